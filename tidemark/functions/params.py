"""Typed run parameters and their markers in SQL text."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

# Quoted text and comments are passed over; only a bare $name is a parameter.
_TOKENS = re.compile(
    r"""('(?:[^']|'')*'|"(?:[^"]|"")*"|`[^`]*`|--[^\n]*|/\*.*?\*/)|\$([A-Za-z_]\w*)""",
    re.DOTALL,
)

# Accepted spellings of a boolean parameter.
TRUE_WORDS = ("true", "yes", "1", "on")
FALSE_WORDS = ("false", "no", "0", "off")


def markers(text: str, only: bool = False) -> str:
    """`$name` becomes Spark's `:name` marker; with `only`, the markers alone are returned."""
    if only:
        return " ".join(f":{m.group(2)}" for m in _TOKENS.finditer(text) if m.group(2))
    return _TOKENS.sub(lambda m: m.group(1) or f":{m.group(2)}", text)


@dataclass(frozen=True)
class Parameter:
    """A declared parameter: its type (`str`, `int`, `float`, `bool`), default, and whether a value must be given."""

    name: str
    kind: type = str
    default: Any = None
    required: bool = False

    def parse(self, value: Any) -> Any:
        if self.kind is bool and not isinstance(value, bool):
            word = str(value).lower()
            if word in TRUE_WORDS:
                return True
            if word in FALSE_WORDS:
                return False
            raise ValueError(f"invalid boolean value for {self.name!r}: {value!r}")
        try:
            return self.kind(value)
        except (TypeError, ValueError) as error:
            raise ValueError(f"failed to parse value for {self.name!r}: {value!r}") from error


def resolve(declared: list[Parameter], given: Mapping[str, Any]) -> dict[str, Any]:
    """Given values over defaults; an unknown name and a missing required value are errors."""
    known = {parameter.name: parameter for parameter in declared}
    for name in given:
        if name not in known:
            raise ValueError(f"unknown parameter: {name!r}")
    values = {}
    for name, parameter in known.items():
        if name in given:
            values[name] = parameter.parse(given[name])
        elif parameter.default is not None:
            values[name] = parameter.parse(parameter.default)
        elif parameter.required:
            raise ValueError(f"missing required parameter: {name!r}")
    return values
