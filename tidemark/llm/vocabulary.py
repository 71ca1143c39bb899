"""Per-word results over whole texts: each different word is worked out once per task and looked up for all its occurrences."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

# Words remembered by a task. When there are more, the half not seen for longest is forgotten, which costs time but changes nothing.
REMEMBERED = 400_000
# New words wait in a part of their own until they are so many, so that the large sorted part is seldom built anew.
LEAST_RECENT = 20_000


class Memo:
    """Lists of numbers per word, kept by the word's hash and length.

    The values of place p are values[first[p]:first[p+1]]. Places change when words are forgotten: read the values of one
    `look_up` before the next.
    """

    def __init__(self, work: Callable[[list[bytes]], list[list[int]] | tuple], kind: type = np.uint32):
        self.work, self.kind = work, kind
        self.clear()

    def clear(self) -> None:
        # sorted keys and their places, of most words and of those added lately
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.recent, self.recent_places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.values = np.zeros(1, np.int64), np.zeros(0, self.kind)
        self.used, self.turn, self.notes = np.zeros(0, np.int64), 0, np.zeros(0, object)

    def look_up(self, keys: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray, head: np.ndarray | None = None) -> np.ndarray:
        """The place of each word. `work` gets a word's bytes, behind its `head` if there are heads; a head must tell in the key too.

        `work` returns a list per word, or (lengths, values) of all words' lists one after another, or these and a note per word, such
        as a string; that of place p is notes[p].
        """
        different, at, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.used) + len(different) > REMEMBERED and len(self.used):
            self._forget(max(0, min(REMEMBERED // 2, REMEMBERED - len(different))))
        found = self._find(different)
        new = np.flatnonzero(found < 0)
        if len(new):
            raw = data.tobytes()
            parts = [raw[a:b] for a, b in zip(begin[at[new]].tolist(), end[at[new]].tolist())]
            made = self.work(parts if head is None else [h + p for h, p in zip(head[at[new]].tolist(), parts)])
            if isinstance(made, tuple):
                lengths, values, *notes = made
                if notes:
                    more = np.empty(len(new), object)
                    more[:] = notes[0]
                    self.notes = np.concatenate([self.notes, more])
            else:
                lengths = np.fromiter(map(len, made), np.int64, len(made))
                values = np.fromiter((x for v in made for x in v), self.kind, int(lengths.sum()))
            found[new] = len(self.first) - 1 + np.arange(len(new))
            self.values = np.concatenate([self.values, values.astype(self.kind, copy=False)])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(lengths)])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])
            self.recent, self.recent_places = _merged(self.recent, self.recent_places, different[new], found[new])
            if len(self.recent) > max(LEAST_RECENT, len(self.keys) // 2):
                self.keys, self.places = _merged(self.keys, self.places, self.recent, self.recent_places)
                self.recent, self.recent_places = self.recent[:0], self.recent_places[:0]
        self.turn += 1
        self.used[found] = self.turn
        return found[back]

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Places of sorted keys, -1 for unknown ones."""
        out = np.full(len(keys), -1, np.int64)
        for have, places in ((self.keys, self.places), (self.recent, self.recent_places)):
            if len(have):
                at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
                hit = have[at] == keys
                out[hit] = places[at[hit]]
        return out

    def _forget(self, most: int) -> None:
        """Keep the `most` words used last."""
        stay = np.zeros(len(self.used), bool)
        stay[np.argsort(-self.used, kind="stable")[:most]] = True
        moved = np.cumsum(stay) - 1
        keys, places = _merged(self.keys, self.places, self.recent, self.recent_places)
        self.keys, self.places = keys[stay[places]], moved[places[stay[places]]]
        self.recent, self.recent_places = self.recent[:0], self.recent_places[:0]
        lengths, self.values = gather(self.first, self.values, np.flatnonzero(stay))
        self.first, self.used = np.concatenate([[0], np.cumsum(lengths)]), self.used[stay]
        self.notes = self.notes[stay] if len(self.notes) else self.notes


def _merged(keys: np.ndarray, places: np.ndarray, more: np.ndarray, more_places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, places = np.concatenate([keys, more]), np.concatenate([places, more_places])
    order = np.argsort(keys, kind="stable")
    return keys[order], places[order]


def gather(first: np.ndarray, values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, values) of the lists at `places`, one after another."""
    lengths = first[places + 1] - first[places]
    shift = first[places] - (np.cumsum(lengths) - lengths)
    return lengths, values[np.arange(int(lengths.sum())) + np.repeat(shift, lengths)]
