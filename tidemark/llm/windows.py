"""Substring dedup over words: every passage of `window` words that also starts anywhere else is removed.

Each run of `window` words has a Rabin-Karp hash of 64 bits and a second one of 16; all of them are counted in Spark
(`chunks.count_hashes`), and the windows counted more than once are merged into maximal intervals per document. With 80 bits,
n windows give n^2 / 2^81 false pairs: none to be expected in 10^12 windows.

Null and empty texts have no words and stay as they are. A text shorter than a window loses nothing. Repeated rows are repeats
of each other. Windows never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.chunks import as_table, count_hashes, distinct, each_chunk, lay_chunks, levels_of, parts_of
from tidemark.llm.text import OTHER, OTHER_INVERSE, Words, covered, lay, rolling

WINDOW = 35
REPORT = "n_words long, n_removed long, kept_sha256 string, removed array<struct<first: long, last: long>>"


def windows_of(table: pa.Table, text: str, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(hash, check, start, n_words) of all windows of a chunk's table, start by the chunk's words; words are hashed slice by slice."""
    keys, checks, starts, done = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)], [np.zeros(0, np.int32)], 0
    for part in parts_of(table, text):
        words = Words(*lay(part.column(text)))
        own, start = words.windows(window)
        keys.append(own)
        checks.append((rolling(words.hash, window, OTHER, OTHER_INVERSE)[start] >> np.uint64(48)).astype(np.uint16))
        start += done
        done += len(words.begin)
        starts.append(start.astype(np.int32) if done < 1 << 31 else start)
        del words, own, start
    return np.concatenate(keys), np.concatenate(checks), np.concatenate(starts), done


def counted(docs: DataFrame, text: str, window: int) -> DataFrame:
    """Chunks of `docs` with the levels of their windows."""

    def extract(row: dict) -> tuple[np.ndarray, np.ndarray]:
        return windows_of(as_table(row["docs"]).select([text]), text, window)[:2]

    return count_hashes(lay_chunks(docs, text), extract, 6.0, "levels")


def repeats(row: dict, text: str, window: int) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray]]:
    """A chunk's documents slice by slice, their words, and which words lie in a repeated window."""
    table = as_table(row["docs"])
    keys, check, start, n = windows_of(table.select([text]), text, window)
    place = distinct(keys, check)[3]
    del keys, check
    again = levels_of(row["levels"])[place] > 1 if len(place) else np.zeros(0, bool)
    gone = covered(start[again], window, n)
    del place, again, start
    at = 0
    for part in parts_of(table, text):
        words = Words(*lay(part.column(text)), hashed=False)
        yield part, words, gone[at : at + len(words.begin)]
        at += len(words.begin)


def report_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: its key, n_words, n_removed, the SHA-256 of the kept words joined by one space, and the removed intervals."""
    docs = docs.select(key, text)

    def work(row: dict) -> Iterator[pa.Table]:
        for part, words, gone in repeats(row, text, window):
            removed, shas, intervals, keep = [], [], [], ~gone
            for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                own = gone[a:b]
                edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist() if own.any() else []
                removed.append(int(own.sum()))
                intervals.append([{"first": x, "last": y - 1} for x, y in zip(edges[0::2], edges[1::2])])
                shas.append(hashlib.sha256(words.text_of(i, keep if removed[-1] else None)).hexdigest())
            kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            yield pa.table(
                {key: part.column(key), "n_words": words.counts(), "n_removed": pa.array(removed, pa.int64()),
                 "kept_sha256": pa.array(shas, pa.string()), "removed": pa.array(intervals, kind)}
            )

    kind = docs.schema[key].dataType.simpleString()
    return each_chunk(counted(docs, text, window), work, f"`{key}` {kind}, {REPORT}")


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """`docs` with every repeated passage cut out of `text`; texts that lose nothing stay byte for byte as they are."""
    names = docs.columns
    schema = to_arrow_schema(docs.schema)

    def work(row: dict) -> Iterator[pa.Table]:
        for part, words, gone in repeats(row, text, window):
            keep = ~gone
            total = np.concatenate([[0], np.cumsum(gone)])
            hit = total[words.first[1:]] > total[words.first[:-1]]
            # only texts that lose something become strings here
            new = pa.array([words.text_of(i, keep).decode("utf-8", "replace") for i in np.flatnonzero(hit).tolist()], pa.string())
            old = part.column(text).cast(pa.string())
            columns = [pc.replace_with_mask(old, pa.array(hit), new) if c == text else part.column(c) for c in names]
            yield pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return each_chunk(counted(docs, text, window), work, docs.schema)
