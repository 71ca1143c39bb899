"""Repeated byte strings by longest-previous-factor arrays: later copies go and the first stays, or, on request, all copies go.

A suffix array of a whole corpus fits no machine, so equal strings are first brought together. Every string of `width` bytes has
an anchor: the smallest hash of the grams inside it, so equal strings have equal anchors at equal places. Anchors are counted over
the corpus (`chunks.count_hashes`); a string whose anchor occurs once cannot repeat. The others, as runs of starts that share an
anchor, are sent to shards by anchor. A shard keeps each different run once, sorts the suffixes of all of them, and finds with the
previous and next smaller positions in suffix order the longest factor that also starts earlier, and later; starts whose factor
reaches `width` are repeats. Shards answer with one bit a start.

An anchor that very many runs share could fill a shard; strings under such anchors are counted one by one by 80-bit hashes instead,
which spreads evenly. Both ways are exact but for those hashes.

The first copy is that of the first document in the order in which `docs` is partitioned and read.

Null is an empty text. A text shorter than `width` loses nothing. Repeated rows repeat each other. Strings never cross texts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.chunks import as_table, count_hashes, count_of, distinct, each_chunk, lay_chunks, levels_of
from tidemark.llm.text import OTHER, OTHER_INVERSE, byte_values, covered, lay, rolling
from tidemark.session import written

WIDTH = 200
GRAM = 64
# Runs of one anchor that a shard may be sent before its strings are counted singly.
HOT_RUNS = 2000
# Bytes of runs that one shard should hold, and suffixes sorted together.
SHARD_BYTES = 2 << 20
# Bytes whose anchors are sought in one go.
PART = 1 << 19


def window_minima(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every `size` neighbours, from running minima of blocks."""
    n = len(x) - size + 1
    blocks = -(-len(x) // size)
    padded = np.full(blocks * size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    table = padded.reshape(blocks, size)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[size - 1 : size - 1 + n])


class Runs:
    """Runs of string starts that share an anchor, over laid-out texts: `start`, `count`, `anchor` hash, and `lead`, the distance
    from the first start to the anchor's place."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, width: int, gram: int):
        values = byte_values()
        found = []
        ends = starts[1:] - 1  # without the newline laid behind each text
        first = 0
        while first < len(ends):
            # neighbouring texts together, up to a part
            last = max(first + 1, int(np.searchsorted(ends, starts[first] + PART, "right")))
            for low, high in _parts(int(starts[first]), int(ends[last - 1]), width):
                found.append(self._anchors(values, data, starts, low, high, width, gram))
            first = last
        cells = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
        self.start, self.count, self.lead, self.anchor = cells

    @staticmethod
    def _anchors(values, data, starts, low, high, width, gram):
        """Runs whose strings lie in data[low:high]."""
        inside = data[low:high]
        n = len(inside) - width + 1
        none = np.zeros(0, np.int64)
        if n <= 0:
            return none, none, none, np.zeros(0, np.uint64)
        # the place of a gram in its low bits makes the first of equal ones the smallest in a window
        hashes = rolling(values[inside], gram)
        size = width - gram + 1
        bits = np.uint64(20)
        ranked = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
        place = (window_minima(ranked, size) & np.uint64((1 << 20) - 1)).astype(np.int64)
        # strings that cross a text's end are no strings
        a, b = np.searchsorted(starts, [low, low + n - 1], "right")
        own = np.repeat(np.arange(a, b + 1), np.diff(np.concatenate([[low], starts[a:b], [low + n]])))
        good = np.arange(low, low + n) + width <= starts[own] - 1
        fresh = np.ones(n, bool)
        fresh[1:] = (place[1:] != place[:-1]) | (own[1:] != own[:-1])
        begin = np.flatnonzero(fresh & good)
        stop = np.flatnonzero(good & np.append(fresh[1:] | ~good[1:], True)) + 1
        return begin + low, stop - begin, place[begin] - begin, hashes[place[begin]]


def _parts(low: int, high: int, width: int) -> Iterator[tuple[int, int]]:
    """[low, high) in parts that overlap so that each string of `width` lies in just one of them whole."""
    while True:
        yield low, min(high, low + PART + width)
        if low + PART + width >= high:
            return
        low += PART + 1


def hot_starts(runs: Runs, hot: np.ndarray) -> np.ndarray:
    """Every start of the runs marked hot."""
    start, count = runs.start[hot], runs.count[hot]
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())


def hot_keys(data: np.ndarray, runs: Runs, hot: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """80 bits of every string of hot runs: 64 and a check of 16."""
    if not hot.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.uint16)
    values, keys, checks = byte_values(), [], []
    for s, n in zip(runs.start[hot].tolist(), runs.count[hot].tolist()):
        part = values[data[s : s + n + width - 1]]
        keys.append(rolling(part, width))
        checks.append((rolling(part, width, OTHER, OTHER_INVERSE) >> np.uint64(48)).astype(np.uint16))
    return np.concatenate(keys), np.concatenate(checks)


def ranks_to_depth(text: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank): suffixes of `text` sorted by their first `depth` bytes; `ends` gives where the run of each place ends.

    Equal ranks are equal prefixes. Prefix doubling: ranks by 8, 16, 32 ... bytes from pairs of ranks half as long.
    """
    n = len(text)
    place = np.arange(n)
    key = np.zeros(n, np.uint64)
    for i in range(7):
        at = np.minimum(place + i, n - 1)
        # a byte past the run's end sorts before all others
        key = (key << np.uint64(9)) | np.where(place + i < ends, text[at].astype(np.uint64) + np.uint64(1), np.uint64(0))
    reached = 7
    while True:
        order = np.argsort(key, kind="stable")
        k = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(True, k[1:] != k[:-1])) if n else 0
        if reached >= depth:
            return order, rank
        step = min(reached, depth - reached)
        at = np.minimum(place + step, n - 1)
        after = np.where(place + step < ends, rank[at] + 1, 0)
        key = (rank.astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
        reached += step


def longest_factors(order: np.ndarray, rank: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(previous, next) per place: the longest factor, up to `width`, that also starts at an earlier, or at a later, place.

    Places are scanned in suffix order. The previous smaller and the next smaller position of a suffix hold its longest previous
    factor; suffixes are only ordered to `width`, so a common prefix counts as `width` where ranks agree and as 0 where not.
    Within a block of equal ranks a stable order ascends by position, so the previous smaller position is the neighbour before,
    and the next larger one the neighbour behind.
    """
    n = len(order)
    common = np.zeros(n + 1, np.int64)
    common[1:n] = np.where(rank[order[1:]] == rank[order[:-1]], width, 0)
    previous, following = np.zeros(n, np.int64), np.zeros(n, np.int64)
    previous[order], following[order] = common[:n], common[1:]
    return previous, following


def shard_repeats(
    anchors: np.ndarray, counts: np.ndarray, texts: list[bytes], width: int, keep_first: bool
) -> list[np.ndarray]:
    """For each run, which of its starts begin a string that begins elsewhere in the shard too, or before it in the shard."""
    seen: dict[tuple[int, bytes], int] = {}
    kind = np.array([seen.setdefault((a, t), len(seen)) for a, t in zip(anchors.tolist(), texts)], np.int64)
    copies = np.bincount(kind)
    answers: list[np.ndarray | None] = [None] * len(seen)
    first = {}
    for i, k in enumerate(kind.tolist()):
        first.setdefault(k, i)
    # the different runs of one anchor are compared; a run that stands alone repeats as a whole or not at all
    by_anchor: dict[int, list[int]] = {}
    for (a, _), k in seen.items():
        by_anchor.setdefault(a, []).append(k)
    batch: list[int] = []
    size = 0

    def settle() -> None:
        nonlocal batch, size
        if batch:
            text = np.frombuffer(b"".join(texts[first[k]] for k in batch), np.uint8)
            lengths = np.array([len(texts[first[k]]) for k in batch])
            ends = np.repeat(np.cumsum(lengths), lengths)
            # factors past a run's end never reach the width, as every run ends with the last string of its starts
            order, rank = ranks_to_depth(text, ends, width)
            previous, following = longest_factors(order, rank, width)
            at = np.cumsum(lengths) - lengths
            for k, s in zip(batch, at.tolist()):
                n = int(counts[first[k]])
                later = (following[s : s + n] >= width) & (not keep_first)
                answers[k] = (previous[s : s + n] >= width) | later
        batch, size = [], 0

    for kinds in by_anchor.values():
        if len(kinds) > 1:
            batch += kinds
            size += sum(len(texts[first[k]]) for k in kinds)
        if size > SHARD_BYTES:
            settle()
    settle()
    out = []
    for i, k in enumerate(kind.tolist()):
        alone = answers[k] is None
        whole = np.full(int(counts[i]), i != first[k] if keep_first else copies[k] > 1)
        out.append(whole if alone else answers[k] | whole)
    return out


def marked(docs: DataFrame, text: str, width: int, gram: int, hot_runs: int, keep_first: bool) -> DataFrame:
    """Chunks of `docs` with the anchors' levels, the hot strings' levels, and the shards' answers."""

    def runs_of(row: dict) -> tuple[np.ndarray, np.ndarray, Runs]:
        data, starts = lay(as_table(row["docs"]).column(text))
        return data, starts, Runs(data, starts, width, gram)

    def anchors(row: dict) -> tuple[np.ndarray, None]:
        return runs_of(row)[2].anchor, None

    chunks = lay_chunks(docs, text)
    counted = count_hashes(chunks, anchors, 60.0, "anchors")
    counted = written(counted.drop("docs"), "anchors")
    both = chunks.join(counted.drop("n_bytes"), "chunk")
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(16, int(total // SHARD_BYTES) + 1)

    def send(row: dict) -> pa.Table:
        data, _, runs = runs_of(row)
        count = _counts(runs, row["anchors"])
        hot = count > hot_runs
        chosen = np.flatnonzero((count > 1) & ~hot)
        shard = (runs.anchor[chosen] >> np.uint64(24)) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        chosen, shard = chosen[order], shard[order].astype(np.int64)
        cuts = [*np.flatnonzero(np.diff(shard, prepend=-1)).tolist(), len(shard)]
        rows = {"shard": [], "chunk": [], "anchors": [], "counts": [], "texts": []}
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = chosen[a:b]
            pieces = [data[s : s + n + width - 1].tobytes() for s, n in zip(runs.start[own].tolist(), runs.count[own].tolist())]
            rows["shard"].append(int(shard[a]))
            rows["chunk"].append(row["chunk"])
            rows["anchors"].append(runs.anchor[own].tobytes())
            rows["counts"].append(runs.count[own].astype("<u2").tobytes())
            rows["texts"].append(zlib.compress(b"".join(pieces), 1))
        rows["strings"] = [None] * len(rows["shard"])
        if hot.any():
            # carried once more through the counting of single strings
            rows = {k: [*v, None if k != "chunk" else row["chunk"]] for k, v in rows.items()}
            keys, checks, _, _ = distinct(*hot_keys(data, runs, hot, width))
            rows["shard"][-1] = -1
            rows["strings"][-1] = keys.tobytes() + checks.tobytes()
        kinds = {"shard": pa.int64(), "chunk": pa.string()}
        return pa.table({k: pa.array(v, kinds.get(k, pa.binary())) for k, v in rows.items()})

    def answer(group: pa.Table) -> pa.Table:
        group = group.sort_by("chunk")
        anchors, counts, texts, sizes = [], [], [], []
        for a, n, t in zip(*(group.column(c).to_pylist() for c in ("anchors", "counts", "texts"))):
            a, n, t = np.frombuffer(a, np.uint64), np.frombuffer(n, "<u2").astype(np.int64), zlib.decompress(t)
            at = np.cumsum(n + width - 1)
            texts += [t[y - x : y] for x, y in zip((n + width - 1).tolist(), at.tolist())]
            anchors.append(a)
            counts.append(n)
            sizes.append(len(a))
        found = shard_repeats(np.concatenate(anchors), np.concatenate(counts), texts, width, keep_first)
        cuts = np.cumsum([0, *sizes]).tolist()
        bits = [np.packbits(np.concatenate(found[a:b])).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.table({"shard": group.column("shard"), "chunk": group.column("chunk"), "bits": pa.array(bits, pa.binary())})

    sent = each_chunk(both, send, "shard long, chunk string, anchors binary, counts binary, texts binary, strings binary")
    sent = written(sent, "runs")
    bits = sent.filter("shard >= 0").groupBy("shard").applyInArrow(answer, "shard long, chunk string, bits binary")
    bits = bits.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("shard", "bits"))).alias("b"))
    bits = bits.select("chunk", F.col("b.bits").alias("bits"))

    def carried(row: dict) -> tuple[np.ndarray, np.ndarray]:
        n = len(row["strings"]) // 10
        return np.frombuffer(row["strings"], np.uint64, n), np.frombuffer(row["strings"], np.uint16, n, 8 * n)

    singles = sent.filter("shard = -1").select("chunk", F.length("strings").cast("long").alias("n_bytes"), "strings")
    singles = count_hashes(singles, carried, 10.0, "singles", earlier=keep_first).select("chunk", "singles")
    marks = written(counted.select("chunk", "anchors").join(bits, "chunk", "left").join(singles, "chunk", "left"), "marks")
    return chunks.join(marks.withColumn("shards", F.lit(shards)), "chunk")


def _counts(runs: Runs, parts: list[bytes] | None) -> np.ndarray:
    place = distinct(runs.anchor, None)[3]
    return count_of(levels_of(parts)[place]) if len(place) else np.zeros(0)


def repeated_bytes(
    row: dict, text: str, width: int, gram: int, hot_runs: int, keep_first: bool
) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's documents, their bytes and where each begins, and which bytes lie in a repeated string."""
    table = as_table(row["docs"])
    data, starts = lay(table.column(text))
    runs = Runs(data, starts, width, gram)
    count = _counts(runs, row["anchors"])
    hot = count > hot_runs
    chosen = np.flatnonzero((count > 1) & ~hot)
    shard = (runs.anchor[chosen] >> np.uint64(24)) % np.uint64(row["shards"])
    order = np.argsort(shard, kind="stable")
    chosen, shard = chosen[order], shard[order]
    begins = []
    if len(chosen):
        cuts = [*np.flatnonzero(np.append(True, shard[1:] != shard[:-1])).tolist(), len(shard)]
        for a, b, bits in zip(cuts[:-1], cuts[1:], row["bits"]):
            n = runs.count[chosen[a:b]]
            again = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(n.sum())).astype(bool)
            at = np.repeat(runs.start[chosen[a:b]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            begins.append(at[again])
    if hot.any():
        _, _, here, place = distinct(*hot_keys(data, runs, hot, width))
        again = levels_of(row["singles"])[place] > 1
        if keep_first:
            within = np.ones(len(place), bool)
            within[np.unique(place, return_index=True)[1]] = False
        else:
            within = here[place] > 1
        begins.append(hot_starts(runs, hot)[again | within])
    gone = covered(np.concatenate(begins), width, len(data)) if begins else np.zeros(len(data), bool)
    return table, data, starts, gone


def report_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    gram: int = GRAM,
    hot_runs: int = HOT_RUNS,
    keep_first: bool = True,
) -> DataFrame:
    """Per document: its key, n_bytes, n_removed, n_spans, and the SHA-256 of the bytes that remain."""
    docs = docs.select(key, text)
    kind = docs.schema[key].dataType.simpleString()

    def work(row: dict) -> pa.Table:
        table, data, starts, gone = repeated_bytes(row, text, width, gram, hot_runs, keep_first)
        removed, spans, shas = [], [], []
        for a, b in zip(starts[:-1].tolist(), (starts[1:] - 1).tolist()):
            own = gone[a:b]
            removed.append(int(own.sum()))
            spans.append(int(np.count_nonzero(np.diff(own, prepend=False) & own)) if removed[-1] else 0)
            shas.append(hashlib.sha256(data[a:b][~own] if removed[-1] else data[a:b]).hexdigest())
        return pa.table(
            {key: table.column(key), "n_bytes": np.diff(starts) - 1, "n_removed": pa.array(removed, pa.int64()),
             "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(shas, pa.string())}
        )

    schema = f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return each_chunk(marked(docs, text, width, gram, hot_runs, keep_first), work, schema)


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    width: int = WIDTH,
    gram: int = GRAM,
    hot_runs: int = HOT_RUNS,
    keep_first: bool = True,
) -> DataFrame:
    """`docs` with the bytes of repeated strings cut out of `text`; broken characters at a cut are dropped."""
    names, schema = docs.columns, to_arrow_schema(docs.schema)

    def work(row: dict) -> pa.Table:
        table, data, starts, gone = repeated_bytes(row, text, width, gram, hot_runs, keep_first)
        new = []
        for i, old in enumerate(table.column(text).to_pylist()):
            a, b = int(starts[i]), int(starts[i + 1]) - 1
            new.append(data[a:b][~gone[a:b]].tobytes().decode("utf-8", "ignore") if gone[a:b].any() else old)
        columns = [pa.chunked_array([pa.array(new, pa.string())]) if c == text else table.column(c) for c in names]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return each_chunk(marked(docs, text, width, gram, hot_runs, keep_first), work, docs.schema)
