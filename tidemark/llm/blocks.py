"""Links within families of sets, found block by block inside tasks: a block yields a forest of its links, never its pairs.

A family is a group of sets that may link, cut into parts that are known to hang together. What is left to find are links between
parts. The largest part is not compared with itself; all other sets meet each other and the largest part. A family too large for
one block is dealt over a grid of blocks, each of bounded rows and bytes; small families share a block. Within a block, pairs are
looked at in steps of bounded size, those first that a few sets have with all others, and what hangs together is not compared again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import give_back

# Sets and bytes in one cell; a block has two cells.
CELL_ROWS = 1024
CELL_BYTES = 16 << 20
# Pairs looked at in one step, growing from the first number to the second.
FIRST_STEP, STEP = 1 << 11, 1 << 15

# Given a block, tells which of its pairs of rows may link.
Likely = Callable[[pa.Table], Callable[[np.ndarray, np.ndarray], np.ndarray]]


def shared_counts(ids: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Elements that set a[i] and set b[i] share; set x is ids[first[x]:first[x+1]], small numbers without repeats, and a ascends."""
    if not len(a):
        return np.zeros(0, np.int64)
    mark = np.zeros(int(ids.max()) + 1 if len(ids) else 1, bool)
    out = np.zeros(len(a), np.int64)
    cuts = np.flatnonzero(np.diff(a, prepend=-1)).tolist() + [len(a)]
    for at, end in zip(cuts[:-1], cuts[1:]):
        own = ids[first[a[at]] : first[a[at] + 1]]
        mark[own] = True
        others = b[at:end]
        size = first[others + 1] - first[others]
        start = np.cumsum(size) - size
        held = mark[ids[np.arange(int(size.sum())) + np.repeat(first[others] - start, size)]]
        total = np.concatenate([[0], np.cumsum(held)])
        out[at:end] = total[start + size] - total[start]
        mark[own] = False
    return out


def root(above: list[int], x: int) -> int:
    while above[x] != x:
        above[x] = above[above[x]]
        x = above[x]
    return x


def pair_steps(later: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (x, y) with x < y < later[x], in steps of bounded size."""
    size = np.maximum(later - np.arange(len(later)) - 1, 0)
    upto = np.cumsum(size)
    at, bound = 0, FIRST_STEP
    while at < len(later):
        done = int(upto[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + bound, "right")))
        own = size[at:end]
        a = np.repeat(np.arange(at, end), own)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(own) - own, own)
        at, bound = end, min(2 * bound, STEP)


def forest(block: pa.Table, percent: int, likely: Likely) -> list[tuple[int, int]]:
    """Linked rows (a, b) of a block sorted by family, enough of them to connect what links connect."""
    family = block.column("family").to_pylist()
    n = block.column("n").to_numpy()
    cell, whole = block.column("cell").to_numpy(), block.column("i").to_numpy() == block.column("j").to_numpy()
    ids = np.unique(np.frombuffer(b"".join(block.column("items").to_pylist()), "<u8"), return_inverse=True)[1]
    may_link = likely(block)
    first = np.concatenate([[0], np.cumsum(n)])
    parts: dict[tuple, int] = {}
    above = list(range(len(n)))
    for i, key in enumerate(zip(family, block.column("part").to_pylist())):
        above[i] = parts.setdefault(key, i)
    ends = np.flatnonzero([x != y for x, y in zip(family, [*family[1:], None])]) + 1 if family else np.zeros(0, np.int64)
    later = np.repeat(ends, np.diff(ends, prepend=0))
    found = []
    for a, b in pair_steps(later):
        top = np.array([root(above, i) for i in range(len(above))])
        small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        # sets of one cell meet in the block that holds this cell alone
        open_pairs = np.flatnonzero((top[a] != top[b]) & (100 * small >= percent * large) & (whole[a] | (cell[a] != cell[b])))
        a, b = a[open_pairs], b[open_pairs]
        good = np.flatnonzero(may_link(a, b)) if len(a) else np.zeros(0, np.int64)
        a, b = a[good], b[good]
        shared = shared_counts(ids, first, a, b)
        linked = np.flatnonzero(100 * shared >= percent * (n[a] + n[b] - shared))
        for x, y in zip(a[linked].tolist(), b[linked].tolist()):
            p, q = root(above, x), root(above, y)
            if p != q:
                above[max(p, q)] = min(p, q)
                found.append((x, y))
    return found


def link_families(members: DataFrame, percent: int, likely: Likely) -> DataFrame:
    """Links (a, b) between parts of a family, as nodes.

    `members` has family, part, node (all binary), n (long: the set's size), items (its elements, 64 bits each) and whatever else
    `likely(block)(a, b)` wants to see in order to tell which pairs of a block's rows may link. Families of one part have nothing to
    find.
    """
    members = members.filter("n > 0")
    sizes = members.groupBy("family", "part").agg(F.count("*").alias("rows"), F.sum(F.length("items")).alias("bytes"))
    sizes = sizes.groupBy("family").agg(
        F.max(F.struct("rows", "bytes", "part")).alias("main"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.count("*").alias("parts")
    ).filter("parts > 1")
    cells = lambda rows, size: F.greatest(F.ceil(rows / CELL_ROWS), F.ceil(size / CELL_BYTES)).cast("int")
    sizes = sizes.select(
        "family", F.col("main.part").alias("main"), cells(F.col("rows") - F.col("main.rows"), F.col("bytes") - F.col("main.bytes")).alias("rest"),
        cells(F.col("main.rows"), F.col("main.bytes")).alias("own"), "rows", "bytes",
    )
    about = sizes.agg(F.sum("rows"), F.sum("bytes")).first()
    packs = max((about[0] or 0) // CELL_ROWS, (about[1] or 0) // CELL_BYTES) + 1
    placed = members.join(sizes.drop("rows", "bytes"), "family")
    spread = lambda n: F.pmod(F.xxhash64("node", F.lit(11)), n).cast("int")
    inner = F.col("part") == F.col("main")
    placed = placed.withColumn("cell", F.when(inner, F.col("rest") + spread(F.col("own"))).otherwise(spread(F.col("rest"))))
    # a set of the largest part meets all cells of other sets; those meet all cells; two cells of a small family are one block
    small = (F.col("rest") == 1) & (F.col("own") == 1)
    others = F.sequence(F.lit(0), F.col("rest") - 1 + F.when(inner, 0).otherwise(F.col("own")))
    placed = placed.withColumn("other", F.explode(F.when(small, F.array(F.lit(-1))).otherwise(others)))
    side = lambda of: F.when(small, 0).otherwise(of("cell", "other"))
    placed = placed.select(*members.columns, "cell", side(F.least).alias("i"), side(F.greatest).alias("j"), small.alias("small"))
    pack = F.when(F.col("small"), F.pmod(F.xxhash64("family"), F.lit(packs))).otherwise(F.xxhash64("family", "i", "j"))

    def work(table: pa.Table) -> pa.Table:
        give_back()
        table = table.sort_by([("family", "ascending"), ("i", "ascending"), ("j", "ascending"), ("node", "ascending")])
        place = list(zip(*(table.column(c).to_pylist() for c in ("family", "i", "j"))))
        node, small = table.column("node").to_pylist(), table.column("small").to_pylist()
        a, b, at = [], [], 0
        while at < len(place):
            # blocks of a grid one by one, small families together
            end = at
            while end < len(place) and (place[end] == place[at] or (small[end] and small[at])):
                end += 1
            for x, y in forest(table.slice(at, end - at), percent, likely):
                a.append(node[at + x])
                b.append(node[at + y])
            at = end
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return placed.withColumn("pack", pack).groupBy("pack").applyInArrow(work, "a binary, b binary")
