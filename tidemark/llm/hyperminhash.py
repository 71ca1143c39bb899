"""Near-duplicate search by HyperMinHash: registers of leading-zero counts plus mantissa bits, banded, estimated, then verified.

A document's set of word shingles fills REGISTERS buckets. Each bucket keeps the least hash that falls into it, compressed to 16
bits: the count of its leading zeros (6) and the bits behind the first one (10). Sets too small to fill all buckets are dealt again
with further hashes, and at last each empty bucket takes the least of all elements, so that a register of two sets agrees with the
probability of their Jaccard similarity however small they are; the first round that reaches a bucket counts.

BANDS bands of ROWS registers are hashed. Sets with a band in common are candidates: two sets of similarity 0.85 miss each other in
all bands with a probability of (1 - 0.85^6)^40 = 6e-9 (0.8: 5e-6). In each band's list all are compared with one, the set that
most others share bands with, which is linear in the list; families so connected are then searched for further links block by block
(`blocks`). Before full sets are compared, the share of equal registers, corrected for registers that agree by chance since 16 bits
are few, must reach the limit less six standard deviations. Links are confirmed on full sets of 64-bit shingle hashes.

Equal sets are one class from the start. Null texts and texts without words have an empty set and link with nothing; texts of fewer
words than a shingle are one shingle. Repeated rows are one class. Of equal ids within a component any one row stands for all. No
list, pair or row is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.blocks import link_families
from tidemark.llm.chunks import as_table, each_chunk, lay_chunks, slices
from tidemark.llm.components import components
from tidemark.llm.ngram_join import digest, shingles
from tidemark.llm.scratch import Scratch
from tidemark.llm.text import lay, mix

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
MANTISSA = 10
# Rounds in which elements are dealt over buckets by chance, before what is empty still takes from all elements.
ROUNDS = 8
# Elements times empty buckets worked on at a time in the last round.
STEP = 1 << 20


def compressed(top: np.ndarray) -> np.ndarray:
    """Leading zeros of 32-bit values and the mantissa bits behind the first one, as 16 bits."""
    fraction, exponent = np.frexp(top.astype(np.float64) + 0.5)
    return ((32 - exponent).astype(np.uint16) << np.uint16(MANTISSA)) | ((2 * fraction - 1) * (1 << MANTISSA)).astype(np.uint16)


def sketches(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers of each set keys[first[i]:first[i+1]], one row per set; an empty set's are all zero."""
    n = len(first) - 1
    out, open_ = np.zeros((n, REGISTERS), np.uint16), np.repeat((np.diff(first) > 0)[:, None], REGISTERS, axis=1)
    owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))

    def fill(place: np.ndarray, value: np.ndarray) -> None:
        # place and the value's upper half as one number, so that one sort puts each place's least value first
        packed = np.sort((place << np.uint64(32)) | (value >> np.uint64(32)))
        place = packed >> np.uint64(32)
        head = np.flatnonzero(np.diff(place, prepend=np.uint64(0xFFFFFFFF)) != 0)
        at = place[head].astype(np.int64)
        still = open_.ravel()[at]
        out.ravel()[at[still]] = compressed(packed[head][still] & np.uint64(0xFFFFFFFF))
        open_.ravel()[at[still]] = False

    left = np.arange(len(keys))
    for turn in range(ROUNDS):
        h = mix(keys[left] ^ np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        bucket = ((h >> np.uint64(40)) * np.uint64(REGISTERS)) >> np.uint64(24)
        fill(owner[left] * np.uint64(REGISTERS) + bucket, mix(h + np.uint64(turn)))
        left = left[open_.any(axis=1)[owner[left]]]
        if not len(left):
            return out
    doc, bucket = np.nonzero(open_)
    size = np.diff(first)[doc]
    upto, at = np.cumsum(size), 0
    while at < len(doc):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + STEP, "right")))
        own = size[at:end]
        element = np.arange(int(own.sum())) + np.repeat(first[doc[at:end]] - np.cumsum(own) + own, own)
        which = np.repeat(bucket[at:end].astype(np.uint64), own)
        fill(np.repeat((doc[at:end] * REGISTERS + bucket[at:end]).astype(np.uint64), own), mix(mix(keys[element] + which) ^ (which + np.uint64(77))))
        at = end
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band, with the band's number in it."""
    rows = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    key = np.tile(np.arange(BANDS, dtype=np.uint64), (len(registers), 1))
    for i in range(ROWS):
        key = mix(key * np.uint64(0x100000001B3) + rows[:, :, i] + np.uint64(1))
    return key


def chance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability that registers of two sets without common elements agree, for sets of a and b elements.

    A register whose bucket has x elements holds a cell at value v of width w with probability w x e^(-x v); products of two such are
    summed over the cells of each leading-zero count.
    """
    x, y = np.maximum(a / REGISTERS, 1.0), np.maximum(b / REGISTERS, 1.0)
    total, both = np.zeros(len(x)), x + y
    for zeros in range(32):
        low, high = 2.0 ** -(zeros + 1), 2.0**-zeros
        total += low * (np.exp(-both * low) - np.exp(-both * high))
    return x * y / both * total / (1 << MANTISSA)


def estimate(equal: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers of sets of a and b elements."""
    c = chance(a, b)
    return (equal / REGISTERS - c) / (1 - c)


def least_estimate(percent: int) -> float:
    """Six standard deviations below the similarity asked for."""
    j = percent / 100
    return j - 6 * float(np.sqrt(j * (1 - j) / REGISTERS))


def same_registers(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    out = np.empty(len(one), np.int64)
    for at in range(0, len(one), 4096):
        out[at : at + 4096] = (one[at : at + 4096] == two[at : at + 4096]).sum(axis=1)
    return out


def as_registers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


def heads_of(chunks: DataFrame, key: str, kind: str, text: str, size: int, percent: int) -> DataFrame:
    """Per document: loc, key, n, node (the digest of its set), and the band keys of sets that can link to any but their equal."""

    def work(row: dict) -> Iterator[pa.Table]:
        at = 0
        for part in as_table(row["docs"]).select([key, text]).combine_chunks().to_batches():
            for batch in slices(part, text):
                keys, first = shingles(*lay(batch.column(text)), size)
                n = np.diff(first).astype(np.int64)
                nodes = [digest(keys[a:b]) if a < b else None for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                able = np.flatnonzero(100 * n >= percent * (n + 1))
                size_ = np.diff(first)[able]
                picked = np.arange(int(size_.sum())) + np.repeat(first[able] - np.cumsum(size_) + size_, size_)
                bands = band_keys(sketches(keys[picked], np.concatenate([[0], np.cumsum(size_)]))).view(np.int64)
                lists: list[np.ndarray | None] = [None] * len(n)
                for i, own in zip(able.tolist(), bands):
                    lists[i] = own
                locs = [f"{row['chunk']}:{at + i}" for i in range(len(n))]
                at += len(n)
                yield pa.table(
                    {"loc": locs, key: batch.column(key), "n": n, "node": pa.array(nodes, pa.binary()), "bands": pa.array(lists, pa.list_(pa.int64()))}
                )

    return each_chunk(chunks.select("chunk", "docs"), work, f"loc string, `{key}` {kind}, n long, node binary, bands array<long>")


def sets_of(chunks: DataFrame, wanted: DataFrame, text: str, size: int) -> DataFrame:
    """(node, n, items, registers) of the documents at `wanted` (node, loc), worked out again from their texts."""
    at = F.split("loc", ":")
    places = wanted.select(at[0].alias("chunk"), F.struct(at[1].cast("int").alias("row"), "node").alias("place"))
    places = places.groupBy("chunk").agg(F.sort_array(F.collect_list("place")).alias("places"))

    def work(row: dict) -> Iterator[pa.Table]:
        picked = as_table(row["docs"]).select([text]).take(pa.array([p["row"] for p in row["places"]], pa.int64()))
        nodes, at = [p["node"] for p in row["places"]], 0
        for part in picked.combine_chunks().to_batches():
            for batch in slices(part, text):
                keys, first = shingles(*lay(batch.column(text)), size)
                items = [keys[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                registers = [r.astype("<u2").tobytes() for r in sketches(keys, first)]
                yield pa.table(
                    {"node": pa.array(nodes[at : at + len(items)], pa.binary()), "n": np.diff(first).astype(np.int64), "items": pa.array(items, pa.binary()),
                     "registers": pa.array(registers, pa.binary())}
                )
                at += len(items)

    return each_chunk(chunks.select("chunk", "docs").join(places, "chunk"), work, "node binary, n long, items binary, registers binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose estimate reaches the limit and whose full sets link."""
    limit = least_estimate(percent)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("a_n").to_numpy(), batch.column("b_n").to_numpy()
            equal = same_registers(as_registers(batch.column("a_registers")), as_registers(batch.column("b_registers")))
            good = estimate(equal, n, m) >= limit
            left, right = batch.column("a_items"), batch.column("b_items")
            for i in np.flatnonzero(good).tolist():
                x, y = (np.frombuffer(c[i].as_buffer(), "<u8") for c in (left, right))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one, two = (sets.select(*[F.col(c).alias(s if c == "node" else f"{s}_{c}") for c in sets.columns]) for s in "ab")
    both = pairs.join(one, "a").join(two, "b").filter(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
    return both.mapInArrow(compare, "a binary, b binary")


def links_of(heads: DataFrame, chunks: DataFrame, text: str, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between different sets, enough of them to connect all that any links connect."""
    nodes = heads.filter("bands is not null").groupBy("node").agg(F.first("bands").alias("bands"))
    posted = nodes.select("node", F.explode("bands").alias("band"))
    # lists of one set end here
    many = posted.groupBy("band").agg(F.count("*").alias("held")).filter("held > 1")
    lists = scratch.lay(posted.join(many, "band"), "lists")
    weights = lists.groupBy("node").agg(F.sum("held").alias("weight"))
    hubs = lists.select("band", "node").join(weights, "node").groupBy("band").agg(F.max(F.struct("weight", "node")).alias("hub"))
    star = lists.select("band", "node").join(hubs, "band").select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
    star = scratch.lay(star.filter("a != b").distinct(), "pairs")
    wanted = heads.select("node", "loc").join(lists.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min("loc").alias("loc"))
    sets = scratch.lay(sets_of(chunks, wanted, text, size), "sets")
    links = scratch.lay(verified(star, sets, percent), "links")

    # families share bands; what of them is not yet connected is searched block by block
    family = components(star).withColumnRenamed("part", "family")
    places = family.join(components(links), "node", "left").withColumn("part", F.coalesce("part", "node"))
    # families of one part are done; only sets of the others move, once
    several = places.groupBy("family").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo != hi").select("family")
    members = scratch.lay(sets.join(places.join(several, "family"), "node"), "members")
    limit = least_estimate(percent)

    def likely(block: pa.Table):
        registers, n = as_registers(block.column("registers")), block.column("n").to_numpy()
        bands = band_keys(registers)

        def judge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            good = np.zeros(len(a), bool)
            for at in range(0, len(a), 4096):
                x, y = a[at : at + 4096], b[at : at + 4096]
                good[at : at + 4096] = (bands[x] == bands[y]).any(axis=1)
            maybe = np.flatnonzero(good)
            x, y = a[maybe], b[maybe]
            good[maybe] = estimate(same_registers(registers[x], registers[y]), n[x], n[y]) >= limit
            return good

        return judge

    return links.union(link_families(members, percent, likely))


def parted(docs: DataFrame, key: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(chunks, rows): rows have loc, key, n_shingles, component_id and part, which names the component as keys may be null or repeat."""
    work, kept = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    chunks = lay_chunks(docs, text)
    kind = docs.schema[key].dataType.simpleString()
    heads = work.lay(heads_of(chunks, key, kind, text, size, percent), "heads")
    label = components(work.lay(links_of(heads, chunks, text, size, percent, work), "links"))
    heads = kept.lay(heads.select("loc", key, "n", "node"), "nodes")
    work.clear()
    classes = heads.filter("n > 0").groupBy("node").agg(F.min(key).alias("least")).join(label, "node", "left")
    classes = classes.withColumn("part", F.coalesce("part", "node"))
    groups = classes.groupBy("part").agg(F.min("least").alias("component_id"))
    found = classes.join(groups, "part").select("node", "component_id", "part")
    rows = heads.select("loc", key, F.col("n").alias("n_shingles"), "node").join(found, "node", "left")
    own = F.when(F.col("n_shingles") == 0, F.col(key)).otherwise(F.col("component_id"))
    return chunks, rows.select("loc", key, "n_shingles", own.alias("component_id"), "part")


def find_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: key, n_shingles, component_id (the smallest key reachable by links, itself included) and kept.

    `kept` is true where key and component_id are equal; a null key is kept where its component has no other.
    """
    _, rows = parted(docs, key, text, size, percent)
    return rows.select(key, "n_shingles", "component_id", F.col(key).eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """`docs` with one row of each component, that of the smallest key; rows without words all stay."""
    chunks, rows = parted(docs, key, text, size, percent)
    worded = rows.filter("n_shingles > 0").groupBy("part").agg(F.min(F.struct(key, "loc")).alias("m")).select("m.loc")
    at = F.split("loc", ":")
    stay = worded.union(rows.filter("n_shingles = 0").select("loc")).groupBy(at[0].alias("chunk")).agg(F.collect_list(at[1].cast("int")).alias("rows"))
    names, schema = docs.columns, to_arrow_schema(docs.schema)

    def work(row: dict) -> pa.Table:
        table = as_table(row["docs"]).take(pa.array(sorted(row["rows"]), pa.int64()))
        return pa.Table.from_arrays([table.column(c).cast(f.type) for c, f in zip(names, schema)], schema=schema)

    return each_chunk(chunks.join(stay, "chunk"), work, docs.schema)
