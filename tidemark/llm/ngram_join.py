"""Similarity join of word-shingle sets by Jaccard, with adaptive multi-match prefixes.

Shingles are ordered by their count over all documents, rarest first. Of a set of n, at least s = ceil(t*n) lie in common with
any set it links to; so two linked sets share at least k of their first n - s + k shingles. Each document picks its k: a longer
prefix reads more lists, but more shared shingles are then required before a pair is compared, so k is chosen to minimise the
estimated cost, lists read plus candidates compared. A pair must share the smaller of its two k.

Equal sets are one class from the start. For the rest, lists are never multiplied out at first: in each list the document that
holds the shingle earliest, usually the original of a family of copies, is compared with all others, which is linear in the
list. What these comparisons connect needs no further comparing. Documents in lists that still hold several components form
families, which are searched for further links block by block (`blocks`): a block looks at pairs in steps, those that share enough
prefix shingles are compared in full, and only a forest of links leaves it. No list, pair or row is capped.

Null texts and texts without words have an empty set and link with nothing; texts of fewer words than a shingle are one shingle.
Repeated rows are one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.blocks import link_families, shared_counts
from tidemark.llm.chunks import as_table, count_hashes, count_of, distinct, each_chunk, lay_chunks, levels_of, parts_of
from tidemark.llm.components import components
from tidemark.llm.scratch import Scratch
from tidemark.llm.text import Words, lay, lower_ascii, mix, rolling

SHINGLE = 5
PERCENT = 80
# The k a document may choose from.
MATCHES = (1, 2, 4, 8, 16)


def shingles(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first): each text's distinct shingles in ascending order; those of text i are hash[first[i]:first[i+1]]."""
    words = Words(lower_ascii(data), starts)
    keys, start = words.windows(size)
    owner = np.searchsorted(words.first, start, "right") - 1
    n = words.counts()
    short = np.flatnonzero((n > 0) & (n < size))
    whole = np.array([_whole(words.hash[words.first[i] : words.first[i + 1]]) for i in short.tolist()], np.uint64)
    keys, owner = np.concatenate([keys, whole]), np.concatenate([owner, short])
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return keys[new], np.searchsorted(owner[new], np.arange(len(starts)))


def shingles_of(table: pa.Table, text: str, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(hash, counts) of a chunk's table, worked out slice by slice: the texts' distinct shingles, and how many each text of a slice has."""
    keys, counts = [np.zeros(0, np.uint64)], []
    for part in parts_of(table.select([text]), text):
        own, first = shingles(*lay(part.column(text)), size)
        keys.append(own)
        counts.append(np.diff(first).astype(np.int64))
    return np.concatenate(keys), counts


def _whole(words: np.ndarray) -> np.uint64:
    return mix(rolling(words, len(words)) + np.uint64(len(words)))[0]


def digest(keys: np.ndarray) -> bytes:
    """128 bits of a set of hashes."""
    with np.errstate(over="ignore"):
        a, b = mix(keys).sum(dtype=np.uint64), mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return a.tobytes() + b.tobytes()


def least(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-percent * n // 100)


def prefix(keys: np.ndarray, df: np.ndarray, percent: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(k, shingles, positions): the chosen k, and the prefix's shingles that any other document holds, with their positions."""
    n = len(keys)
    order = np.lexsort((keys, df))
    base = n - int(least(n, percent))
    others = np.cumsum(count_of(df[order]) - 1)
    choices = [k for k in MATCHES if base + k <= n]
    lists = np.array([others[base + k - 1] for k in choices])
    cost = lists * (1 + n / 8 / np.array(choices))
    k = choices[int(np.argmin(cost))]
    place = np.flatnonzero(df[order[: base + k]] > 1)
    return k, keys[order[place]], place


def heads_of(docs: DataFrame, key: str, text: str, size: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The chunks, and per document: loc, key, n, node (the digest of its set), k, prefix shingles and positions, and its set.

    Prefix and set are null where no other document can link to this one by its prefix.
    """

    def extract(row: dict) -> tuple[np.ndarray, None]:
        keys, _ = shingles_of(as_table(row["docs"]), text, size)
        return keys & np.uint64(~0xFFFF & (1 << 64) - 1), None

    def work(row: dict) -> Iterator[pa.Table]:
        table = as_table(row["docs"])
        keys, counts = shingles_of(table, text, size)
        ids = table.column(key)
        del table
        place = distinct(keys & np.uint64(~0xFFFF & (1 << 64) - 1), None)[3]
        df = levels_of(row["levels"])[place] if len(keys) else np.zeros(0, np.uint8)
        del place
        at = done = 0
        for sizes in counts:
            nodes, ks, tokens, places, sets = [], [], [], [], []
            for n in sizes.tolist():
                own, rare = keys[done : done + n], df[done : done + n]
                done += n
                nodes.append(digest(own) if n else None)
                # too small to link to any set but its equal
                k, t, p = prefix(own, rare, percent) if 100 * n >= percent * (n + 1) else (0, (), ())
                found = len(t) > 0
                ks.append(k)
                tokens.append(t.view(np.int64) if found else None)
                places.append(p if found else None)
                sets.append(own.tobytes() if found else None)
            locs = [f"{row['chunk']}:{at + i}" for i in range(len(sizes))]
            yield pa.table(
                {"loc": locs, key: ids.slice(at, len(sizes)), "n": sizes, "node": pa.array(nodes, pa.binary()),
                 "k": pa.array(ks, pa.int32()), "tokens": pa.array(tokens, pa.list_(pa.int64())),
                 "places": pa.array(places, pa.list_(pa.int64())), "items": pa.array(sets, pa.binary())}
            )
            at += len(sizes)

    chunks = lay_chunks(docs, text)
    kind = docs.schema[key].dataType.simpleString()
    counted = count_hashes(chunks.select("chunk", "n_bytes", "docs"), extract, 6.0, "levels")
    schema = f"loc string, `{key}` {kind}, n long, node binary, k int, tokens array<long>, places array<long>, items binary"
    return chunks, scratch.lay(each_chunk(counted, work, schema), "heads")


def overlap_needed(a: Column, b: Column, percent: int) -> Column:
    return F.ceil(percent * (a + b) / F.lit(100 + percent))


def verified(pairs: DataFrame, heads: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b, a_loc, b_loc) that share as many prefix shingles as both chose, then compared exactly."""
    wanted = pairs.select(F.col("a_loc").alias("loc")).union(pairs.select("b_loc")).distinct()
    sets = scratch.lay(heads.select("loc", "items", "tokens", "k").join(wanted, "loc", "left_semi"), "sets")

    def compare(batches):
        for batch in batches:
            left, right = batch.column("a_items").to_pylist(), batch.column("b_items").to_pylist()
            good = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one, two = (sets.select(*[F.col(c).alias(f"{s}_{c}") for c in sets.columns]) for s in "ab")
    both = pairs.join(one, "a_loc").join(two, "b_loc")
    both = both.filter(F.size(F.array_intersect("a_tokens", "b_tokens")) >= F.least("a_k", "b_k"))
    return both.select("a", "b", "a_items", "b_items").mapInArrow(compare, "a binary, b binary")


def fits(percent: int) -> Column:
    """Sizes, and the places of a shared shingle if it is the first that the two share, leave room for a link."""
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    room = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    return (100 * small >= percent * large) & (room >= overlap_needed(F.col("a_n"), F.col("b_n"), percent))


def pairs_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("a", "b").agg(F.min("a_loc").alias("a_loc"), F.min("b_loc").alias("b_loc"))


def links_of(heads: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between different sets, enough of them to connect all that any links connect."""
    posted = heads.filter("tokens is not null").select(
        "node", "loc", "n", F.explode(F.arrays_zip("tokens", "places")).alias("p")
    )
    # copies of a document meet here before anything is joined
    posted = posted.groupBy(F.col("p.tokens").alias("token"), "node").agg(
        F.min("loc").alias("loc"), F.min("n").alias("n"), F.min("p.places").alias("place")
    )
    posted = scratch.lay(posted, "lists")
    middle = posted.groupBy("token").agg(
        F.min(F.struct("place", "n", "node", "loc")).alias("c"), F.count("*").alias("size")
    )
    lists = scratch.lay(posted.join(middle.filter("size > 1").drop("size"), "token"), "lists")
    cells = ["node", "loc", "n", "place"]
    star = lists.filter(F.col("node") != F.col("c.node")).select(
        *[F.col(f"c.{x}").alias("a" if x == "node" else f"a_{x}") for x in cells],
        *[F.col(x).alias("b" if x == "node" else f"b_{x}") for x in cells],
    )
    first = scratch.lay(pairs_of(star.filter(fits(percent))), "pairs")
    links = scratch.lay(verified(first, heads, percent, scratch), "links")

    # what is left are links between parts that share a list; lists of one part are done
    part = components(links)
    lists = lists.drop("c").join(part, "node", "left").withColumn("part", F.coalesce("part", "node"))
    open_lists = lists.groupBy("token").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.min("node").alias("a")).filter("lo != hi")
    open_lists = scratch.lay(lists.join(open_lists.select("token", "a"), "token").select("a", "node", "loc", "part"), "lists")
    family = components(open_lists.select("a", F.col("node").alias("b")).filter("a != b").distinct()).withColumnRenamed("part", "family")
    nodes = open_lists.groupBy("node").agg(F.min("loc").alias("loc"), F.min("part").alias("part")).join(family, "node")
    members = scratch.lay(nodes.join(heads.select("loc", "n", "k", "tokens", "items"), "loc"), "members")

    def likely(block: pa.Table):
        tokens = block.column("tokens").combine_chunks()
        first = np.concatenate([[0], np.cumsum(pc.list_value_length(tokens).to_numpy(zero_copy_only=False))])
        ids = np.unique(tokens.flatten().to_numpy(), return_inverse=True)[1]
        k = block.column("k").to_numpy()
        return lambda a, b: shared_counts(ids, first, a, b) >= np.minimum(k[a], k[b])

    return links.union(link_families(members, percent, likely))


def parted(docs: DataFrame, key: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(chunks, rows): rows have loc, key, n_shingles, component_id and part, the smallest node of the component.

    The part names the component itself: component_id does not, as keys may be null or repeat.
    """
    work, kept = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    chunks, heads = heads_of(docs, key, text, size, percent, work)
    label = components(work.lay(links_of(heads, percent, work), "links"))
    heads = kept.lay(heads.select("loc", key, "n", "node"), "nodes")
    work.clear()
    classes = heads.filter("n > 0").groupBy("node").agg(F.min(key).alias("least"))
    classes = classes.join(label, "node", "left").withColumn("part", F.coalesce("part", "node"))
    groups = classes.groupBy("part").agg(F.min("least").alias("component_id"))
    found = classes.join(groups, "part").select("node", "component_id", "part")
    rows = heads.select("loc", key, F.col("n").alias("n_shingles"), "node").join(found, "node", "left")
    own = F.when(F.col("n_shingles") == 0, F.col(key)).otherwise(F.col("component_id"))
    return chunks, rows.select("loc", key, "n_shingles", own.alias("component_id"), "part")


def join_by_jaccard(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """(chunks, rows): rows have loc, key, n_shingles and component_id, the smallest key reachable by links, itself included."""
    chunks, rows = parted(docs, key, text, size, percent)
    return chunks, rows.drop("part")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """`docs` with one row of each component, that of the smallest key; rows without words all stay."""
    chunks, rows = parted(docs, key, text, size, percent)
    worded = rows.filter("n_shingles > 0").groupBy("part").agg(F.min(F.struct(key, "loc")).alias("m")).select("m.loc")
    kept = worded.union(rows.filter("n_shingles = 0").select("loc")).select(F.split("loc", ":").alias("at"))
    kept = kept.groupBy(F.col("at")[0].alias("chunk")).agg(F.collect_list(F.col("at")[1].cast("int")).alias("rows"))
    names, schema = docs.columns, to_arrow_schema(docs.schema)

    def work(row: dict) -> pa.Table:
        table = as_table(row["docs"]).take(pa.array(sorted(row["rows"]), pa.int64()))
        return pa.Table.from_arrays([table.column(c).cast(f.type) for c, f in zip(names, schema)], schema=schema)

    return each_chunk(chunks.join(kept, "chunk"), work, docs.schema)
