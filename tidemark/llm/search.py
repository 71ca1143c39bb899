"""Ranked lexical search of many queries at once: what queries share is worked out once per document, along a sharing DAG.

The items (queries) are cut into blocks of bounded size, and each block's term sets are mined for what they share: terms that occur
in the same items are one leaf; then the two nodes that stand together in most items become a node of their own, again and again, as
long as any two items share a pair. A plan holds these sums in order. Documents are read twice. The first time counts, over all
documents, those that hold each term, the terms, and the documents with terms. The second time lays, for few documents at a time, one
partial accumulator per leaf, adds them up along the DAG, each shared sum once, and takes each item's score from its last few nodes.
A task keeps each item's best documents only: a document below the score of as many others cannot be among them.

Scores are 64-bit integers, so that no order of summing changes them. Equal scores rank by ascending key, null keys last. Null texts
have no terms and never rank; so do items without terms. Each row is a document of its own, each row of items an item of its own,
repeated keys and null keys included.

Terms are compared by 64-bit hashes that also hold their length.
"""

from __future__ import annotations

import itertools
import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import slices, small_batches
from tidemark.llm.text import Words, lay, lower_ascii
from tidemark.session import written

# Bytes that no term holds.
GAPS = (*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))
BEST = 10
# Terms of all items of a block; a longer item is a block of its own.
BLOCK_TERMS = 20_000
# Bytes of plans that one reading of the documents serves; more plans take more readings.
PLAN_BYTES = 64 << 20
# Pairs of nodes are mined among the next so many in an item's order, in so many rounds; that limits what is shared, not what is found.
NEAR, ROUNDS = 64, 16
# Accumulators at a time, and candidates held before they are thinned.
CELLS, HELD = 1 << 21, 1 << 16


def terms_of(column: pa.Array) -> Words:
    data, starts = lay(column)
    return Words(lower_ascii(data), starts, gaps=GAPS)


def number_items(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, key, terms): a number for each row, and its distinct terms' hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), itertools.count()
        for batch in batches:
            words = terms_of(batch.column(text))
            terms = [np.unique(words.hash[a:b]).view(np.int64) for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | next(made) for _ in terms], pa.int64()), batch.column(key), pa.array(terms, pa.list_(pa.int64()))],
                names=["item", "key", "terms"],
            )

    kind = items.schema[key].dataType.simpleString()
    return written(items.select(key, text).mapInArrow(work, f"item long, key {kind}, terms array<long>"), "items")


def mine(sets: list[list[int]]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]], list[list[int]]]:
    """(terms in ascending order, leaf of each, sums (x, y), each item's last nodes). The first sum is the node after the last leaf."""
    holders: dict[int, list[int]] = {}
    for i, terms in enumerate(sets):
        for t in terms:
            holders.setdefault(t, []).append(i)
    leaves: dict[tuple[int, ...], int] = {}
    terms = sorted(holders)
    leaf = [leaves.setdefault(tuple(holders[t]), len(leaves)) for t in terms]
    nodes: list[set[int]] = [set() for _ in sets]
    for group, x in leaves.items():
        for i in group:
            nodes[i].add(x)
    weight = [len(group) for group in leaves]
    sums: list[tuple[int, int]] = []
    for _ in range(ROUNDS):
        together: Counter[tuple[int, int]] = Counter()
        for own in nodes:
            # what many items hold comes first, so that equal sets meet in equal order
            order = sorted((x for x in own if weight[x] > 1), key=lambda x: (-weight[x], x))
            for at, x in enumerate(order):
                together.update((x, y) if x < y else (y, x) for y in order[at + 1 : at + 1 + NEAR])
        taken: set[int] = set()
        fresh: dict[tuple[int, int], int] = {}
        for (x, y), n in sorted(together.items(), key=lambda p: (-p[1], p[0])):
            if n > 1 and x not in taken and y not in taken:
                taken |= {x, y}
                fresh[x, y] = len(leaves) + len(sums)
                sums.append((x, y))
                weight.append(0)
        if not fresh:
            break
        mate = {x: (y, z) for (x, y), z in fresh.items()}
        for own in nodes:
            for x in [x for x in own if x in mate]:
                y, z = mate[x]
                if y in own:
                    own -= {x, y}
                    own.add(z)
                    weight[z] += 1
                    weight[x] -= 1
                    weight[y] -= 1
    return np.array(terms, np.int64), np.array(leaf, np.int64), sums, [sorted(x) for x in nodes]


def plans_of(items: DataFrame) -> DataFrame:
    """(block, plan, size) for all items that have terms."""
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = total // BLOCK_TERMS + 1

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("item")
        terms, leaf, sums, nodes = mine(table.column("terms").to_pylist())
        plan = {"terms": terms, "leaf": leaf, "sums": sums, "nodes": nodes, "items": table.column("item").to_numpy()}
        raw = pickle.dumps(plan)
        return pa.table({"block": table.column("block")[:1], "plan": pa.array([raw], pa.binary()), "size": pa.array([len(raw)], pa.int64())})

    blocked = items.filter(F.size("terms") > 0).select("item", "terms", F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"))
    return written(blocked.groupBy("block").applyInArrow(work, "block long, plan binary, size long"), "plans")


class Vocabulary:
    """Finds the places of words among ascending terms."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms.view(np.uint64))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.terms >> np.uint64(44)).astype(np.int64)] = True

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(document, place) of all words that are terms."""
        at = np.flatnonzero(self.maybe[(words.hash >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.terms, words.hash[at]), len(self.terms) - 1)
        hit = self.terms[place] == words.hash[at] if len(self.terms) else np.zeros(0, bool)
        at, place = at[hit], place[hit]
        return np.searchsorted(words.first, at, "right") - 1, place


def corpus_counts(docs: DataFrame, text: str, terms: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(documents with terms, terms of all documents, documents that hold each of `terms`, which ascend as unsigned numbers)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(terms)
        held, documents, length = np.zeros(len(terms), np.int64), 0, 0
        for batch in (s for whole in batches for s in slices(whole, text)):
            words = terms_of(batch.column(text))
            doc, place = vocabulary.find(words)
            if len(terms):
                held += np.bincount(np.unique(doc * len(terms) + place) % len(terms), minlength=len(terms))
            documents, length = documents + int((words.counts() > 0).sum()), length + len(words.begin)
        full = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict(
            {"place": pa.array([-2, -1, *full.tolist()], pa.int64()), "n": pa.array([documents, length, *held[full].tolist()], pa.int64())}
        )

    counted = docs.select(text).mapInArrow(work, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(counted.column("place").to_pylist(), counted.column("n").to_pylist()))
    return found.get(-2, 0), found.get(-1, 0), np.array([found.get(i, 0) for i in range(len(terms))], np.int64)


class Plan:
    """A block's plan with its terms' weights."""

    def __init__(self, raw: bytes, weight_of: dict[int, int]):
        plan = pickle.loads(raw)
        order = np.argsort(plan["terms"].view(np.uint64))
        self.vocabulary = Vocabulary(plan["terms"])
        self.leaf = plan["leaf"][order]
        self.weight = np.array([weight_of[t] for t in plan["terms"][order].tolist()], np.int64)
        self.leaves = int(self.leaf.max()) + 1 if len(self.leaf) else 0
        self.sums, self.items = plan["sums"], plan["items"]
        self.nodes = [np.array(x, np.int64) for x in plan["nodes"]]
        self.floor = np.ones(len(self.items), np.int64)

    def scores(self, words: Words, m: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first document, scores by item and document) for few documents at a time."""
        doc, place = self.vocabulary.find(words)
        entry, times = np.unique(doc * len(self.leaf) + place, return_counts=True)
        doc, place = entry // len(self.leaf), entry % len(self.leaf)
        part = self.weight[place] * (1_000_000_000 * times // (1000 * times + 8 * m[doc]))
        nodes = self.leaves + len(self.sums)
        step = max(1, CELLS // nodes)
        for at in range(0, len(m), step):
            a, b = np.searchsorted(doc, [at, at + step])
            partial = np.zeros((nodes, min(step, len(m) - at)), np.int64)
            np.add.at(partial, (self.leaf[place[a:b]], doc[a:b] - at), part[a:b])
            for z, (x, y) in enumerate(self.sums, self.leaves):
                np.add(partial[x], partial[y], out=partial[z])
            yield at, np.stack([partial[own].sum(axis=0) for own in self.nodes])

    def best(self, words: Words, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item's place, document, score) of all that may be among an item's best, ties included."""
        found = []
        for at, scores in self.scores(words, m):
            if scores.shape[1] >= BEST:
                self.floor = np.maximum(self.floor, np.partition(scores, -BEST, axis=1)[:, -BEST])
            item, doc = np.nonzero(scores >= self.floor[:, None])
            found.append((item, doc + at, scores[item, doc]))
        return tuple(np.concatenate(x) for x in zip(*found))


def thinned(held: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Each item's best rows; and the items that have all of theirs, with the score of the last."""
    held = held.sort_by([("item", "ascending"), ("score", "descending"), ("key", "ascending")])
    item, score = held.column("item").to_numpy(), held.column("score").to_numpy()
    head = np.flatnonzero(np.diff(item, prepend=-1))
    rank = np.arange(len(item)) - np.repeat(head, np.diff(head, append=len(item)))
    last = np.flatnonzero(rank == BEST - 1)
    return held.filter(pa.array(rank < BEST)), item[last], score[last]


def rank_documents(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(item_key, rank, key, score): each item's BEST documents of the highest scores above 0."""
    spark = docs.sparkSession
    small_batches(spark)
    items = number_items(items, item_key, item_text)
    plans = plans_of(items)
    sizes = sorted(tuple(r) for r in plans.select("block", "size").collect())
    groups: list[list[int]] = []
    room = 0
    for block, size in sizes:
        if not groups or size > room:
            groups.append([])
            room = PLAN_BYTES
        groups[-1].append(block)
        room -= size
    kind = docs.schema[key].dataType.simpleString()
    schema = f"item long, key {kind}, score long"
    found = [spark.createDataFrame([], schema)]
    for group in groups:
        raw = [r.plan for r in plans.filter(F.col("block").isin(group)).select("plan").collect()]
        found.append(_rank(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), raw, schema))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key")))
    best = rows.withColumn("rank", rank).filter(F.col("rank") <= BEST)
    names = items.select("item", F.col("key").alias("name"))
    return best.join(names, "item").select(F.col("name").alias(item_key), "rank", F.col("key").alias(key), "score")


def _rank(docs: DataFrame, plans: list[bytes], schema: str) -> DataFrame:
    """Rows (item, key, score): of each task, each item's best."""
    terms = np.unique(np.concatenate([pickle.loads(p)["terms"] for p in plans]).view(np.uint64))
    documents, length, held = corpus_counts(docs, "text", terms)
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()]
    weight_of = dict(zip(terms.view(np.int64).tolist(), weights))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Plan(p, weight_of) for p in plans]
        empty = np.zeros(0, np.int64)
        held: list[pa.Table | None] = [None] * len(own)
        for batch in (s for whole in batches for s in slices(whole, "text")):
            words = terms_of(batch.column("text"))
            m = np.array([10 + 90 * n * documents // length for n in words.counts().tolist()] if length else empty, np.int64)
            for k, plan in enumerate(own):
                item, doc, score = plan.best(words, m) if batch.num_rows and length else (empty, empty, empty)
                more = pa.table({"item": item, "key": batch.column("key").take(pa.array(doc)), "score": score})
                held[k] = more if held[k] is None else pa.concat_tables([held[k], more])
                if held[k].num_rows > HELD:
                    held[k], full, floor = thinned(held[k])
                    plan.floor[full] = np.maximum(plan.floor[full], floor)
        for plan, rows in zip(own, held):
            if rows is not None and rows.num_rows:
                rows = thinned(rows)[0]
                rows = rows.set_column(0, "item", pa.array(plan.items[rows.column("item").to_numpy()], pa.int64()))
                yield from rows.combine_chunks().to_batches()

    return docs.mapInArrow(work, schema)
