"""Toxicity by a factorization machine over hashed terms: linear weights plus pairwise interactions through latent factors.

Terms are a text's words, ASCII letters lowered, and their first four to six bytes, which stand for a word's forms; each counts
once a text. The machine is fitted on a bounded sample of labelled rows (`SAMPLE`): its rows are counted per hashed term and label,
and the terms that tell most about the label (`TERMS`) enter the machine. It scores every whole text.

Null and empty texts hold no terms and get the score of none. With no labels, or labels of one kind, every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import small_batches
from tidemark.llm.linear import Adam, bounded, fold, labelled, sigmoid
from tidemark.llm.text import Words, hash_spans, lay, lower_ascii, mix

SAMPLE = 10_000
BITS = 18
TERMS = 512
FACTORS = 8
ROUNDS = 300
PREFIXES = (4, 5, 6)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(owner, bucket): the distinct hashed terms of each text, in order of text."""
    data, starts = lay(texts)
    data = lower_ascii(data)
    letter = np.zeros(256, bool)
    letter[[*range(97, 123), *range(128, 256)]] = True
    words = Words(np.where(letter[data], data, np.uint8(32)), starts, hashed=False)
    owner = np.repeat(np.arange(len(starts) - 1), words.counts())
    found = [(owner, mix(hash_spans(words.data, words.begin, words.end)))]
    for n in PREFIXES:
        long = words.end - words.begin > n
        found.append((owner[long], mix(hash_spans(words.data, words.begin[long], words.begin[long] + n) + np.uint64(n << 32))))
    owner, hashes = (np.concatenate(x) for x in zip(*found))
    both = np.unique((owner.astype(np.int64) << BITS) | (hashes >> np.uint64(64 - BITS)).astype(np.int64))
    return both >> BITS, both & ((1 << BITS) - 1)


def telling(rows: DataFrame, count: int) -> np.ndarray:
    """The hashed terms whose share among label 1 differs most from that among label 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sizes = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            label = batch.column("label").to_numpy()
            owner, bucket = terms(batch.column("text"))
            for y in (0, 1):
                held[y] += np.bincount(bucket[label[owner] == y], minlength=1 << BITS)
            sizes += np.bincount(label, minlength=2)
        some = np.flatnonzero(held.sum(axis=0))
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(np.append(some, -1)), "zero": pa.array(np.append(held[0, some], sizes[0])), "one": pa.array(np.append(held[1, some], sizes[1]))}
        )

    counted = rows.mapInArrow(work, "bucket long, zero long, one long").groupBy("bucket").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one"))
    # no more rows than buckets
    got = counted.toArrow()
    bucket, zero, one = (got.column(c).to_numpy() for c in ("bucket", "zero", "one"))
    everything = bucket == -1
    n0, n1 = int(zero[everything].sum()), int(one[everything].sum())
    if not n0 or not n1:
        return np.zeros(0, np.int64)
    expected = (zero + one) * n1 / (n0 + n1)
    tells = np.abs(one - expected) / np.sqrt(expected * n0 / (n0 + n1) + 1)
    tells[everything] = -1
    return np.sort(bucket[np.lexsort((bucket, -tells))[: min(count, len(bucket) - 1)]])


class Machine:
    def __init__(self, chosen: np.ndarray):
        n = len(chosen)
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[chosen] = np.arange(n)
        self.bias, self.weights = np.zeros(1), np.zeros(n)
        self.factors = np.random.default_rng(11).normal(0, 0.05, (n, FACTORS))

    def score(self, owner: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        at = self.place[bucket]
        owner, at = owner[at >= 0], at[at >= 0]
        linear = np.bincount(owner, self.weights[at], n)
        pairs = np.zeros(n)
        for f in range(FACTORS):
            v = self.factors[at, f]
            pairs += np.bincount(owner, v, n) ** 2 - np.bincount(owner, v * v, n)
        return sigmoid(self.bias + linear + pairs / 2)

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        steps = Adam([self.bias, self.weights, self.factors], 0.02)
        self.bias[:] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        for _ in range(ROUNDS):
            sums = x @ self.factors
            raw = self.bias + x @ self.weights + ((sums**2) - x @ self.factors**2).sum(axis=1) / 2
            e = (sigmoid(raw) - y) / len(y)
            pull = x.T @ e
            factors = x.T @ (e[:, None] * sums) - pull[:, None] * self.factors
            steps.step([e.sum(keepdims=True), pull + 1e-5 * self.weights, factors + 1e-4 * self.factors])


def train(rows: DataFrame, sample: int) -> Machine | None:
    """From rows (key, text, label)."""
    rows = bounded(rows, sample)
    chosen = telling(rows, TERMS)
    if not len(chosen):
        return None
    machine = Machine(chosen)
    place = machine.place

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, bucket = terms(batch.column("text"))
            at = place[bucket]
            owner, at = owner[at >= 0], at[at >= 0]
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1)).tolist()
            lists = [at[a:b].astype("<u2").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_pydict({"label": batch.column("label"), "at": pa.array(lists, pa.binary())})

    got = rows.orderBy("key").mapInArrow(work, "label int, at binary").toArrow()
    y = got.column("label").to_numpy().astype(np.float64)
    x = np.zeros((len(y), len(chosen)), np.float32)
    for i, at in enumerate(got.column("at").to_pylist()):
        x[i, np.frombuffer(at, "<u2")] = 1
    machine.fit(x, y)
    return machine


def score_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5, held_out: int = 0,
    sample: int = SAMPLE,
) -> DataFrame:
    """Per document: key, held_out (its fold taught nothing), score and predicted."""
    small_batches(docs.sparkSession)
    rows = labelled(docs, labels, key, text, label).filter(fold("key", folds) != held_out)
    machine = train(rows, sample)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            score = machine.score(*terms(batch.column(text)), n) if machine else np.zeros(n)
            yield pa.RecordBatch.from_pydict(
                {key: batch.column(key), "held_out": batch.column("held_out"), "score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))}
            )

    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(key, text, (fold(key, folds) == held_out).alias("held_out"))
    return own.mapInArrow(work, f"`{key}` {kind}, held_out boolean, score double, predicted int")
