"""Quality rules: base counts with fixed limits, then a calibrated logistic regression over hashed word and character n-grams.

Features are shares: of a text's words and word pairs, and of its byte trigrams, that fall into each hashed bucket. A linear score
is then the mean weight of a text's n-grams, so texts are scored in Arrow batches by looking weights up, without feature vectors.
The regression is fitted on a bounded sample of labelled rows (`SAMPLE`); a fifth of it is held back to calibrate the score to
probabilities by Platt's method. Everything else works on all rows.

Null and empty texts have no words and fail the base. With no labels, or labels of one kind, the method accepts all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.chunks import slices, small_batches
from tidemark.llm.linear import Adam, bounded, labelled, sigmoid
from tidemark.llm.text import Words, covered, lay, mix, rolling

# Labelled rows that the regression is fitted on.
SAMPLE = 3000
BUCKETS = 4096
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
# Probability of good quality from which a text is kept.
THRESHOLD = 0.3
# Passes over the fitted rows, and rows in each step.
ROUNDS = 60
STEP_ROWS = 512
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


def base_counts(texts: pa.Array) -> tuple[dict[str, np.ndarray], Words]:
    data, starts = lay(texts)
    words = Words(data, starts)
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[starts])
    n = words.counts().astype(np.int64)
    symbol, char = np.zeros(256, bool), np.ones(256, bool)
    symbol[list(SYMBOLS)] = True
    char[[*range(0x80, 0xC0), 0x20, *range(0x09, 0x0E)]] = False
    keys, start = words.windows(REPEAT_WINDOW)
    owner = np.searchsorted(words.first, start, "right").astype(np.uint64)
    _, back, times = np.unique(mix(keys ^ mix(owner)), return_inverse=True, return_counts=True)
    again = covered(start[times[back] > 1], REPEAT_WINDOW, len(words.begin))
    repeated = np.diff(np.concatenate([[0], np.cumsum(again)])[words.first])
    lines = []
    for text in texts.to_pylist():
        seen, more = set(), 0
        for line in (text or "").split("\n"):
            if line in seen:
                more += 1
            elif line.strip(" \t\n\x0b\x0c\r"):
                seen.add(line)
        lines.append(more)
    failed = (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)
    counts = {
        "n_words": n, "word_chars": total(char[data]), "n_symbols": total(symbol[data]),
        "n_dup_lines": np.array(lines, np.int64), "n_repeat_words": repeated, "base_failed": failed,
    }
    return counts, words


def features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, first) of each kind of n-gram, those of text i being bucket[first[i]:first[i+1]]: words, pairs, byte trigrams."""
    pairs, start = words.windows(2)
    grams = rolling(words.data.astype(np.uint64) + np.uint64(1), 3)
    # trigrams that begin in a text; the last may reach over its end by a line break
    first = np.minimum(words.starts, len(grams))
    cut = lambda x, k: ((x >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int32) + k * BUCKETS
    return [
        (cut(words.hash, 0), words.first), (cut(pairs, 1), np.searchsorted(start, words.first)), (cut(grams, 2), first),
    ]


def shares(words: Words) -> np.ndarray:
    """The dense feature rows of a few texts."""
    n = len(words.starts) - 1
    out = np.zeros((n, 3 * BUCKETS), np.float32)
    for bucket, first in features(words):
        size = np.diff(first)
        np.add.at(out, (np.repeat(np.arange(n), size), bucket[first[0] : first[-1]]), np.repeat(1 / np.maximum(size, 1), size))
    return out


def scores(words: Words, weights: np.ndarray) -> np.ndarray:
    total = np.zeros(len(words.starts) - 1)
    for bucket, first in features(words):
        run = np.concatenate([[0.0], np.cumsum(weights[bucket], dtype=np.float64)])
        total += np.diff(run[first]) / np.maximum(np.diff(first), 1)
    return total


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE) -> tuple[np.ndarray, float, float]:
    """(weights, slope, shift): probability = sigmoid(slope * score + shift)."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                dense = shares(Words(*lay(part.column("text"))))
                places = [np.flatnonzero(r) for r in dense]
                yield pa.RecordBatch.from_pydict(
                    {"label": part.column("label"), "places": pa.array([p.astype("<u2").tobytes() for p in places], pa.binary()),
                     "values": pa.array([r[p].astype("<f4").tobytes() for r, p in zip(dense, places)], pa.binary())}
                )

    rows = bounded(labelled(docs, labels, key, text, label), sample)
    got = rows.orderBy("key").mapInArrow(work, "label int, places binary, values binary").toArrow()
    # a fifth, held back to calibrate, comes last; rows stay sparse, as the dense table would take 50 kB for each
    got = got.take(np.random.default_rng(7).permutation(got.num_rows))
    y = got.column("label").to_numpy().astype(np.float32)
    if len(np.unique(y)) < 2:
        return np.zeros(3 * BUCKETS, np.float32), 0.0, 30.0
    first = np.concatenate([[0], np.cumsum(pc.binary_length(got.column("places")).to_numpy() // 2)])
    places = np.frombuffer(b"".join(got.column("places").to_pylist()), "<u2")
    values = np.frombuffer(b"".join(got.column("values").to_pylist()), "<f4").copy()
    del got
    n = len(y) - len(y) // 5

    def column_sums(upto: int, power: int) -> np.ndarray:
        total = np.zeros(3 * BUCKETS)
        for at in range(0, upto, STEP_ROWS):
            part = slice(first[at], first[min(at + STEP_ROWS, upto)])
            total += np.bincount(places[part], values[part] ** power, 3 * BUCKETS)
        return total

    spread = np.sqrt(np.maximum(column_sums(n, 2) / n - (column_sums(n, 1) / n) ** 2, 0))
    scale = (1 / (spread + 1e-3)).astype(np.float32)
    for at in range(0, len(values), 1 << 20):
        values[at : at + (1 << 20)] *= scale[places[at : at + (1 << 20)]]

    def margins(a: int, b: int, w: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0.0], np.cumsum(values[first[a] : first[b]] * w[places[first[a] : first[b]]], dtype=np.float64)])
        return np.diff(run[first[a : b + 1] - first[a]])

    w, b = np.zeros(3 * BUCKETS), np.zeros(1)
    steps = Adam([w, b], 0.02)
    for _ in range(ROUNDS):
        for at in range(0, n, STEP_ROWS):
            end = min(at + STEP_ROWS, n)
            error = (sigmoid(margins(at, end, w) + b) - y[at:end]) / (end - at)
            part = slice(first[at], first[end])
            slope = np.bincount(places[part], values[part] * np.repeat(error, np.diff(first[at : end + 1])), 3 * BUCKETS)
            steps.step([slope + 1e-5 * w, error.sum(keepdims=True)])
    # Platt: the held-back rows' scores to probabilities, with his targets short of 0 and 1
    raw, truth = margins(n, len(y), w), y[n:]
    up, down = truth.sum(), (1 - truth).sum()
    target = np.where(truth > 0, (up + 1) / (up + 2), 1 / (down + 2))
    ab = np.array([1.0, float(b[0])])
    steps = Adam([ab], 0.05)
    for _ in range(1000):
        error = (sigmoid(ab[0] * raw + ab[1]) - target) / max(len(raw), 1)
        steps.step([np.array([error @ raw, error.sum()])])
    return (w * scale).astype(np.float32), float(max(ab[0], 0.0)), float(ab[1])


def judged(batch: pa.RecordBatch, text: str, model: tuple[np.ndarray, float, float], threshold: float) -> dict[str, np.ndarray]:
    counts, words = base_counts(batch.column(text))
    weights, slope, shift = model
    p = sigmoid(slope * scores(words, weights) + shift)
    return counts | {"quality": p, "kept": ~counts["base_failed"] & (p >= threshold)}


def report_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD
) -> DataFrame:
    """Per document: key, the base counts, base_failed, the probability `quality`, and kept."""
    model = fit(docs, labels, key, text, label)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, text)):
            yield pa.RecordBatch.from_pydict({key: batch.column(key)} | {k: pa.array(v) for k, v in judged(batch, text, model, threshold).items()})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(work, f"`{key}` {kind}, {BASE}, quality double, kept boolean")


def keep_good(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of `docs` that are kept, unchanged."""
    model = fit(docs, labels, key, text, label)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, text)):
            yield batch.filter(pa.array(judged(batch, text, model, threshold)["kept"]))

    return docs.mapInArrow(work, docs.schema)
