"""Language by interpolated Kneser-Ney character models, kept in sorted hash arrays.

Characters become 63 classes of letters and one of everything between words; every run of four is counted per language over all
training rows, in Spark. From these counts come, per language, discounted four-grams and the continuation counts of shorter ones.
A text's language is that of the lowest cross-entropy per character. A softmax over the differences, whose sharpness is fitted on
a bounded sample of training rows (`SAMPLE`), gives the score; texts far beyond the entropies usual in their language, by mean and
deviation over all training rows, are marked rejected.

Null texts and texts without a letter are `und` with score 0, as is every text if nothing can be learnt. Equal entropies go to the
name that sorts first.
"""

from __future__ import annotations

import pickle
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import small_batches
from tidemark.llm.linear import bounded, fold
from tidemark.llm.text import mix

ORDER = 4
CLASSES = 64
MOST_LANGUAGES = 250
# Training rows that the score is calibrated on.
SAMPLE = 1000
# Standard deviations above a language's usual entropy from which a text is rejected.
FAR = 6.0
# Steps per nat in which entropies are summed.
STEPS = 1 << 16
UND = "und"
CODES = 1 << 24


def letter_classes() -> np.ndarray:
    """Class by code point: 1-26 for a-z, 27-63 shared by all other letters, 0 for what is no letter."""
    out = np.zeros(0x32400, np.uint8)
    for c in range(0x80, len(out)):
        if unicodedata.category(chr(c))[0] == "L":
            out[c] = 27 + c % 37
    out[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return out


def grams(texts: list[str | None], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, first, lettered): the four-grams of each text, code[first[i]:first[i+1]] those of text i; whether it has a letter."""
    own = [(t or "").lower() for t in texts]
    points = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = np.where(points < len(classes), classes[np.minimum(points, len(classes) - 1)], 0).astype(np.uint8)
    cuts = np.concatenate([[0], np.cumsum([len(t) for t in own])]).astype(np.int64)
    # three blanks before each text, one after; of other blanks in a row only one counts
    at = np.arange(len(kinds)) + np.repeat(3 + 4 * np.arange(len(own)), np.diff(cuts))
    stream = np.zeros(len(kinds) + 4 * len(own), np.uint8)
    stream[at] = kinds
    begin = cuts[:-1] + 4 * np.arange(len(own))
    keep = np.ones(len(stream), bool)
    keep[1:] = (stream[1:] > 0) | (stream[:-1] > 0)
    head = begin[:, None] + np.arange(3)
    keep[head.ravel()] = True
    keep[begin + 3] |= False
    counted = keep.copy()
    counted[head.ravel()] = False
    # the texts' own first blanks follow blanks and are dropped with them
    place = np.cumsum(keep) - 1
    s = stream[keep].astype(np.uint32)
    code = np.zeros(len(s), np.uint32)
    for back in range(ORDER):
        code[back:] |= s[: len(s) - back] << np.uint32(6 * back)
    code = code[place[counted]]
    total = np.concatenate([[0], np.cumsum(counted)])
    edges = np.append(begin, len(stream))
    letters = np.concatenate([[0], np.cumsum(stream > 0)])
    return code, total[edges], np.diff(letters[edges]) > 0


def count_grams(rows: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language, code, count) over rows (text, lang); at most CODES for each language whatever the rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, number = letter_classes(), {n: i for i, n in enumerate(names)}
        keys, times = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for batch in batches:
            code, first, _ = grams(batch.column("text").to_pylist(), classes)
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.uint32)
            new = np.sort(code | (np.repeat(lang, np.diff(first)) << np.uint32(24)))
            edge = np.flatnonzero(np.append(True, new[1:] != new[:-1])) if len(new) else np.zeros(0, np.int64)
            both = np.concatenate([keys, new[edge]])
            keys, back = np.unique(both, return_inverse=True)
            times = np.bincount(back, np.concatenate([times, np.diff(edge, append=len(new))]), len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys.astype(np.int64)), "n": pa.array(times)})

    got = rows.mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").toArrow()
    keys = got.column("key").to_numpy()
    return keys >> 24, keys & (CODES - 1), got.column("n").to_numpy().astype(np.float64)


class Table:
    """Values by language and n-gram in arrays sorted by a hash of both."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys.astype(np.uint64))
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order].astype(np.float32)

    def get(self, keys: np.ndarray, otherwise: float) -> np.ndarray:
        out = np.full(len(keys), otherwise, np.float32)
        if len(self.hashes):
            hashes = mix(keys.astype(np.uint64))
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            found = self.hashes[at] == hashes
            out[found] = self.values[at[found]]
        return out


class Model:
    """Per order: the discounted share of each n-gram after its context, and what each context leaves to the shorter one."""

    def __init__(self, lang: np.ndarray, code: np.ndarray, count: np.ndarray, names: list[str]):
        self.names, self.grams, self.contexts = names, [], []
        for order in range(ORDER, 0, -1):
            # keys hold the order's classes, the language above them
            mask = (1 << (6 * order)) - 1
            key = (lang.astype(np.int64) << 24) | (code & mask)
            if order < ORDER:
                # how many different classes stand before it
                key, inverse = np.unique(key, return_inverse=True)
                count = np.bincount(inverse).astype(np.float64)
                lang, code = key >> 24, key & (CODES - 1)
            context, back = np.unique((lang << 24) | (code >> 6), return_inverse=True)
            total, kinds = np.bincount(back, count), np.bincount(back)
            once, twice = float((count == 1).sum()), float((count == 2).sum())
            discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
            self.grams.append(Table(key, np.maximum(count - discount, 0) / total[back]))
            self.contexts.append(Table(context, discount * kinds / total))

    def log_chances(self, code: np.ndarray) -> np.ndarray:
        """Natural logarithm per four-gram and language."""
        out = np.empty((len(code), len(self.names)), np.float32)
        code = code.astype(np.int64)
        for number in range(len(self.names)):
            chance = np.full(len(code), 1 / CLASSES, np.float32)
            for order in range(1, ORDER + 1):
                own = code & ((1 << (6 * order)) - 1)
                upper = number << 24
                hit = self.grams[ORDER - order].get(own | upper, 0.0)
                chance = hit + self.contexts[ORDER - order].get((own >> 6) | upper, 1.0) * chance
            out[:, number] = np.log(chance)
        return out


class Scorer:
    """Entropies of texts; each four-gram is looked up once per task."""

    def __init__(self, model: Model):
        self.model, self.classes = model, letter_classes()
        self.place = np.full(CODES, -1, np.int32)
        self.logs = np.zeros((0, len(model.names)), np.float32)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        code, first, lettered = grams(texts, self.classes)
        at = self.place[code]
        new = np.unique(code[at < 0])
        if len(new):
            self.place[new] = len(self.logs) + np.arange(len(new), dtype=np.int32)
            self.logs = np.concatenate([self.logs, self.model.log_chances(new)])
            at = self.place[code]
        out = np.empty((len(texts), self.logs.shape[1]))
        for number in range(out.shape[1]):
            run = np.concatenate([[0.0], np.cumsum(self.logs[:, number][at], dtype=np.float64)])
            out[:, number] = -np.diff(run[first]) / np.maximum(np.diff(first), 1)
        return out, lettered


def certainty(entropies: np.ndarray, sharpness: float) -> np.ndarray:
    gap = np.exp(-sharpness * (entropies - entropies.min(axis=1, keepdims=True)))
    return gap / gap.sum(axis=1, keepdims=True)


def limits_of(rows: DataFrame, model: Model) -> np.ndarray:
    """The entropy from which each language rejects, by mean and deviation over all rows (text, lang) that hold letters."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, number = Scorer(model), {x: i for i, x in enumerate(model.names)}
        for batch in batches:
            found, lettered = scorer.entropies(batch.column("text").to_pylist())
            truth = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)[lettered]
            own = np.rint(found[lettered, truth] * STEPS).astype(np.int64)
            langs = np.unique(truth)
            parts = [own[truth == i] for i in langs]
            sums = ([len(x) for x in parts], [int(x.sum()) for x in parts], [int((x * x).sum()) for x in parts])
            yield pa.RecordBatch.from_pydict(dict(zip(("lang", "n", "s", "q"), map(pa.array, (langs, *sums), [pa.int64()] * 4))))

    got = rows.select("text", "lang").mapInArrow(work, "lang long, n long, s long, q long").groupBy("lang")
    # whole numbers, so that the limits do not depend on the order in which tasks end
    got = got.agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in "nsq"])
    limits = np.full(len(model.names), np.inf)
    for lang, n, s, q in [(r.lang, int(r.n), int(r.s), int(r.q)) for r in got.collect()]:
        limits[lang] = (s / n + FAR * (n * q - s * s) ** 0.5 / n) / STEPS + 0.5
    return limits


def train(rows: DataFrame, sample: int) -> tuple[Model, float, np.ndarray] | None:
    """From rows (key, text, lang): the model, the sharpness of its scores, and the entropy from which each language rejects."""
    names = [r.lang for r in rows.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if not names:
        return None
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    model = Model(*count_grams(rows.select("text", "lang"), names), names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found, lettered = scorer.entropies(batch.column("text").to_pylist())
            own = pa.array([x.tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "e": own}).filter(pa.array(lettered))

    limits = limits_of(rows, model)
    got = bounded(rows, sample).mapInArrow(work, "lang string, e binary").toArrow()
    if not got.num_rows:
        return model, 1.0, limits
    found = np.array([np.frombuffer(e) for e in got.column("e").to_pylist()])
    truth = np.array([names.index(x) for x in got.column("lang").to_pylist()])
    loss = {s: -np.log(certainty(found, s)[np.arange(len(truth)), truth] + 1e-12).mean() for s in 2.0 ** np.arange(0, 8)}
    return model, min(loss, key=loss.get), limits


def identify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, held_out: int = 1, sample: int = SAMPLE
) -> DataFrame:
    """Per document: key, held_out (its fold taught nothing), lang_pred, score and rejected."""
    small_batches(docs.sparkSession)
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & (fold(key, folds) != held_out))
    learnt = train(rows.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")), sample)
    # by value, as workers need not have this package
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(learnt))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(shared.value)
        scorer = Scorer(known[0]) if known else None
        for batch in batches:
            names, score, rejected = [UND] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            if scorer:
                _, sharpness, limits = known
                found, lettered = scorer.entropies(batch.column(text).to_pylist())
                best = found.argmin(axis=1)
                names = [scorer.model.names[b] if ok else UND for b, ok in zip(best.tolist(), lettered.tolist())]
                score = np.where(lettered, certainty(found, sharpness).max(axis=1), 0.0)
                rejected = lettered & (found.min(axis=1) > limits[best])
            yield pa.RecordBatch.from_pydict(
                {key: batch.column(key), "held_out": batch.column("held_out"), "lang_pred": pa.array(names, pa.string()),
                 "score": pa.array(score), "rejected": pa.array(rejected)}
            )

    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(key, text, (fold(key, folds) == held_out).alias("held_out"))
    return own.mapInArrow(work, f"`{key}` {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
