import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.corpus import awkward, frame
from tests.oracle import compare, connect, fetch
from tidemark.llm import search
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.search import mine, rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items):
    terms = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(x for own in terms for x in set(own))
    out = []
    for item, text in items:
        asked, scored = set(TERM.findall((text or "").translate(LOWER))), []
        for (key, _), own in zip(docs, terms):
            tf, score = Counter(own), 0
            for x in asked & set(own):
                m = 10 + 90 * len(own) * n_docs // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, i, x[3], -x[0]) for i, x in enumerate(sorted(scored, key=lambda x: x[:3])[:10], 1)]
    return sorted(out, key=str)


def ask(spark, docs, items):
    queries = spark.createDataFrame([(k, t, 0, "x") for k, t in items], "item_id long, text string, score int, key string")
    got = rank_documents(frame(spark, docs), queries)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def questions(docs, seed=3):
    """Items that share runs of words, and odd ones: null, empty, unknown words only, repeated rows and keys, a very common word."""
    rng = random.Random(seed)
    words = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    words = [w for w in words if len(w) > 20]
    runs = [rng.choice(words)[:8] for _ in range(6)]
    items = [(i, " ".join(sum(rng.sample(runs, 3), []) + rng.choice(words)[8:14])) for i in range(30)]
    return [*items, (40, None), (41, ""), (42, "qqq zzz"), (None, "a"), (3, items[3][1]), (43, "the a The, Ba-lo")]


@pytest.mark.parametrize("rows", [awkward(), awkward(8), [(i, "a b") for i in range(40)] + [(None, "a c"), (None, "a b"), (7, "b")]])
def test_against_brute_force(spark, rows):
    items = questions(awkward())
    assert ask(spark, rows, items) == brute(rows, items)


def test_many_blocks_and_readings(spark, monkeypatch):
    """Blocks, readings, accumulators and candidates of a few only give the same ranks."""
    for name, bound in (("BLOCK_TERMS", 60), ("PLAN_BYTES", 4000), ("CELLS", 300), ("HELD", 50)):
        monkeypatch.setattr(search, name, bound)
    rows = awkward(2)
    items = questions(rows)
    assert ask(spark, rows, items) == brute(rows, items)


def test_empty_tables(spark):
    assert ask(spark, [], [(1, "a")]) == []
    assert ask(spark, [(1, "a")], []) == []
    assert ask(spark, [(1, None), (2, "")], [(1, "a"), (2, None)]) == []


def test_long_text(spark):
    rng = random.Random(4)
    rows = [(1, " ".join(f"w{rng.randint(0, 999)}" for _ in range(1_600_000))), (2, "w1 w2"), (3, "w3"), (4, "other")]
    assert ask(spark, rows, [(1, "w1 w3"), (2, "w7")]) == brute(rows, [(1, "w1 w3"), (2, "w7")])


def test_shared_sums_are_mined_once():
    rng = random.Random(1)
    common = rng.sample(range(1000), 30)
    sets = [sorted({*rng.sample(common, 20), *rng.sample(range(1000, 9000), 5)}) for _ in range(40)]
    terms, leaf, sums, nodes = mine(sets)
    leaves = int(leaf.max()) + 1
    rng_values = np.random.default_rng(0).integers(0, 1000, len(terms))
    value = np.bincount(leaf, rng_values).astype(np.int64).tolist()
    for x, y in sums:
        value.append(value[x] + value[y])
    of = dict(zip(terms.tolist(), rng_values.tolist()))
    assert [sum(value[x] for x in own) for own in nodes] == [sum(of[t] for t in own) for own in sets]
    # adding every term of every item takes twice as many steps
    assert leaves + len(sums) + sum(map(len, nodes)) < 0.75 * sum(map(len, sets))


def test_query_against_sql_and_brute_force(spark, small):
    got = QUERIES["op11_ranked_search"](spark, small)
    assert compare("op11", got.toArrow(), fetch(connect(small), ORACLES["op11_ranked_search"])) == []
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{small}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)
