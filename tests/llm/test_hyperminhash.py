import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import awkward, frame
from tests.llm.test_ngram_join import brute, families
from tidemark.llm import blocks, hyperminhash
from tidemark.llm.hyperminhash import chance, drop_near_duplicates, estimate, find_near_duplicates, same_registers, sketches
from tidemark.llm.queries import QUERIES
from tidemark.llm.text import mix


def near_limit(n=120, seed=4):
    """A family all of whose members differ a little too much, and two that do not."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(300)]
    texts = []
    for i in range(n):
        copy = list(base)
        for at in rng.sample(range(300), 5):
            copy[at] = f"v{i}x{at}"
        texts.append(copy)
    texts.append([*texts[0][:-1], "end"])
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def long_texts():
    rng = random.Random(8)
    words = [f"w{rng.randint(0, 9999)}" for _ in range(1_500_000)]
    other = list(words)
    other[1000] = "changed"
    return [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:700_000])), (4, "short one")]


@pytest.mark.parametrize("rows,size,percent", [(families(), 3, 85), (families(2), 3, 80), (awkward(), 3, 85), (awkward(6), 5, 80), (near_limit(), 3, 85)])
def test_against_brute_force(spark, rows, size, percent):
    got = find_near_duplicates(frame(spark, rows), size=size, percent=percent).collect()
    want = brute(rows, size, percent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_blocks_of_a_grid(spark, monkeypatch):
    """Families over many cells lose no link, and no block writes more links than it has rows."""
    monkeypatch.setattr(blocks, "CELL_ROWS", 7)
    for rows in (families(3), near_limit(40)):
        got = find_near_duplicates(frame(spark, rows), size=3, percent=85).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 85)


def test_only_open_families_move(spark, monkeypatch):
    """The block search gets the sets of families in several parts, from a table that was joined once."""
    search, seen = hyperminhash.link_families, []

    def watched(members, *rest):
        seen.append((members.groupBy("family").agg(F.count_distinct("part")).collect(), members._jdf.queryExecution().toString()))
        return search(members, *rest)

    monkeypatch.setattr(hyperminhash, "link_families", watched)
    base = " ".join(f"c{i}" for i in range(300))
    rows = [*near_limit(40), (500, base), (501, base + " more"), (502, base + " other end")]
    got = find_near_duplicates(frame(spark, rows), size=3, percent=85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 85)
    [(families_, plan)] = seen
    assert families_ and all(parts > 1 for _, parts in families_)
    assert "Join" not in plan


def test_long_texts(spark):
    got = find_near_duplicates(frame(spark, long_texts()), size=3, percent=85).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_empty_table_and_empty_texts(spark):
    assert find_near_duplicates(frame(spark, [])).collect() == []
    got = find_near_duplicates(frame(spark, [(1, None), (2, ""), (2, " "), (None, None)])).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 0, 1, True), (2, 0, 2, True), (2, 0, 2, True), (None, 0, None, True)]


def test_drop_keeps_columns(spark):
    rows = [*families(), (900, None), (901, "")]
    got = drop_near_duplicates(frame(spark, [*rows, rows[3]]), size=3, percent=85)
    assert got.columns == ["doc_id", "text", "lang", "n_words", "chunk"]
    assert sorted(r.doc_id for r in got.collect()) == sorted({c for _, _, c in brute(rows[:-2], 3, 85)}) + [900, 901]


@pytest.mark.parametrize("n,percent", [(7, 86), (40, 85), (300, 85), (5000, 85), (300, 50)])
def test_estimate_is_unbiased(n, percent):
    rng = np.random.default_rng(n)
    found, true = [], []
    for _ in range(60):
        both = round(n * percent / 100)
        items = mix(rng.integers(0, 1 << 62, 2 * n - both).astype(np.uint64))
        one, two = items[:n], np.concatenate([items[:both], items[n:]])
        regs = sketches(np.concatenate([one, two]), np.array([0, n, 2 * n]))
        found.append(float(estimate(same_registers(regs[:1], regs[1:]), np.array([n]), np.array([n]))[0]))
        true.append(both / (2 * n - both))
    assert abs(np.mean(found) - np.mean(true)) < 0.02


def test_registers_agree_by_chance_as_computed():
    rng = np.random.default_rng(1)
    regs = sketches(mix(rng.integers(0, 1 << 62, 400 * 3000).astype(np.uint64)), np.arange(401) * 3000)
    equal = same_registers(regs[:200], regs[200:]).sum() / (200 * hyperminhash.REGISTERS)
    want = float(chance(np.array([3000.0]), np.array([3000.0]))[0])
    assert 0.5 * want < equal < 2 * want


def test_query_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = QUERIES["op12_hyperminhash_near_dedup"](spark, small)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = [(*x, x[0] == x[2]) for x in brute(rows, 3, 85)]
    assert sorted(map(tuple, got.withColumn("kept", F.col("kept")).collect()), key=str) == want
