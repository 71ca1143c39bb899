import random
import re

import pytest

from tests.llm.corpus import awkward, frame
from tidemark.llm.components import components
from tidemark.llm.ngram_join import heads_of, join_by_jaccard, links_of, one_of_each
from tidemark.llm.queries import QUERIES
from tidemark.llm.scratch import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, size, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    lists = {}
    for i, s in enumerate(sets):
        for x in s:
            lists.setdefault(x, []).append(i)
    seen = set()
    for i, s in enumerate(sets):
        for j in {j for x in s for j in lists[x] if j > i} - seen:
            both = len(s & sets[j])
            if 100 * both >= percent * len(s | sets[j]):
                part[root(j)] = root(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return sorted(((k, len(s), least.get(root(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def families(seed=1):
    """Families of copies around originals with one to five words changed, some without the original; templates; chains."""
    rng = random.Random(seed)
    texts = []
    for f in range(6):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([30, 60, 150]))]
        if f % 2:
            texts.append(base)
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = f"v{rng.randint(0, 10**6)}"
            texts.append(copy)
    chain = [f"c{i}" for i in range(100)]
    for _ in range(20):
        texts.append(list(chain))
        chain[rng.randrange(100)] = f"d{rng.randint(0, 10**6)}"
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("rows,size,percent", [(families(), 3, 90), (families(2), 3, 80), (awkward(), 3, 90), (awkward(6), 5, 80)])
def test_against_brute_force(spark, rows, size, percent):
    got = join_by_jaccard(frame(spark, rows), size=size, percent=percent)[1].drop("loc").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, size, percent)


def test_a_family_below_the_limit_writes_no_pairs(spark):
    """Texts that all differ a little too much: nothing links, and what is written stays linear in the family."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(300)]
    texts = []
    for i in range(300):
        copy = list(base)
        for at in rng.sample(range(300), 4):
            copy[at] = f"v{i}x{at}"
        texts.append((i, " ".join(copy)))
    scratch = Scratch(spark)
    _, heads = heads_of(frame(spark, texts), "doc_id", "text", 3, 90, scratch)
    assert heads.filter("tokens is not null").count() > 200
    assert links_of(heads, 90, scratch).count() <= len(texts)
    got = join_by_jaccard(frame(spark, texts), size=3, percent=90)[1].drop("loc").collect()
    assert sorted(map(tuple, got), key=str) == brute(texts, 3, 90)


def test_empty_table(spark):
    assert join_by_jaccard(frame(spark, []))[1].collect() == []


def test_one_of_each_keeps_columns(spark):
    rows = families()
    docs = frame(spark, [*rows, rows[3], (900, None), (901, "")])
    got = one_of_each(docs, size=3, percent=90)
    assert got.schema == docs.schema
    kept = sorted(r.doc_id for r in got.collect())
    assert kept == sorted({c for _, _, c in brute(rows, 3, 90)}) + [900, 901]


def test_one_of_each_of_null_and_repeated_keys(spark):
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(7)]
    rows = [(None, t) for t in texts[:3]] + [(5, t) for t in texts[3:6]] + [(6, texts[6]), (None, texts[0]), (5, texts[3]), (5, texts[6])]
    got = one_of_each(frame(spark, rows), size=3, percent=90).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([*rows[:6], (5, texts[6])], key=str)


def test_components_of_a_long_chain(spark):
    links = [(str(i).zfill(3), str(i + 1).zfill(3)) for i in range(200)] + [("b", "a"), ("a", "a"), ("c", "b")]
    got = components(spark.createDataFrame(links, "a string, b string")).collect()
    want = {str(i).zfill(3): "000" for i in range(201)} | {"a": "a", "b": "a", "c": "a"}
    assert {r.node: r.part for r in got} == want and len(got) == len(want)


def test_query_against_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op3_ngram_jaccard_join"](spark, small).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 3, 90)
