import base64
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers

from tests.llm.corpus import awkward, frame
from tidemark.llm import alignment
from tidemark.llm.alignment import Plane, align_tokenizers, document_counts, lay_planes, link_counts
from tidemark.llm.queries import QUERIES, public_file


@pytest.fixture(scope="module")
def files():
    with open(public_file("byte_bpe_50k.json"), encoding="utf-8") as one, open(public_file("piece_bpe_32k.model"), "rb") as two:
        return one.read(), two.read()


def brute(rows, files):
    """Rows and pairs by whole texts, token by token; A's bytes from the file of ranks."""
    one = tokenizers.Tokenizer.from_str(files[0])
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    with open(public_file("byte_bpe_50k.tiktoken"), "rb") as ranks:
        one_bytes = {int(i): base64.b64decode(t) for t, i in map(bytes.split, ranks)}
    one_bytes[50256] = b"<|endoftext|>"

    def piece(i):
        p = two.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for _, t in rows:
        if not t:
            docs.append(None)
            continue
        whole = (" " + t).encode()
        a, b = one.encode(" " + t, add_special_tokens=False).ids, two.encode(t)
        x, y = [one_bytes[i] for i in a], [piece(i) for i in b]
        if b"".join(x) != whole or b"".join(y) != whole:
            docs.append(None)
            continue
        spans = []
        for parts in (x, y):
            at, own = 0, []
            for p in parts:
                own.append((at, at + len(p)))
                at += len(p)
            spans.append(own)
        links, j = [], 0
        for i, (lo, hi) in enumerate(spans[0]):
            while spans[1][j][1] <= lo:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < hi:
                links.append((a[i], b[k]))
                k += 1
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, i, j = [], 0, 0
        for e in ends:
            p, q = i, j
            while i < len(a) and spans[0][i][1] <= e:
                i += 1
            while j < len(b) and spans[1][j][1] <= e:
                j += 1
            groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
        docs.append((len(a), len(b), groups, links))
    count = Counter(p for d in docs if d for p in d[3])
    held = Counter(p for d in docs if d for p in set(d[3]))
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for (key, _), d in zip(rows, docs):
        if d is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(count[p] == most[p[1]] for p in d[3])
            digest = hashlib.sha256(";".join(d[2]).encode()).hexdigest()
            out.append((key, d[0], d[1], len(d[2]), len(d[3]), best, sum(count[p] for p in d[3]), digest))
    pairs = sorted((a, b, n, held[a, b], n == most[b]) for (a, b), n in count.items())
    return sorted(out, key=str), pairs


def odd(seed=2, n=400):
    """Texts of blanks of all kinds, special tokens' names, U+2581, controls and letters of many scripts."""
    rng = random.Random(seed)
    bits = [" ", " ", " ", "  ", "\n", "\t", "\r\n", " ", "　", " ", "\u0085", "a", "The", "n't", "'s", "12", "!", "...", "é", "日本", "ß", "😀", "́"]
    bits += ["<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "\0", "\x1c", "ﬁ", "Ω", "к", "أ", "​", "‍", "x" * 20, "ing ", " of the "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    return [(i, t) for i, t in enumerate([*texts, "a ▁b", "▁", " ", "\n", " x", "x ", "", None])]


@pytest.mark.parametrize("rows", [awkward(), odd(), odd(9)])
def test_against_brute_force(spark, files, rows):
    got, pairs = align_tokenizers(frame(spark, rows), *files)
    want, want_pairs = brute(rows, files)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sorted(map(tuple, pairs.select("a", "b", "n_links", "n_docs", "best").collect())) == want_pairs


def test_small_chunks_add_up(spark, files, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 3000)
    rows = awkward()
    got, pairs = align_tokenizers(frame(spark, rows).coalesce(1), *files)
    want, want_pairs = brute(rows, files)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sorted(map(tuple, pairs.select("a", "b", "n_links", "n_docs", "best").collect())) == want_pairs


def test_empty_table(spark, files):
    got, pairs = align_tokenizers(frame(spark, []), *files)
    assert got.collect() == [] and pairs.collect() == []
    got, _ = align_tokenizers(frame(spark, [(1, None), (None, "")]), *files)
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def test_long_text(spark, files):
    words = "the quick brown fox jumped over lazy dogs and unusually verbose paragraphs ".split()
    rng = random.Random(1)
    rows = [(1, " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(1_000_000))), (2, "x" * 100_000), (3, "a fox")]
    got, _ = align_tokenizers(frame(spark, rows), *files)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, files)[0]


@pytest.mark.parametrize("documents", [5, 300, 70_000])
def test_planes(documents):
    rng = np.random.default_rng(documents)
    entries = np.unique(np.concatenate([rng.integers(0, 40, 3000) * documents + rng.integers(0, documents, 3000), 7 * documents + np.arange(documents)]))
    pair, doc, times = entries // documents, entries % documents, rng.integers(1, 9, len(entries))
    pairs, planes = lay_planes(pair, doc, times, documents)
    planes = [Plane.unpacked(p.packed(), documents) for p in planes]
    assert (link_counts(planes, len(pairs)) == np.bincount(pair, times)[pairs]).all()
    assert (document_counts(planes, len(pairs), documents) == np.bincount(pair)[pairs]).all()
    total = Counter()
    for k, plane in enumerate(planes):
        for p, d in zip(*(x.tolist() for x in plane.expand(documents))):
            total[int(pairs[p]), d] += 1 << k
    assert total == dict(zip(zip(pair.tolist(), doc.tolist()), times.tolist()))


def test_query_against_brute_force(spark, small, files):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_cross_tokenizer_alignment"](spark, small)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, files)[0]
