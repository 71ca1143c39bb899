import random

import pytest
from tokenizers import Tokenizer, decoders, models, pre_tokenizers

from tests.llm.corpus import awkward, frame
from tidemark.llm.queries import QUERIES, public_file, unigram_vocabulary
from tidemark.llm.tokens import count_tokens


def oracle(vocabulary, byte_pieces, unknown):
    model = Tokenizer(models.Unigram(vocabulary, unk_id=unknown, byte_fallback=byte_pieces))
    model.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    model.decoder = decoders.Metaspace()
    return lambda text: len(model.encode(text or "", add_special_tokens=False).ids)


def tied(seed=3):
    """Small vocabularies with many equal sums."""
    rng = random.Random(seed)
    pieces = {"<unk>": 0.0, "▁": -2.0, "a": -1.0, "b": -1.0}
    while len(pieces) < 40:
        pieces["".join(rng.choice("▁abc") for _ in range(rng.randint(1, 4)))] = -float(rng.randint(1, 3))
    return list(pieces.items())


@pytest.mark.parametrize("seed", [3, 4])
def test_ties_and_unknown_characters(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice("abcd é▁") for _ in range(rng.randint(0, 40)))) for i in range(400)]
    count = oracle(tied(seed), False, 0)
    got = count_tokens(frame(spark, rows), tied(seed), False).collect()
    assert sorted(map(tuple, got)) == [(k, count(t)) for k, t in rows]


def test_public_vocabulary(spark):
    vocabulary = unigram_vocabulary(public_file("piece_bpe_32k.model"))
    count = oracle(vocabulary, True, 0)
    rows = [*awkward(), (700, "<0x41> <unk> ▁▁x"), (701, "日本語 text 😀😀"), (702, "  two  blanks ")]
    got = count_tokens(frame(spark, rows), vocabulary, True).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((k, count(t)) for k, t in rows), key=str)


def test_empty_table(spark):
    assert count_tokens(frame(spark, []), tied(), False).collect() == []


def test_query(spark, small):
    count = oracle(unigram_vocabulary(public_file("piece_bpe_32k.model")), True, 0)
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op10_token_counts"](spark, small).collect())) == sorted((r.doc_id, count(r.text)) for r in rows)
