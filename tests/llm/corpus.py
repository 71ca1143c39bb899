"""Small awkward texts for the operators' tests."""

import random

SCHEMA = "doc_id long, text string, lang string, n_words string, chunk string"


def awkward(seed=5, n=120):
    """Rows (doc_id, text): copies, shared passages, loops, nulls, empties, odd blanks, long words, repeated rows and ids."""
    rng = random.Random(seed)
    vocabulary = [a + b for a in "ba de ki mo ñu ßé".split() for b in "lo ra ti".split()] + ["The", "THE", "the", "a"]

    def words(k):
        return [rng.choice(vocabulary) + rng.choice(["", "", "x", "y", str(rng.randint(0, 99))]) for _ in range(k)]

    shared = [" ".join(words(k)) for k in (12, 40, 60)]
    texts = [" ".join(words(rng.choice([3, 10, 60, 150]))) for _ in range(n)]
    for i in range(0, n, 3):
        cut = rng.randint(0, len(texts[i]))
        texts[i] = texts[i][:cut] + " " + rng.choice(shared) + "\n" + texts[i][cut:]
    texts += [texts[4]] * 5 + [texts[7] + " more", texts[7].replace(" ", "\n\t ")]
    texts += [None, None, "", "", " ", "\n\x0b\x0c\r ", "one", "one", "one two", "a " * 300, "ab cd   é", "x" * 9000]
    texts += [" ".join(words(4000)), "loop de loop de " * 40, "\x1c \x85 zz", "  lead and trail  ", "😀 😀 😀 😀"]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(3, texts[3]), (9, texts[9]), (None, "no id here"), (None, None)]


def frame(spark, rows):
    """With extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(k, t, "en", "x", "y") for k, t in rows], SCHEMA)
