"""The queries over the operators of this package, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import alignment, benchmark, hyperminhash, language, ngram_join, packing, quality, search, suffixes, tokens, toxicity, urls, windows
from tidemark.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(tune(spark), folder)
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return windows.report_repeats(table(spark, folder, "documents"))


@query
def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    _, rows = ngram_join.join_by_jaccard(table(spark, folder, "documents"), size=3, percent=90)
    return rows.select("doc_id", "n_shingles", "component_id")


@query
def op9_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.report_repeats(table(spark, folder, "documents"), keep_first=False)


def public_file(name: str) -> str:
    """Where a public tokenizer's file lies on the driver; its content travels with the tasks."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_file("word_bpe_49k.json"), encoding="utf-8") as file:
        return packing.pack(table(spark, folder, "documents"), file.read())


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces and scores of a public sentencepiece file, without its control pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not model.is_control(i)]


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = unigram_vocabulary(public_file("piece_bpe_32k.model"))
    return tokens.count_tokens(table(spark, folder, "documents"), vocabulary, byte_pieces=True)


URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]
# Hosts that a list of unwanted sites names; each stands for all hosts below it, with whatever path.
LISTED = [
    f"{name}.example.{end}"
    for name in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for end in ("com", "net", "org")
]

ORACLES["op5_url_filter"] = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(verdict, rule, kind) AS (
  VALUES {", ".join([f"('{v}', '{r}', 1)" for v, r in URL_RULES] + [f"('block', '{r}', 0)" for r in LISTED])}
), fits AS (
  SELECT page_id, verdict, rule, kind,
         row_number() OVER (PARTITION BY page_id ORDER BY kind DESC, length(rule) DESC, verdict DESC) AS k
  FROM parts JOIN rules
    ON ends_with('.' || host, '.' || split_part(rule, '/', 1)) AND starts_with(path, CASE WHEN rule LIKE '%/%' THEN substr(rule, strpos(rule, '/')) ELSE '' END)
)
SELECT p.page_id, p.host, p.path, CASE WHEN f.kind = 1 THEN f.rule END AS rule, coalesce(f.verdict, 'allow') AS verdict,
       CASE WHEN f.kind = 0 THEN f.rule END AS listed
FROM parts p LEFT JOIN (SELECT * FROM fits WHERE k = 1) f ON f.page_id = p.page_id
"""


@query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES, LISTED)


ORACLES["op6_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w FROM documents
), b AS (
  SELECT item_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w FROM benchmark
), starts AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0
), grams AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS gram FROM starts
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d
), runs AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM places, (SELECT DISTINCT n FROM grams) WHERE i + n - 1 <= len(w)
), hits AS (
  SELECT doc_id, i, runs.n, item_id FROM runs JOIN grams ON runs.gram = grams.gram AND runs.n = grams.n
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""


@query
def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return benchmark.report_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.report_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op12_hyperminhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return hyperminhash.find_near_duplicates(table(spark, folder, "documents"), size=3, percent=85)


@query
def op13_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_file("byte_bpe_50k.json"), encoding="utf-8") as one, open(public_file("piece_bpe_32k.model"), "rb") as two:
        return alignment.align_tokenizers(table(spark, folder, "documents"), one.read(), two.read())[0]


ORACLES["op11_ranked_search"] = r"""
WITH d AS (
  SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') if x <> ''] AS w FROM documents
), i AS (
  SELECT item_id, unnest(list_distinct([x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') if x <> ''])) AS t FROM benchmark
), whole AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0
), tf AS (
  SELECT doc_id, n, t, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY doc_id, n, t
), df AS (
  SELECT t, count(*) AS df FROM tf GROUP BY t
), part AS (
  SELECT doc_id, t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
           * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS s
  FROM tf JOIN df USING (t), whole
), scored AS (
  SELECT item_id, doc_id, CAST(sum(s) AS BIGINT) AS score FROM part JOIN i USING (t) GROUP BY item_id, doc_id HAVING sum(s) > 0
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored QUALIFY rank <= 10
"""


@query
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
