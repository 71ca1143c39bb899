"""Chained models, contracts, parameters, Python models, text extraction, item vectors and forecasts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.casebook import sequences
from tidemark.catalog.registry import Tables, query
from tidemark.functions.params import Parameter
from tidemark.functions.vectors import nearest
from tidemark.operators import quality as q
from tidemark.operators.enrich import enrich, extract_text
from tidemark.plans import contracts, learning
from tidemark.plans.models import Expectation, Input, Model, run, sql_text_model
from tidemark.plans.versions import Lake


def chain() -> list[Model]:
    """Two SQL models feed one Python model, which feeds another together with one of its own parents."""
    lines = sql_text_model(
        "line_totals",
        """-- tidemark: materialization_strategy = NONE
           SELECT l_suppkey, SUM(l_quantity) AS quantity, COUNT(*) AS line_count FROM lineitem
           WHERE l_shipdate >= $start_date GROUP BY l_suppkey""",
    )
    places = sql_text_model(
        "supplier_places", "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey"
    )

    def by_supplier(totals: DataFrame, places: DataFrame) -> DataFrame:
        return totals.join(places, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey")

    def by_nation(suppliers: DataFrame, places: DataFrame) -> DataFrame:
        counted = places.groupBy("n_name").agg(F.count(F.lit(1)).alias("supplier_count"))
        summed = suppliers.groupBy("n_name").agg(F.sum("quantity").alias("quantity"), F.sum("line_count").alias("line_count"))
        return summed.join(counted, "n_name")

    return [
        Model(
            "nation_totals",
            by_nation,
            {"suppliers": Input("supplier_totals", ["n_name", "quantity", "line_count"]), "places": Input("supplier_places")},
            columns=["n_name", "quantity", "line_count", "supplier_count"],
            strategy="REPLACE",
        ),
        Model(
            "supplier_totals",
            by_supplier,
            {"totals": Input("line_totals", filter="line_count >= $least"), "places": Input("supplier_places")},
            strategy="REPLACE",
        ),
        lines,
        places,
    ]


PARAMETERS = [Parameter("start_date", str, "1997-01-01"), Parameter("least", int, 1)]
_CHAIN_SQL = """WITH totals AS (SELECT l_suppkey, SUM(l_quantity) AS quantity, COUNT(*) AS line_count FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '{start}' GROUP BY l_suppkey HAVING COUNT(*) >= {least}),
  places AS (SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
  SELECT n_name, SUM(quantity) AS quantity, CAST(SUM(line_count) AS BIGINT) AS line_count, ANY_VALUE(c) AS supplier_count
  FROM totals JOIN places ON l_suppkey = s_suppkey JOIN (SELECT n_name, COUNT(*) AS c FROM places GROUP BY n_name) USING (n_name)
  GROUP BY n_name"""


def sources(t: Tables) -> dict[str, DataFrame]:
    return {name: getattr(t, name) for name in ("lineitem", "supplier", "nation")}


@query(_CHAIN_SQL.format(start="1997-01-01", least=1))
def model_chain(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    run(t.spark, chain(), sources(t), lake=lake, declared=PARAMETERS, strict=True)
    return lake.read("nation_totals")


@query(_CHAIN_SQL.format(start="2000-01-01", least=130))
def model_chain_with_parameters(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    given = {"start_date": "2000-01-01", "least": "130"}
    run(t.spark, chain(), sources(t), lake=lake, declared=PARAMETERS, params=given, strict=True)
    return lake.read("nation_totals")


@query(
    """SELECT 'line_totals' AS model, 'NONE' AS strategy, 'succeeded' AS outcome, NULL::BIGINT AS rows UNION ALL
       SELECT 'supplier_places', 'NONE', 'succeeded', NULL UNION ALL
       SELECT 'supplier_totals', 'REPLACE', 'succeeded', COUNT(DISTINCT l_suppkey) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'
       UNION ALL SELECT 'nation_totals', 'REPLACE', 'succeeded', COUNT(DISTINCT s_nationkey) FROM supplier
         WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01')"""
)
def run_summary(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    done = run(t.spark, chain(), sources(t), lake=lake, declared=PARAMETERS, strict=True)
    return done.summary.select("model", "strategy", "outcome", "rows")


@query(
    """SELECT 0::BIGINT AS tables_written, 4::BIGINT AS models_run, COUNT(DISTINCT s_nationkey) AS output_rows FROM supplier
       WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01')"""
)
def dry_run_writes_nothing(t: Tables) -> DataFrame:
    lake = Lake(t.spark, t.scratch("lake"))
    done = run(t.spark, chain(), sources(t), lake=lake, declared=PARAMETERS, strict=True, dry=True)
    return done.outputs["nation_totals"].agg(
        F.lit(lake.tables().count()).cast("long").alias("tables_written"),
        F.lit(done.summary.count()).cast("long").alias("models_run"),
        F.count(F.lit(1)).alias("output_rows"),
    )


@query(
    """SELECT COUNT(*) AS n, false AS published_when_strict, true AS published_when_relaxed FROM customer"""
)
def run_with_failing_check(t: Tables) -> DataFrame:
    """The same failing expectation stops a strict run before anything is published, and only warns otherwise."""
    import warnings

    models = [Model("accounts", lambda customer: customer, {"customer": Input("customer")}, strategy="REPLACE")]
    checks = [Expectation("accounts", checks=[q.accepted_values("c_mktsegment", ["BUILDING"])])]
    published = {}
    for strict in (True, False):
        lake = Lake(t.spark, t.scratch("lake"))
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                run(t.spark, models, {"customer": t.customer}, lake=lake, expectations=checks, strict=strict)
        except q.ExpectationFailed:
            pass
        published[strict] = bool(lake.versions())
    return lake.read("accounts").agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(published[True]).alias("published_when_strict"),
        F.lit(published[False]).alias("published_when_relaxed"),
    )


@query(
    """SELECT 'missing column margin' AS problem, COUNT(*) AS n FROM part UNION ALL
       SELECT 'unexpected column p_size', COUNT(*) FROM part"""
)
def column_contract(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", "p_size")
    problems = contracts.column_problems(df, ["p_partkey", "margin"])
    return df.select(F.explode(F.array(*[F.lit(p) for p in problems])).alias("problem")).groupBy("problem").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    """SELECT 'quality has ' || COUNT(*) || ' nulls' AS problem FROM documents LEFT JOIN labels USING (doc_id)
        WHERE quality IS NULL UNION ALL SELECT 'toxic has ' || COUNT(*) || ' nulls' FROM documents
        LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL UNION ALL SELECT 'lang is string, contract says bigint'
        UNION ALL SELECT 'toxic: no documents[''toxicity''] to come from'"""
)
def typed_contract(t: Tables) -> DataFrame:
    df = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    fields = [
        contracts.Field("doc_id", "Int64", nullable=False, lineage="documents['doc_id']"),
        contracts.Field("lang", "Int64"),
        contracts.Field("quality", "Int32", nullable=False),
        contracts.Field("toxic", "Int32", nullable=False, lineage="documents['toxicity']"),
    ]
    problems = contracts.check_contract(df, fields, {"documents": t.documents})
    return t.spark.createDataFrame([(p,) for p in problems], "problem string")


@query("SELECT o_orderkey AS id, o_totalprice AS amount FROM orders")
def projection_by_lineage(t: Tables) -> DataFrame:
    fields = [
        contracts.Field("id", "Int64", lineage="orders['o_orderkey']"),
        contracts.Field("amount", "Float64", lineage="orders['o_totalprice']"),
    ]
    return contracts.project(t.orders, fields)


@query(
    """SELECT l_shipdate, l_suppkey, l_quantity, ROUND(LOG10(l_quantity), 9) AS log_quantity, CAST(l_shipdate AS DATE) AS ds
       FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_quantity > 0"""
)
def python_model_on_arrow(t: Tables) -> DataFrame:
    """A model whose body is Python over Arrow batches; projection and filters stay outside and reach the scan."""

    def normalize(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            logs = pc.round(pc.log10(batch["l_quantity"]), 9)
            days = pc.cast(batch["l_shipdate"], pa.date32(), safe=False)
            names = [*batch.schema.names, "log_quantity", "ds"]
            yield pa.RecordBatch.from_arrays([*batch.columns, logs, days], names=names)

    kept = t.lineitem.filter("l_shipdate >= '2000-01-01' AND l_quantity > 0").select(
        "l_shipdate", "l_suppkey", "l_quantity"
    )
    return kept.mapInArrow(
        normalize, "l_shipdate timestamp_ntz, l_suppkey bigint, l_quantity double, log_quantity double, ds date"
    )


@query("SELECT page_id, url, SPLIT_PART(REGEXP_REPLACE(html, '<[^>]*>', ' ', 'g'), 'ad 1', 1) AS text FROM pages")
def extract_text_with_parser(t: Tables) -> DataFrame:
    def parser(html: str) -> str:
        import re

        return re.sub("<[^>]*>", " ", html)

    return extract_text(t.pages, "html", "text", marker="ad 1", parser=parser, drop=["html"])


@query(
    """SELECT link, page_id AS from_page_id, REGEXP_EXTRACT(url, '^https?://([^/]+)', 1) AS from_host FROM
       (SELECT page_id, url, UNNEST(REGEXP_EXTRACT_ALL(html, 'href="/([^"]*)"', 1)) AS link FROM pages)"""
)
def enrich_one_to_many(t: Tables) -> DataFrame:
    """Several rows per page from a function called per batch, with the keys of the page added."""

    def links(batch: pd.DataFrame) -> Iterator[dict]:
        import re

        for i, html in enumerate(batch["html"]):
            for link in re.findall(r'href="/([^"]*)"', html):
                yield {"row": i, "link": link}

    pages = t.pages.withColumn("host", F.regexp_extract("url", "^https?://([^/]+)", 1))
    return enrich(pages, links, "link string", ["page_id", "host"], rename="from_{}")


@query(
    """SELECT CAST(l_partkey AS VARCHAR) AS item, 48::BIGINT AS dimensions FROM lineitem WHERE l_quantity > 5
       GROUP BY l_partkey HAVING COUNT(*) >= 2"""
)
def item_vectors(t: Tables) -> DataFrame:
    vectors = learning.skip_gram(sequences(t), "track_ids")
    return vectors.select("item", F.size("vector").cast("long").alias("dimensions"))


@query(
    """SELECT p_partkey AS item, 48::BIGINT AS dimensions, n AS popularity, p_name, p_brand FROM part JOIN
       (SELECT l_partkey, COUNT(*) AS n FROM lineitem WHERE l_quantity > 5 GROUP BY l_partkey HAVING COUNT(*) >= 2
        ORDER BY n DESC, l_partkey LIMIT 100) ON p_partkey = l_partkey"""
)
def item_vectors_with_metadata(t: Tables) -> DataFrame:
    tracks = t.lineitem.filter("l_quantity > 5")
    popular = (
        tracks.groupBy("l_partkey")
        .agg(F.count(F.lit(1)).alias("popularity"))
        .orderBy(F.desc("popularity"), "l_partkey")
        .limit(100)
    )
    vectors = learning.skip_gram(sequences(t), "track_ids").withColumn("item", F.col("item").cast("long"))
    metadata = t.part.select("p_partkey", "p_name", "p_brand").distinct()
    return (
        vectors.join(popular, vectors["item"] == popular["l_partkey"])
        .join(metadata, F.col("item") == F.col("p_partkey"))
        .select("item", F.size("vector").cast("long").alias("dimensions"), "popularity", "p_name", "p_brand")
    )


@query(
    """WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 7)
       SELECT vec_id, label, ROUND(LIST_COSINE_SIMILARITY(embedding::DOUBLE[], (SELECT e::DOUBLE[] FROM q)), 9) AS score
       FROM embeddings ORDER BY LIST_COSINE_SIMILARITY(embedding::DOUBLE[], (SELECT e::DOUBLE[] FROM q)) DESC, vec_id LIMIT 25"""
)
def nearest_vectors(t: Tables) -> DataFrame:
    target = t.embeddings.filter("vec_id = 7").select("embedding").first()["embedding"]
    found = nearest(t.embeddings, "vec_id", "embedding", target, 25)
    return found.select("vec_id", "label", F.round("score", 9).alias("score"))


@query("SELECT event_type, CAST(ts AS DATE) AS ds, COUNT(*) AS y FROM events GROUP BY ALL")
def daily_series(t: Tables) -> DataFrame:
    return learning.daily_counts(t.events, "ts", ["event_type"])


@query(
    """WITH s AS (SELECT event_type, CAST(ts AS DATE) AS ds, COUNT(*)::DOUBLE AS y, DATE_DIFF('day', DATE '1970-01-01',
         CAST(ts AS DATE)) AS x FROM events GROUP BY ALL),
       tr AS (SELECT event_type, REGR_SLOPE(y, x) AS slope, AVG(x) AS mx, AVG(y) AS my, MAX(ds) AS last FROM s GROUP BY event_type),
       r AS (SELECT s.*, y - (my + slope * (x - mx)) AS rest, DAYOFWEEK(ds) AS wd FROM s JOIN tr USING (event_type)),
       w AS (SELECT event_type, wd, AVG(rest) AS effect FROM r GROUP BY ALL),
       sp AS (SELECT event_type, SQRT(AVG((rest - effect) * (rest - effect))) AS spread FROM r JOIN w USING (event_type, wd) GROUP BY event_type),
       d AS (SELECT event_type, ds FROM s UNION ALL SELECT event_type, last + CAST(i AS INTEGER) FROM tr, RANGE(1, 21) AS g(i)),
       f AS (SELECT event_type, ds, my + slope * (DATE_DIFF('day', DATE '1970-01-01', ds) - mx) + COALESCE(effect, 0) AS v, spread
         FROM d JOIN tr USING (event_type) JOIN sp USING (event_type) LEFT JOIN w ON w.event_type = d.event_type AND wd = DAYOFWEEK(ds))
       SELECT event_type, ds, ROUND(v, 6) AS yhat, ROUND(v - 1.96 * spread, 6) AS yhat_lower,
         ROUND(v + 1.96 * spread, 6) AS yhat_upper FROM f"""
)
def forecast_per_series(t: Tables) -> DataFrame:
    series = learning.daily_counts(t.events, "ts", ["event_type"])
    fitted = learning.forecast(series, ["event_type"], 20)
    bounds = [F.round(name, 6).alias(name) for name in ("yhat", "yhat_lower", "yhat_upper")]
    return fitted.select("event_type", "ds", *bounds)
