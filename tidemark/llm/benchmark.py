"""Find and remove benchmark passages: a broadcast set of normalised test n-grams, scanned for in every window of every document.

Every window of a benchmark item is known by its longest word and where that lies in it. A document's words are scanned once;
where a word is known, the words around it are compared with the windows it stands for, so a hit is a verified occurrence. Only
hits leave the scan. All of it is built-in functions.

Null texts have no words, neither do texts of separators alone. Items of fewer words than a window are one window; items without
words find nothing. Rows that repeat a document are judged each; items that repeat count once for each item_id. An empty
benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 10
# Characters of windows, and different anchors, that may be broadcast; a larger benchmark is joined by shuffling.
BROADCAST_CHARS = 32 << 20
MOST_ANCHORS = 50_000
# What lies between words, once A-Z are lower case, and the same with A-Z still as they are.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAPS_BEFORE_LOWERING = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z not yet lowered."""
    return F.array_remove(F.split(text, GAPS_BEFORE_LOWERING), "")


def plain(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, UPPER, LOWER))


def windows_of(benchmark: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """(anchor, ahead, gram, items): each different window once, with its longest word, the words before that, and its items."""
    words = benchmark.select(F.col(item).cast("string").alias("item"), plain(words_of(F.col(text))).alias("words"))
    words = words.filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))
    grams = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, width))).alias("gram"))
    grams = grams.groupBy("gram").agg(F.collect_set("item").alias("items"))
    longest = F.array_max(F.transform("gram", lambda w, i: F.struct(F.length(w).alias("n"), (-i).alias("i"), F.lower(w).alias("w"))))
    return grams.withColumn("a", longest).select(
        F.col("a.w").alias("anchor"), (-F.col("a.i")).alias("ahead"), F.size("gram").alias("n"), "gram", "items"
    )


def hits_of(docs: DataFrame, benchmark: DataFrame, row: list[Column], text: str, item: str, width: int) -> DataFrame:
    """Per document that is hit, under the columns `row`: `hit`, the places of its hit words, and `items`."""
    grams = windows_of(benchmark, item, "text", width)
    size, anchors = grams.agg(F.sum(F.length(F.array_join("gram", " "))), F.count_distinct("anchor")).first()
    known = None
    if (size or 0) <= BROADCAST_CHARS and anchors <= MOST_ANCHORS:
        grams = F.broadcast(grams)
        known = [r.anchor for r in grams.select("anchor").distinct().collect()]
    names = [f"r{i}" for i in range(len(row))]
    words = docs.select(*[c.alias(n) for c, n in zip(row, names)], words_of(F.col(text)).alias("words"))
    # places of anchors, and only the words around them go on; with too many anchors, all places do
    at = F.transform("words", lambda w, i: F.when(F.lower(w).isin(known), i) if known is not None else i)
    near = lambda p: F.struct(
        p.alias("place"), F.greatest(p - (width - 1), F.lit(0)).alias("first"),
        F.slice("words", F.greatest(p - (width - 1), F.lit(0)) + 1, 2 * width - 1).alias("words"),
    )
    around = words.select(*names, F.transform(F.array_compact(at), near).alias("around"))
    # outer, else the optimizer would cut each text into words once more to ask whether there are any
    each = around.select(*names, F.explode_outer("around").alias("c")).filter("c is not null").select(*names, "c.*")
    start = F.col("place") - F.col("ahead")
    word = F.lower(F.col("words")[F.col("place") - F.col("first")])
    same = F.when(start >= 0, plain(F.slice("words", start - F.col("first") + 1, F.col("n"))) == F.col("gram")).otherwise(False)
    found = each.withColumn("word", word).join(grams, (F.col("word") == F.col("anchor")) & same)
    found = found.select(*names, F.struct(start.alias("start"), "n").alias("span"), "items")
    found = found.groupBy(*names).agg(F.collect_set("span").alias("spans"), F.collect_set("items").alias("items"))
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    return found.select(*names, F.array_distinct(covered).alias("hit"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def with_hits(docs: DataFrame, kept: list[Column], benchmark: DataFrame, key: str, text: str, item: str, width: int) -> DataFrame:
    """`kept` columns of every row of `docs`, and `hit` and `items` as of `hits_of` (null where nothing was found)."""
    # a row is known by its key and its text; rows alike in both have the same hits
    row = [F.col(key), F.xxhash64(text), F.crc32(F.col(text).cast("binary"))]
    hits = hits_of(docs, benchmark, row, text, item, width)
    rows = docs.select(*kept, *[c.alias(f"d{i}") for i, c in enumerate(row)])
    same = F.col("d0").eqNullSafe(F.col("r0")) & (F.col("d1") == F.col("r1")) & (F.col("d2") == F.col("r2"))
    return rows.join(hits, same, "left")


def report_hits(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", width: int = WIDTH
) -> DataFrame:
    """Per document: key, n_words, n_hit, n_items, items_sha256 and contaminated."""
    kept = [F.col(key).alias("k"), F.coalesce(F.size(words_of(F.col(text))), F.lit(0)).alias("n")]
    rows = with_hits(docs, kept, benchmark, key, text, item, width)
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    listed = F.coalesce(F.array_join("items", ","), F.lit(""))
    return rows.select(
        F.col("k").alias(key), F.greatest("n", F.lit(0)).cast("long").alias("n_words"), F.greatest(count("hit"), F.lit(0)).alias("n_hit"),
        F.greatest(count("items"), F.lit(0)).alias("n_items"), F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", key: str = "doc_id", text: str = "text",
    item: str = "item_id", width: int = WIDTH,
) -> DataFrame:
    """`docs` without the documents that hold a benchmark window, or (remove="spans") without the words hit.

    A text that loses words becomes its other words joined by one space; all other texts stay as they are.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove!r}")
    rows = with_hits(docs, [F.struct(*docs.columns).alias("row")], benchmark, key, text, item, width)
    if remove == "documents":
        return rows.filter(F.col("hit").isNull()).select("row.*")
    words = words_of(F.col("row")[text])
    rest = F.array_join(F.filter(words, lambda w, i: ~F.array_contains("hit", i)), " ")
    new = F.when(F.col("hit").isNull(), F.col("row")[text]).otherwise(rest)
    return rows.select(*[(new if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
