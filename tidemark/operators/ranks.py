"""Ordered positions without a window over a whole group: row numbers, exact medians, ordered lists.

A window partitioned by a key puts every row of that key in one task. Here rows are range-partitioned by key and order, so
a hot key spreads over many partitions; each partition totals its own rows, and the few totals carried across partition
borders (at most two keys per partition) are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import match_keys
from tidemark.session import shuffle_width, written

PART = "__part"
LOCAL = "__local"
CARRIED = "__carried"
# Rows generated from one repeated row at a time, and items in one piece of an ordered list.
BLOCK = 100_000
# Rows of a key that a task may sort, and the sketch's accuracy: its rank error is one part in so many, its bounds two parts off.
SMALL, ACCURACY = 5_000, 1_000


def spread_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`df` range-partitioned by keys and order, written down with the number of its partition.

    Written, because the ranges are sampled: computed a second time they could fall differently.
    """
    width = shuffle_width(df.sparkSession)
    ranged = df.repartitionByRange(width, *keys, *order).withColumn(PART, F.spark_partition_id())
    return written(ranged, "ranged")


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, before: str) -> DataFrame:
    """Add `before`: the sum of `amount` over the rows of the same keys that sort earlier.

    (keys, order) should be unique; collapse copies first and let `amount` carry their count.
    """
    return total_before(spread_in_order(df, keys, order), keys, order, amount, before)


def total_before(
    ranged: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, before: str
) -> DataFrame:
    """The running total over rows that `spread_in_order` has laid out."""
    keys, order = list(keys), list(order)

    # The keys at the borders of the range partitions: at most two per partition, whatever the data.
    if keys:
        edge = F.struct(*keys)
        borders = (
            ranged.groupBy(PART)
            .agg(F.min(edge).alias("lo"), F.max(edge).alias("hi"))
            .select(F.explode(F.array("lo", "hi")).alias("edge"))
            .select("edge.*")
            .distinct()
        )
        at_border = match_keys(ranged, borders, keys, "left_semi", small=True)
    else:
        at_border = ranged
    totals = at_border.groupBy(PART, *keys).agg(F.sum(amount).alias("__total"))
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(PART, *keys, F.sum("__total").over(earlier).alias(CARRIED)).filter(
        F.col(CARRIED).isNotNull()
    )

    inside = Window.partitionBy(PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn(LOCAL, F.sum(amount).over(inside))
    joined = match_keys(local, carried, [PART, *keys], "left", small=True)
    total = F.coalesce(LOCAL, F.lit(0)) + F.coalesce(CARRIED, F.lit(0))
    return joined.select(*[name for name in ranged.columns if name != PART], total.alias(before))


def number_rows(df: DataFrame, name: str = "row_number") -> DataFrame:
    """Contiguous numbers 1..n in no particular order, with no shuffle of the rows.

    One counted total per stored partition is carried over, so the broadcast side has as many rows as there are partitions.
    """
    marked = written(df.withColumn("__id", F.monotonically_increasing_id()), "numbered")
    part, inside = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = marked.groupBy(part.alias(PART)).agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(PART, F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset"))
    placed = marked.withColumn(PART, part).join(F.broadcast(offsets), PART)
    return placed.select(*df.columns, (F.col("__offset") + inside + 1).alias(name))


def number_ordered(df: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """Contiguous numbers 1..n along `order`, ties broken by the remaining columns.

    Equal rows are counted once and expanded again in blocks, so copies of one row neither pile up in one range partition
    nor become one huge array.
    """
    order = list(order) + [column for column in df.columns if column not in order]
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    placed = running_total(counted, [], order, "__n", "__before")
    blocks = placed.select(
        *df.columns,
        "__before",
        "__n",
        F.explode(F.sequence(F.lit(0), ((F.col("__n") - 1) / BLOCK).cast("long"))).alias("__block"),
    )
    first = F.col("__block") * BLOCK
    last = F.least(first + BLOCK, F.col("__n")) - 1
    steps = F.explode(F.sequence(first, last)).alias("__step")
    return blocks.select(*df.columns, "__before", steps).select(
        *df.columns, (F.col("__before") + F.col("__step") + 1).alias(name)
    )


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Median of the non-null numbers per key: the mean of the two middle values.

    Keys of up to SMALL rows are sorted where they meet. For larger ones a sketch bounds the middle, rows outside the bounds are
    only counted, and the few inside are ranked; so no row is written down or sorted but those near the middle. A sketch that
    misses the middle, which its error bound rules out, would only mean ranking all rows.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value)
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size")).filter(F.col("__size") > SMALL)
    if large.isEmpty():
        return rows.groupBy(*keys).agg(F.median(value).alias(name)) if keys else rows.agg(F.median(value).alias(name)).filter(F.col(name).isNotNull())
    if not keys:
        return _median_near(rows, keys, value, name)
    few = match_keys(rows, large.drop("__size"), keys, "left_anti").groupBy(*keys).agg(F.median(value).alias(name))
    return few.unionByName(_median_near(match_keys(rows, large.drop("__size"), keys, "left_semi"), keys, value, name))


def _median_near(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    margins = [0.5 - 2 / ACCURACY, 0.5 + 2 / ACCURACY]
    near = rows.groupBy(*keys).agg(F.percentile_approx(value, margins, ACCURACY).alias("__near"))
    marked = match_keys(rows, near, keys, small=not keys)
    side = F.when(F.col(value) < F.col("__near")[0], -1).when(F.col(value) > F.col("__near")[1], 1).otherwise(0)
    marked = marked.select(*keys, side.alias("__side"), value)
    inside = F.when(F.col("__side") == 0, F.col(value))
    cells = marked.groupBy(*keys, "__side", inside.alias(value)).agg(F.count(F.lit(1)).alias("__n"))
    cells = written(cells, "cells")
    below = F.coalesce(F.sum(F.when(F.col("__side") == -1, F.col("__n"))), F.lit(0))
    within = F.coalesce(F.sum(F.when(F.col("__side") == 0, F.col("__n"))), F.lit(0))
    sizes = cells.groupBy(*keys).agg(
        F.sum("__n").alias("__size"), below.alias("__below"), within.alias("__within"), F.count(F.lit(1)).alias("__cells")
    )
    low, high = F.floor((F.col("__size") + 1) / 2), F.floor((F.col("__size") + 2) / 2)
    missed = (low <= F.col("__below")) | (high > F.col("__below") + F.col("__within"))
    widest, wrong = sizes.agg(F.max("__cells"), F.bool_or(missed)).first()
    if wrong:
        return _median_by_ranks(rows, keys, value, name)
    middle = cells.filter("__side = 0").drop("__side")
    if widest <= BLOCK:
        earlier = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        placed = middle.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    else:
        placed = running_total(middle, keys, [value], "__n", "__before")
    joined = match_keys(placed, sizes, keys, small=not keys)
    joined = joined.withColumn("__before", F.col("__before") + F.col("__below"))
    return _middle_of(joined, keys, value, name)


def _median_by_ranks(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    counted = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    ranged = spread_in_order(counted, keys, [value])
    placed = total_before(ranged, keys, [value], "__n", "__before")
    sizes = ranged.groupBy(*keys).agg(F.sum("__n").alias("__size"))
    return _middle_of(match_keys(placed, sizes, keys, small=not keys), keys, value, name)


def _middle_of(placed: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The median from different values with their count `__n`, how many come `__before` and the group's `__size`."""
    low, high = F.floor((F.col("__size") + 1) / 2), F.floor((F.col("__size") + 2) / 2)

    def covers(rank: Column) -> Column:
        return (F.col("__before") < rank) & (F.col("__before") + F.col("__n") >= rank)

    middle = placed.filter(covers(low) | covers(high))
    return middle.groupBy(*keys).agg(((F.min(value) + F.max(value)) / 2).alias(name))


def ordered_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    item: str,
    name: str,
    piece: int = BLOCK,
    copies: str | None = None,
) -> DataFrame:
    """The items of each key in order, as arrays of at most `piece` items.

    A key with up to `piece` items is one row with `piece_no` 0, the usual ordered array; a larger one continues in further
    rows, so no task ever holds a whole group. Null items are kept. `copies` names a column saying how often a row counts.
    """
    keys, order = list(keys), list(order)
    sort = order + ([item] if item not in order else [])
    weight = F.count(F.lit(1)) if copies is None else F.sum(copies)
    counted = df.groupBy(*keys, *sort).agg(weight.alias("__n"))
    placed = running_total(counted, keys, sort, "__n", "__before")
    end = F.col("__before") + F.col("__n")
    number = F.explode(
        F.sequence(F.floor(F.col("__before") / piece), F.floor((end - 1) / piece))
    ).alias("piece_no")
    spread = placed.select(*keys, item, "__before", end.alias("__end"), number)
    start = F.greatest(F.col("__before"), F.col("piece_no") * piece)
    stop = F.least(F.col("__end"), (F.col("piece_no") + 1) * piece)
    runs = spread.select(
        *keys,
        "piece_no",
        F.struct(
            start.alias("at"), F.array_repeat(F.col(item), (stop - start).cast("int")).alias("run")
        ).alias("__run"),
    )
    gathered = F.array_sort(F.collect_list("__run"))
    return runs.groupBy(*keys, "piece_no").agg(
        F.flatten(F.transform(gathered, lambda run: run["run"])).alias(name)
    )
