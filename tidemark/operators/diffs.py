"""Comparing and combining versions of a keyed table: row and schema diffs, three-way merge, change feeds.

Diffs put both sides through one grouped aggregation (union, then group by key) instead of a full outer join: map-side
partial aggregation absorbs hot keys, and only keys with a 64-bit row hash are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import widens
from tidemark.operators.joins import match_keys
from tidemark.session import written


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of the columns in which a null differs from every value and from a shifted neighbour."""
    return F.xxhash64(F.lit(len(columns)), *[part for name in columns for part in (F.col(name), F.col(name).isNull())])


def same_types(sides: Sequence[DataFrame]) -> list[DataFrame]:
    """The versions with one type per column: the widest of the numbers; any other difference is refused."""
    if len({frozenset(df.columns) for df in sides}) > 1:
        raise ValueError("the versions have different columns; compare their schemas first")
    wide = {}
    for name in sides[0].columns:
        kinds = [df.schema[name].dataType for df in sides]
        fit = [kind for kind in kinds if all(widens(other, kind) for other in kinds)]
        if not fit:
            found = ", ".join(kind.simpleString() for kind in kinds)
            raise ValueError(f"no type of {name} holds the values of all versions: {found}")
        wide[name] = fit[0]
    return [df.select(*[F.col(n).cast(wide[n]).alias(n) for n in sides[0].columns]) for df in sides]


def _sides(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [name for name in before.columns if name not in keys]
    before, after = same_types([before, after])
    tagged = before.select(*keys, F.lit(0).alias("side"), row_hash(values).alias("hash")).unionByName(
        after.select(*keys, F.lit(1).alias("side"), row_hash(values).alias("hash"))
    )

    def of(side: int) -> Column:
        return F.when(F.col("side") == side, F.col("hash"))

    return tagged.groupBy(*keys).agg(
        F.max(of(0)).alias("old"),
        F.max(of(1)).alias("new"),
        F.count(of(0)).alias("old_rows"),
        F.count(of(1)).alias("new_rows"),
    )


def diff_rows(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with `change` added, removed or changed. A key repeated on either side raises when the result is read."""
    grouped = _sides(before, after, keys)
    repeated = (F.col("old_rows") > 1) | (F.col("new_rows") > 1)
    change = (
        F.when(repeated, F.raise_error(F.lit("duplicate key in a keyed diff")).cast("string"))
        .when(F.col("old_rows") == 0, F.lit("added"))
        .when(F.col("new_rows") == 0, F.lit("removed"))
        .when(F.col("old") != F.col("new"), F.lit("changed"))
    )
    return grouped.select(*keys, change.alias("change")).filter(F.col("change").isNotNull())


def diff_bags(before: DataFrame, after: DataFrame) -> DataFrame:
    """Keyless diff: every differing row with `delta`, the copies gained (positive) or lost (negative)."""
    columns = before.columns
    signed = before.withColumn("delta", F.lit(-1)).unionByName(after.withColumn("delta", F.lit(1)))
    return signed.groupBy(*columns).agg(F.sum("delta").alias("delta")).filter("delta <> 0")


def diff_names(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Set difference both ways by key: `added` is only after, `removed` only before."""
    old, new = before.select(key).distinct(), after.select(key).distinct()
    added = new.join(old, key, "left_anti").withColumn("change", F.lit("added"))
    removed = old.join(new, key, "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def diff_schema(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row per column that was added, removed or retyped."""
    old = {f.name: f.dataType.simpleString() for f in before.schema}
    new = {f.name: f.dataType.simpleString() for f in after.schema}
    found = []
    for name in [*old, *[n for n in new if n not in old]]:
        change = "added" if name not in old else "removed" if name not in new else "retyped"
        if old.get(name) != new.get(name):
            found.append((name, change, old.get(name), new.get(name)))
    return before.sparkSession.createDataFrame(
        found, "column string, change string, old_type string, new_type string"
    )


def merge_rows(
    base: DataFrame, ours: DataFrame, theirs: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Keyed three-way merge: (merged, conflicts).

    A key both sides changed since `base` to different rows is a conflict, with both changes named; the same change on both
    sides is not. A key changed on one side takes that side. Conflicting keys are left out of `merged`, which should be
    published only when `conflicts` is empty. The comparison runs at once; a key repeated on one side raises.
    """
    values = [name for name in base.columns if name not in keys]
    sides = base, ours, theirs = same_types([base, ours, theirs])
    tagged = reduce(
        DataFrame.unionByName,
        [
            df.select(*keys, F.lit(i).alias("side"), row_hash(values).alias("hash"))
            for i, df in enumerate(sides)
        ],
    )

    def state(side: int) -> Column:
        return F.max(F.when(F.col("side") == side, F.col("hash")))

    def copies(side: int) -> Column:
        return F.count_if(F.col("side") == side)

    grouped = tagged.groupBy(*keys).agg(
        state(0).alias("b"),
        state(1).alias("o"),
        state(2).alias("t"),
        F.greatest(copies(0), copies(1), copies(2)).alias("copies"),
    )
    ours_changed = ~F.col("o").eqNullSafe(F.col("b"))
    theirs_changed = ~F.col("t").eqNullSafe(F.col("b"))
    differ = ~F.col("o").eqNullSafe(F.col("t"))
    decided = grouped.select(
        *keys,
        "b",
        "o",
        "t",
        F.when(F.col("copies") > 1, F.raise_error(F.lit("duplicate key in a keyed merge")).cast("string"))
        .when(ours_changed & theirs_changed & differ, F.lit("conflict"))
        .when(theirs_changed & differ, F.lit("theirs"))
        .otherwise(F.lit("ours"))
        .alias("take"),
    )

    def kind(side: str) -> Column:
        return (
            F.when(F.col("b").isNull(), F.lit("added"))
            .when(F.col(side).isNull(), F.lit("removed"))
            .otherwise(F.lit("changed"))
        )

    # Only the keys that do not simply stay ours are written down, once, and serve all three results below.
    foreign = written(
        decided.filter("take <> 'ours'").select(
            *keys, "take", kind("o").alias("ours_change"), kind("t").alias("theirs_change")
        ),
        "merge",
    )
    conflicts = foreign.filter("take = 'conflict'").drop("take")
    taken = foreign.filter("take = 'theirs'").select(*keys)
    merged = match_keys(ours, foreign.select(*keys), keys, "left_anti").unionByName(
        match_keys(theirs, taken, keys, "left_semi")
    )
    return merged, conflicts


def latest_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last change of every key: a struct maximum, combined map-side, so a hot key costs one row per task.

    Of changes equal in `order`, the one with the largest other columns counts, so that the outcome is the same every time.
    """
    rest = [name for name in changes.columns if name not in (*keys, *order)]
    ties = [name for name in rest if "map<" not in changes.schema[name].dataType.simpleString()]
    newest = F.max_by(F.struct(*order, *rest), F.struct(*order, *ties)).alias("__newest")
    return changes.groupBy(*keys).agg(newest).select(*keys, "__newest.*").select(*changes.columns)


def apply_changes(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op"
) -> DataFrame:
    """Apply a feed of insert, update and delete rows to a keyed table; only the last change of a key counts.

    Case does not matter in `op`; a null or any other word fails the job.
    """
    what = F.lower(op)
    wrong = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(F.col(op), F.lit("null")))).cast("boolean")
    stays = F.when(what == "delete", False).when(what.isin("insert", "update"), True).otherwise(wrong)
    last = latest_changes(changes, keys, order)
    touched = last.select(*keys)
    kept = match_keys(base, touched, keys, "left_anti")
    return kept.unionByName(last.filter(stays).select(*base.columns))
