"""Sequences, item vectors and forecasts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path, written

# The skip-gram setting; wrong contexts per right one, drawn by count ** 0.75, and the step of the updates.
VECTOR_SIZE, WINDOW_SIZE, MIN_COUNT = 48, 5, 2
NEGATIVES, SMOOTHING, RATE = 5, 0.75, 0.1
# A model of more floats is refused.
VOCABULARY_FLOATS = 2**31 - 1
# Items of a block at most: a task holds the vectors of two blocks. Blocks smaller than the second only cost more rounds, and
# rounds beyond the third are only worth it for memory.
BLOCK_ITEMS, SMALL_BLOCK, SPREAD = 200_000, 10_000, 32
# Items in one row of the state, pairs in one step, wrong contexts drawn for a step, and pairs a task holds before it hands them on.
ROW_ITEMS, STEP, DRAWN, HELD = 256, 8_192, 16, 262_144
ROW_GROUP = 8 << 20
STATE = "kind int, block int, at bigint, items array<string>, keys binary, vectors binary, squares binary, counts binary"
CENTERS, CONTEXTS, PAIRS = 0, 1, 2
SERIES_END = 20
WIDTH = 1.96


def skip_gram(
    lists: DataFrame, items: str, partitions: int | None = None, seed: int = 42, iterations: int = 1
) -> DataFrame:
    """Item vectors (`item`, `vector`) trained on ordered lists: skip-gram with negative sampling and a step per item (Adagrad).

    No process holds the model. Items are dealt to n blocks by a hash. In each of n rounds every task trains the vectors of one block of
    items on their contexts in one other block, and no two tasks of a round share a block; after n rounds each pair has been used once.
    Between rounds the vectors are a table. The size of the vocabulary is counted first and a model that is too large is refused.
    """
    spark = lists.sparkSession
    # training passes over the lists several times, so they are written once
    words = written(lists.select(F.transform(F.col(items), lambda x: x.cast("string")).alias("items")), "lists")
    counted = written(words.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n")), "counted")
    for salt in count():  # until no two items have the same key
        key = partial(F.xxhash64, F.lit(salt))
        sizes = counted.agg(
            F.count_if(F.col("n") >= MIN_COUNT), F.count_if(F.col("n") < MIN_COUNT), F.count(F.lit(1)), F.count_distinct(key(F.col("item")))
        )
        vocabulary, rare, different, keys = sizes.first()
        if keys == different:
            break
    if vocabulary * VECTOR_SIZE > VOCABULARY_FLOATS:
        raise ValueError(f"{vocabulary} items x {VECTOR_SIZE} exceed one Word2Vec model")
    blocks = partitions or _blocks(vocabulary, spark.sparkContext.defaultParallelism)
    known = counted.filter(F.col("n") >= MIN_COUNT).select("item", key(F.col("item")).alias("key"), "n")
    rounds = _Rounds(spark, _first_state(known, blocks, seed))
    tokens = words.select(F.transform("items", lambda x: key(x)).alias("keys"))
    if rare:  # windows count known items only
        unknown = counted.filter(F.col("n") < MIN_COUNT).select(key(F.col("item")).alias("key"))
        numbered = tokens.withColumn("list", F.monotonically_increasing_id())  # beside posexplode it would number the places
        places = numbered.select("list", F.posexplode("keys").alias("place", "key"))
        kept = places.join(unknown, "key", "left_anti").groupBy("list").agg(F.array_sort(F.collect_list(F.struct("place", "key"))).alias("kept"))
        tokens = kept.select(F.transform("kept", lambda x: x["key"]).alias("keys"))
    tokens = written(tokens.filter(F.size("keys") > 1), "tokens")
    for turn in range(iterations * blocks):
        rounds.play(tokens, blocks, turn % blocks, (seed, turn))
    return _vectors(rounds.state)


def _blocks(vocabulary: int, cores: int) -> int:
    """As many blocks as memory asks for, in whole waves of tasks, or as cores can use."""
    needed = -(-vocabulary // BLOCK_ITEMS)
    if needed > cores:
        return -(-needed // cores) * cores if cores <= SPREAD else needed
    return max(needed, min(cores, SPREAD, -(-vocabulary // SMALL_BLOCK)), 1)


class _Rounds:
    """The model between rounds: one table, which replaces the one before."""

    def __init__(self, spark: SparkSession, first: DataFrame):
        self.spark, self.path = spark, None
        self._keep(first)

    def _keep(self, state: DataFrame) -> None:
        path, before = scratch_path(self.spark, "model"), self.path
        # a reader takes a row group at a time, and rows are large
        state.write.option("parquet.block.size", ROW_GROUP).parquet(path, compression="uncompressed")
        self.path, self.state = path, self.spark.read.schema(state.schema).parquet(path)
        if before:  # nothing reads it any more
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def play(self, tokens: DataFrame, blocks: int, turn: int, seeds: tuple[int, int]) -> None:
        """Each block of items meets the contexts `turn` blocks further on."""
        place = F.when(F.col("kind") == CONTEXTS, F.pmod(F.col("block") - turn, F.lit(blocks))).otherwise(F.col("block"))
        batch = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
        before = {name: self.spark.conf.get(name) for name in batch}
        try:
            for name, value in batch.items():
                self.spark.conf.set(name, value)
            rows = self.state.unionByName(tokens.mapInArrow(_pairs(blocks, turn), STATE))
            dealt = rows.withColumn("task", place.cast("int")).repartitionById(blocks, "task").sortWithinPartitions("kind", "at")
            self._keep(dealt.mapInArrow(_training(blocks, turn, seeds), STATE))
        finally:
            for name, value in before.items():
                self.spark.conf.set(name, value)


def _first_state(known: DataFrame, blocks: int, seed: int) -> DataFrame:
    """Rows of ROW_ITEMS items in the order of their keys: small random vectors as items, zeros as contexts."""
    width, size, centers, contexts = VECTOR_SIZE, ROW_ITEMS, CENTERS, CONTEXTS

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        at = 0
        for batch in batches:
            for part in (batch.slice(i, size) for i in range(0, len(batch), size)):
                items, block, keys, counts = (part.column(name) for name in ("item", "block", "key", "n"))
                n, block = len(part), block[0].as_py()
                vectors = (np.random.default_rng((seed, block, at)).random((n, width), np.float32) - 0.5) / width
                both = {
                    "kind": pa.array([centers, contexts], pa.int32()),
                    "block": pa.array([block, block], pa.int32()),
                    "at": pa.array([at, at], pa.int64()),
                    "items": pa.array([items.to_pylist(), None], pa.list_(pa.string())),
                    "keys": pa.array([keys.to_numpy().tobytes()] * 2, pa.binary()),
                    "vectors": pa.array([vectors.tobytes(), np.zeros_like(vectors).tobytes()], pa.binary()),
                    "squares": pa.array([np.zeros(n, np.float32).tobytes()] * 2, pa.binary()),
                    "counts": pa.array([None, counts.to_numpy().tobytes()], pa.binary()),
                }
                at += 1
                yield pa.RecordBatch.from_pydict(both)

    dealt = known.withColumn("block", F.pmod("key", F.lit(blocks)).cast("int")).repartitionById(blocks, "block")
    return dealt.sortWithinPartitions("key").mapInArrow(start, STATE)


def _pairs(blocks: int, turn: int):
    """The pairs of an item and a context of one round, as rows of many pairs: `keys` has the items, `vectors` the contexts."""
    window, limit, kind = WINDOW_SIZE, HELD, PAIRS

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        at, held, number = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal at
            item, context = (np.concatenate(side) for side in zip(*held))
            block = np.mod(item, blocks)
            order = np.argsort(block, kind="stable")
            item, context, block = item[order], context[order], block[order]
            cuts = np.flatnonzero(np.diff(block, prepend=-1))
            ends = [*cuts[1:], len(block)]
            n = len(cuts)
            found = {
                "kind": pa.array([kind] * n, pa.int32()),
                "block": pa.array(block[cuts].astype(np.int32)),
                "at": pa.array(range(at, at + n), pa.int64()),
                "items": pa.nulls(n, pa.list_(pa.string())),
                "keys": pa.array([item[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                "vectors": pa.array([context[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                "squares": pa.nulls(n, pa.binary()),
                "counts": pa.nulls(n, pa.binary()),
            }
            at += n
            return pa.RecordBatch.from_pydict(found)

        for batch in batches:
            lists = batch.column(0)
            keys, sizes = lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy()
            number_of = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            # each place has a window of its own, 1 to `window`, the same in every round
            mixed = (keys.view(np.uint64) + place.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            reach = (mixed >> np.uint64(33)) % np.uint64(window) + np.uint64(1)
            block = np.mod(keys, blocks)
            for far in range(1, min(window, int(sizes.max(initial=1)) - 1) + 1):
                near = number_of[far:] == number_of[:-far]
                ahead = np.mod(block[far:] - block[:-far], blocks)
                right = np.flatnonzero(near & (reach[:-far] >= far) & (ahead == turn))
                left = np.flatnonzero(near & (reach[far:] >= far) & (ahead == (blocks - turn) % blocks))
                for item, context in ((right, right + far), (left + far, left)):
                    if len(item):
                        held.append((keys[item], keys[context]))
                        number += len(item)
            if number >= limit:
                yield flush()
                held, number = [], 0
        if held:
            yield flush()

    return pairs


def _training(blocks: int, turn: int, seeds: tuple[int, int]):
    """One task of a round: it reads its two blocks, then the pairs row by row, and gives the blocks back."""
    width, size, step, drawn, negatives, smoothing, rate = VECTOR_SIZE, ROW_ITEMS, STEP, DRAWN, NEGATIVES, SMOOTHING, RATE
    centers, contexts, pairs = CENTERS, CONTEXTS, PAIRS

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        parts: dict[int, list[dict]] = {centers: [], contexts: []}
        model: dict[int, dict] = {}
        random = np.random.default_rng((*seeds, TaskContext.get().partitionId()))
        chances = np.zeros(0)

        def numbers(kind: int, name: str, dtype: type) -> np.ndarray:
            return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(part.pop(name), dtype) for part in parts[kind])])

        def assemble() -> None:
            nonlocal chances
            for kind in parts:
                model[kind] = {"keys": numbers(kind, "keys", np.int64), "vectors": numbers(kind, "vectors", np.float32).reshape(-1, width)}
                model[kind]["squares"] = numbers(kind, "squares", np.float32)
            model[contexts]["counts"] = numbers(contexts, "counts", np.int64)
            chances = np.cumsum(model[contexts]["counts"].astype(np.float64) ** smoothing)

        def found(kind: int, keys: np.ndarray) -> np.ndarray:
            known = model[kind]["keys"]
            rows = np.searchsorted(known, keys)
            if not np.array_equal(known.take(rows, mode="clip"), keys):
                raise KeyError("an item is not in the block its pairs were dealt to")
            return rows

        def move(side: dict, rows: np.ndarray, gradient: np.ndarray) -> None:
            """Add up what each row gets and take a step that shrinks with all it got before."""
            order = np.argsort(rows)
            rows = rows[order]
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            total, rows = np.add.reduceat(gradient[order], first, axis=0), rows[first]
            side["squares"][rows] += np.einsum("ij,ij->i", total, total) / width
            side["vectors"][rows] += rate * total / np.sqrt(side["squares"][rows] + 1e-10)[:, None]

        def learn(item: np.ndarray, context: np.ndarray) -> None:
            one, two = model[centers], model[contexts]
            u, v = one["vectors"][item], two["vectors"][context]
            missing = (1 / (1 + np.exp(np.einsum("ij,ij->i", u, v).clip(-30, 30))))[:, None]
            other = np.searchsorted(chances, random.random(drawn) * chances[-1], side="right").clip(max=len(chances) - 1)
            w = two["vectors"][other]
            wrong = np.float32(negatives / drawn) / (1 + np.exp(-(u @ w.T).clip(-30, 30)))
            wrong[context[:, None] == other] = 0
            move(one, item, missing * v - wrong @ w)
            move(two, np.concatenate([context, other]), np.concatenate([missing * u, -(wrong.T @ u)]))

        for batch in batches:
            for row in range(len(batch)):
                kind = batch.column("kind")[row].as_py()
                if kind != pairs:
                    parts[kind].append({name: batch.column(name)[row].as_py() for name in ("items", "keys", "vectors", "squares", "counts")})
                    continue
                if not model:
                    assemble()
                item, context = (np.frombuffer(batch.column(name)[row].as_buffer(), np.int64) for name in ("keys", "vectors"))
                shuffled = random.permutation(len(item))
                item, context = found(centers, item[shuffled]), found(contexts, context[shuffled])
                for i in range(0, len(item), step):
                    learn(item[i : i + step], context[i : i + step])
        if not model:
            assemble()
        mine = TaskContext.get().partitionId()
        names = [item for part in parts[centers] for item in part["items"]]
        for kind, block in ((centers, mine), (contexts, (mine + turn) % blocks)):
            side = model[kind]
            for at, i in enumerate(range(0, len(side["keys"]), size)):
                piece = slice(i, i + size)
                yield pa.RecordBatch.from_pydict(
                    {
                        "kind": pa.array([kind], pa.int32()),
                        "block": pa.array([block], pa.int32()),
                        "at": pa.array([at], pa.int64()),
                        "items": pa.array([names[piece] if kind == centers else None], pa.list_(pa.string())),
                        **{name: pa.array([side[name][piece].tobytes()], pa.binary()) for name in ("keys", "vectors", "squares")},
                        "counts": pa.array([side["counts"][piece].tobytes() if kind == contexts else None], pa.binary()),
                    }
                )

    return train


def _vectors(state: DataFrame) -> DataFrame:
    width = VECTOR_SIZE

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for items, vectors in zip(batch.column("items"), batch.column("vectors")):
                values = pa.array(np.frombuffer(vectors.as_buffer(), np.float32).astype(np.float64))
                ends = pa.array(np.arange(len(items) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays([items.values.cast(pa.string()), pa.ListArray.from_arrays(ends, values)], ["item", "vector"])

    rows = state.filter(F.col("kind") == CENTERS).select("items", "vectors")
    return rows.mapInArrow(unpack, "item string, vector array<double>")


def daily_counts(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per day (`ds`, `y`) and key: a training series."""
    return df.groupBy(*keys, F.to_date(ts).alias("ds")).agg(F.count(F.lit(1)).alias("y"))


def forecast(series: DataFrame, keys: Sequence[str], periods: int = SERIES_END) -> DataFrame:
    """Fitted history and `periods` further days per series: linear trend plus weekday effect, with 95% bounds.

    One aggregate gathers the normal equations of each series and weekday (counts, sums, squares and products of day and value);
    trend, effects and spread follow from its at most seven rows per series, so partial results merge in any order and millions of
    series are one job. A series needs two days to have a trend; with one it stays level.
    """
    if not keys:  # one series: a constant key keeps the joins below ordinary
        return forecast(series.withColumn("__series", F.lit(1)), ["__series"], periods).drop("__series")
    keys = list(keys)
    # days from a point near by, so that squares and products of days stay whole numbers that doubles hold
    origin = F.lit("2000-01-01").cast("date")
    points = series.select(*keys, "ds", F.datediff("ds", origin).cast("double").alias("t"), F.col("y").cast("double").alias("y"))
    moments = points.filter(F.col("y").isNotNull()).groupBy(*keys, F.dayofweek("ds").alias("weekday")).agg(
        F.count(F.lit(1)).alias("n"), *_sums(t=F.col("t"), y=F.col("y"), tt=F.col("t") * F.col("t"), ty=F.col("t") * F.col("y"), yy=F.col("y") * F.col("y")),
        F.max("ds").alias("last"),
    )
    names = ["n", "t", "y", "tt", "ty", "yy"]
    whole = moments.groupBy(*keys).agg(
        *_sums(**{name: F.col(name) for name in names}), F.max("last").alias("last"), F.collect_list(F.struct("weekday", *names)).alias("days")
    )
    spread_t = F.col("tt") - F.col("t") * F.col("t") / F.col("n")
    slope = F.when(spread_t > 0, (F.col("ty") - F.col("t") * F.col("y") / F.col("n")) / spread_t).otherwise(0.0)
    whole = whole.select(*keys, "last", "days", "n", slope.alias("slope"), (F.col("t") / F.col("n")).alias("mean_t"), (F.col("y") / F.col("n")).alias("mean_y"))

    def line(t: Column) -> Column:
        return F.col("mean_y") + F.col("slope") * (t - F.col("mean_t"))

    def left(day: Column) -> Column:
        """Squares left around the trend within a weekday."""
        around = lambda product, one, two: day[product] - day[one] * day[two] / day["n"]
        tilt = F.col("slope")
        return around("yy", "y", "y") - 2 * tilt * around("ty", "t", "y") + tilt * tilt * around("tt", "t", "t")

    effects = F.map_from_entries(F.transform("days", lambda d: F.struct(d["weekday"], d["y"] / d["n"] - line(d["t"] / d["n"]))))
    squares = F.aggregate("days", F.lit(0.0), lambda total, d: total + left(d))
    model = whole.select(
        *keys, "last", "slope", "mean_t", "mean_y", effects.alias("effects"), F.sqrt(F.greatest(squares, F.lit(0.0)) / F.col("n")).alias("spread")
    )
    ahead = model.select(*keys, F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", periods))).alias("ds"))
    days = points.select(*keys, "ds").unionByName(ahead)
    ready = days.join(model, keys)
    value = line(F.datediff("ds", origin)) + F.coalesce(F.try_element_at("effects", F.dayofweek("ds")), F.lit(0.0))
    margin = F.col("spread") * WIDTH
    return ready.select(
        *keys,
        "ds",
        value.alias("yhat"),
        (value - margin).alias("yhat_lower"),
        (value + margin).alias("yhat_upper"),
    )


def _sums(**what: Column) -> list[Column]:
    return [F.sum(column).alias(name) for name, column in what.items()]
