"""Count hashes over a whole corpus and hand each count back to the texts it came from, without moving texts or positions.

Documents are laid down once as compressed chunks in the shared folder. A chunk sends its distinct hashes, sorted and written as
differences, to buckets of the hash space: some six bytes a hash, copies within the chunk already counted. A bucket adds up and
answers each chunk with one byte per hash in the order received, so neither documents nor positions travel. A hash that a third
of all rows hold arrives once per chunk. The chunk then computes its hashes again and reads the counts off.
"""

from __future__ import annotations

import ctypes
import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import written

# Bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK_BYTES = 8 << 20
# Bytes of text worked on at a time where each document is judged on its own; a longer document is a slice of its own.
SLICE_BYTES = 2 << 20
# Hashes that one bucket should hold.
BUCKET_HASHES = 1 << 21
# Above this the answer is a logarithm, eight steps for each doubling.
EXACT = 127


def small_batches(spark: SparkSession) -> None:
    """Rows with whole texts go to Python few megabytes at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2m")


def give_back() -> None:
    """Return freed memory to the system, as several Python workers and a JVM share an executor's room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it, other C libraries need not
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The rows of `batch` in slices of few bytes of text, since temporary arrays take many times their text."""
    lengths = pc.binary_length(batch.column(text).cast(pa.binary())).fill_null(0).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(lengths):
        take = max(1, int(np.searchsorted(np.cumsum(lengths[at:] + 1), SLICE_BYTES, "right")))
        yield batch.slice(at, take)
        give_back()
        at += take


def parts_of(table: pa.Table, text: str) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk's table, in order, in slices of few bytes of text."""
    for part in table.combine_chunks().to_batches():
        yield from slices(part, text)


def level(counts: np.ndarray) -> np.ndarray:
    """A count as one byte: itself up to EXACT, then a logarithm."""
    high = EXACT + np.ceil(8 * np.log2(np.maximum(counts, EXACT) / EXACT))
    return np.where(counts <= EXACT, counts, np.minimum(high, 255)).astype(np.uint8)


def count_of(levels: np.ndarray) -> np.ndarray:
    """About the count a level stands for."""
    x = levels.astype(np.float64)
    return np.where(x <= EXACT, x, EXACT * 2 ** ((x - EXACT) / 8))


def as_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 5))) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def as_table(raw: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.py_buffer(raw)) as source:
        return source.read_all()


def lay_chunks(docs: DataFrame, text: str) -> DataFrame:
    """Write `docs`, all their columns, as rows (chunk, n_bytes, docs); read the result with `as_table`.

    Chunk names ascend with the partitions of `docs` and the rows in them.
    """
    small_batches(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), itertools.count()

        def row(held: list[pa.RecordBatch], n: int) -> pa.RecordBatch:
            blob = as_bytes(pa.Table.from_batches(held))
            return pa.RecordBatch.from_pydict(
                {"chunk": [f"{part:08d}-{next(made):06d}"], "n_bytes": pa.array([n], pa.int64()), "docs": pa.array([blob], pa.binary())}
            )

        held, size = [], 0
        for batch in batches:
            lengths = pc.binary_length(batch.column(text).cast(pa.binary())).fill_null(0).to_numpy(zero_copy_only=False)
            at = 0
            while at < len(lengths):
                total = size + np.cumsum(lengths[at:] + 1)
                take = max(1, int(np.searchsorted(total, CHUNK_BYTES, "right")))
                held.append(batch.slice(at, take))
                size, at = int(total[take - 1]), at + take
                if size >= CHUNK_BYTES or at < len(lengths):
                    yield row(held, size)
                    held, size = [], 0
        if held:
            yield row(held, size)

    # compressed already: a codec's buffers outside the heap would grow to whole pages of chunks and stay
    return written(docs.mapInArrow(pack, "chunk string, n_bytes long, docs binary"), "chunks", "none")


def encode(keys: np.ndarray, extra: np.ndarray | None, counts: np.ndarray) -> bytes:
    """Sorted keys as differences of the fewest bytes, a 16-bit check for each if there is one, and the counts above one."""
    steps = np.diff(keys, prepend=np.uint64(0))
    drop = np.uint64(0 if (steps & np.uint64(0xFFFF)).any() else 16)
    steps >>= drop
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    body = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
    many = np.flatnonzero(counts > 1)
    head = np.array([len(keys), width, len(many), extra is not None, drop], "<u8").tobytes()
    more = [] if extra is None else [extra.astype("<u2").tobytes()]
    return b"".join([head, many.astype("<u4").tobytes(), counts[many].astype("<u8").tobytes(), *more, body])


def decode(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, width, many, checked, drop = (int(x) for x in np.frombuffer(raw, "<u8", 5))
    at, places = np.frombuffer(raw, "<u4", many, 40), np.frombuffer(raw, "<u8", many, 40 + 4 * many)
    counts = np.ones(n, np.int64)
    counts[at] = places
    extra = np.frombuffer(raw, "<u2", n, 40 + 12 * many) if checked else np.zeros(n, np.uint16)
    body = np.frombuffer(raw, np.uint8, n * width, 40 + 12 * many + 2 * n * checked).reshape(n, width)
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :width] = body
    return np.cumsum(steps.view("<u8").ravel() << np.uint64(drop), dtype=np.uint64), extra, counts


def distinct(keys: np.ndarray, extra: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
    """Sorted distinct keys (with their checks), how often each occurs, and for each key given its place among them."""
    order = np.argsort(keys, kind="stable") if extra is None else np.lexsort((extra, keys))
    k = keys[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    e = None
    if extra is not None:
        e = extra[order]
        new[1:] |= e[1:] != e[:-1]
    # a bucket or chunk holds few millions, so places take four bytes
    rank = np.cumsum(new, dtype=np.int32 if len(k) < 1 << 31 else np.int64)
    rank -= 1
    place = np.empty_like(rank)
    place[order] = rank
    del order, rank
    first = np.flatnonzero(new)
    return k[first], None if e is None else e[first], np.diff(first, append=len(k)), place


Extract = Callable[[dict], tuple[np.ndarray, np.ndarray | None]]


def count_hashes(chunks: DataFrame, extract: Extract, bytes_per_hash: float, name: str, earlier: bool = False) -> DataFrame:
    """`chunks` with a column `name`: for each distinct key of the chunk in ascending order, the level of its corpus count.

    `extract` gets a row of `chunks` as a dict and returns its keys (64 bits, repeats allowed) and a 16-bit check for each, or None.
    `bytes_per_hash` only sets the number of buckets. With `earlier`, a key's first chunk gets 1, whatever comes later. Use
    `levels_of` to read the column.
    """
    size = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    bits = max(6, min(18, int(np.ceil(np.log2(max(1, size / bytes_per_hash / BUCKET_HASHES))))))
    columns = chunks.columns

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in columns}
                k, e, n, _ = distinct(*extract(row))
                cuts = np.searchsorted(k, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() + [len(k)]
                full = [b for b in range(1 << bits) if cuts[b] < cuts[b + 1]]
                blobs = [
                    encode(k[cuts[b] : cuts[b + 1]], None if e is None else e[cuts[b] : cuts[b + 1]], n[cuts[b] : cuts[b + 1]])
                    for b in full
                ]
                del k, e, n
                # few buckets at a time, as the JVM takes a batch whole outside its heap
                for at in range(0, len(full), 8):
                    own = full[at : at + 8]
                    yield pa.RecordBatch.from_pydict(
                        {"bucket": pa.array(own, pa.int32()), "chunk": pa.array([row["chunk"]] * len(own), pa.string()),
                         "keys": pa.array(blobs[at : at + 8], pa.binary())}
                    )
                del row, blobs
                give_back()

    def answer(group: pa.Table) -> pa.Table:
        give_back()
        group = group.sort_by("chunk")
        parts = [decode(x.as_py()) for x in group.column("keys")]
        ends = np.cumsum([len(p[0]) for p in parts])[:-1]
        keys, extra, counts = (np.concatenate(x) for x in zip(*parts))
        del parts
        place = distinct(keys, extra)[3]
        del keys, extra
        total = np.bincount(place, counts).astype(np.int64)
        found = level(total)[place]
        if earlier:
            found[np.unique(place, return_index=True)[1]] = 1
        levels = np.split(found, ends)
        return pa.table(
            {"bucket": group.column("bucket"), "chunk": group.column("chunk"),
             "levels": pa.array([zlib.compress(x.tobytes(), 1) for x in levels], pa.binary())}
        )

    sent = chunks.mapInArrow(send, "bucket int, chunk string, keys binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, "bucket int, chunk string, levels binary")
    # one byte per hash of a chunk, so a list is as bounded as the chunk is
    gathered = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "levels"))).alias("parts"))
    gathered = gathered.select("chunk", F.col("parts.levels").alias(name))
    return chunks.join(gathered, "chunk", "left")


def levels_of(parts: list[bytes] | None) -> np.ndarray:
    """The column `count_hashes` adds, as one array in the order of the chunk's distinct keys."""
    return np.frombuffer(b"".join(zlib.decompress(x) for x in parts or []), np.uint8)


def each_chunk(chunks: DataFrame, work: Callable[[dict], pa.Table | Iterator[pa.Table]], schema: str) -> DataFrame:
    """Apply `work` to every row of `chunks`, given as a dict; it returns a table or yields several."""
    columns = chunks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = work({c: batch.column(c)[i].as_py() for c in columns})
                for table in [made] if isinstance(made, pa.Table) else made:
                    yield from table.to_batches(max_chunksize=2000)
                made = table = None
                give_back()

    return chunks.mapInArrow(run, schema)
