"""Cross-tokenizer alignment by inverted pair bitmaps: which tokens of one vocabulary lie over which of another, corpus-wide.

A text, with a blank before it, is encoded by a byte-level BPE (A) and a sentencepiece BPE (B). Where tokens of both end, a group
ends; tokens whose byte ranges overlap are linked. Tokens of neither cross a blank between two visible characters, so texts are cut
there, and each different piece is encoded and aligned once a task.

The index is laid once, by chunks of documents: for each pair of ids (a, b), bitmaps over the chunk's documents, one for each binary
digit of the pair's link count in a document (multiplicity planes). Rare pairs hold document numbers, frequent ones bits. OR-merging
a pair's planes and counting bits gives its documents, 2^k times the bits of plane k its links; only these two numbers leave the
chunk, are summed by pair, and come back as scores, which the chunk's postings return to its documents. Neither texts nor bitmaps
are shuffled, and a pair that all documents hold is one row per chunk.

Null and empty texts have no tokens, nor have texts whose tokens' bytes differ from the text (such as those with U+2581, which B
writes as a blank): zeros, and '' instead of a digest. Special tokens' names inside texts are plain text. Repeated rows count as often
as they occur. Ties for a B id's best count all win.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import CHUNK_BYTES, as_bytes, as_table, give_back, slices, small_batches
from tidemark.llm.text import hash_spans, lay, mix
from tidemark.llm.vocabulary import Memo, gather
from tidemark.session import written

MARK = "▁"
HEAD = 4  # values in front of a piece's pairs: sound, tokens of A, tokens of B, groups
REPORT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: visible Latin-1 letters for themselves, others from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in seen]
    return {chr(x): x for x in seen} | {chr(0x100 + i): x for i, x in enumerate(hidden)}


class Pair:
    """Both tokenizers, from the content of their files."""

    def __init__(self, byte_bpe: str, piece_model: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.one = tokenizers.Tokenizer.from_str(byte_bpe)
        self.one.encode_special_tokens = True
        self.two = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        letters = byte_letters()
        entries = {i: t for t, i in self.one.get_vocab(with_added_tokens=True).items()}
        self.one_bytes = [bytes(letters.get(c, 0x3F) for c in entries.get(i, "")) for i in range(max(entries) + 1)]
        self.size = self.two.get_piece_size()
        pieces = [self.two.id_to_piece(i) for i in range(self.size)]
        self.two_bytes = [bytes([int(p[3:5], 16)]) if self.two.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.one_size, self.two_size = (np.array([len(x) for x in t], np.int64) for t in (self.one_bytes, self.two_bytes))

    def align(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """For each piece, which opens with a blank: (HEAD values, then its links as a * size + b), and its groups as text."""
        texts = [p.decode("utf-8") for p in pieces]
        ones = [e.ids for e in self.one.encode_batch_fast(texts, add_special_tokens=False)]
        twos = self.two.encode([t[1:] for t in texts], num_threads=1)
        sound = [
            b"".join([self.one_bytes[i] for i in a]) == p and b"".join([self.two_bytes[i] for i in b]) == p for p, a, b in zip(pieces, ones, twos)
        ]
        fine = [i for i, ok in enumerate(sound) if ok]
        # all sound pieces on one axis of bytes
        a, b = (np.fromiter(itertools.chain.from_iterable(ids[i] for i in fine), np.int64) for ids in (ones, twos))
        a_end, b_end = np.cumsum(self.one_size[a]), np.cumsum(self.two_size[b])
        edge = np.cumsum([len(pieces[i]) for i in fine], dtype=np.int64)
        # between two neighbouring ends of either kind lies one overlap
        ends = np.union1d(a_end, b_end)
        links = a[np.searchsorted(a_end, ends)] * self.size + b[np.searchsorted(b_end, ends)]
        common = np.intersect1d(a_end, b_end)
        counts = np.zeros((len(pieces), HEAD + 1), np.int64)
        counts[:, 0] = sound
        for column, places in ((1, a_end), (2, b_end), (3, common), (4, ends)):
            counts[fine, column] = np.diff(np.searchsorted(places, edge, "right"), prepend=0)
        lengths = HEAD + counts[:, 4]
        values = np.empty(int(lengths.sum()), np.int64)
        head = np.cumsum(lengths) - lengths
        is_link = np.ones(len(values), bool)
        for k in range(HEAD):
            values[head + k] = counts[:, k]
            is_link[head + k] = False
        values[is_link] = links
        return lengths, values, self._groups(len(pieces), fine, ones, twos, common, a_end, b_end, counts[:, 3])

    def _groups(self, n, fine, ones, twos, common, a_end, b_end, groups) -> list[bytes]:
        a_cut, b_cut = (np.searchsorted(x, common, "right").tolist() for x in (a_end, b_end))
        notes, at, a0, b0 = [b""] * n, 0, 0, 0
        for i in fine:
            a, b, made = list(map(str, ones[i])), list(map(str, twos[i])), []
            a_base, b_base = a0, b0
            for k in range(at, at + int(groups[i])):
                made.append(f"{','.join(a[a0 - a_base : a_cut[k] - a_base])}|{','.join(b[b0 - b_base : b_cut[k] - b_base])}")
                a0, b0 = a_cut[k], b_cut[k]
            at += int(groups[i])
            notes[i] = ";".join(made).encode()
        return notes


def cut_pieces(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, first): pieces of laid-out texts; those of text i are first[i] .. first[i+1]-1.

    Cut before a blank that follows no blank and precedes a byte that opens a visible character; bytes that may open a wide blank
    do not count.
    """
    visible = np.zeros(256, bool)
    visible[0x21:0x7F] = visible[0xC3:0xF5] = True
    visible[[0xE1, 0xE2, 0xE3]] = False
    begins = np.zeros(len(data), bool)
    begins[1:-1] = (data[1:-1] == 32) & (data[:-2] != 32) & visible[data[2:]]
    begins[starts[:-1][np.diff(starts) > 1]] = True
    begin = np.flatnonzero(begins)
    first = np.searchsorted(begin, starts)
    end = np.append(begin[1:], len(data))
    full = np.flatnonzero(np.diff(first) > 0)
    end[first[full + 1] - 1] = starts[full + 1] - 1
    return begin, end, first


@dataclass
class Plane:
    """Of each pair, the documents whose link count has this binary digit: bits if they are many, else numbers."""

    counts: np.ndarray
    dense: np.ndarray
    sparse: np.ndarray

    def many(self, documents: int) -> np.ndarray:
        return self.counts.astype(np.int64) * 8 * self.sparse.itemsize > documents

    def expand(self, documents: int) -> tuple[np.ndarray, np.ndarray]:
        """(pair's place, document) of all entries."""
        many = self.many(documents)
        row, doc = np.nonzero(np.unpackbits(self.dense, axis=1, count=documents)) if len(self.dense) else (np.zeros(0, np.int64),) * 2
        few = np.repeat(np.flatnonzero(~many), self.counts[~many])
        return np.concatenate([np.flatnonzero(many)[row], few]), np.concatenate([doc, self.sparse.astype(np.int64)])

    def packed(self) -> dict:
        return {"counts": self.counts.astype("<u4").tobytes(), "dense": self.dense.tobytes(), "sparse": self.sparse.tobytes()}

    @staticmethod
    def unpacked(raw: dict, documents: int) -> Plane:
        kind = "<u2" if documents <= 1 << 16 else "<u4"
        return Plane(
            np.frombuffer(raw["counts"], "<u4"), np.frombuffer(raw["dense"], np.uint8).reshape(-1, (documents + 7) // 8), np.frombuffer(raw["sparse"], kind)
        )


def lay_planes(pair: np.ndarray, doc: np.ndarray, times: np.ndarray, documents: int) -> tuple[np.ndarray, list[Plane]]:
    """(pairs, planes) of entries sorted by pair and document."""
    pairs, place = np.unique(pair, return_inverse=True)
    planes = []
    for k in range(int(times.max()).bit_length() if len(times) else 0):
        held = np.flatnonzero(times >> k & 1)
        p, d = place[held], doc[held]
        plane = Plane(np.bincount(p, minlength=len(pairs)), np.zeros((0, (documents + 7) // 8), np.uint8), np.zeros(0, "<u2" if documents <= 1 << 16 else "<u4"))
        many = plane.many(documents)
        wide = np.flatnonzero(many[p])
        rank = np.cumsum(many) - 1
        rows = []
        # rows of bits, few megabytes of single bytes at a time
        step = max(1, (8 << 20) // max(documents, 1))
        for at in range(0, int(many.sum()), step):
            own = wide[(rank[p[wide]] >= at) & (rank[p[wide]] < at + step)]
            bits = np.zeros((min(step, int(many.sum()) - at), documents), np.uint8)
            bits[rank[p[own]] - at, d[own]] = 1
            rows.append(np.packbits(bits, axis=1))
        if rows:
            plane.dense = np.concatenate(rows)
        plane.sparse = d[~many[p]].astype(plane.sparse.dtype)
        planes.append(plane)
    return pairs, planes


def link_counts(planes: list[Plane], pairs: int) -> np.ndarray:
    total = np.zeros(pairs, np.int64)
    for k, plane in enumerate(planes):
        total += plane.counts.astype(np.int64) << k
    return total


def document_counts(planes: list[Plane], pairs: int, documents: int) -> np.ndarray:
    """Bits of each pair's planes merged by OR."""
    total = np.zeros(pairs, np.int64)
    wide = np.zeros(pairs, bool)
    for plane in planes:
        wide |= plane.many(documents)
    rank = np.cumsum(wide) - 1
    bits, rest = np.zeros((int(wide.sum()), (documents + 7) // 8), np.uint8), []
    for plane in planes:
        many = plane.many(documents)
        bits[rank[many]] |= plane.dense
        few = np.repeat(np.flatnonzero(~many), plane.counts[~many])
        doc, in_bits = plane.sparse.astype(np.int64), wide[few]
        np.bitwise_or.at(bits, (rank[few[in_bits]], doc[in_bits] >> 3), (128 >> (doc[in_bits] & 7)).astype(np.uint8))
        rest.append(few[~in_bits] * documents + doc[~in_bits])
    total[wide] = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    if rest:
        total += np.bincount(np.unique(np.concatenate(rest)) // max(documents, 1), minlength=pairs)
    return total


def lay_index(docs: DataFrame, byte_bpe: str, piece_model: bytes, key: str, text: str) -> DataFrame:
    """Per chunk: its number, its documents' own rows, its pairs in order with their links and documents, and the pairs' planes."""
    small_batches(docs.sparkSession)
    docs = docs.select(key, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two, part, made = Pair(byte_bpe, piece_model), TaskContext.get().partitionId(), itertools.count()
        memo = Memo(two.align, np.int64)
        reports, entries, size, n = [], [], 0, 0

        def chunk() -> pa.RecordBatch:
            pair, doc, times = (np.concatenate(x) if entries else np.zeros(0, np.int64) for x in (list(zip(*entries)) or [[], [], []]))
            order = np.argsort(pair, kind="stable")
            pairs, planes = lay_planes(pair[order], doc[order], times[order], n)
            return pa.RecordBatch.from_pydict(
                {"chunk": pa.array([part << 32 | next(made)], pa.int64()), "rows": pa.array([as_bytes(pa.Table.from_batches(reports))], pa.binary()),
                 "n_rows": pa.array([n], pa.int64()), "pairs": pa.array([pairs], pa.list_(pa.int64())),
                 "links": pa.array([link_counts(planes, len(pairs))], pa.list_(pa.int64())),
                 "documents": pa.array([document_counts(planes, len(pairs), n)], pa.list_(pa.int64())),
                 "planes": pa.array([[p.packed() for p in planes]], pa.list_(PLANE))}
            )

        for batch in (s for whole in batches for s in slices(whole, text)):
            column = batch.column(text)
            filled = pc.fill_null(pc.not_equal(column, ""), False)
            data, starts = lay(pc.if_else(filled, pc.binary_join_element_wise(pa.scalar(" "), column, pa.scalar("")), ""))
            begin, end, first = cut_pieces(data, starts)
            places = memo.look_up(mix(hash_spans(data, begin, end)), data, begin, end)
            lengths, values = gather(memo.first, memo.values, places)
            head = np.cumsum(lengths) - lengths
            owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
            sound = np.ones(batch.num_rows, bool)
            sound[owner[values[head] == 0]] = False
            totals = [np.bincount(owner, values[head + k], batch.num_rows).astype(np.int64) * sound for k in (1, 2, 3)]
            links = np.bincount(owner, lengths - HEAD, batch.num_rows).astype(np.int64) * sound
            is_link = np.ones(len(values), bool)
            for k in range(HEAD):
                is_link[head + k] = False
            link_owner = np.repeat(owner, lengths)[is_link]
            pair = values[is_link]
            pair, link_owner = pair[sound[link_owner]], link_owner[sound[link_owner]]
            entry, times = np.unique(pair * batch.num_rows + link_owner, return_counts=True)
            entries.append((entry // batch.num_rows, n + entry % batch.num_rows, times))
            notes = memo.notes[places].tolist()
            digests = [
                hashlib.sha256(b";".join(notes[a:b])).hexdigest() if ok and a < b else ""
                for a, b, ok in zip(first[:-1].tolist(), first[1:].tolist(), sound.tolist())
            ]
            reports.append(
                pa.RecordBatch.from_arrays([batch.column(key), *map(pa.array, totals), pa.array(links), pa.array(digests, pa.string())], names=NAMES)
            )
            size, n = size + len(data), n + batch.num_rows
            if size >= CHUNK_BYTES:
                yield chunk()
                reports, entries, size, n = [], [], 0, 0
                give_back()
        if n:
            yield chunk()

    plane = "struct<counts: binary, dense: binary, sparse: binary>"
    schema = f"chunk long, rows binary, n_rows long, pairs array<long>, links array<long>, documents array<long>, planes array<{plane}>"
    return written(docs.mapInArrow(work, schema), "postings")


PLANE = pa.struct([("counts", pa.binary()), ("dense", pa.binary()), ("sparse", pa.binary())])
NAMES = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def pair_scores(index: DataFrame, size: int) -> DataFrame:
    """Per pair: a, b, n_links and n_docs in the whole corpus, and whether no other pair of this b has more links."""
    posted = index.select(F.explode(F.arrays_zip("pairs", "links", "documents")).alias("p")).select("p.*")
    totals = posted.groupBy(F.col("pairs").alias("pair")).agg(F.sum("links").alias("n_links"), F.sum("documents").alias("n_docs"))
    totals = totals.withColumn("a", F.expr(f"pair div {size}")).withColumn("b", F.pmod("pair", F.lit(size)))
    totals = written(totals, "pairs")
    most = totals.groupBy("b").agg(F.max("n_links").alias("most"))
    return totals.join(most, "b").select("pair", "a", "b", "n_links", "n_docs", (F.col("n_links") == F.col("most")).alias("best"))


def align_tokenizers(
    docs: DataFrame, byte_bpe: str, piece_model: bytes, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(rows, pairs). Rows per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Pairs: see `pair_scores`.

    `byte_bpe` and `piece_model` are the tokenizers' files; they travel with the tasks.
    """
    import sentencepiece

    index = lay_index(docs, byte_bpe, piece_model, key, text)
    scores = pair_scores(index, sentencepiece.SentencePieceProcessor(model_proto=piece_model).get_piece_size())
    asked = index.select("chunk", F.explode("pairs").alias("pair"))
    told = asked.join(scores.select("pair", "n_links", "best"), "pair").groupBy("chunk")
    # as many as the chunk has pairs
    told = told.agg(F.sort_array(F.collect_list(F.struct("pair", "n_links", "best"))).alias("told"))
    told = told.select("chunk", F.col("told.n_links").alias("counts"), F.col("told.best").alias("best"))
    names = [key, *NAMES[1:5], "n_best", "count_sum", NAMES[5]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column("n_rows")[i].as_py()
                numbers = lambda name: batch.column(name)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
                if batch.column("counts")[i].is_valid:
                    count, wins = numbers("counts"), numbers("best").astype(np.int64)
                    for k, raw in enumerate(batch.column("planes")[i].as_py()):
                        place, doc = Plane.unpacked(raw, n).expand(n)
                        np.add.at(total, doc, count[place] << k)
                        np.add.at(best, doc, wins[place] << k)
                own = as_table(batch.column("rows")[i].as_py())
                made = pa.table([*own.columns[:5], pa.array(best), pa.array(total), own.column(5)], names=names)
                yield from made.combine_chunks().to_batches(max_chunksize=2000)
                give_back()

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    answered = index.select("chunk", "rows", "n_rows", "planes").join(told, "chunk", "left")
    return answered.mapInArrow(work, schema), scores.drop("pair")
