"""Pack tokenized documents into sequences: first-fit decreasing with a tournament tree, in randomised groups of documents.

A document's tokens, with an end token behind them, are cut into full sequences and one rest. Rests of a random group are taken
longest first; a tournament tree over the bins' free room finds the first bin that a rest fits in logarithmic time. Groups are
dealt by a hash of the document's key, text, task and number among the task's equal rows, so hot sources and copies spread and no
group grows with the corpus.

Null and empty texts are just the end token. Repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import slices, small_batches
from tidemark.llm.text import SPACES, hash_spans, lay, lower_ascii, mix
from tidemark.llm.vocabulary import Memo, gather

LENGTH = 2048
END = 1
# Documents that a random group holds on average.
GROUP = 4000


def first_fit(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) per item by first-fit decreasing into bins of `room`; equal sizes keep their order.

    Leaf i of the tree holds the room left in bin i, an inner node the largest below it; the way down goes left where the left
    half has a bin with enough room.
    """
    n = len(sizes)
    leaves = 1 << max(0, (max(n, 1) - 1).bit_length())
    tree = [room] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        need, node = int(sizes[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, room - tree[node]
        tree[node] -= need
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins, offsets


BLANK, LETTER, DIGIT, SIGN, ODD = range(5)


def byte_classes() -> np.ndarray:
    kinds = np.full(256, ODD, np.uint8)
    kinds[0x21:0x7F] = SIGN
    kinds[[ord("'"), ord("<")]] = ODD  # contractions and special tokens
    kinds[list(SPACES)] = BLANK
    kinds[ord("0") : ord("9") + 1] = DIGIT
    kinds[ord("a") : ord("z") + 1] = kinds[ord("A") : ord("Z") + 1] = LETTER
    return kinds


def parts_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, begin, end, odd): what is encoded in one piece, in order.

    Runs of ASCII and Latin-1 letters, single digits and runs of other ASCII signs are the tokenizer's own parts; a word with any
    other character, an apostrophe or a `<` is odd and goes to the whole tokenizer as it is.
    """
    kinds = byte_classes()[data]
    low = lower_ascii(data)
    # the letters U+00C0 to U+00FF but the two signs among them; upper case is 32 below lower case
    wide = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
    kinds[wide] = kinds[wide + 1] = LETTER
    upper = wide[data[wide + 1] < 0x9F] + 1
    low[upper] += 32
    odd = np.flatnonzero(kinds == ODD)
    if len(odd):
        blanks = np.flatnonzero(kinds == BLANK)
        at = np.unique(np.searchsorted(blanks, odd))
        begin = np.where(at > 0, blanks[at - 1] + 1, 0)
        end = np.append(blanks, len(data))[at]
        change = np.zeros(len(data) + 1, np.int32)
        change[begin] += 1
        change[end] -= 1
        inside = np.cumsum(change[:-1]) > 0
        kinds[inside] = ODD
        low[inside] = data[inside]
    fresh = kinds != BLANK
    fresh[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
    begin = np.flatnonzero(fresh)
    stop = kinds != BLANK
    stop[:-1] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
    return low, begin, np.flatnonzero(stop) + 1, kinds[begin] == ODD


def tokenized(docs: DataFrame, tokenizer: str, key: str, text: str, length: int, end: int) -> DataFrame:
    """Per piece of a document: key, start, length, ids_crc32, doc_tokens and deal. `tokenizer` is the file's content.

    `deal` is a number of the document's row, of its text, its task and which of the task's equal rows it is.

    It must be a lower-casing BPE tokenizer that splits into letters, single digits and signs and drops white space. Each different
    part is encoded once per task.
    """
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(tokenizer)
        bare = Tokenizer.from_str(
            json.dumps(
                json.loads(tokenizer)
                | {"normalizer": None, "added_tokens": [],
                   "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}}
            )
        )
        model = bare.model

        def encode(parts: list[bytes]) -> list[list[int]]:
            out = []
            for p in parts:
                odd, text = p[:1] == b"\n", p.decode("utf-8", "replace")
                if odd:
                    out.append(whole.encode(text[1:], add_special_tokens=False).ids)
                elif p.isascii():
                    out.append([t.id for t in model.tokenize(text)])
                else:
                    out.append(bare.encode(text, add_special_tokens=False).ids)
            return out

        memo = Memo(encode)
        place, copies = TaskContext.get().partitionId(), {}
        for batch in (part for whole_batch in batches for part in slices(whole_batch, text)):
            data, starts = lay(batch.column(text))
            low, begin, stop, odd = parts_of(data)
            hashes = mix(hash_spans(low, begin, stop) + odd)
            places = memo.look_up(hashes, low, begin, stop, np.where(odd, b"\n", b""))
            lengths, ids = gather(memo.first, memo.values, places)
            edges = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(begin, starts)]
            rows = {"owner": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": [], "deal": []}
            keys = batch.column(key).to_pylist()
            tail = np.array([end], "<u4")
            for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                own = np.concatenate([ids[a:b].astype("<u4"), tail])
                whole_crc = zlib.crc32(own)
                # equal rows of a task are numbered, which a repeated task does alike in whatever order they come
                same = hash((keys[i], whole_crc, len(own)))
                copy = copies[same] = copies.get(same, -1) + 1
                deal = ((place * 0x9E3779B1 + copy) & 0x7FFFFFFF) << 32 | whole_crc
                for at in range(0, len(own), length):
                    piece = own[at : at + length]
                    for name, x in zip(rows, (i, at, len(piece), zlib.crc32(piece), len(own), deal)):
                        rows[name].append(x)
            owner = pa.array(rows.pop("owner"), pa.int64())
            made = {key: batch.column(key).take(owner)} | {k: pa.array(v, pa.int64()) for k, v in rows.items()}
            yield pa.RecordBatch.from_pydict(made)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, deal long"
    return docs.select(key, text).mapInArrow(work, schema)


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END, group: int = GROUP
) -> DataFrame:
    """Per piece: key, start, length, ids_crc32, doc_tokens, sequence_id and its offset there; offsets leave no gaps."""
    n = docs.count()
    groups = max(1, -(-n // group))
    pieces = tokenized(docs, tokenizer, key, text, length, end)
    # the row's own number spreads the rows of a key that very many rows share, equal ones too
    salt = F.xxhash64(F.col(key).cast("string"), "deal")
    pieces = pieces.withColumn("batch", F.pmod(salt, F.lit(groups))).drop("deal")
    kind = docs.schema[key].dataType.simpleString()

    def fill(table: pa.Table) -> pa.Table:
        # an order of their own, so that a repeated task packs alike
        table = table.sort_by([(key, "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = first_fit(table.column("length").to_numpy(), length)
        batch = table.column("batch")[0].as_py()
        table = table.drop_columns(["batch"])
        return table.append_column("sequence_id", pa.array(bins + (batch << 32))).append_column("offset", pa.array(offsets))

    schema = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return pieces.groupBy("batch").applyInArrow(fill, schema)
