"""Token counts of a unigram tokenizer without its tokens: count-only Viterbi over Aho-Corasick matches.

A text is cut before every blank, and the blank becomes the mark that opens the next word, as the tokenizer does. Within a word,
an Aho-Corasick automaton gives every vocabulary piece and where it ends; dynamic programming carries the best score and its number
of pieces. Ties as in the tokenizer: of equal scores the piece that starts first, the longest, wins, since a later one must be
strictly better. A character that no piece covers alone costs the lowest score less ten; neighbouring ones make one unknown piece,
or one piece per byte where the vocabulary has all bytes.

Null and empty texts count 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.chunks import slices, small_batches
from tidemark.llm.text import hash_spans, lay, mix
from tidemark.llm.vocabulary import Memo

MARK = "▁"
UNKNOWN_COST = 10.0


# Words of more characters are worked out one by one, shorter ones place by place all at once.
LONG = 256


class Counter:
    """Counts pieces of words. `vocabulary` are (piece, score)."""

    def __init__(self, vocabulary: Sequence[tuple[str, float]], byte_pieces: bool):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.score = np.zeros(len(vocabulary))
        self.length = np.zeros(len(vocabulary), np.int64)
        for i, (piece, score) in enumerate(vocabulary):
            self.score[i], self.length[i] = score, len(piece)
            if piece:
                self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_COST
        self.byte_pieces = byte_pieces

    def count(self, words: Sequence[str]) -> list[int]:
        """Pieces of each word. Every step extends all words to their next place."""
        short = [w for w in words if len(w) <= LONG]
        counts = iter(self._count_short(short) if short else [])
        return [next(counts) if len(w) <= LONG else self._count_long(w) for w in words]

    def matches(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(end, piece) of all vocabulary matches by end, then longest first, as the automaton goes from suffix to shorter suffix."""
        found = np.array(list(chain.from_iterable(self.automaton.iter(text))), np.int64)
        return found[0::2], found[1::2]

    def _count_short(self, words: list[str]) -> list[int]:
        # one line for all words, each behind a blank, which no word holds; the blank's place stands for "nothing yet"
        line = " " + " ".join(words)
        end, piece = self.matches(line)
        size = np.fromiter(map(len, words), np.int64, len(words))
        head = np.cumsum(size + 1) - size - 1
        step = np.arange(len(line)) - np.repeat(head, size + 1)
        length, score = self.length[piece], self.score[piece]
        # pieces that hold blanks themselves could reach back over one
        inside = length <= step[end]
        end, length, score = end[inside], length[inside], score[inside]
        alone = np.zeros(len(line), bool)
        alone[end[length == 1]] = True
        rest = np.flatnonzero(~alone & (step > 0))
        # unknown characters come last at their place: no single character matches there
        end = np.concatenate([end, rest])
        length, score = np.concatenate([length, np.ones(len(rest), np.int64)]), np.concatenate([score, np.full(len(rest), self.unknown)])
        known = np.arange(len(end)) < len(end) - len(rest)
        order = np.argsort(end, kind="stable")
        order = order[np.argsort(step[end[order]].astype(np.uint16), kind="stable")]
        end, length, score, known = end[order], length[order], score[order], known[order]
        cuts = np.searchsorted(step[end], np.arange(1, int(size.max()) + 2))
        width = np.ones(len(line), np.int64)
        if self.byte_pieces:
            width[rest] = [len(line[i].encode("utf-8", "replace")) for i in rest.tolist()]
        best, pieces, unknown = np.zeros(len(line)), np.zeros(len(line), np.int64), np.zeros(len(line), bool)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            place, start = end[a:b], end[a:b] - length[a:b]
            value = best[start] + score[a:b]
            group = np.flatnonzero(np.diff(place, prepend=-1))
            top = np.maximum.reduceat(value, group)
            # of equal values the first, that is the longest
            hit = np.flatnonzero(value == np.repeat(top, np.diff(group, append=b - a)))
            hit = hit[np.flatnonzero(np.diff(place[hit], prepend=-1))]
            at, start, how = place[hit], start[hit], known[a:b][hit]
            best[at], unknown[at] = top, ~how
            more = width[at] if self.byte_pieces else ~unknown[start]
            pieces[at] = pieces[start] + np.where(how, 1, more)
        return pieces[head + size].tolist()

    def _count_long(self, word: str) -> int:
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for last, piece in zip(*(x.tolist() for x in self.matches(word))):
            ends[last].append((int(self.length[piece]), float(self.score[piece])))
        best, pieces = [0.0] * (n + 1), [0] * (n + 1)
        unknown = [False] * (n + 1)  # whether the best way here ends in an unknown piece
        for at in range(1, n + 1):
            top, how, alone = None, 0, False
            for length, score in ends[at - 1]:
                alone |= length == 1
                value = best[at - length] + score
                if top is None or value > top:
                    top, how, start = value, 1, at - length
            if not alone:
                value = best[at - 1] + self.unknown
                if top is None or value > top:
                    top, how, start = value, 0, at - 1
            best[at] = top
            if how:
                pieces[at] = pieces[start] + 1
            else:
                unknown[at] = True
                size = len(word[at - 1].encode("utf-8", "replace"))
                pieces[at] = pieces[start] + (size if self.byte_pieces else 0 if unknown[start] else 1)
        return pieces[n]


def count_tokens(
    docs: DataFrame, vocabulary: Sequence[tuple[str, float]], byte_pieces: bool, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_tokens) per document. `vocabulary` travels with the tasks; it is as large as a tokenizer file."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary, byte_pieces)

        def counts(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            made = np.array(counter.count([MARK + w[1:].decode("utf-8", "replace") for w in words]), np.int64)
            return np.ones(len(made), np.int64), made

        memo = Memo(counts)
        for batch in (part for whole in batches for part in slices(whole, text)):
            texts = batch.column(text).to_pylist()
            # the mark in front of a text stands for a blank too; a text that opens with one has just that
            texts = [(t or "").replace(MARK, " ") for t in texts]
            data, starts = lay([t if not t or t[0] == " " else " " + t for t in texts])
            begin = np.flatnonzero(data == 32)
            first = np.searchsorted(begin, starts)
            end = np.append(begin[1:], len(data))
            inner = first[1:] > first[:-1]
            end[first[1:][inner] - 1] = starts[1:][inner] - 1
            places = memo.look_up(mix(hash_spans(data, begin, end)), data, begin, end)
            total = np.concatenate([[0], np.cumsum(memo.values[memo.first[places]], dtype=np.int64)])
            yield pa.RecordBatch.from_pydict({key: batch.column(key), "n_tokens": pa.array(np.diff(total[first]), pa.int64())})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(work, f"`{key}` {kind}, n_tokens long")
