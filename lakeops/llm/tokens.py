"""Token ids of whole texts, fast for repeated words.

The vocabulary splits at white space, and between an ASCII letter or digit and other
ASCII marks, before it merges anything (an apostrophe, which starts contractions, and
the brackets and bars of its special tokens are left alone). So a text's ids are those
of its parts in a row, and each distinct part is tokenised once per worker. Parts are
found by numpy; the tokenizer itself decides all ids.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from lakeops.llm import words as W

VOCABULARY = "word_bpe_49k.json"
CACHED_PARTS = 400_000
END_OF_TEXT = 2
_MARKS = b".,;:!?()[]{}/*#$%&+-=_\"~@^"
_SENTENCE_END = b".!?"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@dataclass
class Ids:
    """Token ids of some rows: row r has ``ids[offsets[r]:offsets[r + 1]]``. ``stops``
    marks tokens after which a sentence ends."""

    ids: np.ndarray
    offsets: np.ndarray
    stops: np.ndarray


def _parts(column: pa.Array) -> W.Words:
    """Words, split again between an ASCII letter or digit and a run of marks."""
    w = W.words(column, W.SPACED_LOWER)
    if len(w.starts) == 0:
        return w
    kind = np.zeros(256, dtype=np.uint8)
    kind[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = 1
    kind[list(_MARKS)] = 2
    k = kind[w.data]
    cut = np.flatnonzero((k[1:] != k[:-1]) & (k[1:] > 0) & (k[:-1] > 0)) + 1
    # Cuts lie strictly inside words: a blank is of kind 0. Row ends may still meet.
    inside = np.searchsorted(w.starts, cut, side="right") - 1
    cut = cut[(inside >= 0) & (cut < w.ends[inside]) & (cut > w.starts[inside])]
    starts = np.sort(np.concatenate([w.starts, cut]))
    ends = np.sort(np.concatenate([w.ends, cut]))
    first_of_row = np.append(w.starts, len(w.data) + 1)[w.offsets]
    return W.Words(w.data, starts, ends, np.searchsorted(starts, first_of_row))


class Tokeniser:
    """Ids of Arrow string columns; holds at most ``CACHED_PARTS`` distinct parts
    beside those of the column at hand. ``encode`` gives the ids of a list of parts."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], parts: Callable[[pa.Array], W.Words]):
        self.encode, self.parts = encode, parts
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.begin, self.length = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.uint32)

    def _slots(self, w: W.Words, hashes: np.ndarray) -> np.ndarray:
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.slot) + len(unique) > CACHED_PARTS:
            self._clear()
        known = self.slot
        slots = np.fromiter((known.get(h, -1) for h in unique.tolist()), dtype=np.int64, count=len(unique))
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            at = first[missing]
            raw = [w.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(w.starts[at], w.ends[at])]
            found = self.encode(raw)
            length = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            begin = len(self.pool) + np.cumsum(length) - length
            slots[missing] = len(known) + np.arange(len(missing))
            known.update(zip(unique[missing].tolist(), slots[missing].tolist()))
            self.begin, self.length = np.concatenate([self.begin, begin]), np.concatenate([self.length, length])
            flat = np.fromiter((i for f in found for i in f), dtype=np.uint32, count=int(length.sum()))
            self.pool = np.concatenate([self.pool, flat])
        return slots[inverse]

    def __call__(self, column: pa.Array, end: int | None = None) -> Ids:
        """Ids of each row (null: none), each row followed by ``end`` if given."""
        w = self.parts(column)
        slots = self._slots(w, w.hashes())
        length, begin = self.length[slots], self.begin[slots]
        last_byte = w.data[w.ends - 1] if len(slots) else np.zeros(0, dtype=np.uint8)
        stop_part = np.isin(last_byte, np.frombuffer(_SENTENCE_END, dtype=np.uint8))
        upto = np.concatenate([[0], np.cumsum(length)])
        ids = self.pool[np.repeat(begin - upto[:-1], length) + np.arange(upto[-1])]
        offsets = upto[w.offsets]
        stops = np.zeros(len(ids), dtype=bool)
        stops[(upto[1:] - 1)[stop_part & (length > 0)]] = True
        if end is not None:
            ids = np.insert(ids, offsets[1:], np.uint32(end))
            stops = np.insert(stops, offsets[1:], True)
            offsets = offsets + np.arange(len(offsets))
        return Ids(ids, offsets, stops)


@functools.cache
def word_tokeniser(path: str) -> Tokeniser:
    """For ``word_bpe_49k.json``; one per Python worker."""
    # Spark runs one task per core; the library's own threads would only compete.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path)
    return Tokeniser(lambda raw: [e.ids for e in vocabulary.encode_batch_fast(raw, add_special_tokens=False)], _parts)


@functools.cache
def piece_tokeniser(path: str) -> tuple[Tokeniser, np.ndarray]:
    """For ``piece_bpe_32k.model``, word by word, and which of its ids are bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    is_byte = np.array([model.is_byte(i) for i in range(model.vocab_size())])
    return Tokeniser(lambda raw: model.encode(raw, num_threads=1), W.words), is_byte


def token_rows(column: pa.Array, path: str, end: int | None = END_OF_TEXT) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, ids, stops) of each row, a bounded number of bytes at a time."""
    tokenise = word_tokeniser(path)
    for first, upto in W.chunks(column):
        t = tokenise(column.slice(first, upto - first), end)
        for r in range(upto - first):
            a, b = int(t.offsets[r]), int(t.offsets[r + 1])
            yield first + r, t.ids[a:b], t.stops[a:b]
