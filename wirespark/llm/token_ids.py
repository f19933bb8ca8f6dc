"""Token ids of texts with the tokenizers library, for use inside tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from wirespark.llm.common import listed, numbered, spans, text_array, utf8_bytes

#: Bytes of text that are encoded together; a longer text is encoded alone.
BLOCK_BYTES = 3_000_000
#: Pieces whose ids are remembered; beyond that the memory is cleared.
KNOWN_PIECES = 800_000
#: Pieces that are encoded in one run.
RUN = 20_000

# Spark runs a task per core; threads of the library on top would only contend.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_CUT = "\0"
#: A cut before a space is safe unless white space (or the mark itself) stands before it.
_UNSAFE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] |\x00"

_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, loaded once per worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Encoder:
    """Byte-level encoding in bulk.

    A byte-level tokenizer never joins text across a space that follows a word. So texts are cut
    there, and each different piece is encoded once per worker; ids of a text are those of its
    pieces in a row. A text with white space before a space, or with an added token of the
    tokenizer (which the library finds before all else), is encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.unsafe = "|".join([_UNSAFE, *map(re.escape, added)])
        vocabulary = self.tokenizer.get_vocab()
        #: Bytes that each id stands for (a byte-level token has a character for each byte).
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)
        self._forget()

    @property
    def largest_id(self) -> int:
        return len(self.bytes_of) - 1

    def _forget(self) -> None:
        self.slots: dict[str, int] = {"": 0}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.starts = np.zeros(1 << 18, np.int64)  # of each slot, and where the next begins

    def _room(self, slots: int, ids: int) -> None:
        while len(self.starts) <= slots + 1:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while len(self.ids) < ids:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])

    def _learn(self, pieces: pa.LargeStringArray) -> None:
        """Encode new pieces. Those that begin with a space and end in a word go in long runs."""
        last = pc.utf8_is_space(pc.utf8_slice_codeunits(pieces, -1))
        joins = pc.and_not(pc.starts_with(pieces, " "), last)
        safe, other = pieces.filter(joins), listed(pieces.filter(pc.invert(joins)))
        data, offsets = utf8_bytes(safe)
        ends = offsets[1:]
        cuts = [*offsets[:-1:RUN], offsets[-1]]
        runs = [data[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:])]
        encode = partial(self.tokenizer.encode_batch_fast, add_special_tokens=False)
        flat = np.concatenate([np.zeros(0, np.int64), *[np.asarray(e.ids) for e in encode(runs)]])
        flat = flat.astype(np.int64)
        cuts = np.searchsorted(np.cumsum(self.bytes_of[flat]), ends, side="right")
        apart = [np.asarray(e.ids, np.int64) for e in encode(other)]
        flat = np.concatenate([flat, *apart])
        lengths = np.concatenate(
            [np.diff(cuts, prepend=0), np.array([len(x) for x in apart], np.int64)]
        )
        used = len(self.slots)
        base = int(self.starts[used])
        self._room(used + len(lengths), base + len(flat))
        self.ids[base : base + len(flat)] = flat
        self.starts[used + 1 : used + 1 + len(lengths)] = base + np.cumsum(lengths)
        self.slots.update(zip(listed(safe) + other, range(used, used + len(lengths))))

    def _pieces(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        parts = pc.split_pattern(pc.replace_substring(texts, " ", _CUT + " "), _CUT)
        numbers, different = numbered(parts.values)
        pieces = listed(different)
        if len(self.slots) + len(pieces) > KNOWN_PIECES:
            self._forget()
        known = list(map(self.slots.get, pieces))
        new = [i for i, slot in enumerate(known) if slot is None]
        if new:
            self._learn(different.take(pa.array(new)))
            for i in new:
                known[i] = self.slots[pieces[i]]
        slot = np.array(known, np.int64)[numbers]
        start = self.starts[slot]
        length = self.starts[slot + 1] - start
        ids = self.ids[np.repeat(start, length) + spans(length)]
        ends = np.concatenate([[0], np.cumsum(length)])[parts.offsets.to_numpy()]
        return ids, ends

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (one more than texts)."""
        unsafe = pc.match_substring_regex(texts, self.unsafe).to_numpy(zero_copy_only=False)
        if not unsafe.any():
            return self._pieces(texts)
        ids, ends = self._pieces(texts.filter(pa.array(~unsafe)))
        whole = self.tokenizer.encode_batch_fast(
            texts.filter(pa.array(unsafe)).to_pylist(), add_special_tokens=False
        )
        safe, other = iter(np.split(ids, ends[1:-1])) if len(ends) > 1 else iter(()), iter(whole)
        rows = [np.asarray(next(other).ids, np.uint32) if u else next(safe) for u in unsafe]
        return np.concatenate(rows), np.cumsum([0, *map(len, rows)])


def blocks(column: pa.Array) -> Iterator[tuple[int, int, pa.LargeStringArray]]:
    """Runs of texts of about BLOCK_BYTES: first row, row after the last, texts.

    Arrow keeps what the blocks of a batch have freed; that is given back after the last one, since
    workers live on beside the later stages.
    """
    texts = text_array(column)
    offsets = utf8_bytes(texts)[1]
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + BLOCK_BYTES, side="right")) - 1
        end = min(max(end, begin + 1), len(texts))
        yield begin, end, texts.slice(begin, end - begin)
        begin = end
    pa.default_memory_pool().release_unused()


def with_end(ids: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with an end id after each text's."""
    return np.insert(ids, starts[1:], end_id), starts + np.arange(len(starts))
