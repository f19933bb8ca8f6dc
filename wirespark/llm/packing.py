"""Packing documents into sequences of a fixed length by the sum-of-squares rule."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirespark.llm.token_ids import blocks, encoder, with_end

_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
_ARROW = pa.schema(
    [(name, pa.binary() if name == "ids" else pa.int64()) for name in (
        "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"
    )]
)
#: Sequence ids of a task begin at its number times this.
TASK_SEQUENCES = 1 << 40
_FLUSH_IDS = 2_000_000


class Packer:
    """Windows of one task; ``levels[h]`` counts the open windows that hold h ids.

    A piece goes where the sum of the squared counts grows least: on a window at some level, or
    on a new window. That keeps windows of every level in stock, so most pieces find one
    that they fill exactly. Full windows leave; only open ones stay in memory.
    """

    def __init__(self, size: int, first_id: int):
        self.size, self.next_id = size, first_id
        self.levels = np.zeros(size + 1, np.int64)
        self.at_level: list[list[list]] = [[] for _ in range(size + 1)]
        self.done: list[tuple] = []
        self.done_ids = 0

    def level_for(self, length: int) -> int:
        """The fill level on which a piece of this length goes; 0 is a new window."""
        n, top = self.levels, self.size - length
        if top < 1:
            return 0
        here = n[1 : top + 1]
        cost = 2 * (n[1 + length : self.size + 1] - here) + 2
        cost[-1] = 1 - 2 * n[top]  # the window becomes full and leaves
        cost[here == 0] = np.iinfo(np.int64).max
        best = top - int(np.argmin(cost[::-1]))
        return best if cost[best - 1] <= 2 * n[length] + 1 else 0

    def _finish(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, tokens in pieces:
            self.done.append((doc, start, len(ids), ids.tobytes(), tokens, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1
        self.done_ids += offset

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        """Cut whole windows off a document and place the rest."""
        tokens, start = len(ids), 0
        while tokens - start >= self.size:
            self._finish([(doc, start, ids[start : start + self.size], tokens)])
            start += self.size
        rest = ids[start:].copy()
        if not len(rest):
            return
        level = self.level_for(len(rest))
        window = self.at_level[level].pop() if level else []
        window.append((doc, start, rest, tokens))
        filled = level + len(rest)
        self.levels[level] -= level > 0
        if filled == self.size:
            self._finish(window)
        else:
            self.levels[filled] += 1
            self.at_level[filled].append(window)

    def close(self) -> None:
        """Windows that need no padding stay; the others' pieces are cut anew to full windows."""
        window, filled = [], 0
        for level in range(self.size - 1, 0, -1):
            for pieces in self.at_level[level]:
                if level & (level - 1) == 0:
                    self._finish(pieces)
                    continue
                for doc, start, ids, tokens in pieces:
                    while len(ids):
                        part = ids[: self.size - filled]
                        window.append((doc, start, part, tokens))
                        start, ids, filled = start + len(part), ids[len(part) :], filled + len(part)
                        if filled == self.size:
                            self._finish(window)
                            window, filled = [], 0
        if window:
            self._finish(window)

    def taken(self) -> pa.RecordBatch:
        """The pieces of the windows finished since the last call."""
        columns = zip(*self.done) if self.done else [[] for _ in _ARROW]
        arrays = [pa.array(list(x), f.type) for x, f in zip(columns, _ARROW)]
        self.done, self.done_ids = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def _pack(
    batches: Iterator[pa.RecordBatch], tokenizer: str, size: int, end_id: int
) -> Iterator[pa.RecordBatch]:
    packer = Packer(size, TaskContext.get().partitionId() * TASK_SEQUENCES)
    encode = encoder(tokenizer).encode
    for batch in batches:
        for begin, end, texts in blocks(batch.column("text")):
            ids, starts = with_end(*encode(texts), end_id)
            names = batch.column("doc_id").slice(begin, end - begin).to_pylist()
            for i, name in enumerate(names):
                packer.add(name, ids[starts[i] : starts[i + 1]].astype("<u4"))
                if packer.done_ids >= _FLUSH_IDS:
                    yield packer.taken()
    packer.close()
    yield packer.taken()


def packed(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1) -> DataFrame:
    """Pack documents into sequences of at most ``size`` ids.

    ``docs`` needs doc_id and text (null: empty); other columns are ignored and repeated rows
    are packed as often as they come. A document's ids are those of its whole text and an end
    id. Each task packs the documents of its partition online, by ``Packer``; whole windows
    are cut off long documents first. At the end of a partition the pieces of windows that would
    need padding are cut anew, so a partition leaves one padded sequence at most. Nothing is
    shuffled, and a task holds only its open windows. An empty table gives an empty result.

    Returns a row per piece: doc_id, start (the document's ids before it), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset (place in the sequence).
    """
    pack = partial(_pack, tokenizer=tokenizer, size=size, end_id=end_id)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(pack, _SCHEMA)
