"""How often the language model reads and sorts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from wirespark.llm import language_model, token_ids


def test_ranges_of_one_value_are_read_once() -> None:
    values = np.array([3, 9, 9_000, 1, 4, 7, 8, 20, 5], np.uint64)  # ranges: 3 | 9 | 9000 | 1..20 | 5
    low = np.array([0, 1, 2, 3, 3, 3, 3, 3, 8, 5, 0])
    end = np.array([1, 2, 3, 8, 8, 8, 8, 8, 9, 5, 1])
    want = np.array([3, 10, 8_999, 1, 20, 6, 0, 21, 5, 7, 2], np.uint64)
    places = []

    def read(at):
        places.extend(at.tolist())
        return values[at]

    found = language_model._search(read, want, low, end)
    assert found.tolist() == [0, -1, -1, 3, 7, -1, -1, -1, 8, -1, -1]
    assert [places.count(n) for n in (1, 2, 8)] == [1, 1, 1]
    assert low.tolist() == [0, 1, 2, 3, 3, 3, 3, 3, 8, 5, 0]


def test_search_agrees_with_a_plain_one() -> None:
    random = np.random.default_rng(4)
    ranges = [np.unique(random.integers(0, 60, n)) for n in random.integers(0, 40, 300)]
    values = np.concatenate(ranges).astype(np.uint64)
    ends = np.cumsum([len(x) for x in ranges])
    which = random.integers(0, len(ranges), 5_000)
    want = random.integers(0, 62, 5_000).astype(np.uint64)
    low = (ends - [len(x) for x in ranges])[which]
    found = language_model._search(lambda at: values[at], want, low, ends[which])
    plain = [
        int(low[i]) + ranges[r].tolist().index(w) if w in ranges[r] else -1
        for i, (r, w) in enumerate(zip(which, want.tolist()))
    ]
    assert found.tolist() == plain


def test_a_task_sums_up_its_blocks_once(monkeypatch) -> None:
    monkeypatch.setattr(token_ids, "BLOCK_BYTES", 1_000)
    texts = [" ".join(f"w{(n * 7 + k) % 50}" for k in range(60)) for n in range(40)]
    rows = {"doc_id": list(range(40)), "held_out": [n % 10 == 0 for n in range(40)], "text": texts}
    blocks = list(language_model._blocks(iter([pa.RecordBatch.from_pydict(rows)])))
    assert len(blocks) > 5
    calls, merged = [], language_model._merged
    monkeypatch.setattr(language_model, "_merged", lambda *x: calls.append(1) or merged(*x))
    out = list(language_model._counted(iter(blocks), "", (), 4, 1))
    assert len(out) == 1 and len(calls) == 1
    many = []
    monkeypatch.setattr(language_model, "_HELD", 100)
    for part in language_model._counted(iter(blocks), "", (), 4, 1):
        for blob in part.column("counts").to_pylist():
            many.append(int(language_model._spread(blob, False, np.int64).sum()))
    assert sum(many) == sum(61 for n in range(40) if n % 10)
