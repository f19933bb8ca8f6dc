"""What tasks of the near-duplicate join hold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from wirespark.llm import jaccard_join, token_ids


def _keys(batches: list[pa.RecordBatch]) -> list[int]:
    return [sum(len(k) for k in b.column("keys").to_pylist()) // 8 for b in batches]


def test_keys_are_dealt_block_by_block(monkeypatch: pytest.MonkeyPatch) -> None:
    random = np.random.default_rng(1)
    texts = [" ".join(map(str, random.integers(0, 10_000, 300))) for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    whole = list(jaccard_join._entries(iter([batch]), 5, (4, 5), 4))
    monkeypatch.setattr(token_ids, "BLOCK_BYTES", 5_000)
    monkeypatch.setattr(jaccard_join, "HELD_KEYS", 1_000, raising=False)
    parts = list(jaccard_join._entries(iter([batch]), 5, (4, 5), 4))
    most_of_a_block = 2 * 5 * 300
    assert len(parts) > 2
    assert max(_keys(parts)) <= 1_000 + most_of_a_block

    def rows(batches):
        out = set()
        for b in batches:
            for keys, sets in zip(b.column("keys").to_pylist(), b.column("sets").to_pylist()):
                out |= set(zip(np.frombuffer(keys, "<u8"), np.frombuffer(sets, "<i8")))
        return out

    assert rows(parts) == rows(whole)
