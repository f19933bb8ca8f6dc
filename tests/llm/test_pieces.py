"""Words and pieces of text as Python values."""

from __future__ import annotations

import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from tokenizers import Tokenizer

from wirespark.llm import common, token_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "a", "é", "日本語", "\x00b", "😀", "é", " x", "long" * 50]


def test_values_and_hashes_of_odd_words() -> None:
    words = pa.array(ODD, pa.large_string())
    assert common.listed(words) == ODD
    assert common.listed(words.slice(2, 3)) == ODD[2:5]
    assert common.listed(words.slice(0, 0)) == []
    expected = [xxhash.xxh3_64_intdigest(w.encode()) for w in ODD]
    assert common.word_hashes(words).tolist() == expected
    assert len(common.word_hashes(words.slice(0, 0))) == 0


def test_no_scalar_is_made_of_each_piece() -> None:
    words = pa.array([f"word{i}" for i in range(200_000)], pa.large_string())
    seconds = []
    for make in (common.listed, lambda x: x.to_pylist()):
        began = time.process_time()
        make(words)
        seconds.append(time.process_time() - began)
    assert seconds[0] < seconds[1] / 2


def test_pieces_are_encoded_in_several_runs(monkeypatch) -> None:
    monkeypatch.setattr(token_ids, "RUN", 7)
    random = np.random.default_rng(2)
    texts = [" ".join(f"w{n}é," for n in random.integers(0, 500, 40)) for _ in range(30)]
    texts += [*ODD, "two  spaces", "one ends in a space "]
    encoder = token_ids.Encoder(PATH)
    ids, starts = encoder.encode(pa.array(texts, pa.large_string()))
    plain = Tokenizer.from_file(PATH)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in np.split(ids, starts[1:-1])] == expected
