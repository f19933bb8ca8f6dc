"""Rows that the corpus operators once left out or got wrong."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from wirespark.llm import jaccard_join, mixing, packing, queries, token_files
from wirespark.session import new_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_language_model_keeps_ngrams_seen_once(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(12)) for _ in range(40)]
    rare = "one passage that only a single training document holds"
    texts = {i: t for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in range(200)}
    texts[next(i for i in range(100, 200) if not held[i])] = rare
    texts[next(i for i in range(100, 200) if held[i])] = rare
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op10_language_model(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    c1, c2, c3 = collections.Counter(), collections.Counter(), collections.Counter()
    for i, text in texts.items():
        if not held[i]:
            s = ["\n", *WORD.findall(text), "\n"]
            c1.update(s[1:]), c2.update(zip(s, s[1:])), c3.update(zip(s, s[1:], s[2:]))
    n, unknown = sum(c1.values()), (sum(x == 1 for x in c1.values()) + 1) / (sum(c1.values()) + 2)
    s2, s3 = collections.Counter(), collections.Counter()
    for k, x in c2.items():
        s2[k[0]] += x - 0.75
    for k, x in c3.items():
        s3[k[:2]] += x - 0.75
    for r in out:
        score, s = 0.0, ["\n", *WORD.findall(texts[r["doc_id"]]), "\n"]
        for i in range(1, len(s)):
            p = (1 - unknown) * c1[s[i]] / n if s[i] in c1 else unknown
            if s[i - 1] in c1:
                p *= 1 - s2[s[i - 1]] / c1[s[i - 1]]
                p += max(0, c2[s[i - 1], s[i]] - 0.75) / c1[s[i - 1]]
            if i > 1 and (pair := (s[i - 2], s[i - 1])) in c2:
                p = p * (1 - s3[pair] / c2[pair]) + max(0, c3[*pair, s[i]] - 0.75) / c2[pair]
            score += math.log10(min(p, 1))
        assert r["score"] == pytest.approx(score, abs=0.02 * len(s))


def changed(text, places):
    words = text.split(" ")
    for place in places:
        words[place] = f"other{place}"
    return " ".join(words)


def test_pipeline_links_near_copies_by_five_words(spark):
    base = " ".join(f"w{i}" for i in range(100))
    apart = " ".join(f"v{i}" for i in range(100))
    texts = [base, changed(base, (30, 60)), apart, changed(apart, (20, 50, 80))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = corpus_pipeline.unique(spark, docs, "").select("doc_id").collect()
    # 86 of 106 shingles of five words are shared (0.811); of the last two texts 81 of 111.
    assert sorted(r["doc_id"] for r in kept) == [0, 2, 3]


def test_mixing_stage_keeps_null_and_repeated_ids(spark):
    rows = [(i, f"{i} " * (5 + i % 7), f"s{i % 3}" if i % 5 else None) for i in range(90)]
    rows += [(None, f"null {i} " * 6, f"s{i % 3}" if i % 2 else None) for i in range(12)]
    rows += [(7, rows[7][1], rows[7][2])] * 2 + [(7, "another text of the same number", "s0")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken = collections.Counter(tuple(r) for r in corpus_pipeline.mixture(spark, docs, "").collect())
    words = collections.Counter()
    for (doc, text, _), times in taken.items():
        words[doc] += times * len(WORD.findall(text))
    mixed = mixing.mixed_sources(docs).collect()
    expected = collections.Counter()
    for r in mixed:
        expected[r["doc_id"]] += r["taken"]
    assert words == +expected and words[None] and words[7]
    assert sum(taken.values()) == sum(r["copies"] for r in mixed)


def documents(spark, texts, tmp_path):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return docs


def cleaned(spark, docs, tmp_path):
    """Texts after the pipeline's stage; the query must have left as many characters."""
    texts = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, "").collect()}
    left = {r["doc_id"]: r["chars_left"] for r in queries.op5_line_templates(spark, str(tmp_path)).collect()}
    assert {i: n for i, n in left.items() if n} == {i: len(t) for i, t in texts.items() if t}
    return texts


def test_long_lines_recur_from_two_documents(spark, tmp_path):
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(52))
    dated = "on day 12 of month 4 the office was closed for the whole morning"
    texts = [
        f"first text of all\n{passage}\n{dated}\na short shared line\nrose by 3 degrees over the whole year in Ulm",
        f"second one here\n{passage}\n{dated}\na short shared line\nrose by 5 degrees over the whole year in Ulm",
        "third has nothing in common",
    ]
    out = cleaned(spark, documents(spark, texts, tmp_path), tmp_path)
    assert out[0] == texts[0] and out[2] == texts[2]
    # Short lines and lines that differ in a number need three documents.
    assert out[1] == texts[1].replace(f"{passage}\n{dated}\n", "")


def test_rows_of_different_numbers_stay(spark, tmp_path):
    rng = random.Random(8)

    def numbers(n):
        return " ".join(f"{rng.random():.6f}" for _ in range(n))

    tables = ["\n".join([numbers(4), numbers(5), numbers(9), numbers(12)]) for _ in range(5)]
    measured = [f"{i + 10} kg {i + 20} cm {i + 30} mm" for i in range(5)]
    texts = [*tables, *[f"{m}\n{numbers(4)}\n1 2 3 4" for m in measured]]
    texts += [f"this line stands in many documents, number {i}\n{numbers(4)}" for i in range(4)]
    out = cleaned(spark, documents(spark, texts, tmp_path), tmp_path)
    assert [out[i] for i in range(6)] == texts[:6]
    # Equal rows of numbers and templates of words still go.
    assert [out[i] for i in range(6, 10)] == [t.removesuffix("\n1 2 3 4") for t in texts[6:10]]
    assert out[10] == texts[10]
    assert [out[i] for i in range(11, 14)] == [t.split("\n")[1] for t in texts[11:]]


def test_added_tokens_are_encoded_as_the_library_does(spark):
    texts = ["before <|endoftext|> after", "<|endoftext|>", "a<|endoftext|>b  c", "no such token"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    encode = Tokenizer.from_file(TOKENIZER).encode
    plain = {i: encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert 50256 in plain[0]
    folder, at = new_folder(spark, "tokens"), 0
    token_files.write_tokens(docs, folder, TOKENIZER)
    for r in token_files.read_tokens(spark, folder).orderBy("start").collect():
        ids = [*plain[r["doc_id"]], 0]
        assert r["start"] == at and np.frombuffer(r["ids"], "<u4").tolist() == ids
        at += len(ids)
    for r in packing.packed(docs, TOKENIZER).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == [*plain[r["doc_id"]], 1]


def test_documents_without_number_are_linked_and_texts_of_one_number_kept(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    near = {x: changed(x, (40,)) for x in (a, b)}
    rows = [(None, a), (None, near[a]), (4, b), (None, near[b]), (5, c), (5, "quite another text")]
    rows += [(5, c), (None, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    classes = jaccard_join.near_duplicate_rows(docs).collect()
    root = {(r["doc_id"], r["n_shingles"], r["component_id"]): r["root"] for r in classes}
    assert (None, 97, 4) in root and (None, 97, None) in root and len(classes) == len(rows)
    assert len({r["root"] for r in classes if r["doc_id"] is None and r["n_shingles"]}) == 2
    found = jaccard_join.near_duplicates(docs).collect()
    assert sum(r["component_id"] == 4 for r in found) == 2
    kept = [tuple(r) for r in corpus_pipeline.unique(spark, docs, "").collect()]
    assert len(kept) == len(set(kept))
    assert sum(t in (a, near[a]) for _, t in kept) == 1
    rest = {(i, t) for i, t in kept if t not in (a, near[a])}
    assert rest == {(4, b), (5, c), (5, "quite another text"), (None, None), (9, "")}
