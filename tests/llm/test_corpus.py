"""The corpus operators against plain versions, on a small table with awkward rows."""

import os
import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from wirespark.llm import (
    jaccard_join,
    language_model,
    line_templates,
    mixing,
    packing,
    quality,
    sharding,
    token_files,
    toxicity,
    vector_forest,
)
from wirespark.session import new_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = "doc_id bigint, text string, lang string, source string, size int, shard string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    names = [f"word{i}" if i % 9 == 0 else f"{'abcdefghij'[i % 10]}o{i}" for i in range(400)]
    line = "this line stands in many documents, number {}"

    def prose(n):
        words = [rng.choice(names) + rng.choice(["", "", ",", "."]) for _ in range(n)]
        return " ".join(w + ("\n" if i % 17 == 16 else "") for i, w in enumerate(words))

    texts = [prose(rng.randrange(1, 120)) for _ in range(60)]
    base = [prose(300) for _ in range(4)]
    for text in base:
        texts += [text] * 4
        for _ in range(6):
            words = text.split(" ")
            for _ in range(3):
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    texts += [prose(30) + "\n" + line.format(i) + "\n" + prose(20) for i in range(12)]
    texts += [None, "", "   ", "\n\n", "one", "a b c", "x " * 40, "É é ß 日本　語 #$ %", "a  b\n c", "b" * 5000]
    texts += [prose(6000), "again and again and again " * 30]
    data = [(i, t, "en", f"s{i % 5}" if i % 11 else None, i, "y") for i, t in enumerate(texts)]
    return data + [data[3], data[3], (None, "no number here at all", None, "s1", None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def test_shards(docs, empty, rows):
    out = sharding.balanced_shards(docs, 8).toPandas()
    assert len(out) == len(rows)
    assert sorted(out["size"]) == sorted(len((r[1] or "").encode()) + 1 for r in rows)
    text = {r[0]: r[1] for r in rows}
    for r in out.dropna(subset=["doc_id"]).itertuples():
        assert r.text_crc32 == zlib.crc32((text[int(r.doc_id)] or "").encode())
    for _, group in out.groupby("shard"):
        assert sorted(group["slot"]) == list(range(len(group)))
    known = out.dropna(subset=["doc_id"])
    of_text = known.assign(text=[text[int(i)] for i in known["doc_id"]]).groupby("text")["shard"]
    assert (of_text.nunique() == 1).all()
    largest = collections.Counter()
    for r in rows:
        largest[r[1]] += len((r[1] or "").encode()) + 1
    totals = out.groupby("shard")["size"].sum()
    assert totals.max() <= out["size"].sum() / 8 + max(largest.values())
    assert sharding.balanced_shards(empty, 8).count() == 0


def test_mixing(docs, empty, rows):
    out = mixing.mixed_sources(docs).toPandas()
    again = mixing.mixed_sources(docs).toPandas()
    key = ["doc_id", "size", "taken"]
    assert out.sort_values(key)[key].equals(again.sort_values(key)[key]) or len(out) == len(rows)
    assert (out["taken"] <= 2 * out["size"]).all()
    size = collections.Counter()
    for r in rows:
        size[(r[3] is None, r[3] or "")] += len(WORD.findall(r[1] or ""))
    order = sorted(size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(size.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * size[s]]
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 2 * size[s]
            left -= target[s]
            free.discard(s)
    source = {r[0]: (r[3] is None, r[3] or "") for r in rows}
    taken = collections.Counter()
    for r in out.itertuples():
        name = source[None if math.isnan(r.doc_id) else int(r.doc_id)]
        taken[name] += r.taken
        assert r.target == pytest.approx(target[name]) and r.source_size == size[name]
    longest = max(len(WORD.findall(r[1] or "")) for r in rows)
    assert all(abs(taken[s] - target[s]) <= longest for s in order)
    assert mixing.mixed_sources(empty).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    data = []
    for i in range(1500):
        spread = 0.02 if i % 3 else 1.0
        x = base[0 if i % 3 == 1 else i % 40] + spread * rng.normal(size=16)
        data.append((i, [float(v) for v in np.float32(x)], i % 2))
    data += [(2000 + i, data[1][1], 1) for i in range(30)]
    data += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [float("nan")] * 16, 1),
             (3003, [None] + [1.0] * 15, 1), (3004, data[0][1], None), (3005, [], 1)]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int")
    out = vector_forest.near_vectors(frame.repartition(4), leaf=60, block=64).toPandas()
    out = out.set_index("vec_id")
    good = [r for r in data if r[0] < 3000]
    x = np.array([r[1] for r in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in good])
    near = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    found = out.loc[[r[0] for r in good], "n_links"].to_numpy()
    assert (found <= near.sum(axis=1)).all()
    assert found.sum() >= 0.99 * near.sum()
    rest = out.loc[range(3000, 3006)]
    assert (rest["n_links"] == 0).all() and rest["kept"].all()
    nothing = frame.limit(0)
    assert vector_forest.near_vectors(nothing).count() == 0


def exact_ids(text, end):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_packing(docs, empty, rows):
    out = packing.packed(docs, TOKENIZER, size=256).collect()
    pieces = collections.defaultdict(list)
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"]
        pieces[r["doc_id"]].append((r["start"], list(ids), r["doc_tokens"]))
    times = collections.Counter(r[0] for r in rows)
    for doc, text in {r[0]: r[1] for r in rows}.items():
        ids = exact_ids(text, 1)
        joined = sorted(pieces[doc])[:: times[doc]] if times[doc] > 1 else sorted(pieces[doc])
        assert [x for _, part, _ in joined for x in part] == ids
        assert all(n == len(ids) for _, _, n in pieces[doc])
    sequences = collections.defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    open_ = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
        open_ += at & (at - 1) != 0
    assert open_ <= docs.rdd.getNumPartitions()
    assert packing.packed(empty, TOKENIZER).count() == 0


def test_level_choice_is_least_sum_of_squares():
    rng = random.Random(1)
    packer = packing.Packer(32, 0)
    for _ in range(400):
        length = rng.randrange(1, 32)
        counts = packer.levels.copy()

        def cost(level):
            after = counts.copy()
            after[level] -= level > 0
            after[level + length] += 1
            return int((after[1:32] ** 2).sum())

        levels = [h for h in range(1, 33 - length) if counts[h]] + [0]
        assert cost(packer.level_for(length)) == min(map(cost, levels))
        packer.add(0, np.zeros(length, np.uint32))


def line_keys(line):
    found = [re.sub(r".*[0-9].*", "<*>", t) for t in WORD.findall(line)]
    if len(found) < 3:
        return []
    keys = [(-1, tuple(found))]
    rest = len(found) - 3
    if len(found) >= 8:
        for i in range(4):
            a, b = 3 + rest * i // 4, 3 + rest * (i + 1) // 4
            keys.append((i, len(found), tuple(found[:a]), tuple(found[b:])))
    return keys


def test_line_templates(docs, empty, rows):
    met = collections.defaultdict(set)
    for r in set(rows):
        for line in (r[1] or "").split("\n"):
            for key in line_keys(line):
                met[key].add((-1 if r[0] is None else r[0], r[1]))
    out = line_templates.without_recurring_lines(docs)
    assert set(out.columns) == {*docs.columns, "dropped_lines"}
    found = {(r["doc_id"], r["text"]) for r in out.collect()}
    expected = set()
    for r in set(rows):
        if r[1] is None:
            expected.add((r[0], None))
            continue
        me = (-1 if r[0] is None else r[0], r[1])
        kept = [
            line
            for line in r[1].split("\n")
            if not any(len(met[k]) >= 3 and min(met[k]) != me for k in line_keys(line))
        ]
        expected.add((r[0], "\n".join(kept)))
    assert found == expected and out.count() == len(rows)
    assert any("number 7" in (r[1] or "") for r in rows)
    assert not any("number 7" in (t or "") for _, t in found)
    assert line_templates.without_recurring_lines(empty).count() == 0


def shingles(text):
    words = WORD.findall(lowered(text))
    if 0 < len(words) < 4:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3))


def test_near_duplicates(docs, empty, rows):
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 85 * len(a | b):
            low, high = sorted((find(i), find(j)))
            root[high] = low
    found = jaccard_join.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is not None:
            assert r["component_id"] == find(r["doc_id"])
            assert r["n_shingles"] == len(dict(sets)[r["doc_id"]])
    assert jaccard_join.near_duplicates(empty).count() == 0


def test_tree_keeps_every_similar_pair():
    rng = np.random.default_rng(0)
    points = rng.poisson(2, size=(300, 16))
    points[150:] = np.maximum(points[:150] + rng.integers(-1, 2, size=(150, 16)) * (rng.random((150, 16)) < 0.1), 0)
    sizes = points.sum(axis=1)
    a, b = jaccard_join.tree_pairs(points, sizes, points, sizes, (85, 100))
    shared = np.minimum(points[:, None], points[None]).sum(axis=2)
    want = np.argwhere(shared * 185 >= 85 * (sizes[:, None] + sizes))
    assert sorted(zip(a, b)) == [tuple(x) for x in want]


def test_quality(docs, empty, rows):
    out = {}
    for r in quality.quality(docs).collect():
        out[r["doc_id"]] = r
    for doc, text in {r[0]: r[1] for r in rows}.items():
        words, r = WORD.findall(text or ""), out[doc]
        grams = collections.defaultdict(list)
        for i in range(len(words) - 4):
            grams[tuple(words[i : i + 5])].append(i)
        inside = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
        seen, repeated = set(), 0
        for line in (text or "").split("\n"):
            if WORD.search(line):
                repeated += line in seen
                seen.add(line)
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == sum((text or "").count(c) for c in quality.SYMBOLS)
        assert r["n_dup_lines"] == repeated and r["n_repeat_words"] == len(inside)
        failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
        assert r["base_failed"] == failed and not (failed and r["kept"])
    kept = quality.good_documents(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, r in out.items() if r["kept"]}
    assert quality.quality(empty).count() == 0


def test_longest_repeats():
    rng = random.Random(1)
    for _ in range(60):
        texts = [[rng.randrange(3) for _ in range(rng.randrange(25))] for _ in range(4)]
        words = np.array(sum(texts, []), dtype=np.int64)
        owner = np.repeat(np.arange(4), [len(x) for x in texts])
        expected = []
        for x in texts:
            for i in range(len(x)):
                ends = [0]
                for j in range(len(x)):
                    k = 0
                    while i != j and max(i, j) + k < len(x) and x[i + k] == x[j + k]:
                        k += 1
                    ends.append(k)
                expected.append(max(ends))
        assert list(quality.longest_repeats(words, owner)) == expected


def test_toxicity(spark):
    rng = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    data, labels = [], []
    for i in range(600):
        bad, junk = i % 5 == 0, i % 7 == 0
        text = [rng.choice(words) for _ in range(60)]
        if bad:
            text[::15] = ["vile"] * 4
        data.append((i, ("### " if junk else " ").join(text)))
        if i % 2:
            labels.append((i, int(not junk), int(bad)))
    docs = spark.createDataFrame([*data, (9000, None), (9001, "")], "doc_id bigint, text string")
    frame = spark.createDataFrame([*labels, (1, None, 1)], "doc_id bigint, quality int, toxic int")
    categories = {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}
    chain = toxicity.train_chain(docs, frame, categories)
    out = {r["doc_id"]: r for r in toxicity.classified(docs, chain).collect()}
    assert len(out) == 602
    held_out = [i for i in range(600) if i % 2 == 0]
    right = sum(out[i]["toxic"] == (i % 5 == 0) for i in held_out)
    assert right >= 0.98 * len(held_out)
    none = toxicity.train_chain(docs, frame.limit(0), categories)
    assert toxicity.classified(docs.limit(5), none).count() == 5


def test_token_files(spark, docs, empty, rows):
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(docs, folder, TOKENIZER)
    out = token_files.read_tokens(spark, folder).orderBy("start").collect()
    assert len(out) == len(rows)
    text, at = {r[0]: r[1] for r in rows}, 0
    assert [r["doc_id"] for r in out] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    for r in out:
        ids = list(np.frombuffer(r["ids"], "<u4"))
        assert r["start"] == at and ids == exact_ids(text[r["doc_id"]], 0)
        at += len(ids)
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(empty, folder, TOKENIZER)
    assert token_files.read_tokens(spark, folder).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, limit in ((0, 10), (1, 5), (1000, 10**6), (3000, 1 << 64)):
        values = np.unique(rng.integers(0, limit, n, dtype=np.uint64))
        sequence = language_model.EliasFano(*language_model.EliasFano.arrays(values, limit))
        assert (sequence.get(np.arange(len(values))) == values).all()
        asked = np.unique(np.append(values, rng.integers(0, limit, 500, dtype=np.uint64)))
        assert ((sequence.find(asked) >= 0) == np.isin(asked, values)).all()


def test_language_model(spark, docs, empty, rows):
    out = language_model.scored(docs, new_folder(spark, "model")).collect()
    assert len(out) == len(rows)
    tokens = [(r[0], WORD.findall(lowered(r[1])) + ["\n"]) for r in rows]
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in tokens}
    c1, c2, c3 = collections.Counter(), collections.Counter(), collections.Counter()
    for i, t in tokens:
        if not held[i]:
            s = ["\n", *t]
            c1.update(t), c2.update(zip(s, s[1:])), c3.update(zip(s, s[1:], s[2:]))
    n, v, once = sum(c1.values()), len(c1), sum(x == 1 for x in c1.values())
    unknown = (once + 1) / (n + 2)
    k2 = {k: x for k, x in c2.items() if x > 1}
    k3 = {k: x for k, x in c3.items() if x > 1}
    s2, s3 = collections.Counter(), collections.Counter()
    for k, x in k2.items():
        s2[k[0]] += x - 0.75
    for k, x in k3.items():
        s3[k[:2]] += x - 0.75
    texts = dict(tokens)
    for r in out:
        t = texts[r["doc_id"]]
        assert r["held_out"] == held[r["doc_id"]] and r["n_tokens"] == len(t)
        assert r["train_tokens"] == n and r["n_known"] == sum(w in c1 for w in t)
        base = sum(math.log10((c1[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert r["base_score"] == pytest.approx(base)
        score, s = 0.0, ["\n", *t]
        for i in range(1, len(s)):
            p = (1 - unknown) * c1[s[i]] / n if s[i] in c1 else unknown
            if s[i - 1] in c1:
                p *= 1 - s2[s[i - 1]] / c1[s[i - 1]]
                p += max(0, k2.get((s[i - 1], s[i]), 0.75) - 0.75) / c1[s[i - 1]]
            if i > 1 and (pair := (s[i - 2], s[i - 1])) in k2:
                p = p * (1 - s3[pair] / k2[pair])
                p += max(0, k3.get((*pair, s[i]), 0.75) - 0.75) / k2[pair]
            score += math.log10(min(p, 1))
        assert r["score"] == pytest.approx(score, abs=0.1 * len(t))
    assert language_model.scored(empty, new_folder(spark, "model")).count() == 0


def test_pipeline_keeps_columns_and_clean_documents(spark, docs, tmp_path):
    path = str(tmp_path)
    docs.write.parquet(f"{path}/documents.parquet")
    now = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, path)
        assert after.columns == docs.columns
        out = f"{path}/{name}"
        after.write.parquet(out)
        now = spark.read.parquet(out)
    lengthy = [r for r in now.collect() if r["doc_id"] == 20]
    assert len(lengthy) <= 2
    pieces = corpus_pipeline.run(spark, path)
    ids = {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()}
    assert ids == {r["doc_id"] for r in now.collect()}


def test_trie_keeps_no_context_beside_each_entry(spark, rows):
    """Children of an entry are kept by their number and sum, once a context."""
    values = np.sort(np.random.default_rng(3).integers(0, 5_000, 2_000))
    sequence = language_model.EliasFano(*language_model.EliasFano.arrays(values, 5_000))
    assert sequence.values().tolist() == values.tolist()
    folder = new_folder(spark, "model")
    docs = spark.createDataFrame([(i, "a b a b c d") for i in range(30)], "doc_id long, text string")
    assert language_model.scored(docs, folder, min_count=1).count() == 30
    kinds = {(f[0], f.rsplit("-", 1)[1]) for f in os.listdir(folder)}
    assert ("2", "counts.bin") in kinds and ("2", "pointers.low.bin") in kinds
    assert not kinds & {("2", "contexts.bin"), ("3", "contexts.bin"), ("3", "counts.bin")}
