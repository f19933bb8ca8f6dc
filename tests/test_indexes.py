"""Summaries and indexes against the full computation."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF
from wirespark.functions.text import contains_ignoring_case
from wirespark.operators import frequent, postings, tfidf, trigrams, vector_index
from wirespark.operators.knn import cosine
from wirespark.session import new_folder, written


def metric(df, name: str) -> int:
    """Sum of a metric over the scans of an executed plan."""
    df = df.select("*")  # a plan of its own, not executed before
    df.collect()
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
            continue
        if kind == "FileSourceScanExec":
            found = node.metrics().get(name)
            total += found.get().value() if found.isDefined() else 0
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_pruning_keeps_the_bound():
    rng = random.Random(1)
    for _ in range(50):
        true = {f"t{i}": rng.randrange(1, 30) for i in range(rng.randrange(1, 60))}
        counts = pa.table({"item": list(true), "n": pa.array(true.values(), pa.int64())})
        kept, lost = frequent.pruned(counts, 20)
        assert kept.num_rows <= 20
        left = dict(zip(kept["item"].to_pylist(), kept["n"].to_pylist(), strict=True))
        for item, n in true.items():
            assert 0 <= n - left.get(item, 0) <= lost
    assert frequent.pruned(counts.slice(0, 20), 20)[1] == 0


def term_rows(spark, counts: list[tuple[str, int]], parts=4):
    """One document for each (term, tf)."""
    rows = [(i, [(term, tf)]) for i, (term, tf) in enumerate(counts)]
    shape = "i int, terms array<struct<term:string,tf:bigint>>"
    return spark.createDataFrame(rows, shape).repartition(parts)


def best_terms(counts, k, min_df=1):
    cf, df = collections.Counter(), collections.Counter()
    for term, tf in counts:
        cf[term] += tf
        df[term] += 1
    rows = [(t, df[t], cf[t]) for t in cf if df[t] >= min_df]
    return sorted(rows, key=lambda r: (-r[2], r[0]))[:k]


def adversarial(kind: str) -> list[tuple[str, int]]:
    rng = random.Random(kind)
    if kind == "zipf":
        counts = [(f"w{min(int(rng.paretovariate(0.9)), 4000)}", 1) for _ in range(8000)]
    elif kind == "ties":
        counts = [(f"t{i % 300:03}", 2) for i in range(900)]
    elif kind == "flat":
        counts = [(f"f{i}", 1) for i in range(3000)] * 2
    elif kind == "late":  # the frequent ones come last, after all room is taken
        counts = [(f"a{i}", 3) for i in range(2000)] + [(f"z{i % 20}", 1) for i in range(4000)]
    else:  # frequent in one document only, refused by min_df
        counts = [(f"once{i}", 1000) for i in range(200)] + [(f"n{i % 40}", 2) for i in range(400)]
    return counts


@pytest.mark.parametrize("kind", ["zipf", "ties", "flat", "late", "refused"])
@pytest.mark.parametrize("k, capacity", [(10, 20), (25, 400)])
def test_vocabulary_from_summaries(spark, kind, k, capacity):
    counts = adversarial(kind)
    docs = term_rows(spark, counts)
    found = tfidf.vocabulary(docs, "i", max_features=k, min_df=2, max_df=1.0, capacity=capacity)
    found = sorted(((r.term, r.df, r.cf) for r in found.collect()), key=lambda r: (-r[2], r[0]))
    assert found == best_terms(counts, k, 2)


def test_summaries_bound_what_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(frequent, "GATHERED", 100)
    counts = adversarial("zipf")
    rows = term_rows(spark, counts, 5).select(F.inline("terms")).toDF("item", "n")
    found = frequent.summaries(rows, lambda batch: [pa.Table.from_batches([batch])], 50)
    assert found.count() <= 5 * 51
    merged = {r.item: r.n for r in frequent.merged(found).collect()}
    error = merged.pop(None)
    true = collections.Counter()
    for term, tf in counts:
        true[term] += tf
    assert 0 < error < sum(true.values()) / 10
    for term, n in true.items():
        assert merged.get(term, 0) <= n <= merged.get(term, 0) + error


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(0, 25))) for _ in range(3000)]
    texts += ["w50 w50 w50"] * 300 + [""] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string").repartition(4)
    return written(tfidf.term_documents(df, "i", F.col("x")), "documents")


@pytest.fixture(scope="module")
def indexed(spark, documents):
    vocab = written(tfidf.vocabulary(documents, "i", max_features=200), "vocab")
    path = new_folder(spark, "postings")
    postings.write_postings(tfidf.weighted_rows(documents, "i", vocab), "i", path)
    return vocab, path


def test_words_count_like_terms(spark, monkeypatch):
    """Words, with their pairs formed in the task, give what counted terms give."""
    monkeypatch.setattr(tfidf, "SLICE_WORDS", 64)
    rng = random.Random(9)
    texts = [" ".join(rng.choices("ab bc cd de ef fg".split(), k=rng.randrange(0, 40))) for _ in range(80)]
    df = spark.createDataFrame([*enumerate(texts), (99, None)], "i int, x string").repartition(3)
    both = [f(df, "i", F.col("x")) for f in (tfidf.term_documents, tfidf.word_documents)]
    for features in (5, 40, None):
        vocab = [tfidf.vocabulary(d, "i", max_features=features) for d in both]
        assert sorted(map(tuple, vocab[0].collect())) == sorted(map(tuple, vocab[1].collect()))
    vocab = tfidf.vocabulary(both[0], "i", max_features=30)
    weights = [{(r.i, r.term): r.weight for r in tfidf.weights(d, "i", vocab).collect()} for d in both]
    assert weights[0] == pytest.approx(weights[1])
    found = [tfidf.nearest(d, "i", vocab, "ab bc", 12).collect() for d in both]
    assert found[0] == found[1]


def test_weights_in_the_row_equal_joined_weights(spark, documents, indexed):
    vocab, _ = indexed
    in_row = tfidf.weights(documents, "i", vocab, 200)
    assert "Exchange" not in in_row._jdf.queryExecution().executedPlan().toString()
    joined = tfidf.weights(documents, "i", vocab, None)
    rows = [{(r.i, r.term): r.weight for r in df.collect()} for df in (in_row, joined)]
    assert rows[0].keys() == rows[1].keys()
    assert all(rows[0][key] == pytest.approx(rows[1][key]) for key in rows[0])


def test_block_max_search_equals_the_full_scan(spark, documents, indexed):
    vocab, path = indexed
    rng = random.Random(2)
    first_keys = spark.read.parquet(f"{path}/first_keys")
    for _ in range(6):
        query = " ".join(rng.choices([f"w{i}" for i in range(60)], k=rng.randrange(1, 4)))
        k = rng.choice([1, 10, 40])
        asked = [tuple(r) for r in tfidf.query_weights(vocab, query).collect()]
        found = postings.best_documents(spark, path, "i", asked, k, first_blocks=2)
        found = postings.filled_up(found, first_keys, "i", k)
        whole = tfidf.nearest(documents, "i", vocab, query, k, max_features=None)
        direct = tfidf.nearest(documents, "i", vocab, query, k)
        rows = [[(r.i, round(r.similarity, 5)) for r in df.collect()] for df in (found, whole, direct)]
        assert rows[0] == rows[1] == rows[2]


def test_block_max_search_reads_few_blocks(spark, indexed):
    vocab, path = indexed
    asked = [tuple(r) for r in tfidf.query_weights(vocab, "w50").collect()]
    found = postings.best_documents(spark, path, "i", asked, 10, first_blocks=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(block," in plan and "LessThanOrEqual(block," in plan
    everything = spark.read.parquet(f"{path}/postings").filter("term = 'w50'")
    read = everything.filter(postings.in_blocks(_named_blocks(plan)))
    assert 0 < read.count() < everything.count() / 2


def _named_blocks(plan: str) -> list[int]:
    """Blocks within the ranges of the scan's filter."""
    import re

    low = [int(x) for x in re.findall(r"GreaterThanOrEqual\(block,(\d+)\)", plan)]
    high = [int(x) for x in re.findall(r"LessThanOrEqual\(block,(\d+)\)", plan)]
    return [b for a, z in zip(low, high, strict=True) for b in range(a, min(z, a + 5000) + 1)]


def test_documents_are_weighed_once(spark):
    met = spark.sparkContext.accumulator(0)

    def weighed(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    schema = "id bigint, entries array<struct<term:string,weight:double>>"
    entry = "struct(concat('t', id % 7) AS term, CAST(id AS double) AS weight)"
    rows = spark.range(500).selectExpr("id", f"array({entry}) AS entries")
    path = new_folder(spark, "index")
    postings.write_postings(rows.mapInArrow(weighed, schema), "id", path)
    assert met.value == 500
    blocks = spark.read.parquet(f"{path}/blocks").groupBy("term").agg(F.max("most").alias("most"))
    assert {r.term: r.most for r in blocks.collect()} == {f"t{i % 7}": i for i in range(493, 500)}


def test_postings_are_listed_by_block(spark):
    """A row for each term and block, whatever batches its rows come in; a key is stored once."""
    rng = random.Random(4)
    rows = []
    for i in range(900):
        terms = rng.sample([f"t{j}" for j in range(30)], rng.randrange(0, 6))
        entries = [(t, float(rng.randrange(1, 4))) for t in terms]
        length = math.sqrt(sum(w * w for _, w in entries))
        rows.append((None if i == 5 else i % 880, entries, length))
    schema = "id int, entries array<struct<term:string,weight:double>>, length double"
    path, batch = new_folder(spark, "index"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "100")
    try:
        postings.write_postings(spark.createDataFrame(rows, schema).repartition(2), "id", path)
    finally:
        spark.conf.set(batch, before)
    listed = spark.read.parquet(f"{path}/postings")
    blocks = spark.read.parquet(f"{path}/blocks")
    keys = spark.read.parquet(f"{path}/documents").select(F.explode("keys").alias("id"))
    stored = collections.Counter(r.id for r in keys.collect())
    assert stored == collections.Counter(i for i, entries, _ in rows if entries)
    assert listed.count() == listed.select("term", "block").distinct().count() == blocks.count()
    assert listed.agg(F.sum(F.size("places"))).first()[0] == sum(len(e) for _, e, _ in rows)
    heaviest = collections.Counter()
    for _, entries, length in rows:
        for term, weight in entries:
            heaviest[term] = max(heaviest[term], weight / length)
    most = blocks.groupBy("term").agg(F.max("most").alias("most")).collect()
    assert {r.term: r.most for r in most} == dict(heaviest)
    asked = {"t3": 0.8, "t7": 0.6}
    sums = collections.Counter()
    for i, entries, length in rows:
        for term, weight in entries:
            if term in asked:
                sums[i] += weight / length * asked[term]
    for k in (10, 2000):
        found = postings.best_documents(spark, path, "id", list(asked.items()), k).collect()
        scores = sorted((round(x, 6) for x in sums.values()), reverse=True)[:k]
        assert [r.similarity for r in found] == pytest.approx(scores, abs=2e-6)
        assert all(r.similarity == pytest.approx(sums[r.id], abs=2e-6) for r in found)


def test_few_hits_are_filled_up(spark, indexed):
    vocab, path = indexed
    found = postings.best_documents(spark, path, "i", [], 5)
    assert found.count() == 0
    filled = postings.filled_up(found, spark.read.parquet(f"{path}/first_keys"), "i", 5)
    assert [tuple(r) for r in filled.collect()] == [(i, 0.0) for i in range(5)]


def test_ranges_cover_and_part_at_gaps():
    assert postings.ranges([5, 1, 2, 40, 41, 90], 3) == [(1, 5), (40, 41), (90, 90)]
    assert postings.ranges([3], 8) == [(3, 3)]
    rng = random.Random(3)
    for _ in range(50):
        numbers = rng.sample(range(1000), rng.randrange(1, 40))
        parts = postings.ranges(numbers)
        assert len(parts) <= postings.RANGES
        assert all(any(a <= n <= b for a, b in parts) for n in numbers)


def neighbours_by_hand(rows, k):
    usable = {
        i: np.array(v, float) / np.linalg.norm(v)
        for i, v in rows
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = {}
    for q, v in usable.items():
        scored = sorted((-round(float(v @ x), 6), i) for i, x in usable.items())
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


@pytest.mark.parametrize("part_rows", [16_384, 16])
def test_exact_neighbours(spark, monkeypatch, part_rows):
    monkeypatch.setattr(vector_index, "PART_ROWS", part_rows)
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(6, 8))
    rows = [(i, (middle[i % 6] + rng.normal(size=8) * 0.3).tolist()) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(60)]
    rows += [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] * 8), (904, [])]
    df = spark.createDataFrame(rows, "i int, v array<double>").repartition(3)
    path = new_folder(spark, "vectors")
    vector_index.write_index(df, "i", "v", path, cells=12)
    wanted = neighbours_by_hand(rows, 7)
    found = collections.defaultdict(list)
    exact = vector_index.neighbours(spark, path, df, "i", "v", 7, probes=1, exact=True)
    for r in exact.orderBy("query", F.desc("similarity"), "i").collect():
        found[r.query].append((r.i, r.similarity))
    assert set(found) == set(wanted)
    for q, best in wanted.items():
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in best], abs=1.1e-6)
    same = sum([i for i, _ in found[q]] == [i for i, _ in wanted[q]] for q in wanted)
    assert same >= len(wanted) - 2  # a similarity may round otherwise
    none = vector_index.neighbours(spark, path, df.filter("i > 899"), "i", "v", 7, exact=True)
    assert none.count() == 0


def test_empty_vector_index(spark):
    df = spark.createDataFrame([], "i int, v array<double>")
    path = new_folder(spark, "vectors")
    vector_index.write_index(df, "i", "v", path)
    assert vector_index.neighbours(spark, path, df, "i", "v").collect() == []


def test_recall_of_probed_cells(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet".replace("sf0.01", "sf0.1")).select(
        "vec_id", "embedding"
    )
    path = new_folder(spark, "vectors")
    vector_index.write_index(df, "vec_id", "embedding", path)
    queries = df.filter("vec_id % 100 = 0")
    found = vector_index.neighbours(spark, path, queries, "vec_id", "embedding")
    both = queries.select(F.col("vec_id").alias("q"), F.col("embedding").alias("e"))
    pairs = both.crossJoin(df).select("q", "vec_id", F.round(cosine(F.col("e"), F.col("embedding")), 6).alias("s"))
    least = {}
    for r in pairs.collect():
        least.setdefault(r.q, []).append(r.s)
    least = {q: sorted(s)[-20] for q, s in least.items()}
    hits = collections.Counter(r.query for r in found.collect() if r.similarity >= least[r.query] - 1e-6)
    recall = sum(min(20, hits[q]) for q in least) / (20 * len(least))
    assert recall >= 0.9


TEXTS = [
    (1, "Tax Reform in Örebro", "alpha"),
    (2, "tax%form_x", "beta"),
    (3, "TAX", None),
    (4, None, "taxform"),
    (5, "", "al"),
    (6, "unrelated words", "ALPHABET"),
    (7, "ta xf orm", "x_a"),
]


@pytest.mark.parametrize("text", ["tax", "TAX", "form", "ö", "al", "%form", "pha", "nothing", "x_a"])
def test_trigram_search_equals_the_scan(spark, text):
    rows = TEXTS + [(100 + i, f"filler {i} text", f"other {i % 7}") for i in range(600)]
    df = spark.createDataFrame(rows, "i int, a string, b string").repartition(3)
    path = new_folder(spark, "grams")
    trigrams.write_trigrams(df, ["a", "b"], ["a", "i"], path)
    for columns in (["a", "b"], ["b"]):
        found = trigrams.containing(spark, path, columns, text)
        test = F.lit(False)
        for c in columns:
            test = test | contains_ignoring_case(F.col(c), text)
        expected = df.filter(test)
        assert found.columns == df.columns
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    for pattern in (text, text.replace("x", "_"), f"{text[:1]}%{text[1:]}"):
        found = trigrams.matching(spark, path, "a", pattern)
        expected = df.filter(F.col("a").ilike(f"%{pattern}%"))
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_trigram_search_reads_few_rows(spark):
    rows = [(i, f"source{i // 500} number {i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "i int, a string").repartition(3)
    path = new_folder(spark, "grams")
    trigrams.write_trigrams(df, ["a"], ["a", "i"], path)
    found = trigrams.containing(spark, path, ["a"], "SOURCE7 number")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(block," in plan
    assert found.count() == 500
    blocks = trigrams.candidates(spark, path, ["a"], ["source7 number"]).select("block").distinct()
    assert blocks.count() <= 4
    nothing = trigrams.containing(spark, path, ["a"], "absent text")
    assert nothing.count() == 0 and metric(nothing, "numOutputRows") == 0


def test_literal_runs():
    assert trigrams.literal_runs("a%b_c") == ["a", "b", "c"]
    assert trigrams.literal_runs("50\\%_x") == ["50%", "x"]
    assert trigrams.literal_runs("a%b", literal=True) == ["a%b"]
    assert trigrams.grams_of(["ABCD", "bc"]) == ["abc", "bcd"]


class Tasks:
    """Stands for a frame: gives the function of its tasks instead of running it."""

    def __init__(self, schema=None):
        self.schema = schema

    def mapInArrow(self, function, schema):
        return function


def test_summaries_hold_repeated_items_once(monkeypatch):
    added_up, sizes = frequent._added_up, []

    def recorded(tables):
        sizes.append(sum(table.num_rows for table in tables))
        return added_up(tables)

    monkeypatch.setattr(frequent, "_added_up", recorded)
    table = pa.table({"item": ["a", "b", "c", "d"] * 250, "n": pa.array([1] * 1000, pa.int64())})
    task = frequent.summaries(Tasks(), lambda batch: [table], 10)
    out = pa.Table.from_batches(task(iter(range(20)))).to_pydict()
    found = dict(zip(out["item"], out["n"], strict=True))
    assert found == {"a": 5000, "b": 5000, "c": 5000, "d": 5000, None: 0}
    assert max(sizes) <= 1000


def test_vectors_of_queries_are_copied_few_at_a_time(spark):
    """A query that goes to all cells is not copied for all of them at once."""
    rng = np.random.default_rng(5)
    cells = [
        {"cell": i, "centroid": c.tolist(), "parts": 1 + i % 3, "near": 0.0}
        for i, c in enumerate(rng.normal(size=(40, 64)))
    ]
    units = rng.normal(size=(1000, 64))
    lists = pa.FixedSizeListArray.from_arrays(pa.array(units.ravel()), 64)
    lists = lists.cast(pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), lists], ["i", "unit"])
    schema = T.StructType.fromDDL("i bigint, unit array<double>")
    task = vector_index._sent(Tasks(schema), "i", cells, len(cells), False)
    before, most, met = pa.total_allocated_bytes(), 0, []
    for part in task(iter([batch])):
        most = max(most, pa.total_allocated_bytes() - before)
        met += zip(*[part.column(c).to_pylist() for c in ("i", "cell", "part")])
        for row, number in enumerate(part.column("i").to_pylist()[:3]):
            assert part.column("unit")[row].as_py() == units[number].tolist()
    pairs = [(i, c["cell"], p) for i in range(1000) for c in cells for p in range(c["parts"])]
    assert sorted(met) == pairs
    assert most < len(pairs) * 64 * 8 / 4
