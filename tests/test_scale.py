"""Plans and skew: what has to hold when one key holds a third of the rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from conftest import SF_SMALL
from wirespark.operators import expand, fulltext, joins, keyed, knn, tfidf
from wirespark.operators.terms import exploded_terms, with_term_counts


@pytest.fixture
def settings(spark):
    changed = {}

    def change(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, rows=200_000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string"))
    return spark.range(0, rows, 1, 16).select(
        key.alias("k"), F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("pad")
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_splits_a_hot_key(spark, settings, how):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    left = skewed(spark)
    right = left.groupBy("k").agg(F.max("id").alias("top")).filter(F.col("k") != "7")
    right = right if how in ("inner", "left") else right.select("k")
    joined = joins.lookup_join(left, right, "k", how)
    plan = final_plan(joined)
    assert "skew=true" in plan
    expected = left.join(right, "k", how)
    assert joined.count() == expected.count()
    assert joined.columns == expected.columns


def test_distinct_on_prunes_before_the_shuffle(spark):
    df = skewed(spark, 1000)
    first = keyed.distinct_on(df, ["k"], [F.desc("id")])
    plan = final_plan(first)
    assert plan.count("WindowGroupLimit") >= 2
    best = {r.k: r.top for r in df.groupBy("k").agg(F.max("id").alias("top")).collect()}
    assert {r.k: r.id for r in first.collect()} == best


def test_large_ranks_give_the_same_rows_as_small_ones(spark, settings):
    df = skewed(spark, 3000).select("k", (F.col("id") % 300).alias("v"))
    settings(spark__sql__optimizer__windowGroupLimitThreshold="5")
    by_key = {}
    for r in df.collect():
        by_key.setdefault(r.k, []).append(r.v)
    assert max(v.count(3) for v in by_key.values()) > 3
    for n in (3, 7, 50):
        rows = keyed.top_n_per_key(df, ["k"], [F.desc("v")], n)
        assert rows.columns == ["k", "v"]
        expected = sorted((k, v) for k, vs in by_key.items() for v in sorted(vs)[-n:])
        assert sorted(map(tuple, rows.collect())) == expected


def test_merged_top_n_equals_top_n(spark, settings):
    df = spark.range(0, 5000, 1, 40).select((F.col("id") % 977).alias("a"), "id")
    settings(spark__sql__optimizer__windowGroupLimitThreshold="5")
    order = [F.desc("a"), F.asc("id")]
    merged = keyed.top_n_merged(df, 100, order)
    assert merged.collect() == df.orderBy(*order).limit(100).collect()
    assert merged.columns == ["a", "id"]
    plan = final_plan(merged)
    assert plan.count("monotonically_increasing_id") >= 2


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("n", [1, 2, 3, 40, 1500])
def test_expanded_equals_one_limit_at_the_end(spark, how, n):
    first = spark.range(0, 90).select(
        (F.col("id") % 7).alias("k"), F.floor(F.col("id") / 3).alias("a")
    )
    child = spark.range(0, 60).select((F.col("id") % 5).alias("k"), F.floor(F.col("id") / 9).alias("b"))
    order, child_order = [F.asc("a"), F.asc("k")], [F.desc("b")]
    prefix = first.orderBy(*order).limit(n)
    kept = expand.first_children(child, prefix, "k", child_order, n)
    rows = expand.expanded(prefix, kept, "k", order, child_order, n, how)
    if how == "inner":  # every prefix row has to yield a row
        rows = expand.expanded(
            first.filter("k < 5").orderBy(*order).limit(n), kept, "k", order, child_order, n, how
        )
    whole = first.join(child, "k", how).orderBy(*order, *child_order).limit(n)
    assert rows.columns == ["k", "a", "b"]
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, whole.collect()))


def test_expanded_joins_few_rows_of_a_hot_key(spark, settings):
    settings(spark__sql__adaptive__enabled="false")
    n = 1500
    prefix = spark.range(0, n).select(F.lit("hot").alias("k"), F.col("id").alias("a"))
    child = spark.range(0, n).select(F.lit("hot").alias("k"), F.col("id").alias("b"))
    rows = expand.expanded(prefix, child, "k", [F.asc("a")], [F.asc("b")], n)
    needed = expand._placed(
        prefix.withColumn("c", F.lit(n)), F.col("c"), [F.asc("a")], n
    )
    assert needed.count() == 1
    assert sorted(r.b for r in rows.collect()) == list(range(n))
    assert {r.a for r in rows.collect()} == {0}


def test_small_broadcasts_only_limited_frames(spark):
    df = spark.range(5)
    assert "broadcast" in keyed.small(df, 10)._jdf.queryExecution().analyzed().toString().lower() or (
        "ResolvedHint" in keyed.small(df, 10)._jdf.queryExecution().analyzed().toString()
    )
    assert keyed.small(df, keyed.BROADCAST_ROWS + 1) is df


def test_pair_count_with_hot_keys(spark):
    left, right = skewed(spark, 3000), skewed(spark, 2000)
    expected = left.alias("a").join(right.alias("b"), "k").count()
    assert joins.pair_count(left, right, "k", "k").first()["count"] == expected
    assert joins.pair_count(left, right.filter("false"), "k", "k").first()["count"] == 0


LAZY = ["top_news", "theme_filter", "fts_search", "article_cards", "news_detail", "table_profile"]


@pytest.mark.parametrize("key", LAZY)
def test_no_cartesian_product_or_python(spark, key):
    plan = entry_module.queries()[key](spark, SF_SMALL)._jdf.queryExecution().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEval"):
        assert operator not in plan


def test_top_news_reads_the_columns_it_ranks_by(spark):
    plan = entry_module.queries()["top_news"](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan
    assert "partial_max(confidence" in plan


def brute_tfidf(texts: list[list[str]], min_df=2, max_df=0.8):
    grams = [w + [f"{a} {b}" for a, b in zip(w, w[1:])] for w in texts]
    df, n = {}, len(grams)
    for g in grams:
        for term in set(g):
            df[term] = df.get(term, 0) + 1
    idf = {
        t: math.log((1 + n) / (1 + c)) + 1 for t, c in df.items() if c >= min_df and c <= max_df * n
    }
    rows = []
    for g in grams:
        raw = {t: g.count(t) * idf[t] for t in set(g) if t in idf}
        length = math.sqrt(sum(x * x for x in raw.values()))
        rows.append({t: x / length for t, x in raw.items()})
    return idf, rows


def test_tfidf_against_brute_force(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(9)]
    texts = [[r.choice(words) for _ in range(r.randint(0, 8))] for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(" ".join(t) for t in texts)), "i int, x string")
    docs = tfidf.term_documents(df, "i", F.col("x"))
    vocab = tfidf.vocabulary(docs, "i")
    idf, rows = brute_tfidf(texts)
    assert {v.term: round(v.idf, 9) for v in vocab.collect()} == {
        t: round(x, 9) for t, x in idf.items()
    }
    found = [{} for _ in texts]
    for w in tfidf.weights(docs, "i", vocab).collect():
        found[w.i][w.term] = w.weight
    for ours, expected in zip(found, rows):
        assert ours == pytest.approx(expected)
        assert not ours or sum(x * x for x in ours.values()) == pytest.approx(1)

    query = "w1 w2 w3 nothing"
    nearest = tfidf.nearest(docs, "i", vocab, query, 30).collect()
    assert len(nearest) == 30
    q = {t: idf[t] for t in ("w1", "w2", "w3", "w1 w2", "w2 w3") if t in idf}
    length = math.sqrt(sum(x * x for x in q.values()))
    for row in nearest:
        cosine = sum(x * q.get(t, 0) / length for t, x in rows[row.i].items())
        assert row.similarity == pytest.approx(cosine, abs=1e-6)
        assert 0 <= row.similarity <= 1

    asked = spark.createDataFrame([(t, x / length) for t, x in q.items()], "term string, query_weight double")
    saved = tfidf.nearest_by_weights(tfidf.weights(docs, "i", vocab), docs, "i", asked, 30)
    assert [tuple(x) for x in saved.collect()] == [tuple(x) for x in nearest]


def test_vocabulary_limit_breaks_ties_by_term(spark):
    df = spark.createDataFrame([(i, "bb aa cc") for i in range(3)] + [(9, "zz")], "i int, x string")
    docs = tfidf.term_documents(df, "i", F.col("x"))
    vocab = tfidf.vocabulary(docs, "i", max_features=2).collect()
    assert [v.term for v in vocab] == ["aa", "aa cc"]


def test_term_counts_stay_per_row(spark):
    df = spark.createDataFrame([("d", "a b a"), ("d", "a"), ("e", ""), ("f", None)], "i string, x string")
    counted = with_term_counts(df, F.split("x", " "))
    assert sorted(tuple(r) for r in exploded_terms(counted, "i").collect()) == [
        ("d", "a", 1),
        ("d", "a", 2),
        ("d", "b", 1),
        ("e", "", 1),
    ]


def test_rank_rows_equals_rank_index(spark):
    texts = ["Stories of a story, storys", "history", "the cats and a cat", "", None, "houses house"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    terms = fulltext.query_terms(spark, "the STORY cats housees houses")
    assert terms == ["story", "cat", "housees", "house"]
    by_rows = fulltext.rank_rows(df, F.col("x"), terms).select("i", "rank").collect()
    index = fulltext.inverted_index(df, "i", F.col("x"))
    by_index = fulltext.rank_index(index, "i", terms).collect()
    assert sorted(map(tuple, by_rows)) == sorted(map(tuple, by_index)) == [
        (0, 0.3),
        (2, 0.2),
        (5, 0.2),
    ]
    assert fulltext.rank_rows(df, F.col("x"), fulltext.query_terms(spark, "the of")).count() == 0


def test_nearest_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [-1.0, 0.0]), (4, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "i int, v array<float>")
    target = F.array(F.lit(3.0), F.lit(0.0))
    found = knn.nearest_vectors(df, "i", "v", target, 3).collect()
    assert [tuple(r) for r in found] == [(1, 1.0), (4, 1.0), (2, 0.707107)]
