"""Awkward rows and columns: clashing and dotted names, rows that agree in id only, reruns."""

import collections

import pytest

from wirespark.llm import jaccard_join, line_templates, mixing, quality

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()
CLASHES = ["row", "given", "dropped", "_row", "_plan", "_copies", "_time", "_nth", "a.b", "kept", "hash"]
SHAPE = "doc_id bigint, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES)


def prose(seed: int, n: int) -> str:
    return " ".join(f"{WORDS[(seed * 7 + i * i) % 16]}{'' if i % 3 else seed + i}" for i in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    own = [f"own-{c}" for c in CLASHES]
    texts = [prose(i, 40) for i in range(30)]
    texts += [texts[0], texts[0] + " more", None, "", "x"]
    rows = [(i if i % 6 else None, t, f"s{i % 3}", *own) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SHAPE).repartition(3)


def as_sets(df):
    return collections.Counter(map(tuple, df.collect()))


def test_columns_of_any_name_are_kept(spark, docs):
    own = tuple(f"own-{c}" for c in CLASHES)
    classes = jaccard_join.near_duplicate_rows(docs, width=5, ratio=(4, 5))
    results = {
        "quality": quality.good_documents(docs),
        "lines": line_templates.without_recurring_lines(docs).drop("dropped_lines"),
        "unique": jaccard_join.one_of_each(docs, classes),
        "mixing": mixing.take_copies(docs),
    }
    given = as_sets(docs)
    for name, df in results.items():
        assert df.columns == docs.columns, name
        rows = df.collect()
        assert rows and all(tuple(r)[3:] == own for r in rows), name
        if name != "mixing":
            assert not as_sets(df) - given, name
    empty = docs.limit(0)
    assert quality.good_documents(empty).collect() == []
    assert mixing.take_copies(empty).collect() == []
    assert line_templates.without_recurring_lines(empty).collect() == []


def test_good_documents_are_those_that_quality_keeps(docs):
    verdicts = quality.quality(docs)
    kept = collections.Counter(r.doc_id for r in verdicts.filter("kept").collect())
    assert collections.Counter(r.doc_id for r in quality.good_documents(docs).collect()) == kept
    assert 0 < sum(kept.values()) < docs.count()


def test_rows_without_an_id_meet_their_target(spark):
    rows = [(None, prose(i, 10), "a") for i in range(300)] + [(7, prose(i, 10), "b") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mixed_sources(docs)
    again = mixing.mixed_sources(docs.repartition(7))
    assert as_sets(out) == as_sets(again)
    taken = collections.Counter()
    target = {}
    for r in out.collect():
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
    assert len(target) == 2
    for size, wanted in target.items():
        assert abs(taken[size] - wanted) <= 10


def test_texts_are_hashed_once(docs):
    """Not once for every line: the hash stands below the explode."""
    drops = line_templates.recurring_lines(docs)
    assert drops.columns == ["row", "dropped"]
    many = docs.sparkSession.createDataFrame(
        [(1, "\n".join(f"one two three line {i}" for i in range(20_000)), "s")],
        "doc_id bigint, text string, source string",
    )
    cleaned = line_templates.without_recurring_lines(many).first()
    assert cleaned.text.count("\n") == 19_999 and list(cleaned.dropped_lines) == []
