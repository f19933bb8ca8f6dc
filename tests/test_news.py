"""News queries on random relations with repeated URLs, records, titles and ties.

The star-schema tables give one record per URL, so the plans' reductions are
checked here on data where every side of every join fans out.
"""

import random

import duckdb
import pandas as pd
import pytest

import oracle
from compare import canonical
from wirespark.plans import detail, news, search, stats
from wirespark.schemas import CHILD_TABLES, NewsTables, table_schema


def make_rows(seed: int) -> dict[str, list[tuple]]:
    r = random.Random(seed)
    urls = [f"u{i}" for i in range(6)] + [None]
    hot = lambda choices: choices[0] if r.random() < 0.34 else r.choice(choices)
    events = [
        (
            str(i),
            r.choice([20240105, 20240106, 20240199, None]),
            r.choice(["A", "B", None]),
            r.choice(["A", "C", None]),
            r.choice(["010", "042"]),
            "010",
            "01",
            1,
            float(r.randint(-3, 3)),
            r.choice([0, 1, 2, 3, None]),
            r.choice([-1.5, 0.0, 2.0, None]),
            *[0.0] * 6,
            20240105000000 + r.randint(0, 5),
            hot(urls),
        )
        for i in range(60)
    ]
    mentions = [
        (
            hot([str(i) for i in range(70)]),
            20240105000000,
            "s",
            f"m{r.randint(0, 3)}",
            r.choice([-50.0, 50.0, 20.0, None]),
        )
        for _ in range(150)
    ]
    titles = ["", *[f"<PAGE_TITLE>t{i} story</PAGE_TITLE>" for i in range(4)]]
    gkg = [
        (
            r.choice([f"r{i}" for i in range(12)] + ["1", "2"]),
            "20240105000000",
            r.choice(["src1", "src2", None]),
            hot(urls),
            r.choice(["X_TAX;Y;", "Y;", "", None]),
            r.choice(["p1;p2", None]),
            "o1;o2;o1",
            r.choice(["http://i", None]),
            None,
            "Name A,3;Name B,9",
            r.choice(titles),
        )
        for _ in range(20)
    ]
    items = {
        table: [
            (f"r{r.randint(0, 11)}", r.choice([f"{item}_1", f"x{item}2", f"{item}3"]))
            for _ in range(25)
        ]
        for table, (_, item) in CHILD_TABLES.items()
    }
    return {"events": events, "mentions": mentions, "gkg": gkg, **items}


@pytest.fixture(params=[1, 2, 3], scope="module")
def world(request, spark):
    rows = make_rows(request.param)
    frames = {n: spark.createDataFrame(v, table_schema(n)).repartition(3) for n, v in rows.items()}
    connection = duckdb.connect()
    names = {"events": "ev0", "mentions": "mn", "gkg": "gk"}
    names |= {
        "gkg_themes": "gt",
        "gkg_persons": "gp",
        "gkg_organizations": "go_",
        "gkg_names": "gn",
    }
    for table, name in names.items():
        schema = table_schema(table)
        types = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}
        columns = ", ".join(f"{f.name} {types[f.dataType.simpleString()]}" for f in schema)
        connection.execute(f"CREATE TABLE {name} ({columns})")
        marks = ", ".join("?" * len(schema))
        connection.executemany(f"INSERT INTO {name} VALUES ({marks})", rows[table])
    connection.execute(
        "CREATE VIEW ev AS SELECT *, CAST(try_strptime(CAST(sqldate AS VARCHAR), '%Y%m%d') AS DATE)"
        " AS event_date FROM ev0"
    )
    return NewsTables(**frames), connection


def tail(key: str) -> str:
    """Oracle SQL without the definitions of the relations."""
    sql = oracle.oracle_sql(PARAMETERS)[key]
    given = (oracle.EV, oracle.MN, oracle.GK, oracle.GT, oracle.GP, oracle.GO, oracle.GN)
    for definition in given:
        sql = sql.replace(definition + ",\n", "").replace(definition + "\n", "")
    return sql.removeprefix("WITH ") if sql.startswith("WITH SELECT") else sql


class PARAMETERS:
    FEATURED = 40
    THEME = "e_1"
    LITERAL_THEME = "e_1"
    CONTAINS = "a"
    SOURCE = "SRC1"
    AS_OF = "2024-01-06 00:00:00"
    SEARCH_TERMS = ["a"]
    NEWS_TERMS = ["story", "x", "p1"]
    WORDS = "story"
    NEWS_ID = "7"
    NEWS_QUERY = "t1 story org p2"


def check(world, df, key):
    _, connection = world
    cursor = connection.execute(tail(key))
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    ours = canonical(df.columns, [tuple(row) for row in df.collect()])
    assert ours == canonical(names, cursor.fetchall())
    assert ours


def test_top_news(world):
    check(world, news.top_news(world[0]), "top_news")


@pytest.mark.parametrize("limit", [1, 7, 40, 2000])
def test_featured_news(world, limit, monkeypatch):
    monkeypatch.setattr(PARAMETERS, "FEATURED", limit)
    check(world, news.featured_news(world[0], limit), "featured_news")


def test_filter_news(world):
    check(world, news.filter_news(world[0], "e_1"), "theme_filter")
    check(world, news.filter_news(world[0], "E_1", literal=True), "theme_filter_literal")


def test_filter_news_literal_underscore(world):
    t, _ = world
    wild = news.filter_news(t, "xtheme_", literal=False).count()
    assert wild > 0
    assert news.filter_news(t, "xtheme_", literal=True).count() == 0


def test_search_news(world):
    check(world, search.search_news(world[0], "stories, x p1"), "fts_search")


def test_all_articles_filters(world):
    articles = news.all_articles(world[0])
    check(world, news.contains_search(articles, "A"), "contains_search")
    check(world, news.source_filter(articles, "SRC1"), "source_filter")
    assert news.source_filter(articles, "All").count() == 60


def test_recent_and_latest(world):
    check(world, news.recent_news(world[0]), "recent_news")
    check(world, news.latest_news(world[0], PARAMETERS.AS_OF), "latest_news")


@pytest.mark.parametrize(
    "link, key", [("url", "news_detail"), ("id", "news_detail_by_record_id")]
)
def test_detail(world, link, key):
    check(world, detail.news_detail(world[0], link=link), key)


def test_detail_of_one(world):
    t, _ = world
    whole = detail.news_detail(t)
    for news_id in ("1", "7"):
        one = detail.news_detail(t, news_id)
        expected = [tuple(r) for r in whole.filter(whole.id == news_id).collect()]
        assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in one.collect())
    assert detail.news_detail(t, "none").count() == 0


@pytest.mark.parametrize(
    "link, key", [("url", "search_corpus"), ("id", "search_corpus_by_record_id")]
)
@pytest.mark.parametrize("limit", [1, 30, 10_000])
def test_corpus(world, link, key, limit):
    t, connection = world
    ours = search.search_corpus(t, limit, link=link)
    sql = tail(key).replace("LIMIT 10000", f"LIMIT {limit}")
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    assert canonical(ours.columns, map(tuple, ours.collect())) == canonical(
        names, cursor.fetchall()
    )


@pytest.mark.parametrize("max_features", [1000, None])
def test_search_tfidf(world, max_features):
    t, _ = world
    found = search.search_tfidf(t, PARAMETERS.NEWS_QUERY, max_features=max_features)
    check(world, found, "search_tfidf")


def test_every_event_and_record_is_a_document(world):
    t, connection = world
    sql = tail("search_tfidf").split("ct_words AS (")[0].rstrip().removesuffix(",")
    expected = connection.execute(f"{sql} SELECT count(*) FROM rows").fetchone()[0]
    rows = search.corpus_documents(t.events, t.gkg)
    assert rows.count() == expected == rows.select("document").distinct().count()


def test_counts(world):
    t, connection = world
    check(world, stats.stats(t, PARAMETERS.AS_OF[:10]), "stats")
    check(world, stats.table_profile(t), "table_profile")
    approximate = {r["metric"] for r in stats.stats(t, "2024-01-06", approximate=True).collect()}
    assert len(approximate) == 5
    assert {k: v.count() for k, v in stats.table_samples(t).items()} == {
        "events": 5,
        "mentions": 5,
        "gkg": 5,
    }


def test_arguments_are_required(world):
    t, _ = world
    for call in (
        lambda: news.filter_news(t, ""),
        lambda: search.search_news(t, ""),
        lambda: search.search_tfidf(t, "  "),
        lambda: detail.news_detail(t, ""),
        lambda: news.contains_search(t.gkg, ""),
    ):
        with pytest.raises(ValueError):
            call()


def test_null_order_of_descending_keys(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1.0, None, 3.0]}))
    df = df.selectExpr("nullif(a, double('NaN')) AS a")
    assert [r.a for r in df.orderBy(news.desc("a")).collect()] == [None, 3.0, 1.0]
