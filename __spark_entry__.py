
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime
from functools import lru_cache, partial
from types import SimpleNamespace

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from wirespark.functions import cards, dates, text  # noqa: E402
from wirespark.operators import fulltext, joins, knn, tfidf, vector_index  # noqa: E402
from wirespark.plans import (  # noqa: E402
    detail,
    etl,
    increments,
    lookup,
    news,
    ranking,
    saved,
    search,
    segments,
    sketches,
    stats,
)
from wirespark.schemas import BASE_TABLES, NewsTables, table_schema  # noqa: E402
from wirespark.session import new_folder, settled, written  # noqa: E402
from wirespark.sources import feeds, manifest  # noqa: E402
from wirespark.sources.derived import derived_tables, read_table  # noqa: E402
from wirespark.streaming.ingest import BATCH, ingest  # noqa: E402

try:
    import corpus_pipeline
    from wirespark.llm import queries as corpus
except ImportError:  # the corpus operators are an optional part
    corpus = None

SMOKE_DIR = "/root/testdata/sf0.001"

PARAMETERS = SimpleNamespace(
    FEATURED=25,
    THEME="standard",
    LITERAL_THEME="y_brand_1",
    CONTAINS="actor_1",
    SOURCE="src1",
    AS_OF="2024-01-20 12:00:00",
    SEARCH="the sections, retitioning parties or statements",
    SEARCH_TERMS=["section", "retitioning", "party", "statement"],
    NEWS="person rings 13 ECONOMY brushed",
    NEWS_TERMS=["person", "ring", "13", "economy", "brushed"],
    WORDS="and under retitioning the parties le eaux",
    NEWS_ID="7",
    NEWS_QUERY="person 7 org 4 red widget ACTOR_12",
)
P = PARAMETERS


@lru_cache(maxsize=4)
def _relations(spark: SparkSession, sf_dir: str) -> NewsTables:
    """The lazy relations of a data folder, declared once per session."""
    return derived_tables(spark, sf_dir)


def _news(query: Callable[[NewsTables], DataFrame]):
    """A query over the relations derived from a data folder."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(_relations(spark, sf_dir))

    return run


def _table(name: str, query: Callable[[DataFrame], DataFrame]):
    """A query over one of the given tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(read_table(spark, sf_dir, name))

    return run


def _page_titles(pages: DataFrame) -> DataFrame:
    html = F.col("html")
    return pages.select(
        "page_id",
        text.tag_text(html, "title").alias("title"),
        text.tag_text_or_empty(html, "h1").alias("heading"),
    )


def _article_cards(t: NewsTables) -> DataFrame:
    c = F.col
    return news.all_articles(t).select(
        "id",
        dates.date_label(c("event_date")).alias("date_label"),
        cards.theme_category(c("theme")).alias("category"),
        cards.display_title(c("title"), c("actor1_name"), c("actor2_name"), c("theme")).alias(
            "display_title"
        ),
        cards.excerpt(
            c("actor1_name"), c("actor2_name"), c("theme"), c("num_mentions"), c("avg_tone")
        ).alias("excerpt"),
        cards.tone_label(c("avg_tone")).alias("tone"),
        cards.article_url(c("source_url"), F.lit(None).cast("string")).alias("link"),
        cards.image_url(c("image"), c("theme")).alias("picture"),
        cards.confidence_label(c("confidence")).alias("confidence_label"),
        cards.theme_label(c("theme")).alias("theme_label"),
        cards.source_label(c("source")).alias("source_label"),
    )


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    return written(tfidf.word_documents(docs, "doc_id", F.col("text")), "words")


def _tfidf_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = tfidf.vocabulary(_documents(spark, sf_dir), "doc_id")
    return vocab.withColumn("idf", F.round("idf", tfidf.DIGITS))


def _tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    rows = tfidf.weights(docs, "doc_id", tfidf.vocabulary(docs, "doc_id"))
    return rows.withColumn("weight", F.round("weight", tfidf.DIGITS))


def _tfidf_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return tfidf.nearest(docs, "doc_id", tfidf.vocabulary(docs, "doc_id"), P.WORDS)


def _fts_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fulltext.inverted_index(_texts(spark, sf_dir), "doc_id", F.col("text"))


def _fts_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = fulltext.query_terms(spark, P.SEARCH)
    return fulltext.rank_index(_fts_index(spark, sf_dir), "doc_id", terms)


def _knn(vectors: DataFrame) -> DataFrame:
    return knn.nearest_vectors(
        vectors, "vec_id", "embedding", knn.mean_vector(vectors, "embedding")
    )


def _knn_cells(exact: bool):
    """The nearest vectors of every vector whose id is divisible by 100, by a saved index."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, "vectors")
        vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
        vector_index.write_index(vectors, "vec_id", "embedding", folder)
        queries = vectors.filter(F.col("vec_id") % 100 == 0)
        return vector_index.neighbours(
            spark, folder, queries, "vec_id", "embedding", exact=exact
        )

    return run


def _saved_text(query: Callable[[NewsTables, str], DataFrame]):
    """A query over saved text indexes of the relations."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, "texts")
        t = _relations(spark, sf_dir)
        saved.write_text_indexes(t, folder)
        return query(t, folder)

    return run


def _interval_manifest(events: DataFrame) -> DataFrame:
    quarter = F.floor(F.extract(F.lit("MINUTE"), "_t") / 15).cast("int") * 15
    hour = F.date_trunc("HOUR", "_t").cast("timestamp_ntz")
    span = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    for end in ("low", "high"):
        span = span.withColumn("_t", F.col(end))
        span = span.withColumn(end, hour + F.make_dt_interval(mins=quarter))
    steps = manifest.intervals(span, "low", "high")
    return manifest.feed_manifest(steps, "http://feed.example.com/v2/", "landing")


def _round_quarter_hour(events: DataFrame) -> DataFrame:
    start, end = manifest.quarter_hour_range(
        F.col("ts"), F.lit(P.AS_OF).cast("timestamp_ntz")
    )
    return events.select("event_id", start.alias("start_at"), end.alias("end_at"))


def _format_elapsed(events: DataFrame) -> DataFrame:
    seconds = F.floor(F.col("value") * 100)
    return events.select("event_id", dates.elapsed_label(seconds).alias("elapsed"))


def _feed_roundtrip(table: str, feed: str):
    """A whole base table written as raw feed files and read back through the feed source."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, feed)
        feeds.write_feed(getattr(_relations(spark, sf_dir), table), folder, feed)
        return feeds.read_feed(spark, folder, feed)

    return run


def _etl_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All base tables landed as feed files, transformed, and the result profiled."""
    landed, clean = new_folder(spark, "landed"), new_folder(spark, "clean")
    t = _relations(spark, sf_dir)
    for table, feed in BASE_TABLES.items():
        feeds.write_feed(getattr(t, table), f"{landed}/{feed}", feed)
    return stats.table_profile(etl.transform(spark, landed, clean))


DROPS = 3


def _in_drops(t: NewsTables, **kept: list[str]) -> list[dict[str, DataFrame]]:
    """The rows of the base tables as drops that follow one another, by a hash of the row.

    The rows are derived and dealt once, in the shared folder; of a table named in ``kept`` they
    keep these columns.
    """

    def dealt(table: str) -> DataFrame:
        df = getattr(t, table)
        number = F.pmod(F.xxhash64(*df.columns), F.lit(DROPS)).cast("int")
        return written(df.select(*kept.get(table, df.columns), number.alias("drop")), table)

    tables = {table: dealt(table) for table in BASE_TABLES}
    return [
        {table: df.filter(F.col("drop") == number).drop("drop") for table, df in tables.items()}
        for number in range(DROPS)
    ]


def _top_news_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking after all rows came in drops, each of which updated it."""
    t = _relations(spark, sf_dir)
    kept = ranking.Ranking(spark, new_folder(spark, "ranking"))
    mentions, records = ["globaleventid", "confidence"], ["documentidentifier", "sharingimage"]
    for number, drop in enumerate(_in_drops(t, mentions=mentions, gkg=records)):
        kept.update(number, **drop)
    return kept.top_news(DROPS, t.gkg)


def _etl_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All base tables landed drop by drop, each transformed by a run of its own."""
    landed, clean = new_folder(spark, "landed"), new_folder(spark, "clean")
    for number, drop in enumerate(_in_drops(_relations(spark, sf_dir))):
        for table, feed in BASE_TABLES.items():
            feeds.write_feed(drop[table], f"{landed}/{feed}/{number}", feed)
        increments.transform_new(spark, landed, clean)
    return stats.table_profile(increments.read_version(spark, clean))


def _segmented(query: Callable[[segments.SegmentedIndex, NewsTables], DataFrame]):
    """A query over a search index to which all rows came in drops."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = _relations(spark, sf_dir)
        index = segments.SegmentedIndex(spark, new_folder(spark, "segments"))
        for number, drop in enumerate(_in_drops(t)):
            index.refresh(number, **drop)
        return query(index, t)

    return run


def _detail_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "lookup")
    lookup.write_lookup(_relations(spark, sf_dir), folder)
    return lookup.detail_of(spark, folder, P.NEWS_ID)


def _distinct_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "sketches")
    sketches.write_sketches(_relations(spark, sf_dir), folder)
    return sketches.distinct_counts(spark, folder)


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events dropped twice; each drop is ingested by a run of its own, repeats go."""
    drops, out, state = [new_folder(spark, name) for name in ("drops", "ingested", "state")]
    events = _relations(spark, sf_dir).events
    for drop in ("first", "again"):
        feeds.write_feed(events, f"{drops}/{drop}", "export")
        ingest(spark, drops, out, state).awaitTermination()
    return spark.read.schema(table_schema("events")).parquet(out).drop(BATCH)


def _saved_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "index")
    as_of = datetime.fromisoformat(P.AS_OF)
    folder = search.refresh_if_stale(_relations(spark, sf_dir), path, as_of)
    return search.search_saved(spark, folder, P.NEWS_QUERY)


def _saved_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "search")
    t = _relations(spark, sf_dir)
    etl.build_search_tables(t, folder)
    return search.search_saved_news(t, folder, P.NEWS)


def _search_table(t: NewsTables) -> DataFrame:
    tokens = F.aggregate("search_terms", F.lit(0).cast("bigint"), lambda n, x: n + x["tf"])
    table = search.search_table(t.gkg)
    return table.withColumn("tokens", tokens).drop("search_terms")


def _without_featured(t: NewsTables) -> DataFrame:
    featured = settled(news.featured_news(t, P.FEATURED))
    return news.without_featured(news.top_news(t), featured)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = news_queries()
    if corpus is not None:
        registered |= corpus.queries() | {"pipeline": corpus_pipeline.run}
    return registered


def news_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    articles = news.all_articles
    return {
        "page_titles": _table("pages", _page_titles),
        "normalize_text": _table(
            "documents",
            lambda d: d.select("doc_id", text.normalize_text(F.col("text")).alias("normalized")),
        ),
        "explode_themes": _news(lambda t: etl.child_table(t.gkg, "gkg_themes")),
        "explode_persons": _news(lambda t: etl.child_table(t.gkg, "gkg_persons")),
        "explode_organizations": _news(lambda t: etl.child_table(t.gkg, "gkg_organizations")),
        "explode_names": _news(lambda t: etl.child_names(t.gkg)),
        "article_cards": _news(_article_cards),
        "top_news": _news(news.top_news),
        "top_news_maintained": _top_news_maintained,
        "top_news_total": _news(lambda t: stats.total(news.top_news(t))),
        "featured_news": _news(partial(news.featured_news, limit=P.FEATURED)),
        "top_minus_featured": _news(_without_featured),
        "theme_filter": _news(partial(news.filter_news, theme=P.THEME)),
        "theme_filter_literal": _news(
            partial(news.filter_news, theme=P.LITERAL_THEME, literal=True)
        ),
        "contains_search": _news(lambda t: news.contains_search(articles(t), P.CONTAINS)),
        "source_filter": _news(lambda t: news.source_filter(articles(t), P.SOURCE)),
        "theme_filter_saved": _saved_text(lambda t, f: saved.filter_news(t, f, P.THEME)),
        "contains_search_saved": _saved_text(
            lambda t, f: saved.contains_search(t.gkg.sparkSession, f, P.CONTAINS)
        ),
        "source_filter_saved": _saved_text(
            lambda t, f: saved.source_filter(t.gkg.sparkSession, f, P.SOURCE)
        ),
        "recent_news": _news(news.recent_news),
        "latest_news": _news(partial(news.latest_news, as_of=P.AS_OF)),
        "facet_themes": _news(stats.facet_themes),
        "theme_menu": _news(stats.theme_menu),
        "facet_sources": _news(stats.facet_sources),
        "stats": _news(partial(stats.stats, as_of=P.AS_OF[:10])),
        "table_profile": _news(stats.table_profile),
        "sample_events": _news(stats.sample_events),
        "sample_mentions": _news(lambda t: stats.table_samples(t)["mentions"]),
        "sample_gkg": _news(lambda t: stats.table_samples(t)["gkg"]),
        "id_overlap": _news(
            lambda t: joins.pair_count(t.events, t.mentions, "globaleventid", "globaleventid")
        ),
        "news_detail": _news(detail.news_detail),
        "news_detail_one": _news(partial(detail.news_detail, news_id=P.NEWS_ID)),
        "news_detail_lookup": _detail_lookup,
        "news_detail_by_record_id": _news(partial(detail.news_detail, link="id")),
        "orphan_mentions": _news(
            lambda t: joins.orphans(t.mentions, t.events, "globaleventid", "globaleventid")
        ),
        "duplicate_keys": _news(lambda t: joins.duplicate_keys(t.mentions, "globaleventid")),
        "search_table": _news(_search_table),
        "search_docs": _news(lambda t: search.search_docs(t.gkg)),
        "fts_index": _fts_index,
        "fts_rank": _fts_rank,
        "fts_search": _news(partial(search.search_news, query=P.NEWS)),
        "fts_search_saved": _saved_news,
        "tfidf_vocab": _tfidf_vocab,
        "tfidf_weights": _tfidf_weights,
        "tfidf_search": _tfidf_search,
        "search_corpus": _news(search.search_corpus),
        "search_corpus_by_record_id": _news(partial(search.search_corpus, link="id")),
        "search_tfidf": _news(partial(search.search_tfidf, query=P.NEWS_QUERY)),
        "search_tfidf_saved": _saved_search,
        "search_tfidf_segments": _segmented(lambda index, t: index.search(DROPS, P.NEWS_QUERY)),
        "fts_search_segments": _segmented(lambda index, t: index.search_news(DROPS, t, P.NEWS)),
        "knn_cosine": _table("embeddings", _knn),
        "knn_cells": _knn_cells(exact=False),
        "knn_cells_exact": _knn_cells(exact=True),
        "interval_manifest": _table("events", _interval_manifest),
        "round_quarter_hour": _table("events", _round_quarter_hour),
        "format_elapsed": _table("events", _format_elapsed),
        "feed_events": _feed_roundtrip("events", "export"),
        "feed_mentions": _feed_roundtrip("mentions", "mentions"),
        "feed_gkg": _feed_roundtrip("gkg", "gkg"),
        "etl_profile": _etl_profile,
        "etl_increments": _etl_increments,
        "distinct_sketched": _distinct_sketched,
        "stream_ingest": _stream_ingest,
    }


def entry(spark: SparkSession) -> DataFrame:
    return queries()["top_news"](spark, SMOKE_DIR)


def oracle_sql() -> dict[str, str]:
    statements = oracle.oracle_sql(PARAMETERS)
    if corpus is not None:
        statements |= corpus.oracle_sql()
    return statements
