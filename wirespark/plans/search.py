"""Full-text and TF-IDF search over the news relations."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.functions.dates import int_date
from wirespark.functions.text import (
    first_item,
    joined_text,
    list_items,
    search_tokens,
    tag_text,
)
from wirespark.operators import postings, tfidf
from wirespark.operators.expand import expanded, first_children
from wirespark.operators.fulltext import (
    inverted_index,
    query_terms,
    rank_index,
    rank_rows,
    record_text,
)
from wirespark.operators.joins import lookup_join
from wirespark.operators.keyed import distinct_on, small, top_n, top_n_merged
from wirespark.operators.terms import english_stop_words, with_term_counts
from wirespark.plans.news import (
    DEFAULT_TITLE,
    article_records,
    asc,
    desc,
    event_per_url,
    record_order,
    strongest_confidence,
    to_article,
)
from wirespark.schemas import NewsTables
from wirespark.session import kept_while, settled, written
from wirespark.stores.keyed_log import one_of

CORPUS_ROWS = 10_000
INDEX_AGE = timedelta(hours=1)

DOCUMENT = "document"
# Event and record column of each way to link them.
LINKS = {
    "url": ("sourceurl", "documentidentifier"),
    "id": ("globaleventid", "gkgrecordid"),
}
RECORD_FIELDS = ["sourcecommonname", "sharingimage", "extras"]
RECORD_LISTS = ["themes", "persons", "organizations", "allnames"]


def search_title(df: DataFrame) -> DataFrame:
    return df.withColumn("page_title", F.coalesce(tag_text(F.col("extras")), F.lit(DEFAULT_TITLE)))


def search_table(gkg: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """gkg with a real date, the page title and its search terms ``(term, tf)``."""
    titled = search_title(gkg).withColumn("date", int_date(F.substring("date", 1, 8)))
    tokens = search_tokens(
        record_text(F.col("page_title")), stop_words or english_stop_words()
    )
    return with_term_counts(titled, tokens, "search_terms")


def search_docs(gkg: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """Inverted index ``(gkgrecordid, term, tf)`` of the article records."""
    return inverted_index(
        search_title(gkg), "gkgrecordid", record_text(F.col("page_title")), stop_words
    )


def search_news(t: NewsTables, query: str, limit: int = 35) -> DataFrame:
    """Articles with any query word, by rank, one per title.

    Reads the texts of all records; ``search_saved_news`` reads an index instead.
    """
    terms = query_terms(t.gkg.sparkSession, query)
    text = record_text(F.coalesce(tag_text(F.col("extras")), F.lit(DEFAULT_TITLE)))
    return best_articles(t, article_records(rank_rows(t.gkg, text, terms), "rank"), limit)


def search_saved_news(t: NewsTables, folder: str, query: str, limit: int = 35) -> DataFrame:
    """``search_news`` over the tables of ``build_search_tables``, for unique record ids.

    The filter on the terms reaches the scan of the index, which is laid out by term,
    and no text is tokenised.
    """
    spark = t.gkg.sparkSession
    index = spark.read.parquet(f"{folder}/search_terms")
    ranks = rank_index(index, "gkgrecordid", query_terms(spark, query))
    docs = article_records(spark.read.parquet(f"{folder}/search_docs"))
    return best_articles(t, docs.join(ranks, "gkgrecordid"), limit)


def best_articles(t: NewsTables, records: DataFrame, limit: int) -> DataFrame:
    joined = lookup_join(records, event_per_url(t), "sourceurl")
    per_title = distinct_on(
        joined,
        ["page_title"],
        [desc("nummentions"), desc("rank"), asc("globaleventid"), *record_order()],
    )
    order = [desc("rank"), asc("globaleventid"), asc("page_title")]
    return to_article(top_n(per_title, limit, order), "rank")


def search_corpus(t: NewsTables, limit: int = CORPUS_ROWS, *, link: str = "url") -> DataFrame:
    """The newest ``limit`` rows of events with their article records, list items and mentions.

    Rows are ordered by date, event, record, items and confidence, and the chain of
    left joins is cut to ``limit`` rows join by join; the product of all lists is
    never formed. ``link='id'`` takes the event id as record id, ``link='url'`` the
    source URL, and records of one URL stay apart by their id. Materialises the newest
    events and their records.
    """
    if link not in LINKS:
        raise ValueError(f"unknown link: {link}")
    linked, target = LINKS[link]
    events = t.events.select(
        "globaleventid",
        F.col("sqldate").alias("date"),
        "actor1name",
        "actor2name",
        "nummentions",
        F.col(linked).alias("link"),
    )
    order = [desc("date"), asc("globaleventid")]
    newest = settled(top_n_merged(events, limit, order))

    record = ["gkgrecordid", "sourcecommonname", "image", "extras"]
    records = t.gkg.select(
        F.col(target).alias("link"),
        "gkgrecordid",
        "sourcecommonname",
        F.col("sharingimage").alias("image"),
        "extras",
    )
    record_columns = [asc(c) for c in record]
    kept = first_children(records, newest, "link", record_columns, limit, distinct=True)
    described = settled(expanded(newest, kept, "link", order, record_columns, limit))
    order += record_columns

    rows = described
    for child, key, column in (
        (t.gkg_themes, "gkgrecordid", "theme"),
        (t.gkg_persons, "gkgrecordid", "person"),
        (t.gkg_organizations, "gkgrecordid", "organization"),
        (t.gkg_names, "gkgrecordid", "name"),
        (t.mentions, "globaleventid", "confidence"),
    ):
        values = child.select(key, column)
        kept = first_children(values, described, key, [asc(column)], limit, distinct=True)
        rows = expanded(rows, kept, key, order, [asc(column)], limit)
        order = [*order, asc(column)]
    return rows.select(
        "globaleventid",
        "date",
        "actor1name",
        "actor2name",
        "nummentions",
        *record,
        *[
            F.coalesce(c, F.lit("")).alias(c)
            for c in ("theme", "person", "organization", "name")
        ],
        "confidence",
    )


def corpus_documents(
    events: DataFrame,
    gkg: DataFrame,
    *,
    link: str = "url",
    tag: str = "PAGE_TITLE",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One search document per event and article record, events without a record included.

    The ``document`` key holds both ids; an event without a record has a NULL record id.
    Rows of one record id and link are deliveries of the same record, the first in column
    order counts. The text joins the title, the distinct items of each list in sorted order
    and both actors. Event columns in ``keep`` are kept.
    """
    if link not in LINKS:
        raise ValueError(f"unknown link: {link}")
    event_key, record_key = LINKS[link]
    known = gkg.filter(F.col(record_key).isNotNull()).select(
        F.col(record_key).alias("link"), "gkgrecordid", *RECORD_FIELDS, *RECORD_LISTS
    )
    first = [asc(c) for c in (*RECORD_FIELDS, *RECORD_LISTS)]
    lists = [
        F.concat_ws(" ", F.array_sort(F.array_distinct(list_items(F.col(c)))))
        for c in RECORD_LISTS
    ]
    records = distinct_on(known, ["link", "gkgrecordid"], first).select(
        "link",
        "gkgrecordid",
        "sourcecommonname",
        F.col("sharingimage").alias("image"),
        first_item(F.col("themes")).alias("theme"),
        tag_text(F.col("extras"), tag).alias("title"),
        joined_text(*lists).alias("items"),
    )
    described = events.select(
        "globaleventid",
        F.col("sqldate").alias("date"),
        "actor1name",
        "actor2name",
        "nummentions",
        *keep,
        F.col(event_key).alias("link"),
    )
    text = joined_text(*[F.col(c) for c in ("title", "items", "actor1name", "actor2name")])
    return (
        lookup_join(described, records, "link", "left")
        .withColumn("combined_text", text)
        .withColumn(DOCUMENT, F.struct("globaleventid", "gkgrecordid"))
        .drop("link", "items", "gkgrecordid")
    )


def _analysed(rows: DataFrame, max_features: int | None, *, keep: bool = False) -> DataFrame:
    text = F.col("combined_text")
    if tfidf.fits_tasks(max_features):
        return tfidf.word_documents(rows, DOCUMENT, text, keep=keep)
    return tfidf.term_documents(rows, DOCUMENT, text, keep=keep)


def search_tfidf(
    t: NewsTables,
    query: str,
    limit: int = 10,
    *,
    link: str = "url",
    tag: str = "PAGE_TITLE",
    max_features: int | None = tfidf.MAX_FEATURES,
) -> DataFrame:
    """The ``limit`` documents of all events and records closest to the query by TF-IDF cosine.

    ``max_features=None`` keeps every term within the document frequency bounds. Result
    fields and confidences are read for the found events alone. Materialises the term
    counts and the found keys.
    """
    if not query or not query.strip():
        raise ValueError("search text is required")
    rows = corpus_documents(t.events, t.gkg, link=link, tag=tag)
    documents = written(_analysed(rows, max_features), "documents")
    vocab = tfidf.vocabulary(documents, DOCUMENT, max_features=max_features)
    found = settled(
        tfidf.nearest(
            documents, DOCUMENT, vocab, query.strip(), limit, max_features=max_features
        )
    )
    ids = found.select(f"{DOCUMENT}.globaleventid").distinct()
    event_key, record_key = LINKS[link]
    events = t.events.join(small(ids, limit), "globaleventid", "left_semi")
    links = events.select(F.col(event_key).alias(record_key)).distinct()
    gkg = t.gkg.join(small(links, limit), record_key, "left_semi")
    mentions = t.mentions.join(small(ids, limit), "globaleventid", "left_semi")
    return results(
        _with_confidence(corpus_documents(events, gkg, link=link, tag=tag), mentions),
        found,
        limit,
    )


def _with_confidence(rows: DataFrame, mentions: DataFrame) -> DataFrame:
    return rows.join(strongest_confidence(mentions), "globaleventid", "left")


def results(rows: DataFrame, found: DataFrame, limit: int) -> DataFrame:
    return rows.join(small(found, limit), DOCUMENT).select(
        F.col("globaleventid").alias("id"),
        F.when(F.col("title") != "", F.col("title"))
        .otherwise(F.lit("No title available"))
        .alias("title"),
        "date",
        F.coalesce("theme", F.lit("")).alias("theme"),
        F.col("actor1name").alias("actor1_name"),
        F.col("actor2name").alias("actor2_name"),
        F.col("nummentions").alias("num_mentions"),
        "confidence",
        F.col("sourcecommonname").alias("source"),
        "image",
        F.col("similarity").alias("similarity_score"),
    )


def refresh_if_stale(
    t: NewsTables,
    path: str,
    as_of: datetime,
    max_age: timedelta = INDEX_AGE,
    *,
    link: str = "url",
    max_features: int | None = tfidf.MAX_FEATURES,
) -> str:
    """Folder of a saved search index no older than ``max_age``; rebuilds it if needed.

    The index holds result rows, laid out by document, the vocabulary, and weighted terms of all
    events and records (``operators.postings``, or plain weights laid out by term where the
    vocabulary has no limit).
    Each build goes to a folder of its own and is listed in ``path/builds`` only
    once complete, so a reader never sees a partial index and a failed build is
    simply not listed.
    """
    spark = t.events.sparkSession
    built = _last_build(spark, path)
    if built is not None and as_of - built <= max_age:
        return _build_folder(path, built)
    folder = _build_folder(path, as_of)
    # Confidences meet the events before their records do: the texts then take no exchange.
    events = _with_confidence(t.events, t.mentions)
    rows = corpus_documents(events, t.gkg, link=link, keep=["confidence"])
    counted = "words" if tfidf.fits_tasks(max_features) else "terms"
    # Result rows and analysed texts in one go: the texts themselves are not written.
    analysed = _analysed(rows, max_features, keep=True).drop("combined_text")
    with ExitStack() as weighing:
        with kept_while(analysed, "documents") as analysed:
            by_key = analysed.drop(counted).repartitionByRange(DOCUMENT)
            by_key = by_key.sortWithinPartitions(DOCUMENT)
            by_key.write.mode("overwrite").parquet(f"{folder}/rows")
            documents = analysed.select(DOCUMENT, counted)
            vocab = tfidf.vocabulary(documents, DOCUMENT, max_features=max_features)
            vocab.write.mode("overwrite").parquet(f"{folder}/vocabulary")
            vocab = spark.read.parquet(f"{folder}/vocabulary")
            if tfidf.fits_tasks(max_features):
                weighted = tfidf.unscaled_rows(documents, DOCUMENT, vocab)
                weighted = weighing.enter_context(kept_while(weighted, "weighted"))
            else:
                weighted = tfidf.weights(documents, DOCUMENT, vocab, max_features)
                by_term = weighted.repartitionByRange("term", DOCUMENT).sortWithinPartitions("term")
                by_term.write.mode("overwrite").parquet(f"{folder}/weights")
        if tfidf.fits_tasks(max_features):
            postings.write_weighed(weighted, DOCUMENT, f"{folder}/index")
    build = spark.createDataFrame([(as_of,)], "built_at timestamp_ntz")
    build.write.mode("append").parquet(f"{path}/builds")
    return folder


def search_saved(spark: SparkSession, folder: str, query: str, limit: int = 10) -> DataFrame:
    """``search_tfidf`` on a saved index, without reading or tokenising any text.

    Reads the postings of blocks that can reach the result, and the result rows of the
    documents found. Materialises these documents' keys.
    """
    if not query or not query.strip():
        raise ValueError("search text is required")
    rows = spark.read.parquet(f"{folder}/rows")
    vocab = spark.read.parquet(f"{folder}/vocabulary")
    terms = tfidf.query_terms(spark, query.strip())
    asked = tfidf.query_weights(vocab.filter(F.col("term").isin(terms)), query.strip())
    asked = [(r["term"], r["query_weight"]) for r in asked.collect()]
    found = best_saved(spark, folder, asked, limit)
    found = settled(found)
    ids = [r["id"] for r in found.select(F.col(f"{DOCUMENT}.globaleventid").alias("id")).collect()]
    return results(rows.filter(one_of(F.col("globaleventid"), ids)), found, limit)


def best_saved(
    spark: SparkSession, folder: str, asked: list[tuple[str, float]], limit: int
) -> DataFrame:
    """``(document, similarity)`` of the best documents of a saved index."""
    index = f"{folder}/index"
    try:
        first_keys = spark.read.parquet(f"{index}/first_keys")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        weighted = spark.read.parquet(f"{folder}/weights")
        hits = weighted.filter(F.col("term").isin([term for term, _ in asked]))
        model = spark.createDataFrame(asked, "term string, query_weight double")
        rows = spark.read.parquet(f"{folder}/rows")
        return tfidf.nearest_by_weights(hits, rows, DOCUMENT, model, limit, len(asked))
    found = postings.best_documents(spark, index, DOCUMENT, asked, limit)
    if 2 * limit > postings.FIRST_KEYS:
        first_keys = spark.read.parquet(f"{folder}/rows").select(DOCUMENT)
    return postings.filled_up(found, first_keys, DOCUMENT, limit)


def _build_folder(path: str, built: datetime) -> str:
    return f"{path}/{built:%Y%m%dT%H%M%S}"


def _last_build(spark: SparkSession, path: str) -> datetime | None:
    try:
        builds = spark.read.schema("built_at timestamp_ntz").parquet(f"{path}/builds")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return builds.agg(F.max("built_at").alias("last")).first()["last"]
