"""A search index that grows by segments: a refresh adds what came, and rebuilds nothing.

A segment holds the documents of every URL that its drop brought an event or a record of, complete
and anew; of a URL only the documents of its last segment are alive, so a segment needs no marks on
older ones. Term statistics are kept as additions, of new documents, and withdrawals, of those
they replace, and give the vocabulary of all living documents. Weights follow from it at query
time: the postings of the query's terms name the documents to weigh, and only these are read. The
folders of segments are those of ``KeyedLog``, merged in tiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirespark.operators import fulltext, postings, tfidf
from wirespark.operators.joins import lookup_join
from wirespark.operators.keyed import small, top_n
from wirespark.plans.search import (
    DOCUMENT,
    best_articles,
    corpus_documents,
    results,
    search_docs,
    search_title,
)
from wirespark.plans.news import article_records, strongest_confidence
from wirespark.schemas import NewsTables, table_schema
from wirespark.session import settled, written
from wirespark.stores.keyed_log import BUCKETS, KeyedLog

#: The term that counts documents.
DOCUMENTS = ""
_STATISTICS = "term string, df bigint, cf bigint"
_EVENT = ["globaleventid", "sqldate", "actor1name", "actor2name", "nummentions", "sourceurl"]


def _fields(table: str, names: list[str] | None = None) -> list[T.StructField]:
    return [f for f in table_schema(table).fields if names is None or f.name in names]


def _linked(column: str, own: str) -> Column:
    """The URL, or a key of its own where there is none."""
    return F.coalesce(F.col(column), F.concat(F.lit("\u0000"), F.col(own)))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _last_segments(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.max("segment").alias("segment"))


def _extremes(rows: DataFrame) -> DataFrame:
    """The rows that decide which confidence of an event is the strongest."""
    bounds = rows.groupBy("globaleventid").agg(
        F.max("confidence").alias("high"), F.min("confidence").alias("low")
    )
    both = F.explode(F.array_distinct(F.array("high", "low"))).alias("confidence")
    return bounds.select("globaleventid", both)


class SegmentedIndex:
    """The index below ``path``; segments are numbered from 0."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        tag: str = "PAGE_TITLE",
        max_features: int = tfidf.MAX_FEATURES,
        buckets: int = BUCKETS,
    ):
        self.spark, self.path, self.tag, self.max_features = spark, path, tag, max_features
        link = T.StructField("link", T.StringType())
        segment = T.StructField("segment", T.LongType())
        events = T.StructType([link, *_fields("events", _EVENT)])
        records = T.StructType([link, *_fields("gkg")])
        documents = self._documents(
            spark.createDataFrame([], table_schema("events")),
            spark.createDataFrame([], table_schema("gkg")),
        )
        self.columns = documents.columns
        statistics = T.StructType.fromDDL(_STATISTICS)
        posted = T.StructType.fromDDL("term string, link string, segment bigint")
        terms = T.StructType.fromDDL("term string, gkgrecordid string, tf bigint, segment bigint")
        confidence = T.StructType.fromDDL("globaleventid string, confidence double")

        def log(name, key, schema, merge=None):
            return KeyedLog(spark, f"{path}/{name}", key, schema, merge, buckets)

        self.events = log("events", "link", events)
        self.records = log("records", "link", records)
        self.links = log(
            "links", "link", T.StructType([link, segment]), lambda df: _last_segments(df, "link")
        )
        self.documents = log("documents", "link", T.StructType([*documents.schema.fields, segment]))
        self.postings = log("postings", "term", posted)
        self.statistics = log("statistics", "term", statistics, _summed)
        self.confidences = log("confidences", "globaleventid", confidence, _extremes)
        self.texts = log("texts", "gkgrecordid", T.StructType([*_fields("gkg"), segment]))
        self.terms = log("terms", "term", terms)

    def _documents(self, events: DataFrame, gkg: DataFrame) -> DataFrame:
        rows = corpus_documents(events, gkg, tag=self.tag, keep=["sourceurl"])
        linked = rows.withColumn("link", _linked("sourceurl", "globaleventid")).drop("sourceurl")
        fits = tfidf.fits_tasks(self.max_features)
        analysed = tfidf.word_documents if fits else tfidf.term_documents
        return analysed(linked, DOCUMENT, F.col("combined_text"), keep=True).drop("combined_text")

    # Refresh ------------------------------------------------------------------------------

    def refresh(
        self, segment: int, events: DataFrame, mentions: DataFrame, gkg: DataFrame
    ) -> None:
        """Add the rows of a drop as segment number ``segment``; earlier ones must be there.

        Reads, of the rows stored before, those of the drop's own URLs. A refresh that is run
        again writes the same. Events are taken to be unique by id (``transform_new``).
        """
        given = events.select(_linked("sourceurl", "globaleventid").alias("link"), *_EVENT)
        told = gkg.select(F.col("documentidentifier").alias("link"), *table_schema("gkg").names)
        self.events.add(given, segment)
        self.records.add(told, segment)
        said = mentions.filter("confidence IS NOT NULL").select("globaleventid", "confidence")
        self.confidences.add(_extremes(said), segment)

        links = given.select("link").union(told.select("link")).filter("link IS NOT NULL")
        links = written(links.distinct(), "links")
        self.links.add(links.withColumn("segment", F.lit(segment).cast("long")), segment)
        fresh = self._documents(
            self._of(self.events, links, segment + 1), self._of(self.records, links, segment + 1)
        )
        fresh = fresh.withColumn("segment", F.lit(segment).cast("bigint"))
        self.documents.add(fresh, segment)
        # What was stored just now is read back, so texts are analysed once.
        fresh = self._of(self.documents, links, segment + 1).filter(F.col("segment") == segment)
        stale = self._alive(self._of(self.documents, links, segment), segment)
        listed = tfidf.posted_terms(fresh, "link")
        number = F.lit(segment).cast("bigint").alias("segment")
        self.postings.add(listed.select("term", "link", number), segment)
        changes = self._counted(fresh, 1).unionByName(self._counted(stale, -1))
        self.statistics.add(_summed(changes).filter("df != 0 OR cf != 0"), segment)
        self._write_model(segment)
        self._write_first_keys(segment, fresh, stale)
        self._add_texts(segment, gkg)

    def _of(self, log: KeyedLog, links: DataFrame, segment: int) -> DataFrame:
        return lookup_join(log.among(links, segment), links.select("link"), "link", "left_semi")

    def _alive(self, rows: DataFrame, segment: int) -> DataFrame:
        """Rows (link, segment, …) of the last of the first ``segment`` segments of their link."""
        rows = written(rows, "rows")
        last = _last_segments(self.links.among(rows.select("link").distinct(), segment), "link")
        return lookup_join(rows, last, ["link", "segment"], "left_semi")

    def _counted(self, documents: DataFrame, sign: int) -> DataFrame:
        counts = tfidf.term_counts(documents)
        number = documents.agg(F.count(F.lit(1)).alias("df"))
        each = number.select(F.lit(DOCUMENTS).alias("term"), "df", F.lit(0).cast("bigint").alias("cf"))
        signed = [(F.col(c) * sign).alias(c) for c in ("df", "cf")]
        return counts.unionByName(each).select("term", *signed)

    def _write_model(self, segment: int) -> None:
        """The vocabulary of all living documents."""
        counts = written(_summed(self.statistics.before(segment + 1)), "counts")
        n = counts.filter(F.col("term") == DOCUMENTS).agg(F.sum("df")).first()[0] or 0
        bounded = counts.filter(
            (F.col("term") != DOCUMENTS)
            & (F.col("df") >= tfidf.MIN_DF)
            & (F.col("df") <= F.lit(n) * F.lit(tfidf.MAX_DF))
        )
        top = tfidf.most_frequent(bounded, self.max_features)
        idf = F.log((F.lit(n) + 1) / (F.col("df") + 1)) + 1
        top.withColumn("idf", idf).write.mode("overwrite").parquet(self._model(segment))

    def _model(self, segment: int) -> str:
        return f"{self.path}/vocabulary/segment={segment}"

    def _first_keys(self, segment: int) -> str:
        return f"{self.path}/first_keys/segment={segment}"

    def _write_first_keys(self, segment: int, fresh: DataFrame, stale: DataFrame) -> None:
        """The smallest keys of living documents, for results with few hits."""
        kept = fresh.select(DOCUMENT, "link")
        if segment:
            before = self.spark.read.parquet(self._first_keys(segment - 1))
            # A key that went can leave a gap only if the list was cut; then it is made anew.
            gone = stale.select(DOCUMENT).join(kept, DOCUMENT, "left_anti")
            left = before.join(gone, DOCUMENT, "left_anti")
            if before.count() == postings.FIRST_KEYS and left.count() < postings.FIRST_KEYS:
                kept = self._all_keys(segment + 1)
            else:
                kept = kept.union(left).distinct()
        first = top_n(kept, postings.FIRST_KEYS, [F.asc(DOCUMENT)])
        first.coalesce(1).write.mode("overwrite").parquet(self._first_keys(segment))

    def _all_keys(self, segments: int) -> DataFrame:
        documents = self.documents.before(segments)
        return self._alive(documents.select("link", "segment", DOCUMENT), segments).select(DOCUMENT, "link")

    def _add_texts(self, segment: int, gkg: DataFrame) -> None:
        """Full-text postings of the drop's records; a record that comes again is replaced."""
        number = F.lit(segment).cast("bigint").alias("segment")
        self.texts.add(gkg.select(*table_schema("gkg").names, number), segment)
        self.terms.add(search_docs(gkg).select("term", "gkgrecordid", "tf", number), segment)

    # Search -------------------------------------------------------------------------------

    def search(self, segments: int, query: str, limit: int = 10) -> DataFrame:
        """``search.search_tfidf`` over all rows of the first ``segments`` segments.

        Materialises the documents of URLs that hold a word of the query, and the best of them.
        """
        if not query or not query.strip():
            raise ValueError("search text is required")
        query = query.strip()
        vocab = self.spark.read.parquet(self._model(segments - 1))
        asked = tfidf.query_terms(self.spark, query)
        known = [r["term"] for r in vocab.filter(F.col("term").isin(asked)).collect()]
        terms = self.spark.createDataFrame([(t,) for t in known], "term string")
        hits = self.postings.among(terms, segments).filter(F.col("term").isin(known))
        alive = self._alive(hits.select("link", "segment").distinct(), segments)
        alive = written(alive, "alive")
        links = alive.select("link").distinct()
        found = lookup_join(
            self.documents.among(links, segments), alive, ["link", "segment"], "left_semi"
        )
        found = written(found, "found")
        best = settled(
            tfidf.nearest(found, DOCUMENT, vocab, query, limit, max_features=self.max_features)
        )
        first_keys = self.spark.read.parquet(self._first_keys(segments - 1))
        if 2 * limit > postings.FIRST_KEYS:
            first_keys = self._all_keys(segments)
        filled = settled(
            postings.filled_up(best, first_keys.select(DOCUMENT), DOCUMENT, limit)
        )
        known = found.select(DOCUMENT, "link").unionByName(first_keys.select(DOCUMENT, "link"))
        links = known.join(small(filled, limit), DOCUMENT, "left_semi").select("link").distinct()
        return self._results(segments, filled, links, limit)

    def _results(
        self, segments: int, filled: DataFrame, links: DataFrame, limit: int
    ) -> DataFrame:
        ids = filled.select(F.col(f"{DOCUMENT}.globaleventid").alias("globaleventid")).distinct()
        said = self.confidences.among(ids, segments)
        said = said.join(small(ids, limit), "globaleventid", "left_semi")
        documents = self.documents.among(links, segments).join(
            small(filled.select(DOCUMENT), limit), DOCUMENT, "left_semi"
        )
        rows = self._alive(documents, segments).select(*self.columns)
        confidences = strongest_confidence(said)
        return results(rows.join(confidences, "globaleventid", "left"), filled, limit)

    def search_news(self, segments: int, t: NewsTables, query: str, limit: int = 35) -> DataFrame:
        """``search.search_news`` over the records of the first ``segments`` segments.

        Events and mentions are those of ``t``; for unique record ids, the last delivery counts.
        """
        terms = fulltext.query_terms(self.spark, query)
        asked = self.spark.createDataFrame([(term,) for term in terms], "term string")
        hits = self.terms.among(asked, segments).filter(F.col("term").isin(terms))
        hits = written(hits, "hits")
        ids = hits.select("gkgrecordid").distinct()
        rows = written(self.texts.among(ids, segments), "texts")
        rows = lookup_join(rows, ids, "gkgrecordid", "left_semi")
        last = _last_segments(rows, "gkgrecordid")
        live = lookup_join(hits, last, ["gkgrecordid", "segment"], "left_semi")
        ranks = fulltext.rank_index(live, "gkgrecordid", terms)
        texts = lookup_join(rows, last, ["gkgrecordid", "segment"], "left_semi")
        records = article_records(search_title(texts)).join(ranks, "gkgrecordid")
        return best_articles(t, records, limit)
