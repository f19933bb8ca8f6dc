"""TF-IDF vocabulary, weights and cosine search.

A document is a row. Weights are tf x (ln((1 + n) / (1 + df)) + 1), rows scaled to
length one. The vocabulary is limited to ``max_features`` rows. Up to
``BROADCAST_ROWS`` of them go to every task, which then weighs and scores its documents
where they are, without a shuffle; without a limit (``None``) terms are joined and
documents put together again.

Documents are read more than once: pass in a frame that is written somewhere
(``session.written``), or their terms are counted anew each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirespark.operators import frequent
from wirespark.operators.keyed import BROADCAST_ROWS, small, top_n
from wirespark.operators.terms import english_stop_words, exploded_terms, with_term_counts

MAX_FEATURES = 1000
MIN_DF = 2
MAX_DF = 0.8
DIGITS = 6

#: Terms of a task's summary for each term of the vocabulary.
SUMMARY_TERMS = 32
#: Beyond this many terms a summary is no longer small, and all terms are counted.
LARGEST_SUMMARY = 1 << 19
#: Terms that are counted exactly for each term of the vocabulary; the df bounds may refuse some.
CANDIDATES = 4


def kept_words(text: Column, stop_words: list[str]) -> Column:
    """Words of ``normalize_text`` with two or more characters, without stop words."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+")
    return F.filter(words, lambda w: (F.length(w) >= 2) & ~w.isin(stop_words))


def with_bigrams(words: Column) -> Column:
    """The words and then each pair of neighbours."""
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.concat(words, pairs)


def term_documents(
    df: DataFrame,
    key: str,
    text: Column,
    stop_words: list[str] | None = None,
    *,
    keep: bool = False,
) -> DataFrame:
    """``(key, terms)``: the 1- and 2-gram counts of every document; all columns for ``keep``."""
    words = kept_words(text, stop_words or english_stop_words()).alias("_words")
    rows = df.select("*", words) if keep else df.select(key, words)
    return with_term_counts(rows, with_bigrams(F.col("_words"))).drop("_words")


def word_documents(
    df: DataFrame,
    key: str,
    text: Column,
    stop_words: list[str] | None = None,
    *,
    keep: bool = False,
) -> DataFrame:
    """``(key, words)``: the words of every document, for everything here that takes documents;
    all columns for ``keep``.

    Smaller than counted terms; pairs of words are formed and counted where they are needed. With
    a vocabulary that does not fit the tasks (``max_features=None``) counted terms are required.
    """
    words = kept_words(text, stop_words or english_stop_words()).alias("words")
    return df.select("*", words) if keep else df.select(key, words)


#: Words whose terms are looked at together.
SLICE_WORDS = 1 << 16


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """Terms of a batch of documents in runs: first row, row after the last, terms, the row that
    each term is of (from 0), and how often it is there."""
    names = batch.schema.names
    lists = batch.column(names.index("terms" if "terms" in names else "words"))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    begin = 0
    while begin < len(lists):
        end = int(np.searchsorted(offsets, offsets[begin] + SLICE_WORDS, side="right")) - 1
        end = min(max(end, begin + 1), len(lists))
        flat = lists.slice(begin, end - begin).flatten()
        row = np.repeat(np.arange(end - begin), np.diff(offsets[begin : end + 1]))
        if "terms" in names:
            term, tf = flat.flatten()
            yield begin, end, term, row, tf.to_numpy(zero_copy_only=False)
        else:
            same = pa.array(row[1:] == row[:-1])
            left, right = flat[:-1].filter(same), flat[1:].filter(same)
            pairs = pc.binary_join_element_wise(left, right, " ")
            row = np.concatenate([row, row[:-1][row[1:] == row[:-1]]])
            yield begin, end, pa.concat_arrays([flat, pairs]), row, np.ones(len(row), np.int64)
        begin = end


def _known(terms: pa.Array, row: np.ndarray, tf: np.ndarray, names: pa.Array):
    """Rows, places among ``names`` and counts of the known terms, each once a row, by row."""
    places = frequent.look_up(terms, names)
    there = places >= 0
    code = row[there] * max(len(names), 1) + places[there]
    code, at = np.unique(code, return_inverse=True)
    counts = np.bincount(at, weights=tf[there], minlength=len(code)).astype(np.int64)
    return code // max(len(names), 1), code % max(len(names), 1), counts


def _listed(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    for _, _, terms, _, tf in _slices(batch):
        yield pa.table({"item": terms, "n": pa.array(tf, pa.int64())})


def _exact(documents: DataFrame, names: list[str]) -> DataFrame:
    """``(term, df, cf)`` of some terms; a task adds them up before the shuffle."""
    known = pa.array(names, pa.string())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(names)), np.int64)
        for batch in batches:
            for _, _, terms, row, tf in _slices(batch):
                _, places, counts = _known(terms, row, tf, known)
                sums[0] += np.bincount(places, minlength=len(names))
                sums[1] += np.bincount(places, weights=counts, minlength=len(names)).astype(np.int64)
        met = np.flatnonzero(sums[0])
        columns = [known.take(pa.array(met)), pa.array(sums[0][met]), pa.array(sums[1][met])]
        yield pa.RecordBatch.from_arrays(columns, ["term", "df", "cf"])

    parts = documents.mapInArrow(counted, "term string, df bigint, cf bigint")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def term_counts(documents: DataFrame) -> DataFrame:
    """``(term, df, cf)`` of all terms, in any number of parts: a task adds up runs of documents."""
    lists = documents.select("words" if "words" in documents.columns else "terms")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, terms, row, tf in _slices(batch):
                names = terms.unique()
                _, places, counts = _known(terms, row, tf, names)
                df = np.bincount(places, minlength=len(names))
                cf = np.bincount(places, weights=counts, minlength=len(names)).astype(np.int64)
                columns = [names, pa.array(df, pa.int64()), pa.array(cf)]
                yield pa.RecordBatch.from_arrays(columns, ["term", "df", "cf"])

    return lists.mapInArrow(counted, "term string, df bigint, cf bigint")


def posted_terms(documents: DataFrame, key: str) -> DataFrame:
    """``(term, key)``: the terms of documents, for a key once in a run of documents."""
    lists = documents.select(key, "words" if "words" in documents.columns else "terms")

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key)
            for begin, end, terms, row, tf in _slices(batch):
                owners = keys.slice(begin, end - begin).dictionary_encode()
                owner = owners.indices.to_numpy().astype(np.int64)[row]
                names = terms.unique()
                owner, places, _ = _known(terms, owner, tf, names)
                columns = [names.take(pa.array(places)), owners.dictionary.take(pa.array(owner))]
                yield pa.RecordBatch.from_arrays(columns, ["term", key])

    schema = T.StructType([T.StructField("term", T.StringType()), documents.schema[key]])
    return lists.mapInArrow(posted, schema)


def vocabulary(
    documents: DataFrame,
    key: str,
    *,
    max_features: int | None = MAX_FEATURES,
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
    capacity: int | None = None,
) -> DataFrame:
    """``(term, df, cf, idf)`` of the most frequent terms within the df bounds.

    Most terms are rare and never reach the result, so they are not shuffled: tasks send
    summaries of ``capacity`` terms (``frequent``), and only the terms that lead there are
    counted exactly. The counts are final once the last of them is more frequent than any
    term left out can be; otherwise the summaries are made larger, and at last every term is
    counted. The result is the same in all cases.
    """
    n = documents.count()
    idf = F.log((F.lit(n) + 1) / (F.col("df") + 1)) + 1

    def bounded(counted: DataFrame) -> DataFrame:
        return counted.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(n) * F.lit(max_df)))

    if fits_tasks(max_features):
        rows = _leading(documents, bounded, max_features, capacity or SUMMARY_TERMS * max_features)
        if rows is not None:
            schema = "term string, df bigint, cf bigint"
            return documents.sparkSession.createDataFrame(rows, schema).withColumn("idf", idf)
    top = bounded(_counted(documents, key))
    if max_features is not None:
        top = most_frequent(top, max_features)
    return top.withColumn("idf", idf)


def most_frequent(bounded: DataFrame, max_features: int) -> DataFrame:
    return top_n(bounded, max_features, [F.desc("cf"), F.asc("term")])


def fits_tasks(max_features: int | None) -> bool:
    """Whether the vocabulary is small enough to go to every task."""
    return max_features is not None and max_features <= BROADCAST_ROWS


def _counted(documents: DataFrame, key: str) -> DataFrame:
    if "words" in documents.columns:
        grams = with_bigrams(F.col("words"))
        documents = with_term_counts(documents, grams)
    terms = exploded_terms(documents, key)
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def _leading(
    documents: DataFrame,
    bounded: Callable[[DataFrame], DataFrame],
    max_features: int,
    capacity: int,
) -> list[Row] | None:
    """The rows of the vocabulary, or None where summaries do not tell its terms apart."""
    lists = documents.select("words" if "words" in documents.columns else "terms")
    candidates = CANDIDATES * max_features
    while capacity <= LARGEST_SUMMARY and candidates < BROADCAST_ROWS:
        summary = frequent.merged(frequent.summaries(lists, _listed, capacity))
        first = summary.withColumn("is_error", F.col("item").isNull())
        first = top_n(first, candidates + 2, [F.desc("is_error"), F.desc("n"), F.asc("item")])
        found = sorted(first.collect(), key=lambda r: (not r["is_error"], -r["n"], r["item"]))
        error = found[0]["n"] if found else 0
        chosen, left_out = found[1 : candidates + 1], found[candidates + 1 :]
        exact = bounded(_exact(lists, [r["item"] for r in chosen]))
        rows = most_frequent(exact, max_features).collect()
        full = len(rows) == max_features
        if error == 0:
            # The summaries hold every term and its count.
            if full or not left_out:
                return rows
        elif full and rows[-1]["cf"] > error + (left_out[0]["n"] if left_out else 0):
            return rows
        capacity *= 8
        candidates *= 2
    return None


def weights(
    documents: DataFrame, key: str, vocab: DataFrame, max_features: int | None = MAX_FEATURES
) -> DataFrame:
    """``(key, term, weight)``, every document scaled to length one."""
    if fits_tasks(max_features):
        rows = weighted_rows(documents, key, vocab)
        return rows.select(key, F.inline_outer("entries")).filter(F.col("term").isNotNull())
    per_document = Window.partitionBy(key)
    raw = exploded_terms(documents, key).join(vocab.select("term", "idf"), "term")
    raw = raw.withColumn("raw", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(per_document))
    return raw.select(key, "term", (F.col("raw") / length).alias("weight"))


def weighted_rows(documents: DataFrame, key: str, vocab: DataFrame) -> DataFrame:
    """``(key, entries)``: the (term, weight) of every document, without a shuffle.

    For vocabularies that may go to every task; see ``weights``.
    """
    return _weighed(documents, key, vocab, scaled=True)


def unscaled_rows(documents: DataFrame, key: str, vocab: DataFrame) -> DataFrame:
    """``(key, entries, length)``: ``weighted_rows`` whose weights are yet to be divided by length.

    Weights that are not scaled are few different numbers, so they are stored in a fraction of
    the bytes.
    """
    return _weighed(documents, key, vocab, scaled=False)


def _weighed(documents: DataFrame, key: str, vocab: DataFrame, *, scaled: bool) -> DataFrame:
    idf = {r["term"]: r["idf"] for r in vocab.select("term", "idf").collect()}
    names, values = pa.array(idf.keys(), pa.string()), np.array(list(idf.values()))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, terms, row, tf in _slices(batch):
                row, places, tf = _known(terms, row, tf, names)
                raw = tf * values[places]
                length = np.sqrt(np.bincount(row, weights=raw * raw, minlength=end - begin))
                weight = pa.array(raw / length[row] if scaled else raw)
                entries = pa.StructArray.from_arrays(
                    [names.take(pa.array(places)), weight], ["term", "weight"]
                )
                starts = np.searchsorted(row, np.arange(end - begin + 1))
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), entries)
                keys = batch.column(batch.schema.names.index(key)).slice(begin, end - begin)
                columns = {key: keys, "entries": lists}
                if not scaled:
                    columns["length"] = pa.array(length)
                yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    kept = _kept_terms(documents, key, idf)
    entries = "entries array<struct<term:string,weight:double>>"
    schema = _schema(kept, key, entries if scaled else f"{entries}, length double")
    return kept.mapInArrow(weighed, schema)


def _kept_terms(documents: DataFrame, key: str, known) -> DataFrame:
    """The words of documents or, of counted terms, those that are known."""
    if "words" in documents.columns:
        return documents.select(key, "words")
    terms = F.filter("terms", lambda t: t["term"].isin(list(known))) if known else F.array()
    kind = "array<struct<term:string,tf:bigint>>"
    return documents.select(key, F.coalesce(terms, F.array()).cast(kind).alias("terms"))


def _schema(df: DataFrame, key: str, more: str) -> T.StructType:
    return T.StructType([df.schema[key], *T.StructType.fromDDL(more).fields])


def query_terms(
    spark: SparkSession, query: str, stop_words: list[str] | None = None
) -> list[str]:
    """Distinct 1- and 2-grams of a query, by the same analysis as documents."""
    words = kept_words(F.lit(query), stop_words or english_stop_words())
    grams = spark.range(1).select(words.alias("w")).select(with_bigrams(F.col("w")).alias("t"))
    return grams.select(F.array_distinct("t").alias("t")).first()["t"]


def query_weights(
    vocab: DataFrame, query: str, stop_words: list[str] | None = None
) -> DataFrame:
    """``(term, query_weight)`` for the query's terms in the vocabulary, scaled to length one."""
    asked = vocab.sparkSession.range(1).select("id", F.lit(query).alias("q"))
    asked = exploded_terms(term_documents(asked, "id", F.col("q"), stop_words), "id").drop("id")
    raw = F.col("tf") * F.col("idf")
    # As many rows as the query has terms, for the broadcast and for the window.
    length = F.sqrt(F.sum(raw * raw).over(Window.partitionBy()))
    found = vocab.select("term", "idf").join(F.broadcast(asked), "term")
    return found.select("term", (raw / length).alias("query_weight"))


def nearest(
    documents: DataFrame,
    key: str,
    vocab: DataFrame,
    query: str,
    k: int = 10,
    stop_words: list[str] | None = None,
    max_features: int | None = MAX_FEATURES,
) -> DataFrame:
    """The ``k`` documents closest to ``query`` by cosine: ``(key, similarity)``.

    Documents without a query term score 0 and fill up the result.
    """
    if not query:
        raise ValueError("search text is required")
    asked = query_weights(vocab, query, stop_words)
    if fits_tasks(max_features):
        scored = _scored_rows(documents, key, vocab, asked)
        return top_n(scored, k, [F.desc("similarity"), F.asc(key)])
    model = vocab.select("term", "idf").join(F.broadcast(asked), "term", "left")
    raw = F.col("tf") * F.col("idf")
    sums = (
        exploded_terms(documents, key)
        .join(model, "term")
        .groupBy(key)
        .agg(
            F.sum(raw * F.col("query_weight")).alias("dot"),
            F.sqrt(F.sum(raw * raw)).alias("length"),
        )
    )
    similarity = F.round(F.col("dot") / F.col("length"), DIGITS)
    hits = sums.filter(F.col("dot").isNotNull()).select(key, similarity.alias("similarity"))
    return filled(hits, documents, key, k)


def _scored_rows(
    documents: DataFrame, key: str, vocab: DataFrame, asked: DataFrame
) -> DataFrame:
    """``(key, similarity)`` of every document to the query, without a shuffle."""
    model = {r["term"]: r["idf"] for r in vocab.select("term", "idf").collect()}
    query = {r["term"]: r["query_weight"] for r in asked.collect()}
    names, idf = pa.array(model.keys(), pa.string()), np.array(list(model.values()))
    weight = np.array([query.get(term, 0.0) for term in model])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, terms, row, tf in _slices(batch):
                row, places, tf = _known(terms, row, tf, names)
                raw = tf * idf[places]
                dot = np.bincount(row, weights=raw * weight[places], minlength=end - begin)
                squares = np.bincount(row, weights=raw * raw, minlength=end - begin)
                cosine = np.divide(dot, np.sqrt(squares), out=np.zeros_like(dot), where=squares > 0)
                keys = batch.column(batch.schema.names.index(key)).slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([keys, pa.array(cosine)], [key, "cosine"])

    kept = _kept_terms(documents, key, model)
    rows = kept.mapInArrow(scored, _schema(kept, key, "cosine double"))
    return rows.select(key, F.round("cosine", DIGITS).alias("similarity"))


def nearest_by_weights(
    weighted: DataFrame,
    documents: DataFrame,
    key: str,
    asked: DataFrame,
    k: int = 10,
    max_features: int | None = MAX_FEATURES,
) -> DataFrame:
    """Like ``nearest`` over saved weights.

    ``asked`` holds ``(term, query_weight)`` for terms of the vocabulary, at most
    ``max_features`` of them.
    """
    product = F.col("weight") * F.col("query_weight")
    scores = (
        weighted.join(small(asked, max_features), "term")
        .groupBy(key)
        .agg(F.round(F.sum(product), DIGITS).alias("similarity"))
    )
    return filled(scores, documents, key, k)


def filled(scores: DataFrame, documents: DataFrame, key: str, k: int) -> DataFrame:
    """The best ``k`` of ``scores``; the first other documents follow with 0 if fewer match."""
    order = [F.desc("similarity"), F.asc(key)]
    best = top_n(scores, k, order)
    rest = documents.select(key).join(small(best.select(key), k), key, "left_anti")
    fill = top_n(rest.withColumn("similarity", F.lit(0.0)), k, [F.asc(key)])
    return top_n(best.unionByName(fill), k, order)
