"""Toxicity by a chain of linear classifiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirespark.llm.common import stored

#: Labelled documents that are learned from, words that are features, least documents of a word.
MAX_ROWS, MAX_WORDS, MIN_DOCS = 20_000, 4096, 5
FOLDS = 3
#: From this probability on a document is in a category.
THRESHOLD = 0.3

_LETTERS = "[^\\p{L}]+"


@dataclass
class Chain:
    """Categories in order, the words that are features, and a model per category (or the
    share of positive labels where the labels are all alike)."""

    categories: list[str]
    vocabulary: list[str]
    models: list


def _words(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), _LETTERS)
    return F.filter(words, lambda word: word != "")


def _features(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Adds ``_base``: which of the words occur, the share of letters and of different words."""
    size = F.greatest(F.size("_words"), F.lit(1))
    counted = docs.withColumns(
        {
            "_letters": F.length(F.array_join("_words", ""))
            / F.greatest(F.length(F.coalesce("text", F.lit(""))), F.lit(1)),
            "_different": F.size(F.array_distinct("_words")) / size,
        }
    )
    vectors = CountVectorizerModel.from_vocabulary(
        vocabulary or [""], inputCol="_words", outputCol="_met", minTF=1.0
    ).setBinary(True)
    parts = VectorAssembler(inputCols=["_met", "_letters", "_different"], outputCol="_base")
    return parts.transform(vectors.transform(counted)).drop("_words", "_met", "_letters", "_different")


def _linked(docs: DataFrame, earlier: list[str]) -> DataFrame:
    """Adds ``_features``: the base features and the earlier categories' probabilities."""
    if not earlier:
        return docs.withColumn("_features", F.col("_base"))
    return VectorAssembler(inputCols=["_base", *earlier], outputCol="_features").transform(docs)


def _predicted(docs: DataFrame, model, earlier: list[str], name: str) -> DataFrame:
    """Adds the probability of a category as ``name``."""
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(model))
    found = model.transform(_linked(docs, earlier))
    chance = vector_to_array("_probability")[1]
    return found.withColumn(name, chance).drop("_features", "_probability")


def _fitted(rows: DataFrame, category: str, earlier: list[str]):
    """A logistic regression of the category on the features and earlier probabilities."""
    shares = rows.agg(F.min(category), F.max(category)).first()
    if shares[0] is None or shares[0] == shares[1]:
        return float(shares[0] or 0)
    regression = LogisticRegression(
        featuresCol="_features",
        labelCol=category,
        probabilityCol="_probability",
        rawPredictionCol="",
        predictionCol="",
        regParam=1e-3,
        maxIter=50,
    )
    return regression.fit(_linked(rows, earlier))


def _vocabulary(rows: DataFrame, categories: list[str], max_words: int) -> list[str]:
    """The words that tell the labels apart best: by the z-score of their documents, any label."""
    total = rows.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    if not total["n"]:
        return []
    met = rows.select(F.explode(F.array_distinct("_words")).alias("word"), *categories)
    counts = met.groupBy("word").agg(
        F.count("*").alias("docs"), *[F.sum(c).alias(c) for c in categories]
    )
    scores = []
    for category in categories:
        share = (total[category] or 0.0) / total["n"]
        spread = F.sqrt(F.col("docs") * share * (1 - share)) + 1e-9
        scores.append(F.abs(F.col(category) - F.col("docs") * share) / spread)
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    chosen = counts.filter(F.col("docs") >= MIN_DOCS).orderBy(best.desc(), "word")
    return [row["word"] for row in chosen.select("word").limit(max_words).collect()]


def train_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    max_rows: int = MAX_ROWS,
    max_words: int = MAX_WORDS,
) -> Chain:
    """Learn a chain of categories from labelled documents.

    ``docs`` needs doc_id and text, ``labels`` doc_id and what ``categories`` (name to a 0/1
    column over labels, in chain order) are computed from. At most ``max_rows`` labelled
    documents are learned from, those with the smallest hash of doc_id; rows with a null label
    are left out, of repeated labels the larger counts. Each category's model sees the
    probabilities of the categories before it. In training those come from models fitted without
    the document's own fold, so a later model meets probabilities like those of new documents.
    """
    names = list(categories)
    known = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *[c.cast("double").alias(name) for name, c in categories.items()],
    ).dropna()
    known = known.groupBy("doc_id").agg(*[F.max(name).alias(name) for name in names])
    # Bounded by max_rows, so it can go to every task.
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = texts.join(F.broadcast(sample), "doc_id").withColumn("_words", _words(F.col("text")))
    rows = stored(rows, "labelled")
    vocabulary = _vocabulary(rows, names, max_words)
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")
    ready = _features(rows, vocabulary).drop("text").withColumn("_fold", fold)
    ready = stored(ready, "features")
    models, earlier = [], []
    for name in names:
        models.append(_fitted(ready, name, earlier))
        if name != names[-1]:
            apart = None
            for n in range(FOLDS):
                model = _fitted(ready.filter(F.col("_fold") != n), name, earlier)
                part = _predicted(ready.filter(F.col("_fold") == n), model, earlier, f"p_{name}")
                apart = part if apart is None else apart.union(part.select(apart.columns))
            ready = stored(apart, "features")
            earlier = [*earlier, f"p_{name}"]
    return Chain(names, vocabulary, models)


def classified(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """Probability of each category of the chain for every document, and whether it is in it.

    ``docs`` needs doc_id and text; other columns are ignored, repeated rows stay. A null or
    empty text has no words. An empty table gives an empty result. Returns doc_id, and
    p_<category> (probability) and <category> (at least ``threshold``) for each category.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = _features(rows.withColumn("_words", _words(F.col("text"))), chain.vocabulary)
    earlier: list[str] = []
    for name, model in zip(chain.categories, chain.models):
        rows = _predicted(rows, model, earlier, f"p_{name}")
        earlier = [*earlier, f"p_{name}"]
    flags = [(F.col(p) >= threshold).alias(n) for n, p in zip(chain.categories, earlier)]
    return rows.select("doc_id", *earlier, *flags)
