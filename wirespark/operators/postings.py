"""A saved index of weighted terms whose blocks tell the largest weight they hold.

Documents are laid out by their heaviest term and its weight and cut into blocks, so documents
that score alike for a term share blocks. For each term and block the index keeps the largest
weight. A search adds these up to what a document of a block can score at most, scores a few
blocks that promise most, and then reads only those that can still reach the k-th best score
(block-max pruning; Ding and Suel, 2011). Both filters, on terms and on blocks, reach the scan of
the postings, which are sorted by term and block. A posting is a place in its block and a weight
before scaling; the keys and lengths of a block's documents are kept once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirespark.operators.keyed import small, top_n
from wirespark.session import WRITTEN_BLOCK, kept_while

DIGITS = 6
#: Bits of a row's number within its block: blocks of 256 documents.
BLOCK_BITS = 8
#: Blocks that are scored for a first threshold.
FIRST_BLOCKS = 32
#: Blocks that a filter names; if more can reach the threshold, they are joined.
NAMED_BLOCKS = 10_000
#: Ranges of blocks in the filter that reaches the scan.
RANGES = 8
#: First keys kept for results that have fewer hits than asked for.
FIRST_KEYS = 2000
#: Similarities are rounded; a block this close to the threshold can still reach it.
SLACK = 10.0**-DIGITS


def write_postings(rows: DataFrame, key: str, path: str) -> None:
    """Write the index of ``(key, entries)``, entries being an array of (term, weight).

    A column ``length``, if there is one, is what the weights of a row are yet to be divided by.
    Four tables below ``path``: postings, documents (keys and lengths by block), blocks (largest
    weight by term and block) and first_keys. Rows are dealt by ranges that end in the key, so a
    term that leads very many documents is spread over tasks; blocks never leave a task.
    """
    # Weighing is not cheap, and ranges read their rows twice.
    with kept_while(rows, "weighted") as weighed:
        write_weighed(weighed, key, path)


def write_weighed(rows: DataFrame, key: str, path: str) -> None:
    """``write_postings`` of rows that are written somewhere already."""
    length = F.col("length") if "length" in rows.columns else F.lit(1.0)
    top_n(rows.select(key), FIRST_KEYS, [F.asc(key)]).write.parquet(f"{path}/first_keys")

    def entry(e: Column) -> Column:
        return F.struct((e["weight"] / length).alias("weight"), e["term"].alias("term"))

    filled = rows.filter(F.size("entries") > 0).select(
        F.col(key).alias("key"),
        length.alias("length"),
        F.col("entries.term").alias("terms"),
        F.col("entries.weight").alias("weights"),
        F.array_max(F.transform("entries", entry)).alias("lead"),
    )
    order = [F.asc("lead.term"), F.desc("lead.weight"), F.asc("key")]
    dealt = filled.repartitionByRange(*order).sortWithinPartitions(*order).drop("lead")
    # The lower 33 bits of the id count the rows of a task, so its blocks are its own.
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    schema = T.StructType.fromDDL(_POSTED)
    schema = schema.add("keys", T.ArrayType(rows.schema[key].dataType))
    dealt = dealt.withColumn("block", block).mapInArrow(_blocked, schema)
    with kept_while(dealt, "blocks") as blocked:
        documents = blocked.filter(F.col("keys").isNotNull()).select(
            F.col("block").alias("block_number"), "keys", "lengths"
        )
        documents = documents.sortWithinPartitions("block_number")
        documents.write.option("parquet.block.size", WRITTEN_BLOCK).parquet(f"{path}/documents")
        # A block has few documents, so no term and block is too much for a task.
        listed = blocked.filter(F.col("term").isNotNull())
        for name, columns in (("postings", ["places", "weights"]), ("blocks", ["most"])):
            part = listed.select("term", "block", *columns).repartitionByRange("term", "block")
            part = part.sortWithinPartitions("term", "block")
            part.write.option("compression", "zstd").parquet(f"{path}/{name}")


#: Rows of a block: one for each of its terms, with the places of documents in it and what the
#: term weighs there; and one for its documents, with their keys and lengths.
_POSTED = (
    "block bigint, term string, most double, places array<smallint>, weights array<double>,"
    " lengths array<double>"
)


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        if rows.num_rows == 0:
            continue
        # The last block may go on in the next batch.
        blocks = rows.column("block").to_numpy()
        whole = int(np.searchsorted(blocks, blocks[-1]))
        held = rows.slice(whole)
        yield from _by_block(rows.slice(0, whole))
    if held is not None:
        yield from _by_block(held)


def _by_block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if rows.num_rows == 0:
        return
    whole = rows.combine_chunks().to_batches()[0]
    blocks = whole.column("block").to_numpy()
    cuts = [*np.flatnonzero(np.diff(blocks, prepend=-1)).tolist(), len(blocks)]
    found = [_block(whole.slice(a, z - a)) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
    listed = pa.concat_batches([terms for terms, _ in found])
    keys = pa.list_(whole.column("key").type)
    yield _filled_in(listed, {"lengths": pa.list_(pa.float64()), "keys": keys})
    documents = pa.concat_batches([documents for _, documents in found])
    yield _filled_in(documents, {f.name: f.type for f in listed.schema})


def _block(rows: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """The terms of one block and its documents."""
    number, n = rows.column("block")[0], rows.num_rows
    terms = rows.column("terms").flatten().dictionary_encode()
    place = np.repeat(np.arange(n), rows.column("terms").value_lengths().to_numpy())
    order = np.argsort(terms.indices.to_numpy(), kind="stable")
    code, place = terms.indices.to_numpy()[order], place[order]
    weight = rows.column("weights").flatten().to_numpy()[order]
    length = rows.column("length").to_numpy()
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    bounds = pa.array([*starts, len(code)], pa.int32())
    listed = {
        "block": pa.repeat(number, len(starts)),
        "term": terms.dictionary.take(pa.array(code[starts])),
        "most": pa.array(np.maximum.reduceat(weight / length[place], starts)),
        "places": pa.ListArray.from_arrays(bounds, pa.array(place, pa.int16())),
        "weights": pa.ListArray.from_arrays(bounds, pa.array(weight)),
    }
    one = pa.array([0, n], pa.int32())
    documents = {
        "block": pa.repeat(number, 1),
        "lengths": pa.ListArray.from_arrays(one, pa.array(length)),
        "keys": pa.ListArray.from_arrays(one, rows.column("key")),
    }
    return pa.RecordBatch.from_pydict(listed), pa.RecordBatch.from_pydict(documents)


def _filled_in(rows: pa.RecordBatch, columns: dict[str, pa.DataType]) -> pa.RecordBatch:
    """Rows with NULL in those of the columns that they do not have, in the order of _POSTED."""
    known = dict(zip(rows.schema.names, rows.columns, strict=True))
    for name, kind in columns.items():
        known.setdefault(name, pa.nulls(rows.num_rows, kind))
    names = ["block", "term", "most", "places", "weights", "lengths", "keys"]
    return pa.RecordBatch.from_arrays([known[name] for name in names], names)


def best_documents(
    spark: SparkSession,
    path: str,
    key: str,
    asked: list[tuple[str, float]],
    k: int,
    *,
    first_blocks: int = FIRST_BLOCKS,
) -> DataFrame:
    """``(key, similarity)`` of the ``k`` documents with the largest sum of weight x asked weight.

    ``asked`` holds the query's terms with their weights (zero or more). The result is that of
    scoring all postings; ties go to the smaller key. Documents without any of the terms are
    not among them.
    """
    postings = spark.read.parquet(f"{path}/postings")
    documents = spark.read.parquet(f"{path}/documents")
    schema = "term string, query_weight double"
    query = F.broadcast(spark.createDataFrame(asked, schema))
    named = F.col("term").isin([term for term, _ in asked])

    def hits(chosen: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """``(term, key, weight)`` of the query's terms in chosen blocks."""
        listed, described = chosen(postings.filter(named), "block"), chosen(documents, "block_number")
        at = listed.join(described, F.col("block") == F.col("block_number"))
        postings_at = F.transform(
            F.arrays_zip("places", "weights"),
            lambda e: F.struct(
                F.get("keys", e["places"]).alias(key),
                (e["weights"] / F.get("lengths", e["places"])).alias("weight"),
            ),
        )
        return at.select("term", F.inline(postings_at))

    def scores(rows: DataFrame) -> DataFrame:
        product = F.col("weight") * F.col("query_weight")
        summed = rows.join(query, "term").groupBy(key).agg(F.sum(product).alias("sum"))
        return summed.select(key, F.round("sum", DIGITS).alias("similarity"))

    order = [F.desc("similarity"), F.asc(key)]
    bounds = (
        spark.read.parquet(f"{path}/blocks")
        .filter(named)
        .join(query, "term")
        .groupBy("block")
        .agg(F.sum(F.col("most") * F.col("query_weight")).alias("bound"))
    )
    promising = top_n(bounds, first_blocks, [F.desc("bound"), F.asc("block")]).collect()
    first = [r["block"] for r in promising]
    reached = top_n(scores(hits(lambda rows, at: rows.filter(in_blocks(first, at)))), k, order).collect()
    if len(reached) < k:
        return top_n(scores(hits(lambda rows, _: rows)), k, order)
    threshold = reached[-1]["similarity"]
    able = bounds.filter(F.col("bound") >= threshold - SLACK).select("block")
    blocks = [r["block"] for r in able.limit(NAMED_BLOCKS + 1).collect()]
    if len(blocks) <= NAMED_BLOCKS:
        return top_n(scores(hits(lambda rows, at: rows.filter(in_blocks(blocks, at)))), k, order)

    def reaching(rows: DataFrame, at: str) -> DataFrame:
        return rows.join(able.withColumnRenamed("block", "able"), F.col(at) == F.col("able"), "left_semi")

    return top_n(scores(hits(reaching)), k, order)


def in_blocks(blocks: list[int], column: str = "block") -> Column:
    """Whether a block is one of the given ones, as ranges (for the scan) and as a set."""
    if not blocks:
        return F.lit(False)
    inside = [F.col(column).between(low, high) for low, high in ranges(blocks)]
    return reduce(or_, inside) & F.col(column).isin(blocks)


def ranges(numbers: list[int], most: int = RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges that cover the numbers, parted at the widest gaps."""
    ordered = sorted(set(numbers))
    gaps = sorted(range(1, len(ordered)), key=lambda i: ordered[i - 1] - ordered[i])
    cuts = sorted(gaps[: most - 1])
    starts, ends = [0, *cuts], [*cuts, len(ordered)]
    return [(ordered[a], ordered[b - 1]) for a, b in zip(starts, ends, strict=True)]


def filled_up(found: DataFrame, first_keys: DataFrame, key: str, k: int) -> DataFrame:
    """``found``, followed by the first other keys with 0 if there are fewer than ``k``.

    Of the first 2 x k keys at most k are found, so these are all it takes.
    """
    few = top_n(first_keys, 2 * k, [F.asc(key)])
    rest = few.join(small(found.select(key), k), key, "left_anti")
    fill = rest.withColumn("similarity", F.lit(0.0))
    return top_n(found.unionByName(fill), k, [F.desc("similarity"), F.asc(key)])
