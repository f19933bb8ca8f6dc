"""The most frequent of very many items: small summaries per task, then one exact count.

Each task keeps the counts of at most ``capacity`` items. When it holds more, the count of the
first item beyond the capacity is taken off all of them and those that reach zero go (the pruning
of Misra and Gries, in bulk; Agarwal et al., "Mergeable Summaries", 2012). What was taken off adds
up to the summary's error: an item's count is too low by that at most, and an item that is not
there occurs that often at most. Sums over the tasks keep this property, so only ``capacity`` rows
a task are shuffled however many different items there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows a task gathers before it adds them up.
GATHERED = 1 << 17


def pruned(counts: pa.Table, capacity: int) -> tuple[pa.Table, int]:
    """At most ``capacity`` items of ``(item, n)``, and how much was taken off each count."""
    if counts.num_rows <= capacity:
        return counts, 0
    n = counts.column("n").to_numpy()
    place = len(n) - 1 - capacity
    lost = int(np.partition(n, place)[place])
    left = counts.set_column(1, "n", pa.array(n - lost))
    return left.filter(pa.array(n > lost)), lost


def _added_up(tables: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(tables).group_by("item").aggregate([("n", "sum")])
    return pa.table({"item": sums.column("item"), "n": sums.column("n_sum")})


def summaries(
    df: DataFrame, items: Callable[[pa.RecordBatch], Iterator[pa.Table]], capacity: int
) -> DataFrame:
    """``(item, n)`` of every task's summary; a row without an item holds the task's error.

    ``items`` gives the strings (column item) and counts (n) of a batch.
    """

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows, error = 0, 0
        for batch in batches:
            for table in items(batch):
                table = _added_up([table])  # what repeats within a batch is held once
                held.append(table)
                rows += table.num_rows
                if rows >= GATHERED + 2 * capacity:
                    counts, lost = pruned(_added_up(held), capacity)
                    held, rows, error = [counts], counts.num_rows, error + lost
        if held:
            counts, lost = pruned(_added_up(held), capacity)
            counts = counts.cast(_COUNTS)
            yield from counts.to_batches()
            last = [pa.nulls(1, pa.string()), pa.array([error + lost], pa.int64())]
            yield pa.RecordBatch.from_arrays(last, schema=_COUNTS)

    return df.mapInArrow(summarised, "item string, n bigint")


_COUNTS = pa.schema({"item": pa.string(), "n": pa.int64()})


def merged(summary: DataFrame) -> DataFrame:
    """``(item, n)`` of all tasks together; the row without an item holds the whole error."""
    return summary.groupBy("item").agg(F.sum("n").alias("n"))


def look_up(terms: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of each term among the known ones; -1 where it is none of them."""
    places = pc.index_in(terms, value_set=known.cast(terms.type))
    return pc.fill_null(places, -1).to_numpy(zero_copy_only=False)
