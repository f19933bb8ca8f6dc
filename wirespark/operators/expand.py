"""Chains of one-to-many joins under one row limit, without their product.

The rows of a chain are ordered prefix first: by the columns of the first frame,
then by those of the first child, and so on. If every prefix row yields a row,
which left joins guarantee and inner joins get from a semi-join beforehand, the
first ``n`` results come from the first ``n`` prefixes and, per key, from the first
``n`` children. So the chain may be cut to ``n`` rows after each join and still
gives what one limit at the end gives. Before a join the children of each key are
counted, and prefixes are kept only until their children reach ``n``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirespark.operators.joins import lookup_join
from wirespark.operators.keyed import small, top_n_per_key

_COPIES = "_copies"
_CHILDREN = "_children"
_BEFORE = "_before"


def first_children(
    child: DataFrame,
    first: DataFrame,
    key: str,
    order: Sequence[Column],
    n: int,
    *,
    distinct: bool = False,
) -> DataFrame:
    """First ``n`` (distinct) child rows of every key in ``first``.

    ``first`` is settled and has at most ``n`` rows. The child is scanned and filtered by the broadcast keys; only rows of those keys
    are shuffled.
    """
    keys = first.select(key).distinct()
    matching = lookup_join(child, small(keys, n), key, "left_semi")
    return top_n_per_key(matching.distinct() if distinct else matching, [key], order, n)


def expanded(
    prefix: DataFrame,
    children: DataFrame,
    key: str,
    order: Sequence[Column],
    child_order: Sequence[Column],
    n: int,
    how: str = "left",
) -> DataFrame:
    """First ``n`` rows of ``prefix JOIN children`` by prefix order, then child order.

    Both sides are limited: ``prefix`` to ``n`` rows, ``children`` to ``n`` rows a key.
    Equal prefix rows are counted and joined once, and a prefix is joined only if fewer
    than ``n`` result rows come before it, so the join yields at most ``n`` rows and one
    key's children.
    """
    copies = prefix.groupBy(*prefix.columns).agg(F.count(F.lit(1)).alias(_COPIES))
    sizes = children.groupBy(key).agg(F.count(F.lit(1)).alias(_CHILDREN))
    alone = F.lit(1 if how == "left" else 0)
    rows = F.col(_COPIES) * F.coalesce(F.col(_CHILDREN), alone)
    counted = copies.join(small(sizes, n), key, "left")
    needed = _placed(counted, rows, order, n).drop(_BEFORE, _CHILDREN)
    joined = needed.join(children, key, how)
    placed = _placed(joined, F.col(_COPIES), [*order, *child_order], n)
    taken = F.least(F.col(_COPIES), F.lit(n) - F.col(_BEFORE)).cast("int")
    columns = [c for c in joined.columns if c != _COPIES]
    return placed.select(*columns, F.explode(F.array_repeat(F.lit(1), taken))).drop("col")


def _placed(df: DataFrame, rows: Column, order: Sequence[Column], n: int) -> DataFrame:
    """Rows with fewer than ``n`` of ``rows`` before them, and how many. One task; few rows."""
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(rows).over(earlier), F.lit(0))
    return df.withColumn(_BEFORE, before).filter(F.col(_BEFORE) < n)
