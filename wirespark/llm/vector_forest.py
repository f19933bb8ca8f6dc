"""Near-duplicate vectors by a forest of random-projection trees."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirespark.llm.common import stored
from wirespark.llm.components import connected

#: Trees; vectors a leaf is meant to hold; vectors compared at once; deepest subtree of a round.
TREES, LEAF, BLOCK, DEPTH = 6, 400, 512, 8
#: Vectors of a node that its subtree's thresholds are fitted on.
SAMPLE = 1000
#: Half the width of the zone around a threshold that goes to both sides, as a part of the
#: spread that the difference of two just similar vectors has along a random direction.
SPILL = 0.43
#: A node whose vectors mostly spill to one child can't be split: a group of near copies.
STUCK = 0.9

_SUBTREES = "node bigint, depth int, thresholds array<double>"
_ROWS = "rid bigint, node bigint, parent_size bigint"
_FOUND = "rid bigint, links bigint, root bigint"


def _directions(node: int, depth: int, width: int) -> np.ndarray:
    """A random unit direction for each inner node of a subtree, fixed by the node's number."""
    random = np.random.default_rng(np.random.SeedSequence(int(np.uint64(np.int64(node)))))
    lines = random.standard_normal((2**depth - 1, width))
    return lines / np.linalg.norm(lines, axis=1, keepdims=True)


def _unit(vectors: pd.Series | list) -> np.ndarray:
    x = np.stack(list(vectors)).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _margin(width: int, similar: float) -> float:
    return SPILL * np.sqrt(2 - 2 * similar) / np.sqrt(width)


def _descend(x: np.ndarray, thresholds: np.ndarray, lines: np.ndarray, depth: int, margin: float):
    """Rows of x and the leaf each lands in; a row within the margin of a threshold goes both ways."""
    rows, places = np.arange(len(x)), np.zeros(len(x), np.int64)
    side = x @ lines.T - thresholds
    for _ in range(depth):
        at = side[rows, places]
        left, right = at <= margin, at >= -margin
        rows = np.concatenate([rows[left], rows[right]])
        places = np.concatenate([2 * places[left] + 1, 2 * places[right] + 2])
    return rows, places - (2**depth - 1)


def _threshold(along: np.ndarray, margin: float) -> float:
    """The quantile that splits best, or infinity where all splits spill too much.

    With infinity all rows go to the left child, where another direction is tried. So a group
    of near copies stays together instead of being copied into both children at every level.
    """
    best, least = np.inf, np.inf
    for cut in np.quantile(along, np.linspace(0.2, 0.8, 7)) if len(along) else ():
        left, right = np.mean(along <= cut + margin), np.mean(along >= cut - margin)
        cost = left**2 + right**2
        if max(left, right) <= 0.85 and left + right <= 1.35 and cost < least:
            best, least = cut, cost
    return float(best)


def _fit(key: tuple, rows: pd.DataFrame, similar: float, leaf: int) -> pd.DataFrame:
    """Thresholds of a node's subtree, fitted on its sample."""
    node, size = int(key[0]), int(rows["size"].iloc[0])
    x = _unit(rows["embedding"])
    margin = _margin(x.shape[1], similar)
    depth = int(np.clip(np.ceil(np.log(size / leaf) / np.log(1 / 0.57)), 1, DEPTH))
    lines = _directions(node, depth, x.shape[1])
    thresholds = np.zeros(len(lines))
    member = {0: np.arange(len(x))}
    for place in range(len(lines)):
        at = member.pop(place)
        along = x[at] @ lines[place]
        thresholds[place] = cut = _threshold(along, margin)
        member[2 * place + 1] = at[along <= cut + margin]
        member[2 * place + 2] = at[along >= cut - margin]
    return pd.DataFrame({"node": [node], "depth": [depth], "thresholds": [thresholds]})


def _split(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    """Send the rows of open nodes down their subtrees."""
    for batch in batches:
        frame, out = batch.to_pandas(), []
        for node, rows in frame.groupby("node", sort=False):
            x = _unit(rows["embedding"])
            depth = int(rows["depth"].iloc[0])
            lines = _directions(int(node), depth, x.shape[1])
            thresholds = np.asarray(rows["thresholds"].iloc[0])
            at, place = _descend(x, thresholds, lines, depth, _margin(x.shape[1], similar))
            child = (np.uint64(np.int64(node)) + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(
                0x9E3779B97F4A7C15
            ))
            child ^= child >> np.uint64(29)
            child *= np.uint64(0xBF58476D1CE4E5B9)
            child ^= child >> np.uint64(32)
            out.append(
                (rows["rid"].to_numpy()[at], child.view(np.int64), rows["size"].to_numpy()[at])
            )
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in columns], names=["rid", "node", "parent_size"]
        )


def _forest(points: DataFrame, trees: int, similar: float, leaf: int) -> DataFrame:
    """Leaves of every point in every tree: rid, node, size."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    rows = points.select("rid", "kind", tree).select(
        "rid",
        F.xxhash64("kind", "tree").alias("node"),
        F.lit(None).cast("bigint").alias("parent_size"),
    )
    vectors = points.select("rid", "embedding")
    leaves = []
    while True:
        sizes = rows.groupBy("node").agg(F.count("*").alias("size"))
        sized = stored(rows.join(sizes, "node"), "tree-nodes")
        is_open = (F.col("size") > 2 * leaf) & (
            F.col("parent_size").isNull() | (F.col("size") < F.col("parent_size") * STUCK)
        )
        leaves.append(sized.filter(~F.coalesce(is_open, F.lit(False))).select("rid", "node", "size"))
        going = sized.filter(is_open)
        if going.isEmpty():
            break
        chance = F.pmod(F.xxhash64("rid", "node"), F.lit(1 << 30)) / float(1 << 30)
        sample = going.filter(chance * F.col("size") < SAMPLE).join(vectors, "rid")

        def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            return _fit(key, rows, similar, leaf)

        subtrees = stored(sample.groupBy("node").applyInPandas(fit, _SUBTREES), "subtrees")
        sent = going.select("rid", "node", "size").join(vectors, "rid").join(subtrees, "node")
        rows = sent.mapInArrow(partial(_split, similar=similar), _ROWS)
    found = leaves[0]
    for more in leaves[1:]:
        found = found.union(more)
    return found


def _first_shared(one: np.ndarray, two: np.ndarray, leaf: int) -> np.ndarray:
    """Whether ``leaf`` is the least leaf that both have; rows of padded leaf numbers."""
    earlier = np.zeros(len(one), bool)
    for column in range(one.shape[1]):
        value = one[:, column : column + 1]
        earlier |= ((value == two) & (value < leaf)).any(axis=1)
    return ~earlier


def _compared(rows: pd.DataFrame, similar: float):
    """Link counts and spanning links of one leaf, or of one block of it against another."""
    i, j, leaf = rows["i"].iloc[0], rows["j"].iloc[0], rows["node"].iloc[0]
    first = rows[rows["block"] == i]
    second = first if i == j else rows[rows["block"] == j]
    if first.empty or second.empty:
        return None
    x, y = _unit(first["embedding"]), _unit(second["embedding"])
    a, b = np.nonzero(x @ y.T >= similar)
    ids = [f["rid"].to_numpy() for f in (first, second)]
    times = [f["times"].to_numpy() for f in (first, second)]
    core = [f["core"].to_numpy(float) for f in (first, second)]  # NaN, for none, equals nothing
    fresh = core[0][a] != core[1][b]
    fresh &= (a < b) if i == j else (ids[0][a] != ids[1][b])
    a, b = a[fresh], b[fresh]
    width = int(rows["leaves"].map(len).max())
    pad = [
        np.stack([np.pad(v, (0, width - len(v)), constant_values=np.iinfo(np.int64).max)
                  for v in f["leaves"]])
        for f in (first, second)
    ]
    new = np.concatenate(
        [np.zeros(0, bool)]
        + [
            _first_shared(pad[0][a[s : s + 50_000]], pad[1][b[s : s + 50_000]], leaf)
            for s in range(0, len(a), 50_000)
        ]
    )
    a, b = a[new], b[new]
    if not len(a):
        return None
    names = np.concatenate(ids)
    a, b = a, b + (len(ids[0]) if i != j else 0)
    names, weight = (names, np.concatenate(times)) if i != j else (ids[0], times[0])
    links = np.bincount(a, weights=weight[b], minlength=len(names))
    links += np.bincount(b, weights=weight[a], minlength=len(names))
    root = names.copy()
    while True:  # the least id reachable, by passing it along the links
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            break
    met = links > 0
    return names[met], links[met].astype(np.int64), root[met]


def _compare(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    """Compare group by group; the rows come sorted by node, i, j."""
    rest = None

    def done(frame: pd.DataFrame) -> pa.RecordBatch:
        found = [_compared(rows, similar) for _, rows in frame.groupby(["node", "i", "j"])]
        found = [x for x in found if x is not None]
        columns = [np.concatenate(x) for x in zip(*found)] or [np.zeros(0, np.int64)] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in columns], names=["rid", "links", "root"]
        )

    for batch in batches:
        frame = batch.to_pandas()
        rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if rest.empty:
            continue
        last = (rest[["node", "i", "j"]] != rest[["node", "i", "j"]].iloc[-1]).any(axis=1)
        if last.any():
            yield done(rest[last])
            rest = rest[~last].reset_index(drop=True)
    if rest is not None and not rest.empty:
        yield done(rest)


def _dot(a: str, b: str):
    """Dot product of two vectors in double precision, inside the engine."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _cores(leaves: DataFrame, points: DataFrame, similar: float, block: int) -> DataFrame:
    """Vectors of a crowded leaf that all link: those within half the angle of one of them.

    Two vectors within half of the angle that still links are at most that angle apart. So the
    middle of a group of near copies needs no comparison in itself, however large it is.
    Returns rid, core.
    """
    crowded = leaves.filter(F.col("size") > block).select("rid", "node")
    middle = crowded.groupBy("node").agg(F.min("rid").alias("pivot"))
    vectors = points.select("rid", "embedding")
    pivots = middle.join(
        vectors.withColumnsRenamed({"rid": "pivot", "embedding": "middle"}), "pivot"
    )
    met = crowded.join(vectors, "rid").join(pivots, "node")
    norm = F.sqrt(_dot("embedding", "embedding")) * F.sqrt(_dot("middle", "middle"))
    half = float(np.sqrt((1 + similar) / 2)) + 1e-9
    near = met.filter(_dot("embedding", "middle") / norm >= half)
    return near.groupBy("rid").agg(F.min("pivot").alias("core"))


def near_vectors(
    vectors: DataFrame,
    similar: float = 0.93,
    trees: int = TREES,
    leaf: int = LEAF,
    block: int = BLOCK,
) -> DataFrame:
    """Links between similar vectors of the same label, and their components.

    ``vectors`` needs vec_id, embedding (array of float) and label; other columns are ignored.
    Vectors are compared by cosine in double precision when their labels (and widths) are equal.
    Those with a null label, null or zero vectors and those with null or non-finite
    components link with nothing. Equal vectors are one point that counts as often as it comes.

    Every label is split by ``trees`` random-projection trees. Thresholds are quantiles of a
    bounded sample of each node (``SAMPLE``); every point descends, into both children where it
    lies near a threshold. Nodes above twice ``leaf`` are split again until they are small or
    do not split (a group of near copies). Points of a leaf are compared, in blocks of ``block``;
    a pair counts in the first leaf that holds both, so no pair leaves its task. The middle of
    a group that does not split is linked without comparing (``_cores``). Every link has
    been verified; a pair that no leaf holds is missed (recall is measured in the tests).

    Returns vec_id, n_links (other vectors linked directly), component_id (the smallest vec_id
    reachable by links), kept (vec_id = component_id).
    """
    c = F.col
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    usable = c("label").isNotNull() & finite & nonzero
    rows = vectors.select(
        c("vec_id").cast("bigint").alias("vec_id"),
        c("embedding").cast("array<float>").alias("embedding"),
        F.when(F.coalesce(usable, F.lit(False)), c("label").cast("string")).alias("label"),
    )
    rows = rows.select(
        "vec_id",
        "embedding",
        F.when(
            c("label").isNotNull(), F.concat_ws(":", F.size("embedding"), "label")
        ).alias("kind"),
        F.xxhash64("embedding").alias("h1"),
        F.hash("embedding").alias("h2"),
    )
    used = rows.filter("kind IS NOT NULL")
    points = stored(
        used.groupBy("kind", "h1", "h2").agg(
            F.min("vec_id").alias("rid"),
            F.count("*").alias("times"),
            F.first("embedding").alias("embedding"),
        ),
        "points",
    )
    leaves = stored(_forest(points, trees, similar, leaf), "leaves")
    cores = stored(_cores(leaves, points, similar, block), "cores")
    mine = leaves.groupBy("rid").agg(F.array_sort(F.collect_set("node")).alias("leaves"))
    described = points.select("rid", "times", "embedding").join(mine, "rid")
    described = described.join(cores, "rid", "left")
    # A crowded leaf's blocks: those of its main core first, then the others; all meet all but
    # the core itself.
    crowded = leaves.filter(c("size") > block).join(cores, "rid")
    main = crowded.groupBy("node").agg(F.mode("core", deterministic=True).alias("main"))
    many = F.ceil(c("size") / block).cast("int")
    lane = F.pmod(F.xxhash64("rid"), many).cast("int")
    dealt = leaves.select("rid", "node", "size").join(described, "rid").join(main, "node", "left")
    dealt = dealt.withColumn("in_core", F.coalesce(c("core") == c("main"), F.lit(False)))
    dealt = dealt.withColumn("block", F.when(c("in_core"), lane).otherwise(lane + many))
    others = F.when(c("in_core"), F.sequence(many, 2 * many - 1)).otherwise(
        F.sequence(F.lit(0), 2 * many - 1)
    )
    whole = c("size") <= block
    dealt = dealt.withColumns(
        {
            "block": F.when(whole, F.lit(0)).otherwise(c("block")),
            "other": F.explode(F.when(whole, F.array(F.lit(0))).otherwise(others)),
        }
    )
    groups = dealt.select(
        "node",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "rid",
        "times",
        "core",
        "leaves",
        "embedding",
    )
    sorted_groups = groups.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j")
    found = stored(sorted_groups.mapInArrow(partial(_compare, similar=similar), _FOUND), "found")
    cored = cores.join(points.select("rid", "times"), "rid")
    weights = cored.groupBy("core").agg(F.sum("times").alias("weight"))
    in_core = cored.join(weights, "core").select("rid", (c("weight") - c("times")).alias("links"))
    links = found.select("rid", "links").union(in_core)
    links = links.groupBy("rid").agg(F.sum("links").alias("links"))
    edges = found.select("rid", "root").union(cores.select("rid", c("core").alias("root")))
    roots = connected(edges, "rid", "root").withColumnRenamed("node", "rid")
    result = points.select("kind", "h1", "h2", "rid", "times")
    result = result.join(links, "rid", "left").join(roots, "rid", "left")
    classes = result.select(
        "kind",
        "h1",
        "h2",
        (F.coalesce("links", F.lit(0)) + c("times") - 1).alias("n_links"),
        F.coalesce("root", "rid").alias("component_id"),
    )
    linked = used.select("vec_id", "kind", "h1", "h2").join(classes, ["kind", "h1", "h2"])
    alone = rows.filter("kind IS NULL").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), c("vec_id").alias("component_id")
    )
    every = linked.select("vec_id", "n_links", "component_id").union(alone)
    return every.withColumn("kept", c("vec_id").eqNullSafe(c("component_id")))
