"""Hard negatives by exact search in a multiway hyperplane tree.

The tree follows GNAT: a node has up to ``FAN`` split points, each row goes to the child of its nearest one, and
for each split point and each sibling subtree the node keeps the least and the greatest distance between
them, over all rows. Split points come from a bounded sample (``SAMPLE_ROWS``); ranges and leaves hold every row.

A search asks for inner products within a window. With the norms in a subtree a window is an annulus of
distances around the anchor; seen from a split point that is another annulus, and a subtree whose range it
misses is left out. What remains is compared in full in the leaves, so results are exact and the tree only saves work.

First each anchor searches its own subtree of the root for its positives; the least of those found bounds the
search of the others; then each positive's window is searched for negatives. Anchors and rows meet in a
cogroup of a subtree of the root. A subtree of over ``SLICE_ROWS`` rows is dealt to slices by the hash of its
rows, and anchors beyond ``ANCHOR_BLOCK`` to blocks, so no group grows with the data.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part.
Repeats of a whole row count once; rows that share an id are rows of their own, in order of their content. Shorter vectors
count as followed by zeros. An anchor without positives, or a positive without negatives, gives no
rows. Inner products are exact within 60 bits and cut to that beyond. Empty tables give no rows. Columns
other than ``vec_id``, ``embedding`` and ``label`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskstream.llm.storage import cut

POSITIVES = NEGATIVES = 5
FAN = 16
#: Rows from which split points are taken, and the rows of a leaf at that; at most one leaf for 16 sampled rows.
SAMPLE_ROWS, LEAF_ROWS = 16384, 256
SLICE_ROWS, ANCHOR_BLOCK = 32768, 65536
#: Anchors compared with a leaf at once.
TILE = 1024
_LARGEST = 1 << 60
_ROW = "vec_id long, label long, row long, vector array<long>"


@dataclass
class Node:
    points: np.ndarray
    children: list[int]  # a node's place, or -1 - leaf
    low: np.ndarray = field(init=False)  # from split point i to the rows of child j
    high: np.ndarray = field(init=False)
    least: np.ndarray = field(init=False)  # norms of the rows of child j
    most: np.ndarray = field(init=False)

    def __post_init__(self):
        n = len(self.points)
        self.low, self.high = np.full((n, n), np.inf), np.full((n, n), -np.inf)
        self.least, self.most = np.full(n, np.inf), np.full(n, -np.inf)


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2 * x @ points.T
    return np.sqrt(np.maximum(squares, 0))


class Tree:
    """Nodes, the root first, and for each leaf the child of the root above it."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.nodes: list[Node] = []
        self.top: list[int] = []
        self._random = np.random.default_rng(7)
        self._grow(sample, leaves, -1)

    def _points(self, sample: np.ndarray) -> np.ndarray:
        """Split points far from one another: of three times as many candidates, each time the farthest."""
        distinct = np.unique(sample, axis=0)
        candidates = distinct[self._random.permutation(len(distinct))[: 3 * FAN]]
        chosen, nearest = [0], _distances(candidates, candidates[:1])[:, 0]
        while len(chosen) < min(FAN, len(candidates)):
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _distances(candidates, candidates[chosen[-1:]])[:, 0])
        return candidates[chosen]

    def _grow(self, sample: np.ndarray, leaves: int, top: int) -> int:
        node = Node(self._points(sample), [])
        place = len(self.nodes)
        self.nodes.append(node)
        nearest = _distances(sample, node.points).argmin(axis=1)
        for child in range(len(node.points)):
            own, above = sample[nearest == child], child if top < 0 else top
            share = round(leaves * len(own) / len(sample))
            if share > 1 and len(np.unique(own, axis=0)) > FAN:
                node.children.append(self._grow(own, share, above))
            else:
                node.children.append(-1 - len(self.top))
                self.top.append(above)
        return place

    def descend(self, x: np.ndarray, see=None) -> np.ndarray:
        """The leaf of every row; ``see`` gets each node with the rows' distances and nearest points."""
        leaf = np.zeros(len(x), dtype=np.int64)
        waiting = [(0, np.arange(len(x)))]
        while waiting:
            place, rows = waiting.pop()
            node = self.nodes[place]
            distance = _distances(x[rows], node.points)
            nearest = distance.argmin(axis=1)
            if see:
                see(place, rows, distance, nearest)
            for child in np.unique(nearest):
                own, target = rows[nearest == child], node.children[child]
                if target < 0:
                    leaf[own] = -1 - target
                else:
                    waiting.append((target, own))
        return leaf

    def alive(self, place: int, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which children of a node may hold a row whose product with an anchor lies in one of its windows.

        ``low`` and ``high`` have a column for each window; an empty window has ``low`` above ``high``.
        """
        node = self.nodes[place]
        norm, away = (x * x).sum(axis=1), _distances(x, node.points)
        slack = 1e-6 * (1 + np.sqrt(norm) + np.max(node.most, initial=0))[:, None]
        result = np.zeros((len(x), len(node.points)), dtype=bool)
        with np.errstate(invalid="ignore"):
            for k in range(low.shape[1]):
                far = norm[:, None] + node.most**2 - 2 * low[:, k : k + 1]
                near = norm[:, None] + node.least**2 - 2 * high[:, k : k + 1]
                far, near = np.sqrt(np.maximum(far, 0)), np.sqrt(np.maximum(near, 0))
                fits = (low[:, k] <= high[:, k])[:, None] & (node.most >= 0) & (near <= far + slack)
                for i in range(len(node.points)):
                    inner = np.maximum(away[:, i : i + 1] - far, near - away[:, i : i + 1])
                    fits &= (inner <= node.high[i] + slack) & (away[:, i : i + 1] + far >= node.low[i] - slack)
                result |= fits
        return result

    def leaves_alive(self, top: int, x: np.ndarray, low: np.ndarray, high: np.ndarray):
        """(leaf, anchors) below a child of the root, for the leaves that some anchor cannot leave out."""
        waiting = [(self.nodes[0].children[top], np.arange(len(x)))]
        while waiting:
            place, anchors = waiting.pop()
            if place < 0:
                yield -1 - place, anchors
                continue
            fits = self.alive(place, x[anchors], low[anchors], high[anchors])
            for child, target in enumerate(self.nodes[place].children):
                if (own := anchors[fits[:, child]]).size:
                    waiting.append((target, own))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` integers as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as integers. Doubles hold them exactly unless ``exact`` asks for long arithmetic."""
    if not exact:
        return (a @ b.T).astype(np.int64)
    long = np.array([[int(v) for v in row] for row in a], dtype=object) @ np.array([[int(v) for v in row] for row in b], dtype=object).T
    return np.clip(long, -_LARGEST, _LARGEST).astype(np.int64)


def vectors(table: DataFrame) -> DataFrame:
    """vec_id, label, row, vector of the rows that take part; ``row`` is a hash of all three."""
    x = F.col("embedding")
    whole = table.filter(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & x.isNotNull()
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    integers = F.transform(x, lambda v: F.floor(F.lit(256.0) * v.cast("double")))
    rows = whole.select(F.col("vec_id").cast("long"), moved.cast("long").alias("label"), integers.alias("vector"))
    return rows.select("vec_id", "label", F.xxhash64("vec_id", "label", "vector").alias("row"), "vector")


class Index:
    """A tree over all rows, how many slices each subtree of the root has, and the rows dealt to them."""

    def __init__(self, table: DataFrame, leaf_rows: int = LEAF_ROWS):
        rows = vectors(table)
        size = rows.agg(
            F.count("*").alias("n"),
            F.max(F.size("vector")).alias("width"),
            F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))).alias("most"),
            F.count_if(F.col("vec_id") % 100 == 0).alias("anchors"),
        ).first()
        self.n, self.width = size.n, max(size.width or 0, 1)
        self.exact = (size.most or 0) ** 2 * self.width * 4 >= 1 << 53
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(self.width) - F.size("vector"))
        self.rows = rows.withColumn("vector", F.concat("vector", zeros))
        self.blocks = max(1, -(-size.anchors // ANCHOR_BLOCK))
        if self.n:
            self._fit(leaf_rows)

    def _fit(self, leaf_rows: int) -> None:
        share = min(1.0, SAMPLE_ROWS / self.n)
        chosen = self.rows.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < max(1, int(share * (1 << 30))))
        # about SAMPLE_ROWS vectors; repeats of a row have one hash and count once
        sample = chosen.select("row", "vector").distinct().toArrow()
        if not sample.num_rows:
            sample = self.rows.select("row", "vector").limit(1).toArrow()
        leaves = max(2, min(-(-self.n // leaf_rows), sample.num_rows // 16))
        self.tree = Tree(_matrix(sample.column("vector"), self.width), leaves)
        seen = self.rows.select("vector").mapInArrow(
            self._ranges(), "node int, point int, child int, low double, high double, least double, most double, n long"
        )
        seen = seen.groupBy("node", "point", "child").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("least"),
            F.max("most").alias("most"), F.sum("n").alias("n"),
        )
        counts = np.zeros(len(self.tree.nodes[0].points), dtype=np.int64)
        for r in seen.collect():  # FAN squared for each node
            node = self.tree.nodes[r.node]
            node.low[r.point, r.child], node.high[r.point, r.child] = r.low, r.high
            node.least[r.child], node.most[r.child] = r.least, r.most
            if r.node == 0:
                counts[r.child] = r.n
        self.slices = np.maximum(1, -(-counts // SLICE_ROWS))

    def _shared(self):
        return self.rows.sparkSession.sparkContext.broadcast(self.tree)

    def _ranges(self):
        shared, width = self._shared(), self.width

        def run(batches):
            tree = shared.value
            kept: dict[tuple, list] = {}
            for batch in batches:
                x = _matrix(batch.column(0), width)
                norm = np.sqrt((x * x).sum(axis=1))

                def see(place, rows, distance, nearest, norm=norm):
                    for child in np.unique(nearest):
                        own = nearest == child
                        low, high = distance[own].min(axis=0), distance[own].max(axis=0)
                        least, most = norm[rows[own]].min(), norm[rows[own]].max()
                        at = kept.get((place, child))
                        if at is None:
                            kept[place, child] = [low, high, least, most, int(own.sum())]
                        else:
                            kept[place, child] = [
                                np.minimum(at[0], low), np.maximum(at[1], high), min(at[2], least), max(at[3], most),
                                at[4] + int(own.sum()),
                            ]

                if len(x):
                    tree.descend(x, see)
            found = [
                (place, point, int(child), float(low[point]), float(high[point]), float(least), float(most), n)
                for (place, child), (low, high, least, most, n) in kept.items()
                for point in range(len(low))
            ]
            names = ["node", "point", "child", "low", "high", "least", "most", "n"]
            kinds = [pa.int32()] * 3 + [pa.float64()] * 4 + [pa.int64()]
            columns = list(zip(*found, strict=True)) if found else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        return run

    def dealt(self) -> DataFrame:
        """Every row with its leaf and its group: subtree, slice and block of anchors."""
        shared, width, slices, blocks = self._shared(), self.width, self.slices, self.blocks

        def run(batches):
            tree = shared.value
            top_of = np.array(tree.top)
            for batch in batches:
                leaf = tree.descend(_matrix(batch.column(3), width)) if batch.num_rows else np.zeros(0, dtype=np.int64)
                top = top_of[leaf]
                part = batch.column(2).to_numpy() % slices[top]
                new = [pa.array(top, pa.int32()), pa.array(part, pa.int64()), pa.array(leaf, pa.int32())]
                yield pa.RecordBatch.from_arrays([*new, *batch.columns], names=["top", "slice", "leaf", *batch.schema.names])

        placed = self.rows.mapInArrow(run, f"top int, slice long, leaf int, {_ROW}")
        return placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def sent(self, anchors: DataFrame, which: str) -> DataFrame:
        """Anchors (row, label, vector, low, high) to the subtrees of the root where they search.

        ``which`` is ``own``, ``others`` or ``all``; all but the first leave out what the windows miss.
        """
        shared, width, slices = self._shared(), self.width, self.slices

        def run(batches):
            tree = shared.value
            top_of = np.array(tree.top)
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column(2), width)
                own = top_of[tree.descend(x)][:, None] == np.arange(len(slices))
                if which == "own":
                    go = own
                else:
                    go = tree.alive(0, x, *_windows(batch.column(3), batch.column(4)))
                    go = go & ~own if which == "others" else go
                anchor, top = np.nonzero(go)
                times = slices[top]
                anchor, top = np.repeat(anchor, times), np.repeat(top, times)
                part = np.arange(len(top)) - np.repeat(np.cumsum(times) - times, times)
                rows = batch.take(pa.array(anchor))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(top, pa.int32()), pa.array(part, pa.int64()), *rows.columns],
                    names=["top", "slice", *batch.schema.names],
                )

        columns = anchors.select("row", "label", "vector", "low", "high")
        schema = "top int, slice long, row long, label long, vector array<long>, low array<long>, high array<long>"
        block = F.pmod(F.xxhash64("row"), F.lit(self.blocks)).cast("int")
        return columns.mapInArrow(run, schema).withColumn("block", block)

    def search(self, anchors: DataFrame, which: str, same_label: bool, first: int) -> DataFrame:
        """row, window, vec_id, other, score: the ``first`` rows of each window of each anchor, of each group."""
        shared, width, exact = self._shared(), self.width, self.exact
        schema = "row long, window int, vec_id long, other long, score long"

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            found = []
            if left.num_rows and right.num_rows:
                top = left.column("top")[0].as_py()
                order = np.lexsort((right.column("row").to_numpy(), right.column("vec_id").to_numpy()))
                _, once = np.unique(right.column("row").to_numpy()[order], return_index=True)
                order = order[np.sort(once)]  # by id, so that stable sorts settle ties; repeats once
                data = right.take(pa.array(order))
                leaf, ids = data.column("leaf").to_numpy(), data.column("vec_id").to_numpy()
                row, label, x = data.column("row").to_numpy(), data.column("label").to_numpy(), _matrix(data.column("vector"), width)
                for at in range(0, left.num_rows, TILE):
                    part = left.slice(at, TILE)
                    low, high = _windows(part.column("low"), part.column("high"))
                    mine, own = part.column("row").to_numpy(), part.column("label").to_numpy()
                    a = _matrix(part.column("vector"), width)
                    best = []
                    for k, anchors in shared.value.leaves_alive(top, a, low, high):
                        rows = np.flatnonzero(leaf == k)
                        if not len(rows):
                            continue
                        score = _products(a[anchors], x[rows], exact)
                        fits = (label[rows] == own[anchors, None]) == same_label
                        fits &= row[rows] != mine[anchors, None]
                        score[~fits] = -2 * _LARGEST
                        ranks = np.argsort(-score, axis=1, kind="stable")
                        score = np.take_along_axis(score, ranks, axis=1)
                        for w in range(low.shape[1]):
                            start = (score > high[anchors, w : w + 1]).sum(axis=1)
                            place = start[:, None] + np.arange(min(first, len(rows)))
                            inside = place < len(rows)
                            place = np.minimum(place, len(rows) - 1)
                            value = np.take_along_axis(score, place, axis=1)
                            inside &= (value >= low[anchors, w : w + 1]) & (value > -2 * _LARGEST)
                            i, j = np.nonzero(inside)
                            target = rows[np.take_along_axis(ranks, place, axis=1)[i, j]]
                            best.append((anchors[i], np.full(len(i), w), target, value[i, j]))
                    if best:
                        anchor, window, target, value = (np.concatenate(c) for c in zip(*best, strict=True))
                        order = np.lexsort((target, -value, window, anchor))
                        anchor, window, target, value = anchor[order], window[order], target[order], value[order]
                        group = anchor * low.shape[1] + window
                        rank = np.arange(len(group)) - np.searchsorted(group, group)
                        keep = rank < first
                        found.append((mine[anchor[keep]], window[keep], ids[target[keep]], row[target[keep]], value[keep]))
            columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, dtype=np.int64)] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.Table.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["row", "window", "vec_id", "other", "score"]
            )

        group = ["top", "slice", "block"]
        return self.sent(anchors, which).groupBy(*group).cogroup(self.dealt().groupBy(*group)).applyInArrow(run, schema)


def _windows(low, high) -> tuple[np.ndarray, np.ndarray]:
    """Window bounds of each anchor; anchors with fewer windows get empty ones."""
    low, high = low.to_pylist(), high.to_pylist()
    width = max(map(len, low), default=0)
    lows, highs = np.full((len(low), width), 1), np.zeros((len(low), width), dtype=np.int64)
    for k, (a, b) in enumerate(zip(low, high, strict=True)):
        lows[k, : len(a)], highs[k, : len(b)] = a, b
    return lows.astype(np.int64), highs


def _first(found: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), "vec_id", "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def mine(table: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    index = Index(table, leaf_rows)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not index.n:
        return table.sparkSession.createDataFrame([], schema)
    anchors = index.rows.filter(F.col("vec_id") % 100 == 0).distinct()
    lowest, highest = F.lit(-_LARGEST), F.lit(_LARGEST)
    any_score = anchors.withColumns({"low": F.array(lowest), "high": F.array(highest)})
    near = cut(_first(index.search(any_score, "own", True, positives), positives))
    bound = near.groupBy("row").agg(F.count("*").alias("k"), F.min("score").alias("least"))
    least = F.coalesce(F.when(F.col("k") == positives, F.col("least")), lowest)
    bounded = anchors.join(bound, "row", "left").withColumns({"low": F.array(least), "high": F.array(highest)})
    far = index.search(bounded, "others", True, positives)
    found = cut(_first(near.drop("rank").unionByName(far), positives))
    listed = found.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "other", "score"))).alias("found")  # ``positives`` at most
    )
    high = F.transform("found", lambda p: p["score"])
    low = F.transform("found", lambda p: F.ceil(p["score"].cast("decimal(20,0)") * 4 / 5).cast("long"))
    asked = cut(anchors.join(listed, "row").withColumns({"low": low, "high": high}))
    hard = _first(index.search(asked, "all", False, negatives), negatives)
    named = asked.select("row", F.col("vec_id").alias("anchor_id"), "found")
    positive = F.get("found", F.col("window"))
    return hard.join(named, "row").select(
        "anchor_id",
        positive["vec_id"].alias("positive_id"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
