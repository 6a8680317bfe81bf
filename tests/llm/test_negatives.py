"""Hard negatives against comparing every anchor with every row."""

import math
import random

import numpy as np
import pytest

from riskstream.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """rows: (vec_id, embedding, label) as stored in single precision."""
    taken = set()
    for k, x, label in rows:
        if k is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        x = tuple(math.floor(256 * float(np.float32(v))) for v in x)
        taken.add((k, (label + 1) % 10 if k % 7 == 0 else label, x))
    width = max((len(x) for _, _, x in taken), default=0)
    taken = [(k, label, np.array(x + (0,) * (width - len(x)), dtype=object)) for k, label, x in taken]
    result = []
    for k, label, x in taken:
        if k % 100:
            continue
        scored = [(-int((x * y).sum()), j, m) for j, m, y in taken if not (j == k and m == label and (x == y).all())]
        for p, j, m in sorted(s for s in scored if s[2] == label)[:5]:
            fits = sorted(s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)
            result += [(k, j, r, n, -p, -s) for r, (s, n, _) in enumerate(fits[:5], 1)]
    return sorted(result)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in negatives.mine(spark.createDataFrame(rows, SCHEMA), **options).collect())


def clustered(rng, n, width=6, spread=0.05):
    centres = [[rng.gauss(0, 0.6) for _ in range(width)] for _ in range(12)]
    for k in range(n):
        yield (k * 5, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.randrange(10))


@pytest.mark.parametrize("leaf_rows", [8, 10_000])
def test_clusters(spark, leaf_rows):
    rows = list(clustered(random.Random(leaf_rows), 800))
    assert mined(spark, rows, leaf_rows=leaf_rows) == brute(rows)


def test_slices_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SLICE_ROWS", 50)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 4)
    rows = list(clustered(random.Random(3), 600))
    assert mined(spark, rows, leaf_rows=16) == brute(rows)


def test_ties_and_copies(spark):
    """Vectors of few values, so that most scores tie; one vector in a third of all rows."""
    rng = random.Random(1)
    rows = [(k, [0.5, 0.5, 0.5] if k % 3 == 0 else [rng.choice([0.25, 0.5]) for _ in range(3)], k % 4) for k in range(300)]
    assert mined(spark, rows, leaf_rows=4) == brute(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [1.0], 2), (200, [], 2), (300, None, 1), (400, [1.0, None], 1),
        (500, [nan, 1.0], 1), (600, [inf, 1.0], 1), (700, [0.5, 0.5], None), (None, [1.0, 1.0], 1), (1, [1.0, 0.4], 2),
        (2, [0.9, 0.5], 2), (3, [0.9, 0.5], 1), (4, [-1.0, -1.0], 2), (5, [0.9, 0.5], 3), (5, [0.8, 0.5], 3), (800, [1.0, 0.5], 9),
        (900, [-1.0, 0.0], 2), (-100, [0.7, 0.7], 1),
    ]
    assert mined(spark, rows) == brute(rows)


def test_large_components(spark):
    rows = [(k * 20, [2e5 * (k % 9 + 1), 3e5 * (k % 5), 1.0], k % 3) for k in range(60)]
    assert mined(spark, rows, leaf_rows=4) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1)]) == []
    rows = list(clustered(random.Random(5), 100))
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS row", "2 AS top", "3 AS score", "'x' AS rank")
    assert sorted(tuple(r) for r in negatives.mine(table).collect()) == brute(rows)


def test_tree_leaves_subtrees_out():
    """Anchors near one cluster do not visit the leaves of the others."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 8)) * 200
    x = np.floor(np.concatenate([c + rng.normal(size=(200, 8)) * 5 for c in centres]))
    tree = negatives.Tree(x, 60)

    def see(place, rows, distance, nearest):
        node, norm = tree.nodes[place], np.sqrt((x[rows] ** 2).sum(axis=1))
        for child in np.unique(nearest):
            own = nearest == child
            node.low[:, child], node.high[:, child] = distance[own].min(axis=0), distance[own].max(axis=0)
            node.least[child], node.most[child] = norm[own].min(), norm[own].max()

    tree.descend(x, see)
    product = x[:1] @ x.T
    low = np.sort(product[0])[-20:-19][None].astype(np.int64)
    high = np.full_like(low, 1 << 60)
    alive = tree.alive(0, x[:1], low, high)
    assert 1 <= alive.sum() < alive.size / 2


def test_given_vectors(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = sorted(tuple(r) for r in queries.REGISTRY["op13_hard_negatives"](spark, sf).collect())
    assert found and found == brute(rows)
