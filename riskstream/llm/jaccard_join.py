"""Similarity join on word shingles: MinHash bands find candidates, full shingle sets decide.

1. Each text gives its set of five-word shingles and a MinHash signature in bands; the numbers of
   bands and rows follow from the target recall at the threshold.
2. Texts with the same set form one class member (its smallest id, with its number of copies).
3. Band hashes are shuffled; every member of a bucket is tied to the bucket's smallest id, one row each.
   Connected components of these ties hold every pair of texts that share a band, without a list of pairs.
4. A component is checked whole or bucket by bucket, whichever takes fewer copies of texts: whole where most
   members are alike, by buckets where texts that share little are chained. Of buckets with the same members
   one is checked, and a pair counts in the first band that it shares.
5. A group of up to ``BLOCK`` members is checked in one task, a larger one is dealt into blocks of that size
   and every two blocks meet in one task. There, shared shingles of all pairs come from one matrix product.
   A task returns per member its number of links and a tie to the smallest id that links lead to, never its pairs.
6. Components of the verified ties are the classes.

Where g different texts are alike the work still grows with the square of g, in blocks, since each link is
counted; what is shuffled and returned does not list pairs.

Defined results: a text with fewer than five words, but not none, is one shingle. A null or wordless
text has no shingles and no links; it is a class of its own. A row without an id has no class (null)
and no links. Rows that share an id are one document: a repeated row gives a row with equal results and adds no
link, and the links of different texts under one id add up. Ids that are no integers are numbered in their
order first and named again in the result. Texts are read whole, whatever their length. A pair at
the threshold is a link. An empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from riskstream.llm import storage
from riskstream.llm.components import components
from riskstream.llm.storage import cut
from riskstream.llm.textarrays import (
    ALPHANUMERIC,
    LOWER,
    Chunk,
    chunks,
    hashes,
    mix,
    shingles,
    words,
)

SHINGLE = 5
#: Least similarity of a link, in tenths.
THRESHOLD_TENTHS = 8
RECALL = 0.999
#: Hash functions that bands and rows may use.
SIGNATURE = 100
BLOCK = 256
#: Members (pairs of two numbers) that may be broadcast to pick texts: 32 MB.
BROADCAST_ROWS = 1 << 20


def choose_bands(threshold: float, recall: float, budget: int = SIGNATURE) -> tuple[int, int]:
    """The most selective bands and rows that find a pair at the threshold with probability ``recall``."""
    for rows in range(budget, 0, -1):
        bands = budget // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    raise ValueError("no bands reach this recall within the budget")


def _sets(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    low = Chunk(chunk.first, LOWER[chunk.data], chunk.offsets)
    found = words(low, ALPHANUMERIC)
    return shingles(hashes(low.data, found.start, found.end), found.row_first, SHINGLE)


def signatures(values: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of each non-empty set: one column per band."""
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    some = np.flatnonzero(np.diff(bounds))
    result = np.zeros((len(some), bands), dtype=np.uint64)
    if len(some):
        first = bounds[some]
        for band in range(bands):
            total = np.full(len(some), np.uint64(band + 1))
            for row in range(rows):
                least = np.minimum.reduceat(values * factors[band * rows + row], first)
                total = mix(total ^ least)
            result[:, band] = total
    return result


def _signed(bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                values, bounds = _sets(chunk)
                size = np.diff(bounds)
                some = np.flatnonzero(size)
                digest = np.zeros((2, chunk.rows), dtype=np.uint64)
                if len(some):
                    for k, salt in enumerate((0, 0x5851F42D4C957F2D)):
                        digest[k, some] = np.add.reduceat(mix(values + np.uint64(salt)), bounds[some])
                band = np.zeros((chunk.rows, bands), dtype=np.uint64)
                band[some] = signatures(values, bounds, bands, rows)
                edges = np.zeros(chunk.rows + 1, dtype=np.int32)
                edges[1:] = np.cumsum(np.where(size > 0, bands, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.rows),
                        pa.array(size),
                        pa.array(digest[0].view(np.int64)),
                        pa.array(digest[1].view(np.int64)),
                        batch.column(2).slice(chunk.first, chunk.rows),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(band[some].reshape(-1).view(np.int64))),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "version", "bands"],
                )

    return run


def linked(values: np.ndarray, bounds: np.ndarray, tenths: int = THRESHOLD_TENTHS) -> np.ndarray:
    """Which two of some sets are similar enough, from the shared shingles of all pairs at once."""
    n, size = len(bounds) - 1, np.diff(bounds)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(values, kind="stable")
    value, owner = values[order], owner[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = value[1:] != value[:-1]
    column = np.cumsum(fresh) - 1
    many = np.bincount(column)[column] > 1  # a shingle of one text alone is shared with none
    fresh = fresh[many]
    column, owner = np.cumsum(np.concatenate([[0], np.diff(column[many]) != 0])[: many.sum()]), owner[many]
    shared = np.zeros((n, n), dtype=np.float64)
    step = max(1, (1 << 21) // n)
    width = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, width, step):
        part = slice(*np.searchsorted(column, [low, low + step]))
        block = np.zeros((n, min(step, width - low)), dtype=np.float32)
        block[owner[part], column[part] - low] = 1
        shared += block @ block.T  # exact: counts stay far below 2 ** 24 per block
    union = size[:, None] + size[None, :] - shared
    result = (10 * shared >= tenths * union) & (union > 0)
    np.fill_diagonal(result, False)
    return result


def _smallest_reached(near: np.ndarray, node: np.ndarray) -> np.ndarray:
    """For each member the smallest id that its links lead to within the tile."""
    reached, before = node, None
    while before is None or (reached != before).any():
        before = reached
        reached = np.minimum(before, np.where(near, before[None, :], np.iinfo(np.int64).max).min(axis=1))
    return reached


def _verify(groups) -> pa.RecordBatch:
    """Links and ties of the members of some tiles."""
    ids, links, least = [], [], []
    for node, copies, side, earlier, texts, one_block in groups:
        column = pa.array(texts, pa.large_string())
        parts = [_sets(chunk) for chunk in chunks(column)]
        values = np.concatenate([p[0] for p in parts])
        bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[1]) for p in parts]))])
        near = linked(values, bounds)
        if not one_block:  # pairs within a block belong to the block's own tile
            near &= side[:, None] != side[None, :]
        near &= node[:, None] != node[None, :]
        for band in earlier:  # pairs that share an earlier band belong to that bucket's tile
            near &= band[:, None] != band[None, :]
        ids.append(node)
        links.append(near @ copies)
        least.append(_smallest_reached(near, node))
    flat = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (ids, links, least)]
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in flat], names=["node", "links", "least"])


_TILE = ["band", "value", "low", "high"]


def _tiles(batches):
    """Cut the sorted rows of a partition at changes of tile and verify each tile."""
    rest: list[pa.RecordBatch] = []

    def group(parts):
        table = pa.Table.from_batches(parts)
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        numbers = [table.column(name).to_numpy().astype(np.int64) for name in ("node", "copies", "block")]
        earlier = table.column("earlier").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1).T
        return (*numbers, earlier, table.column("text").to_pylist(), low == high)

    for batch in batches:
        key = [batch.column(k).to_numpy() for k in range(len(_TILE))]
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in key:
            change[1:] |= k[1:] != k[:-1]
        if rest and batch.num_rows:
            change[0] = any(rest[-1].column(k)[-1].as_py() != key[k][0] for k in range(len(_TILE)))
        cuts = np.flatnonzero(change)
        pending = []
        at = 0
        for cut_at in cuts.tolist():
            if cut_at > at:
                rest.append(batch.slice(at, cut_at - at))
            if rest:
                pending.append(group(rest))
            rest, at = [], cut_at
            if len(pending) >= 64:
                yield _verify(pending)
                pending = []
        rest.append(batch.slice(at))
        if pending:
            yield _verify(pending)
    if rest and sum(part.num_rows for part in rest):
        yield _verify([group(rest)])


def _groups(candidate: DataFrame, members: DataFrame) -> DataFrame:
    """node, version, copies, bands and ``groups`` (band, value, blocks) in which each member is checked.

    A component checked whole is one group with band -1 and needs no bands.
    """

    def blocks(size: str):
        return F.ceil(F.col(size) / BLOCK).cast("int")

    sizes = candidate.groupBy("component").agg(F.count("*").alias("size"))
    placed = cut(candidate.join(sizes, "component").join(members, "node"))
    bucketed = placed.filter(F.col("size") > BLOCK).select(
        "component", "node", "version", "copies", "set_a", "set_b", "bands", F.posexplode("bands").alias("band", "value")
    )
    # buckets with the same members, told by their digests, are checked once, in the first band
    buckets = cut(
        bucketed.groupBy("component", "band", "value")
        .agg(
            F.min("node").alias("least"),
            F.max("node").alias("most"),
            F.count("*").alias("n"),
            F.bit_xor("set_a").alias("all_a"),
            F.bit_xor("set_b").alias("all_b"),
        )
        .filter("least < most")
        .groupBy("component", "n", "all_a", "all_b")
        .agg(F.min(F.struct("band", "value")).alias("first"))
        .select("component", "n", "first.band", "first.value")
    )
    cost = buckets.groupBy("component").agg(F.sum(F.col("n") * blocks("n")).alias("cost"))
    loose = cut(cost.join(sizes, "component").filter(F.col("cost") < F.col("size") * blocks("size")).select("component"))
    whole = placed.join(loose, "component", "left_anti").select(
        "node",
        "version",
        "copies",
        F.array(
            F.struct(F.lit(-1).alias("band"), F.col("component").alias("value"), blocks("size").alias("blocks"))
        ).alias("groups"),
        F.array().cast("array<long>").alias("bands"),
    )
    parts = (
        bucketed.join(buckets.join(loose, "component"), ["component", "band", "value"])
        .groupBy("node", "version", "copies")
        .agg(
            F.collect_list(F.struct("band", "value", blocks("n").alias("blocks"))).alias("groups"),  # one a band
            F.any_value("bands").alias("bands"),
        )
    )
    return whole.unionByName(parts)


def join(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (smallest id of its class), n_links (other documents similar enough) of every row."""
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        return _join(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), recall)
    ids = docs.select("doc_id").filter("doc_id is not null").distinct().orderBy("doc_id")
    numbers = cut(ids.withColumn("number", F.monotonically_increasing_id()))
    found = _join(docs.join(numbers, "doc_id", "left").select(F.col("number").alias("doc_id"), "text"), recall)
    own = numbers.select(F.col("doc_id").alias("name"), F.col("number").alias("doc_id"))
    classes = numbers.select(F.col("doc_id").alias("class_name"), F.col("number").alias("class_id"))
    return (
        found.join(own, "doc_id", "left")
        .join(classes, "class_id", "left")
        .select(F.col("name").alias("doc_id"), F.col("class_name").alias("class_id"), "n_links", "n_shingles")
    )


def _join(docs: DataFrame, recall: float) -> DataFrame:
    bands, rows = choose_bands(THRESHOLD_TENTHS / 10, recall)
    docs = storage.texts(docs).withColumn("version", F.xxhash64("text"))
    signed = cut(
        docs.mapInArrow(
            _signed(bands, rows),
            "doc_id long, n_shingles long, set_a long, set_b long, version long, bands array<long>",
        )
    )
    of_set = ["set_a", "set_b", "n_shingles"]
    known = signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    members = cut(
        known.groupBy(*of_set, "doc_id")
        .agg(F.min("version").alias("version"), F.any_value("bands").alias("bands"))
        .groupBy(*of_set)
        .agg(
            F.min(F.struct("doc_id", "version")).alias("least"),
            F.count("*").alias("copies"),
            F.any_value("bands").alias("bands"),
        )
        .select(*of_set, F.col("least.doc_id").alias("node"), "least.version", "copies", "bands")
    )
    buckets = members.select("node", F.posexplode("bands").alias("band", "value"))
    firsts = buckets.groupBy("band", "value").agg(F.min("node").alias("b"), F.max("node").alias("most"))
    ties = (
        buckets.join(firsts.filter("b < most").drop("most"), ["band", "value"])
        .filter("node > b")
        .select(F.col("node").alias("a"), "b")
        .distinct()
    )
    picked = cut(_groups(components(ties), members))
    keys = picked.select("node", "version")
    texts = (
        docs.withColumnRenamed("doc_id", "node")
        .join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, ["node", "version"])
        .dropDuplicates(["node", "version"])  # rows repeated in docs
        .join(picked, ["node", "version"])  # dealt as the step before
    )
    grouped = texts.withColumn("at", F.explode("groups")).select(
        "at.*",
        "node",
        "copies",
        F.pmod(F.xxhash64("node", "version"), F.col("at.blocks")).cast("int").alias("block"),
        F.slice("bands", 1, F.greatest(F.col("at.band"), F.lit(0))).alias("earlier"),
        "text",
    )
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    tiles = grouped.withColumn("other", F.explode(other)).select(
        "band",
        "value",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "node",
        "copies",
        "block",
        "earlier",
        "text",
    )
    verified = cut(
        tiles.repartition(*_TILE)
        .sortWithinPartitions(*_TILE)
        .mapInArrow(_tiles, "node long, links long, least long")
    )
    per_member = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(verified.filter("least < node").select(F.col("node").alias("a"), F.col("least").alias("b")))
    described = (
        members.join(per_member, "node", "left")
        .join(classes, "node", "left")
        .select(
            *of_set,
            F.coalesce("component", "node").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    own = signed.drop("bands", "version")
    return own.join(described, of_set, "left").select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0)))
        .otherwise(F.lit(0))
        .cast("long")
        .alias("n_links"),
        "n_shingles",
    )
