"""Ranked lexical search by a pipeline of term owners.

One pass over the texts keeps, for each document, the terms that some item asks for, with their
counts; documents are numbered and cut into blocks of ``BLOCK_DOCS``. Terms are dealt to owners by how common
they are, the rarest first. A bundle is an item's sparse accumulators (documents and integer scores) in
one block. It passes the owners one after another: at each, bundles and the owner's postings of the block meet in a
cogroup, and every posting of a term of the item adds its contribution. Between two owners
each item learns its tenth best score so far. An accumulator goes once it cannot reach that with all that the
later owners could add, and no new one is opened for a document that could not; ties stay, so the
result is exact. Frequent terms come last, when few accumulators are left, and no block or owner
has more rows than its documents have terms.

Items are searched in batches whose texts stay within ``BATCH_BYTES``; a batch's terms, their statistics and its items
are all that the driver holds.

Defined results: a null or empty text has no terms; a document without terms is not counted and an item
without terms, or of which no document has a term, has no rows. Texts of one ``item_id`` are taken as one item, whole repeats
once. Every row of ``docs`` is a document of its own: rows that share an id are ranked apart, a null id
after all others. Equal scores go by ascending id, then by place in the table. Texts are read whole,
whatever their length. Empty tables give no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskstream.llm import storage
from riskstream.llm.textarrays import ALPHANUMERIC, LOWER, Chunk, chunks, hashes, words

TOP = 10
BLOCK_DOCS = 2048
#: Owners by the share of documents that hold a term: up to this share, and one owner for all others.
OWNER_SHARES = (1 / 256, 1 / 32, 1 / 8)
#: Text and number of the items searched at once; their terms are broadcast.
BATCH_BYTES, BATCH_ITEMS = 16 << 20, 4096
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER_TEXT = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_BUNDLES = "block long, item int, place array<int>, score array<long>"


class Vocabulary:
    """The terms asked for, found by hash and confirmed by their bytes."""

    def __init__(self, terms: list[str]):
        encoded = [term.encode() for term in terms]
        self.data = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        self.end = np.cumsum([len(e) for e in encoded], dtype=np.int64)
        self.start = self.end - np.array([len(e) for e in encoded], dtype=np.int64)
        self.hash = hashes(self.data, self.start, self.end)
        self.order = np.argsort(self.hash, kind="stable")

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which spans of ``data`` are terms, and which terms."""
        at = np.searchsorted(self.hash, value := hashes(data, start, end), sorter=self.order)
        term = self.order[np.minimum(at, len(self.order) - 1)]
        near = np.flatnonzero((self.hash[term] == value) & (end - start == (self.end - self.start)[term]))
        term, size = term[near], (end - start)[near]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        differs = data[np.repeat(start[near], size) + inside] != self.data[np.repeat(self.start[term], size) + inside]
        wrong = np.zeros(len(near), dtype=bool)
        wrong[np.repeat(np.arange(len(near)), size)[differs]] = True
        return near[~wrong], term[~wrong]


def _counted(chunk: Chunk, vocabulary: Vocabulary):
    """Words per row, and of each row its terms with their counts, as bounds, terms and counts."""
    chunk = Chunk(chunk.first, LOWER[chunk.data], chunk.offsets)
    found = words(chunk, ALPHANUMERIC)
    near, term = vocabulary.find(chunk.data, found.start, found.end)
    width = len(vocabulary.order)
    pair, count = np.unique(found.rows[near] * width + term, return_counts=True)
    bounds = np.searchsorted(pair, np.arange(chunk.rows + 1) * width)
    return found.counts, bounds, pair % width, count


def _document_terms(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """number, doc_id, n, terms, counts for every row; ``number`` counts rows within a partition."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                n, bounds, terms, counts = _counted(chunk, shared.value)
                bounds = pa.array(bounds, pa.int32())
                rows = [column.slice(chunk.first, chunk.rows) for column in batch.columns[:2]]
                lists = [pa.ListArray.from_arrays(bounds, pa.array(v, pa.int32())) for v in (terms, counts)]
                yield pa.RecordBatch.from_arrays(
                    [*rows, pa.array(n, pa.int64()), *lists], names=["number", "doc_id", "n", "terms", "counts"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = docs.select(F.monotonically_increasing_id().alias("number"), "doc_id", "text")
    schema = f"number long, doc_id {kind}, n long, terms array<int>, counts array<int>"
    return storage.texts(numbered).mapInArrow(run, schema)


@dataclass
class Leg:
    """What bundles meet at one owner. Lists by item; ``least`` is the score that its tenth document has so far."""

    terms: list[np.ndarray]
    weights: list[np.ndarray]
    before: list[int]  # the most that this owner and all later ones can add
    after: list[int]  # the most that later ones can add
    least: list[int]
    last: bool


def _gathered(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and bounds of a list column."""
    column = column.combine_chunks()
    bounds = np.zeros(len(column) + 1, dtype=np.int64)
    np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False), out=bounds[1:])
    return column.flatten().to_numpy(zero_copy_only=False), bounds


def _visit(leg: Leg, bundles: pa.Table, postings: pa.Table, top: int):
    """item, places, scores of every bundle that leaves the owner in this block."""
    term = postings.column("term").to_numpy()
    order = np.argsort(term, kind="stable")
    term, place = term[order], postings.column("place").to_numpy()[order]
    value = postings.column("value").to_numpy()[order]
    known = np.unique(term)
    first, last = np.searchsorted(term, known), np.searchsorted(term, known, side="right")
    places, bounds = _gathered(bundles.column("place"))
    scores, _ = _gathered(bundles.column("score"))
    held = {item: slice(bounds[k], bounds[k + 1]) for k, item in enumerate(bundles.column("item").to_pylist())}
    total, touched = np.zeros(BLOCK_DOCS, dtype=np.int64), np.zeros(BLOCK_DOCS, dtype=bool)
    for item in range(len(leg.terms)):
        mine, opens = held.get(item), leg.before[item] >= leg.least[item]
        if mine is None and not opens:
            continue
        here = np.searchsorted(known, leg.terms[item])
        here = np.minimum(here, len(known) - 1) if len(known) else here[:0]
        some = np.flatnonzero(known[here] == leg.terms[item]) if len(known) else here
        if mine is None and not len(some):
            continue
        total[:], touched[:] = 0, False
        if mine is not None:
            total[places[mine]] = scores[mine]
            touched[places[mine]] = True
        for k in some:
            part = slice(first[here[k]], last[here[k]])
            total[place[part]] += leg.weights[item][k] * value[part]
            if opens:
                touched[place[part]] = True
        kept = np.flatnonzero(touched & (total > 0))
        least = leg.least[item]
        if len(kept) > top:
            least = max(least, int(np.partition(total[kept], len(kept) - top)[len(kept) - top]))
        kept = kept[total[kept] + leg.after[item] >= least]
        if len(kept):
            yield item, kept, total[kept]


def _stage(bundles: DataFrame, postings: DataFrame, leg: Leg, top: int) -> DataFrame:
    """Bundles after one owner; after the last one, the best documents of each item and block."""
    spark = bundles.sparkSession
    shared = spark.sparkContext.broadcast(leg)
    if leg.last:
        schema = f"item int, doc_id {postings.schema['doc_id'].dataType.simpleString()}, number long, score long"
    else:
        schema = _BUNDLES

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        leg, block = shared.value, key[0].as_py()
        listed = right.filter(pc.greater_equal(right.column("term"), 0))
        found = list(_visit(leg, left, listed, top))
        if not leg.last:
            sizes = [len(place) for _, place, _ in found]
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            flat = [np.concatenate([x[i] for x in found] or [np.zeros(0, dtype=np.int64)]) for i in (1, 2)]
            return pa.Table.from_arrays(
                [
                    pa.array([block] * len(found), pa.int64()),
                    pa.array([item for item, _, _ in found], pa.int32()),
                    pa.ListArray.from_arrays(bounds, pa.array(flat[0], pa.int32())),
                    pa.ListArray.from_arrays(bounds, pa.array(flat[1], pa.int64())),
                ],
                names=["block", "item", "place", "score"],
            )
        directory = right.filter(pc.less(right.column("term"), 0)).sort_by("place")
        row_of = np.full(BLOCK_DOCS, -1)
        row_of[directory.column("place").to_numpy()] = np.arange(directory.num_rows)
        ids = directory.column("doc_id").combine_chunks()
        parts = []
        for item, place, score in found:
            rows = pa.table(
                {
                    "item": pa.array([item] * len(place), pa.int32()),
                    "doc_id": ids.take(pa.array(row_of[place])),
                    "number": pa.array(place + block * BLOCK_DOCS, pa.int64()),
                    "score": pa.array(score, pa.int64()),
                }
            )
            best = pc.sort_indices(
                rows, [("score", "descending"), ("doc_id", "ascending"), ("number", "ascending")], null_placement="at_end"
            )
            parts.append(rows.take(best[:top]))
        if not parts:
            none = {"item": pa.int32(), "doc_id": ids.type, "number": pa.int64(), "score": pa.int64()}
            return pa.schema(list(none.items())).empty_table()
        return pa.concat_tables(parts)

    return bundles.groupBy("block").cogroup(postings.groupBy("block")).applyInArrow(run, schema)


def _tenth_best(bundles: DataFrame, n_items: int, top: int) -> list[int]:
    """Of each item the score of its ``top``-th document so far, 1 if it has fewer."""
    best = bundles.select("item", F.explode(F.slice(F.sort_array("score", asc=False), 1, top)).alias("score"))
    order = Window.partitionBy("item").orderBy(F.desc("score"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    least = [1] * n_items
    for row in ranked.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).collect():
        if row.n == top:
            least[row.item] = max(1, row.least)
    return least


def _search(docs: DataFrame, items: list[tuple], item_kind: str, top: int) -> DataFrame | None:
    """item_id, doc_id, score, number: the best documents of a batch of (item_id, texts)."""
    spark = docs.sparkSession
    asked = [Counter(t for text in texts for t in _TERM.findall(text.translate(_LOWER_TEXT))) for _, texts in items]
    terms = sorted(set().union(*asked))
    if not terms:
        return None
    folder = storage.new_folder(spark, "search")
    _document_terms(docs, Vocabulary(terms)).write.parquet(f"{folder}/terms")
    table = spark.read.parquet(f"{folder}/terms")
    whole = table.filter("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
    if not whole.docs:
        storage.remove(spark, folder)
        return None
    listed = table.select("number", "doc_id", "n", F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    length = f"(25 + (75 * n * {whole.docs}L) div {whole.words}L)"
    value = F.expr(f"(1000000000L * t.counts) div (1000L * t.counts + 8 * {length})")
    listed = listed.select("number", "doc_id", F.col("t.terms").alias("term"), value.alias("value"))
    stats = listed.groupBy("term").agg(F.count("*").alias("docs"), F.max("value").alias("most")).collect()
    weight, most, owner = {}, {}, {}
    for row in stats:  # one row per term of the batch
        weight[row.term] = math.floor(1000 * math.log((2 * whole.docs + 2) / (2 * row.docs + 1)))
        most[row.term] = row.most
        owner[row.term] = sum(row.docs > share * whole.docs for share in OWNER_SHARES)
    place = {term: k for k, term in enumerate(terms)}
    plans = []
    for counter in asked:
        mine = sorted((place[t], n) for t, n in counter.items() if weight.get(place[t], 0) > 0)
        plans.append([[(t, n * weight[t]) for t, n in mine if owner[t] == k] for k in range(len(OWNER_SHARES) + 1)])
    bound = [[sum(w * most[t] for t, w in part) for part in plan] for plan in plans]
    owned = spark.createDataFrame([(t, k) for t, k in owner.items()], "term int, owner int")
    at = [
        F.shiftright("number", BLOCK_DOCS.bit_length() - 1).alias("block"),
        F.col("number").bitwiseAND(F.lit(BLOCK_DOCS - 1)).cast("int").alias("place"),
    ]
    none = F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id")
    bundles, least, found = spark.createDataFrame([], _BUNDLES), [1] * len(items), None
    for k in range(len(OWNER_SHARES) + 1):
        last = k == len(OWNER_SHARES)
        # at most one row for each term of the batch
        own = F.broadcast(owned.filter(F.col("owner") == k).select("term"))
        postings = listed.join(own, "term").select(*at, "term", "value", none)
        if last:
            nothing = [F.lit(-1).alias("term"), F.lit(0).cast("long").alias("value")]
            directory = table.filter("n > 0").select(*at, *nothing, "doc_id")
            postings = postings.unionByName(directory)
        leg = Leg(
            [np.array([t for t, _ in plan[k]], dtype=np.int64) for plan in plans],
            [np.array([w for _, w in plan[k]], dtype=np.int64) for plan in plans],
            [sum(b[k:]) for b in bound],
            [sum(b[k + 1 :]) for b in bound],
            least,
            last,
        )
        moved = _stage(bundles, postings, leg, top)
        if last:
            found = storage.cut(moved)
        else:
            moved.write.parquet(f"{folder}/bundles-{k}")
            bundles = spark.read.parquet(f"{folder}/bundles-{k}")
            least = _tenth_best(bundles, len(items), top)
            if k:
                storage.remove(spark, f"{folder}/bundles-{k - 1}")
    storage.remove(spark, folder)
    names = spark.createDataFrame([(k, item) for k, (item, _) in enumerate(items)], f"item int, item_id {item_kind}")
    return found.join(F.broadcast(names), "item").drop("item")  # at most BATCH_ITEMS names


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of each item."""
    kind = items.schema["item_id"].dataType.simpleString()
    asked = items.select("item_id", "text").filter(F.col("text").isNotNull()).distinct()
    size = asked.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).first()
    parts = max(1, -(-(size.bytes or 0) // BATCH_BYTES), -(-size.n // BATCH_ITEMS))
    result = None
    for part in range(parts):
        chosen = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        texts: dict = {}
        for row in chosen.toLocalIterator():  # about BATCH_BYTES
            texts.setdefault(row.item_id, []).append(row.text)
        found = _search(docs, sorted(texts.items(), key=lambda x: (x[0] is None, x[0])), kind, top)
        if found is not None:
            result = found if result is None else result.unionByName(found)
    if result is None:
        result = docs.sparkSession.createDataFrame(
            [], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, number long, score long, item_id {kind}"
        )
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "number")
    ranked = result.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
