"""Removal of repeated passages, found level by level: what repeats at one length is extended to a greater one.

1. Runs of half a window are hashed, and of all runs that start within half a window only the least is kept (so
   two equal windows keep the same run, and a scan yields a fraction of its words). Runs that occur in
   two documents go on.
2. Around each of them the windows of twice the length are candidates. Those between two such runs form a
   block, the stretch of text they cover. Where a block repeats, the document with the smallest id owns it;
   all windows of its other copies are removed at once.
3. The windows of owned blocks, one copy of each block, meet one by one; those that also start in a
   document with a smaller id are removed. As every block's smallest owner takes part, none is missed.

Longer passages are unions of such windows, so no further level changes what is covered. Hashes meet in a
partial aggregation (smallest and largest id per hash) and one join with its result, so a passage shared by
many documents adds rows in proportion to its copies, and windows only once.

Defined results: a null or wordless text has no words; a text shorter than a window loses nothing. Rows
without an id lose nothing and take nothing from others. Rows that share an id are one document and take
nothing from each other; each row, repeated or not, gives one result. Texts are read whole, whatever their
length. An empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm import storage
from riskstream.llm.textarrays import (
    WHITE_SPACE,
    Chunk,
    Words,
    chunks,
    hashes,
    inverse,
    mix,
    powers,
    runs,
    window_minimum,
    words,
)

WINDOW = 50
_KEY = ["doc_id", "version"]
_BASE, _OTHER_BASE = 0xD6E8FEB86659FD93, 0xA24BAED4963EE407


def _keyed(docs: DataFrame) -> DataFrame:
    return storage.texts(docs).select("doc_id", F.xxhash64("text").alias("version"), "text")


def sampled_runs(word_hashes: np.ndarray, row_first: np.ndarray, length: int, window: int) -> tuple:
    """Hashes and places of runs of ``length`` words that are the least of some window's runs."""
    n = len(word_hashes)
    if n < window:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    span = window - length + 1
    value = runs(word_hashes, length)
    least = window_minimum(value, span)
    room = np.repeat(row_first[1:], np.diff(row_first)) - np.arange(n)
    least[room[: len(least)] < window] = 0
    around = np.zeros(len(value) + span - 1, dtype=np.uint64)
    around[span - 1 : span - 1 + len(least)] = least
    greatest = ~window_minimum(~around, span)
    at = np.flatnonzero((value == greatest) & (value > 0))
    return value[at], at


def _first_level(window: int):
    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                found = words(chunk, WHITE_SPACE)
                value, at = sampled_runs(
                    hashes(chunk.data, found.start, found.end), found.row_first, window // 2, window
                )
                row = np.searchsorted(found.row_first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value.view(np.int64)),
                        batch.column(0).take(pa.array(row + chunk.first)),
                        pa.array((at - found.row_first[row]).astype(np.int32)),
                    ],
                    names=["run", "doc_id", "at"],
                )

    return run


def _marked(column: pa.Array, rows: slice) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column's rows and the row of each."""
    part = column.slice(rows.start, rows.stop - rows.start)
    lengths = np.array(part.value_lengths().fill_null(0))
    return np.array(part.flatten()), np.repeat(np.arange(len(part)), lengths)


def _sums(word_hashes: np.ndarray, base: int) -> np.ndarray:
    total = np.zeros(len(word_hashes) + 1, dtype=np.uint64)
    np.cumsum(word_hashes * powers(base, len(word_hashes)), out=total[1:])
    return total


def stretch_hashes(word_hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Hashes of 64 and 32 bits of the words from ``start`` to ``end``."""
    found = []
    for base in (_BASE, _OTHER_BASE):
        total, back = _sums(word_hashes, base), powers(inverse(base), len(word_hashes) + 1)
        found.append(mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64)))
    return pa.array(found[0].view(np.int64)), pa.array((found[1] >> np.uint64(32)).astype(np.uint32).view(np.int32))


def _located(batch: pa.RecordBatch, chunk: Chunk, found: Words, start: np.ndarray, end: np.ndarray, n: np.ndarray):
    """Rows of (run, check, doc_id, version, start, n) for stretches of a chunk."""
    row = np.searchsorted(found.row_first, start, side="right") - 1
    take = pa.array(row + chunk.first)
    run, check = stretch_hashes(hashes(chunk.data, found.start, found.end), start, end)
    place = pa.array((start - found.row_first[row]).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [run, check, batch.column(0).take(take), batch.column(1).take(take), place, pa.array(n.astype(np.int32))],
        names=["run", "check", *_KEY, "start", "n"],
    )


def _blocks(window: int):
    half = window // 2

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                found = words(chunk, WHITE_SPACE)
                at, row = _marked(batch.column(3), slice(chunk.first, chunk.first + chunk.rows))
                at = at + found.row_first[row]
                # places of another text under the same id are no more than hints, and may lie outside
                fits = (at < found.row_first[row + 1]) & (found.counts[row] >= window)
                at, row = at[fits], row[fits]
                first, last = found.row_first[row], found.row_first[row + 1] - window
                change = np.zeros(len(found) + window + 1, dtype=np.int64)
                np.add.at(change, np.minimum(np.maximum(at - (window - half), first), last), 1)
                np.add.at(change, np.minimum(at, last) + 1, -1)
                start = np.flatnonzero(np.cumsum(change) > 0)
                anchor = np.zeros(len(found) + 1, dtype=bool)
                anchor[at] = True
                opens = anchor[start]
                opens[:1] = True
                opens[1:] |= start[1:] != start[:-1] + 1
                n = np.diff(np.append(np.flatnonzero(opens), len(start)))
                yield _located(batch, chunk, found, start[opens], start[opens] + n + window - 1, n)

    return run


def _windows(window: int):
    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                found = words(chunk, WHITE_SPACE)
                part = slice(chunk.first, chunk.first + chunk.rows)
                at, row = _marked(batch.column(3), part)
                n, _ = _marked(batch.column(4), part)
                begin = np.repeat(found.row_first[row] + at, n)
                start = np.unique(begin + np.arange(len(begin)) - np.repeat(np.cumsum(n) - n, n))
                yield _located(batch, chunk, found, start, start + window, np.ones(len(start)))

    return run


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, spans: (version of the text, start, n) of windows that also start in a document with a smaller id."""
    scanned = _keyed(docs).filter(F.col("doc_id").isNotNull())
    return _repeated(scanned, scanned.repartition("doc_id"), window)


def _repeated(scanned: DataFrame, dealt: DataFrame, window: int) -> DataFrame:
    if window < 2 or window % 2:
        raise ValueError("the window must be an even number of words")
    kind = scanned.schema["doc_id"].dataType.simpleString()
    located = f"run long, check int, doc_id {kind}, version long, start int, n int"
    ids = [F.min("doc_id").alias("least"), F.max("doc_id").alias("most")]
    level = scanned.mapInArrow(
        _first_level(window), f"run long, doc_id {kind}, at int"
    )
    shared = level.groupBy("run").agg(*ids).filter("least < most").select("run")
    survivors = level.join(shared, "run", "left_semi").groupBy("doc_id").agg(F.collect_set("at").alias("ats"))
    blocks = dealt.join(survivors, "doc_id").select(*_KEY, "text", "ats").mapInArrow(_blocks(window), located)
    # every block has its smallest owner; one that does not repeat owns itself
    owners = blocks.groupBy("run", "check").agg(*ids).filter("least < most").select("run", "check", "least")
    owned = blocks.join(owners, ["run", "check"], "left").select(*_KEY, "start", "n", "least")
    copies = owned.filter(F.col("least") < F.col("doc_id")).select(*_KEY, "start", "n")
    own = owned.filter(F.col("least").isNull() | (F.col("least") == F.col("doc_id")))
    windows = _with_spans(dealt, _by_document(own), "inner").select(*_KEY, "text", "starts", "ns")
    windows = windows.mapInArrow(_windows(window), located)
    firsts = windows.groupBy("run", "check").agg(*ids).filter("least < most").select("run", "check", "least")
    later = windows.join(firsts, ["run", "check"]).filter(F.col("doc_id") > F.col("least")).select(*_KEY, "start", "n")
    return _by_document(copies.unionByName(later))


def _by_document(spans: DataFrame) -> DataFrame:
    """doc_id, spans: of all texts under the id, told apart by version."""
    return spans.groupBy("doc_id").agg(F.collect_set(F.struct("version", "start", "n")).alias("spans"))


def _with_spans(dealt: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """``dealt`` with ``starts`` and ``ns`` of each text's own spans, joined on the id it is dealt by."""
    own = F.filter("spans", lambda span: span["version"] == F.col("version"))
    return dealt.join(spans, "doc_id", how).withColumn("spans", own).withColumns(
        {"starts": F.col("spans.start"), "ns": F.col("spans.n")}
    )


def keep_mask(n_words: int, start: np.ndarray, n: np.ndarray, window: int) -> np.ndarray:
    """Which words no removed window covers."""
    change = np.zeros(n_words + window + 1, dtype=np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + n - 1 + window, -1)
    return np.cumsum(change)[:n_words] == 0


def _kept(window: int, with_text: bool):
    def run(batches):
        for batch in batches:
            n_words, n_removed, digests, texts = [], [], [], []
            for text, starts, ns in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                parts = (text.as_py() or "").encode().split()  # bytes split at ASCII white space only
                n_words.append(len(parts))
                if starts.is_valid and len(starts):
                    mask = keep_mask(len(parts), np.array(starts.values), np.array(ns.values), window)
                    parts = [parts[k] for k in np.flatnonzero(mask).tolist()]
                n_removed.append(n_words[-1] - len(parts))
                body = b" ".join(parts)
                digests.append(hashlib.sha256(body).hexdigest())
                if with_text:
                    texts.append(body.decode())
            columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            columns += [pa.array(texts, pa.string())] if with_text else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else [])],
            )

    return run


def dedup(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and ``kept_text``) of every row."""
    keyed = _keyed(docs)
    scanned = keyed.filter(F.col("doc_id").isNotNull())
    # The joins below all read this one exchange: the filter above is what an inner join would add to its own.
    dealt = scanned.repartition("doc_id")
    spans = _repeated(scanned, dealt, window)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = ", kept_text string" if with_text else ""
    columns = ["doc_id", "text", "starts", "ns"]
    judged = _with_spans(dealt, spans, "left")
    none = F.lit(None).cast("array<int>")
    nameless = keyed.filter(F.col("doc_id").isNull()).withColumns({"starts": none, "ns": none})
    return (
        judged.select(*columns)
        .unionByName(nameless.select(*columns))
        .mapInArrow(_kept(window, with_text), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string{text}")
    )
