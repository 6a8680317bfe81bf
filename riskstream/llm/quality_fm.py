"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a text: its words hashed into buckets, weighted by count and scaled to unit length; statistics
of its structure, each in steps (one feature per statistic and step); and the step of the table's own
``n_chars``. Pairwise interactions are low-rank, and a row is scored in time linear in its features, as
half of the squared sum less the sum of squares per factor.

The machine is fitted in the driver on at most ``sample_rows`` labelled training rows, those with the
smallest hash of their id; all rows are scored in numpy on the executors.

Defined results: null counts as the empty text, which is scored by its statistics alone. A null
``n_chars`` is a step of its own. Labels for absent documents, and null labels, are not used; a document with
several labels counts once for each, and rows of the same id, text and ``n_chars`` count as one in training. Without any label every score is 0.5. Repeated rows are scored one by
one. A score at the threshold is predicted 1. Texts are read whole, whatever their length. An empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm import sampling, storage
from riskstream.llm.language_id import split
from riskstream.llm.textarrays import ALPHANUMERIC, LOWER, Chunk, chunks, hashes, shingles, words

WORD_BITS = 15
FACTORS = 8
STEPS = 24
SAMPLE_ROWS = 8000
THRESHOLD = 0.3

_LINE = np.ones(256, dtype=bool)
_LINE[0x0A] = False
_CLASSES = {
    "symbol": np.isin(np.arange(256), list(b"#*$%&|<>")),
    "exclamation": np.isin(np.arange(256), list(b"!?")),
    "stop": np.isin(np.arange(256), list(b".,;:")),
    "digit": np.isin(np.arange(256), list(b"0123456789")),
    "upper": (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A),
    "space": np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)]),
}
STATISTICS = (*_CLASSES, "words", "word_length", "distinct", "fresh_runs", "fresh_lines", "line_words", "n_chars")
N_FEATURES = (1 << WORD_BITS) + len(STATISTICS) * STEPS


def _row_sums(member: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(member) + 1, dtype=np.int64)
    np.cumsum(member, out=total[1:])
    return np.diff(total[offsets])


def _share_steps(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Steps of a share between 0 and 1, finer near 0."""
    share = part / np.maximum(whole, 1)
    return np.minimum((np.sqrt(share) * STEPS).astype(np.int64), STEPS - 1)


def _size_steps(size: np.ndarray) -> np.ndarray:
    return np.minimum((np.log2(1 + np.maximum(size, 0)) * 1.25).astype(np.int64), STEPS - 2)


def features(chunk: Chunk, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row bounds, feature indexes and values. A negative ``n_chars`` stands for null."""
    low = LOWER[chunk.data]
    found = words(Chunk(0, low, chunk.offsets), ALPHANUMERIC)
    value = hashes(low, found.start, found.end)
    count = found.counts
    bucket = (value >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key, times = np.unique((found.rows.astype(np.int64) << WORD_BITS) | bucket, return_counts=True)
    row, bucket = key >> WORD_BITS, key & ((1 << WORD_BITS) - 1)
    norm = np.sqrt(np.bincount(row, weights=times.astype(float) ** 2, minlength=chunk.rows))
    weight = times / norm[row]
    size = np.diff(chunk.offsets)
    steps = {name: _share_steps(_row_sums(member[chunk.data], chunk.offsets), size) for name, member in _CLASSES.items()}
    letters = _row_sums(ALPHANUMERIC[low], chunk.offsets)
    runs, run_bounds = shingles(value, found.row_first, 3)
    line = words(chunk, _LINE)
    _, line_bounds = shingles(hashes(chunk.data, line.start, line.end), line.row_first, 1)
    steps["words"] = _size_steps(count)
    steps["word_length"] = np.minimum(letters // np.maximum(count, 1), STEPS - 1)
    steps["distinct"] = _share_steps(np.bincount(row, minlength=chunk.rows), count)
    steps["fresh_runs"] = _share_steps(np.diff(run_bounds), np.maximum(count - 2, 1))
    steps["fresh_lines"] = _share_steps(np.diff(line_bounds), line.counts)
    steps["line_words"] = _size_steps(count // np.maximum(line.counts, 1))
    steps["n_chars"] = np.where(n_chars < 0, STEPS - 1, _size_steps(n_chars))
    base = (1 << WORD_BITS) + STEPS * np.arange(len(STATISTICS))
    own = np.stack([steps[name] for name in STATISTICS], axis=1) + base
    all_rows = np.concatenate([row, np.repeat(np.arange(chunk.rows), len(STATISTICS))])
    index = np.concatenate([bucket, own.reshape(-1)])
    values = np.concatenate([weight, np.ones(own.size)])
    order = np.argsort(all_rows, kind="stable")
    bounds = np.searchsorted(all_rows[order], np.arange(chunk.rows + 1))
    return bounds, index[order], values[order]


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, bounds: np.ndarray, index: np.ndarray, value: np.ndarray):
        """Scores before the logistic function, and the factor sums of each row; no row may be empty."""
        weighted = self.factors[index] * value[:, None]
        total = np.add.reduceat(weighted, bounds[:-1], axis=0)
        squares = np.add.reduceat(weighted**2, bounds[:-1], axis=0)
        plain = np.add.reduceat(self.linear[index] * value, bounds[:-1])
        return self.bias + plain + 0.5 * (total**2 - squares).sum(axis=1), total


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(
    bounds: np.ndarray,
    index: np.ndarray,
    value: np.ndarray,
    label: np.ndarray,
    epochs: int = 8,
    batch_rows: int = 200,
    rate: float = 0.1,
    decay: float = 1e-4,
    seed: int = 7,
) -> Machine:
    """Mini-batch descent on the logistic loss with a rate per weight that follows its past gradients."""
    random = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(N_FEATURES), random.normal(0, 0.02, (N_FEATURES, FACTORS)))
    if not len(label):
        return Machine(0.0, machine.linear, np.zeros_like(machine.factors))
    seen_linear, seen_factors, seen_bias = np.full(N_FEATURES, 1e-6), np.full((N_FEATURES, FACTORS), 1e-6), 1e-6
    length = np.diff(bounds)
    for _ in range(epochs):
        order = random.permutation(len(label))
        for low in range(0, len(order), batch_rows):
            rows = order[low : low + batch_rows]
            size = length[rows]
            edges = np.concatenate([[0], np.cumsum(size)])
            take = np.arange(edges[-1]) + np.repeat(bounds[rows] - edges[:-1], size)
            at, x = index[take], value[take]
            raw, total = machine.raw(edges, at, x)
            error = (logistic(raw) - label[rows]) / len(rows)
            per_entry = np.repeat(error, size) * x
            place = np.argsort(at, kind="stable")
            unique, first = np.unique(at[place], return_index=True)
            step = np.add.reduceat(per_entry[place], first) + decay * machine.linear[unique]
            slope = per_entry[:, None] * (np.repeat(total, size, axis=0) - machine.factors[at] * x[:, None])
            turn = np.add.reduceat(slope[place], first, axis=0) + decay * machine.factors[unique]
            seen_linear[unique] += step**2
            seen_factors[unique] += turn**2
            seen_bias += error.sum() ** 2
            machine.linear[unique] -= rate * step / np.sqrt(seen_linear[unique])
            machine.factors[unique] -= 0.3 * rate * turn / np.sqrt(seen_factors[unique])
            machine.bias -= rate * error.sum() / np.sqrt(seen_bias)
    return machine


def _n_chars(column: pa.Array) -> np.ndarray:
    return np.array(column.cast(pa.int64()).fill_null(-1))


def _featured(batches):
    for batch in batches:
        for chunk in chunks(batch.column(0)):
            rows = slice(chunk.first, chunk.first + chunk.rows)
            bounds, index, value = features(chunk, _n_chars(batch.column(1))[rows])
            edges = pa.array(bounds.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k).slice(chunk.first, chunk.rows) for k in (2, 3, 4)),
                    pa.ListArray.from_arrays(edges, pa.array(index.astype(np.int32))),
                    pa.ListArray.from_arrays(edges, pa.array(value.astype(np.float32))),
                ],
                names=["label", "place", "version", "index", "value"],
            )


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on up to ``sample_rows`` labels of training rows, over the whole texts of their documents."""
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~split(F.col("doc_id")))
    share = sampling.share_for(sample_rows, usable.count())
    chosen = (
        usable.select("doc_id", F.col("quality").cast("double").alias("label"))
        .filter(sampling.smallest_hashes("doc_id", share))  # little more than the sample is left to sort
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample_rows)
    )
    # an id may stand for many rows: keys alone are compared first, then at most sample_rows of them get their texts
    keyed = docs.select("doc_id", "text", "n_chars", F.xxhash64("text", "n_chars").alias("version"))
    keys = (
        keyed.select("doc_id", "version")
        .join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
        .distinct()
        .join(F.broadcast(chosen), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "version", "label")
        .limit(sample_rows)
    )
    sample = (
        keyed.join(F.broadcast(keys.select("doc_id", "version").distinct()), ["doc_id", "version"], "left_semi")
        .dropDuplicates(["doc_id", "version"])
        .join(F.broadcast(keys), ["doc_id", "version"])
    )
    table = (
        storage.texts(sample)
        .select("text", "n_chars", "label", F.xxhash64("doc_id").alias("place"), "version")
        .mapInArrow(_featured, "label double, place bigint, version bigint, index array<int>, value array<float>")
        .toArrow()  # at most sample_rows rows
        .sort_by([("place", "ascending"), ("version", "ascending"), ("label", "ascending")])
        .combine_chunks()
    )
    label = np.array(table.column("label"), dtype=float)
    if not len(label):
        return fit(np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0), label)
    lists = table.column("index").combine_chunks()
    bounds = np.concatenate([[0], np.cumsum(np.array(lists.value_lengths()))])
    index = np.array(lists.flatten()).astype(np.int64)
    value = np.array(table.column("value").combine_chunks().flatten()).astype(float)
    return fit(bounds, index, value, label)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(
        Machine(machine.bias, machine.linear.astype(np.float32), machine.factors.astype(np.float32))
    )

    def run(batches):
        fitted = shared.value
        for batch in batches:
            result = np.zeros(batch.num_rows)
            sizes = _n_chars(batch.column(3))
            for chunk in chunks(batch.column(2)):
                rows = slice(chunk.first, chunk.first + chunk.rows)
                result[rows] = logistic(fitted.raw(*features(chunk, sizes[rows]))[0])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(result),
                    pa.array((result >= THRESHOLD).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return storage.texts(docs).select("doc_id", split(F.col("doc_id")).alias("held_out"), "text", "n_chars").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labels and score all documents."""
    return score(docs, train(docs, labels))
