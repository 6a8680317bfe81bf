"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams per language on a bounded sample of labelled rows; the matrix of log
probabilities is broadcast and each Arrow batch is scored in numpy.

Defined results: a null text, or one without any letter, is ``und`` with score 0. A null
``doc_id`` counts as the empty text for the split. Repeated rows are scored one by one. Without any
labelled row every text is ``und``. Texts are read whole, whatever their length. An empty table gives no rows. Ties go to the language that sorts first. Columns other than
those named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.llm import sampling, storage
from riskstream.llm.textarrays import Chunk, chunks, mix

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: Ids whose rows are counted per language, those with the smallest hash.
SAMPLE_ROWS = 2000
#: Languages for which the broadcast matrix stays within 128 MB.
MAX_LANGUAGES = 512
UNDETERMINED = "und"

_CASE: list[np.ndarray] = []


def _lower(code: int) -> int:
    """The lower case of a letter, or a space for any other character."""
    if 0xD800 <= code < 0xE000 or not (letter := chr(code)).isalpha():
        return 32
    return ord(letter.lower()) if len(letter.lower()) == 1 else code


def lower_letters(codes: np.ndarray) -> np.ndarray:
    if not _CASE:
        _CASE.append(np.array([_lower(code) for code in range(0x10000)], dtype=np.uint32))
    result = _CASE[0][np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    if len(high):
        found, place = np.unique(codes[high], return_inverse=True)
        result[high] = np.array([_lower(int(code)) for code in found], dtype=np.uint32)[place]
    return result


def letters(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with other characters as spaces, and row bounds in characters."""
    lead = (chunk.data & 0xC0) != 0x80
    before = np.zeros(len(chunk.data) + 1, dtype=np.int64)
    np.cumsum(lead, out=before[1:])
    codes = np.frombuffer(chunk.data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    return lower_letters(codes), before[chunk.offsets]


def buckets(codes: np.ndarray, bounds: np.ndarray, buckets_: int = BUCKETS):
    """Per n-gram order: the bucket of each n-gram, and row bounds. Runs of spaces count as one space."""
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    kept = np.zeros(len(codes) + 1, dtype=np.int64)
    np.cumsum(keep, out=kept[1:])
    codes, bounds = codes[keep].astype(np.uint64), kept[bounds]
    shift = np.uint64(64 - int(buckets_).bit_length() + 1)
    value = np.zeros(len(codes), dtype=np.uint64)
    for order in range(1, max(ORDERS) + 1):
        if len(codes) < order:
            return
        value = value[: len(codes) - order + 1] * np.uint64(0x100000001B3) + codes[order - 1 :]
        if order in ORDERS:
            index = (mix(value + np.uint64(order)) >> shift).astype(np.int64)
            # an n-gram belongs to the row it starts in; one that crosses into the next is left out
            inside = np.ones(len(index), dtype=bool)
            for back in range(1, order):
                at = bounds[1:-1] - back
                inside[at[(at >= 0) & (at < len(index))]] = False
            count = np.zeros(len(index) + 1, dtype=np.int64)
            np.cumsum(inside, out=count[1:])
            yield index[inside], count[np.minimum(bounds, len(index))]


def _counted(batches):
    for batch in batches:
        lang = np.array(batch.column(1).to_pylist(), dtype=object)
        for name in sorted(set(lang)):
            texts, total = batch.column(0).filter(pa.array(lang == name)), np.zeros(BUCKETS, dtype=np.int64)
            for chunk in chunks(texts):
                for index, _ in buckets(*letters(chunk)):
                    total += np.bincount(index, minlength=BUCKETS)
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(found), pa.string()), pa.array(found), pa.array(total[found])],
                names=["lang", "bucket", "n"],
            )


@dataclass
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # bucket x language
    log_prior: np.ndarray


def split(doc_id: Column) -> Column:
    """True for held-out rows: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, smoothing: float = 0.5) -> LanguageModel:
    """Fit on up to ``sample_rows`` labelled training rows of each language, their whole texts."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~split(F.col("doc_id")))
    found = labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    languages = sorted(row.lang for row in found)
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # a row a language; a bound on the hash leaves little more than the sample of each before ids are ranked
    shares = docs.sparkSession.createDataFrame(
        [(row.lang, sampling.share_for(sample_rows, row.n)) for row in found], "lang string, share double"
    )
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        labelled.select("doc_id", "lang")
        .join(F.broadcast(shares), "lang")
        .filter(sampling.smallest_hashes("doc_id", F.col("share")))
        .select("doc_id", "lang")
        .distinct()
        .withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= sample_rows)
        .select("doc_id", "lang")
    )
    # at most MAX_LANGUAGES * sample_rows pairs of a number and a short name
    sample = labelled.select("text", "lang", "doc_id").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
    counted = (
        storage.texts(sample)
        .select("text", "lang")
        .mapInArrow(_counted, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    counts = np.zeros((BUCKETS, max(len(languages), 1)))
    table = counted.toArrow()  # languages x buckets at most
    place = {name: k for k, name in enumerate(languages)}
    columns = np.array([place[name] for name in table.column("lang").to_pylist()], dtype=np.int64)
    counts[table.column("bucket").to_numpy(), columns] = table.column("n").to_numpy()
    counts += smoothing
    log_probability = np.log(counts) - np.log(counts.sum(axis=0))
    prior = np.zeros(max(len(languages), 1))  # all languages alike: the sample does not show their shares
    return LanguageModel(languages, log_probability.astype(np.float32), prior - np.log(len(prior)))


def scores(chunk: Chunk, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest language and its posterior; -1 and 0 where a row has no letter."""
    codes, bounds = letters(chunk)
    total = np.repeat(model.log_prior[None, :], chunk.rows, axis=0)
    step = max(1, (1 << 22) // len(model.languages))
    for index, first in buckets(codes, bounds):
        for low in range(0, len(index), step):  # bounds the gathered block, whatever the number of languages
            part = model.log_probability[index[low : low + step]]
            edges = np.clip(first - low, 0, len(part))
            some = np.flatnonzero(np.diff(edges))
            if len(some):
                total[some] += np.add.reduceat(part, edges[some], axis=0, dtype=np.float64)
    lettered = np.zeros(len(codes) + 1, dtype=np.int64)
    np.cumsum(codes != 32, out=lettered[1:])
    has = lettered[bounds[1:]] > lettered[bounds[:-1]]
    best = total.argmax(axis=1)
    posterior = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    return np.where(has, best, -1), np.where(has, posterior, 0.0)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = shared.value
        names = np.array([*fitted.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            label, score = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            if fitted.languages:
                for chunk in chunks(batch.column(2)):
                    rows = slice(chunk.first, chunk.first + chunk.rows)
                    label[rows], score[rows] = scores(chunk, fitted)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names[label], pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return storage.texts(docs).select("doc_id", split(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is determined with at least ``min_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches):
        fitted = shared.value
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            if fitted.languages:
                for chunk in chunks(batch.column(place)):
                    label, score = scores(chunk, fitted)
                    keep[chunk.first : chunk.first + chunk.rows] = (label >= 0) & (score >= min_score)
            yield batch.filter(pa.array(keep))

    return storage.texts(docs).mapInArrow(run, docs.schema)


def identify(docs: DataFrame) -> DataFrame:
    """Train on the labelled rows of ``docs`` and predict all of them."""
    return predict(docs, train(docs))
