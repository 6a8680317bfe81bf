"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A document is its lower-case words, weighted by how often they occur. For each of ``samples`` draws
every word has two gamma variables and a uniform one, functions of the word alone; with its weight
they give a value, and the smallest value over the words of a text is the sample. Two texts have
the same sample with a probability equal to their generalised Jaccard similarity (sum of the smaller
over the sum of the larger weights), so the share of equal samples estimates it.

The next document comes from a window. Rows are dealt to groups of neighbouring ids, split at
bounds taken from a sample of the ids, and the first row of each group is repeated at the end of the group
before it, so that texts are shuffled once and everything else happens where they land.

Defined results: a null text is empty; texts without a word have a fingerprint of their own, alike
among themselves and unlike any other. Rows without an id come last. Rows that share an id are
ordered by the hash of their text and share a group; repeated rows follow one another and are each other's next, one row
out for each row in. A single row is its own next. An empty table gives no rows. Texts are
read whole, whatever their length; a text's words are sorted inside its row. Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

#: Draws of a fingerprint: the likeness of two texts errs by at most 0.09 as a standard deviation.
SAMPLES = 32
#: Rows of a group of neighbours, and the most groups: bounds are part of the plan.
GROUP_ROWS, MAX_GROUPS = 256, 1 << 16
#: Ids looked at for each bound.
IDS_PER_GROUP = 16
#: Draws of a row.
BLOCK = 4
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bounds(docs: DataFrame, group_rows: int) -> list:
    """Ids, descending, that part the rows into groups of about ``group_rows``; at most ``MAX_GROUPS``."""
    ids = docs.filter(F.col("doc_id").isNotNull()).select("doc_id")
    groups = min(MAX_GROUPS, ids.count() // group_rows)
    if groups < 2:
        return []
    share = min(1.0, groups * IDS_PER_GROUP / max(ids.count(), 1))
    looked = ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()
    found = looked.orderBy(F.desc("doc_id")).toArrow().column(0).to_pylist()  # groups * IDS_PER_GROUP or so
    step = max(1, len(found) // groups)
    return found[step::step]


def _place(doc_id: Column, bounds: list, kind) -> Column:
    """How many bounds lie above an id; rows without an id stand behind all others.

    The bounds are searched in two levels, so that a row looks at few of them.
    """
    if not bounds:
        return F.when(doc_id.isNull(), 1).otherwise(0)
    width = max(1, math.isqrt(len(bounds)))
    blocks = [bounds[k : k + width] for k in range(0, len(bounds), width)]
    schema = ArrayType(ArrayType(kind)).simpleString()
    nested = F.from_json(F.lit(json.dumps(blocks, default=str)), schema)
    heads = F.transform(nested, lambda block: block[0])
    block = F.size(F.filter(heads, lambda head: head >= doc_id))
    inside = F.when(block > 0, F.size(F.filter(F.get(nested, block - 1), lambda bound: bound >= doc_id))).otherwise(0)
    return F.when(doc_id.isNull(), len(bounds) + 1).otherwise(F.greatest(block - 1, F.lit(0)) * width + inside)


def with_next(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """place, at, ghost, doc_id, text, next_text: every row with the text of the next lower id, and copies marked ``ghost``.

    The result is partitioned by ``place``; ``at`` counts its rows in order.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType
    place = _place(F.col("doc_id"), _bounds(docs, group_rows), kind)
    firsts = docs.select("doc_id", place.alias("place")).groupBy("place").agg(F.max("doc_id").alias("doc_id"))
    firsts = sorted(firsts.collect(), key=lambda row: row.place)  # one id for each of at most MAX_GROUPS + 1 groups
    before = [(row.doc_id, firsts[k - 1].place) for k, row in enumerate(firsts)]
    lead = docs.sparkSession.createDataFrame(before, f"first {kind.simpleString()}, before int")
    joined = rows.join(F.broadcast(lead), F.col("doc_id").eqNullSafe(F.col("first")), "left")
    own = F.struct(place.alias("place"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.col("before").alias("place"), F.lit(True).alias("ghost"))
    dealt = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, ghost))
    spread = joined.select("doc_id", "text", F.explode(dealt).alias("to")).select("to.*", "doc_id", "text")
    order = Window.partitionBy("place").orderBy("ghost", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    return spread.withColumn("next_text", F.lead("text").over(order)).withColumn(
        "at", F.monotonically_increasing_id()
    )


def _word_ids(text: Column, bit: int) -> Column:
    """The hash of every word, with its lowest bit set to ``bit``."""
    parts = F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), BETWEEN_WORDS), "")
    return F.transform(parts, lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2)).bitwiseOR(F.lit(bit)))


def _weights(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, word, own, other: each word of ``text`` or ``edited`` with its count in both, null for none.

    A row without any word in either text has one row without a word.
    """
    ids = F.concat(_word_ids(F.col("text"), 0), _word_ids(F.col("edited"), 1))
    listed = rows.select(*keys, F.explode_outer(ids).alias("id"))
    odd = F.col("id").bitwiseAND(F.lit(1))
    counted = listed.groupBy(*keys, F.col("id").bitwiseAND(F.lit(-2)).alias("word")).agg(
        F.sum(1 - odd).alias("own"), F.sum(odd).alias("other")
    )
    return counted.withColumns({name: F.when(F.col(name) > 0, F.col(name)) for name in ("own", "other")})


def _uniform(bits: Column) -> Column:
    """A value of 32 bits as a number strictly between 0 and 1."""
    return (bits + F.lit(0.5)) * F.lit(2.0**-32)


def _low(value: Column) -> Column:
    return value.bitwiseAND(F.lit(0xFFFFFFFF))


def _gamma(bits: str) -> Column:
    """A gamma variable of shape two: the sum of two exponential ones."""
    return -F.ln(_uniform(_low(F.col(bits))) * _uniform(F.shiftrightunsigned(bits, 32)))


def _smallest(words: DataFrame, keys: list[str], samples: int) -> DataFrame:
    """keys, samples, edited_samples: hashes of the smallest value of each draw over the words of both texts.

    Draws are made ``BLOCK`` at a time, a block a row: code for all of them in one row would be too
    long for the JVM to compile.
    """
    blocks = F.array(*[F.lit(k) for k in range(-(-samples // BLOCK))])
    rows = words.withColumns({"own": F.ln("own"), "other": F.ln("other")}).withColumn("block", F.explode(blocks))
    every, kept = range(BLOCK), [*keys, "block", "own", "other"]
    rows = rows.select(*kept, *[F.xxhash64("word", "block", F.lit(k)).alias(f"x{k}") for k in every])
    rows = rows.withColumns({f"y{k}": F.xxhash64(f"x{k}") for k in every})
    rows = rows.select(
        *kept,
        *[_gamma(f"x{k}").alias(f"r{k}") for k in every],
        *[F.ln(_gamma(f"y{k}")).alias(f"c{k}") for k in every],
        *[_uniform(_low(F.xxhash64(f"y{k}"))).alias(f"b{k}") for k in every],
    )

    def value(weight: str, k: int) -> Column:
        r, c, b = F.col(f"r{k}"), F.col(f"c{k}"), F.col(f"b{k}")
        return c - r * (F.floor(F.col(weight) / r + b) - b + 1)

    least = [F.min(value(text, k)).alias(f"{text}_{k}") for text in ("own", "other") for k in every]

    def taken(text: str) -> Column:
        return F.array(*[F.xxhash64(F.coalesce(f"{text}_{k}", F.lit(float("inf")))) for k in every])  # no word: infinity

    drawn = rows.groupBy(*keys, "block").agg(*least)
    drawn = drawn.select(*keys, F.struct("block", taken("own").alias("own"), taken("other").alias("other")).alias("part"))
    parts = drawn.groupBy(*keys).agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return parts.select(
        *keys,
        F.slice(F.flatten("parts.own"), 1, samples).alias("samples"),
        F.slice(F.flatten("parts.other"), 1, samples).alias("edited_samples"),
    )


def fingerprints(docs: DataFrame, samples: int = SAMPLES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, samples, edited_samples, next_samples for every row.

    The edited text has the last third of a text's characters replaced by as many from the start of
    the next document, or all it has.
    """
    rows = with_next(docs, group_rows)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    start = F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), start)
    keys = ["place", "at", "ghost", "doc_id", "n_chars", "edited_sha256"]
    rows = rows.select("place", "at", "ghost", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    signed = _smallest(_weights(rows, keys), keys, samples)
    order = Window.partitionBy("place").orderBy("at")
    followed = signed.withColumn("next_samples", F.lead("samples").over(order))
    return followed.filter(~F.col("ghost")).drop("place", "at", "ghost")


def likeness(a: str, b: str) -> Column:
    """The share of equal samples."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x)
    return equal / F.size(a)


def text_of(samples: str) -> Column:
    """The samples as hexadecimal digits, eight each."""
    return F.array_join(F.transform(samples, lambda x: F.lpad(F.hex(_low(x)), 8, "0")), "")
