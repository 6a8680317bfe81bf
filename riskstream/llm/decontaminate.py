"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Every text is hashed in runs of ``GRAM`` words; of each ``SPAN`` consecutive runs the least hash is
kept as a fingerprint. Two texts that share ``GRAM + SPAN - 1`` words in a row therefore share the
fingerprint of that stretch. Fingerprints of the documents meet those of the benchmark in a join, and
each hit is extended to the windows of ``WINDOW`` words around it, which are compared word for word.
As ``GRAM + SPAN - 1 <= WINDOW``, no window can be missed. An item shorter than a window is one window
itself; for each such length that occurs, documents offer all their runs of that length.

The benchmark's fingerprints are broadcast in blocks of ``BLOCK`` rows, one pass over the documents
per block, so a large benchmark costs passes and not memory. Only hits leave the scan, and texts are
never shuffled.

Defined results: a null or wordless text has no words and no hits. Rows equal in ``doc_id`` and text
are one document and give one row; a null ``doc_id`` is an id like others. Items without words have no
windows; repeated items count once; an item without an id marks words but is neither counted nor
listed. Texts are read whole, whatever their length. Without documents there are no rows, without items no
hits. Columns other than those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.storage import cut

WINDOW = 10
GRAM = 5
SPAN = WINDOW - GRAM + 1
#: Fingerprints per broadcast: 16 bytes each, 32 MB in all.
BLOCK = 1 << 21
#: Windows per broadcast beside their words and item lists.
WINDOW_BLOCK = 1 << 17

_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PLACES = 64  # hashes keep their place modulo this in their low bits


def words(text: Column) -> Column:
    """The words of a text: A-Z in lower case, cut at ASCII that is no letter or digit."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )
    return F.array_remove(F.split(low, _SEPARATOR), "")


def _indexes(n: Column) -> Column:
    """0 to n - 1; empty below 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _with_fingerprints(texts: DataFrame) -> DataFrame:
    """``texts`` (with ``words``) and ``marks``: array of (at, print), the winnowed runs."""
    low_bits = F.lit(_PLACES - 1)
    n = F.size("words")
    texts = texts.withColumn("ids", F.transform("words", lambda w: F.xxhash64(w)))
    texts = texts.withColumn(
        "grams",
        F.transform(
            _indexes(n - (GRAM - 1)),
            lambda i: F.xxhash64(*(F.get("ids", i + k) for k in range(GRAM)))
            .bitwiseAND(F.lit(-_PLACES))
            .bitwiseOR(i.bitwiseAND(low_bits)),
        ),
    )
    texts = texts.withColumn(
        "least", F.transform(_indexes(F.size("grams") - (SPAN - 1)), lambda i: F.least(*(F.get("grams", i + k) for k in range(SPAN))))
    )

    def mark(value, i):
        fresh = (i == 0) | (value != F.get("least", i - 1))
        place = i + F.pmod(value.bitwiseAND(low_bits).cast("int") - i, F.lit(_PLACES))
        return F.when(fresh, F.struct(place.alias("at"), value.bitwiseAND(F.lit(-_PLACES)).alias("print")))

    return texts.withColumn("marks", F.transform("least", mark)).drop("ids", "grams", "least")


def _short_marks(length: int) -> Column:
    """All runs of ``length`` words, with the length in the hash."""
    return F.transform(
        _indexes(F.size("words") - (length - 1)),
        lambda i: F.struct(
            i.alias("at"), F.xxhash64(F.lit(length), *(F.get("words", i + k) for k in range(length))).alias("print")
        ),
    )


class Benchmark:
    """Fingerprints and windows of the benchmark items, kept in the shared folder."""

    def __init__(self, items: DataFrame):
        texts = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words"))
        texts = texts.filter(F.size("words") > 0).distinct()
        n = F.size("words")
        spans = F.transform(
            F.when(n >= WINDOW, _indexes(n - (WINDOW - 1))).otherwise(F.array(F.lit(0))),
            lambda i: F.array_join(F.slice("words", i + 1, WINDOW), " "),
        )
        windows = texts.select("item", n.alias("n"), F.explode_outer(F.array_distinct(spans)).alias("window"))
        self.windows = cut(
            windows.groupBy("window").agg(
                F.sort_array(F.collect_set("item")).alias("items"), F.min(F.least("n", F.lit(WINDOW))).alias("length")
            )
        )
        short = texts.filter(n < WINDOW)
        self.short_lengths = sorted(row.n for row in short.select(n.alias("n")).distinct().collect())  # 9 at most
        long_prints = _with_fingerprints(texts.filter(n >= WINDOW)).select(F.explode_outer("marks").alias("mark"))
        prints = long_prints.filter("mark is not null").select(F.lit(WINDOW).alias("length"), "mark.print")
        for length in self.short_lengths:
            own = short.filter(n == length).select(F.explode_outer(_short_marks(length)).alias("mark"))
            prints = prints.unionByName(own.select(F.lit(length).alias("length"), "mark.print"))
        self.prints = cut(prints.distinct())
        self.blocks = max(1, -(-self.prints.count() // BLOCK))
        self.window_blocks = max(1, -(-self.windows.count() // WINDOW_BLOCK))


def hits(docs: DataFrame, benchmark: Benchmark) -> DataFrame:
    """doc_id, version, n_words, start, length, items: a row per window found, and one without items per document."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("version"), words(F.col("text")).alias("words"))
    marked = _with_fingerprints(texts)
    offers = [_offers(F.filter("marks", lambda m: m.isNotNull()), WINDOW)]
    offers += [_offers(_short_marks(length), length) for length in benchmark.short_lengths]
    # the first entry stands for the document itself and always stays
    document = F.array(_offer(F.lit(0), F.lit(-1), F.lit(0).cast("long")))
    rows = marked.select(
        "doc_id", "version", "words", F.size("words").alias("n_words"), F.concat(document, *offers).alias("offers")
    ).select("doc_id", "version", "words", "n_words", F.inline_outer("offers"))
    found = None
    for block in range(benchmark.blocks):
        known = benchmark.prints.filter(F.pmod(F.xxhash64("print"), F.lit(benchmark.blocks)) == block)
        known = known.withColumn("hit", F.lit(True))
        part = rows.join(F.broadcast(known), ["length", "print"], "left").filter((F.col("at") < 0) | F.col("hit"))
        found = part if found is None else found.unionByName(part)
    last = F.least("at", F.col("n_words") - WINDOW)
    first = F.greatest(F.lit(0), F.col("at") - (SPAN - 1))
    starts = (
        F.when(F.col("at") < 0, F.array(F.lit(-1)))
        .when(F.col("length") < WINDOW, F.array("at"))
        .when(first <= last, F.sequence(first, last))
        .otherwise(F.array().cast("array<int>"))
    )
    candidates = found.withColumn("starts", starts).select(
        "doc_id",
        "version",
        "n_words",
        "length",
        F.inline_outer(
            F.transform(
                "starts",
                lambda s: F.struct(
                    s.alias("start"),
                    F.when(s >= 0, F.array_join(F.slice("words", s + 1, F.col("length")), " ")).alias("window"),
                ),
            )
        ),
    )
    windows = benchmark.windows.select("window", "items")
    if benchmark.window_blocks == 1:
        windows = F.broadcast(windows)
    else:  # beyond a broadcast the same windows of one document are sent once
        candidates = candidates.distinct()
    joined = candidates.join(windows, "window", "left")
    return joined.filter((F.col("start") < 0) | F.col("items").isNotNull()).drop("window")


# Arrays are unfolded with the outer variants throughout: for the inner ones the optimizer adds a filter on
# the array's size and pushes it to the scan, where the whole chain of expressions would run again per element.


def _offer(length: Column, at: Column, value: Column) -> Column:
    return F.struct(length.alias("length"), at.alias("at"), value.alias("print"))


def _offers(marks: Column, length: int) -> Column:
    return F.transform(marks, lambda mark: _offer(F.lit(length), mark["at"], mark["print"]))


def covered(spans: Column) -> Column:
    """How many words lie in sorted (start, length) spans."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda done, span: F.struct(
            (
                done["n"]
                + F.greatest(F.lit(0), span["start"] + span["length"] - F.greatest(span["start"], done["end"]))
            ).alias("n"),
            F.greatest(done["end"], span["start"] + span["length"]).alias("end"),
        ),
        lambda done: done["n"],
    )


def scan(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids), spans (array of start, length) of every document."""
    found = hits(docs, Benchmark(items))
    per_document = found.groupBy("doc_id", "version").agg(
        F.max("n_words").alias("n_words"),
        F.sort_array(
            F.collect_set(F.when(F.col("start") >= 0, F.struct("start", "length")))
        ).alias("spans"),
        F.collect_set("items").alias("items"),
    )
    return per_document.select(
        "doc_id",
        "version",
        F.col("n_words").cast("long").alias("n_words"),
        covered(F.col("spans")).alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten("items"))).alias("items"),
        "spans",
    )
