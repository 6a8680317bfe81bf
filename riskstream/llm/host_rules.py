"""Quality rules per document and per host, in DataFrame functions alone.

Each document is measured and judged by its own rules. Failures are then counted per host, each
host's rate is shrunk towards the mean of all hosts with a beta prior fitted to them by moments, and
a host whose shrunk rate of any rule passes ``max_rate`` takes all its documents with it.

The measures are computed once and kept in the shared folder; counting is a partial aggregation, so a
host with most of the documents sends one row per task. The join back moves no texts.

Defined results: a null or wordless text has no words, fails and is not kept. A document without a
host is judged by its own rules and counts for none. Repeated rows are judged one by one. Ties at a
bound are kept. Texts are read whole, whatever their length. An empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.storage import cut

#: The largest shrunk rate of failing documents that a host may have.
MAX_RATE = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 30
MAX_DUPLICATE_LINE_PERCENT = 50
RUN = 3
#: Bounds of the prior's weight in documents: what moments give when hosts hardly differ is unbounded.
PRIOR_WEIGHT = (2.0, 10_000.0)

_SPACES = r"[\x20\x09-\x0D]+"
RULES = ("short", "repetitive", "symbols", "duplicate_lines")


def _repeat_words(docs: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words in runs of three that occur twice or more in the text."""
    n = F.size("words")
    runs = F.when(
        n >= RUN,
        F.transform(
            F.sequence(F.lit(0), n - RUN), lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(RUN)))
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    docs = docs.withColumn("runs", runs)
    # most texts repeat nothing, and only the others are sorted
    placed = F.when(
        F.size(F.array_distinct("runs")) < F.size("runs"),
        F.sort_array(F.transform("runs", lambda value, i: F.struct(value.alias("run"), i.alias("at")))),
    ).otherwise(F.array().cast("array<struct<run:bigint,at:int>>"))
    docs = docs.withColumn("placed", placed)
    twice = F.filter(
        "placed",
        lambda x, i: (x["run"] == F.get("placed", i - 1)["run"]) | (x["run"] == F.get("placed", i + 1)["run"]),
    )
    docs = docs.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["at"])))
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda done, at: F.struct(
            (done["n"] + at + RUN - F.greatest(at, done["end"])).alias("n"), (at + RUN).alias("end")
        ),
        lambda done: done["n"],
    )
    return docs.withColumn("n_repeat_words", covered).drop("runs", "placed", "starts")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, host and the measures of every row."""
    docs = docs.select("doc_id", F.col("source").alias("host"), F.coalesce("text", F.lit("")).alias("body"))
    docs = docs.withColumn("words", F.array_remove(F.split("body", _SPACES), ""))
    lines = F.filter(F.split("body", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.withColumn("lines", lines)
    docs = docs.withColumn("n_symbols", F.length(F.regexp_replace("body", r"[^#*$%&|<>]+", "")).cast("long"))
    docs = docs.withColumn("n_lines", F.size("lines").cast("long"))
    docs = docs.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    docs = docs.withColumn("n_words", F.size("words").cast("long"))
    docs = docs.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
    return _repeat_words(docs.drop("body", "lines")).drop("words")


def failures() -> dict[str, Column]:
    n_words, word_chars = F.col("n_words"), F.col("word_chars")
    return {
        "short": n_words < MIN_WORDS,
        "repetitive": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n_words,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * word_chars,
        "duplicate_lines": 100 * F.col("n_dup_lines") > MAX_DUPLICATE_LINE_PERCENT * F.col("n_lines"),
    }


def host_rates(judged: DataFrame) -> DataFrame:
    """host, n_docs and the shrunk failure rate of each rule, ``rate_<rule>``."""
    hosts = cut(
        judged.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n_docs"), *(F.count_if(rule).alias(rule) for rule in RULES))
    )
    share = {rule: F.col(rule) / F.col("n_docs") for rule in RULES}
    moments = hosts.agg(
        F.avg(1 / F.col("n_docs")).alias("unit"),
        *(F.avg(share[rule]).alias(f"mean_{rule}") for rule in RULES),
        *(F.coalesce(F.var_samp(share[rule]), F.lit(0.0)).alias(f"var_{rule}") for rule in RULES),
    ).first()  # one row of numbers
    rates = []
    for rule in RULES:
        mean, spread = moments[f"mean_{rule}"] or 0.0, moments[f"var_{rule}"] or 0.0
        within = mean * (1 - mean)
        beyond = spread - within * (moments["unit"] or 0.0)  # what chance alone does not explain
        least, most = PRIOR_WEIGHT
        weight = min(max(within / beyond - 1, least), most) if beyond > 0 else most
        rates.append(((F.col(rule) + mean * weight) / (F.col("n_docs") + weight)).alias(f"rate_{rule}"))
    return hosts.select("host", "n_docs", *rates)


def judge(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """The measures of every row, ``base_failed``, ``host_failed`` and ``kept``."""
    judged = cut(measures(docs).withColumns(failures()))
    rates = host_rates(judged)
    bad = rates.filter(F.greatest(*(F.col(f"rate_{rule}") for rule in RULES)) > max_rate).select(
        "host", F.lit(True).alias("host_failed")
    )
    joined = judged.join(bad, "host", "left")
    own = F.col("short") | F.col("repetitive")
    return joined.select(
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        own.alias("base_failed"),
        F.coalesce("host_failed", F.lit(False)).alias("host_failed"),
        (~own & F.col("host_failed").isNull()).alias("kept"),
    )
