"""Quality rules by host: failure rates of each host, shrunk to all hosts, judge its documents.

Each rule has a limit, and a document that breaks one goes, wherever it is. Beyond that,
each rule's failures are added up by host. The rates of all hosts give a beta prior by
their mean and variance; a host's rate is shrunk to it, so a host with few documents is
near the mean. How far a host's shrunk rate is above the mean says how strict its verdict
is: a host with twice the failures of the others has half the room in that rule, down to
the rule's soft limit. A host at or below the mean holds its documents to the limit itself.

Counting runs in one pass over whole texts. Only (host, counts) rows are shuffled,
after map-side sums, so a host with a third of all rows is no hot group. Null texts
have no words; null hosts are one host; equal rows get equal verdicts; other columns,
also ones with the names used here, do not matter. An empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import ASCII_SPACE, map_batches, same, words_of
from ledgerspark.sources.scratch import stable

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 10
    dup_line_percent: int = 30
    soft_min_words: int = 80
    soft_repeat_percent: int = 30
    soft_symbol_percent: int = 5
    soft_dup_line_percent: int = 10
    max_strength: float = 1000.0


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that are found twice or more."""
    if len(words) < 4:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    if len(codes) < 1 << 20:
        window = (ids[:-2] << 40) | (ids[1:-1] << 20) | ids[2:]
    else:  # too many words to pack three of them
        pair = np.unique((ids[:-1] << 32) | ids[1:], return_inverse=True)[1]
        window = (pair[:-1] << 31) | ids[2:]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    equal = ranked[1:] == ranked[:-1]
    if not equal.any():
        return 0
    found = np.zeros(len(window), bool)
    found[order[1:][equal]] = True
    found[order[:-1][equal]] = True
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + len(found)] |= found
    return int(covered.sum())


def text_counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    text = text or ""
    words = words_of(text)
    lines = [line for line in text.split("\n") if line.strip(ASCII_SPACE)]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in ASCII_SPACE),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
    )


def count_texts(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the counts of the whole text of each row."""
    schema = T.StructType([docs.schema[k] for k in keys] + [T.StructField(c, T.LongType()) for c in COUNTS])

    def work(batch: pa.RecordBatch):
        found = [text_counts(t) for t in batch.column(len(keys)).to_pylist()]
        yield {k: batch.column(i) for i, k in enumerate(keys)} | {
            c: pa.array([f[i] for f in found], pa.int64()) for i, c in enumerate(COUNTS)}

    return map_batches(docs.select(*keys, "text"), work, schema)


RULES = ("short", "repeats", "symbols", "lines")


def broken(limits: Limits, strict: dict | None = None) -> dict:
    """For each rule whether a document breaks it; ``strict`` (1 or more) narrows the room towards the soft limit."""
    room = {name: F.lit(1.0) if strict is None else strict[name] for name in RULES}
    n = F.col("n_words")
    least = F.least(limits.min_words * room["short"], F.lit(float(limits.soft_min_words)))

    def above(count: str, of, percent: int, soft: int, name: str):
        return 100 * F.col(count) > F.greatest(percent / room[name], F.lit(float(soft))) * of

    return {
        "short": n < least,
        "repeats": above("n_repeat_words", n, limits.repeat_percent, limits.soft_repeat_percent, "repeats"),
        "symbols": above("n_symbols", F.col("word_chars"), limits.symbol_percent, limits.soft_symbol_percent, "symbols"),
        "lines": above("n_dup_lines", F.col("n_lines"), limits.dup_line_percent, limits.soft_dup_line_percent, "lines"),
    }


def base_failed(limits: Limits):
    rules = broken(limits)
    return rules["short"] | rules["repeats"]


def host_verdicts(counted: DataFrame, host: str, limits: Limits = Limits()) -> DataFrame:
    """(host, n, and for each rule its shrunk failure rate and how strict the host's verdict is).

    ``counted`` has the host column and the counts. The prior is two numbers a rule.
    """
    hosts = counted.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(rule.cast("long")).alias(f"{name}_failed") for name, rule in broken(limits).items()],
    )
    rate = {name: F.col(f"{name}_failed") / F.col("n") for name in RULES}
    prior = hosts.agg(
        *[F.avg(r).alias(f"{name}_mean") for name, r in rate.items()],
        *[F.var_samp(r).alias(f"{name}_var") for name, r in rate.items()],
    ).first().asDict()
    shrunk = hosts
    for name in RULES:
        mean, var = prior[f"{name}_mean"], prior[f"{name}_var"]
        mean = 0.0 if mean is None else float(mean)
        spread = limits.max_strength if not var else mean * (1 - mean) / float(var) - 1
        strength = min(max(spread, 1.0), limits.max_strength)
        rate = (F.col(f"{name}_failed") + mean * strength) / (F.col("n") + strength)
        # six places, so that hosts at the mean are not above it by an error of the last bit
        strict = F.greatest(F.round(rate / mean, 6), F.lit(1.0)) if mean else F.lit(1.0)
        shrunk = shrunk.withColumn(f"{name}_rate", rate).withColumn(f"{name}_strict", strict)
    return shrunk.drop(*[f"{name}_failed" for name in RULES])


def judge(counted: DataFrame, verdicts: DataFrame, host: str, limits: Limits = Limits()) -> DataFrame:
    """``counted`` with base_failed and kept; a join on the host, which Spark splits where it is hot."""
    joined = counted.alias("c").join(verdicts.alias("v"), same(F.col(f"c.{host}"), F.col("v.host")), "left")
    rules = broken(limits, {name: F.coalesce(F.col(f"v.{name}_strict"), F.lit(1.0)) for name in RULES})
    caught = rules["short"] | rules["repeats"] | rules["symbols"] | rules["lines"]
    return joined.select("c.*", base_failed(limits).alias("base_failed"), (~caught).alias("kept"))


def quality_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept. Texts are read once."""
    counted = stable(count_texts(docs, ["doc_id", "source"]))
    judged = judge(counted, host_verdicts(counted, "source", limits), "source", limits)
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")


def filter_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Rows of ``docs`` that are kept, all columns. Texts are counted twice and never shuffled for it
    unless the table of hosts, whose size is known as it is written down, is too large to broadcast."""
    verdicts = stable(host_verdicts(stable(count_texts(docs, ["source"])), "source", limits))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       docs["source"].alias("source"), docs["text"].alias("text"))
    judged = judge(count_texts(rows, ["row", "source"]), verdicts, "source", limits)
    return judged.where("kept").select("row.*")
