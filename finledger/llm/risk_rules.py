"""Quality rules with cutoffs chosen under a risk bound (fixed-sequence testing, exact tails).

A rule rejects texts whose statistic lies beyond a cutoff. Per stratum, good labelled documents
(held out: nothing else is fitted to them) tell how many a cutoff would reject falsely. A cutoff is
certified if so few would be unlikely (exact binomial tail) were the true rate above the limit.
Cutoffs of a rule are tested from the loosest on until one fails, which needs no correction, and
rules and strata share the error level (Bonferroni). So with probability 1 - ERROR no rule
rejects more than its share, and all rules together no more than LIMIT, of a stratum's good
documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp, lgamma, log, log1p

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.llm.common import batches, stored
from finledger.llm.textstats import RATIOS, text_statistics

LIMIT = 0.05  # share of a stratum's good documents that all rules together may reject
ERROR = 0.05  # probability that any stratum breaks its limit

# Rule: statistic, and cutoffs from the loosest to the strictest. A rule rejects above.
LADDERS: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("symbols_per_word", (4.0, 2.0, 1.0, 0.5, 0.25, 0.1, 0.05)),
    "marks": ("marks_per_word", (3.0, 2.0, 1.0, 0.5, 0.25, 0.1, 0.05)),
    "upper": ("upper_share", (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "digits": ("digit_share", (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "top_word": ("top_word_share", (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15)),
    "dup_lines": ("dup_line_share", (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1)),
}
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

CUTOFFS = pa.schema([("stratum", pa.string()), *[(r, pa.float64()) for r in LADDERS]])


def tail(n: int, k: int, rate: float) -> float:
    """P(at most k of n) for a binomial of this rate, summed exactly in logarithms."""
    if k >= n:
        return 1.0
    whole = lgamma(n + 1)
    return min(1.0, sum(
        exp(whole - lgamma(i + 1) - lgamma(n - i + 1) + i * log(rate) + (n - i) * log1p(-rate))
        for i in range(k + 1)
    ))


def least_rows(strata: int, limit: float, error: float) -> int:
    """Good labelled documents that a stratum needs before any cutoff can be certified."""
    level = error / (len(LADDERS) * max(1, strata))
    return ceil(log(level) / log1p(-limit / len(LADDERS)))


def certified(
    rejected: dict[str, list[int]], n: int, strata: int, limit: float, error: float
) -> dict[str, float | None]:
    """Per rule the strictest cutoff that holds, from counts of falsely rejected documents."""
    level, share = error / (len(LADDERS) * max(1, strata)), limit / len(LADDERS)
    out: dict[str, float | None] = {}
    for rule, (_, ladder) in LADDERS.items():
        out[rule] = None
        for cutoff, k in zip(ladder, rejected[rule], strict=True):
            if k > share * n or tail(n, k, share) > level:
                break
            out[rule] = cutoff
    return out


def base_failed(words: Column, repeated: Column) -> Column:
    return (words < MIN_WORDS) | (repeated * 100 > words * MAX_REPEAT_PERCENT)


def cutoffs(
    good: DataFrame, limit: float = LIMIT, error: float = ERROR
) -> DataFrame:
    """A row per stratum with its certified cutoff of each rule, null where none is.

    ``good`` has the good labelled documents: stratum and the rules' statistics. Strata with too
    few of them for any certificate are not tested and do not weigh on the others; which ones
    is decided by their size alone.
    """
    counts = stored(good.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.array(*[F.sum((F.col(stat) > c).cast("bigint")) for c in ladder]).alias(rule)
          for rule, (stat, ladder) in LADDERS.items()],
    ), "rule-counts")
    strata = counts.where(F.col("n") >= least_rows(1, limit, error)).count()
    large = counts.where(F.col("n") >= least_rows(strata, limit, error))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                found = certified({r: row[r] for r in LADDERS}, row["n"], strata, limit, error)
                yield from batches(
                    [{"stratum": [row["stratum"]]} | {r: [c] for r, c in found.items()}], CUTOFFS
                )

    return large.mapInArrow(run, ", ".join(
        ["stratum string", *[f"{r} double" for r in LADDERS]]
    ))


def judge_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    stratum: str = "lang", label: str = "quality", limit: float = LIMIT, error: float = ERROR,
) -> DataFrame:
    """Every document's statistics and verdict.

    Columns: the key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, and rejected_by (the rules beyond their cutoff, in alphabetical order). kept is false
    where base_failed; else it is true unless a certified rule rejects. A null or empty text has
    no words and fails the base; a null stratum is a stratum of its own; a stratum that is too
    small for a certificate has no rules; equal rows are judged alike; a document with several labels
    counts as good if one of them is 1; labels of unknown documents say nothing; an empty table
    gives no rows. Of other columns only the stratum is read.
    """
    named = docs.selectExpr(
        f"CAST(`{key}` AS BIGINT) AS key", f"`{text}` AS text",
        f"coalesce(concat('=', CAST(`{stratum}` AS STRING)), '') AS stratum",  # null is a name, too
    )
    rows = stored(text_statistics(named, "key", "text", carry="stratum"), "rule-statistics")
    rows = rows.withColumns({n: F.expr(RATIOS[n]) for n in {s for s, _ in LADDERS.values()}})
    rows = rows.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    known = labels.where(F.col(label) == 1).select(F.col(key).cast("bigint").alias("key")).distinct()
    good = rows.where(~F.col("base_failed")).join(known, "key", "left_semi")
    table = cutoffs(good, limit, error)
    judged = rows.join(table, "stratum", "left")
    beyond = F.array_compact(F.array(*[
        F.when(F.col(stat) > F.col(rule), F.lit(rule))
        for rule, (stat, _) in sorted(LADDERS.items())
    ]))
    return judged.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size(beyond) == 0)).alias("kept"), beyond.alias("rejected_by"),
    )
