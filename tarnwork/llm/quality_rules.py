"""Quality rules with risk-controlled thresholds.

Every text gets base counts and five ratios. Each ratio has a ladder of cutoffs, from lenient to strict.
Labelled texts (quality 1: good, 0: poor), each distinct text of a stratum once, are dealt into two halves by a hash of the text:
1. On the first half each ratio's strictest useful level is found per stratum: the last at which at least
   MIN_PRECISION of the rejected rows, and MIN_POOR of them, are poor. A ratio without such a level is not used there.
2. On the second half, the holdout, levels are certified: a level rejects a text if any used ratio
   exceeds its cutoff at that level (or its own strictest useful one). It is certified if the exact binomial test refutes
   "the share of good texts rejected exceeds max_false_rejection", after Bonferroni correction over all strata
   and levels. Each stratum uses its strictest certified level, or no cutoffs at all.

The certificate covers rows that pass the base rule; good rows that fail it are rejected by contract, outside the bound.

Defined cases: a null text has no words (base_failed); null is a stratum like any other; strata with fewer than
min_labelled good rows, or none, have no certificate of their own, so only the base rule rejects there; labels of unknown ids or null quality are
ignored; copies of a text count once, however many rows and labels they have, and as poor if any label says so; repeated rows each get
their own result; no labels: no cutoffs. Texts of equal 64-bit hash are taken as copies.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text_stats as S
from .common import cut

# Own choices: (ratio, most lenient cutoff, strictest cutoff). A text above a cutoff is rejected.
LADDER = (
    ("symbol_ratio", 0.60, 0.08),
    ("pipe_ratio", 0.90, 0.20),
    ("shout_ratio", 0.95, 0.50),
    ("repeat_ratio", 0.60, 0.20),
    ("dup_line_ratio", 0.90, 0.30),
)
LEVELS = 8
MIN_PRECISION, MIN_POOR = 0.75, 5
MAX_IDS = 1_000_000  # labelled ids that may be broadcast, about 40 MB
PRINT = "text_print"  # hash of a whole text
RATIOS = tuple(r for r, _, _ in LADDER)


def cutoff(lenient: float, strict: float, level: int) -> float:
    """Level 1 is the most lenient, LEVELS the strictest."""
    return lenient + (strict - lenient) * (level - 1) / (LEVELS - 1)


def _counts(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    c = S.text_counts(buf, offs)
    hist, words = c["hist"], np.maximum(c["n_words"], 1)
    letters = hist[:, S.LOWER] + hist[:, S.UPPER] + hist[:, S.LEAD]
    mark = lambda ch: hist[:, S.MARK[ch]]
    ratios = (
        (mark("#") + mark("*") + mark("$") + mark("%") + mark("&")) / np.maximum(c["word_chars"], 1),
        mark("|") / words,
        hist[:, S.UPPER] / np.maximum(letters, 1),
        c["n_repeat_words"] / words,
        c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
    )
    return [c[k] for k in S.BASE_COLUMNS] + list(ratios)


def rule_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all, if None), the base counts and the ratios of each row."""
    fields = [T.StructField(c, T.LongType()) for c in S.BASE_COLUMNS] + [T.StructField(r, T.DoubleType()) for r in RATIOS]
    return S.map_texts(docs, text, _counts, fields, docs.columns if keep is None else keep)


def base_failed():
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rejected(cutoffs: dict[str, dict[str, float]], stratum):
    """True where a ratio exceeds its stratum's cutoff. cutoffs: stratum_name -> ratio -> cutoff; other strata have none."""
    return exceeds(cutoffs, stratum_name(stratum))


def exceeds(cutoffs: dict[str, dict[str, float]], name):
    """As rejected, for a column of stratum_name."""
    out = F.lit(False)
    for ratio in RATIOS:
        pairs = [x for s, c in cutoffs.items() if ratio in c for x in (F.lit(s), F.lit(c[ratio]))]
        if pairs:
            out = out | F.coalesce(F.col(ratio) > F.try_element_at(F.create_map(*pairs), name), F.lit(False))
    return out


def stratum_name(stratum):
    """A text that tells null from every value."""
    return F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit("null"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p)."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def certify(table: list[tuple[str, int, list[int]]], max_false_rejection: float, delta: float) -> dict[str, int]:
    """table: (stratum, good rows, good rows rejected at levels 1..LEVELS). The strictest certified level, 0 for none."""
    tests = max(1, len(table) * LEVELS)
    chosen = {}
    for stratum, n, rejected in table:
        chosen[stratum] = 0
        for level, k in enumerate(rejected, 1):
            if n and binomial_tail(k, n, max_false_rejection) <= delta / tests:
                chosen[stratum] = max(chosen[stratum], level)
    return chosen


def useful_levels(poor: list[int], good: list[int]) -> int:
    """The strictest level that rejects MIN_POOR poor rows with MIN_PRECISION; 0 for none."""
    return max((k for k, (b, g) in enumerate(zip(poor, good), 1) if b >= MIN_POOR and b >= MIN_PRECISION * (b + g)), default=0)


def labelled_texts(counts: DataFrame, labels: DataFrame, stratum: str) -> DataFrame:
    """stratum, good, holdout and ratios of each distinct labelled text of a stratum that passes the base rule."""
    marked = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = counts.where(~base_failed()).select("doc_id", stratum_name(F.col(stratum)).alias("stratum"), PRINT, *RATIOS).join(marked, "doc_id")
    texts = rows.groupBy("stratum", PRINT).agg((F.min("quality") == 1).alias("good"), *[F.max(r).alias(r) for r in RATIOS])
    return texts.withColumn("holdout", F.pmod(F.xxhash64(F.lit("fold"), PRINT), F.lit(2)) == 1)


def fit_counts(docs: DataFrame, stratum: str, text: str = "text") -> DataFrame:
    """rule_counts with doc_id, the stratum and PRINT."""
    columns = list(dict.fromkeys(["doc_id", stratum]))
    printed = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").alias("\0fit"), F.xxhash64(f"`{text}`").alias(PRINT))
    return rule_counts(printed, "\0fit", [*columns, PRINT])


def fit_cutoffs(counts: DataFrame, labels: DataFrame, *, stratum: str = "lang", max_false_rejection: float = 0.05, delta: float = 0.05, min_labelled: int = 300) -> dict[str, dict[str, float]]:
    """Cutoffs per stratum (as stratum_name) and ratio. counts: rule_counts with doc_id, the stratum and PRINT.

    Strata below min_labelled get none, so the driver sees at most (good texts / min_labelled) of them.
    """
    rows = cut(labelled_texts(counts, labels, stratum))
    large = [r[0] for r in rows.where("good").groupBy("stratum").agg(F.count("*").alias("n")).where(F.col("n") >= min_labelled).collect()]
    if not large:
        return {}
    rows = rows.where(F.col("stratum").isin(large))
    ladder = [(r, k, cutoff(lenient, strict, k)) for r, lenient, strict in LADDER for k in range(1, LEVELS + 1)]
    tallies = [F.count_if((F.col("good") == g) & (F.col(r) > c)).alias(f"{r}_{k}_{g}") for r, k, c in ladder for g in (True, False)]
    caps = {}
    for row in rows.where("not holdout").groupBy("stratum").agg(*tallies).collect():
        each = {r: useful_levels(*[[row[f"{r}_{k}_{g}"] for k in range(1, LEVELS + 1)] for g in (False, True)]) for r in RATIOS}
        caps[row["stratum"]] = {r: k for r, k in each.items() if k}
    at = lambda level: {s: {r: cutoff(lenient, strict, min(level, c[r])) for r, lenient, strict in LADDER if r in c} for s, c in caps.items()}
    held = rows.where("holdout and good").groupBy("stratum").agg(F.count("*").alias("n"), *[F.count_if(exceeds(at(k), F.col("stratum"))).alias(f"k{k}") for k in range(1, LEVELS + 1)]).collect()
    chosen = certify([(r["stratum"], r["n"], [r[f"k{k}"] for k in range(1, LEVELS + 1)]) for r in held], max_false_rejection, delta)
    return {s: at(level)[s] if level and s in caps else {} for s, level in chosen.items()}


def verdict(cutoffs: dict[str, dict[str, float]], stratum: str = "lang"):
    """The column that is true where a row is kept."""
    return ~(base_failed() | rejected(cutoffs, F.col(stratum)))


def apply_rules(docs: DataFrame, labels: DataFrame, *, stratum: str = "lang", **risk) -> DataFrame:
    """One row per row of docs: doc_id, base counts, base_failed, kept and the ratios."""
    counts = cut(fit_counts(docs, stratum))
    cutoffs = fit_cutoffs(counts, labels, stratum=stratum, **risk)
    return counts.select("doc_id", *S.BASE_COLUMNS, base_failed().alias("base_failed"), verdict(cutoffs, stratum).alias("kept"), *[F.round(r, 6).alias(r) for r in RATIOS])


def keep_good(docs: DataFrame, labels: DataFrame, *, stratum: str = "lang", **risk) -> DataFrame:
    """The rows of docs that the rules keep, all columns as they were.

    Texts are never shuffled: labelled ones are counted for the fit, all for the verdict. Beyond MAX_IDS labelled ids all
    are counted for the fit too, and counts meet the labels.
    """
    ids = labels.where(F.col("quality").isin(0, 1)).select("doc_id").distinct()
    labelled = docs.join(F.broadcast(ids), "doc_id", "left_semi") if ids.count() <= MAX_IDS else docs
    cutoffs = fit_cutoffs(fit_counts(labelled, stratum), labels, stratum=stratum, **risk)
    clash = {c.lower() for c in (*S.BASE_COLUMNS, *RATIOS)}
    safe = [f"__col{i}" if c.lower() in clash else c for i, c in enumerate(docs.columns)]
    counted = rule_counts(docs.toDF(*safe))
    return counted.where(verdict(cutoffs, stratum)).select(*[F.col(f"`{s}`").alias(c) for s, c in zip(safe, docs.columns)])
