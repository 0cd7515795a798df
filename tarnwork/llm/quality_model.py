"""Quality classifier by positive-unlabelled learning.

Trusted positives (labelled quality 1) and unlabelled texts give a linear model that minimises the
non-negative unbiased risk  prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))  with the logistic loss.
The class prior is estimated from a first model's scores: the smallest upper bound, over score
thresholds, on (share of unlabelled above) / (share of positives above). Features come from the text alone:
byte class shares, word and line counts, repeated words and lines, hashed shares of byte pairs.

Training rows: about MAX_POSITIVE and MAX_UNLABELLED, twice that at most, chosen by a fixed hash of id and text, whatever
the size of the tables and however many rows share an id. The shares of unlabelled texts for the prior are of all rows that are not held out, counted per
threshold in one aggregate. Rows held out (crc32 of the id mod 3 is 1) are never used. All rows are scored.

Defined cases: a null text is empty and is scored as an empty text; a null doc_id is held out as no
label can be tied to it; a label of an unknown id, or null, is ignored; an id labelled twice counts once if any label is 1;
without a positive or an unlabelled text every score is 0.5; repeated rows each get their own score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text_stats as S
from .common import bounded_sample, bounded_share

MAX_POSITIVE, MAX_UNLABELLED = 8_000, 16_000
PAIRS = 64
SEED = 11
TIE = 1e-9  # scores this far below a threshold reach it: equal texts count alike, however their sums were rounded


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "utf-8")), F.lit(3)) == 1, F.lit(True))


def features(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of floats per text."""
    c = S.text_counts(buf, offs)
    hist = c["hist"].astype(np.float64)
    size = np.maximum(np.diff(offs), 1)[:, None]
    words = np.maximum(c["n_words"], 1)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    # pairs of neighbouring byte classes, hashed; a pair across texts counts for neither
    cls = S.CLASSES[buf]
    pair = (cls[:-1] * 31 + cls[1:] * 17) % PAIRS
    inside = doc[:-1] == doc[1:]
    pairs = np.bincount(doc[:-1][inside] * PAIRS + pair[inside], minlength=(len(offs) - 1) * PAIRS).reshape(-1, PAIRS)
    letters = np.maximum(hist[:, S.LOWER] + hist[:, S.UPPER] + hist[:, S.LEAD], 1)
    extra = np.stack(
        [
            np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / np.maximum(c["word_chars"], 1), c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
            c["n_repeat_words"] / words, c["n_distinct"] / words, hist[:, S.UPPER] / letters, c["n_words"] / np.maximum(c["n_lines"], 1) / 100, np.log1p(c["n_lines"]),
            hist[:, S.MARK["|"]] / words, (c["n_words"] < 20).astype(float), (c["n_words"] == 0).astype(float),
        ],
        axis=1,
    )
    return np.concatenate([np.sqrt(hist / size), np.sqrt(pairs / size), extra], axis=1)


def prior_thresholds(positive: np.ndarray) -> np.ndarray:
    """Ascending."""
    return np.quantile(positive, np.linspace(0.02, 0.9, 45))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Upper bound on the share of positives among unlabelled scores, at its best threshold."""
    return prior_of_counts(positive, np.array([(unlabelled >= c).sum() for c in prior_thresholds(positive)]), len(unlabelled))


def prior_of_counts(positive: np.ndarray, above: np.ndarray, n: int) -> float:
    """As class_prior, from how many of n unlabelled scores reach each threshold."""
    p = np.array([(positive >= c).mean() for c in prior_thresholds(positive)])
    u = above / n
    slack = np.sqrt(np.log(4 / 0.1) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(n))
    ratio = u / np.maximum(p, 1e-9)
    best = np.argmin((u + slack) / np.maximum(p, 1e-9))
    return float(np.clip(ratio[best], 0.02, 0.98))


class LinearModel:
    def __init__(self, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, b: float, prior: float):
        self.mean, self.scale, self.w, self.b, self.prior = mean, scale, w, b, prior

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.w + self.b

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _mean_gradient(x: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Of weights and bias, from the loss's derivative e at each row."""
    return np.append(x.T @ e, e.sum()) / len(x)


def nn_risk(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative risk of weights and bias w on rows p and u, and the direction whose reverse is stepped in.

    Where the negatives' part is below zero the unbiased estimate overfits: the step raises that part alone.
    """
    zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
    positives, negatives = prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    g_negatives = _mean_gradient(u, _sigmoid(zu)) - prior * _mean_gradient(p, _sigmoid(zp))
    if negatives < 0:
        return positives, -g_negatives
    return positives + negatives, prior * _mean_gradient(p, _sigmoid(zp) - 1) + g_negatives


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, *, counted=None, epochs: int = 200, rate: float = 0.03, decay: float = 1e-3) -> LinearModel:
    """Minimise the non-negative risk by Adam on all rows. prior None: estimated from a model fitted to tell P from U.

    counted(model, thresholds) gives how many unlabelled rows reach each threshold, and their number; None: of `unlabelled`.
    """
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-6
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))

    def adam(grad_of):
        w = np.zeros(p.shape[1] + 1)
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, epochs + 1):
            g = grad_of(w)
            g[:-1] += decay * w[:-1]
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return w

    if prior is None:
        w = adam(lambda w: 0.5 * _mean_gradient(p, _sigmoid(p @ w[:-1] + w[-1]) - 1) + 0.5 * _mean_gradient(u, _sigmoid(u @ w[:-1] + w[-1])))
        raw = p @ w[:-1] + w[-1]
        if counted is None:
            prior = class_prior(raw, u @ w[:-1] + w[-1])
        else:
            prior = prior_of_counts(raw, *counted(LinearModel(mean, scale, w[:-1], float(w[-1]), 0.5), prior_thresholds(raw)))

    w = adam(lambda w: nn_risk(w, p, u, prior)[1])
    return LinearModel(mean, scale, w[:-1], float(w[-1]), prior)


def train(docs: DataFrame, labels: DataFrame, text: str = "text") -> LinearModel | None:
    usable = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    chosen = F.broadcast(bounded_sample(usable, "doc_id", MAX_POSITIVE))  # ids, at most twice the parameter
    rows = docs.select("doc_id", F.col(f"`{text}`").alias("t")).where(~held_out(F.col("doc_id")))
    p = _vectors(rows.join(chosen, "doc_id", "left_semi"), MAX_POSITIVE)
    u = _vectors(rows, MAX_UNLABELLED)
    return fit(p, u, counted=lambda model, cuts: _reached(docs, text, model, cuts)) if len(p) and len(u) else None


def _vectors(rows: DataFrame, bound: int) -> np.ndarray:
    """Features of about `bound` of the rows (doc_id, t), twice that at most: rows are chosen, not ids, so repeated ids stay within the bound."""
    some = rows.where(bounded_share(rows, bound, "doc_id", "t"))
    made = S.map_texts(some, "t", lambda b, o: [_flat(features(b, o))], [T.StructField("x", T.ArrayType(T.FloatType()))], [])
    return np.array(sorted(r["x"] for r in made.limit(2 * bound).collect()), np.float64)


def _reached(docs: DataFrame, text: str, model: LinearModel, cuts: np.ndarray) -> tuple[np.ndarray, int]:
    """How many rows of docs that are not held out score at least each of the ascending cuts, and the number of those rows."""

    def make(buf, offs):
        return [np.searchsorted(cuts - TIE, model.raw(features(buf, offs).astype(np.float32).astype(np.float64)), "right").astype(np.int64)]

    rows = docs.where(~held_out(F.col("doc_id"))).select(F.col(f"`{text}`").alias("t"))
    made = S.map_texts(rows, "t", make, [T.StructField("reached", T.LongType())], []).groupBy("reached").agg(F.count("*").alias("n")).collect()
    tally = np.zeros(len(cuts) + 1, np.int64)
    for r in made:
        tally[r["reached"]] = r["n"]
    return tally[::-1].cumsum()[::-1][1:], int(tally.sum())


def _flat(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x.astype(np.float32).reshape(-1), np.arange(len(x) + 1) * x.shape[1]


def score_quality(docs: DataFrame, labels: DataFrame, text: str = "text", model: LinearModel | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; one narrow pass over whole texts."""
    model = model or train(docs, labels, text)

    def make(buf, offs):
        n = len(offs) - 1
        return [np.full(n, 0.5) if model is None else model.score(features(buf, offs))]

    scored = S.map_texts(docs, text, make, [T.StructField("score", T.DoubleType())], ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
