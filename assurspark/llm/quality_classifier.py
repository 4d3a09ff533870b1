"""Quality classifier: Bradley-Terry pairwise ranking.

A document's strength is a linear function of its text statistics.  Of two
labelled documents the one marked good should win; the weights minimise the
logistic loss of the feature differences over such pairs.  A document is
predicted good if its strength reaches a quantile of the strengths of all
labelled training documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import cut, id_remainder, ship, table
from .quality_rules import features, labelled, text_statistics

#: Labelled rows that the weights are fitted on, at most, and preference pairs drawn from them.
FIT_ROWS, PAIRS = 6000, 40_000
RIDGE = 1e-3
ACCEPT = 0.7        # score from which a document is predicted good
N_FEATURES = 17
LEVELS = 1000       # resolution of the quantiles among which the threshold is chosen


def strength_features(column: pa.Array) -> np.ndarray:
    """Rates of the rule statistics, their squares, and the length of the text."""
    s = text_statistics(column)
    x = features(s)
    x[:, 0] /= 10.0
    length = np.log1p(s["n_words"])[:, None] / 10.0
    return np.hstack([x, x * x, length])


def fit_bradley_terry(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE,
                      seed: int = 11, steps: int = 40) -> np.ndarray:
    """Weights w with P(i preferred to j) = sigmoid(w . (x_i - x_j)), by Newton's
    method on pairs of one good and one bad row.  Without both labels: zeros."""
    winners, losers = np.flatnonzero(good), np.flatnonzero(~good)
    w = np.zeros(x.shape[1])
    if not len(winners) or not len(losers):
        return w
    rng = np.random.default_rng(seed)
    d = x[rng.choice(winners, pairs)] - x[rng.choice(losers, pairs)]
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(d @ w, -40, 40)))
        grad = d.T @ (1.0 - p) / len(d) - ridge * w
        hess = (d * (p * (1.0 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def choose_threshold(bad: list[float], good: list[float], n_bad: int, n_good: int) -> float:
    """The strength that separates best, among the quantiles of both labels
    (``bad`` and ``good``: evenly spaced quantiles of either label's strengths)."""
    if not n_bad or not n_good:
        return float("-inf") if not n_bad else float("inf")
    b, g = np.sort(np.array(bad)), np.sort(np.array(good))
    cuts = np.unique(np.concatenate([b, g]))
    # bad rows at or above the cut are errors, and good rows below it
    wrong = (n_bad * (len(b) - np.searchsorted(b, cuts, "left")) / len(b)
             + n_good * np.searchsorted(g, cuts, "left") / len(g))
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    at = int(best[len(best) // 2])
    return float((cuts[at] + cuts[at - 1]) / 2 if at else cuts[at])


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted, strength) of every row of (doc_id, text).

    Labels are learned only from rows whose crc32(doc_id as text) mod 4 is not
    2.  The weights come from at most ``fit_rows`` of them; the threshold from
    the strengths of all of them.  score = sigmoid(strength - threshold +
    logit(0.7)), so 0.7 is the chosen quantile.  Null and empty texts get the
    score of zero statistics, repeated rows are scored alike, null labels are
    not used; without labels of both kinds all rows score on one side.
    """
    spark = docs.sparkSession
    ship(spark)
    train = id_remainder(F.col("doc_id"), 4) != 2

    def fit_rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = strength_features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").cast(pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64()))], ["label", "x"])

    got = labelled(docs, labels, "quality", fit_rows, train).mapInArrow(
        fit_rows_of, "label int, x array<double>").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(len(got), N_FEATURES)
    good = got["label"].to_numpy() == 1
    order = np.lexsort(x.T[::-1]) if len(x) else np.zeros(0, int)
    weights = fit_bradley_terry(x[order], good[order]) if len(x) else np.zeros(N_FEATURES)
    model = spark.sparkContext.broadcast(weights)  # N_FEATURES numbers

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(strength_features(batch.column("text")) @ model.value)],
                ["doc_id", "strength"])

    scored = cut(docs.select("doc_id", "text").mapInArrow(strengths, "doc_id long, strength double"), "strengths")
    marks = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    levels = F.array(*[F.lit(k / LEVELS) for k in range(LEVELS + 1)])
    per = {r["label"]: r for r in scored.where(train).join(marks, "doc_id").groupBy("label").agg(
        F.count("*").alias("n"), F.percentile_approx("strength", levels, F.lit(10 * LEVELS)).alias("q")).collect()}
    quantiles = [(per[k]["q"], per[k]["n"]) if k in per else ([], 0) for k in (0, 1)]
    threshold = choose_threshold(quantiles[0][0], quantiles[1][0], quantiles[0][1], quantiles[1][1])
    if not np.isfinite(threshold):
        threshold = 0.0
    logit = float(np.log(ACCEPT / (1 - ACCEPT)))
    score = 1.0 / (1.0 + F.exp(-(F.col("strength") - F.lit(threshold) + F.lit(logit))))
    return scored.select("doc_id", (~train).alias("held_out"), score.alias("score"), "strength").select(
        "doc_id", "held_out", "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"), "strength")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
