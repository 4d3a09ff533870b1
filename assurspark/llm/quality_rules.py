"""Quality rules: an isolation forest on rule statistics.

Rule statistics of every whole text (words, characters, symbols, repeated lines
and word windows) feed an isolation forest: trees of random splits, in which an
unusual document ends on a short path.  The forest is drawn from a bounded,
documented sample; its score threshold is calibrated from all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._bytes import SEP, SPACE, SYMBOL, mixed, owner, pieces, prefix_hash, span_hash, spans, word_windows
from ._shared import cut, id_remainder, table

TREES, SUBSAMPLE = 128, 256
#: Labelled rows that the forest is drawn from, at most (those with the lowest id hash).
FIT_ROWS = 6000
#: Bins of the score in which the threshold is looked for.
BINS = 1 << 12
#: Share of the labelled good rows that the threshold may turn away.
FALSE_REJECTS = 0.005
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_upper", "n_digits", "n_punct", "n_lines", "n_distinct_words", "n_bytes")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def text_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """Rule statistics per row: the counts of ``COUNTS`` and ``EXTRA``."""
    parts: dict[str, list[np.ndarray]] = {k: [] for k in COUNTS + EXTRA}
    for i, j, data, starts in pieces(column):
        n = j - i
        space = SPACE[data]
        w0, w1 = spans(~space)
        row = owner(w0, starts)
        running = prefix_hash(data)
        words = span_hash(running, w0, w1)

        def per_row(mask: np.ndarray) -> np.ndarray:
            upto = np.zeros(len(mask) + 1, np.int64)
            np.cumsum(mask, out=upto[1:])
            return np.diff(upto[starts])

        def distinct(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            with np.errstate(over="ignore"):
                keyed = mixed(keys + rows.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
            _, first, inverse, counts = np.unique(keyed, return_index=True, return_inverse=True, return_counts=True)
            return first, inverse, counts

        # lines of a row that hold a word
        ends = np.flatnonzero((data == 10) | (data == SEP))
        begins = np.concatenate([[0], ends[:-1] + 1])
        worded = np.searchsorted(w0, ends, "left") > np.searchsorted(w0, begins, "left")
        l0, l1 = begins[worded], ends[worded]
        line_row = owner(l0, starts)
        first, _, _ = distinct(span_hash(running, l0, l1), line_row)
        n_lines = np.bincount(line_row, minlength=n)
        # words in three-word windows that occur twice or more in the row
        window, at = word_windows(words, row, 3)
        _, inverse, counts = distinct(window, row[at])
        again = at[counts[inverse] > 1] if len(at) else at
        repeated = np.zeros(len(words), bool)
        for k in range(3):
            repeated[again + k] = True
        kinds, _, _ = distinct(words, row)

        parts["n_words"].append(np.bincount(row, minlength=n))
        parts["word_chars"].append(per_row(~space & ((data & 0xC0) != 0x80)))
        parts["n_symbols"].append(per_row(SYMBOL[data]))
        parts["n_dup_lines"].append(n_lines - np.bincount(line_row[first], minlength=n))
        parts["n_repeat_words"].append(np.bincount(row[repeated], minlength=n))
        parts["n_upper"].append(per_row(_UPPER[data]))
        parts["n_digits"].append(per_row(_DIGIT[data]))
        parts["n_punct"].append(per_row(_PUNCT[data]))
        parts["n_lines"].append(n_lines)
        parts["n_distinct_words"].append(np.bincount(row[kinds], minlength=n))
        parts["n_bytes"].append(np.diff(starts) - 1)
    return {k: (np.concatenate(v) if v else np.zeros(0)).astype(np.int64) for k, v in parts.items()}


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Rates that do not grow with the length of a text, one column each."""
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    lines = np.maximum(s["n_lines"], 1)
    # square roots, so that small rates are not squeezed together under a uniform split
    return np.column_stack([
        np.minimum(chars / words, 40.0),
        np.sqrt(s["n_symbols"] / chars),
        np.sqrt(s["n_dup_lines"] / lines),
        np.sqrt(s["n_repeat_words"] / words),
        np.sqrt(s["n_upper"] / chars),
        np.sqrt(s["n_digits"] / chars),
        np.sqrt(s["n_punct"] / chars),
        np.sqrt(s["n_distinct_words"] / words),
    ])


# ------------------------------------------------------------------ forest

def _path_norm(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n <= 1 else 2.0 * (np.log(n - 1.0) + 0.5772156649) - 2.0 * (n - 1.0) / n


def grow_forest(x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 5) -> dict[str, np.ndarray]:
    """Isolation trees as arrays (tree, node): feature (-1: leaf), cut, path length at a leaf.
    Node k has its children at 2k + 1 and 2k + 2."""
    rng = np.random.default_rng(seed)
    depth = max(1, int(np.ceil(np.log2(max(2, min(subsample, len(x)))))))
    size = 2 ** (depth + 1) - 1
    feature = np.full((trees, size), -1, np.int16)
    cut = np.zeros((trees, size))
    path = np.zeros((trees, size))
    for t in range(trees):
        rows = rng.choice(len(x), min(subsample, len(x)), replace=False) if len(x) else np.zeros(0, int)
        todo = [(0, rows, 0)]
        while todo:
            node, own, level = todo.pop()
            low, high = (x[own].min(0), x[own].max(0)) if len(own) else (np.zeros(0), np.zeros(0))
            usable = np.flatnonzero(high > low)
            if level >= depth or len(own) <= 1 or not len(usable):
                path[t, node] = level + _path_norm(len(own))
                continue
            f = rng.choice(usable)
            c = rng.uniform(low[f], high[f])
            feature[t, node], cut[t, node] = f, c
            left = x[own, f] < c
            todo += [(2 * node + 1, own[left], level + 1), (2 * node + 2, own[~left], level + 1)]
    return {"feature": feature, "cut": cut, "path": path, "norm": np.array([max(_path_norm(min(subsample, max(len(x), 2))), 1e-9)])}


def anomaly(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Isolation score: 2 ** -(mean path / normal path); near 1 is unusual."""
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, cut, path in zip(forest["feature"], forest["cut"], forest["path"], strict=True):
        node = np.zeros(len(x), np.int64)
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                break
            right = x[rows, np.maximum(f, 0)] >= cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)
        total += path[node]
    return 2.0 ** (-total / max(len(forest["feature"]), 1) / forest["norm"][0])


def calibrate(score: np.ndarray, good: np.ndarray, false_rejects: float = FALSE_REJECTS) -> float:
    """Score above which a row is turned away: the cut with the best balance of
    caught bad and kept good rows among those that turn away at most
    ``false_rejects`` of the good ones.  Without both labels nothing is turned away."""
    if not good.any() or good.all():
        return float("inf")
    floor = float(np.quantile(score[good], 1.0 - false_rejects, method="higher"))
    cuts = np.unique(np.concatenate([[floor], score[score >= floor]]))
    caught = (score[~good][None, :] > cuts[:, None]).mean(1)
    lost = (score[good][None, :] > cuts[:, None]).mean(1)
    best = int(np.argmax(caught - lost))
    # half way to the next higher score, so that rows like the caught ones stay out
    return float(cuts[best])


def labelled(docs: DataFrame, labels: DataFrame, column: str, rows: int, where: Column) -> DataFrame:
    """At most ``rows`` labelled documents (lowest id hash): (text, label)."""
    marks = (labels.where(F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(column).cast("int").alias("label")))
    pick = (marks.where(where).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id").select("text", "label")


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        s = text_statistics(batch.column("text"))
        x = features(s)
        yield pa.RecordBatch.from_arrays(
            [batch.column("label").cast(pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64())),
             pa.array(s["n_words"])], ["label", "x", "n_words"])


def calibrated(scored: DataFrame, false_rejects: float = FALSE_REJECTS) -> float:
    """``calibrate`` over all rows of (score, good): the same cut, found from
    the counts of every score, bin by bin."""
    per = cut(scored.groupBy("score").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).withColumn(
        "bin", F.floor(F.col("score") * BINS)), "scores")
    bins = sorted(tuple(r) for r in per.groupBy("bin").agg(F.sum("good"), F.sum("bad")).collect())
    n_good, n_bad = (sum(r[k] for r in bins) for k in (1, 2))
    if not n_good or not n_bad:
        return float("inf")
    # good rows up to the lowest cut that turns away no more than it may
    least = int(np.ceil((n_good - 1) * (1.0 - false_rejects))) + 1
    before, good, bad = [], 0, 0
    for k, g, b in bins:
        if good + g >= least:
            before.append((k, good, bad))
        good, bad = good + g, bad + b
    upto = Window.partitionBy("bin").orderBy("score")
    known = scored.sparkSession.createDataFrame(before, "bin long, good_before long, bad_before long")
    cuts = (per.join(F.broadcast(known), "bin")  # at most BINS + 1 rows
            .select("score", (F.sum("good").over(upto) + F.col("good_before")).alias("good"),
                    (F.sum("bad").over(upto) + F.col("bad_before")).alias("bad")).where(F.col("good") >= least))
    balance = F.col("good").cast("decimal(19,0)") * n_bad - F.col("bad").cast("decimal(19,0)") * n_good
    return float(cuts.orderBy(balance.desc(), "score").first()["score"])


def fit_rules(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[dict[str, np.ndarray], float]:
    """Forest from at most ``rows`` labelled rows, threshold from the scores of all
    of them (those whose crc32(doc_id as text) mod 4 is not 2, so that the others
    can test it)."""
    train = id_remainder(F.col("doc_id"), 4) != 2
    sample = labelled(docs, labels, "quality", rows, train)
    got = sample.mapInArrow(_statistics_rows, "label int, x array<double>, n_words long").where(
        F.col("n_words") >= MIN_WORDS).toPandas()
    x = np.array(got["x"].tolist(), float).reshape(len(got), 8)
    forest = grow_forest(x[np.lexsort(x.T[::-1])])
    # texts are scored where they are read; only their scores meet the labels
    model = docs.sparkSession.sparkContext.broadcast(forest)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = text_statistics(batch.column("text"))
            keep = pa.array(s["n_words"] >= MIN_WORDS)
            score = pa.array(anomaly(model.value, features(s)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").filter(keep), score.filter(keep)], ["doc_id", "score"])

    marks = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    scored = docs.where(train).select("doc_id", "text").mapInArrow(scores, "doc_id long, score double").join(marks, "doc_id")
    return forest, calibrated(scored.select("score", (F.col("label") == 1).alias("good")))


def apply_rules(docs: DataFrame, forest: dict[str, np.ndarray], threshold: float) -> DataFrame:
    """Statistics, isolation score and verdict of every row of (doc_id, text).

    Null and empty texts have zero counts and fail the base rules; repeated
    rows are scored separately and alike; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast((forest, threshold))  # trees of fixed size

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, limit = model.value
        for batch in batches:
            s = text_statistics(batch.column("text"))
            failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])
            score = anomaly(trees, features(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(s[k]) for k in COUNTS], pa.array(failed),
                 pa.array(~failed & (score <= limit)), pa.array(score)],
                ["doc_id", *COUNTS, "base_failed", "kept", "anomaly"])

    schema = f"doc_id long, {', '.join(f'{k} long' for k in COUNTS)}, base_failed boolean, kept boolean, anomaly double"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return apply_rules(docs, *fit_rules(docs, table(spark, sf_dir, "labels")))
