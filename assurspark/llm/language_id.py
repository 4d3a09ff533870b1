"""Language identification: sparse multinomial logistic regression.

Features are TF-IDF weights of character 1- to 3-grams, hashed to a fixed number
of columns.  Document frequencies are counted over all training documents; the
weights are trained with follow-the-regularised-leader and elastic-net
penalties on a bounded sample; probabilities are calibrated by a temperature
fitted on a part of the sample that the weights have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import id_remainder, ship, table

DIM = 1 << 14
#: Training documents per language that the weights are fitted on, about (by id hash).
FIT_DOCS = 500
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.02, 0.05
CALIBRATION_SHARE = 0.25
UNKNOWN = "und"

_BMP = np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)


def _codes(text: str) -> tuple[np.ndarray, bool]:
    """Code points of the lower-cased text, other characters than letters as
    one blank, two blanks at the end; whether there is a letter."""
    c = np.frombuffer((text.lower() + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _BMP[np.minimum(c, 0xFFFF)]
    high = c > 0xFFFF
    if high.any():
        letter = letter | (high & np.array([chr(x).isalpha() for x in c]))
    return np.where(letter, c, 32).astype(np.uint32), bool(letter.any())


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray, bool]:
    """Hashed columns and counts of the 1- to 3-grams of a whole text."""
    c, letters = _codes(text or "")
    n = len(c) - 2
    if not letters or not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), False
    shift = np.uint32(32 - 14)
    with np.errstate(over="ignore"):
        a, b, d = c[:n], c[1:n + 1], c[2:n + 2]
        one = (a * np.uint32(2654435761)) >> shift
        two = ((a * np.uint32(2246822519)) ^ (b * np.uint32(3266489917) + np.uint32(374761393))) * np.uint32(668265263) >> shift
        three = ((a * np.uint32(374761393)) ^ (b * np.uint32(2654435761)) ^ (d * np.uint32(2246822519) + np.uint32(97))) \
            * np.uint32(3266489917) >> shift
    count = np.bincount(one, minlength=DIM)
    count += np.bincount(two, minlength=DIM)
    count += np.bincount(three, minlength=DIM)
    at = np.flatnonzero(count)
    return at, count[at], True


def tf_idf(at: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1.0 + np.log(count)) * idf[at]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = EPOCHS,
               seed: int = 3) -> np.ndarray:
    """FTRL-proximal weights (DIM, classes) with L1 and L2 penalties."""
    z, n = np.zeros((DIM, classes)), np.zeros((DIM, classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, x = rows[k]
            zk, nk = z[at], n[at]
            w = weights(zk, nk)
            p = _softmax(x @ w)
            p[y[k]] -= 1.0
            g = x[:, None] * p[None, :]
            z[at] = zk + g - (np.sqrt(nk + g * g) - np.sqrt(nk)) / ALPHA * w
            n[at] = nk + g * g
    return weights(z, n)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the lowest log loss (golden section on its logarithm)."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        # one pseudo-row pulls the temperature to 1, or a faultless sample would send it to 0
        p = _softmax(logits / np.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).sum() + t * t)

    a, b, r = np.log(0.01), np.log(100.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many documents hold each hashed gram, and how many documents there are."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                at, _, _ = gram_counts(text.as_py())
                total[at] += 1
                n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], ["gram", "n"])

    rows = docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(DIM, np.int64)  # at most DIM + 1 rows come back
    known = rows[rows["gram"] >= 0]
    df[known["gram"].to_numpy()] = known["n"].to_numpy()
    return df, int(rows.loc[rows["gram"] < 0, "n"].sum())


def fit_languages(docs: DataFrame, fit_docs: int = FIT_DOCS) -> dict:
    """Model learned from text and non-null lang of (doc_id, text, lang)."""
    rows = docs.where(F.col("lang").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return {"langs": [], "w": np.zeros((DIM, 0)), "idf": np.ones(DIM), "t": 1.0}
    df, n = document_frequencies(docs)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    # about fit_docs of each language: an id hash below a cut that follows the language's size
    grid = 1 << 24
    cuts = docs.sparkSession.createDataFrame(
        [(k, int(min(grid, np.ceil(grid * fit_docs / v)))) for k, v in counts.items()], "lang string, below long")
    draw = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(grid))
    sample = (rows.join(F.broadcast(cuts), "lang").where(draw < F.col("below"))  # one row per language
              .select(F.xxhash64("doc_id", "text").alias("key"), "text", "lang"))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((k, t or "", g) for b in batches for k, t, g in zip(
            b.column("key").to_pylist(), b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True))
        grams = [gram_counts(t) for _, t, _ in got]
        known = [i for i, g in enumerate(grams) if g[2]]
        x = [(grams[i][0], tf_idf(grams[i][0], grams[i][1], idf)) for i in known]
        y = np.array([langs.index(got[i][2]) for i in known], int)
        held = np.array([(got[i][0] >> 7) % 1000 < 1000 * CALIBRATION_SHARE for i in known], bool)
        if held.all() or len(set(y[~held])) < len(set(y)):
            held[:] = False
        w = train_ftrl([r for r, h in zip(x, held, strict=True) if not h], y[~held], len(langs))
        asked = held if held.any() else ~held
        logits = np.array([r[1] @ w[r[0]] for r, h in zip(x, asked, strict=True) if h]).reshape(-1, len(langs))
        at = np.flatnonzero(np.abs(w).sum(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)),
             pa.array([*w[at].tolist(), [fit_temperature(logits, y[asked])]], pa.list_(pa.float64()))], ["gram", "w"])

    fitted = sample.repartition(1).mapInArrow(train, "gram long, w array<double>").collect()  # at most DIM + 1 rows
    w = np.zeros((DIM, len(langs)))
    t = 1.0
    for r in fitted:
        if r["gram"] < 0:
            t = r["w"][0]
        else:
            w[r["gram"]] = r["w"]
    return {"langs": langs, "w": w, "idf": idf, "t": t}


def predict_languages(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",), column: str = "text") -> DataFrame:
    """The columns ``keep`` with lang_pred and score of every whole text (of ``column``).

    A null text or one without a letter is ``und`` with score 0; repeated rows
    get the same result; other columns are not read.  With no language to learn
    from, everything is ``und``.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DIM x languages

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, w, idf, t = (sent.value[k] for k in ("langs", "w", "idf", "t"))
        for batch in batches:
            pred, score = [], []
            for text in batch.column(column):
                at, count, letters = gram_counts(text.as_py())
                if not letters or not langs:
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                p = _softmax(tf_idf(at, count, idf) @ w[at] / t)
                best = int(p.argmax())
                pred.append(langs[best])
                score.append(float(p[best]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                [*keep, "lang_pred", "score"])

    plain = docs.select(*keep, column) if column not in keep else docs.select(*keep)
    kinds = {f.name: f.dataType.simpleString() for f in plain.schema}
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keep], "lang_pred string", "score double"])
    return plain.mapInArrow(rows, schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    model = fit_languages(docs.where(~held_out).select("doc_id", "text", "lang"))
    return predict_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
