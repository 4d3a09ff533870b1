"""Spelling variants: words one edit apart, found by blocked Gram matrices.

A word is the vector of its letter counts.  One inserted or deleted letter gives a
squared distance of 1, one replaced letter 2, so near words are at most two
apart.  Blocks hold the words of one length with the same number of letters in each of
a few letter classes; one edit leads to the same block or to one of a few adjacent
ones (length + 1, or one letter from one class to another).  For each pair of adjacent
blocks a task takes the product of the two count matrices, which gives all squared
distances, keeps pairs at most two apart and verifies the edit on the words.

Blocks are split into tiles of about TILE words by a hash, so a task holds two tiles
whatever the size of a block.  Every pair of tiles of adjacent blocks is compared: no
pair of words is left out.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import cut, ship, table

MIN_LENGTH, MIN_COUNT, MARGIN, DROP_EVERY = 6, 5, 5, 199
TILE = 512
HELD = 200_000          # distinct words a task holds before it hands their counts on
PAIRS = 1 << 16         # near pairs handed on at once

# letters a-z and U+00C0..U+00FF
FIRST_WIDE = 0xC0
LETTERS = [chr(c) for c in (*range(97, 123), *range(FIRST_WIDE, 0x100))]
# letters by frequency, dealt to the classes in turn
_ORDER = [*"etaoinshrdlucmfwypvbgkqjxz", *LETTERS[26:]]
CLASSES = ["".join(_ORDER[k::4]) for k in range(4)]


# ------------------------------------------------------------------ words of a corpus
def _counts(min_length: int, drop_every: int):
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)  # shorter runs only get shorter

    def flush(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                raw = text.as_py()
                if not raw:
                    continue
                head = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for word, n in Counter(runs.findall(raw.encode().lower().decode())).items():  # bytes: A-Z only
                    h = zlib.crc32(word.encode(), head)
                    if h % drop_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    held[word] += n
                if len(held) >= HELD:
                    yield flush(held)
                    held = Counter()
        yield flush(held)

    return run


def corpus_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY) -> DataFrame:
    """(word, n) of (doc_id, text) rows: maximal runs of letters with A-Z as a-z, of
    at least ``min_length`` code points and ``min_count`` occurrences.  Where
    ``drop_every`` divides h = crc32 of ``<doc_id>:<run>``, the run's code point
    h % length is left out.  A null id counts as the empty text; a null text has no
    words; repeated rows count each; an empty table gives no words."""
    ship(docs.sparkSession)
    counted = docs.select("doc_id", "text").mapInArrow(_counts(min_length, drop_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ------------------------------------------------------------------ pairs one edit apart
def letter_counts(words: list[str]) -> np.ndarray:
    """A row of letter counts per word; exact in the type that is returned."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = np.where(codes < FIRST_WIDE, codes - 97, codes - FIRST_WIDE + 26)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    counts = np.bincount(row * len(LETTERS) + letter, minlength=len(words) * len(LETTERS)).reshape(len(words), -1)
    longest = max(len(w) for w in words)
    return counts.astype(np.float32 if longest < 1000 else np.float64)  # squares stay below 2^24 (2^53)


def close_pairs(a: list[str], b: list[str] | None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs at a squared distance of at most two, by one matrix product."""
    x = letter_counts(a)
    y = x if b is None else letter_counts(b)
    if x.dtype != y.dtype:
        x, y = x.astype(np.float64), y.astype(np.float64)
    gram = x @ y.T
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * gram
    i, j = np.nonzero(distance <= 2)
    if b is None:
        keep = i < j
        i, j = i[keep], j[keep]
    return i, j


def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k, n = 0, len(a)
    while k < n and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (pair, side, word, n) sorted by pair: near words, both ways round."""
    out: list[tuple[str, str, int]] = []

    def packed() -> pa.RecordBatch:
        w, v, n = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(w), pa.array(v), pa.array(n, pa.int64())], ["word", "near", "near_n"])

    def pairs() -> Iterator[list[tuple]]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[0][0] != row[0]:
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    for rows in pairs():
        sides = [[r for r in rows if r[1] == s] for s in range(3)]
        left, right = (sides[2], sides[2]) if sides[2] else (sides[0], sides[1])
        if not left or not right:
            continue
        for i, j in zip(*close_pairs([r[2] for r in left], None if sides[2] else [r[2] for r in right]), strict=True):
            a, b = left[i], right[j]
            if one_edit(a[2], b[2]):
                out += [(a[2], b[2], b[3]), (b[2], a[2], a[3])]
        if len(out) >= PAIRS:
            yield packed()
            out.clear()
    if out:
        yield packed()


def block_key(word: Column) -> Column:
    """Letters of a word in each class (their sum is its length)."""
    return F.array(*[F.length(word) - F.length(F.translate(word, c, "")) for c in CLASSES])


def steps() -> list[list[int]]:
    """From a block to the adjacent ones, each unordered pair of blocks once."""
    k = len(CLASSES)
    unit = [[int(i == j) for j in range(k)] for i in range(k)]
    return [[0] * k, *unit, *[[x - y for x, y in zip(unit[i], unit[j], strict=True)] for i, j in itertools.combinations(range(k), 2)]]


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, near, near_n) for every ordered pair of distinct words that differ by
    exactly one inserted, deleted or replaced code point.  ``words``: distinct (word,
    n) of the letters a-z and U+00C0..U+00FF; an empty table gives no pairs."""
    ship(words.sparkSession)
    keyed = words.select("word", "n", block_key(F.col("word")).alias("key"))
    blocks = keyed.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    step = F.explode(F.array(*[F.struct(F.lit(k).alias("no"), F.array(*map(F.lit, s)).alias("by")) for k, s in enumerate(steps())]))
    left = blocks.select("key", "tiles", step.alias("step")).select(
        "key", "tiles", F.col("step.no").alias("no"), F.zip_with("key", "step.by", lambda x, y: x + y).alias("other"))
    right = blocks.select(F.col("key").alias("other"), F.col("tiles").alias("other_tiles"))
    pairs = (left.join(right, "other")
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("other_tiles") - 1)))
             .where((F.col("no") > 0) | (F.col("i") <= F.col("j")))
             .withColumn("pair", F.concat_ws(",", F.col("key").cast("array<string>"), "i", "no", "j")))
    own = (F.col("no") == 0) & (F.col("i") == F.col("j"))
    part = F.explode(F.when(own, F.array(F.struct("key", F.col("i").alias("tile"), F.lit(2).alias("side"))))
                     .otherwise(F.array(F.struct("key", F.col("i").alias("tile"), F.lit(0).alias("side")),
                                        F.struct(F.col("other").alias("key"), F.col("j").alias("tile"), F.lit(1).alias("side")))))
    parts = pairs.select("pair", part.alias("part")).select("pair", "part.*")
    placed = keyed.join(blocks, "key").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = placed.join(parts, ["key", "tile"]).select("pair", "side", "word", "n")
    return rows.repartition(n, "pair").sortWithinPartitions("pair", "side", "word").mapInArrow(
        _near, "word string, near string, near_n long")


def roots(forms: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(word, root): the last word on the way from word to form to its form ..., by
    pointer doubling.  A form has more occurrences than its word, so no way is a ring."""
    cur = cut(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max_rounds):
        ahead = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(cur.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                           F.col("next").isNotNull().alias("moved")), "roots")
        cur = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return cur
    raise RuntimeError("forms did not settle")


def variant_groups(words: DataFrame, margin: int = MARGIN, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct (word, n) rows.

    ``form`` is the near word of largest n (ties: the smallest in code-point
    order) if its n is at least ``margin`` times the word's, else null; ``root`` is
    reached from a word through its forms (a word without form is its own root).
    """
    words = cut(words.select("word", "n"), "words")
    best = near_words(words, tile).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    joined = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.less") >= margin * F.col("n"), F.col("best.form")).alias("form"),
        F.when(-F.col("best.less") >= margin * F.col("n"), -F.col("best.less")).alias("form_n")), "forms")
    root = roots(joined.where(F.col("form").isNotNull()).select("word", "form"))
    return joined.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(corpus_words(table(spark, sf_dir, "documents")))


def variants_sql(min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, margin: int = MARGIN, drop_every: int = DROP_EVERY) -> str:
    """DuckDB SQL for the query's rows, where ids are not null: near words share a word
    with one letter left out, at the same place or as the shorter word itself."""
    return f"""WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps),
run AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (
  SELECT run, hex(encode(doc_id || ':' || run)) AS bytes, count(*) AS n FROM run WHERE length(run) >= {min_length} GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], list_transform(range(length(bytes) // 2),
           lambda k: CAST('0x' || substr(bytes, CAST(2 * k + 1 AS INTEGER), 2) AS BIGINT))),
           lambda c, b: xor(c // 256, steps[(xor(c, b) % 256) + 1])), 4294967295) AS h
  FROM counted, crc),
heard AS (
  SELECT CASE WHEN h % {drop_every} = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
              ELSE run END AS word, n FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM heard WHERE length(word) >= {min_length} GROUP BY word HAVING sum(n) >= {min_count}),
less AS (
  SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
  FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS place FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION
  SELECT less.word, words.word, words.n FROM less JOIN words ON words.word = less.rest
  UNION
  SELECT words.word, less.word, less.n FROM less JOIN words ON words.word = less.rest),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {margin} * words.n THEN near END AS form,
         CASE WHEN near_n >= {margin} * words.n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
way AS (
  SELECT word, word AS at_word FROM formed
  UNION ALL
  SELECT way.word, formed.form FROM way JOIN formed ON formed.word = way.at_word WHERE formed.form IS NOT NULL)
SELECT formed.word, formed.form, way.at_word AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN way USING (word) JOIN formed last ON last.word = way.at_word AND last.form IS NULL"""
