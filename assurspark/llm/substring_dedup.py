"""Removal of repeated word passages by prefix-partitioned suffix trees.

The suffixes of all documents (from word to word) are split by a prefix into groups;
a group's subtree is built from its sorted suffixes, and its deep internal nodes
(WINDOW words or more below the root, suffixes of several documents) are the
maximal repeats.  Nothing asks for nodes below WINDOW words, so suffixes are cut there.

1. A prefix that one document alone holds is a leaf: no suffix tree below it has an
   inner node.  To see that with few rows, prefixes are counted where a window of WINDOW
   words has its smallest PREFIX-word hash (its anchor): equal windows have equal
   anchors, so a window whose anchor occurs in one document only is unique.
2. The suffixes of the other windows are written out as the edges of a path from the
   root: fingerprints of words 1..PREFIX and of the rest.
3. Prefixes are counted.  One with more suffixes than a group may hold is replaced by the
   longer prefixes below it (variable length); a prefix of WINDOW words needs no
   subtree, only its smallest document.
4. A task reads its groups sorted, one after the other: neighbours that agree on all edges
   lie below the same deep node.

A text that also stands under a smaller doc_id is a repeat as a whole; its suffixes
are left out.  Occurrences that are equal inside one task are settled there, so a passage
that a third of all documents hold sends one row per task to the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import SPACE, mixed, owner, pieces, prefix_hash, span_hash, spans, word_windows
from ._shared import cut, free, ship, table

WINDOW = 13             # words of a repeat
PREFIX = 6              # words of the shortest prefix
#: A prefix is lengthened beyond so many suffixes, or beyond this part of all of them.
GROUP, GROUP_PART = 1 << 16, 1 << 16
#: Suffixes a task holds before it hands them on, and bytes of text worked on at once.
HELD, PIECE = 1 << 19, 1 << 20
_NULL_ID = -(1 << 63)
_TAG = (1 << 32) - 1
OPEN, SETTLED = 0, 1


class Words:
    """Words of a piece of text and their windows."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, window: int, prefix: int):
        begin, end = spans(~SPACE[data])
        running = prefix_hash(data)
        self.row = owner(begin, starts)
        self.first = np.searchsorted(self.row, np.arange(len(starts)))     # first word of each row
        words = span_hash(running, begin, end)
        n = len(words)
        none = np.zeros(0, np.int64)
        self.start = np.flatnonzero(self.row[:n - window + 1] == self.row[window - 1:]) if n >= window else none
        if not len(self.start):
            self.anchor, self.edges, self.grams = none, [none.view(np.uint64)] * 2, none.view(np.uint64)
            return
        everywhere = np.zeros(n, np.int64)
        self.grams, tails = (word_windows(words, everywhere, k)[0] for k in (prefix, window - prefix))
        self.edges = [self.grams[self.start], tails[self.start + prefix]]
        # anchor of a window: its smallest prefix hash, the leftmost of equal ones
        wide = window - prefix + 1
        order = (self.grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(self.grams), dtype=np.uint64)
        least = order[:len(order) - wide + 1].copy()
        for k in range(1, wide):
            np.minimum(least, order[k:len(order) - wide + 1 + k], out=least)
        self.anchor = (least[self.start] & np.uint64(0xFFFFFFFF)).astype(np.int64)


class _Held:
    """Rows (key columns, doc, run) of a task, handed on by ``settle`` in large pieces."""

    def __init__(self, settle):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size, self.settle = 0, settle

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(columns[0]):
            self.parts.append(columns)
            self.size += len(columns[0])
        if self.size >= HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            columns = [np.concatenate(x) for x in zip(*self.parts, strict=True)]
            self.parts, self.size = [], 0
            yield from self.settle(*columns)


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("doc").to_numpy(), batch.column("tag").to_numpy()


def _run(position: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """Word position and the tag of the text, which tells rows of one doc_id apart."""
    return (position.astype(np.int64) << 32) | tag


# ------------------------------------------------------------------ 1: prefixes of one document
_ANCHORS = "key long, doc long, run long, verdict int"


def _anchor_rows(key: np.ndarray, doc: np.ndarray, run: np.ndarray, verdict: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array(run), pa.array(np.full(len(doc), verdict, np.int32))],
                                      ["key", "doc", "run", "verdict"])


def _several(new_key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows (sorted by key, doc) whose key has several documents."""
    change = np.ones(len(doc), bool)
    change[1:] = doc[1:] != doc[:-1]
    group = np.cumsum(new_key) - 1
    return (np.bincount(group, weights=change | new_key) > 1)[group]


def _anchors(window: int, prefix: int):
    def settle(key: np.ndarray, doc: np.ndarray, run: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.lexsort((run, doc, key))
        key, doc, run = key[at], doc[at], run[at]
        new = _new(key)
        shared = _several(new, doc)
        # a key with several documents is settled: one row, without position, tells the other
        # tasks; its rows are dealt out by their text
        spread = mixed((doc ^ (run & _TAG)).view(np.uint64)).view(np.int64)
        yield _anchor_rows(spread[shared], doc[shared], run[shared], SETTLED)
        yield _anchor_rows(key[~shared], doc[~shared], run[~shared], OPEN)
        lead = shared & new
        yield _anchor_rows(key[lead], doc[lead], np.full(int(lead.sum()), -1, np.int64), OPEN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(settle)
        for batch in batches:
            doc, tag = _rows_of(batch)
            for i, _, data, starts in pieces(batch.column("text"), PIECE):
                w = Words(data, starts, window, prefix)
                anchor = np.unique(w.anchor)
                row = w.row[anchor]
                yield from held.add(w.grams[anchor].view(np.int64), doc[i + row], _run(anchor - w.first[row], tag[i + row]))
        yield from held.flush()

    return run


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, doc, run: the settled ones, and those of keys with several
    documents, in any task."""
    rest: tuple[np.ndarray, ...] | None = None

    def out(doc: np.ndarray, run: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(run)], ["doc", "run"])

    def done(key: np.ndarray, doc: np.ndarray, run: np.ndarray) -> pa.RecordBatch:
        new = _new(key)
        group = np.cumsum(new) - 1
        shared = _several(new, doc) | (np.bincount(group, weights=run < 0) > 0)[group]
        shared &= run >= 0
        return out(doc[shared], run[shared])

    for batch in batches:
        own = tuple(batch.column(k).to_numpy() for k in ("key", "doc", "run"))
        still = batch.column("verdict").to_numpy() == OPEN
        yield out(own[1][~still], own[2][~still])
        own = tuple(x[still] for x in own)
        if rest is not None:
            own = tuple(np.concatenate(x) for x in zip(rest, own, strict=True))
        if len(own[0]):
            last = int(np.searchsorted(own[0], own[0][-1], "left"))  # its last key may go on
            if last:
                yield done(*(x[:last] for x in own))
            rest = tuple(x[last:] for x in own)
    if rest is not None and len(rest[0]):
        yield done(*rest)


# ------------------------------------------------------------------ 2: suffixes below the other prefixes
_SUFFIXES = "e1 long, e2 long, doc long, run long, verdict int"


def _suffix_rows(e1: np.ndarray, e2: np.ndarray, doc: np.ndarray, run: np.ndarray, verdict: int) -> pa.RecordBatch:
    n = len(doc)
    edges = [pa.nulls(n, pa.int64()) if verdict == SETTLED else pa.array(e) for e in (e1, e2)]
    return pa.RecordBatch.from_arrays([*edges, pa.array(doc), pa.array(run), pa.array(np.full(n, verdict, np.int32))],
                                      ["e1", "e2", "doc", "run", "verdict"])


def _repeats(new: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows (sorted by path, doc) below a node that also has a smaller document."""
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    return doc > doc[lead]


def _suffixes(window: int, prefix: int):
    def settle(e1: np.ndarray, e2: np.ndarray, doc: np.ndarray, run: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.lexsort((run, doc, e2, e1))
        e1, e2, doc, run = e1[at], e2[at], doc[at], run[at]
        again = _repeats(_new(e1, e2), doc)
        yield _suffix_rows(e1[again], e2[again], doc[again], run[again], SETTLED)
        first = ~again
        yield _suffix_rows(e1[first], e2[first], doc[first], run[first], OPEN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(settle)
        for batch in batches:
            doc, tag = _rows_of(batch)
            marks = batch.column("marks")
            edge, flat = marks.offsets.to_numpy(), marks.values.to_numpy(zero_copy_only=False)
            for i, j, data, starts in pieces(batch.column("text"), PIECE):
                w = Words(data, starts, window, prefix)
                own = flat[edge[i]:edge[j]]
                row = np.repeat(np.arange(j - i), np.diff(edge[i:j + 1]))
                at = w.first[row] + (own >> 32)
                shared = np.zeros(len(w.row) + 1, bool)
                shared[at[at < w.first[row + 1]]] = True    # texts of one doc_id may have equal tags
                take = np.flatnonzero(shared[w.anchor])
                at = w.row[w.start[take]]
                yield from held.add(*(e[take].view(np.int64) for e in w.edges), doc[i + at],
                                    _run(w.start[take] - w.first[at], tag[i + at]))
        yield from held.flush()

    return run


# ------------------------------------------------------------------ 3 and 4: groups and their subtrees
def grouped(suffixes: DataFrame, group: int = GROUP, part: int = GROUP_PART) -> DataFrame:
    """Adds ``grp``, a fingerprint of the shorter prefix, or of the longer one where
    more than max(group, rows / part) suffixes have the shorter one.  So at most
    ``part`` prefixes are too large: that bounds the list that is broadcast."""
    rows = suffixes.count()
    most = max(group, rows // part)
    # a coarse count first: a prefix that is too large is in a bucket that is too large
    buckets = 4 * rows // most + 1
    full = suffixes.groupBy(F.pmod("e1", F.lit(buckets)).alias("bucket")).count().where(F.col("count") > most).select("bucket")
    large = (suffixes.join(F.broadcast(full), F.pmod("e1", F.lit(buckets)) == F.col("bucket"), "left_semi")
             .groupBy("e1").count().where(F.col("count") > most).select("e1", F.lit(True).alias("large")))
    return (suffixes.join(F.broadcast(large), "e1", "left")
            .withColumn("grp", F.when(F.col("large"), F.xxhash64("e1", "e2")).otherwise(F.xxhash64("e1"))).drop("large"))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes sorted by path and document: those below a deep node with a smaller
    document.  A node is settled by its first row, so no group is held."""
    node: tuple[int, ...] | None = None
    least = 0
    for batch in batches:
        e1, e2, doc, run = (batch.column(k).to_numpy() for k in ("e1", "e2", "doc", "run"))
        if not len(doc):
            continue
        new = _new(e1, e2)
        lead = doc[np.flatnonzero(new)[np.cumsum(new) - 1]]
        if node == (e1[0], e2[0]):         # the last node goes on
            head = int(np.argmax(new[1:])) + 1 if new[1:].any() else len(doc)
            lead[:head] = least
        node, least = (e1[-1], e2[-1]), int(lead[-1])
        again = doc > lead
        yield pa.RecordBatch.from_arrays([pa.array(doc[again]), pa.array(run[again])], ["doc", "run"])


# ------------------------------------------------------------------ 5: removal
def _apply(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            marks, whole = batch.column("marks"), batch.column("whole").to_numpy(zero_copy_only=False)
            edge, flat = marks.offsets.to_numpy(), marks.values.to_numpy(zero_copy_only=False)
            for i, j, data, starts in pieces(batch.column("text"), PIECE):
                begin, end = spans(~SPACE[data])
                first = np.searchsorted(begin, starts)               # first word of each row
                own = flat[edge[i]:edge[j]]
                row = np.repeat(np.arange(j - i), np.diff(edge[i:j + 1]))
                change = np.zeros(len(begin) + window + 1, np.int64)
                hit = first[row] + (own >> 32)
                np.add.at(change, hit, 1)
                np.add.at(change, hit + window, -1)
                gone = np.cumsum(change)[:len(begin)] > 0
                for r in np.flatnonzero(whole[i:j] & (np.diff(first) >= window)):
                    gone[first[r]:first[r + 1]] = True
                runs = gone & ~np.concatenate([[False], gone[:-1]])
                raw = data.tobytes()
                for r in range(j - i):
                    a, b = first[r], first[r + 1]
                    lost = gone[a:b]
                    kept = b" ".join([raw[s:e] for s, e in zip(begin[a:b][~lost].tolist(), end[a:b][~lost].tolist(), strict=True)])
                    out.append((int(b - a), int(lost.sum()), int(runs[a:b].sum()) + int(b > a and gone[a] and not runs[a]),
                                hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *[pa.array(c, pa.int64()) for c in columns[:3]], *[pa.array(c, pa.string()) for c in columns[3:]]],
                ["doc", "n_words", "n_removed", "n_repeats", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, with_text: bool = True) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_words, n_removed, n_repeats (maximal removed
    runs), kept_sha256, kept (remaining words, joined by one space; null unless ``with_text``).

    A word is removed if a window of ``window`` words that covers it also starts in a
    document with a smaller doc_id.  A null text has no words; a null doc_id is
    smaller than any other; rows with one doc_id do not remove each other's words (their
    texts are told apart by 32 bits of a hash);
    texts of fewer words stay whole; very long texts are read whole; an empty table
    gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text: Column = F.coalesce("text", F.lit(""))
    texts = docs.select(F.coalesce("doc_id", F.lit(_NULL_ID)).alias("doc"), text.alias("text"),
                        F.xxhash64(text).bitwiseAND(F.lit(_TAG)).alias("tag"))

    def with_marks(marks: DataFrame, how: str) -> DataFrame:
        lists = (marks.groupBy("doc", F.col("run").bitwiseAND(F.lit(_TAG)).alias("tag"))
                 .agg(F.sort_array(F.collect_set("run")).alias("marks")))  # a set: rows that occur twice send the same marks
        return texts.join(lists.hint("merge"), ["doc", "tag"], how).withColumn(
            "marks", F.coalesce("marks", F.array().cast("array<long>")))

    # texts that a smaller doc_id has too
    same = cut(texts.select("doc", "tag", F.unhex(F.sha2("text", 256)).alias("sha")), "same")
    least = same.groupBy("sha").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("sha", "least")
    copies = cut(same.join(least, "sha").where("doc > least").select("doc", "tag").distinct(), "copies")

    anchors = texts.mapInArrow(_anchors(window, prefix), _ANCHORS)
    shared = cut(anchors.repartition(n, "key").sortWithinPartitions("key", "doc", "run")
                 .mapInArrow(_shared_anchors, "doc long, run long"), "shared")
    own = shared.withColumn("tag", F.col("run").bitwiseAND(F.lit(_TAG))).join(copies, ["doc", "tag"], "left_anti").select("doc", "run")
    suffixes = cut(with_marks(own, "inner").select("doc", "tag", "text", "marks").mapInArrow(_suffixes(window, prefix), _SUFFIXES), "suffixes")
    free(shared)
    still = grouped(suffixes.where(F.col("verdict") == OPEN).drop("verdict"))
    deep = (still.repartition(n, "grp").sortWithinPartitions("grp", "e1", "e2", "doc", "run")
            .select("e1", "e2", "doc", "run").mapInArrow(_subtrees, "doc long, run long"))
    repeats = cut(deep.union(suffixes.where(F.col("verdict") == SETTLED).select("doc", "run")), "repeats")
    free(suffixes)
    marked = with_marks(repeats, "left").join(copies.withColumn("whole", F.lit(True)).hint("merge"), ["doc", "tag"], "left").select(
        "doc", "text", "marks", F.coalesce("whole", F.lit(False)).alias("whole"))
    out = marked.mapInArrow(
        _apply(window, with_text), "doc long, n_words long, n_removed long, n_repeats long, kept_sha256 string, kept string")
    return out.withColumn("doc_id", F.when(F.col("doc") != _NULL_ID, F.col("doc"))).select("doc_id", *out.columns[1:])


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def repeats_sql(window: int = WINDOW) -> str:
    """DuckDB SQL for the query's rows, where ids are distinct and not null."""
    return f"""WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
place AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - {window - 1}, 0) + 1)) AS spot FROM split),
windows AS (
  SELECT doc_id, spot, array_to_string(list_slice(words, spot, spot + {window - 1}), ' ') AS phrase FROM place),
smallest AS (SELECT phrase, min(doc_id) AS least FROM windows GROUP BY phrase),
gone AS (
  SELECT DISTINCT doc_id, spot + k AS spot
  FROM windows JOIN smallest USING (phrase), range({window}) offsets(k) WHERE doc_id > least),
word AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS spot FROM split),
rest AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY spot) AS kept FROM word ANTI JOIN gone USING (doc_id, spot) GROUP BY doc_id),
removed AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE starts) AS n_repeats
  FROM (SELECT doc_id, lag(spot) OVER (PARTITION BY doc_id ORDER BY spot) IS DISTINCT FROM spot - 1 AS starts FROM gone) GROUP BY doc_id)
SELECT split.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_repeats, 0) AS n_repeats, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN rest USING (doc_id) LEFT JOIN removed USING (doc_id)"""
