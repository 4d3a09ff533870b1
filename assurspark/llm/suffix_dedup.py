"""Removal of repeated passages by prefix-free parsing.

A rolling hash of k bytes cuts every text into phrases: each string of LENGTH
bytes belongs to the leftmost smallest k-byte hash inside it (its trigger), and
the strings that share a trigger form a phrase.  Equal strings have equal
triggers at equal offsets, so they meet in equal phrases of the dictionary, or in
phrases that share the trigger.  Only those are worked on further:

1. Equal phrases are equal entries of the dictionary; the parse, ordered by
   (doc_id, position), says which occurrence is first.  All strings of later
   occurrences are repeats.
2. Different phrases with the same trigger are cut into blocks of aligned
   strings.  A block whose common core is unique holds no repeat; equal blocks
   are repeats of the first.
3. The strings of blocks that share the core but differ are compared singly.

Suffixes of dictionary entries are thus ordered from the trigger outwards, as far as
LENGTH bytes, by fingerprint and then by corpus order.  Occurrences that are
equal inside one task are settled there, so a passage that a third of all
documents hold sends one row per task to the shuffle.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import mixed, pieces, prefix_hash, rolling_hash, span_hash
from ._shared import cut, free, ship, table

LENGTH = 100
TRIGGER = 24            # bytes under the rolling hash
BLOCK = 10              # strings of a block
#: Phrases a task holds before it hands them on, and bytes of text worked on at once.
HELD, PIECE = 1 << 19, 1 << 20
_NULL_ID = -(1 << 63)

# A run of strings of one document in one number: start (32 bits), strings - 1 (7),
# trigger - start (7), a tag of the text (16) that tells rows of one doc_id apart.
_RUN = "key long, sub long, doc_id long, run long"


def _pack(start: np.ndarray, count: np.ndarray, delta: np.ndarray, tag: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << 32) | ((count - 1).astype(np.int64) << 25) | (delta.astype(np.int64) << 18) | tag.astype(np.int64)


def _unpack(run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return run >> 32, ((run >> 25) & 127) + 1, (run >> 18) & 127, run & 0xFFFF


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def text_tags(running: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """16 bits of a hash of each text of a piece."""
    return (span_hash(running, starts[:-1], starts[1:] - 1) >> np.uint64(48)).astype(np.int64)


def cut_phrases(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, trigger: int = TRIGGER):
    """Phrases of a piece: hash of the k bytes at the trigger, hash of the
    phrase with the trigger's place, row, first string, strings, trigger - first string."""
    empty = np.zeros(0, np.int64)
    running = prefix_hash(data)
    if len(data) <= length:
        return running, (empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty, empty)
    rolled = rolling_hash(running, trigger)
    order = (rolled & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(rolled), dtype=np.uint64)
    lowest = _sliding_min(order, length - trigger + 1)          # for each string: its trigger
    owner_at = (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)[:len(data) - length + 1]
    # strings that hold a separator run over the end of a text
    ends = starts[1:] - 1
    over = np.zeros(len(owner_at) + 1, np.int64)
    np.add.at(over, np.clip(ends - length + 1, 0, len(owner_at)), 1)
    np.add.at(over, np.clip(ends + 1, 0, len(owner_at)), -1)
    x = np.flatnonzero(np.cumsum(over[:-1]) == 0)
    if not len(x):
        return running, (empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty, empty)
    a = owner_at[x]
    edge = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (x[1:] != x[:-1] + 1)]))
    first, anchor = x[edge], a[edge]
    count = np.diff(np.append(edge, len(x)))
    delta = anchor - first
    with np.errstate(over="ignore"):
        body = mixed(span_hash(running, first, first + count - 1 + length) + delta.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    row = np.searchsorted(starts, first, "right") - 1
    return running, (rolled[anchor], body, row, first, count, delta)


class _Buffer:
    """Occurrences of a task: of equal (key, sub) only the first in corpus order
    is handed on, the others are repeats whatever the other tasks hold."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, key: np.ndarray, sub: np.ndarray, doc: np.ndarray, run: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(key):
            self.parts.append((key.view(np.int64), sub.view(np.int64), doc, run))
            self.size += len(key)
        if self.size >= HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        key, sub, doc, run = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        at = np.lexsort((run, doc, sub, key))
        key, sub, doc, run = key[at], sub[at], doc[at], run[at]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        again = ~new & ((doc != doc[lead]) | ((run >> 32) != (run[lead] >> 32)))
        yield _rows(key[new], sub[new], doc[new], run[new], OPEN)
        yield _rows(key[again], sub[again], doc[again], run[again], REPEAT)


OPEN, REPEAT = 0, 1


def _rows(key: np.ndarray, sub: np.ndarray, doc: np.ndarray, run: np.ndarray, verdict: int) -> pa.RecordBatch:
    none = verdict == REPEAT
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64()) if none else pa.array(key), pa.nulls(n, pa.int64()) if none else pa.array(sub),
         pa.array(doc), pa.array(run), pa.array(np.full(n, verdict, np.int32))], ["key", "sub", "doc_id", "run", "verdict"])


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(_NULL_ID).to_numpy()


def _phrases(length: int, trigger: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Buffer()
        for batch in batches:
            ids = _ids(batch)
            for i, _, data, starts in pieces(batch.column("text"), PIECE):
                running, (key, body, row, first, count, delta) = cut_phrases(data, starts, length, trigger)
                tag = text_tags(running, starts)
                yield from held.add(key, body, ids[i + row], _pack(first - starts[row], count, delta, tag[row]))
        yield from held.flush()

    return run


def _of_text(batch: pa.RecordBatch):
    """Pieces of a batch with its rows' runs: (data, starts, running, row, run) of the runs whose tag fits."""
    runs = batch.column("runs")
    edge = runs.offsets.to_numpy()
    flat = runs.values.to_numpy(zero_copy_only=False) if len(runs.values) else np.zeros(0, np.int64)
    for i, j, data, starts in pieces(batch.column("text"), PIECE):
        own = flat[edge[i]:edge[j]]
        row = np.repeat(np.arange(j - i), np.diff(edge[i:j + 1]))
        running = prefix_hash(data)
        fits = text_tags(running, starts)[row] == (own & 0xFFFF)
        yield i, data, starts, running, row[fits], own[fits]


def _blocks(length: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Buffer()
        for batch in batches:
            ids = _ids(batch)
            for i, _, starts, running, row, packed in ((i, d, s, h, r, p) for i, d, s, h, r, p in _of_text(batch)):
                first, count, delta, tag = _unpack(packed)
                anchor = first + delta
                # offsets of the trigger in the phrase's strings: delta - count + 1 .. delta, cut at multiples of ``block``
                low = delta - count + 1
                for b in range((length // block) + 1):
                    lo, hi = np.maximum(low, b * block), np.minimum(delta, b * block + block - 1)
                    has = lo <= hi
                    base = starts[row[has]]
                    x0, x1 = anchor[has] - hi[has], anchor[has] - lo[has]
                    core0 = base + anchor[has] - b * block
                    core1 = base + anchor[has] - (b * block + block - 1) + length
                    with np.errstate(over="ignore"):
                        core = mixed(span_hash(running, core0, core1) + np.uint64(b + 1) * np.uint64(0x9FB21C651E98DF25))
                        outer = mixed(span_hash(running, base + x0, base + x1 + length)
                                      + hi[has].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
                    yield from held.add(core, outer, ids[i + row[has]], _pack(x0, x1 - x0 + 1, hi[has], tag[has]))
        yield from held.flush()

    return run


def _strings(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Buffer()
        for batch in batches:
            ids = _ids(batch)
            for i, _, starts, running, row, packed in _of_text(batch):
                first, count, delta, tag = _unpack(packed)
                k = np.repeat(np.arange(len(first)), count)
                step = np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count)
                x = first[k] + step
                at = starts[row[k]] + x
                h = span_hash(running, at, at + length)
                one = np.ones(len(x), np.int64)
                yield from held.add(h, np.zeros(len(x), np.uint64), ids[i + row[k]], _pack(x, one, delta[k] - step, tag[k]))
        yield from held.flush()

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, sub, doc_id, run: later occurrences of (key, sub) are
    repeats; the first ones stay open where a key has several subs."""
    rest: tuple[np.ndarray, ...] | None = None

    def groups(key: np.ndarray, sub: np.ndarray, doc: np.ndarray, run: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(key):
            return
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new = new_key | np.concatenate([[True], sub[1:] != sub[:-1]])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        again = ~new & ((doc != doc[lead]) | ((run >> 32) != (run[lead] >> 32)))
        group = np.cumsum(new_key) - 1
        several = np.bincount(group, weights=new)[group] > 1
        yield _rows(key[again], sub[again], doc[again], run[again], REPEAT)
        still = new & several
        yield _rows(key[still], sub[still], doc[still], run[still], OPEN)

    for batch in batches:
        own = tuple(batch.column(k).to_numpy() for k in ("key", "sub", "doc_id", "run"))
        if rest is not None:
            own = tuple(np.concatenate(x) for x in zip(rest, own, strict=True))
        if not len(own[0]):
            continue
        last = int(np.searchsorted(own[0], own[0][-1], "left"))  # its last key may go on
        yield from groups(*(x[:last] for x in own))
        rest = tuple(x[last:] for x in own)
    if rest is not None:
        yield from groups(*rest)


_VERDICTS = _RUN + ", verdict int"


def _first_occurrences(rows: DataFrame) -> DataFrame:
    dealt = rows.where(F.col("verdict") == OPEN).select("key", "sub", "doc_id", "run")
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "key").sortWithinPartitions("key", "sub", "doc_id", "run").mapInArrow(_settle, _VERDICTS)


def _apply(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, data, starts, _, row, packed in _of_text(batch):
                first, count, _, _ = _unpack(packed)
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, starts[row] + first, 1)
                np.add.at(change, starts[row] + first + count - 1 + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                begins = gone & ~np.concatenate([[False], gone[:-1]])
                for r in range(len(starts) - 1):
                    a, b = starts[r], starts[r + 1] - 1
                    lost = gone[a:b]
                    kept = data[a:b][~lost].tobytes()
                    out.append((b - a, int(lost.sum()), int(begins[a:b].sum()), hashlib.sha256(kept).hexdigest(),
                                kept if with_text else None))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([int(v) for v in c], pa.int64()) for c in columns[:3]],
                 pa.array(columns[3], pa.string()), pa.array(columns[4], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, trigger: int = TRIGGER, block: int = BLOCK,
                   with_text: bool = True) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, kept (the remaining bytes; null unless ``with_text``).

    A byte is removed if a string of ``length`` bytes that covers it also
    starts earlier: in a document with a smaller doc_id, or before in the same
    document.  A null text is empty; a null doc_id is smaller than any other;
    rows with one doc_id and one text count as one document and get equal
    results; texts shorter than ``length`` stay whole; an empty table gives no
    rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"texts_{uuid.uuid4().hex}"
    # the texts by document, once: the three steps that need them again move only their runs
    (docs.select(F.coalesce("doc_id", F.lit(_NULL_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
     .repartition(buckets, "doc_id").write.bucketBy(buckets, "doc_id").saveAsTable(name))
    texts = spark.table(name)

    def with_runs(runs: DataFrame, how: str) -> DataFrame:
        lists = runs.groupBy("doc_id").agg(F.collect_list("run").alias("runs"))
        return texts.join(lists.hint("merge"), "doc_id", how).select(
            "doc_id", "text", F.coalesce("runs", F.array().cast("array<long>")).alias("runs"))

    found = []
    rows = cut(texts.mapInArrow(_phrases(length, trigger), _VERDICTS), "phrases")
    for step in (_blocks(length, block), _strings(length), None):
        settled = cut(_first_occurrences(rows), "settled")
        # the repeats stay, all else goes once the next step is written
        found.append(cut(rows.where(F.col("verdict") == REPEAT).union(settled.where(F.col("verdict") == REPEAT))
                         .select("doc_id", "run"), "found"))
        free(rows)
        if step is not None:
            rows = cut(with_runs(settled.where(F.col("verdict") == OPEN), "inner").mapInArrow(step, _VERDICTS), "rows")
        free(settled)
    repeats = found[0]
    for x in found[1:]:
        repeats = repeats.union(x)
    out = with_runs(repeats, "left").mapInArrow(
        _apply(length, with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != _NULL_ID, F.col("doc_id")))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")
