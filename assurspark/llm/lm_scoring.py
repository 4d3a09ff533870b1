"""Language-model scoring by prediction by partial matching (PPM).

A trie of byte contexts (orders 5 to 0) is counted over the training texts.
The probability of a byte is read from the longest context that the trie knows.
Each symbol seen there gives half a count to the escape; a byte not in the
context costs an escape, and the shorter context is asked with the symbols of
the longer one excluded.
Below order 0 all remaining byte values are equally likely.  A text's score is the log10 probability of its bytes and of its end.

The counts of all training positions are gathered by a shuffle, and no node of
the trie is left out of the scores.  What is sent to the tasks is bounded: the
code lengths of at most ``NODES`` of the most frequent grams.  A text's other
grams, rare or never seen, leave the task once per row; their code lengths come
from the full trie, cut into parts by the end of the context, and are joined.
The word counts of the base score work alike: words above one in ``WORDS`` of
all tokens are sent to the tasks, the rest are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import PIECE, SEP, SPACE, mixed, owner, pieces, prefix_hash, span_hash, spans
from ._shared import cut, id_remainder, ship, table

ORDER = 5
NODES, WORDS = 1 << 20, 1 << 20
DISCOUNT = 0.5
HELD_OUT_MOD, HELD_OUT = 7, 2
#: Rows a task gathers before it hands its counts on.
FLUSH = 1 << 21
#: Context bytes that a part of the trie shares; the orders below are small (at most 256^3 nodes) and sent whole.
SHARED = 3
#: Classes an octave by which the frequent grams are chosen, and the share of positions left to the others if ``NODES`` allows.
OCTAVE, REST = 16, 0.005
#: Slots of a task's table of known code lengths.
SLOTS_LOG2 = 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(data: np.ndarray, starts: np.ndarray, order: int = ORDER) -> Iterator[tuple[int, np.ndarray]]:
    """For each position of a piece: its byte below the ``order`` bytes before
    it, as one integer, in blocks of bounded size.  Before a text stand
    separators; the separator after it is its end symbol."""
    n = len(data)
    mask = np.uint64((1 << (8 * (order + 1))) - 1)
    for a in range(0, n, PIECE):
        b = min(n, a + PIECE)
        lead = min(order, a)
        block = np.concatenate([np.full(order - lead, SEP, np.uint8), data[a - lead:b]]).astype(np.uint64)
        g = np.zeros(b - a, np.uint64)
        for k in range(order + 1):
            g = (g << np.uint64(8)) | block[k:k + b - a]
        # bytes of the text before are separators
        begin = starts[:-1]
        for o in range(order):
            at = begin + o
            at = at[(at < starts[1:]) & (at >= a) & (at < b)]
            g[at - a] |= (np.uint64(0xFFFFFFFFFFFFFFFF) << np.uint64(8 * (o + 1))) & mask
        yield a, g & mask


class _Counts:
    """Counts of 64-bit keys, merged when many have come together."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        k, n = np.unique(keys, return_counts=True)
        self.parts.append((k, n))
        self.size += len(k)
        if self.size > FLUSH:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        k, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, weights=n, minlength=len(k)).astype(np.int64)
        self.parts, self.size = [(k, total)], len(k)
        return k, total

    def full(self) -> bool:
        return self.size > FLUSH // 2

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.merge()
        self.parts, self.size = [], 0
        return out


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w0, w1 = spans(~SPACE[data])
    return span_hash(prefix_hash(data), w0, w1), owner(w0, starts)


def gather_counts(train: DataFrame, order: int = ORDER) -> DataFrame:
    """(kind, key, n) over all training texts: kind 0 the words, 1 the ends of
    texts, 2 the byte contexts with their next byte."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)], ["kind", "key", "n"])

        words, contexts, texts = _Counts(), _Counts(), 0
        for batch in batches:
            for i, j, raw, starts in pieces(batch.column("text")):
                data = _LOWER[raw]
                texts += j - i
                words.add(_word_hashes(data, starts)[0])
                for _, g in grams(data, starts, order):
                    contexts.add(g)
                for kind, counts in ((0, words), (2, contexts)):
                    if counts.full():
                        yield rows(kind, *counts.take())
        yield rows(0, *words.take())
        yield rows(2, *contexts.take())
        yield rows(1, np.zeros(1, np.uint64), np.array([texts]))

    partial = train.select("text").mapInArrow(count, "kind int, key long, n long")
    return partial.groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Trie:
    """Context counts by order, and the code length of any gram."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """levels[k]: sorted grams of k context bytes and one symbol, and their counts."""
        self.levels = []
        for k, (key, n) in enumerate(levels):
            context, first = np.unique(key >> np.uint64(8), return_index=True)
            edge = np.append(first, len(key))
            upto = np.concatenate([[0], np.cumsum(n)])
            level = {"key": key, "n": n, "context": context, "total": np.diff(upto[edge]), "kinds": np.diff(edge)}
            level["lost"] = np.zeros(len(context))
            if k:
                # the context's occurrences that its kept symbols do not cover
                at, known = self._find(self.levels[-1]["key"], context)
                if known.any():
                    level["lost"] = np.where(known, np.maximum(self.levels[-1]["n"][at] - level["total"], 0), 0)
                # counts that the context's symbols have one order lower: excluded there
                low = self.levels[-1]
                at = np.searchsorted(low["key"], key & np.uint64((1 << (8 * k)) - 1))
                below = np.concatenate([[0], np.cumsum(low["n"][np.minimum(at, len(low["key"]) - 1)])]) if len(key) else np.zeros(1)
                level["excluded"] = np.diff(below[edge])
            self.levels.append(level)

    @staticmethod
    def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sorted_keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
        return at, sorted_keys[at] == wanted

    def log10(self, g: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last byte after its other bytes."""
        out = np.zeros(len(g))
        live = np.arange(len(g))
        excluded, kinds = np.zeros(len(g)), np.zeros(len(g))  # by the next longer context
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            own = g[live] & np.uint64((1 << (8 * (k + 1))) - 1)
            c, known = self._find(level["context"], own >> np.uint64(8))
            total = np.where(known, level["total"][c] - excluded[live], 0.0) if len(level["context"]) else np.zeros(len(live))
            lost = np.where(known, level["lost"][c], 0.0) if len(level["context"]) else np.zeros(len(live))
            new = np.where(known, level["kinds"][c] - kinds[live], 0.0) if len(level["context"]) else np.zeros(len(live))
            s, seen = self._find(level["key"], own)
            seen &= known
            whole = total + lost
            hit = seen & (whole > 0)
            out[live[hit]] += np.log10((level["n"][s[hit]] - DISCOUNT) / whole[hit])
            miss = ~hit & (whole > 0)
            out[live[miss]] += np.log10((lost[miss] + DISCOUNT * new[miss]) / whole[miss])
            if k:
                excluded[live] = np.where(known, level["excluded"][c], 0.0) if len(level["context"]) else 0.0
            kinds[live] = np.where(known, level["kinds"][c], 0.0) if len(level["context"]) else 0.0
            live = live[~hit]
        out[live] -= np.log10(256.0 - kinds[live])
        return out


class Settled:
    """Code lengths of the frequent grams; NaN for all others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys, self.values = keys, values

    def log10(self, g: np.ndarray) -> np.ndarray:
        at, known = Trie._find(self.keys, g)
        return np.where(known, self.values[at], np.nan) if len(self.keys) else np.full(len(g), np.nan)


class Scorer:
    """Code lengths with a table of those already worked out."""

    def __init__(self, trie: Trie | Settled) -> None:
        self.trie = trie
        self.keys = np.full(1 << SLOTS_LOG2, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.values = np.zeros(1 << SLOTS_LOG2)

    def __call__(self, g: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            slot = (g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS_LOG2)
        out = self.values[slot]
        miss = np.flatnonzero(self.keys[slot] != g)
        if len(miss):
            new, inverse = np.unique(g[miss], return_inverse=True)
            value = self.trie.log10(new)
            out[miss] = value[inverse]
            with np.errstate(over="ignore"):
                at = (new * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS_LOG2)
            # one writer per slot, or key and value of a shared slot could part
            at, first = np.unique(at, return_index=True)
            self.keys[at], self.values[at] = new[first], value[first]
        return out


def build_trie(counts: DataFrame, order: int = ORDER, nodes: int = NODES) -> list[tuple[np.ndarray, np.ndarray]]:
    """The levels of the trie from the gathered context counts; at most ``nodes`` rows a level come back."""
    contexts = counts.where("kind = 2")
    total = contexts.agg(F.sum("n")).first()[0] or 0
    least = max(1, -(-total // nodes))
    by_level = None
    for k in range(order + 1):
        level = (contexts.select(F.lit(k).alias("level"), F.col("key").bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1)).alias("key"), "n")
                 .groupBy("level", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
        by_level = level if by_level is None else by_level.union(level)
    got = by_level.toPandas()
    out = []
    for k in range(order + 1):
        own = got[got["level"] == k]
        key, n = own["key"].to_numpy().astype(np.uint64), own["n"].to_numpy().astype(np.int64)
        at = np.argsort(key)
        out.append((key[at], n[at]))
    return out


def frequent_lengths(contexts: DataFrame, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent grams, at most ``nodes``, sorted, and their code lengths: a gram that
    was seen is read from its longest context, whose total needs all of the context's symbols."""
    size = F.floor(F.log2("n") * OCTAVE)
    sizes = sorted(contexts.groupBy(size.alias("size")).agg(F.count("*"), F.sum("n")).collect(), reverse=True)
    left = sum(r[2] for r in sizes)
    least, held, few = None, 0, REST * left
    for own, grams_of, positions in sizes:
        held += grams_of
        if held > nodes or left <= few:
            break
        least, left = own, left - positions
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0)
    totals = contexts.groupBy(F.shiftright("key", 8).alias("context")).agg(F.sum("n").alias("total"))
    value = F.log10((F.col("n") - DISCOUNT) / F.col("total"))
    got = (contexts.where(size >= least).withColumn("context", F.shiftright("key", 8)).join(totals, "context")
           .select("key", value.alias("value")).toArrow())  # as it comes: pandas would hold it twice more
    key, value = got.column("key").to_numpy().view(np.uint64), got.column("value").to_numpy()
    at = np.argsort(key)
    return key[at], value[at]


def joined_lengths(contexts: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, value): the code length of every gram of ``wanted`` under all counts.

    Contexts that end alike go to one part, so a part holds whole contexts of
    the orders from ``SHARED`` on; a part is read in runs of such endings.
    """
    spark = contexts.sparkSession
    shared = min(SHARED, order)
    low = spark.sparkContext.broadcast(build_trie(contexts, shared - 1, 1 << 62) if shared else [])
    ending = np.uint64((1 << (8 * shared)) - 1)

    def part(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        seen, wanted = n > 0, key[n == 0]
        levels = list(low.value)
        for k in range(shared, order + 1):
            own, inverse = np.unique(key[seen] & np.uint64((1 << (8 * (k + 1))) - 1), return_inverse=True)
            levels.append((own, np.bincount(inverse, weights=n[seen], minlength=len(own)).astype(np.int64)))
        return pa.RecordBatch.from_arrays(
            [pa.array(wanted.view(np.int64)), pa.array(Trie(levels).log10(wanted))], ["gram", "value"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        for batch in batches:
            keys.append(batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64))
            counts.append(batch.column("n").to_numpy(zero_copy_only=False))
            size += batch.num_rows
            if size < FLUSH // 2:
                continue
            key, n = np.concatenate(keys), np.concatenate(counts)
            end = (key >> np.uint64(8)) & ending
            whole = int(np.flatnonzero(end != end[-1])[-1]) + 1 if (end != end[-1]).any() else 0
            if whole:
                yield part(key[:whole], n[:whole])
            keys, counts, size = [key[whole:]], [n[whole:]], len(key) - whole
        if size:
            yield part(np.concatenate(keys), np.concatenate(counts))

    end = F.shiftright("key", 8).bitwiseAND(F.lit(int(ending)))
    both = contexts.select("key", "n").union(wanted.select("gram", F.lit(0).cast("long"))).withColumn("ending", end)
    return both.repartition("ending").sortWithinPartitions("ending").select("key", "n").mapInArrow(
        rows, "gram long, value double")


def score_documents(docs: DataFrame, train: DataFrame, order: int = ORDER, nodes: int = NODES,
                    words: int = WORDS) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_tokens, n_known, train_tokens,
    base_score, score, learning from the texts of ``train``.

    Upper-case A-Z counts as lower case.  A null text is empty: its tokens are
    the end alone.  With nothing to learn from, the base treats all tokens as
    unknown and the bytes are equally likely.  Repeated rows are scored alike;
    other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    # learn: one pass over the training texts
    counts = cut(gather_counts(train, order), "counts")
    sums = {r["kind"]: (r["n"], r["kinds"]) for r in
            counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    ends = sums.get(1, (0, 0))[0]
    n_train = sums.get(0, (0, 0))[0] + ends
    distinct = sums.get(0, (0, 0))[1] + (1 if ends else 0)
    often = max(1, -(-n_train // words))
    frequent = counts.where((F.col("kind") == 0) & (F.col("n") >= often)).select("key", "n").toPandas()
    key = frequent["key"].to_numpy().astype(np.int64).view(np.uint64)
    at = np.argsort(key)
    contexts = counts.where("kind = 2")
    sent = spark.sparkContext.broadcast(
        (frequent_lengths(contexts, nodes), key[at], frequent["n"].to_numpy().astype(np.int64)[at]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled, known_words, known_counts = sent.value
        scorer = Scorer(Settled(*settled))
        bits = np.log10(known_counts + 1.0)
        row = TaskContext.get().partitionId() << 40
        names = ["row", "doc_id", "word", "gram", "n", "n_known", "base", "score"]

        def asked(number: np.ndarray, of: np.ndarray, keys: np.ndarray, column: str) -> pa.RecordBatch:
            """One row per text and key, with the number of times."""
            with np.errstate(over="ignore"):
                _, first, times = np.unique(mixed(keys ^ mixed(of.astype(np.uint64) + np.uint64(1))),
                                            return_index=True, return_counts=True)
            m = len(first)
            have = {"row": pa.array(number[of[first]]), column: pa.array(keys[first].view(np.int64)), "n": pa.array(times)}
            return pa.RecordBatch.from_arrays(
                [have.get(c, pa.nulls(m, pa.float64() if c in ("base", "score") else pa.int64())) for c in names], names)

        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, raw, starts in pieces(batch.column("text")):
                n = j - i
                data = _LOWER[raw]
                word, of = _word_hashes(data, starts)
                at, known = Trie._find(known_words, word)
                base = np.bincount(of[known], weights=bits[at[known]], minlength=n) + np.log10(ends + 1.0)
                n_known = np.bincount(of[known], minlength=n) + (1 if ends else 0)
                values, open_at, open_grams = [], [], []
                for a, g in grams(data, starts, order):
                    v = scorer(g)
                    unsettled = np.flatnonzero(np.isnan(v))
                    v[unsettled] = 0.0
                    values.append(v)
                    open_at.append(unsettled + a)
                    open_grams.append(g[unsettled])
                values = np.concatenate(values)
                score = np.add.reduceat(values, starts[:-1])
                number = row + np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number), ids.slice(i, n), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.bincount(of, minlength=n) + 1),
                     pa.array(n_known), pa.array(base), pa.array(score)], names)
                # the other words and grams, once per row: their counts and code lengths are joined
                if not known.all():
                    yield asked(number, of[~known], word[~known], "word")
                at = np.concatenate(open_at)
                if len(at):
                    yield asked(number, owner(at, starts), np.concatenate(open_grams), "gram")
                row += n

    scored = cut(docs.select("doc_id", "text").mapInArrow(
        rows, "row long, doc_id long, word long, gram long, n long, n_known long, base double, score double"), "scored")
    rare = counts.where((F.col("kind") == 0) & (F.col("n") < often)).select(F.col("key").alias("word"), F.col("n").alias("c"))
    more = (scored.where("word is not null").select("row", "word", "n").join(rare, "word").groupBy("row")
            .agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more_base")))
    unsettled = scored.where("gram is not null").select("row", "gram", "n")
    lengths = cut(joined_lengths(contexts, unsettled.select("gram").distinct(), order), "lengths")
    rest = (unsettled.join(lengths, "gram").groupBy("row").agg(F.sum(F.col("n") * F.col("value")).alias("more_score")))
    texts = scored.where("word is null AND gram is null").join(more, "row", "left").join(rest, "row", "left")
    per_token = float(np.log10(n_train + distinct + 1.0))
    return texts.select(
        "doc_id", F.col("n").alias("n_tokens"), (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n") * F.lit(per_token)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))


def adaptive_code_length(text: bytes, order: int = ORDER) -> float:
    """log10 probability of one text under a trie that starts empty and learns
    as it reads, with the same escapes and exclusion (for short texts)."""
    tables: list[dict[bytes, dict[int, int]]] = [{} for _ in range(order + 1)]
    total = 0.0
    history = bytes([SEP] * order)
    for symbol in [*text, SEP]:
        excluded: set[int] = set()
        contexts = [history[len(history) - k:] for k in range(order + 1)]
        for k in range(order, -1, -1):
            seen = {s: c for s, c in tables[k].get(contexts[k], {}).items() if s not in excluded}
            if not seen:
                continue
            whole = sum(seen.values())
            if symbol in seen:
                total += np.log10((seen[symbol] - DISCOUNT) / whole)
                break
            total += np.log10(DISCOUNT * len(seen) / whole)
            excluded |= set(seen)
        else:
            total -= np.log10(256.0 - len(excluded))
        for k in range(order + 1):
            row = tables[k].setdefault(contexts[k], {})
            row[symbol] = row.get(symbol, 0) + 1
        history = (history + bytes([symbol]))[-order:] if order else b""
    return float(total)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), HELD_OUT_MOD) == HELD_OUT
    scored = score_documents(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
