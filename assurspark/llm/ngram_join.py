"""N-gram Jaccard join by a MinHash LSH forest.

Every text is the set of its five-word shingles.  Each of ``TREES`` sorted
prefix tries orders the texts by a label of MinHash values; texts that share a
prefix of the label in some trie are compared.  Starting from ``MAX_DEPTH``
values the matched prefix is shortened until a pair at the threshold is found
with the target recall.  Found pairs are verified exactly on their shingles.

Texts with equal words are one class before anything else.  Shingles travel only for
classes that share a prefix with another one: once per class in a small
candidate component, otherwise once per tile of a shared prefix.  A prefix with
many texts is cut into tiles of at most about ``TILE`` texts a side, so no task
holds a whole hot group, and a pair is counted only under the first trie that
shares it.  Tasks return a row per text, not per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import _PINV, SEP, _powers, mixed, owner, pieces, prefix_hash, span_hash, spans
from ._shared import components, cut, ship, table

SHINGLE, SIMILARITY = 5, 0.8
TREES, MAX_DEPTH, RECALL = 16, 8, 0.9995
TILE = 384
#: Classes that may hold more than one in so many of all rows, and are broadcast.
BROADCAST_CLASSES = 20_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = True
_WORD[128:SEP] = True
_SEEDS = np.random.default_rng(2024).integers(1, 1 << 63, TREES * MAX_DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def matched_depth(similarity: float = SIMILARITY, trees: int = TREES, depth: int = MAX_DEPTH, recall: float = RECALL) -> int:
    """The longest prefix, shortened step by step from ``depth``, under which a
    pair of the given similarity shares one in some trie with the target recall."""
    while depth > 1 and 1.0 - (1.0 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(data: np.ndarray, starts: np.ndarray, n: int = SHINGLE):
    """Of a piece: hashes of the n-word shingles with their rows (a shorter text
    with words is one shingle), words per row, hash of each row's word sequence."""
    low = _LOWER[data]
    w0, w1 = spans(_WORD[low])
    row = owner(w0, starts)
    words = span_hash(prefix_hash(low), w0, w1)
    rows = len(starts) - 1
    n_words = np.bincount(row, minlength=rows)
    edge = np.concatenate([[0], np.cumsum(n_words)])
    run = np.zeros(len(words) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(words * _powers(0x9E3779B97F4A7C15 | 1, len(words))[:len(words)], out=run[1:])

        def sequence(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            h = (run[b] - run[a]) * _powers(_PINV, len(run))[a]
            return mixed(h + (b - a).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))

        first = np.flatnonzero(row[:max(len(row) - n + 1, 0)] == row[n - 1:]) if len(row) >= n else np.zeros(0, np.int64)
        few = np.flatnonzero((n_words > 0) & (n_words < n))
        h = np.concatenate([sequence(first, first + n), sequence(edge[few], edge[few + 1])])
        of = np.concatenate([row[first], few])
        at = np.argsort(of, kind="stable")
        return h[at], of[at], n_words, sequence(edge[:-1], edge[1:])


def tree_keys(shingles: np.ndarray, edge: np.ndarray, depth: int, trees: int = TREES) -> np.ndarray:
    """(rows, trees): hash of the first ``depth`` MinHash values of each trie's label."""
    out = np.zeros((len(edge) - 1, trees), np.uint64)
    with np.errstate(over="ignore"):
        for t in range(trees):
            label = np.full(len(edge) - 1, t + 1, np.uint64)
            for d in range(depth):
                value = np.minimum.reduceat((shingles * _SEEDS[t * MAX_DEPTH + d]) >> np.uint64(32), edge[:-1])
                label = mixed(label * np.uint64(0x9FB21C651E98DF25) + value)
            out[:, t] = label
    return out


def _sign(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, data, starts in pieces(batch.column("text")):
                n = j - i
                h, of, n_words, sequence = shingle_sets(data, starts)
                raw = span_hash(prefix_hash(data), starts[:-1], starts[1:] - 1)
                worded = np.flatnonzero(n_words)
                keys = np.zeros((n, TREES), np.uint64)
                if len(worded):
                    edge = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n)[worded])])
                    keys[worded] = tree_keys(h, edge, depth)
                blank = np.diff(starts) == 1
                text = np.where(n_words > 0, sequence, mixed(raw)).view(np.int64)
                flat = pa.array(keys.view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * TREES + 1, TREES, dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, n), batch.column("doc").slice(i, n), pa.array(text, mask=blank),
                     pa.array(n_words), lists], ["doc_id", "doc", "text_class", "n_words", "keys"])

    return run


def _shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct shingles of the texts whose class is asked for."""
    for batch in batches:
        asked = batch.column("asked").to_numpy()
        for i, j, data, starts in pieces(batch.column("text")):
            h, of, _, sequence = shingle_sets(data, starts)
            edge = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=j - i))])
            fits = [k for k in range(j - i) if sequence[k].view(np.int64) == asked[i + k]]
            sets = [np.unique(h[edge[k]:edge[k + 1]]).view(np.int64) for k in fits]
            yield pa.RecordBatch.from_arrays(
                [pa.array([asked[i + k] for k in fits], pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                ["text_class", "shingles"])


def link_tile(keys: np.ndarray, sets: list[np.ndarray], side: np.ndarray, tree: int, weight: np.ndarray,
              similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Verified links of one tile: per text its linked texts, their documents,
    and the smallest text it is connected to here.

    side: 0 and 1 where two different parts of a prefix meet (only pairs across
    count), -1 where a part meets itself.  tree >= 0: only pairs whose first
    shared trie it is; tree < 0: pairs that share any trie.
    """
    m = len(sets)
    n_links, n_docs, root = np.zeros(m, np.int64), np.zeros(m, np.int64), np.arange(m)
    flat = np.concatenate(sets)
    size = np.array([len(s) for s in sets])
    edge = np.concatenate([[0], np.cumsum(size)])
    _, number = np.unique(flat, return_inverse=True)
    mark = np.zeros(int(number.max()) + 1, np.int32)

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a in range(m - 1):
        same = keys[a + 1:] == keys[a]
        want = same.any(1) if tree < 0 else same[:, tree] & ~same[:, :tree].any(1)
        want &= (side[a + 1:] != side[a]) | (side[a + 1:] < 0)
        want &= np.minimum(size[a + 1:], size[a]) >= similarity * np.maximum(size[a + 1:], size[a]) - 1e-9
        if not want.any():
            continue
        b = a + 1 + np.flatnonzero(want)
        own = number[edge[a]:edge[a + 1]]
        mark[own] = 1
        if len(b) * 4 > m - a:
            common = np.add.reduceat(mark[number[edge[a + 1]:]], edge[a + 1:-1] - edge[a + 1])[b - a - 1]
        else:
            common = np.array([mark[number[edge[k]:edge[k + 1]]].sum() for k in b])
        mark[own] = 0
        # exact: |A n B| >= s |A u B|
        linked = b[common >= similarity * (size[a] + size[b] - common) - 1e-9]
        n_links[a] += len(linked)
        n_docs[a] += weight[linked].sum()
        n_links[linked] += 1
        n_docs[linked] += weight[a]
        for k in linked:
            x, y = find(a), find(int(k))
            if x != y:
                root[max(x, y)] = min(x, y)
    return n_links, n_docs, np.array([find(k) for k in range(m)])


def _verify(similarity: float):
    """Rows sorted by (block, i, j, text_class) hold whole tiles one after another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            if not rows.num_rows:
                return
            rows = rows.combine_chunks()
            col = {k: rows.column(k).to_numpy() for k in ("block", "i", "j", "chunk", "tree", "text_class", "size")}
            keys = rows.column("keys").combine_chunks()
            keys = keys.flatten().to_numpy().reshape(-1, TREES)
            lists = rows.column("shingles").combine_chunks()
            flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
            new = np.concatenate([[True], (col["block"][1:] != col["block"][:-1]) | (col["i"][1:] != col["i"][:-1])
                                  | (col["j"][1:] != col["j"][:-1])])
            edges = np.append(np.flatnonzero(new), rows.num_rows)
            out: list[list[np.ndarray]] = [[], [], [], []]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a < 2:
                    continue
                two = col["i"][a] != col["j"][a]
                side = (col["chunk"][a:b] == col["j"][a]).astype(int) if two else np.full(b - a, -1)
                links, docs, root = link_tile(keys[a:b], [flat[at[k]:at[k + 1]] for k in range(a, b)], side,
                                              int(col["tree"][a]), col["size"][a:b], similarity)
                some = np.flatnonzero(links)
                out[0].append(col["text_class"][a:b][some])
                out[1].append(col["text_class"][a:b][root[some]])
                out[2].append(links[some])
                out[3].append(docs[some])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out],
                                                 ["text_class", "root", "n_texts", "n_docs"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # the last tile of a batch may go on in the next one
            last = [batch.column(k)[-1].as_py() for k in ("block", "i", "j")]
            same = np.logical_and.reduce([batch.column(k).to_numpy() == v for k, v in zip(("block", "i", "j"), last, strict=True)])
            begin = int(np.argmax(same))
            if begin:
                yield from finish(pa.Table.from_batches([*held, batch.slice(0, begin)]))
                held = []
            elif held and [held[-1].column(k)[-1].as_py() for k in ("block", "i", "j")] != last:
                yield from finish(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(begin))
        if held:
            yield from finish(pa.Table.from_batches(held))

    return run


def ngram_join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, tile: int = TILE) -> DataFrame:
    """Near duplicates of (doc_id, text): a row per row with doc_id, doc (hash of
    id and text), group (one value per class; null for an empty text), class_id (smallest
    doc_id of all documents connected by links), copy_of (smallest doc_id with
    the same words), n_links (other documents at ``similarity`` or more) and
    n_linked_texts (other classes).

    Words are runs of digits, letters and non-ASCII characters, A-Z as a-z.  A
    null or empty text has no partner; a text without words is only a copy of
    equal texts; a text under five words is one shingle; repeated rows are
    copies of each other; extra columns are not read.  A row with a null doc_id is
    linked like any other; class_id and copy_of are null if no row of theirs has an id.
    """
    spark = docs.sparkSession
    ship(spark)
    depth = matched_depth(similarity, recall=recall)
    signed = cut(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("doc"), "text").mapInArrow(
        _sign(depth), "doc_id long, doc long, text_class long, n_words long, keys array<long>"), "signed")
    classes = cut(signed.where("text_class is not null").groupBy("text_class").agg(
        F.min("doc_id").alias("copy_of"), F.count("*").alias("size"), F.max("n_words").alias("n_words"),
        F.first("keys").alias("keys"), F.min("doc").alias("holder")), "classes")
    # nodes of the tries with two or more texts; of equal ones (same members) the first is enough
    leaves = (classes.where("n_words > 0").select("text_class", F.posexplode("keys").alias("tree", "node")))
    nodes = (leaves.groupBy("node").agg(F.count("*").alias("members"), F.min("tree").alias("tree"),
                                        F.bit_xor(F.xxhash64("text_class")).alias("who"), F.min("text_class").alias("low"))
             .where("members > 1").groupBy("who", "members", "low").agg(F.min(F.struct("tree", "node")).alias("n"))
             .select("members", "low", "n.tree", "n.node"))
    shared = cut(leaves.drop("tree").join(nodes, "node"), "shared")
    group = components(shared.select(F.col("text_class").alias("a"), F.col("low").alias("b")))
    sizes = group.groupBy("root").agg(F.count("*").alias("texts"))
    placed = cut(group.join(sizes, "root").select(F.col("node").alias("text_class"), "root", "texts"), "groups")
    # small candidate components are one tile, the others a tile per pair of parts of a node
    small = placed.where(F.col("texts") <= tile).select(
        "text_class", F.col("root").alias("block"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("chunk"),
        F.lit(-1).alias("tree"))
    parts = F.ceil(F.col("members") / tile).cast("int")
    large = (shared.join(placed.where(F.col("texts") > tile).select("text_class"), "text_class")
             .withColumn("chunk", F.pmod(F.xxhash64("node", "text_class"), parts).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
             .select("text_class", F.col("node").alias("block"), F.least("chunk", "other").alias("i"),
                     F.greatest("chunk", "other").alias("j"), "chunk", "tree"))
    wanted = placed.select("text_class").join(classes.select("text_class", "holder", "size", "keys"), "text_class")
    # by the hash of id and text: an id may be null, or have several texts
    texts = docs.select(F.xxhash64("doc_id", "text").alias("holder"), "text").join(
        wanted.select("holder", F.col("text_class").alias("asked")), "holder")
    sets = texts.select("asked", "text").mapInArrow(_shingles_of, "text_class long, shingles array<long>").dropDuplicates(["text_class"])
    loaded = cut(sets.join(wanted.select("text_class", "size", "keys"), "text_class"), "sets")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = (small.union(large).join(loaded, "text_class").repartition(n, "block", "i", "j")
             .sortWithinPartitions("block", "i", "j", "text_class"))
    found = cut(tiles.mapInArrow(_verify(similarity), "text_class long, root long, n_texts long, n_docs long"), "links")
    counts = found.groupBy("text_class").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_docs").alias("n_docs"))
    linked = components(found.select(F.col("text_class").alias("a"), F.col("root").alias("b")))
    named = linked.join(classes.select(F.col("text_class").alias("node"), "copy_of"), "node")
    smallest = named.groupBy("root").agg(F.min("copy_of").alias("class_id"))
    # what every class knows
    known = cut(classes.select("text_class", "copy_of", "size")
                .join(counts, "text_class", "left")
                .join(linked.join(smallest, "root").select(F.col("node").alias("text_class"), "root", "class_id"), "text_class", "left")
                .select("text_class", "size", "copy_of", F.coalesce("class_id", "copy_of").alias("class_id"),
                        F.coalesce("root", "text_class").alias("group"),
                        (F.col("size") - 1 + F.coalesce("n_docs", F.lit(0))).alias("n_links"),
                        F.coalesce("n_texts", F.lit(0)).alias("n_linked_texts")), "known")
    # A class of many copies (a third of all rows, perhaps) is told its row by
    # broadcast: at most BROADCAST_CLASSES classes hold so large a share.
    rows = signed.select("doc_id", "doc", "text_class")
    total = signed.agg(F.count("*")).first()[0]
    large = F.col("size") > total // BROADCAST_CLASSES
    found = [c for c in known.columns if c not in ("text_class", "size")]
    hot = known.where(large).select(F.col("text_class").alias("hot_class"), *[F.col(c).alias("hot_" + c) for c in found])
    told = rows.join(F.broadcast(hot), F.col("text_class") == F.col("hot_class"), "left")
    # rows of large classes, and empty texts, take no part in the shuffled join
    settled = F.col("hot_class").isNotNull() | F.col("text_class").isNull()
    first = told.where(settled).select("doc_id", "doc", *[F.col("hot_" + c).alias(c) for c in found])
    second = told.where(~settled).select("doc_id", "doc", "text_class").join(
        known.where(~large), "text_class").select("doc_id", "doc", *found)
    return first.union(second).select(
        "doc_id", "doc", "group", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("copy_of", "doc_id").alias("copy_of"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_linked_texts", F.lit(0)).alias("n_linked_texts"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents")).drop("doc", "group")
