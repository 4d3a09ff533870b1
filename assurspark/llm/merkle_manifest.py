"""Merkle manifest of a dataset by time-forward processing.

Every document is a leaf; the leaves of a language, in doc_id order, are the first
level of a tree in which each run of FAN consecutive nodes has one parent, and the
tops of the languages are the leaves of one last tree.  A node's label is (last leaf
below it, level), so labels ascend from children to parents.

* Forward sweep: nodes are taken in label order; each sends its digest to its parent
  through a priority queue ordered by label.  Inside a block of FAN ** HEIGHT leaves
  the queue is a heap that holds a few messages a level; between blocks it is Spark's
  shuffle and sort, which spill to disk: the block tops are the leaves of the
  next round, until every tree has one node left.
* Reversed sweep: nodes are taken in descending label order; each sends its own proof,
  which its children lengthen by their siblings, down to the leaves.

No step holds more than a block, and no rank is counted in one task: leaves are range
partitioned by (language, doc_id), numbered inside a partition, and shifted by the
counts of the partitions before.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import cut, id_remainder, ship, table

FAN, HEIGHT = 2, 10
TAMPER_EVERY = 7
OUT_ROWS = 2000
_NODE = "grp string, rank long, size long, digest string"


def digest_of(fields: list[Column]) -> Column:
    """Lowercase hex sha256 of the fields: ``-`` for null, else byte count, ``:``, value."""
    def one(c: Column) -> Column:
        text = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[one(c) for c in fields]), 256)


def joined(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


# ------------------------------------------------------------------ inside a block
def forward(leaves: list[str], levels: int, fan: int) -> list[list[str]]:
    """Digests of all nodes of a block by level; the top is the last one's only node."""
    last = len(leaves) - 1
    nodes: list[list[str]] = [[] for _ in range(levels + 1)]
    queue: list[tuple[int, int, int, str]] = []  # label of the receiver, the sender's place, message

    def send(level: int, place: int, digest: str) -> None:
        nodes[level].append(digest)
        if level < levels:
            end = min((place // fan + 1) * fan ** (level + 1) - 1, last)
            heapq.heappush(queue, (end, level + 1, place, digest))

    for k, leaf in enumerate(leaves):
        send(0, k, leaf)
        while queue and queue[0][0] == k:      # nodes whose last leaf has come
            _, level, place, digest = heapq.heappop(queue)
            inputs = [digest]
            while queue and queue[0][:2] == (k, level):
                inputs.append(heapq.heappop(queue)[3])
            send(level, place // fan, joined(inputs))
    return nodes


def backward(nodes: list[list[str]], fan: int, above: str) -> list[str]:
    """Proof of each leaf: ``above`` (the top's) lengthened by the siblings on the way down.
    A proof is a step a level, ``place.siblings/``, from the leaf upwards."""
    last, levels = len(nodes[0]) - 1, len(nodes) - 1
    proofs = [""] * len(nodes[0])
    queue = [(-last, -levels, 0, above)]        # descending labels
    while queue:
        _, level, place, proof = heapq.heappop(queue)
        level = -level
        if level == 0:
            proofs[place] = proof
            continue
        below = nodes[level - 1]
        first = place * fan
        run = below[first:first + fan]
        for k in range(len(run)):
            end = min((first + k + 1) * fan ** (level - 1) - 1, last)
            heapq.heappush(queue, (-end, 1 - level, first + k, f"{k}.{''.join(run[:k] + run[k + 1:])}/{proof}"))
    return proofs


def fold(leaf: str, proof: str) -> str:
    """Root that a leaf and its proof lead to."""
    for step in proof.split("/")[:-1]:
        place, _, siblings = step.partition(".")
        cut_at = 64 * int(place)
        leaf = hashlib.sha256((siblings[:cut_at] + leaf + siblings[cut_at:]).encode()).hexdigest()
    return leaf


def siblings_of(proof: str) -> str:
    return "".join(step.partition(".")[2] for step in proof.split("/"))


def _levels(size: int, fan: int, height: int) -> int:
    levels, width = 0, 1
    while width < size and levels < height:
        levels, width = levels + 1, width * fan
    return levels


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of each (grp, block) of a partition sorted by them."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and held[0][:2] != row[:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= OUT_ROWS:
            yield packed()
            held = []
    if held:
        yield packed()


# ------------------------------------------------------------------ sweeps over blocks
def _sorted_blocks(nodes: DataFrame, block: int) -> DataFrame:
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (nodes.withColumn("block", F.col("block") if "block" in nodes.columns else F.expr(f"rank div {block}"))
            .repartition(n, "grp", "block").sortWithinPartitions("grp", "block", "rank"))


def _up(nodes: DataFrame, fan: int, height: int) -> DataFrame:
    """One round of the forward sweep: the top of each block."""
    block = fan ** height
    schema = pa.schema([("grp", pa.string()), ("rank", pa.int64()), ("size", pa.int64()), ("digest", pa.string())])

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for rows in _blocks(batches):
            grp, at, size = rows[0][:3]
            nodes_of = forward([r[4] for r in rows], _levels(size, fan, height), fan)
            yield grp, at, -(-size // block), nodes_of[-1][0]

    return _sorted_blocks(nodes, block).select("grp", "block", "size", "rank", "digest").mapInArrow(
        lambda batches: _batches(tops(batches), schema), _NODE)


def _down(nodes: DataFrame, messages: DataFrame, fan: int, height: int, last: bool) -> DataFrame:
    """One round of the reversed sweep.  ``messages``: grp, block, proof, subroot, root of each
    block's top.  Returns the same of every node, with its payload; proofs are
    folded and hashed for the leaves (``last``)."""
    block = fan ** height
    nothing = F.lit(None).cast("string")
    both = (nodes.select("grp", F.expr(f"rank div {block}").alias("block"), "rank", "size", "digest", "doc_id", "other",
                         nothing.alias("proof"), nothing.alias("subroot"), nothing.alias("root"))
            .unionByName(messages.select("grp", "block", F.lit(-1).cast("long").alias("rank"), F.lit(0).cast("long").alias("size"),
                                         nothing.alias("digest"), F.lit(None).cast("long").alias("doc_id"), nothing.alias("other"),
                                         "proof", "subroot", "root")))
    text, long, flag = pa.string(), pa.int64(), pa.bool_()
    if last:
        fields = [("doc_id", long), ("leaf", text), ("subroot", text), ("root", text), ("proof_sha256", text),
                  ("folded_root", text), ("verified", flag)]
    else:
        fields = [("grp", text), ("block", long), ("digest", text), ("other", text), ("proof", text), ("subroot", text), ("root", text)]
    types = {text: "string", long: "long", flag: "boolean"}

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for rows in _blocks(batches):
            message, own = rows[0], rows[1:]        # its rank is -1
            proof, subroot, root = message[7:10]
            tree = forward([r[4] for r in own], _levels(own[0][3], fan, height), fan)
            for r, p in zip(own, backward(tree, fan, proof), strict=True):
                if not last:
                    yield r[0], r[2], r[4], r[6], p, subroot, root
                    continue
                folded = fold(r[6] or r[4], p)
                yield (r[5], r[4], subroot, root, hashlib.sha256(siblings_of(p).encode()).hexdigest(), folded, folded == root)

    return _sorted_blocks(both, block).mapInArrow(
        lambda batches: _batches(rows_of(batches), pa.schema(fields)), ", ".join(f"{k} {types[v]}" for k, v in fields))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank`` (place inside ``grp`` by ``order``) and ``size`` (rows of the group)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["grp", *order, "_tie"]  # repeated rows may fall into several partitions
    placed = cut(rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *by)
                 .sortWithinPartitions(*by).drop("_tie").withColumn("_m", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_m", 33)
    counts = placed.groupBy("grp", part.alias("_p")).agg(F.min("_m").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy("grp")
    counts = counts.select("grp", "_p", "_first", F.sum("_n").over(group).alias("size"),
                           (F.sum("_n").over(group.orderBy("_p")) - F.col("_n")).alias("_before"))
    return (placed.withColumn("_p", part).join(counts, ["grp", "_p"])
            .withColumn("rank", F.col("_m") - F.col("_first") + F.col("_before")).drop("_p", "_m", "_first", "_before"))


def _forest(nodes: DataFrame, fan: int, height: int) -> list[DataFrame]:
    """Rounds of the forward sweep; the last has one node a group."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("size")).first()[0] or 0) > 1:
        tops = _up(rounds[-1], fan, height)
        rounds.append(cut(tops.withColumn("doc_id", F.lit(None).cast("long")).withColumn("other", F.lit(None).cast("string")), "tops"))
    return rounds


def _proofs(rounds: list[DataFrame], messages: DataFrame, fan: int, height: int, last: bool) -> DataFrame:
    for k in range(len(rounds) - 1, -1, -1):
        messages = _down(rounds[k], messages, fan, height, last and k == 0)
    return messages


def manifest(leaves: DataFrame, fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """Manifest of (lang, doc_id, digest, other) rows: doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified.

    ``digest`` is the leaf (hex), ``other`` the leaf to be checked against the
    manifest (null: the leaf itself).  Null languages are one group, ordered first;
    null ids come before all others; rows of one id are ordered by digest, so
    repeated rows are leaves of their own with equal digests; a lone leaf is its
    subroot and has no siblings there; an empty table gives no rows.
    """
    ship(leaves.sparkSession)
    group = F.when(F.col("lang").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "lang"))  # '-' < '='
    start = cut(leaves.select(group.alias("grp"), "doc_id", "digest", "other"), "leaves")
    langs = _forest(cut(ranked(start, ["doc_id", "digest"]), "ranked"), fan, height)
    subroots = langs[-1].select(F.lit("").alias("grp"), F.col("grp").alias("other"), "digest")
    top = _forest(cut(ranked(subroots, ["other"]).withColumn("doc_id", F.lit(None).cast("long")), "subroots"), fan, height)
    nothing = F.lit(None).cast("string")
    message = top[-1].select("grp", F.lit(0).cast("long").alias("block"), F.lit("").alias("proof"), nothing.alias("subroot"),
                             F.col("digest").alias("root"))
    message = _proofs(top, message, fan, height, last=False).select(
        F.col("other").alias("grp"), F.lit(0).cast("long").alias("block"), "proof", F.col("digest").alias("subroot"), "root")
    return _proofs(langs, message, fan, height, last=True)


def leaves_of(docs: DataFrame, every: int = TAMPER_EVERY) -> DataFrame:
    """(lang, doc_id, digest, other) of documents: ``other`` is the leaf with
    n_chars + 1 where ``every`` divides crc32(doc_id as text) (a null id counts as
    the empty text; a null n_chars stays).  Long texts are hashed whole; a null
    field differs from an empty one; other columns are not read."""
    fields = {k: F.col(k) for k in ("doc_id", "source", "lang", "n_chars", "text")}
    tampered = digest_of(list((fields | {"n_chars": F.col("n_chars") + 1}).values()))
    return docs.select("lang", "doc_id", digest_of(list(fields.values())).alias("digest"),
                       F.when((id_remainder(F.col("doc_id"), every) == 0) & F.col("n_chars").isNotNull(), tampered).alias("other"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(leaves_of(table(spark, sf_dir, "documents")))


def manifest_sql(every: int = TAMPER_EVERY) -> str:
    """DuckDB SQL for the query's rows, where ids are distinct and not null."""
    def leaf(n_chars: str) -> str:
        fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
        return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}) || ':' || {c} END" for c in fields) + ")"

    return f"""WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS grp, {leaf('n_chars')} AS leaf, {leaf('(n_chars + 1)')} AS other, n_chars,
         xor(list_reduce(list_concat([4294967295], list_transform(range(strlen(CAST(doc_id AS VARCHAR))),
           lambda k: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(k + 1 AS INTEGER), 1)) AS BIGINT))),
           lambda c, b: xor(c // 256, steps[(xor(c, b) % 256) + 1])), 4294967295) AS h
  FROM documents, crc),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id) - 1 AS pos FROM leaves),
node AS (
  SELECT 0 AS lvl, grp, pos, leaf AS digest FROM placed
  UNION ALL
  SELECT lvl + 1, grp, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM node) WHERE n > 1 GROUP BY lvl, grp, pos // 2),
top AS (SELECT grp, max(lvl) AS height FROM node GROUP BY grp),
subroots AS (
  SELECT grp, digest AS subroot, height, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos
  FROM node JOIN top USING (grp) WHERE lvl = height),
upper_node AS (
  SELECT 0 AS lvl, pos, subroot AS digest FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM upper_node) WHERE n > 1 GROUP BY lvl, pos // 2),
root AS (SELECT lvl AS height, digest AS root FROM upper_node ORDER BY lvl DESC LIMIT 1),
step AS (
  SELECT doc_id, p.lvl AS no, (p.pos >> p.lvl) % 2 AS side, sibling.digest
  FROM (SELECT doc_id, grp, pos, unnest(range(height)) AS lvl FROM placed JOIN top USING (grp)) p
  LEFT JOIN node sibling ON sibling.grp = p.grp AND sibling.lvl = p.lvl AND sibling.pos = xor(p.pos >> p.lvl, 1)
  UNION ALL
  SELECT doc_id, u.height + u.lvl, (u.pos >> u.lvl) % 2, sibling.digest
  FROM placed JOIN (SELECT grp, s.height, pos, unnest(range(root.height)) AS lvl FROM subroots s, root) u USING (grp)
  LEFT JOIN upper_node sibling ON sibling.lvl = u.lvl AND sibling.pos = xor(u.pos >> u.lvl, 1)),
proof AS (SELECT doc_id, sha256(coalesce(string_agg(digest, '' ORDER BY no), '')) AS proof_sha256 FROM step GROUP BY doc_id),
folded AS (
  SELECT doc_id, 0 AS no, CASE WHEN h % {every} = 0 AND n_chars IS NOT NULL THEN other ELSE leaf END AS digest FROM placed
  UNION ALL
  SELECT f.doc_id, f.no + 1, sha256(CASE WHEN s.side = 1 THEN coalesce(s.digest, '') || f.digest ELSE f.digest || coalesce(s.digest, '') END)
  FROM folded f JOIN step s ON s.doc_id = f.doc_id AND s.no = f.no)
SELECT placed.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       arg_max(folded.digest, folded.no) AS folded_root, arg_max(folded.digest, folded.no) = root AS verified
FROM placed JOIN subroots USING (grp) JOIN folded ON folded.doc_id = placed.doc_id LEFT JOIN proof ON proof.doc_id = placed.doc_id, root
GROUP BY placed.doc_id, leaf, subroot, root, proof_sha256"""
