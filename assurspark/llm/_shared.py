"""Helpers shared by the training-data operators: the shared folder, lineage
cuts, bounded broadcasts and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words where an operator says "words": space and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application, and
    keep the Arrow batches of whole texts small."""
    if int(spark.conf.get(BATCH)) > BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_assurspark_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="run-pkg-"), "assurspark_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._assurspark_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor sees.
    Where the setting is unset (local tests) a temporary folder is set for it; on a
    cluster, whose executors would not share that, this raises."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is unset: it names the folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="run-llm-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write a table to the shared folder and read it again: the lineage ends
    there, and a lost executor costs a re-read instead of a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    # the shuffle files of this job are of no use once the table is written
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def free(written: DataFrame) -> None:
    """Delete a table that ``cut`` has written, once all that is made of it is written too."""
    files = written.inputFiles()
    if files:
        jvm = written.sparkSession._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(written.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges`` has long columns a, b (any order, repeats allowed).  Returns
    (node, root) for every node of an edge, root = smallest node of its
    component.  Each round is two group-bys on the edge list, written to the
    shared folder; a node's neighbours are reduced with min() before the
    shuffle, never gathered.  Ends when a round changes no edge (the star
    forest is the fixpoint), usually after a few rounds.
    """
    def directed(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()

    cur = cut(directed(edges), "edges")
    stamp = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of u is linked to the smallest node around u
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the smaller neighbours of u, and u, are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(least.select("u", F.col("m").alias("v")))).distinct()
        cur = cut(small, "edges")
        now = cur.agg(F.count("*").alias("n"),
                      F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if stamp == (now["n"], now["h"]):
            break
        stamp = (now["n"], now["h"])
    else:
        raise RuntimeError("connected components did not settle")
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(cur.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
