"""The corpus pipeline: language ID, near-duplicate removal, benchmark
decontamination, source mixing and token files over the documents table.

Each stage takes (spark, docs, sf_dir), works on every row that the stage
before kept, and returns a DataFrame that is written as Parquet and read again
as the next stage's input.  All stages but the last return the columns of
``documents``; columns beyond them are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assurspark.llm._shared import cut, id_remainder, ship, table
from assurspark.llm.decontamination import contamination
from assurspark.llm.language_id import UNKNOWN, fit_languages, predict_languages
from assurspark.llm.ngram_join import ngram_join
from assurspark.llm.source_mixing import mix_rows, unit_columns
from assurspark.llm.token_files import token_digest

#: A document whose calibrated language probability is lower is rejected.
LEAST_LANGUAGE_SCORE = 0.5


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns c0, c1, ..., so that no carried column clashes
    with one a stage adds, and the new name of each column."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), dict(reversed([(n.lower(), c) for n, c in zip(docs.columns, names, strict=True)]))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter (``und``) and those whose language is
    uncertain.  Null and empty texts go; repeated rows are judged alike."""
    ship(spark)
    model = fit_languages(docs.where(id_remainder(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang"))
    plain, at = _plain(docs)
    judged = predict_languages(plain, model, tuple(plain.columns), at["text"])
    kept = judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(*plain.columns).toDF(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents connected by five-word-shingle similarity of 0.8 or
    more, the one with the smallest doc_id stays (one row of it).  Texts
    without words have no partner but equal texts; empty texts all stay."""
    found = cut(ngram_join(docs.select("doc_id", "text")).select("doc_id", "doc", "group"), "found")
    rows = found.groupBy("doc_id", "doc", "group").agg(F.count("*").alias("rows"))
    best = (rows.where("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "doc", "rows")).alias("m"))
            .select(F.col("m.doc").alias("doc"), F.col("m.rows").alias("rows")))
    plain, at = _plain(docs)
    keyed = plain.withColumn("doc", F.xxhash64(at["doc_id"], at["text"]))
    # rows that stand alone are only filtered; of repeated ones a single one is taken
    free = found.where("group is null").select("doc").distinct()
    alone = keyed.join(best.where("rows = 1").select("doc").union(free), "doc", "left_semi")
    repeated = keyed.join(best.where("rows > 1").select("doc"), "doc", "left_semi").dropDuplicates(["doc"])
    return alone.union(repeated).select(*plain.columns).toDF(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go: at least one word in twenty inside a window
    of 13 words that a benchmark item has.  Texts without words stay."""
    bad = (contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
           .where("contaminated").select("doc").distinct())
    plain, at = _plain(docs)
    keyed = plain.withColumn("doc", F.xxhash64(at["doc_id"], at["text"]))
    return keyed.join(bad, "doc", "left_anti").select(*plain.columns).toDF(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it: rows are dropped or repeated so
    that the sources' words come near their target weights."""
    plain, at = _plain(docs)
    rows = cut(plain.select("*", *unit_columns(F.col(at["doc_id"]), F.col(at["text"]), F.col(at["source"]))), "units")
    copies = mix_rows(rows.select("id", "key", "source", "size")).where("copies > 0").select("id", "copies")
    taken = rows.join(copies, "id").withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*plain.columns).toDF(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and their digest per row: doc_id, start,
    n_tokens, ids_crc32."""
    return token_digest(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("token_files", token_stage),
]

#: Hash-driven rounding and trained models have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
