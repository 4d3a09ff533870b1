"""Benchmark decontamination with a positional inverted index (native).

The words of the training documents that occur in any benchmark item are stored
as postings (document, position, term).  Every window of 13 item words is looked
up from its rarest term: a posting of that term proposes an alignment
(document, item, shift = document position - item position).  The alignment's
other terms are intersected with the postings at their offset-adjusted
positions; runs of at least a window's length are exact phrase matches.

DataFrame functions only.  Terms that no item uses cannot take part in a match
and are not stored; nothing else is left out.  Tables derived from the
benchmark are joined without hints, so Spark broadcasts them only while their
measured size is under its threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import LOWER, UPPER, ascii_lower, cut, table

#: A word: digits, letters and everything beyond ASCII.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: Stored once per document at the position after its last word: the document's length.
END = "\x00"
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20


def item_words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(ITEM_WORD), F.lit(0))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words) of the items with a word; item tells equal ids apart by text."""
    return (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
            .select(F.xxhash64("item_id", "text").alias("item"), "item_id", item_words(F.col("text")).alias("words"))
            .where(F.size("words") > 0).distinct())


def item_terms(items: DataFrame) -> DataFrame:
    """(item, n, at, term): the n words of every item by position; term = 64-bit hash of the word."""
    return (items.select("item", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
            .select("item", "n", "at", F.xxhash64("word").alias("term")).distinct())


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (doc, doc_id, pos, term) of the documents' words that occur in
    ``terms``, with one END posting per row of ``docs``, stored in the shared
    folder.  doc = hash of id and text, so rows that share an id are told apart."""
    wanted = (terms.select("term").union(terms.sparkSession.range(1).select(F.xxhash64(F.lit(END)).alias("term")))
              .distinct())
    spread = docs.select(
        F.xxhash64("doc_id", "text").alias("doc"), "doc_id",
        F.posexplode(F.concat(item_words(F.col("text")), F.array(F.lit(END)))).alias("pos", "word"))
    return cut(spread.select("doc", "doc_id", "pos", F.xxhash64("word").alias("term"))
               .join(wanted, "term", "left_semi").select("doc", "doc_id", "pos", "term"), "postings")


def rarest_terms(index: DataFrame, terms: DataFrame, window: int = WINDOW) -> DataFrame:
    """(term, item, at): for every window of every item its rarest term in the
    corpus; windows with a term that the corpus lacks cannot occur and are left out."""
    counts = index.groupBy("term").agg(F.count("*").alias("df"))
    known = terms.join(counts, "term", "left").select("item", "n", "at", "term", F.coalesce("df", F.lit(0)).alias("df"))
    size = F.least(F.lit(window), F.col("n"))
    first = F.explode(F.sequence(F.greatest(F.lit(0), F.col("at") - size + 1), F.least(F.col("at"), F.col("n") - size)))
    rarest = (known.select("item", "at", "term", "df", first.alias("start")).groupBy("item", "start")
              .agg(F.min(F.struct("df", "at", "term")).alias("r")))
    return rarest.where("r.df > 0").select(F.col("r.term").alias("term"), "item", F.col("r.at").alias("at")).distinct()


def phrase_matches(index: DataFrame, terms: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, item, first, last): the document words [first, last] that equal a
    run of at least ``window`` item words (a shorter item: all its words)."""
    # written first: its size is known before the postings are planned to meet it
    lead = cut(rarest_terms(index, terms, window), "lead")
    aligned = (index.join(lead, "term").select("doc", "item", (F.col("pos") - F.col("at")).alias("shift")).distinct())
    asked = aligned.join(terms, "item").select(
        "doc", "item", "n", "shift", (F.col("shift") + F.col("at")).alias("pos"), "term").where("pos >= 0")
    found = asked.join(index.select("doc", "pos", "term"), ["doc", "pos", "term"]).select(
        "doc", "item", "n", "shift", "pos").distinct()
    by_run = Window.partitionBy("doc", "item", "shift").orderBy("pos")  # at most the words of one item
    runs = (found.withColumn("run", F.col("pos") - F.row_number().over(by_run))
            .groupBy("doc", "item", "n", "shift", "run")
            .agg(F.min("pos").alias("first"), F.max("pos").alias("last")))
    return runs.where(F.col("last") - F.col("first") + 1 >= F.least(F.lit(window), F.col("n"))).select(
        "doc", "item", "first", "last")


def proximity_matches(index: DataFrame, terms: DataFrame, reach: int) -> DataFrame:
    """(doc, item, pos): postings of an item's rarest term that have all other
    distinct terms of the item at most ``reach`` words away, in any order."""
    counts = index.groupBy("term").agg(F.count("*").alias("df"))
    wanted = terms.select("item", "term").distinct()
    lead = (wanted.join(counts, "term", "left").groupBy("item")
            .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")).alias("r"), F.count("*").alias("kinds"))
            .where("r.df > 0").select("item", "kinds", F.col("r.term").alias("term")))
    near = index.join(lead, "term").select("doc", "item", "kinds", F.col("pos").alias("center"))
    cell = F.explode(F.array(*[(F.floor(F.col("center") / (reach + 1)) + k) for k in (-1, 0, 1)]))
    asked = near.join(wanted, "item").withColumn("cell", cell)
    posted = index.select("doc", "term", "pos", F.floor(F.col("pos") / (reach + 1)).alias("cell"))
    return (asked.join(posted, ["doc", "term", "cell"]).where(F.abs(F.col("pos") - F.col("center")) <= reach)
            .groupBy("doc", "item", "kinds", "center").agg(F.count_distinct("term").alias("seen"))
            .where("seen = kinds").select("doc", "item", F.col("center").alias("pos")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of (doc_id, text): doc, doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    n_hit counts the words inside any matched window; contaminated = n_hit > 0
    and 20 n_hit >= n_words.  A null or empty text has no words and is clean;
    an item without words matches nothing; a null item id counts as the empty
    text; repeated rows get equal results; an empty benchmark leaves all
    documents clean; extra columns are not read.
    """
    items = cut(benchmark_items(benchmark), "items")
    terms = cut(item_terms(items), "terms")
    index = build_index(docs, terms)
    matches = cut(phrase_matches(index, terms, window), "matches")
    hit = (matches.select("doc", F.explode(F.sequence("first", "last")).alias("pos")).distinct()
           .groupBy("doc").agg(F.count("*").alias("n_hit")))
    named = (matches.join(items.select("item", "item_id"), "item").select("doc", "item_id").distinct()
             .groupBy("doc").agg(F.count("*").alias("n_items"),
                                 F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("item_id"))), 256).alias("items_sha256")))
    lengths = index.where(F.col("term") == F.xxhash64(F.lit(END))).select(
        "doc", "doc_id", F.col("pos").cast("long").alias("n_words"))
    out = lengths.join(hit.join(named, "doc"), "doc", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select("doc", "doc_id", "n_words", n_hit.cast("long").alias("n_hit"),
                      F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                      ((n_hit > 0) & (F.lit(ONE_IN) * n_hit >= F.col("n_words"))).alias("contaminated"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                         table(spark, sf_dir, "benchmark")).drop("doc")


def contamination_sql(documents: str = "documents") -> str:
    words = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ITEM_WORD}')")
    return f"""
WITH item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {words} AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, size, list_slice(w, s + 1, s + size) AS g
  FROM (SELECT item_id, w, size, unnest(range(0, len(w) - size + 1)) AS s
        FROM (SELECT item_id, w, least({WINDOW}, len(w)) AS size FROM item WHERE len(w) > 0))
), doc AS (
  SELECT doc_id, md5(coalesce(text, '')) AS body, {words} AS w FROM {documents}
), one AS (
  SELECT DISTINCT doc_id, body, w FROM doc
), spot AS (
  SELECT doc_id, body, size, s, list_slice(w, s + 1, s + size) AS g
  FROM (SELECT doc_id, body, w, size, unnest(range(0, len(w) - size + 1)) AS s
        FROM one CROSS JOIN (SELECT DISTINCT size FROM win) WHERE len(w) >= size)
), hit AS (
  SELECT spot.doc_id, spot.body, win.item_id, s, win.size FROM spot JOIN win ON spot.size = win.size AND spot.g = win.g
), n_hit AS (
  SELECT doc_id, body, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, body, unnest(range(s, s + size)) AS p FROM hit) GROUP BY 1, 2
), named AS (
  SELECT doc_id, body, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, body, item_id FROM hit) GROUP BY 1, 2
)
SELECT doc.doc_id, CAST(len(doc.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n_items, 0) AS BIGINT) AS n_items,
       coalesce(named.items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit.n_hit, 0) > 0 AND {ONE_IN} * coalesce(n_hit.n_hit, 0) >= len(doc.w) AS contaminated
FROM doc LEFT JOIN n_hit ON doc.doc_id IS NOT DISTINCT FROM n_hit.doc_id AND doc.body = n_hit.body
LEFT JOIN named ON doc.doc_id IS NOT DISTINCT FROM named.doc_id AND doc.body = named.body
"""
