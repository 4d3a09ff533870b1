"""Mixing sources to target weights by pivotal dependent rounding (native).

Every document of a source gets the same expected number of copies
x = target / source size, between 0 and 2.  The whole part of x is certain;
the fractional parts are rounded by the pivotal method: two fractions p, q meet
and mass moves between them at random until one of them is 0 or 1, the other
carries on.  Documents meet in a reduction tree: up to ``FAN_IN`` documents of
one source and of similar size form a leaf, the one fraction each leaf leaves
over goes to the next level, and so on up to one fraction per source.  Because
sums of fractions are kept and partners have similar sizes, the words taken
stay next to the target, while each document's expectation is exactly x.

Nothing but DataFrame functions is used.  Leaves are bounded (they are dealt by
hash inside a size class of a source), so a source with a third of all rows is
just more leaves.  All random numbers are hashes of (seed, level, node), so
reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import WORD, cut, table

FAN_IN = 32
SEED = 20240229


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(docs: DataFrame, share: float = 1.5, limit: float = 2.0,
                   cycle: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """(source, source_size, target) per source from (source, size) rows.

    Sources in code point order, null last, weigh ``cycle`` repeating and share
    ``share`` times all sizes; a target stops at ``limit`` times its source's
    size and the excess goes to the others by weight.  With L = targets per
    unit of weight, target = min(cap, L * weight): the capped sources are those
    with the smallest cap / weight, so L comes from running sums over the
    sources in that order.  One row per source: documents are summed first.
    """
    per = docs.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    ranked = (per.withColumn("rank", F.row_number().over(order))
              .withColumn("weight", F.element_at(weights, ((F.col("rank") - 1) % len(cycle) + 1).cast("int")))
              .withColumn("cap", F.col("source_size") * F.lit(limit)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the first source in ratio order whose level stays under its own ratio fixes L
    levels = ranked.withColumn("level", level).withColumn(
        "fits", F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level")))
    common = levels.withColumn("common", F.first("fits", ignorenulls=True).over(everything))
    target = F.when(F.col("common").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("common") * F.col("weight")))
    return common.select("source", "source_size", target.cast("double").alias("target"))


def _uniform(*cols: Column) -> Column:
    """A number in [0, 1) from a hash of the columns."""
    return (F.xxhash64(F.lit(SEED), *cols).bitwiseAND(F.lit((1 << 53) - 1))) / F.lit(float(1 << 53))


def _meet(acc: Column, x: Column) -> Column:
    """One pivotal step: the carried fraction ``acc.p`` of unit ``acc.id``
    meets fraction ``x.p`` of unit ``x.id``; ``acc.won`` lists the units that
    were settled at one, the unlisted are settled at zero."""
    p, q = acc["p"], x["p"]
    s = p + q
    low = s < 1.0          # mass moves until one of them is 0
    u = x["u"]
    # low: the carried unit keeps the mass with probability p / s
    # high: the carried unit becomes 1 with probability (1 - q) / (2 - s), the newcomer carries s - 1
    keep_low = u * s < p
    settle_carried = u * (2.0 - s) < (1.0 - q)
    keep = F.when(low, keep_low).otherwise(~settle_carried)
    won = F.when(low, acc["won"]).otherwise(F.concat(
        acc["won"], F.array(F.when(settle_carried, acc["id"]).otherwise(x["id"]))))
    return F.struct(F.when(keep, acc["id"]).otherwise(x["id"]).alias("id"),
                    F.when(keep, acc["key"]).otherwise(x["key"]).alias("key"), F.when(low, s).otherwise(s - 1.0).alias("p"), won.alias("won"))


def _reduce(units: DataFrame, level: int) -> DataFrame:
    """Settle all but one fraction of every node (source, at)."""
    item = F.struct("size", "key", "id", "p", _uniform(F.lit(level), F.col("key")).alias("u"))
    nodes = units.groupBy("source", "at").agg(F.sort_array(F.collect_list(item)).alias("xs"))
    start = F.struct(F.col("xs")[0]["id"].alias("id"), F.col("xs")[0]["key"].alias("key"), F.col("xs")[0]["p"].alias("p"),
                     F.array().cast("array<long>").alias("won"))
    done = F.aggregate(F.slice("xs", 2, F.greatest(F.size("xs") - 1, F.lit(0))), start, _meet)
    return nodes.select("source", "at", F.col("xs")[0]["size"].alias("size"), done.alias("d")).select(
        "source", "at", "size", F.col("d.id").alias("id"), F.col("d.key").alias("key"),
        F.col("d.p").alias("p"), F.col("d.won").alias("won"))


def mix_sources(docs: DataFrame, share: float = 1.5, limit: float = 2.0,
                cycle: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Every document with its number of copies in the mix.

    Input: columns doc_id, text, source (others are ignored).  Output: doc_id,
    size (words of the text), source_size, target (of its source), copies,
    taken = copies * size.

    Defined cases: a null or empty text has size 0 and takes 0 words (copies
    are still drawn); a null source is a source of its own, ordered last;
    repeated rows are separate documents; an empty table gives no rows; if all
    sizes are 0 every target is 0; clashing extra columns are not read.
    """
    rows = cut(docs.select("doc_id", *unit_columns(F.col("doc_id"), F.col("text"), F.col("source"))), "sized")
    copies = mix_rows(rows.select("id", "key", "source", "size"), share, limit, cycle)
    return rows.select("id", "doc_id").join(copies, "id").select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def unit_columns(doc_id: Column, text: Column, source: Column) -> list[Column]:
    """id (tells rows apart once they are written), key (what random numbers depend on), source, size."""
    return [F.monotonically_increasing_id().alias("id"), F.xxhash64(F.lit(SEED), doc_id, text).alias("key"),
            source.alias("source"), word_count(text).alias("size")]


def _dealt(rows: DataFrame) -> DataFrame:
    """Adds ``deal``, by which rows are dealt to leaves: the key, so that a row's leaf does not
    depend on where it is stored; rows that occur several times, which have one key,
    are told apart by their id, or all of them would fall into one leaf."""
    again = rows.groupBy("key").count().where("count > 1").select(F.col("key").alias("again"))
    return rows.join(again, F.col("key") == F.col("again"), "left").withColumn(
        "deal", F.when(F.col("again").isNotNull(), F.xxhash64("key", "id")).otherwise(F.col("key"))).drop("again")


def mix_rows(rows: DataFrame, share: float = 1.5, limit: float = 2.0, cycle: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """(id, size, source_size, target, copies) for written rows of (id, key, source, size)."""
    targets = cut(source_targets(rows.select("source", "size"), share, limit, cycle), "targets")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # leaves: size classes of a source (12 % wide), cut by hash into leaves of about FAN_IN documents
    size_class = F.floor(F.log1p(F.col("size").cast("double")) * 8).cast("int")
    classes = (rows.groupBy("source", size_class.alias("class")).count()
               .withColumn("leaves", F.ceil(F.col("count") / FAN_IN).cast("long")))
    upto = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("offset", F.coalesce(F.sum("leaves").over(upto), F.lit(0)).cast("long"))
    per_class = targets.alias("t").join(classes.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source"))).select(
        F.col("t.source").alias("of"), F.col("class").alias("of_class"), "leaves", "offset", expected.alias("x"), "source_size", "target")
    placed = _dealt(rows).withColumn("class", size_class).join(
        per_class, F.col("source").eqNullSafe(F.col("of")) & (F.col("class") == F.col("of_class"))
    ).select("id", "key", "source", "size", "x", "source_size", "target",
             (F.col("offset") + F.pmod(F.col("deal"), F.col("leaves"))).alias("at"))
    placed = cut(placed, "placed")
    units = placed.select("source", "at", "size", "key", "id", (F.col("x") - F.floor("x")).alias("p")).where(
        (F.col("p") > 1e-12) & (F.col("p") < 1 - 1e-12))
    winners = []
    level = 0
    while True:
        settled = cut(_reduce(units, level), f"level{level}")
        winners.append(settled.select(F.explode("won").alias("id")))
        top = settled.agg(F.max("at")).first()[0]
        if not top:
            # one fraction per source is left: it is drawn
            winners.append(settled.where(_uniform(F.lit(-1), F.col("key")) < F.col("p")).select("id"))
            break
        units = settled.select("source", F.floor(F.col("at") / FAN_IN).alias("at"), "size", "key", "id", "p")
        level += 1
    won = winners[0]
    for w in winners[1:]:
        won = won.union(w)
    won = won.select("id", F.lit(1).alias("extra"))
    whole = F.when(F.col("x") - F.floor("x") >= 1 - 1e-12, F.floor("x") + 1).otherwise(F.floor("x"))
    copies = (whole + F.coalesce("extra", F.lit(0))).cast("long")
    return (placed.join(won, "id", "left").withColumn("copies", copies)
            .select("id", "size", "source_size", "target", "copies"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
