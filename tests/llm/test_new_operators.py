"""Repeated passages, spelling variants and the manifest against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from assurspark.llm import merkle_manifest, source_mixing, spelling_variants, substring_dedup
from assurspark.llm._shared import cut
from assurspark.llm.registry import QUERIES

from . import brute


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]


# ---- 11
REPEATS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def key(row):
    return (row[0] is not None, row)


@pytest.fixture(scope="module")
def passages(spark):
    """Shared passages of 12 to 40 words at every place of a text, copies, near copies, null and repeated ids."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(3000)]
    shared = [[rng.choice(words) for _ in range(n)] for n in (12, 13, 14, 20, 40)]
    rows = []
    for i in range(80):
        w = [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(shared)
        rows.append((rng.choice([None, 7, i, i, i]), rng.choice([" ", "\n", "\t "]).join(w)))
    rows += rows[:5] + [(None, None), (500, ""), (501, " \n"), (502, "a b " * 30), (503, "a b " * 30), (504, "a b " * 20_000)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc", F.lit(1)).withColumn("marks", F.lit("x"))


def test_substring_dedup_whole_table(corpus, odd, passages):
    for rows, df in ((corpus[0], corpus[1]), odd, passages):
        got = rows_of(substring_dedup.remove_repeats(df), *REPEATS)
        assert sorted(got, key=key) == sorted(brute.window_repeats(rows), key=key)


def test_substring_dedup_keeps_the_other_words(spark):
    passage = " ".join(f"p{k}" for k in range(15))
    rows = [(1, f"a {passage} b"), (2, f"c  d\n{passage}\te {passage}"), (3, f"{passage} x {passage}")]
    got = rows_of(substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")),
                  "doc_id", "kept", "n_repeats")
    assert sorted(got) == [(1, rows[0][1], 0), (2, "c d e", 2), (3, "x", 2)]


def test_substring_dedup_longer_prefixes_change_nothing(spark, passages, monkeypatch):
    """Every prefix is too large: groups are made of both edges."""
    rows, df = passages
    whole = substring_dedup.grouped
    monkeypatch.setattr(substring_dedup, "grouped", lambda s: whole(s, group=1, part=1 << 40))
    monkeypatch.setattr(substring_dedup, "HELD", 50)
    got = rows_of(substring_dedup.remove_repeats(df), *REPEATS)
    assert sorted(got, key=key) == sorted(brute.window_repeats(rows), key=key)


def test_prefixes_are_lengthened_where_they_hold_too_much(spark):
    rows = [(1, k % 20) for k in range(40)] + [(2, 1)] * 3 + [(3, k) for k in range(4)]
    df = spark.createDataFrame(rows, "e1 long, e2 long")
    sizes = [n for _, n in rows_of(substring_dedup.grouped(df, group=5, part=1 << 40).groupBy("grp").count(), "grp", "count")]
    assert sorted(sizes) == [2] * 20 + [3, 4]      # (1, *) by both edges, 2 and 3 by one
    assert substring_dedup.grouped(df, group=100, part=1).select("grp").distinct().count() == 3


def test_substring_dedup_other_windows_and_empty(spark, passages, empty):
    rows, df = passages
    for window, prefix in ((8, 3), (20, 9)):
        got = rows_of(substring_dedup.remove_repeats(df, window, prefix), *REPEATS)
        assert sorted(got, key=key) == sorted(brute.window_repeats(rows, window), key=key)
    assert substring_dedup.remove_repeats(empty).collect() == []


# ---- 12
VARIANT = ("word", "form", "root", "n", "n_near", "form_n")


def test_corpus_words(corpus, odd):
    for rows, df in ((corpus[0], corpus[1]), odd):
        assert dict(rows_of(spelling_variants.corpus_words(df), "word", "n")) == brute.corpus_words(rows)
        few = spelling_variants.corpus_words(df, min_length=1, min_count=1, drop_every=3)
        assert dict(rows_of(few, "word", "n")) == {w: n for w, n in brute.corpus_words(rows, 3, 1, 1).items() if w}


def test_spelling_variants_of_the_small_table(spark, corpus):
    want = brute.variants(brute.corpus_words(corpus[0]))
    got = {r[0]: r[1:] for r in rows_of(QUERIES["op12_spelling_variants"](spark, corpus[2]), *VARIANT)}
    assert got == want and any(v[0] for v in want.values())


def test_spelling_variants_ties_chains_and_tiles(spark):
    rng = random.Random(3)
    words = set()
    while len(words) < 500:
        w = "".join(rng.choice("abcé") for _ in range(rng.randrange(4, 8)))
        words |= {w, w + "x", w[1:] or w, w[:2] + "z" + w[3:]}
    words |= {"m" * 3000, "m" * 3001, "m" * 2999 + "n"}    # very long ones
    counts = {w: rng.choice([5, 5, 25, 130, 700, 5000]) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = brute.variants(counts)
    for tile in (512, 7):
        got = {r[0]: r[1:] for r in rows_of(spelling_variants.variant_groups(df, tile=tile), *VARIANT)}
        assert got == want
    assert any(v[0] and want[v[0]][0] for v in want.values())   # a chain


def test_spelling_variants_of_nothing(empty):
    assert spelling_variants.variant_groups(spelling_variants.corpus_words(empty)).collect() == []


def test_near_pairs_lie_in_adjacent_blocks():
    steps = spelling_variants.steps()
    both = {tuple(s) for s in steps} | {tuple(-x for x in s) for s in steps}
    assert len(both) == 2 * len(steps) - 1
    classes = spelling_variants.CLASSES
    assert sorted("".join(classes)) == sorted(spelling_variants.LETTERS)
    at = lambda w: [sum(x in c for x in w) for c in classes]
    for a, b in (("abcdef", "abcdeg"), ("abcdef", "abcdéf"), ("abcdef", "abcdefz"), ("abcdef", "bcdef")):
        assert tuple(x - y for x, y in zip(at(a), at(b), strict=True)) in both


# ---- 13
MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest_of_the_small_table(spark, corpus):
    rows = [tuple(r) for r in corpus[1].select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = rows_of(QUERIES["op13_merkle_manifest"](spark, corpus[2]), *MANIFEST)
    assert sorted(got) == sorted(brute.manifest(rows)) and len({r[-1] for r in got}) == 2


def test_manifest_blocks_nulls_and_repeated_rows(spark, empty):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", None]), rng.choice(["en", "en", "fr", "", "-", None]), rng.choice([None, 3, i]), f"t{i % 11}")
            for i in range(150)]
    rows += rows[:10] * 3 + [(None, None, None, None, None)] * 5 + [(900, "s", "one", 1, "é" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.withColumn("grp", F.lit("x")).withColumn("digest", F.lit(1)).withColumn("rank", F.lit(2))
    want = sorted(brute.manifest(rows), key=str)
    for height in (1, 2, 10):     # many rounds, some, one
        got = rows_of(merkle_manifest.manifest(merkle_manifest.leaves_of(df), height=height), *MANIFEST)
        assert sorted(got, key=str) == want
    none = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle_manifest.manifest(merkle_manifest.leaves_of(none)).collect() == []
    one = merkle_manifest.manifest(merkle_manifest.leaves_of(df.where("doc_id = 900"))).collect()
    assert [(r["leaf"], r["verified"]) for r in one] == [(one[0]["root"], True)]


@pytest.mark.parametrize("fan", [2, 3, 5])
def test_sweeps_inside_a_block(fan):
    for n in (1, 2, 3, 4, 7, 9, 26):
        leaves = [merkle_manifest.joined([str(k)]) for k in range(n)]
        levels = merkle_manifest._levels(n, fan, 10)
        nodes = merkle_manifest.forward(leaves, levels, fan)
        assert [len(x) for x in nodes][-1] == 1
        for level in range(levels):
            assert nodes[level + 1] == [merkle_manifest.joined(nodes[level][k:k + fan]) for k in range(0, len(nodes[level]), fan)]
        proofs = merkle_manifest.backward(nodes, fan, "")
        assert all(merkle_manifest.fold(x, p) == nodes[-1][0] for x, p in zip(leaves, proofs, strict=True))
        assert n == 1 or merkle_manifest.fold(merkle_manifest.joined(["other"]), proofs[0]) != nodes[-1][0]


# ---- 9
def test_repeated_rows_are_dealt_to_many_leaves(spark):
    """100,000 equal rows, and others: no leaf holds many rows, and each source comes near its target."""
    rows = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three").alias("text"), F.lit("a").alias("source"))
    rows = rows.union(spark.range(300).selectExpr("id AS doc_id", "concat('w ', id) AS text", "'b' AS source"))
    units = rows.select(*source_mixing.unit_columns(F.col("doc_id"), F.col("text"), F.col("source")))
    dealt = source_mixing._dealt(cut(units, "units"))
    leaves = 100_000 // source_mixing.FAN_IN
    sizes = dealt.groupBy(F.pmod("deal", F.lit(leaves)).alias("leaf")).count()
    assert sizes.agg(F.max("count")).first()[0] < 3 * source_mixing.FAN_IN
    assert dealt.where("deal = key").count() == 300           # the others keep the leaf of their key
    mixed = source_mixing.mix_sources(rows)
    for r in mixed.groupBy("source_size").agg(F.count("*").alias("n"), F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) <= 0.01 * r["target"] + 10
