"""Every operator against a plain version, on the driver's smallest table and on odd rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assurspark.llm import decontamination, language_id, line_dedup, lm_scoring, ngram_join, quality_classifier
from assurspark.llm import quality_rules, source_mixing, suffix_dedup, token_files
from assurspark.llm._shared import components, shared_dir

from . import brute


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]


def both(corpus, odd):
    return [(corpus[0], corpus[1]), odd]


# ---- 1
def test_ngram_join_finds_every_link(corpus, odd):
    for rows, df in both(corpus, odd):
        want = brute.near_duplicates(rows)
        got = {r[0]: r[1:] for r in rows_of(ngram_join.ngram_join(df), "doc_id", "class_id", "n_links")}
        assert got == {i: w for (i, _), w in zip(rows, want, strict=True)}


def test_ngram_join_tiles_and_repeated_rows(spark):
    rng = np.random.default_rng(1)
    base = [f"w{k}" for k in rng.integers(0, 10_000, 60)]
    rows = []
    for i in range(80):  # one large group of near copies, cut into many tiles
        w = list(base)
        for k in rng.integers(0, 60, rng.integers(0, 3)):
            w[k] = f"x{rng.integers(0, 10_000)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.near_duplicates(rows)
    got = {r[0]: r[1:] for r in rows_of(ngram_join.ngram_join(df, tile=7), "doc_id", "class_id", "n_links")}
    assert got == {i: w for (i, _), w in zip(rows, want, strict=True)}
    twice = ngram_join.ngram_join(df.union(df).union(df.sparkSession.createDataFrame([(None, rows[0][1])], df.schema)))
    assert twice.count() == 161


def test_ngram_join_links_null_and_repeated_ids(spark):
    base = [f"w{k}" for k in range(60)]
    near = " ".join([*base[:59], "x"])
    rows = [(None, near), (1, " ".join(base)), (2, "other words stand here alone"), (None, "z " + near), (7, "far " * 9), (7, near + " y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["text"]: r for r in ngram_join.ngram_join(df).join(
        df.select(F.xxhash64("doc_id", "text").alias("doc"), "text"), "doc").collect()}
    assert [got[t]["n_links"] for _, t in rows] == [3, 3, 0, 3, 0, 3]
    assert [got[t]["class_id"] for _, t in rows] == [1, 1, 2, 1, 7, 1]
    assert len({got[t]["group"] for _, t in rows}) == 3


def test_matched_depth_shortens_to_the_recall():
    assert ngram_join.matched_depth(0.8, 16, 8, 0.9995) == 4
    assert ngram_join.matched_depth(0.95, 16, 8, 0.9995) == 8
    assert ngram_join.matched_depth(0.3, 2, 8, 0.999) == 1


# ---- 2
def test_token_files_round_trip(spark, corpus, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.tokenizer_path())
    for rows, df in both(corpus, odd):
        want = brute.token_rows(rows, tokenizer)
        folder = shared_dir(spark) + "/t"
        written = token_files.write_tokens(df.select("doc_id", "text"), folder, token_files.tokenizer_path(), shard_docs=37)
        assert written.count() > 1
        got = token_files.read_tokens(spark, folder, written)
        assert sorted(rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32")) == sorted(want)
        ids = {r[0]: r[1] for r in rows_of(token_files.read_tokens(spark, folder, written, digest=False), "doc_id", "ids")}
        for doc_id, text in rows[:40]:
            assert ids[doc_id] == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_token_shards_are_read_one_document_at_a_time(spark, corpus):
    folder = shared_dir(spark) + "/t"
    written = token_files.write_tokens(corpus[1].select("doc_id", "text"), folder, token_files.tokenizer_path())
    filesystem, root = token_files.open_shared(folder)
    with filesystem.open_input_file(f"{root}/dictionary") as f:
        dictionary = f.read()
    shard = token_files.ShardReader(folder, "shard-000000", dictionary)
    assert len(shard) == written.first()["n_docs"] and list(shard.doc_id) == sorted(shard.doc_id)
    assert shard.ids(len(shard) - 1)[-1] == token_files.END_ID
    with pytest.raises(ValueError):
        token_files.ShardReader(folder, "shard-000000", b"another")


def test_token_ties_and_null_ids(spark):
    df = spark.createDataFrame([(2, "b"), (2, "b"), (None, "n"), (1, None)], "doc_id long, text string")
    got = sorted(rows_of(token_files.token_digest(df), "start", "doc_id", "n_tokens"))
    assert got == [(0, None, 2), (2, 1, 1), (3, 2, 2), (5, 2, 2)]


# ---- 3
def test_lm_base_counts(corpus, odd):
    for rows, df in both(corpus, odd):
        held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
        got = {r[0]: r[1:] for r in rows_of(lm_scoring.score_documents(df, df.where(~held), words=50),
                                            "doc_id", "n_tokens", "n_known", "train_tokens", "base_score")}
        for i, n, known, total, base in brute.base_scores(rows):
            assert got[i][:3] == (n, known, total)
            assert got[i][3] == pytest.approx(base, rel=1e-9)


def _trie(texts, order):
    """The same trie by plain counting."""
    levels = [{} for _ in range(order + 1)]
    for t in texts:
        b = b"\xff" * order + t + b"\xff"
        for i in range(order, len(b)):
            for k in range(order + 1):
                c = levels[k].setdefault(b[i - k:i], {})
                c[b[i]] = c.get(b[i], 0) + 1
    return levels


def _log10(levels, text, order):
    total, b = 0.0, b"\xff" * order + text + b"\xff"
    for i in range(order, len(b)):
        out = set()
        for k in range(order, -1, -1):
            seen = {s: c for s, c in levels[k].get(b[i - k:i], {}).items() if s not in out}
            if not seen:
                continue
            whole = sum(seen.values())
            if b[i] in seen:
                total += np.log10((seen[b[i]] - 0.5) / whole)
                break
            total += np.log10(0.5 * len(seen) / whole)
            out |= set(seen)
        else:
            total -= np.log10(256 - len(out))
    return total


def test_ppm_equals_plain_counting(corpus):
    rows, df, _ = corpus
    train = df.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
    texts = [(t or "").translate(brute.LOWER).encode() for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    levels = _trie(texts, 2)
    got = {r[0]: r[1] for r in rows_of(lm_scoring.score_documents(df, train, order=2, nodes=1 << 40), "doc_id", "score")}
    for i, t in rows[:25]:
        assert got[i] == pytest.approx(_log10(levels, (t or "").translate(brute.LOWER).encode(), 2), rel=1e-9)


@pytest.mark.parametrize("order", [0, 2, 5])
def test_ppm_uses_every_node_when_few_are_sent(corpus, odd, order):
    for rows, df in ((corpus[0], corpus[1]), odd):
        if order == 0:
            rows = rows[:20]
        df = df.where(F.col("doc_id").isin([i for i, _ in rows]))
        texts = {i: (t or "").translate(brute.LOWER).encode() for i, t in rows}
        held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
        levels = _trie([t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2], order)
        for nodes in (50, 0):
            got = {r[0]: r[1] for r in rows_of(lm_scoring.score_documents(df, df.where(~held), order=order, nodes=nodes), "doc_id", "score")}
            short = [i for i in texts if len(texts[i]) < 20_000][-40:]
            assert any(zlib.crc32(str(i).encode()) % 7 == 2 for i in short)
            for i in short:
                assert got[i] == pytest.approx(_log10(levels, texts[i], order), rel=1e-9)


def test_ppm_scores_are_alike_whatever_is_sent_and_however_a_part_is_cut(corpus, monkeypatch):
    _, df, _ = corpus
    train = df.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
    all_sent = dict(rows_of(lm_scoring.score_documents(df, train), "doc_id", "score"))
    counts = lm_scoring.gather_counts(train).where("kind = 2")
    assert len(lm_scoring.frequent_lengths(counts, 500)[0]) <= 500
    monkeypatch.setattr(lm_scoring, "FLUSH", 64)
    few_sent = dict(rows_of(lm_scoring.score_documents(df, train, nodes=500), "doc_id", "score"))
    assert few_sent == {i: pytest.approx(s, rel=1e-9) for i, s in all_sent.items()}


def test_ppm_probabilities_sum_to_one_when_pruned(corpus):
    counts = lm_scoring.gather_counts(corpus[1], 3)
    trie = lm_scoring.Trie(lm_scoring.build_trie(counts, 3, nodes=2000))
    for context in (b"the", b"\xff\xff\xff", b"zzz", b"e t"):
        c = int.from_bytes(context, "big") << 8
        p = 10.0 ** trie.log10(np.uint64(c) | np.arange(256, dtype=np.uint64))
        assert p.sum() == pytest.approx(1.0)
    assert all(len(level["key"]) <= 2000 for level in trie.levels)


def test_adaptive_code_length_learns():
    once = lm_scoring.adaptive_code_length(b"abcabcabd")
    assert lm_scoring.adaptive_code_length(b"abcabcabd" * 8) > 8 * once
    assert lm_scoring.adaptive_code_length(b"") == pytest.approx(-np.log10(256))


# ---- 4, 7, 8
def test_quality_classifier_held_out(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.classify(docs, labels).join(labels, "doc_id").where("held_out")
    right = got.where("predicted = quality").count() / got.count()
    assert right > 0.95
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_bradley_terry_recovers_an_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    w = quality_classifier.fit_bradley_terry(x, x @ [2.0, -1.0, 0.0] + rng.normal(size=400) * 0.1 > 0)
    assert w[0] > 0 > w[1] and abs(w[2]) < abs(w[1]) / 3


def test_language_id_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language_id.fit_languages(docs.where(~held))
    got = language_id.predict_languages(docs.where(held).select("doc_id", "text", "lang"), model, ("doc_id", "lang"))
    assert got.where("lang = lang_pred").count() / got.count() > 0.97


def test_temperature_flattens_overconfident_logits():
    y = np.array([0, 1] * 50)
    logits = np.where(np.arange(100)[:, None] % 10 < 8, np.eye(2)[y], np.eye(2)[1 - y]) * 50.0
    assert language_id.fit_temperature(logits, y) > 10


def test_rule_counts(corpus, odd):
    for rows, df in both(corpus, odd):
        forest = quality_rules.grow_forest(np.zeros((0, 8)))
        got = {r[0]: r[1:] for r in rows_of(quality_rules.apply_rules(df, forest, 1.0), "doc_id", *quality_rules.COUNTS, "base_failed", "kept")}
        for i, t in rows:
            n, chars, symbols, lines, again = brute.rule_counts(t)
            failed = n < 50 or 100 * again > 50 * n
            assert got[i] == (n, chars, symbols, lines, again, failed, not failed), t and t[:60]


def test_isolation_forest_finds_the_odd_one():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(500, 3)), [[8.0, 8.0, 8.0]]])
    score = quality_rules.anomaly(quality_rules.grow_forest(x, trees=64), x)
    assert score.argmax() == 500
    assert quality_rules.calibrate(score, np.arange(501) < 500) < score[500]


def test_quality_rules_keep_good_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.apply_rules(docs, *quality_rules.fit_rules(docs, labels)).join(labels, "doc_id").where("NOT base_failed")
    good, bad = got.where("quality = 1"), got.where("quality = 0")
    assert good.where("kept").count() / good.count() > 0.97
    assert bad.where("NOT kept").count() / bad.count() > 0.3


def test_quality_threshold_covers_all_labelled_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    forest, threshold = quality_rules.fit_rules(docs, labels, rows=120)
    marks = {r[0]: int(r[1]) for r in rows_of(labels.where("quality IS NOT NULL"), "doc_id", "quality")}
    rows = [(i, t) for i, t in rows_of(docs, "doc_id", "text") if i in marks and zlib.crc32(str(i).encode()) % 4 != 2]
    s = quality_rules.text_statistics(pa.array([t for _, t in rows]))
    wordy = s["n_words"] >= 50
    good = np.array([marks[i] == 1 for i, _ in rows])[wordy]
    assert len(good) > 200
    assert threshold == quality_rules.calibrate(quality_rules.anomaly(forest, quality_rules.features(s))[wordy], good)


def test_quality_threshold_equals_plain_choice(spark):
    rng = np.random.default_rng(3)
    for size, ties in ((3, False), (40, True), (1500, False), (1500, True)):
        good = np.append(rng.random(size) < 0.6, [True, False])
        score = np.clip(rng.normal(0.45, 0.03, size + 2) + 0.04 * ~good, 0.0, 1.0)
        score = np.round(score, 2) if ties else score
        df = spark.createDataFrame(list(zip(score.tolist(), good.tolist(), strict=True)), "score double, good boolean")
        assert quality_rules.calibrated(df) == quality_rules.calibrate(score, good)
    assert quality_rules.calibrated(df.where("good")) == float("inf")


# ---- 5
def test_line_dedup_keeps_one_line_per_component(corpus, odd):
    rows = [r for r in corpus[0] if r[0] is not None and len(r[1] or "") < 4000][:70]
    for rows, df in ((rows, corpus[1]), ([r for r in odd[0] if len(r[1] or "") < 5000], odd[1])):
        ids = [i for i, _ in rows]
        want = brute.line_classes(rows)
        got = {r[0]: r[1:] for r in rows_of(line_dedup.dedup_lines(df.where(F.col("doc_id").isin(ids))), "doc_id", "n_lines", "n_removed", "kept_lines")}
        for r, (i, _) in enumerate(rows):
            mine = {k: v for (a, k), v in want.items() if a == r}
            assert got[i] == (len(mine), sum(not v for v in mine.values()), sorted(k for k, v in mine.items() if v))


def test_line_dedup_tiles(spark):
    rng = np.random.default_rng(3)
    base = [f"word{k}" for k in rng.integers(0, 1000, 40)]
    rows = []
    for i in range(30):
        w = list(base)
        for k in rng.integers(0, 40, rng.integers(0, 3)):
            w[k] = f"other{rng.integers(0, 1000)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    signed = line_dedup.sign_lines(line_dedup.distinct_lines(df)).cache()
    small = {tuple(r) for r in line_dedup.link_lines(signed, tile=6).collect()}
    large = {tuple(r) for r in line_dedup.link_lines(signed, tile=100).collect()}
    assert small == large and small
    kept = sum(len(r["kept_lines"]) for r in line_dedup.dedup_lines(df).collect())
    assert kept == sum(brute.line_classes(rows).values())


def test_line_dedup_shuffles_candidates_only(spark, monkeypatch):
    """Lines without a candidate are filtered out before their texts are shuffled, and a line and band take three longs."""
    plans, cut = {}, line_dedup.cut

    def seen(df, name="cut"):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return cut(df, name)
    monkeypatch.setattr(line_dedup, "cut", seen)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    filters = spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.sha2(F.col("id").cast("string"), 256), F.when(F.col("id") < 3, "\nlicense line of several files").otherwise("")).alias("text"))
        line_dedup.dedup_lines(df.union(df.selectExpr("doc_id + 1000", "concat(text, '.')"))).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "might_contain" in plans["loaded"]
    counted = next(x for x in plans["nodes"].splitlines() if "Aggregate [node" in x)
    assert "min(band" not in counted and "xxhash64" not in counted
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold") == filters


# ---- 6
def test_decontamination(spark, corpus, odd):
    items = [tuple(r) for r in spark.read.parquet(f"{corpus[2]}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(1000, "one two"), (1001, None), (1002, " . "), (1003, odd[0][3][1]), (1003, odd[0][4][1]), (1004, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for rows, df in both(corpus, odd):
        got = rows_of(decontamination.contamination(df, bench), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
        assert sorted(got) == sorted(brute.contamination(rows, items))
        none = decontamination.contamination(df, bench.limit(0))
        assert none.where("contaminated OR n_hit > 0").count() == 0 and none.count() == len(rows)


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "a x b y c"), (2, "c q q q q q q a b"), (3, "b a c")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c")], "item_id long, text string")
    terms = decontamination.item_terms(decontamination.benchmark_items(items))
    index = decontamination.build_index(docs, terms)
    found = decontamination.proximity_matches(index, terms, 4).join(index.select("doc", "doc_id").distinct(), "doc")
    assert {r["doc_id"] for r in found.collect()} == {1, 3}


# ---- 9
def test_source_targets_and_mix(corpus, odd):
    for rows, df in both(corpus, odd):
        got = source_mixing.mix_sources(df)
        assert got.count() == len(rows)
        again = source_mixing.mix_sources(df)
        assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
        sizes = {}
        for r in df.select("text", "source").collect():
            sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.WORD.findall(r["text"] or ""))
        want = brute.targets(sizes)
        joined = [r.asDict() for r in got.join(df.select("doc_id", "source"), "doc_id").collect()]
        for s, target in want.items():
            own = [r for r in joined if r["source"] == s]
            assert own[0]["target"] == pytest.approx(target) and own[0]["source_size"] == sizes[s]
            largest = max(r["size"] for r in own)
            assert abs(sum(r["taken"] for r in own) - target) <= 3 * largest
            assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)


def test_source_targets_many(spark):
    rng = np.random.default_rng(5)
    for _ in range(4):
        sizes = {f"s{k}": int(v) for k, v in enumerate(rng.integers(0, 1000, rng.integers(1, 12)))}
        df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in source_mixing.source_targets(df).collect()}
        for k, v in brute.targets(sizes).items() if sum(sizes.values()) else []:
            assert got[k] == pytest.approx(v)


# ---- 10
def test_suffix_dedup(corpus, odd):
    for rows, df in both(corpus, odd):
        got = rows_of(suffix_dedup.remove_repeats(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert sorted(got) == sorted(brute.repeats(rows))


def test_suffix_dedup_small_alphabet(spark):
    rng = np.random.default_rng(8)
    part = ["".join(rng.choice(list("ab"), 130)) for _ in range(4)]
    rows = [(i, "".join(part[k] for k in rng.integers(0, 4, 5)) + "".join(rng.choice(list("ab"), 40))) for i in range(25)]
    rows += [(40, "a" * 500), (41, "a" * 99), (42, "ab" * 200), (None, "a" * 101), (43, "a" * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(suffix_dedup.remove_repeats(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(got, key=str) == sorted(brute.repeats(rows), key=str)


# ---- shared
def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (250, 2))] + [(k, k + 1) for k in range(400, 460)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute.classes(500, edges)
    assert got == {k: want[k] for k in {x for a, b in edges for x in (a, b) if a != b}}


def test_empty_tables(spark, empty, labels):
    assert ngram_join.ngram_join(empty).count() == 0
    assert token_files.token_digest(empty).count() == 0
    assert lm_scoring.score_documents(empty, empty).count() == 0
    assert quality_classifier.classify(empty, labels).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0
    assert decontamination.contamination(empty, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert language_id.predict_languages(empty, language_id.fit_languages(empty)).count() == 0
    assert quality_rules.apply_rules(empty, *quality_rules.fit_rules(empty, labels)).count() == 0
    assert source_mixing.mix_sources(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_models_without_labels(odd, labels):
    rows, df = odd
    none = labels.limit(0)
    assert quality_classifier.classify(df, none).where("score BETWEEN 0 AND 1").count() == len(rows)
    assert quality_rules.apply_rules(df, *quality_rules.fit_rules(df, none)).count() == len(rows)
    blank = language_id.predict_languages(df, language_id.fit_languages(df.withColumn("lang", F.lit(None).cast("string"))))
    assert blank.where("lang_pred <> 'und'").count() == 0
    assert lm_scoring.score_documents(df, df.limit(0)).where("score < 0").count() == len(rows)
