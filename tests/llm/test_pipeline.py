"""Every stage of the corpus pipeline against a plain version, on its own input."""

from collections import Counter

import pytest

import corpus_pipeline as pipeline
from assurspark.llm import token_files

from . import brute

STAGES = dict(pipeline.STAGES)
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark, odd):
    """The driver's smallest documents, and the odd rows with some repeated."""
    real = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = odd[1].withColumn("n_chars", odd[1]["n"].cast("long"))
    return [real, rows.union(rows.where("doc_id IN (3, 301, 303)"))]


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stage_order():
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "source_mixing", "token_files"]


def test_language_stage_rejects_texts_without_letters(spark, inputs):
    for docs in inputs:
        got = STAGES["language_id"](spark, docs, FOLDER)
        assert got.columns == docs.columns
        letters = Counter(i for i, t in pairs(docs) if any(c.isalpha() for c in t or ""))
        kept = ids(got)
        assert not kept - letters
        assert sum(kept.values()) >= 0.9 * sum(letters.values())
        text = dict(pairs(docs))
        assert all(text[i] == t for i, t in pairs(got))


def test_near_duplicate_stage_keeps_one_of_each_group(spark, inputs):
    for docs in inputs:
        rows = pairs(docs)
        once = list(dict.fromkeys(rows))
        want = Counter()
        for (i, t), (low, _) in zip(once, brute.near_duplicates(once), strict=True):
            if not t:
                want[i] += sum(r == (i, t) for r in rows)      # empty texts all stay
            elif i == low:
                want[i] += 1
        got = STAGES["near_duplicates"](spark, docs, FOLDER)
        assert got.columns == docs.columns and ids(got) == want


def test_decontamination_stage(spark, inputs):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    for docs in inputs:
        rows = pairs(docs)
        want = Counter(r[0] for r in brute.contamination(rows, items) if not r[5])
        got = STAGES["decontamination"](spark, docs, FOLDER)
        assert got.columns == docs.columns and ids(got) == want


def test_mixing_stage(spark, inputs):
    for docs in inputs:
        rows = docs.select("doc_id", "text", "source").collect()
        sizes, largest = Counter(), Counter()
        for r in rows:
            n = len(brute.WORD.findall(r["text"] or ""))
            sizes[r["source"]] += n
            largest[r["source"]] = max(largest[r["source"]], n)
        got = STAGES["source_mixing"](spark, docs, FOLDER)
        assert got.columns == docs.columns
        taken = Counter()
        for r in got.select("text", "source").collect():
            taken[r["source"]] += len(brute.WORD.findall(r["text"] or ""))
        for source, target in brute.targets(sizes).items():
            assert abs(taken[source] - target) <= 3 * largest[source]
        given = ids(docs)
        assert all(n <= 2 * given[i] for i, n in ids(got).items())


def test_token_stage(spark, inputs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.tokenizer_path())
    for docs in inputs:
        got = STAGES["token_files"](spark, docs, FOLDER).collect()
        want = brute.token_rows(pairs(docs), tokenizer)
        assert sorted(tuple(r) for r in got) == sorted(want)


def test_empty_table_passes_all_stages(spark, inputs):
    docs = inputs[0].limit(0)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0
        if name != "token_files":
            assert out.columns == docs.columns


def test_run_over_whole_documents(spark):
    out = pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 100
