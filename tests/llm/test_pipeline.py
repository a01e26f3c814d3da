"""The corpus pipeline against brute force, and every registered query against odd tables."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridseries.llm import language_id, quality, queries, stages
from tests.llm.test_pairs import jaccard_links
from tests.llm.test_tokens import check_packed

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_the_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "ngram_jaccard_join", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_stage_by_stage_brute_force(spark, docs):
    rows = {r.doc_id: r for r in docs.collect()}
    model = language_id.train_on_rest(docs, "doc_id", "text", "lang")
    order = sorted(rows)
    names, shares = model.predict([rows[i].text for i in order])
    known = [i for i, n, s in zip(order, names, shares) if n != "und" and s >= stages.LANGUAGE_SHARE]
    first = docs.where(F.col("doc_id").isin(known))
    scorer = quality.train(first, "doc_id", "text", spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "quality")
    good = [i for i, s in zip(known, scorer.scores([rows[i].text for i in known])) if s >= quality.THRESHOLD]
    links = jaccard_links({i: rows[i].text for i in good})
    kept = [i for i in good if links[i][1] == i]
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted({r.doc_id for r in out}) == kept
    lengths = {i: max(r.start + r.length for r in out if r.doc_id == i) for i in kept}
    check_packed(out, lengths, stages.CAPACITY)
    assert len(known) > 0.95 * len(rows) and len(good) > 0.75 * len(known) and len(kept) < len(good)


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    left = stages.keep_good_quality(spark, stages.keep_known_languages(spark, docs, sf), sf)
    stay = labels.join(left, "doc_id", "left_semi").groupBy("quality").count().collect()
    total = {r.quality: r["count"] for r in labels.groupBy("quality").count().collect()}
    share = {r.quality: r["count"] / total[r.quality] for r in stay}
    assert share[1] > 0.97 and share.get(0, 0) < 0.15


def test_every_stage_takes_odd_tables(spark, docs):
    clash = docs.withColumn("verdict", F.lit(1)).withColumn("k", F.lit("x")).withColumn("class", F.lit(None).cast("int"))
    odd = [(None, None, None, None, None), (None, "", "en", "s", 0), (7, "", "en", "s", 0), (7, "the of and to", "en", "s", 13), (7, "the of and to", "en", "s", 13), (8, "the " * 30000, "en", "s", 1), (None, "the of and to", "en", "s", 13)]
    table = spark.createDataFrame(odd, docs.schema)
    for df in (clash, table, docs.limit(0), table.where("doc_id = 7 AND text = ''")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns and out.count() <= df.count()
        assert corpus_pipeline.STAGES[-1][1](spark, df, SF).count() >= df.count()
    left = stages.keep_one_of_each_group(spark, table, SF).collect()
    assert sorted((r.doc_id is None, r.text or "") for r in left) == sorted([(True, ""), (True, ""), (True, "the of and to"), (False, ""), (False, "the of and to"), (False, "the " * 30000)])
    assert {r.text for r in stages.keep_known_languages(spark, table, SF).collect()} <= {"the of and to", "the " * 30000}


def test_names_and_result_columns(spark):
    want = {
        1: ["doc_id", "held_out", "lang_pred", "score"], 2: ["vec_id", "n_links", "component_id", "kept"], 3: ["doc_id", "n_links", "component_id", "kept"],
        4: ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        5: ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        6: ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        7: ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"], 8: ["page_id", "blocked"],
        9: ["doc_id", "held_out", "score", "predicted"], 10: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        11: ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
        12: ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        13: ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    }
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    for name, query in queries.QUERIES.items():
        assert set(want[int(name[2:].split("_")[0])]) <= set(query(spark, SF).columns), name


def test_the_rest_works_without_this_part(tmp_path):
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('gridseries.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 60 and not any(q.startswith('op') or q == 'pipeline' for q in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=120)
