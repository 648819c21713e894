"""The pipeline against plain Python, stage by stage."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from test_decontaminate import brute
from test_jaccard_join import all_pairs
from test_sharding import check as check_shards

from gavlake.llm.scratch import lean_batches, lean_group

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark):
    from gavlake.llm.mixing import mix_report
    from gavlake.llm.scratch import staged

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "src1", 0), (9002, "123 !!", "en", "src1", 6)], docs.schema)
    docs, columns = docs.unionByName(extra), docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "decontamination", "mix_sources", "shard"]
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    spoken = staged(stages["language_id"](spark, docs, sf_dir), "t")
    assert spoken.columns == columns
    assert sorted(rows(docs.where("doc_id < 9000"))) == sorted(rows(spoken))  # clean documents stay

    single = staged(stages["near_duplicates"](spark, spoken, sf_dir), "t")
    assert single.columns == columns
    want = {c for _, _, c in all_pairs(rows(spoken))}
    assert sorted(r.doc_id for r in single.collect()) == sorted(want)

    clean = staged(stages["decontamination"](spark, single, sf_dir), "t")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    dirty = {d for d, _ in brute(rows(single), items)}
    kept = {r.doc_id for r in clean.collect()}
    assert clean.columns == columns and dirty and not dirty & kept
    assert {d for d, _ in rows(single)} - dirty == kept

    mix = staged(stages["mix_sources"](spark, clean, sf_dir), "t")
    copies = Counter(r.doc_id for r in mix.collect())
    assert mix.columns == columns
    assert all(copies[r.doc_id] * r["size"] == r.taken for r in mix_report(clean).collect() if r["size"])

    check_shards(stages["shard"](spark, mix, sf_dir).collect(), rows(mix))


def test_run(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert got.count() > 150


def test_the_prediction_decides(spark, monkeypatch):
    """Without the model's prediction other rows are kept: it, not the label, drops a language."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    every = corpus_pipeline.language_id(spark, docs, sf_dir)
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", ("en", "de"))
    some = corpus_pipeline.language_id(spark, docs, sf_dir)
    langs = Counter(r.lang for r in some.collect())
    assert 0 < some.count() < every.count() and set(langs) <= {"en", "de", None} | {r.lang for r in every.collect()}
    assert langs["en"] > 10 * langs.get("fr", 0) and langs["de"] > 10 * langs.get("es", 0)
    # a text of two languages in equal parts, and one of none, against a bound that asks for more
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", None)
    monkeypatch.setattr(corpus_pipeline, "LEAST_POSTERIOR", 1.1)
    assert corpus_pipeline.language_id(spark, docs, sf_dir).count() == 0


def tables(spark, tmp_path, docs, name):
    path = tmp_path / name
    docs.write.parquet(f"{path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_run_on_hard_tables(spark, edge_docs, no_docs, tmp_path):
    """Nulls, repeated rows, very long texts, columns with the operators' names; and no rows at all."""
    got = corpus_pipeline.run(spark, tables(spark, tmp_path, edge_docs, "edge")).collect()
    ids = {r.doc_id for r in got}
    assert got and ids <= {None, 1, 4, 7, 8, 9, 10, 11, 12}           # no text, or none with a letter: gone
    assert len(ids & {1, 7, 8}) <= 1                                  # one of the near copies
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, no_docs, "none")).collect() == []


def test_run_leaves_only_its_result(spark, monkeypatch):
    dropped = []
    real = corpus_pipeline.discard
    monkeypatch.setattr(corpus_pipeline, "discard", lambda *t: dropped.append(len(t)) or real(*t))
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 150
    assert len(dropped) == len(corpus_pipeline.STAGES) - 1


def test_worker_keeps_no_memory_of_a_task():
    """A worker that outlives its tasks gives freed heap back, even below a block that is still in use."""
    def resident_mb():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096 / 1e6

    pins = []

    def work(batches):
        for batch in batches:
            held = [np.ones(12_500) for _ in range(2_000)]  # 100 kB each, so they come from the heap
            pins.append(np.ones(12_500))
            del held
            yield batch

    before = resident_mb()
    assert list(lean_batches(work)(iter([1]))) == [1]
    assert resident_mb() - before < 60
    assert lean_group(lambda table: table + 1)(1) == 2
