import json
import tempfile
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tamis.operators import chat, reports
from tamis.plans import stages
from tamis.sources import corpus, staging, testtables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def finished(spark):
    root = tempfile.mkdtemp(prefix="run-")
    corpus.write_stage(testtables.raw(spark, SF), f"{root}/raw")
    return f"{root}/raw", stages.run_stages(spark, f"{root}/raw", root)


def test_stages_hand_over_tables(spark, finished):
    raw, layout = finished
    assert spark.read.parquet(layout.cleaned).columns == ["id", "title", "PMID", "main_text"]
    assert spark.read.parquet(layout.final).columns == list(stages.FINAL_COLUMNS)
    stored = tuple(stages.stored_counts(spark, raw, layout).first())
    assert stored == tuple(reports.stage_counts(testtables.raw(spark, SF)).first())
    flow = stages.stored_report(spark, raw, layout).orderBy("stage_no").collect()
    assert tuple(r.records for r in flow) == stored


def test_report_file(finished):
    _, layout = finished
    (file,) = Path(layout.report).glob("*.json")
    report = json.loads(file.read_text())
    assert set(report) == {"total_records", "mean_text_length", "top_tokens"}
    assert len(report["top_tokens"]) == 20


def test_a_stage_can_be_run_again(spark, finished):
    _, layout = finished
    before = spark.read.parquet(layout.final).count()
    stages.run_dedupe(spark, layout)
    stages.run_tokenize(spark, layout)
    assert spark.read.parquet(layout.final).count() == before


def test_a_failing_stage_ends_the_run(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="run-")
    corpus.write_stage(testtables.raw(spark, SF), f"{root}/raw")

    def broken(*_):
        raise RuntimeError("no")

    monkeypatch.setattr(stages, "dedupe_signature", broken)
    with pytest.raises(RuntimeError, match="no"):
        stages.run_stages(spark, f"{root}/raw", root)
    assert Path(f"{root}/cleaned/stage1_data").exists()
    assert not Path(f"{root}/final").exists()


def test_missing_columns_are_named(spark, finished):
    _, layout = finished
    with pytest.raises(ValueError, match="contents"):
        corpus.read_corpus(spark, layout.final)


def test_sample_of_a_missing_path_is_empty(spark):
    sample = corpus.load_sample(spark, "/nowhere/at/all", ["id", "tokens"], 5)
    assert sample.columns == ["id", "tokens"] and sample.count() == 0


def test_sample_is_capped_and_ordered(spark, finished):
    _, layout = finished
    ids = [r.id for r in corpus.load_sample(spark, layout.final, ["id", "main_text"], 7).collect()]
    assert ids == sorted(ids) and len(ids) == 7


def test_several_directories_are_one_scan(spark, finished):
    _, layout = finished
    both = corpus.read_corpus(spark, [layout.cleaned, layout.deduped], stages.CLEAN_COLUMNS)
    n = sum(spark.read.parquet(p).count() for p in (layout.cleaned, layout.deduped))
    assert both.count() == n


def test_staging_uses_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    stored = staging.stage_table(spark.range(5), "numbers")
    assert all(f.removeprefix("file://").startswith(root) for f in stored.inputFiles())
    assert stored.count() == 5


def test_a_missing_column_is_not_an_empty_sample(spark, finished):
    _, layout = finished
    with pytest.raises(ValueError, match="nothing"):
        corpus.load_sample(spark, layout.final, ["id", "nothing"])


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="one machine"):
        staging.shared_folder("file:///tmp/run", "spark://head:7077")
    assert staging.shared_folder("hdfs://head/run/", "yarn") == "hdfs://head/run"
    assert staging.shared_folder("file:///tmp/run", "local[4]") == "file:///tmp/run"


def test_a_mount_of_all_machines_is_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://head:7077")
    turns = spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    rendered = chat.chat_render(turns, add_generation_prompt=True).collect()
    assert [r.segment for r in rendered] == ["<|user|>\nx</s>\n<|assistant|>\n"]


NAMED = """chat_render cluster_summary corpus_stats cluster_survivors dedupe_clusters dedupe_impact dedupe_removed
doc_lengths dedupe_signature length_metrics final_dataset many_directories near_dup_pairs prompt_render reduction_rate
report_file sft_dropped sft_format sft_split sft_text side_by_side stage_flow""".split()


@pytest.mark.parametrize("name", NAMED)
def test_queries_that_stage_tables_run_on_a_cluster(spark, monkeypatch, name):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://head:7077")
    assert not entry.queries()[name](spark, SF).isEmpty()


def test_a_folder_whose_files_are_not_seen_is_refused(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://head:7077")
    monkeypatch.setattr(staging, "reaches_executors", lambda spark, path: False)
    with pytest.raises(RuntimeError, match="one machine"):
        staging.staging_root(spark)


def test_a_cluster_without_the_setting_uses_the_warehouse(spark, monkeypatch):
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    set_to = {"spark.sql.warehouse.dir": warehouse}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: set_to.get(key, default))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://head:7077")
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)
    monkeypatch.setattr(staging, "reaches_executors", lambda spark, path: True)
    assert staging.staging_root(spark) == staging.qualified(spark, f"{warehouse}/tamis-staging")


def test_all_stored_tables_lie_in_the_folder_of_the_application(spark):
    owned = staging.owned_folder(spark, "x")
    assert owned.startswith(f"{staging.staging_root(spark)}/{spark.sparkContext.applicationId}/x-")


def test_a_path_without_scheme_lies_on_the_default_file_system(spark):
    assert staging.qualified(spark, "/shared/run") == "file:///shared/run"
    assert staging.qualified(spark, "file:///shared/run") == "file:///shared/run"
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.elsewhere.link./shared", "file:///tmp")
    conf.set("fs.defaultFS", "viewfs://elsewhere/")
    try:
        assert staging.qualified(spark, "/shared/run") == "viewfs://elsewhere/shared/run"
    finally:
        conf.set("fs.defaultFS", before)
