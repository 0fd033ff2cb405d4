import ast
from pathlib import Path

import __spark_entry__ as entry
import corpus_pipeline
from tamis.llm import decontaminate, oracles, queries
from tamis.sources.staging import stage_table

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_every_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage_table(stage(spark, docs, SF), "stage")
        assert out.columns == columns and out.dtypes == docs.dtypes
        ids = {r.doc_id for r in out.collect()}
        assert ids <= {r.doc_id for r in docs.collect()} and len(ids) > 0.5 * docs.count()
        if name == "PII":
            assert out.filter("n_chars <> char_length(text)").isEmpty()
        else:
            assert all(texts[r.doc_id] == r.text for r in out.collect())
        if name == "benchmark decontamination":
            benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert decontaminate.find_items(out, benchmark).filter("contaminated").isEmpty()
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and last.filter("not exact").isEmpty()


LONG = " ".join(f"word{i % 97} {i}" for i in range(3000))
ODD = [
    (1, None, "en", "s", None, 1, "b"), (2, "", "en", "s", 0, 2, None), (3, "word", None, "s", 4, None, "b"), (4, LONG, "en", "s", 9, 4, "b"),
    (5, LONG, "en", None, 9, 5, "b"), (None, "no key at all", "de", "s", 13, 6, "b"), (6, "mail a.b@example.org now", "en", "s", 24, 7, "b"),
    (6, "mail a.b@example.org now", "en", "s", 24, 7, "b"),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row int, block string"


def folder(spark, path, rows):
    """Tables with the given documents, whose further columns clash with helper names, and empty others."""
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_take_odd_documents_and_empty_tables(spark, tmp_path):
    path = folder(spark, str(tmp_path / "odd"), ODD)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage_table(stage(spark, docs, path), "stage")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        kept[name], docs = out.collect(), out
    assert len(kept["quality classifier"]) == len(ODD)  # no trusted text, no threshold
    near = [r.doc_id for r in kept["n-gram Jaccard join"]]
    assert sorted(near, key=repr) == sorted([1, 2, 3, 4, None, 6], key=repr)
    assert len(kept["benchmark decontamination"]) == len(near)
    masked = {r.doc_id: r.text for r in kept["PII"]}
    assert "a.b@example.org" not in masked[6] and masked[1] is None and masked[4] == LONG
    last = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert len(last) == len(near) and all(r.exact for r in last)


def test_no_documents_give_no_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, str(tmp_path / "none"), [])).isEmpty()


def test_all_queries_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in queries.QUERIES if n != "pipeline"}
    assert numbers == set(range(1, 14)) and "pipeline" in queries.QUERIES
    assert queries.QUERIES.keys() <= entry.queries().keys()
    assert oracles.ORACLES.keys() <= queries.QUERIES.keys()


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("tamis/**/*.py"), ROOT / "bench.py", ROOT / "oracles.py"]:
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith(("tamis.llm", "corpus_pipeline")) for n in names)
