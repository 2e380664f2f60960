"""The corpus pipeline, and the guard around it."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from orderloom.llm import pii_crf, setsketch

import __spark_entry__

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage gave, by name; the input under its own."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        out[name] = docs
    return out


def test_all_but_the_last_keep_the_columns(stages):
    names = list(stages)
    assert all(stages[n].schema.names == stages["input"].schema.names for n in names[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]


def test_each_stage_decides(stages):
    count = {n: df.count() for n, df in stages.items()}
    assert count["input"] > count["quality"] > count["near_duplicates"] >= count["decontamination"] == count["personal_data"]


def test_no_near_duplicates_are_left(stages):
    got = setsketch.near_duplicates(stages["near_duplicates"])
    assert got.filter("NOT kept").count() == 0


def test_near_duplicates_keep_one_of_each(stages):
    before = {r.doc_id: r.component_id for r in setsketch.near_duplicates(stages["quality"]).collect()}
    after = {r.doc_id for r in stages["near_duplicates"].collect()}
    assert after == {i for i, c in before.items() if i == c}


def test_nothing_of_the_benchmark_is_left(stages, table):
    from test_fm_index import brute

    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    before = {r.doc_id: r.text for r in stages["near_duplicates"].collect()}
    after = {r.doc_id: r for r in stages["decontamination"].collect()}
    hits = {x[0] for x in brute(list(before.items()), items) if x[5]}
    assert not any(x[5] for x in brute([(i, r.text) for i, r in after.items()], items))
    assert all(after[i].text == t for i, t in before.items() if i not in hits)
    assert all(r.n_chars == len(r.text) for i, r in after.items() if i in hits)


def test_no_personal_data_is_left(stages):
    assert [s for r in stages["personal_data"].collect() for s in pii_crf.base_spans(r.text)] == []
    before = {r.doc_id: r.text for r in stages["decontamination"].collect()}
    for r in stages["personal_data"].collect():
        if not pii_crf.TRIGGER.search(before[r.doc_id]):
            assert r.text == before[r.doc_id]


def test_packing_holds_every_document(stages):
    ids = {r.doc_id for r in stages["personal_data"].collect()}
    assert {r.doc_id for r in stages["packing"].select("doc_id").distinct().collect()} == ids


def test_run_is_registered(spark, sf_dir, stages):
    got = __spark_entry__.queries()["pipeline"](spark, sf_dir)
    assert got.columns == stages["packing"].columns
    assert got.select("doc_id").distinct().count() == stages["packing"].select("doc_id").distinct().count()


def test_empty_documents(spark, sf_dir, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_the_rest_works_without_these_folders(tmp_path):
    shutil.copytree(ROOT / "orderloom", tmp_path / "orderloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and not [n for n in q if n.startswith('op') or n == 'pipeline']; e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_the_folder():
    files = [p for p in (ROOT / "orderloom").rglob("*.py") if "llm" not in p.parts]
    assert [p for p in files if "llm" in p.read_text()] == []
