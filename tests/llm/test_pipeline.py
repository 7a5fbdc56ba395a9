"""The pipeline over a small table: each stage acts on what the one before kept."""

import os
import random
import subprocess
import sys

import pytest

import corpus_pipeline
from varzea.llm import quality_rules, simhash, substring_dedup

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    words = [f"w{k}" for k in range(400)]
    rng = random.Random(8)
    clean = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(40)]
    toxic = [c.replace(" ", f" {('idiot', 'trash')[i % 2]} ", 2) for i, c in enumerate(clean)]
    shared = " ".join(f"common{k}" for k in range(55))
    data = ([(i, c) for i, c in enumerate(clean)] + [(100 + i, t + f" end{i}") for i, t in enumerate(toxic)]
            + [(200, clean[0]), (200, clean[0]), (201, "too short"), (202, None), (203, f"{shared} {clean[5][:90]} a b c"),
               (204, f"{' '.join(reversed(clean[6].split()))} {shared}"), (None, " ".join(f"noid{k}" for k in range(80)))])
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in data],
                          "doc_id long, text string, lang string, source string, n_chars long, kind string").repartition(2).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(100 <= i < 200)) for i, _ in data if i is not None and i < 200],
                          "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, folder).cache()
        seen[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name != "best_fit_packing":
            assert docs.columns == columns
        if name == "quality_rules":
            assert docs.count() == quality_rules.apply_policy(quality_rules.ledger(before)).filter("kept").count()
            assert not {201, 202} & seen[name] and {0, 39, 200, None} <= seen[name]
        if name == "toxicity":
            assert not any(i and 100 <= i < 140 for i in seen[name]) and set(range(40)) <= seen[name]
        if name == "simhash_dedup":
            assert 200 not in seen[name] and 0 in seen[name]
            assert docs.count() == simhash.near_duplicates(before).select("component_id").distinct().count()
        if name == "substring_dedup":
            assert docs.count() == before.count()
            text = docs.filter("doc_id = 204").first()["text"]
            assert "common1 " not in text + " "
            assert substring_dedup.digests(before).agg({"n_removed": "sum"}).first()[0] == 55
    total = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in total.collect()} == seen["best_fit_packing"] == seen["substring_dedup"]


def test_rest_imports_without_the_subpackage(tmp_path):
    """Without varzea/llm and corpus_pipeline.py the entry has the other queries only."""
    import shutil
    for name in ("varzea", "__spark_entry__.py"):
        src = os.path.join(ROOT, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 100 and not [k for k in q if k.startswith('op')]"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
