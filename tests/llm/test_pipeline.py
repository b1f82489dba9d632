"""The pipeline: order, columns, every stage's effect; the entry without it."""
import os
import subprocess
import sys

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from riskgraph.llm.decontaminate import contamination
from riskgraph.llm.jaccard import jaccard_components
from riskgraph.llm.secretscan import scan
from riskgraph.llm.tokens import END, TOKENIZER
from tests.conftest import SF0001

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_do_their_work_on_what_is_left(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    bench = spark.read.parquet(f"{SF0001}/benchmark.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "jaccard_join", "decontamination", "secret_scan", "best_fit_packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, SF0001), name)
        if k < 4:
            assert docs.columns == columns
            assert docs.join(before, "doc_id", "left_anti").count() == 0
        if name == "jaccard_join":
            assert jaccard_components(docs).filter("component_id != doc_id").count() == 0
            groups = jaccard_components(before).select("component_id").distinct().count()
            assert docs.count() == groups
        if name == "decontamination":
            assert contamination(docs, bench).filter("contaminated").count() == 0
            assert contamination(before, bench).filter("not contaminated").count() == docs.count()
        if name == "secret_scan":
            assert docs.count() == before.count()
            assert scan(docs).filter("n_assign + n_access + n_hex + n_entropy > 0").count() == 0
    coder = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    ids = [i for r in before.select("text").collect() if r.text for i in (*coder.encode(r.text, add_special_tokens=False).ids, END)]
    packed = [i for r in docs.select("ids").collect() for i in r.ids]
    assert sorted(packed) == sorted(ids)


def test_entry_works_without_the_subpackage(tmp_path):
    """A copy of the repository without the corpus files still imports."""
    import shutil
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; n = e.queries(); assert 'c15_call_edges' in n and not any(k.startswith('op') or k == 'pipeline' for k in n); print(len(e.oracle_sql()))"
    env = {**os.environ, "PYTHONPATH": ""}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-800:]
