"""The registered queries, the pipeline's stages, and the guard for a missing subpackage."""

import os
import subprocess
import sys

import pytest
from conftest import SF001

import corpus_pipeline
from test_oracle_parity import _rows
from tributary.llm import decontaminate as clean
from tributary.llm.jaccard_join import jaccard_join
from tributary.llm.queries import ORACLE, QUERIES
from tributary.llm.toxicity import toxicity_scores

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF001)
    res = duck.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(columns, res.fetchall())


def test_all_are_registered():
    import __spark_entry__ as entry
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} - {"pipeline"}
    assert set(QUERIES) <= set(entry.queries())


def test_stages(spark):
    """Each stage keeps what it should of its own input, with the columns of documents."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    given = docs
    for name, function in corpus_pipeline.STAGES:
        left = function(spark, given, SF001)
        rows = {r.doc_id: r for r in given.collect()}
        if name == "pieces":
            got = left.collect()
            assert len(got) == len(rows) and all(r.round_trip for r in got)
            break
        assert left.columns == docs.columns
        left = spark.createDataFrame(left.collect(), docs.schema)
        got = {r.doc_id: r for r in left.collect()}
        if name == "toxicity":
            scores = {r.doc_id: r.predicted for r in toxicity_scores(given, labels).collect()}
            assert set(got) == {i for i, p in scores.items() if not p}
        elif name == "exact_dedup":
            best = {}
            for i, r in rows.items():
                best[r.text or ""] = max(i, best.get(r.text or "", i))
            assert set(got) == set(best.values())
        elif name == "jaccard_join":
            assert set(got) == {r.component_id for r in jaccard_join(given).collect()}
        else:
            items = [(str(r.item_id), r.text) for r in bench.collect()]
            found = dict(zip(rows, clean.brute_force([r.text for r in rows.values()], items)))
            gone = {i for i, f in found.items() if f[1] > 0.5 * f[0]}
            assert set(got) == set(rows) - gone
            for i, r in got.items():
                if found[i][1] == 0:
                    assert r == rows[i]
                else:
                    assert len(r.text) < len(rows[i].text) and r.n_chars == len(r.text)
        given = left
    assert corpus_pipeline.run(spark, SF001).count() == given.count()


def test_entry_without_the_subpackage():
    code = ("import sys; sys.modules['tributary.llm'] = None; sys.path.insert(0, %r); "
            "import __spark_entry__ as e; q = e.queries(); "
            "assert 'mean_by_key' in q and not any(n.startswith('op1_') for n in q)" % REPO)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
