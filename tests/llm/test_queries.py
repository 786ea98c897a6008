"""The registered queries: twins in DuckDB, the pipeline against plain versions of its stages, and the entry without them."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import differences, duck

import __spark_entry__ as entry
import corpus_pipeline
from tradewake.llm import queries
from tradewake.llm.words import WordHashes, shingle_set

SMALL = "/root/testdata/sf0.001"


def test_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(sum(k.startswith(f"op{n}_") for k in names) == 1 for n in range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_twins(spark, key):
    assert [x for x in differences(queries.QUERIES[key](spark, SMALL), duck(SMALL), queries.ORACLES[key]) if not x.startswith("type")] == []


@pytest.mark.parametrize("key, types", [
    ("op1_html_text", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    ("op3_toxicity", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    ("op6_pack", dict.fromkeys(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"], "bigint")),
    ("op8_shingle_join", dict.fromkeys(["doc_id", "n_shingles", "component_id"], "bigint")),
    ("op12_source_divergence", {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}),
    ("op10_near_vectors", {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}),
])
def test_types(spark, key, types):
    assert dict(queries.QUERIES[key](spark, SMALL).dtypes) == types


def test_stages_take_effect_on_what_they_get(spark):
    docs = queries.table(spark, SMALL, "documents")
    columns, known = docs.columns, WordHashes()
    sets = lambda df: {r["doc_id"]: set(shingle_set(r["text"], known).tolist()) for r in df.collect()}
    before = docs
    after = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, before, SMALL)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        assert kept.columns == columns
        assert {r["doc_id"] for r in kept.select("doc_id").collect()} <= {r["doc_id"] for r in before.select("doc_id").collect()}
        after.append(kept)
        before = kept
    clean, lines, single, free = map(sets, after)
    items = [set(shingle_set(r["text"], known).tolist()) for r in queries.table(spark, SMALL, "benchmark").collect()]
    leaks = lambda s: any(100 * len(s & i) >= 75 * len(i) for i in items)
    assert set(free) == {k for k, s in single.items() if not leaks(s)}
    alike = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    gone = set(lines) - set(single)
    assert gone and all(any(alike(lines[g], s) for k, s in lines.items() if k < g or k in gone and k != g) for g in gone)
    assert not any(alike(single[a], single[b]) for a in single for b in single if a < b)
    rows = corpus_pipeline.STAGES[-1][1](spark, before, SMALL).collect()
    assert {r["doc_id"] for r in rows} == set(free)


def test_run_on_whole_table(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.count() > 50 and "sequence_id" in got.columns


def test_entry_and_library_do_without_the_subpackage(tmp_path):
    """As if the folders were not there: imports of them fail, the entry still gives the other queries."""
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("tradewake.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) >= 190 and not any(k.startswith("op1") or k == "pipeline" for k in e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""
    root = Path(__file__).resolve().parents[2]
    assert subprocess.run([sys.executable, "-c", code], cwd=root, timeout=120).returncode == 0
