"""The corpus pipeline against its operators one by one, and what each stage must keep."""

import re
from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry_point
from faresift.llm import queries
from test_filters import slow_contamination

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.materialise(stage(spark, seen[-1], SMALL), f"test-{name}"))
    for after in seen[1:-1]:
        assert after.dtypes == docs.dtypes
    raw, good, lines, single, clean = ({r.doc_id: r.text for r in df.collect()} for df in seen[:-1])

    rejected = {r.doc_id for r in queries.op4_quality(spark, SMALL).collect() if not r.predicted}
    assert set(good) == set(raw) - rejected
    assert set(lines) == set(good)
    passages = Counter(p for t in lines.values() for p in t.split("\n") if len(re.findall(r"\S+", p)) >= 50)
    assert not passages or max(passages.values()) == 1
    firsts = {r.component_id for r in queries.simhash.near_duplicates(seen[2]).collect()}
    assert set(single) == firsts
    assert {d: single[d] for d in single} == {d: lines[d] for d in single}
    assert set(clean) == {d for d, t in single.items() if not slow_contamination(t, items)[4]}
    packed = seen[-1].collect()
    assert {r.doc_id for r in packed} == set(clean)
    assert all(len(r.ids) == r.length for r in packed)


def test_pipeline_is_registered(spark):
    assert entry_point.queries()["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in entry_point.oracle_sql()
    run = corpus_pipeline.run(spark, SMALL)
    assert run.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    assert run.count() > 0
