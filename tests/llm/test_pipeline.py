"""Stages against brute force, each on its own input, and the entry's queries."""

from test_lines import brute as brute_lines
from test_near import brute as brute_near
from test_quality import figures

import __spark_entry__
import corpus_pipeline
from roadwatch.llm.mixing import mix
from roadwatch.llm.oracles import ORACLES
from roadwatch.llm.quality import quality
from roadwatch.llm.queries import QUERIES
from roadwatch.llm.tables import stored

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def rows_of(frame):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in frame.collect()]


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    results = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, before, SF_DIR), "stage")
        results.append((name, before, docs))
    quality_rules, lines, near, mixing, tokens = results

    _, before, after = quality_rules
    verdict = {r["doc_id"]: r["kept"] for r in quality(before).collect()}
    assert not any(verdict[i] for i, text, *_ in rows_of(before) if figures(text)[-1])
    assert {r["doc_id"] for r in after.collect()} == {i for i, kept in verdict.items() if kept}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    clean = [i for i, text, *_ in rows_of(before) if labels.get(i) == 1 and not figures(text)[-1]]
    assert all(verdict[i] for i in clean)

    _, before, after = lines
    lost = {r[0]: r[2] for r in brute_lines(rows_of(before))}
    left = {r["doc_id"]: r for r in after.collect()}
    assert set(left) == set(lost) and sum(lost.values()) > 0
    for i, text, *_ in rows_of(before):
        assert left[i]["n_chars"] == len(left[i]["text"])
        assert len(text.split("\n")) - lost[i] == (len(left[i]["text"].split("\n")) if left[i]["text"] else 0)

    _, before, after = near
    assert {r["doc_id"] for r in after.collect()} == {r[0] for r in brute_near(rows_of(before)) if r[3]}

    _, before, after = mixing
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mix(before).collect() if r["size"]}
    counts = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in times.items() if n}

    _, before, after = tokens
    assert after.count() == before.count()
    assert after.filter("NOT round_trip OR n_tokens <> size(ids)").count() == 0
    for _, before, after in results[:-1]:
        assert after.columns == before.columns


def test_run(spark):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.count() > 0 and result.filter("NOT round_trip").count() == 0


def test_entry_has_every_operator():
    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
