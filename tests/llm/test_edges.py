"""What every operator must do with NULLs, empty and long texts, repeated rows, clashing columns and no rows."""

import pytest
from cases import edge_rows, table

import corpus_pipeline
from roadwatch.llm import align, block_names, hilbert, line_chunks, mixing, near, personal, quality, scoring, suffixes, tokens

OPERATORS = {
    "near": near.near_duplicates,
    "hilbert": hilbert.document_shards,
    "quality": quality.quality,
    "personal": personal.personal_data,
    "lines": line_chunks.line_report,
    "tokens": tokens.encode,
    "mix": mixing.mix,
    "suffixes": suffixes.byte_report,
    "exact": block_names.exact_duplicates,
    "scores": scoring.text_scores,
    "alignment": align.token_alignment,
}


@pytest.fixture(scope="module")
def edges(spark):
    return table(spark, edge_rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(edges, name):
    result = OPERATORS[name](edges)
    ids = sorted((row["doc_id"] is None, row["doc_id"] or 0) for row in result.collect())
    assert ids == sorted((row[0] is None, row[0] or 0) for row in edge_rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(edges, name):
    result = OPERATORS[name](edges.limit(0))
    assert result.columns == OPERATORS[name](edges).columns
    assert result.count() == 0


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES) - 1))
def test_stages_keep_the_columns(spark, edges, number):
    _, stage = corpus_pipeline.STAGES[number]
    result = stage(spark, edges, None)
    assert result.columns == edges.columns
    assert {row[0] for row in result.select("size").distinct().collect()} <= {"extra"}
    assert stage(spark, edges.limit(0), None).count() == 0


def test_last_stage_on_edge_rows(spark, edges):
    """Each row is encoded, NULL as an empty text; no rows give none."""
    _, stage = corpus_pipeline.STAGES[-1]
    result = stage(spark, edges, None).collect()
    assert len(result) == len(edge_rows()) and all(r["round_trip"] for r in result)
    assert stage(spark, edges.limit(0), None).count() == 0
