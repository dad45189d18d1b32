import itertools
import zlib

import pytest
from cases import edge_rows, prose, table
from pyspark.sql import functions as F

from roadwatch.llm.hilbert import Dimension, curve_index, document_shards, hilbert_shards, magnitude_cell, write_shards


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 1)])
def test_curve_visits_neighbours(spark, dims, bits):
    """The index numbers all cells, and cells of adjacent numbers touch."""
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    names = [f"c{j}" for j in range(dims)]
    frame = spark.createDataFrame(cells, names)
    rows = frame.select(*names, curve_index([F.col(n).cast("int") for n in names], bits).alias("at")).collect()
    order = sorted(rows, key=lambda r: r["at"])
    assert [r["at"] for r in order] == list(range(len(cells)))
    for a, b in itertools.pairwise(order):
        assert sum(abs(x - y) for x, y in zip(a[:dims], b[:dims], strict=True)) == 1


def test_magnitude_cells_are_monotone(spark):
    values = [*range(300), 10**6, 10**12, 2**62]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    cells = [r[0] for r in frame.select(magnitude_cell(F.col("v"), 8)).collect()]
    assert cells == sorted(cells) and cells[-1] <= 255 and cells[0] == 0
    missing = spark.createDataFrame([(None,), (-5,)], "v long").select(magnitude_cell(F.col("v"), 8)).collect()
    assert [r[0] for r in missing] == [0, 0]


def check_law(rows, n_shards=8):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))
    sizes = [len(by_shard.get(s, [])) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)


@pytest.mark.parametrize("n", [3, 14, 101])
def test_law_of_rows(spark, n):
    rows = [(i, prose(i % 9, 10 + i), "en" if i % 2 else "de", "hot" if i % 3 else f"s{i % 5}") for i in range(n)]
    result = document_shards(table(spark, rows)).collect()
    check_law(result)
    for r in result:
        text = rows[r["doc_id"]][1].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", None)


def test_edge_cases(spark):
    result = document_shards(table(spark, edge_rows())).collect()
    check_law(result)
    assert {r["size"] for r in result if r["doc_id"] in (2, 3)} == {1}


def test_runs_prune(spark, tmp_path):
    """Rows of one source lie in few shards, and written files are runs of the curve."""
    rows = [(i, prose(i, 10), "en", f"s{i % 8}") for i in range(400)]
    frame = table(spark, rows).select("doc_id", "source", "lang", F.length("text").alias("length"))
    dims = [Dimension("source", "category"), Dimension("length", "magnitude")]
    result = hilbert_shards(frame, dims, ["doc_id"], 8)
    spread = result.groupBy("source").agg(F.countDistinct("shard").alias("n")).agg(F.avg("n")).first()[0]
    assert spread <= 4
    write_shards(frame, dims, ["doc_id"], 8, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 400
