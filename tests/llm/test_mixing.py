import pytest
from cases import edge_rows, plain, prose, table
from compare import database, difference

from roadwatch.llm.mixing import mix, mixed_documents
from roadwatch.llm.oracles import ORACLES
from roadwatch.llm.queries import QUERIES


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by sharing what is above a cap again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while rest > 1e-9 and open_:
        total, excess = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            target[s] += rest * weight[s] / total
            if target[s] > cap * sizes[s]:
                excess += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
        rest = excess
    return target


def check(rows, result):
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    wanted, taken, largest = targets(sizes), {}, {}
    for r in result:
        row = next(x for x in rows if x[0] == r["doc_id"] and len((x[1] or "").split()) == r["size"])
        assert r["source_size"] == sizes[row[3]]
        assert r["target"] == pytest.approx(wanted[row[3]])
        assert r["taken"] <= 2 * r["size"]
        taken[row[3]] = taken.get(row[3], 0) + r["taken"]
        largest[row[3]] = max(largest.get(row[3], 0), r["size"])
    for source, words in taken.items():
        # Rows of one id are taken together.
        assert abs(words - wanted[source]) <= largest[source] + 1e-6


def test_targets_and_law(spark):
    rows = [(i, prose(i, 12 + i % 40), "en", "hot" if i % 3 else f"s{i % 11}") for i in range(300)]
    check(rows, mix(table(spark, rows)).collect())


def test_edge_cases(spark):
    rows = [row for row in edge_rows() if row[0] not in (6, None) or row[3] == "c"]
    check(rows, mix(table(spark, rows)).collect())


def test_reruns_agree(spark):
    rows = [(i, prose(i, 12 + i % 40), "en", f"s{i % 3}") for i in range(100)]
    first = plain(mix(table(spark, rows)))
    assert first == plain(mix(table(spark, rows).repartition(7)))
    assert first != plain(mix(table(spark, rows), seed=1))


def test_heavier_documents_come_first(spark):
    clean = [(i, prose(i, 40, 1), "en", "a") for i in range(200)]
    noisy = [(200 + i, " ".join(w + "###" for w in prose(i, 40, 1).split()), "en", "a") for i in range(200)]
    other = [(1000 + i, prose(i, 40, 1), "en", "b") for i in range(600)]
    result = mix(table(spark, clean + noisy + other), weights=(1, 9)).collect()
    taken = {r["doc_id"]: r["taken"] for r in result}
    assert sum(taken[i] > 0 for i in range(200)) > 1.5 * sum(taken[i] > 0 for i in range(200, 400))


def test_mixed_rows_are_the_taken_ones(spark):
    rows = [(i, prose(i, 12 + i % 40), "en", "hot" if i % 3 else f"s{i % 11}") for i in range(120)]
    frame = table(spark, rows)
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mix(frame).collect()}
    mixed = mixed_documents(frame)
    assert mixed.columns == frame.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in times.items() if n}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    differing, rows = difference(spark, QUERIES[name], ORACLES[name], sf_dir, database(sf_dir))
    assert not differing and rows > 0
