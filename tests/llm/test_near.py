import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import edge_rows, prose, table

from roadwatch.llm import near
from roadwatch.llm.components import components


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    holders, shared = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for shingle in s:
            shared.update((j, i) for j in holders[shingle])
            holders[shingle].append(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, j), both in shared.items():
        if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(
        ((r[0], len(s), least.get(find(i)), r[0] == least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets, strict=True))),
        key=repr,
    )


def found(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(frame).collect()), key=repr)


def edited(text, share, seed):
    pick = random.Random(seed)
    return " ".join(w if pick.random() > share else f"edit{pick.randint(0, 10**6)}" for w in text.split())


def test_against_brute_force(spark):
    """Families of edited copies on both sides of the threshold, chains, copies and strangers."""
    rows, number = [], 0
    for family in range(25):
        base = prose(family, 120, 1)
        rows.append((number, base, "en", "a"))
        for k in range(family % 6):
            number += 1
            rows.append((number, edited(base, 0.01 + 0.015 * k, number), "en", "a"))
        chain = base
        for _ in range(family % 4):
            number += 1
            chain = edited(chain, 0.02, number)
            rows.append((number, chain, "en", "a"))
        number += 1
    rows += [(1000 + i, prose(i % 5, 120, 1).upper(), "en", "a") for i in range(20)]
    want = brute(rows)
    assert found(table(spark, rows)) == want
    assert sum(not r[3] for r in want) > 60


def test_large_family(spark):
    """Far more near copies than a node may compare, and strangers that share a long common passage."""
    base, passage = prose(1, 150, 1), prose(2, 40, 1)
    rows = [(i, edited(base, random.Random(i).choice([0.002, 0.005, 0.01, 0.04]), i), "en", "a") for i in range(500)]
    rows += [(1000 + i, passage + " " + prose(3000 + i, 150, 1), "en", "a") for i in range(400)]
    assert found(table(spark, rows)) == brute(rows)


def two_families(size):
    """Two dense families at about 0.70, whose only link of 0.76 is between two members beside their centres."""
    pick = random.Random(2)
    shared = [f"s{pick.randint(0, 10**9)}" for _ in range(320)]
    heads = [[f"{side}{k}" for k in range(70)] for side in "ab"]
    rows = []
    for side, head in enumerate(heads):
        for k in range(size):
            tail = list(shared)
            if k:
                tail[(k * 7 + side * 3) % 300 + 10] = f"edit{side}x{k}"
            rows.append((1000 * side + k, " ".join(head + tail), "en", "a"))
    # Nineteen words of either head give way to common ones.
    bridge = [f"c{k}" for k in range(19)]
    rows += [(1000 * side + size, " ".join(head[:51] + bridge + shared), "en", "a") for side, head in enumerate(heads)]
    return rows


@pytest.mark.parametrize(("bound", "levels", "held"), [(32, 0, 2_000), (32, 2, 2_000_000), (2048, 3, 5_000)])
def test_single_link_between_dense_families(spark, monkeypatch, bound, levels, held):
    """The link is found in blocks, in nodes below the root, and when a node's sets are held in stretches."""
    monkeypatch.setattr(near, "BOUND", bound)
    monkeypatch.setattr(near, "LEVELS", levels)
    monkeypatch.setattr(near, "HELD", held)
    rows = two_families(90)
    want = brute(rows)
    assert {r[2] for r in want} == {0}
    a, b = shingle_set(rows[-2][1]), shingle_set(rows[-1][1])
    assert 0.75 <= len(a & b) / len(a | b) < 0.78
    apart = [r for r in rows if r[0] not in (90, 1090)]
    assert {r[2] for r in brute(apart)} == {0, 1000}
    assert found(table(spark, rows)) == want


def test_large_nodes_of_several_parts(spark, monkeypatch):
    """All results, with nodes of many parts and blocks."""
    monkeypatch.setattr(near, "SMALL", 8)
    monkeypatch.setattr(near, "PART", 32)
    monkeypatch.setattr(near, "BOUND", 16)
    base, passage = prose(1, 150, 1), prose(2, 40, 1)
    rows = [(i, edited(base, random.Random(i).choice([0.002, 0.005, 0.01, 0.04]), i), "en", "a") for i in range(200)]
    rows += [(1000 + i, passage + " " + prose(3000 + i, 150, 1), "en", "a") for i in range(100)]
    rows += [(2000 + r[0], *r[1:]) for r in two_families(60)]
    assert found(table(spark, rows)) == brute(rows)


def families_at_seventy(size):
    """Eight families, dense inside, of about 0.70 between each other: candidates everywhere, links only inside."""
    pick = random.Random(3)
    shared = [f"s{pick.randint(0, 10**9)}" for _ in range(320)]
    rows = []
    for side in range(8):
        head = [f"h{side}x{k}" for k in range(70)]
        for k in range(size):
            tail = list(shared)
            tail[(k * 11 + side * 5) % 300 + 10] = f"edit{side}x{k}"
            rows.append((1000 * side + k, " ".join(head + tail), "en", "a"))
    return rows


def test_families_apart_give_no_more_rows_than_members(spark, monkeypatch):
    """What the settling step writes is bounded by the members of its nodes, not by their pairs."""
    sizes = {}
    keep = near.stored

    def counted(frame, name):
        out = keep(frame, name)
        if name in ("open-members", "open-found", "joining-links"):
            sizes[name] = sizes.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(near, "stored", counted)
    rows = families_at_seventy(20)
    assert found(table(spark, rows)) == brute(rows)
    assert sizes["open-found"] <= sizes["open-members"] <= len(rows) * len(near.ROOTS)
    assert sizes["joining-links"] == 0


@pytest.mark.parametrize("size", [2, 5, 33, 64])
def test_small_nodes_propose_fewer_pairs_than_members(size):
    """A node of copies alike proposes what ties them together and says that there are more pairs."""
    sketch = np.zeros((size, near.COORDINATES), np.uint8)
    sketch[np.arange(size), np.arange(size)] = 1
    pairs, more = near._tying_pairs(np.arange(size), sketch)
    assert len(pairs) == size - 1
    assert {x for pair in pairs for x in pair[:2]} == set(range(size))
    assert more == (size > 2)


def test_pairs_that_a_small_node_did_not_propose(spark, monkeypatch):
    """All results if candidates are refuted that tie a small node's members together, and their level's rows."""
    made = {}
    keep = near.stored

    def counted(frame, name):
        out = keep(frame, name)
        if name == "tree-level":
            made[len(made)] = out.count()
        return out

    monkeypatch.setattr(near, "stored", counted)
    rows = families_at_seventy(6)
    assert found(table(spark, rows)) == brute(rows)
    # All of them meet in each of the root nodes that they share.
    assert made[0] <= len(rows) * len(near.ROOTS)


def test_edge_cases(spark):
    rows = [r for r in edge_rows() if r[0] is not None]
    assert found(table(spark, rows)) == brute(rows)


def test_rows_without_ids(spark):
    rows = [(None, prose(1), "en", "a"), (None, prose(1), "en", "a"), (None, prose(2), "en", "a"), (5, prose(2), "en", "a")]
    got = found(table(spark, rows))
    assert [r for r in got if r[2] is None] == [(None, got[-1][1], None, True)] * 2
    assert [(r[0], r[3]) for r in got if r[2] == 5] == [(5, True), (None, False)]


def test_one_of_each_group_stays(spark):
    rows = [(i, prose(i % 4), "en", "a") for i in range(12)] + [(0, prose(0), "en", "a"), (1, prose(1) + " end", "en", "a")]
    rows += [(20, "", "en", "a"), (21, None, "en", "a")]
    kept = near.representatives(table(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 20, 21]


@pytest.mark.parametrize("shape", ["path", "star", "cycles", "random"])
def test_components(spark, shape):
    pick = random.Random(shape)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(30, i) for i in range(60) if i != 30],
        "cycles": [(10 * c + i, 10 * c + (i + 1) % 10) for c in range(6) for i in range(10)],
        "random": [(pick.randint(0, 80), pick.randint(0, 80)) for _ in range(60)],
    }[shape]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in root if find(x) != x}
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).select("u", "v").collect()}
    assert got == want


def test_roots_reach_the_promised_recall():
    assert (1 - near.SIMILARITY) ** len({c for _, c in near.ROOTS}) < 1e-7


def test_components_of_stars_take_no_round(spark, monkeypatch):
    names, keep = [], near.stored
    monkeypatch.setattr("roadwatch.llm.components.stored", lambda frame, name: names.append(name) or keep(frame, name))
    edges = spark.createDataFrame([(1, 5), (6, 1), (2, 9)], "u long, v long")
    assert {tuple(r) for r in components(edges).collect()} == {(5, 1), (6, 1), (9, 2)}
    assert names == ["links", "labels"]
