import hashlib

from cases import edge_rows, plain, prose, table
from pyspark.sql import functions as F

from roadwatch.llm.block_names import exact_duplicates


def brute(rows):
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(text or "", []).append(i)
    out, stayed = [], set()
    for i, text, *_ in rows:
        text = text or ""
        ids = [x for x in groups[text] if x is not None]
        keep = max(ids) if ids else None
        kept = i == keep and text not in stayed
        if kept:
            stayed.add(text)
        out.append((i, keep, len(groups[text]), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edge_cases(spark):
    assert plain(exact_duplicates(table(spark, edge_rows()))) == brute(edge_rows())


def test_block_edges_and_rounds(spark):
    base = prose(5, 400)
    rows = [(i, base[:n], "en", "a") for i, n in enumerate([0, 1, 7, 8, 9, 15, 16, 17, 63, 64, 65, 1000, 1000, 64, 8])]
    rows.append((99, base[:63] + "!", "en", "a"))
    got = exact_duplicates(table(spark, rows), block_bytes=8)
    assert plain(got) == brute(rows)


def test_names_do_not_rest_on_the_hash(spark):
    """With a hash that tells only few blocks apart the bytes decide."""
    rows = [(i, prose(i % 7, 30), "en", "a") for i in range(20)]
    got = exact_duplicates(table(spark, rows), block_bytes=16, block_hash=lambda b: F.octet_length(b).cast("long"))
    assert plain(got) == brute(rows)


def test_large_group(spark):
    rows = [(i, prose(0) if i % 3 else prose(i), "en", "a") for i in range(600)]
    assert plain(exact_duplicates(table(spark, rows))) == brute(rows)
