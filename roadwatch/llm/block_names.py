"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. All distinct blocks are sorted
and numbered; then adjacent numbers are paired, the distinct pairs sorted and numbered
again, and so on, until each text has a single number. Two texts of the same number
of blocks are equal if and only if their numbers are.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadwatch.llm.tables import n_bytes, stored, texts

# Takes the place of the right half where a text has an odd number of names.
NO_RIGHT = -1


def _numbered(frame, order, name, first=0, sign=1):
    """Distinct rows sorted and numbered; each task numbers its own, with its own high bits."""
    number = F.lit(first) + F.lit(sign) * F.monotonically_increasing_id()
    return frame.distinct().sortWithinPartitions(*order).withColumn(name, number)


def _blocks(rows, block_bytes, block_hash):
    raw = F.col("text").cast("binary")
    count = F.greatest(F.lit(1), F.ceil(n_bytes(F.col("text")) / block_bytes)).cast("int")
    starts = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    pieces = F.transform(
        starts, lambda i: F.substring(F.col("raw"), i * block_bytes + 1, F.lit(block_bytes))
    )
    cut = rows.select("doc_id", "text_key", count.alias("n_blocks"), raw.alias("raw"))
    return cut.select("doc_id", "text_key", "n_blocks", F.posexplode(pieces).alias("pos", "block")).withColumn(
        "block_hash", block_hash(F.col("block"))
    )


def _first_names(blocks):
    """One name per block: (doc_id, text_key, n_blocks, pos, name).

    The blocks themselves cross the network once, after equal ones were merged
    before the shuffle. Names return to their places by the block's hash. Where
    different blocks share a hash, their bytes are compared instead.
    """
    named = _numbered(blocks.select("block_hash", "block"), ["block_hash", "block"], "name")
    by_hash = stored(named.select("block_hash", "name"), "block-names").groupBy("block_hash").agg(
        F.min("name").alias("name"), F.count("*").alias("sharing")
    )
    by_hash = stored(by_hash, "block-hashes")
    keys = ["doc_id", "text_key", "n_blocks", "pos"]
    clear = by_hash.filter("sharing = 1").select("block_hash", "name")
    found = blocks.select(*keys, "block_hash").join(clear, "block_hash").select(*keys, "name")
    clashing = by_hash.filter("sharing > 1").select("block_hash")
    if clashing.isEmpty():
        return found
    by_bytes = blocks.join(clashing, "block_hash", "left_semi")
    other_names = stored(
        _numbered(by_bytes.select("block"), ["block"], "name", first=NO_RIGHT - 1, sign=-1),
        "clashing-names",
    )
    return found.unionByName(by_bytes.join(other_names, "block").select(*keys, "name"))


def _paired(rows):
    """Half as many names per text: those of its adjacent pairs."""
    keys = ["doc_id", "text_key", "n_blocks"]
    even = F.col("pos") % 2 == 0
    pairs = rows.groupBy(*keys, F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
        F.max(F.when(even, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(NO_RIGHT)).alias("right"),
    )
    pairs = stored(pairs, "name-pairs")
    names = stored(_numbered(pairs.select("left", "right"), ["left", "right"], "name"), "pair-names")
    return stored(pairs.join(names, ["left", "right"]).select(*keys, "pos", "name"), "names")


def name_texts(rows, block_bytes=4096, block_hash=F.xxhash64):
    """One row per distinct (doc_id, text_key): `n_blocks` and `name`, its text's identity.

    `rows` has doc_id, text and text_key. The number of rounds is the binary
    logarithm of the longest text's blocks; each round halves the rows, and texts that
    have come down to one name leave it.
    """
    names = stored(_first_names(_blocks(rows, block_bytes, block_hash)), "names")
    done, size = [], 1
    while True:
        # After k rounds a text of n blocks has ceil(n / 2^k) names.
        ready = names.filter(F.col("n_blocks") <= size).select("doc_id", "text_key", "n_blocks", "name")
        # Pairing merges repeated rows; those that need none are merged here.
        done.append(ready.distinct() if size == 1 else ready)
        names = names.filter(F.col("n_blocks") > size)
        if names.isEmpty():
            return reduce(DataFrame.unionByName, done)
        names, size = _paired(names), size * 2


def exact_duplicates(documents, id_col="doc_id", text_col="text", block_bytes=4096, block_hash=F.xxhash64):
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. NULL texts count as empty, and
    empty texts are equal. A NULL id is smaller than any other. Of repeated rows with
    one id and one text, one is kept; the others count in group_size. Rows with one id
    and different texts are different documents. An empty table gives no rows.
    """
    rows = texts(documents, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    digest = rows.groupBy("doc_id", "text_key", F.sha2("text", 256).alias("text_sha256")).agg(
        F.count("*").alias("copies")
    )
    names = name_texts(rows, block_bytes, block_hash).withColumnsRenamed(
        {"doc_id": "named_id", "text_key": "named_key"}
    )
    same = F.col("doc_id").eqNullSafe(F.col("named_id")) & (F.col("text_key") == F.col("named_key"))
    identified = stored(
        digest.join(names, same).select("doc_id", "text_sha256", "copies", "n_blocks", "name"),
        "identified",
    )
    # Stored, so that the join shuffles both sides itself and can split a large group.
    groups = stored(
        identified.groupBy("n_blocks", "name").agg(
            F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
        ),
        "groups",
    )
    each = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    return (
        identified.join(groups, ["n_blocks", "name"])
        .select("*", each)
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
