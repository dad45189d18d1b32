"""Shards along a Hilbert curve over several metadata columns.

Each column is quantised to the same number of bits, the cell's place on the curve
is computed, rows are sorted by it and cut into runs. Rows that are close in all
columns lie in the same run, so min/max statistics of the runs' files prune on any of
the columns. Only Spark's own functions are used.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from roadwatch.llm.tables import n_bytes, positions, stored


@dataclass(frozen=True)
class Dimension:
    """A column to order by: `kind` is "category" (any ordered type) or "magnitude" (whole number)."""

    column: str
    kind: str


def curve_tables(n_dims):
    """The curve as a state machine: digit and next state by state * 2^n + corner.

    A state is a rotation and an entry corner of a cube; visiting the corners in Gray
    code order, each sub-cube is entered next to where the last one was left.
    """
    corners = 1 << n_dims
    mask = corners - 1

    def rotate(x, by):
        by %= n_dims
        return ((x << by) | (x >> (n_dims - by))) & mask

    def gray(i):
        return i ^ (i >> 1)

    rank = {gray(i): i for i in range(corners)}

    def ones_below(i):
        return (~i & (i + 1)).bit_length() - 1

    digits, following = [], []
    for state in range(corners * n_dims):
        entry, turn = divmod(state, n_dims)
        for corner in range(corners):
            w = rank[rotate(corner ^ entry, n_dims - (turn + 1) % n_dims)]
            enter = 0 if w == 0 else gray(2 * ((w - 1) // 2))
            axis = 0 if w == 0 else ones_below(w - 1 if w % 2 == 0 else w) % n_dims
            digits.append(w)
            following.append((entry ^ rotate(enter, turn + 1)) * n_dims + (turn + axis + 1) % n_dims)
    return digits, following


def curve_index(cells, bits):
    """Place on the curve (long) of a cell given by one whole-number column per dimension."""
    n_dims = len(cells)
    digits, following = (F.array(*map(F.lit, t)) for t in curve_tables(n_dims))

    def step(acc, level):
        corner = sum(
            (F.call_function("shiftright", cell, level).bitwiseAND(F.lit(1)) * (1 << j) for j, cell in enumerate(cells)),
            F.lit(0),
        )
        spot = (acc["state"] * (1 << n_dims) + corner + 1).cast("int")
        return F.struct(
            F.element_at(following, spot).alias("state"),
            (acc["index"] * (1 << n_dims) + F.element_at(digits, spot)).cast("long").alias("index"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    levels = F.array(*[F.lit(i) for i in reversed(range(bits))])
    return F.aggregate(levels, start, step)["index"]


def magnitude_cell(value, bits):
    """Logarithmic cell of a whole number: its binary length, then its two next binary digits.

    NULL and what is below 1 are in cell 0.
    """
    number = F.greatest(F.coalesce(value.cast("long"), F.lit(0)), F.lit(0))
    exponent = F.length(F.bin(number)) - 1
    mantissa = F.when(exponent >= 2, F.call_function("shiftright", number, exponent - 2).bitwiseAND(F.lit(3)))
    cell = F.when(number < 1, 0).otherwise(exponent * 4 + F.coalesce(mantissa, F.lit(0)) + 1)
    return F.least(cell, F.lit((1 << bits) - 1)).cast("int")


def _category_cells(rows, column, bits, name):
    """The distinct values in order, spread evenly over the cells; NULL comes first."""
    values = positions(rows.select(F.col(column).alias("value")).distinct(), ["value"], f"values-{name}")
    cell = F.floor(F.col("position") * (1 << bits) / F.col("total")).cast("int")
    return stored(values.select("value", cell.alias(name)), f"cells-{name}")


def hilbert_order(rows, dimensions, ties, bits=8):
    """`rows` with `curve`, `position` (gapless from 0 along the curve) and `total`.

    `ties` are columns that order rows of one cell; a hot cell is spread over several
    sort ranges by them. NULLs are the first value of a category and the zero of a
    magnitude. Rows that agree in every column of the order may change places. Columns
    named curve, position or total are replaced.
    """
    taken = [c for c in rows.columns if c not in ("curve", "position", "total")]
    celled, cells = rows.select(*taken), []
    for i, dimension in enumerate(dimensions):
        cell = f"__cell_{i}"
        if dimension.kind == "magnitude":
            celled = celled.withColumn(cell, magnitude_cell(F.col(dimension.column), bits))
        else:
            table = _category_cells(rows, dimension.column, bits, cell).withColumnRenamed("value", f"{cell}_value")
            same = F.col(dimension.column).eqNullSafe(F.col(f"{cell}_value"))
            celled = celled.join(table, same, "left").drop(f"{cell}_value")
        cells.append(F.col(cell))
    curved = celled.select(*taken, curve_index(cells, bits).alias("curve"))
    return positions(curved, ["curve", *ties], "hilbert")


def hilbert_shards(rows, dimensions, ties, n_shards, bits=8):
    """`hilbert_order` cut into runs whose row counts are at most one apart.

    Adds `shard` and `slot`, gapless from 0 in each shard. Fewer rows than shards
    leave some shards empty; an empty table gives no rows.
    """
    ordered = hilbert_order(rows, dimensions, ties, bits)
    return (
        ordered.withColumn("shard", F.expr(f"(position * {n_shards}L) div total"))
        .withColumn("slot", F.col("position") - F.expr(f"(shard * total + {n_shards - 1}L) div {n_shards}L"))
        .withColumn("shard", F.col("shard").cast("int"))
        .drop("total")
    )


def write_shards(rows, dimensions, ties, n_shards, path, bits=8, files_per_shard=1):
    """Write the rows as Parquet, one folder per shard, each file a run of the curve."""
    cut = hilbert_shards(rows, dimensions, ties, n_shards, bits)
    runs = cut.repartitionByRange(n_shards * files_per_shard, "shard", "slot")
    runs.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def document_shards(documents, id_col="doc_id", text_col="text", source_col="source", lang_col="lang", n_shards=8):
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, curve.

    Ordered by source, language and size; the size is the text's bytes plus 1, 1 for a
    NULL text. The law is `rows`. Equal texts of one source and language are
    neighbours on the curve, but may be cut apart at a run's end. Repeated rows and
    NULL ids are documents like others.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = documents.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.col(lang_col).alias("lang"),
        (n_bytes(text) + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    dimensions = [Dimension("source", "category"), Dimension("lang", "category"), Dimension("size", "magnitude")]
    cut = hilbert_shards(rows, dimensions, ["doc_id", "size", "text_crc32"], n_shards)
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
