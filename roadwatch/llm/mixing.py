"""Mixing sources to target weights by weighted sampling without replacement.

A source is taken whole as often as its target allows. What is left of the target is
filled with a weighted sample: each document draws an exponential key divided by its
quality weight, keys are sorted within the source, and documents are taken in that
order until their words reach the rest. The draw depends on the id and a seed alone,
so that a rerun agrees.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from roadwatch.llm.tables import n_words, positions, sort_places, stored

# Characters that running prose hardly has.
SYMBOLS = r"[#*$%&|<>]"


def quality_weight(text, size):
    """Words per words and symbols: 1 for clean prose, less for markup and junk."""
    symbols = F.regexp_count(text, F.lit(SYMBOLS))
    return F.when(size > 0, size / (size + symbols)).otherwise(F.lit(1.0))


def exponential_key(id_column, weight, seed):
    """An exponential draw with rate `weight`, from 52 bits of a hash of seed and id."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("null"))))
    bits = F.conv(F.substring(drawn, 1, 13), 16, 10).cast("long")
    return -F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 52))) / weight


def source_targets(sources, share=1.5, cap=2.0):
    """`sources` (source, source_size, weight) with `target`.

    Targets share `share` times all sizes by weight. None is above `cap` times its
    source's size: the level at which uncapped sources stand, per unit of weight, is
    raised until a round caps no further source. Each round is one aggregate of one row.
    """
    limit = F.col("source_size") * cap
    whole = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    goal = share * (whole[0] or 0)
    level, capped = (goal / whole[1] if whole[1] else 0.0), 0
    while True:
        full = limit <= F.lit(level) * F.col("weight")
        held = sources.filter(full).agg(F.count("*"), F.sum(limit), F.sum("weight")).first()
        free = (whole[1] or 0) - (held[2] or 0)
        if held[0] == capped or free == 0:
            break
        level, capped = (goal - held[1]) / free, held[0]
    return sources.withColumn("target", F.least(limit.cast("double"), F.lit(level) * F.col("weight")))


def mixing_plan(rows, weights=(3, 1, 2), share=1.5, cap=2.0):
    """One row per source: source, source_size, target, epochs, and the last key and id taken.

    `rows` has doc_id, source, size and key. Rows of one id, source and key are taken
    together. A document at the edge is taken if at least half of it fits. The sort
    is over all sources at once, so that a source with most rows spans many tasks.
    """
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = positions(by_source, [F.col("source").asc_nulls_last()], "sources")
    cycle = F.array(*map(F.lit, weights))
    turn = (F.col("position") % len(weights) + 1).cast("int")
    weighted = stored(ranked.select("source", "source_size", F.element_at(cycle, turn).alias("weight")), "weights")
    targets = source_targets(weighted, share, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = stored(
        targets.withColumn("epochs", epochs.cast("long")).withColumn(
            "rest", F.col("target") - F.col("epochs") * F.col("source_size")
        ),
        "targets",
    )

    units = rows.groupBy("source", "key", "doc_id").agg(F.sum("size").alias("size"))
    order = [F.col("source").asc_nulls_last(), "key", "doc_id"]
    drawn = sort_places(units, order, "drawn")
    # Sum within a range, then over the ranges before it that hold the source.
    inside = Window.partitionBy("part", "source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        drawn.groupBy("source", "part")
        .agg(F.sum("size").alias("n"))
        .select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
        .join(plan.select(F.col("source").alias("of"), "rest"), F.col("source").eqNullSafe(F.col("of")))
        .select(F.col("source").alias("of"), F.col("part").alias("of_part"), "offset", "rest")
    )
    placed = drawn.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))
    )
    fits = (F.col("offset") + F.col("inside")) * 2 + F.col("size") <= F.col("rest") * 2
    last = placed.filter(fits).groupBy("source").agg(F.max(F.struct("key", "doc_id")).alias("last"))
    last = last.withColumnRenamed("source", "of")
    return stored(
        plan.join(last, F.col("source").eqNullSafe(F.col("of")), "left").select(
            "source", "source_size", "target", "epochs", "last"
        ),
        "mixing-plan",
    )


def _drawn(documents, id_col, text_col, source_col, seed):
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = n_words(text)
    return documents.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
        exponential_key(F.col(id_col), quality_weight(text, size), seed).alias("key"),
    )


def _times(key, id_column, plan=""):
    """How often the mix takes a document, given its source's row of the plan."""
    drawn = F.struct(key.alias("key"), id_column.alias("doc_id"))
    return F.col(f"{plan}epochs") + F.when(drawn <= F.col(f"{plan}last"), 1).otherwise(0)


def mix(documents, id_col="doc_id", text_col="text", source_col="source", seed=0, **shares):
    """One row per document: doc_id, size, source_size, target, taken.

    A NULL text has size 0. NULL is a source of its own, the last. A NULL id is a
    document like others, the first among equal keys. Repeated rows are
    taken equally often. A source without words has target 0. An empty table gives no rows.
    `shares` go to `mixing_plan`.
    """
    rows = stored(_drawn(documents, id_col, text_col, source_col, seed), "draws")
    plan = mixing_plan(rows, **shares).withColumnRenamed("source", "of")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    taken = F.col("size") * _times(F.col("key"), F.col("doc_id"))
    return joined.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(documents, id_col="doc_id", text_col="text", source_col="source", seed=0, **shares):
    """The mix itself: each row of `documents` as often as it is taken, with its own columns.

    Texts are read twice and never shuffled while the plan, one row per source, is
    small enough for Spark to broadcast. Documents without words are taken no time.
    """
    rows = stored(_drawn(documents, id_col, text_col, source_col, seed), "draws")
    plan = mixing_plan(rows, **shares).select(F.struct("*").alias("__plan"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = n_words(text)
    key = exponential_key(F.col(id_col), quality_weight(text, size), seed)
    planned = documents.select("*", size.alias("__size"), key.alias("__key")).join(
        plan, F.col(source_col).eqNullSafe(F.col("__plan.source"))
    )
    times = _times(F.col("__key"), F.col(id_col), "__plan.")
    repeated = F.array_repeat(F.lit(0), F.when(F.col("__size") > 0, times).otherwise(0).cast("int"))
    copies = planned.withColumn("__copy", F.explode(repeated))
    return copies.select(*documents.columns)
