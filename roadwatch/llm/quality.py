"""Quality rules under weak supervision.

Each rule votes good, bad or abstains. Votes are counted per pattern of votes, expectation-
maximisation over the patterns estimates how often each rule errs on good and on bad
documents, and the posterior probability that a document is good replaces the demand
that it pass every rule. Only Spark's own functions are used: even the iterations
are one expression over the counted patterns.
"""

from functools import reduce

from pyspark.sql import functions as F

from roadwatch.llm.tables import WORD, let, stored

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
ABSTAIN, BAD, GOOD = -1, 0, 1

# Rules: name, measure as SQL over the columns of `measured`, condition for bad, condition for good.
RULES = [
    ("symbols", "n_symbols / word_chars", "x > 0.05", "x < 0.01"),
    ("symbol_runs", "n_symbol_runs / n_words", "x > 0.2", "x < 0.02"),
    ("repeats", "n_repeat_words / n_words", "x > 0.25", "x < 0.02"),
    ("capitals", "n_capitals / word_chars", "x > 0.3", "x < 0.1"),
    ("word_length", "word_chars / n_words", "x < 3.3 OR x > 6.8", "x BETWEEN 4.2 AND 6.3"),
    ("vocabulary", "n_distinct_words / sqrt(n_words)", "x < 3", "x > 5"),
    ("stops", "n_stops / n_words", "x < 0.02 OR x > 0.6", "x BETWEEN 0.05 AND 0.4"),
    ("duplicate_lines", "n_dup_lines / n_lines", "x > 0.4", "x < 0.1"),
]

# First guess: share of good documents; a rule's chance of a bad vote on a good and on a bad document.
# Rules are written to be precise: each knows one kind of junk and seldom errs on good prose.
FIRST_GUESS = (0.75, 0.005, 0.25)
# The guess counts as much as this share of all documents, so that the classes keep their meaning.
ANCHOR = 0.02
ROUNDS = 30


def repeated_words(words):
    """Words that lie in a window of 8 words found twice or more, of an array of words.

    Windows are hashed first. Only where hashes repeat are the windows
    themselves sorted and compared with their neighbours.
    """
    count = F.size(words)
    starts = F.sequence(F.lit(1), F.greatest(count - (WINDOW - 1), F.lit(1)))
    some_repeat = let(
        F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW))),
        lambda hashes: F.size(F.array_distinct(hashes)) < F.size(hashes),
    )

    def same(ordered):
        def position(window, j):
            before, after = F.get(ordered, j - 1)["window"], F.get(ordered, j + 1)["window"]
            repeated = F.coalesce(window["window"] == before, F.lit(False)) | F.coalesce(
                window["window"] == after, F.lit(False)
            )
            return F.when(repeated, window["start"])

        return F.array_sort(F.array_compact(F.transform(ordered, position)))

    def covered(found):
        reach = F.transform(
            found, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(found, k + 1) - at, F.lit(WINDOW)))
        )
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    ordered = F.array_sort(
        F.transform(
            starts,
            lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("window"), i.alias("start")),
        )
    )
    exact = let(let(ordered, same), covered)
    return F.when((count > WINDOW) & some_repeat, exact).otherwise(F.lit(0)).cast("long")


def measured(documents, text_col="text"):
    """`documents` with the figures that the rules look at; a NULL text has no words."""
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = ["n_lines", "n_distinct_words", "n_capitals", "n_stops", "n_symbol_runs"]
    kept = [c for c in documents.columns if c not in {*figures, *more, "__text", "__words", "__lines"}]
    read = documents.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    text, words, lines = F.col("__text"), F.col("__words"), F.col("__lines")
    cut = read.select(
        "*",
        F.array_remove(F.split(text, BLANKS), "").alias("__words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("__lines"),
    )
    return cut.select(
        *kept,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count(text, F.lit(SYMBOLS + "+")).cast("long").alias("n_symbol_runs"),
        F.regexp_count(text, F.lit("[.,!?]")).cast("long").alias("n_stops"),
    )


def _vote(rule):
    _, measure, bad, good = rule
    value = f"({measure})"
    bad, good = (" ".join(value if w == "x" else w for w in c.split(" ")) for c in (bad, good))
    return F.expr(f"CASE WHEN n_words = 0 THEN {ABSTAIN} WHEN {bad} THEN {BAD} WHEN {good} THEN {GOOD} ELSE {ABSTAIN} END")


def pattern(rules=RULES):
    """All votes of a document as one whole number, base 3."""
    return reduce(lambda code, rule: code * 3 + _vote(rule) + 1, rules, F.lit(0)).alias("pattern")


def _chance_of_good(votes, guess):
    """Posterior probability of a good document."""
    odds = F.ln(guess["good_share"] / (1 - guess["good_share"]))
    each = F.arrays_zip(votes.alias("vote"), guess["on_good"].alias("on_good"), guess["on_bad"].alias("on_bad"))

    def add(total, rule):
        bad = F.ln(rule["on_good"] / rule["on_bad"])
        good = F.ln((1 - rule["on_good"]) / (1 - rule["on_bad"]))
        return total + F.when(rule["vote"] == BAD, bad).when(rule["vote"] == GOOD, good).otherwise(F.lit(0.0))

    return 1 / (1 + F.exp(-F.aggregate(each, odds, add)))


def _total(items, value):
    return F.aggregate(items, F.lit(0.0), lambda total, item: total + value(item))


def _better_guess(patterns, guess, n_rules):
    """One round: posterior of each pattern, then the figures these posteriors imply."""

    def figures(weighted):
        def bad_votes(j, weight):
            bad = _total(weighted, lambda p: F.when(F.get(p["votes"], F.lit(j)) == BAD, p[weight]).otherwise(F.lit(0.0)))
            cast = _total(weighted, lambda p: F.when(F.get(p["votes"], F.lit(j)) != ABSTAIN, p[weight]).otherwise(F.lit(0.0)))
            return bad, cast

        good, bad = _total(weighted, lambda p: p["good"]), _total(weighted, lambda p: p["bad"])

        def anchored(part, whole, first):
            imagined = (good + bad) * ANCHOR
            return (part + imagined * first) / (whole + imagined)

        share, on_good, on_bad = FIRST_GUESS
        return F.struct(
            anchored(good, good + bad, share).alias("good_share"),
            F.array(*[anchored(*bad_votes(j, "good"), on_good) for j in range(n_rules)]).alias("on_good"),
            F.array(*[anchored(*bad_votes(j, "bad"), on_bad) for j in range(n_rules)]).alias("on_bad"),
        )

    def weigh(p):
        chance = _chance_of_good(p["votes"], guess)
        return let(
            chance,
            lambda c: F.struct(p["votes"].alias("votes"), (p["n"] * c).alias("good"), (p["n"] * (1 - c)).alias("bad")),
        )

    return let(F.transform(patterns, weigh), figures)


def label_model(patterns, n_rules=len(RULES), rounds=ROUNDS):
    """Posterior per pattern, from `pattern` and its count `n`.

    There are at most 3^rules patterns, whatever the number of documents, so one row
    holds them all.
    """
    votes = F.transform(
        F.sequence(F.lit(n_rules - 1), F.lit(0)),
        lambda j: (F.floor(F.col("pattern") / F.pow(F.lit(3), j)) % 3 - 1).cast("int"),
    )
    gathered = patterns.select(F.struct("pattern", votes.alias("votes"), "n").alias("p")).agg(
        F.array_sort(F.collect_list("p")).alias("patterns")
    )
    share, on_good, on_bad = FIRST_GUESS
    first = F.struct(
        F.lit(share).alias("good_share"),
        F.array(*[F.lit(on_good)] * n_rules).alias("on_good"),
        F.array(*[F.lit(on_bad)] * n_rules).alias("on_bad"),
    )
    last = F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)),
        first,
        lambda guess, _: _better_guess(F.col("patterns"), guess, n_rules),
    )
    fitted = gathered.select("patterns", F.when(F.size("patterns") > 0, last).otherwise(first).alias("model"))

    def judge(p):
        return F.struct(p["pattern"], _chance_of_good(p["votes"], F.col("model")).alias("chance_of_good"))

    return fitted.select(F.explode(F.transform("patterns", judge)).alias("p")).select("p.*")


def judged(documents, text_col="text", carry=None, rules=RULES):
    """The columns `carry` (all by default) with the base figures, base_failed, chance_of_good and kept.

    The texts are read once. What is known of each document is stored, its vote patterns are
    counted, and the posterior of a pattern, one of a few thousand, is broadcast
    back. Columns of `carry` named like a result column are replaced.
    """
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    replaced = {*results, "pattern", "base_failed", "chance_of_good", "kept"}
    carried = [c for c in (carry or documents.columns) if c not in replaced]
    voted = stored(measured(documents, text_col).select(*carried, *results, pattern(rules)), "votes")
    chances = label_model(voted.groupBy("pattern").agg(F.count("*").alias("n")), len(rules))
    base_failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return voted.join(F.broadcast(stored(chances, "chances")), "pattern").select(
        *carried,
        *results,
        base_failed.alias("base_failed"),
        (~base_failed & (F.col("chance_of_good") >= 0.5)).alias("kept"),
        "chance_of_good",
    )


def quality(documents, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, the base figures, base_failed, kept, chance_of_good.

    NULL and empty texts have no words, all rules abstain, and they fail the base. Repeated
    rows and NULL ids are documents like others and count as often. An empty table
    gives no rows.
    """
    renamed = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return judged(renamed, carry=["doc_id"])


def good_documents(documents, text_col="text"):
    """The rows of `documents` that the rules keep, with their own columns."""
    packed = documents.select(F.struct("*").alias("__row"), F.col(text_col).alias("__of"))
    return judged(packed, "__of", carry=["__row"]).filter("kept").select("__row.*")
