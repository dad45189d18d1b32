"""Small tables that hold what operators must not trip over."""

import random

WORDS = "the of and to in is it on as with for was that by this from are or an be one all have not".split()


def prose(seed, words=60, lines=6):
    """Invented prose of distinct enough sentences."""
    pick = random.Random(seed)
    out = []
    for _ in range(lines):
        line = [pick.choice(WORDS) + pick.choice("abcdefghij") + pick.choice(WORDS) for _ in range(words // lines)]
        out.append(" ".join(line).capitalize() + ".")
    return "\n".join(out)


COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, size string, kept string, shard string, "
    "slot string, total string, position string, curve string, target string, key string, pattern string, "
    "n_words string, n_lines string, n_removed string, group string, part string, name string, copies string, "
    "spans string, candidates string, ids string, host string, component_id string, node string, key_1 string"
)
EXTRA = COLUMNS.count(",") - 4


def edge_rows():
    """(doc_id, text, lang, source): NULLs in any column, empty, blank and long texts, repeated rows, copies."""
    long = "\n".join(prose(1000 + i, 300, 10) for i in range(60))
    return [
        (1, prose(1), "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, "b"),
        (4, " \n\t ", "de", None),
        (5, prose(1), "en", "b"),
        (6, prose(6), "en", "a"),
        (6, prose(6), "en", "a"),
        (7, long, "fr", "c"),
        (8, "x" * 5000, None, None),
        (None, prose(9), "en", "c"),
        (None, prose(10), None, None),
        (11, "Ünï 日本語 \U0001f642 \x00 end", "fr", "c"),
        (12, "one two", "en", "a"),
        (6, prose(12), "en", "a"),
    ]


def table(spark, rows, columns=COLUMNS):
    """A frame of (doc_id, text, lang, source) with n_chars and columns that clash with results."""
    full = [(*row, None if row[1] is None else len(row[1]), *["extra"] * EXTRA) for row in rows]
    return spark.createDataFrame(full, columns)


def plain(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)
