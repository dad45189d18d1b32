"""The same queries in SQL, where SQL can express them."""

from roadwatch.llm.hilbert import curve_tables
from roadwatch.llm.quality import ANCHOR, FIRST_GUESS, ROUNDS, RULES

WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS symbols
  FROM documents
), draws AS (
  SELECT *, -ln((('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5)
    / 4503599627370496.0) / CASE WHEN size > 0 THEN size / (size + symbols) ELSE 1.0 END AS key
  FROM d
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source
), ratios AS (
  SELECT *, 2 * source_size / weight AS ratio, sum(2 * source_size) OVER w AS capped,
    sum(weight) OVER w AS capped_weight, 1.5 * sum(source_size) OVER () AS goal, sum(weight) OVER () AS all_weight
  FROM sources WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST)
), level AS (
  SELECT max(level) AS level FROM (
    SELECT max(goal) / max(all_weight) AS level, 0 AS ratio, min(ratio) AS next FROM ratios
    UNION ALL
    SELECT (goal - capped) / (all_weight - capped_weight), ratio, lead(ratio) OVER (ORDER BY ratio, source NULLS LAST)
    FROM ratios WHERE capped_weight < all_weight
  ) WHERE ratio <= level AND (level < next OR next IS NULL)
), targets AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM (SELECT *, least((2 * source_size)::DOUBLE, level * weight) AS target FROM sources, level)
), placed AS (
  SELECT doc_id, size, source_size, target, epochs, sum(size) OVER (
    PARTITION BY w.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS earlier
  FROM draws w JOIN targets t ON w.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (epochs + CASE WHEN 2 * earlier + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed"""

BLOCK_NAMING = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""

CHOSEN_PATHS = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * common >= 75 * (s.n + t.n - common)
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, b.y FROM reached r JOIN both_ways b ON r.y = b.x
), least AS (
  SELECT x, min(y) AS component_id FROM reached GROUP BY x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN least ON x = d.doc_id"""


def _weak_supervision():
    """The rules' votes counted per pattern, then one step of the chain per round of estimation."""
    share, on_good, on_bad = FIRST_GUESS
    rules = range(len(RULES))

    def vote(rule):
        _, measure, bad, good = rule
        value = f"({measure})"
        bad, good = (" ".join(value if w == "x" else w for w in c.split(" ")) for c in (bad, good))
        return f"CASE WHEN n_words = 0 THEN -1 WHEN {bad} THEN 0 WHEN {good} THEN 1 ELSE -1 END"

    votes = ", ".join(f"{vote(rule)} AS v{j}" for j, rule in enumerate(RULES))
    names = ", ".join(f"v{j}" for j in rules)
    evidence = " + ".join(
        f"CASE v{j} WHEN 0 THEN ln(g{j} / b{j}) WHEN 1 THEN ln((1 - g{j}) / (1 - b{j})) ELSE 0 END" for j in rules
    )
    chance = f"1 / (1 + exp(-(ln(share / (1 - share)) + {evidence})))"
    steps = [
        f"r0 AS (SELECT {share}::DOUBLE AS share, "
        + ", ".join(f"{on_good}::DOUBLE AS g{j}, {on_bad}::DOUBLE AS b{j}" for j in rules) + ")"
    ]
    for k in range(ROUNDS):
        weighed = f"SELECT p.*, n * ({chance}) AS good, n * (1 - ({chance})) AS bad FROM patterns p, r{k}"
        whole, imagined = "sum(good + bad)", f"(sum(good + bad) * {ANCHOR})"
        columns = [f"(sum(good) + {imagined} * {share}) / ({whole} + {imagined}) AS share"]
        for j in rules:
            for name, weight, first in (("g", "good", on_good), ("b", "bad", on_bad)):
                part, cast = (f"sum(CASE WHEN v{j} {test} THEN {weight} ELSE 0 END)" for test in ("= 0", "<> -1"))
                columns.append(f"({part} + {imagined} * {first}) / ({cast} + {imagined}) AS {name}{j}")
        steps.append(f"r{k + 1} AS MATERIALIZED (SELECT {', '.join(columns)} FROM ({weighed}))")
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, start, array_to_string(words[start:start + 7], ' ') AS eight
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS start FROM texts WHERE len(words) >= 8)
), repeated AS (
  SELECT doc_id, count(DISTINCT start + k) AS n FROM (
    SELECT doc_id, start, count(*) OVER (PARTITION BY doc_id, eight) AS times FROM windows
  ), range(8) t(k) WHERE times > 1 GROUP BY doc_id
), measured AS (
  SELECT t.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(list_distinct(words)) AS n_distinct_words, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
    len(regexp_extract_all(text, '[#*$%&|<>]+')) AS n_symbol_runs,
    length(regexp_replace(text, '[^.,!?]', '', 'g')) AS n_stops
  FROM texts t LEFT JOIN repeated r ON r.doc_id = t.doc_id
), voted AS (
  SELECT *, {votes} FROM measured
), patterns AS MATERIALIZED (
  SELECT {names}, count(*) AS n FROM voted GROUP BY ALL
), {", ".join(steps)}, judged AS (
  SELECT v.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {chance} AS chance
  FROM voted v, r{ROUNDS}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND chance >= 0.5 AS kept, round(chance, 6) AS chance_of_good
FROM judged"""


def _crc32(nibbles):
    """CRC-32 of a list of half bytes, low half first, by the table of the reflected polynomial."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    step = f"lambda c, x: xor((CAST({table} AS BIGINT[]))[(xor(c, x) & 15) + 1], c >> 4)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {nibbles}), {step}), 4294967295)"


def _hilbert_shards(bits=8):
    """Cells of the three columns, then one step of the curve's state machine per bit."""
    digits, following = curve_tables(3)
    steps = ["c0 AS (SELECT *, 0 AS state, 0::BIGINT AS curve FROM cells)"]
    for n, bit in enumerate(reversed(range(bits))):
        corner = f"((a >> {bit}) & 1) + 2 * ((b >> {bit}) & 1) + 4 * ((c >> {bit}) & 1)"
        steps.append(
            f"c{n + 1} AS (SELECT * REPLACE ({following}[state * 8 + {corner} + 1] AS state, "
            f"curve * 8 + {digits}[state * 8 + {corner} + 1] AS curve) FROM c{n})"
        )
    return f"""
WITH d AS (
  SELECT doc_id, source, lang, strlen(coalesce(text, '')) + 1 AS size,
    string_split(hex(encode(coalesce(text, ''))), '') AS h
  FROM documents
), sums AS (
  SELECT doc_id, source, lang, size, {_crc32("""list_transform(range(0, 2 * (size - 1)),
    lambda i: (strpos('0123456789ABCDEF', h[xor(i, 1) + 1]) - 1)::BIGINT)""")} AS text_crc32
  FROM d
), sources AS (
  SELECT source, (row_number() OVER (ORDER BY source NULLS FIRST) - 1) * 256 // count(*) OVER () AS a
  FROM (SELECT DISTINCT source FROM documents)
), langs AS (
  SELECT lang, (row_number() OVER (ORDER BY lang NULLS FIRST) - 1) * 256 // count(*) OVER () AS b
  FROM (SELECT DISTINCT lang FROM documents)
), cells AS (
  SELECT s.*, a, b, least(255, (strlen(bin(size)) - 1) * 4 + 1 + CASE WHEN strlen(bin(size)) >= 3
    THEN (size >> (strlen(bin(size)) - 3)) & 3 ELSE 0 END) AS c
  FROM sums s JOIN sources t ON s.source IS NOT DISTINCT FROM t.source
  JOIN langs l ON s.lang IS NOT DISTINCT FROM l.lang
), {", ".join(steps)}, placed AS (
  SELECT *, row_number() OVER (ORDER BY curve, doc_id, size) - 1 AS position, count(*) OVER () AS total
  FROM c{bits}
), cut AS (SELECT *, position * 8 // total AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY position) - 1 AS slot, NULL::INT AS grown_shard, curve
FROM cut"""


# Bytes as hexadecimal digits, two each; strings of 400 bytes are compared by their digest. Texts are taken in
# overlapping parts, since finding a place in a string takes time in proportion to it.
SUFFIX_ARRAYS = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), parts AS (
  SELECT doc_id, first, n, substr(h, 2 * first + 1, 2000) AS h
  FROM (SELECT doc_id, h, n, unnest(range(0, n - 399, 601)) AS first FROM d WHERE n >= 400)
), starts AS (
  SELECT doc_id, start, md5(substr(h, 2 * (start - first) + 1, 800)) AS string
  FROM (SELECT doc_id, first, h, unnest(range(first, least(first + 601, n - 399))) AS start FROM parts)
), again AS (
  SELECT doc_id, start FROM (SELECT doc_id, start, count(*) OVER (PARTITION BY string) AS times FROM starts)
  WHERE times > 1
), runs AS (
  SELECT doc_id, start, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start) AS run FROM (
    SELECT doc_id, start, CASE WHEN start <= lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 400
      THEN 0 ELSE 1 END AS fresh FROM again)
), spans AS (
  SELECT doc_id, min(start) AS a, max(start) + 400 AS b FROM runs GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL
  SELECT d.doc_id, coalesce(max(b), 0), any_value(n) FROM d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id
), kept AS (
  SELECT g.doc_id, string_agg(CASE WHEN b > a THEN h[2 * a + 1:2 * b] ELSE '' END, '' ORDER BY a, b) AS h
  FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id
), lost AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(kept.h)) AS kept_sha256
FROM d LEFT JOIN lost ON lost.doc_id = d.doc_id JOIN kept ON kept.doc_id = d.doc_id"""

PRESENCE_MASKS = r"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL
), lengths AS (
  SELECT doc_id, sum(tf) AS n FROM tfs GROUP BY doc_id
), totals AS (
  SELECT count(*) AS docs, sum(n) AS terms FROM lengths
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs, totals GROUP BY term
), measures AS (
  SELECT doc_id, (25 + (75 * n * docs) // terms)::BIGINT AS m FROM lengths, totals
), scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN measures USING (doc_id) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10"""

ORACLES = {
    "op1_chosen_paths": CHOSEN_PATHS,
    "op2_hilbert_shards": _hilbert_shards(),
    "op4_weak_supervision": _weak_supervision(),
    "op8_source_mix": MIX,
    "op9_suffix_arrays": SUFFIX_ARRAYS,
    "op10_block_naming": BLOCK_NAMING,
    "op11_presence_masks": PRESENCE_MASKS,
}
