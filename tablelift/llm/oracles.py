"""The same results as the named queries, in DuckDB's SQL."""

# A to Z in lower case, and words as runs of anything but white space.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {WORDS.format(LOWER)} AS ws FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')]
        ELSE [] END) AS shingles
    FROM words
), sized AS (
    SELECT doc_id, len(shingles) AS n, shingles FROM sets
), single AS (
    SELECT doc_id, n, unnest(shingles) AS shingle FROM sized
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS node, doc_id AS other FROM documents
    UNION
    SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other
), least_reached AS (
    SELECT node, min(other) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sized JOIN least_reached ON node = doc_id
"""

LINE_DEDUP = r"""
WITH split AS (
    SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), line AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM split
), worded AS (
    SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM line
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), counted AS (
    SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) - words AS ahead,
        sum(words) OVER (PARTITION BY doc_id) AS whole
    FROM worded
), reached AS (
    SELECT doc_id, pos, whole - ahead AS rest, ahead + words AS upto, words,
        max(pos) OVER forth AS last, list(line) OVER forth AS forth_lines,
        min(pos) OVER back AS first, list(line) OVER back AS back_lines,
        lag(pos) OVER seq AS pos_before, lag(words) OVER seq AS words_before, lag(line) OVER seq AS line_before, line
    FROM counted
    WINDOW forth AS (PARTITION BY doc_id ORDER BY ahead RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING),
        back AS (PARTITION BY doc_id ORDER BY ahead + words RANGE BETWEEN 49 PRECEDING AND CURRENT ROW),
        seq AS (PARTITION BY doc_id ORDER BY pos)
), windows AS (
    -- A run of 50 words or more is covered by the least runs from its lines on, and up to
    -- them; two lines of 50 words each also take the lines without words in between along.
    SELECT doc_id, pos, last, forth_lines AS content FROM reached WHERE rest >= 50
    UNION SELECT doc_id, first, pos, back_lines FROM reached WHERE upto >= 50
    UNION SELECT doc_id, pos_before, pos, [line_before, line] FROM reached WHERE words >= 50 AND words_before >= 50
), placed AS (
    SELECT doc_id, pos, last,
        first_value(doc_id) OVER f AS first_doc, first_value(last) OVER f AS first_last
    FROM windows
    WINDOW f AS (PARTITION BY content ORDER BY doc_id, pos)
), gone AS (
    SELECT doc_id, list(DISTINCT p) AS gone FROM (
        SELECT doc_id, unnest(range(pos, last + 1)) AS p FROM placed
        WHERE doc_id <> first_doc OR pos > first_last
    ) GROUP BY doc_id
), cleaned AS (
    SELECT d.*, gone,
        CASE WHEN gone IS NULL THEN d.text ELSE coalesce(array_to_string(
            [l FOR l, i IN string_split(d.text, chr(10)) IF NOT list_contains(gone, i - 1)], chr(10)), '') END AS clean
    FROM documents d LEFT JOIN gone g ON g.doc_id = d.doc_id
)
SELECT doc_id, clean AS text, lang, source,
    CASE WHEN gone IS NULL THEN n_chars ELSE length(clean) END AS n_chars,
    CAST(coalesce(len(gone), 0) AS BIGINT) AS n_lines_removed
FROM cleaned
"""

# (rule, share of, per, cutoffs in percent from loose to strict).
RULE_ROWS = """
    ('symbols', [50, 30, 20, 10, 5, 2]), ('dup_lines', [80, 60, 50, 40, 30, 20]),
    ('repeats', [90, 80, 70, 60, 50, 40, 30, 20]), ('capitals', [80, 60, 40, 30, 20]),
    ('long_words', [3000, 2000, 1500, 1200, 1000])
"""

QUALITY_RULES = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT doc_id, stratum, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        [l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
    FROM texts
), grams AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS gram
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM split)
), again AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM grams) WHERE times > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id
), measured AS (
    SELECT s.doc_id, stratum, len(ws) AS n_words, list_sum([length(w) FOR w IN ws] || [0]) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
        len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(c.n, 0) AS n_repeat_words
    FROM split s LEFT JOIN covered c ON c.doc_id = s.doc_id
), shares AS (
    SELECT doc_id, stratum, unnest([
        {{'rule': 'symbols', 'part': n_symbols, 'per': word_chars}},
        {{'rule': 'dup_lines', 'part': n_dup_lines, 'per': n_lines}},
        {{'rule': 'repeats', 'part': n_repeat_words, 'per': n_words}},
        {{'rule': 'capitals', 'part': n_capitals, 'per': word_chars}},
        {{'rule': 'long_words', 'part': word_chars, 'per': n_words}}], recursive := true)
    FROM measured
), tests AS (
    SELECT rule, unnest(cuts) AS cutoff, unnest(range(0, len(cuts))) AS place
    FROM (VALUES {RULE_ROWS}) AS r(rule, cuts)
), marks AS (
    SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), counted AS (
    SELECT stratum, t.rule, cutoff, place, count(*) FILTER (quality >= 1) AS trials,
        count(*) FILTER (quality >= 1 AND 100 * part > cutoff * per) AS hits,
        count(*) FILTER (quality < 1 AND 100 * part > cutoff * per) AS caught
    FROM shares s JOIN marks USING (doc_id) JOIN tests t ON t.rule = s.rule GROUP BY ALL
), tested AS (
    SELECT *, CASE WHEN hits < trials * 0.01 THEN list_sum([
        exp(lgamma(trials + 1) - lgamma(j + 1) - lgamma(trials - j + 1) + j * ln(0.01) + (trials - j) * ln(0.99))
        FOR j IN range(0, hits + 1)]) ELSE 1 END
        > 0.05 / (5 * (SELECT count(DISTINCT stratum) FROM counted)) AS fails
    FROM counted
), safe AS (
    SELECT *, max(fails) OVER (PARTITION BY stratum, rule ORDER BY place) AS stopped FROM tested
), best AS (
    SELECT stratum, rule, min(cutoff) AS cutoff FROM safe
    WHERE NOT stopped AND caught >= hits AND caught > 0 GROUP BY stratum, rule
), over AS (
    SELECT DISTINCT doc_id FROM shares s JOIN best b ON b.stratum = s.stratum AND b.rule = s.rule
    WHERE 100 * part > cutoff * per
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols,
    CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND doc_id NOT IN (SELECT doc_id FROM over) AS kept
FROM measured
"""


# CRC-32 of ``key``, byte by byte and bit by bit.
CRC32 = """xor(4294967295, list_reduce(
    [4294967295] || list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))"""

# v[state + 1] is the cost to the end; states: nothing, after system, user, assistant.
REPAIR = rf"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations
), hit AS (
    SELECT *, {CRC32} % 20 AS fault FROM keyed
), damaged AS (
    SELECT conv, turn, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy,
        CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hit
), ordered AS (
    SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) AS times,
        role[1] AS r, lag(role[1]) OVER w AS r_before,
        right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS closing
    FROM damaged WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy)
), told AS MATERIALIZED (
    SELECT *, CASE WHEN closing = '' THEN 'blank' WHEN times > 1 THEN 'duplicate'
        WHEN closing NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM ordered
), turns AS MATERIALIZED (
    SELECT conv, i, r, role, text, fault NOT IN ('blank', 'duplicate') AS ok, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS x
    FROM told
), counted AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (i > 1 AND r_before || r NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM told GROUP BY conv
), back AS (
    SELECT conv, n + 1 AS i, [0, 10, 5, 0] AS v FROM counted
    UNION ALL
    SELECT conv, i, [least(b0, 5 + b2, 10 + b3), least(b1, 5 + b2, 10 + b3), least(b2, 5 + b3), least(b3, 5 + b2)] AS v
    FROM (
        SELECT conv, turns.i,
            least(2 + v[1], CASE WHEN ok AND r = 's' THEN x + v[2] WHEN ok AND r = 'u' THEN x + v[3] WHEN ok THEN 1 + x + v[3] END,
                CASE WHEN ok THEN 1 + x + v[3] END) AS b0,
            least(2 + v[2], CASE WHEN ok AND r = 'u' THEN x + v[3] WHEN ok THEN 1 + x + v[3] END) AS b1,
            least(2 + v[3], CASE WHEN ok AND r = 'a' THEN x + v[4] WHEN ok THEN 1 + x + v[4] END) AS b2,
            least(2 + v[4], CASE WHEN ok AND r = 'u' THEN x + v[3] WHEN ok THEN 1 + x + v[3] END) AS b3
        FROM back JOIN turns USING (conv) WHERE turns.i = back.i - 1
    )
), costs AS MATERIALIZED (
    SELECT b.conv, b.i, b.v, a.v AS after, r, role, text, ok, x
    FROM back b LEFT JOIN back a ON a.conv = b.conv AND a.i = b.i + 1 LEFT JOIN turns t ON t.conv = b.conv AND t.i = b.i
), walk AS (
    SELECT conv, 1 AS i, 0 AS state, '' AS audit, CAST([] AS VARCHAR[]) AS said, n + 1 AS stop, false AS done FROM counted
    UNION ALL
    SELECT conv, CASE edit WHEN 'I' THEN i WHEN '' THEN i ELSE i + 1 END,
        CASE edit WHEN 'D' THEN state WHEN '' THEN state WHEN 'K' THEN keeps ELSE fits END, audit || edit,
        CASE edit WHEN 'D' THEN said WHEN '' THEN said WHEN 'K' THEN said || [role || ':' || text]
            ELSE said || [CASE fits WHEN 3 THEN 'assistant:' ELSE 'user:' END || CASE edit WHEN 'I' THEN '' ELSE text END] END,
        stop, edit = ''
    FROM (
        SELECT *, CASE WHEN i = stop AND v[state + 1] = 0 THEN '' WHEN v[state + 1] = 2 + after[state + 1] THEN 'D'
            WHEN v[state + 1] = 5 + v[fits + 1] THEN 'I' WHEN ok AND v[state + 1] = x + after[keeps + 1] THEN 'K' ELSE 'R' END AS edit
        FROM (
            SELECT w.*, v, after, role, text, ok, x, CASE state WHEN 2 THEN 3 ELSE 2 END AS fits,
                CASE WHEN state = 0 AND r = 's' THEN 1 WHEN state <> 2 AND r = 'u' THEN 2 WHEN state = 2 AND r = 'a' THEN 3 END AS keeps
            FROM walk w JOIN costs c ON c.conv = w.conv AND c.i = w.i WHERE NOT done
        )
    )
)
SELECT every.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(v[1], 0) AS BIGINT) AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM keyed) every LEFT JOIN counted USING (conv)
    LEFT JOIN (SELECT * FROM walk WHERE done) finished USING (conv)
    LEFT JOIN (SELECT conv, v FROM back WHERE i = 1) first_costs USING (conv)
"""


def _vector_codes(rounds: int = 6) -> str:
    """Assigning and averaging, round by round: book_r follows from near_r and book_(r - 1)."""
    nearest = """near{r} AS MATERIALIZED (
    SELECT vec_id, p, min(16 * list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) + e) AS key
    FROM part JOIN book{r} USING (p) GROUP BY vec_id, p
)"""
    moved = """mean{r} AS (
    SELECT p, e, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS c FROM (
        SELECT p, CAST(key % 16 AS BIGINT) AS e, i, sum(x[i]) AS total, count(*) AS n
        FROM near{r} JOIN part USING (vec_id, p), range(1, (SELECT w FROM width) + 1) AS place(i) GROUP BY ALL
    ) GROUP BY p, e
), book{next} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m ON m.p = b.p AND m.e = b.e
)"""
    steps = ",\n".join(f"{nearest.format(r=r)}, {moved.format(r=r, next=r + 1)}" for r in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
), width AS (
    SELECT max(len(v)) // 8 AS w FROM kept
), part AS MATERIALIZED (
    SELECT vec_id, p, v[p * w + 1 : (p + 1) * w] AS x FROM kept, width, range(8) AS part(p)
), seed AS (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 16
), book0 AS MATERIALIZED (
    SELECT p, e, x AS c FROM part JOIN seed USING (vec_id)
), {steps}, {nearest.format(r=rounds)}, coded AS (
    SELECT vec_id, string_agg(printf('%02x', CAST(key % 16 AS BIGINT)), '' ORDER BY p) AS code,
        CAST(sum(key // 16) AS BIGINT) AS error
    FROM near{rounds} GROUP BY vec_id
), spelled AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), spelled
"""


ORACLES = {
    "op11_checkpointed_repair": REPAIR,
    "op12_anchor_tree_codes": _vector_codes(),
    "op2_minhash_near_duplicates": NEAR_DUPLICATES,
    "op3_quality_rules": QUALITY_RULES,
    "op9_line_dedup": LINE_DEDUP,
}
