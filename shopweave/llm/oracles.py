"""SQL of the queries that SQL can express."""

from __future__ import annotations

from .chat import BUDGET, HISTORY, MARKS, STRETCH, TOKEN
from .quality import COVERED_PCT, LINES_PCT, MAX_REPEAT_PCT, MIN_WORDS

SPACE = r"[\x20\x09-\x0D]"

EMBEDDINGS = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors AS a JOIN vectors AS b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links, l.component_id,
    e.vec_id = l.component_id AS kept
FROM embeddings AS e JOIN least AS l ON l.a = e.vec_id
"""


def quality() -> str:
    """Words and windows one by one; a word is inside a repeat if a repeated window began at it or up
    to n - 1 words before."""
    lengths = [3, *COVERED_PCT]
    most = max(lengths)
    next_words = ", ".join(f"lead(word, {k}) OVER w AS w{k}" for k in range(1, most))
    windows = ", ".join(
        f"CASE WHEN w{n - 1} IS NOT NULL THEN concat_ws(' ', word, {', '.join(f'w{k}' for k in range(1, n))}) END AS g{n}"
        for n in lengths
    )
    twice = ", ".join(f"g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{n}) > 1 AS t{n}" for n in lengths)
    inside = ", ".join(
        f"bool_or(t{n}) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS i{n}"
        for n in lengths
    )
    covered = ", ".join(f"coalesce(sum(length(word)) FILTER (WHERE i{n}), 0) AS covered_{n}" for n in COVERED_PCT)
    within = "".join(f" AND 100 * covered_{n} <= {pct} * word_chars" for n, pct in COVERED_PCT.items())
    counts = ["n_words", "word_chars", "n_repeat_words", *(f"covered_{n}" for n in COVERED_PCT)]
    return f"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACE.replace("[", "[^")}+') AS ws FROM documents
), words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM split
), following AS (SELECT *, {next_words} FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY place)
), windows AS (SELECT doc_id, word, place, {windows} FROM following),
repeats AS (SELECT doc_id, word, place, {twice} FROM windows),
inside AS (SELECT doc_id, word, {inside} FROM repeats),
sums AS (
    SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (WHERE i3) AS n_repeat_words, {covered}
    FROM inside GROUP BY doc_id
), lines AS (
    SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY place) AS nth FROM (
        SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
    )
), again AS (
    SELECT doc_id, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '{SPACE}', '', 'g'))) AS dup_line_chars
    FROM lines WHERE nth > 1 AND regexp_matches(line, '{SPACE.replace("[", "[^")}') GROUP BY doc_id
), found AS (
    SELECT d.doc_id, {", ".join(f"CAST(coalesce(s.{c}, 0) AS BIGINT) AS {c}" for c in counts)},
        CAST(coalesce(a.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(a.dup_line_chars, 0) AS BIGINT) AS dup_line_chars,
        CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols
    FROM documents AS d LEFT JOIN sums AS s ON s.doc_id = d.doc_id LEFT JOIN again AS a ON a.doc_id = d.doc_id
), base AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM found
)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= {LINES_PCT} * word_chars{within} AS kept FROM base
"""


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = f"""
WITH pieces AS (
    SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM (SELECT coalesce(lang, 'und') AS lang, {LOWER.format("coalesce(text, '')")} AS text FROM documents)
), words AS (
    SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
    FROM (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws, unnest([1, 2, 3]) AS k FROM pieces)
), grams AS (SELECT lang, array_to_string(ws[i : i + k - 1], ' ') AS phrase, k FROM words WHERE i + k - 1 <= len(ws)
), found AS MATERIALIZED (SELECT lang, phrase, k, count(*) AS a FROM grams GROUP BY lang, phrase, k
), sums AS (SELECT lang, sum(a) AS n FROM found WHERE k = 1 GROUP BY lang
), candidates AS (SELECT lang, phrase, k AS size, a, string_split(phrase, ' ') AS ws FROM found WHERE k > 1 AND a >= 10
), parts AS MATERIALIZED (
    SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1 : size], ' ') AS tail
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), cut AS (
    SELECT c.lang, c.phrase, c.a, f.a AS l, r.a AS r, c.k,
        CAST(1000000 * CAST(c.a AS HUGEINT) * c.a // (CAST(f.a AS HUGEINT) * r.a) AS BIGINT) AS score
    FROM parts AS c JOIN found AS f ON f.lang = c.lang AND f.phrase = c.head JOIN found AS r ON r.lang = c.lang AND r.phrase = c.tail
), lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, phrase, max(a) AS a FROM (
        SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM candidates WHERE size = 3
    ) GROUP BY lang, phrase
), ranked AS (
    SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM (SELECT c.*, x.a AS around FROM lowest AS c LEFT JOIN longer AS x USING (lang, phrase))
    WHERE around IS NULL OR 100 * around < 50 * a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN sums USING (lang) WHERE rank <= 2000
"""

SEARCH = f"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS row,
        regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts
    FROM documents
), sums AS (SELECT count(*) AS docs, sum(len(ts)) AS length FROM docs WHERE len(ts) > 0
), sized AS (
    SELECT row, doc_id, CAST(75 + 25 * len(ts) * CAST(docs AS HUGEINT) // length AS BIGINT) AS m FROM docs, sums WHERE len(ts) > 0
), tfs AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ts) AS term FROM docs) GROUP BY row, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), sums
), wanted AS (
    SELECT item, item_id, term, count(*) AS times FROM (
        SELECT item_id, row_number() OVER () AS item,
            unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM benchmark
    ) GROUP BY item, item_id, term
), scores AS (
    SELECT item, item_id, row, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM wanted JOIN weights USING (term) JOIN tfs USING (term) JOIN sized USING (row) GROUP BY item, item_id, row, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""



def chat() -> str:
    """Windows turn by turn: a turn opens one if it doesn't fit, or begins a stretch."""
    escaped = "replace(replace(replace({}, '\\', '\\s'), '###', '\\h'), '</turn>', '\\t')"
    return f"""
WITH RECURSIVE rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\\### Assistant: </turn> ok'
), turns AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place,
        len(regexp_extract_all({escaped.format("text")}, '{TOKEN}')) + {MARKS} AS tokens,
        length('### ' || {escaped.format("role")} || ': ' || {escaped.format("text")} || '</turn>') + 1 AS chars
    FROM rows
), placed AS (
    SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        coalesce(max(CASE WHEN place = 0 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id), 0) AS own
    FROM turns
), opened AS (
    SELECT conv_id, place, place AS first, before AS start, before // {STRETCH} AS stretch FROM placed WHERE place = 0
    UNION ALL
    SELECT t.conv_id, t.place, CASE WHEN fits THEN o.first ELSE t.place END, CASE WHEN fits THEN o.start ELSE t.before END, t.before // {STRETCH}
    FROM opened AS o JOIN placed AS t ON t.conv_id = o.conv_id AND t.place = o.place + 1,
    LATERAL (SELECT t.before // {STRETCH} = o.stretch AND t.before + t.tokens - o.start <= {BUDGET - HISTORY} - t.own AS fits)
), starts AS (SELECT DISTINCT conv_id, first, start FROM opened
), repeats AS (
    SELECT s.conv_id, sum(t.chars) AS chars FROM starts AS s JOIN placed AS t ON t.conv_id = s.conv_id AND t.place < s.first
    WHERE s.start - t.before <= {HISTORY} OR t.place = 0 AND t.role = 'system' GROUP BY s.conv_id
), sizes AS (SELECT conv_id, count(*) AS n_windows FROM starts GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(t.chars) + coalesce(any_value(r.chars), 0) AS BIGINT) AS formatted_chars, any_value(n_windows) AS n_windows
FROM turns AS t JOIN sizes USING (conv_id) LEFT JOIN repeats AS r USING (conv_id) GROUP BY conv_id
"""


ORACLES: dict[str, str] = {
    "op1_embedding_near_dedup": EMBEDDINGS,
    "op4_quality_rules": quality(),
    "op11_phrase_collocations": COLLOCATIONS,
    "op12_chat_formatting": chat(),
    "op13_ranked_lexical_search": SEARCH,
}
