"""DuckDB SQL with the results of the queries that SQL can state."""

from __future__ import annotations

from millrace.llm.chat import BEGIN, CONTROL, END, FINISH, TEXT, TURN
from millrace.llm.common import ASCII_UPPER
from millrace.llm.lexical import TERM
from millrace.llm.quality import ALPHA, DELTA, LADDER

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_SPACES = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

_RUNGS = ", ".join(f"({i}, {', '.join(map(str, rung))})" for i, rung in enumerate(LADDER, 1))

QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, {_WORDS.format("text")} AS words FROM d),
wi AS (SELECT rid, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
wk AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i:i + 4]) AS n FROM wi),
rep AS (
    SELECT rid, sum(least(5, coalesce(gap, 5))) AS n
    FROM (SELECT rid, lead(i) OVER (PARTITION BY rid ORDER BY i) - i AS gap FROM wk WHERE n > 1) GROUP BY rid),
ln AS (
    SELECT rid, count(*) AS n, count(DISTINCT line) AS distinct_n
    FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE trim(line, {_SPACES}) <> '' GROUP BY rid),
m AS (
    SELECT d.doc_id, d.lang, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(ln.n - ln.distinct_n, 0)::BIGINT AS n_dup_lines, coalesce(ln.n, 0) AS n_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words
    FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN ln USING (rid)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
ladder(rung, symbols, dup, repeated, longest, shortest) AS (VALUES {_RUNGS}),
good AS (
    SELECT * FROM j WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
broken AS (
    SELECT lang, rung, count(*) AS n, count(*) FILTER (
        100 * n_symbols > symbols * n_words OR 100 * n_dup_lines > dup * n_lines OR 100 * n_repeat_words > repeated * n_words
        OR 10 * word_chars > longest * n_words OR 10 * word_chars < shortest * n_words) AS k
    FROM good, ladder GROUP BY lang, rung),
tail AS (
    SELECT lang, rung, n, k, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA}) + (n - i) * ln(1 - {ALPHA}))) AS p
    FROM (SELECT *, unnest(range(0, k + 1)) AS i FROM broken) GROUP BY ALL),
chosen AS (
    SELECT lang, max(rung) AS rung FROM tail
    WHERE k <= {ALPHA} * n AND p <= {DELTA} / (SELECT count(*) FROM broken) GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce(
        100 * n_symbols > symbols * n_words OR 100 * n_dup_lines > dup * n_lines OR 100 * n_repeat_words > repeated * n_words
        OR 10 * word_chars > longest * n_words OR 10 * word_chars < shortest * n_words, false) AS kept
FROM j LEFT JOIN chosen ON j.lang IS NOT DISTINCT FROM chosen.lang LEFT JOIN ladder USING (rung)
"""


def _escaped(column: str) -> str:
    sql = f"replace({column}, '\\', '\\\\')"
    for c in CONTROL:
        sql = f"replace({sql}, '{c}', '{c[0]}\\{c[1:]}')"
    return sql


CHAT = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role IS NOT DISTINCT FROM 'assistant' AS learned
    FROM (FROM conversations UNION ALL
        VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) AS c(conv_id, turn, role, text))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (learned), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (learned), '')) AS loss_sha256,
    ({len(BEGIN) + len(FINISH)} + sum({len(TURN) + len(TEXT) + len(END)} + length({_escaped("role")}) + length({_escaped("text")})))::BIGINT
        AS formatted_chars
FROM said GROUP BY conv_id
"""

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
k AS (SELECT *, translate(trim(line, {_SPACES}), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}') AS key FROM l),
shared AS (
    SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT k.*, owner IS NOT NULL AND doc_id < owner AS dropped FROM k LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY rid, doc_id
"""

# Every place of every item over every document, found by single words; no seeds.
OVERLAPS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("lower(text)")} AS words FROM documents),
b AS (SELECT row_number() OVER () AS bid, item_id, {_WORDS.format("lower(text)")} AS words FROM benchmark),
dw AS (SELECT rid, doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS p FROM d),
bw AS (SELECT bid, item_id, len(words) AS item_words, unnest(words) AS w, generate_subscripts(words, 1) AS q FROM b),
pairs AS (
    SELECT rid, doc_id, bid, item_id, item_words, p - q AS shift,
        count(*) OVER (PARTITION BY rid, bid, p - q ORDER BY q RANGE BETWEEN 12 PRECEDING AND CURRENT ROW) AS n
    FROM dw JOIN bw USING (w)),
places AS (
    SELECT doc_id, item_id, item_words, max(n) AS matched, count(*) AS item_hits
    FROM pairs GROUP BY rid, doc_id, bid, item_id, item_words, shift)
SELECT doc_id, item_id, max(matched)::BIGINT AS matched, max(item_words)::BIGINT AS item_words, max(item_hits)::BIGINT AS item_hits
FROM places WHERE matched >= CASE WHEN item_words >= 13 THEN 11 ELSE item_words END
GROUP BY doc_id, item_id
"""

_FRAMED = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = f"sha256(concat({', '.join(_FRAMED.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars', '{text}'))}))"


def _tree(name: str, leaves: str) -> str:
    """Nodes (grp, level, i, h, n) of the trees over leaves (grp, i, h, n), level by level."""
    return f"""{name}(grp, level, i, h, n) AS (
    SELECT grp, 0, i, h, n FROM {leaves}
    UNION ALL
    SELECT grp, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), max((n + 2) // 3) FROM {name} WHERE n > 1 GROUP BY grp, level, i // 3)"""


def _sides(rows: str, tree: str) -> str:
    """Siblings of the leaves of ``rows`` in ``tree``, as 'left|right' per level."""
    return f"""
    SELECT rid, own.level, coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < own.i), '') || '|'
        || coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > own.i), '') AS step
    FROM {rows} JOIN {tree} AS own ON own.grp IS NOT DISTINCT FROM {rows}.grp AND own.i = {rows}.i // (3 ** own.level)::BIGINT AND own.n > 1
    JOIN {tree} AS s ON s.grp IS NOT DISTINCT FROM own.grp AND s.level = own.level AND s.i // 3 = own.i // 3
    GROUP BY rid, own.level"""


# crc32 bit by bit: a table of 256 values, then a step per digit.
MERKLE = f"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS t
    FROM range(256) AS r(i)),
d AS (SELECT row_number() OVER () AS rid, * FROM documents),
l AS (
    SELECT rid, doc_id, source AS grp, {_LEAF.format(text="text")} AS h,
        {_LEAF.format(text="replace(text, chr(10), '')")} AS cut,
        xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 2 = 0 AS touched
    FROM d, crc),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY grp) AS n FROM l),
{_tree("lower", "leaves")},
groups AS (
    SELECT row_number() OVER () AS rid, 0 AS grp, lower.grp AS of, h,
        row_number() OVER (ORDER BY lower.grp NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM lower WHERE n = 1),
{_tree("upper", "groups")},
below AS ({_sides("leaves", "lower")}),
above AS ({_sides("groups", "upper")}),
paths AS (
    SELECT rid, list(step ORDER BY place, level) AS path FROM (
        SELECT rid, 0 AS place, level, step FROM below UNION ALL
        SELECT leaves.rid, 1, above.level, step
        FROM leaves JOIN groups ON groups.of IS NOT DISTINCT FROM leaves.grp JOIN above ON above.rid = groups.rid) GROUP BY rid),
proved AS (
    SELECT doc_id, leaves.h AS leaf, groups.h AS subroot, (SELECT h FROM upper WHERE n = 1) AS root,
        sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) AS proof_sha256,
        list_reduce([CASE WHEN touched AND text_cut THEN cut ELSE leaves.h END] || coalesce(path, []),
            lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
    FROM (SELECT *, cut <> h AS text_cut FROM leaves) AS leaves
    JOIN groups ON groups.of IS NOT DISTINCT FROM leaves.grp LEFT JOIN paths ON paths.rid = leaves.rid)
SELECT *, folded_root = root AS verified FROM proved
"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'), '{TERM}')"

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS terms FROM documents),
n AS (SELECT rid, doc_id, len(terms) AS n FROM d),
total AS (SELECT count(*) FILTER (n > 0) AS docs, sum(n)::BIGINT AS terms FROM n),
dt AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM dt GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM df, total),
i AS (
    SELECT iid, item_id, term, count(*) AS qtf
    FROM (SELECT row_number() OVER () AS iid, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
weighed AS (
    SELECT rid, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total.terms)) AS damped
    FROM dt JOIN n USING (rid), total),
scored AS (
    SELECT iid, item_id, rid, sum(qtf * w * damped)::BIGINT AS score
    FROM i JOIN w USING (term) JOIN weighed USING (term) GROUP BY ALL),
placed AS (
    SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
    FROM scored JOIN n USING (rid) WHERE score > 0)
SELECT * FROM placed WHERE rank <= 20
"""
