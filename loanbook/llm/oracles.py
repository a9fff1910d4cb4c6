"""DuckDB SQL for the queries of this subpackage that SQL can express."""

import zlib

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _split(text: str, separators: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[{separators}]+'), lambda x: x <> '')"


SPACES = r"\x20\x09-\x0D"
NOT_ALNUM = r"\x00-\x2F\x3A-\x60\x7B-\x7F"

def _places(words: str, key: str) -> str:
    """(key, k, len, w1 ... w13): each word of each row with the twelve after it, from windows over unnested words."""
    following = ", ".join(f"lead(word, {j}) OVER p AS w{j + 1}" for j in range(1, 13))
    return f"""SELECT {key}, k, count(*) OVER (PARTITION BY {key}) AS len, word AS w1, {following}
  FROM (SELECT {key}, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM {words}) AS u WINDOW p AS (PARTITION BY {key} ORDER BY k)"""


_WINDOW = f"array_to_string([{', '.join(f'w{j}' for j in range(1, 14))}][1:n], ' ') AS x"

OP10 = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS r, {_split(LOWER, NOT_ALNUM)} AS w FROM documents),
i AS MATERIALIZED (SELECT coalesce(item_id::VARCHAR, 'null') AS item, row_number() OVER () AS q, {_split(LOWER, NOT_ALNUM)} AS w FROM benchmark),
names AS (SELECT q, item FROM i),
win AS (
  SELECT DISTINCT item, n, {_WINDOW} FROM (SELECT *, least(13, len) AS n FROM ({_places('i', 'q')}) AS v WHERE k <= greatest(1, len - 12)) AS v
  JOIN names USING (q)),
places AS (
  SELECT r, k, n, {_WINDOW} FROM ({_places('d', 'r')}) AS v JOIN (SELECT DISTINCT n FROM win) AS sizes ON k + n - 1 <= len),
hits AS (SELECT r, k, n, item FROM places JOIN win USING (n, x)),
words AS (SELECT r, count(DISTINCT k + j) AS n_hit FROM hits, unnest(range(0, n)) AS t(j) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, item FROM hits) AS x GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_split(LOWER, SPACES)} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS x
  FROM d, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS t(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s AS p JOIN s AS q USING (x)
                    WHERE p.doc_id <> q.doc_id GROUP BY ALL) AS pairs
  JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (SELECT DISTINCT a, a AS b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       coalesce(component_id, doc_id) = doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""


SYMBOLS = "#*$%&|<>"
WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def op2(measures: dict[str, int], least: int, spreads: int) -> str:
    columns = {"symbols": "CASE WHEN word_chars > 0 THEN 10000 * n_symbols // word_chars ELSE 0 END",
               "dup_lines": "CASE WHEN n_lines > 0 THEN 10000 * n_dup_lines // n_lines ELSE 0 END",
               "repeats": "CASE WHEN n_words > 0 THEN 10000 * n_repeat_words // n_words ELSE 0 END",
               "word_length": "CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END"}
    floors = " ".join(f"WHEN '{m}' THEN {x}" for m, x in measures.items())
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {_split('text', SPACES)} AS w,
             list_filter(string_split(text, chr(10)), lambda x: translate(x, {WHITE}, '') <> '') AS lines FROM t),
places AS (SELECT r, k, array_to_string(w[k:k + 7], ' ') AS x FROM w, unnest(range(1, len(w) - 6)) AS u(k)),
twice AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, x) AS c FROM places) AS p WHERE c > 1),
rep AS (SELECT r, count(DISTINCT k + j) AS n FROM twice, unnest(range(0, 8)) AS u(j) GROUP BY r),
c AS (
  SELECT r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(translate(text, {WHITE}, ''))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (r)),
m AS (SELECT r, lang, source, unnest([{', '.join(f"'{m}'" for m in measures)}]) AS measure,
             unnest([{', '.join(columns[m] for m in measures)}]) AS x FROM c),
b AS (SELECT lang, source, measure, (x >> greatest(0, length(bin(x)) - 7)) << greatest(0, length(bin(x)) - 7) AS bucket,
             count(*) AS n FROM m GROUP BY ALL),
sk AS (SELECT 0 AS level, lang, source, measure, bucket, n FROM b
       UNION ALL SELECT 1, lang, NULL, measure, bucket, sum(n) FROM b GROUP BY ALL
       UNION ALL SELECT 2, NULL, NULL, measure, bucket, sum(n) FROM b GROUP BY ALL),
up AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bucket) AS upto,
              sum(n) OVER (PARTITION BY level, lang, source, measure) AS total FROM sk),
q AS (SELECT level, lang, source, measure, max(total) AS total, min(bucket) FILTER (4 * upto >= total) AS q1,
             min(bucket) FILTER (4 * upto >= 3 * total) AS q3 FROM up GROUP BY ALL),
h AS (SELECT level, lang, source, measure, total,
             q3 + {spreads} * greatest(q3 - q1, CASE measure {floors} END) AS high FROM q),
f AS (SELECT o.lang, o.source, o.measure,
             CASE WHEN o.total >= {least} THEN o.high WHEN l.total >= {least} THEN l.high ELSE a.high END AS high
      FROM h AS o JOIN h AS l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure
      JOIN h AS a ON a.measure = o.measure WHERE o.level = 0 AND l.level = 1 AND a.level = 2),
bad AS (SELECT DISTINCT r FROM m JOIN f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
        AND m.measure = f.measure WHERE x > high)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND bad.r IS NULL AS kept
FROM c LEFT JOIN bad USING (r)
"""


def op1(rarity: int) -> str:
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
w AS (SELECT *, translate(line, {WHITE}, '') <> '' AS worded, lead(line) OVER p AS after,
             lead(translate(line, {WHITE}, '') <> '') OVER p AS worded_after FROM l WINDOW p AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, doc_id, i, count(*) OVER (PARTITION BY line, after) AS n FROM w
      WHERE worded AND worded_after AND substr(md5(line || chr(10) || after), 1, 2) >= '{256 // rarity:02x}'),
b AS (SELECT *, lag(i) OVER q = i - 1 AS touches, lag(n) OVER q AS n_before, lead(i) OVER q = i + 1 AS touched, lead(n) OVER q AS n_after
      FROM c WHERE n > 1 WINDOW q AS (PARTITION BY r ORDER BY i)),
g AS (SELECT *, sum(CASE WHEN coalesce(touches, false) AND n_before = n THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS run,
             i + CASE WHEN coalesce(touches, false) AND n_before > n THEN 1 ELSE 0 END AS b,
             i + CASE WHEN coalesce(touched, false) AND n_after > n THEN 0 ELSE 1 END AS e FROM b),
k AS (SELECT r, doc_id, run, arg_min(b, i) AS b, arg_max(e, i) AS e FROM g GROUP BY r, doc_id, run),
x AS (SELECT r, doc_id, b, e, string_agg(line, chr(10) ORDER BY i) AS own FROM (SELECT * FROM k WHERE e > b) AS k JOIN l USING (r, doc_id)
      WHERE i BETWEEN b AND e GROUP BY r, doc_id, b, e),
o AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY doc_id, b) AS place FROM x),
gone AS (SELECT DISTINCT r, unnest(range(b, e + 1)) AS i FROM o WHERE place > 1),
z AS (SELECT r, string_agg(line, chr(10) ORDER BY i) FILTER (gone.i IS NULL) AS stays, count(gone.i) AS lost
      FROM l LEFT JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CASE WHEN lost > 0 THEN coalesce(stays, '') ELSE text END AS text,
       coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(lost, 0)::BIGINT AS n_removed
FROM d LEFT JOIN z USING (r)
"""


OP6 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
s AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM s WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM s LEFT JOIN f USING (payload_digest)
"""


OP9 = """
WITH t AS (SELECT row_number() OVER () AS r, conv_id, turn, replace(replace(replace(coalesce(role, 'unknown'), '<|', '< |'), chr(10), '\\n'), chr(13), '\\r') AS speaker,
                  replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
v AS (SELECT t.*, perspective, CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
                               ELSE 'user' END AS role
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10) AS head FROM v),
s AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM h),
o AS (SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text, r
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM s)
SELECT conv_id, perspective, turn, speaker, role, segment, start, length(segment)::BIGINT AS length,
       CASE WHEN role = 'assistant' THEN start + length(head) ELSE start END::BIGINT AS train_start,
       CASE WHEN role = 'assistant' THEN length(text) + 10 ELSE 0 END::BIGINT AS train_length
FROM o
"""


def _crc_table() -> list[int]:
    """What one byte makes of the register 0; the register is complemented before and after."""
    return [zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)]


def crc32(ascii_text: str) -> str:
    """Unsigned crc32 of a text of ASCII characters; needs a column crc_table."""
    codes = f"list_transform(string_split({ascii_text}, ''), lambda x: ascii(x)::BIGINT)"
    step = "lambda c, b: xor(crc_table[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), {step}), 4294967295)"


CRC_TABLE = f"(SELECT {_crc_table()}::BIGINT[] AS crc_table)"


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _tree(name: str, levels: int) -> str:
    """Levels {name}0, {name}1, ... of nodes (t, pos, h, n), and {name}run0, ... of the runs of each."""
    parts = []
    for k in range(levels):
        parts.append(f"""{name}run{k} AS (SELECT t, pos // 16 AS p, n, string_agg(h, '' ORDER BY pos) AS run FROM {name}{k} GROUP BY t, pos // 16, n),
{name}{k + 1} AS (SELECT t, p AS pos, CASE WHEN n > 1 THEN sha256(run) ELSE run END AS h, (n + 15) // 16 AS n FROM {name}run{k})""")
    return ",\n".join(parts)


def op12(levels: int = 6, upper: int = 4) -> str:
    """Trees of up to 16^levels leaves and 16^upper sources."""
    joins, siblings, folds = [], [], []
    for k, (name, level, t, pos) in enumerate([("a", k, "l.t", "l.pos") for k in range(levels)] + [("b", k, "0", "o.pos") for k in range(upper)]):
        joins.append(f"JOIN {name}run{level} AS r{k} ON r{k}.t IS NOT DISTINCT FROM {t} AND r{k}.p = {pos} // {16 ** (level + 1)}")
        place = f"({pos} // {16 ** level} % 16)"
        siblings.append(f"CASE WHEN r{k}.n > 1 THEN substr(r{k}.run, 1, 64 * {place}) || substr(r{k}.run, 64 * {place} + 65) ELSE '' END")
        folds.append(f"r{k}.n AS n{k}, substr(r{k}.run, 1, 64 * {place}) AS x{k}, substr(r{k}.run, 64 * {place} + 65) AS y{k}")
    steps = [f"w{k + 1} AS (SELECT * REPLACE (CASE WHEN n{k} > 1 THEN sha256(x{k} || f || y{k}) ELSE f END AS f) FROM w{k})"
             for k in range(levels + upper)]
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS t, {_leaf('text')} AS leaf,
                  CASE WHEN {crc32('doc_id::VARCHAR')} % 5 = 0 AND text IS NOT NULL
                       THEN {_leaf(LOWER.replace("coalesce(text, '')", 'text'))} END AS changed
           FROM documents, {CRC_TABLE} AS c),
l AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY t) AS n FROM d),
a0 AS (SELECT t, pos, leaf AS h, n FROM l),
{_tree('a', levels)},
o AS (SELECT t, h, row_number() OVER (ORDER BY encode(t) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM a{levels}),
b0 AS (SELECT 0 AS t, pos, h, n FROM o),
{_tree('b', upper)},
w0 AS (SELECT l.doc_id, l.leaf, o.h AS subroot, coalesce(l.changed, l.leaf) AS f, sha256({' || '.join(siblings)}) AS proof_sha256, {', '.join(folds)}
       FROM l JOIN o ON l.t IS NOT DISTINCT FROM o.t {' '.join(joins)}),
{', '.join(steps)}
SELECT doc_id, leaf, subroot, b{upper}.h AS root, proof_sha256, f AS folded_root, f = b{upper}.h AS verified FROM w{levels + upper}, b{upper}
"""


def _op11() -> str:
    """Strings of 12 digits and an audit compare like (cost, audit); four of them are the states."""
    def add(x: str, cost: str, letter: str) -> str:
        return f"(lpad((substr({x}, 1, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({x}, 13) || '{letter}')"

    def put(x: str) -> str:
        return add(x, "2", "I")

    def kept(initial: str, *states: str) -> list[str]:
        return [f"CASE WHEN NOT gone AND initial = '{initial}' THEN {add(x, 'extra', 'K')} END" for x in states]

    def changed(*states: str) -> list[str]:
        return [f"CASE WHEN NOT gone THEN {add(x, '2 + extra', 'R')} END" for x in states]

    inserted = (f"e0 AS i0, e1 AS i1, least(e2, {put('e0')}, {put('e1')}, {put('e3')}) AS i2, "
                f"least(e3, {put('e2')}, {put(put('e0'))}, {put(put('e1'))}) AS i3")
    steps = ", ".join([
        f"{add('i0', '3', 'D')} AS e0",
        f"least({', '.join([add('i1', '3', 'D'), *kept('s', 'i0')])}) AS e1",
        f"least({', '.join([add('i2', '3', 'D'), *kept('u', 'i0', 'i1', 'i3'), *changed('i0', 'i1', 'i3')])}) AS e2",
        f"least({', '.join([add('i3', '3', 'D'), *kept('a', 'i2'), *changed('i2')])}) AS e3"])
    blank = "translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')"
    tail = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS way
  FROM conversations, {CRC_TABLE} AS c),
d AS (
  SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
         CASE way WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM o, (SELECT unnest([1, 2]) AS copy) AS u WHERE way <> 0 AND (copy = 1 OR way = 3)),
k AS (
  SELECT *, coalesce(conv_id::VARCHAR, 'null') AS g, left(role, 1) AS initial, {blank} = '' AS blank,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS rn FROM d),
f AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY g, role, text ORDER BY rn) > 1 AS duplicate,
         right(rtrim(text, {tail}), 1) NOT IN ('.', '!', '?') AS open_, lag(initial) OVER (PARTITION BY g ORDER BY rn) AS before FROM k),
r AS (
  SELECT *, blank OR duplicate AS gone, open_ AND NOT blank AND NOT duplicate AS truncated,
         CASE WHEN open_ AND NOT blank AND NOT duplicate THEN 1 ELSE 0 END AS extra FROM f),
w AS (
  SELECT g, 0::BIGINT AS rn, lpad('', 12, '0') AS e0, NULL::VARCHAR AS e1, NULL::VARCHAR AS e2, NULL::VARCHAR AS e3
  FROM (SELECT DISTINCT g FROM r) AS x
  UNION ALL
  SELECT g, rn, {steps} FROM (
    SELECT r.g, r.rn, initial, gone, extra, {inserted} FROM w JOIN r ON w.g = r.g AND r.rn = w.rn + 1) AS x),
z AS (
  SELECT g, least(e0, {put('e2')}, e3, {put(put('e1'))}) AS best
  FROM w JOIN (SELECT g, max(rn) AS rn FROM r GROUP BY g) AS x USING (g, rn)),
b AS (SELECT g, substr(best, 1, 12)::BIGINT AS cost, substr(best, 13) AS audit FROM z),
l AS (
  SELECT g, i, substr(audit, i, 1) AS letter, i - strlen(replace(substr(audit, 1, i), 'D', '')) AS gone_so_far,
         strlen(replace(substr(audit, 1, i), 'I', '')) AS rn, audit
  FROM b, unnest(range(1, strlen(audit) + 1)) AS u(i)),
p AS (
  SELECT l.g, i, letter, role, text, i - gone_so_far AS place,
         CASE WHEN first_value(CASE WHEN letter = 'K' THEN left(role, 1) END) OVER (PARTITION BY l.g ORDER BY i) = 's' THEN 1 ELSE 0 END AS system
  FROM l LEFT JOIN r ON r.g = l.g AND r.rn = l.rn WHERE letter <> 'D'),
t AS (
  SELECT g, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
                       || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS whole
  FROM p GROUP BY g),
c AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY g)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, 'null') AS g FROM conversations) AS x
LEFT JOIN c USING (g) LEFT JOIN b USING (g) LEFT JOIN t USING (g)
"""


OP11 = _op11()
