"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from corpuskit.llm import licenses

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP8 = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g, least(10, len(w)) AS n
  FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
h AS (SELECT r, i, bw.n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM h, unnest(range(i, i + n)) AS t(p) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items,
  array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS items FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""


OP9 = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id != q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""


def _canonical(text: str) -> str:
    out = f"regexp_replace(coalesce({text}, ''), '{licenses.COPYRIGHT_LINE}', '', 'g')"
    out = f"translate({out}, '{licenses.UPPER}', '{licenses.LOWER}')"
    out = f"trim(regexp_replace({out}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'))"
    for other, usual in licenses.SPELLINGS:
        out = f"replace({out}, '{other}', '{usual}')"
    return out


def _values(pairs: list[tuple[str, str]]) -> str:
    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in pairs)
    return f"(SELECT sha256({_canonical('t')}) AS digest, min(n) AS license FROM (VALUES {rows}) AS k(n, t) GROUP BY 1)"


def _known() -> str:
    """Digests of whole texts: of those at hand and of those known by their digests alone."""
    rows = ", ".join(f"('{n}', '{d}')" for n, d in licenses.DIGESTS)
    return f"""(SELECT digest, min(license) AS license FROM (SELECT * FROM {_values(licenses.TEXTS + licenses.NOTICES)}
  UNION ALL SELECT d, n FROM (VALUES {rows}) AS k(n, d)) GROUP BY digest)"""


OP6 = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
lines AS (SELECT r, i, string_split(text, chr(10))[i] AS line FROM d, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i)),
notices AS (SELECT r, string_agg(license, ',' ORDER BY i) AS notices FROM lines JOIN {_values(licenses.NOTICES)} k
  ON sha256({_canonical('line')}) = k.digest WHERE regexp_matches(line, 'licen[cs]e', 'i') GROUP BY r)
SELECT doc_id, sha256({_canonical('text')}) AS text_digest, k.license, coalesce(notices, '') AS notices
FROM d LEFT JOIN {_known()} k ON sha256({_canonical('text')}) = k.digest LEFT JOIN notices USING (r)"""


def _record(html: str) -> str:
    crlf = "chr(13) || chr(10)"
    return f"""encode('WARC/1.1' || {crlf} || 'WARC-Type: resource' || {crlf} || 'WARC-Record-ID: <urn:page:' || page_id || '>' || {crlf}
  || 'WARC-Target-URI: ' || url || {crlf} || 'Content-Length: ' || octet_length(encode({html})) || {crlf} || {crlf} || {html} || {crlf} || {crlf})"""


OP7 = f"""WITH a AS (SELECT page_id, page_id // 512 AS file, {_record('html')} AS rec, {_record('bad')} AS bad, page_id % 211 = 3 AS gone
  FROM (SELECT *, CASE WHEN page_id % 50 = 7 THEN '#' || substr(html, 2) WHEN page_id % 83 = 5 THEN left(html, length(html) - 1)
    ELSE html END AS bad FROM pages)),
m AS (SELECT *, sum(octet_length(rec)) OVER (PARTITION BY file ORDER BY page_id) AS stop FROM a)
SELECT page_id, file::BIGINT AS file, (stop - octet_length(rec))::BIGINT AS start, stop::BIGINT AS "end",
  CASE WHEN gone THEN 'missing' ELSE 'changed' END AS status, sha256(rec) AS digest_a, CASE WHEN NOT gone THEN sha256(bad) END AS digest_b
FROM m WHERE gone OR rec != bad"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


#: The checksum bit by bit, before its last inversion.
_CRC32 = """list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1))))"""


def _climbed(name: str, leaves: str) -> str:
    """A tree over leaves (g, i, n, d), the siblings (l, r) of each node, both by level."""
    run = "PARTITION BY lv, g, i // 3 ORDER BY i ROWS BETWEEN"
    return f"""{name} AS (SELECT 0 AS lv, g, i, n, d FROM {leaves}
  UNION ALL SELECT lv + 1, g, i // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY lv, g, i // 3, n),
{name}_way AS (SELECT lv, g, i, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name} WHERE n > 1)"""


def _folded(name: str, leaves: str, tree: str) -> str:
    """Leaves (row, g, i, n, cur, proof) folded up to the top of their tree."""
    return f"""{name} AS (SELECT row, 0 AS lv, g, i, n, cur, proof FROM {leaves}
  UNION ALL SELECT f.row, f.lv + 1, f.g, f.i // 3, (f.n + 2) // 3, sha256(w.l || f.cur || w.r), f.proof || w.l || w.r
  FROM {name} f JOIN {tree}_way w ON w.lv = f.lv AND w.i = f.i AND w.g IS NOT DISTINCT FROM f.g WHERE f.n > 1)"""


OP11 = f"""WITH RECURSIVE docs AS (SELECT row_number() OVER () AS row, doc_id, source AS g, {_leaf("text")} AS d,
  CASE WHEN {_CRC32} % 2 = 1 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS bent FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM docs),
{_climbed("low", "leaves")},
subs AS (SELECT '' AS g, g AS source, d, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
{_climbed("high", "subs")},
low_start AS (SELECT row, g, i, n, bent AS cur, '' AS proof FROM leaves),
{_folded("low_fold", "low_start", "low")},
high_start AS (SELECT f.row, s.g, s.i, s.n, f.cur, f.proof FROM low_fold f JOIN subs s ON s.source IS NOT DISTINCT FROM f.g WHERE f.n = 1),
{_folded("high_fold", "high_start", "high")}
SELECT doc_id, leaves.d AS leaf, s.d AS subroot, top.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = top.d AS verified
FROM leaves JOIN (SELECT * FROM high_fold WHERE n = 1) h USING (row) JOIN subs s ON s.source IS NOT DISTINCT FROM leaves.g
JOIN high top ON top.n = 1"""


#: The filters of a document as bits, A the lowest.
OP12 = r"""WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (SELECT r, doc_id, part, (len(ws) < 50)::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT
  + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
  + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS bits,
  doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
  doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic FROM w),
c AS (SELECT part, bits, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY part, bits),
l AS (SELECT i, chr(65 + i::INT) AS name, (1 << i)::INT AS bit FROM range(5) AS t(i)),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM l a, l b, l c, l d, l e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, k::INTEGER AS step, bits[k] AS bit, list_sum(bits[1:k]) - bits[k] AS before FROM o, range(1, 6) AS t(k)),
parts AS (SELECT DISTINCT part FROM c),
x AS (SELECT part, filter_order, step, bit,
  coalesce(sum(n) FILTER (WHERE bits & (before::INT | bit) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (WHERE bits & bit != 0 AND bits & before::INT = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (WHERE bits & bit != 0 AND bits & before::INT != 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (WHERE bits = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (WHERE bits & bit != 0 AND bits & before::INT = 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (WHERE bits & bit != 0 AND bits & before::INT = 0), 0)::BIGINT AS toxic_lost
  FROM s CROSS JOIN c GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM x"""
