"""DuckDB SQL of the queries of this package that SQL can express."""

from __future__ import annotations

#: Plain forms of the patterns (fixed values: their contract), by kind.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
VALID = {
    "email": "true",
    "ip": "len(list_filter(string_split(v, '.'), lambda p: len(ltrim(p, '0')) > 3 OR (len(ltrim(p, '0')) = 3 AND ltrim(p, '0') > '255'))) = 0",
    "card": f"""len({DIGITS}) BETWEEN 14 AND 19 AND list_sum(list_transform(range(len({DIGITS})), lambda i:
        CASE WHEN i % 2 = 0 THEN CAST(substr(reverse({DIGITS}), i + 1, 1) AS INTEGER)
        ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][CAST(substr(reverse({DIGITS}), i + 1, 1) AS INTEGER) + 1] END)) % 10 = 0""",
    "phone": f"len({DIGITS}) BETWEEN 10 AND 15",
    "iban": """list_reduce(list_transform(string_split(substr(replace(v, ' ', ''), 5) || substr(replace(v, ' ', ''), 1, 4), ''),
        lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END), lambda a, x: CASE WHEN x > 9 THEN (a * 100 + x) % 97 ELSE (a * 10 + x) % 97 END, 0) = 1""",
    "ssn": """NOT regexp_matches(v, '^(000|666|9)|-00-|-0000$')
        AND regexp_matches(lower(substr(text, greatest(s - 40, 0) + 1, least(s, 40))), '\\b(ssn|social|security)\\b')""",
}


def pii() -> str:
    kinds = "\n  UNION ALL\n".join(f"""  SELECT doc_id, text, {place} AS place, '{kind}' AS kind, string_split_regex(text, '{pattern}') AS gaps,
    regexp_extract_all(text, '{pattern}') AS found FROM docs""" for place, (kind, pattern) in enumerate(PATTERNS.items()))
    valid = " ".join(f"WHEN '{kind}' THEN {test}" for kind, test in VALID.items())
    base = [k for k in PATTERNS if k not in ("iban", "ssn")]
    one = "kind || ':' || s || ':' || e"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matches AS (
{kinds}
),
each AS (SELECT doc_id, text, place, kind, gaps, found, unnest(range(1, len(found) + 1)) AS i FROM matches),
placed AS (
  SELECT doc_id, text, place, kind, found[i] AS v,
    CAST(sum(len(gaps[i]) + len(found[i])) OVER (PARTITION BY doc_id, place ORDER BY i) AS BIGINT) AS e FROM each),
spans AS (
  SELECT doc_id, place, kind, s, e FROM (SELECT *, e - len(v) AS s FROM placed) p
  WHERE CASE kind {valid} END),
joined AS (
  SELECT doc_id, string_agg({one}, ',' ORDER BY s, place) AS spans,
    string_agg({one}, ',' ORDER BY s, place) FILTER (place < 4) AS base,
    {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in base)}
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in base)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN joined j ON d.doc_id = j.doc_id"""


#: Every 100-byte string by itself, in hexadecimal digits (two a byte); texts are first cut into pieces that hold 500 starts.
REPEATS = """
WITH docs AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
pieces AS (
  SELECT doc_id, q, substr(h, 1000 * q + 1, 1198) AS piece
  FROM (SELECT doc_id, h, unnest(range((len(h) // 2 - 99 + 499) // 500)) AS q FROM docs WHERE len(h) >= 200) c),
starts AS (
  SELECT doc_id, 500 * q + i AS p, md5_number(substr(piece, 2 * i + 1, 200)) AS named
  FROM (SELECT doc_id, q, piece, unnest(range(len(piece) // 2 - 99)) AS i FROM pieces) c),
firsts AS (SELECT named, min({'d': doc_id, 'p': p}) AS first FROM starts GROUP BY named),
marked AS (SELECT doc_id, p FROM starts JOIN firsts USING (named) WHERE first.d <> doc_id OR first.p <> p),
opened AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS fresh FROM marked),
runs AS (
  SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b
  FROM (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM opened) n GROUP BY doc_id, run),
cuts AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS done, list({'f': kept_from, 't': a} ORDER BY a) AS parts
  FROM (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from FROM runs) k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE
    array_to_string(list_transform(parts, lambda x: substr(h, 2 * x.f + 1, 2 * (x.t - x.f))), '') || substr(h, 2 * done + 1) END)) AS kept_sha256
FROM docs d LEFT JOIN cuts c ON d.doc_id = c.doc_id"""


#: Words of a text as a list: A to Z lower-cased, longest runs of digits, letters and characters beyond ASCII.
WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

#: Every stretch of as many words as a window has, looked up among the windows.
CONTAMINATION = f"""
WITH items AS (SELECT item_id, ws, least(len(ws), 10) AS k FROM (SELECT item_id, {WORDS} AS ws FROM benchmark) b WHERE len(ws) > 0),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS w
  FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM items) p),
docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws FROM documents),
stretches AS (
  SELECT r, i, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS w
  FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows) l WHERE len(ws) >= k) p),
hits AS (SELECT DISTINCT r, i, k, item_id FROM stretches JOIN windows USING (k, w)),
words AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS place FROM hits) w GROUP BY r),
named AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hits) h GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN named USING (r)"""

#: Every term of every document by itself.
RANKING = f"""
WITH docs AS (SELECT r, doc_id, ws, len(ws) AS n FROM (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws FROM documents) d WHERE len(ws) > 0),
whole AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
items AS (SELECT DISTINCT item_id, unnest({WORDS}) AS term FROM benchmark),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM docs) t WHERE term IN (SELECT term FROM items) GROUP BY r, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term) f, whole),
scores AS (
  SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM items JOIN held USING (term) JOIN weights USING (term) JOIN docs USING (r), whole GROUP BY item_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scores JOIN docs USING (r) WHERE score > 0) o
WHERE rank <= 50"""

#: CRC-32 of a text's UTF-8 bytes: the byte table is folded from the polynomial, then the bytes are folded over the table.
CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(range(8), lambda a, _: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, b::BIGINT))"
CRC32 = """xor(list_reduce(list_transform(range(strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT),
  lambda a, b: xor(a // 256, crc[xor(a % 256, b) + 1]), 4294967295::BIGINT), 4294967295)"""

RESAMPLING = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws FROM documents),
given AS (SELECT r, unnest(ws) AS word FROM docs),
aimed AS (SELECT unnest({WORDS}) AS word FROM benchmark),
buckets AS (
  SELECT word, {CRC32} % 10000 AS bucket
  FROM (SELECT word FROM given UNION SELECT word FROM aimed) w, (SELECT {CRC_TABLE} AS crc) c),
sources AS (SELECT bucket, count(*) AS s FROM given JOIN buckets USING (word) GROUP BY bucket),
targets AS (SELECT bucket, count(*) AS t FROM aimed JOIN buckets USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM given) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT count(*) FROM aimed) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM sources LEFT JOIN targets USING (bucket)),
weighed AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM given JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weighed USING (r)),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS big_n FROM scored WHERE n >= 20)
SELECT doc_id, n AS n_features, weight, score, CAST(CASE WHEN rank <= 10 * big_n // 100 THEN rank END AS BIGINT) AS rank
FROM scored LEFT JOIN ranked USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_pii": pii(), "op10_suffix_dedup": REPEATS, "op11_contamination": CONTAMINATION, "op12_ball_tree": RANKING, "op13_resampling": RESAMPLING}
