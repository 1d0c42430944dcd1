"""The registered queries of this subpackage and their SQL, where DuckDB can express it over whole tables. The others are
held against brute force in tests/llm."""

from __future__ import annotations

from . import decontaminate, license_scan, lm_score, merkle, mixing, ngram_join, quality, search, secret_scan, substring_dedup, token_files, toxicity, url_filter

QUERIES = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_lm_score": lm_score.op6_lm_score,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_mixing": mixing.op9_mixing,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_token_files": token_files.op12_token_files,
    "op13_lexical_search": search.op13_lexical_search,
}

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

_OP5 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s FROM b, UNNEST(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0),
dw AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM d, (SELECT DISTINCT n FROM bw), UNNEST(range(1, len(w) - n + 2)) AS u(i)),
h AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM h, UNNEST(range(i, i + n)) AS u(p) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""

_SPACED = r"[^\x20\x09-\x0D]+"
_BAD_LINE = f"""CASE WHEN n = 0 THEN false
WHEN n <= {quality.BOILERPLATE_WORDS} AND regexp_matches(line, '(?i){quality.BOILERPLATE.pattern.replace("'", "''")}') THEN true
WHEN bars >= 3 AND 4 * bars >= n - bars THEN true
WHEN 10 * len(regexp_extract_all(line, '[#*$%&|<>{{}}~^=_\\\\@]')) > chars THEN true
WHEN n >= 10 AND 4 * len(list_distinct(w)) <= n THEN true
WHEN n >= 5 AND len(regexp_extract_all(line, '\\p{{Lu}}')) > 0 AND 10 * len(regexp_extract_all(line, '\\p{{Lu}}')) > 7 * len(regexp_extract_all(line, '\\p{{L}}')) THEN true
WHEN n < 3 AND NOT regexp_matches(w[-1], '[.!?:;…。！？।"''”’»)\\]]$') THEN true
WHEN n >= 30 AND NOT regexp_matches(line, '[.!?,;:…。！？、，।]') THEN true ELSE false END"""

_OP2 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS s FROM d, UNNEST(range(1, len(w) - 6)) AS u(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM twice, UNNEST(range(i, i + 8)) AS u(p) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d),
l AS (SELECT doc_id, line, k, regexp_extract_all(line, '{_SPACED}') AS w FROM lines),
m AS (SELECT *, len(w) AS n, list_sum(list_transform(w, lambda x: length(x))) AS chars, len(regexp_extract_all(line, '[|»›•·→]')) + len(regexp_extract_all(line, '\\s>(?:\\s)')) AS bars FROM l),
j AS (SELECT doc_id, line, k, n, coalesce(chars, 0) AS chars, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS nth, {_BAD_LINE} AS bad FROM m),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (n > 0 AND nth > 1) AS n_dup_lines, count(*) FILTER (bad) AS n_lines_removed, CAST(coalesce(sum(chars) FILTER (NOT bad), 0) AS BIGINT) AS kept_chars, CAST(coalesce(sum(chars), 0) AS BIGINT) AS word_chars, sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT bad), '')) AS clean_sha256 FROM j GROUP BY 1),
r AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, word_chars, CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines, n_lines_removed, kept_chars, clean_sha256 FROM d JOIN g USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND kept_chars >= {quality.MIN_KEPT} * word_chars AS kept FROM r"""



def _matches(kind: str) -> str:
    """Whole matches, what counts in them, and the pieces between."""
    quoted = "'" + secret_scan.PATTERNS[kind].replace("'", "''") + "'"
    group = 2 if kind == "assign" else 0
    return (
        f"SELECT doc_id, {secret_scan.KINDS.index(kind)} AS rank, '{kind}' AS kind, regexp_extract_all(text, {quoted}, 0) AS w, regexp_extract_all(text, {quoted}, {group}) AS b, "
        f"string_split_regex(text, {quoted}) AS p FROM t WHERE regexp_matches(text, {quoted})"
    )


_W = secret_scan.WINDOW
_OP8 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(map(_matches, secret_scan.KINDS))}),
s AS (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM m),
sp AS (SELECT doc_id, rank, kind, CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1 : i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(w[i]) AS n, b[i] AS body FROM s),
base AS (SELECT doc_id, rank, kind, a, a + n AS z FROM sp WHERE kind <> 'entropy' AND (kind <> 'assign' OR length(body) >= 6)),
cand AS (SELECT doc_id, a, n, body FROM sp WHERE kind = 'entropy' AND NOT regexp_matches(body, '{secret_scan.ALLOWED}') AND NOT EXISTS (SELECT 1 FROM base WHERE base.doc_id = sp.doc_id AND base.a < sp.a + sp.n AND base.z > sp.a)),
win AS (SELECT doc_id, a, body, unnest(range(0, n - {_W} + 1)) AS j FROM cand),
ch AS (SELECT doc_id, a, body, j, unnest(string_split(substr(body, j + 1, {_W}), '')) AS c FROM win),
q AS (SELECT doc_id, a, body, j, c, count(*) AS q FROM ch GROUP BY ALL),
h AS (SELECT doc_id, a, body, j, -sum(q / {_W} * log2(q / {_W})) AS e FROM q GROUP BY ALL),
hit AS (SELECT doc_id, a, min(j) AS lo, max(j) + {_W} AS hi FROM h WHERE e >= CASE {" ".join(f"WHEN regexp_matches(body, '{c}') THEN {bits}" for c, bits in secret_scan.CLASSES)} ELSE {secret_scan.OTHER_BITS} END GROUP BY 1, 2),
every AS (SELECT * FROM base UNION ALL SELECT doc_id, 3, 'entropy', a + lo, a + hi FROM hit),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
string_agg(concat_ws(':', kind, a, z), ',' ORDER BY a, rank, z) FILTER (kind <> 'entropy') AS b, string_agg(concat_ws(':', kind, a, z), ',' ORDER BY a, rank, z) AS x FROM every GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(x, '') AS spans FROM t LEFT JOIN g USING (doc_id)"""

_OP1 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACED}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS g FROM d),
x AS (SELECT doc_id, len(g) AS n, unnest(g) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS id, doc_id AS c FROM d UNION SELECT p.b AS id, r.c AS c FROM r JOIN p ON r.id = p.a)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, m.c AS component_id FROM s JOIN (SELECT id, min(c) AS c FROM r GROUP BY 1) m ON m.id = s.doc_id"""

def _fields(text: str) -> str:
    """The fields of a leaf, each with its length in bytes."""
    return " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", text))


_OP11 = f"""
WITH RECURSIVE f AS (SELECT *, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)) AS crc, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
v AS (SELECT doc_id, source, sha256({_fields('text')}) AS leaf, CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN sha256({_fields('low')}) ELSE sha256({_fields('text')}) END AS forged FROM f),
p AS (SELECT *, coalesce('=' || source, '') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS size FROM v),
lv AS (SELECT tree, 0 AS level, i, leaf AS h, size AS n FROM p
UNION ALL SELECT tree, level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 15) // 16 FROM lv WHERE n > 1 GROUP BY tree, level, i // 16),
sub AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM lv WHERE n = 1),
tv AS (SELECT 0 AS level, i, subroot AS h, n FROM sub UNION ALL SELECT level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 15) // 16 FROM tv WHERE n > 1 GROUP BY level, i // 16),
every AS (SELECT tree, level, i, h FROM lv WHERE n > 1 UNION ALL SELECT tree, 100 + tv.level, tv.i, tv.h FROM tv, (SELECT DISTINCT tree FROM lv) WHERE tv.n > 1),
way AS (SELECT doc_id, leaf, p.tree, every.level, p.i // CAST(power(16, every.level) AS BIGINT) AS spot FROM p JOIN (SELECT DISTINCT tree, level FROM every WHERE level < 100) every USING (tree)
UNION ALL SELECT doc_id, leaf, p.tree, l.level, sub.i // CAST(power(16, l.level - 100) AS BIGINT) AS spot FROM p JOIN sub USING (tree), (SELECT DISTINCT level FROM every WHERE level >= 100) l),
step AS (SELECT doc_id, leaf, level, row_number() OVER (PARTITION BY doc_id, leaf ORDER BY level) AS k, coalesce(string_agg(h, '' ORDER BY every.i) FILTER (every.i < spot), '') AS l, coalesce(string_agg(h, '' ORDER BY every.i) FILTER (every.i > spot), '') AS r
FROM way JOIN every USING (tree, level) WHERE every.i // 16 = spot // 16 GROUP BY doc_id, leaf, level),
proof AS (SELECT doc_id, leaf, string_agg(l || r, '' ORDER BY k) AS s, max(k) AS k FROM step GROUP BY 1, 2),
fold AS (SELECT doc_id, leaf, 0 AS k, forged AS h FROM p UNION ALL SELECT doc_id, leaf, fold.k + 1, sha256(l || h || r) FROM fold JOIN step USING (doc_id, leaf) WHERE step.k = fold.k + 1),
root AS (SELECT h AS root FROM tv WHERE n = 1)
SELECT p.doc_id, p.leaf, subroot, root, sha256(coalesce(proof.s, '')) AS proof_sha256, fold.h AS folded_root, fold.h = root AS verified
FROM p JOIN sub USING (tree) LEFT JOIN proof ON proof.doc_id = p.doc_id AND proof.leaf = p.leaf JOIN fold ON fold.doc_id = p.doc_id AND fold.leaf = p.leaf AND fold.k = coalesce(proof.k, 0), root"""

_OP13 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), q AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
c AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
t AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score FROM q JOIN p USING (term) JOIN t USING (term), c GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""

ORACLE_SQL: dict[str, str] = {"op1_ngram_join": _OP1, "op2_quality_rules": _OP2, "op5_decontaminate": _OP5, "op8_secret_scan": _OP8, "op11_merkle_manifest": _OP11, "op13_lexical_search": _OP13}
