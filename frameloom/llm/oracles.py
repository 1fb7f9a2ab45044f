"""DuckDB SQL for the queries that SQL can express, on the plain way: all
pairs and exact counts instead of signatures and indexes."""

from __future__ import annotations

from . import quality

#: What a word or a line's ends are made of.
_WORD, _BLANK = r"[^\x20\x09-\x0D]+", "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _components(nodes: str, links: str) -> str:
    """CTEs ending in comp(id, c): the smallest id that links reach."""
    return f"""both_ways AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
    reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
    comp AS (SELECT id, least(id, coalesce(m, id)) AS c FROM {nodes} LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) ON id = a)"""


#: Other than white space of any kind.
_DARK = r"[^\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"

OP2 = rf"""WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, doc_id AS id, regexp_extract_all(coalesce(text, ''), '{_DARK}') AS w FROM documents),
    shingles AS (SELECT DISTINCT r, array_to_string(w[p : p + 4], ' ') AS s FROM (SELECT r, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS p FROM rows WHERE len(w) > 0)),
    sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
    shared AS (SELECT x.r AS a, y.r AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.r <> y.r GROUP BY x.r, y.r),
    pairs AS (SELECT a, b, CAST(shared.n AS DOUBLE) / (p.n + q.n - shared.n) AS j FROM shared JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b),
    links AS (SELECT p.id AS a, q.id AS b FROM pairs JOIN rows p ON p.r = pairs.a JOIN rows q ON q.r = pairs.b WHERE j >= 0.8e0 AND p.id <> q.id),
    copies AS (SELECT pairs.a AS r, min(id) AS copy FROM pairs JOIN rows ON rows.r = pairs.b WHERE j = 1 GROUP BY pairs.a),
    nodes AS (SELECT DISTINCT id FROM rows), {_components("nodes", "links")}
    SELECT rows.id AS doc_id, least(rows.id, coalesce(copy, rows.id)) AS copy_of, c AS class_id, rows.id = c AS kept FROM rows JOIN comp ON comp.id = rows.id LEFT JOIN copies USING (r)"""

OP5 = f"""WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    lines AS (SELECT r, doc_id, unnest(generate_series(1, len(lines))) AS p, unnest(lines) AS line FROM rows),
    keyed AS (SELECT *, translate(trim(line, {_BLANK}), '{_UPPER}', '{_UPPER.lower()}') AS k FROM lines),
    shared AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
    marked AS (SELECT r, doc_id, p, line, last IS NOT NULL AND doc_id <> last AS gone FROM keyed LEFT JOIN shared USING (k))
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256 FROM marked GROUP BY r"""


def _op8() -> str:
    bits = " + ".join(f"CASE WHEN {rule.fails} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(quality.RULES))
    kept = ", ".join(f"failed & {p.mask} = 0 AS kept_{p.version}" for p in quality.POLICIES)
    last = quality.POLICIES[-1].mask
    return rf"""WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    words AS (SELECT r, unnest(generate_series(1, len(w))) AS p, unnest(w) AS a, unnest(w[2:]) AS b, unnest(w[3:]) AS c FROM (SELECT r, regexp_extract_all(text, '{_WORD}') AS w FROM rows)),
    windows AS (SELECT r, p, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM words WHERE c IS NOT NULL),
    inside AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM windows WHERE n > 1) GROUP BY r),
    measured AS (SELECT r, doc_id, len(regexp_extract_all(text, '{_WORD}')) AS n_words,
        coalesce(list_sum([length(x) for x in regexp_extract_all(text, '{_WORD}')]), 0) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
        [x for x in string_split(text, chr(10)) if regexp_matches(x, '{_WORD}')] AS lines,
        len(regexp_extract_all(text, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(text, '\p{{L}}')) AS n_letters FROM rows),
    counted AS (SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines, CAST(n_upper AS BIGINT) AS n_upper, CAST(n_letters AS BIGINT) AS n_letters FROM measured LEFT JOIN inside USING (r)),
    judged AS (SELECT *, CAST({bits} AS BIGINT) AS failed FROM counted)
    SELECT *, {kept}, failed & {quality.BASE} <> 0 AS base_failed, failed & {quality.BASE | last} = 0 AS kept FROM judged"""


OP9 = f"""WITH RECURSIVE vectors AS (SELECT row_number() OVER () AS r, vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    usable AS (SELECT r, id, v, sqrt(list_inner_product(v, v)) AS size FROM vectors WHERE len(v) > 0 AND len([x for x in v if x IS NULL OR NOT isfinite(x)]) = 0),
    pairs AS (SELECT x.r AS p, y.r AS q, x.id AS a, y.id AS b FROM usable x JOIN usable y ON x.r < y.r WHERE x.size > 0 AND y.size > 0 AND len(x.v) = len(y.v) AND list_inner_product(x.v, y.v) / (x.size * y.size) >= 0.95e0),
    nodes AS (SELECT DISTINCT id FROM vectors), links AS (SELECT a, b FROM pairs), {_components("nodes", "links")},
    counts AS (SELECT p, count(*) AS n FROM (SELECT p FROM pairs UNION ALL SELECT q FROM pairs) GROUP BY p)
    SELECT vectors.id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, c AS component_id, vectors.id = c AS kept FROM vectors LEFT JOIN counts ON r = p JOIN comp ON comp.id = vectors.id"""


def oracle_sql() -> dict[str, str]:
    return {"op2_minhash": OP2, "op5_line_dedup": OP5, "op8_quality_ledger": _op8(), "op9_embedding_dedup": OP9}
