"""DuckDB SQL for the operators' queries that SQL can say."""

from __future__ import annotations

from pricelake.llm import quality

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quality() -> str:
    value = {m: e.replace(" DIV ", " // ") for m, (e, _, _) in quality.MEASURES.items()}
    low = "CASE WHEN v < 32 THEN v ELSE (v >> (length(bin(v)) - 5)::INTEGER) << (length(bin(v)) - 5)::INTEGER END"
    levels = {"g": "lang, source", "l": "lang", "e": ""}
    fences, joins, rules = [], [], []
    for name, keys in levels.items():
        quantile = lambda m, q: f"list_sort(list({m}_low))[ceil(count(*) * {q})::INTEGER]"
        ends = ", ".join(f"{quantile(m, 0.25)} AS {m}_q1, {quantile(m, 0.75)} AS {m}_q3" for m in value)
        gap = lambda m: f"greatest(6 * ({m}_q3 - {m}_q1), {quality.MEASURES[m][2]})"
        bounds = ", ".join(
            (f"{m}_q1 - {gap(m)}" if quality.MEASURES[m][1] == "both" else "-1") + f" AS {m}_lo, {m}_q3 + {gap(m)} AS {m}_hi" for m in value
        )
        pick = f"{keys}, " if keys else ""
        group = f"GROUP BY {keys}" if keys else ""
        fences.append(f"{name} AS (SELECT {pick} n, {bounds} FROM (SELECT {pick} count(*) AS n, {ends} FROM lows {group}))")
        on = " AND ".join(f"{name}.{k} IS NOT DISTINCT FROM m.{k}" for k in keys.split(", ") if k) or "true"
        joins.append(f"LEFT JOIN {name} ON {on}")
    for m in value:
        side = lambda s: f"CASE WHEN g.n >= 50 THEN g.{m}_{s} WHEN l.n >= 50 THEN l.{m}_{s} ELSE e.{m}_{s} END"
        rules.append(f"({value[m]}) BETWEEN {side('lo')} AND {side('hi')}")
    lows = ", ".join(f"(SELECT {low} FROM (SELECT {value[m]} AS v)) AS {m}_low" for m in value)
    counts = ", ".join(quality.COUNTS)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT rid, i, concat_ws(chr(10), w[i], w[i + 1], w[i + 2]) AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
repeated AS (SELECT rid, count(DISTINCT i + j) AS n FROM twice, (VALUES (0), (1), (2)) AS t(j) GROUP BY rid),
lines AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
m AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals
  FROM d JOIN lines USING (rid) LEFT JOIN repeated r USING (rid)),
lows AS (SELECT lang, source, {lows} FROM m),
{", ".join(fences)},
judged AS (
  SELECT m.doc_id, {", ".join("m." + c for c in quality.COUNTS)}, m.lang, m.source, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    {" AND ".join(rules)} AS fine
  FROM m {" ".join(joins)})
SELECT doc_id, {counts}, lang, source, base_failed, NOT base_failed AND fine AS kept FROM judged"""


TOP_K = """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
written AS (
  SELECT *, regexp_replace(regexp_replace(text, '<(~*)(\||/?s>)', '<~\1\2', 'g'), '\[(~*)(/?INST\])', '[~\1\2', 'g') AS safe FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|turn|>') + length(url_encode(role)) + 1 + length(safe) + length('<|end|>') + 1)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], chr(10)) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) AS i FROM d)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN links ON x = other)
SELECT doc_id, any_value(coalesce(n, 0))::BIGINT AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

EXACT = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)"""

ORACLES: dict[str, str] = {
    "op3_quality_rules": _quality(), "op4_top_k": TOP_K, "op6_chat_format": CHAT, "op10_jaccard_join": JACCARD, "op12_exact_dedup": EXACT,
}
