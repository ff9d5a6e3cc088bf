"""SQL for the results of queries that DuckDB can state."""

from __future__ import annotations

_WORD_ENDS = r"[ \t\n\x0b\f\r]"

QUALITY_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_WORD_ENDS}+'), lambda x: x <> '') AS ws
  FROM documents),
threes AS (SELECT r, i, ws[i:i+2] AS three FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS c FROM threes) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^ \t\n\x0b\f\r]') GROUP BY r),
f AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '{_WORD_ENDS}+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, len(list_filter(ws, lambda x: regexp_full_match(x, '[!-@\[-`{{-~]+'))) AS n_wordless
  FROM d LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND 10 * n_dup_lines <= 3 * n_lines
       AND word_chars BETWEEN 2 * n_words AND 20 * n_words AND 5 * n_wordless <= 2 * n_words AS kept
FROM b"""


def _text(turns: str) -> str:
    turn = "'<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)"
    return f"coalesce(list_aggregate(list_transform({turns}, lambda x: {turn}), 'string_agg', ''), '')"


def _mask(turns: str) -> str:
    """Start and end of what the assistant says; 24 characters of a turn are marks, 13 of them before the text."""
    size = "list_transform(s, lambda x: length(x.role) + length(x.text) + 24)"
    span = "list_transform(range(1, len(s) + 1), lambda i: [coalesce(list_sum(sizes[1:i-1]), 0) + length(s[i].role) + 13, coalesce(list_sum(sizes[1:i]), 0)])"
    own = "list_filter(range(1, len(s) + 1), lambda i: s[i].role = 'assistant')"
    listed = f"list_transform({own}, lambda i: CAST(CAST(spans[i][1] AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(spans[i][2] AS BIGINT) AS VARCHAR))"
    inner = f"SELECT s, {size} AS sizes FROM (SELECT {turns} AS s)"
    return f"(SELECT coalesce(list_aggregate({listed}, 'string_agg', ','), '') FROM (SELECT s, {span} AS spans FROM ({inner})))"


PREFERENCE_PAIRS = f"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS LAST, role, text) AS turns FROM t GROUP BY conv_id),
p AS (
  SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id,
         coalesce(any_value(turns) FILTER (WHERE conv_id % 2 = 0), []) AS a, coalesce(any_value(turns) FILTER (WHERE conv_id % 2 <> 0), []) AS b
  FROM c GROUP BY 1),
n AS (SELECT *, len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[1:i] = b[1:i])) AS same FROM p),
x AS (SELECT *, a[1:same] AS head, a[same+1:] AS ca, b[same+1:] AS cb FROM n)
SELECT pair_id, CAST(same AS BIGINT) AS prompt_turns, {_text("head")} AS prompt, {_text("ca")} AS chosen, {_text("cb")} AS rejected,
       {_mask("ca")} AS chosen_mask, {_mask("cb")} AS rejected_mask
FROM x"""


WEB_ARCHIVE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
c AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS chief FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND chief IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND chief IS DISTINCT FROM page_id THEN chief END AS refers_to
FROM c"""


def centroid_clusters(k: int = 40, rounds: int = 5, size: int = 64, seed: int = 2) -> str:
    """One step for each round: all distances, the nearest centroid, exact floors of the means."""

    def nearest(c: str) -> str:
        # |v - c|^2 of integers, exact in doubles below 2^53
        far = f"list_inner_product(v.q, v.q) - 2 * list_inner_product(v.q, {c}.q) + list_inner_product({c}.q, {c}.q)"
        return f"""SELECT r, vec_id, q, cluster, CAST(far AS BIGINT) AS distance FROM (
  SELECT v.r, v.vec_id, v.q, {c}.cluster, {far} AS far, row_number() OVER (PARTITION BY v.r ORDER BY {far}, {c}.cluster) AS n
  FROM v CROSS JOIN {c}) WHERE n = 1"""

    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({256} * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), q) - 1 AS INTEGER) AS cluster, q FROM v
  ORDER BY cluster LIMIT {k})""",
    ]
    for i in range(1, rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED ({nearest(f'c{i - 1}')})")
        steps.append(
            f"""m{i} AS MATERIALIZED (
  SELECT cluster, list(m ORDER BY d) AS q FROM (
    SELECT cluster, d, CAST((s - ((s % n) + n) % n) // n AS DOUBLE) AS m FROM (
      SELECT cluster, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT cluster, unnest(q) AS x, unnest(range(1, {size + 1})) AS d FROM a{i}) GROUP BY cluster, d)) GROUP BY cluster)"""
        )
        steps.append(f"c{i} AS MATERIALIZED (SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{i - 1} c LEFT JOIN m{i} m USING (cluster))")
    last = f"c{rounds}"
    steps.append(f"a AS MATERIALIZED ({nearest(last)})")
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(list_aggregate(list_transform({last}.q, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM a JOIN {last} USING (cluster)"""
