"""SQL of the intermediate tables that the oracles share."""

from __future__ import annotations

from assayer.plans.inputs import SPEC
from assayer.spec import DOUBLE

LABELLED = """
labelled AS (
  SELECT d.doc_id AS _row_key, d.text AS text_content, d.lang AS content_type, CAST(l.quality AS BIGINT) AS label
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
"""

LABELLED_DOCUMENTS = """
labelled AS (
  SELECT d.doc_id AS _row_key, d.text AS text_content, d.lang AS content_type, CAST(l.quality AS BIGINT) AS label, d.source, d.n_chars
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
"""

SOURCE = r"""
words AS (
  SELECT *, regexp_extract_all(lower(text_content), '\S+') AS w,
         [len(regexp_extract_all(s, '\S+')) for s in string_split_regex(text_content, '[.!?]+')
          if len(regexp_extract_all(s, '\S+')) > 0] AS sent
  FROM labelled),
counts AS (
  SELECT *, CAST(len(w) AS BIGINT) AS word_count, CAST(length(text_content) AS BIGINT) AS character_count,
         CAST(greatest(len(regexp_extract_all(text_content, '[.!?]+')), 1) AS BIGINT) AS sentence_count,
         len(list_distinct(w)) AS vocabulary,
         length(regexp_replace(text_content, '[ \t\n\r\f]', '', 'g')) AS letters,
         length(text_content) - length(regexp_replace(text_content, '[!-/:-@\[-`{-~]', '', 'g')) AS marks,
         len(regexp_extract_all(lower(text_content), '[aeiouy]+')) AS syllables,
         len([x for x in w if len(regexp_extract_all(x, '[aeiouy]+')) >= 3]) AS long_words,
         CAST(len(sent) AS BIGINT) AS sn, CAST(coalesce(list_sum(sent), 0) AS BIGINT) AS st,
         CAST(coalesce(list_sum([x * x for x in sent]), 0) AS BIGINT) AS sq
  FROM words),
source AS (
  SELECT _row_key, text_content, content_type, label, word_count, character_count, sentence_count,
         vocabulary / nullif(CAST(word_count AS DOUBLE), 0) AS lexical_diversity,
         word_count / CAST(sentence_count AS DOUBLE) AS avg_sentence_length,
         letters / nullif(CAST(word_count AS DOUBLE), 0) AS avg_word_length,
         marks / nullif(CAST(character_count AS DOUBLE), 0) AS punctuation_ratio,
         CASE WHEN content_type = 'en' AND word_count > 0 THEN
           CAST(206.835 AS DOUBLE) - CAST(1.015 AS DOUBLE) * (word_count / CAST(sentence_count AS DOUBLE))
           - CAST(84.6 AS DOUBLE) * (syllables / CAST(word_count AS DOUBLE)) END AS flesch_reading_ease,
         CASE WHEN content_type = 'en' AND word_count > 0 THEN
           CAST(0.4 AS DOUBLE) * ((word_count / CAST(sentence_count AS DOUBLE))
           + CAST(100 AS DOUBLE) * (long_words / CAST(word_count AS DOUBLE))) END AS gunning_fog_index,
         sqrt(CAST(sn * sq - st * st AS DOUBLE)) / nullif(CAST(st AS DOUBLE), 0) AS burstiness
  FROM counts)
"""

RAW = """
raw AS (
  SELECT *, md5(text_content || '|' || coalesce(content_type, '<NA>') || '|' || CAST(character_count AS VARCHAR)
    || '|' || coalesce(CAST(label AS VARCHAR), '<NA>')) AS _row_hash
  FROM source)
"""

UNIQUE = """
uniq AS (
  SELECT * EXCLUDE (_turn) FROM (
    SELECT *, row_number() OVER (PARTITION BY _row_hash ORDER BY _row_key) AS _turn FROM raw) WHERE _turn = 1)
"""

# The counts are never NULL here; the ratios are where a text has no words.
_RATIOS = [c for c in SPEC.numeric if SPEC.types[c] == DOUBLE]
_MEDIANS = ", ".join(f"median({c}) AS m_{c}" for c in _RATIOS)
_FILLED = ", ".join(f"coalesce({c}, m_{c}) AS {c}" if c in _RATIOS else c for c in SPEC.numeric)

STAGING = f"""
clean AS (SELECT * FROM uniq WHERE label IS NOT NULL),
meds AS (SELECT {_MEDIANS} FROM clean),
staging AS (SELECT _row_key, text_content, content_type, label, _row_hash, {_FILLED} FROM clean, meds)
"""

TO_RAW = (LABELLED, SOURCE, RAW)
TO_STAGING = (*TO_RAW, UNIQUE, STAGING)

SCORED = """
scored AS (
  SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label, 'price' AS classifier,
         CAST(o_totalprice >= 250000 AS INTEGER) AS prediction, o_totalprice AS score FROM orders
  UNION ALL
  SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER), 'urgency',
         CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 3 AS INTEGER),
         CAST(6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS DOUBLE) FROM orders
  UNION ALL
  SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER), 'recency',
         CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) >= 1200 AS INTEGER),
         CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) FROM orders)
"""


def confusion(by: str = "classifier", scored: str = "scored") -> str:
    keys = [k.strip() for k in by.split(",")]
    same = " AND ".join(f"{{0}}.{k} = {{1}}.{k}" for k in keys)
    gb, gp = same.format("a", "b"), same.format("g", "c")
    a_keys, g_keys = ", ".join(f"a.{k}" for k in keys), ", ".join(f"g.{k}" for k in keys)
    return f"""
cells AS (SELECT {by}, label, prediction, count(*) AS n FROM {scored} GROUP BY ALL),
occurring AS (SELECT {by}, label AS c FROM cells UNION SELECT {by}, prediction FROM cells),
grid AS (SELECT {a_keys}, a.c AS label, b.c AS prediction FROM occurring a JOIN occurring b ON {gb}),
confusion AS (
  SELECT {g_keys}, g.label, g.prediction, CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM grid g LEFT JOIN cells c ON {gp} AND g.label = c.label AND g.prediction = c.prediction)
"""


def class_scores(by: str = "classifier") -> str:
    return f"""
per_class AS (
  SELECT {by}, label AS class, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS hits
  FROM confusion GROUP BY ALL),
per_prediction AS (SELECT {by}, prediction AS class, sum(n) AS predicted FROM confusion GROUP BY ALL),
class_scores AS (
  SELECT {by}, class, CAST(support AS BIGINT) AS support, CAST(hits AS BIGINT) AS hits,
         CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / CAST(predicted AS DOUBLE) END AS "precision",
         CASE WHEN support = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / CAST(support AS DOUBLE) END AS recall,
         CASE WHEN predicted + support = 0 THEN 0.0
              ELSE CAST(2 * hits AS DOUBLE) / CAST(predicted + support AS DOUBLE) END AS f1
  FROM per_class JOIN per_prediction USING ({by}, class))
"""


def curve(by: str = "classifier", scored: str = "scored") -> str:
    return f"""
per_score AS (
  SELECT {by}, score, CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS p,
         CAST(count(*) FILTER (WHERE label <> 1) AS BIGINT) AS n FROM {scored} GROUP BY ALL),
curve AS (
  SELECT *, CAST(sum(p) OVER w AS BIGINT) AS p_upto, CAST(sum(n) OVER w AS BIGINT) AS n_upto,
         CAST(sum(p) OVER (PARTITION BY {by}) AS BIGINT) AS p_all, CAST(sum(n) OVER (PARTITION BY {by}) AS BIGINT) AS n_all
  FROM per_score WINDOW w AS (PARTITION BY {by} ORDER BY score))
"""


def auc(by: str = "classifier") -> str:
    return f"""
auc AS (
  SELECT {by}, CASE WHEN sum(p) = 0 OR sum(n) = 0 THEN NULL ELSE
         CAST(sum(CAST(p AS HUGEINT) * (2 * n_upto - n)) AS DOUBLE) / 2
         / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) END AS roc_auc
  FROM curve GROUP BY ALL)
"""


def metrics(by: str = "classifier") -> str:
    return f"""
f_scores AS (
  SELECT {by}, CAST(sum(hits) AS DOUBLE) / CAST(sum(support) AS DOUBLE) AS accuracy,
         sum(f1 * support) / CAST(sum(support) AS DOUBLE) AS f1_weighted, avg(f1) AS f1_macro,
         coalesce(max(CASE WHEN class = 1 THEN f1 END), 0.0) AS f1_binary
  FROM class_scores GROUP BY ALL),
metrics AS (SELECT f_scores.*, auc.roc_auc FROM f_scores LEFT JOIN auc USING ({by}))
"""


def all_metrics(by: str = "classifier", scored: str = "scored") -> tuple[str, ...]:
    return confusion(by, scored), class_scores(by), curve(by, scored), auc(by), metrics(by)


def ordered_keys(key: str) -> str:
    return f"substr(md5('42|' || CAST({key} AS VARCHAR)), 1, 15), {key}"


def split(table: str, target: str, key: str) -> str:
    """`split`: the rows of `table` with `_split`; quotas by largest remainder of ceil(0.2 * N)."""
    return f"""
sizes AS (SELECT {target} AS c, count(*) AS n FROM {table} GROUP BY ALL),
total AS (SELECT sum(n) AS rows, CAST(ceil(CAST(sum(n) AS DECIMAL(18,0)) * CAST(0.2 AS DECIMAL(2,1))) AS BIGINT) AS t FROM sizes),
parts AS (SELECT c, CAST(t * n AS BIGINT) // CAST(rows AS BIGINT) AS q, CAST(t * n AS BIGINT) % CAST(rows AS BIGINT) AS rest, t
          FROM sizes, total),
quotas AS (SELECT c, q + CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= t - sum(q) OVER () THEN 1 ELSE 0 END AS quota
           FROM parts),
split AS (
  SELECT s.* EXCLUDE (rn), CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS _split
  FROM (SELECT *, row_number() OVER (PARTITION BY {target} ORDER BY {ordered_keys(key)}) AS rn FROM {table}) s
  JOIN quotas ON quotas.c = s.{target})
"""


def scaled(columns: tuple[str, ...] = SPEC.numeric) -> str:
    fits = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in columns)
    return f"scaler AS (SELECT {fits} FROM split WHERE _split = 'train')"
