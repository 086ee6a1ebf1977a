"""DuckDB SQL fragments mirroring the role mapping in ``sources.tables``.

These are the oracle side of the correctness check: each registered Spark
query has an ANSI SQL twin that DuckDB runs over the same parquet tables.
"""

SEQ_CTE = """seq AS (
  SELECT user_id AS patient_id,
         CASE event_type WHEN 'click' THEN 'E1' WHEN 'error' THEN 'E2'
                         WHEN 'purchase' THEN 'E3' WHEN 'signup' THEN 'E4'
                         WHEN 'view' THEN 'E5' END AS exercise_id,
         0 AS joint,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS frame,
         value AS x,
         CAST(regexp_extract(props, '"k": (-?[0-9.]+)', 1) AS DOUBLE) AS y
  FROM events)"""

SEQ_KEYS = "patient_id, exercise_id, joint"

STEPS_CTE = SEQ_CTE + """,
st0 AS (
  SELECT *, lag(frame) OVER w IS NOT NULL AS has_prev,
         CASE WHEN lag(frame) OVER w IS NULL THEN CAST(0 AS DOUBLE) ELSE x - lag(x) OVER w END AS dx,
         CASE WHEN lag(frame) OVER w IS NULL THEN CAST(0 AS DOUBLE) ELSE y - lag(y) OVER w END AS dy,
         sum(x) OVER (PARTITION BY patient_id, exercise_id, joint ORDER BY frame
                      ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) / 4.0 AS sx,
         sum(y) OVER (PARTITION BY patient_id, exercise_id, joint ORDER BY frame
                      ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) / 4.0 AS sy
  FROM seq WINDOW w AS (PARTITION BY patient_id, exercise_id, joint ORDER BY frame)),
st1 AS (
  SELECT *, sqrt(dx * dx + dy * dy) AS step,
         CASE WHEN has_prev THEN atan2(dy, dx) END AS angle,
         sqrt((x - sx) * (x - sx) + (y - sy) * (y - sy)) AS jitter
  FROM st0),
steps AS (
  SELECT *, abs(angle - lag(angle) OVER (PARTITION BY patient_id, exercise_id, joint ORDER BY frame)) AS dangle
  FROM st1)"""

# regression role of lineitem
REG_CTE = """reg AS (
  SELECT l_quantity, l_discount, l_tax, l_extendedprice AS target FROM lineitem)"""

MISSING_CTE = """miss AS (
  SELECT l_quantity, l_extendedprice,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_discount END AS l_discount,
         CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_tax END AS l_tax
  FROM lineitem)"""

POSE_CTE = """pose AS (
  SELECT vec_id AS row_id, CAST(vec_id % 14 + 1 AS INTEGER) AS patient_id,
         CAST(embedding AS DOUBLE[]) AS features, CAST(label AS DOUBLE) AS target
  FROM embeddings)"""


POSE33_CTE = POSE_CTE + """,
pose33 AS (SELECT row_id, patient_id, list_transform(range(132), lambda i: features[i % 64 + 1] * (1 + i // 64)) AS features FROM pose)"""


def portable_hash_sql(expr: str, seed: int | str = 42) -> str:
    return f"CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR) || '{seed}'), 1, 8)) AS BIGINT)"


REG_PRED_CTE = """preds AS (
  SELECT m.model, CAST(l_linenumber % 5 AS INTEGER) AS fold,
         CASE WHEN l_orderkey % 4 = 0 THEN 'val' ELSE 'train' END AS set,
         l_extendedprice AS y_true, l_quantity * m.a AS y_pred
  FROM lineitem, (VALUES ('qty_x_1500', 1500.0::DOUBLE), ('qty_x_2000', 2000.0::DOUBLE)) m(model, a))"""

CLS_PRED_CTE = """preds AS (
  SELECT m.model, CAST(doc_id % 5 AS INTEGER) AS fold, doc_id AS row_id, quality AS y_true,
         CAST(CASE WHEN m.model = 'rater' THEN toxic ELSE 1 - toxic END AS INTEGER) AS y_pred
  FROM labels, (VALUES ('rater'), ('inverse_rater')) m(model))"""


JSEQ_CTE = """fr AS (
  SELECT label AS recording, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame
  FROM embeddings),
jseq AS (
  SELECT recording, frame, CAST(j AS INTEGER) AS joint,
         CAST(embedding[2 * j + 1] AS DOUBLE) AS x, CAST(embedding[2 * j + 2] AS DOUBLE) AS y
  FROM fr, range(32) t(j)),
jsteps AS (
  SELECT *, CASE WHEN lag(frame) OVER w IS NULL THEN 0 ELSE sqrt((x - lag(x) OVER w) ^ 2 + (y - lag(y) OVER w) ^ 2) END AS step,
         lag(frame) OVER w IS NOT NULL AS has_prev
  FROM jseq WINDOW w AS (PARTITION BY recording, joint ORDER BY frame)),
parts AS (SELECT CAST(j AS INTEGER) AS joint, 'p' || CAST(j // 8 AS VARCHAR) AS part,
                 CASE WHEN j % 2 = 0 THEN 'l' ELSE 'r' END AS side FROM range(32) t(j))"""
