"""Equivalent SQL (DuckDB dialect) for each registered query.

The derived input tables are rebuilt as CTEs from the same parquet views,
so the SQL engine computes everything from the raw tables on its own.
"""

from __future__ import annotations

# ------------------------------------------------------------------ CTEs

FE = """
fe AS (
  SELECT e.event_id AS id,
         d.text AS text,
         sha256(d.text) AS text_hash,
         CAST(CASE WHEN e.event_id % 4 = 0 THEN (e.event_id * 7919) % 1001
                   ELSE (CASE WHEN e.event_type = 'signup' THEN 300
                              WHEN e.event_type IN ('error', 'purchase') THEN 600
                              ELSE 0 END) + (((e.event_id * 7919) % 1001) * 2) // 5
              END AS DOUBLE) / 1000.0 AS model_score,
         CASE WHEN e.event_type = 'signup' THEN 'human_edited_ai'
              WHEN e.event_type IN ('error', 'purchase') THEN 'ai'
              WHEN e.event_type IN ('click', 'view') THEN 'human' END AS user_feedback,
         'm' || CAST(e.event_id % 4 + 1 AS VARCHAR) AS model_version,
         e.ts AS event_timestamp,
         CASE WHEN e.event_type = 'signup' THEN 0.5
              WHEN e.event_type IN ('error', 'purchase') THEN 1.0
              WHEN e.event_type IN ('click', 'view') THEN 0.0 END::DOUBLE AS target_score,
         d.lang AS lang
  FROM events e
  JOIN documents d ON d.doc_id = (e.event_id * 31) % (SELECT count(*) FROM documents)
)"""

CONSISTENT = """NOT coalesce(((user_feedback = 'human' AND model_score > 0.7)
                 OR (user_feedback = 'ai' AND model_score < 0.3)) AND NOT isnan(model_score), false)"""

DEDUP = """
dd AS (
  SELECT * FROM fe
  QUALIFY row_number() OVER (PARTITION BY text_hash
                             ORDER BY event_timestamp DESC NULLS FIRST, id DESC) = 1
)"""

CLEAN = f"""
clean AS (
  SELECT * FROM dd
  WHERE coalesce(lang = 'en', false)
    AND coalesce(length(text) BETWEEN 5 AND 1000, false)
    AND {CONSISTENT}
    AND target_score IS NOT NULL AND NOT isnan(target_score)
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


FEEDBACK_COLS = "id, text, text_hash, model_score, user_feedback, model_version, event_timestamp, target_score, lang"

SQL: dict[str, str] = {}

SQL["clean_feedback"] = with_ctes(FE, DEDUP, CLEAN) + f"SELECT {FEEDBACK_COLS} FROM clean"

# ------------------------------------------------------------------ more CTEs

STALE = """
stale AS (
  SELECT id, text, text_hash, model_score, user_feedback, model_version, event_timestamp,
         CASE WHEN model_version = 'm1' THEN NULL WHEN model_version = 'm2' THEN 0.25
              ELSE target_score END::DOUBLE AS target_score
  FROM fe
)"""

PRED = """
pred AS (
  SELECT id, model_version, text, event_timestamp, target_score AS y_true, model_score AS y_pred FROM fe
)"""

MAP_TARGET = """CASE WHEN user_feedback = 'human' THEN 0.0 WHEN user_feedback = 'human_edited_ai' THEN 0.5
                     WHEN user_feedback = 'ai' THEN 1.0 END::DOUBLE"""

BAND = """CASE WHEN {s} IS NULL OR isnan({s}) THEN NULL WHEN {s} < 0.35 THEN '{lo}'
               WHEN {s} <= 0.65 THEN 'Human-edited AI' ELSE '{hi}' END"""

PAT = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

TRAIN = """
tset AS (
  SELECT d.doc_id, d.source, d.text, l.target_score AS label
  FROM documents d LEFT JOIN (SELECT text_hash, target_score FROM dd) l ON sha256(d.text) = l.text_hash
)"""

ROWHASH = """CAST(('0x' || substr(md5(concat(coalesce(length(CAST(text AS VARCHAR)) || ':' || CAST(text AS VARCHAR), '-'),
                  coalesce(length(CAST(label AS VARCHAR)) || ':' || CAST(label AS VARCHAR), '-'))), 1, 15))::BIGINT AS DECIMAL(38,0))"""

DSR = f"""
dsr AS (
  SELECT source AS dataset_run_id,
         CAST(CAST(sum({ROWHASH}) AS DECIMAL(38,0)) AS VARCHAR) AS dataset_checksum,
         CAST(count(*) AS DOUBLE) AS num_rows,
         avg(CASE WHEN NOT isnan(label) THEN label END) AS label_mean,
         stddev_samp(CASE WHEN NOT isnan(label) THEN label END) AS label_std,
         min(CASE WHEN NOT isnan(label) THEN label END) AS label_min,
         max(CASE WHEN NOT isnan(label) THEN label END) AS label_max
  FROM tset GROUP BY source
)"""

MR = """
mr AS (
  SELECT 'run' || CAST(n.n_nationkey AS VARCHAR) AS run_id,
         'src' || CAST(n.n_nationkey AS VARCHAR) AS dataset_run_id,
         CASE WHEN n.n_nationkey % 5 = 0 OR d.dataset_checksum IS NULL
              THEN md5('src' || CAST(n.n_nationkey AS VARCHAR)) ELSE d.dataset_checksum END AS dataset_checksum
  FROM nation n LEFT JOIN dsr d ON d.dataset_run_id = 'src' || CAST(n.n_nationkey AS VARCHAR)
)"""

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"

PREV = f"""
prev_fe AS (SELECT * FROM fe WHERE event_timestamp < TIMESTAMP '2024-01-16 00:00:00'),
prev_dd AS (
  SELECT * FROM prev_fe WHERE coalesce(length(text) BETWEEN 5 AND 1000, false)
  QUALIFY row_number() OVER (PARTITION BY text_hash ORDER BY event_timestamp DESC NULLS FIRST, id DESC) = 1
),
prev_clean AS (
  SELECT * FROM prev_dd WHERE coalesce(lang = 'en', false) AND {CONSISTENT}
    AND target_score IS NOT NULL AND NOT isnan(target_score)
),
hist AS (SELECT TIMESTAMP '2024-01-16 00:00:00' AS run_ts, avg(CASE WHEN NOT isnan(model_score) THEN model_score END) AS mean_score FROM prev_clean),
base AS (SELECT max_by(mean_score, run_ts) AS b FROM hist)"""

F_ = with_ctes(FE)
SQL["scan_feedback"] = F_ + f"SELECT {FEEDBACK_COLS} FROM fe"
SQL["text_hash"] = "SELECT doc_id, sha256(text) AS text_hash FROM documents"
SQL["target_score"] = F_ + f"SELECT id, user_feedback, {MAP_TARGET} AS target_score FROM fe"
SQL["target_backfill"] = with_ctes(FE, STALE) + f"SELECT id, coalesce(target_score, {MAP_TARGET}) AS target_score FROM stale"
SQL["target_remap"] = with_ctes(FE, STALE) + f"""
SELECT id, CASE WHEN (SELECT coalesce(max(CASE WHEN target_score IS NULL OR isnan(target_score) THEN 1 ELSE 0 END), 0) FROM stale) = 1
                THEN {MAP_TARGET} ELSE target_score END AS target_score FROM stale"""
SQL["score_band"] = with_ctes(FE, PRED) + "SELECT id, y_pred, " + BAND.format(
    s="y_pred", lo="Human-written", hi="AI-generated") + " AS band FROM pred"
SQL["score_band_reversed"] = with_ctes(FE, PRED) + "SELECT id, y_pred, " + BAND.format(
    s="y_pred", lo="AI-generated", hi="Human-written") + " AS band FROM pred"
SQL["band_to_feedback"] = with_ctes(FE, PRED) + """
SELECT id, band,
       CASE WHEN band = 'Human-written' THEN 'human' WHEN band = 'Human-edited AI' THEN 'human_edited_ai'
            WHEN band = 'AI-generated' THEN 'ai' END AS feedback,
       printf('%.3f', y_pred) AS score_shown
FROM (SELECT id, y_pred, """ + BAND.format(s="y_pred", lo="Human-written", hi="AI-generated") + " AS band FROM pred) b"
SQL["residuals"] = with_ctes(FE, PRED) + "SELECT id, round(y_true - y_pred, 9) AS residual, round(abs(y_true - y_pred), 9) AS abs_error FROM pred"
SQL["token_length"] = f"SELECT doc_id, CAST(len(regexp_extract_all(text, '{PAT}')) + 2 AS INTEGER) AS token_length FROM documents"
SQL["truncated_length"] = f"SELECT doc_id, CAST(length(array_to_string(list_slice(regexp_extract_all(text, '{PAT}'), 1, 510), '')) AS INTEGER) AS truncated_length FROM documents"

SQL["gate_language"] = F_ + "SELECT id, text_hash FROM fe WHERE coalesce(lang = 'en', false)"
SQL["gate_length"] = F_ + "SELECT id, text_hash FROM fe WHERE coalesce(length(text) BETWEEN 5 AND 1000, false)"
SQL["gate_consistency"] = F_ + f"SELECT id, text_hash FROM fe WHERE {CONSISTENT}"
SQL["gate_target"] = with_ctes(FE, STALE) + "SELECT id, text_hash FROM stale WHERE target_score IS NOT NULL AND NOT isnan(target_score)"
SQL["clean_feedback_remap"] = with_ctes(FE, DEDUP) + f""",
c AS (SELECT * REPLACE (CASE WHEN model_version = 'm1' THEN NULL WHEN model_version = 'm2' THEN 0.25 ELSE target_score END AS target_score)
      FROM dd WHERE coalesce(lang = 'en', false) AND coalesce(length(text) BETWEEN 5 AND 1000, false) AND {CONSISTENT})
SELECT id, text, text_hash, model_score, user_feedback, model_version, event_timestamp,
       CASE WHEN (SELECT coalesce(max(CASE WHEN target_score IS NULL OR isnan(target_score) THEN 1 ELSE 0 END), 0) FROM c) = 1
            THEN {MAP_TARGET} ELSE target_score END AS target_score, lang
FROM c"""
SQL["dedup_latest"] = with_ctes(FE, DEDUP) + "SELECT id, text_hash, event_timestamp FROM dd"
SQL["duplicate_flag"] = F_ + """SELECT id, row_number() OVER (PARTITION BY text_hash ORDER BY event_timestamp ASC NULLS LAST, id ASC) > 1 AS is_duplicate FROM fe"""
SQL["funnel_report"] = with_ctes(FE, DEDUP) + f""",
s AS (
  SELECT (SELECT count(*) FROM fe) AS initial_rows,
         count(*) AS after_dedup,
         count(*) FILTER (WHERE coalesce(lang = 'en', false)) AS after_language,
         count(*) FILTER (WHERE coalesce(lang = 'en', false) AND coalesce(length(text) BETWEEN 5 AND 1000, false)) AS after_length,
         count(*) FILTER (WHERE coalesce(lang = 'en', false) AND coalesce(length(text) BETWEEN 5 AND 1000, false) AND {CONSISTENT}) AS after_consistency,
         count(*) FILTER (WHERE coalesce(lang = 'en', false) AND coalesce(length(text) BETWEEN 5 AND 1000, false) AND {CONSISTENT}
                                AND target_score IS NOT NULL AND NOT isnan(target_score)) AS after_target
  FROM dd
)
SELECT CAST(initial_rows AS BIGINT) AS initial_rows, CAST(after_dedup AS BIGINT) AS after_dedup,
       CAST(after_language AS BIGINT) AS after_language, CAST(after_length AS BIGINT) AS after_length,
       CAST(after_consistency AS BIGINT) AS after_consistency, CAST(after_target AS BIGINT) AS after_target,
       CAST(initial_rows - after_dedup AS BIGINT) AS removed_dedup,
       CAST(after_dedup - after_language AS BIGINT) AS removed_language,
       CAST(after_language - after_length AS BIGINT) AS removed_length,
       CAST(after_length - after_consistency AS BIGINT) AS removed_consistency,
       CAST(after_consistency - after_target AS BIGINT) AS removed_target,
       round(CASE WHEN initial_rows = 0 THEN NULL ELSE after_target * 100.0 / initial_rows END, 6) AS retention_pct
FROM s"""

_DL_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
SQL["null_ratio"] = """
WITH dl AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_ratio, "
    f"coalesce(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.01, false) AS too_many FROM dl" for c in _DL_COLS)
SQL["duplicate_ratio"] = F_ + """
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS groups,
       round(CAST(sum(n) - count(*) AS DOUBLE) / sum(n), 6) AS duplicate_ratio
FROM (SELECT text_hash, count(*) AS n FROM fe GROUP BY text_hash) g"""
SQL["label_distribution"] = F_ + """
SELECT target_score AS label, CAST(count(*) AS BIGINT) AS n,
       round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM fe WHERE target_score IS NOT NULL AND NOT isnan(target_score)), 6) AS share
FROM fe WHERE target_score IS NOT NULL AND NOT isnan(target_score) GROUP BY target_score"""
MISMATCH = """coalesce(((user_feedback = 'human' AND model_score > 0.8) OR (user_feedback = 'ai' AND model_score < 0.2))
                    AND NOT isnan(model_score), false)"""
SQL["alignment_ratio"] = F_ + f"SELECT round(avg(CASE WHEN {MISMATCH} THEN 1.0 ELSE 0.0 END), 6) AS mismatch_ratio FROM fe"
AGE = f"(epoch_us({AS_OF}) - epoch_us(event_timestamp)) / 86400e6"
SQL["freshness"] = F_ + f"SELECT round(avg({AGE}), 6) AS avg_age_days FROM fe"
INRANGE = "coalesce(target_score BETWEEN 0.0 AND 1.0 AND NOT isnan(target_score), false)"
SQL["target_range"] = with_ctes(FE, STALE) + f"""
SELECT coalesce(bool_and({INRANGE}), true) AS target_in_range,
       CAST(count(*) FILTER (WHERE NOT {INRANGE}) AS BIGINT) AS n_out_of_range FROM stale"""
SQL["score_drift"] = with_ctes(FE, DEDUP, CLEAN) + "," + PREV.lstrip() + """
SELECT round((SELECT b FROM base), 6) AS previous_mean, round(avg(model_score), 6) AS current_mean,
       round(abs(avg(model_score) - (SELECT b FROM base)), 6) AS drift,
       CASE WHEN (SELECT b FROM base) IS NULL THEN 'info'
            WHEN abs(avg(model_score) - (SELECT b FROM base)) > 0.2 THEN 'warn' ELSE 'pass' END AS status
FROM clean"""
SQL["validation_report"] = with_ctes(FE, DEDUP, CLEAN) + "," + PREV.lstrip() + f""",
g AS (
  SELECT CAST(count(*) AS DOUBLE) AS c2,
         greatest(avg(CASE WHEN id IS NULL THEN 1.0 ELSE 0.0 END), avg(CASE WHEN text IS NULL THEN 1.0 ELSE 0.0 END),
                  avg(CASE WHEN text_hash IS NULL THEN 1.0 ELSE 0.0 END),
                  avg(CASE WHEN model_score IS NULL OR isnan(model_score) THEN 1.0 ELSE 0.0 END),
                  avg(CASE WHEN user_feedback IS NULL THEN 1.0 ELSE 0.0 END), avg(CASE WHEN model_version IS NULL THEN 1.0 ELSE 0.0 END),
                  avg(CASE WHEN event_timestamp IS NULL THEN 1.0 ELSE 0.0 END),
                  avg(CASE WHEN target_score IS NULL OR isnan(target_score) THEN 1.0 ELSE 0.0 END),
                  avg(CASE WHEN lang IS NULL THEN 1.0 ELSE 0.0 END)) AS c3,
         avg(CASE WHEN {MISMATCH} THEN 1.0 ELSE 0.0 END) AS c7,
         avg({AGE}) AS c8,
         CAST(min(CASE WHEN {INRANGE} THEN 1 ELSE 0 END) AS DOUBLE) AS c9,
         abs(avg(CASE WHEN NOT isnan(model_score) THEN model_score END) - (SELECT b FROM base)) AS c10,
         (SELECT b FROM base) IS NULL AS no_baseline
  FROM clean
),
dup AS (SELECT CAST(sum(n) - count(*) AS DOUBLE) / sum(n) AS c4 FROM (SELECT text_hash, count(*) n FROM clean GROUP BY text_hash) x),
lab AS (SELECT max(share) AS c5, CAST(count(*) AS DOUBLE) AS c6 FROM (
          SELECT CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM clean WHERE target_score IS NOT NULL AND NOT isnan(target_score)) AS share
          FROM clean WHERE target_score IS NOT NULL AND NOT isnan(target_score) GROUP BY target_score) y),
w AS (SELECT * FROM g, dup, lab),
r AS (
  SELECT 1 AS ord, 'required_columns' AS "check", 0.0::DOUBLE AS value, 0.0::DOUBLE AS limit_value, 'pass' AS status FROM w
  UNION ALL SELECT 2, 'min_samples', c2, 100.0, CASE WHEN c2 < 100 THEN 'fail' ELSE 'pass' END FROM w
  UNION ALL SELECT 3, 'null_ratio', c3, 0.01, CASE WHEN c3 > 0.01 THEN 'fail' ELSE 'pass' END FROM w
  UNION ALL SELECT 4, 'duplicate_ratio', c4, 0.05, CASE WHEN c4 > 0.05 THEN 'fail' ELSE 'pass' END FROM w
  UNION ALL SELECT 5, 'max_label_share', c5, 0.85, CASE WHEN c5 > 0.85 THEN 'fail' ELSE 'pass' END FROM w
  UNION ALL SELECT 6, 'label_classes', c6, 2.0, CASE WHEN c6 < 2 THEN 'fail' ELSE 'pass' END FROM w
  UNION ALL SELECT 7, 'feedback_mismatch', c7, 0.1, CASE WHEN c7 > 0.1 THEN 'fail' ELSE 'pass' END FROM w
  UNION ALL SELECT 8, 'freshness_days', c8, 30.0, CASE WHEN c8 > 30 THEN 'warn' ELSE 'pass' END FROM w
  UNION ALL SELECT 9, 'target_range', c9, 1.0, CASE WHEN coalesce(c9, 1.0) < 1 THEN 'fail' ELSE 'pass' END FROM w
  UNION ALL SELECT 10, 'score_drift', c10, 0.2, CASE WHEN no_baseline THEN 'info' WHEN c10 > 0.2 THEN 'warn' ELSE 'pass' END FROM w
)
SELECT ord, "check", round(value, 6) AS value, limit_value, status,
       CASE WHEN ord > coalesce(min(CASE WHEN status = 'fail' THEN ord END) OVER (), 99) THEN 'not_run' ELSE status END AS outcome
FROM r"""

SQL["audit_basic"] = with_ctes(FE, DEDUP, TRAIN) + """
SELECT CAST(count(*) AS BIGINT) AS num_rows, CAST(count(*) FILTER (WHERE text IS NULL) AS BIGINT) AS num_null_text,
       CAST(count(*) FILTER (WHERE label IS NULL OR isnan(label)) AS BIGINT) AS num_null_labels FROM tset"""
SQL["audit_labels"] = with_ctes(FE, DEDUP, TRAIN) + """
SELECT round(avg(x), 6) AS label_mean, round(stddev_samp(x), 6) AS label_std, round(min(x), 6) AS label_min,
       round(max(x), 6) AS label_max, round(median(x), 6) AS label_median
FROM (SELECT CASE WHEN NOT isnan(label) THEN label END AS x FROM tset) t"""
SQL["audit_tokens"] = with_ctes(FE, DEDUP, TRAIN) + f"""
SELECT round(avg(n), 6) AS token_len_mean, round(stddev_pop(n), 6) AS token_len_std,
       round(quantile_cont(n, 0.95), 6) AS token_len_p95, round(quantile_cont(n, 0.99), 6) AS token_len_p99,
       CAST(max(n) AS BIGINT) AS token_len_max, round(avg(CASE WHEN n > 512 THEN 1.0 ELSE 0.0 END), 6) AS pct_truncated
FROM (SELECT len(regexp_extract_all(coalesce(text, 'nan'), '{PAT}')) + 2 AS n FROM tset) t"""
SQL["table_fingerprint"] = with_ctes(FE, DEDUP, TRAIN) + f"""
SELECT source, CAST(count(*) AS BIGINT) AS num_rows, CAST(CAST(sum({ROWHASH}) AS DECIMAL(38,0)) AS VARCHAR) AS fingerprint
FROM tset GROUP BY source"""
SQL["text_tree"] = """
WITH RECURSIVE b AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
s AS (SELECT doc_id, raw, octet_length(raw) AS size, greatest((octet_length(raw) + 255) // 256, 1) AS n FROM b),
leaf AS (SELECT doc_id, size, n, k, sha256(raw[k * 256 + 1 : k * 256 + 256]) AS h
         FROM (SELECT doc_id, raw, size, n, unnest(range(n)) AS k FROM s) x),
tree AS (
  SELECT doc_id, size, n, n AS left_, k, h FROM leaf
  UNION ALL
  SELECT doc_id, size, n, (left_ + 3) // 4, k // 4, sha256(string_agg(h, '' ORDER BY k))
  FROM tree WHERE left_ > 1 GROUP BY doc_id, size, n, left_, k // 4
)
SELECT doc_id, CAST(size AS BIGINT) AS n_bytes, CAST(n AS BIGINT) AS n_chunks, h AS root FROM tree WHERE left_ = 1"""
SQL["lineage_join"] = with_ctes(FE, DEDUP, TRAIN, DSR, MR) + """,
j AS (SELECT mr.run_id, mr.dataset_run_id, d.num_rows, d.label_mean, d.label_std, d.label_min, d.label_max,
             d.dataset_run_id IS NOT NULL AS found
      FROM mr LEFT JOIN dsr d ON mr.dataset_run_id = d.dataset_run_id)
SELECT run_id, dataset_run_id, 'dataset_num_rows' AS param_key, round(num_rows, 6) AS param_value FROM j WHERE num_rows IS NOT NULL
UNION ALL SELECT run_id, dataset_run_id, 'dataset_label_mean', round(label_mean, 6) FROM j WHERE label_mean IS NOT NULL
UNION ALL SELECT run_id, dataset_run_id, 'dataset_label_std', round(label_std, 6) FROM j WHERE label_std IS NOT NULL
UNION ALL SELECT run_id, dataset_run_id, 'dataset_label_min', round(label_min, 6) FROM j WHERE label_min IS NOT NULL
UNION ALL SELECT run_id, dataset_run_id, 'dataset_label_max', round(label_max, 6) FROM j WHERE label_max IS NOT NULL
UNION ALL SELECT run_id, dataset_run_id, NULL, NULL FROM j WHERE NOT found"""
SQL["lineage_check"] = with_ctes(FE, DEDUP, TRAIN, DSR, MR) + """
SELECT mr.run_id, mr.dataset_run_id, mr.dataset_checksum AS declared_checksum, d.dataset_checksum AS audited_checksum,
       CASE WHEN d.dataset_checksum IS NULL THEN 'missing'
            WHEN mr.dataset_checksum IS NOT DISTINCT FROM d.dataset_checksum THEN 'match' ELSE 'mismatch' END AS status
FROM mr LEFT JOIN dsr d ON mr.dataset_run_id = d.dataset_run_id"""


# ------------------------------------------------------------------ evaluation, runs, splits

EVAL = with_ctes(FE, PRED)
ACT = "coalesce(y_true >= 0.5 AND NOT isnan(y_true), false)"


def _pred_at(t):
    return f"coalesce(y_pred >= {t} AND NOT isnan(y_pred), false)"


SQL["regression_metrics"] = EVAL + """
SELECT model_version, CAST(count(*) AS BIGINT) AS n, round(avg(abs(y_true - y_pred)), 6) AS mae,
       round(avg((y_true - y_pred) * (y_true - y_pred)), 6) AS mse,
       round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 6) AS rmse,
       round(avg((y_true - y_pred) * (y_true - y_pred)), 6) AS ref_rmse
FROM pred GROUP BY model_version"""
SQL["confusion_matrix"] = EVAL + "\nUNION ALL\n".join(
    f"SELECT {t} AS threshold, {a} AS actual, {p} AS predicted, "
    f"CAST(count(*) FILTER (WHERE {'' if a else 'NOT '}{ACT} AND {'' if p else 'NOT '}{_pred_at(t)}) AS BIGINT) AS n FROM pred"
    for t in (0.3, 0.5, 0.7) for a in (0, 1) for p in (0, 1))
_BANDS = [(0.0, 0.35), (0.35, 0.65), (0.65, 1.0)]
SQL["band_metrics"] = EVAL + """, b AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{lo:.2f}-{hi:.2f}' AS range, "
    f"count(*) FILTER (WHERE coalesce(y_pred BETWEEN {lo} AND {hi} AND NOT isnan(y_pred), false) AND {ACT}) AS tp, "
    f"count(*) FILTER (WHERE coalesce(y_pred BETWEEN {lo} AND {hi} AND NOT isnan(y_pred), false) AND NOT {ACT}) AS fp, "
    f"count(*) FILTER (WHERE NOT coalesce(y_pred BETWEEN {lo} AND {hi} AND NOT isnan(y_pred), false) AND {ACT}) AS fn FROM pred"
    for lo, hi in _BANDS) + """)
SELECT range, round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 9) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 9) AS recall,
       CAST(fp AS BIGINT) AS false_positives, CAST(fn AS BIGINT) AS false_negatives, CAST(tp AS BIGINT) AS true_positives
FROM b"""
SQL["residual_histogram"] = EVAL + """,
r AS (SELECT y_true - y_pred AS r FROM pred WHERE y_true - y_pred IS NOT NULL AND NOT isnan(y_true - y_pred)),
st AS (SELECT min(r) AS lo, max(r) AS hi, (max(r) - min(r)) / 30 AS w FROM r),
c AS (SELECT CAST(CASE WHEN st.w = 0 THEN 0 ELSE least(floor((r.r - st.lo) / st.w), 29) END AS INTEGER) AS bin, count(*) AS n
      FROM r, st GROUP BY 1),
g AS (SELECT CAST(unnest(range(0, CASE WHEN w = 0 THEN 1 ELSE 30 END)) AS INTEGER) AS bin FROM st WHERE lo IS NOT NULL)
SELECT g.bin, round(st.lo + g.bin * st.w, 9) AS bin_lo, round(st.lo + (g.bin + 1) * st.w, 9) AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM g CROSS JOIN st LEFT JOIN c ON g.bin = c.bin"""
SQL["residual_density"] = EVAL + """,
r AS (SELECT y_true - y_pred AS r FROM pred WHERE y_true - y_pred IS NOT NULL AND NOT isnan(y_true - y_pred)),
st AS (SELECT min(r) AS lo, max(r) AS hi, count(*) AS n, stddev_samp(r) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM r),
v AS (SELECT r, CAST(count(*) AS DOUBLE) AS c FROM r GROUP BY r),
g AS (SELECT unnest(range(0, 200)) AS k FROM st WHERE h > 0 AND hi > lo)
SELECT CAST(g.k AS INTEGER) AS grid_index, round(st.lo + g.k * (st.hi - st.lo) / 199, 9) AS x,
       round(sum(v.c * exp(-pow((st.lo + g.k * (st.hi - st.lo) / 199 - v.r) / st.h, 2) / 2)) / (st.n * st.h * sqrt(2 * pi())), 6) AS density
FROM g CROSS JOIN st CROSS JOIN v GROUP BY g.k, st.lo, st.hi, st.n, st.h"""
SQL["calibration"] = EVAL + """
SELECT CAST(least(floor(y_pred * 10), 9) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n,
       round(avg(y_pred), 6) AS mean_pred, round(avg(y_true), 6) AS mean_actual
FROM pred WHERE y_pred IS NOT NULL AND NOT isnan(y_pred) AND y_true IS NOT NULL AND NOT isnan(y_true) GROUP BY 1"""
SQL["error_by_length"] = EVAL + f"""
SELECT CAST(floor(len / 100) * 100 AS BIGINT) AS length_bin, CAST(count(*) AS BIGINT) AS n,
       round(avg(err), 6) AS mean_error, round(max(err), 6) AS max_error
FROM (SELECT length(array_to_string(list_slice(regexp_extract_all(text, '{PAT}'), 1, 510), '')) AS len,
             abs(y_true - y_pred) AS err FROM pred) t GROUP BY 1"""

LL = """
ll AS (SELECT 'r' || CAST(event_id % 7 AS VARCHAR) AS run_id, phase, (event_id // 7) // 50 AS epoch, event_id // 7 AS step,
              CASE WHEN phase = 'val' THEN value ELSE value / 2 - (event_id // 7) // 50 END AS loss
       FROM (SELECT *, unnest(['val', 'train']) AS phase FROM events) x),
ep AS (SELECT run_id, phase, epoch, avg(loss) AS epoch_loss, sum(loss) AS loss_sum, count(loss) AS steps
       FROM ll GROUP BY run_id, phase, epoch)"""
FIN = "(NOT isnan(m) AND abs(m) != 'inf'::DOUBLE)"
ES = f"""
es1 AS (SELECT run_id, epoch, epoch_loss AS m,
               min(epoch_loss) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pb
        FROM ep WHERE phase = 'val'),
es2 AS (SELECT *, coalesce(m < pb, true) AND {FIN} AS improved FROM es1),
es3 AS (SELECT *, sum(CASE WHEN improved THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS island FROM es2),
es4 AS (SELECT *, row_number() OVER (PARTITION BY run_id, island ORDER BY epoch) - 1 AS wait FROM es3),
es AS (SELECT run_id, min(CASE WHEN wait >= 2 OR NOT {FIN} THEN epoch END) AS stop_epoch,
              CAST(count(*) AS BIGINT) AS epochs_seen FROM es4 GROUP BY run_id)"""
SQL["epoch_loss"] = "WITH" + LL + "\nSELECT run_id, phase, epoch, round(epoch_loss, 9) AS epoch_loss, CAST(steps AS BIGINT) AS steps FROM ep"
SQL["running_loss"] = "WITH" + LL + """
SELECT run_id, phase, epoch,
       round(sum(loss_sum) OVER w / sum(steps) OVER w, 9) AS running_loss
FROM ep WINDOW w AS (PARTITION BY run_id, phase ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
SQL["early_stop"] = "WITH" + LL + "," + ES + "\nSELECT run_id, stop_epoch, epochs_seen FROM es"
SQL["best_checkpoint"] = "WITH" + LL + "," + ES + """,
b AS (SELECT ep.run_id, ep.epoch, ep.epoch_loss,
             row_number() OVER (PARTITION BY ep.run_id ORDER BY ep.epoch_loss, ep.epoch) AS rk
      FROM ep LEFT JOIN es ON ep.run_id = es.run_id
      WHERE ep.phase = 'val' AND (es.stop_epoch IS NULL OR ep.epoch <= es.stop_epoch) AND NOT isnan(ep.epoch_loss))
SELECT run_id, epoch AS best_epoch, round(epoch_loss, 9) AS best_value FROM b WHERE rk = 1"""

CAND = """
cand AS (SELECT model_version AS family, CAST(event_timestamp AS DATE) AS day,
                round(avg(abs(target_score - model_score)), 6) AS test_mae FROM fe GROUP BY 1, 2)"""


def _promote(best, s):
    return (f"coalesce({s} IS NOT NULL AND NOT isnan({s}) AND CASE WHEN {best} IS NULL THEN {s} < 'inf'::DOUBLE "
            f"ELSE {s} < {best} AND ({best} - {s}) / {best} >= 0.02 END, false)")


def _fold(src):
    p = _promote("f.best", "c.test_mae")
    return f"""
c AS (SELECT family, day, test_mae, row_number() OVER (PARTITION BY family ORDER BY day) AS rn FROM {src}),
fold AS (
  SELECT family, CAST(0 AS BIGINT) AS rn, CAST(NULL AS DOUBLE) AS best, CAST(0 AS BIGINT) AS promotions,
         CAST(NULL AS DATE) AS last_promoted
  FROM (SELECT DISTINCT family FROM c) x
  UNION ALL
  SELECT c.family, c.rn, CASE WHEN {p} THEN c.test_mae ELSE f.best END,
         f.promotions + CASE WHEN {p} THEN 1 ELSE 0 END,
         CASE WHEN {p} THEN c.day ELSE f.last_promoted END
  FROM fold f JOIN c ON c.family = f.family AND c.rn = f.rn + 1
),
hist AS (SELECT f.family, n.candidates, f.best AS final_best, f.promotions, f.last_promoted
         FROM fold f JOIN (SELECT family, CAST(count(*) AS BIGINT) AS candidates FROM c GROUP BY family) n
           ON f.family = n.family AND f.rn = n.candidates)"""


SQL["promotion_history"] = "WITH RECURSIVE" + FE.replace("fe AS", " fe AS", 1) + "," + CAND + "," + _fold("cand") + """
SELECT family, candidates, final_best, promotions, last_promoted FROM hist"""
SQL["promotion_decision"] = "WITH RECURSIVE" + FE.replace("fe AS", " fe AS", 1) + "," + CAND + """,
ld AS (SELECT family, max(day) AS last_day FROM cand GROUP BY family),
latest AS (SELECT cand.family, test_mae AS candidate_score FROM cand JOIN ld ON cand.family = ld.family AND cand.day = ld.last_day),
earlier AS (SELECT cand.* FROM cand JOIN ld ON cand.family = ld.family AND cand.day < ld.last_day),""" + _fold("earlier") + """,
j AS (SELECT l.family, l.candidate_score, h.family IS NULL AS first_dep,
             CASE WHEN h.family IS NULL THEN 'inf'::DOUBLE ELSE coalesce(h.final_best, 'inf'::DOUBLE) END AS best_v
      FROM latest l LEFT JOIN hist h ON l.family = h.family),
k AS (SELECT *, CASE WHEN best_v = 'inf'::DOUBLE THEN 1.0 ELSE (best_v - candidate_score) / best_v END AS improvement FROM j),
m AS (SELECT *, coalesce(candidate_score < best_v AND NOT isnan(candidate_score) AND (first_dep OR improvement >= 0.02), false) AS p FROM k)
SELECT family, candidate_score, best_v AS best_before, round(improvement, 9) AS improvement,
       CASE WHEN candidate_score IS NULL THEN NULL ELSE p END AS promoted,
       CASE WHEN candidate_score IS NULL THEN 'missing_metric' WHEN p THEN 'promoted'
            WHEN NOT isnan(candidate_score) AND candidate_score >= best_v THEN 'no_improvement'
            ELSE 'insufficient_improvement' END AS reason,
       CASE WHEN p THEN candidate_score ELSE best_v END AS best_after
FROM m"""
SQL["run_compare"] = "WITH" + LL + "," + ES + """
SELECT r.run_id, 2.0 AS patience, round(r.n_steps, 9) AS n_steps, round(r.mean_loss, 9) AS mean_loss,
       round(e.n_epochs, 9) AS n_epochs, round(e.best_epoch_loss, 9) AS best_epoch_loss,
       round(CAST(es.stop_epoch AS DOUBLE), 9) AS stop_epoch
FROM (SELECT run_id, CAST(count(*) AS DOUBLE) AS n_steps, avg(loss) AS mean_loss FROM ll WHERE phase = 'val' GROUP BY run_id) r
JOIN (SELECT run_id, CAST(count(*) AS DOUBLE) AS n_epochs, min(epoch_loss) AS best_epoch_loss FROM ep WHERE phase = 'val' GROUP BY run_id) e
  ON r.run_id = e.run_id
JOIN es ON r.run_id = es.run_id"""

SKEY = "('0x' || substr(md5('42:' || CAST({k} AS VARCHAR)), 1, 8))::BIGINT"
SQL["sample_head"] = with_ctes(FE, DEDUP, CLEAN) + """
SELECT id, text, model_score, user_feedback, target_score FROM clean
ORDER BY event_timestamp ASC NULLS LAST, id ASC LIMIT 5"""
SQL["seeded_shuffle"] = F_ + f"""
SELECT id, shuffle_key, row_number() OVER (ORDER BY shuffle_key, id) AS shuffle_rank
FROM (SELECT id, {SKEY.format(k='id')} AS shuffle_key FROM fe) t"""
SPLIT = f"""
sk AS (SELECT doc_id, sha256(text) AS text_hash, row_number() OVER (ORDER BY {SKEY.format(k='doc_id')}, doc_id) AS rk FROM tset),
sn AS (SELECT CAST(floor(count(*) * 0.7::DOUBLE) AS BIGINT) AS nt, count(*) AS n FROM tset),
sv AS (SELECT nt, CAST(floor((n - nt) / 2) AS BIGINT) AS nv FROM sn),
sx AS (SELECT sk.doc_id, sk.text_hash,
              CASE WHEN rk <= nt THEN 'train' WHEN rk <= nt + nv THEN 'val' ELSE 'test' END AS split,
              CAST(rk - CASE WHEN rk <= nt THEN 0 WHEN rk <= nt + nv THEN nt ELSE nt + nv END AS BIGINT) AS rank_in_split
       FROM sk, sv)"""
SQL["split_exact"] = with_ctes(FE, DEDUP, TRAIN) + "," + SPLIT + "\nSELECT doc_id, split, rank_in_split FROM sx"
SQL["split_bucket"] = with_ctes(FE, DEDUP, TRAIN) + f"""
SELECT doc_id, CASE WHEN k < 3006477107.2 THEN 'train' WHEN k < 3650722201.6 THEN 'val' ELSE 'test' END AS split
FROM (SELECT doc_id, {SKEY.format(k='doc_id')} AS k FROM tset) t"""
SQL["batch_plan"] = with_ctes(FE, DEDUP, TRAIN) + "," + SPLIT + """,
pb AS (SELECT split, CAST(floor((rank_in_split - 1) / 4) AS BIGINT) AS batch, count(*) AS size FROM sx GROUP BY 1, 2)
SELECT split, CAST(sum(size) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_batches,
       CAST(arg_max(size, batch) AS BIGINT) AS last_batch_size FROM pb GROUP BY split"""
SQL["split_leak"] = with_ctes(FE, DEDUP, TRAIN) + "," + SPLIT + """,
a AS (SELECT DISTINCT text_hash FROM sx WHERE split = 'train' AND text_hash IS NOT NULL),
b AS (SELECT * FROM sx WHERE split <> 'train' AND text_hash IS NOT NULL)
SELECT CAST((SELECT count(*) FROM (SELECT text_hash FROM a INTERSECT SELECT text_hash FROM b)) AS BIGINT) AS overlap_keys,
       CAST((SELECT count(*) FROM b WHERE text_hash IN (SELECT text_hash FROM a)) AS BIGINT) AS rows_leaked,
       CAST((SELECT count(*) FROM b WHERE text_hash NOT IN (SELECT text_hash FROM a)) AS BIGINT) AS rows_clean,
       CAST((SELECT count(*) FROM a) AS BIGINT) AS keys_a,
       CAST((SELECT count(DISTINCT text_hash) FROM b) AS BIGINT) AS keys_b"""


# ------------------------------------------------------------------ language, vocabulary, scoring, ingest

PROF = """
dg0 AS (SELECT doc_id, lang, lower(text) AS lt, unnest(range(1, length(lower(text)) - 1)) AS i
        FROM documents WHERE text IS NOT NULL),
dg AS (SELECT doc_id, lang, substr(lt, i, 3) AS gram FROM dg0),
pc AS (SELECT lang, gram, count(*) AS n FROM dg WHERE lang IS NOT NULL GROUP BY lang, gram),
pt AS (SELECT lang, sum(n) AS t FROM pc GROUP BY lang),
pv AS (SELECT count(DISTINCT gram) AS v FROM pc),
prof AS (SELECT gg.gram, pt.lang, ln(coalesce(pc.n, 0) + 0.5) - ln(pt.t + 0.5 * pv.v) AS lp
         FROM (SELECT DISTINCT gram FROM pc) gg CROSS JOIN pt CROSS JOIN pv
         LEFT JOIN pc ON pc.gram = gg.gram AND pc.lang = pt.lang)"""


def detect_cte(src: str, key: str, name: str = "det") -> str:
    return f"""
{name}_g0 AS (SELECT {key} AS k, lower(text) AS lt, unnest(range(1, length(lower(text)) - 1)) AS i
              FROM {src} WHERE text IS NOT NULL),
{name}_g AS (SELECT k, substr(lt, i, 3) AS gram FROM {name}_g0),
{name}_s AS (SELECT g.k, prof.lang, sum(prof.lp) AS s FROM {name}_g g JOIN prof ON g.gram = prof.gram GROUP BY 1, 2),
{name} AS (SELECT k AS {key}, lang AS detected_lang FROM {name}_s
           QUALIFY row_number() OVER (PARTITION BY k ORDER BY s DESC, lang ASC) = 1)"""


LANG_REASON = "CASE WHEN detected_lang IS NULL THEN 'detection failed' WHEN detected_lang <> 'en' THEN 'not English' END"

SQL["lang_profile"] = "WITH" + PROF + """
SELECT pc.lang, pc.gram, CAST(pc.n AS BIGINT) AS n, round(ln(pc.n + 0.5) - ln(pt.t + 0.5 * pv.v), 9) AS logp
FROM pc JOIN pt ON pc.lang = pt.lang CROSS JOIN pv"""
SQL["lang_detect"] = "WITH" + PROF + "," + detect_cte("documents", "doc_id") + """
SELECT d.doc_id, det.detected_lang FROM documents d LEFT JOIN det ON d.doc_id = det.doc_id"""

VOCAB = f"""
vc AS (SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '{PAT}')) AS token FROM documents) t
       GROUP BY token),
vocab AS (SELECT token, CAST(n AS BIGINT) AS n, CAST(row_number() OVER (ORDER BY n DESC, token ASC) + 3 AS INTEGER) AS token_id
          FROM vc)"""
SQL["vocab_build"] = "WITH" + VOCAB + "\nSELECT token, n, token_id FROM vocab"
SQL["encode_fixed"] = "WITH" + VOCAB + f""",
et AS (SELECT doc_id, list_slice(regexp_extract_all(text, '{PAT}'), 1, 510) AS toks FROM documents),
eu AS (SELECT doc_id, unnest(toks) AS token, unnest(range(1, len(toks) + 1)) AS pos FROM et),
el AS (SELECT eu.doc_id, list(coalesce(v.token_id, 3) ORDER BY eu.pos) AS ids
       FROM eu LEFT JOIN vocab v ON eu.token = v.token GROUP BY eu.doc_id),
ea AS (SELECT d.doc_id, coalesce(el.ids, []::INTEGER[]) AS ids FROM documents d LEFT JOIN el ON d.doc_id = el.doc_id)
SELECT doc_id,
       array_to_string(list_concat([0], ids, [2]), ',') || repeat(',1', CAST(510 - len(ids) AS INTEGER)) AS ids_text,
       CAST(len(ids) + 2 AS INTEGER) AS mask_sum
FROM ea"""

WEIGHTS = f"""
lab AS (SELECT d.text, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
wt AS (SELECT token, ln(CAST(count(*) FILTER (WHERE quality = 1) + 1 AS DOUBLE) /
                        CAST(count(*) FILTER (WHERE quality = 0) + 1 AS DOUBLE)) AS w
       FROM (SELECT quality, unnest(regexp_extract_all(text, '{PAT}')) AS token FROM lab) t GROUP BY token),
stok AS (SELECT doc_id, unnest(regexp_extract_all(text, '{PAT}')) AS token FROM documents),
sc AS (SELECT s.doc_id, sum(coalesce(wt.w, 0.0)) AS sw, count(*) AS nt FROM stok s LEFT JOIN wt ON s.token = wt.token
       GROUP BY s.doc_id),
lin AS (SELECT d.doc_id, 1.0 / (1.0 + exp(-(CASE WHEN coalesce(sc.nt, 0) > 0 THEN sc.sw / sc.nt ELSE 0.0 END))) AS score
        FROM documents d LEFT JOIN sc ON d.doc_id = sc.doc_id)"""
SQL["score_linear"] = "WITH" + WEIGHTS + "\nSELECT doc_id, round(score, 6) AS score FROM lin"
SQL["predict_pipeline"] = "WITH" + PROF + "," + detect_cte("documents", "doc_id") + "," + WEIGHTS + f""",
pp AS (SELECT d.doc_id, det.detected_lang FROM documents d LEFT JOIN det ON d.doc_id = det.doc_id),
pr AS (SELECT pp.doc_id, pp.detected_lang, {LANG_REASON} AS reason, lin.score FROM pp JOIN lin ON pp.doc_id = lin.doc_id),
ps AS (SELECT doc_id, detected_lang, reason, CASE WHEN reason IS NULL THEN score END AS score FROM pr)
SELECT doc_id, detected_lang, reason, round(score, 6) AS score,
       {BAND.format(s="score", lo="Human-written", hi="AI-generated")} AS label FROM ps"""

INC = """
half AS (SELECT max(id) / 2 AS h FROM fe),
store AS (SELECT * FROM fe WHERE id < (SELECT h FROM half) AND id % 5 = 0
          QUALIFY row_number() OVER (PARTITION BY text_hash ORDER BY id) = 1),
req AS (SELECT id, CASE WHEN id % 53 = 0 THEN 'abc' WHEN id % 61 = 0 THEN '\u4e2d\u6587\u4e2d\u6587\u4e2d\u6587' WHEN id % 67 = 0 THEN NULL ELSE text END AS text,
               CASE WHEN id % 43 = 0 THEN 1.5 WHEN id % 79 = 0 THEN NULL ELSE model_score END AS model_score,
               CASE WHEN id % 41 = 0 THEN 'some_unknown_feedback_label' WHEN id % 71 = 0 THEN NULL ELSE user_feedback END AS user_feedback,
               CASE WHEN id % 47 = 0 THEN NULL WHEN id % 73 = 0 THEN repeat('v', 101) ELSE model_version END AS model_version,
               event_timestamp, unnest(CASE WHEN id % 59 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM fe),
rh AS (SELECT *, sha256(text) AS text_hash FROM req),
ih AS (SELECT * FROM rh WHERE id >= (SELECT h FROM half))"""
SHAPE = """CASE WHEN coalesce(length(text) < 5, true) THEN 'text_too_short'
     WHEN model_score IS NULL OR isnan(model_score) OR model_score < 0.0 OR model_score > 1.0 THEN 'score_out_of_range'
     WHEN NOT coalesce(regexp_matches(user_feedback, '^(human|ai|human_edited_ai)$'), false) THEN 'invalid_feedback'
     WHEN model_version IS NULL THEN 'missing_model_version'
     WHEN user_feedback NOT IN ('human', 'ai', 'human_edited_ai') THEN 'feedback_not_allowed' END"""


def new_dups(src: str) -> str:
    return f"""
fst AS (SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY text_hash ORDER BY event_timestamp ASC NULLS LAST, id ASC, copy) = 1),
new AS (SELECT * FROM fst f WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.text_hash = f.text_hash)),
dups AS (SELECT * FROM fst f WHERE EXISTS (SELECT 1 FROM store s WHERE s.text_hash = f.text_hash)
         UNION ALL SELECT * FROM {src} x WHERE NOT EXISTS (SELECT 1 FROM fst WHERE fst.id = x.id AND fst.copy = x.copy))"""


SQL["ingest_validate"] = with_ctes(FE, INC) + f"SELECT id, {SHAPE} AS reject_reason FROM req"
SQL["constraint_report"] = with_ctes(FE, INC) + """
SELECT 'text_not_null' AS rule, CAST(count(*) FILTER (WHERE text IS NULL) AS BIGINT) AS violations FROM rh
UNION ALL SELECT 'text_hash_not_null', CAST(count(*) FILTER (WHERE text_hash IS NULL) AS BIGINT) FROM rh
UNION ALL SELECT 'model_score_not_null', CAST(count(*) FILTER (WHERE model_score IS NULL) AS BIGINT) FROM rh
UNION ALL SELECT 'user_feedback_not_null', CAST(count(*) FILTER (WHERE user_feedback IS NULL) AS BIGINT) FROM rh
UNION ALL SELECT 'user_feedback_allowed', CAST(count(*) FILTER (WHERE user_feedback NOT IN ('human', 'ai', 'human_edited_ai')) AS BIGINT) FROM rh
UNION ALL SELECT 'text_hash_width', CAST(count(*) FILTER (WHERE length(text_hash) > 64) AS BIGINT) FROM rh
UNION ALL SELECT 'user_feedback_width', CAST(count(*) FILTER (WHERE length(user_feedback) > 20) AS BIGINT) FROM rh
UNION ALL SELECT 'model_version_width', CAST(count(*) FILTER (WHERE length(model_version) > 100) AS BIGINT) FROM rh
UNION ALL SELECT 'text_hash_unique', CAST(coalesce((SELECT sum(n) FROM (SELECT text_hash, count(*) AS n FROM rh
          WHERE text_hash IS NOT NULL GROUP BY text_hash HAVING count(*) > 1) t), 0) AS BIGINT)"""
SQL["ingest_lang_gate"] = with_ctes(FE, INC) + "," + PROF.lstrip() + "," + detect_cte(
    "(SELECT DISTINCT text_hash, text FROM rh)", "text_hash") + f"""
SELECT rh.id, det.detected_lang, {LANG_REASON} AS reason FROM rh LEFT JOIN det ON rh.text_hash = det.text_hash"""
SQL["ingest_new"] = with_ctes(FE, INC) + "," + new_dups("ih") + "\nSELECT id, text_hash FROM new"
SQL["ingest_duplicates"] = with_ctes(FE, INC) + "," + new_dups("ih") + "\nSELECT id, text_hash FROM dups"
SQL["ingest_pipeline"] = with_ctes(FE, INC) + "," + PROF.lstrip() + "," + detect_cte(
    "(SELECT DISTINCT text_hash, text FROM ih)", "text_hash") + f""",
r0 AS (SELECT ih.*, {SHAPE} AS shape FROM ih),
r AS (SELECT r0.*, coalesce(shape, {LANG_REASON}) AS reject_reason FROM r0 LEFT JOIN det ON r0.text_hash = det.text_hash),
okr AS (SELECT * EXCLUDE (shape, reject_reason) FROM r WHERE reject_reason IS NULL),""" + new_dups("okr") + f"""
SELECT id, text_hash, 'accepted' AS status, {MAP_TARGET} AS target_score FROM new
UNION ALL SELECT id, text_hash, 'duplicate', NULL::DOUBLE FROM dups
UNION ALL SELECT id, text_hash, reject_reason, NULL::DOUBLE FROM r WHERE reject_reason IS NOT NULL"""

MON = f"""
SELECT ws AS window_start, ws + INTERVAL {{dur}} AS window_end, CAST(count(*) AS BIGINT) AS n,
       round(avg(CASE WHEN NOT isnan(model_score) THEN model_score END), 6) AS mean_score,
       round(avg(CASE WHEN {MISMATCH} THEN 1.0 ELSE 0.0 END), 6) AS mismatch_ratio,
       round(avg(CASE WHEN user_feedback = 'ai' THEN 1.0 ELSE 0.0 END), 6) AS ai_share
FROM (SELECT *, {{start}} AS ws FROM fe {{extra}}) t GROUP BY ws"""
SQL["monitor_tumbling"] = F_ + MON.format(dur="'1 day'", start="date_trunc('day', event_timestamp)", extra="")
SQL["monitor_sliding"] = F_ + MON.format(
    dur="'3 days'", start="date_trunc('day', event_timestamp) - to_days(CAST(k AS INTEGER))",
    extra=", (SELECT unnest(range(0, 3)) AS k) kk")

SQL["csv_roundtrip"] = SQL["clean_feedback"]

SQL["clean_feedback_detected"] = with_ctes(FE) + "," + PROF.lstrip() + """,
lf AS (SELECT * FROM fe WHERE coalesce(length(text) BETWEEN 5 AND 1000, false)),""" + detect_cte(
    "(SELECT DISTINCT text_hash, text FROM lf)", "text_hash") + f""",
x AS (SELECT lf.*, det.detected_lang FROM lf LEFT JOIN det ON lf.text_hash = det.text_hash
      WHERE coalesce(det.detected_lang = 'en', false)),
xd AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY text_hash
                                                  ORDER BY event_timestamp DESC NULLS FIRST, id DESC) = 1)
SELECT {FEEDBACK_COLS}, detected_lang FROM xd
WHERE {CONSISTENT} AND target_score IS NOT NULL AND NOT isnan(target_score)"""
SQL["calibration_points"] = with_ctes(FE, PRED) + "SELECT id, y_pred AS predicted, y_true AS actual FROM pred"

SQL["score_udf"] = """
SELECT doc_id,
       round(1.0 / (1.0 + exp(-((CAST(len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]')) AS DOUBLE)
                                 / greatest(length(coalesce(text, '')), 1)) - 0.5) * 4.0)), 6) AS score
FROM documents"""

SQL["metrics_json"] = SQL["band_metrics"]
SQL["dataset_registry"] = with_ctes(FE, DEDUP, TRAIN) + f"""
SELECT 'training_set' AS dataset, run_id, CAST(CAST(sum({ROWHASH}) AS DECIMAL(38,0)) AS VARCHAR) AS fingerprint,
       CAST(count(*) AS BIGINT) AS rows, {AS_OF} AS registered_at
FROM (SELECT *, unnest(['r1', 'r2']) AS run_id FROM tset) x GROUP BY run_id"""
_hard_fails = SQL["validation_report"].replace("SELECT ord, \"check\", round(value, 6)", "SELECT ord, status AS hard, \"check\", round(value, 6)", 1)
SQL["drift_state"] = with_ctes(FE, DEDUP, CLEAN) + "," + PREV.lstrip() + f""",
report AS (SELECT * FROM ({_hard_fails}) q)
SELECT run_ts, round(mean_score, 6) AS mean_score FROM hist
UNION ALL SELECT {AS_OF}, round(avg(CASE WHEN NOT isnan(model_score) THEN model_score END), 6) FROM clean
HAVING (SELECT count(*) FROM report WHERE hard = 'fail') = 0"""
SQL["ingest_append"] = SQL["ingest_pipeline"][:SQL["ingest_pipeline"].rindex("\nSELECT id, text_hash, 'accepted'")] + f"""
SELECT id, text_hash, target_score, CAST(event_timestamp AS DATE) AS event_date FROM store
UNION ALL SELECT id, text_hash, {MAP_TARGET}, CAST(event_timestamp AS DATE) FROM new"""
SQL["split_two_way"] = with_ctes(FE, DEDUP, TRAIN) + f""",
sk AS (SELECT doc_id, row_number() OVER (ORDER BY {SKEY.format(k='doc_id')}, doc_id) AS rk FROM tset),
sr AS (SELECT sk.*, train_ratio, CAST(floor((SELECT count(*) FROM tset) * train_ratio) AS BIGINT) AS nt
       FROM (SELECT *, unnest([0.8::DOUBLE, 0.85::DOUBLE]) AS train_ratio FROM sk) sk)
SELECT doc_id, train_ratio, CASE WHEN rk <= nt THEN 'train' ELSE 'test' END AS split,
       CAST(rk - CASE WHEN rk <= nt THEN 0 ELSE nt END AS BIGINT) AS rank_in_split FROM sr"""
SQL["early_stop_running"] = "WITH" + LL + """,
rl AS (SELECT run_id, epoch, phase, sum(loss_sum) OVER w / sum(steps) OVER w AS epoch_loss
       FROM ep WINDOW w AS (PARTITION BY run_id, phase ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),""" + ES.replace(
    "FROM ep WHERE", "FROM rl WHERE") + "\nSELECT run_id, stop_epoch, epochs_seen FROM es"


# ------------------------------------------------------------------ K4: the training loop, one CTE per gradient round

def training_cte(rates: dict, epochs: int, rounds: int, dim: int) -> str:
    """Features, weights after every round (k0, k1, ...) and the log of the epochs that ran."""
    runs = " UNION ALL ".join(f"SELECT '{r}' AS run_id, {v}::DOUBLE AS rate" for r, v in sorted(rates.items()))
    out = f"""
kd AS (SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS y, {SKEY.format(k='d.doc_id')} AS sk,
              list_filter(list_transform(regexp_extract_all(lower(coalesce(d.text, '')), '{PAT}'), lambda t: ltrim(t)),
                          lambda t: regexp_full_match(t, '\\p{{L}}+')) AS ws
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL),
kp AS MATERIALIZED (
  SELECT doc_id, y, CASE WHEN sk < 3006477107.2 THEN CAST(sk % {rounds} AS VARCHAR) WHEN sk < 3650722201.6 THEN 'val' ELSE 'test' END AS part FROM kd),
kc AS (SELECT doc_id, CAST(('0x' || substr(md5(w), 1, 8))::BIGINT % {dim} AS INTEGER) AS b, count(*) AS c
       FROM (SELECT doc_id, unnest(ws) AS w FROM kd) GROUP BY 1, 2),
kf AS MATERIALIZED (
  SELECT doc_id, b, c / sqrt(sum(c * c) OVER (PARTITION BY doc_id)) AS x FROM kc UNION ALL SELECT doc_id, -1, 1.0 FROM kp),
kr AS ({runs}),
kk0 AS MATERIALIZED (SELECT run_id, rate, b, 0.0::DOUBLE AS w, 0.0::DOUBLE AS v FROM kr, (SELECT DISTINCT b FROM kf))"""

    def scores(k, part):
        return (f"SELECT p.doc_id, p.y, w.run_id, 1 / (1 + exp(-sum(f.x * w.w))) AS s FROM kp p JOIN kf f ON p.doc_id = f.doc_id "
                f"JOIN kk{k} w ON f.b = w.b WHERE p.part = '{part}' GROUP BY ALL")

    k, logs = 0, []
    for e in range(epochs):
        for r in range(rounds):
            out += f""",
ks{k} AS MATERIALIZED ({scores(k, r)}),
kg{k} AS (SELECT s.run_id, f.b, sum(2 * (s.s - s.y) * s.s * (1 - s.s) * f.x) / (SELECT count(*) FROM kp WHERE part = '{r}') AS g
          FROM ks{k} s JOIN kf f ON s.doc_id = f.doc_id GROUP BY 1, 2),
kk{k + 1} AS MATERIALIZED (
  SELECT w.run_id, w.rate, w.b, w.w - w.rate * ({0.9} * w.v + coalesce(g.g, 0)) AS w, {0.9} * w.v + coalesce(g.g, 0) AS v
  FROM kk{k} w LEFT JOIN kg{k} g ON w.run_id = g.run_id AND w.b = g.b)"""
            k += 1
        train = " UNION ALL ".join(f"SELECT run_id, avg((s - y) * (s - y)) AS m FROM ks{i} GROUP BY 1" for i in range(k - rounds, k))
        out += f""",
kv{e} AS (SELECT run_id, {e} AS epoch, avg((s - y) * (s - y)) AS val_loss, avg(abs(s - y)) AS val_mae FROM ({scores(k, 'val')}) GROUP BY 1),
kl{e} AS (SELECT v.*, t.m AS train_loss FROM kv{e} v JOIN (SELECT run_id, avg(m) AS m FROM ({train}) GROUP BY 1) t ON v.run_id = t.run_id)"""
        logs.append(f"SELECT * FROM kl{e}")
    es = ES.replace("epoch_loss AS m", "val_mae AS m").replace("min(epoch_loss)", "min(val_mae)").replace("FROM ep WHERE phase = 'val'", "FROM kall")
    return out + ",\nkall AS MATERIALIZED (" + " UNION ALL ".join(logs) + ")," + es + """,
klog AS (SELECT kall.* FROM kall JOIN es ON kall.run_id = es.run_id WHERE es.stop_epoch IS NULL OR kall.epoch <= es.stop_epoch)"""


TRAINING_CTE = training_cte({"fast": 8.0, "slow": 1.0}, 5, 4, 4096)
SQL["train_epochs"] = "WITH" + TRAINING_CTE + """
SELECT run_id, CAST(epoch AS INTEGER) AS epoch, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss,
       round(val_mae, 6) AS val_mae, round(sqrt(val_loss), 6) AS val_rmse FROM klog"""
_tests = " UNION ALL ".join(
    f"SELECT {e} AS epoch, p.doc_id, p.y, w.run_id, 1 / (1 + exp(-sum(f.x * w.w))) AS s FROM kp p JOIN kf f ON p.doc_id = f.doc_id "
    f"JOIN kk{4 * (e + 1)} w ON f.b = w.b WHERE p.part = 'test' GROUP BY ALL" for e in range(5))
SQL["train_best"] = "WITH" + TRAINING_CTE + f""",
kb AS (SELECT run_id, epoch AS best_epoch, val_mae FROM klog QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY val_mae, epoch) = 1),
km AS (SELECT avg(y) AS m FROM kp WHERE part NOT IN ('val', 'test'))
SELECT kb.run_id, CAST(es.stop_epoch AS INTEGER) AS stop_epoch, (SELECT count(*) FROM klog l WHERE l.run_id = kb.run_id)::BIGINT AS epochs_seen,
       CAST(kb.best_epoch AS INTEGER) AS best_epoch,
       round(kb.val_mae, 6) AS best_val_mae, round(avg(abs(t.s - t.y)), 6) AS test_mae, round(avg(abs(km.m - t.y)), 6) AS mean_mae,
       CAST(count(*) AS BIGINT) AS n_test
FROM kb JOIN es ON kb.run_id = es.run_id JOIN ({_tests}) t ON t.run_id = kb.run_id AND t.epoch = kb.best_epoch, km
GROUP BY kb.run_id, es.stop_epoch, kb.best_epoch, kb.val_mae"""


_HELD = SKEY.format(k="doc_id") + " % 3"
SQL["lang_heldout"] = "WITH" + PROF.replace("FROM documents WHERE text IS NOT NULL", f"FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL AND {_HELD} <> 1") + f""",
held AS (SELECT * FROM documents WHERE {_HELD} = 1 AND lang IS NOT NULL),""" + detect_cte("held", "doc_id") + """
SELECT held.lang, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE det.detected_lang = held.lang) AS BIGINT) AS correct,
       round(avg(CASE WHEN det.detected_lang = held.lang THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM held LEFT JOIN det ON held.doc_id = det.doc_id GROUP BY held.lang"""


COVER = INC + """,
iall AS (SELECT * FROM rh WHERE NOT (id < (SELECT h FROM half) AND id % 5 = 0))"""
SQL["probe_duplicates"] = with_ctes(FE, COVER) + "," + new_dups("iall") + """
SELECT id, text_hash, false AS is_duplicate FROM new UNION ALL SELECT id, text_hash, true FROM dups"""
SQL["probe_append"] = with_ctes(FE, COVER) + "," + new_dups("iall") + """
SELECT id, text_hash, NULL::BIGINT AS batch_id FROM store UNION ALL SELECT id, text_hash, 0 FROM new WHERE text_hash IS NOT NULL"""

SQL["unique_stream"] = with_ctes(FE, COVER) + """,
ua AS (SELECT text_hash, id, event_timestamp, count(*) AS copies FROM iall WHERE text_hash IS NOT NULL GROUP BY 1, 2, 3)
SELECT text_hash, id, CAST(copies AS BIGINT) AS copies,
       row_number() OVER (PARTITION BY text_hash ORDER BY event_timestamp ASC NULLS LAST, id) = 1
       AND text_hash NOT IN (SELECT text_hash FROM store) AS kept
FROM ua"""


_LIMITS = [(1, "required_columns", "0.0::DOUBLE", 0.0, "'pass'"), (2, "min_samples", "c2", 100.0, "CASE WHEN c2 < 100 THEN 'fail' ELSE 'pass' END"),
           (3, "null_ratio", "c3", 0.01, "CASE WHEN c3 > 0.01 THEN 'fail' ELSE 'pass' END"),
           (4, "duplicate_ratio", "c4", 0.05, "CASE WHEN c4 > 0.05 THEN 'fail' ELSE 'pass' END"),
           (5, "max_label_share", "c5", 0.85, "CASE WHEN c5 > 0.85 THEN 'fail' ELSE 'pass' END"),
           (6, "label_classes", "c6", 2.0, "CASE WHEN c6 < 2 THEN 'fail' ELSE 'pass' END"),
           (7, "feedback_mismatch", "c7", 0.1, "CASE WHEN c7 > 0.1 THEN 'fail' ELSE 'pass' END"),
           (8, "freshness_days", "c8", 30.0, "CASE WHEN c8 > 30 THEN 'warn' ELSE 'pass' END"),
           (9, "target_range", "c9", 1.0, "CASE WHEN coalesce(c9, 1.0) < 1 THEN 'fail' ELSE 'pass' END"),
           (10, "score_drift", "c10", 0.2, "CASE WHEN b IS NULL THEN 'info' WHEN c10 > 0.2 THEN 'warn' ELSE 'pass' END")]
_MISSING = "greatest(" + ", ".join(f"avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END)" for c in (
    "id IS NULL", "text IS NULL", "text_hash IS NULL", "model_score IS NULL OR isnan(model_score)", "user_feedback IS NULL", "model_version IS NULL",
    "event_timestamp IS NULL", "target_score IS NULL OR isnan(target_score)", "lang IS NULL")) + ")"
_HARD = " OR ".join("(" + v.replace("CASE WHEN ", "coalesce(").replace(" THEN 'fail' ELSE 'pass' END", ", false)") + ")" for _, _, _, _, v in _LIMITS if "'fail'" in v)
RUNS = with_ctes(FE, DEDUP, CLEAN) + f""",
allrows AS MATERIALIZED (
  SELECT 'raw' AS tab, strftime(event_timestamp, '%Y-%m-%d') AS run, * FROM fe
  UNION ALL SELECT 'clean', strftime(event_timestamp, '%Y-%m-%d'), * FROM clean
  UNION ALL SELECT 'stale', strftime(event_timestamp, '%Y-%m-%d'), * REPLACE (
    CASE WHEN model_version = 'm1' THEN NULL WHEN model_version = 'm2' THEN 0.25 ELSE target_score END::DOUBLE AS target_score) FROM fe),
vg AS (SELECT tab, run, CAST(count(*) AS DOUBLE) AS c2, {_MISSING} AS c3, avg(CASE WHEN {MISMATCH} THEN 1.0 ELSE 0.0 END) AS c7, avg({AGE}) AS c8,
              CAST(min(CASE WHEN {INRANGE} THEN 1 ELSE 0 END) AS DOUBLE) AS c9, avg(CASE WHEN NOT isnan(model_score) THEN model_score END) AS mean_score
       FROM allrows GROUP BY 1, 2),
vd AS (SELECT tab, run, CAST(sum(n) - count(*) AS DOUBLE) / sum(n) AS c4 FROM (SELECT tab, run, text_hash, count(*) AS n FROM allrows GROUP BY 1, 2, 3) x GROUP BY 1, 2),
vl AS (SELECT tab, run, CAST(max(n) AS DOUBLE) / sum(n) AS c5, CAST(count(*) AS DOUBLE) AS c6
       FROM (SELECT tab, run, target_score, count(*) AS n FROM allrows WHERE target_score IS NOT NULL AND NOT isnan(target_score) GROUP BY 1, 2, 3) x GROUP BY 1, 2),
v0 AS (SELECT vg.*, c4, c5, coalesce(c6, 0.0) AS c6 FROM vg JOIN vd USING (tab, run) LEFT JOIN vl USING (tab, run)),
v1 AS (SELECT *, CASE WHEN NOT ({_HARD}) THEN mean_score END AS sound FROM v0),
v2 AS (SELECT *, last_value(sound IGNORE NULLS) OVER (PARTITION BY tab ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM v1),
v3 AS (SELECT *, abs(mean_score - b) AS c10 FROM v2),
vr AS (""" + "\nUNION ALL ".join(
    f"SELECT tab, run, {o} AS ord, '{n}' AS \"check\", {v} AS value, {lim}::DOUBLE AS limit_value, {st} AS status FROM v3" for o, n, v, lim, st in _LIMITS) + """),
vo AS (SELECT *, CASE WHEN ord > coalesce(min(CASE WHEN status = 'fail' THEN ord END) OVER (PARTITION BY tab, run), 99) THEN 'not_run' ELSE status END AS outcome FROM vr)
"""
SQL["validation_runs"] = RUNS + 'SELECT tab AS "table", run, ord, "check", round(value, 6) AS value, limit_value, status, outcome FROM vo'
SQL["run_verdicts"] = RUNS + """SELECT tab AS "table", run, CASE WHEN bool_or(outcome = 'fail') THEN 'failed' WHEN bool_or(outcome = 'warn') THEN 'passed with warnings' ELSE 'passed' END AS verdict,
       arg_min("check", ord) FILTER (WHERE outcome = 'fail') AS first_failure, CAST(count(*) FILTER (WHERE outcome = 'not_run') AS BIGINT) AS checks_not_run
FROM vo GROUP BY tab, run"""

SQL["monitor_panes"] = F_ + """,
pw AS (SELECT *, date_trunc('day', event_timestamp) - to_days(CAST(k AS INTEGER)) AS ws FROM fe, (SELECT unnest(range(0, 3)) AS k) kk),
pr AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY model_score) AS rk, count(*) OVER (PARTITION BY ws) AS sc
       FROM pw WHERE model_score IS NOT NULL AND NOT isnan(model_score)),
pq AS (SELECT ws, round((floor(max(CASE WHEN rk = ceil(0.5 * sc) THEN model_score END) * 1000) + 0.5) / 1000, 6) AS score_p50,
              round((floor(max(CASE WHEN rk = ceil(0.95::DOUBLE * sc) THEN model_score END) * 1000) + 0.5) / 1000, 6) AS score_p95 FROM pr GROUP BY ws),
pm AS (""" + SQL["monitor_sliding"].removeprefix(F_) + """)
SELECT pm.*, score_p50, score_p95 FROM pm LEFT JOIN pq ON pm.window_start = pq.ws"""

_REPORT = SQL["validation_report"].replace(",\nhist AS", ",\nhist0 AS", 1).replace("FROM hist)", "FROM hist0 WHERE false)")  # a first run has no history
SQL["retrain_chain"] = f"""
WITH vrep AS (SELECT * FROM ({_REPORT}) q),
bad AS (SELECT count(*) AS n FROM vrep WHERE status = 'fail'),
cn AS (SELECT count(*) AS n FROM ({SQL["clean_feedback"]}) c),
sz AS (SELECT n, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS nt FROM cn),
sv AS (SELECT n, nt, CAST(floor((n - nt) / 2) AS BIGINT) AS nv FROM sz)
SELECT 'clean' AS step, 'ok' AS status, CAST(n AS BIGINT) AS n_rows FROM cn
UNION ALL SELECT 'validate', CASE WHEN n > 0 THEN 'failed' ELSE 'ok' END, CAST(n AS BIGINT) FROM bad
UNION ALL SELECT 'split.train', 'ok', nt FROM sv, bad WHERE bad.n = 0
UNION ALL SELECT 'split.val', 'ok', nv FROM sv, bad WHERE bad.n = 0
UNION ALL SELECT 'split.test', 'ok', sv.n - nt - nv FROM sv, bad WHERE bad.n = 0
UNION ALL SELECT 'train', 'ok', nt FROM sv, bad WHERE bad.n = 0
UNION ALL SELECT 'evaluate', 'ok', sv.n - nt - nv FROM sv, bad WHERE bad.n = 0
UNION ALL SELECT 'decide', 'promoted', NULL FROM bad WHERE bad.n = 0"""
