"""DuckDB oracle SQL for the registered queries (run on the same parquet).

Each statement is the literal, step-by-step definition (the reference's order
of operations), independent of the fused Spark plans it checks.  DuckDB's
regex engine has no look-behind, so the mention rule is written with a
consumed preceding character; ``&amp;`` is the only entity in the fixture.
"""

from __future__ import annotations

from polarity.sources.fixtures import DOCUMENT_POSTS_SQL, FLAWED_SQL, TEXTS_SQL, TURNS_SQL, duck, duck_cte

WS = r"[\s\x{0B}\x{1c}-\x{1f}\x{85}\p{Z}]"


def _clean(col: str) -> str:
    decoded = f"replace({col}, '&amp;', '&')"
    urls = rf"regexp_replace({decoded}, '(?i)(https?://|www\.)[^\s\x{{0B}}\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]+', '<URL>', 'g')"
    mentions = rf"regexp_replace({urls}, '(^|[^\p{{L}}\p{{N}}_])@[A-Za-z0-9_]+', '\1<USER>', 'g')"
    tags = rf"regexp_replace({mentions}, '#([\p{{L}}\p{{N}}_]+)', '\1', 'g')"
    return f"trim(regexp_replace({tags}, '{WS}+', ' ', 'g'))"


def _key(col: str) -> str:
    return f"trim(regexp_replace(lower(replace({col}, '&amp;', '&')), '{WS}+', ' ', 'g'))"


_DEDUP_STEPS = f"""
exact AS (SELECT min(row_id) AS row_id, sentiment, text, count(*) AS n FROM posts GROUP BY text, sentiment),
keyed AS (SELECT row_id, sentiment, text, n, {_key('text')} AS duplicate_key FROM exact),
bad AS (SELECT duplicate_key FROM keyed GROUP BY duplicate_key HAVING count(DISTINCT sentiment) > 1),
kept AS (SELECT * FROM keyed WHERE duplicate_key NOT IN (SELECT duplicate_key FROM bad)),
survivors AS (SELECT row_id, sentiment, text, duplicate_key FROM kept
              WHERE row_id IN (SELECT min(row_id) FROM kept GROUP BY duplicate_key, sentiment)),
cleaned AS (SELECT row_id, sentiment, text, {_clean('text')} AS clean_text FROM survivors),
nonblank AS (SELECT * FROM cleaned WHERE clean_text <> ''),
bad2 AS (SELECT clean_text FROM nonblank GROUP BY clean_text HAVING count(DISTINCT sentiment) > 1),
kept2 AS (SELECT * FROM nonblank WHERE clean_text NOT IN (SELECT clean_text FROM bad2)),
final AS (SELECT row_id, sentiment, text, clean_text FROM kept2
          WHERE row_id IN (SELECT min(row_id) FROM kept2 GROUP BY clean_text, sentiment))
"""


def _with_dedup() -> str:
    return duck_cte("posts").rstrip() + "," + _DEDUP_STEPS


ORACLE: dict[str, str] = {
    "clean_text": duck_cte("posts") + f"SELECT row_id, text, {_clean('text')} AS clean_text FROM posts",
    "duplicate_key": duck_cte("posts") + f"SELECT row_id, {_key('text')} AS duplicate_key FROM posts",
    "exact_dedup": duck_cte("posts") + "SELECT min(row_id) AS row_id, sentiment, text FROM posts GROUP BY text, sentiment",
    "dedup_survivors": _with_dedup() + "SELECT * FROM survivors",
    "label_conflicts": _with_dedup() + """
SELECT row_id, sentiment, text, duplicate_key FROM keyed
WHERE duplicate_key IN (SELECT duplicate_key FROM bad)""",
    "conflicts_removed": duck_cte("posts").rstrip() + f""",
k AS (SELECT row_id, sentiment, text, {_key('text')} AS duplicate_key FROM posts),
b AS (SELECT duplicate_key FROM k GROUP BY duplicate_key HAVING count(DISTINCT sentiment) > 1)
SELECT *, duplicate_key IN (SELECT duplicate_key FROM b) AS conflicting FROM k""",
    "dedup_report": _with_dedup() + """
SELECT CAST((SELECT count(*) FROM posts) AS BIGINT) AS rows_before,
  CAST((SELECT count(*) FROM posts) - (SELECT count(*) FROM exact) AS BIGINT) AS exact_duplicate_rows_removed,
  CAST((SELECT count(*) FROM bad) AS BIGINT) AS conflicting_duplicate_text_groups,
  CAST((SELECT count(*) FROM keyed) - (SELECT count(*) FROM kept) AS BIGINT) AS conflicting_duplicate_rows_removed,
  CAST((SELECT count(*) FROM kept) - (SELECT count(*) FROM survivors) AS BIGINT) AS same_label_duplicate_rows_removed,
  CAST((SELECT count(*) FROM survivors) AS BIGINT) AS rows_after""",
    "preprocess": _with_dedup() + "SELECT * FROM final",
    "cleaning_report": _with_dedup() + """
SELECT CAST((SELECT count(*) FROM posts) AS BIGINT) AS rows_before,
  CAST((SELECT count(*) FROM final) AS BIGINT) AS rows_after,
  CAST((SELECT count(*) FROM cleaned) - (SELECT count(*) FROM nonblank) AS BIGINT) AS empty_clean_text_rows_removed,
  CAST((SELECT count(*) FROM bad2) AS BIGINT) AS conflicting_clean_text_groups,
  CAST((SELECT count(*) FROM nonblank) - (SELECT count(*) FROM kept2) AS BIGINT) AS conflicting_clean_text_rows_removed,
  CAST((SELECT count(*) FROM kept2) - (SELECT count(*) FROM final) AS BIGINT) AS same_label_clean_text_duplicates_removed,
  CAST((SELECT count(*) FROM nonblank) - (SELECT count(*) FROM final) AS BIGINT) AS total_clean_text_duplicates_removed,
  CAST((SELECT count(*) FROM posts) - (SELECT count(*) FROM exact) AS BIGINT) AS exact_duplicate_rows_removed,
  CAST((SELECT count(*) FROM bad) AS BIGINT) AS conflicting_duplicate_text_groups,
  CAST((SELECT count(*) FROM keyed) - (SELECT count(*) FROM kept) AS BIGINT) AS conflicting_duplicate_rows_removed,
  CAST((SELECT count(*) FROM kept) - (SELECT count(*) FROM survivors) AS BIGINT) AS same_label_duplicate_rows_removed,
  CAST((SELECT count(*) FROM survivors) AS BIGINT) AS rows_after_key_dedup""",
}


_BLANK = rf"regexp_full_match(text, '{WS}*')"

_SPLIT_STEPS = """,
hsh AS (SELECT row_id, sentiment, md5('42:' || CAST(row_id AS VARCHAR)) AS h FROM final),
cls AS (SELECT sentiment, count(*) AS n_c FROM hsh GROUP BY sentiment),
s1 AS (SELECT sentiment, n_c,
          CAST(n_c AS DOUBLE) / sum(n_c) OVER () * floor(CAST(0.8 AS DOUBLE) * sum(n_c) OVER ()) AS cont,
          floor(CAST(0.8 AS DOUBLE) * sum(n_c) OVER ()) AS n_draw FROM cls),
s1r AS (SELECT *, row_number() OVER (ORDER BY cont - floor(cont) DESC, sentiment) AS rk,
          n_draw - sum(floor(cont)) OVER () AS need FROM s1),
q1 AS (SELECT sentiment, n_c, CAST(floor(cont) + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS q_train FROM s1r),
s2 AS (SELECT sentiment, q_train,
          CAST(n_c - q_train AS DOUBLE) / sum(n_c - q_train) OVER ()
            * floor((CAST(0.1 AS DOUBLE) / (CAST(0.1 AS DOUBLE) + CAST(0.1 AS DOUBLE))) * sum(n_c - q_train) OVER ()) AS cont,
          floor((CAST(0.1 AS DOUBLE) / (CAST(0.1 AS DOUBLE) + CAST(0.1 AS DOUBLE))) * sum(n_c - q_train) OVER ()) AS n_draw
       FROM q1),
s2r AS (SELECT *, row_number() OVER (ORDER BY cont - floor(cont) DESC, sentiment) AS rk,
          n_draw - sum(floor(cont)) OVER () AS need FROM s2),
q AS (SELECT sentiment, q_train, CAST(floor(cont) + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS q_val FROM s2r),
ranked AS (SELECT row_id, sentiment, row_number() OVER (PARTITION BY sentiment ORDER BY h, row_id) AS pos FROM hsh),
split AS (SELECT r.row_id, r.sentiment, CASE WHEN pos <= q_train THEN 'train'
                 WHEN pos <= q_train + q_val THEN 'validation' ELSE 'test' END AS split
          FROM ranked r JOIN q USING (sentiment))
"""


def _with_split() -> str:
    return _with_dedup().rstrip() + _SPLIT_STEPS


def _histogram(lengths_sql: str, bins: int = 50) -> str:
    def edge(i: str) -> str:
        return f"CASE WHEN {i} >= {bins} THEN last ELSE {i} * ((last - first) / {bins}) + first END"
    return f"""
lens AS ({lengths_sql}),
rng AS (SELECT CAST(CASE WHEN min(len) = max(len) THEN min(len) - 0.5 ELSE min(len) END AS DOUBLE) AS first,
               CAST(CASE WHEN min(len) = max(len) THEN max(len) + 0.5 ELSE max(len) END AS DOUBLE) AS last FROM lens),
b0 AS (SELECT len, first, last, CAST(floor(((len - first) / (last - first)) * {bins}) AS INTEGER) AS raw FROM lens, rng),
b1 AS (SELECT len, first, last, CASE WHEN raw = {bins} THEN {bins - 1} ELSE raw END AS i0 FROM b0),
b2 AS (SELECT len, first, last, CASE WHEN len < {edge('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM b1),
b3 AS (SELECT CASE WHEN len >= {edge('(i1 + 1)')} AND i1 <> {bins - 1} THEN i1 + 1 ELSE i1 END AS bin FROM b2),
grid AS (SELECT CAST(range AS INTEGER) AS bin, first, last FROM range({bins}), rng)
SELECT g.bin,
  CASE WHEN g.bin >= {bins} THEN g.last ELSE g.bin * ((g.last - g.first) / {bins}) + g.first END AS bin_start,
  CASE WHEN g.bin + 1 >= {bins} THEN g.last ELSE (g.bin + 1) * ((g.last - g.first) / {bins}) + g.first END AS bin_end,
  CAST(count(b3.bin) AS BIGINT) AS count
FROM grid g LEFT JOIN b3 ON g.bin = b3.bin
GROUP BY g.bin, g.first, g.last"""


ORACLE.update({
    "validation_checks": duck_cte("posts") + f"""
SELECT CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count_if(text IS NULL) AS BIGINT) AS missing_text,
  CAST(count_if(sentiment IS NULL) AS BIGINT) AS missing_label,
  CAST(count_if(sentiment IS NOT NULL AND sentiment NOT IN (0, 1)) AS BIGINT) AS invalid_label_rows,
  CAST(count_if({_BLANK}) AS BIGINT) AS empty_text_rows
FROM posts""",
    "profile": duck_cte("posts") + f"""
SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(2 AS BIGINT) AS total_columns,
  CAST(count_if(text IS NULL) AS BIGINT) AS missing_text,
  CAST(count_if(sentiment IS NULL) AS BIGINT) AS missing_label,
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT sentiment, text FROM posts)) AS BIGINT) AS duplicate_exact_rows,
  CAST(count_if({_BLANK}) AS BIGINT) AS empty_text_rows,
  avg(length(text)) AS average_text_length,
  CAST(quantile_cont(length(text), 0.5) AS DOUBLE) AS median_text_length,
  CAST(max(length(text)) AS BIGINT) AS max_text_length
FROM posts""",
    "label_distribution": duck_cte("posts") + "SELECT sentiment, CAST(count(*) AS BIGINT) AS count FROM posts GROUP BY sentiment",
    "length_histogram": duck_cte("posts").rstrip() + "," + _histogram(
        "SELECT length(text) AS len FROM posts WHERE text IS NOT NULL"),
    "stratified_split": _with_split() + "SELECT row_id, sentiment, split FROM split",
    "split_report": _with_split() + "SELECT split, sentiment, CAST(count(*) AS BIGINT) AS rows FROM split GROUP BY split, sentiment",
    "split_leakage": _with_split() + """
SELECT CAST(count(*) AS BIGINT) AS overlapping_clean_texts FROM (
  SELECT f.clean_text FROM split s JOIN final f USING (row_id)
  GROUP BY f.clean_text HAVING min(s.split) <> max(s.split))""",
    "class_weights": _with_split() + """
SELECT sentiment, CAST(count(*) AS BIGINT) AS count,
  CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight
FROM split WHERE split = 'train' GROUP BY sentiment""",
})



def _div(a: str, b: str) -> str:
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"


def _metric_sql(tn="tn", fp="fp", fn="fn", tp="tp") -> dict[str, str]:
    sup0, sup1 = f"({tn} + {fp})", f"({fn} + {tp})"
    pred0, pred1 = f"({tn} + {fn})", f"({fp} + {tp})"
    n = f"({sup0} + {sup1})"
    p0, p1 = _div(tn, pred0), _div(tp, pred1)
    r0, r1 = _div(tn, sup0), _div(tp, sup1)
    f0, f1 = _div(f"2 * {tn}", f"{sup0} + {pred0}"), _div(f"2 * {tp}", f"{sup1} + {pred1}")
    pr0 = f"CAST(({sup0} > 0 OR {pred0} > 0) AS INTEGER)"
    pr1 = f"CAST(({sup1} > 0 OR {pred1} > 0) AS INTEGER)"

    def macro(a, b):
        return _div(f"{a} * {pr0} + {b} * {pr1}", f"{pr0} + {pr1}")

    def weighted(a, b):
        return _div(f"{a} * {sup0} + {b} * {sup1}", n)

    return {
        "accuracy": _div(f"{tn} + {tp}", n),
        "macro_precision": macro(p0, p1), "macro_recall": macro(r0, r1), "macro_f1": macro(f0, f1),
        "weighted_precision": weighted(p0, p1), "weighted_recall": weighted(r0, r1),
        "weighted_f1": weighted(f0, f1),
        "negative_precision": p0, "negative_recall": r0, "negative_f1": f0,
        "positive_precision": p1, "positive_recall": r1, "positive_f1": f1,
    }


_PRED = "CASE WHEN positive_probability > negative_probability THEN 1 ELSE 0 END"


def _counts_sql(pred: str) -> str:
    return f"""counts AS (SELECT
  count_if(sentiment = 0 AND {pred} = 0) AS tn, count_if(sentiment = 0 AND {pred} = 1) AS fp,
  count_if(sentiment = 1 AND {pred} = 0) AS fn, count_if(sentiment = 1 AND {pred} = 1) AS tp FROM scored)
"""


def _metrics_select(threshold: str = "NULL") -> str:
    m = _metric_sql()
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in m.items())
    return (f"SELECT CAST({threshold} AS DOUBLE) AS decision_threshold,\n  {cols},\n"
            "  CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
            "CAST(tp AS BIGINT) AS tp FROM counts")


def _sweep_sql() -> str:
    m = _metric_sql()
    keep = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1", "negative_f1", "positive_f1"]
    cols = ",\n  ".join(f"{m[k]} AS {k}" for k in keep)
    return f"""grid AS (SELECT CAST(round(0.30 + 0.01 * range, 2) AS DOUBLE) AS threshold FROM range(41)),
sweep_counts AS (SELECT g.threshold,
    count_if(s.sentiment = 0 AND NOT (s.positive_probability >= g.threshold)) AS tn,
    count_if(s.sentiment = 0 AND s.positive_probability >= g.threshold) AS fp,
    count_if(s.sentiment = 1 AND NOT (s.positive_probability >= g.threshold)) AS fn,
    count_if(s.sentiment = 1 AND s.positive_probability >= g.threshold) AS tp
  FROM grid g CROSS JOIN scored s GROUP BY g.threshold),
sweep AS (SELECT threshold,
  {cols},
  CAST(fp AS BIGINT) AS false_positives, CAST(fn AS BIGINT) AS false_negatives FROM sweep_counts)
"""


def _errors_sql() -> str:
    return rf"""errors AS (SELECT row_id, text, clean_text, sentiment AS actual_sentiment, {_PRED} AS predicted_sentiment,
    CASE WHEN sentiment = 0 AND {_PRED} = 1 THEN 'false_positive' ELSE 'false_negative' END AS error_type,
    greatest(negative_probability, positive_probability) AS confidence,
    negative_probability, positive_probability,
    CAST(length(clean_text) AS BIGINT) AS text_length,
    CAST(len(regexp_extract_all(clean_text, '[^\s\x{{0B}}\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]+')) AS BIGINT) AS word_count
  FROM scored WHERE sentiment <> {_PRED})
"""


_S = duck_cte("posts", "scored")

ORACLE.update({
    "confusion_matrix": _S.rstrip() + ",\n" + _counts_sql(_PRED) + """
SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual_sentiment, predicted_sentiment),
LATERAL (SELECT CAST(CASE WHEN v.actual_sentiment = 0 AND v.predicted_sentiment = 0 THEN tn
                          WHEN v.actual_sentiment = 0 THEN fp
                          WHEN v.predicted_sentiment = 0 THEN fn ELSE tp END AS BIGINT) AS count FROM counts)""",
    "metrics": _S.rstrip() + ",\n" + _counts_sql(_PRED) + _metrics_select(),
    "tuned_metrics": _S.rstrip() + ",\n" + _counts_sql(
        "CASE WHEN positive_probability >= 0.47 THEN 1 ELSE 0 END") + _metrics_select("0.47"),
    "classification_report": _S.rstrip() + ",\n" + _counts_sql(_PRED) + ", m AS (" + _metrics_select() + """)
SELECT 'negative' AS label, negative_precision AS precision, negative_recall AS recall, negative_f1 AS f1_score,
       CAST(tn + fp AS BIGINT) AS support FROM m
UNION ALL SELECT 'positive', positive_precision, positive_recall, positive_f1, CAST(fn + tp AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, accuracy, CAST(tn + fp + fn + tp AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', (negative_precision + positive_precision) / 2, (negative_recall + positive_recall) / 2,
       (negative_f1 + positive_f1) / 2, CAST(tn + fp + fn + tp AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg',
  (negative_precision * (tn + fp) + positive_precision * (fn + tp)) / (tn + fp + fn + tp),
  (negative_recall * (tn + fp) + positive_recall * (fn + tp)) / (tn + fp + fn + tp),
  (negative_f1 * (tn + fp) + positive_f1 * (fn + tp)) / (tn + fp + fn + tp),
  CAST(tn + fp + fn + tp AS BIGINT) FROM m""",
    "quality_gate": _S.rstrip() + ",\n" + _counts_sql(_PRED) + ", m AS (" + _metrics_select() + """)
SELECT accuracy, macro_f1, (accuracy < 0.75 OR macro_f1 < 0.75) AS below_quality_gate FROM m""",
    "threshold_sweep": _S.rstrip() + ",\n" + _sweep_sql() + "SELECT * FROM sweep",
    "best_threshold": _S.rstrip() + ",\n" + _sweep_sql() + "SELECT * FROM sweep ORDER BY macro_f1 DESC, threshold LIMIT 1",
    "default_threshold_row": _S.rstrip() + ",\n" + _sweep_sql() + "SELECT * FROM sweep WHERE round(threshold, 2) = 0.5",
    "error_table": _S.rstrip() + ",\n" + _errors_sql() + "SELECT * FROM errors",
    "top_errors": _S.rstrip() + ",\n" + _errors_sql() + "SELECT * FROM errors ORDER BY confidence DESC, row_id LIMIT 100",
    "error_summary": _S.rstrip() + f""",
e AS (SELECT count(*) AS total_rows, count_if(sentiment <> {_PRED}) AS total_errors,
             count_if(sentiment = 0 AND {_PRED} = 1) AS false_positives,
             count_if(sentiment <> {_PRED} AND NOT (sentiment = 0 AND {_PRED} = 1)) AS false_negatives FROM scored)
SELECT CAST(total_rows AS BIGINT) AS total_rows, CAST(total_errors AS BIGINT) AS total_errors,
  CAST(false_positives AS BIGINT) AS false_positives, CAST(false_negatives AS BIGINT) AS false_negatives,
  {_div('total_errors', 'total_rows')} AS error_rate FROM e""",
})


_R = duck_cte("texts")
_TOKENS = r"regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}_]{2,}')"
_WORD12_TERMS = f"""word_terms AS (
  SELECT row_id, term, count(*) AS tf FROM (
    SELECT row_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
    FROM (SELECT row_id, {_TOKENS} AS t FROM texts))
  GROUP BY row_id, term)
"""
_CHAR35_TERMS = r"""char_terms AS (
  SELECT row_id, term, count(*) AS tf FROM (
    SELECT row_id, unnest(flatten(list_transform(range(3, 6), lambda n:
        CASE WHEN n < L THEN list_transform(range(1, L - n + 2), lambda i: substring(p, i, n))
             WHEN n = greatest(3, L) THEN [p] ELSE [] END))) AS term
    FROM (SELECT row_id, ' ' || w || ' ' AS p, length(' ' || w || ' ') AS L
          FROM (SELECT row_id, unnest(regexp_extract_all(lower(text), '[^\s\x{0B}\x{1c}-\x{1f}\x{85}\p{Z}]+')) AS w
                FROM texts)))
  GROUP BY row_id, term)
"""


def _tfidf_sql(terms: str, min_df: int, max_df: float, max_features: int | str) -> str:
    return f"""ndocs AS (SELECT count(*) AS n FROM texts),
dfreq AS (SELECT term, count(*) AS df, sum(tf) AS tf_total FROM {terms} GROUP BY term),
vocab AS (SELECT term, CAST(df AS BIGINT) AS df, CAST(tf_total AS BIGINT) AS tf_total,
                 ln((1 + CAST(n AS DOUBLE)) / (1 + CAST(df AS DOUBLE))) + 1 AS idf
          FROM dfreq, ndocs WHERE df >= {min_df} AND df <= CAST({max_df} AS DOUBLE) * n
          ORDER BY tf_total DESC, term LIMIT {max_features}),
w AS (SELECT t.row_id, t.term, t.tf * v.idf AS w FROM {terms} t JOIN vocab v USING (term))
"""


ORACLE.update({
    "word_tokens": _R + f"SELECT row_id, array_to_string({_TOKENS}, ' ') AS tokens FROM texts",
    "word_ngrams": _R.rstrip() + ",\n" + _WORD12_TERMS + "SELECT row_id, term, CAST(tf AS BIGINT) AS tf FROM word_terms",
    "char_ngrams": _R.rstrip() + ",\n" + _CHAR35_TERMS + "SELECT row_id, term, CAST(tf AS BIGINT) AS tf FROM char_terms",
    "document_frequency": _R.rstrip() + ",\n" + _WORD12_TERMS + """
SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS tf_total FROM word_terms GROUP BY term""",
    "vocabulary": _R.rstrip() + ",\n" + _WORD12_TERMS + "," + _tfidf_sql("word_terms", 2, 0.95, 50000)
        + "SELECT term, df, tf_total, round(idf, 6) AS idf FROM vocab",
    "tfidf_long": _R.rstrip() + ",\n" + _WORD12_TERMS + "," + _tfidf_sql("word_terms", 2, 0.95, 50000)
        + "SELECT row_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 6) AS tfidf FROM w",
    "tfidf_all_terms": _R.rstrip() + ",\n" + _WORD12_TERMS + "," + _tfidf_sql("word_terms", 1, 1.0, "ALL")
        + "SELECT row_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 6) AS tfidf FROM w",
    "char_tfidf_long": _R.rstrip() + ",\n" + _CHAR35_TERMS + "," + _tfidf_sql("char_terms", 2, 0.95, 30000)
        + "SELECT row_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 6) AS tfidf FROM w",
})


ORACLE["vocabulary_pruned"] = ORACLE["vocabulary"]
ORACLE["guarded_input"] = _R + f"""
SELECT row_id,
  NOT (text IS NULL OR regexp_full_match(text, '{WS}*') OR length(text) > 1000) AS accepted,
  CASE WHEN text IS NULL OR regexp_full_match(text, '{WS}*') THEN 'empty_text'
       WHEN length(text) > 1000 THEN 'text_too_long' END AS rejection_reason
FROM texts"""


ORACLE.update({
    "regression_gate": _S.rstrip() + ",\n" + _counts_sql(_PRED) + ", base AS (" + _metrics_select() + "),\n"
        + _counts_sql("CASE WHEN positive_probability >= 0.47 THEN 1 ELSE 0 END").replace("counts AS", "tcounts AS")
        + ", cand AS (" + _metrics_select("0.47").replace("FROM counts", "FROM tcounts") + """)
SELECT c.macro_f1 AS candidate_macro_f1, b.macro_f1 AS baseline_macro_f1,
       COALESCE(c.macro_f1 < b.macro_f1, false) AS below_baseline
FROM cand c, base b""",
    "invalid_labels": duck_cte("posts") + "SELECT DISTINCT sentiment FROM posts WHERE sentiment IS NOT NULL AND sentiment NOT IN (0, 1)",
    "review_length_histogram": _R.rstrip() + "," + _histogram("SELECT length(text) AS len FROM texts WHERE text IS NOT NULL"),
})


# --- rows that the checks must find, and real texts ---------------------------------

def _over(sql: str, fixture: str) -> str:
    """An oracle written for ``posts``, over another fixture of that shape."""
    own = duck_cte("posts").rstrip()
    assert sql.startswith(own)
    return f"WITH posts AS ({duck(fixture).strip()})" + sql[len(own):]


ORACLE.update({
    "flawed_validation": _over(ORACLE["validation_checks"], FLAWED_SQL),
    "flawed_profile": _over(ORACLE["profile"], FLAWED_SQL),
    "flawed_labels": _over(ORACLE["invalid_labels"], FLAWED_SQL),
    "document_survivors": _over(ORACLE["dedup_survivors"], DOCUMENT_POSTS_SQL),
    "document_conflicts": _over(ORACLE["label_conflicts"], DOCUMENT_POSTS_SQL),
    "document_cleaning_report": _over(ORACLE["cleaning_report"], DOCUMENT_POSTS_SQL),
    "document_profile": _over(ORACLE["profile"], DOCUMENT_POSTS_SQL),
    "turn_dedup": _over(ORACLE["preprocess"], TURNS_SQL),
    # the entities of the pages, with and without the closing semicolon
    "page_entities": """
WITH p AS (SELECT page_id, html, replace(replace(replace(replace(replace(replace(html, '&copy;', chr(169)), '&middot;', chr(183)),
  '&quot;', '"'), '&amp;', chr(1)), '&amp', '&'), chr(1), '&') AS d FROM pages)
SELECT page_id, md5(d) AS decoded_md5, d <> html AS changed FROM p""",
    "leaderboard": duck_cte("leaderboard") + "SELECT * FROM leaderboard",
    "leaderboard_best": duck_cte("leaderboard") + "SELECT * FROM leaderboard ORDER BY macro_f1 DESC, experiment_name LIMIT 1",
    "leaderboard_variants": duck_cte("leaderboard").rstrip() + """,
best AS (SELECT tfidf_variant, max(macro_f1) AS best_macro_f1 FROM leaderboard GROUP BY tfidf_variant)
SELECT *, (SELECT best_macro_f1 FROM best WHERE tfidf_variant = 'real_word_char_hybrid')
        - (SELECT best_macro_f1 FROM best WHERE tfidf_variant = 'unigram_bigram') AS real_word_char_hybrid_minus_unigram_bigram
FROM best""",
})


# --- complement naive Bayes ----------------------------------------------------------

def _unigrams(name: str, source: str) -> str:
    return f"""{name}_t AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest({_TOKENS}) AS term FROM {source})
  GROUP BY row_id, term)"""


def _weights(name: str) -> str:
    """L2-normed tf * idf of the terms that the vocabulary holds."""
    return f"""{name}_w AS (SELECT t.row_id, t.term, t.tf * v.idf AS w FROM {name}_t t JOIN vocab v USING (term)),
{name}_x AS (SELECT row_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY row_id)) AS x FROM {name}_w)"""


_BAYES = _with_split().rstrip() + f""",
train AS (SELECT f.row_id, f.sentiment, f.clean_text AS text FROM final f JOIN split s USING (row_id) WHERE s.split = 'train'),
{_unigrams('train', 'train')},
vocab AS (SELECT term, ln((1 + n) / (1 + CAST(df AS DOUBLE))) + 1 AS idf FROM (
    SELECT term, count(*) AS df, sum(tf) AS tf_total FROM train_t GROUP BY term),
    (SELECT CAST(count(*) AS DOUBLE) AS n FROM train)
  WHERE df >= 2 AND df <= CAST(0.95 AS DOUBLE) * n ORDER BY tf_total DESC, term LIMIT 30000),
{_weights('train')},
sums AS (SELECT v.term, coalesce(sum(x) FILTER (sentiment = 1), 0.0) AS s1, coalesce(sum(x) FILTER (sentiment = 0), 0.0) AS s0
  FROM vocab v LEFT JOIN train_x USING (term) LEFT JOIN train USING (row_id) GROUP BY v.term),
-- the parameters of a class come from the rows of the other one
theta AS (SELECT term, ln(s1 + 1) - ln(sum(s1) OVER () + count(*) OVER ()) AS theta_0,
                 ln(s0 + 1) - ln(sum(s0) OVER () + count(*) OVER ()) AS theta_1 FROM sums)"""


def _bayes_scores(source: str) -> str:
    """p: positive probability of each row of ``source`` (row_id, text = clean text)."""
    return _BAYES + f""",
{_unigrams('own', source)},
{_weights('own')},
z AS (SELECT row_id, sum(x * theta_1) - sum(x * theta_0) AS d FROM own_x JOIN theta USING (term) GROUP BY row_id),
p AS (SELECT s.row_id, 1 / (1 + exp(coalesce(d, 0.0))) AS p1, 1 - 1 / (1 + exp(coalesce(d, 0.0))) AS p0
      FROM {source} s LEFT JOIN z USING (row_id))"""


_UNLABELLED = f"(SELECT row_id, {_clean('text')} AS text FROM posts)"
_PREDICTED = """CAST(CASE WHEN p1 >= 0.47 THEN 1 ELSE 0 END AS INTEGER) AS predicted_label,
  CASE WHEN p1 >= 0.47 THEN 'positive' ELSE 'negative' END AS predicted_sentiment"""
_PROBABILITIES = "round(p0, 6) AS negative_probability, round(p1, 6) AS positive_probability"
_BATCH = f"""
SELECT row_id, text, {_clean('text')} AS cleaned_text, {_PREDICTED}, CAST(0.47 AS DOUBLE) AS decision_threshold,
  {_PROBABILITIES} FROM posts JOIN p USING (row_id)"""

ORACLE.update({
    "bayes_fit": _BAYES + "\nSELECT term, round(-theta_0, 6) AS theta_0, round(-theta_1, 6) AS theta_1 FROM theta",
    "bayes_score_batch": _bayes_scores(_UNLABELLED) + _BATCH,
    "bayes_evaluation": _bayes_scores("(SELECT row_id, clean_text AS text FROM final)") + f"""
SELECT f.row_id, f.text, f.clean_text, CAST(f.sentiment AS INTEGER) AS actual_sentiment,
  CAST(CASE WHEN p1 > p0 THEN 1 ELSE 0 END AS INTEGER) AS predicted_sentiment, {_PROBABILITIES}
FROM final f JOIN p USING (row_id) JOIN split s USING (row_id) WHERE s.split = 'test'""",
    "bayes_log": _bayes_scores(_UNLABELLED) + f"""
SELECT md5('request:' || CAST(row_id AS VARCHAR)) AS request_id, {_PREDICTED}, {_PROBABILITIES},
  CAST(0.47 AS DOUBLE) AS threshold, CAST(length({_clean('text')}) AS BIGINT) AS text_length FROM posts JOIN p USING (row_id)""",
    "bayes_score_stream": _bayes_scores(_UNLABELLED)
        + _BATCH.replace("SELECT row_id,", "SELECT md5('request:' || CAST(row_id AS VARCHAR)) AS request_id, row_id,"),
})
_TEXTS = duck(TEXTS_SQL)
ORACLE["bayes_score_guarded"] = _bayes_scores(f"(SELECT row_id, {_clean('text')} AS text FROM ({_TEXTS}))") + f""",
g AS (SELECT *, CASE WHEN text IS NULL OR regexp_full_match(text, '{WS}*') THEN 'empty_text'
                     WHEN length(text) > 1000 THEN 'text_too_long' END AS why FROM ({_TEXTS}))
SELECT row_id, why IS NULL AS accepted, why AS rejection_reason, text,
  CASE WHEN why IS NULL THEN {_clean('text')} END AS cleaned_text,
  CASE WHEN why IS NULL THEN predicted_label END AS predicted_label,
  CASE WHEN why IS NULL THEN predicted_sentiment END AS predicted_sentiment, CAST(0.47 AS DOUBLE) AS decision_threshold,
  CASE WHEN why IS NULL THEN negative_probability END AS negative_probability,
  CASE WHEN why IS NULL THEN positive_probability END AS positive_probability
FROM g JOIN (SELECT row_id, {_PREDICTED}, {_PROBABILITIES} FROM p) USING (row_id)"""


# --- files, streams, the whole job ---------------------------------------------------

def _newton(model: str, loss: str, penalty: str, scale: str, free: bool, steps: int = 12) -> str:
    """Full Newton steps for (w1, w2, intercept), one CTE a step, by Cramer's rule."""
    first = {"logistic": "-1 / (1 + exp(m))", "squared_hinge": "-2 * greatest(1 - m, 0)"}[loss]
    second = {"logistic": "1 / (2 + exp(m) + exp(-m))", "squared_hinge": "CASE WHEN m < 1 THEN 2 ELSE 0 END"}[loss]
    ridge0 = "0" if free else penalty
    out = [f"{model}_0 AS (SELECT CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS c)"]
    for i in range(steps):
        out.append(f"""{model}_m{i} AS (SELECT r.*, {scale} * weight AS k, sign * (a * x1 + b * x2 + c) AS m FROM rows_ r, {model}_{i}),
{model}_s{i} AS (SELECT sum(k * sign * ({first}) * x1) AS g1, sum(k * sign * ({first}) * x2) AS g2, sum(k * sign * ({first})) AS g3,
  sum(k * ({second}) * x1 * x1) + {penalty} AS h11, sum(k * ({second}) * x1 * x2) AS h12, sum(k * ({second}) * x1) AS h13,
  sum(k * ({second}) * x2 * x2) + {penalty} AS h22, sum(k * ({second}) * x2) AS h23, sum(k * ({second})) + {ridge0} AS h33 FROM {model}_m{i}),
{model}_g{i} AS (SELECT a, b, c, g1 + {penalty} * a AS p, g2 + {penalty} * b AS q, g3 + {ridge0} * c AS r, s.*,
  h11 * (h22 * h33 - h23 * h23) - h12 * (h12 * h33 - h23 * h13) + h13 * (h12 * h23 - h22 * h13) AS det
  FROM {model}_s{i} s, {model}_{i}),
{model}_{i + 1} AS MATERIALIZED (SELECT
  a - (p * (h22 * h33 - h23 * h23) - h12 * (q * h33 - h23 * r) + h13 * (q * h23 - h22 * r)) / det AS a,
  b - (h11 * (q * h33 - h23 * r) - p * (h12 * h33 - h23 * h13) + h13 * (h12 * r - q * h13)) / det AS b,
  c - (h11 * (h22 * r - q * h23) - h12 * (h12 * r - q * h13) + p * (h12 * h23 - h22 * h13)) / det AS c FROM {model}_g{i})""")
    return ",\n".join(out)


_FITS = (duck_cte("posts", "measured").rstrip() + """,
sizes AS (SELECT sentiment, CAST(count(*) AS DOUBLE) AS n_c FROM measured GROUP BY sentiment),
rows_ AS MATERIALIZED (SELECT x1, x2, CASE WHEN sentiment = 1 THEN 1.0 ELSE -1.0 END AS sign,
  (SELECT sum(n_c) FROM sizes) / ((SELECT count(*) FROM sizes) * n_c) AS weight FROM measured JOIN sizes USING (sentiment)),
""" + ",\n".join([
    _newton("logistic_regression", "logistic", "1", "1", False),
    _newton("linear_svc", "squared_hinge", "1", "1", False),
    _newton("sgd_classifier", "logistic", "0.0001", "(1 / (SELECT CAST(count(*) AS DOUBLE) FROM measured))", True)]))

ORACLE.update({
    "csv_round_trip": duck_cte("quoted") + "SELECT CAST(sentiment AS INTEGER) AS sentiment, text FROM quoted",
    "bayes_score_csv": _bayes_scores(_UNLABELLED) + _BATCH.replace("SELECT row_id, text", "SELECT text"),
    "bayes_log_sink": ORACLE["bayes_log"],
    "accent_stripping": duck_cte("accented") + """
SELECT doc_id AS row_id, concat('cafe ', ['ff', 'fi', 'fl', 'ffi', 'ffl', '1⁄2', '3⁄4', 'dz', chr(4370) || chr(4449) || chr(4523),
  chr(4352) || chr(4467) || chr(4527), 'kg'][1 + doc_id % 11], 'x ', lower(lang)) AS stripped FROM documents""",
    "linear_fits": _FITS + "".join(
        f"{' UNION ALL' if i else ''} SELECT '{m}' AS model, round(a, 6) AS w1, round(b, 6) AS w2, round(c, 6) AS intercept FROM {m}_12"
        for i, m in enumerate(("logistic_regression", "linear_svc", "sgd_classifier"))),
    "full_job": _bayes_scores("(SELECT row_id, clean_text AS text FROM final)") + """,
parts AS (SELECT f.row_id, f.sentiment, p1 AS positive_probability, p0 AS negative_probability, s.split
  FROM final f JOIN p USING (row_id) JOIN split s USING (row_id)),
scored AS (SELECT * FROM parts WHERE split = 'validation'),
""" + _sweep_sql() + """, best AS (SELECT threshold FROM sweep ORDER BY macro_f1 DESC, threshold LIMIT 1),
tested AS (SELECT sentiment, CASE WHEN positive_probability >= threshold THEN 1 ELSE 0 END AS pred FROM parts, best WHERE split = 'test'),
counts AS (SELECT count_if(sentiment = 0 AND pred = 0) AS tn, count_if(sentiment = 0 AND pred = 1) AS fp,
  count_if(sentiment = 1 AND pred = 0) AS fn, count_if(sentiment = 1 AND pred = 1) AS tp FROM tested)
""" + _metrics_select("(SELECT threshold FROM best)"),
})
