"""Inputs derived from the driver tables (read-only parquet).

The SQL below runs unchanged on Spark and DuckDB; ``{name}`` placeholders are
filled with DataFrames on Spark (``spark.sql(..., name=df)``) and with the view
names on DuckDB, so the oracle reads exactly the rows the Spark job reads.

* ``posts``  - short texts with mentions, URLs, entities, hashtags, case and
  space variants and conflicting labels (dedup and cleaning).
* ``reviews`` - long multilingual documents with a 0/1 label (features, models).
* ``scored`` - deterministic class probabilities per post (metrics, sweep,
  errors) without a model.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

POSTS_SQL = """
SELECT event_id AS row_id,
  CASE WHEN value > 10.0 THEN 1 ELSE 0 END AS sentiment,
  concat(
    CASE WHEN event_id % 3 = 0 THEN '@user' WHEN event_id % 3 = 1 THEN '@USER' ELSE 'user' END,
    CAST(user_id % 17 AS STRING),
    CASE WHEN event_id % 2 = 0 THEN ' ' ELSE '   ' END,
    CASE WHEN event_id % 5 = 0 THEN concat('#', event_type) ELSE event_type END,
    CASE WHEN event_id % 7 = 0 THEN ' &amp; ' ELSE ' & ' END,
    'caf', chr(233), ' ',
    CASE WHEN event_id % 4 = 0 THEN concat('https://t.co/', CAST(event_id % 11 AS STRING))
         WHEN event_id % 4 = 1 THEN 'www.ex.org'
         ELSE CAST(event_id % 101 AS STRING) END,
    CASE WHEN event_id % 6 = 0 THEN ' !!! ' ELSE '' END) AS text
FROM {events}
"""

REVIEWS_SQL = """
SELECT d.doc_id AS row_id, CAST(l.quality AS INT) AS sentiment, d.text AS text
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id
"""

SCORED_SQL = """
SELECT row_id, sentiment, text, text AS clean_text,
  CAST(1000 - ((row_id * 37) % 700 + 300 * sentiment) AS DOUBLE) / CAST(1000 AS DOUBLE) AS negative_probability,
  CAST((row_id * 37) % 700 + 300 * sentiment AS DOUBLE) / CAST(1000 AS DOUBLE) AS positive_probability
FROM ({posts}) p
"""

# posts with nulls, blanks and labels outside 0 and 1
FLAWED_SQL = """
SELECT event_id AS row_id,
  CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN CAST(2 + event_id % 4 AS INT)
       WHEN value > 10.0 THEN 1 ELSE 0 END AS sentiment,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '  ' WHEN event_id % 19 = 0 THEN ''
       ELSE concat(event_type, ' ', CAST(user_id % 17 AS STRING)) END AS text
FROM {events}
"""

# the real texts, with copies among them; parity stands in for a label
DOCUMENT_POSTS_SQL = """
SELECT doc_id AS row_id, CAST(doc_id % 2 AS INT) AS sentiment, text FROM {documents}
"""

# every document, for operators that need no label
TEXTS_SQL = """
SELECT doc_id AS row_id, text FROM {documents}
"""

TURNS_SQL = """
SELECT conv_id * 1000 + turn AS row_id, CASE WHEN role = 'user' THEN 1 ELSE 0 END AS sentiment, text FROM {conversations}
"""

# texts with quotes, commas and line breaks, for CSV
QUOTED_SQL = """
SELECT event_id AS row_id, CASE WHEN value > 10.0 THEN 1 ELSE 0 END AS sentiment,
  concat(CASE WHEN event_id % 3 = 0 THEN '"' ELSE '' END, event_type, CASE WHEN event_id % 4 = 0 THEN concat(',', chr(10)) ELSE ' ' END,
         props, CASE WHEN event_id % 5 = 0 THEN concat(chr(10), chr(10), '"') ELSE '' END,
         CASE WHEN event_id % 7 = 0 THEN ' ' ELSE '' END) AS text
FROM {events}
"""

# letters whose accent-free form is longer than one character
ACCENTED_SQL = """
SELECT doc_id AS row_id, concat('Caf', chr(233), ' ', substring('ﬀﬁﬂﬃﬄ½¾Ǆ한글㎏', CAST(1 + doc_id % 11 AS INT), 1), 'x ', lang) AS text
FROM {documents}
"""

# two numbers for each post
MEASURED_SQL = """
SELECT row_id, sentiment, CAST(length(text) AS DOUBLE) / CAST(40 AS DOUBLE) AS x1,
  CAST(row_id % 7 AS DOUBLE) / CAST(7 AS DOUBLE) + 0.5 * sentiment AS x2
FROM ({posts}) p
"""

LEADERBOARD_SQL = """
SELECT n.n_name AS experiment_name,
  CASE n.n_regionkey % 3 WHEN 0 THEN 'basic_unigram' WHEN 1 THEN 'unigram_bigram' ELSE 'real_word_char_hybrid' END AS tfidf_variant,
  CAST(count(c.c_custkey) AS DOUBLE) / CAST(100000 AS DOUBLE) AS macro_f1
FROM {nation} n LEFT JOIN {customer} c ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, n.n_regionkey
"""

# one distinct short text per order; the label follows the price, with noise
ORDER_NOTES_SQL = """
SELECT o_orderkey AS row_id,
  CASE WHEN o_totalprice + (o_orderkey * 7919) % 100000 > 300000 THEN 1 ELSE 0 END AS sentiment,
  lower(concat(o_orderpriority, ' order of ', n_name, ' customer ', c_name, ' ', c_mktsegment, ' in month ',
    CAST(month(o_orderdate) AS STRING), ' of ', CAST(year(o_orderdate) AS STRING), ' number ', CAST(o_orderkey AS STRING),
    ' in band ', CAST(CAST(floor(o_totalprice / 20000) AS INT) AS STRING), ' status ', o_orderstatus)) AS clean_text
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spark_sql(spark: SparkSession, sf_dir: str, sql: str, **frames: DataFrame) -> DataFrame:
    for name in set(_PLACEHOLDER.findall(sql)) - set(frames):
        frames[name] = load_table(spark, sf_dir, name)
    return spark.sql(sql, **frames)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, POSTS_SQL)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, REVIEWS_SQL)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, SCORED_SQL, posts=posts(spark, sf_dir))


def flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, FLAWED_SQL)


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, DOCUMENT_POSTS_SQL)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, TEXTS_SQL)


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, TURNS_SQL)


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, LEADERBOARD_SQL)


def quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, QUOTED_SQL)


def accented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, ACCENTED_SQL)


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, MEASURED_SQL, posts=posts(spark, sf_dir))


def order_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, ORDER_NOTES_SQL)


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).select("row_id", "text")


def duck(sql: str) -> str:
    """Fill placeholders for DuckDB: base tables by name, fixtures inline."""
    def fill(match: re.Match) -> str:
        name = match.group(1)
        if name == "posts":
            return duck(POSTS_SQL)
        return name
    return _PLACEHOLDER.sub(fill, sql)


def duck_cte(*names: str) -> str:
    """``WITH posts AS (...), ...`` prefix for oracle queries."""
    bodies = {"leaderboard": LEADERBOARD_SQL, "texts": TEXTS_SQL, "posts": POSTS_SQL, "reviews": REVIEWS_SQL,
              "quoted": QUOTED_SQL, "accented": ACCENTED_SQL, "measured": MEASURED_SQL.replace("({posts}) p", "posts"), "scored": SCORED_SQL.replace("({posts}) p", "posts")}
    parts = [f"{name} AS ({duck(bodies[name]).strip()})" for name in names]
    return "WITH " + ",\n".join(parts) + "\n"
