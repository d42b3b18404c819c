"""Inputs derived from the given tables, as SQL both engines read.

The given tables hold no user stories or model answers, so these views build
some from every row, in classes that cover the cases an operator tells apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STORIES = """
SELECT c_custkey AS story_id, c_mktsegment AS project, CASE c_custkey % 6
  WHEN 0 THEN CAST(NULL AS STRING)
  WHEN 1 THEN 'As a ' || lower(c_mktsegment) || ' buyer, I want item ' || CAST(c_custkey AS STRING) || ' so that I save time'
  WHEN 2 THEN 'as an  admin,' || chr(10) || 'I want  report ' || CAST(c_custkey AS STRING) || chr(10) || 'so that I can audit'
  WHEN 3 THEN 'I want item ' || CAST(c_custkey AS STRING)
  WHEN 4 THEN 'As a user, I want item ' || CAST(c_custkey AS STRING)
  ELSE '   ' END AS input
FROM customer
"""

TASK_TEXTS = """
SELECT p_partkey AS us_id, p_name AS input, p_brand AS brand, CASE p_partkey % 5
  WHEN 0 THEN 'Here are the tasks:' || chr(10) || '1. summary: Add ' || p_name || chr(10) || 'description: first' || chr(10) || chr(10) || '2. summary: Test ' || p_name || chr(10) || 'description: second'
  WHEN 1 THEN '1) **summary:** Add ' || p_name || chr(10) || 'description: first' || chr(10) || '  a. (Optional) Summary: Sub' || chr(10) || '2) summary: Test' || chr(10) || 'description: second'
  WHEN 2 THEN 'summary: Add ' || p_name || chr(10) || 'description: first' || chr(10) || 'summary: Test' || chr(10) || 'description: second'
  WHEN 3 THEN 'Plan:' || chr(10) || 'a) 4.1. Create ' || p_name || chr(10) || 'b) 4.2. Build it'
  ELSE 'No list for ' || p_name END AS tasks
FROM part
"""

# a second answer per row, of another class, for the two-generator queries
TASK_PAIRS = f"""
SELECT us_id, input, tasks AS tasks_generator_a, CASE us_id % 3
  WHEN 0 THEN '1. **summary**: Plan ' || input || chr(10) || '**description:** one**'
  WHEN 1 THEN 'summary: Plan' || chr(10) || 'description: one' || chr(10) || 'summary: Build' || chr(10) || 'summary: Ship ' || input
  ELSE 'Sure!' || chr(10) || 'a) 1.1. Plan ' || input || chr(10) || 'b) 1.2. Build' || chr(10) || 'c) 1.3. Ship' || chr(10) || 'd) 1.4. Run' END AS tasks_generator_b
FROM ({TASK_TEXTS}) t
"""

# every line of every document becomes a numbered task
DOCUMENT_TASKS = """
SELECT doc_id AS us_id, lang, 'Tasks follow' || chr(10) || '1. summary: ' || replace(text, chr(10), chr(10) || '  2) **summary:** ') AS tasks
FROM documents
"""

PROPS_DAMAGED = """
SELECT event_id, CASE event_id % 6
  WHEN 0 THEN props
  WHEN 1 THEN replace(props, '}', ',}')
  WHEN 2 THEN 'Sure:' || chr(10) || '```json' || chr(10) || props || chr(10) || '```'
  WHEN 3 THEN '{"note": "two' || chr(10) || 'lines", "k": ' || CAST(event_id AS STRING) || '}'
  WHEN 4 THEN replace(props, '}', '')
  ELSE '{"k": 1 "granuylarity": 8}' END AS raw
FROM events
"""

# keys one letter off, exact, two letters off, and twice with the same meaning
PROPS_KEYS = """
SELECT event_id, CASE event_id % 4
  WHEN 0 THEN replace(props, '"k"', '"granuylarity"')
  WHEN 1 THEN replace(props, '"k"', '"format"')
  WHEN 2 THEN replace(props, '"k"', '"coherenz"')
  ELSE '{"formt": 1, "value": "' || event_type || '", "formats": ' || CAST(user_id AS STRING) || '}' END AS raw
FROM events
"""

# keys given more than once: the last value counts
DUPLICATE_KEYS = """
SELECT event_id, CASE event_id % 4
  WHEN 0 THEN '{"zz": 1, "k": ' || CAST(event_id AS STRING) || ', "zz": 2}'
  WHEN 1 THEN '{"format": 1, "formt": 2, "format": 3}'
  WHEN 2 THEN '{"formt": ' || CAST(user_id AS STRING) || ', "x": 0, "formt": 5, "format": 6}'
  ELSE '{"format": 7, "k": 1, "k": ' || CAST(user_id AS STRING) || '}' END AS raw,
  CASE event_id % 4 WHEN 0 THEN 'k,zz' WHEN 1 THEN 'format' WHEN 2 THEN 'format,x' ELSE 'format,k' END AS keys,
  CASE event_id % 4 WHEN 1 THEN '2' WHEN 2 THEN '6' WHEN 3 THEN '7' END AS format,
  CASE event_id % 4 WHEN 0 THEN CAST(event_id AS STRING) WHEN 3 THEN CAST(user_id AS STRING) END AS k
FROM events
"""

PAIR_DUPLICATES = """
SELECT o_orderkey AS us_id, '{"coherence_a": 3, "coherence_b": 1, "coherence_a": ' || CAST(o_custkey % 11 AS STRING)
  || ', "winner": "A", "reason": "first", "winner": "' || CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END || '", "reason": "last"}' AS raw,
  o_custkey % 11 AS score, CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS winner
FROM orders
"""

PAIR_RAW = """
SELECT o_orderkey AS us_id, o_orderpriority AS config, CASE o_orderkey % 6
  WHEN 3 THEN 'not json'
  WHEN 4 THEN '{"coherence_a": 15, "completeness_a": "7.9", "feasibility_a": "bad", "coherence_b": -3, "winner": "b.", "reason": "r"}'
  WHEN 5 THEN 'Answer: {"coherence_a": ' || CAST(o_orderkey % 11 AS STRING) || ', "granularity_b": 6, "winner": "C"} done'
  ELSE '{"coherence_a": ' || CAST(1 + o_orderkey % 10 AS STRING) || ', "completeness_a": 7, "feasibility_a": 8, "format_a": 9, "granularity_a": ' || CAST(1 + o_custkey % 10 AS STRING)
    || ', "coherence_b": 6, "completeness_b": ' || CAST(1 + o_custkey % 10 AS STRING) || ', "feasibility_b": 7, "format_b": 8, "granularity_b": 5, "winner": "' || CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'B' END || '", "reason": "ok"}' END AS raw
FROM orders
"""


def _criterion(name: str, score: str) -> str:
    return f""" '"{name}": {{"puntuacion": ' || {score} || ', "justificacion": "j"}}' """


def _single(*parts: str, end: str = "") -> str:
    body = " || ', ' || ".join(p.strip() for p in parts)
    return f"'{{' || {body} || '{end}}}'"


_KEY = "CAST(1 + o_orderkey % 10 AS STRING)"
_CUST = "CAST(1 + o_custkey % 10 AS STRING)"
_REST = [
    _criterion("completeness", "'7'"),
    _criterion("feasibility", "'8'"),
    _criterion("format", "'9.5'"),
]

SINGLE_RAW = f"""
SELECT o_orderkey AS us_id, o_orderpriority AS config, CASE o_orderkey % 7
  WHEN 0 THEN {_single(_criterion("coherence", _KEY), *_REST, _criterion("granularity", _CUST), end=', "aprobado": true, "problemas_criticos": ["p1", "p2"], "recomendaciones": []')}
  WHEN 1 THEN {_single(_criterion("coherence", _KEY), *_REST, _criterion("granularity", _CUST), end=', "puntuacion_total": 99')}
  WHEN 2 THEN {_single(_criterion("coherence", _KEY), *_REST)}
  WHEN 3 THEN '```json' || chr(10) || {_single(_criterion("coherense", _KEY), *_REST, _criterion("granuylarity", _CUST), end=', "aprobado": false,')} || chr(10) || '```'
  WHEN 4 THEN {_single(_criterion("coherence", "'\"8\"'"), *_REST, _criterion("granularity", _CUST))}
  WHEN 5 THEN {_single(_criterion("coherence", "'0'"), *_REST, _criterion("granularity", _CUST))}
  ELSE 'I cannot judge this.' END AS raw
FROM orders
"""

SINGLE_DUPLICATES = f"""
SELECT o_orderkey AS us_id, {_single(_criterion("coherence", "'1'"), *_REST, _criterion("granularity", _CUST), _criterion("coherence", _KEY), end=', "aprobado": false, "aprobado": true')} AS raw,
  CAST(1 + o_orderkey % 10 AS DOUBLE) AS coherence, CAST(1 + o_orderkey % 10 + 24.5 + 1 + o_custkey % 10 AS DOUBLE) AS total
FROM orders
"""

TIMINGS = """
SELECT o_orderkey AS us_id, o_orderpriority AS config, o_totalprice / 1000 AS generation_time_a,
  CASE WHEN o_orderkey % 9 = 0 THEN CAST(NULL AS DOUBLE) ELSE o_totalprice / 2000 END AS generation_time_b,
  CAST(o_custkey % 13 AS DOUBLE) AS judge_time
FROM orders
"""

# answers whose totals lie close together, and a few calls that failed
PAIR_STEADY = """
SELECT o_orderkey AS us_id, o_orderpriority AS config, CASE WHEN o_orderkey % 97 = 0 THEN CAST(NULL AS STRING) ELSE
  '{"coherence_a": ' || CAST(1 + o_orderkey % 10 AS STRING) || ', "completeness_a": 7, "feasibility_a": 8, "format_a": 9, "granularity_a": ' || CAST(1 + o_custkey % 10 AS STRING)
    || ', "coherence_b": 6, "completeness_b": ' || CAST(1 + o_custkey % 10 AS STRING) || ', "feasibility_b": 7, "format_b": 8, "granularity_b": 5, "winner": "A", "reason": "ok"}' END AS raw
FROM orders
"""

# totals that hardly ever repeat, with some far out and some missing
FRACTIONAL_TOTALS = """
SELECT l_returnflag || l_linestatus AS Config,
  CASE WHEN l_orderkey % 301 = 0 THEN -5.0 ELSE 20.0 + l_extendedprice / 4096.0 END AS judge_score_a_total,
  CASE WHEN l_orderkey % 13 = 0 THEN CAST(NULL AS DOUBLE) WHEN l_partkey % 211 = 0 THEN 50.0 + l_linenumber ELSE 30.0 + l_extendedprice / 65536.0 END AS judge_score_b_total
FROM lineitem
"""

# one planned run per row, settings inside and outside their ranges, some not given
PLANNED_RUNS = """
SELECT o_orderkey AS run_id, o_custkey % 7 - 1 AS batch_size, o_orderkey % 31 / 10.0 - 0.5 AS temperature,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE (o_custkey % 40 - 2) * 100 END AS max_tokens, o_orderkey % 9 AS workers,
  CASE o_custkey % 4 WHEN 0 THEN 35.0 WHEN 1 THEN 50.0 WHEN 2 THEN 50.5 ELSE -1.0 END AS threshold
FROM orders
"""

STRUCTURED = """
SELECT p_partkey AS part_id, CASE WHEN p_partkey % 7 = 0 THEN 'no json' ELSE
  '{"project": "' || p_brand || '", "summary": "' || p_name || '", "description": "As a buyer, I want ' || p_name || ' so that size ' || CAST(p_size AS STRING) || ' fits"}' END AS input
FROM part
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """Run one of the texts above over the given tables."""
    for name in tables:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, STORIES, "customer")


def task_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, TASK_TEXTS, "part")


def task_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, TASK_PAIRS, "part")


def pair_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, PAIR_RAW, "orders")


def single_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, SINGLE_RAW, "orders")
