"""The same results in plain SQL, written independently of the Spark operators."""

from __future__ import annotations

from queries import inputs
from specflow.functions.prompts import (
    JUDGE_TEMPLATE,
    PAIR_TEMPLATE,
    TASK_TEMPLATE,
    retry_note,
)

CRITERIA = ("coherence", "completeness", "feasibility", "format", "granularity")
SPANISH = ("coherencia", "completitud", "viabilidad", "formato", "granularidad")
WS = r"[\t-\r\x1c-\x1f \x85\p{Z}]"
MARK = r"(?:\p{Nd}+\.|\p{Nd}+\)|[a-z]\)|[a-z]\.)"
SUMMARY = rf"\*{{0,2}}[Ss]ummary{WS}*\*{{0,2}}{WS}*:"
NOTE = rf"(?:\([^)]*\){WS}*)?"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def is_story(x: str, flags: str = "i") -> str:
    pattern = r"^As\s+an?\s+(.+?),\s+I\s+want\s+(.+?)\s+so\s+that\s+(.+)$"
    return f"coalesce(regexp_matches({squeeze(x)}, '{pattern}', '{flags}'), false)"


# --- tasks ------------------------------------------------------------------


def pieces(x: str, pattern: str) -> str:
    cut = f"string_split(regexp_replace({x}, '\\n({pattern})', chr(1) || '\\1', 'g'), chr(1))"
    return f"list_filter(list_transform({cut}, lambda p: {strip('p')}), lambda p: p <> '')"


def no_preamble(x: str, pattern: str, flags: str = "c") -> str:
    return (
        f"CASE WHEN len({x}) > 0 AND NOT regexp_matches({x}[1], '{pattern}', '{flags}') "
        f"THEN {x}[2:] ELSE {x} END"
    )


def clean(x: str, strict: bool = False) -> str:
    x = strip(x)
    prefixes = [
        rf"^\p{{Nd}}+\.{WS}+",
        rf"^\p{{Nd}}+\){WS}+",
        rf"^[a-z]\){WS}+",
        rf"^[a-z]\.{WS}+",
        rf"^\p{{Nd}}+\.\p{{Nd}}+(\.\p{{Nd}}+)*{WS}+",
    ]
    if strict:
        prefixes.append(rf"^\p{{Nd}}+\.\p{{Nd}}+(\.\p{{Nd}}+)*\.?{WS}+")
    for p in prefixes:
        x = f"regexp_replace({x}, '{p}', '')"
    if strict:
        p = r"^(\p{Nd}+|[a-z])[.)](\*{0,2}[Ss]ummary)"
        x = f"regexp_replace({x}, '{p}', '\\2')"
    for label in ("(summary|Summary)", "(description|Description)"):
        for p in (rf"\*\*{label}\*\*{WS}*:", rf"\*\*{label}{WS}*:{WS}*\*\*", rf"\*\*{label}{WS}*:"):
            x = f"regexp_replace({x}, '{p}', '\\1:', 'g')"
    return f"regexp_replace({x}, '(?m)\\*\\*{WS}*$', '', 'g')"


def split_ctes(source: str, column: str = "tasks", name: str = "listed") -> str:
    """CTEs ending in ``name``: the source's columns plus ``task_list``."""
    first = rf"{WS}*{MARK}{WS}*{NOTE}{SUMMARY}"
    start = rf"^{WS}*{MARK}?{WS}*{NOTE}{SUMMARY}"
    third = rf"{WS}*[a-z]\){WS}+\p{{Nd}}+\.\p{{Nd}}+\.{WS}+"
    return f"""
{name}_0 AS (SELECT *, {strip(column)} AS s FROM {source}),
{name}_1 AS (SELECT *, {pieces('s', first)} AS q1, {pieces('s', SUMMARY)} AS q2, {pieces('s', third)} AS q3 FROM {name}_0),
{name}_2 AS (SELECT * REPLACE ({no_preamble('q1', start, 'i')} AS q1, {no_preamble('q2', '^' + SUMMARY)} AS q2,
   {no_preamble('q3', rf'^([a-z]\)|(summary|Summary){WS}*:)')} AS q3) FROM {name}_1),
{name} AS (SELECT * EXCLUDE (s, q1, q2, q3), CASE WHEN s IS NULL THEN [NULL] WHEN len(q1) >= 2 THEN q1 WHEN len(q2) >= 2 THEN q2
   WHEN len(q3) >= 2 THEN q3 WHEN len(q1) = 1 THEN q1 ELSE [s] END AS task_list FROM {name}_2)"""


def exploded_ctes(source: str, column: str = "tasks", name: str = "exploded", strict: bool = False) -> str:
    """... and in ``name``: one row per task with ``pos`` and ``task``."""
    return (
        split_ctes(source, column, f"{name}_l")
        + f""",
{name}_p AS (SELECT *, unnest(range(1, len(task_list) + 1)) AS pos FROM {name}_l),
{name} AS (SELECT * EXCLUDE (task_list), {clean('task_list[pos]', strict)} AS task FROM {name}_p)"""
    )


TASKS = f"WITH base AS ({inputs.TASK_TEXTS}), " + exploded_ctes("base")
_PAIR_SIDES = (
    f"WITH base AS ({inputs.TASK_PAIRS}), "
    + exploded_ctes("base", "tasks_generator_a", "ea")
    + ", "
    + exploded_ctes("base", "tasks_generator_b", "eb")
)
_COMPARED = f"""{_PAIR_SIDES}, compared AS (
SELECT coalesce(a.us_id, b.us_id) AS us_id, coalesce(a.pos, b.pos) AS task_id, coalesce(a.input, b.input) AS input,
  a.task AS task_generator_a, b.task AS task_generator_b
FROM ea a FULL OUTER JOIN eb b ON a.us_id = b.us_id AND a.pos = b.pos)"""
_DOC_TASKS = f"WITH base AS ({inputs.DOCUMENT_TASKS}), " + exploded_ctes("base")

# --- judges -----------------------------------------------------------------


def pair_ctes(source: str) -> str:
    given = " OR ".join(f"json_extract(j, '$.{c}_{s}') IS NOT NULL" for s in "ab" for c in CRITERIA)
    scores = []
    for s in "ab":
        for c in CRITERIA:
            n = f"TRY_CAST(json_extract_string(j, '$.{c}_{s}') AS DOUBLE)"
            scores.append(
                f"CASE WHEN {n} IS NULL THEN 0 ELSE CAST(trunc(greatest(0, least(10, {n}))) AS BIGINT) END AS judge_score_{s}_{c}"
            )
    totals = ", ".join(
        " + ".join(f"judge_score_{s}_{c}" for c in CRITERIA) + f" AS judge_score_{s}_total" for s in "ab"
    )
    return f"""
pair_0 AS (SELECT *, CASE WHEN json_valid(raw) THEN raw ELSE nullif(regexp_extract(raw, '(?s)\\{{.*\\}}'), '') END AS t FROM {source}),
pair_1 AS (SELECT *, CASE WHEN json_valid(t) AND json_type(t) = 'OBJECT' THEN t END AS j FROM pair_0),
pair_2 AS (SELECT us_id, config, {', '.join(scores)},
  CASE WHEN trim(upper(json_extract_string(j, '$.winner')), '"''.') = 'B' THEN 'B' ELSE 'A' END AS judge_winner,
  coalesce(json_extract_string(j, '$.reason'), '') AS judge_reason,
  CASE WHEN j IS NULL THEN 'parse_failed' WHEN {given} THEN 'ok' ELSE 'empty' END AS judge_status FROM pair_1),
pairs AS (SELECT *, {totals}, 'C' || left(config, 1) AS cfg FROM pair_2)"""


_PAIR_COLUMNS = ", ".join(
    [f"judge_score_{s}_{c}" for s in "ab" for c in (*CRITERIA, "total")]
    + ["judge_winner", "judge_reason", "judge_status"]
)
PAIRS = f"WITH base AS ({inputs.PAIR_RAW}), " + pair_ctes("base")


def single_ctes(threshold: float = 35, own: bool = True) -> str:
    keys = [f"list_filter(json_keys(j), lambda k: levenshtein(k, '{c}') < 2)[-1] AS k_{c}" for c in CRITERIA]
    values = [f"json_extract(j, '$.\"' || k_{c} || '\".puntuacion') AS v_{c}" for c in CRITERIA]
    numbers = [
        f"CASE WHEN json_type(v_{c}) IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(v_{c} AS DOUBLE) END AS n_{c}"
        for c in CRITERIA
    ]
    total = " + ".join(f"n_{c}" for c in CRITERIA)
    shown = [f"CASE WHEN t IS NULL THEN -1 ELSE n_{c} END AS validacion_{s}" for c, s in zip(CRITERIA, SPANISH)]
    enough = f"t >= {threshold}"
    approved = f"coalesce(CAST(json_extract(j, '$.aprobado') AS BOOLEAN), {enough})" if own else enough
    listed = lambda key: f"array_to_string(coalesce(CAST(json_extract(j, '$.{key}') AS VARCHAR[]), []), '|')"
    return f"""
single_0 AS (SELECT *, coalesce(nullif(regexp_extract(replace(replace(raw, '```json', ''), '```', ''), '(?s)\\{{.*\\}}'), ''), raw) AS c FROM base),
single_1 AS (SELECT *, CASE WHEN json_valid(c) THEN c ELSE regexp_replace(c, ',\\s*([}}\\]])', '\\1', 'g') END AS r FROM single_0),
single_2 AS (SELECT *, CASE WHEN json_valid(r) AND json_type(r) = 'OBJECT' THEN r END AS j FROM single_1),
single_3 AS (SELECT *, {', '.join(keys)} FROM single_2),
single_4 AS (SELECT *, {', '.join(values)} FROM single_3),
single_5 AS (SELECT *, {', '.join(numbers)} FROM single_4),
single_6 AS (SELECT *, {total} AS t FROM single_5),
singles AS (SELECT us_id, config, {', '.join(shown)}, coalesce(t, -5) AS validacion_total,
  CASE WHEN t IS NULL THEN false ELSE {approved} END AS validacion_aprobado,
  CASE WHEN t IS NULL THEN 'Error en parsing de respuesta del juez' ELSE {listed('problemas_criticos')} END AS validacion_problemas,
  CASE WHEN t IS NULL THEN 'Revisar manualmente' ELSE {listed('recomendaciones')} END AS validacion_recomendaciones,
  CASE WHEN t IS NULL THEN 'parse_failed' ELSE 'ok' END AS judge_status FROM single_6)"""


SINGLES = f"WITH base AS ({inputs.SINGLE_RAW}), " + single_ctes()
_ZERO = " OR ".join(f"validacion_{s} = 0" for s in SPANISH)

# --- model doubles ----------------------------------------------------------


def writer(prompt: str) -> str:
    h = f"md5({prompt})"
    part = lambda a, n: f"substr({h}, {a}, {n})"
    return (
        f"('1. summary: Build ' || {part(1, 8)} || chr(10) || 'description: First ' || {part(9, 8)} || chr(10) || chr(10) "
        f"|| '2. summary: Test ' || {part(17, 8)} || chr(10) || 'description: Second ' || {part(25, 8)})"
    )


def short_writer(prompt: str) -> str:
    return f"('Only ' || substr(md5({prompt}), 1, 12))"


def digit(h: str, i: int) -> str:
    return f"((strpos('0123456789abcdef', substr({h}, {i}, 1)) - 1) % 11)"


def reasked(prompt: str, scored: int) -> str:
    """Digest that counts: the first without a zero among the scored digits, or the third."""
    asks = [f"md5({prompt} || {text(retry_note(k) if k else '')})" for k in range(3)]
    zero = lambda h: f"regexp_matches(substr({h}, 1, {scored}), '[0b]')"
    return f"CASE WHEN NOT {zero(asks[0])} THEN {asks[0]} WHEN NOT {zero(asks[1])} THEN {asks[1]} ELSE {asks[2]} END"


def digits_sum(h: str, start: int) -> str:
    return " + ".join(digit(h, i) for i in range(start, start + 5))


def fill(template: str, **values: str) -> str:
    sql = text(template)
    for name, value in values.items():
        sql = f"replace({sql}, '{{{{{name}}}}}', {value})"
    return sql


_STORIES = f"WITH stories AS ({inputs.STORIES})"
_VALID = f"{_STORIES}, valid AS (SELECT * FROM stories WHERE {is_story('input')})"
_NUMBERED = f"{_VALID}, numbered AS (SELECT *, row_number() OVER (ORDER BY story_id) AS us_id FROM valid)"
_CLEAN_NUMBERED = (
    f"{_VALID}, numbered AS (SELECT * REPLACE ({strip('input')} AS input), "
    "row_number() OVER (ORDER BY story_id) AS us_id FROM valid)"
)
_TASK_PROMPT = fill(TASK_TEMPLATE, user_story=strip("input"))
_SINGLE_PROMPT = fill(JUDGE_TEMPLATE, story="input", tasks="task", threshold="'35.0'")
_SINGLE_RUN = f"""{_CLEAN_NUMBERED}, answered AS (SELECT *, {writer(_TASK_PROMPT)} AS tasks FROM numbered), {exploded_ctes('answered')},
judged AS (SELECT *, {reasked(f'({_SINGLE_PROMPT})', 5)} AS h FROM exploded)
SELECT us_id, story_id, row_number() OVER (ORDER BY us_id, pos) AS task_id, task, 'double-writer' AS generator_model_name,
  'double-judge' AS judge_model_name, CAST({digits_sum('h', 1)} AS DOUBLE) AS validacion_total, ({digits_sum('h', 1)}) >= 35 AS validacion_aprobado,
  'ok' AS judge_status FROM judged"""
_SINGLE_FILE = f"""{_CLEAN_NUMBERED.replace(is_story('input'), is_story('input', 'c'))},
answered AS (SELECT *, {writer("'Split: ' || input")} AS tasks FROM numbered), {exploded_ctes('answered')}
SELECT us_id, row_number() OVER (ORDER BY us_id, pos) AS task_id, md5(task) AS md5 FROM exploded"""
_DUAL = f"""{_CLEAN_NUMBERED}, answered AS (SELECT us_id, input, {writer(_TASK_PROMPT)} AS a, {short_writer(_TASK_PROMPT)} AS b FROM numbered)"""
_PAIR_PROMPT = fill(PAIR_TEMPLATE, user_story="input", tasks_a="a", tasks_b="b")

_DUAL_ONCE = f"""{_DUAL}, once0 AS (SELECT us_id, md5(input || ' / ' || a) AS h FROM answered),
once AS (SELECT us_id, h, {digits_sum('h', 1)} AS ta, {digits_sum('h', 6)} AS tb,
  CASE WHEN (strpos('0123456789abcdef', substr(h, 11, 1)) - 1) % 2 = 1 THEN 'B' ELSE 'A' END AS winner FROM once0)"""
_DUAL_TASKS = f"""{_DUAL}, {exploded_ctes('answered', 'a', 'ea')}, {exploded_ctes('answered', 'b', 'eb')}
SELECT x.us_id, x.pos FROM ea x LEFT JOIN eb y ON x.us_id = y.us_id AND x.pos = y.pos"""

# --- reports ----------------------------------------------------------------


def metric_rows(by: str, extra: str = "") -> str:
    """Long metrics rows from ``pairs``; ``by`` ends in a comma or is empty."""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    rows = []
    for gen, s, w in (("G1", "a", "A"), ("G2", "b", "B")):
        means = ", ".join(f"round(avg(judge_score_{s}_{c}), 6) AS \"{c.capitalize()}\"" for c in CRITERIA)
        total = " + ".join(f"avg(judge_score_{s}_{c})" for c in CRITERIA)
        rows.append(
            f"SELECT {by} '{gen}' AS \"Gen\", {means}, round(avg(judge_score_{s}_total), 6) AS \"Mean\", "
            f"round(stddev_samp(judge_score_{s}_total), 6) AS \"Std\", "
            f"round(avg(CASE WHEN judge_score_{s}_total >= 35 THEN 1.0 ELSE 0.0 END) * 100, 6) AS \"Pass\", "
            f"round(avg(CASE WHEN judge_winner = '{w}' THEN 1.0 ELSE 0.0 END) * 100, 6) AS \"Win\", "
            f"round({total}, 6) AS \"Criteria_Total\" FROM pairs {extra} {group}"
        )
    return " UNION ALL ".join(rows)


# result 4 has no total of side B and no winner
_NO_TOTAL = "CASE WHEN NOT (\"Config\" = 'C4' AND \"Gen\" = 'G2') THEN"
_PARTIAL_METRICS = (
    ", ".join(f'{_NO_TOTAL} "{c}" END AS "{c}"' for c in ("Mean", "Std", "Pass"))
    + ", CASE WHEN \"Config\" <> 'C4' THEN \"Win\" END AS \"Win\""
)
_ROUNDED_METRICS = (
    ", ".join(f'round_even({_NO_TOTAL} "{c}" END, 2) AS "{c}"' for c in ("Mean", "Pass"))
    + ", round_even(CASE WHEN \"Config\" <> 'C4' THEN \"Win\" END, 2) AS \"Win\""
)
_CAPITAL = ", ".join(f'"{c.capitalize()}"' for c in CRITERIA)
_LONG = f"{PAIRS}, long0 AS ({metric_rows('cfg,')}), long AS (SELECT * RENAME (cfg AS \"Config\") FROM long0)"
_LONG_ALL = f"{PAIRS}, long AS ({metric_rows('')})"
_BOXES = """totals AS (
SELECT cfg, 'G1' AS gen, CAST(judge_score_a_total AS DOUBLE) AS v FROM pairs UNION ALL
SELECT cfg, 'G2', CAST(judge_score_b_total AS DOUBLE) FROM pairs),
quartiles AS (SELECT cfg, gen, count(*) AS n_rows, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med,
  quantile_cont(v, 0.75) AS q3 FROM totals GROUP BY cfg, gen),
fenced AS (SELECT t.cfg, t.gen, v, n_rows, q1, med, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
  FROM totals t JOIN quartiles q ON t.cfg = q.cfg AND t.gen = q.gen),
boxes AS (SELECT cfg, gen, n_rows, q1, med, q3, least(min(CASE WHEN v >= lo THEN v END), q1) AS w_lo,
  greatest(max(CASE WHEN v <= hi THEN v END), q3) AS w_hi, count(*) FILTER (v < lo OR v > hi) AS n_out
  FROM fenced GROUP BY cfg, gen, n_rows, q1, med, q3)"""
_TOTALS = f"{PAIRS}, {_BOXES}"
_FRACTIONS = f"""WITH pairs AS (SELECT "Config" AS cfg, judge_score_a_total, judge_score_b_total FROM ({inputs.FRACTIONAL_TOTALS}) t), {_BOXES.replace("FROM pairs),", "FROM pairs WHERE judge_score_b_total IS NOT NULL),")}"""

_REFUSED = (
    "CASE WHEN batch_size < 1 THEN 'batch_size' END, CASE WHEN temperature < 0 OR temperature > 2 THEN 'temperature' END, "
    "CASE WHEN max_tokens < 1 THEN 'max_tokens' END, CASE WHEN workers < 1 THEN 'workers' END, CASE WHEN threshold < 0 OR threshold > 50 THEN 'threshold' END"
)

_DAMAGED = f"""WITH base AS ({inputs.PROPS_DAMAGED}),
cut AS (SELECT event_id, coalesce(nullif(regexp_extract(replace(replace(raw, '```json', ''), '```', ''), '(?s)\\{{.*\\}}'), ''), raw) AS c FROM base),
mended AS (SELECT *, regexp_replace(regexp_replace(replace(c, chr(10), '\\n'), ',\\s*([}}\\]])', '\\1', 'g'), '(\\d)\\s*("\\w+":)', '\\1, \\2', 'g') AS m FROM cut),
parsed AS (SELECT event_id, CASE WHEN json_valid(c) AND NOT regexp_matches(c, ',\\s*[}}\\]]') THEN 'direct' WHEN json_valid(m) THEN 'repaired' ELSE 'failed' END AS parse_status,
  CASE WHEN json_valid(c) THEN c WHEN json_valid(m) THEN m END AS j FROM mended)"""


def _share(status: str) -> str:
    name = "success" if status == "direct" else status
    return (
        f"count(*) FILTER (parse_status = '{status}') AS {name}, "
        f"count(*) FILTER (parse_status = '{status}') * 100.0::DOUBLE / count(*) AS {name}_pct"
    )


ORACLE: dict[str, str] = {
    "stories_clean": f"{_STORIES} SELECT * REPLACE ({strip('input')} AS input) FROM stories WHERE {strip('input')} <> ''",
    "stories_sampled": f"{_STORIES}, first AS (SELECT * FROM stories ORDER BY story_id LIMIT 50) "
    f"SELECT * REPLACE ({strip('input')} AS input) FROM first WHERE {strip('input')} <> ''",
    "stories_valid": f"{_VALID} SELECT * FROM valid",
    "stories_valid_case": f"{_STORIES} SELECT * FROM stories WHERE {is_story('input', 'c')}",
    "stories_flagged": f"{_STORIES} SELECT story_id, {is_story('input')} AS story_valid FROM stories",
    "stories_validation_stats": f"{_STORIES}, v AS (SELECT {is_story('input')} AS ok FROM stories) "
    "SELECT count(*) AS total, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid, "
    "count(*) FILTER (ok) * 100.0::DOUBLE / count(*) AS valid_pct, "
    "count(*) FILTER (NOT ok) * 100.0::DOUBLE / count(*) AS invalid_pct FROM v",
    "stories_reject_sample": f"{_STORIES} SELECT story_id, input FROM stories WHERE NOT {is_story('input')} ORDER BY story_id LIMIT 3",
    "story_ids": f"{_NUMBERED} SELECT story_id, us_id FROM numbered",
    "ids_by_tied_key": "WITH r AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) AS id FROM orders) "
    "SELECT o_orderpriority, min(id) AS first_id, max(id) AS last_id, count(DISTINCT id) AS ids FROM r GROUP BY 1",
    "story_batches": f"{_NUMBERED} SELECT story_id, (us_id - 1) // 8 AS batch_id, (us_id - 1) % 4 AS split_id FROM numbered",
    "story_batch_count": f"{_VALID} SELECT CAST(ceil(count(*) / 8) AS BIGINT) AS num_batches FROM valid",
    "document_squeezed": f"SELECT doc_id, md5({squeeze('text')}) AS md5, length({squeeze('text')}) AS n FROM documents",
    "structured_story": f"WITH s AS ({inputs.STRUCTURED}), j AS (SELECT part_id, CASE WHEN json_valid(input) THEN input END AS j FROM s) "
    "SELECT part_id, json_extract_string(j, '$.project') AS project, json_extract_string(j, '$.summary') AS summary, "
    "json_extract_string(j, '$.description') AS description FROM j",
    "structured_story_valid": f"WITH s AS ({inputs.STRUCTURED}), d AS (SELECT part_id, CASE WHEN json_valid(input) "
    f"THEN json_extract_string(input, '$.description') END AS description FROM s) SELECT * FROM d WHERE {is_story('description')}",
    "structured_story_build": "SELECT p_partkey, CAST(json_object('project', p_brand, 'summary', p_name, 'description', p_type) AS VARCHAR) AS input FROM part",
    "stories_csv": f"{_STORIES} SELECT story_id, project, input FROM stories",
    "prompts_rendered": f"{_STORIES} SELECT story_id, {fill(TASK_TEMPLATE, user_story=f"coalesce({strip('input')}, '')")} AS prompt FROM stories",
    "judge_prompts": f"WITH base AS ({inputs.TASK_PAIRS}) SELECT us_id, "
    f"{fill(JUDGE_TEMPLATE, story='input', tasks='tasks_generator_a', threshold="'35.0'")} || {text(retry_note(1))} AS single, "
    f"{fill(PAIR_TEMPLATE, user_story=strip('input'), tasks_a=strip('tasks_generator_a'), tasks_b=strip('tasks_generator_b'))} AS pair FROM base",
    "tasks_split": f"WITH base AS ({inputs.TASK_TEXTS}), {split_ctes('base')} "
    "SELECT us_id, len(task_list) AS n, array_to_string(task_list, ' | ') AS pieces FROM listed",
    "tasks_exploded_global": f"{TASKS} SELECT us_id, input, brand, row_number() OVER (ORDER BY us_id, pos) AS task_id, task FROM exploded",
    "tasks_exploded_grouped": f"{TASKS} SELECT us_id, input, brand, pos AS task_id, task FROM exploded",
    "tasks_exploded_brand": f"{TASKS} SELECT us_id, input, brand, row_number() OVER (PARTITION BY brand ORDER BY us_id, pos) AS task_id, task FROM exploded",
    "tasks_strict_numbers": f"WITH base AS ({inputs.TASK_TEXTS}), {exploded_ctes('base', strict=True)} SELECT us_id, pos AS task_id, task FROM exploded",
    "task_fields": f"{TASKS} SELECT us_id, pos AS task_id, "
    f"nullif({strip(rf"regexp_extract(task, '(?is)summary{WS}*:(.*?)(?:\n{WS}*description{WS}*:|$)', 1)")}, '') AS task_summary, "
    f"nullif({strip(rf"regexp_extract(task, '(?is)(?:^|\n){WS}*description{WS}*:(.*)$', 1)")}, '') AS task_description FROM exploded",
    "document_tasks": f"{_DOC_TASKS} SELECT us_id, pos AS task_id, md5(task) AS md5 FROM exploded",
    "document_tasks_by_language": f"{_DOC_TASKS} SELECT lang, us_id, row_number() OVER (PARTITION BY lang ORDER BY us_id, pos) AS task_id, md5(task) AS md5 FROM exploded",
    "dual_task_compare": f"{_COMPARED} SELECT * FROM compared",
    "dual_task_join": f"{_COMPARED} SELECT * FROM compared",
    "task_counts": f"{_COMPARED} SELECT count(*) AS tasks, count(DISTINCT us_id) AS stories FROM compared",
    "json_parse_status": f"{_DAMAGED} SELECT event_id, parse_status, json_extract_string(j, '$.k') AS k, json_extract_string(j, '$.note') AS note FROM parsed",
    "json_parse_metrics": f"{_DAMAGED} SELECT count(*) AS total, {_share('direct')}, {_share('repaired')}, {_share('failed')} FROM parsed",
    "json_fuzzy_keys": f"WITH base AS ({inputs.PROPS_KEYS}), k AS (SELECT event_id, raw, unnest(json_keys(raw)) AS k, generate_subscripts(json_keys(raw), 1) AS i FROM base), "
    "n AS (SELECT *, CASE WHEN levenshtein(k, 'granularity') < 2 THEN 'granularity' WHEN levenshtein(k, 'format') < 2 THEN 'format' "
    "WHEN levenshtein(k, 'coherence') < 2 THEN 'coherence' ELSE k END AS name, json_extract_string(raw, '$.\"' || k || '\"') AS v FROM k) "
    "SELECT event_id, string_agg(DISTINCT name, ',' ORDER BY name) AS keys, arg_max(v, i) FILTER (name = 'granularity') AS granularity, "
    "arg_max(v, i) FILTER (name = 'format') AS format FROM n GROUP BY event_id",
    "page_braces": "WITH c AS (SELECT page_id, regexp_extract(html, '(?s)\\{.*\\}') AS cut FROM pages) SELECT page_id, md5(cut) AS md5, "
    "len(cut) - len(replace(cut, '{', '')) > len(cut) - len(replace(cut, '}', '')) AS truncated FROM c",
    "json_duplicate_keys": f"SELECT event_id, keys, format, k FROM ({inputs.DUPLICATE_KEYS}) t",
    "pair_duplicate_keys": f"SELECT us_id, CASE WHEN score > 10 THEN 10 ELSE score END AS judge_score_a_coherence, winner AS judge_winner, 'last' AS judge_reason FROM ({inputs.PAIR_DUPLICATES}) t",
    "single_duplicate_keys": f"SELECT us_id, coherence AS validacion_coherencia, total AS validacion_total, true AS validacion_aprobado, 'direct' AS parse_status FROM ({inputs.SINGLE_DUPLICATES}) t",
    "generated_partly_cached": f"WITH p AS (SELECT o_orderkey, 'Order ' || CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey END AS VARCHAR) AS prompt FROM orders) "
    f"SELECT o_orderkey, md5({writer('prompt')}) AS md5, (SELECT count(DISTINCT prompt) FROM p) AS asked FROM p",
    "generated_forgotten": f"WITH p AS (SELECT o_orderkey, 'Customer ' || CAST(o_custkey AS VARCHAR) AS prompt FROM orders), n AS (SELECT count(DISTINCT prompt) AS n FROM p) "
    f"SELECT o_orderkey, md5({writer('prompt')}) AS md5, true AS same, md5('Only ' || substr(md5(prompt), 1, 12)) AS other_md5, n AS \"left\", n AS kept FROM p, n",
    "generated_refreshed": f"SELECT conv_id, turn, md5({writer('text')}) AS md5, (SELECT count(DISTINCT text) FROM conversations) AS held FROM conversations",
    "documents_csv": "SELECT doc_id, lang, md5(text) AS md5, length(text) AS n FROM documents",
    "documents_csv_inferred": "SELECT source, count(*) AS rows, sum(n_chars)::BIGINT AS chars, sum(length(text))::BIGINT AS length, 'int,int,string,string' AS kinds FROM documents GROUP BY source",
    "requests_shown": "WITH h AS (SELECT conv_id, turn, text, md5(text) AS h FROM conversations) SELECT conv_id, turn, "
    "CASE WHEN text IS NOT NULL AND h[1] <> '0' THEN 'm|be brief|0.5|json|' || substr(h, 1, 6) END AS generation, "
    "CASE WHEN text IS NULL THEN 'missing prompt' WHEN h[1] = '0' THEN 'never ' || substr(h, 2, 4) END AS generation_error, "
    "CAST(CASE WHEN text IS NULL THEN 0 WHEN h[1] IN ('0', '1') THEN 2 ELSE 1 END AS BIGINT) AS attempts FROM h",
    "pair_call_failures": f"WITH h AS (SELECT us_id, md5('p ' || CAST(us_id AS VARCHAR)) AS h, us_id % 11 = 0 AS gone FROM ({inputs.TASK_PAIRS}) t), "
    "s AS (SELECT *, CASE WHEN gone THEN 'missing_input' WHEN h[1] IN ('0','1','2','3') THEN 'call_failed' WHEN h[1] IN ('4','5') THEN 'parse_failed' ELSE 'ok' END AS judge_status FROM h) "
    "SELECT us_id, CAST(CASE WHEN judge_status IN ('missing_input', 'call_failed') THEN -1 WHEN judge_status = 'ok' THEN 5 ELSE 0 END AS BIGINT) AS judge_score_a_coherence, "
    "CAST(CASE WHEN judge_status IN ('missing_input', 'call_failed') THEN -5 WHEN judge_status = 'ok' THEN 4 ELSE 0 END AS BIGINT) AS judge_score_b_total, "
    "CASE WHEN judge_status = 'ok' THEN 'B' ELSE 'A' END AS judge_winner, "
    "CASE judge_status WHEN 'missing_input' THEN 'Judge evaluation failed: missing prompt' WHEN 'call_failed' THEN 'Judge evaluation failed: down ' || substr(h, 2, 3) WHEN 'ok' THEN 'json1000' ELSE '' END AS judge_reason, judge_status FROM s",
    "single_call_failures": f"WITH h AS (SELECT us_id, md5('p ' || CAST(us_id AS VARCHAR)) AS h FROM ({inputs.TASK_TEXTS}) t), "
    "s AS (SELECT *, CASE WHEN h[1] IN ('0','1','2','3') THEN 'call_failed' WHEN h[1] IN ('4','5') THEN 'parse_failed' ELSE 'ok' END AS judge_status FROM h) "
    "SELECT us_id, CASE WHEN judge_status = 'ok' THEN 8.0::DOUBLE ELSE -1.0::DOUBLE END AS validacion_coherencia, CASE WHEN judge_status = 'ok' THEN 40.0::DOUBLE ELSE -5.0::DOUBLE END AS validacion_total, "
    "judge_status = 'ok' AS validacion_aprobado, CASE judge_status WHEN 'ok' THEN '' WHEN 'call_failed' THEN 'Error de conexión con modelo' ELSE 'Error en parsing de respuesta del juez' END AS problems, "
    "CASE judge_status WHEN 'ok' THEN '' WHEN 'call_failed' THEN 'Reintentar validación' ELSE 'Revisar manualmente' END AS advice, judge_status FROM s",
    "single_judge_scores": f"{SINGLES} SELECT * EXCLUDE (config) FROM singles",
    "single_judge_by_threshold": f"WITH base AS ({inputs.SINGLE_RAW}), {single_ctes(30, own=False)} SELECT us_id, validacion_total, validacion_aprobado FROM singles",
    "approval_report": f"{SINGLES} SELECT config, count(*) FILTER (validacion_aprobado) AS approved, count(*) AS total, "
    "round(avg(CAST(validacion_aprobado AS INT)) * 100, 6) AS approved_pct, round(avg(validacion_total), 6) AS mean_total FROM singles GROUP BY config",
    "single_zero_scores": f"{SINGLES} SELECT us_id, {_ZERO} AS zero FROM singles",
    "pair_judge_scores": f"{PAIRS} SELECT us_id, {_PAIR_COLUMNS} FROM pairs",
    "selected_outputs": f"{PAIRS} SELECT us_id, CASE WHEN judge_winner = 'B' THEN 'second' ELSE 'first' END AS selected_output FROM pairs",
    "totals_recomputed": f"{PAIRS} SELECT us_id, judge_score_a_total - CASE WHEN judge_score_a_format = 9 THEN 9 ELSE 0 END AS judge_score_a_total, judge_score_b_total FROM pairs",
    "numbers_coerced": "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS DOUBLE) WHEN 1 THEN 7.5::DOUBLE END AS score FROM orders",
    "generated_rows": f"SELECT conv_id, turn, {writer('text')} AS generation, CAST(1 AS BIGINT) AS attempts FROM conversations",
    "generated_twice": f"SELECT conv_id, turn, {writer('text')} AS generation_a, {short_writer('text')} AS generation_b, true AS timed FROM conversations",
    "generated_cached": f"SELECT o_orderkey, md5({writer("('Explain ' || o_orderpriority)")}) AS md5, true AS same FROM orders",
    "generations_joined": f"SELECT conv_id, turn, role, {writer('text')} AS generation_a, {short_writer('text')} AS generation_b FROM conversations",
    "zero_reask": f"WITH base AS ({inputs.TASK_TEXTS}), h AS (SELECT us_id, {reasked("('Judge: ' || input || ' / ' || tasks)", 5)} AS h FROM base) "
    f"SELECT us_id, CAST({digits_sum('h', 1)} AS DOUBLE) AS validacion_total, ({digits_sum('h', 1)}) >= 35 AS validacion_aprobado, 'ok' AS judge_status FROM h",
    "pair_reask": f"WITH base AS ({inputs.TASK_PAIRS}), h AS (SELECT *, {reasked("(input || ' / ' || tasks_generator_a || ' / ' || tasks_generator_b)", 10)} AS h FROM base), "
    "w AS (SELECT *, CASE WHEN (strpos('0123456789abcdef', substr(h, 11, 1)) - 1) % 2 = 1 THEN 'B' ELSE 'A' END AS judge_winner FROM h) "
    f"SELECT us_id, {digits_sum('h', 1)} AS judge_score_a_total, {digits_sum('h', 6)} AS judge_score_b_total, judge_winner, substr(h, 12, 5) AS judge_reason, "
    "'ok' AS judge_status, md5(CASE WHEN judge_winner = 'B' THEN tasks_generator_b ELSE tasks_generator_a END) AS selected_md5 FROM w",
    "pair_evaluation": f"{_LONG} SELECT * FROM long",
    "generator_metrics": f"{_LONG_ALL} SELECT \"Gen\", \"Mean\", \"Std\", \"Pass\", \"Win\" FROM long",
    "generator_metrics_judged_only": f"{PAIRS}, long AS ({metric_rows('config,', "WHERE config <> '5-LOW'")}) SELECT config, \"Gen\", \"Mean\", \"Std\", \"Pass\", \"Win\" FROM long",
    "criterion_means": f"{_LONG_ALL} SELECT \"Gen\", {_CAPITAL} FROM long",
    "wins": f"{PAIRS} SELECT config, count(*) AS stories, count(*) FILTER (judge_winner = 'A') AS wins_a, count(*) FILTER (judge_winner = 'B') AS wins_b, "
    "round(count(*) FILTER (judge_winner = 'A') * 100.0::DOUBLE / count(*), 6) AS wins_a_pct, round(count(*) FILTER (judge_winner = 'B') * 100.0::DOUBLE / count(*), 6) AS wins_b_pct, "
    "round(avg(judge_score_a_total), 6) AS mean_a, round(avg(judge_score_b_total), 6) AS mean_b FROM pairs GROUP BY config",
    "run_timings": f"WITH t AS ({inputs.TIMINGS}) SELECT config, round(avg(generation_time_a), 6) AS mean_generation_time_a, round(avg(generation_time_b), 6) AS mean_generation_time_b, "
    "round(avg(judge_time), 6) AS mean_judge_time, round(avg(generation_time_a + generation_time_b + judge_time), 6) AS mean_total_time FROM t GROUP BY config",
    "consolidated_criteria": f"{_LONG} SELECT \"Config\", \"Gen\", {_CAPITAL.replace('"Format"', """CASE WHEN "Config" = 'C2' AND "Gen" = 'G2' THEN NULL ELSE "Format" END AS "Format" """)} FROM long",
    "consolidated_metrics": f"{_LONG} SELECT \"Config\", \"Gen\", {_PARTIAL_METRICS} FROM long",
    "summary_files": f"{_LONG} SELECT \"Config\", \"Gen\", {_ROUNDED_METRICS} FROM long",
    "consolidated_totals": f"{_LONG} SELECT 'run_dual_test' || right(\"Config\", 1) || '_judge_results' AS test, \"Config\", \"Gen\", "
    "round(CASE WHEN \"Config\" = 'C2' AND \"Gen\" = 'G2' THEN \"Criteria_Total\" - \"Format\" ELSE \"Criteria_Total\" END, 6) AS \"Criteria_Total\" FROM long",
    "boxplot_from_files": f"{_TOTALS} SELECT cfg AS \"Config\", gen AS \"Gen\", n_rows AS rows, q1, med AS median, q3, w_lo AS whisker_low, w_hi AS whisker_high, n_out AS outliers "
    "FROM boxes WHERE NOT (cfg = 'C4' AND gen = 'G2')",
    "criteria_pivot": f"{_LONG} SELECT \"Config\", "
    + ", ".join(
        f"max(\"{c}\") FILTER (\"Gen\" = '{g}') AS \"{g}_{c}\"" for c in (x.capitalize() for x in CRITERIA) for g in ("G1", "G2")
    )
    + " FROM long GROUP BY \"Config\"",
    "score_boxplot": f"{_TOTALS}, names AS (SELECT * FROM (VALUES ('C1', 'Llama 3.1', 'Mistral'), ('C2', 'Qwen 3', 'Gemma 4'), "
    "('C3', 'Gemma 3', 'Mistral Nemo'), ('C4', 'Qwen 3', 'Phi 4')) v(c, g1, g2)) "
    'SELECT cfg AS "Config", gen AS "Gen", n_rows AS rows, q1, med AS median, q3, w_lo AS whisker_low, w_hi AS whisker_high, n_out AS outliers, '
    """CASE WHEN gen = 'G1' THEN g1 ELSE g2 END AS "Model" FROM boxes JOIN names ON cfg = c""",
    "score_outliers": f"""WITH pairs AS (SELECT 'C' || substr(o_orderpriority, 1, 1) AS cfg,
  CASE WHEN o_orderkey % 97 = 0 THEN -5 ELSE 26 + o_orderkey % 10 + o_custkey % 10 END AS judge_score_a_total,
  CASE WHEN o_orderkey % 97 = 0 THEN -5 ELSE 27 + o_custkey % 10 END AS judge_score_b_total FROM orders), {_BOXES}
  SELECT cfg AS "Config", gen AS "Gen", CAST(v AS BIGINT) AS value, count(*) AS n FROM fenced WHERE v < lo OR v > hi GROUP BY ALL""",
    "fractional_boxplot": f"""{_FRACTIONS} SELECT cfg AS "Config", gen AS "Gen", n_rows AS rows, q1, med AS median, q3, w_lo AS whisker_low, w_hi AS whisker_high, n_out AS outliers FROM boxes""",
    "fractional_outliers": f"""{_FRACTIONS} SELECT cfg AS "Config", gen AS "Gen", v AS value, count(*) AS n FROM fenced WHERE v < lo OR v > hi GROUP BY ALL""",
    "flow_chain": "SELECT c_custkey, round(c_acctbal * 100) AS cents, upper(c_mktsegment) || '!' AS shout, 'm1' AS model FROM customer",
    "single_run": _SINGLE_RUN,
    "dual_run_tasks": f"""{_DUAL}, {exploded_ctes('answered', 'a', 'ea')}, {exploded_ctes('answered', 'b', 'eb')}
SELECT x.us_id, x.pos AS task_id, x.input, x.task AS task_generator_a, y.task AS task_generator_b
FROM ea x LEFT JOIN eb y ON x.us_id = y.us_id AND x.pos = y.pos""",
    "dual_run_scores": f"""{_DUAL}, h AS (SELECT us_id, input, {reasked(f'({_PAIR_PROMPT})', 10)} AS h FROM answered)
SELECT us_id, input, {digits_sum('h', 1)} AS judge_score_a_total, {digits_sum('h', 6)} AS judge_score_b_total,
  CASE WHEN (strpos('0123456789abcdef', substr(h, 11, 1)) - 1) % 2 = 1 THEN 'B' ELSE 'A' END AS judge_winner,
  {digit('h', 1)} AS judge_score_a_coherence, {digit('h', 10)} AS judge_score_b_granularity, substr(h, 12, 5) AS judge_reason,
  true AS stamped, true AS timed FROM h""",
    "single_run_report": f"WITH r AS ({_SINGLE_RUN}) SELECT count(*) AS tasks, count(DISTINCT us_id) AS stories, count(*) FILTER (validacion_aprobado) AS approved, "
    "count(*) AS total, round(avg(CAST(validacion_aprobado AS INT)) * 100, 6) AS approved_pct, round(avg(validacion_total), 6) AS mean_total, "
    "count(*) AS success, CAST(0 AS BIGINT) AS repaired, CAST(0 AS BIGINT) AS failed FROM r",
    "single_run_file": _SINGLE_FILE,
    "dual_run_report": f"{_DUAL_ONCE}, c AS (SELECT count(*) AS tasks, count(DISTINCT us_id) AS stories FROM ({_DUAL_TASKS}) t), "
    "w AS (SELECT count(*) FILTER (winner = 'A') AS wins_a, count(*) FILTER (winner = 'B') AS wins_b, round(avg(ta), 6) AS mean_a, round(avg(tb), 6) AS mean_b FROM once), "
    "m AS (" + " UNION ALL ".join(
        f"SELECT '{g}' AS \"Gen\", " + ", ".join(f'round(avg({digit("h", at + i)}), 6) AS "{c.capitalize()}"' for i, c in enumerate(CRITERIA)) + " FROM once"
        for g, at in (("G1", 1), ("G2", 6))
    ) + ") SELECT m.*, c.*, w.*, true AS timed FROM m, c, w",
    "dual_run_files": f"{_DUAL_ONCE} SELECT us_id, CAST(ta AS VARCHAR) AS judge_score_a_total, winner AS judge_winner, CAST(0 AS BIGINT) AS missing, 'dual_tasks_t_judge_results' AS test FROM once",
    "settings_refused": f"WITH r AS ({inputs.PLANNED_RUNS}), p AS (SELECT run_id, list_filter([{_REFUSED}], lambda x: x IS NOT NULL) AS p FROM r) "
    "SELECT run_id, array_to_string(p, ',') AS refused, len(p) AS n FROM p",
    "settings_kept": f"WITH r AS ({inputs.PLANNED_RUNS}) SELECT run_id, workers FROM r WHERE len(list_filter([{_REFUSED}], lambda x: x IS NOT NULL)) = 0",
    "flow_outputs": "SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders",
    "written_tables": f"{TASKS}, {_STORIES.removeprefix('WITH ')} SELECT 'task' AS kind, us_id AS id, md5(task) AS md5 FROM exploded "
    f"UNION ALL SELECT 'story', story_id, md5({strip('input')}) FROM stories WHERE {is_story('input')}",
    "run_stamps": "SELECT o_orderkey, CAST(60 AS BIGINT) AS seconds, '03:04:05' AS begun FROM orders",
}
