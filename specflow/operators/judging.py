"""Judge answers -> typed scores, one answer or a pair per row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from specflow.functions import jsontext as J
from specflow.functions import prompts
from specflow.functions.common import ColumnOrName, as_col, require_columns, settle
from specflow.functions.numbers import clamped_score, to_number
from specflow.operators.columns import CRITERIA, check_settings, chosen, drop_missing
from specflow.operators.inference import Ask, ModelCall, ask_lazily
from specflow.operators.parsing import parse_json
from specflow.session import materialize

# --- fixed values -----------------------------------------------------------
THRESHOLD = 35.0
ZERO_RETRIES = 2
FAILED_SCORE = -1
FAILED_TOTAL = -5
SINGLE_NAMES = {
    "coherence": "coherencia",
    "completeness": "completitud",
    "feasibility": "viabilidad",
    "format": "formato",
    "granularity": "granularidad",
}
PARSE_PROBLEM = "Error en parsing de respuesta del juez"
PARSE_ADVICE = "Revisar manualmente"
CALL_PROBLEM = "Error de conexión con modelo"
CALL_ADVICE = "Reintentar validación"
JUDGE_OPTIONS = {"temperature": 0.2, "num_predict": 800}
PAIR_OPTIONS = {"temperature": 0.2, "num_predict": 1000}
# ----------------------------------------------------------------------------


def parse_judgement(
    df: DataFrame,
    raw_column: str,
    threshold: float = THRESHOLD,
    policy: str = "model",
    criteria: Sequence[str] = CRITERIA,
    prefix: str = "validacion_",
    status: str = "judge_status",
    parse_status: str | None = None,
) -> DataFrame:
    """Score columns, total, approval, problems and advice from a single judge's answer.

    Every criterion needs a numeric ``puntuacion``, else the row is
    ``parse_failed``: -1 per criterion, total -5, not approved.  A null answer
    is ``call_failed``.  The total is always summed here.  With policy
    ``model`` the judge's own approval counts if it gave one, with
    ``threshold`` only the total does.  ``parse_status`` names a column for
    how the answer parsed (see ``parse_metrics``).
    """
    if policy not in ("model", "threshold"):
        raise ValueError(f"policy must be 'model' or 'threshold', got {policy!r}")
    require_columns(df, [raw_column], "parse_judgement")
    parsed = parse_json(df, raw_column, "__fields", "__how")
    parsed = parsed.withColumn("__entries", J.named_entries("__fields", criteria))
    # all criteria in one parse: if one of them is not an object, none counts
    listed = F.concat_ws(",", *[J.last_value("__entries", c) for c in criteria])
    points = F.from_json(F.concat(F.lit("["), listed, F.lit("]")), "array<struct<puntuacion: double>>")
    parsed = parsed.withColumn("__points", points)
    whole = F.size("__points") == len(criteria)
    each = {
        f"__{c}": F.when(whole, F.get("__points", F.lit(i))["puntuacion"])
        for i, c in enumerate(criteria)
    }
    parsed = parsed.withColumns(each)
    total = F.lit(0.0)
    for c in criteria:
        total = total + F.col(f"__{c}")
    parsed = parsed.withColumn("__total", total)

    ok = F.col("__total").isNotNull()
    failed_call = F.col(raw_column).isNull()
    fields = F.col("__fields")
    enough = (F.col("__total") >= threshold) & ~F.isnan("__total")
    own = fields["aprobado"].try_cast("boolean")
    approved = F.coalesce(own, enough) if policy == "model" else enough

    def messages(key: str, parse_text: str, call_text: str) -> Column:
        value = fields[key]
        listed = F.coalesce(
            F.from_json(value, "array<string>"), F.when(value.isNotNull(), F.array(value))
        )
        return (
            F.when(ok, F.coalesce(listed, F.array().cast("array<string>")))
            .when(failed_call, F.array(F.lit(call_text)))
            .otherwise(F.array(F.lit(parse_text)))
        )

    columns = {
        f"{prefix}{SINGLE_NAMES.get(c, c)}": F.when(ok, F.col(f"__{c}")).otherwise(
            F.lit(float(FAILED_SCORE))
        )
        for c in criteria
    }
    columns |= {
        f"{prefix}total": F.coalesce(F.col("__total"), F.lit(float(FAILED_TOTAL))),
        f"{prefix}aprobado": F.when(ok, approved).otherwise(F.lit(False)),
        f"{prefix}problemas": messages("problemas_criticos", PARSE_PROBLEM, CALL_PROBLEM),
        f"{prefix}recomendaciones": messages("recomendaciones", PARSE_ADVICE, CALL_ADVICE),
        status: F.when(ok, F.lit("ok"))
        .when(failed_call, F.lit("call_failed"))
        .otherwise(F.lit("parse_failed")),
    }
    if parse_status:
        columns[parse_status] = F.col("__how")
    scored = parsed.withColumns(columns)
    return settle(scored.drop("__fields", "__how", "__entries", "__points", "__total", *each), columns)


def parse_pair_judgement(
    df: DataFrame,
    raw_column: str,
    criteria: Sequence[str] = CRITERIA,
    prefix: str = "judge_",
    status: str = "judge_status",
    accept_nested: bool = False,
    error_column: str | None = None,
) -> DataFrame:
    """Scores of both sides, totals, winner and reason from a pair judge's answer.

    Scores are whole numbers 0 to 10, missing or unusable ones 0.  The winner
    is the one the judge names, A when it names neither.  ``status``:
    ``ok``, ``empty`` (an object without any score), ``parse_failed`` (no
    object; all zero) or ``call_failed`` (null answer; -1 / -5).  The contract
    is flat keys like ``coherence_a``; ``accept_nested`` also reads
    ``breakdown_a.coherence``.
    """
    require_columns(df, [raw_column], "parse_pair_judgement")
    raw = F.col(raw_column)
    # the whole answer first; only text around or instead of an object is cut away
    opens = raw.rlike(r"^[ \t\n\r]*\{")
    staged = df.withColumn("__whole", F.when(opens, raw))
    staged = J.with_json_object(staged, "__whole", "__direct")
    staged = staged.withColumn("__rest", F.when(F.col("__direct").isNull(), raw))
    staged = J.with_other_json(staged, "__rest", "__other", ~opens)
    staged = staged.withColumn("__cut", F.when(~F.col("__other"), J.from_braces("__rest")))
    staged = J.with_json_object(staged, "__cut", "__inner")
    staged = staged.withColumn("__fields", F.coalesce("__direct", "__inner"))
    fields = F.col("__fields")
    # one small expression over the ten keys, not ten copies of it: generated
    # methods beyond the JVM's compile limit stay interpreted
    keys = [(side, c) for side in "ab" for c in criteria]
    texts = F.transform(
        F.array(*[F.lit(f"{c}_{side}") for side, c in keys]), lambda k: F.try_element_at(fields, k)
    )
    if accept_nested:
        nested = {s: J.last_wins(F.from_json(fields[f"breakdown_{s}"], "map<string,string>")) for s in "ab"}
        staged = staged.withColumns({f"__nested_{s}": nested[s] for s in "ab"})
        deeper = F.array(*[F.col(f"__nested_{side}")[c] for side, c in keys])
        texts = F.zip_with(texts, deeper, lambda flat, nested: F.coalesce(flat, nested))
    staged = staged.withColumn("__texts", texts)
    numbers = F.transform(F.transform("__texts", to_number), clamped_score)
    failed_call = raw.isNull()
    failures = F.array_repeat(F.lit(FAILED_SCORE), len(keys))
    staged = staged.withColumn("__scores", F.when(failed_call, failures).otherwise(numbers))
    scores = {
        f"{prefix}score_{side}_{c}": F.get("__scores", F.lit(i)) for i, (side, c) in enumerate(keys)
    }
    any_given = F.exists("__texts", lambda t: t.isNotNull())
    named = F.regexp_replace(F.upper(fields["winner"]), r"^[\"'.]+|[\"'.]+\z", "")
    cause = F.coalesce(F.col(error_column), F.lit("")) if error_column else F.lit("no answer")
    error = F.concat(F.lit("Judge evaluation failed: "), cause)
    n = len(criteria)
    totals = {}
    for at, side in ((1, "a"), (n + 1, "b")):
        total = F.aggregate(F.slice("__scores", at, n), F.lit(0), lambda total, score: total + score)
        totals[f"{prefix}score_{side}_total"] = F.when(failed_call, F.lit(FAILED_TOTAL)).otherwise(total)
    how = (
        F.when(failed_call, F.lit("call_failed"))
        .when(fields.isNull(), F.lit("parse_failed"))
        .when(any_given, F.lit("ok"))
        .otherwise(F.lit("empty"))
    )
    rest = {
        **totals,
        f"{prefix}winner": F.when(named == "B", F.lit("B")).otherwise(F.lit("A")),
        f"{prefix}reason": F.when(failed_call, error).otherwise(
            F.coalesce(fields["reason"], F.lit(""))
        ),
        status: how,
    }
    scored = staged.withColumns({**scores, **rest})
    steps = ["__whole", "__direct", "__rest", "__other", "__cut", "__inner", "__fields"]
    steps += ["__texts", "__scores", "__nested_a", "__nested_b"]
    return settle(scored.drop(*steps), [*scores, *rest])


def has_zero(df: DataFrame, columns: Sequence[str]) -> Column:
    """Whether any of the score columns is 0; the failure value -1 is not."""
    require_columns(df, columns, "has_zero")
    zero = F.lit(False)
    for name in columns:
        zero = zero | (F.col(name) == 0)
    return F.coalesce(zero, F.lit(False))


def single_score_columns(prefix: str = "validacion_", criteria: Sequence[str] = CRITERIA) -> list[str]:
    return [f"{prefix}{SINGLE_NAMES.get(c, c)}" for c in criteria]


def pair_score_columns(prefix: str = "judge_", criteria: Sequence[str] = CRITERIA) -> list[str]:
    return [f"{prefix}score_{side}_{c}" for side in "ab" for c in criteria]


def ask_until_scored(
    df: DataFrame,
    prompt: ColumnOrName,
    call: ModelCall,
    parse: Callable[[DataFrame, str], DataFrame],
    score_columns: Sequence[str],
    time_column: str,
    zero_retries: int = ZERO_RETRIES,
    partitions: int | None = None,
) -> DataFrame:
    """Ask, parse, and ask again with a stricter prompt where a score came back 0.

    Rounds instead of a loop per row: each round writes its replies with their
    scores, the rows without a zero are finished, and the (far fewer) others go
    into the next one.  The last answer is kept, and seconds add up.
    """
    raw, spent = "__raw", "__spent"
    extra = [raw, f"{raw}_error", f"{raw}_attempts", "__seconds"]
    pending = df.withColumn("__prompt", as_col(prompt)).withColumn(spent, F.lit(0.0))
    finished: list[DataFrame] = []
    for attempt in range(zero_retries + 1):
        ask = Ask(prompts.stricter("__prompt", attempt), raw, call, "__seconds", details=True)
        # the prompt is built again each round and never written
        asked = ask_lazily(pending, [ask], partitions).drop("__prompt")
        scored = parse(asked, raw).withColumn(spent, F.col(spent) + F.coalesce(F.col("__seconds"), F.lit(0.0)))
        scored = materialize(scored, "judged")
        if attempt == zero_retries:
            finished.append(scored)
            break
        zero = has_zero(scored, score_columns)
        finished.append(scored.filter(~zero))
        again = scored.filter(zero)
        if again.isEmpty():
            break
        pending = again.select(*df.columns, spent).withColumn("__prompt", as_col(prompt))
    result = finished[0]
    for part in finished[1:]:
        result = result.unionByName(part)
    return result.withColumn(time_column, F.col(spent)).drop(*extra, spent)


def judge(
    df: DataFrame,
    story_column: str,
    tasks_column: str,
    call: ModelCall,
    threshold: float = THRESHOLD,
    policy: str = "model",
    criteria: Sequence[str] = CRITERIA,
    prefix: str = "validacion_",
    prompt: ColumnOrName | None = None,
    zero_retries: int = ZERO_RETRIES,
    partitions: int | None = None,
    observation: Observation | None = None,
    parse_status: str | None = None,
) -> DataFrame:
    """Score each row's tasks against its story with a judge model.

    Rows without a story or without tasks cannot be judged and are left out;
    an ``observation`` counts them.
    """
    check_settings(threshold=threshold)
    usable = drop_missing(df, [story_column, tasks_column], observation)
    if prompt is None:
        prompt = prompts.judge_prompt(story_column, tasks_column, threshold)

    def parse(asked: DataFrame, raw: str) -> DataFrame:
        return parse_judgement(asked, raw, threshold, policy, criteria, prefix, parse_status=parse_status)

    return ask_until_scored(
        usable,
        prompt,
        replace(call, response_format="json", options=JUDGE_OPTIONS if call.options is None else call.options),
        parse,
        single_score_columns(prefix, criteria),
        "judge_time",
        zero_retries,
        partitions,
    )


def judge_pairs(
    df: DataFrame,
    input_column: str,
    a_column: str,
    b_column: str,
    call: ModelCall,
    criteria: Sequence[str] = CRITERIA,
    prefix: str = "judge_",
    prompt: ColumnOrName | None = None,
    zero_retries: int = ZERO_RETRIES,
    accept_nested: bool = False,
    retries: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Score two outputs per row with a judge model and pick the one it prefers.

    A failed call gives a failure row at once unless ``retries`` are asked for.
    Rows with a missing text are not sent to the model: they come out with the
    failure values and ``judge_status`` ``missing_input``.
    """
    require_columns(df, [input_column, a_column, b_column], "judge_pairs")
    if prompt is None:
        prompt = prompts.pair_prompt(input_column, a_column, b_column)
    missing = F.col(input_column).isNull() | F.col(a_column).isNull() | F.col(b_column).isNull()
    flagged = df.withColumn("__missing", missing)

    def parse(asked: DataFrame, raw: str) -> DataFrame:
        return parse_pair_judgement(
            asked, raw, criteria, prefix, accept_nested=accept_nested, error_column=f"{raw}_error"
        )

    scored = ask_until_scored(
        flagged,
        F.when(~missing, as_col(prompt)),
        replace(
            call,
            response_format="json",
            max_retries=retries,
            options=PAIR_OPTIONS if call.options is None else call.options,
        ),
        parse,
        pair_score_columns(prefix, criteria),
        f"{prefix}time",
        zero_retries,
        partitions,
    )
    status = F.when(F.col("__missing"), F.lit("missing_input")).otherwise(F.col("judge_status"))
    return scored.withColumns(
        {
            "judge_status": status,
            "selected_output": chosen(f"{prefix}winner", a_column, b_column),
        }
    ).drop("__missing")
