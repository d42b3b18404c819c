"""Reports over judged rows.

Both sides of a pair are aggregated in one pass over the rows as they are; the
turn from columns (A, B) to rows (G1, G2) happens on the few aggregated rows.
All aggregates combine on the map side, so one configuration holding most rows
is no hot spot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specflow.functions.common import require_columns
from specflow.operators.columns import CRITERIA, coerce_numbers
from specflow.operators.ids import running_total_before
from specflow.operators.judging import FAILED_TOTAL, THRESHOLD
from specflow.session import materialize

SIDES = {"G1": "a", "G2": "b"}
WINNERS = {"G1": "A", "G2": "B"}
_ACCURACY = 10_000  # of the sketch of totals: ranks are off by at most one in so many
_BAND = 2 / _ACCURACY  # how far from a quantile, in shares of the rows, the sketch is asked on both sides


def _percent(condition: Column, present: Column | None = None) -> Column:
    """Share of the rows where the column is ``present``, null counting as no; null without such rows."""
    share = F.coalesce(condition, F.lit(False)).cast("double")
    return F.avg(share if present is None else F.when(present, share)) * 100


def to_long(wide: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows ``Gen`` = G1, G2 from columns named ``G1_x``, ``G2_x``."""
    sides = F.array(
        *[
            F.struct(F.lit(gen).alias("Gen"), *[F.col(f"{gen}_{c}").alias(c) for c in columns])
            for gen in SIDES
        ]
    )
    return wide.select(*by, F.inline(sides))


def generator_metrics(
    df: DataFrame,
    by: Sequence[str] = (),
    threshold: float = THRESHOLD,
    prefix: str = "judge_",
    exclude_failed: bool = False,
) -> DataFrame:
    """Mean, sample deviation, pass rate and win rate (percent) of G1 and G2.

    Failed judgements count with their failure totals unless excluded.
    """
    needed = [f"{prefix}score_a_total", f"{prefix}score_b_total", f"{prefix}winner"]
    require_columns(df, [*by, *needed], "generator_metrics")
    return to_long(
        _grouped(df, by, prefix, exclude_failed).agg(*_metrics(threshold, prefix)),
        by,
        ["Mean", "Std", "Pass", "Win"],
    )


def criterion_means(
    df: DataFrame,
    by: Sequence[str] = (),
    prefix: str = "judge_",
    criteria: Sequence[str] = CRITERIA,
    exclude_failed: bool = False,
) -> DataFrame:
    """Mean score per criterion of G1 and G2."""
    require_columns(df, [*by, *[f"{prefix}score_{s}_{c}" for s in "ab" for c in criteria]])
    means = _grouped(df, by, prefix, exclude_failed).agg(*_means(prefix, criteria))
    return to_long(means, by, [c.capitalize() for c in criteria])


def consolidate(
    df: DataFrame,
    config: str = "Config",
    threshold: float = THRESHOLD,
    prefix: str = "judge_",
    criteria: Sequence[str] = CRITERIA,
    by: Sequence[str] = (),
) -> DataFrame:
    """Criterion means, their sum and the generator metrics per configuration, one scan.

    Text scores are read as numbers, unusable ones as null; the winner column
    is left as it is.  ``by`` adds grouping columns, such as the result file.
    A column named in a row's ``missing_columns`` (see ``read_judge_results``)
    gives no rate, and the sum is that of the criteria there are.
    """
    scores = [f"{prefix}score_{s}_{c}" for s in "ab" for c in (*criteria, "total")]
    require_columns(df, [config, *by, *scores, f"{prefix}winner"], "consolidate")
    keys = [*by, config]
    wide = (
        coerce_numbers(df, scores)
        .groupBy(*keys)
        .agg(*_means(prefix, criteria), *_metrics(threshold, prefix, "missing_columns" in df.columns))
    )
    names = [c.capitalize() for c in criteria]
    long = to_long(wide, keys, [*names, "Mean", "Std", "Pass", "Win"])
    total = F.lit(0.0)
    for name in names:
        total = total + F.coalesce(F.col(name), F.lit(0.0))
    return long.withColumn("Criteria_Total", total)


def criterion_summary(consolidated: DataFrame, criteria: Sequence[str] = CRITERIA) -> DataFrame:
    return consolidated.select("Config", "Gen", *[c.capitalize() for c in criteria])


def aggregate_summary(consolidated: DataFrame) -> DataFrame:
    return consolidated.select("Config", "Gen", "Mean", "Std", "Pass", "Win")


def sort_and_round(summary: DataFrame, digits: int = 2) -> DataFrame:
    """A finished summary: sorted by Config and Gen, numbers rounded half to even."""
    rounded = {
        f.name: F.bround(f.name, digits)
        for f in summary.schema.fields
        if f.dataType.typeName() == "double"
    }
    return summary.withColumns(rounded).orderBy("Config", "Gen")


def pivot_generators(summary: DataFrame, values: Sequence[str], config: str = "Config") -> DataFrame:
    """One row per configuration, columns ``G1_x`` and ``G2_x``."""
    require_columns(summary, [config, "Gen", *values], "pivot_generators")
    picked = [
        F.first(F.when(F.col("Gen") == gen, F.col(v)), ignorenulls=True).alias(f"{gen}_{v}")
        for v in values
        for gen in SIDES
    ]
    return summary.groupBy(config).agg(*picked)


def wins(df: DataFrame, by: Sequence[str] = (), prefix: str = "judge_") -> DataFrame:
    """Wins per side, in rows and percent, and the mean totals."""
    return df.groupBy(*by).agg(*_wins(prefix))


def _wins(prefix: str) -> list[Column]:
    winner = F.col(f"{prefix}winner")
    return [
        F.count(F.lit(1)).alias("stories"),
        F.count_if(winner == "A").alias("wins_a"),
        F.count_if(winner == "B").alias("wins_b"),
        _percent(winner == "A").alias("wins_a_pct"),
        _percent(winner == "B").alias("wins_b_pct"),
        F.avg(f"{prefix}score_a_total").alias("mean_a"),
        F.avg(f"{prefix}score_b_total").alias("mean_b"),
    ]


def run_timings(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean seconds of both generators, the judge and the whole row."""
    columns = ("generation_time_a", "generation_time_b", "judge_time", "total_time")
    require_columns(df, [*by, *columns], "run_timings")
    return df.groupBy(*by).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def run_figures(df: DataFrame, by: Sequence[str] = (), tasks: str = "tasks", key: str = "us_id", prefix: str = "judge_") -> DataFrame:
    """``task_counts``, ``wins``, ``criterion_means`` and ``run_timings`` of a judged run from one aggregate.

    ``tasks`` holds the number of task rows a judged row stands for.
    """
    times = ("generation_time_a", "generation_time_b", "judge_time", "total_time")
    require_columns(df, [*by, key, tasks, *times], "run_figures")
    return df.groupBy(*by).agg(
        F.coalesce(F.sum(tasks), F.lit(0)).cast("long").alias("tasks"),
        F.count_distinct(F.when(F.col(tasks) > 0, F.col(key))).alias("task_stories"),
        *_wins(prefix),
        *_means(prefix, CRITERIA),
        *[F.avg(c).alias(f"mean_{c}") for c in times],
    )


def approval_report(df: DataFrame, by: Sequence[str] = (), prefix: str = "validacion_") -> DataFrame:
    """Approved rows, all rows, the share in percent and the mean total."""
    require_columns(df, [*by, f"{prefix}aprobado", f"{prefix}total"], "approval_report")
    return df.groupBy(*by).agg(
        F.count_if(f"{prefix}aprobado").alias("approved"),
        F.count(F.lit(1)).alias("total"),
        _percent(F.col(f"{prefix}aprobado")).alias("approved_pct"),
        F.avg(f"{prefix}total").alias("mean_total"),
    )


def task_counts(df: DataFrame, key: str = "us_id", by: Sequence[str] = ()) -> DataFrame:
    """Tasks and the distinct stories they come from."""
    require_columns(df, [*by, key], "task_counts")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("tasks"), F.count_distinct(key).alias("stories")
    )


def score_counts(df: DataFrame, by: Sequence[str] = (), prefix: str = "judge_") -> DataFrame:
    """How often each total occurs per group and generator (columns ``value``, ``n``).

    Whole totals from -5 to 50 give at most 56 rows per group and generator however
    many rows were judged, fractional ones a row each; distributions are read off it.
    Totals read as text (from result files) are taken as numbers first.
    """
    counted = (
        _numeric_totals(df, by, prefix)
        .groupBy(*by, *_totals(prefix))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*by, "n", F.inline(_sides(prefix)))
    )
    return (
        counted.filter(F.col("value").isNotNull())
        .groupBy(*by, "Gen", "value")
        .agg(F.sum("n").alias("n"))
    )


def _totals(prefix: str) -> list[str]:
    return [f"{prefix}score_{side}_total" for side in SIDES.values()]


def _numeric_totals(df: DataFrame, by: Sequence[str], prefix: str) -> DataFrame:
    """Group and totals of the judged rows, totals read as text (from result files) as numbers."""
    texts = [f.name for f in df.schema.fields if f.name in _totals(prefix) and f.dataType.typeName() == "string"]
    return coerce_numbers(df, texts).select(*by, *_totals(prefix))


def _sides(prefix: str) -> Column:
    return F.array(
        *[F.struct(F.lit(gen).alias("Gen"), F.col(total).alias("value")) for gen, total in zip(SIDES, _totals(prefix))]
    )


def box_stats(
    df: DataFrame, by: Sequence[str] = (), prefix: str = "judge_", reach: float = 1.5
) -> DataFrame:
    """Box-plot figures of the totals: quartiles, whiskers and number of outliers.

    A whisker ends at the outermost total within ``reach`` quartile ranges of
    the box, or at the box itself.  The figures, one row per group and generator,
    are written before they are returned.
    """
    value, inside = F.col("value"), F.col("value").between(F.col("low"), F.col("high"))
    keys = [*by, "Gen"]
    boxes = _with_box(df, by, prefix, reach).groupBy(*keys, "q1", "median", "q3")
    summed = boxes.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(F.when(value >= F.col("low"), value)).alias("lowest"),
        F.max(F.when(value <= F.col("high"), value)).alias("highest"),
        F.sum(F.when(inside, 0).otherwise(1)).alias("outliers"),
    )
    figures = summed.select(
        *keys,
        "rows",
        "q1",
        "median",
        "q3",
        F.least(F.col("lowest").cast("double"), "q1").alias("whisker_low"),
        F.greatest(F.col("highest").cast("double"), "q3").alias("whisker_high"),
        "outliers",
    )
    return materialize(figures, "box-figures")


def outliers(
    df: DataFrame, by: Sequence[str] = (), prefix: str = "judge_", reach: float = 1.5
) -> DataFrame:
    """Totals outside the whiskers with their frequency."""
    outside = ~F.col("value").between(F.col("low"), F.col("high"))
    far = _with_box(df, by, prefix, reach).filter(outside)
    return far.groupBy(*by, "Gen", "value").agg(F.count(F.lit(1)).alias("n"))


def quantiles(
    counted: DataFrame, keys: Sequence[str], shares: Mapping[str, float], value: str = "value", n: str = "n"
) -> DataFrame:
    """Per group the interpolated quantiles of ``value``, each row standing for ``n`` equal ones.

    ``counted`` has the columns ``__before`` (rows of the group with smaller values) of
    ``ranked``.  A quantile is read off the one or two rows whose ranks hold it, by
    aggregates that combine before they move, so no task gathers a group's values.
    """
    sizes = counted.groupBy(*keys).agg(F.sum(n).alias("__size"))
    return _read_off(_on_keys(counted, sizes, keys), keys, shares, value, n)


def _read_off(sized: DataFrame, keys: Sequence[str], shares: Mapping[str, float], value: str, n: str) -> DataFrame:
    held = []
    for name, share in shares.items():
        place = F.lit(share) * (F.col("__size") - 1)
        for end, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            holds = (F.col("__before") <= rank) & (rank < F.col("__before") + F.col(n))
            held.append(F.max(F.when(holds, F.col(value))).cast("double").alias(f"__{end}_{name}"))
        held.append(F.max(place - F.floor(place)).alias(f"__part_{name}"))
    read = sized.groupBy(*keys).agg(*held)
    low, high, part = ({s: F.col(f"__{x}_{s}") for s in shares} for x in ("low", "high", "part"))
    return read.select(*keys, *[(low[s] + (high[s] - low[s]) * part[s]).alias(s) for s in shares])


def ranked(counted: DataFrame, keys: Sequence[str], value: str = "value", n: str = "n") -> DataFrame:
    """Add ``__before``: how many of the group's rows have a smaller value.

    Rows are range-partitioned by group and value and the counts run inside each
    part, so a group with many distinct values spreads over tasks.
    """
    grouped = counted.withColumn("__group", F.struct(*keys))
    return running_total_before(grouped, "__group", [value], F.col(n), "__before").drop("__group")


def _on_keys(rows: DataFrame, figures: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Figures of a group on all its rows; null keys are a group like any other."""
    named = figures.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return rows.join(named, same).drop(*[f"__{k}" for k in keys])


def _with_box(df: DataFrame, by: Sequence[str], prefix: str, reach: float) -> DataFrame:
    """Every total with the quartiles of its group; the judged rows are read once.

    The totals are stored as they are, neither moved nor sorted.  Quartiles, one row per
    group and generator, are stored too.
    """
    keys = [*by, "Gen"]
    stored = materialize(_numeric_totals(df, by, prefix), "totals")
    rows = stored.select(*by, F.inline(_sides(prefix))).filter(F.col("value").isNotNull())
    box = materialize(select_quantiles(rows, keys, {"q1": 0.25, "median": 0.5, "q3": 0.75}), "quartiles")
    width = reach * (F.col("q3") - F.col("q1"))
    return _on_keys(rows, box.withColumns({"low": F.col("q1") - width, "high": F.col("q3") + width}), keys)


def select_quantiles(rows: DataFrame, keys: Sequence[str], shares: Mapping[str, float], value: str = "value") -> DataFrame:
    """Per group the exact interpolated quantiles of ``value`` (not null), by narrowing down instead of sorting.

    A sketch names values a little below and above each quantile.  They cut a group into
    bands, the values themselves being bands of their own; every band's rows are counted,
    and only those that hold a wanted rank are sorted.  The counts are exact, so a poor sketch
    would only leave more rows to sort.  ``rows`` is read three times: store it first.
    """
    near = sorted({max(0.0, min(1.0, share + d)) for share in shares.values() for d in (-_BAND, _BAND)})
    sketch = rows.groupBy(*keys).agg(F.percentile_approx(value, near, _ACCURACY).alias("__cuts"))
    banded = _on_keys(rows, materialize(sketch, "cuts"), keys)
    cuts = [F.get("__cuts", F.lit(k)) for k in range(len(near))]
    band = reduce(add, [(F.col(value) >= c).cast("int") + (F.col(value) > c).cast("int") for c in cuts])
    banded = banded.select(*keys, value, band.alias("__band"))
    counts = materialize(banded.groupBy(*keys, "__band").agg(F.count(F.lit(1)).alias("__rows")), "bands")
    whole, below = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("__band")
    counts = counts.withColumns(
        {"__size": F.sum("__rows").over(whole), "__below": F.sum("__rows").over(below) - F.col("__rows")}
    )
    places = [F.lit(share) * (F.col("__size") - 1) for share in shares.values()]
    ranks = [end(place) for place in places for end in (F.floor, F.ceil)]
    wanted = reduce(or_, [(F.col("__below") <= r) & (r < F.col("__below") + F.col("__rows")) for r in ranks])
    held = counts.filter(wanted).drop("__rows")
    few = _on_keys(banded, held, [*keys, "__band"])
    counted = few.groupBy(*keys, "__band", "__size", "__below", value).agg(F.count(F.lit(1)).alias("n"))
    placed = ranked(materialize(counted, "near-quantiles"), [*keys, "__band"], value)
    return _read_off(placed.withColumn("__before", F.col("__before") + F.col("__below")), keys, shares, value, "n")


def _grouped(df: DataFrame, by: Sequence[str], prefix: str, exclude_failed: bool):
    if exclude_failed:
        df = df.filter(~F.col(f"{prefix}score_a_total").eqNullSafe(F.lit(FAILED_TOTAL)))
    return df.groupBy(*by)


def _metrics(threshold: float, prefix: str, partial: bool = False) -> list[Column]:
    def present(name: str) -> Column | None:
        return ~F.array_contains("missing_columns", name) if partial else None

    columns = []
    for gen, side in SIDES.items():
        total = F.col(f"{prefix}score_{side}_total")
        columns += [
            F.avg(total).alias(f"{gen}_Mean"),
            F.stddev_samp(total).alias(f"{gen}_Std"),
            _percent(total >= threshold, present(f"{prefix}score_{side}_total")).alias(f"{gen}_Pass"),
            _percent(F.col(f"{prefix}winner") == WINNERS[gen], present(f"{prefix}winner")).alias(f"{gen}_Win"),
        ]
    return columns


def _means(prefix: str, criteria: Sequence[str]) -> list[Column]:
    return [
        F.avg(f"{prefix}score_{side}_{c}").alias(f"{gen}_{c.capitalize()}")
        for gen, side in SIDES.items()
        for c in criteria
    ]

