import pytest
from pyspark.sql import functions as F

from specflow.functions.text import CUT
from specflow.operators import tasks

SPLITS = [
    # numbered, preamble dropped
    ("Here:\n1. summary: A\ndescription: d\n\n2. summary: B", ["summary: A\ndescription: d", "summary: B"]),
    # every marker style, labels, bold, missing space, indents
    (
        "1) **summary:** A\n  a. (Optional) Summary: B\nb) summary: C\n8.summary: D\n\t2. **summary**: E",
        ["summary: A", "(Optional) Summary: B", "summary: C", "8.summary: D", "summary: E"],
    ),
    # blank lines of all kinds between tasks
    ("1. summary: A\n\n \n\t\n2. summary: B\r\n \n3. summary: C", ["summary: A", "summary: B", "summary: C"]),
    # a plain first summary counts as a task
    ("summary: A\n2. summary: B", ["summary: A", "summary: B"]),
    ("SUMMARY: A\n2. summary: B", ["SUMMARY: A", "summary: B"]),
    # upper case other than the first letter is no break
    ("1. summary: A\n2. SUMMARY: B\n3. summary: C", ["summary: A\n2. SUMMARY: B", "summary: C"]),
    # a numbered line without the label stays with its task
    ("1. summary: A\n2. Other\n3. summary: C", ["summary: A\n2. Other", "summary: C"]),
    # a single numbered task is kept without its preamble
    ("Sure!\n1. summary: A", ["summary: A"]),
    # fallback 1: bare labels at line start, indented ones do not count
    ("Intro\nsummary: A\n  summary: no\n**summary**: B", ["summary: A\n  summary: no", "summary: B"]),
    # fallback 2: lettered sub-numbers
    ("Plan\na) 4.1. Create x\nb) 4.2. Build y", ["4.1. Create x", "4.2. Build y"]),
    ("summary: Core\na) 4.1. Create x\n  b) 4.2. Build y", ["summary: Core", "4.1. Create x", "4.2. Build y"]),
    # one bare label and nothing else: the whole answer
    ("Intro\nsummary: A", ["Intro\nsummary: A"]),
    ("no list here", ["no list here"]),
    ("  \n ", [""]),
    ("", [""]),
    (None, [None]),
    # the reserved cut character inside a text
    (f"1. summary: A{CUT}B\n2. summary: C", [f"summary: A{CUT}B", "summary: C"]),
    # other line separators are no newlines
    ("1. summary: A 2. summary: B", ["summary: A 2. summary: B"]),
    # numbers of other scripts
    ("١. summary: A\n٢. summary: B", ["summary: A", "summary: B"]),
    # bold at line ends and round descriptions
    ("1. **summary:** **A**\n**description**: b**\n2. **Summary: C**", ["summary: **A\ndescription: b", "Summary: C"]),
    # sub-numbers after a letter: with a dot kept, without removed
    ("1. summary: x\n2. summary: y\n", ["summary: x", "summary: y"]),
    ("a) 4.1 Create", ["Create"]),
    ("a) 4.1. Create", ["4.1. Create"]),
]


def explode_one(spark, text, **options):
    df = spark.createDataFrame([(1, text)], "us_id int, tasks string")
    rows = tasks.explode_tasks(df, group_by="us_id", unique_group=True, **options).collect()
    return [r.task for r in sorted(rows, key=lambda r: r.task_id)]


def test_split_table(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(SPLITS)], "us_id int, tasks string")
    rows = tasks.explode_tasks(df, group_by="us_id", unique_group=True).collect()
    for i, (text, want) in enumerate(SPLITS):
        got = [r.task for r in sorted((r for r in rows if r.us_id == i), key=lambda r: r.task_id)]
        assert got == want, text


def test_strict_numbers(spark):
    assert explode_one(spark, "a) 4.1. Create", strict_numbers=True) == ["Create"]
    assert explode_one(spark, "8.summary: A", strict_numbers=True) == ["summary: A"]


def test_split_is_stripped(spark):
    df = spark.createDataFrame([("1. summary: A  \n2. summary: B",)], "tasks string")
    assert tasks.split_tasks(df, "tasks").first().task_list == ["1. summary: A", "2. summary: B"]


def test_columns_and_order(spark):
    df = spark.createDataFrame([("t", 7, "x")], "tasks string, us_id int, other string")
    exploded = tasks.explode_tasks(df, group_by="us_id", unique_group=True)
    assert exploded.columns == ["us_id", "other", "task_id", "task"]
    same = tasks.explode_tasks(df, output_column="tasks", group_by="us_id", unique_group=True)
    assert same.columns == ["us_id", "other", "task_id", "tasks"]


def test_empty_input_keeps_schema(spark):
    df = spark.createDataFrame([], "us_id int, tasks string")
    for options in ({"group_by": "us_id", "unique_group": True}, {"order_by": ["us_id"]}):
        exploded = tasks.explode_tasks(df, **options)
        assert exploded.columns == ["us_id", "task_id", "task"]
        assert exploded.count() == 0


def test_global_numbers(spark):
    df = spark.range(1000).select(
        F.col("id").alias("us_id"),
        F.concat_ws("\n", F.transform(F.sequence(F.lit(1), F.col("id") % 4 + 2), lambda i: F.concat(i.cast("string"), F.lit(". summary: t")))).alias("tasks"),
    )
    rows = tasks.explode_tasks(df, order_by=["us_id"]).collect()
    rows.sort(key=lambda r: r.task_id)
    assert [r.task_id for r in rows] == list(range(1, len(rows) + 1))
    assert [r.us_id for r in rows] == sorted(r.us_id for r in rows)
    assert len(rows) == sum(i % 4 + 2 for i in range(1000))


def test_group_numbers_with_one_huge_group(spark):
    # a third of the rows in one group, a third of the rest without a group
    data = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else (None if i % 3 == 1 else f"g{i % 100}")
        data.append((group, i, "\n".join(f"{k}. summary: {i}" for k in range(1, i % 3 + 3))))
    df = spark.createDataFrame(data, "g string, at int, tasks string").repartition(7)
    rows = tasks.explode_tasks(df, group_by="g", order_by=["at"], partitions=16).collect()
    want = {}
    for group, at, text in sorted(data, key=lambda d: d[1]):
        for _ in text.split("\n"):
            want.setdefault(group, []).append(at)
    got = {}
    for r in sorted(rows, key=lambda r: r.task_id):
        got.setdefault(r.g, []).append((r.task_id, r.at))
    assert {g: [a for _, a in v] for g, v in got.items()} == want
    assert all([t for t, _ in v] == list(range(1, len(v) + 1)) for v in got.values())


def test_order_is_required(spark):
    df = spark.createDataFrame([("t", 1)], "tasks string, us_id int")
    with pytest.raises(ValueError, match="order_by"):
        tasks.explode_tasks(df)
    with pytest.raises(ValueError, match="order_by"):
        tasks.explode_tasks(df, group_by="us_id")


def test_task_fields(spark):
    df = spark.createDataFrame(
        [
            (1, "summary: A b\ndescription: c\nd"),
            (2, "**Summary:** x"),
            (3, "4.1. Create"),
            (4, "summary: mentions description: inline"),
        ],
        "id int, task string",
    )
    rows = {r.id: (r.task_summary, r.task_description) for r in tasks.task_fields(df).collect()}
    assert rows[1] == ("A b", "c\nd")
    assert rows[3] == (None, None)
    assert rows[4] == ("mentions description: inline", None)


def test_compare_pads_the_shorter_side(spark):
    df = spark.createDataFrame(
        [(1, "s", "1. summary: A\n2. summary: B", "only"), (2, "s", None, "x")],
        "us_id int, input string, tasks_generator_a string, tasks_generator_b string",
    )
    rows = sorted(map(tuple, tasks.compare_tasks(df).collect()), key=lambda r: r[:2])
    assert rows == [
        (1, 1, "s", "summary: A", "only"),
        (1, 2, "s", "summary: B", None),
        (2, 1, "s", None, "x"),
    ]
