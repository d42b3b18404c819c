"""Compare Spark rows with DuckDB rows, whatever their order."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


def check(spark_df, con, sql):
    """Return a text naming the first difference, or None."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: str(d[1]) for d in expected.description}
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    wanted = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}
    for field in spark_df.schema.fields:
        kind = wanted.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kind != kinds[field.name]:
            return f"type of {field.name}: {kind} != {kinds[field.name]}"
    theirs = rows_of(names, expected.fetchall())
    ours = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a!r:.700} != {b!r:.700}"
    return None
