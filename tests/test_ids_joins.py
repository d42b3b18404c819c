import pytest
from pyspark.sql import functions as F

from specflow.operators import ids, joins
from specflow.session import partitions_for


def test_dense_id_follows_order(spark):
    df = spark.range(5000).select(F.reverse(F.format_string("%05d", "id")).alias("k")).repartition(9)
    rows = ids.dense_id(df, ["k"], unique=True).collect()
    assert sorted(r.us_id for r in rows) == list(range(1, 5001))
    by_id = [r.k for r in sorted(rows, key=lambda r: r.us_id)]
    assert by_id == sorted(by_id)


def test_dense_id_with_ties_and_copies(spark):
    # two keys only, and a third of all rows are copies of one row
    df = spark.range(6000).select(
        (F.col("id") % 2).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("v"),
    ).repartition(8)
    numbered = ids.dense_id(df, ["k"], "n", partitions=8)
    rows = numbered.collect()
    assert sorted(r.n for r in rows) == list(range(1, 6001))
    ordered = [r.k for r in sorted(rows, key=lambda r: r.n)]
    assert ordered == sorted(ordered)
    # the ids are pinned: another action sees the same
    again = {(r.k, r.v, r.n) for r in numbered.collect()}
    assert again == {(r.k, r.v, r.n) for r in rows}


def test_tied_keys_spread_over_partitions(spark):
    copies = spark.range(8000, numPartitions=8).select(F.lit("same").alias("k"))
    ordered = ids.order_rows(copies, ["k"], partitions=8)
    sizes = [r.n for r in ordered.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 3000


def test_dense_id_of_nothing(spark):
    assert ids.dense_id(spark.createDataFrame([], "k int"), ["k"]).count() == 0


def test_batches_and_splits(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "n")
    rows = df.select("n", ids.batch_id("n", 4).alias("b"), ids.split_id("n", 3).alias("s")).collect()
    assert [r.b for r in rows] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]
    assert [r.s for r in rows] == [0, 1, 2, 0, 1, 2, 0, 1, 2, 0]
    assert ids.batch_count(df, 4).first().num_batches == 3
    for call in (lambda: ids.batch_id("n", 0), lambda: ids.split_id("n", 0), lambda: ids.batch_count(df, 0)):
        with pytest.raises(ValueError):
            call()


def test_join_generations_and_tasks(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(1, "y"), (2, "z")], "id int, b string")
    assert [tuple(r) for r in joins.join_generations(a, b, "id", ["b"]).collect()] == [(1, "x", "y")]
    left = spark.createDataFrame([(1, 1, "s", "A1"), (1, 2, "s", "A2")], "us_id int, task_id int, input string, task_generator_a string")
    right = spark.createDataFrame([(1, 1, "s", "B1"), (2, 1, "t", "B2")], "us_id int, task_id int, input string, task_generator_b string")
    rows = sorted(map(tuple, joins.join_tasks(left, right).collect()), key=lambda r: r[:2])
    assert rows == [(1, 1, "s", "A1", "B1"), (1, 2, "s", "A2", None), (2, 1, "t", None, "B2")]


def test_tasks_follow_the_size_of_the_table(spark, tmp_path):
    spark.range(2_000).selectExpr("id", "sha2(string(id), 256) AS pad").write.parquet(f"{tmp_path}/small")
    spark.range(60_000).selectExpr("id", "sha2(string(id), 256) AS pad").write.parquet(f"{tmp_path}/large")
    small, large = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("small", "large"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        tasks = [partitions_for(t) for t in (small, large)]
        assert tasks[0] == spark.sparkContext.defaultParallelism < 20 < tasks[1]
        # a join reads both sides, and no more
        assert partitions_for(large.join(small, "id")) <= sum(tasks)
        assert ids.order_rows(large, ["pad"]).rdd.getNumPartitions() == tasks[1]
        numbered = ids.dense_id(large, ["pad"], "n").select("id", "n").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, numbered)) == sorted(map(tuple, ids.dense_id(large, ["pad"], "n").select("id", "n").collect()))
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")
    assert partitions_for(unknown) == int(spark.conf.get("spark.sql.shuffle.partitions"))
