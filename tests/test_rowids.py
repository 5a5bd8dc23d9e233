from pyspark.sql import Window
from pyspark.sql import functions as F

from tollgate.operators.rowids import dense_row_numbers, row_ids


def test_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    out = dense_row_numbers(df, ["g", "k"], num_partitions=7)
    ref = df.select("*", F.row_number().over(Window.orderBy("g", "k")).alias("row_num"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, ref.collect()))


def test_identical_rows_split_across_partitions(spark):
    # one value holding every row: ids stay dense 1..n
    df = spark.range(0, 3000).select(F.lit("hot").alias("k"))
    ids = [r.row_num for r in dense_row_numbers(df, num_partitions=6).collect()]
    assert sorted(ids) == list(range(1, 3001))


def test_prefix_and_nulls_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    got = {r.k: r.row_id for r in row_ids(df, 42).collect()}
    assert got == {None: "42_1", "a": "42_2", "b": "42_3"}
