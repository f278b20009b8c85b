from pyspark.sql import functions as F

from msgtriage.session import checkpoint_root, ensure_parallelism, materialize


def test_checkpoint_root_uses_session_setting(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")


def test_materialize_round_trip(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    back = materialize(df, "unit")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert checkpoint_root(spark) in back.inputFiles()[0]


def test_ensure_parallelism_only_spreads_small_inputs(spark):
    one = spark.range(10).coalesce(1)
    spread = ensure_parallelism(one, 4)
    assert spread.rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(8)
    assert ensure_parallelism(many, 4).rdd.getNumPartitions() == 8


def test_stored_table_follows_its_inputs(spark, tmp_path):
    from msgtriage.session import drop_stored, input_version, materialize_once

    path, built = str(tmp_path / "in"), []

    def build():
        built.append(1)
        return spark.read.parquet(path)

    spark.range(3).write.parquet(path)
    first = input_version(spark, [path])
    assert materialize_once(spark, "t", first, build).count() == materialize_once(spark, "t", first, build).count() == 3
    spark.range(5).write.mode("overwrite").parquet(path)
    second = input_version(spark, [path])
    assert second != first and materialize_once(spark, "t", second, build).count() == 5 and len(built) == 2
    drop_stored(spark)
    assert materialize_once(spark, "t", second, build).count() == 5 and len(built) == 3
