"""How often the training plans compute the rows they read several times."""

from msgtriage.plans.training import train_and_evaluate


def _rows(spark, n=60):
    words = ("water", "food", "shelter", "medicine", "rain", "storm")
    rows = [(i, " ".join(words[(i * k) % 6] for k in range(1, 6)), i % 2, int(i % 3 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, message string, related int, toxic int")


def _counted(df, seen):
    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(passed, df.schema)


def test_training_run_reads_its_split_from_storage(spark):
    seen = spark.sparkContext.accumulator(0)
    report, _ = train_and_evaluate(spark, _counted(_rows(spark), seen), ["related", "toxic"], upsample_targets=("toxic",), downsample_target="related")
    assert {r.label for r in report.collect()} == {"related", "toxic"}
    assert seen.value <= 120  # counted and indexed, once each
