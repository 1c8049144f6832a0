"""Tables that are written once."""

from pyspark.sql import functions as F

from delaykit.operators.lookups import settled


def test_a_settled_table_knows_nothing_of_its_history(spark):
    rows = spark.range(20).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(12)])
    kept = settled(rows.withColumn("fold", F.crc32(F.concat_ws("|", *rows.columns).cast("binary")) % 5))
    # What the optimizer knows of a column is said again for every new name of its inputs.
    renamed = kept.select("fold", *[F.col(c).alias(f"x{i}") for i, c in enumerate(rows.columns)])
    assert renamed._jdf.queryExecution().optimizedPlan().constraints().size() == 0
    assert renamed.count() == 20
    assert kept.dtypes == [*rows.dtypes, ("fold", "bigint")]


def test_a_settled_table_may_be_empty(spark):
    assert settled(spark.range(0).withColumn("a", F.lit("x"))).collect() == []
