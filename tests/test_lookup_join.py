from pyspark.sql import functions as F

from caseweave.session import lookup_join


def test_repeated_lookup_is_not_broadcast(spark):
    """Spark takes the lookup, repeated for every salt, for as small as the lookup itself, and would send all of it to the driver."""
    left = spark.range(300).select(F.col("id").alias("i"), (F.col("id") % 7).alias("k"))
    side = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how, rows in (("inner", [(i, i % 7, i % 7 * 10) for i in range(300) if i % 7 < 5]),
                      ("left", [(i, i % 7, i % 7 * 10 if i % 7 < 5 else None) for i in range(300)])):
        joined = lookup_join(left, side, "k", how, salts=64, small=False)
        assert sorted(tuple(r) for r in joined.select("i", "k", "v").collect()) == rows
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
