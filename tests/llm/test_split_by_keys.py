from pyspark.sql import functions as F

from quillstat.llm import exact_dedup
from quillstat.llm.common import cut, split_by_keys


def test_no_row_of_a_key_is_left_out_and_few_others_come_along(spark):
    df = spark.range(20000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x" * 50).alias("body"))
    keys = cut(df.filter("k IS NULL OR k % 40 = 0").select("k"))
    maybe, rest = split_by_keys(df, keys, "k")
    assert maybe.columns == rest.columns == ["k", "body"]
    assert maybe.count() + rest.count() == 20000 and rest.filter("k IS NULL OR k % 40 = 0").isEmpty()
    assert 500 <= maybe.count() < 500 + 0.1 * 19500
    none, every = split_by_keys(df, keys.filter("false"), "k")
    assert none.isEmpty() and every.count() == 20000


def test_rows_without_a_copy_are_not_shuffled(spark):
    """The join of whole rows with the repeated hashes reads the rows that may be repeated only."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.greatest(F.col("id"), F.lit(100)).cast("string")).alias("text"))
    kept = exact_dedup.keep_first(df)
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(101, 4000)]
    assert "_bits" in kept._jdf.queryExecution().optimizedPlan().toString()
