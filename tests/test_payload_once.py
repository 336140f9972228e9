"""A payload is judged with one parse, however the judgement is used."""

from pyspark.sql import functions as F

from ledgerline import functions as fn
from tests.conftest import rows


def test_filters_do_not_parse_again(spark):
    k = F.col("k")
    raw = F.when(k == 1, F.lit("'{\"amount\": 1}'")).when(k == 2, F.lit("[1]")).otherwise(F.lit('{"amount": "many"}'))
    good, dead = fn.split_payloads(spark.range(1, 4).withColumnRenamed("id", "k").withColumn("raw", raw), "raw", "k")
    # The filter is pushed below the column with its expression; the dead letters' reason is told once more, for these rows alone.
    assert [side._jdf.queryExecution().executedPlan().toString().count("parseJson(") for side in (good, dead)] == [1, 2]
    assert [r["payload"]["amount"] for r in good.collect()] == [1]
    assert rows(dead) == [(2, "[1]", "not an object"), (3, '{"amount": "many"}', "amount is not int")]


def test_outer_quotes_at_line_ends(spark):
    texts = ["'a'", "'", "''", "'a'\n", "'a'\r\n", "a' ", "'a\n'", "", "a", "'é'", None, "'a'\n\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(fn.strip_outer_quote("t").eqNullSafe(F.regexp_replace("t", "^'|'$", "")).alias("same"))
    assert all(r["same"] for r in got.collect())
