"""Both sides of a merge into a table are moved once, to its buckets; packed batch files read like plain ones."""

import glob
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerline.operators import merge
from ledgerline.sources import cdc_files
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def test_merge_moves_each_side_once(spark, tmp_path, monkeypatch):
    spec = merge.MergeSpec(on=("k", "t"), update=("v",), insert=("k", "t", "v"))
    table, schema = f"{tmp_path}/t", "k string, t int, v int, created_at timestamp_ntz"
    old = spark.createDataFrame([(f"k{n}", n % 3, n, T0) for n in range(50)] + [(None, 1, 1, T0)], schema)
    new = spark.createDataFrame([(f"k{n}", n % 3, -n) for n in range(40, 60)] + [(None, 1, 2)], "k string, t int, v int")
    merge.write_table(old, table, spec.on, 5)
    plans, plain = [], merge._by_bucket

    def look(df, *args, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, *args, **kw)

    monkeypatch.setattr(merge, "_by_bucket", look)
    assert merge.merge_into_table(spark, table, new, spec, 5) == 21
    assert "Join" in plans[0] and "ENSURE_REQUIREMENTS" not in plans[0]
    want = merge.merge_upsert(old, new, spec)
    assert rows(merge.read_table(spark, table).select(*old.columns)) == rows(want)
    wrong = merge.read_table(spark, table).where(F.col(merge.BUCKET_COL) != merge.key_bucket(spec.on, 5))
    assert wrong.count() == 0


def test_packed_files_read_like_plain_ones(spark, tmp_path):
    log = spark.createDataFrame([("I", "a", 'x "1",\n2|3', T0), ("U", "b", None, T0), ("D", "c", "", T0 + timedelta(days=1))],
                                "Op string, id string, v string, file_time timestamp_ntz")
    got = {}
    for how in ("none", "gzip"):
        path = f"{tmp_path}/{how}"
        cdc_files.write_cdc_batches(log, path, compression=how)
        cdc_files.write_full_load(log.drop("file_time"), path, compression=how)
        got[how] = [rows(cdc_files.read_cdc(spark, path)), rows(cdc_files.read_cdc(spark, path, full=True)), rows(cdc_files.read_cdc(spark, path, multiline="split"))]
    assert got["gzip"] == got["none"] and got["none"][0] == rows(log)
    assert glob.glob(f"{tmp_path}/gzip/batch=*/*.csv.gz") and not glob.glob(f"{tmp_path}/gzip/*/*.csv")


def test_own_files_are_packed(spark):
    from ledgerline.session import materialize
    assert all(".zstd." in f for f in materialize(spark.range(10), "packed").inputFiles())
