"""Headers, inferred types, pruned listings and scans, restricted joins, metrics, SQL functions, dead letters."""

import fnmatch
import os
import random
from contextlib import nullcontext
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline import functions as fn
from ledgerline.functions.sql import register_sql_functions
from ledgerline.operators import joins, merge, metrics, watermark
from ledgerline.operators.merge import LOAD_COL, MergeSpec, merge_into_table, read_table, write_table
from ledgerline.session import shared_dir
from ledgerline.sources import cdc_files as C
from tests.conftest import rows


def _file(path, name, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
    with open(f"{path}/{name}", "w", encoding=encoding) as f:
        f.write(text)


def _layouts(spark, name="lay outs"):
    path = shared_dir(spark, name).removeprefix("file:")
    _file(path, "batch=20240101-000000/a.csv", "Op|k|v\nI|1|one\nI|2|two\n")
    _file(path, "batch=20240101-000000/b.csv", 'v|"Op"|k|extra\nthree|U|3|x\n', "utf-8-sig")
    _file(path, "batch=20240102-000000/c.csv", "Op|k|v\nI|4|\"li\nne\"\n")
    _file(path, "batch=20240102-000000/empty.csv", "")
    _file(path, "batch=20240103-000000/head-only.csv", "Op|other\n")
    _file(path, "20240104-000000123.csv", "k|Op\n5|I\n")
    return path


def test_files_are_grouped_by_header(spark):
    path = _layouts(spark)
    groups = C.headers(spark, C.list_files(spark, path))
    assert {names: len(files) for names, files in groups.items()} == {("Op", "k", "v"): 2, ("v", "Op", "k", "extra"): 1, ("Op", "other"): 1, ("k", "Op"): 1}
    got = C.read_cdc(spark, path, ["Op", "k", "v", "extra"], {"k": "int"})
    assert sorted(tuple(r)[:4] for r in got.collect() if r["v"] is not None) == [("I", 1, "one", None), ("I", 2, "two", None), ("I", 4, "li\nne", None), ("U", 3, "three", "x")]
    assert got.where("k = 5").first()["file_time"] == datetime(2024, 1, 4)
    assert set(C.read_cdc(spark, path).columns) == {"Op", "k", "v", "extra", "other", "file_time"}
    assert "other" not in C.read_cdc(spark, path, ["k"], since="2024-01-03 00:00:00", optional=("other", "Op")).columns


def test_headers_of_files_that_share_a_task(spark, monkeypatch):
    path = _layouts(spark, "shared-task")
    whole = C.headers(spark, C.list_files(spark, path))
    monkeypatch.setattr(C, "_one_file_per_task", lambda s: nullcontext())
    assert C.headers(spark, C.list_files(spark, path)) == whole


def test_header_that_names_a_column_twice(spark):
    path = shared_dir(spark, "twice").removeprefix("file:")
    _file(path, "batch=20240101-000000/a.csv", "Op|k|k\nI|1|2\n")
    with pytest.raises(ValueError, match="twice"):
        C.read_cdc(spark, path, ["k"])


@pytest.mark.parametrize("size", [64, 300, 1 << 20])
def test_files_are_split_inside_records(spark, size):
    """Splits far smaller than records: every way of breaking them gives the rows of the one-task reader."""
    rng = random.Random(size)
    path = shared_dir(spark, "splits").removeprefix("file:")
    values = ["", "plain", "two\nlines", "a \"quoted\" part\nand |", "x" * 200 + "\n" * 5 + "y", "\n", '""', "été\n", "\\N not null", None]
    for f in range(3):
        text = "Op|k|v\n"
        for k in range(60):
            v = rng.choice(values)
            text += f"I|{f}.{k}|" + ("\\N" if v is None else '"' + v.replace('"', '""') + '"' if v != "plain" else v) + "\n"
        _file(path, f"batch=2024010{f + 1}-000000/a.csv", text if f else text.rstrip("\n"))
    _file(path, "batch=20240105-000000/crlf.csv", 'Op|k|v\r\nI|c.1|plain\r\nI|c.2|"q"\r\n')
    want = rows(C.read_cdc(spark, path, ["Op", "k", "v"]).where("k not like 'c.%'"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, str(size))
        got = C.read_cdc(spark, path, ["Op", "k", "v"], multiline="split")
        assert rows(got.where("k not like 'c.%'")) == want and len(want) == 180
        assert sorted((r["k"], r["v"]) for r in got.where("k like 'c.%'").collect()) == [("c.1", "plain"), ("c.2", "q")]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_files(spark):
    assert C.read_cdc(spark, shared_dir(spark, "none"), ["Op", "k"], {"k": "int"}).dtypes == [("Op", "string"), ("k", "int"), ("file_time", "timestamp_ntz")]


def test_globs_of_later_names():
    rng = random.Random(1)
    stamps = [datetime(2000 + rng.randint(0, 40), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23), rng.randint(0, 59), rng.randint(0, 59)).strftime("%Y%m%d-%H%M%S") for _ in range(300)]
    for since in stamps[:40]:
        globs = C.stamps_from(since)
        assert {s for s in stamps if any(fnmatch.fnmatch(s, g) for g in globs)} == {s for s in stamps if s >= since}


def test_only_later_folders_are_listed(spark):
    path = shared_dir(spark, "later").removeprefix("file:")
    for day in range(1, 9):
        _file(path, f"batch=2024010{day}-000000/a.csv", f"Op|k\nI|{day}\n")
    assert [os.path.basename(os.path.dirname(f)) for f in C.list_files(spark, path, since="2024-01-06 00:00:00")] == ["batch=20240107-000000", "batch=20240108-000000"]
    assert C.pending_batches(spark, path, "2024-01-07 00:00:00").count() == 1
    assert C.pending_batches(spark, path, "2025-01-07 00:00:00").count() == 0


def test_type_lattice(spark):
    columns = {
        "int": ["1", "-20", None, ""], "bigint": ["1", "3000000000"], "decimal(38,0)": ["1", "12345678901234567890123"],
        "double": ["1", "2.5", "-1e3", ".5"], "date": ["2024-01-31", None], "timestamp_ntz": ["2024-01-31", "2024-01-31 10:00:00.5", "2024-01-31T10:00:00"],
        "boolean": ["true", "FALSE"], "string": ["1", "2024-01-31"], "void": [None, ""], "bad date": ["2024-02-31"], "text": ["a b"], "number text": ["1", "1 apple"]}
    n = max(map(len, columns.values()))
    names = list(columns)
    df = spark.createDataFrame([tuple(columns[c][i] if i < len(columns[c]) else None for c in names) for i in range(n)], ", ".join(f"`{c}` string" for c in names)).repartition(3)
    masks = df.agg(*C.column_types(names)).first()
    got = {c: C.narrowest(masks[c]) for c in names}
    assert got == {c: c if c in C.LATTICE else "string" for c in names}


def test_infer_cdc_types_what_it_reads(spark):
    path = _layouts(spark, "infer")
    df, types = C.infer_cdc(spark, path, ["Op", "k", "v", "extra"], forced={"extra": "double"})
    assert types == {"Op": "string", "k": "int", "v": "string", "extra": "double"}
    assert dict(df.dtypes)["k"] == "int" and df.count() == 5 and "csv" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


# --- scans and joins ---------------------------------------------------------------

SPEC = MergeSpec(("k",), ("v", "created_at"), ("k", "v", "created_at"))


def _loaded(spark, n, v, shift="0"):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(v).alias("v"), F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, cast(id % 12 + {shift} as int))").alias("created_at"))


def _files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName().startswith("Adaptive") else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_watermark_prunes_files_and_merges_leave_nothing_behind(spark):
    path = shared_dir(spark, "months")
    write_table(_loaded(spark, 1200, "old"), path, ("k",), 3, by_load=True)
    table = read_table(spark, path)
    assert _files_read(watermark.scan_incremental(table, "created_at", "2024-11-30T00:00:00")) <= 6 < _files_read(table)
    late = watermark.scan_incremental(table, "created_at", "2024-11-30T00:00:00")
    assert late.count() == 100 and LOAD_COL not in late.columns
    # All rows of one bucket move to another month.
    moved = _loaded(spark, 1200, "new", "12").where(merge.key_bucket(("k",), 3) == 1)
    untouched = {f for f in table.inputFiles() if "key_bucket=1/" not in f}
    merge_into_table(spark, path, moved, SPEC, 3)
    after = read_table(spark, path)
    assert after.count() == 1200 and after.where("v = 'new'").count() == moved.count()
    assert untouched == {f for f in after.inputFiles() if "key_bucket=1/" not in f}
    assert {r[0] // 100 for r in after.where("key_bucket = 1").select(LOAD_COL).distinct().collect()} == {2025}


def test_bloom_filter_keeps_all_matches_and_few_others(spark):
    keys = spark.range(0, 20_000).select((F.col("id") * 37).cast("string").alias("k"))
    rows_ = spark.range(0, 740_000).select(F.col("id").cast("string").alias("k"), F.lit("wide").alias("v"))
    found = joins.restrict_to(rows_, keys.unionByName(spark.createDataFrame([(None,)], "k string")), "k", most=1000)
    n = found.count()
    assert found.join(keys, "k", "left_semi").count() == 20_000 and n <= 20_400
    assert found.columns == ["k", "v"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") <= 2  # those of the keys alone
    assert joins.restrict_to(rows_, keys, "k", most=1000, words=100) is rows_


def test_bloom_filter_of_another_key_type(spark):
    rows_ = spark.range(100).select(F.col("id").alias("k"))
    found = joins.restrict_to(rows_, spark.createDataFrame([(3,), (50,)], "other int"), "k", "other", most=1)
    assert {3, 50} <= {r["k"] for r in found.collect()} and found.count() < 20


def test_purchase_job_restricts_refunds_and_events(spark, monkeypatch):
    from ledgerline.plans import jobs
    seen = []
    real = jobs.restrict_to
    monkeypatch.setattr(jobs, "restrict_to", lambda df, inc, key, *a: seen.append(key) or real(df, inc, key, *a))
    import __spark_entry__ as E
    E.queries()["incremental_purchases"](spark, "/root/testdata/sf0.001").collect()
    assert {"payment_intent_id", "user_email"} <= set(seen)


def test_figures_are_taken_as_rows_are_written(spark):
    df, figures = metrics.observed(spark.range(100).where("id % 3 = 0"), "x", n=F.count(F.lit(1)), top=F.max("id"))
    assert "CollectMetrics" in df._jdf.queryExecution().executedPlan().toString()
    df.write.format("noop").mode("overwrite").save()
    assert figures() == {"n": 34, "top": 99}


# --- SQL functions and dead letters ------------------------------------------------

def test_sql_functions_are_the_column_functions(spark):
    names = register_sql_functions(spark)
    tags = [None, "", "homeRenewal", "homeRenewalNew", "HOMERENEWAL", "psdTrainX", "PSDTRAIN", "autoNew"]
    data = [(t, c, a, r, datetime(2022, 10, d), s) for t in tags for c, a, r, d, s in
            [("Add-on", 10.0, 10.0, 30, "ca"), ("x", 99.995, None, 31, "C A"), (None, None, 1.0, 31, "new york"), ("Add-on", 0.5, 0.5, 31, None)]]
    df = spark.createDataFrame(data, "tag string, category string, amount double, refunded double, at timestamp_ntz, state string")
    flags = fn.purchase_flags("tag", "category")
    later = F.col("at") + F.make_dt_interval(F.lit(0), F.lit(24))
    want = df.withColumns({**{f"c_{k}": v for k, v in flags.items()}, "c_fee": fn.processing_fee("amount"), "c_state": fn.state_name("state"),
                           "c_short": fn.is_fully_refunded_short_term("amount", "refunded", "at", later), "c_full": fn.is_full_refund("amount")})
    want = want.withColumn("c_cost", fn.operational_costs("c_has_appointment", "c_is_full_fare", "c_is_renewal", "c_is_addon", "at"))
    want.createOrReplaceTempView("sql_function_cases")
    got = spark.sql("""
        SELECT *, is_full_fare(tag) = c_is_full_fare AND is_renewal(tag) = c_is_renewal AND is_renewal_new(tag) <=> c_is_renewal_new
          AND is_other(tag) = c_is_other AND is_addon(category) = c_is_addon AND has_appointment(tag) <=> c_has_appointment
          AND processing_fee(amount) <=> c_fee AND state_name(state) = c_state AND is_full_refund(amount) <=> c_full
          AND is_fully_refunded_short_term(amount, refunded, at, at + INTERVAL 24 HOURS) = c_short
          AND operational_costs(has_appointment(tag), is_full_fare(tag), is_renewal(tag), is_addon(category), at) <=> c_cost AS same
        FROM sql_function_cases""")
    assert got.where("same").count() == len(data) and len(names) == 13
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_every_payload_is_typed_or_a_dead_letter(spark):
    texts = {1: '{"id": "x", "amount": 5}', 2: "'{\"id\": \"y\", \"amount\": 7}'", 3: None, 4: "", 5: '{"id": ', 6: "[1]", 7: '"text"', 8: '{"amount": "many"}',
             9: '{"amount": null}', 10: '{"amount": 5, "paid": "maybe"}', 11: '{"id": 12}', 12: "not json"}
    df = spark.createDataFrame(list(texts.items()), "k int, raw string")
    good, dead = fn.split_payloads(df, "raw", "k")
    reasons = {r["k"]: r["reason"] for r in dead.collect()}
    assert reasons == {5: "not JSON", 6: "not an object", 7: "not an object", 8: "amount is not int", 10: "paid is not boolean", 12: "not JSON"}
    assert {r["k"]: r["payload"] and r["payload"]["amount"] for r in good.collect()} == {1: 5, 2: 7, 3: None, 4: None, 9: None, 11: None}
    assert rows(dead.where("k = 5").select("raw")) == [('{"id": ',)]
