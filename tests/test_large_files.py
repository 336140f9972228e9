"""Large CDC files whose lines are records are read by splits, all others whole."""

import os

from ledgerline.session import shared_dir
from ledgerline.sources import cdc_files as C
from tests.conftest import rows

PLAIN = ['1|"{""a"": ""x|y""}"', '2|""', "3|\\N", '4|""""', '5|a""b', "6|é"]
OTHER = {"break": '1|"a\nb"', "stray": '1|x"|"a\n2|b"|y', "open after stray": '1|x""|"abc\n"', "return": '1|a\r\n2|b', "blank": "1|a\n  \n2|b",
         "line ends": '1|"a\n"\n2|"b"'}


def _write(path, name, lines, head="k|v"):
    os.makedirs(f"{path}/LOAD", exist_ok=True)
    with open(f"{path}/LOAD/{name}.csv", "w", newline="") as f:
        f.write("\n".join([head, *lines]) + "\n")


def test_line_files(spark):
    path = shared_dir(spark, "large %20files").removeprefix("file:")
    _write(path, "plain", PLAIN * 50)
    for name, text in OTHER.items():
        _write(path, name, [*PLAIN, text])
    files = C.list_files(spark, path, full=True)
    assert [os.path.basename(f) for f in C.line_files(spark, files, 0)] == ["plain.csv"]
    assert C.line_files(spark, files) == set() and C.line_files(spark, [], 0) == set()


def test_large_file_is_split(spark, monkeypatch):
    path = shared_dir(spark, "large").removeprefix("file:")
    _write(path, "plain", PLAIN * 20_000)
    _write(path, "mixed", [*PLAIN, *OTHER.values()])
    conf = {"spark.sql.files.maxPartitionBytes": "200000", "spark.sql.files.openCostInBytes": "1000"}
    before = {k: spark.conf.get(k) for k in conf}
    whole = C.read_cdc(spark, path, ["k", "v"], full=True)
    want = rows(whole.groupBy("k", "v").count())
    monkeypatch.setattr(C, "LARGE_FILE", 10)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = C.read_cdc(spark, path, ["k", "v"], full=True)
        assert got.rdd.getNumPartitions() > whole.rdd.getNumPartitions() + 3
        assert rows(got.groupBy("k", "v").count()) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_header_of_a_split_file(spark, monkeypatch):
    path = shared_dir(spark, "headers").removeprefix("file:")
    _write(path, "plain", PLAIN * 1000)
    _write(path, "other", ["x|1"] * 3000, "v|k")
    monkeypatch.setattr(C, "LARGE_FILE", 5000)
    with C._one_file_per_task(spark):
        assert spark.read.text(f"{path}/LOAD").rdd.getNumPartitions() > 4
    groups = C.headers(spark, C.list_files(spark, path, full=True))
    assert {names: [os.path.basename(f) for f in files] for names, files in groups.items()} == {("k", "v"): ["plain.csv"], ("v", "k"): ["other.csv"]}
