import duckdb
import pytest

import corpus_pipeline
from ledgerline.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.data import awkward, empty, frame, lower, row
from tests.llm.test_jaccard import component_ids
from tests.llm.test_toxicity import corpus, labelled

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows, labels = corpus(150)
    labelled(spark, labels).write.parquet(f"{path}/labels.parquet")
    frame(spark, rows + awkward()).select(*COLUMNS).write.parquet(f"{path}/documents.parquet")
    return path


def test_each_stage_against_a_plain_version(spark, tables):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for name in ("toxicity", "exact_dedup", "ngram_jaccard", "mixing"):
        before = [tuple(r) for r in docs.collect()]
        docs = stages[name](spark, docs, tables)
        assert docs.columns == COLUMNS
        after = [tuple(r) for r in docs.collect()]
        if name == "exact_dedup":
            best = {}
            for r in before:
                if r[0] is not None:
                    best[lower(r[1])] = max(best.get(lower(r[1]), r[0]), r[0])
            assert sorted(map(str, after)) == sorted(str(r) for r in before if r[0] is None or best[lower(r[1])] == r[0])
        if name == "ngram_jaccard":
            assert sorted(map(str, after)) == sorted(str(r) for r, c in zip(before, component_ids(before), strict=True) if r[0] in (None, c))
        assert set(after) <= set(before)
    packed = stages["packing"](spark, docs, tables)
    assert {r["doc_id"] for r in packed.collect()} == {r[0] for r in after}


def test_run_is_all_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 0


def test_stages_stand_empty_tables(spark, tables):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark).select(*COLUMNS), tables).count() == 0, name


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    rows = lambda d: sorted(tuple("" if x is None or x != x else f"{x:.9g}" if isinstance(x, float) else str(x) for x in t) for t in d[cols].itertuples(index=False, name=None))
    as_float = [c for c in cols if want[c].dtype.kind == "f" or got[c].dtype.kind == "f"]
    for c in as_float:
        want[c], got[c] = want[c].astype(float), got[c].astype(float)
    assert rows(got) == rows(want)


def test_repeated_rows_and_rows_without_an_id_are_mixed_once(spark, tables):
    texts = {"one two": [5, 5, None], "ONE three": [None, None], "one four": [6], "": [None]}
    docs = frame(spark, [row(i, x) for x, ids in texts.items() for i in ids] + [row(None, "one THREE"), row(None, None)]).select(*COLUMNS)
    for name in ("exact_dedup", "ngram_jaccard"):
        docs = dict(corpus_pipeline.STAGES)[name](spark, docs, tables)
    assert docs.count() == 9
    one = corpus_pipeline.one_per_text(docs)
    assert one.columns == COLUMNS and sorted((str(r["doc_id"]), lower(r["text"])) for r in one.collect()) == [("5", "one two"), ("6", "one four"), ("None", ""), ("None", "one three")]
    got = corpus_pipeline.mixing(spark, docs, tables).collect()
    assert sorted(map(str, got)) == sorted(map(str, corpus_pipeline.mixed(one).collect())) and len(got) < corpus_pipeline.mixed(docs).count()
