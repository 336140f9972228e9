"""A cell's form is told once."""

from pyspark.sql import functions as F

from ledgerline.sources import cdc_files as C


def test_a_cell_is_matched_once_per_form(spark):
    values = [None, "", "1", "+5", "-2147483649", "9" * 20, "9" * 39, "1.", ".5", "1e3", "1e400", "12\n", "2024-01-31", "2024-02-31", "2024-01-31 25:00:00",
              "2024-01-31T10:00:00.5", "TRUE", "False\n", "f", " 1", "٣", "x", "-", "2024-01-31\n"]
    t = F.col("t")

    def plain(k, kind):
        return F.when(t.rlike(C._FORMS[kind]) & t.try_cast(kind).isNotNull(), 1 << k).otherwise(0)

    mask = plain(0, C.LATTICE[0])
    for k, name in enumerate(C.LATTICE[1:], 1):
        mask = mask.bitwiseOR(plain(k, name))
    df = spark.createDataFrame([(v,) for v in values], "t string")
    assert df.where(~C.fitting(t).eqNullSafe(F.when(F.length(t) > 0, mask))).count() == 0
    # One pattern a form: before, every type tried its own.
    assert str(C.fitting(t)).lower().count("rlike(") == 5
