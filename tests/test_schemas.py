"""Payload layouts parse and carry the fields the pipeline reads."""

from pyspark.sql import functions as F

from ledgerline.schemas import DISPUTE_PAYLOAD_DDL, REFUND_PAYLOAD_DDL, payment_payload_ddl


def _schema(spark, ddl):
    return spark.range(1).select(F.from_json(F.lit("{}"), ddl).alias("j")).schema["j"].dataType


def test_payload_layouts(spark):
    pay = _schema(spark, payment_payload_ddl())
    meta = pay["metadata"].dataType
    assert meta["packageTag"].dataType.simpleString() == "string"
    assert [f.name for f in meta["provider"].dataType.fields] == ["fullName", "providerId"]
    assert len(pay.fields) == 47
    dis = _schema(spark, DISPUTE_PAYLOAD_DDL)
    assert dis["evidence_details"].dataType["due_by"].dataType.simpleString() == "bigint"
    assert len(dis["evidence"].dataType.fields) == 27 and len(dis["metadata"].dataType.fields) == 0
    ref = _schema(spark, REFUND_PAYLOAD_DDL)
    assert ref["metadata"].dataType.simpleString() == "string" and len(ref.fields) == 48


def test_vendor_package_field_is_a_parameter(spark):
    meta = _schema(spark, payment_payload_ddl("acmePackage"))["metadata"].dataType
    assert "acmePackage" in meta.fieldNames() and "vendorPackage" not in meta.fieldNames()
