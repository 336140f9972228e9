"""JSON payload parsing and field extraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import strip_outer_quote
from ledgerline.schemas import PAYLOAD_DDL


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_payload(c: Column | str, kind: str = "payment", ddl: str | None = None) -> Column:
    """JSON text -> typed struct.  Permissive: a malformed document gives a
    struct of NULL fields, NULL or empty text gives NULL."""
    return F.from_json(_c(c), ddl or PAYLOAD_DDL[kind])


def _once(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` evaluated once, however often ``use`` names it:
    bound as the variable of a one-element ``transform``.  A column is not
    enough, as a filter on the result is pushed below it with every mention
    written out."""
    return F.transform(F.array(c), use).getItem(0)


def payload_defect(c: Column | str, kind: str = "payment", ddl: str | None = None) -> Column:
    """Why a payload does not fit its layout, or NULL where it does (and for
    NULL and empty text, which hold no payload): ``not JSON``, ``not an object``
    or ``<field> is not <type>`` for the first top-level scalar field of the
    layout that holds a value of another type.  The text is parsed once, to a
    variant (see :func:`_once`)."""
    layout = T.StructType.fromDDL(ddl or PAYLOAD_DDL[kind])
    # A string field is never bad: text holds any scalar.
    typed = [f for f in layout.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.StringType))]

    def cast(doc: Column, kinds: list[str]) -> Column:
        return F.try_variant_get(doc, "$", f"struct<{', '.join(f'`{f.name}`:{k}' for f, k in zip(typed, kinds, strict=True))}>")

    def read(doc: Column) -> Column:
        # All fields at once; a value of another type is NULL in its own field alone.
        return F.struct(doc.isNull().alias("broken"), F.startswith(F.schema_of_variant(doc), F.lit("OBJECT")).alias("object"),
                        cast(doc, [f.dataType.simpleString() for f in typed]).alias("typed"), cast(doc, ["string"] * len(typed)).alias("text"))

    def judge(x: Column) -> Column:
        reason = F.lit(None).cast("string")
        for f in reversed(typed):
            # Text holds any scalar; a JSON null is no value.
            bad = x["typed"][f.name].isNull() & x["text"][f.name].isNotNull()
            reason = F.when(bad, F.lit(f"{f.name} is not {f.dataType.simpleString()}")).otherwise(reason)
        return F.when(x["broken"], F.lit("not JSON")).when(~x["object"], F.lit("not an object")).otherwise(reason)

    return _once(_c(c), lambda text: F.when(F.length(text) > 0, _once(_once(F.try_parse_json(text), read), judge)))


def split_payloads(df: DataFrame, col: str, key: str, kind: str = "payment", ddl: str | None = None,
                   into: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(typed rows, dead letters): rows whose payload fits its layout (or that
    have none) with the parsed struct as ``into``, and the others as (key, raw
    text, reason).  Every row is in one of the two."""
    judged = df.withColumn("__reason", _once(F.col(col), lambda raw: payload_defect(strip_outer_quote(raw), kind, ddl)))
    good = judged.where(F.col("__reason").isNull()).withColumn(into, parse_payload(strip_outer_quote(col), kind, ddl)).drop("__reason")
    dead = judged.where(F.col("__reason").isNotNull()).select(key, F.col(col).alias("raw"), F.col("__reason").alias("reason"))
    return good, dead


def field_or_empty(c: Column | str) -> Column:
    """A nested string field, or ``''`` when it (or any parent) is missing."""
    return F.coalesce(_c(c), F.lit(""))


def extract_payment_fields(parsed: Column | str) -> dict[str, Column]:
    """Product tag, provider name and provider id of a parsed charge."""
    p = _c(parsed)
    meta = p.getField("metadata")
    return {
        "productTag": field_or_empty(meta.getField("packageTag")),
        "provider": field_or_empty(meta.getField("provider").getField("fullName")),
        "provider_id": field_or_empty(meta.getField("provider").getField("providerId")),
    }


def epoch_to_ts(c: Column | str) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall clock); NULL stays NULL.

    Zone-independent: the seconds are added to the NTZ epoch instead of
    going through the session time zone.
    """
    return F.timestamp_add("SECOND", _c(c).cast("bigint"),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def dispute_fields(parsed: Column | str) -> dict[str, Column]:
    """Response deadline and status of a parsed dispute."""
    p = _c(parsed)
    return {
        "dispute_response_required_by": epoch_to_ts(p.getField("evidence_details").getField("due_by")),
        "dispute_status": field_or_empty(p.getField("status")),
    }
