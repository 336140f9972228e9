"""Lake tables of the payment pipeline, derived with Spark from the driver's
TPC-H-like test tables.

The original pipeline reads lake tables (payments, refunds, disputes,
product history, referral events, client-side billing items) that do not
exist in the test data.  Each is derived here by a deterministic Spark plan
from ``orders``, ``lineitem``, ``customer``, ``part``, ``supplier`` and
``events``, so that every query's work grows with the input scale.  The
same derivations are written in DuckDB SQL in :mod:`ledgerline.oracle`.

Mapping (one row each):
  payment         every order
  product_history (product tag, ``p_size``) group of parts = one version
  refund          order with returned (``R``) lines; ``A`` lines form a
                  second, later refund batch used as MERGE source
  dispute         urgent order (``1-URGENT``); a later batch covers
                  finished urgent and high-priority orders
  referral_event  any event; user ``u`` is customer ``u``
  client_billing  line item (ship date = client-side load time)
  cdc log         events as CDC rows: first non-error event of a user is an
                  insert, later ones updates, errors deletes; one file per day
"""

from __future__ import annotations

from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# ---------------------------------------------------------------------------
# FIXED VALUES of the test-table mapping (shared with the DuckDB oracle).
# ---------------------------------------------------------------------------
VERSION_EPOCH = "1995-01-01 00:00:00"      # version k of a tag starts k*30 days later
VERSION_STEP_DAYS = 30
EVENT_EPOCH = "2024-01-01 00:00:00"        # event clock origin ...
EVENT_TARGET_EPOCH = "1995-01-01 00:00:00"  # ... mapped onto the order clock
EVENT_TIME_STRETCH = 80                     # 30 event days -> ~6.6 order years
# Spellings of the state a customer's nation maps to (index = n_nationkey).
STATE_SPELLINGS = [
    "CA", "ca", "C A", "New York", "newyork", "NY", "tx", "Texas", "WA", "Washington",
    "D C", "District of Columbia", "PR", "puerto rico", "FL", "Florida", "XX", "Ontario",
    "", None, "IL", "n y", "NewJersey", "OR", "oregon",
]
# E-mail patterns of internal accounts in the test data (exclusion parameter).
TEST_INTERNAL_EMAIL_PATTERNS = ("%internal%", "%qa-team%")
# Referral event type per source event type.
EVENT_TYPE_MAP = {
    "signup": "user_qualified", "click": "link_clicked", "view": "page_viewed",
    "purchase": "reward_issued", "error": "user_disqualified",
}
# Fixed run timestamps used by the registered queries (replayable output).
RUN_TS = "2024-06-01 12:00:00"
EARLIER_RUN_TS = "2024-05-01 08:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Derived lake tables already written in this session: (app id, sf_dir, name) -> table.
_LAKE: dict[tuple[str, str, str], str] = {}
# Bucket counts by session and input: (app id, sf_dir) -> buckets.
_BUCKETS: dict[tuple[str, str], int] = {}
#: Orders, events or four line items that a bucket holds on average: what a task sorts, joins and
#: writes of one bucket stays this big whatever the input.
BUCKET_ROWS = 400_000


def lake_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived lake table, written once per session and read back the way
    the pipeline jobs read their lake tables.

    Stored as an external bucketed table (data in the shared folder named by
    ``spark.checkpoint.dir``, one file per bucket), bucketed by the table
    key with one bucket count for all tables: joins on the key between two
    lake tables (payment/refund, refund/payment) need no shuffle, and scans
    get column pruning and filter pushdown.  Tables whose builder gives rows
    that lie by the key already (``LAKE_PLACED``) are written as they come; one
    without a key is not bucketed.
    """
    import uuid

    from ledgerline.session import CODEC, app_id, shared_dir

    key = (app_id(spark), sf_dir.rstrip("/"), name)
    table = _LAKE.get(key)
    if table is None:
        path = shared_dir(spark, f"lake-{name}")
        table = f"lake_{name}_{uuid.uuid4().hex[:10]}"
        buckets, by = lake_buckets(spark, sf_dir), LAKE_KEYS.get(name)
        rows = LAKE_BUILDERS[name](spark, sf_dir)
        if by is not None and name not in LAKE_PLACED:
            rows = rows.repartition(buckets, by)
        out = rows.write if by is None else rows.write.bucketBy(buckets, by)
        with _in_buckets(spark, buckets) if name in LAKE_PLACED else nullcontext():
            out.option("compression", CODEC).option("path", path).saveAsTable(table)
        _LAKE[key] = table
    return spark.table(table)


def lake_buckets(spark: SparkSession, sf_dir: str) -> int:
    """Bucket count shared by all lake tables of an input (co-located joins need
    equal counts): the cluster's default parallelism, or more where a bucket
    would hold over ``BUCKET_ROWS``.  Rows are counted by the files' footers."""
    from ledgerline.session import app_id, parallelism

    key = (app_id(spark), sf_dir.rstrip("/"))
    if key not in _BUCKETS:
        orders, events, lines = (read_table(spark, sf_dir, t).count() for t in ("orders", "events", "lineitem"))
        _BUCKETS[key] = max(parallelism(spark), -(-max(orders, events, lines // 4) // BUCKET_ROWS))
    return _BUCKETS[key]


@contextmanager
def _in_buckets(spark: SparkSession, buckets: int):
    """A plan runs with one task per bucket, in shuffles and in scans of bucketed tables."""
    conf = {"spark.sql.shuffle.partitions": str(buckets), "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _ntz(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def _hours(n: Column | int, ts: Column) -> Column:
    return F.timestamp_add("HOUR", n if isinstance(n, Column) else F.lit(n), ts)


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _money(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def _q(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def customer_email(custkey: Column, segment: Column) -> Column:
    k = custkey.cast("string")
    # Every 50th customer has no e-mail.
    return (F.when(custkey % 50 == 7, F.lit(None).cast("string"))
            .when(segment == "HOUSEHOLD", F.concat(F.lit("c"), k, F.lit("@internal.example.com")))
            .when(segment == "AUTOMOBILE", F.concat(F.lit("QA-Team+c"), k, F.lit("@example.com")))
            .otherwise(F.concat(F.lit("customer"), k, F.lit("@example.com"))))


def product_tag(p_type: Column, p_brand: Column) -> Column:
    return (F.when(p_type == "ECONOMY", F.concat(F.lit("homeRenewal-"), p_brand))
            .when(p_type == "LARGE", F.lit("homeRenewalNew"))
            .when(p_type == "MEDIUM", F.concat(F.lit("psdTrain-"), p_brand))
            .when(p_type == "PROMO", F.concat(F.lit("autoRENEW-"), p_brand))
            .otherwise(F.concat(p_type, F.lit("-"), p_brand)))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with line items: first line, totals in cents and
    per-return-flag totals.  A single partial aggregation over lineitem."""
    li = read_table(spark, sf_dir, "lineitem")
    cents = _cents("l_extendedprice")
    return li.groupBy("l_orderkey").agg(
        F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("first_line"),
        F.sum(cents).alias("line_cents"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("l_returnflag") == "R", cents)).alias("r_cents"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("r_lines"),
        F.sum(F.when(F.col("l_returnflag") == "A", cents)).alias("a_cents"),
        F.count(F.when(F.col("l_returnflag") == "A", 1)).alias("a_lines"),
    )


def _order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their line summary, customer and first line's part
    (shared by several lake tables: written once per session)."""
    return lake_table(spark, sf_dir, "order_facts")


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table is joined to the narrower side that has its key, and the two
    sides meet by the payment's key in the buckets of the lake: the joined rows
    are moved once, and the tables made of them (payments, refunds) not at all."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    buckets = lake_buckets(spark, sf_dir)
    lines = order_lines(spark, sf_dir)
    lines = (lines.join(s, F.col("first_line.l_suppkey") == s.s_suppkey, "left")
             .join(p, F.col("first_line.l_partkey") == p.p_partkey, "left")
             .drop("first_line", "p_partkey").withColumn("__line_key", _payment_key("l_orderkey")).drop("l_orderkey"))
    o = o.join(c, o.o_custkey == c.c_custkey, "left").drop("c_custkey").withColumn("payment_intent_id", _payment_key("o_orderkey"))
    o, lines = o.repartition(buckets, "payment_intent_id"), lines.repartition(buckets, "__line_key")
    return o.join(lines, F.col("payment_intent_id") == F.col("__line_key"), "left").drop("__line_key")


def _payment_key(order_key: str) -> Column:
    return F.concat(F.lit("pi_"), F.col(order_key).cast("string"))


def _payment_json(k: Column, cents: Column, status: Column, tag: Column,
                  provider: Column, provider_id: Column) -> Column:
    head = F.concat(F.lit('{"id": "ch_'), k, F.lit('", "object": "charge", "amount": '), cents.cast("string"),
                    F.lit(', "currency": "usd", "status": "'), status, F.lit('", "paid": true'))
    meta = F.concat(F.lit(', "metadata": {"packageTag": "'), tag, F.lit('", "provider": {"fullName": "'),
                    provider, F.lit('", "providerId": "'), provider_id, F.lit('"}}'))
    return F.concat(head, F.when(tag.isNotNull(), meta).otherwise(F.lit("")), F.lit("}"))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment table as stage 1 leaves it (payload keeps outer quotes)."""
    f = _order_facts(spark, sf_dir)
    k = F.col("o_orderkey").cast("string")
    cents = F.coalesce(F.col("line_cents"), _cents("o_totalprice"))
    status = (F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("processing"))
    refunded = F.coalesce(F.col("r_lines") > 0, F.lit(False))
    disputed = F.col("o_orderpriority") == "1-URGENT"
    states = F.array(*[F.lit(x).cast("string") for x in STATE_SPELLINGS])
    tag = product_tag(F.col("p_type"), F.col("p_brand"))
    updated = _hours(F.col("o_orderkey") % 48, F.col("o_orderdate"))
    return f.select(
        "payment_intent_id",
        status.alias("status"),
        F.concat(F.lit("ch_"), k).alias("charge_id"),
        customer_email(F.col("o_custkey"), F.col("c_mktsegment")).alias("email"),
        F.concat(F.lit("555-"), F.col("o_custkey").cast("string")).alias("phone"),
        F.col("c_name").alias("name"),
        F.element_at(states, F.col("c_nationkey") + 1).alias("state"),
        _money(cents).alias("amount"),
        refunded.alias("is_refunded"),
        disputed.alias("is_dispute"),
        F.col("o_orderdate").alias("payment_created_at"),
        updated.alias("payment_updated_at"),
        F.when(refunded, _hours((F.col("o_orderkey") % 4) * 12, F.col("o_orderdate"))).alias("payment_refunded_at"),
        F.when(disputed, F.timestamp_add("DAY", F.lit(3), F.col("o_orderdate"))).alias("payment_disputed_at"),
        _q(_payment_json(k, cents, status, tag, F.col("s_name"),
                         F.concat(F.lit("prov_"), F.col("s_suppkey").cast("string")))).alias("payment_data"),
        F.timestamp_add("MINUTE", F.lit(90), updated).alias("created_at"),
    )


def payment_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch of payment rows: every order with returned lines, now
    refunded.  Every tenth has a key of its own, which the target does not have."""
    f = _order_facts(spark, sf_dir).where(F.col("r_lines") > 0)
    k = F.col("o_orderkey").cast("string")
    refunded_at = _hours((F.col("o_orderkey") % 4) * 12, F.col("o_orderdate"))
    cents = F.coalesce(F.col("line_cents"), _cents("o_totalprice"))
    states = F.array(*[F.lit(x).cast("string") for x in STATE_SPELLINGS])
    return f.select(
        F.concat(F.when(F.col("o_orderkey") % 10 == 0, "pi_new_").otherwise("pi_"), k).alias("payment_intent_id"),
        F.lit("refunded").alias("status"),
        F.concat(F.lit("ch_"), k).alias("charge_id"),
        customer_email(F.col("o_custkey"), F.col("c_mktsegment")).alias("email"),
        F.concat(F.lit("555-"), F.col("o_custkey").cast("string")).alias("phone"),
        F.col("c_name").alias("name"),
        F.element_at(states, F.col("c_nationkey") + 1).alias("state"),
        _money(cents).alias("amount"),
        F.lit(True).alias("is_refunded"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_dispute"),
        F.col("o_orderdate").alias("payment_created_at"),
        refunded_at.alias("payment_updated_at"),
        refunded_at.alias("payment_refunded_at"),
        F.lit(None).cast("timestamp_ntz").alias("payment_disputed_at"),
        _q(F.concat(F.lit('{"id": "ch_'), k, F.lit('", "object": "charge", "refunded": true}'))).alias("payment_data"),
        F.timestamp_add("DAY", F.lit(2), refunded_at).alias("created_at"),
    )


def refunds(spark: SparkSession, sf_dir: str, flag: str = "R") -> DataFrame:
    """Refund rows of the orders with ``flag`` lines (``R``: the refund
    table; ``A``: a later refund batch)."""
    cents_col, count_col = ("r_cents", "r_lines") if flag == "R" else ("a_cents", "a_lines")
    f = _order_facts(spark, sf_dir).where(F.col(count_col) > 0)
    k = F.col("o_orderkey").cast("string")
    disputed = F.col("o_orderpriority") == "1-URGENT"
    shift = 0 if flag == "R" else 6
    refunded_at = F.when(F.col("o_orderkey") % 10 != 9,
                         _hours((F.col("o_orderkey") % 4) * 12 + shift, F.col("o_orderdate")))
    return f.select(
        "payment_intent_id",
        F.when(disputed, F.concat(F.lit("dp_"), k)).alias("dispute_id"),
        F.concat(F.lit("ch_"), k).alias("charge_id"),
        _money(F.col(cents_col)).alias("amount_refunded"),
        (F.col(count_col) < F.col("n_lines")).alias("is_partially_refunded"),
        (F.col(count_col) == F.col("n_lines")).alias("is_fully_refunded"),
        disputed.alias("is_dispute"),
        F.when(disputed, F.timestamp_add("DAY", F.lit(3), F.col("o_orderdate"))).alias("dispute_created_at"),
        refunded_at.alias("payment_refunded_at"),
        _q(F.concat(F.lit('{"id": "re_'), k, F.lit('", "object": "refund", "amount": '),
                    F.col(cents_col).cast("string"), F.lit(', "status": "succeeded"}'))).alias("refund_data"),
        (F.when(F.col("o_orderkey") % 3 == 0, "requested_by_customer")
         .when(F.col("o_orderkey") % 3 == 1, "duplicate").otherwise("fraudulent")).alias("reason"),
        _hours(60 + shift, F.col("o_orderdate")).alias("created_at"),
    )


def disputes(spark: SparkSession, sf_dir: str, later: bool = False) -> DataFrame:
    """Dispute rows of urgent orders; ``later=True`` gives the next batch:
    finished urgent or high-priority orders with a decided status."""
    o = read_table(spark, sf_dir, "orders")
    if later:
        o = o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") == "F"))
    else:
        o = o.where(F.col("o_orderpriority") == "1-URGENT")
    k = F.col("o_orderkey").cast("string")
    opened = F.timestamp_add("DAY", F.lit(3), F.col("o_orderdate"))
    due = F.unix_timestamp(F.timestamp_add("DAY", F.lit(10), opened))
    status = F.lit("won") if later else F.when(F.col("o_orderkey") % 2 == 0, "needs_response").otherwise("under_review")
    body = F.concat(
        F.lit('{"id": "dp_'), k, F.lit('", "object": "dispute", "charge": "ch_'), k, F.lit('"'),
        F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit(', "status": "'), status, F.lit('"'))).otherwise(F.lit("")),
        F.when(F.col("o_orderkey") % 5 != 0,
               F.concat(F.lit(', "evidence_details": {"due_by": '), due.cast("string"),
                        F.lit(', "past_due": false, "has_evidence": false, "submission_count": 0}')))
        .otherwise(F.lit("")),
        F.lit("}"))
    load_shift = 240 if later else 80
    return o.select(
        F.concat(F.lit("pi_"), k).alias("payment_intent_id"),
        F.concat(F.lit("dp_"), k).alias("dispute_id"),
        F.concat(F.lit("ch_"), k).alias("charge_id"),
        F.col("o_totalprice").alias("dispute_amount"),
        opened.alias("dispute_created_at"),
        _hours(1, opened).alias("record_created_at"),
        _q(body).alias("dispute_data"),
        (F.when(F.col("o_orderkey") % 3 == 0, "fraudulent")
         .when(F.col("o_orderkey") % 3 == 1, "duplicate").otherwise("product_not_received")).alias("reason"),
        _hours(load_shift, F.col("o_orderdate")).alias("created_at"),
    )


def product_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned product dimension: one version per (tag, p_size)."""
    p = read_table(spark, sf_dir, "part")
    g = (p.withColumn("tag", product_tag(F.col("p_type"), F.col("p_brand")))
         .groupBy("tag", "p_size")
         .agg(F.min("p_partkey").alias("id"), F.min("p_name").alias("name")))
    start = F.timestamp_add("DAY", F.col("p_size") * VERSION_STEP_DAYS, _ntz(VERSION_EPOCH))
    return g.select(
        "id", "tag", "name",
        F.concat(F.lit("off_"), F.col("id").cast("string")).alias("offering_id"),
        F.col("tag").alias("stripe_product_tag"),
        F.when(F.col("tag").ilike("%renew%"), "Renewal").otherwise("Initial").alias("type"),
        F.when(F.col("p_size") % 5 == 0, "Add-on").otherwise("Package").alias("category"),
        (F.when(F.col("p_size") % 3 == 0, "In-App").when(F.col("p_size") % 3 == 1, "Website")
         .otherwise("Phone")).alias("purchase_location"),
        F.when(F.col("p_size") % 2 == 0, "subscription").otherwise("one-time").alias("purchase_type"),
        ((F.col("p_size") % 7) * 5 + 10).alias("operational_costs"),
        (F.col("p_size") <= 45).alias("is_active"),
        start.alias("starting_at"),
        F.timestamp_add("DAY", F.lit(-1), start).alias("created_at"),
    )


def referral_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Referral events on the order clock, e-mail of customer ``user_id``."""
    e = read_table(spark, sf_dir, "events")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    secs = (F.unix_timestamp("ts") - F.unix_timestamp(_ntz(EVENT_EPOCH))) * EVENT_TIME_STRETCH
    event_date = F.timestamp_add("SECOND", secs, _ntz(EVENT_TARGET_EPOCH))
    etype = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_TYPE_MAP.items()])
    return (e.join(c, e.user_id == c.c_custkey, "left").select(
        "event_id",
        customer_email(F.col("user_id"), F.col("c_mktsegment")).alias("user_email"),
        event_date.alias("event_date"),
        etype.alias("event_type"),
        F.concat(F.lit("cmp_"), (F.col("event_id") % 17).cast("string")).alias("campaign_id"),
        F.concat(F.lit("Campaign "), (F.col("event_id") % 17).cast("string")).alias("campaign_name"),
        F.timestamp_add("MINUTE", F.lit(30), event_date).alias("inserted_at"),
    ))


def client_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("created_at"))


def cdc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC rows in the payment table's shape plus ``Op`` and ``file_time``.

    Per user: the first non-error event is an insert, later non-error
    events are updates, error events are deletes.  One file per event day,
    stamped at the end of that day.
    """
    e = read_table(spark, sf_dir, "events")
    first = (e.where(F.col("event_type") != "error").groupBy("user_id")
             .agg(F.min(F.struct("ts", "event_id")).alias("first")))
    j = e.join(first, "user_id", "left")
    op = (F.when(F.col("event_type") == "error", "D")
          .when(F.col("event_id") == F.col("first.event_id"), "I").otherwise("U"))
    day = F.col("ts").cast("date").cast("timestamp_ntz")
    file_time = F.timestamp_add("DAY", F.lit(1), day)
    uid = F.col("user_id").cast("string")
    return j.select(
        op.alias("Op"),
        F.concat(F.lit("pi_u"), uid).alias("payment_intent_id"),
        F.col("event_type").alias("status"),
        F.concat(F.lit("ch_e"), F.col("event_id").cast("string")).alias("charge_id"),
        F.concat(F.lit("user"), uid, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("555-"), uid).alias("phone"),
        F.concat(F.lit("User "), uid).alias("name"),
        F.lit(None).cast("string").alias("state"),
        F.col("value").alias("amount"),
        (F.col("event_type") == "purchase").alias("is_refunded"),
        F.lit(False).alias("is_dispute"),
        day.alias("payment_created_at"),
        F.col("ts").alias("payment_updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("payment_refunded_at"),
        F.lit(None).cast("timestamp_ntz").alias("payment_disputed_at"),
        _q(F.col("props")).alias("payment_data"),
        file_time.alias("created_at"),
        file_time.alias("file_time"),
    )


LAKE_BUILDERS = {
    "order_facts": order_facts,
    "payment": payments,
    "payment_updates": payment_updates,
    "refund": lambda s, d: refunds(s, d, "R"),
    "refund_updates": lambda s, d: refunds(s, d, "A"),
    "dispute": disputes,
    "dispute_updates": lambda s, d: disputes(s, d, later=True),
    "product_history": product_history,
    "referral_event": referral_events,
    "client_billing": client_billing,
    "cdc": cdc_log,
}

LAKE_KEYS = {
    "order_facts": "payment_intent_id",
    "payment": "payment_intent_id", "payment_updates": "payment_intent_id",
    "refund": "payment_intent_id", "refund_updates": "payment_intent_id",
    "dispute": "payment_intent_id", "dispute_updates": "payment_intent_id",
    "product_history": "tag", "referral_event": "user_email", "cdc": "payment_intent_id",
}

#: Tables whose rows come by their key: the order facts are joined in the buckets, payments and refunds read these.
LAKE_PLACED = ("order_facts", "payment", "refund", "refund_updates")
