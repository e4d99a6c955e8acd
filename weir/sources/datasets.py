"""The reference's datasets, shaped from the driver tables by Spark.

Each function returns a lazy DataFrame with the schema of one reference
input (users, items, nested events, lab people/swipes/purchases, fuel
exports, stream envelopes, order documents, fetch attempts, access logs).
The rules are plain column expressions, so the work grows with the driver
tables and the DuckDB oracle (`weir.plans.oracle`) can state the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.sources.tables import read_table, spread

# ------------------------------------------------------------------- KPI

# Fixed value: the fixture's country bucket count.
COUNTRY_BUCKETS = 25  # country = 'N' || user_id % 25


def _iso_ts(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> ISO-8601 text with offset, as the event files carry."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def event_price(event_id: Column, value: Column) -> Column:
    """Purchase price with the two kinds of bad data the KPI must survive:
    a negative price (event_id % 100 = 7) and a missing one (= 11)."""
    m = event_id % 100
    return F.when(m == 11, F.lit(None).cast("double")).when(m == 7, -value).otherwise(value)


def event_item(event_id: Column, key: Column) -> Column:
    """The event's item; every tenth event names one that no table has."""
    return F.when(event_id % 10 == 3, -1 - key).otherwise(key)


def kpi_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested events: ts string, event, user_id, item_id, context, props, exp."""
    e = read_table(spark, sf_dir, "events")
    is_purchase = F.col("event_type") == "purchase"
    return e.select(
        _iso_ts(F.col("ts")).alias("ts"),
        F.col("event_type").alias("event"),
        F.col("user_id").cast("long").alias("user_id"),
        event_item(F.col("event_id"), F.get_json_object("props", "$.k").cast("long")).alias("item_id"),
        F.struct(
            F.concat(F.lit("N"), (F.col("user_id") % COUNTRY_BUCKETS).cast("string")).alias("country"),
            F.element_at(F.array(F.lit("web"), F.lit("ios"), F.lit("android")),
                         (F.col("event_id") % 3 + 1).cast("int")).alias("device"),
            F.lit("en_US").alias("locale"),
            F.concat(F.lit("s"), F.col("user_id").cast("string"), F.lit("-"),
                     F.to_date("ts").cast("string")).alias("session_id"),
        ).alias("context"),
        F.struct(
            event_price(F.col("event_id"), F.col("value")).alias("price"),
            F.when(is_purchase, F.lit("card")).alias("payment_method"),
            F.when(~is_purchase, F.floor(F.col("value") * 100).cast("int")).alias("dwell_ms"),
        ).alias("props"),
        F.struct(F.when(F.col("event_id") % 2 == 0, "A").otherwise("B").alias("ab_group")).alias("exp"),
    )


def kpi_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items: item_id int, category string, tags array<string>."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("long").alias("item_id"),
        F.col("p_type").alias("category"),
        F.array(F.col("p_brand")).alias("tags"),
    )


def kpi_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users: id int, signup_date, plan, country, marketing_opt_in."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("long").alias("id"),
        F.lit(None).cast("string").alias("signup_date"),
        F.col("c_mktsegment").alias("plan"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        (F.col("c_acctbal") > 0).alias("marketing_opt_in"),
    )


# --------------------------------------------------- presence investigation

def _badge(key) -> Column:
    return F.concat(F.lit("BDG-"), key.cast("string"))


def lab_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """people: person_id, full_name, team, badge_uid (from customer)."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("long").alias("person_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("team"),
        _badge(F.col("c_custkey")).alias("badge_uid"),
    )


def lab_swipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """swipes: badge_uid, session_code, ts (one per order)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        _badge(F.col("o_custkey")).alias("badge_uid"),
        F.col("o_orderstatus").alias("session_code"),
        F.col("o_orderdate").alias("ts"),
    )


def lab_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sessions: session_code, session_name (the distinct codes)."""
    o = read_table(spark, sf_dir, "orders")
    codes = o.select(F.col("o_orderstatus").alias("session_code")).distinct()
    return codes.withColumn("session_name", F.concat(F.lit("SESSION "), F.col("session_code")))


def lab_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """purchases: purchase_id, badge_uid, location, product, qty, ts."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("long").alias("purchase_id"),
        _badge(F.col("o_custkey")).alias("badge_uid"),
        F.lit("cafeteria").alias("location"),
        F.col("o_orderpriority").alias("product"),
        F.lit(1).alias("qty"),
        F.col("o_orderdate").alias("ts"),
    )


# ------------------------------------------------------ CSV demo (people)

def sample_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, age, city (from customer: age = 20 + nation key)."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("long").alias("id"),
        F.col("c_name").alias("name"),
        (F.col("c_nationkey") + 20).cast("int").alias("age"),
        F.col("c_mktsegment").alias("city"),
    )


# ------------------------------------------------------------ fuel export

FUEL_FILES = 4  # source_file = fuel_export_<l_orderkey % 4>.parquet
FUEL_LOADED_BEFORE = ("fuel_export_0.parquet",)  # already in the manifest


def fuel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuel export rows (D6 shape) with the export file each belongs to."""
    from weir.operators.joins import broadcast_if_bounded

    li = spread(read_table(spark, sf_dir, "lineitem"))
    part, _ = broadcast_if_bounded(
        read_table(spark, sf_dir, "part").select(F.col("p_partkey"), F.col("p_brand").alias("franchise"))
    )
    li = li.join(part, li["l_partkey"] == part["p_partkey"], "left")
    pk = F.col("l_partkey")
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
        .alias("transaction_id"),
        F.col("l_suppkey").cast("int").alias("station_id"),
        F.when(pk % 10 == 0, F.lit(None)).otherwise(
            F.struct(F.col("l_linenumber").cast("short").alias("bay"), F.col("l_returnflag").alias("level"))
        ).alias("dock"),
        F.concat(F.lit("SHIP-"), (pk % 50).cast("string")).alias("ship_name"),
        "franchise",
        F.concat(F.lit("Captain "), F.col("l_suppkey").cast("string")).alias("captain_name"),
        F.col("l_linestatus").alias("species"),
        F.col("l_returnflag").alias("fuel_type"),
        F.col("l_quantity").cast("float").alias("fuel_units"),
        F.col("l_discount").cast("decimal(8,2)").alias("price_per_unit"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("total_cost"),
        F.when(pk % 7 == 0, F.lit(None)).otherwise(F.array("l_linestatus", "l_returnflag")).alias("services"),
        F.when(pk % 13 == 0, F.lit(None)).otherwise(F.col("l_discount") > 0.09).alias("is_emergency"),
        F.col("l_shipdate").cast("timestamp").alias("visited_at"),
        F.col("l_shipdate").cast("date").alias("arrival_date"),
        pk.cast("double").alias("coords_x"),
        F.col("l_tax").alias("coords_y"),
        F.concat(F.lit("fuel_export_"), (F.col("l_orderkey") % FUEL_FILES).cast("string"), F.lit(".parquet"))
        .alias("source_file"),
    )


# ------------------------------------------------------------ event stream

STREAM_TOPIC = "demo"
STREAM_PARTITIONS = 3  # partition = event_id % 3, offset = event_id div 3


def stream_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker envelopes (key, value, topic, partition, offset, timestamp)
    whose value is the Avro payload of one event."""
    from weir.functions.avro import encode_payload
    from weir.functions.columns import ntz_to_epoch_millis

    e = spread(read_table(spark, sf_dir, "events"))
    return e.select(
        F.lit(None).cast("binary").alias("key"),
        encode_payload(
            F.concat(F.lit("u_"), F.col("user_id").cast("string")),
            F.col("event_type"),
            F.col("value"),
            ntz_to_epoch_millis(F.col("ts")),
        ).alias("value"),
        F.lit(STREAM_TOPIC).alias("topic"),
        (F.col("event_id") % STREAM_PARTITIONS).cast("int").alias("partition"),
        F.expr(f"event_id div {STREAM_PARTITIONS}").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


# ------------------------------------------------------------------ orders

# Fixed values of the order service: tax rate by currency, status names.
TAX_RATE_USD = "0.07"
TAX_RATE_OTHER = "0.20"
ORDER_STATUSES = ("created", "confirmed", "invoiced", "paid")
ORDER_CURRENCIES = ("USD", "EUR", "GBP")


def order_currency(order_key: Column) -> Column:
    return F.when(order_key % 3 == 0, F.lit("USD")).otherwise(F.lit("EUR"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines, one row each: order_id, sku, name, qty, unit_price (four
    decimals), usage_month. qty is 0 on every 50th part (invalid rows for
    the domain checks). The amount is the operators' to compute."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("name"),
        F.when(F.col("l_partkey") % 50 == 0, F.lit(0)).otherwise(F.col("l_quantity").cast("int")).alias("qty"),
        (F.col("l_extendedprice").cast("decimal(18,2)") * F.lit("0.01").cast("decimal(3,2)"))
        .cast("decimal(18,4)").alias("unit_price"),
        F.date_format("l_shipdate", "yyyy-MM-01").alias("usage_month"),
    )


def _order_status() -> Column:
    return (
        F.when(F.col("o_orderkey") % 40 == 0, F.lit("unknown"))
        .when(F.col("o_orderstatus") == "F", F.lit("paid"))
        .when(F.col("o_orderstatus") == "P", F.lit("invoiced"))
        .otherwise(F.lit("created"))
    )


def order_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header fields that totals and checks need (no customer join):
    order_id, status, currency."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), _order_status().alias("status"),
        order_currency(F.col("o_orderkey")).alias("currency"),
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order header fields: order_id, account_id, company, contact, status,
    currency, created_at, source."""
    from weir.operators.joins import broadcast_if_bounded

    o = read_table(spark, sf_dir, "orders")
    c, _ = broadcast_if_bounded(
        read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    )
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("c_name").alias("company"),
        F.struct(
            F.col("c_name").alias("name"),
            F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
            F.concat(F.lit("+1-555-"), F.format_string("%07d", F.col("o_custkey"))).alias("phone"),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        ).alias("contact"),
        _order_status().alias("status"),
        order_currency(F.col("o_orderkey")).alias("currency"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.lit("orders").alias("source"),
    )


# ---------------------------------------------------------- fetch attempts

FETCH_MAX_ATTEMPTS = 5


def fetch_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (item, attempt 1..5) with the status the service gave:
    500 when (item*7 + n*3) % 10 = 0, 429 when (item*11 + n*5) % 17 = 0,
    404 when (item + n) % 97 = 0, else 200 (first rule that holds)."""
    o = spread(read_table(spark, sf_dir, "orders")).select(F.col("o_orderkey").alias("item_id"))
    a = o.select("item_id", F.explode(F.sequence(F.lit(1), F.lit(FETCH_MAX_ATTEMPTS))).alias("attempt"))
    i, n = F.col("item_id"), F.col("attempt")
    status = (
        F.when((i * 7 + n * 3) % 10 == 0, F.lit(500))
        .when((i * 11 + n * 5) % 17 == 0, F.lit(429))
        .when((i + n) % 97 == 0, F.lit(404))
        .otherwise(F.lit(200))
    )
    return a.withColumn("status", status)


# -------------------------------------------------------------- access log

# Fixed values of the log format.
LOG_METHODS = ("GET", "POST", "PUT", "PATCH", "DELETE")
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"


def user_ip(key: Column) -> Column:
    return F.concat(F.lit("10.0."), F.floor(key / 50).cast("string"), F.lit("."), (key % 50).cast("string"))


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One combined-format access-log line per event (column `value`)."""
    e = spread(read_table(spark, sf_dir, "events"))
    is_err = F.col("event_type") == "error"
    status = F.when(is_err, F.when(F.col("event_id") % 2 == 0, 404).otherwise(500)).otherwise(200)
    level = F.when(is_err, F.lit("ERROR")).otherwise(F.lit("INFO"))
    err_type = F.when(is_err, F.when(F.col("event_id") % 2 == 0, "NOT_FOUND").otherwise("TIMEOUT"))
    method = F.element_at(F.array(*[F.lit(m) for m in LOG_METHODS]), (F.col("event_id") % 5 + 1).cast("int"))
    query = F.when(F.col("event_id") % 4 == 0,
                   F.concat(F.lit("?page="), (F.col("event_id") % 50).cast("string"), F.lit("&q=x"))) \
        .otherwise(F.lit(""))
    line = F.concat(
        user_ip(F.col("user_id")), F.lit(" - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \""),
        method, F.lit(" /api/v1/items/"), F.get_json_object("props", "$.k"), query, F.lit(" HTTP/1.1\" "),
        status.cast("string"), F.lit(" "), F.floor(F.col("value") * 100).cast("string"),
        F.lit(" \"-\" \"agent-"), (F.col("user_id") % 7).cast("string"), F.lit("\" level="), level,
        F.lit(" request_id="), F.format_string("%012x", F.col("event_id")),
        F.coalesce(F.concat(F.lit(" error_type=ERROR:"), err_type), F.lit("")),
    )
    return e.select(line.alias("value"))


USER_LANGUAGES = ("nl", "pt", "sv", "it", "pl", "fi")


def user_documents_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user (D16 `users` element) per customer; ip shared with the log."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    langs = F.array(*[F.lit(x) for x in USER_LANGUAGES])
    return c.select(
        F.format_string("u%05d", k).alias("id"),
        F.struct(
            F.col("c_name").alias("name"),
            F.lower(F.regexp_replace("c_name", "#", "_")).alias("username"),
            user_ip(k).alias("ip"), F.lit("UTC").alias("tz"), F.lit("en_US").alias("locale"),
        ).alias("profile"),
        F.struct(
            F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
            F.concat(F.lit("+1-555-"), F.format_string("%07d", k)).alias("phone"),
        ).alias("contact"),
        F.struct(
            F.element_at(langs, (F.col("c_nationkey") % len(USER_LANGUAGES) + 1).cast("int")).alias("lang"),
            (F.col("c_acctbal") > 0).alias("marketing_opt_in"),
            F.when(k % 2 == 0, "light").otherwise("dark").alias("theme"),
        ).alias("preferences"),
        F.array(F.struct(F.concat(F.lit("agent-"), (k % 7).cast("string")).alias("ua"),
                         F.lit("Linux").alias("os"))).alias("devices"),
        F.array(F.col("c_mktsegment")).alias("tags"),
    )
