from decimal import Decimal

from pyspark.sql import functions as F

from weir import schemas
from weir.operators import orders as O


def test_totals_round_half_up_in_decimal(spark):
    # 2.675 as a binary double rounds down; in decimal it is 2.68
    lines = spark.createDataFrame([(1, "2.675"), (2, "10.00")], "order_id long, amount string") \
        .select("order_id", F.round(F.col("amount").cast("decimal(18,3)"), 2).cast("decimal(18,2)").alias("amount"))
    headers = spark.createDataFrame([(1, "USD"), (2, "EUR"), (3, "EUR")], "order_id long, currency string")
    got = {r.order_id: (r.subtotal, r.tax, r.total) for r in O.order_totals(lines, headers).collect()}
    assert got[1] == (Decimal("2.68"), Decimal("0.19"), Decimal("2.87"))
    assert got[2] == (Decimal("10.00"), Decimal("2.00"), Decimal("12.00"))
    assert got[3] == (Decimal("0.00"), Decimal("0.00"), Decimal("0.00"))   # order without lines


def test_totals_from_nested_lines(spark):
    docs = spark.createDataFrame(
        [(1, "USD", [("s", "n", 3, 0.041, 0.12, "2025-01-01"), ("t", "n", 2, 29.0, 58.0, "2025-01-01")])],
        "order_id long, currency string, lines array<struct<sku:string,name:string,qty:int,"
        "unit_price:double,amount:double,usage_month:string>>",
    )
    r = O.order_totals_nested(docs).first()
    assert (r.subtotal, r.tax, r.total) == (Decimal("58.12"), Decimal("4.07"), Decimal("62.19"))


def test_documents_carry_their_lines_and_totals(spark):
    headers = spark.createDataFrame([(1, "USD"), (2, "EUR")], "order_id long, currency string")
    lines = O.with_amount(spark.createDataFrame(
        [(1, "t", "n", 2, Decimal("29.0000"), "m"), (1, "s", "n", 3, Decimal("0.0415"), "m")],
        "order_id long, sku string, name string, qty int, unit_price decimal(18,4), usage_month string"))
    got = {r.order_id: r for r in O.with_nested_totals(O.order_documents(headers, lines)).collect()}
    assert [(x.sku, x.amount) for x in got[1].lines] == [("s", Decimal("0.12")), ("t", Decimal("58.00"))]
    assert (got[1].subtotal, got[1].total) == (Decimal("58.12"), Decimal("62.19"))
    assert got[2].lines == [] and got[2].total == Decimal("0.00")   # order without lines


def test_validation_names_failed_rules(spark):
    headers = spark.createDataFrame([(1, "paid", "USD"), (2, "unknown", "XXX")],
                                    "order_id long, status string, currency string")
    lines = spark.createDataFrame([(1, 1, Decimal("1.0"), Decimal("1.00")), (2, 0, Decimal("1.0"), Decimal("0.00"))],
                                  "order_id long, qty int, unit_price decimal(18,4), amount decimal(18,2)")
    got = {r.order_id: (r.valid, r.failed_rules) for r in O.validate_orders(headers, lines).collect()}
    assert got[1] == (True, "")
    assert got[2] == (False, "qty>=1,status,currency")


def test_fetch_outcomes_all_classes(spark):
    attempts = spark.createDataFrame([
        (1, 1, 500), (1, 2, 200),                      # retried then fetched
        (2, 1, 429), (2, 2, 404),                      # gave up on 404
        (3, 1, 500), (3, 2, None), (3, 3, 429), (3, 4, 503), (3, 5, 500),   # exhausted
        (4, 1, 200),
    ], "item_id long, attempt int, status int")
    got = {r.item_id: (r.outcome, r.attempts) for r in O.fetch_outcomes(attempts).collect()}
    assert got == {1: ("fetched", 2), 2: ("gave_up", 2), 3: ("exhausted", 5), 4: ("fetched", 1)}


def test_strict_documents_reader(spark, tmp):
    from weir.sources.files import read_documents_strict

    path = f"{tmp}/docs"
    with open(f"{tmp}/ok.json", "w"):
        pass
    import os

    os.makedirs(path)
    with open(f"{path}/a.json", "w") as f:
        f.write('{"order_id": 1, "account_id": 2, "company": "c", "status": "paid", "currency": "USD", '
                '"subtotal": 1.0, "tax": 0.07, "total": 1.07, "created_at": "x", "source": "mock"}\n')
        f.write('{"order_id": 2, "account_id": 3, "status": "paid", "currency": "USD", '
                '"subtotal": 1.0, "tax": 0.07, "total": 1.07, "created_at": "x", "source": "mock"}\n')
    df = read_documents_strict(spark, path, schemas.ORDER, schemas.ORDER_CSV_FIELDS)
    try:
        df.collect()
        raised = False
    except Exception as ex:  # noqa: BLE001
        raised = "required field" in str(ex)
    assert raised


def test_documents_are_stored_compressed(spark, tmp):
    import glob

    from weir.plans import orders
    from weir.sources.files import read_documents_strict

    sf = f"{tmp}/orders_sf"
    spark.sql("SELECT 1L l_orderkey, 3L l_partkey, 2D l_quantity, 10.5D l_extendedprice, "
              "TIMESTAMP_NTZ '2024-01-05 00:00:00' l_shipdate").write.parquet(f"{sf}/lineitem.parquet")
    spark.sql("SELECT 1L o_orderkey, 7L o_custkey, 'F' o_orderstatus, "
              "TIMESTAMP_NTZ '2024-01-05 00:00:00' o_orderdate").write.parquet(f"{sf}/orders.parquet")
    spark.sql("SELECT 7L c_custkey, 'Customer#7' c_name, 1 c_nationkey").write.parquet(f"{sf}/customer.parquet")
    orders._documents(spark, sf, f"{tmp}/docs")
    assert glob.glob(f"{tmp}/docs/*.json.gz") and not glob.glob(f"{tmp}/docs/*.json")
    read = read_documents_strict(spark, f"{tmp}/docs", schemas.ORDER, (*schemas.ORDER_CSV_FIELDS, "lines")).first()
    assert (read.order_id, read.status, len(read.lines)) == (1, "paid", 1)
