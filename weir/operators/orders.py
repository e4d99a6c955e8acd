"""Order documents: totals (A15), domain validation (V2), fetch outcomes
(F8, F9, A14).

Totals follow the order service: amount = round(unit_price x qty, 2) per
line; subtotal = sum of amounts; tax = round(subtotal x rate, 2) with rate
0.07 for USD and 0.20 otherwise; total = round(subtotal + tax, 2). All in
decimal (binary floating point rounds 2.675 to 2.67; decimal gives 2.68).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.operators.quality import valid_rejected
from weir.sources.datasets import ORDER_CURRENCIES, ORDER_STATUSES, TAX_RATE_OTHER, TAX_RATE_USD

MONEY = "decimal(18,2)"


def tax_rate(currency: Column) -> Column:
    return F.when(currency == "USD", F.lit(TAX_RATE_USD).cast("decimal(3,2)")).otherwise(
        F.lit(TAX_RATE_OTHER).cast("decimal(3,2)")
    )


def line_amount(unit_price: Column, qty: Column) -> Column:
    return F.round(unit_price.cast("decimal(18,4)") * qty, 2).cast(MONEY)


def with_amount(lines: DataFrame) -> DataFrame:
    """A15 per line: amount = round(unit_price x qty, 2)."""
    return lines.withColumn("amount", line_amount(F.col("unit_price"), F.col("qty")))


def with_tax_and_total(df: DataFrame) -> DataFrame:
    """subtotal + currency -> tax, total."""
    tax = F.round(F.col("subtotal") * tax_rate(F.col("currency")), 2).cast(MONEY)
    return df.withColumn("tax", tax).withColumn(
        "total", F.round(F.col("subtotal") + F.col("tax"), 2).cast(MONEY)
    )


def order_totals(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """A15 over flat lines (order_id, amount): grouped sum (combined
    map-side, so one huge order is no hot task), then header join."""
    sub = lines.groupBy("order_id").agg(F.sum("amount").cast(MONEY).alias("subtotal"))
    j = headers.select("order_id", "currency").join(sub, "order_id", "left")
    j = j.withColumn("subtotal", F.coalesce(F.col("subtotal"), F.lit(0).cast(MONEY)))
    return with_tax_and_total(j).select("order_id", "currency", "subtotal", "tax", "total")


def with_nested_totals(docs: DataFrame) -> DataFrame:
    """A15 over documents with a `lines` array (null: no lines): subtotal,
    tax and total by a per-document fold, no shuffle at all."""
    sub = F.aggregate(
        "lines", F.lit(0).cast(MONEY),
        lambda acc, ln: (acc + line_amount(ln["unit_price"], ln["qty"])).cast(MONEY),
    )
    return with_tax_and_total(docs.withColumn("subtotal", F.coalesce(sub, F.lit(0)).cast(MONEY)))


def order_totals_nested(docs: DataFrame) -> DataFrame:
    """The totals of `with_nested_totals` alone, one row per document."""
    return with_nested_totals(docs).select("order_id", "currency", "subtotal", "tax", "total")


def order_documents(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Headers with their `lines` array (D12), in a fixed order, and the totals
    of the same lines. A document is one record by its format, so all lines of an
    order meet in one row."""
    fields = ("sku", "name", "qty", "unit_price", "amount", "usage_month")
    nested = lines.groupBy("order_id").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("lines"), F.sum("amount").cast(MONEY).alias("subtotal"))
    docs = headers.join(nested, "order_id", "left").withColumns({
        "lines": F.coalesce("lines", F.array()), "subtotal": F.coalesce("subtotal", F.lit(0).cast(MONEY))})
    return with_tax_and_total(docs)


def validate_orders(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """V2: order_id, valid, failed_rules (comma list). Totals and line rules
    are folded in one grouped pass over the lines (map-side combined)."""
    folded = lines.groupBy("order_id").agg(
        F.sum("amount").cast(MONEY).alias("subtotal"),
        F.bool_and(F.col("qty") >= 1).alias("lines_qty_ok"),
        F.bool_and(F.col("unit_price") >= 0).alias("lines_unit_price_ok"),
        F.bool_and(F.col("amount") >= 0).alias("lines_amount_ok"),
    )
    j = headers.select("order_id", "status", "currency").join(folded, "order_id", "left")
    j = with_tax_and_total(j.withColumn("subtotal", F.coalesce(F.col("subtotal"), F.lit(0).cast(MONEY))))
    rules = {
        "qty>=1": F.coalesce(F.col("lines_qty_ok"), F.lit(True)),
        "unit_price>=0": F.coalesce(F.col("lines_unit_price_ok"), F.lit(True)),
        "amount>=0": F.coalesce(F.col("lines_amount_ok"), F.lit(True)),
        "subtotal>=0": F.col("subtotal") >= 0,
        "tax>=0": F.col("tax") >= 0,
        "total>=0": F.col("total") >= 0,
        "status": F.col("status").isin(*ORDER_STATUSES),
        "currency": F.col("currency").isin(*ORDER_CURRENCIES),
    }
    out = valid_rejected(j, rules)
    return out.select("order_id", "valid", F.concat_ws(",", "failed_rules").alias("failed_rules"))


# ------------------------------------------------------ fetch outcomes
def _retryable(status: Column) -> Column:
    """429, 5xx and timeouts / transport errors (null status) are retried."""
    return status.isNull() | (status == 429) | ((status >= 500) & (status < 600))


def fetch_outcomes(attempts: DataFrame, max_attempts: int = 5) -> DataFrame:
    """per item, the first attempt that ends it: 200 -> fetched, other
    non-retryable -> gave_up; none within `max_attempts` -> exhausted.
    A grouped min over terminal rows of attempt * 1000 + status (statuses
    have three digits): one long, so it stays a hash aggregate."""
    a = attempts.filter(F.col("attempt") <= max_attempts)
    code = F.col("attempt").cast("long") * 1000 + F.col("status")
    first = a.groupBy("item_id").agg(F.min(F.when(~_retryable(F.col("status")), code)).alias("first"))
    outcome = (
        F.when(F.col("first").isNull(), F.lit("exhausted"))
        .when(F.col("first") % 1000 == 200, F.lit("fetched"))
        .otherwise(F.lit("gave_up"))
    )
    return first.select(
        "item_id", outcome.alias("outcome"),
        F.coalesce(F.expr("first div 1000").cast("int"), F.lit(max_attempts)).alias("attempts"),
    )


def fetched_only(outcomes: DataFrame) -> DataFrame:
    """F8: successful fetches only."""
    return outcomes.filter(F.col("outcome") == "fetched")
