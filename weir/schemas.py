"""Declared schemas of the reference datasets.

Declaring them means no inference pass and stable types. NOT NULL in the
declarations is documentation only: Spark's file readers make every field
nullable, so required fields are checked by `weir.operators.quality`.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# KPI inputs
USERS = _s(("id", L), ("signup_date", S), ("plan", S), ("country", S), ("marketing_opt_in", B))
ITEMS = _s(("item_id", L), ("category", S), ("tags", T.ArrayType(S)))
EVENT_CONTEXT = _s(("country", S), ("device", S), ("locale", S), ("session_id", S))
EVENT_PROPS = _s(("price", D), ("payment_method", S), ("dwell_ms", I))
EVENT_EXP = _s(("ab_group", S))
EVENTS = _s(
    ("ts", S), ("event", S), ("user_id", L), ("item_id", L),
    ("context", EVENT_CONTEXT), ("props", EVENT_PROPS), ("exp", EVENT_EXP),
)

# Lab tables (TIMESTAMP without zone)
SESSIONS = _s(("session_code", S), ("session_name", S))
PEOPLE = _s(("person_id", L), ("full_name", S), ("team", S), ("badge_uid", S))
SWIPES = _s(("badge_uid", S), ("session_code", S), ("ts", T.TimestampNTZType()))
PURCHASES = _s(
    ("purchase_id", L), ("badge_uid", S), ("location", S), ("product", S), ("qty", I),
    ("ts", T.TimestampNTZType()),
)

# Fuel export as written by the exporter (visited_at is ns in files)
DOCK = _s(("bay", T.ShortType()), ("level", S))
FUEL_EXPORT = _s(
    ("transaction_id", S), ("station_id", I), ("dock", DOCK), ("ship_name", S),
    ("franchise", S), ("captain_name", S), ("species", S), ("fuel_type", S),
    ("fuel_units", T.FloatType()), ("price_per_unit", T.DecimalType(8, 2)),
    ("total_cost", T.DecimalType(12, 2)), ("services", T.ArrayType(S)),
    ("is_emergency", B), ("visited_at", T.TimestampType()), ("arrival_date", T.DateType()),
    ("coords_x", D), ("coords_y", D),
)

# The flattened target table
FUEL_TARGET = _s(
    ("transaction_id", S), ("station_id", I), ("dock_bay", T.ShortType()), ("dock_level", S),
    ("ship_name", S), ("franchise", S), ("captain_name", S), ("species", S), ("fuel_type", S),
    ("fuel_units", T.FloatType()), ("price_per_unit", T.DecimalType(8, 2)),
    ("total_cost", T.DecimalType(12, 2)), ("services", T.ArrayType(S)), ("is_emergency", B),
    ("visited_at", T.TimestampType()), ("arrival_date", T.DateType()), ("coords_x", D),
    ("coords_y", D), ("source_file", S), ("loaded_at", T.TimestampType()),
)

# D7 / D8 column rules of the target tables: (column, max length or None, not null)
FUEL_TARGET_RULES = (
    ("transaction_id", 100, True), ("station_id", None, True), ("dock_level", 10, False),
    ("ship_name", 255, False), ("franchise", 255, False), ("captain_name", 255, False),
    ("species", 100, False), ("fuel_type", 100, False), ("source_file", 255, False),
)
FUEL_TARGET_KEY = "transaction_id"

# Stream envelope, Avro payload, stream output
ENVELOPE = _s(
    ("key", T.BinaryType()), ("value", T.BinaryType()), ("topic", S), ("partition", I),
    ("offset", L), ("timestamp", T.TimestampType()),
)
PAYLOAD = _s(("user", S), ("event", S), ("amount", D), ("ts", L))

# Order documents and the 9 CSV fields
CONTACT = _s(("name", S), ("email", S), ("phone", S), ("country", S))
ORDER_LINE = _s(
    ("sku", S), ("name", S), ("qty", I), ("unit_price", D), ("amount", D), ("usage_month", S)
)
ORDER = _s(
    ("order_id", L), ("account_id", L), ("company", S), ("contact", CONTACT), ("status", S),
    ("currency", S), ("lines", T.ArrayType(ORDER_LINE)), ("subtotal", D), ("tax", D),
    ("total", D), ("created_at", S), ("source", S),
)
ORDER_CSV_FIELDS = (
    "order_id", "account_id", "company", "status", "currency", "subtotal", "tax", "total",
    "created_at",
)

# the CSV fields of a document, its lines as the text they are (not parsed)
ORDER_HEAD = T.StructType([*[ORDER[c] for c in ORDER_CSV_FIELDS], T.StructField("lines", S)])

# Sample people CSV (inferred in the reference)
SAMPLE_PEOPLE = _s(("id", L), ("name", S), ("age", I), ("city", S))

# Users document
USER_PROFILE = _s(("name", S), ("username", S), ("ip", S), ("tz", S), ("locale", S))
USER_DOC = _s(
    ("id", S), ("profile", USER_PROFILE), ("contact", _s(("email", S), ("phone", S))),
    ("preferences", _s(("lang", S), ("marketing_opt_in", B), ("theme", S))),
    ("devices", T.ArrayType(_s(("ua", S), ("os", S)))), ("tags", T.ArrayType(S)),
)
USERS_DOCUMENT = _s(
    ("generated_at", S), ("meta", _s(("source", S), ("version", L))),
    ("users", T.ArrayType(USER_DOC)),
)

# D5 column rules of the lab tables: (column, max length or None, not null),
# and their PRIMARY KEY / UNIQUE columns.
LAB_RULES = {
    "sessions": ((("session_code", 10, True), ("session_name", 100, False)), ("session_code",)),
    "people": ((("person_id", None, True), ("full_name", 100, False), ("team", 50, False),
                ("badge_uid", 50, False)), ("person_id", "badge_uid")),
    "swipes": ((("badge_uid", 50, False), ("session_code", 10, False)), ()),
    "purchases": ((("purchase_id", None, True), ("badge_uid", 50, False), ("location", 50, False),
                   ("product", 50, False)), ("purchase_id",)),
}
