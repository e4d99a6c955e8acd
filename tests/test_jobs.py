"""Jobs over files in the reference's input formats (hand-written rows)."""

import gzip
import json
import os


from weir.functions.avro import encode_record  # noqa: F401  (import check)
from weir.plans import jobs
from tests.test_sql_reports import GOLDEN_HASH


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_presence_job_on_csv_files(spark, tmp):
    _write(f"{tmp}/people.csv", "person_id,full_name,team,badge_uid\n"
           "1,Ada Nguyen,Gamma,BDG-1\n2,Juno Garcia,Alpha,BDG-2\n3,Bo Park,Beta,BDG-3\n")
    _write(f"{tmp}/sessions.csv", "session_code,session_name\nS1,RED\nS3,GOLD\n")
    _write(f"{tmp}/swipes.csv", "badge_uid,session_code,ts\n"
           "BDG-1,S3,2025-09-01 13:02:00\nBDG-2,S3,2025-09-01 13:13:32\nBDG-3,S1,2025-09-01 10:00:00\n")
    _write(f"{tmp}/purchases.csv", "purchase_id,badge_uid,location,product,qty,ts\n"
           "1,BDG-2,cafeteria,Coffee,1,2025-09-01 15:11:32\n2,BDG-2,cafeteria,Coffee,1,2025-09-01 15:30:00\n"
           "3,BDG-2,cafeteria,Coffee,1,2025-09-01 16:00:00\n4,BDG-3,cafeteria,Coffee,1,2025-09-01 15:05:00\n"
           "5,BDG-1,cafeteria,Coffee,1,2025-09-01 15:06:00\n")
    rows = jobs.presence_job(spark, tmp).collect()
    assert [(r.thief_name, r.verification_hash, r.coffees_bought_after_15h) for r in rows] == \
        [("Juno Garcia", GOLDEN_HASH, 3)]
    counts = {r.table_name: r.row_count for r in jobs.presence_table_counts(spark, tmp).collect()}
    assert counts == {"people": 3, "sessions": 2, "swipes": 3, "purchases": 5}


def test_kpi_job_on_jsonl_files(spark, tmp):
    _write(f"{tmp}/users.jsonl", "\n".join(json.dumps(u) for u in [
        {"id": 1, "signup_date": "2025-01-01", "plan": "free", "country": "TH", "marketing_opt_in": False},
        {"id": 2, "signup_date": "2025-01-02", "plan": "pro", "country": "DE", "marketing_opt_in": True},
    ]) + "\n")
    _write(f"{tmp}/items.jsonl", json.dumps({"item_id": 7, "category": "books", "tags": ["new"]}) + "\n")
    os.makedirs(f"{tmp}/events")
    evs = [
        {"ts": "2025-03-01T10:00:00+00:00", "event": "purchase", "user_id": 1, "item_id": 7,
         "context": {"country": "US", "device": "web", "locale": "en_US", "session_id": "s"},
         "props": {"price": 12.5, "payment_method": "card", "dwell_ms": None}, "exp": {"ab_group": "A"}},
        {"ts": "2025-03-01T11:00:00+00:00", "event": "view", "user_id": 2, "item_id": 7,
         "context": {"country": "US"}, "props": {}, "exp": {"ab_group": "B"}},
        {"ts": "2025-03-02T11:00:00+00:00", "event": "purchase", "user_id": 2, "item_id": 7,
         "context": {"country": "US"}, "props": {"price": -1.0}, "exp": {}},
    ]
    with gzip.open(f"{tmp}/events/part-00.jsonl.gz", "wt") as f:
        f.write("\n".join(json.dumps(e) for e in evs) + "\n")
    kpi = jobs.kpi_job(spark, f"{tmp}/users.jsonl", f"{tmp}/items.jsonl", f"{tmp}/events",
                       out=f"{tmp}/out", spread_to=4)
    rows = spark.read.parquet(f"{tmp}/out").collect()
    assert len(rows) == 1   # the negative purchase is dropped, so only 2025-03-01 remains
    r = rows[0]
    assert (r.country, r.category, r.events_total, r.purchases, r.unique_users) == ("US", "books", 2, 1, 2)
    assert str(r.revenue) == "12.50" and str(r.date) == "2025-03-01"
    assert kpi.count() == 1


def test_orders_and_logs_jobs(spark, tmp):
    _write(f"{tmp}/docs/a.json",
           json.dumps({"order_id": 2, "account_id": 9, "company": "B", "status": "paid", "currency": "EUR",
                       "subtotal": 1.0, "tax": 0.2, "total": 1.2, "created_at": "t", "source": "mock",
                       "lines": [{"sku": "s", "name": "n", "qty": 1, "unit_price": 1.0, "amount": 1.0,
                                  "usage_month": "2025-01-01"}]}) + "\n" +
           json.dumps({"order_id": 1, "account_id": 8, "company": "A", "status": "created", "currency": "USD",
                       "subtotal": 2.0, "tax": 0.14, "total": 2.14, "created_at": "t", "source": "mock"}) + "\n")
    jobs.orders_job(spark, f"{tmp}/docs", f"{tmp}/csv")
    back = spark.read.option("header", True).csv(f"{tmp}/csv")
    assert back.columns[:3] == ["order_id", "account_id", "company"]
    assert sorted(int(r.order_id) for r in back.collect()) == [1, 2]

    os.makedirs(f"{tmp}/logs")
    with gzip.open(f"{tmp}/logs/access-000.log.gz", "wt") as f:
        f.write('10.0.0.1 - - [05/Mar/2025:10:11:12 +0000] "GET /health HTTP/1.1" 200 10 "-" "ua" '
                "level=INFO request_id=a1\n")
        f.write('10.0.0.1 - - [05/Mar/2025:10:11:13 +0000] "GET /login HTTP/1.1" 500 10 "-" "ua" '
                "level=ERROR request_id=a2 error_type=ERROR:DB_CONN_FAIL\n")
    _write(f"{tmp}/users.json", json.dumps({"generated_at": "x", "meta": {"source": "s", "version": 1}, "users": [
        {"id": "u00000", "profile": {"name": "A", "username": "a", "ip": "10.0.0.1", "tz": "UTC", "locale": "en"},
         "contact": {"email": "e", "phone": "p"}, "preferences": {"lang": "en", "marketing_opt_in": True,
         "theme": "dark"}, "devices": [{"ua": "x", "os": "Linux"}], "tags": ["vip"]}]}, indent=2))
    errors, per_user = jobs.logs_job(spark, f"{tmp}/logs", f"{tmp}/users.json", spread_to=2)
    assert [(r.error_type, r.status, r.lines) for r in errors.collect()] == [("DB_CONN_FAIL", 500, 1)]
    assert [(r.ip, r.user_id, r.requests, r.errors) for r in per_user.collect()] == [("10.0.0.1", "u00000", 2, 1)]
