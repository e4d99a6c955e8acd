import datetime as dt

from weir import schemas
from weir.operators import logs as G
from weir.sources.files import read_json_documents


LINES = [
    '10.0.0.1 - - [05/Mar/2025:10:11:12 +0000] "GET /api/v1/items/42?page=7&q=box HTTP/1.1" 200 1234 '
    '"-" "agent-1" level=INFO request_id=abc123def456',
    '10.0.0.2 - - [05/Mar/2025:10:11:13 +0000] "POST /login HTTP/1.1" 503 99 "https://example.com" '
    '"agent-2" level=ERROR request_id=zzz error_type=ERROR:UPSTREAM_TIMEOUT',
    "not a log line",
]


def test_parse_lines(spark):
    df = G.parse_access_log(spark.createDataFrame([(x,) for x in LINES], "value string"))
    rows = {r.request_id: r for r in df.collect()}
    a = rows["abc123def456"]
    assert (a.ip, a.method, a.path, a.page, a.status, a.bytes, a.level, a.error_type) == \
        ("10.0.0.1", "GET", "/api/v1/items/42", 7, 200, 1234, "INFO", None)
    assert a.ts == dt.datetime(2025, 3, 5, 10, 11, 12)
    b = rows["zzz"]
    assert (b.status, b.level, b.error_type, b.page) == (503, "ERROR", "UPSTREAM_TIMEOUT", None)
    assert rows[None].ip is None   # unparsable line kept, all nulls
    counts = {(r.error_type, r.status): r.lines for r in G.error_counts(df).collect()}
    assert counts == {("UPSTREAM_TIMEOUT", 503): 1}


def test_users_documents_round_trip(spark, tmp):
    users = spark.createDataFrame([
        ("u00000", ("Ann", "ann", "10.0.0.1", "UTC", "en_US"), ("a@x", "1"), ("en", True, "dark"),
         [("ua", "Linux"), ("ub", "iOS")], ["vip"]),
        ("u00001", ("Bob", "bob", "10.0.0.9", "UTC", "en_US"), ("b@x", "2"), ("de", False, "light"),
         [], []),
    ], schemas.USER_DOC).repartition(2)
    G.pack_user_documents(users, "2025-01-01T00:00:00Z").write.text(f"{tmp}/docs")
    flat = G.flatten_users(read_json_documents(spark, f"{tmp}/docs", schemas.USERS_DOCUMENT))
    got = {r.id: (r.ip, r.devices, r.tags) for r in flat.collect()}
    assert got == {"u00000": ("10.0.0.1", 2, "vip"), "u00001": ("10.0.0.9", 0, "")}
    log = G.parse_access_log(spark.createDataFrame([(x,) for x in LINES], "value string"))
    joined = {r.ip: r.user_id for r in G.requests_per_user(log, flat).collect()}
    assert joined == {"10.0.0.1": "u00000", "10.0.0.2": None, None: None}


def test_odd_values_in_a_line_are_nulls(spark):
    from weir.operators import logs as G

    line = '1.2.3.4 - - [{}] "GET {} HTTP/1.1" 200 {} "-" "ua" level=INFO request_id=r1'
    rows = [(line.format("garbage", "/a", "5"),), (line.format("10/Oct/2024:13:55:36 +0000", "/a?page=abc", "9" * 30),),
            (line.format("10/Oct/2024:13:55:36 +0000", "/a?page=7", "5"),), ("no log line",)]
    got = G.parse_access_log(spark.createDataFrame(rows, "value string")).collect()
    assert got[0].ts is None and got[0].bytes == 5 and got[0].path == "/a"
    assert got[1].page is None and got[1].bytes is None and got[1].ts is not None
    assert got[2].page == 7 and got[2].status == 200 and got[2].error_type is None
    assert all(v is None for v in got[3])
