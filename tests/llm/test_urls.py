from datetime import datetime

from pyspark.sql import functions as F

from etlkit.llm import urls

DAY = lambda n: datetime(2024, 1, n)
ENTRIES = [
    ("example.com", "block", DAY(5)), ("example.com", "remove", DAY(10)), ("example.com", "block", DAY(20)),
    ("good.example.com", "allow", DAY(6)), ("good.example.com/ads", "block", DAY(1)), ("other.org", "block", DAY(3)),
    ("other.org", "allow", DAY(3)), (None, "block", DAY(1)), ("late.net", "block", None), ("late.net", None, DAY(2)),
    ("other.org", "block", DAY(3)),
]


def test_entries_in_force_at_fetch_time(spark):
    asked = [
        (1, "http://example.com/", DAY(4), False), (2, "http://example.com/", DAY(5), True), (3, "HTTP://Example.com./x", DAY(9), True),
        (4, "http://a.b.example.com:80/x?y#z", DAY(10), False), (5, "https://u@a.example.com", DAY(25), True),
        (6, "http://good.example.com/x", DAY(7), False), (7, "http://good.example.com/ads/1", DAY(7), True),
        (8, "http://good.example.com/x", DAY(5), True), (9, "http://notexample.com/", DAY(6), False), (10, "http://other.org/?q", DAY(4), True),
        (11, None, DAY(4), False), (12, "no url", DAY(4), False), (13, "http://example.com/", None, False), (14, "", DAY(4), False),
        (None, "http://other.org/", DAY(4), True), (2, "http://example.com/", DAY(5), True), (15, "http://late.net/", DAY(5), False),
        (16, "http://other.org/" + "p/" * 3000, DAY(4), True), (17, "http://[::1]:8080/x", DAY(4), False),
    ]
    captures = spark.createDataFrame([(a, b, c, "x", 1) for a, b, c, _ in asked], "page_id long, url string, fetched_at timestamp_ntz, key string, action int")
    entries = spark.createDataFrame(ENTRIES, "key string, action string, at timestamp_ntz")
    got = urls.judged(captures, entries).collect()
    assert sorted((str(r.page_id), str(r.url), r.blocked) for r in got) == sorted((str(a), str(b), d) for a, b, _, d in asked)
    keys = {r.page_id: r.matched_key for r in got}
    assert keys[7] == "good.example.com/ads" and keys[6] == "good.example.com" and keys[5] == "example.com" and keys[1] is None


def test_intervals_do_not_overlap(spark):
    entries = spark.createDataFrame(ENTRIES, "key string, action string, at timestamp_ntz")
    got = [tuple(r) for r in urls.validity(entries).filter("key = 'example.com'").orderBy("since").collect()]
    assert got == [("example.com", "block", DAY(5), DAY(10)), ("example.com", "block", DAY(20), None)]


def test_empty_tables(spark):
    captures = spark.createDataFrame([(1, "http://example.com/", DAY(6))], "page_id long, url string, fetched_at timestamp_ntz")
    entries = spark.createDataFrame(ENTRIES, "key string, action string, at timestamp_ntz")
    assert urls.judged(captures.filter(F.lit(False)), entries).count() == 0
    assert not urls.judged(captures, entries.filter(F.lit(False))).first().blocked


def test_entries_of_any_depth(spark):
    deep = "a.com/" + "/".join(f"p{k}" for k in range(12))
    entries = spark.createDataFrame([("a.com/x/y/z/w", "block", DAY(1)), (deep, "block", DAY(1)), ("a.com/x/y/z/w/v", "allow", DAY(1))], "key string, action string, at timestamp_ntz")
    asked = {"http://a.com/x/y/z/w/page": True, "http://a.com/x/y/z": False, "http://a.com/x/y/z/w/v/u": False, f"http://{deep}/q?z": True, "http://a.com/": False, "http://b.a.com/x/y/z/w": False}
    captures = spark.createDataFrame([(k, u, DAY(3)) for k, u in enumerate(asked)], "page_id long, url string, fetched_at timestamp_ntz")
    assert {r.url: r.blocked for r in urls.judged(captures, entries).collect()} == asked


def test_list_of_the_query_is_one_pass(spark, data):
    from etlkit.llm.queries import list_entries

    pages = spark.read.parquet(f"{data}/pages.parquet")
    entries = list_entries(pages)
    assert entries._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert entries.count() > 10
