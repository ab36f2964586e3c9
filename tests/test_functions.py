"""Column functions on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from etlkit import functions as fn


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_messy_people(spark):
    df = spark.createDataFrame(
        [(1, "  John   Doe  ", "john.doe@GMAIL.com", "(555) 123-4567"), (2, "bob-johnson", "bob@domain.org", "555.987.6543"),
         (3, None, None, None)], "id int, name string, email string, phone string")
    out = df.select("id", fn.clean_text(F.col("name")), fn.first_token(F.col("name")), fn.last_token(F.col("name")),
                    fn.email_domain(F.col("email")), fn.format_phone(F.col("phone")), fn.area_code(F.col("phone"))).collect()
    assert tuple(out[0]) == (1, "john doe", "john", "doe", "gmail.com", "(555) 123-4567", "555")
    assert tuple(out[1]) == (2, "bobjohnson", "bobjohnson", "bobjohnson", "domain.org", "(555) 987-6543", "")
    assert tuple(out[2]) == (3,) + (None,) * 6


def test_text_and_similarity(spark):
    r = one(spark, near=fn.similar(F.lit("kitten"), F.lit("kittin")), far=fn.similar(F.lit("kitten"), F.lit("sitting")),
            words=fn.word_count(F.lit("a b\n c")), chars=fn.no_space_length(F.lit("a b\n c")),
            url=fn.url_parts(F.lit("https://x.org/a/b?q=1")), code=F.soundex(F.lit("Robert")))
    assert (r["near"], r["far"], r["words"], r["chars"], r["code"]) == (True, False, 3, 3, "R163")
    assert tuple(r["url"]) == ("https", "x.org", "/a/b?q=1")


@pytest.mark.parametrize("day,business,weekend", [
    ("2024-03-01", "2024-03-01", False), ("2024-03-02", "2024-03-04", True), ("2024-03-03", "2024-03-04", True)])
def test_business_day(spark, day, business, weekend):
    d = F.lit(day).cast("date")
    r = one(spark, b=fn.next_business_day(d), w=fn.is_weekend(d))
    assert (str(r["b"]), r["w"]) == (business, weekend)


def test_dates(spark):
    d = F.lit("2024-02-15").cast("date")
    math = fn.date_math(d, F.lit("2024-03-31").cast("date"))
    r = one(spark, q=fn.quarter_start(d), p=fn.parse_date(F.lit("02/15/2024")), bad=fn.parse_date(F.lit("x")),
            text=fn.format_date(d, "verbose"), utc=fn.to_utc(F.lit("2024-07-01 00:00:00").cast("timestamp"), "America/New_York"), **math)
    assert str(r["q"]) == "2024-01-01" and str(r["p"]) == "2024-02-15" and r["bad"] is None
    assert r["text"] == "February 15, 2024"
    assert (str(r["date_plus_30"]), str(r["date_minus_7"]), r["days_since"]) == ("2024-03-16", "2024-02-08", 45)
    assert r["months_since"] == 1.51612903
    with pytest.raises(ValueError):
        fn.format_date(d, "long")


def test_stamp_replays(spark):
    df = fn.stamp(spark.range(1), F.lit("2024-05-06 07:08:09"))
    r = df.first()
    assert (r.processing_date_text, r.processing_time_text) == ("2024-05-06", "07:08:09")
    assert r.processing_timestamp == dt.datetime(2024, 5, 6, 7, 8, 9)


def test_tiers_and_ratios(spark):
    r = one(spark, a=fn.tier(F.lit(1001), [(1000, "high"), (100, "medium")], "low"),
            b=fn.tier(F.lit(100), [(1000, "high"), (100, "medium")], "low"), c=fn.tier(F.lit(None).cast("int"), [(1, "x")], "none"),
            d=fn.pct(F.lit(1.0), F.lit(3.0)), e=fn.pct(F.lit(1.0), F.lit(0.0)))
    assert list(r.values()) == ["high", "low", "none", 33.33, None]
    with pytest.raises(ValueError):
        fn.tier(F.lit(1), [], "x")


def test_samples_and_salts_repeat(spark):
    df = spark.range(20_000)
    pick = df.filter(fn.hash_below([F.col("id")], 0.1))
    assert rows(pick) == rows(df.repartition(7).filter(fn.hash_below([F.col("id")], 0.1)))
    assert 1700 < pick.count() < 2300
    salts = df.groupBy(fn.salt([F.col("id")], 8).alias("s")).count().collect()
    assert len(salts) == 8 and min(r["count"] for r in salts) > 2000


def test_nested(spark):
    text = ('{"customer_id":"c1","personal_info":{"name":"A","age":3,"email":"e"},"orders":[{"order_id":"o1","date":"d",'
            '"items":[{"item_id":"i1","quantity":2,"price":1.5},{"item_id":"i2","quantity":1,"price":2.5}]},'
            '{"order_id":"o2","date":"d","items":[]}]}')
    df = spark.createDataFrame([(text,), ("broken",)], "j string").select(fn.parse_json(F.col("j"), fn.CUSTOMER_SCHEMA).alias("customer_data"))
    assert rows(fn.flatten_nested(df)) == [("c1", "A", "o1", "d", "i1", 2, 1.5), ("c1", "A", "o1", "d", "i2", 1, 2.5)]
    packed = fn.nest(spark.createDataFrame([(1, "x", 2)], "a int, b string, c int"), "s", ["b", "c"])
    assert packed.columns == ["a", "s"] and rows(fn.flatten(packed, "s")) == [(1, "x", 2)]
    arrays = spark.createDataFrame([(1, ["x", "y"]), (2, [])], "id int, l array<string>")
    assert rows(fn.explode_rows(arrays, "l", "v", position="p")) == [(1, 0, "x"), (1, 1, "y")]
    assert fn.explode_rows(arrays, "l", "v", outer=True).count() == 3
    with pytest.raises(ValueError, match="missing"):
        fn.nest(arrays, "s", ["zz"])
