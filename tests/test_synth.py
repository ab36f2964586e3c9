"""Generated tables: counts, domains, repeatability."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from etlkit.functions import flatten_nested
from etlkit.sources import synth as S

AS_OF = "2024-06-30"


def test_sales_skew_and_seed(spark):
    df = S.synth_sales(spark, 20_000, skew=0.4, seed=3)
    share = df.filter("category = 'Electronics'").count() / 20_000
    assert 0.48 < share < 0.56
    lo, hi = df.agg(F.min("sales"), F.max("sales")).first()
    assert lo >= 10 and hi <= 10_000 and dict(df.dtypes)["date"] == "date"
    assert rows(df) == rows(S.synth_sales(spark, 20_000, skew=0.4, seed=3).repartition(9))
    assert rows(df.limit(50)) != rows(S.synth_sales(spark, 50, skew=0.4, seed=4))


def test_financial_and_series(spark):
    f = S.synth_financial(spark, 500)
    assert f.count() == 500 and f.filter("amount < 1 or amount > 50000").count() == 0
    s = S.synth_series(spark, 48, "hourly")
    assert s.agg(F.max("timestamp").cast("string")).first()[0] == "2023-01-02 23:00:00"
    assert S.synth_series(spark, 3, "weekly").agg(F.max("timestamp").cast("string")).first()[0] == "2023-01-15 00:00:00"
    with pytest.raises(ValueError):
        S.synth_series(spark, 1, "yearly")


def test_nested(spark):
    n = S.synth_nested(spark, 200)
    sizes = n.select(F.size("customer_data.orders").alias("n")).agg(F.min("n"), F.max("n")).first()
    assert tuple(sizes) == (1, 3)
    items = flatten_nested(n)
    assert 200 * 1 <= items.count() <= 200 * 15 and items.filter("quantity not between 1 and 10").count() == 0


def test_dimensions_and_defects(spark):
    c, p, s = S.synth_customers(spark, 300, AS_OF), S.synth_products(spark, 100, AS_OF), S.synth_stores(spark, 20, AS_OF)
    assert (c.count(), p.count(), s.count()) == (300, 100, 20)
    assert c.filter(f"created_date >= '{AS_OF}'").count() == 0 and c.filter("tier is null").count() > 0
    t = S.synth_transactions(spark, 6000, 300, 100, 20, AS_OF, seed=1)
    extra = t.count() - 6000
    assert extra > 60 and t.count() - t.distinct().count() == extra
    for defect in ("customer_id is null", "product_id = 'INVALID_PROD'", "amount < 0", f"transaction_date > '{AS_OF}'", "quantity is null"):
        assert 60 < t.filter(defect).count() < 300, defect
    assert t.join(s, "store_id").count() == t.count()
    assert t.join(c, "customer_id", "left_anti").filter("customer_id is not null").count() == 0
    clean = S.synth_transactions(spark, 500, 300, 100, 20, AS_OF, defect_rate=0.0)
    assert clean.count() == 500 and clean.filter("customer_id is null or amount < 0").count() == 0


def test_presets():
    assert S.SIZES["xlarge"] == (2_000_000, 0.4) and S.ENVIRONMENTS["stress_test"][3] == 5_000_000
