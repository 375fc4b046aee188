"""Text and table round trips."""

from decimal import Decimal

import pytest

import tillroll as tr
from tillroll.session import scratch_path


def test_receipt_text_round_trip(spark, write_text):
    src = "2015-08-20,pane,latte\n2015-10-05\n2015-09-01,vino,vino\n"
    rec = tr.read_receipts(spark, write_text(src))
    for form in ("comma", "colon"):
        out = scratch_path(spark, f"rt-{form}")
        tr.write_lines(tr.receipt_lines(rec, form), out)
        back = tr.read_receipts(spark, out, form)
        assert sorted((r.data, tuple(r.products)) for r in back.collect()) == \
            sorted((r.data, tuple(r.products)) for r in rec.collect())


def test_write_overwrites(spark):
    out = scratch_path(spark, "ow")
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    tr.write_lines(df, out)
    tr.write_lines(df.limit(1), out)
    assert spark.read.text(out).count() == 1


def test_key_value_lines(spark):
    out = scratch_path(spark, "kv")
    df = spark.createDataFrame([("pane", "3"), ("vino", None)], "k string, v string")
    tr.write_key_value(df, out, "k", "v")
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["pane\t3", "vino\t"]


def test_price_round_trip(spark, write_text):
    prices = tr.read_prices(spark, write_text("pane,3\nlatte,3.5\n"))
    out = scratch_path(spark, "prices")
    tr.write_lines(tr.price_lines(prices), out)
    assert sorted(map(tuple, tr.read_prices(spark, out).collect())) == sorted(map(tuple, prices.collect()))


def test_tables(spark):
    tr.create_table(spark, "t_prices", tr.PRICE_SCHEMA, scratch_path(spark, "t_prices"))
    assert tr.read_table(spark, "t_prices").count() == 0
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "product string, price double")
    tr.load_into_table(spark, tr.typed_prices(df), "t_prices", scratch_path(spark, "t_prices"))
    tr.load_into_table(spark, tr.typed_prices(df), "t_prices", scratch_path(spark, "t_prices"))
    assert tr.read_table(spark, "t_prices").count() == 2
    tr.drop_table(spark, "t_prices")
    assert not spark.catalog.tableExists("t_prices")


def test_prices_are_never_rounded(spark, write_text):
    ok = spark.createDataFrame([("a", 3.9), ("b", 1e6), ("c", None), ("d", 0.0)], "product string, price double")
    assert [str(r.price) for r in tr.typed_prices(ok).collect()] == ["3.90", "1000000.00", "None", "0.00"]
    for kind, value in (("double", 3.999), ("string", "3.999"), ("decimal(9,3)", Decimal("3.999"))):
        bad = spark.createDataFrame([("a", value)], f"product string, price {kind}")
        items = spark.createDataFrame([(1, "2024-01", "a")], "rid int, month string, product string")
        with pytest.raises(Exception, match="price does not fit"):
            tr.typed_prices(bad, scale=2).collect()
        if not kind.startswith("decimal"):
            with pytest.raises(Exception, match="price does not fit"):
                tr.monthly_revenue(items, bad).collect()


def test_price_lists_of_a_larger_scale(spark, write_text):
    path = write_text("pane,3.999\nlatte,1.25\n")
    with pytest.raises(Exception, match="price does not fit"):
        tr.read_prices(spark, path).collect()
    prices = tr.read_prices(spark, path, scale=4)
    items = spark.createDataFrame([(1, "2024-01", "pane"), (2, "2024-01", "pane")], "rid int, month string, product string")
    for how in ("inner", "full"):
        rev = tr.monthly_revenue(items, prices, how=how).where("product = 'pane'").first()
        assert (str(rev.price), str(rev.total)) == ("3.9990", "7.9980")


def test_empty_items_inside_and_at_the_end(spark, write_text):
    path = write_text("2024-01-01,a,,b,,\n2024-01-02,,\n2024-01-03\n\n2024-01-04,,c\n")
    got = {rule: [list(r.products) for r in tr.read_receipts(spark, path, empty=rule).orderBy("rid").collect()]
           for rule in ("drop", "inner", "keep")}
    assert got["inner"] == [["a", "", "b"], [], [], [], ["", "c"]]
    assert got["drop"] == [["a", "b"], [], [], [], ["c"]]
    assert got["keep"] == [["a", "", "b", "", ""], ["", ""], [], [], ["", "c"]]
    with pytest.raises(ValueError):
        tr.read_receipts(spark, path, empty="some")


def test_sorted_sink_writes_in_key_order(spark):
    import glob
    import os
    out = scratch_path(spark, "sorted")
    df = spark.range(0, 500, 1, 7).selectExpr("cast((id * 37) % 500 as string) as k", "id")
    tr.write_key_value(df.selectExpr("lpad(k, 3, '0') as k", "id"), out, "k", "id", order_by=["k"])
    lines = []
    local = out[len("file:"):] if out.startswith("file:") else out
    for f in sorted(glob.glob(os.path.join(local, "part-*"))):
        lines += open(f).read().splitlines()
    keys = [ln.split("\t")[0] for ln in lines]
    assert keys == sorted(keys) and len(keys) == 500
