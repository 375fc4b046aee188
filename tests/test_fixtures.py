"""Hand-made fixtures: every documented edge case has a test here."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import tillroll as tr
from tillroll.functions import month_key

RECEIPTS_SMALL = (
    "2015-08-20,pane,latte\n"
    "2015-08-21,pane,latte,vino\n"
    "2015-09-01,vino,vino\n"
    "2015-09-02,pane,,latte\n"
    "2015-10-05\n"
    "\n"
    "2015-8-22,pane\n"
)


@pytest.fixture
def small(spark, write_text):
    return tr.read_receipts(spark, write_text(RECEIPTS_SMALL))


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---------------------------------------------------------------- sources

def test_comma_reader_keeps_blank_lines_and_drops_empty_items(small):
    got = [(r.data, r.products) for r in small.orderBy("rid").collect()]
    assert got == [
        ("2015-08-20", ["pane", "latte"]),
        ("2015-08-21", ["pane", "latte", "vino"]),
        ("2015-09-01", ["vino", "vino"]),
        ("2015-09-02", ["pane", "latte"]),
        ("2015-10-05", []),
        ("", []),
        ("2015-8-22", ["pane"]),
    ]


def test_keep_empty_items(spark, write_text):
    rec = tr.read_receipts(spark, write_text(RECEIPTS_SMALL), keep_empty=True)
    assert ["pane", "", "latte"] in [r.products for r in rec.collect()]


def test_colon_reader(spark, write_text):
    rec = tr.read_receipts(spark, write_text("2015-08-20:pane,latte\n2015-09-01:vino\n2015-10-05\n"), "colon")
    got = sorted((r.data, tuple(r.products)) for r in rec.collect())
    assert got == [("2015-08-20", ("pane", "latte")), ("2015-09-01", ("vino",)), ("2015-10-05", ())]


def test_unsplit_reader_types_the_date(spark, write_text):
    rec = tr.read_receipts_unsplit(spark, write_text("2015-08-20:pane,latte\nnot-a-date:vino\n"))
    assert dict(rec.dtypes)["data"] == "date"
    got = sorted((str(r.data), r.products) for r in rec.collect())
    assert got == [("2015-08-20", "pane,latte"), ("None", "vino")]


def test_price_reader_is_exact(spark, write_text):
    p = tr.read_prices(spark, write_text("pane,3\nlatte,3.5\nvino,x\n"))
    assert dict(p.dtypes)["price"] == "decimal(12,2)"
    assert rows(p, "product", "price") == [("latte", Decimal("3.50")), ("pane", Decimal("3.00")), ("vino", None)]


def test_price_lines_have_no_quotes_and_lose_nothing(spark, write_text):
    p = tr.read_prices(spark, write_text('"d,4\n\na,3.50\n'))
    assert rows(p, "product", "price") == [('"d', Decimal("4.00")), ("a", Decimal("3.50"))]
    with pytest.raises(Exception, match="does not fit"):
        tr.read_prices(spark, write_text("b,3.999\n")).collect()


# ---------------------------------------------------------------- months

def test_month_modes(spark):
    df = spark.createDataFrame([("2015-8-22",), ("2015-08-20",), ("2015",), ("",)], "d string")
    got = df.select(month_key("d", "date").alias("a"), month_key("d", "prefix").alias("b"),
                    month_key("d", "unix").alias("c")).collect()
    assert [tuple(r) for r in got] == [
        ("2015-08", "2015-8-", "2015-08"), ("2015-08", "2015-08", "2015-08"),
        ("2015-01", "2015", "2015-01"), (None, "", None)]


# ---------------------------------------------------------------- Q1

def test_top_products_default(small):
    top = tr.monthly_top_products(tr.explode_items(small))
    assert rows(top, "month", "rank", "product", "units") == [
        ("2015-08", 1, "pane", 3), ("2015-08", 2, "latte", 2), ("2015-08", 3, "vino", 1),
        ("2015-09", 1, "vino", 2), ("2015-09", 2, "latte", 1), ("2015-09", 3, "pane", 1)]


def test_top_products_prefix_month(small):
    top = tr.monthly_top_products(tr.explode_items(small, month_mode="prefix"))
    got = rows(top, "month", "product", "units")
    assert ("2015-8-", "pane", 1) in got and ("2015-08", "pane", 2) in got


def test_top_tie_at_rank_five_is_broken_by_name(spark, write_text):
    line = "2015-01-01," + ",".join(["a"] * 6 + ["b"] * 5 + ["c"] * 4 + ["d"] * 3 + ["f"] * 2 + ["e"] * 2)
    rec = tr.read_receipts(spark, write_text(line + "\n"))
    top = tr.monthly_top_products(tr.explode_items(rec))
    assert rows(top, "rank", "product") == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]


def test_top_k_validates(small):
    with pytest.raises(ValueError):
        tr.monthly_top_products(tr.explode_items(small), k=0)


def test_names_with_space_colon_and_total(spark, write_text):
    rec = tr.read_receipts(spark, write_text("2015-01-01,olio di oliva,a:b,total\n2015-01-02,total\n"))
    items = tr.explode_items(rec)
    top = tr.monthly_top_products(items)
    assert rows(top, "product", "units") == [("a:b", 1), ("olio di oliva", 1), ("total", 2)]
    parsed = tr.parse_top_line(tr.render_top_line(top))
    assert rows(parsed, "month", "rank", "product", "units") == rows(top, "month", "rank", "product", "units")
    rules = tr.pair_rules(items, rec)
    assert ("total", "olio di oliva", 1) in rows(rules, "p1", "p2", "pair_count")


# ---------------------------------------------------------------- renderers of Q1

def test_render_top(small):
    top = tr.monthly_top_products(tr.explode_items(small))
    assert rows(tr.render_top_line(top), "month", "line")[0] == ("2015-08", "2015-08:\tpane 3, latte 2, vino 1")
    assert rows(tr.render_top_line(top, trailing_separator=True), "line")[0] == ("2015-08:\tpane 3, latte 2, vino 1, ",)
    assert rows(tr.render_top_tuple(top), "line")[0] == ("(2015-08,[(pane,3), (latte,2), (vino,1)])",)
    cols = tr.render_top_columns(top).where("month = '2015-08'").first()
    assert (cols.top1, cols.top2, cols.top3, cols.top4, cols.top5) == ("pane 3, ", "latte 2, ", "vino 1, ", None, None)


def test_ranked_list(small):
    counts = tr.monthly_counts(tr.explode_items(small))
    got = tr.ranked_list(counts).where("month = '2015-09'").first()
    assert (got.ranked, got.first, got.second) == ("vino 2, latte 1, pane 1", "vino", "latte")


# ---------------------------------------------------------------- Q2

@pytest.fixture
def q2_inputs(spark):
    items = spark.createDataFrame(
        [(1, "2015-08", "a"), (1, "2015-08", "a"), (2, "2015-09", "a")] + [(3, "2015-08", "nopr")] * 4,
        "rid long, month string, product string")
    prices = spark.createDataFrame([("a", Decimal("3")), ("unsold", Decimal("5"))], "product string, price decimal(12,2)")
    return items, prices


def test_revenue_inner(q2_inputs):
    rev = tr.monthly_revenue(*q2_inputs)
    assert rows(rev, "product", "month", "units", "total") == [
        ("a", "2015-08", 2, Decimal("6.00")), ("a", "2015-09", 1, Decimal("3.00"))]
    assert dict(rev.dtypes)["total"] == "decimal(22,2)"


def test_revenue_full_and_slash_render(q2_inputs):
    rev = tr.monthly_revenue(*q2_inputs, how="full", zero_is_missing=True)
    got = dict(rows(tr.render_revenue_slash(rev), "product", "line"))
    assert got == {"a": "a\t08/2015:6 09/2015:3 ", "nopr": "nopr\t", "unsold": "unsold\t"}


def test_revenue_zero_price(spark, q2_inputs):
    items, _ = q2_inputs
    zero = spark.createDataFrame([("a", Decimal("0"))], "product string, price decimal(12,2)")
    assert rows(tr.monthly_revenue(items, zero), "total") == [(Decimal("0.00"),), (Decimal("0.00"),)]
    assert tr.monthly_revenue(items, zero, zero_is_missing=True).count() == 0


def test_revenue_full_keeps_unsold_zero_prices_and_undated_sales(spark):
    items = spark.createDataFrame([(1, "2015-08", "a"), (2, None, "a"), (3, "2015-08", "z")],
                                  "rid long, month string, product string")
    prices = spark.createDataFrame([("a", Decimal("3")), ("z", Decimal("0")), ("zu", Decimal("0")), ("m", None)],
                                   "product string, price decimal(12,2)")
    rev = tr.monthly_revenue(items, prices, how="full", zero_is_missing=True)
    assert dict(rows(tr.render_revenue_slash(rev), "product", "line")) == {
        "a": "a\tundated:3 08/2015:3 ", "z": "z\t", "zu": "zu\t", "m": "m\t"}


def test_revenue_duplicate_and_fractional_prices(spark, q2_inputs):
    items, _ = q2_inputs
    dup = spark.createDataFrame([("a", Decimal("3")), ("a", Decimal("3.5"))], "product string, price decimal(12,2)")
    assert tr.monthly_revenue(items, dup).count() == 4
    got = rows(tr.monthly_revenue(items, dup, dedup="max"), "month", "total")
    assert got == [("2015-08", Decimal("7.00")), ("2015-09", Decimal("3.50"))]


def test_revenue_renderers(q2_inputs):
    rev = tr.monthly_revenue(*q2_inputs)
    assert rows(tr.render_revenue_tuple(rev), "line") == [("(a,[(2015-08,6), (2015-09,3)])",)]
    assert [r.month_total for r in tr.render_revenue_array(rev).collect()] == [["08-2015:6", "09-2015:3"]]


# ---------------------------------------------------------------- Q3

EXPECTED_RULES = {
    ("latte", "pane"): (3, 42.86, 100.00), ("latte", "vino"): (1, 14.29, 33.33),
    ("pane", "latte"): (3, 42.86, 75.00), ("pane", "vino"): (1, 14.29, 25.00),
    ("vino", "latte"): (1, 14.29, 33.33), ("vino", "pane"): (1, 14.29, 33.33),
    ("vino", "vino"): (2, 28.57, 66.67),
}


def _rules_dict(df):
    return {(r.p1, r.p2): (r.pair_count, round(r.support * 100, 2), round(r.confidence * 100, 2)) for r in df.collect()}


@pytest.mark.parametrize("form", ["mirror", "ordered"])
@pytest.mark.parametrize("hot_items", [None, 1, 2, 4096])
def test_rules_default(small, form, hot_items):
    got = _rules_dict(tr.pair_rules(tr.explode_items(small), small, form=form, hot_items=hot_items))
    assert got == EXPECTED_RULES


def test_rules_without_self_pairs(small):
    got = _rules_dict(tr.pair_rules(tr.explode_items(small), small, self_pairs=False))
    assert got == {k: v for k, v in EXPECTED_RULES.items() if k != ("vino", "vino")}


def test_rules_distinct_items(small):
    got = _rules_dict(tr.pair_rules(tr.explode_items(small), small, distinct_items=True))
    assert ("vino", "vino") not in got
    assert got[("vino", "latte")] == (1, 14.29, 50.00) and got[("vino", "pane")] == (1, 14.29, 50.00)


def test_rules_keep_empty(spark, write_text):
    rec = tr.read_receipts(spark, write_text(RECEIPTS_SMALL), keep_empty=True)
    got = _rules_dict(tr.pair_rules(tr.explode_items(rec), rec))
    assert ("", "pane") in got and ("latte", "") in got


def test_support_denominator_counts_itemless_receipts(small):
    assert tr.receipt_total(small).first().receipts == 7


def test_rule_renderers(small):
    rules = tr.pair_rules(tr.explode_items(small), small).where("p1 = 'pane' and p2 = 'latte'")
    assert tr.render_rules_decimal(rules).first().line == "(pane,latte,42.86,75.00)"
    assert tr.render_rules_percent(rules).first().line == "pane,latte\t42.9%, 75.0%"
    raw = tr.render_rules_raw(rules, places=6).first()
    assert (raw.support_pct, raw.confidence_pct) == ("42.857143%", "75.0%")


def test_golden_arithmetic(spark):
    df = spark.createDataFrame([(51628, 246110, 1000000)], "pair long, single long, total long")
    ratios = df.select((F.col("pair") / F.col("total")).alias("support"),
                       (F.col("pair") / F.col("single")).alias("confidence"),
                       F.lit("a").alias("p1"), F.lit("b").alias("p2"))
    assert tr.render_rules_decimal(ratios).first().line == "(a,b,5.16,20.98)"


def test_tagged_counts(small):
    got = {(r.tag, r.p1, r.p2): r.n for r in tr.tagged_counts(tr.explode_items(small), small).collect()}
    assert got[("total", None, None)] == 7
    assert got[("product", "pane", None)] == 4
    assert got[("pair", "vino", "vino")] == 2 and got[("pair", "pane", "latte")] == 3


def test_large_basket_goes_through_the_grid(spark, write_text):
    names = [f"p{i:04d}" for i in range(2000)]
    rec = tr.read_receipts(spark, write_text("2015-01-01," + ",".join(names + names[:10]) + "\n"))
    items = tr.explode_items(rec)
    plain = tr.pair_counts(items, hot_items=None)
    grid = tr.pair_counts(items, hot_items=64)
    n_pairs = 2000 * 1999
    assert plain.count() == n_pairs + 10 and grid.count() == n_pairs + 10
    assert plain.agg(F.sum("pair_count")).first()[0] == 2010 * 2009
    assert plain.exceptAll(grid).count() == 0 and grid.exceptAll(plain).count() == 0


def test_empty_input(spark, write_text):
    rec = tr.read_receipts(spark, write_text(""))
    items = tr.explode_items(rec)
    assert tr.monthly_top_products(items).count() == 0
    assert tr.pair_rules(items, rec).count() == 0
    assert tr.receipt_total(rec).first().receipts == 0


def test_result_does_not_depend_on_partitioning(small):
    items = tr.explode_items(small)
    base = sorted(map(tuple, tr.pair_rules(items, small).collect()))
    for n in (1, 7):
        again = sorted(map(tuple, tr.pair_rules(items.repartition(n), small.repartition(n)).collect()))
        assert again == base


# ---------------------------------------------------------------- ids

def test_dense_row_numbers(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("k"))
    numbered = tr.with_row_number(df, ["k"], "n")
    got = sorted((r.n, r.k) for r in numbered.collect())
    assert got == [(i + 1, i) for i in range(1000)]


def test_random_ids(spark):
    df = tr.with_random_id(spark.range(50), "uid", via="reflect")
    assert df.columns == ["uid", "id"] and df.select("uid").distinct().count() == 50


def test_stepwise_rules_equal_one_plan(small):
    items = tr.explode_items(small)
    got = _rules_dict(tr.pair_rules_stepwise(items, small, buckets=4))
    assert got == EXPECTED_RULES
    got_hot = _rules_dict(tr.pair_rules_stepwise(items, small, buckets=3, hot_items=1))
    assert got_hot == EXPECTED_RULES


def test_hot_receipt_pairs_spread_over_many_tasks(spark):
    from tillroll.operators.rules import _grid_pairs
    n = 600
    hot = spark.range(n).select(F.lit(1).cast("bigint").alias("rid"),
                                F.format_string("p%04d", "id").alias("product"),
                                F.lit(1).cast("bigint").alias("c"),
                                F.lit(n).cast("bigint").alias("d"))
    pairs = _grid_pairs(hot, 64)  # 10 buckets -> 55 blocks of one receipt
    # a huge receipt is joined by shuffle on (rid, bucket_i, bucket_j); force
    # that here (no broadcast of this tiny input, no merging of partitions)
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        per_task = [r["n"] for r in pairs.groupBy(F.spark_partition_id().alias("t"))
                    .agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(per_task) == n * (n - 1) // 2
    assert len(per_task) >= 6                     # not one task
    assert max(per_task) < 0.5 * sum(per_task)    # no task holds most of the receipt
