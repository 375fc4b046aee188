"""Registered queries over the Parquet test tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` and runs on the whole
tables.  Output columns are STRING, BIGINT, INT or DOUBLE (money as BIGINT
cents) so the SQL oracles of :mod:`tillroll.plans.oracle` compare one to
one.  Queries that test a text or table round trip write their
intermediate under the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import month_key, month_label
from tillroll.functions.formats import percent1
from tillroll.functions.tokens import drop_empty, split_tokens
from tillroll.operators import ids, items as it, render, revenue, rules, stepwise, top_products
from tillroll.plans import hive_sql
from tillroll.session import Scope, scratch_path
from tillroll.sources import prices as pr
from tillroll.sources import receipts as rc
from tillroll.sources import sinks, tables

TOP_K = 5
PREVIEW_ROWS = 10


# ---------------------------------------------------------------- inputs

def _name_items(spark: SparkSession, sf: str) -> DataFrame:
    return it.with_month(tables.order_items(spark, sf, "name"))


def _partkey_items(spark: SparkSession, sf: str) -> DataFrame:
    return it.with_month(tables.order_items(spark, sf, "partkey"))


def _cents(name: str) -> F.Column:
    """A DECIMAL money column as BIGINT cents (exact)."""
    return (F.col(name) * F.lit(100)).cast("bigint")


def _name_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Units per month and name, without shuffling items by part key."""
    items = it.with_month(tables.order_items(spark, sf, "key"))
    return top_products.named_counts(items, tables.part_names(spark, sf), ["month"], "units")


def _top(spark: SparkSession, sf: str) -> DataFrame:
    return top_products.top_of_counts(_name_counts(spark, sf), TOP_K)


def _rules(spark: SparkSession, sf: str, **kw) -> DataFrame:
    return rules.pair_rules(_name_items(spark, sf), tables.order_receipts(spark, sf),
                            sizes=tables.order_sizes(spark, sf), **kw)


def _pairs(spark: SparkSession, sf: str, **kw) -> DataFrame:
    return rules.pair_counts(_name_items(spark, sf), sizes=tables.order_sizes(spark, sf), **kw)


# ---------------------------------------------------------------- Q1

def q_monthly_product_counts(spark, sf):
    return _name_counts(spark, sf)


def q_units_sum_of_ones(spark, sf):
    return top_products.monthly_counts_sum_of_ones(_name_items(spark, sf))


def q_monthly_top5(spark, sf):
    return _top(spark, sf)


def q_monthly_top5_line(spark, sf):
    return render.render_top_line(_top(spark, sf))


def q_monthly_top5_tuple(spark, sf):
    return render.render_top_tuple(_top(spark, sf))


def q_monthly_top5_columns(spark, sf):
    return render.render_top_columns(_top(spark, sf), TOP_K)


def q_packed_list_parse(spark, sf):
    return render.parse_top_line(render.render_top_line(_top(spark, sf)))


def q_ranked_list_sorted(spark, sf):
    top = _top(spark, sf).select("month", "product", "units")
    return render.ranked_list(top)


def q_global_sort(spark, sf):
    counts = _name_counts(spark, sf)
    return ids.with_row_number(counts, ["month", "product"], "position")


def q_preview(spark, sf):
    counts = _name_counts(spark, sf)
    return counts.orderBy(F.col("units").desc(), "month", "product").limit(PREVIEW_ROWS)


def q_month_prefix(spark, sf):
    orders = tables.order_receipts(spark, sf).select(F.date_format("data", "yyyy-MM-dd").alias("data"))
    parts = F.split(month_key("data", "prefix"), "-")
    return (orders.select(month_key("data", "prefix").alias("month"),
                          month_key("data", "unix").alias("month_unix"),
                          F.concat_ws("/", F.get(parts, 1), F.get(parts, 0)).alias("month_slash"))
            .groupBy("month", "month_unix", "month_slash").agg(F.count(F.lit(1)).alias("receipts")))


# ---------------------------------------------------------------- Q2

def _revenue(spark, sf, **kw):
    return revenue.monthly_revenue(_partkey_items(spark, sf), tables.part_prices(spark, sf, "partkey"), **kw)


def q_monthly_revenue(spark, sf):
    rev = _revenue(spark, sf)
    return rev.select("product", "month", "units", _cents("total").alias("total_cents"))


def q_monthly_revenue_full(spark, sf):
    rev = _revenue(spark, sf, how="full", zero_is_missing=True)
    return render.render_revenue_slash(rev)


def q_monthly_revenue_full_zero(spark, sf):
    """Full join where some prices are 0 and half of the products never sold."""
    listed = tables.part_prices(spark, sf, "partkey").select("product", F.when(
        F.col("product").cast("bigint") % 7 == 0, F.lit(0)).otherwise(F.col("price")).alias("price"))
    unsold = listed.select(F.concat(F.lit("-"), "product").alias("product"), "price")
    rev = revenue.monthly_revenue(_partkey_items(spark, sf), listed.unionByName(unsold), how="full",
                                  zero_is_missing=True)
    return render.render_revenue_slash(rev)


def q_monthly_revenue_tuple(spark, sf):
    return render.render_revenue_tuple(_revenue(spark, sf))


def q_monthly_revenue_array(spark, sf):
    arr = render.render_revenue_array(_revenue(spark, sf))
    return arr.select("product", F.array_join("month_total", ",").alias("month_total"))


def q_price_dedup(spark, sf):
    p = revenue.dedup_prices(tables.part_prices(spark, sf, "name"), "max")
    return p.select("product", _cents("price").alias("price_cents"))


# ---------------------------------------------------------------- Q3

def q_product_occurrences(spark, sf):
    items = tables.order_items(spark, sf, "key").select("product")
    return top_products.named_counts(items, tables.part_names(spark, sf), [], "occurrences")


def q_receipt_total(spark, sf):
    return rules.receipt_total(tables.order_receipts(spark, sf))


def q_pair_counts(spark, sf):
    return _pairs(spark, sf, form="ordered")


def q_pair_counts_mirror(spark, sf):
    return _pairs(spark, sf, form="mirror")


def q_pair_counts_selfjoin(spark, sf):
    return _pairs(spark, sf, self_pairs=False)


def q_pair_counts_events(spark, sf):
    return rules.pair_counts(tables.event_items(spark, sf))


def q_pair_rules(spark, sf):
    return _rules(spark, sf)


def q_pair_rules_distinct(spark, sf):
    return _rules(spark, sf, distinct_items=True)


def q_pair_rules_pct1(spark, sf):
    return render.render_rules_percent(_rules(spark, sf))


def q_pair_rules_pct2(spark, sf):
    return render.render_rules_decimal(_rules(spark, sf))


def q_pair_rules_raw_percent(spark, sf):
    return render.render_rules_raw(_rules(spark, sf, self_pairs=False), places=6)


def q_pair_rules_unrounded_percent(spark, sf):
    """The unrounded text; its number is read back, since engines print doubles differently."""
    rows = render.render_rules_raw(_rules(spark, sf, self_pairs=False))
    numbers = {c: F.regexp_extract(c, "^([0-9.E-]+)%$", 1).cast("double") for c in ("support_pct", "confidence_pct")}
    return rows.select("p1", "p2", *[v.alias(c) for c, v in numbers.items()])


SQL_HOT_ITEMS = 7  # receipts with more rows are split in the SQL form
GRID_HOT_ITEMS = 3  # receipts with more than 3 distinct items take the bucket grid


def q_pair_rules_grid(spark, sf):
    """Pair rules with every receipt above 3 distinct items sent through the
    hot-receipt bucket grid (the path a huge receipt takes)."""
    return _rules(spark, sf, hot_items=GRID_HOT_ITEMS)


def q_pair_counts_events_grid(spark, sf):
    """Event baskets, with baskets above 3 distinct types in the bucket grid."""
    return rules.pair_counts(tables.event_items(spark, sf), hot_items=GRID_HOT_ITEMS)


def q_pair_rules_stepwise(spark, sf):
    """Pair rules with every step written as a table, the basket bucketed by receipt."""
    return stepwise.pair_rules_stepwise(_name_items(spark, sf), tables.order_receipts(spark, sf),
                                        sizes=tables.order_sizes(spark, sf))


def q_one_pass_counts(spark, sf):
    return rules.tagged_counts(_name_items(spark, sf), tables.order_receipts(spark, sf),
                               sizes=tables.order_sizes(spark, sf))


# ---------------------------------------------------------------- sources / sinks

def q_receipt_text_roundtrip(spark, sf):
    path = scratch_path(spark, "receipts-comma")
    sinks.write_lines(rc.receipt_lines(tables.order_receipt_arrays(spark, sf), "comma"), path)
    back = rc.read_receipts(spark, path, "comma")
    return back.select("data", F.array_join("products", ",").alias("items"))


def q_receipt_colon_roundtrip(spark, sf):
    path = scratch_path(spark, "receipts-colon")
    sinks.write_lines(rc.receipt_lines(tables.order_receipt_arrays(spark, sf), "colon"), path)
    back = rc.read_receipts(spark, path, "colon")
    return back.select("data", F.array_join("products", ",").alias("items"))


def q_receipt_unsplit_occurrences(spark, sf):
    path = scratch_path(spark, "receipts-unsplit")
    sinks.write_lines(rc.receipt_lines(tables.order_receipt_arrays(spark, sf), "colon"), path)
    back = rc.read_receipts_unsplit(spark, path)
    exploded = back.select("rid", F.explode(drop_empty(split_tokens("products", ","))).alias("product"))
    return rules.product_occurrences(exploded)


def q_receipt_text_top5(spark, sf):
    path = scratch_path(spark, "receipts-top")
    sinks.write_lines(rc.receipt_lines(tables.order_receipt_arrays(spark, sf), "comma"), path)
    back = rc.read_receipts(spark, path, "comma")
    return top_products.monthly_top_products(it.explode_items(back), TOP_K)


def q_receipt_inner_empties(spark, sf):
    """Items per product where lines have empty items inside and at their end.

    A receipt without items is written as two empty ones; a line item of an even
    part key is followed by an empty item.  With the rule ``inner`` an empty item
    between others is an item, one at the end of a line is none.
    """
    path = scratch_path(spark, "receipts-empties")
    rows = tables.order_receipt_arrays(spark, sf, "partkey")
    gaps = F.flatten(F.transform("products", lambda p: F.when(
        p.cast("bigint") % 2 == 0, F.array(p, F.lit(""))).otherwise(F.array(p))))
    gaps = F.when(F.size("products") > 0, gaps).otherwise(F.array(F.lit(""), F.lit("")))
    sinks.write_lines(rc.receipt_lines(rows.withColumn("products", gaps), "comma"), path)
    back = rc.read_receipts(spark, path, "comma", empty="inner")
    return rules.product_occurrences(it.explode_items(back))


def q_price_text_roundtrip(spark, sf):
    path = scratch_path(spark, "prices")
    sinks.write_lines(pr.price_lines(tables.part_prices(spark, sf, "partkey")), path)
    back = pr.read_prices(spark, path)
    return back.select("product", _cents("price").alias("price_cents"))


def q_table_overwrite(spark, sf):
    tag = uuid.uuid4().hex[:12]
    result = Scope(spark)
    with Scope(spark) as scope:
        raw, dedup = scope.table(f"tillroll_prices_{tag}"), result.table(f"tillroll_price_max_{tag}")
        raw_path, dedup_path = scope.path(raw), result.path(dedup)
        sinks.create_table(spark, raw, pr.PRICE_SCHEMA, raw_path)
        prices = tables.part_prices(spark, sf, "name")
        sinks.load_into_table(spark, prices, raw, raw_path)
        sinks.load_into_table(spark, prices, raw, raw_path)  # replaces, never appends
        sinks.drop_table(spark, dedup)
        sinks.save_table(revenue.dedup_prices(sinks.read_table(spark, raw)), dedup, dedup_path)
        back = sinks.read_table(spark, dedup)
    result.release()  # out of the catalog; its files stay for the result
    return back.select("product", _cents("price").alias("price_cents"))


def q_packed_revenue_parse(spark, sf):
    text = render.render_revenue_slash(_revenue(spark, sf, how="full", zero_is_missing=True))
    back = render.parse_month_list(text)
    return back.select("product", "month", _cents("total").alias("total_cents"))


def q_rules_text_sink(spark, sf):
    rules_ = _rules(spark, sf)
    kv = rules_.select(F.concat_ws(",", "p1", "p2").alias("k"),
                       F.concat(percent1("support"), F.lit(", "), percent1("confidence")).alias("v"))
    path = scratch_path(spark, "rules-kv")
    sinks.write_key_value(kv, path, "k", "v")
    return spark.read.text(path).select(F.col("value").alias("line"))


def q_hive_top5_sql(spark, sf):
    return hive_sql.top_columns_sql(spark, tables.order_lists(spark, sf))


def q_hive_revenue_sql(spark, sf):
    return hive_sql.revenue_sql(spark, tables.order_lists(spark, sf, "partkey"),
                                tables.part_prices(spark, sf, "partkey"))


def q_hive_rules_sql(spark, sf):
    """Rules as one SQL statement; the largest receipts go the split way."""
    return hive_sql.rules_sql(spark, tables.order_lists(spark, sf), tables.order_receipts(spark, sf),
                              hot_items=SQL_HOT_ITEMS)


def q_hive_rules_steps(spark, sf):
    return hive_sql.rules_steps_sql(spark, tables.order_lists(spark, sf), tables.order_receipts(spark, sf))


def q_receipt_ids(spark, sf):
    orders = tables.order_receipts(spark, sf)
    with_ids = ids.with_random_id(orders, "uid", via="reflect")
    numbered = ids.with_row_number(with_ids, ["rid"], "number")
    return numbered.agg(
        F.count(F.lit(1)).alias("receipts"),
        F.countDistinct("uid").alias("distinct_ids"),
        F.max("number").alias("max_number"),
        F.countDistinct("number").alias("distinct_numbers"),
    )


def q_month_labels(spark, sf):
    months = _partkey_items(spark, sf).select("month").distinct()
    return months.select("month", month_label("month", "MM/yyyy").alias("month_slash"),
                         month_label("month", "MM-yyyy").alias("month_dash"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "monthly_product_counts": q_monthly_product_counts,
    "units_sum_of_ones": q_units_sum_of_ones,
    "monthly_top5": q_monthly_top5,
    "monthly_top5_line": q_monthly_top5_line,
    "monthly_top5_tuple": q_monthly_top5_tuple,
    "monthly_top5_columns": q_monthly_top5_columns,
    "packed_list_parse": q_packed_list_parse,
    "ranked_list_sorted": q_ranked_list_sorted,
    "global_sort": q_global_sort,
    "preview": q_preview,
    "month_prefix": q_month_prefix,
    "month_labels": q_month_labels,
    "monthly_revenue": q_monthly_revenue,
    "monthly_revenue_full": q_monthly_revenue_full,
    "monthly_revenue_full_zero": q_monthly_revenue_full_zero,
    "monthly_revenue_tuple": q_monthly_revenue_tuple,
    "monthly_revenue_array": q_monthly_revenue_array,
    "price_dedup": q_price_dedup,
    "product_occurrences": q_product_occurrences,
    "receipt_total": q_receipt_total,
    "pair_counts": q_pair_counts,
    "pair_counts_mirror": q_pair_counts_mirror,
    "pair_counts_selfjoin": q_pair_counts_selfjoin,
    "pair_counts_events": q_pair_counts_events,
    "pair_rules": q_pair_rules,
    "pair_rules_distinct": q_pair_rules_distinct,
    "pair_rules_pct1": q_pair_rules_pct1,
    "pair_rules_pct2": q_pair_rules_pct2,
    "pair_rules_raw_percent": q_pair_rules_raw_percent,
    "pair_rules_unrounded_percent": q_pair_rules_unrounded_percent,
    "pair_rules_grid": q_pair_rules_grid,
    "pair_counts_events_grid": q_pair_counts_events_grid,
    "pair_rules_stepwise": q_pair_rules_stepwise,
    "one_pass_counts": q_one_pass_counts,
    "receipt_text_roundtrip": q_receipt_text_roundtrip,
    "receipt_colon_roundtrip": q_receipt_colon_roundtrip,
    "receipt_unsplit_occurrences": q_receipt_unsplit_occurrences,
    "receipt_text_top5": q_receipt_text_top5,
    "price_text_roundtrip": q_price_text_roundtrip,
    "table_overwrite": q_table_overwrite,
    "receipt_ids": q_receipt_ids,
    "packed_revenue_parse": q_packed_revenue_parse,
    "rules_text_sink": q_rules_text_sink,
    "hive_top5_sql": q_hive_top5_sql,
    "hive_revenue_sql": q_hive_revenue_sql,
    "hive_rules_sql": q_hive_rules_sql,
    "hive_rules_steps": q_hive_rules_steps,
    "receipt_inner_empties": q_receipt_inner_empties,
}
