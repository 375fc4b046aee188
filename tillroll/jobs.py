"""Command-line jobs: text receipts in, rendered text out.

    spark-submit tillroll/jobs.py top      <receipts> <out> [--k 5] [--style tuple|line|columns] [--trailing-separator]
    spark-submit tillroll/jobs.py revenue  <receipts> <prices> <out> [--how inner|full] [--style tuple|slash|array]
                                           [--dedup max|min] [--zero-is-missing | --zero-is-price] [--price-scale N]
    spark-submit tillroll/jobs.py rules    <receipts> <out> [--style decimal|percent|raw] [--no-self-pairs] [--distinct] [--hot-items N]

Common options: ``--form comma|colon`` (receipt line form), ``--keep-empty`` or
``--empty drop|keep|inner``, ``--month-mode date|prefix|unix``, ``--rebalance``
(deal out the lines of few large files), ``--unsorted``.  The output folder is
replaced.  Lines are written sorted by their key (month, product, or pair);
``--unsorted`` leaves that global sort out.  A price of 0 counts as missing in
the full join unless ``--zero-is-price`` says otherwise, and as a price in the
inner one unless ``--zero-is-missing`` does.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import tillroll as tr  # noqa: E402
from tillroll.operators.rules import HOT_ITEMS_DEFAULT  # noqa: E402


def _receipts(spark: SparkSession, args) -> DataFrame:
    return tr.read_receipts(spark, args.receipts, args.form, args.keep_empty, args.empty, args.rebalance or None)


def _line_of_columns(df: DataFrame, key: str) -> DataFrame:
    cols = [c for c in df.columns if c != key]
    return df.select(key, F.concat_ws("\t", *[F.col(c).cast("string") for c in [key] + cols]).alias("line"))


def run_top(spark: SparkSession, args) -> tuple[DataFrame, list[str]]:
    items = tr.explode_items(_receipts(spark, args), args.month_mode)
    top = tr.monthly_top_products(items, args.k)
    if args.style == "tuple":
        return tr.render_top_tuple(top), ["month"]
    if args.style == "line":
        return tr.render_top_line(top, args.trailing_separator, args.k), ["month"]
    return _line_of_columns(tr.render_top_columns(top, args.k), "month"), ["month"]


def run_revenue(spark: SparkSession, args) -> tuple[DataFrame, list[str]]:
    items = tr.explode_items(_receipts(spark, args), args.month_mode)
    missing = args.how == "full" if args.zero_is_missing is None else args.zero_is_missing
    rev = tr.monthly_revenue(items, tr.read_prices(spark, args.prices, args.price_scale), how=args.how,
                             zero_is_missing=missing, dedup=args.dedup)
    if args.style == "tuple":
        return tr.render_revenue_tuple(rev), ["product"]
    if args.style == "slash":
        return tr.render_revenue_slash(rev), ["product"]
    arr = tr.render_revenue_array(rev)
    return arr.select("product", F.concat(F.col("product"), F.lit("\t"),
                                          F.array_join("month_total", ",")).alias("line")), ["product"]


def run_rules(spark: SparkSession, args) -> tuple[DataFrame, list[str]]:
    receipts = _receipts(spark, args)
    rules = tr.pair_rules(tr.explode_items(receipts, args.month_mode), receipts,
                          self_pairs=not args.no_self_pairs, distinct_items=args.distinct,
                          hot_items=args.hot_items)
    if args.style == "decimal":
        return tr.render_rules_decimal(rules), ["p1", "p2"]
    if args.style == "percent":
        return tr.render_rules_percent(rules), ["p1", "p2"]
    raw = tr.render_rules_raw(rules)
    line = F.concat_ws(", ", "p1", "p2", "support_pct", "confidence_pct")
    return raw.select("p1", "p2", line.alias("line")), ["p1", "p2"]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tillroll.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    def common(sp):
        sp.add_argument("--form", choices=["comma", "colon"], default="comma")
        sp.add_argument("--keep-empty", action="store_true")
        sp.add_argument("--empty", choices=["drop", "keep", "inner"], default=None)
        sp.add_argument("--rebalance", action="store_true")
        sp.add_argument("--unsorted", action="store_true")
        sp.add_argument("--month-mode", choices=["date", "prefix", "unix"], default="date")

    top = sub.add_parser("top")
    top.add_argument("receipts")
    top.add_argument("out")
    top.add_argument("--k", type=int, default=5)
    top.add_argument("--style", choices=["tuple", "line", "columns"], default="tuple")
    top.add_argument("--trailing-separator", action="store_true",
                     help="a line with fewer than k products ends with the separator")
    common(top)

    rev = sub.add_parser("revenue")
    rev.add_argument("receipts")
    rev.add_argument("prices")
    rev.add_argument("out")
    rev.add_argument("--how", choices=["inner", "full"], default="inner")
    rev.add_argument("--style", choices=["tuple", "slash", "array"], default="tuple")
    rev.add_argument("--dedup", choices=["max", "min"], default=None, help="one price per product")
    rev.add_argument("--zero-is-missing", dest="zero_is_missing", action="store_true", default=None)
    rev.add_argument("--zero-is-price", dest="zero_is_missing", action="store_false")
    rev.add_argument("--price-scale", type=int, default=2, help="decimals of a price; more are an error")
    common(rev)

    rul = sub.add_parser("rules")
    rul.add_argument("receipts")
    rul.add_argument("out")
    rul.add_argument("--style", choices=["decimal", "percent", "raw"], default="decimal")
    rul.add_argument("--no-self-pairs", action="store_true")
    rul.add_argument("--distinct", action="store_true")
    rul.add_argument("--hot-items", type=int, default=HOT_ITEMS_DEFAULT,
                     help="receipts with more distinct items go through the bucket grid")
    common(rul)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tillroll-{args.job}").getOrCreate()
    runner = {"top": run_top, "revenue": run_revenue, "rules": run_rules}[args.job]
    df, keys = runner(spark, args)
    tr.write_lines(df, args.out, col="line", order_by=None if args.unsorted else keys)


if __name__ == "__main__":
    main()
