"""Renderers: results as text lines, tuple text, arrays or fixed columns.

Every list built here has a bounded length: a top-k list holds at most k
entries, a product's revenue list one entry per month.  Lists are sorted
inside the group (``sort_array`` / ``array_sort``), so the text does not
depend on shuffle order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import month_label
from tillroll.functions.formats import decimal2_times100, percent1, raw_percent

UNDATED = "undated"  # shown for the month of items whose date did not parse


def _ranked_list(top: DataFrame, group: str = "month") -> DataFrame:
    """Per group, the top rows as an array sorted by rank (at most k long)."""
    return top.groupBy(group).agg(
        F.sort_array(F.collect_list(F.struct("rank", "product", "units"))).alias("entries"))


def render_top_tuple(top: DataFrame) -> DataFrame:
    """``(month,[(prod,n), (prod,n)])`` per month -> ``month, line``."""
    lst = _ranked_list(top)
    body = F.array_join(F.transform("entries", lambda e: F.concat(
        F.lit("("), e["product"], F.lit(","), e["units"].cast("string"), F.lit(")"))), ", ")
    line = F.concat(F.lit("("), F.coalesce("month", F.lit(UNDATED)), F.lit(",["), body, F.lit("])"))
    return lst.select("month", line.alias("line"))


def render_top_line(top: DataFrame, trailing_separator: bool = False, k: int = 5) -> DataFrame:
    """``month:<TAB>prod n, prod n`` per month -> ``month, line``.

    ``trailing_separator=True`` reproduces the line form that ends with
    ``", "`` when a month has fewer than ``k`` products.
    """
    lst = _ranked_list(top)
    body = F.array_join(F.transform("entries", lambda e: F.concat_ws(
        " ", e["product"], e["units"].cast("string"))), ", ")
    if trailing_separator:
        body = F.when(F.size("entries") < k, F.concat(body, F.lit(", "))).otherwise(body)
    line = F.concat(F.coalesce("month", F.lit(UNDATED)), F.lit(":\t"), body)
    return lst.select("month", line.alias("line"))


def render_top_columns(top: DataFrame, k: int = 5) -> DataFrame:
    """One row per month with k text columns ``top1..topk`` = ``prod n, ``.

    Positions beyond the month's product count are NULL (``get`` returns
    NULL past the end instead of raising).
    """
    lst = _ranked_list(top)
    cells = [F.get("entries", i) for i in range(k)]
    cols = [F.concat(c["product"], F.lit(" "), c["units"].cast("string"), F.lit(", ")).alias(f"top{i + 1}")
            for i, c in enumerate(cells)]
    return lst.select("month", *cols)


def ranked_list(counts: DataFrame, group: str = "month", value: str = "units",
                name: str = "product") -> DataFrame:
    """Sort a collected list by value descending, name ascending.

    ``counts`` should already be cut to a bounded size per group (a top-k
    result).  Returns ``group, ranked`` (``name value`` text joined by
    ``", "``), plus ``first`` / ``second``, the leading names picked by
    position (NULL when missing).
    """
    lst = counts.groupBy(group).agg(F.collect_list(F.struct(
        F.col(name).alias("name"), F.col(value).alias("value"))).alias("entries"))

    def cmp(a, b):
        return (F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1)
                .when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0))

    ordered = F.array_sort("entries", cmp)
    text = F.array_join(F.transform(ordered, lambda e: F.concat_ws(" ", e["name"], e["value"].cast("string"))), ", ")
    return lst.select(group, text.alias("ranked"),
                      F.get(ordered, 0)["name"].alias("first"),
                      F.get(ordered, 1)["name"].alias("second"))


def parse_top_line(lines: DataFrame, col: str = "line") -> DataFrame:
    """Parse ``month:<TAB>prod n, prod n`` text back into top-k rows.

    The count is split off at the last space, so product names with spaces
    survive.  Returns ``month, rank INT, product, units BIGINT``.
    """
    kv = F.split(F.col(col), "\t", 2)
    month = F.regexp_replace(F.get(kv, 0), ":$", "")
    entries = lines.select(month.alias("month"), F.posexplode(F.split(F.get(kv, 1), ", ")).alias("pos", "e"))
    entries = entries.where(F.col("e") != "")
    return entries.select(
        "month",
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.regexp_extract("e", r"^(.*) ([0-9]+)$", 1).alias("product"),
        F.regexp_extract("e", r"^(.*) ([0-9]+)$", 2).cast("bigint").alias("units"),
    )


def _total_text():
    """A total without trailing zeros: ``6``, ``3.5``."""
    return F.regexp_replace(F.col("total").cast("string"), r"\.?0+$", "")


def _entry(label: str, sep: str):
    """Month and total of a sale (NULL without a total); undated sales say so."""
    month = F.coalesce(month_label(F.col("month"), label), F.lit(UNDATED))
    return F.when(F.col("total").isNotNull(), F.struct(
        F.col("month").alias("m"), F.concat(month, F.lit(sep), _total_text()).alias("t")))


def render_revenue_tuple(revenue: DataFrame) -> DataFrame:
    """``(prod,[(month,total), ...])`` per product, months ascending."""
    lst = revenue.groupBy("product").agg(F.sort_array(F.collect_list(
        _entry("yyyy-MM", ","))).alias("entries"))
    body = F.array_join(F.transform("entries", lambda e: F.concat(F.lit("("), e["t"], F.lit(")"))), ", ")
    line = F.concat(F.lit("("), F.col("product"), F.lit(",["), body, F.lit("])"))
    return lst.select("product", line.alias("line"))


def render_revenue_slash(revenue: DataFrame) -> DataFrame:
    """``prod<TAB>MM/yyyy:total MM/yyyy:total `` per product.

    Meant for ``monthly_revenue(..., how='full', zero_is_missing=True)``: a
    product without a price, or a price without sales, gets an empty list.
    """
    lst = revenue.groupBy("product").agg(F.sort_array(F.collect_list(
        _entry("MM/yyyy", ":"))).alias("entries"))
    body = F.concat_ws("", F.transform("entries", lambda e: F.concat(e["t"], F.lit(" "))))
    return lst.select("product", F.concat(F.col("product"), F.lit("\t"), body).alias("line"))


def render_revenue_array(revenue: DataFrame) -> DataFrame:
    """``(product, ARRAY<'MM-yyyy:total'>)``: a set of entries (equal entries
    collapse, as with ``collect_set``), sorted by month."""
    lst = revenue.groupBy("product").agg(F.sort_array(F.collect_set(_entry("MM-yyyy", ":"))).alias("entries"))
    return lst.select("product", F.transform("entries", lambda e: e["t"]).alias("month_total"))


def parse_month_list(lines: DataFrame, col: str = "line") -> DataFrame:
    """Parse ``prod<TAB>MM/yyyy:total MM/yyyy:total `` text back into rows.

    Returns ``product, month ('yyyy-MM'), total DECIMAL(22,2)``; a product
    with an empty list gives no row.  The product is split off at the tab,
    each entry at its last ``:``.
    """
    kv = F.split(F.col(col), "\t", 2)
    entries = lines.select(F.get(kv, 0).alias("product"),
                           F.explode(F.split(F.trim(F.get(kv, 1)), " ")).alias("e"))
    entries = entries.where(F.col("e") != "")
    label = F.regexp_extract("e", r"^(.*):([^:]*)$", 1)
    return entries.select(
        "product",
        F.concat(F.substring(label, 4, 4), F.lit("-"), F.substring(label, 1, 2)).alias("month"),
        F.regexp_extract("e", r"^(.*):([^:]*)$", 2).cast("decimal(22,2)").alias("total"),
    )


def render_rules_decimal(rules: DataFrame) -> DataFrame:
    """``(p1,p2,ss.ss,cc.cc)``: percentages with two decimals, no sign."""
    line = F.concat(F.lit("("), F.col("p1"), F.lit(","), F.col("p2"), F.lit(","),
                    decimal2_times100("support"), F.lit(","), decimal2_times100("confidence"), F.lit(")"))
    return rules.select("p1", "p2", line.alias("line"))


def render_rules_percent(rules: DataFrame) -> DataFrame:
    """``p1,p2<TAB>s.s%, c.c%``: percentages with one decimal."""
    line = F.concat(F.col("p1"), F.lit(","), F.col("p2"), F.lit("\t"),
                    percent1("support"), F.lit(", "), percent1("confidence"))
    return rules.select("p1", "p2", line.alias("line"))


def render_rules_raw(rules: DataFrame, places: int | None = None) -> DataFrame:
    """``p1, p2, 's%', 'c%'`` with the ratio x 100 as unrounded text."""
    return rules.select("p1", "p2",
                        raw_percent("support", places).alias("support_pct"),
                        raw_percent("confidence", places).alias("confidence_pct"))
