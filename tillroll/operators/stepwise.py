"""Q3 in steps, every intermediate written as a table.

Each step is a create-table-as-select under the session's shared checkpoint
folder, read back by the next step:

1. ``<prefix>_basket``: (rid, product, c) of plain receipts, **bucketed and
   sorted by rid**, one file a bucket, and ``<prefix>_hot`` of hot ones;
2. ``<prefix>_products``: occurrences per product;
3. ``<prefix>_receipts``: the number of receipts (one row);
4. ``<prefix>_pairs``: pair counts, from the basket joined with itself;
5. the rules, from the three small tables.

Because both sides of the self-join in step 4 read the same bucketed
table, Spark joins bucket with bucket, with no shuffle of the basket.  The
written tables also cut the lineage: a lost executor costs a re-read of a
table, not a recomputation from the raw inputs.  All tables leave the catalog
before the result is returned, and the basket's files are deleted; the files
of the three small tables stay, since the result reads them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tillroll.operators.rules import (
    HOT_ITEMS_DEFAULT,
    Baskets,
    make_baskets,
    occurrences_from_baskets,
    pair_counts_from_baskets,
    receipt_total,
    with_ratios,
)
from tillroll.session import Scope
from tillroll.sources.layout import spread_partitions
from tillroll.sources.sinks import save_table


def _ctas(scope: Scope, df: DataFrame, name: str, buckets: int | None = None, by: str | None = None) -> DataFrame:
    save_table(df, scope.table(name), scope.path(name), bucket_by=by, buckets=buckets)
    return scope.spark.table(name)


def pair_rules_stepwise(items: DataFrame, receipts: DataFrame, buckets: int | None = None,
                        prefix: str | None = None, self_pairs: bool = True,
                        distinct_items: bool = False,
                        hot_items: int | None = HOT_ITEMS_DEFAULT, sizes: DataFrame | None = None) -> DataFrame:
    """Same result as :func:`tillroll.operators.rules.pair_rules`, in written steps.

    ``buckets`` defaults to the session's shuffle partition count, on large
    tables to as many as the scanned bytes ask for.
    """
    spark = items.sparkSession
    prefix = prefix or f"tillroll_q3_{uuid.uuid4().hex[:10]}"
    buckets = buckets or spread_partitions(items) or int(spark.conf.get("spark.sql.shuffle.partitions"))
    result = Scope(spark)
    with Scope(spark) as scope:
        made = make_baskets(items, distinct_items, hot_items, sizes)
        b = Baskets(_ctas(scope, made.plain, f"{prefix}_basket", buckets, "rid"),
                    made.hot if made.hot is None else _ctas(scope, made.hot, f"{prefix}_hot"), hot_items)
        occ = _ctas(result, occurrences_from_baskets(b), f"{prefix}_products")
        total = _ctas(result, receipt_total(receipts), f"{prefix}_receipts")
        pairs = _ctas(result, pair_counts_from_baskets(b, self_pairs and not distinct_items), f"{prefix}_pairs")
        rules = with_ratios(pairs.join(occ.withColumnRenamed("product", "p1"), "p1"), total)
    result.release()
    return rules
