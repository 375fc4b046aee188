"""Q3: support and confidence of every ordered product pair (rules of size 2).

Definitions (positional, like a double loop over the items of a receipt):

* ``pair_count(a, b)`` = number of ordered position pairs i != j on the same
  receipt with item i = a and item j = b.  With c_a copies of a on a
  receipt that is ``c_a * c_b`` for a != b and ``c_a * (c_a - 1)`` for a = b.
* ``occurrences(a)`` = number of items equal to a, over all receipts.
* ``support = pair_count / receipts`` (item-less receipts count too).
* ``confidence = pair_count / occurrences(p1)``.

How it runs:

1. **Receipt sizes** are counted first (rows per receipt, combined in each map
   task; an adapter that knows them better may pass them).  The ``MAX_HOT``
   largest receipts of more than ``hot_items`` rows are the *hot* ones.  That
   list is bounded by its limit, so it is broadcast, and the items are split
   with it before any exchange on ``rid``: no task ever holds a hot receipt.
2. Plain receipts take **one exchange, by** ``rid`` **alone**.  It serves the
   collapse of copies to ``(rid, product, c)``, both sides of the self-join and
   the per-product occurrences.  On large tables the number of its partitions
   follows the scanned bytes, so a task's memory doesn't grow with the input.
3. The diagonal ``(a, a)`` is arithmetic on ``c``: in the self-join an item with
   copies also meets itself, one ``c * (c - 1)`` row per receipt with copies.
4. Distinct items are paired by a self-join on ``rid`` that keeps ``p1 < p2``
   (every unordered pair once, weight ``c1 * c2``).  The weights are summed
   per pair (partial aggregation right after the join, in the same stage) and
   mirrored to both orders afterwards, which halves the rows of the shuffle.
5. Hot receipts are collapsed by ``(rid, product)`` with a combine in each map
   task, hashed into ``s = ceil(d / hot_items)`` buckets (d = distinct items)
   and joined on ``(rid, bucket_i, bucket_j)`` over the upper triangle
   ``i <= j``: one receipt's pairs spread over ``s (s + 1) / 2`` join groups of
   about ``hot_items`` squared candidate pairs each.  So a sort-merge join
   buffers at most about ``hot_items`` rows a key on either path, unless more
   than ``MAX_HOT`` receipts are hot: the smaller ones then go the plain way,
   with the same result.
6. Plain and hot receipts are summed apart and the two per-pair tables added,
   so the plain join never waits for the hot branch; without hot receipts
   adaptive execution drops that branch.
7. The receipt total enters the ratios as a scalar subquery.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.items import basket, receipt_basket
from tillroll.sources.layout import spread_partitions

HOT_ITEMS_DEFAULT = 4096
MAX_HOT = 1 << 16  # receipts in the broadcast list of hot ones


class Baskets(NamedTuple):
    """Collapsed items ``(rid, product, c)``: of plain receipts, in one place per
    receipt, and of hot ones, spread, with ``d`` distinct items (None: no split)."""

    plain: DataFrame
    hot: DataFrame | None
    hot_items: int | None


def receipt_sizes(items: DataFrame) -> DataFrame:
    """``rid, size``: item rows per receipt, combined in each map task."""
    return items.where(F.col("rid").isNotNull()).groupBy("rid").agg(F.count(F.lit(1)).alias("size"))


def hot_receipts(sizes: DataFrame, hot_items: int, most: int = MAX_HOT) -> DataFrame:
    """``rid`` of the receipts with more than ``hot_items`` rows, the ``most`` largest."""
    return (sizes.where(F.col("size") > hot_items).orderBy(F.col("size").desc(), "rid").limit(most).select("rid"))


def split_items(items: DataFrame, hot_items: int, sizes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Items of plain and of hot receipts; nothing is exchanged by ``rid``."""
    if hot_items < 1:
        raise ValueError("hot_items must be >= 1")
    hot = F.broadcast(hot_receipts(sizes if sizes is not None else receipt_sizes(items), hot_items))
    return items.join(hot, "rid", "left_anti"), items.join(hot, "rid", "left_semi")


def make_baskets(items: DataFrame, distinct_items: bool = False, hot_items: int | None = HOT_ITEMS_DEFAULT,
                 sizes: DataFrame | None = None) -> Baskets:
    """Split and collapse items.  ``sizes`` (``rid, size``) may be any estimate:
    it only decides which way a receipt goes.  ``hot_items=None``: no split."""
    items = items.select("rid", "product")
    partitions = spread_partitions(items)
    if hot_items is None:
        return Baskets(receipt_basket(items, distinct_items, partitions), None, None)
    plain, hot = split_items(items, hot_items, sizes)
    return Baskets(receipt_basket(plain, distinct_items, partitions), with_distinct(basket(hot, distinct_items)), hot_items)


def with_distinct(hot: DataFrame) -> DataFrame:
    """``d``, the distinct items of each hot receipt; one row a receipt is broadcast,
    at most ``MAX_HOT``, so the basket stays spread."""
    d = hot.groupBy("rid").agg(F.count(F.lit(1)).alias("d"))
    return hot.join(F.broadcast(d.limit(MAX_HOT)), "rid")


def _mirror(pairs: DataFrame, value: str) -> DataFrame:
    """Unordered pairs ``p1 <= p2`` -> both orders, in one narrow pass
    (a diagonal row ``p1 = p2`` stays one row)."""
    same = F.struct(F.col("p1").alias("p1"), F.col("p2").alias("p2"), F.col(value).alias(value))
    swapped = F.struct(F.col("p2").alias("p1"), F.col("p1").alias("p2"), F.col(value).alias(value))
    rows = F.when(F.col("p1") == F.col("p2"), F.array(same)).otherwise(F.array(same, swapped))
    return pairs.select(F.inline(rows))


def _sides(b: DataFrame):
    left = b.select("rid", F.col("product").alias("p1"), F.col("c").alias("c1"))
    right = b.select("rid", F.col("product").alias("p2"), F.col("c").alias("c2"))
    return left, right


def _weight(own: bool):
    """Position pairs of two items of a receipt; of an item with itself ``c * (c - 1)``."""
    both = F.col("c1") * F.col("c2")
    return F.when(F.col("p1") == F.col("p2"), F.col("c1") * (F.col("c1") - 1)).otherwise(both) if own else both


def _plain_pairs(b: DataFrame, ordered: bool, own: bool = False) -> DataFrame:
    """Self-join on ``rid``: ``(p1, p2, w)`` for distinct items of a receipt.

    ``own`` adds the diagonal: an item with copies also meets itself.
    """
    left, right = _sides(b)
    cond = (F.col("p1") != F.col("p2")) if ordered else (F.col("p1") < F.col("p2"))
    if own:
        cond = cond | ((F.col("p1") == F.col("p2")) & (F.col("c1") > 1))
    return left.join(right, "rid").where(cond).select("p1", "p2", _weight(own).alias("w"))


def _grid_pairs(hot: DataFrame, hot_items: int, own: bool = False) -> DataFrame:
    """Unordered ``(p1 < p2, w)`` for hot receipts, split into bucket blocks; ``own`` adds the diagonal.

    ``hot`` has ``rid, product, c, d`` (d = distinct items of the receipt).
    Item x lands in bucket ``h(x) mod s``; the left copy of an item in bucket
    i is sent to blocks (i, j) for j >= i, the right copy of an item in
    bucket j to blocks (i, j) for i <= j.  Each unordered pair of distinct
    items meets in exactly one block: items in different buckets meet once
    in (min, max); items in the same bucket meet in (i, i) and are kept
    once by ``p1 < p2``.
    """
    s = F.ceil(F.col("d") / F.lit(hot_items)).cast("int")
    h = hot.select("rid", "product", "c", s.alias("s"))
    h = h.withColumn("bucket", F.pmod(F.xxhash64("product"), F.col("s")).cast("int"))
    left = h.select("rid", F.col("product").alias("p1"), F.col("c").alias("c1"),
                    F.col("bucket").alias("bi"),
                    F.explode(F.sequence(F.col("bucket"), F.col("s") - 1)).alias("bj"))
    right = h.select("rid", F.col("product").alias("p2"), F.col("c").alias("c2"),
                     F.col("bucket").alias("bj"),
                     F.explode(F.sequence(F.lit(0), F.col("bucket"))).alias("bi"))
    joined = left.join(right, ["rid", "bi", "bj"])
    keep = (F.col("bi") < F.col("bj")) | (F.col("p1") < F.col("p2"))
    if own:
        keep = keep | ((F.col("p1") == F.col("p2")) & (F.col("c1") > 1))
    return joined.where(keep).select(
        F.least("p1", "p2").alias("p1"), F.greatest("p1", "p2").alias("p2"), _weight(own).alias("w"))


def pair_weights(b: Baskets, ordered: bool = False) -> DataFrame:
    """Unaggregated ``(p1, p2, w)`` rows for distinct items of each receipt.

    ``ordered=False`` gives each unordered pair once with ``p1 < p2``;
    ``ordered=True`` gives both orders.
    """
    plain = _plain_pairs(b.plain, ordered)
    if b.hot is None:
        return plain
    grid = _grid_pairs(b.hot, b.hot_items)
    return plain.unionByName(_mirror(grid, "w") if ordered else grid)


def all_items(b: Baskets) -> DataFrame:
    """``(rid, product, c)`` of all receipts."""
    columns = ("rid", "product", "c")
    return b.plain.select(*columns) if b.hot is None else b.plain.select(*columns).unionByName(b.hot.select(*columns))


def occurrences_from_baskets(b: Baskets) -> DataFrame:
    """``product, occurrences`` (sum of c over receipts)."""
    return all_items(b).groupBy("product").agg(F.sum("c").alias("occurrences"))


def pair_counts_from_baskets(b: Baskets, self_pairs: bool = True, form: str = "mirror") -> DataFrame:
    """``(p1, p2, pair_count BIGINT)`` for every ordered pair that occurs."""
    if form not in ("mirror", "ordered"):
        raise ValueError(f"form must be 'mirror' or 'ordered', got {form!r}")
    ordered = form == "ordered"

    def summed(w: DataFrame) -> DataFrame:
        return w.groupBy("p1", "p2").agg(F.sum("w").alias("pair_count"))

    counts = summed(_plain_pairs(b.plain, ordered, self_pairs))
    if b.hot is not None:
        # plain and hot receipts are summed apart, then the two small
        # per-pair tables are added
        grid = _grid_pairs(b.hot, b.hot_items, self_pairs)
        grid = summed(_mirror(grid, "w") if ordered else grid)
        counts = counts.unionByName(grid).groupBy("p1", "p2").agg(F.sum("pair_count").alias("pair_count"))
    return counts if ordered else _mirror(counts, "pair_count")


def pair_counts(items: DataFrame, self_pairs: bool = True, distinct_items: bool = False,
                form: str = "mirror", hot_items: int | None = HOT_ITEMS_DEFAULT,
                sizes: DataFrame | None = None) -> DataFrame:
    """Occurrences of every ordered product pair on the same receipt.

    ``self_pairs=False`` drops pairs of a product with itself (name-based
    ``p1 != p2``).  ``distinct_items=True`` counts receipts that contain
    both products instead of position pairs.  ``form`` chooses how pairs
    reach the shuffle: ``'mirror'`` (one row per unordered pair, mirrored
    after the sum) or ``'ordered'`` (both orders before the sum).
    """
    return pair_counts_from_baskets(make_baskets(items, distinct_items, hot_items, sizes),
                                    self_pairs and not distinct_items, form)


def product_occurrences(items: DataFrame, distinct_items: bool = False) -> DataFrame:
    """Items per product (``distinct_items=True``: receipts per product)."""
    if distinct_items:
        b = basket(items.select("rid", "product"), True)
        return b.groupBy("product").agg(F.sum("c").alias("occurrences"))
    return (items.where(F.col("product").isNotNull())
            .groupBy("product").agg(F.count(F.lit(1)).alias("occurrences")))


def receipt_total(receipts: DataFrame) -> DataFrame:
    """One row: ``receipts BIGINT``, the number of receipts."""
    return receipts.agg(F.count(F.lit(1)).alias("receipts"))


def pair_rules(items: DataFrame, receipts: DataFrame, self_pairs: bool = True,
               distinct_items: bool = False, form: str = "mirror",
               hot_items: int | None = HOT_ITEMS_DEFAULT, sizes: DataFrame | None = None) -> DataFrame:
    """Association rules p1 -> p2 with support and confidence.

    Returns ``p1, p2, pair_count BIGINT, support DOUBLE, confidence DOUBLE``
    (ratios, not percentages).  ``receipts`` has one row per receipt and
    gives the support denominator; it may include item-less receipts.
    ``sizes`` (``rid, size``) saves counting the items of each receipt.

    Plan: the items of plain receipts are shuffled once, by rid, and that
    shuffle is reused by both sides of the pair join and the per-product
    occurrences; the occurrences (one row per product) join the pair counts
    on p1; the receipt total is a scalar subquery (no join).
    """
    b = make_baskets(items, distinct_items, hot_items, sizes)
    occ = occurrences_from_baskets(b).withColumnRenamed("product", "p1")
    pairs = pair_counts_from_baskets(b, self_pairs and not distinct_items, form)
    return with_ratios(pairs.join(occ, "p1"), receipt_total(receipts))


def with_ratios(pairs: DataFrame, total: DataFrame) -> DataFrame:
    """Support and confidence from ``p1, p2, pair_count, occurrences``.

    The receipt count (a one-row aggregate) enters as a scalar subquery:
    computed once, used as a value, no join.
    """
    n = total.select(F.col("receipts").cast("double")).scalar()
    return pairs.select(
        "p1", "p2", "pair_count",
        (F.col("pair_count").cast("double") / n).alias("support"),
        (F.col("pair_count").cast("double") / F.col("occurrences")).alias("confidence"),
    )


def tagged_counts(items: DataFrame, receipts: DataFrame, self_pairs: bool = True,
                  hot_items: int | None = HOT_ITEMS_DEFAULT, sizes: DataFrame | None = None) -> DataFrame:
    """Three grains in one aggregation by grouping sets: ``tag, p1, p2, n``.

    One set of facts, each with its own measure: unordered pairs ``(p1, p2,
    w)``, items ``(p, p)`` with their copies and the pairs of copies, and
    receipts.  Grouping sets ``(p1, p2)``, ``(p1)`` and ``()`` sum them once: a
    ``'pair'`` row takes the pair weights, a ``'product'`` row the copies and
    the ``'total'`` row the receipts, so no grain is derived from another.
    Pairs are mirrored after the sum, so half of the pair rows are made.
    """
    b = make_baskets(items, False, hot_items, sizes)
    zero = F.lit(0).cast("bigint")
    null = F.lit(None).cast("string")
    pairs = pair_weights(b).select("p1", "p2", "w", zero.alias("copies"), zero.alias("receipts"))
    own = F.col("c") * (F.col("c") - 1) if self_pairs else zero
    singles = all_items(b).select(F.col("product").alias("p1"), F.col("product").alias("p2"), own.alias("w"),
                                  F.col("c").alias("copies"), zero.alias("receipts"))
    total = receipts.select(null.alias("p1"), null.alias("p2"), zero.alias("w"), zero.alias("copies"),
                            F.lit(1).cast("bigint").alias("receipts"))
    facts = pairs.unionByName(singles).unionByName(total)
    grain = F.grouping_id()  # 0: (p1, p2), 1: (p1), 3: ()
    n = F.when(grain == 0, F.sum("w")).when(grain == 1, F.sum("copies")).otherwise(F.sum("receipts"))
    tag = F.when(grain == 0, "pair").when(grain == 1, "product").otherwise("total")
    sums = facts.groupingSets([["p1", "p2"], ["p1"], []], "p1", "p2").agg(tag.alias("tag"), n.alias("n"))
    sums = sums.where(F.col("n") > 0)
    row = lambda a, b: F.struct(F.col("tag"), a.alias("p1"), b.alias("p2"), F.col("n"))
    same = row(F.col("p1"), F.col("p2"))
    both = F.array(same, row(F.col("p2"), F.col("p1")))
    return sums.select(F.inline(F.when((F.col("tag") == "pair") & (F.col("p1") != F.col("p2")), both)
                                .otherwise(F.array(same))))
