"""Generated baskets: Spark results equal a brute-force double loop."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import tillroll as tr

PRODUCTS = st.sampled_from(["a", "b", "c", "d", "e", "olio di oliva", "x:y"])
RECEIPT = st.tuples(st.sampled_from(["2015-01-03", "2015-02-10", "2015-03-31"]),
                    st.lists(PRODUCTS, max_size=7))
RECEIPTS = st.lists(RECEIPT, min_size=1, max_size=12)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def brute_pairs(receipts, self_pairs=True, distinct=False):
    out = Counter()
    for _, items in receipts:
        its = sorted(set(items)) if distinct else items
        for i, a in enumerate(its):
            for j, b in enumerate(its):
                if i != j and (self_pairs or a != b):
                    out[(a, b)] += 1
    return out


def frames(spark, receipts):
    rec = spark.createDataFrame([(i, d, p) for i, (d, p) in enumerate(receipts)],
                                "rid long, data string, products array<string>")
    return rec, tr.explode_items(rec)


@SETTINGS
@given(RECEIPTS, st.booleans(), st.sampled_from([None, 1, 3]), st.sampled_from(["mirror", "ordered"]))
def test_pair_counts_equal_double_loop(spark, receipts, self_pairs, hot_items, form):
    _, items = frames(spark, receipts)
    got = {(r.p1, r.p2): r.pair_count
           for r in tr.pair_counts(items, self_pairs=self_pairs, hot_items=hot_items, form=form).collect()}
    assert got == dict(brute_pairs(receipts, self_pairs))


@SETTINGS
@given(RECEIPTS)
def test_rules_properties(spark, receipts):
    rec, items = frames(spark, receipts)
    rules = {(r.p1, r.p2): r for r in tr.pair_rules(items, rec).collect()}
    occ = Counter(p for _, items_ in receipts for p in items_)
    n = len(receipts)
    for (a, b), r in rules.items():
        assert rules[(b, a)].pair_count == r.pair_count            # symmetric counts
        assert abs(r.support - r.pair_count / n) < 1e-12
        assert abs(r.confidence - r.pair_count / occ[a]) < 1e-12
        assert r.confidence > 0
    for a in occ:  # sum over p2 of pair counts = sum over receipts of c_a * (n_items - 1)
        expect = sum(items_.count(a) * (len(items_) - 1) for _, items_ in receipts)
        assert sum(r.pair_count for (x, _), r in rules.items() if x == a) == expect


@SETTINGS
@given(RECEIPTS)
def test_distinct_pairs(spark, receipts):
    _, items = frames(spark, receipts)
    got = {(r.p1, r.p2): r.pair_count for r in tr.pair_counts(items, distinct_items=True).collect()}
    assert got == dict(brute_pairs(receipts, distinct=True))


@SETTINGS
@given(RECEIPTS, st.integers(min_value=1, max_value=4))
def test_top_k_and_monthly_units(spark, receipts, k):
    _, items = frames(spark, receipts)
    counts = Counter((d[:7], p) for d, items_ in receipts for p in items_)
    expect = []
    for month in sorted({m for m, _ in counts}):
        ranked = sorted(((-n, p) for (m, p), n in counts.items() if m == month))[:k]
        expect += [(month, i + 1, p, -n) for i, (n, p) in enumerate(ranked)]
    got = sorted(tuple(r) for r in tr.monthly_top_products(items, k).collect())
    assert got == sorted(expect)
    total = sum(r.units for r in tr.monthly_counts(items).collect())
    assert total == sum(len(p) for _, p in receipts)


PRICE_ROWS = st.lists(st.tuples(PRODUCTS, st.sampled_from(["0", "1", "2.5", "3"])), max_size=8)


@SETTINGS
@given(RECEIPTS, PRICE_ROWS, st.sampled_from(["inner", "full"]), st.booleans(), st.sampled_from([None, "max"]))
def test_revenue_equals_brute_force(spark, receipts, price_rows, how, zero_missing, dedup):
    from decimal import Decimal
    _, items = frames(spark, receipts)
    prices = spark.createDataFrame([(p, Decimal(v)) for p, v in price_rows], "product string, price decimal(12,2)")
    got = sorted((r.product, r.month, r.units, r.total)
                 for r in tr.monthly_revenue(items, prices, how=how, zero_is_missing=zero_missing, dedup=dedup).collect())
    units = Counter((p, d[:7]) for d, its in receipts for p in its)
    plist = [(p, None if zero_missing and Decimal(v) == 0 else Decimal(v)) for p, v in price_rows]
    if how == "inner":
        plist = [(p, v) for p, v in plist if v is not None]
    if dedup:
        best = {}
        for p, v in plist:
            best[p] = max((x for x in (best.get(p), v) if x is not None), default=None)
        plist = list(best.items())
    expect = []
    for (p, m), n in units.items():
        matches = [v for q, v in plist if q == p]
        expect += [(p, m, n, None if v is None else (n * v).quantize(Decimal("0.01"))) for v in matches]
        if how == "full" and not matches:
            expect.append((p, m, n, None))
    if how == "full":
        sold = {p for p, _ in units}
        expect += [(p, None, None, None) for p, v in plist if p not in sold]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted(got, key=key) == sorted(expect, key=key)


def test_distinct_pairs_equal_fpgrowth(spark):
    """Cross-check with Spark ML's FP-growth on distinct-item baskets (sf0.001)."""
    from pyspark.ml.fpm import FPGrowth
    from pyspark.sql import functions as F

    from tillroll.sources import tables
    items = tables.order_items(spark, "/root/testdata/sf0.001", "name")
    baskets = items.groupBy("rid").agg(F.collect_set("product").alias("items"))
    n = baskets.count()
    fp = FPGrowth(itemsCol="items", minSupport=0.5 / n, minConfidence=0.0).fit(baskets)
    pairs2 = fp.freqItemsets.where(F.size("items") == 2).collect()
    expect = {}
    for r in pairs2:
        a, b = r["items"]
        expect[(a, b)] = r["freq"]
        expect[(b, a)] = r["freq"]
    got = {(r.p1, r.p2): r.pair_count for r in tr.pair_counts(items, distinct_items=True).collect()}
    assert got == expect


NAMES = st.text(alphabet="abc xyz:-_", min_size=1, max_size=8).filter(
    lambda s: s.strip() == s and ", " not in s and s != "")


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["2015-01-03", "2015-02-10"]), st.lists(NAMES, max_size=5)),
                min_size=1, max_size=8), st.integers(min_value=1, max_value=4))
def test_top_line_round_trip(spark, receipts, k):
    _, items = frames(spark, receipts)
    top = tr.monthly_top_products(items, k)
    back = tr.parse_top_line(tr.render_top_line(top))
    assert sorted(map(tuple, back.select("month", "rank", "product", "units").collect())) == \
        sorted(map(tuple, top.collect()))


@SETTINGS
@given(RECEIPTS, PRICE_ROWS)
def test_month_list_round_trip(spark, receipts, price_rows):
    from decimal import Decimal
    _, items = frames(spark, receipts)
    prices = spark.createDataFrame([(p, Decimal(v)) for p, v in price_rows], "product string, price decimal(12,2)")
    rev = tr.monthly_revenue(items, prices, dedup="max")
    back = tr.parse_month_list(tr.render_revenue_slash(rev))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rev.select("product", "month", "total").collect()))
