"""Plan properties that matter at scale, checked on the executed plans."""

import re
import uuid
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tillroll.operators import ids, items as it, revenue, rules, stepwise
from tillroll.plans import hive_sql
from tillroll.plans.queries import QUERIES
from tillroll.session import Scope
from tillroll.sources import layout, sinks, tables
from tillroll.sources.receipts import parse_comma_lines

SF = "/root/testdata/sf0.001"


def full_text(df) -> str:
    return df._jdf.queryExecution().toString()


def test_top_k_is_limited_before_the_shuffle(spark):
    plan = full_text(QUERIES["monthly_top5"](spark, SF))
    assert "WindowGroupLimit" in plan
    # partial limit below the exchange, final limit above it
    assert re.search(r"WindowGroupLimit[^\n]*Partial", plan), plan


@contextmanager
def settings(spark, **confs):
    confs = {k.replace("_", "."): v for k, v in confs.items()}
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled_plan(spark, build) -> str:
    """The physical plan as it is with neither adaptive execution nor broadcasts by size."""
    with settings(spark, spark_sql_adaptive_enabled="false", spark_sql_autoBroadcastJoinThreshold="-1"):
        return build()._jdf.queryExecution().executedPlan().toString()


def jobs_of(spark, build) -> int:
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize("hot_items", [None, 4096])
def test_one_exchange_between_items_and_pairs(spark, hot_items):
    items = tables.order_items(spark, SF, "name")  # the part join comes last, so items are not by receipt
    receipts = tables.order_receipts(spark, SF)
    lines = shuffled_plan(spark, lambda: rules.pair_rules(items, receipts, hot_items=hot_items,
                                                          sizes=tables.order_sizes(spark, SF))).splitlines()
    assert sum("Exchange hashpartitioning(rid#" in x and "REPARTITION_BY_COL" in x and "Reused" not in x for x in lines) == 1
    # the other side of the self-join and the occurrences
    assert sum("ReusedExchange" in x and "REPARTITION_BY_COL" in x for x in lines) == 2, "\n".join(lines)


@pytest.mark.parametrize("name", ["pair_rules", "pair_rules_grid", "pair_counts_events_grid", "pair_counts"])
def test_no_window_over_items(spark, name):
    plan = full_text(QUERIES[name](spark, SF))
    assert "Window" not in plan


@pytest.fixture
def hot_items(spark):
    """One receipt holds a third of all rows; the others have three items."""
    hot = spark.range(6000).select(F.lit(-1).alias("rid"), F.concat(F.lit("h"), F.col("id") % 2000).alias("product"))
    rest = spark.range(12000).select((F.col("id") % 4000).cast("int").alias("rid"),
                                     F.concat(F.lit("p"), F.col("id") % 7).alias("product"))
    return hot.unionByName(rest).repartition(4)


def test_no_task_holds_a_hot_receipt(spark, hot_items):
    with settings(spark, spark_sql_adaptive_coalescePartitions_enabled="false",
                  spark_sql_autoBroadcastJoinThreshold="-1"):
        b = rules.make_baskets(hot_items, hot_items=100)
        assert b.plain.where("rid = -1").count() == 0 and b.plain.select("rid").distinct().count() == 4000
        assert b.hot.select("rid", "d").distinct().collect() == [(-1, 2000)]
        grid = rules._grid_pairs(b.hot, 100)
        for frame, total in ((b.hot, 2000), (grid, 2000 * 1999 // 2)):
            tasks = [r[0] for r in frame.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).select("count(1)").collect()]
            assert sum(tasks) == total and len(tasks) >= 6 and max(tasks) < total / 3
        want = rules.pair_counts(hot_items, hot_items=None)
        got = rules.pair_counts(hot_items, hot_items=100)
        assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0


def test_more_hot_receipts_than_the_list_holds(spark, hot_items, monkeypatch):
    want = rules.pair_counts(hot_items, hot_items=None)
    listed = rules.hot_receipts(rules.receipt_sizes(hot_items), 2, most=10)
    assert listed.count() == 10 and listed.where("rid = -1").count() == 1  # the largest first
    monkeypatch.setattr(rules.hot_receipts, "__defaults__", (10,))
    got = rules.pair_counts(hot_items, hot_items=2)
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0


@pytest.fixture
def stored(spark, tmp_path):
    """Items and receipts in Parquet files: 3 items on each of 4000 receipts, 7 names."""
    at = str(tmp_path / "items")
    spark.range(12000).select((F.col("id") % 4000).alias("rid"),
                              F.concat(F.lit("p"), F.col("id") % 7).alias("product")).write.parquet(at)
    spark.range(4000).withColumnRenamed("id", "rid").write.parquet(at + "-receipts")
    receipts = spark.read.parquet(at + "-receipts")
    # joined by receipt, as an adapter's items are; nothing is broadcast
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        yield spark.read.parquet(at).join(receipts, "rid"), receipts


def task_rows(df) -> list[int]:
    return [r[0] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).select("n").collect()]


@pytest.mark.parametrize("wanted", [8, 16, 40])  # 8: the session's own number
def test_basket_tasks_are_bounded_on_large_tables(spark, stored, monkeypatch, wanted):
    items, _ = stored
    want = rules.pair_counts(items).collect()
    small = rules.make_baskets(items)
    assert layout.spread_partitions(items.select("rid", "product")) is None
    assert len(task_rows(small.plain)) < 8  # adaptive execution merges what is small
    size = layout.scanned_bytes(items.select("rid", "product"))
    monkeypatch.setattr(layout, "ADAPTIVE_BYTES", 0)
    monkeypatch.setattr(layout, "TASK_BYTES", -(-size // wanted))
    for hot_items in (None, 4096):
        rows = task_rows(rules.make_baskets(items, hot_items=hot_items).plain)
        assert sum(rows) == 12000 and len(rows) >= wanted - 1 and max(rows) < 2.5 * 12000 / wanted
    assert sorted(rules.pair_counts(items).collect()) == sorted(want)
    assert jobs_of(spark, lambda: rules.pair_counts(items)) == 0


def test_sql_and_steps_are_spread_on_large_tables(spark, stored, monkeypatch):
    items, receipts = stored
    lists = items.select("rid", F.array("product").alias("list"))
    sql, steps = hive_sql.rules_sql(spark, lists, receipts), stepwise.pair_rules_stepwise(items, receipts, self_pairs=False)
    want = [sorted(x.collect()) for x in (sql, steps)]
    monkeypatch.setattr(layout, "ADAPTIVE_BYTES", 0)
    monkeypatch.setattr(layout, "TASK_BYTES", -(-layout.scanned_bytes(items.select("rid", "product")) // 20))
    written = []
    save = stepwise.save_table
    monkeypatch.setattr(stepwise, "save_table", lambda df, name, *a, **kw: (written.append((name, kw)), save(df, name, *a, **kw)))
    sql, steps = hive_sql.rules_sql(spark, lists, receipts), stepwise.pair_rules_stepwise(items, receipts, self_pairs=False)
    assert re.search(r"hashpartitioning\(rid#\d+L?, (19|20)\), REPARTITION_BY_NUM", full_text(sql)), full_text(sql)
    assert [kw["buckets"] in (19, 20) for name, kw in written if name.endswith("_basket")] == [True]
    assert [sorted(x.collect()) for x in (sql, steps)] == want and want[0] == want[1]


PAIR_QUERIES = ["pair_counts_mirror", "pair_counts_selfjoin", "pair_rules", "pair_rules_pct1",
                "pair_rules_pct2", "pair_rules_raw_percent", "pair_rules_unrounded_percent",
                "rules_text_sink", "pair_counts", "pair_rules_distinct"]


@pytest.mark.parametrize("name", PAIR_QUERIES)
def test_every_pair_query_is_spread_on_large_tables(spark, monkeypatch, name):
    made = []
    make = rules.make_baskets
    monkeypatch.setattr(rules, "make_baskets", lambda *a, **kw: (made.append(make(*a, **kw)), made[-1])[1])
    want = sorted(QUERIES[name](spark, SF).collect(), key=str)
    size = layout.scanned_bytes(tables.order_items(spark, SF).select("rid", "product"))
    monkeypatch.setattr(layout, "ADAPTIVE_BYTES", 0)
    monkeypatch.setattr(layout, "TASK_BYTES", -(-size // 20))
    assert sorted(QUERIES[name](spark, SF).collect(), key=str) == want
    merged, spread = (task_rows(b.plain) for b in made)
    assert sum(merged) == sum(spread) > 0
    assert len(merged) < 8 and len(spread) >= 19 and max(spread) < 2.5 * sum(spread) / 20


def test_frames_of_unknown_size_stay_adaptive(spark, monkeypatch):
    monkeypatch.setattr(layout, "ADAPTIVE_BYTES", 0)
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1, "a"), (1, "b")]), "rid BIGINT, product STRING")
    assert layout.spread_partitions(unknown) is None


def test_parts_are_counted_before_they_are_named(spark):
    for name in ("monthly_top5", "product_occurrences"):
        lines = shuffled_plan(spark, lambda n=name: QUERIES[n](spark, SF)).splitlines()
        at = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\([^)]*l_partkey|Exchange hashpartitioning\(product#", line)]
        assert at
        for i in at:  # what is exchanged by part key or name are counts, or the part table
            below = " ".join(lines[i + 1:i + 4])
            assert "HashAggregate" in below or "p_partkey" in below, "\n".join(lines)


def test_full_revenue_is_one_tagged_aggregation(spark):
    for name in ("monthly_revenue_full", "monthly_revenue_full_zero"):
        plan = shuffled_plan(spark, lambda n=name: revenue_rows(spark, n))
        assert "FullOuter" not in plan and "Union" in plan
        by_product = [x for x in plan.splitlines() if re.search(r"Exchange hashpartitioning\(product#\d+, _grouping", x)]
        assert len(by_product) == 1, plan


def revenue_rows(spark, name):
    items = it.with_month(tables.order_items(spark, SF, "partkey"))
    return revenue.monthly_revenue(items, tables.part_prices(spark, SF), how="full", zero_is_missing=name.endswith("zero"))


def test_three_grains_are_one_expand(spark):
    plan = full_text(QUERIES["one_pass_counts"](spark, SF)).split("== Physical Plan ==")[1]
    assert len(re.findall(r"[-+ ]Expand \[", plan)) == 1
    assert re.search(r"\(p1#\d+ < p2#\d+\)", plan) and not re.search(r"NOT \(p1#\d+ = p2#\d+\)", plan.split("Expand")[1])


def test_bucketed_table_has_a_file_per_bucket(spark):
    with Scope(spark) as scope:
        b = rules.make_baskets(tables.order_items(spark, SF, "partkey").repartition(8), hot_items=None).plain
        path, name = scope.path("buckets"), scope.table("tillroll_test_buckets")
        sinks.save_table(b, name, path, bucket_by="rid", buckets=8)
        files = [f for f in spark.table(name).inputFiles()]
        assert len(files) == 8
        read = rules.Baskets(spark.table(name), None, None)
        plan = shuffled_plan(spark, lambda: rules.pair_weights(read))
        assert "Exchange" not in plan, plan


def test_rebalance_is_an_option_and_starts_no_job(spark):
    lines = spark.createDataFrame([(f"2024-02-{d:02d},bread,milk",) for d in range(1, 29)], "value STRING").repartition(5)
    assert jobs_of(spark, lambda: parse_comma_lines(lines)) == 0
    assert jobs_of(spark, lambda: parse_comma_lines(lines, rebalance=True)) == 0
    assert "RebalancePartitions" not in full_text(parse_comma_lines(lines))
    spread = parse_comma_lines(lines, rebalance=True)
    assert "RebalancePartitions" in full_text(spread)
    assert sorted(spread.select("data").collect()) == sorted(parse_comma_lines(lines).select("data").collect())
    with settings(spark, spark_tillroll_rebalanceScans="true"):
        assert "RebalancePartitions" in full_text(QUERIES["monthly_top5"](spark, SF))
    assert "RebalancePartitions" not in full_text(QUERIES["monthly_top5"](spark, SF))


@pytest.mark.parametrize("name", ["global_sort", "pair_rules", "monthly_revenue_full", "hive_rules_sql", "one_pass_counts"])
def test_no_job_before_the_action(spark, name):
    assert jobs_of(spark, lambda: QUERIES[name](spark, SF)) == 0


def test_dense_numbering_orders_ranges_apart(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 1000).alias("k"), F.col("id").alias("v"))
    numbered = ids.with_row_number(df, ["k"], "n", ranges=16)
    text = shuffled_plan(spark, lambda: numbered)
    windows = [line for line in text.splitlines() if re.search(r"Window \[", line)]
    assert windows and all(("row_number" in w and "_range" in w.split("windowspecdefinition")[1]) or "sum(_n" in w for w in windows)
    per_range = numbered.groupBy(F.floor((F.col("n") - 1) / 200)).agg(F.count(F.lit(1)).alias("c")).collect()
    assert sum(r.c for r in per_range) == 3000
    with settings(spark, spark_sql_adaptive_enabled="false"):
        tasks = [r.c for r in numbered.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("c")).collect()]
    assert max(tasks) < 1500


@pytest.mark.parametrize("name", ["pair_rules_stepwise", "table_overwrite", "hive_top5_sql", "hive_revenue_sql",
                                  "hive_rules_sql", "hive_rules_steps"])
def test_nothing_is_left_in_the_catalog(spark, name):
    before = {t.name for t in spark.catalog.listTables()}
    QUERIES[name](spark, SF).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("name", ["monthly_top5", "monthly_revenue", "pair_rules", "pair_counts_events"])
def test_scans_read_only_needed_columns(spark, name):
    text = full_text(QUERIES[name](spark, SF))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        assert len(schema.split(",")) <= 3, schema


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_evaluation(spark, name):
    text = full_text(QUERIES[name](spark, SF))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert marker not in text


@pytest.mark.parametrize("name", ["pair_rules", "pair_rules_stepwise", "one_pass_counts", "monthly_revenue"])
def test_no_cross_join_and_only_bounded_broadcasts(spark, name):
    df = QUERIES[name](spark, SF)
    optimized = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("Join Cross" in line for line in optimized)
    for i, line in enumerate(optimized):  # the only hinted sides are the lists of hot receipts, cut by a limit
        if "strategy=broadcast" in line:
            assert any("GlobalLimit 65536" in below for below in optimized[i + 1:]), "\n".join(optimized)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in final and "CartesianProduct" not in final


