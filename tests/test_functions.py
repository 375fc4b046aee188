"""Column helpers on literal inputs."""

import pytest
from pyspark.sql import functions as F

from tillroll.functions import (
    decimal2_times100,
    drop_empty,
    items_after_date,
    month_label,
    percent1,
    raw_percent,
    split_tokens,
)


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_month_labels(spark):
    assert one(spark, month_label(F.lit("2015-08"), "MM/yyyy")) == "08/2015"
    assert one(spark, month_label(F.lit("2015-08"), "MM-yyyy")) == "08-2015"
    assert one(spark, month_label(F.lit("2015-08"), "yyyy-MM")) == "2015-08"


def test_tokens(spark):
    assert one(spark, split_tokens(F.lit("a,,b,"), ",")) == ["a", "", "b", ""]
    assert one(spark, split_tokens(F.lit("a|b.c"), "|")) == ["a", "b.c"]     # separator taken literally
    assert one(spark, drop_empty(split_tokens(F.lit("a,,b,"), ","))) == ["a", "b"]
    assert one(spark, items_after_date(split_tokens(F.lit("2015-01-01,a,b"), ","))) == ["a", "b"]
    assert one(spark, items_after_date(split_tokens(F.lit("2015-01-01"), ","))) == []


def test_number_formats(spark):
    assert one(spark, percent1(F.lit(3.0) / F.lit(7.0))) == "42.9%"
    assert one(spark, percent1(F.lit(1.0))) == "100.0%"
    assert one(spark, decimal2_times100(F.lit(51628.0) / F.lit(246110.0))) == "20.98"
    assert one(spark, decimal2_times100(F.lit(0.0))) == "0.00"
    assert one(spark, raw_percent(F.lit(0.75))) == "75.0%"
    assert one(spark, raw_percent(F.lit(3.0) / F.lit(7.0), places=6)) == "42.857143%"


def test_scratch_root_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from tillroll.session import scratch_root

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default: default)))
