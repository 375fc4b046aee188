"""Owned intermediates: kept while in use, gone afterwards."""

import os

import pytest

from tillroll.session import Scope, scratch_root


def local(path):
    return path.removeprefix("file:")


def test_scope_owns_folders_tables_and_views(spark):
    df = spark.range(5).toDF("x")
    with Scope(spark) as scope:
        kept = scope.keep(df, "five")
        other = scope.path("other")
        df.write.option("path", other).saveAsTable(scope.table("tillroll_scope_test"))
        view = scope.view(df, "five")
        assert spark.table(view).count() == spark.table("tillroll_scope_test").count() == kept.count() == 5
        read = spark.table("tillroll_scope_test")
        scope.release()
        assert not spark.catalog.tableExists("tillroll_scope_test") and not spark.catalog.tableExists(view)
        assert read.count() == 5  # its plan names the files
        folder = local(kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("//"))
        assert os.path.isdir(local(other)) and os.path.isdir(folder)
        assert local(other).startswith(local(scratch_root(spark)))
    assert not os.path.exists(local(other)) and not os.path.exists(folder)


def test_scope_closes_after_an_error(spark):
    with pytest.raises(RuntimeError), Scope(spark) as scope:
        path = scope.path("x")
        spark.range(1).write.parquet(path)
        raise RuntimeError
    assert not os.path.exists(local(path))


def test_one_folder_can_go_early(spark):
    with Scope(spark) as scope:
        path = scope.path("x")
        spark.range(1).write.parquet(path)
        scope.drop(path)
        assert not os.path.exists(local(path))
