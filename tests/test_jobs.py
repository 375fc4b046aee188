"""The command-line jobs on the hand-made receipts."""

import glob
import os

from tillroll import jobs
from tillroll.session import scratch_path

RECEIPTS = "2015-08-20,pane,latte\n2015-08-21,pane,latte,vino\n2015-09-01,vino,vino\n2015-09-02,pane,,latte\n2015-10-05\n\n2015-8-22,pane\n"


def read_lines(path):
    local = path[len("file:"):] if path.startswith("file:") else path
    out = []
    for f in sorted(glob.glob(os.path.join(local, "part-*"))):
        out += open(f).read().splitlines()
    return out


def test_top_job(spark, write_text):
    out = scratch_path(spark, "job-top")
    jobs.main(["top", write_text(RECEIPTS), out, "--style", "line"], spark)
    assert read_lines(out) == ["2015-08:\tpane 3, latte 2, vino 1", "2015-09:\tvino 2, latte 1, pane 1"]


def test_rules_job(spark, write_text):
    out = scratch_path(spark, "job-rules")
    jobs.main(["rules", write_text(RECEIPTS), out, "--style", "percent"], spark)
    lines = read_lines(out)
    assert lines[0] == "latte,pane\t42.9%, 100.0%" and "vino,vino\t28.6%, 66.7%" in lines and len(lines) == 7
    out2 = scratch_path(spark, "job-rules-grid")
    jobs.main(["rules", write_text(RECEIPTS), out2, "--style", "percent", "--hot-items", "1"], spark)
    assert read_lines(out2) == lines


def test_revenue_job(spark, write_text):
    out = scratch_path(spark, "job-rev")
    prices = write_text("pane,2\nlatte,1.5\nvino,0\nolio,4\n")
    jobs.main(["revenue", write_text(RECEIPTS), prices, out, "--how", "full", "--style", "slash"], spark)
    assert read_lines(out) == ["latte\t08/2015:3 09/2015:1.5 ", "olio\t",
                               "pane\t08/2015:6 09/2015:2 ", "vino\t"]


def test_job_options(spark, write_text):
    receipts, prices = write_text(RECEIPTS), write_text("pane,2\npane,3\nlatte,1.5\nvino,0\nolio,4\n")

    def run(*args):
        out = scratch_path(spark, "job")
        jobs.main([*args[:-1], out, *args[-1]], spark)
        return read_lines(out)

    assert run("top", receipts, ["--style", "line", "--trailing-separator"]) == [
        "2015-08:\tpane 3, latte 2, vino 1, ", "2015-09:\tvino 2, latte 1, pane 1, "]
    assert run("top", receipts, ["--style", "line", "--empty", "inner"])[1] == "2015-09:\tvino 2,  1, latte 1, pane 1"
    assert run("revenue", receipts, prices, ["--style", "slash", "--dedup", "max"]) == [
        "latte\t08/2015:3 09/2015:1.5 ", "pane\t08/2015:9 09/2015:3 ", "vino\t08/2015:0 09/2015:0 "]
    assert run("revenue", receipts, prices, ["--style", "slash", "--dedup", "min", "--zero-is-missing"]) == [
        "latte\t08/2015:3 09/2015:1.5 ", "pane\t08/2015:6 09/2015:2 "]
    assert run("revenue", receipts, prices, ["--how", "full", "--style", "slash", "--dedup", "max", "--zero-is-price"])[-1] == \
        "vino\t08/2015:0 09/2015:0 "
    assert run("revenue", receipts, write_text("pane,2.125\n"), ["--price-scale", "3", "--style", "slash"]) == [
        "pane\t08/2015:6.375 09/2015:2.125 "]
    sort = run("rules", receipts, ["--style", "percent"])
    assert sorted(run("rules", receipts, ["--style", "percent", "--unsorted", "--rebalance"])) == sorted(sort)
