"""Queries over usage records: memory of a task and shuffled rows must not grow with the table."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from usagelens.operators import aggregates as A
from usagelens.operators import joins as J
from usagelens.operators import summaries as S
from usagelens.plans import catalog as C
from usagelens.plans import inputs as I

DAY = dt.date(2024, 1, 1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def many(spark, monkeypatch):
    """The small tables count as many records, and no dimension fits a broadcast."""
    monkeypatch.setattr(J, "ROWS_PER_TASK", 300)
    J._SIZE_CHECKED.clear()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    yield I.usage_tasks(spark, "/root/testdata/sf0.001")
    J._SIZE_CHECKED.clear()
    (spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before) if before
     else spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))


def test_tasks_follow_the_rows(spark):
    assert J.tasks_for(spark, J.ROWS_PER_TASK) is None
    assert J.tasks_for(spark, 36_000_000) == 144
    assert J.tasks_for(spark, 216_000_000) == 6 * 144


@pytest.mark.parametrize("name", ["rollup_period", "roaming_matrix", "usage_summary", "usage_outlier_period",
                                  "movement_outlier", "day_aggregate", "device_outlier", "usage_outlier_day",
                                  "daily_dimension_summary", "levels_long", "active_users_nday"])
def test_records_are_dealt_by_their_number(spark, sf_dir, many, name):
    assert many > spark.sparkContext.defaultParallelism
    records = (I.usage_records(spark, sf_dir, by_user=True) if name == "active_users_nday"
               else I.located_usage_records(spark, sf_dir))
    plan = _plan(records)
    assert f", {many}), REPARTITION_BY_NUM" in plan
    assert "SortMergeJoin" not in plan
    if name in ("roaming_matrix", "usage_summary", "levels_long", "active_users_nday", "day_aggregate"):
        assert "SortMergeJoin" not in _plan(C.QUERIES[name](spark, sf_dir))


def test_active_users_count_once_per_window(spark):
    usage = spark.createDataFrame(
        [(m, DAY + dt.timedelta(days=d), net) for m, d, net in
         [(1, 0, "A"), (1, 0, "A"), (1, 2, "A"), (1, 9, "A"), (2, 2, "A"), (2, 2, None), (2, 3, None), (None, 1, "A")]]
        + [(1, None, "A")], "mdn long, d date, net string")
    users = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (2, None)], "mdn long, belocity string")
    out = S.active_users_nday(usage, users, "d", ["net", "belocity"], n=3)
    seen = usage.join(users, "mdn").withColumn("end_day", F.explode(F.sequence("d", F.date_add("d", 2))))
    want = seen.groupBy("end_day", "net", "belocity").agg(F.count_distinct("mdn").alias("active_users"))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    keyed = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", _plan(out))
    assert keyed and not any("mdn" in k for k in keyed)  # no set of (end day, user) in memory


def test_marks_count_distinct_users_without_their_shuffle(spark):
    rows = spark.createDataFrame(
        [(1, "c", "p", "e"), (1, "c", "p", "e"), (1, "c", "p", None), (1, "c", None, "e"), (2, "c", "p", "e"),
         (None, "c", "p", "e"), (2, None, "p", "e")], "mdn long, cycle string, prov string, enbid string")
    marked = A.mark_first(rows, ["mdn", "cycle"], ["prov", "enbid"], "first_")
    for depth, keys in enumerate((["cycle"], ["cycle", "prov"], ["cycle", "prov", "enbid"])):
        out = marked.groupBy(*keys).agg(F.sum(f"first_{depth}").alias("users"))
        want = rows.groupBy(*keys).agg(F.count_distinct("mdn").alias("users"))
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("name", ["levels_long", "daily_dimension_summary"])
def test_expanded_rows_are_not_shuffled_per_user(spark, sf_dir, name):
    plan = _plan(C.QUERIES[name](spark, sf_dir))
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan[:plan.index("Expand")])
    assert dealt and not any("mdn" in keys for keys in dealt)
