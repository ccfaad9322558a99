"""Invariants across operators: unpivot round trip, coarse levels equal sums of
fine levels for additive measures, grouping-set totals equal plain totals, and the
streaming result equals the batch result."""

from pyspark.sql import functions as F

from usagelens.operators import multidim as M
from usagelens.operators import summaries as S
from usagelens.plans import catalog as C
from usagelens.plans import inputs as I
from usagelens.streaming import ingest as ST


def test_unpivot_round_trip(spark, sf_dir):
    long = C.QUERIES["usage_summary"](spark, sf_dir)
    wide = long.groupBy("gather_cycle", "custid", "prov", "city").pivot(
        "gather_type", ["OUTFLOW", "INFLOW", "TOTALFLOW"]).agg(F.first("gather_value"))
    bad = wide.where(F.coalesce("OUTFLOW", F.lit(0)) + F.coalesce("INFLOW", F.lit(0)) != F.col("TOTALFLOW"))
    assert bad.count() == 0
    # the long rows carry every non-zero aggregate exactly once
    assert long.groupBy("gather_cycle", "custid", "prov", "city", "gather_type").count() \
        .where(F.col("count") > 1).count() == 0


def test_city_rows_sum_to_province_rows(spark, sf_dir):
    out = C.QUERIES["daily_failure_summary"](spark, sf_dir).where(F.col("meas_obj") == "MMEREQS")
    city = out.where(F.col("dim_type") == "CITY").groupBy("summ_cycle", "custid", "prov") \
        .agg(F.sum("meas_value").alias("c"))
    prov = out.where(F.col("dim_type") == "PROV").select("summ_cycle", "custid", "prov", F.col("meas_value").alias("p"))
    j = city.join(prov, ["summ_cycle", "custid", "prov"], "full")
    assert j.where(F.col("c").isNull() | F.col("p").isNull() | (F.col("c") != F.col("p"))).count() == 0


def test_grouping_set_totals_equal_plain_totals(spark, sf_dir):
    rows = C._md_rows(spark, sf_dir).withColumn("cycle", F.year("starttime").cast("string"))
    agg = M.multi_dim_usage(C._md_rows(spark, sf_dir), F.year("starttime").cast("string"))
    company = agg.where(F.col("servtype").isNull() & F.col("type").isNull() & F.col("vpdndomain").isNull()) \
        .select("cycle", "companycode", F.col("upflow").alias("g"))
    plain = rows.groupBy("cycle", "companycode").agg(F.sum("upflow").alias("p"))
    j = company.join(plain, ["cycle", "companycode"], "full")
    assert j.where(F.col("g").isNull() | F.col("p").isNull() | (F.col("g") != F.col("p"))).count() == 0
    # per-network rows add up to the all-network row for an additive measure
    nets = agg.where(F.col("servtype").isNull() & F.col("vpdndomain").isNull() & F.col("type").isNotNull()) \
        .groupBy("cycle", "companycode").agg(F.sum("upflow").alias("n"))
    k = company.join(nets, ["cycle", "companycode"])
    assert k.where(F.col("g") != F.col("n")).count() == 0


def test_distinct_users_do_not_add_up_but_bound(spark, sf_dir):
    out = C.QUERIES["auth_summary"](spark, sf_dir)
    # rows without a network form a group of their own, so levels are told by grouping id
    over_nets = F.col("gid").bitwiseAND(F.lit(0b00100)) > 0
    comp = out.where(F.col("servtype").isNull() & over_nets).select(
        "cycle", "companycode", F.col("req_card_cnt").alias("all_users"))
    per_net = out.where(F.col("servtype").isNull() & ~over_nets).groupBy("cycle", "companycode") \
        .agg(F.sum("req_card_cnt").alias("sum_users"), F.max("req_card_cnt").alias("max_users"))
    j = comp.join(per_net, ["cycle", "companycode"])
    # a user seen on both networks is one user overall: max <= all <= sum
    assert j.where((F.col("all_users") > F.col("sum_users")) | (F.col("all_users") < F.col("max_users"))).count() == 0


def test_streaming_equals_batch(spark, sf_dir):
    streamed = C.QUERIES["stream_window_summary"](spark, sf_dir)
    ev = I.table(spark, sf_dir, "events").withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    batch = ev.groupBy(F.window(F.timestamp_seconds(F.unix_timestamp("ts")), "5 minutes").alias("w"), "event_type") \
        .agg(F.count(F.lit(1)).alias("events"), F.sum("cents").alias("total"))
    assert streamed.count() == batch.count()
    assert streamed.agg(F.sum("events"), F.sum("total")).first() == batch.agg(F.sum("events"), F.sum("total")).first()


def test_levels_long_rollup_consistent(spark, sf_dir):
    u = I.located_usage_records(spark, sf_dir).withColumn("enbid", F.col("enbid").cast("string"))
    out = S.levels_long(u, ["prov", "enbid", "cellid"], F.year("starttime").cast("string"))
    top = out.where(F.col("level") == 0).select("cycle", F.col("upflow").alias("t"))
    provs = out.where(F.col("level") == 1).groupBy("cycle").agg(F.sum("upflow").alias("s"))
    assert top.join(provs, "cycle").where(F.col("t") != F.col("s")).count() == 0
