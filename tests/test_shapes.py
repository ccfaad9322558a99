"""Join / aggregate / window helpers that the registered queries use only indirectly."""

from pyspark.sql import functions as F

from usagelens.operators import aggregates as A
from usagelens.operators import joins as J
from usagelens.operators import windows as W


def test_enrich_chain_and_left_default(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, 99)], "mdn int, enbid int")
    users = spark.createDataFrame([(1, "c1"), (2, "c2")], "mdn int, custid string")
    st = spark.createDataFrame([(10, "P1")], "enbid int, prov string")
    out = J.enrich_chain(fact, [(users, "mdn", "inner"), (st, "enbid", "left", {"prov": "-"})])
    assert sorted(tuple(r) for r in out.select("mdn", "custid", "prov").collect()) == [(1, "c1", "P1"), (2, "c2", "-")]
    lw = J.left_with_default(fact, users, "mdn", {"custid": "未知"})
    assert sorted(r.custid for r in lw.collect()) == ["c1", "c2", "未知"]


def test_join_when_member_requires_ownership(spark):
    fact = spark.createDataFrame([(1, "apn1", "d1,d2"), (2, "apn1", "d3")], "mdn int, apn string, doms string")
    m = spark.createDataFrame([("apn1", "d2"), ("apn1", "d9")], "apn string, dom string")
    got = sorted((r.mdn, r.dom) for r in J.join_when_member(fact, m, "apn", "doms", "dom").collect())
    assert got == [(1, "d2"), (2, None)]


def test_prefix_key_join(spark):
    fact = spark.createDataFrame([("12345",), ("98000",)], "bsid string")
    dim = spark.createDataFrame([("1234", "P")], "pre string, prov string")
    out = fact.join(dim, J.prefix_key("bsid", 4) == dim.pre, "left").collect()
    assert sorted((r.bsid, r.prov) for r in out) == [("12345", "P"), ("98000", None)]


def test_join_back_and_zero_fill(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "a")], "mdn int, cell string")
    back = J.join_back_to_aggregate(df, ["mdn"], [F.count_distinct("cell").alias("n")], F.col("n") > 2)
    assert back.count() == 3 and {r.mdn for r in back.collect()} == {1}
    req = spark.createDataFrame([("k1", 5), ("k2", 3)], "k string, reqs long")
    fail = spark.createDataFrame([("k1", 2)], "k string, fails long")
    z = {r.k: r.fails for r in J.zero_filled(req, fail, ["k"], ["fails"]).collect()}
    assert z == {"k1": 2, "k2": 0}


def test_label_levels_and_ranks_within(spark):
    df = spark.createDataFrame([("p1", "c1", 3), ("p1", "c2", 5), ("p2", "c3", 1)], "prov string, city string, v long")
    gs = A.grouping_sets(df, [["prov", "city"], ["prov"]], [F.sum("v").alias("v")], "gid")
    labelled = {(r.prov, r.city): r.v for r in A.label_levels(gs, ["city"], "t").collect()}
    assert labelled[("p1", "t")] == 8 and labelled[("p1", "c2")] == 5
    r = W.ranks_within(df.withColumn("w", -F.col("v")), ["prov"], ["v", "w"], tiebreak=["city"]).collect()
    got = {x.city: (x.v_rank, x.w_rank) for x in r}
    assert got == {"c1": (2, 1), "c2": (1, 2), "c3": (1, 1)}


def test_reduce_unless_broadcast_both_branches(spark):
    facts = spark.createDataFrame([(1, 10, 5), (1, 10, 7), (2, 10, 1)], "mdn int, enbid int, up long")
    dim = spark.createDataFrame([(1, "c1"), (2, "c2")], "mdn int, custid string")
    raw = J.reduce_unless_broadcast(facts, ["mdn", "enbid"], ["up"], [dim])
    assert raw.count() == 3   # dimension fits: records kept, the join stays map-side
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        red = J.reduce_unless_broadcast(facts, ["mdn", "enbid"], ["up"], [dim])
        assert sorted(tuple(r) for r in red.collect()) == [(1, 10, 12), (2, 10, 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # either way the final per-customer sums agree
    for f in (raw, red):
        got = {r.custid: r.up for r in f.join(dim, "mdn").groupBy("custid").agg(F.sum("up").alias("up")).collect()}
        assert got == {"c1": 12, "c2": 1}
