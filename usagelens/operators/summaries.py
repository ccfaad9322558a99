"""Report families (survey AN-1..5, 11..14, 33, 38..41, 43..45, 52).

Each operator is DataFrame-in, DataFrame-out; column names and sentinels are
parameters with the reference's defaults.  The cycle (5-minute slot, hour, day,
month) is a grouping column the caller supplies, so one call summarises every
slot of its input in a single pass instead of one job per slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import stored_step
from . import aggregates as A
from . import joins as J
from . import packing as P
from . import windows as W

# Labels and sentinels the reference's reports write.
# Usage measures (OUTFLOW is the uplink volume, INFLOW the downlink one, as named there).
USAGE_MEASURES = {"OUTFLOW": "upflow", "INFLOW": "downflow", "TOTALFLOW": "totalflow"}
ACTIVE_USERS, SESSIONS, TERM_MEASURE = "ACTIVEUSERS", "SESSIONS", "-1"
LEVEL_BS, LEVEL_CITY, LEVEL_PROV, LEVEL_TERM = "BS", "CITY", "PROV", "TERMDETAIL"
REQS, FAILREQS, FAILUSERS = "REQS", "FAILREQS", "FAILUSERS"
MSGS = "MSGS"
MME_REQS, MME_FAILREQS, MME_FAILUSERS = "MMEREQS", "MMEFAILREQS", "MMEFAILUSERS"
LOCAL, ROAMOUT, ROAMIN = "LOCAL", "ROAMOUT", "ROAMIN"
USER_PREFIX, FLUX_PREFIX = "USER_", "FLUX_"
UNKNOWN = "未知"   # customer / city of a record whose dimension row is missing
NATION = "全国"    # national total row
RECORDS_A_ROW = 2  # records of a row from which they are summed before they are dealt by the row's group


def usage_summary(usage: DataFrame, users: DataFrame, stations: DataFrame,
                  cycle: Column, user_filter: Column | None = None,
                  city_sentinel: str = "-") -> DataFrame:
    """AN-1: usage per (cycle, customer, province, city) in long form.

    usage(mdn, enbid, prov, upflow, downflow) ⋈ users(mdn, custid) [inner, users
    passing ``user_filter``, default ``isnb = '1'``] ⋈ stations(enbid, provname,
    cityname) on station id **and** province [inner]; sums of up and down volume,
    total = up + down; unpivoted to OUTFLOW / INFLOW / TOTALFLOW rows; zero
    values dropped.
    """
    if user_filter is None:
        user_filter = F.col("isnb") == "1"
    u = users.where(user_filter).select("mdn", "custid")
    b = stations.select("enbid", F.col("provname").alias("prov"),
                        F.coalesce(F.col("cityname"), F.lit(city_sentinel)).alias("city"))
    # Records are reduced per (cycle, user, station) first when a join would shuffle them.
    facts = J.reduce_unless_broadcast(usage.withColumn("gather_cycle", cycle),
                                      ["gather_cycle", "mdn", "enbid", "prov"], ["upflow", "downflow"], [u, b])
    joined = J.dimension_join(facts, u, "mdn").join(J.sized(b), ["enbid", "prov"])
    agg = (joined.groupBy("gather_cycle", "custid", "prov", "city")
           .agg(F.sum("upflow").alias("upflow"), F.sum("downflow").alias("downflow"))
           .withColumn("totalflow", F.col("upflow") + F.col("downflow")))
    return A.unpivot_measures(agg, ["gather_cycle", "custid", "prov", "city"], USAGE_MEASURES,
                              "gather_type", "gather_value", drop_zero=True)


def _long(df: DataFrame, ids: Sequence[str], rows: Sequence[tuple[str, Column, Column]],
          type_col: str = "meas_obj", value_col: str = "meas_value",
          rank_col: str = "meas_rank") -> DataFrame:
    """Wide → long with a value *and* a rank per measure, in one projection
    (``inline`` of an array of structs) instead of one union branch per measure."""
    structs = [F.struct(F.lit(label).alias(type_col), value.cast("bigint").alias(value_col),
                        rank.cast("int").alias(rank_col)) for label, value, rank in rows]
    return df.select(*ids, F.inline(F.array(*structs)))


def procedure_summary(log: DataFrame, users: DataFrame, stations: DataFrame, cycle: Column,
                      user_filter: Column | None = None, city_sentinel: str = "-") -> DataFrame:
    """AN-2: per (cycle, customer, province, city): requests (REQS), failed requests
    (FAILREQS) and distinct failing users (FAILUSERS), in long form.

    log(mdn, enbid, result) ⋈ users(mdn, custid) [inner] ⋈ stations(enbid) [inner].
    The reference joined a second aggregate of failing users back with a left join
    and ``nvl(.., 0)``; a conditional distinct count in the same aggregate gives the
    same zero-filled value in one pass."""
    if user_filter is None:
        user_filter = F.col("isnb") == "1"
    u = users.where(user_filter).select("mdn", "custid")
    b = stations.select("enbid", F.col("provname").alias("prov"),
                        F.coalesce(F.col("cityname"), F.lit(city_sentinel)).alias("city"))
    j = log.select(cycle.alias("gather_cycle"), "mdn", "enbid", "result").join(J.sized(u), "mdn").join(J.sized(b), "enbid")
    failed = F.col("result") == "failed"
    agg = j.groupBy("gather_cycle", "custid", "prov", "city").agg(
        F.count(F.lit(1)).alias("reqcnt"),
        A.sum_if(F.lit(1), failed).alias("failreqcnt"),
        A.count_distinct_if(F.col("mdn"), failed).alias("failusers"))
    return agg.select("gather_cycle", "custid", "prov", "city", F.inline(F.array(
        *[F.struct(F.lit(t).alias("gather_type"), F.col(c).cast("bigint").alias("gather_value"))
          for t, c in ((REQS, "reqcnt"), (FAILREQS, "failreqcnt"), (FAILUSERS, "failusers"))])))


def message_summary(sms: DataFrame, users: DataFrame, cycle: Column,
                    user_filter: Column | None = None) -> DataFrame:
    """AN-3: messages per (cycle, customer).  A message counts once for the called
    user's customer ('r') and once for the calling user's ('s').

    The two roles are produced by exploding (callee, caller) per message, so the
    user dimension is joined once instead of twice (JN-21 as one join)."""
    if user_filter is None:
        user_filter = F.col("isnb") == "1"
    u = users.where(user_filter).select("mdn", "custid")
    roles = sms.select(cycle.alias("gather_cycle"), F.inline(F.array(
        F.struct(F.lit("r").alias("type"), F.col("callee").alias("mdn")),
        F.struct(F.lit("s").alias("type"), F.col("caller").alias("mdn")))))
    agg = roles.join(J.sized(u), "mdn").groupBy("gather_cycle", "custid").agg(
        F.count(F.lit(1)).alias("gather_value"))
    return agg.select("gather_cycle", "custid", F.lit("-1").alias("prov"), F.lit("-1").alias("city"),
                      F.lit(MSGS).alias("gather_type"), "gather_value")


def daily_dimension_summary(usage: DataFrame, users: DataFrame, stations: DataFrame,
                            devices: DataFrame, cycle: Column, unknown_customer: str = UNKNOWN,
                            city_sentinel: str = "-", user_filter: Column | None = None,
                            ascending: bool = True, total_rank_from: str = "downflow",
                            tasks: int | None = None) -> DataFrame:
    """AN-4: usage summary at levels BS / CITY / PROV / TERMDETAIL.

    Enrichment is one chain of left joins (users → custid or ``unknown_customer``;
    stations on (enbid, prov); devices on tac).  Measures are up / down / total volume, active
    users (distinct mdn) and sessions (count of session ids); TERMDETAIL counts distinct users
    per model.  Distinct users are sums of marks on a user's first row per key.  The marked
    records are stored, as each level reads them.  Each measure is ranked per (cycle, level,
    customer) with ``row_number`` — ascending by default, as in the reference, where the
    TOTALFLOW row also carries the downlink rank (``total_rank_from``).  Output is long; zero
    values dropped.

    ``tasks`` says among how many tasks many records, dealt by user, are dealt again for the
    joins, marks and ranks (None: as Spark does); they are packed for that.  A step of two such
    shuffles is stored, so that its shuffle files need not stay until the end."""
    if user_filter is None:
        user_filter = F.col("isnb") == "1"
    u = users.where(user_filter).select("mdn", "custid")
    b = stations.select("enbid", F.col("provname").alias("prov"), F.col("cityname").alias("bcity"),
                        F.lit(True).alias("bmatch"))
    models = devices.select("tac", "modelname").distinct()
    # A record counts once per row that the device register has for its terminal; models
    # themselves only name TERMDETAIL rows and are joined to those.
    repeated = devices.groupBy("tac").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    # Records are reduced per (cycle, user, station, terminal) first when a join would
    # shuffle them; sums and session counts are additive, distinct users are counted
    # after the joins.
    facts = J.reduce_unless_broadcast(
        usage.withColumn("summ_cycle", cycle)
        .withColumn("sessions", F.when(F.col("session_id").isNotNull(), 1).otherwise(0)),
        ["summ_cycle", "mdn", "enbid", "prov", "tac"], ["upflow", "downflow", "sessions"], [u, b])
    copies = F.coalesce("copies", F.lit(1).cast("bigint"))
    facts = (facts.join(J.sized(u), "mdn", "left").join(J.sized(repeated), "tac", "left")
             .select("summ_cycle", F.coalesce("custid", F.lit(unknown_customer)).alias("custid"), "mdn", "enbid", "prov", "tac",
                     *[(F.col(c) * copies).alias(c) for c in ("upflow", "downflow", "sessions")]))
    codes: dict[str, P.Code] = {}
    dealt = tasks is not None and not J.fits_broadcast(b)
    if dealt:  # by station for the join, and by user again
        facts = stored_step(facts, "dimension-facts")
        codes = P.codes_of(facts, [c for c in facts.columns if c not in ("mdn", "prov")])
        facts = P.spread_packed(facts, tasks, ["enbid", "prov"], codes)
    # Province and city shown are the station's (province null, city '-' when unknown).
    enriched = (facts.join(J.sized(b), ["enbid", "prov"], "left")
                .withColumns({"prov": F.when(F.col("bmatch"), F.col("prov")),
                              "city": F.coalesce("bcity", F.lit(city_sentinel))}).drop("bcity", "bmatch"))
    if dealt:
        places = P.codes_of(b, ["prov", "bcity"])
        if "bcity" in places and (city := P.texts_code([*places.pop("bcity").texts, city_sentinel])):
            places["city"] = city
        enriched = P.spread_packed(enriched, tasks, ["mdn"], {**codes, **places})
    user = ["mdn", "summ_cycle", "custid"]
    marked = A.mark_first(A.mark_first(enriched, user, ["prov", "city", "enbid"], "place_"),
                          user, ["prov", "city", "tac"], "term_")
    first = {LEVEL_PROV: "place_1", LEVEL_CITY: "place_2", LEVEL_BS: "place_3", LEVEL_TERM: "term_3"}
    sums = ["upflow", "downflow", "sessions"]
    marked = stored_step(marked.select("summ_cycle", "custid", "prov", "city", "enbid", "tac", *sums, *first.values()),
                         "dimension-records")
    codes = P.codes_of(marked, marked.columns) if tasks is not None else {}
    group = ["summ_cycle", "custid"]
    by_group = lambda df, codes: (df.repartition(*group) if tasks is None
                                  else P.spread_packed(df, tasks, group, codes))
    # Station rows are summed where they are ranked, unless a station row has many records: those
    # are summed map-side first, so that a ranking task never holds many more rows than it ranks.
    place = ["enbid", "prov", "city"]
    records = marked.drop("tac", *[m for k, m in first.items() if k != LEVEL_BS])
    summed = lambda df: df.groupBy(*group, *place).agg(
        *[F.sum(c).alias(c) for c in sums], F.sum(first[LEVEL_BS]).alias("users"))
    seen = None if tasks is None else marked.agg(
        F.count(F.lit(1)).alias("records"), F.approx_count_distinct(F.struct(*group, *place)).alias("rows")).first()
    if seen and seen["records"] > RECORDS_A_ROW * seen["rows"]:
        bs = by_group(summed(records), {c: codes[c] for c in place if c in codes})  # sums exceed the records' ranges
    else:
        bs = summed(by_group(records, codes))
    bs = (bs.withColumns({"dim_type": F.lit(LEVEL_BS), "enbid": F.col("enbid").cast("string")})
          .withColumn("dim_obj", F.col("enbid")))
    # Cities and provinces are few rows, summed map-side.
    sets = {LEVEL_CITY: [*group, "prov", "city"], LEVEL_PROV: [*group, "prov"]}
    areas = A.grouping_sets(marked, list(sets.values()), [
        *[F.sum(c).alias(c) for c in sums], *[F.sum(first[k]).alias(first[k]) for k in sets]], id_col="gid")
    areas = areas.withColumn("dim_type", A.level_of("gid", list(sets.values()), sets))
    is_city = F.col("dim_type") == LEVEL_CITY
    areas = (areas.withColumn("users", F.when(is_city, F.col(first[LEVEL_CITY])).otherwise(F.col(first[LEVEL_PROV])))
             .withColumns({"dim_obj": F.when(is_city, F.col("city")).otherwise(F.col("prov")), "enbid": F.lit(None).cast("string")}))
    terms = marked.select(*group, "prov", "city", "tac", first[LEVEL_TERM])
    terms = (P.spread_packed(terms, tasks, ["tac"], codes).groupBy(*group, "prov", "city", "tac")
             .agg(F.sum(first[LEVEL_TERM]).alias("users")).join(J.sized(models), "tac", "left"))
    terms = by_group(terms, {**codes, **(P.codes_of(models, ["modelname"]) if tasks is not None else {})})
    terms = terms.withColumn("dim_type", F.lit(LEVEL_TERM)).withColumn("tac", F.col("tac").cast("string"))

    # Measures a level is ranked by (TERMDETAIL: users alone), as long rows: one window and one
    # sort rank them all.  A rank group is one measure of one customer and level, at most a row
    # per station, place or terminal type of the registers.
    measure = lambda name: F.struct(F.lit(name).alias("measure"), F.col(name).cast("bigint").alias("value"))
    names = ["upflow", "downflow", "users", "sessions"]

    def ranked(level: DataFrame, obj: Column, measures: Sequence[str], tie: Sequence[str]) -> DataFrame:
        total = F.col("upflow") + F.col("downflow") if "upflow" in measures else F.lit(None).cast("bigint")
        long = level.select(*group, "dim_type", obj.alias("dim_obj"), total.alias("totalflow"), "prov", "city",
                            *[c for c in tie if c not in ("prov", "city")], F.inline(F.array(*[measure(n) for n in measures])))
        placed = W.rank_within(long, [*group, "dim_type", "measure"], ["value"], "meas_rank", ascending=ascending, tiebreak=tie)
        return placed.select(*group, "dim_type", "dim_obj", "totalflow", "prov", "city", "measure", "value", "meas_rank")
    placed = (ranked(bs, F.col("dim_obj"), names, ["enbid", "prov", "city"])
              .unionByName(ranked(areas, F.col("dim_obj"), names, ["prov", "city"]))
              .unionByName(ranked(terms, F.col("modelname"), ["users"], ["prov", "city", "modelname", "tac"])))

    def m(label, value):
        return F.struct(label.alias("meas_obj"), value.cast("bigint").alias("meas_value"))
    label = F.when(F.col("dim_type") == LEVEL_TERM, F.lit(TERM_MEASURE))
    for name, text in (("upflow", "OUTFLOW"), ("downflow", "INFLOW"), ("users", ACTIVE_USERS)):
        label = label.when(F.col("measure") == name, F.lit(text))
    own = m(label.otherwise(F.lit(SESSIONS)), F.col("value"))
    # The total's row goes along with the measure whose rank it carries.
    rows = F.when((F.col("measure") == total_rank_from) & (F.col("dim_type") != LEVEL_TERM),
                  F.array(own, m(F.lit("TOTALFLOW"), F.col("totalflow")))).otherwise(F.array(own))
    out_city = F.when(F.col("dim_type") == "PROV", F.lit("-1")).otherwise(F.col("city"))
    out = placed.select("summ_cycle", "custid", out_city.alias("city"), "prov", F.lit("-1").alias("district"),
                        "dim_type", "dim_obj", F.col("meas_rank").cast("int").alias("meas_rank"), F.inline(rows))
    ids = ["summ_cycle", "custid", "city", "prov", "district", "dim_type", "dim_obj"]
    return out.where(F.col("meas_value") != 0).select(*ids, "meas_obj", "meas_value", "meas_rank")


def daily_failure_summary(log: DataFrame, users: DataFrame, stations: DataFrame, cycle: Column,
                          user_filter: Column | None = None,
                          unknown_customer: str = UNKNOWN) -> DataFrame:
    """AN-5: procedure requests and failures rolled up BS → CITY → PROV → CUST, plus
    failure causes per customer ranked by failure count (desc).

    The station level is aggregated from the log; coarser levels re-aggregate the
    station rows (additive measures only, AG-16) with one grouping-sets pass over
    the rows whose station is known (the reference re-joined the station table with
    an inner join at each coarser level).  Cause rows carry MMEFAILREQS with its
    rank and MMEFAILUSERS (distinct failing users, not additive, so computed from
    the log) with rank -1."""
    if user_filter is None:
        user_filter = F.col("isnb") == "1"
    u = users.where(user_filter).select("mdn", "custid")
    b = stations.select("enbid", F.col("provname").alias("prov"), F.col("cityname").alias("city"),
                        F.lit(True).alias("known"))
    failed = F.col("result") == "failed"
    # The log is read, reduced and joined once; levels and causes both come from these rows
    # (only a failed request keeps its cause).
    base = (log.groupBy(cycle.alias("summ_cycle"), "mdn", "enbid", F.when(failed, F.col("cause")).alias("cause"))
            .agg(F.count(F.lit(1)).alias("reqcnt"), A.sum_if(F.lit(1), failed).alias("failcnt"))
            .join(J.sized(u), "mdn", "left").join(J.sized(b), "enbid", "left")
            .withColumn("custid", F.coalesce("custid", F.lit(unknown_customer))))
    bs = base.groupBy("summ_cycle", "custid", "enbid", "prov", "city", "known").agg(
        F.sum("reqcnt").alias("reqcnt"), F.sum("failcnt").alias("failcnt"))
    levels = {"CITY": ["summ_cycle", "custid", "prov", "city"], "PROV": ["summ_cycle", "custid", "prov"],
              "CUST": ["summ_cycle", "custid"]}
    coarse = A.grouping_sets(bs.where(F.col("known")), list(levels.values()),
                             [F.sum("reqcnt").alias("reqcnt"), F.sum("failcnt").alias("failcnt")], "gid")
    coarse = coarse.select("summ_cycle", "custid", F.coalesce("prov", F.lit("-1")).alias("prov"),
                           F.coalesce("city", F.lit("-1")).alias("city"),
                           A.level_of("gid", list(levels.values()), levels).alias("dim_type"),
                           "reqcnt", "failcnt")
    coarse = coarse.withColumn("dim_obj", F.when(F.col("dim_type") == "CITY", F.col("city"))
                               .when(F.col("dim_type") == "PROV", F.col("prov")).otherwise(F.col("custid")))
    bs_rows = bs.select("summ_cycle", "custid", "prov", "city", F.lit("BS").alias("dim_type"),
                        "reqcnt", "failcnt", F.col("enbid").cast("string").alias("dim_obj"))
    levels = bs_rows.unionByName(coarse).withColumn("dim_obj_2", F.lit("-1"))
    ids = ["summ_cycle", "custid", "prov", "city", "dim_type", "dim_obj", "dim_obj_2"]
    level_long = _long(levels, ids, [(MME_REQS, F.col("reqcnt"), F.lit(-1)),
                                     (MME_FAILREQS, F.col("failcnt"), F.lit(-1))])
    causes = base.where(F.col("failcnt") > 0).groupBy("summ_cycle", "custid", "cause").agg(
        F.sum("failcnt").alias("failcnt"), F.count_distinct("mdn").alias("failusers"))
    causes = W.rank_within(causes, ["summ_cycle", "custid"], ["failcnt"], "failrank",
                           ascending=False, tiebreak=["cause"])
    cause_long = _long(causes.select("summ_cycle", "custid", F.lit("-1").alias("prov"),
                                     F.lit("-1").alias("city"), F.lit("CAUSE").alias("dim_type"),
                                     F.col("custid").alias("dim_obj"), F.col("cause").alias("dim_obj_2"),
                                     "failcnt", "failusers", "failrank"),
                       ids, [(MME_FAILREQS, F.col("failcnt"), F.col("failrank")),
                             (MME_FAILUSERS, F.col("failusers"), F.lit(-1))])
    return level_long.unionByName(cause_long)


# Grouping columns of the per-user daily table (AN-38) and their sources.
DAY_KEYS = ["cycle", "custid", "mdn", "enbid", "provid", "lanid", "eci", "apn", "tac",
            "own_provid", "own_lanid"]


def day_aggregate(usage: DataFrame, users: DataFrame, stations: DataFrame, cycle: Column,
                  user_filter: Column | None = None, city_sentinel: str = "-",
                  tasks: int | None = None, needed: Sequence[str] | None = None) -> DataFrame:
    """AN-38: per (cycle, customer, user, station, cell, apn, tac, home area) totals:
    up / down volume, sessions (record count), duration (sum) and times (distinct
    session ids).  Users inner-joined (``isnb = '1'``), stations left-joined on
    (enbid, prov); the station's province/city become ``provid``/``lanid``.

    ``needed``: the columns of the result that the caller reads (all).  ``tasks``: among how many
    tasks many records, dealt by user, are dealt again by station where the stations are too many
    to be sent to all; the rows are stored with the needed columns before, and packed (None: as
    Spark does)."""
    if user_filter is None:
        user_filter = F.col("isnb") == "1"
    u = users.where(user_filter).select("mdn", "custid", F.col("beloprov").alias("own_provid"),
                                        F.col("belocity").alias("own_lanid"))
    b = stations.select("enbid", F.col("provname").alias("prov"), F.col("cityname").alias("bcity"),
                        F.lit(True).alias("bmatch"))
    # Aggregate on the record's own narrow keys first, then attach the user and station
    # attributes to the (much smaller) aggregate; the dimension keys are unique, so the
    # result equals enriching every record before grouping.
    # Records of users outside the filter go first: a map-side semi join where the users fit.
    kept = usage.join(J.sized(u.select("mdn")), "mdn", "left_semi")
    agg = (kept.groupBy(cycle.alias("cycle"), "mdn", "enbid", "prov", F.col("cellid").alias("eci"),
                         F.col("nai_domain").alias("apn"), "tac")
           .agg(F.sum("upflow").alias("upflow"), F.sum("downflow").alias("downflow"),
                F.count("mdn").alias("sessions"), F.sum("duration").alias("duration"),
                F.count_distinct("session_id").alias("times")))
    rows = agg.join(J.sized(u), "mdn")
    needed = list(needed or [*DAY_KEYS, "upflow", "downflow", "sessions", "duration", "times"])
    if tasks is not None and not J.fits_broadcast(b):
        narrow = [c for c in needed if c not in ("enbid", "prov", "provid", "lanid")]
        rows = stored_step(rows.select("enbid", "prov", *narrow), "day-usage")
        rows = P.spread_packed(rows, tasks, ["enbid", "prov"], P.codes_of(rows, narrow))
    j = (rows.join(J.sized(b), ["enbid", "prov"], "left")
         .withColumn("provid", F.when(F.col("bmatch"), F.col("prov")))
         .withColumn("lanid", F.coalesce("bcity", F.lit(city_sentinel))))
    return j.select(*needed)


def rollup_period(day_rows: DataFrame, period: Column, keys: Sequence[str]) -> DataFrame:
    """AN-39: period (week / month) rows as sums of daily rows over ``keys``.  Distinct
    counts (``times``) are **added** across days, not recomputed — the reference's
    documented behaviour."""
    return day_rows.withColumn("period", period).groupBy("period", *keys).agg(
        F.sum("upflow").alias("upflow"), F.sum("downflow").alias("downflow"),
        F.sum("sessions").alias("sessions"), F.sum("duration").alias("duration"),
        F.sum("times").alias("times"))


def roaming_matrix(usage: DataFrame, users: DataFrame, stations: DataFrame, home: str,
                   cycle: Column, unknown: str = UNKNOWN) -> DataFrame:
    """AN-11: local / roam-out / roam-in usage of a home province.

    Records (visited province ``prov``) are left-joined to users (home province and
    city, industry) and stations on (enbid, prov) (visited city).  A record is
    LOCAL when visited and home province are ``home``, ROAMOUT when only the home
    province is, ROAMIN when only the visited one is.  Per (cycle, class, visited
    province, home province, home city, visited city, industry): distinct users and
    up / down / total volume, as long rows ``USER_<class>``, ``FLUX_<class>``,
    ``FLUX_<class>_U``, ``FLUX_<class>_D``.  The class is a column, so the three
    classes are one aggregation instead of three scans."""
    u = users.select("mdn", "beloprov", "belocity", "ind_type")
    b = stations.select("enbid", F.col("provname").alias("prov"), F.col("cityname").alias("bcity"))
    facts = J.reduce_unless_broadcast(usage.withColumn("gather_date", cycle),
                                      ["gather_date", "mdn", "enbid", "prov"], ["upflow", "downflow"], [u, b])
    j = (facts.join(J.sized(u), "mdn", "left").join(J.sized(b), ["enbid", "prov"], "left")
         .withColumn("regcity", F.coalesce("belocity", F.lit(unknown)))
         .withColumn("city", F.coalesce("bcity", F.lit(unknown))))
    h = F.lit(home)
    klass = (F.when((F.col("prov") == h) & (F.col("beloprov") == h), F.lit(LOCAL))
             .when((F.col("prov") != h) & (F.col("beloprov") == h), F.lit(ROAMOUT))
             .when((F.col("prov") == h) & (F.col("beloprov") != h), F.lit(ROAMIN)))
    keys = ["gather_date", "klass", "prov", "beloprov", "regcity", "city", "ind_type"]
    agg = (j.withColumn("klass", klass).where(F.col("klass").isNotNull()).groupBy(*keys)
           .agg(F.count_distinct("mdn").alias("users"), F.sum("upflow").alias("up"),
                F.sum("downflow").alias("down")))
    out = agg.select(F.col("gather_date"), F.col("beloprov").alias("regprovince"), "regcity",
                     F.col("prov").alias("province"), "city", "ind_type", "klass", F.inline(F.array(
                         F.struct(F.lit(USER_PREFIX).alias("p"), F.lit("").alias("s"), F.col("users").alias("gather_value")),
                         F.struct(F.lit(FLUX_PREFIX).alias("p"), F.lit("").alias("s"), (F.col("up") + F.col("down")).alias("gather_value")),
                         F.struct(F.lit(FLUX_PREFIX).alias("p"), F.lit("_U").alias("s"), F.col("up").alias("gather_value")),
                         F.struct(F.lit(FLUX_PREFIX).alias("p"), F.lit("_D").alias("s"), F.col("down").alias("gather_value")))))
    return out.select("gather_date", "regprovince", "regcity", "province", "city", "ind_type",
                      F.concat("p", "klass", "s").alias("gather_type"),
                      F.col("gather_value").cast("bigint").alias("gather_value"))


def roaming_users_period(usage: DataFrame, users: DataFrame, home: str, period: Column,
                         unknown: str = UNKNOWN) -> DataFrame:
    """AN-11 (week / month form): distinct users of the home province per period,
    home city and industry, split into records seen at home (visited province =
    ``home``, LOCAL) and elsewhere (ROAMOUT); users only, no volumes.  Records are
    reduced to distinct (period, user, visited province) first."""
    seen = usage.select(period.alias("period"), "mdn", "prov").distinct()
    u = users.where(F.col("beloprov") == home).select("mdn", "beloprov", "belocity", "ind_type")
    j = seen.join(J.sized(u), "mdn").withColumn("regcity", F.coalesce("belocity", F.lit(unknown)))
    klass = F.when(F.col("prov") == F.lit(home), F.lit(LOCAL)).otherwise(F.lit(ROAMOUT))
    return (j.withColumn("klass", klass)
            .groupBy("period", F.col("beloprov").alias("regprovince"), "regcity", "ind_type",
                     F.concat(F.lit(USER_PREFIX), F.col("klass")).alias("gather_type"))
            .agg(F.count_distinct("mdn").alias("gather_value")))


def active_users_nday(usage: DataFrame, users: DataFrame, day_col: str, keys: Sequence[str],
                      n: int = 7, user_filter: Column | None = None) -> DataFrame:
    """AN-12: distinct users seen in the ``n`` days ending on each day, per key
    (network type, city...).

    A record counts for the window-end days from its own day to the day before the user's
    next record of the key, at most ``n`` (the next record counts from there on).  So a user
    is emitted once per end day and key, and a plain count of rows, added up map-side, is
    the distinct count: users are grouped once, and no set of (end day, user) is held."""
    u = users if user_filter is None else users.where(user_filter)
    seen = (usage.select("mdn", F.col(day_col).alias("day"), *[k for k in keys if k in usage.columns])
            .join(J.sized(u.select("mdn", *[k for k in keys if k not in usage.columns])), "mdn")
            .select("mdn", "day", *keys))
    following = F.lead("day").over(Window.partitionBy("mdn", *keys).orderBy("day"))
    last = F.date_add(F.col("day"), n - 1)
    last = F.least(last, F.date_sub(following, 1))  # of two records of one day the later one counts
    ends = (seen.withColumn("last", last).where(F.col("last") >= F.col("day"))
            .withColumn("end_day", F.explode(F.sequence(F.col("day"), F.col("last")))))
    return ends.groupBy("end_day", *keys).agg(F.count("mdn").alias("active_users"))


def gateway_reconciliation(records: DataFrame, gateways: dict[str, str], cycle: Column,
                           session_class: Column, volume_class: Column) -> DataFrame:
    """AN-13: per gateway (by address prefix) and record class: distinct users and
    distinct (user, session) pairs for the session class; distinct users and
    up / down / total volume for the volume class (records with any volume).

    Both classes come from one scan and one aggregation (conditional distinct
    counts and sums)."""
    gw = None
    for prefix, name in gateways.items():
        cond = F.col("gwaddress").startswith(prefix)
        gw = F.when(cond, F.lit(name)) if gw is None else gw.when(cond, F.lit(name))
    vol = volume_class & ((F.col("upflow") > 0) | (F.col("downflow") > 0))
    agg = (records.select(cycle.alias("sta_time"), gw.alias("pgw"), "mdn", "session_id", "upflow", "downflow",
                          session_class.alias("is_s"), vol.alias("is_v"))
           .where(F.col("pgw").isNotNull() & (F.col("is_s") | F.col("is_v")))
           .groupBy("sta_time", "pgw")
           .agg(F.count_distinct(F.when(F.col("is_s"), F.col("mdn"))).alias("s_users"),
                F.count_distinct(F.when(F.col("is_s"), F.col("mdn")), F.when(F.col("is_s"), F.col("session_id"))).alias("s_sessions"),
                F.count_distinct(F.when(F.col("is_v"), F.col("mdn"))).alias("v_users"),
                F.sum(F.when(F.col("is_v"), F.col("upflow"))).alias("v_up"),
                F.sum(F.when(F.col("is_v"), F.col("downflow"))).alias("v_down"),
                F.max(F.col("is_s").cast("int")).alias("has_s"), F.max(F.col("is_v").cast("int")).alias("has_v")))
    rows = agg.select("sta_time", "pgw", F.inline(F.array(
        F.struct(F.lit("SESSION").alias("checktype"), F.col("s_users").alias("usernum"),
                 F.col("s_sessions").alias("upflow"), F.lit(-1).cast("bigint").alias("downflow"),
                 F.lit(-1).cast("bigint").alias("totalflow"), F.col("has_s").alias("present")),
        F.struct(F.lit("VOLUME").alias("checktype"), F.col("v_users").alias("usernum"),
                 F.col("v_up").alias("upflow"), F.col("v_down").alias("downflow"),
                 (F.col("v_up") + F.col("v_down")).alias("totalflow"), F.col("has_v").alias("present")))))
    return rows.where(F.col("present") == 1).drop("present")


def customer_report(usage: DataFrame, users: DataFrame, cycle: Column,
                    nation_label: str = NATION, all_label: str = "-1") -> DataFrame:
    """AN-14: per customer × province × city: opened users (from the subscriber
    table), active users (distinct users with usage) and volume; with province
    totals, a national total and per-industry totals.

    Opened and active figures are each one grouping-sets aggregate (customer rows,
    province, nation, industry); activity rows drive the report and the opened
    counts are attached with a left join (null-safe on the level keys)."""
    sets = {"CUST": ["cycle", "custid", "beloprov", "belocity"], "PROV": ["cycle", "beloprov"],
            "NATION": ["cycle"], "INDUSTRY": ["cycle", "ind_type"]}
    active_rows = usage.select(cycle.alias("cycle"), "mdn", "upflow", "downflow").join(
        J.sized(users.select("mdn", "custid", "beloprov", "belocity", "ind_type")), "mdn")
    active = A.grouping_sets(active_rows, list(sets.values()), [
        F.count_distinct("mdn").alias("active_users"), F.sum("upflow").alias("upflow"),
        F.sum("downflow").alias("downflow")], "gid")
    active = active.withColumn("level", A.level_of("gid", list(sets.values()), sets)).drop("gid")
    opened_sets = {k: [c for c in v if c != "cycle"] for k, v in sets.items()}
    opened = A.grouping_sets(users, [s for s in opened_sets.values()],
                             [F.count_distinct("mdn").alias("opened_users")], "gid")
    opened = opened.withColumn("level", A.level_of("gid", list(opened_sets.values()), opened_sets)).drop("gid")
    keys = ["level", "custid", "beloprov", "belocity", "ind_type"]
    j = active.join(opened, [active[k].eqNullSafe(opened[k]) for k in keys], "left").select(
        "cycle", *[active[k] for k in keys], "opened_users", "active_users", "upflow", "downflow")
    label = lambda c, lv: F.when(F.col("level").isin(*lv), F.lit(all_label)).otherwise(F.col(c))
    return j.select("cycle", "level",
                    label("custid", ["PROV", "NATION", "INDUSTRY"]).alias("custid"),
                    F.when(F.col("level") == "NATION", F.lit(nation_label))
                    .otherwise(label("beloprov", ["INDUSTRY"])).alias("province"),
                    label("belocity", ["PROV", "NATION", "INDUSTRY"]).alias("city"),
                    F.coalesce("ind_type", F.lit(all_label)).alias("industry"),
                    F.coalesce("opened_users", F.lit(0)).alias("opened_users"), "active_users",
                    (F.col("upflow") + F.col("downflow")).alias("totalflow"))


def customer_report_by_type(usage: DataFrame, users: DataFrame, cycle: Column,
                            nation_label: str = NATION) -> DataFrame:
    """AN-14 (open types): per open type NB / 4G / 3G and customer × province × city: opened
    users, volume and active users; then province and national totals that add up the
    customer rows of the type.

    A user is opened for NB by its flag, for 4G if it may use 4G, and for 3G if it may use
    3G without 4G, or 2G, 3G and 4G all.  Customer rows exist where there was usage; one
    without opened users keeps a null there, as in the left join of the rule."""
    keys = ["opentype", "custid", "beloprov", "belocity"]
    u = users.select("mdn", "custid", "beloprov", "belocity", "isnb", "is2g", "is3g", "is4g")
    yes = lambda c: F.col(c) == "Y"
    types = F.filter(F.array(
        F.when(F.col("isnb") == "1", F.lit("NB")), F.when(yes("is4g"), F.lit("4G")),
        F.when((yes("is3g") & (F.col("is4g") == "N")) | (yes("is2g") & yes("is3g") & yes("is4g")), F.lit("3G"))),
        lambda t: t.isNotNull())
    opened = u.withColumn("opentype", F.explode(types)).groupBy(*keys).agg(F.count(F.lit(1)).alias("opened"))
    active = (usage.select(cycle.alias("cycle"), "mdn", "opentype", "upflow", "downflow")
              .join(J.sized(u.select("mdn", "custid", "beloprov", "belocity")), "mdn")
              .groupBy("cycle", *keys).agg(F.sum("upflow").alias("inflow"), F.sum("downflow").alias("outflow"),
                                           F.count_distinct("mdn").alias("active")))
    rows = active.join(opened, keys, "left")
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("opened", "active", "inflow", "outflow")]
    sets = {"CUST": ["cycle", *keys], "PROV": ["cycle", "opentype", "beloprov"], "NATION": ["cycle", "opentype"]}
    out = A.grouping_sets(rows, list(sets.values()), sums, "gid")
    level = A.level_of("gid", list(sets.values()), sets)
    return out.select("cycle", level.alias("level"), "opentype", "custid",
                      F.when(level == "NATION", F.lit(nation_label)).otherwise(F.col("beloprov")).alias("province"),
                      F.col("belocity").alias("city"), "opened", "active", "inflow", "outflow")


# Administrative words removed from province / city names.
PROVINCE_WORDS = ["省", "市", "壮族", "自治区", "维吾尔", "回族"]
CITY_WORDS = ["电信"]


def province_access(usage: DataFrame, users: DataFrame, stations: DataFrame, cycle: Column,
                    net_label: str) -> DataFrame:
    """AN-33: registered province / city / industry × visited province / city:
    up / down / total volume, active users, duration and times (distinct sessions).
    Names are cleaned of administrative words (PRJ-14)."""
    u = users.select("mdn", F.col("beloprov").alias("own_provid"), F.col("belocity").alias("own_lanid"),
                     F.col("ind_type").alias("industry_level1"))
    b = stations.select("enbid", F.col("provname").alias("prov"), F.col("cityname").alias("lanid"))
    j = usage.withColumn("cycle", cycle).join(J.sized(u), "mdn").join(J.sized(b), ["enbid", "prov"], "left")
    agg = j.groupBy("cycle", "own_provid", "own_lanid", "industry_level1", F.col("prov").alias("provid"), "lanid").agg(
        F.sum("upflow").alias("upflow"), F.sum("downflow").alias("downflow"),
        F.count_distinct("mdn").alias("activeusers"), F.sum("duration").alias("duration"),
        F.count_distinct("session_id").alias("times"))
    return agg.select("cycle", C.strip_words("own_provid", PROVINCE_WORDS).alias("own_provid"),
                      C.strip_words("own_lanid", CITY_WORDS).alias("own_lanid"), "industry_level1",
                      "provid", "lanid", "upflow", "downflow",
                      (F.col("upflow") + F.col("downflow")).alias("totalflow"), "activeusers", "duration",
                      "times", F.lit(net_label).alias("nettype"))


def interphone_cell_usage(usage: DataFrame, numbers: DataFrame, cycle: Column) -> DataFrame:
    """AN-40: for the numbers of a list (left-semi join, JN-11): accesses, distinct
    users, duration and volume per station and cell."""
    mine = J.semi(usage, numbers.select("mdn"), "mdn")
    return mine.groupBy(cycle.alias("cycle"), "enbid", "cellid").agg(
        F.count(F.lit(1)).alias("accesses"), F.count_distinct("mdn").alias("users"),
        F.sum("duration").alias("duration"), F.sum("upflow").alias("upflow"),
        F.sum("downflow").alias("downflow"))


def pool_status(users: DataFrame, customer: str = "custid", product: str = "companycode") -> DataFrame:
    """AN-41: users per (customer, product), ranked per customer by users (desc)."""
    per = users.groupBy(customer, product).agg(F.count(F.lit(1)).alias("usernum"))
    return W.rank_within(per, [customer], ["usernum"], "rank", ascending=False, tiebreak=[product])


def region_kpi(gw: DataFrame, mme: DataFrame, stations: DataFrame, grain: str,
               attach: Column, tau: Column) -> DataFrame:
    """AN-43: per time grain (hour ``yyyyMMddHH`` / day / month format) and province /
    city: distinct online users and volume in GB (PRJ-24) from the gateway records,
    failed attach and failed tracking-area-update counts from the signalling log;
    the two aggregates are merged by a full outer join (JN-8)."""
    b = stations.select("enbid", F.col("provname").alias("prov"), F.col("cityname").alias("city"))
    g = (gw.join(J.sized(b), "enbid", "left").groupBy(F.date_format("starttime", grain).alias("period"), "prov", "city")
         .agg(F.count_distinct("mdn").alias("online_users"),
              C.bytes_to_gb(F.sum(F.col("upflow") + F.col("downflow"))).alias("flow_gb")))
    m = (mme.where(F.col("result") == "failed").join(J.sized(b), "enbid", "left")
         .groupBy(F.date_format("starttime", grain).alias("period"), "prov", "city")
         .agg(A.count_if(attach).alias("attach_fail"), A.count_if(tau).alias("tau_fail")))
    keys = ["period", "prov", "city"]
    m = m.select(*[F.col(k).alias(f"m_{k}") for k in keys], "attach_fail", "tau_fail")
    j = g.join(m, [F.col(k).eqNullSafe(F.col(f"m_{k}")) for k in keys], "full")
    return j.select(*[F.coalesce(F.col(k), F.col(f"m_{k}")).alias(k) for k in keys],
                    F.coalesce("online_users", F.lit(0)).alias("online_users"),
                    F.coalesce("flow_gb", F.lit(0.0)).alias("flow_gb"),
                    F.coalesce("attach_fail", F.lit(0)).alias("attach_fail"),
                    F.coalesce("tau_fail", F.lit(0)).alias("tau_fail"))


def failure_causes_by_area(mme: DataFrame, stations: DataFrame, grain: str,
                           items: dict[str, Column]) -> DataFrame:
    """AN-43 (cause part): failed procedures per period, province, city, item (e.g.
    attach / tau, each a predicate on the procedure) and cause code."""
    b = stations.select("enbid", F.col("provname").alias("prov"), F.col("cityname").alias("city"))
    item = None
    for name, cond in items.items():
        item = F.when(cond, F.lit(name)) if item is None else item.when(cond, F.lit(name))
    f = mme.where(F.col("result") == "failed").withColumn("itemcode", item).where(F.col("itemcode").isNotNull())
    return (f.join(J.sized(b), "enbid", "left")
            .groupBy(F.date_format("starttime", grain).alias("period"), "prov", "city", "itemcode",
                     F.col("cause").alias("reasoncode"))
            .agg(F.count(F.lit(1)).alias("itemvalue")))


def auth_by_gateway(auth: DataFrame, ip_map: DataFrame, users: DataFrame, cycle: Column) -> DataFrame:
    """AN-44: per customer × gateway province × gateway IP: attempts, distinct users
    and success ratio (PRJ-25).  Users inner-joined; the IP map is a dimension
    (Spark's size-checked join choice)."""
    j = auth.join(J.sized(users.select("mdn", "custid")), "mdn").join(J.sized(ip_map), "pdsnip")
    agg = j.groupBy(cycle.alias("cycle"), "custid", "prov", "pdsnip").agg(
        F.count(F.lit(1)).alias("req_cnt"), F.count_distinct("mdn").alias("users"),
        A.count_if(F.col("result") == "success").alias("succ_cnt"))
    return agg.withColumn("succ_ratio", C.safe_ratio("succ_cnt", "req_cnt"))


def session_count(usage: DataFrame, classes: Sequence[str], class_col: str = "net",
                  key: str = "prov") -> DataFrame:
    """AN-45: distinct (user, session) pairs per province over the starting or
    complete records (AG-3, FLT-3)."""
    return usage.where(F.col(class_col).isin(*classes)).groupBy(key).agg(
        F.count_distinct("mdn", "session_id").alias("sessions"))


def levels_long(usage: DataFrame, levels: Sequence[str], cycle: Column) -> DataFrame:
    """AN-52: day measures at every depth of a dimension path (null for the absent
    deeper levels).  The reference emitted each depth without re-aggregating (so
    coarse keys repeated); here it is a real ``rollup``, one row per key and depth,
    with the depth in ``level``.

    Distinct users: with a user's records in the order of the path, the first record of
    each key is marked at its depth and the marks are added up, so the rollup shuffles
    sums per key and no copy of every user per depth."""
    levels = list(levels)
    rows = usage.select(cycle.alias("cycle"), *levels, "mdn", "upflow", "downflow").where(F.col("cycle").isNotNull())
    rows = A.mark_first(rows, ["mdn", "cycle"], levels, "first_")
    marks = [f"first_{k}" for k in range(len(levels) + 1)]
    agg = A.rollup(rows, ["cycle", *levels], [
        F.sum("upflow").alias("upflow"), F.sum("downflow").alias("downflow"),
        *[F.sum(m).alias(m) for m in marks]], id_col="gid")
    agg = agg.where(F.col("cycle").isNotNull()).withColumn(
        "level", (len(levels) - F.bit_count(F.col("gid"))).cast("int"))
    users = F.element_at(F.array(*marks), F.col("level") + 1)
    return agg.select("cycle", *levels, "upflow", "downflow", users.alias("users"), "level")
