"""DuckDB SQL for the stand-in inputs of :mod:`usagelens.plans.inputs`.

The oracle queries in :mod:`usagelens.plans.catalog` start from these CTEs so both
sides read the same rows.  Each CTE mirrors one function of ``inputs`` column for
column; keep the two in step.  ``day_usage`` / ``day_usage_d`` are the oracle of the
per-user daily aggregate (AN-38, yearly and daily cycle), reused as the input of the
operators that consume that table.
"""

from __future__ import annotations

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "geo": ("""SELECT n.n_nationkey AS city_id, n.n_name AS city, r.r_regionkey AS prov_id,
                      r.r_name AS prov
               FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""", ()),
    "usage_rec": ("""SELECT o.o_custkey AS mdn, l.l_orderkey AS session_id, l.l_suppkey AS enbid,
                      CAST(l.l_linenumber AS VARCHAR) AS cellid, l.l_partkey AS tac,
                      l.l_returnflag AS net, 'd' || CAST(l.l_partkey % 7 AS VARCHAR) AS nai_domain,
                      '10.0.' || CAST(l.l_suppkey % 4 AS VARCHAR) || '.' || CAST(l.l_linenumber AS VARCHAR) AS gwaddress,
                      CAST(round(l.l_quantity) AS BIGINT) AS upflow,
                      CAST(round(l.l_extendedprice * 100) AS BIGINT) AS downflow,
                      CAST(round(l.l_discount * 100) AS BIGINT) AS duration,
                      l.l_shipdate AS starttime, CAST(l.l_shipdate AS DATE) AS d
               FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""", ()),
    "located_usage": ("""SELECT u.*, g.prov FROM usage_rec u
               JOIN customer c ON u.mdn = c.c_custkey
               JOIN geo g ON c.c_nationkey = g.city_id""", ("usage_rec", "geo")),
    "users": ("""SELECT c.c_custkey AS mdn, c.c_mktsegment AS custid,
                      'C' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS companycode,
                      g.prov AS beloprov, g.city AS belocity, c.c_mktsegment AS ind_type,
                      CASE WHEN c.c_acctbal >= 0 THEN '1' ELSE '0' END AS isnb,
                      CASE WHEN c.c_acctbal < 2000 THEN '1' ELSE '0' END AS isdirect,
                      CASE WHEN c.c_acctbal >= 1000 AND c.c_acctbal < 6000 THEN '1' ELSE '0' END AS isvpdn,
                      CASE WHEN c.c_acctbal >= 5000 AND c.c_acctbal < 9000 THEN '1' ELSE '0' END AS iscommon,
                      'd' || CAST(c.c_custkey % 3 AS VARCHAR) || ',' || 'd' || CAST(c.c_custkey % 5 + 2 AS VARCHAR) AS vpdndomain,
                      lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') || '0000000' AS imei,
                      CASE WHEN c.c_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS is2g,
                      CASE WHEN c.c_custkey % 3 <> 0 THEN 'Y' ELSE 'N' END AS is3g,
                      CASE WHEN c.c_custkey % 5 < 3 THEN 'Y' ELSE 'N' END AS is4g,
                      c.c_name AS username,
                      CAST(round(c.c_acctbal * 100) AS BIGINT) AS acctbal
               FROM customer c JOIN geo g ON c.c_nationkey = g.city_id""", ("geo",)),
    "companies": ("""SELECT 'C' || lpad(CAST(city_id AS VARCHAR), 2, '0') AS companycode,
                      CASE WHEN prov_id <> 0 THEN prov END AS provincecode FROM geo""", ("geo",)),
    "typed_usage": ("""SELECT *, CASE net WHEN 'N' THEN 'NB' WHEN 'R' THEN '4G' ELSE '3G' END AS opentype
               FROM usage_rec""", ("usage_rec",)),
    "stations": ("""SELECT s.s_suppkey AS enbid, g.prov AS provname, g.city AS cityname,
                      g.prov_id AS provid, g.city_id AS cityid, s.s_name AS stationname
               FROM supplier s JOIN geo g ON s.s_nationkey = g.city_id""", ("geo",)),
    "devices": ("""SELECT p_partkey AS tac, p_name AS modelname, p_brand AS manufacturer,
                      p_type AS devicetype FROM part""", ()),
    "signalling": ("""SELECT event_id, user_id AS mdn, ts AS starttime,
                      ['attach', 'tau', 'detach', 'auth', 'paging'][CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 + 1]
                        AS procedure,
                      CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS result,
                      json_extract_string(props, '$.k') AS cause, (event_id * 7919) % (SELECT max(s_suppkey) + 1 FROM supplier) AS enbid,
                      CAST(round(value * 100) AS BIGINT) AS delay,
                      CAST(user_id AS VARCHAR) || '@d' || CAST(event_id % 7 AS VARCHAR) AS nai,
                      CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 2 = 0 THEN '3g' ELSE '4g' END AS net,
                      '10.1.' || CAST((event_id * 7919) % (SELECT max(s_suppkey) + 1 FROM supplier) AS VARCHAR) AS pdsnip
               FROM events""", ()),
    "station_slots": ("""SELECT l.starttime AS time, u.companycode || CASE WHEN u.isvpdn = '1' THEN '_C_-1' ELSE '_P_-1' END AS csd,
                      l.net AS nettype,
                      CASE WHEN l.net = '3g' THEN lpad(to_base(l.enbid, 36), 4, '0') || CAST(l.event_id % 10 AS VARCHAR)
                           ELSE CAST(l.enbid AS VARCHAR) END AS enbid,
                      CAST(l.procedure = 'attach' AND l.result = 'success' AS BIGINT) AS ma_sn,
                      CAST(l.procedure = 'attach' AS BIGINT) AS ma_rn,
                      CAST(l.procedure = 'auth' AND l.result = 'success' AS BIGINT) AS a_sn,
                      CAST(l.procedure = 'auth' AS BIGINT) AS a_rn,
                      CASE WHEN l.procedure = 'tau' THEN l.delay ELSE 0 END AS f_d,
                      CASE WHEN l.procedure = 'paging' THEN l.delay ELSE 0 END AS f_u,
                      CAST(l.procedure = 'detach' AS BIGINT) AS o_ln,
                      CAST(l.procedure = 'detach' AND l.result <> 'success' AS BIGINT) AS o_fln
               FROM signalling l JOIN users u ON l.mdn = u.mdn""", ("signalling", "users")),
    "session_events": ("""SELECT event_id, user_id AS mdn, CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
                      CASE WHEN event_type = 'signup' THEN 'Start'
                           WHEN event_type = 'purchase' THEN 'Stop' ELSE 'Interim' END AS status,
                      ts AS time, json_extract_string(props, '$.k') AS cause,
                      (event_id * 7919) % (SELECT max(s_suppkey) + 1 FROM supplier) AS enbid,
                      CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 2 = 0 THEN '3g' ELSE '4g' END AS net,
                      CAST(round(value * 100) AS BIGINT) AS octets
               FROM events""", ()),
    "messages": ("""SELECT event_id, user_id AS caller, (event_id * 7919) % (SELECT max(c_custkey) + 1 FROM customer) AS callee, ts AS committime,
                      CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS result
               FROM events""", ()),
    "day_usage": ("""SELECT CAST(year(n.starttime) AS VARCHAR) AS cycle, u.custid, n.mdn, n.enbid,
                      CASE WHEN b.enbid IS NOT NULL THEN n.prov END AS provid,
                      coalesce(b.cityname, '-') AS lanid, n.cellid AS eci, n.nai_domain AS apn, n.tac,
                      u.beloprov AS own_provid, u.belocity AS own_lanid,
                      CAST(sum(n.upflow) AS BIGINT) AS upflow, CAST(sum(n.downflow) AS BIGINT) AS downflow,
                      count(n.mdn) AS sessions, CAST(sum(n.duration) AS BIGINT) AS duration,
                      count(DISTINCT n.session_id) AS times
               FROM located_usage n JOIN users u ON n.mdn = u.mdn
               LEFT JOIN stations b ON n.enbid = b.enbid AND n.prov = b.provname
               WHERE u.isnb = '1'
               GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11""", ("located_usage", "users", "stations")),
    "day_usage_d": ("""SELECT CAST(n.d AS VARCHAR) AS cycle, u.custid, n.mdn, n.enbid,
                      CASE WHEN b.enbid IS NOT NULL THEN n.prov END AS provid,
                      coalesce(b.cityname, '-') AS lanid, n.cellid AS eci, n.nai_domain AS apn, n.tac,
                      u.beloprov AS own_provid, u.belocity AS own_lanid,
                      CAST(sum(n.upflow) AS BIGINT) AS upflow, CAST(sum(n.downflow) AS BIGINT) AS downflow,
                      count(n.mdn) AS sessions, CAST(sum(n.duration) AS BIGINT) AS duration,
                      count(DISTINCT n.session_id) AS times
               FROM located_usage n JOIN users u ON n.mdn = u.mdn
               LEFT JOIN stations b ON n.enbid = b.enbid AND n.prov = b.provname
               WHERE u.isnb = '1'
               GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11""", ("located_usage", "users", "stations")),
    "classes": ("""SELECT CASE net WHEN 'A' THEN 'vpdn3g' WHEN 'N' THEN 'ha3g' ELSE 'pgw4g' END AS klass,
                      mdn, enbid AS bsid, upflow, downflow, starttime,
                      CAST(mdn AS VARCHAR) || '@' || nai_domain AS nai, 'apn.' || nai_domain AS apn
               FROM usage_rec WHERE net IN ('A', 'N', 'R')""", ("usage_rec",)),
    "apn_map": ("""SELECT DISTINCT 'd' || CAST(p_partkey % 7 AS VARCHAR) AS vpdndomain,
                      'apn.d' || CAST(p_partkey % 7 AS VARCHAR) AS apn FROM part""", ()),
    "operation_log": ("""SELECT CAST(e.user_id AS VARCHAR) AS mdn,
                      CASE WHEN e.event_id % 2 = 0 THEN 'HLR' ELSE 'HSS' END AS logtype,
                      CASE WHEN e.event_type = 'signup' THEN 'open' WHEN e.event_type = 'purchase' THEN 'close'
                           ELSE 'query' END AS opername,
                      CASE WHEN e.value >= 1.0 THEN 'success' ELSE 'fail' END AS oper_result,
                      g.prov AS custprovince, 'C' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS vpdncompanycode,
                      e.ts AS opertime
               FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN geo g ON c.c_nationkey = g.city_id""",
                      ("geo",)),
    "raw_event_log": ("""SELECT CAST(event_id AS VARCHAR) AS T0, CAST(user_id AS VARCHAR) AS T1,
                      strftime(ts, '%Y-%m-%d %H:%M:%S') AS T2, event_type AS T3,
                      CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS T4 FROM events""", ()),
    "gateway_ips": ("""SELECT '10.1.' || CAST(enbid AS VARCHAR) AS pdsnip, provname AS prov FROM stations""",
                    ("stations",)),
    "raw_mme_log": ("""SELECT v.vendor, CAST(e.user_id AS VARCHAR) AS T0, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS T1,
                      CASE WHEN e.event_type IN ('signup', 'view')
                           THEN CASE v.vendor WHEN 'huawei' THEN '0x00' WHEN 'zte' THEN '2101' ELSE 'attach' END
                           ELSE 'other' END AS T8,
                      CASE WHEN v.vendor = 'huawei' THEN '0x' || upper(hex(v.station))
                           ELSE CAST(v.station AS VARCHAR) END AS T12,
                      CASE WHEN e.event_type = 'error' THEN 'e' || json_extract_string(e.props, '$.k')
                           ELSE CASE v.vendor WHEN 'huawei' THEN '0x0000' WHEN 'zte' THEN '4294967295'
                                              ELSE 'nocausecode' END END AS T13
               FROM events e, (SELECT max(s_suppkey) + 1 AS n FROM supplier) st, LATERAL (SELECT ['huawei', 'zte', 'ericsson'][e.event_id % 3 + 1] AS vendor,
                      (e.event_id * 7919) % st.n AS station) v""", ()),
}


def with_inputs(*names: str) -> str:
    """``WITH`` clause defining the named stand-in CTEs (and what they depend on)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in _CTES[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][0]})" for n in order)


def with_ctes(inputs: tuple[str, ...], ctes: dict[str, str]) -> str:
    """``WITH`` clause of the stand-in CTEs followed by the query's own CTEs."""
    parts = []
    if inputs:
        parts.append(with_inputs(*inputs)[len("WITH "):])
    parts += [f"{name} AS ({q})" for name, q in ctes.items()]
    return ("WITH " + ",\n".join(parts)) if parts else ""
