"""Normalisation of raw records, and the reports over authentication stations and terminals
(AN-46, JN-16, AN-21, AN-32)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dimensions as D
from ..operators import formats as FM
from ..operators import multidim as M
from . import inputs as I
from . import raw_inputs as RAW
from .catalog import _day, oracle, register

_AT = "starttime + to_seconds(session_id % 86400)"
_SLOTS = """strftime({t}, '%y%m%d') AS d, strftime({t}, '%H') AS h,
       lpad(CAST(minute({t}) // 5 * 5 AS VARCHAR), 2, '0') AS m5"""
_ACCOUNTING = ["mdn_2", "mdn", "nai", "account_session_id", "pdsn_address", "bsid", "event_time", "acct_session_time",
               "acct_input_packets", "acct_output_packets", "cellid", "roamflag", "d", "h", "m5"]


def _accounting_sql(net: str) -> str:
    return oracle(("usage_rec",), rec=f"SELECT *, {_AT} AS moment, CAST(mdn AS VARCHAR) AS num FROM usage_rec WHERE net = '{net}'",
                  body=f"""
SELECT num AS mdn_2, num AS mdn, num || '@' || nai_domain AS nai, CAST(session_id AS VARCHAR) AS account_session_id,
       gwaddress AS pdsn_address, printf('%X', enbid) AS bsid, strftime(moment, '%Y-%m-%d %H:%M:%S') AS event_time,
       CAST(duration AS VARCHAR) AS acct_session_time, CAST(upflow AS VARCHAR) AS acct_input_packets,
       CAST(downflow AS VARCHAR) AS acct_output_packets, cellid, CAST(NULL AS VARCHAR) AS roamflag,
       {_SLOTS.format(t="moment")}
FROM rec""")


@register("normalize_cdr_pdsn", _accounting_sql("A"))
def q_normalize_cdr_pdsn(spark, sf_dir):
    return FM.normalize_cdr(RAW.raw_cdr(spark, sf_dir, "pdsn"), "pdsn").select(*_ACCOUNTING)


@register("normalize_cdr_haccg", _accounting_sql("N"))
def q_normalize_cdr_haccg(spark, sf_dir):
    return FM.normalize_cdr(RAW.raw_cdr(spark, sf_dir, "haccg"), "haccg").select(*_ACCOUNTING)


@register("normalize_cdr_pgw", oracle(
    ("usage_rec",), rec=f"SELECT *, {_AT} AS moment, CAST(mdn AS VARCHAR) AS num FROM usage_rec WHERE net = 'R' AND upflow > 3",
    body=f"""
SELECT '46003' || num AS imsi, num AS mdn, CAST(session_id AS VARCHAR) AS chargingid, 'apn.' || nai_domain AS accesspointnameni,
       CAST(enbid AS VARCHAR) AS bsid, CAST(enbid AS VARCHAR) AS enbid,
       strftime(moment, '%Y-%m-%d %H:%M:%S') AS l_timeoflastusage, CAST(upflow AS VARCHAR) AS l_datavolumefbcuplink,
       CAST(downflow AS VARCHAR) AS l_datavolumefbcdownlink, CAST(NULL AS VARCHAR) AS stoptime, {_SLOTS.format(t="moment")}
FROM rec"""))
def q_normalize_cdr_pgw(spark, sf_dir):
    return FM.normalize_cdr(RAW.raw_cdr(spark, sf_dir, "pgw"), "pgw").select(
        "imsi", "mdn", "chargingid", "accesspointnameni", "bsid", "enbid", "l_timeoflastusage", "l_datavolumefbcuplink",
        "l_datavolumefbcdownlink", "stoptime", "d", "h", "m5")


def _auth_sql(klass: str, own: str) -> str:
    good = "1" if klass == "vpdn" else "0"
    return f"""
SELECT CASE WHEN event_type = 'error' THEN json_extract_string(props, '$.k') ELSE '{good}' END AS auth_result,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS auth_time, CAST(NULL AS VARCHAR) AS device,
       '46003' || CAST(user_id AS VARCHAR) AS imsicdma, CAST(NULL AS VARCHAR) AS imsilte, CAST(user_id AS VARCHAR) AS mdn,
       CAST(user_id AS VARCHAR) || '@d' || CAST(event_id % 7 AS VARCHAR) AS nai_sercode, {own},
       strftime(ts, '%y%m%d') AS d, strftime(ts, '%H') AS h, CAST(minute(ts) // 5 * 5 AS VARCHAR) AS m5,
       CASE WHEN event_type <> 'error' OR json_extract_string(props, '$.k') = '{good}' THEN 'success' ELSE 'failed' END AS result
FROM events WHERE event_id % 3 = {RAW.AUTH_CLASSES.index(klass)}"""


_NAS = """CAST(NULL AS VARCHAR) AS nasport, CAST(NULL AS VARCHAR) AS nasportid, CAST(NULL AS VARCHAR) AS nasporttype,
       '10.2.' || CAST(event_id % 9 AS VARCHAR) AS pcfip"""


@register("normalize_auth_3g", _auth_sql("3g", _NAS + ", CAST(NULL AS VARCHAR) AS srcip"))
def q_normalize_auth_3g(spark, sf_dir):
    return FM.normalize_auth(RAW.raw_auth(spark, sf_dir, "3g"), "3g")


@register("normalize_auth_4g", _auth_sql("4g", _NAS))
def q_normalize_auth_4g(spark, sf_dir):
    return FM.normalize_auth(RAW.raw_auth(spark, sf_dir, "4g"), "4g")


@register("normalize_auth_vpdn", _auth_sql("vpdn", """'ent' || CAST(user_id % 5 AS VARCHAR) AS entname,
       CAST(NULL AS VARCHAR) AS lnsip, CAST(NULL AS VARCHAR) AS pdsnip"""))
def q_normalize_auth_vpdn(spark, sf_dir):
    return FM.normalize_auth(RAW.raw_auth(spark, sf_dir, "vpdn"), "vpdn")


_EPC_CTES = dict(
    section="""
  SELECT sectionno, prov AS atrb_pr, prov AS user_pr, city AS user_city,
         CASE WHEN block % 5 = 0 THEN 'IOT' ELSE 'CDMA' END AS network
  FROM (SELECT DISTINCT c_custkey // 100 AS block,
               substr('86' || lpad(CAST(c_custkey // 100 * 100 AS VARCHAR), 9, '0'), 1, 9) AS sectionno FROM customer) s
  JOIN geo ON block % 25 = city_id WHERE block % 4 <> 3""",
    rec=f"""
  SELECT *, {_AT} AS moment, '86' || lpad(CAST(mdn AS VARCHAR), 9, '0') AS num, '46003' || CAST(mdn AS VARCHAR) AS imsi,
         CASE WHEN duration > 0 THEN duration * 60 END AS secs FROM usage_rec""")
_HOME = """CASE WHEN s.network = 'IOT' THEN '物联网' ELSE s.atrb_pr END AS mdnprovince, s.user_pr, s.user_city, s.network"""


@register("normalize_epc_sgw", oracle(("usage_rec", "geo"), **_EPC_CTES, body=f"""
SELECT substr(num, 1, 9) AS mdnsection, num AS mdn, imsi, net AS changetime,
       strftime(moment, '%Y-%m-%d %H:%M:%S') AS starttime, CAST(secs AS VARCHAR) AS duration, CAST(NULL AS VARCHAR) AS t800,
       CAST(enbid AS VARCHAR) AS bsid, strftime(moment + to_seconds(secs), '%Y-%m-%d %H:%M:%S') AS stoptime,
       {_SLOTS.format(t="(moment + to_seconds(secs))")}, {_HOME}
FROM rec LEFT JOIN section s ON substr(num, 1, 9) = s.sectionno"""))
def q_normalize_epc_sgw(spark, sf_dir):
    return FM.normalize_epc(RAW.raw_epc(spark, sf_dir, "sgw"), RAW.number_sections(spark, sf_dir), "sgw")


@register("normalize_epc_pgw", oracle(("usage_rec", "geo"), **_EPC_CTES, body=f"""
SELECT substr(num, 1, 9) AS mdnsection, num AS mdn, imsi, CAST(NULL AS VARCHAR) AS servedimeisv,
       CAST(NULL AS VARCHAR) AS servedmsisdn, CAST(NULL AS VARCHAR) AS servingnodeaddress, net AS rattype,
       CAST(NULL AS VARCHAR) AS l_ratinggroup, CAST(NULL AS VARCHAR) AS l_timeoffirstusage,
       strftime(moment, '%Y-%m-%d %H:%M:%S') AS l_timeoflastusage, CAST(upflow AS VARCHAR) AS l_datavolumefbcuplink,
       CAST(downflow AS VARCHAR) AS l_datavolumefbcdownlink, CAST(enbid AS VARCHAR) AS enodebid,
       CAST(NULL AS VARCHAR) AS t800, strftime(moment + to_seconds(secs), '%Y-%m-%d %H:%M:%S') AS stoptime,
       {_SLOTS.format(t="moment")}, {_HOME}
FROM rec LEFT JOIN section s ON substr(num, 1, 9) = s.sectionno"""))
def q_normalize_epc_pgw(spark, sf_dir):
    return FM.normalize_epc(RAW.raw_epc(spark, sf_dir, "pgw"), RAW.number_sections(spark, sf_dir), "pgw")


# --- AN-21: stations ---------------------------------------------------------------------
@register("auth_stations", oracle(
    ("signalling", "users"),
    rec="""
  SELECT strftime(a.starttime, '%Y%m%d') AS cycle, a.mdn, a.result, CAST(a.enbid AS VARCHAR) AS bsid, u.companycode,
         regexp_extract(a.nai, '@(.*)$', 1) AS dom, u.isdirect, u.isvpdn, u.vpdndomain
  FROM signalling a JOIN users u ON a.mdn = u.mdn WHERE a.procedure = 'auth' AND a.net = '3g'""",
    served="""
  SELECT *, CASE WHEN isdirect = '1' THEN 'D'
                 WHEN isvpdn = '1' AND list_contains(string_split(vpdndomain, ','), dom) THEN 'C' ELSE 'P' END AS servtype
  FROM rec""",
    tagged="""
  SELECT cycle, companycode, servtype, '-1' AS vpdndomain, bsid, mdn, result FROM served
  UNION ALL SELECT cycle, companycode, servtype, dom, bsid, mdn, result FROM served WHERE servtype = 'C'""",
    body="""
SELECT cycle, companycode, servtype, vpdndomain, coalesce(bsid, '0') AS bsid, count(*) AS rn,
       count(CASE WHEN result <> 'success' THEN 1 END) AS rfn, count(CASE WHEN result = 'success' THEN 1 END) AS rsn,
       count(DISTINCT mdn) AS req_card_cnt, count(DISTINCT CASE WHEN result <> 'success' THEN mdn END) AS req_card_fcnt,
       count(DISTINCT CASE WHEN result = 'success' THEN mdn END) AS req_card_scnt
FROM tagged GROUP BY 1, 2, 3, 4, 5"""))
def q_auth_stations(spark, sf_dir):
    log = I.signalling(spark, sf_dir).where(F.col("procedure") == "auth")
    return M.auth_stations(log, I.users(spark, sf_dir), _day("starttime"))


# --- AN-32: users, terminals, abnormal terminals -------------------------------------------
@register("user_terminal_counts", oracle(
    ("users", "devices"),
    u="""
  SELECT u.companycode, u.isvpdn, u.isdirect, u.iscommon, u.vpdndomain, length(u.imei) > 0 AS has,
         CASE d.devicetype WHEN 'SMALL' THEN true WHEN 'PROMO' THEN true ELSE false END AS odd
  FROM users u LEFT JOIN devices d ON substr(u.imei, 1, 8) = lpad(CAST(d.tac AS VARCHAR), 8, '0')""",
    tagged="""
  SELECT companycode, '-1' AS servtype, '-1' AS vpdndomain, has, odd FROM u
  UNION ALL SELECT companycode, 'D', '-1', has, odd FROM u WHERE isdirect = '1'
  UNION ALL SELECT companycode, 'P', '-1', has, odd FROM u WHERE iscommon = '1'
  UNION ALL SELECT companycode, 'C', '-1', has, odd FROM u WHERE isvpdn = '1'
  UNION ALL SELECT companycode, 'C', unnest(string_split(vpdndomain, ',')), has, odd FROM u WHERE isvpdn = '1'""",
    body="""
SELECT companycode, servtype, vpdndomain, count(*) AS usrcnt, count(CASE WHEN has THEN 1 END) AS tercnt,
       count(CASE WHEN odd THEN 1 END) AS abnormalcnt
FROM tagged GROUP BY 1, 2, 3"""))
def q_user_terminal_counts(spark, sf_dir):
    return D.user_terminal_counts(I.users(spark, sf_dir), I.devices(spark, sf_dir), ["SMALL", "PROMO"])
