"""Record formats: names of positions, slots, missing fields, damaged texts, number sections."""

import pytest

from usagelens.operators import formats as FM


def one(df):
    return df.first().asDict()


def test_positions_of_a_record():
    assert len(FM.ACCOUNTING) == 67 and len(FM.GATEWAY) == 58
    pdsn, haccg, pgw = (FM.CDR_FIELDS[k] for k in ("pdsn", "haccg", "pgw"))
    assert (pdsn["T0"], pdsn["T37"], pdsn["T59"], pdsn["T66"], pdsn["T809"]) == (
        "streamnumber", "event_time", "session_id", "pcf_ipv6_address", "enterprise_name")
    assert "T66" not in haccg and haccg == {k: v for k, v in pdsn.items() if k != "T66"}
    assert (pgw["T46"], pgw["T28"], pgw["T57"], pgw["T804"]) == (
        "l_timeoflastusage", "userlocationinformation", "sc_changetime", "enbid")
    assert "T17" not in pgw and "T803" not in pgw
    for fields in (pdsn, haccg, pgw):
        assert len(set(fields.values())) == len(fields)


@pytest.mark.parametrize("klass", ["pdsn", "haccg"])
def test_accounting_records(spark, klass):
    raw = spark.createDataFrame([("1", 7, "2024-02-09 23:58:01"), ("2", 8, None), ("3", 9, "bad")],
                                "mdn string, t12 int, T37 string")
    got = {r.mdn_2: r for r in FM.normalize_cdr(raw, klass).collect()}
    r = got["1"]
    assert (r.account_session_id, r.event_time, r.d, r.h, r.m5, r.nai) == (
        "7", "2024-02-09 23:58:01", "240209", "23", "55", None)
    assert (got["2"].d, got["2"].m5) == (None, None) and got["3"].m5 is None
    assert ("pcf_ipv6_address" in r.asDict()) == (klass == "pdsn")


def test_gateway_records_need_a_last_usage(spark):
    raw = spark.createDataFrame([("1", "x;eNodeBId=4711;y", "2024-02-09 03:04:59", 5), ("2", "none", "2024-02-09 03:10:00", 6),
                                 ("3", "eNodeBId=1", None, 7)], "MDN string, T28 string, T46 string, T50 int")
    got = {r.mdn: (r.bsid, r.l_datavolumefbcuplink, r.h, r.m5) for r in FM.normalize_cdr(raw, "pgw").collect()}
    assert got == {"1": ("4711", "5", "03", "00"), "2": ("", "6", "03", "10")}


def test_auth_logs(spark):
    raw = spark.createDataFrame([("0", "2024-02-09 03:04:59", "1"), ("1", "2024-02-09 03:59:59", "2"),
                                 (None, None, "3")], "auth_result string, AUTH_TIME string, mdn string")
    results = {k: [r.result for r in FM.normalize_auth(raw, k).orderBy("mdn").collect()] for k in ("3g", "4g", "vpdn")}
    assert results == {"3g": ["success", "failed", "failed"], "4g": ["success", "failed", "failed"],
                       "vpdn": ["failed", "success", "failed"]}
    assert [r.m5 for r in FM.normalize_auth(raw, "4g").orderBy("mdn").collect()] == ["0", "55", None]
    assert "srcip" in FM.normalize_auth(raw, "3g").columns and "srcip" not in FM.normalize_auth(raw, "4g").columns


def test_epc_numbers_find_their_section(spark):
    sections = spark.createDataFrame([("861064100", "A", "B", "C", "CDMA"), ("861064200", "A", "B", "C", "IOT")],
                                     "sectionno string, atrb_pr string, user_pr string, user_city string, network string")
    raw = spark.createDataFrame([("00861064100012", "2024-02-09 23:59:00", 120), ("861064200012", "2024-02-09 01:00:00", None),
                                 ("86999", "no time", 1), (None, None, None)], "mdn string, T16 string, T17 long")
    got = {r.mdn: r for r in FM.normalize_epc(raw, sections, "sgw").collect()}
    assert len(got) == 4
    first = got["861064100012"]
    assert (first.mdnprovince, first.stoptime, first.d, first.h, first.m5) == ("A", "2024-02-10 00:01:00", "240210", "00", "00")
    assert (got["861064200012"].mdnprovince, got["861064200012"].stoptime) == ("物联网", None)
    assert got["86999"].mdnprovince is None and got["86999"].stoptime is None and got[None].network is None
    pgw = FM.normalize_epc(raw.withColumnRenamed("T17", "t17"), sections, "pgw")
    assert "starttime" not in pgw.columns and {r.stoptime for r in pgw.collect()} == {"2024-02-10 00:01:00", None}
