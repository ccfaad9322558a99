"""Record formats of raw logs (survey AN-46): usage records, authentication logs, EPC records.

Raw rows are JSON objects whose fields are positions (``T0``, ``T1``, ..., some left out by
the sender).  A format is a list of names; normalising is one projection: names for
positions, everything as text, time slots from the record's time text.  A position that the
input lacks gives a null column, so one damaged delivery does not fail the slot.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from . import joins as J

# Names of the positions T0, T1, ... of an accounting record (3G), "-" for none.
ACCOUNTING = """
streamnumber acct_status_type roamflag paidtype mdn msid esn meid source_ip_address nai
source_ipv6_prefix ipv6_interface_id account_session_id correlation_id session_continue
beginning_session service_reference_id flow_id_parameter home_agent pdsn_address
serving_pcf bsid foreign_agent_address subnet carrier_id user_zone gmt_time_zone_offset
service_option ip_technology compulsory_tunnel_indicator
release_indicator always_on hot_line_accounting_indication flow_status termination originating
bad_ppp_frame_count event_time active_time number_of_active_transitions
in_bound_mobile_ip_signaling_octet_count outbound_mobile_ip_signaling_octet_count
last_user_activity_time filtered_terminating filtered_originating rsvp_inbound_octet_count
rsvp_outbound_octet_count rsvp_inbound_packet_count rsvp_outbound_packet_count
ip_quality_of_service granted_qos_parameters container acct_authentic acct_session_time
acct_input_packets acct_output_packets acct_terminate_cause acct_input_gigawords
acct_output_gigawords session_id chteprl_otherarea_access_id pmip_indicator
ip_services_authorized pdsn_ipv6_address home_agent_ipv6_address foreign_agent_ipv6_address
pcf_ipv6_address
""".split()

# Names of the positions T800 to T809 of an accounting record.
ACCOUNTING_PLACE = "acce_province acce_region sid nid siteid sitename cellid cellname secid enterprise_name".split()

# Names of the positions T0, T1, ... of a gateway record (4G), "-" for none.
GATEWAY = """
recordtype servedimsi imsiunauthenticatedflag servedimeisv served3gpp2meid p_gwaddress
chargingid pdnconnectionid servingnodeaddress servingnodetype
p_gwplmnidentifier accesspointnameni pdppdntype servedpdppdnaddress servedpdppdnaddressext
dynamicaddressflag dynamicaddressflagext - mstimezone duration
causeforrecclosing diagnostics recordsequencenumber nodeid recordextensions
localsequencenumber apnselectionmode servedmsisdn userlocationinformation usercsginformation
threegpp2userlocationinformation chargingcharacteristics chchselectionmode
imssignalingcontext servingnodeplmnidentifier rattype psfurnishcharginginformation
starttime stoptime camelcharginginformation
externalchargingid servedmnnai l_ratinggroup l_chargingrulebasename l_localsequencenumber
l_timeoffirstusage l_timeoflastusage l_timeusage l_serviceconditionchange
l_qosinformationneg
l_datavolumefbcuplink l_datavolumefbcdownlink l_timeofreport sc_qosnegotiated
sc_datavolumegprsuplink sc_datavolumegprsdownlink sc_changecondition sc_changetime
""".split()

# Other fields of a gateway record, and the tag of the station in its location.
GATEWAY_OTHER = {"IMSI": "imsi", "MDN": "mdn", "T100": "t100", "T800": "prov", "T801": "city", "T802": "t802",
                 "T804": "enbid", "T805": "t805", "T806": "t806", "T807": "t807", "T809": "t809"}
STATION_TAG = "eNodeBId=([0-9]+)"

# Fields of an authentication log by class, and the code of a success.
AUTH_COMMON = "auth_result auth_time device imsicdma imsilte mdn nai_sercode".split()
AUTH_FIELDS = {"3g": [*AUTH_COMMON, "nasport", "nasportid", "nasporttype", "pcfip", "srcip"],
               "4g": [*AUTH_COMMON, "nasport", "nasportid", "nasporttype", "pcfip"],
               "vpdn": [*AUTH_COMMON, "entname", "lnsip", "pdsnip"]}
AUTH_SUCCESS = {"3g": "0", "4g": "0", "vpdn": "1"}

# Fields of EPC records by gateway.
EPC_FIELDS = {
    "sgw": {"imsi": "imsi", "T11": "changetime", "T16": "starttime", "T17": "duration", "T800": "t800", "T804": "bsid"},
    "pgw": {"imsi": "imsi", "T3": "servedimeisv", "T27": "servedmsisdn", "T8": "servingnodeaddress",
            "T35": "rattype", "T42": "l_ratinggroup", "T45": "l_timeoffirstusage", "T46": "l_timeoflastusage",
            "T50": "l_datavolumefbcuplink", "T51": "l_datavolumefbcdownlink", "T804": "enodebid", "T800": "t800"}}
# Network whose numbers belong to no province, and the label shown for it.
IOT_NETWORK, IOT_LABEL = "IOT", "物联网"


def positions(names: list[str], first: int = 0) -> dict[str, str]:
    """``T<position>`` → name for a run of positions."""
    return {f"T{first + i}": n for i, n in enumerate(names) if n != "-"}


CDR_FIELDS: dict[str, dict[str, str]] = {
    "pdsn": {"MDN": "mdn_2", **positions(ACCOUNTING), **positions(ACCOUNTING_PLACE, 800)},
    "haccg": {"MDN": "mdn_2", **positions(ACCOUNTING[:-1]), **positions(ACCOUNTING_PLACE, 800)},
    "pgw": {**positions(GATEWAY), **GATEWAY_OTHER},
}


def named_fields(raw: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """PRJ-1/PRJ-2: the fields under their names, as text (names of raw fields in any case)."""
    have = {c.lower(): c for c in raw.columns}
    present = {src: dst for src, dst in fields.items() if src.lower() in have}
    text = C.cast_all(C.rename_positional(raw, {f"`{have[s.lower()]}`": d for s, d in present.items()}))
    return C.tag(text, **{d: None for s, d in fields.items() if s not in present}).select(
        *[F.col(d).cast("string").alias(d) for d in fields.values()])


def text_slots(time: str, padded: bool = True) -> dict[str, Column]:
    """d (yyMMdd), h and m5 cut out of a time text ``yyyy-MM-dd HH:mm:ss``; parts that are not
    there are empty or null, a null time gives nulls."""
    t = F.col(time)
    m5 = (F.floor(F.substring(t, 15, 2).try_cast("int") / 5) * 5).cast("int").cast("string")
    return {"d": F.substring(F.regexp_replace(t, "-", ""), 3, 6), "h": F.substring(t, 12, 2),
            "m5": F.lpad(m5, 2, "0") if padded else m5}


def normalize_cdr(raw: DataFrame, klass: str) -> DataFrame:
    """AN-46: usage records of a class, ``pdsn`` / ``haccg`` (3G accounting) or ``pgw`` (4G).

    Slots come from the event time; those of a gateway record from its last usage, without
    which the record is dropped.  Its station (``bsid``) is cut out of the location text."""
    named = named_fields(raw, CDR_FIELDS[klass])
    if klass != "pgw":
        return named.withColumns(text_slots("event_time"))
    kept = named.where(F.col("l_timeoflastusage").isNotNull())
    return kept.withColumn("bsid", C.extract_tag("userlocationinformation", STATION_TAG)).withColumns(
        text_slots("l_timeoflastusage"))


def normalize_auth(raw: DataFrame, klass: str) -> DataFrame:
    """AN-46: authentication logs of a class, ``3g``, ``4g`` or ``vpdn``: its fields, the slots
    (m5 without a leading zero, as these logs have it) and ``result`` by the class's code."""
    named = named_fields(raw, {f: f for f in AUTH_FIELDS[klass]})
    ok = F.coalesce(F.col("auth_result") == AUTH_SUCCESS[klass], F.lit(False))
    return named.withColumns(text_slots("auth_time", padded=False)).withColumn(
        "result", F.when(ok, F.lit("success")).otherwise(F.lit("failed")))


def normalize_epc(raw: DataFrame, sections: DataFrame, gateway: str) -> DataFrame:
    """AN-46 + JN-16: records of a serving (``sgw``) or packet (``pgw``) gateway with the home
    of their number, found by the number's section (its first nine digits, without a leading
    international 00).

    ``sections``: sectionno, atrb_pr, user_pr, user_city, network.  The join is a left join: a
    number of no section stays, with nulls.  Numbers of the IOT network get that label instead
    of a province.  The stop time is start plus duration; slots come from it (sgw) or from the
    last usage (pgw)."""
    fields = {"mdn": "mdn", **EPC_FIELDS[gateway], **({"T16": "__start", "T17": "__seconds"} if gateway == "pgw" else {})}
    start, seconds = ("starttime", "duration") if gateway == "sgw" else ("__start", "__seconds")
    named = named_fields(raw, fields).withColumn("mdn", F.regexp_replace("mdn", "^00", ""))
    begin = F.try_to_timestamp(F.col(start), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    stop = C.stop_time(begin, F.col(seconds).try_cast("bigint"))
    timed = named.withColumn("mdnsection", C.section_key("mdn")).withColumn(
        "stoptime", F.date_format(stop, "yyyy-MM-dd HH:mm:ss")).drop("__start", "__seconds")
    timed = timed.withColumns(text_slots("stoptime" if gateway == "sgw" else "l_timeoflastusage"))
    home = sections.select(F.col("sectionno").alias("mdnsection"),
                           F.when(F.col("network") == IOT_NETWORK, F.lit(IOT_LABEL)).otherwise(F.col("atrb_pr"))
                           .alias("mdnprovince"), "user_pr", "user_city", "network")
    return J.dimension_join(timed, home, "mdnsection", "left")
