"""The queries in DuckDB's SQL, written from the rules and not from the Spark plans."""

from pyspark.sql import types as T

from tagloom.schema import AD_LOG, ODS
from workload.adlog import HISTORY_END

ORACLES = {}

# -- the log ------------------------------------------------------------------------

_RULES = {
    "sessionid": "event_id",
    "requestmode": "CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 1 END",
    "processnode": "1 + event_id % 3",
    "adplatformproviderid": "99990 + k",
    "iseffective": "CASE WHEN k % 5 = 0 THEN 0 ELSE 1 END",
    "isbilling": "CASE WHEN event_id % 7 = 0 THEN 0 ELSE 1 END",
    "isbid": "CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END",
    "iswin": "event_id % 2",
    "adorderid": "CASE WHEN event_id % 11 = 0 THEN 0 ELSE 199950 + k END",
    "adcreativeid": "199960 + k",
    "winprice": "CAST(round(value * 100) AS BIGINT)",
    "adpayment": "CAST(round(value * 80) AS BIGINT)",
    "channelid": "CASE WHEN k % 20 = 0 THEN '' ELSE CAST(123400 + k % 20 AS VARCHAR) END",
    "client": "1 + k % 6",
    "devicetype": "1 + k % 2",
    "device": "CASE WHEN event_id % 17 <> 0 THEN 'DEV ' || (event_id % 8) END",
    "networkmannerid": "1 + k % 4",
    "networkmannername": "CASE k % 4 WHEN 0 THEN 'WIFI' WHEN 1 THEN '4G' WHEN 2 THEN '3G' ELSE '5G' END",
    "ispname": "CASE k % 4 WHEN 0 THEN '移动' WHEN 1 THEN '联通' WHEN 2 THEN '电信' ELSE '' END",
    "appid": "'XRX' || (1 + k % 10)",
    "appname": "CASE WHEN event_id % 4 <> 0 THEN 'App ' || (1 + k % 10) END",
    "ip": "CASE WHEN event_id % 29 <> 0 THEN"
          " (1 + k) || '.' || (user_id % 256) || '.' || (event_id % 256) || '.7' END",
    "longitude": "CASE WHEN user_id % 31 <> 0 THEN"
                 " CAST(user_id * 7919 % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - 180 END",
    "latitude": "CASE WHEN user_id % 31 <> 0 THEN"
                " CAST(user_id * 104729 % 18000 AS DOUBLE) / CAST(100 AS DOUBLE) - 90 END",
    "province": "r_name",
    "city": "n_name",
    "keywords": "event_type || ',w' || (k % 3) || ',' || event_type",
    "age": "18 + user_id % 50",
    "sex": "user_id % 2",
    "androidid": "CASE WHEN event_id % 3 = 0 THEN 'A' || user_id END",
    "openudid": "CASE WHEN event_id % 5 = 0 THEN 'O' || (user_id - user_id % 2) END",
    "mac": "CASE WHEN event_id % 7 = 0 THEN 'M' || (user_id - user_id % 10) END",
    "idfa": "CASE WHEN event_id % 11 = 0 THEN 'D' || event_id END",
    "imei": "CASE event_id % 13 WHEN 1 THEN 'I' || user_id WHEN 2 THEN ' ' ELSE '' END",
}

_SQL_TYPES = {T.StringType: "VARCHAR", T.IntegerType: "INTEGER", T.LongType: "BIGINT",
              T.DoubleType: "DOUBLE", T.DecimalType: "DOUBLE"}


def _column(field):
    rule = _RULES.get(field.name)
    if rule is None and isinstance(field.dataType, T.StringType):
        rule = f"'{field.name}-' || (event_id % 7)"
    elif rule is None and isinstance(field.dataType, T.DecimalType):
        rule = "CAST(event_id % 1000 AS DOUBLE) / CAST(100 AS DOUBLE)"
    elif rule is None:
        rule = "event_id % 10"
    return f"CAST({rule} AS {_SQL_TYPES[type(field.dataType)]}) AS {field.name}"


_ADLOG = f"""adlog AS (
  SELECT event_id, user_id, ts, {', '.join(map(_column, ODS))}
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
  LEFT JOIN (SELECT c_custkey, r_name, n_name FROM customer
             JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey) c ON e.user_id = c.c_custkey)"""


def _with(*parts):
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def _oracle(name, body, *parts):
    ORACLES[name] = (_with(*parts) if parts else "") + body


# -- reports ------------------------------------------------------------------------

_BIDDING = "adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1"
_WON = f"{_BIDDING} AND iswin = 1"
_SPENT = f"{_WON} AND adorderid > 200000 AND adcreativeid > 200000"


def _sums(cost="winprice"):
    counts = {
        "org_request_num": "requestmode = 1 AND processnode >= 1",
        "valid_request_num": "requestmode = 1 AND processnode >= 2",
        "ad_request_num": "requestmode = 1 AND processnode = 3",
        "bid_num": f"{_BIDDING} AND isbid = 1 AND adorderid <> 0",
        "bid_success_num": _WON,
        "ad_show_num": "requestmode = 2 AND iseffective = 1",
        "ad_click_num": "requestmode = 3 AND iseffective = 1",
        "media_show_num": "requestmode = 2 AND iseffective = 1 AND isbilling = 1",
        "media_click_num": "requestmode = 3 AND iseffective = 1 AND isbilling = 1",
    }
    columns = [f"CAST(count(*) FILTER (WHERE {c}) AS BIGINT) AS {n}" for n, c in counts.items()]
    for name, price in (("ad_consumption", "winprice"), ("ad_cost", cost)):
        columns.append(f"CAST(coalesce(sum({price}) FILTER (WHERE {_SPENT}), 0) AS DOUBLE)"
                       f" / CAST(1000 AS DOUBLE) AS {name}")
    return ", ".join(columns)


_RATES = ("*, CAST(bid_success_num AS DOUBLE) / nullif(bid_num, 0) AS bid_success_rate,"
          " CAST(media_click_num AS DOUBLE) / nullif(media_show_num, 0) AS click_rate")
_LABEL = "CASE client WHEN 1 THEN 'android' WHEN 2 THEN 'ios' WHEN 3 THEN 'wp' ELSE 'other' END"

# report: (grouping columns, condition)
_REPORTS = {
    "region": ({"province": "province", "city": "city"},
               "province <> '' AND city <> ''"),
    "channel": ({"channelid": "channelid"}, "channelid <> ''"),
    "device": ({"client": _LABEL, "device": "device"}, "client IS NOT NULL AND device <> ''"),
    "network": ({"networkmannerid": "networkmannerid", "networkmannername": "networkmannername"},
                "networkmannerid IS NOT NULL AND networkmannername <> ''"),
    "operator": ({"ispname": "ispname"}, "ispname <> ''"),
    "app": ({"appid": "appid", "appname": "appname"}, "appid <> '' AND appname <> ''"),
}


def _funnel(name, cost="winprice", extra=""):
    columns, condition = _REPORTS[name]
    shown = ", ".join(f"{rule} AS {column}" for column, rule in columns.items())
    return (f"SELECT {_RATES} FROM (SELECT {shown}, {extra}{_sums(cost)} FROM adlog"
            f" WHERE {condition} GROUP BY {', '.join(columns.values())})")


for _name in _REPORTS:
    _oracle(f"report_{_name}", _funnel(_name), _ADLOG)
_oracle("report_cost_by_payment", _funnel("channel", "adpayment"), _ADLOG)
_oracle("report_province_city",
        "SELECT province, city, count(*) AS count FROM adlog"
        " WHERE province <> '' AND city <> '' GROUP BY province, city", _ADLOG)

_suite = [f"SELECT '{name}' AS report, * FROM (" + _funnel(name, extra="count(*) AS n, ") + ")"
          for name in _REPORTS]
_oracle("report_suite", " UNION ALL BY NAME ".join(f"({part})" for part in _suite), _ADLOG)

ORACLES["report_partials"] = ORACLES["report_suite"]

# -- sources and tables -------------------------------------------------------------

_oracle("read_json_log", f"SELECT {', '.join(AD_LOG.names)} FROM adlog", _ADLOG)
_oracle("write_read_roundtrip", "SELECT sessionid, ip, appid, winprice FROM adlog", _ADLOG)
_oracle("unique_by_key", """SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r = 1""")
_oracle("table_suffix", """SELECT event_id, strftime(ts, '%Y%m%d') AS today,
  strftime(ts - INTERVAL 1 DAY, '%Y%m%d') AS yesterday FROM events""")

# -- addresses ----------------------------------------------------------------------

_IPS = "ips AS (SELECT DISTINCT ip FROM adlog WHERE ip <> '')"
_NUMBERS = """numbers AS (
  SELECT ip, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
    + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS number FROM ips)"""
_RANGES = """ranges AS (
  SELECT (1 + 4 * CAST(n_nationkey AS BIGINT)) * 16777216 AS start_ip,
    (4 + 4 * CAST(n_nationkey AS BIGINT)) * 16777216 - 1 AS end_ip,
    CASE WHEN n_nationkey % 5 = 0 THEN n_name || '市' ELSE r_name || '省' || n_name || '市' END AS country,
    CASE WHEN n_nationkey % 7 = 0 THEN ' CZ88.NET' ELSE 'ISP' || (n_nationkey % 3) END AS area,
    CAST(13 * n_nationkey AS DOUBLE) AS lon, CAST(3 * n_nationkey AS DOUBLE) AS lat
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
_INFO = """info AS (
  SELECT ip, number, lon, lat, coalesce(country, '未知国家') AS country,
    CASE WHEN trim(area) = 'CZ88.NET' THEN '本机或本网络' ELSE coalesce(area, '未知地区') END AS area
  FROM numbers LEFT JOIN ranges ON number BETWEEN start_ip AND end_ip)"""
_PLACES = """places AS (
  SELECT *, CASE WHEN regexp_matches(country, '省.+') THEN regexp_extract(country, '^([^省]*省)', 1)
    ELSE country END AS place_province,
  CASE WHEN regexp_matches(country, '省.+') THEN regexp_extract(country, '省(.+)$', 1)
    ELSE country END AS place_city FROM info)"""
_LOCATED = (_ADLOG, _IPS, _NUMBERS, _RANGES, _INFO, _PLACES)

_oracle("distinct_ips", "SELECT ip FROM ips", _ADLOG, _IPS)
_oracle("ip_to_long", "SELECT ip, number FROM numbers", _ADLOG, _IPS, _NUMBERS)
_oracle("long_to_ip", """SELECT event_id, (number >> 24) || '.' || ((number >> 16) & 255) || '.'
  || ((number >> 8) & 255) || '.' || (number & 255) AS ip, number
FROM (SELECT event_id, event_id * 429497 % 4294967296 AS number FROM events)""")
_oracle("ip_region_join", "SELECT ip, country, area FROM info", *_LOCATED)
_oracle("ip_lonlat_join", "SELECT ip, lon, lat FROM info", *_LOCATED)
_oracle("ip_rows", """SELECT sessionid, a.ip, country, lon FROM adlog a
LEFT JOIN numbers n ON a.ip = n.ip LEFT JOIN ranges ON number BETWEEN start_ip AND end_ip""",
        _ADLOG, _IPS, _NUMBERS, _RANGES)
_oracle("ip_city", "SELECT ip, CASE WHEN ip NOT LIKE '192.168.%' THEN place_city END AS city FROM places",
        *_LOCATED)
_oracle("split_region", "SELECT ip, country, place_province AS province, place_city AS city FROM places",
        *_LOCATED)
_GEO = {"longitude": "p.lon", "latitude": "p.lat", "province": "p.place_province", "city": "p.place_city"}
_oracle("ods_enrich",
        f"SELECT {', '.join(f'{_GEO[c]} AS {c}' if c in _GEO else f'a.{c}' for c in ODS.names)}"
        " FROM adlog a LEFT JOIN places p ON a.ip = p.ip", *_LOCATED)

# -- business areas -----------------------------------------------------------------

_COORDINATES = """coordinates AS (
  SELECT longitude, latitude, min(user_id) AS u FROM adlog
  WHERE longitude IS NOT NULL AND latitude IS NOT NULL GROUP BY longitude, latitude)"""


def _bits(column, span):
    return (f"least(CAST(floor(({column} + {span // 2}) / {span} * 1048576) AS BIGINT), 1048575)")


# One character: five bits, alternating between the axes, longitude first.
_CELLS = f"""cells AS (
  SELECT *, array_to_string(list_transform(range(8), lambda c:
      substr('0123456789bcdefghjkmnpqrstuvwxyz', 1 + CAST(list_sum(list_transform(range(5), lambda i:
        (((CASE WHEN (5 * c + i) % 2 = 0 THEN x ELSE y END) >> CAST(19 - (5 * c + i) // 2 AS INTEGER)) & 1)
        * (16 >> CAST(i AS INTEGER)))) AS INTEGER), 1)), '') AS geohash
  FROM (SELECT *, {_bits('longitude', 360)} AS x, {_bits('latitude', 180)} AS y FROM coordinates))"""
_RESPONSES = """responses AS (
  SELECT *, CASE WHEN u % 23 = 0 THEN '' WHEN u % 19 = 0 THEN 'not json'
    WHEN u % 17 = 0 THEN '{"regeocode":{}}'
    ELSE '{"regeocode":{"addressComponent":{"businessAreas":[{"id":"1","location":"0,0","name":"AREA'
      || (u % 9) || '"},{"id":"2","location":"1,1","name":"AREA' || (u % 4) || '"}]}}}' END AS response
  FROM cells)"""
_NAMES = """names AS (
  SELECT *, CASE WHEN json_valid(response) THEN
    json_extract_string(response, '$.regeocode.addressComponent.businessAreas[*].name') END AS listed
  FROM responses)"""
_AREAS = """areas AS (
  SELECT geohash, string_agg(area, ',' ORDER BY area) AS areas
  FROM (SELECT DISTINCT geohash, unnest(listed) AS area FROM names) GROUP BY geohash)"""
_PLACED = (_ADLOG, _COORDINATES, _CELLS, _RESPONSES, _NAMES, _AREAS)

ORACLES["etl_unique_sessions"] = ORACLES["ods_enrich"]
_oracle("ip_range_files", """SELECT DISTINCT ip, CASE WHEN number IS NOT NULL AND ip NOT LIKE '192.168%' THEN (
  SELECT CASE WHEN number <= 16 * c_custkey + 5 + c_custkey % 3 * 6 THEN c_name END FROM customer
  WHERE c_custkey * 16 <= number ORDER BY c_custkey DESC LIMIT 1) END AS country
FROM (SELECT CASE event_id % 50 WHEN 0 THEN '192.168.0.7' WHEN 1 THEN '1.2.3.999' || event_id WHEN 2 THEN ''
        ELSE concat_ws('.', n >> 24 & 255, n >> 16 & 255, n >> 8 & 255, n & 255) END AS ip,
        CASE WHEN event_id % 50 > 2 THEN n END AS number
      FROM (SELECT event_id, event_id * 7 % 2097152 AS n FROM events))""")

_oracle("geohash8", "SELECT longitude, latitude, geohash FROM cells", _ADLOG, _COORDINATES, _CELLS)
_oracle("distinct_coords", "SELECT DISTINCT longitude, latitude FROM coordinates", _ADLOG, _COORDINATES)
_oracle("parse_areas", "SELECT longitude, latitude, coalesce(array_to_string(listed, ','), '') AS areas"
        " FROM names", *_PLACED)
_oracle("area_dictionary", "SELECT geohash, areas FROM areas", *_PLACED)

# -- tags ---------------------------------------------------------------------------

_DICTIONARIES = """apps AS (
  SELECT 'XRX' || i AS appid, 'Dict ' || i AS dict_name FROM range(1, 9) AS r(i)),
codes AS (SELECT * FROM (VALUES
  ('1', 'D00010001'), ('2', 'D00010002'), ('3', 'D00010003'), ('4', 'D00010004'),
  ('WIFI', 'D00020001'), ('4G', 'D00020002'), ('3G', 'D00020003'), ('2G', 'D00020004'),
  ('NETWORKOTHER', 'D00020005'),
  ('移动', 'D00030001'), ('联通', 'D00030002'), ('电信', 'D00030003'), ('OPERATOROTHER', 'D00030004')
) AS t(value, code))"""
_TAGGED = """tagged AS (
  SELECT a.* EXCLUDE (appname), coalesce(a.appname, apps.dict_name, '') AS appname,
    coalesce(c.code, 'OTHER') AS client_code, coalesce(i.code, 'OTHER') AS carrier_code,
    coalesce(n.code, 'OTHER') AS network_code, areas.areas
  FROM adlog a LEFT JOIN apps ON a.appid = apps.appid
  LEFT JOIN codes c ON CAST(a.client AS VARCHAR) = c.value
  LEFT JOIN codes i ON a.ispname = i.value
  LEFT JOIN codes n ON a.networkmannername = n.value
  LEFT JOIN cells g ON a.longitude = g.longitude AND a.latitude = g.latitude
  LEFT JOIN areas ON g.geohash = areas.geohash)"""
_TAG_PARTS = (*_PLACED, _DICTIONARIES, _TAGGED)

_TAG_RULES = {
    "app": ["'APP_' || appname"],
    "device": ["'DV_' || device", "'DT_' || client_code", "'ISP_' || carrier_code",
               "'NW_' || network_code",
               "CASE WHEN devicetype = 1 THEN 'NW_手机' ELSE 'NW_平板' END"],
    "region": ["'PV_' || province", "'CT_' || city"],
    "channel": ["'CN_' || channelid"],
    "keyword": ["unnest(list_transform(string_split(keywords, ','), lambda w: 'KW_' || w))"],
    "demography": ["'AGE_' || age", "CASE WHEN sex = '0' THEN 'SEX_女' ELSE 'SEX_男' END"],
    "business_area": ["unnest(list_transform(string_split(areas, ','), lambda w: 'BA_' || w))"],
}


def _tags(*kinds):
    """DISTINCT over the union: a tag counts once per row."""
    rules = [rule for kind in kinds for rule in _TAG_RULES[kind]]
    union = " UNION ".join(f"SELECT sessionid, {rule} AS tag FROM tagged" for rule in rules)
    return f"SELECT DISTINCT sessionid, tag FROM ({union}) WHERE tag IS NOT NULL"


_oracle("app_name_fill", "SELECT sessionid, appid, appname FROM tagged", *_TAG_PARTS)
_oracle("device_code", "SELECT sessionid, client_code, carrier_code, network_code FROM tagged", *_TAG_PARTS)
for _kind in _TAG_RULES:
    _oracle(f"tag_{_kind}", _tags(_kind), *_TAG_PARTS)

_ID_LIST = """idlists AS (
  SELECT sessionid, ts, list_filter([androidid, openudid, mac, idfa, imei],
    lambda i: i IS NOT NULL AND trim(i) <> '') AS ids FROM adlog),
identified AS (SELECT * FROM idlists WHERE len(ids) > 0)"""
_ROW_TAGS = f"row_tags AS (SELECT t.sessionid, tag FROM ({_tags(*_TAG_RULES)}) t" \
            " JOIN identified i ON t.sessionid = i.sessionid)"
_oracle("tags_per_row", "SELECT sessionid, tag FROM row_tags", *_TAG_PARTS, _ID_LIST, _ROW_TAGS)

# -- identity -----------------------------------------------------------------------


def _components(prefix, edges):
    """Labels spread along the edges until nothing is new; the smallest one stays."""
    return f"""{prefix}_edges AS ({edges}),
{prefix}_both AS (SELECT src, dst FROM {prefix}_edges UNION SELECT dst, src FROM {prefix}_edges),
{prefix}_reach AS (
  SELECT src AS id, src AS label FROM {prefix}_both
  UNION
  SELECT b.dst, r.label FROM {prefix}_reach r JOIN {prefix}_both b ON r.id = b.src),
{prefix}_users AS (SELECT id, min(label) AS user_id FROM {prefix}_reach GROUP BY id)"""


def _record_edges(condition="true"):
    return f"SELECT DISTINCT ids[1] AS src, unnest(ids) AS dst FROM identified WHERE {condition}"


_ALL_USERS = _components("every", _record_edges())
_oracle("identified_rows", """SELECT a.sessionid, androidid, openudid, mac, idfa, imei
FROM adlog a JOIN identified i ON a.sessionid = i.sessionid""", _ADLOG, _ID_LIST)
_oracle("identity_ids", "SELECT sessionid, array_to_string(ids, ',') AS ids, ids[1] AS main_id"
        " FROM identified", _ADLOG, _ID_LIST)
_oracle("identity_edges", _record_edges(), _ADLOG, _ID_LIST)
_oracle("connected_components", "SELECT id, user_id AS component FROM every_users",
        _ADLOG, _ID_LIST, _ALL_USERS)
_oracle("identity_members", "SELECT user_id, id FROM every_users", _ADLOG, _ID_LIST, _ALL_USERS)
ORACLES["identity_increment"] = ORACLES["identity_members"]
_oracle("identity_records", """SELECT sessionid, ids[1] AS id, user_id
FROM identified JOIN every_users ON ids[1] = id""", _ADLOG, _ID_LIST, _ALL_USERS)

# -- merged tags --------------------------------------------------------------------


def _merged(name, users, condition="true"):
    return f"""{name} AS (
  SELECT user_id, tag, CAST(count(*) AS DOUBLE) AS weight
  FROM row_tags t JOIN identified i ON t.sessionid = i.sessionid
  JOIN {users} ON ids[1] = id WHERE {condition} GROUP BY user_id, tag)"""


_BASE = (*_TAG_PARTS, _ID_LIST, _ROW_TAGS)
_MERGE = (*_BASE, _ALL_USERS, _merged("merged", "every_users"))
_oracle("tag_merge", "SELECT user_id, tag, weight FROM merged", *_MERGE)
_oracle("tag_decode", "SELECT user_id, tag, weight FROM merged", *_MERGE)
_oracle("tag_encode", """SELECT user_id, 0 AS part, all_user_id, tags
FROM (SELECT user_id, string_agg(id, ',' ORDER BY id) AS all_user_id FROM every_users GROUP BY user_id)
JOIN (SELECT user_id, string_agg(tag || ' -> ' || CAST(weight AS VARCHAR), '#' ORDER BY tag) AS tags
      FROM merged GROUP BY user_id) USING (user_id)""", *_MERGE)

_BEFORE = f"ts < TIMESTAMP '{HISTORY_END}'"
_AFTER = f"ts >= TIMESTAMP '{HISTORY_END}'"
_OLD = (*_BASE, _components("old", _record_edges(_BEFORE)), _merged("old_tags", "old_users", _BEFORE))
_oracle("tag_decay", "SELECT user_id, tag, round(weight * CAST(0.9 AS DOUBLE), 6) AS weight FROM merged",
        *_MERGE)
_oracle("tag_decay_all", """SELECT user_id, tag, round(weight * CASE WHEN tag LIKE 'KW\\_%' ESCAPE '\\'
  THEN CAST(0.8 AS DOUBLE) ELSE CAST(0.9 AS DOUBLE) END, 6) AS weight FROM merged""", *_MERGE)
_DAYS = """days AS (SELECT user_id, tag, CAST(i.ts AS DATE) AS day
  FROM row_tags t JOIN identified i ON t.sessionid = i.sessionid JOIN every_users ON ids[1] = id)"""
_oracle("tag_cooling", """SELECT user_id, tag, round(sum(pow(
    CASE WHEN tag LIKE 'KW\\_%' ESCAPE '\\' THEN CAST(0.8 AS DOUBLE) ELSE CAST(0.9 AS DOUBLE) END,
    date_diff('day', day, DATE '2024-02-06'))), 6) AS weight FROM days GROUP BY user_id, tag""",
        *_BASE, _ALL_USERS, _DAYS)
_oracle("tag_cooling_stored", """SELECT user_id, tag, round(sum(pow(CAST(0.9 AS DOUBLE), 25 -
    CASE WHEN day <= DATE '2024-01-10' THEN 10 WHEN day = DATE '2024-01-11' THEN 11 ELSE 20 END)), 6) AS weight
FROM days GROUP BY user_id, tag""", *_BASE, _ALL_USERS, _DAYS)
_QUALIFIED = """qualified AS (SELECT list_filter([
    CASE WHEN trim(androidid) <> '' THEN 'androidid:' || androidid END,
    CASE WHEN trim(openudid) <> '' THEN 'openudid:M' || substr(openudid, 2) END,
    CASE WHEN trim(mac) <> '' THEN 'mac:' || mac END, CASE WHEN trim(idfa) <> '' THEN 'idfa:' || idfa END,
    CASE WHEN trim(imei) <> '' THEN 'imei:' || imei END], lambda i: i IS NOT NULL) AS ids FROM adlog)"""
_oracle("tag_merge_qualified", "SELECT user_id, id FROM kinds_users", _ADLOG, _QUALIFIED,
        _components("kinds", "SELECT DISTINCT ids[1] AS src, unnest(ids) AS dst FROM qualified"
                             " WHERE len(ids) > 0"))
_oracle("tag_text_escape", """SELECT 'u' || c_nationkey AS user_id,
  'KW_C#' || (c_custkey % 7) || ' -> \\h,' || c_mktsegment AS tag, CAST(count(*) AS DOUBLE) AS weight
FROM customer GROUP BY ALL
UNION ALL SELECT 'u' || c_nationkey, c_mktsegment || ',\\c' || c_custkey, NULL FROM customer""")
_oracle("tag_history_merge", """SELECT user_id, tag, round(sum(weight), 6) AS weight FROM (
  SELECT u.user_id, tag, weight * CAST(0.9 AS DOUBLE) AS weight
  FROM old_tags o JOIN both_users u ON o.user_id = u.id
  UNION ALL SELECT user_id, tag, weight FROM new_tags) GROUP BY user_id, tag""",
        *_OLD,
        _components("both", _record_edges(_AFTER) + " UNION SELECT user_id, id FROM old_users"),
        _merged("new_tags", "both_users", _AFTER))

ORACLES["tag_history_stored"] = ORACLES["tag_history_merge"]

# -- skew ---------------------------------------------------------------------------

_oracle("hot_keys", """SELECT event_type, count(*) AS n FROM events GROUP BY event_type
HAVING count(*) >= CAST(0.2 AS DOUBLE) * (SELECT count(*) FROM events)""")
_ORDERS = "orders_ AS (SELECT o_orderkey, o_custkey AS c_custkey FROM orders)"
_BLANK = "blank AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS c_custkey FROM orders)"
_CUSTOMERS = "customers AS (SELECT c_custkey, c_name, c_mktsegment FROM customer)"


def _joined(left, condition="true"):
    return (f"SELECT l.c_custkey, o_orderkey, c_name, c_mktsegment FROM {left} l"
            f" LEFT JOIN customers r ON l.c_custkey = r.c_custkey WHERE {condition}")


_oracle("skew_nullfilter_join", _joined("blank", "l.c_custkey IS NOT NULL"), _BLANK, _CUSTOMERS)
for _name in ("skew_blank_around_join", "skew_lookup_join"):
    _oracle(_name, _joined("blank"), _BLANK, _CUSTOMERS)
for _name in ("skew_broadcast_join", "skew_split_join", "skew_salted_join"):
    _oracle(_name, _joined("orders_"), _ORDERS, _CUSTOMERS)
_oracle("skew_two_phase_count", """SELECT user_id, count(*) AS n, min(event_id) AS first_id,
  max(event_id) AS last_id, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY user_id""")
_SKEWED = """skewed AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 3 THEN 1 ELSE o_custkey END AS c_custkey
  FROM orders)"""
for _name in ("filled", "lookup", "split", "salted"):
    _oracle(f"skew_hot_{_name}_join", _joined("skewed"), _SKEWED, _CUSTOMERS)
_oracle("skew_hot_count", "SELECT c_custkey, count(*) AS n FROM skewed GROUP BY c_custkey", _SKEWED)
_oracle("skew_hot_keys", """SELECT c_custkey, count(*) AS n FROM skewed GROUP BY c_custkey
HAVING count(*) >= CAST(0.05 AS DOUBLE) * (SELECT count(*) FROM skewed)""", _SKEWED)
_oracle("union_distinct", "SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders")

# -- keyed tables -------------------------------------------------------------------

_ACCOUNTS = "accounts AS (SELECT c_custkey, c_name, c_acctbal FROM customer)"
_PATCH = """patch AS (
  SELECT c_custkey, CASE WHEN c_custkey % 20 <> 0 THEN 'patched ' || c_custkey END AS c_name,
    c_acctbal + 1 AS c_acctbal FROM accounts WHERE c_custkey % 10 = 0
  UNION ALL
  SELECT c_custkey + 1000000, c_name, c_acctbal FROM accounts WHERE c_custkey % 100 = 0)"""
_KEYED = (_ACCOUNTS, _PATCH)
_oracle("keyed_insert", """SELECT *, 0 AS conflict FROM accounts
UNION ALL SELECT *, 0 FROM patch WHERE c_custkey NOT IN (SELECT c_custkey FROM accounts)
UNION ALL SELECT *, 1 FROM patch WHERE c_custkey IN (SELECT c_custkey FROM accounts)""", *_KEYED)
_oracle("keyed_update", """SELECT a.c_custkey,
  CASE WHEN p.c_custkey IS NULL THEN a.c_name ELSE p.c_name END AS c_name, a.c_acctbal
FROM accounts a LEFT JOIN patch p ON a.c_custkey = p.c_custkey""", *_KEYED)
_oracle("keyed_delete", "SELECT * FROM accounts WHERE c_custkey NOT IN (SELECT c_custkey FROM patch)",
        *_KEYED)
_oracle("keyed_upsert", """SELECT * FROM accounts WHERE c_custkey NOT IN (SELECT c_custkey FROM patch)
UNION ALL SELECT * FROM patch""", *_KEYED)
_oracle("bucketed_join", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
for _name in ("upsert", "delete"):
    ORACLES[f"bucketed_{_name}"] = ORACLES[f"keyed_{_name}"]
_oracle("keyed_table_insert", """SELECT *, 0 AS conflict FROM accounts
UNION ALL SELECT *, 0 FROM patch WHERE c_custkey NOT IN (SELECT c_custkey FROM accounts)
UNION ALL SELECT *, 1 FROM patch WHERE c_custkey IN (SELECT c_custkey FROM accounts)
UNION ALL SELECT c_custkey, c_name, -1000000, 1 FROM patch WHERE c_custkey > 1000000""", *_KEYED)
for _name in ("update", "delete", "upsert"):
    ORACLES[f"keyed_table_{_name}"] = ORACLES[f"keyed_{_name}"]
_oracle("keyed_insert_select", """SELECT c_custkey, 'rich' AS c_name, c_acctbal FROM accounts WHERE c_acctbal > 3000
UNION ALL SELECT c_custkey + 1000000, c_name, c_acctbal FROM accounts WHERE c_acctbal > 9000""", *_KEYED)
_oracle("keyed_select", "SELECT c_custkey, c_name FROM accounts", *_KEYED)
_oracle("insert_select_filter", """SELECT * FROM (SELECT * FROM accounts UNION ALL SELECT * FROM patch)
WHERE c_acctbal > 3000""", *_KEYED)
