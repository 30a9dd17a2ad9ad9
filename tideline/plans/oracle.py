"""DuckDB SQL equal in meaning to each registered query (the correctness
oracle).  Written directly against the base tables, independently of the
Spark code paths: no JSON round trip, plain window functions."""

from __future__ import annotations

from tideline.plans import params as P

_DTF = "'%Y-%m-%d %H:%M:%S'"

START_LOG = """
start_log AS (
  SELECT 'START_LOG' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition",
         event_id // 4 AS "offset", event_id, ts AS ets,
         'mid_' || CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         CAST(user_id % 25 AS VARCHAR) AS ar, event_type AS ch,
         json_extract_string(props, '$.k') AS vc, epoch_us(ts) // 1000 AS ts,
         strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, strftime(ts, '%M') AS mi
  FROM events)"""

DAU_COLS = "mid, uid, ar, ch, vc, dt, hr, mi, ts"


def _firsts(where: str = "TRUE", name: str = "firsts") -> str:
    return f"""
{name} AS (
  SELECT {DAU_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY ts, event_id) AS rn
    FROM start_log WHERE {where}) WHERE rn = 1)"""


def _order_info(midnight: bool = False) -> str:
    ct = "o.o_orderdate" if midnight else "o.o_orderdate + to_seconds((o.o_orderkey * 7919) % 86400)"
    return f"""
oi AS (
  SELECT o.o_orderkey AS id, CAST(c.c_nationkey AS BIGINT) AS province_id,
         o.o_orderstatus AS order_status, o.o_custkey AS user_id,
         o.o_totalprice AS final_total_amount, CAST(0.0 AS DOUBLE) AS benefit_reduce_amount,
         o.o_totalprice AS original_total_amount, CAST(0.0 AS DOUBLE) AS feight_fee,
         strftime({ct} + INTERVAL 15 MINUTE, {_DTF}) AS expire_time,
         strftime({ct}, {_DTF}) AS create_time,
         strftime({ct}, {_DTF}) AS operate_time
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
oid AS (
  SELECT *, split_part(create_time, ' ', 1) AS create_date,
         split_part(split_part(create_time, ' ', 2), ':', 1) AS create_hour
  FROM oi)"""


ORDER_SRC = ("id, province_id, order_status, user_id, final_total_amount, benefit_reduce_amount, "
             "original_total_amount, feight_fee, expire_time, create_time, operate_time")

SEED = f"""
seed AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN order_status <> 'P' THEN '1' ELSE '0' END AS if_consumed,
         CASE WHEN order_status <> 'P' THEN id END AS first_order_id
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) AS rn
        FROM oi WHERE create_time < '{P.STATE_CUT}') WHERE rn = 1)"""

# Final flag of the batch after the cut given the seeded state (T2 rule).
BATCH_FLAGS = f"""
batch AS (SELECT * FROM oi WHERE create_time >= '{P.STATE_CUT}'),
cand AS (
  SELECT b.*, (coalesce(s.if_consumed, '') <> '1' OR coalesce(s.first_order_id = b.id, FALSE)) AS cand
  FROM batch b LEFT JOIN seed s ON CAST(b.user_id AS VARCHAR) = s.user_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY cand DESC, create_time, id) AS rn FROM cand),
flags AS (
  SELECT *, CASE WHEN cand AND rn = 1 THEN '1' ELSE '0' END AS if_first_order FROM ranked)"""

PROVINCES = f"""
prov AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region_id,
         CAST(n_nationkey + 100 AS VARCHAR) AS area_code, n_regionkey
  FROM nation),
prov_loaded AS (SELECT * FROM prov WHERE n_regionkey <> {P.MISSING_REGION})"""

USERS = f"""
users AS (
  SELECT c_custkey AS id, c_name AS name,
         strftime(DATE '1950-01-01' + CAST((c_custkey * 37) % 25000 AS INTEGER), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 3 = 0 THEN 'F' WHEN c_custkey % 3 = 1 THEN 'M' END AS gender,
         c_mktsegment
  FROM customer),
users_loaded AS (SELECT * FROM users WHERE c_mktsegment <> '{P.MISSING_SEGMENT}'),
user_attrs AS (
  SELECT id AS user_id,
         CASE WHEN gender = 'F' THEN '女' WHEN gender = 'M' THEN '男' END AS user_gender,
         CASE WHEN gender = 'F' THEN '男' ELSE '女' END AS user_gender_swapped,
         CASE WHEN age <= 20 THEN '20岁及以下' WHEN age <= 30 THEN '21-30岁' WHEN age > 30 THEN '30岁以上' END
           AS user_age_group
  FROM (SELECT *, year(DATE '{P.AS_OF}') - year(CAST(birthday AS DATE))
                  - CASE WHEN month(DATE '{P.AS_OF}') * 100 + day(DATE '{P.AS_OF}')
                              < month(CAST(birthday AS DATE)) * 100 + day(CAST(birthday AS DATE))
                         THEN 1 ELSE 0 END AS age
        FROM users_loaded))"""

WIDE = f"""
full_flags AS (
  SELECT id AS fid, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
                    THEN '1' ELSE '0' END AS if_first_order FROM oi),
wide AS (
  SELECT o.id, o.province_id, o.order_status, o.user_id, o.final_total_amount, o.benefit_reduce_amount,
         o.original_total_amount, o.feight_fee, o.expire_time, o.create_time, o.operate_time,
         o.create_date, o.create_hour, f.if_first_order, p.name AS province_name,
         p.area_code AS province_area_code, u.user_age_group, u.user_gender
  FROM oid o JOIN full_flags f ON o.id = f.fid
  LEFT JOIN prov_loaded p ON o.province_id = p.id
  LEFT JOIN user_attrs u ON o.user_id = u.user_id)"""

WIDE_COLS = (ORDER_SRC + ", create_date, create_hour, if_first_order, province_name, "
             "province_area_code, user_age_group, user_gender")


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _days(expr: str) -> str:
    return f"CAST(date_diff('day', DATE '1970-01-01', CAST({expr} AS DATE)) AS INTEGER)"


RANGES = f"""
ranges AS (
  SELECT {_days('ets')} AS batch_id, topic, "partition", min("offset") AS from_offset,
         max("offset") + 1 AS until_offset, count(*) AS n_rows
  FROM start_log GROUP BY ALL)"""

LEDGER = f"""
ledger AS (
  SELECT '{P.CONSUMER_GROUP}' AS group_id, topic, "partition", until_offset FROM (
    SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY batch_id DESC) AS rn
    FROM ranges WHERE from_offset < until_offset AND batch_id <= {_days(f"DATE '{P.LEDGER_CUT_DAY}'")})
  WHERE rn = 1)"""


def _word_regex(query: str) -> str:
    terms = sorted({t for t in query.lower().split() if t})
    return r"(^|[^\p{L}\p{N}])(" + "|".join(terms) + r")([^\p{L}\p{N}]|$)"


PAYLOAD = {"id": "BIGINT", "province_id": "BIGINT", "order_status": "VARCHAR", "user_id": "BIGINT", "final_total_amount": "DOUBLE",
           "benefit_reduce_amount": "DOUBLE", "original_total_amount": "DOUBLE", "feight_fee": "DOUBLE", "expire_time": "VARCHAR",
           "create_time": "VARCHAR", "operate_time": "VARCHAR", "name": "VARCHAR", "region_id": "VARCHAR", "area_code": "VARCHAR",
           "birthday": "VARCHAR", "gender": "VARCHAR", "order_id": "BIGINT", "sku_id": "BIGINT", "sku_num": "DOUBLE",
           "order_price": "DOUBLE", "category": "VARCHAR", "price": "DOUBLE"}


def _payload(**have: str) -> str:
    return ", ".join(f"CAST({have.get(f, 'NULL')} AS {t}) AS {f}" for f, t in PAYLOAD.items())


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


ORDER_FIELDS = _same(*[c.strip() for c in ORDER_SRC.split(",")])


def _cdc_object_sql() -> str:
    types = "['insert','update','delete','bootstrap-insert']"

    def routed(topic: str, n_fields: str, source: str, **have: str) -> str:
        return (f"SELECT '{topic}' AS topic, CAST({have['id']} AS VARCHAR) AS key, {types}[{have['id']} % 4 + 1] AS op_type, "
                f"{n_fields} AS n_fields, {_payload(**have)} FROM {source} WHERE {have['id']} % 4 <> 2")

    part = {"id": "p_partkey"}
    return _with(_order_info(), PROVINCES, USERS, """
detail AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id, l_quantity AS sku_num,
         l_extendedprice AS order_price, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time
  FROM lineitem)""") + "\nUNION ALL\n".join([
        f"SELECT 'ODS_T_ORDER_INFO' AS topic, CAST(id AS VARCHAR) AS key, 'insert' AS op_type, "
        f"CASE WHEN province_id IS NULL THEN 10 ELSE 11 END AS n_fields, {_payload(**ORDER_FIELDS)} FROM oi WHERE id % 4 = 0",
        routed("ODS_T_BASE_PROVINCE", "4", "prov", **_same("id", "name", "region_id", "area_code")),
        routed("ODS_T_USER_INFO", "CASE WHEN gender IS NULL THEN 3 ELSE 4 END", "users", **_same("id", "name", "birthday", "gender")),
        routed("ODS_T_ORDER_DETAIL", "6", "detail", **_same("id", "order_id", "sku_id", "sku_num", "order_price", "create_time")),
        routed("ODS_T_SPU_INFO", "3", "part", **part, name="p_name", category="p_type"),
        routed("ODS_T_SKU_INFO", "3", "part", **part, name="p_name", price="p_retailprice"),
        routed("ODS_T_BASE_CATEGORY3", "2", "part", **part, name="p_type"),
        routed("ODS_T_BASE_TRADEMARK", "2", "part", **part, name="p_brand")])


def _cdc_array_sql() -> str:
    return _with(_order_info()) + f"""
SELECT 'ODS_T_ORDER_INFO' AS topic, CAST(id AS VARCHAR) AS key,
       ['INSERT','UPDATE','DELETE'][({_days('substr(create_time, 1, 10)')} + id // 1024) % 3 + 1] AS op_type,
       CASE WHEN province_id IS NULL THEN 10 ELSE 11 END AS n_fields, {_payload(**ORDER_FIELDS)}
FROM oi"""


def _chain(sql: str) -> str:
    """The same SQL over the orders that the router passes on (inserts)."""
    return sql.replace("FROM orders o LEFT JOIN", "FROM (SELECT * FROM orders WHERE o_orderkey % 4 = 0) o LEFT JOIN")


def oracle_sql() -> dict[str, str]:
    cut = P.DAU_SEEN_CUT
    q: dict[str, str] = {}
    q["start_log_parse"] = _with(START_LOG) + """
SELECT topic, "partition", "offset", mid, uid, ar, ch, vc, ts FROM start_log"""
    q["dau_info"] = _with(START_LOG, _firsts()) + f" SELECT {DAU_COLS} FROM firsts"
    q["dau_incremental"] = _with(START_LOG, _firsts(f"ets >= TIMESTAMP '{cut}'")) + f"""
SELECT {DAU_COLS} FROM firsts f
WHERE NOT EXISTS (SELECT 1 FROM start_log s
                  WHERE s.ets < TIMESTAMP '{cut}' AND s.dt = f.dt AND s.mid = f.mid)"""
    q["dau_index_by_run_date"] = _with(START_LOG, """
firsts AS (
  SELECT s.*, strftime(CAST(date_trunc('week', CAST(dt AS DATE)) AS DATE) + 7, '%Y%m%d') AS run_date
  FROM (SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY ts, event_id) AS rn FROM start_log) s
  WHERE rn = 1)""") + f"""
SELECT 'dau_info_' || run_date AS index_name, {DAU_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY run_date, mid ORDER BY ts DESC, event_id DESC) AS rn2
  FROM firsts) WHERE rn2 = 1"""
    q["dau_upsert"] = _with(START_LOG, _firsts(f"ets < TIMESTAMP '{P.DAU_BATCH1_END}'", "f1"),
                            _firsts(f"ets >= TIMESTAMP '{P.DAU_BATCH2_START}'", "f2")) + f"""
SELECT {DAU_COLS} FROM f1 WHERE NOT EXISTS (SELECT 1 FROM f2 WHERE f2.dt = f1.dt AND f2.mid = f1.mid)
UNION ALL SELECT {DAU_COLS} FROM f2"""
    q["dau_filter_counts"] = _with(START_LOG) + """
SELECT dt, count(*) AS rows_before, count(DISTINCT mid) AS rows_after FROM start_log GROUP BY dt"""
    q["cdc_route_object"] = _cdc_object_sql()
    q["cdc_route_array"] = _cdc_array_sql()
    q["cdc_rejects"] = f"""
SELECT 'ODS_DB_OBJECT' AS topic, 5 AS "partition", CAST(n_nationkey AS BIGINT) * 2 + 1 AS "offset",
       '{{"table":"base_province","type":"' || ['insert','update','delete','bootstrap-insert'][(n_nationkey * 2 + 1) % 4 + 1]
         || '","data":null}}' AS value, 'no data' AS reason FROM nation
UNION ALL
SELECT 'ODS_DB_ARRAY', 4, CAST(r_regionkey AS BIGINT) * 3 + i,
       '{{"table":"order_info","type":"INSERT","data":' || CASE i WHEN 1 THEN 'null' ELSE '[null]' END || '}}',
       CASE i WHEN 1 THEN 'no data' ELSE 'null element' END
FROM region, (VALUES (1), (2)) v(i)"""
    q["start_log_rejects"] = """
SELECT 'START_LOG' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset",
       CASE WHEN event_type = 'purchase' THEN 'no ts' ELSE 'no mid' END AS reason,
       CAST(CASE event_type WHEN 'error' THEN 12
            WHEN 'signup' THEN length('{"common":{"ch":"signup"},"ts":' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || '}')
            ELSE length('{"common":{"mid":"mid_' || CAST(user_id AS VARCHAR) || '","ch":"purchase"}}') END AS INTEGER) AS value_chars
FROM events WHERE event_type IN ('error', 'signup', 'purchase')"""
    q["order_rejects"] = """
SELECT 'ODS_T_ORDER_INFO' AS topic, CAST(o_orderkey % 4 AS INTEGER) AS "partition", o_orderkey // 4 AS "offset",
       CASE WHEN o_orderstatus = 'P' THEN 'no create_time' ELSE 'no user_id' END AS reason, CAST(o_orderkey AS VARCHAR) AS id
FROM orders WHERE o_orderstatus IN ('P', 'O')"""
    q["cdc_order_chain"] = _chain(_with(_order_info(), PROVINCES, USERS, WIDE) + f" SELECT {WIDE_COLS} FROM wide")
    q["cdc_province_chain"] = _with(PROVINCES) + """
SELECT id, name, region_id, area_code FROM prov WHERE id % 4 <> 2
UNION ALL
SELECT id, lower(name) || ' v2', region_id, CAST(id + 200 AS VARCHAR) FROM prov WHERE id % 4 = 2 AND n_regionkey IN (0, 2)"""
    q["order_parse"] = _with(_order_info()) + f" SELECT {ORDER_SRC}, create_date, create_hour FROM oid"
    q["state_lookup"] = _with(_order_info(), SEED) + f"""
SELECT user_id, if_consumed, first_order_id FROM seed
WHERE user_id IN (SELECT CAST(user_id AS VARCHAR) FROM oi WHERE create_time >= '{P.STATE_CUT}')"""
    q["order_state_flag"] = _with(_order_info(), SEED) + f"""
SELECT b.id, b.user_id,
       CASE WHEN s.if_consumed = '1' AND NOT coalesce(s.first_order_id = b.id, FALSE) THEN '0' ELSE '1' END
         AS if_first_order
FROM oi b LEFT JOIN seed s ON CAST(b.user_id AS VARCHAR) = s.user_id
WHERE b.create_time >= '{P.STATE_CUT}'"""
    q["first_order_in_batch"] = _with(_order_info(), SEED, BATCH_FLAGS) + """
SELECT id, user_id, create_time, if_first_order FROM flags"""
    q["order_first_flag"] = _with(_order_info(midnight=True)) + """
SELECT id, user_id, create_time,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1 THEN '1' ELSE '0' END
         AS if_first_order
FROM oi"""
    q["order_first_two_batches"] = _with(_order_info()) + f"""
, b1 AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) AS rn
  FROM oi WHERE create_time < '{P.STATE_CUT}'),
b2 AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) AS rn
  FROM oi WHERE create_time >= '{P.STATE_CUT}')
SELECT 1 AS batch, id, user_id, CASE WHEN rn = 1 THEN '1' ELSE '0' END AS if_first_order FROM b1
UNION ALL
SELECT 2, id, user_id,
       CASE WHEN rn = 1 AND user_id NOT IN (SELECT user_id FROM b1) THEN '1' ELSE '0' END FROM b2"""
    q["user_state"] = _with(_order_info(), SEED, BATCH_FLAGS) + """
, upd AS (SELECT CAST(user_id AS VARCHAR) AS user_id, '1' AS if_consumed, id AS first_order_id
          FROM flags WHERE if_first_order = '1')
SELECT user_id, if_consumed, first_order_id FROM seed WHERE user_id NOT IN (SELECT user_id FROM upd)
UNION ALL SELECT user_id, if_consumed, first_order_id FROM upd"""
    q["dim_scan"] = _with(PROVINCES) + " SELECT id, name, region_id, area_code FROM prov"
    q["dim_upsert"] = _with(PROVINCES) + """
SELECT id,
       CASE WHEN n_regionkey IN (0, 2) THEN lower(name) || ' v2' ELSE name END AS name,
       region_id,
       CASE WHEN n_regionkey IN (0, 2) THEN CAST(id + 200 AS VARCHAR) ELSE area_code END AS area_code
FROM prov"""
    q["user_dim_upsert"] = _with(USERS) + f"""
SELECT id, CASE WHEN c_mktsegment = '{P.CHANGED_SEGMENT}' THEN upper(name) || ' (renamed)' ELSE name END
         AS name, birthday, gender
FROM users"""
    q["keyed_upsert"] = _with(_order_info()) + f"""
SELECT id, province_id,
       CASE WHEN order_status = '{P.UPDATED_STATUS}' THEN '{P.NEW_STATUS}' ELSE order_status END AS order_status,
       user_id, final_total_amount, benefit_reduce_amount, original_total_amount, feight_fee, expire_time,
       create_time,
       CASE WHEN order_status = '{P.UPDATED_STATUS}'
            THEN strftime(CAST(create_time AS TIMESTAMP) + INTERVAL 1 DAY, {_DTF}) ELSE operate_time END
         AS operate_time
FROM oi"""
    q["order_province_enrich"] = _with(_order_info(), PROVINCES) + """
SELECT o.id, o.province_id, p.name AS province_name, p.area_code AS province_area_code
FROM oi o LEFT JOIN prov_loaded p ON o.province_id = p.id"""
    q["order_user_enrich"] = _with(_order_info(), USERS) + """
SELECT o.id, o.user_id, u.user_gender, u.user_age_group
FROM oi o LEFT JOIN user_attrs u ON o.user_id = u.user_id"""
    q["order_user_enrich_swapped"] = _with(_order_info(), USERS) + """
SELECT o.id, o.user_id, u.user_gender_swapped AS user_gender, u.user_age_group
FROM oi o LEFT JOIN user_attrs u ON o.user_id = u.user_id"""
    q["order_wide"] = _with(_order_info(), PROVINCES, USERS, WIDE) + f" SELECT {WIDE_COLS} FROM wide"
    q["dw_order_messages"] = _with(_order_info(), PROVINCES, USERS, WIDE) + """
SELECT 'DW_ORDER_INFO' AS topic, CAST(id AS VARCHAR) AS key, """ + WIDE_COLS + " FROM wide"
    q["order_wide_repeated_dims"] = _with(_order_info(), PROVINCES, USERS, WIDE, f"""
prov_all AS (
  SELECT id, name AS n, area_code AS a FROM prov_loaded
  UNION ALL SELECT id, lower(name) || ' v2', CAST(id + 200 AS VARCHAR) FROM prov WHERE n_regionkey IN (0, 2)),
prov_one AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, a DESC) AS rn FROM prov_all) WHERE rn = 1)""") + """
SELECT w.* EXCLUDE (province_name, province_area_code, user_age_group), p.n AS province_name, p.a AS province_area_code,
       CASE WHEN l.id IS NOT NULL THEN '20岁及以下' END AS user_age_group
FROM wide w LEFT JOIN prov_one p ON w.province_id = p.id LEFT JOIN users_loaded l ON w.user_id = l.id"""
    q["order_upsert"] = _with(_order_info(), PROVINCES, USERS, WIDE) + f"""
SELECT id, province_id,
       CASE WHEN order_status = '{P.UPDATED_STATUS}' THEN '{P.NEW_STATUS}' ELSE order_status END AS order_status,
       user_id, final_total_amount, benefit_reduce_amount, original_total_amount, feight_fee, expire_time,
       create_time, operate_time, create_date, create_hour, if_first_order, province_name,
       province_area_code, user_age_group, user_gender
FROM wide"""
    q["offset_ranges"] = _with(START_LOG, RANGES) + """
SELECT batch_id, topic, "partition", from_offset, until_offset, n_rows FROM ranges"""
    q["offset_ledger"] = _with(START_LOG, RANGES, LEDGER) + """
SELECT group_id, topic, "partition", until_offset FROM ledger"""
    q["offset_resume"] = _with(START_LOG, RANGES, LEDGER) + """
SELECT s.topic, s."partition", s."offset" FROM start_log s
LEFT JOIN ledger l ON s.topic = l.topic AND s."partition" = l."partition"
WHERE s."offset" >= coalesce(l.until_offset, 0)"""
    q["term_match_search"] = f"""
SELECT doc_id AS id, n_chars AS score FROM documents
WHERE regexp_matches(lower(text), '{_word_regex(P.DOC_QUERY)}')
ORDER BY n_chars, doc_id LIMIT {P.SEARCH_LIMIT}"""
    q["term_match_postings"] = q["term_match_search"]
    q["nested_match_search"] = f"""
SELECT conv_id, count(*) AS n_turns,
       CAST(sum(CASE WHEN regexp_matches(lower(text), '{_word_regex(P.CONV_QUERY)}') THEN 1 ELSE 0 END)
            AS BIGINT) AS n_matching
FROM conversations GROUP BY conv_id HAVING n_matching > 0"""
    return q
