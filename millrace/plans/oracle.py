"""DuckDB SQL for the registered queries, over the same tables and without any row restriction of its own."""

from __future__ import annotations

from millrace.plans.feeds import DIC

_DIC_VALUES = ", ".join(f"('{code}', '{name}')" for code, name in DIC.items())
_HMS = "'%Y-%m-%d %H:%M:%S'"


def _ends(size: str = "10 seconds", ts: str = "ts") -> str:
    start = f"time_bucket(INTERVAL '{size}', {ts})"
    return f"strftime({start}, {_HMS}) AS stt, strftime({start} + INTERVAL '{size}', {_HMS}) AS edt"


# Named parts; each may use the ones above it.
PARTS = {
    "ev": "SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
    "page_log": """
        SELECT event_id AS log_id, k, event_type, ts, CAST(user_id AS VARCHAR) AS mid,
            CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS uid,
            CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN 'login'
                WHEN 'purchase' THEN 'payment' ELSE 'good_list' END AS page_id,
            CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN 'login' ELSE 'search' END AS last_page_id,
            CASE WHEN k % 2 = 0 THEN 'keyword' ELSE 'sku_id' END AS item_type,
            CASE WHEN k % 7 = 0 THEN NULL WHEN k % 4 = 0 THEN 'red widget' WHEN k % 4 = 2 THEN 'Blue BOLT 256'
                ELSE 'ring' END AS item,
            CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new,
            'v' || CAST(k % 4 AS VARCHAR) AS vc, 'ch' || CAST(user_id % 3 AS VARCHAR) AS ch,
            CAST(user_id % 25 AS VARCHAR) AS ar, CAST(round(value * 1000) AS BIGINT) AS during_time
        FROM ev""",
    "readable": "SELECT * FROM page_log WHERE k % 17 <> 5",
    "repaired": """
        SELECT * REPLACE (CASE WHEN is_new = '1' AND anchor <> CAST(ts AS DATE) THEN '0' ELSE is_new END AS is_new)
        FROM (SELECT *, first_value(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END)
                OVER (PARTITION BY mid ORDER BY ts, log_id) AS anchor FROM page_log)""",
    "readable_repaired": """
        SELECT * REPLACE (CASE WHEN is_new = '1' AND anchor <> CAST(ts AS DATE) THEN '0' ELSE is_new END AS is_new)
        FROM (SELECT *, first_value(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END)
                OVER (PARTITION BY mid ORDER BY ts, log_id) AS anchor FROM readable)""",
    "uv": """
        SELECT * FROM (SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY mid ORDER BY ts, log_id) AS before
            FROM repaired WHERE coalesce(last_page_id, '') = '')
        WHERE before IS NULL OR before <> CAST(ts AS DATE)""",
    "steps": """
        SELECT *, lead(ts) OVER w AS next_ts, lead(coalesce(last_page_id, '') = '') OVER w AS next_entry
        FROM repaired WINDOW w AS (PARTITION BY mid ORDER BY ts, log_id)""",
    "jump10": """
        SELECT * FROM steps WHERE coalesce(last_page_id, '') = ''
            AND (next_ts IS NULL OR next_entry OR next_ts >= ts + INTERVAL '10 seconds')""",
    "jump6h": """
        SELECT * FROM steps WHERE coalesce(last_page_id, '') = ''
            AND (next_ts IS NULL OR next_entry OR next_ts >= ts + INTERVAL '6 hours')""",
    "signed_in": """
        SELECT * FROM page_log WHERE coalesce(uid, '') <> ''
            AND (coalesce(last_page_id, '') = '' OR last_page_id = 'login')""",
    "dic": f"SELECT * FROM (VALUES {_DIC_VALUES}) AS t(dic_code, dic_name)",
    "cart": """
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
            CAST(event_id % 2000 AS VARCHAR) AS sku_id, CAST(2401 + k % 5 AS VARCHAR) AS source_type,
            event_type = 'click' AS is_insert, k % 20 AS num,
            CASE WHEN event_type = 'click' OR k % 3 = 0 THEN NULL ELSE (k + 7) % 20 END AS old_num,
            CAST(floor(epoch(ts)) AS BIGINT) AS sec
        FROM ev WHERE event_type IN ('click', 'view')""",
    "cart_fact": """
        SELECT id, user_id, sku_id, source_type AS source_type_code, dic_name AS source_type_name,
            CAST(CASE WHEN is_insert THEN num ELSE num - old_num END AS VARCHAR) AS sku_num,
            CAST(sec AS VARCHAR) AS ts, sec
        FROM cart JOIN dic ON source_type = dic_code WHERE is_insert OR num > old_num""",
    "first_adds": """
        SELECT * FROM (SELECT *, lag(d) OVER (PARTITION BY user_id ORDER BY sec, id) AS before
            FROM (SELECT *, CAST(epoch_ms(sec * 1000) AS DATE) AS d FROM cart_fact))
        WHERE before IS NULL OR before <> d""",
    "order_rows": """
        SELECT 'insert' AS type, o_orderkey, o_custkey, '1001' AS order_status, NULL AS old_status, o_orderdate AS ts
        FROM orders
        UNION ALL
        SELECT 'update', o_orderkey, o_custkey,
            CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'P' THEN '1005' ELSE '1002' END, '1001',
            o_orderdate + INTERVAL '1' DAY FROM orders
        UNION ALL
        SELECT 'update', o_orderkey, o_custkey, '1006', '1005', o_orderdate + INTERVAL '2' DAY
        FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 0""",
    "order_info": f"""
        SELECT type, CAST(o_orderkey AS VARCHAR) AS oi_id, CAST(o_custkey AS VARCHAR) AS user_id,
            CAST(o_custkey % 25 AS VARCHAR) AS province_id, order_status, old_status,
            strftime(ts, {_HMS}) AS operate_time, CAST(CAST(epoch(ts) AS BIGINT) AS VARCHAR) AS oi_ts
        FROM order_rows""",
    "line": f"""
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
            CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
            'part ' || CAST(l_partkey AS VARCHAR) AS sku_name, strftime(l_shipdate, {_HMS}) AS create_time,
            CAST(l_suppkey AS VARCHAR) AS source_id, CAST(2401 + l_linenumber % 5 AS VARCHAR) AS source_type,
            CAST(CAST(l_quantity AS INT) AS VARCHAR) AS sku_num,
            CAST(CAST(CAST(l_quantity AS INT) AS DECIMAL(16,2)) * CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR)
                AS split_original_amount,
            CASE WHEN l_discount > 0.05 THEN CAST(CAST(l_extendedprice AS DECIMAL(16,2))
                * CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) END AS split_activity_amount,
            CASE WHEN l_tax > 0.05 THEN CAST(CAST(l_extendedprice AS DECIMAL(16,2))
                * CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) END AS split_coupon_amount,
            CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS split_total_amount,
            CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS od_ts
        FROM lineitem""",
    "activity": """
        SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS act_id,
            CAST(l_orderkey % 7 AS VARCHAR) AS activity_id, CAST(l_linenumber AS VARCHAR) AS activity_rule_id
        FROM lineitem WHERE l_discount > 0.05""",
    "coupon": """
        SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS cou_id,
            CAST(l_orderkey % 11 AS VARCHAR) AS coupon_id
        FROM lineitem WHERE l_tax > 0.05""",
    "wide": """
        SELECT id, order_id, sku_id, sku_name, left(create_time, 10) AS date_id, create_time, source_id, source_type,
            sku_num, split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount, od_ts,
            user_id, province_id, left(operate_time, 10) AS operate_date_id, operate_time, order_status, type,
            old_status, oi_ts, activity_id, activity_rule_id, coupon_id, dic_name AS source_type_name
        FROM line JOIN order_info ON order_id = oi_id LEFT JOIN activity ON id = act_id
            LEFT JOIN coupon ON id = cou_id JOIN dic ON source_type = dic_code""",
    "detail": """
        SELECT id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id, date_id,
            create_time, source_id, source_type AS source_type_code, source_type_name, sku_num, split_original_amount,
            split_activity_amount, split_coupon_amount, split_total_amount, od_ts AS ts
        FROM wide WHERE type = 'insert'""",
    "payment": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS pi_order_id, CAST(1101 + o_orderkey % 4 AS VARCHAR) AS payment_type,
            CASE WHEN o_orderkey % 3 = 0 THEN '1601' ELSE '1602' END AS payment_status,
            strftime(o_orderdate + INTERVAL '2' HOUR, {_HMS}) AS callback_time,
            CAST(CAST(epoch(o_orderdate + INTERVAL '2' HOUR) AS BIGINT) AS VARCHAR) AS pi_ts
        FROM orders WHERE o_orderstatus = 'O'""",
    "paid": """
        SELECT id AS order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id,
            coupon_id, payment_type AS payment_type_code, dic_name AS payment_type_name, callback_time, source_id,
            source_type_code, source_type_name, sku_num, split_original_amount, split_activity_amount,
            split_coupon_amount, split_total_amount AS split_payment_amount, pi_ts AS ts, payment_status
        FROM payment JOIN detail ON pi_order_id = order_id JOIN dic ON payment_type = dic_code""",
    "returned": f"""
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
            CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS order_id,
            CAST(l_partkey AS VARCHAR) AS sku_id, strftime(l_shipdate, {_HMS}) AS create_time,
            CAST(1501 + l_linenumber % 2 AS VARCHAR) AS refund_type,
            CAST(1301 + l_partkey % 8 AS VARCHAR) AS reason_type, 'reason ' || CAST(l_linenumber AS VARCHAR) AS reason,
            CAST(1101 + l_orderkey % 4 AS VARCHAR) AS payment_type,
            CAST(CAST(l_quantity AS INT) AS VARCHAR) AS refund_num,
            CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS refund_amount,
            l_partkey % 2 = 0 AS finished, l_partkey % 3 = 0 AS repaid,
            CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND o_orderstatus = 'P'""",
    "latest": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY create_time DESC, split_total_amount DESC,
            sku_id DESC, source_id DESC, sku_num DESC) AS rn FROM detail) WHERE rn = 1""",
    "flagged": """
        SELECT *, CASE WHEN before IS NULL OR before <> d THEN 1 ELSE 0 END AS uu FROM (
            SELECT *, lag(d) OVER (PARTITION BY user_id ORDER BY t, id) AS before FROM (
                SELECT *, epoch_ms(CAST(ts AS BIGINT) * 1000) AS t, CAST(epoch_ms(CAST(ts AS BIGINT) * 1000) AS DATE) AS d
                FROM latest))""",
    "sides": "SELECT c_custkey * 2 AS c_key, c_name FROM customer",
    "click": "SELECT event_id AS click_id, user_id AS c_user, ts AS c_ts FROM events WHERE event_type = 'click'",
    "buy": "SELECT event_id AS buy_id, user_id AS b_user, ts AS b_ts FROM events WHERE event_type = 'purchase'",
}
_ORDER = list(PARTS)


def _sql(select: str, *parts: str) -> str:
    """``select`` with the parts it names, and the parts those use, as a WITH clause."""
    wanted = set(parts)
    for name in reversed(_ORDER):
        if name in wanted:
            words = set(PARTS[name].replace(",", " ").replace("(", " ").replace(")", " ").split())
            wanted |= {other for other in _ORDER[: _ORDER.index(name)] if other in words}
    clause = ", ".join(f"{name} AS ({PARTS[name].strip()})" for name in _ORDER if name in wanted)
    return f"WITH {clause} {select}" if clause else select


def _traffic(uv: str = "uv", jump: str = "jump10") -> str:
    keys = "vc, ch, ar, is_new"
    total = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"))
    return f"""
        SELECT {_ends()}, {keys}, {total} FROM (
            SELECT ts, {keys}, 0 AS uv_ct, CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS sv_ct,
                1 AS pv_ct, during_time AS dur_sum, 0 AS uj_ct FROM repaired
            UNION ALL SELECT ts, {keys}, 1, 0, 0, 0, 0 FROM {uv}
            UNION ALL SELECT ts, {keys}, 0, 0, 0, 0, 1 FROM {jump})
        GROUP BY time_bucket(INTERVAL '10 seconds', ts), {keys}"""


def _sku_report(size: str) -> str:
    amounts = ", ".join(
        f"round(CAST(sum(CAST(coalesce(split_{a}, '{d}') AS DECIMAL(18,4))) AS DOUBLE), 4) AS {n}"
        for a, d, n in (
            ("original_amount", "0", "original_amount"),
            ("activity_amount", "0", "activity_amount"),
            ("coupon_amount", "0", "coupon_amount"),
            ("total_amount", "0", "order_amount"),
        )
    )
    return f"""
        SELECT {_ends(size, 't')}, sku_id, CAST(sum(uu) AS BIGINT) AS order_uu_count,
            count(DISTINCT order_id) AS order_count, {amounts}
        FROM flagged GROUP BY time_bucket(INTERVAL '{size}', t), sku_id"""


_TS_MS = "epoch_us(ts) // 1000 AS ts_ms"
_ON_PAGE = "k % 11 <> 3"

ORACLE = {
    "traffic_full_window": _sql(_traffic(), "repaired", "uv", "jump10"),
    "traffic_union_window": _sql(_traffic(), "repaired", "uv", "jump10"),
    "traffic_page_window": _sql(
        f"""SELECT {_ends()}, vc, ch, ar, is_new,
            CAST(sum(CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct,
            count(*) AS pv_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum
        FROM page_log GROUP BY time_bucket(INTERVAL '10 seconds', ts), vc, ch, ar, is_new""",
        "page_log",
    ),
    "union_streams": _sql(
        """SELECT vc, is_new, count(*) AS n_rows, CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
            CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum, CAST(sum(uj) AS BIGINT) AS uj_ct
        FROM (SELECT vc, is_new, 0 AS uv, CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS sv, 1 AS pv,
                during_time AS dur, 0 AS uj FROM page_log
            UNION ALL SELECT vc, is_new, 1, 0, 0, 0, 0 FROM page_log WHERE coalesce(last_page_id, '') = ''
            UNION ALL SELECT vc, is_new, 0, 0, 0, 0, 1 FROM page_log WHERE page_id = 'payment') GROUP BY vc, is_new""",
        "page_log",
    ),
    "new_visitor_repair": _sql("SELECT log_id, mid, is_new FROM repaired", "repaired"),
    "unique_visitor_detail": _sql(f"SELECT log_id, mid, page_id, {_TS_MS} FROM uv", "uv"),
    "user_jump_10s": _sql(f"SELECT log_id, mid, page_id, {_TS_MS} FROM jump10", "jump10"),
    "user_jump_6h": _sql(f"SELECT log_id, mid, page_id, {_TS_MS} FROM jump6h", "jump6h"),
    "user_jump_hot_keys": _sql(
        """SELECT log_id, mid, is_new, CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS is_visit_start,
            CASE WHEN log_id IN (SELECT log_id FROM uv) THEN 1 ELSE 0 END AS is_unique_visit,
            CASE WHEN log_id IN (SELECT log_id FROM jump6h) THEN 1 ELSE 0 END AS is_bounce
        FROM repaired""",
        "repaired", "uv", "jump6h",
    ),
    "home_detail_uv_window": _sql(
        f"""SELECT {_ends()}, CAST(sum(CASE page_id WHEN 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_ct,
            CAST(sum(CASE page_id WHEN 'good_detail' THEN 1 ELSE 0 END) AS BIGINT) AS good_detail_uv_ct
        FROM (SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY mid, page_id ORDER BY ts, log_id) AS before
            FROM page_log WHERE page_id IN ('home', 'good_detail'))
        WHERE before IS NULL OR before <> CAST(ts AS DATE) GROUP BY time_bucket(INTERVAL '10 seconds', ts)""",
        "page_log",
    ),
    "login_back_window": _sql(
        f"""SELECT {_ends()}, CAST(sum(CASE WHEN date_diff('day', before, CAST(ts AS DATE)) >= 8 THEN 1 ELSE 0 END)
            AS BIGINT) AS back_ct, count(*) AS uu_ct
        FROM (SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY uid ORDER BY ts, log_id) AS before FROM signed_in)
        WHERE before IS NULL OR before <> CAST(ts AS DATE) GROUP BY time_bucket(INTERVAL '10 seconds', ts)""",
        "signed_in",
    ),
    "login_filter": _sql("SELECT log_id, uid, last_page_id FROM signed_in", "signed_in"),
    "returning_customers": """
        SELECT o_custkey AS custkey, strftime(d, '%Y-%m-%d') AS day, CAST(1 AS BIGINT) AS uu_ct,
            CAST(CASE WHEN date_diff('day', before, d) >= 8 THEN 1 ELSE 0 END AS BIGINT) AS back_ct
        FROM (SELECT o_custkey, d, lag(d) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS before
            FROM (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders))
        WHERE before IS NULL OR before <> d""",
    "dirty_split": _sql(
        """SELECT event_id, value, CASE WHEN json_valid(value) THEN 0 ELSE 1 END AS is_dirty FROM (
            SELECT event_id, CASE WHEN k % 17 = 5 THEN left(props, length(props) - 1) ELSE props END AS value FROM ev)""",
        "ev",
    ),
    "log_split_dirty": _sql("SELECT log_id FROM page_log WHERE k % 17 = 5", "page_log"),
    "log_split_page": _sql(
        f"""SELECT log_id, mid, uid, is_new, page_id, last_page_id, item, during_time, {_TS_MS}
        FROM readable_repaired WHERE {_ON_PAGE}""",
        "readable_repaired",
    ),
    "log_split_start": _sql(
        f"""SELECT log_id, mid, is_new, 'icon' AS entry, CAST(k * 10 AS BIGINT) AS loading_time, {_TS_MS}
        FROM readable_repaired WHERE NOT ({_ON_PAGE})""",
        "readable_repaired",
    ),
    "log_split_err": _sql(
        f"""SELECT log_id, mid, CAST(1000 + k AS BIGINT) AS error_code, 'failed' AS msg,
            CASE WHEN {_ON_PAGE} THEN page_id END AS page_id,
            CASE WHEN {_ON_PAGE} AND k % 4 > 0 THEN k % 4 END AS n_displays
        FROM readable WHERE event_type = 'error'""",
        "readable",
    ),
    "log_split_display": _sql(
        f"""SELECT log_id, mid, page_id, CASE WHEN i % 2 = 0 THEN 'query' ELSE 'promotion' END AS display_type,
            CAST(log_id * 10 + i AS VARCHAR) AS item, CAST(i AS INT) AS display_order, {_TS_MS}
        FROM (SELECT *, unnest(range(1, k % 4 + 1)) AS i FROM readable WHERE {_ON_PAGE} AND k % 4 > 0)""",
        "readable",
    ),
    "log_split_action": _sql(
        f"""SELECT log_id, mid, page_id, 'favor_add' AS action_id, CAST(k AS VARCHAR) AS item,
            epoch_us(ts) // 1000 + 500 AS action_ts FROM readable WHERE {_ON_PAGE} AND k % 3 = 1""",
        "readable",
    ),
    "log_split_topics": _sql(
        f"""SELECT topic, count(*) AS n_rows, count(DISTINCT mid) AS n_devices FROM (
            SELECT 'dwd_traffic_err_log' AS topic, mid FROM readable WHERE event_type = 'error'
            UNION ALL SELECT 'dwd_traffic_start_log', mid FROM readable WHERE NOT ({_ON_PAGE})
            UNION ALL SELECT 'dwd_traffic_page_log', mid FROM readable WHERE {_ON_PAGE}
            UNION ALL SELECT 'dwd_traffic_action_log', mid FROM readable WHERE {_ON_PAGE} AND k % 3 = 1
            UNION ALL SELECT 'dwd_traffic_display_log', mid
                FROM (SELECT mid, unnest(range(0, k % 4)) AS i FROM readable WHERE {_ON_PAGE})) GROUP BY topic""",
        "readable",
    ),
    "search_filter": _sql(
        """SELECT log_id, item FROM page_log
        WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL""",
        "page_log",
    ),
    "keyword_window": _sql(
        f"""SELECT {_ends()}, 'SEARCH' AS source, keyword, count(*) AS keyword_count
        FROM (SELECT ts, unnest(regexp_extract_all(lower(item), '[a-z0-9]+')) AS keyword FROM page_log
            WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL)
        GROUP BY time_bucket(INTERVAL '10 seconds', ts), keyword""",
        "page_log",
    ),
    "keyword_count_docs": r"""
        SELECT keyword, count(*) AS keyword_count
        FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9]+|[\x{4e00}-\x{9fff}]+')) AS keyword FROM documents)
        GROUP BY keyword""",
    "cdc_bootstrap_filter": _sql(
        """SELECT event_id, CASE k % 5 WHEN 3 THEN 'bootstrap-insert' ELSE 'update' END AS type,
            CAST(event_id AS VARCHAR) AS id
        FROM ev WHERE k % 5 > 2 AND k % 7 <> 0""",
        "ev",
    ),
    "cdc_changed_column": _sql(
        "SELECT oi_id AS id, order_status, old_status, oi_ts AS ts FROM order_info WHERE type = 'update'", "order_info"
    ),
    "upsert_latest": """
        SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_extendedprice, l_partkey,
            l_suppkey
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
        WHERE rn = 1""",
    "dim_config_apply": _sql(
        """SELECT 'table_' || CAST(user_id AS VARCHAR) AS source_table, 'dim_' || CAST(user_id AS VARCHAR) AS sink_table,
            'id,c' || CAST(k AS VARCHAR) AS sink_columns
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM ev)
        WHERE rn = 1 AND event_type <> 'purchase'""",
        "ev",
    ),
    "dim_routing": """
        SELECT 'dim_region' AS sink_table, 2 AS n_fields, CAST(r_regionkey AS VARCHAR) AS pk, r_name AS name,
            CAST(NULL AS VARCHAR) AS unlisted, CAST(NULL AS VARCHAR) AS region FROM region
        UNION ALL SELECT 'dim_nation', 3, CAST(n_nationkey AS VARCHAR), n_name, NULL, CAST(n_regionkey AS VARCHAR)
        FROM nation
        UNION ALL SELECT 'dim_part', 2, CAST(p_partkey AS VARCHAR), p_brand, NULL, NULL FROM part""",
    "cart_add_fact": _sql("SELECT * EXCLUDE (sec) FROM cart_fact", "cart_fact"),
    "cart_add_uu_window": _sql(
        f"""SELECT {_ends(ts="epoch_ms(sec * 1000)")}, count(*) AS cart_add_uu_ct FROM first_adds
        GROUP BY time_bucket(INTERVAL '10 seconds', epoch_ms(sec * 1000))""",
        "first_adds",
    ),
    "cart_add_users": _sql("SELECT user_id, ts FROM first_adds", "first_adds"),
    "order_pre_process": _sql("SELECT * FROM wide", "wide"),
    "order_state_latest": _sql(
        """SELECT id, order_id, user_id, order_status, type, coupon_id, split_total_amount, sku_id, source_id, sku_num,
            CAST(oi_ts AS BIGINT) AS changed_at
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CAST(oi_ts AS BIGINT) DESC, order_status DESC,
            split_total_amount DESC, sku_id DESC, source_id DESC, sku_num DESC) AS rn FROM wide) WHERE rn = 1""",
        "wide",
    ),
    "order_detail_fact": _sql("SELECT * FROM detail", "detail"),
    "order_cancel_fact": _sql(
        """SELECT id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
            operate_date_id AS date_id, operate_time AS cancel_time, source_id, source_type AS source_type_code,
            source_type_name, sku_num, split_original_amount, split_activity_amount, split_coupon_amount,
            split_total_amount, oi_ts AS ts
        FROM wide WHERE type = 'update' AND old_status IS NOT NULL AND order_status = '1003'""",
        "wide",
    ),
    "payment_fact": _sql("SELECT * EXCLUDE (payment_status) FROM paid", "paid"),
    "payment_success_fact": _sql(
        """SELECT order_detail_id, order_id, payment_type_name, callback_time, split_payment_amount
        FROM paid WHERE payment_status = '1602'""",
        "paid",
    ),
    "refund_fact": _sql(
        """SELECT id, r.user_id, order_id, sku_id, province_id, left(create_time, 10) AS date_id, create_time,
            refund_type AS refund_type_code, td.dic_name AS refund_type_name, reason_type AS refund_reason_type_code,
            rd.dic_name AS refund_reason_type_name, reason AS refund_reason_txt, refund_num, refund_amount, ts
        FROM returned r JOIN order_info ON order_id = oi_id JOIN dic td ON refund_type = td.dic_code
            JOIN dic rd ON reason_type = rd.dic_code
        WHERE type = 'update' AND order_status = '1005'""",
        "returned", "order_info", "dic",
    ),
    "refund_pay_fact": _sql(
        """SELECT p.id, o.user_id, p.order_id, p.sku_id, province_id, p.payment_type AS payment_type_code,
            dic_name AS payment_type_name, left(p.create_time, 10) AS date_id, p.create_time AS callback_time,
            l.refund_num, p.refund_amount, p.ts
        FROM returned p JOIN returned l ON p.order_id = l.order_id AND p.sku_id = l.sku_id
            JOIN order_info o ON p.order_id = oi_id JOIN dic ON p.payment_type = dic_code
        WHERE p.repaid AND l.finished AND type = 'update' AND order_status = '1006'""",
        "returned", "order_info", "dic",
    ),
    "refund_pay_latest": _sql(
        """SELECT id, order_id, sku_id, refund_num, refund_amount, sec FROM (
            SELECT p.id, p.order_id, p.sku_id, l.refund_num, p.refund_amount, CAST(p.ts AS BIGINT) AS sec,
                row_number() OVER (PARTITION BY p.id ORDER BY CAST(p.ts AS BIGINT) DESC, l.refund_num DESC,
                    p.refund_amount DESC, p.sku_id DESC) AS rn
            FROM returned p JOIN returned l ON p.order_id = l.order_id AND p.sku_id = l.sku_id
                JOIN order_info o ON p.order_id = oi_id JOIN dic ON p.payment_type = dic_code
            WHERE p.repaid AND l.finished AND type = 'update' AND order_status = '1006') WHERE rn = 1""",
        "returned", "order_info", "dic",
    ),
    "order_uu_flag": _sql(
        "SELECT id, user_id, sku_id, CAST(uu AS BIGINT) AS order_uu_count FROM flagged", "flagged"
    ),
    "sku_order_window": _sql(
        f"""SELECT r.*, p_name AS sku_name, p_type AS spu_id, p_brand AS trademark_id,
            CAST(p_partkey % 100 AS VARCHAR) AS category3_id
        FROM ({_sku_report('10 seconds')}) r LEFT JOIN part ON sku_id = CAST(p_partkey AS VARCHAR)""",
        "flagged",
    ),
    "sku_order_day": _sql(_sku_report("1 day"), "flagged"),
    "sku_dim_chain": """
        SELECT CAST(l_partkey AS VARCHAR) AS sku_id, round(CAST(amount AS DOUBLE), 4) AS order_amount,
            p_name AS sku_name, p_type AS spu_id, p_brand AS trademark_id, CAST(p_partkey % 100 AS VARCHAR) AS category3_id,
            lower(p_type) AS spu_name, upper(p_brand) AS trademark_name, s_name AS category3_name,
            CAST(s_nationkey AS VARCHAR) AS category2_id, n_name AS category2_name,
            CAST(n_regionkey AS VARCHAR) AS category1_id, r_name AS category1_name
        FROM (SELECT l_partkey, sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS amount FROM lineitem GROUP BY l_partkey)
            LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON p_partkey % 100 = s_suppkey
            LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "join_inner": _sql(
        "SELECT o_orderkey, o_custkey, o_orderstatus, c_key, c_name FROM orders JOIN sides ON o_custkey = c_key", "sides"
    ),
    "join_left": _sql(
        "SELECT o_orderkey, o_custkey, o_orderstatus, c_key, c_name FROM orders LEFT JOIN sides ON o_custkey = c_key",
        "sides",
    ),
    "join_right": _sql(
        "SELECT o_orderkey, o_custkey, o_orderstatus, c_key, c_name FROM orders RIGHT JOIN sides ON o_custkey = c_key",
        "sides",
    ),
    "join_full": _sql(
        "SELECT o_orderkey, o_custkey, o_orderstatus, c_key, c_name FROM orders FULL JOIN sides ON o_custkey = c_key",
        "sides",
    ),
    "join_interval": _sql(
        """SELECT click_id, buy_id, c_user FROM click JOIN buy ON c_user = b_user
            AND b_ts BETWEEN c_ts - INTERVAL '1 hour' AND c_ts + INTERVAL '1 hour'""",
        "click", "buy",
    ),
    "join_interval_left": _sql(
        """SELECT click_id, buy_id, c_user FROM click LEFT JOIN buy ON c_user = b_user
            AND b_ts BETWEEN c_ts - INTERVAL '1 hour' AND c_ts + INTERVAL '1 hour'""",
        "click", "buy",
    ),
    "join_interval_right": _sql(
        """SELECT click_id, buy_id, b_user FROM click RIGHT JOIN buy ON c_user = b_user
            AND b_ts BETWEEN c_ts - INTERVAL '1 hour' AND c_ts + INTERVAL '1 hour'""",
        "click", "buy",
    ),
    "join_interval_full": _sql(
        """SELECT click_id, buy_id FROM click FULL JOIN buy ON c_user = b_user
            AND b_ts BETWEEN c_ts - INTERVAL '1 hour' AND c_ts + INTERVAL '1 hour'""",
        "click", "buy",
    ),
    "join_retention": _sql(
        """SELECT oi_id, payment_type, callback_time AS paid_at FROM order_info JOIN payment ON oi_id = pi_order_id
            AND CAST(pi_ts AS BIGINT) BETWEEN CAST(oi_ts AS BIGINT) - 905 AND CAST(oi_ts AS BIGINT) + 8105
        WHERE type = 'insert'""",
        "order_info", "payment",
    ),
    "join_lookup": _sql(
        """SELECT event_id, code, dic_name AS source_name
        FROM (SELECT event_id, CAST(k % 5 + 2401 AS VARCHAR) AS code FROM ev) JOIN dic ON code = dic_code""",
        "ev", "dic",
    ),
    "dim_lookup": """
        SELECT l_partkey AS p_partkey, CAST(l_linenumber * 5 AS INT) AS p_size, p_name
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND l_linenumber * 5 = p_size""",
    "time_columns": f"""
        SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, {_HMS}) AS at, strftime(ts, {_HMS}) AS at_second,
            strftime(ts, '%Y-%m-%d') AS day_of_text,
            epoch_ms(date_trunc('day', ts)) - 28800000 AS midnight_east8,
            CAST(floor(epoch(ts)) AS BIGINT) * 1000 - 28800000 AS ms_east8
        FROM events""",
    "operation_time_order": _sql(
        """SELECT event_id, CASE WHEN
            CASE k % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 0.04 ELSE 0.049 END >= CAST('0.0' || CAST(k AS VARCHAR) AS DOUBLE)
            THEN 1 ELSE 0 END AS not_before FROM ev""",
        "ev",
    ),
}

# The streams must end in the rows of the same rule on tables.
ORACLE["stream_page_window"] = ORACLE["traffic_page_window"]
ORACLE["stream_keyword_window"] = ORACLE["keyword_window"]
ORACLE["stream_new_visitor_repair"] = ORACLE["new_visitor_repair"]
ORACLE["stream_unique_visitor"] = ORACLE["unique_visitor_detail"]
ORACLE["stream_user_jump"] = ORACLE["user_jump_10s"]
ORACLE["stream_home_detail"] = ORACLE["home_detail_uv_window"]
ORACLE["stream_login_back"] = ORACLE["login_back_window"]
ORACLE["stream_cart_add_window"] = ORACLE["cart_add_uu_window"]
ORACLE["stream_join_interval"] = _sql(
    """SELECT l.mid AS l_mid, l.log_id AS l_id, r.log_id AS r_id FROM page_log l JOIN page_log r ON l.mid = r.mid
    AND l.page_id = 'home' AND r.page_id = 'good_detail'
    AND r.ts BETWEEN l.ts - INTERVAL '1 hour' AND l.ts + INTERVAL '1 hour'""",
    "page_log",
)
ORACLE["sku_order_full"] = _sql(
    f"""SELECT r.*, p_name AS sku_name, p_type AS spu_id, p_brand AS trademark_id, CAST(p_partkey % 100 AS VARCHAR) AS category3_id,
        lower(p_type) AS spu_name, upper(p_brand) AS trademark_name, s_name AS category3_name,
        CAST(s_nationkey AS VARCHAR) AS category2_id, n_name AS category2_name,
        CAST(n_regionkey AS VARCHAR) AS category1_id, r_name AS category1_name
    FROM ({_sku_report('10 seconds')}) r LEFT JOIN part ON sku_id = CAST(p_partkey AS VARCHAR)
        LEFT JOIN supplier ON p_partkey % 100 = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "flagged",
)
ORACLE["dim_tables"] = """
    SELECT 'dim_region' AS sink_table, CAST(r_regionkey AS VARCHAR) AS pk, r_name AS name FROM region
    UNION ALL SELECT 'dim_nation', CAST(n_nationkey AS VARCHAR), n_name FROM nation
    UNION ALL SELECT 'dim_part', CAST(p_partkey AS VARCHAR), p_brand FROM part"""
ORACLE["cart_add_from_json"] = ORACLE["cart_add_fact"]
ORACLE["stream_join_left"] = ORACLE["join_left"]

_AS_OF = """
    WITH ev AS (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events),
    names AS (
        SELECT CAST(2401 + k % 5 AS VARCHAR) AS code, ts, max_by('source of ' || event_id, event_id) AS dic_name,
            max_by(event_type = 'error' AND event_id % 3 = 0, event_id) AS gone
        FROM ev WHERE event_type IN ('signup', 'error') GROUP BY ALL),
    carts AS (
        SELECT event_id AS log_id, CASE WHEN k % 13 <> 4 THEN CAST(2401 + k % 5 AS VARCHAR) END AS source_type, ts
        FROM ev WHERE event_type IN ('click', 'view'))
    SELECT log_id, source_type, CASE WHEN NOT gone THEN dic_name END AS dic_name
    FROM carts c ASOF LEFT JOIN names n ON c.source_type = n.code AND c.ts >= n.ts"""
ORACLE["lookup_as_of"] = _AS_OF
ORACLE["lookup_as_of_ranges"] = _AS_OF + " WHERE NOT gone"
ORACLE["dim_routing_as_of"] = """
    WITH ev AS (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events),
    config AS (
        SELECT user_id % 40 AS t, epoch_ms(ts) AS ms, max_by({'op': event_type, 'k': k}, event_id) AS entry
        FROM ev WHERE event_type IN ('signup', 'error', 'purchase') GROUP BY ALL),
    changes AS (SELECT event_id, k, user_id, user_id % 40 AS t, CAST(floor(epoch_ms(ts) / 1000) AS BIGINT) * 1000 AS ms FROM ev WHERE event_type IN ('view', 'click'))
    SELECT CAST(event_id AS VARCHAR) AS log_id, 'dim_' || entry.k % 4 || '_' || c.t AS sink_table, 'id' AS sink_pk,
        CAST(entry.k % 3 + 1 AS INT) AS n_fields,
        CASE WHEN entry.k % 3 > 0 THEN CAST(c.k AS VARCHAR) END AS k, CASE WHEN entry.k % 3 = 2 THEN CAST(user_id AS VARCHAR) END AS user_id
    FROM changes c ASOF JOIN config g ON c.t = g.t AND c.ms >= g.ms WHERE entry.op <> 'purchase'"""
ORACLE["dim_routing_as_of_chunks"] = ORACLE["dim_routing_as_of"]

# Keyed state over rows in order of time ends in the rows of the same rule on tables.
ORACLE["keyed_new_visitor_repair"] = ORACLE["new_visitor_repair"]
ORACLE["keyed_unique_visitor"] = ORACLE["unique_visitor_detail"]
ORACLE["keyed_user_jump"] = ORACLE["user_jump_10s"]
ORACLE["keyed_home_detail"] = ORACLE["home_detail_uv_window"]
ORACLE["keyed_login_back"] = ORACLE["login_back_window"]
ORACLE["keyed_sku_order_window"] = ORACLE["sku_order_window"]
ORACLE["stream_upsert"] = ORACLE["upsert_latest"]
ORACLE["stream_delivery"] = _sql(f"SELECT log_id, mid, page_id, {_TS_MS}, CAST(log_id % 3 AS INT) AS batch_id FROM page_log", "page_log")
ORACLE["keyword_count_lateral"] = ORACLE["keyword_count_docs"]
ORACLE["words_by_list"] = r"""
    WITH RECURSIVE listed AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM documents),
    texts AS (SELECT DISTINCT lower(replace(p_name, ' ', '') || p_type) AS t FROM part),
    best AS (
        SELECT t, p.place, max(s.size) AS size FROM texts, range(1, 65) AS p(place), range(1, 13) AS s(size)
        WHERE p.place + s.size - 1 <= length(t) AND substr(t, p.place, s.size) IN (SELECT w FROM listed) GROUP BY t, p.place),
    sized AS (
        SELECT t, p.place, coalesce(size, 1) AS size, size IS NOT NULL OR regexp_matches(substr(t, p.place, 1), '[\p{L}\p{N}]') AS known
        FROM (SELECT t, r.place FROM texts, range(1, 65) AS r(place) WHERE r.place <= length(t)) p LEFT JOIN best USING (t, place)),
    walk AS (
        SELECT t, 1::BIGINT AS place, '' AS words FROM texts
        UNION ALL SELECT w.t, w.place + s.size, w.words || CASE WHEN s.known THEN '|' || substr(w.t, w.place, s.size) ELSE '' END
        FROM walk w JOIN sized s ON w.t = s.t AND w.place = s.place)
    SELECT p_partkey, substr(words, 2) AS words FROM part JOIN walk ON t = lower(replace(p_name, ' ', '') || p_type) AND walk.place = length(t) + 1"""
ORACLE["snapshot_cut_over"] = _sql(
    "SELECT user_id, max_by(k, event_id) AS k FROM ev GROUP BY user_id HAVING max_by(event_type, event_id) <> 'purchase'", "ev"
)
