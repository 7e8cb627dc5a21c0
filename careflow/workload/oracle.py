"""The queries again, in SQL for another engine, over the same tables."""

from __future__ import annotations

from careflow.plans.facts import FACTS

# Common table expressions that read the test tables as the warehouse's inputs.
EV = """ev AS (
    SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(16,2)) AS fee,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS written,
           CAST(event_id AS VARCHAR) AS id, CAST(event_id % 10 AS VARCHAR) AS doctor_id,
           CAST(user_id AS VARCHAR) AS user_text
    FROM events)"""
DOCTOR = """doctor AS (
    SELECT CAST(s_suppkey AS VARCHAR) AS id, CAST(s_nationkey AS VARCHAR) AS hospital_id FROM supplier)"""
HOSPITAL = "hospital AS (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation)"
DICTIONARY = "dictionary AS (SELECT * FROM (VALUES ('101', '男'), ('102', '女')) AS t(id, value))"


def band(age: str) -> str:
    return f"""CASE WHEN {age} >= 0 AND {age} <= 2 THEN '婴儿期' WHEN {age} <= 5 THEN '幼儿期'
        WHEN {age} <= 11 THEN '小学阶段' WHEN {age} <= 17 THEN '青少年期' WHEN {age} <= 29 THEN '青年期'
        WHEN {age} <= 59 THEN '中年期' WHEN {age} > 60 THEN '老年期' ELSE '年龄异常' END"""


def years(born: str) -> str:
    """Whole years, by counting the anniversaries passed (Feb 29 has one in leap years only)."""
    return (
        f"(year(DATE '2024-02-01') - year({born}) - CASE WHEN month({born}) * 100 + day({born}) > 201 "
        f"THEN 1 ELSE 0 END)"
    )


BORN = "(DATE '1930-01-01' + CAST(c_custkey * 7919 % 34000 AS INT))"
PATIENT = f"""patient AS (
    SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(101 + c_custkey % 2 AS VARCHAR) AS gender,
           {BORN} AS born, CASE WHEN {BORN} <= DATE '2024-02-01' THEN {years(BORN)}
           ELSE -date_sub('year', DATE '2024-02-01', {BORN}) END AS age
    FROM customer)"""

PRESCRIPTION = """pre AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS total_amount,
           CAST(o_orderkey % 10 AS VARCHAR) AS doctor_id, CAST(o_custkey AS VARCHAR) AS patient_id
    FROM orders),
det AS (
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id,
           l_shipdate AS ts, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS written,
           CAST(CAST(l_quantity AS INT) AS VARCHAR) AS count, CAST(l_partkey AS VARCHAR) AS medicine_id,
           CAST(l_orderkey AS VARCHAR) AS prescription_id
    FROM lineitem)"""


def paid(before: str, after: str) -> str:
    return f"""paid AS (
    SELECT d.id, p.written AS prescription_pay_suc_time, p.ts AS pay_ts, CAST(1 + d.event_id % 5 AS VARCHAR) AS count,
           CAST(d.event_id % 97 AS VARCHAR) AS medicine_id, d.user_text AS prescription_id,
           p.fee, CAST(p.fee AS VARCHAR) AS total_amount, p.id AS consultation_id, p.doctor_id,
           p.user_text AS patient_id
    FROM ev d JOIN ev p ON d.user_id = p.user_id AND d.event_type = 'click' AND p.event_type = 'purchase'
         AND d.ts >= p.ts - INTERVAL {before} AND d.ts <= p.ts + INTERVAL {after})"""


PAID_NARROW = paid("15 MINUTES", "5 SECONDS")
PAID_WIDE = paid("1 DAY", "1 HOUR")
PAID_COLUMNS = (
    "id, prescription_pay_suc_time, count, medicine_id, prescription_id, total_amount, consultation_id, "
    "doctor_id, patient_id"
)


def bucket(size: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{size}', {ts}, TIMESTAMP '1970-01-01')"


def bounds(size: str, start: str = "w") -> str:
    return (
        f"strftime({start}, '%Y-%m-%d %H:%M:%S') AS stt, "
        f"strftime({start} + INTERVAL '{size}', '%Y-%m-%d %H:%M:%S') AS edt, "
        f"strftime({start}, '%Y-%m-%d') AS cur_date"
    )


def trade(rows: str, measure: str, size: str) -> str:
    """Sum and count of ``rows`` (columns ts, doctor_id, patient_id, amount) per hospital, gender and band."""
    return f"""grouped AS (
    SELECT {bucket(size)} AS w, d.hospital_id, p.gender, {band('p.age')} AS age_group,
           SUM(r.amount) AS amount, COUNT(*) AS n
    FROM ({rows}) r LEFT JOIN doctor d ON r.doctor_id = d.id LEFT JOIN patient p ON r.patient_id = p.id
    GROUP BY ALL)
SELECT {bounds(size)}, g.hospital_id, h.name AS hospital_name, g.gender AS patient_gender_code,
       t.value AS patient_gender, g.age_group, CAST(g.amount AS DOUBLE) AS {measure}_amount,
       CAST(g.n AS BIGINT) AS {measure}_count
FROM grouped g LEFT JOIN hospital h ON g.hospital_id = h.id LEFT JOIN dictionary t ON g.gender = t.id"""


def visits(kind: str, measure: str, size: str) -> str:
    rows = f"""SELECT ts, doctor_id, user_text AS patient_id, fee AS amount FROM ev
               WHERE event_type = '{kind}'"""
    return f"WITH {EV}, {DOCTOR}, {PATIENT}, {HOSPITAL}, {DICTIONARY}, {trade(rows, measure, size)}"


def prescriptions(size: str) -> str:
    rows = """SELECT MIN(date_trunc('second', det.ts)) AS ts, pre.doctor_id, pre.patient_id,
                     CAST(pre.total_amount AS DECIMAL(16,2)) AS amount
              FROM det JOIN pre ON det.prescription_id = pre.id
              GROUP BY pre.id, pre.doctor_id, pre.patient_id, pre.total_amount"""
    return (
        f"WITH {PRESCRIPTION}, {DOCTOR}, {PATIENT}, {HOSPITAL}, {DICTIONARY}, "
        f"{trade(rows, 'prescription', size)}"
    )


def prescriptions_paid(joined: str, size: str) -> str:
    rows = """SELECT date_trunc('second', pay_ts) AS ts, doctor_id, patient_id, fee AS amount FROM paid
              QUALIFY ROW_NUMBER() OVER (PARTITION BY prescription_id
                  ORDER BY date_trunc('second', pay_ts), id, doctor_id, patient_id, fee) = 1"""
    return (
        f"WITH {EV}, {joined}, {DOCTOR}, {PATIENT}, {HOSPITAL}, {DICTIONARY}, "
        f"{trade(rows, 'prescription_pay_suc', size)}"
    )


def counts(rest: int, measure: str, size: str) -> str:
    return f"""SELECT {bounds(size)}, n AS {measure} FROM (
    SELECT {bucket(size)} AS w, CAST(COUNT(*) AS BIGINT) AS n FROM events
    WHERE event_type = 'signup' AND event_id % 3 = {rest} GROUP BY 1)"""


def reviews(size: str) -> str:
    return f"""WITH {EV}, {DOCTOR}, {HOSPITAL}, flagged AS (
    SELECT ev.ts, d.hospital_id, 1 + (ev.event_id // 10) % 5 AS rating,
           ROW_NUMBER() OVER (PARTITION BY ev.user_id, d.hospital_id ORDER BY ev.ts, ev.event_id) = 1 AS is_first
    FROM ev LEFT JOIN doctor d ON ev.doctor_id = d.id WHERE ev.event_type = 'view'),
grouped AS (
    SELECT {bucket(size)} AS w, hospital_id, CAST(SUM(CASE WHEN is_first THEN 1 ELSE 0 END) AS BIGINT) AS fresh,
           CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(CASE WHEN rating = 5 THEN 1 ELSE 0 END) AS BIGINT) AS good
    FROM flagged GROUP BY 1, 2)
SELECT {bounds(size)}, g.hospital_id, h.name AS hospital_name, g.fresh AS review_new_user_count,
       g.n AS review_count, g.good AS good_review_count
FROM grouped g LEFT JOIN hospital h ON g.hospital_id = h.id"""


def windowed(size: str, keys: str = "", where: str = "") -> str:
    keys = f", {keys}" if keys else ""
    return f"""SELECT {bounds(size)}{keys}, n FROM (
    SELECT {bucket(size)} AS w{keys}, CAST(COUNT(*) AS BIGINT) AS n FROM events GROUP BY ALL) {where}"""


def closed(size: str) -> str:
    """Windows that a stream has given out by the end."""
    return f"WHERE w + INTERVAL '{size}' <= (SELECT MAX(ts) FROM events) - INTERVAL 5 SECONDS"


READABLE = "event_id % 19 <> 0 AND event_id % 23 <> 0"

CHANGES = """changes AS (
    SELECT o_orderkey AS seq, o_custkey, CAST(o_custkey AS VARCHAR) AS row_key, o_custkey % 7 AS source,
           CASE WHEN o_orderkey % 11 = 0 THEN 'delete' WHEN o_orderkey % 13 = 0 THEN 'bootstrap-start'
                WHEN o_orderkey % 3 = 1 THEN 'update' ELSE 'insert' END AS change_type,
           CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS a,
           CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS b
    FROM orders)"""
ROUTED = f"""{CHANGES}, routed AS (
    SELECT 'dim_' || n_name AS sink_table, row_key, change_type, seq,
           CASE WHEN change_type = 'delete' THEN 'id,a,b,extra' WHEN source % 2 = 0 THEN 'id,a' ELSE 'id,b' END AS kept,
           CASE WHEN change_type = 'delete' OR source % 2 = 0 THEN a END AS a,
           CASE WHEN change_type = 'delete' OR source % 2 = 1 THEN b END AS b
    FROM changes JOIN nation ON source = n_nationkey
    WHERE n_nationkey < 5 AND change_type <> 'bootstrap-start')"""


def folded(keys: str, rows: str) -> str:
    """Last value of each column after the last delete."""
    return f"""SELECT {keys}, arg_max(a, seq) FILTER (WHERE a IS NOT NULL) AS a,
    arg_max(b, seq) FILTER (WHERE b IS NOT NULL) AS b, MAX(seq) AS seq
FROM (SELECT *, MAX(CASE WHEN change_type = 'delete' THEN seq END) OVER (PARTITION BY {keys}) AS gone FROM {rows})
WHERE change_type <> 'delete' AND (gone IS NULL OR seq > gone) GROUP BY {keys}"""


ORDER_CHANGES = """(SELECT o_custkey AS row_key, o_orderkey AS seq,
    CASE WHEN o_orderkey % 11 = 0 THEN 'delete' ELSE 'update' END AS change_type,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS a,
    CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS b FROM orders)"""

CONFIG = """config AS (
    SELECT o_orderkey AS seq, o_orderkey % 5 AS op, o_custkey AS old_key,
           CASE WHEN o_orderkey % 4 = 1 THEN o_custkey + 1 ELSE o_custkey END AS new_key,
           'dim_' || o_orderstatus || '_' || (o_custkey % 50) AS sink_table,
           'id,c' || (o_orderkey % 9) AS sink_columns
    FROM orders)"""


def visit_fact(kind: str, time: str, fields: str = "CAST(fee AS VARCHAR) AS consultation_fee", where: str = "") -> str:
    return f"""WITH {EV} SELECT id, written AS {time}, {fields}, doctor_id, user_text AS patient_id,
    user_text AS user_id FROM ev WHERE event_type = '{kind}' {where}"""


PERSON_BORN = "strftime(DATE '1930-01-01' + CAST(event_id * 7919 % 34000 AS INT), '%Y-%m-%d') AS birthday"
PERSON_GENDER = "CAST(101 + event_id % 2 AS VARCHAR) AS gender"

ORACLE: dict[str, str] = {
    "ods_decode": f"""WITH {EV} SELECT event_id, event_type AS source_table, 'insert' AS change_type, id,
        written AS time, value AS amount, CAST(NULL AS VARCHAR) AS nothing, TRUE AS no_old
        FROM ev JOIN (SELECT event_id, value FROM events) USING (event_id)
        WHERE {READABLE} AND event_id % 17 <> 0""",
    "ods_decode_keys": f"""SELECT event_id, CAST(event_id AS VARCHAR) AS id, value AS amount
        FROM events WHERE {READABLE} AND event_id % 17 <> 0""",
    "ods_rejected": f"""SELECT event_type, CAST(COUNT(*) AS BIGINT) AS n FROM events
        WHERE {READABLE} AND event_id % 17 = 0 GROUP BY 1""",
    "ods_drop_tombstones": f"SELECT event_id, event_type FROM events WHERE {READABLE}",
    "config_latest": f"""WITH {CONFIG}, steps AS (
        SELECT seq, old_key AS k, 0 AS live, NULL AS sink_table, NULL AS sink_columns FROM config
        WHERE op = 4 OR (op IN (2, 3) AND old_key <> new_key)
        UNION ALL SELECT seq, new_key, 1, sink_table, sink_columns FROM config WHERE op <> 4)
        SELECT 'source_' || k AS source_table, sink_table, 'info' AS sink_family, sink_columns,
               'id' AS sink_row_key
        FROM (SELECT * FROM steps QUALIFY ROW_NUMBER() OVER (PARTITION BY k ORDER BY seq DESC) = 1)
        WHERE live = 1""",
    "config_lifecycle": f"""WITH {CONFIG} SELECT sink_table, arg_max(op, seq) <> 4 AS is_live,
        MAX(CASE WHEN op IN (2, 3, 4) THEN seq END) AS last_drop_seq FROM config GROUP BY 1""",
    "dim_route": f"WITH {ROUTED} SELECT * FROM routed",
    "dim_prune_columns": f"""WITH {CHANGES} SELECT seq,
        CASE seq % 3 WHEN 0 THEN 'id,a' WHEN 1 THEN 'b,extra' ELSE 'id' END AS kept,
        CASE WHEN seq % 3 <> 1 THEN row_key END AS id, CASE WHEN seq % 3 = 0 THEN a END AS a,
        CASE WHEN seq % 3 = 1 THEN b END AS b, CASE WHEN seq % 3 = 1 THEN CAST(seq AS VARCHAR) END AS extra
        FROM changes WHERE seq % 22 <> 0""",
    "dim_upsert_latest": folded("row_key", ORDER_CHANGES),
    "dim_delete": f"""SELECT row_key, MAX(seq) FILTER (WHERE change_type = 'delete') AS deleted_seq
        FROM {ORDER_CHANGES} GROUP BY 1 HAVING arg_max(change_type, seq) = 'delete'""",
    "dim_tables": f"WITH {ROUTED} {folded('sink_table, row_key', 'routed')}",
    "fact_consultation": visit_fact("click", "create_time"),
    "fact_consultation_paid": visit_fact("purchase", "consultation_pay_suc_time"),
    "fact_consultation_paid_transition": visit_fact(
        "purchase", "consultation_pay_suc_time", where="AND event_id % 4 <> 0"
    ),
    "fact_review": visit_fact(
        "view", "review_time", "CAST(1 + (event_id // 10) % 5 AS VARCHAR) AS rating"
    ),
    "fact_prescription": f"""WITH {PRESCRIPTION} SELECT det.id, det.written AS prescription_time, det.count,
        det.medicine_id, det.prescription_id, pre.total_amount, pre.id AS consultation_id, pre.doctor_id,
        pre.patient_id FROM det JOIN pre ON det.prescription_id = pre.id""",
    "fact_typed_decode": f"""WITH {PRESCRIPTION} SELECT det.id, det.prescription_id,
        CAST(det.count AS INT) AS count, CAST(pre.total_amount AS DOUBLE) AS total_amount,
        strftime(det.ts, '%Y-%m-%d %H:%M:%S') AS event_time
        FROM det JOIN pre ON det.prescription_id = pre.id""",
    "fact_prescription_paid": f"WITH {EV}, {PAID_NARROW} SELECT {PAID_COLUMNS} FROM paid",
    "fact_prescription_paid_wide": f"WITH {EV}, {PAID_WIDE} SELECT {PAID_COLUMNS} FROM paid",
    "fact_user_register": f"""WITH {EV} SELECT id, written AS register_time,
        CASE WHEN event_id % 10 <> 0 THEN '*@mail' || (event_id % 7) || '.example' END AS email,
        left(CAST(13000000000 + event_id AS VARCHAR), 3) || '********' AS telephone,
        'user' || user_id AS username
        FROM ev WHERE event_type = 'signup' AND event_id % 3 = 0""",
    "fact_patient_add": f"""WITH {EV} SELECT id, written AS add_time, {PERSON_BORN}, {PERSON_GENDER},
        chr(CAST(65 + event_id % 26 AS INT)) || '*' AS name, user_text AS user_id
        FROM ev WHERE event_type = 'signup' AND event_id % 3 = 1""",
    "fact_doctor_register": f"""WITH {EV} SELECT id, written AS create_time, {PERSON_BORN},
        CAST(fee AS VARCHAR) AS consultation_fee, {PERSON_GENDER}, 'doctor' || event_id AS name,
        CAST(300 + event_id % 20 AS VARCHAR) AS specialty, CAST(400 + event_id % 4 AS VARCHAR) AS title,
        CAST(event_id % 25 AS VARCHAR) AS hospital_id
        FROM ev WHERE event_type = 'signup' AND event_id % 3 = 2""",
    "mask_email": """SELECT c_custkey,
        CASE WHEN c_custkey % 10 <> 0 THEN '*@' || lower(c_mktsegment) || '.example' END AS email
        FROM customer""",
    "mask_phone": """SELECT c_custkey, left(CAST(13000000000 + c_custkey AS VARCHAR), 3) || '********' AS phone
        FROM customer""",
    "mask_name": "SELECT c_custkey, left(c_name, 1) || '*' AS name FROM customer",
    "parse_event_time": """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS event_time,
        TRUE AS other_is_null FROM events""",
    "window_bounds": f"SELECT event_id, {bounds('10 seconds', bucket('10 seconds'))} FROM events",
    "age_group": f"""WITH {PATIENT} SELECT CAST(id AS BIGINT) AS c_custkey, CAST(age AS INT) AS age,
        {band('age')} AS age_group,
        CASE WHEN age < 0 THEN '年龄异常' WHEN age >= 60 THEN '老年期' ELSE {band('age')} END AS age_group_repaired
        FROM patient""",
    "interval_join_events": """SELECT d.event_id AS detail_id, p.event_id AS payment_id, d.user_id
        FROM events d JOIN events p ON d.user_id = p.user_id AND d.event_type = 'click'
        AND p.event_type = 'purchase' AND d.ts >= p.ts - INTERVAL 1 DAY AND d.ts <= p.ts + INTERVAL 1 HOUR""",
    "lookup_doctor_hospital": f"""WITH {EV}, {DOCTOR} SELECT ev.id, ev.doctor_id, d.hospital_id
        FROM ev LEFT JOIN doctor d ON ev.doctor_id = d.id WHERE event_type = 'click'""",
    "lookup_patient_age_group": f"""WITH {EV}, {PATIENT} SELECT ev.id, ev.user_text AS patient_id, p.gender,
        {band('p.age')} AS age_group
        FROM ev LEFT JOIN patient p ON ev.user_text = p.id WHERE event_type = 'click'""",
    "tumbling_keyed": windowed("10 seconds", "event_type"),
    "tumbling_keyed_daily": windowed("1 day", "event_type"),
    "tumbling_global": windowed("10 seconds"),
    "tumbling_global_daily": windowed("1 day"),
    "first_detail_per_prescription": """SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped,
        l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
        QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey
            ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity) = 1""",
    "first_review_flag": f"""WITH {EV}, {DOCTOR} SELECT ev.id, ev.written AS review_time, ev.doctor_id,
        ev.user_text AS user_id, d.hospital_id, CAST(CASE WHEN ROW_NUMBER() OVER (
            PARTITION BY ev.user_id, d.hospital_id ORDER BY ev.ts, ev.id) = 1 THEN 1 ELSE 0 END AS BIGINT) AS is_first
        FROM ev LEFT JOIN doctor d ON ev.doctor_id = d.id WHERE event_type = 'view'""",
    "summary_consultation": visits("click", "consultation", "10 seconds"),
    "summary_consultation_daily": visits("click", "consultation", "1 day"),
    "summary_consultation_paid": visits("purchase", "consultation_pay_suc", "10 seconds"),
    "summary_consultation_paid_daily": visits("purchase", "consultation_pay_suc", "1 day"),
    "summary_prescription": prescriptions("10 seconds"),
    "summary_prescription_monthly": prescriptions("30 days"),
    "summary_prescription_paid": prescriptions_paid(PAID_NARROW, "10 seconds"),
    "summary_prescription_paid_daily": prescriptions_paid(PAID_WIDE, "1 day"),
    "summary_user_register": counts(0, "register_user_count", "10 seconds"),
    "summary_user_register_daily": counts(0, "register_user_count", "1 day"),
    "summary_patient_add": counts(1, "patient_add_count", "10 seconds"),
    "summary_patient_add_daily": counts(1, "patient_add_count", "1 day"),
    "summary_doctor_register": counts(2, "register_count", "10 seconds"),
    "summary_doctor_register_daily": counts(2, "register_count", "1 day"),
    "summary_reviews": reviews("10 seconds"),
    "summary_reviews_daily": reviews("1 day"),
    "summary_json": f"""SELECT '{{"stt":"' || stt || '","edt":"' || edt || '","cur_date":"' || cur_date
        || '","hospital_id":"' || hospital_id || '","hospital_name":"' || hospital_name
        || '","review_new_user_count":' || review_new_user_count || ',"review_count":' || review_count
        || ',"good_review_count":' || good_review_count || '}}' AS value
        FROM ({reviews('1 day')})""",
    "stream_tumbling": windowed("10 seconds", "event_type", closed("10 seconds")),
    "stream_late_drop": windowed("1 hour", "", closed("1 hour")),
    "stream_summary_consultation": f"""SELECT * FROM ({visits("click", "consultation", "10 seconds")})
        WHERE CAST(edt AS TIMESTAMP) <= (SELECT MAX(date_trunc('second', ts)) FROM events
            WHERE event_type = 'click') - INTERVAL 5 SECONDS""",
    "stream_fact_prescription_paid": f"WITH {EV}, {PAID_WIDE} SELECT {PAID_COLUMNS} FROM paid",
}

# Other ways to the same results.
ORACLE["dim_store"] = f"SELECT sink_table, row_key, a, b FROM ({ORACLE['dim_tables']})"
ORACLE["dim_store_late_put"] = ORACLE["dim_store"]
ORACLE["dim_store_some_keys"] = f"""SELECT row_key, a, b FROM ({ORACLE['dim_tables']})
    WHERE sink_table = (SELECT min('dim_' || n_name) FROM nation WHERE n_nationkey < 5)
    AND row_key IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderkey % 7 = 0)"""
ORACLE["summary_two_runs"] = ORACLE["summary_reviews_daily"]
ORACLE["fact_from_landed_log"] = ORACLE["fact_consultation"]
ORACLE["fact_through_topic"] = ORACLE["fact_doctor_register"]
ORACLE["lookup_salted"] = ORACLE["lookup_doctor_hospital"]
ORACLE["summary_consultation_ids_first"] = ORACLE["summary_consultation_daily"]
ORACLE["summary_table"] = ORACLE["summary_reviews_daily"]
ORACLE["stream_first_row"] = """SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS seen, value FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1"""
ORACLE["stream_ttl_join"] = """SELECT c.event_id AS click_id, v.event_id AS view_id
    FROM events c JOIN events v ON c.user_id = v.user_id AND c.event_type = 'click' AND v.event_type = 'view'
    AND c.ts BETWEEN v.ts - INTERVAL 1 DAY AND v.ts + INTERVAL 1 DAY"""
ORACLE["stream_dimensions"] = f"""SELECT sink_table, row_key, a, b FROM (WITH {ROUTED}, taken AS (
    SELECT * FROM routed WHERE seq % 2 = 0 OR sink_table <> (SELECT 'dim_' || n_name FROM nation WHERE n_nationkey = 4))
    {folded('sink_table, row_key', 'taken')})"""
ORACLE["config_preloaded"] = f"""WITH {CONFIG}, steps AS (
    SELECT seq, old_key AS k, 0 AS live, NULL AS sink_table, NULL AS sink_columns FROM config
    WHERE seq % 2 = 0 AND (op = 4 OR (op IN (2, 3) AND old_key <> new_key))
    UNION ALL SELECT seq, new_key, 1, sink_table, sink_columns FROM config WHERE seq % 2 = 0 AND op <> 4
    UNION ALL SELECT -1, n_nationkey, 1, 'dim_' || n_name, CASE n_nationkey % 2 WHEN 0 THEN 'id,a' ELSE 'id,b,absent' END
    FROM nation WHERE n_nationkey < 5)
    SELECT 'source_' || k AS source_table, sink_table, 'info' AS sink_family, sink_columns, 'id' AS sink_row_key
    FROM (SELECT * FROM steps QUALIFY ROW_NUMBER() OVER (PARTITION BY k ORDER BY seq DESC) = 1) WHERE live = 1"""
ORACLE["fact_prescription_within"] = ORACLE["fact_prescription"] + """ JOIN orders ON CAST(o_orderkey AS VARCHAR) = pre.id
    WHERE det.ts BETWEEN o_orderdate - INTERVAL 60 DAY AND o_orderdate + INTERVAL 60 DAY"""
ORACLE["stream_fact_prescription"] = ORACLE["fact_prescription_within"]

ORACLE["stream_lookup_hot_keys"] = ORACLE["lookup_doctor_hospital"]
ORACLE["config_two_partitions"] = ORACLE["config_latest"]
ORACLE["dim_two_partitions"] = f"SELECT row_key, a, b FROM ({ORACLE['dim_upsert_latest']})"
ORACLE["stream_routes_replayed"] = ORACLE["stream_dimensions"]
ORACLE["config_versions"] = f"""WITH {CONFIG}, steps AS (
    SELECT seq, old_key AS k, 0 AS live, NULL AS sink_table, NULL AS sink_columns FROM config
    WHERE op = 4 OR (op IN (2, 3) AND old_key <> new_key)
    UNION ALL SELECT seq, new_key, 1, sink_table, sink_columns FROM config WHERE op <> 4)
    SELECT 'source_' || k AS source_table, sink_table, 'info' AS sink_family, sink_columns, 'id' AS sink_row_key,
           seq AS from_seq, until_seq
    FROM (SELECT *, LEAD(seq) OVER (PARTITION BY k ORDER BY seq) AS until_seq FROM steps) WHERE live = 1"""


def treatments(seconds: int, measure: str) -> str:
    """Closed windows of what happens some seconds after every click."""
    rows = f"""SELECT date_trunc('second', ts + INTERVAL {seconds} SECONDS) AS ts, doctor_id, user_text AS patient_id, fee AS amount
               FROM ev WHERE event_type = 'click'"""
    return f"""SELECT * FROM (WITH {EV}, {DOCTOR}, {PATIENT}, {HOSPITAL}, {DICTIONARY}, {trade(rows, measure, '10 seconds')})
        WHERE CAST(edt AS TIMESTAMP) <= (SELECT MAX(date_trunc('second', ts + INTERVAL {seconds} SECONDS)) FROM events
            WHERE event_type = 'click') - INTERVAL 5 SECONDS"""


ORACLE["stream_summary_prescription"] = treatments(2, "prescription")
ORACLE["stream_summary_prescription_paid"] = treatments(60, "prescription_pay_suc")

LAST_REVIEW = "(SELECT MAX(date_trunc('second', ts)) FROM events WHERE event_type = 'view' {})"
ORACLE["stream_summary_reviews"] = f"""SELECT * FROM ({reviews('10 seconds')})
    WHERE CAST(edt AS TIMESTAMP) <= {LAST_REVIEW.format('')} - INTERVAL 5 SECONDS"""
ORACLE["stream_first_review_flag"] = f"""SELECT * FROM ({ORACLE['first_review_flag']})
    WHERE is_first = 1 OR date_trunc('second', CAST(review_time AS TIMESTAMP)) <= {LAST_REVIEW.format('')} - INTERVAL 5 SECONDS"""

# A window closes in the first slice whose last review is 5 seconds past its end; doctors move on after each slice.
ORACLE["stream_summary_reviews_live"] = f"""WITH {EV}, {DOCTOR}, {HOSPITAL}, seen AS (
    SELECT *, {bucket('10 seconds', "date_trunc('second', ts)")} AS w FROM ev WHERE event_type = 'view'),
closed AS (
    SELECT *, CASE WHEN w + INTERVAL 15 SECONDS <= {LAST_REVIEW.format("AND ts < TIMESTAMP '2024-01-11'")} THEN 0
                   WHEN w + INTERVAL 15 SECONDS <= {LAST_REVIEW.format("AND ts < TIMESTAMP '2024-01-21'")} THEN 1 ELSE 2 END AS moved
    FROM seen WHERE w + INTERVAL 15 SECONDS <= {LAST_REVIEW.format('')}),
placed AS (
    SELECT c.*, CAST((CAST(d.hospital_id AS INT) + moved) % 25 AS VARCHAR) AS hospital_id
    FROM closed c LEFT JOIN doctor d ON c.doctor_id = d.id),
flagged AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, hospital_id ORDER BY w, ts) = 1 AS is_first FROM placed),
grouped AS (
    SELECT w, hospital_id, CAST(SUM(CASE WHEN is_first THEN 1 ELSE 0 END) AS BIGINT) AS fresh, CAST(COUNT(*) AS BIGINT) AS n,
           CAST(SUM(CASE WHEN 1 + (event_id // 10) % 5 = 5 THEN 1 ELSE 0 END) AS BIGINT) AS good
    FROM flagged GROUP BY 1, 2)
SELECT {bounds('10 seconds')}, g.hospital_id, h.name AS hospital_name, g.fresh AS review_new_user_count,
       g.n AS review_count, g.good AS good_review_count
FROM grouped g LEFT JOIN hospital h ON g.hospital_id = h.id"""

_TREATED = """SELECT event_id || '-' || line AS id, strftime(ts + INTERVAL {after}, '%Y-%m-%d %H:%M:%S.%f') AS {time},
    CAST(line + event_id % 5 AS VARCHAR) AS count, CAST(event_id % 97 AS VARCHAR) AS medicine_id, id AS prescription_id,
    CAST(fee AS VARCHAR) AS total_amount, id AS consultation_id, doctor_id, user_text AS patient_id
    FROM ev, (VALUES (1), (2)) AS l(line) WHERE event_type = 'click'"""
_EACH_FACT = {name: ORACLE[f"fact_{name}"] for name in FACTS if not name.startswith("prescription")} | {
    "prescription": f"WITH {EV} {_TREATED.format(after='2 SECONDS', time='prescription_time')}",
    "prescription_paid": f"WITH {EV} {_TREATED.format(after='60 SECONDS', time='prescription_pay_suc_time')}",
}
# Details of even prescriptions arrive 2 seconds after them, those of odd ones 20.
ORACLE["stream_arrival_ttl"] = f"WITH {EV} {_TREATED.format(after='90 DAYS', time='prescription_time')} AND event_id % 2 = 0"
ORACLE["facts_from_json"] = " UNION ALL ".join(
    f"SELECT '{name}' AS fact, id, concat_ws('|', {', '.join(f'coalesce({c}, {chr(39) * 2})' for c in FACTS[name].columns)}) AS fields FROM ({sql})"
    for name, sql in _EACH_FACT.items()
)
