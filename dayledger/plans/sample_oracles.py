"""The same results as plain SQL, written independently, for checking."""

from __future__ import annotations

VIEWS = """
WITH ev AS (
  SELECT event_id, CAST(ts AS DATE) AS d, user_id, event_type, value,
         CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k
  FROM events),
fx_fields AS (SELECT r_regionkey + 1 AS id, r_name AS name FROM region),
fx_platforms AS (
  SELECT n_nationkey AS id, n_name AS name,
         CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE CAST(n_regionkey AS VARCHAR) END AS square,
         n_regionkey + 1 AS field_id
  FROM nation),
fx_wells AS (SELECT c_custkey AS id, c_name AS name, c_nationkey AS platform_id FROM customer),
fx_horizons AS (
  SELECT p_partkey AS id, p_brand AS name, 1 + p_size % 5 AS field_id,
         CAST(0.7 AS DOUBLE) + (p_size % 20) / CAST(100 AS DOUBLE) AS oil_density
  FROM part),
first_ev AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, d, event_type ORDER BY event_id) AS rn
    FROM ev) t
  WHERE rn = 1),
fx_daily AS (
  SELECT user_id AS well_id, d, CAST(max(k) % 25 AS DOUBLE) AS well_uptime_hours,
         min(value) AS pqa, count(*) AS n_events
  FROM ev GROUP BY user_id, d),
fx_well_stock_raw AS (
  SELECT user_id AS well_id, d, event_id, 1 + k % 2 AS category_id, 1 + k % 3 AS sub_category_id,
         CASE WHEN k % 5 = 0 THEN NULL ELSE 1 + k % 4 END AS method_id
  FROM first_ev WHERE event_type = 'view'),
fx_completions_raw AS (
  SELECT user_id AS well_id, d, event_id, k AS horizon_id, CAST(k % 3 AS VARCHAR) AS casing
  FROM first_ev WHERE event_type = 'click'),
fx_downtime_raw AS (
  SELECT user_id AS well_id, d, event_id, k % 5 AS category,
         CASE WHEN k % 7 = 0 THEN NULL ELSE 'c' || CAST(k % 3 AS VARCHAR) END AS comments
  FROM first_ev WHERE event_type = 'error'),
fx_well_tests AS (
  SELECT user_id AS well_id, d, event_id, d - (k % 20) AS well_test_date, value * 3 AS liquid_ton,
         value * 2 AS oil_ton, value AS water_ton
  FROM first_ev WHERE event_type = 'purchase'),
fx_gas_well_tests AS (
  SELECT user_id AS well_id, d, event_id, d - (k % 20) AS well_test_date, value * 10 AS total_gas,
         value * (k % 12) AS gaslift_gas
  FROM first_ev WHERE event_type = 'purchase'),
fx_lab AS (
  SELECT user_id AS well_id, d, event_id, d - (k % 9) AS lab_date, CAST(k AS DOUBLE) AS water_cut,
         CAST(k % 7 AS DOUBLE) AS mechanical_impurities
  FROM first_ev WHERE event_type = 'signup'),
fx_monthly AS (
  SELECT id AS field_id, DATE '2024-01-31' AS report_date, CAST(1000 * id AS DOUBLE) AS produced_oil
  FROM fx_fields WHERE id < 5),
fx_meter AS (
  SELECT user_id AS meter_id, d, min(k) % 5 AS reading1, max(k) % 5 AS reading2
  FROM ev GROUP BY user_id, d),
fx_report_rows AS (
  SELECT 'r' || CAST(user_id AS VARCHAR) AS file,
         CAST(13 + row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INT) AS row_idx,
         CASE WHEN k = 99 THEN NULL ELSE CAST(k % 9 AS VARCHAR) END AS c02,
         ' ' || event_type || ' ' AS c05,
         CASE WHEN k % 10 = 0 THEN 'y' WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 'abc'
              ELSE replace(CAST(value AS VARCHAR), '.', ',') END AS c20,
         CASE WHEN k % 6 = 0 THEN '45300.25' WHEN k % 6 = 1 THEN '1/9/2024' WHEN k % 6 = 2 THEN '500'
              WHEN k % 6 = 3 THEN 'not a date'
              WHEN k % 6 = 4 THEN CAST(d AS VARCHAR) || 'T' || lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':30:00.000Z'
              ELSE '20000' END AS c19
  FROM ev),
fx_placed AS (
  SELECT w.id AS well_id, w.name AS well, p.name AS platform_name, p.square, p.field_id,
         f.name AS field
  FROM fx_wells w LEFT JOIN fx_platforms p ON w.platform_id = p.id
  LEFT JOIN fx_fields f ON p.field_id = f.id),
fx_states AS (
  SELECT b.well_id, b.d, b.well_uptime_hours, b.pqa, b.n_events,
         ws.category_id, ws.sub_category_id, ws.method_id, c.horizon_id, c.casing,
         wdr.category AS downtime_category, wdr.comments,
         wt.d AS wt_d, wt.well_test_date, wt.liquid_ton, wt.oil_ton, wt.water_ton,
         lr.lab_date, lr.water_cut, lr.mechanical_impurities, gwt.total_gas, gwt.gaslift_gas
  FROM fx_daily b
  ASOF LEFT JOIN fx_well_stock_raw ws ON b.well_id = ws.well_id AND b.d >= ws.d
  ASOF LEFT JOIN fx_completions_raw c ON b.well_id = c.well_id AND b.d >= c.d
  ASOF LEFT JOIN fx_downtime_raw wdr ON b.well_id = wdr.well_id AND b.d >= wdr.d
  ASOF LEFT JOIN fx_well_tests wt ON b.well_id = wt.well_id AND b.d >= wt.d
  ASOF LEFT JOIN fx_lab lr ON b.well_id = lr.well_id AND b.d >= lr.d
  ASOF LEFT JOIN fx_gas_well_tests gwt ON b.well_id = gwt.well_id AND b.d >= gwt.d),
fx_history AS (
  SELECT well_id, d, category_id, sub_category_id, method_id FROM (
    SELECT *, lag(category_id) OVER w AS pc, lag(sub_category_id) OVER w AS ps,
           lag(method_id) OVER w AS pm
    FROM fx_well_stock_raw WINDOW w AS (PARTITION BY well_id ORDER BY d)) t
  WHERE pc IS DISTINCT FROM category_id OR ps IS DISTINCT FROM sub_category_id
     OR pm IS DISTINCT FROM method_id),
fx_calc AS (
  SELECT s.*, pl.well, pl.platform_name, pl.square, pl.field_id, pl.field, h.name AS horizon,
         CASE WHEN pl.field <> 'ASIA' THEN coalesce(s.oil_ton / 24 * s.well_uptime_hours, 0)
              WHEN h.oil_density = 0 AND s.water_cut = 0 THEN 0
              ELSE coalesce(round(s.liquid_ton / 24 * s.well_uptime_hours
                     * (h.oil_density * (1 - s.water_cut / 100))
                     / nullif(h.oil_density * (1 - s.water_cut / 100) + s.water_cut / 100, 0)), 0)
         END AS oil_calc,
         CASE WHEN pl.field <> 'ASIA' THEN coalesce(s.water_ton / 24 * s.well_uptime_hours, 0)
              WHEN h.oil_density = 0 AND s.water_cut = 0 THEN 0
              ELSE coalesce(round(s.liquid_ton / 24 * s.well_uptime_hours * (s.water_cut / 100)
                     / nullif(h.oil_density * (1 - s.water_cut / 100) + s.water_cut / 100, 0)), 0)
         END AS water_calc
  FROM fx_states s LEFT JOIN fx_placed pl ON s.well_id = pl.well_id
  LEFT JOIN fx_horizons h ON s.horizon_id = h.id)
"""

# Sheets: the values behind the cells, per well and day, without cells or parsing.
SHEETS = (
    VIEWS
    + """,
sheet_days AS (
  SELECT e.user_id AS well_id, e.d, max(e.k) AS m, min(e.k) AS s, min(e.value) AS v, count(*) AS n,
         any_value(w.platform_id) AS p
  FROM ev e JOIN fx_wells w ON e.user_id = w.id GROUP BY e.user_id, e.d),
sheet_files AS (
  SELECT CAST(p AS VARCHAR) || '_' || CAST(d AS VARCHAR) AS file, p, d, count(*) AS n_rows,
         CASE WHEN p < 15 THEN 1 ELSE 1 + p % 5 END AS own_field_id, day(d) AS dom,
         CAST(d - DATE '2014-12-31' AS INT) AS day_id
  FROM sheet_days GROUP BY p, d),
file_codes AS (
  SELECT *, CASE WHEN (p + dom) % 19 = 0 THEN NULL ELSE own_field_id END AS field_id,
         CASE WHEN (p + dom) % 19 = 0 THEN 'FIELD_UNKNOWN'
              WHEN (p + dom) % 23 = 0 THEN 'REPORT_DATE_INVALID'
              WHEN (p + dom) % 29 = 0 THEN 'FOOTER_ERROR' END AS code
  FROM sheet_files),
sheet_rows AS (
  SELECT t.*, f.file, f.own_field_id AS field_id, f.day_id,
         13 + row_number() OVER (PARTITION BY f.file ORDER BY t.well_id) AS row_idx,
         1 + m % 2 AS category_id, 1 + m % 3 AS sub_id,
         CASE WHEN m % 5 = 0 THEN NULL ELSE 1 + m % 4 END AS method_id,
         CASE WHEN m % 17 = 0 THEN 0 ELSE m % 26 END AS uptime,
         CASE WHEN m = 98 THEN 101 ELSE m END AS cut,
         CASE WHEN m % 7 = 0 THEN NULL ELSE 'c' || CAST(s % 3 AS VARCHAR) END AS comments
  FROM sheet_days t JOIN file_codes f ON t.p = f.p AND t.d = f.d WHERE f.code IS NULL),
row_codes AS (
  SELECT file, row_idx, 'ERROR' AS level, 'WELL_UNKNOWN' AS code FROM sheet_rows WHERE m = 50
  UNION ALL SELECT file, row_idx, 'ERROR', 'RESULT_DATE_INVALID' FROM sheet_rows
    WHERE m <> 50 AND m % 23 = 0
  UNION ALL SELECT file, row_idx, 'ERROR', 'FLOWMETER_MISSING' FROM sheet_rows
    WHERE m <> 50 AND field_id = 1 AND sub_id = 1 AND n % 3 = 0
  UNION ALL SELECT file, row_idx, 'ERROR', 'UPTIME_RANGE' FROM sheet_rows WHERE m <> 50 AND uptime > 24
  UNION ALL SELECT file, row_idx, 'ERROR', 'DOWNTIME_UNEXPLAINED' FROM sheet_rows
    WHERE m <> 50 AND uptime < 24 AND (m % 5 = 0 OR comments IS NULL)
  UNION ALL SELECT file, row_idx, 'ERROR', 'LIQUID_RANGE' FROM sheet_rows WHERE m <> 50 AND v * 3 > 500
  UNION ALL SELECT file, row_idx, 'ERROR', 'GAS_BELOW_GASLIFT' FROM sheet_rows
    WHERE m <> 50 AND v * 10 < v * (m % 12)
  UNION ALL SELECT file, row_idx, 'ERROR', 'PERCENT_RANGE' FROM sheet_rows WHERE m <> 50 AND cut > 100
  UNION ALL SELECT file, row_idx, 'INFO', 'UNPARSABLE_NUMBER' FROM sheet_rows
    WHERE m <> 50 AND s % 13 = 0),
bad_rows AS (SELECT DISTINCT file, row_idx FROM row_codes WHERE level = 'ERROR'),
good_rows AS (SELECT * FROM sheet_rows r ANTI JOIN bad_rows b ON r.file = b.file AND r.row_idx = b.row_idx),
meter_files AS (
  SELECT *, dom % 11 = 0 AS incomplete FROM file_codes
  WHERE code IS NULL AND own_field_id = 1 AND p IN (2, 3, 7, 13)),
meter_fates AS (
  SELECT a.*, NOT a.incomplete AND a.p = 13 AND a.dom % 4 = 0 AND b.p IS NOT NULL AS discontinuous,
         NOT a.incomplete AND a.p = 7 AND b.p IS NOT NULL AS stale
  FROM meter_files a LEFT JOIN meter_files b
    ON a.p = b.p AND a.d - 1 = b.d AND NOT b.incomplete),
stock_new AS (
  SELECT * FROM (
    SELECT *, lag(category_id) OVER w AS a, lag(sub_id) OVER w AS b, lag(method_id) OVER w AS c
    FROM good_rows WINDOW w AS (PARTITION BY well_id ORDER BY d)) t
  WHERE a IS DISTINCT FROM category_id OR b IS DISTINCT FROM sub_id OR c IS DISTINCT FROM method_id),
brand_ids AS (SELECT name, min(id) AS id FROM fx_horizons GROUP BY name),
completion_rows AS (
  SELECT g.*, b.id AS horizon_id, g.s % 3 AS casing
  FROM good_rows g LEFT JOIN brand_ids b ON b.name = 'Brand#' || CAST(1 + g.m % 25 AS VARCHAR)),
completion_new AS (
  SELECT * FROM (
    SELECT *, lag(horizon_id) OVER w AS a, lag(casing) OVER w AS b
    FROM completion_rows WINDOW w AS (PARTITION BY well_id ORDER BY d)) t
  WHERE a IS DISTINCT FROM horizon_id OR b IS DISTINCT FROM casing),
downtime_new AS (
  SELECT * FROM (
    SELECT *, lag(m % 5) OVER w AS a, lag(1 + s % 5) OVER w AS b, lag(comments) OVER w AS c
    FROM good_rows WINDOW w AS (PARTITION BY well_id ORDER BY d)) t
  WHERE a IS DISTINCT FROM m % 5 OR b IS DISTINCT FROM 1 + s % 5 OR c IS DISTINCT FROM comments),
comment_rows AS (
  SELECT *, CASE WHEN dom % 6 = 0 THEN NULL ELSE 'note ' || CAST(dom // 5 AS VARCHAR) END AS note
  FROM file_codes WHERE code IS NULL),
comment_new AS (
  SELECT * FROM (
    SELECT *, lag(note) OVER (PARTITION BY p ORDER BY d) AS a FROM comment_rows) t
  WHERE a IS DISTINCT FROM note),
inserted AS (
  SELECT 'well_stock' AS table_name, CAST(well_id AS VARCHAR) AS entity, day_id AS report_date_id,
         CAST(coalesce(method_id, 0) AS DOUBLE) AS amount FROM stock_new
  UNION ALL SELECT 'completions', CAST(well_id AS VARCHAR), day_id, horizon_id FROM completion_new
  UNION ALL SELECT 'well_downtime_reasons', CAST(well_id AS VARCHAR), day_id, 1 + s % 5 FROM downtime_new
  UNION ALL SELECT 'daily_well_parameters', CAST(well_id AS VARCHAR), day_id,
         CASE WHEN m % 10 = 0 THEN 0 ELSE n * CAST(1.5 AS DOUBLE) / 24 * uptime END FROM good_rows
  UNION ALL SELECT 'well_tests', CAST(well_id AS VARCHAR), min(day_id), arg_min(v * 3, day_id)
    FROM good_rows GROUP BY well_id, d - (m % 20)
  UNION ALL SELECT 'gas_well_tests', CAST(well_id AS VARCHAR), min(day_id), arg_min(v * (m % 12), day_id)
    FROM good_rows GROUP BY well_id, d - (s % 20)
  UNION ALL SELECT 'laboratory_results', CAST(well_id AS VARCHAR), min(day_id), arg_min(cut, day_id)
    FROM good_rows GROUP BY well_id, d - (s % 9)
  UNION ALL SELECT 'daily_general_comments',
         CAST(own_field_id AS VARCHAR) || '/' || CAST(p AS VARCHAR), day_id, 0 FROM comment_new
  UNION ALL SELECT 'flowmeters', CAST(p AS VARCHAR), day_id, dom * 10 + p FROM meter_fates
    WHERE NOT incomplete AND NOT discontinuous),
findings AS (
  SELECT file, CAST(NULL AS INT) AS row_idx, 'ERROR' AS level, code, TRUE AS qc
    FROM file_codes WHERE code IS NOT NULL
  UNION ALL SELECT file, NULL, 'WARNING', 'NOT_STORED', FALSE
    FROM file_codes WHERE code <> 'FOOTER_ERROR'
  UNION ALL SELECT file, row_idx, level, code, level = 'ERROR' FROM row_codes
  UNION ALL SELECT file, row_idx, 'WARNING', 'NOT_STORED', FALSE FROM bad_rows
  UNION ALL SELECT file, row_idx, 'WARNING', 'RESULTS_TOO_OLD', FALSE FROM good_rows
    WHERE sub_id = 1 AND m % 20 > 15
  UNION ALL SELECT file, NULL, 'ERROR', 'METER_INCOMPLETE', TRUE FROM meter_fates WHERE incomplete
  UNION ALL SELECT file, NULL, 'WARNING', 'NOT_STORED', FALSE FROM meter_fates WHERE incomplete
  UNION ALL SELECT file, NULL, 'ERROR', 'METER_DISCONTINUOUS', TRUE FROM meter_fates WHERE discontinuous
  UNION ALL SELECT file, NULL, 'WARNING', 'METER_STALE', TRUE FROM meter_fates WHERE stale
  UNION ALL SELECT file, NULL, 'INFO', 'METER_ABSENT', FALSE FROM file_codes
    WHERE code IS NULL AND (own_field_id <> 1 OR p NOT IN (2, 3, 7, 13)))
"""
)

_ROWS_KEPT = """
SELECT f.file, f.row_idx, e.end_row, f.c19, f.c20 FROM fx_report_rows f
LEFT JOIN (SELECT file, min(row_idx) AS end_row FROM fx_report_rows WHERE c02 IS NULL GROUP BY file) e
  ON f.file = e.file
WHERE e.end_row IS NULL OR f.row_idx < e.end_row
"""

_DAY = """CASE c19 WHEN '45300.25' THEN DATE '1899-12-30' + 45300 WHEN '20000' THEN DATE '1899-12-30' + 20000
  WHEN '500' THEN NULL ELSE CASE WHEN c19 LIKE '%Z'
    THEN CAST(strptime(left(c19, 19), '%Y-%m-%dT%H:%M:%S') + INTERVAL 4 HOUR AS DATE)
    ELSE CAST(try_strptime(c19, '%m/%d/%Y') AS DATE) END END"""

_NUMBER = "try_cast(replace(c20, ',', '.') AS DOUBLE)"

_CALENDAR = """
cal AS (SELECT CAST(row_number() OVER (ORDER BY day) AS INT) AS id, CAST(day AS DATE) AS report_date
        FROM generate_series(DATE '2015-01-01', DATE '2030-01-01', INTERVAL 1 DAY) g(day))
"""

# One row after another, as a loader takes them.
_WALK = VIEWS.replace("WITH ev", "WITH RECURSIVE ev", 1)

ORACLES: dict[str, str] = {
    "asof_latest_test": VIEWS
    + """SELECT well_id, d, well_uptime_hours, wt_d AS reported, well_test_date,
  coalesce(round(liquid_ton / 24 * well_uptime_hours), 0) AS liquid_ton FROM fx_states""",
    "asof_strict_previous": VIEWS
    + """SELECT b.well_id, b.d, b.n_events, l.lab_date, l.water_cut FROM fx_daily b
ASOF LEFT JOIN fx_lab l ON b.well_id = l.well_id AND b.d > l.d""",
    "asof_many_states": VIEWS
    + """SELECT well_id, d, category_id, method_id, horizon_id, downtime_category, comments, liquid_ton,
  water_cut, total_gas FROM fx_states""",
    "asof_orders_lineitem": """
WITH o AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, max(o_orderkey) AS o_orderkey,
         arg_max(o_totalprice, o_orderkey) AS o_totalprice
  FROM orders GROUP BY 1, 2),
l AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS day, o_custkey AS custkey
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)
SELECT l.*, o.o_orderkey AS latest_o_orderkey, o.o_totalprice AS latest_o_totalprice
FROM l ASOF LEFT JOIN o ON l.custkey = o.o_custkey AND l.day >= o.day""",
    "densify_history": VIEWS
    + """, days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', (SELECT max(d) FROM ev),
  INTERVAL 1 DAY)) AS DATE) AS d),
grid AS (SELECT w.well_id, days.d FROM (SELECT well_id, min(d) AS first FROM fx_history GROUP BY 1) w
  JOIN days ON days.d >= w.first)
SELECT g.well_id, g.d, h.category_id, h.sub_category_id, h.method_id FROM grid g
ASOF LEFT JOIN fx_history h ON g.well_id = h.well_id AND g.d >= h.d""",
    "append_if_absent": VIEWS
    + """, late AS (SELECT * FROM fx_well_tests WHERE d > DATE '2024-01-15')
SELECT well_id, well_test_date, arg_min(d, event_id) AS d, min(event_id) AS event_id,
  arg_min(liquid_ton, event_id) AS liquid_ton
FROM late WHERE NOT EXISTS (
  SELECT 1 FROM fx_well_tests t WHERE t.d <= DATE '2024-01-15' AND t.well_id = late.well_id
    AND t.well_test_date = late.well_test_date)
GROUP BY well_id, well_test_date""",
    "append_if_changed": VIEWS
    + """, stored AS (SELECT * FROM fx_history WHERE d <= DATE '2024-01-15'),
incoming AS (
  SELECT r.* FROM fx_well_stock_raw r WHERE r.d >= DATE '2024-01-10' AND NOT EXISTS (
    SELECT 1 FROM stored s WHERE s.well_id = r.well_id AND s.d = r.d)),
both_sides AS (
  SELECT well_id, d, event_id, category_id, sub_category_id, method_id, 1 AS src FROM incoming
  UNION ALL SELECT well_id, d, NULL, category_id, sub_category_id, method_id, 0 FROM stored),
seen AS (
  SELECT *, lag(category_id) OVER w AS a, lag(sub_category_id) OVER w AS b, lag(method_id) OVER w AS c
  FROM both_sides WINDOW w AS (PARTITION BY well_id ORDER BY d))
SELECT well_id, d, event_id, category_id, sub_category_id, method_id FROM seen
WHERE src = 1 AND (a IS DISTINCT FROM category_id OR b IS DISTINCT FROM sub_category_id
  OR c IS DISTINCT FROM method_id)""",
    "asof_timeline_events": """
WITH views AS (SELECT user_id, ts, max(event_id) AS event_id, max_by(value, event_id) AS value
  FROM events WHERE event_type = 'view' GROUP BY user_id, ts)
SELECT e.event_id, e.user_id, e.event_type, v.event_id AS view_event_id, round(v.value, 9) AS view_value
FROM (SELECT * FROM events WHERE event_type IN ('purchase', 'error')) e
ASOF LEFT JOIN views v ON e.user_id = v.user_id AND e.ts >= v.ts""",
    "state_snapshots": VIEWS
    + """, both_tables AS (
  SELECT 'well_stock' AS table_name, well_id, d, CAST(method_id AS DOUBLE) AS amount, d AS tie FROM fx_well_stock_raw
  UNION ALL SELECT 'well_tests', well_id, d, liquid_ton, well_test_date FROM fx_well_tests),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY table_name, well_id ORDER BY d DESC, tie DESC) AS rn
  FROM both_tables WHERE d < DATE '2024-01-26')
SELECT table_name, well_id, CAST(date_diff('day', DATE '2015-01-01', d) + 1 AS INT) AS report_date_id,
       round(amount, 9) AS amount FROM ranked WHERE rn = 1""",
    "late_repair": VIEWS
    + """, raw AS (
  SELECT *, (day(d) + well_id) % 3 = 0 AS late FROM fx_well_stock_raw),
before_late AS (
  SELECT well_id, d, category_id, sub_category_id, method_id,
         lag(category_id) OVER w AS a, lag(sub_category_id) OVER w AS b, lag(method_id) OVER w AS c
  FROM raw WHERE NOT late WINDOW w AS (PARTITION BY well_id ORDER BY d)),
after_late AS (
  SELECT well_id, d, category_id, sub_category_id, method_id,
         lag(category_id) OVER w AS a, lag(sub_category_id) OVER w AS b, lag(method_id) OVER w AS c
  FROM raw WINDOW w AS (PARTITION BY well_id ORDER BY d)),
old AS (SELECT well_id, d, category_id, sub_category_id, method_id FROM before_late
  WHERE a IS DISTINCT FROM category_id OR b IS DISTINCT FROM sub_category_id OR c IS DISTINCT FROM method_id),
new AS (SELECT well_id, d, category_id, sub_category_id, method_id FROM after_late
  WHERE a IS DISTINCT FROM category_id OR b IS DISTINCT FROM sub_category_id OR c IS DISTINCT FROM method_id)
SELECT 'insert' AS action, * FROM (SELECT * FROM new EXCEPT SELECT * FROM old)
UNION ALL SELECT 'retract', * FROM (SELECT * FROM old EXCEPT SELECT * FROM new)""",
    "append_if_changed_repeated": _WALK
    + """, se AS (
  SELECT user_id AS well_id, d, event_id, k % 2 AS category_id, CASE WHEN k % 5 <> 0 THEN 1 + k % 2 END AS method_id
  FROM ev WHERE event_type = 'view'),
n1 AS (
  SELECT *, 1 AS src, row_number() OVER (PARTITION BY well_id ORDER BY d, event_id) AS n
  FROM se WHERE d <= DATE '2024-01-15'),
w1 AS (
  SELECT DISTINCT well_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS DATE) AS last_d, CAST(NULL AS INT) AS c,
    CAST(NULL AS INT) AS m, FALSE AS hit FROM n1
  UNION ALL
  SELECT well_id, n, CASE WHEN hit THEN d ELSE last_d END, CASE WHEN hit THEN category_id ELSE c END,
    CASE WHEN hit THEN method_id ELSE m END, hit
  FROM (SELECT w.well_id, r.n, r.d, w.last_d, w.c, w.m, r.category_id, r.method_id,
          r.d IS DISTINCT FROM w.last_d
            AND (r.category_id IS DISTINCT FROM w.c OR r.method_id IS DISTINCT FROM w.m) AS hit
        FROM w1 w JOIN n1 r ON r.well_id = w.well_id AND r.n = w.n + 1)),
stored AS (SELECT n1.* FROM n1 JOIN w1 USING (well_id, n) WHERE hit),
n2 AS (
  SELECT *, row_number() OVER (PARTITION BY well_id ORDER BY d, src, event_id) AS n FROM (
    SELECT well_id, d, event_id, category_id, method_id, 0 AS src FROM stored
    UNION ALL SELECT well_id, d, event_id, category_id, method_id, 1 FROM se WHERE d >= DATE '2024-01-10')),
w2 AS (
  SELECT DISTINCT well_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS DATE) AS last_d, CAST(NULL AS INT) AS c,
    CAST(NULL AS INT) AS m, FALSE AS hit FROM n2
  UNION ALL
  SELECT well_id, n, CASE WHEN hit OR src = 0 THEN d ELSE last_d END,
    CASE WHEN hit OR src = 0 THEN category_id ELSE c END, CASE WHEN hit OR src = 0 THEN method_id ELSE m END, hit
  FROM (SELECT w.well_id, r.n, r.d, r.src, w.last_d, w.c, w.m, r.category_id, r.method_id,
          r.src = 1 AND r.d IS DISTINCT FROM w.last_d
            AND (r.category_id IS DISTINCT FROM w.c OR r.method_id IS DISTINCT FROM w.m) AS hit
        FROM w2 w JOIN n2 r ON r.well_id = w.well_id AND r.n = w.n + 1))
SELECT 'stored' AS source, well_id, d, event_id, category_id, method_id FROM stored
UNION ALL SELECT 'new', well_id, d, event_id, category_id, method_id FROM n2 JOIN w2 USING (well_id, n) WHERE hit""",
    "change_detail": VIEWS
    + """, seen AS (
  SELECT *, lag(horizon_id) OVER w AS a, lag(casing) OVER w AS b
  FROM fx_completions_raw WINDOW w AS (PARTITION BY well_id ORDER BY d))
SELECT well_id, d, concat_ws(',', CASE WHEN a IS DISTINCT FROM horizon_id THEN 'horizon_id' END,
  CASE WHEN b IS DISTINCT FROM casing THEN 'casing' END) AS changed_columns
FROM seen WHERE a IS DISTINCT FROM horizon_id OR b IS DISTINCT FROM casing""",
    "sheet_facts": SHEETS
    + "SELECT table_name, entity, report_date_id, round(amount, 9) AS amount FROM inserted",
    "sheet_parameters": SHEETS
    + """SELECT well_id, day_id AS report_date_id, CASE WHEN n % 3 <> 0 THEN 'F1' END AS flowmeter,
  CAST(CASE WHEN m % 17 <> 0 THEN m % 26 END AS DOUBLE) AS well_uptime_hours, CAST(v AS VARCHAR) AS pqa,
  {pressures}, round(CASE WHEN m % 10 = 0 THEN 0 ELSE n * CAST(1.5 AS DOUBLE) / 24 * uptime END, 9) AS gaslift_gas,
  CASE WHEN m % 3 <> 0 THEN CAST(m + 37 AS VARCHAR) || ',5' END AS gaslift_system_pressure,
  {numbers}, CASE WHEN m % 3 <> 0 THEN m % 2 = 0 END AS esp_downhole_gas_separator,
  CASE WHEN m % 3 <> 0 THEN CAST(m + 46 AS VARCHAR) || ',5' END AS srp_pumpjack_type,
  'person' AS responsible_person, 'phone' AS phone_number FROM good_rows""",
    "sheet_stock": SHEETS
    + """SELECT well_id, day_id AS report_date_id, category_id AS well_stock_category_id,
  1 AS well_stock_sub_category_id, sub_id AS production_well_stock_sub_category_id,
  method_id AS production_method_id FROM stock_new""",
    "sheet_results": SHEETS
    + """, t AS (
  SELECT 'well_tests' AS table_name, well_id, day_id, d - (m % 20) AS day, v * 3 AS a, v * 2 AS b,
    CASE WHEN s % 13 <> 0 THEN v END AS c FROM good_rows
  UNION ALL SELECT 'gas_well_tests', well_id, day_id, d - (s % 20), v * 10, v * (m % 12), NULL FROM good_rows
  UNION ALL SELECT 'laboratory_results', well_id, day_id, d - (s % 9), cut, s % 7, NULL FROM good_rows),
first_of AS (SELECT *, row_number() OVER (PARTITION BY table_name, well_id, day ORDER BY day_id) AS rn FROM t)
SELECT table_name, well_id, day_id AS report_date_id, day, round(CAST(a AS DOUBLE), 9) AS value1,
  round(CAST(b AS DOUBLE), 9) AS value2, round(CAST(c AS DOUBLE), 9) AS value3 FROM first_of WHERE rn = 1""",
    "summary_lines": SHEETS
    + """, said AS (
  SELECT count(*) AS rows, lower(level) AS tail FROM findings GROUP BY level
  UNION ALL SELECT count(*), 'row(s) inserted into ' || table_name FROM inserted
    WHERE table_name IN ('flowmeters', 'well_stock') GROUP BY table_name)
SELECT lpad(CAST(rows AS VARCHAR), CAST(greatest(6, length(CAST(rows AS VARCHAR))) AS INT), ' ') || chr(9) || chr(9) || tail AS line
FROM said""",
    "route_records": SHEETS
    + """SELECT t.table_name, count(*) AS rows, count(DISTINCT well_id) AS entities
FROM good_rows, (VALUES ('well_stock'), ('completions'), ('well_downtime_reasons'),
  ('daily_well_parameters'), ('well_tests'), ('gas_well_tests'), ('laboratory_results')) t(table_name)
GROUP BY t.table_name
UNION ALL SELECT 'daily_general_comments', count(*), count(DISTINCT p) FROM comment_rows""",
    "sheet_findings": SHEETS + "SELECT file, CAST(row_idx AS INT) AS row_idx, level, code, qc FROM findings",
    "load_summary": SHEETS
    + """SELECT 'table' AS section, t.table_name AS name, count(i.table_name) AS rows
FROM (VALUES ('well_stock'), ('completions'), ('well_downtime_reasons'), ('daily_well_parameters'),
  ('well_tests'), ('gas_well_tests'), ('laboratory_results'), ('daily_general_comments'),
  ('flowmeters')) t(table_name) LEFT JOIN inserted i ON t.table_name = i.table_name
GROUP BY t.table_name
UNION ALL SELECT 'level', level, count(*) FROM (
  SELECT level FROM findings
  UNION ALL SELECT 'INFO' FROM range((SELECT 7 * count(*) FROM good_rows)
    + (SELECT count(*) FROM comment_rows)
    - (SELECT count(*) FROM inserted WHERE table_name <> 'flowmeters'))
  UNION ALL SELECT CASE WHEN table_name IN ('well_stock', 'completions', 'well_downtime_reasons')
    THEN 'WARNING' ELSE 'SUCCESS' END FROM inserted) x GROUP BY level""",
    "validate_files": SHEETS
    + """SELECT file, field_id, CASE WHEN (p + dom) % 23 = 0 THEN NULL ELSE day_id END AS report_date_id,
  code FROM file_codes""",
    "lookup_first_match": VIEWS
    + """SELECT p_partkey, (SELECT min(id) FROM fx_horizons h WHERE h.name = p_brand) AS horizon_id,
  (SELECT min(id) FROM fx_horizons h WHERE h.name = p_brand AND h.field_id = 1 + p_size % 3)
    AS field_horizon_id FROM part""",
    "lookup_null_safe": VIEWS
    + """SELECT c_custkey, q.id AS platform_id, r.id AS strict_platform_id FROM customer
LEFT JOIN fx_platforms p ON c_nationkey = p.id
LEFT JOIN fx_platforms q ON q.name = p.name AND q.field_id = p.field_id AND q.square IS NOT DISTINCT FROM p.square
LEFT JOIN fx_platforms r ON r.name = p.name AND r.field_id = p.field_id AND r.square = p.square""",
    "lookup_trimmed": VIEWS
    + """SELECT e.event_id, w.id AS well_id, e.event_type FROM ev e LEFT JOIN fx_wells w ON w.id = e.k""",
    "lookup_prefix": """SELECT p_partkey AS part, min(p_partkey) OVER (PARTITION BY trim(left(p_name, 5))) AS first_id
FROM part""",
    "calendar_lookup": VIEWS
    + ","
    + _CALENDAR
    + """SELECT well_id, d, id AS report_date_id, CAST(d - DATE '2014-12-31' AS INT) AS by_arithmetic
FROM fx_daily LEFT JOIN cal ON d = report_date""",
    "denormalise": VIEWS
    + """SELECT b.well_id, b.d, p.well, CASE WHEN p.square IS NULL OR p.square = '' THEN p.platform_name
  ELSE p.platform_name || ' / ' || p.square END AS platform, p.field
FROM fx_daily b LEFT JOIN fx_placed p ON b.well_id = p.well_id""",
    "pivot_cells": VIEWS + "SELECT file, row_idx, c02, c05, c19, c20 FROM fx_report_rows",
    "report_header": VIEWS
    + """SELECT file, max(CASE WHEN row_idx = 14 THEN c05 END) AS ogpd_name,
  max(CASE WHEN row_idx = 15 THEN c05 END) AS field_name,
  max(CASE WHEN row_idx = 14 THEN c02 END) AS first_mark,
  max(CASE WHEN row_idx = 16 THEN c19 END) AS report_date_cell,
  max(CASE WHEN row_idx = 18 THEN c20 END) AS reading1_cell,
  FALSE AS is_lts, FALSE AS platform_by_file
FROM fx_report_rows GROUP BY file""",
    "report_body": VIEWS
    + f"SELECT file, row_idx, end_row, {_DAY} AS test_date, {_NUMBER} AS liquid_ton FROM ({_ROWS_KEPT})",
    "report_footer": VIEWS
    + """, ends AS (SELECT file, min(row_idx) AS end_row FROM fx_report_rows WHERE c02 IS NULL GROUP BY file)
SELECT e.file, e.end_row,
  coalesce(bool_or(f.row_idx - e.end_row BETWEEN 7 AND 22 AND f.c20 IS NOT NULL
    AND f.c20 NOT IN ('', '0', 'false')), FALSE) AS has_error,
  max(CASE WHEN f.row_idx - e.end_row = 7 THEN f.c05 END) AS general_comments
FROM ends e LEFT JOIN fx_report_rows f ON e.file = f.file GROUP BY e.file, e.end_row""",
    "normalise_numbers": VIEWS
    + f"""SELECT file, row_idx, {_NUMBER} AS value,
  CASE WHEN c20 = 'y' THEN 'missing' WHEN {_NUMBER} IS NULL THEN 'unparsable' ELSE 'ok' END AS status,
  CASE WHEN c20 = 'y' THEN 0 ELSE {_NUMBER} END AS rule_value,
  CASE WHEN c20 <> 'y' THEN replace(c20, ',', '.') END AS point_text
FROM fx_report_rows""",
    "normalise_dates": VIEWS + f"SELECT file, row_idx, {_DAY} AS day FROM fx_report_rows",
    "loader_gaslift": VIEWS
    + f"""SELECT file, row_idx, coalesce({_NUMBER}, 0) / 24 * coalesce(CAST(c02 AS DOUBLE), 0) AS gaslift_gas
FROM fx_report_rows""",
    "validate_rows": VIEWS
    + """, j AS (
  SELECT b.well_id, b.d, b.well_uptime_hours + 1 AS uptime, b.n_events, s.category_id, s.sub_category_id,
    x.category, x.comments, t.well_test_date, t.liquid_ton, g.total_gas, g.gaslift_gas,
    l.water_cut * CAST(1.1 AS DOUBLE) AS cut, p.well, p.field_id
  FROM fx_daily b LEFT JOIN fx_well_stock_raw s ON b.well_id = s.well_id AND b.d = s.d
  LEFT JOIN fx_downtime_raw x ON b.well_id = x.well_id AND b.d = x.d
  LEFT JOIN fx_well_tests t ON b.well_id = t.well_id AND b.d = t.d
  LEFT JOIN fx_gas_well_tests g ON b.well_id = g.well_id AND b.d = g.d
  LEFT JOIN fx_lab l ON b.well_id = l.well_id AND b.d = l.d
  LEFT JOIN fx_placed p ON b.well_id = p.well_id),
k AS (SELECT * FROM j WHERE well IS NOT NULL)
SELECT well_id, d, 'ERROR' AS level, 'WELL_UNKNOWN' AS code FROM j WHERE well IS NULL
UNION ALL SELECT well_id, d, 'ERROR', 'RESULT_DATE_INVALID' FROM k WHERE well_test_date IS NULL
UNION ALL SELECT well_id, d, 'ERROR', 'FLOWMETER_MISSING' FROM k
  WHERE field_id = 1 AND category_id IN (1, 2) AND sub_category_id = 1 AND n_events <= 1
UNION ALL SELECT well_id, d, 'ERROR', 'UPTIME_RANGE' FROM k WHERE uptime NOT BETWEEN 0 AND 24
UNION ALL SELECT well_id, d, 'ERROR', 'DOWNTIME_UNEXPLAINED' FROM k
  WHERE uptime < 24 AND (category IS NULL OR category = 0 OR comments IS NULL)
UNION ALL SELECT well_id, d, 'ERROR', 'LIQUID_RANGE' FROM k WHERE category_id IN (1, 2) AND liquid_ton > 500
UNION ALL SELECT well_id, d, 'ERROR', 'GAS_BELOW_GASLIFT' FROM k WHERE total_gas < gaslift_gas
UNION ALL SELECT well_id, d, 'ERROR', 'PERCENT_RANGE' FROM k WHERE cut NOT BETWEEN 0 AND 100""",
    "stale_results": VIEWS
    + """SELECT well_id, d, well_test_date, lab_date FROM fx_states
WHERE sub_category_id = 1 AND (date_diff('day', well_test_date, d) > 15 OR date_diff('day', lab_date, d) > 15)""",
    "meter_checks": VIEWS
    + """, r AS (
  SELECT meter_id, CAST(d - DATE '2014-12-31' AS INT) AS day_id, CAST(reading1 AS DOUBLE) AS reading1,
         CAST(CASE WHEN reading2 <> 3 THEN reading2 END AS DOUBLE) AS reading2
  FROM fx_meter),
ok AS (SELECT * FROM r WHERE reading2 IS NOT NULL),
pairs AS (
  SELECT o.*, y.reading2 AS before2, coalesce(y.reading2 <> o.reading1, FALSE) AS mismatch
  FROM ok o LEFT JOIN ok y ON o.meter_id = y.meter_id AND o.day_id - 1 = y.day_id),
runs AS (
  SELECT *, sum(CASE WHEN mismatch THEN 0 ELSE 1 END)
              OVER (PARTITION BY meter_id ORDER BY day_id) AS run FROM pairs),
fates AS (
  SELECT *, (row_number() OVER (PARTITION BY meter_id, run ORDER BY day_id) - 1) % 2 = 0 AS kept
  FROM runs)
SELECT r.meter_id, r.day_id, r.reading1, r.reading2, r.reading2 IS NULL AS incomplete, FALSE AS "exists",
  coalesce(NOT f.kept, FALSE) AS discontinuous, coalesce(f.kept, FALSE) AS inserted,
  coalesce(f.kept AND y.kept AND f.before2 = f.reading2, FALSE) AS stale
FROM r LEFT JOIN fates f ON r.meter_id = f.meter_id AND r.day_id = f.day_id
LEFT JOIN fates y ON r.meter_id = y.meter_id AND r.day_id - 1 = y.day_id""",
    "meter_checks_repeated": _WALK
    + """, r AS (
  SELECT user_id AS meter_id, event_id, CAST(d - DATE '2014-12-31' AS INT) AS day_id,
    CAST(k % 3 AS DOUBLE) AS reading1, CAST(CASE WHEN k % 7 <> 0 THEN (k // 3) % 3 END AS DOUBLE) AS reading2
  FROM ev),
nr AS (
  SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY day_id, event_id) AS n
  FROM r WHERE reading2 IS NOT NULL),
w AS (
  SELECT DISTINCT meter_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS INT) AS ld, CAST(NULL AS DOUBLE) AS lc,
    CAST(NULL AS INT) AS pd, CAST(NULL AS DOUBLE) AS pc, FALSE AS broken, FALSE AS taken, FALSE AS same FROM nr
  UNION ALL
  SELECT meter_id, n, CASE WHEN NOT broken AND NOT taken THEN day_id ELSE ld END,
    CASE WHEN NOT broken AND NOT taken THEN reading2 ELSE lc END,
    CASE WHEN NOT broken AND NOT taken THEN ld ELSE pd END,
    CASE WHEN NOT broken AND NOT taken THEN lc ELSE pc END,
    broken, taken, coalesce(before = reading2, FALSE)
  FROM (SELECT *, coalesce(before <> reading1, FALSE) AS broken FROM (
    SELECT w.meter_id, r.n, r.day_id, r.reading1, r.reading2, w.ld, w.lc, w.pd, w.pc,
      coalesce(w.ld = r.day_id, FALSE) AS taken,
      CASE WHEN w.ld = r.day_id - 1 THEN w.lc WHEN w.ld = r.day_id AND w.pd = r.day_id - 1 THEN w.pc END AS before
    FROM w JOIN nr r ON r.meter_id = w.meter_id AND r.n = w.n + 1)))
SELECT r.meter_id, r.event_id, r.day_id, r.reading1, r.reading2, r.reading2 IS NULL AS incomplete,
  coalesce(NOT broken AND taken, FALSE) AS "exists", coalesce(broken, FALSE) AS discontinuous,
  coalesce(NOT broken AND NOT taken, FALSE) AS inserted, coalesce(NOT broken AND NOT taken AND same, FALSE) AS stale
FROM r LEFT JOIN nr ON r.event_id = nr.event_id LEFT JOIN w ON nr.meter_id = w.meter_id AND nr.n = w.n""",
    "orphans": VIEWS
    + """SELECT 'l_partkey' AS fk, l_partkey AS value, count(*) AS rows FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM fx_completions_raw c WHERE c.horizon_id = l_partkey) GROUP BY l_partkey
UNION ALL SELECT 'o_custkey', o_custkey, count(*) FROM orders
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey) GROUP BY o_custkey""",
    "duplicates": """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    "nulls": VIEWS
    + """SELECT 'category_id' AS "column", count(*) AS rows FROM fx_well_stock_raw WHERE category_id IS NULL
UNION ALL SELECT 'method_id', count(*) FROM fx_well_stock_raw WHERE method_id IS NULL
UNION ALL SELECT 'name', count(*) FROM fx_placed WHERE platform_name IS NOT NULL AND well IS NULL
UNION ALL SELECT 'square', count(*) FROM fx_placed WHERE platform_name IS NOT NULL AND square IS NULL""",
    "month_end_target": VIEWS
    + """SELECT b.well_id, b.d, p.field_id, (SELECT produced_oil FROM fx_monthly m
    WHERE m.field_id = p.field_id AND m.report_date = last_day(b.d)) AS target,
  round((SELECT produced_oil FROM fx_monthly m
    WHERE m.field_id = p.field_id AND m.report_date = last_day(b.d)) / day(last_day(b.d)), 9) AS per_day
FROM fx_daily b LEFT JOIN fx_placed p ON b.well_id = p.well_id""",
    "allocate_pro_rata": VIEWS
    + """SELECT b.well_id, b.d, p.field_id, round(m.produced_oil / day(last_day(b.d)) * b.well_uptime_hours
  / nullif(sum(b.well_uptime_hours) OVER (PARTITION BY p.field_id, b.d), 0), 9) AS allocated
FROM fx_daily b LEFT JOIN fx_placed p ON b.well_id = p.well_id
LEFT JOIN fx_monthly m ON m.field_id = p.field_id AND m.report_date = last_day(b.d)""",
    "production_formulas": VIEWS
    + """SELECT well_id, d, round(oil_calc, 9) AS oil_ton, round(water_calc, 9) AS water_ton,
  coalesce(round(liquid_ton / 24 * well_uptime_hours), 0) AS liquid_ton,
  round(liquid_ton * ((100 - water_cut) / 100) * (24 - well_uptime_hours) / 24, 9) AS oil_loss_ton_wellTest,
  round(total_gas / 24 * well_uptime_hours) AS total_gas,
  round(gaslift_gas / 24 * well_uptime_hours) AS gaslift_gas,
  round((total_gas - gaslift_gas) * well_uptime_hours / 24) AS produced_gas,
  round(mechanical_impurities, 1) AS mechanical_impurities FROM fx_calc""",
    "complete_table": VIEWS
    + """SELECT d AS report_date, field, CASE WHEN square IS NULL OR square = '' THEN platform_name
    ELSE platform_name || ' / ' || square END AS platform, well, a.name AS well_stock_category,
  b.name AS production_well_stock_sub_category, e.name AS production_method, horizon, casing,
  CAST(NULL AS VARCHAR) AS completion_interval, CAST(NULL AS VARCHAR) AS tubing1_depth,
  CAST(NULL AS VARCHAR) AS tubing1_length, CAST(NULL AS VARCHAR) AS tubing2_depth,
  CAST(NULL AS VARCHAR) AS tubing2_length, CAST(NULL AS VARCHAR) AS tubing3_depth,
  CAST(NULL AS VARCHAR) AS tubing3_length, CAST(NULL AS VARCHAR) AS flowmeter, well_uptime_hours,
  water_cut, round(oil_calc, 9) AS oil_ton_wellTest, round(water_calc, 9) AS water_ton,
  round(m.produced_oil / day(last_day(d)) * oil_calc
    / nullif(sum(oil_calc) OVER (PARTITION BY c.field_id, d), 0), 9) AS oil_ton_allocated,
  coalesce(round(liquid_ton / 24 * well_uptime_hours), 0) AS liquid_ton,
  round(liquid_ton * ((100 - water_cut) / 100) * (24 - well_uptime_hours) / 24, 9) AS oil_loss_ton_wellTest,
  round(total_gas / 24 * well_uptime_hours) AS total_gas,
  round(gaslift_gas / 24 * well_uptime_hours) AS gaslift_gas,
  round((total_gas - gaslift_gas) * well_uptime_hours / 24) AS produced_gas,
  round(mechanical_impurities, 1) AS mechanical_impurities, CAST(pqa AS VARCHAR) AS Pqa,
  CAST(NULL AS VARCHAR) AS Phf, CAST(NULL AS VARCHAR) AS Pba, CAST(NULL AS VARCHAR) AS P6x9,
  CAST(NULL AS VARCHAR) AS P9x13, CAST(NULL AS VARCHAR) AS P13x20, CAST(NULL AS VARCHAR) AS choke,
  CAST(NULL AS DOUBLE) AS gaslift_gas_daily, CAST(NULL AS VARCHAR) AS gaslift_system_pressure,
  {nulls}, CAST(NULL AS BOOLEAN) AS esp_downhole_gas_separator, CAST(NULL AS VARCHAR) AS srp_pumpjack_type,
  CAST(downtime_category AS VARCHAR) AS downtime_category, s.name AS production_skin, comments
FROM fx_calc c LEFT JOIN fx_fields a ON c.category_id = a.id LEFT JOIN fx_fields b ON c.sub_category_id = b.id
LEFT JOIN fx_fields e ON c.method_id = e.id LEFT JOIN fx_fields s ON c.downtime_category + 1 = s.id
LEFT JOIN fx_monthly m ON m.field_id = c.field_id AND m.report_date = last_day(d)""",
    "split_table": VIEWS + "SELECT well_id, d, well_test_date, total_gas, gaslift_gas FROM fx_gas_well_tests",
    "evolve_schema": VIEWS
    + """SELECT well_id, d, lab_date, water_cut, CAST(NULL AS DOUBLE) AS reported_cut, 1 AS field_id,
  CAST(NULL AS VARCHAR) AS note FROM fx_lab""",
    "seed_rows": VIEWS
    + """SELECT v.name, d, count(*) AS rows FROM fx_well_stock_raw s LEFT JOIN (VALUES (1, 'Fəaliyyətdə'),
  (2, 'Fəaliyyətsiz'), (3, 'Qazmadan mənimsədə')) v(id, name) ON s.sub_category_id = v.id GROUP BY v.name, d""",
    "dimension_scan": VIEWS + "SELECT id, name, platform_id FROM fx_wells",
    "delete_created_on": VIEWS
    + """, c AS (SELECT *, CASE WHEN water_cut <> 7 THEN lab_date END AS created_at FROM fx_lab)
SELECT well_id, d, event_id, created_at FROM c WHERE created_at IS DISTINCT FROM DATE '2024-01-09'""",
    "delete_report": VIEWS
    + """SELECT t.well_id, CAST(t.d - DATE '2014-12-31' AS INT) AS report_date_id, t.event_id FROM fx_well_tests t
WHERE NOT (t.d = DATE '2024-01-12' AND EXISTS (SELECT 1 FROM fx_wells w WHERE w.id = t.well_id AND w.platform_id = 7))""",
    "delete_report_all": VIEWS
    + """SELECT t.well_id, CAST(t.d - DATE '2014-12-31' AS INT) AS report_date_id, t.event_id FROM fx_well_tests t
WHERE NOT (t.d = DATE '2024-01-12' AND EXISTS (SELECT 1 FROM fx_placed p
  WHERE p.well_id = t.well_id AND p.platform_name IS NOT NULL))""",
    "recode_values": VIEWS
    + """SELECT well_id, d, CASE sub_category_id + 1 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3
  ELSE sub_category_id + 1 END AS sub_category_id FROM fx_well_stock_raw""",
    "update_where": VIEWS
    + """, u AS (SELECT p_brand, max(p_size) / CAST(100 AS DOUBLE) AS density FROM part GROUP BY p_brand
  HAVING max(p_size) / CAST(100 AS DOUBLE) >= 0.5)
SELECT h.id, h.name, h.field_id, CASE WHEN u.p_brand IS NOT NULL THEN u.density
  WHEN h.name = 'Brand#7' AND h.field_id = 1 THEN CAST(0.754 AS DOUBLE) ELSE h.oil_density END AS density
FROM fx_horizons h LEFT JOIN u ON h.name = u.p_brand""",
    "delete_ids": VIEWS + "SELECT id, name FROM fx_horizons WHERE id NOT IN (1, 4, 5, 6, 14, 16, 17)",
    "shift_key": VIEWS
    + "SELECT well_id, CAST(d - DATE '2023-12-31' AS INT) + 3287 AS report_date_id FROM fx_daily",
    "state_changes": VIEWS
    + """, prior AS (SELECT b.well_id, b.d, x.comments FROM fx_daily b
  ASOF LEFT JOIN fx_downtime_raw x ON b.well_id = x.well_id AND b.d > x.d)
SELECT s.well_id, s.d, s.comments IS DISTINCT FROM p.comments AS changed
FROM fx_states s JOIN prior p ON s.well_id = p.well_id AND s.d = p.d""",
}


def _null_doubles() -> str:
    from dayledger.sources.schemas import PUMP_NUMBERS, ROD_AND_SCREW_NUMBERS

    return ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in (*PUMP_NUMBERS, *ROD_AND_SCREW_NUMBERS))


def _cells(names: tuple[str, ...], first: int, kind: str) -> str:
    """Values of neighbouring sheet columns: the row's number and the column's."""
    return ", ".join(
        f"CASE WHEN m % 3 <> 0 THEN CAST(CAST(m + {first + i} AS VARCHAR) || '.5' AS {kind}) END AS {n}"
        for i, n in enumerate(names)
    )


def _parameter_cells() -> tuple[str, str]:
    from dayledger.sources.schemas import PRESSURES, PUMP_NUMBERS, ROD_AND_SCREW_NUMBERS

    numbers = _cells(PUMP_NUMBERS, 38, "DOUBLE") + ", " + _cells(ROD_AND_SCREW_NUMBERS, 47, "DOUBLE")
    return _cells(PRESSURES[1:], 30, "VARCHAR"), numbers


_pressures, _numbers = _parameter_cells()
ORACLES["sheet_parameters"] = (
    ORACLES["sheet_parameters"].replace("{pressures}", _pressures).replace("{numbers}", _numbers)
)
ORACLES["complete_table"] = ORACLES["complete_table"].replace("{nulls}", _null_doubles())
ORACLES["complete_table_range"] = (
    f"SELECT * FROM ({ORACLES['complete_table']}) WHERE report_date BETWEEN DATE '2024-01-12' AND DATE '2024-01-14'"
)


def _constraints() -> str:
    """A line of SQL for each constraint of the sample mart."""
    wells, days = ("well_id", "well_id", "wells", "fx_wells"), ("report_date_id", "d", "report_dates", "calendar_days")
    names = "fx_fields"
    tables = {
        "well_stock": ("fx_well_stock_raw", ("well_id", "d"), "well_id, report_date_id", [
            wells, days,
            ("well_stock_category_id", "category_id", "well_stock_categories", names),
            ("production_well_stock_sub_category_id", "sub_category_id", "production_well_stock_sub_categories", names),
            ("production_method_id", "method_id", "production_methods", names),
        ]),
        "completions": ("fx_completions_raw", ("well_id", "d"), "well_id, report_date_id", [
            wells, days, ("horizon_id", "horizon_id", "horizons", "fx_horizons"),
        ]),
        "well_downtime_reasons": ("fx_downtime_raw", ("well_id", "d"), "well_id, report_date_id", [
            wells, days,
            ("production_sub_skins_activity_id", "category + 1", "production_sub_skins_activities", names),
        ]),
        "daily_well_parameters": ("fx_daily", ("well_id", "d"), "well_id, report_date_id", [wells, days]),
        "well_tests": ("fx_well_tests", ("well_id", "well_test_date"), "well_id, well_test_date", [wells, days]),
        "gas_well_tests": ("fx_gas_well_tests", ("well_id", "well_test_date"), "well_id, well_test_date", [wells, days]),
        "laboratory_results": ("fx_lab", ("well_id", "lab_date"), "well_id, last_lab_date", [wells, days]),
        "monthly_reported": ("fx_monthly", ("field_id", "report_date"), "field_id, report_date_id", [
            ("field_id", "field_id", "fields", names), ("report_date_id", "report_date", "report_dates", "calendar_days"),
        ]),
    }
    lines = []

    def line(name: str, source: str, violating: str) -> None:
        lines.append(
            f"SELECT '{name}' AS \"constraint\", (SELECT count(*) FROM {source}) AS checked, "
            f"(SELECT count(*) FROM {source} WHERE {violating}) AS violations"
        )

    for table, (source, key, key_name, references) in tables.items():
        line(f"{table}({key_name}) not_null", source, " OR ".join(f"{c} IS NULL" for c in key))
        columns = ", ".join(key)
        repeated = f"({columns}) IN (SELECT ({columns}) FROM {source} GROUP BY {columns} HAVING count(*) > 1)"
        line(f"{table}({key_name}) unique", source, repeated)
        for column, value, parent, rows in references:
            missing = f"{value} IS NOT NULL AND {value} NOT IN (SELECT id FROM {rows})"
            line(f"{table}({column}) refers -> {parent}.id", source, missing)
    days_sql = "calendar_days AS (SELECT CAST(unnest(generate_series(DATE '2015-01-01', DATE '2030-01-01', INTERVAL 1 DAY)) AS DATE) AS id)"
    return VIEWS + f", {days_sql}\n" + "\nUNION ALL ".join(lines)


ORACLES["mart_constraints"] = _constraints()
