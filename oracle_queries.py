"""DuckDB oracle SQL for each ``queries()`` entry (views of the driver tables pre-registered).

The CTE fragments restate the table mapping of ``stationdw/plans/bridge.py`` in SQL. Decimal
arithmetic uses decimal literals; DuckDB returns DOUBLE for AVG of a decimal, so averages are
cast back to the decimal scale Spark keeps (input scale + 4) before rounding.
"""

D01 = "CAST(0.1 AS DECIMAL(2,1))"
D001 = "CAST(0.01 AS DECIMAL(3,2))"
D05 = "CAST(0.5 AS DECIMAL(2,1))"

ORDERS = f"""
per_day AS (
  SELECT c.c_nationkey AS nk, CAST(o.o_orderdate AS DATE) AS norm_date,
         MIN(CAST(o.o_totalprice AS DECIMAL(12,2))) AS dly_tmin_normal,
         MAX(CAST(o.o_totalprice AS DECIMAL(12,2))) AS dly_tmax_normal,
         COUNT(*) AS n_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2
),
staging AS (
  SELECT CAST(p.nk AS VARCHAR) AS station_id, n.n_name AS station_name,
         CAST(NULL AS DECIMAL(8,2)) AS elevation,
         CAST(n.n_regionkey AS DECIMAL(10,6)) AS latitude,
         CAST(NULL AS DECIMAL(10,6)) AS longitude,
         p.norm_date, p.dly_tmin_normal, p.dly_tmax_normal,
         CAST(SUM(p.n_orders) OVER (
             PARTITION BY p.nk, year(p.norm_date), month(p.norm_date) ORDER BY p.norm_date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(20,2))
           AS mtd_prcp_normal
  FROM per_day p JOIN nation n ON p.nk = n.n_nationkey
),
dim_station AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY station_id) AS INTEGER) AS station_key, *
  FROM (SELECT DISTINCT station_id, station_name, elevation, latitude, longitude FROM staging)
),
daily AS (
  SELECT station_id, station_name, latitude, longitude,
         CAST(year(norm_date) AS INTEGER) AS year_num,
         CAST(month(norm_date) AS INTEGER) AS month_num,
         strftime(norm_date, '%B') AS month_name,
         CAST(quarter(norm_date) AS INTEGER) AS quarter_num,
         norm_date AS full_date,
         ROUND(dly_tmin_normal * {D01}, 2) AS dly_tmin_normal_f,
         ROUND(dly_tmax_normal * {D01}, 2) AS dly_tmax_normal_f,
         ROUND(mtd_prcp_normal * {D001}, 2) AS mtd_prcp_normal_in
  FROM staging
  WHERE dly_tmin_normal IS NOT NULL AND dly_tmax_normal IS NOT NULL
    AND mtd_prcp_normal IS NOT NULL
),
monthly AS (
  SELECT station_id, station_name, latitude, longitude, year_num, month_num, month_name,
         COUNT(*) AS num_days,
         ROUND(CAST(AVG((dly_tmin_normal_f + dly_tmax_normal_f) * {D05}) AS DECIMAL(38,7)), 2)
           AS avg_t,
         ROUND(MAX(dly_tmax_normal_f), 2) AS max_t,
         ROUND(MIN(dly_tmin_normal_f), 2) AS min_t,
         ROUND(MAX(mtd_prcp_normal_in), 2) AS prcp
  FROM daily
  GROUP BY station_id, station_name, latitude, longitude, year_num, month_num, month_name
)"""

EVENTS = """
ev AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS station_id,
         CASE WHEN event_type <> 'error' THEN 'USER ' || CAST(user_id AS VARCHAR) END
           AS station_name,
         value AS elevation_d,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS latitude_d,
         strftime(ts, '%Y%m%d') AS norm_date_s,
         CAST(ts AS DATE) AS norm_date,
         CAST(floor(value) AS INTEGER) AS tmin_i,
         CAST(ceil(value) AS INTEGER) AS tmax_i,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS mtd_i
  FROM events
),
ev_valid AS (SELECT * FROM ev WHERE station_name IS NOT NULL),
ev_staging AS (
  SELECT station_id, station_name,
         CAST(elevation_d AS DECIMAL(8,2)) AS elevation,
         CAST(latitude_d AS DECIMAL(10,6)) AS latitude,
         CAST(NULL AS DECIMAL(10,6)) AS longitude,
         norm_date,
         CAST(tmin_i AS DECIMAL(7,2)) AS dly_tmin_normal,
         CAST(tmax_i AS DECIMAL(7,2)) AS dly_tmax_normal,
         CAST(mtd_i AS DECIMAL(10,2)) AS mtd_prcp_normal
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id, norm_date
                                     ORDER BY event_id DESC) AS rn
        FROM ev_valid)
  WHERE rn = 1
),
ev_clean AS (
  SELECT station_id, station_name, elevation_d AS elevation, latitude_d AS latitude,
         CAST(NULL AS DOUBLE) AS longitude, norm_date_s AS norm_date,
         CAST(substr(norm_date_s, 1, 4) AS INTEGER) AS year_num,
         CAST(substr(norm_date_s, 5, 2) AS INTEGER) AS month_num,
         substr(norm_date_s, 1, 6) AS norm_month,
         CAST(tmin_i AS DOUBLE) AS dly_tmin_normal,
         CAST(tmax_i AS DOUBLE) AS dly_tmax_normal,
         CAST(mtd_i AS DOUBLE) AS mtd_prcp_normal,
         event_id
  FROM ev
),
ev_summary AS (
  SELECT station_id, station_name, norm_month, year_num, month_num,
         COUNT(*) AS num_days,
         AVG(dly_tmin_normal) AS avg_dly_tmin_normal,
         AVG(dly_tmax_normal) AS avg_dly_tmax_normal,
         MAX(mtd_prcp_normal) AS month_end_prcp_normal
  FROM ev_clean
  WHERE station_id IS NOT NULL AND station_name IS NOT NULL AND norm_month IS NOT NULL
    AND year_num IS NOT NULL AND month_num IS NOT NULL
  GROUP BY station_id, station_name, norm_month, year_num, month_num
)"""


def _with(*fragments: str) -> str:
    return "WITH " + ",".join(f.strip() for f in fragments) + "\n"


STAGING_SELECT = """
SELECT station_id, station_name, CAST(elevation AS DOUBLE) AS elevation,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       norm_date, CAST(dly_tmin_normal AS DOUBLE) AS dly_tmin_normal,
       CAST(dly_tmax_normal AS DOUBLE) AS dly_tmax_normal,
       CAST(mtd_prcp_normal AS DOUBLE) AS mtd_prcp_normal
FROM ev_staging"""

SUMMARY_TABLE_SELECT = """
SELECT station_id, station_name, norm_month, year_num, month_num,
       CAST(num_days AS INTEGER) AS num_days,
       CAST(CAST(avg_dly_tmin_normal AS DECIMAL(7,2)) AS DOUBLE) AS avg_dly_tmin_normal,
       CAST(CAST(avg_dly_tmax_normal AS DECIMAL(7,2)) AS DOUBLE) AS avg_dly_tmax_normal,
       CAST(CAST(month_end_prcp_normal AS DECIMAL(10,2)) AS DOUBLE) AS month_end_prcp_normal
FROM ev_summary"""

CLEAN_SELECT = """
SELECT station_id, station_name, elevation, latitude, longitude, norm_date, year_num,
       month_num, norm_month, dly_tmin_normal, dly_tmax_normal, mtd_prcp_normal, event_id
FROM ev_clean"""

DIM_DATE_ROWS = """
SELECT DISTINCT CAST(strftime(norm_date, '%Y%m%d') AS INTEGER) AS date_key,
       norm_date AS full_date, CAST(day(norm_date) AS INTEGER) AS day_num,
       CAST(month(norm_date) AS INTEGER) AS month_num, strftime(norm_date, '%B') AS month_name,
       CAST(quarter(norm_date) AS INTEGER) AS quarter_num,
       CAST(year(norm_date) AS INTEGER) AS year_num"""

FACT_ROWS = """
SELECT CAST(strftime(s.norm_date, '%Y%m%d') AS INTEGER) AS date_key, d.station_key,
       CAST(s.dly_tmin_normal AS DOUBLE) AS dly_tmin_normal,
       CAST(s.dly_tmax_normal AS DOUBLE) AS dly_tmax_normal,
       CAST(s.mtd_prcp_normal AS DOUBLE) AS mtd_prcp_normal
FROM staging s JOIN dim_station d ON s.station_id = d.station_id"""

ORACLE_SQL = {
    "q1_monthly": _with(ORDERS) + """
SELECT station_id, station_name, year_num, month_num, month_name, num_days,
       CAST(avg_t AS DOUBLE) AS monthly_avg_temperature_normal,
       CAST(max_t AS DOUBLE) AS monthly_max_temperature_normal,
       CAST(min_t AS DOUBLE) AS monthly_min_temperature_normal,
       CAST(prcp AS DOUBLE) AS monthly_total_precipitation_normal
FROM monthly ORDER BY station_name, year_num, month_num""",

    "q2_compare": _with(ORDERS, """
cmp AS (
  SELECT year_num, month_num, month_name,
         MAX(CASE WHEN station_id = '1' THEN avg_t END) AS l_avg,
         MAX(CASE WHEN station_id = '2' THEN avg_t END) AS r_avg,
         MAX(CASE WHEN station_id = '1' THEN prcp END) AS l_p,
         MAX(CASE WHEN station_id = '2' THEN prcp END) AS r_p
  FROM monthly WHERE station_id IN ('1', '2')
  GROUP BY year_num, month_num, month_name
)""") + """
SELECT year_num, month_num, month_name,
       CAST(l_avg AS DOUBLE) AS n1_avg_temperature, CAST(r_avg AS DOUBLE) AS n2_avg_temperature,
       CAST(ROUND(l_avg - r_avg, 2) AS DOUBLE) AS n1_minus_n2_avg_temperature,
       CAST(l_p AS DOUBLE) AS n1_total_precipitation,
       CAST(r_p AS DOUBLE) AS n2_total_precipitation,
       CAST(ROUND(l_p - r_p, 2) AS DOUBLE) AS n1_minus_n2_precipitation
FROM cmp ORDER BY year_num, month_num""",

    "q3_season": _with(ORDERS, """
ss AS (
  SELECT station_id, station_name, year_num,
         CASE WHEN month_num IN (12, 1, 2) THEN 'Winter' WHEN month_num IN (3, 4, 5)
              THEN 'Spring' WHEN month_num IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END
           AS season_name,
         CASE WHEN month_num IN (12, 1, 2) THEN 1 WHEN month_num IN (3, 4, 5) THEN 2
              WHEN month_num IN (6, 7, 8) THEN 3 ELSE 4 END AS season_order,
         ROUND(CAST(AVG(avg_t) AS DECIMAL(38,6)), 2) AS s_avg,
         ROUND(MAX(max_t), 2) AS s_max, ROUND(MIN(min_t), 2) AS s_min,
         ROUND(SUM(prcp), 2) AS s_p
  FROM monthly WHERE station_id IN ('3', '4')
  GROUP BY station_id, station_name, year_num, season_name, season_order
)""") + """
SELECT year_num, season_name, station_name,
       CAST(s_avg AS DOUBLE) AS seasonal_avg_temperature,
       CAST(s_max AS DOUBLE) AS seasonal_max_temperature,
       CAST(s_min AS DOUBLE) AS seasonal_min_temperature,
       CAST(ROUND(s_max - s_min, 2) AS DOUBLE) AS seasonal_temperature_range,
       CAST(s_p AS DOUBLE) AS seasonal_total_precipitation
FROM ss ORDER BY year_num, season_order, station_name""",

    "q4_gap_rank": _with(ORDERS, """
pm AS (
  SELECT year_num, month_num, month_name,
         MAX(CASE WHEN station_id = '5' THEN latitude END) AS a_lat,
         MAX(CASE WHEN station_id = '6' THEN latitude END) AS b_lat,
         MAX(CASE WHEN station_id = '5' THEN avg_t END) AS a_avg,
         MAX(CASE WHEN station_id = '6' THEN avg_t END) AS b_avg,
         MAX(CASE WHEN station_id = '5' THEN prcp END) AS a_p,
         MAX(CASE WHEN station_id = '6' THEN prcp END) AS b_p
  FROM monthly WHERE station_id IN ('5', '6')
  GROUP BY year_num, month_num, month_name
)""") + """
SELECT year_num, month_num, month_name,
       CAST(a_lat AS DOUBLE) AS n5_latitude, CAST(b_lat AS DOUBLE) AS n6_latitude,
       CAST(a_avg AS DOUBLE) AS n5_avg_temperature, CAST(b_avg AS DOUBLE) AS n6_avg_temperature,
       CAST(ROUND(b_avg - a_avg, 2) AS DOUBLE) AS n6_minus_n5_temperature,
       CAST(a_p AS DOUBLE) AS n5_total_precipitation,
       CAST(b_p AS DOUBLE) AS n6_total_precipitation,
       CAST(ROUND(b_p - a_p, 2) AS DOUBLE) AS n6_minus_n5_precipitation,
       RANK() OVER (ORDER BY ABS(b_avg - a_avg) DESC NULLS LAST)
         AS temperature_difference_rank
FROM pm ORDER BY temperature_difference_rank, year_num, month_num""",

    "q5_annual_profile": _with(ORDERS, """
ap AS (
  SELECT station_id, station_name, year_num,
         ROUND(CAST(AVG(avg_t) AS DECIMAL(38,6)), 2) AS a_avg,
         ROUND(MAX(max_t), 2) AS a_max, ROUND(MIN(min_t), 2) AS a_min,
         ROUND(MAX(max_t) - MIN(min_t), 2) AS a_range, ROUND(SUM(prcp), 2) AS a_p
  FROM monthly GROUP BY station_id, station_name, year_num
),
wm AS (
  SELECT station_id, year_num, month_name AS wettest_month_name,
         prcp AS wettest_month_precipitation,
         ROW_NUMBER() OVER (PARTITION BY station_id, year_num
                            ORDER BY prcp DESC NULLS LAST, month_num) AS rn
  FROM monthly
)""") + """
SELECT ap.station_id, ap.station_name, ap.year_num,
       CAST(a_avg AS DOUBLE) AS annual_avg_temperature,
       CAST(a_max AS DOUBLE) AS annual_max_temperature,
       CAST(a_min AS DOUBLE) AS annual_min_temperature,
       CAST(a_range AS DOUBLE) AS annual_temperature_range,
       CAST(a_p AS DOUBLE) AS annual_total_precipitation,
       wm.wettest_month_name,
       CAST(wm.wettest_month_precipitation AS DOUBLE) AS wettest_month_precipitation,
       CAST(RANK() OVER (PARTITION BY ap.year_num ORDER BY a_range DESC NULLS LAST) AS INTEGER)
         AS annual_temperature_range_rank
FROM ap JOIN wm ON ap.station_id = wm.station_id AND ap.year_num = wm.year_num
WHERE wm.rn = 1
ORDER BY ap.year_num, annual_temperature_range_rank, ap.station_name""",

    "q6_monthly_summary": _with(EVENTS) + "SELECT * FROM ev_summary",

    "dim_station": _with(ORDERS) + """
SELECT station_key, station_id, station_name, CAST(elevation AS DOUBLE) AS elevation,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude
FROM dim_station""",

    "dim_date": _with(ORDERS) + DIM_DATE_ROWS + " FROM staging",

    "fact_load": _with(ORDERS) + FACT_ROWS,

    "fact_reload": _with(ORDERS) + """
SELECT s.station_id, CAST(strftime(s.norm_date, '%Y%m%d') AS INTEGER) AS date_key,
       d.station_key, CAST(s.dly_tmin_normal AS DOUBLE) AS dly_tmin_normal,
       CAST(s.dly_tmax_normal AS DOUBLE) AS dly_tmax_normal,
       CAST(s.mtd_prcp_normal AS DOUBLE) AS mtd_prcp_normal
FROM staging s JOIN dim_station d ON s.station_id = d.station_id""",

    "daily_view": _with(ORDERS) + """
SELECT station_id, station_name, CAST(latitude AS DOUBLE) AS latitude,
       CAST(longitude AS DOUBLE) AS longitude, year_num, month_num, month_name, quarter_num,
       full_date, CAST(dly_tmin_normal_f AS DOUBLE) AS dly_tmin_normal_f,
       CAST(dly_tmax_normal_f AS DOUBLE) AS dly_tmax_normal_f,
       CAST(mtd_prcp_normal_in AS DOUBLE) AS mtd_prcp_normal_in
FROM daily""",

    "load_report": _with(ORDERS) + """
SELECT 'staging_rows' AS stage, COUNT(*) AS row_count FROM staging
UNION ALL SELECT 'staging_stations', COUNT(DISTINCT station_id) FROM staging
UNION ALL SELECT 'staging_dates', COUNT(DISTINCT norm_date) FROM staging
UNION ALL SELECT 'dim_station', COUNT(*) FROM dim_station
UNION ALL SELECT 'dim_date', COUNT(DISTINCT norm_date) FROM staging
UNION ALL SELECT 'fact_upserted', COUNT(*) FROM (""" + FACT_ROWS + ")",

    "check_domain": _with(ORDERS) + """
SELECT station_id, norm_date, violations FROM (
  SELECT station_id, norm_date, concat_ws(',',
    CASE WHEN length(station_id) > 30 THEN 'station_id' END,
    CASE WHEN length(station_name) > 100 THEN 'station_name' END,
    CASE WHEN abs(elevation) >= 1000000 THEN 'elevation' END,
    CASE WHEN abs(latitude) >= 10000 THEN 'latitude' END,
    CASE WHEN abs(longitude) >= 10000 THEN 'longitude' END,
    CASE WHEN abs(dly_tmin_normal) >= 100000 THEN 'dly_tmin_normal' END,
    CASE WHEN abs(dly_tmax_normal) >= 100000 THEN 'dly_tmax_normal' END,
    CASE WHEN abs(mtd_prcp_normal) >= 100000000 THEN 'mtd_prcp_normal' END) AS violations
  FROM staging)
WHERE violations <> ''""",

    "check_fk": """
SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE o.o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""",

    "check_fk_users": """
SELECT e.event_id, e.user_id FROM events e
WHERE e.user_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = e.user_id)""",

    "check_fk_star": _with(ORDERS) + FACT_ROWS + " WHERE d.station_key IS NULL",

    "first_per_group": _with(ORDERS) + """
SELECT station_id, year_num, month_num, month_name,
       CAST(prcp AS DOUBLE) AS monthly_total_precipitation_in
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id, year_num
                                   ORDER BY prcp DESC NULLS LAST, month_num) AS rn
      FROM monthly)
WHERE rn = 1""",

    "global_rank": _with(ORDERS) + """
SELECT station_id, year_num, month_num, CAST(avg_t AS DOUBLE) AS monthly_avg_temperature_f,
       RANK() OVER (ORDER BY avg_t DESC NULLS LAST) AS avg_rank
FROM monthly""",

    "staging_upsert": _with(EVENTS) + STAGING_SELECT,

    "split_valid_ok": _with(EVENTS) + """
SELECT station_id, station_name, CAST(CAST(elevation_d AS DECIMAL(8,2)) AS DOUBLE) AS elevation,
       CAST(CAST(latitude_d AS DECIMAL(10,6)) AS DOUBLE) AS latitude,
       CAST(NULL AS DOUBLE) AS longitude, norm_date,
       CAST(tmin_i AS DOUBLE) AS dly_tmin_normal, CAST(tmax_i AS DOUBLE) AS dly_tmax_normal,
       CAST(mtd_i AS DOUBLE) AS mtd_prcp_normal, event_id
FROM ev_valid""",

    "split_valid_bad": _with(EVENTS) + """
SELECT station_id, norm_date, 'missing station_name' AS reject_reason, event_id
FROM ev WHERE station_name IS NULL""",

    "check_unique": _with(EVENTS) + """
SELECT station_id, norm_date, COUNT(*) AS dup_count FROM ev_valid
GROUP BY station_id, norm_date HAVING COUNT(*) > 1""",

    "check_not_null": _with(EVENTS) + """
SELECT station_id, norm_date, event_id, 'station_name' AS null_columns
FROM ev WHERE station_name IS NULL""",

    "distinct_stations": _with(EVENTS) + """
SELECT station_id, station_name, CAST(elevation AS DOUBLE) AS elevation,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY norm_date) AS rn
      FROM ev_staging)
WHERE rn = 1""",

    "upsert_dim": _with(ORDERS, EVENTS, """
inc AS (
  SELECT station_id, station_name, elevation, latitude, longitude
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY norm_date) AS rn
        FROM ev_staging)
  WHERE rn = 1
),
matched AS (
  SELECT d.station_key, i.* FROM inc i JOIN dim_station d ON i.station_id = d.station_id
),
fresh AS (
  SELECT CAST((SELECT MAX(station_key) FROM dim_station)
              + ROW_NUMBER() OVER (ORDER BY i.station_id) AS INTEGER) AS station_key, i.*
  FROM inc i WHERE i.station_id NOT IN (SELECT station_id FROM dim_station)
),
untouched AS (
  SELECT d.station_key, d.station_id, d.station_name, d.elevation, d.latitude, d.longitude
  FROM dim_station d WHERE d.station_id NOT IN (SELECT station_id FROM inc)
),
merged AS (
  SELECT * FROM untouched UNION ALL SELECT * FROM matched UNION ALL SELECT * FROM fresh
)""") + """
SELECT station_key, station_id, station_name, CAST(elevation AS DOUBLE) AS elevation,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude
FROM merged""",

    "insert_ignore": _with(ORDERS, EVENTS, """
all_dates AS (SELECT norm_date FROM staging UNION SELECT norm_date FROM ev_staging)""")
    + DIM_DATE_ROWS + " FROM all_dates",

    "clean_readings": _with(EVENTS) + CLEAN_SELECT,

    "pick_fields": _with(EVENTS) + SUMMARY_TABLE_SELECT,

    "stream_clean": _with(EVENTS) + CLEAN_SELECT,

    "stream_monthly": _with(EVENTS) + SUMMARY_TABLE_SELECT,

    "watch_latest": _with(EVENTS) + CLEAN_SELECT + """
QUALIFY ROW_NUMBER() OVER (PARTITION BY station_id, norm_month ORDER BY event_id DESC) = 1""",

    "stream_staging": _with(EVENTS) + STAGING_SELECT,

    "stream_changelog": _with(EVENTS) + SUMMARY_TABLE_SELECT,

    "stream_replay": _with(EVENTS) + STAGING_SELECT,

    "stream_two_subscribers": _with(EVENTS) + """
SELECT 'staging' AS subscriber, strftime(norm_date, '%Y%m') AS norm_month, COUNT(*) AS readings
FROM ev_staging GROUP BY 2
UNION ALL
SELECT 'summary', norm_month, CAST(SUM(num_days) AS BIGINT) FROM ev_summary GROUP BY 2""",

    "summary_rejected": _with(EVENTS) + """
SELECT station_id, norm_month,
       CASE WHEN CAST(station_id AS INTEGER) % 4 = 2 THEN 'missing station_name' END
         AS reject_reason
FROM ev_summary WHERE CAST(station_id AS INTEGER) % 4 >= 2""",

    "month_slice": _with(EVENTS) + """
SELECT station_id, CAST(strftime(norm_date, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(dly_tmin_normal AS DOUBLE) AS dly_tmin_normal,
       CAST(dly_tmax_normal AS DOUBLE) AS dly_tmax_normal,
       CAST(mtd_prcp_normal AS DOUBLE) AS mtd_prcp_normal
FROM ev_staging WHERE strftime(norm_date, '%Y%m') = '202401'""",

    "load_after_crash": _with(ORDERS, EVENTS) + """
SELECT station_id, CAST(strftime(norm_date, '%Y%m%d') AS INTEGER) AS date_key,
       strftime(norm_date, '%B') AS month_name,
       CAST(dly_tmin_normal AS DOUBLE) AS dly_tmin_normal,
       CAST(dly_tmax_normal AS DOUBLE) AS dly_tmax_normal,
       CAST(mtd_prcp_normal AS DOUBLE) AS mtd_prcp_normal
FROM (SELECT station_id, norm_date,
             ROUND(dly_tmin_normal * CAST(0.1 AS DECIMAL(2,1)), 2) AS dly_tmin_normal,
             ROUND(dly_tmax_normal * CAST(0.1 AS DECIMAL(2,1)), 2) AS dly_tmax_normal,
             mtd_prcp_normal
      FROM staging
      UNION ALL
      SELECT station_id, norm_date, dly_tmin_normal, dly_tmax_normal, mtd_prcp_normal
      FROM ev_staging)""",

    "shared_views": _with(ORDERS, """
scaled AS (
  SELECT * REPLACE (CAST(dly_tmin_normal * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(7,2)) AS dly_tmin_normal,
                    CAST(dly_tmax_normal * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(7,2)) AS dly_tmax_normal)
  FROM staging
),
shared_daily AS (
  SELECT station_id, station_name, latitude, longitude, norm_date,
         ROUND(dly_tmin_normal * CAST(0.1 AS DECIMAL(2,1)), 2) AS lo,
         ROUND(dly_tmax_normal * CAST(0.1 AS DECIMAL(2,1)), 2) AS hi,
         ROUND(mtd_prcp_normal * CAST(0.01 AS DECIMAL(3,2)), 2) AS wet
  FROM scaled
  WHERE dly_tmin_normal IS NOT NULL AND dly_tmax_normal IS NOT NULL
    AND mtd_prcp_normal IS NOT NULL
)""") + """
SELECT station_id, station_name, CAST(latitude AS DOUBLE) AS latitude,
       CAST(longitude AS DOUBLE) AS longitude,
       CAST(year(norm_date) AS INTEGER) AS year_num,
       CAST(month(norm_date) AS INTEGER) AS month_num, strftime(norm_date, '%B') AS month_name,
       COUNT(*) AS num_days,
       CAST(ROUND(CAST(AVG((lo + hi) * CAST(0.5 AS DECIMAL(2,1))) AS DECIMAL(38,7)), 2) AS DOUBLE)
         AS monthly_avg_temperature_f,
       CAST(MAX(hi) AS DOUBLE) AS monthly_max_temperature_f,
       CAST(MIN(lo) AS DOUBLE) AS monthly_min_temperature_f,
       CAST(MAX(wet) AS DOUBLE) AS monthly_total_precipitation_in
FROM shared_daily GROUP BY ALL""",

    "created_at_kept": _with(EVENTS) + "SELECT station_id, norm_date, TRUE AS kept FROM ev_staging",

    "read_csv": _with(ORDERS) + """
SELECT station_id, station_name || ',' || chr(10) || '"' || station_id || '"' AS station_name,
       CAST(NULL AS DOUBLE) AS elevation, CAST(latitude AS DOUBLE) AS latitude,
       CAST(NULL AS DOUBLE) AS longitude, strftime(norm_date, '%Y%m%d') AS norm_date,
       CAST(trunc(dly_tmin_normal) AS INTEGER) AS dly_tmin_normal,
       CAST(trunc(dly_tmax_normal) AS INTEGER) AS dly_tmax_normal,
       CAST(mtd_prcp_normal AS INTEGER) AS mtd_prcp_normal
FROM staging""",
}
# The same report, through its files.
ORACLE_SQL["report_csv"] = ORACLE_SQL["q1_monthly"]
