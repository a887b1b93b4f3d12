"""The same results as plain SQL, written independently of the Spark plans.

Coverage fractions, for one, come from integrating every edge against every cell of the grid, and the
resampling gathers four neighbours where the library scatters.
"""

from __future__ import annotations


def _r(expr: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


def _exact(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(28,9)) AS DOUBLE)"


D = "CAST({} AS DOUBLE)".format
STEP = D("0.75")


def _obs(value: str = "value", name: str = "obs") -> str:
    return f"""{name} AS (
  SELECT event_type AS variable, ts AS valid_time, CAST(ts AS DATE) AS date,
         CAST((event_id % 150) // 15 AS INTEGER) AS iy, CAST((event_id % 150) % 15 AS INTEGER) AS ix,
         (CAST((event_id % 150) // 15 AS DOUBLE) + 0.5) * {STEP} AS lat,
         (CAST((event_id % 150) % 15 AS DOUBLE) + 0.5) * {STEP} AS lon,
         {value} AS value
  FROM events)"""


OBS = _obs()
OBS_NULL = _obs("CASE WHEN event_id % 97 <> 0 THEN value END")
OBS_COLUMNS = "variable, valid_time, date, iy, ix, value"

FORECAST = """fc AS (
  SELECT event_type AS variable,
         date_trunc('day', ts) + CASE WHEN event_id % 2 = 0 THEN INTERVAL 0 HOUR ELSE INTERVAL 12 HOUR END AS run_time,
         CAST(event_id % 121 AS INTEGER) AS lead_hour,
         CAST((event_id % 150) // 15 AS INTEGER) AS iy, CAST((event_id % 150) % 15 AS INTEGER) AS ix, value
  FROM events)"""

# The value between the two rows around a probability; alone, a row is its own quantile.
QUANTILE = """max(CASE WHEN n = 1 THEN v WHEN s <= {p} * top AND {p} * top < s2 THEN v + (v2 - v) * ({p} * top - s) / (s2 - s) END)"""

RUN_CELLS = """SELECT variable, run_time, lead_hour, run_time + lead_hour * INTERVAL 1 HOUR AS valid_time, iy, ix, max(value) AS value
  FROM fc {where} GROUP BY ALL"""


def _zone_rows(key: str, shift: str, extra: str = "") -> str:
    return f"""SELECT CAST({key} AS BIGINT) AS zone_id,
         CAST(n_nationkey % 5 AS DOUBLE) * {D('2.2')} + {D('1.3')} + {D(shift)} AS cx,
         CAST(n_nationkey // 5 AS DOUBLE) * {D('1.4')} + {D('0.9')} AS cy FROM nation{extra}"""


OFFSETS = """off AS (SELECT e, CAST(dx AS DOUBLE) AS dx, CAST(dy AS DOUBLE) AS dy FROM (VALUES
    (0, -1.1, -0.3), (1, 0.2, -0.9), (2, 1.2, 0.1), (3, 0.3, 0.25), (4, -0.2, 0.95)) t(e, dx, dy))"""

EDGES = """edges AS (
  SELECT z.zone_id, a.e AS edge, z.cx + a.dx AS ax, z.cy + a.dy AS ay, z.cx + b.dx AS bx, z.cy + b.dy AS by_
  FROM zone z CROSS JOIN off a JOIN off b ON b.e = (a.e + 1) % 5)"""

WEIGHTS = f"""cell AS (
  SELECT CAST(i AS INTEGER) AS iy, CAST(j AS INTEGER) AS ix,
         i * {STEP} AS y0, (i + 1) * {STEP} AS y1, j * {STEP} AS x0, (j + 1) * {STEP} AS x1
  FROM range(10) r(i) CROSS JOIN range(15) c(j)),
oriented AS (
  SELECT zone_id, CASE WHEN ax < bx THEN 1 ELSE -1 END AS sgn, least(ax, bx) AS lx, greatest(ax, bx) AS hx,
         CASE WHEN ax < bx THEN ay ELSE by_ END AS ly, CASE WHEN ax < bx THEN by_ ELSE ay END AS hy
  FROM edges WHERE ax <> bx),
clipped AS (
  SELECT *, greatest(lx, x0) AS xa, least(hx, x1) AS xb FROM oriented JOIN cell ON lx < x1 AND hx > x0),
heights AS (
  SELECT *, ly + (hy - ly) * (xa - lx) / (hx - lx) AS ya, ly + (hy - ly) * (xb - lx) / (hx - lx) AS yb
  FROM clipped WHERE xa < xb),
integrals AS (
  SELECT *,
    CASE WHEN ya <= y0 THEN 0 WHEN ya < y1 THEN (ya - y0) * (ya - y0) / 2
         ELSE (y1 - y0) * (y1 - y0) / 2 + (y1 - y0) * (ya - y1) END AS ga,
    CASE WHEN yb <= y0 THEN 0 WHEN yb < y1 THEN (yb - y0) * (yb - y0) / 2
         ELSE (y1 - y0) * (y1 - y0) / 2 + (y1 - y0) * (yb - y1) END AS gb
  FROM heights),
w AS (
  SELECT zone_id, iy, ix, abs(sum(sgn * CASE
      WHEN abs(yb - ya) < 1e-9 THEN (least(greatest((ya + yb) / 2, y0), y1) - y0) * (xb - xa)
      ELSE (xb - xa) / (yb - ya) * (gb - ga) END)) / ({STEP} * {STEP}) AS fraction
  FROM integrals GROUP BY zone_id, iy, ix)"""

ZONES = f"zone AS ({_zone_rows('n_nationkey', '0')}), {OFFSETS}, {EDGES}"
ZONES_SMALL = ZONES.replace("CAST(dx AS DOUBLE) AS dx, CAST(dy AS DOUBLE) AS dy", "CAST(dx AS DOUBLE) / 10 AS dx, CAST(dy AS DOUBLE) / 10 AS dy")
ZONES_WIDE = (
    f"zone AS ({_zone_rows('n_nationkey', '0')} UNION ALL {_zone_rows('n_nationkey + 100', '8')}), {OFFSETS}, {EDGES}"
)
COVER = f"{WEIGHTS}, cover AS (SELECT * FROM w WHERE fraction > 1e-9)"

DAILY = """daily AS (
  SELECT variable, date, iy, ix, avg(value) AS v_mean, max(value) AS v_max, min(value) AS v_min,
         CAST(count(*) AS INTEGER) AS n_steps
  FROM obs GROUP BY variable, date, iy, ix)"""

DAILY_STRICT = """daily AS (
  SELECT variable, date, iy, ix,
         CASE WHEN count(value) = count(*) THEN avg(value) END AS v_mean,
         CASE WHEN count(value) = count(*) THEN max(value) END AS v_max,
         CASE WHEN count(value) = count(*) THEN min(value) END AS v_min,
         CAST(count(*) AS INTEGER) AS n_steps
  FROM obs GROUP BY variable, date, iy, ix)"""


def _weighted(column: str) -> str:
    return f"sum(fraction * {column}) / sum(CASE WHEN {column} IS NOT NULL THEN fraction END)"


PRICE = """price AS (
  SELECT CAST(5100000 + c_nationkey AS BIGINT) AS code_muni, CAST(o_orderdate AS DATE) AS date,
         avg(o_totalprice) AS mean, max(o_totalprice) AS max, min(o_totalprice) AS min
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
zd AS (
  SELECT code_muni, date, 'mean' AS stat, mean AS value FROM price
  UNION ALL SELECT code_muni, date, 'max', max FROM price
  UNION ALL SELECT code_muni, date, 'min', min FROM price)"""

# Conversion per event type, as in the views.
CONVERT = """CASE variable
    WHEN 'click' THEN {v} * 1e9
    WHEN 'error' THEN {v} * 1e6
    WHEN 'purchase' THEN {v} * CAST(44698 AS DOUBLE)
    WHEN 'signup' THEN {v} + CAST(-273.15 AS DOUBLE)
    WHEN 'view' THEN {v} * CAST(40 AS DOUBLE) END"""

MODEL = """CASE event_type
    WHEN 'click' THEN {v} * (CAST(1 AS DOUBLE) / 1e9)
    WHEN 'error' THEN {v} * (CAST(1 AS DOUBLE) / 1e6)
    WHEN 'purchase' THEN {v} * (CAST(1 AS DOUBLE) / CAST(44698 AS DOUBLE))
    WHEN 'signup' THEN {v} - CAST(-273.15 AS DOUBLE)
    WHEN 'view' THEN {v} * (CAST(1 AS DOUBLE) / CAST(40 AS DOUBLE)) END"""

MONTH = "CAST(date_trunc('month', date) AS DATE)"
DAYS = """days AS (
  SELECT variable, CAST(d AS DATE) AS date
  FROM (SELECT DISTINCT event_type AS variable FROM events),
       range(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-05', INTERVAL 1 DAY) r(d))"""
TARGET = "'grid_' || variable || '_' || strftime(date, '%Y%m%d') || '.nc'"
NAME = "'grid_' || event_type || '_' || strftime(ts, '%Y%m%d') || '_mean.nc'"
RUN_MARKER = "'datestamp_' || strftime({t}, '%Y%m%d') || '_' || strftime({t}, '%H:%M')"


def _zoned(obs: str, daily: str, select: str, zones: str = ZONES) -> str:
    return f"""WITH {obs}, {zones}, {COVER}, {daily}
SELECT {select} FROM daily JOIN cover USING (iy, ix) GROUP BY variable, date, zone_id"""


FILE_SCAN = f"""WITH {OBS}, {WEIGHTS.split('oriented AS')[0].rstrip().rstrip(',')},
days AS (SELECT DISTINCT variable, date FROM obs)
SELECT d.variable, d.date, s.stat, c.iy, c.ix, c.y0 + {D('0.375')} AS lat, c.x0 + {D('0.375')} AS lon,
       {_exact("CASE s.stat WHEN 'mean' THEN avg(value) WHEN 'max' THEN max(value) ELSE min(value) END")} AS value
FROM days d CROSS JOIN cell c CROSS JOIN (VALUES ('mean'), ('max'), ('min')) s(stat) LEFT JOIN obs o
  ON o.variable = d.variable AND o.date = d.date AND o.iy = c.iy AND o.ix = c.ix
GROUP BY d.variable, d.date, s.stat, c.iy, c.ix, c.y0, c.x0"""

# Edges of rectangles (zone_id, sign of the ring, west, south, east, north) cut against the demo grid.
PARTS = """placed AS (
  SELECT c_custkey AS zone_id, (c_custkey * 37 % 89) / CAST(10 AS DOUBLE) AS x,
         (c_custkey * 53 % 53) / CAST(10 AS DOUBLE) + CAST(0.1 AS DOUBLE) AS y FROM customer),
boxes AS (
  SELECT zone_id, p.sgn, x + CAST(p.w AS DOUBLE) AS w, y + CAST(p.s AS DOUBLE) AS s, x + CAST(p.e AS DOUBLE) AS e,
         y + CAST(p.n AS DOUBLE) AS n
  FROM placed CROSS JOIN (VALUES (1, 0, 0, 1.3, 1.1), (-1, 0.2, 0.3, 0.7, 0.9), (1, 1.5, 0.2, 1.9, 2)) p(sgn, w, s, e, n))"""

ORACLE: dict[str, str] = {
    "zonal_daily_mean": _zoned(
        OBS, DAILY, f"variable, date, zone_id, {_r(_weighted('v_mean'))} AS value"
    ),
    "grid_file_scan": FILE_SCAN,
    "grid_file_scan_undated": FILE_SCAN,
    "forecast_file_scan": f"""WITH {OBS}, {FORECAST}, run AS (SELECT max(run_time) AS run_time FROM fc),
cells AS (SELECT variable, date, iy, ix, max(value) AS value FROM obs GROUP BY ALL)
SELECT variable, run_time, CAST(0 AS INTEGER) AS lead_hour, run_time AS valid_time, count(value) AS n, max(value) AS largest
FROM cells, run GROUP BY variable, run_time""",
    "scan_by_pattern": """SELECT DISTINCT 'grid_' || event_type || '_' || strftime(ts, '%Y%m%d') || '_min.nc' AS name,
       event_type AS variable, CAST(ts AS DATE) AS date FROM events""",
    "parquet_scan": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS value FROM orders",
    "zone_edges": f"""WITH {ZONES}
SELECT zone_id, CAST(edge AS INTEGER) AS edge, {_exact('ax')} AS lon_a, {_exact('ay')} AS lat_a,
       {_exact('bx')} AS lon_b, {_exact('by_')} AS lat_b, CAST(-1 AS INTEGER) AS weight FROM edges""",
    "table_scan": f"WITH {PRICE} SELECT code_muni, date, value FROM zd WHERE stat = 'max'",
    "request_manifest": f"""WITH {DAYS.replace("event_type AS variable", "CASE event_type WHEN 'purchase' THEN 'o3' ELSE event_type END AS variable")}
SELECT variable, date, {TARGET} AS target, lpad(CAST(h * 3 AS VARCHAR), 2, '0') || ':00' AS step
FROM days, range(8) s(h) WHERE variable <> 'o3' OR h >= 2""",
    "lead_manifest": f"""WITH {FORECAST}, runs AS (SELECT DISTINCT run_time FROM fc)
SELECT run_time, CAST(h AS INTEGER) AS lead_hour, run_time + to_hours(CAST(h AS INTEGER)) AS valid_time
FROM runs, range(121) l(h)""",
    "first_marker": f"WITH {FORECAST} SELECT min({RUN_MARKER.format(t='run_time')}) AS name FROM fc",
    "append_roundtrip": f"WITH {OBS} SELECT {OBS_COLUMNS} FROM obs",
    "replace_table": f"WITH {PRICE} SELECT code_muni, date, stat, {_r('value')} AS value FROM zd",
    "export_parquet_roundtrip": f"WITH {PRICE} SELECT code_muni, date, stat, {_r('value')} AS value FROM zd",
    "export_csv_roundtrip": f"""WITH {PRICE} SELECT code_muni, date, {_r('mean')} AS mean,
       CASE WHEN max > min THEN max END AS max, min FROM price""",
    "grid_daily_roundtrip": f"""WITH {OBS}, {DAILY}
SELECT variable, date, iy, ix,
       CASE WHEN date >= DATE '2024-01-16' THEN {_exact('v_mean')} ELSE -1.0 END AS v_mean,
       CASE WHEN date >= DATE '2024-01-16' THEN v_max ELSE -1.0 END AS v_max,
       CASE WHEN date >= DATE '2024-01-16' THEN v_min ELSE -1.0 END AS v_min, n_steps
FROM daily""",
    "stack_stats": f"""WITH {PRICE} SELECT code_muni, date, {_r('value')} AS value, stat AS name
FROM zd""",
    "monthly_mean": f"""WITH {PRICE}
SELECT code_muni, {MONTH} AS date, stat AS name, {_r('avg(value)')} AS value FROM zd GROUP BY ALL""",
    "export_monthly": f"""WITH {PRICE}, monthly AS (
  SELECT code_muni, {MONTH} AS ano_mes, stat, avg(value) AS value FROM zd WHERE year(date) >= 1998 GROUP BY ALL)
SELECT CAST(substr(CAST(code_muni AS VARCHAR), 1, 6) AS BIGINT) AS cod6, ano_mes,
       {_r("max(CASE WHEN stat = 'mean' THEN value END)")} AS pm25
FROM monthly GROUP BY code_muni, ano_mes""",
    "export_daily": f"""WITH {PRICE}
SELECT CAST(substr(CAST(code_muni AS VARCHAR), 1, 6) AS BIGINT) AS cod6, date AS ano_mes,
       min, {_r('mean')} AS med, max FROM price WHERE year(date) >= 2000""",
    "monthly_report": f"""WITH {PRICE}, monthly AS (
  SELECT code_muni, {MONTH} AS ano_mes, stat, avg(value) AS value FROM zd WHERE year(date) >= 1998 GROUP BY ALL)
SELECT CAST(substr(CAST(code_muni AS VARCHAR), 1, 6) AS BIGINT) AS cod6, ano_mes,
       {_r("max(CASE WHEN stat = 'mean' THEN value END)")} AS pm25
FROM monthly GROUP BY code_muni, ano_mes""",
    "daily_report": f"""WITH {PRICE}
SELECT CAST(substr(CAST(code_muni AS VARCHAR), 1, 6) AS BIGINT) AS cod6, date AS ano_mes,
       min, {_r('mean')} AS med, max FROM price WHERE year(date) >= 2000""",
    "zone_series": f"""WITH {PRICE} SELECT code_muni, date, {_r('value')} AS value
FROM zd WHERE stat = 'mean' AND code_muni = 5100003 ORDER BY date""",
    "year_from": f"""WITH {PRICE} SELECT code_muni, date, stat, {_r('value')} AS value,
       CAST(year(date) AS INTEGER) AS year FROM zd WHERE year(date) >= 1998""",
    "zone_monthly_2024": f"""WITH {PRICE} SELECT {MONTH} AS date, {_r('avg(value)')} AS value
FROM zd WHERE stat = 'mean' AND code_muni = 5100003 AND year(date) = 2000 GROUP BY 1 ORDER BY 1""",
    "bbox_filter": f"""WITH {OBS} SELECT {OBS_COLUMNS} FROM obs
WHERE lat BETWEEN 1.5 AND 5.0 AND lon BETWEEN 2.0 AND 8.0""",
    "lead_slice": f"WITH {FORECAST} SELECT * FROM fc WHERE lead_hour = 24",
    "lead_slice_files": f"WITH {FORECAST} {RUN_CELLS.format(where='WHERE lead_hour = 24')}",
    "run_files_roundtrip": f"WITH {FORECAST} {RUN_CELLS.format(where='')}",
    "step_filter": f"""WITH {OBS} SELECT {OBS_COLUMNS} FROM obs
WHERE hour(valid_time) IN (6, 9, 12, 15, 18, 21)""",
    "variable_filter": f"WITH {OBS} SELECT {OBS_COLUMNS} FROM obs WHERE variable = 'purchase'",
    "zone_weights": f"""WITH {ZONES}, {COVER}
SELECT 'demo' AS grid_id, zone_id, iy, ix, {_exact('fraction')} AS fraction FROM cover""",
    "missing_days": f"""WITH {DAYS}
SELECT variable, date, {TARGET} AS target FROM days d
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = d.variable AND CAST(e.ts AS DATE) = d.date)
ORDER BY date DESC, variable""",
    "missing_files": f"""WITH {DAYS}
SELECT variable, date, {TARGET} AS target FROM days
WHERE (variable, date) NOT IN (SELECT event_type, CAST(ts AS DATE) FROM events)""",
    "missing_steps": f"""WITH {DAYS}
SELECT variable, date, lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS step FROM days, range(24) s(h)
EXCEPT SELECT event_type, CAST(ts AS DATE), strftime(ts, '%H:00') FROM events""",
    "zonal_median": f"""WITH {OBS_NULL}, {ZONES}, {COVER}, {DAILY_STRICT},
r AS (SELECT variable, date, zone_id, v_max AS v, fraction AS w,
        row_number() OVER s AS k, count(*) OVER g AS n, coalesce(sum(fraction) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM daily JOIN cover USING (iy, ix) WHERE v_max IS NOT NULL
      WINDOW g AS (PARTITION BY variable, date, zone_id), s AS (PARTITION BY variable, date, zone_id ORDER BY v_max, fraction)),
p AS (SELECT *, (k - 1) * w + (n - 1) * before AS s FROM r),
q AS (SELECT *, max(s) OVER (PARTITION BY variable, date, zone_id) AS top, lead(s) OVER o AS s2, lead(v) OVER o AS v2
      FROM p WINDOW o AS (PARTITION BY variable, date, zone_id ORDER BY k)),
z AS (SELECT DISTINCT variable, date, zone_id FROM daily JOIN cover USING (iy, ix)),
m AS (SELECT variable, date, zone_id, {QUANTILE.format(p=0.5)} AS median, {QUANTILE.format(p=0.25)} AS lower, min(v) AS least, max(v) AS most
      FROM q GROUP BY ALL)
SELECT variable, date, zone_id, {_r('median', 6)} AS median, {_r('lower', 6)} AS lower, {_r('least', 6)} AS least, {_r('most', 6)} AS most
FROM z LEFT JOIN m USING (variable, date, zone_id)""",
    "zonal_left_complete": f"""WITH {OBS}, {ZONES_WIDE}, {COVER}, {DAILY},
means AS (SELECT variable, date, zone_id, {_r(_weighted('v_mean'))} AS value
          FROM daily JOIN cover USING (iy, ix) GROUP BY variable, date, zone_id),
days AS (SELECT DISTINCT variable, date FROM obs)
SELECT d.variable, d.date, z.zone_id, m.value FROM days d CROSS JOIN zone z LEFT JOIN means m
  ON m.variable = d.variable AND m.date = d.date AND m.zone_id = z.zone_id""",
    "daily_cell_stats": f"""WITH {OBS_NULL}, {DAILY}
SELECT variable, date, iy, ix, {_exact('v_mean')} AS v_mean, v_max, v_min, n_steps FROM daily""",
    "daily_stats_incremental": f"""WITH {OBS_NULL}, {DAILY}
SELECT variable, date, iy, ix, {_exact('v_mean')} AS v_mean, v_max, v_min, n_steps FROM daily""",
    "daily_cell_stats_strict": f"""WITH {OBS_NULL}, {DAILY_STRICT}
SELECT variable, date, iy, ix, {_exact('v_mean')} AS v_mean, v_max, v_min, n_steps FROM daily""",
    "zonal_multi_stat": _zoned(
        OBS_NULL,
        DAILY_STRICT,
        f"""variable, date, zone_id, {_r(_weighted('v_mean'), 6)} AS z_mean,
       {_r('sum(fraction * v_mean)', 6)} AS z_sum,
       {_r('coalesce(sum(CASE WHEN v_mean IS NOT NULL THEN fraction END), 0)', 6)} AS z_count,
       {_r('min(v_mean)', 6)} AS z_min, {_r('max(v_mean)', 6)} AS z_max""",
    ),
    "zonal_daily_max_min": _zoned(
        OBS,
        DAILY,
        f"variable, date, zone_id, {_r(_weighted('v_max'))} AS max, {_r(_weighted('v_min'))} AS min",
    ),
    "zonal_forecast": f"""WITH {FORECAST}, {ZONES}, {COVER}
SELECT variable, run_time, lead_hour, zone_id, {_r(_weighted('value'))} AS value
FROM fc JOIN cover USING (iy, ix) GROUP BY variable, run_time, lead_hour, zone_id""",
    "row_count": f"WITH {FORECAST} SELECT count(*) AS n FROM fc",
    "layer_minmax": f"""WITH {FORECAST} SELECT variable, lead_hour, min(value) AS v_min, max(value) AS v_max
FROM fc GROUP BY variable, lead_hour""",
    "value_domain": f"WITH {FORECAST} SELECT min(value) AS domain_min, max(value) AS domain_max FROM fc",
    "head_rows": f"""WITH {FORECAST} SELECT * FROM fc
ORDER BY variable, run_time, lead_hour, iy, ix, value LIMIT 6""",
    "pivot_stats": f"WITH {PRICE} SELECT code_muni, date, {_r('mean')} AS mean, max, min FROM price",
    "unit_convert": f"""WITH {OBS} SELECT variable, valid_time, {_r(CONVERT.format(v='value'))} AS value FROM obs""",
    "round2": f"WITH {OBS} SELECT variable, valid_time, {_r('value / 8')} AS value FROM obs",
    "code6": f"""WITH {PRICE} SELECT code_muni, date, stat,
       CAST(substr(CAST(code_muni AS VARCHAR), 1, 6) AS BIGINT) AS cod6 FROM zd""",
    "date_from_name": f"""SELECT {NAME} AS name, event_type AS variable, CAST(ts AS DATE) AS date FROM events""",
    "run_time_parse": f"""SELECT event_id, {RUN_MARKER.format(t='ts')} AS marker, CAST(hour(ts) AS INTEGER) AS run_hour,
       date_trunc('hour', ts) AS run_time FROM events""",
    "file_parts": f"""SELECT '/data/daily.v1/' || {NAME} AS path, {NAME} AS base,
       'grid_' || event_type || '_' || strftime(ts, '%Y%m%d') || '_mean' AS stem FROM events""",
    "expected_file_name": f"""WITH present AS (SELECT DISTINCT event_type AS variable, CAST(ts AS DATE) AS date FROM events)
SELECT variable, date, {TARGET} AS target FROM present""",
    "valid_time": f"""WITH {FORECAST} SELECT variable, run_time, lead_hour,
       run_time + to_hours(lead_hour) AS valid_time FROM fc""",
    "local_time": f"""WITH {FORECAST}, t AS (SELECT variable, run_time + to_hours(lead_hour) AS valid_time FROM fc)
SELECT variable, valid_time,
       (valid_time AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS local_time,
       ((valid_time - INTERVAL 2191 DAY) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS local_time_earlier
FROM t""",
    "latest_cycle": """SELECT event_id, CASE WHEN hour(ts) < 12 THEN date_trunc('day', ts) - INTERVAL 12 HOUR
       ELSE date_trunc('day', ts) END AS run_time FROM events""",
    "grid_normalise": f"""WITH {OBS}, raw AS (
  SELECT variable, valid_time, ix * {D('24')} AS lon, iy * {D('18')} - {D('81')} AS lat, value FROM obs)
SELECT variable, valid_time, CASE WHEN lon >= 180 THEN lon - 360 ELSE lon END AS lon, lat, value,
       CAST(floor((CASE WHEN lon >= 180 THEN lon - 360 ELSE lon END + 180) / 24) AS INTEGER) AS ix,
       CAST(floor((lat + 90) / 18) AS INTEGER) AS iy
FROM raw""",
    "regrid_bilinear": f"""WITH {OBS}, {DAILY},
target AS (
  SELECT CAST(i AS INTEGER) AS iy, CAST(j AS INTEGER) AS ix,
         (i * {D('0.5')} - 0.25 - 0.375) / {STEP} AS fy, (j * {D('0.5')} - 0.25 - 0.375) / {STEP} AS fx
  FROM range(18) r(i) CROSS JOIN range(26) c(j)
  WHERE i * {D('0.5')} - 0.25 BETWEEN 0 AND 7.5 AND j * {D('0.5')} - 0.25 BETWEEN 0 AND 11.25),
near AS (
  SELECT t.iy, t.ix, CAST(floor(fy) AS INTEGER) + a AS sy, CAST(floor(fx) AS INTEGER) + b AS sx,
         (CASE WHEN a = 0 THEN 1 - (fy - floor(fy)) ELSE fy - floor(fy) END)
       * (CASE WHEN b = 0 THEN 1 - (fx - floor(fx)) ELSE fx - floor(fx) END) AS wgt
  FROM target t CROSS JOIN (VALUES (0), (1)) p(a) CROSS JOIN (VALUES (0), (1)) q(b))
SELECT d.variable, d.date, n.iy, n.ix, {_exact('sum(wgt * v_mean) / sum(wgt)')} AS v_mean
FROM daily d JOIN near n ON d.iy = n.sy AND d.ix = n.sx
WHERE wgt > 1e-9 GROUP BY d.variable, d.date, n.iy, n.ix""",
    "zone_validate": f"""WITH {ZONES}, bad AS (
  SELECT zone_id, count(*) AS n_vertices, count(*) FILTER (WHERE abs(ax + 172) > 180) AS n_outside FROM edges GROUP BY zone_id)
SELECT zone_id, n_vertices, n_outside, CAST(0 AS BIGINT) AS n_long_edges,
       CAST(0 AS BIGINT) AS n_short_rings, n_outside = 0 AS valid FROM bad""",
    "zone_weights_global": f"""WITH box AS (
  SELECT CAST(n_nationkey AS BIGINT) AS zone_id, n_nationkey + {D('150.5')} AS w, {D('180')} AS e, n_nationkey * 3 - {D('50')} AS s FROM nation
  UNION ALL SELECT n_nationkey + 100, {D('-180')}, n_nationkey - {D('179.75')}, n_nationkey * 3 - {D('50')} FROM nation),
cell AS (
  SELECT CAST(i AS INTEGER) AS iy, CAST(j AS INTEGER) AS ix, i * {D('18')} - 90 AS y0, j * {D('24')} - 192 + t * 360 AS x0
  FROM range(10) r(i), range(15) c(j), (VALUES (-1), (0), (1)) u(t))
SELECT 'world-shift' AS grid_id, zone_id, iy, ix,
       {_exact('sum((least(e, x0 + 24) - greatest(w, x0)) * (least(s + 2.5, y0 + 18) - greatest(s, y0))) / (24 * 18)')} AS fraction
FROM box JOIN cell ON w < x0 + 24 AND e > x0 AND s < y0 + 18 AND s + 2.5 > y0 GROUP BY zone_id, iy, ix""",
    "zone_weights_parts": f"""WITH {PARTS}, {WEIGHTS.split('oriented AS')[0].rstrip().rstrip(',')},
cut AS (
  SELECT zone_id, iy, ix, sum(sgn * (least(e, x1) - greatest(w, x0)) * (least(n, y1) - greatest(s, y0))) / ({STEP} * {STEP}) AS fraction
  FROM boxes JOIN cell ON w < x1 AND e > x0 AND s < y1 AND n > y0 GROUP BY zone_id, iy, ix)
SELECT 'demo' AS grid_id, zone_id, iy, ix, {_exact('fraction')} AS fraction FROM cut WHERE fraction > 1e-9""",
    "regrid_global": f"""WITH {OBS}, {DAILY},
target AS (
  SELECT CAST(i AS INTEGER) AS iy, CAST(j AS INTEGER) AS ix, (i * {D('9.9')} + {D('4.95')} - {D('89.3')} + 90 - 9) / 18 AS fy,
         (j * {D('9.9')} + {D('4.95')} - {D('179.3')} + 192 - 12) / 24 AS fx
  FROM range(18) r(i) CROSS JOIN range(36) c(j)),
near AS (
  SELECT t.iy, t.ix, CAST(floor(fy) AS INTEGER) + a AS sy, (CAST(floor(fx) AS INTEGER) + b + 15) % 15 AS sx,
         (CASE WHEN a = 0 THEN 1 - (fy - floor(fy)) ELSE fy - floor(fy) END)
       * (CASE WHEN b = 0 THEN 1 - (fx - floor(fx)) ELSE fx - floor(fx) END) AS wgt
  FROM target t CROSS JOIN (VALUES (0), (1)) p(a) CROSS JOIN (VALUES (0), (1)) q(b))
SELECT d.variable, d.date, n.iy, n.ix, {_exact('sum(wgt * v_mean) / sum(wgt)')} AS v_mean
FROM daily d JOIN near n ON d.iy = n.sy AND d.ix = n.sx GROUP BY d.variable, d.date, n.iy, n.ix""",
    "zonal_shuffle_join": _zoned(OBS, DAILY, f"variable, date, zone_id, {_r(_weighted('v_mean'))} AS value"),
    "zonal_stored_weights": f"""WITH {_obs(MODEL.format(v="value"))}, {ZONES_SMALL}, {COVER}, {DAILY_STRICT},
m AS (
  SELECT variable, zone_id, date, {_weighted('v_mean')} AS mean,
         {_weighted('v_max')} AS max, {_weighted('v_min')} AS min
  FROM daily JOIN cover USING (iy, ix) GROUP BY variable, date, zone_id),
z AS (
  SELECT d.variable, zone.zone_id AS code_muni, d.date, mean, max, min
  FROM (SELECT DISTINCT variable, date FROM obs) d CROSS JOIN zone LEFT JOIN m
    ON m.variable = d.variable AND m.date = d.date AND m.zone_id = zone.zone_id)
SELECT variable, 'mean' AS stat, code_muni, date, {_r(CONVERT.format(v='mean'))} AS value FROM z
UNION ALL SELECT variable, 'max', code_muni, date, {_r(CONVERT.format(v='max'))} FROM z
UNION ALL SELECT variable, 'min', code_muni, date, {_r(CONVERT.format(v='min'))} FROM z""",
    "rebuild_table": f"WITH {PRICE} SELECT code_muni, date, stat, {_r('value * 2')} AS value FROM zd",
    "list_tables": "SELECT DISTINCT event_type || '_daily' AS name FROM events ORDER BY name",
    "split_run": f"WITH {FORECAST} SELECT * FROM fc",
    "mixed_appends": f"WITH {OBS} SELECT {OBS_COLUMNS} FROM obs",
    "incremental_ingest": f"WITH {OBS} SELECT {OBS_COLUMNS} FROM obs",
    "replace_runs": f"WITH {FORECAST} SELECT * FROM fc",
    "current_run": f"""WITH {FORECAST}
SELECT * FROM fc WHERE run_time = (SELECT max(run_time) FROM fc f WHERE f.variable = fc.variable)""",
    "reanalysis_zone_daily": f"""WITH {_obs(MODEL.format(v="CASE WHEN event_id % 97 <> 0 THEN value END"))}, {ZONES}, {COVER}, {DAILY_STRICT},
m AS (
  SELECT variable, zone_id, date, {_weighted('v_mean')} AS mean,
         {_weighted('v_max')} AS max, {_weighted('v_min')} AS min
  FROM daily JOIN cover USING (iy, ix) GROUP BY variable, date, zone_id),
z AS (
  SELECT d.variable, zone.zone_id AS code_muni, d.date, mean, max, min
  FROM (SELECT DISTINCT variable, date FROM obs) d CROSS JOIN zone LEFT JOIN m
    ON m.variable = d.variable AND m.date = d.date AND m.zone_id = zone.zone_id)
SELECT variable, 'mean' AS stat, code_muni, date, {_r(CONVERT.format(v='mean'))} AS value FROM z
UNION ALL SELECT variable, 'max', code_muni, date, {_r(CONVERT.format(v='max'))} FROM z
UNION ALL SELECT variable, 'min', code_muni, date, {_r(CONVERT.format(v='min'))} FROM z""",
    "forecast_zone_table": f"""WITH {FORECAST.replace("ix, value", "ix, " + MODEL.format(v="value") + " AS value")}, {ZONES}, {COVER},
m AS (
  SELECT variable, run_time, lead_hour, zone_id, {_weighted('value')} AS mean
  FROM fc JOIN cover USING (iy, ix) GROUP BY variable, run_time, lead_hour, zone_id),
z AS (
  SELECT l.variable, l.run_time, l.lead_hour, zone.zone_id AS code_muni, mean
  FROM (SELECT DISTINCT variable, run_time, lead_hour FROM fc) l CROSS JOIN zone LEFT JOIN m
    ON m.variable = l.variable AND m.run_time = l.run_time AND m.lead_hour = l.lead_hour AND m.zone_id = zone.zone_id)
SELECT variable, run_time, lead_hour, code_muni, run_time + to_hours(lead_hour) AS valid_time,
       ((run_time + to_hours(lead_hour)) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS local_time,
       {_r(CONVERT.format(v='mean'))} AS value
FROM z""",
}
