"""SQL twins (DuckDB dialect) of the registered queries.

Same presentation rules as :mod:`gridseries.plans.present`: timestamps as
``%Y-%m-%d %H:%M:%S`` text, doubles rounded to 6 decimals, integers BIGINT.
"""

from __future__ import annotations

HOURLY = """
hourly AS (
  SELECT event_type, date_trunc('hour', ts) AS ts, sum(value) AS value
  FROM events WHERE value IS NOT NULL GROUP BY 1, 2
)"""

TEST_WINDOW = "TIMESTAMP '2024-01-24 00:00:00' AND TIMESTAMP '2024-01-30 23:00:00'"

# last value (as-of backward) and seasonal lookups with presence fallback
BASE_FORECASTS = f"""
{HOURLY},
lastv AS (
  SELECT h.event_type, h.ts, h.value AS y_true,
         last_value(h.value) OVER (PARTITION BY h.event_type ORDER BY h.ts
             RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS naive_last
  FROM hourly h
),
fc AS (
  SELECT l.event_type, l.ts, l.y_true, l.naive_last,
         CASE WHEN d.ts IS NOT NULL THEN d.value ELSE l.naive_last END AS naive_daily,
         CASE WHEN w.ts IS NOT NULL THEN w.value ELSE l.naive_last END AS naive_weekly
  FROM lastv l
  LEFT JOIN hourly d ON d.event_type = l.event_type AND d.ts = l.ts - INTERVAL 24 HOUR
  LEFT JOIN hourly w ON w.event_type = l.event_type AND w.ts = l.ts - INTERVAL 168 HOUR
),
long AS (
  SELECT 'naive_last' AS model, event_type, ts, y_true, naive_last AS y_pred FROM fc
  UNION ALL SELECT 'naive_daily', event_type, ts, y_true, naive_daily FROM fc
  UNION ALL SELECT 'naive_weekly', event_type, ts, y_true, naive_weekly FROM fc
),
test AS (SELECT * FROM long WHERE ts BETWEEN {TEST_WINDOW})
"""

METRICS = """
  count(*) AS n,
  avg(abs(y_true - y_pred)) AS MAE,
  sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS RMSE,
  avg(abs(y_true - y_pred) / greatest(abs(y_true), 0.001)) * 100 AS MAPE_percent,
  avg(CASE WHEN (abs(y_true) + abs(y_pred)) / 2 > 0
           THEN abs(y_true - y_pred) / ((abs(y_true) + abs(y_pred)) / 2) END) * 100 AS sMAPE_percent
"""

# ---------------------------------------------------------------- helpers
import math  # noqa: E402


def _ts(col: str, alias: str | None = None) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S') AS {alias or col}"


def _r(col: str, alias: str | None = None, decimals: int = 6) -> str:
    # "+ 0.0" turns a rounded negative zero into zero, as Spark's round does
    scale = f"1{'0' * decimals}.0"
    return f"(round(CAST({col} AS DOUBLE) * {scale}) / {scale} + 0.0) AS {alias or col}"


SQL: dict[str, str] = {}

SQL["forecast_last"] = f"""
WITH {BASE_FORECASTS}
SELECT model, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
       {_r('y_true')}, {_r('y_pred')}
FROM test WHERE model = 'naive_last'
"""

SQL["forecast_seasonal"] = f"""
WITH {BASE_FORECASTS}
SELECT model, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
       {_r('y_true')}, {_r('y_pred')}
FROM test WHERE model IN ('naive_daily', 'naive_weekly')
"""

SQL["walkforward_metrics"] = f"""
WITH {BASE_FORECASTS},
m AS (SELECT event_type, model, {METRICS} FROM test GROUP BY event_type, model)
SELECT event_type, model, n, {_r('MAE')}, {_r('RMSE')},
       {_r('MAPE_percent')}, {_r('sMAPE_percent')}
FROM m
"""

SQL["leaderboard"] = f"""
WITH {BASE_FORECASTS},
m AS (SELECT event_type, model, round_even(avg(abs(y_true - y_pred)), 4) AS MAE FROM test GROUP BY 1, 2)
SELECT event_type, model, {_r('MAE')},
       row_number() OVER (PARTITION BY event_type ORDER BY MAE ASC NULLS LAST, model) AS rank
FROM m
"""


LINES = """
lines AS (
  SELECT user_id AS square_id, time_bucket(INTERVAL 10 MINUTE, ts) AS ts, value, ts::DATE AS file_day, true AS good FROM events
  UNION ALL SELECT user_id, time_bucket(INTERVAL 10 MINUTE, ts), NULL, ts::DATE, true FROM events WHERE event_type = 'error'
  UNION ALL SELECT user_id + 70000, time_bucket(INTERVAL 10 MINUTE, ts), value, ts::DATE, true FROM events WHERE event_type = 'signup'
  UNION ALL SELECT user_id, time_bucket(INTERVAL 10 MINUTE, ts), value, ts::DATE - 1, true FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT user_id, time_bucket(INTERVAL 10 MINUTE, ts), value, ts::DATE, false FROM events, range(2) WHERE event_id % 10 = 0
)"""

CANON = f"""{LINES},
canon AS (
  SELECT file_day, CAST(square_id AS BIGINT) AS square_id, ts, CAST(sum(value) AS FLOAT) AS internet
  FROM lines WHERE good AND value IS NOT NULL GROUP BY 1, 2, 3
)"""

CELLS = """
cells AS (
  SELECT user_id, date_trunc('hour', ts) AS ts, sum(value) AS value
  FROM events WHERE value IS NOT NULL GROUP BY 1, 2
),
totals AS (SELECT user_id, sum(value) AS total FROM cells GROUP BY 1)"""

DAILY_ORDERS = """
daily AS (
  SELECT o_orderpriority, date_trunc('day', o_orderdate) AS ts, sum(o_totalprice) AS value
  FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1, 2
)"""

GRID_HOURLY = """
bounds AS (SELECT event_type, min(ts) AS lo, max(ts) AS hi FROM hourly GROUP BY 1),
grid AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM bounds)"""

FILLED = f"""
{GRID_HOURLY},
reg AS (
  SELECT g.event_type, g.ts, h.value, h.value IS NULL AS was_missing
  FROM grid g LEFT JOIN hourly h ON h.event_type = g.event_type AND h.ts = g.ts
),
reg_rn AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn FROM reg),
reg_nb AS (
  SELECT *,
    last_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
    last_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pr,
    first_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
    first_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nr
  FROM reg_rn
),
filled AS (
  SELECT event_type, ts, was_missing,
    CAST(coalesce(value,
      CASE WHEN pr IS NOT NULL AND nr IS NOT NULL
           THEN pv + (nv - pv) * CAST(rn - pr AS DOUBLE) / CAST(nr - pr AS DOUBLE) END,
      nv, pv) AS DOUBLE) AS value
  FROM reg_nb
)"""

WEEK2 = "TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-14 23:00:00'"

# ---------------------------------------------------------------- ingest
SQL["canonical_from_lines"] = f"""
WITH {CANON}
SELECT square_id, {_ts('ts')}, {_r('internet')},
       strftime(file_day, '%Y-%m-%d') AS day, strftime(file_day, '%Y-%m') AS year_month
FROM canon
"""

SQL["ingest_profile"] = f"""
WITH {LINES},
n AS (
  SELECT count(*) AS raw_rows,
         count(*) - (SELECT count(*) FROM events WHERE event_id % 10 = 0) AS well_formed_rows,
         count(*) FILTER (WHERE good) AS parsed_rows,
         count(*) FILTER (WHERE good AND value IS NOT NULL) AS non_null_rows,
         (SELECT count(*) FROM (SELECT DISTINCT square_id, ts FROM lines WHERE good AND value IS NOT NULL)) AS canonical_rows
  FROM lines
)
SELECT *, {_r('canonical_rows / CAST(raw_rows AS DOUBLE)', 'reduction_ratio')} FROM n
"""

SQL["daily_manifest"] = f"""
WITH {CANON}
SELECT strftime(file_day, '%Y-%m-%d') AS day, strftime(file_day, '%Y-%m') AS year_month,
       'year_month=' || strftime(file_day, '%Y-%m') || '/day=' || strftime(file_day, '%Y-%m-%d') AS path,
       count(*) AS rows, count(DISTINCT square_id) AS cells
FROM canon GROUP BY 1, 2, 3
"""

SQL["ingest_two_runs"] = f"""
WITH {CANON},
stored AS (SELECT file_day, count(*) AS rows, max(square_id) AS max_id, sum(internet::DOUBLE) AS total FROM canon GROUP BY 1),
bad AS (SELECT file_day, count(*) AS bad_lines FROM lines WHERE NOT good GROUP BY 1)
SELECT strftime(coalesce(s.file_day, b.file_day), '%Y-%m-%d') AS day, rows, max_id, round(total) AS total, coalesce(bad_lines, 0) AS bad_lines
FROM stored s FULL JOIN bad b ON b.file_day = s.file_day
"""

SQL["quarantine_rows"] = """
WITH e AS (
  SELECT *, (epoch(time_bucket(INTERVAL 10 MINUTE, ts)) * 1000)::BIGINT AS ms, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE event_id % 10 = 0
)
SELECT user_id || chr(9) || ms AS line, 'sms-call-internet-mi-' || day || '.txt' AS file_name, 2::BIGINT AS n_fields, 'field_count' AS reason, day FROM e
UNION ALL
SELECT concat('x', user_id, chr(9), ms, chr(9), length(event_type), repeat(chr(9), 4), event_id, chr(9), value),
       'sms-call-internet-mi-' || day || '.txt', 8, 'bad_value', day FROM e
"""

SQL["ingest_manifest"] = f"""
WITH {CANON},
present AS (SELECT DISTINCT file_day FROM canon),
missing AS (SELECT d::DATE AS day FROM generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-02', INTERVAL 1 DAY) g(d) ANTI JOIN present ON file_day = d::DATE)
SELECT '2023-12-30' AS expected_start, '2024-02-02' AS expected_end,
  (SELECT count(*) FROM present) AS n_partitions, (SELECT count(*) FROM canon) AS total_rows,
  (SELECT count(*) FROM missing) AS n_missing,
  (SELECT strftime(min(day), '%Y-%m-%d') FROM missing) AS first_missing, (SELECT strftime(max(day), '%Y-%m-%d') FROM missing) AS last_missing
"""

SQL["missing_hours"] = f"""
WITH {HOURLY}, {GRID_HOURLY}
SELECT g.event_type, {_ts('g.ts', 'ts')}
FROM grid g ANTI JOIN hourly h ON h.event_type = g.event_type AND h.ts = g.ts
"""

SQL["missing_days"] = f"""
WITH {DAILY_ORDERS},
b AS (SELECT o_orderpriority, min(ts) AS lo, max(ts) AS hi FROM daily GROUP BY 1),
g AS (SELECT o_orderpriority, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM b)
SELECT g.o_orderpriority, {_ts('g.ts', 'ts')}
FROM g ANTI JOIN daily d ON d.o_orderpriority = g.o_orderpriority AND d.ts = g.ts
"""

# ---------------------------------------------------------------- series algebra
SQL["area_series"] = f"""
WITH {HOURLY}
SELECT event_type, {_ts('ts')}, {_r('value')}
FROM hourly WHERE event_type = 'click'
"""

SQL["areas_wide"] = f"""
WITH {HOURLY}
SELECT {_ts('ts')},
  {', '.join(_r(f"avg(value) FILTER (WHERE event_type = '{e}')", f'area_{e}') for e in ['click', 'error', 'purchase', 'signup', 'view'])}
FROM hourly
GROUP BY ts
"""

SQL["area_totals"] = f"""
WITH {CELLS}
SELECT user_id, {_r('total')} FROM totals
"""

SQL["top_areas"] = f"""
WITH {CELLS}
SELECT user_id, {_r('total')}, row_number() OVER (ORDER BY total DESC, user_id) AS rank
FROM totals ORDER BY total DESC, user_id LIMIT 5
"""

SQL["resolve_areas"] = f"""
WITH {CELLS},
toks AS (
  SELECT CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS position, unnest(l) AS token
  FROM (SELECT string_split('top, 7 ,12,,TOP', ',') AS l)
),
t AS (SELECT position, trim(token) AS token FROM toks WHERE trim(token) <> ''),
best AS (SELECT user_id FROM totals ORDER BY total DESC, user_id LIMIT 1),
r AS (
  SELECT position,
         CASE WHEN lower(token) = 'top' THEN 'top(' || (SELECT user_id FROM best) || ')' ELSE token END AS label,
         CASE WHEN lower(token) = 'top' THEN (SELECT user_id FROM best) ELSE CAST(token AS BIGINT) END AS user_id
  FROM t
)
SELECT label, user_id, min(position) AS position FROM r GROUP BY 1, 2
"""

SQL["split_counts"] = f"""
WITH {HOURLY}
SELECT event_type,
  CASE WHEN ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-20 23:00:00' THEN 'train'
       WHEN ts BETWEEN TIMESTAMP '2024-01-21 00:00:00' AND TIMESTAMP '2024-01-23 23:00:00' THEN 'validation'
       WHEN ts BETWEEN {TEST_WINDOW} THEN 'test' END AS split,
  count(*) AS n, {_r('sum(value)', 'total')}
FROM hourly GROUP BY 1, 2
"""

SQL["interpolate"] = f"""
WITH {HOURLY}, {FILLED}
SELECT event_type, {_ts('ts')}, {_r('value')}, was_missing FROM filled
"""

SQL["rolling_stats"] = f"""
WITH {HOURLY}
SELECT event_type, {_ts('ts')}, {_r('value')},
  {_r('CASE WHEN count(value) OVER w = 24 THEN avg(value) OVER w END', 'rolling_mean')},
  {_r('CASE WHEN count(value) OVER w = 24 THEN stddev_samp(value) OVER w END', 'rolling_std')}
FROM hourly
WINDOW w AS (PARTITION BY event_type ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
"""

SQL["preview"] = f"""
WITH {HOURLY}
SELECT event_type, {_ts('ts')}, {_r('value')},
  {_r('avg(value) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)', 'moving_avg')},
  isodow(ts) - 1 >= 5 AS is_weekend
FROM hourly
WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts <= TIMESTAMP '2024-01-14 23:00:00'
"""

SQL["seasonal_diff"] = f"""
WITH {HOURLY},
d AS (
  SELECT event_type, ts, CAST(1 AS BIGINT) AS lag,
         value - lag(value, 1) OVER (PARTITION BY event_type ORDER BY ts) AS diff FROM hourly
  UNION ALL
  SELECT event_type, ts, CAST(24 AS BIGINT),
         value - lag(value, 24) OVER (PARTITION BY event_type ORDER BY ts) FROM hourly
)
SELECT event_type, {_ts('ts')}, lag, {_r('diff')} FROM d WHERE diff IS NOT NULL
"""

# ---------------------------------------------------------------- city / spatial
SQL["city_stats"] = f"""
WITH {CELLS}
SELECT count(total) AS n_areas, count(*) FILTER (WHERE total > 0) AS n_positive,
  {_r('avg(total)', 'mean')}, {_r('quantile_cont(total, 0.5)', 'median')},
  {_r('stddev_pop(total)', 'std')}, {_r('min(total)', 'min')}, {_r('max(total)', 'max')},
  {_r('skewness(total) FILTER (WHERE total > 0)', 'skew')},
  {_r('kurtosis(total) FILTER (WHERE total > 0)', 'kurtosis')},
  {_r('quantile_cont(total, 0.01)', 'p1')}, {_r('quantile_cont(total, 0.05)', 'p5')},
  {_r('quantile_cont(total, 0.95)', 'p95')}, {_r('quantile_cont(total, 0.99)', 'p99')}
FROM totals
"""

SQL["city_histogram"] = f"""
WITH {CELLS},
pos AS (SELECT total AS x FROM totals WHERE total > 0),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM pos),
c AS (
  SELECT CAST(CASE WHEN hi - lo > 0 THEN least(floor((x - lo) * (80.0 / (hi - lo))), 79) ELSE 0 END AS BIGINT) AS bin,
         count(*) AS cnt
  FROM pos, b GROUP BY 1
),
e AS (SELECT range AS bin, lo + range * (hi - lo) / 80 AS elo, lo + (range + 1) * (hi - lo) / 80 AS ehi FROM range(80), b)
SELECT e.bin, {_r('elo', 'lo')}, {_r('ehi', 'hi')}, coalesce(c.cnt, 0) AS count
FROM e LEFT JOIN c ON c.bin = e.bin
"""

SQL["city_kde"] = f"""
WITH {CELLS},
logs AS (SELECT log10(total) AS x FROM totals WHERE total > 0),
st AS (SELECT min(x) AS lo, max(x) AS hi, count(x) AS n,
              stddev_samp(x) * pow(CAST(count(x) AS DOUBLE), -0.2) AS h FROM logs),
grid AS (
  SELECT range AS j, lo + range * (CASE WHEN hi > lo THEN (hi - lo) / 399 ELSE 1.0 END) AS gx, n, h
  FROM range(400), st
)
SELECT CAST(j AS BIGINT) AS point, {_r('gx', 'log10_total')},
  {_r('sum(exp(-0.5 * ((gx - x) / h) * ((gx - x) / h))) / (n * h * sqrt(2 * pi()))', 'density')}
FROM grid, logs GROUP BY j, gx, n, h
"""

SQL["spatial_grid"] = f"""
WITH {CELLS},
side AS (SELECT ceil(sqrt(max(user_id) + 1))::BIGINT AS n FROM totals)
SELECT c.id AS user_id, CAST(floor((c.id - 1) / n) AS BIGINT) AS row,
       CAST((c.id - 1) % n AS BIGINT) AS col, {_r('t.total', 'total')},
       {_r('CASE WHEN t.total > 0 THEN log10(t.total) END', 'log10_total')}
FROM side, (SELECT unnest(range(1, n * n + 1)) AS id FROM side) c LEFT JOIN totals t ON t.user_id + 1 = c.id
"""

SQL["spatial_stats"] = f"""
WITH {CELLS}
SELECT (SELECT user_id + 1 FROM totals ORDER BY total DESC, user_id LIMIT 1) AS top_area,
       {_r('(SELECT max(total) FROM totals)', 'top_value')},
       (SELECT count(*) FROM totals WHERE total > 0) AS n_nonzero
"""

_SPARSE = f"""{CELLS},
sparse AS (SELECT user_id * 1000 + 1 AS id, total FROM totals),
side AS (SELECT CAST(ceil(sqrt(max(id))) AS BIGINT) AS n FROM sparse),
cells_at AS (SELECT id, (id - 1) // n AS row, (id - 1) % n AS col, total FROM sparse, side)"""
SQL["spatial_cells"] = f"""
WITH {_SPARSE}
SELECT CAST(id AS BIGINT) AS user_id, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, {_r('total')},
       {_r('CASE WHEN total > 0 THEN log10(total) END', 'log10_total')}
FROM cells_at
"""

SQL["spatial_tiles"] = f"""
WITH {_SPARSE}
SELECT CAST(row // 32 AS BIGINT) AS tile_row, CAST(col // 32 AS BIGINT) AS tile_col, count(*) AS n_cells,
       count(*) FILTER (WHERE total > 0) AS n_nonzero, {_r('sum(total)', 'total')}, {_r('max(total)', 'max_total')}
FROM cells_at GROUP BY 1, 2
"""

SQL["city_day_stats"] = f"""
WITH {CELLS},
daily AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS total FROM cells GROUP BY 1, 2)
SELECT count(total) AS n_areas, count(*) FILTER (WHERE total > 0) AS n_positive,
  {_r('avg(total)', 'mean')}, {_r('stddev_pop(total)', 'std')}, {_r('min(total)', 'min')}, {_r('max(total)', 'max')},
  {_r('skewness(total) FILTER (WHERE total > 0)', 'skew')},
  {_r('kurtosis(total) FILTER (WHERE total > 0)', 'kurtosis')}
FROM daily
"""

SQL["city_day_ranks"] = "SELECT unnest(['median', 'p1', 'p5', 'p95', 'p99']) AS level, true AS within"
SQL["area_totals_days"] = SQL["area_totals"]

# ---------------------------------------------------------------- EDA in SQL
_ACF_LAGS = (1, 24, 168)
SQL["acf_lags"] = f"""
WITH {HOURLY},
s AS (SELECT event_type, ts, value - avg(value) OVER (PARTITION BY event_type) AS d FROM hourly WHERE value IS NOT NULL),
l AS (
  SELECT event_type, d, {', '.join(f'lead(d, {k}) OVER w AS l{k}' for k in _ACF_LAGS)}
  FROM s WINDOW w AS (PARTITION BY event_type ORDER BY ts)
),
a AS (SELECT event_type, sum(d * d) AS den, count(*) AS n, {', '.join(f'sum(d * l{k}) AS c{k}' for k in _ACF_LAGS)} FROM l GROUP BY 1)
{' UNION ALL '.join(f"SELECT event_type, CAST({k} AS BIGINT) AS lag, {_r(f'CASE WHEN n > {k} THEN c{k} / den END', 'acf')} FROM a" for k in _ACF_LAGS)}
"""


def _kpss_sql(lags: int) -> str:
    lrv = "e2"
    for k in range(1, lags + 1):
        lrv += f" + {repr(2.0 * (1.0 - k / (lags + 1.0)))} * coalesce(p{k}, 0.0)"
    crit, pv = (0.119, 0.146, 0.176, 0.216), (0.10, 0.05, 0.025, 0.01)
    pcase = f"CASE WHEN stat <= {crit[0]} THEN {pv[0]}"
    for i in range(3):
        pcase += (
            f" WHEN stat <= {crit[i + 1]} THEN {pv[i]} + ((stat - {crit[i]}) / {repr(crit[i + 1] - crit[i])})"
            f" * {repr(pv[i + 1] - pv[i])}"
        )
    pcase += f" ELSE {pv[-1]} END"
    return f"""
WITH {HOURLY},
s AS (SELECT event_type, ts, value AS x,
             CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts) AS DOUBLE) AS t
      FROM hourly WHERE value IS NOT NULL),
f AS (SELECT *, regr_slope(x, t) OVER (PARTITION BY event_type) AS b,
                regr_intercept(x, t) OVER (PARTITION BY event_type) AS a FROM s),
e AS (SELECT event_type, ts, x - (a + b * t) AS e FROM f),
c AS (
  SELECT event_type, e,
    sum(e) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS S,
    {', '.join(f'lag(e, {k}) OVER w AS e{k}' for k in range(1, lags + 1))}
  FROM e WINDOW w AS (PARTITION BY event_type ORDER BY ts)
),
g AS (SELECT event_type, count(*) AS nobs, sum(S * S) AS ss, sum(e * e) AS e2,
             {', '.join(f'sum(e * e{k}) AS p{k}' for k in range(1, lags + 1))} FROM c GROUP BY 1),
k AS (SELECT event_type, nobs,
             CASE WHEN nobs >= 100 THEN (ss / (CAST(nobs AS DOUBLE) * nobs)) / (({lrv}) / CAST(nobs AS DOUBLE)) END AS stat
      FROM g)
SELECT event_type, nobs, CAST({lags} AS BIGINT) AS lags, {_r('stat', 'kpss_stat')},
       {_r(f'CASE WHEN stat IS NOT NULL THEN {pcase} END', 'kpss_pvalue')}
FROM k
"""


SQL["kpss_fixed_lag"] = _kpss_sql(8)


def _decomp_sql(period: int) -> str:
    half = period // 2
    width = 2 * half + 1
    # the frame is summed in the order of the engine's two parts: the end of one
    # block of `width` rows backwards, then the start of the next forwards
    add = "lambda a, b: a + b"
    total = (f"CASE WHEN e = {width} THEN list_reduce(l, {add}) "
             f"ELSE list_reduce(list_reverse(l[1:{width} - e]), {add}) + list_reduce(l[{width} - e + 1:], {add}) END")
    edges = "" if period % 2 else " - 0.5 * (before + after)"
    return f"""
dec_l{period} AS (
  SELECT event_type, ts, value, row_number() OVER w AS rn,
         list(value) OVER (w ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING) AS l,
         (row_number() OVER w - 1 + {half}) % {width} + 1 AS e,
         lag(value, {half}) OVER w AS before, lead(value, {half}) OVER w AS after
  FROM filled WINDOW w AS (PARTITION BY event_type ORDER BY ts)
),
dec_t{period} AS (
  SELECT event_type, ts, value AS observed, (rn - 1) % {period} AS phase,
         CASE WHEN len(l) = {width} THEN ({total}{edges}) / {period} END AS trend
  FROM dec_l{period}
),
dec_p{period} AS (SELECT event_type, phase, avg(observed - trend) AS pm FROM dec_t{period} GROUP BY 1, 2),
dec_c{period} AS (SELECT event_type, phase, pm - avg(pm) OVER (PARTITION BY event_type) AS seasonal FROM dec_p{period}),
dec{period} AS (
  SELECT t.event_type, t.ts, CAST({period} AS BIGINT) AS period, t.observed, t.trend, c.seasonal,
         t.observed - t.trend - c.seasonal AS resid
  FROM dec_t{period} t LEFT JOIN dec_c{period} c ON c.event_type = t.event_type AND c.phase = t.phase
)"""


def _harmonic_sql(daily_terms: int = 4, weekly_terms: int = 3) -> str:
    terms = ["1.0::DOUBLE"]
    for period, n in ((24, daily_terms), (168, weekly_terms)):
        for k in range(1, n + 1):
            arg = f"{repr(2.0 * math.pi * k / period)} * s"
            terms += [f"sin({arg})", f"cos({arg})"]
    k = len(terms)
    train = "ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-20 23:00:00'"
    return f"""
shape0 AS (
  SELECT event_type, min(epoch(ts))::BIGINT AS anchor, min(value) >= 0 AS use_log, count(*) AS n_train, min(value) AS lo, max(value) AS hi
  FROM hourly WHERE {train} AND value IS NOT NULL GROUP BY 1
),
shape AS (SELECT event_type, anchor, use_log, n_train, CASE WHEN use_log THEN ln(1 + lo) ELSE lo END AS low, CASE WHEN use_log THEN ln(1 + hi) ELSE hi END AS high FROM shape0),
stepped AS (
  SELECT h.event_type, h.ts, h.value, anchor, use_log, n_train, low, high, floor((epoch(h.ts) - anchor) / 3600) AS s,
         CASE WHEN use_log THEN CASE WHEN value >= 0 THEN ln(1 + value) END ELSE value END AS y
  FROM hourly h LEFT JOIN shape USING (event_type)
),
design AS (SELECT *, [{', '.join(terms)}] AS x FROM stepped),
cells AS (
  SELECT event_type, i, j, sum(x[i] * CASE WHEN j > {k} THEN y ELSE x[j] END) AS v
  FROM design, range(1, {k + 1}) a(i), range(1, {k + 2}) b(j) WHERE {train} AND value IS NOT NULL GROUP BY 1, 2, 3
),
lines_ AS (SELECT event_type, i, list(v ORDER BY j) AS line FROM cells GROUP BY 1, 2),
solve(event_type, s, m) AS (
  SELECT event_type, 0::BIGINT, list(line ORDER BY i) FROM lines_ GROUP BY 1
  UNION ALL
  SELECT event_type, s + 1, list_transform(m, lambda r, i: CASE WHEN i = s + 1 THEN p
      ELSE list_transform(r, lambda v, j: v - r[s + 1] * p[j]) END)
  FROM (SELECT event_type, s, m, list_transform(m[s + 1], lambda v: v / m[s + 1][s + 1]) AS p FROM solve WHERE s < {k})
),
coef AS (SELECT event_type, list_transform(m, lambda r: r[{k + 1}]) AS beta FROM solve JOIN shape USING (event_type) WHERE s = {k} AND n_train >= {4 * k}),
fitted AS (
  SELECT d.*, beta, list_dot_product(x, beta) AS fit, y - list_dot_product(x, beta) AS r
  FROM design d LEFT JOIN coef USING (event_type)
),
resid AS (
  SELECT event_type, r, lag(r, 1) OVER w AS a, lag(r, 2) OVER w AS b FROM fitted WHERE {train} AND value IS NOT NULL
  WINDOW w AS (PARTITION BY event_type ORDER BY ts)
),
ar0 AS (
  SELECT event_type, sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(r * a) AS ra, sum(r * b) AS rb, sum(r * r) AS rr
  FROM resid WHERE b IS NOT NULL GROUP BY 1
),
ar1 AS (SELECT *, (ra * bb - rb * ab) / (aa * bb - ab * ab) AS p1, (rb * aa - ra * ab) / (aa * bb - ab * ab) AS p2 FROM ar0),
ar2 AS (SELECT *, abs(p2) < 1 AND p1 + p2 < 1 AND p2 - p1 < 1 AS stable FROM ar1),
ar AS (SELECT event_type, ra, rb, rr, CASE WHEN stable THEN p1 ELSE 0 END AS phi1, CASE WHEN stable THEN p2 ELSE 0 END AS phi2 FROM ar2),
params AS (
  SELECT s.*, beta, phi1, phi2, greatest(0.0, rr - phi1 * ra - phi2 * rb) / greatest(n_train - 2, 1) AS sigma2
  FROM shape s JOIN coef USING (event_type) JOIN ar USING (event_type)
),
harmonic AS (
  SELECT event_type, ts, value AS y_true,
    greatest(f.low - (f.high - f.low) * 0.25, least(f.high + (f.high - f.low) * 0.25,
      fit + coalesce(phi1 * lag(r, 1) OVER w, 0) + coalesce(phi2 * lag(r, 2) OVER w, 0))) AS z, f.use_log
  FROM fitted f JOIN ar USING (event_type) WINDOW w AS (PARTITION BY event_type ORDER BY ts)
),
test AS (
  SELECT 'harmonic' AS model, event_type, ts, y_true, CASE WHEN use_log THEN exp(z) - 1 ELSE z END AS y_pred
  FROM harmonic WHERE ts BETWEEN {TEST_WINDOW}
)"""


SQL["harmonic_params"] = f"""
WITH RECURSIVE {HOURLY}, {_harmonic_sql()}
SELECT event_type, anchor, use_log, n_train, {_r('low')}, {_r('high')}, {_r('phi1')}, {_r('phi2')}, {_r('sigma2')},
       term, {_r('b', 'beta')}
FROM (SELECT *, unnest(beta) AS b, unnest(range(0, len(beta))) AS term FROM params)
"""

SQL["harmonic_forecast"] = f"""
WITH RECURSIVE {HOURLY}, {_harmonic_sql()}
SELECT model, event_type, {_ts('ts')}, {_r('y_true')}, {_r('y_pred')} FROM test
"""

SQL["harmonic_metrics"] = f"""
WITH RECURSIVE {HOURLY}, {_harmonic_sql()},
m AS (SELECT event_type, model, {METRICS} FROM test GROUP BY event_type, model)
SELECT event_type, model, n, {_r('MAE')}, {_r('RMSE')}, {_r('MAPE_percent')}, {_r('sMAPE_percent')} FROM m
"""

SQL["classical_decomposition"] = f"""
WITH {HOURLY}, {FILLED}, {_decomp_sql(24)}
SELECT event_type, {_ts('ts')}, period, {_r('observed')}, {_r('trend')}, {_r('seasonal')}, {_r('resid')} FROM dec24
"""

SQL["strengths"] = f"""
WITH {HOURLY}, {FILLED}, {_decomp_sql(24)}, {_decomp_sql(168)},
both_ AS (SELECT * FROM dec24 UNION ALL SELECT * FROM dec168)
SELECT event_type, period,
  {_r('greatest(0.0, 1 - var_pop(resid) / greatest(var_pop(seasonal + resid), 1e-12))', 'seasonal_strength')},
  {_r('greatest(0.0, 1 - var_pop(resid) / greatest(var_pop(trend + resid), 1e-12))', 'trend_strength')}
FROM both_ GROUP BY 1, 2
"""

SQL["residual_outliers"] = f"""
WITH {HOURLY}, {FILLED}, {_decomp_sql(24)},
z AS (
  SELECT event_type, ts, observed AS value, resid AS residual,
    (resid - avg(resid) OVER (PARTITION BY event_type, period))
      / greatest(stddev_pop(resid) OVER (PARTITION BY event_type, period), 1e-12) AS z
  FROM dec24
)
SELECT event_type, {_ts('ts')}, {_r('value')}, {_r('residual')}, {_r('z')} FROM z WHERE abs(z) > 4.0
"""

SQL["drop_runs"] = f"""
WITH {HOURLY}, {FILLED},
b AS (SELECT event_type, ts, value, lag(value, 24) OVER (PARTITION BY event_type ORDER BY ts) AS base FROM filled),
r AS (SELECT event_type, ts, CASE WHEN abs(base) >= 1e-6 THEN (value - base) / base END AS rel,
             row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn FROM b),
f AS (SELECT *, rn - row_number() OVER (PARTITION BY event_type ORDER BY ts) AS island
      FROM r WHERE coalesce(rel < -0.4, false)),
g AS (SELECT event_type, min(ts) AS s, max(ts) AS e, avg(rel) AS m, count(*) AS length FROM f GROUP BY event_type, island)
SELECT event_type, {_ts('s', 'start')}, {_ts('e', '"end"')}, {_r('m', 'mean_relative_drop')}, length
FROM g WHERE length >= 2
"""

# ---------------------------------------------------------------- features
def _fourier_cols(period: int, terms: int, prefix: str) -> str:
    cols = []
    for k in range(1, terms + 1):
        c = repr(2.0 * math.pi * k / period)
        cols.append(_r(f"sin({c} * s)", f"{prefix}_sin{k}"))
        cols.append(_r(f"cos({c} * s)", f"{prefix}_cos{k}"))
    return ", ".join(cols)


SQL["fourier_features"] = f"""
WITH {HOURLY},
a AS (
  SELECT *, min(CASE WHEN ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-20 23:00:00'
                     THEN CAST(floor(epoch(ts)) AS BIGINT) END) OVER (PARTITION BY event_type) AS anchor
  FROM hourly
),
st AS (SELECT *, CAST(floor((CAST(floor(epoch(ts)) AS BIGINT) - anchor) / 3600.0) AS DOUBLE) AS s FROM a)
SELECT event_type, {_ts('ts')}, {_r('value')}, {_fourier_cols(24, 4, 'daily')}, {_fourier_cols(168, 3, 'weekly')}
FROM st
"""

_TWO_PI = 2.0 * math.pi
SQL["calendar_features"] = f"""
WITH {HOURLY},
c AS (SELECT *, CAST(floor((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 3600) AS DOUBLE) AS slot,
             CAST(isodow(ts) - 1 AS DOUBLE) AS dow FROM hourly)
SELECT event_type, {_ts('ts')}, {_r('value')},
  {_r(f'sin({repr(_TWO_PI / 24)} * slot)', 'tod_sin')}, {_r(f'cos({repr(_TWO_PI / 24)} * slot)', 'tod_cos')},
  {_r(f'sin({repr(_TWO_PI / 7.0)} * dow)', 'dow_sin')}, {_r(f'cos({repr(_TWO_PI / 7.0)} * dow)', 'dow_cos')},
  {_r('CASE WHEN dow >= 5 THEN 1.0 ELSE 0.0 END', 'is_weekend')}
FROM c
"""

SQL["scaled_features"] = f"""
WITH {HOURLY},
sc AS (
  SELECT event_type, avg(value) AS scale_mean,
         CASE WHEN stddev_pop(value) < 1e-9 THEN 1.0 ELSE stddev_pop(value) END AS scale_std
  FROM hourly WHERE value IS NOT NULL AND ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-20 23:00:00'
  GROUP BY 1
)
SELECT h.event_type, {_ts('h.ts', 'ts')}, {_r('h.value', 'value')}, {_r('scale_mean')}, {_r('scale_std')},
       {_r('(h.value - scale_mean) / scale_std', 'z')}
FROM hourly h JOIN sc ON sc.event_type = h.event_type
"""

_LAGS = (1, 2, 3, 24, 168)
SQL["lag_windows"] = f"""
WITH {HOURLY},
l AS (SELECT *, {', '.join(f'lag(value, {k}) OVER w AS lag_{k}' for k in _LAGS)}
      FROM hourly WINDOW w AS (PARTITION BY event_type ORDER BY ts))
SELECT event_type, {_ts('ts')}, {_r('value')}, {', '.join(_r(f'lag_{k}') for k in _LAGS)}
FROM l WHERE {' AND '.join(f'lag_{k} IS NOT NULL' for k in _LAGS)}
"""

# ---------------------------------------------------------------- evaluation
_MODELS = ("naive_last", "naive_daily", "naive_weekly")
SQL["residual_table"] = f"""
WITH {BASE_FORECASTS},
w AS (
  SELECT event_type, ts, first(y_true) AS y_true,
    {', '.join(f"first(y_pred) FILTER (WHERE model = '{m}') AS {m}" for m in _MODELS)}
  FROM test GROUP BY 1, 2
)
SELECT event_type, {_ts('ts')}, {_r('y_true')},
  {', '.join(_r(m, f'pred_{m}') for m in _MODELS)},
  {', '.join(_r(f'y_true - {m}', f'resid_{m}') for m in _MODELS)}
FROM w
"""

SQL["rolling_mae"] = f"""
WITH {BASE_FORECASTS}
SELECT model, event_type, {_ts('ts')}, {_r('y_true')}, {_r('y_pred')},
  {_r('CASE WHEN count(abs(y_true - y_pred)) OVER w = 6 THEN avg(abs(y_true - y_pred)) OVER w END', 'rolling_mae')}
FROM test WINDOW w AS (PARTITION BY event_type, model ORDER BY ts ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
"""

FAILURES = f"""
{BASE_FORECASTS},
jr AS (
  SELECT model, event_type, ts,
    CASE WHEN count(ae) OVER w6 = 6 THEN avg(ae) OVER w6 END AS r,
    avg(ae) OVER (PARTITION BY event_type, model) AS a
  FROM (SELECT *, abs(y_true - y_pred) AS ae FROM test)
  WINDOW w6 AS (PARTITION BY event_type, model ORDER BY ts ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
),
jf AS (SELECT *, coalesce(r > a * 2.0, false) AS flag, r / greatest(a, 1e-9) AS ratio FROM jr),
jp AS (SELECT event_type, ts, bool_and(flag) AS joint, count(model) AS n, sum(ratio) AS severity FROM jf GROUP BY 1, 2),
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY severity DESC, ts) AS k
    FROM jp WHERE joint AND n = 3) WHERE k = 1
)"""

SQL["joint_failure"] = f"""
WITH {FAILURES}
SELECT b.event_type, {_ts('b.ts - INTERVAL 3 HOUR', 'start')}, {_ts('b.ts + INTERVAL 3 HOUR', '"end"')},
       {_ts('b.ts', 'peak')}, {_r('b.severity', 'severity')}, jf.model, {_r('jf.ratio', 'ratio')}
FROM best b JOIN jf ON jf.event_type = b.event_type AND jf.ts = b.ts
"""

SQL["failure_context"] = f"""
WITH {FAILURES}
SELECT t.model, t.event_type, {_ts('t.ts', 'ts')}, {_r('t.y_true', 'y_true')}, {_r('t.y_pred', 'y_pred')},
       t.ts BETWEEN b.ts - INTERVAL 3 HOUR AND b.ts + INTERVAL 3 HOUR AS in_window
FROM test t JOIN best b ON b.event_type = t.event_type
 AND t.ts BETWEEN b.ts - INTERVAL 3 HOUR - INTERVAL 2 HOUR AND b.ts + INTERVAL 3 HOUR + INTERVAL 2 HOUR
"""

# ---------------------------------------------------------------- tuning, run log
VAL_WINDOW = "TIMESTAMP '2024-01-21 00:00:00' AND TIMESTAMP '2024-01-23 23:00:00'"

SQL["tuning_naive"] = f"""
WITH {HOURLY},
lastv AS (
  SELECT h.event_type, h.ts, h.value AS y_true,
         last_value(h.value) OVER (PARTITION BY h.event_type ORDER BY h.ts
             RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS p_last
  FROM hourly h
),
fc AS (
  SELECT l.event_type, l.ts, l.y_true, l.p_last,
         CASE WHEN a.ts IS NOT NULL THEN a.value ELSE l.p_last END AS p_day,
         CASE WHEN b.ts IS NOT NULL THEN b.value ELSE l.p_last END AS p_two_days,
         CASE WHEN c.ts IS NOT NULL THEN c.value ELSE l.p_last END AS p_week
  FROM lastv l
  LEFT JOIN hourly a ON a.event_type = l.event_type AND a.ts = l.ts - INTERVAL 24 HOUR
  LEFT JOIN hourly b ON b.event_type = l.event_type AND b.ts = l.ts - INTERVAL 48 HOUR
  LEFT JOIN hourly c ON c.event_type = l.event_type AND c.ts = l.ts - INTERVAL 168 HOUR
),
long AS (
  SELECT 'last' AS label, 'last' AS period, event_type, ts, y_true, p_last AS y_pred FROM fc
  UNION ALL SELECT 'day', '24', event_type, ts, y_true, p_day FROM fc
  UNION ALL SELECT 'two_days', '48', event_type, ts, y_true, p_two_days FROM fc
  UNION ALL SELECT 'week', '168', event_type, ts, y_true, p_week FROM fc
),
m AS (
  SELECT event_type, label, period,
    round_even(avg(abs(y_true - y_pred)), 4) AS val_MAE,
    round_even(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 4) AS val_RMSE,
    round_even(avg(abs(y_true - y_pred) / greatest(abs(y_true), 0.001)) * 100, 4) AS val_MAPE_percent,
    round_even(avg(CASE WHEN (abs(y_true) + abs(y_pred)) / 2 > 0
           THEN abs(y_true - y_pred) / ((abs(y_true) + abs(y_pred)) / 2) END) * 100, 4) AS val_sMAPE_percent
  FROM long WHERE ts BETWEEN {VAL_WINDOW} GROUP BY 1, 2, 3
)
SELECT 'naive' AS model, event_type, label, CAST(0.0 AS DOUBLE) AS train_seconds,
       {_r('val_MAE')}, {_r('val_RMSE')}, {_r('val_MAPE_percent')}, {_r('val_sMAPE_percent')},
       '' AS notes, period AS "param.period"
FROM m
"""

SQL["run_log_upsert"] = f"""
WITH {BASE_FORECASTS},
val AS (SELECT model, event_type, count(*) AS steps, avg(abs(y_true - y_pred)) AS val_MAE
        FROM long WHERE ts BETWEEN {VAL_WINDOW} GROUP BY 1, 2),
tst AS (SELECT model, event_type, count(*) AS steps, avg(abs(y_true - y_pred)) AS test_MAE
        FROM long WHERE ts BETWEEN {TEST_WINDOW} GROUP BY 1, 2)
SELECT coalesce(t.model, v.model) AS model, coalesce(t.event_type, v.event_type) AS event_type,
       CASE WHEN t.model IS NOT NULL THEN t.steps ELSE v.steps END AS steps,
       {_r('v.val_MAE', 'val_MAE')}, {_r('t.test_MAE', 'test_MAE')}
FROM val v FULL OUTER JOIN tst t ON t.model = v.model AND t.event_type = v.event_type
"""

# ---------------------------------------------------------------- streaming
SQL["stream_bins"] = f"""
WITH {HOURLY}
SELECT event_type, {_ts('ts')}, {_r('value')} FROM hourly
"""

SQL["stream_online_error"] = f"""
WITH {HOURLY},
l AS (
  SELECT h.event_type, h.ts, h.value AS y_true,
         last_value(h.value) OVER (PARTITION BY h.event_type ORDER BY h.ts
             RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS pred_last
  FROM hourly h
)
SELECT l.event_type, {_ts('l.ts', 'ts')}, {_r('l.y_true', 'y_true')}, {_r('l.pred_last', 'pred_last')},
       {_r('CASE WHEN d.ts IS NOT NULL THEN d.value ELSE l.pred_last END', 'pred_seasonal')},
       {_r('abs(l.y_true - l.pred_last)', 'abs_err_last')},
       {_r('abs(l.y_true - CASE WHEN d.ts IS NOT NULL THEN d.value ELSE l.pred_last END)', 'abs_err_seasonal')}
FROM l LEFT JOIN hourly d ON d.event_type = l.event_type AND d.ts = l.ts - INTERVAL 24 HOUR
"""

# ---------------------------------------------------------------- whole-grid forms
SQL["cells_walkforward"] = f"""
WITH {CELLS},
lastv AS (
  SELECT c.user_id, c.ts, c.value AS y_true,
         last_value(c.value) OVER (PARTITION BY c.user_id ORDER BY c.ts
             RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS naive_last
  FROM cells c
),
fc AS (
  SELECT l.user_id, l.ts, l.y_true, l.naive_last,
         CASE WHEN d.ts IS NOT NULL THEN d.value ELSE l.naive_last END AS naive_daily
  FROM lastv l LEFT JOIN cells d ON d.user_id = l.user_id AND d.ts = l.ts - INTERVAL 24 HOUR
),
long AS (
  SELECT 'naive_last' AS model, user_id, ts, y_true, naive_last AS y_pred FROM fc
  UNION ALL SELECT 'naive_daily', user_id, ts, y_true, naive_daily FROM fc
),
m AS (SELECT user_id, model, {METRICS} FROM long WHERE ts BETWEEN {TEST_WINDOW} GROUP BY 1, 2)
SELECT user_id, model, n, {_r('MAE')}, {_r('RMSE')}, {_r('MAPE_percent')}, {_r('sMAPE_percent')} FROM m
"""

SQL["store_partitions"] = f"""
WITH {CANON}
SELECT strftime(file_day, '%Y-%m-%d') AS day, strftime(file_day, '%Y-%m') AS year_month,
       count(*) AS rows, true AS has_bytes, true AS has_sha256
FROM canon GROUP BY 1, 2
"""

SQL["store_series"] = f"""
WITH {CANON}
SELECT CAST(square_id AS BIGINT) AS square_id, {_ts('ts')}, {_r('internet')}
FROM canon
"""
SQL["store_week"] = f"{SQL['store_series']} WHERE ts BETWEEN {WEEK2}"

SQL["orders_walkforward"] = f"""
WITH {DAILY_ORDERS},
lastv AS (
  SELECT o.o_orderpriority, o.ts, o.value AS y_true,
         last_value(o.value) OVER (PARTITION BY o.o_orderpriority ORDER BY o.ts
             RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS naive_last
  FROM daily o
),
fc AS (
  SELECT l.o_orderpriority, l.ts, l.y_true, l.naive_last,
         CASE WHEN w.ts IS NOT NULL THEN w.value ELSE l.naive_last END AS naive_weekly
  FROM lastv l LEFT JOIN daily w ON w.o_orderpriority = l.o_orderpriority AND w.ts = l.ts - INTERVAL 7 DAY
),
long AS (
  SELECT 'naive_last' AS model, o_orderpriority, ts, y_true, naive_last AS y_pred FROM fc
  UNION ALL SELECT 'naive_weekly', o_orderpriority, ts, y_true, naive_weekly FROM fc
),
m AS (SELECT o_orderpriority, model, {METRICS} FROM long
      WHERE ts BETWEEN TIMESTAMP '2001-03-01 00:00:00' AND TIMESTAMP '2001-08-01 00:00:00' GROUP BY 1, 2)
SELECT o_orderpriority, model, n, {_r('MAE')}, {_r('RMSE')}, {_r('MAPE_percent')}, {_r('sMAPE_percent')} FROM m
"""

# full correlogram by direct sums (the Spark side uses an FFT per series)
SQL["acf_full"] = f"""
WITH {HOURLY},
s AS (
  SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn,
         value - avg(value) OVER (PARTITION BY event_type) AS d,
         count(*) OVER (PARTITION BY event_type) AS n
  FROM hourly WHERE value IS NOT NULL
),
lags AS (SELECT DISTINCT event_type, n, unnest(range(0, least(336, n - 1) + 1)) AS lag FROM s),
c AS (
  SELECT l.event_type, l.lag, l.n, sum(a.d * b.d) AS num
  FROM lags l JOIN s a ON a.event_type = l.event_type
  JOIN s b ON b.event_type = l.event_type AND b.rn = a.rn + l.lag
  GROUP BY 1, 2, 3
),
den AS (SELECT event_type, sum(d * d) AS den FROM s GROUP BY 1),
r AS (SELECT c.event_type, c.lag, c.n, c.num / den.den AS acf FROM c JOIN den ON den.event_type = c.event_type),
v AS (
  SELECT *, CASE WHEN lag = 0 THEN 0.0 WHEN lag = 1 THEN 1.0 / n
                 ELSE (1.0 + 2 * (sum(acf * acf) OVER (PARTITION BY event_type ORDER BY lag
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1.0)) / n END AS var
  FROM r
)
SELECT event_type, CAST(lag AS BIGINT) AS lag, {_r('acf')}, {_r('1.959963984540054 * sqrt(var)', 'band')} FROM v
"""

# partial autocorrelation: Durbin-Levinson recursion as a recursive CTE
SQL["pacf"] = f"""
WITH RECURSIVE {HOURLY},
s AS (
  SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn,
         value - avg(value) OVER (PARTITION BY event_type) AS d,
         count(*) OVER (PARTITION BY event_type) AS n
  FROM hourly WHERE value IS NOT NULL
),
nl AS (SELECT DISTINCT event_type, n, greatest(0, least(60, n // 2 - 1)) AS maxlag FROM s),
lags AS (SELECT event_type, n, maxlag, unnest(range(0, maxlag + 1)) AS lag FROM nl),
c AS (
  SELECT l.event_type, l.lag, sum(a.d * b.d) AS num
  FROM lags l JOIN s a ON a.event_type = l.event_type
  JOIN s b ON b.event_type = l.event_type AND b.rn = a.rn + l.lag
  GROUP BY 1, 2
),
den AS (SELECT event_type, sum(d * d) AS den FROM s GROUP BY 1),
r AS (
  SELECT nl.event_type, nl.n, nl.maxlag, list(c.num / den.den ORDER BY c.lag) AS rl
  FROM nl JOIN c ON c.event_type = nl.event_type JOIN den ON den.event_type = nl.event_type
  GROUP BY 1, 2, 3
),
dl AS (
  SELECT event_type, n, maxlag, rl, 1 AS k, [rl[2]] AS phi, 1.0 - rl[2] * rl[2] AS v, rl[2] AS a
  FROM r WHERE maxlag >= 1
  UNION ALL
  SELECT event_type, n, maxlag, rl, k + 1,
         list_append(list_transform(range(1, k + 1), lambda j: phi[j] - na * phi[k + 1 - j]), na),
         v * (1 - na * na), na
  FROM (
    SELECT *, (rl[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * rl[k + 2 - j]))) / v AS na
    FROM dl
  ) t
  WHERE k < maxlag
)
SELECT event_type, CAST(k AS BIGINT) AS lag, {_r('a', 'pacf')}, {_r('1.959963984540054 / sqrt(n)', 'band')} FROM dl
UNION ALL
SELECT event_type, CAST(0 AS BIGINT), 1.0, {_r('1.959963984540054 / sqrt(n)', 'band')} FROM nl
"""

SQL["comparison_lines"] = f"""
WITH {BASE_FORECASTS},
m AS (
  SELECT event_type, model,
    round_even(avg(abs(y_true - y_pred)), 4) AS MAE,
    round_even(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 4) AS RMSE,
    round_even(avg(abs(y_true - y_pred) / greatest(abs(y_true), 0.001)) * 100, 4) AS MAPE_percent,
    round_even(avg(CASE WHEN (abs(y_true) + abs(y_pred)) / 2 > 0
           THEN abs(y_true - y_pred) / ((abs(y_true) + abs(y_pred)) / 2) END) * 100, 4) AS sMAPE_percent
  FROM test GROUP BY 1, 2
)
SELECT '| event_type | model | MAE | RMSE | MAPE_percent | sMAPE_percent |' AS line
UNION ALL SELECT '|---|---|---|---|---|---|'
UNION ALL
SELECT '| ' || concat_ws(' | ', event_type, model, CAST(MAE AS VARCHAR), CAST(RMSE AS VARCHAR),
                         CAST(MAPE_percent AS VARCHAR), CAST(sMAPE_percent AS VARCHAR)) || ' |'
FROM m
"""


def _kpss_auto_sql() -> str:
    crit, pv = (0.119, 0.146, 0.176, 0.216), (0.10, 0.05, 0.025, 0.01)
    pcase = f"CASE WHEN stat <= {crit[0]} THEN {pv[0]}"
    for i in range(3):
        pcase += (
            f" WHEN stat <= {crit[i + 1]} THEN {pv[i]} + ((stat - {crit[i]}) / {repr(crit[i + 1] - crit[i])})"
            f" * {repr(pv[i + 1] - pv[i])}"
        )
    pcase += f" ELSE {pv[-1]} END"
    return f"""
WITH {HOURLY},
s AS (SELECT event_type, value AS x, CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts) AS DOUBLE) AS t,
             count(*) OVER (PARTITION BY event_type) AS n
      FROM hourly WHERE value IS NOT NULL),
f AS (SELECT *, regr_slope(x, t) OVER (PARTITION BY event_type) AS b,
                regr_intercept(x, t) OVER (PARTITION BY event_type) AS a FROM s),
e AS (SELECT event_type, t, n, x - (a + b * t) AS e FROM f),
cum AS (SELECT event_type, sum(e) OVER (PARTITION BY event_type ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS S FROM e),
ss AS (SELECT event_type, sum(S * S) AS ss FROM cum GROUP BY 1),
e0 AS (SELECT event_type, any_value(n) AS n, sum(e * e) AS e2 FROM e GROUP BY 1),
cl AS (SELECT event_type, n, unnest(range(1, CAST(floor(pow(n, 2.0 / 9.0)) AS BIGINT) + 1)) AS k FROM e0),
cp AS (
  SELECT cl.event_type, cl.k, sum(x.e * y.e) / (cl.n / 2.0) AS prod
  FROM cl JOIN e x ON x.event_type = cl.event_type
  JOIN e y ON y.event_type = cl.event_type AND y.t = x.t - cl.k
  GROUP BY cl.event_type, cl.k, cl.n
),
au AS (
  SELECT e0.event_type, e0.n, e0.e2, e0.e2 / e0.n + sum(cp.prod) AS s0, sum(cp.k * cp.prod) AS s1
  FROM e0 JOIN cp ON cp.event_type = e0.event_type GROUP BY e0.event_type, e0.n, e0.e2
),
lg AS (
  SELECT event_type, n, e2,
         least(CAST(floor(1.1447 * pow((s1 / s0) * (s1 / s0), 1.0 / 3.0) * pow(n, 1.0 / 3.0)) AS BIGINT), n - 1) AS lags
  FROM au
),
lp AS (SELECT event_type, lags, unnest(range(1, lags + 1)) AS k FROM lg),
pp AS (
  SELECT lp.event_type, sum(2.0 * x.e * y.e * (1.0 - lp.k / (lp.lags + 1.0))) AS p
  FROM lp JOIN e x ON x.event_type = lp.event_type
  JOIN e y ON y.event_type = lp.event_type AND y.t = x.t - lp.k
  GROUP BY lp.event_type
),
k AS (
  SELECT lg.event_type, lg.lags, (ss.ss / (CAST(lg.n AS DOUBLE) * lg.n)) / ((lg.e2 + coalesce(pp.p, 0.0)) / lg.n) AS stat
  FROM lg JOIN ss ON ss.event_type = lg.event_type LEFT JOIN pp ON pp.event_type = lg.event_type
)
SELECT event_type, {_r('stat', 'kpss_stat')}, {_r(pcase, 'kpss_pvalue')}, CAST(lags AS DOUBLE) AS kpss_lags FROM k
"""


SQL["kpss_auto"] = _kpss_auto_sql()

# ---------------------------------------------------------------- augmented Dickey-Fuller
def _sweep(name: str, matrix: str, steps: str) -> str:
    """Gauss-Jordan steps on each row's matrix ``m`` of table ``matrix`` (event_type, m, steps); one row per step."""
    return f"""
{name}(event_type, s, m, steps) AS (
  SELECT event_type, 0::BIGINT, m, {steps} FROM {matrix}
  UNION ALL
  SELECT event_type, s + 1, list_transform(m, lambda r, i: CASE WHEN i = s + 1 THEN p
      ELSE list_transform(r, lambda v, j: v - r[s + 1] * p[j]) END), steps
  FROM (SELECT *, list_transform(m[s + 1], lambda v: v / m[s + 1][s + 1]) AS p FROM {name} WHERE s < steps)
)"""


def _moments(name: str, rows: str) -> str:
    """Matrices of sums of products of the vectors ``x`` in ``rows``, for each entity."""
    return f"""
{name}_c AS (SELECT event_type, i, j, sum(x[i] * x[j]) AS v FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM {rows}), range(1, 60) b(j) WHERE j <= len(x) GROUP BY 1, 2, 3),
{name}_l AS (SELECT event_type, i, list(v ORDER BY j) AS line FROM {name}_c GROUP BY 1, 2),
{name} AS (SELECT event_type, list(line ORDER BY i) AS m FROM {name}_l GROUP BY 1)"""


def _adf_ctes(src: str, tag: str) -> str:
    """adf_{tag}: (event_type, n_obs, tau, pvalue, usedlag, nobs) of table ``src`` (event_type, ts, v).

    Regressors are eliminated one after the other, so the sum of squares after
    each step is that of the regression with one more lag.
    """
    small, large = (3.2512, 1.6047, 0.049588), (2.5261, 0.61654, -0.37956, -0.060285)
    poly = lambda c: " + ".join(f"{v} * pow(tau, {k})" for k, v in enumerate(c))
    return f"""
x_{tag} AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS i, v - avg(v) OVER (PARTITION BY event_type) AS x FROM {src} WHERE v IS NOT NULL),
n_{tag} AS (SELECT event_type, count(*) AS n, least(count(*) // 2 - 3, ceil(12 * pow(count(*) / 100.0, 0.25)))::BIGINT AS k FROM x_{tag} GROUP BY 1 HAVING count(*) >= 100),
d_{tag} AS (SELECT event_type, i - 1 AS j, x - lag(x) OVER w AS dx, lag(x) OVER w AS level FROM x_{tag} WINDOW w AS (PARTITION BY event_type ORDER BY i)),
s_{tag} AS (SELECT event_type, n, k, list(dx ORDER BY j) AS d, list(level ORDER BY j) AS l FROM d_{tag} JOIN n_{tag} USING (event_type) WHERE dx IS NOT NULL GROUP BY 1, 2, 3),
a_{tag} AS (
  SELECT event_type, [1.0::DOUBLE, j - k - (n - k) / 2.0, l[j]] || list_reverse(d[j - k : j - 1]) || [d[j]] AS x
  FROM (SELECT *, unnest(range(k + 1, n)) AS j FROM s_{tag})
),{_moments(f"am_{tag}", f"a_{tag}")},{_sweep(f"as_{tag}", f"(SELECT event_type, m, len(m) - 1 AS steps FROM am_{tag})", "steps")},
aic_{tag} AS (
  SELECT event_type, s - 3 AS lag, (n - 1 - k) * (ln(2 * pi()) + ln(greatest(m[k + 4][k + 4], 1e-300) / (n - 1 - k)) + 1) + 2 * s AS aic
  FROM as_{tag} JOIN n_{tag} USING (event_type) WHERE s >= 3
),
best_{tag} AS (SELECT event_type, arg_min(lag, (aic, lag)) AS lag FROM aic_{tag} GROUP BY 1),
b_{tag} AS (
  SELECT event_type, [1.0::DOUBLE, j - lag - (n - lag) / 2.0] || list_reverse(d[j - lag : j - 1]) || [l[j], d[j]] AS x
  FROM (SELECT *, unnest(range(lag + 1, n)) AS j FROM s_{tag} JOIN best_{tag} USING (event_type))
),{_moments(f"bm_{tag}", f"b_{tag}")},{_sweep(f"bs_{tag}", f"(SELECT event_type, m, len(m) - 2 AS steps FROM bm_{tag})", "steps")},
t_{tag} AS (
  SELECT event_type, n AS n_obs, lag, n - 1 - lag AS nobs,
    (m[p][p + 1] / m[p][p]) / sqrt((m[p + 1][p + 1] - m[p][p + 1] * m[p][p + 1] / m[p][p]) / (n - 1 - lag - p) / m[p][p]) AS tau
  FROM (SELECT *, steps + 1 AS p FROM bs_{tag} WHERE s = steps) JOIN n_{tag} USING (event_type) JOIN best_{tag} USING (event_type)
),
z_{tag} AS (SELECT *, CASE WHEN tau <= -2.89 THEN {poly(small)} ELSE {poly(large)} END AS z FROM t_{tag}),
adf_{tag} AS (
  SELECT event_type, n_obs, tau, lag AS usedlag, nobs,
    CASE WHEN tau > 0.7 THEN 1.0 WHEN tau < -16.18 THEN 0.0
         -- the normal distribution function by its series
         ELSE 0.5 + exp(-z * z / 2) / sqrt(2 * pi()) * list_reduce(list_prepend({{'t': z, 's': z}}, list_transform(range(1, 150), lambda q: {{'t': q::DOUBLE, 's': 0.0::DOUBLE}})),
           lambda acc, q: {{'t': acc.t * z * z / (2 * q.t + 1), 's': acc.s + acc.t * z * z / (2 * q.t + 1)}}).s END AS pvalue
  FROM z_{tag}
)"""


_LEVELS = "levels AS (SELECT event_type, ts, value AS v FROM hourly)"
_DIFFS = ", ".join(
    f"diff{k} AS (SELECT event_type, ts, value - lag(value, {k}) OVER (PARTITION BY event_type ORDER BY ts) AS v FROM hourly)" for k in (1, 24)
)

SQL["stationarity_tests"] = f"""
WITH RECURSIVE {HOURLY}, {_LEVELS}, {_adf_ctes("levels", "lv")},
kpss AS ({_kpss_auto_sql()})
SELECT a.event_type, n_obs, {_r('tau', 'adf_stat')}, {_r('pvalue', 'adf_pvalue')}, {_r('usedlag', 'adf_usedlag')}, {_r('nobs', 'adf_nobs')},
       kpss_stat, kpss_pvalue, kpss_lags
FROM adf_lv a JOIN kpss k USING (event_type)
"""

SQL["adf_after_diff"] = f"""
WITH RECURSIVE {HOURLY}, {_DIFFS}, {_adf_ctes("diff1", "d1")}, {_adf_ctes("diff24", "d24")}
SELECT event_type, 1::BIGINT AS lag, {_r('tau', 'adf_stat_diff')}, {_r('pvalue', 'adf_p_diff')} FROM adf_d1
UNION ALL SELECT event_type, 24, {_r('tau', 'adf_stat_diff')}, {_r('pvalue', 'adf_p_diff')} FROM adf_d24
"""

_REG_DIFFS = ", ".join(
    f"rdiff{k} AS (SELECT event_type, ts, value - lag(value, {k}) OVER (PARTITION BY event_type ORDER BY ts) AS v FROM reg)" for k in (1, 24)
)

SQL["eda_summary"] = f"""
WITH RECURSIVE {HOURLY}, {FILLED}, {_LEVELS}, {_REG_DIFFS},
{_adf_ctes("levels", "lv")}, {_adf_ctes("rdiff1", "d1")}, {_adf_ctes("rdiff24", "d24")},
kpss AS ({SQL["kpss_auto"]}), st AS ({SQL["strengths"]}), ac AS ({SQL["acf_lags"]}), ro AS ({SQL["residual_outliers"]}),
dr AS ({SQL["drop_runs"].replace("lag(value, 24)", "lag(value, 168)").replace("-0.4", "-0.6").replace(">= 2", ">= 6")})
SELECT e.event_type, e.n_obs, {_r('a.tau', 'adf_stat')}, {_r('a.pvalue', 'adf_pvalue')}, {_r('a.usedlag', 'adf_usedlag')}, {_r('a.nobs', 'adf_nobs')},
  kpss_stat, kpss_pvalue, kpss_lags,
  {_r('d1.tau', 'adf_stat_diff1')}, {_r('d1.pvalue', 'adf_p_diff1')}, {_r('d24.tau', 'adf_stat_diff_daily')}, {_r('d24.pvalue', 'adf_p_diff_daily')},
  {', '.join(f"(SELECT {f}_strength FROM st WHERE st.event_type = e.event_type AND period = {p}) AS {f}_strength_{n}" for p, n in ((24, 'daily'), (168, 'weekly')) for f in ('seasonal', 'trend'))},
  {', '.join(f"(SELECT acf FROM ac WHERE ac.event_type = e.event_type AND lag = {p}) AS acf_{n}" for p, n in ((24, 'daily'), (168, 'weekly')))},
  (SELECT count(*) FROM ro WHERE ro.event_type = e.event_type) AS outliers_count,
  (SELECT count(*) FROM dr WHERE dr.event_type = e.event_type) AS drop_runs_count
FROM (SELECT event_type, count(value) AS n_obs FROM hourly GROUP BY 1) e
LEFT JOIN adf_lv a ON a.event_type = e.event_type LEFT JOIN adf_d1 d1 ON d1.event_type = e.event_type
LEFT JOIN adf_d24 d24 ON d24.event_type = e.event_type LEFT JOIN kpss ON kpss.event_type = e.event_type
"""

SQL["stream_incremental"] = f"""
WITH {CANON}
SELECT CAST(square_id AS BIGINT) AS square_id, {_ts('ts')}, {_r('internet')}, strftime(file_day, '%Y-%m-%d') AS day
FROM canon
"""

SQL["sliding_windows"] = f"""
WITH {HOURLY},
sc AS (
  SELECT event_type, avg(value) AS scale_mean,
         CASE WHEN stddev_pop(value) < 1e-9 THEN 1.0 ELSE stddev_pop(value) END AS scale_std
  FROM hourly WHERE value IS NOT NULL AND ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-20 23:00:00'
  GROUP BY 1
),
c AS (
  SELECT h.event_type, h.ts, (h.value - sc.scale_mean) / sc.scale_std AS z,
         row_number() OVER (PARTITION BY h.event_type ORDER BY h.ts) AS rn,
         CAST(floor((hour(h.ts) * 3600 + minute(h.ts) * 60 + second(h.ts)) / 3600) AS DOUBLE) AS slot,
         CAST(isodow(h.ts) - 1 AS DOUBLE) AS dow
  FROM hourly h JOIN sc ON sc.event_type = h.event_type
)
SELECT t.event_type, {_ts('t.ts', 'ts')}, CAST(s.rn - (t.rn - 24) AS BIGINT) AS k, {_r('s.z', 'z')},
  {_r(f'sin({repr(_TWO_PI / 24)} * s.slot)', 'tod_sin')}, {_r(f'cos({repr(_TWO_PI / 24)} * s.slot)', 'tod_cos')},
  {_r(f'sin({repr(_TWO_PI / 7.0)} * s.dow)', 'dow_sin')}, {_r(f'cos({repr(_TWO_PI / 7.0)} * s.dow)', 'dow_cos')},
  {_r('CASE WHEN s.dow >= 5 THEN 1.0 ELSE 0.0 END', 'is_weekend')}
FROM c t JOIN c s ON s.event_type = t.event_type AND s.rn BETWEEN t.rn - 24 AND t.rn - 1
WHERE t.rn > 24
"""

# ---------------------------------------------------------------- the heavy operators over every user's series
SQL["cells_interpolate"] = SQL["interpolate"].replace("event_type", "user_id")

# the mean is summed in the order of the engine's two parts of a window, as in the decomposition
SQL["cells_rolling"] = f"""
WITH {HOURLY}, {FILLED},
w24 AS (
  SELECT event_type, ts, value, list(value) OVER w AS l, stddev_samp(value) OVER w AS sd,
         (row_number() OVER (PARTITION BY event_type ORDER BY ts) - 1) % 24 + 1 AS e
  FROM filled WINDOW w AS (PARTITION BY event_type ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
)
SELECT event_type, {_ts('ts')}, {_r('value')},
  {_r('CASE WHEN len(l) = 24 THEN (CASE WHEN e = 24 THEN list_reduce(l, lambda a, b: a + b) ELSE list_reduce(list_reverse(l[1:24 - e]), lambda a, b: a + b) + list_reduce(l[24 - e + 1:], lambda a, b: a + b) END) / 24 END', 'rolling_mean')},
  {_r('CASE WHEN len(l) = 24 THEN sd END', 'rolling_std')}
FROM w24
""".replace("event_type", "user_id")

SQL["cells_strengths"] = f"""
WITH {HOURLY}, {FILLED}, {_decomp_sql(24)},
v AS (
  SELECT event_type, period, var_pop(resid) AS r, var_pop(seasonal + resid) AS s, var_pop(trend + resid) AS t FROM dec24 GROUP BY 1, 2
)
SELECT event_type, period, {_r('greatest(0.0, 1 - r / greatest(s, 1e-12))', 'seasonal_strength')},
  {_r('greatest(0.0, 1 - r / greatest(t, 1e-12))', 'trend_strength')}
FROM v
""".replace("event_type", "user_id")

SQL["cells_drop_runs"] = (
    SQL["drop_runs"].replace("event_type", "user_id").replace("rel < -0.4", "rel < -0.6").replace("length >= 2", "length >= 6")
)

# ---------------------------------------------------------------- sinks written and read back
SQL["forecast_store"] = f"""
WITH {BASE_FORECASTS}
SELECT model, event_type, count(*) AS n, {_r('avg(y_pred)', 'mean_pred')} FROM test WHERE model IN ('naive_last', 'naive_weekly') GROUP BY 1, 2
UNION ALL SELECT DISTINCT 'not_run', event_type, 0, CAST(NULL AS DOUBLE) FROM hourly
"""

SQL["metrics_csv"] = f"""
WITH {BASE_FORECASTS},
m AS (SELECT event_type, model, {METRICS} FROM test GROUP BY 1, 2)
SELECT event_type, model, n, {_r('round_even(MAE, 4)', 'MAE')}, {_r('round_even(RMSE, 4)', 'RMSE')} FROM m
"""

SQL["anomalies_csv"] = f"""
SELECT event_type, ts, z FROM ({SQL["residual_outliers"].replace("4.0", "3.0")})
"""

SQL["summary_merge"] = f"""
WITH {HOURLY}
SELECT event_type, CASE WHEN event_type >= 'p' THEN 0 ELSE count(*) END AS n_obs, {_r('sum(value)', 'total')},
       {_r("CASE WHEN event_type >= 'p' THEN max(value) END", 'top')}
FROM hourly GROUP BY event_type
"""

SQL["run_log_csv"] = f"""
WITH {CELLS}
SELECT 'harmonic' AS model, user_id AS square_id, 0.5::DOUBLE AS train_seconds, 480::BIGINT AS train_steps,
       {_r('total', 'predict_seconds_total')}, NULL::DOUBLE AS predict_seconds_per_step_mean, 168::BIGINT AS test_steps
FROM totals
"""

SQL["upsert_replace"] = f"""
WITH {CELLS}
SELECT user_id, {_r('CASE WHEN user_id % 3 = 0 THEN total * 2 ELSE total END', 'total')}, CASE WHEN user_id % 3 = 0 THEN 'new' ELSE 'old' END AS run FROM totals
"""

SQL["top_area_text"] = f"""
WITH {CELLS}
SELECT user_id::VARCHAR AS value FROM totals ORDER BY total DESC, user_id LIMIT 1
"""

SQL["cells_kpss"] = SQL["kpss_fixed_lag"].replace("event_type", "user_id")

SQL["ingest_catalog"] = f"""
WITH {CANON},
days AS (SELECT DISTINCT file_day, dense_rank() OVER (ORDER BY file_day) > 10 AS later FROM lines),
n AS (SELECT later, count(DISTINCT file_day) AS days, count(*) AS rows FROM canon JOIN days USING (file_day) GROUP BY 1)
SELECT CASE WHEN later THEN 2 ELSE 1 END::BIGINT AS version, days AS hashed_days, 0::BIGINT AS removed_files,
  (sum(days) OVER w)::BIGINT AS n_partitions, (sum(rows) OVER w)::BIGINT AS total_rows, 0::BIGINT AS wrong_files
FROM n WINDOW w AS (ORDER BY later)
"""

SQL["long_rolling"] = SQL["rolling_stats"]
SQL["long_interpolate"] = SQL["interpolate"]
SQL["long_forecasts"] = SQL["forecast_seasonal"]
SQL["long_drop_runs"] = SQL["drop_runs"]
SQL["step_last"] = SQL["forecast_last"]
SQL["step_seasonal"] = SQL["forecast_seasonal"]


def _lag_search_sql() -> str:
    """Least squares and ridge over masked lag sets by Gauss-Jordan steps, judged on the validation rows."""
    lags = [1, 2, 3, 24, 168]
    k = len(lags) + 1
    candidates = [("last", 1, 0.0), ("recent", 3, 0.0), ("daily", 4, 0.0), ("weekly", 5, 0.0), ("weekly_ridge", 5, 0.1), ("weekly_strong", 5, 1.0)]
    values = ", ".join(f"({c}, '{label}', {[int(i <= n) for i in range(k)]}, {n + 1}, {pen})" for c, (label, n, pen) in enumerate(candidates))
    train = "ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-20 23:00:00'"
    return f"""
sc AS (
  SELECT event_type, avg(value) AS mu, CASE WHEN stddev_pop(value) < 1e-9 THEN 1.0 ELSE stddev_pop(value) END AS sd
  FROM hourly WHERE {train} AND value IS NOT NULL GROUP BY 1
),
zs AS (SELECT h.event_type, h.ts, h.value, mu, sd, (h.value - mu) / sd AS z FROM hourly h LEFT JOIN sc USING (event_type)),
fr AS (
  SELECT *, lag(value, 1) OVER w AS last_, [1.0::DOUBLE, {', '.join(f'lag(z, {n}) OVER w' for n in lags)}] AS x,
         {' AND '.join(f'lag(z, {n}) OVER w IS NOT NULL' for n in lags)} AS full_
  FROM zs WINDOW w AS (PARTITION BY event_type ORDER BY ts)
),
rows_ AS (
  SELECT event_type, sd, CASE WHEN {train} THEN 'train' ELSE 'val' END AS part, list_append(x, z) AS v
  FROM fr WHERE full_ AND z IS NOT NULL AND ({train} OR ts BETWEEN {VAL_WINDOW})
),
cells AS (SELECT event_type, part, i, j, sum(v[i] * v[j]) AS g FROM rows_, range(1, {k + 2}) a(i), range(1, {k + 2}) b(j) GROUP BY 1, 2, 3, 4),
counts AS (SELECT event_type, count(*) FILTER (WHERE part = 'train') AS n_train, count(*) FILTER (WHERE part = 'val') AS n_val, max(sd) AS sd FROM rows_ GROUP BY 1),
cand(c, label, mask, terms, pen) AS (VALUES {values}),
lines_ AS (
  SELECT event_type, c, i, list(CASE WHEN j > {k} THEN g * mask[i] ELSE g * mask[i] * mask[j]
      + CASE WHEN i = j AND mask[i] = 0 THEN 1 WHEN i = j AND i > 1 THEN pen * n_train ELSE 0 END END ORDER BY j) AS line
  FROM cells JOIN counts USING (event_type), cand WHERE part = 'train' AND i <= {k} AND n_train >= {4} * terms GROUP BY 1, 2, 3
),
solve(event_type, c, s, m) AS (
  SELECT event_type, c, 0::BIGINT, list(line ORDER BY i) FROM lines_ GROUP BY 1, 2
  UNION ALL
  SELECT event_type, c, s + 1, list_transform(m, lambda r, i: CASE WHEN i = s + 1 THEN p
      ELSE list_transform(r, lambda v, j: v - r[s + 1] * p[j]) END)
  FROM (SELECT event_type, c, s, m, list_transform(m[s + 1], lambda v: v / m[s + 1][s + 1]) AS p FROM solve WHERE s < {k})
),
coef AS (SELECT event_type, c, list_transform(m, lambda r: r[{k + 1}]) AS beta FROM solve WHERE s = {k}),
sse AS (
  SELECT event_type, c, sum(g * list_append(beta, -1.0)[i] * list_append(beta, -1.0)[j]) AS e
  FROM cells JOIN coef USING (event_type) WHERE part = 'val' GROUP BY 1, 2
),
found AS (
  SELECT n.event_type, label, c, n_train, n_val, sqrt(greatest(e, 0.0) / n_val) * sd AS val_RMSE
  FROM counts n CROSS JOIN cand LEFT JOIN sse USING (event_type, c)
),
ranked AS (
  SELECT *, val_RMSE IS NOT NULL AND row_number() OVER (PARTITION BY event_type ORDER BY val_RMSE NULLS LAST, c) = 1 AS chosen FROM found
)"""


SQL["lag_search"] = f"""
WITH RECURSIVE {HOURLY}, {_lag_search_sql()}
SELECT event_type, label, n_train, n_val, {_r('val_RMSE')}, chosen FROM ranked
"""

SQL["lag_search_metrics"] = f"""
WITH RECURSIVE {HOURLY}, {_lag_search_sql()},
test AS (
  SELECT 'lag_search' AS model, f.event_type, f.ts, value AS y_true,
         coalesce(CASE WHEN full_ THEN list_dot_product(x, beta) * sd + mu END, last_) AS y_pred
  FROM fr f LEFT JOIN (SELECT r.event_type, beta FROM ranked r JOIN coef USING (event_type, c) WHERE chosen) b ON b.event_type = f.event_type
  WHERE f.ts BETWEEN {TEST_WINDOW}
),
m AS (SELECT event_type, model, {METRICS} FROM test GROUP BY 1, 2)
SELECT event_type, model, n, {_r('MAE')}, {_r('RMSE')}, {_r('MAPE_percent')}, {_r('sMAPE_percent')} FROM m
"""

# ---------------------------------------------------------------- streams out of order, compacted tables, sequence batches
SQL["stream_ordered_error"] = SQL["stream_online_error"]

SQL["stream_compacted_bins"] = f"""
SELECT event_type, {_ts("date_trunc('hour', ts)", 'ts')}, {_r('sum(value)', 'value')}, event_id % 20 = 3 AND ts < TIMESTAMP '2024-01-10 00:00:00' AS late
FROM events WHERE value IS NOT NULL GROUP BY event_type, date_trunc('hour', ts), late
"""

SQL["sequence_scores"] = f"""
WITH {HOURLY},
sc AS (
  SELECT event_type, avg(value) AS scale_mean,
         CASE WHEN stddev_pop(value) < 1e-9 THEN 1.0 ELSE stddev_pop(value) END AS scale_std
  FROM hourly WHERE value IS NOT NULL AND ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-20 23:00:00'
  GROUP BY 1
),
c AS (
  SELECT h.event_type, h.ts, (h.value - sc.scale_mean) / sc.scale_std AS z,
         row_number() OVER (PARTITION BY h.event_type ORDER BY h.ts) AS rn,
         CASE WHEN isodow(h.ts) >= 6 THEN 1.0 ELSE 0.0 END AS weekend
  FROM hourly h JOIN sc ON sc.event_type = h.event_type
),
g AS (
  SELECT t.event_type, t.ts, arg_min(s.z, s.rn) AS oldest, arg_max(s.z, s.rn) AS newest, avg(s.z) AS mean_z, max(s.z) AS max_z,
         sum(s.z * (s.rn - t.rn + 25)) / 300.0 AS weighted, sum(s.weekend) AS weekend
  FROM c t JOIN c s ON s.event_type = t.event_type AND s.rn BETWEEN t.rn - 24 AND t.rn - 1
  WHERE t.rn > 24 GROUP BY 1, 2
)
SELECT event_type, {_ts('ts')}, {_r('oldest')}, {_r('newest')}, {_r('mean_z')}, {_r('max_z')}, {_r('weighted')}, {_r('weekend')} FROM g
"""

# ---------------------------------------------------------------- trained, named and evaluated models; the store's order; the canonical cast
SQL["trained_metrics"] = SQL["harmonic_metrics"]
SQL["named_forecasts"] = f"""
WITH {BASE_FORECASTS}
SELECT model, event_type, {_ts('ts')}, {_r('y_true')}, {_r('y_pred')} FROM test
"""
SQL["evaluated_run"] = SQL["leaderboard"]
SQL["store_order"] = f"""
WITH {CANON}
SELECT strftime(file_day, '%Y-%m-%d') AS day, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM canon GROUP BY 1
"""
SQL["canonical_cast"] = f"""
SELECT CAST(user_id AS BIGINT) AS square_id, {_ts('ts')}, {_r('CAST(CAST(value AS FLOAT) AS DOUBLE)', 'internet')} FROM events
"""
