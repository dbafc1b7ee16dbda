"""DuckDB SQL twins of the registered queries (same column names, same rounding formula).

Tables ``events lineitem orders customer`` are views over the benchmark parquet files.
``R6``/``R4`` round with ties-to-even on the scaled value, like ``rint`` on the Spark side.
"""

from __future__ import annotations

from headroom.plans.catalog import FALLBACK_MIN_POINTS, QUERIES
from headroom.operators.narrative import ACTION_SENTENCE, HORIZON_PHRASE, NO_ACTION_SENTENCE, PROMPT_TEMPLATE


def r(x: str, d: int) -> str:
    return f"(round_even(({x}) * 1e{d}, 0) / 1e{d})"


def r6(x: str) -> str:
    return r(x, 6)


def r4(x: str) -> str:
    return r(x, 4)


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def clip(x: str, lo: str | None, hi: str | None) -> str:
    parts = [f"WHEN {x} IS NULL OR isnan({x}) THEN {x}"]
    if lo is not None:
        parts.append(f"WHEN {x} < {lo} THEN {lo}")
    if hi is not None:
        parts.append(f"WHEN {x} > {hi} THEN {hi}")
    return f"(CASE {' '.join(parts)} ELSE {x} END)"


def pdiv(n: str, d: str) -> str:
    return (f"(CASE WHEN {n} IS NULL OR {d} IS NULL THEN NULL WHEN {d} = 0 THEN "
            f"(CASE WHEN {n} > 0 THEN 'inf'::DOUBLE WHEN {n} < 0 THEN '-inf'::DOUBLE ELSE NULL END) "
            f"ELSE {n}::DOUBLE / {d} END)")


def sigma(syy: str, sxy: str, sxx: str, n: str) -> str:
    left = f"({syy} - {sxy} * {sxy} / {sxx})"
    return f"CASE WHEN {left} <= 1e-13 * {syy} THEN 0.0::DOUBLE ELSE sqrt({left} / {n}) END"


def by_group(k: str, values: list[str]) -> str:
    return "(CASE " + " ".join(f"WHEN {k} = {i} THEN {v}" for i, v in enumerate(values)) + " END)"


# ---- raw tables --------------------------------------------------------------------------
_CPU = by_group("user_id % 5", ["value / 0.977::DOUBLE * 0.2::DOUBLE", "value / 0.977::DOUBLE * 0.4::DOUBLE", "40.0::DOUBLE + value / 0.977::DOUBLE * 0.2::DOUBLE",
                                "85.0::DOUBLE + value / 0.977::DOUBLE * 0.2::DOUBLE", "value / 0.977::DOUBLE * 3.0::DOUBLE - 20.0::DOUBLE"])
RAW_COMPUTE = f"""
raw_compute AS (
  SELECT date_trunc('hour', ts) AS "timestamp",
         'cluster-' || CAST(user_id AS VARCHAR) AS cluster_id,
         cpu AS cpu_utilization_pct, cpu * 0.9::DOUBLE AS memory_utilization_pct, cpu AS cluster_utilization_pct,
         event_id AS seq
  FROM (SELECT *, {_CPU} AS cpu FROM events)
)"""

_BASE = by_group("k", [f"{b}::DOUBLE" for b in ("0.46", "0.11", "0.30", "0.215", "0.49")])
_SLOPE = by_group("k", [f"{s}::DOUBLE" for s in ("0.50", "0.75", "0.05", "0.50", "0.30")])
RAW_STORAGE = f"""
raw_storage AS (
  SELECT l_shipdate AS "timestamp",
         'storage-' || CAST(l_suppkey AS VARCHAR) AS storage_id,
         used AS disk_used_gb, 1000.0::DOUBLE AS disk_total_gb, used / 1000.0::DOUBLE * 100.0::DOUBLE AS disk_utilization_pct,
         l_discount * 1000.0::DOUBLE + l_tax * 500.0::DOUBLE AS io_utilization_pct,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM (SELECT *, 1000.0::DOUBLE * ({_BASE} + {_SLOPE} * d / 2500) + l_quantity AS used
        FROM (SELECT *, l_suppkey % 5 AS k,
                     datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS d
              FROM lineitem))
)"""

RAW_NETWORK = """
raw_network AS (
  SELECT o_orderdate AS "timestamp", 'link-' || CAST(o_custkey // 10 AS VARCHAR) AS link_id, 500.0::DOUBLE AS bandwidth_mbps,
         o_totalprice / 977.0::DOUBLE AS throughput_mbps, c_acctbal AS latency_ms, o_orderkey AS seq
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
)"""

# ---- cleaning ----------------------------------------------------------------------------
CLEAN_COMPUTE = f"""
clean_compute AS (
  SELECT "timestamp", cluster_id,
         {clip('cpu_utilization_pct', '0.0', '100.0')} AS cpu_utilization_pct,
         {clip('memory_utilization_pct', '0.0', '100.0')} AS memory_utilization_pct,
         {clip('cluster_utilization_pct', '0.0', '100.0')} AS cluster_utilization_pct
  FROM (SELECT * FROM raw_compute
        QUALIFY row_number() OVER (PARTITION BY "timestamp", cluster_id ORDER BY seq) = 1)
  WHERE cpu_utilization_pct IS NOT NULL AND memory_utilization_pct IS NOT NULL
)"""

CLEAN_STORAGE = f"""
clean_storage AS (
  SELECT "timestamp", storage_id, disk_used_gb, disk_total_gb,
         round_even({pdiv('disk_used_gb', 'disk_total_gb')} * 100.0::DOUBLE * 100.0::DOUBLE, 0) / 100.0::DOUBLE
           AS disk_utilization_pct,
         {clip('io_utilization_pct', '0.0', '100.0')} AS io_utilization_pct
  FROM (SELECT * FROM raw_storage
        QUALIFY row_number() OVER (PARTITION BY "timestamp", storage_id
                                   ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                                            l_extendedprice) = 1)
  WHERE disk_used_gb IS NOT NULL AND disk_total_gb IS NOT NULL AND disk_used_gb <= disk_total_gb
)"""

CLEAN_NETWORK = f"""
clean_network AS (
  SELECT "timestamp", link_id, bandwidth_mbps, {clip('throughput_mbps', '0.0', None)} AS throughput_mbps, latency_ms
  FROM (SELECT * FROM raw_network
        QUALIFY row_number() OVER (PARTITION BY "timestamp", link_id ORDER BY seq) = 1)
  WHERE throughput_mbps IS NOT NULL AND latency_ms IS NOT NULL AND latency_ms >= 0
)"""

# ---- daily + trends ----------------------------------------------------------------------
KIND = {
    "compute": ("cluster_id", ["cpu_utilization_pct", "memory_utilization_pct", "cluster_utilization_pct"],
                "cluster_utilization_pct"),
    "storage": ("storage_id", ["disk_used_gb", "disk_total_gb", "disk_utilization_pct", "io_utilization_pct"],
                "disk_utilization_pct"),
    "network": ("link_id", ["bandwidth_mbps", "throughput_mbps", "latency_ms"], "throughput_mbps"),
}


def daily_cte(kind: str) -> str:
    idc, cols, _ = KIND[kind]
    aggs = ", ".join(f"avg({c}) AS {c}" for c in cols)
    return f"""
daily_{kind} AS (
  SELECT {idc}, CAST("timestamp" AS DATE) AS date, {aggs}
  FROM clean_{kind} WHERE {idc} IS NOT NULL AND "timestamp" IS NOT NULL
  GROUP BY {idc}, CAST("timestamp" AS DATE)
)"""


def trends_cte(kind: str) -> str:
    idc, cols, v = KIND[kind]
    w = f"PARTITION BY {idc} ORDER BY date"
    return f"""
trends_{kind} AS (
  SELECT *, CASE WHEN _cur IS NULL OR _prev IS NULL THEN 0.0::DOUBLE
                 WHEN _prev = 0 THEN (CASE WHEN _cur = 0 THEN 0.0::DOUBLE WHEN _cur > 0 THEN 'inf'::DOUBLE
                                           ELSE '-inf'::DOUBLE END)
                 ELSE _cur / _prev - 1.0::DOUBLE END AS {v}_growth_rate
  FROM (SELECT *,
          avg({v}) OVER ({w} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS {v}_ma7,
          avg({v}) OVER ({w} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS {v}_ma30,
          last_value({v} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _cur,
          last_value({v} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _prev
        FROM daily_{kind})
)"""


RAW = {"compute": RAW_COMPUTE, "storage": RAW_STORAGE, "network": RAW_NETWORK}
CLEAN = {"compute": CLEAN_COMPUTE, "storage": CLEAN_STORAGE, "network": CLEAN_NETWORK}


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def upto_trends(*kinds: str) -> list[str]:
    out = []
    for k in kinds:
        out += [RAW[k], CLEAN[k], daily_cte(k), trends_cte(k)]
    return out


ALL = ("compute", "storage", "network")

SERIES = """
series AS (
  SELECT *, row_number() OVER (PARTITION BY resource_type, resource_id ORDER BY ds) - 1 AS t
  FROM (SELECT 'compute' AS resource_type, cluster_id AS resource_id, date AS ds,
               cluster_utilization_pct::DOUBLE AS y FROM trends_compute WHERE cluster_id IS NOT NULL
        UNION ALL
        SELECT 'storage', storage_id, date, disk_utilization_pct::DOUBLE FROM trends_storage
        WHERE storage_id IS NOT NULL
        UNION ALL
        SELECT 'network', link_id, date, throughput_mbps::DOUBLE FROM trends_network WHERE link_id IS NOT NULL)
)"""

LINEAR_FIT = """
linear_fit AS (
  SELECT *, """ + sigma('_syy', '_sxy', '_sxx', 'n') + """ AS sigma,
         CASE WHEN n < 2 THEN 'too_few_points' WHEN n_y < n THEN 'missing_y' ELSE 'ok' END AS status
  FROM (SELECT resource_type, resource_id, count(*) AS n, count(y) AS n_y,
               regr_intercept(y, t) AS intercept, regr_slope(y, t) AS slope,
               regr_syy(y, t) AS _syy, regr_sxy(y, t) AS _sxy, regr_sxx(y, t) AS _sxx,
               max(t) AS max_t, max(ds) AS max_ds
        FROM {src} GROUP BY resource_type, resource_id)
)"""

HORIZONS = "(SELECT unnest([4, 12]) AS horizon_weeks)"

LINEAR_FORECAST = f"""
linear_forecast AS (
  SELECT resource_type, resource_id, 'linear_regression' AS model, 'linear_regression' AS model_used,
         h.horizon_weeks, step, ds, yhat, yhat - 1.96 * sigma AS yhat_lower, yhat + 1.96 * sigma AS yhat_upper
  FROM (SELECT resource_type, resource_id, sigma, step, CAST(max_ds + CAST(step AS INTEGER) AS DATE) AS ds,
               intercept + slope * (max_t + step) AS yhat
        FROM (SELECT *, unnest(generate_series(1, 84)) AS step FROM linear_fit WHERE status = 'ok')) f
  JOIN {HORIZONS} h ON f.step <= h.horizon_weeks * 7
)"""


def seasonal_ctes(src: str) -> str:
    k = "resource_type, resource_id"
    return f"""
s1 AS (
  SELECT *, y - (_a + _b * t) AS _r FROM (
    SELECT *, count(*) OVER (PARTITION BY {k}) AS _n, count(y) OVER (PARTITION BY {k}) AS _n_y,
           regr_intercept(y, t) OVER (PARTITION BY {k}) AS _a, regr_slope(y, t) OVER (PARTITION BY {k}) AS _b,
           regr_syy(y, t) OVER (PARTITION BY {k}) AS _syy, regr_sxy(y, t) OVER (PARTITION BY {k}) AS _sxy,
           regr_sxx(y, t) OVER (PARTITION BY {k}) AS _sxx,
           dayofweek(ds) + 1 AS _dow, month(ds) AS _mon
    FROM {src})
),
s2 AS (SELECT *, _r - _sw AS _r2 FROM (SELECT *, avg(_r) OVER (PARTITION BY {k}, _dow) AS _sw FROM s1)),
s3 AS (
  SELECT *, _r2 - _sm AS _e FROM (
    SELECT *, CASE WHEN _n >= 365 THEN avg(_r2) OVER (PARTITION BY {k}, _mon) ELSE 0.0 END AS _sm FROM s2)
),
sfit AS (
  SELECT *,
    CASE WHEN n_y >= 2 THEN 'seasonal' WHEN n >= 2 AND n_y = n THEN 'linear_regression' END AS model_used,
    CASE WHEN n_y >= 2 THEN _sigma_e ELSE _sigma_lin END AS sigma,
    CASE WHEN n < 2 THEN 'too_few_points' WHEN n_y >= 2 THEN 'ok' WHEN n >= 2 AND n_y = n THEN 'fallback_linear'
         ELSE 'missing_y' END AS status
  FROM (SELECT {k}, max(_n) AS n, max(_n_y) AS n_y, max(_a) AS intercept, max(_b) AS slope, max(t) AS max_t,
               max(ds) AS max_ds, stddev_pop(_e) AS _sigma_e,
               {sigma('max(_syy)', 'max(_sxy)', 'max(_sxx)', 'max(_n)')} AS _sigma_lin
        FROM s3 GROUP BY {k})
),
weekday_eff AS (SELECT DISTINCT {k}, _dow, _sw FROM s3),
month_eff AS (SELECT DISTINCT {k}, _mon, _sm FROM s3)"""


SEASONAL_FORECAST = f"""
seasonal_forecast AS (
  SELECT f.resource_type, f.resource_id, 'seasonal' AS model, f.model_used, h.horizon_weeks, f.step, f.ds,
         f.yhat, f.yhat - 1.96 * f.sigma AS yhat_lower, f.yhat + 1.96 * f.sigma AS yhat_upper
  FROM (SELECT g.*, CASE WHEN g.model_used = 'seasonal'
                         THEN g.intercept + g.slope * (g.max_t + g.step) + coalesce(w._sw, 0.0) + coalesce(m._sm, 0.0)
                         ELSE g.intercept + g.slope * (g.max_t + g.step) END AS yhat
        FROM (SELECT *, CAST(max_ds + CAST(step AS INTEGER) AS DATE) AS ds FROM
                (SELECT *, unnest(generate_series(1, 84)) AS step FROM sfit WHERE model_used IS NOT NULL)) g
        LEFT JOIN weekday_eff w ON w.resource_type = g.resource_type AND w.resource_id = g.resource_id
                               AND w._dow = dayofweek(g.ds) + 1
        LEFT JOIN month_eff m ON m.resource_type = g.resource_type AND m.resource_id = g.resource_id
                             AND m._mon = month(g.ds)) f
  JOIN {HORIZONS} h ON f.step <= h.horizon_weeks * 7
)"""


def forecast_select(name: str) -> str:
    return (f"SELECT resource_type, resource_id, model, model_used, CAST(horizon_weeks AS BIGINT) AS horizon_weeks, "
            f"CAST(step AS BIGINT) AS step, ds, {r4('yhat')} AS yhat, {r4('yhat_lower')} AS yhat_lower, "
            f"{r4('yhat_upper')} AS yhat_upper FROM {name}")


STORAGE_SERIES = """
storage_series AS (
  SELECT 'storage' AS resource_type, storage_id AS resource_id, date AS ds, disk_utilization_pct::DOUBLE AS y,
         row_number() OVER (PARTITION BY storage_id ORDER BY date) - 1 AS t
  FROM trends_storage WHERE storage_id IS NOT NULL
)"""

PEAKS = """
current_storage AS (
  SELECT storage_id AS resource_id, arg_max(disk_utilization_pct, date) AS current_value
  FROM trends_storage WHERE storage_id IS NOT NULL GROUP BY storage_id
),
peaks AS (
  SELECT resource_id, max(yhat) FILTER (WHERE horizon_weeks = 4) AS peak_4,
         max(yhat) FILTER (WHERE horizon_weeks = 12) AS peak_12
  FROM linear_forecast WHERE model = 'linear_regression' AND resource_type = 'storage' GROUP BY resource_id
),
joined AS (SELECT c.resource_id, c.current_value, p.peak_4, p.peak_12 FROM current_storage c
           LEFT JOIN peaks p ON c.resource_id = p.resource_id)"""


def _risk(p: str) -> str:
    return f"CASE WHEN {p} >= 90.0 THEN 'critical' WHEN {p} >= 75.0 THEN 'warning' END"


def _thr(p: str) -> str:
    return f"CASE WHEN {p} >= 90.0 THEN 90.0::DOUBLE WHEN {p} >= 75.0 THEN 75.0::DOUBLE END"


REC_STORAGE = f"""
cand AS (
  SELECT resource_id, current_value, 4 AS h, peak_4 AS peak, {_risk('peak_4')} AS risk, {_thr('peak_4')} AS thr
  FROM joined
  UNION ALL
  SELECT resource_id, current_value, 12, peak_12, {_risk('peak_12')}, {_thr('peak_12')}
  FROM joined WHERE NOT coalesce(peak_4 >= 90.0, false)
),
found AS (SELECT * FROM cand WHERE risk IS NOT NULL),
rec_storage AS (
  SELECT resource_id, 'storage' AS resource_type, 'increase_storage_capacity' AS recommendation_type,
         risk AS risk_level, current_value, peak AS forecasted_value, h AS forecast_horizon_weeks,
         'threshold' AS detail_key, thr AS detail_value
  FROM found
  UNION ALL
  SELECT resource_id, 'storage', 'no_action', 'info', current_value, current_value, 0, NULL, NULL
  FROM joined WHERE resource_id NOT IN (SELECT resource_id FROM found)
)"""

REC_COMPUTE = """
cg AS (
  SELECT cluster_id AS resource_id, avg(cluster_utilization_pct) AS a,
         count(*) FILTER (WHERE cluster_utilization_pct < 30.0) AS below
  FROM trends_compute WHERE cluster_id IS NOT NULL GROUP BY cluster_id
),
rec_compute AS (
  SELECT resource_id, 'compute' AS resource_type,
         CASE WHEN below >= 21 THEN (CASE WHEN a < 15.0 THEN 'decommission_orphaned_infrastructure'
                                          ELSE 'downsize_underutilized_compute' END)
              WHEN a >= 85.0 THEN 'enable_temporary_autoscaling' ELSE 'no_action' END AS recommendation_type,
         CASE WHEN below >= 21 THEN 'warning' WHEN a >= 85.0 THEN 'critical' ELSE 'info' END AS risk_level,
         a AS current_value, a AS forecasted_value, 0 AS forecast_horizon_weeks,
         CASE WHEN below >= 21 THEN 'days_below_threshold' END AS detail_key,
         CASE WHEN below >= 21 THEN below::DOUBLE END AS detail_value
  FROM cg
)"""


def rec_network(bandwidth: str | None) -> str:
    peak = "max(throughput_mbps) OVER (PARTITION BY link_id)" if bandwidth is None else bandwidth
    return f"""
np AS (
  SELECT link_id, {pdiv('throughput_mbps', peak)} * 100.0::DOUBLE AS pct
  FROM trends_network WHERE link_id IS NOT NULL
),
ng AS (
  SELECT link_id AS resource_id, count(*) FILTER (WHERE pct >= 85.0) AS spike_days, avg(pct) AS a, max(pct) AS mx
  FROM np GROUP BY link_id
),
rec_network AS (
  SELECT resource_id, 'network' AS resource_type,
         CASE WHEN spike_days >= 2 THEN 'enable_temporary_autoscaling' ELSE 'no_action' END AS recommendation_type,
         CASE WHEN spike_days >= 2 THEN 'warning' ELSE 'info' END AS risk_level,
         a AS current_value, CASE WHEN spike_days >= 2 THEN mx ELSE a END AS forecasted_value,
         0 AS forecast_horizon_weeks,
         CASE WHEN spike_days >= 2 THEN 'spike_days' END AS detail_key,
         CASE WHEN spike_days >= 2 THEN spike_days::DOUBLE END AS detail_value
  FROM ng
)"""


def flat_select(name: str, extra: str = "") -> str:
    return (f"SELECT {extra}resource_id, resource_type, recommendation_type, risk_level, "
            f"{r4('current_value')} AS current_value, {r4('forecasted_value')} AS forecasted_value, "
            f"CAST(forecast_horizon_weeks AS BIGINT) AS forecast_horizon_weeks, detail_key, detail_value FROM {name}")


def _fmt1(x: str) -> str:
    return f"coalesce(printf('%.1f', {x}), 'nan')"


NARRATIVE = (
    f"CASE WHEN recommendation_type = 'no_action' THEN printf('{NO_ACTION_SENTENCE}', resource_id, "
    f"{_fmt1('current_value')}) "
    f"ELSE printf('{ACTION_SENTENCE}', resource_id, {_fmt1('forecasted_value')}, "
    "CASE WHEN forecast_horizon_weeks IS NOT NULL AND forecast_horizon_weeks <> 0 "
    f"THEN printf('{HORIZON_PHRASE}', CAST(forecast_horizon_weeks AS VARCHAR)) ELSE '' END, risk_level, "
    "replace(recommendation_type, '_', ' ')) END"
)

ALL_RECS_CTES = (upto_trends(*ALL) + [SERIES, LINEAR_FIT.format(src="(SELECT * FROM series WHERE resource_type = 'storage')"),
                                      LINEAR_FORECAST, PEAKS, REC_STORAGE, REC_COMPUTE, rec_network(None),
                                      """
recs AS (SELECT * FROM rec_storage UNION ALL SELECT * FROM rec_compute UNION ALL SELECT * FROM rec_network)"""])

_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"

RESPONSES = """
responses AS (
  SELECT resource_type, resource_id, forecast_horizon_weeks,
         CASE WHEN risk_level = 'critical'
              THEN '{"candidates":[{"content":{"parts":[{"text":"  ' || resource_id || ' needs attention: '
                   || recommendation_type || '.\\n"}]}}]}'
              WHEN risk_level = 'warning' THEN '{"candidates": ['
              ELSE '{"candidates":[{"content":{"parts":[{"text":"   "}]}}]}' END AS response
  FROM recs
)"""


def _prompt_sql() -> str:
    tpl = PROMPT_TEMPLATE.replace("'", "''").replace("\n", "' || chr(10) || '")
    details = ("CASE WHEN detail_key IS NULL THEN '{}' ELSE '{\"' || detail_key || '\":' || "
               "CAST(detail_value AS VARCHAR) || '}' END")
    return (f"printf('{tpl}', resource_id, resource_type, recommendation_type, risk_level, "
            f"CAST(CAST(printf('%.2f', current_value) AS DOUBLE) AS VARCHAR), "
            f"CAST(CAST(printf('%.2f', forecasted_value) AS DOUBLE) AS VARCHAR), "
            f"CAST(forecast_horizon_weeks AS VARCHAR), {details})")


def _closed_days() -> str:
    idc, cols, _ = KIND["compute"]
    aggs = ", ".join(f"{r6(f'avg({c})')} AS {c}" for c in cols)
    return (with_ctes(RAW_COMPUTE, CLEAN_COMPUTE) +
            f" SELECT cluster_id, CAST(\"timestamp\" AS DATE) AS date, {aggs} FROM clean_compute "
            f"WHERE cluster_id IS NOT NULL AND CAST(CAST(\"timestamp\" AS DATE) AS TIMESTAMP) + INTERVAL 2 DAY <= "
            f"(SELECT max(\"timestamp\") FROM raw_compute) GROUP BY cluster_id, CAST(\"timestamp\" AS DATE)")


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["dq_violations"] = (
        with_ctes(RAW_COMPUTE, RAW_STORAGE, RAW_NETWORK) +
        " SELECT 'compute' AS table_name, 'cpu_out_of_bounds' AS rule, count(*) FILTER (WHERE cpu_utilization_pct < 0 "
        "OR cpu_utilization_pct > 100) AS violations FROM raw_compute UNION ALL "
        "SELECT 'storage', 'used_exceeds_total', count(*) FILTER (WHERE disk_used_gb > disk_total_gb) FROM raw_storage "
        "UNION ALL SELECT 'network', 'negative_latency', count(*) FILTER (WHERE latency_ms < 0) FROM raw_network")
    cc = ", ".join(f"{r6(c)} AS {c}" for c in KIND["compute"][1])
    q["dedupe_first"] = (with_ctes(RAW_COMPUTE) +
                         f" SELECT {ts_text('timestamp')} AS \"timestamp\", cluster_id, seq, {cc} FROM raw_compute "
                         "QUALIFY row_number() OVER (PARTITION BY \"timestamp\", cluster_id ORDER BY seq) = 1")
    values = {"compute": ["cpu_utilization_pct", "memory_utilization_pct", "cluster_utilization_pct"],
              "storage": ["disk_used_gb", "disk_total_gb", "disk_utilization_pct", "io_utilization_pct"],
              "network": ["bandwidth_mbps", "throughput_mbps", "latency_ms"]}
    for k in ALL:
        idc, cols, v = KIND[k]
        vals = ", ".join(f"{r6(c)} AS {c}" for c in values[k])
        q[f"clean_{k}"] = with_ctes(RAW[k], CLEAN[k]) + f" SELECT {ts_text('timestamp')} AS \"timestamp\", {idc}, {vals} FROM clean_{k}"
        d = ", ".join(f"{r6(c)} AS {c}" for c in cols)
        q[f"daily_{k}"] = with_ctes(RAW[k], CLEAN[k], daily_cte(k)) + f" SELECT {idc}, date, {d} FROM daily_{k}"
        tcols = cols + [f"{v}_ma7", f"{v}_ma30", f"{v}_growth_rate"]
        t = ", ".join(f"{r6(c)} AS {c}" for c in tcols)
        q[f"trends_{k}"] = with_ctes(*upto_trends(k)) + f" SELECT {idc}, date, {t} FROM trends_{k}"
    series_ctes = upto_trends(*ALL) + [SERIES]
    q["series_index"] = with_ctes(*series_ctes) + f" SELECT resource_type, resource_id, ds, {r6('y')} AS y, t FROM series"
    q["resource_counts"] = (with_ctes(*series_ctes) +
                            " SELECT resource_type, count(DISTINCT resource_id) AS n_resources FROM series GROUP BY 1")
    q["linear_fit"] = (with_ctes(*series_ctes, LINEAR_FIT.format(src="series")) +
                       f" SELECT resource_type, resource_id, n, n_y, {r4('intercept')} AS intercept, {r6('slope')} AS slope,"
                       f" {r4('sigma')} AS sigma, max_t, max_ds, status FROM linear_fit")
    q["linear_forecast"] = with_ctes(*series_ctes, LINEAR_FIT.format(src="series"), LINEAR_FORECAST) + " " + \
        forecast_select("linear_forecast")
    # The prophet slot is the linear forecast (the source's fallback where Prophet is missing).
    q["prophet_forecast"] = (with_ctes(*series_ctes, LINEAR_FIT.format(src="series"), LINEAR_FORECAST) + " " +
                             forecast_select("(SELECT * REPLACE ('prophet' AS model) FROM linear_forecast)"))
    q["seasonal_forecast"] = with_ctes(*series_ctes, seasonal_ctes("series"), SEASONAL_FORECAST) + " " + \
        forecast_select("seasonal_forecast")
    q["forecast_all"] = (with_ctes(*series_ctes, LINEAR_FIT.format(src="series"), LINEAR_FORECAST,
                                   seasonal_ctes("series"), SEASONAL_FORECAST) + " " +
                         forecast_select("linear_forecast") + " UNION ALL " + forecast_select("seasonal_forecast"))
    holed = ("(SELECT resource_type, resource_id, ds, CASE WHEN resource_id LIKE 'cluster-%3' AND dayofmonth(ds) = 15 "
             "THEN NULL ELSE y END AS y, t FROM series)")
    for name, src in (("forecast_status", holed), ("forecast_status_series", "series")):
        q[name] = (with_ctes(*series_ctes, LINEAR_FIT.format(src=src), seasonal_ctes(src)) +
                   " SELECT resource_type, resource_id, 'linear_regression' AS model, status, n, n_y "
                   "FROM linear_fit UNION ALL SELECT resource_type, resource_id, 'seasonal', status, n, n_y FROM sfit")
    train = ("(SELECT resource_type, resource_id, ds, y, t FROM (SELECT *, max(ds) OVER (PARTITION BY resource_type, "
             "resource_id) - INTERVAL 28 DAY AS _cut FROM series) WHERE ds <= _cut)")
    hold = ("(SELECT resource_type, resource_id, ds, y FROM (SELECT *, max(ds) OVER (PARTITION BY resource_type, "
            "resource_id) - INTERVAL 28 DAY AS _cut FROM series) WHERE ds > _cut AND y IS NOT NULL)")
    q["select_model"] = (
        with_ctes(*series_ctes, LINEAR_FIT.format(src=train), LINEAR_FORECAST, seasonal_ctes(train), SEASONAL_FORECAST,
                  f"""
fc AS (SELECT resource_type, resource_id, model, ds, yhat FROM linear_forecast WHERE horizon_weeks = 4
       UNION ALL SELECT resource_type, resource_id, model, ds, yhat FROM seasonal_forecast WHERE horizon_weeks = 4),
err AS (SELECT f.resource_type, f.resource_id, f.model, avg(abs(f.yhat - h.y)) AS mae, count(*) AS n_holdout
        FROM fc f JOIN {hold} h ON f.resource_type = h.resource_type AND f.resource_id = h.resource_id
        AND f.ds = h.ds GROUP BY 1, 2, 3)""") +
        f" SELECT resource_type, resource_id, model, {r4('mae')} AS mae, n_holdout, "
        "model = first(model ORDER BY round_even(mae * 1e9, 0) / 1e9, model) OVER (PARTITION BY resource_type, resource_id) AS selected FROM err")
    st = upto_trends("storage") + [STORAGE_SERIES, LINEAR_FIT.format(src="storage_series"), LINEAR_FORECAST, PEAKS]
    q["horizon_peaks"] = (with_ctes(*st) + f" SELECT resource_id, {r4('current_value')} AS current_value, "
                          f"{r4('peak_4')} AS peak_4, {r4('peak_12')} AS peak_12 FROM joined")
    q["recommend_storage"] = with_ctes(*st, REC_STORAGE) + " " + flat_select("rec_storage")
    q["recommend_compute"] = with_ctes(*upto_trends("compute"), REC_COMPUTE) + " " + flat_select("rec_compute")
    q["recommend_network"] = with_ctes(*upto_trends("network"), rec_network(None)) + " " + flat_select("rec_network")
    q["recommend_network_bandwidth"] = (with_ctes(*upto_trends("network"), rec_network("1000000.0::DOUBLE")) + " " +
                                        flat_select("rec_network"))
    recs = with_ctes(*ALL_RECS_CTES)
    q["recommendations"] = recs + " " + flat_select(f"(SELECT *, {NARRATIVE} AS ai_narrative FROM recs)", "ai_narrative, ")
    q["narratives"] = (recs + " SELECT resource_type, resource_id, CAST(forecast_horizon_weeks AS BIGINT) AS "
                       f"forecast_horizon_weeks, {NARRATIVE} AS narrative FROM recs")
    q["prompts"] = (recs + " SELECT resource_type, resource_id, CAST(forecast_horizon_weeks AS BIGINT) AS "
                    f"forecast_horizon_weeks, {_prompt_sql()} AS prompt FROM recs")
    parsed = (f"trim(CASE WHEN json_valid(p.response) THEN json_extract_string(p.response, "
              f"'$.candidates[0].content.parts[0].text') END, {_WS})")
    q["narratives_from_responses"] = (
        with_ctes(*ALL_RECS_CTES, RESPONSES).replace("\nrecs AS (", "\nrecs AS MATERIALIZED (") +
        " SELECT r.resource_type, r.resource_id, CAST(r.forecast_horizon_weeks AS BIGINT) AS forecast_horizon_weeks, "
        f"coalesce(nullif({parsed}, ''), {NARRATIVE.replace('resource_id', 'r.resource_id').replace('forecast_horizon_weeks', 'r.forecast_horizon_weeks')}) AS narrative "
        "FROM recs r LEFT JOIN responses p ON r.resource_type = p.resource_type AND r.resource_id = p.resource_id "
        "AND r.forecast_horizon_weeks = p.forecast_horizon_weeks")
    net_pct = f"round_even({pdiv('throughput_mbps', 'bandwidth_mbps')} * 100.0::DOUBLE * 100.0::DOUBLE, 0) / 100.0::DOUBLE"
    q["utilization_overview"] = (
        with_ctes(*upto_trends(*ALL)) +
        f" SELECT cluster_id AS resource_id, 'compute' AS resource_type, date, {r6('cluster_utilization_pct')} AS "
        f"utilization_pct FROM trends_compute UNION ALL SELECT storage_id, 'storage', date, {r6('disk_utilization_pct')} "
        f"FROM trends_storage UNION ALL SELECT link_id, 'network', date, {r6(net_pct)} FROM trends_network")
    q["risk_summary"] = recs + " SELECT resource_type, risk_level, count(*) AS \"count\" FROM recs GROUP BY 1, 2"
    q["risk_counts"] = (recs + " SELECT count(*) FILTER (WHERE risk_level = 'critical') AS critical_count, "
                        "count(*) FILTER (WHERE risk_level = 'warning') AS warning_count FROM recs")
    q["latency_warning"] = (with_ctes(*upto_trends("network")) +
                            " SELECT link_id AS resource_id, count(*) FILTER (WHERE latency_ms >= 150.0) AS "
                            f"latency_warning_days, {r6('max(latency_ms)')} AS max_daily_latency_ms FROM trends_network "
                            "WHERE link_id IS NOT NULL GROUP BY link_id")
    q["stream_daily_closed"] = _closed_days()
    q["stream_landing"] = (with_ctes(RAW_COMPUTE) + f" SELECT {ts_text('timestamp')} AS \"timestamp\", cluster_id, seq, "
                           + ", ".join(f"{r6(clip(c, '0.0', '100.0'))} AS {c}" for c in KIND["compute"][1])
                           + " FROM raw_compute WHERE cpu_utilization_pct IS NOT NULL AND "
                             "memory_utilization_pct IS NOT NULL")
    q["seasonal_fallback"] = (
        f"WITH season AS ({q['seasonal_forecast']}), line AS ({q['linear_forecast']}), points AS ({q['series_index']}), "
        "sizes AS (SELECT resource_type, resource_id, count(*) AS n, count(y) AS n_y FROM points GROUP BY ALL) "
        f"SELECT season.* FROM season JOIN sizes USING (resource_type, resource_id) WHERE n_y >= {FALLBACK_MIN_POINTS} UNION ALL "
        f"SELECT line.* REPLACE ('seasonal' AS model) FROM line JOIN sizes USING (resource_type, resource_id) "
        f"WHERE n_y < {FALLBACK_MIN_POINTS} AND n_y = n")
    q["missing_days"] = (
        f"WITH points AS ({q['series_index']}), ends AS (SELECT resource_type, resource_id, min(ds) AS low, max(ds) AS high "
        "FROM points GROUP BY ALL), spine AS (SELECT resource_type, resource_id, "
        "CAST(unnest(generate_series(low::TIMESTAMP, high::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS ds FROM ends) "
        "SELECT * FROM spine ANTI JOIN points USING (resource_type, resource_id, ds)")
    # The same tables by another way: increments and streams.
    q["stream_daily_all"] = q["daily_compute"]
    q["stream_trends_compute"] = q["trends_compute"]
    for kind in ALL:
        q[f"incremental_trends_{kind}"] = q[f"trends_{kind}"]
    q["roundtrip_recommendations"] = q["recommendations"]
    q["roundtrip_overview"] = q["utilization_overview"]
    q["roundtrip_risk_summary"] = q["risk_summary"]
    q["roundtrip_forecasts"] = q["forecast_all"]
    # end_to_end_roundtrip: rows-only (it writes and re-reads the whole job's outputs).
    return {name: sql for name, sql in q.items() if name in QUERIES}


ORACLE_SQL = build()
