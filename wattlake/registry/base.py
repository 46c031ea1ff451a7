"""Registration of queries and the shared SQL views over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under ``name``; ``sql`` is the equivalent text for the check."""
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return query
    return keep


def total(column: str, scale: int = 4) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def mean(column: str, scale: int = 4) -> str:
    return f"({total(column, scale)} / NULLIF(COUNT({column}), 0))"


def rnd(expression: str, digits: int) -> str:
    return f"(ROUND(CAST({expression} AS DOUBLE), {digits}) + 0.0::DOUBLE)"


VIEWS = {
    "telemetry": """
        SELECT concat('E', lpad(CAST(e.event_id AS VARCHAR), 8, '0')) AS event_id,
               date_trunc('hour', e.ts) + CASE WHEN extract(minute FROM e.ts) >= 30
                    THEN INTERVAL '30' MINUTE ELSE INTERVAL '0' MINUTE END AS timestamp,
               e.ts AS raw_ts,
               concat('M', lpad(CAST(e.user_id AS VARCHAR), 5, '0')) AS meter_id,
               concat('B', lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0')) AS building_id,
               CASE WHEN e.event_type = 'error' THEN NULL ELSE r.r_name END AS building_type,
               CASE WHEN k = 13 THEN NULL WHEN k = 17 THEN -e.value ELSE e.value END AS power_kw,
               CASE WHEN k = 29 THEN NULL ELSE CAST(1700 + 11 * k AS DOUBLE) / 10 END AS voltage_v,
               CASE WHEN k = 29 THEN NULL ELSE CAST(100 * k AS DOUBLE) / 8 END AS current_a,
               CAST(600 + 5 * (e.event_id % 100) AS DOUBLE) / 1000 AS power_factor
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e
        JOIN customer c ON e.user_id = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "buildings": """
        SELECT concat('B', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS building_id,
               n_name AS building_name, r_name AS category,
               CAST(100 + 5 * n_nationkey AS DOUBLE) AS peak_capacity_kw,
               concat('Zone ', CAST(n_regionkey AS VARCHAR)) AS zone
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 23""",
    "meters": """
        SELECT concat('M', lpad(CAST(c_custkey AS VARCHAR), 5, '0')) AS meter_id,
               concat('B', lpad(CAST(c_nationkey AS VARCHAR), 2, '0')) AS building_id,
               c_mktsegment AS meter_type,
               CASE WHEN c_custkey % 10 = 0 THEN 'MAINTENANCE' ELSE 'ACTIVE' END AS status
        FROM customer""",
    "bronze_rows": """
        SELECT event_id, timestamp, meter_id, building_id, COALESCE(building_type, 'Unknown') AS building_type,
               power_kw, voltage_v, current_a, power_factor FROM telemetry""",
    "unique_rows": """
        SELECT * FROM telemetry
        QUALIFY row_number() OVER (PARTITION BY meter_id, timestamp ORDER BY event_id DESC) = 1""",
    "dedup_rows": """
        SELECT * FROM bronze_rows
        QUALIFY row_number() OVER (PARTITION BY meter_id, timestamp ORDER BY event_id DESC) = 1""",
    "silver_rows": """
        SELECT d.event_id, d.timestamp, d.meter_id, d.building_id,
               COALESCE(b.building_name, d.building_id) AS building_name,
               COALESCE(b.category, d.building_type, 'Facilities') AS category,
               COALESCE(b.zone, 'General Zone') AS zone,
               COALESCE(b.peak_capacity_kw, 100.0::DOUBLE) AS building_capacity_kw,
               COALESCE(m.meter_type, 'Smart Sub-Meter') AS meter_type,
               CASE WHEN d.power_kw < 0 THEN 0.0::DOUBLE ELSE d.power_kw END AS power_kw,
               CASE WHEN d.voltage_v >= 180 AND d.voltage_v <= 270 THEN d.voltage_v
                    ELSE 230.0::DOUBLE END AS voltage_v,
               CASE WHEN d.current_a > 0 THEN d.current_a ELSE 0.0::DOUBLE END AS current_a,
               CASE WHEN d.power_factor > 1 THEN 1.0::DOUBLE
                    WHEN d.power_factor >= 0.7::DOUBLE THEN d.power_factor
                    ELSE 0.85::DOUBLE END AS power_factor,
               COALESCE(d.voltage_v < 200 OR d.voltage_v > 250, FALSE) AS is_voltage_sag_swell,
               COALESCE(d.power_factor < 0.85::DOUBLE, FALSE) AS is_low_power_factor
        FROM dedup_rows d LEFT JOIN buildings b USING (building_id) LEFT JOIN meters m ON m.meter_id = d.meter_id
        WHERE d.timestamp IS NOT NULL AND d.power_kw IS NOT NULL""",
    "efficiency_totals": f"""
        SELECT building_id, building_name, category, zone,
               COUNT(DISTINCT meter_id) AS total_meters,
               {rnd(mean('power_kw'), 2)} AS avg_demand_kw,
               {rnd('MAX(power_kw)', 2)} AS peak_demand_kw,
               {rnd('MIN(power_kw)', 2)} AS baseload_demand_kw,
               {rnd(mean('power_kw') + ' / NULLIF(MAX(power_kw), 0)', 3)} AS load_factor,
               {rnd(mean('power_factor'), 3)} AS avg_power_factor,
               COUNT(*) AS total_telemetry_samples
        FROM silver_rows GROUP BY ALL""",
    "campus_hours": f"""
        SELECT date_trunc('hour', timestamp) AS hour_window, {total('power_kw')} AS kw
        FROM silver_rows GROUP BY ALL""",
    "sliding": f"""
        SELECT date_trunc('minute', raw_ts) - to_minutes(i) AS window_start,
               date_trunc('minute', raw_ts) - to_minutes(i) + INTERVAL '5' MINUTE AS window_end, building_id,
               {rnd(mean('power_kw'), 2)} AS avg_power_kw, {rnd(mean('voltage_v'), 2)} AS avg_voltage_v,
               {rnd(mean('power_factor'), 3)} AS avg_power_factor
        FROM telemetry CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS i) GROUP BY ALL""",
    "aggs": """
        SELECT id::BIGINT AS id, window_start, window_end, building_id,
               CASE WHEN id = 2 THEN avg_power_kw + 1.5::DOUBLE ELSE avg_power_kw END AS avg_power_kw,
               CASE WHEN id = 2 THEN avg_voltage_v + 0.25::DOUBLE ELSE avg_voltage_v END AS avg_voltage_v,
               avg_power_factor
        FROM sliding CROSS JOIN (SELECT unnest([1, 2]) AS id)""",
    "calendar_rows": """
        SELECT *, extract(hour FROM timestamp)::BIGINT AS hour, dayname(timestamp) AS day_name,
               (isodow(timestamp) - 1)::BIGINT AS day_of_week, isodow(timestamp) >= 6 AS is_weekend,
               CASE WHEN isodow(timestamp) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type
        FROM telemetry""",
    "alert_rows": """
        SELECT event_id, timestamp, meter_id, building_id, 'VOLTAGE_SAG' AS alert_type, 'CRITICAL' AS severity,
               voltage_v AS metric_value, 220.0::DOUBLE AS threshold_value,
               printf('Voltage dropped to %.1fV (under standard 220.0V threshold)', voltage_v) AS description
        FROM telemetry WHERE voltage_v < 220
        UNION ALL
        SELECT event_id, timestamp, meter_id, building_id, 'VOLTAGE_SURGE', 'WARNING', voltage_v, 240.0::DOUBLE,
               printf('Voltage spiked to %.1fV (over standard 240.0V threshold)', voltage_v)
        FROM telemetry WHERE voltage_v > 240
        UNION ALL
        SELECT event_id, timestamp, meter_id, building_id, 'LOW_POWER_FACTOR', 'WARNING', power_factor, 0.88::DOUBLE,
               printf('Power factor degraded to %.3f (below target 0.88)', power_factor)
        FROM telemetry WHERE power_factor < 0.88::DOUBLE""",
    "meter_stats": f"""
        SELECT meter_id, {mean('power_kw')} AS mean_kw,
               CASE WHEN stddev_samp(power_kw) = 0 THEN 1.0::DOUBLE ELSE stddev_samp(power_kw) END AS std_kw
        FROM telemetry GROUP BY meter_id""",
    "latest_buildings": """
        SELECT a.id, a.window_start, a.window_end, a.building_id, b.building_name, b.category AS building_type,
               a.avg_power_kw, a.avg_voltage_v, a.avg_power_factor
        FROM (SELECT * FROM aggs
              QUALIFY row_number() OVER (PARTITION BY building_id ORDER BY window_end DESC, id DESC) = 1) a
        LEFT JOIN buildings b ON a.building_id = b.building_id""",
    "current_aggs": """
        SELECT * FROM aggs
        QUALIFY row_number() OVER (PARTITION BY window_end, building_id ORDER BY id DESC) = 1""",
    "building_hours": f"""
        SELECT building_id, date_trunc('hour', timestamp) AS ds,
               {rnd(mean('load'), 2)} AS total_power_kw, {rnd(mean('volts', 8), 2)} AS avg_voltage_v,
               {rnd(mean('pf', 8), 3)} AS avg_power_factor
        FROM (SELECT building_id, timestamp, {total('power_kw')} AS load, {mean('voltage_v')} AS volts,
                     {mean('power_factor')} AS pf
              FROM telemetry GROUP BY building_id, timestamp)
        GROUP BY ALL""",
}


def with_views(sql: str) -> str:
    """Prefixes the views that the text mentions, with those they mention in turn."""
    needed: list[str] = []

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name, body in VIEWS.items():
            if name in words and name not in needed:
                visit(body)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    views = ", ".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    return f"WITH {views} {sql}"
