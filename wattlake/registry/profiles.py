"""Filters, joins, profiles, rankings and set operations over readings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wattlake import fixtures as fx
from wattlake.functions.calendar import add_calendar, add_partitions
from wattlake.functions.electrical import derive_power
from wattlake.operators import filters, joins, keyed, profiles
from wattlake.operators.alerts import alerts
from wattlake.plans.medallion import dedup_latest
from wattlake.registry.base import mean, register, rnd, total
from wattlake.session import stored

NINE = """event_id, timestamp, meter_id, building_id, building_type, power_kw, voltage_v, current_a,
           power_factor"""
LATE = "2024-01-10 00:00:00", "2024-01-12 12:00:00"


@register("add_calendar", "SELECT * EXCLUDE (raw_ts) FROM calendar_rows")
def _(spark, sf_dir):
    rows = add_calendar(fx.readings(spark, sf_dir))
    return rows.withColumns({"hour": F.col("hour").cast("bigint"),
                             "day_of_week": F.col("day_of_week").cast("bigint")})


@register("add_partitions", """
    SELECT event_id, year(timestamp)::BIGINT AS year, month(timestamp)::BIGINT AS month,
           day(timestamp)::BIGINT AS day FROM telemetry""")
def _(spark, sf_dir):
    rows = add_partitions(fx.readings(spark, sf_dir))
    return rows.select("event_id", *[F.col(name).cast("bigint").alias(name) for name in ("year", "month", "day")])


@register("filter_telemetry", f"""
    SELECT {NINE} FROM telemetry WHERE building_type = 'ASIA'
      AND timestamp >= TIMESTAMP '{LATE[0]}' AND timestamp <= TIMESTAMP '{LATE[1]}'""")
def _(spark, sf_dir):
    return filters.filter_telemetry(fx.readings(spark, sf_dir), category="ASIA", building="All Buildings",
                                    date_from=LATE[0], date_to=LATE[1])


@register("query_telemetry", f"""
    SELECT {NINE} FROM telemetry
    WHERE timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-25'
      AND building_id IN ('B01', 'B08', 'B24')
    ORDER BY timestamp DESC, event_id DESC LIMIT 100""")
def _(spark, sf_dir):
    return filters.query_telemetry(fx.readings(spark, sf_dir), dt.date(2024, 1, 5), dt.date(2024, 1, 24),
                                   ["B01", "B08", "B24"], "All", limit=100)


@register("search_literal", f"SELECT {NINE} FROM telemetry WHERE lower(building_id) LIKE '%b1%' OR lower(meter_id) LIKE '%b1%'")
def _(spark, sf_dir):
    return filters.search(fx.readings(spark, sf_dir), " B1 ")


@register("search_regex", f"""
    SELECT {NINE} FROM telemetry
    WHERE regexp_matches(lower(building_id), '^b0[12]$|m0+7$') OR regexp_matches(lower(meter_id), '^b0[12]$|m0+7$')""")
def _(spark, sf_dir):
    return filters.search(fx.readings(spark, sf_dir), "^B0[12]$|M0+7$", mode="regex")


@register("recent", f"""
    SELECT {NINE} FROM telemetry WHERE timestamp >= (SELECT MAX(timestamp) - INTERVAL 40 MINUTE FROM telemetry )""")
def _(spark, sf_dir):
    return filters.recent(fx.readings(spark, sf_dir), "timestamp", "40 minutes")


@register("derive_power", f"""
    SELECT event_id, apparent_power_kva,
           CASE WHEN apparent_power_kva IS NOT NULL AND power_kw IS NOT NULL THEN
           {rnd('sqrt(GREATEST(0.0::DOUBLE, apparent_power_kva * apparent_power_kva - power_kw * power_kw))', 2)} END
               AS reactive_power_kvar,
           {rnd('power_kw * 1000.0::DOUBLE / NULLIF(voltage_v, 0)', 2)} AS derived_current_a
    FROM (SELECT *, {rnd('power_kw / NULLIF(power_factor, 0)', 2)} AS apparent_power_kva FROM telemetry )""")
def _(spark, sf_dir):
    return derive_power(fx.readings(spark, sf_dir)) \
        .select("event_id", "apparent_power_kva", "reactive_power_kvar", "derived_current_a")


# --- joins -----------------------------------------------------------------

STAR = """t JOIN meters m ON t.meter_id = m.meter_id JOIN buildings b ON m.building_id = b.building_id"""


@register("readings_star", f"""
    SELECT t.event_id, t.timestamp, t.meter_id, m.building_id, b.category AS building_type, b.building_name,
           t.power_kw, t.voltage_v, t.current_a, t.power_factor
    FROM telemetry {STAR} ORDER BY t.timestamp DESC, t.event_id DESC LIMIT 25000""")
def _(spark, sf_dir):
    return joins.readings_star(fx.readings(spark, sf_dir), fx.meters(spark, sf_dir), fx.buildings(spark, sf_dir))


@register("alerts_star", f"""
    SELECT t.event_id, t.timestamp, t.meter_id, m.building_id, b.category AS building_type, t.alert_type,
           t.severity, t.metric_value, t.threshold_value, t.description
    FROM alert_rows {STAR} ORDER BY t.timestamp DESC, t.event_id DESC, t.alert_type DESC LIMIT 500""")
def _(spark, sf_dir):
    return joins.alerts_star(alerts(fx.readings(spark, sf_dir)), fx.meters(spark, sf_dir),
                             fx.buildings(spark, sf_dir))


@register("orphan_readings", f"""
    SELECT {NINE} FROM telemetry WHERE building_id NOT IN (SELECT building_id FROM buildings )""")
def _(spark, sf_dir):
    return joins.orphans(fx.readings(spark, sf_dir), fx.buildings(spark, sf_dir), "building_id") \
        .select(*[name for name in fx.readings(spark, sf_dir).columns])


@register("baseline_lookup", f"""
    SELECT t.event_id, COALESCE(s.mean_kw, 20.0::DOUBLE) AS mean_kw,
           ROUND(CASE WHEN s.meter_id IS NULL THEN 5.0::DOUBLE ELSE s.std_kw END, 6) AS std_kw
    FROM telemetry t LEFT JOIN (
        SELECT meter_id, {mean('power_kw')} AS mean_kw,
               CASE WHEN stddev_samp(power_kw) = 0 THEN 1.0::DOUBLE ELSE stddev_samp(power_kw) END AS std_kw
        FROM telemetry WHERE building_type IS NOT NULL AND building_id < 'B20' GROUP BY meter_id) s
    ON t.meter_id = s.meter_id""")
def _(spark, sf_dir):
    rows = fx.readings(spark, sf_dir)
    known = stored(profiles.meter_baselines(rows.where("building_type IS NOT NULL AND building_id < 'B20'")),
                   "baselines")
    return joins.baseline_lookup(rows, known).select("event_id", "mean_kw", F.round("std_kw", 6).alias("std_kw"))


# --- aggregates ------------------------------------------------------------

PROFILE_COLUMNS = f"""{rnd(mean('power_kw'), 2)} AS avg_power_kw, {rnd('MAX(power_kw)', 2)} AS peak_power_kw,
    {rnd(mean('voltage_v'), 2)} AS avg_voltage_v, {rnd(mean('current_a'), 2)} AS avg_current_a,
    {rnd(mean('power_factor'), 3)} AS avg_power_factor, COUNT(event_id) AS reading_count"""


@register("building_summary", f"""
    SELECT building_id, building_type, {rnd(total('power_kw'), 2)} AS total_energy_kw_sum, {PROFILE_COLUMNS},
           COUNT(DISTINCT meter_id) AS meter_count
    FROM telemetry WHERE building_id IS NOT NULL AND building_type IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf_dir):
    return profiles.building_summary(fx.readings(spark, sf_dir))


@register("meter_summary", f"""
    SELECT meter_id, building_id, building_type, {PROFILE_COLUMNS}
    FROM telemetry WHERE building_type IS NOT NULL GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    return profiles.meter_summary(fx.readings(spark, sf_dir))


@register("category_summary", f"""
    SELECT building_type, {rnd(total('power_kw'), 2)} AS total_energy_kw_sum, {PROFILE_COLUMNS},
           COUNT(DISTINCT building_id) AS building_count, COUNT(DISTINCT meter_id) AS meter_count
    FROM telemetry WHERE building_type IS NOT NULL GROUP BY 1""")
def _(spark, sf_dir):
    return profiles.category_summary(fx.readings(spark, sf_dir))


@register("building_energy", f"""
    SELECT building_id, building_type, COUNT(DISTINCT meter_id) AS meter_count,
           {rnd(mean('power_kw'), 2)} AS avg_power_kw, {rnd('MAX(power_kw)', 2)} AS max_power_kw,
           {rnd(total('power_kw') + ' * 0.25::DOUBLE', 2)} AS est_total_kwh, COUNT(*) AS total_readings
    FROM telemetry GROUP BY 1, 2""")
def _(spark, sf_dir):
    return profiles.building_energy(fx.readings(spark, sf_dir))


def _lake_profile_sql(where: str) -> str:
    return f"""
    SELECT extract(hour FROM timestamp)::BIGINT AS hour, {rnd(mean('power_kw'), 2)} AS avg_power_kw,
           {rnd('MIN(power_kw)', 2)} AS min_power_kw, {rnd('MAX(power_kw)', 2)} AS max_power_kw,
           {rnd(mean('voltage_v'), 2)} AS avg_voltage_v, {rnd(mean('power_factor'), 3)} AS avg_power_factor,
           COUNT(*) AS reading_count
    FROM telemetry WHERE {where} GROUP BY 1"""


@register("hourly_profile_lake", _lake_profile_sql("TRUE"))
def _(spark, sf_dir):
    return profiles.hourly_profile_lake(fx.readings(spark, sf_dir))


@register("hourly_profile_lake_category", _lake_profile_sql("building_type = 'EUROPE'"))
def _(spark, sf_dir):
    return profiles.hourly_profile_lake(fx.readings(spark, sf_dir), building_id="All", building_type="EUROPE")


@register("hourly_profile_by_category", f"""
    SELECT hour, building_type, {rnd(mean('power_kw'), 2)} AS avg_power_kw, {total('power_kw')} AS total_power_kw,
           {mean('voltage_v')} AS avg_voltage_v FROM calendar_rows WHERE building_type IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf_dir):
    rows = profiles.hourly_profile(fx.readings(spark, sf_dir))
    return rows.withColumn("hour", F.col("hour").cast("bigint"))


@register("hourly_profile", f"""
    SELECT hour, {rnd(mean('power_kw'), 2)} AS avg_power_kw, {total('power_kw')} AS total_power_kw,
           {mean('voltage_v')} AS avg_voltage_v FROM calendar_rows GROUP BY 1""")
def _(spark, sf_dir):
    rows = profiles.hourly_profile(fx.readings(spark, sf_dir), by_category=False)
    return rows.withColumn("hour", F.col("hour").cast("bigint"))


@register("day_of_week_profile", f"""
    SELECT day_name, day_of_week, building_type, {mean('power_kw')} AS avg_power_kw,
           {total('power_kw')} AS total_power_kw FROM calendar_rows WHERE building_type IS NOT NULL GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    rows = profiles.day_of_week_profile(fx.readings(spark, sf_dir))
    return rows.withColumn("day_of_week", F.col("day_of_week").cast("bigint"))


@register("weekday_weekend", f"""
    SELECT day_type, building_type, {rnd(mean('power_kw'), 2)} AS avg_power_kw,
           {rnd('MAX(power_kw)', 2)} AS peak_power_kw, COUNT(event_id) AS reading_count
    FROM calendar_rows WHERE building_type IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf_dir):
    return profiles.weekday_weekend(fx.readings(spark, sf_dir))


@register("building_week", f"""
    SELECT day_name, day_of_week, {mean('power_kw')} AS avg_power_kw, MAX(power_kw) AS peak_power_kw
    FROM calendar_rows WHERE building_id = 'B07' GROUP BY 1, 2""")
def _(spark, sf_dir):
    rows = profiles.building_week(fx.readings(spark, sf_dir), "B07")
    return rows.withColumn("day_of_week", F.col("day_of_week").cast("bigint"))


def _resample_sql(width: str, where: str = "TRUE") -> str:
    return f"""
    SELECT * FROM (
        SELECT time_bucket(INTERVAL '{width}', timestamp) AS timestamp, {total('power_kw')} AS total_power_kw,
               {mean('power_kw')} AS avg_power_kw, {mean('voltage_v')} AS avg_voltage_v,
               {mean('power_factor')} AS avg_power_factor
        FROM telemetry WHERE {where} GROUP BY 1)
    WHERE timestamp IS NOT NULL AND avg_power_kw IS NOT NULL AND avg_voltage_v IS NOT NULL
      AND avg_power_factor IS NOT NULL"""


for _freq, _width in profiles.FREQUENCIES.items():
    register(f"resample_{_freq.lower()}", _resample_sql(_width))(
        lambda spark, sf_dir, freq=_freq: profiles.resample(fx.readings(spark, sf_dir), freq))


@register("resample_category", _resample_sql("1 hour", "building_type = 'AFRICA'"))
def _(spark, sf_dir):
    return profiles.resample(fx.readings(spark, sf_dir), "1h", "AFRICA")


@register("anomaly_counts", """
    SELECT COUNT(*) FILTER (WHERE voltage_v < 220 OR voltage_v > 240 OR power_factor < 0.88::DOUBLE) AS total_anomalies,
           COUNT(*) FILTER (WHERE voltage_v < 220) AS voltage_sags,
           COUNT(*) FILTER (WHERE voltage_v > 240) AS voltage_surges,
           COUNT(*) FILTER (WHERE power_factor < 0.88::DOUBLE) AS low_power_factor FROM telemetry""")
def _(spark, sf_dir):
    return profiles.anomaly_counts(fx.readings(spark, sf_dir))


@register("anomaly_rows", f"""
    SELECT {NINE} FROM telemetry WHERE voltage_v < 220 OR voltage_v > 240 OR power_factor < 0.88::DOUBLE""")
def _(spark, sf_dir):
    return profiles.anomaly_rows(fx.readings(spark, sf_dir))


@register("category_scan", f"""
    SELECT building_type, COUNT(*) AS readings, {mean('power_kw')} AS avg_power_kw, MAX(power_kw) AS max_power_kw
    FROM telemetry GROUP BY 1""")
def category_scan(spark, sf_dir):
    return profiles.category_scan(fx.readings(spark, sf_dir))


@register("category_scan_star", f"""
    SELECT b.category, COUNT(*) AS readings, {mean('t.power_kw')} AS avg_power_kw, MAX(t.power_kw) AS max_power_kw
    FROM telemetry {STAR} GROUP BY 1""")
def _(spark, sf_dir):
    return profiles.category_scan_star(fx.readings(spark, sf_dir), fx.meters(spark, sf_dir),
                                       fx.buildings(spark, sf_dir))


@register("campus_distincts", """
    SELECT COUNT(*) AS total_records, MIN(timestamp) AS min_timestamp, MAX(timestamp) AS max_timestamp,
           COUNT(DISTINCT meter_id) AS meters_count, COUNT(DISTINCT building_id) AS buildings_count FROM telemetry""")
def _(spark, sf_dir):
    return profiles.campus_distincts(fx.readings(spark, sf_dir))


def unique_readings(spark, sf_dir):
    """One raw reading per meter and time."""
    return dedup_latest(fx.readings(spark, sf_dir))


def _last(column: str) -> str:
    return f"""(SELECT meter_id, {column} AS v FROM telemetry  WHERE {column} IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY timestamp DESC, event_id DESC) = 1)"""


@register("kpis", f"""
    SELECT COUNT(*) AS total_records, COUNT(DISTINCT building_type) AS total_categories,
           COUNT(DISTINCT building_id) AS total_buildings, COUNT(DISTINCT meter_id) AS total_meters,
           MIN(timestamp) AS earliest_time, MAX(timestamp) AS latest_time,
           (SELECT {rnd(total('v'), 2)} FROM {_last('power_kw')}) AS current_total_load_kw,
           (SELECT {rnd(mean('v'), 2)} FROM {_last('voltage_v')}) AS avg_voltage,
           (SELECT {rnd(mean('v'), 3)} FROM {_last('power_factor')}) AS avg_power_factor,
           {rnd(mean('power_kw'), 2)} AS avg_power_kw, {rnd('MAX(power_kw)', 2)} AS peak_power_kw,
           {rnd('MIN(power_kw)', 2)} AS min_power_kw
    FROM telemetry """)
def _(spark, sf_dir):
    return profiles.kpis(fx.readings(spark, sf_dir))


@register("latest_per_meter", f"""
    SELECT k.meter_id, p.v AS power_kw, u.v AS voltage_v, f.v AS power_factor
    FROM (SELECT DISTINCT meter_id FROM telemetry  ) k LEFT JOIN {_last('power_kw')} p ON k.meter_id = p.meter_id
    LEFT JOIN {_last('voltage_v')} u ON k.meter_id = u.meter_id
    LEFT JOIN {_last('power_factor')} f ON k.meter_id = f.meter_id""")
def _(spark, sf_dir):
    return keyed.latest_per_meter(fx.readings(spark, sf_dir))


@register("instant_load", f"""
    SELECT {rnd(total('power_kw'), 1)} AS total_kw, {rnd(mean('voltage_v'), 1)} AS avg_v,
           {rnd(mean('power_factor'), 3)} AS avg_pf
    FROM telemetry WHERE timestamp = (SELECT MAX(timestamp) FROM telemetry )""")
def _(spark, sf_dir):
    return profiles.instant_load(fx.readings(spark, sf_dir))


@register("meter_baselines", "SELECT meter_id, mean_kw, ROUND(std_kw, 6) AS std_kw FROM meter_stats")
def _(spark, sf_dir):
    return profiles.meter_baselines(fx.readings(spark, sf_dir)) \
        .withColumn("std_kw", F.round("std_kw", 6))


@register("newest_readings", f"SELECT {NINE} FROM telemetry ORDER BY timestamp DESC, event_id DESC LIMIT 2000")
def _(spark, sf_dir):
    return keyed.newest_first(fx.readings(spark, sf_dir), 2_000)


@register("top_meters", f"""
    SELECT meter_id, building_id, building_type, {PROFILE_COLUMNS} FROM telemetry WHERE building_type IS NOT NULL
    GROUP BY 1, 2, 3 ORDER BY avg_power_kw DESC NULLS LAST, meter_id, building_id, building_type LIMIT 10""")
def _(spark, sf_dir):
    return keyed.top_k(profiles.meter_summary(fx.readings(spark, sf_dir)), 10, "avg_power_kw",
                       ["meter_id", "building_id", "building_type"])


# --- set operations --------------------------------------------------------

@register("union_by_name", f"""
    SELECT {NINE}, NULL::DOUBLE AS ambient_temp_c, NULL::DOUBLE AS humidity_pct
    FROM telemetry WHERE timestamp < TIMESTAMP '2024-01-15'
    UNION ALL SELECT {NINE}, 28.5::DOUBLE + voltage_v / 10, power_factor * 50 FROM telemetry
    WHERE timestamp >= TIMESTAMP '2024-01-15'""")
def _(spark, sf_dir):
    rows = fx.readings(spark, sf_dir)
    old = rows.where("timestamp < TIMESTAMP_NTZ '2024-01-15'")
    new = rows.where("timestamp >= TIMESTAMP_NTZ '2024-01-15'").withColumns({
        "ambient_temp_c": F.lit(28.5) + F.col("voltage_v") / 10, "humidity_pct": F.col("power_factor") * 50})
    return old.unionByName(new, allowMissingColumns=True)


@register("distinct_partitions", """
    SELECT DISTINCT year(timestamp)::BIGINT AS year, month(timestamp)::BIGINT AS month, day(timestamp)::BIGINT AS day
    FROM telemetry""")
def _(spark, sf_dir):
    rows = add_partitions(fx.readings(spark, sf_dir))
    return rows.select(*[F.col(name).cast("bigint").alias(name) for name in ("year", "month", "day")]).distinct()
