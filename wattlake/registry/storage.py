"""Lake, catalogs, versioned table, contracts and the pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake import fixtures as fx
from wattlake.operators import joins, keyed
from wattlake.operators.alerts import alerts
from wattlake.plans import contracts as k
from wattlake.plans import medallion
from wattlake.plans.pipeline import run_pipeline
from wattlake.registry.base import mean, register, rnd
from wattlake.registry.medallion import EFFICIENCY_SQL, silver
from wattlake.registry.profiles import NINE
from wattlake.schema import TELEMETRY_COLUMNS
from wattlake.session import scratch_dir
from wattlake.sources import dimensions, lake, serving, snapshots

# --- lake ------------------------------------------------------------------


def written_lake(spark, sf_dir) -> str:
    """The readings as a lake, appended in two parts so that days have several files."""
    path = scratch_dir(spark, "lake")
    rows = fx.readings(spark, sf_dir)
    early = F.hour("timestamp") < 12
    lake.write_lake(rows.where(early), path)
    lake.write_lake(rows.where(~early), path)
    return path


@register("lake_round_trip", f"""
    SELECT {NINE}, year(timestamp)::BIGINT AS year, month(timestamp)::BIGINT AS month, day(timestamp)::BIGINT AS day
    FROM telemetry""")
def _(spark, sf_dir):
    rows = lake.read_lake(spark, written_lake(spark, sf_dir))
    return rows.withColumns({name: F.col(name).cast("bigint") for name in ("year", "month", "day")})


@register("lake_metadata", """
    SELECT TRUE AS exists, COUNT(DISTINCT date_trunc('day', timestamp)) AS days, COUNT(*) AS total_records,
           MIN(timestamp) AS min_timestamp, MAX(timestamp) AS max_timestamp,
           COUNT(DISTINCT meter_id) AS meters_count, COUNT(DISTINCT building_id) AS buildings_count FROM telemetry""")
def _(spark, sf_dir):
    found = lake.lake_metadata(spark, written_lake(spark, sf_dir))
    return found.withColumn("days", F.size("partitions").cast("bigint")) \
        .drop("partitions", "total_files", "total_size_mb")


@register("compact_lake", f"SELECT {NINE} FROM telemetry")
def _(spark, sf_dir):
    path = written_lake(spark, sf_dir)
    lake.compact_lake(spark, path)
    return lake.read_lake(spark, path).select(*TELEMETRY_COLUMNS)


@register("compaction_report", """
    SELECT COUNT(*) AS partitions_checked, COUNT(*) AS partitions_compacted, COUNT(*) AS total_files_after
    FROM (SELECT DISTINCT date_trunc('day', timestamp) FROM telemetry )""")
def _(spark, sf_dir):
    report = lake.compact_lake(spark, written_lake(spark, sf_dir))
    return lake.compaction_totals(report).select("partitions_checked", "partitions_compacted", "total_files_after")


NEWEST = f"SELECT {NINE} FROM telemetry ORDER BY timestamp DESC, event_id DESC LIMIT 2000"


@register("newest_lake_readings", NEWEST)
def _(spark, sf_dir):
    """The newest readings of a stored lake, from its newest days backwards."""
    return keyed.newest_first(lake.read_lake(spark, written_lake(spark, sf_dir)), 2_000).select(*TELEMETRY_COLUMNS)


@register("newest_lake_star", f"""
    SELECT event_id, timestamp, t.meter_id, m.building_id, b.category AS building_type, b.building_name, power_kw, voltage_v,
           current_a, power_factor
    FROM telemetry t JOIN meters m ON t.meter_id = m.meter_id JOIN buildings b ON m.building_id = b.building_id
    ORDER BY timestamp DESC, event_id DESC LIMIT 2000""")
def _(spark, sf_dir):
    rows = lake.read_lake(spark, written_lake(spark, sf_dir))
    return joins.readings_star(rows, fx.meters(spark, sf_dir), fx.buildings(spark, sf_dir), 2_000)


@register("lake_union_by_name", f"""
    SELECT {NINE}, CASE WHEN day(timestamp) >= 15 THEN 28.5::DOUBLE + voltage_v / 10 END AS ambient_temp_c FROM telemetry""")
def _(spark, sf_dir):
    """Files with and without a column, read and compacted as one lake."""
    path, rows = scratch_dir(spark, "lake-union"), fx.readings(spark, sf_dir)
    old = F.dayofmonth("timestamp") < 15
    lake.write_lake(rows.where(old), path)
    lake.write_lake(rows.where(~old).withColumn("ambient_temp_c", F.lit(28.5) + F.col("voltage_v") / 10), path)
    lake.compact_lake(spark, path)
    return lake.read_lake(spark, path).select(*TELEMETRY_COLUMNS, "ambient_temp_c")


@register("lake_partitions", """
    SELECT DISTINCT year(timestamp)::BIGINT AS year, month(timestamp)::BIGINT AS month, day(timestamp)::BIGINT AS day
    FROM telemetry""")
def _(spark, sf_dir):
    """The day folders of a stored lake, from its listing."""
    rows = lake.lake_files(spark, written_lake(spark, sf_dir))
    return rows.select(*[lake._day(name).cast("bigint").alias(name) for name in ("year", "month", "day")]).distinct()


QUERY = """
    SELECT building_type, COUNT(*) AS count, {mean} AS mean_power, MAX(power_kw) AS max_power
    FROM telemetry_lake WHERE power_kw >= :least GROUP BY building_type ORDER BY count DESC"""


@register("query_lake", f"""
    SELECT building_type, COUNT(*) AS count, {rnd(mean('power_kw'), 2)} AS mean_power, MAX(power_kw) AS max_power
    FROM telemetry WHERE power_kw >= 0 GROUP BY building_type""")
def _(spark, sf_dir):
    exact = "SUM(CAST(rint(power_kw * 10000) AS BIGINT)) / 10000D / COUNT(power_kw)"
    sql = QUERY.format(mean=f"floor(({exact}) * 100 + 0.5) / 100D")
    return lake.query_lake(lake.read_lake(spark, written_lake(spark, sf_dir)), sql, {"least": 0.0})


# --- catalogs and serving --------------------------------------------------

@register("expand_meters", """
    SELECT concat('M', lpad(CAST(row_number() OVER (ORDER BY building_id, n) AS VARCHAR), 6, '0')) AS meter_id,
           building_id, category AS building_type, 'Smart Sub-Meter' AS meter_type, 'ACTIVE' AS status
    FROM (SELECT b.building_id, b.category, row_number() OVER (PARTITION BY b.building_id) AS n
          FROM meters m JOIN buildings b ON m.building_id = b.building_id)""")
def _(spark, sf_dir):
    counts = fx.meters(spark, sf_dir).groupBy("building_id").agg(F.count("*").alias("meter_count")) \
        .join(fx.buildings(spark, sf_dir), "building_id") \
        .select("building_id", F.col("category").alias("building_type"), "meter_count")
    return dimensions.expand_meters(counts, ["building_id"], width=6)


@register("upsert_buildings", """
    SELECT concat('B', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS building_id,
           CASE WHEN n_nationkey < 23 THEN n_name ELSE concat('New ', n_name) END AS building_name,
           CASE WHEN n_nationkey < 10 THEN r_name ELSE 'Facilities' END AS category,
           CASE WHEN n_nationkey < 23 THEN CAST(100 + 5 * n_nationkey AS DOUBLE) END AS peak_capacity_kw,
           CASE WHEN n_nationkey < 23 THEN concat('Zone ', CAST(n_regionkey AS VARCHAR)) END AS zone
    FROM nation JOIN region ON n_regionkey = r_regionkey""")
def _(spark, sf_dir):
    updates = fx.table(spark, sf_dir, "nation").where("n_nationkey >= 10").select(
        F.concat(F.lit("B"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("building_id"),
        F.concat(F.lit("New "), F.col("n_name")).alias("building_name"), F.lit("Facilities").alias("category"))
    return dimensions.upsert(fx.buildings(spark, sf_dir), updates, "building_id", ["category"])


@register("table_stats", """
    SELECT (SELECT COUNT(*) FROM buildings ) AS building_count, (SELECT COUNT(*) FROM meters ) AS meter_count,
           (SELECT COUNT(*) FROM telemetry ) AS readings_count, (SELECT COUNT(*) FROM alert_rows ) AS alerts_count,
           (SELECT COUNT(*) FROM aggs ) AS aggregates_count, (SELECT MIN(timestamp) FROM telemetry ) AS earliest_reading,
           (SELECT MAX(timestamp) FROM telemetry ) AS latest_reading""")
def _(spark, sf_dir):
    rows = fx.readings(spark, sf_dir)
    return serving.table_stats(fx.buildings(spark, sf_dir), fx.meters(spark, sf_dir), rows, alerts(rows),
                               fx.window_aggregates(spark, sf_dir))


@register("newest_hourly_mart", """
    SELECT date_trunc('hour', timestamp) AS hour_window, building_id, category, COUNT(*) AS sample_count
    FROM silver_rows GROUP BY ALL ORDER BY hour_window DESC, building_id, category LIMIT 500""")
def _(spark, sf_dir):
    rows = silver(spark, sf_dir)
    marts = serving.present_marts(medallion.hourly_facility_demand(rows), medallion.daily_dispatch(rows),
                                  medallion.facility_efficiency(rows))
    return marts["hourly"].select("hour_window", "building_id", "category", "sample_count")


@register("newest_daily_mart", f"""
    SELECT strftime(hour_window, '%Y-%m-%d') AS dispatch_date, COUNT(*) AS active_hours, {rnd('MAX(kw)', 2)} AS peak_campus_demand_kw
    FROM campus_hours GROUP BY 1 ORDER BY dispatch_date DESC""")
def _(spark, sf_dir):
    """The daily mart as the pipeline writes it and its readers show it."""
    out, _ = pipeline_run(spark, sf_dir, k.range_contracts())
    return serving.read_marts(spark, f"{out}/gold")["daily"].select("dispatch_date", "active_hours", "peak_campus_demand_kw")


# --- versioned table -------------------------------------------------------

EXTRA = "CASE WHEN day(timestamp) >= 10 THEN 20 + voltage_v / 10 END AS ambient_temp_c"


LATE = "day(timestamp) = 12 AND minute(timestamp) >= 30"           # come with the rows of later days
FIRST = f"(day(timestamp) < 20 AND NOT ({LATE}))"


def versioned_table(spark, sf_dir) -> str:
    """Four versions: INIT, an append with a new column, an append with late rows, OPTIMIZE of the one crowded day."""
    path = scratch_dir(spark, "snapshots")
    rows = fx.readings(spark, sf_dir).withColumns({
        "year": F.year("timestamp"), "month": F.month("timestamp"), "day": F.dayofmonth("timestamp")})
    warm = rows.withColumn("ambient_temp_c", 20 + F.col("voltage_v") / 10)
    snapshots.snapshot_init(rows.where("day < 10"), path)
    snapshots.snapshot_append(warm.where(f"day >= 10 AND {FIRST}"), path)
    snapshots.snapshot_append(warm.where(f"day >= 10 AND NOT {FIRST}"), path)
    snapshots.snapshot_compact(spark, path)
    return path


@register("snapshot_latest", f"SELECT {NINE}, {EXTRA} FROM telemetry")
def _(spark, sf_dir):
    return snapshots.read_snapshot(spark, versioned_table(spark, sf_dir)).drop("year", "month", "day")


@register("snapshot_time_travel", f"SELECT {NINE}, {EXTRA} FROM telemetry WHERE {FIRST}")
def _(spark, sf_dir):
    return snapshots.read_snapshot(spark, versioned_table(spark, sf_dir), version=1).drop("year", "month", "day")


@register("snapshot_compare", """
    SELECT COUNT(*) FILTER (WHERE day(timestamp) < 10) AS rows_a, COUNT(*) AS rows_b,
           COUNT(*) FILTER (WHERE day(timestamp) >= 10) AS row_delta, 'ambient_temp_c' AS added_columns,
           '' AS removed_columns, TRUE AS schema_evolved FROM telemetry""")
def _(spark, sf_dir):
    return snapshots.compare_snapshots(spark, versioned_table(spark, sf_dir), 0, 3).select(
        "rows_a", "rows_b", "row_delta", F.concat_ws(",", "added_columns").alias("added_columns"),
        F.concat_ws(",", "removed_columns").alias("removed_columns"), "schema_evolved")


@register("commit_history", f"""
    SELECT 3::BIGINT AS version, 'OPTIMIZE' AS operation, COUNT(*) AS rows FROM telemetry WHERE day(timestamp) = 12
    UNION ALL SELECT 2, 'APPEND', COUNT(*) FROM telemetry WHERE NOT {FIRST}
    UNION ALL SELECT 1, 'APPEND', COUNT(*) FROM telemetry WHERE {FIRST} AND day(timestamp) >= 10
    UNION ALL SELECT 0, 'INIT', COUNT(*) FROM telemetry WHERE day(timestamp) < 10""")
def _(spark, sf_dir):
    return snapshots.commit_history(spark, versioned_table(spark, sf_dir)) \
        .select(F.col("version").cast("bigint").alias("version"), "operation", "rows")


@register("query_snapshot", f"""
    SELECT building_type, COUNT(*) AS records, {rnd(mean('power_kw'), 2)} AS mean_power
    FROM telemetry WHERE {FIRST} GROUP BY building_type""")
def _(spark, sf_dir):
    """Any SQL over an older version of the table."""
    exact = "SUM(CAST(rint(power_kw * 10000) AS BIGINT)) / 10000D / COUNT(power_kw)"
    rows = snapshots.read_snapshot(spark, versioned_table(spark, sf_dir), version=1)
    return lake.query_lake(rows, f"""SELECT building_type, COUNT(*) AS records, floor(({exact}) * 100 + 0.5) / 100D AS mean_power
        FROM snapshot GROUP BY building_type""", view="snapshot")


# --- contracts and pipeline ------------------------------------------------

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SQL_TABLES = {
    "buildings": "buildings", "meters": "meters", "bronze": "bronze_rows", "silver": "silver_rows",
    "hourly": """(SELECT concat(CAST(date_trunc('hour', timestamp) AS VARCHAR), building_id) AS hourly_facility_id,
        building_id, date_trunc('hour', timestamp) AS hour_timestamp, AVG(power_kw) AS avg_power_kw,
        COUNT(*) AS sample_count FROM silver_rows GROUP BY date_trunc('hour', timestamp), building_id, building_name, category, zone)""",
    "daily": """(SELECT strftime(hour_window, '%Y-%m-%d') AS dispatch_date, MAX(kw) AS peak_campus_demand_kw
        FROM campus_hours GROUP BY 1)""",
    "efficiency": "efficiency_totals",
}


def _contract_sql(contract: k.Contract) -> str:
    column, table = contract.column, SQL_TABLES[contract.model]
    if contract.test == "unique":
        counted = f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1)"
        failures = f"SELECT COUNT(*) FROM {counted}"
    elif contract.test == "relationships":
        parent = f"SELECT {contract.parent_key} FROM {SQL_TABLES[contract.parent]} "
        failures = f"SELECT COUNT(*) FROM {table} WHERE {column} NOT IN ({parent})"
    else:
        listed = ", ".join(f"'{value}'" for value in contract.values)
        rule = {"not_null": f"{column} IS NULL", "accepted_values": f"{column} NOT IN ({listed})",
                "range": " OR ".join(
                    ([f"{column} {'<=' if contract.low_open else '<'} {contract.low}"] if contract.low is not None else [])
                    + ([f"{column} > {contract.high}"] if contract.high is not None else []))}[contract.test]
        failures = f"SELECT COUNT(*) FROM {table} WHERE {rule}"
    return f"SELECT '{contract.model}' AS model, '{column}' AS \"column\", '{contract.test}' AS test, " \
           f"({failures}) AS failures"


def _report_sql(contracts) -> str:
    return "SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(map(_contract_sql, contracts)) + ")"


def pipeline_run(spark, sf_dir, contracts):
    """A whole pipeline run; the folder it wrote to and its report."""
    out = scratch_dir(spark, "medallion")
    report = run_pipeline(fx.readings(spark, sf_dir), fx.buildings(spark, sf_dir), fx.meters(spark, sf_dir), out,
                          contracts=contracts)
    if report.error:
        raise RuntimeError(report.error)
    return out, report


CONTRACTS = k.campus_contracts(REGIONS)


@register("run_contracts", _report_sql(CONTRACTS))
def _(spark, sf_dir):
    out, _ = pipeline_run(spark, sf_dir, CONTRACTS)
    return spark.read.parquet(f"{out}/contracts")


@register("range_contracts", _report_sql(k.range_contracts()))
def _(spark, sf_dir):
    out, _ = pipeline_run(spark, sf_dir, k.range_contracts())
    return spark.read.parquet(f"{out}/contracts")


@register("check_not_null", "SELECT COUNT(*) AS failures FROM telemetry WHERE power_kw IS NULL")
def _(spark, sf_dir):
    return k.check_not_null(fx.readings(spark, sf_dir), "power_kw")


@register("check_unique", """
    SELECT COUNT(*) AS failures FROM (SELECT meter_id FROM telemetry GROUP BY meter_id HAVING COUNT(*) > 1)""")
def _(spark, sf_dir):
    return k.check_unique(fx.readings(spark, sf_dir), "meter_id")


@register("check_accepted_values", """
    SELECT COUNT(*) AS failures FROM telemetry WHERE building_type NOT IN ('ASIA', 'EUROPE')""")
def _(spark, sf_dir):
    return k.check_accepted_values(fx.readings(spark, sf_dir), "building_type", ["ASIA", "EUROPE"])


@register("check_relationship", """
    SELECT COUNT(*) AS failures FROM telemetry WHERE building_id NOT IN (SELECT building_id FROM buildings )""")
def _(spark, sf_dir):
    return k.check_relationship(fx.readings(spark, sf_dir), "building_id", fx.buildings(spark, sf_dir), "building_id")


@register("check_range", "SELECT COUNT(*) AS failures FROM telemetry WHERE voltage_v < 180 OR voltage_v > 270")
def _(spark, sf_dir):
    return k.check_range(fx.readings(spark, sf_dir), "voltage_v", 180.0, 270.0)


@register("orphan_meters", "SELECT * FROM meters WHERE building_id NOT IN (SELECT building_id FROM buildings )")
def _(spark, sf_dir):
    return joins.orphans(fx.meters(spark, sf_dir), fx.buildings(spark, sf_dir), "building_id") \
        .select("meter_id", "building_id", "meter_type", "status")


@register("pipeline_efficiency_mart", EFFICIENCY_SQL)
def _(spark, sf_dir):
    """The efficiency mart as the pipeline writes it."""
    out, _ = pipeline_run(spark, sf_dir, k.range_contracts())
    return serving.read_marts(spark, f"{out}/gold")["efficiency"]
