"""Sliding windows and the readers of their serving table."""

from __future__ import annotations

from wattlake import fixtures as fx
from wattlake.operators import joins, live, profiles
from wattlake.operators.filters import category_filter
from wattlake.registry.base import mean, register, rnd, total
from wattlake.streaming.windows import flatten_window, sliding_building_averages


@register("sliding_building_averages", "SELECT * FROM sliding")
def sliding(spark, sf_dir):
    return flatten_window(sliding_building_averages(fx.telemetry(spark, sf_dir), ts="raw_ts"))


@register("aggregates_star", """
    SELECT a.id, a.window_start, a.window_end, a.building_id, b.building_name, b.category AS building_type,
           a.avg_power_kw, a.avg_voltage_v, a.avg_power_factor
    FROM aggs a JOIN buildings b ON a.building_id = b.building_id
    ORDER BY a.window_end DESC, a.building_id DESC, a.id DESC LIMIT 1000""")
def _(spark, sf_dir):
    return joins.aggregates_star(fx.window_aggregates(spark, sf_dir), fx.buildings(spark, sf_dir))


@register("latest_version", "SELECT * FROM current_aggs")
def _(spark, sf_dir):
    return live.latest_version(fx.window_aggregates(spark, sf_dir))


def latest_rows(spark, sf_dir):
    return live.latest_per_building(fx.window_aggregates(spark, sf_dir), fx.buildings(spark, sf_dir))


register("latest_per_building", "SELECT * FROM latest_buildings")(latest_rows)


@register("category_filter", "SELECT * FROM latest_buildings WHERE building_type = 'ASIA'")
def _(spark, sf_dir):
    return category_filter(latest_rows(spark, sf_dir), "ASIA")


@register("stream_timeline", f"""
    SELECT window_end, {rnd(total('avg_power_kw'), 1)} AS total_power_kw, {rnd(mean('avg_voltage_v'), 1)} AS avg_voltage_v,
           COUNT(*) AS active_buildings
    FROM current_aggs WHERE window_end >= (SELECT MAX(window_end) - INTERVAL 40 MINUTE FROM aggs )
    GROUP BY window_end ORDER BY window_end LIMIT 40""")
def _(spark, sf_dir):
    return live.stream_timeline(fx.window_aggregates(spark, sf_dir))


@register("live_timeline", f"""
    SELECT window_end, {total('avg_power_kw')} AS avg_power_kw
    FROM current_aggs WHERE window_end >= (SELECT MAX(window_end) - INTERVAL 60 MINUTE FROM aggs )
    GROUP BY window_end""")
def _(spark, sf_dir):
    return live.live_timeline(fx.window_aggregates(spark, sf_dir))


@register("live_window", f"""
    SELECT window_end, current_load_kw, current_voltage_v,
           {rnd('current_load_kw - (SELECT ' + rnd(mean('power_kw'), 2) + ' FROM telemetry )', 1)} AS load_vs_history_kw,
           {rnd('current_voltage_v - (SELECT ' + rnd(mean('voltage_v'), 2) + ' FROM telemetry )', 1)} AS voltage_vs_history_v
    FROM (SELECT window_end, {total('avg_power_kw')} AS current_load_kw, {mean('avg_voltage_v')} AS current_voltage_v
          FROM current_aggs WHERE window_end = (SELECT MAX(window_end) FROM aggs ) GROUP BY window_end)""")
def _(spark, sf_dir):
    current = live.live_window(fx.window_aggregates(spark, sf_dir))
    return profiles.live_comparison(current, fx.readings(spark, sf_dir))


@register("latest_totals", f"""
    SELECT MAX(window_end) AS window_end, {rnd(total('avg_power_kw'), 1)} AS load_kw,
           {rnd(mean('COALESCE(avg_voltage_v, 0)'), 1)} AS voltage_v, COUNT(*) AS active_buildings FROM latest_buildings""")
def _(spark, sf_dir):
    return live.latest_totals(latest_rows(spark, sf_dir))


@register("top_buildings", f"""
    SELECT building_name AS name, {rnd('MAX(avg_power_kw)', 1)} AS power FROM latest_buildings
    GROUP BY 1 ORDER BY power DESC NULLS LAST, name LIMIT 8""")
def _(spark, sf_dir):
    return live.top_buildings(latest_rows(spark, sf_dir))
