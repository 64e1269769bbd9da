"""Window functions over the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from peervane.operators import series as sr
from peervane.operators.order_stats import average_rank
from peervane.operators.peers import with_peer_groups
from workload.base import (
    DAILY_SQL,
    SOUND_SQL,
    FUND_CTES,
    PANEL_SQL,
    REGISTRY_SQL,
    Tables,
    pools_sql,
    query,
    r6,
    with_clause,
)


@query(
    "win1_daily_returns", "WIN-1",
    with_clause(DAILY_SQL, SOUND_SQL) + f"SELECT entity, ts, {r6('price / lag(price) OVER (PARTITION BY entity ORDER BY ts) - 1', 'ret')} FROM daily JOIN sound USING (entity)",
)
def _(t: Tables):
    return sr.with_returns(t.sound_daily).select("entity", "ts", "ret")


@query(
    "win2_adjacent_returns", "WIN-2",
    with_clause(PANEL_SQL, "calendar AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS day_index FROM (SELECT DISTINCT ts FROM panel))") + f"""
    SELECT entity, ts, day_index, {r6('CASE WHEN pi = day_index - 1 THEN price / p - 1 END', 'ret')} FROM (
      SELECT entity, ts, day_index, price, lag(price) OVER w AS p, lag(day_index) OVER w AS pi FROM panel JOIN calendar USING (ts) WINDOW w AS (PARTITION BY entity ORDER BY day_index))""",
)
def _(t: Tables):
    return sr.with_adjacent_returns(t.panel, sr.calendar_of(t.panel)).select("entity", "ts", "day_index", "ret")


@query(
    "win3_running_peak", "WIN-3",
    with_clause(PANEL_SQL) + f"SELECT entity, ts, {r6('max(price) OVER (PARTITION BY entity ORDER BY ts ROWS UNBOUNDED PRECEDING)', 'peak')} FROM panel",
)
def _(t: Tables):
    return sr.with_running_peak(t.panel).select("entity", "ts", "peak")


@query(
    "win4_implausible_moves", "WIN-4",
    with_clause(PANEL_SQL) + f"SELECT entity, ts, {r6('price', 'price')}, coalesce(abs(price / lag(price) OVER (PARTITION BY entity ORDER BY ts) - 1) > 0.2, false) AS implausible_move FROM panel",
)
def _(t: Tables):
    return sr.flag_implausible_moves(t.panel).select("entity", "ts", "price", "implausible_move")


@query(
    "win5_stale_prices", "WIN-5",
    with_clause(PANEL_SQL, "steps AS (SELECT entity, ts, floor(price / 150) AS price FROM panel)") + f"""
    SELECT entity, ts, {r6('price', 'price')}, still AND count(*) OVER (PARTITION BY entity, run) - 1 >= 2 AS stale_price FROM (
      SELECT *, sum(CASE WHEN still THEN 0 ELSE 1 END) OVER (PARTITION BY entity ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM (
        SELECT *, coalesce(price = lag(price) OVER (PARTITION BY entity ORDER BY ts), false) AS still FROM steps))""",
)
def _(t: Tables):
    steps = t.panel.select("entity", "ts", F.floor(F.col("price") / 150).cast("double").alias("price"))
    return sr.flag_stale_prices(steps, 2)


AVERAGE_RANK = "rank() OVER (PARTITION BY {g} ORDER BY {v}) + (count(*) OVER (PARTITION BY {g}, {v}) - 1) / 2.0::DOUBLE"


@query(
    "win6_average_rank", "WIN-6",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r6('a', 'rank_in_group')}, {r6('b', 'rank_in_all')} FROM (
      SELECT *, {AVERAGE_RANK.format(g='l_returnflag', v='l_quantity')} AS a, {AVERAGE_RANK.format(g='1', v='l_quantity')} AS b FROM lineitem)""",
)
def _(t: Tables):
    """Over a third of the lines share a flag: ranks come from counts of values sorted in ranges."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = t.lineitem.select(*keys, "l_returnflag", "l_quantity", F.lit(1).alias("_all"))
    grouped = average_rank(lines, ["l_returnflag"], "l_quantity", "rank_in_group")
    return average_rank(grouped, ["_all"], "l_quantity", "rank_in_all").select(*keys, "rank_in_group", "rank_in_all")


@query(
    "win7_group_sizes", "WIN-7 SCO-1",
    with_clause(*FUND_CTES, pools_sql()) + """SELECT profile, entity, CASE WHEN n >= 3 THEN grp ELSE '(universo inteiro)' END AS peer_group,
      CASE WHEN n >= 3 THEN n ELSE total END AS peer_size, total AS pool_size FROM (
      SELECT profile, entity, grp, count(*) OVER (PARTITION BY profile, grp) AS n, count(*) OVER (PARTITION BY profile) AS total FROM pools)""",
)
def _(t: Tables):
    from peervane.operators.peers import profile_pools
    from workload.base import PROFILES

    return with_peer_groups(profile_pools(t.funds, PROFILES), "grp", 3).select(
        "profile", "entity", "peer_group", "peer_size", "pool_size"
    )


@query(
    "sco1_merged_small_groups", "SCO-1",
    with_clause(REGISTRY_SQL) + """SELECT entity, CASE WHEN n >= 4 THEN grp ELSE '(universo inteiro)' END AS peer_group FROM (
      SELECT entity, grp, count(*) OVER (PARTITION BY grp) AS n FROM registry)""",
)
def _(t: Tables):
    whole = t.registry.select("entity", "grp", F.lit("all").alias("profile"))
    return with_peer_groups(whole, "grp", 4).select("entity", "peer_group")
