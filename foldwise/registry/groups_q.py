"""Check queries for group statistics, windows, sort / top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.groups import (GroupStats, RollingStats, distinct_values, global_mean, min_max,
                                top_n_categories, value_counts)
from ..operators.quantiles import global_quantiles, grouped_quantiles
from ..operators.ranking import group_sort_topk, running_hits
from ..sources.io import table
from . import register, tidy

# ------------------------------------------------------------------ A1
_A1_FUNCS = ["mean", "std", "sum", "median", "min", "max", "count", "nunique", "skew", "kurt"]
_A1_SQL = {
    "mean": "avg(value)", "std": "stddev_samp(value)", "sum": "coalesce(sum(value), 0)",
    "median": "quantile_cont(value, 0.5)", "min": "min(value)", "max": "max(value)",
    "count": "count(value)", "nunique": "count(DISTINCT value)",
    "skew": "CASE WHEN var_pop(value) = 0 THEN 0 ELSE skewness(value) END",
    "kurt": "CASE WHEN var_pop(value) = 0 THEN 0 ELSE kurtosis(value) END",
}
# means of 2-decimal values over power-of-two counts sit exactly on a 6-digit
# rounding boundary; 9 digits keeps both engines on the same side.
_A1_DIGITS = {"std": 4, "skew": 4, "kurt": 4, "mean": 9}


def _a1_sql(key: str) -> str:
    aggs = ",\n    ".join(f"{_A1_SQL[f]} AS {key}_{f}_value" for f in _A1_FUNCS)
    outs = []
    for f in _A1_FUNCS:
        n = f"{key}_{f}_value"
        outs.append(f"CAST(g.{n} AS BIGINT) AS {n}" if f in ("count", "nunique")
                    else f"round(g.{n}, {_A1_DIGITS.get(f, 6)}) AS {n}")
    return f"""
WITH g AS (
  SELECT {key},
    {aggs}
  FROM events WHERE {key} IS NOT NULL GROUP BY {key})
SELECT CAST(e.event_id AS BIGINT) AS event_id, e.{key},
  {", ".join(outs)}
FROM events e LEFT JOIN g ON e.{key} = g.{key}"""


def _a1(spark, sf, key):
    ev = table(spark, sf, "events")
    st = GroupStats("a1", [key], ["value"], _A1_FUNCS)
    out = st.fit(ev).transform(ev.select("event_id", key, "value"))
    names = [st.out_name("value", f) for f in _A1_FUNCS]
    return tidy(out.select("event_id", key, *names),
                overrides={st.out_name("value", f): d for f, d in _A1_DIGITS.items()})


@register("group_stats", _a1_sql("user_id"))
def q_group_stats(spark, sf):
    return _a1(spark, sf, "user_id")


@register("group_stats_hot_key", _a1_sql("event_type"))
def q_group_stats_hot_key(spark, sf):
    """Five event types over all rows: each key holds ~1/5 of the table."""
    return _a1(spark, sf, "event_type")


# ------------------------------------------------------------------ A2
_A2_WINDOWS = {"1D": 86_400_000_000, "7D": 7 * 86_400_000_000}
_A2_FUNCS = {"mean": "avg", "sum": "sum", "count": "count"}


def _a2_sql() -> str:
    inner, outer = [], []
    for w, us in _A2_WINDOWS.items():
        for f, fn in _A2_FUNCS.items():
            n = f"user_id_value_rolling_{w}_{f}"
            inner.append(f"{fn}(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) "
                         f"RANGE BETWEEN {us - 1} PRECEDING AND CURRENT ROW) AS r_{n}")
            lag = f"lag(r_{n}) OVER (PARTITION BY user_id ORDER BY ts, event_id)"
            outer.append(f"CAST({lag} AS BIGINT) AS {n}" if f == "count" else f"round({lag}, 6) AS {n}")
    return f"""
WITH r AS (SELECT event_id, user_id, ts, {", ".join(inner)} FROM events)
SELECT CAST(event_id AS BIGINT) AS event_id, user_id, {", ".join(outer)} FROM r"""


@register("rolling_stats", _a2_sql())
def q_rolling_stats(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    st = RollingStats("a2", ["user_id"], "ts", ["value"], list(_A2_WINDOWS), list(_A2_FUNCS),
                      order_col="event_id")
    out = st.transform(ev)
    return tidy(out.drop("ts", "value"))


# ------------------------------------------------------------------ A3-A8
@register("value_counts", """
SELECT event_type, CAST(count(*) AS BIGINT) AS count,
       round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM events WHERE event_type IS NOT NULL GROUP BY event_type""")
def q_value_counts(spark, sf):
    return tidy(value_counts(table(spark, sf, "events"), "event_type", normalize=True))


@register("top_n_categories", """
SELECT p_brand, CAST(count(*) AS BIGINT) AS count FROM part WHERE p_brand IS NOT NULL
GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 5""")
def q_top_n_categories(spark, sf):
    return tidy(top_n_categories(table(spark, sf, "part"), "p_brand", 5))


@register("distinct_values", "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL")
def q_distinct_values(spark, sf):
    return distinct_values(table(spark, sf, "part"), "p_type")


_PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@register("quantiles", "SELECT " + ", ".join(
    f"round(quantile_cont(l_extendedprice, {p}), 6) AS q{int(p * 100)}" for p in _PROBS) + " FROM lineitem")
def q_quantiles(spark, sf):
    qs = global_quantiles(table(spark, sf, "lineitem"), "l_extendedprice", _PROBS)
    return tidy(spark.createDataFrame([tuple(qs)], [f"q{int(p * 100)}" for p in _PROBS]))


@register("grouped_quantiles", "SELECT event_type, " + ", ".join(
    f"round(quantile_cont(value, {p}), 6) AS q{int(p * 100)}" for p in _PROBS)
    + " FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def q_grouped_quantiles(spark, sf):
    st = grouped_quantiles(table(spark, sf, "events"), "value", _PROBS, ["event_type"],
                           [f"q{int(p * 100)}" for p in _PROBS])
    return tidy(st.df)


@register("global_mean", "SELECT round(avg(o_totalprice), 6) AS o_totalprice_mean FROM orders")
def q_global_mean(spark, sf):
    return tidy(global_mean(table(spark, sf, "orders"), "o_totalprice"))


@register("min_max", """
SELECT round(min(l_quantity), 6) AS l_quantity_min, round(max(l_quantity), 6) AS l_quantity_max,
       round(min(l_extendedprice), 6) AS l_extendedprice_min, round(max(l_extendedprice), 6) AS l_extendedprice_max,
       round(min(l_discount), 6) AS l_discount_min, round(max(l_discount), 6) AS l_discount_max
FROM lineitem""")
def q_min_max(spark, sf):
    return tidy(min_max(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


# ------------------------------------------------------------------ A9, A10
@register("group_sort_topk", """
SELECT user_id, CAST(event_id AS BIGINT) AS event_id, round(value, 6) AS value, CAST(rank AS BIGINT) AS rank FROM (
  SELECT user_id, event_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events)
WHERE rank <= 3""")
def q_group_sort_topk(spark, sf):
    ev = table(spark, sf, "events")
    return tidy(group_sort_topk(ev, ["user_id"], "value", 3, tie="event_id").select(
        "user_id", "event_id", "value", "rank"))


@register("running_hits", """
SELECT user_id, CAST(event_id AS BIGINT) AS event_id,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS hits,
  CAST(row_number() OVER w AS BIGINT) AS pos
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY value DESC, event_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_running_hits(spark, sf):
    ev = table(spark, sf, "events").withColumn("rel", (F.col("event_type") == "purchase").cast("int"))
    out = running_hits(ev, ["user_id"], "value", "rel", tie="event_id")
    return tidy(out.select("user_id", "event_id", "hits", "pos"))


def _a2_hot_sql() -> str:
    us = 86_400_000_000
    inner = [f"{fn}(value) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN {us - 1} PRECEDING "
             f"AND CURRENT ROW) AS r_{f}" for f, fn in _A2_FUNCS.items()]
    outer = []
    for f in _A2_FUNCS:
        lag = f"lag(r_{f}) OVER (PARTITION BY event_type ORDER BY ts, event_id)"
        n = f"event_type_value_rolling_1D_{f}"
        # windows of 32/64 rows put 2-decimal means on 6-digit ties: compare means at 9
        digits = 9 if f == "mean" else 6
        outer.append(f"CAST({lag} AS BIGINT) AS {n}" if f == "count" else f"round({lag}, {digits}) AS {n}")
    return f"""
WITH r AS (SELECT event_id, event_type, ts, {", ".join(inner)} FROM events)
SELECT CAST(event_id AS BIGINT) AS event_id, event_type, {", ".join(outer)} FROM r"""


@register("rolling_stats_hot_key", _a2_hot_sql())
def q_rolling_stats_hot_key(spark, sf):
    """A2 keyed by event type (each key ~1/5 of all rows), 1-day windows over
    6-hour buckets: every hot key is spread over many tasks."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    st = RollingStats("a2h", ["event_type"], "ts", ["value"], ["1D"], list(_A2_FUNCS), order_col="event_id",
                      bucket="6h")
    return tidy(st.transform(ev).drop("ts", "value"), overrides={"event_type_value_rolling_1D_mean": 9})
