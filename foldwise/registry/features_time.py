"""Check queries for date / time stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.temporal import DateDifference, DatetimeFeatures
from ..sources.io import table
from . import register, tidy

_PART_SQL = {"year": "year({c})", "month": "month({c})", "day": "day({c})", "hour": "hour({c})",
             "minute": "minute({c})", "second": "second({c})", "weekday": "isodow({c}) - 1",
             "dayofyear": "dayofyear({c})", "weekofyear": "weekofyear({c})", "quarter": "quarter({c})"}


def _parts_sql(c):
    outs = [f"CAST({e.format(c=c)} AS BIGINT) AS {c}_{p}" for p, e in _PART_SQL.items()]
    outs += [f"CAST(coalesce(isodow({c}) - 1 >= 5, false) AS BIGINT) AS {c}_is_weekend",
             f"CAST(coalesce(day({c}) = 1, false) AS BIGINT) AS {c}_is_month_start",
             f"CAST(coalesce(CAST({c} AS DATE) = last_day({c}), false) AS BIGINT) AS {c}_is_month_end",
             f"CASE WHEN hour({c}) < 6 THEN 'Night' WHEN hour({c}) < 12 THEN 'Morning' "
             f"WHEN hour({c}) < 18 THEN 'Afternoon' WHEN hour({c}) < 24 THEN 'Evening' END AS {c}_time_of_day"]
    for p, per, e in (("month", 12, "month({c})"), ("weekday", 7, "(isodow({c}) - 1)"), ("hour", 24, "hour({c})")):
        ang = f"(2 * pi() * {e.format(c=c)} / {per})"
        outs += [f"round(sin({ang}), 6) AS {c}_{p}_sin", f"round(cos({ang}), 6) AS {c}_{p}_cos"]
    return ",\n  ".join(outs)


_ALL = ["year", "month", "day", "hour", "minute", "second", "weekday", "dayofyear", "weekofyear", "quarter",
        "is_weekend", "is_month_start", "is_month_end", "time_of_day", "cyclical"]


@register("date_parts", f"SELECT CAST(event_id AS BIGINT) AS event_id,\n  {_parts_sql('ts')}\nFROM events")
def q_date_parts(spark, sf):
    """T1-T4 on `events.ts` (all components)."""
    ev = table(spark, sf, "events").select("event_id", "ts")
    return tidy(DatetimeFeatures("t1", ["ts"], _ALL).transform(ev).drop("ts"))


@register("date_parts_orders", f"SELECT o_orderkey,\n  {_parts_sql('o_orderdate')}\nFROM orders")
def q_date_parts_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return tidy(DatetimeFeatures("t1o", ["o_orderdate"], _ALL).transform(o).drop("o_orderdate"))


@register("date_diff", """
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber,
  round((epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate)) / 1e6 / 86400.0, 6) AS l_shipdate_minus_o_orderdate_in_D,
  round((epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate)) / 1e6 / 3600.0, 6) AS l_shipdate_minus_o_orderdate_in_h
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_date_diff(spark, sf):
    """T5 after joining each line to its order (ship date − order date)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = li.join(o, "l_orderkey")
    j = DateDifference("t5d", "l_shipdate", "o_orderdate", "D").transform(j)
    j = DateDifference("t5h", "l_shipdate", "o_orderdate", "h").transform(j)
    return tidy(j.drop("l_shipdate", "o_orderdate"))


@register("date_flags", """SELECT o_orderkey, CAST(coalesce(isodow(o_orderdate) - 1 >= 5, false) AS BIGINT) AS o_orderdate_is_weekend,
  CAST(coalesce(day(o_orderdate) = 1, false) AS BIGINT) AS o_orderdate_is_month_start,
  CAST(coalesce(CAST(o_orderdate AS DATE) = last_day(o_orderdate), false) AS BIGINT) AS o_orderdate_is_month_end
FROM orders""")
def q_date_flags(spark, sf):
    """Weekend / month start / month end flags."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    st = DatetimeFeatures("t2", ["o_orderdate"], ["is_weekend", "is_month_start", "is_month_end"])
    return tidy(st.transform(o).drop("o_orderdate"))


@register("time_of_day", """SELECT CAST(event_id AS BIGINT) AS event_id,
  CASE WHEN hour(ts) < 6 THEN 'Night' WHEN hour(ts) < 12 THEN 'Morning' WHEN hour(ts) < 18 THEN 'Afternoon'
       WHEN hour(ts) < 24 THEN 'Evening' END AS ts_time_of_day FROM events""")
def q_time_of_day(spark, sf):
    """T3."""
    ev = table(spark, sf, "events").select("event_id", "ts")
    return tidy(DatetimeFeatures("t3", ["ts"], ["time_of_day"]).transform(ev).drop("ts"))


@register("cyclical", """SELECT CAST(event_id AS BIGINT) AS event_id, CAST(hour(ts) AS BIGINT) AS ts_hour,
  round(sin(2 * pi() * hour(ts) / 24), 6) AS ts_hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) AS ts_hour_cos
FROM events""")
def q_cyclical(spark, sf):
    """T4: sin/cos only for the requested parts (hour here)."""
    ev = table(spark, sf, "events").select("event_id", "ts")
    return tidy(DatetimeFeatures("t4", ["ts"], ["hour", "cyclical"]).transform(ev).drop("ts"))
