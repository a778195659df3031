"""Date / time stages (T1-T5). All stateless column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import TWO_PI, ts_micros
from .base import StatelessStage, require_columns

PARTS = ("year", "month", "day", "hour", "minute", "second", "weekday", "dayofyear", "weekofyear", "quarter")
FLAGS = ("is_weekend", "is_month_start", "is_month_end")
COMPONENTS = PARTS + FLAGS + ("time_of_day", "cyclical")


def as_timestamp(df, c: str):
    """Lenient conversion: timestamps pass through, strings are parsed with
    `try_to_timestamp` (unparseable → NULL), dates are widened."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.col(c)
    if isinstance(dt, T.StringType):
        return F.try_to_timestamp(F.col(c))
    return F.col(c).cast("timestamp")


class DatetimeFeatures(StatelessStage):
    """Calendar parts (weekday Monday = 0, ISO week), 0/1 calendar
    flags (NULL → 0), a time-of-day label and sin/cos encodings of month,
    weekday and hour (only for the parts that were requested)."""

    def __init__(self, name: str, cols, components):
        super().__init__(name)
        bad = set(components) - set(COMPONENTS)
        if bad:
            raise ValueError(f"unsupported components {sorted(bad)}")
        self.cols, self.components = list(cols), list(dict.fromkeys(components))

    def apply(self, df):
        require_columns(df, self.cols, self.name)
        out = {}
        want = set(self.components)
        for c in self.cols:
            t = as_timestamp(df, c)
            wd = F.weekday(t)
            parts = {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t),
                     "minute": F.minute(t), "second": F.second(t), "weekday": wd, "dayofyear": F.dayofyear(t),
                     "weekofyear": F.weekofyear(t), "quarter": F.quarter(t)}
            for p in PARTS:
                if p in want:
                    out[f"{c}_{p}"] = parts[p]
            if "is_weekend" in want:
                out[f"{c}_is_weekend"] = F.coalesce((wd >= 5).cast("int"), F.lit(0))
            if "is_month_start" in want:
                out[f"{c}_is_month_start"] = F.coalesce((F.dayofmonth(t) == 1).cast("int"), F.lit(0))
            if "is_month_end" in want:
                out[f"{c}_is_month_end"] = F.coalesce((F.to_date(t) == F.last_day(t)).cast("int"), F.lit(0))
            if "time_of_day" in want:
                h = F.hour(t)
                out[f"{c}_time_of_day"] = (F.when(h < 6, "Night").when(h < 12, "Morning")
                                            .when(h < 18, "Afternoon").when(h < 24, "Evening"))
            if "cyclical" in want:
                for p, period in (("month", 12), ("weekday", 7), ("hour", 24)):
                    if p in want:
                        ang = F.lit(TWO_PI) * parts[p] / F.lit(period)
                        out[f"{c}_{p}_sin"] = F.sin(ang)
                        out[f"{c}_{p}_cos"] = F.cos(ang)
        keep = [F.col(f"`{x}`") for x in df.columns if x not in out]
        return df.select(*keep, *[e.alias(n) for n, e in out.items()])


UNITS = {"D": 86400.0, "h": 3600.0, "m": 60.0, "s": 1.0}


class DateDifference(StatelessStage):
    """T5: `<a>_minus_<b>_in_<unit>` = (a − b) in days / hours / minutes /
    seconds as a double."""

    def __init__(self, name: str, col1: str, col2: str, unit: str = "D"):
        super().__init__(name)
        if unit not in UNITS:
            raise ValueError(f"unsupported unit {unit!r}; use one of {sorted(UNITS)}")
        self.col1, self.col2, self.unit = col1, col2, unit

    def apply(self, df):
        require_columns(df, [self.col1, self.col2], self.name)
        a, b = as_timestamp(df, self.col1), as_timestamp(df, self.col2)
        secs = (ts_micros(a) - ts_micros(b)) / F.lit(1e6)
        return df.withColumn(f"{self.col1}_minus_{self.col2}_in_{self.unit}", secs / F.lit(UNITS[self.unit]))
