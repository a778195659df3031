"""User-defined stages.

A custom stage is a plain subclass of `Stage` / `StatelessStage` imported like
any other module — no registry or folder scanning. The two examples below are
the kind of stage users add: a regex extraction and a ratio.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .base import StatelessStage, require_columns


class ExpressionStage(StatelessStage):
    """New columns from Spark SQL expressions, `{output: "sql expr"}`."""

    def __init__(self, name: str, exprs: dict[str, str]):
        super().__init__(name)
        self.exprs = dict(exprs)

    def apply(self, df):
        return df.select("*", *[F.expr(e).alias(n) for n, e in self.exprs.items()])


class RegexExtractStage(StatelessStage):
    """First capture group of a pattern (no match → NULL), e.g. a title
    such as "Mr" from " Mr." in a name."""

    def __init__(self, name: str, col: str, pattern: str = r" ([A-Za-z]+)\.", out: str | None = None):
        super().__init__(name)
        self.col, self.pattern, self.out = col, pattern, out or f"{col}_title"

    def apply(self, df):
        require_columns(df, [self.col], self.name)
        v = F.regexp_extract(F.col(self.col), self.pattern, 1)
        return df.withColumn(self.out, F.when(v != "", v))


class RatioStage(StatelessStage):
    """`a / (b + eps)`."""

    def __init__(self, name: str, numerator: str, denominator: str, eps: float = 1e-6, out: str | None = None):
        super().__init__(name)
        self.a, self.b, self.eps = numerator, denominator, eps
        self.out = out or f"{numerator}_per_{denominator}"

    def apply(self, df):
        require_columns(df, [self.a, self.b], self.name)
        return df.withColumn(self.out, F.try_divide(F.col(self.a), F.col(self.b) + F.lit(self.eps)))
