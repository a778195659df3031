"""Stage contract: `Stage.fit(df) -> Fitted`, `Fitted.transform(df) -> DataFrame`.

Fitted state is either a handful of literals collected from one aggregate row
(edges, means, bounds) or a small *state table* DataFrame that is joined back.
Transforms are lazy: they only add expressions / joins to the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

TRAIN = "train"
COMBINED = "combined"


class Fitted:
    """Result of `Stage.fit`; applies the learned state to any DataFrame."""

    def __init__(self, stage: "Stage"):
        self.stage = stage

    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    # streaming compatibility: stages whose state is literals or a static
    # state table can be applied to a streaming DataFrame unchanged.
    streamable = True

    def release(self) -> None:
        """Unpersist every persisted DataFrame this fitted stage holds (state
        tables, indexes). Transforms built afterwards recompute the state
        from lineage, so call it when the stage is no longer applied."""
        from pyspark.sql import DataFrame as _DF

        def drop(obj, depth=0):
            if depth > 3:
                return
            if isinstance(obj, _DF):
                obj.unpersist()
            elif hasattr(obj, "df") and isinstance(getattr(obj, "df"), _DF):
                obj.df.unpersist()
            elif isinstance(obj, dict):
                for v in obj.values():
                    drop(v, depth + 1)
            elif isinstance(obj, (list, tuple)):
                for v in obj:
                    drop(v, depth + 1)
            elif hasattr(obj, "__dict__") and not isinstance(obj, type) and depth < 2 and obj is not self.stage:
                for v in vars(obj).values():
                    drop(v, depth + 1)

        for k, v in vars(self).items():
            if k != "stage":
                drop(v)


class Stage:
    """Base class of every feature stage.

    `fit_scope` tells the feature-set builder what to fit on: `train` (default)
    or `combined` (train ∪ test, e.g. group statistics).
    """

    fit_scope = TRAIN

    def __init__(self, name: str):
        self.name = name

    def fit(self, df: DataFrame) -> Fitted:  # pragma: no cover - abstract
        raise NotImplementedError

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def __repr__(self) -> str:
        return f"{type(self).__name__}({self.name!r})"


class _StatelessFitted(Fitted):
    def transform(self, df: DataFrame) -> DataFrame:
        return self.stage.apply(df)


class StatelessStage(Stage):
    """A stage with nothing to learn: fit is free, `apply` does the work."""

    def fit(self, df: DataFrame) -> Fitted:
        return _StatelessFitted(self)

    def apply(self, df: DataFrame) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        return self.apply(df)


class LiteralFitted(Fitted):
    """Fitted state held as driver-side literals; transform is one `select`."""

    def __init__(self, stage: "Stage", state: dict, build):
        super().__init__(stage)
        self.state = state
        self._build = build

    def transform(self, df: DataFrame) -> DataFrame:
        return self._build(df, self.state)


class AggregateFit:
    """Mixin for stages whose fit is ONE global aggregate row. The feature-set
    builder fuses consecutive such fits (same fit scope, inputs not produced
    inside the run) into a single `agg` job: each stage contributes
    expressions aliased under its own prefix and then builds its fitted state
    from the shared row."""

    def fit_inputs(self) -> list[str]:  # pragma: no cover - abstract
        raise NotImplementedError

    def fit_aggs(self, prefix: str) -> list:  # pragma: no cover - abstract
        raise NotImplementedError

    def from_row(self, row, prefix: str) -> Fitted:  # pragma: no cover - abstract
        raise NotImplementedError

    def fit(self, df: DataFrame) -> Fitted:
        require_columns(df, self.fit_inputs(), getattr(self, "name", "stage"))
        return self.from_row(df.agg(*self.fit_aggs("")).first(), "")


def require_columns(df: DataFrame, cols, where: str = "") -> None:
    """Fail early (no job) when a configured column is absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{where or 'stage'}: column(s) not found: {missing}")
