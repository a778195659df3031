"""Categorical stages.

Category statistics are computed with one `groupBy` per column (partial
aggregation on the map side, so a hot category costs one row per task) into
a state table, which is joined back; it is broadcast only under the row and
byte caps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import md5_mod
from .base import Fitted, LiteralFitted, StatelessStage, Stage, require_columns
from .indexing import global_index
from .state import StateTable, lookup


def _add(df: DataFrame, cols: dict, drop=()) -> DataFrame:
    keep = [F.col(f"`{c}`") for c in df.columns if c not in cols and c not in drop]
    return df.select(*keep, *[e.alias(n) for n, e in cols.items()])


def _counts(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__n"))


# ------------------------------------------------------------------ C1
class RareCategoryCombiner(Stage):
    """Categories seen fewer than `min_count` times (or, when no count is
    given, with a share below `min_freq` of non-NULL rows) and NULL become
    `other_value`; the column is replaced in place."""

    def __init__(self, name: str, cols, min_count: int | None = None, min_freq: float | None = None,
                 other_value: str = "Other"):
        super().__init__(name)
        if min_count is None and min_freq is None:
            raise ValueError("give min_count or min_freq")
        self.cols, self.min_count, self.min_freq, self.other_value = list(cols), min_count, min_freq, other_value

    def fit(self, df):
        require_columns(df, self.cols, self.name)
        keep = {}
        for c in self.cols:
            g = _counts(df, c)
            if self.min_count:
                g = g.where(F.col("__n") >= self.min_count)
            else:
                total = df.where(F.col(c).isNotNull()).count()
                g = g.where(F.col("__n") / F.lit(max(total, 1)) >= self.min_freq)
            keep[c] = StateTable.build(g.select(c))
        return _RareFitted(self, keep)


class _RareFitted(Fitted):
    def __init__(self, stage, keep):
        super().__init__(stage)
        self.keep = keep

    def transform(self, df):
        out = df
        other = F.lit(self.stage.other_value)
        for c, st in self.keep.items():
            # Membership through the state table
            s = st.df.select(F.col(c).alias("__k"), F.lit(True).alias("__in"))
            s = F.broadcast(s) if st.broadcastable() else s
            j = out.join(s, out[c] == s["__k"], "left")
            out = j.select(*[F.col(f"`{x}`") for x in out.columns if x != c],
                           F.when(F.col("__in"), F.col(c).cast("string")).otherwise(other).alias(c))
        return out


# ------------------------------------------------------------------ C2
class OneHotEncoder(Stage):
    """`<c>_ohe_<v>` 0/1 per kept category; with `max_categories`, the N
    most frequent (ties by value) plus `<c>_ohe_other` (also 1 for NULL).
    Without a cap all non-NULL categories are used. `max_columns` is an optional
    guard against wide results. Inputs are dropped."""

    def __init__(self, name: str, cols, max_categories: int | None = None, max_columns: int | None = None):
        super().__init__(name)
        self.cols, self.max_categories, self.max_columns = list(cols), max_categories, max_columns

    def fit(self, df):
        require_columns(df, self.cols, self.name)
        cats = {}
        for c in self.cols:
            g = _counts(df, c)
            if self.max_categories:
                rows = g.orderBy(F.desc("__n"), F.asc(c)).limit(self.max_categories).collect()
            else:
                g = g.orderBy(c)
                rows = (g.limit(self.max_columns + 1) if self.max_columns else g).collect()
                if self.max_columns and len(rows) > self.max_columns:
                    raise ValueError(f"{self.name}: {c} has more than {self.max_columns} categories; "
                                     "set max_categories or use count/target encoding")
            cats[c] = [r[0] for r in rows]

        def build(d, st):
            out = {}
            for c in self.cols:
                for v in st[c]:
                    out[f"{c}_ohe_{v}"] = (F.col(c) == F.lit(v)).eqNullSafe(True).cast("int")
                if self.max_categories:
                    out[f"{c}_ohe_other"] = (~F.coalesce(F.col(c).isin(st[c]), F.lit(False))).cast("int")
            return _add(d, out, drop=self.cols)

        return LiteralFitted(self, cats, build)


# ------------------------------------------------------------------ C3
class CountFrequencyEncoder(Stage):
    """`<c>_count` (or `<c>_freq`, share of non-NULL rows); unseen / NULL → 0."""

    def __init__(self, name: str, cols, normalize: bool = False):
        super().__init__(name)
        self.cols, self.normalize = list(cols), normalize
        self.suffix = "_freq" if normalize else "_count"

    def fit(self, df):
        require_columns(df, self.cols, self.name)
        states = {}
        for c in self.cols:
            g = _counts(df, c)
            if self.normalize:
                total = df.where(F.col(c).isNotNull()).count()
                g = g.select(c, (F.col("__n") / F.lit(float(max(total, 1)))).alias("__v"))
            else:
                g = g.select(c, F.col("__n").alias("__v"))
            states[c] = StateTable.build(g)
        return _LookupFitted(self, states, {c: (f"{c}{self.suffix}", 0) for c in self.cols}, drop=False)


class _LookupFitted(Fitted):
    """Map each column through its state table (`__v`), default when unseen."""

    def __init__(self, stage, states, outs, drop: bool):
        super().__init__(stage)
        self.states, self.outs, self.drop = states, outs, drop

    def transform(self, df):
        out = df
        for c, st in self.states.items():
            name, default = self.outs[c]
            out = lookup(out, st, c, c, {name: ("__v", default)})
        if self.drop:
            out = out.drop(*self.states.keys())
        return out


# ------------------------------------------------------------------ C4
class HashingEncoder(StatelessStage):
    """C4: `<name>_hash_i` counters; each column's value (as text, NULL as
    'nan') adds 1 to bucket int(md5(value), 16) mod N. Inputs are dropped."""

    def __init__(self, name: str, cols, n_components: int = 8):
        super().__init__(name)
        self.cols, self.n = list(cols), int(n_components)

    def apply(self, df):
        require_columns(df, self.cols, self.name)
        buckets = [md5_mod(F.coalesce(F.col(c).cast("string"), F.lit("nan")), self.n) for c in self.cols]
        out = {}
        for i in range(self.n):
            s = None
            for b in buckets:
                t = (b == F.lit(i)).cast("int")
                s = t if s is None else s + t
            out[f"{self.name}_hash_{i}"] = s
        return _add(df, out, drop=self.cols)


# ------------------------------------------------------------------ C5
class OrdinalEncoder(Stage):
    """`<c>_ordinal` from a given mapping, else codes 0..K-1 in ascending
    value order, or with `order_col` in the order of first appearance by that
    column (ties by value; values that never have one come last); unseen and
    NULL → `unknown_value`. Inputs are dropped."""

    def __init__(self, name: str, cols, mapping: dict | None = None, unknown_value: int = -1,
                 order_col: str | None = None):
        super().__init__(name)
        self.cols, self.mapping, self.unknown_value = list(cols), mapping or {}, unknown_value
        self.order_col = order_col

    def fit(self, df):
        require_columns(df, self.cols, self.name)
        spark = df.sparkSession
        states = {}
        for c in self.cols:
            if c in self.mapping:
                rows = list(self.mapping[c].items())
                g = spark.createDataFrame(rows, f"k string, __v int").withColumnRenamed("k", c)
            else:
                d, order = df.where(F.col(c).isNotNull()), [F.col(c)]
                if self.order_col:
                    d = d.groupBy(c).agg(F.min(self.order_col).alias("__first"))
                    order = [F.col("__first").asc_nulls_last(), F.col(c)]
                else:
                    d = d.select(c).distinct()
                g = global_index(d, order, "__v").select(c, F.col("__v").cast("int").alias("__v"))
            states[c] = StateTable.build(g)
        return _LookupFitted(self, states, {c: (f"{c}_ordinal", self.unknown_value) for c in self.cols},
                             drop=True)


# ------------------------------------------------------------------ C6, C7
class TargetEncoder(Stage):
    """`<c>_te` = (mean·n + global·s)/(n + s); unseen → global mean.
    Inputs are dropped.

    With `fold_col`, rows that carry a fold are encoded out of fold: their
    statistics (and the global mean) come from the other folds only —
    category totals minus the fold's own share, both small grouped tables —
    so a row never sees its own target. Rows without a fold (test rows) get
    the full-data encoding."""

    def __init__(self, name: str, cols, target_col: str, smoothing_strength: float = 20.0,
                 fold_col: str | None = None):
        super().__init__(name)
        self.cols, self.target_col, self.s = list(cols), target_col, float(smoothing_strength)
        self.fold_col = fold_col

    def fit(self, df):
        if self.fold_col is not None:
            return self._fit_oof(df)
        require_columns(df, self.cols + [self.target_col], self.name)
        y = F.col(self.target_col).try_cast("double")
        gm = df.agg(F.avg(y)).first()[0]
        states = {}
        for c in self.cols:
            g = (df.where(F.col(c).isNotNull()).groupBy(c)
                   .agg(F.avg(y).alias("__m"), F.count(y).alias("__c")))
            g = g.select(c, ((F.col("__m") * F.col("__c") + F.lit(gm) * F.lit(self.s))
                             / (F.col("__c") + F.lit(self.s))).alias("__v"))
            states[c] = StateTable.build(g)
        self.global_mean_ = gm
        return _LookupFitted(self, states, {c: (f"{c}_te", gm) for c in self.cols}, drop=True)


    def _fit_oof(self, df):
        fc = self.fold_col
        require_columns(df, self.cols + [self.target_col, fc], self.name)
        y = F.col(self.target_col).try_cast("double")
        base = df.where(y.isNotNull())
        folds = {r[0]: (r[1], r[2]) for r in base.where(F.col(fc).isNotNull()).groupBy(fc)
                 .agg(F.sum(y), F.count(y)).collect()}  # one row per fold
        tot = base.agg(F.sum(y), F.count(y)).first()
        states = {}
        for c in self.cols:
            src = base.where(F.col(c).isNotNull())
            cat = src.groupBy(c).agg(F.sum(y).alias("__S"), F.count(y).alias("__N"))
            catf = src.where(F.col(fc).isNotNull()).groupBy(c, fc).agg(F.sum(y).alias("__Sf"),
                                                                        F.count(y).alias("__Nf"))
            states[c] = (StateTable.build(cat), StateTable.build(catf))
        return _OofTargetFitted(self, states, folds, (tot[0], tot[1]))


class _OofTargetFitted(Fitted):
    def __init__(self, stage, states, folds, total):
        super().__init__(stage)
        self.states, self.folds, self.total = states, folds, total

    def transform(self, df):
        s, fc = self.stage, self.stage.fold_col
        S, N = self.total
        gm_all = S / N if N else None
        # out-of-fold global mean per fold (k literals)
        gmap = F.create_map(*[x for f, (sf, nf) in self.folds.items()
                              for x in (F.lit(f), F.lit((S - sf) / (N - nf) if N - nf else None))])
        out = df
        for c, (cat, catf) in self.states.items():
            a = cat.df.select(F.col(c).alias("__k1"), "__S", "__N")
            b = catf.df.select(F.col(c).alias("__k2"), F.col(fc).alias("__f2"), "__Sf", "__Nf")
            a = F.broadcast(a) if cat.broadcastable() else a
            b = F.broadcast(b) if catf.broadcastable() else b
            j = out.join(a, out[c] == a["__k1"], "left")
            j = j.join(b, (j[c] == b["__k2"]) & (j[fc] == b["__f2"]), "left")
            in_fold = F.col(fc).isNotNull()
            g = F.when(in_fold, gmap[F.col(fc)]).otherwise(F.lit(gm_all))
            ss = F.coalesce(F.col("__S"), F.lit(0.0)) - F.when(in_fold, F.coalesce(F.col("__Sf"), F.lit(0.0))).otherwise(0.0)
            nn = F.coalesce(F.col("__N"), F.lit(0)) - F.when(in_fold, F.coalesce(F.col("__Nf"), F.lit(0))).otherwise(0)
            te = F.when(nn > 0, (ss + g * F.lit(s.s)) / (nn + F.lit(s.s))).otherwise(g)
            out = j.select(*[F.col(f"`{x}`") for x in out.columns], te.alias(f"{c}_te"))
        return out.drop(*self.states.keys())


class WoEEncoder(Stage):
    """`<c>_woe` = ln(((pos+ε)/P) / ((neg+ε)/N)); the target must be 0/1;
    unseen → 0. Inputs are dropped."""

    def __init__(self, name: str, cols, target_col: str, epsilon: float = 1e-6):
        super().__init__(name)
        self.cols, self.target_col, self.eps = list(cols), target_col, float(epsilon)

    def fit(self, df):
        require_columns(df, self.cols + [self.target_col], self.name)
        t = F.col(self.target_col)
        r = df.agg(F.count_if(t.isNull() | ~t.isin(0, 1)).alias("bad"), F.sum(t).alias("pos"),
                   F.count(F.lit(1)).alias("n")).first()
        if r["bad"]:  # R10
            raise ValueError(f"{self.name}: WoE needs a binary 0/1 target")
        P, N = float(r["pos"] or 0), float(r["n"] - (r["pos"] or 0))
        states = {}
        for c in self.cols:
            g = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__n"),
                                                              F.sum(t).alias("__p"))
            # a target class absent from the fit data gives NULL (→ the unseen default), not an error
            woe = F.log(F.try_divide(F.try_divide(F.col("__p") + F.lit(self.eps), F.lit(P)),
                                     F.try_divide(F.col("__n") - F.col("__p") + F.lit(self.eps), F.lit(N))))
            states[c] = StateTable.build(g.select(c, woe.alias("__v")))
        return _LookupFitted(self, states, {c: (f"{c}_woe", 0.0) for c in self.cols}, drop=True)


# ------------------------------------------------------------------ C8
class CategoricalInteraction(StatelessStage):
    """For each group of columns, their text values joined with `_`
    (NULL as 'nan'); the new column is named by the joined column names."""

    def __init__(self, name: str, cols):
        super().__init__(name)
        self.groups = [list(g) for g in cols]

    def apply(self, df):
        require_columns(df, [c for g in self.groups for c in g], self.name)
        out = {"_".join(g): F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in g])
               for g in self.groups}
        return _add(df, out)
