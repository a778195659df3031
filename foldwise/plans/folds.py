"""Validation splits (V1-V5).

A split turns a table into folds. K-fold style splits add one integer fold
column (a row validates in exactly one fold and trains in the others); time
splits are literal range predicates on a day column (a row can train in
several folds). `pairs(df)` yields `(fold, train_df, valid_df)` lazily either
way, so a training loop never materialises per-fold copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hash_unit
from ..operators.indexing import global_index
from ..operators.ranking import running_totals


def _persisted(df: DataFrame) -> DataFrame:
    """Folds are read once per fold and per learner pass: keep the assigned
    table in memory/disk (rebuilt from lineage if an executor is lost)."""
    from pyspark import StorageLevel

    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        return df
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


class Split:
    fold_col = "fold"

    def assign(self, df: DataFrame) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def pairs(self, df: DataFrame):  # pragma: no cover - abstract
        raise NotImplementedError

    def n_splits(self) -> int:  # pragma: no cover - abstract
        raise NotImplementedError


# ------------------------------------------------------------------ time splits
class DateCutoff(Split):
    """V1: one fold — train `day <= cutoff`, valid `day > cutoff`."""

    def __init__(self, day_col: str, cutoff):
        self.day_col, self.cutoff = day_col, cutoff

    def n_splits(self):
        return 1

    def assign(self, df):
        d = F.col(self.day_col)
        return (df.withColumn(self.fold_col, F.lit(0))
                  .withColumn("role", F.when(d <= F.lit(self.cutoff), "train").when(d > F.lit(self.cutoff), "valid")))

    def pairs(self, df):
        d = F.col(self.day_col)
        df = _persisted(df)
        yield 0, df.where(d <= F.lit(self.cutoff)), df.where(d > F.lit(self.cutoff))


class RollingTime(Split):
    """V2: fold i (rolling backwards): valid = (end − V, end] with
    end = max − i·(V + gap); train = day ≤ end − V − gap. Stops once the train
    end falls before the first day; empty folds are skipped. Bounds come from
    one min/max aggregate; folds are literal range filters."""

    def __init__(self, day_col: str, n_splits: int = 5, valid_duration: int = 7, gap_duration: int = 0):
        if n_splits <= 0 or valid_duration <= 0 or gap_duration < 0:
            raise ValueError("a rolling split takes one fold or more, a validation span of one day or more and no negative gap")
        self.day_col, self.k, self.valid, self.gap = day_col, n_splits, valid_duration, gap_duration
        self.bounds_ = None

    def n_splits(self):
        return self.k

    def fold_bounds(self, df) -> list[tuple]:
        d = F.col(self.day_col).cast("double")
        r = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi")).first()
        out = []
        if r["lo"] is None:
            return out
        for i in range(self.k):
            v_end = r["hi"] - i * (self.valid + self.gap)
            v_start = v_end - self.valid
            t_end = v_start - self.gap
            if t_end < r["lo"]:
                break
            out.append((i, t_end, v_start, v_end))
        return out

    def _preds(self, b):
        d = F.col(self.day_col).cast("double")
        _, t_end, v_start, v_end = b
        return d <= F.lit(t_end), (d > F.lit(v_start)) & (d <= F.lit(v_end))

    def fold_table(self, df) -> DataFrame:
        """(fold, train_end, valid_start, valid_end) for the non-empty folds."""
        spark = df.sparkSession
        bounds = self.fold_bounds(df)
        if not bounds:
            return spark.createDataFrame([], "fold int, train_end double, valid_start double, valid_end double")
        aggs = []
        for b in bounds:
            tr, va = self._preds(b)
            aggs += [F.count_if(tr).alias(f"t{b[0]}"), F.count_if(va).alias(f"v{b[0]}")]
        r = df.agg(*aggs).first()
        rows = [(b[0], float(b[1]), float(b[2]), float(b[3])) for b in bounds if r[f"t{b[0]}"] and r[f"v{b[0]}"]]
        return spark.createDataFrame(rows, "fold int, train_end double, valid_start double, valid_end double")

    def assign(self, df):
        """Long form: one row per (row, fold) the row takes part in."""
        folds = self.fold_table(df).collect()
        d = F.col(self.day_col).cast("double")
        roles = [F.when(d <= F.lit(f["train_end"]), F.struct(F.lit(f["fold"]).alias("fold"), F.lit("train").alias("role")))
                  .when((d > F.lit(f["valid_start"])) & (d <= F.lit(f["valid_end"])),
                        F.struct(F.lit(f["fold"]).alias("fold"), F.lit("valid").alias("role")))
                 for f in folds]
        if not roles:
            return df.withColumn(self.fold_col, F.lit(None).cast("int")).withColumn("role", F.lit(None).cast("string"))
        x = df.select("*", F.explode(F.filter(F.array(*roles), lambda s: s.isNotNull())).alias("__fr"))
        return x.select(*[F.col(f"`{c}`") for c in df.columns],
                        F.col("__fr.fold").alias(self.fold_col), F.col("__fr.role").alias("role"))

    def pairs(self, df):
        df = _persisted(df)
        for f in self.fold_table(df).collect():
            d = F.col(self.day_col).cast("double")
            yield (f["fold"], df.where(d <= F.lit(f["train_end"])),
                   df.where((d > F.lit(f["valid_start"])) & (d <= F.lit(f["valid_end"]))))


# ------------------------------------------------------------------ fold-column splits
class _FoldColumn(Split):
    def __init__(self, n_splits: int = 5):
        self.k = n_splits

    def n_splits(self):
        return self.k

    def pairs(self, df):
        a = _persisted(self.assign(df))
        for i in range(self.k):
            yield i, a.where(F.col(self.fold_col) != i).drop(self.fold_col), \
                a.where(F.col(self.fold_col) == i).drop(self.fold_col)


def _sized_fold(idx, n: int, k: int):
    """Fold of 0-based position idx when n rows are cut into k contiguous
    folds, the first n mod k of them one row larger."""
    q, r = n // k, n % k
    big = r * (q + 1)
    return F.when(idx < F.lit(big), F.floor(idx / F.lit(q + 1))).otherwise(
        F.lit(r) + F.floor((idx - F.lit(big)) / F.lit(max(q, 1)))).cast("int")


def _row_hash(col: str, seed: int):
    """Seeded hash; NULL ids count as the text 'NULL'."""
    return F.coalesce(hash_unit(col, seed), F.pmod(F.xxhash64(F.lit("NULL"), F.lit(seed)), F.lit(1 << 30)))


def _hash_fold(col: str, seed: int, k: int):
    return F.pmod(_row_hash(col, seed), F.lit(k)).cast("int")


class KFold(_FoldColumn):
    """V3: k contiguous folds of sizes differing by at most one row, either
    in `order_col` order or (shuffle) in the order of a seeded md5 hash of
    `id_col`. Positions come from a distributed global index of the rows.
    `exact=False`: the hash modulo k, a projection without shuffle; sizes are
    equal only on average and rows with equal ids share a fold."""

    def __init__(self, n_splits: int = 5, id_col: str = "id", shuffle: bool = True, seed: int = 42,
                 order_col: str | None = None, exact: bool = True):
        super().__init__(n_splits)
        if not exact and not shuffle:
            raise ValueError("folds by hash are shuffled")
        self.exact = exact
        self.id_col, self.shuffle, self.seed, self.order_col = id_col, shuffle, seed, order_col

    def assign(self, df):
        # on the rows themselves: ids may repeat or be NULL
        ic = self.id_col
        if not self.exact:
            return df.withColumn(self.fold_col, _hash_fold(ic, self.seed, self.k))
        if self.shuffle:
            rows, order = df.withColumn("__h", _row_hash(ic, self.seed)), ["__h", ic]
        else:
            rows, order = df, [self.order_col, ic] if self.order_col and self.order_col != ic else [ic]
        n = df.count()
        idx = global_index(rows, order, "__i")
        return idx.withColumn(self.fold_col, _sized_fold(F.col("__i"), n, self.k)).drop("__i", "__h")


class StratifiedKFold(_FoldColumn):
    """V4: within each class, rows in seeded-hash order are dealt round-robin
    to the folds, so every fold keeps the class balance. The position inside a
    class is a distributed running count (a dominant class is not one task)."""

    def __init__(self, n_splits: int = 5, y_col: str = "y", id_col: str = "id", seed: int = 42, exact: bool = True):
        super().__init__(n_splits)
        self.exact = exact
        self.y_col, self.id_col, self.seed = y_col, id_col, seed

    def assign(self, df):
        ic, yc = self.id_col, self.y_col
        # on the rows themselves: ids may repeat or be NULL. Equal keys are told
        # apart by the row's place after the sort
        if not self.exact:
            return df.withColumn(self.fold_col, _hash_fold(ic, self.seed, self.k))
        rows = df.withColumn("__h", _row_hash(ic, self.seed)).withColumn("__y", F.coalesce(
            F.col(yc).cast("string"), F.lit("NULL"))).withColumn("__one", F.lit(1))
        pos = running_totals(rows, ["__y"], [F.col("__h").asc(), F.col(ic).asc()], {"__pos": F.col("__one")})
        return (pos.withColumn(self.fold_col, F.pmod(F.col("__pos") - 1, F.lit(self.k)).cast("int"))
                .drop("__h", "__y", "__one", "__pos"))


class GroupKFold(_FoldColumn):
    """V5: all rows of a group share a fold. `hash` (default): seeded md5 of the
    group; `snake`: groups sorted by size (desc, then key) dealt 0..k−1,
    k−1..0, … for balanced fold sizes (positions from a distributed index over
    the group table)."""

    def __init__(self, n_splits: int = 5, group_col: str = "group", method: str = "hash", seed: int = 42):
        super().__init__(n_splits)
        if method not in ("hash", "snake"):
            raise ValueError("method must be 'hash' or 'snake'")
        self.group_col, self.method, self.seed = group_col, method, seed

    def group_folds(self, df) -> DataFrame:
        g = df.where(F.col(self.group_col).isNotNull()).groupBy(self.group_col).agg(F.count(F.lit(1)).alias("__n"))
        if self.method == "hash":
            return g.select(self.group_col, F.pmod(hash_unit(self.group_col, self.seed), F.lit(self.k))
                            .cast("int").alias(self.fold_col))
        g = g.withColumn("__neg", -F.col("__n"))
        idx = global_index(g, ["__neg", self.group_col], "__i")
        r = F.pmod(F.col("__i"), F.lit(2 * self.k))
        fold = F.when(r < self.k, r).otherwise(F.lit(2 * self.k - 1) - r).cast("int")
        return idx.select(self.group_col, fold.alias(self.fold_col))

    def assign(self, df):
        if self.method == "hash":
            return df.withColumn(self.fold_col,
                                 F.pmod(hash_unit(self.group_col, self.seed), F.lit(self.k)).cast("int"))
        return df.join(self.group_folds(df), self.group_col, "left")
