"""Check queries for validation splits (V1-V5), per-fold scores (P10) and the
fold / feature summaries (A11-A13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import day_number
from ..operators.metrics import Rmse
from ..plans.folds import DateCutoff, GroupKFold, KFold, RollingTime, StratifiedKFold
from ..plans.flows import feature_ranking, fold_summary
from ..sources.io import table
from . import register, tidy


def _events(spark, sf):
    ev = table(spark, sf, "events")
    return ev.withColumn("day", day_number("ts", "2024-01-01"))


_DAY = "CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT)"


def _hash_sql(col, seed=42):
    return f"CAST(('0x' || substr(md5('{seed}|' || CAST({col} AS VARCHAR)), 1, 8)) AS BIGINT)"


def _sized_sql(idx, n, k):
    return (f"CAST(CASE WHEN {idx} < ({n} % {k}) * ({n} // {k} + 1) THEN floor({idx} / ({n} // {k} + 1)) "
            f"ELSE ({n} % {k}) + floor(({idx} - ({n} % {k}) * ({n} // {k} + 1)) / greatest({n} // {k}, 1)) END AS BIGINT)")


@register("split_date_cutoff", f"""
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(0 AS BIGINT) AS fold,
  CASE WHEN {_DAY} <= 20 THEN 'train' ELSE 'valid' END AS role FROM events""")
def q_split_date_cutoff(spark, sf):
    a = DateCutoff("day", 20).assign(_events(spark, sf))
    return tidy(a.select("event_id", "fold", "role"))


@register("split_rolling_time", f"""
WITH d AS (SELECT event_id, CAST({_DAY} AS DOUBLE) AS day FROM events),
b AS (SELECT min(day) AS lo, max(day) AS hi FROM d),
f AS (SELECT i AS fold, hi - i * 7 - 5 - 2 AS train_end, hi - i * 7 - 5 AS vs, hi - i * 7 AS ve, lo
      FROM b, range(0, 3) r(i)),
ok AS (SELECT * FROM f WHERE train_end >= lo
       AND fold < coalesce((SELECT min(fold) FROM f WHERE train_end < lo), 1000000)),
x AS (SELECT d.event_id, ok.fold, CASE WHEN d.day <= ok.train_end THEN 'train'
        WHEN d.day > ok.vs AND d.day <= ok.ve THEN 'valid' END AS role FROM d, ok),
ne AS (SELECT fold FROM x GROUP BY fold HAVING count_if(role = 'train') > 0 AND count_if(role = 'valid') > 0)
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(fold AS BIGINT) AS fold, role FROM x
WHERE role IS NOT NULL AND fold IN (SELECT fold FROM ne)""")
def q_split_rolling_time(spark, sf):
    """3 folds, valid 5 days, gap 2 days, rolling back from the last day."""
    a = RollingTime("day", n_splits=3, valid_duration=5, gap_duration=2).assign(_events(spark, sf))
    return tidy(a.select("event_id", "fold", "role"))


@register("split_kfold", f"""
WITH n AS (SELECT count(*) AS n FROM events),
o AS (SELECT event_id, row_number() OVER (ORDER BY {_hash_sql('event_id')}, event_id) - 1 AS i FROM events)
SELECT CAST(event_id AS BIGINT) AS event_id, {_sized_sql('i', 'n.n', 5)} AS fold FROM o, n""")
def q_split_kfold(spark, sf):
    a = KFold(5, id_col="event_id", shuffle=True, seed=42).assign(table(spark, sf, "events"))
    return tidy(a.select("event_id", "fold"))


@register("split_kfold_ordered", f"""
WITH n AS (SELECT count(*) AS n FROM events),
o AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i FROM events)
SELECT CAST(event_id AS BIGINT) AS event_id, {_sized_sql('i', 'n.n', 5)} AS fold FROM o, n""")
def q_split_kfold_ordered(spark, sf):
    a = KFold(5, id_col="event_id", shuffle=False, order_col="ts").assign(table(spark, sf, "events"))
    return tidy(a.select("event_id", "fold"))


@register("split_stratified", f"""
SELECT CAST(event_id AS BIGINT) AS event_id, event_type,
  CAST((row_number() OVER (PARTITION BY event_type ORDER BY {_hash_sql('event_id')}, event_id) - 1) % 5 AS BIGINT) AS fold
FROM events""")
def q_split_stratified(spark, sf):
    a = StratifiedKFold(5, y_col="event_type", id_col="event_id").assign(table(spark, sf, "events"))
    return tidy(a.select("event_id", "event_type", "fold"))


@register("split_group", f"""
SELECT CAST(event_id AS BIGINT) AS event_id, user_id, CAST({_hash_sql('user_id')} % 5 AS BIGINT) AS fold FROM events""")
def q_split_group(spark, sf):
    a = GroupKFold(5, group_col="user_id").assign(table(spark, sf, "events"))
    return tidy(a.select("event_id", "user_id", "fold"))


@register("split_group_snake", """
WITH g AS (SELECT user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
o AS (SELECT user_id, (row_number() OVER (ORDER BY n DESC, user_id) - 1) % 10 AS r FROM g)
SELECT CAST(e.event_id AS BIGINT) AS event_id, e.user_id,
  CAST(CASE WHEN o.r < 5 THEN o.r ELSE 9 - o.r END AS BIGINT) AS fold
FROM events e LEFT JOIN o ON e.user_id = o.user_id""")
def q_split_group_snake(spark, sf):
    a = GroupKFold(5, group_col="user_id", method="snake").assign(table(spark, sf, "events"))
    return tidy(a.select("event_id", "user_id", "fold"))


# ------------------------------------------------------------------ P10, A11-A13
def _li_folds(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("p", F.col("l_quantity") * 1500.0)
    return GroupKFold(5, group_col="l_orderkey").assign(li)


_LI_FOLD = f"""b AS (SELECT l_extendedprice AS y, l_quantity * 1500.0 AS p,
                    l_quantity, l_discount, l_tax, {_hash_sql('l_orderkey')} % 5 AS fold FROM lineitem)"""


@register("fold_scores", f"""WITH {_LI_FOLD}
SELECT CAST(fold AS BIGINT) AS fold, round(sqrt(avg(power(y - p, 2))), 6) AS score FROM b GROUP BY fold""")
def q_fold_scores(spark, sf):
    """P10: RMSE per fold (orders kept whole within a fold)."""
    return tidy(Rmse().frame(_li_folds(spark, sf), "l_extendedprice", "p", by=["fold"]))


@register("fold_mean_std", f"""WITH {_LI_FOLD},
s AS (SELECT fold, sqrt(avg(power(y - p, 2))) AS score FROM b GROUP BY fold)
SELECT round(avg(score), 6) AS mean_score, round(stddev_pop(score), 4) AS std_score,
       CAST(count(*) AS BIGINT) AS n_folds FROM s""")
def q_fold_mean_std(spark, sf):
    """Mean and population std of the per-fold scores."""
    scores = Rmse().frame(_li_folds(spark, sf), "l_extendedprice", "p", by=["fold"])
    return tidy(fold_summary(scores), overrides={"std_score": 4})


_FEATS = ["l_quantity", "l_discount", "l_tax"]


@register("feature_ranking", f"""WITH {_LI_FOLD},
imp AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, fold, abs(corr({c}, y)) AS imp FROM b GROUP BY fold" for c in _FEATS)}),
m AS (SELECT feature, avg(imp) AS mean_importance FROM imp GROUP BY feature)
SELECT feature, round(mean_importance, 6) AS mean_importance FROM m ORDER BY mean_importance DESC, feature LIMIT 2""")
def q_feature_ranking(spark, sf):
    """A12 + A11: per-fold importances (|corr| with the target) in long form,
    mean per feature, top 2."""
    folds = _li_folds(spark, sf)
    imp = None
    for c in _FEATS:
        part = folds.groupBy("fold").agg(F.abs(F.corr(c, "l_extendedprice")).alias("importance")) \
                    .withColumn("feature", F.lit(c))
        imp = part if imp is None else imp.unionByName(part)
    return tidy(feature_ranking(imp, top_n=2))


_IMP_SQL = f"""WITH {_LI_FOLD},
imp AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, fold, abs(corr({c}, y)) AS imp FROM b GROUP BY fold" for c in _FEATS)})"""


def _importances(spark, sf):
    folds = _li_folds(spark, sf)
    parts = [folds.groupBy("fold").agg(F.abs(F.corr(c, "l_extendedprice")).alias("importance"))
             .withColumn("feature", F.lit(c)) for c in _FEATS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("row_mean", f"{_IMP_SQL}\nSELECT feature, round(avg(imp), 6) AS mean_importance FROM imp GROUP BY feature")
def q_row_mean(spark, sf):
    """Mean over folds per feature (long table, no wide row mean)."""
    return tidy(feature_ranking(_importances(spark, sf)))


@register("global_top_n", f"{_IMP_SQL}\nSELECT feature, round(avg(imp), 6) AS mean_importance FROM imp GROUP BY feature "
                          "ORDER BY avg(imp) DESC, feature LIMIT 1")
def q_global_top_n(spark, sf):
    """The single best feature."""
    return tidy(feature_ranking(_importances(spark, sf), top_n=1))


@register("split_kfold_repeated_ids", f"""
WITH n AS (SELECT count(*) AS n FROM lineitem), r AS (SELECT unnest(range(0, (SELECT n FROM n))) AS i)
SELECT {_sized_sql('i', 'n.n', 5)} AS fold, count(*) AS n_rows FROM r, n GROUP BY 1""")
def q_split_kfold_repeated_ids(spark, sf):
    """V3 by an id that repeats: no row is lost or doubled."""
    a = KFold(5, id_col="l_orderkey", shuffle=True, seed=42).assign(table(spark, sf, "lineitem"))
    return tidy(a.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows")))


@register("split_kfold_hash", f"""
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST({_hash_sql('l_orderkey')} % 5 AS BIGINT) AS fold FROM lineitem""")
def q_split_kfold_hash(spark, sf):
    """V3 as a projection: hash modulo k, no shuffle."""
    a = KFold(5, id_col="l_orderkey", exact=False).assign(table(spark, sf, "lineitem"))
    return tidy(a.select("l_orderkey", "l_linenumber", "fold"))
