"""Check queries for categorical stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.categorical import (CategoricalInteraction, CountFrequencyEncoder, HashingEncoder,
                                     OneHotEncoder, OrdinalEncoder, RareCategoryCombiner, TargetEncoder,
                                     WoEEncoder)
from ..sources.io import table
from . import register, tidy


def _orders(spark, sf):
    return table(spark, sf, "orders").withColumn("is_f", (F.col("o_orderstatus") == "F").cast("int"))


@register("combine_rare", """
WITH b AS (SELECT p_brand FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand HAVING count(*) >= 80)
SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM b) THEN p_brand ELSE 'Other' END AS p_brand,
  p_type AS p_type_raw
FROM part""")
def q_combine_rare(spark, sf):
    p = table(spark, sf, "part")
    st = RareCategoryCombiner("c1", ["p_brand"], min_count=80)
    out = st.fit(p).transform(p)
    return out.select("p_partkey", "p_brand", F.col("p_type").alias("p_type_raw"))


@register("combine_rare_freq", """
WITH t AS (SELECT p_type FROM part WHERE p_type IS NOT NULL GROUP BY p_type
           HAVING count(*) / (SELECT count(p_type) FROM part) >= 0.17)
SELECT p_partkey, CASE WHEN p_type IN (SELECT p_type FROM t) THEN p_type ELSE 'Other' END AS p_type FROM part""")
def q_combine_rare_freq(spark, sf):
    p = table(spark, sf, "part")
    return RareCategoryCombiner("c1f", ["p_type"], min_freq=0.17).fit(p).transform(p).select("p_partkey", "p_type")


def _long(df, ids, prefix):
    """Wide 0/1 columns → (id, feature, value) so the check does not depend
    on data-driven column names."""
    vals = [c for c in df.columns if c.startswith(prefix)]
    return tidy(df.unpivot(ids, vals, "feature", "value"))


@register("one_hot", """
WITH c AS (SELECT DISTINCT o_orderpriority AS v FROM orders WHERE o_orderpriority IS NOT NULL)
SELECT o.o_orderkey, 'o_orderpriority_ohe_' || c.v AS feature,
       CAST(coalesce(o.o_orderpriority = c.v, false) AS BIGINT) AS value
FROM orders o, c""")
def q_one_hot(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return _long(OneHotEncoder("c2", ["o_orderpriority"]).fit(o).transform(o), ["o_orderkey"], "o_orderpriority_ohe_")


@register("one_hot_top", """
WITH top AS (SELECT p_type AS v FROM part WHERE p_type IS NOT NULL GROUP BY p_type
             ORDER BY count(*) DESC, p_type LIMIT 3)
SELECT p.p_partkey, 'p_type_ohe_' || top.v AS feature, CAST(coalesce(p.p_type = top.v, false) AS BIGINT) AS value
FROM part p, top
UNION ALL
SELECT p_partkey, 'p_type_ohe_other', CAST(coalesce(p_type NOT IN (SELECT v FROM top), true) AS BIGINT) FROM part""")
def q_one_hot_top(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    return _long(OneHotEncoder("c2t", ["p_type"], max_categories=3).fit(p).transform(p), ["p_partkey"], "p_type_ohe_")


@register("count_encode", """
WITH g AS (SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand)
SELECT p.p_partkey, CAST(coalesce(g.n, 0) AS BIGINT) AS p_brand_count
FROM part p LEFT JOIN g ON p.p_brand = g.p_brand""")
def q_count_encode(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    return tidy(CountFrequencyEncoder("c3", ["p_brand"]).fit(p).transform(p).drop("p_brand"))


@register("freq_encode", """
WITH g AS (SELECT p_type, count(*) / (SELECT count(p_type) FROM part) AS f FROM part
           WHERE p_type IS NOT NULL GROUP BY p_type)
SELECT p.p_partkey, round(coalesce(g.f, 0), 6) AS p_type_freq
FROM part p LEFT JOIN g ON p.p_type = g.p_type""")
def q_freq_encode(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    return tidy(CountFrequencyEncoder("c3f", ["p_type"], normalize=True).fit(p).transform(p).drop("p_type"))


def _md5_mod_sql(x, n):
    h = f"md5(coalesce(CAST({x} AS VARCHAR), 'nan'))"
    hi = f"CAST(('0x' || substr({h}, 1, 16)) AS UBIGINT)"
    lo = f"CAST(('0x' || substr({h}, 17, 16)) AS UBIGINT)"
    two64 = (2 ** 64) % n
    return f"((CAST({hi} % {n} AS HUGEINT) * {two64} + CAST({lo} % {n} AS HUGEINT)) % {n})"


def _hash_sql(cols, n, name):
    outs = []
    for i in range(n):
        outs.append("CAST(" + " + ".join(f"CAST({_md5_mod_sql(c, n)} = {i} AS INTEGER)" for c in cols)
                    + f" AS BIGINT) AS {name}_hash_{i}")
    return ", ".join(outs)


@register("hash_encode", f"SELECT p_partkey, {_hash_sql(['p_brand', 'p_type'], 8, 'c4')} FROM part")
def q_hash_encode(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return tidy(HashingEncoder("c4", ["p_brand", "p_type"], 8).transform(p))


@register("hash_encode_7", f"SELECT c_custkey, {_hash_sql(['c_mktsegment', 'c_nationkey'], 7, 'c4s')} FROM customer")
def q_hash_encode_7(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return tidy(HashingEncoder("c4s", ["c_mktsegment", "c_nationkey"], 7).transform(c))


@register("ordinal_encode", """
WITH g AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS code
           FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL))
SELECT o.o_orderkey, CAST(coalesce(g.code, -1) AS BIGINT) AS o_orderpriority_ordinal
FROM orders o LEFT JOIN g ON o.o_orderpriority = g.o_orderpriority""")
def q_ordinal_encode(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return tidy(OrdinalEncoder("c5", ["o_orderpriority"]).fit(o).transform(o))


@register("ordinal_encode_mapping", """
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE -1 END AS BIGINT)
  AS o_orderstatus_ordinal FROM orders""")
def q_ordinal_encode_mapping(spark, sf):
    """Given mapping without 'P': those rows are unseen → -1."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    st = OrdinalEncoder("c5m", ["o_orderstatus"], mapping={"o_orderstatus": {"F": 0, "O": 1}})
    return tidy(st.fit(o).transform(o))


@register("target_encode", """
WITH gm AS (SELECT avg(CAST(o_orderstatus = 'F' AS INTEGER)) AS m FROM orders
            WHERE o_orderdate < TIMESTAMP '1996-01-01'),
g AS (SELECT o_orderpriority, avg(CAST(o_orderstatus = 'F' AS INTEGER)) AS mu, count(*) AS n FROM orders
      WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_orderpriority IS NOT NULL GROUP BY o_orderpriority)
SELECT o.o_orderkey, round(coalesce((g.mu * g.n + gm.m * 20.0) / (g.n + 20.0), gm.m), 6) AS o_orderpriority_te
FROM orders o LEFT JOIN g ON o.o_orderpriority = g.o_orderpriority, gm""")
def q_target_encode(spark, sf):
    """Fit on orders before 1996, apply to all orders."""
    o = _orders(spark, sf)
    fit = o.where(F.col("o_orderdate") < F.lit("1996-01-01"))
    st = TargetEncoder("c6", ["o_orderpriority"], "is_f", 20.0).fit(fit)
    return tidy(st.transform(o.select("o_orderkey", "o_orderpriority")))


@register("woe_encode", """
WITH t AS (SELECT sum(CAST(o_orderstatus = 'F' AS INTEGER)) AS p, count(*) AS n FROM orders),
g AS (SELECT o_orderpriority, count(*) AS n, sum(CAST(o_orderstatus = 'F' AS INTEGER)) AS p FROM orders
      WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority)
SELECT o.o_orderkey,
  round(coalesce(ln(((g.p + 1e-6) / t.p) / ((g.n - g.p + 1e-6) / (t.n - t.p))), 0), 6) AS o_orderpriority_woe
FROM orders o LEFT JOIN g ON o.o_orderpriority = g.o_orderpriority, t""")
def q_woe_encode(spark, sf):
    o = _orders(spark, sf)
    st = WoEEncoder("c7", ["o_orderpriority"], "is_f").fit(o)
    return tidy(st.transform(o.select("o_orderkey", "o_orderpriority")))


@register("concat_categories", """
SELECT p_partkey, coalesce(p_brand, 'nan') || '_' || coalesce(p_type, 'nan') AS p_brand_p_type,
       coalesce(p_type, 'nan') || '_' || coalesce(CAST(p_size AS VARCHAR), 'nan') AS p_type_p_size
FROM part""")
def q_concat_categories(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    out = CategoricalInteraction("c8", [["p_brand", "p_type"], ["p_type", "p_size"]]).transform(p)
    return out.select("p_partkey", "p_brand_p_type", "p_type_p_size")


@register("target_encode_oof", """
WITH b AS (SELECT o_orderkey, o_orderpriority, CAST(o_orderstatus = 'F' AS DOUBLE) AS y,
                  CAST(('0x' || substr(md5('42|' || CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS fold
           FROM orders),
t AS (SELECT sum(y) AS s, count(y) AS n FROM b),
f AS (SELECT fold, sum(y) AS sf, count(y) AS nf FROM b GROUP BY fold),
c AS (SELECT o_orderpriority, sum(y) AS s, count(y) AS n FROM b WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority),
cf AS (SELECT o_orderpriority, fold, sum(y) AS s, count(y) AS n FROM b WHERE o_orderpriority IS NOT NULL
       GROUP BY o_orderpriority, fold),
x AS (SELECT b.o_orderkey, (t.s - f.sf) / (t.n - f.nf) AS g,
        coalesce(c.s, 0) - coalesce(cf.s, 0) AS ss, coalesce(c.n, 0) - coalesce(cf.n, 0) AS nn
      FROM b JOIN f ON b.fold = f.fold LEFT JOIN c ON b.o_orderpriority = c.o_orderpriority
      LEFT JOIN cf ON b.o_orderpriority = cf.o_orderpriority AND b.fold = cf.fold, t)
SELECT o_orderkey, round(CASE WHEN nn > 0 THEN (ss + g * 20.0) / (nn + 20.0) ELSE g END, 6) AS o_orderpriority_te
FROM x""")
def q_target_encode_oof(spark, sf):
    """C6 out of fold (D15): each order encoded from the other four folds."""
    from ..plans.folds import GroupKFold

    o = GroupKFold(5, group_col="o_orderkey").assign(_orders(spark, sf))
    st = TargetEncoder("c6o", ["o_orderpriority"], "is_f", 20.0, fold_col="fold").fit(o)
    return tidy(st.transform(o.select("o_orderkey", "o_orderpriority", "fold")).select("o_orderkey",
                                                                                        "o_orderpriority_te"))


@register("ordinal_encode_first_seen", """
WITH f AS (SELECT event_type, min(ts) AS t FROM events WHERE event_type IS NOT NULL GROUP BY event_type),
c AS (SELECT event_type, row_number() OVER (ORDER BY t, event_type) - 1 AS code FROM f)
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(coalesce(code, -1) AS BIGINT) AS event_type_ordinal
FROM events LEFT JOIN c USING (event_type)""")
def q_ordinal_encode_first_seen(spark, sf):
    """Codes in the order of first appearance by time."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "ts")
    st = OrdinalEncoder("c5f", ["event_type"], order_col="ts")
    return tidy(st.fit(ev).transform(ev).select("event_id", "event_type_ordinal"))
