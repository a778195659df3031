"""Check queries for numerical stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.numeric import (BoxCoxTransformer, DecisionTreeBinner, EqualWidthBinner, IsNullIndicator,
                                 LogTransformer, MinMaxScaler, NumCatInteraction, NumericalInteraction,
                                 OutlierIndicator, QuantileBinner, RobustScaler, SqrtTransformer,
                                 StandardScaler, ValueIndicator, YeoJohnsonTransformer)
from ..sources.io import table
from . import register, tidy

LI_ID = ["l_orderkey", "l_linenumber"]


def sql_bin(x: str, e: str) -> str:
    """Right-closed bin index of x in the edge list e (DuckDB lists are 1-based)."""
    return (f"CAST(CASE WHEN {x} IS NULL OR len({e}) = 0 OR {x} < {e}[1] OR {x} > {e}[len({e})] THEN -1 "
            f"WHEN {x} = {e}[1] THEN 0 ELSE len(list_filter({e}, lambda v: v < {x})) - 1 END AS BIGINT)")


def _fit_apply(stage, df, keep, digits=6):
    out = stage.fit(df).transform(df)
    new = [c for c in out.columns if c not in df.columns]
    return tidy(out.select(*keep, *new), digits)


# ------------------------------------------------------------------ N1
def _ew_edges(x, n=10):
    return (f"list_transform(range(0, {n + 1}), lambda i: CASE WHEN i = {n} THEN max({x}) "
            f"ELSE i * ((max({x}) - min({x})) / {n}) + min({x}) END)")


@register("equal_width_bin", f"""
WITH e AS (SELECT {_ew_edges('l_extendedprice')} AS e1, {_ew_edges('l_quantity')} AS e2 FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  {sql_bin('l_extendedprice', 'e1')} AS l_extendedprice_ew_binned,
  {sql_bin('l_quantity', 'e2')} AS l_quantity_ew_binned
FROM lineitem, e""")
def q_equal_width_bin(spark, sf):
    li = table(spark, sf, "lineitem")
    return _fit_apply(EqualWidthBinner("n1", ["l_extendedprice", "l_quantity"], 10), li, LI_ID)


@register("equal_width_bin_unseen", f"""
WITH e AS (SELECT {_ew_edges('o_totalprice')} AS e1 FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01')
SELECT o_orderkey, {sql_bin('o_totalprice', 'e1')} AS o_totalprice_ew_binned FROM orders, e""")
def q_equal_width_bin_unseen(spark, sf):
    """Fit on orders before 1995, apply to every order (out-of-range → -1)."""
    o = table(spark, sf, "orders")
    f = EqualWidthBinner("n1b", ["o_totalprice"], 10).fit(o.where(F.col("o_orderdate") < F.lit("1995-01-01")))
    return tidy(f.transform(o).select("o_orderkey", "o_totalprice_ew_binned"))


# ------------------------------------------------------------------ N2
def _q_edges(x, n=10):
    qs = ", ".join(f"quantile_cont({x}, {k / n})" for k in range(n + 1))
    return f"list_sort(list_distinct([{qs}]))"


@register("quantile_bin", f"""
WITH e AS (SELECT {_q_edges('l_extendedprice')} AS e1, {_q_edges('l_discount')} AS e2 FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  {sql_bin('l_extendedprice', 'e1')} AS l_extendedprice_q_binned,
  {sql_bin('l_discount', 'e2')} AS l_discount_q_binned
FROM lineitem, e""")
def q_quantile_bin(spark, sf):
    li = table(spark, sf, "lineitem")
    return _fit_apply(QuantileBinner("n2", ["l_extendedprice", "l_discount"], 10), li, LI_ID)


def _tree_sql(depth: int) -> str:
    """Greedy Gini splits of o_totalprice on is_f, level by level over the
    distinct values, then bins between the thresholds."""
    ctes = ["v0 AS (SELECT 0 AS node, o_totalprice AS v, CAST(sum((o_orderstatus <> 'F')::INT) AS DOUBLE) AS n0, "
            "CAST(sum((o_orderstatus = 'F')::INT) AS DOUBLE) AS n1 FROM orders WHERE o_totalprice IS NOT NULL "
            "AND o_orderstatus IS NOT NULL GROUP BY o_totalprice)"]
    for d in range(depth):
        ctes.append(f"""c{d} AS (SELECT *, sum(n0) OVER w AS l0, sum(n1) OVER w AS l1, sum(n0) OVER (PARTITION BY node) AS t0,
    sum(n1) OVER (PARTITION BY node) AS t1, lead(v) OVER (PARTITION BY node ORDER BY v) AS nx
  FROM v{d} WINDOW w AS (PARTITION BY node ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
        ctes.append(f"""b{d} AS (SELECT node, v AS best, v / 2 + nx / 2 AS cut FROM c{d} WHERE nx IS NOT NULL AND t0 > 0 AND t1 > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY (l0 * l0 + l1 * l1) / (l0 + l1)
    + ((t0 - l0) * (t0 - l0) + (t1 - l1) * (t1 - l1)) / ((t0 - l0) + (t1 - l1)) DESC, v) = 1)""")
        ctes.append(f"v{d + 1} AS (SELECT 2 * v{d}.node + (v > best)::INT AS node, v, n0, n1 FROM v{d} JOIN b{d} USING (node))")
    cuts = " UNION ALL ".join(f"SELECT cut AS e FROM b{d}" for d in range(depth))
    ctes.append(f"e AS (SELECT list_sort(list_distinct(list(e))) AS e FROM ({cuts} UNION ALL SELECT min(o_totalprice) "
                "FROM orders UNION ALL SELECT max(o_totalprice) FROM orders))")
    return (f"WITH {', '.join(ctes)} SELECT o_orderkey, {sql_bin('o_totalprice', 'e')} AS o_totalprice_tree_binned "
            "FROM orders, e")


@register("tree_bin", _tree_sql(3))
def q_tree_bin(spark, sf):
    """Exact Gini splits of the order price on a status flag, three levels."""
    o = table(spark, sf, "orders").withColumn("is_f", (F.col("o_orderstatus") == "F").cast("int"))
    st = DecisionTreeBinner("n3", ["o_totalprice"], "is_f", max_depth=3)
    return _fit_apply(st, o, ["o_orderkey"])


# ------------------------------------------------------------------ N4-N6
@register("flag_value", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(coalesce(l_discount = 0, false) AS BIGINT) AS l_discount_is_0,
  CAST(coalesce(l_tax = 0, false) AS BIGINT) AS l_tax_is_0
FROM lineitem""")
def q_flag_value(spark, sf):
    return _fit_apply(ValueIndicator("n4", ["l_discount", "l_tax"], 0), table(spark, sf, "lineitem"), LI_ID)


@register("flag_null", """
SELECT d.doc_id, CAST(l.quality IS NULL AS BIGINT) AS quality_is_null,
       CAST(l.toxic IS NULL AS BIGINT) AS toxic_is_null
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_flag_null(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return _fit_apply(IsNullIndicator("n5", ["quality", "toxic"]), d, ["doc_id"])


def _outlier_sql(x, m=1.5):
    q1, q3 = f"quantile_cont({x}, 0.25)", f"quantile_cont({x}, 0.75)"
    return f"{q1} - {m} * ({q3} - {q1}) AS lo_{x}, {q3} + {m} * ({q3} - {q1}) AS hi_{x}"


@register("flag_outlier", f"""
WITH b AS (SELECT {_outlier_sql('l_extendedprice')}, {_outlier_sql('l_quantity')} FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(coalesce(l_extendedprice < lo_l_extendedprice OR l_extendedprice > hi_l_extendedprice, false) AS BIGINT)
    AS l_extendedprice_is_outlier,
  CAST(coalesce(l_quantity < lo_l_quantity OR l_quantity > hi_l_quantity, false) AS BIGINT) AS l_quantity_is_outlier
FROM lineitem, b""")
def q_flag_outlier(spark, sf):
    return _fit_apply(OutlierIndicator("n6", ["l_extendedprice", "l_quantity"]), table(spark, sf, "lineitem"), LI_ID)


# ------------------------------------------------------------------ N7-N9
@register("scale_standard", """
WITH s AS (SELECT avg(l_extendedprice) m1, stddev_pop(l_extendedprice) s1,
                  avg(l_discount) m2, stddev_pop(l_discount) s2 FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  round((l_extendedprice - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END, 6) AS l_extendedprice_standard_scaled,
  round((l_discount - m2) / CASE WHEN s2 = 0 THEN 1 ELSE s2 END, 6) AS l_discount_standard_scaled
FROM lineitem, s""")
def q_scale_standard(spark, sf):
    return _fit_apply(StandardScaler("n7", ["l_extendedprice", "l_discount"]), table(spark, sf, "lineitem"), LI_ID)


@register("scale_minmax", """
WITH s AS (SELECT min(c_acctbal) lo, max(c_acctbal) hi FROM customer),
     k AS (SELECT 1.0 / CASE WHEN hi - lo = 0 THEN 1 ELSE hi - lo END AS sc, lo FROM s)
SELECT c_custkey, round(c_acctbal * sc + (0.0 - lo * sc), 6) AS c_acctbal_minmax_scaled FROM customer, k""")
def q_scale_minmax(spark, sf):
    return _fit_apply(MinMaxScaler("n8", ["c_acctbal"]), table(spark, sf, "customer"), ["c_custkey"])


def _robust_sql(x):
    return (f"quantile_cont({x}, 0.5) AS md_{x}, "
            f"quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) AS r_{x}")


@register("scale_robust", f"""
WITH s AS (SELECT {_robust_sql('l_extendedprice')}, {_robust_sql('l_quantity')} FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  round((l_extendedprice - md_l_extendedprice) / CASE WHEN r_l_extendedprice = 0 THEN 1 ELSE r_l_extendedprice END, 6)
    AS l_extendedprice_robust_scaled,
  round((l_quantity - md_l_quantity) / CASE WHEN r_l_quantity = 0 THEN 1 ELSE r_l_quantity END, 6)
    AS l_quantity_robust_scaled
FROM lineitem, s""")
def q_scale_robust(spark, sf):
    return _fit_apply(RobustScaler("n9", ["l_extendedprice", "l_quantity"]), table(spark, sf, "lineitem"), LI_ID)


# ------------------------------------------------------------------ N10-N13
@register("log1p", """
SELECT c_custkey, round(CASE WHEN c_acctbal > -1 THEN ln(1 + c_acctbal) END, 6) AS c_acctbal_log1p FROM customer""")
def q_log1p(spark, sf):
    return _fit_apply(LogTransformer("n10", ["c_acctbal"]), table(spark, sf, "customer"), ["c_custkey"])


@register("sqrt_clip", """
SELECT c_custkey, round(sqrt(greatest(c_acctbal, 0)), 6) AS c_acctbal_sqrt FROM customer""")
def q_sqrt_clip(spark, sf):
    return _fit_apply(SqrtTransformer("n11", ["c_acctbal"]), table(spark, sf, "customer"), ["c_custkey"])


_BC = "(CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END)"
_YJ = ("(CASE WHEN x >= 0 THEN (CASE WHEN lam = 0 THEN ln(x + 1) ELSE (pow(x + 1, lam) - 1) / lam END) "
       "ELSE (CASE WHEN lam = 2 THEN -ln(-x + 1) ELSE -(pow(-x + 1, 2 - lam) - 1) / (2 - lam) END) END)")


def _power_sql(tbl, xcol, ids, expr, jac, out):
    """Same λ search as the Spark fit: coarse grid k/10, then three zoom passes
    best + k/d (d = 100, 1000, 10000), each an argmax of the profile llf."""
    def best(grid):
        return (f"(SELECT arg_max(lam, (lam - 1) * j - n / 2.0 * ln(v)) AS lam FROM "
                f"(SELECT lam, var_pop({expr}) AS v FROM {grid}, d GROUP BY lam) s, j WHERE v > 0)")

    ctes = [f"d AS (SELECT {xcol} AS x FROM {tbl} WHERE {xcol} IS NOT NULL)",
            f"j AS (SELECT count(*) AS n, sum({jac}) AS j FROM d)",
            "g0 AS (SELECT k / CAST(10 AS DOUBLE) AS lam FROM range(-20, 21) r(k))",
            f"b0 AS {best('g0')}"]
    for i, den in enumerate((100, 1000, 10000), start=1):
        ctes.append(f"g{i} AS (SELECT b{i - 1}.lam + k / CAST({den} AS DOUBLE) AS lam "
                    f"FROM b{i - 1}, range(-10, 11) r(k))")
        ctes.append(f"b{i} AS {best(f'g{i}')}")
    lam_expr = expr_sub(expr, xcol)
    return f"""
WITH {", ".join(ctes)}
SELECT {ids}, round({lam_expr}, 6) AS {out}
FROM {tbl}, b3"""


def expr_sub(expr: str, xcol: str) -> str:
    import re

    return re.sub(r"\bx\b", xcol, expr)


@register("box_cox", _power_sql("lineitem", "l_extendedprice", "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber",
                                _BC, "ln(x)", "l_extendedprice_boxcox"))
def q_box_cox(spark, sf):
    return _fit_apply(BoxCoxTransformer("n12", ["l_extendedprice"]), table(spark, sf, "lineitem"), LI_ID)


@register("yeo_johnson", _power_sql("customer", "c_acctbal", "c_custkey", _YJ,
                                    "sign(x) * ln(abs(x) + 1)", "c_acctbal_yeojohnson"))
def q_yeo_johnson(spark, sf):
    return _fit_apply(YeoJohnsonTransformer("n13", ["c_acctbal"]), table(spark, sf, "customer"), ["c_custkey"])


# ------------------------------------------------------------------ N14, N15
def _pair_sql(cols):
    from itertools import combinations

    out = []
    for a, b in combinations(cols, 2):
        out += [f"round({a} + {b}, 6) AS {a}_add_{b}", f"round({a} - {b}, 6) AS {a}_sub_{b}",
                f"round({b} - {a}, 6) AS {b}_sub_{a}", f"round({a} * {b}, 6) AS {a}_mul_{b}",
                f"round({a} / ({b} + 1e-6), 6) AS {a}_div_{b}", f"round({b} / ({a} + 1e-6), 6) AS {b}_div_{a}"]
    return ",\n  ".join(out)


_PAIR = ["l_quantity", "l_extendedprice", "l_discount"]


@register("pairwise_arith", f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  {_pair_sql(_PAIR)}
FROM lineitem""")
def q_pairwise_arith(spark, sf):
    return _fit_apply(NumericalInteraction("n14", _PAIR), table(spark, sf, "lineitem"), LI_ID)


@register("group_deviation", """
WITH g AS (SELECT c_mktsegment, avg(c_acctbal) gm FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment),
o AS (SELECT avg(c_acctbal) om FROM customer)
SELECT c.c_custkey,
  round(c.c_acctbal / (coalesce(g.gm, o.om) + 1e-6), 6) AS c_acctbal_div_by_c_mktsegment_mean,
  round(c.c_acctbal - coalesce(g.gm, o.om), 6) AS c_acctbal_sub_by_c_mktsegment_mean
FROM customer c LEFT JOIN g ON c.c_mktsegment = g.c_mktsegment, o""")
def q_group_deviation(spark, sf):
    st = NumCatInteraction("n15", {"c_mktsegment": ["c_acctbal"]})
    return _fit_apply(st, table(spark, sf, "customer"), ["c_custkey"])


@register("box_cox_skewed", """
WITH x AS (SELECT power((l_discount * 100 + 1) / 11.0, 0.125) AS x, count(*) AS c FROM lineitem GROUP BY l_discount),
n AS (SELECT sum(c) AS n, sum(c * ln(x)) AS j FROM x),
g AS (SELECT k / 1000.0 AS lam FROM (SELECT unnest(range(1, 20000)) AS k)),
v AS (SELECT lam, sum(c * power((power(x, lam) - 1) / lam, 2)) / sum(c)
        - power(sum(c * (power(x, lam) - 1) / lam) / sum(c), 2) AS var FROM g, x GROUP BY lam)
SELECT round(max((lam - 1) * j - n / 2.0 * ln(var)), 1) AS llf FROM v, n""")
def q_box_cox_skewed(spark, sf):
    """N12 with an optimum far above 2: the log-likelihood that the fit reaches."""
    import math

    x = table(spark, sf, "lineitem").select(F.pow((F.col("l_discount") * 100 + 1) / 11.0, F.lit(0.125)).alias("x"))
    lam = BoxCoxTransformer("n12s", ["x"]).fit(x).state["x"]
    r = x.agg(F.var_pop((F.pow("x", F.lit(lam)) - 1) / lam).alias("v"), F.count(F.lit(1)).alias("n"),
              F.sum(F.log("x")).alias("j"))
    return tidy(r.select(((F.lit(lam) - 1) * F.col("j") - F.col("n") / 2 * F.log("v")).alias("llf")), overrides={"llf": 1})
