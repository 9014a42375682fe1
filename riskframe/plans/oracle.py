"""DuckDB SQL equivalents of :mod:`riskframe.plans.driver_queries`.

Written independently of the Spark code, over the same whole tables, with the
same input-variant expressions (:mod:`riskframe.plans.inputs`).  Data-dependent
output columns (category levels) are spelled out; the levels are those of the
supplied tables.
"""

from __future__ import annotations

from riskframe.plans.driver_queries import (
    CHI_SQL, ENCODE_SQL_COLS, PRUNE_SQL_COLS,
)
from riskframe.plans.inputs import (
    APPLICANTS_SQL, CUSTOMER_MAIN, CUSTOMER_SENTINEL, LINEITEM_MISSING, LINEITEM_SCORES,
    LINEITEM_TEXT_NUMBERS, ORDERS_PLACEHOLDERS, sql_from,
)

# ---- fixed level lists of the supplied tables ------------------------------------
ORDER_STATUS = ["F", "O", "P"]
ORDER_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RETURN_FLAG = ["A", "N", "R"]
LINE_STATUS = ["F", "O"]
PLACEHOLDERS = "('', 'NA', 'N/A', 'None', 'null')"
LI = ["l_quantity", "l_price_m", "l_discount", "l_tax"]


def _r(e: str, bits: int = 36, floor_exp: int = -40) -> str:
    # 36 significant bits, 2**-40 near zero, as the Spark side's snap(); + 0.0 folds -0.0
    q = f"greatest(pow(2.0, floor(log2(abs({e}))) - {bits}), pow(2.0, {floor_exp}))"
    return f"(CASE WHEN ({e}) = 0 THEN 0.0 ELSE floor(({e}) / {q} + 0.5) * {q} END + 0.0)"


def _clean_priority(col: str = "o_orderpriority") -> str:
    return f"CASE WHEN trim({col}) IN {PLACEHOLDERS} THEN NULL ELSE trim({col}) END"


def _stats(col: str, prefix: str, rounded: bool = True) -> list[str]:
    x = f"CAST({col} AS DOUBLE)"
    up = f"{prefix}_{col}".upper()
    r = _r if rounded else (lambda e: e)
    return [f'{r(f"avg({x})")} AS "{up}_MEAN"', f'{r(f"max({x})")} AS "{up}_MAX"',
            f'{r(f"min({x})")} AS "{up}_MIN"', f'{r(f"stddev_samp({x})")} AS "{up}_STD"']


def _shares(col: str, levels: list[str], prefix: str, expr: str | None = None,
            rounded: bool = True) -> list[str]:
    e = expr or col
    up = f"{prefix}_{col}".upper()
    r = _r if rounded else (lambda x: x)
    out = [f'{r(f"avg(CASE WHEN {e} = {chr(39)}{lv}{chr(39)} THEN 1.0 ELSE 0.0 END)")} AS "{up}_{lv.upper()}"'
           for lv in levels]
    out.append(f'{r(f"avg(CASE WHEN {e} IS NULL THEN 1.0 ELSE 0.0 END)")} AS "{up}_NAN"')
    return out


SQL: dict[str, str] = {}

SQL["standardize_columns"] = """
SELECT o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY, o_orderstatus AS O_ORDERSTATUS,
       o_totalprice AS O_TOTALPRICE, o_orderpriority AS O_ORDERPRIORITY,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS O_ORDERDATE FROM orders"""

SQL["clean_placeholders"] = f"""
SELECT o_orderkey, {_clean_priority()} AS o_orderpriority FROM ({sql_from(ORDERS_PLACEHOLDERS)})"""

SQL["impute_unknown"] = f"""
SELECT o_orderkey, coalesce({_clean_priority()}, 'UNKNOWN') AS o_orderpriority
FROM ({sql_from(ORDERS_PLACEHOLDERS)})"""

SQL["clean_coerce_numeric"] = f"""
SELECT l_orderkey, l_linenumber, TRY_CAST(trim(t95) AS DOUBLE) AS t95, trim(t80) AS t80
FROM ({sql_from(LINEITEM_TEXT_NUMBERS)})"""

SQL["impute_median"] = f"""
WITH t AS ({sql_from(LINEITEM_MISSING)})
SELECT l_orderkey, l_linenumber,
       coalesce(l_price_m, {_r("(SELECT median(l_price_m) FROM t)")}) AS l_price_m FROM t"""

SQL["dedupe_rows"] = """
SELECT DISTINCT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM (
  SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 10 = 0)"""


def _missing_rows(src: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
             f"AS missing_count, {_r(f'sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / count(*)')} "
             f"AS missing_rate FROM {src}" for c in cols]
    return "\nUNION ALL\n".join(parts)


SQL["missing_profile"] = f"""
WITH li AS ({sql_from(LINEITEM_MISSING)}),
     o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                  {_clean_priority()} AS o_orderpriority FROM ({sql_from(ORDERS_PLACEHOLDERS)}))
{_missing_rows("li", ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_price_m", "is_r"])}
UNION ALL
{_missing_rows("o", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])}"""

SQL["safe_ratio"] = f"""
SELECT l_orderkey, l_linenumber,
       {_r("l_extendedprice / NULLIF(l_discount, 0.0)")} AS price_per_discount FROM lineitem"""

SQL["sentinel_flag"] = f"""
WITH t AS ({sql_from(CUSTOMER_SENTINEL)}),
     m AS (SELECT median(DAYS_EMPLOYED) AS med FROM t WHERE DAYS_EMPLOYED <> 365243)
SELECT c_custkey,
       {_r("CAST(CASE WHEN DAYS_EMPLOYED = 365243 THEN m.med ELSE DAYS_EMPLOYED END AS DOUBLE)")}
           AS DAYS_EMPLOYED,
       CAST(CASE WHEN DAYS_EMPLOYED = 365243 THEN 1 ELSE 0 END AS TINYINT) AS DAYS_EMPLOYED_ANOM
FROM t, m"""

_F1 = {
    "CREDIT_INCOME_RATIO": "AMT_CREDIT / NULLIF(AMT_INCOME_TOTAL, 0)",
    "ANNUITY_INCOME_RATIO": "AMT_ANNUITY / NULLIF(AMT_INCOME_TOTAL, 0)",
    "CREDIT_ANNUITY_RATIO": "AMT_CREDIT / NULLIF(AMT_ANNUITY, 0)",
    "GOODS_CREDIT_RATIO": "AMT_GOODS_PRICE / NULLIF(AMT_CREDIT, 0)",
    "DOWN_PAYMENT_PROXY": "AMT_CREDIT - AMT_GOODS_PRICE",
    "AGE_YEARS": "greatest(-DAYS_BIRTH / 365.25, 0.0)",
    "EMPLOYED_YEARS": "-least(DAYS_EMPLOYED, 0.0) / 365.25",
    "DAYS_EMPLOYED_PERC": "DAYS_EMPLOYED / NULLIF(DAYS_BIRTH, 0)",
    "EXT_SOURCE_MEAN": "(coalesce(EXT_SOURCE_1,0)+coalesce(EXT_SOURCE_2,0)+coalesce(EXT_SOURCE_3,0))"
                       " / NULLIF(_n, 0)",
    "EXT_SOURCE_MIN": "least(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)",
    "EXT_SOURCE_MAX": "greatest(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)",
    "EXT_SOURCE_STD": "CASE WHEN _n >= 2 THEN sqrt(("
                      "coalesce((EXT_SOURCE_1 - _m) * (EXT_SOURCE_1 - _m), 0) + "
                      "coalesce((EXT_SOURCE_2 - _m) * (EXT_SOURCE_2 - _m), 0) + "
                      "coalesce((EXT_SOURCE_3 - _m) * (EXT_SOURCE_3 - _m), 0)) / (_n - 1)) ELSE 0.0 END",
    "EXT_SOURCE_PROD": "coalesce(EXT_SOURCE_1, 1.0) * coalesce(EXT_SOURCE_2, 1.0) * coalesce(EXT_SOURCE_3, 1.0)",
    "EXT_SOURCE_WEIGHTED": "0.5 * EXT_SOURCE_2 + 0.25 * EXT_SOURCE_1 + 0.25 * EXT_SOURCE_3",
    "DOCUMENT_COUNT": "CAST(coalesce(FLAG_DOCUMENT_2, 0) + coalesce(FLAG_DOCUMENT_3, 0) AS DOUBLE)",
    "BUREAU_CREDIT_RATIO": "BUREAU_AMT_CREDIT_SUM_MEAN / NULLIF(AMT_CREDIT, 0)",
    "BUREAU_OVERDUE_FLAG": "CAST(coalesce(BUREAU_AMT_CREDIT_SUM_OVERDUE_MEAN > 0, false) AS DOUBLE)",
    "PREV_CREDIT_RATIO": "PREV_AMT_CREDIT_MEAN / NULLIF(AMT_CREDIT, 0)",
    "DAYS_LAST_PHONE_CHANGE_ABS": "abs(DAYS_LAST_PHONE_CHANGE)",
    "SOCIAL_CIRCLE_DEFAULT_RATE": "DEF_30_CNT_SOCIAL_CIRCLE / NULLIF(OBS_30_CNT_SOCIAL_CIRCLE, 0)",
    "CREDIT_ENQUIRIES_FLAG": "CAST(coalesce(AMT_REQ_CREDIT_BUREAU_YEAR > 3, false) AS DOUBLE)",
}
# MIN/MAX over present values: DuckDB least/greatest also skip NULL.


def _fill(names: list[str], src: str, med: str) -> str:
    return ", ".join(f"coalesce({src}.{n}, {med}.{n}) AS {n}" for n in names)


def _medians(names: list[str], src: str) -> str:
    return "SELECT " + ", ".join(f"coalesce(median({n}), 0.0) AS {n}" for n in names) + f" FROM {src}"


_F1_NAMES = list(_F1)
SQL["engineer_features"] = f"""
WITH a0 AS ({APPLICANTS_SQL}),
sm AS (SELECT median(DAYS_EMPLOYED) AS med FROM a0 WHERE DAYS_EMPLOYED <> 365243),
a AS (SELECT a0.* REPLACE (CASE WHEN DAYS_EMPLOYED = 365243 THEN sm.med ELSE DAYS_EMPLOYED END
                            AS DAYS_EMPLOYED) FROM a0, sm),
b AS (SELECT *,
        (CASE WHEN EXT_SOURCE_1 IS NULL THEN 0 ELSE 1 END + CASE WHEN EXT_SOURCE_2 IS NULL THEN 0 ELSE 1 END
         + CASE WHEN EXT_SOURCE_3 IS NULL THEN 0 ELSE 1 END) AS _n
      FROM a),
c AS (SELECT *, (coalesce(EXT_SOURCE_1,0)+coalesce(EXT_SOURCE_2,0)+coalesce(EXT_SOURCE_3,0)) / NULLIF(_n, 0) AS _m
      FROM b),
r1 AS (SELECT SK_ID_CURR, {", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in _F1.items())} FROM c),
m1 AS ({_medians(_F1_NAMES, "r1")}),
f1 AS (SELECT r1.SK_ID_CURR, {_fill(_F1_NAMES, "r1", "m1")} FROM r1, m1),
r2 AS (SELECT *, AGE_YEARS * CREDIT_INCOME_RATIO AS AGE_CREDIT_INTERACTION FROM f1),
m2 AS ({_medians(["AGE_CREDIT_INTERACTION"], "r2")})
SELECT SK_ID_CURR, {", ".join(_r(n) + " AS " + n for n in _F1_NAMES if n not in ("AGE_CREDIT_INTERACTION",))},
       {_r("coalesce(r2.AGE_CREDIT_INTERACTION, m2.AGE_CREDIT_INTERACTION)")} AS AGE_CREDIT_INTERACTION
FROM r2, m2"""

SQL["drop_constant_columns"] = f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_price_m, is_r
FROM ({sql_from(LINEITEM_MISSING)})"""

SQL["class_filter"] = "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0"

SQL["rollup_numeric"] = f"""
SELECT o_custkey, {", ".join(_stats("o_orderkey", "ord") + _stats("o_totalprice", "ord"))}
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey"""

SQL["rollup_category_share"] = f"""
SELECT o_custkey, {", ".join(_shares("o_orderstatus", ORDER_STATUS, "ord")
                              + _shares("o_orderpriority", ORDER_PRIORITY, "ord", "_p"))}
FROM (SELECT *, {_clean_priority()} AS _p FROM ({sql_from(ORDERS_PLACEHOLDERS)}))
WHERE o_custkey IS NOT NULL GROUP BY o_custkey"""

SQL["rollup_join"] = f"""
WITH r AS (SELECT o_custkey, {", ".join(_stats("o_totalprice", "ord") + _shares("o_orderstatus", ORDER_STATUS, "ord"))}
           FROM orders GROUP BY o_custkey),
c AS (SELECT c_custkey, c_nationkey, c_acctbal FROM customer
      UNION ALL SELECT -c_custkey, c_nationkey, c_acctbal FROM customer)
SELECT c.c_custkey, c.c_nationkey, c.c_acctbal, r.* EXCLUDE (o_custkey)
FROM c LEFT JOIN r ON c.c_custkey = r.o_custkey"""

_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


_MERGED = f"""
ro AS (SELECT o_custkey, {", ".join(_stats("o_totalprice", "ord", False)
                                     + _shares("o_orderstatus", ORDER_STATUS, "ord", None, False)
                                     + _shares("o_orderpriority", ORDER_PRIORITY, "ord", None, False))}
       FROM orders GROUP BY o_custkey),
rl AS (SELECT o_custkey, {", ".join(sum((_stats(c, "li", False) for c in _LI_NUM), [])
                                     + _shares("l_returnflag", RETURN_FLAG, "li", None, False)
                                     + _shares("l_linestatus", LINE_STATUS, "li", None, False))}
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
m AS (SELECT c.c_custkey, c.c_nationkey, CAST(c.c_acctbal < 0 AS INT) AS target,
             ro.* EXCLUDE (o_custkey), rl.* EXCLUDE (o_custkey)
      FROM customer c LEFT JOIN ro ON c.c_custkey = ro.o_custkey
      LEFT JOIN rl ON c.c_custkey = rl.o_custkey)"""

SQL["target_correlations"] = f"""
WITH {_MERGED},
l AS (UNPIVOT (SELECT * EXCLUDE (c_custkey) FROM m) ON COLUMNS(* EXCLUDE (target))
      INTO NAME feature VALUE value),
g AS (SELECT feature, count(*) AS n, covar_pop(value, target) AS cov,
             stddev_pop(value) AS sx, stddev_pop(target) AS sy
      FROM l WHERE value IS NOT NULL AND target IS NOT NULL GROUP BY feature)
SELECT feature,
       {_r("CASE WHEN sx > 0 AND sy > 0 THEN cov / (sx * sy) END")} AS pearson_corr_with_target,
       n
FROM g"""

SQL["top_correlations"] = f"""
SELECT * FROM ({SQL["target_correlations"]})
WHERE pearson_corr_with_target IS NOT NULL
ORDER BY abs(pearson_corr_with_target) DESC, feature LIMIT 5"""

SQL["class_balance"] = f"""
SELECT count(target) AS n_rows,
       CAST(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_target_0,
       CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_target_1,
       {_r("avg(target)")} AS default_rate,
       {_r("CAST(greatest(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END), sum(CASE WHEN target = 1 THEN 1 ELSE 0 END)) AS DOUBLE)"
           " / least(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END), sum(CASE WHEN target = 1 THEN 1 ELSE 0 END))")}
           AS imbalance_ratio
FROM ({sql_from(CUSTOMER_MAIN)})"""


def _long(src: str, cols: list[str], keep: str = "") -> str:
    k = f"{keep}, " if keep else ""
    return "\nUNION ALL\n".join(
        f"SELECT {k}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols)


SQL["describe_numeric"] = f"""
WITH li AS ({sql_from(LINEITEM_MISSING)}),
l AS ({_long("li", LI)}),
tot AS (SELECT count(*) AS rows FROM li)
SELECT feature, count(value) AS count, {_r("avg(value)")} AS mean, {_r("stddev_samp(value)")} AS std,
       {_r("min(value)")} AS min, {_r("quantile_cont(value, 0.25)")} AS q0_25,
       {_r("quantile_cont(value, 0.5)")} AS q0_5, {_r("quantile_cont(value, 0.75)")} AS q0_75,
       {_r("max(value)")} AS max, any_value(tot.rows) - count(value) AS missing_count,
       {_r("(any_value(tot.rows) - count(value)) / any_value(tot.rows)")} AS missing_rate
FROM l, tot GROUP BY feature"""

SQL["quantiles"] = f"""
WITH li AS ({sql_from(LINEITEM_MISSING)}), l AS ({_long("li", LI)})
SELECT feature, {", ".join(f"{_r(f'quantile_cont(value, {p})')} AS q{str(p).replace('.', '_')}"
                           for p in (0.01, 0.25, 0.5, 0.75, 0.99))}
FROM l WHERE value IS NOT NULL GROUP BY feature"""

SQL["distinct_counts"] = f"""
WITH o AS (SELECT o_orderstatus, {_clean_priority()} AS o_orderpriority, o_custkey
           FROM ({sql_from(ORDERS_PLACEHOLDERS)})),
l AS (SELECT 'o_orderstatus' AS feature, o_orderstatus AS value FROM o
      UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM o
      UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM o)
SELECT feature, count(DISTINCT value) AS n_distinct,
       count(DISTINCT value) + max(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS n_distinct_with_missing
FROM l GROUP BY feature"""

SQL["feature_variance"] = f"""
WITH li AS ({sql_from(LINEITEM_MISSING)}), l AS ({_long("li", LI)})
SELECT feature, {_r("var_samp(value)")} AS variance FROM l GROUP BY feature"""

SQL["binary_column_check"] = f"""
WITH li AS ({sql_from(LINEITEM_MISSING)}), l AS ({_long("li", ["is_r", "l_discount", "l_quantity"])})
SELECT feature, coalesce(min(CASE WHEN value IS NULL THEN 1 WHEN value IN (0.0, 1.0) THEN 1 ELSE 0 END), 1)
       AS is_binary FROM l GROUP BY feature"""

SQL["class_histogram"] = f"""
WITH li AS ({sql_from(LINEITEM_MISSING)}),
base AS (SELECT l_price_m AS x, is_r AS target FROM li WHERE l_price_m IS NOT NULL),
q AS (SELECT quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM base),
c AS (SELECT target, least(greatest(x, q.lo), q.hi) AS x FROM base, q),
rng AS (SELECT target, min(x) AS lo, max(x) AS hi, count(*) AS n_class FROM c GROUP BY target),
b AS (SELECT c.target, CAST(CASE WHEN (hi - lo) / 40 > 0
                                THEN least(floor((x - lo) / ((hi - lo) / 40)), 39) ELSE 0 END AS INT) AS bin,
             lo, hi, n_class
      FROM c JOIN rng ON c.target = rng.target),
k AS (SELECT target, bin, count(*) AS count FROM b GROUP BY ALL),
every AS (SELECT target, lo, hi, n_class, CAST(unnest(generate_series(0, CASE WHEN hi > lo THEN 39 ELSE 0 END)) AS INT) AS bin
          FROM rng),
h AS (SELECT every.*, coalesce(count, 0) AS count FROM every LEFT JOIN k USING (target, bin)),
w AS (SELECT *, CASE WHEN hi > lo THEN (hi - lo) / 40 ELSE 1.0 END AS width FROM h)
SELECT target, bin, {_r("lo + bin * width")} AS bin_start, {_r("lo + (bin + 1) * width")} AS bin_end,
       count, {_r("count / (n_class * width)")} AS density FROM w"""


def _pairs(cols: list[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]


_CM = LI + ["l_linenumber"]
SQL["correlation_matrix"] = f"""
WITH li AS ({sql_from(LINEITEM_MISSING)})
""" + "\nUNION ALL\n".join(
    f"SELECT '{_CM[i]}' AS feature_a, '{_CM[j]}' AS feature_b, "
    f"count({_CM[i]} * {_CM[j]}) AS n, {_r(f'greatest(least(corr({_CM[i]}, {_CM[j]}), 1.0), -1.0)')} AS r FROM li"
    for i, j in _pairs(_CM))

_PR = ["a", "b", "c", "d", "e", "f", "g"]
SQL["correlation_prune"] = f"""
WITH t AS (SELECT {PRUNE_SQL_COLS} FROM lineitem),
p AS ({" UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, '{_PR[j]}' AS feature, corr({_PR[i]}, {_PR[j]}) AS r FROM t"
                         for i, j in _pairs(_PR))})
SELECT feature, j AS position FROM p WHERE abs(r) >= 0.95 GROUP BY feature, j"""

_RANKED = f"""
li AS ({sql_from(LINEITEM_MISSING)}),
l AS ({_long("li", LI, "is_r")}),
v AS (SELECT feature, value, count(*) AS n, sum(is_r) AS n1,
             sum(CASE WHEN is_r = 0 THEN 1 ELSE 0 END) AS n0
      FROM l WHERE value IS NOT NULL GROUP BY feature, value),
rk AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY feature ORDER BY value
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 + (n + 1) / 2.0 AS avg_rank FROM v)"""

SQL["spearman"] = f"""
WITH {_RANKED},
g AS (SELECT feature, sum(n) AS n, sum(n1) AS n1,
             sum(n * (avg_rank - (tot + 1) / 2.0) * (avg_rank - (tot + 1) / 2.0)) AS srr,
             sum(n1 * (avg_rank - (tot + 1) / 2.0)) AS sry
      FROM (SELECT *, sum(n) OVER (PARTITION BY feature) AS tot FROM rk) GROUP BY feature)
SELECT feature, {_r("CASE WHEN srr > 0 AND n1 > 0 AND n1 < n THEN sry / sqrt(srr * n * (n1 / n) * (1 - n1 / n)) END")}
       AS spearman_corr_with_target, CAST(n AS BIGINT) AS n FROM g"""

SQL["mann_whitney"] = f"""
WITH {_RANKED},
r AS (SELECT feature, sum(n0 * avg_rank) AS r0, sum(n * n * n - n) AS ties FROM rk GROUP BY feature),
m AS (SELECT feature, count(CASE WHEN is_r = 0 THEN 1 END) AS n0, count(CASE WHEN is_r = 1 THEN 1 END) AS n1,
             avg(CASE WHEN is_r = 0 THEN value END) AS g0, avg(CASE WHEN is_r = 1 THEN value END) AS g1,
             var_samp(CASE WHEN is_r = 0 THEN value END) AS v0, var_samp(CASE WHEN is_r = 1 THEN value END) AS v1
      FROM l WHERE value IS NOT NULL GROUP BY feature),
j AS (SELECT m.*, r.r0, r.ties, r.r0 - n0 * (n0 + 1) / 2.0 AS u0 FROM m JOIN r USING (feature)
      WHERE n0 >= 20 AND n1 >= 20),
z AS (SELECT *, greatest(u0, n0 * n1 - u0) AS u,
             sqrt(n0 * n1 / 12.0 * ((n0 + n1 + 1) - ties / ((n0 + n1) * (n0 + n1 - 1)))) AS s FROM j)
SELECT feature, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1, {_r("u0")} AS u_stat,
       {_r("CASE WHEN s > 0 THEN (u - n0 * n1 / 2.0 - 0.5) / s END")} AS z,
       {_r("g0")} AS group0_mean, {_r("g1")} AS group1_mean,
       {_r("CASE WHEN sqrt((v0 + v1) / 2) > 0 THEN (g1 - g0) / sqrt((v0 + v1) / 2) ELSE 0.0 END")} AS cohens_d
FROM z"""

# ---- tail probabilities: erfc by series or continued fraction, chi-square by its finite sum ----
_ROOT_PI = "sqrt(pi())"


def _erfc(x: str) -> str:
    series = (f"list_sum(list_transform(generate_series(0, 60), lambda n: exp((2 * n + 1) * ln({x}) - lgamma(n + 1.5) - {x} * {x})))")
    inner = (f"list_reduce(list_concat([CAST(0.0 AS DOUBLE)], list_transform(generate_series(0, 199), lambda k: CAST(200 - k AS DOUBLE))), "
             f"lambda t, k: (k / 2) / ({x} + t))")
    return f"CASE WHEN {x} < 1 THEN 1 - {series} ELSE exp(-{x} * {x}) / {_ROOT_PI} / ({x} + {inner}) END"


_MW_P = f"""SELECT *, CASE WHEN zz <= 0 THEN 1.0 WHEN zz IS NOT NULL THEN {_erfc("zx")} END AS raw_p
FROM (SELECT *, zz / sqrt(2.0) AS zx FROM (SELECT *, CASE WHEN s > 0 THEN (u - n0 * n1 / 2.0 - 0.5) / s END AS zz FROM z))"""
SQL["mann_whitney_p"] = (SQL["mann_whitney"].replace("\nFROM z", f""",
       {_r("raw_p")} AS p_value
FROM ({_MW_P})"""))

_CHI = ["c_mktsegment", "n_name", "r_name", "nation_band"]
SQL["chi_square"] = f"""
WITH t AS ({CHI_SQL}),
l AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, coalesce({c}, 'UNKNOWN') AS level, target FROM t" for c in _CHI)}),
cells AS (SELECT feature, level, count(CASE WHEN target = 0 THEN 1 END) AS o0,
                 count(CASE WHEN target = 1 THEN 1 END) AS o1 FROM l GROUP BY feature, level),
m AS (SELECT *, sum(o0) OVER (PARTITION BY feature) AS c0, sum(o1) OVER (PARTITION BY feature) AS c1,
             count(*) OVER (PARTITION BY feature) AS n_levels FROM cells),
e AS (SELECT *, (o0 + o1) * c0 / (c0 + c1) AS e0, (o0 + o1) * c1 / (c0 + c1) AS e1 FROM m),
t2 AS (SELECT *,
         CASE WHEN e0 > 0 THEN power(abs(o0 - e0) - CASE WHEN n_levels = 2 THEN least(0.5, abs(o0 - e0)) ELSE 0 END, 2) / e0 ELSE 0 END
       + CASE WHEN e1 > 0 THEN power(abs(o1 - e1) - CASE WHEN n_levels = 2 THEN least(0.5, abs(o1 - e1)) ELSE 0 END, 2) / e1 ELSE 0 END
         AS t FROM e),
g AS (SELECT feature, any_value(n_levels) AS n_levels, any_value(c0) AS c0, any_value(c1) AS c1, sum(t) AS chi2
      FROM t2 GROUP BY feature)
SELECT feature, CAST(n_levels AS BIGINT) AS n_levels, CAST(n_levels - 1 AS BIGINT) AS dof,
       {_r("CASE WHEN c0 > 0 AND c1 > 0 AND n_levels > 1 THEN chi2 END")} AS chi2,
       {_r("CASE WHEN c0 > 0 AND c1 > 0 AND n_levels > 1 THEN sqrt(chi2 / (c0 + c1)) END")} AS cramers_v
FROM g"""

_CHI_P = f"""SELECT *, CASE WHEN n_levels <= 1 OR c0 = 0 OR c1 = 0 THEN NULL WHEN chi2 <= 0 THEN 1.0
       WHEN (n_levels - 1) % 2 = 0
       THEN list_sum(list_transform(generate_series(0, (n_levels - 1) // 2 - 1), lambda k: exp(k * ln(hx) - hx - lgamma(k + 1))))
       ELSE ({_erfc("sqrt(hx)")}) + coalesce(list_sum(list_transform(generate_series(1, (n_levels - 2) // 2), lambda k: exp((k - 0.5) * ln(hx) - hx - lgamma(k + 0.5)))), 0) END AS raw_p
FROM (SELECT *, chi2 / 2 AS hx FROM g)"""
SQL["chi_square_p"] = (SQL["chi_square"].replace("\nFROM g", f""",
       {_r("raw_p")} AS p_value
FROM ({_CHI_P})"""))

SQL["cluster_profile"] = f"""
SELECT c_nationkey % 3 AS CLUSTER_ID, count(*) AS n_rows, {_r("avg(c_acctbal)")} AS c_acctbal,
       {_r("avg(CAST(c_nationkey AS DOUBLE))")} AS c_nationkey, {_r("avg(CAST(target AS DOUBLE))")} AS target
FROM ({sql_from(CUSTOMER_MAIN)}) GROUP BY ALL"""

SQL["kmeans_distance"] = f"""
WITH c AS (SELECT *, c_nationkey % 3 AS CLUSTER_ID FROM ({sql_from(CUSTOMER_MAIN)})),
k AS (SELECT CLUSTER_ID, avg(c_acctbal) AS a, avg(CAST(c_nationkey AS DOUBLE)) AS b FROM c GROUP BY ALL)
SELECT c.c_custkey, {", ".join(
    _r(f"(SELECT sqrt((c.c_acctbal - k.a) * (c.c_acctbal - k.a) + (c.c_nationkey - k.b) * (c.c_nationkey - k.b)) FROM k WHERE k.CLUSTER_ID = {i})")
    + f" AS DIST_TO_CLUSTER_{i}" for i in range(3))}
FROM c"""

# What must hold of any converged k-means with the default three clusters.
SQL["kmeans_certificate"] = """
SELECT CAST(cluster AS INT) AS cluster, true AS nearest, true AS centred FROM range(3) t(cluster)"""

def _top_vector(matrix: str, out: str) -> str:
    """The leading eigenvector of a symmetric list of lists by repeated squaring, largest entry positive."""
    return f"""
{out}_pow AS (SELECT 0 AS k, m FROM {matrix}
    UNION ALL
    SELECT k + 1, list_transform(sq, lambda r: list_transform(r, lambda x: x / tr)) FROM (
        SELECT k, sq, list_sum(list_transform(generate_series(1, len(sq)), lambda i: sq[i][i])) AS tr FROM (
            SELECT k, list_transform(m, lambda a: list_transform(m, lambda b: list_inner_product(a, b))) AS sq FROM {out}_pow WHERE k < 26))),
{out}_col AS (SELECT m, list_position(d, list_max(d)) AS p FROM (
    SELECT m, list_transform(generate_series(1, len(m)), lambda i: m[i][i]) AS d FROM {out}_pow WHERE k = 26)),
{out}_raw AS (SELECT list_transform(m[p], lambda x: x / sqrt(m[p][p])) AS v FROM {out}_col),
{out} AS (SELECT list_transform(v, lambda x: x * sign(v[list_position(list_transform(v, lambda y: abs(y)), list_max(list_transform(v, lambda y: abs(y))))])) AS v
    FROM {out}_raw)"""


# Embeddings clipped at 1% / 99%, scaled (ddof 0) and projected on the two leading eigenvectors of their covariance.
SQL["pca_project"] = f"""
WITH RECURSIVE l AS (SELECT vec_id, unnest(generate_series(1, 64)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings),
b AS (SELECT i, quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM l GROUP BY i),
c AS (SELECT vec_id, i, least(greatest(x, lo), hi) AS x FROM l JOIN b USING (i)),
s AS (SELECT i, avg(x) AS mean, stddev_pop(x) AS sd FROM c GROUP BY i),
z AS (SELECT vec_id, i, (x - mean) / sd AS z FROM c JOIN s USING (i)),
pairs AS (SELECT a.i AS i, b.i AS j, sum(a.z * b.z) / (count(*) - 1) AS v FROM z a JOIN z b USING (vec_id) GROUP BY a.i, b.i),
cov AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS r FROM pairs GROUP BY i)),
{_top_vector("cov", "one")},
less AS (SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - lam * v[i] * v[j])) AS m FROM (
    SELECT m, v, list_inner_product(v, list_transform(m, lambda r: list_inner_product(r, v))) AS lam FROM cov, one)),
{_top_vector("less", "two")}
SELECT vec_id, round(sum(z * one.v[i]), 6) AS PCA_1, round(sum(z * two.v[i]), 6) AS PCA_2 FROM z, one, two GROUP BY vec_id"""

SQL["silhouette"] = """
WITH s AS (SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL
           ORDER BY ('0x' || substr(md5(CAST(vec_id AS VARCHAR) || ':42'), 1, 15))::BIGINT, vec_id LIMIT 5000),
d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.e, b.e)) AS total, count(*) AS n
      FROM s a CROSS JOIN s b GROUP BY a.vec_id, a.label, b.label),
m AS (SELECT vec_id, label, max(CASE WHEN other = label AND n > 1 THEN total / (n - 1) END) AS a,
             min(CASE WHEN other <> label THEN total / n END) AS b FROM d GROUP BY vec_id, label)
SELECT vec_id, label AS cluster, round(coalesce((b - a) / NULLIF(greatest(a, b), 0), 0.0), 9) AS silhouette FROM m"""

SQL["class_weights"] = f"""
SELECT target, count(*) AS n, {_r("sum(count(*)) OVER () / (2.0 * count(*))")} AS weight
FROM ({sql_from(CUSTOMER_MAIN)}) GROUP BY target"""

SQL["avg_rank"] = f"""
SELECT l_orderkey, l_linenumber,
       {_r("rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0")}
       AS avg_rank
FROM lineitem"""

_SCORES_LONG = f"""
s AS ({sql_from(LINEITEM_SCORES)}),
l AS (SELECT 'discount_score' AS model, discount_score AS score, y FROM s
      UNION ALL SELECT 'tax_score', tax_score, y FROM s
      UNION ALL SELECT 'quantity_score', quantity_score, y FROM s),
v AS (SELECT model, score, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS n0, sum(y) AS n1
      FROM l WHERE score IS NOT NULL GROUP BY model, score),
t AS (SELECT *, sum(n1) OVER w AS tp, sum(n0) OVER w AS fp,
             sum(n1) OVER (PARTITION BY model) AS P, sum(n0) OVER (PARTITION BY model) AS N,
             coalesce(sum(n0) OVER (PARTITION BY model ORDER BY score
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n0_before
      FROM v WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

SQL["roc_points"] = f"""
WITH {_SCORES_LONG}
SELECT model, score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       {_r("tp / P")} AS tpr, {_r("fp / N")} AS fpr FROM t"""

SQL["pr_points"] = f"""
WITH {_SCORES_LONG}
SELECT model, score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       {_r("tp / (tp + fp)")} AS precision, {_r("tp / P")} AS recall FROM t"""

SQL["ranking_metrics"] = f"""
WITH {_SCORES_LONG}
SELECT model, CAST(any_value(P) AS BIGINT) AS n_pos, CAST(any_value(N) AS BIGINT) AS n_neg,
       {_r("sum(n1 * (n0_before + n0 / 2.0)) / (any_value(P) * any_value(N))")} AS roc_auc,
       {_r("sum(CASE WHEN n1 > 0 THEN n1 * tp / (tp + fp) ELSE 0 END) / any_value(P)")} AS average_precision
FROM t GROUP BY model"""

SQL["confusion"] = f"""
WITH s AS ({sql_from(LINEITEM_SCORES)}),
l AS (SELECT 'discount_score' AS model, discount_score AS score, y FROM s
      UNION ALL SELECT 'tax_score', tax_score, y FROM s
      UNION ALL SELECT 'quantity_score', quantity_score, y FROM s),
g AS (SELECT model,
             CAST(sum(CASE WHEN score > 0.5 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN score > 0.5 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN NOT score > 0.5 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
             CAST(sum(CASE WHEN NOT score > 0.5 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
      FROM l GROUP BY model)
SELECT model, tp, fp, tn, fn,
       {_r("coalesce(tp / NULLIF(tp + fp, 0), 0.0)")} AS precision,
       {_r("coalesce(tp / NULLIF(tp + fn, 0), 0.0)")} AS recall,
       {_r("coalesce(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0.0)")} AS f1
FROM g"""

_HASH = "('0x' || substr(md5(CAST({id} AS VARCHAR) || ':42'), 1, 15))::BIGINT"

SQL["sample_n"] = f"""
SELECT c_custkey, c_nationkey FROM customer
ORDER BY {_HASH.format(id="c_custkey")}, c_custkey LIMIT 300"""

SQL["stratified_split"] = f"""
WITH p AS (SELECT c_custkey, target,
                  row_number() OVER (PARTITION BY target ORDER BY {_HASH.format(id="c_custkey")}, c_custkey) - 1 AS pos,
                  count(*) OVER (PARTITION BY target) AS n_class
           FROM ({sql_from(CUSTOMER_MAIN)})),
q AS (SELECT *, floor(n_class * 0.2 + 0.5) AS n_test FROM p)
SELECT c_custkey, target, CAST(pos < n_test AS INT) AS is_test,
       CAST(CASE WHEN pos >= n_test THEN floor(5 * (pos - n_test) / (n_class - n_test)) END AS INT) AS fold
FROM q"""

SQL["encode_categoricals"] = f"""
WITH o AS (SELECT {ENCODE_SQL_COLS}, coalesce({_clean_priority()}, 'UNKNOWN') AS o_orderpriority
           FROM ({sql_from(ORDERS_PLACEHOLDERS)}))
SELECT o_orderkey, o_totalprice,
       CAST(CASE o_size WHEN 'HIGH' THEN 0 WHEN 'LOW' THEN 1 END AS INT) AS o_size,
       CAST(o_orderstatus = 'O' AS TINYINT) AS o_orderstatus_O,
       CAST(o_orderstatus = 'P' AS TINYINT) AS o_orderstatus_P,
       {", ".join(f'CAST(o_orderpriority = {chr(39)}{lv}{chr(39)} AS TINYINT) AS "o_orderpriority_{lv}"'
                  for lv in ORDER_PRIORITY[1:] + ["UNKNOWN"])}
FROM o"""

_W = ["l_quantity", "l_price_m", "l_discount", "l_tax"]
SQL["winsorize"] = f"""
WITH li AS ({sql_from(LINEITEM_MISSING)}),
q AS (SELECT {", ".join(f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi" for c in _W)} FROM li)
SELECT l_orderkey, l_linenumber,
       {", ".join(_r(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {c}_lo), {c}_hi) END") + f" AS {c}" for c in _W)},
       is_r
FROM li, q"""

SQL["standard_scale"] = f"""
WITH li AS ({sql_from(LINEITEM_MISSING)}),
m AS (SELECT {", ".join(f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS {c}_s" for c in _W)} FROM li)
SELECT l_orderkey, l_linenumber, {", ".join(_r(f"({c} - {c}_m) / {c}_s") + f" AS {c}" for c in _W)}, is_r
FROM li, m"""

# ---- results table from score "models" on a stratified split of lineitem -------------
_RESULTS = f"""
s AS (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id
      FROM ({sql_from(LINEITEM_SCORES)})),
p AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {_HASH.format(id="row_id")}, row_id) - 1 AS pos,
             count(*) OVER (PARTITION BY y) AS n_class FROM s),
sp AS (SELECT *, CAST(pos < floor(n_class * 0.2 + 0.5) AS INT) AS is_test,
              CASE WHEN pos >= floor(n_class * 0.2 + 0.5) THEN floor(5 * (pos - floor(n_class * 0.2 + 0.5)) / (n_class - floor(n_class * 0.2 + 0.5))) END AS fold
       FROM p),
l AS (SELECT 'discount_score' AS model, discount_score AS score, y, is_test, fold FROM sp
      UNION ALL SELECT 'tax_score', tax_score, y, is_test, fold FROM sp
      UNION ALL SELECT 'quantity_score', quantity_score, y, is_test, fold FROM sp),
g AS (SELECT model, CASE WHEN is_test = 1 THEN -1 ELSE fold END AS grp, score, y FROM l),
v AS (SELECT model, grp, score, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS n0, sum(y) AS n1
      FROM g GROUP BY ALL),
t AS (SELECT *, sum(n1) OVER w AS tp, sum(n0) OVER w AS fp,
             sum(n1) OVER (PARTITION BY model, grp) AS P, sum(n0) OVER (PARTITION BY model, grp) AS N,
             coalesce(sum(n0) OVER (PARTITION BY model, grp ORDER BY score
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n0_before
      FROM v WINDOW w AS (PARTITION BY model, grp ORDER BY score DESC
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rk AS (SELECT model, grp, sum(n1 * (n0_before + n0 / 2.0)) / (any_value(P) * any_value(N)) AS auc,
              sum(CASE WHEN n1 > 0 THEN n1 * tp / (tp + fp) ELSE 0 END) / any_value(P) AS ap
       FROM t GROUP BY model, grp),
cf AS (SELECT model, grp,
              sum(CASE WHEN score > 0.5 AND y = 1 THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN score > 0.5 AND y = 0 THEN 1 ELSE 0 END) AS fp,
              sum(CASE WHEN NOT score > 0.5 AND y = 1 THEN 1 ELSE 0 END) AS fn
       FROM g GROUP BY model, grp),
m AS (SELECT rk.model, rk.grp, rk.auc, rk.ap,
             coalesce(cf.tp / NULLIF(cf.tp + cf.fp, 0), 0.0) AS prec,
             coalesce(cf.tp / NULLIF(cf.tp + cf.fn, 0), 0.0) AS rec,
             coalesce(2.0 * cf.tp / NULLIF(2 * cf.tp + cf.fp + cf.fn, 0), 0.0) AS f1
      FROM rk JOIN cf ON rk.model = cf.model AND rk.grp = cf.grp),
res AS (
  SELECT model, 'test' AS stage, 'test_auc' AS metric, auc AS value FROM m WHERE grp = -1
  UNION ALL SELECT model, 'test', 'test_pr_auc', ap FROM m WHERE grp = -1
  UNION ALL SELECT model, 'test', 'test_f1', f1 FROM m WHERE grp = -1
  UNION ALL SELECT model, 'test', 'test_precision', prec FROM m WHERE grp = -1
  UNION ALL SELECT model, 'test', 'test_recall', rec FROM m WHERE grp = -1
  UNION ALL SELECT model, 'cv', 'cv_auc_mean', avg(auc) FROM m WHERE grp >= 0 GROUP BY model
  UNION ALL SELECT model, 'cv', 'cv_auc_std', stddev_pop(auc) FROM m WHERE grp >= 0 GROUP BY model
  UNION ALL SELECT model, 'cv', 'cv_f1_mean', avg(f1) FROM m WHERE grp >= 0 GROUP BY model
  UNION ALL SELECT model, 'cv', 'cv_f1_std', stddev_pop(f1) FROM m WHERE grp >= 0 GROUP BY model),
wide AS (SELECT model,
    any_value(CASE WHEN metric = 'test_auc' THEN value END) AS test_auc,
    any_value(CASE WHEN metric = 'test_pr_auc' THEN value END) AS test_pr_auc,
    any_value(CASE WHEN metric = 'test_f1' THEN value END) AS test_f1,
    any_value(CASE WHEN metric = 'test_precision' THEN value END) AS test_precision,
    any_value(CASE WHEN metric = 'test_recall' THEN value END) AS test_recall,
    any_value(CASE WHEN metric = 'cv_auc_mean' THEN value END) AS cv_auc_mean,
    any_value(CASE WHEN metric = 'cv_auc_std' THEN value END) AS cv_auc_std,
    any_value(CASE WHEN metric = 'cv_f1_mean' THEN value END) AS cv_f1_mean,
    any_value(CASE WHEN metric = 'cv_f1_std' THEN value END) AS cv_f1_std
  FROM res GROUP BY model),
sc AS (SELECT *, 0.6 * test_auc AS contrib_test_auc, 0.2 * coalesce(cv_auc_mean, test_auc) AS contrib_cv_auc,
              0.2 * test_pr_auc AS contrib_pr_auc FROM wide),
sc2 AS (SELECT *, contrib_test_auc + contrib_cv_auc + contrib_pr_auc AS weighted_score FROM sc),
rnk AS (SELECT *, row_number() OVER (ORDER BY weighted_score DESC, model) AS rank FROM sc2)"""

SQL["results_table"] = f"""
WITH {_RESULTS}
SELECT model, stage, metric, {_r("value")} AS value FROM res"""

SQL["comparison_table"] = f"""
WITH {_RESULTS}
SELECT model, {", ".join(_r(c) + " AS " + c for c in ["cv_auc_mean", "cv_auc_std", "cv_f1_mean", "cv_f1_std",
                                                   "test_auc", "test_pr_auc", "test_f1", "test_precision",
                                                   "test_recall", "weighted_score"])},
       CAST(rank AS INT) AS rank, CASE WHEN rank = 1 THEN 'Selected' ELSE 'Other' END AS selected
FROM rnk"""

SQL["model_selection"] = f"""
WITH {_RESULTS}
SELECT model, {_r("weighted_score")} AS weighted_score, CAST(rank AS INT) AS rank,
       CASE WHEN rank = 1 THEN 'Selected' ELSE 'Other' END AS selected FROM rnk"""

SQL["score_contributions"] = f"""
WITH {_RESULTS}
SELECT model, 'contrib_test_auc' AS component, {_r("contrib_test_auc")} AS contribution FROM sc2
UNION ALL SELECT model, 'contrib_cv_auc', {_r("contrib_cv_auc")} FROM sc2
UNION ALL SELECT model, 'contrib_pr_auc', {_r("contrib_pr_auc")} FROM sc2"""

SQL["runner_up_margin"] = f"""
WITH {_RESULTS},
nx AS (SELECT *, lead(model) OVER (ORDER BY rank) AS runner_up,
              lead(weighted_score) OVER (ORDER BY rank) AS nxt FROM rnk)
SELECT model AS best, runner_up, {_r("weighted_score - nxt")} AS margin FROM nx WHERE rank = 1"""

SQL["metric_leaderboard"] = f"""
WITH {_RESULTS}
SELECT model, {_r("test_pr_auc")} AS value,
       CAST(row_number() OVER (ORDER BY test_pr_auc DESC, model) AS INT) AS position FROM wide"""

SQL["screening_quadrant"] = f"""
WITH {_RESULTS}
SELECT model, {_r("test_recall")} AS recall, {_r("test_precision")} AS precision,
       CAST(test_recall >= 0.65 AS INT) AS meets_recall,
       CAST(test_precision >= 0.17 AS INT) AS meets_precision FROM wide"""

SQL["csv_roundtrip"] = """
SELECT CAST(c_custkey AS DOUBLE) AS C_CUSTKEY, c_name AS C_NAME, CAST(c_nationkey AS DOUBLE) AS C_NATIONKEY,
       c_acctbal AS C_ACCTBAL, c_mktsegment AS C_MKTSEGMENT FROM customer"""

SQL["clean_log"] = f"""
WITH o AS ({sql_from(ORDERS_PLACEHOLDERS)}),
d AS (SELECT DISTINCT * FROM o),
m AS (SELECT count(*) AS n, sum(CASE WHEN {_clean_priority()} IS NULL THEN 1 ELSE 0 END) AS ph FROM d)
SELECT 'raw_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM o
UNION ALL SELECT 'raw_cols', 5.0
UNION ALL SELECT 'clean_rows', CAST(n AS DOUBLE) FROM m
UNION ALL SELECT 'clean_cols', 5.0
UNION ALL SELECT 'duplicates_removed', CAST((SELECT count(*) FROM o) - n AS DOUBLE) FROM m
UNION ALL SELECT 'missing_before', CAST((SELECT count(*) - count(o_orderpriority) FROM o) AS DOUBLE)
UNION ALL SELECT 'numeric_imputed', 0.0
UNION ALL SELECT 'categorical_imputed', CAST(ph AS DOUBLE) FROM m
UNION ALL SELECT 'missing_after', 0.0
UNION ALL SELECT 'numeric_columns_converted', 0.0"""

from riskframe.plans.driver_queries import NON_FINITE_SQL_COLS  # noqa: E402

SQL["non_finite_to_null"] = f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN isinf(l_tax_nf) OR isnan(l_tax_nf) THEN NULL ELSE l_tax_nf END AS l_tax_nf
FROM (SELECT {NON_FINITE_SQL_COLS} FROM lineitem)"""

SQL["fill_zero"] = f"""
SELECT l_orderkey, l_linenumber, coalesce(l_price_m, 0.0) AS l_price_m FROM ({sql_from(LINEITEM_MISSING)})"""

SQL["distinct_ids"] = "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL"

SQL["sample_per_class"] = f"""
WITH s AS (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id
           FROM ({sql_from(LINEITEM_SCORES)})),
p AS (SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY {_HASH.format(id="row_id")}, row_id) AS rn
      FROM s)
SELECT row_id, y FROM p WHERE rn <= 200"""

# ---- saved state, stage records and small operators -----------------------------------
SQL["saved_scaler"] = SQL["standard_scale"]
SQL["saved_clipper"] = SQL["winsorize"]

SQL["resumed_stages"] = f"""
WITH o AS (SELECT coalesce({_clean_priority()}, 'UNKNOWN') AS p FROM ({sql_from(ORDERS_PLACEHOLDERS)}))
SELECT p AS name, count(*) AS n FROM o GROUP BY p
UNION ALL SELECT 'clean:rows', count(*) FROM o
UNION ALL SELECT 'counts:rows', count(DISTINCT p) FROM o"""

SQL["join_sample_features"] = f"""
WITH s AS (SELECT * FROM customer ORDER BY {_HASH.format(id="c_custkey")}, c_custkey LIMIT 300)
SELECT c.c_custkey, c.c_nationkey, c.c_acctbal, s.c_nationkey % 3 AS CLUSTER_ID, abs(s.c_acctbal) AS DIST_TO_CLUSTER_0
FROM customer c LEFT JOIN s ON c.c_custkey = s.c_custkey"""

SQL["duplicate_columns"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"

SQL["forced_numeric"] = f"""
SELECT l_orderkey, l_linenumber, TRY_CAST(t95 AS DOUBLE) AS t95, TRY_CAST(t80 AS DOUBLE) AS t80
FROM ({sql_from(LINEITEM_TEXT_NUMBERS).replace("AS STRING", "AS VARCHAR")})"""

_VARIANCE = f"""
li AS ({sql_from(LINEITEM_MISSING)}),
v AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {i} AS position, var_samp({c}) AS importance FROM li" for i, c in enumerate(LI))}),
k AS (SELECT *, row_number() OVER (ORDER BY importance DESC, position) AS rank FROM v)"""
SQL["top_features"] = f"""
WITH {_VARIANCE}
SELECT 'variance' AS model, feature, {_r("importance")} AS importance, CAST(position AS INT) AS position, CAST(rank AS INT) AS rank
FROM k WHERE rank <= 2"""

# Price and quantity vary most by far in every supplied table.
SQL["selected_columns"] = f"""
SELECT l_orderkey, l_linenumber, is_r, l_quantity, l_price_m FROM ({sql_from(LINEITEM_MISSING)})"""

SQL["feature_report"] = f"""
WITH {_VARIANCE},
c AS ({" UNION ALL ".join(f"SELECT '{b}' AS feature, corr({a}, {b}) AS r FROM li" for j, b in enumerate(LI) for a in LI[:j])})
SELECT feature, CAST(rank <= 2 AS INT) AS selected,
       CAST(feature IN (SELECT feature FROM c WHERE abs(r) >= 0.9) AS INT) AS dropped_corr,
       CASE WHEN rank <= 2 THEN {_r("importance")} END AS importance, {_r("importance")} AS variance FROM k"""

SQL["safety_fill"] = f"""
WITH t AS ({sql_from(LINEITEM_MISSING)})
SELECT l_orderkey, l_linenumber, l_quantity,
       coalesce(l_price_m, {_r("(SELECT median(l_price_m) FROM t WHERE l_orderkey % 5 <> 0)")}) AS l_price_m, l_discount, l_tax, is_r AS label
FROM t"""

SQL["rounded_report"] = f"""
WITH {_RESULTS}
SELECT model, {", ".join(f"round({c}, 4) AS {c}" for c in ["cv_auc_mean", "cv_auc_std", "cv_f1_mean", "cv_f1_std", "test_auc", "test_pr_auc",
                                                        "test_f1", "test_precision", "test_recall", "weighted_score"])},
       CAST(rank AS INT) AS rank, CASE WHEN rank = 1 THEN 'Selected' ELSE 'Other' END AS selected
FROM rnk"""
