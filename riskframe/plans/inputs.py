"""The driver's tables in the roles the reference's operators expect.

Roles (see FIXTURES.md): main = ``customer`` with target ``c_acctbal < 0``;
support 1 = ``orders`` by ``o_custkey``; support 2 = ``lineitem`` through
``orders``; rank tests and curves = ``lineitem`` with target
``l_returnflag = 'R'``.  The supplied tables have no missing values,
placeholders or sentinels, so each variant below injects them with one SQL
expression over the WHOLE table; the same text runs in Spark and in DuckDB
(``oracle.py``), so both engines see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- SQL text shared by Spark and the DuckDB oracle ----------------------------
# Each entry: (source table, select list).  ``{src}`` is the table reference.

CUSTOMER_MAIN = ("customer", """
    c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
    CAST(c_acctbal < 0 AS INT) AS target""")

ORDERS_PLACEHOLDERS = ("orders", """
    o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    CASE WHEN o_orderkey % 11 = 0 THEN ' N/A '
         WHEN o_orderkey % 13 = 0 THEN ''
         ELSE o_orderpriority END AS o_orderpriority""")

LINEITEM_MISSING = ("lineitem", """
    l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS l_price_m,
    CAST(l_returnflag = 'R' AS INT) AS is_r""")

LINEITEM_TEXT_NUMBERS = ("lineitem", """
    l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 20 = 0 THEN 'bad' ELSE CAST(l_linenumber AS STRING) END AS t95,
    CASE WHEN l_orderkey % 5 = 0 THEN 'bad' ELSE CAST(l_linenumber AS STRING) END AS t80""")

CUSTOMER_SENTINEL = ("customer", """
    c_custkey,
    CASE WHEN c_custkey % 5 = 0 THEN 365243 ELSE -30 * c_nationkey END AS DAYS_EMPLOYED""")

LINEITEM_SCORES = ("lineitem", """
    l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(l_returnflag = 'R' AS INT) AS y,
    l_discount * 10 AS discount_score,
    l_tax * CAST(12.5 AS DOUBLE) AS tax_score,
    l_quantity / 50 AS quantity_score""")

# Applicant-like main table: reference column names, values derived from
# customer and per-customer order aggregates.
APPLICANTS_SQL = """
WITH oa AS (
    SELECT o_custkey, max(o_totalprice) AS o_max, avg(o_totalprice) AS o_avg,
           min(o_totalprice) AS o_min, count(*) AS o_cnt
    FROM orders GROUP BY o_custkey)
SELECT c.c_custkey AS SK_ID_CURR,
       CAST(c.c_acctbal < 0 AS INT) AS TARGET,
       abs(c.c_acctbal) AS AMT_INCOME_TOTAL,
       oa.o_max AS AMT_CREDIT,
       oa.o_avg / 12 AS AMT_ANNUITY,
       CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE oa.o_min END AS AMT_GOODS_PRICE,
       CAST(-(7000 + (c.c_custkey * 37) % 15000) AS DOUBLE) AS DAYS_BIRTH,
       CAST(CASE WHEN c.c_custkey % 5 = 0 THEN 365243 ELSE -30 * c.c_nationkey END AS DOUBLE)
           AS DAYS_EMPLOYED,
       CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE CAST(c.c_nationkey + 1 AS DOUBLE) / 26 END AS EXT_SOURCE_1,
       CAST((c.c_custkey * 7) % 100 AS DOUBLE) / 100 AS EXT_SOURCE_2,
       CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE CAST(oa.o_cnt AS DOUBLE) / 40 END AS EXT_SOURCE_3,
       CAST(c.c_mktsegment = 'BUILDING' AS INT) AS FLAG_DOCUMENT_2,
       CAST(c.c_nationkey % 2 = 0 AS INT) AS FLAG_DOCUMENT_3,
       oa.o_avg AS BUREAU_AMT_CREDIT_SUM_MEAN,
       CASE WHEN c.c_custkey % 6 = 0 THEN oa.o_min ELSE 0.0 END AS BUREAU_AMT_CREDIT_SUM_OVERDUE_MEAN,
       oa.o_min AS PREV_AMT_CREDIT_MEAN,
       CAST(-(c.c_custkey % 400) AS DOUBLE) AS DAYS_LAST_PHONE_CHANGE,
       CAST(c.c_custkey % 4 AS DOUBLE) AS OBS_30_CNT_SOCIAL_CIRCLE,
       CAST(c.c_custkey % 3 AS DOUBLE) AS DEF_30_CNT_SOCIAL_CIRCLE,
       CAST(c.c_nationkey % 7 AS DOUBLE) AS AMT_REQ_CREDIT_BUREAU_YEAR,
       c.c_mktsegment AS NAME_CONTRACT_TYPE
FROM customer c LEFT JOIN oa ON c.c_custkey = oa.o_custkey"""


def derived(spark: SparkSession, sf_dir: str, spec: tuple[str, str]) -> DataFrame:
    src, select = spec
    return table(spark, sf_dir, src).selectExpr(*_split_select(select))


def _split_select(select: str) -> list[str]:
    """Split a select list on top-level commas."""
    out, depth, cur = [], 0, []
    for ch in select:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            out.append("".join(cur).strip())
            cur = []
        else:
            cur.append(ch)
    if "".join(cur).strip():
        out.append("".join(cur).strip())
    return out


def sql_from(spec: tuple[str, str]) -> str:
    src, select = spec
    return f"SELECT {select} FROM {src}"


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in ("customer", "orders"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"_rf_{name}")
    text = APPLICANTS_SQL.replace("FROM orders", "FROM _rf_orders") \
        .replace("FROM customer c", "FROM _rf_customer c")
    return spark.sql(text)
