"""One query per relational construct that flow steps are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.catalog.derived import table
from flowspark.operators import relational as R


def load_projection(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("amount"),
        F.expr("try_cast(o_orderpriority AS INT)").alias("priority_no"),
        F.lit("1").alias("stt"),
    )


def filter_not_null(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return df.filter(F.col("priority").isNotNull() & F.col("o_custkey").isNotNull()).select("o_orderkey", "priority")


def filter_predicates(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return (
        table(spark, sf, "lineitem")
        .filter((c("l_returnflag") != "N") & c("l_linenumber").isin(1, 2, 3) & ~c("l_linestatus").isin("X"))
        .filter((c("l_quantity") < 5) | (c("l_discount") == 0.05))
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    )


def filter_range(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders")
    day = F.to_date(F.lit("1997-01-01")), F.to_date(F.lit("1997-06-30"))
    return df.filter(F.col("o_orderdate").between(*day)).select("o_orderkey", "o_custkey")


def account_info(spark: SparkSession, sf: str) -> DataFrame:
    """Latest order per customer, joined to customer, nation and region."""
    latest = R.first_per_key(
        table(spark, sf, "orders").filter("o_orderstatus IN ('O', 'F')").select("o_custkey", "o_orderkey", "o_orderdate"),
        ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey"),
    )
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        table(spark, sf, "customer")
        .join(latest, F.col("c_custkey") == F.col("o_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_name", "o_orderkey", "n_name", "r_name")
        .distinct()
    )


def counterparty(spark: SparkSession, sf: str) -> DataFrame:
    lines = (
        table(spark, sf, "lineitem").filter("l_returnflag = 'R' AND l_linenumber <> 7")
        .select("l_orderkey", "l_suppkey").distinct()
    )
    names = table(spark, sf, "supplier").filter("s_acctbal > 0 OR s_nationkey = 1").select("s_suppkey", "s_name").distinct()
    final = F.when(F.left("s_name", F.lit(3)) == "Sup", F.reverse("s_name")).otherwise(F.col("s_name"))
    return lines.join(names, F.col("l_suppkey") == F.col("s_suppkey"), "left").select(
        "l_orderkey", "l_suppkey", "s_name", final.alias("s_name_final")
    )


def _recent(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").filter(
        F.col("o_orderdate") >= F.date_sub(F.to_date(F.lit("2001-08-01")), 90)
    ).select(F.col("o_custkey").alias("c_custkey"))


def inactive_customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").join(_recent(spark, sf), "c_custkey", "left_anti").select("c_custkey", "c_name")


def active_customers_semi(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").join(_recent(spark, sf), "c_custkey", "left_semi").select("c_custkey", "c_name")


def dedup_then_join(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return R.dedup_join(customers, _recent(spark, sf), ["c_custkey"])


def orders_by_nation(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per nation, counted per customer before any join. No broadcast is
    forced: Spark takes one where file sizes show the dimension to be small."""
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum(R.money("o_totalprice")).alias("amount")
    )
    return (
        per_customer.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.sum("n").alias("n_orders"), R.total(F.col("amount")).alias("amount"))
    )


def cross_small(spark: SparkSession, sf: str) -> DataFrame:
    """Join without a condition; one side is a global aggregate, so one row."""
    customers = table(spark, sf, "customer")
    peak = customers.agg(F.max("c_acctbal").alias("top_balance"))
    return customers.join(F.broadcast(peak)).select("c_custkey", "top_balance", (F.col("c_acctbal") == F.col("top_balance")).alias("is_top"))


def customer_totals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_custkey").agg(R.total(R.money("o_totalprice")).alias("total"))


def null_safe_totals(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.nullif(R.money("l_extendedprice"), F.when(F.col("l_linenumber") == 1, R.money("l_extendedprice")))
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        R.null_safe_total(amount).alias("total"),
        F.sum(F.ifnull(F.nullif("l_linenumber", F.lit(2)), F.lit(0)).cast("bigint")).alias("line_sum"),
    )


def recent_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _recent(spark, sf).distinct()


def agg_then_join(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return R.agg_join(
        lines, orders, "l_orderkey", "o_orderkey",
        F.count("*").alias("n_lines"), R.total(R.money("l_quantity")).alias("quantity"),
    ).select("o_orderkey", "o_orderstatus", "n_lines", "quantity")


def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return R.first_per_key(orders, ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey")).drop("o_orderdate")


def statement_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.lit("1").alias("stt"), "l_suppkey", "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"
    )
    order = [F.asc(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]
    return R.first_per_key(lines, ["l_suppkey", "l_returnflag", "l_linestatus"], *order).drop("l_shipdate")


def monthly_revenue(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.month("o_orderdate").alias("month_no"),
        F.date_trunc("month", F.col("o_orderdate")).cast("date").cast("string").alias("month_start"),
        F.trunc(day, "YEAR").cast("string").alias("year_start"),
    ).agg(R.total(R.money("o_totalprice")).alias("revenue"))


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat_ws("\r", "lang", "source", "text")
    return table(spark, sf, "documents").select("doc_id", R.clean_text(raw).alias("text"), R.shorten("text", 80).alias("short"))


QUERIES = {
    f.__name__: f
    for f in (
        load_projection, filter_not_null, filter_predicates, filter_range, account_info, counterparty,
        inactive_customers, active_customers_semi, dedup_then_join, orders_by_nation, cross_small,
        customer_totals, null_safe_totals, recent_customers, agg_then_join, latest_per_key,
        statement_lines, monthly_revenue, clean_text,
    )
}

_RECENT = "SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= DATE '2001-08-01' - 90"

ORACLE = {
    "load_projection": """SELECT o_orderkey AS order_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
        TRY_CAST(o_orderpriority AS INT) AS priority_no, '1' AS stt FROM orders""",
    "filter_not_null": "SELECT o_orderkey, o_orderpriority AS priority FROM orders WHERE o_orderpriority <> '5-LOW' AND o_custkey IS NOT NULL",
    "filter_predicates": """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
        WHERE l_returnflag <> 'N' AND l_linenumber IN (1, 2, 3) AND l_linestatus NOT IN ('X') AND (l_quantity < 5 OR l_discount = CAST(0.05 AS DOUBLE))""",
    "filter_range": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'",
    "account_info": """SELECT DISTINCT c_custkey, c_name, o_orderkey, n_name, r_name FROM customer
        JOIN (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'F')
              QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) ON c_custkey = o_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "counterparty": """SELECT l_orderkey, l_suppkey, s_name, CASE WHEN left(s_name, 3) = 'Sup' THEN reverse(s_name) ELSE s_name END AS s_name_final
        FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber <> 7)
        LEFT JOIN (SELECT DISTINCT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0 OR s_nationkey = 1) ON l_suppkey = s_suppkey""",
    "inactive_customers": f"SELECT c_custkey, c_name FROM customer LEFT JOIN ({_RECENT}) ON c_custkey = k WHERE k IS NULL",
    "active_customers_semi": f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN ({_RECENT})",
    "dedup_then_join": f"SELECT c_custkey, c_mktsegment FROM customer JOIN ({_RECENT}) ON c_custkey = k",
    "orders_by_nation": """SELECT n_name, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "cross_small": """SELECT c_custkey, top_balance, c_acctbal = top_balance AS is_top FROM customer
        CROSS JOIN (SELECT max(c_acctbal) AS top_balance FROM customer)""",
    "customer_totals": "SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY o_custkey",
    "null_safe_totals": """SELECT l_returnflag, l_linestatus,
        CAST(sum(CASE WHEN l_linenumber = 1 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS total,
        CAST(sum(CASE WHEN l_linenumber = 2 THEN 0 ELSE l_linenumber END) AS BIGINT) AS line_sum
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "recent_customers": "SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderdate >= DATE '2001-08-01' - 90",
    "agg_then_join": """SELECT o_orderkey, o_orderstatus, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus""",
    "latest_per_key": """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "statement_lines": """SELECT '1' AS stt, l_suppkey, l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_returnflag, l_linestatus
                                   ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) = 1""",
    "monthly_revenue": """SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(month(o_orderdate) AS INT) AS month_no,
        CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
        CAST(CAST(date_trunc('year', o_orderdate) AS DATE) AS VARCHAR) AS year_start,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY ALL""",
    "clean_text": """SELECT doc_id, replace(concat_ws(chr(13), lang, source, text), chr(13), ' ') AS text,
        CASE WHEN length(text) > 80 THEN concat(substr(text, 1, 80), '...') ELSE text END AS short FROM documents""",
}
