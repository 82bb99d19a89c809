"""The library's input tables derived from the TPC-H-like test tables.

The real log, skills and bank files are not at hand, so each table below is computed
from whole test tables; FIXTURES.md lists the rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.plans import bank
from registra.plans.skills import SkillBase
from registra.sources.shared import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _comma_text(column: str) -> Column:
    return F.replace(F.col(column).cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))


def _comma_or_blank(column: str) -> Column:
    return F.when(F.col("l_linenumber") == 1, "").otherwise(_comma_text(column))


def user_logs(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    rows = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).join(
        suppliers, lines["l_suppkey"] == suppliers["s_suppkey"]
    )
    day = F.col("l_shipdate").cast("date")
    month = F.month(day)
    events = F.when(F.col("l_quantity") < 3, 0).otherwise(F.col("l_quantity").cast("int"))
    columns = {
        "courseid": (F.col("l_suppkey") % 10).cast("int"),
        "userid": F.col("o_custkey").cast("int"),
        "num_week": F.weekofyear(day),
        "s_all": F.when(F.col("l_discount") != 0, events),
        "s_all_avg": _comma_text("l_extendedprice"),
        "s_course_viewed": F.col("l_linenumber"),
        "s_course_viewed_avg": _comma_or_blank("l_discount"),
        "s_q_attempt_viewed": (F.col("l_partkey") % 5).cast("int"),
        "s_q_attempt_viewed_avg": _comma_or_blank("l_tax"),
        "s_a_course_module_viewed": (F.col("l_orderkey") % 7).cast("int"),
        "s_a_course_module_viewed_avg": _comma_or_blank("l_quantity"),
        "s_a_submission_status_viewed": (F.col("l_partkey") % 3).cast("int"),
        "s_a_submission_status_viewed_avg": _comma_or_blank("l_quantity"),
        "namer_level": F.when(F.col("l_linenumber") == 7, "pass").when(
            F.col("l_linenumber") != 6, F.substring("o_orderpriority", 1, 1)
        ),
        "name_vatt": F.col("o_orderstatus"),
        "depart": F.when(F.col("l_tax") != 0.08, F.col("s_nationkey") + 3),
        "name_osno": F.when(F.col("l_returnflag") == "A", "1").when(F.col("l_returnflag") == "N", "2").otherwise("3"),
        "name_formopril": F.col("l_returnflag"),
        "leveled": F.when(F.col("l_linestatus") == "F", "1").otherwise("2"),
        "num_sem": month,
        "kurs": month % 4 + 1,
        "date_vatt": F.date_format(day, "yyyy-MM-dd"),
    }
    return rows.select(*[value.alias(name) for name, value in columns.items()])


def departments(spark: SparkSession, folder: str) -> DataFrame:
    """All nations; logs name departments 3 to 27, so some ids have no department."""
    return table(spark, folder, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def skill_base(spark: SparkSession, folder: str) -> SkillBase:
    """People are customers and hold the size plus one of the parts they bought, so the
    largest id held names no knowledge. Knowledge is a part size, a competency is a brand
    and needs the sizes of its dearest part of each type; a position is a part type and
    needs the brands of its dearest and of its cheapest part."""
    parts = table(spark, folder, "part")
    bought = (
        spread(table(spark, folder, "lineitem").select("l_orderkey", "l_partkey"), "l_orderkey")
        .join(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    )
    dearest = F.struct("p_retailprice", "p_partkey")
    sizes = parts.groupBy("p_brand", "p_type").agg(F.max_by("p_size", dearest).alias("knowledge_id"))
    brands = parts.groupBy("p_type").agg(
        F.array(F.max_by("p_brand", dearest), F.min_by("p_brand", dearest)).alias("brands")
    )
    return SkillBase(
        skills=bought.select(
            F.col("o_custkey").cast("int").alias("employee_id"),
            F.concat(F.lit("person "), F.col("o_custkey").cast("string")).alias("full_name"),
            (F.col("p_size") + 1).alias("knowledge_id"),
        ),
        knowledge=parts.select(
            F.col("p_size").alias("knowledge_id"), F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("knowledge_name")
        ).distinct(),
        competencies=parts.select(F.col("p_brand").alias("competency_id"), F.upper("p_brand").alias("competency_name")).distinct(),
        competency_knowledge=sizes.select(F.col("p_brand").alias("competency_id"), "knowledge_id").distinct(),
        positions=parts.select(F.col("p_type").alias("position_id"), F.lower("p_type").alias("position_name")).distinct(),
        position_competency=brands.select(
            F.col("p_type").alias("position_id"), F.explode("brands").alias("competency_id")
        ).distinct(),
    )


def extra_requirements(spark: SparkSession, folder: str) -> DataFrame:
    """For each position the brand of its largest part."""
    largest = F.struct("p_size", "p_partkey")
    return table(spark, folder, "part").groupBy(F.col("p_type").alias("position_id")).agg(
        F.max_by("p_brand", largest).alias("competency_id")
    )


def extra_skills(spark: SparkSession, folder: str) -> DataFrame:
    """The sizes of the parts people bought, without the plus one."""
    return skill_base(spark, folder).skills.select("employee_id", (F.col("knowledge_id") - 1).alias("knowledge_id"))


@dataclass(frozen=True)
class Bank:
    clients: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    credits: DataFrame


def bank_tables(spark: SparkSession, folder: str) -> Bank:
    """Clients are customers, accounts and credits are orders, transactions are line items."""
    customers = table(spark, folder, "customer")
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem")
    ordered = F.col("o_orderdate").cast("date")
    shipped = F.col("l_shipdate").cast("date")
    priority = F.substring("o_orderpriority", 1, 1)
    # A number for a line item from all columns that together name it.
    digest = F.md5(
        F.concat_ws(
            "|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.col("l_extendedprice").cast("decimal(14,2)").cast("string"), F.date_format(shipped, "yyyy-MM-dd"),
        )
    )
    clients = customers.select(
        F.col("c_custkey").cast("int").alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("patronymic"),
        F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 18000).cast("int")).alias("birth_date"),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("passport_series"),
        F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("passport_number"),
        F.concat(F.lit("office "), F.col("c_nationkey").cast("string")).alias("passport_issued_by"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string"), F.lit("\nhouse "), F.col("c_custkey").cast("string")).alias("address"),
        F.concat(F.lit("+"), F.col("c_custkey").cast("string")).alias("phone"),
        F.concat(F.lower("c_mktsegment"), F.col("c_custkey").cast("string"), F.lit("@example.org")).alias("email"),
    )
    accounts = orders.select(
        F.col("o_orderkey").alias("account_id"),
        F.lpad(F.col("o_orderkey").cast("string"), 20, "0").alias("account_number"),
        F.col("o_orderstatus").alias("account_type"),
        F.when(priority == "1", "USD").when(priority == "2", "EUR").otherwise("RUB").alias("currency"),
        ordered.alias("open_date"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("balance"),
        F.col("o_custkey").cast("int").alias("client_id"),
    )
    transactions = lines.select(
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("transaction_id"),
        shipped.alias("transaction_date"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("amount"),
        F.when(F.col("l_returnflag") == "A", "credit entry").otherwise("DEBIT entry").alias("transaction_type"),
        F.col("l_orderkey").alias("account_id"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("description"),
    )
    credits = orders.select(
        F.col("o_orderkey").alias("credit_id"),
        F.col("o_custkey").cast("int").alias("client_id"),
        F.floor("o_totalprice").alias("amount"),
        ((F.col("o_orderkey") % 161 + 90) / 10).alias("interest_rate"),
        F.element_at(
            F.array(*[F.lit(t) for t in (6, 12, 24, 36, 60, 120, 360)]), (F.col("o_orderkey") % 7 + 1).cast("int")
        ).alias("term_months"),
        ordered.alias("issue_date"),
    )
    return Bank(clients, accounts, transactions, bank.annuities(credits))
