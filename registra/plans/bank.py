"""Client report, loan payments and table sizes of the bank data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.functions import labels, numbers
from registra.operators import ranking
from registra.sources.shared import written
from registra.sources.tables import row_counts


PRINT_ORDER = ["client_id", "block", "account_id", "step", "item_id"]


def annuities(credits: DataFrame) -> DataFrame:
    """Credits with the monthly payment worked out from amount, rate and term."""
    payment = numbers.annuity_payment(F.col("amount"), F.col("interest_rate"), F.col("term_months"))
    return credits.withColumn("monthly_payment", payment)


def summary(clients: DataFrame, accounts: DataFrame, transactions: DataFrame, credits: DataFrame) -> DataFrame:
    return row_counts({"clients": clients, "accounts": accounts, "transactions": transactions, "credits": credits})


def full_name() -> Column:
    return F.concat_ws(" ", "last_name", "first_name", "patronymic")


def client_attributes(clients: DataFrame) -> DataFrame:
    """Texts put together from the parts of a client, and the first day of legal age
    (18 times 365 days after birth, not 18 calendar years)."""
    return clients.select(
        "client_id",
        full_name().alias("full_name"),
        F.concat_ws(" ", "passport_series", "passport_number").alias("passport"),
        labels.one_line(F.col("address")).alias("address_line"),
        F.date_format(F.date_add("birth_date", 18 * 365), "yyyy-MM-dd").alias("of_age"),
    )


def first_transactions(transactions: DataFrame, n: int = 3) -> DataFrame:
    """The first n transactions of every account, in id order, with their place."""
    return ranking.first_n_per_key(transactions, ["account_id"], [F.asc("transaction_id")], n)


def first_clients(clients: DataFrame, n: int) -> DataFrame:
    return clients.orderBy("client_id").limit(n)


def report_rows(
    clients: DataFrame, accounts: DataFrame, transactions: DataFrame, credits: DataFrame
) -> DataFrame:
    """The client report as rows (client_id, block, account_id, step, item_id, section, place, and the values shown).

    Sections: client, account, transactions (a heading), transaction (first 3 per account, in the currency of the
    account), credits (a heading), credit; no_accounts, no_transactions and no_credits say that there are none.
    In the order of client_id, block, account_id, step and item_id the rows stand as on paper.
    A client may own any number of accounts, and an account any number of transactions, so
    nothing is gathered per client, transactions are cut to three per account before any
    join, and whoever has none is found by distinct ids.
    """
    chosen = clients.select("client_id", full_name().alias("name"))
    ids = chosen.select("client_id")
    owned = accounts.join(ids, "client_id", "left_semi")
    lent = credits.join(ids, "client_id", "left_semi")
    with_transactions = owned.select("account_id", "client_id", "currency").join(
        first_transactions(transactions), "account_id", "left"
    )

    def without(others: DataFrame) -> DataFrame:
        return ids.join(others.select("client_id").distinct(), "client_id", "left_anti")

    def rows(df: DataFrame, section: Column | str, **values: Column | str) -> DataFrame:
        shapes = {"account_id": "bigint", "item_id": "bigint", "place": "int", "title": "string", "kind": "string",
                  "day": "string", "amount": "double", "currency": "string", "rate": "double", "payment": "double"}
        given = {c: F.col(v) if isinstance(v, str) else v for c, v in values.items()}
        cells = [given.get(c, F.lit(None)).cast(t).alias(c) for c, t in shapes.items()]
        named = (F.lit(section) if isinstance(section, str) else section).alias("section")
        return df.select("client_id", named, *cells).withColumns(
            {
                "block": F.when(F.col("section") == "client", 0).when(F.col("section").isin("credits", "credit", "no_credits"), 2).otherwise(1),
                "step": F.when(F.col("section").isin("account", "credits"), 0).when(F.col("section") == "transactions", 1).otherwise(2),
            }
        )

    # The heading comes with the first transaction of an account, from the same scan.
    headed = F.array(F.lit("transactions"), F.lit("transaction"))
    sections = (
        F.when(F.col("place").isNull(), F.array(F.lit("no_transactions")))
        .when(F.col("place") == 1, headed)
        .otherwise(F.array(F.lit("transaction")))
    )
    listed = with_transactions.withColumn("section", F.explode(sections))
    shown = lambda value: F.when(F.col("section") == "transaction", value)
    parts = [
        rows(chosen, "client", title="name"),
        rows(owned, "account", account_id="account_id", title="account_number", kind="account_type", amount="balance",
             currency="currency"),
        rows(without(accounts), "no_accounts"),
        rows(listed, F.col("section"), account_id="account_id", item_id=shown(F.col("transaction_id")), place=shown(F.col("place")),
             kind=shown(labels.capitalize(F.col("transaction_type"))), day=shown(F.date_format("transaction_date", "yyyy-MM-dd")),
             amount=shown(F.col("amount")), currency=shown(F.col("currency"))),
        rows(lent.select("client_id").distinct(), "credits"),
        rows(lent, "credit", item_id="credit_id", amount="amount", rate="interest_rate", payment="monthly_payment"),
        rows(without(credits), "no_credits"),
    ]
    return reduce(DataFrame.unionByName, parts)


def first_clients_report(
    clients: DataFrame, accounts: DataFrame, transactions: DataFrame, credits: DataFrame, n: int = 5
) -> DataFrame:
    """The report lines of the first n clients, in the order of a print-out."""
    chosen = written(first_clients(clients, n), "clients")
    owned = written(accounts.join(chosen.select("client_id"), "client_id", "left_semi"), "accounts")
    # Few accounts are sent to every task; Spark decides by their size.
    booked = transactions.join(owned.select("account_id"), "account_id", "left_semi")
    return report_lines(report_rows(chosen, owned, booked, credits)).orderBy(*PRINT_ORDER)


def report_lines(report: DataFrame) -> DataFrame:
    """The report as text: its order (client_id, block, account_id, step, item_id) and the line."""
    money = F.format_string("%.2f", "amount")
    # The wording of the report.
    line = (
        F.when(F.col("section") == "client", F.concat(F.lit("Клиент: "), "title"))
        .when(F.col("section") == "no_accounts", F.lit("  Счета: нет"))
        .when(
            F.col("section") == "account",
            F.concat(F.lit("  Счет: "), "title", F.lit(" ("), "kind", F.lit(") | Остаток: "), money, F.lit(" "), "currency"),
        )
        .when(
            F.col("section") == "transaction",
            F.concat(F.lit("      - "), "day", F.lit(" | "), "kind", F.lit(": "), money, F.lit(" "), "currency"),
        )
        .when(F.col("section") == "transactions", F.lit("    Транзакции (показаны первые 3):"))
        .when(F.col("section") == "no_transactions", F.lit("    Транзакции: нет"))
        .when(F.col("section") == "credits", F.lit("  Кредиты:"))
        .when(
            F.col("section") == "credit",
            F.concat(
                F.lit("    - Сумма: "), money, F.lit(" руб. | Ставка: "), F.format_string("%.1f", "rate"),
                F.lit("% | Платеж: "), F.format_string("%.2f", "payment"), F.lit(" руб./мес."),
            ),
        )
        .otherwise(F.lit("  Кредиты: нет"))
    )
    return report.select(*PRINT_ORDER, line.alias("line"))
