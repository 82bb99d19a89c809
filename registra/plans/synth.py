"""Synthetic staff and bank tables.

Each generator takes a table of ids (any DataFrame; `ids_up_to` makes one) and draws every
value from (seed, what, id). Names and places are small invented word lists. Days end at
`as_of`, which the caller gives, so a table can be made again on a later day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.functions import labels, numbers
from registra.functions.draws import between, cycle_unique, day_between, draw, pick, pick_weighted
from registra.operators import ranking
from registra.sources.shared import spread

SEED = 42
DAYS_TO_18 = 18 * 365

# Invented words.
JOBS = ["Аналитик", "Бухгалтер", "Инженер", "Логист", "Маркетолог", "Программист", "Тестировщик", "Юрист"]
CITIES = ["Вершинск", "Заречный", "Каменный Брод", "Лесогорск", "Новоозёрск", "Степной"]
REGIONS = ["Заречному краю", "Лесной области", "Озёрной области", "Степному краю"]
STREETS = ["Береговая", "Лесная", "Новая", "Полевая", "Садовая", "Школьная"]
LAST_NAMES = ["Берёзкин", "Ветров", "Громов", "Дубов", "Ельников", "Журавлёв", "Звягин", "Ключев"]
FIRST_NAMES = ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Илья", "Павел"]
PATRONYMICS = ["Антонович", "Борисович", "Викторович", "Глебович", "Денисович", "Егорович"]

# The lists the generated tables draw from.
STATUSES, STATUS_CHANCES = ["active", "terminated"], [90, 10]
GENDERS = ["М", "Ж"]
ACCOUNT_TYPES = ["дебетовый", "кредитный"]
CURRENCIES, CURRENCY_CHANCES = ["RUB", "USD", "EUR"], [85, 10, 5]
CREDITED, DEBITED = "пополнение", "списание"
DESCRIPTIONS = {
    CREDITED: ["Зарплата", "Внесение наличных через банкомат", "Входящий перевод", "Кэшбэк", "Возврат средств"],
    DEBITED: [
        "Оплата в супермаркете",
        "Перевод клиенту",
        "Оплата ЖКУ",
        "Снятие наличных",
        "Оплата подписки",
        "Покупка в интернете",
    ],
}
TERMS = [6, 12, 24, 36, 60, 120, 360]
SALARY_CHANGES, SALARY_CHANGE_CHANCES = [0, 1, 2, 3, 4], [20, 30, 30, 10, 10]


def ids_up_to(spark: SparkSession, n: int) -> DataFrame:
    """ids 1..n."""
    return spark.range(1, n + 1)


def _born(drawn: Column, as_of: date, youngest: int, oldest: int) -> Column:
    """A birth day that gives an age between youngest and oldest on the day as_of."""
    today = F.lit(as_of)
    first = F.date_add(F.add_months(today, -12 * (oldest + 1)), 1)
    return day_between(drawn, first, F.add_months(today, -12 * youngest))


def _contact(seed: int, what: str, key: Column) -> list[Column]:
    """address, phone and email."""
    address = F.concat(
        F.lit("г. "), pick(draw(seed, f"{what}.city", key), CITIES), F.lit("\nул. "),
        pick(draw(seed, f"{what}.street", key), STREETS), F.lit(", д. "),
        between(draw(seed, f"{what}.house", key), 1, 150).cast("string"),
    )
    phone = F.concat(F.lit("+7 9"), F.lpad(between(draw(seed, f"{what}.phone", key), 0, 999_999_999).cast("string"), 9, "0"))
    email = F.concat(F.lit(what), key.cast("string"), F.lit("@example.org"))
    return [labels.one_line(address).alias("address"), phone.alias("phone"), email.alias("email")]


def _person(seed: int, what: str, key: Column) -> list[Column]:
    return [
        pick(draw(seed, f"{what}.last", key), LAST_NAMES).alias("last_name"),
        pick(draw(seed, f"{what}.first", key), FIRST_NAMES).alias("first_name"),
        pick(draw(seed, f"{what}.patronymic", key), PATRONYMICS).alias("patronymic"),
    ]


def hr_departments(ids: DataFrame, seed: int = SEED) -> DataFrame:
    key = F.col("id")
    return ids.select(
        key.cast("int").alias("department_id"),
        F.concat(cycle_unique(key, JOBS), F.lit(" отдел")).alias("name"),
        pick(draw(seed, "department.city", key), CITIES).alias("location"),
    )


def hr_positions(ids: DataFrame, seed: int = SEED) -> DataFrame:
    key = F.col("id")
    lowest = between(draw(seed, "position.min", key), 30_000, 60_000)
    return ids.select(
        key.cast("int").alias("position_id"),
        cycle_unique(key, JOBS).alias("name"),
        lowest.cast("int").alias("min_salary"),
        (lowest + between(draw(seed, "position.span", key), 20_000, 80_000)).cast("int").alias("max_salary"),
    )


def _with_one_of(rows: DataFrame, ids: DataFrame, drawn: Column, out: str) -> DataFrame:
    """Adds one of the ids (id), by its place in ascending order; NULL where there are none.

    Ids are numbered as a table and met by an equi-join on the place, which Spark splits where few ids have
    very many rows; only their count goes to all tasks.
    """
    key = F.col("id").cast("bigint")
    numbered = ranking.global_rank(ids.select(key.alias(out)), [F.asc(out)], "_rank").select(out, (F.col("_rank") + 1).alias("_place"))
    many = F.greatest(ids.agg(F.count(F.lit(1))).scalar(), F.lit(1).cast("bigint"))
    return rows.withColumn("_place", between(drawn, F.lit(1), many)).join(numbered, "_place", "left").drop("_place")


def hr_employees(ids: DataFrame, departments: DataFrame, positions: DataFrame, as_of: date, seed: int = SEED) -> DataFrame:
    """Staff aged 18 to 70, hired between coming of age and as_of; departments and positions
    are among the given ones (id), whatever their ids."""
    key = F.col("id")
    born = spread(ids, "id").select(
        key,
        *_person(seed, "employee", key),
        _born(draw(seed, "employee.birth", key), as_of, 18, 70).alias("birth_date"),
        *_contact(seed, "employee", key),
    )
    placed = _with_one_of(born, departments, draw(seed, "employee.department", key), "department_id")
    placed = _with_one_of(placed, positions, draw(seed, "employee.position", key), "position_id")
    return spread(placed, "id").select(
        key.cast("int").alias("employee_id"),
        "last_name",
        "first_name",
        "patronymic",
        "birth_date",
        pick(draw(seed, "employee.gender", key), GENDERS).alias("gender"),
        "address",
        "phone",
        "email",
        day_between(draw(seed, "employee.hire", key), F.date_add("birth_date", DAYS_TO_18), F.lit(as_of)).alias("hire_date"),
        pick_weighted(draw(seed, "employee.status", key), STATUSES, STATUS_CHANCES).alias("status"),
        "department_id",
        "position_id",
        between(draw(seed, "employee.salary", key), 40_000, 150_000).cast("int").alias("salary"),
    )


def salary_history(employees: DataFrame, as_of: date, seed: int = SEED) -> DataFrame:
    """Per employee one row for the hire and 0 to 4 changes; days and salaries ascend, the
    last salary is the present one. history_id runs on without gaps in employee order."""
    key = F.col("employee_id")
    counted = employees.select("employee_id", "hire_date", "salary").withColumn(
        "changes", pick_weighted(draw(seed, "history.changes", key), SALARY_CHANGES, SALARY_CHANGE_CHANCES)
    )
    numbered = spread(ranking.running_offset(counted, "employee_id", F.col("changes") + 1, "offset"), "employee_id")

    def drawn(what: str, value) -> Column:
        steps = F.filter(F.sequence(F.lit(1), F.greatest("changes", F.lit(1))), lambda i: i <= F.col("changes"))
        return F.array_sort(F.transform(steps, lambda i: value(draw(seed, f"history.{what}", key, i))))

    days = drawn("day", lambda d: day_between(d, F.col("hire_date"), F.lit(as_of)))
    salaries = drawn("salary", lambda d: between(d, 30_000, F.col("salary")).cast("int"))
    steps = F.arrays_zip(
        F.concat(F.array("hire_date"), days).alias("change_date"),
        F.concat(salaries, F.array("salary")).alias("new_salary"),
    )
    return numbered.select("employee_id", "offset", F.posexplode(steps).alias("place", "step")).select(
        (F.col("offset") + F.col("place") + 1).alias("history_id"),
        "employee_id",
        F.col("step.change_date").alias("change_date"),
        F.col("step.new_salary").alias("new_salary"),
    )


def bank_clients(ids: DataFrame, as_of: date, seed: int = SEED) -> DataFrame:
    """Clients aged 18 to 80."""
    key = F.col("id")

    def two_digits(what: str) -> Column:
        return between(draw(seed, f"client.{what}", key), 10, 99).cast("string")

    return spread(ids, "id").select(
        key.cast("int").alias("client_id"),
        *_person(seed, "client", key),
        _born(draw(seed, "client.birth", key), as_of, 18, 80).alias("birth_date"),
        F.concat(two_digits("series1"), two_digits("series2")).alias("passport_series"),
        between(draw(seed, "client.passport", key), 100_000, 999_999).cast("string").alias("passport_number"),
        F.concat(F.lit("ГУ МВД России по "), pick(draw(seed, "client.region", key), REGIONS)).alias("passport_issued_by"),
        *_contact(seed, "client", key),
    )


def _cents(drawn: Column, low: int, high: int) -> Column:
    return (between(drawn, low * 100, high * 100).cast("decimal(20,0)") / 100).cast("decimal(14,2)")


def bank_accounts(clients: DataFrame, as_of: date, seed: int = SEED) -> DataFrame:
    """1 to 3 accounts per client, opened at 18 or later; account_id runs on without gaps."""
    owner = F.col("client_id")
    counted = clients.select("client_id", "birth_date").withColumn("n", between(draw(seed, "account.n", owner), 1, 3))
    numbered = spread(ranking.running_offset(counted, "client_id", F.col("n"), "offset"), "client_id")
    key = F.col("account_id")
    rows = numbered.select(
        "client_id", "birth_date", F.explode(F.sequence(F.col("offset") + 1, F.col("offset") + F.col("n"))).alias("account_id")
    )
    return rows.select(
        "account_id",
        F.lpad(draw(seed, "account.number", key).cast("string"), 20, "0").alias("account_number"),
        pick(draw(seed, "account.type", key), ACCOUNT_TYPES).alias("account_type"),
        pick_weighted(draw(seed, "account.currency", key), CURRENCIES, CURRENCY_CHANCES).alias("currency"),
        day_between(draw(seed, "account.open", key), F.date_add("birth_date", DAYS_TO_18), F.lit(as_of)).alias("open_date"),
        _cents(draw(seed, "account.balance", key), 0, 1_500_000).alias("balance"),
        "client_id",
    )


def bank_transactions(accounts: DataFrame, as_of: date, seed: int = SEED) -> DataFrame:
    """10 to 50 transactions per account, from its first day on; transaction_id has no gaps."""
    owner = F.col("account_id")
    counted = accounts.select("account_id", "open_date").withColumn("n", between(draw(seed, "transaction.n", owner), 10, 50))
    numbered = spread(ranking.running_offset(counted, "account_id", F.col("n"), "offset"), "account_id")
    key = F.col("transaction_id")
    rows = numbered.select(
        "account_id", "open_date", F.explode(F.sequence(F.col("offset") + 1, F.col("offset") + F.col("n"))).alias("transaction_id")
    ).withColumn("transaction_type", pick_weighted(draw(seed, "transaction.type", key), [CREDITED, DEBITED], [30, 70]))
    wording = draw(seed, "transaction.description", key)
    return rows.select(
        "transaction_id",
        day_between(draw(seed, "transaction.day", key), F.col("open_date"), F.lit(as_of)).alias("transaction_date"),
        _cents(draw(seed, "transaction.amount", key), 100, 150_000).alias("amount"),
        "transaction_type",
        "account_id",
        F.when(F.col("transaction_type") == CREDITED, pick(wording, DESCRIPTIONS[CREDITED]))
        .otherwise(pick(wording, DESCRIPTIONS[DEBITED]))
        .alias("description"),
    )


def bank_credits(clients: DataFrame, as_of: date, seed: int = SEED) -> DataFrame:
    """Exactly one client in five (rounded down) gets one credit.

    Clients are ordered by a digest and the first fifth is taken by global rank.
    """
    owner = F.col("client_id")
    drawn = clients.select("client_id", "birth_date").withColumn("_order", draw(seed, "credit.owner", owner))
    ranked = ranking.global_rank(drawn, [F.asc("_order"), F.asc("client_id")], "_rank", "_total")
    key = F.col("client_id")
    rows = ranked.filter((F.col("_rank") + 1) * 5 <= F.col("_total")).select(
        (F.col("_rank") + 1).alias("credit_id"),
        "client_id",
        between(draw(seed, "credit.amount", key), 50_000, 5_000_000).alias("amount"),
        (between(draw(seed, "credit.rate", key), 90, 250) / 10).alias("interest_rate"),
        pick(draw(seed, "credit.term", key), TERMS).alias("term_months"),
        day_between(draw(seed, "credit.issue", key), F.date_add("birth_date", DAYS_TO_18), F.lit(as_of)).alias("issue_date"),
    )
    payment = numbers.annuity_payment(F.col("amount"), F.col("interest_rate"), F.col("term_months"))
    return rows.withColumn("monthly_payment", payment)
