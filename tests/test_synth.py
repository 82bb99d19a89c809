from datetime import date

import pytest
from pyspark.sql import functions as F

from registra.plans import synth

TODAY = date(2024, 1, 1)


@pytest.fixture(scope="module")
def bank(spark):
    clients = synth.bank_clients(synth.ids_up_to(spark, 1003), TODAY).cache()
    accounts = synth.bank_accounts(clients, TODAY).cache()
    return clients, accounts, synth.bank_transactions(accounts, TODAY).cache(), synth.bank_credits(clients, TODAY).cache()


def bad(df, condition):
    return df.filter(f"NOT coalesce({condition}, false)").count()


def test_clients(bank):
    clients, *_ = bank
    assert clients.count() == 1003
    assert bad(clients, "months_between(date'2024-01-01', birth_date) >= 18*12 AND months_between(date'2024-01-01', birth_date) < 81*12") == 0
    assert bad(clients, "passport_series rlike '^[1-9][0-9][1-9][0-9]$' AND passport_number rlike '^[1-9][0-9]{5}$'") == 0
    assert bad(clients, "instr(address, chr(10)) = 0") == 0


def test_accounts(bank):
    clients, accounts, *_ = bank
    per_client = accounts.groupBy("client_id").count()
    assert per_client.count() == 1003 and bad(per_client, "count BETWEEN 1 AND 3") == 0
    n = accounts.count()
    assert accounts.agg(F.min("account_id"), F.max("account_id"), F.countDistinct("account_id")).first() == (1, n, n)
    opened = accounts.join(clients, "client_id")
    assert bad(opened, "open_date BETWEEN date_add(birth_date, 6570) AND date'2024-01-01' AND balance BETWEEN 0 AND 1500000") == 0
    assert 0.8 < accounts.filter("currency = 'RUB'").count() / n < 0.9


def test_transactions(bank):
    _, accounts, transactions, _ = bank
    per_account = transactions.groupBy("account_id").count()
    assert per_account.count() == accounts.count() and bad(per_account, "count BETWEEN 10 AND 50") == 0
    n = transactions.count()
    assert transactions.agg(F.max("transaction_id"), F.countDistinct("transaction_id")).first() == (n, n)
    dated = transactions.join(accounts, "account_id")
    assert bad(dated, "transaction_date BETWEEN open_date AND date'2024-01-01' AND amount BETWEEN 100 AND 150000") == 0
    for kind, texts in synth.DESCRIPTIONS.items():
        got = {r[0] for r in transactions.filter(F.col("transaction_type") == kind).select("description").distinct().collect()}
        assert got == set(texts)


def test_credits(bank):
    *_, credits = bank
    assert credits.count() == 200
    assert credits.select("client_id").distinct().count() == 200
    assert credits.agg(F.min("credit_id"), F.max("credit_id")).first() == (1, 200)
    assert bad(credits, "amount BETWEEN 50000 AND 5000000 AND interest_rate BETWEEN 9 AND 25 AND monthly_payment > 0") == 0
    assert {r[0] for r in credits.select("term_months").distinct().collect()} == set(synth.TERMS)


def test_staff(spark):
    departments = synth.hr_departments(synth.ids_up_to(spark, 30))
    positions = synth.hr_positions(synth.ids_up_to(spark, 20))
    assert departments.select("name").distinct().count() == 30
    assert bad(positions, "min_salary BETWEEN 30000 AND 60000 AND max_salary - min_salary BETWEEN 20000 AND 80000") == 0
    staff = synth.hr_employees(synth.ids_up_to(spark, 500), synth.ids_up_to(spark, 30), synth.ids_up_to(spark, 20), TODAY)
    assert bad(staff, "hire_date BETWEEN date_add(birth_date, 6570) AND date'2024-01-01' AND salary BETWEEN 40000 AND 150000") == 0
    assert bad(staff, "department_id BETWEEN 1 AND 30 AND position_id BETWEEN 1 AND 20") == 0
    history = synth.salary_history(staff, TODAY)
    n = history.count()
    assert history.agg(F.max("history_id"), F.countDistinct("history_id")).first() == (n, n)
    steps = history.groupBy("employee_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("history_id", "change_date", "new_salary"))), lambda s: s["change_date"]).alias("days"),
        F.transform(F.array_sort(F.collect_list(F.struct("history_id", "change_date", "new_salary"))), lambda s: s["new_salary"]).alias("pay"),
    ).join(staff, "employee_id")
    assert bad(steps, "days = array_sort(days) AND pay = array_sort(pay) AND days[0] = hire_date") == 0
    assert bad(steps, "element_at(pay, -1) = salary AND size(pay) BETWEEN 1 AND 5") == 0


def test_same_rows_for_any_partitioning(spark, bank):
    _, accounts, transactions, credits = bank
    clients = synth.bank_clients(synth.ids_up_to(spark, 1003).repartition(13), TODAY)
    again = synth.bank_accounts(clients, TODAY)
    assert again.exceptAll(accounts).isEmpty() and again.count() == accounts.count()
    assert synth.bank_transactions(again.repartition(5), TODAY).exceptAll(transactions).isEmpty()
    assert synth.bank_credits(clients, TODAY).exceptAll(credits).isEmpty()
    other = synth.bank_accounts(synth.bank_clients(synth.ids_up_to(spark, 50), TODAY, seed=1), TODAY, seed=1)
    assert not other.exceptAll(accounts).isEmpty()


def test_staff_belongs_to_given_ids(spark):
    given = [7, 19, 400], [3, 1000]
    departments, positions = (spark.createDataFrame([(i,) for i in ids], "id bigint") for ids in given)
    staff = synth.hr_employees(synth.ids_up_to(spark, 300), departments, positions, TODAY)
    found = staff.agg(F.array_sort(F.collect_set("department_id")), F.array_sort(F.collect_set("position_id"))).first()
    assert (found[0], found[1]) == given


def test_department_ids_are_joined_and_keep_their_width(spark):
    given = [2**31 + 5, 2**40, 7], [3 * 2**31, 12]
    departments, positions = (spark.createDataFrame([(i,) for i in ids], "id bigint") for ids in given)
    staff = synth.hr_employees(synth.ids_up_to(spark, 300), departments, positions, TODAY)
    found = staff.agg(F.array_sort(F.collect_set("department_id")), F.array_sort(F.collect_set("position_id"))).first()
    assert (found[0], found[1]) == tuple(sorted(ids) for ids in given)
    assert staff.count() == 300
    assert "collect_list" not in staff._jdf.queryExecution().toString()


def test_few_bytes_of_ids_are_dealt_over_all_tasks(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    clients = synth.bank_clients(spark.range(1, 200).coalesce(1), TODAY)
    assert clients.rdd.getNumPartitions() == parts > 1
    assert synth.bank_accounts(clients, TODAY).rdd.getNumPartitions() == parts
