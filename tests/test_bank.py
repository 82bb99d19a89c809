from datetime import date
from decimal import Decimal

from registra import schemas
from registra.plans import bank, triples


def tables_of(spark):
    person = ("Громов", "Глеб", "Глебович", date(2000, 2, 29), "1010", "100100", "x", "a\nb", "+7", "m@example.org")
    clients = spark.createDataFrame([(1, *person), (2, *person)], schemas.CLIENTS)
    accounts = spark.createDataFrame(
        [(10, "n10", "дебетовый", "USD", date(2020, 1, 1), Decimal("5.50"), 1),
         (11, "n11", "кредитный", "RUB", date(2020, 1, 1), Decimal("0.00"), 1),
         (12, "n12", "кредитный", "RUB", date(2020, 1, 1), Decimal("0.00"), 99)],
        schemas.ACCOUNTS,
    )
    transactions = spark.createDataFrame(
        [(i, date(2021, 1, i), Decimal(i), "списание", 10, "d") for i in (5, 2, 9, 4)] + [(20, date(2021, 1, 1), Decimal(1), "x", 77, "d")],
        schemas.TRANSACTIONS,
    )
    credits = spark.createDataFrame([(1, 1, 1000, 12.0, 12, date(2021, 1, 1), 88.85)], schemas.CREDITS)
    return clients, accounts, transactions, credits


def test_report(spark):
    lines = [(r.client_id, r.line) for r in bank.first_clients_report(*tables_of(spark)).collect()]
    assert [line for client, line in lines if client == 1] == [
        "Клиент: Громов Глеб Глебович",
        "  Счет: n10 (дебетовый) | Остаток: 5.50 USD",
        "    Транзакции (показаны первые 3):",
        "      - 2021-01-02 | Списание: 2.00 USD",
        "      - 2021-01-04 | Списание: 4.00 USD",
        "      - 2021-01-05 | Списание: 5.00 USD",
        "  Счет: n11 (кредитный) | Остаток: 0.00 RUB",
        "    Транзакции: нет",
        "  Кредиты:",
        "    - Сумма: 1000.00 руб. | Ставка: 12.0% | Платеж: 88.85 руб./мес.",
    ]
    assert [line for client, line in lines if client == 2] == ["Клиент: Громов Глеб Глебович", "  Счета: нет", "  Кредиты: нет"]


def test_class_graph_of_edges(spark):
    parts = tables_of(spark)
    rows = triples.class_graph_rows(*triples.schema_of_edges(triples.bank_edges(*parts), triples.bank_classes(*parts))).collect()
    short = lambda v: v and v.removeprefix(triples.BANK_IRI)
    assert {tuple(map(short, r)) for r in rows} == {
        ("Клиент", "Счет", "владеет_счетом"),
        ("Клиент", "Кредит", "имеет_кредит"),
        ("Транзакция", "Счет", "относится_к_счету"),
        ("Счет", None, None),
        ("Кредит", None, None),
    }
    observed = triples.observed_schema(triples.bank_triples(*parts, literals=False))
    assert sorted(map(str, triples.class_graph_rows(*observed).collect())) == sorted(map(str, rows))


def test_edges_skip_missing_parents(spark):
    edges = triples.bank_edges(*tables_of(spark))
    assert sorted((r.predicate, r.source_id, r.target_id) for r in edges.collect()) == sorted(
        [("владеет_счетом", 1, 10), ("владеет_счетом", 1, 11), ("имеет_кредит", 1, 1)]
        + [("относится_к_счету", i, 10) for i in (2, 4, 5, 9)]
    )


def test_client_attributes(spark):
    row = bank.client_attributes(tables_of(spark)[0]).first()
    assert (row.full_name, row.passport, row.address_line) == ("Громов Глеб Глебович", "1010 100100", "a, b")
    assert row.of_age == "2018-02-24"


def test_triples(spark):
    facts = triples.bank_triples(*tables_of(spark))
    # 4 classes, 6 + 5 + 4 + 5 data properties, 7 links
    assert facts.count() == (2 + 3 + 5 + 1) + 2 * 6 + 3 * 5 + 5 * 4 + 5 + 7
    assert {r[0] for r in facts.filter("object = '5.50'").select("datatype").collect()} == {triples.XSD + "decimal"}
