"""Tables as subject-predicate-object rows, and the class graph of such rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.plans import skills as S
from registra.sources.shared import written

# Where names live unless the caller says otherwise.
SKILLS_IRI = "http://example.org/skills#"
BANK_IRI = "http://example.org/bank#"

# Names of the RDF standards, of classes, individuals and properties.
TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
XSD = "http://www.w3.org/2001/XMLSchema#"

SKILLS_OBJECT_PROPERTIES = [
    "требует_знание",
    "обладает_знанием",
    "обладает_компетенцией",
    "может_занимать_должность",
    "требует_компетенцию",
]
SKILLS_DATA_PROPERTIES = ["название", "имя_сотрудника"]
BANK_OBJECT_PROPERTIES = ["владеет_счетом", "имеет_кредит", "относится_к_счету"]

IRI_KIND, LITERAL = "iri", "literal"


def _fact(base: str, predicate: str, value: Column, kind: str, datatype: str | None) -> Column:
    name = predicate if predicate == TYPE else base + predicate
    return F.struct(
        F.lit(name).alias("predicate"),
        value.cast("string").alias("object"),
        F.lit(kind).alias("object_kind"),
        F.lit(XSD + datatype if datatype else None).cast("string").alias("datatype"),
    )


def _facts(rows: DataFrame, subject: Column, facts: list[Column]) -> DataFrame:
    """All facts of a row from one scan; a missing value gives no triple."""
    return (
        rows.select(subject.alias("subject"), F.explode(F.array(*facts)).alias("fact"))
        .select("subject", "fact.*")
        .filter("object IS NOT NULL")
    )


def _entity(rows: DataFrame, base: str, cls: str, name: Column, values: list[tuple[str, Column, str]]) -> DataFrame:
    facts = [_fact(base, TYPE, F.lit(base + cls), IRI_KIND, None)]
    facts += [_fact(base, prop, value, LITERAL, datatype) for prop, value, datatype in values]
    return _facts(rows, F.concat(F.lit(base), name), facts)


def _edge(rows: DataFrame, base: str, predicate: str, subject: Column, target: Column) -> DataFrame:
    fact = _fact(base, predicate, F.concat(F.lit(base), target), IRI_KIND, None)
    return _facts(rows, F.concat(F.lit(base), subject), [fact])


def skill_triples(base: S.SkillBase, iri: str = SKILLS_IRI) -> DataFrame:
    """Individuals, names, requirements, skills and the inferred grants."""
    found = S.infer(base)
    who, knows = S.individual("employee"), S.individual("knowledge")
    masters, fills = S.individual("competency"), S.individual("position")

    def named(rows: DataFrame, cls: str, name: Column, prop: str, title: str) -> DataFrame:
        return _entity(rows, iri, cls, name, [(prop, F.col(title), "string")])

    parts = [
        named(base.knowledge, "Знание", knows, "название", "knowledge_name"),
        named(base.competencies, "Компетенция", masters, "название", "competency_name"),
        named(base.positions, "Должность", fills, "название", "position_name"),
        named(found.everybody, "Специалист", who, "имя_сотрудника", "full_name"),
        _edge(base.competency_knowledge.distinct(), iri, "требует_знание", masters, knows),
        _edge(base.position_competency.distinct(), iri, "требует_компетенцию", fills, masters),
        _edge(found.held, iri, "обладает_знанием", who, knows),
        _edge(found.competencies, iri, "обладает_компетенцией", who, masters),
        _edge(found.positions, iri, "может_занимать_должность", who, fills),
    ]
    return reduce(DataFrame.unionByName, parts)


def bank_edges(clients: DataFrame, accounts: DataFrame, transactions: DataFrame, credits: DataFrame) -> DataFrame:
    """Links whose both ends exist: source_kind, source_id, predicate, target_kind, target_id."""

    def edge(links: DataFrame, predicate: str, source: tuple[str, str], target: tuple[str, str]) -> DataFrame:
        return links.select(
            F.lit(source[0]).alias("source_kind"),
            F.col(source[1]).cast("bigint").alias("source_id"),
            F.lit(predicate).alias("predicate"),
            F.lit(target[0]).alias("target_kind"),
            F.col(target[1]).cast("bigint").alias("target_id"),
        )

    owned = accounts.select("client_id", "account_id").join(clients.select("client_id"), "client_id", "left_semi")
    lent = credits.select("client_id", "credit_id").join(clients.select("client_id"), "client_id", "left_semi")
    booked = transactions.select("transaction_id", "account_id").join(
        accounts.select("account_id"), "account_id", "left_semi"
    )
    return (
        edge(owned, "владеет_счетом", ("Клиент", "client_id"), ("Счет", "account_id"))
        .unionByName(edge(lent, "имеет_кредит", ("Клиент", "client_id"), ("Кредит", "credit_id")))
        .unionByName(edge(booked, "относится_к_счету", ("Транзакция", "transaction_id"), ("Счет", "account_id")))
    )


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def bank_triples(
    clients: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    credits: DataFrame,
    iri: str = BANK_IRI,
    literals: bool = True,
) -> DataFrame:
    """Four classes with their data properties, and the three kinds of links.

    Without `literals` only types and links, which is all a class graph needs.
    """
    full_name = F.concat_ws(" ", "last_name", "first_name", "patronymic")
    passport = F.concat_ws(" ", "passport_series", "passport_number")

    def entity(rows: DataFrame, cls: str, key: str, values: list[tuple[str, Column, str]]) -> DataFrame:
        name = F.concat(F.lit(f"{cls}_"), F.col(key).cast("string"))
        return _entity(rows, iri, cls, name, values if literals else [])

    edges = bank_edges(clients, accounts, transactions, credits)
    links = edges.select(
        F.concat(F.lit(iri), "source_kind", F.lit("_"), F.col("source_id").cast("string")).alias("subject"),
        F.concat(F.lit(iri), "predicate").alias("predicate"),
        F.concat(F.lit(iri), "target_kind", F.lit("_"), F.col("target_id").cast("string")).alias("object"),
        F.lit(IRI_KIND).alias("object_kind"),
        F.lit(None).cast("string").alias("datatype"),
    )
    parts = [
        entity(clients, "Клиент", "client_id", [
            ("фио", full_name, "string"),
            ("дата_рождения", _day("birth_date"), "string"),
            ("паспортные_данные", passport, "string"),
            ("адрес", F.col("address"), "string"),
            ("телефон", F.col("phone"), "string"),
            ("email", F.col("email"), "string"),
        ]),
        entity(accounts, "Счет", "account_id", [
            ("номер_счета", F.col("account_number"), "string"),
            ("тип_счета", F.col("account_type"), "string"),
            ("валюта", F.col("currency"), "string"),
            ("дата_открытия", _day("open_date"), "string"),
            ("остаток", F.col("balance"), "decimal"),
        ]),
        entity(transactions, "Транзакция", "transaction_id", [
            ("дата_транзакции", _day("transaction_date"), "string"),
            ("сумма_транзакции", F.col("amount"), "decimal"),
            ("тип_транзакции", F.col("transaction_type"), "string"),
            ("описание", F.col("description"), "string"),
        ]),
        entity(credits, "Кредит", "credit_id", [
            ("сумма_кредита", F.col("amount").cast("decimal(14,2)"), "decimal"),
            ("процентная_ставка", F.col("interest_rate").cast("decimal(5,1)"), "decimal"),
            ("срок_в_месяцах", F.col("term_months"), "integer"),
            ("дата_выдачи", _day("issue_date"), "string"),
            ("ежемесячный_платеж", F.col("monthly_payment").cast("decimal(14,2)"), "decimal"),
        ]),
        links,
    ]
    return reduce(DataFrame.unionByName, parts)


def class_graph(classes: DataFrame, domains: DataFrame, ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (class) and edges (source, target, label) of the class level.

    classes(class), domains(property, class, declared), ranges(property, class). Of several
    properties between two classes the one declared last labels the edge.
    """
    edges = (
        domains.select("property", "declared", F.col("class").alias("source"))
        .join(ranges.select("property", F.col("class").alias("target")), "property")
        .join(classes.select(F.col("class").alias("source")), "source", "left_semi")
        .groupBy("source", "target")
        .agg(F.max_by("property", F.struct("declared", "property")).alias("label"))
    )
    nodes = classes.select("class").union(edges.select("target")).distinct()
    return nodes, edges


def observed_schema(triples: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes, property domains and property ranges as they occur in the triples.

    An individual is first reduced to its distinct classes and to the distinct properties
    that start or end at it, a few words each, so that one with very many links joins like
    any other. Rows have no order of declaration, so the name decides between two
    properties.
    """

    def end(individual: str, kind: str) -> Column:
        return F.struct(
            F.col(individual).alias("individual"), F.lit(kind).alias("kind"), F.col("predicate").alias("property")
        )

    facts = triples.filter(F.col("object_kind") == IRI_KIND)
    types = facts.filter(F.col("predicate") == TYPE).select(
        F.col("subject").alias("individual"), F.col("object").alias("class")
    )
    ends = (
        facts.filter(F.col("predicate") != TYPE)
        .select(F.explode(F.array(end("subject", "domain"), end("object", "range"))).alias("end"))
        .select("end.*")
    )
    used = types.distinct().join(ends.distinct(), "individual", "left").select("class", "kind", "property").distinct()
    stored = written(used, "schema")

    def of_kind(kind: str) -> DataFrame:
        return stored.filter(F.col("kind") == kind).select("property", "class")

    return stored.select("class").distinct(), of_kind("domain").withColumn("declared", F.lit(0)), of_kind("range")


def schema_of_edges(edges: DataFrame, classes: DataFrame, iri: str = BANK_IRI) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes, property domains and property ranges from links that carry the kinds of their ends.

    A few kinds are left of all links within each task. `classes` (class) names further ones.
    """
    kinds = edges.select("source_kind", "predicate", "target_kind").distinct()
    kinds = written(kinds.select(*[F.concat(F.lit(iri), c).alias(c) for c in kinds.columns]), "kinds")
    ends = kinds.select(F.col("source_kind").alias("class")).union(kinds.select("target_kind"))
    domains = kinds.select(F.col("predicate").alias("property"), F.col("source_kind").alias("class"), F.lit(0).alias("declared"))
    ranges = kinds.select(F.col("predicate").alias("property"), F.col("target_kind").alias("class"))
    known = classes.select(F.concat(F.lit(iri), "class").alias("class"))
    return written(ends.union(known).distinct(), "classes"), domains.distinct(), ranges.distinct()


def bank_classes(clients: DataFrame, accounts: DataFrame, transactions: DataFrame, credits: DataFrame) -> DataFrame:
    """The classes that have an individual: one row of each table is looked at."""
    named = {"Клиент": clients, "Счет": accounts, "Транзакция": transactions, "Кредит": credits}
    return reduce(DataFrame.unionByName, [df.limit(1).select(F.lit(cls).alias("class")) for cls, df in named.items()])


def class_graph_rows(classes: DataFrame, domains: DataFrame, ranges: DataFrame) -> DataFrame:
    """The class graph as one listing: every edge, and a row without target per class that starts none."""
    nodes, edges = class_graph(classes, domains, ranges)
    alone = nodes.select(F.col("class").alias("source")).join(edges, "source", "left_anti")
    none = F.lit(None).cast("string")
    return edges.unionByName(alone.select("source", none.alias("target"), none.alias("label")))
