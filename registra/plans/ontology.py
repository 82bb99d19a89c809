"""Declared classes and properties of the two graphs, as triples and as an OWL file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.plans.triples import BANK_IRI, IRI_KIND, SKILLS_IRI, TYPE, XSD

# Names of the OWL standards.
OWL = "http://www.w3.org/2002/07/owl#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
THING = OWL + "Thing"


@dataclass(frozen=True)
class Ontology:
    """Names in order of declaration; links are (property, domain, range), values
    (property, domain, datatype)."""

    iri: str
    classes: tuple[str, ...]
    links: tuple[tuple[str, str, str], ...]
    values: tuple[tuple[str, str | None, str], ...]

    def name(self, short: str | None) -> str:
        return THING if short is None else self.iri + short


# What the two graphs declare.
SKILLS = Ontology(
    SKILLS_IRI,
    ("Знание", "Компетенция", "Специалист", "Должность"),
    (
        ("требует_знание", "Компетенция", "Знание"),
        ("обладает_знанием", "Специалист", "Знание"),
        ("обладает_компетенцией", "Специалист", "Компетенция"),
        ("может_занимать_должность", "Специалист", "Должность"),
        ("требует_компетенцию", "Должность", "Компетенция"),
    ),
    (("название", None, "string"), ("имя_сотрудника", "Специалист", "string")),
)
BANK = Ontology(
    BANK_IRI,
    ("Клиент", "Счет", "Транзакция", "Кредит"),
    (
        ("владеет_счетом", "Клиент", "Счет"),
        ("имеет_кредит", "Клиент", "Кредит"),
        ("относится_к_счету", "Транзакция", "Счет"),
    ),
    (
        *[(p, "Клиент", "string") for p in ("фио", "дата_рождения", "паспортные_данные", "адрес", "телефон", "email")],
        *[(p, "Счет", "string") for p in ("номер_счета", "тип_счета", "валюта", "дата_открытия")],
        ("остаток", "Счет", "decimal"),
        ("дата_транзакции", "Транзакция", "string"),
        ("сумма_транзакции", "Транзакция", "decimal"),
        ("тип_транзакции", "Транзакция", "string"),
        ("описание", "Транзакция", "string"),
        ("сумма_кредита", "Кредит", "decimal"),
        ("процентная_ставка", "Кредит", "decimal"),
        ("срок_в_месяцах", "Кредит", "integer"),
        ("дата_выдачи", "Кредит", "string"),
        ("ежемесячный_платеж", "Кредит", "decimal"),
    ),
)


def declarations(ontology: Ontology) -> list[tuple[str, str, str]]:
    """(subject, predicate, object) of every class and property, all of them names."""
    name = ontology.name
    facts = [(name(c), TYPE, OWL + "Class") for c in ontology.classes]
    for kind, rows in (("ObjectProperty", ontology.links), ("DatatypeProperty", ontology.values)):
        for prop, domain, target in rows:
            end = name(target) if kind == "ObjectProperty" else XSD + target
            facts += [(name(prop), TYPE, OWL + kind), (name(prop), RDFS + "domain", name(domain)), (name(prop), RDFS + "range", end)]
    return facts


def schema_triples(spark: SparkSession, ontology: Ontology) -> DataFrame:
    """The declarations as triples, to stand beside the individuals."""
    rows = spark.createDataFrame(declarations(ontology), "subject string, predicate string, object string")
    return rows.withColumns({"object_kind": F.lit(IRI_KIND), "datatype": F.lit(None).cast("string")})


def write_schema(spark: SparkSession, ontology: Ontology, path: str) -> None:
    """The declarations as RDF/XML files below `path`, each in order of declaration."""
    name = ontology.name
    resource = lambda c: F.struct(F.col(c).alias("_rdf:resource"))

    def save(rows: DataFrame, tag: str) -> None:
        (
            rows.coalesce(1)
            .write.format("xml")
            .option("validateName", False)
            .mode("overwrite")
            .option("rootTag", f'rdf:RDF xmlns:rdf="{TYPE.removesuffix("type")}" xmlns:owl="{OWL}" xmlns:rdfs="{RDFS}"')
            .option("rowTag", tag)
            .save(f"{path}/{tag.partition(':')[2]}")
        )

    save(spark.createDataFrame([(name(c),) for c in ontology.classes], "`_rdf:about` string"), "owl:Class")
    for tag, rows in (("owl:ObjectProperty", [(name(p), name(d), name(r)) for p, d, r in ontology.links]),
                      ("owl:DatatypeProperty", [(name(p), name(d), XSD + r) for p, d, r in ontology.values])):
        ends = spark.createDataFrame(rows, "about string, start string, stop string")
        save(ends.select(F.col("about").alias("_rdf:about"), resource("start").alias("rdfs:domain"), resource("stop").alias("rdfs:range")), tag)
