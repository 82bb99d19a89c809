"""Skills inference: knowledge -> competencies -> positions, gaps and what-if changes.

All tables are links between ids:
    skills(employee_id, full_name, knowledge_id)      knowledge(knowledge_id, knowledge_name)
    competencies(competency_id, competency_name)      competency_knowledge(competency_id, knowledge_id)
    positions(position_id, position_name)             position_competency(position_id, competency_id)
A person is the id: if one id carries several names, the last name in text order is used.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.operators import division, quality
from registra.sources.shared import spread, written


# What technical names begin with.
INDIVIDUALS = {"knowledge": "знание", "competency": "компетенция", "position": "должность", "employee": "сотрудник"}


@dataclass(frozen=True)
class SkillBase:
    skills: DataFrame
    knowledge: DataFrame
    competencies: DataFrame
    competency_knowledge: DataFrame
    positions: DataFrame
    position_competency: DataFrame


def people(base: SkillBase) -> DataFrame:
    """employee_id, full_name; rows without an id or a name are nobody."""
    named = base.skills.filter("employee_id IS NOT NULL AND full_name IS NOT NULL")
    # Distinct first: it reduces the rows by hash, while the largest text needs a sort.
    names = named.select("employee_id", "full_name").distinct()
    return names.groupBy("employee_id").agg(F.max("full_name").alias("full_name"))


def distinct_skills(base: SkillBase) -> DataFrame:
    return base.skills.dropDuplicates()


def held_knowledge(base: SkillBase) -> DataFrame:
    """Distinct (employee_id, knowledge_id); ids that name no knowledge are left out."""
    return (
        base.skills.filter("employee_id IS NOT NULL AND full_name IS NOT NULL")
        .select("employee_id", "knowledge_id")
        .distinct()
        .join(base.knowledge, "knowledge_id", "left_semi")
        .select("employee_id", "knowledge_id")
    )


def unknown_ids(base: SkillBase) -> DataFrame:
    """Ids no table knows, with their row count: in skills they are skipped, in the
    requirement tables they make the build fail (see `require_known_links`)."""
    places = [
        ("skills", base.skills, "knowledge_id", base.knowledge),
        ("competency_knowledge", base.competency_knowledge, "competency_id", base.competencies),
        ("competency_knowledge", base.competency_knowledge, "knowledge_id", base.knowledge),
        ("position_competency", base.position_competency, "position_id", base.positions),
        ("position_competency", base.position_competency, "competency_id", base.competencies),
    ]
    return reduce(
        DataFrame.unionByName,
        [
            quality.orphans(links, column, parents, column).select(
                F.lit(table).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.col(column).cast("string").alias("unknown_id"),
                "n_rows",
            )
            for table, links, column, parents in places
        ],
    )


def require_known_links(base: SkillBase) -> None:
    broken = unknown_ids(base).filter("table_name <> 'skills'")
    if not broken.isEmpty():
        raise ValueError("requirement tables name unknown ids")


def competencies_of(base: SkillBase, held: DataFrame | None = None, everybody: DataFrame | None = None) -> DataFrame:
    """(employee_id, competency_id): the person holds all knowledge the competency requires."""
    held = held_knowledge(base) if held is None else held
    return division.qualified(
        people(base) if everybody is None else everybody, held, base.competencies, base.competency_knowledge,
        "employee_id", "competency_id", "knowledge_id",
    )


def positions_of(base: SkillBase, granted: DataFrame | None = None, everybody: DataFrame | None = None) -> DataFrame:
    """(employee_id, position_id): the person holds all competencies the position requires."""
    granted = competencies_of(base) if granted is None else granted
    return division.qualified(
        people(base) if everybody is None else everybody, granted, base.positions, base.position_competency,
        "employee_id", "position_id", "competency_id",
    )


@dataclass(frozen=True)
class Inference:
    """What people hold and what follows from it; everybody has employee_id and full_name."""

    everybody: DataFrame
    held: DataFrame
    competencies: DataFrame
    positions: DataFrame


def infer(base: SkillBase) -> Inference:
    """Fails if a requirement names an unknown id. People, what they hold and competencies
    are narrow tables that later steps read more than once, so they are written once."""
    require_known_links(base)
    everybody = written(people(base), "people")
    held = written(held_knowledge(base), "held")
    granted = written(competencies_of(base, held, everybody), "competencies")
    return Inference(everybody, held, granted, positions_of(base, granted, everybody))


def position_violations(held_positions: DataFrame, granted: DataFrame, position_competency: DataFrame) -> DataFrame:
    """Held (employee_id, position_id) for which a required competency is missing."""
    return (
        held_positions.join(position_competency, "position_id")
        .join(granted, ["employee_id", "competency_id"], "left_anti")
        .select("employee_id", "position_id")
        .distinct()
    )


def missing_knowledge(base: SkillBase) -> DataFrame:
    known = base.competency_knowledge.join(base.competencies, "competency_id", "left_semi")
    return division.missing(
        people(base), held_knowledge(base), known, "employee_id", "competency_id", "knowledge_id"
    )


def missing_competencies(base: SkillBase, granted: DataFrame | None = None) -> DataFrame:
    granted = competencies_of(base) if granted is None else granted
    known = base.position_competency.join(base.positions, "position_id", "left_semi")
    return division.missing(people(base), granted, known, "employee_id", "position_id", "competency_id")


def requirements(base: SkillBase) -> DataFrame:
    """Listing: kind, name and required_name per requirement; required_name is NULL for none."""
    by_competency = (
        base.competencies.join(base.competency_knowledge, "competency_id", "left")
        .join(base.knowledge, "knowledge_id", "left")
        .select(
            F.lit("competency").alias("kind"),
            _title("competency").alias("name"),
            F.col("knowledge_name").alias("required_name"),
        )
    )
    by_position = (
        base.positions.join(base.position_competency, "position_id", "left")
        .join(base.competencies, "competency_id", "left")
        .select(
            F.lit("position").alias("kind"),
            _title("position").alias("name"),
            F.col("competency_name").alias("required_name"),
        )
    )
    return by_competency.unionByName(by_position)


def individual(entity: str) -> Column:
    """Technical name of a knowledge, competency, position or employee.

    Ids may be text; what may not stand in an IRI is percent-encoded, and the percent sign too, so that
    different ids keep different names.
    """
    safe = F.replace(F.col(f"{entity}_id").cast("string"), F.lit("%"), F.lit("%25"))
    return F.concat(F.lit(f"{INDIVIDUALS[entity]}_"), iri_safe(safe))


# Characters below 128 that may not stand in an IRI.
NOT_IN_IRI = [*map(chr, range(33)), *'<>"{}|^`\\']


def iri_safe(text: Column) -> Column:
    """Text with the characters that no IRI may hold percent-encoded."""
    encoded = text
    for ch in NOT_IN_IRI:
        encoded = F.replace(encoded, F.lit(ch), F.lit(f"%{ord(ch):02X}"))
    return F.when(text.rlike(r'[\x00-\x20<>"{}|^`\\]'), encoded).otherwise(text)


def _title(entity: str) -> Column:
    """Display name, else the technical name."""
    return F.coalesce(F.col(f"{entity}_name"), individual(entity))


def skill_profile(base: SkillBase) -> DataFrame:
    """Per person the ordered list of held knowledge ids, empty if none is known.

    The list is distinct, so the knowledge table bounds its length.
    """
    lists = held_knowledge(base).groupBy("employee_id").agg(F.array_sort(F.collect_set("knowledge_id")).alias("ids"))
    empty = F.array().cast(lists.schema["ids"].dataType)
    return people(base).join(lists, "employee_id", "left").withColumn("ids", F.coalesce("ids", empty))


def skill_counts(base: SkillBase) -> DataFrame:
    """Per person and knowledge id the number of skill rows: the list with its repeats, as counts."""
    return (
        base.skills.filter("employee_id IS NOT NULL AND full_name IS NOT NULL")
        .groupBy("employee_id", "full_name", "knowledge_id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def full_profile(base: SkillBase) -> DataFrame:
    """Listing: one row per person and held thing (kind: knowledge, competency, position)."""
    found = infer(base)
    parts = [
        (found.held, base.knowledge, "knowledge"),
        (found.competencies, base.competencies, "competency"),
        (found.positions, base.positions, "position"),
    ]
    listing = reduce(
        DataFrame.unionByName,
        [
            links.join(table, f"{kind}_id").select("employee_id", F.lit(kind).alias("kind"), _title(kind).alias("name"))
            for links, table, kind in parts
        ],
    )
    return found.everybody.join(listing, "employee_id", "left").select("employee_id", "full_name", "kind", "name")


def with_requirements(base: SkillBase, extra: DataFrame) -> SkillBase:
    """Add (position_id, competency_id) requirements that are not there yet."""
    links = base.position_competency.unionByName(extra.select("position_id", "competency_id")).distinct()
    return replace(base, position_competency=links)


def positions_after(base: SkillBase, extra: DataFrame, mode: str = "keep", granted: DataFrame | None = None) -> DataFrame:
    """Positions after new requirements. `keep` leaves earlier grants in place, as adding
    facts does; `recompute` grants anew. Competencies do not depend on positions, so they
    are inferred once, or given."""
    if mode not in ("keep", "recompute"):
        raise ValueError(f"unknown mode {mode!r}")
    require_known_links(with_requirements(base, extra))
    if granted is None:
        granted = written(competencies_of(base), "competencies")
    now = positions_of(with_requirements(base, extra), granted)
    return now if mode == "recompute" else positions_of(base, granted).unionByName(now).distinct()


def with_skills(base: SkillBase, extra: DataFrame) -> SkillBase:
    """Add (employee_id, knowledge_id) skills to people who are there already.

    Names and the new skills are written, so that no task joins, merges and infers at once, and rows are dealt
    over all tasks before they are sorted or gathered.
    """
    more = spread(extra.select("employee_id", "knowledge_id"), "employee_id")
    named = more.join(written(people(base), "people"), "employee_id")
    skills = base.skills.unionByName(named.select(base.skills.columns))
    return replace(base, skills=written(spread(skills, *skills.columns).dropDuplicates(), "skills"))


def only_person(base: SkillBase, employee_id) -> SkillBase:
    """The base seen by one person, to infer again after a change to that person."""
    return replace(base, skills=base.skills.filter(F.col("employee_id") == F.lit(employee_id)))


def next_employee_id(base: SkillBase) -> DataFrame:
    """One row: the largest id plus one."""
    return people(base).agg((F.max("employee_id") + 1).alias("employee_id"))


def with_new_person(base: SkillBase, full_name: str) -> SkillBase:
    """Add a person with the next free id who holds all knowledge."""
    kind = base.skills.schema["employee_id"].dataType
    new_id = next_employee_id(base).scalar().cast(kind)
    rows = base.knowledge.select(
        new_id.alias("employee_id"), F.lit(full_name).alias("full_name"), "knowledge_id"
    )
    return replace(base, skills=base.skills.unionByName(rows.select(base.skills.columns)))
