"""The small skills base with known results."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from registra import schemas
from registra.operators import division
from registra.plans import skills, triples
from registra.plans.skills import SkillBase

REQUIRES = {1: [1, 2, 3], 2: [4, 5], 3: [1, 4, 5], 4: [5, 6, 7], 5: [1, 9], 6: [8, 9], 7: [4, 10], 8: [4, 5]}
NEEDS = {1: [2, 3], 2: [2, 3], 3: [5], 4: [2], 5: [3]}
HOLDS = {1: [1, 4, 5], 2: [1, 4, 5], 3: [1, 2, 9], 4: [5, 6, 7], 5: [5, 6, 7], 6: [4, 5, 10], 7: [1, 2, 3]}


def pairs(links):
    return [(a, b) for a, bs in links.items() for b in bs]


def grouped(df):
    out = {}
    for a, b in map(tuple, df.collect()):
        out.setdefault(a, set()).add(b)
    return out


@pytest.fixture
def base(rows):
    held = [(p, f"person {p}", k) for p, k in pairs(HOLDS)]
    return SkillBase(
        skills=rows(held + held[:3], schemas.EMPLOYEE_SKILLS),
        knowledge=rows([(i, f"k{i}") for i in range(1, 11)], schemas.KNOWLEDGE),
        competencies=rows([(i, f"c{i}") for i in range(1, 9)], schemas.COMPETENCIES),
        competency_knowledge=rows(pairs(REQUIRES), schemas.COMPETENCY_KNOWLEDGE),
        positions=rows([(i, f"p{i}") for i in range(1, 6)], schemas.POSITIONS),
        position_competency=rows(pairs(NEEDS), schemas.POSITION_COMPETENCY),
    )


@pytest.fixture
def extra(rows):
    return rows([(4, 4), (2, 1), (1, 2)], schemas.POSITION_COMPETENCY)


def test_inference(base):
    found = skills.infer(base)
    assert grouped(found.competencies) == {1: {2, 3, 8}, 2: {2, 3, 8}, 3: {5}, 4: {4}, 5: {4}, 6: {2, 7, 8}, 7: {1}}
    assert grouped(found.positions) == {1: {1, 2, 4, 5}, 2: {1, 2, 4, 5}, 3: {3}, 6: {4}}
    assert skills.missing_knowledge(base).count() == 79
    assert skills.missing_competencies(base).count() == 33


def test_new_requirements_and_skills(base, extra, rows):
    changed = skills.with_requirements(base, extra)
    assert changed.position_competency.count() == 9
    more = skills.with_skills(changed, rows([(5, 1), (5, 4), (77, 1)], "employee_id int, knowledge_id int"))
    again = skills.infer(skills.only_person(more, 5))
    assert grouped(again.competencies) == {5: {2, 3, 4, 8}}
    assert grouped(again.positions) == {5: {1, 4, 5}}

    kept = skills.positions_after(base, extra, "keep").unionByName(again.positions)
    granted = skills.competencies_of(more)
    violations = skills.position_violations(kept, granted, more.position_competency)
    assert sorted(map(tuple, violations.collect())) == [(1, 2), (1, 4), (2, 2), (2, 4), (6, 4)]
    assert grouped(skills.positions_of(more)) == {1: {1, 5}, 2: {1, 5}, 3: {3}, 5: {1, 4, 5}}
    assert grouped(skills.positions_after(base, extra, "recompute")) == {1: {1, 5}, 2: {1, 5}, 3: {3}}
    with pytest.raises(ValueError):
        skills.positions_after(base, extra, "other")


def test_new_person_gets_everything(base):
    larger = skills.with_new_person(base, "somebody")
    found = skills.infer(skills.only_person(larger, 8))
    assert grouped(found.competencies) == {8: set(range(1, 9))}
    assert grouped(found.positions) == {8: set(range(1, 6))}


def test_goal_without_requirements_goes_to_everybody(base, rows):
    free = replace(base, competencies=base.competencies.union(rows([(9, "c9")], schemas.COMPETENCIES)))
    got = grouped(skills.competencies_of(free))
    assert set(got) == set(range(1, 8)) and all(9 in got[p] for p in got)


def test_gaps_do_not_depend_on_any_size(base, rows):
    """NULL, repeated and unrelated links; blocks of one goal and salts of one person against the defaults."""
    links = "employee_id int, item int"
    held = rows([(1, 1), (1, 2), (2, 2), (2, 2), (3, 9), (4, None)], links)
    people = rows([(i,) for i in range(1, 6)], "employee_id int")
    required = rows([(1, 1), (1, 2), (1, 2), (2, 2), (3, 7), (4, None), (None, 1)], "goal int, item int")
    goals = rows([(1,), (2,), (3,), (4,), (5,), (None,)], "goal int")
    wanted = {(1, 3, 7), (2, 1, 1), (2, 3, 7)} | {(p, g, i) for p in (3, 4, 5) for g, i in ((1, 1), (1, 2), (2, 2), (3, 7))}
    for per_salt in (1, 2, 100_000):
        found = division.missing(people, held, required, "employee_id", "goal", "item", per_salt=per_salt).collect()
        assert sorted(map(tuple, found)) == sorted(wanted)
    # goals 4 and 5 require nothing that has a name
    distinct = held.dropna().distinct()
    earned = {(1, 1), (1, 2), (2, 2)} | {(p, g) for p in range(1, 6) for g in (4, 5)}
    found = division.qualified(people, distinct, goals, required, "employee_id", "goal", "item").collect()
    assert sorted(map(tuple, found)) == sorted(earned)
    for per_block in (1, 3, 1000):
        pairs = division.paired_with(people, goals.dropna(), 5, per_block).collect()
        assert sorted(map(tuple, pairs)) == [(p, g) for p in range(1, 6) for g in range(1, 6)]


def test_goals_without_requirements_beside_others(base, rows):
    free = replace(base, competencies=base.competencies.union(rows([(9, "c9")], schemas.COMPETENCIES)))
    assert skills.competencies_of(free).filter("competency_id = 9").count() == 7
    assert skills.competencies_of(base).count() == 13 and skills.positions_of(base).count() == 10


def test_inference_refuses_unknown_requirements(base, rows, extra):
    broken = replace(base, competency_knowledge=base.competency_knowledge.union(rows([(1, 99)], schemas.COMPETENCY_KNOWLEDGE)))
    with pytest.raises(ValueError, match="unknown ids"):
        skills.infer(broken)
    with pytest.raises(ValueError, match="unknown ids"):
        skills.positions_after(base, rows([(1, 99)], schemas.POSITION_COMPETENCY))


def test_text_ids_make_valid_names(spark):
    frame = spark.createDataFrame([("A B>%",), ("A_B",)], "position_id string")
    names = [r[0] for r in frame.select(skills.individual("position")).collect()]
    assert names == ["должность_A%20B%3E%25", "должность_A_B"]


def test_unknown_ids(base, rows):
    odd = replace(base, skills=base.skills.union(rows([(7, "person 7", 99)], schemas.EMPLOYEE_SKILLS)))
    assert grouped(skills.competencies_of(odd)) == grouped(skills.competencies_of(base))
    assert [tuple(r) for r in skills.unknown_ids(odd).collect()] == [("skills", "knowledge_id", "99", 1)]
    skills.require_known_links(odd)
    broken = replace(base, position_competency=base.position_competency.union(rows([(1, 99)], schemas.POSITION_COMPETENCY)))
    with pytest.raises(ValueError):
        skills.require_known_links(broken)


def test_listings(base, rows):
    none_known = replace(base, skills=base.skills.union(rows([(9, "person 9", 99)], schemas.EMPLOYEE_SKILLS)))
    profile = {r.employee_id: r.ids for r in skills.skill_profile(none_known).collect()}
    assert profile[1] == [1, 4, 5] and profile[9] == []
    lonely = replace(base, positions=base.positions.union(rows([(6, None)], schemas.POSITIONS)))
    listing = skills.requirements(lonely)
    assert listing.filter("kind = 'position' AND name = 'должность_6' AND required_name IS NULL").count() == 1
    full = skills.full_profile(none_known)
    assert full.filter("employee_id = 9 AND kind IS NULL").count() == 1
    assert full.filter("kind = 'position'").count() == 10


def test_two_names_for_one_id(base, rows):
    renamed = replace(base, skills=base.skills.union(rows([(1, "a person", 2)], schemas.EMPLOYEE_SKILLS)))
    assert skills.people(renamed).filter("employee_id = 1").first().full_name == "person 1"
    assert grouped(skills.held_knowledge(renamed).select("employee_id", "knowledge_id"))[1] == {1, 2, 4, 5}


def test_triples(base):
    facts = triples.skill_triples(base)
    assert facts.filter(F.col("predicate") == triples.TYPE).count() == 10 + 8 + 5 + 7
    grants = facts.filter(F.col("predicate").endswith("может_занимать_должность"))
    assert grants.count() == 10 and grants.filter("object_kind <> 'iri'").isEmpty()


def test_gaps_over_a_catalogue_of_many_blocks(spark):
    rng = random.Random(5)
    items = list(range(-70, 130))
    required = {goal: set(rng.sample(items, rng.randint(1, 150))) for goal in "abcdef"}
    held = {person: set(rng.sample([*items, 999], rng.randint(0, 180))) for person in range(25)}
    held |= {person: set() for person in (25, 26)} | {27: set(items)}
    people = spark.createDataFrame([(p,) for p in held], "person int")
    owned = spark.createDataFrame([(p, i) for p, own in held.items() for i in own], "person int, item int")
    needs = spark.createDataFrame([(g, i) for g, own in required.items() for i in own] + [("a", None), (None, 3)], "goal string, item int")
    items_of = division.numbered_items(division.valid_requirements(needs, "goal", "item"), "item")
    assert items_of.select("_block").distinct().count() > 3
    wanted = sorted((p, g, i) for p, own in held.items() for g, asked in required.items() for i in asked - own)
    for per_salt in (100_000, 1):
        found = division.missing(people, owned.repartition(3), needs, "person", "goal", "item", per_salt)
        assert sorted(map(tuple, found.collect())) == wanted


def test_gaps_without_requirements_or_people(spark):
    people, owned = spark.createDataFrame([(1,)], "person int"), spark.createDataFrame([(1, 5)], "person int, item int")
    needs = spark.createDataFrame([("a", 5), ("b", 6)], "goal string, item int")
    assert division.missing(people, owned, needs.limit(0), "person", "goal", "item").count() == 0
    assert division.missing(people.limit(0), owned, needs, "person", "goal", "item").count() == 0
    assert [tuple(r) for r in division.missing(people, owned, needs, "person", "goal", "item").collect()] == [(1, "b", 6)]


def test_added_skills_are_written_before_inference(base, rows):
    more = skills.with_skills(base, rows([(5, 1), (5, 1), (77, 1)], "employee_id int, knowledge_id int"))
    plan = more.skills._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert sorted(map(tuple, more.skills.collect())) == sorted({*map(tuple, base.skills.collect()), (5, "person 5", 1)})


def test_division_compares_sets_by_block(spark, rows):
    draws = random.Random(3)
    required = [(g, draws.randrange(300)) for g in range(40) for _ in range(1 + g % 3)]
    held = [(p, i) for p in range(30) for i in range(300) if draws.random() < 0.7]
    people = rows([(p,) for p in range(31)], "p int")
    args = rows(held, "p int, i int"), rows([(g,) for g in range(40)], "g int"), rows(required, "g int, i int"), "p", "g", "i"
    found = division.qualified(people, *args)
    known, needs = set(held), {g: {i for h, i in required if h == g} for g in range(40)}
    assert sorted(map(tuple, found.collect())) == sorted((p, g) for p in range(31) for g in needs if all((p, i) in known for i in needs[g]))
    assert "_mask" in found._jdf.queryExecution().optimizedPlan().toString()
