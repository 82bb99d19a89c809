"""Relational division: who holds everything that something requires, and who lacks what.

A requirement is a (goal, item) without NULL; rows that hold one name nothing and are left out, in
both functions and before anything else. Nothing here depends on the size of a table but the
number of parts that rows are dealt over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registra.sources.shared import written

# Parts that the rows of one key are spread over.
SALTS = 64
# Items of a block have the bits of a 64-bit mask.
_BLOCK_BITS = 6


def _part(df: DataFrame, parts: int) -> Column:
    """A row's part, by its content; maps have no hash and do not count."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.pmod(F.xxhash64(*plain), F.lit(parts).cast("bigint"))


def _every(parts: int) -> Column:
    """A copy of the row for every part."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint")))


def valid_requirements(required: DataFrame, goal: str, item: str) -> DataFrame:
    return required.select(goal, item).dropna().distinct()


def paired_with(people: DataFrame, catalogue: DataFrame, values: int, per_block: int = 1000) -> DataFrame:
    """Every person with every catalogue row, for results defined on all of these pairs.

    The catalogue's `values` rows are gathered in blocks of about `per_block`, each a list in one row. People are
    copied to the blocks and joined on (block, salt): no key holds more than one block and a
    part of the people, and Spark broadcasts the blocks where they are small.
    """
    blocks = max(1, -(-values // per_block))
    listed = (
        catalogue.select(F.struct(*catalogue.columns).alias("_row"), _part(catalogue, blocks).alias("_block"))
        .groupBy("_block")
        .agg(F.collect_list("_row").alias("_rows"))
        .withColumn("_salt", _every(SALTS))
    )
    left = people.withColumn("_salt", _part(people, SALTS)).withColumn("_block", _every(blocks))
    return left.join(listed, ["_block", "_salt"]).select(*people.columns, F.explode("_rows").alias("_row")).select(*people.columns, "_row.*")


def qualified(
    people: DataFrame, held: DataFrame, goals: DataFrame, required: DataFrame, person: str, goal: str, item: str
) -> DataFrame:
    """Distinct (person, goal) for which the person holds every required item.

    `held` holds distinct (person, item) of these people. A goal without requirements goes
    to everybody. Held and required items are compared as 64-bit sets by block of the catalogue: a person's block meets
    the goals that need something of it, and only those met in full go on; the number of such blocks is compared with the
    goal's. Much of the people may hold items of one block, and Spark splits such a key.
    """
    known = goals.select(goal).dropna().distinct()
    needs = valid_requirements(required, goal, item).join(known, goal, "left_semi")
    per_goal = needs.groupBy(goal).agg(F.count(F.lit(1)).alias("_needed"))
    sizes = written(known.join(per_goal, goal, "left").withColumn("_needed", F.coalesce("_needed", F.lit(0))), "goals")
    needs = written(needs, "needs")
    items = numbered_items(needs, item)
    wanted = bitmaps(needs.join(items, item), [goal]).withColumnRenamed("_mask", "_wanted")
    blocks = wanted.groupBy(goal).agg(F.count(F.lit(1)).alias("_blocks"))
    met = F.col("_wanted").bitwiseAND(F.bitwise_not("_mask")) == 0
    earned = (
        bitmaps(held.select(person, item).join(items, item), [person])
        .join(wanted.join(blocks, goal), "_block")
        .filter(met)
        .groupBy(person, goal)
        .agg(F.count(F.lit(1)).alias("_met"), F.max("_blocks").alias("_blocks"))
        .filter("_met = _blocks")
        .select(person, goal)
    )
    free = sizes.filter("_needed = 0").select(goal)
    n_free = free.count()
    if not n_free:
        return earned
    return earned.unionByName(paired_with(people.select(person).distinct(), free, n_free).select(person, goal))


def numbered_items(needs: DataFrame, item: str) -> DataFrame:
    """item, _block, _bit of every distinct item: up to 64 items share a block, each has a bit of it."""
    number = F.monotonically_increasing_id()
    items = written(needs.select(item).distinct().withColumn("_number", number), "items")
    return items.select(item, F.shiftright("_number", _BLOCK_BITS).alias("_block"), F.col("_number").bitwiseAND((1 << _BLOCK_BITS) - 1).cast("int").alias("_bit"))


def bitmaps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, _block, _mask: the items of a key as 64-bit sets, reduced in each task by hash."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit"))
    return rows.groupBy(*keys, "_block").agg(F.bit_or(bit).alias("_mask"))


def missing(
    people: DataFrame, held: DataFrame, required: DataFrame, person: str, goal: str, item: str, per_salt: int = 100_000
) -> DataFrame:
    """One row (person, goal, item) per required item a person lacks.

    Items are numbered, and sets of them are 64-bit masks by block of the catalogue. People are first reduced to their
    distinct sets of held required items. Gaps are worked out once per (set, goal, block), as
    needed and not held, and only then listed by name for the
    people of a set; a set that very many hold is dealt over salts of `per_salt` people.
    """
    needs = written(valid_requirements(required, goal, item), "needs")
    items = numbered_items(needs, item)
    held_blocks = bitmaps(held.select(person, item).join(items, item), [person])
    sets = held_blocks.groupBy(person).agg(F.array_sort(F.collect_list(F.struct("_block", "_mask"))).alias("_held"))
    nothing = F.array().cast(sets.schema["_held"].dataType)
    listed = people.select(person).distinct().join(sets, person, "left").withColumn("_held", F.coalesce("_held", nothing))
    listed = listed.withColumn("_set", F.sha2(F.to_json("_held"), 256)).withColumn("_held", F.map_from_entries("_held"))
    listed = written(listed, "held-sets")
    distinct = listed.groupBy("_set").agg(F.first("_held").alias("_held"), F.count(F.lit(1)).alias("_people"))
    goals = bitmaps(needs.join(items, item), [goal]).withColumnRenamed("_mask", "_needed")
    pairs = paired_with(distinct, goals, goals.count())
    lacks = F.col("_needed").bitwiseAND(F.bitwise_not(F.coalesce(F.col("_held")[F.col("_block")], F.lit(0).cast("bigint"))))
    lacking = pairs.select("_set", "_people", goal, "_block", lacks.alias("_lacks")).filter("_lacks != 0")
    bits = F.array_sort(F.collect_list(F.struct("_bit", item)))
    names = items.groupBy("_block").agg(bits.alias("_items"))
    is_missing = lambda entry: F.getbit("_lacks", entry["_bit"]) == 1
    named = lacking.join(names, "_block").select("_set", "_people", goal, F.filter("_items", is_missing).alias("_lacks"))
    salts = F.ceil(F.col("_people") / per_salt).cast("bigint")
    gaps = named.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
    spread = listed.join(distinct.select("_set", "_people"), "_set").withColumn(
        "_salt", F.pmod(F.xxhash64(person), salts)
    )
    return (
        spread.select(person, "_set", "_salt")
        .join(gaps.drop("_people"), ["_set", "_salt"])
        .select(person, goal, F.explode("_lacks").alias("_entry"))
        .select(person, goal, F.col("_entry")[item].alias(item))
    )
