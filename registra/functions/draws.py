"""Reproducible draws: pure functions of (seed, what is drawn, row id).

`rand()` depends on how rows fall into partitions; a digest of the id does not, so a
generated table is the same for any cluster size and after any task retry.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int, what: str, *ids: Column) -> Column:
    """A whole number in [0, 2^60)."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(what), *[i.cast("string") for i in ids])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def between(drawn: Column, low: int | Column, high: int | Column) -> Column:
    """Whole number in [low, high]."""
    low, high = (F.lit(x) if isinstance(x, int) else x for x in (low, high))
    low, high = low.cast("bigint"), high.cast("bigint")
    return low + F.pmod(drawn, high - low + 1)


def day_between(drawn: Column, first: Column, last: Column) -> Column:
    """Day in [first, last]."""
    return F.date_add(first, F.pmod(drawn, F.datediff(last, first).cast("bigint") + 1).cast("int"))


def pick(drawn: Column, values: list) -> Column:
    """One of the values, each as likely as the others."""
    choices = F.array(*[F.lit(v) for v in values])
    return F.element_at(choices, (F.pmod(drawn, F.lit(len(values)).cast("bigint")) + 1).cast("int"))


def pick_weighted(drawn: Column, values: list, per_cent: list[int]) -> Column:
    """One of the values with the given chances, which add up to 100."""
    if sum(per_cent) != 100:
        raise ValueError("chances must add up to 100")
    place = F.pmod(drawn, F.lit(100).cast("bigint"))
    chosen = F
    for value, limit in zip(values[:-1], accumulate(per_cent)):
        chosen = chosen.when(place < limit, F.lit(value))
    return chosen.otherwise(F.lit(values[-1]))


def cycle_unique(number: Column, words: list[str]) -> Column:
    """A distinct text for every number >= 1: the words in turn, then the words with 2, 3, ... added."""
    size = F.lit(len(words)).cast("bigint")
    zero_based = number.cast("bigint") - 1
    word = F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(zero_based, size) + 1).cast("int"))
    turn = F.floor(zero_based / size)
    return F.when(turn == 0, word).otherwise(F.concat_ws(" ", word, (turn + 1).cast("string")))
