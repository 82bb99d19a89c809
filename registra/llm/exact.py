"""Exact duplicates: a minimal perfect hash over the digests of earlier documents.

A history is a table of shards. A digest belongs to the shard its first eight bytes name; a
shard holds a minimal perfect hash of its n distinct digests and n slots, each with the full digest,
the locator of the document that stays, and the number of rows seen. Any digest gets some slot,
so a look-up compares all 32 bytes with the slot's; only equal ones are members.

The hash is built level by level: every digest left over names a bit of the level, bits that
exactly one digest names are set, the others' digests go to the next level. The rank of a digest's bit among all set bits
is its slot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registra.llm.common import by_hot_key, mix64, unused, whole_text, written

DIGEST_BYTES = 32
GAMMA = 1.5  # bits of a level per digest that reaches it
HISTORY = "shard bigint, shards bigint, n bigint, levels array<bigint>, bits binary, digests binary, winners binary, n_rows binary"


def normalised(text: Column) -> Column:
    """Runs of blanks, tabs and line ends as one blank."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def digest(df: DataFrame, column: str = "text") -> Column:
    """SHA-256 of the normalised text in UTF-8, as bytes; NULL counts as empty."""
    return F.unhex(F.sha2(normalised(whole_text(df, column)), 256))


def _positions(digests: np.ndarray, level: int, bits: int) -> np.ndarray:
    words = digests.view("<u8")
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix64(words[:, level % 4] ^ salt) % np.uint64(bits)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash of distinct 32-byte digests."""

    def __init__(self, levels: list[int], bits: np.ndarray):
        self.levels, self.bits = levels, bits
        self.rank = np.cumsum(bits, dtype=np.int64) - bits

    @classmethod
    def of(cls, digests: np.ndarray) -> PerfectHash:
        levels, bits, left = [], [], digests
        while len(left):
            if len(levels) == 256:
                raise ValueError("the digests are not distinct")
            size = int(GAMMA * len(left)) + 1
            at = _positions(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        return cls(levels, np.concatenate(bits) if bits else np.zeros(0, dtype=bool))

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """A slot for each digest; -1 where no level has its bit."""
        out = np.full(len(digests), -1, dtype=np.int64)
        left, base = np.arange(len(digests)), 0
        for level, size in enumerate(self.levels):
            at = base + _positions(digests[left], level, size)
            found = self.bits[at]
            out[left[found]] = self.rank[at[found]]
            left, base = left[~found], base + size
        return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="u1").reshape(-1, DIGEST_BYTES)


def _shard(shards: int) -> Column:
    # 15 hex digits of the digest make a number that is never negative.
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("bigint"), F.lit(shards).cast("bigint"))


def distinct_digests(rows: DataFrame) -> DataFrame:
    """digest, winner (smallest doc_id), n_rows. Copies are counted in each task first."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("winner"), F.count(F.lit(1)).alias("n_rows"))


def build_history(distinct: DataFrame, per_shard: int = 20_000, arrivals: int = 0) -> DataFrame:
    """The history table of distinct digests (digest, winner, n_rows): about `per_shard` in a row.

    If more digests than these are to be looked up, their number `arrivals` sets the shards, so that a
    shard meets about `per_shard` of them.
    """
    distinct = written(distinct, "distinct-digests")
    shards = max(1, -(-max(distinct.count(), arrivals) // per_shard))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        digests = _matrix(group["digest"])
        hashed = PerfectHash.of(digests)
        order = np.empty(len(digests), dtype=np.int64)
        order[hashed.slots(digests)] = np.arange(len(digests))
        known = group["winner"].notna().to_numpy()
        winners = group["winner"].fillna(0).to_numpy(dtype="<i8")
        return pd.DataFrame(
            {
                "shard": [int(group["shard"].iloc[0])],
                "shards": [shards],
                "n": [len(digests)],
                "levels": [hashed.levels],
                "bits": [np.packbits(hashed.bits).tobytes()],
                "digests": [digests[order].tobytes()],
                "winners": [winners[order].tobytes() + known[order].astype("u1").tobytes()],
                "n_rows": [group["n_rows"].to_numpy(dtype="<i8")[order].tobytes()],
            }
        )

    return written(distinct.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(build, HISTORY), "digest-history")


def look_up(history: DataFrame, distinct: DataFrame) -> DataFrame:
    """The distinct digests of an arrival, and the history's: one row for each digest of either.

    digest, keep_id, group_size, member (the history knows it). Members keep the history's
    winner, whatever their own doc_ids; their rows add to its count. Nonmembers are groups of
    their own and keep their smallest doc_id. Against an empty history all are nonmembers and are not gathered.
    """
    first = history.select("shards").first()
    if first is None:
        return distinct.select("digest", F.col("winner").alias("keep_id"), F.col("n_rows").alias("group_size"), F.lit(False).alias("member"))
    shards = first["shards"]

    def search(slots: pd.DataFrame, arrived: pd.DataFrame) -> pd.DataFrame:
        asked = _matrix(arrived["digest"])
        own = pd.DataFrame({"digest": arrived["digest"], "keep_id": arrived["winner"].astype("Int64"), "group_size": arrived["n_rows"], "member": False})
        if not len(slots):
            return own
        row = slots.iloc[0]
        bits = np.unpackbits(np.frombuffer(row["bits"], dtype="u1"), count=int(sum(row["levels"]))).astype(bool)
        stored = np.frombuffer(row["digests"], dtype="u1").reshape(-1, DIGEST_BYTES)
        n = len(stored)
        winners = pd.array(np.frombuffer(row["winners"], dtype="<i8", count=n), dtype="Int64")
        winners[np.frombuffer(row["winners"], dtype="u1", offset=8 * n) == 0] = pd.NA
        sizes = np.frombuffer(row["n_rows"], dtype="<i8").copy()
        at = PerfectHash([int(x) for x in row["levels"]], bits).slots(asked)
        member = (at >= 0) & (stored[np.maximum(at, 0)] == asked).all(axis=1)
        sizes[at[member]] += arrived["n_rows"].to_numpy()[member]
        known = pd.DataFrame({"digest": [x.tobytes() for x in stored], "keep_id": winners, "group_size": sizes, "member": True})
        return pd.concat([known, own[~member]], ignore_index=True)

    arrived = distinct.withColumn("shard", _shard(shards))
    pairs = history.groupBy("shard").cogroup(arrived.groupBy("shard"))
    return pairs.applyInPandas(search, "digest binary, keep_id bigint, group_size bigint, member boolean")


def group_rows(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, digest.

    The lower half of the range of doc_ids is the history, the rest arrives after it; so the
    history's winner is always the smallest doc_id. NULL doc_ids arrive last and stay only if
    no other row has the text. Of rows that repeat both doc_id and text one is kept. Texts are
    whole, NULL counts as empty; other columns are not looked at. No rows give no rows.
    """
    rows = written(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), digest(docs).alias("digest")), "digests")
    span = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n")).first()
    cut = ((span["low"] or 0) + (span["high"] or 0)) // 2 + 1
    earlier, later = rows.filter(F.col("doc_id") < cut), rows.filter((F.col("doc_id") >= cut) | F.col("doc_id").isNull())
    arrived = written(distinct_digests(later), "arrived-digests")
    history = build_history(distinct_digests(earlier), arrivals=arrived.count())
    classes = written(look_up(history, arrived).drop("member"), "digest-classes")
    copies = rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies"))
    of_class = by_hot_key(copies, classes, "digest", "group_size", span["n"])
    each = of_class.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return each.select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "digest"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that stay: one of each group of equal texts.

    As for `group_rows`: NULL and empty texts are one group, of rows that repeat doc_id and text the first in the order
    of their other columns stays; columns may have any names; no rows give no rows.
    """
    key, own = unused(docs, "text_digest"), unused(docs, "stays")
    groups = group_rows(docs)
    stays = groups.filter("kept").select(F.col("keep_id").alias(own), F.col("digest").alias(key))
    rows = docs.withColumn(key, digest(docs))
    winners = stays.withColumnRenamed(key, f"{key}_")
    kept = rows.join(
        winners, rows["doc_id"].cast("bigint").eqNullSafe(winners[own]) & (rows[key] == winners[f"{key}_"]), "left_semi"
    )
    again = unused(kept, "copy_number")
    order = Window.partitionBy("doc_id", key).orderBy(*[F.col(f"`{c}`").cast("string") for c in docs.columns if c not in ("doc_id", "text")], F.col("text").cast("string"))
    if not groups.filter("NOT kept AND doc_id <=> keep_id").isEmpty():
        kept = kept.withColumn(again, F.row_number().over(order)).filter(F.col(again) == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
