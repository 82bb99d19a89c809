"""The prefix trie of conversations by van Emde Boas recursion.

All sequences of turns are cut at half the largest depth, a power of two. What comes before the cut is named; the upper
trie is made of the sequences up to the cut, and below each name hangs a lower forest of what comes after it.
Upper trie and lower forests are cut in the same way, all of them in one step, until they are one turn deep. A
step is one aggregation over rows (conversation, block of 2^k turns), so a conversation of any length
is dealt over many tasks, and their number is the logarithm of the largest depth.

Names are built from two kinds of digests: the content of a complete block, from those of its halves, and the root below
which a block hangs: of the left half its block's own, of the right half the name of the cut, made of that root and the left
half's content. The name of a turn's node is made of its root and the turn. Equal prefixes have equal names.

Totals go the other way. Every node starts with its own values. In step k the lower forests of 2^k turns are grafted: the totals
of their top nodes are added up for each cut node and given to it and its ancestors in the
upper trie, 2^k nodes on the path of one member. What a node holds after the last step is its subtree's total.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.llm.common import by_hot_key, written
from registra.operators.ranking import global_rank

ROOT = bytes(16)
HEADS = 8  # an own beginning has at most 8 turns


def _digest(*parts: Column) -> Column:
    """16 bytes of SHA-256."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turns(conversations: DataFrame) -> DataFrame:
    """conv, place (from 0), symbol (digest of role and text), size (UTF-8 bytes of the text).

    A conversation's turns are ordered by turn, null first; equal turn numbers by role, then by the digest. NULL role
    and text count as empty. Rows without conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        conversations["conv_id"].cast("bigint").alias("conv"),
        conversations["turn"].cast("bigint").alias("turn"),
        role.alias("role"),
        _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("symbol"),
        F.octet_length(text).cast("bigint").alias("size"),
    ).filter("conv IS NOT NULL")
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("symbol")]
    ranked = written(global_rank(rows, order).select("conv", "rank", "symbol", "size"), "turns")
    starts = written(ranked.groupBy("conv").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")), "turn-starts")
    placed = by_hot_key(ranked, starts, "conv", "n", ranked.count())
    return placed.select("conv", (F.col("rank") - F.col("first")).alias("place"), "symbol", "size")


def rebuilt(sequences: DataFrame, every: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations with the beginning of another, and their lengths (conv, length).

    Conversation c gets the first h turns of conversation c - c % `every`, all if that has fewer and none if it
    does not exist, then its own turns after its first h; h is the crc32 of the decimal c modulo 9.
    """
    counts = written(sequences.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "conversations")
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(HEADS + 1))
    asked = counts.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    bases = counts.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = asked.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = written(convs.select("conv", "n", "h", "base", "taken"), "rebuilt-conversations")
    own = by_hot_key(sequences, convs, "conv", "n", sequences.count()).filter("place >= h")
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "symbol", "size")
    heads = sequences.filter(F.col("place") < HEADS).withColumnRenamed("conv", "base")
    lent = convs.filter("taken > 0").join(heads, "base").filter("place < taken").select("conv", "place", "symbol", "size")
    lengths = convs.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return own.unionByName(lent), lengths


def names(sequences: DataFrame, depth: int) -> DataFrame:
    """The rows (conv, place, symbol) of sequences at most `depth` long with the name of the node that ends there."""
    levels = max(0, depth - 1).bit_length()
    # What complete blocks of 2^k turns hold.
    contents = [sequences.select("conv", F.col("place").alias("block"), F.col("symbol").alias("content"))]
    for _ in range(levels - 1):
        odd = F.col("block").bitwiseAND(1) == 1
        halves = contents[-1].groupBy("conv", F.shiftright("block", 1).alias("block")).agg(
            F.max(F.when(~odd, F.col("content"))).alias("left"), F.max(F.when(odd, F.col("content"))).alias("right")
        )
        whole = halves.filter("left IS NOT NULL AND right IS NOT NULL")
        contents.append(written(whole.select("conv", "block", _digest(F.lit(b"b"), F.col("left"), F.col("right")).alias("content")), "contents"))
    # The roots of blocks, from the largest down; a conversation's first blocks hang below the root.
    roots = None
    for k in range(levels - 1, -1, -1):
        kinds = {"root": "binary", "left": "binary", "has_right": "boolean"}

        def part(rows: DataFrame, block: Column, **given: Column) -> DataFrame:
            return rows.select("conv", block.alias("block"), *[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in kinds.items()])  # noqa: B023

        place = F.col("place")
        right = sequences.filter(place % (2 << k) == 1 << k)
        parts = part(right, F.shiftright(place, k + 1), has_right=F.lit(True))
        lefts = contents[k].filter(F.col("block").bitwiseAND(1) == 0)
        parts = parts.unionByName(part(lefts, F.shiftright("block", 1), left=F.col("content")))
        if roots is not None:
            parts = parts.unionByName(part(roots, F.col("block"), root=F.col("root")))
        met = parts.groupBy("conv", "block").agg(*[F.max(n).alias(n) for n in kinds])
        cut = _digest(F.lit(b"n"), F.coalesce("root", F.lit(ROOT)), F.col("left"))
        both = F.array(
            F.struct((F.col("block") * 2).alias("block"), F.col("root").alias("root")),
            F.struct((F.col("block") * 2 + 1).alias("block"), F.when(F.col("has_right"), cut).alias("root")),
        )
        roots = written(met.select("conv", F.explode(both).alias("half")).select("conv", "half.*").filter("root IS NOT NULL"), "roots")
    rows = sequences
    if roots is not None:
        rows = rows.join(roots.withColumnRenamed("block", "place"), ["conv", "place"], "left")
    else:
        rows = rows.withColumn("root", F.lit(None).cast("binary"))
    return rows.select("conv", "place", "size", _digest(F.lit(b"n"), F.coalesce("root", F.lit(ROOT)), F.col("symbol")).alias("name"))


def graft(nodes: DataFrame, paths: DataFrame, depth: int, values: list[str]) -> DataFrame:
    """rep, place and the sums of `values` over the subtree of every node.

    `nodes` has rep, place, parent_rep and the node's own values; `paths` (conv, place, rep, parent_rep) the node that each
    conversation passes at each place.
    """
    key = ["rep", "place", "parent_rep"]
    parts = [nodes.select(*key, *values)]
    for k in range(max(0, depth - 1).bit_length()):
        tops = [p.filter(F.col("place") % (2 << k) == 1 << k) for p in parts]
        lower = tops[0]
        for more in tops[1:]:
            lower = lower.unionByName(more)
        cut = lower.groupBy(F.col("parent_rep").alias("conv"), F.col("place").alias("below")).agg(*[F.sum(v).alias(v) for v in values])
        above = cut.withColumn("place", F.explode(F.sequence(F.col("below") - (1 << k), F.col("below") - 1))).drop("below")
        given = above.join(paths, ["conv", "place"]).groupBy(*key).agg(*[F.sum(v).alias(v) for v in values])
        parts.append(written(given, "grafted"))
    total = parts[0]
    for more in parts[1:]:
        total = total.unionByName(more)
    return total.groupBy("rep", "place").agg(*[F.sum(v).alias(v) for v in values])


def joined_hashes(rows: DataFrame) -> DataFrame:
    """rep, place, ends_sha256: SHA-256 of the decimal conv of all rows (rep, place, conv) of a node, ascending, joined by commas.

    Rows are sorted by range, each task joins its stretch of a node in pieces of an Arrow batch, and only these
    pieces meet, in order, in the task that hashes them one after the other.
    """
    keys = ["rep", "place"]

    def breaks(batch: pa.RecordBatch) -> list[int]:
        rep, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        new = np.flatnonzero((rep[1:] != rep[:-1]) | (place[1:] != place[:-1])) + 1
        return [0, *new.tolist(), batch.num_rows]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, convs = breaks(batch), batch.column(2).to_pylist()
                joined = [",".join(map(str, convs[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]
                first = pa.array(at[:-1])
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(first) for i in range(3)), pa.array(joined, pa.string())], names=[*keys, "conv", "part"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for rep, place, part in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (rep, place) == node:
                    state.update(b",")
                else:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (rep, place), hashlib.sha256()
                state.update(part.encode())
            yield _rows(done)
        if node:
            yield _rows([(*node, state.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], kind) for i, kind in enumerate(kinds)], names=[*keys, "ends_sha256"])

    placed = rows.select(*keys, "conv").repartitionByRange(*keys, "conv").sortWithinPartitions(*keys, "conv")
    pieces = placed.mapInArrow(join, "rep bigint, place bigint, conv bigint, part string")
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "conv").mapInArrow(digest, "rep bigint, place bigint, ends_sha256 string")


def prefix_trie(sequences: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `sequences` has conv, place (from 0, without gaps), symbol and size, `lengths` conv and length, 0 for a member of the root
    alone. Equal sequences share all their nodes. Without any conversation there is no node.
    """
    sequences, lengths = written(sequences, "sequences"), written(lengths, "lengths")
    seen = lengths.agg(F.max("length").alias("depth"), F.min("conv").alias("least"), F.count(F.lit(1)).alias("n"), F.sum("length").alias("rows")).first()
    depth = seen["depth"] or 0
    named = written(names(sequences, depth), "names")
    reps = named.groupBy("name").agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"))
    met = by_hot_key(named, written(reps, "reps"), "name", "n_convs", max(1, seen["rows"] or 0))
    met = written(met.select("conv", "place", "size", "rep", "n_convs"), "members")
    before = met.select("conv", (F.col("place") + 1).alias("place"), F.col("rep").alias("parent_rep"))
    paths = met.join(before, ["conv", "place"], "left").withColumn("parent_rep", F.coalesce("parent_rep", F.lit(seen["least"]).cast("bigint")))
    paths = written(paths, "paths")
    nodes = paths.filter("conv = rep").select("rep", "place", "parent_rep", "n_convs", "size")
    children = nodes.groupBy(F.col("parent_rep").alias("rep"), (F.col("place") - 1).alias("place")).agg(F.count(F.lit(1)).alias("n_children"))
    saved = (F.col("n_convs") - 1) * F.col("size")
    nodes = nodes.join(children, ["rep", "place"], "left").na.fill(0, ["n_children"])
    own = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("bigint")).withColumn("saved_tokens", saved)
    own = written(own, "nodes")
    totals = graft(own, paths.select("conv", "place", "rep", "parent_rep"), depth, ["n_leaves", "saved_tokens"])
    least = F.lit(seen["least"]).cast("bigint")
    top = own.agg(
        F.count_if(F.col("place") == 0).alias("n_children"),
        F.greatest(F.coalesce(F.sum("n_leaves"), F.lit(0)), F.lit(1)).cast("bigint").alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).cast("bigint").alias("saved_tokens"),
    ).filter(F.lit(seen["n"] > 0))
    top = top.select(least.alias("rep"), F.lit(-1).cast("bigint").alias("place"), F.lit(None).cast("bigint").alias("parent_rep"), F.lit(seen["n"]).cast("bigint").alias("n_convs"), "n_children", "n_leaves", "saved_tokens")
    below = own.drop("n_leaves", "saved_tokens").join(totals, ["rep", "place"])
    every = below.select(*top.columns).unionByName(top)
    # A conversation ends at its last place, a turnless one at the root.
    ends = lengths.withColumn("place", F.col("length") - 1).join(paths.select("conv", "place", "rep"), ["conv", "place"], "left")
    hashes = joined_hashes(ends.select(F.coalesce("rep", least).alias("rep"), "place", "conv"))
    return every.join(hashes, ["rep", "place"], "left").select(
        F.col("rep").alias("conv_id"),
        (F.col("place") + 1).alias("depth"),
        F.col("parent_rep").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of rebuilt conversations: `turns`, `rebuilt`, then `prefix_trie`; other columns are not looked at.

    Repeated rows are turns of their own. A table without conversations gives no rows.
    """
    sequences, lengths = rebuilt(written(turns(conversations), "placed-turns"))
    return prefix_trie(sequences, lengths)
