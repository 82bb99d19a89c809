"""Near duplicates: ProbMinHash signatures of weighted word shingles, banding, verification.

A document is the set of its shingles of five words (fewer words: one shingle of all), each
weighted 1 + ln(times it occurs). Likeness of two documents is the probability Jaccard
similarity of these weights,

    J = sum over common shingles d of 1 / sum over all shingles e of max(a_e / a_d, b_e / b_d),

the plain Jaccard similarity where no shingle repeats. Documents of one word sequence are one
node from the start. Two nodes that share a band of their signatures are a candidate pair; pairs
of likeness 0.8 or more are links, and classes are the components of the links.
With 32 bands of 4 a pair at 0.8 shares none with probability 5e-8.

Not all pairs of a bucket are compared, and none is lost. Let a and b weigh t and t', and their common shingles
u in a and v in b. The sum below a common d is at least (t - u) / a_d + t' / b_d, so its term is at most
a_d b_d / ((t - u) b_d + t' a_d), which is concave and homogeneous: the terms add up to no more than the same of u and v,

    J <= 1 / (t / u + t' / v - 1).

A shingle that no other node of a crowded bucket has cannot be common. With k the number of a node's other
shingles and x what these weigh beyond 1 each, u <= min(k, k') + x and v <= min(k, k') + x'.

Nodes for which no member of their bucket can reach 0.8 leave it. The rest are compared with a
centre, the member that shares most; what ends in one component needs no more comparison.
In buckets that still hold several components, the pairs that the bound allows are compared within tasks, in
blocks of about 256 by 256 members, each pair in its first common bucket, and only links leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.llm.common import by_hot_key, give_back, map_texts, mix64, parts, unused, whole_text, written
from registra.llm.components import components

WORDS = 5
THRESHOLD = 0.8
REGISTERS, ROWS = 128, 4
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
PER_SALT = BLOCK = 256
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


class _WordHashes(dict):
    """64-bit hashes of words; past about `memory` bytes the memory starts anew."""

    memory, used = 32_000_000, 0

    def __missing__(self, word: str) -> int:
        if self.used >= self.memory:
            self.clear()
            self.used = 0
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode())
        self.used += 180 + len(word)
        return value


_hashes = _WordHashes()


def shingles(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a text in ascending order, and how often each occurs."""
    if not words:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    hashes = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    total = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        total += mix64(hashes[i : i + n]) * _ODD[i]
    return np.unique(mix64(total), return_counts=True)


def weights(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts)


def signatures(elements: np.ndarray, doc: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
    """ProbMinHash of many documents at once: the winning element of each register, 0 for none.

    Each element is a Poisson process whose rate is its weight. An arrival falls on a random
    register, which keeps the earliest. In every round all elements still running have
    one arrival more; an element ends as soon as it comes later than every register of its
    document holds, since no later arrival could win.
    """
    times = np.full((docs, REGISTERS), np.inf)
    winners = np.zeros((docs, REGISTERS), dtype=np.uint64)
    flat_times, flat_winners = times.reshape(-1), winners.reshape(-1)
    clock, step = np.zeros(len(elements)), 0
    latest = np.full(docs, np.inf)
    while len(elements):
        step += 1
        noise = mix64(elements + np.uint64(step * int(GOLDEN) & 0xFFFFFFFFFFFFFFFF))
        clock = clock - np.log(((noise >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        running = clock < latest[doc]
        elements, doc, weight, clock, noise = elements[running], doc[running], weight[running], clock[running], noise[running]
        at = doc * REGISTERS + (mix64(noise ^ GOLDEN) % np.uint64(REGISTERS)).astype(np.int64)
        wins = np.flatnonzero(clock < flat_times[at])
        wins = wins[np.argsort(-clock[wins], kind="stable")]  # of several, the earliest is written last
        flat_times[at[wins]] = clock[wins]
        flat_winners[at[wins]] = elements[wins]
        touched = np.unique(doc)
        latest[touched] = times[touched].max(axis=1)
    return winners


def bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    n = signature.shape[1] // ROWS
    grouped = mix64(signature).reshape(len(signature), n, ROWS)
    keys = np.zeros(grouped.shape[:2], dtype=np.uint64)
    for i in range(ROWS):
        keys += grouped[:, :, i] * _ODD[i]
    return mix64(keys ^ (GOLDEN * np.arange(1, n + 1, dtype=np.uint64))).view(np.int64)


def likeness(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets (ascending distinct elements); 1 for two empty sets.

    For a common element of ratio r = wa / wb, elements of ratio r or more count by wa and the
    others by wb; sorted by ratio, both sums are prefixes. Where all common elements weigh the same
    in both, this is the common weight over the weight of the union.
    """
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    xa, xb = wa[ia], wb[ib]
    if (xa == xb).all():
        shared = xa.sum()
        return float(shared / (wa.sum() + wb.sum() - shared))
    only_a = wa.sum() - xa.sum()
    only_b = wb.sum() - xb.sum()
    ratio = xa / xb
    order = np.argsort(ratio, kind="stable")
    xa, xb, ratio = xa[order], xb[order], ratio[order]
    first = np.searchsorted(ratio, ratio, "left")
    above = only_a + xa.sum() - np.concatenate([[0.0], np.cumsum(xa)])[first]
    below = only_b + np.concatenate([[0.0], np.cumsum(xb)])[first]
    return float((1.0 / (above / xa + below / xb)).sum())


def _node(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode())


def _text_key(docs: DataFrame) -> Column:
    return F.xxhash64(whole_text(docs))


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, node (a 128-bit hash of the word sequence), bands (none for a text without words)."""

    def work(texts: list[str]) -> Iterator[tuple]:
        nodes, elements, heavy = [], [], []
        for text in texts:
            words = text.split()
            nodes.append(_node(words))
            found, counts = shingles(words)
            elements.append(found)
            heavy.append(weights(counts))
        doc = np.repeat(np.arange(len(texts)), [len(x) for x in elements])
        keys = bands(signatures(np.concatenate(elements), doc, np.concatenate(heavy), len(texts)))
        for node, found, key in zip(nodes, elements, keys, strict=True):
            yield node, key.tolist() if len(found) else []

    return map_texts(
        docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), _text_key(docs).alias("text_key"), whole_text(docs).alias("text")),
        work,
        [("node", pa.binary()), ("bands", pa.list_(pa.int64()))],
        "node binary, bands array<bigint>",
        chars=1_500_000,
    )


def shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """id, hashes, counts, size (number of shingles), total (all weight) and bands of the texts that stand for `nodes`
    (id, node, rep: the doc_id, and rep_key: the text key of one row, bands).

    Rows that share a doc_id, or have none, meet a node only if their text has its key, so each meets one, but for equal hashes.
    """
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), _text_key(docs).alias("text_key"), whole_text(docs).alias("text"))
    same = (texts["text_key"] == nodes["rep_key"]) & texts["doc_id"].eqNullSafe(nodes["rep"])
    rows = texts.join(nodes, same).select("id", "node", "bands", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.float64(), pa.binary())
        for batch in batches:
            for part in parts(batch, 3, 2_000_000):
                made = []
                for key, node, keys, text in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                    words = text.split()
                    if _node(words) == node:  # keys of different texts may be equal
                        hashes, counts = shingles(words)
                        own = np.array(keys, dtype=np.int64).tobytes()
                        made.append((key, hashes.tobytes(), counts.astype("<u4").tobytes(), len(hashes), float(weights(counts).sum()), own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in made], kind) for i, kind in enumerate(kinds)], names=["id", "hashes", "counts", "size", "total", "bands"]
                )
        give_back()

    return rows.mapInArrow(work, "id bigint, hashes binary, counts binary, size bigint, total double, bands binary").dropDuplicates(["id"])


def own_weight(sets: DataFrame) -> DataFrame:
    """id, own and own_more: the number of the shingles that no other of the sets has, and what they weigh beyond 1 each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 1, 2_000_000):
                hashes = [np.frombuffer(x, dtype=np.int64) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "shingle": pa.array(np.concatenate(hashes)),
                        "id": pa.array(np.repeat(part.column(0).to_numpy(), [len(x) for x in hashes])),
                        "times": pa.array(np.concatenate([np.frombuffer(x, dtype="<u4") for x in part.column(2).to_pylist()]).astype(np.int64)),
                    }
                )

    each = sets.select("id", "hashes", "counts").mapInArrow(work, "shingle bigint, id bigint, times bigint")
    alone = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("id"), F.max("times").alias("times"))
    return alone.filter("n = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own"), F.sum(F.ln("times")).alias("own_more"))


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """center, id, likeness of distinct pairs (center, id, n).

    Many pairs may share a centre: they are dealt over one salt per 256 members of its largest bucket,
    n, and the centre's shingles are copied to each of them.
    """
    salts = lambda n: F.ceil(F.col(n) / PER_SALT).cast("bigint")
    sets = sets.select("id", "hashes", "counts")
    own = pairs.withColumn("salt", F.pmod(F.xxhash64("id"), salts("n"))).join(sets, "id")
    centers = pairs.groupBy("center").agg(F.max("n").alias("most"))
    copies = (
        sets.select(F.col("id").alias("center"), F.col("hashes").alias("c_hashes"), F.col("counts").alias("c_counts"))
        .join(centers, "center")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts("most") - 1)))
        .drop("most")
    )
    both = own.join(copies, ["center", "salt"]).select("center", "id", "hashes", "counts", "c_hashes", "c_counts")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_set = lambda h, c: (np.frombuffer(h, dtype=np.uint64), weights(np.frombuffer(c, dtype="<u4")))
        for batch in batches:
            rows = zip(*(batch.column(i) for i in range(2, 6)), strict=True)
            found = [likeness(*as_set(h.as_py(), c.as_py()), *as_set(ch.as_py(), cc.as_py())) for h, c, ch, cc in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["center", "id", "likeness"])

    return written(both.mapInArrow(work, "center bigint, id bigint, likeness double"), "compared")


def classify(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, class_id, class_size, kept.

    class_id is the smallest doc_id of the class and that document is kept. Texts without
    words are one class. NULL text counts as empty; NULL doc_ids are only a class's id if it has no other;
    rows that repeat a doc_id and text are all marked kept. Other columns are not looked at.
    """
    return _classified(docs).drop("text_key")


def _classified(docs: DataFrame) -> DataFrame:
    """What `classify` gives, and the text key of each row."""
    signed = written(sign(docs), "signatures")
    total = signed.count()
    row = F.struct("doc_id", "text_key")  # of the smallest doc_id, if there is one
    nodes = written(
        signed.groupBy("node")
        .agg(F.min_by(row, F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("row"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
        .select("node", F.col("row.doc_id").alias("rep"), F.col("row.text_key").alias("rep_key"), "copies", "bands")
        .withColumn("id", F.monotonically_increasing_id()),
        "nodes",
    )
    labels = _labels(docs, nodes)
    named = nodes.select("id", "node", "rep", "copies").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    groups = named.groupBy("label").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"))
    classes = written(by_hot_key(named, written(groups.join(named.groupBy("label").agg(F.count(F.lit(1)).alias("n_nodes")), "label"), "classes"), "label", "n_nodes", nodes.count()).select("node", "copies", "class_id", "class_size"), "node-classes")
    rows = by_hot_key(signed.select("doc_id", "text_key", "node"), classes, "node", "copies", total)
    return rows.select("doc_id", "text_key", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def _reachable(t, u, other_t, v):
    """Whether sets of weights t and other_t, of which u and v at most are common, can be 0.8 alike or more."""
    return (u > 0) & (u * v >= (THRESHOLD - 1e-9) * (t * v + other_t * u - u * v))


def _most(common: str, other: str, more: str) -> Column:
    """The most that the shingles common to two nodes can weigh in the one with `more`."""
    return F.least(common, other) + F.col(more)


def _labels(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    members = nodes.select("id", F.explode("bands").alias("bucket"))
    buckets = written(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    # Most members are alone in their bucket and drop out here; Spark splits the rows of a large bucket.
    shared = written(members.join(buckets, "bucket"), "bucket-members")
    wanted = shared.groupBy("id").agg(F.max("n").alias("most"))
    sets = written(shingle_sets(docs, nodes.select("id", "node", "rep", "rep_key", "bands").join(wanted, "id")), "shingles")
    crowded = sets.join(wanted.filter("most > 2").select("id"), "id", "left_semi")
    profile = sets.select("id", "size", "total").join(own_weight(crowded), "id", "left").na.fill(0, ["own", "own_more"])
    # Only members of crowded buckets have been searched for common shingles.
    searched = F.col("n") > 2
    spread = shared.join(profile, "id").select(
        "id",
        "bucket",
        "n",
        "total",
        F.when(searched, F.col("size") - F.col("own")).otherwise(F.col("size")).alias("common"),
        (F.col("total") - F.col("size") - F.when(searched, F.col("own_more")).otherwise(0.0)).alias("more"),
    )
    spread = written(spread, "spread")
    # t' / v is least for the member that weighs least without x', given the greatest x', and is never under 1.
    lows = spread.groupBy("bucket").agg(F.min(F.col("total") - F.col("more")).alias("low"), F.max("more").alias("high"), F.count(F.lit(1)).alias("n"))
    kept = by_hot_key(spread.drop("n"), written(lows, "least"), "bucket", "n", max(1, spread.count()))
    top = F.col("common") + F.col("high")
    spread = written(kept.filter(_reachable(F.col("total"), _most("common", "common", "more"), F.greatest(F.col("low") + F.col("high"), top), top)).drop("low", "high"), "spread")
    # The centre of a bucket is the member that shares most of its weight.
    centers = spread.groupBy("bucket").agg(F.max_by("id", _most("common", "common", "more") / F.col("total")).alias("center"))
    of_center = spread.select("bucket", F.col("id").alias("center"), F.col("total").alias("c_total"), F.col("common").alias("c_common"), F.col("more").alias("c_more"))
    chosen = written(centers.join(of_center, ["bucket", "center"]), "centers")
    fits = _reachable(F.col("total"), _most("common", "c_common", "more"), F.col("c_total"), _most("common", "c_common", "c_more"))
    asked = spread.join(chosen, "bucket").filter(F.col("id") != F.col("center")).filter(fits)
    links = compare(written(asked.groupBy("center", "id").agg(F.max("n").alias("n")), "pairs"), sets).filter(F.col("likeness") >= THRESHOLD)
    links = links.select(F.col("center").alias("a"), F.col("id").alias("b"))
    labels = components(links)
    mixed = _mixed(spread, labels)
    if mixed.isEmpty():
        return labels
    more = written(_rest(mixed, sets), "more-links")
    return labels if more.isEmpty() else components(links.unionByName(more))


def _mixed(spread: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components: low is the bucket's smallest label, n its
    members, strays those of another label."""
    labelled = spread.drop("n").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    labelled = written(labelled, "labelled")
    lows = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"))
    # Of two members one was the centre, so their pair has been decided.
    lows = written(lows.filter("low < high AND n > 2").select("bucket", "low", "n"), "mixed-buckets")
    mixed = written(by_hot_key(labelled, lows, "bucket", "n", max(1, labelled.count())), "mixed")
    strays = mixed.groupBy("bucket").agg(F.count_if(F.col("label") > F.col("low")).alias("strays"), F.count(F.lit(1)).alias("n"))
    return written(by_hot_key(mixed.drop("n"), written(strays, "strays"), "bucket", "n", max(1, mixed.count())), "mixed")


def _rest(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between members of different components of a bucket.

    Strays are dealt over rows of blocks and all members over columns; a block meets in one task.
    """
    rows, columns = (F.ceil(F.col(c) / BLOCK).cast("bigint") for c in ("strays", "n"))
    part = lambda count: F.pmod(F.xxhash64("id"), count)
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1))
    strays = mixed.filter("label > low").withColumn("stray", F.lit(True)).withColumn("i", part(rows)).withColumn("j", every(columns))
    others = mixed.withColumn("stray", F.lit(False)).withColumn("j", part(columns)).withColumn("i", every(rows))
    placed = strays.unionByName(others).select("bucket", "i", "j", "stray", "id", "label", "common", "more").join(sets, "id")

    def search(block: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(block["bands"]), dtype=np.int64).reshape(len(block), -1)
        here = int(np.flatnonzero(keys[0] == block["bucket"].iloc[0])[0])
        found = []
        stray = block["stray"].to_numpy(dtype=bool)
        members = np.flatnonzero(~stray)
        label, common, more, total = (block[c].to_numpy() for c in ("label", "common", "more", "total"))
        as_set = [
            (np.frombuffer(h, dtype=np.uint64), weights(np.frombuffer(c, dtype="<u4"))) for h, c in zip(block["hashes"], block["counts"], strict=True)
        ]
        for x in np.flatnonzero(stray):
            least = np.minimum(common[x], common[members])
            asked = (label[members] < label[x]) & _reachable(total[x], least + more[x], total[members], least + more[members])
            asked &= ~(keys[members][:, :here] == keys[x, :here]).any(axis=1)  # not met in an earlier band
            for y in members[asked]:
                if likeness(*as_set[x], *as_set[y]) >= THRESHOLD:
                    found.append((block["id"].iloc[x], block["id"].iloc[y]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return placed.groupBy("bucket", "i", "j").applyInPandas(search, "a bigint, b bigint")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, whose document is kept of its class.

    Rows are told apart by doc_id and a hash of the text, so rows that share a doc_id, or have none, stay or go each
    with their own class. Rows that repeat both all stay; exact copies are best dropped before. NULL and empty texts
    are one class, as for `classify`; columns may have any names; no rows give no rows.
    """
    own, key = unused(docs, "kept_id"), unused(docs, "kept_key")
    kept = _classified(docs).filter("kept").select(F.col("doc_id").alias(own), F.col("text_key").alias(key)).distinct()
    same = (_text_key(docs) == kept[key]) & docs["doc_id"].cast("bigint").eqNullSafe(kept[own])
    return docs.join(kept, same, "left_semi")
