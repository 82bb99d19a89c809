import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
from edge_tables import ROWS, SCHEMA, documents
from pyspark.sql import functions as F

from registra.llm import exact, near
from registra.llm.components import components


def sha(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).digest()


def test_perfect_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 3, 100, 5000):
        digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), dtype="u1").reshape(-1, 32)
        slots = exact.PerfectHash.of(digests).slots(digests)
        assert sorted(slots.tolist()) == list(range(n))


def test_equal_digests_are_refused():
    one = np.frombuffer(hashlib.sha256(b"x").digest() * 2, dtype="u1").reshape(2, 32)
    with pytest.raises(ValueError, match="not distinct"):
        exact.PerfectHash.of(one)


def expected_groups(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(sha(text), []).append(doc_id)
    out = []
    for digest, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        marked = False
        for i in sorted(ids, key=lambda x: (x is None, x or 0)):
            stays = i == keep and not marked
            marked |= stays
            out.append((i, keep, len(ids), stays, digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("clashing", [False, True])
def test_groups_of_equal_texts(spark, clashing):
    found = exact.group_rows(documents(spark, clashing)).collect()
    assert sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in found), key=str) == expected_groups(ROWS)


@pytest.mark.parametrize("clashing", [False, True])
def test_one_row_of_each_group_stays(spark, clashing):
    docs = documents(spark, clashing)
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(sha(r["text"]) for r in rows) == sorted({sha(r[1]) for r in ROWS})
    assert {r["doc_id"] for r in rows} == {1, 3, 5, 6, 7, 8, 9, None}


def test_one_row_stays_of_a_table_of_numbers_and_texts(spark):
    rows = [(1, "same  text"), (1, "same text"), (2, "same text"), (3, "other"), (3, "other"), (None, "none"), (None, "none")]
    kept = exact.drop_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r["doc_id"]), sha(r["text"])) for r in kept) == [("1", sha("same text")), ("3", sha("other")), ("None", sha("none"))]


def test_hot_text_and_random_ids(spark):
    rng = random.Random(4)
    rows = [(rng.randint(-500, 500) if rng.random() < 0.98 else None, rng.choice(["hot", "hot", f"t {rng.randint(0, 200)}"]), "en", "s", 0) for _ in range(3000)]
    found = exact.group_rows(documents(spark, rows=rows)).collect()
    assert sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in found), key=str) == expected_groups(rows)


def test_history_answers_for_members_only(spark):
    history = exact.build_history(spark.createDataFrame([(bytearray(sha(str(i))), i, 1) for i in range(500)], "digest binary, winner bigint, n_rows bigint"), per_shard=40)
    asked = spark.createDataFrame([(bytearray(sha(str(i))), 1000 + i, 2) for i in range(450, 600)], "digest binary, winner bigint, n_rows bigint")
    found = {bytes(r["digest"]): (r["keep_id"], r["group_size"], r["member"]) for r in exact.look_up(history, asked).collect()}
    assert found == {sha(str(i)): (i, 3 if i >= 450 else 1, True) for i in range(500)} | {sha(str(i)): (1000 + i, 2, False) for i in range(500, 600)}


def test_no_documents_no_groups(spark):
    assert exact.group_rows(documents(spark, rows=[])).count() == 0
    assert exact.drop_copies(documents(spark, rows=[])).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(7, 7)]
    found = {r["id"]: r["label"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 130), 100) | dict.fromkeys(range(200, 209), 200)


def weighted(text):
    words = text.split()
    if not words:
        return {}
    width = min(5, len(words))
    counts = {}
    for i in range(len(words) - width + 1):
        key = tuple(words[i : i + width])
        counts[key] = counts.get(key, 0) + 1
    return {k: 1 + np.log(v) for k, v in counts.items()}


def plain_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    every = a.keys() | b.keys()
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in every) for d in a.keys() & b.keys())


def test_likeness_equals_its_definition():
    rng = random.Random(6)
    for _ in range(60):
        x = [rng.choice("abc") for _ in range(rng.randint(1, 30))]
        y = x[: rng.randint(0, len(x))] + [rng.choice("abc") for _ in range(rng.randint(1, 12))]
        a, b = " ".join(x), " ".join(y)
        (ea, ca), (eb, cb) = near.shingles(x), near.shingles(y)
        assert near.likeness(ea, near.weights(ca), eb, near.weights(cb)) == pytest.approx(plain_likeness(weighted(a), weighted(b)))


def test_registers_agree_as_often_as_the_likeness_says():
    rng = np.random.default_rng(1)
    agreed, wanted = [], []
    for _ in range(40):
        shared = rng.integers(1, 2**63, 60).astype(np.uint64)
        a, b = np.unique(np.append(shared, rng.integers(1, 2**63, 15).astype(np.uint64))), np.unique(np.append(shared, rng.integers(1, 2**63, 10).astype(np.uint64)))
        wa, wb = rng.uniform(1, 4, len(a)), rng.uniform(1, 4, len(b))
        both = near.signatures(np.append(a, b), np.repeat([0, 1], [len(a), len(b)]), np.append(wa, wb), 2)
        agreed.append((both[0] == both[1]).mean())
        wanted.append(near.likeness(a, wa, b, wb))
    assert np.mean(agreed) == pytest.approx(np.mean(wanted), abs=0.02)
    assert np.corrcoef(agreed, wanted)[0, 1] > 0.5


def at_most(a, b):
    """A quick upper bound of the likeness: a term is no more than either share of its shingle."""
    every, other = sum(a.values()), sum(b.values())
    return sum(min(w / every, b[d] / other) for d, w in a.items() if d in b) if a and b else 1.0


def brute_classes(rows):
    """Class of every row by comparing all pairs of texts."""
    sets = [weighted(r[1] or "") for r in rows]
    label = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if label[i] != label[j] and at_most(sets[i], sets[j]) >= 0.79 and plain_likeness(sets[i], sets[j]) >= 0.8:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
    smallest, size = {}, {}
    for row, x in zip(rows, label, strict=True):
        size[x] = size.get(x, 0) + 1
        if row[0] is not None:
            smallest[x] = min(row[0], smallest.get(x, row[0]))
    return sorted(((r[0], smallest.get(x), size[x], r[0] == smallest.get(x)) for r, x in zip(rows, label, strict=True)), key=str)


def near_rows(seed=8):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(12):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(40, 120))]
        for _ in range(rng.randint(1, 12)):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**6)}"
            rows.append((n, " ".join(words), "en", "s", 0))
            n += 1
    return rows


def test_classes_equal_brute_force(spark):
    rows = near_rows() + [(500 + i, r[1], "en", "s", 0) for i, r in enumerate(near_rows()[:20])]
    found = near.classify(documents(spark, rows=rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_classes(rows)


def hub_rows():
    """Many edits of one text: few are near the base, the rest near nothing; and texts that share half."""
    rng, rows = random.Random(40), []
    base = [f"b{i}" for i in range(146)]
    for n in range(70):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 8])):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
        rows.append((n, " ".join(words), "en", "s", 0))
    for n in range(0, 70, 7):  # a near copy that stands in no crowded bucket with the rest
        long = f"{rows[n][1]} " + " ".join(f"tail{n}x{i}" for i in range(900))
        rows += [(200 + n, long, "en", "s", 0), (201 + n, long.replace(f"tail{n}x450", "changed"), "en", "s", 0)]
    for n in range(40):
        rows.append((100 + n, " ".join(base[:30] + [f"o{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 30))]), "en", "s", 0))
    return rows


def test_crowded_buckets_lose_no_link(spark):
    rows = hub_rows()
    assert sorted((tuple(r) for r in near.classify(documents(spark, rows=rows)).collect()), key=str) == brute_classes(rows)


def repeated_rows():
    """Texts of one set of shingles, or nearly, that differ in how often a part of them occurs."""
    rng, rows = random.Random(50), []
    for n in range(6):
        first, second = ([f"{c}{n}x{i}" for i in range(rng.randint(12, 30))] for c in "pq")
        for _ in range(14):
            words = first * rng.choice([1, 2, 3, 8, 20, 60]) + second * rng.choice([1, 2, 3, 8, 20, 60])
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(words), "en", "s", 0))
    return rows


def test_how_often_a_shingle_occurs_counts(spark):
    base, more = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    rows = [(0, " ".join(base + more), "en", "s", 0), (1, " ".join(base * 40 + more), "en", "s", 0), (2, " ".join(base * 41 + more), "en", "s", 0)]
    found = {r["doc_id"]: r["class_id"] for r in near.classify(documents(spark, rows=rows)).collect()}
    assert found == {0: 0, 1: 1, 2: 1}


def test_repeated_shingles_equal_brute_force(spark):
    rows = repeated_rows()
    wanted = brute_classes(rows)
    assert 12 < len({r[1] for r in wanted}) < 70
    assert sorted((tuple(r) for r in near.classify(documents(spark, rows=rows)).collect()), key=str) == wanted


def test_bound_holds_for_unequal_weights():
    rng = np.random.default_rng(3)
    for _ in range(2000):
        a, b = (np.flatnonzero(rng.random(12) < rng.uniform(0.6, 1)).astype(np.uint64) for _ in range(2))
        wa, wb = (near.weights(np.ceil(rng.exponential(rng.choice([0.5, 3, 30]), len(x)))) for x in (a, b))
        k = len(np.intersect1d(a, b))
        more = [(w[np.isin(x, y)] - 1).sum() for x, w, y in ((a, wa, b), (b, wb, a))]
        if near.likeness(a, wa, b, wb) >= 0.8:
            assert near._reachable(wa.sum(), k + more[0], wb.sum(), k + more[1])


@pytest.mark.parametrize("clashing", [False, True])
def test_awkward_documents(spark, clashing):
    docs = documents(spark, clashing)
    assert sorted((tuple(r) for r in near.classify(docs).collect()), key=str) == brute_classes(ROWS)
    kept = near.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {1, 3, 6, 7, 8, 9, None}


def test_rows_of_one_number_or_none_go_with_their_own_class(spark):
    base = [f"w{i}" for i in range(60)]
    near_copy = lambda n: " ".join([*base[:-1], f"end{n}"])
    rows = [(1, " ".join(base)), (None, near_copy(1)), (None, "stands alone without a number"), (5, near_copy(2)), (5, "stands alone under a number used twice")]
    docs = documents(spark, rows=[(*r, "en", "s", 0) for r in rows])
    assert {(r["doc_id"], r["text"]) for r in near.drop_near_copies(docs).collect()} == {rows[0], rows[2], rows[4]}


def test_no_documents_no_classes(spark):
    assert near.classify(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("number", [7, None])
def test_many_rows_of_one_number_meet_once_each(spark, number):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randint(0, 9999)}" for _ in range(30)) for _ in range(700)]
    texts += [t.rsplit(" ", 1)[0] + " changed" for t in texts]  # every text has a near copy, so all are looked up
    rows = [(number, t, "en", "s", 0) for t in texts]
    docs = documents(spark, rows=rows)
    signed = near.sign(docs)
    nodes = signed.select(F.monotonically_increasing_id().alias("id"), "node", F.col("doc_id").alias("rep"), F.col("text_key").alias("rep_key"), F.array().cast("array<bigint>").alias("bands"))
    sets = near.shingle_sets(docs, nodes)
    metrics = sets._jdf.queryExecution().executedPlan()
    assert sets.count() == len(rows) and "NestedLoop" not in metrics.toString()
    found = near.classify(docs).collect()
    assert {r["class_size"] for r in found} == {2} and {r["class_id"] for r in found} == {number}


def test_shards_follow_the_arrivals_too(spark):
    """One outlying id leaves nearly all rows to the arrivals."""
    rows = [(-(10**12), "the outlier", "en", "s", 0)] + [(i, f"text {i % 5000}", "en", "s", 0) for i in range(6000)]
    found = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.group_rows(documents(spark, rows=rows)).collect()}
    assert found == {(-(10**12), -(10**12), 1, True)} | {(i, i % 5000, 1 + (i % 5000 < 1000), i < 5000) for i in range(6000)}
    first = documents(spark, rows=rows[:1])
    history = exact.build_history(exact.distinct_digests(first.select("doc_id", exact.digest(first).alias("digest"))), per_shard=100, arrivals=5000)
    assert history.first()["shards"] == 50


def test_op4_agrees_with_sql(spark):
    from checks.compare import normal_form, oracle_rows
    from registra.llm.queries import ORACLES, op4_exact_dedup

    folder = "/root/testdata/sf0.001"
    frame = op4_exact_dedup(spark, folder)
    names, theirs = oracle_rows(folder, ORACLES["op4_exact_dedup"])
    assert sorted(names) == sorted(frame.columns)
    assert normal_form(frame.columns, frame.collect()) == normal_form(names, theirs)
