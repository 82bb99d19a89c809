"""Periodic runs against a search of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from edge_tables import ROWS, documents

from registra.llm import periodic
from registra.llm.queries import op11_periodic_runs, with_repeats


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def cases(rng):
    def nested(depth):
        if not depth:
            return [rng.choice("abc") for _ in range(rng.randint(1, 4))]
        return nested(depth - 1) * rng.randint(1, 7) + [rng.choice("abcd") for _ in range(rng.randint(0, 2))]

    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    yield list(b)
    yield ["x"] * 500
    yield []
    for _ in range(60):
        yield [rng.choice("ab") for _ in range(rng.randint(0, 90))]
        yield (nested(rng.randint(1, 4))[:300] * rng.randint(1, 4))[rng.randint(0, 9) :]
        unit, around = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 40))], [str(i) for i in range(30)]
        yield around[: rng.randint(0, 30)] + (unit * 7)[: rng.randint(1, 6 * len(unit))] + around[: rng.randint(0, 30)]
        words = [str(rng.randint(0, 400)) for _ in range(rng.randint(1, 300))]
        first, period = rng.randrange(len(words)), 1 + len(words) // rng.randint(3, 12)
        words = [w if i < first else words[min(first + (i - first) % period, len(words) - 1)] for i, w in enumerate(words)]
        if rng.random() < 0.3:
            words[rng.randrange(len(words))] = "other"
        yield words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_a_search_of_every_period(seed):
    texts = list(cases(random.Random(seed)))
    for words, (n, runs, rest) in zip(texts, periodic.find([" ".join(w) for w in texts]), strict=True):
        wanted = plain_runs(words)
        assert (n, runs, rest) == (len(words), wanted, collapsed(words, wanted)), words


def test_successors_equal_a_scan():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 65):
        values = rng.permutation(n)
        matrix = periodic.WaveletMatrix(values)
        low = rng.integers(0, n, 200)
        high, least = np.minimum(n, low + rng.integers(0, n + 1, 200)), rng.integers(0, n + 2, 200)
        wanted = [min((int(v) for v in values[a:b] if v >= c), default=-1) for a, b, c in zip(low, high, least, strict=True)]
        assert matrix.successor(low, high, least).tolist() == wanted


@pytest.mark.parametrize("clashing", [False, True])
def test_awkward_documents(spark, clashing):
    found = periodic.find_runs(documents(spark, clashing)).collect()
    assert sorted((str(r["doc_id"]), r["n_words"]) for r in found) == sorted((str(i), len((t or "").encode().split())) for i, t, *_ in ROWS)
    assert all(r["runs"] == [] for r in found if r["doc_id"] != 6)
    assert periodic.find_runs(documents(spark).limit(0)).collect() == []


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    texts = {i: " \t".join(str(rng.randint(0, 60)) for _ in range(rng.choice([0, 1, 5, 60, 200, 400]))) for i in range(-3, 140)}
    texts[5] = None
    rows = [(i, t, "en", "s", 0) for i, t in texts.items()]
    documents(spark, rows=rows).write.parquet(str(tmp_path / "documents.parquet"))
    edited = {r["doc_id"]: r["text"] for r in with_repeats(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect()}
    seen = 0
    for row in op11_periodic_runs(spark, str(tmp_path)).collect():
        words, h = (texts[row["doc_id"]] or "").encode().split(), zlib.crc32(str(row["doc_id"]).encode())
        words, n, g = [w.decode() for w in words], len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert edited[row["doc_id"]].split() == words
        runs = plain_runs(words)
        seen += len(runs)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (len(runs), *best, milli)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert seen > 3
