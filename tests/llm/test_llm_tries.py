"""The conversation trie against one kept in dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from registra.llm import tries
from registra.llm.queries import ORACLES, op13_conversation_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CLASHING = "conv, place, symbol, size, name, rep, root, n, h, block, content, rank, first, depth, parent_rep, n_convs"


def plain_trie(rows):
    """Every node with its members, in plain Python."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [(role, text) for _, role, text in sorted(found, key=lambda t: (t[0], t[1], symbol(t[1], t[2])))] for c, found in own.items()}
    built = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(turns.get(base, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, sequence in built.items():
        for d in range(len(sequence) + 1):
            members[sequence[:d]].append(c)
    out = {}
    for node, convs in members.items():
        inside = [x for x in members if x[: len(node)] == node]
        ends = sorted(c for c in convs if len(built[c]) == len(node))
        out[min(convs), len(node)] = (
            min(members[node[:-1]]) if node else None,
            len(convs),
            sum(len(x) == len(node) + 1 for x in inside),
            sum(not any(len(y) == len(x) + 1 and y[:-1] == x for y in inside) for x in inside),
            sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in inside if x),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return out


def symbol(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def as_dict(frame):
    rows = frame.collect()
    found = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in rows}
    assert len(found) == len(rows)
    return found


def conversations(seed, n, depth, words):
    rng = random.Random(seed)
    rows = []
    for c in range(-4, n):
        length = rng.randint(0, depth)
        same = rng.random() < 0.5
        for turn in range(length):
            text = f"turn {turn}" if same else rng.choice(words)
            rows.append((c, turn * 2, rng.choice(["user", None]) if rng.random() < 0.1 else "user", text))
    rng.shuffle(rows)
    return rows


AWKWARD = [
    *[(None, 0, "user", "nobody's"), (3, None, None, None), (3, None, "user", "first"), (3, 1, "user", "é\U0001f600"), (3, 1, "user", "é\U0001f600")],
    *[(5, 0, "user", "a"), (5, 1, "assistant", "b"), (6, 0, "user", "a"), (6, 1, "assistant", "b"), (6, 2, "user", ""), (8, 0, None, None)],
    *[(10, t, "user", "x") for t in range(70)],  # one conversation with most of the rows
    *[(11, t, "user", "x") for t in range(70)],
    *[(12, t, "user", "x" if t < 40 else "y") for t in range(64)],
    *[(100 + c, t, "user", f"common {t}") for c in range(60) for t in range(10)],
]


@pytest.mark.parametrize("rows", [AWKWARD, conversations(1, 90, 12, ["a", "b", "ccc"]), conversations(2, 60, 3, ["", "ü"])])
def test_trie_equals_plain_trie(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert as_dict(tries.conversation_trie(frame)) == plain_trie(rows)


def test_clashing_columns_and_short_conversations(spark):
    rows = [(c, 0, "user", "hi") for c in (1, 2, 4, 7)]
    names = CLASHING.split(", ")
    frame = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], SCHEMA + "".join(f", {n} string" for n in names))
    assert as_dict(tries.conversation_trie(frame)) == plain_trie(rows)


def test_no_conversations(spark):
    assert tries.conversation_trie(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)).collect() == []
    assert tries.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_agrees_with_sql(spark):
    from checks.compare import normal_form, oracle_rows

    folder = "/root/testdata/sf0.001"
    frame = op13_conversation_trie(spark, folder)
    names, theirs = oracle_rows(folder, ORACLES["op13_conversation_trie"])
    assert sorted(names) == sorted(frame.columns)
    assert normal_form(frame.columns, frame.collect()) == normal_form(names, theirs)
