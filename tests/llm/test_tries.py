"""The conversation trie against one made of Python dictionaries."""

import hashlib
import random
import zlib

import pytest

from showloom.llm import tries
from showloom.llm.common import stored


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            mark = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:16]
            own.setdefault(c, []).append(((turn is not None, turn or 0, mark), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def plain(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    rows = []
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) or 1
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[q] for q in below)
        ends = ",".join(str(c) for c in sorted(members[p]) if len(convs[c]) == len(p))
        rows.append((
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below), leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, depth long, node binary, marks string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, b"n", "m") for r in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def dialogues(seed, n=120):
    """Few different turns, so that many conversations begin alike; some are equal as a whole."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        c = c * 5 if c % 7 == 0 else c
        length = rng.choice([1, 2, 3, 5, 9, 14])
        for t in range(length):
            text = rng.choice(["yes", "nö", "", None]) if t < 9 or c % 3 else rng.choice("ab")
            rows.append((c, t, rng.choice(["user", None]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, seed):
    rows = dialogues(seed)
    assert got(tries.conversation_trie(frame(spark, rows).repartition(4))) == plain(rebuilt(rows))


def test_hot_beginnings_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps all ranges, however small
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rng = random.Random(4)
        rows = [(5 * c + 1, t, "user", f"t{t}") for c in range(300) for t in range(12)]  # equal ones
        rows += [(5 * c + 2, t, "user", f"t{t}" if t < 11 else rng.choice("xyz")) for c in range(100) for t in range(14)]
        rows += [(5 * c + 3, 20, "user", rng.choice("pqr")) for c in range(50)] * 2
        rows += [(4, t, "user", f"long{t}") for t in range(3000)]
        assert got(tries.conversation_trie(frame(spark, rows))) == plain(rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_odd_rows(spark):
    rows = [
        (0, 1, "user", "b"), (0, None, None, "first"), (0, 1, "user", "a"), (0, 1, "user", "a"), (3, 5, "", None), (3, None, "x", ""),
        (None, 1, "user", "b"), (11, 0, "user", "é" * 200_000), (7, 0, "us", "er"), (6, 0, "u", "ser"), (8, -3, "user", "b"),
    ]
    assert got(tries.conversation_trie(frame(spark, rows))) == plain(rebuilt(rows))


def test_only_turnless(spark):
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in range(1, 40) if c % 5}
    rows = [(c, 0, "user", "gone") for c, n in h.items() if n]
    assert got(tries.conversation_trie(frame(spark, rows))) == plain(rebuilt(rows))
    assert len(plain(rebuilt(rows))) == 1


def test_empty(spark):
    assert got(tries.conversation_trie(frame(spark, []))) == []


def test_a_conversation_over_many_ranges_is_put_together(spark):
    rows = [(1, t, "user", str(t)) for t in range(500)]
    seqs = stored(tries.sequences(frame(spark, rows).repartition(5)), "s").collect()
    assert len(seqs) == 1 and len(seqs[0].marks) == 500 * 16 and len(seqs[0].sizes) == 500 * 4


def test_common_turns():
    rng = random.Random(1)
    for _ in range(300):
        n, m, k = rng.randrange(40), rng.randrange(40), rng.randrange(40)
        a = b"".join(bytes([i % 3]) * 16 for i in range(n))
        b = a[: k * 16] + b"".join(bytes([9 + i]) * 16 for i in range(m))
        assert tries.common_turns(a, b) == min(k, n)
