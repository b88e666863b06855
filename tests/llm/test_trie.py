"""The prefix trie against one built turn by turn."""

import hashlib
import random
import zlib

import pytest

from strandline.llm.trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def by_walking(rows):
    """Every node of the trie, its subtree summed by recursion."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, children = {}, {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append((c, len(path)))
            if d:
                children.setdefault(path[: d - 1], set()).add(path[:d])

    def summed(p):
        leaves, saved = 0 if children.get(p) else 1, (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        for q in children.get(p, ()):
            more = summed(q)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, n in m if n == len(p)))
        out.append((min(m)[0], len(p), min(members[p[:-1]])[0] if p else None, len(m), len(children.get(p, ())), *summed(p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, parts=3, **how):
    got = prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(parts), **how)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for c, t in got.dtypes if c != "ends_sha256"} == {"bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_walking(rows)


def test_random_conversations(spark):
    rng = random.Random(3)
    rows = []
    for c in [*range(-3, 40), *range(95, 140), *range(300, 330)]:
        if c == 300:
            continue  # a family without its first
        rows += [(c, rng.choice([t, t, None]), rng.choice(["user", "bot", None]), rng.choice(["a", "bb", "ccc 🙂", "", None])) for t in range(rng.randrange(1, 9))]
    check(spark, rows)


def test_ties_repeats_nulls_and_turnless(spark):
    rows = [(0, 0, "u", "x"), (None, 0, "u", "lost"), (7, 1, "u", "same"), (7, 1, "u", "same"), (7, 1, "b", "same"), (7, None, None, None)]
    rows += [(c, 0, "u", "only") for c in range(200, 260)]  # some skip their single turn, and their first has but one
    check(spark, rows)


@pytest.mark.parametrize("hot", ["turns", "first", "whole"])
def test_a_third_of_all_rows_in_one(spark, hot):
    rows = [(c, t, "u", f"{c % 7} {t}") for c in range(1000, 1400) for t in range(3)]
    if hot == "turns":
        rows += [(1000, t, "u", f"t{t}") for t in range(3, 900)]
    elif hot == "first":
        rows += [(c, 0, "u", "hello") for c in range(5000, 5600)] + [(c, 1, "u", str(c)) for c in range(5000, 5600)]
    else:
        rows += [(c, t, "u", f"copied {t}") for c in range(5000, 5200) for t in range(7)]
    check(spark, rows, 8)


def test_empty_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, 0, "u", "x", 5, 6, 7)], SCHEMA + ", depth int, part int, owner int")
    assert prefix_trie(frame).count() == 1 + (zlib.crc32(b"1") % 6 == 0)
    assert not prefix_trie(frame.limit(0)).collect()


def test_digests_are_the_same_in_pieces(spark):
    check(spark, [(c, t, "u", f"copied {t}") for c in range(300) for t in range(7)], 4, piece_ids=7)
