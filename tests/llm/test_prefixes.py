"""The conversation trie against one built turn by turn."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from sessionloom.llm import prefix_rollup

from . import corpus

SCHEMA = "conv_id long, turn long, role string, text string, a long, block long, depth long, x long, n_convs long, t1 string, part int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, "x", 6) for r in rows], SCHEMA).repartition(3)


def brute(rows):
    """(conv_id, depth) is not unique, so nodes are returned as sorted rows."""
    own = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[conv].append((role or "", text or ""))
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = tuple(own.get(conv - int(math.fmod(conv, 20)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for conv, turns in sorted(rebuilt.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * len(corpus.words(node[-1][1])) if node else 0
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(rebuilt[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.append((convs[0], len(node), parent, len(convs), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    return sorted((tuple(r) for r in prefix_rollup.prefix_trie(frame(spark, rows)).collect()), key=repr)


def conversations(seed, n=70, longest=14):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(160), n):
        length = rng.choice([1, 2, 3, 4, 5, 8, 9, longest])
        shared = rng.random() < 0.7  # turns from a small stock, so that beginnings agree
        for k in rng.sample(range(longest * 3), length):
            text = rng.choice(["a", "b c", "", None]) if shared else " ".join(corpus.prose(rng, 5))
            rows.append((conv, k if rng.random() < 0.97 else None, rng.choice(["user", "user", None]), text))
    seen, out = set(), []
    for r in rows:  # no two turns of one number: their order is our own
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            out.append(r)
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_trie(spark, seed, monkeypatch):
    monkeypatch.setattr(prefix_rollup, "STRETCH", [1024, 2, 1][seed])
    monkeypatch.setattr(prefix_rollup, "WIDTH", [4, 3, 4][seed])
    monkeypatch.setattr(prefix_rollup, "PIECE_BITS", [13, 1, 3][seed])
    rows = conversations(seed)
    assert found(spark, rows) == brute(rows)


def test_copies_long_ones_and_absent_families(spark):
    rows = [(c, k, "user", f"same {k}") for c in range(40, 80) for k in range(9)]  # copies
    rows += [(100, k, "user", f"turn {k}  of\tmany") for k in range(300)]  # one long one
    rows += [(c, 0, "user", "alone") for c in (-3, -20, 141, 142, 143, 147, 161)]  # families absent or negative
    rows += [(200, None, None, None), (200, 1, "user", "x " * 20000), (201, 5, "user", ""), (202, 5, "", None)]
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    assert found(spark, rows) == brute(rows)


def test_repeated_rows_are_turns(spark):
    rows = [(c, 1, "user", "again") for c in (20, 20, 20, 40, 40)] + [(60, None, "user", "again")]
    assert found(spark, rows) == brute(rows)


def test_no_conversations(spark):
    assert found(spark, []) == [] and found(spark, [(None, 1, "user", "x")]) == []
