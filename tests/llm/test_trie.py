"""The conversation trie against brute force, for small blocks and few rows a shard."""

import hashlib
import random
import zlib

import pytest

from tracelake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_convs int"  # two names clash


def brute_force(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, (role or "", text or "")))

    def digest(rt):
        return hashlib.sha256(f"{len(rt[0].encode())}:{rt[0]}{rt[1]}".encode()).digest()[:16]

    own = {c: [x[2] for x in sorted(t, key=lambda x: (x[0], x[1], digest(x[2])))] for c, t in convs.items()}
    members = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        seq = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append((c, d == len(seq)))
    below = {node: [0, 0, 0] for node in members}  # children, leaves, savings
    out = []
    for node in sorted(members, key=len, reverse=True):
        children, leaves, saved = below[node]
        leaves = leaves if children else 1
        saved += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        if node:
            up = below[node[:-1]]
            up[0] += 1
            up[1] += leaves
            up[2] += saved
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        ends = ",".join(str(c) for c in sorted(c for c, last in members[node] if last))
        out.append((min(c for c, _ in members[node]), len(node), parent, len(members[node]), children, leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def some(seed, n=60):
    rng = random.Random(seed)
    rows = []
    copies = [(i, rng.choice(["user", None]), rng.choice(["a", "bé", "", None])) for i in range(rng.randrange(3, 14))]
    for c in range(n):
        if rng.random() < 0.1:
            continue
        if c % 3 == 0:  # a third are copies
            turns = copies
        else:
            turns = [(rng.choice([i, i, i, None, 3]), rng.choice(["user", "assistant"]), rng.choice("ab")) for i in range(rng.randrange(1, 9))]
        rows += [(c, t, r, x, "clash", 7) for t, r, x in turns]
    rows += [(None, 0, "user", "nobody", None, None)] * 3
    rng.shuffle(rows)
    return rows + rows[:5]  # repeated rows


@pytest.mark.parametrize(("seed", "block", "shards"), [(1, 1024, 1), (2, 1024, 7), (3, 2, 5), (4, 3, 1), (5, 1, 4)])
def test_nodes_equal_brute_force(spark, seed, block, shards):
    rows = some(seed)
    got = trie.build(spark.createDataFrame(rows, SCHEMA), block=block, shards=shards)
    assert got.columns == trie.OUT
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(rows)


def test_long_conversations_and_hot_copies(spark):
    long = [(7, i, "user", "x" * (i % 5), "", 0) for i in range(500)]
    rows = long + [(c, t, r, x, d, n) for c in (100, 101) for _, t, r, x, d, n in long[:300]]
    rows += [(c, 0, "user", "same", "", 0) for c in range(1000, 1400)]
    got = trie.build(spark.createDataFrame(rows, SCHEMA), block=64, shards=6)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(rows)


def test_no_rows(spark):
    assert trie.build(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_node_off_the_splitters_is_whole_in_its_shard():
    rng = random.Random(0)
    keys = sorted({("0", bytes(rng.choices(b"ab", k=rng.randrange(5))) * 1, i) for i in range(80)})
    splitters = trie.Splitters(keys[::9])
    shards = [splitters.shard(*k) for k in keys]
    assert shards == sorted(shards) and shards[-1] == len(splitters.at)
