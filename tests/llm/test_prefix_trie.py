"""The prefix trie against a recursive one, and its list ranking against walking the list."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from cellscape.llm import prefix_trie
from cellscape.llm.stage import Stages

SCHEMA = "conv_id long, turn long, role string, text string, pos int, depth string, part int, k1 string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, md5(md5(role or "") + md5(text or "")), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(own):
        base, h = c - int(np.fmod(c, 100)), zlib.crc32(str(c).encode()) % 6
        turns = tuple(own[c] if base == c else own.get(base, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
        ends[turns].append(c)
    leaves, saved = Counter(), Counter()
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return Counter((m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(children[n]), leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n, m in members.items())


def check(spark, rows, **sizes):
    frame = spark.createDataFrame([(*r, 1, "d", 2, "k") for r in rows], SCHEMA).repartition(5)
    got = prefix_trie.prefix_trie(frame, **sizes).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == plain(rows)
    places = sorted(x for r in got for x in (r["enter_at"], r["exit_at"]))
    assert places == list(range(2 * len(got)))
    return got


def odd_rows():
    rng = np.random.default_rng(6)
    rows = []
    for c in list(range(-120, 330, 3)) + [10**15, 10**15 + 7]:
        first = str(rng.choice(["hi", "hello", "é日本🤦🏼"]))
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", first if t == 0 else str(rng.choice(["a", "b", "c long answer"]))) for t in range(rng.integers(0, 9))]
    rows += [(c, t, "user", "the same in many") for c in range(400, 520) for t in range(3)]
    rows += [(7, None, None, None), (7, None, "user", "x"), (7, 0, "user", "tie"), (7, 0, "a", "tie"), (7, 0, "a", "tie"), (None, 1, "user", "lost"), (601, None, None, None)]
    return rows


def test_odd_rows(spark):
    check(spark, odd_rows())


def test_small_tasks_and_mates(spark):
    """Many tasks and rounds of random mates give the same result."""
    check(spark, odd_rows(), task_nodes=60, single=40)


@pytest.mark.parametrize("rows", [[], [(5, 0, "user", "one turn")], [(1, 0, "user", "x"), (2, 0, "user", "x")]])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_one_conversation_with_most_rows(spark):
    """A third of all rows or more in one conversation, with long texts, numbered or not."""
    rows = [(100, t, "user", f"turn {t % 7}") for t in range(6000)] + [(101, None, "user", f"no number {k % 900}") for k in range(3000)]
    rows += [(c, t, "user", f"turn {t}") for c in range(200, 900) for t in range(4)] + [(902, 0, "user", "y" * 5_000_000), (903, 0, "user", "y" * 5_000_000)]
    got = check(spark, rows, task_nodes=1000)
    assert max(r["depth"] for r in got) == 6000


def test_many_ends_of_one_node(spark):
    """Ids that end in one node are digested in several chunks."""
    check(spark, [(c, 0, "user", "same") for c in range(3000)] + [(c, t, "user", f"own {c}") for c in range(3000, 3300) for t in range(2)])


@pytest.mark.parametrize("single", [1, 10, 10_000])
def test_list_ranking(spark, single):
    rng = np.random.default_rng(2)
    order = rng.permutation(500) * 3 + 1
    weights = rng.integers(0, 50, (500, 3))
    following = [int(x) for x in order[1:]] + [None]
    rows = [(int(p), f, *map(int, w)) for p, f, w in zip(order, following, weights)]
    pieces = spark.createDataFrame(rows, "piece long, following long, steps long, leaves long, saved long").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in prefix_trie.rank_list(pieces, Stages(spark, "test"), single).collect()}
    before = np.cumsum(weights, axis=0) - weights
    assert got == {int(p): tuple(map(int, b)) for p, b in zip(order, before)}


def test_scan(spark):
    rng = np.random.default_rng(9)
    rows = [(int(k), i, int(x), int(x)) for i, (k, x) in enumerate(zip(rng.choice([1, 1, 1, 2, 3, 4], 3000), rng.integers(-(2**40), 2**40, 3000)))]
    frame = spark.createDataFrame(rows, "k long, i int, s long, x long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["k"], r["i"]): (r["s"], r["x"]) for r in prefix_trie.scan(frame, "k", ["i"], {"s": "sum", "x": "xor"}, Stages(spark, "test"), "scan").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, state = {}, defaultdict(lambda: (0, 0))
    for k, i, s, x in rows:
        state[k] = (state[k][0] + s, state[k][1] ^ x)
        want[(k, i)] = state[k]
    assert got == want


def test_tables(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    frame = spark.read.parquet(f"{sf}/conversations.parquet")
    got = Counter(map(tuple, prefix_trie.prefix_trie(frame).select(COLUMNS).collect()))
    assert got == plain([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])
    assert got == Counter(con.execute(prefix_trie.ORACLE).fetchall())
