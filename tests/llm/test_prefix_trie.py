"""The prefix trie against brute force over random conversations."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from growthlens.llm.prefix_trie import conversation_trie, decomposed, rebuilt_trie
from tests.conftest import SF_SMALL, rows
from tools.compare_oracle import duck_rows, register, rows_of, spark_rows

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, depth string, rep string, top_conv string"


def ordered(data):
    convs = {}
    for conv, turn, role, text in data:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    return {c: [(r, t) for *_, r, _, t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        base = convs.get(c - int(np.fmod(c, 5)), [])
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = base[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: [] for p in members}
    for p in members:
        if p:
            children[p[:-1]].append(p)
    total = {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        below = [total[q] for q in children[p]]
        total[p] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for p, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(p))
        out.append((
            min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(children[p]), *total[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def conversations(seed, convs=60, longest=9, words=2):
    r = random.Random(seed)
    data = []
    for c in r.sample(range(-40, 4 * convs), convs):
        for turn in range(r.choice([1, 2, r.randint(1, longest)])):
            data.append((c, turn, r.choice(["user", "user", None]), r.choice(["", None, "é🙂", *"ab"[:words]])))
    data += [(3, None, "user", "null turn"), (3, 1, "a", "tie"), (3, 1, "a", "tie"), (3, 1, "b", "tie"), (None, 0, "user", "no id")]
    return data


def frame(spark, data):
    return spark.createDataFrame([(*d, "x", None, "y") for d in data], SCHEMA)


@pytest.mark.parametrize("task_nodes", [6, 10_000])
def test_trie_equals_brute_force(spark, task_nodes):
    data = conversations(1)
    assert sorted(rows(conversation_trie(frame(spark, data), task_nodes), *COLUMNS), key=str) == brute(ordered(data))


def test_rebuilt_conversations_and_those_without_turns(spark):
    data = conversations(2, convs=80)
    convs = rebuilt(ordered(data))
    assert any(not turns for turns in convs.values())
    assert sorted(rows(rebuilt_trie(frame(spark, data)), *COLUMNS), key=str) == brute(convs)
    assert rebuilt_trie(frame(spark, data).limit(0)).count() == 0


def test_one_long_conversation_and_many_equal_ones(spark):
    data = [(1, t, "user", f"turn {t % 3}") for t in range(300)] + [(2, t, "user", f"turn {t % 3}") for t in range(200)]
    data += [(c, t, "user", "same") for c in range(10, 60) for t in range(2)]
    got = rows(conversation_trie(frame(spark, data), 40), *COLUMNS)
    assert sorted(got, key=str) == brute(ordered(data))


def test_decomposition_of_random_trees():
    r = np.random.default_rng(3)
    for shape in (1, 3, 50):
        n = 400
        parent = np.array([-1, *(r.integers(max(0, i - shape), i) for i in range(1, n))])
        depth, size, want = np.zeros(n, np.int64), np.ones(n, np.int64), r.integers(0, 9, n)
        value = want.copy()
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        for i in range(n - 1, 0, -1):
            size[parent[i]] += size[i]
            want[parent[i]] += want[i]
        (got,) = decomposed(np.arange(n), depth, parent, np.zeros(n, np.int64), size, [value])
        assert (got == want).all()


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    register(con, SF_SMALL)
    s_cols, s_rows = spark_rows(entry.queries()["op11_prefix_trie"](spark, SF_SMALL))
    d_cols, d_rows = duck_rows(con, entry.oracle_sql()["op11_prefix_trie"])
    assert sorted(s_cols) == sorted(d_cols) and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
