"""Conversation trie against plain prefix counting, whatever the blocks."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from playtally.llm import prefix_trie
from tests.llm.helpers import SCALE, assert_matches

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [row[2:] for row in sorted(turns)] for conv, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        out[conv] = own.get(conv - int(math.fmod(conv, 100)), [])[:h] + turns[h:]
    return out


def plain_nodes(paths):
    members, kids = defaultdict(list), defaultdict(set)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(conv)
            if depth:
                kids[tuple(path[:depth - 1])].add(tuple(path[:depth]))
    out = []
    for node, convs in members.items():
        leaves = saved = 0
        below = [node]
        while below:
            one = below.pop()
            leaves += not kids[one]
            saved += (len(members[one]) - 1) * (len(one[-1][1]) if one else 0)
            below += kids[one]
        ends = ",".join(map(str, sorted(conv for conv in convs if len(paths[conv]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids[node]), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(frame, **sizes):
    return sorted(map(tuple, prefix_trie.trie_nodes(prefix_trie.with_shared_heads(prefix_trie.sequences(frame)), **sizes).collect()), key=repr)


def wild_rows():
    pick, rows = random.Random(11), []
    texts = ["", None, "a", "b", "Ünï 😀", "x" * 50]
    for conv in [*range(-130, 260, 3), 100, 200, 2**53 + 1, 2**53 + 2]:
        for turn in range(pick.choice([1, 1, 2, 4, 9])):
            rows.append((conv, turn, pick.choice(["user", "assistant", None]), pick.choice(texts)))
    hot = [(1000 + i, turn, "user", f"hot {turn}") for i in range(300) for turn in range(7)]
    return rows + hot + rows[:5] + [(7, None, "user", "b"), (7, None, None, None), (None, 0, "user", "lost"), (5, 3, "user", "tie"), (5, 3, "user", "tie")]


@pytest.mark.parametrize("sizes, partitions", [({}, 1), ({"block_rows": 1}, 4), ({"block_rows": 3}, 5), ({"block_turns": 40}, 8)])
def test_any_blocks_give_the_same_nodes(spark, sizes, partitions):
    rows = wild_rows()
    # Ties of (turn, role) have equal texts here, so that their order does not matter.
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as name", "2 as key", "3 as depth").repartition(partitions)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps many shards of few rows
    try:
        found = made(frame, **sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert found == plain_nodes(rebuilt(rows))


def test_whole_table_matches_sql(spark):
    assert_matches(spark, prefix_trie.conversation_trie, prefix_trie.SQL)


def test_whole_table_matches_plain_counting(spark):
    rows = list(map(tuple, spark.read.parquet(str(SCALE / "conversations.parquet")).select("conv_id", "turn", "role", "text").collect()))
    found = sorted(map(tuple, prefix_trie.conversation_trie(spark, str(SCALE)).collect()), key=repr)
    assert found == plain_nodes(rebuilt(rows))


def test_long_conversation(spark):
    rows = [(c, turn, "user", str(turn)) for c in (1, 2, 3) for turn in range(5000 if c < 3 else 4000)]
    found = {row[1]: row for row in made(spark.createDataFrame(rows, SCHEMA), block_rows=1) if row[0] == 1}
    paths = rebuilt(rows)
    assert len(found) == 1 + len(paths[1]) and all(found[d][3] >= 1 and found[d][5] >= 1 for d in found)
    assert found[0][3] == 3 and found[len(paths[1])][4] == 0


def test_empty_table_and_turnless_conversations(spark):
    assert made(spark.createDataFrame([], SCHEMA)) == []
    turnless = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 3)
    rows = [(turnless, 0, "user", "taken away")]
    assert made(spark.createDataFrame(rows, SCHEMA)) == plain_nodes({turnless: []})


def test_double_array_holds_exactly_its_sequences():
    pick = random.Random(5)
    every = sorted({tuple(pick.randrange(40) for _ in range(pick.randrange(6))) for _ in range(400)})
    trie = prefix_trie.DoubleArray([list(path) for path in every])
    prefixes = {path[:i] for path in every for i in range(len(path) + 1)}
    assert (trie.check >= 0).sum() == len(prefixes) - 1
    for path in prefixes:
        state = 0
        for code in range(40):
            child = int(trie.base[0]) + code
            holds = 0 < child < len(trie.check) and trie.check[child] == 0
            assert holds == ((code,) in prefixes)
        for code in path:
            child = int(trie.base[state]) + code
            assert trie.check[child] == state
            state = child
    flat = np.array([code for path in every for code in path])
    walked = list(trie.walk(flat, np.array([*map(len, every)])))
    assert len(walked) == max(map(len, every)) + 1
