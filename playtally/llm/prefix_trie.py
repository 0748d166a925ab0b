"""Prefix trie of conversations: double arrays by shard, shared upper nodes merged over all shards.

A turn is named by 128 bits of a digest of its role and text, a conversation is the sequence of these names. Sequences
are dealt out by range in their own order (with conv_id behind, so that copies of one conversation can be split too), so
a shard holds neighbours. Each task cuts its sorted sequences into blocks of bounded size. In a block turn names
become dense ids and the trie is packed into BASE and CHECK: the child of state s by id c is BASE[s] + c, which holds
iff CHECK of it is s. All sequences are then walked through both arrays at once, turn by turn, and what their
members add up to is kept by state.

Only nodes on a block's first and last sequence can also occur in other blocks. All others are complete and leave as
results. Nodes on these two are the shared upper part: they leave with what the rest of the block adds to them,
under a name that chains the digests from the root, and are merged by name. Their sums over subtrees are
then running sums along the same sequences from the bottom, where each merged node counts in one sequence only. The
number of shared rows depends on the number of blocks, not on the members of a node.

Defined results: null roles and texts are empty; turns of one conversation are ordered by turn (null first), equal ones by
role, then digest; repeated rows are repeated turns; rows with a null conv_id belong to no conversation; an empty table
has no member and hence no node, not even the root. A conversation is one row while it is handled, at 24 bytes a turn and without its
texts; the SHA-256 of a node's ends is sequential by definition, so the ends of one node are streamed, sorted, by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtally.llm.storage import cut

HEAD_OF, HEADS, NAME_BYTES = 100, 6, 16
BLOCK_TURNS, BLOCK_ROWS = 1 << 18, 1 << 17
#: Free places tried for the children of a node before they go to the end of the arrays.
TRIES = 32
SALTS = 32
DONE, SHARED, END = 0, 1, 2
ROOT = bytes(NAME_BYTES)
NO_ENDS = hashlib.sha256().digest()
TURN = "struct<name:string,chars:int>"
MADE = pa.schema([
    ("kind", pa.int32()), ("name", pa.binary()), ("parent", pa.binary()), ("path", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("chars", pa.int64()), ("ends", pa.binary())])
MADE_SQL = ("kind int, name binary, parent binary, path bigint, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
            "n_children bigint, n_leaves bigint, saved_tokens bigint, chars bigint, ends binary")
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


class DoubleArray:
    """A trie over sorted, different sequences of dense ids, packed into BASE and CHECK. State 0 is the root."""

    def __init__(self, sequences: list[list[int]]):
        self.base, self.check, self._free = [0], [-1], 1
        waiting = [(0, 0, len(sequences), 0)]
        while waiting:
            state, first, last, depth = waiting.pop()
            if first < last and len(sequences[first]) == depth:
                first += 1
            children: list[list[int]] = []
            at = first
            while at < last:
                code, begin = sequences[at][depth], at
                at += 1
                while at < last and sequences[at][depth] == code:
                    at += 1
                children.append([code, begin, at])
            if not children:
                continue
            base = self._place(sorted(child[0] for child in children))
            self.base[state] = base
            for code, begin, end in children:
                self.check[base + code] = state
                waiting.append((base + code, begin, end, depth + 1))
        self.base, self.check = np.array(self.base, np.int64), np.array(self.check, np.int64)

    def _place(self, codes: list[int]) -> int:
        """A base at which the places of all codes are free, found at the first free places or else behind all others."""
        while self._free < len(self.check) and self.check[self._free] >= 0:
            self._free += 1
        place, tried = self._free, 0
        while place < len(self.check):
            if self.check[place] < 0:
                base, tried = place - codes[0], tried + 1
                if all(base + code >= len(self.check) or self.check[base + code] < 0 for code in codes[1:]):
                    break
                if tried == TRIES:
                    place = len(self.check)
                    break
            place += 1
        base = place - codes[0]
        more = base + codes[-1] + 1 - len(self.check)
        if more > 0:
            self.check += [-1] * more
            self.base += [0] * more
        return base

    def walk(self, flat: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Depth by depth the sequences that are so long, and their states; the root first, with all of them."""
        first, order = np.cumsum(lengths) - lengths, np.argsort(-lengths, kind="stable")
        states = np.zeros(len(lengths), np.int64)
        yield np.arange(len(lengths)), states.copy()
        longer = np.cumsum(np.bincount(lengths, minlength=1)[::-1])[::-1]
        for depth in range(int(lengths.max(initial=0))):
            active = order[:longer[depth + 1]]
            found = self.base[states[active]] + flat[first[active] + depth]
            if not (self.check[found] == states[active]).all():
                raise ValueError("a sequence is not in the trie")
            states[active] = found
            yield active, found


def _block(rows: list[tuple[bytes, list[int], int]], block: int) -> pa.RecordBatch:
    """The nodes of sorted rows (names of turns, their characters, conv_id): results, shared nodes and ends of shared nodes."""
    keys, members = [], []
    for key, _, conv in rows:
        if not keys or keys[-1] != key:
            keys.append(key)
            members.append([])
        members[-1].append(conv)
    ids: dict[bytes, int] = {}
    chars: list[int] = []
    sequences = []
    for key, sizes, _ in rows:
        if len(sequences) < len(keys) and key == keys[len(sequences)]:
            sequence = []
            for i, size in enumerate(sizes):
                name = key[i * NAME_BYTES:(i + 1) * NAME_BYTES]
                code = ids.setdefault(name, len(ids))
                if code == len(chars):
                    chars.append(size)
                sequence.append(code)
            sequences.append(sequence)
    trie = DoubleArray(sequences)
    lengths = np.array([len(sequence) for sequence in sequences], np.int64)
    flat = np.array([code for sequence in sequences for code in sequence], np.int64)
    many = np.array([len(group) for group in members], np.int64)
    least = np.array([min(group) for group in members], np.int64)

    states = len(trie.check)
    n, smallest = np.zeros(states, np.int64), np.full(states, np.iinfo(np.int64).max)
    depth, last_code, shared, ending = np.zeros(states, np.int64), np.zeros(states, np.int64), np.zeros(states, bool), np.zeros(len(keys), np.int64)
    first_of, chains = np.cumsum(lengths) - lengths, {0: [], len(keys) - 1: []}
    for at, (active, found) in enumerate(trie.walk(flat, lengths)):
        np.add.at(n, found, many[active])
        np.minimum.at(smallest, found, least[active])
        depth[found], ending[active] = at, found
        if at:
            last_code[found] = flat[first_of[active] + at - 1]
        for sequence in chains:
            chains[sequence] += found[active == sequence].tolist()
    for chain in chains.values():
        shared[chain] = True

    used = np.flatnonzero(n)
    used = used[np.argsort(depth[used], kind="stable")]
    parent = trie.check
    size = np.append(np.array(chars, np.int64), 0)[np.where(depth > 0, last_code, -1)]
    inner = used[1:]
    children = np.bincount(parent[inner], minlength=states)
    leaves, saved = np.where(children == 0, 1, 0), (n - 1) * size
    own = np.bincount(parent[inner[~shared[inner]]], minlength=states)
    leaves[shared] = saved[shared] = 0
    # From the bottom up; a shared node takes from the others only and hands nothing on, its sums are made when all are merged.
    bounds = np.searchsorted(depth[inner], np.arange(1, depth[used[-1]] + 2))
    for level in range(len(bounds) - 2, -1, -1):
        nodes = inner[bounds[level]:bounds[level + 1]]
        nodes = nodes[~shared[nodes]]
        np.add.at(leaves, parent[nodes], leaves[nodes])
        np.add.at(saved, parent[nodes], saved[nodes])

    digests = list(ids)
    names = {0: ROOT}
    for state, code, above in zip(inner.tolist(), last_code[inner].tolist(), parent[inner].tolist()):
        names[state] = hashlib.blake2b(names[above] + digests[code], digest_size=NAME_BYTES).digest()
    ends = {int(state): group for state, group in zip(ending, members)}
    out: list[tuple] = []
    for state in inner[~shared[inner]].tolist():
        above = int(parent[state])
        mine = ends.get(state)
        out.append((DONE, names[state], names[above] if shared[above] else None, None, int(depth[state]), int(smallest[state]),
                    None if shared[above] else int(smallest[above]), int(n[state]), int(children[state]), int(leaves[state]), int(saved[state]), None,
                    hashlib.sha256(",".join(map(str, mine)).encode()).digest() if mine else NO_ENDS))
    told = set()
    for which, chain in enumerate(chains.values()):
        for state in chain:
            once = state not in told
            told.add(state)
            above = names[int(parent[state])] if state else None
            numbers = [int(values[state]) for values in (n, own, leaves, saved)] if once else [0, 0, 0, 0]
            out.append((SHARED, names[state], above, block * 2 + which, int(depth[state]), int(smallest[state]) if once else None, None,
                        *numbers, int(size[state]), None))
            if once:
                out += [(END, names[state], None, None, None, conv, *(None,) * 7) for conv in ends.get(state, ())]
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*out), MADE)], schema=MADE)


def _blocks(batches: Iterable[pa.RecordBatch], block_turns: int, block_rows: int) -> Iterator[pa.RecordBatch]:
    rows, turns = [], 0
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in ("key", "chars", "conv_id"))):
            rows.append(row)
            turns += len(row[1])
            if turns >= block_turns or len(rows) >= block_rows:
                yield _block(rows, block)
                rows, turns, block = [], 0, block + 1
    if rows:
        yield _block(rows, block)


def _end_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the conv_ids of each name, streamed in order."""
    name, digest = None, None
    for batch in batches:
        done: list[tuple[bytes, bytes]] = []
        for one, conv in zip(batch.column("name").to_pylist(), batch.column("conv_id").to_pylist()):
            if one == name:
                digest.update(f",{conv}".encode())
                continue
            if name is not None:
                done.append((name, digest.digest()))
            name, digest = one, hashlib.sha256(str(conv).encode())
        yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in done], pa.binary()) for i in range(2)], ["name", "ends"])
    if name is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.digest()], pa.binary())], ["name", "ends"])


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns array<TURN>) from rows (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    name = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * NAME_BYTES)
    ordered = turns.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.struct(
        F.col("turn").isNotNull().alias("numbered"), F.coalesce("turn", F.lit(0)).alias("turn"), role.alias("role"), name.alias("name"),
        F.length(text).alias("chars")).alias("turn"))
    return ordered.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")).withColumn(
        "turns", F.expr("transform(turns, t -> named_struct('name', t.name, 'chars', t.chars))"))


def with_shared_heads(conversations: DataFrame) -> DataFrame:
    """Each conversation with its first h turns taken from the conversation that heads its hundred. A head serves 199 at most."""
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    heads = conversations.where(F.col("conv_id") % HEAD_OF == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, HEADS - 1).alias("head"))
    joined = conversations.withColumns({"head_id": F.col("conv_id") - F.col("conv_id") % HEAD_OF, "h": h}).join(heads, "head_id", "left")
    none = F.array().cast(f"array<{TURN}>")
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), rest).alias("turns"))


def trie_nodes(conversations: DataFrame, block_turns: int = BLOCK_TURNS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per node (columns RESULT) of the trie over (conv_id, turns array<TURN>), each conv_id once. A block
    ends with the row that brings it to `block_turns` turns or `block_rows` rows; any sizes give the same rows."""
    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _blocks(batches, block_turns, block_rows)

    # Dealing out by range looks at the rows twice, so they are written first: names and lengths only.
    dealt = cut(conversations.select("conv_id", F.unhex(F.array_join("turns.name", "")).alias("key"), F.col("turns.chars").alias("chars")))
    made = cut(dealt.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(blocks, MADE_SQL))
    chains = made.where(F.col("kind") == SHARED)
    merged = chains.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.max("chars").alias("chars"),
        F.min("path").alias("owner"), *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    below = merged.where("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("below")).withColumnRenamed("parent", "name")
    merged = cut(merged.join(below, "name", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("below", F.lit(0))).drop("below"))
    once = F.col("path") == F.col("owner")
    terms = chains.select("path", "depth", "name").join(merged.select(
        "name", "owner", (F.col("n_leaves") + (F.col("n_children") == 0).cast("bigint")).alias("leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "name")
    upward = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = terms.select("name", *[F.sum(F.when(once, F.col(name)).otherwise(0)).over(upward).alias(name) for name in ("leaves", "saved")]).groupBy(
        "name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    ends = made.where(F.col("kind") == END).select("name", "conv_id").repartition("name").sortWithinPartitions("name", "conv_id").mapInArrow(
        _end_digests, "name binary, ends binary")
    parents = merged.select(F.col("name").alias("parent"), F.col("conv_id").alias("above"))
    upper = merged.join(sums, "name").join(ends, "name", "left").join(parents, "parent", "left").select(
        "conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"))
    # The root is the parent of many: the few merged nodes are repeated so that these spread.
    salted = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    lower = made.where(F.col("kind") == DONE).withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int")).join(
        salted, ["parent", "salt"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).select(*upper.columns)
    return lower.unionByName(upper).withColumn("ends_sha256", F.lower(F.hex("ends"))).select(*RESULT)


def conversation_trie(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return trie_nodes(with_shared_heads(sequences(turns)))


SQL = """with own as (
  select conv_id, list({r: coalesce(role, ''), t: coalesce(text, '')} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id),
hashed as (
  select conv_id, turns, cast(xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(
    string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as ubigint))),
    lambda c, x: list_reduce(list_prepend(xor(c, x), list_transform(range(8), lambda i: cast(i as ubigint))),
      lambda s, i: xor(s >> 1, (s & 1) * 3988292384::ubigint))), 4294967295::ubigint) % 6 as integer) as h
  from own),
rebuilt as (
  select c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) as path
  from hashed c left join own b on b.conv_id = c.conv_id - c.conv_id % 100),
steps as (select conv_id, path, unnest(range(0, len(path) + 1)) as depth from rebuilt),
nodes as (
  select path[1:depth] as node, depth, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (len(path) = depth), '')) as ends_sha256
  from steps group by 1, 2),
children as (select node[1:depth - 1] as node, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by 1, 2),
full_nodes as (select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c using (node, depth)),
lines as (
  select node, unnest(range(0, depth + 1)) as above, (n_convs - 1) * coalesce(length(node[depth].t), 0) as spared,
    case when n_children = 0 then 1 else 0 end as leaf
  from full_nodes),
sums as (select node[1:above] as node, above as depth, sum(spared) as saved_tokens, sum(leaf) as n_leaves from lines group by 1, 2)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, cast(s.n_leaves as bigint) as n_leaves,
  cast(s.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from full_nodes n join sums s using (node, depth)
left join nodes p on n.depth > 0 and p.node = n.node[1:n.depth - 1] and p.depth = n.depth - 1"""
