"""Near-duplicate documents: MinHash signatures joined by coordinate, exact sets to confirm, components to group.

Each set of 5-word shingles gets a signature of COORDINATES minima. Signatures are posted under
every (coordinate, value); two sets collide as often as they share postings. Sets with Jaccard similarity
0.75 share 48 of 64 coordinates on average, and fewer than MATCHES = 30 with a probability below 10^-6.

Prefix merging: postings are ordered by rarity. Two signatures with MATCHES collisions must share one of the
(own shared postings - MATCHES + 1) rarest of each, so only these are joined; a passage that thousands
of otherwise different documents share is never rare within them and makes no candidates. Skip merging: a
posting held by one signature is skipped, a signature with fewer than MATCHES shared postings leaves altogether.

No list of postings is expanded into its pairs. First every member is compared with the list's pivot only (the
member that shares most with others, the centre of a group of copies), which is linear and settles most of a group of
any size. Lists whose members then lie in one component are done. In the others, members outside the largest
component meet the list in tiles of at most TILE x TILE signatures, where collisions of longer signatures
(FINE coordinates, FINE_MATCHES of them to pass, again missed by less than one pair in 10^6) are counted in place. Pairs
of different components above that threshold, each in the first list that it shares, are handed on by member, not
pair by pair, and confirmed where the members' full sets meet; only links that join components leave. Pairs with a
pivot are confirmed on their full sets by joins.

Equal sets are one class from the start (documents of a class are joined back by key at the end), so
exact copies cost nothing beyond an aggregate. Classes are named by 64 bits of a set hash and confirmed by 64 more.

Defined results: a document without words has an empty set, is its own component and is kept; one with fewer
than five words has one shingle; a null doc_id is ignored as a component name unless its class has no other;
repeated rows are one class and get the same row each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.llm.blocks import LOWER, SPACED, gram_hashes, mixed, span_hashes, text_blocks, word_bounds
from playtally.llm.storage import cut

SHINGLE, SIMILAR_PERCENT = 5, 75
COORDINATES, MATCHES, TILE = 64, 30, 1024
FINE, FINE_MATCHES = 256, 156
TILE_KEYS = ["post", "i", "j"]
_RNG = np.random.default_rng(20240602)
_FLIP = _RNG.integers(0, 2**63, FINE, dtype=np.uint64)
_TURN = _RNG.integers(0, 2**63, FINE, dtype=np.uint64) | np.uint64(1)
_NAME_SALT = np.uint64(0xA0761D6478BD642F)


def shingle_sets(texts: list) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, set sizes, starts, values): the distinct shingle hashes of each text of a block, sorted."""
    for first, _, data, offsets in text_blocks(texts):
        codes = LOWER[np.frombuffer(data, np.uint8)]
        starts, ends = word_bounds(codes, SPACED)
        words, n = span_hashes(codes, starts, ends), len(offsets) - 1
        begin = np.searchsorted(starts, offsets)
        count = np.diff(begin)
        grams = gram_hashes(words, SHINGLE)
        owner = np.repeat(np.arange(n), count)
        whole = owner[:len(grams)] == owner[SHINGLE - 1:] if len(grams) else np.zeros(0, bool)
        short = np.flatnonzero((count > 0) & (count < SHINGLE))
        lone = np.array([gram_hashes(words[begin[row]:begin[row + 1]], count[row])[0] for row in short], np.uint64)
        values = np.concatenate([grams[whole], lone])
        owners = np.concatenate([owner[:len(grams)][whole], short])
        order = np.lexsort((values, owners))
        values, owners = values[order], owners[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
        values, owners = values[new], owners[new]
        sizes = np.bincount(owners, minlength=n)
        yield first, sizes, np.concatenate([[0], np.cumsum(sizes)[:-1]]), values


def _reduced(operation: np.ufunc, values: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One value per text that has any."""
    used = sizes > 0
    return operation.reduceat(values, starts[used]) if used.any() else np.zeros(0, np.uint64)


def _names(values: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each nonempty set."""
    return tuple(_reduced(np.add, mixed(values ^ salt), sizes, starts).view(np.int64) for salt in (np.uint64(0), _NAME_SALT))


def _columns(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """A frame whose class names stay whole numbers beside nulls; pandas by itself would make doubles of them."""
    made = pd.DataFrame({name: pd.Series([row[i] for row in rows], dtype="Int64" if name in ("name", "check") else object)
                         for i, name in enumerate(names)})
    return made.astype({"n": "int64"}) if "n" in names else made


def _signed(texts: pd.Series) -> pd.DataFrame:
    """Set size, class names and the minima by coordinate, in 32 bits each, of each text."""
    rows = []
    for _, sizes, starts, values in shingle_sets(texts.tolist()):
        posts = np.empty((int((sizes > 0).sum()), COORDINATES), np.int32)
        for c in range(COORDINATES):
            least = _reduced(np.minimum, (values ^ _FLIP[c]) * _TURN[c], sizes, starts)
            posts[:, c] = (mixed(least) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        one, two = _names(values, sizes, starts)
        used = iter(range(len(posts)))
        for size in sizes.tolist():
            at = next(used) if size else None
            rows.append((size, None, None, None) if at is None else (size, int(one[at]), int(two[at]), posts[at]))
    return _columns(rows, ["n", "name", "check", "posts"])


def _sets(texts: pd.Series) -> pd.DataFrame:
    """Class names, the full set and FINE minima of one byte each, of each text that has any words."""
    rows = []
    for _, sizes, starts, values in shingle_sets(texts.tolist()):
        one, two = _names(values, sizes, starts)
        fine = np.empty((len(one), FINE), np.uint8)
        for c in range(FINE):
            fine[:, c] = mixed(_reduced(np.minimum, (values ^ _FLIP[c]) * _TURN[c], sizes, starts)) & np.uint64(0xFF)
        used = iter(range(len(one)))
        for start, size in zip(starts.tolist(), sizes.tolist()):
            at = next(used) if size else None
            rows.append((None, None, None, None) if at is None else (
                int(one[at]), int(two[at]), values[start:start + size].view(np.int64), fine[at].tobytes()))
    return _columns(rows, ["name", "check", "shingles", "fine"])


def prefix_postings(classes: DataFrame) -> DataFrame:
    """(name, prefix, weight): the rarest postings of each class that can have a partner, rarest first, and how
    much it shares with others."""
    every = classes.select("name", F.posexplode("posts")).select(
        "name", F.expr("shiftleft(cast(pos as bigint), 32) | (cast(col as bigint) & 4294967295L)").alias("post"))
    # Written first: a join that also aggregates one side cannot split the rows of a hot posting.
    shared = cut(every.groupBy("post").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1"))
    held = every.join(shared, "post").groupBy("name").agg(
        F.sort_array(F.collect_list(F.struct("holders", "post"))).alias("held"), F.sum("holders").alias("weight"))
    return held.where(F.size("held") >= MATCHES).select(
        "name", F.slice("held.post", F.lit(1), F.size("held") - (MATCHES - 1)).alias("prefix"), "weight")


def pivot_pairs(prefixes: DataFrame) -> DataFrame:
    """(a, b): each list's pivot with every other member."""
    listed = prefixes.select("name", "weight", F.explode("prefix").alias("post"))
    pivots = listed.groupBy("post").agg(
        F.max(F.struct("weight", "name")).alias("pivot"), F.count(F.lit(1)).alias("m")).where("m > 1").select(
        "post", F.col("pivot.name").alias("a"))
    return listed.join(pivots, "post").where("name <> a").select(
        F.least("name", "a").alias("a"), F.greatest("name", "a").alias("b")).distinct()


def by_tile(rows: DataFrame, work: Callable[[dict[str, np.ndarray]], list[tuple]], schema: str) -> DataFrame:
    """`work` on the rows of each tile, as arrays by column. Most tiles are small, so tasks walk over sorted rows and cut them
    where the tile changes, instead of making a frame for each; a tile has at most 2 TILE rows."""
    names = [column.split()[0] for column in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = None
        for batch in batches:
            if not len(batch):
                continue
            waiting = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
            made, waiting = cut_at_tiles(waiting, False)
            yield pd.DataFrame(made, columns=names)
        if waiting is not None:
            yield pd.DataFrame(cut_at_tiles(waiting, True)[0], columns=names)

    def cut_at_tiles(held: pd.DataFrame, whole: bool) -> tuple[list[tuple], pd.DataFrame]:
        keys = held[TILE_KEYS].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(held)] if whole else []]).astype(int).tolist()
        columns = {name: held[name].to_numpy() for name in held}
        made = [row for a, b in zip(starts, starts[1:]) for row in work({name: values[a:b] for name, values in columns.items()})]
        return made, held.iloc[starts[-1]:]

    return rows.repartition(*TILE_KEYS).sortWithinPartitions(*TILE_KEYS).mapInPandas(run, schema)


def tile_links(prefixes: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) that join components within lists that hold several: each member outside its list's largest component
    against the whole list, in tiles of bounded size. Pairs above the threshold are confirmed in a tile of their own,
    where their sets meet once each; pairs that links of the tile already join are not looked at."""
    placed = prefixes.join(labels, "name", "left").select(
        "name", F.coalesce("label", "name").alias("label"), F.explode("prefix").alias("post"))
    sizes = placed.groupBy("post", "label").agg(F.count(F.lit(1)).alias("k"))
    lists = sizes.groupBy("post").agg(F.max_by("label", F.struct("k", "label")).alias("largest"),
                                      F.sum("k").alias("m"), F.max("k").alias("most")).where("m > most")
    blocks = lambda count: F.ceil(count / TILE).cast("int")
    members = placed.join(lists, "post").select(
        "name", "label", "post", (F.col("label") != F.col("largest")).alias("outside"),
        blocks(F.col("m")).alias("rows"), blocks(F.col("m") - F.col("most")).alias("columns"))
    signed = members.join(sets.select("name", "fine"), "name").join(prefixes.select("name", "prefix"), "name")
    kept = ["post", "name", "label", "fine", "prefix"]
    place = F.xxhash64("name")
    whole = signed.select(*kept, F.lit(False).alias("asks"), F.pmod(place, "rows").cast("int").alias("i"),
                          F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"))
    asking = signed.where("outside").select(
        *kept, F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"),
        F.pmod(place, "columns").cast("int").alias("j"))

    def compare(tile: dict[str, np.ndarray]) -> list[tuple]:
        asks, names, labels = (tile[name] for name in ("asks", "name", "label"))
        grid = np.frombuffer(b"".join(tile["fine"]), np.uint8).reshape(len(names), FINE)
        prefixes, (post, i, j), found = tile["prefix"], (int(tile[name][0]) for name in TILE_KEYS), {}
        is_member = ~asks
        # The members that hold each posting: a pair belongs to the first list that it shares, so a row leaves out those that
        # it meets in a rarer one before any signature is compared.
        held = np.flatnonzero(is_member)
        postings = np.concatenate([prefixes[at] for at in held]) if len(held) else np.zeros(0, np.int64)
        holder = np.repeat(held, [len(prefixes[at]) for at in held])
        order = np.argsort(postings, kind="stable")
        postings, holder = postings[order], holder[order]
        for row in np.flatnonzero(asks):
            mine = prefixes[row]
            rarer = mine[:int(np.flatnonzero(mine == post)[0])]
            rivals = is_member & (labels != labels[row])
            for first, last in zip(np.searchsorted(postings, rarer).tolist(), np.searchsorted(postings, rarer, "right").tolist()):
                rivals[holder[first:last]] = False
            rivals = np.flatnonzero(rivals)
            near = rivals[(grid[rivals] == grid[row]).sum(axis=1) >= FINE_MATCHES]
            if len(near):
                found.setdefault((names[row], labels[row]), []).extend(names[near])
                for hit in near:
                    found.setdefault((names[hit], labels[hit]), [])
        return [(post, i, j, name, label, partners) for (name, label), partners in found.items()]

    def confirm(tile: pd.DataFrame) -> pd.DataFrame:
        # Sets stay the sorted arrays that they come as, in the order of unsigned numbers.
        held = {name: shingles.view(np.uint64) for name, shingles in zip(tile["name"], tile["shingles"])}
        group, links = dict(zip(tile["name"], tile["label"])), []
        for name, partners in zip(tile["name"], tile["partners"]):
            for other in partners.tolist():
                if group[name] != group[other]:
                    small, large = sorted((held[name], held[other]), key=len)
                    if 100 * len(small) < SIMILAR_PERCENT * len(large):
                        continue
                    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = int((large[place] == small).sum())
                    if 100 * both >= SIMILAR_PERCENT * (len(small) + len(large) - both):
                        links.append((name, other))
                        old, new = group[other], group[name]
                        group = {one: new if label == old else label for one, label in group.items()}
        return pd.DataFrame(links, columns=["a", "b"])

    near = by_tile(whole.unionByName(asking), compare, "post bigint, i int, j int, name bigint, label bigint, partners array<bigint>")
    # Few tiles have candidates, and their sets can be large: one tile at a time.
    return near.join(sets.select("name", "shingles"), "name").groupBy(*TILE_KEYS).applyInPandas(confirm, "a bigint, b bigint").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that reach the similarity on their full sets."""
    left = sets.select(F.col("name").alias("a"), F.col("shingles").alias("one"))
    right = sets.select(F.col("name").alias("b"), F.col("shingles").alias("two"))
    joined = pairs.join(left, "a").join(right, "b").where(
        100 * F.least(F.size("one"), F.size("two")) >= SIMILAR_PERCENT * F.greatest(F.size("one"), F.size("two")))
    both = joined.withColumn("both", F.size(F.array_intersect("one", "two")))
    return both.where(100 * F.col("both") >= SIMILAR_PERCENT * (F.size("one") + F.size("two") - F.col("both"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(name, label): the least name reachable over the links. Labels spread and are followed until none changes."""
    both = cut(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "name"))
    while True:
        near = both.join(labels.withColumnRenamed("name", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        spread = (labels.join(near.withColumnRenamed("a", "name"), "name", "left")
                  .select("name", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        roots = labels.select(F.col("name").alias("label"), F.col("label").alias("root"))
        found = cut(spread.join(roots, "label", "left").select("name", "old", F.least("label", "root").alias("label")))
        labels = found.select("name", "label")
        if found.where("label <> old").isEmpty():
            return labels


def _grouped(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, text_key (64 bits of the text's hash), n_shingles, component_id, kept,
    label (of the group; null without words)."""
    signed = F.pandas_udf(_signed, "n bigint, name bigint, check bigint, posts array<int>")
    base = cut(docs.select("doc_id", F.xxhash64("text").alias("text_key"), signed("text").alias("s"))
               .select("doc_id", "text_key", "s.*"))
    classes = cut(base.where("n > 0").groupBy("name", "check").agg(
        F.min("doc_id").alias("first_id"), F.first("posts").alias("posts")))
    prefixes = cut(prefix_postings(classes))

    wanted = prefixes.select("name").join(classes.select("name", "check", "first_id"), "name")
    # Not deterministic to the optimizer, else the filter on its names would make every set a second time.
    made = F.pandas_udf(_sets, "name bigint, check bigint, shingles array<bigint>, fine binary").asNondeterministic()
    texts = docs.select(F.col("doc_id").alias("first_id"), "text").join(
        wanted.withColumnsRenamed({"name": "w_name", "check": "w_check", "first_id": "w_id"}),
        F.col("first_id").eqNullSafe(F.col("w_id")))
    fetched = texts.select("w_name", "w_check", made("text").alias("s")).where("s.name = w_name and s.check = w_check")
    sets = cut(fetched.select("s.name", "s.shingles", "s.fine").dropDuplicates(["name"]))

    links = cut(confirmed(pivot_pairs(prefixes), sets))
    labels = components(links)
    more = cut(tile_links(prefixes, labels, sets))
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    named = classes.select("name", "check", "first_id").join(labels, "name", "left").withColumn(
        "label", F.coalesce("label", "name"))
    least = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    found = named.join(least, "label").select("name", "check", "component_id", "label")
    return base.select("doc_id", "text_key", "n", "name", "check").join(found, ["name", "check"], "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "label").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def group(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept. A group is named by its least doc_id, so `kept` holds
    for every row of the group with that id, and for all rows of a group without ids; `first_of_each` takes one of them."""
    return _grouped(docs).drop("text_key", "label")


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stand for their groups: one of each, and all without words."""
    kept = _grouped(docs).where("kept").groupBy("doc_id", "text_key").agg(
        F.count(F.lit(1)).alias("times"), F.max("n_shingles").alias("n"), F.max("label").alias("label"))
    kept = cut(kept.select(*[F.col(name).alias(f"__{name}") for name in kept.columns]))
    rows = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.xxhash64("text") == F.col("__text_key")))
    again = kept.where("__n > 0").groupBy("__label").agg(F.sum("__times").alias("rows")).where("rows > 1")
    if not again.isEmpty():
        # Rows of one group that share a doc_id or have none: one of them stays.
        rows = rows.where("__n = 0").unionByName(rows.where("__n > 0").dropDuplicates(["__label"]))
    return rows.select(docs.columns)


def minhash_neardup(spark, sf_dir: str) -> DataFrame:
    return group(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""with recursive words as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, list_slice(w, i, i + {SHINGLE - 1}) as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE}, 0) + 2)) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by 1),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n_both from shingles a join shingles b using (s)
  where a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from common join sizes x on a = x.doc_id join sizes y on b = y.doc_id
  where 100 * n_both >= {SIMILAR_PERCENT} * (x.n + y.n - n_both)),
reach as (
  select doc_id as a, doc_id as b from sizes union select reach.a, links.b from reach join links on reach.b = links.a)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(least_id, doc_id) as component_id,
  coalesce(least_id, doc_id) = doc_id as kept
from documents left join sizes using (doc_id) left join (select a as doc_id, min(b) as least_id from reach group by 1) using (doc_id)"""
