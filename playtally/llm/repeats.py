"""Removal of repeated passages by a difference-cover suffix sort.

A byte goes when it lies in a MATCH-byte string that also starts elsewhere, in any document or the same.

A suffix order of the whole corpus is not needed for that, only which MATCH-byte prefixes of suffixes are equal,
and rows for every suffix of 100 TB would not fit any disk. So the sort is dealt out first, with an exact rule: of
the GRAM-byte windows inside a MATCH-byte string the least hash (leftmost of equals) is its anchor. Equal strings
have equal anchors at equal places, so they meet in the bucket of that hash; a hash seen at one place only is
dropped before any text moves. What remains are contexts: the starts that share an anchor, with MATCH bytes from each.

Each task sorts the suffixes of the contexts of its buckets by a difference cover modulo 3: the triples at
positions 1 and 2 mod 3 are sorted and named, the names are sorted recursively, the suffixes at 0 mod 3 are merged in by
their first byte and the rank behind it. Recursion ends once names cover MATCH bytes. Neighbours in the order are
then compared byte by byte over MATCH bytes; equal ones are repeats. Hashes only deal out, they decide nothing.

Equal contexts become one row before they are shuffled with their bytes, so copies of any number cost one; two places
of one context already prove every start of it. A bucket with more than BUCKET different contexts (one passage
in the midst of very many texts) is dealt out finer, never gathered: its starts are halved by their distance before the
anchor. Strings of one half share more bytes around it (`shared_core`), and the hash of these names the bucket
of the half. After nine halvings a slice is one string and equal ones are one row, so every bucket becomes small.
Equal texts are scanned by key (128 bits of their SHA-256) and one of them is searched.

Defined results: a null text is empty; a text shorter than MATCH keeps all; repeated rows are repeated texts
and lose everything from MATCH bytes on; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.llm.blocks import _BYTE_CODES, mixed, powers, text_blocks, windowed_min
from playtally.llm.storage import cut

MATCH, GRAM = 400, 128
WINDOWS = MATCH - GRAM + 1
BUCKET, SORTED_BYTES = 1500, 700_000
#: Names of crowded buckets (8 bytes each) that are broadcast; beyond, both sides are shuffled.
MOST_BROADCAST = 1_000_000
_SYMBOL_BITS = 21

#: A slice holds starts whose distance before the anchor is in [low, high); `left` is that of its first byte.
SLICE = "bucket bigint, context binary, low int, high int, left int, starts int, bytes binary"


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the `width` bytes from each position."""
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[codes] * up[:len(codes)], out=sums[1:])
    n = max(0, len(codes) - width + 1)
    return mixed((sums[width:width + n] - sums[:n]) * down[:n])


def anchors(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, hash, first start, starts, distance to the anchor) of each run of starts with one anchor, in a block."""
    hashes = window_hashes(codes, GRAM)
    # One width for every block, so that equal strings break ties alike.
    low = np.uint64((1 << 32) - 1)
    least = windowed_min((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), WINDOWS)
    place = (least & low).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(place)]
    # Starts whose MATCH bytes end inside their text; a newline closes each text.
    whole = np.arange(len(place)) + MATCH < offsets[text + 1]
    first = np.ones(len(place), bool)
    first[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1])
    at = np.flatnonzero(first)
    starts = np.diff(np.concatenate([at, [len(place)]]))
    at, starts = at[whole[at]], starts[whole[at]]
    return text[at], hashes[place[at]].view(np.int64), at, starts, place[at] - at


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keys, ids = batch["key"].to_numpy(), batch["id"]
        for first, _, data, offsets in text_blocks(batch["text"].tolist()):
            text, hashes, at, _, _ = anchors(np.frombuffer(data, np.uint8), offsets)
            yield pd.DataFrame({"anchor": hashes, "key": keys[first + text], "start": (at - offsets[text]).astype(np.int32),
                                "id": ids.iloc[first + text].to_numpy()})


def shared_core(low: int, high: int, left: int) -> slice:
    """The bytes of a slice that lie in every string which starts `low` to `high` - 1 bytes before its anchor."""
    return slice(left - low, left - high + 1 + MATCH)


def _digest(data: bytes, size: int = 16) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def _context_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keys, wanted = batch["key"].to_numpy(), batch["anchors"].tolist()
        for first, last, data, offsets in text_blocks(batch["text"].tolist()):
            text, hashes, at, starts, left = anchors(np.frombuffer(data, np.uint8), offsets)
            held = np.zeros(len(at), bool)
            for row in range(first, last):
                mine = slice(*np.searchsorted(text, [row - first, row - first + 1]))
                held[mine] = np.isin(hashes[mine], wanted[row])
            text, hashes, at, starts, left = text[held], hashes[held], at[held], starts[held], left[held]
            pieces = [data[a:a + n - 1 + MATCH] for a, n in zip(at.tolist(), starts.tolist())]
            yield pd.DataFrame({
                "key": keys[first + text], "start": (at - offsets[text]).astype(np.int32),
                "bucket": hashes, "context": [_digest(piece) for piece in pieces], "low": np.int32(0), "high": np.int32(WINDOWS),
                "left": left.astype(np.int32), "starts": starts.astype(np.int32), "bytes": pieces})


def _halves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The starts of each slice in two slices, by their distance before the anchor."""
    for batch in batches:
        rows = []
        for key, low, high, left, starts, data in batch[["context", "low", "high", "left", "starts", "bytes"]].itertuples(index=False):
            middle = (low + high) // 2
            for a, b in ((low, middle), (middle, high)):
                first, last = max(0, left - b + 1), min(starts, left - a + 1)
                if first < last:
                    piece = data[first:last - 1 + MATCH]
                    bucket = int.from_bytes(_digest(data[shared_core(a, b, left)], 8), "little", signed=True)
                    rows.append((key, first, bucket, _digest(piece), a, b, left - first, last - first, piece))
        yield pd.DataFrame(rows, columns=["key", "start", "bucket", "context", "low", "high", "left", "starts", "bytes"])


# ---- Difference cover -----------------------------------------------------------------------------

def suffix_order(symbols: np.ndarray, depth: int, covered: int = 1) -> np.ndarray:
    """Positions of `symbols` (1 and up, fewer than 2^21) in the order of their suffixes, exact up to `depth` letters.

    `covered` is the number of letters that a symbol stands for; suffixes equal that far are in any order.
    """
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    padded = np.concatenate([symbols, np.zeros(3, np.int64)])
    # Where n is 1 mod 3, an empty suffix keeps the two halves of the name string apart.
    top = n + (n % 3 == 1)
    sample = np.concatenate([np.arange(1, top, 3), np.arange(2, top, 3)])
    triples = _packed(padded[sample], padded[sample + 1], padded[sample + 2])
    order = np.argsort(triples, kind="stable")
    new = np.ones(len(order), np.int64)
    new[1:] = triples[order][1:] != triples[order][:-1]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new)
    if new.sum() < len(order) and 3 * covered < depth:
        order = suffix_order(names, depth, 3 * covered)
    ranks = np.zeros(n + 4, np.int64)
    ranks[sample[order]] = np.arange(1, len(order) + 1)

    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(_packed(padded[rest], ranks[rest + 1]), kind="stable")]
    ranked = sample[order]
    ranked = ranked[ranked < n]
    one, two = ranked[ranked % 3 == 1], ranked[ranked % 3 == 2]
    before = np.searchsorted(np.sort(_packed(padded[one], ranks[one + 1])), _packed(padded[rest], ranks[rest + 1]))
    before += np.searchsorted(np.sort(_packed(padded[two], padded[two + 1], ranks[two + 2])),
                              _packed(padded[rest], padded[rest + 1], ranks[rest + 2]))
    # Among suffixes equal up to the depth the two counts may disagree by places within that group.
    before = np.maximum.accumulate(before)
    merged = np.full(n, -1, np.int64)
    merged[before + np.arange(len(rest))] = rest
    merged[merged < 0] = ranked
    return merged


def _packed(*columns: np.ndarray) -> np.ndarray:
    out = columns[0]
    for column in columns[1:]:
        out = out << _SYMBOL_BITS | column
    return out


def equal_starts(contexts: list[bytes], starts: list[int]) -> list[np.ndarray]:
    """For each context, which of its starts has the same MATCH bytes as a start of another context."""
    data = b"".join(context + b"\0" for context in contexts)
    begin = np.cumsum([0, *[len(context) + 1 for context in contexts]])
    codes = np.frombuffer(data, np.uint8)
    symbols = codes.astype(np.int64) + 2
    symbols[begin[1:] - 1] = 1
    is_start = np.zeros(len(codes), bool)
    for at, n in zip(begin, starts):
        is_start[at:at + n] = True
    order = suffix_order(symbols, MATCH)
    order = order[is_start[order]]
    one, other = order[:-1], order[1:]
    # Eight bytes at a time from the end, where neighbours that differ mostly do.
    words = np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))
    for at in range(MATCH - 8, -1, -8):
        same = words[one + at] == words[other + at]
        one, other = one[same], other[same]
    repeated = np.zeros(len(codes), bool)
    repeated[one] = repeated[other] = True
    return [repeated[at:at + n] for at, n in zip(begin, starts)]


def _runs(flags: np.ndarray) -> list[dict]:
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return [{"a": int(a), "b": int(b)} for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))]


RUNS = "array<struct<a:int,b:int>>"


def _sorted_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by bucket; whole buckets are sorted together while they are small."""
    waiting: list[tuple] = []
    size, bucket, began = 0, None, 0

    def done() -> pd.DataFrame:
        found = equal_starts([row[2] for row in waiting], [row[1] for row in waiting])
        rows = [(row[0], _runs(flags)) for row, flags in zip(waiting, found) if flags.any()]
        return pd.DataFrame(rows, columns=["context", "runs"])

    for batch in batches:
        for row in zip(batch["context"], batch["starts"], batch["bytes"], batch["bucket"]):
            if row[3] != bucket:
                # Starts of one context lie at different distances from its anchor, so a lone context repeats nothing.
                if len(waiting) - began == 1:
                    size -= len(waiting.pop()[2])
                if size > SORTED_BYTES:
                    yield done()
                    waiting, size = [], 0
                bucket, began = row[3], len(waiting)
            waiting.append(row)
            size += len(row[2])
    if waiting:
        yield done()


# ---- Operator -------------------------------------------------------------------------------------

def _kept(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
    rows = []
    for text, spans in zip(texts, runs):
        data, kept, at, merged = text.encode("utf-8", "surrogatepass"), [], 0, []
        for a, b in sorted((span["a"], span["b"]) for span in spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in merged:
            kept.append(data[at:a])
            at = b
        left = b"".join([*kept, data[at:]])
        rows.append((len(data) - len(left), len(merged), hashlib.sha256(left).hexdigest()))
    return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256"])


def _settled(placed: DataFrame) -> DataFrame:
    """(context, runs of its repeated starts) of rows (key, start, slice); crowded buckets are halved until none is left."""
    place = F.xxhash64("key", "start")
    slices = ("bucket", "low", "high", "left", "starts", "bytes")
    unique = cut(placed.groupBy("context").agg(F.min(place).alias("one"), F.max(place).alias("other"),
                                               *[F.first(name).alias(name) for name in slices]))
    runs = unique.where("one <> other").select("context", F.array(F.struct(
        F.lit(0).alias("a"), F.col("starts").alias("b"))).alias("runs"))
    crowded = cut(unique.groupBy("bucket").agg(F.count(F.lit(1)).alias("held"), F.min(F.col("high") - F.col("low")).alias("distances"))
                  .where(f"held > {BUCKET} and distances > 1").select("bucket"))
    number, calm = crowded.count(), unique
    if number:
        crowded = F.broadcast(crowded) if number <= MOST_BROADCAST else crowded
        calm = unique.join(crowded, "bucket", "left_anti")
        halves = cut(unique.join(crowded, "bucket", "left_semi").mapInPandas(_halves, f"key binary, start int, {SLICE}"))
        runs = runs.unionByName(_moved(halves.select("key", "start", "context"), _settled(halves), 0)
                                .withColumnRenamed("key", "context"))
    return runs.unionByName(calm.repartition("bucket").sortWithinPartitions("bucket").select(
        "context", "starts", "bytes", "bucket").mapInPandas(_sorted_buckets, f"context binary, runs {RUNS}"))


def _moved(placed: DataFrame, runs: DataFrame, longer: int) -> DataFrame:
    """(key, runs) with the runs of each context moved to its start in the key, their ends by `longer` more."""
    return placed.join(runs, "context").select("key", F.transform("runs", lambda run: F.struct(
        (F.col("start") + run["a"]).alias("a"), (F.col("start") + run["b"] + longer).alias("b"))).alias("runs"))


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, text) of the texts that hold an anchor seen elsewhere, and (key, runs) of their repeated bytes."""
    # As text, since pandas would make doubles of numbers beside nulls.
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), _key(F.sha2("text", 256)).alias("key"), "text").where(
        F.octet_length("text") >= MATCH)
    rows = texts.mapInPandas(_anchor_rows, "anchor bigint, key binary, start int, id string")
    place = F.xxhash64("key", "start")
    # Written first: a join that also aggregates one side cannot split the rows of a hot anchor.
    shared = cut(rows.groupBy("anchor").agg(F.min(place).alias("one"), F.max(place).alias("other")).where(
        "one <> other").select("anchor"))
    wanted = rows.join(shared, "anchor").groupBy("key").agg(F.min("id").alias("w_id"), F.collect_set("anchor").alias("anchors"))
    wanted = wanted.withColumnRenamed("key", "w_key")
    near = cut(texts.join(wanted, F.col("id").eqNullSafe(F.col("w_id")) & (F.col("key") == F.col("w_key")))
               .select("key", "text", "anchors"))

    contexts = near.mapInPandas(_context_rows, f"key binary, start int, {SLICE}")
    runs = _moved(contexts.select("key", "start", "context"), _settled(contexts), MATCH - 1)
    return near.select("key", "text"), runs.groupBy("key").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def _key(digest):
    return F.unhex(F.substring(digest, 1, 32))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    near, runs = repeated_spans(docs)
    # Written before the join below, which can then split the rows of a text in very many copies.
    cleaned = cut(near.dropDuplicates(["key"]).join(runs, "key").select("key", F.pandas_udf(
        _kept, "n_removed bigint, n_spans bigint, kept_sha256 string")("text", "runs").alias("r")))
    base = docs.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    base = base.withColumn("key", _key(F.col("whole")))
    copies = cut(base.groupBy("key").agg(F.count(F.lit(1)).alias("copies")))
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= MATCH)
    return base.join(copies, "key").join(cleaned, "key", "left").select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("r.n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("r.n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("r.kept_sha256", "whole")).alias("kept_sha256"))


def suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
