"""Benchmark decontamination by winnowing.

Of every WINNOW neighbouring k-gram hashes the least is kept as a fingerprint, on both sides. Two texts that
share SPAN words in a row (SPAN = GRAM + WINNOW - 1) share every k-gram hash of that span, so they
keep the same least one: each shared span of SPAN words or more shows up in the join of the fingerprints. A
hit is then extended word by word to the windows of the item that contain it; only equal words count.

An item of fewer than SPAN words has one window, itself; it is filed by the hash of all its words.

Benchmark fingerprints are measured. Up to `broadcast_rows` of them (16 bytes each) are sent to the tasks
and joined there in one pass over the documents, with no shuffle. Beyond, fingerprints of both
sides meet in a shuffled join on the hash, which is distinct on the benchmark's side per (hash, item), and only
documents with a hit are extended.

Defined results: words are runs of letters, digits and all beyond ASCII, A-Z lower-cased; a null or empty
text has none; an item without words has no window; a null item_id is never listed but its windows
count as hits; repeated items count once per item_id; repeated documents each get their row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.llm.blocks import LOWER, PLAIN, gram_hashes, span_hashes, text_blocks, windowed_min, word_bounds
from playtally.llm.storage import cut

SPAN, GRAM = 10, 6
WINNOW = SPAN - GRAM + 1
BROADCAST_ROWS = 2_000_000
RESULT = "n_words bigint, n_hit bigint, n_items bigint, items array<string>, hit_spans array<struct<start:int,end:int>>"


class Words:
    """The words of a block of texts: bounds, hashes and the range of words of each text."""

    def __init__(self, data: bytes, offsets: np.ndarray):
        self.codes = LOWER[np.frombuffer(data, np.uint8)]
        self.data, self.offsets = self.codes.tobytes(), offsets
        self.starts, self.ends = word_bounds(self.codes, PLAIN)
        self.hashes = span_hashes(self.codes, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, offsets)
        self.grams = gram_hashes(self.hashes, GRAM)

    def text(self, a: int, b: int) -> bytes:
        """Words a to b (exclusive) with one blank between, the same wherever they stand."""
        return b" ".join([self.data[s:e] for s, e in zip(self.starts[a:b], self.ends[a:b])])

    def fingerprints(self) -> np.ndarray:
        """Positions of the kept k-grams, `grams` holds their hashes. Those across two texts are harmless."""
        n = len(self.grams)
        if n < WINNOW:
            return np.arange(n)
        # The position in the low bits makes the first of equal hashes win in every window.
        keyed = (self.grams & ~np.uint64(0xFFFFF)) | (np.arange(n, dtype=np.uint64) & np.uint64(0xFFFFF))
        low = windowed_min(keyed, WINNOW)
        at = np.concatenate([low[:1], low[1:][low[1:] != low[:-1]]]) & np.uint64(0xFFFFF)
        base = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
        return base + ((at.astype(np.int64) - base) & 0xFFFFF)


def short_hash(words: Words, a: int, b: int) -> np.uint64:
    return gram_hashes(words.hashes[a:b], b - a)[0]


class Index:
    """Windows of the items that a task needs, found by fingerprint."""

    def __init__(self, items: list[tuple[str | None, str | None]]):
        self.windows: dict[bytes, set] = {}
        self.short: dict[int, list] = {}
        prints = []
        for first, _, data, offsets in text_blocks([text for _, text in items]):
            words = Words(data, offsets)
            prints.append(words.grams[words.fingerprints()])
            for row in range(len(offsets) - 1):
                a, b = words.first[row], words.first[row + 1]
                item = items[first + row][0]
                for at in range(a, max(a, b - SPAN) + 1 if b > a else a):
                    self.windows.setdefault(words.text(at, min(at + SPAN, b)), set()).add(item)
                if 0 < b - a < SPAN:
                    self.short.setdefault(b - a, []).append(short_hash(words, a, b))
        self.prints = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64)
        self.short = {n: np.unique(np.array(hashes, np.uint64)) for n, hashes in self.short.items()}

    def __getstate__(self):
        return {"windows": self.windows, "short": self.short, "prints": self.prints}

    def places(self, words: Words) -> list[tuple[int, int]]:
        """(first word, length) of the windows of the block that may be an item's: near a shared fingerprint."""
        kept = words.fingerprints()
        shared = kept[np.isin(words.grams[kept], self.prints)] if len(kept) else kept
        places = {(at, SPAN) for hit in shared.tolist()
                  for at in range(max(0, hit - SPAN + GRAM), hit + 1)}
        for n, hashes in self.short.items():
            grams = gram_hashes(words.hashes, n)
            places |= {(at, n) for at in np.flatnonzero(np.isin(grams, hashes)).tolist()}
        return sorted(places)

    def match(self, texts: list) -> pd.DataFrame:
        rows = []
        for _, _, data, offsets in text_blocks(texts):
            words = Words(data, offsets)
            places = self.places(words)
            owners = np.searchsorted(words.first, [at for at, _ in places], "right") - 1
            found: dict[int, list] = {}
            for (at, n), owner in zip(places, owners.tolist()):
                if at + n <= words.first[owner + 1]:
                    items = self.windows.get(words.text(at, at + n))
                    if items is not None:
                        found.setdefault(owner, []).append((at, at + n, items))
            for row in range(len(offsets) - 1):
                rows.append(self._row(words, row, found.get(row, [])))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "n_items", "items", "hit_spans"])

    @staticmethod
    def _row(words: Words, row: int, found: list) -> tuple:
        """Counts, items and the byte spans of the runs of hit words, relative to the text."""
        begin, runs, items = words.offsets[row], [], set()
        for a, b, names in sorted(found, key=lambda hit: hit[:2]):
            items |= names
            if runs and a <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], b)
            else:
                runs.append([a, b])
        spans = [{"start": int(words.starts[a] - begin), "end": int(words.ends[b - 1] - begin)} for a, b in runs]
        listed = sorted(item for item in items if item is not None)
        return (int(words.first[row + 1] - words.first[row]), sum(b - a for a, b in runs), len(listed), listed, spans)


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")


def _prints_of(texts: list) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes): what a text is filed under. Every k-gram that a text may share by itself is among them."""
    for first, _, data, offsets in text_blocks(texts):
        words = Words(data, offsets)
        kept = words.fingerprints()
        for row in range(len(offsets) - 1):
            mine = kept[slice(*np.searchsorted(kept, words.first[row:row + 2]))]
            yield first + row, words.grams[mine]


def _fingerprint_rows(keyed: DataFrame, lengths: list[int] | None) -> DataFrame:
    """(key, hash) of each text; `lengths` adds the hash of every run of that many words (None: short texts whole)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, texts = batch["key"].tolist(), batch["text"].tolist()
            for row, hashes in _prints_of(texts):
                _, _, data, offsets = next(text_blocks([texts[row]]))
                words = Words(data, offsets)
                n = len(words.starts)
                wanted = ([n] if 0 < n < SPAN else []) if lengths is None else [k for k in lengths if k <= n]
                found = np.unique(np.concatenate([hashes, *[gram_hashes(words.hashes, k) for k in wanted]]))
                yield pd.DataFrame({"key": keys[row], "hash": found.view(np.int64)})

    return keyed.select("key", "text").mapInPandas(run, "key string, hash bigint")


def _match_joined(docs: DataFrame, items: DataFrame, into: str) -> DataFrame:
    """Beyond the broadcast size: fingerprints meet in a shuffled join, then each hit document gets its items."""
    spark = docs.sparkSession
    items = cut(items.withColumn("key", F.sha2("text", 256)))
    sizes = F.size(F.expr(r"regexp_extract_all(lower(text), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', 0)"))
    lengths = [row[0] for row in items.select(sizes.alias("n")).where(f"n between 1 and {SPAN - 1}").distinct().collect()]
    named = docs.withColumn("__key", F.sha2(F.coalesce("text", F.lit("")), 256))
    filed = _fingerprint_rows(items, None).distinct().withColumnRenamed("key", "item_key")
    texts = named.select(F.col("__key").alias("key"), "text")
    hits = (_fingerprint_rows(texts, lengths).distinct().join(filed, "hash").select("key", "item_key").distinct()
            .join(items.select(F.col("key").alias("item_key"), "item_id", F.col("text").alias("item_text")).distinct(),
                  "item_key")
            .groupBy("key").agg(F.collect_set(F.struct("item_id", "item_text")).alias("items")))

    def extend(texts: pd.Series, items: pd.Series) -> pd.DataFrame:
        made = [Index([(item["item_id"], item["item_text"]) for item in ([] if near is None else near)]).match([text])
                for text, near in zip(texts, items)]
        return pd.concat(made) if made else Index([]).match([])

    joined = named.join(hits.select(F.col("key").alias("__key"), F.col("items").alias("__items")), "__key", "left")
    return joined.withColumn(into, F.pandas_udf(extend, RESULT)("text", "__items")).drop("__key", "__items")


def match(docs: DataFrame, benchmark: DataFrame, into: str = "leak", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`docs` with a struct column `into`: words, hit words, items with occurring windows and byte spans of hits."""
    items = _items(benchmark)
    words = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if words > broadcast_rows:
        return _match_joined(docs, items, into)
    shared = docs.sparkSession.sparkContext.broadcast(Index([tuple(row) for row in items.collect()]))
    return docs.withColumn(into, F.pandas_udf(lambda texts: shared.value.match(texts.tolist()), RESULT)("text"))


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = match(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "leak.n_words", "leak.n_hit", "leak.n_items",
                        F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"),
                        (F.col("leak.n_hit") > 0).alias("contaminated"))


_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""with docs as (select doc_id, regexp_extract_all({_LOWER}, {_WORD}) as w from documents),
items as (select item_id, regexp_extract_all({_LOWER}, {_WORD}) as w from benchmark),
item_windows as (
  select item_id, len(w) as n, list_slice(w, i, i + least(len(w), {SPAN}) - 1) as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - {SPAN}, 0) + 2)) as i from items where len(w) > 0)),
sizes as (select distinct len(win) as n from item_windows),
doc_windows as (
  select doc_id, i, n, list_slice(w, i, i + n - 1) as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, sizes where len(w) >= n)),
hits as (select doc_id, i, d.n, item_id from doc_windows d join item_windows using (win)),
hit_words as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by 1),
hit_items as (
  select doc_id, count(distinct item_id) as n_items,
    string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as listed from hits group by 1)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit_words using (doc_id) left join hit_items using (doc_id)"""
