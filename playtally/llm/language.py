"""Language identification by prediction by partial matching.

For each language a variable-order context tree over bytes: nodes of up to three bytes hold the counts
of what followed. A symbol seen in a context costs -log2 of its share; an unseen one costs the escape
(distinct followers over total plus distinct) and then its cost in the context shorter by a byte, down
to the uniform code. The code length of a text is exact under these frozen counts; the shortest wins.

Bytes are folded to 43 symbols first (a-z, white space and other ASCII, the low four bits of bytes
beyond ASCII), so a tree has at most 43^4 leaves per language, 14 MB as a table, at any corpus size. Contexts are
always three bytes, for any number of languages: a worker keeps the tables while all of them fit into TABLE_BYTES (up to
39 languages), and otherwise makes those of STEP languages at a time for each block of texts and lets them go.
Counting covers every learning row of every language and is summed per task before the shuffle.

Defined results: `und` and score 0 for a null text, one without a letter, or where nothing was learned;
rows with a null lang are not learned from; ties go to the first language by name; repeated rows count
as often as they occur; a null doc_id is held out. A letter is what Unicode calls one: no digit, fraction or exponent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtally.llm.blocks import text_blocks

ORDER, FOLDS = 3, 5
#: Languages whose tables are made and summed at once.
STEP = 8
SYMBOLS = 43
TABLE_BYTES = 512 << 20
UNKNOWN = "und"
_FOLD = np.zeros(256, np.int64)
_FOLD[ord("a"):ord("z") + 1] = _FOLD[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_FOLD[128:] = 27 + (np.arange(128) & 15)
#: Grams of a language that a task counts at once, grams of all that may wait, and the bytes of its sums before it passes them on.
_COUNT_CHUNK, _MOST_WAITING, _SUM_BYTES = 4 << 20, 16 << 20, 512 << 20


def grams(data: bytes) -> np.ndarray:
    """For each byte the number of the (context, symbol) string that ends there."""
    symbols = _FOLD[np.frombuffer(data, np.uint8)]
    out = symbols.copy()
    for back in range(1, ORDER + 1):
        out[back:] += symbols[:-back] * SYMBOLS ** back
    return out


def _texts_with_room(texts: list) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last, grams, begins, ends): ORDER newlines stand before each text as its first context."""
    for first, last, data, offsets in text_blocks(texts, gap=ORDER):
        yield first, last, grams(b"\n" * ORDER + data), offsets[:-1] + ORDER, offsets[1:]


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all rows of `docs` with a language and a text; grams are of order + 1 symbols."""
    size = SYMBOLS ** (order + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[str, list] = {}
        sums: dict[str, np.ndarray] = {}

        def add(lang: str) -> None:
            found = np.bincount(np.concatenate(waiting.pop(lang)) % size, minlength=size)
            sums[lang] = sums[lang] + found if lang in sums else found

        def summed() -> Iterator[pd.DataFrame]:
            while sums:
                lang, counts = sums.popitem()
                seen = np.flatnonzero(counts)
                yield pd.DataFrame({"lang": lang, "gram": seen, "n": counts[seen]})

        for batch in batches:
            langs = batch["lang"].tolist()
            for first, last, found, begins, ends in _texts_with_room(batch["text"].tolist()):
                for row in range(first, last):
                    waiting.setdefault(langs[row], []).append(found[begins[row - first]:ends[row - first]])
                sizes = {lang: sum(map(len, parts)) for lang, parts in waiting.items()}
                least = _COUNT_CHUNK if sum(sizes.values()) <= _MOST_WAITING else 0
                for lang in [lang for lang, grams_held in sizes.items() if grams_held > least]:
                    add(lang)
                    if len(sums) * size * 8 > _SUM_BYTES:
                        yield from summed()
        for lang in [*waiting]:
            add(lang)
            if len(sums) * size * 8 > _SUM_BYTES:
                yield from summed()
        yield from summed()

    learned = docs.where("lang is not null and text is not null").select("text", "lang")
    return learned.mapInPandas(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, longest: int = ORDER) -> np.ndarray:
    """Bits of each (context, symbol) string of longest + 1 symbols, from the counts of those strings."""
    by_order = [counts.astype(np.float64)]
    for order in range(longest, 0, -1):
        by_order.append(by_order[-1].reshape(SYMBOLS, SYMBOLS ** order).sum(axis=0))
    bits = np.full(SYMBOLS, np.log2(SYMBOLS))
    for level, seen in enumerate(reversed(by_order)):
        seen = seen.reshape(-1, SYMBOLS)
        total, distinct = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
        # A context never seen has nothing to escape from.
        escape = np.log2(np.maximum(total + distinct, 1) / np.maximum(distinct, 1))
        shorter = np.tile(bits, SYMBOLS if level else 1).reshape(seen.shape)
        bits = np.where(seen > 0, np.log2(np.maximum(total + distinct, 1) / np.maximum(seen, 1)), escape + shorter).ravel()
    return bits


class Model:
    """Counts by language as sparse arrays; the dense tables are made once in each worker."""

    def __init__(self, counts: pd.DataFrame, order: int = ORDER, table_bytes: int = TABLE_BYTES):
        parts = dict(tuple(counts.groupby("lang")))
        self.langs, self.order = sorted(parts), order
        self.sparse = [(parts[lang]["gram"].to_numpy(), parts[lang]["n"].to_numpy()) for lang in self.langs]
        self.kept = 4 * len(self.langs) * SYMBOLS ** (order + 1) <= table_bytes
        self.tables = {}

    def table(self, first: int) -> np.ndarray:
        """Code lengths of the languages from `first` on, STEP of them; kept only while the tables of all fit."""
        made = self.tables.get(first)
        if made is None:
            chosen = self.sparse[first:first + STEP]
            made = np.empty((SYMBOLS ** (self.order + 1), len(chosen)), np.float32)
            for i, (gram, n) in enumerate(chosen):
                counts = np.zeros(len(made), np.int64)
                counts[gram] = n
                made[:, i] = code_lengths(counts, self.order)
            if self.kept:
                self.tables[first] = made
        return made

    def _bits(self, found: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Code length of each text in each language, from running sums over some languages at a time."""
        out = np.empty((len(begins), len(self.langs)))
        for first in range(0, len(self.langs), STEP):
            sums = np.zeros((len(found) + 1, len(self.langs[first:first + STEP])))
            np.cumsum(self.table(first)[found], axis=0, dtype=np.float64, out=sums[1:])
            out[:, first:first + STEP] = sums[ends] - sums[begins]
        return out

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return names, scores
        for first, last, found, begins, ends in _texts_with_room(texts):
            bits = self._bits(found % SYMBOLS ** (self.order + 1), begins, ends)
            best = bits.argmin(axis=1)
            with np.errstate(over="ignore", under="ignore"):
                share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
            for row in range(first, last):
                if texts[row] and any(map(str.isalpha, texts[row])):
                    names[row], scores[row] = self.langs[best[row - first]], float(share[row - first])
        return names, scores


def fit(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> Model:
    """The model of all rows of `docs`, of contexts of ORDER bytes; a worker keeps its tables if they fit into `table_bytes`."""
    return Model(count_grams(docs, ORDER).toPandas(), ORDER, table_bytes)


def identify(docs: DataFrame, model: Model, into: str = "language") -> DataFrame:
    """`docs` with a struct column `into` of lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        names, scores = shared.value.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.withColumn(into, predicted("text"))


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == 0


def language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text", held_out().alias("held_out")), model).select(
        "doc_id", "held_out", "language.lang_pred", "language.score")
