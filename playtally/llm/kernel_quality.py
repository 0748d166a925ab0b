"""Quality classifier: a Gaussian kernel over document statistics, approximated by random Fourier features.

Each whole text becomes STATISTICS (shares of character classes, word and line lengths, repetition, entropy), scaled by
the training rows' means and deviations. sqrt(2 / n) cos(W x + b) with fixed random W and b turns the Gaussian kernel
into a plain product, so a kernel ridge fit is a linear one: every partition sums its part of the normal equations, the
parts are added in two rounds, and the driver solves one system of FREQUENCIES + 1 unknowns, whatever the corpus.

The sums are kept by fold (a hash of doc_id). So the ridge weight is chosen by cross-validation from the sums alone, and
the isotonic calibration (pool adjacent violators over CALIBRATION_BINS score bins) sees only scores of rows that
the scoring model was not fitted on.

Defined results: a null or empty text has statistics of zero and is scored like any other; a label of a doc_id that is
labelled several times is their mean, null labels are none; repeated documents count as often as they occur; a null
doc_id has no label and is not held out; without any label every score is 0.5, with labels of one value the
score is near that value; an empty table gives no rows. Numbers that are not finite cannot arise: every share has a floor of one
in its denominator. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtally.llm.blocks import LOWER, SPACED, byte_table, gram_hashes, span_hashes, text_blocks, word_bounds
from playtally.llm.storage import cut

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "letters", "capitals", "digits", "blanks", "line_breaks", "stops", "commas", "symbols",
    "pipes", "other_marks", "beyond_ascii", "entropy", "word_mean", "word_deviation", "short_words", "long_words", "letter_words",
    "different_words", "commonest_word", "repeated_pairs", "repeated_fives", "line_mean", "short_lines", "equal_lines", "ended_lines")
FREQUENCIES, FOLDS, BANDWIDTH, FARTHEST = 256, 4, 1.0, 5.0
RIDGES = (1e-5, 1e-4, 1e-3, 1e-2, 1e-1)
CALIBRATION_BINS, LEAST_RAW, MOST_RAW = 4096, -1.0, 2.0
SUM_GROUPS = 64
HELD_OUT_OF, HELD_OUT = 3, 1

_LETTERS, _CAPITALS, _DIGITS = (byte_table(bytes(range(*span))) for span in ((0x61, 0x7B), (0x41, 0x5B), (0x30, 0x3A)))
_STOPS, _COMMAS, _SYMBOLS, _PIPES = (byte_table(marks) for marks in (b".!?", b",;:", b"#*$%&<>_=~^\\{}[]", b"|"))
_MARKS = byte_table(bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum()))
_WORD_LETTERS = _LETTERS | _CAPITALS | byte_table(bytes(range(0x80, 0x100)))


def _by_owner(owners: np.ndarray, n: int, values: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owners, values, n).astype(np.float64)


def _repeats(owners: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """By owner: how many of its values are not the first of their kind, and how often its commonest one occurs."""
    order = np.lexsort((values, owners))
    owners, values = owners[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    first = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, owners[first], np.diff(np.append(first, len(values))))
    return _by_owner(owners[~new], n), most


def statistics(texts: list) -> np.ndarray:
    """One row of STATISTICS for each text."""
    return np.concatenate([np.zeros((0, len(STATISTICS))), *[_block_statistics(data, offsets) for _, _, data, offsets in text_blocks(texts)]])


def _block_statistics(data: bytes, offsets: np.ndarray) -> np.ndarray:
    codes, n = np.frombuffer(data, np.uint8), len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    # The newline after each text is not part of it.
    inside = np.ones(len(codes), bool)
    inside[offsets[1:] - 1] = False
    histogram = np.bincount(owner[inside] * 256 + codes[inside], minlength=256 * n).reshape(n, 256).astype(np.float64)
    size = histogram.sum(axis=1)
    share = histogram / np.maximum(size, 1)[:, None]
    of = lambda table: share[:, table].sum(axis=1)

    starts, ends = word_bounds(codes, SPACED)
    lengths, word_owner = (ends - starts).astype(np.float64), owner[starts]
    words = _by_owner(word_owner, n)
    per_word = np.maximum(words, 1)
    mean = _by_owner(word_owner, n, lengths) / per_word
    square = _by_owner(word_owner, n, lengths * lengths) / per_word
    lettered = np.concatenate([[0], np.cumsum(_WORD_LETTERS[codes])])
    hashes = span_hashes(LOWER[codes], starts, ends)
    word_repeats, commonest = _repeats(word_owner, hashes, n)
    grams = []
    for k in (2, 5):
        whole = word_owner[:len(hashes) - k + 1] == word_owner[k - 1:] if len(hashes) >= k else np.zeros(0, bool)
        grams.append(_repeats(word_owner[:len(whole)][whole], gram_hashes(hashes, k)[whole], n)[0] / per_word)

    breaks = np.flatnonzero(codes == 0x0A)
    line_starts = np.concatenate([[0], breaks[:-1] + 1])
    used = breaks > line_starts
    line_starts, line_ends = line_starts[used], breaks[used]
    line_owner = owner[line_starts]
    lines = _by_owner(line_owner, n)
    per_line = np.maximum(lines, 1)
    line_words = np.searchsorted(starts, line_ends) - np.searchsorted(starts, line_starts)
    equal_lines, _ = _repeats(line_owner, span_hashes(codes, line_starts, line_ends), n)
    logs = np.log2(share, out=np.zeros_like(share), where=share > 0)
    return np.column_stack([
        np.log1p(size), np.log1p(words), np.log1p(lines), of(_LETTERS), of(_CAPITALS), of(_DIGITS), share[:, 0x20], share[:, 0x0A],
        of(_STOPS), of(_COMMAS), of(_SYMBOLS), of(_PIPES), of(_MARKS & ~(_STOPS | _COMMAS | _SYMBOLS | _PIPES)), share[:, 0x80:].sum(axis=1),
        -(share * logs).sum(axis=1), mean, np.sqrt(np.maximum(square - mean * mean, 0)),
        _by_owner(word_owner[lengths <= 3], n) / per_word, _by_owner(word_owner[lengths >= 12], n) / per_word,
        _by_owner(word_owner[lettered[ends] - lettered[starts] == lengths], n) / per_word,
        1 - word_repeats / per_word, commonest / per_word, *grams,
        np.log1p(_by_owner(line_owner, n, line_words.astype(np.float64)) / per_line),
        _by_owner(line_owner[line_words < 5], n) / per_line, equal_lines / per_line,
        _by_owner(line_owner[_STOPS[codes[line_ends - 1]]], n) / per_line])


def with_statistics(docs: DataFrame, into: str = "statistics") -> DataFrame:
    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series(list(statistics(texts.tolist())), dtype=object)

    return docs.withColumn(into, measured("text"))


# ---- Model ----------------------------------------------------------------------------------------

@dataclass
class Fourier:
    """Scaled statistics to random Fourier features, the constant last. Equal in every worker."""
    mean: np.ndarray
    deviation: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(20240607)
        weights = rng.standard_normal((len(self.mean), FREQUENCIES)) / (BANDWIDTH * np.sqrt(len(self.mean)))
        phases = rng.uniform(0, 2 * np.pi, FREQUENCIES)
        scaled = np.clip((x - self.mean) / np.where(self.deviation > 0, self.deviation, 1), -FARTHEST, FARTHEST)
        return np.column_stack([np.sqrt(2 / FREQUENCIES) * np.cos(scaled @ weights + phases), np.ones(len(x))])


@dataclass
class Model:
    fourier: Fourier
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def _scaling(labelled: DataFrame) -> Fourier:
    """Means and deviations of the statistics over all labelled rows."""
    numbers = [F.col("statistics")[i] for i in range(len(STATISTICS))]
    row = labelled.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(numbers)], *[F.stddev_pop(c).alias(f"d{i}") for i, c in enumerate(numbers)]).first()
    return Fourier(*(np.array([row[f"{kind}{i}"] or 0.0 for i in range(len(STATISTICS))]) for kind in "md"))


def normal_equations(labelled: DataFrame, fourier: Fourier) -> np.ndarray:
    """By fold the matrix [Z y]' [Z y] over all labelled rows: each partition adds up its own, then these are added."""
    width = FREQUENCIES + 2
    shared = labelled.sparkSession.sparkContext.broadcast(fourier)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((FOLDS, width, width))
        for batch in batches:
            if not len(batch):
                continue
            z = np.column_stack([shared.value.features(np.stack(batch["statistics"])), batch["label"].to_numpy(float)])
            folds = batch["fold"].to_numpy()
            for fold in range(FOLDS):
                part = z[folds == fold]
                sums[fold] += part.T @ part
        yield pd.DataFrame({"line": range(width), "part": TaskContext.get().partitionId(), "sums": list(sums.transpose(1, 0, 2).reshape(width, -1))})

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        return pd.DataFrame({"line": rows["line"].iloc[:1], "part": rows["part"].iloc[:1], "sums": [np.sum(np.stack(rows["sums"]), axis=0)]})

    schema = "line int, part int, sums array<double>"
    parts = labelled.select("statistics", "label", "fold").mapInPandas(run, schema)
    # Two rounds, so that no task holds the lines of all partitions.
    some = parts.groupBy("line", F.pmod("part", F.lit(SUM_GROUPS)).alias("some")).applyInPandas(added, schema)
    lines = {row["line"]: row["sums"] for row in some.groupBy("line").applyInPandas(added, schema).collect()}
    if not lines:  # a frame without any partition
        return np.zeros((FOLDS, width, width))
    return np.array([lines[i] for i in range(width)]).reshape(width, FOLDS, width).transpose(1, 0, 2)


def _solved(sums: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge weights from [Z y]'[Z y]; the constant is not held down."""
    n = max(sums[-2, -2], 1.0)
    held = np.append(np.full(FREQUENCIES, ridge * n), 1e-9)
    return np.linalg.solve(sums[:-1, :-1] + np.diag(held), sums[:-1, -1])


def _square_error(sums: np.ndarray, weights: np.ndarray) -> float:
    signed = np.append(weights, -1.0)
    return float(signed @ sums @ signed)


def best_ridge(by_fold: np.ndarray) -> float:
    """The ridge weight with the least square error on folds that it was not fitted on."""
    total = by_fold.sum(axis=0)
    return min(RIDGES, key=lambda ridge: sum(_square_error(fold, _solved(total - fold, ridge)) for fold in by_fold))


def pooled(n: np.ndarray, positive: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: mean raw score and share of positives (one half more on either side) of each pool, both rising."""
    pools: list[list[float]] = []
    for one in zip(n.tolist(), positive.tolist(), raw.tolist()):
        pools.append(list(one))
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    made = np.array(pools)
    return made[:, 2] / made[:, 0], np.maximum.accumulate((made[:, 1] + 0.5) / (made[:, 0] + 1))


def _calibration(labelled: DataFrame, models: list[Model]) -> pd.DataFrame:
    """Rows, sum of labels and of raw scores by bin of the raw score, each row scored by the model of the other folds."""
    shared = labelled.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("double")
    def raw(x: pd.Series, folds: pd.Series) -> pd.Series:
        x, folds, out = np.stack(x), folds.to_numpy(), np.zeros(len(folds))
        for fold, model in enumerate(shared.value):
            if (folds == fold).any():
                out[folds == fold] = model.raw(x[folds == fold])
        return pd.Series(np.clip(out, LEAST_RAW, MOST_RAW))

    scored = labelled.select("label", raw("statistics", "fold").alias("raw"))
    place = F.floor((F.col("raw") - LEAST_RAW) * (CALIBRATION_BINS / (MOST_RAW - LEAST_RAW)))
    return scored.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive"),
                                                  F.sum("raw").alias("raw")).toPandas().sort_values("bin")


def fit(labelled: DataFrame) -> Model:
    """From all rows of (statistics, label 0 to 1, fold). What reaches the driver does not grow with them."""
    fourier = _scaling(labelled)
    by_fold = normal_equations(labelled, fourier)
    total = by_fold.sum(axis=0)
    if total[-2, -2] == 0:
        return Model(fourier, np.zeros(FREQUENCIES + 1), np.array([0.0]), np.array([0.5]))
    ridge = best_ridge(by_fold)
    none = np.array([0.0])
    others = [Model(fourier, _solved(total - fold, ridge), none, none) for fold in by_fold]
    bins = _calibration(labelled, others)
    return Model(fourier, _solved(total, ridge), *pooled(*(bins[name].to_numpy(float) for name in ("n", "positive", "raw"))))


def score(measured: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """`measured` (with column statistics) and its score, 0 to 1."""
    shared = measured.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.stack(x)) if len(x) else [], dtype=float)

    return measured.withColumn(into, scored("statistics"))


# ---- Query ----------------------------------------------------------------------------------------

def _hash() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def held_out() -> Column:
    return _hash() % HELD_OUT_OF == HELD_OUT


def with_labels(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(statistics, label, fold) of the rows to learn from."""
    # One row a document, written first: a join that aggregates one side could not split a hot doc_id of the other.
    known = cut(labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("label")))
    fold = F.pmod(F.floor(_hash() / HELD_OUT_OF), F.lit(FOLDS)).cast("int").alias("fold")
    return measured.where(~held_out()).join(known, "doc_id").select("statistics", F.least(F.greatest("label", F.lit(0.0)), F.lit(1.0)).alias("label"), fold)


def quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    # The texts are read once; their statistics are a few percent of them.
    measured = cut(with_statistics(docs).select("doc_id", held_out().alias("held_out"), "statistics"))
    model = fit(cut(with_labels(measured, labels)))
    return score(measured, model).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
