"""Secrets in texts: three base patterns, and a randomness battery for whatever else looks like a key.

Candidates are runs of 16 or more key characters; '=' is only padding at their end, so a name and its value are two. Where
no encoding fits a run (signs of both base64 alphabets in one), its longest parts of 16 or more characters that fit one
are the candidates; they may overlap. For each, the encoding is inferred (hex, base32, base64, URL-safe base64
or letters and digits) and three tests ask whether its characters can be uniform draws of
that alphabet: chi-squared uniformity, the runs test about the middle of the alphabet, and serial
correlation at lag one. The least of the three p-values, times three, is the battery's p-value.

Not looking unrandom is no evidence for a short string, so each candidate is also tested against ordinary
text, in which the kind of character (lower, upper, digit, sign) rarely changes: the Chernoff bound on that many
changes is a p-value that shrinks with the length. False discoveries are controlled per length class by
the Benjamini-Hochberg rule over all candidates of the corpus, whose p-values are counted in bins of a tenth of a
power of ten (always rounded up), a table of bounded size. A candidate is reported when it is a discovery of its class, the
battery does not reject randomness, and no base span overlaps it.

Everything is built from DataFrame functions: two scans, no Python, no shuffle beyond the counts of the bins.

Defined results: a null text is empty; repeated rows get the same spans and count as often; without candidates
there is nothing to discover; offsets are code points, end exclusive; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}"
CANDIDATE = "[A-Za-z0-9+/_-]{16,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?"
#: Parts of a run that no encoding fits.
PARTS = ("[A-Za-z0-9+/]{16,}={0,2}", "[A-Za-z0-9_-]{16,}={0,2}")
MIN_ASSIGNED = 12
#: Share of neighbours of different kind in ordinary text, false discovery rate, level of the battery.
TEXT_CHANGES, FALSE_DISCOVERIES, BATTERY_LEVEL = 0.05, 0.001, 0.001
BINS_PER_DECADE, MOST_BINS = 10, 400
LENGTH_CLASSES = (24, 40, 80)

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    ("^[A-Za-z0-9+/]+={0,2}$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("^[A-Za-z0-9_-]+={0,2}$", _UPPER + _LOWER + _DIGITS + "-_"),
)


def _matches(text: Column, kind: str, pattern: str, valid) -> Column:
    """array<struct<start, kind, end>> of the matches that are `valid`; the pattern's gaps give the places."""
    group = F.regexp_extract_all(text, F.lit(pattern), F.lit(1 if kind == "assign" else 0))
    rows = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), group.alias("value"),
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"))
    empty = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")

    def step(seen: Column, row: Column) -> Column:
        start = seen["at"] + row["gap"]
        end = start + F.length(row["found"])
        span = F.array(F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.coalesce(valid(row["value"]), F.lit(False)), F.concat(seen["out"], span))
                        .otherwise(seen["out"]).alias("out"))

    spans = F.aggregate(rows, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda seen: seen["out"])
    # Most texts hold none: one test of the pattern is all they cost.
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def base_spans(text: Column) -> Column:
    """All base spans, by start and then kind."""
    always = lambda value: value.isNotNull()
    return F.array_sort(F.concat(
        _matches(text, "assign", ASSIGN, lambda value: F.length(value) >= MIN_ASSIGNED),
        _matches(text, "access", ACCESS, always), _matches(text, "hex", HEX, always)))


# ---- Battery --------------------------------------------------------------------------------------

def _upper_tail(z: Column) -> Column:
    """P(normal > z), by the usual five-term polynomial (absolute error below 10^-7)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def battery(token: Column) -> Column:
    """p-value of randomness of a token under its inferred encoding; 0 where no encoding fits."""
    plain = F.regexp_replace(token, "=+$", "")
    alphabet = F.lit(None).cast("string")
    for pattern, letters in reversed(ENCODINGS):
        alphabet = F.when(token.rlike(pattern), F.lit(letters)).otherwise(alphabet)

    def tests(known: Column) -> Column:
        letters, size, n = known["letters"], F.length(known["letters"]), F.length(known["plain"]).cast("double")

        def of(places: Column) -> Column:
            squares = F.aggregate(F.array_distinct(places), F.lit(0.0), lambda total, one: total + F.pow(
                F.size(F.filter(places, lambda x: x == one)).cast("double"), F.lit(2.0)))
            chi = (squares * size / n - n - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
            pairs = F.arrays_zip(F.slice(places, F.lit(1), F.size(places) - 1).alias("x"),
                                 F.slice(places, F.lit(2), F.size(places) - 1).alias("y"))
            high = lambda x: (2 * x > size).cast("double")
            above = F.aggregate(places, F.lit(0.0), lambda total, x: total + high(x))
            runs = 1 + F.aggregate(pairs, F.lit(0.0), lambda total, p: total + F.abs(high(p["x"]) - high(p["y"])))
            both = 2 * above * (n - above)
            spread = F.sqrt(F.greatest(both * (both - n) / (n * n * (n - 1)), F.lit(1e-9)))
            runs_p = F.when(both > 0, 2 * _upper_tail(F.abs((runs - both / n - 1) / spread))).otherwise(F.lit(0.0))
            mean = F.aggregate(places, F.lit(0.0), lambda total, x: total + x) / n
            power = F.aggregate(places, F.lit(0.0), lambda total, x: total + F.pow(x - mean, F.lit(2.0)))
            lagged = F.aggregate(pairs, F.lit(0.0), lambda total, p: total + (p["x"] - mean) * (p["y"] - mean))
            serial_p = F.when(power > 0, 2 * _upper_tail(F.abs((lagged / power + 1 / n) * F.sqrt(n)))).otherwise(F.lit(0.0))
            return F.least(F.lit(1.0), 3 * F.least(_upper_tail(chi), runs_p, serial_p))

        return _let(F.transform(F.split(known["plain"], ""), lambda c: F.position(c, letters)), of)

    return F.coalesce(_let(F.struct(plain.alias("plain"), alphabet.alias("letters")), tests), F.lit(0.0))


def changes_bin(token: Column) -> Column:
    """Bin of the p-value against ordinary text: floor of -10 log10 of the bound, at most MOST_BINS."""
    pairs = (F.length(token) - 1).cast("double")
    share = (F.length(F.regexp_replace(token, "[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+", "x")) - 1) / pairs
    rest = 1 - share
    divergence = share * F.log(share / TEXT_CHANGES) + F.when(rest > 0, rest * F.log(rest / (1 - TEXT_CHANGES))).otherwise(F.lit(0.0))
    bin_of = F.floor(pairs * divergence * (BINS_PER_DECADE / math.log(10))).cast("int")
    return F.when(share > TEXT_CHANGES, F.least(bin_of, F.lit(MOST_BINS))).otherwise(F.lit(0))


def length_class(token: Column) -> Column:
    return sum((F.length(token) >= bound).cast("int") for bound in LENGTH_CLASSES)


def _runs(text: Column, pattern: str) -> Column:
    """array<struct<start, token>> of the matches of a pattern."""
    rows = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("token"),
                        F.transform(F.split(text, pattern, -1), F.length).alias("gap"))
    empty = F.expr("cast(array() as array<struct<start:int,token:string>>)")

    def step(seen: Column, row: Column) -> Column:
        start = seen["at"] + row["gap"]
        run = F.array(F.struct(start.alias("start"), row["token"].alias("token")))
        return F.struct((start + F.length(row["token"])).alias("at"), F.concat(seen["out"], run).alias("out"))

    # The last gap has no match before it.
    matched = F.filter(rows, lambda row: row["token"].isNotNull())
    runs = F.aggregate(matched, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda seen: seen["out"])
    return F.when(text.rlike(pattern), runs).otherwise(empty)


def candidates(text: Column) -> Column:
    """array<struct<start, token>>: the runs that an encoding fits, and the parts of the others that one fits."""
    def tested(run: Column) -> Column:
        parts = F.concat(*[_runs(run["token"], part) for part in PARTS])
        moved = F.transform(parts, lambda part: F.struct((part["start"] + run["start"]).alias("start"), part["token"].alias("token")))
        return F.when(run["token"].rlike("|".join(pattern for pattern, _ in ENCODINGS)), F.array(run)).otherwise(moved)

    return F.flatten(F.transform(_runs(text, CANDIDATE), tested))


def discovery_bins(docs: DataFrame) -> list[int]:
    """Per length class the least bin that is a discovery, by the Benjamini-Hochberg rule over all candidates."""
    tokens = docs.select(F.explode(candidates(F.col("text"))["token"]).alias("token"))
    counts = tokens.groupBy(length_class(F.col("token")).alias("class"), changes_bin(F.col("token")).alias("bin")).count()
    bounds = [MOST_BINS + 1] * (len(LENGTH_CLASSES) + 1)
    by_class: dict[int, dict[int, int]] = {}
    for row in counts.collect():
        by_class.setdefault(row["class"], {})[row["bin"]] = row["count"]
    for size, bins in by_class.items():
        total, found = sum(bins.values()), 0
        for place in sorted(bins, reverse=True):
            found += bins[place]
            if 10 ** (-place / BINS_PER_DECADE) * total <= FALSE_DISCOVERIES * found:
                bounds[size] = place
    return bounds


def random_spans(text: Column, base: Column, bounds: list[int]) -> Column:
    def valid(token: Column) -> Column:
        least = F.element_at(F.array(*map(F.lit, bounds)), length_class(token) + 1)
        return (changes_bin(token) >= least) & (battery(token) >= BATTERY_LEVEL)

    found = F.transform(F.filter(candidates(text), lambda run: valid(run["token"])), lambda run: F.struct(
        run["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"),
        (run["start"] + F.length(run["token"])).alias("end")))
    return F.filter(found, lambda span: ~F.exists(base, lambda one: (one["start"] < span["end"]) & (span["start"] < one["end"])))


def scan(docs: DataFrame, into: str = "secrets") -> DataFrame:
    """`docs` with a struct column `into`: arrays `base` and `all` of (start, kind number, end)."""
    named = docs.withColumn("text", F.coalesce("text", F.lit("")))
    bounds = discovery_bins(named)
    with_base = named.withColumn(into, F.struct(base_spans(F.col("text")).alias("base")))
    base = F.col(into)["base"]
    return with_base.withColumn(into, F.struct(base.alias("base"), F.array_sort(
        F.concat(base, random_spans(F.col("text"), base, bounds))).alias("all")))


def secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    names = F.array(*map(F.lit, KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda span: F.concat_ws(
        ":", F.element_at(names, span["kind"] + 1), span["start"].cast("string"), span["end"].cast("string"))), ",")
    counts = [F.expr(f"cast(size(filter(secrets.base, span -> span.kind = {i})) as bigint)").alias(f"n_{kind}")
              for i, kind in enumerate(KINDS[:3])]
    return scan(docs).select("doc_id", *counts, F.sha2(joined(F.col("secrets.base")), 256).alias("base_sha256"),
                             joined(F.col("secrets.all")).alias("spans"))
