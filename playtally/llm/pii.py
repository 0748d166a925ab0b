"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a classifier decides.

Patterns propose spans: strict ones (the base kinds, always reported) and loose ones (national phone
numbers, spelled-out e-mail addresses, account and social security numbers, hardware addresses, numbers of
card length). On each span five labelers vote for, against or abstain: the strict
pattern, gazetteers, context words, check digits, and the characters around it. Nobody labels by hand: expectation-
maximisation estimates each labeler's reliability and the share of true spans per kind from the votes
alone, and a logistic classifier over votes, kind and length is then trained on the resulting posteriors.

What training needs is the number of spans by (kind, votes, length class): counts over all texts, summed
in each task and then in Spark, a table of at most 9 x 3^5 x 4 rows whatever the corpus. Applying the model is a
narrow pass with no shuffle. A text is scanned once per pattern, in time that grows with its length; memory is one
text and its spans.

Defined results: a null text is empty; repeated rows get the same spans each and count as often in training;
without any spans the model is the prior and adds nothing; a loose span that overlaps a base span is dropped, and
of loose spans that the classifier takes and that overlap, the one of the highest score stays (then the first);
offsets are code points, end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "spelled_email", "local_phone", "ssn", "iban", "mac")
LABELERS = ("pattern", "gazetteer", "context", "checksum", "surroundings")
THRESHOLD, EM_ROUNDS, CLASSIFIER_ROUNDS, CONTEXT_CHARS = 0.9, 50, 50, 40

_EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# Dots end a run of digits, so whatever starts within a run also starts at its first digit: only those are tried, once each.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE = {
    "spelled_email": re.compile(
        r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,63}){1,4}", re.I),
    "local_phone": re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?!\.?[0-9-])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "mac": re.compile(r"(?<![0-9A-Fa-f:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![0-9A-Fa-f:-])"),
}
#: What a text must hold for a loose pattern to be worth a scan; a span cannot exist without it.
_NEEDED = {"spelled_email": re.compile(r"[\[(] ?at ?[\])]", re.I), "local_phone": re.compile(r"[0-9]{3}[ .-][0-9]{4}"),
           "ssn": re.compile(r"[0-9]-[0-9]{2}-[0-9]"), "iban": re.compile(r"[A-Z]{2}[0-9]{2}"),
           "mac": re.compile(r"[:-][0-9A-Fa-f]{2}[:-][0-9A-Fa-f]{2}[:-]")}
#: Gazetteers and context words.
TOP_DOMAINS = frozenset("com org net edu gov info io eu de fr es uk us it nl ch at be pl se no dk fi pt ca au jp cn in br".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "40", "41", "43", "44", "45", "46", "47", "48",
                 "49", "52", "54", "55", "61", "81", "82", "86", "90", "91", "351", "353", "358", "420", "421", "972")
CARD_PREFIXES = ("34", "37", "4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "6011", "65", "35", "30", "36", "38")
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22,
                "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
_FOR = {
    "email": "mail|contact|write|address|correo|courriel", "spelled_email": "mail|contact|write|address",
    "ip": r"\bip\b|host|server|address|addr|client", "card": "card|visa|credit|payment|karte|carte|tarjeta|account",
    "phone": "phone|tel|call|mobile|fax|contact", "local_phone": "phone|tel|call|mobile|fax|contact",
    "ssn": r"ssn|social|security", "iban": "iban|bank|account|konto|compte|cuenta", "mac": r"\bmac\b|hardware|device|ethernet",
}
_CONTEXT = {kind: re.compile(words, re.I) for kind, words in _FOR.items()}
_AGAINST = re.compile(r"version|release|isbn|issn|order|invoice|serial|section|chapter|figure|page|build|example of", re.I)


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return sum(doubled) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, an @ at a time: what stands before it back to the last match, and its domain."""
    at, done = text.find("@"), 0
    while at >= 0:
        start, domain = at, _DOMAIN.match(text, at)
        if domain:
            while start > done and text[start - 1] in _EMAIL_CHARS:
                start -= 1
        if start < at:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(a, b, "email") for a, b in _emails(text)]
    for match in _IP.finditer(text):
        if all(map(_small, match[0].split("."))):
            found.append((*match.span(), "ip"))
    for match in _CARD.finditer(text):
        digits = _digits(match[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((*match.span(), "card"))
    for match in _PHONE.finditer(text):
        if 10 <= len(_digits(match[0])) <= 15:
            found.append((*match.span(), "phone"))
    return ordered(found)


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2]), span[1]))


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the account pattern, cut to the length of their country where a word ends there. The pattern also takes
    capital words that follow, so the search goes on behind the cut, or behind the first word where there is none."""
    at = 0
    while match := _LOOSE["iban"].search(text, at):
        start, end = match.span()
        left, cut = IBAN_LENGTHS.get(text[start:start + 2], 0), start
        while left and cut < end:
            left -= text[cut] != " "
            cut += 1
        if cut > start and not left and not text[cut:cut + 1].isalnum():
            yield start, cut
            at = cut
        else:
            yield start, end
            at = start + 4


def loose_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """All further candidates that do not overlap base spans; they may overlap each other until they are scored."""
    starts = [a for a, _, _ in base]
    reach = [0, *accumulate((b for _, b, _ in base), max)]
    found = [(*match.span(), "card") for match in _CARD.finditer(text) if 12 <= len(_digits(match[0])) <= 19]
    for kind, pattern in _LOOSE.items():
        if _NEEDED[kind].search(text):
            places = _ibans(text) if kind == "iban" else (match.span() for match in pattern.finditer(text))
            found += [(*place, kind) for place in places]
    # Base spans come by start: one overlaps if any that starts before the end of the span reaches beyond its start.
    return [span for span in ordered(found) if reach[bisect_left(starts, span[1])] <= span[0]]


def settled(scored: list[tuple[float, tuple[int, int, str]]]) -> list[tuple[int, int, str]]:
    """Of spans that overlap, the one of the highest score, then the first."""
    kept: list[tuple[int, int, str]] = []
    for _, span in sorted(scored, key=lambda one: (-one[0], one[1][0], KINDS.index(one[1][2]))):
        at = bisect_left(kept, span)
        if (not at or kept[at - 1][1] <= span[0]) and (at == len(kept) or span[1] <= kept[at][0]):
            kept.insert(at, span)
    return kept


def _iban_valid(text: str) -> bool:
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def votes(text: str, span: tuple[int, int, str], strict: bool) -> tuple[int, ...]:
    """One vote per labeler: 1 for personal data, -1 against, 0 no opinion."""
    start, end, kind = span
    value, digits = text[start:end], _digits(text[start:end])
    near = text[max(0, start - CONTEXT_CHARS):start]
    gazetteer = checksum = 0
    if kind in ("email", "spelled_email"):
        gazetteer = 1 if re.split(r"[^A-Za-z0-9]+", value.rstrip(")]"))[-1].lower() in TOP_DOMAINS else -1
    elif kind == "phone":
        gazetteer = 1 if digits.startswith(CALLING_CODES) else -1
    elif kind == "local_phone":
        gazetteer = -1 if digits[0] in "01" else 1
    elif kind == "card":
        gazetteer = 1 if digits.startswith(CARD_PREFIXES) else -1
        checksum = 1 if luhn(digits) else -1
    elif kind == "iban":
        compact = value.replace(" ", "")
        gazetteer = 1 if IBAN_LENGTHS.get(compact[:2]) == len(compact) else -1
        checksum = 1 if _iban_valid(value) else -1
    elif kind == "ssn":
        gazetteer = -1 if digits[:3] in ("000", "666") or digits[0] == "9" else 0
        checksum = -1 if digits[3:5] == "00" or digits[5:] == "0000" else 0
    elif kind == "ip":
        gazetteer = -1 if digits in ("0000", "1234", "1000") else 1
    context = 1 if _CONTEXT[kind].search(near) else -1 if _AGAINST.search(near) else 0
    around = text[max(0, start - 1):start] + text[end:end + 1]
    surroundings = -1 if any(c.isalnum() or c == "_" for c in around) else 1
    return (1 if strict else -1 if kind in BASE_KINDS else 0), gazetteer, context, checksum, surroundings


def length_class(span: tuple[int, int, str]) -> int:
    return min(3, (span[1] - span[0]) // 8)


# ---- Model ----------------------------------------------------------------------------------------

def count_votes(docs: DataFrame) -> DataFrame:
    """(kind, votes, length class, n) over every span of every text; summed in the task first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                base = base_spans(text)
                seen.update((span[2], ",".join(map(str, votes(text, span, True))), length_class(span)) for span in base)
                seen.update((span[2], ",".join(map(str, votes(text, span, False))), length_class(span))
                            for span in loose_spans(text, base))
        if seen:
            yield pd.DataFrame([(*key, n) for key, n in seen.items()], columns=["kind", "votes", "length", "n"])

    return (docs.where("text is not null").select("text")
            .mapInPandas(run, "kind string, votes string, length int, n bigint")
            .groupBy("kind", "votes", "length").agg(F.sum("n").alias("n")))


def estimate(table: np.ndarray, kinds: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each vote pattern and P(vote | truth) of each labeler, by expectation-maximisation."""
    posterior = np.clip(0.5 + 0.2 * table.sum(axis=1), 0.05, 0.95)
    told = np.stack([table == vote for vote in (-1, 0, 1)], axis=2)
    for _ in range(EM_ROUNDS):
        weights = np.stack([(1 - posterior) * n, posterior * n])
        reliability = np.einsum("tr,rlv->tlv", weights, told) + 1.0
        reliability /= reliability.sum(axis=2, keepdims=True)
        prior = np.array([[weights[truth][kinds == k].sum() + 1 for truth in (0, 1)] for k in range(len(KINDS))])
        prior /= prior.sum(axis=1, keepdims=True)
        log = np.log(prior[kinds]).T + np.einsum("rlv,tlv->tr", told, np.log(reliability))
        posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return posterior, reliability


def features(kinds: np.ndarray, table: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(kinds), 1)), np.eye(len(KINDS))[kinds], table > 0, table < 0, np.eye(4)[lengths]])


class Classifier:
    """Logistic regression on the posteriors, fitted on counts by Newton steps with a small ridge."""

    def __init__(self, counted: pd.DataFrame):
        self.weights = None
        if len(counted):
            counted = counted.sort_values(["kind", "votes", "length"])
            kinds = np.array([KINDS.index(kind) for kind in counted["kind"]])
            table = np.array([[int(vote) for vote in row.split(",")] for row in counted["votes"]])
            n = counted["n"].to_numpy(float)
            posterior, self.reliability = estimate(table, kinds, n)
            x = features(kinds, table, counted["length"].to_numpy())
            self.weights = np.zeros(x.shape[1])
            for _ in range(CLASSIFIER_ROUNDS):
                p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
                slope = x.T @ (n * (p - posterior)) + self.weights
                curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
                step = np.linalg.solve(curve, slope)
                self.weights -= step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))

    def spans(self, text: str) -> tuple[list, list]:
        """Base spans, and the loose ones that the classifier takes for personal data."""
        base = base_spans(text)
        loose = loose_spans(text, base) if self.weights is not None else []
        if loose:
            x = features(np.array([KINDS.index(span[2]) for span in loose]),
                         np.array([votes(text, span, False) for span in loose]), np.array(list(map(length_class, loose))))
            least = np.log(THRESHOLD / (1 - THRESHOLD))
            loose = settled([(value, span) for span, value in zip(loose, x @ self.weights) if value >= least])
        return base, loose


def fit(docs: DataFrame) -> Classifier:
    return Classifier(count_votes(docs).toPandas())


SPANS = "array<struct<start:int,end:int,kind:string>>"


def find(docs: DataFrame, model: Classifier, into: str = "pii") -> DataFrame:
    """`docs` with a struct column `into`: arrays `base` and `all` of spans by start, then kind."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def found(texts: pd.Series) -> pd.DataFrame:
        rows = [shared.value.spans(text or "") for text in texts]
        pack = lambda spans: [dict(zip(("start", "end", "kind"), span)) for span in spans]
        return pd.DataFrame({"base": [pack(base) for base, _ in rows],
                             "all": [pack(ordered(base + more)) for base, more in rows]})

    return docs.withColumn(into, F.pandas_udf(found, f"base {SPANS}, all {SPANS}")("text"))


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """`text` with each span replaced by its kind; overlapping spans become one, under the first kind."""
    parts, at = [], 0
    for start, end, kind in ordered(spans):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, model: Classifier) -> DataFrame:
    """`docs` with masked texts; a null text stays null, other columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([None if text is None else mask(text, sum(shared.value.spans(text), [])) for text in texts])

    return docs.withColumn("text", F.pandas_udf(masked, "string")("text"))


def pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    joined = lambda name: F.array_join(F.transform(f"pii.{name}", lambda span: F.concat_ws(
        ":", span["kind"], span["start"], span["end"])), ",")
    counts = [F.expr(f"cast(size(filter(pii.base, span -> span.kind = '{kind}')) as bigint)").alias(f"n_{kind}")
              for kind in BASE_KINDS]
    return find(docs, fit(docs)).select(
        "doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("all").alias("spans"))
