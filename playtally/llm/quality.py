"""Quality rules, line first: failing lines are removed, then documents that lose too much text go.

Line rules, each on its own: navigation (menu separators make up a third of the words), punctuation
(symbols make up over a tenth of the characters in words, or a fragment of under five words with no sentence mark)
and boilerplate (stock phrases make up a fifth of the words). A document whose remaining lines hold less than half of
its words is rejected, as is one that fails the base rules (under 20 words, or over 30 % of them in repeated windows).

One narrow pass, no shuffle; counts of a block of texts are sums between offsets, so a text of any
length costs time in proportion. Defined results: a null or empty text has no words and fails; repeated
rows get the same verdict each; other columns pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.llm.blocks import (
    SPACED, byte_table, char_offsets, gram_hashes, mixed, span_hashes, text_blocks, word_bounds,
)

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
MIN_FRAGMENT_WORDS, MAX_SYMBOL_PERCENT, MIN_KEPT_PERCENT, SEPARATOR_SHARE = 5, 10, 50, 3
PHRASE_SHARE = 5
SYMBOLS, SEPARATORS, SENTENCE_MARKS = b"#*$%&|<>", b"|>", b".!?:;"
#: Stock phrases of navigation bars, consent notices and footers.
PHRASES = (
    "accept cookies", "cookie policy", "all rights reserved", "privacy policy", "terms of use", "terms of service",
    "sign up now", "log in to", "click here", "subscribe to our", "enable javascript", "skip to content",
    "share this", "read more", "back to top", "lorem ipsum",
)
_PHRASE = re.compile("|".join(map(re.escape, PHRASES)).encode(), re.I)
_WIDE_MARK = re.compile(b"|".join(mark.encode() for mark in "…。！？"))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_removed_lines",
          "n_kept_words")
RESULT = ", ".join(f"{name} bigint" for name in COUNTS) + ", cleaned string"


def _between(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[ends] - sums[starts]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key, whether it occurs more than once, and whether it occurred before."""
    _, first, which, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return counts[which] > 1, first[which] != np.arange(len(keys))


def measure(data: bytes, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], list[bytes]]:
    """Counts of each text of a block, and its text without the lines that fail."""
    codes, n = np.frombuffer(data, np.uint8), len(offsets) - 1
    begin, end = offsets[:-1], offsets[1:] - 1
    starts, ends = word_bounds(codes, SPACED)
    owner = np.searchsorted(offsets, starts, "right") - 1
    chars = char_offsets(codes)
    out = {"n_words": np.bincount(owner, minlength=n),
           "word_chars": np.bincount(owner, chars[ends] - chars[starts], minlength=n).astype(np.int64),
           "n_symbols": _between(byte_table(SYMBOLS)[codes], begin, end)}

    windows = gram_hashes(span_hashes(codes, starts, ends), WINDOW)
    at = np.flatnonzero(owner[:len(windows)] == owner[WINDOW - 1:]) if len(windows) else np.zeros(0, np.int64)
    twice, _ = _repeats(mixed(windows[at] + owner[at].astype(np.uint64)))
    covered = np.zeros(len(starts) + 1, np.int64)
    np.add.at(covered, at[twice], 1)
    np.add.at(covered, at[twice] + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(owner[np.cumsum(covered[:-1]) > 0], minlength=n)

    line_ends = np.flatnonzero(codes == 10)
    line_starts = np.concatenate([[0], line_ends[:-1] + 1])
    per_line = np.diff(np.concatenate([np.searchsorted(starts, line_starts), [len(starts)]]))
    used = per_line > 0
    line_starts, line_ends, per_line = line_starts[used], line_ends[used], per_line[used]
    line_owner = np.searchsorted(offsets, line_starts, "right") - 1
    _, before = _repeats(mixed(span_hashes(codes, line_starts, line_ends) + line_owner.astype(np.uint64)))
    out["n_dup_lines"] = np.bincount(line_owner[before], minlength=n)
    out["n_lines"] = np.bincount(line_owner, minlength=n)

    def holds(pattern: re.Pattern) -> np.ndarray:
        found = np.zeros(len(line_starts), bool)
        places = [match.start() for match in pattern.finditer(data)]
        found[np.searchsorted(line_starts, places, "right") - 1] = True
        return found

    failed = SEPARATOR_SHARE * _between(byte_table(SEPARATORS)[codes], line_starts, line_ends) >= per_line
    in_words = _between(SPACED[codes] & ((codes & 0xC0) != 0x80), line_starts, line_ends)
    failed |= 100 * _between(byte_table(SYMBOLS)[codes], line_starts, line_ends) > MAX_SYMBOL_PERCENT * in_words
    marked = (_between(byte_table(SENTENCE_MARKS)[codes], line_starts, line_ends) > 0) | holds(_WIDE_MARK)
    failed |= ~marked & (per_line < MIN_FRAGMENT_WORDS)
    stock = [(match.start(), match[0].count(b" ") + 1) for match in _PHRASE.finditer(data)]
    if stock:
        places, sizes = np.array(stock).T
        on = np.searchsorted(line_starts, places, "right") - 1
        failed |= PHRASE_SHARE * np.bincount(on, sizes, minlength=len(failed)) >= np.maximum(per_line, 1)
    out["n_removed_lines"] = np.bincount(line_owner[failed], minlength=n)
    out["n_kept_words"] = np.bincount(line_owner[~failed], per_line[~failed], minlength=n).astype(np.int64)
    cleaned = [data[a:b] for a, b in zip(begin, end)]
    for row in np.flatnonzero(out["n_removed_lines"]):
        mine = slice(*np.searchsorted(line_owner, [row, row + 1]))
        at, parts = begin[row], []
        for a, b in zip(line_starts[mine][failed[mine]], line_ends[mine][failed[mine]]):
            parts.append(data[at:a])
            at = b + 1
        cleaned[row] = b"".join([*parts, data[at:end[row]]])
    return out, cleaned

def _measured(texts: pd.Series) -> pd.DataFrame:
    blocks = [measure(data, offsets) for _, _, data, offsets in text_blocks(texts.tolist())]
    columns = {name: np.concatenate([counts[name] for counts, _ in blocks]) if blocks else [] for name in COUNTS}
    return pd.DataFrame(columns | {"cleaned": [
        text.decode("utf-8", "surrogatepass") for _, cleaned in blocks for text in cleaned]})


def judge(docs: DataFrame, into: str = "quality") -> DataFrame:
    """`docs` with a struct column `into`: the counts, base_failed, kept and the cleaned text."""
    # Not deterministic to the optimizer, else a filter on the verdict would measure every text a second time.
    measured = F.pandas_udf(_measured, RESULT).asNondeterministic()
    raw = docs.withColumn(into, measured(F.coalesce(F.col("text"), F.lit(""))))
    get = F.col(into).getField
    base = (get("n_words") < MIN_WORDS) | (100 * get("n_repeat_words") > MAX_REPEAT_PERCENT * get("n_words"))
    kept = ~base & (100 * get("n_kept_words") >= MIN_KEPT_PERCENT * get("n_words"))
    return raw.withColumn(into, F.struct(*[get(name).alias(name) for name in COUNTS], base.alias("base_failed"),
                                         kept.alias("kept"), get("cleaned").alias("cleaned")))


def quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select("doc_id", *[f"quality.{name}" for name in (*COUNTS, "base_failed", "kept")])


_WORD = r"'[^\x20\x09-\x0D]+'"
SQL = rf"""with docs as (select doc_id, coalesce(text, '') as text from documents),
words as (
  select doc_id, text, w, len(w) as n_words from (select doc_id, text, regexp_extract_all(text, {_WORD}) as w from docs)),
grams as (
  select doc_id, i, list_slice(w, i, i + {WINDOW - 1}) as gram
  from (select doc_id, w, unnest(range(1, n_words - {WINDOW - 2})) as i from words where n_words >= {WINDOW})),
twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as c from grams) where c > 1),
repeated as (
  select doc_id, count(distinct i + o) as n_repeat_words from twice, (select unnest(range(0, {WINDOW})) as o) group by 1),
lines as (
  select doc_id, line, row_number() over (partition by doc_id, line order by i) as nth,
    len(regexp_extract_all(line, {_WORD})) as n,
    len(regexp_extract_all(line, '[|>]')) as separators, len(regexp_extract_all(line, '[#*$%&|<>]')) as symbols,
    length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) as chars,
    regexp_matches(line, '[.!?:;…。！？]') as marked,
    coalesce(list_sum(list_transform(
      regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{"|".join(PHRASES)}'),
      lambda x: length(x) - length(replace(x, ' ', '')) + 1)), 0) as stock
  from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i
        from docs)),
judged as (
  select *, {SEPARATOR_SHARE} * separators >= n or 100 * symbols > {MAX_SYMBOL_PERCENT} * chars
    or (not marked and n < {MIN_FRAGMENT_WORDS}) or {PHRASE_SHARE} * stock >= n as failed from lines where n > 0),
sums as (
  select doc_id, count(*) filter (nth > 1) as n_dup_lines, count(*) as n_lines,
    count(*) filter (failed) as n_removed_lines, coalesce(sum(n) filter (not failed), 0) as n_kept_words
  from judged group by 1),
counts as (
  select doc_id, n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines,
    coalesce(n_removed_lines, 0) as n_removed_lines, coalesce(n_kept_words, 0) as n_kept_words
  from words left join repeated using (doc_id) left join sums using (doc_id)),
verdict as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from counts)
select doc_id, {", ".join(f"cast({name} as bigint) as {name}" for name in COUNTS)}, base_failed,
  not base_failed and 100 * n_kept_words >= {MIN_KEPT_PERCENT} * n_words as kept
from verdict"""
