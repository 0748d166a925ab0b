"""Alignment of two tokenizers over the same bytes, and how often their tokens end together in the corpus.

Tokenizer A is byte-level and hands out character offsets, tokenizer B is a piece model with byte fallback and hands
out byte spans. A token whose span is as long as its decoded bytes gives a coarse cut. The others (parts of a
multibyte character share the span of that character, fallback bytes but the last have an empty span) are laid out
by their decoded bytes from the coarse cut before them. Offsets where tokens of both end cut the text into groups;
the two tokens that end there are linked.

Words. A blank after anything but white space starts a new word in A, and no piece of B holds a blank after another
character, so texts are cut there (`words_of`) and each different word is encoded once while the worker remembers it
(up to CACHED_BYTES, then it starts anew). Words not yet known are encoded many at a time as one text. A text with a
word whose bytes do not come back goes through both tokenizers as a whole.

Counts. One scan tokenizes; its rows keep each document's different links, packed (about as large as the compressed
input), and are written once. Their sums by pair of ids then meet these rows again: the most frequent
BROADCAST_PAIRS pairs (16 bytes each; all of them, where the corpus has no more) are sent to the tasks, rarer
ones, none of which can be hot, are joined by a shuffle. No row and no pair is left out at any size.

Defined results: a null or empty text, or one whose bytes either tokenizer does not give back, has no tokens: zeros
and ''. It adds nothing to the counts. Strings of special tokens inside texts are plain text. Repeated rows count as
often as they occur; an empty table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.llm.storage import cut

A_PATH, B_PATH = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Characters of texts looked at together, and of unknown words encoded together; what a worker remembers; pairs sent to tasks.
BLOCK_CHARS, JOINED_CHARS, CACHED_BYTES, BROADCAST_PAIRS = 2 << 20, 1 << 17, 128 << 20, 1 << 20
WAITING_PAIRS = 4 << 20
SCANNED = """n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, ends array<int>,
  pairs binary, times binary"""

_BLANK_AFTER_SPACE = re.compile(r"\s |^ | $")
_WORD_START = re.compile(r"(?<=\S) (?=[\s\S])")


def words_of(text: str) -> list[str]:
    """The words of blank + text, each without the blank that starts it."""
    if not _BLANK_AFTER_SPACE.search(text):
        return text.split(" ")
    found, last = [], 0
    for match in _WORD_START.finditer(text):
        found.append(text[last:match.start()])
        last = match.end()
    return [*found, text[last:]]


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, and that byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {chr(byte): byte for byte in shown} | {chr(256 + i): byte for i, byte in enumerate(hidden)}


def token_ends(lengths: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Byte offset after each token: that of its span where this is as long as the token, else counted from the last such one."""
    counted = np.cumsum(lengths)
    plain = np.flatnonzero(ends - starts == lengths)
    before = np.searchsorted(plain, np.arange(len(lengths)), "right") - 1
    ahead = np.concatenate([ends[plain] - counted[plain], [0]])
    return counted + ahead[before]


class Encoders:
    """Both tokenizers, and the bytes of each of their ids."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode() for entry in entries]
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                        else self.b.id_to_piece(i).replace(MARK, " ").encode() for i in range(self.b.get_piece_size())]
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in made], np.int64) for made in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = ([str(i) for i in range(len(made))] for made in (self.a_bytes, self.b_bytes))

    def aligned(self, text: str) -> tuple | None:
        """(ids A, ids B, index of the A and of the B token that end at each common offset, those offsets) of
        blank + `text`; nothing where either does not give back its bytes."""
        whole = " " + text
        data = whole.encode()
        made = self.a.encode(whole, add_special_tokens=False)
        pieces = self.b.encode(text, return_type="proto").pieces
        a_ids, b_ids = made.ids, [piece.id for piece in pieces]
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != data or b"".join(map(self.b_bytes.__getitem__, b_ids)) != data:
            return None
        spans = np.fromiter(chain.from_iterable(made.offsets), np.int64, 2 * len(a_ids))
        if len(data) != len(whole):
            codes = np.frombuffer(data, np.uint8)
            spans = np.append(np.flatnonzero((codes & 0xC0) != 0x80), len(data))[spans]
        # Spans of B follow each other and leave out the blank that it adds itself.
        b_spans = np.array([0, *[piece.end + 1 for piece in pieces]], np.int64)
        a_ids, b_ids = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        a_ends = token_ends(self.a_lengths[a_ids], spans[::2], spans[1::2])
        b_ends = token_ends(self.b_lengths[b_ids], b_spans[:-1], b_spans[1:])
        # Both hold the end of the text, so each offset of the smaller side has a place in the other.
        place = np.searchsorted(b_ends, a_ends)
        a_at = np.flatnonzero(b_ends[place] == a_ends)
        return a_ids, b_ids, a_at, place[a_at], a_ends[a_at]

    def links(self, a_ids: np.ndarray, b_ids: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> np.ndarray:
        """The pair code of the tokens at each common offset: id A * size of B + id B."""
        return a_ids[a_at] * len(self.b_bytes) + b_ids[b_at]

    def group_texts(self, a_ids: np.ndarray, b_ids: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> list[str]:
        a_names = list(map(self.a_names.__getitem__, a_ids.tolist()))
        b_names = list(map(self.b_names.__getitem__, b_ids.tolist()))
        out, i, j = [], 0, 0
        for a, b in zip(a_at.tolist(), b_at.tolist()):
            left = a_names[i] if a == i else ",".join(a_names[i:a + 1])
            out.append(f"{left}|{b_names[j]}" if b == j else f"{left}|{','.join(b_names[j:b + 1])}")
            i, j = a + 1, b + 1
        return out


class WordTable:
    """What is known of each word, by its number: its groups as text (nothing where its bytes differ), their number and
    those of its tokens, and, in the order of the words, the end and the link of each group."""

    def __init__(self, encoders: Encoders):
        self.encoders = encoders
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.groups: list[str | None] = []
        # Arrays in parts: three numbers a word, and the end and the link of each group.
        self.counts, self.ends, self.links = [np.zeros((3, 0), np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.bytes = 0

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words that are not known yet. They may pass the bound on what is kept; `full` says so afterwards."""
        waiting, size = [], 0
        for word in {*words} - self.at.keys():
            # A final blank would be another word's first one; the mark does not come back and would spoil its neighbours.
            if not word or word[-1].isspace() or MARK in word:
                self._encode([word])
                continue
            waiting.append(word)
            size += len(word) + 1
            if size > JOINED_CHARS:
                self._encode(waiting)
                waiting, size = [], 0
        if waiting:
            self._encode(waiting)

    def _encode(self, words: list[str]) -> None:
        found = self.encoders.aligned(" ".join(words))
        if found is None:
            if len(words) == 1:
                self._put(words, [None], np.zeros((3, 1), np.int64))
            else:
                half = len(words) // 2
                self._encode(words[:half])
                self._encode(words[half:])
            return
        a_ids, b_ids, a_at, b_at, common = found
        texts = self.encoders.group_texts(a_ids, b_ids, a_at, b_at)
        word_ends = np.cumsum([len(word.encode()) + 1 for word in words])
        last = np.searchsorted(common, word_ends)
        sizes = np.diff(last, prepend=-1)
        begins = np.concatenate([[0], word_ends[:-1]])
        self.ends.append(common - np.repeat(begins, sizes))
        self.links.append(self.encoders.links(a_ids, b_ids, a_at, b_at))
        firsts, lasts = (last + 1 - sizes).tolist(), (last + 1).tolist()
        self._put(words, [";".join(texts[i:j]) for i, j in zip(firsts, lasts)],
                  np.stack([sizes, np.diff(a_at[last], prepend=-1), np.diff(b_at[last], prepend=-1)]))

    def _put(self, words: list[str], groups: list[str | None], counts: np.ndarray) -> None:
        self.at.update(zip(words, range(len(self.groups), len(self.groups) + len(words))))
        self.groups += groups
        self.counts.append(counts)
        self.bytes += 350 * len(words) + 2 * sum(map(len, words)) + sum(len(text) for text in groups if text) + 16 * int(counts[0].sum())

    @property
    def full(self) -> bool:
        return self.bytes > CACHED_BYTES


    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(groups, A tokens, B tokens) by word; ends and links of all words one after the other."""
        for parts in (self.counts, self.ends, self.links):
            if len(parts) > 1:
                parts[:] = [np.concatenate(parts, axis=-1)]
        return self.counts[0], self.ends[0], self.links[0]


@lru_cache(maxsize=1)
def _table(a_path: str, b_path: str) -> WordTable:
    """The worker's own table; tokenizers are loaded once."""
    return WordTable(Encoders(a_path, b_path))


NO_TOKENS = (0, 0, 0, 0, "", "", [], b"", b"")


def _row(n_a: int, n_b: int, groups: str, ends, links: np.ndarray, code: type, with_groups: bool) -> tuple:
    """A row of SCANNED: the different links in order as `code`, and how often each occurs in as few bytes as do."""
    pairs, times = np.unique(links.astype(code), return_counts=True)
    return (n_a, n_b, len(links), len(links), hashlib.sha256(groups.encode()).hexdigest(), groups if with_groups else "",
            ends if with_groups else [], pairs.tobytes(), times.astype(np.uint8 if times.max(initial=0) < 256 else np.uint32).tobytes())


def _whole_row(table: WordTable, text: str, code: type, with_groups: bool) -> tuple:
    found = table.encoders.aligned(text)
    if found is None:
        return NO_TOKENS
    a_ids, b_ids, a_at, b_at, common = found
    return _row(len(a_ids), len(b_ids), ";".join(table.encoders.group_texts(a_ids, b_ids, a_at, b_at)), common,
                table.encoders.links(a_ids, b_ids, a_at, b_at), code, with_groups)


def _block_rows(table: WordTable, texts: list[str | None], code: type, with_groups: bool) -> Iterator[tuple]:
    if table.full:
        table.clear()
    texts_words = [words_of(text) if text else [] for text in texts]
    table.learn(chain.from_iterable(texts_words))
    (sizes, n_a, n_b), ends, links = table.arrays()
    first = np.cumsum(sizes) - sizes
    for text, words in zip(texts, texts_words):
        if not text:
            yield NO_TOKENS
            continue
        numbers = list(map(table.at.__getitem__, words))
        parts = list(map(table.groups.__getitem__, numbers))
        if None in parts:
            yield _whole_row(table, text, code, with_groups)
            continue
        at = np.array(numbers, np.int64)
        many = sizes[at]
        word = np.repeat(np.arange(len(at)), many)
        place = np.arange(len(word)) + np.repeat(first[at] - np.cumsum(many) + many, many)
        group_ends = []
        if with_groups:
            begins = np.cumsum([0, *[len(part.encode()) + 1 for part in words]])
            group_ends = ends[place] + begins[word]
        yield _row(int(n_a[at].sum()), int(n_b[at].sum()), ";".join(parts), group_ends, links[place], code, with_groups)


def scan(docs: DataFrame, a_path: str, b_path: str, code: type, with_groups: bool, into: str) -> DataFrame:
    """`docs` with a struct column `into` of SCANNED."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = _table(a_path, b_path)
        names = [column.split()[0] for column in SCANNED.replace("\n", " ").split(",")]
        for batch in batches:
            rows, block, size = [], [], 0
            for text in [*batch, ...]:
                if block and (text is ... or size > BLOCK_CHARS):
                    rows += _block_rows(table, block, code, with_groups)
                    block, size = [], 0
                if text is not ...:
                    block.append(text)
                    size += len(text or "")
            yield pd.DataFrame({name: [row[i] for row in rows] for i, name in enumerate(names)})

    return docs.withColumn(into, F.pandas_udf(run, SCANNED)("text"))


def _unpacked(pairs: bytes, times: bytes, code: type) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(pairs, code)
    return pairs.astype(np.int64), np.frombuffer(times, np.uint8 if len(times) == len(pairs) else np.uint32).astype(np.int64)


def _summed(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]), return_inverse=True)
    return found, np.bincount(place, np.concatenate([np.zeros(0, np.int64), *times]), len(found)).astype(np.int64)


def count_pairs(scanned: DataFrame, into: str, code: type) -> DataFrame:
    """(pair, n): how many links of the corpus hold each pair of ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, times, waiting = [], [], 0
        for batch in batches:
            for one in zip(batch["pairs"], batch["times"]):
                found = _unpacked(*one, code)
                pairs.append(found[0])
                times.append(found[1])
                waiting += len(found[0])
                if waiting > WAITING_PAIRS:
                    found = _summed(pairs, times)
                    # What does not shrink to half is handed on, so that memory stays bounded.
                    if len(found[0]) > WAITING_PAIRS // 2:
                        yield pd.DataFrame({"pair": found[0], "n": found[1]})
                        found = np.zeros(0, np.int64), np.zeros(0, np.int64)
                    pairs, times, waiting = [found[0]], [found[1]], len(found[0])
        found = _summed(pairs, times)
        yield pd.DataFrame({"pair": found[0], "n": found[1]})

    return scanned.select(f"`{into}`.pairs", f"`{into}`.times").mapInPandas(run, "pair bigint, n bigint").groupBy("pair").agg(
        F.sum("n").alias("n"))


def judged_pairs(counts: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best). A B id has at most as many pairs as A has ids, whatever the corpus."""
    token = F.col("pair") % b_size
    most = counts.groupBy(token.alias("token")).agg(F.max("n").alias("most"))
    return counts.withColumn("token", token).join(most, "token").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


class PairCounts:
    """Pairs in order, with their counts and whether each is the best of its B id."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("pair")
        self.pair, self.n, self.best = (rows[name].to_numpy(kind) for name, kind in (("pair", np.int64), ("n", np.int64), ("best", bool)))

    def look_up(self, pairs: np.ndarray, times: np.ndarray) -> tuple[int, int, np.ndarray]:
        """Links that are best, the sum of their counts, and which pairs are not here."""
        if not len(self.pair):
            return 0, 0, np.ones(len(pairs), bool)
        at = np.minimum(np.searchsorted(self.pair, pairs), len(self.pair) - 1)
        known = self.pair[at] == pairs
        return int(times[known & self.best[at]].sum()), int((times * self.n[at])[known].sum()), ~known


def align(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH, into: str = "alignment", with_groups: bool = True,
          keep: Sequence[str] | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The columns `keep` of `docs` (all by default) and a struct column `into`: counts, the digest of the groups and,
    with `with_groups`, the groups as text and the byte offsets (in blank + text) where they end."""
    encoders = Encoders(a_path, b_path)
    a_size, b_size = len(encoders.a_bytes), len(encoders.b_bytes)
    code = np.uint32 if a_size * b_size <= 1 << 32 else np.int64
    kept = docs.columns if keep is None else [*keep]
    scanned = cut(scan(docs, a_path, b_path, code, with_groups, into).select(*[f"`{name}`" for name in kept], into))
    pairs = cut(judged_pairs(cut(count_pairs(scanned, into, code)), b_size))
    size = pairs.count()
    frequent = pairs
    if size > broadcast_pairs:
        # About the wanted number of pairs lie above this count; the others are at most as frequent as any of these.
        bound = pairs.select(F.percentile_approx("n", F.lit(1 - broadcast_pairs / size), F.lit(100_000))).first()[0]
        frequent = pairs.where(F.col("n") > bound)
    shared = docs.sparkSession.sparkContext.broadcast(PairCounts(frequent.toPandas()))

    @F.pandas_udf("n_best bigint, count_sum bigint, rare array<bigint>, rare_times array<bigint>")
    def judged(pairs: pd.Series, times: pd.Series) -> pd.DataFrame:
        rows = []
        for one in zip(pairs, times):
            found, many = _unpacked(*one, code)
            best, total, rare = shared.value.look_up(found, many)
            rows.append((best, total, found[rare], many[rare]))
        return pd.DataFrame({name: [row[i] for row in rows] for i, name in enumerate(("n_best", "count_sum", "rare", "rare_times"))})

    more = "__judged"
    while more in kept:
        more += "_"
    found = scanned.withColumn(more, judged(f"`{into}`.pairs", f"`{into}`.times"))
    if size > broadcast_pairs:
        found = _with_rare(found, pairs, more)
    last = ["groups_sha256", "groups", "ends"] if with_groups else ["groups_sha256"]
    columns = [F.col(f"`{into}`.{name}") for name in ("n_a", "n_b", "n_groups", "n_links")]
    columns += [F.col(f"`{more}`.{name}") for name in ("n_best", "count_sum")] + [F.col(f"`{into}`.{name}") for name in last]
    return found.withColumn(into, F.struct(*columns)).drop(more)


def _with_rare(found: DataFrame, pairs: DataFrame, more: str) -> DataFrame:
    """Adds the counts of links whose pairs were not sent to the tasks. Rows are numbered as they lie in the written frame."""
    row = f"{more}_row"
    numbered = cut(found.withColumn(row, F.monotonically_increasing_id()))
    rare = numbered.select(row, F.explode(F.arrays_zip(f"`{more}`.rare", f"`{more}`.rare_times")).alias("link")).select(
        row, F.col("link.rare").alias("pair"), F.col("link.rare_times").alias("links"))
    added = rare.join(pairs, "pair").groupBy(row).agg(
        F.sum(F.col("links") * F.col("n")).alias("__sum"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("__best"))
    plus = lambda name, extra: (F.col(f"`{more}`.{name}") + F.coalesce(extra, F.lit(0))).cast("bigint")
    return numbered.join(added, row, "left").withColumn(more, F.struct(
        plus("n_best", "__best").alias("n_best"), plus("count_sum", "__sum").alias("count_sum"))).select(*found.columns)


def cross_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return align(docs, with_groups=False, keep=["doc_id"]).select("doc_id", "alignment.*")
