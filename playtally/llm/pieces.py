"""SentencePiece encoding and decoding with N-best segmentation.

The best segmentations of a text under the model's piece scores are found over its piece lattice: a
forward Viterbi pass gives the best score of every prefix, and a backward A-star search takes these as
its heuristic. They are exact, so complete paths leave the queue in order of score and the first N are the N best.

No piece of such a vocabulary holds a word mark after another character, so the lattice of a text is a
chain of lattices of its words, joined at single nodes. The best path of a word and the distance of its second best are
remembered by the worker (two generations, a new one after CACHED_WORDS words, with ids and decoded bytes packed). Words that are new in a block of
texts go through the forward pass in sorted order, which goes on from what a word shares with the one before it. The same A-star
runs over the chain, whose edges are the N best paths of each word. Of a chain only the N - 1 words with the cheapest second choice can change within the N best (each gives a
better path on its own than any change elsewhere), so the search stays small for a text of any length.

A character without a piece becomes its UTF-8 bytes, at a score below that of every piece. The vocabulary (a
fixed number of pieces) is read on the driver from the path given and broadcast.

All n best segmentations are returned: nbest_scores holds their scores, best first, and nbest_sha256 is the lowercase
SHA-256 hex of their ids in the same order, each as little-endian int32 followed by -1.

Defined results: a null text is empty; an empty text has no pieces and one segmentation of score 0; ties keep the
order of the search (fewer, longer pieces at the end of a word first); repeated rows get equal results; a text
holding the word mark itself (U+2581) decodes with a blank in its place, as in the original format, and is
reported as not restored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
N_BEST, UNKNOWN_PENALTY, CACHED_WORDS, CACHED_CHARS, CACHED_PATHS = 4, 10.0, 40_000, 64, 10_000
BATCH_ROWS, BLOCK_CHARS = 1000, 1 << 20
NEVER = float("-inf")
#: Scores at or below this one mean "never by choice" and do not set the score of unknown characters.
BARRED_SCORE = -1e8

RESULT = """n_pieces bigint, best_score double, n_segmentations bigint, margin double, ids_sha256 string, restored boolean,
  nbest_scores array<double>, nbest_sha256 string, ids array<int>"""


def packed(ids: Sequence[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


def unpacked(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<i4")


#: Ends each segmentation in nbest_sha256; no id is negative.
_SEGMENTATION_END = packed([-1])


@dataclass
class Vocabulary:
    """Pieces with ids and scores, the ids of the 256 bytes, and what each id decodes to."""
    scores: dict[str, tuple[tuple, float]]
    byte_ids: list[int]
    decoded: list[bytes]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, byte_ids, decoded = {}, [model.unk_id()] * 256, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                decoded.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                decoded.append(b"")
            else:
                scores[piece] = ((i,), model.get_score(i))
                decoded.append(piece.replace(MARK, " ").encode())
        return cls(scores, byte_ids, decoded)

    def __post_init__(self):
        self.longest = max(map(len, self.scores), default=1)
        self.unknown_score = min((s for _, s in self.scores.values() if s > BARRED_SCORE), default=0.0) - UNKNOWN_PENALTY
        joined = {c for piece in self.scores if len(piece) > 1 for c in piece}
        alone = "".join(re.escape(c) for c in "\n\r\t" if c not in joined)
        chained = not any(MARK in piece.lstrip(MARK) for piece in self.scores)
        self.words = re.compile(rf"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + (f"|[{alone}]" if alone else "")
                                if chained else ".+", re.S)
        # Pieces from their last character backwards: (next level, packed ids or None, score, decoded bytes).
        self.tree: dict[str, tuple] = {}
        for piece, (ids, score) in sorted(self.scores.items(), key=lambda one: one[0][::-1]):
            node = self.tree
            for char in piece[:0:-1]:
                node = node.setdefault(char, ({}, None, 0.0, b""))[0]
            below = node.get(piece[0], ({},))[0]
            node[piece[0]] = (below, packed(ids), score, b"".join(map(self.decoded.__getitem__, ids)))
        self.recent: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}
        self.paths: dict[tuple[str, int], list] = {}

    def __getstate__(self):
        return {"scores": self.scores, "byte_ids": self.byte_ids, "decoded": self.decoded}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def edges(self, word: str) -> tuple[list[float], list[list]]:
        """Best score of each prefix (forward Viterbi), and the pieces (start, ids, score) that end at each place."""
        best, ending = [0.0], [[]]
        for end in range(1, len(word) + 1):
            here = []
            for start in range(max(0, end - self.longest), end):
                found = self.scores.get(word[start:end])
                if found is not None:
                    here.append((start, *found))
            if word[end - 1] not in self.scores:
                here.append((end - 1, *self._spelled(word[end - 1])))
            best.append(max(best[start] + score for start, _, score in here))
            ending.append(here)
        return best, ending

    def best_words(self, names: set[str]) -> dict[str, tuple[float, float, bytes, bytes]]:
        """Of each word (and others) the score of its best path, how far the second one is behind, and the ids (packed) and
        the decoded bytes of the best."""
        if len(self.recent) >= CACHED_WORDS:
            self.older, self.recent = self.recent, {}
        missing = names - self.recent.keys()
        # What comes from the older generation is of use again.
        self.recent.update([(name, self.older[name]) for name in missing & self.older.keys()])
        new = dict(self._viterbi(sorted(missing - self.older.keys())))
        long = [name for name in new if len(name) > CACHED_CHARS]
        if not long:
            self.recent.update(new)
            return self.recent
        found = {**self.recent, **new}
        self.recent.update((name, word) for name, word in new.items() if len(name) <= CACHED_CHARS)
        return found

    def _viterbi(self, names: list[str]) -> Iterator[tuple[str, tuple]]:
        """Forward pass over sorted words that keeps the best two scores of each prefix and the last piece of the best.
        The prefix that a word shares with the one before it is not passed again."""
        first, second, back, before, root = [0.0], [NEVER], [None], "", self.tree
        for name in names:
            shared, most = 0, min(len(name), len(before))
            while shared < most and name[shared] == before[shared]:
                shared += 1
            del first[shared + 1:], second[shared + 1:], back[shared + 1:]
            before = name
            for end in range(shared + 1, len(name) + 1):
                start = end - 1
                entry = root.get(name[start])
                if entry is None or entry[1] is None:
                    spelled, score = self._spelled(name[start])
                    chosen = start, packed(spelled), b"".join(map(self.decoded.__getitem__, spelled))
                else:
                    _, ids, score, text = entry
                    chosen = start, ids, text
                best, behind = first[start] + score, second[start] + score
                while entry is not None and start:
                    start -= 1
                    entry = entry[0].get(name[start])
                    if entry is None:
                        break
                    ids = entry[1]
                    if ids is not None:
                        score = entry[2]
                        total = first[start] + score
                        # Of equal paths the one with the longer last piece counts.
                        if total >= best:
                            other = second[start] + score
                            behind = other if other > best else best
                            best, chosen = total, (start, ids, entry[3])
                        elif total > behind:
                            behind = total
                first.append(best)
                second.append(behind)
                back.append(chosen)
            ids, texts, at = [], [], len(name)
            while at:
                at, one, text = back[at]
                ids.append(one)
                texts.append(text)
            ids.reverse()
            texts.reverse()
            yield name, (first[-1], first[-1] - second[-1], b"".join(ids), b"".join(texts))

    def n_best(self, name: str, n: int) -> list[tuple[float, tuple]]:
        """The n best paths of a word, each as (score, ids); remembered for some words."""
        found = self.paths.get((name, n))
        if found is None:
            found = [(score, tuple(i for ids in path for i in ids)) for score, path in backward_search(*self.edges(name), n)]
            if len(self.paths) >= CACHED_PATHS:
                self.paths.clear()
            if len(name) <= CACHED_CHARS:
                self.paths[name, n] = found
        return found

    def _spelled(self, char: str) -> tuple[tuple, float]:
        return tuple(self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")), self.unknown_score


def backward_search(best: list[float], ending: list[list], n: int) -> list[tuple[float, tuple]]:
    """The n best paths from the first node to the last, best first, as (score, labels).

    `best` holds the best score from the first node to each node, `ending` the edges (from, label, score) by end.
    """
    last, made, done = len(best) - 1, 0, []
    left = [n] * len(best)
    queue = [(-best[last], 0, last, 0.0, None)]
    while queue and len(done) < n:
        _, _, node, behind, path = heapq.heappop(queue)
        # No more than the n best ways on from a node can be part of the n best paths.
        if not left[node]:
            continue
        left[node] -= 1
        if node == 0:
            labels = []
            while path is not None:
                label, path = path
                labels.append(label)
            done.append((behind, tuple(labels)))
            continue
        for start, label, score in ending[node]:
            made += 1
            heapq.heappush(queue, (-(best[start] + score + behind), made, start, score + behind, (label, path)))
    return done


def normalized(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def chain(vocabulary: Vocabulary, names: list[str], scores: Sequence[float], behind: Sequence[float],
          n: int) -> tuple[list[int], list[tuple[float, tuple]]]:
    """The words with the cheapest second choice, in the order of the text, and the n best paths as (score of the whole
    text, ids of these words); all other words keep their best path."""
    gaps = np.array(behind)
    near = np.flatnonzero(gaps <= np.partition(gaps, n - 2)[n - 2]) if len(gaps) >= n > 1 else np.arange(len(gaps))
    near = near[gaps[near] < -NEVER]
    open_words = sorted(near[np.argsort(gaps[near], kind="stable")][:n - 1].tolist())
    best, ending = [0.0], [[]]
    for node, at in enumerate(open_words):
        best.append(best[-1] + scores[at])
        ending.append([(node, ids, score) for score, ids in vocabulary.n_best(names[at], n)])
    rest = sum(scores) - best[-1]
    return open_words, [(rest + score, changes) for score, changes in backward_search(best, ending, n)]


def segment(vocabulary: Vocabulary, text: str, n: int = N_BEST) -> list[tuple[float, list[tuple]]]:
    """The n best segmentations, each as (score, ids by word)."""
    names = vocabulary.words.findall(normalized(text))
    words = list(map(vocabulary.best_words({*names}).__getitem__, names))
    open_words, found = chain(vocabulary, names, [word[0] for word in words], [word[1] for word in words], n)
    first = [tuple(unpacked(word[2])) for word in words]
    out = []
    for score, changes in found:
        ids = first.copy()
        for at, chosen in zip(open_words, changes):
            ids[at] = chosen
        out.append((score, ids))
    return out


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    return b"".join(map(vocabulary.decoded.__getitem__, ids)).decode("utf-8", "replace")[1:]


def encode_texts(vocabulary: Vocabulary, texts: list[str | None], n: int) -> Iterator[tuple]:
    """A row of RESULT for each text; the words of all texts are looked up together."""
    names_of = [vocabulary.words.findall(normalized(text or "")) for text in texts]
    known = vocabulary.best_words({name for names in names_of for name in names})
    for text, names in zip(texts, names_of):
        scores, behind, ids, decoded = zip(*map(known.__getitem__, names)) if names else ((),) * 4
        open_words, found = chain(vocabulary, names, scores, behind, n)
        ids, decoded = list(ids), list(decoded)
        for at, chosen in zip(open_words, found[0][1]):
            ids[at] = packed(chosen)
            decoded[at] = b"".join(map(vocabulary.decoded.__getitem__, chosen))
        whole = b"".join(ids)  # a batch of these is held at once, lists would take twice as much
        restored = b"".join(decoded).decode("utf-8", "replace")[1:] == (text or "")
        every = hashlib.sha256(whole)
        every.update(_SEGMENTATION_END)
        if len(found) > 1:
            # The others differ from the best only in its open words: hash the bytes between them from `whole`.
            bounds, at_byte, done = [], 0, 0
            for at in open_words:
                at_byte += sum(map(len, ids[done:at]))
                bounds.append((at_byte, at_byte + len(ids[at])))
                done = at
            view = memoryview(whole)
            for _, changes in found[1:]:
                start = 0
                for (begin, end), chosen in zip(bounds, changes):
                    every.update(view[start:begin])
                    every.update(packed(chosen))
                    start = end
                every.update(view[start:])
                every.update(_SEGMENTATION_END)
        yield (len(whole) // 4, found[0][0], len(found), found[0][0] - found[1][0] if len(found) > 1 else None,
               hashlib.sha256(whole).hexdigest(), restored, [score for score, _ in found], every.hexdigest(),
               unpacked(whole))


def encode(docs: DataFrame, model_path: str = MODEL_PATH, n: int = N_BEST, into: str = "pieces",
           with_ids: bool = True) -> DataFrame:
    """`docs` with a struct column `into`: ids of the best segmentation, its score and margin, and the round trip.

    Ids take more room than their text, so the session's Arrow batches are lowered to BATCH_ROWS rows (and stay there).
    """
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(docs.sparkSession.conf.get(batch)) <= BATCH_ROWS:
        docs.sparkSession.conf.set(batch, str(BATCH_ROWS))
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))
    names = [field.split()[0] for field in RESULT.replace("\n", " ").split(", ")][:None if with_ids else -1]
    returns = RESULT if with_ids else RESULT.rpartition(",")[0]

    def run(texts: pd.Series) -> pd.DataFrame:
        rows, block, size = [], [], 0
        for text in [*texts, ...]:
            if block and (text is ... or size > BLOCK_CHARS):
                rows += [row[:len(names)] for row in encode_texts(shared.value, block, n)]
                block, size = [], 0
            if text is not ...:
                block.append(text)
                size += len(text or "")
        made = pd.DataFrame({name: [row[i] for row in rows] for i, name in enumerate(names)})
        made["margin"] = made["margin"].astype("Float64")
        return made

    return docs.withColumn(into, F.pandas_udf(run, returns)("text"))


def sentencepiece_nbest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, with_ids=False).select("doc_id", "pieces.*")
