"""Alignment of two tokenizers against a plain walk over token bytes."""

import hashlib
from collections import Counter

import pytest

from playtally.llm import alignment
from tests.llm.helpers import SCALE, documents

WILD = ["Ünïcode 漢字 😀é́", "two  blanks   and\ttabs \n lines\n\nmore ", " leading", "▁mark here", "<|endoftext|> </s> <s>", "don't 'x' it's 12½",
        "a b  c", "\x00nul", "x" * 5000, "tail\n", "🏳️‍🌈 flags", ""]


@pytest.fixture(scope="module")
def encoders():
    return alignment.Encoders(alignment.A_PATH, alignment.B_PATH)


def walked(encoders, text):
    """(groups as text, ends, links, n_a, n_b) of one text, token by token."""
    a = encoders.a.encode(" " + text, add_special_tokens=False).ids
    b = encoders.b.encode(text)
    whole, ends = (" " + text).encode(), []
    for ids, table in ((a, encoders.a_bytes), (b, encoders.b_bytes)):
        if b"".join(table[i] for i in ids) != whole:
            return None
        at, found = 0, {}
        for place, token in enumerate(ids):
            at += len(table[token])
            found[at] = place
        ends.append(found)
    groups, links, i, j, common = [], [], 0, 0, sorted(ends[0].keys() & ends[1].keys())
    for end in common:
        x, y = ends[0][end], ends[1][end]
        groups.append(",".join(map(str, a[i:x + 1])) + "|" + ",".join(map(str, b[j:y + 1])))
        links.append((a[x], b[y]))
        i, j = x + 1, y + 1
    return ";".join(groups), common, links, len(a), len(b)


def expected(encoders, texts):
    found = [walked(encoders, text) if text else None for text in texts]
    counts = Counter(link for one in found if one for link in one[2])
    best = Counter()
    for (_, token), n in counts.items():
        best[token] = max(best[token], n)
    return [(0, 0, 0, 0, 0, 0, "", "", []) if one is None else (
        one[3], one[4], len(one[1]), len(one[2]), sum(counts[link] == best[link[1]] for link in one[2]),
        sum(counts[link] for link in one[2]), hashlib.sha256(one[0].encode()).hexdigest(), one[0], one[1]) for one in found]


def got(frame):
    return [tuple(row.alignment) for row in sorted(frame.collect(), key=lambda row: row.doc_id)]


@pytest.mark.parametrize("pairs", [1 << 20, 7, 0])
def test_awkward_texts(spark, encoders, pairs):
    texts = [None, *WILD, *WILD[:3], "the cat sat on the mat, the mat."]
    frame = documents(spark, texts, extra=True).selectExpr("*", "1 as pairs", "2 as rare", "3 as __judged", "4 as ends")
    found = alignment.align(frame, broadcast_pairs=pairs)
    assert found.columns == [*frame.columns, "alignment"]
    assert got(found) == expected(encoders, texts)


def test_whole_table(spark, encoders):
    docs = spark.read.parquet(str(SCALE / "documents.parquet")).select("doc_id", "text")
    texts = [row.text for row in docs.orderBy("doc_id").collect()]
    rows = alignment.cross_tokenizer_alignment(spark, str(SCALE)).orderBy("doc_id").collect()
    assert [tuple(row)[1:] for row in rows] == [row[:7] for row in expected(encoders, texts)]


def test_a_small_memory_changes_nothing(spark, encoders, monkeypatch):
    table = alignment.WordTable(encoders)
    monkeypatch.setattr(alignment, "CACHED_BYTES", 2000)
    texts = ["some words that come again", "other words", "some words that come again", *WILD[:4]] * 3
    rows = [row for text in texts for row in alignment._block_rows(table, [text], alignment.np.uint32, True)]
    assert [row[5] for row in rows] == [(walked(encoders, text) or [""])[0] for text in texts]


def test_empty_table(spark):
    assert alignment.align(documents(spark, [])).collect() == []


def test_coarse_cuts_are_refined_inside_characters(encoders):
    """Three bytes of one character: the spans of all three tokens are the character, or empty but for the last."""
    a_ids, b_ids, a_at, b_at, common = encoders.aligned("é漢x")
    assert len(a_ids) > 3 and common[-1] == len(" é漢x".encode())
    assert [bytes().join(encoders.a_bytes[i] for i in a_ids[:at + 1]) for at in a_at] == [
        bytes().join(encoders.b_bytes[i] for i in b_ids[:at + 1]) for at in b_at]
