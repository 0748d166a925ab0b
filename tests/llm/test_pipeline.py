"""The stages of the pipeline one after the other, each against SQL or plain Python over its own input."""

import re

import duckdb
import pytest

import corpus_pipeline
from playtally.llm import decontaminate, neardup, pieces, pii, quality
from tests.conftest import TESTDATA

SCALE = TESTDATA / "sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs, kept = tmp_path_factory.mktemp("stages"), spark.read.parquet(str(SCALE / "documents.parquet")), []
    kept.append(str(SCALE / "documents.parquet"))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(SCALE)).write.parquet(str(folder / str(i)))
        docs = spark.read.parquet(str(folder / str(i)))
        kept.append(f"{folder / str(i)}/*.parquet")
    return kept


def sql(documents, query):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{documents}'")
    connection.execute(f"create view benchmark as select * from '{SCALE}/benchmark.parquet'")
    return connection.execute(query).fetchall()


def kept_ids(path):
    return sorted(row[0] for row in sql(path, "select doc_id from documents"))


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES][1] == "near-duplicates" and corpus_pipeline.ORACLE_SQL is None
    for path in stages[1:-1]:
        assert [row[0] for row in sql(path, "describe documents")] == COLUMNS
        assert not sql(path, "select * from documents where n_chars <> length(text)")


@pytest.mark.parametrize("stage, query", [
    (0, f"select doc_id from ({quality.SQL}) where kept"), (1, f"select doc_id from ({neardup.SQL}) where kept"),
    (2, f"select doc_id from ({decontaminate.SQL}) where not contaminated")])
def test_filters_keep_what_sql_keeps(stages, stage, query):
    assert kept_ids(stages[stage + 1]) == sorted(row[0] for row in sql(stages[stage], query)) != kept_ids(stages[stage])


def test_texts_change_only_where_they_should(stages):
    before = dict(sql(stages[3], "select doc_id, text from documents"))
    after = dict(sql(stages[4], "select doc_id, text from documents"))
    assert before.keys() == after.keys() and before != after
    for doc, text in after.items():
        assert not pii.base_spans(text)
        assert bool(pii.base_spans(before[doc])) <= (text != before[doc])
        assert re.sub(r"\[[A-Z_]+\]", "", text) == text or text != before[doc]


def test_ids_decode_to_the_texts(stages):
    vocabulary = pieces.Vocabulary.load(pieces.MODEL_PATH)
    texts = dict(sql(stages[4], "select doc_id, text from documents"))
    rows = sql(stages[5], "select doc_id, ids, restored from documents")
    assert len(rows) == len(texts)
    assert all(restored and pieces.decode(vocabulary, ids) == texts[doc] for doc, ids, restored in rows)


def test_awkward_rows(spark, tmp_path):
    """Nulls in any column, empty and repeated rows, and further columns named as the stages name theirs."""
    words = [f"{a}{b}" for a in "stone river market winter garden letter morning".split() for b in ("", "s", "ed", "ing", "er")]
    text = lambda k: " ".join(words[(k + i * i + i // 7) % len(words)] for i in range(60)) + "."
    given = [(1, text(1), "en", "a", 5), (None, text(9), None, None, None), (3, None, "en", "a", 0), (4, "", "en", "a", 0),
             (5, text(1), "en", "b", 5), (None, None, None, None, None), (6, "too few words", "en", "a", 13)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    more = {name: "1" for name in ("key", "label", "__key", "pieces", "name", "n", "start")}
    for rows, kept in ((given, [None, 1]), ([], [])):
        docs = spark.createDataFrame(rows, schema).selectExpr("*", *[f"{value} as {name}" for name, value in more.items()])
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            folder = str(tmp_path / f"{len(rows)}-{i}")
            stage(spark, docs, str(SCALE)).write.parquet(folder)
            docs = spark.read.parquet(folder)
            if i < 4:
                assert docs.columns == [*COLUMNS, *more]
        assert sorted((row.doc_id for row in docs.collect()), key=lambda one: one or 0) == kept


def test_run_leaves_only_the_last_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline.storage, "shared_folder", lambda spark: str(tmp_path))
    result = corpus_pipeline.run(spark, str(TESTDATA / "sf0.001"))
    assert len([path for path in tmp_path.iterdir() if path.name.startswith("pipeline-")]) == 1 and result.count()
