"""Small tables with every awkward row, and the comparison of a query with its SQL."""

import duckdb

from tests.conftest import TESTDATA
from tests.test_oracle import normal

SCALE = TESTDATA / "sf0.01"
TABLES = ("documents", "benchmark", "conversations", "labels")


def sql_rows(sql, scale=SCALE):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{scale}/{name}.parquet'")
    cursor = connection.execute(sql)
    return normal([column[0] for column in cursor.description], cursor.fetchall())


def assert_matches(spark, query, sql, scale=SCALE):
    ours = query(spark, str(scale))
    got, expected = normal(ours.columns, [tuple(row) for row in ours.collect()]), sql_rows(sql, scale)
    assert got[0] == expected[0]
    assert got[1] == expected[1] and got[1]


def documents(spark, texts, extra=False):
    rows = [(i, text, "en", "src0", len(text or "")) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    # Names that operators could use inside.
    return frame.selectExpr("*", "'x' as key", "1 as hash", "2 as value", "3 as n", "4 as digest") if extra else frame
