"""Queries against their SQL, on a test table and on planted rows."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from clicktide.llm import pii, queries
from tests.llm.helpers import SF, documents_of, needs_data, random_texts

BIG = SF.replace("0.001", "0.01")


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(str(v) for v in row) for row in frame.itertuples(index=False))


def compare(spark, name, folder, connection):
    ours = queries.QUERIES[name](spark, folder).toPandas()
    theirs = connection.execute(queries.ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs) and len(ours)
    return ours


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{BIG}/*.parquet"):
        table = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    compare(spark, name, BIG, connection)


PLANTED = ["mail a@b.cd ", "1.2.3.4 ", "999.1.1.1 ", "4111 1111 1111 1111 ", "4111111111111112 ", "+49 30 1234567 ",
           "GB82 WEST 1234 5698 7654 32 ", "GB82 WEST 1234 5698 7654 33 ", "ssn 123-45-6789 ", "123-45-6789 ",
           "tax id 000-45-6789 ", "é ", "word ", "other words here ", "\n", "1-", "ssn 9123-45-6789 ", "# ", "| "]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_planted_rows_match_sql(spark, folder, name):
    texts = random_texts(400, PLANTED, 30, seed=11) + [None, "", " ", "same line\n" * 9, "a b c d e f g h i j k"]
    rows_ = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string, n_chars long")
    frame.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    found = compare(spark, name, folder, connection)
    if name == "op1_pii":
        spans = ",".join(found["spans"])
        assert all(f"{kind}:" in spans for kind in ("email", "ip", "card", "phone", "iban", "ssn"))


def test_scores_match_sql(spark, folder):
    planted = [*PLANTED, "call ", "order ", "version ", "host ", "bank ", "serial ", "tel (017) 555-7713 ", "030 1234 5678 ",
               "017.555.7713, ", "+1 (017) 555-7713 ", "(", "- ", "git ", "visa ", "a@b.cd ", "some longer words between these ones "]
    texts = random_texts(600, planted, 20, seed=3) + random_texts(900, planted, 3, seed=4)
    documents_of(spark, texts).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    found = compare(spark, "op1_pii", folder, connection)
    kinds = {kind.name: kind for kind in pii.KINDS}
    seen = set()
    for spans, scores in zip(found["spans"], found["scores"], strict=True):
        pairs = zip(spans.split(","), scores.split(","), strict=True) if spans else ()
        seen.update((span.split(":")[0], int(score)) for span, score in pairs)
    for name, kind in kinds.items():
        possible = {round(100 * s) for s in (kind.raised, kind.score, kind.lowered) if s >= kind.least}
        assert {score for of, score in seen if of == name} == possible, name
