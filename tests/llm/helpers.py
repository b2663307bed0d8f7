"""Small document tables with the cases that every operator must bear."""

import duckdb
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LONG = "lorem ipsum dolor sit amet, " * 4000
ODD = [
    (1, None, "en", "a", 0), (2, "", None, None, None), (3, "   \n\t ", "en", "a", 6), (4, "one", "en", "b", 3), (5, "one two", "en", "b", 7), (6, LONG, "en", "b", len(LONG)), (7, LONG, "en", "c", len(LONG)),
    (8, "Ünï çødé 中文 😀 text\u00a0here", "xx", "c", 5), (9, "one two", "en", "a", 7), (9, "one two", "en", "a", 7), (None, "one two", "en", "a", 7), (None, None, None, None, None), (10, "x" * 30000, "en", "a", 30000), (11, "<|endoftext|> a <|endoftext|>", "en", "a", 1),
]
CLASHING = ["word", "n", "row", "id", "key", "score", "block", "copy", "part", "ids", "fp", "num", "recipe", "kept"]


def frame(spark, rows=None):
    return spark.createDataFrame(ODD if rows is None else rows, SCHEMA)


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASHING})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def oracle(sql, sf_dir, tables):
    con = duckdb.connect()
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.sql(sql)


def agree(got, want):
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str)
    assert rows == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)
