"""Small tables with everything awkward, and the SQL check."""

from collections import Counter
from pathlib import Path

import duckdb

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, hash int, label string, rest string"
LONG = " ".join(f"word{i % 700}" for i in range(30_000))
ROWS = [
    (1, "A shared line of more than twenty signs\nown one", "en", "a", 5),
    (2, "a SHARED line of more than twenty signs  \nown two", "en", "a", 5),
    (3, "\tA shared line of more than twenty signs\nown three", None, None, None),
    (3, "\tA shared line of more than twenty signs\nown three", None, None, None),
    (4, None, "en", "b", None),
    (5, "", "en", "b", 0),
    (6, " \n \n", "en", "c", 3),
    (None, "no id here", "en", "c", 10),
    (7, LONG, "en", "a", len(LONG)),
    (8, LONG, "en", "z", len(LONG)),
    (9, "All rights reserved. Licensed under\nthe CC BY-NC 4.0 terms, all rights reserved", "en", "a", 1),
    (10, "Released under the MIT License", "en", "é", 1),
    (11, "x² İ ŉ don't 'tis 12 ### 日本語 \U0001f600", "xx", "é", 1),
]


def awkward(spark, rows=ROWS):
    return spark.createDataFrame([(*row, "clash", 1, "clash", "clash") for row in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def save(spark, docs, folder):
    """The documents as the table of a data folder."""
    docs.coalesce(1).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return str(folder)


def sql_rows(sf_dir, sql):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        own = f"{path}/*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{own}')")
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(row[i] for i in order) for row in result.fetchall())


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())
