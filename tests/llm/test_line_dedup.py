import numpy as np
import pytest
from helpers_llm import awkward

from granero.llm import line_dedup as dedup


def test_perfect_hash_gives_every_key_its_own_place():
    rng = np.random.default_rng(1)
    for size in (0, 1, 7, 5000):
        keys = np.unique(rng.integers(-(1 << 63), (1 << 63) - 1, size))
        built = dedup.PerfectHash.build(keys)
        read = dedup.PerfectHash.load(*built.dump())
        assert sorted(read.places(keys)) == list(range(len(keys)))
    assert dedup.PerfectHash.build(np.arange(3)).places(np.array([10**12]))[0] < 3


def test_listed_keys(monkeypatch):
    monkeypatch.setattr(dedup, "LEVELS", 1)
    keys = np.arange(1000)
    built = dedup.PerfectHash.build(keys)
    assert len(built.rest) and sorted(built.places(keys)) == list(range(1000))


def brute(rows, least=20, docs=3):
    def key(line):
        own = line.strip(" \t\n\x0b\x0c\r")
        own = "".join(c.lower() if "A" <= c <= "Z" else c for c in own)
        return own if len(own) >= least else None

    holders = {}
    for at, (doc, text) in enumerate(rows):
        for own in {key(line) for line in (text or "").split("\n")} - {None}:
            holders.setdefault(own, []).append(-(10**9) if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        mine = -(10**9) if doc is None else doc
        kept = [x for x in lines if len(holders.get(key(x), ())) < docs or max(holders[key(x)]) == mine]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_equals_brute_force(spark, sf_dir):
    for docs in (awkward(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        found = dedup.dedup_lines(docs, lines_per_shard=64).collect()
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found), key=str) == brute(rows)


def test_hot_lines_take_the_short_way(spark, monkeypatch):
    monkeypatch.setattr(dedup, "HOT_ROWS", 2)
    docs = spark.range(50).selectExpr("id AS doc_id", "concat('one very common line of text\n', id) AS text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = dedup.dedup_lines(docs).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found), key=str) == brute(rows)


@pytest.mark.parametrize("docs, least_docs, hot_rows", [
    (400, 300, 1_000), (400, 300, 10), (299, 300, 1_000), (299, 300, 10), (1_500, 2_000, 1_000), (2_100, 2_000, 1_000),
    (256, 256, 1_000), (255, 256, 1_000), (300, 256, 1_000),
])
def test_any_least_number_of_documents(spark, monkeypatch, docs, least_docs, hot_rows):
    monkeypatch.setattr(dedup, "HOT_ROWS", hot_rows)
    table = spark.range(docs).selectExpr("id AS doc_id", "concat('one line that all the documents share\n', id) AS text")
    found = dedup.dedup_lines(table, least_docs=least_docs)
    assert found.selectExpr("sum(n_dropped)").first()[0] == (docs - 1 if docs >= least_docs else 0)
    assert found.where("n_dropped = 0").count() == (1 if docs >= least_docs else docs)


def test_lines_in_very_many_documents_are_hot_below_the_share(spark, monkeypatch):
    monkeypatch.setattr(dedup, "HOT_ALWAYS", 5)
    lines = dedup.stage(spark.range(40).selectExpr("id AS doc", "id % 2 AS key", "cast(7 AS int) AS print"))
    found = dedup.repeated_lines(lines, least_docs=3).collect()
    assert len(found) == 38 and {row.doc for row in found} == set(range(38))


def test_counts_take_the_smallest_type():
    assert [dedup.count_type(n).itemsize for n in (3, 255, 256, 65_535, 65_536, 1 << 40)] == [1, 1, 2, 2, 4, 8]


def test_columns_are_carried(spark):
    docs = awkward(spark)
    cleaned = dedup.without_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    assert cleaned.where("doc_id = 1").first().lang == "en"
