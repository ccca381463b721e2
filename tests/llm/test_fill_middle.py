import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import LONG, awkward, empty, save, spark_rows, sql_rows

from granero.llm import fill_middle
from granero.llm.oracle import ORACLE
from granero.llm.queries import QUERIES

CUTS = fill_middle.Cuts()


def numbers(doc_id, seed=7):
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def by_hand(doc_id, text, percent=100, suffix_first=50):
    """n, form, sizes and output of one text, with strings."""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h1, h2, h3, h4 = numbers(doc_id)
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(mark in text for mark in CUTS.marks) or h3 % 100 >= percent:
        return len(units), "plain", None, None, text
    if h4 % 100 < suffix_first:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_batches_equal_strings():
    rng = np.random.default_rng(5)
    texts = ["", "\n", "\n\n", "a", "a\nb", "é\n日本\n😀", "<P", "x<S\n>", "<S>", "<\n<P\nS>\n", LONG]
    texts += ["".join(rng.choice(list("ab\né<PSM>\r "), rng.integers(0, 40))) for _ in range(3_000)]
    drawn = np.array([numbers(i) for i in range(len(texts))], np.int64).T
    moved = fill_middle.move(pa.array(texts), drawn, CUTS)
    outputs = fill_middle.texts_of(moved.data, moved.bounds)
    assert set(moved.form) == {"plain", "psm", "spm"}
    for i, (text, output) in enumerate(zip(texts, outputs.to_pylist())):
        n, form, prefix, middle, want = by_hand(i, text)
        assert (moved.n[i], moved.form[i], output) == (n, form, want)
        if form != "plain":
            assert (moved.prefix_chars[i], moved.middle_chars[i]) == (prefix, middle)
    back = fill_middle.bring_back(outputs, moved.form.tolist(), CUTS)
    assert fill_middle.texts_of(*back).to_pylist() == texts


def test_displaced_places_every_byte():
    places = fill_middle.displaced(np.array([0, 2, 2, 5]), np.array([3, 9, 0, -5]), 7)
    assert places.tolist() == [3, 4, 2, 3, 4, 0, 1]
    assert fill_middle.displaced(np.array([], int), np.array([], int), 0).tolist() == []


def test_slices_are_bounded_and_whole():
    column = pa.array(["ab", "", "c" * 10, "d", "é"])
    assert list(fill_middle.slices(column, 4)) == [(0, 2), (2, 3), (3, 5)]
    assert list(fill_middle.slices(column.slice(0, 0), 4)) == []


def test_awkward_rows(spark, tmp_path):
    folder = save(spark, awkward(spark), tmp_path)
    name = "op11_displacement_scatter"
    assert spark_rows(QUERIES[name](spark, folder)) == sql_rows(folder, ORACLE[name])


def test_shares_and_other_marks(spark):
    docs = spark.createDataFrame([(i, f"one {i}\ntwo\nthree\n<P>" if i % 7 == 0 else f"one {i}\ntwo\n") for i in range(400)], "doc_id bigint, text string")
    cuts = fill_middle.Cuts(percent=40, suffix_first=0, prefix="[pre]", suffix="[suf]", middle="[mid]")
    rows = fill_middle.restored(fill_middle.fill_in_middle(docs, cuts), cuts).collect()
    texts = {row.doc_id: row.text for row in docs.collect()}
    for row in rows:
        assert row.restored == texts[row.doc_id]
        assert row.form == ("psm" if numbers(row.doc_id)[2] % 100 < 40 else "plain")
        assert row.form == "plain" or row.output.startswith("[pre]")


@pytest.mark.parametrize("marks", [("a", "a", "b"), ("ab", "bc", "d"), ("é", "b", "c"), ("", "b", "c"), ("aba", "c", "d"), ("abc", "b", "d")])
def test_marks_that_overlap_are_refused(marks):
    with pytest.raises(ValueError):
        fill_middle.Cuts(prefix=marks[0], suffix=marks[1], middle=marks[2])


def test_empty_table_and_kept_columns(spark):
    moved = fill_middle.restored(fill_middle.fill_in_middle(empty(spark)))
    assert moved.collect() == [] and moved.columns[-1] == "restored"
    given = spark.createDataFrame([(1, "<P>a\n<S>c<M>b\n", "psm", "x"), (2, None, "plain", "y")], "id int, output string, form string, restored string")
    assert [(r.id, r.restored) for r in fill_middle.restored(given).orderBy("id").collect()] == [(1, "a\nb\nc"), (2, "")]
