import math
from collections import Counter

import numpy as np
import pytest
from helpers_llm import awkward

from granero.llm import weighted_minhash as near


def brute_classes(rows, idf):
    """Smallest id of every connected class by all pairs."""
    texts = sorted({text or "" for _, text in rows})
    found = near.similarities(texts, idf) >= near.SIMILARITY
    label = list(range(len(texts)))
    for one, other in zip(*np.nonzero(np.tril(found, -1))):
        a, b = label[one], label[other]
        label = [b if x == a else x for x in label]
    of = {text: label[i] for i, text in enumerate(texts)}
    least = {}
    for doc, text in rows:
        own = of[text or ""]
        least[own] = min(least.get(own, (2, 0)), (doc is not None, doc or 0))
    return {(doc, text): least[of[text or ""]] for doc, text in rows}


def brute_rarity(texts, share, least):
    """IDF of every shingle by a dictionary of all of them."""
    df = Counter(name for text in texts for name in near.shingles(text)[0].tolist())
    floor = max(least, math.ceil(len(texts) * share))
    return {name: math.log((1 + len(texts)) / (1 + max(n, min(floor, len(texts))))) + 1 for name, n in df.items()}


def classes(docs, **options):
    return {r.doc_id: r.class_id for r in near.near_duplicates(docs, **options).collect()}


def test_classes_equal_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_classes(rows, near.inverse_frequencies(docs))
    assert classes(docs) == {doc: least[1] for (doc, _), least in want.items()}
    kept = near.one_per_class(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({least for least in want.values()})


def test_large_groups_are_split_and_connected(spark, monkeypatch):
    monkeypatch.setattr(near, "MEMBERS_IN_TASK", 3)
    words = [f"word{i}" for i in range(300)]
    rows = [(i, " ".join(words[:i] + [f"new{i}"] + words[i + 1 :])) for i in range(30)]
    rows += [(100 + i, " ".join(words[:150] + [f"other{i}x{j}" for j in range(150)])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = classes(docs)
    assert {found[i] for i in range(30)} == {0}
    assert all(found[100 + i] == 100 + i for i in range(12))


def test_links_of_a_large_class_are_called_spanning(spark):
    words = [f"word{i}" for i in range(300)]
    rows = [(i, " ".join(words[: 7 * i] + [f"new{i}"] + words[7 * i + 1 :])) for i in range(40)]
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.class_id for r in found} == {0}
    # All 780 pairs are similar; far fewer links connect them.
    assert 2 * 39 <= sum(r.n_links for r in found) < 780
    assert "spanning links" in near.near_duplicates.__doc__


def test_pairs_inside_a_large_group_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near, "MEMBERS_IN_TASK", 5)
    shared = [f"word{i}" for i in range(500)]
    rows = []
    for i in range(70):
        # Of every seven texts two have some of their own words in common.
        pair = i // 7 if i % 7 < 2 else 100 + i
        own = [f"own{pair}x{j}" for j in range(8)] + [f"last{i}x{j}" for j in range(9)]
        rows.append((i, " ".join(shared + own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_classes(rows, near.inverse_frequencies(docs))
    assert len({least for least in want.values()}) == 60
    assert classes(docs) == {doc: least[1] for (doc, _), least in want.items()}


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = near.near_duplicates(docs)
    assert found.count() == docs.count()
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[7].class_id == by_id[8].class_id == 7 and by_id[7].kept and not by_id[8].kept
    assert {by_id[i].class_id for i in (4, 5)} == {4} and by_id[6].class_id == 6
    assert by_id[None].class_id is None and by_id[None].kept
    assert near.one_per_class(docs).where("doc_id = 3").count() == 1


def test_samples_agree_as_often_as_the_similarity():
    one = [f"w{i}" for i in range(500)]
    other = [w if i % 50 else f"x{i}" for i, w in enumerate(one)] + one[:40]
    a, b = " ".join(one), " ".join(other)
    names = near.shingles(a)[0][::2]
    idf = near.Rarity(names, np.random.default_rng(2).uniform(1, 5, len(names)), 5.5)
    sampler = near.Sampler(near.Bands(bands=300), idf)
    exact = near.weighted_jaccard(near.bag(a, idf), near.bag(b, idf))
    assert abs((sampler.samples(a) == sampler.samples(b)).mean() - exact) < 0.06


def test_shingles_of_any_length():
    long = "y" * 200_000
    text = f"a b {long} c d e {long} f"
    assert len(near.shingles(text)[0]) == 4
    assert len(near.shingles("one two")[0]) == 1 and len(near.shingles(" \n ")[0]) == 0
    words = " ".join(f"w{i}" for i in range(60_000))
    found, counts = near.shingles(words)
    assert len(found) == 60_000 - 4 and counts.max() == 1


@pytest.mark.parametrize("share, least, parts", [(1 / 1024, 4, 3), (1 / 20, 4, 9), (1 / 8, 2, 40), (1 / 2, 30, 7)])
def test_frequencies_equal_a_dictionary(spark, sf_dir, share, least, parts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    docs = docs.unionByName(docs.limit(50)).unionByName(spark.createDataFrame([(None,), ("",), ("only one",)], "text string"))
    texts = [row.text or "" for row in docs.collect()]
    found = near.inverse_frequencies(docs.repartition(parts), share, least)
    want = brute_rarity(texts, share, least)
    names = np.array(sorted(want), np.uint64)
    assert np.allclose(found.of(names), [want[name] for name in names.tolist()], atol=1e-12)
    assert (np.diff(found.names.astype(object)) > 0).all()
    # Only shingles that are not rare have a row.
    assert len(found.names) == sum(idf < found.rare - 1e-12 for idf in want.values()) + sum(
        n == max(least, math.ceil(len(texts) * share)) for n in Counter(x for t in texts for x in near.shingles(t)[0].tolist()).values()
    )


def test_shingles_of_one_task_are_not_counted_on_the_driver(spark, monkeypatch):
    """Copies that lie together are in many documents of their task and in few of all."""
    given, count = [], near._exactly
    monkeypatch.setattr(near, "_exactly", lambda names: given.append(names) or count(names))
    own = "transform(sequence(1, 30), x -> concat('word', x, 'of', id div 25))"
    docs = spark.range(1600, numPartitions=16).selectExpr(f"concat_ws(' ', {own}, 'all these eight words are in each one') AS text")
    found = near.inverse_frequencies(docs, 1 / 20, 4)
    want = brute_rarity([row.text for row in docs.collect()], 1 / 20, 4)
    names = np.array(sorted(want), np.uint64)
    assert np.allclose(found.of(names), [want[name] for name in names.tolist()], atol=1e-12)
    assert len(found.names) == 4 and len(want) > 64 * 26
    # Of the 1,664 shingles that 25 copies in one task share none.
    assert len(given) == 1 and len(given[0]) < 50


def test_similarities_are_those_of_exact_weights(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {row.doc_id: row.text or "" for row in docs.collect()}
    want = brute_rarity(list(rows.values()), near.RARE_SHARE, near.RARE_LEAST)
    idf = near.inverse_frequencies(docs)
    by_class = {}
    for row in near.near_duplicates(docs, similarity=0.6).collect():
        by_class.setdefault(row.class_id, []).append(rows[row.doc_id])
    pairs = 0
    for texts in by_class.values():
        for other in texts[1:6]:
            a, b = (Counter(dict(zip(*(x.tolist() for x in near.shingles(text))))) for text in (texts[0], other))
            weigh = [{name: n * want[name] for name, n in bag.items()} for bag in (a, b)]
            common = sum(min(weigh[0][name], weigh[1][name]) for name in a.keys() & b.keys())
            total = sum(sum(w.values()) for w in weigh) - common
            found = near.weighted_jaccard(near.bag(texts[0], idf), near.bag(other, idf))
            assert abs(found - (common / total if total else 0.0)) < 1e-9
            pairs += 1
    assert pairs > 10


def test_frequencies_of_nothing(spark):
    none = near.inverse_frequencies(spark.createDataFrame([], "text string"))
    assert len(none.names) == 0 and none.of(np.array([3], np.uint64)).tolist() == [1.0]


def test_texts_that_differ_only_in_signs_between_blanks_stay(spark):
    texts = ["f(x) = x + 1", "f(x) = x - 1", "f(x) == x * 1", "### $$$", "!!!", "+-+-+", "", None, " \n "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = classes(docs)
    assert found == {i: i for i in range(9)} | {7: 6}
    assert sorted(row.doc_id for row in near.one_per_class(docs).collect()) == [0, 1, 2, 3, 4, 5, 6, 8]
    words = " ".join(f"word{i}" for i in range(50))
    same = [(0, words), (1, words.upper() + "!"), (2, words.replace("word7 ", "word7, ")), (3, words)]
    assert set(classes(spark.createDataFrame(same, "doc_id bigint, text string")).values()) == {0}


@pytest.mark.parametrize("text, want", [
    ("A, b! c", "a  b  c"), ("x + y", "x + y"), ("(a) -> b", " a  -> b"), ("--", "--"), ("-a- --- é-", " a  --- é "),
    ("\t*\n", " * "), ("", ""), ("a  =", "a  ="), ("$a +", " a +"),
])
def test_words_of_signs(text, want):
    assert near.word_bytes(text).tobytes().decode() == want
