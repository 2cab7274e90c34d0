"""Deduplication, language and benchmark operators against plain versions."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from covey.llm import anchors, decontamination, fmindex, langid, ngrams, queries, suffixes
from covey.llm.components import bitmap, components, passes
from tests.llm import brute
from tests.llm.fixtures import make_docs, table_dir

ODD = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "one"), (905, "ab" * 150)]


def _pieced(seed, n, alphabet, parts=6):
    pick = random.Random(seed)
    base = ["".join(pick.choices(alphabet, k=90)) for _ in range(6)]
    rows = []
    for i in range(n):
        cuts = [pick.choice(base)[pick.randint(0, 20) : pick.randint(20, 90)] for _ in range(pick.randint(0, parts))]
        rows.append((i, "".join(cuts) + "".join(pick.choices(alphabet, k=3))))
    return rows


def test_components(spark):
    pick = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(pick.randint(0, 60), pick.randint(0, 60)) for _ in range(40)]
    df = spark.createDataFrame([*edges, (5, 5), (None, 3), (7, None)], "a long, b long").repartition(7)
    got = {r.node: r.root for r in components(df).collect()}
    sets = {i: {i} for e in edges for i in e}
    for a, b in edges:
        joined = sets[a] | sets[b]
        for i in joined:
            sets[i] = joined
    assert got == {i: min(s) for i, s in sets.items() if min(s) != i}
    assert components(df.limit(0)).count() == 0


def test_bitmap_has_no_false_misses(spark):
    df = spark.range(-500, 500).select((F.col("id") * 977).alias("v"))
    table = bitmap(df, "v", 12).value
    assert passes(table, np.arange(-500, 500) * 977).all()
    assert not passes(bitmap(df.limit(0), "v", 12).value, np.arange(50)).any()


@pytest.mark.parametrize("span,gram,block", [(12, 4, 1 << 20), (10, 3, 64), (100, 32, 1 << 20)])
def test_suffixes(spark, monkeypatch, span, gram, block):
    monkeypatch.setattr(anchors, "_BLOCK", block)
    rows = _pieced(span, 50, "abé ", 12 if span == 100 else 6) + ODD
    got = sorted((*r[:4], bytes(r[4])) for r in suffixes.remove_repeats(make_docs(spark, rows).repartition(3), span, gram).collect())
    assert got == sorted(brute.byte_repeats(rows, span))


def test_suffixes_with_null_and_repeated_ids(spark):
    rows = [(None, "x" * 30), (3, "abcdefghijklmnop"), (3, "abcdefghijklmnop"), (None, "zabcdefghijklmnop")]
    got = sorted((str(r[0]), r[1], r[2]) for r in suffixes.remove_repeats(make_docs(spark, rows), 12, 4).collect())
    # Null ids come first; the second of two equal rows repeats the first.
    assert got == [("3", 16, 16), ("3", 16, 16), ("None", 17, 0), ("None", 30, 29)]
    assert suffixes.remove_repeats(make_docs(spark, rows).limit(0)).count() == 0


def test_matching_statistics():
    pick = random.Random(2)
    for _ in range(60):
        texts = [[pick.randint(1, pick.choice([2, 3, 6])) for _ in range(pick.randint(0, 14))] for _ in range(5)]
        weight = [pick.randint(1, 2) for _ in texts]
        at = np.cumsum([0] + [len(t) for t in texts])
        if at[-1] == 0:
            continue
        index = fmindex.FmIndex(np.array(sum(texts, []), np.uint64), at, np.array(weight))
        found, count = index.matches(), {}
        for t, w in zip(texts, weight, strict=True):
            for i, j in itertools.combinations(range(len(t) + 1), 2):
                count[tuple(t[i:j])] = count.get(tuple(t[i:j]), 0) + w
        for t, first in zip(texts, index.first, strict=True):
            for i in range(len(t)):
                longest = max((j - i for j in range(i + 1, len(t) + 1) if count[tuple(t[i:j])] >= 2), default=0)
                assert found[first + i] == longest


@pytest.mark.parametrize("span,gram,block", [(6, 2, 1 << 20), (5, 2, 40)])
def test_fm_index(spark, monkeypatch, span, gram, block):
    monkeypatch.setattr(anchors, "_BLOCK", block)
    rows = _pieced(span, 50, ["a ", "b ", "c\n", "a"]) + ODD + [(910, "x y z w v u t"), (911, "x y z w v u t")]
    got = sorted((*r[:3], bytes(r[3])) for r in fmindex.remove_repeats(make_docs(spark, rows).repartition(3), span, gram).collect())
    assert got == sorted(brute.window_repeats(rows, span))


def test_many_contexts_of_one_gram(spark, monkeypatch):
    """One gram in the middle of ever different surroundings."""
    rows = [(i, f"{i} {i * 7} common words here now {i * 3} {i}") for i in range(300)]
    rows += [(500 + i, f"q{i} r{i} s common words here now t{i % 2} u") for i in range(4)]
    got = sorted((*r[:3], bytes(r[3])) for r in fmindex.remove_repeats(make_docs(spark, rows).repartition(5), 5, 3).collect())
    assert got == sorted(brute.window_repeats(rows, 5))


@pytest.mark.parametrize("hot", [0, 600])
def test_hot_grams_are_split(spark, monkeypatch, hot):
    """Grams with more contexts than one task should hold give the same repeats."""
    monkeypatch.setattr(anchors, "_HOT", hot)
    rows = _pieced(12, 50, "abé ", 6) + ODD
    got = sorted((*r[:4], bytes(r[4])) for r in suffixes.remove_repeats(make_docs(spark, rows).repartition(3), 12, 4).collect())
    assert got == sorted(brute.byte_repeats(rows, 12))
    rows = _pieced(6, 50, ["a ", "b ", "c\n", "a"]) + ODD + [(910, "x y z w v u t"), (911, "x y z w v u t")]
    rows += [(1000 + i, f"{i} {i * 7} common words here now {i % 3} {i % 2} t") for i in range(100)]
    got = sorted((*r[:3], bytes(r[3])) for r in fmindex.remove_repeats(make_docs(spark, rows).repartition(3), 6, 2).collect())
    assert got == sorted(brute.window_repeats(rows, 6))


def test_no_rows_of_a_key_are_dropped():
    """Beyond 2 GB Arrow cuts a key's content in several batches: an error, not a loss."""
    batch = pa.record_batch({"key": np.zeros(1100, np.int64), "stretch": pa.array([bytes(1 << 20)] * 1100, pa.binary())})
    with pytest.raises(OverflowError):
        print([b.num_rows for b in anchors.whole_keys(iter([batch, batch]), 1 << 40)])


def test_jaccard(spark):
    pick = random.Random(4)
    rows = list(ODD)
    for i in range(60):
        words = pick.choices("abcdefghijklmnopqrstuvwxyz", k=pick.randint(0, 60))
        for j in range(pick.randint(1, 4)):
            rows.append((i * 10 + j, " ".join(w.upper() if pick.random() < 0.1 else w for w in words)))
            if words:
                words[pick.randrange(len(words))] = "zz"
    sets = {i: brute.shingles(t) for i, t in rows}
    want = brute.classes(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngrams.jaccard_classes(make_docs(spark, rows).repartition(4)).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


def test_jaccard_group_of_near_copies(spark):
    """Many edited copies of one text: most pairs of them don't link, all link with the text."""
    pick = random.Random(6)
    text = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(text))]
    for i in range(1, 120):
        copy = list(text)
        for _ in range(pick.randint(1, 4)):
            copy[pick.randrange(150)] = f"x{pick.random()}"
        rows.append((i, " ".join(copy)))
    sets = {i: brute.shingles(t) for i, t in rows}
    want = brute.classes(sets)
    got = {r.doc_id: r.component_id for r in ngrams.jaccard_classes(make_docs(spark, rows)).collect()}
    assert got == want


def test_jaccard_of_a_shared_phrase(spark, monkeypatch):
    """A phrase in a third of all documents, of all sizes and different classes, short enough to be in
    every prefix; near copies among them."""
    pick = random.Random(21)
    phrase = "we are very sorry indeed".split()
    rows = []
    for i in range(300):
        own = [f"w{pick.randint(0, 10**6)}" for _ in range(pick.randint(1, 40))]
        rows.append((i, " ".join(phrase + own if i % 3 == 0 else own + own[:2])))
    rows += [(1000 + i, rows[3 * i][1] + " " + rows[3 * i][1].split()[-1]) for i in range(40)]
    # Without a first pass all links are the prefix join's.
    monkeypatch.setattr(ngrams, "_neighbours", lambda kept: kept.selectExpr("rep AS a", "rep AS b").limit(0))
    sets = {i: brute.shingles(t) for i, t in rows}
    want = brute.classes(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngrams.jaccard_classes(make_docs(spark, rows)).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}
    assert len(set(want.values())) < len(rows) - 10


def test_jaccard_null_and_repeated_rows(spark):
    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (5, "A B C D E F")]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngrams.jaccard_classes(make_docs(spark, rows)).collect())
    assert got == [("2", 2, "2"), ("2", 2, "2"), ("5", 2, "2"), ("None", 2, "None")]
    assert ngrams.jaccard_classes(make_docs(spark, rows).limit(0)).count() == 0


def test_masks_miss_nothing():
    for two in itertools.combinations(range(decontamination.STRETCH), decontamination.SUBSTITUTED):
        assert any(
            all(at + i not in two for i, bit in enumerate(mask) if bit == "1")
            for mask in decontamination.MASKS
            for at in range(decontamination.STRETCH - len(mask) + 1)
        )


def test_leaks(spark):
    pick = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(pick.choices(words, k=pick.randint(3, 40)))) for i in range(25)] + [(99, None), (98, "")]
    docs = list(ODD)
    for d in range(50):
        w = pick.choices(words, k=pick.randint(0, 60))
        for _ in range(pick.randint(0, 2)):
            x = (pick.choice(items)[1] or "a").split()
            x = x[pick.randint(0, len(x) // 3) :]
            for _ in range(pick.randint(0, 5)):
                x[pick.randrange(len(x))] = "zz"
            at = pick.randint(0, len(w))
            w[at:at] = x
        docs.append((d, " ".join(y.upper() + pick.choice(["", "!", ","]) for y in w)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    table = make_docs(spark, docs)
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(table, benchmark).collect()}
    want = {(d, i) for d, i, _ in brute.leaks(docs, items)}
    assert got == want and want
    kept = {r.doc_id for r in decontamination.clean(table, benchmark).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}
    assert decontamination.leaks(table, benchmark.limit(0)).count() == 0
    assert decontamination.leaks(table.limit(0), benchmark).count() == 0


def test_language(spark, sf_dir):
    rows = queries.op5_language_id(spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    held = rows.filter("held_out")
    assert held.filter("lang = lang_pred").count() >= 0.95 * held.count()
    assert rows.filter("score < 0 OR score > 1").count() == 0


def test_language_of_odd_texts(spark):
    labelled = [(i, ("der die das und ist nicht " if i % 2 else "the of and to is not ") * 3, "de" if i % 2 else "en", None, None) for i in range(200)]
    odd = [(1000, None, "en", None, None), (1001, "", None, None, None), (1002, "123 !?", "de", None, None), (None, "the of and", None, None, None), (1003, "der die das " * 2000, None, None, None)]
    docs = spark.createDataFrame(labelled + odd, "doc_id long, text string, lang string, source string, lang_score string")
    net = langid.fit(docs)
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in langid.predict(docs, net).collect()}
    assert [got[i] for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003][0] == "de" and got[None][0] == "en" and got[1003][1] > 0.9
    assert langid.fit(docs.limit(0)) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}


def test_queries_match_plain_versions(spark, tmp_path):
    rows = [(i, f"a{i} " + "m n o p q r s t u v w x y z " * 3 + f"b{i}") for i in range(3)]
    path = table_dir(tmp_path, spark, documents=make_docs(spark, rows), benchmark=spark.createDataFrame([(1, "m n o p q")], "item_id long, text string"))
    for query in (queries.op6_suffix_dedup, queries.op9_fm_index, queries.op7_ngram_jaccard):
        assert query(spark, path).count() == 3
    assert {r.doc_id for r in queries.op10_decontamination(spark, path).collect()} == {0, 1, 2}
