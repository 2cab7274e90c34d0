"""Spelling variants against a plain search of the deletion neighbourhood."""

import collections
import itertools
import re
import zlib

import pytest

from covey.llm import queries, spelling
from tests.llm.fixtures import make_docs, table_dir

LOWER = {k: k + 32 for k in range(65, 91)}


def plain_words(rows):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_near(words):
    holes = collections.defaultdict(list)
    for w in words:
        for i in range(len(w)):
            holes[i, len(w), w[:i] + w[i + 1 :]].append(w)
    near = collections.defaultdict(set)
    for same in holes.values():
        for a, b in itertools.permutations(same, 2):
            near[a].add(b)
    for w in words:
        for i in range(len(w)):
            if (shorter := w[:i] + w[i + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    return near


def plain(rows):
    words = plain_words(rows)
    near = plain_near(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def result(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_plain_near_is_one_edit():
    words = ["abcdefg", "abcdefh", "abcdef", "bcdefg", "xabcdefg", "abdcefg", "aaaaaaa", "aaaaaaaa"]
    near = plain_near(dict.fromkeys(words, 2))
    for a, b in itertools.permutations(words, 2):
        assert (b in near[a]) == one_edit(a, b)


def test_query_against_plain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = plain([tuple(r) for r in docs])
    assert any(x[0] for x in want.values())
    assert result(queries.op12_spelling_tiles(spark, sf_dir)) == want


EDGES = [
    (1, None),
    (2, ""),
    (3, " \n"),
    (None, "Reference REFERENCE referenceÀÿ× referencĀe"),
    (4, "straßenbahn Straßenbahn straßenbah strafßenbahn Éléphanté Éléphanté éléphanté éléphanté"),
    (5, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa"),
    (6, " ".join(["popular"] * 2000 + ["populer"] * 150 + ["ppopular"] * 150 + ["popule"] * 9 + ["populerr"] * 3 + ["opuler"] * 3)),
    (7, ("long" * 900 + " ") * 2 + "lonG" * 899 + "lon long " + "long" * 899 + "lon"),
    (7, "abcdefgh abcdefgh"),
    (8, " ".join(f"shared{a}{b}ending" for a in "abcdefghijklmnop" for b in "abcdefghijklmnop" for _ in range(2))),
]


@pytest.mark.parametrize("largest", [512, 6])
def test_edges_and_crowded_keys(spark, tmp_path, largest, monkeypatch):
    """With a small limit crowded keys are split down to single places."""
    rows = EDGES * 2
    folder = table_dir(tmp_path, spark, documents=make_docs(spark, rows))
    want = plain(rows)
    assert max(x[3] for x in want.values()) >= 30
    near = spelling.near
    monkeypatch.setattr(spelling, "near", lambda counted: near(counted, largest))
    assert result(queries.op12_spelling_tiles(spark, folder)) == want


def test_chain_of_forms(spark, tmp_path):
    words = {"abcdefghij": 3000, "abcdefghix": 280, "abcdefghxx": 25, "abcdefgxxx": 2}
    rows = [(1, " ".join(w for w, n in words.items() for _ in range(n)))]
    got = result(spelling.variants(make_docs(spark, rows)))
    assert got == plain(rows)
    assert got["abcdefgxxx"][:2] == ("abcdefghxx", "abcdefghij")


def test_blocks_of_a_large_tile(spark):
    """Groups beyond a block: pairs within and between blocks, of both lengths."""
    words = {f"prefix{a}{b}": 2 + i for i, (a, b) in enumerate(itertools.product("abcdefghijklmnopqrst", repeat=2))}
    words |= {f"prefix{a}{b}c": 2 for a in "abcdefghij" for b in "ab"}
    counted = spark.createDataFrame(list(words.items()), "word string, n long")
    near = plain_near(words)
    for largest in (4096, 3):
        got = {r["word"]: (r["n_near"], r["best"]["word"]) for r in spelling.near(counted, largest).collect()}
        assert got == {w: (len(x), min(x, key=lambda y: (-words[y], y))) for w, x in near.items() if x}


def test_empty_table(spark):
    assert spelling.variants(make_docs(spark, [])).collect() == []
