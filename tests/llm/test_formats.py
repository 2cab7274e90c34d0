"""Forest, token counts, archives, id files and the pipeline against plain versions."""

import heapq
import io
import random
import zipfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import tokenizers

import corpus_pipeline
from covey.llm import bpe, forest, huffman, queries, tokencounts, warc
from covey.llm.components import roots
from covey.sources import shared as written
from tests.llm import brute
from tests.llm.fixtures import make_docs, table_dir


# --- forest --------------------------------------------------------------------------------


def _table(spark, vectors, first=0):
    rows = [(first + i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, size string")


def test_forest_finds_all_links_here(spark):
    pick = np.random.default_rng(3)
    centres = pick.normal(size=(120, 24))
    x = np.concatenate([centres, centres[:40] + pick.normal(size=(40, 24)) * 0.1, centres[:1] + pick.normal(size=(150, 24)) * 0.12, centres[5:8]])
    x = x.astype(np.float32).astype(np.float64)
    near = brute.cosine_links(x)
    a, b = np.nonzero(near)
    want = {i: (int(near[i].sum()), int(r)) for i, r in enumerate(roots(len(x), a, b))}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in forest.near_duplicates(_table(spark, x), leaf=32).collect()}
    assert {i: g[:2] for i, g in got.items()} == want
    assert all(g[2] == (g[1] == i) for i, g in got.items())
    # However small the largest node may be, links are never invented, and classes are kept.
    split = forest.near_duplicates(_table(spark, x), leaf=32, largest=64).collect()
    assert all(r.n_links <= want[r.vec_id][0] for r in split)


def _wanted(x):
    near = brute.cosine_links(x)
    return {i: (int(near[i].sum()), int(r)) for i, r in enumerate(roots(len(x), *np.nonzero(near)))}


def test_forest_leaves_beyond_the_largest(spark):
    """Groups that no split takes apart, compared in blocks by many tasks: every link counts."""
    pick = np.random.default_rng(5)
    centres = pick.normal(size=(60, 24))
    x = np.concatenate([centres, centres[:1] + pick.normal(size=(420, 24)) * 0.1, centres[1:2] + pick.normal(size=(260, 24)) * 0.02, centres[5:8]])
    x = x.astype(np.float32).astype(np.float64)
    got = forest.near_duplicates(_table(spark, x), leaf=32, largest=64).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == _wanted(x)


def test_forest_margin_keeps_wide_groups():
    """A wide, dense group: of its pairs near the threshold, few are parted by one split."""
    pick = np.random.default_rng(8)
    centre = pick.normal(size=64)
    x = centre / np.linalg.norm(centre) + pick.normal(size=(1500, 64)) * 0.028
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    dots = x @ x.T
    a, b = np.nonzero(np.triu((dots >= 0.95) & (dots < 0.955), 1))
    margin = forest._MARGIN * np.sqrt(2 * 0.05 / 64)
    parted = []
    for tree in range(40):
        p = x @ forest._directions(tree, 64, 64)[:, 0]
        p -= np.median(p)
        parted.append(((p[a] > margin) & (p[b] <= -margin) | (p[b] > margin) & (p[a] <= -margin)).mean())
    assert len(a) > 10000 and np.mean(parted) < 0.1  # 0.07; at a margin of 0.35 0.19


def test_forest_recall_on_planted_vectors(spark):
    """Ten thousand vectors: single ones, pairs just above and below the threshold, and a wide
    group in which many pairs are near it. No link is invented, and of 1,000 hardly one is missed."""
    pick = np.random.default_rng(12)
    x = pick.normal(size=(7_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turned = x[:1_000] + pick.normal(size=(1_000, 64)) * 0.041
    wide = x[-1] + pick.normal(size=(2_000, 64)) * 0.028
    x = np.concatenate([x, turned, wide]).astype(np.float32).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = np.concatenate([(unit[i : i + 1000] @ unit.T >= 0.95).sum(1) for i in range(0, len(x), 1000)]) - 1
    near = np.concatenate([((d := unit[i : i + 1000] @ unit.T) >= 0.95).sum() - ((d >= 0.955).sum()) for i in range(0, len(x), 1000)], axis=None)
    assert near.sum() > 20_000
    got = {r.vec_id: r.n_links for r in forest.near_duplicates(_table(spark, x)).collect()}
    n_links = np.array([got[i] for i in range(len(x))])
    assert (n_links <= want).all()
    assert n_links.sum() >= 0.999 * want.sum()


def test_forest_odd_vectors(spark):
    good = [1.0, 2.0, 3.0]
    vectors = [good, None, [], [0.0, 0.0, 0.0], [1.0, None, 3.0], [float("nan"), 2.0, 3.0], [float("inf"), 2.0, 3.0], good, [1.0, 2.0], [2.0, 4.0, 6.0]]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in forest.near_duplicates(_table(spark, vectors)).collect()}
    assert got[0] == (2, 0, True) and got[7] == (2, 0, False) and got[9] == (2, 0, False)
    assert all(got[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 6, 8))
    null = spark.createDataFrame([(None, good, "x"), (1, good, "x"), (1, good, "x")], "vec_id long, embedding array<float>, size string")
    assert sorted(map(str, map(tuple, forest.near_duplicates(null).collect()))) == ["(1, 1, 1, True)", "(1, 1, 1, True)", "(None, 0, None, None)"]
    assert forest.near_duplicates(null.limit(0)).count() == 0


# --- token counts --------------------------------------------------------------------------


@pytest.mark.parametrize("rule", tokencounts.RULES)
def test_token_counts(spark, rule):
    pick = random.Random(5)
    texts = ["".join(pick.choices(["word", " the", "\n", "\n\n", " ", "é", "中", "'s"], k=pick.randint(0, 60))) for _ in range(30)]
    rows = [*enumerate(texts), (100, None), (101, ""), (102, "\n"), (102, "\n")]
    library = tiktoken.Encoding("own", pat_str=queries.public_tokenizers.PATTERN, mergeable_ranks=bpe.coder(queries.BYTE_BPE, queries.public_tokenizers.PATTERN).ranks, special_tokens={})
    want = []
    for i, text in rows:
        text = text or ""
        lines = text.splitlines(keepends=True) if text else [""]
        owner = [k for k, line in enumerate(lines) for _ in line.encode()]
        got, at = [0.0] * len(lines), 0
        for token in library.encode_ordinary(text):
            n = len(library.decode_single_token_bytes(token))
            mine = owner[at : at + n]
            at += n
            if rule == "start":
                got[mine[0]] += 1
            elif rule == "share":
                for k in mine:
                    got[k] += 1 / n
            else:
                got[max(sorted(set(mine)), key=mine.count)] += 1
        begin = 0
        for k, line in enumerate(lines):
            want.append((i, k, begin, begin + len(line), round(got[k], 6)))
            begin += len(line)
    result = tokencounts.section_tokens(make_docs(spark, rows), queries.BYTE_BPE, queries.public_tokenizers.PATTERN, rule)
    assert sorted((*r[:4], round(r[4], 6)) for r in result.collect()) == sorted(want)


# --- archives ------------------------------------------------------------------------------


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def test_warc_round_trip(spark, tmp_path):
    long, other = "é" * 600, "x" * 1000
    rows = [(1, "http://a/ b\r\n", long), (2, None, long), (3, "u", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", other), (7, "u", other), (None, "u", other), (None, "v", other), (8, "u", "y" * 999), (9, "u", "y" * 999)]
    pages = _pages(spark, [(*r, "x") for r in rows]).repartition(3)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, None if r.payload is None else bytes(r.payload)) for r in warc.read(warc.write(pages, f"file://{tmp_path}/w")).collect()), key=str)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        if i in (1, 2):
            want.append((i, "revisit", 3, len(data), None))
        else:
            want.append((i, "response", None, len(data), data))
    assert got == sorted(want, key=str)
    assert warc.read(warc.write(pages.limit(0), f"file://{tmp_path}/e")).count() == 0


def test_query_of_odd_pages(spark, tmp_path):
    path = table_dir(tmp_path, spark, pages=_pages(spark, [(1, "a", "z" * 1500, "x"), (2, "b", "z" * 1500, "x"), (3, "c", None, "x")]))
    got = sorted(map(tuple, queries.op4_warc_zip(spark, path).collect()))
    assert [(g[0], g[1], g[3], g[4]) for g in got] == [(1, 1500, "revisit", 2), (2, 1500, "response", None), (3, 0, "response", None)]


@pytest.mark.parametrize("limit", [None, 10])
def test_zip_directory(monkeypatch, limit):
    """The parser against the library's own, with and without ZIP64 records."""
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as made:
        made.writestr("a.txt", b"first" * 9)
        made.writestr("b/é.bin", b"second" * 99, zipfile.ZIP_DEFLATED)
        made.writestr("c", b"")
        made.comment = b"a comment with PK\x05\x06 in it" + bytes(30)
    data = out.getvalue()
    source = pa.BufferReader(data)

    class Random:
        def size(self):
            return len(data)

        def read_at(self, n, at):
            return source.read_at(n, at)

    members = {m.name: m for m in warc.directory(Random())}
    assert {n: m.stored for n, m in members.items()} == {"a.txt": True, "b/é.bin": False, "c": True}
    m = members["a.txt"]
    assert data[m.start(Random()) : m.start(Random()) + m.size] == b"first" * 9
    with pytest.raises(ValueError):
        warc.directory(type("Empty", (), {"size": lambda s: 30, "read_at": lambda s, n, a: bytes(n)})())


def test_damaged_payload():
    raw = warc.record(5, "u", b"payload", None)
    assert warc.parse(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"payload\r\n\r\n", b"paybond\r\n\r\n"))


# --- id files ------------------------------------------------------------------------------


def test_code_lengths_are_the_best():
    pick = random.Random(3)
    for n in (1, 2, 3, 10, 300):
        counts = np.array([int(pick.paretovariate(0.4)) for _ in range(n)])
        lengths = huffman.code_lengths(counts, 24)
        heap, total = counts.tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            total += both
            heapq.heappush(heap, both)
        assert lengths.max() > 23 or int((lengths * counts).sum()) == (total or int(counts.sum()))
        short = huffman.code_lengths(counts, 9)
        assert short.max() <= 9 and sum(2.0 ** -int(x) for x in short) <= 1
        ids = np.random.default_rng(1).choice(n, 5000)
        blocks = [huffman.pack(ids[a:b], huffman.canonical(short), short) for a, b in ((0, 3000), (3000, 5000))]
        assert (huffman.Decoder(short).blocks(blocks) == ids).all()
    assert not huffman.code_lengths(np.zeros(4, int)).any()
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, int), 3)


def test_id_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK", 64)
    library = tokenizers.Tokenizer.from_file(queries.WORD_BPE)
    specials = ["a <|endoftext|> b", "A<|startoftext|>", "<|ENDOFTEXT|> <|endoftext |>", "<|endoftext|>" * 3 + " It's"]
    rows = [(20 + i, t) for i, t in enumerate(specials)] + [(None, "null id"), (5, None), (7, ""), (-3, "Héllo  Wörld's\n\tand more <|endoftext|> é"), (9, "word " * 400), (11, "x"), (11, "x"), (2, " lead and trail ")]
    want, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((str(i), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    manifest = huffman.write(make_docs(spark, rows).repartition(3), queries.WORD_BPE, f"file://{tmp_path}/h", ids_per_file=100)
    got = sorted((str(r[0]), *r[1:]) for r in huffman.read(manifest).collect())
    assert got == sorted(want) and manifest.count() > 1
    none = huffman.write(make_docs(spark, rows).limit(0), queries.WORD_BPE, f"file://{tmp_path}/e")
    assert huffman.read(none).count() == 0


@pytest.mark.parametrize("known", [True, False])
def test_tokenizer_as_the_library(monkeypatch, known):
    """With the rules it knows, and with others, under which whole texts go to the library."""
    if not known:
        monkeypatch.setattr(huffman, "_SPLITTER", {})
    library = tokenizers.Tokenizer.from_file(queries.WORD_BPE)
    mine = huffman.WordTokenizer(queries.WORD_BPE)
    assert mine.by_words == known
    texts = ["", "It's <|endoftext|>here", "<|ENDOFTEXT|>!", "naïve e\u0301tude, 12 <|startoftext|><|endoftext|>.", "plain words. plain"]
    for _ in range(2):
        for text, ids in zip(texts, mine.encode(texts), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_of_letters_pass_the_rules_by(monkeypatch):
    """Words of Latin-1 letters, also around the end of a line, go to the model alone; ids are the library's."""
    library = tokenizers.Tokenizer.from_file(queries.WORD_BPE)
    mine = huffman.WordTokenizer(queries.WORD_BPE)
    every = [chr(c) for c in range(0x21, 0x250)]
    texts = [
        "first line.\nSecond\r\nthird\tline\n\n\u0301x \n",
        " ".join("w" + c + "o" for c in every) + "\n" + "\n".join(every),
        "\u212Aelvin \u212Bngstr\u00F6m \u0130stanbul STRASSE stra\u1E9Ee e\u0301\ne \u0301 a\u00ADb \u00B5m \u00AA " + "long" * 40,
    ]
    for _ in range(2):
        for text, ids in zip(texts, mine.encode(texts), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    asked = []

    class Watched:
        encode_special_tokens = False

        def encode_batch_fast(self, some, **given):
            asked.extend(some)
            return library.encode_batch_fast(some, **given)

    mine.library = Watched()
    mine.encode(["Plain words\nover\u00E9 LINES.\nand More"])
    assert not asked


def test_a_word_is_learned_once_however_it_stands():
    """Capitals, brackets and other punctuation around a word make no other words of it."""
    library = tokenizers.Tokenizer.from_file(queries.WORD_BPE)
    mine = huffman.WordTokenizer(queries.WORD_BPE)
    text = 'Word, (word) "WORD" word\tword-word;\u00C9t\u00E9. (\u00E9t\u00E9)'
    asked = []

    class Model:
        def tokenize(self, word):
            asked.append(word)
            return library.model.tokenize(word)

    mine.model = Model()
    for _ in range(2):
        assert mine.encode([text, "word"])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert asked[0] == "word" and len(asked) == 3  # of the other one, with and without a capital letter


def test_borders_of_words_as_the_library(monkeypatch):
    """Every pair of bytes' characters, letters that normal form C parts, long texts and words, a full table."""
    library = tokenizers.Tokenizer.from_file(queries.WORD_BPE)
    first = [chr(c) for c in range(256)]
    texts = ["x" + a + " ".join(a + b + "y" for b in first) for a in first]
    texts += ["\u00E9\u0958, \u0958.b \uFB2A!", "H\u0331 h\u0331 I\u0307, A\u0301. (A\u0301)", "", "A", "\u0301b", "'S 's'st ('s", "w" * 70 + ". " + "W" * 70]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for kept, long in ((1 << 20, 1 << 22), (50, 1 << 22), (1 << 20, 20)):
        monkeypatch.setattr(huffman, "_WORDS_KEPT", kept)
        monkeypatch.setattr(huffman, "_LONG", long)
        mine = huffman.WordTokenizer(queries.WORD_BPE)
        for a in range(0, len(texts), 40):
            assert [ids.tolist() for ids in mine.encode(texts[a : a + 40])] == want[a : a + 40]
        assert not any(len(w) > 64 for w in mine.words) and len(mine.ids) == mine.ends[-1]


# --- pipeline ------------------------------------------------------------------------------


def test_pipeline_keeps_odd_columns_and_rows(spark, tmp_path):
    """Clashing names, null and repeated ids, null and empty texts; an empty table."""
    taken = ["_num", "_kept", "lang_pred", "lang_score", "num", "rep", "key", "found", "packed", "component_id", "item_id", "other_5"]
    pick = random.Random(4)

    def text(n):
        return " ".join(pick.choice("the of and to in is that for it with was".split()) + pick.choice("abcdefgh") * pick.randint(0, 4) for _ in range(n))

    first = text(60)
    rows = [(i, text(60), "en") for i in range(30)] + [(50, None, "en"), (51, "", None), (None, text(50), "en"), (None, text(50), "en"), (7, text(50), "en"), (60, first, "en"), (61, first, "en")]
    docs = spark.createDataFrame([(*r, 0, *taken) for r in rows], ", ".join(["doc_id long", "text string", "lang string", "n_chars int", *[f"`{t}` string" for t in taken]]))
    path = table_dir(tmp_path, spark, benchmark=spark.createDataFrame([(1, "nothing of this is anywhere " * 4)], "item_id long, text string"))
    for table in (docs, docs.limit(0), docs.drop("n_chars")):
        seen = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, seen, path)
            assert out.dtypes == table.dtypes
            out.write.mode("overwrite").parquet(f"{path}/seen-{out.columns == docs.columns}-{len(out.columns)}-{stage.__name__}")
            seen = spark.read.parquet(f"{path}/seen-{out.columns == docs.columns}-{len(out.columns)}-{stage.__name__}")
        kept = seen.collect()
        if table is docs:
            ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept)
            assert ids == sorted([*[(False, i) for i in range(30)], (False, 7), (True, 0), (True, 0), (False, 60)])
            assert all([r[t] for t in taken] == taken for r in kept)
        else:
            assert len(kept) == (34 if "n_chars" not in table.columns else 0)
        assert corpus_pipeline.STAGES[-1][1](spark, seen, path).count() == len(kept)



def test_pipeline(spark, tmp_path, monkeypatch):
    """Each stage takes out what it should and nothing else."""
    pick = random.Random(8)
    words = {"en": "the of and to in is that for it with was".split(), "de": "der die und das nicht ist ein zu von mit sich".split()}

    def text(lang, n):
        return " ".join(pick.choice(words[lang]) + (pick.choice("abcdefgh") * pick.randint(1, 4) if pick.random() < 0.5 else "") for _ in range(n))

    rows = [(i, text("en" if i % 2 else "de", 80), "en" if i % 2 else "de") for i in range(80)]
    shared, passage = text("en", 60), text("de", 20)
    rows += [(100, None, None), (101, "123 456", "en"), (102, rows[0][1], "de"), (103, rows[1][1] + " more", "en")]
    rows += [(104, text("en", 60) + " " + shared, "en"), (105, shared + " " + text("en", 60), "en"), (106, text("de", 40) + " " + passage + " " + text("de", 40), "de")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    path = table_dir(tmp_path, spark, documents=docs, benchmark=spark.createDataFrame([(1, passage)], "item_id long, text string"))
    seen, left = docs, []
    for _, stage in corpus_pipeline.STAGES:
        seen = stage(spark, seen, path)
        seen.write.parquet(f"{path}/stage{len(left)}")
        seen = spark.read.parquet(f"{path}/stage{len(left)}")
        left.append({r.doc_id for r in seen.select("doc_id").collect()})
        if len(left) < len(corpus_pipeline.STAGES):
            assert seen.columns == docs.columns
    every = {r[0] for r in rows}
    assert left[0] == every - {100, 101}
    assert left[1] == left[0] - {102, 103}
    assert left[2] == left[1] and left[3] == left[2] - {106} and left[4] == left[3]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/stage2").collect()}
    assert shared not in texts[104] and texts[104] and shared not in texts[105] and texts[105]
    assert all(texts[i] == t for i, t, _ in rows if i < 80)
    monkeypatch.setattr(written, "shared_dir", lambda _: f"{path}/shared")
    final = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    # What the stages wrote for themselves is gone.
    assert [p.name[:10] for p in (tmp_path / "shared" / "covey").iterdir()] == ["pipeline-4"]
    assert set(final) == left[4]
    assert bpe.coder(queries.BYTE_BPE, queries.public_tokenizers.PATTERN).decode(np.array(final[3].ids)) == texts[3].encode()
