"""Text operators against brute force, the library or an exact round trip, on small tables."""

import collections
import random
import zlib

import numpy as np
import pytest
from conftest import same_rows

from millrace.llm import bpe, html_text, jaccard_join, mixing, quality, queries, suffix_dedup, token_files, toxicity, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
NASTY = ["", " ", "a", "a  b\n\nc\t d", "é 　x", "<|endoftext|> x<|endoftext|>", "'s 'RE I'm 12²3", "漢字 🙂 é", "\x1c\x85", "x" * 3000, "word " * 3000, "=\n=a = b"]


def docs(spark, texts, sources=None):
    rows = [(i, t, None, (sources or [None])[i % len(sources or [None])], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


def test_bpe_equals_the_library(library):
    own, other = bpe.Bpe(queries.vocabulary()), token_files.LibraryEncoder(queries.vocabulary())
    rng = random.Random(5)
    parts = ["a", "Bc", " ", "  ", "\n", "\t", "　", "é", "<|endoftext|>", "'s", "12", "²", "!", "漢", "\x1c", "\x85", "🙂", "=", "<|end"]
    texts = NASTY + ["".join(rng.choices(parts, k=rng.randrange(15))) for _ in range(3000)]
    for t, coded in zip(texts, other.encode(texts), strict=True):
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and np.frombuffer(coded, "<u4").tolist() == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_cuts_long_texts_alike(library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 50)
    text = "some words, and\nlines  with   gaps " * 40
    assert bpe.Bpe(queries.vocabulary()).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_encoded_documents_keep_their_columns(spark, library):
    df = docs(spark, [*NASTY, None, "dup", "dup"])
    rows = bpe.encode_documents(df, queries.vocabulary()).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate([*NASTY, None, "dup", "dup"])}
    assert bpe.encode_documents(df.limit(0), queries.vocabulary()).columns == [*df.columns, "ids"]


def test_token_files_round_trip(spark, library, tmp_path):
    texts = [*NASTY, None, "dup", "dup"]
    df = docs(spark, texts).repartition(3)
    manifest = token_files.write(df, queries.vocabulary(), str(tmp_path / "f")).persist()
    got = {r.doc_id: r for r in token_files.read_back(manifest).collect()}
    at = 0
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    for r in manifest.collect():
        fs, path = token_files.file_system(r.path)
        reader = token_files.Reader(fs.open_input_file(path))
        one = reader.index["doc_id"][-1]
        assert [d for d, _ in reader.get([one])] == [one]
    assert token_files.read_back(token_files.write(df.limit(0), queries.vocabulary(), str(tmp_path / "g"))).count() == 0


def test_word_hashes_depend_on_the_word_alone(monkeypatch):
    monkeypatch.setattr(words, "BLOCK", 64)
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcÉ", k=rng.choice([1, 5, 90]))) + rng.choice(["", " ", "\n\t"]) for _ in range(300))
    b = text.encode()
    starts, ends, h = words.words(np.frombuffer(b, dtype=np.uint8))
    found = [b[s:e].lower() for s, e in zip(starts, ends, strict=True)]
    assert found == b.lower().split()
    assert len(set(h.tolist())) == len(set(found)) and len({*zip(found, h.tolist(), strict=True)}) == len(set(found))


def brute_components(rows, n, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(zip(*[w[j:] for j in range(n)], strict=False)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))
    find = lambda x: x if root[x] == x else find(root[x])
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and None not in (rows[i][0], rows[j][0]) and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return collections.Counter((d, len(sets[i]), least[find(i)] if d is not None else None) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("small", [64, 2])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "BLOCK_GRAMS", 2000)
    rng = random.Random(small)
    base = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60)) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, "one two"), (3, "ONE\ttwo"), (None, base[0]), (5, base[0]), (5, base[0]), (6, base[0].upper())]
    for i in range(90):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = rng.choice("xyz")
        rows.append((10 + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(map(tuple, jaccard_join.join(df).collect()))
    assert got == brute_components(rows, 4, 85)
    kept = {r.doc_id for r in jaccard_join.keep_one(df, 4, 85).collect()}
    assert kept == {d for d, _, c in got if d == c or d is None}
    assert jaccard_join.join(df.limit(0)).count() == 0


def test_suffix_dedup_finds_repeats_and_spares_the_rest(spark):
    rng = random.Random(4)
    word = lambda k: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(k))
    passage, short = word(70), word(45)
    texts = [f"{word(30)} {passage} {word(20)}", f"{word(80)} {passage.upper()}", f"{passage} {word(5)}", f"{short} {word(40)}", f"{word(40)} {short}", word(90), None, "", "tiny", "the " * 200]
    texts += [texts[5]]
    df = docs(spark, texts)
    got = {(r.doc_id, r.first_word, r.n_words, r.n_later) for r in suffix_dedup.repeats(df).collect()}
    assert got == {(0, 30, 70, 0), (1, 80, 70, 70), (2, 0, 70, 70), (5, 0, 90, 0), (10, 0, 90, 90)}
    cut = {r.doc_id: r for r in suffix_dedup.cut_repeats(df).collect()}
    assert set(cut) == set(range(10)) and len(cut[1].text.split()) == 80 and len(cut[2].text.split()) == 5 and cut[1].n_chars == len(cut[1].text)
    assert all(cut[i].text == texts[i] for i in (0, 3, 4, 5, 6, 7, 8, 9))
    assert suffix_dedup.repeats(df.limit(0)).count() == 0


def test_mixing_targets_and_samples(spark):
    rng = random.Random(6)
    sources = ["b", "a", None, "é", "a"]
    rows = [(i, "w " * rng.randrange(40), sources[i % 5], None) for i in range(500)] + [(None, "x y", "a", None), (7, "x", "a", None), (900, None, "zero", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, key string")
    out = mixing.decisions(df).collect()
    total, seen = sum(r.size for r in out), {}
    for r in out:
        seen.setdefault(r.source, [0, r.source_size, r.target])[0] += r.taken
        assert r.taken <= 3 * r.size
    order = [s for s in sorted((s for s in seen if s), key=lambda s: s.encode())] + [None]
    left, weights, want = total, {s: i % 3 + 1 for i, s in enumerate(order)}, {}
    while left is not None:
        open_ = [s for s in order if s not in want]
        share = left / max(sum(weights[s] for s in open_), 1)
        full = [s for s in open_ if weights[s] * share >= 3 * seen[s][1]]
        want |= {s: 3 * seen[s][1] for s in full} if full else {s: weights[s] * share for s in open_}
        left = total - sum(want.values()) if full else None
    for s, (taken, _, target) in seen.items():
        assert target == pytest.approx(want[s]) and abs(taken - target) <= 80
    assert sorted(map(str, out)) == sorted(map(str, mixing.decisions(df.repartition(7)).collect()))
    copies = collections.Counter(r.doc_id for r in mixing.mix(df).collect())
    expected = collections.Counter()
    for r in out:
        expected[r.doc_id] += r.copies
    assert copies == +expected and mixing.mix(df).columns == df.columns
    assert mixing.decisions(df.limit(0)).count() == 0


def test_mixing_query_equals_its_sql(spark, duck, sf):
    same_rows(queries.op4_mixing(spark, sf), duck, queries.OP4_SQL)


PAGE = """<html><head><title>t</title><style>x{}</style></head><body><nav><a>Home</a></nav><header>Site</header><article><h1>T &amp; U</h1>
<p>One <a href=x>two</a>\n three &eacute;<script>var x='</p>'</script></p><div class="ad">buy now</div><ul><li>a b</li></ul><p>end<br>of it</article>
<div class=comments><p>A reader says a good many things here</p></div><form>name</form><footer>foot</footer></body></html>"""


def test_html_main_text(spark):
    assert html_text.extract(PAGE) == "T & U\nOne two three é\na b\nend of it"
    assert [html_text.extract(x) for x in (None, "", "<div>", "just &lt;text", "<p>x<p>y z<a hre", "<!-- a")] == ["", "", "", "just <text", "x\ny z", ""]
    rows = html_text.main_text(spark.createDataFrame([(1, "u", PAGE, 5), (2, None, None, 6)], "page_id long, url string, html string, text int")).collect()
    assert [(r.page_id, r.n_chars, len(r.text)) for r in rows] == [(1, 43, 43), (2, 0, 0)] or rows[0].n_chars == len(rows[0].text)


@pytest.mark.parametrize(("run", "label", "rest"), [(quality.scored, "quality", (5, 0)), (toxicity.scored, "toxic", (4, 2))])
def test_classifiers_on_held_out_rows(spark, run, label, rest):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    extra = spark.createDataFrame([(10**9, None), (10**9 + 1, ""), (None, "text")], "doc_id long, text string")
    rows = run(d.select("doc_id", "text").unionByName(extra), labels).collect()
    assert len(rows) == d.count() + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % rest[0] == rest[1]) for r in rows)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    tested = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in tested) / len(tested) > 0.88
    none = run(extra, labels.limit(0)).collect()
    assert len(none) == 3


def test_jaccard_query_equals_its_sql(spark, duck, sf):
    same_rows(queries.op8_jaccard_join(spark, sf), duck, queries.OP8_SQL)
