"""The counts that the toxicity models gather."""

import random
from collections import Counter

import numpy as np

from millrace.llm import toxicity
from millrace.llm.tables import Scratch


def words_of(text):
    return toxicity.Words(np.frombuffer(text.encode(), dtype=np.uint8))


def test_shared_counts_are_of_all_words_of_all_documents(spark):
    rng = random.Random(3)
    vocabulary = [f"{a}{b}{c}word{d}" for a in "abc" for b in "de" for c in "fg" for d in "hijk"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(30))) for _ in range(200)] + [None, "", "alone", "Alone, alone"]
    before = {}
    for t in texts:
        w = (t or "").lower().replace(",", "").split()
        for left, right in zip(["", *w], w, strict=False):
            before.setdefault(right, set()).add(left)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    corpus = toxicity.corpus_counts(df, Scratch(spark, "toxicity"))
    got = {(r.word, r.n) for r in corpus.collect()}
    hashes = {w: int(words_of(w).levels[0].view(np.int64)[0]) for w in before}
    assert got == {(hashes[w], len(lefts)) for w, lefts in before.items()}
    some = words_of(" ".join(vocabulary[:5]))
    tables = [np.unique(x) for x in some.levels]
    counts = toxicity.known_counts(corpus, tables)
    for level, length in enumerate((99, 6, 4)):
        for v, key in zip(vocabulary[:5], some.levels[level], strict=True):
            n = sum(len(lefts) for w, lefts in before.items() if w[:length] == v[:length])
            assert counts[level][1 + np.searchsorted(tables[level], key)] == n
    assert counts[3][0] == sum(map(len, before.values()))


def test_a_sampled_document_of_its_own_words_counts_and_unseen_words_fall_out(spark):
    texts = [f"plain text number {'one two three four'.split()[i % 4]} of them" for i in range(40)]
    rows = [(i, f"{t} vile{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{i}" if i % 2 else t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, "toxic", toxicity.F.lit(True))
    held = [words_of(t) for i, t in rows if i % 2 and model.ids(words_of(t))[0].all()]
    assert len(held) > 8  # each has a word that no other document has
    unseen = words_of("plain zzzz text vilified qqqq")
    old = model.ratios(unseen)
    for level, c in enumerate(model.chance):
        c[0] *= 1e-3 ** (3 - level)
    assert np.allclose(model.ratios(unseen), old)


def test_lower_counts_are_of_different_words_before_and_rare_words_keep_mass():
    toxic = [words_of(t) for t in ("san francisco", "san francisco", "san francisco here", "bad dog", "my dog", "a dog here")]
    ordinary = [words_of(t) for t in ("my house", "a house", "the house here")]
    tables = [np.unique(np.concatenate([w.levels[i] for w in toxic + ordinary])) for i in range(3)]
    model = toxicity.Model(tables, [*(np.ones(len(t) + 1) for t in tables), np.array([50.0])])
    model.fit(toxic, ordinary)
    own = lambda word: model.lower[0][0][model.ids(words_of(word))[0][0]]
    assert own("dog") > own("francisco") > 0 and own("bad") > 0
    off = toxicity.discount(np.array([1, 1, 1, 2, 5]))
    assert off == 3 / 5
    assert model.ratios(words_of("bad dog")).min() > 0


def brute_probability(model, of, docs, word, left, chance):
    """Interpolated Kneser-Ney by its definition, over a whole vocabulary of strings."""
    pairs = Counter((a, b) for d in docs for a, b in zip(d, d[1:], strict=False))
    before = {(a, b) for d in docs for a, b in zip(["", *d], d, strict=False)}
    types = Counter(b for _, b in before)
    p = chance[word[:4]]
    for size in (4, 6, 99):
        k = Counter()
        for w, n in types.items():
            k[w[:size]] += n
        counts = np.array([*k.values()])
        off, total = toxicity.discount(counts), sum(k.values())
        if size < 99:
            share = 1.0 if size == 4 else chance[word[:6]] / chance[word[:4]]
        else:
            share = chance[word] / chance[word[:6]]
        spare = max(np.minimum(counts, off).sum() / total, 1e-3)
        p = max(k[word[:size]] - off, 0) / total + spare * share * p
    seen = {b: n for (a, b), n in pairs.items() if a == left}
    if not seen:
        return p
    off, total = toxicity.discount(np.array([*pairs.values()])), sum(seen.values())
    return max(seen.get(word, 0) - off, 0) / total + min(max(sum(min(n, off) for n in seen.values()) / total, 1e-3), 1.0) * p


def test_probabilities_equal_a_brute_force_model_and_sum_to_one():
    rng = random.Random(6)
    vocabulary = [f"{a}{b}ñ{c}word{d}" for a in "abc" for b in "de" for c in "fg" for d in "hijk"]
    docs = [[rng.choices(vocabulary, k=rng.randrange(1, 12)) for _ in range(30)] for _ in range(2)]
    every = words_of(" ".join(vocabulary))
    tables = [np.unique(x) for x in every.levels]
    n = [rng.randrange(1, 9) for _ in vocabulary]
    counts, chance = [np.ones(len(t) + 1) for t in tables], {}
    for level, size in enumerate((99, 6, 4)):
        for i, w in enumerate(vocabulary):
            same = sum(k for v, k in zip(vocabulary, n, strict=True) if v[:size] == w[:size])
            chance[w[:size]] = same / sum(n)
            counts[level][1 + np.searchsorted(tables[level], every.levels[level][i])] = same
    model = toxicity.Model(tables, [*counts, np.array([float(sum(n))])])
    model.fit(*([words_of(" ".join(d)) for d in of] for of in docs))
    for left in vocabulary[:5]:
        for of in (0, 1):
            got = [model.probabilities(words_of(f"{left} {w}"))[of][0][1] for w in vocabulary]
            assert abs(sum(got) - 1) < 1e-9
            assert np.allclose(got, [brute_probability(model, of, docs[of], w, left, chance) for w in vocabulary])


def test_texts_together_score_as_alone_and_odd_rows_are_kept(spark):
    texts = ["plain words here", "vile scum and vile scum", None, "", "vile", "Wörter " * 3000, "plain " * 50_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "vile scum"), (1, texts[1])]
    rows += [(100 + i, f"some kind folk {i} went home") for i in range(40)] + [(200 + i, f"some vile scum {i} went home") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as Score")
    labels = spark.createDataFrame([(100 + i, 0) for i in range(40)] + [(200 + i, 1) for i in range(40)] + [(200, 0)], "doc_id long, toxic int")
    out = toxicity.scored(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.predicted for r in out}
    assert by[1] and by[4] and not by[0] and not by[5] and not by[6]
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == ["doc_id", "text", "Score"] and {r.Score for r in kept.collect()} == {"x"}
    model = toxicity.learn(docs, labels, "toxic", toxicity.F.lit(True))
    raw = [np.frombuffer((t or "").encode(), dtype=np.uint8) for t in texts]
    assert np.allclose(model.score(toxicity.Words(*raw)), [model.score(toxicity.Words(b))[0] for b in raw])
    assert toxicity.scored(docs.limit(0), labels).count() == 0


def test_hot_words_are_counted_alike(spark):
    rng = random.Random(9)
    texts = [" ".join(x for _ in range(rng.randrange(40)) for x in ("hot", "".join(rng.choices("abc", k=3)))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    count = lambda hot: {tuple(r) for r in toxicity.corpus_counts(docs, Scratch(spark, "toxicity"), hot).collect()}
    assert count(words_of("hot").levels[0]) == count(None)
