"""The pipeline on a small table, its stages held against brute force and the library."""

import collections
import random

import corpus_pipeline
from test_suffix_dedup import brute_repeats
from test_text_operators import brute_components
from tokenizers import Tokenizer

from millrace.llm import mixing, queries, toxicity


def test_pipeline_equals_its_stages_by_brute_force(spark, tmp_path):
    rng = random.Random(8)
    word = lambda k: ["".join(rng.choices("abcdefgh", k=6)) for _ in range(k)]
    phrase, passage = word(14), word(60)
    texts = []
    for i in range(48):
        body = [*word(30), *(passage if i % 4 == 0 else phrase), *word(40 + i)]
        texts.append(" ".join([*body, *(["vile", "scum"] * 4 if i % 3 == 0 else ["kind", "folk"] * 4)]))
    texts += [texts[1], texts[2].upper(), " ".join(["the"] * 300), "", None]
    rows = [(i, t, "en", "ab"[i % 2], len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(48)], "doc_id long, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))

    clean = {r.doc_id for r in toxicity.scored(docs, labels).collect() if not r.predicted}
    assert {r.doc_id for r in toxicity.keep_clean(docs, labels).collect()} == clean and 0 < len(clean) < len(texts)
    kept = sorted(d for d, _, c in brute_components([(i, texts[i]) for i in sorted(clean)], 5, 80) if d == c)
    left = {kept[i]: w for i, w in brute_repeats([texts[i] or "" for i in kept])[1].items()}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(queries.vocabulary())
    for r in out:
        assert (r.text or "").lower().split() == left[r.doc_id]
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
    cut = spark.createDataFrame([(i, " ".join(w), "ab"[i % 2]) for i, w in left.items()], "doc_id long, text string, source string")
    want = {r.doc_id: r.copies for r in mixing.decisions(cut).collect() if r.copies}
    assert collections.Counter(r.doc_id for r in out) == want
