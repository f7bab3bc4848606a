"""Repeated passages against brute force over all stretches of 50 words."""

import collections
import random

import pytest

from millrace.llm import suffix_dedup


def brute_repeats(texts):
    """The rows of ``repeats`` and, by document, the words that ``cut_repeats`` leaves."""
    split = [t.lower().split() for t in texts]
    held = collections.defaultdict(set)
    for d, w in enumerate(split):
        for i in range(len(w) - 49):
            held[tuple(w[i : i + 50])].add(d)
    rows, left = set(), {}
    for d, w in enumerate(split):
        every, later = [False] * len(w), [False] * len(w)
        spans = []
        for i in range(len(w) - 49):
            of = held[tuple(w[i : i + 50])]
            if len(of) > 1:
                every[i : i + 50] = [True] * 50
                spans = [*spans[:-1], (spans[-1][0], i + 50)] if spans and i <= spans[-1][1] else [*spans, (i, i + 50)]
            if min(of) < d:
                later[i : i + 50] = [True] * 50
        rows |= {(d, s, e - s, sum(later[s:e])) for s, e in spans}
        left[d] = [x for x, gone in zip(w, later, strict=True) if not gone]
    return rows, {d: w for d, w in left.items() if w or not split[d]}


def check(spark, texts, partitions="4"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows, left = brute_repeats(texts)
        assert {tuple(r) for r in suffix_dedup.repeats(df).collect()} == rows
        assert {r.doc_id: r.text.lower().split() for r in suffix_dedup.cut_repeats(df).collect()} == left
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def spread(rng, k):
    return ["".join(rng.choices("abcdefgh", k=6)) for _ in range(k)]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_copies_meet_the_earliest_of_their_own_words(spark, partitions):
    rng = random.Random(11)
    phrase = spread(rng, 14)
    passages = [[*spread(rng, 25), *phrase, *spread(rng, 25)] for _ in range(3)]
    texts = [" ".join([*spread(rng, 60), *phrase, *spread(rng, 60)])]
    for _ in range(60):
        texts.append(" ".join([*spread(rng, rng.randrange(40)), *rng.choice(passages)[rng.randrange(5) :], *spread(rng, rng.randrange(40))]))
    check(spark, texts, partitions)


@pytest.mark.parametrize("period", [1, 5, 8])
def test_runs_of_other_lengths_keep_the_same_positions(spark, period):
    rng = random.Random(period)
    texts = []
    for i in range(12):
        line, tail = spread(rng, period), spread(rng, 10 + i)
        for extra in (0, 7, 45):
            texts.append(" ".join([*spread(rng, 20), *(line * 80)[: 120 + extra][::-1][: 50 + extra][::-1], *tail, *spread(rng, 20)]))
    check(spark, [*texts, "the " * 400, "the " * 70 + "end"])
