"""The Jaccard join's exact filters, and what it fetches and sends."""

import collections
import random

import numpy as np
import pytest
from test_text_operators import brute_components

from millrace.llm import jaccard_join
from millrace.llm.tables import Scratch


@pytest.mark.parametrize("percent", [50, 80, 85])
def test_parity_bits_rule_out_no_link(percent):
    rng = np.random.default_rng(percent)
    ruled_out = linked = 0
    for _ in range(3000):
        n = int(rng.integers(1, 300))
        common = rng.integers(0, 2**64, n, dtype=np.uint64)
        a, b = (np.unique(np.concatenate((common, rng.integers(0, 2**64, int(rng.integers(0, n // 2 + 2)), dtype=np.uint64)))) for _ in range(2))
        least = jaccard_join.least_difference(jaccard_join.parity_bits(a), jaccard_join.parity_bits(b))
        assert least <= len(np.setxor1d(a, b, assume_unique=True))
        likely = least <= len(a) + len(b) - 2 * jaccard_join.needed(len(a), len(b), percent)
        assert likely or not jaccard_join.links(a, b, percent)
        ruled_out, linked = ruled_out + (not likely), linked + jaccard_join.links(a, b, percent)
    assert linked > 100 and (ruled_out > 100 or percent == 50)


@pytest.fixture
def written(monkeypatch):
    """How many rows each kept table has."""
    rows, keep = {}, Scratch.keep

    def kept(self, df, name):
        out = keep(self, df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "keep", kept)
    return rows


def test_sets_are_fetched_for_likely_pairs_alone(spark, written):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices("abcdef", k=60))) for i in range(80)]  # they share n-grams, and no more than chance has it
    rows += [(80 + i, rows[i][1] + " z") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collections.Counter(map(tuple, jaccard_join.join(df).collect())) == brute_components(rows, 4, 85)
    assert written["pairs"] > 50 and written["found-sets"] == 6


def test_large_blocks_leave_out_what_pairs_with_nothing(spark, written, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    tail = " ".join(f"b{i}" for i in range(93))
    rows = [(i, "s0 s1 s2 s3 " + " ".join(f"u{i}x{j}" for j in range(7)) + " " + tail) for i in range(6)]  # 91 of 101 n-grams are shared, and 93 would link
    rows += [(None, tail)] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collections.Counter(map(tuple, jaccard_join.join(df).collect())) == brute_components(rows, 4, 85)
    assert written["shared"] > 0 and written["pairs"] == 0 and written["found-sets"] == 0
