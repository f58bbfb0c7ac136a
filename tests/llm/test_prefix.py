"""Large buckets of near-dedup: members posted by their rarest shingles."""

import random

import numpy as np
import pytest

from cartero.llm import common, minhash


def test_similar_sets_share_a_posted_shingle():
    rng = np.random.default_rng(8)
    counts = rng.integers(0, 5, 1 << minhash.SLOTS).astype(np.uint32)  # many ties
    met = 0
    for _ in range(4000):
        n = int(rng.integers(1, 60))
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        y = np.concatenate([rng.permutation(x)[:int(rng.integers(n // 2, n + 1))], rng.integers(0, 1 << 63, int(rng.integers(0, 12)), dtype=np.uint64)])
        x, y = np.unique(x), np.unique(y)
        if minhash.linked(x, y):
            met += 1
            assert np.intersect1d(minhash.prefix(x, counts), minhash.prefix(y, counts)).size
    assert met > 500


def headed(n):
    """Texts of which 60 per cent is one header; every tenth has a near copy further on."""
    rng = random.Random(n)
    header = [f"h{i}" for i in range(150)]
    own = [[f"t{i}_{j}" for j in range(100)] for i in range(n)]
    out = [" ".join(header + o) for o in own]
    out += [" ".join(header[:140] + own[i] + [f"e{rng.randrange(99)}"]) for i in range(0, n, 10)]
    return out


@pytest.mark.parametrize("n", [300, 600])
def test_a_header_does_not_make_texts_meet(spark, monkeypatch, n):
    monkeypatch.setattr(minhash, "BLOCK", 32)
    common.ship(spark)
    dealt, deal = [], minhash._dealt

    def counted(rest, rows):
        out = deal(rest, rows)
        dealt.append(out.count())
        return out

    monkeypatch.setattr(minhash, "_dealt", counted)
    frame = spark.createDataFrame(list(enumerate(headed(n))), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame).collect()}
    assert got == {**{i: i for i in range(n)}, **{n + k: 10 * k for k in range(n // 10)}}
    assert sum(dealt) < 6 * n  # by buckets every text comes once for each 32 others, in several bands
