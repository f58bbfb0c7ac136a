"""Ranked search against scoring of every document."""

import collections
import math
import random
import re

import numpy as np
import pytest

from cartero.llm import blockmax, common

RNG = random.Random(11)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k):
    terms = [(i, collections.Counter(WORD.findall((t or "").translate(LOWER)))) for i, t in docs]
    full = [(i, c, sum(c.values())) for i, c in terms if c]
    n_docs, n_terms = len(full), sum(n for _, _, n in full)
    df = collections.Counter(t for _, c, _ in full for t in c)
    out = []
    for item, text in items:
        asked = set(WORD.findall((text or "").translate(LOWER)))
        rows = []
        for ident, c, n in full:
            m = 50 + 50 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if s > 0:
                rows.append((-s, ident is None, ident, ident))
        out += [(item, rank, r[3], -r[0]) for rank, r in enumerate(sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def some(n, words):
    return " ".join(RNG.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rare = [f"w{i}" for i in range(400)]
    common_ = ["the", "of", "The", "straße", "日本", "a1"]
    docs = [(i, some(RNG.choice([1, 5, 30, 200]), RNG.choice([common_, rare, common_ + rare, common_ * 20 + rare]))) for i in range(900)]
    docs += [(900 + i, "the of w1 w1 w2") for i in range(60)]  # equal scores
    docs += [(None, "the of w1 w1 w2"), (990, None), (991, ""), (992, " ., "), (5, "w1"), (993, "w3 " * 300_000)]
    items = [(f"q{i}", some(RNG.choice([1, 3, 12, 40]), common_ + rare)) for i in range(30)]
    items += [("the", "the"), ("tie", "w1 w2!"), ("none", "unseen"), ("null", None), ("empty", ""), ("none2", "...")]
    return docs, items


@pytest.mark.parametrize("shard_bytes, window", [(1 << 24, 1024), (3000, 1024), (20_000, 64)])
def test_against_scores_of_all(spark, corpus, shard_bytes, window, monkeypatch):
    common.ship(spark)
    monkeypatch.setattr(blockmax, "GROUP_ITEMS", 7)
    docs, items = corpus
    frame = spark.createDataFrame([(*d, "clash", 3) for d in docs], "doc_id long, text string, term string, rank int").repartition(3)
    asked = spark.createDataFrame([*items, items[0]], "item_id string, text string")
    got = blockmax.search(blockmax.build(frame, shard_bytes), asked, 20)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, 20)


def shard_of(docs):
    lists = collections.defaultdict(list)
    lengths = np.array([sum(c.values()) for c in docs])
    words = np.concatenate([np.repeat(np.array(sorted(c), np.uint64), [c[t] for t in sorted(c)]) for c in docs])
    ids = np.repeat(np.arange(len(docs)), lengths)
    term, df, blocks, points, sizes, head, best, payload = blockmax.build_postings(words, ids, lengths)
    at = [np.concatenate([[0], np.cumsum(x)]) for x in (blocks, points, sizes)]
    rows = [(1 + int(t) % 50, head[at[0][i]:at[0][i + 1]].tobytes(), best[at[1][i]:at[1][i + 1]].tobytes(),
             payload[at[2][i]:at[2][i + 1]].tobytes()) for i, t in enumerate(term)]
    for i, c in enumerate(docs):
        for t, n in c.items():
            lists[t].append((i, n))
    return term, df, rows, lists, lengths


def test_blocks_hold_every_posting_and_save_unpacking():
    docs = [collections.Counter({t: RNG.choice([1, 1, 2, 300, 70_000]) if t < 3 else 1 for t in range(1, 41) if RNG.random() < (0.9 if t < 30 else 0.01)})
            or collections.Counter({1: 1}) for _ in range(4000)]
    term, df, rows, lists, lengths = shard_of(docs)
    shard = blockmax.Shard(lengths, len(docs), int(lengths.sum()), rows)
    for i, t in enumerate(term.tolist()):
        got = [shard.block(i, b) for b in range(len(shard.lists[i][1]))]
        assert np.concatenate([d for d, _ in got]).tolist() == [d for d, _ in lists[t]] and df[i] == len(lists[t])
        part = [1_000_000_000 * n // (1000 * n + 20 * int(shard.m[d])) * rows[i][0] for d, n in lists[t]]
        assert np.concatenate([s for _, s in got]).tolist() == part
        assert [int(s.max()) for _, s in got] == shard.lists[i][4].tolist()  # block maxima are exact
    fresh = blockmax.Shard(lengths, len(docs), int(lengths.sum()), [(w * (1 if t < 30 else 100), *r) for t, (w, *r) in zip(term.tolist(), rows)])
    own = list(range(len(rows)))
    found, scores = fresh.search(own, 10, np.arange(len(docs)), 256)
    full = np.zeros(len(docs), np.int64)
    for i in own:
        for b in range(len(fresh.lists[i][1])):
            d, s = fresh.block(i, b) if b in fresh.lists[i][7] else blockmax.Shard.block(fresh, i, b)
            full[d] += s
    best = np.lexsort((np.arange(len(docs)), -full))[:10]
    assert sorted(found.tolist()) == sorted(best.tolist()) and sorted(scores.tolist()) == sorted(full[best].tolist())
    again = blockmax.Shard(lengths, len(docs), int(lengths.sum()), [(w * (1 if t < 30 else 100), *r) for t, (w, *r) in zip(term.tolist(), rows)])
    again.search(own, 10, np.arange(len(docs)), 256)
    assert again.unpacked < sum(len(x[1]) for x in again.lists)  # block maxima rejected some


def test_empty_tables(spark):
    common.ship(spark)
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert blockmax.search(blockmax.build(docs.limit(0)), items).collect() == []
    assert blockmax.search(blockmax.build(docs), items.limit(0)).collect() == []
    assert [tuple(r) for r in blockmax.search(blockmax.build(docs), items).collect()][0][:3] == (1, 1, 1)
