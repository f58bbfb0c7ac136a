"""Runs of words against a comparison of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartero.llm import common, queries, squares

RNG = random.Random(7)
HASH = np.random.default_rng(1).integers(1, 1 << 63, 1000, dtype=np.uint64)


def brute(w, least=12):
    out = {}
    for p in range(1, len(w) // 2 + 1):
        i = p
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - p]:
                j += 1
            if j > i and j - i + p >= max(least, 2 * p):
                out.setdefault((i - p, j), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def sequences():
    yield from ([], [1], [0] * 11, [0] * 12, [0] * 300, list(range(50)) * 4, fibonacci(600), [bin(i).count("1") % 2 for i in range(700)])
    for _ in range(150):
        w = [RNG.randrange(RNG.choice([1, 2, 2, 3, 4, 10])) for _ in range(RNG.randrange(160))]
        if len(w) > 5 and RNG.random() < 0.7:
            a = RNG.randrange(len(w))
            p = 1 + (len(w) - a) // RNG.randrange(2, 9)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        yield w


@pytest.mark.parametrize("least", [12, 2])
def test_runs_at_once_word_by_word_and_in_batches(least):
    words, bounds, want = [], [0], []
    for w in sequences():
        h = HASH[np.array(w, int)]
        want.append(brute(w, least))
        whole = squares.Catchers(least)
        whole.append(h)
        online, i = squares.Catchers(least), 0
        while i < len(h):
            step = RNG.choice([1, 1, 2, 7, 30])
            online.append(h[i:i + step])
            i += step
        assert [tuple(r) for r in whole.runs().tolist()] == want[-1]
        assert [tuple(r) for r in online.runs().tolist()] == want[-1]
        words.append(h)
        bounds.append(bounds[-1] + len(h))
    got = squares.batch_runs(np.concatenate(words), np.array(bounds), least)
    assert [[tuple(r) for r in g.tolist()] for g in got] == want


def by_contract(ident, text):
    w = [x for x in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if x]
    h, n = zlib.crc32(str(ident).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(found), *top, top[0] is not None and 1000 * top[1] // top[2] or None,
            sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_on_texts_of_all_kinds(spark, tmp_path):
    common.ship(spark)
    line = "the quick brown fox jumps over it\n"
    texts = [None, "", " \n\t", "a", "a " * 40, line * 3, "x " + line * 5 + " y", "ab c " * 20, "é\x0bé " * 9, "one two three " * 200,
             " ".join(RNG.choice("ab") for _ in range(500)), " ".join(str(i) for i in range(300)), "word " * 250_000]  # over 1 MB
    rows = [(i, texts[i % len(texts)], "clash", 1) for i in range(12 * len(texts)) if len(texts[i % len(texts)] or "") < 10_000 or i < 26]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, period long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)
    for r in got:
        text = dict((a, b) for a, b, _, _ in rows)[r["doc_id"]]
        if len(text or "") < 10_000:
            assert tuple(r)[1:] == by_contract(r["doc_id"], text), r["doc_id"]
        else:
            assert (r["n_runs"], r["start"], r["length"], r["period"]) == (1, 0, 250_000, 1)


def test_null_ids_repeats_and_empty_tables(spark):
    common.ship(spark)
    docs = spark.createDataFrame([(None, "a " * 20), (1, "a " * 20), (1, "a " * 20), (1, None)], "doc_id long, text string")
    got = squares.find_runs(docs).select("doc_id", F.size("runs").alias("n"), "collapsed").collect()
    assert sorted((str(a), b, c) for a, b, c in got) == [("1", 0, ""), ("1", 1, "a"), ("1", 1, "a"), ("None", 1, "a")]
    assert squares.find_runs(docs.limit(0)).collect() == []
