"""Pseudo-likelihood of whole texts by plain loops, with counts held in tasks and joined."""

import collections
import math
import random

import numpy as np
import pytest

from cartero.llm import common, pseudo


def words_of(text):
    out, word = [], ""
    for ch in (text or "") + " ":
        ch = chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
        if ch.isascii() and not ch.isalnum():
            out, word = out + [word] * bool(word), ""
        else:
            word += ch
    return out


def plain_scores(texts, vocabulary, flat):
    """{id: (words, sum of log probabilities)} by explicit softmax over all words."""
    net = {k: v.astype(float) for k, v in pseudo.unpack(flat).items()}
    split = {i: words_of(t) for i, t in texts}
    counts = collections.Counter(w for ws in split.values() for w in ws)
    raw = {w: np.frombuffer(w.encode(), np.uint8) for w in counts}
    number = {w: int(vocabulary.of(pseudo.span_hashes(b, np.array([0]), np.array([len(b)])).view(np.int64))[0]) for w, b in raw.items()}
    outside = {w: n for w, n in counts.items() if number[w] == 0}
    rarer = max(1, sum(n for n in outside.values() if n < pseudo.LEAST))
    total = rarer + sum(n for n in outside.values() if n >= pseudo.LEAST)
    three, two, one = collections.Counter(), collections.Counter(), collections.Counter()
    for w, n in outside.items():
        letters = [0, 0, *pseudo._LETTER[raw[w]].tolist(), 0]
        for a, b, c in zip(letters, letters[1:], letters[2:]):
            three[a, b, c] += n
            two[b, c] += n
            one[c] += n
    heads3, heads2 = collections.Counter(), collections.Counter()
    for (a, b, _), n in three.items():
        heads3[a, b] += n
    for (b, _), n in two.items():
        heads2[b] += n
    every = sum(one.values())

    def letter(a, b, c):
        p = (one[c] + 1) / (every + pseudo.LETTERS)
        p = (two[b, c] + pseudo.SMOOTH * p) / (heads2[b] + pseudo.SMOOTH)
        return (three[a, b, c] + pseudo.SMOOTH * p) / (heads3[a, b] + pseudo.SMOOTH)

    def soft(x):
        return np.exp(x - x.max()) / np.exp(x - x.max()).sum()

    out = {}
    for i, ws in split.items():
        ids, score = [number[w] for w in ws], 0.0
        for at, w in enumerate(ws):
            around = [ids[j] if 0 <= j < len(ids) else pseudo.VOCAB for j in (at - 2, at - 1, at + 1, at + 2)]
            h = np.tanh(np.concatenate([net["embed"][k] for k in around]) @ net["w1"] + net["b1"])
            c, m = divmod(ids[at], pseudo.CLASSES)
            score += math.log(soft(h @ net["wc"] + net["bc"])[c] * soft(h @ net["ww"][c] + net["bw"][c])[m])
            if ids[at] == 0:
                letters = [0, 0, *pseudo._LETTER[raw[w]].tolist(), 0]
                p = rarer / total * math.prod(letter(*x) for x in zip(letters, letters[1:], letters[2:]))
                score += math.log(p + (outside[w] / total if outside[w] >= pseudo.LEAST else 0))
        out[i] = (len(ws), score)
    return out


@pytest.mark.parametrize("held", [1 << 17, 40, 0])
def test_pseudo_likelihood_by_loops(spark, monkeypatch, held):
    """The same scores whether the counts of words are in the tasks, in part, or all joined."""
    monkeypatch.setattr(pseudo, "HELD", held)
    common.ship(spark)
    rng = random.Random(21)
    lexicon = [f"{a}{b}{c}" for a in "bdkMn" for b in "aeiöu" for c in ("rs", "t9", "l", "日", "", "xe", "yo", "wa", "pi", "q", "ff", "zz", "om")]
    lexicon = [w + s for w in lexicon for s in ("", "n", "st", "ou")]
    weights = [1 / (i + 3) for i in range(len(lexicon))]
    texts = [(i, " ".join(rng.choices(lexicon, weights, k=rng.randint(1, 400)))) for i in range(60)]
    texts += [(60, None), (61, ""), (62, "..."), (63, "alone"), (64, " ".join(f"rare{i} twice{i}" for i in range(900))),
              (65, " ".join(f"twice{i} " * 5 for i in range(900))), (66, "z" * 5000)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    model = pseudo.fit(frame)
    got = {r.doc_id: (r.n_words, r.log_likelihood) for r in pseudo.score(frame, model).collect()}
    want = plain_scores(texts, *model)
    assert got.keys() == want.keys() and len(model[0].outside.keys) <= held
    assert model[0].outside.rest[1] > pseudo.LEAST or held > 1000
    for i, (n, total) in want.items():
        assert got[i][0] == n and got[i][1] == pytest.approx(total, rel=1e-4, abs=1e-6)
