"""The window set of benchmark decontamination."""

import pickle
import random

import numpy as np
import pyarrow as pa

from cartero.llm import decontaminate


def found(windows, text):
    buf, _, s, e, bounds = decontaminate.words_of(pa.array([text], pa.string()))
    return {(i, k, x) for i, k, ids in windows.find(windows.filters(), buf, s, e, bounds[1:]) for x in ids}


def test_windows_of_items_of_all_lengths():
    rng = random.Random(4)
    lexicon = ["One", "two", "é日", "x1", "FOUR"]
    items = [(str(i), rng.choice(["", " ", "(("]) + ", ".join(rng.choices(lexicon, k=rng.choice([0, 1, 2, 3, 5, 9])))) for i in range(60)]
    items += [("end", "two"), ("end", "two"), ("null-like", "!!")]
    windows = pickle.loads(pickle.dumps(decontaminate.WindowSet(items, 4)))
    for _ in range(50):
        words = [w.lower() for w in rng.choices(lexicon, k=12)]
        want = set()
        for ident, item in items:
            own = [w.lower() for w in item.replace("(", " ").replace("!", " ").replace(",", " ").split()]
            k = min(4, len(own))
            for a in range(len(own) - k + 1 if k else 0):
                want |= {(i, k, ident) for i in range(len(words) - k + 1) if words[i:i + k] == own[a:a + k]}
        assert found(windows, " ; ".join(words)) == want


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(decontaminate, "window_hashes", lambda words, k: np.zeros(max(0, len(words) - k + 1), np.uint64))
    windows = decontaminate.WindowSet([("a", "red blue"), ("b", "blue red")], 2)
    assert found(windows, "red blue red") == {(0, 2, "a"), (1, 2, "b")}


def test_no_items_and_bytes_a_word():
    assert found(decontaminate.WindowSet([], 13), "a b") == set()
    assert found(decontaminate.WindowSet([("a", "")], 13), "") == set()
    text = " ".join(f"word{i}" for i in range(100_000))
    assert len(pickle.dumps(decontaminate.WindowSet([("a", text)], 13))) < 45 * 100_000
