"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are 1- to 3-grams of the characters of a lower-cased text (digits,
punctuation and white space fold to one blank), hashed to 2**BITS columns; document
frequencies come from all documents.  The weights are learnt by follow-the-
regularised-leader with elastic-net penalties on at most ``max_rows`` labelled rows
(the smallest id hashes of every language), and a temperature is fitted on rows kept
back from them.  Scoring covers whole texts.

A null text, or one without a letter, is ``und`` with score 0.  Without any labelled
row every text is ``und``.  Rows with equal ids are scored each by themselves; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartero.llm.common import narrow, slices

BITS = 14
MAX_ROWS = 3000
MAX_LANGUAGES = 200
LETTERS = 0x40000  # no letter is assigned beyond

_KEEP = np.zeros(0x110000, np.int32)
_LETTER = np.zeros(0x110000, bool)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Code point -> folded letter or blank; built once per process."""
    if not _LETTER[97]:
        for cp in range(LETTERS):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                _KEEP[cp], _LETTER[cp] = ord(low[0]), True
            elif unicodedata.category(c)[0] == "M":
                _KEEP[cp] = cp
            else:
                _KEEP[cp] = 32
        _KEEP[LETTERS:] = 32
    return _KEEP, _LETTER


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, count) of hashed n-grams; rows without a letter have none."""
    keep, letter = _tables()
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "replace"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64) + 1
    row = np.repeat(np.arange(len(texts)), lengths)[:len(points)]
    has = np.zeros(len(texts), bool)
    has[row[letter[points]]] = True
    c = keep[points].astype(np.uint32)
    solo = np.ones(len(c), bool)
    solo[1:] = (c[1:] != 32) | (c[:-1] != 32) | (row[1:] != row[:-1])  # one blank per gap
    c, row = c[solo], row[solo]
    keys = []
    for n in (1, 2, 3):
        if len(c) < n:
            break
        h = np.full(len(c) - n + 1, n, np.uint32)
        for j in range(n):
            h = (h ^ c[j:len(c) - n + 1 + j]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        h = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        same = row[:len(h)] == row[n - 1:]
        keys.append(((row[:len(h)].astype(np.int64) << BITS) | h)[same])
    keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    cells = np.bincount(keys, minlength=len(texts) << BITS)
    used = np.flatnonzero(cells)
    r, col = used >> BITS, used & ((1 << BITS) - 1)
    ok = has[r]
    return r[ok], col[ok], cells[used][ok]


def tfidf(texts: list[str], idf: np.ndarray):
    """Rows in L2 norm: (row, column, value)."""
    r, c, n = ngrams(texts)
    x = (1 + np.log(n)) * idf[c]
    norm = np.sqrt(np.bincount(r, x * x, minlength=len(texts)))
    return r, c, x / norm[r]


def _chunks(column: pa.Array, rows: int = 32):
    for i in range(0, len(column), rows):
        yield ["" if t is None else t for t in column.slice(i, rows).to_pylist()]


def _frequencies(batches):
    total, docs = np.zeros(1 << BITS, np.int64), 0
    for b in slices(batches):
        for texts in _chunks(b.column("text")):
            _, c, _ = ngrams(texts)
            total += np.bincount(c, minlength=1 << BITS)
            docs += len(texts)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], docs))], ["c", "n"])


def _features(idf, batches):
    """Columns and values of whole texts."""
    for b in slices(batches):
        cells = [[], []]
        for texts in _chunks(b.column("text")):
            r, c, x = tfidf(texts, idf)
            cut = np.searchsorted(r, np.arange(len(texts) + 1))
            cells[0] += [c[a:z].astype("<i2").tobytes() for a, z in zip(cut[:-1], cut[1:])]
            cells[1] += [x[a:z].astype("<f4").tobytes() for a, z in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), *(pa.array(c, pa.binary()) for c in cells)],
                                         ["doc_id", "lang", "columns", "x"])


def train_ftrl(rows, labels: np.ndarray, n_classes: int, alpha=0.5, beta=1.0, l1=1e-3, l2=1e-3, epochs=4):
    """FTRL-proximal for the multinomial log loss; ``rows`` are (columns, values)."""
    z = np.zeros((1 << BITS, n_classes), np.float64)
    n = np.zeros_like(z)
    rng = np.random.default_rng(7)

    def weights(zc, nc):
        w = -(zc - np.sign(zc) * l1) / ((beta + np.sqrt(nc)) / alpha + l2)
        return np.where(np.abs(zc) <= l1, 0.0, w)

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            c, x = rows[i]
            zc, nc = z[c], n[c]
            w = weights(zc, nc)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[labels[i]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(nc + g * g) - np.sqrt(nc)) / alpha
            z[c] = zc + g - sigma * w
            n[c] = nc + g * g
    return weights(z, n)


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Temperature with the smallest log loss on rows kept back."""
    def loss(t):
        s = scores / t
        s = s - s.max(1, keepdims=True)
        return -(s[np.arange(len(s)), labels] - np.log(np.exp(s).sum(1))).mean()
    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
    return float(grid[np.argmin([loss(t) for t in grid])]) if len(scores) else 1.0


class Model:
    def __init__(self, langs, idf, weights, temperature):
        self.langs, self.idf, self.weights, self.temperature = langs, idf, weights, temperature

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores per language, rows with a letter)."""
        r, c, x = tfidf(texts, self.idf)
        out = np.empty((len(texts), len(self.langs)))
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(r, x * self.weights[c, k], minlength=len(texts))
        has = np.zeros(len(texts), bool)
        has[r] = True
        return out, has


def fit(docs: DataFrame, labelled: DataFrame, max_rows: int = MAX_ROWS) -> Model | None:
    """``docs`` (text) give the document frequencies, ``labelled`` (doc_id, text, lang) the labels."""
    found = {r["c"]: r["n"] for r in narrow(docs, "text").mapInArrow(_frequencies, "c long, n long")
             .groupBy("c").agg(F.sum("n").alias("n")).collect()}  # at most 2**BITS + 1 rows
    total = found.pop(-1, 0)
    df = np.zeros(1 << BITS)
    df[list(found)] = list(found.values())
    idf = np.log((1 + total) / (1 + df)) + 1
    known = labelled.filter("text is not null and lang is not null")
    langs = sorted(r["lang"] for r in known.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not langs:
        return None
    # A bounded sample of labelled rows: the smallest id hashes of every language, whole texts.
    each = max(1, max_rows // len(langs))
    spot = F.xxhash64("doc_id")
    order = Window.partitionBy("lang").orderBy("spot", "doc_id")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    narrowed = F.lit(1 << 30)  # few rows are ranked: a share of the hashes that surely holds enough of a language
    for lang in langs:
        share = min(1.0, 1.5 * each / counts[lang] + 20 / counts[lang])
        narrowed = F.when(F.col("lang") == lang, int(share * (1 << 30))).otherwise(narrowed)
    ids = known.filter(F.pmod(spot, F.lit(1 << 30)) <= narrowed).select("doc_id", "lang", F.pmod(spot, F.lit(1 << 30)).alias("spot"))
    picks = ids.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= each).select("doc_id", "lang").distinct()
    chosen = known.join(F.broadcast(picks), ["doc_id", "lang"]).select("doc_id", "lang", "text")  # about max_rows rows
    kind = known.schema["doc_id"].dataType.simpleString()
    rows, seen = [], dict.fromkeys(langs, 0)
    found = chosen.mapInArrow(partial(_features, idf), f"doc_id {kind}, lang string, columns binary, x binary")
    for r in found.orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "columns").limit(2 * max_rows).collect():  # 2**BITS cells a row at most
        if seen[r["lang"]] < each:
            seen[r["lang"]] += 1
            rows.append((np.frombuffer(r["columns"], "<i2").astype(np.int64), np.frombuffer(r["x"], "<f4").astype(np.float64), langs.index(r["lang"])))
    feats, labels = [(c, x) for c, x, _ in rows], np.array([y for _, _, y in rows])
    kept_back = np.arange(len(rows)) % 5 == 4
    weights = train_ftrl([f for f, k in zip(feats, kept_back) if not k], labels[~kept_back], len(langs))
    held = np.array([x @ weights[c] for (c, x), k in zip(feats, kept_back) if k]).reshape(-1, len(langs))
    return Model(langs, idf, weights, fit_temperature(held, labels[kept_back]))


def _predict(model, carry, batches):
    for b in slices(batches):
        names, values = [], []
        for texts in _chunks(b.column("text")):
            if model is None:
                names += ["und"] * len(texts)
                values += [0.0] * len(texts)
                continue
            s, has = model.scores(texts)
            s = s / model.temperature
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best = p.argmax(1)
            names += [model.langs[k] if h else "und" for k, h in zip(best, has)]
            values += [float(v) if h else 0.0 for v, h in zip(p.max(1), has)]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carry), pa.array(names, pa.string()), pa.array(values)],
                                         [*carry, "lang_pred", "score"])


def predict(docs: DataFrame, model: Model | None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(carried columns, lang_pred, score) of every whole text."""
    names = list(dict.fromkeys([*carry, "text"]))
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    return narrow(docs, *names).mapInArrow(partial(_predict, model, carry), schema + "lang_pred string, score double")
