"""LM scoring by masked pseudo-likelihood: a window network predicts every word from both sides.

Words are those of the benchmark contract.  The vocabulary holds the VOCAB - 1 most
frequent words of all documents; any other word is word 0, whose probability is shared
out: a word with LEAST occurrences has its share of all words outside the vocabulary, and
the share of the rarer ones is spelt out, letter by letter after the two letters before.
Both count all documents, so their tables grow with the input.  The counts of at most HELD
of these words, the most frequent, go to the tasks; those of all others stay in a table
that is joined by word to the words of the texts.  The network reads the
embeddings of SIDE words on either side (a padding word beyond the ends), one hidden
layer, and a softmax in two steps, class and word in class.  Every partition trains on
masked positions of all its documents (every ROUNDS-th of a text, from the next one on
in each round, so that each position is a target once) from the same weights; the weights are averaged by the number of positions as a grouped sum.

Score: the sum of log conditional probabilities of all words of a whole text.  A text
without words (null or empty too) has 0 words and score 0.  Rows with equal ids are
scored each by themselves; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartero.llm.common import narrow, one_core, ragged, slices, span_hashes, stage
from cartero.llm.decontaminate import words_of

CLASSES = 32
VOCAB = CLASSES * CLASSES
SIDE, WIDTH, HIDDEN = 2, 16, 24
ROUNDS, BATCH, RATE = 2, 2048, 0.2
FLUSH = 1 << 20
LEAST, SMOOTH = 5, 16
HELD = 1 << 17  # 2 MB of counts in a task, whatever the number of words
_LETTER = np.zeros(256, np.int64)  # 0 is the end of a word, and what stands before it
_LETTER[48:58], _LETTER[97:123], _LETTER[128:] = np.arange(1, 11), np.arange(11, 37), np.arange(37, 165)
LETTERS = 165
SHAPES = {"embed": (VOCAB + 1, WIDTH), "w1": (2 * SIDE * WIDTH, HIDDEN), "b1": (HIDDEN,), "wc": (HIDDEN, CLASSES),
          "bc": (CLASSES,), "ww": (CLASSES, HIDDEN, CLASSES), "bw": (CLASSES, CLASSES)}


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def initial() -> np.ndarray:
    rng = np.random.default_rng(5)
    parts = [np.zeros(s) if name[0] == "b" else rng.normal(0, 0.3 if name == "embed" else s[-2] ** -0.5, s)
             for name, s in SHAPES.items()]
    return np.concatenate([p.ravel() for p in parts]).astype(np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    """In place, by rows."""
    x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    x /= (x @ np.ones(x.shape[1], x.dtype))[:, None]
    return x


def contexts(ids: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words on both sides of the positions; VOCAB stands for beyond the text."""
    text = np.searchsorted(bounds, at, "right") - 1
    out = np.empty((len(at), 2 * SIDE), np.int64)
    for i, shift in enumerate([s for s in range(-SIDE, SIDE + 1) if s]):
        j = at + shift
        ok = (j >= bounds[text]) & (j < bounds[text + 1])
        out[:, i] = np.where(ok, ids[np.clip(j, 0, len(ids) - 1)], VOCAB)
    return out


def targets(bounds: np.ndarray, turn: int) -> np.ndarray:
    """Masked positions of a round; the rounds have every position of every text once."""
    n = int(bounds[-1])
    return np.flatnonzero((np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))) % ROUNDS == turn)


def _by_class(words: np.ndarray):
    order = np.argsort(words // CLASSES, kind="stable")
    cut = np.searchsorted((words // CLASSES)[order], np.arange(CLASSES + 1))
    return [(c, order[cut[c]:cut[c + 1]]) for c in range(CLASSES) if cut[c] < cut[c + 1]]


def _log_softmax_at(x: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The log-softmax of every row at one column; x is used up."""
    top = x.max(1)
    out = x[np.arange(len(x)), column] - top
    x -= top[:, None]
    np.exp(x, out=x)
    return out - np.log(x @ np.ones(x.shape[1], x.dtype))


def log_probabilities(net: dict, around: np.ndarray, words: np.ndarray) -> np.ndarray:
    h = np.tanh(net["embed"][around].reshape(len(words), -1) @ net["w1"] + net["b1"])
    out = _log_softmax_at(h @ net["wc"] + net["bc"], words // CLASSES)
    for c, rows in _by_class(words):
        out[rows] += _log_softmax_at(h[rows] @ net["ww"][c] + net["bw"][c], words[rows] % CLASSES)
    return out


def step(net: dict, memory: dict, around: np.ndarray, words: np.ndarray) -> None:
    """One Adagrad step on a batch."""
    n = len(words)
    order = np.argsort((words // CLASSES).astype(np.uint8), kind="stable")
    around, words = around[order], words[order]
    cuts = np.searchsorted(words // CLASSES, np.arange(CLASSES + 1))
    x = net["embed"][around].reshape(n, -1)
    h = np.tanh(x @ net["w1"] + net["b1"])
    g = {k: np.zeros_like(v) for k, v in net.items()}
    row, kind = np.arange(n), words // CLASSES
    p = h @ net["wc"]
    p += net["bc"]
    p = _softmax(p)
    p[row, kind] -= 1
    g["wc"], g["bc"] = h.T @ p, p.sum(0)
    dh = p @ net["wc"].T
    some = np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()
    parts = [(c, slice(cuts[c], cuts[c + 1])) for c in some]
    p = net["bw"][kind]
    for c, rows in parts:
        p[rows] += h[rows] @ net["ww"][c]
    p = _softmax(p)
    p[row, words % CLASSES] -= 1
    g["bw"][some] = np.add.reduceat(p, cuts[some], axis=0)
    for c, rows in parts:
        np.matmul(h[rows].T, p[rows], out=g["ww"][c])
        dh[rows] += p[rows] @ net["ww"][c].T
    da = dh * (1 - h * h)
    g["w1"], g["b1"] = x.T @ da, da.sum(0)
    cells = (around.ravel()[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    g["embed"] += np.bincount(cells, (da @ net["w1"].T).ravel(), g["embed"].size).reshape(g["embed"].shape)
    for k, v in g.items():
        v /= n
        memory[k] += v * v
        net[k] -= RATE * v / (np.sqrt(memory[k]) + 1e-6)


class Vocabulary:
    """Word hash -> id; ids follow frequency, 0 is any other word."""

    def __init__(self, hashes: list[int]):
        keys = np.array(hashes, np.int64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], order + 1

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.ids[at], 0)


def spelling(buf: np.ndarray, s: np.ndarray, e: np.ndarray):
    """(code of every letter and end after the two before it, first code of each word)."""
    sizes = e - s + 1
    first = np.cumsum(sizes) - sizes
    sym = _LETTER[buf[np.minimum(ragged(s, sizes), len(buf) - 1)]]
    sym[first + sizes - 1] = 0
    one, two = np.zeros_like(sym), np.zeros_like(sym)
    one[1:], two[2:] = sym[:-1], sym[:-2]
    two[first] = 0
    return (two * LETTERS + one) * LETTERS + sym, first


class Outside:
    """Log probabilities of words given that they are outside the vocabulary.

    ``counted`` is the sum of the counts of all words with LEAST occurrences, of which ``keys`` are the held ones.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, counted: int, rarer: int, codes: np.ndarray, n: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        self.rarer = max(rarer, 1)
        self.total = counted + self.rarer
        three = np.zeros(LETTERS ** 3, np.float32)
        three[codes] = n
        three = three.reshape(LETTERS, LETTERS, LETTERS)
        two = three.sum(0, dtype=np.float64)
        one = (two.sum(0) + 1) / (two.sum() + LETTERS)
        two = (two + SMOOTH * one) / (two.sum(1, keepdims=True) + SMOOTH)
        size = three.sum(2, keepdims=True) + np.float32(SMOOTH)
        three += (SMOOTH * two).astype(np.float32)
        self.logs = np.log(three / size).ravel()

    def of(self, hashes: np.ndarray, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log probabilities, whether the word is held); that of a word that is not held is its spelling's alone."""
        if not len(hashes):
            return np.zeros(0), np.zeros(0, bool)
        codes, first = spelling(buf, s, e)
        spelt = np.add.reduceat(self.logs[codes].astype(np.float64), first) + np.log(self.rarer / self.total)
        if not len(self.keys):
            return spelt, np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        held = self.keys[at] == hashes
        known = np.flatnonzero(held)
        spelt[known] = np.logaddexp(spelt[known], np.log(self.counts[at[known]] / self.total))
        return spelt, held


# -------------------------------------------------------------------- in tasks
def _count(batches):
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held: list[np.ndarray] = []

    def merged():
        new, n = np.unique(np.concatenate(held), return_counts=True) if held else (keys[:0], counts[:0])
        k, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
        return k, np.bincount(back, np.concatenate([counts, n]), minlength=len(k)).astype(np.int64)

    for b in slices(batches):
        buf, _, s, e, _ = words_of(b.column("text"))
        held.append(span_hashes(buf, s, e).view(np.int64))
        if sum(map(len, held)) > FLUSH:
            (keys, counts), held = merged(), []
            if len(keys) > FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["word", "n"])
                keys, counts = keys[:0], counts[:0]
    keys, counts = merged()
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["word", "n"])


def _train(vocabulary, flat, turn, batches):
    one_core()
    net = {k: v.copy() for k, v in unpack(flat).items()}
    memory, seen, wait = {k: np.full_like(v, 1e-3) for k, v in net.items()}, 0, []
    spelt, held = np.zeros(LETTERS ** 3 if turn == 0 else 0, np.int64), []
    for b in slices(batches):
        buf, _, s, e, bounds = words_of(b.column("text"))
        ids = vocabulary.of(span_hashes(buf, s, e).view(np.int64))
        if turn == 0:
            other = np.flatnonzero(ids == 0)
            if len(other):
                held.append(spelling(buf, s[other], e[other])[0])
            if sum(map(len, held)) > 4 * FLUSH:
                spelt += np.bincount(np.concatenate(held), minlength=len(spelt))
                held = []
        at = targets(bounds, turn)
        if not len(at):
            continue
        at = np.random.default_rng(turn).permutation(at)
        wait.append((contexts(ids, bounds, at), ids[at]))
        seen += len(at)
        around, words = (np.concatenate(c) for c in zip(*wait))
        full = len(words) // BATCH * BATCH
        for i in range(0, full, BATCH):
            step(net, memory, around[i:i + BATCH], words[i:i + BATCH])
        wait = [(around[full:], words[full:])]
    for around, words in wait:
        if len(words):
            step(net, memory, around, words)
    if held:
        spelt += np.bincount(np.concatenate(held), minlength=len(spelt))
    codes = np.flatnonzero(spelt)
    if len(codes):
        yield pa.RecordBatch.from_arrays([pa.array(codes + len(flat)), pa.array(spelt[codes].astype(np.float64))], ["i", "v"])
    if seen:
        new = np.concatenate([net[k].ravel() for k in SHAPES]).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(new))), pa.array(np.append(seen, new * seen))], ["i", "v"])


def _score(vocabulary, flat, carry, batches):
    one_core()
    net = unpack(flat)
    for b in slices(batches):
        buf, _, s, e, bounds = words_of(b.column("text"))
        hashes = span_hashes(buf, s, e).view(np.int64)
        ids = vocabulary.of(hashes)
        total = np.zeros(len(ids) + 1)
        for i in range(0, len(ids), 1 << 14):
            at = np.arange(i, min(len(ids), i + (1 << 14)))
            total[at + 1] = log_probabilities(net, contexts(ids, bounds, at), ids[at])
        other = np.flatnonzero(ids == 0)
        spelt, held = vocabulary.outside.of(hashes[other], buf, s[other], e[other])
        total[other + 1] += spelt
        np.cumsum(total, out=total)
        # Words that are not held, once for every text, with their number: their counts are joined.
        left = np.flatnonzero(~held)
        word, text = hashes[other[left]], np.searchsorted(bounds, other[left], "right") - 1
        by = np.lexsort((word, text))
        word, text, own = word[by], text[by], spelt[left[by]]
        first = np.flatnonzero((np.diff(word, prepend=0) != 0) | (np.diff(text, prepend=-1) != 0))
        number = np.diff(np.append(first, len(word)))
        cuts = np.searchsorted(text[first], np.arange(b.num_rows + 1)).astype(np.int32)
        rare = pa.StructArray.from_arrays([pa.array(word[first]), pa.array(own[first]), pa.array(number)], ["word", "spelt", "k"])
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in carry), pa.array(np.diff(bounds)), pa.array(total[bounds[1:]] - total[bounds[:-1]]),
             pa.ListArray.from_arrays(pa.array(cuts), rare)], [*carry, "n_words", "_base", "_rare"])


# --------------------------------------------------------------- the operator
def fit(docs: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and weights from all documents; the vocabulary names the written table of counts."""
    source = narrow(docs, "text")
    path: list = []
    words = stage(source.mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words", path)
    top = words.orderBy(F.desc("n"), "word").limit(VOCAB - 1).collect()  # VOCAB - 1 rows
    vocabulary, flat = Vocabulary([r["word"] for r in top]), initial()
    codes, n = np.zeros(0, np.int64), np.zeros(0)
    for turn in range(ROUNDS):
        sums = source.mapInArrow(partial(_train, vocabulary, flat, turn), "i long, v double")
        sums = sums.groupBy("i").agg(F.sum("v").alias("v")).toArrow()  # one row per weight, and per three letters
        i, v = (sums[c].to_numpy() for c in ("i", "v"))
        if turn == 0:
            codes, n = i[i >= len(flat)] - len(flat), v[i >= len(flat)]
        if (i < 0).any():
            new = np.zeros(len(flat))
            own = (i >= 0) & (i < len(flat))
            new[i[own]] = v[own]
            flat = (new / v[i < 0][0]).astype(np.float32)
    # What follows the vocabulary in the same order; at most HELD of the words go to the tasks.
    last = (top[-1]["n"], top[-1]["word"]) if top else (0, 0)
    other = words.filter((F.col("n") < last[0]) | ((F.col("n") == last[0]) & (F.col("word") > last[1])))
    rarer = other.filter(F.col("n") < LEAST).agg(F.sum("n")).first()[0] or 0
    other = other.filter(F.col("n") >= LEAST)
    counted, room, cut = 0, HELD, 0
    for r in other.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).collect():  # one row per count
        counted += r["n"] * r["words"]
        room -= r["words"]
        if room < 0:
            cut = max(cut, r["n"] + 1)
    table = other.filter(F.col("n") >= cut).toArrow()  # at most HELD rows
    keys, counts = (table[c].to_numpy() for c in ("word", "n"))
    vocabulary.outside = Outside(keys, counts, counted, rarer, codes, n)
    vocabulary.outside.rest = (path[0], cut)
    return vocabulary, flat


def score(docs: DataFrame, model: tuple[Vocabulary, np.ndarray], carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(carried columns, n_words, log_likelihood) of every whole text."""
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    found = narrow(docs, *dict.fromkeys([*carry, "text"])).mapInArrow(
        partial(_score, *model, carry),
        schema + "n_words long, _base double, _rare array<struct<word:long,spelt:double,k:long>>")
    found = stage(found.withColumn("_row", F.monotonically_increasing_id()), "scored")
    # A word has its share by count or is spelt: log(exp(spelt) + share), of which spelt is in the base already.
    more = F.log(F.col("n") / F.lit(float(model[0].outside.total))) - F.col("spelt")
    gain = F.greatest(more, F.lit(0.0)) + F.log1p(F.exp(-F.abs(more)))
    path, cut = model[0].outside.rest
    counts = docs.sparkSession.read.schema("word long, n long").parquet(path).filter((F.col("n") >= LEAST) & (F.col("n") < cut))
    rare = found.select("_row", F.inline("_rare")).join(counts, "word")
    gains = rare.groupBy("_row").agg(F.sum(F.col("k") * gain).alias("_gain"))
    return found.drop("_rare").join(gains, "_row", "left").select(
        *carry, "n_words", (F.col("_base") + F.coalesce("_gain", F.lit(0.0))).alias("log_likelihood"))
