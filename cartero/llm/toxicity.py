"""Toxicity by weak supervision.

1. Voters: a seed lexicon, lexicons induced from labelled rows (words and word beginnings
   far more frequent in toxic texts), and patterns (an insult after a word of address, shouting,
   exclamation).  Each says toxic (1), clean (0) or nothing (2) about a whole text.
2. A generative label model over the counts of vote patterns of all documents estimates
   how often each voter says what about either class, and how strongly voters repeat
   each other given the class; correlated voters count less.  Labelled rows of the
   learning fold keep their label.
3. A linear classifier over the presence of words and word beginnings with an L1 penalty is trained on the posterior
   labels of a bounded sample and scores every whole text.

Bounds: at most LABELLED labelled rows of either class, LEXICON induced words, TRAIN
rows per class for the classifier (with at most MAX_TERMS distinct terms each), and
3**VOTERS vote patterns.  Everything else covers all documents.

A null or empty text votes like a clean one and gets the classifier's base score; with
no labelled rows the seed lexicon and patterns alone define the classes.  Rows with
equal ids are scored each by themselves; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartero.llm.common import binaries, bytes_of, narrow, prefix_sums, slices, span_hashes, stage
from cartero.llm.decontaminate import words_of

# FIXED VALUES: plain insults and words of address in the corpus languages.
SEED = """idiot idiots moron morons imbecile stupid dumb fool loser losers scum trash garbage pathetic worthless
disgusting clown jerk bastard bitch asshole shit fuck fucking filthy vermin idiota imbécil estúpido estúpida basura
asqueroso cabrón mierda payaso idiote imbécile stupide connard salaud ordure merde dégoûtant arschloch dummkopf
schwachkopf abschaum scheiße widerlich blödmann""".split()
ADDRESS = "you your youre u are a an such du ihr euch bist tu vous es un une eres usted una".split()

LABELLED, LEXICON, TRAIN = 4000, 200, 3000
STEMS = (4, 5, 6)  # bytes of a word beginning
VOTERS, BUCKET_BITS = 10, 18
L1, STEPS = 5e-4, 120


def word_keys(words: list[str]) -> np.ndarray:
    buf, _, s, e, _ = words_of(pa.array([" ".join(words)], pa.string()))
    return np.unique(span_hashes(buf, s, e))


class Lexicon:
    """Term hash -> rank, behind a table of hash prefixes that few other terms pass."""

    def __init__(self, keys: np.ndarray):
        self.rank = np.argsort(keys)
        self.keys = keys[self.rank]
        self.table = np.zeros(1 << 18, bool)
        self.table[(keys >> np.uint64(46)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of members, their ranks)."""
        at = np.flatnonzero(self.table[(hashes >> np.uint64(46)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        i = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        good = self.keys[i] == hashes[at]
        return at[good], self.rank[i[good]]


def terms(column: pa.Array):
    """(text of every word, hashes of every word and its beginnings as rows)."""
    buf, _, s, e, bounds = words_of(column)
    total = prefix_sums(buf)
    rows = [span_hashes(buf, s, e, total)]
    for n in STEMS:
        stem = span_hashes(buf, s, np.minimum(s + n, e), total) ^ np.uint64(n)
        rows.append(np.where(e - s > n, stem, rows[0]))
    return np.searchsorted(bounds[1:], np.arange(len(s)), "right"), np.stack(rows)


# -------------------------------------------------------------------- in tasks
def _word_counts(batches):
    """Documents per word, toxic and clean, of labelled rows."""
    for b in slices(batches):
        doc, hashes = terms(b.column("text"))
        order = np.lexsort((hashes.ravel(), np.tile(doc, len(hashes))))
        pairs = np.stack([np.tile(doc, len(hashes)).astype(np.uint64), hashes.ravel()])[:, order]
        pairs = pairs[:, np.r_[True, (pairs[:, 1:] != pairs[:, :-1]).any(0)][:pairs.shape[1]]]
        toxic = np.array(b.column("toxic").to_pylist(), np.int64)[pairs[0].astype(np.int64)]
        words, back = np.unique(pairs[1], return_inverse=True)
        n = [np.bincount(back, w, minlength=len(words)).astype(np.int64) for w in (toxic, 1 - toxic)]
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), *map(pa.array, n)], ["word", "toxic", "clean"])


def votes(column: pa.Array, seed: Lexicon, induced: Lexicon, address: Lexicon) -> np.ndarray:
    """One row of VOTERS votes per text."""
    raw, offs = bytes_of(column)
    doc, hashes = terms(column)
    n = len(column)

    def texts(words):
        return np.bincount(doc[np.unique(words)], minlength=n)

    in_seed, _ = seed.find(hashes[0])
    found = [induced.find(h) for h in hashes]
    where, rank = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    seeds, induced_n = texts(in_seed), texts(where)
    out = np.full((n, VOTERS), 2, np.int8)
    out[seeds > 0, 0] = 1
    out[seeds == 0, 1], out[seeds > 1, 1] = 0, 1
    for i in range(4):  # four lexicons, dealt by rank
        out[texts(where[rank % 4 == i]) > 0, 2 + i] = 1
    out[induced_n == 0, 6], out[induced_n > 1, 6] = 0, 1
    hit = np.union1d(in_seed, where)
    hit = hit[hit > 0]
    hit = hit[doc[hit] == doc[hit - 1]]
    out[texts(hit[address.find(hashes[0][hit - 1])[0]]) > 0, 7] = 1

    def total(mask):
        c = np.concatenate([[0], np.cumsum(mask)])
        return c[offs[1:]] - c[offs[:-1]]

    upper, lower = total((raw >= 65) & (raw <= 90)), total((raw >= 97) & (raw <= 122))
    out[:, 8] = np.where(upper > lower, 1, 0)
    out[:, 9] = np.where(total(raw == 33) * 40 > np.diff(offs), 1, 2)
    return out


def _vote(seed, induced, address, carry, batches):
    for b in slices(batches):
        v = votes(b.column("text"), seed, induced, address)
        code = (v * 3 ** np.arange(VOTERS)).sum(1)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carry), pa.array(code.astype(np.int64))], [*carry, "pattern"])


def _buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every term of every text."""
    doc, hashes = terms(column)
    return np.tile(doc, len(hashes)), (hashes.ravel() >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _features(batches):
    for b in slices(batches):
        doc, bucket = _buckets(b.column("text"))
        pairs = np.unique((doc << BUCKET_BITS) | bucket)
        counts = np.bincount(pairs >> BUCKET_BITS, minlength=b.num_rows)
        cells = binaries((pairs & ((1 << BUCKET_BITS) - 1)).astype("<i4"), counts)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), cells], ["doc_id", "y", "words"])  # 2**BUCKET_BITS words at most


def _score(weights, bias, carry, batches):
    active = weights != 0
    for b in slices(batches):
        doc, hashes = terms(b.column("text"))
        pairs = []
        for h in hashes:
            bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
            on = np.flatnonzero(active[bucket])
            pairs.append((doc[on] << BUCKET_BITS) | bucket[on])
        pairs = np.unique(np.concatenate(pairs))
        s = np.bincount(pairs >> BUCKET_BITS, weights[pairs & ((1 << BUCKET_BITS) - 1)], minlength=b.num_rows) + bias
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carry), pa.array(1 / (1 + np.exp(-s)))], [*carry, "score"])


# ------------------------------------------------------------------- the models
class LabelModel:
    """Class-conditional votes, down-weighted by the correlations that the class leaves unexplained."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, known: np.ndarray, rounds: int = 30):
        """``known``: labelled rows per pattern as columns clean, toxic."""
        v = codes[:, None] // 3 ** np.arange(VOTERS) % 3
        one = np.stack([v == k for k in range(3)], 2).astype(float)  # pattern, voter, vote
        self.codes, self.weights = codes, np.ones(VOTERS)
        says = (v == 1).sum(1)
        post = np.where(says > 1, 0.95, np.where(says == 1, 0.4, 0.02))
        seen = known.sum(1)
        post = np.where(seen > 0, (known[:, 1] + post) / (seen + 1), post)
        rest = np.maximum(counts - seen, 0)
        boost = max(1.0, 0.5 * rest.sum() / max(1, seen.sum()))  # labelled rows weigh half of the rest at least
        for _ in range(rounds):
            w1 = rest * post + boost * known[:, 1]
            w0 = rest * (1 - post) + boost * known[:, 0]
            self.prior = (w1.sum() + 1) / (w0.sum() + w1.sum() + 2)
            self.table = np.stack([(np.tensordot(w, one, 1) + 0.5) / (w.sum() + 1.5) for w in (w0, w1)])
            self.correlations = np.zeros((VOTERS, VOTERS))
            for w, k in ((w0, 0), (w1, 1)):
                x = (v == 1) - self.table[k, :, 1]
                cov = (x * w[:, None]).T @ x / max(w.sum(), 1e-9)
                d = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                self.correlations += cov / d[:, None] / d[None, :] / 2
            np.fill_diagonal(self.correlations, 0)
            self.weights = 1 / (1 + np.maximum(self.correlations, 0).sum(1))
            gain = np.log(self.table[1] / self.table[0])
            logit = np.log(self.prior / (1 - self.prior)) + np.einsum("pjk,jk,j->p", one, gain, self.weights)
            post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        self.posterior = post


def train_linear(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float]:
    """L1 logistic regression on soft labels by accelerated proximal gradient steps."""
    used, back = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.int64), return_inverse=True)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    # Terms whose gradient at zero is below half the penalty do not enter the model.
    pull = np.abs(np.bincount(back, (y - y.mean())[doc], minlength=len(used))) / max(1, len(rows)) if len(rows) else np.zeros(0)
    strong = pull > L1 / 2
    keep, number = strong[back], np.cumsum(strong) - 1
    used, back, doc = used[strong], number[back[keep]], doc[keep]
    n, w, b = max(1, len(rows)), np.zeros(len(used)), 0.0
    # Diagonal scaling: rare words take larger steps.
    rate = 4.0 / np.maximum(np.sqrt(np.bincount(back, minlength=len(used)) / n), 1e-2) / 10
    wp, bp, t = w, b, 1.0
    for _ in range(STEPS):
        s = np.bincount(doc, wp[back], minlength=len(rows)) + bp
        r = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y) / n
        g = np.bincount(back, r[doc], minlength=len(used))
        step = wp - rate * g
        new = np.sign(step) * np.maximum(np.abs(step) - rate * L1, 0)
        newb = bp - 2.0 * r.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wp, bp = new + (t - 1) / t2 * (new - w), newb + (t - 1) / t2 * (newb - b)
        w, b, t = new, newb, t2
    out = np.zeros(1 << BUCKET_BITS)
    out[used] = w
    return out, float(b)


# --------------------------------------------------------------- the operator
def _sample(ids: DataFrame, label: str, each: int) -> DataFrame:
    """At most ``each`` rows of either side of a 0/1 column, the smallest id hashes first."""
    parts = [ids.filter(F.col(label) == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and bias; ``docs`` (doc_id, text), ``labels`` (doc_id, toxic) of the rows to learn from."""
    source = narrow(docs, "doc_id", "text")
    labels = narrow(labels, "doc_id", "toxic").filter("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    labelled = stage(_sample(labels, "toxic", LABELLED), "labelled")
    texts = source.join(F.broadcast(labelled), "doc_id")  # at most 2 * LABELLED rows
    counts = texts.mapInArrow(_word_counts, "word long, toxic long, clean long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    top = (counts.filter("toxic >= 3").withColumn("odds", odds - 1.5 * error).filter(F.col("odds") > 2.2)
           .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "word").limit(LEXICON).collect())
    induced = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    task = (Lexicon(word_keys(SEED)), Lexicon(induced), Lexicon(word_keys(ADDRESS)))

    cast = stage(source.mapInArrow(partial(_vote, *task, ("doc_id",)), f"doc_id {source.schema['doc_id'].dataType.simpleString()}, pattern long"), "votes")
    patterns = cast.join(F.broadcast(labelled), "doc_id", "left").groupBy("pattern").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("toxic") == 0, 1)).alias("clean"),
        F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic")).orderBy("pattern").collect()  # at most 3**VOTERS rows
    if not patterns:
        return np.zeros(1 << BUCKET_BITS), 0.0
    model = LabelModel(np.array([r["pattern"] for r in patterns]), np.array([r["n"] for r in patterns], float),
                       np.array([[r["clean"], r["toxic"]] for r in patterns], float))
    rows = [(int(c), float(p)) for c, p in zip(model.codes, model.posterior)]
    posterior = docs.sparkSession.createDataFrame(rows, "pattern long, y double")
    soft = cast.join(F.broadcast(posterior), "pattern").select("doc_id", "y", (F.col("y") > 0.5).cast("int").alias("side"))
    picked = _sample(soft, "side", TRAIN).groupBy("doc_id").agg(F.max("y").alias("y"))  # a repeated id: its likeliest text
    picked = stage(picked, "picked")
    kinds = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, y double, words binary"
    train = source.join(F.broadcast(picked), "doc_id").mapInArrow(_features, kinds).orderBy("doc_id", "words").collect()
    return train_linear([np.frombuffer(r["words"], "<i4").astype(np.int64) for r in train], np.array([r["y"] for r in train]))


def score(docs: DataFrame, model: tuple[np.ndarray, float], carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(carried columns, score) of every whole text."""
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    return narrow(docs, *dict.fromkeys([*carry, "text"])).mapInArrow(partial(_score, *model, carry), schema + "score double")
