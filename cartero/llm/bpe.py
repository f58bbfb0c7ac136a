"""Byte-pair encoding of whole Arrow batches with the tokenizers library.

The split pattern of the byte-level vocabulary is found on the bytes of a whole
batch; every distinct piece is encoded once by the library and kept in a cache
of fixed size per worker process.  Texts with characters of three or more UTF-8
bytes, or with unusual white space, are given to the library as they are.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from cartero.llm.common import U64, ragged, span_hashes

SPACE, LETTER, DIGIT, OTHER, STRANGE = 1, 2, 3, 4, 5
CACHE_BITS = 20
ARENA_IDS = 1 << 25
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _kind(cp: int) -> int:
    c = chr(cp)
    if cp in (0x85, 0xA0):
        return STRANGE
    if cp == 32 or 9 <= cp <= 13:
        return SPACE
    return {"L": LETTER, "N": DIGIT}.get(unicodedata.category(c)[0], OTHER)


_KINDS = np.array([_kind(i) for i in range(0x800)], np.uint8)


def split_pieces(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece starts, odd): pieces of the vocabulary's pattern; odd texts are not split."""
    n = len(buf)
    kind = _KINDS[:256][buf]
    lead = np.flatnonzero((buf >= 0xC2) & (buf <= 0xDF))
    wide = _KINDS[((buf[lead] & 31).astype(np.int64) << 6) | (buf[lead + 1] & 63)]
    kind[lead] = wide
    kind[lead + 1] = wide
    kind[buf >= 0xE0] = STRANGE
    strange = np.flatnonzero(kind == STRANGE)
    odd = np.zeros(len(offs) - 1, bool)
    odd[np.searchsorted(offs, strange, "right") - 1] = True
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    follows = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~edge[1:n]) + 1
    start[follows - 1] = True
    start[follows[buf[follows - 1] == 32]] = False
    quotes = np.flatnonzero((buf == 39) & start)
    for tail in CONTRACTIONS:
        end = quotes + 1 + len(tail)
        q = quotes[end <= n]
        for i, c in enumerate(tail):
            q = q[(buf[q + 1 + i] == ord(c)) & ~edge[q + 1 + i]]
        start[q + 1] = False
        after = q + 1 + len(tail)
        start[after[after < n]] = True
    return np.flatnonzero(start), odd


class Encoder:
    """Ids of texts; one per worker process, see ``encoder``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tk = Tokenizer.from_file(path)
        self.tk.encode_special_tokens = True
        vocab = self.tk.get_vocab()
        self.size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.n_bytes = np.zeros(self.size, np.int64)
        for token, i in vocab.items():
            self.n_bytes[i] = len(token)
        self.reset()

    def reset(self) -> None:
        self.keys = np.zeros(1 << CACHE_BITS, np.uint64)
        self.offset = np.zeros(1 << CACHE_BITS, np.int64)
        self.length = np.zeros(1 << CACHE_BITS, np.int32)
        self.arena, self.used = np.zeros(1 << 16, self.dtype), 0

    def _store(self, ids: np.ndarray) -> int:
        while self.used + len(ids) > len(self.arena):
            self.arena = np.concatenate([self.arena, np.zeros_like(self.arena)])
        at = self.used
        self.arena[at:at + len(ids)] = ids
        self.used += len(ids)
        return at

    def _encode_pieces(self, buf, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Arena offset and length of each distinct piece."""
        offset, length = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        many = (ends - starts > 1) & (buf[starts] == 32)
        many &= _KINDS[:256][buf[np.minimum(starts + 1, len(buf) - 1)]] != SPACE
        raw = buf.tobytes()
        for group in np.array_split(np.flatnonzero(many), max(1, many.sum() // 128)):
            # Pieces with a leading space stay pieces when they are put in a row.
            if not len(group):
                continue
            joined = b"".join([raw[s:e] for s, e in zip(starts[group], ends[group])]).decode()
            ids = np.array(self.tk.encode(joined, add_special_tokens=False).ids, self.dtype)
            upto = np.concatenate([[0], np.cumsum(self.n_bytes[ids])])
            cut = np.searchsorted(upto, np.concatenate([[0], np.cumsum(ends[group] - starts[group])]))
            offset[group] = self._store(ids) + cut[:-1]
            length[group] = np.diff(cut)
        for i in np.flatnonzero(~many):
            ids = np.array(self.tk.encode(raw[starts[i]:ends[i]].decode(), add_special_tokens=False).ids, self.dtype)
            offset[i], length[i] = self._store(ids), len(ids)
        return offset, length

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        n_docs = len(offs) - 1
        if not len(buf):
            return np.zeros(0, self.dtype), np.zeros(n_docs, np.int64)
        if self.used > ARENA_IDS:
            self.reset()
        starts, odd = split_pieces(buf, offs)
        ends = np.append(starts[1:], len(buf))
        doc = np.searchsorted(offs, starts, "right") - 1
        if odd.any():
            plain = ~odd[doc]
            starts, ends, doc = starts[plain], ends[plain], doc[plain]
        key = span_hashes(buf, starts, ends)
        slot = (key >> U64(64 - CACHE_BITS)).astype(np.int64)
        offset, length = self.offset[slot], self.length[slot].astype(np.int64)
        miss = np.flatnonzero(self.keys[slot] != key)
        if len(miss):
            new, first, back = np.unique(key[miss], return_index=True, return_inverse=True)
            o, n = self._encode_pieces(buf, starts[miss[first]], ends[miss[first]])
            offset[miss], length[miss] = o[back], n[back]
            at = slot[miss[first]]
            self.keys[at], self.offset[at], self.length[at] = new, o, n
        ids = self.arena[ragged(offset, length)]
        counts = np.zeros(n_docs, np.int64)
        total = np.concatenate([[0], np.cumsum(length)])
        bounds = np.searchsorted(doc, np.arange(n_docs + 1))
        counts[:] = total[bounds[1:]] - total[bounds[:-1]]
        if not odd.any():
            return ids, counts
        parts, raw = [], buf.tobytes()
        for d in range(n_docs):
            if odd[d]:
                own = self.tk.encode(raw[offs[d]:offs[d + 1]].decode(), add_special_tokens=False).ids
                parts.append(np.array(own, self.dtype))
                counts[d] = len(own)
            else:
                parts.append(ids[total[bounds[d]]:total[bounds[d + 1]]])
        return np.concatenate(parts), counts


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, counts: np.ndarray, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Append the end id to every text."""
    return np.insert(ids, np.cumsum(counts), end), counts + 1
