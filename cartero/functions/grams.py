"""Character n-grams of whole texts in Arrow batches, as sorted 64-bit keys.

Up to three code points are packed into one integer, first code point first, so keys sort as
the strings do.  What is returned here runs inside tasks and is pickled by value: the
workers need no copy of the package.
"""

from __future__ import annotations

from collections.abc import Callable

SLICE = 1 << 20  # characters taken apart at once
TABLE = 1 << 23  # entries of a table of counts
DENSE = 160      # characters whose n-grams the scorer finds in a table
COUNTS = "idioma string, g long, n long"
SUMS = "_n long, _sums array<double>"


def packer(sizes: tuple[int, ...]) -> Callable:
    """texts -> (text numbers, keys) of all n-grams; n-grams never cross texts."""
    if max(sizes) > 3:
        raise ValueError("n-grams of more than three characters do not fit a key")

    def pack(texts: list[str]):
        import numpy as np
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        rows, keys = [row[:0]], [points[:0]]
        for n in sizes:
            m = len(points) - n + 1
            if m <= 0:
                continue
            key = points[:m] << 42
            for k in range(1, n):
                key |= points[k:k + m] << (42 - 21 * k)
            inside = row[:m] == row[n - 1:]
            rows.append(row[:m][inside])
            keys.append(key[inside])
        return np.concatenate(rows), np.concatenate(keys)

    def slices(texts: list[str]):
        """(first, last) text of stretches of about SLICE characters."""
        start = size = 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= SLICE:
                yield start, i + 1
                start, size = i + 1, 0
        if start < len(texts):
            yield start, len(texts)

    pack.slices = slices
    return pack


def counter(sizes: tuple[int, ...]) -> Callable:
    """Batches of (idioma, _t) -> COUNTS, merged inside each stretch of texts.

    N-grams are counted in a table over the characters of a stretch; sorted keys are counted where it would be too large.
    """
    pack = packer(sizes)

    def count(batches):
        import numpy as np
        import pyarrow as pa

        def tallied(texts):
            size = np.array([len(t) for t in texts])
            points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
            known = np.flatnonzero(np.bincount(points))
            wide = len(known) + 1
            if wide ** max(sizes) > TABLE:
                return np.unique(pack(texts)[1], return_counts=True)
            number = np.zeros(known[-1] + 1 if len(known) else 1, np.int64)
            number[known] = np.arange(1, wide)
            code = np.append(0, known + 1).astype(np.int64)
            ids, ends = number[points], np.cumsum(size)
            at, keys, counts = ids, [], []
            for n in range(1, max(sizes) + 1):
                if n > 1:
                    at = at[:-1] * wide + ids[n - 1:]
                if n not in sizes or not len(at):
                    continue
                inside = at.copy()
                for k in range(1, n):  # n-grams that begin in the last n - 1 places of a text leave it
                    left = ends[size >= k] - k
                    inside[left[left < len(at)]] = 0
                found = np.bincount(inside)
                found[0] = 0
                hit = np.flatnonzero(found)
                key, rest = np.zeros(len(hit), np.int64), hit
                for k in reversed(range(n)):
                    key |= code[rest % wide] << (42 - 21 * k)
                    rest = rest // wide
                keys.append(key)
                counts.append(found[hit])
            return np.concatenate(keys or [code[:0]]), np.concatenate(counts or [code[:0]])

        for b in batches:
            langs, texts = b.column("idioma").to_pylist(), b.column("_t").to_pylist()
            for a, z in pack.slices(texts):
                for lang in sorted(set(langs[a:z])):
                    g, n = tallied([t for t, own in zip(texts[a:z], langs[a:z]) if own == lang])
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], ["idioma", "g", "n"])

    return count


def gram_number(length: int, sizes: tuple[int, ...]) -> int:
    """N-grams of a text of ``length`` characters."""
    return sum(max(length - n + 1, 0) for n in sizes)


def scorer(sizes: tuple[int, ...], profile, languages: int) -> Callable:
    """Batches of (_row, _t) -> (_row, SUMS): n-grams of a text and the sum of their gains per language.

    ``profile`` is a broadcast (sorted keys, gains per key and language).  The DENSE characters that most
    n-grams of the profile have are numbered, so their n-grams are found in a table; only n-grams with
    another character are searched among the keys.
    """
    pack = packer(sizes)

    def score(batches):
        import numpy as np
        import pyarrow as pa
        keys, gains = profile.value
        low = (1 << 21) - 1
        parts = [keys >> 42, keys >> 21 & low, keys & low]          # 0 where a key has no such character
        codes, uses = np.unique(np.concatenate(parts), return_counts=True)
        uses[codes == 0] = 0
        dense = np.sort(codes[np.argsort(-uses, kind="stable")[:DENSE]])
        dense = dense[dense > 0]
        wide, none = len(dense) + 1, len(keys)
        number = np.zeros(0x110001, np.int32)
        number[dense - 1] = np.arange(1, wide)
        own = [np.append(0, number)[p] for p in parts]
        length = sum((p > 0).astype(int) for p in parts)
        tables = {}
        for n in sizes:
            whole = (length == n) & np.all([o > 0 for o in own[:n]], axis=0)
            tables[n] = np.full(wide ** n, none, np.int32)
            place = np.zeros(whole.sum(), np.int64)
            for o in own[:n]:
                place = place * wide + o[whole]
            tables[n][place] = np.flatnonzero(whole)
        columns = [np.append(gains[:, k], 0.0) for k in range(languages)]

        def searched(points, at, n, odd):
            """Rows of the n-grams at the places ``odd``."""
            key = np.zeros(len(odd), np.int64)
            for k in range(n):
                key |= points[odd + k].astype(np.int64) + 1 << (42 - 21 * k)
            found = np.minimum(np.searchsorted(keys, key), none - 1)
            at[odd] = np.where(keys[found] == key, found, none)

        def summed(texts, sums):
            size = np.array([len(t) for t in texts])
            points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
            if not len(points) or not none:
                return
            ids, ends, filled = number[points], np.cumsum(size), np.flatnonzero(size)
            starts, place = (ends - size)[filled], ids
            other = ids == 0
            for n in range(1, max(sizes) + 1):
                if n > 1:
                    place = place[:-1] * wide + ids[n - 1:]
                    other = other[:-1] | (ids[n - 1:] == 0)
                if n not in sizes or not len(place):
                    continue
                at = np.full(len(points), none, np.int32)
                at[:len(place)] = tables[n][place]
                odd = np.flatnonzero(other)
                if len(odd):
                    searched(points, at, n, odd)
                for k in range(1, n):  # n-grams that begin in the last n - 1 places of a text leave it
                    at[ends[size >= k] - k] = none
                for k in range(languages):
                    sums[filled, k] += np.add.reduceat(columns[k][at], starts)

        for b in batches:
            texts = b.column("_t").to_pylist()
            total = np.array([sum(max(len(t) - n + 1, 0) for n in sizes) for t in texts], np.int64)
            sums = np.zeros((len(texts), languages))
            for a, z in pack.slices(texts):
                summed(texts[a:z], sums[a:z])
            flat = pa.array(sums.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * languages), flat)
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(total), lists], ["_row", "_n", "_sums"])

    return score
