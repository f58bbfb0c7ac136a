"""Words, pairs and known terms of mails in Arrow batches.

What is returned here runs inside tasks on the mails of a batch at once and is pickled by value: the workers
need no copy of the package.
"""

from __future__ import annotations

from collections.abc import Callable

SLICE = 1 << 20  # characters taken apart at once
COUNTS = "rasgos array<struct<term: string, cnt: int>>"
WEIGHTS = "term string, x double, norma double"
GRAMS = "array<struct<term: string, peso: double>>"


def cutter(most: int) -> Callable:
    """sizes of mails -> (first, last) mail of stretches of about ``most`` characters."""

    def stretches(sizes):
        start = size = 0
        for i, n in enumerate(sizes):
            size += n
            if size >= most:
                yield start, i + 1
                start, size = i + 1, 0
        if start < len(sizes):
            yield start, len(sizes)

    return stretches


def finder() -> Callable:
    """(counts of mails, terms) -> (mail, number of the term, 1 + ln cnt) of every known term."""

    def found(rasgos, terms):
        import numpy as np
        import pyarrow.compute as pc
        flat, of = rasgos.flatten(), pc.list_parent_indices(rasgos).to_numpy()
        number = pc.index_in(flat.field("term"), value_set=terms)
        hit = number.is_valid()
        cnt = flat.field("cnt").filter(hit).to_numpy(zero_copy_only=False)
        return of[hit.to_numpy(zero_copy_only=False)], number.filter(hit).to_numpy(), 1.0 + np.log(cnt.astype(float))

    return found


def counter(stop: list[str], upto: int) -> Callable:
    """Batches of (_row, _t) -> (_row, rasgos): counts of the words of a cleaned text, and of adjacent pairs if ``upto`` is 2.

    Words have two or more characters and are no stop words; a null text has null counts.
    """
    cut = cutter(SLICE)

    def counted(texts):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
        words, row = lists.flatten(), np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        keep = pc.and_(pc.greater_equal(pc.utf8_length(words), 2), pc.invert(pc.is_in(words, value_set=pa.array(stop, pa.string()))))
        row, coded = row[keep.to_numpy(zero_copy_only=False)], words.filter(keep).dictionary_encode()
        code, known = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        wide = max(len(known), 1)
        key = code
        if upto == 2:
            same = row[1:] == row[:-1]
            key = np.concatenate([code, (wide + code[:-1] * wide + code[1:])[same]])
            row = np.concatenate([row, row[1:][same]])
        order = np.lexsort((key, row)) if len(texts) * (wide + 1) * wide >= 1 << 62 else np.argsort(row * (wide + 1) * wide + key)
        row, key = row[order], key[order]
        first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (key[1:] != key[:-1]))[:len(row)])
        cnt = np.diff(np.append(first, len(row))).astype(np.int32)
        row, key = row[first], key[first]
        pair = key >= wide
        a, b = np.divmod(key[pair] - wide, wide)
        terms = pa.concat_arrays([known.take(pa.array(key[~pair])), pc.binary_join_element_wise(known.take(pa.array(a)), known.take(pa.array(b)), " ")])
        place = np.empty(len(key), np.int64)
        place[np.flatnonzero(~pair)] = np.arange((~pair).sum())
        place[np.flatnonzero(pair)] = np.arange((~pair).sum(), len(key))
        rows = pa.StructArray.from_arrays([terms.take(pa.array(place)), pa.array(cnt)], ["term", "cnt"])
        ends = np.append(0, np.cumsum(np.bincount(row, minlength=len(texts)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), rows, mask=texts.is_null())

    def count(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            texts = b.column("_t")
            for a, z in cut(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                yield pa.RecordBatch.from_arrays([b.column("_row").slice(a, z - a), counted(pa.concat_arrays([texts.slice(a, z - a)]))],
                                                 ["_row", "rasgos"])

    return count


def weigher(sent) -> Callable:
    """Batches of (_row, modelo, rasgos) -> (_row, term, x, norma) of every known term: its share of a mail of unit length.

    ``sent`` is a broadcast of model -> (terms, idf per term and column, ...), of which the first column counts.
    """
    find, cut = finder(), cutter(SLICE // 4)

    def weigh(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        tables = sent.value
        for b in batches:
            for name in {*b.column("modelo").to_pylist()} & tables.keys():
                terms, idf = tables[name][:2]
                mine = b.filter(pc.equal(b.column("modelo"), name))
                sizes = pc.fill_null(pc.list_value_length(mine.column("rasgos")), 0).to_pylist()
                for a, z in cut(sizes):
                    row, term, tf = find(mine.column("rasgos").slice(a, z - a), terms)
                    x = tf * idf[term, 0]
                    length = np.sqrt(np.bincount(row, x * x, minlength=z - a))[row]
                    yield pa.RecordBatch.from_arrays([mine.column("_row").slice(a, z - a).take(pa.array(row)), terms.take(pa.array(term)),
                                                      pa.array(x / length), pa.array(length)], ["_row", "term", "x", "norma"])

    return weigh


def class_adder(sent) -> Callable:
    """Batches of (modelo, Label_Code, pliegue, rasgos) -> (modelo, term, sums of ham, sums of spam), one sum per column of weights.

    ``sent`` is a broadcast of model -> (terms, idf per term and column, fold per column).  In a column a mail is
    (1 + ln cnt) * idf of its terms over their length; terms without idf are not in the column.  A column of a fold
    adds up the mails of other folds, one of fold -1 all mails.  Mails of a task are added up in the task.
    """
    find = finder()

    def add(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        tables, total = sent.value, {}
        for b in batches:
            models = b.column("modelo").to_pylist()
            label = np.array([-1 if y is None else y for y in b.column("Label_Code").to_pylist()])
            fold = np.array([-1 if f is None else f for f in b.column("pliegue").to_pylist()])
            for name in sorted(set(models) & tables.keys()):
                terms, idf, outside = tables[name]
                mine = pc.equal(b.column("modelo"), name)
                y, f = label[mine.to_numpy(zero_copy_only=False)], fold[mine.to_numpy(zero_copy_only=False)]
                row, term, tf = find(b.column("rasgos").filter(mine), terms)
                sums = total.setdefault(name, np.zeros((2, *idf.shape)))
                for c, own in enumerate(outside):
                    x = tf * idf[term, c]
                    x[np.isnan(x)] = 0.0
                    length = np.sqrt(np.bincount(row, x * x, minlength=len(y)))
                    unit = x / np.where(length > 0, length, 1.0)[row]
                    for k in (0, 1):
                        fits = ((y == k) & ((own < 0) | (f >= 0) & (f != own)))[row]
                        sums[k, :, c] += np.bincount(term[fits], unit[fits], minlength=len(idf))
        for name, sums in total.items():
            terms, idf, outside = tables[name]
            hit = np.flatnonzero(sums.any(axis=(0, 2)))
            flat = [pa.array(sums[k, hit, c]) for k in (0, 1) for c in range(len(outside))]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(hit), pa.string()), terms.take(pa.array(hit)), *flat],
                                             ["modelo", "term", *[f"_{k}_{c}" for k in (0, 1) for c in range(len(outside))]])

    return add


def mail_adder(sent) -> Callable:
    """Batches of (_row, modelo, rasgos) -> (_row, squares, products): sums over the known terms of a mail.

    ``sent`` is a broadcast of model -> (terms, idf per term and column, weights per term, column and kind); a square is the sum
    of ((1 + ln cnt) * idf) ** 2 in a column, a product that of (1 + ln cnt) * idf * weight.
    """
    find = finder()

    def add(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        tables = sent.value
        columns, kinds = next((w.shape[1:] for _, _, w in tables.values()), (0, 0))
        names = [f"_q{c}" for c in range(columns)] + [f"_d{c}_{k}" for c in range(columns) for k in range(kinds)]
        for b in batches:
            out = np.zeros((len(names), b.num_rows))
            for name in {*b.column("modelo").to_pylist()} & tables.keys():
                terms, idf, weights = tables[name]
                mine = pc.equal(b.column("modelo"), name)
                at = np.flatnonzero(mine.to_numpy(zero_copy_only=False))
                row, term, tf = find(b.column("rasgos").filter(mine), terms)
                for c in range(columns):
                    x = tf * idf[term, c]
                    x[np.isnan(x)] = 0.0
                    out[c, at] = np.bincount(row, x * x, minlength=len(at))
                    for k in range(kinds):
                        w = weights[term, c, k]
                        out[columns + c * kinds + k, at] = np.bincount(row, x * np.where(np.isnan(w), 0.0, w), minlength=len(at))
            yield pa.RecordBatch.from_arrays([b.column("_row"), *[pa.array(v) for v in out]], ["_row", *names])

    return add


def term_numbers(sent) -> Callable:
    """Batches of (_row, modelo, rasgos) -> (_row, celdas): numbers and counts of the known terms of a mail, none for other models.

    ``sent`` is a broadcast of model -> (terms, their numbers).
    """
    cut = cutter(SLICE // 4)

    def cells(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        tables = sent.value
        for b in batches:
            models = np.array(b.column("modelo").to_pylist(), object)
            for name in dict.fromkeys(models):
                terms, numbers = tables.get(name, (pa.array([], pa.string()), np.zeros(0)))
                mine = b.take(pa.array(np.flatnonzero(models == name)))
                for a, z in cut(pc.fill_null(pc.list_value_length(mine.column("rasgos")), 0).to_pylist()):
                    rasgos = mine.column("rasgos").slice(a, z - a)
                    flat, of = rasgos.flatten(), pc.list_parent_indices(rasgos).to_numpy()
                    term = pc.index_in(flat.field("term"), value_set=terms)
                    hit = term.is_valid()
                    i = numbers[term.filter(hit).to_numpy()].astype("i4")
                    found = pa.StructArray.from_arrays([pa.array(i), flat.field("cnt").filter(hit).cast(pa.int64())], ["i", "cnt"])
                    ends = np.append(0, np.cumsum(np.bincount(of[hit.to_numpy(zero_copy_only=False)], minlength=z - a))).astype("i4")
                    yield pa.RecordBatch.from_arrays([mine.column("_row").slice(a, z - a), pa.ListArray.from_arrays(pa.array(ends), found)],
                                                     ["_row", "celdas"])

    return cells


def known_words() -> type:
    """The class of the terms of a model as numbers of their words."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    class KnownWords:
        """Looks the words and pairs of texts up by number; words of ``stop`` are numbered as well."""

        def __init__(self, terms, stop):
            self.terms, self.stop = terms, stop
            parts = [t.split(" ") for t in self.terms]
            words = sorted({w for p in parts for w in p} | self.stop)
            number = {w: i for i, w in enumerate(words)}
            self.words, self.wide = pa.array(words, pa.string()), max(len(words), 1)
            self.alone = np.full(self.wide + 1, -1)       # the last one stands for a word that is not known
            self.stops = np.zeros(self.wide + 1, bool)
            self.stops[np.array([number[w] for w in self.stop], int)] = True
            pairs = []
            for t, p in enumerate(parts):
                if len(p) == 1:
                    self.alone[number[p[0]]] = t
                elif len(p) == 2:
                    pairs.append((number[p[0]] * self.wide + number[p[1]], t))
            pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)
            self.keys, self.of = pairs[:, 0].copy(), pairs[:, 1].copy()
            self.opens, self.ends = np.zeros(self.wide + 1, bool), np.zeros(self.wide + 1, bool)
            self.opens[self.keys // self.wide] = True
            self.ends[self.keys % self.wide] = True

        def numbered(self, texts):
            """(row, word number or -1, length) of every blank-separated piece."""
            lists = pc.split_pattern(texts, " ")
            flat = lists.flatten()
            ids = pc.fill_null(pc.index_in(flat, value_set=self.words), -1).to_numpy()
            row = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
            return row, ids, pc.utf8_length(flat).to_numpy()

        def hits(self, row, ids, pairs):
            """(row * terms + term) of every known word and pair."""
            t = self.alone[ids]
            found = [row[t >= 0] * len(self.terms) + t[t >= 0]]
            if pairs and len(self.keys):
                a, b = ids[:-1], ids[1:]
                near = np.flatnonzero((row[1:] == row[:-1]) & self.opens[a] & self.ends[b])
                key = a[near].astype(np.int64) * self.wide + b[near]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                found.append(row[near[hit]] * len(self.terms) + self.of[at[hit]])
            return np.concatenate(found)

    return KnownWords


def mail_cells(sent, rules: dict) -> Callable:
    """Batches of (modelo, message_id, texto_procesado) -> (modelo, message_id, i, cnt, norma, masa) of mails with known terms.

    ``sent`` is a broadcast of model -> (terms, idf); ``rules`` has the stop words and the longest n-gram of a model, the key
    None those of all others.  The numbers and counts of a mail's terms are bytes; ``norma`` is the length of
    (1 + ln cnt) * idf, ``masa`` their sum in a mail of unit length.
    """
    cut, known = cutter(SLICE), known_words()

    def cells(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        tables, numbered = sent.value, {}
        for b in batches:
            for name in sorted({*b.column("modelo").to_pylist()} & tables.keys()):
                stop, upto = rules.get(name, rules.get(None))
                terms, idf = tables[name]
                if name not in numbered:
                    numbered[name] = known(terms, stop)
                mine = b.filter(pc.equal(b.column("modelo"), name))
                texts = pc.fill_null(mine.column("texto_procesado"), "")
                for a, z in cut(pc.binary_length(texts).to_pylist()):
                    row, ids, length = numbered[name].numbered(pa.concat_arrays([texts.slice(a, z - a)]))
                    keep = (length >= 2) & ~numbered[name].stops[ids]
                    found, cnt = np.unique(numbered[name].hits(row[keep], ids[keep], upto == 2), return_counts=True)
                    mail, term = np.divmod(found, max(len(terms), 1))
                    x = (1.0 + np.log(cnt)) * idf[term]
                    norm, mass = (np.sqrt(np.bincount(mail, x * x, minlength=z - a)), np.bincount(mail, x, minlength=z - a))
                    ends = np.append(0, np.cumsum(np.bincount(mail, minlength=z - a)))
                    hit = np.flatnonzero(np.diff(ends))
                    i, n = term.astype("<i4"), cnt.astype("<i4")
                    yield pa.RecordBatch.from_arrays(
                        [mine.column(c).slice(a, z - a).take(pa.array(hit)) for c in ("modelo", "message_id")]
                        + [pa.array([v[ends[h]:ends[h + 1]].tobytes() for h in hit], pa.binary()) for v in (i, n)]
                        + [pa.array(norm[hit]), pa.array(mass[hit] / norm[hit])],
                        ["modelo", "message_id", "i", "cnt", "norma", "masa"])

    return cells


def mail_scorer(sent, rules: dict, explain: bool, k: int) -> Callable:
    """Batches of (_row, modelo, texto_procesado) -> (_row, p_spam, strongest terms of spam and of ham).

    ``sent`` is a broadcast of (model -> (sorted terms, idf, weight, rounded weight), model -> bias); ``rules`` has the stop
    words and the longest n-gram of a model; the key None stands for all other models.  Words and pairs are numbers
    inside a batch; explanations look at all words.
    """
    cut, words = cutter(SLICE), known_words()

    def score(batches):
        import re

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        weights, bias = sent.value
        word = re.compile("[a-záéíóúñü0-9_]+")
        grams = pa.list_(pa.struct([("term", pa.string()), ("peso", pa.float64())]))

        class Known(words):
            """The terms of a model with their weights and ranks."""

            def __init__(self, name):
                stop, self.upto = rules.get(name, rules.get(None))
                terms, self.idf, self.w, self.peso = weights.get(name, ([], *[np.zeros(0)] * 3))
                super().__init__(terms, stop)
                self.ranks = {}
                for sign in (1, -1):
                    order = np.lexsort((np.arange(len(terms)), -sign * self.peso))
                    self.ranks[sign] = order, np.argsort(order)

        def strongest(known, cells, n, sign):
            size = max(len(known.terms), 1)
            row, term = np.divmod(cells, size)
            use = known.peso[term] * sign > 0
            order, rank = known.ranks[sign]
            row, place = np.divmod(np.sort(row[use] * size + rank[term[use]]), size)
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            row, term = row[nth < k], order[place[nth < k]]
            ends = np.append(0, np.cumsum(np.bincount(row, minlength=n)))
            values = pa.array([known.terms[t] for t in term], pa.string()), pa.array(known.peso[term], pa.float64())
            return ends, values

        def one_model(known, base, texts):
            """(p_spam, spam, ham) of the mails of one model."""
            n, size = len(texts), max(len(known.terms), 1)
            row, ids, length = known.numbered(texts)
            keep = (length >= 2) & ~known.stops[ids]
            cells, times = np.unique(known.hits(row[keep], ids[keep], known.upto == 2), return_counts=True)
            mail, term = np.divmod(cells, size)
            x = (1.0 + np.log(times)) * known.idf[term]
            dot, square = np.bincount(mail, x * known.w[term], minlength=n), np.bincount(mail, x * x, minlength=n)
            margin = base + np.divide(dot, np.sqrt(square), out=np.zeros(n), where=square > 0)
            p = 1.0 / (1.0 + np.exp(-np.maximum(margin, -700.0)))
            if not explain:
                return p, [None] * n, [None] * n
            odd = np.flatnonzero(~pc.match_substring_regex(texts, r"\A[a-záéíóúñü0-9_ ]*\z").to_numpy(zero_copy_only=False))
            if len(odd):
                plain = texts.to_pylist()
                for i in odd:
                    plain[i] = " ".join(word.findall(plain[i].lower()))
                row, ids, length = known.numbered(pa.array(plain, pa.string()))
            cells = np.unique(known.hits(row[length > 0], ids[length > 0], True))
            out = []
            for sign in (1, -1):
                ends, (term, peso) = strongest(known, cells, n, sign)
                rows = pa.StructArray.from_arrays([term, peso], ["term", "peso"])
                out.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), rows))
            return p, *out

        tables = {}
        for b in batches:
            texts = pc.fill_null(b.column("texto_procesado"), "")
            for a, z in cut(pc.binary_length(texts).to_pylist()):
                names = np.array(b.column("modelo").slice(a, z - a).to_pylist(), object)
                here, parts, order = pa.concat_arrays([texts.slice(a, z - a)]), [], []
                for name in dict.fromkeys(names):
                    if name not in tables:
                        tables[name] = Known(name)
                    mine = np.flatnonzero(names == name)
                    order.append(mine)
                    parts.append(one_model(tables[name], bias.get(name, bias.get(None)), here.take(pa.array(mine))))
                back = pa.array(np.argsort(np.concatenate(order)))
                whole = [pa.concat_arrays([pa.array(p[i], kind) if isinstance(p[i], (list, np.ndarray)) else p[i].cast(kind) for p in parts]).take(back)
                         for i, kind in enumerate((pa.float64(), grams, grams))]
                yield pa.RecordBatch.from_arrays([b.column("_row").slice(a, z - a), *whole], ["_row", "p_spam", "_spam", "_ham"])

    return score
