"""Building blocks of the DuckDB check queries (test support only)."""

from __future__ import annotations

import re

from cartero.functions import lexicons as lx


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def sql_map(table: dict) -> str:
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in table.items()) + "}"


def pick(values, ident="message_id") -> str:
    values = list(values)
    return f"{sql_list(values)}[CAST({ident} % {len(values)} AS INT) + 1]"


def h(ident: str, seed="42") -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({ident} AS VARCHAR)), 1, 8))::BIGINT"


def half_up(e: str, n: int) -> str:
    """Round half up on the decimal form of a double."""
    return f"CAST(round(CAST(CAST({e} AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


def strip(e: str) -> str:
    return rf"regexp_replace({e}, '^\s+|\s+$', '', 'g')"


def signals(e: str) -> str:
    word = r"(^|[^\p{L}\p{N}_])(?:usd|eur|dolares|dollars|pesos)($|[^\p{L}\p{N}_])"
    e = rf"regexp_replace({e}, 'https?://\S+|www\.\S+', ' tokenurl ', 'gi')"
    e = rf"regexp_replace({e}, '\S+@\S+', ' tokenemail ', 'g')"
    for _ in range(2):
        e = rf"regexp_replace({e}, '{word}', '\1 tokendinero \2', 'gi')"
    e = rf"regexp_replace({e}, '[$€£]', ' tokendinero ', 'g')"
    e = rf"regexp_replace({e}, '!+', ' tokenexclam ', 'g')"
    return rf"regexp_replace({e}, '\d+', ' tokennumero ', 'g')"


def charset(e: str) -> str:
    return f"trim(regexp_replace(lower({e}), '[^a-z0-9áéíóúñü_]+', ' ', 'g'))"


def blank_words(e: str, table: dict) -> str:
    return (f"array_to_string(list_transform(string_split({e}, ' '), "
            f"lambda w: coalesce({sql_map(table)}[w], w)), ' ')")


def any_words(e: str, table: dict, fold=False) -> str:
    key = "lower(w)" if fold else "w"
    return (f"array_to_string(list_transform(regexp_extract_all({e}, '[\\p{{L}}\\p{{N}}\\p{{M}}_]+|[^\\p{{L}}\\p{{N}}\\p{{M}}_]+'), "
            f"lambda w: coalesce({sql_map(table)}[{key}], w)), '')")


def clean(e: str) -> str:
    return blank_words(charset(signals(f"coalesce({e}, '')")), {**lx.ABBREVIATIONS, **lx.TYPOS})


def phrases(e: str, table: dict, fold=False) -> str:
    for p in sorted(table, key=len, reverse=True):
        e = rf"regexp_replace({e}, '\b{p}\b', {q(table[p])}, '{'gi' if fold else 'g'}')"
    return e


def lexical(e: str) -> str:
    body = phrases(f"lower(coalesce({e}, ''))", lx.PHRASES)
    return (f"array_to_string(list_transform(regexp_extract_all({body}, '[a-z0-9áéíóúñü_]+'), "
            f"lambda w: coalesce({sql_map(lx.GLOSSARY)}[w], w)), ' ')")


def expand_lexical(e: str) -> str:
    return lexical(any_words(f"lower(coalesce({e}, ''))", {**lx.ABBREVIATIONS, **lx.TYPOS}))


def residual(e: str) -> str:
    e = any_words(phrases(f"coalesce({e}, '')", lx.RESIDUAL_PHRASES, True), lx.RESIDUAL_WORDS, True)
    for second, whole in lx.SIGNAL_TOKEN_GLUE:
        e = rf"regexp_replace({e}, '\btoken\s*{second}\b', '{whole}', 'gi')"
    return e


def words(e: str) -> str:
    return rf"list_filter(regexp_split_to_array({e}, '\s+'), lambda w: w <> '')"


def pack(e: str, limit: int) -> str:
    fold = (f"list_reduce({e}, lambda a, x: CASE WHEN a.o IS NULL THEN {{'d': a.d, 'o': x}} "
            f"WHEN length(a.o) + 1 + length(x) <= {limit} THEN {{'d': a.d, 'o': a.o || ' ' || x}} "
            f"ELSE {{'d': list_append(a.d, a.o), 'o': x}} END, "
            f"{{'d': CAST([] AS VARCHAR[]), 'o': CAST(NULL AS VARCHAR)}})")
    return f"list_transform([{fold}], lambda pk: CASE WHEN pk.o IS NULL THEN pk.d ELSE list_append(pk.d, pk.o) END)[1]"


def segment(e: str, limit: int = 500) -> str:
    """``e`` must be stripped already."""
    parts = rf"string_split(regexp_replace({e}, '([.!?\n;:])\s+', '\1' || chr(1), 'g'), chr(1))"
    sentences = f"list_filter(list_transform({parts}, lambda s: {strip('s')}), lambda s: s <> '')"
    pieces = (f"flatten(list_transform({sentences}, lambda s: CASE WHEN length(s) <= {limit} THEN [s] "
              f"ELSE {pack(words('s'), limit)} END))")
    return (f"CASE WHEN {e} = '' THEN CAST([] AS VARCHAR[]) WHEN length({e}) <= {limit} THEN [{e}] "
            f"ELSE {pack(pieces, limit)} END")


def tokens(e: str, stop) -> str:
    stop = [w for w in stop if re.fullmatch(r"\w\w+", w)]
    return (f"list_filter(string_split({e}, ' '), lambda t: length(t) >= 2 AND "
            f"NOT list_contains({sql_list(sorted(set(stop)))}, t))")


def grams(e: str) -> str:
    """Unigrams and adjacent pairs of a token list expression (a column name)."""
    return (f"list_concat({e}, list_transform(range(1, greatest(len({e}), 1)), "
            f"lambda i: {e}[i] || ' ' || {e}[i + 1]))")


def nb(p: str, src: str, k: int = 20_000, alpha: float = 0.1) -> dict[str, str]:
    """Tables of one Naive Bayes run over ``src(modelo, message_id, y, tr, terms)``."""
    a = f"{alpha!r}::DOUBLE"
    return {
        f"{p}_c": f"SELECT modelo, message_id, y, tr, term, count(*) AS cnt FROM (SELECT modelo, message_id, y, tr, "
                  f"unnest(terms) AS term FROM {src}) GROUP BY ALL",
        f"{p}_n": f"SELECT modelo, count(*) AS n FROM {src} WHERE tr GROUP BY 1",
        f"{p}_v": f"SELECT modelo, term, total, df, ln((1e0 + n) / (1e0 + df)) + 1e0 AS idf, rango FROM (SELECT modelo, term, "
                  f"CAST(sum(cnt) AS BIGINT) AS total, count(*) AS df, row_number() OVER (PARTITION BY modelo ORDER BY sum(cnt) DESC, term) AS rango "
                  f"FROM {p}_c WHERE tr GROUP BY 1, 2) JOIN {p}_n USING (modelo) WHERE rango <= {k}",
        f"{p}_x": f"SELECT modelo, message_id, y, tr, term, (1e0 + ln(cnt)) * idf AS x FROM {p}_c JOIN {p}_v USING (modelo, term)",
        f"{p}_l": f"SELECT modelo, message_id, sqrt(sum(x * x)) AS l FROM {p}_x GROUP BY 1, 2",
        f"{p}_w": f"SELECT v.modelo, v.term, v.idf, coalesce(wh, 0e0) AS w_ham, coalesce(ws, 0e0) AS w_spam FROM {p}_v v LEFT JOIN ("
                  f"SELECT modelo, term, sum(CASE WHEN y = 0 THEN x / l ELSE 0e0 END) AS wh, sum(CASE WHEN y = 1 THEN x / l ELSE 0e0 END) AS ws "
                  f"FROM {p}_x JOIN {p}_l USING (modelo, message_id) WHERE tr GROUP BY 1, 2) s ON s.modelo = v.modelo AND s.term = v.term",
        f"{p}_k": f"SELECT modelo, term, idf, ln((w_ham + {a}) / (sum(w_ham) OVER m + {a} * count(*) OVER m)) AS lp_ham, "
                  f"ln((w_spam + {a}) / (sum(w_spam) OVER m + {a} * count(*) OVER m)) AS lp_spam FROM {p}_w WINDOW m AS (PARTITION BY modelo)",
        f"{p}_b": f"SELECT modelo, ln(count(*) FILTER (WHERE y = 1) / CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE)) AS sesgo "
                  f"FROM {src} WHERE tr GROUP BY 1",
        f"{p}_p": f"SELECT s.modelo, s.message_id, s.y, s.tr, 1e0 / (1e0 + exp(-(sesgo + coalesce(dot / sqrt(sq), 0e0)))) AS p "
                  f"FROM {src} s JOIN {p}_b USING (modelo) LEFT JOIN (SELECT modelo, message_id, sum(x * (lp_spam - lp_ham)) AS dot, "
                  f"sum(x * x) AS sq FROM {p}_x JOIN {p}_k USING (modelo, term) GROUP BY 1, 2) t "
                  f"ON t.modelo = s.modelo AND t.message_id = s.message_id",
    }


def metrics(src: str, ranking: bool = True) -> str:
    """Metric row per model of ``src(modelo, y, p, pred)``."""
    base = (f"SELECT modelo, count(*) AS n, round((tp + tn) / CAST(count(*) AS DOUBLE), 4) AS accuracy, "
            f"coalesce(round(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 4), 0e0) AS precision, "
            f"coalesce(round(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 4), 0e0) AS recall, "
            f"coalesce(round(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 4), 0e0) AS f1 "
            f"FROM {src} JOIN (SELECT modelo, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn, "
            f"count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn FROM {src} GROUP BY 1) USING (modelo) "
            f"GROUP BY modelo, tp, tn, fp, fn")
    return f"SELECT * FROM ({base}) JOIN ({rank_metrics(src)}) USING (modelo)" if ranking else base


def cumulative(src: str) -> str:
    return (f"SELECT modelo, p, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER m AS np, sum(neg) OVER m AS nn FROM ("
            f"SELECT modelo, p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM {src} GROUP BY 1, 2) "
            f"WINDOW w AS (PARTITION BY modelo ORDER BY p DESC ROWS UNBOUNDED PRECEDING), m AS (PARTITION BY modelo)")


def rank_metrics(src: str) -> str:
    return (f"SELECT modelo, round(CASE WHEN any_value(np) > 0 AND any_value(nn) > 0 THEN sum(neg * (tp - pos / 2e0)) / "
            f"CAST(any_value(np) * any_value(nn) AS DOUBLE) ELSE 0e0 END, 4) AS roc_auc, "
            f"round(CASE WHEN any_value(np) > 0 AND any_value(nn) > 0 THEN sum(pos * tp / CAST(tp + fp AS DOUBLE)) / any_value(np) "
            f"ELSE 0e0 END, 4) AS pr_auc FROM ({cumulative(src)}) GROUP BY 1")
