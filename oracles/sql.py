"""DuckDB SQL for every query that SQL can state (test support only)."""

from __future__ import annotations

import re

from cartero.functions import lexicons as lx
from cartero.operators.score import GREY_ZONE, ROUTE_EN, ROUTE_ES, TOO_SHORT, UNCERTAIN
from cartero.plans.queries import SPECS
from oracles import fragments as f

EN, ES = lx.STOP_WORDS_EN, lx.STOP_WORDS_ES
CTES: dict[str, str] = {}
BODY: dict[str, str] = {}

# ------------------------------------------------------------------ base tables
CTES["docs"] = "SELECT doc_id AS message_id, text, lang, source FROM documents"
CTES["raw"] = f"""
SELECT message_id, CASE WHEN contains(text, chr(10)) THEN substr(text, instr(text, chr(10)) + 1) ELSE text END AS text,
       label, CASE message_id % 4 WHEN 0 THEN CAST(label AS VARCHAR) WHEN 1 THEN upper(nm)
              WHEN 2 THEN CASE WHEN label IS NOT NULL THEN 'otro' END ELSE nm END AS label_text,
       CASE WHEN contains(text, chr(10)) THEN substr(text, 1, instr(text, chr(10)) - 1) END AS subject,
       CAST(NULL AS VARCHAR) AS date, CASE WHEN {f.h('message_id', 'split')} % 5 = 0 THEN 'test' ELSE 'train' END AS split,
       source AS fuente, lang
FROM (SELECT d.*, 1 - quality AS label, CASE 1 - quality WHEN 1 THEN 'spam' WHEN 0 THEN 'ham' END AS nm
      FROM docs d LEFT JOIN labels l ON l.doc_id = d.message_id)"""
CTES["norm"] = """
SELECT *, CASE Category WHEN 'ham' THEN 0 WHEN 'spam' THEN 1 END AS y FROM (
  SELECT *, coalesce(CASE lower(label_text) WHEN '0' THEN 'ham' WHEN 'ham' THEN 'ham' WHEN '1' THEN 'spam' WHEN 'spam' THEN 'spam' END,
                     CASE label WHEN 0 THEN 'ham' WHEN 1 THEN 'spam' END) AS Category FROM raw)"""
CTES["valid"] = "SELECT * FROM norm WHERE text IS NOT NULL AND Category IS NOT NULL"
CTES["dedup"] = "SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY text ORDER BY message_id) = 1"
CTES["corpus"] = """
SELECT * EXCLUDE (text), substr(text, 1, 10000) AS msg, least(length(text), 10000) AS longitud_correo,
       CASE WHEN length(text) > 10000 THEN 1 ELSE 0 END AS truncado FROM dedup WHERE length(text) > 5"""
CTES["whole"] = "SELECT *, text AS msg, length(text) AS longitud_correo FROM dedup WHERE length(text) > 5"
_subject_body = "coalesce(subject, '') || ' ' || "
CTES["nlp"] = f"SELECT * FROM (SELECT *, {f.clean(_subject_body + 'msg')} AS clean_en FROM whole) WHERE length(clean_en) > 5"


def ranked(src: str, seed="42") -> str:
    return (f"SELECT *, row_number() OVER (PARTITION BY Category ORDER BY {f.h('message_id', seed)}, message_id) AS r, "
            f"count(*) OVER (PARTITION BY Category) AS nc, count(*) OVER () AS na FROM {src}")


CTES["split2"] = f"SELECT *, CASE WHEN r <= round_even(0.8e0 * nc, 0) THEN 'train' ELSE 'test' END AS parte FROM ({ranked('nlp')})"
CTES["split3"] = (f"SELECT *, CASE WHEN r <= round_even(0.64e0 * nc, 0) THEN 'fit' WHEN r <= round_even(0.8e0 * nc, 0) THEN 'val' "
                  f"ELSE 'test' END AS parte FROM ({ranked('nlp')})")


def terms(src: str, cols: str, text: str, stop, ngram: int) -> str:
    body = f"SELECT {cols}, {f.tokens(text, stop)} AS tk FROM {src}"
    return f"SELECT * EXCLUDE (tk), {f.grams('tk') if ngram == 2 else 'tk'} AS terms FROM ({body})"


# -------------------------------------------------------- experiments (one each)
CTES["ex"] = terms("split2", "'en' AS modelo, message_id, y, parte, parte = 'train' AS tr", "clean_en", EN, 2)
CTES.update(f.nb("ex", "ex"))
CTES["ex6"] = "SELECT modelo, message_id, y, tr, round(p, 6) AS p, CASE WHEN round(p, 6) >= 0.5 THEN 1 ELSE 0 END AS pred FROM ex_p"
CTES["ex6t"] = "SELECT * FROM ex6 WHERE NOT tr"
CTES["al"] = terms("nlp", "'en' AS modelo, message_id, y, true AS tr", "clean_en", EN, 2)
CTES.update(f.nb("al", "al", 10_000))
CTES["va"] = terms("split3", "'en' AS modelo, message_id, y, parte, parte = 'fit' AS tr", "clean_en", EN, 2)
CTES.update(f.nb("va", "va"))
CTES["val6"] = "SELECT s.modelo, s.y, round(p, 6) AS p FROM va_p s JOIN va USING (message_id) WHERE parte = 'val'"


def sweep(src: str, beta: float, cents) -> str:
    b2 = beta * beta
    return (f"SELECT modelo, c / 100e0 AS umbral, count(*) FILTER (WHERE y = 1 AND p >= c / 100e0) AS tp, "
            f"count(*) FILTER (WHERE y = 0 AND p >= c / 100e0) AS fp, count(*) FILTER (WHERE y = 1 AND p < c / 100e0) AS fn, "
            f"coalesce({1 + b2}e0 * count(*) FILTER (WHERE y = 1 AND p >= c / 100e0) / nullif({1 + b2}e0 * count(*) FILTER (WHERE y = 1 AND p >= c / 100e0) "
            f"+ {b2}e0 * count(*) FILTER (WHERE y = 1 AND p < c / 100e0) + count(*) FILTER (WHERE y = 0 AND p >= c / 100e0), 0), 0e0) AS fbeta "
            f"FROM {src}, (SELECT unnest({list(cents)}) AS c) GROUP BY modelo, c")


def best_threshold(src: str, beta: float, cents) -> str:
    return f"SELECT modelo, umbral, fbeta FROM ({sweep(src, beta, cents)}) QUALIFY row_number() OVER (PARTITION BY modelo ORDER BY round(fbeta, 9) DESC, umbral) = 1"


C50, C80 = range(20, 86, 5), range(20, 81, 5)

# served models: English and Spanish, trained on the whole labelled corpus
CTES["nlp_es"] = f"SELECT *, {f.lexical('clean_en')} AS texto_es FROM nlp"
CTES["sv"] = (terms("nlp", "'en' AS modelo, message_id, y, true AS tr", "clean_en", EN, 2) + " UNION ALL "
              + terms("nlp_es", "'es' AS modelo, message_id, y, true AS tr", "texto_es", ES, 1))
CTES["routed"] = f"""
SELECT message_id, text, lang, CASE WHEN lang = 'en' THEN 'en' ELSE 'es' END AS modelo,
       CASE lang WHEN 'en' THEN {f.q(ROUTE_EN)} WHEN 'es' THEN {f.q(ROUTE_ES)} ELSE 'Español (Detectado ' || upper(lang) || ', Traducido a ES)' END AS idioma_modelo,
       {f.clean('src')} AS texto_procesado
FROM (SELECT *, CASE WHEN lang IN ('en', 'es') THEN text ELSE {f.expand_lexical('text')} END AS src FROM wld)"""
CTES["rt"] = (terms("(SELECT * FROM routed WHERE modelo = 'en')", "modelo, message_id", "texto_procesado", EN, 2) + " UNION ALL "
              + terms("(SELECT * FROM routed WHERE modelo = 'es')", "modelo, message_id", "texto_procesado", ES, 1))
CTES.update({k: v for k, v in f.nb("sv", "sv").items() if k != "sv_p"})
CTES["rt_p"] = """
SELECT r.*, round(1e0 / (1e0 + exp(-(sesgo + coalesce(dot / sqrt(sq), 0e0)))), 9) AS p, CASE modelo WHEN 'en' THEN 0.75e0 ELSE 0.65e0 END AS umbral
FROM routed r JOIN sv_b USING (modelo) LEFT JOIN (
  SELECT message_id, sum((1e0 + ln(cnt)) * idf * (lp_spam - lp_ham)) AS dot, sum(((1e0 + ln(cnt)) * idf) ** 2) AS sq FROM (
    SELECT modelo, message_id, term, count(*) AS cnt FROM (SELECT modelo, message_id, unnest(terms) AS term FROM rt) GROUP BY ALL)
  JOIN sv_k USING (modelo, term) GROUP BY 1) USING (message_id)"""
_short, _grey = TOO_SHORT.replace("%d", "{}"), GREY_ZONE.replace("%.3f", "{:.3f}").replace("%.2f", "{:.2f}")
CTES["pr"] = f"""
SELECT *, CASE WHEN es_incierto THEN {f.q(UNCERTAIN)} ELSE etiqueta_tentativa END AS etiqueta,
       CASE WHEN nt <= 4 THEN format({f.q(_short)}, nt) WHEN es_incierto THEN format({f.q(_grey)}, p, umbral) ELSE '' END AS motivo
FROM (SELECT *, CASE WHEN p >= umbral THEN 'SPAM' ELSE 'HAM' END AS etiqueta_tentativa, nt <= 4 OR abs(p - umbral) < 0.15e0 AS es_incierto
      FROM (SELECT *, len(list_filter(string_split(texto_procesado, ' '), lambda t: length(t) > 1)) AS nt FROM rt_p))"""
CTES["bank"] = """SELECT pr.*, upper(Category) AS esperada, CASE WHEN etiqueta_tentativa = upper(Category) THEN 'PASS' ELSE 'FAIL' END AS resultado
FROM pr JOIN (SELECT message_id, Category FROM valid) USING (message_id)"""


def explained(src: str, weights: str, text: str) -> str:
    found = f"SELECT modelo, message_id, regexp_extract_all(lower({text}), '[a-záéíóúñü0-9_]+') AS tk FROM {src}"
    flat = f"SELECT DISTINCT modelo, message_id, unnest({f.grams('tk')}) AS term FROM ({found})"
    hits = f"SELECT message_id, term, peso FROM ({flat}) JOIN (SELECT modelo, term, round(lp_spam - lp_ham, 9) AS peso FROM {weights}) USING (modelo, term)"
    sides = [f"SELECT message_id, string_agg(format('{{}} ({plus}{{:.2f}})', term, peso), ' | ' ORDER BY peso {direction}, term) AS {name} FROM "
             f"(SELECT * FROM ({hits}) WHERE peso {cond} 0 QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY peso {direction}, term) <= 6) GROUP BY 1"
             for name, cond, direction, plus in (("tokens_spam", ">", "DESC", "+"), ("tokens_ham", "<", "ASC", ""))]
    return (f"SELECT message_id, coalesce(tokens_spam, '') AS tokens_spam, coalesce(tokens_ham, '') AS tokens_ham FROM {src} "
            f"LEFT JOIN ({sides[0]}) USING (message_id) LEFT JOIN ({sides[1]}) USING (message_id)")


# model comparison
CTES["split3_frag"] = f"SELECT * EXCLUDE (b), {f.clean(f.residual('b'))} AS texto_es FROM (SELECT *, array_to_string(list_transform({f.segment('clean_en')}, lambda z: {f.lexical('z')}), ' ') AS b FROM split3)"
CTES["split3_es"] = f"SELECT *, {f.lexical('clean_en')} AS texto_es FROM split3"
_c3 = "message_id, y, parte"
CTES["mc3"] = (terms("split3", f"'en' AS modelo, {_c3}", "clean_en", EN, 2) + " UNION ALL " + terms("split3_es", f"'es_lex' AS modelo, {_c3}", "texto_es", ES, 1)
               + " UNION ALL " + terms("split3_frag", f"'es_frag' AS modelo, {_c3}", "texto_es", ES, 1))
CTES["mca"] = "SELECT *, parte = 'fit' AS tr FROM mc3"
CTES.update(f.nb("mca", "mca"))
CTES["mcb"] = "SELECT *, parte <> 'test' AS tr FROM mc3"
CTES.update(f.nb("mcb", "mcb"))
CTES["mcv"] = "SELECT s.modelo, s.y, round(p, 6) AS p FROM mca_p s JOIN mca m ON m.modelo = s.modelo AND m.message_id = s.message_id WHERE parte = 'val'"
CTES["mct"] = best_threshold("mcv", 0.5, C50)
CTES["mcp"] = "SELECT modelo, y, round(p, 6) AS p, umbral, CASE WHEN round(p, 6) >= umbral THEN 1 ELSE 0 END AS pred FROM mcb_p JOIN mct USING (modelo) WHERE NOT tr"

# held-out evaluation
CTES["hs"] = f"""
SELECT message_id, Category, CASE Category WHEN 'ham' THEN 0 ELSE 1 END AS y, true AS tr, {f.clean(_subject_body + 'text')} AS clean_en
FROM (SELECT * FROM valid WHERE split = 'train' QUALIFY row_number() OVER (PARTITION BY text ORDER BY message_id) = 1) WHERE length(text) > 5"""
CTES["ho"] = f"""
SELECT * FROM (SELECT * FROM hs UNION ALL
  SELECT message_id, Category, coalesce(label, y) AS y, false AS tr, {f.clean(_subject_body + 'text')} AS clean_en
  FROM valid WHERE split = 'test' AND length(text) > 5) WHERE length(clean_en) > 5"""
CTES["ho_es"] = f"SELECT *, {f.lexical('CASE WHEN tr THEN clean_en ELSE substr(clean_en, 1, 600) END')} AS texto_es FROM ho"
CTES["ho_r"] = f"SELECT message_id, CASE WHEN r <= round_even(0.8e0 * nc, 0) THEN 'fit' ELSE 'val' END AS parte FROM ({ranked('(SELECT * FROM ho WHERE tr)')})"
CTES["hxf"] = "SELECT hx.* EXCLUDE (tr), parte, parte = 'fit' AS tr FROM hx JOIN ho_r USING (message_id) WHERE tr"
CTES.update(f.nb("hxf", "hxf"))
CTES["hxv"] = "SELECT s.modelo, s.y, round(p, 6) AS p FROM hxf_p s WHERE NOT tr"
CTES["hxt"] = best_threshold("hxv", 0.5, C50)
CTES["hxm"] = "SELECT modelo, y, p, CASE WHEN p >= umbral THEN 1 ELSE 0 END AS pred FROM hxv JOIN hxt USING (modelo)"
CTES["hx"] = (terms("ho", "'en_heldout' AS modelo, message_id, y, tr", "clean_en", EN, 2) + " UNION ALL "
              + terms("ho_es", "'es_heldout' AS modelo, message_id, y, tr", "texto_es", ES, 1))
CTES.update(f.nb("hx", "hx"))
CTES["hxp"] = "SELECT modelo, y, round(p, 6) AS p, CASE WHEN round(p, 6) >= umbral THEN 1 ELSE 0 END AS pred FROM hx_p JOIN hxt USING (modelo) WHERE NOT tr"

# folds
_fold = "CASE WHEN r <= round_even({0!r}::DOUBLE * nc, 0) THEN 0 WHEN r <= round_even({1!r}::DOUBLE * nc, 0) THEN 1 ELSE 2 END"
_fold = _fold.format(1.0 / 3, 1.0 / 3 + 1.0 / 3)
for _r in (0, 1):
    CTES[f"fold{_r}"] = f"SELECT *, {_fold} AS pliegue FROM ({ranked('nlp', f'cv{_r}')})"
CTES["foldg"] = f"SELECT *, {_fold} AS pliegue FROM ({ranked('nlp')})"
CTES["cvt"] = " UNION ALL ".join(terms(f"fold{r}", f"'{r}' AS rep, message_id, y, pliegue", "clean_en", EN, 2) for r in (0, 1))
CTES["cv"] = "SELECT rep || '|' || fd AS modelo, message_id, y, pliegue <> fd AS tr, terms FROM cvt, (SELECT unnest([0, 1, 2]) AS fd)"
CTES.update(f.nb("cv", "cv"))
_f1 = ("coalesce(2 * count(*) FILTER (WHERE y = 1 AND hit) / CAST(nullif(2 * count(*) FILTER (WHERE y = 1 AND hit) + count(*) FILTER (WHERE y = 0 AND hit) "
       "+ count(*) FILTER (WHERE y = 1 AND NOT hit), 0) AS DOUBLE), 0e0)")
CTES["cvf"] = f"SELECT modelo, {_f1} AS f1 FROM (SELECT *, round(p, 9) > 0.5 AS hit FROM cv_p WHERE NOT tr) GROUP BY 1"
CTES["gst"] = " UNION ALL ".join(terms("foldg", f"{n} AS ngram, message_id, y, pliegue", "clean_en", EN, n) for n in (1, 2))
CTES["gs"] = "SELECT ngram || '|' || fd AS modelo, message_id, y, pliegue <> fd AS tr, terms FROM gst, (SELECT unnest([0, 1, 2]) AS fd)"
_gs = []
for _k in (10_000, 15_000, 20_000):
    _run = f.nb(f"gs{_k}", "gs", _k)
    CTES.update({n: s for n, s in _run.items() if n.rsplit("_", 1)[1] not in ("k", "p")})
    for _i, _a in enumerate((0.1, 0.3, 0.5, 1.0)):
        _one = f.nb(f"gs{_k}", "gs", _k, _a)
        _keys = _one[f"gs{_k}_k"]
        _gs.append(f"SELECT modelo, y, {_a}e0 AS alpha, {_k} AS max_features, round(sesgo + coalesce(dot / sqrt(sq), 0e0), 9) > 0 AS hit FROM gs s "
                   f"JOIN gs{_k}_b USING (modelo) LEFT JOIN (SELECT modelo, message_id, sum(x * (lp_spam - lp_ham)) AS dot, sum(x * x) AS sq "
                   f"FROM gs{_k}_x JOIN ({_keys}) USING (modelo, term) WHERE NOT tr GROUP BY 1, 2) t USING (modelo, message_id) WHERE NOT tr")
CTES["gsh"] = " UNION ALL ".join(_gs)
CTES["gsf"] = f"SELECT modelo, alpha, max_features, {_f1} AS f1 FROM gsh GROUP BY 1, 2, 3"

# languages
_lw = f"lower({f.strip('substr(coalesce(text, {e}), 1, 150)')})".replace("{e}", "''")
CTES["lgt"] = f"SELECT message_id, lang, {_lw} AS t FROM docs"
_gr = " UNION ALL ".join(f"SELECT message_id, lang, t, unnest(list_transform(range(1, greatest(length(t) - {n - 1}, 0) + 1), lambda i: substr(t, i, {n}))) AS g FROM lgt"
                         for n in (1, 2, 3))
CTES["lgg"] = _gr
CTES["lgc"] = (f"SELECT lang, g, count(*) AS n FROM lgg WHERE lang IS NOT NULL GROUP BY 1, 2 "
               "QUALIFY row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, g) <= 5000")
CTES["lgs"] = "SELECT lang, sum(n) AS tot, (SELECT count(DISTINCT g) FROM lgc) AS v, CAST(row_number() OVER (ORDER BY lang) AS INT) AS o FROM lgc GROUP BY 1"
CTES["lgp"] = """
SELECT message_id, max_by(lang, struct_pack(s := s, o := o)) AS idioma FROM (
  SELECT d.message_id, l.lang, -l.o AS o,
         round(coalesce(any_value(gain), 0e0) + any_value(coalesce(ng, 0)) * any_value(ln(0.5e0) - ln(tot + 0.5e0 * v)), 6) AS s
  FROM lgt d CROSS JOIN lgs l
  LEFT JOIN (SELECT message_id, count(*) AS ng FROM lgg GROUP BY 1) k ON k.message_id = d.message_id
  LEFT JOIN (SELECT a.message_id, b.lang, sum(ln(b.n + 0.5e0) - ln(0.5e0)) AS gain FROM lgg a JOIN lgc b ON a.g = b.g GROUP BY 1, 2) x
    ON x.message_id = d.message_id AND x.lang = l.lang GROUP BY 1, 2, 3) GROUP BY 1"""
# whole texts, at scoring time
CTES["wlt"] = f"SELECT message_id, text, source, lower({f.strip('text')}) AS t FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM docs)"
_chars = "SELECT message_id, string_split(t, '') AS c FROM wlt WHERE t <> ''"
CTES["wlg"] = "SELECT message_id, g, count(*) AS cnt FROM (" + " UNION ALL ".join(
    f"SELECT message_id, unnest(list_transform(range(1, greatest(len(c) - {n - 1}, 0) + 1), lambda i: {' || '.join(f'c[i + {k}]' for k in range(n))})) AS g FROM ({_chars})"
    for n in (1, 2, 3)) + ") GROUP BY 1, 2"
CTES["wlc"] = ("SELECT lang, g, CAST(sum(cnt) AS BIGINT) AS n FROM wlg JOIN docs USING (message_id) WHERE lang IS NOT NULL GROUP BY 1, 2 "
               "QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sum(cnt) DESC, g) <= 100000")
CTES["wls"] = CTES["lgs"].replace("lgc", "wlc")
CTES["wlp"] = (CTES["lgp"].replace("JOIN lgc", "JOIN wlc").replace("JOIN lgs", "JOIN wls").replace("FROM lgt d", "FROM wlt d").replace("count(*) AS ng FROM lgg", "sum(cnt) AS ng FROM wlg")
               .replace("sum(ln(b.n + 0.5e0) - ln(0.5e0)) AS gain FROM lgg a", "sum(a.cnt * (ln(b.n + 0.5e0) - ln(0.5e0))) AS gain FROM wlg a"))
_hint = f"CASE WHEN len(list_intersect(list_distinct({f.words('lower(text)')}), {f.sql_list(lx.ENGLISH_HINTS)})) >= 2 THEN 'en' ELSE 'es' END"
CTES["wld"] = f"""SELECT message_id, text, source, CASE WHEN {f.strip('text')} = '' THEN 'es' WHEN length(t) < 6 OR NOT regexp_matches(text, '\\p{{L}}') THEN {_hint}
  ELSE idioma END AS lang FROM wlt JOIN wlp USING (message_id)"""
CTES["lgd"] = "SELECT message_id, lang, text, CASE WHEN length(t) < 6 THEN 'desconocido' ELSE idioma END AS idioma_detectado FROM lgp JOIN lgt USING (message_id, ) JOIN (SELECT message_id, text FROM docs) USING (message_id)".replace("(message_id, )", "(message_id)")

# feedback
CTES["fb"] = """
SELECT event_id AS seq, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, CASE event_type WHEN 'error' THEN 1 ELSE 0 END AS label,
       round(k, 4) AS p_spam, round(value / (value + 20e0), 4) AS p_posterior, CASE WHEN k >= 0.6e0 THEN 'SPAM' ELSE 'HAM' END AS pred_prev,
       0.6e0 AS umbral, d.text AS texto, d.lang AS idioma
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100e0 AS k FROM events) e
JOIN (SELECT *, row_number() OVER (ORDER BY message_id) AS r FROM docs) d ON d.r = e.event_id % (SELECT count(*) FROM documents) + 1"""
CTES["fr"] = f"""
SELECT *, printf('%.1f%%', antes) AS porcentaje_antes, printf('%.1f%%', despues) AS porcentaje_despues,
       CASE WHEN delta >= 0 THEN '+' ELSE '' END || printf('%.1f%%', delta + 0e0) AS cambio_delta, pred_prev = etiqueta_ensenada AS era_correcto,
       CASE WHEN length(txt) > 120 THEN substr(txt, 1, 120) || '...' ELSE txt END AS texto_resumen
FROM (SELECT *, {f.half_up('despues - antes', 1)} AS delta FROM (
  SELECT *, {f.strip('texto')} AS txt, {f.half_up('p_spam * 100e0', 1)} AS antes, {f.half_up('p_posterior * 100e0', 1)} AS despues,
         CASE label WHEN 1 THEN 'SPAM' ELSE 'HAM' END AS etiqueta_ensenada FROM fb)) WHERE txt <> ''"""
CTES["hg"] = """
SELECT txt, count(*) AS veces, min(seq) AS primero, max(seq) AS ultimo, max_by(timestamp, seq) AS timestamp, min_by(timestamp, seq) AS primera_fecha,
       coalesce(CAST(epoch(try_strptime(max_by(timestamp, seq), '%Y-%m-%d %H:%M:%S')) AS BIGINT), 0) AS tiempo, count(*) > 1 AS insignia,
       max_by(etiqueta_ensenada, seq) AS etiqueta_ensenada, max_by(cambio_delta, seq) AS cambio_delta, max_by(upper(idioma), seq) AS idioma,
       max_by(texto_resumen, seq) AS texto_resumen FROM fr GROUP BY 1"""
CTES["cat_post"] = "SELECT *, p_posterior AS pf FROM fr"


def catalogue(src: str) -> str:
    return (f"SELECT printf('fb_%03d', row_number() OVER (ORDER BY primero)) AS id, * FROM (SELECT md5(txt) AS clave, min(seq) AS primero, "
            f"min_by(timestamp, seq) AS fecha, min_by(upper(idioma), seq) AS idioma, max_by(etiqueta_ensenada, seq) AS etiqueta, max_by(label, seq) AS label, "
            f"count(*) AS veces_entrenado, CASE WHEN count(*) > 1 THEN max_by(timestamp, seq) END AS ultima_fecha, max_by(pf, seq) AS ultima_probabilidad_spam "
            f"FROM {src} GROUP BY txt)")


# events of the stream as extra samples of the served models
CTES["ev_in"] = f"SELECT seq AS message_id, label AS y, CASE WHEN lower(idioma) = 'en' THEN 'en' ELSE 'es' END AS modelo, {f.clean('txt')} AS t FROM fr"
CTES["ev"] = (terms("(SELECT * FROM ev_in WHERE modelo = 'en')", "modelo, message_id, y", "t", EN, 2) + " UNION ALL "
              + terms("(SELECT * FROM ev_in WHERE modelo = 'es')", "modelo, message_id, y", "t", ES, 1))


def taught(base: str, extra: str, samples: str) -> str:
    """Counts of ``base`` plus those of the rows of ``extra(modelo, message_id, y, terms)`` under frozen idf."""
    flat = f"SELECT modelo, message_id, y, term, (1e0 + ln(count(*))) * any_value(idf) AS x FROM (SELECT modelo, message_id, y, unnest(terms) AS term FROM {extra}) JOIN {base}_v USING (modelo, term) GROUP BY 1, 2, 3, 4"
    unit = f"SELECT *, x / sqrt(sum(x * x) OVER (PARTITION BY modelo, message_id)) AS u FROM ({flat})"
    gain = f"SELECT modelo, term, sum(CASE WHEN y = 0 THEN u ELSE 0e0 END) AS gh, sum(CASE WHEN y = 1 THEN u ELSE 0e0 END) AS gs FROM ({unit}) GROUP BY 1, 2"
    n = f"SELECT modelo, count(*) FILTER (WHERE y = 0) AS n_ham, count(*) FILTER (WHERE y = 1) AS n_spam FROM ({samples}) GROUP BY 1"
    return (f"SELECT modelo, term, w_ham + coalesce(gh, 0e0) AS w_ham, w_spam + coalesce(gs, 0e0) AS w_spam, n_ham, n_spam "
            f"FROM {base}_w LEFT JOIN ({gain}) USING (modelo, term) JOIN ({n}) USING (modelo)")


# posterior of every event after its own teaching: running sums in order of arrival
CTES["evx"] = """SELECT modelo, message_id, y, term, x / sqrt(sum(x * x) OVER (PARTITION BY modelo, message_id)) AS u FROM (
  SELECT modelo, message_id, y, term, (1e0 + ln(count(*))) * any_value(idf) AS x FROM (SELECT modelo, message_id, y, unnest(terms) AS term FROM ev)
  JOIN sv_v USING (modelo, term) GROUP BY 1, 2, 3, 4)"""
CTES["evr"] = """SELECT modelo, message_id, sum(u) AS su, sum(u * (ln(w_spam + gs + 0.1e0) - ln(w_ham + gh + 0.1e0))) AS dot FROM (
  SELECT *, sum(CASE WHEN y = 0 THEN u ELSE 0e0 END) OVER w AS gh, sum(CASE WHEN y = 1 THEN u ELSE 0e0 END) OVER w AS gs FROM evx
  WINDOW w AS (PARTITION BY modelo, term ORDER BY message_id ROWS UNBOUNDED PRECEDING)) JOIN sv_w USING (modelo, term) GROUP BY 1, 2"""
CTES["evp"] = """SELECT message_id AS seq, 1e0 / (1e0 + exp(-(ln((ns + ks) / (nh + kh)) + dot + su * (ln(th + mh + 0.1e0 * v) - ln(ts + ms + 0.1e0 * v))))) AS pm FROM (
  SELECT e.modelo, e.message_id, coalesce(su, 0e0) AS su, coalesce(dot, 0e0) AS dot,
         sum(CASE WHEN y = 0 THEN 1e0 ELSE 0e0 END) OVER w AS kh, sum(CASE WHEN y = 1 THEN 1e0 ELSE 0e0 END) OVER w AS ks,
         sum(CASE WHEN y = 0 THEN coalesce(su, 0e0) ELSE 0e0 END) OVER w AS mh, sum(CASE WHEN y = 1 THEN coalesce(su, 0e0) ELSE 0e0 END) OVER w AS ms
  FROM ev e LEFT JOIN evr r ON r.modelo = e.modelo AND r.message_id = e.message_id
  WINDOW w AS (PARTITION BY e.modelo ORDER BY e.message_id ROWS UNBOUNDED PRECEDING))
JOIN (SELECT modelo, count(*) AS v, sum(w_ham) AS th, sum(w_spam) AS ts FROM sv_w GROUP BY 1) USING (modelo)
JOIN (SELECT modelo, count(*) FILTER (WHERE y = 0) AS nh, count(*) FILTER (WHERE y = 1) AS ns FROM sv GROUP BY 1) USING (modelo)"""
CTES["cat_learned"] = "SELECT *, pm AS pf FROM fr JOIN evp USING (seq)"


# ---------------------------------------------------------------------- queries
BODY["ingest_splits"] = "SELECT *, length(text) AS n, md5(text) AS clave, 'jsonl' AS fuente FROM (SELECT * EXCLUDE (fuente) FROM raw)"
BODY["ingest_fallback"] = "SELECT doc_id, lang, 'local' AS split, 'local_fallback' AS fuente FROM documents"
BODY["csv_scan_sink"] = "SELECT message_id, lang, md5(text) AS clave FROM docs"
BODY["json_array_scan"] = "SELECT item_id, md5(text) AS clave FROM benchmark"
BODY["jsonl_permissive_scan"] = "SELECT event_id, event_type, value FROM events WHERE event_type NOT IN ('view', 'signup')"
BODY["jsonl_append"] = "SELECT seq, upper(idioma) AS idioma, etiqueta_ensenada, cambio_delta FROM fr"
BODY["resolve_aliases"] = ("SELECT 'documents' AS origen, md5(text) AS clave, doc_id AS id FROM documents UNION ALL "
                           "SELECT 'conversations', md5(text), conv_id FROM conversations")
BODY["validate_schema"] = "SELECT Category, count(*) AS filas FROM nlp GROUP BY 1"
BODY["keep_present_columns"] = "SELECT message_id, subject, date, split, fuente FROM raw"
_frag = f"{f.residual('b')}"
CTES["frag"] = (f"SELECT message_id, {_frag} AS texto_es, greatest(nb, 1) AS num_fragmentos FROM (SELECT message_id, array_to_string(list_transform(bl, lambda z: {f.lexical('z')}), ' ') AS b, "
                f"len(bl) AS nb FROM (SELECT message_id, {f.segment('t')} AS bl FROM (SELECT message_id, {f.strip('text')} AS t FROM docs)))")
BODY["best_variant"] = f"""
SELECT message_id, CASE WHEN message_id % 7 = 0 OR message_id % 3 = 0 THEN frag.texto_es ELSE {f.lexical('text')} END AS texto_es,
       CASE WHEN message_id % 7 = 0 THEN 0 WHEN message_id % 3 = 0 THEN 1 ELSE 2 END AS variante FROM docs JOIN frag USING (message_id)"""
BODY["glossary_export"] = f"""
SELECT a.k AS abreviatura_en, a.v AS expansion_en, coalesce({f.sql_map(lx.ABBREVIATIONS_ES)}[a.k], '') AS equivalente_es, coalesce(u.n, 0) AS usos
FROM (SELECT unnest(map_keys(m)) AS k, unnest(map_values(m)) AS v FROM (SELECT {f.sql_map(lx.ABBREVIATIONS)} AS m)) a
LEFT JOIN (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM docs) GROUP BY 1) u ON u.w = a.k"""

BODY["drop_null_text"] = "SELECT message_id, Category FROM valid"
BODY["null_profile"] = " UNION ALL ".join(f"SELECT '{c}' AS columna, count(*) FILTER (WHERE {c} IS NULL) AS nulos FROM raw"
                                          for c in ("message_id", "text", "label", "label_text", "subject", "date", "split", "fuente"))
BODY["normalise_label"] = ("SELECT message_id, Category, y AS Label_Code, coalesce(CASE label WHEN 0 THEN 'ham' WHEN 1 THEN 'spam' END, Category) AS Category_heldout FROM norm")
BODY["length_chars"] = "SELECT message_id, coalesce(length(text), 0) AS longitud_correo FROM raw"
BODY["dedupe_exact"] = "SELECT min(message_id) AS message_id, md5(text) AS clave FROM docs GROUP BY text"
BODY["duplicate_report"] = "SELECT count(*) AS filas, count(DISTINCT text) AS distintos, count(*) - count(DISTINCT text) AS duplicados FROM docs"
BODY["min_length"] = "SELECT message_id, length(text) AS longitud_correo FROM raw WHERE length(text) > 5"
BODY["truncate_long"] = ("SELECT message_id, least(length(text), 10000) AS longitud_correo, CASE WHEN length(text) > 10000 THEN 1 ELSE 0 END AS truncado, "
                         "md5(substr(text, 1, 10000)) AS clave FROM docs")
BODY["long_mail_bias"] = "SELECT Category, count(*) AS conteo FROM dedup WHERE length(text) > 10000 GROUP BY 1"
BODY["cleaning_funnel"] = """
SELECT etapa, conteo, round(conteo * 100e0 / (SELECT count(*) FROM raw), 1) AS porcentaje FROM (
  SELECT 'inicial' AS etapa, count(*) AS conteo FROM raw UNION ALL SELECT 'sin_nulos', count(text) FROM raw
  UNION ALL SELECT 'sin_dup', count(DISTINCT text) FROM valid UNION ALL SELECT 'final', count(*) FROM corpus
  UNION ALL SELECT 'truncados', count(*) FROM corpus WHERE truncado = 1)"""
BODY["clean_corpus"] = "SELECT *, y AS Label_Code, md5(msg) AS clave FROM corpus"
BODY["sanitise_text"] = f"SELECT message_id, {f.strip(f.q('') and 'coalesce(subject, {e})')} AS subject, subject IS NULL AS nulo FROM raw".replace("{e}", "''")

BODY["meta_tokens"] = f"""
SELECT origen, id, regexp_replace({f.signals('text')}, '\\s+', ' ', 'g') AS texto FROM (
  SELECT 'documents' AS origen, doc_id AS id, text FROM documents UNION ALL
  SELECT 'pages', page_id, 'mira ' || url || ' y escribe a x' || page_id || '@correo.es por 20 USD!!!' FROM pages)"""
BODY["charset_normalise"] = f"SELECT message_id, {f.charset('text')} AS texto FROM docs"
BODY["expand_abbreviations"] = f"SELECT message_id, {f.any_words('t', lx.ABBREVIATIONS)} AS texto FROM (SELECT message_id, lower(text || ' ' || {f.pick(lx.ABBREVIATIONS)}) AS t FROM docs)"
BODY["fix_typos"] = f"SELECT message_id, {f.any_words('t', lx.TYPOS)} AS texto FROM (SELECT message_id, lower(text) || ' (' || {f.pick(lx.TYPOS)} || ')' AS t FROM docs)"
BODY["clean_text"] = f"SELECT message_id, {f.clean('t')} AS clean_en FROM (SELECT message_id, text || ' ' || {f.pick(lx.TYPOS)} AS t FROM docs)"
BODY["subject_plus_body"] = f"SELECT message_id, {f.clean(_subject_body + 'text')} AS clean_en FROM raw"
BODY["text_stats"] = f"SELECT message_id, length(text) AS longitud, len({f.words('text')}) AS palabras FROM docs"
BODY["meta_token_counts"] = " UNION ALL ".join(
    f"SELECT Category, '{t}' AS token, sum((length(clean_en) - length(replace(clean_en, '{t}', ''))) / {len(t)}) AS ocurrencias FROM nlp GROUP BY 1" for t in lx.SIGNAL_TOKENS)
BODY["language_detect"] = f"""SELECT message_id, lang, idioma_detectado,
  CASE WHEN len(list_intersect(list_distinct({f.words('lower(text)')}), {f.sql_list(lx.ENGLISH_HINTS)})) >= 2 THEN 'en' ELSE 'es' END AS pista FROM lgd"""
BODY["language_census"] = "SELECT idioma_detectado AS idioma_iso, count(*) AS conteo, round(count(*) * 100e0 / (SELECT count(*) FROM lgd), 2) AS porcentaje FROM lgd GROUP BY 1"
BODY["top_languages"] = """SELECT l AS idioma_iso, count(*) AS conteo FROM (SELECT lang AS l FROM docs UNION ALL
  SELECT regexp_extract(html, 'lang="([a-z]+)"', 1) FROM pages) GROUP BY 1 ORDER BY conteo DESC, l LIMIT 8"""
CTES["lgm"] = (CTES["lgp"].replace("lgt d", "lgm_t d").replace("FROM lgg GROUP", "FROM lgm_g GROUP").replace("FROM lgg a", "FROM lgm_g a"))
CTES["lgm_t"] = f"SELECT message_id, lang, {_lw.replace('text', 'msg')} AS t FROM whole"
CTES["lgm_g"] = _gr.replace("FROM lgt", "FROM lgm_t")
BODY["nlp_corpus"] = f"""
SELECT message_id, Category, CASE WHEN length(t) < 6 THEN 'desconocido' ELSE idioma END AS idioma_detectado, length(clean_en) AS long_clean,
       len({f.words('clean_en')}) AS num_palabras_clean, md5(clean_en) AS clave FROM nlp JOIN lgm USING (message_id) JOIN (SELECT message_id, t FROM lgm_t) USING (message_id)"""

_ph = lambda values: f"(SELECT message_id, text || '. ' || {f.pick(values)} || '!' AS text FROM docs)"
BODY["lexical_translate"] = f"SELECT message_id, {f.lexical('text')} AS texto_es FROM {_ph(lx.PHRASES)}"
BODY["expand_then_translate"] = f"SELECT message_id, {f.expand_lexical('text')} AS texto_es, 1 AS num_fragmentos FROM {_ph(lx.ABBREVIATIONS)}"
BODY["segment_sentences"] = f"""
SELECT message_id, array_to_string(bl, '¶') AS bloques, len(bl) AS n, coalesce(list_max(list_transform(bl, lambda z: length(z))), 0) AS mayor
FROM (SELECT message_id, {f.segment('t')} AS bl FROM (SELECT message_id, {f.strip('text')} AS t FROM docs))"""
BODY["fragment_translate_reassemble"] = "SELECT * FROM frag"
BODY["fragment_regroup"] = "SELECT * FROM frag"
BODY["translate_prefix"] = f"SELECT message_id, {f.lexical('substr(text, 1, 600)')} AS texto_es, 1 AS num_fragmentos FROM docs"
BODY["post_normalise"] = f"SELECT message_id, {f.residual('text')} AS texto_es FROM {_ph([p + ' token number token email Token URL' for p in lx.RESIDUAL_PHRASES])}"
BODY["safe_translate"] = f"SELECT message_id, CASE WHEN message_id % 10 = 0 THEN text ELSE {f.lexical('text')} END AS texto_es, message_id % 10 = 0 AS fallo FROM docs"
CTES["patch"] = """
SELECT message_id, need AS rehecho, CASE WHEN need THEN frag.texto_es ELSE 'v1:' || text END AS texto_es,
       CASE WHEN need THEN num_fragmentos ELSE 1 END AS num_fragmentos
FROM (SELECT *, length(text) > 600 OR message_id % 2 = 1 OR message_id % 10 = 0 AS need FROM docs) JOIN frag USING (message_id)"""
BODY["incremental_patch"] = "SELECT * FROM patch"
BODY["patch_report"] = "SELECT count(*) FILTER (WHERE NOT rehecho) AS conservados, count(*) FILTER (WHERE rehecho) AS rehechos FROM patch"
BODY["resume_pending"] = f"""SELECT message_id, CASE WHEN {f.h('message_id', 'done')} % 3 = 0 THEN 'hecho ' || text ELSE {f.lexical('text')} END AS texto_es,
  1 AS num_fragmentos FROM docs"""
BODY["length_parity"] = f"""
SELECT count(*) AS n, corr(b, a) AS correlacion, avg(b / nullif(a, 0)) AS razon_media, count(*) FILTER (WHERE b > a) AS mas_largos FROM (
  SELECT CAST(length(text) AS DOUBLE) AS a, CAST(length({f.lexical('text')}) AS DOUBLE) AS b FROM
    docs)"""
BODY["examples_per_language"] = """SELECT message_id, lang, r AS orden FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY message_id) AS r FROM docs)
  WHERE r <= CASE lang WHEN 'en' THEN 10 ELSE 3 END"""
_runs = " UNION ALL ".join(f"SELECT {i} AS corrida, text, {seen} AS antes FROM (SELECT DISTINCT text FROM raw WHERE text IS NOT NULL AND {cond})"
                           for i, cond, seen in ((1, "split = 'train'", "false"),
                                                 (2, "split = 'test'", "text IN (SELECT text FROM raw WHERE split = 'train')"),
                                                 (3, "true", "true")))
BODY["translation_reuse"] = f"""SELECT corrida, count(*) AS textos, count(*) FILTER (WHERE antes) AS reutilizados,
       count(*) FILTER (WHERE NOT antes) AS traducidos, 0 AS fallidos FROM ({_runs}) GROUP BY corrida"""
CTES["frag_raw"] = CTES["frag"].replace("FROM docs", "FROM raw")
BODY["stored_translations"] = """SELECT message_id, CASE WHEN text IS NOT NULL THEN frag_raw.texto_es END AS texto_es,
       CASE WHEN text IS NULL THEN 0 ELSE frag_raw.num_fragmentos END AS num_fragmentos, false AS fallo
FROM raw JOIN frag_raw USING (message_id)"""
BODY["translated_corpus"] = "SELECT message_id, texto_es, 1 AS num_fragmentos, length(texto_es) AS longitud_es FROM nlp_es"
BODY["translation_validation"] = "SELECT count(*) AS filas, count(texto_es) AS traducidas, round(avg(num_fragmentos), 2) AS fragmentos_media, max(num_fragmentos) AS fragmentos_max FROM frag"

_take = "SELECT message_id, Category FROM ({0}) WHERE r <= {1}"
BODY["stratified_sample"] = _take.format(ranked("valid"), "least(greatest(1, round_even(150e0 * nc / na, 0)), nc)")
BODY["balanced_sample"] = _take.format(ranked("valid"), "least(nc, 50)")
BODY["random_sample"] = f"SELECT message_id FROM docs QUALIFY row_number() OVER (ORDER BY {f.h('message_id')}, message_id) <= 200"
BODY["stratified_split"] = (f"SELECT message_id, Category, CASE WHEN r <= round_even(0.64e0 * nc, 0) THEN 'train' WHEN r <= round_even(0.8e0 * nc, 0) THEN 'val' "
                            f"ELSE 'test' END AS parte FROM ({ranked('valid')})")
BODY["stratified_kfold"] = " UNION ALL ".join(f"SELECT message_id, Category, {_fold} AS pliegue, {r} AS repeticion FROM ({ranked('valid', f'cv{r}')})" for r in (0, 1))
BODY["shuffle"] = f"SELECT message_id, row_number() OVER (ORDER BY {f.h('message_id')}, message_id) AS posicion FROM docs"

CTES["cl"] = f"SELECT message_id, {f.clean('text')} AS c FROM docs"
BODY["tokenise_stop"] = f"SELECT message_id, array_to_string({f.tokens('c', EN)}, ' ') AS tokens, array_to_string({f.tokens('c', ES)}, ' ') AS tokens_es FROM cl"
BODY["ngrams"] = f"SELECT message_id, array_to_string(terms, ' | ') AS gramas FROM ({terms('cl', 'message_id', 'c', EN, 2)})"
BODY["vocabulary_topk"] = "SELECT term, total, df, idf, rango FROM al_v"
BODY["tfidf"] = "SELECT message_id, term, x / l AS x FROM al_x JOIN al_l USING (modelo, message_id)"
BODY["nb_train"] = "SELECT term, w.idf, w_ham, w_spam, lp_ham, lp_spam FROM ex_w w JOIN ex_k USING (modelo, term)"
BODY["nb_score"] = "SELECT message_id, CASE WHEN tr THEN 'train' ELSE 'test' END AS parte, y AS Label_Code, p AS p_spam FROM ex6"
BODY["threshold_predict"] = "SELECT message_id, p AS p_spam, CASE WHEN p >= 0.75 THEN 1 ELSE 0 END AS pred FROM ex6"
BODY["grid_search"] = """
SELECT *, row_number() OVER (ORDER BY f1_medio DESC, alpha, max_features, ngram) = 1 AS mejor FROM (
  SELECT alpha, max_features, CAST(string_split(modelo, '|')[1] AS INT) AS ngram, round(avg(f1), 6) AS f1_medio FROM gsf GROUP BY 1, 2, 3)"""
BODY["cv_folds"] = "SELECT * FROM cvf"
BODY["cv_repeated"] = "SELECT round(avg(f1), 4) AS f1_cv_mean, round(stddev_pop(f1), 4) AS f1_cv_std FROM cvf"
BODY["calibrate_threshold"] = f"SELECT *, 0.5 AS beta FROM ({best_threshold('val6', 0.5, C50)}) UNION ALL SELECT *, 1.0 FROM ({best_threshold('val6', 1.0, C80)})"
BODY["threshold_sweep"] = sweep("val6", 0.5, C50)
CTES["exw"] = "SELECT modelo, term, round(lp_spam - lp_ham, 9) AS peso FROM ex_k"
BODY["top_terms"] = " UNION ALL ".join(
    f"SELECT '{c}' AS clase, r AS rango, term, round(peso, 3) AS peso FROM (SELECT term, {s} * peso AS peso, row_number() OVER (ORDER BY {s} * peso DESC, term) AS r FROM exw) WHERE r <= 60"
    for c, s in (("spam", "1"), ("ham", "-1")))
BODY["explain_mail"] = explained("(SELECT 'en' AS modelo, * FROM nlp)", "ex_k", "clean_en")
BODY["nb_partial_fit"] = taught("ex", "(SELECT * FROM ex WHERE NOT tr)", "SELECT * FROM ex")
BODY["model_tables"] = "SELECT message_id, p AS p_spam FROM ex_p"
BODY["model_comparison"] = f"SELECT * FROM ({f.metrics('mcp')}) JOIN (SELECT modelo, umbral FROM mct) USING (modelo)"

BODY["confusion_matrix"] = ("SELECT modelo, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp, "
                            "count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp FROM ex6 GROUP BY 1")
BODY["classification_metrics"] = f.metrics("ex6t", ranking=False)
BODY["roc_auc"] = f.rank_metrics("ex6t")
BODY["average_precision"] = f.rank_metrics("ex6t")
BODY["roc_curve"] = f"SELECT p AS umbral, fp / CAST(nn AS DOUBLE) AS fpr, tp / CAST(np AS DOUBLE) AS tpr FROM ({f.cumulative('ex6')})"
BODY["pr_curve"] = f"SELECT p AS umbral, tp / CAST(np AS DOUBLE) AS recall, tp / CAST(tp + fp AS DOUBLE) AS precision FROM ({f.cumulative('ex6')})"
BODY["error_audit"] = """SELECT message_id, md5(text) AS clave, y AS real, round(p, 3) AS p_spam, pred, CASE pred WHEN 1 THEN 'FP' ELSE 'FN' END AS tipo
  FROM ex6 JOIN (SELECT message_id, text FROM raw) USING (message_id) WHERE pred <> y ORDER BY message_id LIMIT 100"""
BODY["error_totals"] = "SELECT modelo, count(*) FILTER (WHERE y = 0 AND pred = 1) AS falsos_positivos, count(*) FILTER (WHERE y = 1 AND pred = 0) AS falsos_negativos FROM ex6 GROUP BY 1"
BODY["heldout_evaluation"] = f.metrics("hxp")
CTES["hxw"] = "SELECT modelo, term, round(lp_spam - lp_ham, 9) AS peso FROM hx_k"
BODY["model_unit"] = (f"SELECT * FROM ({f.metrics('hxm', ranking=False)}) JOIN (SELECT modelo, umbral FROM hxt) USING (modelo) JOIN (" + " UNION ALL ".join(
    f"SELECT modelo, '{c}' AS clase, r AS rango, term, round(peso, 3) AS peso FROM (SELECT modelo, term, {s} * peso AS peso, "
    f"row_number() OVER (PARTITION BY modelo ORDER BY {s} * peso DESC, term) AS r FROM hxw) WHERE r <= 60"
    for c, s in (("spam", "1"), ("ham", "-1"))) + ") USING (modelo)")
BODY["metrics_unpivot"] = (f"SELECT *, round(valor * 100, 2) AS valor_x100 FROM (UNPIVOT (SELECT modelo, accuracy, precision, recall, f1 FROM ({f.metrics('ex6', ranking=False)})) "
                           "ON accuracy, precision, recall, f1 INTO NAME metrica VALUE valor)")
BODY["mail_classifier"] = f.metrics("ex6t")

BODY["route_by_language"] = "SELECT *, md5(texto_procesado) AS clave FROM routed"
BODY["certainty_flag"] = "SELECT *, motivo AS motivo_incertidumbre FROM pr"
BODY["predict_batch"] = f"""SELECT pr.*, round(p, 4) AS p_spam, round(1e0 - p, 4) AS p_ham, lang AS idioma_detectado, e.tokens_spam, e.tokens_ham
  FROM pr JOIN ({explained('routed', 'sv_k', 'texto_procesado')}) e USING (message_id)"""
BODY["bank_audit"] = """SELECT CASE WHEN grouping(lang) = 1 THEN 'TOTAL' ELSE lang END AS categoria, count(*) FILTER (WHERE resultado = 'PASS') AS aciertos, count(*) AS total,
  round(count(*) FILTER (WHERE resultado = 'PASS') * 100e0 / count(*), 1) AS tasa FROM bank GROUP BY GROUPING SETS ((), (lang))"""
BODY["pool_validation"] = "SELECT message_id, CASE WHEN es_incierto THEN 'ZONA GRIS' WHEN etiqueta = esperada THEN 'ACIERTO' ELSE 'FALLO' END AS validacion FROM bank"
BODY["catalog_filter"] = """SELECT message_id, 'Camuflado' AS subcategoria, lang AS idioma, substr(source || ' / ' || text, 1, 35) AS categoria, substr(text, 1, 35) AS asunto
  FROM docs WHERE message_id % 3 = 0"""
BODY["catalog_pick"] = f"SELECT message_id FROM docs ORDER BY {f.h('message_id')}, message_id LIMIT 1"
BODY["uncertain_archive"] = """SELECT '2024-01-31 00:00:00' AS timestamp, upper(lang) AS idioma, printf('%.3f', p) AS p_spam, printf('%.2f', umbral) AS umbral, motivo,
  md5(text) AS clave, texto_procesado FROM pr WHERE es_incierto"""

BODY["feedback_records"] = """SELECT *, md5(txt) AS clave, upper(x) AS idioma, pred_prev AS prediccion_previa, p_spam AS probabilidad_spam_previa,
  CASE WHEN p_posterior >= umbral THEN 'SPAM' ELSE 'HAM' END AS prediccion_posterior, p_posterior AS probabilidad_spam_posterior FROM (SELECT * RENAME (idioma AS x) FROM fr)"""
BODY["feedback_log"] = f"""SELECT timestamp, idioma, CASE label WHEN 1 THEN 'SPAM' ELSE 'HAM' END AS etiqueta_asignada, printf('%.3f', p_spam) AS p_spam_previa,
  row_number() OVER (PARTITION BY modelo ORDER BY seq) + coalesce(n, 0) AS num_muestras_total, md5(texto) AS clave, {f.clean('texto')} AS texto_procesado
FROM (SELECT *, CASE WHEN idioma = 'en' THEN 'en' ELSE 'es' END AS modelo FROM fb) LEFT JOIN (SELECT modelo, count(*) AS n FROM sv GROUP BY 1) USING (modelo)"""
BODY["online_learning"] = taught("sv", "ev", "SELECT modelo, y FROM sv UNION ALL SELECT modelo, y FROM ev")
BODY["retrain_catalog"] = catalogue("cat_post")
BODY["retrain_catalog_stream"] = catalogue("cat_post")
BODY["learned_catalog"] = catalogue("cat_learned")
BODY["online_scores"] = """SELECT seq, upper(idioma) AS idioma, pm AS probabilidad_spam_posterior,
  CASE WHEN pm >= umbral THEN 'SPAM' ELSE 'HAM' END AS prediccion_posterior, etiqueta_ensenada FROM fr JOIN evp USING (seq)"""
BODY["history_groups"] = "SELECT *, md5(txt) AS clave FROM hg"
BODY["history_timeline"] = """SELECT *, md5(txt) AS clave, row_number() OVER (PARTITION BY txt ORDER BY seq) AS iteracion,
  seq = max(seq) OVER (PARTITION BY txt) AS es_actual, CASE WHEN era_correcto THEN 'Confirmado' ELSE 'Reentrenado' END AS estado FROM fr"""
BODY["history_search"] = "SELECT *, md5(txt) AS clave FROM hg WHERE contains(lower(txt), 'the') OR contains(lower(texto_resumen), 'the') OR contains(lower(idioma), 'the')"
BODY["history_page"] = "SELECT md5(txt) AS clave, veces, tiempo FROM hg ORDER BY tiempo DESC, primero LIMIT 25 OFFSET 50"

BODY["class_distribution"] = "SELECT Category, count(*) AS conteo, round(count(*) * 100e0 / (SELECT count(*) FROM whole), 1) AS porcentaje FROM whole GROUP BY 1"


def histogram(src: str, value: str, bins: int, name: str) -> str:
    at = f"least(coalesce(floor(round(log10({value}) - lo, 9) / nullif((hi - lo) / {bins}e0, 0)), 0), {bins - 1})"
    return (f"SELECT '{name}' AS medida, Category, bin, round(pow(10e0, lo + bin * (hi - lo) / {bins}e0), 4) AS desde, count(*) AS conteo FROM ("
            f"SELECT Category, lo, hi, {at} AS bin FROM {src}, (SELECT log10(min({value})) AS lo, log10(max({value})) AS hi FROM {src} WHERE {value} > 0) WHERE {value} > 0) GROUP BY 2, 3, lo, hi")


CTES["lens"] = f"SELECT Category, longitud_correo, len({f.words('msg')}) AS num_palabras FROM whole"
BODY["length_histogram"] = histogram("lens", "longitud_correo", 40, "caracteres") + " UNION ALL " + histogram("lens", "num_palabras", 60, "palabras")
CTES["kc"] = "SELECT Category, CAST(round(log10(longitud_correo) / 0.01e0) AS INT) AS c, count(*) AS w FROM whole GROUP BY 1, 2"
CTES["kp"] = """SELECT *, greatest(sqrt(greatest((ss - n * (s / n) * (s / n)) / greatest(n - 1, 1), 0e0)) * pow(n, -0.2e0), 0.01e0) AS bw FROM (
  SELECT Category, CAST(sum(w) AS DOUBLE) AS n, sum(w * (c * 0.01e0)) AS s, sum(w * (c * 0.01e0) * (c * 0.01e0)) AS ss, min(c) AS lo, max(c) AS hi FROM kc GROUP BY 1)"""
BODY["length_density"] = """SELECT Category, punto, round(any_value(x), 6) AS x, round(sum(w * exp(-0.5e0 * ((c * 0.01e0 - x) / bw) ** 2) / (n * bw * sqrt(2e0 * pi()))), 6) AS densidad FROM (
  SELECT k.*, n, bw, i AS punto, (lo + (hi - lo) * i / 49e0) * 0.01e0 AS x FROM kc k JOIN kp USING (Category), (SELECT unnest(range(0, 50)) AS i)) GROUP BY 1, 2"""
CTES["wc"] = f"SELECT Category, len({f.words('clean_en')}) AS v FROM nlp"
BODY["wordcount_boxplot"] = """SELECT Category, n, q1, mediana, q3, min(v) AS bigote_inf, max(v) AS bigote_sup FROM wc JOIN (
  SELECT Category, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS mediana, quantile_cont(v, 0.75) AS q3 FROM wc GROUP BY 1) USING (Category)
  WHERE v BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1) GROUP BY 1, 2, 3, 4, 5"""


# --------------------------------------------------------------------- assembly
def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"(?:FROM|JOIN)\s+([a-z_0-9]+)", sql))
    return [n for n in CTES if n in words]


def _ordered(sql: str, seen: list[str]) -> list[str]:
    for name in _needs(sql):
        if name not in seen:
            _ordered(CTES[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def _typed(name: str, kind: str) -> str:
    if kind == "l":
        return f"CAST({name} AS BIGINT) AS {name}"
    if kind == "s":
        return f"CAST({name} AS VARCHAR) AS {name}"
    if kind == "b":
        return f"CAST({name} AS BOOLEAN) AS {name}"
    return f"round(CAST({name} AS DOUBLE), {kind[1:]}) + 0e0 AS {name}"


def build(name: str) -> str:
    body, columns = BODY[name], [c.split(":") for c in SPECS[name].split()]
    with_ = ", ".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in _ordered(body, []))
    cols = ", ".join(_typed(n, k) for n, k in columns)
    return f"{'WITH ' + with_ if with_ else ''} SELECT {cols} FROM ({body}) AS t"


ORACLES = {name: build(name) for name in BODY}
