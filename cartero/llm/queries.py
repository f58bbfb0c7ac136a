"""The operators as queries over the given tables, with the digest columns of their contracts."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cartero.llm import blockmax, decontaminate, extract, langid, minhash, packing, permutation, pseudo, rans, squares, suffixes, toxicity, winnow
from cartero.llm.common import crc_mod, narrow, ship, table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@F.pandas_udf(LongType())
def crc32_of(data: pd.Series) -> pd.Series:
    return data.map(zlib.crc32)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels whose crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 3) != 1)
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score",
                        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document, and whether it counts as contaminated."""
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vec_id divisible by 20."""
    return permutation.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def language_model(spark: SparkSession, docs: DataFrame) -> langid.Model | None:
    """Learnt from documents whose crc32(doc_id) mod 5 is not 0."""
    learn = narrow(docs, "doc_id", "text", "lang").filter(crc_mod("doc_id", 5) != 0)
    return langid.fit(learn, learn)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, language_model(spark, docs))
    return found.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat 100 bytes from an earlier place."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op6_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, read the files back and return a checksum per document."""
    back = rans.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())
    return back.select("doc_id", "start", "n_tokens", crc32_of("ids").alias("ids_crc32"))


def op7_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of every document."""
    docs = table(spark, sf_dir, "documents")
    return pseudo.score(docs, pseudo.fit(docs)).withColumn(
        "per_word", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and runs that repeat an earlier run of three lines, or of over 50 words, and a checksum of what is left."""
    found = winnow.delete_runs(narrow(table(spark, sf_dir, "documents"), "doc_id", "text"), words=50)
    return found.select("doc_id", "lines_removed", "runs_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, one in ten of which is made periodic first, and a checksum of what is left."""
    docs = narrow(table(spark, sf_dir, "documents"), "doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    found = squares.find_runs(docs, plant=(g, F.when(h % 10 == 0, 3 + g % 8)))
    top = squares.longest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"),
        top["period"].alias("period"), F.floor(1000 * top["length"] / top["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    index = blockmax.build(table(spark, sf_dir, "documents"))
    return blockmax.search(index, table(spark, sf_dir, "benchmark"))


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, after the package was sent to the workers."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: shipped(q) for q in (
    op1_toxicity, op2_decontaminate, op3_permutation, op4_language, op5_suffix_array, op6_rans, op7_pseudo_likelihood, op8_minhash, op9_line_dedup, op10_packing,
    op11_main_text, op12_periodic_runs, op13_ranked_search)}
OP2_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ik AS (SELECT item, w, least(13, len(w)) AS k FROM iw WHERE len(w) > 0),
ig AS (SELECT DISTINCT item, k, array_to_string(w[p : p + k - 1], ' ') AS g
       FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM ik)),
dg AS (SELECT doc_id, p, k, array_to_string(w[p : p + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM dw, (SELECT DISTINCT k FROM ig))),
hit AS (SELECT doc_id, p, k, item FROM dg JOIN ig USING (k, g)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS s FROM hit GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""
OP5_SQL = r"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 200)) AS g
      FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) // 2 - 99 AS BIGINT))) AS p FROM t WHERE length(h) >= 200)),
later AS (SELECT doc_id, p FROM g QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1),
bounds AS (SELECT doc_id, p, coalesce(p > lag(p) OVER w + 100, true) AS opens FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
numbered AS (SELECT doc_id, p, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM bounds),
runs AS (SELECT doc_id, r, min(p) AS a, max(p) + 100 AS z FROM numbered GROUP BY doc_id, r),
parts AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS prev FROM runs),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last,
                string_agg(substr(h, CAST(2 * prev + 1 AS BIGINT), CAST(2 * (a - prev) AS BIGINT)), '' ORDER BY a) AS s
         FROM parts JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE s || substr(h, CAST(2 * last + 1 AS BIGINT)) END)) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)"""
OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + k - 1], ' ') AS g
      FROM (SELECT doc_id, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 75 * (x.n + y.n - m)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""
OP9_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM documents),
f AS (SELECT doc_id, ln, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM l),
p AS (SELECT doc_id, ln, t, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS p,
             len(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS n FROM f WHERE t <> ''),
g AS (SELECT a.doc_id, a.p, 3 AS k, [a.t, b.t, c.t] AS g FROM p a JOIN p b ON a.doc_id = b.doc_id AND b.p = a.p + 1
      JOIN p c ON a.doc_id = c.doc_id AND c.p = a.p + 2
      UNION ALL SELECT a.doc_id, a.p, 2, [a.t, b.t] FROM p a JOIN p b ON a.doc_id = b.doc_id AND b.p = a.p + 1 WHERE a.n + b.n > 50
      UNION ALL SELECT doc_id, p, 1, [t] FROM p WHERE n > 50),
later AS (SELECT doc_id, p, k FROM g QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + k)) AS p FROM later),
runs AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE p - 1 NOT IN (SELECT y.p FROM gone y WHERE y.doc_id = x.doc_id)) AS r FROM gone x GROUP BY doc_id),
kept AS (SELECT f.doc_id, string_agg(line, chr(10) ORDER BY f.ln) AS s FROM f LEFT JOIN p ON p.doc_id = f.doc_id AND p.ln = f.ln
         LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.p = p.p WHERE gone.p IS NULL GROUP BY f.doc_id)
SELECT d.doc_id, coalesce(n, 0) AS lines_removed, coalesce(r, 0) AS runs_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM documents d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)"""
OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                      lambda c: [CAST(ascii(c) AS BIGINT), 256, 256, 256, 256, 256, 256, 256, 256]))),
                      lambda a, x: CASE WHEN x < 256 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) AS h FROM documents),
s AS (SELECT doc_id, w, h, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS turns FROM d),
x AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // turns) END])
                             ELSE w END AS w FROM s),
t AS (SELECT doc_id, n, unnest(w) AS t, unnest(range(n)) AS i FROM x),
same AS (SELECT a.doc_id, b.i - a.i AS p, a.i FROM t a JOIN t b ON a.doc_id = b.doc_id AND a.t = b.t AND a.i < b.i AND 2 * (b.i - a.i) <= a.n),
isle AS (SELECT doc_id, p, i, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS k FROM same),
stretch AS (SELECT doc_id, p, min(i) AS s, min(i) + count(*) + p AS e FROM isle GROUP BY doc_id, p, k HAVING count(*) + p >= greatest(12, 2 * p)),
run AS (SELECT doc_id, s, e, min(p) AS p FROM stretch GROUP BY doc_id, s, e),
top AS (SELECT doc_id, s, e - s AS length, p FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY e - s DESC, s, p) = 1),
runs AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || p || chr(10), '' ORDER BY s, p) AS r FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + p, e)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS c FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT x.doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.length, top.p AS period, 1000 * top.length // top.p AS exponent_milli,
       sha256(coalesce(r, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM x LEFT JOIN runs USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN kept USING (doc_id)"""
OP13_SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM n, c),
p AS (SELECT doc_id, term, count(*) AS tf FROM t SEMI JOIN q USING (term) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * any_value(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, c GROUP BY term),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50"""
ORACLES: dict[str, str] = {"op2_decontaminate": OP2_SQL, "op5_suffix_array": OP5_SQL, "op8_minhash": OP8_SQL, "op9_line_dedup": OP9_SQL,
                           "op12_periodic_runs": OP12_SQL, "op13_ranked_search": OP13_SQL}
