"""The registered queries of the corpus operators, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codes, langid, licenses, lmscore, mixing, negatives, pieces, pii, quality, sharding, simhash, tokencount, topk
from .common import only, written

SHARDS = 40
TOKEN_LIMIT = 1024


def _tokenizer(name: str) -> str:
    """Where the public vocabulary files lie; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return only(spark.read.parquet(f"{sf_dir}/documents.parquet"), columns)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the folds that are not held out."""
    docs = _documents(spark, sf_dir, "doc_id", "text", "lang").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.fit(docs, learn=~F.col("held_out"))
    return langid.identify(docs, model, keep=("doc_id", "held_out"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    rows = simhash.near_duplicates(_documents(spark, sf_dir, "doc_id", "text"), shingle=3, distance=3)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every query vector."""
    vectors = only(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), ["vec_id", "embedding"])
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    q = F.col("__quality")
    judged = quality.judge(_documents(spark, sf_dir, "doc_id", "text"))
    return judged.select("doc_id", *[q["counts"][c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                         q["base_failed"].alias("base_failed"), q["kept"].alias("kept"))


def op5_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document with seeded merge-dropout."""
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return pieces.encode_documents(docs, _tokenizer("piece_bpe_32k.model"))


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document; sizes of shards nearly equal."""
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    rows = sharding.slotted(_documents(spark, sf_dir, "doc_id", "text"), [F.col("doc_id"), crc])
    versions = sharding.balanced_map(rows, SHARDS)
    stored = sharding.store_map(spark, sharding.map_path(spark), versions)
    placed = sharding.place(rows, stored.where(F.col("version") == len(versions) - 1).drop("version"), ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(len(versions) - 1).alias("map_version"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document, the shards that its copies go to, and their order within."""
    rows = mixing.records(_documents(spark, sf_dir, "doc_id", "text", "source"))
    return mixing.assigned(rows, mixing.plan(rows, SHARDS)).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "shards", "shuffle_keys")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document between documents labelled good and all documents."""
    docs = _documents(spark, sf_dir, "doc_id", "text")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    target, background = lmscore.fit(docs, good)
    return lmscore.score(docs, target, background)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest and licence of every document (line 0), and every line that is a known notice by itself."""
    docs = _documents(spark, sf_dir, "doc_id", "text")
    whole = licenses.scan(docs).select("doc_id", F.lit(0).alias("line"), "digest", "license", "kind")
    lines = licenses.notices(docs).select("doc_id", "line", F.lit(None).cast("string").alias("digest"), "license", "kind")
    return whole.unionByName(lines)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return tokencount.count_tokens(docs, _tokenizer("byte_bpe_50k.json")).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector."""
    return codes.compress(only(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), ["vec_id", "embedding", "label"]))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of what stands plainly, and all places."""
    found = pii.detect(_documents(spark, sf_dir, "doc_id", "text"))
    plain = F.filter("spans", lambda s: s["plain"])
    count = lambda kind: F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(pii.said(plain), 256).alias("base_sha256"), pii.said(F.col("spans")).alias("spans"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor; some labels are shifted, as wrong labels of a real set would be."""
    vectors = only(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), ["vec_id", "embedding", "label"])
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline from documents to pieces."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_language_id, op2_simhash, op3_topk, op4_quality_rules, op5_piece_dropout, op6_shards, op7_mix, op8_lm_score,
    op9_license_scan, op10_token_counts, op11_vector_codes, op12_pii, op13_hard_negatives, pipeline)}

_SQL_TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def _sql_quality() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(
        [*quality.STOP_WORDS, *[x.capitalize() for x in quality.STOP_WORDS], *[x.upper() for x in quality.STOP_WORDS if len(x) > 1]]))
    tests = []
    for r in quality.RULES:
        ratio = f"CASE WHEN {r.whole} > 0 THEN CAST({r.part} AS DOUBLE) / {r.whole} ELSE 0 END"
        tests += [f"{ratio} >= {r.least}"] * (r.least is not None) + [f"{ratio} <= {r.most}"] * (r.most is not None)
    return rf"""
WITH w AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM documents),
g AS (SELECT row_no, unnest(range(1, greatest(len(w) - 1, 1))) AS i,
             unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, greatest(len(w) - 1, 1))]) AS gram FROM w WHERE len(w) > 3),
d AS (SELECT row_no, i FROM (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, gram) AS n FROM g) WHERE n > 1),
covered AS (SELECT row_no, count(DISTINCT i + k) AS n FROM d, (VALUES (0), (1), (2)) o(k) GROUP BY row_no),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
             len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop_words
      FROM w LEFT JOIN covered USING (row_no)),
b AS (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(tests)} AS kept FROM b"""


def _sql_licenses() -> str:
    def form(x: str) -> str:
        x = f"regexp_replace({x}, 'Copyright {licenses._PHRASE}', 'copyright-\\1', 'g')"
        for notice in licenses._NOTICE:
            x = f"regexp_replace({x}, '{notice}', chr(10), 'g')"
        x = f"translate(replace({x}, '&', ' and '), '{licenses._UPPER}', '{licenses._LOWER}')"
        x = f"trim(regexp_replace({x}, '{licenses._GAP}', ' ', 'g'))"
        for a, b in licenses.EQUIVALENT:
            x = f"replace({x}, '{a}', '{b}')"
        return f"sha256({x})"

    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({', '.join(map(quoted, row))})" for row in licenses.KNOWN)
    return f"""
WITH known AS (SELECT {form('text')} AS digest, min((license, kind)) AS k FROM (VALUES {known}) v(license, kind, text) GROUP BY 1),
whole AS (SELECT doc_id, {form('text')} AS digest FROM documents),
line AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
hit AS (SELECT doc_id, line, {form('text')} AS digest FROM line)
SELECT doc_id, CAST(0 AS INTEGER) AS line, whole.digest, k[1] AS license, k[2] AS kind FROM whole LEFT JOIN known ON whole.digest = known.digest
UNION ALL
SELECT doc_id, CAST(line AS INTEGER), CAST(NULL AS VARCHAR), k[1], k[2] FROM hit JOIN known ON hit.digest = known.digest"""


_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _sql_codes() -> str:
    steps = [f"""
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({codes.FACTOR} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
     FROM embeddings WHERE {_USABLE} AND len(embedding) > 0 AND len(embedding) % {codes.PARTS} = 0),
x AS MATERIALIZED (SELECT r, vec_id, p, v[p * (len(v) // {codes.PARTS}) + 1 : (p + 1) * (len(v) // {codes.PARTS})] AS x FROM v, range({codes.PARTS}) t(p)),
b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM x
      WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {codes.ENTRIES}))"""]
    for i in range(codes.ROUNDS + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (SELECT r, p, min({{'d': CAST(list_sum(list_transform(list_zip(x, c), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) AS BIGINT), 'e': e}}) AS m
      FROM x JOIN b{i} USING (p) GROUP BY r, p)""")
        if i < codes.ROUNDS:
            steps.append(f"""
s{i} AS (SELECT p, m.e AS e, j, CAST(sum(x[j]) AS BIGINT) AS s, count(*) AS n FROM a{i} JOIN x USING (r, p), (SELECT unnest(range(1, len(x) + 1)) AS j, r, p FROM x) k
      WHERE k.r = x.r AND k.p = x.p GROUP BY p, m.e, j),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(t.c, b.c) AS c FROM b{i} b LEFT JOIN (
      SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM s{i} GROUP BY p, e) t ON t.p = b.p AND t.e = b.e)""")
    last = codes.ROUNDS
    return "WITH" + ",".join(steps) + f""",
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS sha FROM b{last}),
code AS (SELECT r, string_agg(lpad(lower(hex(m.e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{last} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256 FROM v JOIN code USING (r), book"""


_SQL_NEGATIVES = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_USABLE}),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM n WHERE rank <= 10"""


ORACLE: dict[str, str] = {"op11_vector_codes": _sql_codes(), "op13_hard_negatives": _SQL_NEGATIVES.strip(), "op3_topk": _SQL_TOPK.strip(), "op4_quality_rules": _sql_quality().strip(), "op9_license_scan": _sql_licenses().strip()}
