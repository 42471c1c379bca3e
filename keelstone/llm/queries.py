"""The registered queries of these operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from keelstone.llm import (
    collocations, decontaminate, hard_negatives, html_text, license_scan, ngram_join, ngram_lm, packing,
    quality_rules, sharding, substring_dedup, toxicity, url_reputation,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


OP1_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(
          CASE WHEN len(words) = 0 THEN []
               WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
               ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))
          END) AS gram FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
      FROM s AS x JOIN s AS y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
      WHERE 100 * both_have >= 90 * (x.n + y.n - both_have)),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS id, doc_id AS reached FROM documents
      UNION SELECT r.id, e2.b FROM r JOIN e2 ON r.reached = e2.a),
c AS (SELECT id, min(reached) AS component_id FROM r GROUP BY id)
SELECT documents.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents LEFT JOIN n USING (doc_id) JOIN c ON c.id = documents.doc_id
"""


@query(OP1_SQL)
def op1_ngram_jaccard_join(spark, folder):
    """Components of documents whose 3-word shingle sets have a similarity of 0.9 or more."""
    return ngram_join.jaccard_components(table(spark, folder, "documents"), k=3, percent=90)


OP7_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
           FROM documents),
w AS (SELECT doc_id, generate_subscripts(words, 1) AS i, words FROM t),
g AS (SELECT doc_id, i, list_slice(words, i, i + 4) AS gram FROM w WHERE i + 4 <= len(words)),
r AS (SELECT doc_id, unnest(list(i)) AS i FROM g GROUP BY doc_id, gram HAVING count(*) > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM r)
      GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT t.doc_id, len(words)::BIGINT AS n_words,
             length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
             coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(d.n_lines, 0) AS n_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM t LEFT JOIN d USING (doc_id) LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 40 * n_words OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR (n_words >= 10 AND 100 * n_capitals > 60 * word_chars)) AS kept
FROM b
"""


@query(OP7_SQL)
def op7_quality_rules(spark, folder):
    """Measurements and verdict of every document, from the ledger."""
    rows = quality_rules.ledger(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("base")).alias("base_failed"),
        quality_rules.passes().alias("kept"),
    )


@query()
def op2_packing(spark, folder):
    """Pieces of all documents in sequences of 2,048 tokens."""
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


OP3_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
           FROM documents),
w AS (SELECT doc_id, words, generate_subscripts(words, 1) AS i FROM t),
g AS (SELECT doc_id, i, hash(list_slice(words, i, i + 12)) AS gram FROM w WHERE i + 12 <= len(words)),
f AS (SELECT gram, min(doc_id) AS first_doc FROM g GROUP BY gram),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN f USING (gram)
      WHERE first_doc < doc_id),
k AS (SELECT w.doc_id, string_agg(words[w.i], ' ' ORDER BY w.i) FILTER (c.i IS NULL) AS kept,
             count(c.i) AS n_removed
      FROM w LEFT JOIN c ON w.doc_id = c.doc_id AND w.i = c.i GROUP BY w.doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k USING (doc_id)
"""


@query(OP3_SQL)
def op3_substring_dedup(spark, folder):
    """Words that remain when repeats of 13 words or more are removed."""
    return substring_dedup.digest(table(spark, folder, "documents"))


@query()
def op4_html_extraction(spark, folder):
    """Main text of every page."""
    return html_text.extract(table(spark, folder, "pages"))


@query()
def op5_benchmark_decontamination(spark, folder):
    """Documents that contain a benchmark item, and the closest passage."""
    items = table(spark, folder, "benchmark")
    return decontaminate.hits(table(spark, folder, "documents"), items, short_items=True)


def _strength_sql(groups):
    """Strength of the prior that the rates of a table of counts come from."""
    return f"""
        (SELECT CASE WHEN total IS NULL OR k < 2 OR spread <= 0 THEN 1000.0
                     ELSE least(greatest(mean * (1 - mean) / spread - 1, 1.0), 1000.0) END
         FROM (SELECT *, (s - total * mean * mean - (k - 1) * mean * (1 - mean))
                         / CASE WHEN total - nn / total - (k - 1) = 0 THEN 1
                                ELSE total - nn / total - (k - 1) END AS spread
               FROM (SELECT count(*) AS k, sum(n)::DOUBLE AS total, sum(n * n)::DOUBLE AS nn,
                            sum(bad)::DOUBLE / sum(n) AS mean, sum(bad::DOUBLE * bad / n) AS s
                     FROM {groups} WHERE n > 0)))
    """


OP6_SQL = rf"""
WITH u AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN url[instr(url, '://') + 3:] ELSE '' END AS rest
    FROM pages),
p AS (SELECT page_id,
             translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
o AS (SELECT doc_id, max(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS is_bad
      FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
c AS (SELECT host, count(is_bad) AS n, count(*) FILTER (is_bad) AS bad
      FROM p LEFT JOIN o
        ON o.doc_id = TRY_CAST(regexp_extract(path, '/(\d{{1,18}})[^/]*/?$', 1) AS BIGINT)
      GROUP BY host),
h AS (SELECT *, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
             string_split(host, '.')[-1] AS suffix FROM c),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
k AS (SELECT {_strength_sql('s')} AS ks, {_strength_sql('d')} AS kd, {_strength_sql('h')} AS kh,
             (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) FROM s) AS overall),
rs AS (SELECT suffix, (bad + ks * overall) / (n + ks) AS rate FROM s, k),
rd AS (SELECT domain, suffix, (bad + kd * rs.rate) / (n + kd) AS rate FROM d JOIN rs USING (suffix), k),
rh AS (SELECT host, n + kh AS weight, (bad + kh * rd.rate) / (n + kh) AS rate
       FROM h JOIN rd USING (domain, suffix), k),
b AS (SELECT host, rate, greatest(0.0, rate - 1.645 * sqrt(rate * (1 - rate) / (weight + 1))) AS lower_bound
      FROM rh),
r AS (SELECT p.*, rate, lower_bound, CASE
          WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
          WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
          WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
          WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
      FROM p JOIN b USING (host))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN lower_bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       round(rate, 6) AS bad_rate, round(lower_bound, 6) AS lower_bound
FROM r
"""


@query(OP6_SQL)
def op6_url_filters(spark, folder):
    """Verdict on every page's url."""
    judged = url_reputation.judge(table(spark, folder, "pages"), table(spark, folder, "labels"))
    return judged.withColumns({c: F.round(c, 6) for c in ("bad_rate", "lower_bound")})


@query()
def op8_toxicity(spark, folder):
    """Toxicity score of every document; the held-out fold is never learned from."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    # A row without an id is in no fold.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    lexicon = toxicity.learn(docs, labels.where(~held_out))
    return toxicity.score(docs, lexicon).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "n_hits",
    )


@query()
def op9_sharding(spark, folder):
    """Sixteen shards of near-equal bytes."""
    return sharding.shard(table(spark, folder, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op10_license_scans(spark, folder):
    """License labels of every document."""
    return license_scan.scan(table(spark, folder, "documents"))


OP12_SQL = r"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
             list_inner_product(a.x, r.x)::BIGINT AS score
      FROM v AS a JOIN v AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query(OP12_SQL)
def op12_hard_negatives(spark, folder):
    """The three hardest negatives for each positive of every fiftieth vector."""
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


def _phrases_sql(n):
    """Places of the phrases of n words."""
    return f"""
        SELECT lang, list_slice(words, i, i + {n - 1}) AS p FROM (
            SELECT lang, words, unnest(range(1, len(words) - {n} + 2)) AS i FROM w WHERE len(words) >= {n})
    """


OP13_SQL = rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM t),
f1 AS (SELECT lang, p, count(*) AS f FROM ({_phrases_sql(1)}) GROUP BY ALL),
fn AS ({" UNION ALL ".join(f"SELECT lang, p, count(*) AS f FROM ({_phrases_sql(n)}) GROUP BY ALL HAVING count(*) >= 100" for n in range(2, 6))}),
f AS (FROM f1 UNION ALL FROM fn),
n AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang),
inner_phrases AS (
    SELECT lang, f, list_slice(p, i, i + m - 1) AS p
    FROM (SELECT *, unnest(range(1, len(p) - m + 2)) AS i
          FROM (SELECT *, unnest(range(2, len(p))) AS m FROM fn WHERE len(p) > 2))),
longer AS (SELECT lang, p, max(f) AS longer FROM inner_phrases GROUP BY ALL),
c AS (SELECT fn.lang, fn.p, fn.f AS a FROM fn LEFT JOIN longer AS o ON o.lang = fn.lang AND o.p = fn.p
      WHERE o.longer IS NULL OR 100 * o.longer < 100 * fn.f),
k AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM c),
s AS (SELECT k.lang, k.p, a, k, x.f AS l, y.f AS r, n.n::BIGINT AS n,
             (1000::HUGEINT * a * n.n::HUGEINT // (x.f::HUGEINT * y.f))::BIGINT AS score
      FROM k JOIN f AS x ON x.lang = k.lang AND x.p = list_slice(k.p, 1, k)
             JOIN f AS y ON y.lang = k.lang AND y.p = list_slice(k.p, k + 1, len(k.p))
             JOIN n ON n.lang = k.lang
      QUALIFY row_number() OVER (PARTITION BY k.lang, k.p ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
       array_to_string(p, ' ') AS phrase, a, l, r, n, score
FROM s QUALIFY rank <= 2000
"""


@query(OP13_SQL)
def op13_phrase_collocations(spark, folder):
    """The 2,000 strongest collocations of every language."""
    return collocations.mine(table(spark, folder, "documents"))


@query()
def op11_lm_scoring(spark, folder):
    """Scores of all documents by a model of those outside the held-out fold."""
    docs = table(spark, folder, "documents")
    # A row without an id is in no fold.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    model = ngram_lm.learn(docs, ~held_out)
    return ngram_lm.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
