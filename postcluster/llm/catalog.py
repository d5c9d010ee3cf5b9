"""Registered queries of the operators, each over its whole table, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postcluster.llm import (
    bpe,
    collocations,
    decontaminate,
    embedding_dedup,
    licenses,
    minhash_dedup,
    mixing,
    quality,
    substring_dedup,
    token_counts,
    toxicity,
    url_filter,
    vector_codes,
)
from postcluster.llm.frames import ROW, find_code
from postcluster.llm.learning import held_out

Query = Callable[[SparkSession, str], DataFrame]

BPE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = bpe.round_trip(docs, public_tokenizers.path(BPE_FILE), keep=["doc_id"])
    return done.select(f"{ROW}.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    done = decontaminate.find_leaks(docs, benchmark, keep=["doc_id"])
    return done.select(f"{ROW}.doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = token_counts.token_counts(docs, public_tokenizers.path(PIECE_FILE), keep=["doc_id"])
    return done.select(f"{ROW}.doc_id", "n_words", "n_tokens", "score")


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = minhash_dedup.near_documents(table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def _near_documents_sql() -> str:
    """Shared shingles counted for every pair that has some; components by closure."""
    share = minhash_dedup.PERCENT
    return f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
sets AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN []::VARCHAR[]
    WHEN len(words) < {minhash_dedup.SHINGLE} THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - {minhash_dedup.SHINGLE - 2}),
      lambda i: array_to_string(words[i:i + {minhash_dedup.SHINGLE - 1}], ' '))) END AS shingles
  FROM w),
one AS MATERIALIZED (SELECT r, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b
  FROM one a JOIN one b ON a.shingle = b.shingle AND a.r <> b.r AND 100 * a.n >= {share} * b.n AND 100 * b.n >= {share} * a.n
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= {share} * (a.n + b.n - count(*))),
reach(r, low) AS (
  SELECT r, doc_id FROM sets
  UNION
  SELECT l.b, reach.low FROM reach JOIN links l ON l.a = reach.r)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, min(low) AS component_id, doc_id = min(low) AS kept
FROM sets JOIN reach USING (r) GROUP BY r, doc_id, shingles"""


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return done.select(f"{ROW}.page_id", "host", "path", "rule", "verdict")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def _near_vectors_sql() -> str:
    """The cosine of every pair of a label; components by closure."""
    return f"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
sound AS MATERIALIZED (
  SELECT * FROM v
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(v, lambda x: x <> 0)) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
  WHERE list_cosine_similarity(a.v, b.v) >= {embedding_dedup.THRESHOLD}),
reach(r, low) AS (
  SELECT r, vec_id FROM v
  UNION
  SELECT l.b, reach.low FROM reach JOIN links l ON l.a = reach.r),
low AS (SELECT r, min(low) AS low FROM reach GROUP BY r),
n AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, low::BIGINT AS component_id, vec_id = low AS kept
FROM v JOIN low USING (r) LEFT JOIN n USING (r)"""


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return done.select(f"{ROW}.doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def _substring_sql() -> str:
    """Every window as a string; the words that a string seen twice covers."""
    width = substring_dedup.WIDTH
    return f"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
windows AS MATERIALIZED (
  SELECT r, i, array_to_string(words[i:i + {width - 1}], ' ') AS sequence
  FROM (SELECT r, words, unnest(range(1, len(words) - {width - 2})) AS i FROM w)),
twice AS (SELECT sequence FROM windows GROUP BY sequence HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + {width})) AS i FROM windows SEMI JOIN twice USING (sequence)),
stay AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept
  FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w) ANTI JOIN gone USING (r, i)
  GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN stay USING (r)"""


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = licenses.scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return done.select(f"{ROW}.doc_id", "n_words", "n_base", "first_word", "last_word",
                       "base_labels", "labels", "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    done = toxicity.score_toxicity(docs, model, keep=["doc_id"])
    return done.select(f"{ROW}.doc_id", held_out(F.col(f"{ROW}.doc_id")).alias("held_out"), "score", "predicted")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels)
    done = quality.score_quality(docs, model, keep=["doc_id"])
    return done.select(f"{ROW}.doc_id", held_out(F.col(f"{ROW}.doc_id")).alias("held_out"), "score", "predicted")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def _collocations_sql() -> str:
    """Every phrase of every piece counted, then every cut of the frequent ones."""
    longest, least = collocations.LONGEST, collocations.LEAST
    names = [f"w{i}" for i in range(1, longest + 1)]
    leads = ", ".join(f"lead(w, {i}) OVER x AS w{i + 1}" for i in range(1, longest))
    counts = "\n  UNION ALL ".join(
        f"SELECT lang, {k} AS k, [{', '.join(names[:k])}] AS ws, count(*) AS a FROM runs "
        f"WHERE {names[k - 1]} IS NOT NULL GROUP BY ALL" for k in range(1, longest + 1))
    return f"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, ws FROM (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents))),
words AS (SELECT lang, piece, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM pieces),
runs AS (SELECT lang, w AS w1, {leads} FROM words WINDOW x AS (PARTITION BY piece ORDER BY i)),
total AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
f AS MATERIALIZED (SELECT * FROM ({counts}) WHERE a >= {least}),
inside AS (
  SELECT lang, ws, max(a) AS longer FROM (
    SELECT lang, ws[1:k - 1] AS ws, a FROM f WHERE k > 2
    UNION ALL SELECT lang, ws[2:k] AS ws, a FROM f WHERE k > 2) GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.ws, c.a, j AS cut, l.a AS l, r.a AS r, n,
    (1000 * c.a::HUGEINT * n) // (l.a::HUGEINT * r.a) AS score
  FROM (SELECT f.*, unnest(range(1, k)) AS j FROM f WHERE k > 1) c
  JOIN f l ON l.lang = c.lang AND l.ws = c.ws[1:j]
  JOIN f r ON r.lang = c.lang AND r.ws = c.ws[j + 1:c.k]
  JOIN total t ON t.lang = c.lang
  LEFT JOIN inside i ON i.lang = c.lang AND i.ws = c.ws
  WHERE i.longer IS NULL OR 100 * i.longer < {collocations.COVERED} * c.a),
best AS (
  SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
WHERE rank <= {collocations.TOP}"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def _codes_sql() -> str:
    """Every part against every entry, the rounds written out."""
    parts, entries, scale = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.SCALE
    steps = []
    for r in range(vector_codes.ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec, part, arg_min(entry, dist * {entries} + entry) AS entry, min(dist) AS dist FROM (
    SELECT x.vec, x.part, c.entry, sum((x.x - c.x) * (x.x - c.x)) AS dist
    FROM comp x JOIN c{r} c ON c.part = x.part AND c.pos = x.pos GROUP BY ALL) GROUP BY ALL)""")
        if r < vector_codes.ROUNDS:
            steps.append(f"""m{r} AS (
  SELECT a.part, a.entry, x.pos, floor_div(sum(x.x), count(*)) AS x
  FROM a{r} a JOIN comp x ON x.vec = a.vec AND x.part = a.part GROUP BY ALL),
c{r + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, c.pos, coalesce(m.x, c.x)::BIGINT AS x
  FROM c{r} c LEFT JOIN m{r} m ON m.part = c.part AND m.entry = c.entry AND m.pos = c.pos)""")
    last = vector_codes.ROUNDS
    steps = ",\n".join(steps).replace("floor_div(sum(x.x), count(*))", "(sum(x.x) - (sum(x.x) % count(*) + count(*)) % count(*)) // count(*)")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS vec, vec_id, label,
    list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comp AS MATERIALIZED (
  SELECT vec, ((i - 1) // (len(v) // {parts}))::INT AS part, ((i - 1) % (len(v) // {parts}))::INT AS pos, x
  FROM (SELECT vec, v, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept)),
c0 AS MATERIALIZED (SELECT part, (vec - 1)::INT AS entry, pos, x FROM comp WHERE vec <= {entries}),
{steps},
codes AS (
  SELECT vec, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error
  FROM a{last} GROUP BY vec)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM c{last}) AS codebooks_sha256
FROM kept JOIN codes USING (vec)"""


#: What a document's label makes of its chance in the mix.
QUALITY_WEIGHTS = {0: 0.5, 1: 2.0}


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.create_map(*[F.lit(x) for pair in QUALITY_WEIGHTS.items() for x in pair])
    labels = table(spark, sf_dir, "labels").select("doc_id", known[F.col("quality").cast("int")].alias("quality"))
    done = mixing.mix_sources(table(spark, sf_dir, "documents"), labels, keep=["doc_id"])
    return done.select(f"{ROW}.doc_id", "size", "source_size", "target", "taken")


def _mixing_sql() -> str:
    """Targets by a recursive rate, keys from the same hash, prefix sums by window."""
    turn = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
    weight = " ".join(f"WHEN {label} THEN {w}" for label, w in QUALITY_WEIGHTS.items())
    limit = f"{mixing.MOST} * source_size"
    return f"""
WITH RECURSIVE good AS (
  SELECT doc_id, max(CASE quality {weight} END) AS good FROM labels GROUP BY doc_id),
d AS (
  SELECT d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('{mixing.SEED}:' || d.doc_id), 1, 13))::BIGINT + 0.5) / {float(1 << 52)}::DOUBLE AS u,
    coalesce(good, 1.0)::DOUBLE AS good
  FROM documents d LEFT JOIN good g ON g.doc_id = d.doc_id),
s AS (
  SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} {turn} END)::DOUBLE AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
rate(i, r) AS (
  SELECT 0, 0.0::DOUBLE
  UNION ALL
  SELECT i + 1, (SELECT (sum(source_size) - sum(CASE WHEN r * w > {limit} THEN {limit} ELSE 0 END))
                   / sum(CASE WHEN r * w > {limit} THEN 0.0 ELSE w END) FROM s)
  FROM rate WHERE i < 30),
t AS (
  SELECT source, source_size, least((SELECT max(r) FROM rate) * w, {limit}::DOUBLE) AS target FROM s),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
k AS (
  SELECT d.*, b.source_size, b.target, b.epochs, floor(target + 0.5)::BIGINT - epochs * source_size AS fraction,
    sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / good, d.doc_id::VARCHAR, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, fraction - before)))::BIGINT AS taken
FROM k"""


def _url_sql() -> str:
    """The rules as a CASE; the link graph with its steps written out."""
    ordered = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))

    def case(value) -> str:
        whens = " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(v, h + p)}'"
            for v, h, p in ordered)
        return f"CASE {whens} END"

    lower = f"'{url_filter.UPPER}', '{url_filter.LOWER}'"
    link = url_filter.LINK_HOST.replace("'", "''")
    steps = []
    for i in range(1, url_filter.STEPS + 1):
        steps.append(f"""r{i} AS (
  SELECT s.kind, s.host, s.seed, {1 - url_filter.DAMPING} * s.seed + {url_filter.DAMPING} * coalesce(g.got, 0) AS rank
  FROM start s LEFT JOIN (
    SELECT kind, host, sum(got) AS got FROM (
      SELECT f.kind, f.b AS host, r.rank * f.w AS got FROM r{i - 1} r JOIN flows f ON r.kind = f.kind AND r.host = f.a
      UNION ALL
      SELECT r.kind, r.host, r.rank FROM r{i - 1} r WHERE NOT EXISTS (
        SELECT 1 FROM flows f WHERE f.kind = r.kind AND f.a = r.host))
    GROUP BY ALL) g ON g.kind = s.kind AND g.host = s.host)""")
    return f"""
WITH parts AS (
  SELECT page_id, html,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {lower}) AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
judged AS (SELECT *, {case(lambda v, r: r)} AS rule, {case(lambda v, r: v)} AS ruled FROM parts),
seeds AS (
  SELECT host, CASE WHEN t > {url_filter.SEED_SHARE} THEN t ELSE 0 END AS trust,
    CASE WHEN d > {url_filter.SEED_SHARE} THEN d ELSE 0 END AS distrust
  FROM (
    SELECT host, avg(CASE WHEN ruled = 'allow' THEN 1.0 ELSE 0.0 END) AS t,
      avg(CASE WHEN ruled = 'block' THEN 1.0 ELSE 0.0 END) AS d
    FROM judged WHERE host <> '' GROUP BY host)),
edges AS (
  SELECT src, dst, count(*) AS n FROM (
    SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), {lower}) AS dst FROM parts)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
both_ways AS (
  SELECT 'trust' AS kind, src AS a, dst AS b, n FROM edges
  UNION ALL SELECT 'distrust', dst, src, n FROM edges),
flows AS (SELECT kind, a, b, n / sum(n) OVER (PARTITION BY kind, a) AS w FROM both_ways),
hosts AS (SELECT host FROM seeds UNION SELECT src FROM edges UNION SELECT dst FROM edges),
start AS (
  SELECT 'trust' AS kind, h.host, coalesce(s.trust, 0) AS seed FROM hosts h LEFT JOIN seeds s ON s.host = h.host
  UNION ALL
  SELECT 'distrust', h.host, coalesce(s.distrust, 0) FROM hosts h LEFT JOIN seeds s ON s.host = h.host),
r0 AS (SELECT kind, host, seed, seed AS rank FROM start),
{", ".join(steps)},
bad AS (
  SELECT host FROM r{url_filter.STEPS} GROUP BY host
  HAVING sum(CASE WHEN kind = 'distrust' THEN rank ELSE 0 END) >= {url_filter.BLOCK_AT}
    AND sum(CASE WHEN kind = 'distrust' THEN rank ELSE 0 END) > sum(CASE WHEN kind = 'trust' THEN rank ELSE 0 END))
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged"""


def _notice_pattern(template: str) -> str:
    """A template as a regular expression over words that a space follows, piece by piece."""
    out = " "
    for piece in re.split(r"(<<optional\b|<<var [0-9-]+>>|>>)", template):
        if piece == "<<optional":
            out += "(?:"
        elif piece == ">>":
            out += ")?"
        elif piece.startswith("<<var"):
            limits = piece[6:-2].split("-")
            out += f"(?:[^ ]+ ){{{limits[0] if len(limits) > 1 else 1},{limits[-1]}}}"
        else:
            out += "".join(f"{w} " for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", piece.lower()))
    return out


def _licenses_sql() -> str:
    """Words by regular expression; a phrase's places by the words before it."""
    norm = "' ' || array_to_string(words, ' ') || ' '"
    hits = " + ".join(
        f"coalesce(len(list_filter(range(1, len(words) + 1), lambda i: array_to_string("
        f"words[i:i + {len(p.split()) - 1}], ' ') = '{p}')), 0)" for p in licenses.BASE_PHRASES)
    starts = ", ".join(
        f"list_filter(range(1, len(words) + 1), lambda i: array_to_string("
        f"words[i:i + {len(p.split()) - 1}], ' ') = '{p}')" for p in licenses.BASE_PHRASES)
    base = ", ".join(f"CASE WHEN contains(line, ' {p} ') THEN '{label}' END"
                     for p, label in licenses.BASE_PHRASES.items())
    more = ", ".join(f"CASE WHEN regexp_matches(line, '{_notice_pattern(t)}') THEN '{label}' END"
                     for label, t in licenses.standard_templates().items())

    def joined(items: str) -> str:
        return f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{items}], lambda x: x IS NOT NULL))), ','), '')"

    return f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
l AS (SELECT doc_id, words, {norm} AS line FROM w),
s AS (
  SELECT doc_id, line, len(words) AS n_words,
    CASE WHEN regexp_matches(line, ' ({"|".join(licenses.BASE_PHRASES)}) ')
      THEN flatten([{starts}]) ELSE []::BIGINT[] END AS starts
  FROM l)
SELECT doc_id, n_words::BIGINT AS n_words, len(starts)::BIGINT AS n_base,
  (list_min(starts) - 1)::BIGINT AS first_word, (list_max(starts) - 1)::BIGINT AS last_word,
  {joined(base)} AS base_labels, {joined(base + ", " + more)} AS labels,
  CASE WHEN len(list_filter([{more}], lambda x: x IS NOT NULL)) > 0 THEN {licenses.FULL}
       WHEN len(starts) > 0 THEN {licenses.PHRASE_ONLY} ELSE {licenses.NONE} END::DOUBLE AS score
FROM s"""


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_decontaminate": op2_decontaminate,
    "op3_token_counts": op3_token_counts,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_url_filters": op5_url_filters,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_licenses": op8_licenses,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_vector_codes": op12_vector_codes,
    "op13_mixing": op13_mixing,
}


def oracle_queries() -> dict[str, str]:
    return {
        "op4_minhash_dedup": _near_documents_sql(),
        "op5_url_filters": _url_sql(),
        "op6_embedding_dedup": _near_vectors_sql(),
        "op7_substring_dedup": _substring_sql(),
        "op8_licenses": _licenses_sql(),
        "op11_collocations": _collocations_sql(),
        "op12_vector_codes": _codes_sql(),
        "op13_mixing": _mixing_sql(),
    }
