"""The registered queries of the operators, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import collocations, mixing, packing, quality, resampling, sentence_pieces, simhash, suffix_dedup, token_count, token_files, top_k, warc, winnow
from tablewright.llm.common import stored, table, tokenizer_path, words_in
from tablewright.session import scratch_path


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole text: how many, their checksum, and whether they decode to the text."""
    found = sentence_pieces.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return found.select("row.doc_id", F.octet_length("row.text").cast("long").alias("n_bytes"), "n_pieces", "ids_crc32", "same")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector among all others."""
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 50k byte-level vocabulary."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document, the threshold of its language, and the decision."""
    found = quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.drop("digest")


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of every document and of its edited text."""
    found = winnow.fingerprints_of_edits(table(spark, sf_dir, "documents"))
    texts = [winnow.spelled(F.col(c)).alias(n) for c, n in (("marks", "fingerprint"), ("edited_marks", "edited_fingerprint"))]
    return found.select("doc_id", "n_chars", "edited_sha256", *texts, "near_edited", "near_next")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that came before."""
    return suffix_dedup.removed(table(spark, sf_dir, "documents"), length=100)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to a file set and read back."""
    folder = scratch_path(spark, "token-files")
    token_files.write_ids(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), folder)
    return token_files.read_ids(spark, folder, ids=False)


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl of the pages: each is fetched once, and asked for again later with its validators.

    Of ten second requests one has a weak tag, one a wrong tag, one a date alone and one nothing; all
    send a content type that must not be taken over, and a fresh cache-control.
    """
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    moment = lambda seconds: F.timestamp_seconds(F.lit(1_700_000_000) + seconds)
    number, case = F.col("page_id"), F.coalesce(F.pmod("page_id", F.lit(10)), F.lit(0))
    since = F.date_format(moment(number), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    header = lambda *pairs: F.map_filter(F.create_map(*(F.lit(x) if isinstance(x, str) else x for p in pairs for x in p)), lambda k, v: v.isNotNull())
    full = header(("content-type", "text/html; charset=utf-8"), ("etag", tag), ("last-modified", since), ("cache-control", "max-age=60"))
    sent = F.when(case == 3, F.concat(F.lit("W/"), tag)).when(case == 5, F.lit('"stale"')).when(~case.isin(7, 9), tag)
    again = header(("content-type", "text/plain"), ("etag", sent), ("last-modified", F.when(case != 9, since)), ("cache-control", F.concat(F.lit("max-age="), case.cast("string"))))
    first = pages.select(F.concat(F.lit("urn:page:"), number).alias("record_id"), F.lit("response").alias("kind"), "url", moment(number * 10).alias("time"), full.alias("headers"), F.col("html").alias("payload"))
    second = pages.select(F.concat(F.lit("urn:visit:"), number).alias("record_id"), F.lit("revisit").alias("kind"), "url", moment(number * 20 + 5).alias("time"), again.alias("headers"), F.lit(None).cast("string").alias("payload"))
    return first.unionByName(second)


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl of all pages written as WARC, read back, and its revisits resolved."""
    folder = scratch_path(spark, "warc")
    warc.write_warc(captures_of(table(spark, sf_dir, "pages")), folder)
    body = {"html_md5": F.md5("payload"), "html_bytes": F.octet_length("payload").cast("long")}
    slim = stored(warc.read_warc(spark, folder).withColumns(body).drop("payload"), "captures")
    found = warc.resolve_revisits(slim, carried=("html_md5", "html_bytes"))
    number = lambda c: F.regexp_extract(c, r"(-?\d+)$", 1).cast("long")
    return found.select(
        number(F.col("record_id")).alias("visit_id"), number(F.col("response_id")).alias("page_id"), "canonical_url", "outcome",
        F.col("headers")["content-type"].alias("content_type"), F.col("headers")["cache-control"].alias("cache_control"), "html_md5", "html_bytes",
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    sizes = table(spark, sf_dir, "documents").select("doc_id", "source", words_in(F.col("text")).alias("size"))
    mixed = mixing.systematic_mix(stored(sizes, "sizes"), F.col("size"))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two to five words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"), threshold=100, longest=5, best=2000, absorb=100)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sequence and place every piece of every document has."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), capacity=2048, ids=False)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in a draw towards the benchmark's texts."""
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = resampling.resample(docs, target, percent=5, min_words=20, longest=3, buckets=10_000, seed=42, keep=["doc_id"])
    return found.select("row.doc_id", "n_features", "weight", "score", "rank")


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""

OP9_SQL = r"""
WITH p AS (
  SELECT *, page_id * 10 AS t, page_id * 20 + 5 AS t2, page_id % 10 AS k, substr(md5(html), 1, 16) AS tag,
         regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?', ['s', 'h', 'p', 'q']) AS u
  FROM pages),
c AS (
  SELECT *, lower(u.s) || '://'
         || regexp_replace(lower(u.h), CASE lower(u.s) WHEN 'http' THEN ':80$' ELSE ':443$' END, '')
         || CASE WHEN u.p = '' THEN '/' ELSE u.p END
         || CASE WHEN len(u.q) > 1 THEN '?' || array_to_string(list_sort(string_split(substr(u.q, 2), '&')), '&')
                 ELSE '' END AS canonical_url
  FROM p),
visits AS (
  SELECT page_id AS visit_id, canonical_url, t2, k, page_id AS since, CASE WHEN k NOT IN (7, 9) THEN
         CASE WHEN k = 5 THEN 'stale' ELSE tag END END AS sent
  FROM c),
met AS (
  SELECT v.visit_id, v.canonical_url, v.k, v.sent, v.since, c.page_id, c.tag, c.html,
         row_number() OVER (PARTITION BY v.visit_id ORDER BY c.t DESC NULLS LAST) AS r
  FROM visits v LEFT JOIN c ON c.canonical_url = v.canonical_url AND c.t < v.t2),
judged AS (
  SELECT *, CASE WHEN page_id IS NULL THEN 'orphan' WHEN k = 9 THEN 'unvalidated'
                 WHEN coalesce(sent = tag, since = page_id) THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM met WHERE r = 1)
SELECT visit_id, page_id, canonical_url, outcome,
       CASE WHEN outcome IN ('resolved', 'unvalidated') THEN 'text/html; charset=utf-8' ELSE 'text/plain' END
         AS content_type,
       'max-age=' || k AS cache_control,
       CASE WHEN outcome IN ('resolved', 'unvalidated') THEN md5(html) END AS html_md5,
       CASE WHEN outcome IN ('resolved', 'unvalidated') THEN strlen(html) END::BIGINT AS html_bytes
FROM judged
"""

OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size,
         [1, 2, 3][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM per),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM per)
              - coalesce(sum(3 * source_size) OVER filled, 0))::DOUBLE
            / ((SELECT sum(w) FROM weighed) - coalesce(sum(w) OVER filled, 0))::DOUBLE AS level
  FROM weighed
  WINDOW filled AS (ORDER BY 3 * source_size / w::DOUBLE, source ASC NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least((3 * source_size)::DOUBLE, w * (SELECT max(level) FROM levels)) AS target
  FROM levels),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id % 1024, doc_id) AS r,
         ('0x' || substr(md5('mix' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM sized)
SELECT doc_id, size, source_size, target,
       ((floor(r * rate + u) - floor((r - 1) * rate + u)) * size)::BIGINT AS taken
FROM (SELECT ranked.*, source_size, target,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 1.0 END AS rate
      FROM ranked JOIN targets ON ranked.source IS NOT DISTINCT FROM targets.source)
"""

OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
runs AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM runs GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM runs),
grams AS (SELECT lang, w[i:i + m - 1] AS p, len(w[i:i + m - 1]) AS m
          FROM places, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE i + m - 1 <= len(w)),
f AS MATERIALIZED (SELECT lang, p, any_value(m) AS m, count(*)::HUGEINT AS a FROM grams GROUP BY lang, p HAVING count(*) >= 100),
kept AS (
  SELECT * FROM f c WHERE c.m > 1 AND NOT EXISTS (
    SELECT 1 FROM (SELECT lang, a, p[1:m - 1] AS q FROM f WHERE m > 2
                   UNION ALL SELECT lang, a, p[2:m] AS q FROM f WHERE m > 2) longer
    WHERE longer.lang = c.lang AND longer.q = c.p AND 100 * longer.a >= 100 * c.a)),
cuts AS (
  SELECT c.lang, c.p, c.a, k, x.a AS l, y.a AS r, n, (1000 * c.a * n) // (x.a * y.a) AS score
  FROM (SELECT lang, p, m AS size, a, unnest(range(1, m)) AS k FROM kept) c
  JOIN totals ON totals.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.p = c.p[1:k]
  JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:size]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
  SELECT *, array_to_string(p, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank
  FROM lowest)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

QUERIES = {
    "op1_sentence_pieces": op1_sentence_pieces,
    "op2_top_k": op2_top_k,
    "op3_simhash": op3_simhash,
    "op4_token_counts": op4_token_counts,
    "op5_quality": op5_quality,
    "op6_winnowing": op6_winnowing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_token_files": op8_token_files,
    "op9_warc_revisits": op9_warc_revisits,
    "op10_mixing": op10_mixing,
    "op11_collocations": op11_collocations,
    "op12_packing": op12_packing,
    "op13_resampling": op13_resampling,
}
ORACLES = {"op2_top_k": OP2_SQL, "op9_warc_revisits": OP9_SQL, "op10_mixing": OP10_SQL, "op11_collocations": OP11_SQL}
