"""One query for each operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_documents, library_codec
from .collocations import collocations
from .common import passing, shared_dir, table
from .html import extract_main_text
from .interactions import audit, judged
from .itq import embedding_dedup
from .licences import scan
from .lines import BOILERPLATE, ENDS, clean_lines
from .mixing import lm_scores
from .ngram import ngram_join
from .packing import TreeBins, assemble, cut, pack, tightest
from .quality import quality_scores
from .warc import as_records, read_warc, write_warc
from .wordbpe import word_codec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op8_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_lines(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")


ORACLE_SQL["op8_line_cleaning"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT r, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(0, 8) AS t(k) GROUP BY r),
lines AS (SELECT r, line, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS lw FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
verdict AS (SELECT r, line, len(array_to_string(lw, '')) AS chars,
  (len(line) - len(replace(line, '|', '')) >= 3 AND 2 * (len(line) - len(replace(line, '|', ''))) >= len(lw) - (len(line) - len(replace(line, '|', ''))))
  OR len(line) - len(regexp_replace(line, '[#*$%&|<>{{}}~^=]', '', 'g')) > 0.1 * len(line)
  OR (len(lw) < 3 AND NOT regexp_matches(line, '{ENDS.replace("'", "''")}[\x20\x09-\x0D]*$'))
  OR (len(lw) >= 3 AND len(line) - len(regexp_replace(line, '\p{{Lu}}', '', 'g')) > 0.5 * len(array_to_string(lw, '')))
  OR (len(lw) <= 20 AND ({" OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)})) AS fails FROM lines),
byline AS (SELECT r, count(*) - count(DISTINCT line) AS dup, coalesce(sum(chars) FILTER (WHERE fails), 0) AS lost FROM verdict GROUP BY r),
base AS (SELECT r, doc_id, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars,
  (len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols FROM w),
res AS (SELECT doc_id, n_words, word_chars, n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_chars
  FROM base LEFT JOIN rep USING (r) LEFT JOIN byline USING (r))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost_chars <= 0.5 * word_chars AS kept FROM res
"""


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = cut(table(spark, sf_dir, "documents"), lambda: word_codec(path).encode, 4096, end_id=1)
    return pack(pieces, lambda counts: tightest(counts, 4096)).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


@query
def op2_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    pieces = cut(table(spark, sf_dir, "documents"), lambda: library_codec(path, pattern).encode, 2048, end_id=50256, ids=True, width=2)
    return assemble(pack(pieces, TreeBins(2048)), 2048, width=2, pad=50256)


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


@query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept", "class_id")


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(as_records(table(spark, sf_dir, "pages")), path)
    passing(spark, path)
    number = lambda c: F.regexp_extract(c, r"(-?\d+)>$", 1).try_cast("long")
    back = read_warc(spark, path, payloads=False).where("kind = 'record'")
    return back.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.when(F.col("record_type") == "revisit", number("refers_to")).alias("refers_to"))


ORACLE_SQL["op1_warc_round_trip"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS n FROM pages),
q AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN last IS NOT NULL AND last IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last IS NOT NULL AND last IS DISTINCT FROM page_id THEN last END AS refers_to FROM q
"""


@query
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


@query
def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


@query
def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))).drop("filter")


ORACLE_SQL["op12_filter_interactions"] = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
lowest AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT + 4 * (100 * (len(text) - len(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * len(text))::INT
  + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask
  FROM w JOIN lowest USING (text) LEFT JOIN known USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31),
s AS (SELECT filter_order, step::INT AS step, bits[step] AS b, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, range(1, 6) AS t(step)),
r AS (SELECT part, filter_order, step, b,
  coalesce(sum(n) FILTER (WHERE mask & (before | b) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & b <> 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (WHERE mask & before <> 0 AND mask & b <> 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (WHERE mask = b), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & b <> 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & b <> 0), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, b)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, b))::BIGINT AS shapley FROM r
"""


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op13_collocations"] = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS m))),
f AS (SELECT lang, m, phrase, count(*) AS n FROM g GROUP BY lang, m, phrase),
size AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND n >= 10),
inner_ AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a AS longer FROM c WHERE m = 3),
kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.longer >= 50 * c.a)),
cut AS (SELECT kept.*, k, array_to_string(w[1:k], ' ') AS one, array_to_string(w[k + 1:m], ' ') AS two FROM kept, (SELECT unnest([1, 2]) AS k) WHERE k < m),
s AS (SELECT cut.lang, cut.phrase, a, k, x.n AS l, y.n AS r, ((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n))::BIGINT AS score FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = one JOIN f y ON y.lang = cut.lang AND y.phrase = two),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b QUALIFY rank <= 2000)
SELECT t.lang, rank, phrase, a, l, r, size.n, score FROM t JOIN size ON size.lang = t.lang
"""
