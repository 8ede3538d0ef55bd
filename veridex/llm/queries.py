"""Queries of this folder's operators over their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, collocations, jaccard, media, negatives, packing, pii, ppm, quality, suffixes, toxicity, urls
from .common import read_documents


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_documents(spark, sf_dir))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.ppm_scores(read_documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return toxicity.toxicity_scores(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(read_documents(spark, sf_dir))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read_documents(spark, sf_dir))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read_documents(spark, sf_dir))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op7_chat_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.dialogues(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(read_documents(spark, sf_dir))


def op8_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_links(read_documents(spark, sf_dir))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), urls.train(urls.seeds(spark)))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_documents(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_lm_scoring, op3_toxicity, op4_media_columns, op5_pii, op6_suffix_dedup, op7_chat_formatting, op7_chat_dialogues, op8_jaccard_join, op8_jaccard_links, op9_byte_bpe, op10_packing, op11_url_filters, op12_collocations, op13_hard_negatives)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op1_quality_rules": f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, doc_id, host, text, {_WORDS.format("text")} AS ws FROM d),
win AS (SELECT k, i, list_slice(ws, i, i + 7) AS x FROM (SELECT k, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, x) AS c FROM win) WHERE c > 1),
repw AS (SELECT k, count(DISTINCT i + j) AS n FROM rep, (SELECT unnest(range(0, 8)) AS j) GROUP BY k),
raw AS (SELECT k, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT k, host, text, line, trim(regexp_replace({_LOWER.format("line")}, '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS norm, len({_WORDS.format("line")}) AS n FROM raw WHERE len({_WORDS.format("line")}) > 0),
dup AS (SELECT k, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY k),
hosts AS (SELECT host, count(DISTINCT text) AS n FROM d GROUP BY host),
freq AS (SELECT l.host, norm FROM lines l JOIN hosts h USING (host) GROUP BY l.host, norm, h.n HAVING count(DISTINCT text) > {quality.MIN_DOCS} AND count(DISTINCT text) > {quality.MAX_SHARE} * h.n),
lost AS (SELECT k, sum(l.n) AS n FROM lines l JOIN freq USING (host, norm) GROUP BY k),
f AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(length(array_to_string(ws, '')), 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
 coalesce(dup.n, 0) AS n_dup_lines, coalesce(repw.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS n_removed_words
 FROM w LEFT JOIN dup USING (k) LEFT JOIN repw USING (k) LEFT JOIN lost USING (k))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
 (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
 NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (n_words - n_removed_words < {quality.MIN_KEPT} * n_words) AS kept,
 CAST(n_removed_words AS BIGINT) AS n_removed_words
FROM f""",
    "op7_chat_formatting": """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.conv_id, p.perspective, t.turn, t.speaker,
 CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS message_role,
 CASE WHEN speaker <> 'system' AND speaker <> perspective THEN speaker END AS message_name, t.text
 FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id)
SELECT conv_id, perspective, turn, speaker, message_role, message_name,
 '<|' || message_role || coalesce(' name=' || replace(message_name, '<|', '<\\|'), '') || '|>' || replace(text, '<|', '<\\|') || '<|end|>' AS rendered,
 CASE WHEN speaker = perspective AND speaker <> 'system' THEN 1 ELSE 0 END AS mask
FROM r""",
    "op8_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, list_aggregate(list_slice(ws, i, i + {jaccard.WIDTH - 1}), 'string_agg', ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {jaccard.WIDTH - 1}, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= {jaccard.PERCENT} * (x.n + y.n - k)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)""",
}

# the same links, counted
ORACLES["op8_jaccard_links"] = ORACLES["op8_jaccard_join"].replace("\nSELECT d.doc_id, CAST(coalesce(n.n, 0)", ",\ncounted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)\nSELECT d.doc_id, CAST(coalesce(k.n_links, 0) AS BIGINT) AS n_links, CAST(coalesce(n.n, 0)").replace("LEFT JOIN n USING (doc_id)", "LEFT JOIN n USING (doc_id) LEFT JOIN counted k ON k.a = d.doc_id")

# the rendered turns, joined
ORACLES["op7_chat_dialogues"] = f"""
WITH x AS ({ORACLES["op7_chat_formatting"]}),
o AS (SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, rendered ROWS UNBOUNDED PRECEDING) AS ending FROM x)
SELECT conv_id, perspective, string_agg(rendered, '' ORDER BY ending) AS dialogue,
 coalesce(string_agg(CAST(ending - length(rendered) AS BIGINT) || ':' || CAST(ending AS BIGINT), ',' ORDER BY ending) FILTER (WHERE mask = 1), '') AS learnt
FROM o GROUP BY conv_id, perspective"""


_GRAMS = "list_transform(range(1, length({0}) - {2} + 2), lambda i: CAST('0x' || substr(md5('{1}' || substr({0}, i, {2})), 1, 3) AS INTEGER))"
_URL = f"""SELECT *, coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
 coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path"""
_BUCKETS = "list_distinct(flatten([" + ", ".join(_GRAMS.format(t, m, n) for t, m in (("('^' || host || '$')", "h"), (_LOWER.format("path"), "p")) for n in urls.SIZES) + "]))"
_FITS = " ".join(f"WHEN ends_with('.' || host, '.{r[: r.index('/')]}') AND starts_with(path, '{r[r.index('/') :]}') THEN '{{}}'" for _, r in sorted(urls.RULES, key=lambda r: -len(r[1])))
ORACLES["op11_url_filters"] = f"""
WITH RECURSIVE seed AS (SELECT * FROM (VALUES {", ".join(f"('{u}', {k}.0)" for k, some in ((1, urls.BLOCKED), (0, urls.ALLOWED)) for u in some)}) t(url, y)),
x AS (SELECT url, CAST(y AS DOUBLE) AS y, {_BUCKETS} AS x FROM ({_URL} FROM seed)),
one AS (SELECT list(x ORDER BY url) AS x, list(y ORDER BY url) AS y FROM x),
gram AS MATERIALIZED (SELECT x, y, list_transform(x, lambda a: list_transform(x, lambda b: len(list_intersect(a, b)) / sqrt(len(a) * len(b)) + 1)) AS k FROM one),
fit AS (SELECT 0 AS t, list_transform(y, lambda v: CAST(0 AS DOUBLE)) AS alpha FROM one
 UNION ALL SELECT t + 1, list_transform(range(1, len(y) + 1), lambda i: alpha[i] * {1 - urls.RATE * urls.DECAY} + {urls.RATE} * (y[i] - 1 / (1 + exp(-list_inner_product(k[i], alpha))))) FROM fit, gram WHERE t < {urls.STEPS}),
each AS (SELECT unnest(alpha) AS a, unnest(x) AS x FROM fit, gram WHERE t = {urls.STEPS}),
bucket AS (SELECT b, sum(round(a / sqrt(len(x)) * 1e9)) AS w FROM (SELECT a, x, unnest(x) AS b FROM each) GROUP BY b),
bias AS (SELECT sum(round(a * 1e9)) AS bias FROM each),
page AS (SELECT row_number() OVER () AS k, page_id, host, path, {_BUCKETS} AS x FROM ({_URL} FROM pages)),
score AS (SELECT k, sum(w) AS s FROM (SELECT k, unnest(x) AS b FROM page) JOIN bucket USING (b) GROUP BY k)
SELECT page_id, host, path, CASE {_FITS.format(*(r for _, r in sorted(urls.RULES, key=lambda r: -len(r[1]))))} END AS rule,
 CASE {_FITS.format(*(a for a, _ in sorted(urls.RULES, key=lambda r: -len(r[1]))))}
 WHEN coalesce(s, 0) / sqrt(greatest(len(x), 1)) + bias > 0 THEN 'block' ELSE 'allow' END AS verdict
FROM page LEFT JOIN score USING (k), bias"""

ORACLES["op12_collocations"] = f"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("text")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
total AS (SELECT lang, sum(len(ws)) AS n FROM p GROUP BY lang),
place AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p),
f AS (SELECT lang, ws[i:i + k - 1] AS ws, count(*) AS f FROM place, (SELECT unnest(range(1, {collocations.LONGEST + 1})) AS k) WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
c AS (SELECT *, array_to_string(ws, ' ') AS phrase FROM f WHERE len(ws) >= 2),
cuts AS (SELECT c.lang, phrase, c.f AS a, x.f AS l, y.f AS r, n, len(x.ws) AS k, 1000 * CAST(c.f AS HUGEINT) * CAST(n AS HUGEINT) // (CAST(x.f AS HUGEINT) * CAST(y.f AS HUGEINT)) AS score
 FROM (SELECT *, unnest(range(1, len(ws))) AS j FROM c) c JOIN f x ON x.lang = c.lang AND x.ws = c.ws[:j] JOIN f y ON y.lang = c.lang AND y.ws = c.ws[j + 1:] JOIN total t ON t.lang = c.lang
 WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.lang = c.lang AND len(b.ws) > len(c.ws) AND b.f >= c.f AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= {collocations.TOP}"""

ORACLES["op13_hard_negatives"] = f"""
WITH v AS (SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x
 FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (SELECT a.k AS a, a.vec_id AS anchor_id, a.label = b.label AS same, b.k AS b, b.vec_id, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score FROM v a, v b WHERE a.vec_id % {negatives.EVERY} = 0 AND a.k <> b.k),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= {negatives.POSITIVES})
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND {negatives.LOWER} * p.score <= 100 * s.score AND 100 * s.score <= {negatives.UPPER} * p.score
QUALIFY rank <= {negatives.NEGATIVES}"""
