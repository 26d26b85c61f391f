"""Registered queries of the operators, and SQL for those that have it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradestar.llm import decontam, langid, licenses, mixing, packing, prefix_trie, simhash, spelling, token_store, toxicity, url_filter, warc, weak_quality
from tradestar.llm.common import read_table
from tradestar.session import scratch_path


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.annotate(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"), ["doc_id"])


def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    made = warc.derive(warc.responses(read_table(spark, sf, "pages")), ["page_id"])
    return made.drop("record")


def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(read_table(spark, sf, "pages"), read_table(spark, sf, "documents"))


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.judge(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf, "pages").select("page_id", "url"), url_filter.labelled_urls(spark))


def op6_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf, "documents"), ["doc_id"]).drop("detections")


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.replicate(read_table(spark, sf, "documents"))


def token_records(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = scratch_path(spark, "token_store")
    return token_store.write_store(docs, path, tokenizer_path(), added_tokens=True).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_token_store(spark: SparkSession, sf: str) -> DataFrame:
    return token_records(spark, read_table(spark, sf, "documents"))


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return weak_quality.judge(read_table(spark, sf, "documents"), ["doc_id"])


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(found["fp"]).alias("fingerprint"), "component_id")


def packing_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op11_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack_texts(read_table(spark, sf, "documents"), packing_tokenizer_path())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(spelling.occurrences(read_table(spark, sf, "documents"))))


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.with_shared_heads(prefix_trie.sequences(read_table(spark, sf, "conversations")))).drop("first_rank", "last_rank")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_warc": op2_warc,
    "op3_language": op3_language,
    "op4_toxicity": op4_toxicity,
    "op5_url_filter": op5_url_filter,
    "op6_licenses": op6_licenses,
    "op7_mixing": op7_mixing,
    "op8_token_store": op8_token_store,
    "op9_quality_rules": op9_quality_rules,
    "op10_simhash": op10_simhash,
    "op11_packing": op11_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_prefix_trie": op13_prefix_trie,
}

OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS k, unnest(list_transform(range(0, len(w) - least(13, len(w)) + 1), lambda i: array_to_string(w[i + 1 : i + least(13, len(w))], ' '))) AS win FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, k, unnest(range(0, len(w) - k + 1)) AS pos, unnest(list_transform(range(0, len(w) - k + 1), lambda i: array_to_string(w[i + 1 : i + k], ' '))) AS win FROM d, sizes WHERE len(w) >= k),
hits AS (SELECT r, pos, dw.k, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + k)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

OP7_SQL = """
WITH RECURSIVE sizes AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS size FROM documents GROUP BY source),
total AS (SELECT sum(size) AS all_size, sum(pow(size, 0.5)) AS all_weight FROM sizes),
rates AS (SELECT source, CASE WHEN size > 0 AND all_weight > 0 THEN pow(size, 0.5) / all_weight * all_size * 1.0 / size ELSE 1.0 END AS rate FROM sizes, total),
draws AS (SELECT source, rate / greatest(ceil(rate / 64), 1) AS rate, greatest(ceil(rate / 64), 1)::BIGINT AS n FROM rates),
below AS (SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM draws
          UNION ALL SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM below WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
named AS (SELECT row_number() OVER () AS r, *, coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, ''))) AS name FROM documents),
drawn AS (SELECT r, ('0x' || substr(md5('42|' || name || '|' || j), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u, source
          FROM (SELECT named.r, named.name, named.source, unnest(range(1, draws.n + 1)) AS j FROM named JOIN draws ON named.source IS NOT DISTINCT FROM draws.source)),
counts AS (SELECT r, count(*) AS n FROM drawn JOIN below ON drawn.source IS NOT DISTINCT FROM below.source AND below.c <= drawn.u GROUP BY r),
copies AS (SELECT named.*, n, unnest(range(1, n + 1)) AS k FROM named JOIN counts USING (r))
SELECT doc_id, text, lang, source, n_chars, k::INTEGER AS copy, n::INTEGER AS n_copies, md5('42 order|' || name || '|' || k) AS mix_key FROM copies
"""

#: Table of the CRC-32 of every byte (polynomial 0xEDB88320), and the checksum of a list of bytes by it.
CRC_TABLE = "crc AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) AS t(i)))"


def _crc(list_of_bytes: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295, {list_of_bytes}), lambda c, x: xor(c // 256, tab[1 + xor(c % 256, x)])), 4294967295)"


OP13_SQL = rf"""
WITH {CRC_TABLE},
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'k': sha256(strlen(role) || ':' || role || text), 'w': len(regexp_extract_all(text, '[^ 	-
]+'))}} ORDER BY turn NULLS FIRST, role, text) AS l FROM turns GROUP BY conv_id),
heads AS (SELECT conv_id, l, {_crc("list_transform(regexp_extract_all(conv_id::VARCHAR, '.'), lambda x: unicode(x)::BIGINT)")} % 4 AS h FROM own, crc),
paths AS (SELECT o.conv_id, list_concat(coalesce(b.l[:h], []), o.l[h + 1:]) AS l FROM heads AS o LEFT JOIN own AS b ON b.conv_id = o.conv_id - o.conv_id % 20),
on_path AS (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS depth FROM paths),
nodes AS (SELECT depth, list_transform(l[:depth], lambda x: x.k) AS k, any_value(l[depth].w) AS w, count(*) AS n_convs, min(conv_id) AS conv_id,
                 string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(l) = depth) AS ends FROM on_path GROUP BY 1, 2),
kids AS (SELECT k[:depth - 1] AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
tops AS (SELECT k[:a] AS k, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * coalesce(w, 0)) AS saved_tokens
         FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM full_nodes) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM full_nodes AS n JOIN tops USING (k) LEFT JOIN full_nodes AS p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.k = n.k[:n.depth - 1]
"""

_BYTES = "list_concat(list_transform(regexp_extract_all(coalesce(doc_id::VARCHAR, '') || ':', '.'), lambda x: unicode(x)::BIGINT), flatten(list_transform(regexp_extract_all(run, '.'), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END)))"
OP12_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2),
hashed AS (SELECT run, n, {_crc(_BYTES)} AS h FROM runs, crc),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
skips AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM words),
parts AS (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM skips),
less AS (SELECT DISTINCT parts.word AS longer, parts.n AS longer_n, words.word AS shorter, words.n AS shorter_n FROM parts JOIN words ON words.word = a || b),
near AS (SELECT x.word AS w, y.word AS v, y.n AS vn FROM parts AS x JOIN parts AS y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
         UNION ALL SELECT longer, shorter, shorter_n FROM less UNION ALL SELECT shorter, longer, longer_n FROM less),
ranked AS (SELECT w, v, vn, count(*) OVER (PARTITION BY w) AS n_near, row_number() OVER (PARTITION BY w ORDER BY vn DESC, v) AS place FROM near),
found AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN vn >= 2 * n THEN v END AS form, CASE WHEN vn >= 2 * n THEN vn END AS form_n FROM words LEFT JOIN ranked ON w = word AND place = 1),
chain AS (SELECT word, word AS root, 0 AS steps FROM found UNION ALL SELECT chain.word, found.form, steps + 1 FROM chain JOIN found ON found.word = chain.root WHERE found.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM found JOIN (SELECT word, max_by(root, steps) AS root FROM chain GROUP BY word) USING (word)
"""

SQL = {"op1_decontamination": OP1_SQL, "op7_mixing": OP7_SQL, "op12_spelling_variants": OP12_SQL, "op13_prefix_trie": OP13_SQL}
