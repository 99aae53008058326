"""Registered queries of the training-data operators and their DuckDB oracle SQL.

Each query applies its operator, with production parameters, to the whole table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from boxwise.llm import automata, bpe, conversation, exact_dedup, langid, lsh_forest, packing, quality_bt, rules, secrets, token_codec, warc, whitening
from boxwise.llm.common import crc_bucket, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_quality_classifier")
def _op1(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_bt.fit(docs, labels.filter(crc_bucket("doc_id", 5) != 0))
    return quality_bt.score(docs, model).select(
        F.col("id").alias("doc_id"), (crc_bucket("id", 5) == 0).alias("held_out"), "score", "predicted")


@register("op2_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN octet_length(encode(h)) >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(encode(h)) >= 1000 AND page_id <> top THEN top END AS refers_to
FROM g""")
def _op2(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    records = warc.read(spark, warc.archive(pages), with_payload=False)
    return records.where("record_type IN ('response', 'revisit')").select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


@register("op3_byte_bpe")
def _op3(spark, sf_dir):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    rows = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks), ranks)
    return rows.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op4_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)""")
def _op4(spark, sf_dir):
    return (exact_dedup.classify(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
            .select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")))


@register("op5_near_dedup", """
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [words]
    ELSE list_transform(range(1, len(words) - 3), lambda i: words[i:i+4]) END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
      GROUP BY 1, 2),
link AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
         WHERE 100 * k >= 75 * (na.n + nb.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)""")
def _op5(spark, sf_dir):
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


@register("op6_quality_rules", rules.rules_oracle())
def _op6(spark, sf_dir):
    return rules.apply_rules(table(spark, sf_dir, "documents"))


def _vocabulary(name: str) -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@register("op7_best_fit_packing")
def _op7(spark, sf_dir):
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@register("op8_secret_scans")
def _op8(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = "cast(size(filter(base, x -> x.k = {})) AS bigint) AS {}"
    return found.selectExpr(
        "doc_id", count.format(0, "n_assign"), count.format(1, "n_access"), count.format(2, "n_hex"),
        f"sha2({secrets.spans_text('base')}, 256) AS base_sha256", f"{secrets.spans_text('found')} AS spans")


@register("op9_token_files")
def _op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    manifest = token_codec.write(docs, _vocabulary("word_bpe_49k.json"), end_id=2)
    return token_codec.read(spark, manifest).select(
        F.col("name").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "start", "n_tokens",
        F.crc32("ids").alias("ids_crc32"))


@register("op10_language_id")
def _op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(crc_bucket("doc_id", 4) != 2))
    return langid.predict(docs, model, carry=["doc_id"]).select(
        "doc_id", (crc_bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@register("op11_conversation_repair", r"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda i: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
          lambda x, z: xor(x >> 1, 3988292384 * (x & 1)), i)) AS t),
spaced AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' ') AS k FROM conversations),
hit AS (SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(list_transform(string_split(k, ''), lambda c: cast(ord(c) AS bigint)),
          lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]), 4294967295)) % 20 AS d FROM spaced, crc),
made AS (SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
           CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE d WHEN 3 THEN 2 ELSE 1 END)) AS again FROM hit WHERE d <> 0),
seq AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM made),
ends AS (SELECT *, left(role, 1) AS ini, right(rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 1) AS tail,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM seq),
f AS (SELECT *, CASE WHEN tail = '' THEN 1 WHEN seen THEN 2 WHEN tail NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM ends),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
           count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
grow AS (SELECT * FROM (VALUES ('', 0, 0, ''), ('', 1, 1, ''), ('', 2, 2, ''), ('', 3, 3, ''), ('I', 0, 2, 'u'), ('I', 1, 2, 'u'), ('I', 2, 3, 'a'),
           ('I', 3, 2, 'u'), ('II', 0, 3, 'ua'), ('II', 1, 3, 'ua'), ('II', 2, 2, 'au'), ('II', 3, 3, 'ua')) AS g(letters, s, z, made)),
edit AS (SELECT * FROM (VALUES ('D', 0, 0, ''), ('D', 1, 1, ''), ('D', 2, 2, ''), ('D', 3, 3, ''), ('K', 0, 1, 's'), ('K', 0, 2, 'u'), ('K', 1, 2, 'u'),
           ('K', 2, 3, 'a'), ('K', 3, 2, 'u'), ('R', 0, 2, 'user'), ('R', 1, 2, 'user'), ('R', 2, 3, 'assistant'), ('R', 3, 2, 'user')) AS e(letter, s, z, what)),
walk AS (
  SELECT conv_id, cast(0 AS bigint) AS i, 0 AS z, cast(0 AS bigint) AS cost, '' AS audit, cast([] AS varchar[]) AS out FROM sums
  UNION ALL
  SELECT conv_id, i, z, b.cost, b.audit, b.out FROM (
    SELECT w.conv_id, f.i, e.z, min(struct_pack(cost := w.cost + 5 * length(g.letters)
        + CASE e.letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN f.fault = 3 AND e.letter <> 'D' THEN 5 ELSE 0 END,
      audit := w.audit || g.letters || e.letter,
      out := w.out || list_filter(list_transform(string_split(g.made, ''), lambda c: CASE c WHEN 'u' THEN 'user:' WHEN 'a' THEN 'assistant:' ELSE '' END), lambda c: c <> '')
        || CASE e.letter WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [e.what || ':' || f.text] END)) AS b
    FROM walk w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    JOIN grow g ON g.s = w.z JOIN edit e ON e.s = g.z
    WHERE (e.letter = 'D' OR f.fault NOT IN (1, 2)) AND (e.letter <> 'K' OR e.what = f.ini)
    GROUP BY w.conv_id, f.i, e.z)),
done AS (SELECT w.conv_id, min(struct_pack(cost := w.cost + 5 * length(g.letters), audit := w.audit || g.letters,
           out := w.out || list_filter(list_transform(string_split(g.made, ''), lambda c: CASE c WHEN 'u' THEN 'user:' WHEN 'a' THEN 'assistant:' ELSE '' END), lambda c: c <> ''))) AS b
         FROM walk w JOIN sums ON sums.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = sums.n
         JOIN grow g ON g.s = w.z WHERE g.z IN (0, 3) GROUP BY w.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0) AS cost, coalesce(b.audit, '') AS audit,
       sha256(coalesce(array_to_string(b.out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id""")
def _op11(spark, sf_dir):
    return conversation.audit(conversation.damage(table(spark, sf_dir, "conversations")), copies_col="copies")


@register("op12_embedding_whitening")
def _op12(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register("op13_substring_dedup", r"""
WITH w AS (SELECT doc_id, text, list_filter(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS words
           FROM documents),
g AS (SELECT doc_id, text, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50),
h AS (SELECT doc_id, text, i, sha256(array_to_string(words[i:i+49], ' ')) AS k FROM g),
o AS (SELECT k, min(doc_id) AS low FROM h GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, text, unnest(range(i, i + 50)) AS place FROM h JOIN o USING (k) WHERE low < doc_id),
m AS (SELECT doc_id, text, list(place) AS ats FROM gone GROUP BY doc_id, text)
SELECT w.doc_id, cast(len(words) AS bigint) AS n_words, cast(coalesce(len(ats), 0) AS bigint) AS n_removed,
       sha256(array_to_string(CASE WHEN ats IS NULL THEN words
         ELSE list_filter(words, lambda x, i: NOT list_contains(ats, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN m ON m.doc_id = w.doc_id AND m.text = w.text""")
def _op13(spark, sf_dir):
    return automata.repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
