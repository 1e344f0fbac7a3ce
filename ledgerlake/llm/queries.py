"""Queries that apply each operator to its whole table, and their DuckDB twins where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import ann, chat, common, decontam, lexical, linededup, packing, pieces, pii, quality, simhash, trie, urlfilter, warc


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to Zstandard WARC archives in the shared folder and read back."""
    pages = common.read(spark, sf_dir, "pages")
    folder = common.new_folder(spark, "warc")
    warc.archives(warc.with_record_types(pages, "page_id", "html", "url")).write.parquet(folder)
    return warc.read_archives(spark.read.parquet(folder), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN d.page_id > f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id > f.first THEN f.first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day, spread over 366 days by the page's id."""
    return pages.select("page_id", "url", F.expr("date_add(DATE '2024-01-01', cast(pmod(page_id * 7919, 366) AS int))").alias("fetch_day"))


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated URL list that grows with the pages: every fifth page puts its host, its domain or its
    directory on the list, or takes it off, on a day given by its id."""
    host, path = urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url"))
    pattern = F.expr("""CASE pmod(page_id, 3) WHEN 0 THEN host
        WHEN 1 THEN regexp_extract(host, '([^.]+[.][^.]+)$', 1)
        ELSE concat(host, regexp_extract(path, '^(/[^/]+/)', 1)) END""")
    return (pages.filter("pmod(page_id, 5) = 0").select("page_id", host.alias("host"), path.alias("path")).filter("host IS NOT NULL")
            .select(F.nullif(pattern, F.lit("")).alias("pattern"),
                    F.expr("element_at(array('block', 'block', 'allow', 'remove'), cast(pmod(page_id div 5, 4) AS int) + 1)").alias("action"),
                    F.expr("concat('c', pmod(page_id div 20, 4))").alias("category"),
                    F.expr("date_add(DATE '2024-01-01', cast(pmod(page_id * 104729, 366) AS int))").alias("day"),
                    F.col("page_id").alias("seq")))


def op2_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries that were active on its fetch day."""
    pages = common.read(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(captures(pages), list_entries(pages), "page_id", "url", "fetch_day")


OP2_SQL = r"""
WITH u AS (
  SELECT page_id, nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([a-z0-9._-]*[a-z0-9_-])', 1), '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
e AS (
  SELECT CASE page_id % 3 WHEN 0 THEN host WHEN 1 THEN regexp_extract(host, '([^.]+[.][^.]+)$', 1)
              ELSE host || regexp_extract(path, '^(/[^/]+/)', 1) END AS pattern,
         ['block', 'block', 'allow', 'remove'][(page_id // 5) % 4 + 1] AS action, 'c' || ((page_id // 20) % 4) AS category,
         DATE '2024-01-01' + ((page_id * 104729) % 366)::INT AS day, page_id AS seq
  FROM u WHERE page_id % 5 = 0 AND host IS NOT NULL),
last AS (SELECT lower(pattern) AS pattern, day, action, category FROM e WHERE pattern <> ''
         QUALIFY row_number() OVER (PARTITION BY lower(pattern), day ORDER BY seq DESC) = 1),
changed AS (SELECT * FROM last QUALIFY lag(action || '/' || category) OVER (PARTITION BY pattern ORDER BY day) IS DISTINCT FROM action || '/' || category),
valid AS (SELECT *, coalesce(lead(day) OVER (PARTITION BY pattern ORDER BY day), DATE '2200-01-01') AS until FROM changed),
c AS (SELECT *, DATE '2024-01-01' + ((page_id * 7919) % 366)::INT AS fetch_day, string_split(host, '.') AS l, string_split(lower(path), '/') AS d FROM u),
k AS (
  SELECT page_id, unnest(list_distinct(list_concat(
    CASE WHEN len(l) >= 2 THEN list_transform(range(1, len(l)), lambda i: array_to_string(l[i:], '.')) ELSE [host] END,
    list_transform(range(1, least(4, len(d) - 2) + 1), lambda i: host || '/' || array_to_string(d[2:i + 1], '/') || '/')))) AS pattern
  FROM c WHERE host IS NOT NULL),
b AS (SELECT k.page_id, v.* FROM k JOIN c USING (page_id) JOIN valid v ON v.pattern = k.pattern AND v.action <> 'remove'
        AND v.day <= c.fetch_day AND c.fetch_day < v.until
      QUALIFY row_number() OVER (PARTITION BY k.page_id ORDER BY length(k.pattern) DESC, k.pattern DESC) = 1)
SELECT c.page_id, c.host, c.fetch_day, coalesce(b.action, 'allow') AS action, b.pattern, b.category, b.day AS listed_since
FROM c LEFT JOIN b USING (page_id)
"""


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    docs = common.read(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, "doc_id", "text", shingle=3, max_bits=3).select(
        "doc_id", "fingerprint", "component_id")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole document; n_* count the base entities."""
    return pii.find(common.read(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    return ann.search(common.read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.Model:
    return quality.fit(docs, common.read(spark, sf_dir, "labels"), "doc_id", "text", "quality")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole document by a model that never saw the held-out fold."""
    docs = common.read(spark, sf_dir, "documents")
    scored = quality.with_score(docs.select("doc_id", "text"), "text", quality_model(spark, sf_dir, docs), "score")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered from the perspective of each of its participants."""
    return chat.rotate(common.read(spark, sf_dir, "conversations"))


OP7_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS speaker,
         replace(coalesce(text, ''), '<|im_', '<' || chr(8205) || '|im_') AS text FROM conversations),
w AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
h AS (
  SELECT t.*, w.perspective, t.speaker = w.perspective AS mine,
         '<|im_start|>' || CASE WHEN t.speaker = 'system' THEN 'system' WHEN t.speaker = w.perspective THEN 'assistant'
           ELSE 'user name=' || regexp_replace(replace(t.speaker, '<|im_', '<' || chr(8205) || '|im_'), '[\r\n]', ' ', 'g') END || chr(10) AS head
  FROM t JOIN w ON t.conv_id IS NOT DISTINCT FROM w.conv_id),
s AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM h)
SELECT conv_id, perspective, row_number() OVER o - 1 AS position, turn, segment,
       (sum(length(segment)) OVER (o ROWS UNBOUNDED PRECEDING) - length(segment))::BIGINT AS start,
       CASE WHEN mine THEN length(head) ELSE 0 END AS mask_start, CASE WHEN mine THEN length(segment) - 1 ELSE 0 END AS mask_end
FROM s WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text)
"""


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) whose document has 0.8 of the item's 5-word shingles."""
    found = decontam.contaminated(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_found")


OP8_SQL = r"""
WITH w AS (
  SELECT 0 AS kind, doc_id AS id, regexp_split_to_array(trim(lower(coalesce(text, '')), E' \t\n\x0b\f\r'), '[\x20\x09-\x0D]+') AS a FROM documents
  UNION ALL
  SELECT 1, item_id, regexp_split_to_array(trim(lower(coalesce(text, '')), E' \t\n\x0b\f\r'), '[\x20\x09-\x0D]+') FROM benchmark),
p AS (SELECT kind, id, a, unnest(range(1, len(a) - 3)) AS i FROM w),
g AS (SELECT DISTINCT kind, id, array_to_string(a[i:i + 4], ' ') AS gram FROM p),
n AS (SELECT id, count(*) AS n FROM g WHERE kind = 1 GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(n.n)::INT AS n_shingles, count(*)::INT AS n_found
FROM g d JOIN g b ON d.gram = b.gram AND d.kind = 0 AND b.kind = 1 JOIN n ON n.id = b.id
GROUP BY d.id, b.id HAVING count(*) >= ceil(0.8 * any_value(n.n) - 1e-9)
"""


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document tokenised, cut and packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(common.read(spark, sf_dir, "documents"), "doc_id", "text",
                                  public_tokenizers.path("byte_bpe_50k.json"))


def op10_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 and more words that an earlier one has."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup(docs, "doc_id", "text", min_words=50, spans_col="removed")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded with byte offsets, and decoded again."""
    docs = pieces.encode(common.read(spark, sf_dir, "documents").select("doc_id", "text"), "text",
                         public_tokenizers.path("piece_bpe_32k.model"), decoded_col="decoded", keep_text=False)
    return docs.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       F.element_at("ends", -1).cast("long").alias("n_bytes"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) in which conversation c opens with the first crc32(c) mod 4 turns of
    conversation c - c mod 20 and goes on with its own turns after as many."""
    text = common.text_or_empty
    own = (conversations.filter("conv_id IS NOT NULL")
           .select("conv_id", text(F.col("role")).alias("role"), text(F.col("text")).alias("text"),
                   F.row_number().over(Window.partitionBy("conv_id").orderBy(
                       F.col("turn").asc_nulls_first(), text(F.col("role")), text(F.col("text")))).cast("long").alias("position")))
    convs = (own.select("conv_id").distinct()
             .withColumns({"base": F.expr("conv_id - conv_id % 20"),
                           "opened": F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4))}))
    opening = own.filter("conv_id % 20 = 0 AND position <= 3").withColumnRenamed("conv_id", "base")
    columns = ["conv_id", "position", "role", "text"]
    turns = (convs.join(opening, "base").filter("position <= opened").select(columns)
             .unionByName(own.join(convs, "conv_id").filter("position > opened").select(columns)))
    return turns, convs.select("conv_id")


def op12_prefixtrie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared prefix of the rebuilt conversations."""
    return trie.nodes(*rebuilt(common.read(spark, sf_dir, "conversations")))


OP12_SQL = r"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS txt,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                 lambda x: list_concat([ascii(x)::BIGINT], list_transform(range(8), lambda k: -1::BIGINT)))),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END,
             4294967295::BIGINT), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM o)),
r AS (
  SELECT c.conv_id, o.n, o.role, o.txt FROM c JOIN o ON o.conv_id = c.base AND o.n <= c.h
  UNION ALL SELECT c.conv_id, o.n, o.role, o.txt FROM c JOIN o ON o.conv_id = c.conv_id AND o.n > c.h),
k AS (SELECT conv_id, n, sha256(length(role) || ':' || role || txt) AS k, len(regexp_extract_all(txt, '[^ 	-
]+')) AS words FROM r),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(k, '') OVER w AS prefix, words FROM k
  WINDOW w AS (PARTITION BY conv_id ORDER BY n ROWS UNBOUNDED PRECEDING)),
m AS (SELECT conv_id, depth, prefix, words FROM p UNION ALL SELECT conv_id, 0, '', 0 FROM c),
g AS (SELECT prefix, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM m GROUP BY prefix),
e AS (
  SELECT prefix, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, max_by(prefix, depth) AS prefix FROM m GROUP BY conv_id) GROUP BY prefix),
q AS (SELECT left(prefix, (depth - 1) * 64) AS prefix, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY ALL),
a AS (
  SELECT left(g.prefix, i * 64) AS prefix, sum((n_convs - 1) * words) AS saved, count(*) FILTER (q.n_children IS NULL) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS i FROM g) g LEFT JOIN q ON q.prefix = g.prefix GROUP BY ALL)
SELECT g.conv_id, g.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, g.n_convs, coalesce(q.n_children, 0) AS n_children, a.n_leaves,
       a.saved::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM g JOIN a USING (prefix) LEFT JOIN q USING (prefix) LEFT JOIN e USING (prefix)
LEFT JOIN g u ON g.depth > 0 AND u.prefix = left(g.prefix, (g.depth - 1) * 64)
"""


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that rank highest for every benchmark item."""
    return lexical.search(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH t AS (
  SELECT 0 AS kind, row_number() OVER () AS r, doc_id AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS a FROM documents
  UNION ALL
  SELECT 1, row_number() OVER (), item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') FROM benchmark),
g AS (SELECT count(*) AS n_docs, sum(len(a))::BIGINT AS n_terms FROM t WHERE kind = 0 AND len(a) > 0),
u AS (SELECT kind, r, id, len(a)::BIGINT AS n, unnest(a) AS term FROM t),
c AS (SELECT kind, r, id, n, term, count(*) AS tf FROM u GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM c WHERE kind = 0 GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, g),
s AS (
  SELECT q.r AS item, q.id AS item_id, d.r AS doc, d.id AS doc_id,
         sum(q.tf * w.w * ((1000000000 * d.tf) // (1000 * d.tf + 12 * (75 + (25 * d.n * n_docs) // n_terms))))::BIGINT AS score
  FROM c q JOIN c d ON q.term = d.term AND q.kind = 1 AND d.kind = 0 JOIN w ON w.term = q.term, g GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 20
"""


QUERIES = {
    "op1_warc": op1_warc,
    "op2_urlfilter": op2_urlfilter,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_ann": op5_ann,
    "op6_quality": op6_quality,
    "op7_chat": op7_chat,
    "op8_decontamination": op8_decontamination,
    "op9_packing": op9_packing,
    "op10_linededup": op10_linededup,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_prefixtrie": op12_prefixtrie,
    "op13_lexical": op13_lexical,
}
ORACLE = {
    "op1_warc": OP1_SQL,
    "op2_urlfilter": OP2_SQL,
    "op7_chat": OP7_SQL,
    "op8_decontamination": OP8_SQL,
    "op12_prefixtrie": OP12_SQL,
    "op13_lexical": OP13_SQL,
}
