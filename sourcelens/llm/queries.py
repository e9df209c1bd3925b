"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    conversation_trie,
    decontam,
    html_text,
    hyperplane_tree,
    language_cnn,
    near_dup,
    packing,
    permutation_index,
    pii,
    secret_scan,
    token_files,
    toxicity,
)
from .common import prepare, scratch, table


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth vector, by the permutation index."""
    prepare(spark)
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema-fingerprint chat formatting of all conversations and conversation -7."""
    prepare(spark)
    hard = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    made = chat_format.records(rows.unionByName(extra))
    return chat_format.digest(chat_format.read_back(chat_format.render(chat_format.canonical_turns(made))))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document by the subsequence-kernel machine."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to dictionary-compressed token files and back."""
    prepare(spark)
    base, manifest = token_files.write(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", "space", end_id=0)
    return token_files.read(base, manifest)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weakly supervised PII spans of every whole document."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scratch(pii.candidates(docs).drop("text"), "pii-spans")
    return pii.digest(found, pii.fit(found))


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items leaked into each document, by greedy string tiling."""
    prepare(spark)
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by tree scoring."""
    prepare(spark)
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, similarity 0.8."""
    prepare(spark)
    return near_dup.components(table(spark, sf_dir, "documents"), words=4, percent=80)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-fit-decreasing packing of all documents into windows of 2048 tokens."""
    prepare(spark)
    return packing.pack(table(spark, sf_dir, "documents"), "word_bpe_49k.json", "word", end_id=1, capacity=2048,
                        keep_ids=False)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole document, judged by corpus-wide ownership."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return secret_scan.digest(secret_scan.scan(
        docs, F.col("source"), F.concat_ws("/", F.col("source"), F.col("lang"))))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, each with openings borrowed from its family."""
    prepare(spark)
    lists = conversation_trie.turn_lists(table(spark, sf_dir, "conversations"))
    return conversation_trie.nodes(conversation_trie.borrow_openings(lists))


def op12_language_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document by the byte convolutional network."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return language_cnn.predict(docs, language_cnn.fit(docs.where(~language_cnn.held_out())))


def op13_hyperplane_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, by the hyperplane tree."""
    prepare(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hyperplane_tree.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES = {
    "op1_permutation_index": op1_permutation_index,
    "op2_chat_format": op2_chat_format,
    "op3_toxicity": op3_toxicity,
    "op4_token_files": op4_token_files,
    "op5_pii": op5_pii,
    "op6_decontam": op6_decontam,
    "op7_html_text": op7_html_text,
    "op8_near_dup": op8_near_dup,
    "op9_packing": op9_packing,
    "op10_secret_scan": op10_secret_scan,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_language_cnn": op12_language_cnn,
    "op13_hyperplane_tree": op13_hyperplane_tree,
}
#: Lengths of escaped strings: every backslash and every control string grows by one code point.
_ESCAPED = r"""regexp_replace(regexp_replace({0}, '\\', 'bb', 'g'),
      '<(\||s>|/s>|<SYS|</SYS|start_of|end_of)|\[(/?INST\])', '<b\1\2', 'g')"""
#: crc32 of a conversation's id as text, bit by bit: bytes of the text enter, each followed by eight shifts.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(conv_id::VARCHAR, ''), lambda c: list_concat([ascii(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""

ORACLES: dict[str, str] = {
    "op2_chat_format": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, length({_ESCAPED.format('text')}) AS text_len, length({_ESCAPED.format('role')}) AS role_len FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_len + role_len + {len(chat_format.START + chat_format.MIDDLE + chat_format.END) + 1}) AS BIGINT)
    AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op8_near_dup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3]))
    END AS s FROM words
), classes AS (
  SELECT hash(list_sort(s)) AS c, min(doc_id) AS node, any_value(s) AS s, len(any_value(s)) AS n
  FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), each AS (SELECT node, n, unnest(s) AS x FROM classes),
common AS (
  SELECT a.node AS a, b.node AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM each a JOIN each b ON a.x = b.x AND a.node <> b.node AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
  GROUP BY a.node, b.node
), links AS (SELECT a, b FROM common WHERE 100 * k >= 80 * (na + nb - k)),
reach(node, other) AS (
  SELECT node, node FROM classes UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
), least_of AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component, s.doc_id) AS component_id,
  coalesce(l.component, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN classes c ON len(s.s) > 0 AND c.c = hash(list_sort(s.s)) LEFT JOIN least_of l ON l.node = c.node""",
    "op11_conversation_trie": f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC32} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)
), heads AS (
  SELECT i.conv_id, t.n, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.base AND t.n <= i.h
), borrowed AS (SELECT conv_id, count(*) AS k FROM heads GROUP BY conv_id),
rebuilt AS (
  SELECT * FROM heads UNION ALL
  SELECT i.conv_id, t.n - i.h + coalesce(b.k, 0), t.role, t.text
  FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.n > i.h LEFT JOIN borrowed b ON b.conv_id = i.conv_id
), paths AS (
  SELECT conv_id, 0 AS d, md5('') AS p, 0 AS bytes FROM ids UNION ALL
  SELECT conv_id, n, md5(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '')
    OVER (PARTITION BY conv_id ORDER BY n)), strlen(text) FROM rebuilt
), members AS (
  SELECT *, lag(p) OVER (PARTITION BY conv_id ORDER BY d) AS up, d = max(d) OVER (PARTITION BY conv_id) AS ends FROM paths
), nodes AS (
  SELECT d, p, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY d, p
), below AS (SELECT d - 1 AS d, up AS p, count(*) AS n_children FROM nodes GROUP BY d, up),
sums AS (
  SELECT m.d, m.p, count(*) FILTER (b.p IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.bytes) AS saved_tokens
  FROM nodes u JOIN members m ON m.conv_id = u.conv_id AND m.d <= u.d LEFT JOIN below b ON b.d = u.d AND b.p = u.p
  GROUP BY m.d, m.p
)
SELECT v.conv_id, v.d::BIGINT AS depth, a.conv_id AS parent_conv_id, v.n_convs, coalesce(b.n_children, 0) AS n_children,
  s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM nodes v JOIN sums s ON s.d = v.d AND s.p = v.p LEFT JOIN below b ON b.d = v.d AND b.p = v.p
LEFT JOIN nodes a ON a.d = v.d - 1 AND a.p = v.up""",
    "op13_hyperplane_tree": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (
    PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5""",
}
