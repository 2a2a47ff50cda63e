"""The registered queries of this package, each over its whole table, and their SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from claimwright.llm import (
    centroids, chat_tools, decontamination, html_text, lm_scoring, neighbours, packing, secret_scan,
    simhash, text_digest, token_files, toxicity, vector_codes, vector_sql)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The definition of a public tokenizer; tasks get its text, not its place."""
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_lm_scoring(spark, folder):
    return lm_scoring.score_texts(table(spark, folder, "documents"))


TOOLS = """VALUES
    ('answer', 'text', 'string', true), ('answer', 'words', 'integer', true),
    ('answer', 'share', 'number', false),
    ('note', 'text', 'string', true), ('note', 'words', 'string', true),
    ('note', 'lang', 'string', true) AS tools(name, param, type, required)"""


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as tool traffic: an assistant turn calls a tool with its text, after the
    assistant turn before it; the user turn that follows is the result."""
    return conversations.selectExpr(
        "conv_id", "turn", "CASE WHEN role = 'user' AND turn > 0 THEN 'tool' ELSE role END AS role",
        """CASE WHEN role = 'assistant' THEN to_json(named_struct('tool_calls', array(named_struct(
                'id', concat('c', turn), 'after', CASE WHEN turn >= 2 THEN concat('c', turn - 2) END,
                'name', CASE turn % 4 WHEN 1 THEN 'answer' WHEN 3 THEN 'note' ELSE 'other' END,
                'arguments', named_struct('words', size(filter(split(text, ' '), w -> w <> '')),
                                          'text', text)))))
            WHEN role = 'user' AND turn > 0
            THEN to_json(named_struct('tool_call_id', concat('c', turn - 1), 'content', text))
            ELSE text END AS text""")


def op2_chat_tools(spark, folder):
    return chat_tools.link_tool_calls(
        tool_messages(table(spark, folder, "conversations")), spark.sql(TOOLS))


def op3_toxicity(spark, folder):
    return toxicity.contract(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_decontamination(spark, folder):
    return decontamination.contract(
        spark, table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_simhash(spark, folder):
    return simhash.contract(table(spark, folder, "documents"))


def op6_packing(spark, folder):
    return packing.pack_documents(
        table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))


def op7_secrets(spark, folder):
    return secret_scan.contract(table(spark, folder, "documents"))


def op8_html_text(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


def op9_token_files(spark, folder):
    return token_files.contract(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op10_neighbours(spark, folder):
    return neighbours.search(table(spark, folder, "embeddings"))


def op11_vector_codes(spark, folder):
    return vector_codes.contract(table(spark, folder, "embeddings"))


def op12_text_digest(spark, folder):
    return text_digest.contract(table(spark, folder, "documents"))


def op13_centroids(spark, folder):
    return centroids.contract(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_chat_tools": op2_chat_tools,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_simhash": op5_simhash,
    "op6_packing": op6_packing,
    "op7_secrets": op7_secrets,
    "op8_html_text": op8_html_text,
    "op9_token_files": op9_token_files,
    "op10_neighbours": op10_neighbours,
    "op11_vector_codes": op11_vector_codes,
    "op12_text_digest": op12_text_digest,
    "op13_centroids": op13_centroids,
    "pipeline": corpus_pipeline.run,
}

# Every turn is one row here, calls and results meet on their ids, and a call waits for
# the greatest turn of what comes before it in its chain.
CHAT_SQL = """
WITH RECURSIVE rows_ AS (
  SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(text, '') AS text, role,
    CASE WHEN role = 'assistant' THEN 'call' WHEN role = 'user' AND turn > 0 THEN 'result'
         ELSE 'message' END AS kind,
    CASE WHEN role = 'assistant' THEN 'c' || turn
         WHEN role = 'user' AND turn > 0 THEN 'c' || (turn - 1) END AS call_id
  FROM conversations),
calls AS (
  SELECT conv_id, turn,
    EXISTS (SELECT 1 FROM rows_ r WHERE r.conv_id = c.conv_id AND r.kind = 'result'
            AND r.turn = c.turn + 1) AS answered,
    EXISTS (SELECT 1 FROM rows_ b WHERE b.conv_id = c.conv_id AND b.kind = 'call'
            AND b.turn = c.turn - 2) AS chained
  FROM (SELECT DISTINCT conv_id, turn FROM rows_ WHERE kind = 'call') c),
chain AS (
  SELECT conv_id, turn, answered, 0 AS depth FROM calls WHERE NOT chained
  UNION ALL
  SELECT c.conv_id, c.turn, c.answered, p.depth + 1 FROM calls c
  JOIN chain p ON p.conv_id = c.conv_id AND p.turn = c.turn - 2 WHERE c.chained),
joined AS (
  SELECT r.conv_id, r.turn, r.kind, r.call_id, r.text, r.role,
    CASE r.kind WHEN 'message' THEN 'message'
      WHEN 'call' THEN CASE WHEN k.answered THEN 'linked' ELSE 'unanswered' END
      ELSE CASE WHEN k.turn IS NULL THEN 'orphan' ELSE 'linked' END END AS status,
    CASE r.kind WHEN 'message' THEN 0 WHEN 'call' THEN 2 * k.depth
      ELSE CASE WHEN k.turn IS NULL THEN 0 ELSE 2 * k.depth + 1 END END AS depth,
    CASE r.turn % 4 WHEN 1 THEN 'answer' WHEN 3 THEN 'note' ELSE 'other' END AS name,
    len(list_filter(string_split(r.text, ' '), lambda w: w <> '')) AS words
  FROM rows_ r LEFT JOIN chain k ON k.conv_id = r.conv_id
    AND k.turn = CASE r.kind WHEN 'call' THEN r.turn WHEN 'result' THEN r.turn - 1 END)
SELECT conv_id,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn, depth, kind, role, call_id, text) - 1 AS position,
  kind, CASE kind WHEN 'result' THEN 'tool' ELSE role END AS role, turn, call_id, status,
  CASE WHEN kind <> 'call' OR name = 'answer' THEN ''
       WHEN name = 'note' THEN 'missing lang; wrong type words' ELSE 'no schema' END AS errors,
  CASE kind
    WHEN 'call' THEN '{"arguments":{"text":' || to_json(text)::VARCHAR || ',"words":' || words
      || '},"id":' || to_json(call_id)::VARCHAR || ',"name":"' || name || '","role":"assistant"}'
    WHEN 'result' THEN '{"content":' || to_json(text)::VARCHAR || ',"id":' || to_json(call_id)::VARCHAR
      || ',"role":"tool"}'
    ELSE '{"content":' || to_json(text)::VARCHAR || ',"role":' || to_json(role)::VARCHAR || '}' END AS line
FROM joined
"""

LEAK_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i
        FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
spots AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lengths
        WHERE len(w) >= n)),
found AS (SELECT doc_id, i, s.n, item_id FROM spots s JOIN windows USING (n, x)),
hit AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_hit
  FROM (SELECT doc_id, i, unnest(generate_series(0, n - 1)) AS j FROM (SELECT DISTINCT doc_id, i, n FROM found))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE: dict[str, str] = {
    "op2_chat_tools": CHAT_SQL,
    "op4_decontamination": LEAK_SQL,
    "op11_vector_codes": vector_sql.vector_codes_sql(),
    "op12_text_digest": vector_sql.text_digest_sql(),
    "op13_centroids": vector_sql.centroids_sql(),
}
