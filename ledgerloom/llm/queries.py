"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import TableSource
from .chat_trees import END, ESCAPE, START
from .common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, TableSource(spark, sf_dir))
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return deco


@query("op1_karmarkar_karp_shards")
def op1(spark: SparkSession, table: TableSource) -> DataFrame:
    from .sharding import shard_documents
    return shard_documents(table("documents"))


@query("op2_token_counts")
def op2(spark: SparkSession, table: TableSource) -> DataFrame:
    import public_tokenizers
    from .token_counts import count_tokens
    return count_tokens(table("documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op4_sentencepiece_codec")
def op4(spark: SparkSession, table: TableSource) -> DataFrame:
    import public_tokenizers
    from .sentencepiece_codec import encoding_digests
    return encoding_digests(table("documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_one_permutation_fingerprints")
def op6(spark: SparkSession, table: TableSource) -> DataFrame:
    from .fingerprints import fingerprint_edits
    return fingerprint_edits(table("documents"))


@query("op7_superminhash_groups", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 3, 1))) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.root FROM reach r JOIN edges e ON r.doc_id = e.x)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, d.component_id, d.doc_id = d.component_id AS kept
FROM (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) d LEFT JOIN sizes z ON z.doc_id = d.doc_id""")
def op7(spark: SparkSession, table: TableSource) -> DataFrame:
    from .superminhash import near_duplicates
    return near_duplicates(table("documents"), words=4, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


_PROBE = "</s>[INST] ok [/INST]"
_ROLE = r"replace(replace(role, '\', '\\'), chr(10), '\n')"
_ESCAPED = "length(regexp_replace({}, '" + ESCAPE + r"', '\1\2\\\3', 'g'))"


@query("op10_reply_trees", f"""
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(START)} + {_ESCAPED.format(_ROLE)} + 1 + {_ESCAPED.format('text')} + {len(END)} + 1) AS BIGINT) AS formatted_chars
FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '{_PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{_PROBE}')
GROUP BY conv_id""")
def op10(spark: SparkSession, table: TableSource) -> DataFrame:
    from .chat_trees import format_trees, read_back, replies_of_turns
    extra = spark.createDataFrame([(-7, 0, "user", _PROBE), (-7, 1, "assistant", _PROBE)],
                                  "conv_id long, turn long, role string, text string")
    turns = table("conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(format_trees(replies_of_turns(turns)))


@query("op9_simhash_decontamination")
def op9(spark: SparkSession, table: TableSource) -> DataFrame:
    from .decontaminate import contaminated
    return contaminated(table("documents"), table("benchmark"))


@query("op8_surrogates")
def op8(spark: SparkSession, table: TableSource) -> DataFrame:
    from .surrogates import replace_personal_data
    return replace_personal_data(table("documents")).select("doc_id", "n_entities", "text")


@query("op3_byte_cnn_quality")
def op3(spark: SparkSession, table: TableSource) -> DataFrame:
    from .quality_cnn import fit, score_documents
    docs = table("documents")
    return score_documents(docs, fit(docs, table("labels")))


@query("op5_html_crf")
def op5(spark: SparkSession, table: TableSource) -> DataFrame:
    from .html_crf import extract_pages
    return extract_pages(table("pages"))


@query("op12_prefix_dp_bpe")
def op12(spark: SparkSession, table: TableSource) -> DataFrame:
    import public_tokenizers
    from .word_bpe import encode_documents, encoding_digests
    return encoding_digests(encode_documents(table("documents"), public_tokenizers.path("word_bpe_49k.json")))


@query("op13_conversation_prefix_trie")
def op13(spark: SparkSession, table: TableSource) -> DataFrame:
    from .prefix_trie import prefix_trie, rebuild
    return prefix_trie(*rebuild(table("conversations"))).drop("id", "parent")


@query("op11_streamed_turn_repair")
def op11(spark: SparkSession, table: TableSource) -> DataFrame:
    from .turn_repair import damage, repair
    return repair(damage(table("conversations")))
