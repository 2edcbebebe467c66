"""The registered queries of this subpackage and their SQL: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fellwalk.llm import op1_chat_format, op2_personal_data, op3_near_dedup, op4_mixing, op5_vantage_search, op6_language, op7_licences, op8_embedding_dedup, op9_packing, op10_token_files, op11_prefix_trie, op12_toxicity, op13_lexical_search
from fellwalk.llm.common import documents, settle_llm

QUERIES = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = lambda spark, sf_dir: function(settle_llm(spark), sf_dir)
        if sql:
            SQL[name] = sql
        return function

    return register


def vocabulary() -> str:
    """The public vocabulary the contracts name; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query("op10_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_token_files.token_files(documents(spark, sf_dir), vocabulary())


@_query("op9_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_packing.pack(documents(spark, sf_dir), vocabulary())


# Conversation -1 of the contract: both of its texts are made of control strings (fixed values).
PLANTED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]

CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), shown AS (
    SELECT *,
        regexp_replace(role, '([<\[])(\\*)(</?SYS>>|/?s>|/?INST\])', '\1\\\2\3', 'g') AS shown_role,
        regexp_replace(text, '([<\[])(\\*)(</?SYS>>|/?s>|/?INST\])', '\1\\\2\3', 'g') AS shown_text
    FROM turns
), told AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS all_text,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
        sum(length('<s>[INST] ') + length(shown_role) + length(' [/INST]') + length(shown_text) + length('</s>')) AS formatted_chars
    FROM shown GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
    CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM told
"""


@_query("op1_chat_format", CHAT_SQL)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = stored.unionByName(spark.createDataFrame(PLANTED, stored.schema))
    return op1_chat_format.digest(op1_chat_format.format_chats(op1_chat_format.turns_as_events(turns)))


@_query("op2_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_personal_data.digest(documents(spark, sf_dir))


MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), sources AS (
    SELECT source, sum(size) AS source_size,
        [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sized GROUP BY source
), ordered AS (
    SELECT *, 2.0::DOUBLE * source_size AS most,
        1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER earlier, 0) AS rest,
        sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS weights
    FROM sources
    WINDOW earlier AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT arg_min(rest / weights, most / weight) AS level FROM ordered WHERE most >= weight * (rest / weights)
)
SELECT source, CAST(source_size AS BIGINT) AS source_size, round(least(most, coalesce(level * weight, most)), 6) AS target FROM ordered, level
"""


@_query("mix_targets", MIX_SQL)
def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources and their targets, which SQL can check; what each document gives hangs on a hash that SQL does not have."""
    sized = op4_mixing.measured(documents(spark, sf_dir))
    sources = op4_mixing.source_weights(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    return op4_mixing.capped_shares(sources).select("source", "source_size", F.round("target", 6).alias("target"))


@_query("op4_mixing")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_mixing.shares(documents(spark, sf_dir))


@_query("op3_near_dedup")
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_near_dedup.groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


@_query("op6_language")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_language.identify(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score", "n_words")


@_query("op5_vantage_search")
def vantage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return op5_vantage_search.search(vectors, vectors.filter("vec_id % 50 = 0"), 5)


@_query("op8_embedding_dedup")
def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_embedding_dedup.groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LICENCE_SQL = r"""
WITH templates AS (
    SELECT license, words, greatest(len(words) - 4, 1) AS span, greatest(greatest(len(words) - 4, 1) // 4, 1) AS stride,
        list_distinct(list_transform(range(0, greatest(len(words) - 5, 0) + 1), lambda i: array_to_string(words[i + 1 : i + 5], ' '))) AS shingles
    FROM (SELECT license, list_filter(string_split_regex(translate(text, PLAIN), ' +'), lambda w: w <> '') AS words
          FROM (VALUES TEMPLATES) AS t(license, text))
), texts AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), PLAIN), ' +'), lambda w: w <> '') AS words
    FROM documents
), shingled AS (
    SELECT doc_id, list_transform(range(0, greatest(len(words) - 5, 0) + 1), lambda i: array_to_string(words[i + 1 : i + 5], ' ')) AS there
    FROM texts WHERE len(words) > 0
), windows AS (
    SELECT doc_id, license, shingles, unnest(range(0, len(there), stride)) AS start, there, span, stride
    FROM shingled, templates WHERE list_has_any(there, shingles)
), judged AS (
    SELECT doc_id, license, start, len(shingles) AS size,
        len(list_intersect(shingles, there[greatest(start - stride, 0) + 1 : start + span + stride])) AS matched
    FROM windows WHERE list_has_any(shingles, there[start + 1 : start + span])
), best AS (
    SELECT doc_id, license, max({'matched': matched, 'start': -start, 'size': size}) AS best FROM judged WHERE matched >= 0.8 * size GROUP BY doc_id, license
)
SELECT doc_id, license, CAST(best.matched AS BIGINT) AS matched, best.matched / CAST(best.size AS DOUBLE) AS containment, -best.start AS first_shingle FROM best
""".replace("PLAIN", ", ".join(map(_quoted, op7_licences.PLAIN))).replace(
    "TEMPLATES", ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in op7_licences.TEMPLATES.items()))


@_query("op7_licences", LICENCE_SQL)
def licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_licences.scan(documents(spark, sf_dir))


LEXICAL_SQL = r"""
WITH terms AS (
    SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), docs AS (
    SELECT doc, doc_id, words, CAST(len(words) AS BIGINT) AS n FROM terms WHERE len(words) > 0
), sums AS (
    SELECT CAST(count(*) AS BIGINT) AS total, CAST(sum(n) AS BIGINT) AS length FROM docs
), tfs AS (
    SELECT doc, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc, doc_id, n, unnest(words) AS term FROM docs) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tfs, sums GROUP BY term, total
), items AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY ALL
), parts AS (
    SELECT item_id, doc, doc_id, times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * total) // length))) AS part
    FROM items JOIN tfs USING (term) JOIN weights USING (term), sums
), scored AS (
    SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM parts GROUP BY item_id, doc, doc_id HAVING sum(part) > 0
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""


@_query("op13_lexical_search", LEXICAL_SQL)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


TRIE_SQL = r"""
WITH turns AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
    SELECT conv_id, turns, conv_id - conv_id % 5 AS base,
        xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
            lambda x, y: list_reduce(list_concat([xor(x, y)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, b: xor(a >> 1, (a & 1) * 3988292384)))) % 9 AS most
    FROM (SELECT conv_id, count(*) AS turns FROM turns GROUP BY conv_id)
), rebuilt AS (
    SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.most
    UNION ALL
    SELECT t.conv_id, t.pos - greatest(c.most - coalesce(b.turns, 0), 0), t.role, t.text
    FROM turns t JOIN convs c ON t.conv_id = c.conv_id LEFT JOIN convs b ON b.conv_id = c.base WHERE t.pos > c.most
), rows AS (
    SELECT conv_id, 0 AS depth, '' AS path, 0 AS bytes FROM convs
    UNION ALL
    SELECT conv_id, pos, string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY pos), strlen(text) FROM rebuilt
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = longest), '') AS ends
    FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS longest FROM rows) GROUP BY path, depth
), below AS (
    SELECT *, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND starts_with(c.path, n.path)) AS n_children FROM nodes n
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
    (SELECT count(*) FROM below s WHERE s.n_children = 0 AND starts_with(s.path, n.path)) AS n_leaves,
    CAST((SELECT sum((s.n_convs - 1) * s.bytes) FROM nodes s WHERE starts_with(s.path, n.path)) AS BIGINT) AS saved_tokens,
    sha256(n.ends) AS ends_sha256
FROM below n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND starts_with(n.path, p.path)
"""


@_query("op11_prefix_trie", TRIE_SQL)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@_query("op12_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
