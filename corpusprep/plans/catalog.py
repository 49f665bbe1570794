"""All queries of the library, each over whole tables, and the SQL that tells the same result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StringType

from ..functions import canonical, identity, text
from ..operators import assembly, chunking, documents, json_schema, manifests, reconcile, records, retrieval, rules, series, tokens
from ..operators.sentences import sentence_spans as spans_of
from ..shared import discard, shared_dir
from ..sources import csv_splits, files, seeds
from ..sources.tables import table

RECORD_SCHEMA = {
    "type": "object", "required": ["lang", "title"], "additionalProperties": False,
    "properties": {
        "lang": {"enum": ["en", "de", "fr"]}, "source": {"type": "string", "maxLength": 4, "pattern": "src1[0-9]*"}, "n_chars": {"type": "integer", "minimum": 100},
        "labels": {"type": "object", "properties": {"quality": {"type": "integer"}, "toxic": {"enum": [0, 1]}}},
    },
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: A namespace of our own for the identity queries.
NAMESPACE = "4b3f0c9e-52d4-4c39-9f0a-0d5a7c1e8b21"


def query(sql: str | None = None):
    """Register a query under its name, with its SQL if it has one."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def _docs(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text", *columns)


SQL_SENTENCES = r"""
p AS (SELECT doc_id, unnest(s) AS piece, unnest(range(1, len(s) + 1)) AS nr FROM (SELECT doc_id, regexp_extract_all(text, '(?s).*?[।!?.]+["''”’]?(?:\s|$)|.+$') AS s FROM documents)),
q AS (SELECT doc_id, nr, piece, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS f FROM p),
sent AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY nr) - 1 AS INTEGER) AS source_index,
 CAST(f + length(piece) - length(regexp_replace(piece, '^\s+', '')) AS INTEGER) AS start_char,
 CAST(f + length(piece) - length(regexp_replace(piece, '^\s+', '')) + length(regexp_replace(piece, '^\s+|\s+$', '', 'g')) AS INTEGER) AS end_char,
 trim(regexp_replace(piece, '\s+', ' ', 'g')) AS text FROM q WHERE regexp_replace(piece, '\s', '', 'g') <> '')"""


@query(f"WITH {SQL_SENTENCES} SELECT doc_id, source_index, start_char, end_char, text FROM sent")
def sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    return spans_of(_docs(spark, folder))


@query(r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS word_count, CAST(length(text) AS BIGINT) AS character_count,
 CAST(len(list_filter(regexp_split_to_array(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\n\s*\n'), lambda x: regexp_replace(x, '\s', '', 'g') <> '')) AS BIGINT) AS paragraph_count FROM documents""")
def document_text_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", text.text_stats(F.col("text")).alias("s")).select("doc_id", "s.*")


@query(r"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INTEGER) AS paragraph_no, regexp_replace(regexp_replace(x, '\s+', ' ', 'g'), '^ | $', '', 'g') AS text FROM
 (SELECT doc_id, unnest(s) AS x, unnest(range(len(s))) AS i FROM (SELECT doc_id, regexp_split_to_array(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\n') AS s FROM documents)) WHERE regexp_replace(x, '\s', '', 'g') <> ''""")
def paragraph_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", F.posexplode(text.line_blocks(F.col("text"))).alias("i", "text")).select("doc_id", (F.col("i") + 1).alias("paragraph_no"), "text")


@query(r"SELECT doc_id, sha256(regexp_replace(text, '\s', '', 'g')) AS spaceless_sha256, sha256(text) AS text_sha256 FROM documents")
def whitespace_insensitive_hash(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", identity.spaceless_sha256(F.col("text")).alias("spaceless_sha256"), identity.sha256_text(F.col("text")).alias("text_sha256"))


@query("SELECT doc_id, 'sha256' AS algorithm, sha256(text || chr(10)) AS value FROM documents")
def artifact_integrity_hash(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", F.lit("sha256").alias("algorithm"), identity.artifact_sha256(F.col("text")).alias("value"))


SQL_NORMAL = r"regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text), '\r\n?', chr(10), 'g'), '[ \t]+(\n|$)', '\1', 'g'), '^\s+|\s+$', '', 'g')"


@query(f"SELECT doc_id, sha256({SQL_NORMAL}) AS normalized_content_sha256 FROM documents")
def normalized_content_hash(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", identity.content_sha256(F.col("text")).alias("normalized_content_sha256"))


@query(f"""WITH n AS (SELECT doc_id, 'v1|' || source || '|' || CAST(doc_id AS VARCHAR) || '|' || lang || '|' || sha256({SQL_NORMAL}) AS name FROM documents),
h AS (SELECT doc_id, sha1(unhex('{NAMESPACE.replace('-', '')}') || encode(name)) AS h FROM n)
SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || lower(printf('%x', (CAST('0x' || substr(h, 17, 2) AS INTEGER) & 63) | 128)) || substr(h, 19, 2) || '-' || substr(h, 21, 12) AS content_key FROM h""")
def content_key_uuid5(spark: SparkSession, folder: str) -> DataFrame:
    c = identity.content_identity(NAMESPACE, F.col("source"), F.col("doc_id").cast("string"), F.col("lang"), F.col("text"))
    return _docs(spark, folder, "source", "lang").select("doc_id", c["content_key"].alias("content_key"))


@query(r"""WITH d AS (SELECT doc_id, sha256(regexp_replace(text, '\s', '', 'g')) AS h FROM documents), g AS (SELECT h, count(*) AS n, min(doc_id) AS first_id FROM d GROUP BY h HAVING count(*) > 1)
SELECT doc_id, h AS spaceless_sha256, n AS copies, first_id FROM d JOIN g USING (h)""")
def duplicate_content(spark: SparkSession, folder: str) -> DataFrame:
    hashed = _docs(spark, folder).select("doc_id", identity.spaceless_sha256(F.col("text")).alias("spaceless_sha256"))
    return manifests.copies(hashed, "spaceless_sha256").select("doc_id", "spaceless_sha256", "copies", "first_id")


@query("SELECT doc_id, CASE WHEN contains(text, 'License') OR contains(text, 'licensed') THEN 'license,notice' ELSE '' END AS tags FROM documents")
def marker_tags(spark: SparkSession, folder: str) -> DataFrame:
    tags = text.marker_tags(F.col("text"), ["License", "licensed"], ["license", "notice"])
    return _docs(spark, folder).select("doc_id", F.array_join(tags, ",").alias("tags"))


@query(r"""WITH s AS (SELECT p_partkey, p_brand, p_size, trim(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(p_name || ' / ' || p_type, '\s+', ' ', 'g')), '[\\/:*?"<>|]+', '-', 'g'), '\s+', '-', 'g'), '', '', 'g'), '.-') AS f FROM part)
SELECT p_partkey, CASE WHEN substr(f, 1, 80) = '' THEN 'chapter' ELSE substr(f, 1, 80) END AS file_name, 'CAT001_' || p_brand || '_slug_' || printf('%03d', p_size) || '_v01.02.txt' AS artifact_name FROM s""")
def safe_file_names(spark: SparkSession, folder: str) -> DataFrame:
    name = text.safe_filename(F.concat("p_name", F.lit(" / "), "p_type"))
    artifact = text.artifact_name(F.lit("CAT001"), F.col("p_brand"), F.lit("slug"), F.col("p_size"), F.lit("01"), F.lit("02"), ".txt")
    return table(spark, folder, "part").select("p_partkey", name.alias("file_name"), artifact.alias("artifact_name"))


@query(f"WITH {SQL_SENTENCES} SELECT doc_id, source_index, string_agg(text, ' ') OVER (PARTITION BY doc_id ORDER BY source_index ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS window_text FROM sent")
def context_windows(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.context_windows(spans_of(_docs(spark, folder)), 3).select("doc_id", "source_index", "window_text")


SQL_DISTANCE = """v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, lag(CAST(embedding AS DOUBLE[])) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings),
dist AS (SELECT vec_id, label, CASE WHEN b IS NULL THEN NULL ELSE 1 - list_dot_product(b, e) / (sqrt(list_dot_product(b, b)) * sqrt(list_dot_product(e, e))) END AS distance FROM v)"""


@query(f"WITH {SQL_DISTANCE} SELECT vec_id, label, round(distance, 6) AS distance FROM dist")
def adjacent_cosine_distance(spark: SparkSession, folder: str) -> DataFrame:
    rows = series.adjacent_distance(table(spark, folder, "embeddings"), "label", "vec_id", "embedding")
    return rows.select("vec_id", "label", F.round("distance", 6).alias("distance"))


@query(f"""WITH {SQL_DISTANCE}, t AS (SELECT label, quantile_cont(distance, 0.8) AS threshold FROM dist GROUP BY label)
SELECT vec_id, label, round(threshold, 6) AS threshold, coalesce(distance >= threshold, false) AS is_break, CAST(sum(CAST(coalesce(distance >= threshold, false) AS INTEGER)) OVER (PARTITION BY label ORDER BY vec_id ROWS UNBOUNDED PRECEDING) AS INTEGER) AS group_no FROM dist JOIN t USING (label)""")
def percentile_breakpoints(spark: SparkSession, folder: str) -> DataFrame:
    rows = series.breakpoints(series.adjacent_distance(table(spark, folder, "embeddings"), "label", "vec_id", "embedding"), 80.0, "label", "vec_id")
    return rows.select("vec_id", "label", F.round("threshold", 6).alias("threshold"), "is_break", "group_no")


@query(f"""WITH RECURSIVE {SQL_SENTENCES},
n AS (SELECT doc_id, max(source_index) AS last FROM sent GROUP BY doc_id),
r AS (SELECT s.doc_id, s.source_index AS i, length(text) AS open, 0 AS done, CASE WHEN length(text) >= 600 THEN 1 ELSE 0 END AS closes FROM sent s WHERE source_index = 0
 UNION ALL SELECT s.doc_id, s.source_index, CASE WHEN r.closes = 1 THEN length(s.text) ELSE r.open + 1 + length(s.text) END, r.done + r.closes,
 CASE WHEN (CASE WHEN r.closes = 1 THEN length(s.text) ELSE r.open + 1 + length(s.text) END) >= 600 THEN 1 ELSE 0 END FROM r JOIN sent s ON s.doc_id = r.doc_id AND s.source_index = r.i + 1),
c AS (SELECT doc_id, i, done + 1 AS idx FROM r), t AS (SELECT doc_id, sum(closes) AS full_chunks FROM r GROUP BY doc_id)
SELECT c.doc_id, CAST(least(idx, greatest(full_chunks, 1)) AS INTEGER) AS index, CAST(min(i) AS INTEGER) AS start_sentence, CAST(max(i) AS INTEGER) AS end_sentence FROM c JOIN t USING (doc_id) GROUP BY c.doc_id, least(idx, greatest(full_chunks, 1))""")
def greedy_min_size_merge(spark: SparkSession, folder: str) -> DataFrame:
    each = spans_of(_docs(spark, folder)).withColumn("group_no", F.col("source_index"))
    return chunking.merged_groups(each, 600)


#: The coarse encoder of the queries: one place of three, by the length of the window. SQL can tell the same.
def length_encoder(c: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: (F.char_length(c) % 3 == k).cast("float"))


COARSE = chunking.ChunkConfig(threshold_percentile=75.0)

SQL_CHUNKS = f"""{SQL_SENTENCES},
wins AS (SELECT *, length(string_agg(text, ' ') OVER (PARTITION BY doc_id ORDER BY source_index ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)) % 3 AS k FROM sent),
dist AS (SELECT *, CASE WHEN source_index > 0 THEN CAST(k <> lag(k) OVER (PARTITION BY doc_id ORDER BY source_index) AS DOUBLE) END AS distance FROM wins),
thr AS (SELECT doc_id, quantile_cont(distance, 0.75) AS t FROM dist GROUP BY doc_id),
grp AS (SELECT dist.*, sum(CAST(coalesce(distance >= t, false) AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY source_index ROWS UNBOUNDED PRECEDING) AS g FROM dist JOIN thr USING (doc_id)),
per AS (SELECT doc_id, g, min(source_index) AS first, max(source_index) AS last, sum(length(text)) + count(*) - 1 AS chars FROM grp GROUP BY doc_id, g),
r AS (SELECT doc_id, g, chars AS open, 0 AS done, CASE WHEN chars >= 600 THEN 1 ELSE 0 END AS closes FROM per WHERE g = 0
 UNION ALL SELECT p.doc_id, p.g, CASE WHEN r.closes = 1 THEN p.chars ELSE r.open + 1 + p.chars END, r.done + r.closes,
 CASE WHEN (CASE WHEN r.closes = 1 THEN p.chars ELSE r.open + 1 + p.chars END) >= 600 THEN 1 ELSE 0 END FROM r JOIN per p ON p.doc_id = r.doc_id AND p.g = r.g + 1),
tot AS (SELECT doc_id, sum(closes) AS full_chunks FROM r GROUP BY doc_id),
rng AS (SELECT r.doc_id, CAST(least(done + 1, greatest(full_chunks, 1)) AS INTEGER) AS index, min(first) AS a, max(last) AS z FROM r JOIN tot USING (doc_id) JOIN per ON per.doc_id = r.doc_id AND per.g = r.g GROUP BY r.doc_id, least(done + 1, greatest(full_chunks, 1))),
chunk AS (SELECT rng.doc_id, index, CAST(a AS INTEGER) AS start_sentence, CAST(z AS INTEGER) AS end_sentence, b.start_char, e.end_char FROM rng JOIN sent b ON b.doc_id = rng.doc_id AND b.source_index = a JOIN sent e ON e.doc_id = rng.doc_id AND e.source_index = z)"""


@query(f"""WITH RECURSIVE {SQL_CHUNKS} SELECT c.doc_id, index, start_sentence, end_sentence, start_char, end_char, CAST(end_char - start_char AS INTEGER) AS char_count, sha256(substring(text, start_char + 1, end_char - start_char)) AS chunk_text_sha256
 FROM chunk c JOIN documents d ON d.doc_id = c.doc_id""")
def semantic_chunks(spark: SparkSession, folder: str) -> DataFrame:
    made = chunking.semantic_chunks(_docs(spark, folder), COARSE, length_encoder)
    return made.select("doc_id", "index", "start_sentence", "end_sentence", "start_char", "end_char", "char_count", "chunk_text_sha256")


@query(f"""WITH RECURSIVE {SQL_CHUNKS}, n AS (SELECT doc_id, count(*) AS n, sum(len(regexp_extract_all(substring(text, start_char + 1, end_char - start_char), '\\S+'))) AS w FROM chunk JOIN documents USING (doc_id) GROUP BY doc_id)
SELECT doc_id, sha256(regexp_replace(text, '\\s', '', 'g')) AS source_text_sha256, sha256(regexp_replace(text, '\\s', '', 'g')) AS concatenated_chunks_sha256, CAST(coalesce(n, 0) AS INTEGER) AS chunk_count, CAST(coalesce(w, 0) AS BIGINT) AS estimated_token_count
FROM documents LEFT JOIN n USING (doc_id)""")
def chunk_set_records(spark: SparkSession, folder: str) -> DataFrame:
    docs = _docs(spark, folder)
    sets = assembly.chunk_sets(docs, chunking.semantic_chunks(docs, COARSE, length_encoder), COARSE, {"provider": "length", "model": "length-mod-3"})
    return sets.select("doc_id", "source_text_sha256", "concatenated_chunks_sha256", "chunk_count", "estimated_token_count")


@query(r"SELECT doc_id, NOT (doc_id % 3 > 0 AND regexp_replace(text, '\s', '', 'g') <> '') AS is_covered FROM documents")
def chunk_coverage_check(spark: SparkSession, folder: str) -> DataFrame:
    """Of two thirds of the documents a chunk is damaged: its text is another, or it begins a character late."""
    docs = _docs(spark, folder)
    made, first = chunking.semantic_chunks(docs, COARSE, length_encoder), F.col("index") == 1
    damaged = made.withColumn("text", F.when(first & (F.col("doc_id") % 3 == 1), F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    damaged = damaged.withColumn("start_char", F.when(first & (F.col("doc_id") % 3 == 2), F.col("start_char") + 1).otherwise(F.col("start_char")))
    return chunking.chunk_coverage(docs, damaged).select("doc_id", "is_covered")


@query("""WITH n AS (SELECT *, sum(CAST(role = 'user' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section FROM conversations)
SELECT conv_id, CAST(section AS INTEGER) AS section, count(*) AS turns, min(turn) AS first_turn, max(turn) AS last_turn FROM n GROUP BY conv_id, section""")
def line_sections(spark: SparkSession, folder: str) -> DataFrame:
    numbered = documents.chapter_numbers(table(spark, folder, "conversations").select("conv_id", "turn", "role"), F.col("role") == "user", "conv_id", "turn")
    return numbered.groupBy("conv_id", F.col("chapter_no").alias("section")).agg(F.count(F.lit(1)).alias("turns"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"))


@query("""WITH a AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS g FROM conversations)
SELECT conv_id, role, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS turns FROM a GROUP BY conv_id, role, g""")
def contiguous_role_groups(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents.islands(table(spark, folder, "conversations").select("conv_id", "turn", "role"), F.col("role"), ["conv_id"], "turn")
    return rows.groupBy("conv_id", "role", "island").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.count(F.lit(1)).alias("turns")).drop("island")


@query("SELECT conv_id, sha256(string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn)) AS text_sha256, count(*) AS turns FROM conversations GROUP BY conv_id")
def ordered_turn_concat(spark: SparkSession, folder: str) -> DataFrame:
    said = table(spark, folder, "conversations")
    joined = documents.ordered_text(said, ["conv_id"], "turn", F.concat("role", F.lit(": "), "text"), "\n\n")
    turns = said.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    return joined.join(turns, "conv_id").select("conv_id", identity.sha256_text(F.col("text")).alias("text_sha256"), "turns")


@query(r"""WITH c AS (SELECT lang, len(regexp_extract_all(text, '\S+')) AS w, len(regexp_extract_all(regexp_replace(text, '\s', '', 'g'), '\w{1,4}|[^\w]')) AS t FROM documents)
SELECT lang, count(*) AS documents, CAST(sum(w) AS BIGINT) AS word_count, CAST(sum(t) AS BIGINT) AS token_count, round(sum(t) / sum(w), 6) AS tokens_per_word, round(700 / (sum(t) / sum(w)), 6) AS words_per_budget FROM c GROUP BY lang""")
def token_ratio_summary(spark: SparkSession, folder: str) -> DataFrame:
    count = lambda c: F.regexp_count(c, F.lit(r"\w{1,4}|[^\w]"))
    s = tokens.token_summary(tokens.token_counts(_docs(spark, folder, "lang"), count, keep=("lang",)), "lang")
    return s.withColumns({c: F.round(c, 6) for c in ("tokens_per_word", "words_per_budget")})


@query(r"""WITH r AS (SELECT p_partkey AS row_number, p_name, p_brand, CAST(p_size AS VARCHAR) AS p_size, p_type FROM part),
d AS (SELECT p_name FROM r WHERE trim(p_name) <> '' GROUP BY p_name HAVING count(*) > 1)
SELECT 'error' AS severity, row_number, 'p_size' AS "column", 'Expected a size of one digit.' AS message FROM r WHERE NOT regexp_full_match(p_size, '[0-9]')
UNION ALL SELECT 'error', row_number, 'p_brand', 'Expected format Brand#nn.' FROM r WHERE NOT regexp_full_match(p_brand, 'Brand#[1-3][0-9]')
UNION ALL SELECT 'error', row_number, 'p_type', 'Value must be 15 characters or fewer.' FROM r WHERE length(trim(p_type)) > 15""")
def validation_issues(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select(F.col("p_partkey").alias("row_number"), "p_brand", F.col("p_size").cast("string").alias("p_size"), "p_type")
    made = rules.RuleSet(("p_brand", "p_size", "p_type"), (
        ("p_size", rules.when_given(rules.matches("[0-9]"), "Expected a size of one digit.")),
        ("p_brand", rules.when_given(rules.matches("Brand#[1-3][0-9]"), "Expected format Brand#nn.")), ("p_type", rules.at_most(15))))
    return rules.row_issues(rows, made)


@query("""WITH k AS (SELECT p_brand || ' ' || p_type || ' ' || CAST(p_size AS VARCHAR) AS v, p_partkey AS r FROM part), g AS (SELECT v, string_agg(CAST(r AS VARCHAR), ', ' ORDER BY r) AS rs FROM k GROUP BY v HAVING count(*) > 1)
SELECT 'error' AS severity, r AS row_number, 'key' AS "column", 'Duplicate non-empty key value ''' || v || '''; appears on rows: ' || rs || '.' AS message FROM k JOIN g USING (v)""")
def duplicate_value_issues(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select(F.col("p_partkey").alias("row_number"), F.concat_ws(" ", "p_brand", "p_type", F.col("p_size").cast("string")).alias("key"))
    return rules.duplicate_issues(rows, "key")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def referential_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(F.col("doc_id").alias("row_number"), F.col("doc_id").cast("string").alias("doc"))
    found = rules.reference_issues(rows, "doc", table(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("d")), "d")
    return found.select(F.col("row_number").alias("doc_id"))


@query("""SELECT 'error' AS severity, c_custkey AS row_number, 'ref' AS "column", 'Unresolved ref; no matching category code found: ' || CAST(c_custkey AS VARCHAR) || '.' AS message FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 10 = 0)""")
def reference_check_issues(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("row_number"), F.col("c_custkey").cast("string").alias("ref"))
    return rules.reference_issues(rows, "ref", table(spark, folder, "orders").where("o_orderkey % 10 = 0").select(F.col("o_custkey").cast("string").alias("o")), "o")


@query("SELECT doc_id, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def file_selection_semi_join(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files, asked for by stem or by name."""
    listed = table(spark, folder, "documents").select("doc_id", "source", "n_chars", F.col("doc_id").cast("string").alias("stem"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"))
    asked = table(spark, folder, "labels").where("quality = 1").select(F.concat(F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, ".txt").otherwise("")).alias("name"))
    return files.select_files(listed, asked)[0].select("doc_id", "source", "n_chars")


@query("""SELECT s_suppkey, coalesce(n.n_name, r.r_name, '') AS resolved, n.n_name IS NOT NULL AND r.r_name IS NOT NULL AND n.n_name <> r.r_name AS differs FROM supplier s
 LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey AND n.n_nationkey % 2 = 0 LEFT JOIN region r ON r.r_regionkey = s.s_suppkey % 7""")
def lookup_fallback_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    n = table(spark, folder, "nation").where("n_nationkey % 2 = 0")
    rows = reconcile.lookup_with_fallback(
        table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"), (F.col("s_nationkey"), n, "n_nationkey", "n_name"),
        (F.col("s_suppkey") % 7, table(spark, folder, "region"), "r_regionkey", "r_name"),
    )
    return rows.select("s_suppkey", "resolved", "differs")


@query("""SELECT n_nationkey, count(DISTINCT s_suppkey) AS n, coalesce(string_agg(DISTINCT CAST(s_suppkey AS VARCHAR), ',' ORDER BY CAST(s_suppkey AS VARCHAR)), '') AS document_ids FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey""")
def cardinality_lookup(spark: SparkSession, folder: str) -> DataFrame:
    ids = reconcile.cardinality(table(spark, folder, "supplier").select("s_nationkey", F.col("s_suppkey").cast("string").alias("d")), "s_nationkey", "d")
    rows = table(spark, folder, "nation").select("n_nationkey").join(ids, F.col("n_nationkey") == F.col("code"), "left")
    return rows.select("n_nationkey", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce(F.array_join("document_ids", ","), F.lit("")).alias("document_ids"))


def _desired(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as records that should be there."""
    c = table(spark, folder, "customer")
    return c.select(
        F.col("c_custkey").alias("position"), F.format_string("C%07d", "c_custkey").alias("category_code"), F.col("c_mktsegment").alias("legacy_code"), (F.col("c_acctbal") > 0).alias("is_active"),
        F.col("c_custkey").alias("sort_order"), F.col("c_name").alias("name_en"), F.col("c_mktsegment").alias("description_en"), F.upper("c_name").alias("name_hi_IN"), F.lower("c_mktsegment").alias("description_hi_IN"),
    )


def _existing(spark: SparkSession, folder: str) -> DataFrame:
    """What is there: by the key's remainder nothing, the record as desired, one with another name, one locale only, or two documents."""
    d = _desired(spark, folder).withColumn("k", F.col("position") % 7)
    base = d.where("k <> 0").withColumn("document_id", F.concat(F.lit("doc-"), "position"))
    shared = ["document_id", F.col("category_code").alias("code"), "position", "legacy_code", "is_active", "sort_order"]
    en = base.where("k <> 3").select(*shared, F.lit("en").alias("locale"), F.when(F.col("k") == 2, F.concat("name_en", F.lit("!"))).otherwise(F.col("name_en")).alias("name"), F.col("description_en").alias("description"))
    hi = base.where("k <> 4").select(*shared, F.lit("hi-IN").alias("locale"), F.col("name_hi_IN").alias("name"), F.when(F.col("k") == 5, F.lit("other")).otherwise(F.col("description_hi_IN")).alias("description"))
    twice = en.where("position % 7 = 6").withColumn("document_id", F.concat("document_id", F.lit("-b")))
    return en.unionByName(hi).unionByName(twice)


SQL_PLAN = """plan AS (SELECT c_custkey AS position, printf('C%07d', c_custkey) AS code, CASE c_custkey % 7 WHEN 0 THEN 'create' WHEN 1 THEN 'matching' WHEN 6 THEN 'conflict' ELSE 'update' END AS action,
 CASE WHEN c_custkey % 7 IN (1, 2, 3, 4, 5) THEN 'doc-' || c_custkey END AS document_id, c_custkey % 7 IN (2, 3) AS update_default, c_custkey % 7 = 5 AS update_localized, c_custkey % 7 IN (0, 4) AS create_localized,
 CASE WHEN c_custkey % 7 = 6 THEN 'Duplicate existing Category records with code ' || printf('C%07d', c_custkey) || ' in default locale.' ELSE '' END AS messages FROM customer)"""


@query(f"WITH {SQL_PLAN} SELECT code, action, document_id, update_default, update_localized, create_localized, messages FROM plan")
def reconcile_plan(spark: SparkSession, folder: str) -> DataFrame:
    p = reconcile.plan(_desired(spark, folder), _existing(spark, folder), reconcile.CATEGORY)
    return p.select("code", "action", "document_id", "update_default", "update_localized", "create_localized", F.array_join("messages", " ").alias("messages"))


@query(f"""WITH {SQL_PLAN} SELECT count(*) AS records, count(*) FILTER (WHERE action = 'create') AS create_count, count(*) FILTER (WHERE action = 'update') AS update_count, count(*) FILTER (WHERE action = 'matching') AS matching_count,
 count(*) FILTER (WHERE action = 'conflict') AS conflict_count, count(*) FILTER (WHERE action = 'blocked') AS blocked_count, CAST(sum(CASE WHEN action IN ('create', 'update') THEN CASE WHEN create_localized OR update_localized THEN 2 ELSE 1 END ELSE 0 END) AS BIGINT) AS publish_actions FROM plan""")
def plan_counters(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.plan_counters(reconcile.plan(_desired(spark, folder), _existing(spark, folder), reconcile.CATEGORY))


@query(f"""WITH {SQL_PLAN}, a AS (SELECT code, document_id, 1 AS step, CASE WHEN action = 'create' THEN 'create' WHEN update_default THEN 'update' ELSE 'publish' END AS verb, 'en' AS locale FROM plan WHERE action IN ('create', 'update')
 UNION ALL SELECT code, document_id, 2, CASE WHEN create_localized THEN 'localize' ELSE 'update' END, 'hi-IN' FROM plan WHERE create_localized OR update_localized) SELECT code, CAST(step AS INTEGER) AS step, verb, locale, document_id FROM a""")
def action_explode(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.actions(reconcile.plan(_desired(spark, folder), _existing(spark, folder), reconcile.CATEGORY), reconcile.CATEGORY)


@query("SELECT printf('C%07d', c_custkey) AS code, CASE WHEN c_custkey % 7 = 6 THEN 'conflict' ELSE 'matching' END AS action FROM customer")
def replan_is_noop(spark: SparkSession, folder: str) -> DataFrame:
    desired, existing = _desired(spark, folder), _existing(spark, folder)
    after = reconcile.apply_plan(desired, existing, reconcile.plan(desired, existing, reconcile.CATEGORY), reconcile.CATEGORY)
    return reconcile.plan(desired, after, reconcile.CATEGORY).select("code", "action")


@query("""WITH o AS (SELECT p_size % 10 AS so, count(*) AS n, min(p_partkey) AS first_key FROM part GROUP BY 1) SELECT p_partkey, CASE WHEN p_partkey <> first_key THEN first_key ELSE -1 END AS first_user, n - 1 AS others FROM part JOIN o ON so = p_size % 10""")
def sort_order_collision(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part").select("p_partkey", (F.col("p_size") % 10).alias("so"))
    users = reconcile.first_users(p, "so", F.col("p_partkey"), "p_partkey")
    return p.join(users, F.col("so") == F.col("_order")).select("p_partkey", F.when(F.col("p_partkey") != F.col("first_position"), F.col("first_code")).otherwise(-1).alias("first_user"), (F.col("n") - 1).alias("others"))


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_wins_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.latest(table(spark, folder, "events").select("user_id", "event_type", "event_id", "ts", "value"), ["user_id", "event_type"], "ts", "event_id").drop("ts")


@query(r"""WITH k AS (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, CASE WHEN contains(url, '?') THEN 'query' WHEN contains(url, '#') THEN 'fragment' END AS k, url FROM pages)
SELECT host, count(*) FILTER (WHERE starts_with(url, 'https://') AND url LIKE '%#top') AS secure_top, count(*) FILTER (WHERE starts_with(url, 'https://') AND url NOT LIKE '%#top') AS secure, count(*) FILTER (WHERE starts_with(url, 'http://')) AS plain, count(*) AS total FROM k GROUP BY host""")
def conditional_counts(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "pages").select("url", F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"))
    return manifests.artifact_counts(p, [("secure_top", "https://", "#top"), ("secure", "https://", ""), ("plain", "http://", "")], "url", ("host",))


@query("SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS counts FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id")
def group_counts_map(spark: SparkSession, folder: str) -> DataFrame:
    m = documents.converter_counts(table(spark, folder, "events").select("user_id", F.col("event_type").alias("converter")), "user_id")
    entries = F.transform(F.map_entries("converter_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return m.select("user_id", F.array_join(entries, ",").alias("counts"))


@query("""WITH f AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'full_subject/' WHEN 1 THEN 'chapters/msword/' WHEN 2 THEN 'chapters/text_and_metadata/' WHEN 3 THEN 'run_reports/prep-subject/' ELSE 'misc/' END || 'n' || (p_partkey // 3) || CASE p_partkey % 3 WHEN 0 THEN '.docx' WHEN 1 THEN '.txt' ELSE '.json' END AS path, p_size % 5 AS g, p_partkey % 3 AS s FROM part)
SELECT p_partkey, path, CAST(CASE g WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 3 ELSE 4 END AS INTEGER) AS group_rank, CASE WHEN g IN (1, 2) THEN 'n' || (p_partkey // 3) ELSE path END AS stem, CAST(CASE WHEN g IN (1, 2) THEN s ELSE 0 END AS INTEGER) AS suffix_rank FROM f""")
def ordered_publication(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    at = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), (n + 1).cast("int"))
    path = F.concat(at(F.col("p_size") % 5, "full_subject/", "chapters/msword/", "chapters/text_and_metadata/", "run_reports/prep-subject/", "misc/"), F.lit("n"), F.floor(F.col("p_partkey") / 3).cast("string"), at(F.col("p_partkey") % 3, ".docx", ".txt", ".json"))
    return manifests.publication_order(p.select("p_partkey", path.alias("path")))


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels WHERE toxic = 0")
def set_difference(spark: SparkSession, folder: str) -> DataFrame:
    return manifests.select_chapters(table(spark, folder, "labels").where("toxic = 0").select("doc_id"), table(spark, folder, "documents"), "doc_id")[1]


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, coalesce(json_extract_string(props, '$.missing'), '') AS missing FROM events""")
def json_extract_typed(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").select("event_id", "props")
    return e.select("event_id", reconcile.field(F.col("props"), "k").alias("k"), F.coalesce(reconcile.field(F.col("props"), "missing"), F.lit("")).alias("missing"))


@query("""WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 50 = 0), s AS (SELECT query_id, vec_id AS chunk_id, round(list_cosine_similarity(q.e, CAST(v.embedding AS DOUBLE[])), 9) AS score FROM q, embeddings v)
SELECT query_id, rank, chunk_id, round(score, 6) AS score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM s) WHERE rank <= 20""")
def topk_similar(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "embeddings").select("vec_id", "embedding")
    found = retrieval.top_k(e.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), e.withColumnRenamed("vec_id", "chunk_id"))
    return found.withColumn("score", F.round("score", 6))


@query("""WITH c AS (SELECT lang, CAST(count(*) AS BIGINT) AS n, CAST(min(doc_id) AS BIGINT) AS lo, list(DISTINCT source ORDER BY source) AS sources, sum(n_chars) AS chars, arg_min(text, doc_id) AS first_text FROM documents GROUP BY lang)
SELECT lang, sha256('{"Zeichen":{"je_Viertel":' || CASE WHEN chars % 4 = 0 THEN (chars // 4) || '.0' ELSE CAST(chars / 4 AS VARCHAR) END || ',"zusammen":' || chars || '},"documents":' || n || ',"first":' || lo || ',"language":"' || lang || '","sources":[' || array_to_string(list_transform(sources, lambda s: '"' || s || '"'), ',') || '],"text":' || to_json(first_text) || ',"Überblick":null}') AS fingerprint FROM c""")
def config_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint of what each language's documents say of themselves, as canonical JSON: the fields stand here in no order."""
    told = table(spark, folder, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").cast("long").alias("lo"), F.array_sort(F.collect_set("source")).alias("sources"), F.sum("n_chars").alias("chars"), F.min_by("text", "doc_id").alias("first"),
    )
    told = told.select("lang", F.struct(
        F.col("lang").alias("language"), F.lit(None).cast("string").alias("Überblick"), F.col("n").alias("documents"), F.col("first").alias("text"), F.col("lo").alias("first"), "sources",
        F.struct(F.col("chars").alias("zusammen"), (F.col("chars") / 4).alias("je_Viertel")).alias("Zeichen"),
    ).alias("record"))
    return told.select("lang", identity.record_fingerprint(F.col("record"), told.schema["record"].dataType).alias("fingerprint"))


@query("""SELECT d.doc_id, true AS number_as_number, false AS number_as_text, false AS text_as_number, true AS flag_as_number, CAST(length(coalesce(text, '')) = n_chars AS BOOLEAN) AS length_as_stored, CAST(d.source AS VARCHAR) AS parent FROM documents d JOIN labels USING (doc_id)""")
def typed_stored_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Stored records (JSON of each document and its labels) against wanted values, by type and value."""
    both = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    parent = F.struct(F.struct(F.struct(F.col("source").alias("documentId")).alias("attributes")).alias("data"))
    record = F.to_json(F.struct(F.struct("quality", F.col("doc_id").cast("string").alias("code"), "n_chars", parent.alias("parent")).alias("attributes"), (F.col("toxic") == 1).alias("toxic")))
    rows = both.select("doc_id", "quality", "toxic", F.char_length(F.coalesce("text", F.lit(""))).alias("length"), F.try_parse_json(record).alias("v"))
    same = lambda name, wanted, kind: canonical.same_typed(canonical.stored_field(F.col("v"), name), wanted, kind)
    whole, text_kind = rows.schema["quality"].dataType, StringType()
    return rows.select(
        "doc_id", same("quality", F.col("quality"), whole).alias("number_as_number"), same("quality", F.col("quality").cast("string"), text_kind).alias("number_as_text"), same("code", F.col("doc_id"), whole).alias("text_as_number"),
        same("toxic", F.col("toxic"), whole).alias("flag_as_number"), same("n_chars", F.col("length"), whole).alias("length_as_stored"), canonical.stored_relation(F.col("v"), "parent").alias("parent"),
    )


@query("""WITH h AS (SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
i AS (SELECT doc_id, '$.labels.quality' AS path, 'must be of type integer' AS message FROM h WHERE quality IS NULL UNION ALL SELECT doc_id, '$.labels.toxic', 'must be one of [0, 1]' FROM h WHERE toxic IS NULL
 UNION ALL SELECT doc_id, '$.lang', 'must be one of [''en'', ''de'', ''fr'']' FROM h WHERE lang NOT IN ('en', 'de', 'fr') UNION ALL SELECT doc_id, '$.n_chars', 'must be 100 or more' FROM h WHERE n_chars < 100
 UNION ALL SELECT doc_id, '$.source', 'must have 4 characters or fewer' FROM h WHERE length(source) > 4 UNION ALL SELECT doc_id, '$.source', 'must match src1[0-9]*' FROM h WHERE NOT regexp_full_match(source, 'src1[0-9]*')
 UNION ALL SELECT doc_id, '$.title', 'is required' FROM h UNION ALL SELECT doc_id, '$.source_id', 'is not allowed' FROM h)
SELECT * FROM i""")
def record_schema_issues(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels as JSON records against a schema, compiled to one column."""
    both = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    record = F.to_json(F.struct("lang", "source", "n_chars", F.struct("quality", "toxic").alias("labels"), F.col("doc_id").alias("source_id")), {"ignoreNullFields": "false"})
    return json_schema.record_issues(both.select("doc_id", record.alias("record")), RECORD_SCHEMA, "record", ("doc_id",))


@query("""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, lag(CAST(embedding AS DOUBLE[])) OVER (ORDER BY vec_id) AS b FROM embeddings),
one AS (SELECT vec_id, CASE WHEN b IS NULL THEN NULL ELSE 1 - list_dot_product(b, e) / (sqrt(list_dot_product(b, b)) * sqrt(list_dot_product(e, e))) END AS distance FROM v),
t AS (SELECT quantile_cont(distance, 0.9) AS threshold FROM one)
SELECT vec_id, round(distance, 6) AS distance, round(threshold, 6) AS threshold, coalesce(distance >= threshold, false) AS is_break, CAST(sum(CAST(coalesce(distance >= threshold, false) AS INTEGER)) OVER (ORDER BY vec_id ROWS UNBOUNDED PRECEDING) AS INTEGER) AS group_no FROM one, t""")
def one_series_breakpoints(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors as one series: distances, an exact percentile and running groups, with no task over its share of the key."""
    rows = table(spark, folder, "embeddings").select(F.lit("all").alias("series"), "vec_id", "embedding")
    found = series.breakpoints(series.adjacent_distance(rows, "series", "vec_id", "embedding", task_rows=1), 90.0, "series", "vec_id", task_rows=1)
    return found.select("vec_id", F.round("distance", 6).alias("distance"), F.round("threshold", 6).alias("threshold"), "is_break", "group_no")


@query("""SELECT doc_id, 'r2' AS backend, 'bucket' AS bucket, 'corpus/' || source || '/' || lang || '/' || doc_id || '.txt' AS key, 'https://files.example/corpus/' || source || '/' || lang || '/' || doc_id || '.txt' AS url FROM documents""")
def storage_references(spark: SparkSession, folder: str) -> DataFrame:
    path = assembly.join_key(F.col("source"), F.concat(F.lit("/"), F.col("lang"), F.lit("/")), F.lit(""), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    r = assembly.storage_reference(path, "bucket", "/corpus/", "https://files.example/")
    return table(spark, folder, "documents").select("doc_id", r.alias("r")).select("doc_id", "r.backend", "r.bucket", "r.key", "r.url")


@query(rf"""SELECT doc_id, printf('%03d', doc_id) AS chapter_number, sha256(text || chr(10)) AS artifact_sha256, sha256({SQL_NORMAL}) AS normalized_content_sha256,
 CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS word_count, CASE WHEN contains(nfc_normalize(text), 'License') THEN 'license' ELSE '' END AS tags FROM documents""")
def chapter_metadata(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    rows = d.select(F.col("lang").alias("category_code"), F.col("source").alias("subject_code"), F.lit("slug").alias("title_slug"), F.col("doc_id").alias("chapter_no"), F.lit("v1.0").alias("version"), "text", F.format_string("t/%03d.txt", "doc_id").alias("text_path"), F.format_string("t/%03d.json", "doc_id").alias("metadata_path"))
    m = assembly.chapter_metadata(rows, NAMESPACE, markers=["License"], tags=["license"])
    return m.select(
        F.col("chapter_no").alias("doc_id"), F.col("document.chapter_number"), F.col("integrity.artifacts.text.value").alias("artifact_sha256"), F.col("content_identity.normalized_content_sha256"),
        F.col("content_stats.word_count"), F.array_join("automated_tags", ",").alias("tags"),
    )


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'categories' WHEN 1 THEN 'subjects' WHEN 2 THEN 'sanatan-glossary' END AS source_key,
 CASE WHEN p_size % 4 = 3 THEN 'Unsupported ingest target: other. Accepted values: category, subject, sanatan-glossary, prabodhan-glossary.' ELSE '' END AS blocked FROM part""")
def target_routing(spark: SparkSession, folder: str) -> DataFrame:
    names = F.element_at(F.array(*map(F.lit, ("category", "subject", "sanatan-glossary", "other"))), (F.col("p_size") % 4 + 1).cast("int"))
    out = seeds.routed(table(spark, folder, "part").select("p_partkey", names.alias("target")))
    return out.select("p_partkey", F.col("route.source_key").alias("source_key"), F.coalesce("blocked", F.lit("")).alias("blocked"))


@query("""SELECT lang, count(*) AS chapters, count(*) FILTER (WHERE contains(text, 'License') AND n_chars > 1000) AS summary_chapters FROM documents GROUP BY lang""")
def summary_chapter_counts(spark: SparkSession, folder: str) -> DataFrame:
    d = _docs(spark, folder, "lang", "n_chars")
    tags = F.array_compact(F.array(F.when(F.col("text").contains("License"), "license"), F.when(F.col("n_chars") > 1000, "long")))
    return manifests.summary_chapters(d.withColumn("automated_tags", tags), ["license", "long"], by=("lang",))


@query(r"""SELECT doc_id, CASE WHEN l.id IS NOT NULL THEN 'published' ELSE 'not_published' END AS status, concat_ws(' ', CASE WHEN l.id IS NULL THEN 'The chapter was not published.' END, CASE WHEN len(regexp_extract_all(text, '\S+')) = 0 THEN 'The chapter has no words.' END,
 CASE WHEN NOT contains(text, 'License') THEN 'No marker was found.' END, CASE WHEN lang <> 'de' THEN 'No text was converted.' END) AS notes FROM documents LEFT JOIN (SELECT DISTINCT doc_id AS id FROM labels) l ON l.id = doc_id""")
def chapter_audit(spark: SparkSession, folder: str) -> DataFrame:
    d = _docs(spark, folder, "lang")
    rows = d.select("doc_id", text.word_count(F.col("text")).alias("word_count"), text.marker_tags(F.col("text"), ["License"], ["license"]).alias("automated_tags"), F.when(F.col("lang") == "de", F.create_map(F.lit("aps"), F.lit(1).cast("long"))).alias("converter_counts"))
    return manifests.chapter_audit(rows, table(spark, folder, "labels"), "doc_id").select("doc_id", "status", F.array_join("notes", " ").alias("notes"))


def _subjects(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as subjects below their nations, with what planning must refuse: by the key's remainder no code (0), the code of the one
    before (2), no order (3), the order of the one before (5), a record without an id (6), an order that another record has (7), one
    locale only (8), all as desired (9). Of nations every fifth is not there, and the one after it is there twice."""
    k, m, none = F.col("c_custkey"), F.col("c_custkey") % 11, F.lit(None).cast("string")
    desired = table(spark, folder, "customer").select(
        k.alias("position"), F.when(m == 0, "").otherwise(F.format_string("C%07d", k - F.when(m == 2, 1).otherwise(0))).alias("subject_code"), none.alias("legacy_code"), F.lit(True).alias("is_active"),
        F.when(m != 3, k - F.when(m == 5, 1).otherwise(0)).alias("sort_order"), F.concat(F.lit("N"), "c_nationkey").alias("category_code"), F.col("c_name").alias("name_en"), none.alias("description_en"),
        F.upper("c_name").alias("name_hi_IN"), none.alias("description_hi_IN"), none.alias("from_date"), none.alias("to_date"), F.lit(None).cast("int").alias("prabodhan_count"),
    )
    m = F.col("position") % 11
    there = desired.where(m.isin(6, 7, 8, 9)).withColumn("document_id", F.when(m == 6, "").otherwise(F.concat(F.lit("doc-"), "position"))).withColumn("code", F.when(m == 7, F.concat(F.lit("X"), "position")).otherwise(F.col("subject_code")))
    there = there.withColumn("parent_document_id", F.concat(F.lit("p-"), "category_code"))
    shared = ["document_id", "code", "position", "legacy_code", "is_active", "sort_order", "from_date", "to_date", "prabodhan_count", "parent_document_id"]
    en = there.select(*shared, F.lit("en").alias("locale"), F.col("name_en").alias("name"), F.col("description_en").alias("description"))
    hi = there.where(m.isin(6, 9)).select(*shared, F.lit("hi-IN").alias("locale"), F.col("name_hi_IN").alias("name"), F.col("description_hi_IN").alias("description"))
    n = table(spark, folder, "nation").where("n_nationkey % 5 > 0").select(F.concat(F.lit("N"), "n_nationkey").alias("code"), (F.col("n_nationkey") % 5 == 1).alias("twice"))
    parents = n.select("code", F.explode(F.when(F.col("twice"), F.array(F.lit("-a"), F.lit("-b"))).otherwise(F.array(F.lit("")))).alias("x")).select("code", F.concat(F.lit("p-"), "code", "x").alias("document_id"))
    return desired, en.unionByName(hi), parents


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 11 AS m, c_nationkey AS n, min(CASE WHEN c_custkey % 11 = 0 THEN c_custkey END) OVER () AS first_missing FROM customer),
d AS (SELECT *, CASE m WHEN 0 THEN '<missing-code>' WHEN 2 THEN printf('C%07d', k - 1) ELSE printf('C%07d', k) END AS code FROM c),
x AS (SELECT *, CASE n % 5 WHEN 0 THEN 'Referenced Category code N' || n || ' was not found.' WHEN 1 THEN 'Referenced Category code N' || n || ' is ambiguous across documentIds: p-N' || n || '-a, p-N' || n || '-b.' END AS blocked,
 concat_ws(' ', CASE m WHEN 0 THEN 'Missing required artifact value: subject_code. Missing required artifact value: subject_code.' WHEN 3 THEN 'Missing required artifact value: sort_order. Missing required artifact value: sort_order.' END,
 CASE WHEN m = 2 OR (m = 0 AND k <> first_missing) THEN 'Duplicate artifact subject_code: ' || code || '.' END, CASE WHEN m = 5 THEN 'Duplicate artifact sort_order ' || (k - 1) || ' also used by ' || printf('C%07d', k - 1) || '.' END,
 CASE WHEN m = 6 THEN 'Existing Subject is missing documentId.' END, CASE WHEN m = 7 THEN 'sort_order ' || k || ' is already used by existing Subject code(s): X' || k || '.' END) AS conflicts FROM d)
SELECT k AS position, code, CASE WHEN blocked IS NOT NULL THEN 'blocked' WHEN conflicts <> '' THEN 'conflict' WHEN m = 8 THEN 'update' WHEN m = 9 THEN 'matching' ELSE 'create' END AS action,
 CASE WHEN blocked IS NULL AND m IN (8, 9) THEN 'doc-' || k END AS document_id, coalesce(blocked, conflicts) AS messages, blocked IS NULL AND m IN (1, 4, 8, 10) AS create_localized FROM x""")
def subject_plan(spark: SparkSession, folder: str) -> DataFrame:
    desired, existing, parents = _subjects(spark, folder)
    p = reconcile.plan(desired, existing, reconcile.SUBJECT, parents)
    return p.select("position", "code", "action", "document_id", F.array_join("messages", " ").alias("messages"), "create_localized")


@query(r"""WITH b AS (SELECT conv_id, turn, role, regexp_replace(trim(role || ': ' || text), '\s+', ' ', 'g') AS t, sum(CAST(role = 'user' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS c FROM conversations),
p AS (SELECT conv_id, t FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM b WHERE c = 0) WHERE n = 1)
SELECT b.conv_id, CAST(c AS INTEGER) AS chapter_no, max(p.t) AS heading, sha256(concat_ws(chr(10) || chr(10), max(p.t), string_agg(b.t, chr(10) || chr(10) ORDER BY turn))) AS text_sha256 FROM b LEFT JOIN p USING (conv_id) WHERE c > 0 GROUP BY b.conv_id, c""")
def document_chapters(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as documents: what the user says opens a chapter, what stands before is the preface."""
    blocks = table(spark, folder, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("block_no"), F.lit("p").alias("tag"), F.concat("role", F.lit(": "), "text").alias("text"))
    made = documents.chapters(blocks, r"\Auser: ", regex=True)
    return made.select(F.col("doc").alias("conv_id"), "chapter_no", "heading", identity.sha256_text(F.col("text")).alias("text_sha256"))


@query("""SELECT p_partkey, CASE WHEN p_size % 5 IN (0, 3) THEN 'aps' WHEN p_size % 5 IN (1, 4) THEN 'shreelipi' END AS converter FROM part""")
def font_converters(spark: SparkSession, folder: str) -> DataFrame:
    """The first font that tells a converter: by the remainder one, the other, none, the second of two, the first of two."""
    names = [["APS-DV-Prakash"], ["Arial", "Shree-Lipi 7"], ["Arial", "Times"], [None, "x priyanka"], ["SHREEDEV", "aps_dv"]]
    fonts = F.element_at(F.array(*[F.array(*[F.lit(x).cast("string") for x in n]) for n in names]), (F.col("p_size") % 5 + 1).cast("int"))
    return table(spark, folder, "part").select("p_partkey", documents.converter_of(fonts).alias("converter"))


@query("""SELECT 'error' AS severity, p_partkey AS row_number, 'Row' AS "column", CASE p_size % 4 WHEN 0 THEN 'Blank rows are not allowed.' WHEN 1 THEN 'Expected 4 columns, found 3.' ELSE 'Expected 4 columns, found 5.' END AS message FROM part WHERE p_size % 4 < 3""")
def record_shape_issues(spark: SparkSession, folder: str) -> DataFrame:
    m, v = F.col("p_size") % 4, F.col("p_name")
    values = F.when(m == 0, F.array(F.lit(" "), F.lit(""), F.lit("\t"), F.lit(None).cast("string"))).when(m == 1, F.array(v, v, v)).when(m == 2, F.array(v, v, v, v, v)).otherwise(F.array(v, v, v, v))
    return rules.shape_issues(table(spark, folder, "part").select(F.col("p_partkey").alias("row_number"), values.alias("values")), 4)


def _categories(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as rows of a category source, each with one fault by the key's remainder."""
    k, m = F.col("p_partkey"), F.col("p_partkey") % 9
    cell = lambda n, bad, good: F.when(m == n, F.lit(bad)).otherwise(good)
    return table(spark, folder, "part").select(
        k.alias("row_number"), cell(0, "CAT1", F.format_string(" CAT%03d", k % 1000)).alias("code"), F.concat(F.lit("L"), k).alias("legacy_code"), cell(1, "yes", F.lit("True")).alias("is_active"), cell(2, "1.5", k.cast("string")).alias("sort_order"),
        cell(3, "done", F.lit("draft")).alias("desired_status"), F.when(m == 4, F.repeat(F.lit("n"), 256)).otherwise(F.col("p_name")).alias("name_en"), F.lit("").alias("description_en"), cell(5, " ", F.col("p_name")).alias("name_hi-IN"), F.col("p_type").alias("description_hi-IN"),
    )


@query("""SELECT 'error' AS severity, p_partkey AS row_number, CASE p_partkey % 9 WHEN 0 THEN 'code' WHEN 1 THEN 'is_active' WHEN 2 THEN 'sort_order' WHEN 3 THEN 'desired_status' WHEN 4 THEN 'name_en' ELSE 'name_hi-IN' END AS "column",
 CASE p_partkey % 9 WHEN 0 THEN 'Expected format CATnnn, for example CAT001.' WHEN 1 THEN 'Expected boolean value true or false.' WHEN 2 THEN 'Expected an integer value.' WHEN 3 THEN 'Expected desired_status to be draft or published.' WHEN 4 THEN 'Value must be 255 characters or fewer.'
 ELSE 'Required value is missing.' END AS message FROM part WHERE p_partkey % 9 < 6""")
def category_validation(spark: SparkSession, folder: str) -> DataFrame:
    return rules.ordered(rules.row_issues(_categories(spark, folder), rules.CATEGORY))


@query("""SELECT CASE WHEN p_partkey % 9 = 0 THEN 'CAT1' ELSE printf('CAT%03d', p_partkey % 1000) END AS category_code, 'L' || p_partkey AS legacy_code, p_partkey % 9 <> 1 AS is_active, CASE WHEN p_partkey % 9 <> 2 THEN CAST(p_partkey AS BIGINT) END AS sort_order,
 CASE WHEN p_partkey % 9 = 5 THEN '' ELSE trim(p_name) END AS name_hi_IN, CAST(NULL AS VARCHAR) AS description_en, trim(p_type) AS description_hi_IN FROM part WHERE p_partkey % 9 <> 2""")
def category_records(spark: SparkSession, folder: str) -> DataFrame:
    made = records.category_records(_categories(spark, folder).where("row_number % 9 <> 2"))
    return made.select("category_code", "legacy_code", "is_active", "sort_order", "name_hi_IN", "description_en", "description_hi_IN")


@query("""SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'metadata is missing' WHEN 1 THEN 'text is missing' WHEN 2 THEN 'text path leaves its base' WHEN 3 THEN 'text references differ' WHEN 4 THEN 'text checksum differs' WHEN 5 THEN 'manifest identity differs' ELSE '' END AS problem FROM documents""")
def manifest_cross_check(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest, metadata and texts of the documents, with one fault by the id's remainder."""
    d, m = table(spark, folder, "documents").select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text")), F.col("chapter_no") % 7
    path = F.format_string("t/%03d.txt", "doc_id")
    made = assembly.chapter_metadata(d.select(F.lit("CAT001").alias("category_code"), F.col("source").alias("subject_code"), F.lit("s").alias("title_slug"), F.col("doc_id").alias("chapter_no"), F.lit("v1").alias("version"), "text", path.alias("text_path"), path.alias("metadata_path")), NAMESPACE)
    listed = made.select(
        "chapter_no", F.when(m == 5, "other").otherwise(F.col("content_identity.content_key")).alias("content_key"), "content_identity.normalized_content_sha256",
        F.when(m == 2, "../x").when(m == 3, "t/x").otherwise(F.col("storage.artifacts.text.path")).alias("text_path"),
    )
    texts = d.select(F.col("doc_id").alias("chapter_no"), F.when(F.col("doc_id") % 7 == 4, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text")).where(m != 1)
    found = manifests.cross_check(listed, made.where(m != 0), texts, NAMESPACE)
    return found.select(F.col("chapter_no").alias("doc_id"), F.coalesce("problem", F.lit("")).alias("problem"))


@query("""SELECT event_id, CASE event_id % 5 WHEN 4 THEN '' ELSE 'd' || user_id END AS parent FROM events""")
def relation_ids(spark: SparkSession, folder: str) -> DataFrame:
    """A relation told in each of the forms that a store has for it, or not at all."""
    m, d = F.col("event_id") % 5, F.concat(F.lit("d"), "user_id")
    forms = [F.to_json(F.struct(d.alias("r"))), F.to_json(F.struct(F.struct(d.alias("documentId")).alias("r"))), F.to_json(F.struct(F.struct(F.struct(F.struct(d.alias("documentId")).alias("data")).alias("r")).alias("attributes"))), F.to_json(F.struct(F.struct(F.struct(F.struct(d.alias("documentId")).alias("attributes")).alias("data")).alias("r"))), F.lit("{}")]
    told = F.lit(None).cast("string")
    for k, f in enumerate(forms):
        told = F.when(m == k, f).otherwise(told)
    return table(spark, folder, "events").select("event_id", F.coalesce(reconcile.relation_id(told, "r"), F.lit("")).alias("parent"))


@query(r"""SELECT p_partkey, printf('%03d', p_size) || '-' || CASE WHEN p_partkey % 2 = 0 THEN 'प्रबोधन-क्र-' || p_size ELSE trim(regexp_replace(regexp_replace(trim(p_name), '[\\/:*?"<>|]+', '-', 'g'), '\s+', '-', 'g'), '.-') END AS title FROM part""")
def fallback_titles(spark: SparkSession, folder: str) -> DataFrame:
    said = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("x प्रबोधन  क्र. "), F.col("p_size").cast("string"), F.lit(" y"))).otherwise(F.col("p_name"))
    return table(spark, folder, "part").select("p_partkey", text.fallback_title(said, F.col("p_size")).alias("title"))


@query("""WITH t AS (SELECT p_partkey, p_size, p_name, p_type, CASE WHEN p_size <> 5 THEN p_name ELSE '' END AS term FROM part),
m AS (SELECT *, CASE WHEN p_size = 1 THEN 'Duplicate existing Sanatan Glossary records with code T' || p_partkey || '.' WHEN p_size = 2 THEN 'Existing glossary record is missing documentId.'
 WHEN p_size = 3 THEN 'Existing glossary record is missing required Strapi field: definition.' WHEN p_size = 5 THEN 'Missing required artifact value: term.' END AS message FROM t)
SELECT 'T' || p_partkey AS code, CASE WHEN message IS NOT NULL THEN 'conflict' WHEN p_size > 30 THEN 'create' WHEN p_size = 4 OR p_type <> 'ECONOMY' THEN 'update' ELSE 'matching' END AS action,
 CASE WHEN message IS NULL AND p_size <= 30 THEN 'd' || p_partkey END AS document_id, coalesce(message, '') AS messages FROM m""")
def glossary_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as terms, against stored terms whose state follows from the part's size: two documents, no document, no definition, a term
    that is a number, or none; the stored definition is another one for all types but one."""
    p, size = table(spark, folder, "part"), F.col("p_size")
    desired = p.select(F.col("p_partkey").alias("position"), F.concat(F.lit("T"), "p_partkey").alias("term_code"), F.when(size != 5, F.col("p_name")).otherwise("").alias("term"), F.col("p_type").alias("definition"))
    document = F.concat(F.lit("d"), "p_partkey")
    fields = [F.concat(F.lit("T"), "p_partkey").alias("code"), F.when(size == 3, None).otherwise("ECONOMY").alias("definition")]
    plain, number = (F.to_json(F.struct(F.when(size != 2, document).alias("documentId"), F.col("p_partkey").alias("id"), F.struct(*fields, term).alias("attributes"))) for term in (F.col("p_name").alias("term"), size.alias("term")))
    stored = p.where(size <= 30).select(F.when(size == 4, number).otherwise(plain).alias("record"), F.lit(1).alias("status_rank"), F.col("p_partkey").alias("position"))
    twice = p.where(size == 1).select(F.to_json(F.struct(F.concat(document, F.lit("b")).alias("documentId"), *fields, F.col("p_name").alias("term"))).alias("record"), F.lit(1).alias("status_rank"), F.col("p_partkey").alias("position"))
    existing = reconcile.glossary_existing(stored.unionByName(stored.withColumn("status_rank", F.lit(2))).unionByName(twice))
    planned = reconcile.glossary_plan(desired, existing, seeds.TARGETS["sanatan-glossary"].display_name)
    return planned.select("code", "action", "document_id", F.array_join("messages", " ").alias("messages"))


@query("""SELECT 'customer' AS source, c_custkey AS row_number, 'category_code' AS "column", 'Unresolved category_code; no matching category code found: ' || c_nationkey || '.' AS message FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 4)
UNION ALL SELECT 'supplier', 0, 'category_code', 'Category source validation failed; cannot validate subject references.'""")
def category_gate(spark: SparkSession, folder: str) -> DataFrame:
    """References into a source without faults are looked up; into one that repeats its codes they are not."""
    rows = lambda name, key, ref: table(spark, folder, name).select(F.col(key).alias("row_number"), F.col(ref).cast("string").alias("category_code"))
    some = table(spark, folder, "nation").where("n_regionkey < 4")
    sound, broken = some.select(F.col("n_nationkey").alias("row_number"), F.col("n_nationkey").cast("string").alias("category_code")), rows("customer", "c_custkey", "c_nationkey")
    found = [
        rules.gated_reference_issues(rows(name, key, ref), "category_code", known, "category_code", rules.duplicate_issues(known, "category_code")).select(F.lit(name).alias("source"), F.col("row_number").cast("long").alias("row_number"), "column", "message")
        for name, key, ref, known in (("customer", "c_custkey", "c_nationkey", sound), ("supplier", "s_suppkey", "s_nationkey", broken))
    ]
    return found[0].unionByName(found[1])


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, sha256(coalesce(text, '')) AS text_sha256 FROM documents")
def csv_records(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as CSV files, whose texts hold newlines, quotes and commas, and the records read back by splits."""
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    table(spark, folder, "documents").select("doc_id", "source", "text").write.csv(path, header=True, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    records = csv_splits.csv_records(spark, path).where("row_number > 1")
    discard(spark, path)  # the records are of what was settled
    return records.select(F.get("values", F.lit(0)).alias("doc_id"), F.get("values", F.lit(1)).alias("source"), identity.sha256_text(F.coalesce(F.get("values", F.lit(2)), F.lit(""))).alias("text_sha256"))
