"""The queries of this subpackage, op<N>_<name>, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, conversations, decontaminate, html_text, line_dedup, lm_score, pieces, pii, simhash, spelling, substring_dedup, toxicity, url_filter
from .common import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentation of every text, decoded again and held against the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.round_trip(docs)
    given = F.coalesce("text", F.lit(""))
    return both.select(
        "doc_id", F.char_length(given).cast("long").alias("n_chars"), F.size("pieces").cast("long").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_xxh64"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), (F.col("decoded") == given).alias("lossless"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def _is(kind: str):
    return lambda span: span["kind"] == kind


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_<kind> counts the base spans; spans lists base and added ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.train(docs))
    counts = [F.size(F.filter("base_spans", _is(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.spell("base_spans").cast("binary"), 256).alias("base_sha256"), pii.spell(F.concat("base_spans", "added_spans")).alias("spans"), F.size("added_spans").cast("long").alias("n_added"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages, html_text.train(pages)).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(toxicity.may_teach()))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (~toxicity.may_teach()).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, url_filter.rules_of(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversations.assess(turns, conversations.damaged(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_pii": op5_pii,
    "op6_html_extraction": op6_html_extraction,
    "op7_toxicity": op7_toxicity,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_url_filter": op12_url_filter,
    "op13_conversation_repair": op13_conversation_repair,
}

#: crc32 of the text ``s`` of a row, from a table of 256 remainders made by its rule.
SQL_CRC_TABLE = """crc AS (SELECT list(c ORDER BY i) AS tbl FROM (SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i)))"""
SQL_CRC = """xor(list_reduce([4294967295] || flatten(list_transform(string_split(s, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [192 + (ord(x) >> 6), 128 + (ord(x) & 63)] END)), lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295)"""


def _add(state: int, cost: str, letter: str) -> str:
    """SQL of a state's cost (nine digits) and audit with one more edit."""
    return f"printf('%09d', CAST(left(a[{state}], 9) AS INTEGER) + {cost}) || substr(a[{state}], 10) || '{letter}'"


def _keep_or_change(to: int, arcs: tuple[tuple[int, str, str], ...], cost: str) -> str:
    late = "CASE WHEN x[1] IN ('S', 'U', 'A', 'O') THEN 1 ELSE 0 END"
    return ", ".join(f"CASE WHEN {f"lower(x[1]) = '{role}'" if role else "x[1] <> 'x'"} THEN {_add(p, f'{cost if not role else 0} + {late}', letter)} END" for p, role, letter in arcs)


#: States 1 to 4: begin, after the system, after the user, after the assistant.
_USER = tuple((p, "u", "K") for p in (1, 2, 4)) + tuple((p, "", "R") for p in (1, 2, 4))
SQL_STEP = f"""[{_add(1, '3', 'D')},
 least({_add(2, '3', 'D')}, {_keep_or_change(2, ((1, 's', 'K'),), '2')}),
 least({_add(3, '3', 'D')}, {_keep_or_change(3, _USER, '2')}),
 least({_add(4, '3', 'D')}, {_keep_or_change(4, ((3, 'a', 'K'), (3, '', 'S')), '2')})]"""
SQL_INSERT = f"[a[1], a[2], least(a[3], {_add(1, '2', 'I')}, {_add(2, '2', 'I')}, {_add(4, '2', 'I')}), least(a[4], {_add(3, '2', 'J')})]"

ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP9_WORDS = "list_filter(regexp_split_to_array(" + ASCII_LOWER.format("coalesce(text, '')") + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

ORACLE: dict[str, str] = {
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 34), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
r AS (SELECT g FROM p GROUP BY g HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM p JOIN r USING (g))),
k AS (SELECT d.doc_id, j, x FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d) d ANTI JOIN c USING (doc_id, j)),
t AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY j) AS s FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)""",
    # exact search: the tables that SQL is run on fit one block, where the operator's windows hold all rows
    "op8_nearest_neighbours": """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS l FROM v),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) / (q.l * c.l) AS score FROM n q JOIN n c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 AND q.l > 0 AND c.l > 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op9_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {OP9_WORDS} AS w FROM documents),
b AS (SELECT item_id, {OP9_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(g) AS n FROM win),
pos AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM pos JOIN win USING (g)),
cov AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op10_line_dedup": rf"""
WITH l AS (SELECT doc_id, i, line, {ASCII_LOWER.format("trim(line, E' \t\n\x0b\x0c\r')")} AS key FROM
 (SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
f AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN f USING (key) GROUP BY doc_id""",
    "op11_spelling_variants": rf"""
WITH RECURSIVE {SQL_CRC_TABLE},
t AS (SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS d, {ASCII_LOWER.format("r")} AS r FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents) WHERE length(r) >= 6),
h AS (SELECT r, {SQL_CRC} AS h FROM (SELECT r, d || ':' || r AS s FROM t), crc),
words AS (SELECT word, count(*) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, CAST(h % length(r) AS INTEGER)) || substr(r, CAST(h % length(r) AS INTEGER) + 2) ELSE r END AS word FROM h) WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
cut AS (SELECT word, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (hole) WHERE a.word <> b.word UNION SELECT a.word, b.word FROM cut a JOIN words b ON a.less = b.word UNION SELECT b.word, a.word FROM cut a JOIN words b ON a.less = b.word),
best AS (SELECT n.word, count(*) AS n_near, first(other ORDER BY o.n DESC, other) AS other, max(o.n) AS m FROM near n JOIN words o ON o.word = n.other GROUP BY n.word),
forms AS (SELECT word, other AS form, m FROM best JOIN words USING (word) WHERE m >= 5 * n),
chain AS (SELECT word, form AS root, 1 AS k FROM forms UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN forms f ON f.word = c.root),
ends AS (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word)
SELECT w.word, form, coalesce(root, w.word) AS root, n, coalesce(n_near, 0) AS n_near, f.m AS form_n
FROM words w LEFT JOIN best b USING (word) LEFT JOIN forms f USING (word) LEFT JOIN ends USING (word)""",
    "op12_url_filter": f"""
WITH rules(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
k AS (SELECT page_id, {ASCII_LOWER.format("coalesce(regexp_extract(rest, '^[^/?#]*'), '')")} AS host, coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') AS path FROM u),
d AS (SELECT DISTINCT host, path FROM k),
b AS (SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict FROM d, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, k.host, k.path, rule, coalesce(verdict, 'allow') AS verdict FROM k LEFT JOIN b ON b.host = k.host AND b.path = k.path""",
    "op13_conversation_repair": rf"""
WITH {SQL_CRC_TABLE},
g AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
f AS (SELECT conv_id, turn, role, text, {SQL_CRC} % 20 AS h FROM g, crc),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM f WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, E' 	
') AS seen, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM d),
k AS (SELECT *, CASE WHEN seen = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault, left(role, 1) || coalesce(left(lead(role) OVER (PARTITION BY conv_id ORDER BY i), 1), '+') AS pair FROM o),
e AS (SELECT *, CASE WHEN fault IN ('b', 'd') THEN 'x' WHEN fault = 't' THEN upper(CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END) WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS kind FROM k),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
 count(*) FILTER (pair NOT IN ('su', 'ua', 'au') AND NOT ends_with(pair, '+')) AS illegal, list([kind] ORDER BY i) AS kinds FROM e GROUP BY conv_id),
p AS (SELECT * EXCLUDE kinds, list_reduce([['000000000', NULL, '000000002I', '000000004IJ']] || kinds, lambda acc, x: list_transform([list_transform([acc], lambda a: {SQL_STEP})[1]], lambda b: list_transform([list_transform([b], lambda a: {SQL_INSERT})[1]], lambda a: {SQL_INSERT})[1])[1]) AS z FROM c),
r AS (SELECT * EXCLUDE z, CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS edits FROM (SELECT *, least(z[1], z[4]) AS best FROM p)),
tok AS (SELECT conv_id, unnest(tk) AS token, unnest(range(1, len(tk) + 1)) AS i FROM (SELECT conv_id, regexp_extract_all(edits, '[IJ]*[DKRS]|[IJ]+$') AS tk FROM r)),
lines AS (SELECT t.conv_id, t.i, list_transform(list_filter(string_split(token, ''), lambda l: l <> 'D'), lambda l: CASE l WHEN 'I' THEN 'user:' WHEN 'J' THEN 'assistant:' WHEN 'R' THEN 'user:' || text WHEN 'S' THEN 'assistant:' || text ELSE role || ':' || text END) AS part FROM tok t LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM t.conv_id AND e.i = t.i),
s AS (SELECT conv_id, sha256(array_to_string(flatten(list(part ORDER BY i)), chr(10))) AS sha FROM lines GROUP BY conv_id)
SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, translate(coalesce(edits, ''), 'JS', 'IR') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM q.conv_id""",
}
