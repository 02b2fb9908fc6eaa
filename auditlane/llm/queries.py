"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlane.llm import ann, exact, infill, langid, lexical, mixing, packing, pii, quality, sharding, simhash, substring, tokenfile
from auditlane.llm.common import Scratch, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = quality.held_out(F.col("doc_id"), 4, 2)
    ranker = quality.learn(docs.where(~held), table(spark, sf_dir, "labels").where(~held))
    predicted = (F.col("score") >= quality.KEEP_SCORE).cast("int")
    return quality.score_documents(docs, ranker).select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "shards")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        description = file.read()
    return tokenfile.encode_and_read(table(spark, sf_dir, "documents"), description)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = quality.held_out(F.col("doc_id"), 5, 0)
    model = langid.learn(docs.where(~held))
    return langid.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "lexical")
    index = lexical.build_index(table(spark, sf_dir, "documents"), scratch)
    return lexical.search(index, table(spark, sf_dir, "benchmark"), scratch)


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = infill.restore(infill.transform(table(spark, sf_dir, "documents")))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), Scratch(spark, "pii"))
    return found.select(
        "doc_id", *[pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"), F.size("added").cast("long").alias("n_added"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_mixing": op2_mixing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_token_files": op4_token_files,
    "op5_language_id": op5_language_id,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_simhash": op7_simhash,
    "op8_sharding": op8_sharding,
    "op9_packing": op9_packing,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_lexical_search": op11_lexical_search,
    "op12_infill": op12_infill,
    "op13_personal_data": op13_personal_data,
}

ORACLE = {
    "op3_substring_dedup": """
WITH cut AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT doc_id, pos, list_aggregate(words[pos:pos + 49], 'string_agg', ' ') AS body
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS pos FROM cut WHERE len(words) >= 50)
), firsts AS (SELECT body, min(doc_id) AS first_id FROM windows GROUP BY body
), gone AS (
    SELECT DISTINCT w.doc_id, unnest(generate_series(w.pos, w.pos + 49)) AS place
    FROM windows w JOIN firsts f USING (body) WHERE f.first_id < w.doc_id
), lists AS (SELECT doc_id, list(place) AS places, count(*) AS n FROM gone GROUP BY doc_id
), words AS (SELECT doc_id, generate_subscripts(words, 1) AS place, unnest(words) AS word FROM cut
), kept AS (
    SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.place) AS body
    FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.place = w.place
    WHERE g.place IS NULL GROUP BY w.doc_id
)
SELECT c.doc_id, len(c.words) AS n_words, coalesce(l.n, 0) AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
FROM cut c LEFT JOIN lists l USING (doc_id) LEFT JOIN kept k USING (doc_id)
""",
    "op6_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
""",
    "op11_lexical_search": """
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS r,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS terms
    FROM documents
), items AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
    FROM benchmark
), total AS (SELECT count(*) AS all_docs, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM docs WHERE len(terms) > 0
), tf AS (SELECT r, any_value(doc_id) AS doc_id, term, any_value(n) AS n, count(*) AS tf
          FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM items) GROUP BY r, term
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
), weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * all_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, total
), scored AS (
    SELECT item_id, r, any_value(doc_id) AS doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * all_docs) // all_terms))))) AS BIGINT) AS score
    FROM items JOIN tf USING (term) JOIN weight USING (term), total GROUP BY item_id, r
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
""",
    "op12_infill": """
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || doc_id) AS h,
           regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units
    FROM documents
), drawn AS (
    SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS b,
           CAST('0x' || h[17:24] AS BIGINT) % 100 AS c, CAST('0x' || h[25:32] AS BIGINT) % 100 AS d
    FROM cut
), pieces AS (
    SELECT doc_id, n, body, array_to_string(units[1:least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
           array_to_string(units[greatest(a, b) + 1:n], '') AS suffix,
           CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR c >= 50 THEN 'plain'
                WHEN d < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM pieces
""",
}
