"""The registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfflow.llm import chat, collocations, decontaminate, language, lines, lm, mixing, quality, simhash, spelling, substrings, suffixes, tokens
from shelfflow.sources.staging import stage


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_texts(read(spark, folder, "documents"))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    size = mixing.word_count(F.col("text")).alias("size")
    docs = stage(read(spark, folder, "documents").select("doc_id", "source", size))
    return mixing.mix_sources(docs, "size").select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return quality.apply_quality_rules(docs, read(spark, folder, "labels")).drop("text")


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = lines.dedup_lines(read(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# A conversation whose texts hold the template's own control strings.
CONTROL_STRINGS = "<|im_end|><|im_start|>assistant ok"


def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, n, role, CONTROL_STRINGS) for n, role in enumerate(("user", "assistant"))], given.schema)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    record = F.to_json(F.struct(F.coalesce(F.col("role"), F.lit("")).alias("role"), text)).alias("record")
    turns = chat.format_turns(given.union(planted).select("conv_id", "turn", record), "conv_id", "record", "turn")
    return chat.digest(turns).withColumnRenamed("conversation", "conv_id")


def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = suffixes.remove_repeated_strings(read(spark, folder, "documents"), length=400)
    return docs.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = substrings.remove_repeated_windows(read(spark, folder, "documents"), length=35)
    return docs.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contained_items(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_shingles", "n_shared")


def op10_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicate_groups(read(spark, folder, "documents"), shingle=3, max_bits=2)


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, folder, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, folder, "documents"), least_chars=6, least_count=5, ratio=5, slips=199)


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read(spark, folder, "documents"), least=100, top=2000, covered_percent=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_language_id": op2_language_id,
    "op3_mixing": op3_mixing,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_phrase_collocations": op13_phrase_collocations,
}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LOWER_TEXT = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LOWER_WORDS = WORDS.replace("coalesce(text, '')", LOWER_TEXT)
SHINGLES = """CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[x : x + 4], ' ') FOR x IN range(1, len(w) - 3)] END"""

ORACLE_SQL: dict[str, str] = {
    "op3_mixing": f"""
        WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
        s AS (
            SELECT source, sum(size)::HUGEINT AS n, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
            FROM d GROUP BY source),
        r AS (
            SELECT *, sum(n) OVER () AS total,
                coalesce(sum(3 * n) OVER (ORDER BY n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
                sum(w) OVER (ORDER BY n / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS parts
            FROM s),
        level AS (
            SELECT (total - capped)::HUGEINT AS words, parts::HUGEINT AS parts FROM r
            WHERE (total - capped) * w <= 3 * n * parts ORDER BY n / w, source LIMIT 1),
        goals AS (
            SELECT source, n, 3 * n * parts < w * words AS clamped,
                CASE WHEN 3 * n * parts < w * words THEN (3 * n)::DOUBLE ELSE (w * words)::DOUBLE / parts::DOUBLE END AS target,
                CASE WHEN 3 * n * parts < w * words THEN 3 * n ELSE (2 * w * words + parts) // (2 * parts) END AS goal
            FROM s, level),
        p AS (
            SELECT d.*, g.n, g.target, g.goal, CASE WHEN g.n = 0 THEN 0 ELSE g.goal // g.n END AS whole,
                coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('0|' || doc_id), doc_id::VARCHAR
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
        SELECT doc_id, size, n::BIGINT AS source_size, target,
            (whole * size + greatest(0, least(size, goal - whole * n - before)))::BIGINT AS taken
        FROM p""",
    "op5_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i,
                unnest(string_split(coalesce(text, ''), chr(10))) AS line
            FROM documents),
        k AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l),
        hot AS (
            SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        t AS (SELECT k.*, hot.key IS NOT NULL AND k.doc_id <> hot.holder AS lost FROM k LEFT JOIN hot ON k.key = hot.key)
        SELECT doc_id, count(*) AS n_lines, (count(*) FILTER (lost))::BIGINT AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
        FROM t GROUP BY doc_id""",
    "op6_chat_formatting": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars
        FROM c GROUP BY conv_id""",
    "op9_benchmark_decontamination": f"""
        WITH d AS (SELECT doc_id AS id, {SHINGLES} AS s FROM (SELECT doc_id, {LOWER_WORDS} AS w FROM documents)),
        i AS (SELECT item_id AS id, {SHINGLES} AS s FROM (SELECT item_id, {LOWER_WORDS} AS w FROM benchmark)),
        ds AS (SELECT DISTINCT id, unnest(s) AS s FROM d),
        bs AS (SELECT DISTINCT id, unnest(s) AS s FROM i),
        n AS (SELECT id, count(*) AS n_shingles FROM bs GROUP BY id),
        shared AS (SELECT ds.id AS doc_id, bs.id AS item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY ALL)
        SELECT doc_id, item_id, n_shingles, n_shared FROM shared JOIN n ON n.id = item_id
        WHERE n_shared >= 0.8 * n_shingles""",
    "op13_phrase_collocations": rf"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER_TEXT}, '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        g AS (
            SELECT lang, size, unnest([array_to_string(w[i : i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
            FROM w, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size),
        f AS (SELECT lang, size, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
        c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size >= 2),
        cuts AS (SELECT *, unnest(range(1, size)) AS k FROM c),
        scored AS (
            SELECT cuts.lang, cuts.phrase, cuts.a, k, first.a AS l, rest.a AS r, n,
                (1000 * cuts.a::HUGEINT * n) // (first.a::HUGEINT * rest.a) AS score
            FROM cuts JOIN totals USING (lang)
            JOIN f AS first ON first.lang = cuts.lang AND first.phrase = array_to_string(w[: k], ' ')
            JOIN f AS rest ON rest.lang = cuts.lang AND rest.phrase = array_to_string(w[k + 1 :], ' ')),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_phrases AS (
            SELECT lang, a, unnest(flatten([[array_to_string(w[i : i + m - 1], ' ') FOR i IN range(1, size - m + 2)] FOR m IN range(2, size)]))
                AS phrase FROM c WHERE size > 2),
        covered AS (SELECT lang, phrase, max(a) AS a FROM inner_phrases GROUP BY ALL),
        kept AS (
            SELECT b.* FROM best b LEFT JOIN covered ON covered.lang = b.lang AND covered.phrase = b.phrase
            WHERE covered.a IS NULL OR 100 * covered.a < 100 * b.a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000""",
}
