"""Queries over the test tables, one per operator, and the SQL each must agree with where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import centroids, chat, cotrain, decontaminate, lm, merkle, packing, pieces, prefix, rules, simhash, suffix, warc
from ledgerspark.llm.common import table
from ledgerspark.sources.scratch import scratch_path


PIECE_MODEL = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix.fingerprint_documents(table(spark, sf_dir, "documents"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"), pieces.tokenizer_path(BYTE_RANKS))


def op4_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_digests(table(spark, sf_dir, "documents"), pieces.tokenizer_path(PIECE_MODEL))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), pieces.tokenizer_path(PIECE_MODEL))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.passage_digests(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.Archive(scratch_path(spark, "warc"))
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), archive)
    return warc.read_archives(manifest, archive)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    back = chat.read_back(chat.format_conversations(rows.unionByName(probe)))
    return back.select(
        "conv_id", "state", "valid",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        chat.trained_text().alias("trained"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id", "n_turns", "turns_sha256",
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars", "state", "valid",
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proof_digests(table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_prefix_fingerprints": op1_prefix_fingerprints,
    "op2_language_model": op2_language_model,
    "op3_quality_rules": op3_quality_rules,
    "op4_piece_encoding": op4_piece_encoding,
    "op5_packing": op5_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_warc": op7_warc,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_simhash": op10_simhash,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_benchmark_decontamination": op13_benchmark_decontamination,
}


def _leaf_text(n_chars: str) -> str:
    """The text of a leaf: each field with its length, in the manifest's order."""
    def field(value: str) -> str:
        text = f"CAST({value} AS VARCHAR)"
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({text})) || ':' || {text} END"

    return " || ".join(field(v) for v in ("doc_id", "source", "lang", n_chars, "text"))


def _crc32(text: str) -> str:
    bit = "lambda y, z: xor(y >> 1, 3988292384 * (y & 1))"
    byte = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {byte}), 4294967295)"


_PAIRED = "list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], '')))"


def _sibling(pos: str) -> str:
    return f"coalesce(nodes[CASE WHEN {pos} % 2 = 1 THEN {pos} ELSE {pos} + 2 END], '')"


def _folded(pos: str) -> str:
    return f"sha256(CASE WHEN {pos} % 2 = 1 THEN {_sibling(pos)} || below ELSE below || {_sibling(pos)} END)"


def _clustering(rounds: int) -> str:
    """Rounds of assigning and moving over (r, d, x), a row a component."""
    ctes = []
    for k in range(rounds + 1):
        ctes.append(f"""far{k} AS (
            SELECT r, c, sum((x - y) * (x - y)) AS dist FROM parts JOIN centre{k} USING (d) GROUP BY r, c
        ), near{k} AS (
            SELECT r, arg_min(c, (dist, c)) AS c, min(dist) AS dist FROM far{k} GROUP BY r
        )""")
        if k < rounds:
            ctes.append(f"""centre{k + 1} AS (
            SELECT c, d, coalesce((s - (s % n + n) % n) // n, y) AS y FROM centre{k} LEFT JOIN (
                SELECT c, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM parts JOIN near{k} USING (r) GROUP BY c, d
            ) USING (c, d)
        )""")
    return ", ".join(ctes)


ORACLES = {
    "op7_warc": """
        WITH rows AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), kept AS (
            SELECT payload_digest, max(page_id) AS kept FROM rows WHERE payload_bytes >= 1000
            GROUP BY payload_digest
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
            CASE WHEN kept IS NULL OR kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN kept <> page_id THEN kept END AS refers_to
        FROM rows LEFT JOIN kept USING (payload_digest)
    """,
    "op9_chat_formatting": """
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
        ), texts AS (
            SELECT *, replace(replace(replace(text, '\\', '\\0'), '</turn>', '\\1'), '### ', '\\2') AS safe,
                replace(replace(replace(replace(role, '\\', '\\0'), '</turn>', '\\1'), '### ', '\\2'),
                    ': ', '\\3') AS safe_role
            FROM rows
        ), whole AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                    ORDER BY turn, role, text), '') AS trained,
                sum(length('### ' || safe_role || ': ' || safe || '</turn>' || chr(10))) AS formatted_chars,
                bool_and(allowed) AS valid, last(role ORDER BY turn, role, text) AS last_role
            FROM (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), 'start') || '>' || role
                IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') AS allowed FROM texts)
            GROUP BY conv_id
        )
        SELECT conv_id, n_turns, CASE WHEN valid THEN last_role ELSE 'invalid' END AS state, valid, sha256(turns) AS turns_sha256, length(trained) AS loss_chars,
            sha256(trained) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM whole
    """,
    "op3_quality_rules": """
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
                regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
        ), lines AS (
            SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
                SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
            WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
        ), windows AS (
            SELECT r, i, w FROM (
                SELECT r, unnest(range(1, len(words) - 1)) AS i,
                    unnest(list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2])) AS w
                FROM texts WHERE len(words) > 2)
        ), found AS (
            SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1
        ), repeats AS (
            SELECT r, count(DISTINCT i + k) AS n_repeat_words
            FROM found, (VALUES (0), (1), (2)) AS s(k) GROUP BY r
        ), counted AS (
            SELECT doc_id, source, len(words) AS n_words,
                CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                coalesce(n_lines, 0) AS n_lines
            FROM texts LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
        ), ruled AS (
            SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeats,
                100 * n_symbols > 10 * word_chars AS symbols, 100 * n_dup_lines > 30 * n_lines AS lines
            FROM counted
        ), hosts AS (
            SELECT source, rule, count(*) AS n, sum(CAST(failed AS BIGINT)) AS failed
            FROM ruled UNPIVOT (failed FOR rule IN (short, repeats, symbols, lines)) GROUP BY source, rule
        ), prior AS (
            SELECT rule, avg(failed / n) AS mean, var_samp(failed / n) AS var FROM hosts GROUP BY rule
        ), strength AS (
            SELECT rule, mean, least(greatest(CASE WHEN coalesce(var, 0) = 0 THEN 1000
                ELSE mean * (1 - mean) / var - 1 END, 1), 1000) AS strength FROM prior
        ), strict AS (
            SELECT source, max(CASE WHEN rule = 'short' THEN k END) AS short_k,
                max(CASE WHEN rule = 'repeats' THEN k END) AS repeats_k,
                max(CASE WHEN rule = 'symbols' THEN k END) AS symbols_k,
                max(CASE WHEN rule = 'lines' THEN k END) AS lines_k
            FROM (SELECT source, rule, CASE WHEN mean = 0 THEN 1
                ELSE greatest(round((failed + mean * strength) / (n + strength) / mean, 6), 1) END AS k
                FROM hosts JOIN strength USING (rule)) GROUP BY source
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
            short OR repeats AS base_failed,
            NOT (n_words < least(50 * short_k, 80) OR 100 * n_repeat_words > greatest(50 / repeats_k, 30) * n_words
                OR 100 * n_symbols > greatest(10 / symbols_k, 5) * word_chars
                OR 100 * n_dup_lines > greatest(30 / lines_k, 10) * n_lines) AS kept
        FROM ruled JOIN strict ON ruled.source IS NOT DISTINCT FROM strict.source
    """,
    "op11_merkle_manifest": f"""
        WITH RECURSIVE rows AS (
            SELECT row_number() OVER () AS r, * FROM documents
        ), leaves AS (
            SELECT r, doc_id, lang, sha256({_leaf_text('n_chars')}) AS leaf, sha256({_leaf_text('n_chars + 1')}) AS changed,
                {_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 AS tampered
            FROM rows
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos FROM leaves
        ), levels AS (
            SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
            UNION ALL SELECT lang, level + 1, {_PAIRED} FROM levels WHERE len(nodes) > 1
        ), subroots AS (
            SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
            FROM levels WHERE len(nodes) = 1
        ), top AS (
            SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
            UNION ALL SELECT level + 1, {_PAIRED} FROM top WHERE len(nodes) > 1
        ), climbed AS (
            SELECT r, lang, pos, 0 AS level, CASE WHEN tampered THEN changed ELSE leaf END AS below, '' AS proof FROM placed
            UNION ALL SELECT r, c.lang, pos // 2, c.level + 1, {_folded('pos')}, proof || {_sibling('pos')}
            FROM climbed c JOIN levels l ON c.lang IS NOT DISTINCT FROM l.lang AND c.level = l.level
            WHERE len(nodes) > 1
        ), below_top AS (
            SELECT r, place AS pos, subroot, below, proof FROM climbed c JOIN (SELECT lang, max(level) AS level FROM levels
                GROUP BY lang) h ON c.lang IS NOT DISTINCT FROM h.lang AND c.level = h.level
            JOIN subroots s ON c.lang IS NOT DISTINCT FROM s.lang
        ), topped AS (
            SELECT r, subroot, pos, 0 AS level, below, proof FROM below_top
            UNION ALL SELECT r, subroot, pos // 2, c.level + 1, {_folded('pos')}, proof || {_sibling('pos')}
            FROM topped c JOIN top l ON c.level = l.level WHERE len(nodes) > 1
        )
        SELECT doc_id, leaf, subroot, nodes[1] AS root, sha256(proof) AS proof_sha256, below AS folded_root,
            below = nodes[1] AS verified
        FROM placed JOIN topped USING (r) JOIN top ON top.level = topped.level WHERE len(nodes) = 1
    """,
    "op12_centroid_clustering": f"""
        WITH rows AS (
            SELECT row_number() OVER () AS r, vec_id,
                list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = 64
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        ), parts AS (
            SELECT r, unnest(range(64)) AS d, unnest(v) AS x FROM rows
        ), first AS (
            SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id), r) - 1 AS c FROM rows QUALIFY c < 16
        ), centre0 AS (
            SELECT c, d, x AS y FROM first JOIN parts USING (r)
        ), {_clustering(3)}, shas AS (
            SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM centre3 GROUP BY c
        )
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
            CAST(sum(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
            CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM near3 JOIN rows USING (r) JOIN shas USING (c)
    """,
    "op13_benchmark_decontamination": """
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), items AS (
            SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark
        ), item_windows AS (
            SELECT DISTINCT item, size, words[i:i + size - 1] AS w FROM (
                SELECT *, least(10, len(words)) AS size, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
                FROM items WHERE len(words) > 0)
        ), sizes AS (
            SELECT DISTINCT size FROM item_windows
        ), doc_windows AS (
            SELECT r, size, i, words[i:i + size - 1] AS w FROM (
                SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i
                FROM docs, sizes WHERE len(words) >= size)
        ), found AS (
            SELECT r, i, d.size, item FROM doc_windows d JOIN item_windows t ON d.w = t.w AND d.size = t.size
        ), hits AS (
            SELECT r, count(DISTINCT p) AS n_hit FROM (
                SELECT DISTINCT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY r
        ), named AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
    """,
}
