"""Registered queries of the text operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.llm.bpe import bpe_digests
from martline.llm.common import held_out, known_labels, table, training_rows
from martline.llm.exact_dedup import exact_dedup
from martline.llm.fertility import quality_verdicts
from martline.llm.merkle import folded_root, leaf_hash, merkle_proofs
from martline.llm.packing import pack_digests
from martline.llm.phrases import collocations
from martline.llm.pieces import piece_digests
from martline.llm.pii import find_pii
from martline.llm.quality import document_statistics, score_quality, train_quality
from martline.llm.quotes import link_quotes
from martline.llm.simhash import simhash_components
from martline.llm.toxicity import score_toxicity, train_toxicity
from martline.llm.warc import archive_pages

#: Scores from here on predict label 1.
THRESHOLD = 0.7


def op1_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(training_rows(docs, table(spark, sf_dir, "labels"), "toxic", 3, 1))
    return score_toxicity(docs, model).select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op3_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_found")


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_components(docs).select("doc_id", "fingerprint", "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_verdicts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "chars_per_token", "byte_share", "entropy", "chars_per_piece", "script")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_statistics(table(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = known_labels(table(spark, sf_dir, "labels"), "quality", 4, 2)
    seen = rows.select(F.col("_row.doc_id").alias("doc_id"), F.col("_stats").alias("stats")).join(labels, "doc_id")
    model = train_quality(seen.withColumnRenamed("doc_id", "id"))
    return score_quality(rows, model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def quoting_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as a mail thread: each turn but the first quotes an earlier one of its conversation.

    Every third turn answers the first turn, the others the one before; the
    answered text stands at level 1, the first line of the text before it at
    level 2, below a line that introduces them.
    """
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = talk.filter("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    answered = F.when(F.col("turn") % 3 == 2, F.lit(0)).otherwise(F.col("turn") - 1)
    talk = (talk.withColumn("_to", answered).withColumn("_before", F.col("_to") - 1)
            .join(said.select("conv_id", F.col("turn").alias("_to"), F.col("text").alias("_one")), ["conv_id", "_to"], "left")
            .join(said.select("conv_id", F.col("turn").alias("_before"), F.substring_index("text", "\n", 1).alias("_two")),
                  ["conv_id", "_before"], "left"))
    quote = F.concat(F.lit("Someone wrote:\n"), F.coalesce(F.concat(F.lit("> > "), F.col("_two"), F.lit("\n")), F.lit("")),
                     F.lit("> "), F.replace("_one", F.lit("\n"), F.lit("\n> ")), F.lit("\n\n"))
    return talk.select("conv_id", "turn", "role", F.concat(F.coalesce(quote, F.lit("")), F.coalesce("text", F.lit(""))).alias("text"))


def op9_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(quoting_view(spark, sf_dir)).select(
        "conv_id", "turn", "role", "reply_text", "n_quotes", "parent_turn", "thread_turn", "depth", "position", "chat_text")


def op10_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))

    def leaf(n_chars: Column) -> Column:
        return leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    original = leaf(F.col("n_chars"))
    rows = docs.select("doc_id", "lang", original.alias("leaf"),
                       F.when(tampered, leaf(F.col("n_chars") + 1)).otherwise(original).alias("claimed"))
    proofs = merkle_proofs(rows, "doc_id", "lang")
    folded = folded_root(*map(F.col, ("claimed", "position", "leaves", "subtree", "subtrees", "proof")))
    return proofs.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


QUERIES = {
    "op1_curve_packing": op1_curve_packing,
    "op2_toxicity_lexicon": op2_toxicity_lexicon,
    "op3_contextual_pii": op3_contextual_pii,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_quote_linking": op9_quote_linking,
    "op10_warc_index": op10_warc_index,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_collocations": op12_collocations,
    "op13_piece_round_trip": op13_piece_round_trip,
}

ORACLES = {
    "op5_exact_dedup": """
        WITH n AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
        FROM n
    """,
    "op9_quote_linking": r"""
        WITH RECURSIVE said0 AS (
            SELECT conv_id, turn, min(text) AS text FROM conversations WHERE turn IS NOT NULL GROUP BY conv_id, turn
        ), asked AS (
            SELECT *, CASE WHEN turn % 3 = 2 THEN 0 ELSE turn - 1 END AS to_turn FROM conversations
        ), quoting AS (
            SELECT a.conv_id, a.turn, a.role, row_number() OVER () AS rid,
                   coalesce('Someone wrote:' || chr(10)
                            || coalesce('> > ' || split_part(two.text, chr(10), 1) || chr(10), '')
                            || '> ' || replace(one.text, chr(10), chr(10) || '> ') || chr(10) || chr(10), '')
                   || coalesce(a.text, '') AS text
            FROM asked a LEFT JOIN said0 one ON one.conv_id = a.conv_id AND one.turn = a.to_turn
            LEFT JOIN said0 two ON two.conv_id = a.conv_id AND two.turn = a.to_turn - 1
        ), cut AS (
            SELECT rid, string_split_regex(text, '\r?\n') AS parts FROM quoting
        ), numbered AS (
            SELECT rid, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS line FROM cut
        ), lines AS (
            SELECT rid, i, regexp_replace(line, '^((?:[ \t]?>)+)[ \t]?', '') AS body,
                   length(regexp_replace(regexp_extract(line, '^((?:[ \t]?>)+)[ \t]?', 1), '[^>]', '', 'g')) AS level
            FROM numbered
        ), marked AS (
            SELECT *, lag(level) OVER (PARTITION BY rid ORDER BY i) AS level_before,
                   coalesce(lead(level) OVER (PARTITION BY rid ORDER BY i), 0) AS level_after,
                   regexp_matches(body, '(?i)^.{0,200}\b(wrote|writes|schrieb|a écrit|escribió)\s?:\s*$') AS introduces
            FROM lines
        ), own AS (
            SELECT rid, regexp_replace(coalesce(string_agg(body, chr(10) ORDER BY i)
                        FILTER (level = 0 AND NOT (introduces AND level_after > 0)), ''), '\A\s+|\s+\z', '', 'g') AS reply_text,
                   count(*) FILTER (level > 0 AND level IS DISTINCT FROM level_before) AS n_quotes
            FROM marked GROUP BY rid
        ), runs AS (
            SELECT rid, i, body, level,
                   sum(CASE WHEN level IS DISTINCT FROM level_before THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS run
            FROM marked
        ), texts AS (
            SELECT rid, level, string_agg(body, chr(10) ORDER BY i) AS text FROM runs WHERE level > 0 GROUP BY rid, run, level
            UNION ALL SELECT rid, 0, reply_text FROM own
        ), parts AS (
            SELECT rid, level, true AS whole, text AS part FROM texts
            UNION ALL SELECT rid, level, false, unnest(string_split_regex(text, '\n\s*\n')) FROM texts
            UNION ALL SELECT rid, level, false, unnest(string_split(text, chr(10))) FROM texts
        ), clean AS (
            SELECT q.conv_id, q.turn, u.level, u.unit
            FROM (SELECT rid, level, whole, trim(regexp_replace(lower(part), '\s+', ' ', 'g')) AS unit FROM parts) u
            JOIN quoting q ON q.rid = u.rid
            WHERE u.unit <> '' AND (u.whole OR length(u.unit) >= 8) AND q.conv_id IS NOT NULL AND q.turn IS NOT NULL
        ), said AS (
            SELECT conv_id, unit, min(turn) AS said FROM clean WHERE level = 0 GROUP BY conv_id, unit
        ), quoted AS (
            SELECT conv_id, turn, unit, min(level) AS level, max(length(unit)) AS chars
            FROM clean WHERE level > 0 GROUP BY conv_id, turn, unit
        ), weighed AS (
            SELECT conv_id, turn, said, level, sum(chars) AS chars FROM quoted JOIN said USING (conv_id, unit)
            WHERE said < turn GROUP BY conv_id, turn, said, level
        ), links AS (
            SELECT conv_id, turn, said AS parent FROM (
                SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, chars DESC, said DESC) AS rn FROM weighed)
            WHERE rn = 1
        ), chain AS (
            SELECT conv_id, turn, parent, parent AS first, 1 AS steps FROM links
            UNION ALL
            SELECT c.conv_id, c.turn, c.parent, l.parent, c.steps + 1
            FROM chain c JOIN links l ON l.conv_id = c.conv_id AND l.turn = c.first
        ), ends AS (
            SELECT conv_id, turn, any_value(parent) AS parent, arg_max(first, steps) AS first, max(steps) AS steps
            FROM chain GROUP BY conv_id, turn
        )
        SELECT q.conv_id, q.turn, q.role, o.reply_text, o.n_quotes, e.parent AS parent_turn,
               coalesce(e.first, q.turn) AS thread_turn, coalesce(e.steps, 0) AS depth,
               row_number() OVER (PARTITION BY q.conv_id ORDER BY coalesce(e.first, q.turn) NULLS FIRST, q.turn NULLS FIRST, q.rid) AS position,
               '<|' || coalesce(q.role, 'unknown') || '|>' || chr(10) || o.reply_text || chr(10) AS chat_text
        FROM quoting q JOIN own o ON o.rid = q.rid LEFT JOIN ends e ON e.conv_id = q.conv_id AND e.turn = q.turn
    """,
    "op10_warc_index": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages
        ), k AS (
            SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
                   max(page_id) OVER (PARTITION BY body) AS keep_id
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> keep_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> keep_id THEN keep_id END AS refers_to
        FROM k
    """,
    "op11_merkle_manifest": """
        WITH RECURSIVE doc AS (
            SELECT *, coalesce(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                          lambda c: [1000 + ascii(c), 0, 0, 0, 0, 0, 0, 0, 0]))),
                          lambda crc, x: CASE WHEN x > 0 THEN xor(crc, x - 1000)
                                           ELSE xor(crc >> 1, CASE WHEN crc & 1 = 1 THEN 3988292384 ELSE 0 END) END), 0) AS crc,
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail
            FROM documents
        ), leaf AS (
            SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
                   sha256(head || coalesce(strlen(CAST(n AS VARCHAR)) || ':' || n, '-') || tail) AS claimed
            FROM (SELECT *, n_chars + CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS n FROM doc)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, row_number() OVER () AS rid FROM leaf
        ), low AS (
            SELECT lang, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY lang) AS m FROM placed
            UNION ALL
            SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((m + 1) // 2)
            FROM low WHERE m > 1 GROUP BY lang, level, i // 2
        ), subroots AS (
            SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM low WHERE m = 1
        ), high AS (
            SELECT 0 AS level, g AS i, subroot AS h, count(*) OVER () AS m FROM subroots
            UNION ALL
            SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((m + 1) // 2)
            FROM high WHERE m > 1 GROUP BY level, i // 2
        ), steps AS (
            SELECT p.rid, 0 AS tree, own.level, own.i, beside.h
            FROM placed p JOIN low own ON own.lang IS NOT DISTINCT FROM p.lang AND own.i = p.i >> own.level AND own.m > 1
            LEFT JOIN low beside ON beside.lang IS NOT DISTINCT FROM p.lang AND beside.level = own.level AND beside.i = xor(own.i, 1)
            UNION ALL
            SELECT p.rid, 1, own.level, own.i, beside.h
            FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN high own ON own.i = s.g >> own.level AND own.m > 1
            LEFT JOIN high beside ON beside.level = own.level AND beside.i = xor(own.i, 1)
        ), paths AS (
            SELECT rid, string_agg(coalesce(h, ''), '' ORDER BY tree, level) AS proof,
                   list(CASE WHEN h IS NULL THEN 'N' WHEN i % 2 = 0 THEN 'R' || h ELSE 'L' || h END ORDER BY tree, level) AS sides
            FROM steps GROUP BY rid
        ), folded AS (
            SELECT p.*, s.subroot, r.h AS root, sha256(coalesce(t.proof, '')) AS proof_sha256,
                   list_reduce(list_concat([p.claimed], coalesce(t.sides, [])), lambda h, x: sha256(
                       CASE x[1] WHEN 'R' THEN h || x[2:] WHEN 'L' THEN x[2:] || h ELSE h END)) AS folded_root
            FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
            CROSS JOIN (SELECT h FROM high WHERE m = 1) r LEFT JOIN paths t ON t.rid = p.rid
        )
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
    """,
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), words AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
        ), starts AS (
            SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM words, range(1, 6) AS sizes(k)
        ), counts AS (
            SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM starts GROUP BY ALL
        ), total AS (
            SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
        ), candidates AS (
            SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE k > 1 AND f >= 100
        ), cuts AS (
            SELECT *, unnest(range(1, k)) AS cut FROM candidates
        ), scored AS (
            SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, t.n,
                   (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
            FROM cuts c JOIN total t ON t.lang = c.lang
            JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.cut], ' ')
            JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')
        ), best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), inside AS (
            SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
            FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM candidates, range(2, 5) AS sizes(m) WHERE m < k) GROUP BY ALL
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
               score::BIGINT AS score
        FROM best LEFT JOIN inside USING (lang, phrase)
        WHERE longer IS NULL OR 100 * longer < 100 * a
        QUALIFY rank <= 2000
    """,
}
