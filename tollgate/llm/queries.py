"""Registered queries of the numbered operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.common import new_path
from tollgate.llm import (brown, decontaminate, fim, langid, lines, manifest, mixing, quality, simhash, substring, syncmers,
                          token_counts, warc)
from tollgate.sources.tables import read_table


def op1_warc_zip_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.pages_round_trip(spark, read_table(spark, sf_dir, "pages"), new_path(spark, "warc"))
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_mix_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("text")


def op3_line_dedup_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", "n_lines", "n_removed", "longest",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def crc_of_id(parts: int):
    """crc32 of the id as text modulo ``parts``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op4_language_id_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.learn(docs, crc_of_id(4) != 2)
    rows = docs.select("doc_id", F.coalesce(crc_of_id(4) == 2, F.lit(False)).alias("held_out"), "text")
    return langid.predict(rows, model, ["doc_id", "held_out"])


def op5_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def op6_substring_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(read_table(spark, sf_dir, "documents"))


def op7_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op8_lm_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(crc_of_id(10) == 0, F.lit(False)))
    model, vocabulary = brown.learn(docs.filter(crc_of_id(10) != 0))
    return brown.score(docs, model, vocabulary, "held_out")


def op9_decontaminate_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.with_next(read_table(spark, sf_dir, "documents"))


def op11_fim_chunk_memo(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(read_table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(crc_of_id(2) == 0, F.regexp_replace("text", "\n", ""))
    rows = manifest.build(read_table(spark, sf_dir, "documents"), tampered)
    folded = F.element_at("version", -1)
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(F.col("way")), 256).alias("proof_sha256"),
                       folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024


def op13_token_counts_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    tokenizer = token_counts.compiled(public_tokenizers.path(TOKENIZER))
    counted = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


QUERIES = {
    "op1_warc_zip_archive": op1_warc_zip_archive,
    "op2_mix_temperature": op2_mix_temperature,
    "op3_line_dedup_suffix_array": op3_line_dedup_suffix_array,
    "op4_language_id_ecoc": op4_language_id_ecoc,
    "op5_quality_cotraining": op5_quality_cotraining,
    "op6_substring_debruijn": op6_substring_debruijn,
    "op7_simhash_covering": op7_simhash_covering,
    "op8_lm_brown_classes": op8_lm_brown_classes,
    "op9_decontaminate_pieces": op9_decontaminate_pieces,
    "op10_syncmer_fingerprints": op10_syncmer_fingerprints,
    "op11_fim_chunk_memo": op11_fim_chunk_memo,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_counts_fst": op13_token_counts_fst,
}

ORACLE = {
    "op1_warc_zip_archive": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                          sha1(coalesce(html, '')) AS payload_digest FROM pages),
             k AS (SELECT payload_digest, max(page_id) AS keeper FROM p
                   WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN k.keeper <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN k.keeper <> p.page_id THEN k.keeper END AS refers_to
        FROM p LEFT JOIN k USING (payload_digest)""",
    "op2_mix_temperature": """
        WITH RECURSIVE d AS (
            SELECT doc_id, source, coalesce('=' || source, 'null') AS s,
                   len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents),
        t AS (SELECT s, sum(n_tokens)::BIGINT AS tokens FROM d WHERE n_tokens > 0 GROUP BY s),
        p AS (SELECT s, tokens, tokens / (SELECT sum(tokens) FROM t) AS p FROM t),
        ps AS (SELECT list(p ORDER BY s) AS ps, 0.95 * ln(count(*)) AS need FROM p),
        fit AS (SELECT ps, need,
                    -list_sum(list_transform(ps, lambda x: x * ln(x))) >= need AS entropy_ok,
                    list_max(list_transform(ps, lambda x: 1 / x)) / len(ps) <= 4 AS repeats_ok FROM ps),
        halve(i, lo0, hi0, lo1, hi1) AS (
            SELECT 0, CASE WHEN entropy_ok THEN 1.0 ELSE 0.0 END::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE,
                   CASE WHEN repeats_ok THEN 0.0 ELSE 1.0 END::DOUBLE FROM fit
            UNION ALL
            SELECT i + 1, CASE WHEN e THEN m0 ELSE lo0 END, CASE WHEN e THEN hi0 ELSE m0 END,
                   CASE WHEN r THEN lo1 ELSE m1 END, CASE WHEN r THEN m1 ELSE hi1 END
            FROM (SELECT *, ln(z0) - m0 * list_sum(list_transform(ps, lambda x: pow(x, m0) * ln(x))) / z0 >= need AS e,
                         list_max(list_transform(ps, lambda x: pow(x, m1) / x)) / z1 <= 4 AS r
                  FROM (SELECT *, list_sum(list_transform(ps, lambda x: pow(x, m0))) AS z0,
                               list_sum(list_transform(ps, lambda x: pow(x, m1))) AS z1
                        FROM (SELECT *, (lo0 + hi0) / 2 AS m0, (lo1 + hi1) / 2 AS m1 FROM halve, fit WHERE i < 40)))),
        a AS (SELECT greatest(lo0, hi1) AS a FROM halve WHERE i = 40),
        w AS (SELECT s, tokens, pow(p, a) / sum(pow(p, a)) OVER () AS w, sum(tokens) OVER () AS total FROM p, a),
        q AS (SELECT s, tokens, floor(w * total)::BIGINT AS quota, ceil(tokens / 1048576)::BIGINT AS blocks FROM w),
        e AS (SELECT d.doc_id, d.source, d.s, d.n_tokens, q.*,
                     unnest(range(0, quota // tokens + 1)) AS epoch FROM d JOIN q ON d.s = q.s WHERE n_tokens > 0),
        h AS (SELECT *, ('0x' || substr(md5('42:' || epoch || ':' || doc_id), 1, 15))::BIGINT AS h FROM e),
        b AS (SELECT *, h % blocks AS block FROM h),
        c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY s, epoch ORDER BY block, h, doc_id) - n_tokens AS before FROM b)
        SELECT doc_id, source, n_tokens, epoch, block,
               least((epoch + block / blocks) / (quota / tokens), 1.0) AS turn
        FROM c WHERE epoch * tokens + before < quota""",
    "op3_line_dedup_suffix_array": """
        WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
        x AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM d),
        c AS (SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM x),
        r AS (SELECT a.doc_id, a.pos, min(b.pos) - a.pos + 1 AS q
              FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos AND a.pos + 59
                               AND b.upto - a.upto + length(a.line) + 1 >= 60
              GROUP BY a.doc_id, a.pos
              UNION
              SELECT a.doc_id, max(b.pos) AS pos, a.pos - max(b.pos) + 1 AS q
              FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos - 59 AND a.pos
                               AND a.upto - b.upto + length(b.line) + 1 >= 60
              GROUP BY a.doc_id, a.pos),
        run AS (SELECT r.doc_id, r.pos, r.q, array_to_string(l[r.pos + 1 : r.pos + r.q], chr(10)) AS t
                FROM r JOIN d ON r.doc_id = d.doc_id),
        later AS (SELECT doc_id, pos, q FROM (
                      SELECT *, row_number() OVER (PARTITION BY q, t ORDER BY doc_id, pos) AS k FROM run) WHERE k > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + q)) AS pos FROM later),
        stretch AS (SELECT doc_id, count(*) AS n FROM (
                        SELECT doc_id, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM gone) GROUP BY doc_id, g),
        longest AS (SELECT doc_id, max(n) AS longest FROM stretch GROUP BY doc_id)
        SELECT x.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed, coalesce(max(s.longest), 0) AS longest,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY x.pos) FILTER (g.pos IS NULL), '')) AS kept_sha256
        FROM x LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.pos = x.pos
        LEFT JOIN longest s ON s.doc_id = x.doc_id
        GROUP BY x.doc_id""",
    "op11_fim_chunk_memo": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
                          sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
        h AS (SELECT *, ('0x' || substr(s, 1, 8))::BIGINT AS h1, ('0x' || substr(s, 9, 8))::BIGINT AS h2,
                     ('0x' || substr(s, 17, 8))::BIGINT AS h3, ('0x' || substr(s, 25, 8))::BIGINT AS h4 FROM d),
        c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                     CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                               OR h3 % 100 >= 90 THEN 'plain'
                          WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
                                ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a)
                      END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM c""",
    "op12_merkle_manifest": """
        WITH RECURSIVE f AS (
            SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   text, replace(text, chr(10), '') AS altered,
                   xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                                   lambda crc, b: list_reduce([xor(crc, b)] || range(8),
                                       lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
                       4294967295) % 2 AS odd FROM documents),
        d AS (SELECT doc_id, source, odd, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                     sha256(head || coalesce(strlen(altered) || ':' || altered, '-')) AS other FROM f),
        p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM d),
        up(source, k, l) AS (
            SELECT source, 0, list(leaf ORDER BY pos) FROM p GROUP BY source
            UNION ALL
            SELECT source, k + 1, list_transform(range((len(l) + 2) // 3), lambda i: sha256(array_to_string(l[3 * i + 1 : 3 * i + 3], '')))
            FROM up WHERE len(l) > 1),
        s AS (SELECT source, l[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM up WHERE len(l) = 1),
        top(k, l) AS (
            SELECT 0, list(subroot ORDER BY pos) FROM s
            UNION ALL
            SELECT k + 1, list_transform(range((len(l) + 2) // 3), lambda i: sha256(array_to_string(l[3 * i + 1 : 3 * i + 3], '')))
            FROM top WHERE len(l) > 1),
        way AS (
            SELECT p.doc_id, p.source, k, p.pos // pow(3, k)::BIGINT AS x, l FROM p JOIN up ON p.source IS NOT DISTINCT FROM up.source
            WHERE len(l) > 1
            UNION ALL
            SELECT p.doc_id, p.source, 1000 + k, s.pos // pow(3, k)::BIGINT, l
            FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source, top WHERE len(l) > 1),
        beside AS (SELECT doc_id, k, array_to_string(l[x - x % 3 + 1 : x], '') AS a, array_to_string(l[x + 2 : x - x % 3 + 3], '') AS b FROM way),
        steps AS (SELECT doc_id, string_agg(a || b, '' ORDER BY k) AS proof, list(a || '|' || b ORDER BY k) AS steps FROM beside GROUP BY doc_id),
        r AS (SELECT p.doc_id, leaf, subroot, (SELECT l[1] FROM top WHERE len(l) = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
                     list_reduce([CASE WHEN odd = 0 THEN other ELSE leaf END] || coalesce(steps, []),
                                 lambda acc, t: sha256(split_part(t, '|', 1) || acc || split_part(t, '|', 2))) AS folded_root
              FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source LEFT JOIN steps ON p.doc_id = steps.doc_id)
        SELECT *, folded_root = root AS verified FROM r""",
}
