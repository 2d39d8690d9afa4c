"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe, decontaminate, exact_dedup, fim, html_blocks, ngram_join, phrases, sharding, simhash, substring_dedup, suffix_dedup, toxicity, warc
from .common import ROW, ship_library, table

SHARDS = 40


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.annotate(table(spark, sf_dir, "documents"))
    return out.select(F.col(ROW)["doc_id"].alias("doc_id"), "keep_id", "group_size", "kept",
                      "text_sha256")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.read_records(chunks).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.annotate(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit()
    return out.select(F.col(ROW)["doc_id"].alias("doc_id"), "n_words", hit.alias("n_hit"),
                      F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (hit > 0).alias("contaminated"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(table(spark, sf_dir, "documents"),
                     public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                     carry=["doc_id"])
    return out.select(F.col(ROW)["doc_id"].alias("doc_id"), "n_tokens",
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.Model(docs, table(spark, sf_dir, "labels"))
    return model.score(docs.select("doc_id", "text")).select(
        F.col(ROW)["doc_id"].alias("doc_id"),
        (toxicity.fold(F.col(ROW)["doc_id"]) == 0).alias("held_out"), "score", "predicted")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = html_blocks.extract(pages, html_blocks.train(spark))
    return out.select(F.col(ROW)["page_id"].alias("page_id"), F.col(ROW)["url"].alias("url"),
                      F.col("main_text").alias("text"),
                      F.char_length("main_text").cast("long").alias("n_chars"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), simhash.hex_digits(F.col("fp")).alias("fingerprint"),
        "component_id")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                      "kept_sha256")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "slot-map")
    owner = sharding.initial_map(SHARDS)
    sharding.store_map(spark, path, 1, owner)
    sharding.store_map(spark, path, 2, sharding.grow(owner))
    docs = table(spark, sf_dir, "documents")
    # A third version is edited by the measured bytes of the slots, as for an equal-bytes law;
    # the placement below follows the first two, which id and shard count decide.
    loads = sharding.slot_load(sharding.with_slots(docs)).collect()  # a row a slot
    sharding.store_map(spark, path, 3, sharding.rebalance(
        owner, {r.virtual_slot: r.slot_bytes for r in loads}))
    out = sharding.place(docs, sharding.load_map(spark, path, 1), sharding.load_map(spark, path, 2))
    return out.withColumn("law", F.lit("key"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fim.restore(F.col("output"), F.col("form"))
    return out.select(F.col(ROW)["doc_id"].alias("doc_id"), "n", "form", "prefix_chars",
                      "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored, 256).alias("restored_sha256"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id")


def _shipped(query: Callable) -> Callable:
    """The query, run after the workers can import this package."""
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_library(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {name: _shipped(query) for name, query in {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_warc": op2_warc,
    "op4_decontaminate": op4_decontaminate,
    "op6_byte_bpe": op6_byte_bpe,
    "op8_toxicity": op8_toxicity,
    "op5_html_extract": op5_html_extract,
    "op7_simhash": op7_simhash,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_sharding": op10_sharding,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_ngram_jaccard": op13_ngram_jaccard,
}.items()}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES = {
    "op1_exact_dedup": f"""
        WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'))
                          AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM n WINDOW w AS (PARTITION BY text_sha256)""",
    "op2_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                          sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id
                    THEN first_id END AS refers_to
        FROM f""",
    "op4_decontaminate": f"""
        WITH texts AS (
            SELECT 'd' AS kind, doc_id AS id, text FROM documents
            UNION ALL SELECT 'i', item_id, text FROM benchmark),
        lists AS (
            SELECT kind, id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS ws
            FROM texts),
        starts AS (
            SELECT kind, id, ws, unnest(range(1, greatest(len(ws) - k + 2, 1))) AS s, k
            FROM (SELECT kind, id, ws, unnest(CASE WHEN kind = 'd' THEN range(1, 11)
                         ELSE [least(10, greatest(len(ws), 1))] END) AS k FROM lists)
            WHERE k IN (SELECT least(10, len(ws)) FROM lists WHERE kind = 'i')),
        windows AS (SELECT kind, id, s, k, array_to_string(ws[s:s + k - 1], ' ') AS w
                    FROM starts),
        hits AS (SELECT d.id, d.s, d.k, i.id AS item FROM windows d
                 JOIN windows i ON i.kind = 'i' AND i.w = d.w AND i.k = d.k
                 WHERE d.kind = 'd' AND d.w <> ''),
        marked AS (SELECT id, count(DISTINCT p) AS n_hit
                   FROM (SELECT id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY id),
        named AS (SELECT id, count(*) AS n_items,
                         string_agg(item, ',' ORDER BY item) AS item_list
                  FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM hits) GROUP BY id)
        SELECT l.id AS doc_id, len(l.ws) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items,
               sha256(coalesce(item_list, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM lists l LEFT JOIN marked m ON m.id = l.id LEFT JOIN named n ON n.id = l.id
        WHERE l.kind = 'd'""",
    "op11_fill_in_middle": r"""
        WITH h AS (SELECT doc_id, coalesce(text, '') AS t,
                          sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
        k AS (SELECT doc_id, t, regexp_extract_all(t,
                     '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS ts,
                     ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
                     ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM h),
        c AS (SELECT *, len(ts) AS n, least(h1 % (len(ts) + 1), h2 % (len(ts) + 1)) AS a,
                     greatest(h1 % (len(ts) + 1), h2 % (len(ts) + 1)) AS b,
                     CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>')
                               OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                          WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
        p AS (SELECT *, array_to_string(ts[1:a], '') AS pre,
                     array_to_string(ts[a + 1:b], '') AS mid,
                     array_to_string(ts[b + 1:], '') AS suf FROM c)
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t
                      WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p""",
    "op12_phrase_mining": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        ws AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'),
                                        lambda w: w <> '') AS w FROM pieces),
        grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p
                  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                        FROM ws, (VALUES (1), (2), (3)) AS t(k))),
        f AS (SELECT lang, k, p, count(*) AS f FROM grams GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS w FROM f
              WHERE k >= 2 AND f >= 10),
        inside AS (SELECT lang, unnest([array_to_string(w[1:2], ' '),
                                        array_to_string(w[2:3], ' ')]) AS p, a FROM c WHERE k = 3),
        longest AS (SELECT lang, p, max(a) AS b FROM inside GROUP BY ALL),
        free AS (SELECT c.* FROM c LEFT JOIN longest g ON g.lang = c.lang AND g.p = c.p
                 WHERE c.k = 3 OR g.b IS NULL OR 100 * g.b < 50 * c.a),
        cuts AS (SELECT lang, p, a, k, unnest(range(1, k)) AS cut, w FROM free),
        scored AS (
            SELECT s.lang, s.p, s.a, s.cut, l.f AS l, r.f AS r,
                   ((1000000::HUGEINT * s.a * s.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
            FROM cuts s
            JOIN f l ON l.lang = s.lang AND l.p = array_to_string(s.w[1:s.cut], ' ')
            JOIN f r ON r.lang = s.lang AND r.p = array_to_string(s.w[s.cut + 1:], ' ')),
        least AS (SELECT * FROM scored QUALIFY row_number() OVER (
                      PARTITION BY lang, p ORDER BY score, cut) = 1),
        ranked AS (SELECT *, row_number() OVER (
                       PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM least)
        SELECT lang, rank, p AS phrase, a, l, r, n, score
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
    "op13_ngram_jaccard": rf"""
        WITH RECURSIVE ws AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i
                    FROM ws WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
                   FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
                  WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
        reach AS (SELECT doc_id, doc_id AS r FROM documents
                  UNION SELECT reach.doc_id, y FROM reach JOIN links ON x = r)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id
        FROM documents d JOIN reach ON reach.doc_id = d.doc_id
        LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
}
