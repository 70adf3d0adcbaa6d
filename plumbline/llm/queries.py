"""The registered queries of this package and their SQL."""

from __future__ import annotations

import hashlib
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.durable import shared_folder
from plumbline.llm import (
    bpe,
    chunk_dedup,
    conversation_trie,
    exact_dedup,
    language_id,
    minhash,
    mixing,
    packing,
    secret_scan,
    sharding,
    suffix_dedup,
    topk,
    vector_codes,
)
from plumbline.llm.common import durable, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def packed_pieces(docs: DataFrame, remembered: int = packing.REMEMBERED) -> DataFrame:
    """The columns of the packing contract."""
    pieces = packing.pack_documents(docs, TOKENIZER, remembered=remembered)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of two words, as the contract of this query fixes."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what strings of 100 bytes that start earlier take from it."""
    found = suffix_dedup.remove_repeated_strings(table(spark, sf_dir, "documents"), 100)
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the counts of base findings, a digest of them, and all spans.

    All documents arrive in two deliveries, each scanned into the same kept ledger: what the first
    one holds is not scanned again for the second.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    place = f"{shared_folder(spark).rstrip('/')}/plumbline/{uuid.uuid4().hex}"
    later = F.coalesce(F.xxhash64("doc_id") >= 0, F.lit(False))
    for delivery in (docs.where(~later), docs.where(later)):
        ledger = secret_scan.scan_into(delivery, place)
    found = secret_scan.findings_of(docs, ledger)
    spans = F.coalesce("_spans", F.array().cast(found.schema["_spans"].dataType))
    base = [rule.kind for rule in secret_scan.BASE]

    def joined(column):
        return F.concat_ws(
            ",",
            F.transform(
                column, lambda x: F.concat_ws(":", x["kind"], x["begin"].cast("string"), x["stop"].cast("string"))
            ),
        )

    def count(kind):
        return F.size(F.filter("_all", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    only_base = F.filter("_all", lambda x: x["kind"].isin(*base))
    return found.withColumn("_all", spans).select(
        "doc_id", *map(count, base), F.sha2(joined(only_base), 256).alias("base_sha256"), joined("_all").alias("spans")
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), TOKENIZER, lambda raw: hashlib.sha256(raw).hexdigest())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out(F.col("doc_id"))
    learnt = language_id.fit(docs, ~held)
    found = language_id.predict(docs, learnt, carry=["doc_id"])
    found = found.select("_row.doc_id", "lang_pred", "score", "rejected")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op7_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.curve_shards(table(spark, sf_dir, "documents"), 16)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


def op9_norm_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("key") % 50 == 0)


def op10_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what repeated chunks take from it."""
    found = chunk_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_chunks", "n_repeated", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of four parts, their errors, and a digest of the codebooks."""
    rows = durable(vector_codes.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1024, ("label",)))
    books = vector_codes.fit(rows)
    numbers = ",".join(
        str(number) for size in sorted(books) for book in books[size] for entry in book.tolist() for number in entry
    )
    found = vector_codes.summed_by(durable(vector_codes.encode(rows, books)), F.col("_carried.label"), "label_error")
    code = F.concat_ws("", F.transform("_codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    return found.select(
        F.col("_key").alias("vec_id"), code.alias("code"), F.col("_error").alias("error"), "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).documents


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations."""
    turns = durable(conversation_trie.ordered_turns(table(spark, sf_dir, "conversations")))
    return conversation_trie.prefix_trie(*conversation_trie.rebuilt_turns(turns))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_packing": op3_packing,
    "op4_secret_scan": op4_secret_scan,
    "op5_bpe": op5_bpe,
    "op6_language_id": op6_language_id,
    "op7_hilbert_sharding": op7_hilbert_sharding,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_norm_topk": op9_norm_topk,
    "op10_chunk_dedup": op10_chunk_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_mixing": op12_mixing,
    "op13_conversation_trie": op13_conversation_trie,
}


def _codes_sql(rounds: int = 4) -> str:
    """The rounds of `op11_vector_codes` as tables of one statement."""
    parts = [
        """v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS vec
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), p AS (
            SELECT vec_id, label, position, vec[position * len(vec) // 4 + 1 : (position + 1) * len(vec) // 4] AS part
            FROM v, range(4) t(position)
        ), first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v),
        book0 AS (SELECT position, entry, part AS center FROM p JOIN first USING (vec_id) WHERE entry < 256)"""
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""near{r} AS (
            SELECT vec_id, position, any_value(label) AS label, any_value(part) AS part,
                   min(distance) AS error, arg_min(entry, distance * 1000 + entry) AS entry
            FROM (SELECT vec_id, label, p.position, part, entry,
                         list_sum(list_transform(list_zip(part, center), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
                  FROM p JOIN book{r} b ON b.position = p.position)
            GROUP BY vec_id, position)"""
        )
        if r < rounds:
            parts.append(
                f"""means{r} AS (
            SELECT position, entry, list(mean ORDER BY place) AS center
            FROM (SELECT position, entry, place, floor(sum(part[place]) / count(*)::DOUBLE)::BIGINT AS mean
                  FROM near{r}, range(1, 17) t(place) GROUP BY ALL) GROUP BY ALL
        ), book{r + 1} AS (
            SELECT b.position, b.entry, coalesce(m.center, b.center) AS center
            FROM book{r} b LEFT JOIN means{r} m ON m.position = b.position AND m.entry = b.entry)"""
            )
    return (
        "WITH "
        + ", ".join(parts)
        + f""", coded AS (
            SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', entry), '' ORDER BY position) AS code,
                   sum(error)::BIGINT AS error FROM near{rounds} GROUP BY vec_id
        ), digest AS (
            SELECT sha256(string_agg(array_to_string(center, ','), ',' ORDER BY position, entry)) AS codebooks_sha256
            FROM book{rounds})
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM coded, digest"""
    )


ORACLES = {
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_norm_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.vec) = len(q.vec) WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
                   vec_id, score
            FROM scored
        )
        SELECT * FROM ranked WHERE rank <= 5
    """,
    "op11_vector_codes": _codes_sql(),
    "op13_conversation_trie": """
        WITH t AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
                   sha256(concat(strlen(coalesce(role, '')), ':', role, text)) AS id, strlen(coalesce(text, '')) AS bytes
            FROM conversations WHERE conv_id IS NOT NULL
        ), c AS (
            -- CRC-32 of the decimal digits, bit by bit: 256 and more bring a byte, 0 a shift.
            SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base,
                   xor(list_reduce(
                       flatten(list_transform(range(1, len(conv_id::VARCHAR) + 1),
                                              lambda i: [256 + ascii(substr(conv_id::VARCHAR, i, 1)), 0, 0, 0, 0, 0, 0, 0, 0])),
                       lambda a, x: CASE WHEN x >= 256 THEN xor(a, x - 256)
                                         ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END,
                       4294967295::BIGINT), 4294967295::BIGINT) % 9 AS h
            FROM t GROUP BY conv_id
        ), r AS (
            SELECT c.conv_id, pos AS d, id, bytes FROM c JOIN t ON t.conv_id = c.base WHERE pos <= h
            UNION ALL
            SELECT c.conv_id, pos - c.h + least(c.h, coalesce(b.n, 0)), id, bytes
            FROM c JOIN t ON t.conv_id = c.conv_id LEFT JOIN c b ON b.conv_id = c.base WHERE pos > c.h
        ), m AS (
            SELECT conv_id, d, string_agg(id, '' ORDER BY d) OVER (PARTITION BY conv_id ORDER BY d) AS path, bytes FROM r
            UNION ALL SELECT conv_id, 0, '', 0 FROM c
        ), nodes AS (
            SELECT d, path, min(conv_id) AS low, count(*) AS n, any_value(bytes) AS bytes,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = last), '')) AS ends
            FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS last FROM m) GROUP BY d, path
        ), own AS (
            SELECT nodes.*, coalesce(k.children, 0) AS children, (n - 1) * bytes AS saved
            FROM nodes LEFT JOIN (SELECT left(path, (d - 1) * 64) AS path, count(*) AS children FROM nodes WHERE d > 0 GROUP BY 1) k
            ON k.path = nodes.path
        ), under AS (
            SELECT left(path, up.d * 64) AS path, sum(saved) AS saved, count(*) FILTER (children = 0) AS leaves
            FROM own, range(0, 1000) up(d) WHERE up.d <= own.d GROUP BY 1
        )
        SELECT own.low AS conv_id, own.d AS depth, p.low AS parent_conv_id, own.n AS n_convs, own.children AS n_children,
               under.leaves AS n_leaves, under.saved::BIGINT AS saved_tokens, own.ends AS ends_sha256
        FROM own JOIN under ON under.path = own.path
        LEFT JOIN nodes p ON p.path = left(own.path, greatest(own.d - 1, 0) * 64) AND own.d > 0
    """,
}
