"""Language identification by compression with per-language dictionaries.

Each language has a raw-content Zstandard dictionary made of excerpts of its labelled
documents. Of a text and of the excerpts only the words count, in lower case. A text is cut
into pieces, every piece is compressed with every dictionary, and the language whose
dictionary gives the smallest total wins. The whole text is read; pieces keep the dictionary
in play, since inside one long frame the text would soon serve as its own dictionary. The
margin is (second - best) / second; a document with a margin below `NARROW` is rejected, and
so is a text without letters.

The dictionaries are fitted on a bounded sample: per language the distinct excerpts (the words
of the first `EXCERPT` characters) with the smallest hashes, until they make `DICTIONARY` bytes.
Copies count once, however many there are. A language with less distinct text has a shorter
dictionary; the others stay as they are, and none is left out. That sample alone reaches the
driver. Prediction is a map without a shuffle.

Cases: NULL, empty and letterless texts are `und` with score 0 and rejected, and so is
everything if there is nothing to learn from. With one language the score is 1. Ties go to
the language that sorts first, with score 0. Repeated rows get the same answer. Rows with a
NULL label are not learnt from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import bounded_batches

#: Bounds of the fitted sample: characters of a document, bytes of a dictionary.
EXCERPT, DICTIONARY = 1024, 32_768
#: Bytes of a language that are ranked for the sample, as a multiple of it.
PASSED = 8
#: Bytes of a piece, and the margin below which a document is rejected.
PIECE, NARROW = 1024, 0.002
#: A search that finds all matches of four bytes; the window holds dictionary and piece.
SEARCH = {
    "strategy": zstandard.STRATEGY_BTLAZY2, "min_match": 4, "window_log": 17, "hash_log": 16, "chain_log": 16,
    "search_log": 4, "target_length": 16,
}
UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")


def held_out(key: Column) -> Column:
    """Documents that are never learnt from: CRC-32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(
    docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", key: str = "doc_id"
) -> dict[str, bytes]:
    """Dictionary per language from the rows where `learn` holds."""
    excerpt = F.substring(text_col, 1, EXCERPT)
    # What `only_words` keeps, as far as it tells excerpts apart.
    words = F.regexp_replace(F.lower(excerpt), r"[^\p{L}\p{Nl}\p{No}]+", " ")
    labelled = docs.where(learn & F.col(lang_col).isNotNull() & excerpt.rlike(r"\p{L}"))
    labelled = labelled.select(F.col(lang_col).alias("lang"), excerpt.alias("text"), words.alias("words"))
    labelled = labelled.select("lang", "text", F.octet_length("words").alias("bytes"), F.xxhash64("words").alias("same"))
    # Bytes of distinct excerpts; of copies each task sends one row of numbers.
    once = labelled.groupBy("lang", "same").agg(F.min("bytes").cast("long").alias("bytes"))
    counts = {r["lang"]: r["bytes"] for r in once.groupBy("lang").agg(F.sum("bytes").alias("bytes")).collect()}
    if not counts:
        return {}
    # Few bytes per language pass a hash threshold, however many documents and tasks there are.
    shares = [min(1.0, PASSED * DICTIONARY / count) for count in counts.values()]
    limit = F.element_at(
        F.map_from_arrays(F.array(*map(F.lit, counts)), F.array(*[F.lit(int(s * (1 << 31))) for s in shares])), F.col("lang")
    )
    rows = labelled.withColumn("order", F.pmod("same", F.lit(1 << 31))).where(F.col("order") < limit)
    rows = rows.groupBy("lang", "order", "same").agg(F.min("text").alias("text"), F.min("bytes").alias("bytes"))
    before = Window.partitionBy("lang").orderBy("order", "same").rowsBetween(Window.unboundedPreceding, -1)
    sample = rows.withColumn("before", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    sample = sample.where(F.col("before") < DICTIONARY).select("lang", "text", "order", "same")
    excerpts: dict[str, list[bytes]] = {}
    for row in sample.orderBy("lang", "order", "same").collect():
        excerpts.setdefault(row["lang"], []).append(only_words(row["text"]))
    # The length of a dictionary follows its own language: little text of one takes nothing from another.
    return {lang: b"\n".join(dict.fromkeys(excerpts[lang]))[:DICTIONARY] for lang in sorted(excerpts)}


def only_words(text: str) -> bytes:
    """The letters of a text in lower case, words apart by one space."""
    return (" ".join(NO_LETTERS.sub(" ", text.lower()).split()) + " ").encode("utf-8", "replace")


def pieces(raw: bytes) -> list[bytes]:
    """The whole text in pieces of nearly equal size."""
    count = -(-len(raw) // PIECE)
    step = -(-len(raw) // max(count, 1))
    return [raw[at : at + step] for at in range(0, len(raw), step or 1)]


def compressors(dictionaries: dict[str, bytes]) -> dict[str, zstandard.ZstdCompressor]:
    bare = {"write_checksum": 0, "write_content_size": 0, "write_dict_id": 0}
    search = zstandard.ZstdCompressionParameters(**SEARCH, **bare)
    return {
        lang: zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            compression_params=search,
        )
        for lang, content in dictionaries.items()
    }


def classify(text: str | None, by: dict[str, zstandard.ZstdCompressor]) -> tuple[str, float, float]:
    """(language, score, margin) of a text."""
    if not by or not text or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, 0.0
    cut = pieces(only_words(text))
    sizes = sorted((sum(len(made.compress(piece)) for piece in cut), lang) for lang, made in by.items())
    if len(sizes) == 1:
        return sizes[0][1], 1.0, 1.0
    best, second = sizes[0][0], sizes[1][0]
    margin = (second - best) / second
    return sizes[0][1], min(1.0, margin / 0.1), margin


def _classifier(dictionaries: dict[str, bytes]):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = compressors(dictionaries)
        for batch in batches:
            found = [classify(text.as_py(), by) for text in batch.column(0)]
            langs, scores, margins = zip(*found, strict=True) if found else ((), (), ())
            answer = [
                pa.array(langs, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array([x < NARROW for x in margins], pa.bool_()),
            ]
            names = ["lang_pred", "score", "rejected"]
            yield pa.record_batch([*batch.columns[1:], *answer], names=[*batch.schema.names[1:], *names])

    return apply


def predict(
    docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """`_row` (the carried columns of `docs`) with lang_pred, score and rejected."""
    carry = docs.columns if carry is None else carry
    held = bounded_batches(docs).select(F.col(f"`{text_col}`").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row"))
    answer = T.StructType([T.StructField("_row", held.schema["_row"].dataType)])
    answer = answer.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return held.mapInArrow(_classifier(dictionaries), answer)
