"""Exact duplicates by most-significant-byte radix partitioning.

Documents are split into groups by successive bytes of their text until a group holds one
document or its texts have ended. The first digit is the length in bytes, so that all texts
of a group end in the same round, and the runs of bytes grow from round to round, so that
the number of rounds follows the logarithm of the longest text up to the widest run. Two
texts meet in a final group exactly if all their bytes agree; no digest decides.

A round counts the rows of each (group, run of bytes) with map-side partial counts, so a
group of copies that holds much of the corpus sends one row per task. Only runs met twice
become new groups. Rows find their new group by a salted join, and texts that are alone
need no further round. Every round is a table in the shared folder.

Cases: a NULL text is the empty text, and empty texts are copies of each other. Of a group
the row with the largest key stays; a NULL key is the smallest. Of repeated rows with that
key one stays. An empty table gives an empty result. Other columns are passed through by
`keep_one` and are otherwise not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import durable, forget, hot_join

#: Bytes looked at in the first round, growth of the runs, and the widest run.
FIRST, GROWTH, WIDEST = 64, 64, 1 << 20


def _split(rows: DataFrame, start: int, width: int) -> tuple[DataFrame, DataFrame]:
    """One round: (rows with their next `_group`, NULL if alone; the table of the groups)."""
    keyed = rows.withColumn("_run", F.substring("_bytes", start + 1, width))
    groups = durable(
        keyed.groupBy("_group", "_size", "_run")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1")
        .select("_group", "_size", "_run", F.monotonically_increasing_id().alias("_next"))
    )
    found = hot_join(keyed, groups, ["_group", "_size", "_run"], [F.col("_key")], "left")
    return found.drop("_group", "_run").withColumnRenamed("_next", "_group"), groups


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """Per document: _key, _row (tells repeated rows apart), _size, _round and _group (NULL if alone).

    With `whole`, also _bytes (the text) and _doc (the other columns); else text_sha256, which
    is only shown.
    """
    others = [F.col(f"`{name}`") for name in docs.columns if name != text_col] if whole else []
    rows = docs.select(
        F.col(id_col).alias("_key"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("_bytes"),
        F.struct(F.col(text_col).isNull().alias("_no_text"), *others).alias("_doc"),
        F.lit(0).cast("long").alias("_group"),
    ).withColumn("_size", F.octet_length("_bytes").cast("long"))
    shown = ["_bytes", "_doc"] if whole else ["text_sha256"]
    if not whole:
        rows = rows.drop("_doc").withColumn("text_sha256", F.sha2("_bytes", 256))
    finished: list[DataFrame] = []
    start, width = 0, FIRST
    while True:
        split, groups = _split(rows, start, width)
        start += width
        if not finished:
            split = split.withColumn("_row", F.monotonically_increasing_id())
        more = F.col("_group").isNotNull() & (F.col("_size") > start)
        split = split.withColumn("_more", more)
        written = durable(split if whole else split.withColumn("_bytes", F.when(F.col("_more"), F.col("_bytes"))))
        forget(groups)
        turn = F.lit(len(finished)).alias("_round")
        finished.append(written.where("not _more").select("_key", "_row", "_size", turn, "_group", *shown))
        rows = written.where("_more").drop("_more")
        if rows.isEmpty():
            break
        width = min(width * GROWTH, WIDEST)
    result = finished[0]
    for done in finished[1:]:
        result = result.unionByName(done)
    return result


def _marked(rows: DataFrame) -> DataFrame:
    """`exact_groups` with _keep (largest key of the group), _copies and _kept."""
    # The copies alone, as few as they are beside the corpus, meet their group's size and last row.
    copies = rows.where("_group is not null")
    groups = durable(
        copies.groupBy("_round", "_group").agg(
            F.count(F.lit(1)).alias("_copies"), F.max(F.struct("_key", "_row")).alias("_last")
        )
    )
    marked = hot_join(copies, groups, ["_round", "_group"], [F.col("_key"), F.col("_row")])
    marked = marked.withColumns({"_keep": F.col("_last._key"), "_kept": F.col("_row") == F.col("_last._row")})
    single = rows.where("_group is null").withColumns(
        {"_keep": F.col("_key"), "_copies": F.lit(1).cast("long"), "_kept": F.lit(True)}
    )
    return single.unionByName(marked.drop("_last"))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: key, keep_id (largest key of its equal texts), group_size, kept, text_sha256."""
    return _marked(exact_groups(docs, id_col, text_col)).select(
        F.col("_key").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_copies").alias("group_size"),
        F.col("_kept").alias("kept"),
        "text_sha256",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns unchanged: of equal texts the one with the largest key."""
    kept = _marked(exact_groups(docs, id_col, text_col, whole=True)).where("_kept")
    text = F.when(~F.col("_doc._no_text"), F.col("_bytes").cast("string"))
    return kept.select(*[(text if n == text_col else F.col(f"_doc.`{n}`")).alias(n) for n in docs.columns])
