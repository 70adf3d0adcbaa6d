"""Secret scanning with an incremental ledger of blobs.

Every version of every path is addressed by its content (SHA-256). The ledger holds, per
blob, the rule versions it was scanned with and what they found. A run scans only pairs of
blob and rule version that the ledger does not hold, and joins the findings of all blobs
back to all paths and versions that hold them. Raising the version of a rule or adding one
scans all blobs with this rule alone; adding documents scans only contents never seen.

Copies are one blob: the text of a blob is taken by an aggregate with map-side combine, so
a group of copies of any size sends one row per task. Paths join their blob by a salted
join. A ledger that outlives a run is a table of its own (`scan_into`, `open_ledger`): a run
appends the pairs it scanned and rewrites nothing.

Cases: a NULL text is the empty text. Paths may repeat or be NULL; each row gets its
result. An empty table gives an empty ledger and no rows. Offsets count code points, the
end is exclusive. Other columns pass through `redact`, whatever their names, and are otherwise not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, durable, hot_join, unused


@dataclass(frozen=True)
class Rule:
    """A pattern, its version and the least length of the group that decides a match."""

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    @property
    def pair(self) -> str:
        return f"{self.kind}@{self.version}"


#: Patterns and lengths that the contract fixes.
BASE = (
    Rule(
        "assign",
        1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        any_case=True,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", 1, r"[0-9a-f]{24,}", least=24),
)
#: What stands between the lines of a key: breaks, also written as escapes, quote marks and the like.
_APART = r"""(?:\\[nrt]|[\s>#*|"',;\\+])*+"""
_BESIDE, _BREAK, _CODE = r"""[\x20\t>#*|"',;+]*+""", r"(?:\r\n?|\n|(?:\\r)?\\n)", r"[A-Za-z0-9+/=]"
#: A private key from its first line to its END line, whatever is between, but not past other five dashes.
#: Without such an END it goes as far as there are header fields, runs of 16 base64 characters or more and
#: lines of base64 characters only, then one shorter run with a digit or sign, then a broken END line.
PEM = (
    r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"
    r"(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END (?:[A-Z]+ )*PRIVATE KEY-----|"
    rf"(?:{_APART}(?:Proc-Type|DEK-Info|Key-Info|Content-Domain|Comment|Version):\x20*+[A-Za-z0-9,._-]++)*+"
    rf"(?:{_APART}{_CODE}{{16,}}+|{_BESIDE}{_BREAK}{_BESIDE}{_CODE}++(?={_BESIDE}(?:{_BREAK}|[\])}}]|\Z)))*+"
    rf"(?:(?<={_CODE}{{16}}){_APART}(?=[A-Za-z]*+[0-9+/=]){_CODE}++)?+"
    rf"(?:{_APART}-----END[A-Z\x20]*+-*+)?+)"
)
#: Well-known published formats, found beside the base.
MORE = (
    Rule("pem", 2, PEM),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE + MORE

FINDING = "struct<rule:string,begin:bigint,stop:bigint>"
LEDGER = f"blob string, scanned array<string>, findings array<{FINDING}>"


def find(text: str, rules: list[tuple[Rule, re.Pattern]]) -> list[dict]:
    """All accepted matches of the rules, leftmost and non-overlapping per rule."""
    return [
        {"rule": rule.pair, "begin": m.start(), "stop": m.end()}
        for rule, pattern in rules
        for m in pattern.finditer(text)
        if m.end(rule.group) - m.start(rule.group) >= rule.least
    ]


def _scanner(rules: tuple[Rule, ...]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ASCII: neither case folding nor classes reach other letters.
        compiled = {r.pair: (r, re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0))) for r in rules}
        found_type = pa.list_(pa.struct([("rule", pa.string()), ("begin", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            due = batch.column(2).to_pylist()
            found = [
                find(text.as_py(), [compiled[pair] for pair in pairs])
                for text, pairs in zip(batch.column(1), due, strict=True)
            ]
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(found, found_type)], names=["blob", "scanned", "findings"]
            )

    return scan


def _unseen(docs: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...], text_col: str) -> DataFrame:
    """Ledger entries of the pairs of blob and rule version that the ledger does not hold."""
    blobs = bounded_batches(docs).select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    blobs = blobs.groupBy(F.sha2("text", 256).alias("blob")).agg(F.min("text").alias("text"))
    pairs = F.array(*[F.lit(rule.pair) for rule in rules])
    if ledger is None:
        due = blobs.select("blob", "text", pairs.alias("due"))
        return due.mapInArrow(_scanner(rules), LEDGER)
    known = ledger.select("blob", F.col("scanned").alias("_seen"))
    due = blobs.join(known, "blob", "left").select(
        "blob", "text", F.array_except(pairs, F.coalesce("_seen", F.array().cast("array<string>"))).alias("due")
    )
    return due.where("size(due) > 0").mapInArrow(_scanner(rules), LEDGER)


def _one_per_blob(entries: DataFrame) -> DataFrame:
    """Entries of several runs as one per blob; what two runs at a time both scanned counts once."""
    return entries.groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("scanned"),
        F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings"),
    )


def scan_unseen(
    docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text"
) -> DataFrame:
    """The ledger after this run: blob, scanned (rule versions), findings.

    `ledger` is the result of an earlier run. Its entries stay, also of contents that `docs`
    no longer holds.
    """
    new = _unseen(docs, ledger, rules, text_col)
    return durable(new if ledger is None else _one_per_blob(ledger.unionByName(new)))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger kept at `path`, one row per blob; empty if no run has written there."""
    try:
        return _one_per_blob(spark.read.schema(LEDGER).parquet(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], LEDGER)


def scan_into(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Scan what the ledger kept at `path` does not hold, append it there; the ledger after this run.

    A run that breaks off appends nothing. An appended entry holds one blob, the rule versions of
    that run and what they found.
    """
    spark = docs.sparkSession
    _unseen(docs, open_ledger(spark, path), rules, text_col).write.mode("append").parquet(path)
    return open_ledger(spark, path)


def findings_of(
    docs: DataFrame,
    ledger: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    text_col: str = "text",
    by: str = "doc_id",
    spans_col: str = "_spans",
) -> DataFrame:
    """`docs` with `spans_col`: the findings of its content by the given rules, by start, then in the rules' order.

    It must not be a column of `docs`; a text without findings has NULL.
    """
    if spans_col.lower() in map(str.lower, docs.columns):
        raise ValueError(f"The table has a column {spans_col} already; name another one for the findings.")
    (blob,) = unused([*docs.columns, spans_col], "_blob")
    pairs = F.array(*[F.lit(rule.pair) for rule in rules])
    wanted = F.filter("findings", lambda x: F.array_contains(pairs, x["rule"]))
    ordered = F.array_sort(
        F.transform(
            wanted,
            lambda x: F.struct(
                x["begin"].alias("begin"),
                F.array_position(pairs, x["rule"]).alias("place"),
                x["stop"].alias("stop"),
                F.substring_index(x["rule"], "@", 1).alias("kind"),
            ),
        )
    )
    # Blobs without findings need not meet their paths.
    held = ledger.where("size(findings) > 0").select(F.col("blob").alias(blob), ordered.alias(spans_col))
    address = F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)
    return hot_join(docs.withColumn(blob, address), held, [blob], [F.col(f"`{by}`")], "left").drop(blob)


def redact(
    docs: DataFrame, mark: str = "[secret]", text_col: str = "text", by: str = "doc_id", ledger: str | None = None
) -> DataFrame:
    """`docs` with every secret in its text replaced by `mark`; all columns and rows stay.

    Overlapping findings are replaced once. `n_chars`, where there is such a column, follows.
    `ledger` is the path of a kept ledger, which this run reads and extends.
    """
    held = scan_unseen(docs, text_col=text_col) if ledger is None else scan_into(docs, ledger, text_col=text_col)
    text = F.col(f"`{text_col}`")
    (spans,) = unused(docs.columns, "_spans")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, span):
        # A finding that begins before the end of an earlier one only extends it.
        inside = span["begin"] < acc["at"]
        kept = text.substr((acc["at"] + 1).cast("int"), (span["begin"] - acc["at"]).cast("int"))
        return F.struct(
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], kept, F.lit(mark))).alias("out"),
            F.greatest(acc["at"], span["stop"]).alias("at"),
        )

    def finish(acc):
        return F.concat(acc["out"], text.substr((acc["at"] + 1).cast("int"), F.length(text)))

    cleaned = F.when(F.col(spans).isNull(), text).otherwise(F.aggregate(spans, start, step, finish))
    found = findings_of(docs, held, text_col=text_col, by=by, spans_col=spans).withColumn(text_col, cleaned)
    if "n_chars" in docs.columns:
        count = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length(text))
        found = found.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType))
    return found.select(*[F.col(f"`{name}`") for name in docs.columns])
