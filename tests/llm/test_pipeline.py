"""The pipeline against a plain program, and the driver's contract."""

import os
import re
import subprocess
import sys
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from fixtures import empty, odd  # noqa: F401
from pyspark.sql import functions as F
from test_dedup import brute_components

from plumbline.llm import language_id, secret_scan

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def masked(text):
    spans = []
    for rule in secret_scan.RULES:
        flags = re.A | (re.I if rule.any_case else 0)
        spans += [m.span() for m in re.finditer(rule.pattern, text, flags) if len(m[rule.group]) >= rule.least]
    out, at = "", 0
    for begin, stop in sorted(spans):
        if begin >= at:
            out += text[at:begin] + "[secret]"
        at = max(at, stop)
    return out + text[at:]


def test_pipeline_matches_a_plain_program(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learnt = language_id.fit(docs, ~language_id.held_out(F.col("doc_id")))
    by = language_id.compressors(learnt)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    texts = {k: t for k, t in texts.items() if language_id.classify(t, by)[2] >= language_id.NARROW}
    last = {}
    for key in sorted(texts):
        last[texts[key]] = key
    texts = {k: t for t, k in last.items()}
    groups = brute_components(list(texts.items()), 5)
    texts = {k: masked(t) for k, t in texts.items() if groups[k][1] == k}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {k: library.encode(t, add_special_tokens=False).ids + [1] for k, t in texts.items()}

    rows = corpus_pipeline.run(spark, sf_dir).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(want)
    for key, ids in want.items():
        found = sorted(pieces[key], key=lambda r: r["start"])
        assert [r["doc_tokens"] for r in found] == [len(ids)] * len(found)
        at = 0
        for r in found:
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)


def test_stages_keep_columns_and_survive_odd_tables(spark, odd, empty, tmp_path):
    for rows in (odd, empty):
        docs = rows
        for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{place}-{rows is odd}"
            stage(spark, docs, "").write.parquet(path)
            docs = spark.read.parquet(path)
            if place < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == rows.columns


def test_queries_are_registered_once_and_can_be_absent(tmp_path):
    import __spark_entry__ as entry

    numbered = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in numbered) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # Without the subpackage the entry still imports and keeps the other queries.
    os.symlink(f"{ROOT}/catalog", f"{tmp_path}/catalog")
    os.mkdir(f"{tmp_path}/plumbline")
    for name in os.listdir(f"{ROOT}/plumbline"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/plumbline/{name}", f"{tmp_path}/plumbline/{name}")
    with open(f"{ROOT}/__spark_entry__.py") as source, open(f"{tmp_path}/__spark_entry__.py", "w") as copy:
        copy.write(source.read())
    code = "import __spark_entry__ as e; print([n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("[]"), done.stderr[-500:]
