"""The whole pipeline against brute force, the registered queries and their SQL."""

import hashlib
import os

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from panewise.llm import bpe, entries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return {k: v.toPandas() for k, v in out.items()}


def test_stage_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_jaccard", "decontamination", "byte_bpe"]
    for name in names[:-1]:
        assert list(stages[name].columns) == list(stages["documents"].columns)


def test_clean_documents_stay(stages):
    assert len(stages["language_id"]) >= 0.99 * len(stages["documents"])


def test_lines_then_groups_then_benchmark(stages):
    seen = set()
    for text in stages["line_dedup"].sort_values("doc_id")["text"]:
        own = [" ".join(x.split()) for x in text.split("\n") if x.split()]
        assert not seen & set(own) and len(own) == len(set(own))
        seen |= set(own)
    assert (stages["line_dedup"]["text"].str.len() == stages["line_dedup"]["n_chars"]).all()

    def groups(frame):
        sets = {}
        for i, t in zip(frame["doc_id"], frame["text"], strict=True):
            w = t.encode().lower().split()
            k = min(5, len(w))
            sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
        by = {}
        for i, s in sets.items():
            for g in s:
                by.setdefault(g, []).append(i)
        pairs = {(a, b) for x in by.values() for a in x for b in x if a < b}
        return {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}

    before, after = stages["line_dedup"], stages["ngram_jaccard"]
    links, kept = groups(before), set(after["doc_id"])
    label = {i: i for i in before["doc_id"]}
    for _ in range(len(label)):
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
        if not changed:
            break
    assert kept == {i for i, x in label.items() if i == x}

    bench = [" ".join(t.split()) for t in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").df()["text"]]
    leaked = {i for i, t in zip(after["doc_id"], after["text"], strict=True) if any(b in " ".join(t.split()) for b in bench)}
    assert leaked and not leaked & set(stages["decontamination"]["doc_id"])
    assert len(after) - len(stages["decontamination"]) <= len(leaked) + 0.01 * len(after)


def test_token_digests(stages):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    text = dict(zip(stages["decontamination"]["doc_id"], stages["decontamination"]["text"], strict=True))
    rows = stages["byte_bpe"]
    assert set(rows["doc_id"]) == set(text)
    for r in rows.itertuples():
        ids = np.array(library.encode_ordinary(text[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())


def test_odd_tables(spark, tmp_path):
    """Nulls, empty texts, repeated rows and an empty table go through all stages."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    line = "the men of the town have been here for a long time"
    rows = [(1, line, "en", "s", 1), (1, line, "en", "s", 1), (2, None, "en", None, None), (None, f"{line} now", None, "s", 3), (3, "", "de", "s", 0), (4, "der mann und die frau sind schon lange hier", "de", "s", 5), (5, "123", None, None, 3)]
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    extra = {c: F.lit("extra") for c in ("row", "accepted", "tag", "class", "gone", "n_tokens")}
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = frame.withColumns(extra)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        got = [r.doc_id for r in docs.collect()]
        assert sorted(got, key=str) == ([1, 4] if frame.count() else [])


def test_registered_queries():
    names = list(entries.queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    import __spark_entry__

    assert {*names, "pipeline"} <= set(__spark_entry__.queries())
    assert set(entries.oracle_sql()) <= set(names)


def test_nothing_outside_imports_the_package():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, files in os.walk(os.path.join(root, "panewise")):
        for f in files:
            if f.endswith(".py") and os.path.basename(folder) != "llm":
                with open(os.path.join(folder, f)) as source:
                    assert "panewise.llm" not in source.read()
