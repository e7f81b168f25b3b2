import hashlib
import re

import corpus_pipeline
import numpy as np
from tessera.llm import bpe, exact, langid
from test_contamination import brute as brute_contamination
from test_exact import brute as brute_exact
from test_jaccard import brute as brute_jaccard


def brute(docs, items):
    """doc_id -> text of what the first four stages keep."""
    rows = [(i, t) for i, t in docs if t and re.search(r"[^\W\d_]", t)]
    keep = {x[1] for x in brute_exact(rows)}
    rows = [r for r in rows if r[0] in keep]
    keep = {x[2] for x in brute_jaccard(rows)}
    rows = [r for r in rows if r[0] in keep]
    dirty = {x[0] for x in brute_contamination(rows, items) if x[5]}
    return {i: t for i, t in rows if i not in dirty}


def test_stages(spark, sf01):
    docs, items = spark.read.parquet(f"{sf01}/documents.parquet"), spark.read.parquet(f"{sf01}/benchmark.parquet")
    kept = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    got = corpus_pipeline.run(spark, sf01).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(kept) and 0 < len(kept) < docs.count()
    encode = bpe.Encoder(bpe.default_tokenizer_path()).tokenizer.encode
    for r in got[::25]:
        ids = encode(kept[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())


def test_stage_columns(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").selectExpr("*", "1 AS row", "2 AS keep_id")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf001).columns == docs.columns


def test_stages_on_odd_rows(spark, make_docs, sf001):
    rows = [(1, None), (2, ""), (3, "123"), (4, "the cat"), (5, "the  cat"), (None, "the dog and the cat"), (6, "word " * 60_000)]
    docs = make_docs(rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf001)
    assert sorted((r["doc_id"] for r in docs.collect()), key=str) == [5, 6, None]
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf001)
    assert docs.collect() == []


def test_accepted_equals_identify(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    want = {r["doc_id"] for r in langid.identify(docs).collect() if r["lang_pred"] != langid.UNKNOWN}
    assert {r["doc_id"] for r in langid.accepted(docs).collect()} == want
    assert exact.deduplicated(docs).count() == len({r["keep_id"] for r in exact.exact_groups(docs).collect()})
