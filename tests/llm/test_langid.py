import zlib

import numpy as np

from tessera.llm import langid


def test_kernel_counts_shared_grams():
    texts = ["Ab c", "ab  c!", "", "12 .", "xaé"]
    raw = [t.encode() for t in texts]
    pairs, count, has = langid.grams(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))

    def brute(t):
        s = "".join(c.lower() if c.isalpha() else " " for c in t)
        while "  " in s:
            s = s.replace("  ", " ")
        return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}

    assert count.tolist() == [len(brute(t)) for t in texts]
    assert has.tolist() == [True, True, False, False, True]


def test_held_out_accuracy(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = langid.identify(docs).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    again = {(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(docs.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["lang_pred"], r["score"]) for r in got}


def test_labels_of_held_out_rows_are_not_used(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    want = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(docs).collect()}
    spoilt = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1 THEN 'xx' ELSE lang END AS lang")
    assert {(r["doc_id"], r["lang_pred"]) for r in langid.identify(spoilt).collect()} == want


def test_edge_cases(spark, make_docs):
    rows = [(0, "der die und das ist nicht", "de"), (4, "the and of that is", "en"), (2, None, "en"), (3, "", "de"), (5, "123 !", "en"), (6, "the cat is the", None), (None, "the and", "en"), (8, "und das " * 50_000, "de"), (8, "und das", "de")]
    rows += [(100 + i, "the and of that is this", "en") for i in range(9)] + [(200 + i, "der die und das ist nicht", "de") for i in range(9)]
    got = {}
    for r in langid.identify(make_docs(rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [got[i][0]["lang_pred"] for i in (2, 3, 5, 6, None)] == ["und", "und", "und", "en", "en"]
    assert [r["lang_pred"] for r in got[8]] == ["de", "de"]
    assert got[2][0]["score"] == 0 and got[None][0]["held_out"] is False
    assert langid.identify(make_docs([])).collect() == []
    assert {r["lang_pred"] for r in langid.identify(make_docs([(1, "the cat", None)])).collect()} == {"und"}


def text_grams(text):
    """The n-grams of a text as strings; none without a letter."""
    s = "".join(c.lower()[0] if c.isalpha() else " " for c in text or "")
    while "  " in s:
        s = s.replace("  ", " ")
    return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)} if s.strip() else set()


def brute(rows):
    """doc_id -> (language or None, score) by kernels between sets of strings."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    sample = sorted((zlib.crc32(b"%d" % i), i, lang, text_grams(t)) for i, t, lang in rows if i is not None and lang is not None and t is not None and not held(i))
    sample = [(lang, g) for _, _, lang, g in sample if g]
    langs = sorted({lang for lang, _ in sample})
    by_lang = {lang: [g for x, g in sample if x == lang] for lang in langs}
    marks = [by_lang[lang][i] for i in range(len(sample)) for lang in langs if i < len(by_lang[lang])][: langid.LANDMARKS]
    kernel = lambda a: np.array([len(a & m) / np.sqrt(len(a) * len(m)) for m in marks])
    k_nm, k_mm = np.array([kernel(g) for _, g in sample]), np.array([kernel(m) for m in marks])
    weight = np.diag([len(sample) / len(langs) / len(by_lang[x]) for x, _ in sample])
    y = np.array([[1 if x == lang else -1 for lang in langs] for x, _ in sample])
    left = k_nm.T @ weight @ k_nm + langid.RIDGE * len(sample) / len(marks) * k_mm + 1e-6 * np.eye(len(marks))
    alpha = np.linalg.solve(left, k_nm.T @ weight @ y)
    out = {}
    for i, t, _ in rows:
        g = text_grams(t)
        margin = kernel(g) @ alpha if g else None
        out[i] = (None, 0.0, 1.0) if margin is None else (langs[int(margin.argmax())], float(np.clip((margin.max() + 1) / 2, 0, 1)), float(np.diff(np.sort(margin)[-2:])[0]))
    return out


def test_query_equals_brute_force(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text", "lang").collect()
    want = brute([tuple(r) for r in docs])
    got = {r["doc_id"]: r for r in langid.op8_langid(spark, sf001).collect()}
    assert set(got) == set(want) and len({w[0] for w in want.values()}) >= 4
    for i, (lang, score, gap) in want.items():
        if gap > 1e-3:
            assert got[i]["lang_pred"] == (lang or "und")
        assert abs(got[i]["score"] - score) < 2e-3
