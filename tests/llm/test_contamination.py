import hashlib
import re

import pytest

from tessera.llm import contamination as c

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                names = windows.get(tuple(w[i : i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture
def make_items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "'y' AS row")


def got(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


ITEMS = [(1, "One two THREE four five six seven eight nine ten eleven"), (2, "short item"), (10, "the the the the the the the the the the"), (3, None), (4, ""), (5, "..."), (None, "no id here"), (2, "short item"), (6, "éa-ß")]
DOCS = [
    (1, "x one two three four five six seven eight nine ten eleven y"), (2, "one two three four five six seven eight nine TEN"), (3, "one two three four five six seven eight nine"),
    (4, None), (5, ""), (6, "a short item, short.item"), (7, "the " * 40), (8, "no id here"), (8, "no id here"), (9, "ÉA-ß éa ß éa ß"), (10, "word " * 200_000 + "short item"), (11, "short"), (12, "item"),
]


@pytest.mark.parametrize("block", [c.BLOCK_BYTES, 30])
def test_edge_cases(spark, make_docs, make_items, block):
    for parts in (1, 3):
        assert got(c.contamination(make_docs(DOCS, parts), make_items(ITEMS), block_bytes=block)) == brute(DOCS, ITEMS)


def test_tables(spark, sf001):
    docs, items = spark.read.parquet(f"{sf001}/documents.parquet"), spark.read.parquet(f"{sf001}/benchmark.parquet")
    want = brute([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert any(x[2] for x in want)
    assert got(c.contamination(docs, items)) == want


def test_proximity(spark, make_docs, make_items):
    docs = make_docs([(1, "one two three filler four five six seven eight nine ten")])
    row = c.contamination(docs, make_items([(1, "one two three four five six seven eight nine ten")])).first()
    assert (row["n_hit"], row["n_near_items"]) == (0, 1)


def test_empty_tables(spark, make_docs, make_items):
    assert got(c.contamination(make_docs([]), make_items(ITEMS))) == []
    assert got(c.contamination(make_docs(DOCS), make_items([]))) == brute(DOCS, [])


def test_decontaminated(spark, make_docs, make_items):
    docs = make_docs(DOCS)
    kept = c.decontaminated(docs, make_items(ITEMS))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {x[0] for x in brute(DOCS, ITEMS) if not x[5]}
