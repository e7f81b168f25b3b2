import random
import re
from collections import defaultdict

import pytest

from tessera.llm import jaccard as j

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text, size=5):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows, similarity=0.8):
    """Sorted (doc_id, class_id, group_id, n_links, n_similar)."""
    key = lambda i: (i is None, i or 0)
    classes, alone = defaultdict(list), []
    for i, t in rows:
        s = shingles(t)
        classes[s].append(i) if s else alone.append((i, i, i, 0, 0))
    sets = list(classes)
    where = defaultdict(list)
    for n, s in enumerate(sets):
        for g in s:
            where[g].append(n)
    links = defaultdict(set)
    for n, s in enumerate(sets):
        both = defaultdict(int)
        for g in s:
            for m in where[g]:
                both[m] += 1
        for m, k in both.items():
            if m != n and k >= similarity * (len(s) + len(sets[m]) - k) - 1e-9:
                links[n].add(m)
    seen, out = {}, []
    for n in range(len(sets)):
        if n in seen:
            continue
        group, todo = [], [n]
        seen[n] = group
        while todo:
            x = todo.pop()
            group.append(x)
            for m in links[x]:
                if m not in seen:
                    seen[m] = group
                    todo.append(m)
    for n, s in enumerate(sets):
        best = min((i for m in seen[n] for i in classes[sets[m]]), key=key)
        similar = len(classes[s]) - 1 + sum(len(classes[sets[m]]) for m in links[n])
        out += [(i, min(classes[s], key=key), best, len(links[n]), similar) for i in classes[s]]
    return sorted(out + alone, key=str)


def got(df):
    return sorted((tuple(r[c] for c in ("doc_id", "class_id", "group_id", "n_links", "n_similar")) for r in df.collect()), key=str)


def varied(rng, base, edits):
    w = base.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    base = " ".join(f"w{rng.randrange(900)}" for _ in range(300))
    other = " ".join(f"v{rng.randrange(900)}" for _ in range(120))
    out = [(i, varied(rng, base, 2)) for i in range(60)] + [(100 + i, varied(rng, other, i % 3)) for i in range(9)]
    out += [(200, None), (201, ""), (202, "..."), (203, "two words"), (204, "Two, words!"), (205, "one two three four five"), (206, "one two three four five"), (206, "one two three four five")]
    out += [(None, base), (207, base.upper()), (208, "q" * 300_000), (209, " ".join(f"z{i}" for i in range(60_000)))]
    return out


@pytest.mark.parametrize("block", [j.BLOCK, 8])
def test_brute_force(spark, make_docs, rows, block):
    assert got(j.jaccard_groups(make_docs(rows, 4), block=block)) == brute(rows)


def test_tables(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert any(x[3] for x in want)
    assert got(j.jaccard_groups(docs)) == want


def test_one_per_group(spark, make_docs, rows):
    docs = make_docs(rows)
    kept = j.one_per_group(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {x[2] for x in brute(rows)}


def test_empty(spark, make_docs):
    assert got(j.jaccard_groups(make_docs([]))) == []


def test_prefix_depth():
    assert j.prefix_depth(recall=0.5) > j.prefix_depth(recall=0.9995) >= 3
    assert 1 - (1 - 0.8 ** j.prefix_depth()) ** j.TREES >= j.RECALL


def test_connected_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    labels = {r["node"]: r["root"] for r in j.connected(edges).collect()}
    assert labels == {**{i: 0 for i in range(1, 41)}, 101: 100}
