import numpy as np

from tessera.llm import toxicity as t
from tessera.llm.common import word_hashes


def test_features_are_words_and_stems():
    raw = ["Horrible cat", "", "horribly"]
    data = [x.encode() for x in raw]
    doc, code = t.features(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    of = [set(code[doc == i].tolist()) for i in range(3)]
    assert [len(x) for x in of] == [3, 0, 2] and len(of[0] & of[2]) == 1
    assert int(t.mix(word_hashes("cat"))[0] >> t._SHIFT) in of[0]


def test_held_out_accuracy(spark, sf01):
    docs, labels = spark.read.parquet(f"{sf01}/documents.parquet"), spark.read.parquet(f"{sf01}/labels.parquet")
    held = "crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1"
    chain = t.fit(docs, labels.where(f"NOT {held}"))
    truth = {r["doc_id"]: r["toxic"] for r in labels.where(held).collect()}
    got = {r["doc_id"]: r for r in t.predict(docs, chain).collect()}
    assert len(got) == docs.count()
    hit = sum(got[i]["toxic"] and y == 1 for i, y in truth.items())
    found, there = sum(got[i]["toxic"] for i in truth), sum(y == 1 for y in truth.values())
    assert there >= 8 and hit / found >= 0.75 and hit / there >= 0.7


def test_later_models_get_earlier_probabilities():
    rng = np.random.default_rng(3)
    n = 600
    first = rng.random(n) < 0.4
    second = first & (rng.random(n) < 0.95)
    sets = [np.unique(np.array([1 if f else 2, *rng.integers(10, 400, 20)], np.int32)) for f in first]
    chain = t.Chain(sets, np.column_stack([first, second]).astype(int))
    assert chain.models[0].v.shape == (0,) and chain.models[1].v.shape == (1,) and chain.models[1].v[0] > 0
    rows, codes = np.repeat(np.arange(n), [len(s) for s in sets]), np.concatenate(sets)
    p = chain.predict(codes, rows, n)
    assert ((p[:, 0] > 0.5) == first).mean() > 0.99 and ((p[:, 1] >= chain.thresholds[1]) == second).mean() > 0.95


def test_threshold():
    assert 0.3 <= t._threshold(np.array([0.9, 0.8, 0.3, 0.2]), np.array([1, 1, 0, 0])) < 0.8
    assert t._threshold(np.array([0.1, 0.2]), np.zeros(2)) == 0.5


def test_edge_cases(spark, make_docs):
    rows = [(i, f"you vile scum number {i}") for i in range(40)] + [(100 + i, f"a kind friend number {i}") for i in range(80)]
    rows += [(500, None), (501, ""), (502, "vile scum"), (502, "vile scum"), (None, "a kind friend"), (503, "kind " * 60_000)]
    labels = [(i, 1, 1) for i in range(40)] + [(100 + i, 1, 0) for i in range(80)] + [(0, 1, 1), (500, 0, 0), (None, 1, 1), (3, None, 0), (900, 0, 1)]
    docs = make_docs(rows)
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text", "1 AS __target")
    got = t.predict(docs, t.fit(docs, frame)).collect()
    assert len(got) == len(rows)
    toxic = {}
    for r in got:
        toxic.setdefault(r["doc_id"], set()).add(r["toxic"])
    assert toxic[502] == {True} and all(toxic[i] == {True} for i in range(40))
    assert all(toxic[i] == {False} for i in (500, 501, 503, None, *range(100, 180)))
    nothing = t.predict(docs, t.fit(docs, frame.limit(0))).collect()
    assert len(nothing) == len(rows) and not any(r["toxic"] or r["p_toxic"] for r in nothing)
    assert t.predict(make_docs([]), t.fit(make_docs([]), frame)).collect() == []


def test_a_bounded_sample_judges_like_all_labels(spark, make_docs):
    words = ["vile"] * 60 + ["odd"] * 40 + ["vile"] * 9 + ["odd"] * 270 + ["calm"] * 621
    docs = make_docs([(i, f"{w} text") for i, w in enumerate(words)])
    labels = spark.createDataFrame([(i, 1, int(i < 100)) for i in range(len(words))], "doc_id long, quality int, toxic int")
    for bound in (t.TRAIN_ROWS, 160):  # all labels; as many positives as negatives
        got = t.predict(docs, t.fit(docs, labels, train_rows=bound)).collect()
        assert {(words[r["doc_id"]], r["toxic"]) for r in got} == {("vile", True), ("odd", False), ("calm", False)}
        assert abs(np.mean([r["p_toxic"] for r in got]) - 0.1) < 0.04


def text_features(text):
    """Hashed words and stems of a text, word by word."""
    import re

    out = set()
    for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
        raw = np.frombuffer(w.encode(), np.uint8)
        out.add(int(t.mix(t.Words(raw, np.array([0, len(raw)])).hash)[0] >> t._SHIFT))
        if len(raw) > t.STEM:
            out.add(int(t.mix(t.Words(raw[: t.STEM], np.array([0, t.STEM])).hash ^ np.uint64(0x5B))[0] >> t._SHIFT))
    return out


class Dense:
    """The chain's linear model on a dense matrix, row by row."""

    def __init__(self, sets, extra, y):
        pos, neg = sum(y), len(y) - sum(y)
        self.scale = {}
        for f in sorted(set().union(*sets)):
            hit = sum(label for s, label in zip(sets, y) if f in s)
            other = sum(1 - label for s, label in zip(sets, y) if f in s)
            cells = [(hit, hit + other, pos), (other, hit + other, neg), (pos - hit, len(y) - hit - other, pos), (neg - other, len(y) - hit - other, neg)]
            g = 2 * sum(k * np.log(k * len(y) / (row * col)) for k, row, col in cells if k)
            if g >= t.LEAST_G and hit + other >= 3:
                self.scale[f] = np.log((hit + 0.5) / (pos + 1) / ((other + 0.5) / (neg + 1)))
        x, y = self.matrix(sets, extra), np.array(y, float)
        theta = np.zeros(x.shape[1])
        theta[-1] = np.log(pos / neg)
        ridge = np.full(len(theta), t.RIDGE)
        ridge[-1] = 0
        speed = square = 0.0
        for k in range(1, 151):
            grad = (x.T @ (1 / (1 + np.exp(-x @ theta)) - y) + ridge * theta) / len(y)
            speed, square = 0.9 * speed + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
            theta = theta - 0.1 * (speed / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
        self.theta = theta

    def matrix(self, sets, extra):
        return np.array([[v if f in s else 0.0 for f, v in self.scale.items()] + [*e, 1.0] for s, e in zip(sets, extra)])

    def predict(self, sets, extra):
        return 1 / (1 + np.exp(-self.matrix(sets, extra) @ self.theta))


def test_query_equals_brute_force(spark, sf001):
    """The registered query against a dense chain over sets of words."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    labels = {r["doc_id"]: (int(r["quality"] == 0), int(r["toxic"] == 1)) for r in spark.read.parquet(f"{sf001}/labels.parquet").collect()}
    ids = sorted(i for i in labels if i in docs)
    ids = sorted(ids, key=lambda i: int(t.mix(np.array([i], np.uint64))[0]))
    sets, every = [text_features(docs[i]) for i in ids], {i: text_features(x) for i, x in docs.items()}
    fold = np.arange(len(ids)) % t.FOLDS
    earlier, models, cuts = [[] for _ in ids], [], []
    for k in (0, 1):
        y = [labels[i][k] for i in ids]
        out = np.zeros(len(ids))
        for f in range(t.FOLDS):
            train, held = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            out[held] = Dense([sets[a] for a in train], [earlier[a] for a in train], [y[a] for a in train]).predict([sets[a] for a in held], [earlier[a] for a in held])
        models.append(Dense(sets, earlier, y))
        best = max(range(len(ids)), key=lambda a: (2 * sum(y[b] for b in range(len(ids)) if out[b] >= out[a]) / (sum(out >= out[a]) + sum(y)), out[a]))
        below = out[out < out[best]].max(initial=0.0)
        cuts.append((out[best] + below) / 2)
        earlier = [[*e, p] for e, p in zip(earlier, out)]
    got = {r["doc_id"]: r for r in t.op9_toxicity(spark, sf001).collect()}
    assert set(got) == set(docs) and any(r["toxic"] for r in got.values())
    low = models[0].predict(list(every.values()), [[]] * len(every))
    toxic = models[1].predict(list(every.values()), [[p] for p in low])
    for i, a, b in zip(every, low, toxic):
        assert abs(got[i]["p_low_quality"] - a) < 1e-4 and abs(got[i]["p_toxic"] - b) < 1e-4
        if abs(b - cuts[1]) > 1e-4:
            assert got[i]["toxic"] == (bool(every[i]) and b >= cuts[1])
