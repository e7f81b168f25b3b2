"""Operator 2: n-gram Jaccard join by MinHash bands, verified exactly.

Texts are compared by their sets of five-word shingles; a link joins two texts
with a Jaccard similarity of 0.8 or more. (A text of one to four words is a
single shingle; one without words has no shingles and no links.)

1. One pass over the whole texts makes each text's shingle set, a digest of
   the set, and ``TREES`` MinHash bands of ``prefix_depth`` minima each. Texts
   with equal sets form a *class* and go on as one representative.
2. Representatives that agree in a whole band form a bucket. The bands have one
   depth for all texts, the longest at which a pair at the threshold meets in
   some band with probability ``RECALL`` (no forest: paths are not sorted, and
   none is shortened by what the data show). A link at exactly 0.8 is missed
   with (1 - 0.8^4)^16 = 2.2e-4, one at 0.85 with 7.4e-6.
3. Buckets with the same members in several tries are kept once. A bucket of
   more than ``BLOCK`` members is cut in blocks, and each pair of blocks is a
   task of its own, so no bucket meets whole in one task and no pair of rows
   is written out.
4. Each task verifies its pairs exactly on their whole shingle sets, by one
   product of presence matrices. A pair counts only in the first trie in which
   it meets, so it counts once. Out come, per member, its number of links and
   the smallest member it hangs together with.
5. Links are joined to groups by alternating star contraction on tables in
   the shared folder; labels never reach the driver.

Shingles are compared by 64-bit hashes.

Defined results: null and empty texts have no words: each is a class and group
of its own with no links; repeated rows are members of one class; a null
doc_id is kept (ids are compared null last); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WORDS_SQL, Words, mix, stored, table, text_slices, trimmed

SHINGLE = 5
SIMILARITY = 0.8
TREES = 16
MAX_DEPTH = 8
RECALL = 0.9995
BLOCK = 192

_SIGN = "row bigint, doc_id bigint, text_hash bigint, digest binary, n int, keys array<bigint>"
_FOUND = "rep bigint, links bigint, docs bigint, root bigint"


def prefix_depth(similarity: float = SIMILARITY, trees: int = TREES, recall: float = RECALL, max_depth: int = MAX_DEPTH) -> int:
    """The longest prefix under which a pair at ``similarity`` meets in some
    trie with probability ``recall`` at least."""
    depth = max_depth
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, one after another;
    and how many each text has."""
    words = Words(data, offsets)
    n = words.per_doc
    place = [np.uint64(x) for x in mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)]
    h = words.hash
    hashed = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for j in range(size):
        hashed += h[j : len(h) - size + 1 + j] * place[j] if len(hashed) else np.uint64(0)
    hashed = mix(hashed)
    ends = np.cumsum(n)
    sets, counts = [], np.zeros(len(n), np.int64)
    for i, (a, b) in enumerate(zip((ends - n).tolist(), ends.tolist())):
        if b - a >= size:
            own = np.sort(hashed[a : b - size + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            own = mix(np.array([sum(int(h[a + j]) * int(place[j]) for j in range(b - a)) % (1 << 64) ^ (b - a)], np.uint64))
        else:
            continue
        sets.append(own)
        counts[i] = len(own)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), counts


def _sign_task(size: int, trees: int, depth: int):
    seeds = mix(np.arange(1, 2 * trees * depth + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    flip, factor = seeds[: trees * depth], seeds[trees * depth :] | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(3)):
                sets, n = shingle_sets(data, offsets, size)
                some = np.flatnonzero(n)
                at = (np.cumsum(n) - n)[some]
                keys = np.zeros((len(some), trees), np.uint64)
                digest: list[bytes | None] = [None] * (hi - lo)
                if len(some):
                    for k in range(trees * depth):
                        least = np.minimum.reduceat((sets ^ flip[k]) * factor[k], at)
                        keys[:, k // depth] = mix(keys[:, k // depth] + least + np.uint64(k + 1))
                    low, high = np.add.reduceat(mix(sets), at), np.add.reduceat(mix(sets ^ np.uint64(0x5DEECE66D)), at)
                    for i, a, b, c in zip(some.tolist(), low.tolist(), high.tolist(), n[some].tolist()):
                        digest[i] = a.to_bytes(8, "little") + b.to_bytes(8, "little") + c.to_bytes(8, "little")
                starts = np.concatenate([[0], np.cumsum((n > 0) * trees)]).astype(np.int32)
                paths = pa.ListArray.from_arrays(pa.array(starts), pa.array(keys.reshape(-1).view(np.int64)))
                own = [batch.column(i).slice(lo, hi - lo) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(digest, pa.binary()), pa.array(n, pa.int32()), paths], [x.split()[0] for x in _SIGN.split(", ")])

    return run


def _set_task(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                sets, n = shingle_sets(data, offsets, size)
                ends = np.cumsum(n).tolist()
                raw = [sets[e - c : e].tobytes() for e, c in zip(ends, n.tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(raw, pa.binary())], ["rep", "shingles"])

    return run


def _links(sets: list[np.ndarray], keys: np.ndarray, tree: int, first: np.ndarray, second: np.ndarray, similarity: float) -> np.ndarray:
    """Verified links (as a boolean matrix) between the members ``first`` and ``second``."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    number = np.cumsum(count > 1) - 1
    row, column = owner[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(first), len(second)), np.float32)
    width = 8192
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        presence = np.zeros((len(sets), width), np.float32)
        presence[row[a:b], column[a:b] - lo] = 1
        both += presence[first] @ presence[second].T
    size = np.array([len(s) for s in sets], np.float64)
    union = size[first][:, None] + size[second][None, :] - both
    meet = keys[first][:, None, :] == keys[second][None, :, :]
    return (both + 1e-6 >= similarity * union) & (meet.argmax(axis=2) == tree) & meet.any(axis=2)


def _verify(rows: list[tuple], similarity: float) -> list[tuple]:
    """rows: (tree, low block, high block, rep, block, copies, keys, shingles) of one task."""
    tree, low, high = rows[0][:3]
    rows = list({r[3]: r for r in rows}.values())
    reps = np.array([r[3] for r in rows])
    sets = [np.frombuffer(r[7], "<u8") for r in rows]
    keys, copies = np.array([r[6] for r in rows]), np.array([r[5] for r in rows])
    block = np.array([r[4] for r in rows])
    first, second = np.flatnonzero(block == low), np.flatnonzero(block == high)
    if not len(first) or not len(second):
        return []
    link = _links(sets, keys, tree, first, second, similarity)
    links, docs = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    if low == high:
        np.fill_diagonal(link, False)
        links[first], docs[first] = link.sum(axis=1), link @ copies[first]
    else:
        links[first], docs[first] = link.sum(axis=1), link @ copies[second]
        links[second], docs[second] = link.sum(axis=0), copies[first] @ link
    root = np.arange(len(rows))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in zip(*np.nonzero(link)):
        a, b = find(first[i]), find(second[j])
        if a != b:
            a, b = (a, b) if reps[a] < reps[b] else (b, a)
            root[b] = a
    return [(int(reps[i]), int(links[i]), int(docs[i]), int(reps[find(i)])) for i in range(len(rows)) if links[i]]


def _verify_task(similarity: float):
    """Rows come sorted by task; a task's rows may span batches."""

    def out(found: list[tuple]) -> pa.RecordBatch:
        names = [x.split()[0] for x in _FOUND.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows, found = None, [], []
        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
                now = (bucket, row[1], row[2])
                if now != task:
                    if rows:
                        found += _verify(rows, similarity)
                    task, rows = now, []
                rows.append(tuple(row))
            if found:
                yield out(found)
                found = []
        if rows:
            found += _verify(rows, similarity)
        if found:
            yield out(found)

    return run


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the smallest node that
    it hangs together with. Alternating large-star and small-star steps; each
    round is a table in the shared folder, only row counts reach the driver."""
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "components")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        edges = stored(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(small).where("a <> b").distinct(), "components")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def jaccard_groups(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, trees: int = TREES, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, text_hash, class_id (smallest doc_id with
    the same shingle set), group_id (smallest doc_id that links lead to),
    n_links (other classes linked to its class), n_similar (other rows in its
    class or in linked classes), first (the one row of its group that stays)."""
    depth = prefix_depth(similarity, trees, recall)
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    ids = F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), ids, text_hash.alias("text_hash"), "text")
    signed = stored(rows.mapInArrow(trimmed(_sign_task(shingle, trees, depth)), _SIGN), "jaccard-signatures")
    # The representative has the smallest doc_id (null last), then row.
    order = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), "row", "doc_id", "text_hash", "keys")
    classes = signed.where("n > 0").groupBy("digest").agg(F.min(order).alias("x"), F.count("*").alias("copies"))
    classes = stored(classes.select("digest", "copies", "x.row", "x.doc_id", "x.text_hash", "x.keys").withColumnRenamed("row", "rep"), "jaccard-classes")

    # Buckets: representatives under one prefix of one trie.
    leaves = classes.select("rep", F.posexplode("keys").alias("tree", "prefix"))
    buckets = leaves.groupBy("tree", "prefix").agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("rep")).alias("d1"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("d2"))
    kept = buckets.where("members > 1").groupBy("members", "d1", "d2").agg(F.min(F.struct("tree", "prefix")).alias("x")).select("x.tree", "x.prefix", "members")
    members = leaves.join(kept, ["tree", "prefix"])
    blocks = F.ceil(F.col("members") / block).cast("int")
    members = members.withColumn("block", F.pmod(F.xxhash64("rep", "prefix"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    members = stored(members.select("rep", "tree", "prefix", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")), "jaccard-members")

    # Shingle sets of the representatives in buckets, from their texts.
    wanted = members.select("rep").distinct().join(classes, "rep").select("rep", F.col("doc_id").alias("want_id"), F.col("text_hash").alias("want_hash"))
    texts = docs.select(ids, "text", text_hash.alias("text_hash"))
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("want_id")) & (F.col("text_hash") == F.col("want_hash"))).select("rep", "text")
    sets = stored(texts.mapInArrow(trimmed(_set_task(shingle)), "rep bigint, shingles binary"), "jaccard-sets").join(classes.select("rep", "copies", "keys"), "rep")

    tasks = members.join(sets, "rep").select(F.xxhash64("tree", "prefix").alias("bucket"), "tree", "low", "high", "rep", "block", "copies", "keys", "shingles")
    tasks = tasks.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    found = stored(tasks.mapInArrow(trimmed(_verify_task(similarity)), _FOUND), "jaccard-links")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"), F.sum("docs").alias("docs"))
    roots = connected(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))

    # Groups: the representative with the smallest (doc_id, row) speaks for all.
    labelled = classes.select("digest", "rep", "doc_id", "copies").join(linked, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    labelled = labelled.withColumn("root", F.coalesce("root", "rep"))
    first = labelled.groupBy("root").agg(F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)), F.col("rep").alias("first_row"), F.col("doc_id").alias("group_id"))).alias("x"))
    labelled = labelled.join(first.select("root", "x.first_row", "x.group_id"), "root").select("digest", F.col("doc_id").alias("class_id"), "copies", "links", "docs", "first_row", "group_id")
    every = signed.select("row", "doc_id", "text_hash", "digest").join(labelled, "digest", "left")
    alone = F.col("first_row").isNull()
    return every.select(
        "doc_id",
        "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("group_id")).alias("group_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        (F.coalesce("docs", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_similar"),
        (alone | (F.col("row") == F.col("first_row"))).alias("first"),
    )


def one_per_group(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` of which one of each group stays, all columns kept.
    (Of rows that agree in doc_id and text, all stay or go together.)"""
    groups = jaccard_groups(docs, **options)
    gone = groups.groupBy(F.col("doc_id").alias("__gone_id"), F.col("text_hash").alias("__gone_hash")).agg(F.max("first").alias("__stays")).where("NOT __stays")
    own = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__gone_id")) & (own == F.col("__gone_hash")), "left_anti")


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "group_id", "n_links", "n_similar")


#: The same join by common shingles in DuckDB SQL.
OP2_SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
s AS (
  SELECT r, doc_id, unnest(list_distinct(list_transform(generate_series(1, greatest(1, len(w) - 4)), lambda i: array_to_string(w[i : i + 4], ' ')))) AS g
  FROM d WHERE len(w) > 0
), sets AS (SELECT r, doc_id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS k FROM s GROUP BY r, doc_id),
classes AS (SELECT k, any_value(n) AS n, min(doc_id) AS class_id, count(*) AS copies, min(r) AS first FROM sets GROUP BY k),
cs AS (SELECT k, g FROM s JOIN classes ON r = first),
pairs AS (SELECT a.k AS ka, b.k AS kb, count(*) AS c FROM cs a JOIN cs b ON a.g = b.g AND a.k <> b.k GROUP BY 1, 2),
links AS (SELECT ka, kb, y.copies FROM pairs JOIN classes x ON x.k = ka JOIN classes y ON y.k = kb WHERE 5 * c >= 4 * (x.n + y.n - c)),
reach AS (SELECT k, k AS m FROM classes UNION SELECT reach.k, kb FROM reach JOIN links ON m = ka),
groups AS (SELECT reach.k, min(class_id) AS group_id FROM reach JOIN classes ON classes.k = m GROUP BY 1),
counts AS (SELECT ka AS k, count(*) AS n_links, sum(copies) AS docs FROM links GROUP BY 1)
SELECT d.doc_id, CASE WHEN k IS NULL THEN d.doc_id ELSE class_id END AS class_id, CASE WHEN k IS NULL THEN d.doc_id ELSE group_id END AS group_id,
       coalesce(n_links, 0) AS n_links, CAST(coalesce(docs, 0) + coalesce(classes.copies, 1) - 1 AS BIGINT) AS n_similar
FROM d LEFT JOIN sets USING (r) LEFT JOIN classes USING (k) LEFT JOIN groups USING (k) LEFT JOIN counts USING (k)
"""
