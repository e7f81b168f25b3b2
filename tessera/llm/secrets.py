"""Operator 5: secret scan with multipart credential linking. DataFrame functions only.

Base kinds (they always stay): ``assign`` (a password-like name, a separator
and a value of 8 or more characters), ``access`` (AKIA identifiers of 16 or
more) and ``hex`` (32 or more hex digits).

Weak parts say little alone: ``weak_access`` (the value given to a user,
account, client or key identifier), ``weak_secret`` (a run of 20 or more key
characters with letters and digits, outside any base span) and ``endpoint``
(a URL, or a host with a port). They are linked by an interval join: two parts
are in one scope when their starts lie within ``SCOPE`` code points in the same
text. A weak access identifier is reported only when a secret (assign, hex or
weak) is in its scope; a weak secret only when an access identifier is; an
endpoint only when both are.

Positions come from the lengths of the pieces between a pattern's matches,
summed up by a window over the matches of one text and kind, and the interval
join is a window with a range frame: time and memory follow the number of
matches, never pairs. Only texts with some part are shuffled, as lengths.
Patterns can start only at the head of a run, so scanning stays linear.

Defined results: null counts as empty; a text without findings gives zero
counts, the hash of the empty string and an empty span list; repeated rows are
scanned row by row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored, table

SCOPE = 200
#: Kinds in the order of the contract, added ones after them.
KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "endpoint")

_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_WEAK_ACCESS = r"""(?i:(?<![A-Za-z0-9])(?:user|username|login|account|client_?id|access_?key_?id|access_?id|key_?id))["']?\x20{0,4}[:=]\x20{0,4}["']?([A-Za-z0-9_.@-]{3,})"""
_WEAK_SECRET = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}+"
_ENDPOINT = r"""(?i:(?<![A-Za-z0-9+.-])[a-z][a-z0-9+-]{1,15}://[^\s"'<>]++|(?<![A-Za-z0-9.-])[a-z0-9-]++(?:\.[a-z0-9-]++){1,8}:[0-9]{2,5}(?![0-9]))"""

#: kind, pattern, group whose length counts, least length. Runs are matched
#: whole (a shorter run fails as a whole), so the bound may stand in the pattern.
PATTERNS = (
    ("assign", _ASSIGN, 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
    ("weak_access", _WEAK_ACCESS, 0, 1),
    ("weak_secret", _WEAK_SECRET, 0, 20),
    ("endpoint", _ENDPOINT, 0, 1),
)


def _matches(text: Column, order: int, pattern: str, group: int, least: int) -> Column:
    """Array of (kind's place, gap before the match, match length, holds)."""
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.zip_with(F.slice(between, 1, F.size(whole)), F.arrays_zip(whole.alias("w"), part.alias("p")), lambda gap, m: F.struct(
        F.lit(order).alias("kind"), F.char_length(gap).alias("gap"), F.char_length(m["w"]).alias("length"), (F.char_length(m["p"]) >= least).alias("holds")))
    none = F.array().cast("array<struct<kind:int,gap:int,length:int,holds:boolean>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def _named(spans: Column) -> Column:
    """kind:start:end, comma-joined, of (start, kind's place, end) structs."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_parts(docs: DataFrame) -> DataFrame:
    """row, doc_id and per kind the lengths of matches and of the gaps before
    them, as a table in the shared folder (the only pass over the texts)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    every = [_matches(F.col("text"), i, pattern, group, least).alias(kind) for i, (kind, pattern, group, least) in enumerate(PATTERNS)]
    return stored(rows.select("row", "doc_id", *every), "secret-parts")


def linked_spans(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per text with some match: row, doc_id, spans (start, kind, end)."""
    lengths = None
    for kind in KINDS:
        one = parts.select("row", "doc_id", F.posexplode(kind).alias("place", "m")).select("row", "doc_id", "place", "m.*")
        lengths = one if lengths is None else lengths.unionByName(one)
    so_far = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = lengths.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(so_far))
    spans = spans.select("row", "doc_id", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "holds")
    base = F.col("kind") < 3
    # Weak secrets must not touch a base span: the farthest end before, the nearest start after.
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = spans.withColumn("reach", F.max(F.when(base & F.col("holds"), F.col("end"))).over(before)).withColumn("next", F.min(F.when(base & F.col("holds"), F.col("start"))).over(after))
    touches = (F.coalesce("reach", F.lit(-1)) > F.col("start")) | (F.coalesce("next", F.lit(1 << 40)) < F.col("end"))
    spans = spans.withColumn("holds", F.col("holds") & ~((F.col("kind") == 4) & touches)).drop("reach", "next")
    # The interval join: what else starts within the scope.
    near = Window.partitionBy("row").orderBy("start").rangeBetween(-scope, scope)
    some = lambda *kinds: F.max(F.when(F.col("holds"), F.col("kind").isin(*kinds))).over(near)
    spans = spans.withColumn("access", F.coalesce(some(1, 3), F.lit(False))).withColumn("secret", F.coalesce(some(0, 2, 4), F.lit(False)))
    linked = F.when(base, True).when(F.col("kind") == 3, F.col("secret")).when(F.col("kind") == 4, F.col("access")).otherwise(F.col("access") & F.col("secret"))
    span = F.when(F.col("holds") & linked, F.struct("start", "kind", "end"))
    return spans.groupBy("row", "doc_id").agg(F.collect_list(span).alias("spans"))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and all spans of every row."""
    parts = find_parts(docs)
    some = sum((F.size(k) for k in KINDS), F.lit(0)) > 0
    clean = parts.where(~some).select("doc_id", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>").alias("spans"))
    found = linked_spans(parts.where(some), scope).select("doc_id", "spans")
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return clean.union(found).select("doc_id", count(0), count(1), count(2), F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
