"""Secret scans over an incremental ledger of blobs.

Every version of a text is named by the SHA-256 of its content.  A ledger in
shared storage holds which blob was scanned under which rule version, and the
spans found.  A scan reads only blobs that the ledger doesn't have under the
current version, each once however many paths carry it, appends them, and
joins the findings back to all paths.

A rule is a pattern and a least length of one of its groups; its version is a
hash of both, so a changed or new rule is scanned over old blobs again, the
others aren't.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, table, text_of
from .words import slices


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group``
    has fewer than ``least`` characters are dropped afterwards.  ``hints``: in
    lower case, every text with a match holds one of them (none: not known).
    Patterns must take linear time, also where they don't match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    hints: tuple[str, ...] = ()

    @property
    def version(self) -> str:
        return hashlib.sha256(f"{self.pattern}\0{self.group}\0{self.least}".encode()).hexdigest()[:16]


def _either_case(letters: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in letters)


# The contract's patterns, then forms of well-known credentials.
# A run of 32 or more is the same as any run of which the shorter are dropped.
BASE_RULES = (
    Rule("assign", "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, ("passw", "secret", "token", "api")),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16, ("akia",)),
    Rule("hex", "[0-9a-f]{32,}"),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("-----begin ",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{1,1000}\.eyJ[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)?", hints=(".eyj",)),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 20, ("xox",)),
    Rule("google", "AIza[A-Za-z0-9_-]+", 0, 39, ("aiza",)),
    Rule("bearer", r"Bearer\x20+([A-Za-z0-9+/_.=-]+)", 1, 20, ("bearer",)),
    Rule("url_password", r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[A-Za-z0-9_.-]+:([^\x20\x09-\x0D/@:]+)@", 1, 1, ("://",)),
)
RULES = BASE_RULES + MORE_RULES

_FINDING = "blob string, version string, start long, `end` long"


def _scan(rules: Sequence[Rule]):
    """blob, versions seen, text -> a row for each span of a rule not seen, and
    one without a span for each scanned rule."""
    compiled = [(r.version, re.compile(r.pattern), r.group, r.least, r.hints) for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, 2):
            blobs, versions, starts, ends = [], [], [], []
            for blob, seen, text in zip(part.column(0), part.column(1), texts):
                blob, seen, text = blob.as_py(), set(seen.as_py() or ()), text.decode("utf-8", "replace")
                low = text.lower()
                for version, pattern, group, least, hints in compiled:
                    if version in seen:
                        continue
                    spans = [m.span() for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least] if not hints or any(h in low for h in hints) else []
                    for start, end in [(None, None), *spans]:
                        blobs.append(blob), versions.append(version), starts.append(start), ends.append(end)
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.string()), pa.array(versions, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["blob", "version", "start", "end"])

    return run


class Ledger:
    """Scanned (blob, rule version) pairs and their findings under ``path``.

    A scan's rows are one folder, written whole or not at all: a row without a
    span says that the pair was scanned.  ``path`` must be shared storage."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(_FINDING).option("recursiveFileLookup", True).parquet(self.path)
        except AnalysisException:  # nothing written so far
            return self.spark.createDataFrame([], _FINDING)

    def append(self, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.path}/scan-{uuid.uuid4().hex}")

    def scan(self, versions: DataFrame, path: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
        """path, blob of every row of ``versions``; blobs new to the ledger
        under one of the rules are scanned and recorded.

        Null texts are empty.  The blob of equal texts is read once, from the
        row with the least path.  Copies of a text may be any share of the
        rows: they are counted out by hash before texts are dealt.
        """
        wanted = sorted({r.version for r in rules})
        seen = self.rows().where(F.col("start").isNull() & F.col("version").isin(wanted)).groupBy("blob").agg(F.collect_set("version").alias("seen"))
        rows = versions.select(F.col(path).alias("path"), text_of(text).alias("text")).withColumn("blob", F.sha2("text", 256))
        ws = Workspace(self.spark, "secrets")
        paths = ws.store(rows.select("path", "blob"), "paths")
        new = paths.groupBy("blob").agg(F.min("path").alias("from")).join(seen, "blob", "left").where(F.size(F.coalesce("seen", F.array().cast("array<string>"))) < len(wanted))
        # rows that repeat the path and the text meet in one task, and are scanned one by one
        texts = rows.where("text != ''").join(new, (rows.blob == new.blob) & rows.path.eqNullSafe(new["from"])).select(new.blob, "seen", "text")
        once = ws.store(texts.mapInArrow(_scan(rules), _FINDING), "found").distinct()
        # texts without characters hold nothing under any rule and need no record
        self.append(once)
        return paths

    def findings(self, paths: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
        """path, blob, spans (array of kind, start, end by start, then kind as
        listed): one row for each row of ``paths``."""
        order = F.lit(None).cast("int")
        kind = F.lit(None).cast("string")
        for i, r in reversed(list(enumerate(rules))):
            hit = F.col("version") == r.version
            order, kind = F.when(hit, i).otherwise(order), F.when(hit, r.kind).otherwise(kind)
        spans = self.rows().where("start IS NOT NULL").select("blob", "start", order.alias("place"), kind.alias("kind"), "end").where("place IS NOT NULL")
        # rows of a pair that two scans recorded are the same
        of_blob = spans.distinct().groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "place", "kind", "end"))).alias("spans"))
        none = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
        return paths.join(of_blob, "blob", "left").select("path", "blob", F.coalesce("spans", none).alias("spans"))


def _listed(spans, kinds: Sequence[str] | None = None):
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``Ledger.findings``."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = [r.kind for r in BASE_RULES]
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(_listed(F.col("spans"), base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def query(spark, sf_dir):
    """A first scan: an empty ledger, one version of each document."""
    ledger = Ledger(spark, Workspace(spark, "secrets-ledger").path)
    return digest(ledger.findings(ledger.scan(table(spark, sf_dir, "documents"))))


def _oracle() -> str:
    """Matches of each rule, placed by the lengths of the pieces between them."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(RULES):
        parts.append(f"""
  SELECT row, {quoted(r.kind)} AS kind, {i} AS place, string_split_regex(t, {quoted(r.pattern)}) AS gaps,
         regexp_extract_all(t, {quoted(r.pattern)}, 0) AS whole, regexp_extract_all(t, {quoted(r.pattern)}, {r.group}) AS part, {r.least} AS least
  FROM d WHERE regexp_matches(t, {quoted(r.pattern)})""")
    spans = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place)"
    base = f"place < {len(BASE_RULES)}"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}')::BIGINT AS n_{r.kind}" for r in BASE_RULES)
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS row FROM documents),
m AS ({' UNION ALL '.join(parts)}),
p AS (
  SELECT row, kind, place, least, part, i,
         (list_sum([length(x) for x in gaps[1:i]]) + list_sum([length(x) for x in whole[1:i]]) - length(whole[i]))::BIGINT AS s,
         length(whole[i]) AS size
  FROM m, unnest(range(1, len(whole) + 1)) AS u(i)),
f AS (SELECT row, kind, place, s, s + size AS e FROM p WHERE length(part[i]) >= least),
g AS (SELECT row, {counts}, {spans} FILTER (WHERE {base}) AS base, {spans} AS spans FROM f GROUP BY row)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (row)
"""


ORACLE = _oracle()
