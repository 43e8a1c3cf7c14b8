"""Secret scan with corpus-wide ownership frequency.

One pass finds candidates in whole texts. The digests of their values are counted over distinct
repositories (documents) and distinct owners (sources): a value that many owners hold is a widely
copied example, a value of few owners that looks random is a live credential. The base patterns'
spans always stay; the wider patterns add the spans whose value is owner-specific and live-looking.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents, map_arrow, stored

# Fixed values of the base scan: kinds in their listed order, patterns, least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "vendor", "random")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")

#: Wider candidates: tokens with a vendor's prefix, and long runs that mix cases and digits.
VENDOR = re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]_|glpat-|sk-|xox[abprs]-|AIza|ya29\.)[A-Za-z0-9_-]{16,}")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
#: Values held by at least this many owners are copied examples.
WIDE = 3
#: Bits a character from which a value looks random.
ENTROPY = 3.0
#: Parts of values that mark a placeholder.
PLACEHOLDER = re.compile(r"example|sample|dummy|placeholder|changeme|your[_-]?|xxxx|0000000|1234567", re.IGNORECASE)

CANDIDATE = "array<struct<kind:int,start:long,end:long,digest:string,live:boolean>>"


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def live_looking(value: str) -> bool:
    return entropy(value) >= ENTROPY and not PLACEHOLDER.search(value)


def base_matches(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base patterns, by start and kind."""
    found = [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    lower = text.lower()
    if any(hint in lower for hint in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    return sorted(found)


def wider_matches(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Candidates of the wider patterns that touch no base span, nor each other."""
    found = [(m.start(), 3, m.end(), m[0]) for m in VENDOR.finditer(text)]
    for m in RANDOM.finditer(text):
        v = m[0]
        if any(map(str.isdigit, v)) and any(map(str.isupper, v)) and any(map(str.islower, v)):
            found.append((m.start(), 4, m.end(), v))
    out: list[tuple[int, int, int, str]] = []
    for x in sorted(found):
        if all(x[2] <= b[0] or b[2] <= x[0] for b in base) and (not out or out[-1][2] <= x[0]):
            out.append(x)
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("digest", pa.string()), ("live", pa.bool_())]))
    for batch in batches:
        counts, shas, found = [], [], []
        for text in batch.column("text").to_pylist():
            base = base_matches(text or "")
            counts.append([sum(x[1] == k for x in base) for k in range(3)])
            shas.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in base).encode()).hexdigest())
            found.append([{"kind": k, "start": s, "end": e, "digest": hashlib.sha256(v.encode()).hexdigest(),
                           "live": live_looking(v)} for s, k, e, v in base + wider_matches(text or "", base)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("doc_id"), batch.column("_owner"),
             *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3)),
             pa.array(shas, pa.string()), pa.array(found, out_type)],
            names=["_row", "doc_id", "_owner", "n_assign", "n_access", "n_hex", "base_sha256", "found"])


def value_owners(candidates: DataFrame) -> DataFrame:
    """digest -> repositories, owners. Counted in three steps, each summed before its shuffle, so a
    value that a third of all rows hold never gathers in one task."""
    return (candidates.select("digest", "_owner", "doc_id").distinct()
            .groupBy("digest", "_owner").agg(F.count(F.lit(1)).alias("_documents"))
            .groupBy("digest").agg(F.sum("_documents").alias("repositories"),
                                   F.count(F.lit(1)).alias("owners")))


def scan_secrets(docs: DataFrame, owner: str = "source", wide: int = WIDE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans (array of
    kind, start, end, digest, class, owners, repositories by start and kind), n_live, n_example.

    ``start``/``end`` are code points, end exclusive. A span's class is ``example`` (at least
    ``wide`` owners), ``live`` (fewer, random-looking) or ``weak``. A NULL or empty text has no spans
    (its digest is that of the empty string); a NULL owner counts as one owner; repeated rows
    give repeated results; texts of any length are scanned whole; an empty table gives no rows; other
    columns, whatever their names, are not read.
    """
    owner_col = F.coalesce(F.col(owner).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"),
                       owner_col.alias("_owner"), "text")
    scan = stored(map_arrow(rows, _scan, "_row long, doc_id long, _owner string, n_assign long, n_access long, "
                                         f"n_hex long, base_sha256 string, found {CANDIDATE}"), "secret-scan")
    candidates = scan.select("_row", "doc_id", "_owner", F.explode("found").alias("_x")) \
        .select("_row", "doc_id", "_owner", "_x.*")
    judged = candidates.join(value_owners(candidates), "digest").withColumn(
        "class", F.when(F.col("owners") >= wide, "example").when(F.col("live"), "live").otherwise("weak"))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    spans = (judged.where((F.col("kind") < 3) | (F.col("class") == "live"))
             .groupBy("_row").agg(F.sort_array(F.collect_list(F.struct(
                 "start", F.col("kind").alias("_kind"), kind.alias("kind"), "end", "digest", "class", "owners",
                 "repositories"))).alias("spans")))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return (scan.drop("found", "_owner").join(spans, "_row", "left")
            .withColumn("spans", F.coalesce("spans", empty))
            .withColumn("n_live", F.size(F.filter("spans", lambda x: x["class"] == "live")).cast("long"))
            .withColumn("n_example", F.size(F.filter("spans", lambda x: x["class"] == "example")).cast("long"))
            .drop("_row"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, spans as ``kind:start:end`` joined by commas."""
    return scan_secrets(documents(spark, sf_dir)).withColumn("spans", F.array_join(F.transform(
        "spans", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","))
