"""Secret scans over an incremental ledger of blobs.

Every version of a file is addressed by the SHA-256 of its text. The ledger holds, for
each (blob, rule version) scanned so far, the blob's findings; a run scans only pairs
that the ledger lacks, appends their rows and no others, and joins findings back to every
path that ever held the blob.

One text is scanned for each blob: copies are dropped within each task before the
shuffle by blob and again after it, so a group of copies with a third of all rows
sends at most one text from each task. The join back is on the blob, where the large
side's hot blob is split by AQE.

Defined results: a null text is the empty blob, which has no findings; repeated rows
are each returned; a null path stays; very long texts are scanned whole; an empty history
gives empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import parts_for, scratch, table

RULE_VERSION = "1"
#: Blobs that a task remembers, at most.
SEEN = 1 << 19

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: A keyword is there whenever this matches; most texts have none.
_KEYWORD = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Kinds beyond the base ones, each with an unmistakable prefix.
_MORE = {
    "pem": re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "slack": re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"),
}
_MORE_HINT = {"pem": "-----BEGIN ", "jwt": "eyJ", "github": "gh", "slack": "xox"}
BASE = ("assign", "access", "hex")
KINDS = (*BASE, *_MORE)
RESULT = "blob string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) in code points, by start and then kind."""
    out = []
    if _KEYWORD.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    for k, (kind, pattern) in enumerate(_MORE.items(), len(BASE)):
        if _MORE_HINT[kind] in text:
            out += [(m.start(), k, m.end()) for m in pattern.finditer(text)]
    out.sort()
    return out


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def _first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(blob, text) without the copies that this task has already sent."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for blob in batch.column("blob").to_pylist():
            key = bytes.fromhex(blob[:32])
            keep.append(key not in seen)
            if len(seen) >= SEEN:
                seen.clear()  # a copy more is sent
            seen.add(key)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(blob, text) -> RESULT. The rows of one blob are in one task."""
    seen: set[bytes] = set()
    for batch in batches:
        rows = []
        for blob, text in zip(batch.column("blob").to_pylist(), batch.column("text")):
            if (key := bytes.fromhex(blob[:32])) in seen:
                continue
            if len(seen) >= SEEN:
                seen.clear()  # a copy more is scanned
            seen.add(key)
            found = find(text.as_py())
            base = [x for x in found if x[1] < len(BASE)]
            n = [sum(x[1] == k for x in base) for k in range(len(BASE))]
            rows.append((blob, *n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found)))
        names = ["blob", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = list(zip(*rows)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _blob(text: str | Column) -> Column:
    """A text's content address; null is the empty text."""
    return F.sha2(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), 256)


class Ledger:
    """What has been scanned: rows of RESULT with rule_version, one for each pair of blob
    and rule version, in a folder to which each run adds its own rows only."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.rows = spark, path or scratch(spark, "ledger"), None

    def known(self, rule_version: str) -> DataFrame | None:
        """The rows of a rule version; None before anything was scanned."""
        rows = self._all()
        return None if rows is None else rows.where(F.col("rule_version") == rule_version).drop("rule_version")

    def _all(self) -> DataFrame | None:
        if self.rows is None:
            try:
                self.rows = self.spark.read.schema(f"{RESULT}, rule_version string").parquet(self.path)
            except AnalysisException:  # nothing there yet
                return None
        return self.rows

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").option("compression", "zstd").parquet(self.path)
        self.rows = None  # listed anew


def scan_unseen(history: DataFrame, ledger: Ledger, text: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """RESULT of the blobs that the ledger lacks for this rule version, one row each.

    Texts are dealt by blob once; the known blobs are dealt alike and left out there."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    blobs = history.select(F.sha2(body, 256).alias("blob"), body.alias("text"))
    n = parts_for(history)
    once = blobs.mapInArrow(_first_copies, "blob string, text string").repartition(n, "blob")
    known = ledger.known(rule_version)
    if known is not None:
        once = once.join(known.select("blob").repartition(n, "blob").hint("shuffle_hash"), "blob", "left_anti")
    return once.mapInArrow(_scan, RESULT).dropDuplicates(["blob"])


def scan(history: DataFrame, ledger: Ledger, text: str = "text", rule_version: str = RULE_VERSION) -> None:
    """Scans what is new in history and adds it to the ledger."""
    ledger.add(scan_unseen(history, ledger, text, rule_version).withColumn("rule_version", F.lit(rule_version)))


def findings(history: DataFrame, ledger: Ledger, keys: tuple[str, ...] = ("doc_id",), text: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """Every row of history with what the ledger has for its blob: keys, then RESULT. A key
    named like a column of RESULT is an error."""
    taken = {c.split()[0] for c in RESULT.split(", ")}
    if clash := taken.intersection(keys):
        raise ValueError(f"rename {sorted(clash)}")
    known = ledger.known(rule_version)
    if known is None:
        known = ledger.spark.createDataFrame([], RESULT)
    return history.select(*(F.col(f"`{k}`") for k in keys), _blob(F.col(f"`{text}`")).alias("blob")).join(known, "blob")


def op1_blob_ledger(spark, sf_dir):
    """Documents arrive in two parts; the second scans what the first has not seen."""
    docs, ledger = table(spark, sf_dir, "documents"), Ledger(spark)
    for part in range(2):
        scan(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == part), ledger)
    return findings(docs, ledger).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "blob")
