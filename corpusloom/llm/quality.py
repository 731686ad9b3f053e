"""Host-level quality rules.

Each document is measured once, in one pass over its whole text. RULES name what a
document can fail; the first two, BASE, reject it by themselves. Failures are summed by
host and rule (a few numbers for each host, combined on the map side, so a host with a
third of all rows costs no more than others). For every rule the hosts' rates get a beta
prior fitted by the method of moments: its mean is the corpus's rate, its strength comes
from how far hosts differ beyond what sampling alone explains. A host fails a rule when
its posterior rate is, three standard deviations down, still above both TIMES the
corpus's rate and LEAST_RATE; a host that fails a rule takes its documents with it.

Defined results: a null or empty text has zero words and fails; a null host is a host
of its own; repeated rows count each; very long texts are measured whole, one at a time;
an empty table gives an empty table; op9's measures need the columns named only, and
keep_documents carries all columns, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import words as W
from corpusloom.session import table, written

WINDOW, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: What a document fails, in SQL over MEASURES.
RULES = {
    "few_words": f"n_words < {LEAST_WORDS}",
    "repeats": f"100 * n_repeat_words > {REPEAT_PERCENT} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
}
BASE = ("few_words", "repeats")
#: A host's rate is held against this many times the corpus's, and against LEAST_RATE.
TIMES, LEAST_RATE, DEVIATIONS = 2.0, 0.2, 3.0
SYMBOLS = b"#*$%&|<>"
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_CONTINUATION = bytes(range(0x80, 0xC0))


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier one."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


def _repeated_words(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words of each text that stand in a window found twice or more in it."""
    h, owner = W.windows(words, counts, WINDOW)
    out = np.zeros(len(counts), np.int64)
    if not len(h):
        return out
    order = np.lexsort((h, owner))
    hs, os = h[order], owner[order]
    same = (hs[1:] == hs[:-1]) & (os[1:] == os[:-1])
    twice = np.zeros(len(h), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = order[twice]
    starts = np.concatenate([[0], np.cumsum(counts)])
    at = starts[owner[hit]] + (hit - np.searchsorted(owner, owner[hit]))
    mark = np.zeros(len(words) + 1, np.int64)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(mark[:-1]) > 0)])
    return covered[starts[1:]] - covered[starts[:-1]]


def _measured(texts: list[bytes], vocabulary: W.Words) -> list[pa.Array]:
    words, counts = W.hashed(texts, vocabulary, lower=False)
    bare = [b.translate(None, SPACE) for b in texts]
    lines = [_lines(b) for b in texts]
    columns = [
        counts,
        [len(b.translate(None, _CONTINUATION)) for b in bare],
        [len(b) - len(b.translate(None, SYMBOLS)) for b in bare],
        [x[1] for x in lines],
        _repeated_words(words, counts),
        [x[0] for x in lines],
    ]
    return [pa.array(c, pa.int64()) for c in columns]


def _pass(text: str, carried: bool):
    """Batches with a struct of MEASURES, named QUALITY, put behind their columns. carried:
    the text stays where the document passes the base rules, else it goes."""

    @W.trimming
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = W.Words()
        for batch in batches:
            at = batch.schema.names.index(text)
            plain = pa.RecordBatch.from_arrays([batch.column(at).cast(pa.binary())], names=[text])
            for first, texts in W.steps(plain, text):
                own = batch.slice(first, len(texts))
                found = _measured(texts, vocabulary)
                columns = dict(zip(own.schema.names, own.columns))
                if carried:
                    n, repeats = found[0].to_numpy(), found[4].to_numpy()
                    failed = (n < LEAST_WORDS) | (100 * repeats > REPEAT_PERCENT * n)
                    columns[text] = pa.array([None if f else b for f, b in zip(failed, texts)], pa.binary()).cast(columns[text].type)
                else:
                    del columns[text]
                columns[QUALITY] = pa.StructArray.from_arrays(found, names=list(MEASURES))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return measure


QUALITY = "__quality"
#: Rejected hosts of more bytes than this are not broadcast.
BROADCAST_BYTES = 8 << 20
_MEASURED = T.StructField(QUALITY, T.StructType([T.StructField(n, T.LongType()) for n in MEASURES]))


def document_measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, MEASURES, base_failed: one row for each document."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).alias("__text"))
    out = narrow.mapInArrow(_pass("__text", False), T.StructType([*narrow.schema.fields[:2], _MEASURED]))
    return out.select("doc_id", "host", f"{QUALITY}.*").withColumn("base_failed", _failed(BASE))


def _failed(rules) -> Column:
    return reduce(Column.__or__, (F.expr(RULES[r]) for r in rules))


def host_verdicts(measured: DataFrame) -> DataFrame:
    """(host, host_docs, failed_<rule>..., host_ok) of rows with host and MEASURES.

    One aggregated row, a few numbers for each rule, is all that reaches the driver.
    """
    counts = [F.count_if(F.expr(sql)).alias(f"failed_{r}") for r, sql in RULES.items()]
    hosts = measured.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"), *counts)
    n = F.col("host_docs")
    moments = [F.sum(f"failed_{r}").alias(f"f_{r}") for r in RULES]
    moments += [F.sum(F.col(f"failed_{r}").cast("double") * F.col(f"failed_{r}") / n).alias(f"s_{r}") for r in RULES]
    m = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("docs"), *moments).first()
    ok = F.lit(True)
    for r in RULES:
        mean, strength = 0.0, 1.0
        if m["docs"]:
            mean = m[f"f_{r}"] / m["docs"]
            # variance between hosts = weighted variance of rates - what sampling alone gives
            between = max(m[f"s_{r}"] / m["docs"] - mean * mean - mean * (1 - mean) * m["hosts"] / m["docs"], 1e-9)
            strength = max(1.0, min(1e6, mean * (1 - mean) / between - 1))
        rate = (F.col(f"failed_{r}") + mean * strength) / (n + strength)
        least = rate - DEVIATIONS * F.sqrt(rate * (1 - rate) / (n + strength + 1))
        ok = ok & (least <= max(TIMES * mean, LEAST_RATE))
    return hosts.withColumn("host_ok", ok)


def host_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row for each document: its measures, base_failed, its host's counts and kept."""
    measured = written(document_measures(docs, doc_id, text, host), "quality")
    verdicts = host_verdicts(measured)
    # a null host is matched too; the many documents of one host are split by AQE
    out = measured.join(verdicts, measured["host"].eqNullSafe(verdicts["host"]), "left").drop(verdicts["host"])
    return out.withColumn("kept", ~F.col("base_failed") & F.col("host_ok"))


def keep_documents(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass; all their columns as they were. Texts are read once, and
    what passes the base rules is written once; only hosts' counts are shuffled."""
    schema = T.StructType([*docs.schema.fields, _MEASURED])
    measured = written(docs.mapInArrow(_pass(text, True), schema), "quality")
    verdicts = host_verdicts(measured.select(F.col(f"`{host}`").cast("string").alias("host"), f"{QUALITY}.*"))
    gone = written(verdicts.where("not host_ok").select(F.col("host").alias("__host")), "hosts")
    if gone.agg(F.coalesce(F.sum(F.coalesce(F.length("__host"), F.lit(0)) + 32), F.lit(0))).first()[0] <= BROADCAST_BYTES:
        gone = F.broadcast(gone)  # counted; beyond it, a shuffle on the host
    passed = measured.where(~reduce(Column.__or__, (F.expr(_inside(RULES[r])) for r in BASE)))
    return passed.join(gone, F.col(f"`{host}`").cast("string").eqNullSafe(F.col("__host")), "left_anti").drop(QUALITY)


def _inside(sql: str) -> str:
    """A rule over the fields of QUALITY."""
    return re.sub(r"\bn_", f"{QUALITY}.n_", sql)


def op9_host_rules(spark, sf_dir):
    out = host_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *MEASURES, "base_failed", "kept")
