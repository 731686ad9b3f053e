"""Deletion of repeated runs of lines, by prefix doubling over line-id sequences.

Each document is its sequence of non-blank lines. Ranks of windows of 1, 2, 4, ... lines
come from doubling: a window of 2w lines is named by the names of its two halves, and
the name of a class of equal windows is the position of its first member. These are the
suffix array's intervals of common-prefix length w or more. A window that occurs once
is in no repeated run, nor is any window that contains it, so each level keeps repeated
windows only and the sequences shrink fast.

A run counts when it has at least MIN_WORDS words. From each position the shortest such
window forwards, and backwards, is named by two overlapping windows of the largest power
of two (equal names: one interval of the suffix array at that depth). A window that is
not the first of its class is a later copy, and its lines are deleted, other than those
of the first itself where the two overlap; together these windows cover exactly the
maximal runs of at least MIN_WORDS words that occur earlier.

The array of sorted suffixes itself is never laid out: an interval of it at a depth of w
lines is the class of equal windows of w lines, which is all that deletion asks of it.
As a line has a word at least, depths beyond MIN_WORDS lines are not needed, and levels
end there.

Everything is DataFrame operations. Groupings use partial aggregation (count and least
position), and joins on a hot line or window are split by AQE. Windows partition by
document only.

Order of positions: doc_id (null first), the text's hash, line. Defined results: a null
text stays null, an empty one empty; rows of one id and text are one document and get
the same result; very long texts are handled whole, and many equal lines cost their
number; an empty table gives no rows; all columns and their order are kept, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.session import table, written

MIN_WORDS = 50
SPACE = r"[\x20\x09-\x0D]+"


def _tie(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def sequences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, tie, seq, idx, line, chars, words): the non-blank lines of each document.

    seq counts non-blank lines, idx all; line is a 64-bit hash, told apart by chars too.
    """
    lines = docs.select(F.col(doc_id).alias("d"), _tie(text).alias("tie"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("idx", "line"))
    words = F.size(F.split(F.regexp_replace("line", rf"^{SPACE}|{SPACE}$", ""), SPACE)).cast("long")
    seen = lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select("d", "tie", "idx", F.xxhash64("line").alias("line"), F.length("line").alias("chars"), words.alias("words"))
    order = Window.partitionBy("d", "tie").orderBy("idx")
    return seen.withColumn("seq", F.dense_rank().over(order).cast("long"))


def _named(windows: DataFrame, by: list[str]) -> DataFrame:
    """Repeated windows (d, tie, seq) with name: the first position of their class."""
    keyed = windows.withColumn("at", F.struct("d", "tie", "seq"))
    classes = keyed.groupBy(*by).agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first <> last")
    return keyed.join(classes, by).select("d", "tie", "seq", F.col("first").alias("name"))


def doubled(lines: DataFrame, levels: int) -> list[DataFrame]:
    """For j = 0, 1, ...: (d, tie, seq, name) of the repeated windows of 2**j lines."""
    # every level is a function of the one before; each is written once
    now = written(_named(lines.select("d", "tie", "seq", "line", "chars").distinct(), ["line", "chars"]), "rank")
    out = [now]
    for j in range(1, levels):
        step = 1 << (j - 1)
        if not now.head(1):
            break
        order = Window.partitionBy("d", "tie").orderBy("seq")
        halves = now.withColumn("right", F.lead("name", step).over(order)).withColumn("there", F.lead("seq", step).over(order))
        halves = halves.where(F.col("there") == F.col("seq") + step).select("d", "tie", "seq", F.col("name").alias("left"), "right")
        now = written(_named(halves, ["left", "right"]), "rank")
        out.append(now)
    return out


def windows(lines: DataFrame, repeated: DataFrame, min_words: int) -> DataFrame:
    """(d, tie, seq, n): the shortest windows of repeated lines with min_words words that
    begin, or end, at each repeated line."""
    own = lines.select("d", "tie", "seq", "words").distinct()
    own = own.join(repeated.select("d", "tie", "seq"), [own["d"].eqNullSafe(repeated["d"]), own["tie"] == repeated["tie"], own["seq"] == repeated["seq"]], "left_semi")
    doc = Window.partitionBy("d", "tie").orderBy("seq")
    own = own.withColumn("segment", F.col("seq") - F.row_number().over(doc))
    part = Window.partitionBy("d", "tie", "segment")
    own = own.withColumn("upto", F.sum("words").over(part.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)))
    # forwards: the first line whose running sum reaches what the window needs; a wanted
    # sum sorts before the line that has it
    wanted = F.array(
        F.struct(F.col("upto").alias("sum"), F.lit(1).alias("kind"), F.col("seq").alias("line"), F.lit(None).cast("long").alias("start")),
        F.struct((F.col("upto") - F.col("words") + min_words).alias("sum"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("line"), F.col("seq").alias("start")),
    )
    rows = own.select("d", "tie", "segment", F.inline(wanted))
    # from the end, so that the frame only grows: one that shrinks is made anew for each row
    ahead = part.orderBy(*(F.desc(c) for c in ("sum", "kind", "line", "start"))).rowsBetween(Window.unboundedPreceding, 0)
    forward = rows.withColumn("end", F.min("line").over(ahead)).where("kind = 0 and end is not null").select("d", "tie", F.col("start").alias("seq"), (F.col("end") - F.col("start") + 1).alias("n"))
    # backwards: the last line from which the sum still reaches
    wanted = F.array(
        F.struct((F.col("upto") - F.col("words")).alias("sum"), F.lit(0).alias("kind"), F.col("seq").alias("line"), F.lit(None).cast("long").alias("end")),
        F.struct((F.col("upto") - min_words).alias("sum"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("line"), F.col("seq").alias("end")),
    )
    rows = own.select("d", "tie", "segment", F.inline(wanted))
    behind = part.orderBy("sum", "kind", "line", "end").rowsBetween(Window.unboundedPreceding, 0)
    backward = rows.withColumn("start", F.max("line").over(behind)).where("kind = 1 and start is not null").select("d", "tie", F.col("start").alias("seq"), (F.col("end") - F.col("start") + 1).alias("n"))
    return forward.unionByName(backward).distinct()


def later_copies(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, tie, seq, n): the lines, of windows of min_words words or more that occur
    earlier, that are not lines of that first occurrence."""
    levels = doubled(lines, max(1, min_words).bit_length())  # a line has a word at least
    wanted = windows(lines, levels[0], min_words)
    level = F.floor(F.log2(F.col("n").cast("double")) + 1e-9).cast("int")
    wanted = wanted.withColumn("level", level).withColumn("second", F.col("seq") + F.col("n") - F.expr("shiftleft(1L, level)"))
    ranks = None
    for j, r in enumerate(levels):
        r = r.withColumn("level", F.lit(j))
        ranks = r if ranks is None else ranks.unionByName(r)

    def name(of: DataFrame, at: str, to: str) -> DataFrame:
        r = ranks.select(F.col("d").alias("rd"), F.col("tie").alias("rt"), F.col("seq").alias("rs"), F.col("level").alias("rl"), F.col("name").alias(to))
        on = [F.col("d").eqNullSafe(F.col("rd")), F.col("tie") == F.col("rt"), F.col(at) == F.col("rs"), F.col("level") == F.col("rl")]
        return of.join(r, on).drop("rd", "rt", "rs", "rl")

    both = name(name(wanted, "seq", "one"), "second", "two").select("d", "tie", "seq", "n", "one", "two")
    at = F.struct("d", "tie", "seq")
    first = both.groupBy("one", "two", "n").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last").drop("last")
    later = both.join(first, ["one", "two", "n"]).where(at != F.col("first"))
    own = F.col("first.d").eqNullSafe(F.col("d")) & (F.col("first.tie") == F.col("tie"))
    start = F.when(own, F.greatest("seq", F.col("first.seq") + F.col("n"))).otherwise(F.col("seq"))
    return later.select("d", "tie", start.alias("seq"), (F.col("seq") + F.col("n") - start).alias("n"))


def deletions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(d, tie, cut, n_cut): the ranges of line indexes to delete, for documents with any."""
    lines = written(sequences(docs, doc_id, text), "lines")
    gone = later_copies(lines, min_words).select("d", "tie", F.explode(F.sequence(F.col("seq"), F.col("seq") + F.col("n") - 1)).alias("seq")).distinct()
    order = Window.partitionBy("d", "tie").orderBy("seq")
    runs = gone.withColumn("run", F.col("seq") - F.row_number().over(order)).groupBy("d", "tie", "run").agg(F.min("seq").alias("from"), F.max("seq").alias("to"))
    at = lines.select(F.col("d").alias("ld"), F.col("tie").alias("lt"), F.col("seq").alias("ls"), "idx").distinct()

    def index(of: DataFrame, seq: str) -> DataFrame:
        on = [F.col("d").eqNullSafe(F.col("ld")), F.col("tie") == F.col("lt"), F.col(seq) == F.col("ls")]
        return of.join(at, on).withColumn(f"{seq}_idx", F.col("idx")).drop("ld", "lt", "ls", "idx")

    found = index(index(runs, "from"), "to")
    return found.groupBy("d", "tie").agg(F.array_sort(F.collect_list(F.struct("from_idx", "to_idx"))).alias("cut"), F.sum(F.col("to") - F.col("from") + 1).alias("n_cut"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, counted: str | None = None) -> DataFrame:
    """docs with later copies cut from their texts; counted names a column for how many
    lines went."""
    cuts = deletions(docs, doc_id, text, min_words).select(F.col("d").alias("__d"), F.col("tie").alias("__tie"), F.col("cut").alias("__cut"), F.col("n_cut").alias("__n"))
    joined = docs.join(cuts, [F.col(doc_id).eqNullSafe(F.col("__d")), _tie(text) == F.col("__tie")], "left")
    kept = F.filter(F.split(F.col(text), "\n", -1), lambda _, i: ~F.exists("__cut", lambda c: i.between(c["from_idx"], c["to_idx"])))
    new = F.when(F.col("__cut").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    out = [new.alias(text) if c == text else F.col(c) for c in docs.columns]
    if counted:
        out.append(F.coalesce("__n", F.lit(0)).cast(T.LongType()).alias(counted))
    return joined.select(*out)


def op10_prefix_doubling(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents"), counted="n_cut_lines").select("doc_id", "n_cut_lines", "text")
