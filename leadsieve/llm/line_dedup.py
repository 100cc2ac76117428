"""Deletion of repeated runs of lines, by a suffix array over line IDs built with prefix doubling; DataFrame functions only.

The suffixes are those of all documents' line sequences, each known by its place: the document's number in order and the
line's in the document. Rank 0 orders them by their first line; a round joins each suffix's rank with the rank of the
suffix as many lines further on, sorts the pairs in ranges, and so orders suffixes by twice as many lines. Suffixes alone
in their rank share nothing and leave; rounds go on until no rank is shared. At each depth, suffixes of one rank are an
interval of the suffix array whose longest common prefix is at least that long. Neighbouring suffixes of a document whose
intervals begin at neighbouring places are one repeated run, as long as it can be: from the first of them to the last line
that the last of them shares. A run that has enough words goes, unless it is the first.

A document equal to an earlier one is a run as a whole and has no suffixes. Texts are stored once, in buckets by the task that
wrote them, and what goes comes to them, one map of row to parts for each of these tasks; no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadsieve.llm.common import bucketed, fingerprint, staged, whole
from leadsieve.operators.selection import spread_join, with_maybe, with_row_index

#: Words of a run.
RUN_WORDS = 8
#: A place is the document's number times this, and the number of the line.
LINES = 1 << 30
#: Spark numbers the rows of a task from its own number times 2^33. A map holds the parts of so many rows.
TASK_BITS, BLOCK_BITS = 33, 10


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """row, doc_id, text, print, n_lines, words, task (that wrote the row) of every document."""
    own = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    blanks = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    filled = F.length(F.regexp_replace("text", r"[^\n]+", "x")) - breaks  # lines that aren't empty
    return bucketed(own.select("row", "doc_id", "text", fingerprint("text").alias("print"), (breaks + 1).cast("long").alias("n_lines"),
                               (blanks + filled).alias("words"), F.shiftright("row", TASK_BITS).alias("task")), "texts", "task")


def _numbered(texts: DataFrame) -> DataFrame:
    """row, doc (the number in order of id, null ids last, rows with one id in order of the table), copy (of an earlier text)."""
    order = texts.select(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "print")
    numbers = staged(with_row_index(order, "no_id", "doc_id", "row", name="doc").select("row", "doc", "print"), "numbers")
    firsts = staged(numbers.groupBy("print").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")), "firsts")
    return staged(spread_join(numbers, firsts, "print", "row", "n").select(
        "row", "doc", (F.col("doc") > F.col("first")).alias("copy")), "order")


def _repeated(texts: DataFrame, order: DataFrame) -> DataFrame:
    """place, id (128 bits) and words of the lines that repeat, but for those of whole copies."""
    line = F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")
    words = F.when(F.col("line") == "", 0).otherwise(F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1)
    lines = texts.select("row", line).select("row", "pos", F.unhex(F.md5("line")).alias("id"), words.alias("words"))
    often = staged(lines.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "often")
    known = spread_join(with_maybe(lines, often, ["id"], "maybe").filter("maybe"), often, "id", "pos", "n")
    return known.join(order.filter("not copy"), "row").select((F.col("doc") * LINES + F.col("pos")).alias("place"), "id", "words")


def _shared(suffixes: DataFrame, key: F.Column, *order: str) -> DataFrame:
    """Suffixes whose order columns another suffix has too, with rank (in that order) and first (the earliest place)."""
    twice = suffixes.groupBy(*order).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).filter("n > 1")
    # Sorted in ranges, the numbers of rows grow in that order.
    ranks = staged(twice.repartitionByRange(*order).sortWithinPartitions(*order).select(
        key.alias("class"), "n", "first", F.monotonically_increasing_id().alias("rank")), "ranks")
    # One line may be a third of all: its suffixes are dealt over many tasks.
    return spread_join(suffixes.select("place", key.alias("class")), ranks, "class", "place", "n").select("place", "rank", "first")


def _doubled(suffixes: DataFrame, lines: int) -> DataFrame:
    """Suffixes that go on with a shared one so many lines further on, with its rank as beyond. Places are unique."""
    ahead = suffixes.select((F.col("place") - lines).alias("place"), F.col("rank").alias("beyond"))
    return suffixes.select("place", F.col("rank").alias("own")).join(ahead, "place")


def _runs(suffixes: DataFrame, lines: int) -> DataFrame:
    """begin, end (places, end excluded) of the runs that occur earlier."""
    later = suffixes.filter("place > first").withColumns(
        {"doc": F.floor(F.col("place") / LINES), "back": F.col("place") - F.col("first")})
    order = Window.partitionBy("doc", "back").orderBy("place")
    return later.withColumn("run", F.col("place") - F.row_number().over(order)).groupBy("doc", "back", "run").agg(
        F.min("place").alias("begin"), (F.max("place") + lines).alias("end")).select("begin", "end")


def repeated_runs(lines: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """doc and gone: the parts of its lines that repeat earlier ones, as (begin, end) in order, apart from each other."""
    lines = staged(lines, "lines")
    suffixes = staged(_shared(lines, F.col("id"), "id"), "suffixes")
    runs, depth = _runs(suffixes, 1), 1
    while True:
        pairs = staged(_doubled(suffixes, depth), "pairs")
        suffixes = staged(_shared(pairs, F.struct("own", "beyond"), "own", "beyond"), "suffixes")
        if suffixes.isEmpty():
            break
        depth *= 2
        runs = runs.union(_runs(suffixes, depth))
    # Words of a document's repeated lines up to each one; those of a run are all among them.
    so_far = Window.partitionBy(F.floor(F.col("place") / LINES)).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    upto = lines.select("place", F.sum("words").over(so_far).alias("upto"), "words")
    begins = upto.select(F.col("place").alias("begin"), (F.col("upto") - F.col("words")).alias("before"))
    ends = upto.select((F.col("place") + 1).alias("end"), "upto")
    fit = runs.distinct().join(begins, "begin").join(ends, "end").filter(F.col("upto") - F.col("before") >= run_words).select(
        F.floor(F.col("begin") / LINES).alias("doc"), "begin", "end")
    order = Window.partitionBy("doc").orderBy("begin", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = fit.withColumn("fresh", F.when(F.col("begin") <= reached, 0).otherwise(1))
    parts = parts.withColumn("part", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    line = lambda place: (place - F.col("doc") * LINES).cast("int")
    return parts.groupBy("doc", "part").agg(line(F.min("begin")).alias("begin"), line(F.max("end")).alias("end")).groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("gone"))  # of one document


def _block() -> F.Column:
    return F.shiftright(F.col("row").bitwiseAND(F.lit((1 << TASK_BITS) - 1)), BLOCK_BITS)


def _by_task(gone: DataFrame) -> DataFrame:
    """task and blocks: maps of block to map of row to gone. A task's rows bound what meets here."""
    entries = gone.groupBy(F.shiftright("row", TASK_BITS).alias("task"), _block().alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct("row", "gone"))).alias("rows"))
    return entries.groupBy("task").agg(F.map_from_entries(F.collect_list(F.struct("block", "rows"))).alias("blocks"))


def deduplicate_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run_words: int = RUN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_deleted, text (what stays).

    A line goes if it belongs to a run of lines that occurs earlier too (in a document of smaller id, or further up) and
    has run_words words at least. Runs are found at every depth of a power of two: neighbouring suffixes, each of which
    shares so many lines with an earlier one, and whose first occurrences are neighbours as well; a document equal to an
    earlier one is a run as a whole. The first occurrence of a run always stays. Documents come in order of id, null ids
    last; rows with one id in order of the table. Null text is empty text, one line; empty lines count as lines, with no
    words. Repeated rows are whole copies. Columns besides the two are ignored. An empty table gives no rows.
    """
    texts = _texts(docs, doc_id, text)
    order = _numbered(texts)
    gone = staged(repeated_runs(_repeated(texts, order), run_words).join(order, "doc").select("row", "gone"), "gone")
    copies = order.filter("copy").join(texts.filter(F.col("words") >= run_words).select("row", "n_lines"), "row").select(
        "row", F.array(F.struct(F.lit(0).alias("begin"), F.col("n_lines").cast("int").alias("end"))).alias("gone"))
    marks = _by_task(gone.union(copies))
    own = texts.select("task", "row", "doc_id", "n_lines", "text").join(marks.hint("shuffle_hash"), "task", "left").select(
        "doc_id", "n_lines", "text", F.try_element_at(F.try_element_at("blocks", _block()), F.col("row")).alias("gone"))
    # What stays lies between the parts that go; so each line is copied once.
    begin = F.concat(F.array(F.lit(0)), F.col("gone.end"))
    end = F.concat(F.col("gone.begin"), F.array(F.size("lines")))
    spans = F.filter(F.zip_with(begin, end, lambda a, b: F.struct(a.alias("at"), (b - a).alias("n"))), lambda s: s["n"] > 0)
    kept = F.flatten(F.transform(spans, lambda s: F.slice("lines", s["at"] + 1, s["n"])))
    lost = F.coalesce(F.aggregate("gone", F.lit(0), lambda n, g: n + g["end"] - g["begin"]), F.lit(0)).cast("long")
    told = own.withColumn("n_deleted", lost)
    # Only a text that loses a part and keeps one is split, once.
    cut = F.col("n_deleted").between(1, F.col("n_lines") - 1)
    told = told.withColumn("lines", F.when(cut, F.split("text", "\n", -1)))
    text = F.when(F.col("n_deleted") == 0, F.col("text")).when(F.col("n_deleted") == F.col("n_lines"), "").otherwise(
        F.array_join(kept, "\n"))
    return told.select("doc_id", "n_lines", "n_deleted", text.alias("text"))
