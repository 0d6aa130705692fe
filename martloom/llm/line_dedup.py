"""Line dedup by a suffix array over line-id sequences, DataFrame operations only.

Documents are sequences of lines. Only lines that occur more than once can
belong to a repeated run, so the others just end one. Suffixes of the
remaining runs are ordered by prefix doubling: a round's rank orders suffixes
by their first 2^k lines, and the pair (rank of i, rank of i + 2^k) orders
them by twice as many. Ranks come from a range-partitioned sort of the
distinct pairs, so no task sees all of them, and suffixes whose prefix has
become unique drop out.

Suffixes that share a prefix form an interval of the suffix array with that
longest common prefix. A run that is long enough is looked up as the interval
of its length (by the ranks of its first and its last 2^k lines); the run's
first place in the corpus stays, its later copies are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import WORD, checkpointed, text_or_empty, unused

MIN_WORDS = 10
BREAK = "\n"
FREQUENT = 1000   # a content with more than one in so many windows is spread
SALTS = 32


def _order_preserving(keys: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``keys`` (distinct rows) with increasing, not dense, numbers in their order."""
    ordered = keys.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return checkpointed(ordered.withColumn(name, F.monotonically_increasing_id()))


def row_key() -> Column:
    """A document's place in the corpus: by id, NULL last, then by a hash of its text."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                    F.xxhash64(text_or_empty()).alias("mark"))


def lines_of(docs: DataFrame) -> DataFrame:
    """One row a non-blank line: ``row``, its ``seat`` among them, ``at`` among all, hashes, ``words``."""
    lines = F.transform(F.split(F.col("text"), BREAK), lambda line, at: F.struct(
        at.alias("at"), F.xxhash64(line).alias("code"), F.hash(line).alias("check"),
        F.regexp_count(line, F.lit(WORD)).alias("words")))
    seated = docs.select("row", F.posexplode(F.filter(lines, lambda x: x["words"] > 0)).alias("seat", "line"))
    return seated.select("row", "seat", "line.*")


def windows_of(member: DataFrame, min_words: int) -> DataFrame:
    """Shortest windows of at least ``min_words`` words that begin or end at each line.

    ``member`` has ``row, run, place, words``; places are consecutive in a
    run. Every line has a word, so a window needs at most ``min_words`` lines.
    """
    run = Window.partitionBy("row", "run").orderBy("place")
    total = F.sum("words").over(run.rowsBetween(Window.unboundedPreceding, 0))
    before = F.col("total") - F.col("words")
    spans = member.withColumn("total", total).withColumn(
        "ends", F.collect_list("total").over(run.rowsBetween(0, min_words - 1))).withColumn(
        "starts", F.collect_list(before).over(run.rowsBetween(-(min_words - 1), 0)))
    ahead = F.array_position(F.transform("ends", lambda t: t - before >= min_words), True)
    back = F.array_position(F.reverse(F.transform("starts", lambda b: F.col("total") - b >= min_words)), True)
    sized = spans.select("row", "run", "place", ahead.cast("int").alias("ahead"), back.cast("int").alias("back"))
    both = F.array(F.struct(F.col("place").alias("place"), F.col("ahead").alias("length")),
                   F.struct((F.col("place") - F.col("back") + 1).alias("place"), F.col("back").alias("length")))
    return sized.select("row", "run", F.explode(both).alias("w")).select("row", "run", "w.*").filter(
        "length > 0").distinct()


def _later_copies(windows: DataFrame, first: DataFrame, total: int) -> DataFrame:
    """Windows that are not the ``first`` of their content, a frequent content spread over ``SALTS`` places.

    Fewer than ``FREQUENT`` contents can have more than ``total / FREQUENT``
    of ``total`` windows each: those, and no others, are broadcast.
    """
    content = ["length", "head", "tail"]
    often = F.col("n") > F.lit(total / FREQUENT)
    hot = F.broadcast(first.filter(often).select(*content, F.lit(True).alias("hot")))
    spread = first.withColumn("salt", F.explode(F.when(often, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("row", "place"), F.lit(SALTS)).cast("int")).otherwise(0)
    salted = windows.join(hot, content, "left").withColumn("salt", salt)
    return salted.join(spread.drop("n"), [*content, "salt"]).filter(F.struct("row", "place") > F.col("first"))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Lines to delete, as ``(row, at)`` pairs.

    ``docs`` has ``row`` (ordered, equal for equal documents only) and
    ``text``. A line goes if it lies in a run of consecutive non-blank lines
    of one document with at least ``min_words`` words that also stands earlier
    in the corpus (in a smaller row, or further up in the same one).
    """
    lines = checkpointed(lines_of(docs).repartition("row").dropDuplicates(["row", "seat"]))
    counts = lines.groupBy("code", "check").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    names = _order_preserving(counts.select("code", "check"), ["code", "check"], "rank")
    member = lines.join(names, ["code", "check"]).select("row", "at", "seat", "words", "rank")
    # lines that occur once break runs: seat less place is constant inside one
    member = member.withColumn("place", F.row_number().over(Window.partitionBy("row").orderBy("seat"))).withColumn(
        "run", F.col("seat") - F.col("place"))
    member = checkpointed(member.select("row", "run", "place", "at", "words", "rank"))
    windows = checkpointed(windows_of(member, min_words))

    total = windows.count()
    ranked, width, found = member.select("row", "run", "place", "rank"), 1, None
    longest = windows.agg(F.max("length")).first()[0] or 1
    while width <= longest:
        fits = windows.filter((F.col("length") >= width) & (F.col("length") < 2 * width))
        head = fits.join(ranked.withColumnRenamed("rank", "head"), ["row", "run", "place"])
        tail = ranked.select("row", "run", F.col("place").alias("last"), F.col("rank").alias("tail"))
        keyed = head.withColumn("last", F.col("place") + F.col("length") - width).join(
            tail, ["row", "run", "last"]).select("row", "run", "place", "length", "head", "tail")
        first = keyed.groupBy("length", "head", "tail").agg(
            F.min(F.struct("row", "place")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        later = _later_copies(keyed, first, total).select("row", "run", "place", "length")
        found = later if found is None else found.unionByName(later)
        if 2 * width <= longest:
            then = ranked.select("row", "run", (F.col("place") - width).alias("place"), F.col("rank").alias("then"))
            pairs = ranked.join(then, ["row", "run", "place"])
            shared = pairs.groupBy("rank", "then").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            named = _order_preserving(shared.select("rank", "then"), ["rank", "then"], "wider")
            ranked = checkpointed(pairs.join(named, ["rank", "then"]).select(
                "row", "run", "place", F.col("wider").alias("rank")))
        width *= 2
    covered = found.select("row", "run", F.explode(F.sequence(
        F.col("place"), F.col("place") + F.col("length") - 1)).alias("place")).distinct()
    return covered.join(member, ["row", "run", "place"]).select("row", "at")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``.

    All columns pass through; ``n_lines``, ``n_deleted`` and ``n_left`` (words)
    are appended (columns of those names are replaced). The corpus order is
    ``doc_id`` (NULL last), then a hash of the text; rows that repeat both are
    one document and are answered alike. NULL texts stay NULL with no line;
    an empty text is one blank line; an empty table gives no rows. Blank lines
    stay and do not break a run. Very long texts are read whole; of copies in
    one document the first stays. Other columns may have any name.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_deleted", "n_left")]
    row, gone = unused(names, "_row"), unused(names, "_gone")
    placed = docs.select(*names, row_key().alias(row))
    repeated = repeated_lines(placed.filter("text IS NOT NULL").select(F.col(row).alias("row"), "text"), min_words)
    cut = repeated.groupBy(F.col("row").alias(row)).agg(F.collect_set("at").alias(gone))
    joined = placed.join(cut, row, "left")
    lines = F.split(F.col("text"), BREAK)
    kept = F.array_join(F.filter(lines, lambda _, at: ~F.array_contains(gone, at)), BREAK)
    text = F.when(F.col(gone).isNotNull(), kept).otherwise(F.col("text"))
    out = joined.select(*[F.col(c) for c in names if c != "text"], text.alias("text"),
                        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
                        F.coalesce(F.size(gone), F.lit(0)).cast("bigint").alias("n_deleted"))
    return out.select(*names, "n_lines", "n_deleted",
                      F.regexp_count(text_or_empty(), F.lit(WORD)).cast("bigint").alias("n_left"))
