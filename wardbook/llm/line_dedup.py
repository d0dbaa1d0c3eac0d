"""Line deduplication by overlapping three-line windows (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardbook.llm.common import run_folder, stored


def _windows(lines: Column, size: int) -> Column:
    """(place, two 64-bit hashes) of every run of ``size`` lines; fewer lines have none."""
    def digest(i):
        run = F.slice(lines, i + 1, size)
        # The second hash reads the lines after a mark, so the two are independent: 128 bits in all.
        return F.struct(i.alias("place"), F.xxhash64(run).alias("h1"), F.xxhash64(F.lit("window"), run).alias("h2"))

    return F.when(F.size(lines) >= size, F.transform(F.sequence(F.lit(0), F.size(lines) - size), digest))


def remove_repeated_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 3,
    folder: str | None = None,
) -> DataFrame:
    """Documents without lines that belong to a repeated window of ``window`` lines.

    Lines end at ``\\n``. A window is repeated if the same lines in a row begin anywhere
    before it, in order of (id, place); the first occurrence of each stays. Overlapping
    repeated windows cover one stretch, and every covered line goes; coverage is judged on
    the input, so a window may begin inside another. Returns all input columns with the
    new text, plus ``n_lines`` and ``n_removed``.

    Null text stays null with no lines; empty text has one empty line. Documents of fewer
    lines than a window are untouched. Rows with null id take no part and stay as they
    are. Rows that share an id are one document in as far as lines go: a window at the
    same place of the same id is one occurrence, so repeated rows are treated alike.
    An empty table gives no rows. The added columns replace input columns of that name.

    Windows are hashed where the documents are read. Repeated ones come from an aggregate
    that combines before its shuffle; joining it back is a plain equi-join whose window
    side is split at run time where a window is hot. What is gathered per document is the
    list of its own removed places.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "line-dedup")
    # Split in a step of its own: inside a lambda it would run once per element.
    windows = stored(
        docs.filter(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("id"), F.split(text_col, "\n", -1).alias("lines"))
        .select("id", F.explode(_windows(F.col("lines"), window)).alias("w"))
        .select("id", "w.place", "w.h1", "w.h2"),
        f"{folder}/windows",
    )
    first = (
        windows.groupBy("h1", "h2")
        .agg(F.min(F.struct("id", "place")).alias("first"), F.max(F.struct("id", "place")).alias("last"))
        .filter("first <> last")
        .select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), "first")
    )
    # Stored, so that the join reads plain shuffles and splits a hot window.
    first = stored(first, f"{folder}/first")
    later = windows.join(first, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2"))).filter(
        F.struct("id", "place") != F.col("first")
    )
    gone = (
        later.groupBy(F.col("id").alias("_id"))
        .agg(F.collect_set("place").alias("starts"))
        .select(
            "_id",
            F.array_distinct(
                F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (window - 1))))
            ).alias("_gone"),
        )
    )
    # Lists of removed lines grow with the corpus: the join is shuffled at every size, never broadcast.
    gone = stored(gone, f"{folder}/gone").hint("merge")
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    joined = docs.join(gone, F.col(id_col) == F.col("_id"), "left").select(
        *others, "_gone", F.split(text_col, "\n", -1).alias("_lines")
    )
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size("_lines")).cast("bigint")
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    kept = F.array_join(F.transform(places, lambda i: F.get("_lines", i)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(kept)
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in others],
        n_lines.alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_removed"),
    )
