"""Records of delimited text files, read in splits, whose quoted fields may hold line breaks.

A file is read once, as lines, by as many tasks as it has splits, and the lines are stored with their
split and place. Whether a line begins inside a quoted field depends on all lines before it. But seen
alone a line can do only one of four things: leave that as it is, end outside, end inside, or turn
it around. Such steps combine, whatever came before them: first within a split, then over the splits of a
file, as a prefix scan over one row per split. Only then are the lines of those records gathered that
break over several lines; all others stay where they were read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muster.session import shared_folder

# A record of more lines than this counts as a quote that was never closed.
MAX_RECORD_LINES = 10_000

# Fields of a line. A quoted field ends at its first quote that is not doubled; what follows up to the
# separator belongs to it. The possessive loops neither go back nor nest, however long a field is.
_INNER = r'[^"]*+(?:""[^"]*+)*+'
QUOTED = rf'"{_INNER}"'
_FIELD = rf'(?:{QUOTED}[^|]*+|[^"|][^|]*+|)\|'
OPEN = rf'^(?:{_FIELD})*+"{_INNER}$'
# The same for a line that begins inside quotes. There a separator or the end of the line follows the quote
# that closes; a quote in any other place shows that what seemed to be open was not.
_STAYS = rf'^{_INNER}(?:"\|(?:{_FIELD})*+"{_INNER})?+$'
_STRAY = rf'^{_INNER}"[^|]'

# What a line does to being inside quotes.
KEEPS, ENDS_OUTSIDE, ENDS_INSIDE, TURNS = range(4)


def _step(line: Column) -> Column:
    from_outside = line.rlike(OPEN)
    from_inside = F.when(line.rlike(_STRAY), from_outside).otherwise(line.rlike(_STAYS))
    return (
        F.when(~line.contains('"') | (~from_outside & from_inside), KEEPS)
        .when(from_outside & from_inside, ENDS_INSIDE)
        .when(from_outside, TURNS)
        .otherwise(ENDS_OUTSIDE)
        .cast("byte")
    )


def file_name() -> Column:
    """Listed names are URL-encoded, except that a plus sign stands for itself."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared scratch folder and read back."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_lines(spark: SparkSession, path: str, glob: str, recursive: bool, **storage: str) -> DataFrame:
    """``path, file, block, place, line, step, fresh`` of every line of the matching files, as a stored table.

    ``block`` is where the line's split begins, ``place`` rises within it; a ``fresh`` line begins a record
    even where quotes seemed to be open. Later steps read this table and
    not the files, so they all see the same splits, and only the columns that they need.
    """
    lines = (
        spark.read.options(pathGlobFilter=glob, recursiveFileLookup=recursive, **storage)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            file_name().alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            F.col("value").alias("line"),
            _step(F.col("value")).alias("step"),
            F.col("value").rlike(_STRAY).alias("fresh"),
        )
    )
    return stored(lines, "lines")


def file_headers(lines: DataFrame) -> DataFrame:
    """``path, header, head`` of every file: its first line that is not blank, and the place of it."""
    heads = lines.filter((F.col("block") == 0) & (F.length(F.trim("line")) > 0))
    first = F.min(F.struct("place", "line"))
    return heads.groupBy("path").agg(first.alias("first")).select("path", "first.line", "first.place").toDF(
        "path", "header", "head"
    )


def _scanned(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds what the steps of a group have come to at each row, in order: ``fixed`` and ``state``.

    ``fixed`` is whether some step up to the row ends inside or outside whatever came before, and then
    ``state`` is what holds; otherwise ``state`` tells whether an odd number of steps has turned around.
    """
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.col("step")
    turned = rows.withColumn("_turns", F.sum(F.when(step == TURNS, 1).otherwise(0)).over(window))
    # A fixing step remembers what it sets, together with the count of turns at that point.
    sets = F.when(step.isin(ENDS_OUTSIDE, ENDS_INSIDE), F.col("_turns") + (step == ENDS_INSIDE).cast("int"))
    last = F.last(sets, ignorenulls=True).over(window)
    return turned.select(
        *rows.columns,
        last.isNotNull().alias("fixed"),
        F.pmod(F.col("_turns") + F.coalesce(last, F.lit(0)), F.lit(2)).alias("state"),
    )


def _after(before: Column) -> Column:
    """1 if a scanned row ends inside quotes, when ``before`` tells it for the place before the first."""
    return F.when(F.col("fixed"), F.col("state")).otherwise(F.pmod(before + F.col("state"), F.lit(2)))


def _open_blocks(lines: DataFrame) -> DataFrame:
    """``path, block, before, since`` of the splits that a record with line breaks touches.

    ``before`` is 1 if a split begins inside quotes, and ``since`` then is where they opened. Lines that
    keep the state are not looked at, and only files in which some line can open a quote.
    """
    opening = lines.filter(F.col("step").isin(ENDS_INSIDE, TURNS)).select("path").distinct()
    marks = lines.filter(F.col("step") != KEEPS).select("path", "block", "place", "step", "fresh")
    scanned = _scanned(marks.join(opening, "path", "left_semi"), ["path", "block"], ["place"])
    # The step of a whole split: what its last mark has come to.
    whole = (
        F.when(~F.col("fixed"), F.when(F.col("state") == 1, TURNS).otherwise(KEEPS))
        .when(F.col("state") == 1, ENDS_INSIDE)
        .otherwise(ENDS_OUTSIDE)
    )
    # The last mark that opens quotes, for either state before the split.
    order = Window.partitionBy("path", "block").orderBy("place")
    openers = []
    for before in (0, 1):
        inside = F.coalesce(F.lag(_after(F.lit(before))).over(order), F.lit(before))
        openers.append(F.when((F.col("fresh") | (inside == 0)) & (_after(F.lit(before)) == 1), F.col("place")))
    scanned = scanned.select("*", *(o.alias(f"opener{n}") for n, o in enumerate(openers)))
    ends = scanned.groupBy("path", "block").agg(
        F.max_by(whole, "place").alias("step"), F.max("opener0").alias("opener0"), F.max("opener1").alias("opener1")
    )
    blocks = lines.select("path", "block").distinct().join(opening, "path", "left_semi")
    blocks = blocks.join(ends, ["path", "block"], "left").fillna({"step": KEEPS})
    order = Window.partitionBy("path").orderBy("block")
    chained = _scanned(blocks, ["path"], ["block"]).withColumn("after", _after(F.lit(0)))
    chained = chained.withColumn("before", F.coalesce(F.lag("after").over(order), F.lit(0)))
    opener = F.when(F.col("before") == 0, F.col("opener0")).otherwise(F.col("opener1"))
    chained = chained.withColumn("opener", opener)
    # The last opener of a split has opened the quotes that are open at its end.
    still = F.when((F.col("after") == 1) & F.col("opener").isNotNull(), F.struct("block", "opener"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    since = F.last(still, ignorenulls=True).over(earlier).alias("since")
    return chained.select("path", "block", "before", since, F.col("opener").isNotNull().alias("opens")).filter(
        "before = 1 or opens"
    )


def records(lines: DataFrame, headers: DataFrame, max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """``path, file, line`` of all records but headers; ``line`` of a record with line breaks is all of it.

    Blank lines outside quotes are left out. A quote that nothing closes, or not within ``max_lines``
    lines, or that meets a stray one first, opens nothing: its lines are records by themselves.

    Splits that no broken record touches are read as they are; the lines of the others are dealt by split
    and put in order, so a file of any size is the work of many tasks, and a record of ``max_lines`` lines
    at most that of one.
    """
    quoted = headers.filter(F.col("header").contains('"'))
    if not quoted.isEmpty():
        # A header is a line, whatever its quotes.
        heads = quoted.select("path", F.col("head").alias("_head"))
        lines = lines.join(heads, "path", "left").withColumn(
            "step", F.when(F.col("place") == F.col("_head"), ENDS_OUTSIDE).otherwise(F.col("step")).cast("byte")
        ).drop("_head")
    columns = ["path", "file", "line"]
    if lines.filter(F.col("step").isin(ENDS_INSIDE, TURNS)).isEmpty():
        return _without_headers(lines, headers).select(columns)
    touched = stored(_open_blocks(lines), "open-splits")
    ids = touched.select("path", "block")
    order = Window.partitionBy("path", "block").orderBy("place")
    inner = lines.join(touched, ["path", "block"])
    inner = _scanned(inner, ["path", "block"], ["place"]).withColumn("after", _after(F.col("before")))
    inside = F.coalesce(F.lag("after").over(order), F.col("before"))
    inner = inner.withColumn("inside", F.when(F.col("fresh"), 0).otherwise(inside))
    opener = F.when((F.col("inside") == 0) & (F.col("after") == 1), F.struct("block", F.col("place").alias("opener")))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    span = F.coalesce(F.last(opener, ignorenulls=True).over(so_far), F.col("since"))
    belongs = (F.col("inside") == 1) | (F.col("after") == 1)
    inner = inner.withColumn("span", F.when(belongs, span))
    inner = stored(inner.select("path", "file", "block", "place", "line", "span", "after"), "open-lines")
    parts = inner.filter("span is not null")
    sizes = parts.groupBy("path", "span").agg(
        F.count(F.lit(1)).alias("lines"), F.min("after").alias("open")
    )
    # Stored, so that adaptive execution can split the join for a span of very many lines.
    sound = stored(sizes.filter((F.col("open") == 0) & (F.col("lines") <= max_lines)).select("path", "span"), "spans")
    ordered = F.array_sort(F.collect_list(F.struct("block", "place", "line")))
    joined = (
        parts.join(sound, ["path", "span"], "left_semi")
        .groupBy("path", "span")
        .agg(F.first("file").alias("file"), F.array_join(F.transform(ordered, lambda x: x.line), "\n").alias("line"))
    )
    single = lines.join(ids, ["path", "block"], "left_anti").select("path", "file", "block", "place", "line")
    loose = inner.filter("span is null").unionByName(parts.join(sound, ["path", "span"], "left_anti"))
    single = single.unionByName(loose.select(single.columns))
    return _without_headers(single, headers).select(columns).unionByName(joined.select(columns))


def _without_headers(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Without each file's header, and without blank lines.

    Only lines of first splits that read like some header are compared with their file's own, so the
    other lines need not meet the list of files.
    """
    lines = lines.filter(F.length(F.trim("line")) > 0)
    layouts = [r.header for r in headers.select("header").distinct().collect()]
    like = (F.col("block") == 0) & F.col("line").isin(layouts)
    heads = headers.select("path", F.col("head").alias("place"))
    return lines.filter(~like).unionByName(lines.filter(like).join(heads, ["path", "place"], "left_anti"))
