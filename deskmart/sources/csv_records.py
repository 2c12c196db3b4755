"""Records of CSV files in which quoted cells hold line breaks, read in parallel.

Whether a line begins inside a quoted cell depends on everything before it. Each line maps the
state it begins in (inside or outside) to the state it ends in: it keeps it, swaps it, or ends in a
fixed state. Such maps compose, so the state at a line follows from a running composition inside its
file split, and from one over the splits of its file, which have one short row each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A quote is special at the beginning of a cell only; doubled ones inside stand for one.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CELL = f'(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?+'
ENDS_OPEN = rf'\A(?:{_CELL},)*+"{_INSIDE}\z'                        # for a line that begins outside
_STAYS_OPEN = rf'\A{_INSIDE}(?:"[^,]*+,(?:{_CELL},)*+"{_INSIDE})?+\z'  # for one that begins inside
# Unicode noncharacters stand for line breaks while a record is taken apart
_BREAKS, _MARKS = "\n\r", "﷐﷑"

_SPLIT = ("file", "start")
_ORDER = ("line", "part")


def glob_free(path: str) -> str:
    """A path whose characters mean themselves where a pattern is expected."""
    return "".join("\\" + c if c in "\\[]{}*?" else c for c in path)


def more_cells_than(record: Column, n: int) -> Column:
    """True for a record with more than ``n`` cells."""
    return record.rlike(rf"\A(?:{_CELL},){{{n}}}")


def cell_count(record: Column) -> Column:
    """Cells of a record that ends outside quotes."""
    quoted = F.regexp_count(record, F.lit(rf"\G{_CELL},"))
    plain = F.length(record) - F.length(F.replace(record, F.lit(","), F.lit("")))
    return F.when(record.contains('"'), quoted).otherwise(plain) + 1


def _lines(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str]) -> DataFrame:
    """Every line by (file, start, line, part) with its own line break: LF, CRLF or CR; and what it does to the state."""
    text = spark.read.options(**options).option("lineSep", "\n").text([glob_free(p) for p in paths]).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"), "value")
    crlf = F.col("value").endswith("\r")
    body = F.when(crlf, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    parts = F.split(body, "\r", -1)
    return (text.withColumn("last", F.size(parts) - 1).withColumn("crlf", crlf)
            .select(*_SPLIT, "line", "last", "crlf", F.posexplode(parts).alias("part", "text"))
            .withColumn("end", F.when(F.col("part") < F.col("last"), "\r").when(F.col("crlf"), "\r\n").otherwise("\n"))
            .drop("last", "crlf")
            .withColumns({"opens": F.col("text").rlike(ENDS_OPEN), "stays": F.col("text").rlike(_STAYS_OPEN)}))


def _running(df: DataFrame, window, fixed: Column, to: Column, swap: Column) -> DataFrame:
    """Adds ``swaps`` and ``known`` (to, at): the composition of all maps before a row. Its state is
    ``known.to``, swapped ``swaps - known.at`` times, or the state ahead, swapped ``swaps`` times."""
    df = df.withColumn("swaps", F.coalesce(F.sum(swap.cast("int")).over(window), F.lit(0)))
    return df.withColumn("known", F.last(
        F.when(fixed, F.struct(to.alias("to"), F.col("swaps").alias("at"))), ignorenulls=True).over(window))


def _state(ahead: Column) -> Column:
    known, swaps = F.col("known"), F.col("swaps")
    base = F.when(known.isNull(), ahead).otherwise(known["to"])
    times = F.when(known.isNull(), swaps).otherwise(swaps - known["at"])
    return base != (times % 2 == 1)


def _fixed() -> Column:
    return F.col("opens") == F.col("stays")


def _swap() -> Column:
    return F.col("opens") & ~F.col("stays")


def _ahead(splits: DataFrame) -> DataFrame:
    """Adds ``ahead``, the state in which a split begins, to one row per split (file, start, to, odd): the state that its
    last fixing line leads to, if it has one, and whether an odd number of swaps follows."""
    ends = F.col("to") != F.col("odd")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    found = _running(splits, earlier, F.col("to").isNotNull(), ends, F.col("to").isNull() & F.col("odd"))
    return found.withColumn("ahead", _state(F.lit(False))).drop("swaps", "known")


def _located(lines: DataFrame) -> DataFrame:
    """``lines`` with ``inside``: whether a line begins inside a quoted cell. Lines are shuffled by file split."""
    before = Window.partitionBy(*_SPLIT).orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    lines = _running(lines, before, _fixed(), F.col("opens"), _swap())
    last = F.max(F.when(_fixed(), F.struct(*_ORDER, F.col("opens").alias("to"), F.col("swaps").alias("at")))).alias("fix")
    splits = lines.groupBy(*_SPLIT).agg(F.sum(_swap().cast("int")).alias("total"), last).select(
        *_SPLIT, F.col("fix.to").alias("to"), ((F.col("total") - F.coalesce("fix.at", F.lit(0))) % 2 == 1).alias("odd"))
    # one row per file split, so the broadcast is bounded by the number of splits
    return lines.join(F.broadcast(_ahead(splits).select(*_SPLIT, "ahead")), list(_SPLIT)).withColumn(
        "inside", _state(F.col("ahead"))).drop("ahead", "swaps", "known", "opens", "stays")


def _begin(lines: DataFrame) -> DataFrame:
    """(file, begin): where the last record of each file begins."""
    return lines.where(~F.col("inside")).groupBy("file").agg(F.max(F.struct("start", *_ORDER)).alias("begin"))


def unclosed(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str] | None = None) -> DataFrame:
    """(file, number): the files that end inside a quoted cell, and the line, from 1, in which their last record begins.

    The state at the end of a file follows from two passes that move one row per file split: the last line of a split
    after which the state is known, and the swaps behind that line. Only lines of files that
    are broken are looked at again for the place.
    """
    lines = _lines(spark, paths, options or {})
    fix = lines.where(_fixed()).groupBy(*_SPLIT).agg(F.max(F.struct(*_ORDER, F.col("opens").alias("to"))).alias("fix"))
    behind = F.col("fix").isNull() | (F.struct(*_ORDER) > F.struct("fix.line", "fix.part"))
    # one row per file split, so the broadcast is bounded by the number of splits
    splits = (lines.join(F.broadcast(fix), list(_SPLIT), "left").groupBy(*_SPLIT)
              .agg(F.any_value("fix.to").alias("to"), (F.count_if(_swap() & behind) % 2 == 1).alias("odd")))
    ends = F.coalesce("to", "ahead") != F.col("odd")
    final = _ahead(splits).groupBy("file").agg(F.max_by(ends, "start").alias("open"))
    broken = final.where("open").select("file")
    found = _located(lines.join(F.broadcast(broken), "file", "left_semi"))
    upto = F.struct("start", *_ORDER) <= F.col("begin")
    return found.join(F.broadcast(_begin(found)), "file").groupBy("file").agg(F.count_if(upto).alias("number"))


def records(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str] | None = None,
            broken: Sequence[str] = ()) -> DataFrame:
    """(file, start, number, record): every record that is not blank, the header being number 1.

    ``start`` is the file split in which the record begins. Lines are shuffled by file split, whose
    size is bounded, and once more by record; no task reads a whole file. A quote that is never closed makes
    the rest of its file one record: the last record of the files of ``broken`` (see unclosed) is left out
    before records are put together. ``options`` go to the reader.
    """
    lines = _located(_lines(spark, paths, options or {}))
    if broken:
        theirs = lines.where(F.col("file").isin(*broken))
        lines = (lines.join(F.broadcast(_begin(theirs)), "file", "left")
                 .where(F.col("begin").isNull() | (F.struct("start", *_ORDER) < F.col("begin"))).drop("begin"))
    lines = lines.where(F.col("inside") | (F.trim(F.translate("text", "\t", " ")) != ""))
    begins = (~F.col("inside")).cast("int")
    upto = Window.partitionBy(*_SPLIT).orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.withColumn("own", F.sum(begins).over(upto))
    skipped = lines.groupBy(*_SPLIT).agg(F.sum(begins).alias("n")).select(
        *_SPLIT, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"))
    numbered = counted.join(F.broadcast(skipped), list(_SPLIT)).withColumn("number", F.col("skip") + F.col("own"))
    pieces = F.array_sort(F.collect_list(F.struct("start", *_ORDER, "text", "end"))).alias("pieces")
    joined = numbered.groupBy("file", "number").agg(pieces)
    text = F.concat_ws("", F.transform("pieces", lambda p, i: F.when(
        i == F.size("pieces") - 1, p["text"]).otherwise(F.concat(p["text"], p["end"]))))
    return joined.select("file", F.col("pieces")[0]["start"].alias("start"), "number", text.alias("record"))


def cells(record: Column, n: int) -> list[Column]:
    """The first ``n`` cells of a record, line breaks as they are."""
    layout = ", ".join(f"c{i} string" for i in range(n))
    parsed = F.from_csv(F.translate(record, _BREAKS, _MARKS), layout, {"escape": '"'})
    return [F.translate(parsed[f"c{i}"], _MARKS, _BREAKS) for i in range(n)]
