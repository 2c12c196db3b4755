"""Date layouts of files by evidence (B1): what the cells of a column look like, and whether days stand first.

The per-value rule of ``functions.dates`` reads ``3/4/2024`` as 4 March everywhere. A file that also holds ``13/4/2024``
says that its days come first; here that evidence is gathered per file and column, whatever the order
of rows, and applied to all cells of the file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.functions.dates import parse_datetime
from deskmart.functions.text import present, strip
from deskmart.schemas import DATE_COLUMNS

SOURCE_FILE = "_source_file"
# Two numbers of one or two digits and a year, with one separator
_TWO_FIRST = r"^(\d{1,2})([/.-])(\d{1,2})\2(?=\d{2}(?:\d{2})?(?!\d))"
# What stands for letters and for numbers of 1-2, 4 and other lengths in a mask
_MASKS = ((r"\p{L}+", "a"), (r"(?<!\d)\d{1,2}(?!\d)", "n"), (r"(?<!\d)\d{4}(?!\d)", "y"), (r"\d+", "d"))


def mask_of(text: Column) -> Column:
    """The shape of a cell: ``12/03/2024 9:14 pm`` is ``n/n/y n:n a``."""
    for pattern, letter in _MASKS:
        # digits are masked last, so that letters put in their place are not masked again
        text = F.regexp_replace(text, pattern, letter)
    return text


def date_masks(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per file, date column and mask: n, separator, largest first and second number (where two short
    numbers come first), and how many cells the per-value rule cannot read. One scan; tasks count ahead of
    the shuffle."""
    columns = [c for c in columns or DATE_COLUMNS if c in df.columns]
    cells = (df.select(SOURCE_FILE, *(strip(F.when(present(c), F.col(c))).alias(c) for c in columns))
             .unpivot([SOURCE_FILE], columns, "column_name", "value").where("value <> ''"))
    value = F.col("value")
    number = lambda i: F.regexp_extract(value, _TWO_FIRST, i).try_cast("int")
    return cells.select(
        SOURCE_FILE, "column_name", mask_of(value).alias("mask"), F.regexp_extract(value, _TWO_FIRST, 2).alias("separator"),
        number(1).alias("one"), number(3).alias("two"), parse_datetime(value).isNull().alias("unread")
    ).groupBy(SOURCE_FILE, "column_name", "mask", "separator").agg(
        F.count(F.lit(1)).alias("n"), F.max("one").alias("first_number"), F.max("two").alias("second_number"),
        F.count_if("unread").alias("unread"))


def choose_layouts(masks: DataFrame) -> DataFrame:
    """Per file, column and separator whose cells begin with two short numbers: n, ``first`` (day or month) and ``evidence``.

    A first number above 12 anywhere in the column says that days come first, a second one above 12 that months do
    (``certain``). Neither leaves the column ``ambiguous``, read month first; both make it ``mixed``, read value
    by value. All masks with the same separator count together, with or without a time of day.
    """
    day, month = F.col("first_number") > 12, F.col("second_number") > 12
    return (masks.where("separator <> ''").groupBy(SOURCE_FILE, "column_name", "separator")
            .agg(F.sum("n").alias("n"), F.max("first_number").alias("first_number"), F.max("second_number").alias("second_number"))
            .select(SOURCE_FILE, "column_name", "separator", "n", F.when(day & ~month, "day").otherwise("month").alias("first"),
                    F.when(day & month, "mixed").when(day | month, "certain").otherwise("ambiguous").alias("evidence")))


def apply_layouts(df: DataFrame, layouts: DataFrame) -> DataFrame:
    """``df`` with the cells of columns whose order is certain rewritten as month/day/year, which the per-value rule reads
    so, also where it takes no such separator before a year of two digits.

    Files with such columns are joined by name; the join is broadcast by measured size only.
    """
    columns = [c for c in DATE_COLUMNS if c in df.columns]
    chosen = (layouts.where("evidence = 'certain'").groupBy(F.col(SOURCE_FILE).alias("_layout_of"))
              .agg(F.collect_set(F.concat_ws(" ", "column_name", "separator", "first")).alias("_orders")))

    def rewritten(name: str) -> Column:
        text = strip(F.col(name))
        separator = F.regexp_extract(text, _TWO_FIRST, 2)

        def known(first: str) -> Column:
            return F.coalesce(F.array_contains("_orders", F.concat_ws(" ", F.lit(name), separator, F.lit(first))), F.lit(False))

        return (F.when(known("day"), F.regexp_replace(text, _TWO_FIRST, "$3/$1/"))
                .when(known("month"), F.regexp_replace(text, _TWO_FIRST, "$1/$3/")).otherwise(F.col(name)))

    return (df.join(chosen, F.col(SOURCE_FILE) == F.col("_layout_of"), "left")
            .withColumns({c: rewritten(c) for c in columns}).drop("_layout_of", "_orders"))
