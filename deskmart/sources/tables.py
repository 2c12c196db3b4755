"""Written tables: raw tickets, the star as Parquet, the star as CSV."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deskmart.operators.fact import Star, build_star
from deskmart.schemas import FACT_SECONDS, RAW_TICKETS, STAR_TABLES
from deskmart.session import side_by_side

_TIME = "yyyy-MM-dd HH:mm:ss"
PARTITION = "created_month"

# Spark's CSV writer trims cells unless told not to.
CSV_OUT = {
    "header": True, "escape": '"', "timestampNTZFormat": _TIME,
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def write_raw(tickets: DataFrame, path: str) -> int:
    """Replace ``raw_tickets``; the row count is observed during the write itself."""
    seen = Observation("raw_tickets")
    tickets.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"]


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_TICKETS).parquet(path)


# Every rebuild is written to a folder of its own below VERSIONS. It becomes the current one by a row that is appended to
# COMMITS in one file, which appears whole or not at all; until then, readers see the one before.
VERSIONS, COMMITS = "versions", "commits"
_COMMIT = "number bigint, version string"


def _commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of all rebuilds that were finished, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    return sorted(tuple(r) for r in spark.read.schema(_COMMIT).parquet(f"{path}/{COMMITS}").collect())


def _commit(spark: SparkSession, path: str, version: str, keep: int) -> None:
    """Make ``version`` the current one, then remove the folders of all but the ``keep`` newest ones."""
    earlier = _commits(spark, path)
    row = spark.createDataFrame([(earlier[-1][0] + 1 if earlier else 1, version)], _COMMIT)
    row.coalesce(1).write.mode("append").parquet(f"{path}/{COMMITS}")
    files = spark._jvm.org.apache.hadoop.fs
    for _, old in earlier[:max(0, len(earlier) + 1 - keep)]:
        folder = files.Path(f"{path}/{VERSIONS}/{old}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def current(spark: SparkSession, path: str) -> str:
    """Folder of the last rebuild below ``path`` that was finished."""
    commits = _commits(spark, path)
    if not commits:
        raise FileNotFoundError(f"no finished rebuild in {path}")
    return f"{path}/{VERSIONS}/{commits[-1][1]}"


def _write_tables(star: Star, folder: str) -> None:
    """The six tables. The fact is partitioned by creation month, so date slicers read matching months only. The
    rebalance hint lets adaptive execution size the files and split a month that holds most rows."""
    month = (F.col("created_date_key") / 100).cast("int").alias(PARTITION)
    fact = star.fact.drop(PARTITION).select("*", month).hint("rebalance", PARTITION)
    jobs = [partial(fact.write.partitionBy(PARTITION).parquet, f"{folder}/fact_tickets")]
    jobs += [partial(table.write.parquet, f"{folder}/{name}")
             for name, table in star.tables().items() if name != "fact_tickets"]
    side_by_side(fact.sparkSession, jobs)


def write_star(star: Star, path: str, keep: int = 2) -> None:
    """Replace all six tables at once.

    Readers of ``path`` see the earlier star until every table of this one is written, also when the rebuild is
    interrupted. The ``keep`` newest rebuilds stay, so frames read from the one before remain valid; one
    rebuild of a path runs at a time.
    """
    version = uuid.uuid4().hex
    _write_tables(star, f"{path}/{VERSIONS}/{version}")
    _commit(star.fact.sparkSession, path, version, keep)


def read_star(spark: SparkSession, path: str, as_of: datetime) -> Star:
    """The current star of ``path``; its six tables are of one rebuild."""
    folder = current(spark, path)
    seconds = ", ".join(f"{c} bigint" for c in FACT_SECONDS)
    fact = spark.read.schema(
        f"{STAR_TABLES['fact_tickets'].simpleString()[7:-1].replace(':', ' ')}, {seconds}, "
        f"{PARTITION} int").parquet(f"{folder}/fact_tickets")
    dims = (spark.read.schema(STAR_TABLES[t]).parquet(f"{folder}/{t}")
            for t in ("dim_agent", "dim_category", "dim_channel", "dim_priority", "dim_calendar"))
    return Star(fact, *dims, as_of)


def read_tables(spark: SparkSession, path: str, as_of: datetime) -> tuple[DataFrame, Star]:
    """``raw_tickets`` and the star of the last finished build_tables of ``path``."""
    return read_raw(spark, f"{current(spark, path)}/raw_tickets"), read_star(spark, path, as_of)


# A record never spans lines, so exported files can be split: line breaks in text are written as
# backslash and n or r, and a backslash as two.
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))
_MARK = "\ufdd0"  # a Unicode noncharacter, in the place of a restored backslash


def _escaped(text: Column) -> Column:
    for plain, written in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def _restored(text: Column) -> Column:
    text = F.replace(text, F.lit(_ESCAPES[0][1]), F.lit(_MARK))
    for plain, written in _ESCAPES[1:]:
        text = F.replace(text, F.lit(written), F.lit(plain))
    return F.replace(text, F.lit(_MARK), F.lit("\\"))


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({name: change(F.col(name)) for name, kind in df.dtypes if kind == "string"})


def export_csv(star: Star, path: str) -> None:
    """One CSV folder per table, with header. Adaptive execution sizes the files of dimensions."""
    jobs = []
    for name, table in star.tables().items():
        out = _texts(table if name == "fact_tickets" else table.hint("rebalance"), _escaped)
        jobs.append(partial(out.write.mode("overwrite").options(**CSV_OUT).csv, f"{path}/{name}"))
    side_by_side(star.fact.sparkSession, jobs)


def read_csv_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A10: an exported table with its required types."""
    cells = (spark.read.schema(STAR_TABLES[table]).option("header", True).option("escape", '"')
             .option("timestampNTZFormat", _TIME).csv(f"{path}/{table}"))
    return _texts(cells, _restored)


def build_tables(tickets: DataFrame, path: str, as_of: datetime, keep: int = 2) -> tuple[DataFrame, Star]:
    """The whole build: write ``raw_tickets``, then the star from it; both come back as tables.

    Cleaning runs once. Five dimensions and the fact read the written columns they need, instead
    of parsing the source again, and a lost executor costs no more than its current tasks. All tables take effect
    together, as in write_star.
    """
    spark = tickets.sparkSession
    version = uuid.uuid4().hex
    folder = f"{path}/{VERSIONS}/{version}"
    write_raw(tickets, f"{folder}/raw_tickets")
    star = build_star(read_raw(spark, f"{folder}/raw_tickets"), as_of)
    _write_tables(star, folder)
    _commit(spark, path, version, keep)
    return read_tables(spark, path, as_of)
