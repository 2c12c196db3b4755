"""Quality rules: lines that many documents of a host share, and documents that little else is left of."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import KEY, text_key, text_of, written
from deskmart.llm.textstats import text_stats

MIN_DOCS = 5          # a line in this many different texts of a host, or fewer, is never too frequent
MAX_SHARE = 0.02      # of the different texts of the host
MIN_LEFT = 0.5        # share of a document's words that must be left without its frequent lines
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_WORD = r"[^\x20\x09-\x0D]+"


def _host(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias("host")


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, host, key of the text and the BASE counts of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = text_stats(batch.column(4))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), *(pa.array(counts[n]) for n in BASE)],
                names=["doc_id", "host", *KEY, *BASE])

    schema = "doc_id long, host string, key_a long, key_b long, " + ", ".join(f"{n} long" for n in BASE)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "host", *text_key(),
                       text_of().alias("text")).mapInArrow(run, schema)


def normalised(line: Column) -> Column:
    """Small letters, every run of anything but letters and digits one blank, digits as 0."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "), r"\p{N}", "0"))


def line_table(docs: DataFrame) -> DataFrame:
    """One row per (host, text, line): hash of the normalised line and its words in all copies of the text."""
    raw = F.filter(F.split(text_of(), "\n"), lambda line: line.rlike(_WORD))
    lines = docs.select("host", *text_key(), F.explode(raw).alias("line"))
    line = normalised(F.col("line"))
    return (lines.select("host", *KEY, *_line_hashes(line), F.regexp_count(
        "line", F.lit(_WORD)).cast("long").alias("words"))
            .groupBy("host", *KEY, "line_a", "line_b").agg(F.sum("words").alias("words")))


def _line_hashes(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("line_a"), F.xxhash64(F.lit(3), line).alias("line_b")]


def frequent_lines(lines: DataFrame, texts: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """(host, line_a, line_b) of ``line_table`` rows in too many of the host's different ``texts`` (host, key)."""
    hosts = texts.groupBy("host").agg(F.count("*").alias("texts"))
    return written(
        lines.groupBy("host", "line_a", "line_b").agg(F.count("*").alias("docs"))
        .where(F.col("docs") > min_docs).join(hosts, "host")
        .where(F.col("docs") > max_share * F.col("texts"))
        .select("host", "line_a", "line_b"), "frequent")


def judge_documents(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS,
                    max_share: float = MAX_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """doc_id, host, the BASE counts, words_left, base_failed and kept of every row of ``docs``.

    A normalised line is too frequent on a host when more than ``min_docs`` different texts of the
    host hold it and these are more than ``max_share`` of its texts; copies of a text count once, so
    copying alone never condemns a document. ``words_left`` counts the words outside such lines; a
    document with less than ``min_left`` of its words left is depleted. ``base_failed`` holds for
    fewer than 50 words or more than half of the words in repeated triples.

    Counting shuffles hashes, first by (host, text, line), so a line that a third of all rows share
    is summed up in many tasks. Null texts count as empty, null hosts are one host, ids are only
    passed through; repeated rows are judged alike and all returned. Further columns are ignored, texts of any length
    are read whole, ties at a limit are within it, and an empty table gives no rows.
    """
    docs = docs.select("doc_id", _host(host), "text")
    counts = written(base_counts(docs), "counts")
    lines = written(line_table(docs), "lines")
    copies = counts.groupBy("host", *KEY).agg(F.count("*").alias("copies"))
    frequent = frequent_lines(lines, copies, min_docs, max_share)
    removed = (lines.join(frequent, ["host", "line_a", "line_b"])
               .groupBy("host", *KEY).agg(F.sum("words").alias("words")).join(copies, ["host", *KEY])
               .select("host", *KEY, (F.col("words") / F.col("copies")).cast("long").alias("_removed")))
    left = F.col("n_words") - F.coalesce("_removed", F.lit(0))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (counts.join(removed, ["host", *KEY], "left")
            .select("doc_id", "host", *BASE, left.cast("long").alias("words_left"),
                    failed.alias("base_failed"),
                    (~failed & (left >= min_left * F.col("n_words"))).alias("kept")))


def remove_frequent_lines(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS,
                          max_share: float = MAX_SHARE) -> DataFrame:
    """The rows of ``docs``, with all their columns, without the too frequent lines of their host in ``text``."""
    light = docs.select(_host(host), "text")
    lines = written(line_table(light), "lines")
    frequent = frequent_lines(lines, light.select("host", *text_key()).distinct(), min_docs, max_share)
    # a text's own frequent lines, no more than it has lines
    gone = written(lines.join(frequent, ["host", "line_a", "line_b"]).groupBy("host", *KEY)
                   .agg(F.collect_set(F.struct("line_a", "line_b")).alias("gone")), "gone")
    others = [F.col(f"row.{c}") for c in docs.columns]
    rows = (docs.select(F.struct(*docs.columns).alias("row"), _host(host), "text", *text_key())
            .join(gone, ["host", *KEY], "left"))
    left = F.filter(F.split(text_of(), "\n"), lambda line: ~F.array_contains("gone", F.struct(*_line_hashes(normalised(line)))))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return rows.withColumn("clean", text).select(*(
        F.col("clean").alias(c) if c == "text" else other for c, other in zip(docs.columns, others)))
