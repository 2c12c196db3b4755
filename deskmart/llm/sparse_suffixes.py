"""Suffix-array dedup: sparse suffixes at minimiser positions, compared with their neighbours and extended."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import KEY, text_key, text_of, written
from deskmart.llm.kernels import blocks, rows_of, windows, words

PASSAGE = 50  # words of the shortest passage
CHOICE = 26   # neighbouring positions of which one suffix is retained
GRAM = 8      # words whose hash decides which
SHARED = PASSAGE - CHOICE + 1  # words that two suffixes in one passage share at least


def minimisers(tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a block: rows and places (in the block) of retained suffixes, and for every word the retained
    place of the passage window that begins there, -1 where no window fits.

    Of CHOICE neighbouring positions the leftmost with the least hash of GRAM words is retained, so
    equal passages retain the same places.
    """
    n = len(tokens)
    of = np.full(n, -1, dtype=np.int64)
    rows = rows_of(at)
    if n < PASSAGE:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), of
    grams = windows(tokens, GRAM, 5)
    starts = np.flatnonzero(rows[:n - PASSAGE + 1] == rows[PASSAGE - 1:])
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), of
    # least of CHOICE neighbours in log steps; ties go to the left
    best, width = np.arange(len(grams)), 1
    while width < CHOICE:
        step = min(width, CHOICE - width)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(grams[right] < grams[left], right, left)
        width += step
    of[starts] = best[starts]
    places = np.unique(of[starts])
    return rows[places], places, of


def _suffix_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """One row per text: places of its retained suffixes, each with the hash of its SHARED first words."""
    for start, n, data, offsets in blocks(batch.column(batch.num_columns - 1)):
        tokens, at = words(data, offsets)
        rows, places, _ = minimisers(tokens, at)
        heads = windows(tokens, SHARED, 6)[places] if len(places) else np.zeros(0, np.uint64)
        ends = np.zeros(n + 1, dtype=np.int32)
        np.cumsum(np.bincount(rows, minlength=n), out=ends[1:])
        ends = pa.array(ends)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i).slice(start, n) for i in range(batch.num_columns - 1)), pa.array(np.diff(at)),
             pa.ListArray.from_arrays(ends, pa.array((places - at[rows]).astype(np.int32))),
             pa.ListArray.from_arrays(ends, pa.array(heads.astype(np.int64)))],
            names=[*batch.schema.names[:-1], "words", "places", "heads"])


def _window_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The passage windows around the suffixes ``places`` of each text, as start and two hashes."""
    for start, n, data, offsets in blocks(batch.column(batch.num_columns - 1)):
        tokens, at = words(data, offsets)
        _, _, of = minimisers(tokens, at)
        wanted = batch.column(batch.num_columns - 2).slice(start, n)
        flat = wanted.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(n), np.diff(wanted.offsets.to_numpy()))
        chosen = np.zeros(len(tokens) + 1, dtype=bool)
        chosen[flat + at[owner]] = True
        starts = np.flatnonzero((of >= 0) & chosen[of])
        rows = np.searchsorted(at, starts, side="right") - 1
        ends = np.zeros(n + 1, dtype=np.int32)
        np.cumsum(np.bincount(rows, minlength=n), out=ends[1:])
        ends = pa.array(ends)
        hashes = [windows(tokens, PASSAGE, salt)[starts].astype(np.int64) for salt in (7, 8)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i).slice(start, n) for i in range(batch.num_columns - 2)),
             pa.ListArray.from_arrays(ends, pa.array((starts - at[rows]).astype(np.int32))),
             *(pa.ListArray.from_arrays(ends, pa.array(h)) for h in hashes)],
            names=[*batch.schema.names[:-2], "starts", "one", "two"])


def _per_batch(make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from make(batch)
    return run


def repeated_windows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, words of every row; key, start, first_doc of every passage window that occurs at two places or in two texts).

    1. Retained suffixes are sorted into runs with equal first SHARED words; a run whose members stand in
    two texts or at two places of a text has equal neighbours. Sorting is an aggregate with map-side
    combine, so a passage in a third of all texts is no hot run. 2. The texts of such suffixes are read again, once per
    different text, and each suffix is extended left and right to all windows of PASSAGE words that
    retain it. 3. Windows that occur once are dropped, by 128-bit hashes. Every window of a shared
    passage retains a suffix whose SHARED words lie inside the passage, so none is missed.
    """
    rows = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(), text_of().alias("text"))
        .mapInArrow(_per_batch(_suffix_batch), "doc_id long, key_a long, key_b long, words long, places array<int>, heads array<long>"),
        "suffixes")
    suffixes = rows.select("key_a", "key_b", F.explode(F.arrays_zip("places", "heads")).alias("s")).select(*KEY, "s.places", "s.heads")
    two = lambda c: F.min(c) != F.max(c)
    runs = (suffixes.groupBy("heads").agg((two("key_a") | two("key_b") | two("places")).alias("several"))
            .where("several").select("heads"))
    again = (suffixes.join(runs, "heads").groupBy(*KEY).agg(F.collect_set("places").alias("wanted")))
    # one row of each text: the least id; ids may be null
    reps = rows.groupBy(*KEY).agg(F.min("doc_id").alias("rep_id"))
    wanted = written(again.join(reps, KEY), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(), text_of().alias("text"))
    w = wanted.select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), "rep_id", "wanted")
    chosen = texts.join(w.hint("shuffle_hash"), (F.col("key_a") == F.col("a")) & (F.col("key_b") == F.col("b"))
                        & F.col("doc_id").eqNullSafe(F.col("rep_id")))
    found = written(
        chosen.select("doc_id", *KEY, "wanted", "text").mapInArrow(
            _per_batch(_window_batch), "doc_id long, key_a long, key_b long, starts array<int>, one array<long>, two array<long>"),
        "windows")
    found = (found.select("doc_id", *KEY, F.explode(F.arrays_zip("starts", "one", "two")).alias("w"))
             .select("doc_id", *KEY, F.col("w.starts").alias("start"), "w.one", "w.two"))
    several = (found.groupBy("one", "two")
               .agg((two("key_a") | two("key_b") | two("start")).alias("several"), F.min("doc_id").alias("first_doc"))
               .where("several").select("one", "two", "first_doc"))
    return rows.select("doc_id", *KEY, "words"), found.join(several, ["one", "two"]).select(*KEY, "start", "first_doc")


def _passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of neighbouring windows become passages."""
    for batch in batches:
        out = []
        for a, b, found in zip(batch["key_a"], batch["key_b"], batch["found"]):
            starts = np.array([f["start"] for f in found])
            first = [f["first_doc"] for f in found]
            cuts = np.flatnonzero(np.diff(starts) > 1) + 1
            heads, tails = np.r_[0, cuts], np.r_[cuts, len(starts)] - 1
            spans = [(int(starts[h]), int(starts[t]) + PASSAGE, first[h]) for h, t in zip(heads, tails)]
            covered, reach = 0, 0
            for s, e, _ in spans:
                covered += e - max(s, reach)
                reach = e
            out.append((a, b, [{"start": s, "end": e, "first_doc": d} for s, e, d in spans], covered))
        yield pd.DataFrame(out, columns=["key_a", "key_b", "passages", "repeated_words"])


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, copies, words, repeated_words, passages of every row with a repeated passage.

    A passage is a longest run of words in which every window of PASSAGE words occurs elsewhere too:
    in another text, or at another place of the same one; start and end are word numbers, end
    exclusive. ``first_doc`` is the least doc_id whose text holds the passage's first window, so a
    passage with another first_doc than the row's class is a repeat. Equal texts are one class, named
    after its least doc_id; if it has two rows or more and PASSAGE words, the whole text is one passage.

    Words are runs of anything but ASCII white space, compared exactly. Null and empty texts and texts
    below PASSAGE words have no passage; null ids come first only where all ids of a class are null; repeated
    rows are copies of each other; further columns are ignored. Texts of any length are read whole, in pieces; an empty
    table gives no rows.
    """
    rows, windows_ = repeated_windows(docs)
    found = (windows_.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", "first_doc"))).alias("found"))
             .mapInPandas(_passages, "key_a long, key_b long, passages array<struct<start:int,end:int,first_doc:long>>, repeated_words long"))
    classes = (rows.groupBy(*KEY).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"), F.max("words").alias("words"))
               .where(F.col("words") >= PASSAGE))
    whole = F.col("copies") > 1
    full = F.array(F.struct(F.lit(0).alias("start"), F.col("words").cast("int").alias("end"), F.col("class_id").alias("first_doc")))
    judged = written(
        classes.join(found, KEY, "left").where(whole | F.col("passages").isNotNull())
        .select(*KEY, "class_id", "copies", F.when(whole, F.col("words")).otherwise(F.col("repeated_words")).alias("repeated_words"),
                F.when(whole, full).otherwise(F.col("passages")).alias("passages")), "judged")
    return rows.join(judged, KEY).select("doc_id", "class_id", "copies", "words", "repeated_words", "passages")
