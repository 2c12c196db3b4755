"""Benchmark decontamination: greedy string tiling of benchmark items over documents."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import KEY, text_key, text_of, written
from deskmart.llm.kernels import NOT_WORD, blocks, rows_of, windows, words

SEED = 5          # words in a shared seed, and in the shortest tile
COVERAGE = 0.6    # share of an item's words under tiles from which a document counts as contaminated
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def _seed_arrays(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Hashes of all runs of SEED words of each row, in order; the text is the last column."""
    *rest, texts = batch.columns
    lists, lengths = [], []
    for _, _, data, offsets in blocks(texts):
        tokens, at = words(data, offsets, NOT_WORD)
        rows = rows_of(at)
        seeds = windows(tokens, SEED)
        whole = rows[:len(seeds)] == rows[SEED - 1:] if len(seeds) else np.zeros(0, bool)
        lists.append(seeds[whole].astype(np.int64))
        lengths.append(np.maximum(np.diff(at) - SEED + 1, 0))
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    if lengths:
        np.cumsum(np.concatenate(lengths), out=starts[1:])
    values = pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64))
    return pa.RecordBatch.from_arrays(
        [*rest, pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), values)],
        names=[*batch.schema.names[:-1], "seeds"])


def seeds_of(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``seeds``: hashes of all runs of SEED words. Words are runs of ASCII letters, digits and
    anything beyond ASCII, in small letters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # bounds the lists in memory
                yield _seed_arrays(batch.slice(at, 500))

    schema = ", ".join(f"{k} {t}" for k, t in df.select(*keep).dtypes)
    return df.select(*keep, F.lower(text_of()).alias("text")).mapInArrow(run, f"{schema}, seeds array<long>")


class _Rolling:
    """Karp-Rabin hashes of all runs of a sequence, by prefix sums modulo a prime."""

    def __init__(self, sequence: list[int]):
        self.sums, self.powers = [0], [1]
        for x in sequence:
            self.sums.append((self.sums[-1] * _BASE + x) % _PRIME)
            self.powers.append(self.powers[-1] * _BASE % _PRIME)

    def hash(self, start: int, n: int) -> int:
        return (self.sums[start + n] - self.sums[start] * self.powers[n]) % _PRIME


def tiles(item: list[int], places: list[int], seeds: list[int]) -> list[tuple[int, int, int]]:
    """Greedy string tiling of an item over the seeded parts of a text: (item word, text word, words) of each tile.

    ``item`` has the hash of every run of SEED words of the item; the text has ``seeds`` at the
    sorted word ``places``. A tile of n words is a run of n - SEED + 1 equal seeds. Searching starts
    with long runs: all runs of the search length whose words are unmarked are found by their
    Karp-Rabin hashes, compared and extended; a match of twice the length restarts the search with its length; else the
    matches are marked, longest first, of equal ones the first in the item and then in the text, where nothing is
    marked yet; then the length is halved, down to one seed. The result is that of plain greedy tiling.
    """
    islands, begin = [], 0  # runs of neighbouring places
    for k in range(1, len(places) + 1):
        if k == len(places) or places[k] != places[k - 1] + 1:
            islands.append((begin, k))
            begin = k
    own, text = _Rolling(item), _Rolling(seeds)
    item_marks, text_marks = [False] * (len(item) + SEED - 1), set()
    found: list[tuple[int, int, int]] = []

    def free(i: int, p: int, n: int) -> int:
        """Words of the run of n seeds that can be tiled from its start, up to the first mark."""
        for k in range(n + SEED - 1):
            if item_marks[i + k] or p + k in text_marks:
                return k
        return n + SEED - 1

    longest = max((e - b for b, e in islands), default=0)
    length = min(longest, len(item))
    while length >= 1:
        runs: dict[int, list[int]] = {}
        for i in range(len(item) - length + 1):
            if not any(item_marks[i:i + length + SEED - 1]):
                runs.setdefault(own.hash(i, length), []).append(i)
        matches: list[tuple[int, int, int]] = []
        for b, e in islands if runs else ():
            for k in range(b, e - length + 1):
                for i in runs.get(text.hash(k, length), ()):
                    n = 0
                    while k + n < e and i + n < len(item) and item[i + n] == seeds[k + n]:
                        n += 1
                    if n >= length and (size := free(i, places[k], n)) >= length + SEED - 1:
                        matches.append((size, i, places[k]))
        best = max((m[0] for m in matches), default=0) - SEED + 1
        if best >= 2 * length:
            length = best
            continue
        queue = [(-size, i, p) for size, i, p in matches]
        heapq.heapify(queue)
        while queue:
            less, i, p = heapq.heappop(queue)
            n = free(i, p, -less - SEED + 1)
            if n == -less:
                found.append((i, p, n))
                item_marks[i:i + n] = [True] * n
                text_marks.update(range(p, p + n))
            elif n >= length + SEED - 1:  # what is left of a match takes its turn by its new length
                heapq.heappush(queue, (-n, i, p))
        length = length // 2 if length > 1 else 0
    return sorted(found)


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(key of the text, item_id, item_words, tiled_words, tiles, coverage) of every text and item with
    tiles over at least ``coverage`` of the item. See ``decontaminate`` for the rules."""
    items = written(seeds_of(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), "item_id")
                    .where("size(seeds) > 0").withColumn("item_no", F.monotonically_increasing_id()), "items")
    seeds = items.select("item_no", F.explode("seeds").alias("seed")).distinct()
    seeds = written(seeds, "seeds")  # the planner broadcasts it below its threshold only
    found = (seeds_of(docs.select(*text_key(), "text"), *KEY)
             .select(*KEY, F.posexplode("seeds").alias("place", "seed"))
             .join(seeds, "seed"))
    # copies of a text give equal rows; one text has at most one row per place and item
    pairs = (found.distinct().groupBy(*KEY, "item_no")
             .agg(F.array_sort(F.collect_list(F.struct("place", "seed"))).alias("found"))
             .join(items.withColumnRenamed("seeds", "item"), "item_no"))

    def tile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for a, b, item_id, hits, item in zip(batch["key_a"], batch["key_b"], batch["item_id"], batch["found"], batch["item"]):
                item = [int(x) for x in item]
                got = tiles(item, [int(h["place"]) for h in hits], [int(h["seed"]) for h in hits])
                total = len(item) + SEED - 1
                under = sum(n for _, _, n in got)
                out.append((a, b, item_id, total, under, ",".join(f"{i}:{p}:{n}" for i, p, n in got), under / total))
            yield pd.DataFrame(out, columns=["key_a", "key_b", "item_id", "item_words", "tiled_words", "tiles", "coverage"])

    return pairs.select(*KEY, "item_id", "found", "item").mapInPandas(
        tile, "key_a long, key_b long, item_id long, item_words int, tiled_words int, tiles string, coverage double"
    ).where(F.col("coverage") >= coverage)


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, item_words, tiled_words, tiles, coverage: the benchmark items each contaminated document holds.

    Seeds are all runs of SEED words; documents and items that share seeds are joined on them, and
    each such pair is tiled from its seeds alone, so texts are read once and never shuffled. Tiles
    are found longest first and do not overlap, so an item is also found when its passages were
    reordered. ``tiles`` lists item word:text word:words.

    Items of fewer than SEED words are no evidence and never match. Null and empty texts hold
    nothing; null and repeated ids are passed through, every row of an equal text gets the same
    items; an item_id with several texts is tiled by each; further columns are ignored; empty tables give no rows.
    Of equally long matches the one that is first in the item, then in the text, becomes the tile. Texts of any length
    are read whole; their words are hashed in pieces, and a task holds the seeds that a text shares with an item.
    """
    found = written(contaminated_texts(docs, benchmark, coverage), "contaminated")
    rows = docs.select("doc_id", *text_key())
    return rows.join(found, KEY).select("doc_id", "item_id", "item_words", "tiled_words", "tiles", "coverage")


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose texts are not contaminated, by the rules of find_leaks.

    Null and empty texts stay; repeated rows stay or go together; without benchmark items all rows stay; an empty table
    stays empty; further columns of any name are kept.
    """
    found = written(contaminated_texts(docs, benchmark, coverage).select(*KEY).distinct(), "contaminated")
    return (docs.select(F.struct(*docs.columns).alias("row"), *text_key())
            .join(found, KEY, "left_anti").select("row.*"))
