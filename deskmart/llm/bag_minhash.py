"""MinHash near duplicates of weighted word shingles: BagMinHash signatures, bands, verified multiset overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import KEY, text_key, text_of, written
from deskmart.llm.components import connected_components
from deskmart.llm.kernels import NOT_WORD, blocks, mixed, rows_of, windows, words

WORDS = 5            # in a shingle
SIMILARITY = 0.8
BANDS, ROWS = 32, 4  # a pair at the threshold misses all bands once in 20 million
SIZE = BANDS * ROWS
BLOCK_DOCS, BLOCK_SHINGLES = 512, 1_000_000  # of one in-task comparison
_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)


def shingles(tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of a block, in text order. A row of fewer than WORDS words is one shingle."""
    rows, counts = rows_of(at), np.diff(at)
    full = windows(tokens, WORDS)
    whole = rows[:len(full)] == rows[WORDS - 1:] if len(full) else np.zeros(0, bool)
    found, owners = [full[whole]], [rows[:len(full)][whole]]
    for n in range(1, WORDS):
        short = np.flatnonzero(counts == n)
        if len(short):
            value = tokens[at[short]].copy()
            for j in range(1, n):
                value = value * _GOLD + tokens[at[short] + j]
            found.append(mixed(value + _U(n)))
            owners.append(short)
    return np.concatenate(owners), np.concatenate(found)


def weighted(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, shingle) with weight, how often it occurs; and the number of each occurrence, with
    its order of occurrences."""
    own = keys ^ mixed(rows.astype(np.uint64) + _U(1))
    order = np.argsort(own, kind="stable")
    first = np.ones(len(order), dtype=bool)
    first[1:] = own[order][1:] != own[order][:-1]
    starts = np.flatnonzero(first)
    weights = np.diff(np.append(starts, len(order)))
    number = np.arange(len(order)) - np.repeat(starts, weights)
    return order[starts], weights, order, number


def signatures(rows: np.ndarray, keys: np.ndarray, weights: np.ndarray, n: int, size: int = SIZE) -> np.ndarray:
    """The BagMinHash signature of each of ``n`` rows: for every component the first point it gets.

    Weights are cut at 0, 1, 2, 4, 8, ...; every interval below the weight of an element has its own
    Poisson process, with a rate as long as the interval. A point falls in a cell of its interval and
    counts if the cell is below the weight, so elements of any two weights share exactly the
    points below the lesser. It belongs to one random component. A process is followed until its
    points come later than all components of its row have one.
    """
    top = np.ceil(np.log2(weights)).astype(np.int64) if len(weights) else np.zeros(0, np.int64)
    element = np.repeat(np.arange(len(rows)), top + 1)
    level = np.arange(len(element)) - np.repeat(np.cumsum(top + 1) - top - 1, top + 1)
    length = np.where(level > 0, 2.0 ** (level - 1), 1.0)
    row, weight = rows[element], weights[element]
    state = mixed(keys[element] + _GOLD * level.astype(np.uint64))
    low = np.where(level > 0, 2 ** np.maximum(level - 1, 0), 0)
    found = np.full(n * size, np.inf)
    latest = np.full(n, np.inf)
    x, step = np.zeros(len(row)), np.zeros(len(row), dtype=np.uint64)
    per_row = np.bincount(row, minlength=n)
    ahead = np.maximum(1, np.ceil(2 * size / np.maximum(per_row, 1))).astype(np.int64)
    active = np.arange(len(row))
    while len(active):
        for k in range(8):  # processes of rows with few elements look several points ahead
            now = active[ahead[row[active]] > k] if k else active
            if not len(now):
                break
            u = mixed(state[now] + _GOLD * (step[now] * _U(2) + _U(1)))
            step[now] += _U(1)
            x[now] -= np.log(((u >> _U(11)).astype(float) + 1) * 2.0 ** -53) / length[now]
            v = mixed(u ^ _U(0xD1B54A32D192ED03))
            cell = low[now] + 1 + ((v >> _U(32)) & (length[now].astype(np.uint64) - _U(1))).astype(np.int64)
            take = (cell <= weight[now]) & (x[now] < latest[row[now]])
            chosen = now[take]
            part = ((v[take] & _U(0xFFFFFFFF)) % _U(size)).astype(np.int64)
            np.minimum.at(found, row[chosen] * size + part, x[chosen])
        latest = found.reshape(n, size).max(axis=1)
        active = active[x[active] < latest[row[active]]]
    return found.reshape(n, size)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One hash per row and band of ROWS components."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), -1, ROWS)
    out = np.zeros(bits.shape[:2], dtype=np.uint64)
    for k in range(ROWS):
        out = mixed(out * _GOLD + bits[:, :, k])
    return mixed(out + np.arange(out.shape[1], dtype=np.uint64) * _GOLD)


def _signed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts = batch.column(batch.num_columns - 1)
    for start, n, data, offsets in blocks(texts):
        tokens, at = words(data, offsets, NOT_WORD)
        rows, keys = shingles(tokens, at)
        heads, weights, _, _ = weighted(rows, keys)
        hashes = band_hashes(signatures(rows[heads], keys[heads], weights, n)).astype(np.int64)
        counts = np.bincount(rows, minlength=n)
        has = counts > 0
        # the sequence of words, as two sums over (word, place)
        place = np.arange(len(tokens)) - np.repeat(at[:-1], np.diff(at))
        ids = []
        for salt in (1, 2):
            terms = mixed(tokens + _GOLD * (place.astype(np.uint64) * _U(2) + _U(salt)))
            sums = np.zeros(len(terms) + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            ids.append(mixed(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)).astype(np.int64))
        ends = np.zeros(n + 1, dtype=np.int32)
        np.cumsum(np.where(has, BANDS, 0), out=ends[1:])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i).slice(start, n) for i in range(batch.num_columns - 1)),
             pa.array(ids[0]), pa.array(ids[1]), pa.array(counts.astype(np.int64)),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[has].ravel()))],
            names=[*batch.schema.names[:-1], "words_a", "words_b", "n", "bands"])


def signed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, key of the text, key of the word sequence, n shingles and band hashes of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _signed(batch)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(), F.lower(text_of()).alias("text"))
            .mapInArrow(run, "doc_id long, key_a long, key_b long, words_a long, words_b long, n long, bands array<long>"))


def bags(texts: DataFrame) -> DataFrame:
    """(class_no, bag): the shingles of each text with the number of each occurrence mixed in, so that the
    overlap of two multisets is the intersection of two sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n, data, offsets in blocks(batch.column(1)):
                rows, keys = shingles(*words(data, offsets, NOT_WORD))
                _, _, order, number = weighted(rows, keys)
                bag = mixed(keys[order] + _GOLD * number.astype(np.uint64)).astype(np.int64)
                back = np.argsort(rows[order], kind="stable")
                ends = np.zeros(n + 1, dtype=np.int32)
                np.cumsum(np.bincount(rows, minlength=n), out=ends[1:])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, n), pa.ListArray.from_arrays(pa.array(ends), pa.array(bag[back]))],
                    names=["class_no", "bag"])

    return texts.select("class_no", F.lower(text_of()).alias("text")).mapInArrow(run, "class_no long, bag array<long>")


def overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two multisets given as bags."""
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def _block_links(group: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links between documents of different components in a block or between two blocks, one spanning
    set: overlaps of all pairs at once, as products of incidence matrices over the shared shingles."""
    group = group.drop_duplicates("class_no")
    bags_ = [np.asarray(b) for b in group["bag"]]
    sizes = np.array([len(b) for b in bags_])
    ids, parts = group["class_no"].to_numpy(), group["component"].to_numpy()
    flat, owner = np.concatenate(bags_), np.repeat(np.arange(len(sizes)), sizes)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    column = np.unique(column[shared], return_inverse=True)[1]
    owner = owner[shared]
    common = np.zeros((len(sizes), len(sizes)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 8192
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [at, at + width])
        incidence = np.zeros((len(sizes), width), dtype=np.float32)
        incidence[owner[i:j], column[i:j] - at] = 1
        common += incidence @ incidence.T
    near = common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-4
    near &= parts[:, None] != parts[None, :]
    root = {p: p for p in parts}

    def top(p: int) -> int:
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    links = []
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        a, b = top(parts[i]), top(parts[j])
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((ids[i], ids[j]))
    return pd.DataFrame(links, columns=["src", "dst"], dtype="int64")


def _bag_table(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """Bags of the classes in ``reps`` (class_no, doc_id, key of the text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(), "text")
    r = reps.select("class_no", F.col("doc_id").alias("rep_id"), F.col("key_a").alias("rep_a"), F.col("key_b").alias("rep_b"))
    joined = texts.join(r.hint("shuffle_hash"), (F.col("key_a") == F.col("rep_a")) & (F.col("key_b") == F.col("rep_b"))
                        & F.col("doc_id").eqNullSafe(F.col("rep_id")))
    return written(bags(joined), "bags")


def near_duplicate_groups(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(signed rows with class_no; class_no, component, rep): the connected groups of near duplicates.

    1. Rows with equal word sequences are one class. 2. Classes that agree in a band share a bucket; each bucket has as
    leader the class that sits in the most and largest buckets, and all others are verified against it. 3. Buckets of three or more whose members are still in
    different components are compared in full: blocks of bounded size, every pair of blocks in a task
    of its own, with exact overlaps. So every link between classes that share a bucket is found
    or was made needless by a path of verified links; no bucket is capped.
    """
    signed = written(signed_documents(docs), "signed")
    rep = F.struct("doc_id", *KEY)
    # equal words have equal bands
    classes = written(signed.groupBy("words_a", "words_b").agg(
        F.min(rep).alias("rep"), F.max("n").alias("n"), F.any_value("bands").alias("bands"))
        .withColumn("class_no", F.monotonically_increasing_id()), "classes")
    rows = signed.join(classes.select("words_a", "words_b", "class_no"), ["words_a", "words_b"])
    members = classes.select("class_no", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = written(members.join(sizes, "bucket"), "shared")
    central = members.groupBy("class_no").agg(F.sum("size").alias("central"))
    best = F.max(F.struct("central", (-F.col("class_no")).alias("no"))).alias("best")
    leaders = (members.join(central, "class_no").groupBy("bucket").agg(best)
               .select("bucket", (-F.col("best.no")).alias("leader")))
    pairs = (members.join(leaders, "bucket").where("class_no <> leader")
             .select("class_no", "leader").distinct())
    needed = members.select("class_no").distinct()
    found = _bag_table(docs, classes.join(needed, "class_no").select("class_no", "rep.*"))
    a = found.select(F.col("class_no").alias("leader"), F.col("bag").alias("leader_bag"))
    checked = pairs.join(found, "class_no").join(a, "leader")
    links = written(checked.where(overlap(F.col("bag"), F.col("leader_bag")) >= similarity)
                    .select(F.col("leader").alias("src"), F.col("class_no").alias("dst")), "links")
    groups = written(connected_components(links), "groups")

    part = F.coalesce("component", "class_no").alias("component")
    placed = (members.where("size > 2").join(groups.withColumnRenamed("node", "class_no"), "class_no", "left")
              .select("bucket", "class_no", part))
    sizes_of = classes.select("class_no", "n")
    open_ = (placed.join(sizes_of, "class_no").groupBy("bucket")
             .agg(F.min("component").alias("low"), F.max("component").alias("high"),
                  F.count("*").alias("docs"), F.sum("n").alias("shingles")).where("low <> high")
             .select("bucket", F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS),
                                          F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("parts")))
    left = written(placed.join(open_, "bucket"), "open")
    own = F.pmod(F.xxhash64("class_no"), F.col("parts")).cast("int")
    dealt = (left.withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("bucket", "class_no", "component", F.least("own", "other").alias("one"),
                     F.greatest("own", "other").alias("two")))
    more = written(
        dealt.join(found, "class_no").groupBy("bucket", "one", "two")
        .applyInPandas(lambda g: _block_links(g, similarity), "src long, dst long").distinct(), "more")
    if more.take(1):
        groups = written(connected_components(links.union(more)), "groups")
    named = (classes.join(groups.withColumnRenamed("node", "class_no"), "class_no", "left")
             .select("class_no", part, "rep"))
    return rows, written(named, "named")


def classify_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, class_docs and kept of every row of ``docs``.

    Documents are near duplicates when their multisets of five-word shingles overlap (weighted Jaccard) by
    ``similarity`` or more; ``class_id`` is the least doc_id of the connected group, and ``kept``
    marks the row that stays. Words are runs of letters and digits in small letters; texts of fewer
    than five words are one shingle. Null and empty texts and texts without words are all equal; null ids sort first, so a
    group with one has a null class_id; of repeated rows that would all stay, each is marked. Further
    columns are ignored; texts of any length are read whole, in pieces of bounded size; an empty table gives no rows.
    """
    rows, groups = near_duplicate_groups(docs, similarity)
    keep = groups.groupBy("component").agg(F.min("rep").alias("keep"))
    sized = (rows.groupBy("class_no").agg(F.count("*").alias("docs"))
             .join(groups.select("class_no", "component"), "class_no")
             .groupBy("component").agg(F.sum("docs").alias("class_docs")))
    named = groups.join(keep, "component").join(sized, "component").select("class_no", "keep", "class_docs")
    return (rows.join(named, "class_no")
            .select("doc_id", F.col("keep.doc_id").alias("class_id"), "class_docs",
                    F.struct("doc_id", *KEY).eqNullSafe(F.col("keep")).alias("kept")))


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the one with the least doc_id, null before others
    and ties broken by the text's key; of rows with equal id and text any one.

    Texts without words, null and empty ones included, are one group. An empty table stays empty; further columns of any
    name are kept.
    """
    _, groups = near_duplicate_groups(docs, similarity)
    keep = (groups.groupBy("component").agg(F.min("rep").alias("keep"))
            .select(F.col("keep.doc_id").alias("rep_id"), F.col("keep.key_a").alias("rep_a"), F.col("keep.key_b").alias("rep_b")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *text_key())
    kept = rows.join(keep.hint("shuffle_hash"), (F.col("key_a") == F.col("rep_a")) & (F.col("key_b") == F.col("rep_b"))
                     & F.col("doc_id").eqNullSafe(F.col("rep_id")), "left_semi")
    return kept.dropDuplicates(["doc_id", *KEY]).select("row.*")
