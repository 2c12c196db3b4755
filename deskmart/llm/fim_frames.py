"""Fill-in-middle over seekable compressed frames: only the frames that hold a cut are taken apart."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import text_of, written

FRAME = 1 << 16  # bytes of text in a frame
BATCH = 1 << 22  # bytes of frames in a batch that a task hands on
LEVEL = 3


@dataclass(frozen=True)
class Marks:
    """The texts that stand ahead of prefix, suffix and middle. None begins inside another one."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def in_order(self, form: str) -> tuple[bytes, bytes, bytes]:
        first = (self.prefix, self.suffix) if form == "psm" else (self.suffix, self.prefix)
        return tuple(m.encode() for m in (*first, self.middle))


class _Codec:
    """One zstandard context a task, made where it is used."""

    def __init__(self) -> None:
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.opener = zstandard.ZstdDecompressor()

    def pack(self, data: bytes) -> bytes:
        return self.packer.compress(data)

    def open(self, frame: bytes) -> bytes:
        return self.opener.decompress(frame)


def _points(data: bytes) -> int:
    return len(data) - int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))


def _pieces(data: memoryview, size: int) -> Iterator[bytes]:
    """``data`` in pieces of ``size`` bytes that end between code points."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield bytes(data[at:end])
        at = end


def _holds(pieces: Iterable[bytes], marks: Iterable[bytes]) -> bool:
    """Whether a mark stands in the joined pieces, across their borders too."""
    marks, tail = list(marks), b""
    keep = max(map(len, marks)) - 1
    for piece in pieces:
        near = tail + piece
        if any(m in near for m in marks):
            return True
        tail = near[-keep:] if keep else b""
    return False


def _lists(rows: list[list], kind: pa.DataType) -> pa.ListArray:
    ends = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array([v for r in rows for v in r], kind))


_STORE = "doc_id bigint, lines bigint, chars bigint, marked boolean, lines_before array<bigint>, chars_before array<bigint>, frames array<binary>"


def frame_store(docs: DataFrame, marks: Marks = Marks(), size: int = FRAME) -> DataFrame:
    """doc_id, lines, chars, marked, lines_before, chars_before, frames of every row of ``docs``.

    A text (null: empty) is kept as independent zstandard frames of ``size`` bytes of text, each with the number of
    line feeds and code points ahead of it, so the frame that holds a given line or character is found by
    bisection and read alone. ``lines`` counts what `[^\\n]*\\n|[^\\n]+` matches; ``marked`` says that the text holds
    one of ``marks``. An empty text has no frame; null ids stay null; further columns are ignored.
    """
    wanted = [m.encode() for m in (marks.prefix, marks.suffix, marks.middle)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _Codec()
        for batch in batches:
            ids, rows, held = batch.column(0), [], 0
            texts, begun = batch.column(1).cast(pa.large_binary()), 0
            for i in range(batch.num_rows):
                data = memoryview(texts[i].as_buffer())
                lines = chars = 0
                before, at, frames = [], [], []
                for piece in _pieces(data, size):
                    before.append(lines)
                    at.append(chars)
                    frames.append(codec.pack(piece))
                    lines += piece.count(b"\n")
                    chars += _points(piece)
                marked = _holds(_pieces(data, size), wanted)
                rows.append((lines + bool(len(data) and data[-1] != 10), chars, marked, before, at, frames))
                held += sum(map(len, frames)) + 64
                if held >= BATCH or i == batch.num_rows - 1:
                    yield _store_batch(ids.slice(begun, len(rows)), rows)
                    begun, rows, held = i + 1, [], 0

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, _STORE)


def _store_batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    lines, chars, marked, before, at, frames = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(lines, pa.int64()), pa.array(chars, pa.int64()), pa.array(marked, pa.bool_()),
         _lists(before, pa.int64()), _lists(at, pa.int64()), _lists(frames, pa.binary())],
        names=["doc_id", "lines", "chars", "marked", "lines_before", "chars_before", "frames"])


def _cut(codec: _Codec, line: int, lines: int, before: list[int], frames: list[bytes]) -> tuple[int, bytes, bytes]:
    """(frame, its text ahead of the cut, its text behind the cut) for the cut behind the first ``line`` lines. Only
    that frame is decompressed; a cut at an end of the text needs none."""
    if line == 0:
        return 0, b"", b""
    if line == lines:
        return len(frames), b"", b""
    k = int(np.searchsorted(before, line, side="left")) - 1  # the last frame with fewer line feeds ahead
    text = codec.open(frames[k])
    feeds = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    at = int(feeds[line - before[k] - 1]) + 1
    return k, text[:at], text[at:]


def _sections(codec: _Codec, cuts: tuple[int, int], lines: int, before: list[int], frames: list[bytes],
              ) -> tuple[list[bytes], list[bytes], list[bytes], list[tuple[int, int]]]:
    """Frames of prefix, middle and suffix, and for both cuts (frame, code points of it ahead of the cut). Frames
    without a cut go on as they are."""
    (i, head_i, tail_i), (j, head_j, tail_j) = (_cut(codec, c, lines, before, frames) for c in cuts)

    def pack(text: bytes) -> list[bytes]:
        return [codec.pack(text)] if text else []

    after_i, after_j = (k + (1 if head or tail else 0) for k, head, tail in ((i, head_i, tail_i), (j, head_j, tail_j)))
    prefix = [*frames[:i], *pack(head_i)]
    suffix = [*pack(tail_j), *frames[after_j:]]
    if i == j and after_i > i and after_j > j:
        middle = pack(head_j[len(head_i):])
    else:
        middle = [*pack(tail_i), *frames[after_i:j], *pack(head_j)]
    return prefix, middle, suffix, [(i, _points(head_i)), (j, _points(head_j))]


def _numbers(doc_id: int | None, seed: str) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


_OUTPUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output array<binary>"


def fill_in_middle(store: DataFrame, marks: Marks = Marks(), seed: str = "7", rate: int = 100, spm: int = 50) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output (frames) of every row of ``store`` (of frame_store, same marks).

    The id decides the two cuts between lines, whether the text is taken apart (``rate`` of 100) and the form: spm
    (``spm`` of 100) or psm. Empty texts and texts that hold a mark stay plain. Frames without a cut are handed on as
    they are; those with a cut are decompressed and split. A null id counts as an empty one; rows of equal id and
    text get equal results.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _Codec()
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "lines", "chars", "marked", "lines_before", "chars_before", "frames")]
            rows, held = [], 0
            for i in range(batch.num_rows):
                doc_id, lines, chars, marked, before, at, frames = (c[i].as_py() for c in columns)
                h = _numbers(doc_id, seed)
                if not lines or marked or h[2] % 100 >= rate:
                    rows.append((doc_id, lines, "plain", None, None, frames))
                else:
                    form = "spm" if h[3] % 100 < spm else "psm"
                    cuts = sorted((h[0] % (lines + 1), h[1] % (lines + 1)))
                    prefix, middle, suffix, ends = _sections(codec, tuple(cuts), lines, before, frames)
                    one, two = ((at[k] if k < len(at) else chars) + inside for k, inside in ends)
                    parts = (prefix, suffix) if form == "psm" else (suffix, prefix)
                    named = zip(marks.in_order(form), (*parts, middle))
                    output = [f for mark, part in named for f in (codec.pack(mark), *part)]
                    rows.append((doc_id, lines, form, one, two - one, output))
                held += sum(map(len, rows[-1][-1])) + 64
                if held >= BATCH:
                    yield _output_batch(rows)
                    rows, held = [], 0
            if rows:
                yield _output_batch(rows)

    return store.mapInArrow(run, _OUTPUT)


def _output_batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, n, form, prefix, middle, output = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
         pa.array(middle, pa.int64()), _lists(output, pa.binary())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


class _Reader:
    """The bytes of an output, frame by frame, and where its marks stand."""

    def __init__(self, codec: _Codec, frames: list[bytes]):
        self.codec, self.frames = codec, frames

    def pieces(self) -> Iterator[bytes]:
        for frame in self.frames:
            yield self.codec.open(frame)

    def find(self, marks: Iterable[bytes]) -> list[int]:
        """Where each of ``marks``, in this order, stands first behind the one before."""
        wanted, found, tail, base = list(marks), [], b"", 0
        for piece in self.pieces():
            near = tail + piece
            at = 0
            while len(found) < len(wanted) and (k := near.find(wanted[len(found)], at)) >= 0:
                found.append(base + k)
                at = k + len(wanted[len(found) - 1])
            if len(found) == len(wanted):
                return found
            keep = max(at, len(near) - len(wanted[len(found)]) + 1)
            base, tail = base + keep, near[keep:]
        raise ValueError("the output does not hold all marks")

    def between(self, start: int, end: int | None) -> Iterator[bytes]:
        at = 0
        for frame in self.frames:
            size = zstandard.frame_content_size(frame)
            if at + size > start and (end is None or at < end):  # other frames stay compressed
                yield self.codec.open(frame)[max(0, start - at):None if end is None else end - at]
            at += size


def _restored(reader: _Reader, form: str, marks: Marks) -> Iterator[bytes]:
    """The text that an output of a form was made from, piece by piece."""
    if form == "plain":
        yield from reader.pieces()
        return
    order = marks.in_order(form)
    starts = reader.find(order)
    begin = {m: s + len(m) for m, s in zip(order, starts)}
    end = dict(zip(order, [*starts[1:], None]))
    for mark in (marks.prefix, marks.middle, marks.suffix):
        yield from reader.between(begin[mark.encode()], end[mark.encode()])


def digests(outputs: DataFrame, marks: Marks = Marks()) -> DataFrame:
    """``outputs`` (of fill_in_middle) with the SHA-256 of the output and of the text restored from output and form alone,
    in place of the frames. Both are streamed: a task holds one decompressed frame."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _Codec()
        for batch in batches:
            forms, outputs_ = batch.column("form"), batch.column("output")
            found = ([], [])
            for i in range(batch.num_rows):
                reader = _Reader(codec, outputs_[i].as_py())
                for out, pieces in zip(found, (reader.pieces(), _restored(reader, forms[i].as_py(), marks))):
                    digest = hashlib.sha256()
                    for piece in pieces:
                        digest.update(piece)
                    out.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(f, pa.string()) for f in found)],
                                             names=[*batch.schema.names[:-1], "output_sha256", "restored_sha256"])

    return outputs.mapInArrow(run, _OUTPUT.rsplit(",", 1)[0] + ", output_sha256 string, restored_sha256 string")


def texts(outputs: DataFrame) -> DataFrame:
    """``outputs`` with the output as text in place of its frames, for a trainer's reader."""
    @F.arrow_udf("string")
    def joined(frames: pa.Array) -> pa.Array:
        codec = _Codec()
        return pa.array([b"".join(_Reader(codec, f.as_py()).pieces()).decode() for f in frames], pa.string())

    return outputs.withColumn("output", joined("output"))


def transform_documents(docs: DataFrame, marks: Marks = Marks(), seed: str = "7", rate: int = 100, spm: int = 50) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every row of ``docs``.

    Texts are written once as frames; cuts, outputs and digests come from the frames. No row is shuffled, and a task
    holds one text, its compressed frames and one decompressed frame. Null texts count as empty and stay
    plain, with no characters of prefix or middle (null); repeated rows get equal results; further columns are
    ignored; an empty table gives no rows.
    """
    store = written(frame_store(docs, marks), "frames")
    return digests(fill_in_middle(store, marks, seed, rate, spm), marks)
