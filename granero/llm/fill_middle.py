"""Fill-in-the-middle texts by displacing bytes.

A text is cut at two line borders into prefix, middle and suffix, which are written
in another order behind marks. A batch of texts is one run of bytes. Its line borders
are found in one scan; a difference array takes, at every border where the
displacement changes, by how much it does, and its running sum is the displacement of
every byte. Bytes and marks are then scattered to their places at once. Restoring
goes the other way: the marks give the parts, running sums of differences say where
each byte of the text lies now, and one gather brings it back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLAIN, PSM, SPM = "plain", "psm", "spm"
NEW_LINE = 10
MOST_BYTES = 4_000_000
OUTPUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


@dataclass(frozen=True)
class Cuts:
    """``percent`` of the texts are cut, ``suffix_first`` percent of those with the suffix in front.

    Marks are ASCII, and none may begin with the end of one, so that the first mark
    found is always a written one.
    """

    percent: int = 100
    suffix_first: int = 50
    seed: int = 7
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.marks
        if not all(marks) or len(set(marks)) < 3 or not "".join(marks).isascii():
            raise ValueError(f"marks must be three different ASCII texts: {marks}")
        for one in marks:
            for other in marks:
                if any(other.startswith(one[at:]) for at in range(1, len(one))) or (one != other and one in other):
                    raise ValueError(f"the marks {one} and {other} overlap")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four 32-bit numbers from a document's id alone; a null id is the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(name, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


# --- batches of texts as bytes ----------------------------------------------------


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the place where each begins, and the end."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def texts_of(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The inverse of :func:`flat`, as texts."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data)]
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, buffers[1], buffers[2])


def slices(column: pa.Array, most: int = MOST_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``most`` bytes together, or one row."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > start and held + size > most:
            yield start, at
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def displaced(parts: np.ndarray, shifts: np.ndarray, total: int) -> np.ndarray:
    """Where each of ``total`` bytes goes: part i begins at ``parts[i]`` and moves by ``shifts[i]``.

    Parts lie in a row; empty ones may share a place with the next.
    """
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, parts, np.diff(shifts, prepend=0))
    # A step of one per byte makes the running sum the place itself.
    change[1:] += 1
    return np.cumsum(change[:total])


def write_mark(out: np.ndarray, places: np.ndarray, mark: bytes) -> None:
    out[places[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)


@dataclass
class Moved:
    """A batch's texts after the cut; ``bounds`` are those of the written texts."""

    n: np.ndarray
    form: np.ndarray
    prefix_chars: np.ndarray
    middle_chars: np.ndarray
    data: np.ndarray
    bounds: np.ndarray


def holds_mark(column: pa.Array, cuts: Cuts) -> np.ndarray:
    found = np.zeros(len(column), bool)
    for mark in cuts.marks:
        found |= pc.match_substring(column, mark).to_numpy(zero_copy_only=False)
    return found


def move(column: pa.Array, numbers: np.ndarray, cuts: Cuts) -> Moved:
    """Cut every text of a batch by its four ``numbers`` and write its parts anew."""
    data, bounds = flat(column)
    starts, stops = bounds[:-1], bounds[1:]
    breaks = np.flatnonzero(data == NEW_LINE)
    first = np.searchsorted(breaks, starts)
    whole = np.searchsorted(breaks, stops) - first
    open_end = (stops > starts) & (data[np.maximum(stops, 1) - 1] != NEW_LINE) if len(data) else np.zeros(len(starts), bool)
    n = whole + open_end

    h1, h2, h3, h4 = numbers
    one, other = h1 % (n + 1), h2 % (n + 1)
    plain = (stops == starts) | holds_mark(column, cuts) | (h3 % 100 >= cuts.percent)
    ahead = ~plain & (h4 % 100 < cuts.suffix_first)
    form = np.where(plain, PLAIN, np.where(ahead, SPM, PSM))

    def border(units: np.ndarray) -> np.ndarray:
        """The place after so many units."""
        ends = np.append(breaks + 1, 0)[np.minimum(first + units - 1, len(breaks))]
        return np.where(units == 0, starts, np.where(units <= whole, ends, stops))

    cut, end = border(np.minimum(one, other)), border(np.maximum(one, other))
    front, back, _ = sizes = [len(mark) for mark in cuts.marks]
    marked = np.where(plain, 0, sum(sizes))
    # What the texts before have gained in marks moves the whole text.
    before = np.cumsum(marked) - marked
    prefix, middle, suffix = cut - starts, end - cut, stops - end
    shift = np.stack(
        [
            np.where(plain, 0, np.where(ahead, back + suffix + front, front)),
            np.where(plain, 0, sum(sizes) + suffix),
            np.where(plain, 0, np.where(ahead, back - prefix - middle, front + back - middle)),
        ],
        axis=1,
    )
    parts = np.stack([starts, cut, end], axis=1)
    places = displaced(parts.ravel(), (shift + before[:, None]).ravel(), len(data))
    begins = np.append(starts + before, len(data) + marked.sum())
    out = np.empty(begins[-1], np.uint8)
    out[places] = data
    for where, lead, second, size in (
        (~plain & ~ahead, cuts.prefix, cuts.suffix, prefix),
        (ahead, cuts.suffix, cuts.prefix, suffix),
    ):
        at = begins[:-1][where]
        write_mark(out, at, lead.encode())
        write_mark(out, at + len(lead) + size[where], second.encode())
        write_mark(out, at + len(lead) + len(second) + (prefix + suffix)[where], cuts.middle.encode())

    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    return Moved(n, form, chars[cut] - chars[starts], chars[end] - chars[cut], out, begins)


def bring_back(column: pa.Array, form: list[str], cuts: Cuts) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and bounds of the texts that were moved, from their outputs and forms alone."""
    data, bounds = flat(column)
    whole = data.tobytes()
    front, back, last = (mark.encode() for mark in cuts.marks)
    parts, takes, sizes = [], [], []
    at = 0
    for start, stop, kind in zip(bounds[:-1].tolist(), bounds[1:].tolist(), form):
        size = stop - start
        if kind == PLAIN:
            runs = [(start, size)]
        else:
            lead, second = (front, back) if kind == PSM else (back, front)
            low = start + len(lead)
            mid = whole.index(second, low, stop)
            tail = whole.index(last, mid + len(second), stop)
            runs = [(low, mid - low), (mid + len(second), tail - mid - len(second)), (tail + len(last), stop - tail - len(last))]
            size -= len(front) + len(back) + len(last)
            # In the text's order: prefix, middle, suffix.
            runs = [runs[0], runs[2], runs[1]] if kind == PSM else [runs[1], runs[2], runs[0]]
        for place, length in runs:
            parts.append(at)
            takes.append(place - at)
            at += length
        sizes.append(size)
    sources = displaced(np.array(parts, np.int64), np.array(takes, np.int64), at)
    return data[sources], np.cumsum([0, *sizes])


# --- tables -----------------------------------------------------------------------


def fill_in_middle(docs: DataFrame, cuts: Cuts = Cuts()) -> DataFrame:
    """Every text with its middle moved to the end: doc_id, n, form, prefix_chars, middle_chars, output.

    A unit is a line with its end, or what follows the last one; ``n`` counts them. The
    cuts and the form depend on doc_id alone and on ``n``. Null and empty texts, and
    texts that hold a mark, are plain: their output is the text, their counts are null.
    Whole texts of any length are moved. One row for every row of ``docs``, repeats
    included; a null id draws like an empty one. An empty table gives an empty result.
    Columns other than doc_id and text are not read, so their names do not matter.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start, stop in slices(batch.column(1)):
                part = batch.slice(start, stop - start)
                numbers = np.stack([part.column(2 + i).to_numpy() for i in range(4)])
                moved = move(part.column(1), numbers, cuts)
                plain = moved.form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(moved.n, pa.int64()),
                        pa.array(moved.form, pa.string()),
                        pa.array(moved.prefix_chars, pa.int64(), mask=plain),
                        pa.array(moved.middle_chars, pa.int64(), mask=plain),
                        texts_of(moved.data, moved.bounds).cast(pa.string()),
                    ],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    doc_id = F.col("doc_id").cast("bigint")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), *draws(doc_id, cuts.seed)).mapInArrow(batches, OUTPUT)


def restored(moved: DataFrame, cuts: Cuts = Cuts()) -> DataFrame:
    """The rows of ``moved`` with ``restored``, the text rebuilt from ``output`` and ``form``.

    A null output is the empty text. All other columns stay; one named restored is
    replaced. A form other than plain whose output lacks a mark is an error.
    """
    moved = moved.drop("restored").withColumn("output", F.coalesce("output", F.lit("")))
    names = moved.columns
    schema = T.StructType([*moved.schema, T.StructField("restored", T.StringType())])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            outputs, forms = batch.column(names.index("output")), batch.column(names.index("form"))
            for start, stop in slices(outputs):
                part = batch.slice(start, stop - start)
                own = outputs.slice(start, stop - start)
                data, bounds = bring_back(own, forms.slice(start, stop - start).to_pylist(), cuts)
                texts = texts_of(data, bounds).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*names, "restored"])

    return moved.mapInArrow(batches, schema)
