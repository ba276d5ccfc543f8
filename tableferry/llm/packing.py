"""Packing documents into sequences by linear grouping and best fit.

Lengths are whole numbers up to the capacity, so a histogram of at most ``capacity`` rows describes any corpus. On it,
large lengths are sorted and cut into groups of equal cardinality, and each is rounded up to the largest of its group.
With so few sizes, configurations (multisets of sizes that fit one sequence) are built one after the other, each the
fullest for the largest size left, and used as often as the sizes last. Then the actual lengths take the places of
the rounded ones, and the small lengths go by best fit into the tightest gap that holds them.

A plan is a list of runs, one for each place of a configuration: *pieces of this length, ranks r to r + m, stand at this
offset of sequences s to s + m*. Its size depends on the capacity and the groups, not on the corpus. Pieces learn
their rank within their length by counts of slices, so that a length shared by a third of all pieces is still dealt
over many tasks.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm import common, vocabulary

CAPACITY = 2048
#: Appended to each document.
END = 0
#: A length is large from this share of the capacity. Numbers of groups to try; the plan of fewest sequences is taken.
LARGE = 1 / 8
GROUPS = (256, 1024, 4096)
#: Slices in which the pieces of one length are ranked.
SLICES = 256

_PIECE = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The pieces of each document's ids. All but the first have ``capacity`` tokens. ``row`` numbers the documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary.byte_bpe(path).encode
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for row, doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), encode(batch.column(2))):
                ids += end
                length = len(ids) // 4
                start = 0
                for number in range(-(-length // capacity)):
                    stop = start + capacity if number or length % capacity == 0 else length % capacity
                    out.append((row, doc, number, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start = stop
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in _PIECE.split(", ")])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(cut, _PIECE)


# --- the plan, on the histogram ------------------------------------------------------------------------------------


def grouped(lengths: list[int], counts: list[int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups of equal cardinality of ascending lengths: (rounded size, [(length, count)])."""
    total = sum(counts)
    share, out, room = -(-total // groups), [], 0
    for length, count in zip(lengths, counts):
        while count:
            if not room:
                out.append([])
                room = share
            taken = min(room, count)
            out[-1].append((length, taken))
            room -= taken
            count -= taken
    merged: dict[int, list] = {}
    for members in out:  # groups that round to one size are one size
        merged.setdefault(members[-1][0], []).extend(members)
    return sorted(merged.items())


def fullest(sizes: list[int], left: list[int], room: int) -> list[int]:
    """Indices of sizes (ascending), at most ``left`` of each, whose sum comes closest to ``room``; larger sizes first."""
    reach = 1  # bit s: the sum s can be reached
    steps: list[tuple[int, int]] = []
    mask = (1 << (room + 1)) - 1
    for i in range(len(sizes) - 1, -1, -1):
        if sizes[i] > room or not left[i]:
            continue
        for _ in range(min(left[i], room // sizes[i])):
            grown = (reach | reach << sizes[i]) & mask
            if grown == reach:
                break
            steps.append((i, reach))
            reach = grown
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, []
    for i, before in reversed(steps):
        if not before >> at & 1:
            chosen.append(i)
            at -= sizes[i]
    return chosen


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """(indices of sizes in one sequence, how many sequences), until no size is left."""
    left, out, top = list(counts), [], len(sizes) - 1
    while top >= 0:
        if not left[top]:
            top -= 1
            continue
        left[top] -= 1
        chosen = [top, *fullest(sizes, left, capacity - sizes[top])]
        left[top] += 1
        need = defaultdict(int)
        for i in chosen:
            need[i] += 1
        times = min(left[i] // n for i, n in need.items())
        for i, n in need.items():
            left[i] -= n * times
        out.append((chosen, times))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = 1024) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, number, first sequence, offset) that place every piece of a histogram of lengths."""
    large = sorted(x for x in histogram if x >= LARGE * capacity and histogram[x])
    members = grouped(large, [histogram[x] for x in large], groups)
    sizes = [size for size, _ in members]
    supply = [list(m) for _, m in members]  # actual lengths of each group, the largest last
    ranks: dict[int, int] = defaultdict(int)
    sequences, runs = 0, []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens: [(first sequence, number)]

    def place(length: int, number: int, sequence: int, offset: int) -> None:
        runs.append((length, ranks[length], number, sequence, offset))
        ranks[length] += number

    for chosen, times in configurations(sizes, [sum(n for _, n in m) for _, m in members], capacity):
        while times:
            # Substitute: as many sequences as every place can fill with one actual length.
            want: dict[int, int] = defaultdict(int)
            for i in chosen:
                want[i] += 1
            now = min([times, *(max(1, supply[i][-1][1] // n) for i, n in want.items())])
            offset = 0
            for i in chosen:
                length, number = supply[i][-1]
                place(length, now, sequences, offset)
                if number > now:
                    supply[i][-1] = (length, number - now)
                else:
                    supply[i].pop()
                offset += length
            gaps[capacity - offset].append((sequences, now))
            sequences += now
            times -= now
    for length in sorted((x for x in histogram if x < LARGE * capacity and histogram[x]), reverse=True):
        left = histogram[length]
        while left:
            fit = min((g for g in gaps if g >= length and gaps[g]), default=None)
            if fit is None:
                # New sequences hold as many of this length as fit, so that few runs open them.
                each = min(capacity // length, left)
                number = left // each
                for k in range(each):
                    place(length, number, sequences, k * length)
                gaps[capacity - each * length].append((sequences, number))
                sequences += number
                left -= each * number
                continue
            first, number = gaps[fit].pop()
            now = min(number, left)
            if now < number:
                gaps[fit].append((first + now, number - now))
            if not gaps[fit]:
                del gaps[fit]
            place(length, now, first, capacity - fit)
            gaps[fit - length].append((first, now))
            left -= now
    return runs


def best_plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS) -> list[tuple[int, int, int, int, int]]:
    return min((plan(histogram, capacity, g) for g in groups), key=lambda runs: max((r[3] + r[2] for r in runs), default=0))


def pack(docs: DataFrame, capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS, path: str | None = None) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end token alone. Repeated rows and null ids are documents of their own; ties in
    length are broken by slice and row. An empty table gives no rows. Other columns are ignored.
    """
    cut = common.stored(pieces(docs, capacity, path).withColumn("slice", F.pmod(F.xxhash64("row", "piece"), F.lit(SLICES))), "pieces")
    counts = common.stored(cut.groupBy("length", "slice").agg(F.count("*").alias("n")), "counts")
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).select("length", "slice", "first")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    runs = np.array(sorted(best_plan(histogram, capacity, groups)), np.int64).reshape(-1, 5)
    span = int(runs[:, 1].max(initial=0) + 1)
    order = runs[:, 0] * span + runs[:, 1]

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("length", "rank"))
            at = runs[np.searchsorted(order, length * span + np.minimum(rank, span - 1), side="right") - 1]
            out = [*batch.columns[:5], pa.array(at[:, 3] + rank - at[:, 1]), pa.array(at[:, 4])]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    own = Window.partitionBy("length", "slice").orderBy("row", "piece")
    within = cut.withColumn("own", F.row_number().over(own) - 1)
    ranked = within.join(F.broadcast(firsts), ["length", "slice"]).withColumn("rank", (F.col("first") + F.col("own")).cast("long"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        seat, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
