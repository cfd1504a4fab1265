"""Product codes of vectors, by rounds of k-means in whole numbers with norm-of-sum bounds.

A vector is cut into parts, and each part position has a codebook of its own.
Each round assigns every part to the nearest entry and moves the entries to the
means.  For each part a row carries an upper bound on the distance to its entry
and a lower bound on the distance to all others, each stamped with the round in
which it was exact.  The codebooks of all rounds are kept, so a bound is brought
up to date by how far its entries really are from where they stood in the
stamped round: the norm of the sum of their moves, which is never more than the
sum of the norms.  Only where the bounds then fail are distances computed again,
first to the one entry, then to all.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ..storage import cut_lineage, drop_cut
from .texts import give_back, pieces


@dataclass(frozen=True)
class Coding:
    """A component x counts as floor(scale * x)."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


#: Whole numbers of up to so many bits have squared distances that fit in 64 bits; larger ones go as Python's.
SMALL_BITS = 26

# beside all columns of a caller's table
_CODE, _HIGH, _LOW, _STAMPS, _SUMS, _DIMS = "__code", "__high", "__low", "__stamps", "__sums", "__dims"
STATE = [StructField(c, BinaryType()) for c in (_CODE, _HIGH, _LOW, _STAMPS, _SUMS)]


# --- whole numbers -----------------------------------------------------------------------------


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles; 64-bit numbers, or Python's where they don't fit."""
    scaled = np.floor(values * scale) if values.size == 0 or np.abs(values).max() < 1e300 else None
    if scaled is not None and (scaled.size == 0 or np.abs(scaled).max() < 1 << SMALL_BITS):
        return scaled.astype(np.int64)
    # a double from 2**53 is whole, and multiplied as such
    flat = [int(v) * scale if abs(v) >= 1 << 53 else math.floor(v * scale) for v in values.ravel().tolist()]
    return np.array(flat, object).reshape(values.shape)


def squared(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of two arrays of whole numbers."""
    return ((x - entry) ** 2).sum(axis=-1)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Nearest entry of each row, ties to the lower index; its squared distance, and the next one's if there is one."""
    d = np.stack([squared(x, e) for e in book], axis=1)
    code = d.argmin(axis=1)
    own = d[np.arange(len(x)), code]
    other = np.sort(d, axis=1)[:, 1] if len(book) > 1 else None
    return code, own, other


_UP = 1 + 2.0**-40  # outweighs the rounding of the few floating-point steps from one bound to the next


def _root(squares: np.ndarray, more: int) -> np.ndarray:
    if squares.dtype != object:
        return np.sqrt(squares.astype(np.float64))
    largest = int(np.finfo(np.float64).max)
    roots = [math.isqrt(v) + more for v in squares.ravel().tolist()]
    return np.array([float(r) if r <= largest else (np.inf if more else largest) for r in roots], float).reshape(squares.shape)


def root_up(squares: np.ndarray) -> np.ndarray:
    return _root(squares, 1) * _UP


def root_down(squares: np.ndarray) -> np.ndarray:
    return _root(squares, 0) / _UP


# --- one round ---------------------------------------------------------------------------------


@dataclass
class History:
    """Codebooks of all rounds so far, each of shape (parts, entries, width)."""

    books: list[np.ndarray] = field(default_factory=list)

    def moved(self, part: int) -> tuple[np.ndarray, np.ndarray]:
        """For each earlier round: how far each entry is from where it stood then, and how far the
        farthest of all others is; rounded up."""
        now = self.books[-1][part]
        far = np.stack([root_up(squared(now, old[part])) for old in self.books])
        others = np.zeros_like(far)
        for j in range(far.shape[1]):
            others[:, j] = np.delete(far, j, axis=1).max(axis=1, initial=0)
        return far, others


@dataclass
class Bounds:
    """For each row and part: entry, bounds, and the rounds in which these were exact."""

    code: np.ndarray
    high: np.ndarray
    low: np.ndarray
    high_stamp: np.ndarray
    low_stamp: np.ndarray

    @classmethod
    def first(cls, rows: int, parts: int) -> Bounds:
        """Bounds that fail."""
        zeros = lambda kind: np.zeros((rows, parts), kind)
        return cls(zeros(np.uint8), np.full((rows, parts), np.inf), zeros(np.float64), zeros(np.uint8), zeros(np.uint8))


def reassign(x: np.ndarray, bounds: Bounds, history: History) -> int:
    """Assign every part of ``x`` (rows, parts, width) by the newest codebooks, in ``bounds``; returns
    the number of distances computed."""
    now, computed = len(history.books) - 1, 0
    for p in range(x.shape[1]):
        far, others = history.moved(p)
        code, book, own = bounds.code[:, p], history.books[-1][p], x[:, p]
        low = (bounds.low[:, p] - others[bounds.low_stamp[:, p], code]) / _UP
        high = (bounds.high[:, p] + far[bounds.high_stamp[:, p], code]) * _UP
        # an entry that is strictly nearer than all others is the one an exact comparison finds
        open_ = np.flatnonzero(~(high < low))
        if not len(open_):
            continue
        if now:
            tight = root_up(squared(own[open_], book[code[open_]]))
            bounds.high[open_, p], bounds.high_stamp[open_, p] = tight, now
            computed += len(open_)
            open_ = open_[~(tight < low[open_])]
        found, mine, other = nearest(own[open_], book)
        computed += len(open_) * len(book)
        bounds.code[open_, p] = found
        bounds.high[open_, p], bounds.high_stamp[open_, p] = root_up(mine), now
        bounds.low[open_, p], bounds.low_stamp[open_, p] = np.inf if other is None else root_down(other), now
    return computed


def sums_of(x: np.ndarray, code: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and sums of each part's entries."""
    counts = np.zeros((x.shape[1], entries), np.int64)
    sums = np.zeros((x.shape[1], entries, x.shape[2]), x.dtype)
    for p in range(x.shape[1]):
        counts[p] = np.bincount(code[:, p], minlength=entries)
        np.add.at(sums[p], code[:, p], x[:, p])
    return counts, sums


# --- Spark -------------------------------------------------------------------------------------

_LIMB = 31  # bits of a limb of a sum, so that sums of limbs fit in 64 bits


def _limbs(v: int) -> list[tuple[int, int]]:
    """Signed limbs other than zero, that together make up ``v``."""
    out, sign, v, i = [], (1 if v >= 0 else -1), abs(v), 0
    while v:
        if low := v & ((1 << _LIMB) - 1):
            out.append((i, sign * low))
        v, i = v >> _LIMB, i + 1
    return out


def _pack(counts: np.ndarray, sums: np.ndarray) -> bytes:
    """Rows of whole numbers: part, entry, position (-1: the count), limb, value."""
    rows = [(p, e, -1, 0, int(counts[p, e])) for p, e in np.argwhere(counts).tolist()]
    for p, e, i in np.argwhere(sums != 0).tolist():
        rows += [(p, e, i, limb, v) for limb, v in _limbs(int(sums[p, e, i]))]
    return np.array(rows, "<i8").reshape(-1, 5).tobytes()


def usable(vectors: Column) -> Column:
    """Whether a vector is neither null nor holds a null or a number that is not finite."""
    odd = F.exists(vectors, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.isNotNull() & ~F.coalesce(odd, F.lit(True))


def _matrix(column: pa.Array, coding: Coding) -> np.ndarray:
    """Whole numbers of shape (rows, parts, width)."""
    values = np.asarray(column.flatten()).astype(np.float64)
    return whole(values.reshape(len(column), coding.parts, -1), coding.scale)


def _read_bounds(part: pa.RecordBatch, coding: Coding) -> Bounds:
    if _CODE not in part.schema.names:
        return Bounds.first(part.num_rows, coding.parts)

    def of(name: str, kind: str, *shape: int) -> np.ndarray:
        return np.frombuffer(b"".join(part.column(name).to_pylist()), kind).reshape(-1, *shape, coding.parts).copy()

    stamps = of(_STAMPS, "u1", 2)
    high, low = of(_HIGH, "<f4").astype(np.float64), of(_LOW, "<f4").astype(np.float64)
    return Bounds(of(_CODE, "u1"), high, low, stamps[:, 0], stamps[:, 1])


def _write_bounds(bounds: Bounds) -> list[pa.Array]:
    """In the order of ``STATE``; bounds as single floats, one step outward."""
    with np.errstate(over="ignore"):
        high = np.nextafter(bounds.high.astype("<f4"), np.float32(np.inf))
        low = np.nextafter(bounds.low.astype("<f4"), np.float32(-np.inf))
    stamps = np.stack([bounds.high_stamp, bounds.low_stamp], axis=1)
    return [pa.array([r.tobytes() for r in a], pa.binary()) for a in (bounds.code, high, low, stamps)]


def _step(rows: DataFrame, vec_col: str, history: History, coding: Coding) -> DataFrame:
    """The rows with bounds of a new round, and a row of each task with the sums of its rows."""
    state = {f.name for f in STATE}
    plain = [f for f in rows.schema.fields if f.name not in state]
    names = [f.name for f in plain] + [f.name for f in STATE]
    shape = history.books[-1].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(shape[:2], np.int64), np.zeros(shape, np.int64)
        computed, columns = 0, None
        for batch in batches:
            for part in pieces(batch, 8192):
                x, bounds = _matrix(part.column(vec_col), coding), _read_bounds(part, coding)
                computed += reassign(x, bounds, history)
                columns = [part.column(f.name) for f in plain]
                yield pa.RecordBatch.from_arrays([*columns, *_write_bounds(bounds), pa.nulls(part.num_rows, pa.binary())], names)
                more = sums_of(x, bounds.code.astype(np.int64), shape[1])
                counts, sums = counts + more[0], sums + more[1]
        if columns is not None:
            done = np.array([[-1, -1, -1, 0, computed]], "<i8").tobytes()
            empty = [pa.nulls(1, c.type) for c in columns] + [pa.nulls(1, pa.binary())] * 4
            yield pa.RecordBatch.from_arrays([*empty, pa.array([_pack(counts, sums) + done], pa.binary())], names)
        give_back()

    free = [StructField(f.name, f.dataType) for f in plain]
    return rows.mapInArrow(run, StructType([*free, *STATE]))


def _totals(sums: DataFrame) -> list:
    """Sums over all tasks: a row for each part, entry, position and limb."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8").reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.T.copy()], ["p", "e", "i", "limb", "v"])

    long_rows = sums.select(_SUMS).mapInArrow(rows, "p long, e long, i long, limb long, v long")
    return long_rows.groupBy("p", "e", "i", "limb").agg(F.sum("v").alias("v")).collect()


def _moved_on(book: np.ndarray, totals: list) -> tuple[np.ndarray, int]:
    """The next codebooks: floor(sum / count) of used entries; and how many distances were computed."""
    counts: dict = {}
    sums: dict = {}
    computed = 0
    for r in totals:
        if r.p < 0:
            computed += r.v
        elif r.i < 0:
            counts[r.p, r.e] = r.v
        else:
            sums[r.p, r.e, r.i] = sums.get((r.p, r.e, r.i), 0) + (r.v << (_LIMB * r.limb))
    out = book.astype(object)
    for (p, e), n in counts.items():
        for i in range(book.shape[2]):
            out[p, e, i] = sums.get((p, e, i), 0) // n
    return _tidy(out), computed


def _tidy(book: np.ndarray) -> np.ndarray:
    """64-bit numbers where they are small enough."""
    small = all(abs(v) < 1 << SMALL_BITS for v in book.ravel().tolist())
    return book.astype(np.int64) if small else book


@dataclass
class Codes:
    """``rows``: all columns of the kept rows, ``code binary`` (an index for each part) and ``error``;
    ``history``: the codebooks before each round and after the last; ``computed``: distances
    computed in each assignment."""

    rows: DataFrame
    history: History
    computed: list[int]

    @property
    def codebooks(self) -> np.ndarray | None:
        return self.history.books[-1] if self.history.books else None

    @property
    def codebooks_sha256(self) -> str:
        """Of all entries' components as decimals by part, entry and position, joined by commas."""
        flat = [] if self.codebooks is None else self.codebooks.ravel().tolist()
        return hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def _first_books(rows: DataFrame, id_col: str, vec_col: str, coding: Coding) -> np.ndarray:
    """The parts of the vectors with the smallest ids; few rows, by parameter."""
    order = [F.col(id_col).asc_nulls_last(), F.col(vec_col).asc()]
    head = rows.orderBy(*order).limit(coding.entries).select(vec_col).collect()
    values = np.array([list(r[0]) for r in head], np.float64)
    return _tidy(whole(values.reshape(len(head), coding.parts, -1), coding.scale).transpose(1, 0, 2).astype(object))


def encode(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", coding: Coding = Coding()) -> Codes:
    """Train codebooks on all rows and encode them.

    Rows whose vector is null or holds null or non-finite components are left
    out.  The commonest length that is a positive multiple of ``coding.parts``
    (of equally common ones the largest) is the one that is coded; rows of other
    lengths are kept with null code and error and count in nothing.  Entries
    start as the parts of the smallest ids, null ids last, equal ids by vector;
    fewer rows give fewer entries.  Repeated rows count each; an empty table
    gives no rows and no codebooks.  An error beyond 64 bits is null.  Extra
    columns stay as they are, but for those named ``code`` or ``error``.

    A round reads and writes each row once: vector, code and bounds.  What
    leaves a task is a few sums for each entry; the codebooks of all rounds are
    small by the parameters and go with the tasks.
    """
    kept = vectors.drop("code", "error").where(usable(F.col(vec_col)))
    plain, added = kept.schema.fields, [StructField("code", BinaryType()), StructField("error", LongType())]
    without = {f.name: F.lit(None).cast(f.dataType) for f in added}
    sizes = kept.select(F.size(vec_col).alias(_DIMS)).groupBy(_DIMS).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.where((F.col(_DIMS) > 0) & (F.col(_DIMS) % coding.parts == 0))
    common = sizes.orderBy(F.desc("n"), F.desc(_DIMS)).first()
    if common is None:
        return Codes(kept.withColumns(without), History(), [])
    fits = F.size(vec_col) == common[0]

    first = kept.where(fits)
    history = History([_first_books(first, id_col, vec_col, coding)])
    rows, computed = first, []
    for _ in range(coding.rounds + 1):
        before, step = rows, cut_lineage(_step(rows, vec_col, history, coding))
        rows = step.where(F.col(_SUMS).isNull()).drop(_SUMS)
        book, n = _moved_on(history.books[-1], _totals(step.where(F.col(_SUMS).isNotNull())))
        if before is not first:
            drop_cut(before)
        computed.append(n)
        if len(computed) <= coding.rounds:
            history.books.append(book)
    final = history.books[-1]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 8192):
                x, codes = _matrix(part.column(vec_col), coding), part.column(_CODE)
                code = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(-1, coding.parts)
                errors = sum(squared(x[:, p], final[p][code[:, p]]) for p in range(coding.parts)).tolist()
                error = pa.array([e if e < 1 << 63 else None for e in errors], pa.int64())
                names = [f.name for f in plain]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), codes, error], [*names, "code", "error"])
        give_back()

    out = rows.mapInArrow(finish, StructType([*(StructField(f.name, f.dataType) for f in plain), *added]))
    return Codes(out.unionByName(kept.where(~fits).withColumns(without)), history, computed)


def with_label_error(rows: DataFrame, label_col: str = "label") -> DataFrame:
    """``rows`` with ``label_error``: the sum of ``error`` over equal labels, nulls together.

    Sums are combined before they move, and there is a row for each label on the
    small side of the join.  Errors that are null count as none; a sum beyond 64
    bits is null.
    """
    wide = F.sum(F.col("error").cast("decimal(38,0)"))
    per = rows.groupBy(F.col(label_col).alias("__label")).agg(wide.try_cast("long").alias("label_error"))
    return rows.join(per, F.col(label_col).eqNullSafe(F.col("__label"))).drop("__label")


def coded(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", coding: Coding = Coding()) -> DataFrame:
    """``id_col, code`` in hexadecimal digits, ``error, label_error, codebooks_sha256``."""
    codes = encode(vectors.select(id_col, vec_col, label_col), id_col, vec_col, coding)
    done = cut_lineage(codes.rows.select(id_col, label_col, "code", "error"))
    return with_label_error(done, label_col).select(
        id_col, F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codes.codebooks_sha256).alias("codebooks_sha256")
    )
