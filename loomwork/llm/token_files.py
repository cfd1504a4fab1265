"""Token ids in directly addressable files.

Every id is cut into chunks of bits.  Level 0 holds the lowest chunk of every
id, level 1 the next chunk of those ids that need one, and so on.  A bitmap
beside each level says which of its entries go on, and a rank directory counts
the bits set before each block of the bitmap, so the place of an entry on the
next level is one look-up away: any token is read without decoding others.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..storage import cut_lineage, new_path
from .texts import give_back, slices

# The file format.
MAGIC = b"DACTOK01"
RANK_BLOCK = 512  # bits of bitmap for each entry of the rank directory
WIDTHS = (8, 8, 16)  # bits of each level's chunks


# --- the code itself ---------------------------------------------------------------------------


def encode_levels(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> list[dict[str, np.ndarray]]:
    """Chunks, bitmap and rank directory of each level."""
    rest, levels = ids.astype(np.uint32, copy=False), []
    for i, width in enumerate(widths):
        kind = np.uint8 if width <= 8 else np.uint16 if width <= 16 else np.uint32
        chunks = (rest & np.uint32((1 << width) - 1)).astype(kind)
        if i == len(widths) - 1:
            if width < 32 and (rest >> np.uint32(width)).any():
                raise ValueError(f"an id needs more than {sum(widths)} bits")
            levels.append({"chunks": chunks, "bits": np.zeros(0, np.uint8), "ranks": np.zeros(0, np.uint64)})
            break
        on = rest >= np.uint32(1 << width)
        padded = np.zeros(-(-len(on) // RANK_BLOCK) * RANK_BLOCK, bool)
        padded[: len(on)] = on
        per_block = padded.reshape(-1, RANK_BLOCK).sum(axis=1)
        ranks = np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint64)
        levels.append({"chunks": chunks, "bits": np.packbits(padded, bitorder="little"), "ranks": ranks})
        rest = rest[on] >> np.uint32(width)
    return levels


def write_file(out, doc_ids: list, bounds: np.ndarray, ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> None:
    """One file: header, document directory, levels."""
    known = np.array([d is not None for d in doc_ids], bool)
    sections: list[np.ndarray] = [
        np.array([0 if d is None else d for d in doc_ids], np.int64), known.view(np.uint8), bounds.astype(np.uint64),
    ]
    names = ["doc_ids", "known", "bounds"]
    for i, level in enumerate(encode_levels(ids, widths)):
        for name, array in level.items():
            names.append(f"{name}{i}")
            sections.append(array)
    places, at = {}, 0
    for name, array in zip(names, sections):
        places[name] = [at, len(array), array.dtype.str]
        at += -(-array.nbytes // 8) * 8
    header = json.dumps({"widths": widths, "sections": places}).encode()
    header += b" " * (-len(header) % 8)
    out.write(MAGIC + len(header).to_bytes(8, "little") + header)
    for array in sections:
        out.write(array.tobytes() + bytes(-array.nbytes % 8))


class TokenFile:
    """Random access to a file; only the bytes asked for are read."""

    def __init__(self, file):
        self.file = file
        head = file.read_at(16, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(head[8:], "little")
        meta = json.loads(file.read_at(size, 16))
        self.widths, self.sections, self.start = meta["widths"], meta["sections"], 16 + size

    def part(self, name: str, lo: int = 0, hi: int | None = None) -> np.ndarray:
        at, count, kind = self.sections[name]
        hi, item = count if hi is None else min(hi, count), np.dtype(kind).itemsize
        if hi <= lo:
            return np.zeros(0, kind)
        return np.frombuffer(self.file.read_at((hi - lo) * item, self.start + at + lo * item), kind)

    def rank(self, level: int, i: int) -> int:
        """Bits set before position ``i`` of the level's bitmap."""
        block = i // RANK_BLOCK
        bits = self.part(f"bits{level}", block * RANK_BLOCK // 8, -(-i // 8))
        tail = np.unpackbits(bits, bitorder="little")[: i - block * RANK_BLOCK]
        return int(self.part(f"ranks{level}", block, block + 1)[0]) + int(tail.sum())

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """Ids of the tokens ``lo`` to ``hi - 1``: on every level they lie side by side."""
        out, rows, shift = np.zeros(max(0, hi - lo), np.uint32), None, 0
        for level, width in enumerate(self.widths):
            chunks = self.part(f"chunks{level}", lo, hi).astype(np.uint32) << np.uint32(shift)
            if rows is None:
                out[:] = chunks
                rows = np.arange(len(out))
            else:
                out[rows] |= chunks
            if level == len(self.widths) - 1 or hi <= lo:
                break
            first = lo // 8 * 8
            bits = np.unpackbits(self.part(f"bits{level}", lo // 8, -(-hi // 8)), bitorder="little")[lo - first : hi - first]
            rows = rows[bits.astype(bool)]
            lo = self.rank(level, lo)
            hi = lo + len(rows)
            shift += width
        return out

    def documents(self) -> tuple[list, np.ndarray]:
        """Document ids, and where each document begins; the last bound is the end."""
        ids, known = self.part("doc_ids").tolist(), self.part("known").tolist()
        return [d if k else None for d, k in zip(ids, known)], self.part("bounds").astype(np.int64)


# --- encoding texts ----------------------------------------------------------------------------

# A space before one of these begins a new pre-token of the byte-level pattern,
# whatever stands before it, so texts can be cut there and put together there.
_CUT = regex.compile(r" (?=[\p{L}\p{N}\p{P}\p{S}])")
_PLAIN = regex.compile(r"[\p{L}\p{N}\p{P}\p{S}]")


class PieceEncoder:
    """Encodes texts with a byte-level tokenizer, each distinct piece once.

    A piece is a word with the space before it; the piece a text begins with has
    none and is of a kind of its own.  Pieces seen are remembered until there
    are ``remember`` of them; then it starts afresh.
    """

    def __init__(self, path: str, remember: int = 600_000, joined_chars: int = 1 << 10):
        self.tokenizer = Tokenizer.from_file(path)
        self.remember, self.joined_chars = remember, joined_chars
        vocabulary = self.tokenizer.get_vocab()  # a character of a token is a byte of text
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.inner: dict[str, int] = {}  # places in the arrays below
        self.first: dict[str, int] = {}
        self.sizes, self.begins, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _tokens(self, texts: list[str], at_once: int = 256) -> list[np.ndarray]:
        """Ids of each text; what the library returns is much larger, so some texts at a time."""
        out: list[np.ndarray] = []
        for i in range(0, len(texts), at_once):
            some = self.tokenizer.encode_batch_fast(texts[i : i + at_once], add_special_tokens=False)
            out += [np.array(e.ids, np.uint32) for e in some]
        return out

    def _add(self, known: dict[str, int], pieces: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        known.update(zip(pieces, range(len(self.sizes), len(self.sizes) + len(pieces))))
        begins = np.cumsum(sizes) - sizes + len(self.ids)
        self.sizes, self.begins = np.concatenate([self.sizes, sizes]), np.concatenate([self.begins, begins])
        self.ids = np.concatenate([self.ids, ids])

    def _learn(self, pieces: list[str], lengths: np.ndarray) -> None:
        """Encode new pieces together, each after a space, and cut them apart by their bytes."""
        per = max(1, self.joined_chars * len(pieces) // max(1, int(lengths.sum())))
        tokens = self._tokens([" " + " ".join(pieces[i : i + per]) for i in range(0, len(pieces), per)])
        ids = np.concatenate([np.zeros(0, np.uint32), *tokens])
        piece_ends, token_ends = np.cumsum(lengths + 1), np.cumsum(self.token_bytes[ids])
        places = np.searchsorted(token_ends, piece_ends)
        if len(pieces) and not np.array_equal(token_ends[places], piece_ends):
            raise ValueError("a token reaches over two pieces: not a byte-level tokenizer")
        self._add(self.inner, pieces, np.diff(places + 1, prepend=0), ids)

    def _inner(self, pieces: list[str], lengths: np.ndarray) -> np.ndarray:
        """Places of different pieces that follow a space; new ones are learned."""
        found = list(map(self.inner.get, pieces))
        new = [i for i, place in enumerate(found) if place is None]
        if new:
            at = len(self.sizes)
            self._learn([pieces[i] for i in new], lengths[new])
            for i, place in zip(new, range(at, at + len(new))):
                found[i] = place
        return np.array(found, np.int64)

    def _first(self, pieces: list[str]) -> np.ndarray:
        new = list(dict.fromkeys(p for p in pieces if p not in self.first))
        if new:
            tokens = self._tokens(new)
            self._add(self.first, new, np.array([len(t) for t in tokens]), np.concatenate(tokens))
        return np.fromiter(map(self.first.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has.

        Arrow cuts the texts and finds their different pieces; only these are looked up.
        """
        if len(self.sizes) > self.remember:
            self._forget()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lists = pc.split_pattern(texts, " ")
        flat, bounds = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
        later = np.ones(len(flat), bool)
        later[bounds[:-1]] = False
        inner = flat.filter(pa.array(later)).dictionary_encode()
        types, codes = inner.dictionary, np.asarray(inner.indices)
        strange = _strange(types)
        if strange.any():  # spaces that don't begin a piece; these are never remembered
            places = np.full(len(types), -1)
            plain = types.filter(pa.array(~strange))
            places[~strange] = self._inner(plain.to_numpy(zero_copy_only=False).tolist(), _bytes_of(plain))
        else:
            places = self._inner(types.to_numpy(zero_copy_only=False).tolist(), _bytes_of(types))
        used, per_text = np.empty(len(flat), np.int64), np.diff(bounds)
        used[later] = places[codes]
        used[bounds[:-1]] = self._first(flat.take(pa.array(bounds[:-1])).to_pylist())
        if strange.any():
            owner = np.repeat(np.arange(len(texts)), per_text - 1)
            with_care = {i: self._cut_with_care(texts[i].as_py()) for i in np.unique(owner[strange[codes]]).tolist()}
            parts = [with_care.get(i, used[a:b]) for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist()))]
            used, per_text = np.concatenate(parts), np.array([len(p) for p in parts])
        sizes = self.sizes[used]
        ends = np.cumsum(sizes)
        at = np.repeat(self.begins[used] - (ends - sizes), sizes)
        at += np.arange(len(at))
        text_ends = np.concatenate([[0], ends])[np.cumsum(per_text)]
        return self.ids[at], np.diff(text_ends, prepend=0)

    def _cut_with_care(self, text: str) -> np.ndarray:
        """Places of the pieces of a text with spaces that don't begin one."""
        first, *rest = _CUT.split(text)
        different = list(dict.fromkeys(rest))
        places = dict(zip(different, self._inner(different, np.array([len(p.encode()) for p in different], np.int64)).tolist()))
        return np.array([int(self._first([first])[0]), *(places[p] for p in rest)], np.int64)


def _bytes_of(pieces: pa.Array) -> np.ndarray:
    return np.asarray(pc.binary_length(pieces)).astype(np.int64)


def _strange(pieces: pa.Array) -> np.ndarray:
    """Whether a space before a piece does not begin a pre-token."""
    offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
    data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
    first = np.append(data, np.uint8(0))[offsets[:-1]]
    # ASCII marks, digits and letters do; the rest is looked at one by one
    out = (first < 0x21) | (first > 0x7E) | (np.diff(offsets) == 0)
    for i in np.flatnonzero(out).tolist():
        out[i] = not _PLAIN.match(pieces[i].as_py())
    return out


@lru_cache(maxsize=1)
def encoder_of(path: str) -> PieceEncoder:
    """One for all tasks that a worker runs."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core, and each thread memory of its own
    return PieceEncoder(path)


# --- Spark -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """``end_id`` is appended to every document; a file is closed once it has ``file_tokens``."""

    end_id: int = 0
    file_tokens: int = 4_000_000
    widths: tuple[int, ...] = WIDTHS


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", layout: Layout = Layout()
) -> DataFrame:
    """Encode all texts into files under ``folder``; returns the manifest.

    Documents are in ascending order of id over all files; null ids come first,
    and rows with equal ids by hash of the text.  Null text counts as empty and
    has the end id only.  The manifest has ``place`` (order of the file), path
    and numbers of documents and tokens.  A task that is run again writes files
    of other names; only those of tasks that Spark accepted are in the manifest.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["id", F.xxhash64("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        encoder = encoder_of(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        ids: list = []
        tokens: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            name = f"{base}/{part:06d}-{seq:06d}-{uuid.uuid4().hex}.dac"
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            every = np.concatenate(tokens)
            tokens.clear()
            with fs.open_output_stream(name) as out:
                write_file(out, ids, bounds, every, layout.widths)
            cells = ([part], [seq], [name], [len(ids)], [int(bounds[-1])])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cells, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                ["part", "seq", "path", "n_docs", "n_tokens"],
            )

        fs.create_dir(base, recursive=True)
        held = 0
        for batch in batches:
            for some in slices(batch, 1, 1024, 2 << 20):
                flat, n = encoder.encode(some.column(1))
                with_end = np.insert(flat, np.cumsum(n), layout.end_id)
                ids += some.column(0).to_pylist()
                tokens.append(with_end)
                sizes.append(n + 1)
                held += len(with_end)
                if held >= layout.file_tokens:
                    yield close()
                    ids, tokens, sizes, held, seq = [], [], [], 0, seq + 1
        if ids:
            yield close()
        give_back()

    written = sorted_rows.mapInArrow(save, "part int, seq int, path string, n_docs long, n_tokens long")
    manifest = cut_lineage(written)
    # one row per file of some million tokens, and numbers only
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame, folder: str, tokens_per_task: int = 16_000_000) -> DataFrame:
    """Per document from the files: ``doc_id, start, n_tokens, ids_crc32, ids binary``.

    ``ids`` are little-endian unsigned 32-bit integers; Spark does not ask for
    them where they are not used later, but they are read either way, as the
    check sum needs them.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(path) as file:
                    code = TokenFile(file)
                    doc_ids, bounds = code.documents()
                    for first in range(0, len(doc_ids), 1024):
                        last = min(first + 1024, len(doc_ids))
                        ids = code.tokens(int(bounds[first]), int(bounds[last])).astype("<u4")
                        cut = bounds[first : last + 1] - bounds[first]
                        data = [ids[a:b].tobytes() for a, b in zip(cut, cut[1:])]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(doc_ids[first:last], pa.int64()), pa.array(bounds[first:last] + start, pa.int64()),
                                pa.array(np.diff(cut), pa.int64()), pa.array([zlib.crc32(d) for d in data], pa.int64()),
                                pa.array(data, pa.binary()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                        )

    total = manifest.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first().n
    files = manifest.select("path", "start", "part", "seq").repartition(total // tokens_per_task + 1, "part", "seq")
    return files.mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", layout: Layout = Layout()) -> DataFrame:
    """Write all documents to a new folder in the shared one and read the files back."""
    folder = new_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer, id_col, text_col, layout), folder)
