"""Cross-entropy difference of two matched n-gram models over one vocabulary."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .texts import SPACED_LOWER, Words, as_bytes, give_back, words_of


@dataclass(frozen=True)
class Settings:
    """Both models are bigram models with Dirichlet smoothing of the same strength.

    ``prior`` is how many observations the unigram model counts for in every
    context, and the background unigram model in the target's.  ``chunk_bytes``
    of text are counted and scored together, and ``chunks_per_shard`` chunks'
    worth of keys are summed up together.
    """

    prior: float = 10.0
    unigram_prior: float = 1000.0
    chunk_bytes: int = 4 << 20
    chunks_per_shard: int = 4
    seed: int = 42


KEY_BYTES = 6  # of a key; among 10**10 keys one in 28,000 meets another
_START = np.uint64(0x5851F42D4C957F2D)  # stands before the first word of every text


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def word_keys(words: Words, seed: int) -> np.ndarray:
    """The 64-bit hash that a word of the shared vocabulary goes by, of every word."""
    types = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.types.to_pylist()), np.uint64, len(words.types))
    return types[words.codes]


def contexts(words: Words, keys: np.ndarray) -> np.ndarray:
    """The key before each word; a text's first word has the start."""
    before = np.empty_like(keys)
    before[1:] = keys[:-1]
    before[words.bounds[:-1][words.lengths > 0]] = _START
    return before


def pair_keys(before: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return _mix(before * np.uint64(0x9E3779B97F4A7C15) + _mix(keys))


def _sum_by_key(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and each count summed over equal keys."""
    order = np.argsort(keys)
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[begins], *(np.add.reduceat(c[order], begins) if len(keys) else c for c in counts)


def short(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - 8 * KEY_BYTES)


def count(words: Words, in_target: np.ndarray, seed: int) -> tuple[np.ndarray, ...]:
    """Keys of words, starts and pairs in the texts: how often in target texts, and in all."""
    keys = word_keys(words, seed)
    target = in_target[words.owner].astype(np.int32)
    full = words.lengths > 0
    every = short(np.concatenate([keys, pair_keys(contexts(words, keys), keys), np.full(full.sum(), _START)]))
    of_target = np.concatenate([target, target, in_target[full].astype(np.int32)])
    return _sum_by_key(every, of_target, np.ones(len(every), np.int32))


def planes(x: np.ndarray, n_bytes: int) -> bytes:
    """The low bytes of all numbers, then the next ones and so on; the upper ones, mostly zero, pack well."""
    return np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :n_bytes].T.tobytes()


def numbers(data: bytes, n_bytes: int) -> np.ndarray:
    out = np.zeros((len(data) // n_bytes, 8), np.uint8)
    out[:, :n_bytes] = np.frombuffer(data, np.uint8).reshape(n_bytes, -1).T
    return out.view("<u8").ravel()


class Model:
    """Counts of both corpora for some keys."""

    def __init__(self, keys: np.ndarray, target: np.ndarray, background: np.ndarray, n_target: int, n_background: int):
        self.keys, self.counts = keys, (target, background)  # keys in order
        self.totals = n_target, n_background

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys))
        keys = short(keys)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return tuple(np.where(known, c[at], 0).astype(float) for c in self.counts)

    def losses(self, words: Words, s: Settings) -> tuple[np.ndarray, np.ndarray]:
        """Negative log probability of every word under the target and the background model."""
        distinct, place = np.unique(words.codes, return_inverse=True)
        types = Words(np.arange(len(distinct)), words.types.take(pa.array(distinct)), np.array([0, len(distinct)]))
        one_t, one_b = (c[place] for c in self.look_up(word_keys(types, s.seed)))
        keys = word_keys(words, s.seed)
        before = contexts(words, keys)
        context = self.look_up(np.unique(before))
        at = np.searchsorted(np.unique(before), before)
        context_t, context_b = (c[at] for c in context)
        pair_t, pair_b = self.look_up(pair_keys(before, keys))
        n_t, n_b = self.totals
        p_b = one_b / max(1, n_b)
        p_t = (one_t + s.unigram_prior * p_b) / (n_t + s.unigram_prior)
        target = (pair_t + s.prior * p_t) / (context_t + s.prior)
        background = (pair_b + s.prior * p_b) / (context_b + s.prior)
        return -np.log(target), -np.log(background)


_FIELDS = (
    StructField("n_tokens", LongType()), StructField("target_loss", DoubleType()),
    StructField("background_loss", DoubleType()), StructField("score", DoubleType()),
)


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).combine_chunks().to_pylist()


def difference(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``id_col, n_tokens, target_loss, background_loss, score`` for every row of ``docs``.

    The target model is of the rows of ``docs`` whose id is in ``target``, the
    background model of all rows, and both are over all words of ``docs`` with
    A-Z lowered.  Losses are in nats a word; ``score`` is their difference,
    negative where a text is more like the target.  Texts without words, null
    ones too, have 0 for all.  Null ids are in no target; repeated rows count
    as often as they are there, and get equal scores.

    Text is put into chunks by hash of id once, and stays there.  Each chunk
    counts its distinct words and pairs and sends them, packed, to shards of
    the key space; shards sum them up and send every chunk the sums for its own
    keys, in their order, with which it scores its texts.  No table of all keys
    is anywhere in one place, and a frequent pair is one entry for each chunk.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    wanted = target.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    sizes = rows.select("id", F.octet_length("text").alias("size"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n"))
    marked = sizes.join(wanted.withColumn("in_target", F.lit(True)), "id", "left")
    total = marked.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("n"), F.lit(0)).alias("all"),
        F.coalesce(F.sum(F.when(F.col("in_target"), F.col("n"))), F.lit(0)).alias("target"),
    ).first()
    n_target, n_all, n_chunks = total.target, total["all"], total.bytes // settings.chunk_bytes + 1
    chunk = F.pmod(F.xxhash64("id"), F.lit(n_chunks)).cast("int").alias("chunk")
    texts, ids = rows.select("id", "text", chunk), wanted.select("id", chunk)

    n_shards = n_chunks // settings.chunks_per_shard + 1

    def counted(docs_of: pa.Table, target_of: pa.Table) -> tuple:
        words = words_of(as_bytes(docs_of.column("text").combine_chunks()), SPACED_LOWER)
        marked = set(_column(target_of, "id")) if target_of is not None else set()
        in_target = np.array([i in marked for i in _column(docs_of, "id")], bool)
        return words, *count(words, in_target, settings.seed)

    def count_chunk(key: tuple, docs_of: pa.Table, target_of: pa.Table) -> pa.Table:
        give_back()
        _, keys, t, b = counted(docs_of, target_of)
        shard = (keys >> np.uint64(8 * KEY_BYTES - 32)).astype(np.int64) * n_shards >> 32  # in order of the keys
        shards, begins = np.unique(shard, return_index=True)
        cuts = [slice(i, j) for i, j in zip(begins, [*begins[1:], len(keys)])]
        blobs = (
            [planes(np.diff(keys[c], prepend=np.uint64(0)), KEY_BYTES) for c in cuts],
            [planes(t[c], 4) for c in cuts], [planes(b[c], 4) for c in cuts],
        )
        return pa.table([pa.array(shards, pa.int32()), pa.array([key[0].as_py()] * len(shards), pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)],
                        names=["shard", "chunk", "keys", "target", "background"])

    def sum_shard(key: tuple, parts: pa.Table) -> pa.Table:
        give_back()
        each = [np.cumsum(numbers(x, KEY_BYTES)) for x in _column(parts, "keys")]
        t, b = (np.concatenate([numbers(x, 4) for x in _column(parts, c)]).astype(np.int64) for c in ("target", "background"))
        keys = np.concatenate(each)
        distinct, t, b = _sum_by_key(keys, t, b)
        at, cuts = np.searchsorted(distinct, keys), np.cumsum([len(x) for x in each])[:-1]
        sums = [[planes(x, 6) for x in np.split(c[at], cuts)] for c in (t, b)]
        return pa.table([parts.column("chunk"), parts.column("shard"), *(pa.array(s, pa.binary()) for s in sums)],
                        names=["chunk", "shard", "target", "background"])

    def score_chunk(key: tuple, docs_of: pa.Table, sums: pa.Table) -> pa.Table:
        give_back()
        words, keys, _, _ = counted(docs_of, None)
        sums = sums.sort_by("shard")
        totals = [np.concatenate([np.zeros(0, np.uint64), *(numbers(x, 6) for x in _column(sums, c))]) for c in ("target", "background")]
        model = Model(keys, *totals, n_target, n_all)
        n, out = words.lengths, []
        for loss in model.losses(words, settings):
            mean, full = np.zeros(len(n)), np.flatnonzero(n)
            if len(full):
                mean[full] = np.add.reduceat(loss, words.bounds[full]) / n[full]
            out.append(mean)
        return pa.table([docs_of.column("id"), pa.array(n), pa.array(out[0]), pa.array(out[1]), pa.array(out[0] - out[1])],
                        names=[id_col, *(f.name for f in _FIELDS)])

    counts = texts.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(
        count_chunk, "shard int, chunk int, keys binary, target binary, background binary"
    )
    sums = counts.groupBy("shard").applyInArrow(sum_shard, "chunk int, shard int, target binary, background binary")
    return texts.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInArrow(
        score_chunk, StructType([StructField(id_col, LongType()), *_FIELDS])
    )
