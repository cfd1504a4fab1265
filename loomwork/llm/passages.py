"""Quality of documents by attention-based multiple-instance learning over their passages."""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from .texts import SPACED, Words, as_bytes, map_batches, words_of

# --- passages ----------------------------------------------------------------------------------

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation
N_PARTS = 4  # features of a word: its letters, what stands around them, its shape, its length
N_FACTS = 6


@dataclass(frozen=True)
class Settings:
    """Sizes of the model and how it is fitted.

    ``sample_docs`` bounds the labelled documents that it is fitted on: those
    with the smallest seeded hashes of their ids.
    """

    passage_words: int = 64
    buckets: int = 1 << 14
    width: int = 24
    attention: int = 16
    sample_docs: int = 4000
    epochs: int = 6
    batch_docs: int = 32
    rate: float = 0.01
    decay: float = 1e-5
    seed: int = 42


def type_features(types: list[bytes], buckets: int) -> np.ndarray:
    """Buckets of each distinct word's letters, of what stands around them, of its shape and of its length."""
    cores = [w.strip(_MARKS) for w in types]
    n = len(types)
    around = [w.replace(c, b" ", 1) if len(c) < len(w) else b"" for w, c in zip(types, cores)]
    seen = {a: crc32(b"around" + a[:12]) for a in set(around)}
    letters = np.fromiter((crc32(c.lower()) for c in cores), np.int64, n)
    marks = np.fromiter(map(seen.__getitem__, around), np.int64, n)
    shape = np.fromiter((2 * c[:1].isupper() + c[1:].isupper() + 4 * c.isdigit() for c in cores), np.int64, n)
    length = np.fromiter(map(len, cores), np.int64, n)
    # shapes and lengths are few; they share the buckets with the rest at places of their own
    return np.stack([letters, marks, crc32(b"shape") + shape, crc32(b"length") + np.minimum(length, 20)], axis=1) % buckets


@dataclass
class Bags:
    """Passages of some documents: the features of all words, and where passages and documents begin."""

    words: np.ndarray  # positions in ``types``
    types: np.ndarray  # features of each distinct word
    passages: np.ndarray  # bounds in words
    docs: np.ndarray  # bounds in passages
    facts: np.ndarray  # of each passage


def bags_of(words: Words, settings: Settings) -> Bags:
    """Cut every document into passages of ``passage_words`` words; one without words has one empty passage."""
    n_passages = np.maximum(1, -(-words.lengths // settings.passage_words))
    docs = np.concatenate([[0], np.cumsum(n_passages)])
    within = np.arange(docs[-1]) - np.repeat(docs[:-1], n_passages)
    begins = np.repeat(words.bounds[:-1], n_passages) + within * settings.passage_words
    passages = np.append(begins, words.bounds[-1])
    features = type_features(words.types.to_pylist(), settings.buckets)
    # facts about the passage as a whole
    codes, size = words.codes.astype(np.int64), np.diff(passages)
    owner = np.repeat(np.arange(len(size)), size)
    same = np.zeros(len(codes))
    if len(codes) > 1:
        same[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    n_types = max(1, len(features))
    distinct = np.unique(owner * n_types + codes) // n_types
    chars = np.asarray(pc.binary_length(words.types)).astype(float)[codes]
    some = np.maximum(size, 1)
    count = lambda w: np.bincount(owner, w, len(size)) / some
    facts = np.stack(
        [np.log1p(size) / 4, count(same), np.bincount(distinct, minlength=len(size)) / some, count(chars) / 10, size == 0, size < 8],
        axis=1,
    )
    return Bags(codes, features, passages, docs, facts.astype(np.float32))


# --- the model ---------------------------------------------------------------------------------


def _sums(rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the rows between bounds; empty ranges are zero."""
    out = np.zeros((len(bounds) - 1, *rows.shape[1:]), np.float32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = np.add.reduceat(rows, bounds[full], axis=0)
    return out


def new_model(s: Settings) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(s.seed)
    normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    return {
        "words": normal(s.buckets, s.width, scale=0.1),
        "facts": normal(N_FACTS, s.width, scale=0.3), "bias": np.zeros(s.width, np.float32),
        "v": normal(s.width, s.attention, scale=0.3), "u": normal(s.width, s.attention, scale=0.3),
        "w": normal(s.attention, scale=0.3), "out": normal(s.width, scale=0.3), "out_bias": np.zeros(1, np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def encode(model: dict, bags: Bags, at_once: int = 1 << 17) -> np.ndarray:
    """The vector of every passage: mean of its words' vectors, and its facts, squashed."""
    by_type = model["words"][bags.types].sum(axis=1) if len(bags.types) else np.zeros((0, model["words"].shape[1]), np.float32)
    size, parts, first = np.diff(bags.passages), [], 0
    while first < len(size):  # some passages at a time, to bound memory
        last = max(first + 1, int(np.searchsorted(bags.passages, bags.passages[first] + at_once, side="right")) - 1)
        lo, hi = bags.passages[first], bags.passages[last]
        parts.append(_sums(by_type[bags.words[lo:hi]], bags.passages[first : last + 1] - lo))
        first = last
    mean = np.concatenate(parts) / np.maximum(size, 1)[:, None]
    return np.tanh(mean + bags.facts @ model["facts"] + model["bias"])


def attend(model: dict, h: np.ndarray, docs: np.ndarray) -> dict[str, np.ndarray]:
    """Gated attention over each document's passages, and the score of the weighted vector."""
    t, g = np.tanh(h @ model["v"]), _sigmoid(h @ model["u"])
    e = (t * g) @ model["w"]
    size = np.diff(docs)
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, docs[:-1]), size))
    a = e / np.repeat(np.add.reduceat(e, docs[:-1]), size)
    z = np.add.reduceat(a[:, None] * h, docs[:-1], axis=0)
    return {"t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ model["out"] + model["out_bias"][0])}


def gradients(model: dict, bags: Bags, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted mean cross-entropy; that of the word vectors comes as rows and their sums."""
    h = encode(model, bags)
    s, size = attend(model, h, bags.docs), np.diff(bags.docs)
    d_logit = ((s["p"] - labels) * weights / weights.sum()).astype(np.float32)
    d_z = np.repeat(d_logit[:, None] * model["out"], size, axis=0)
    d_a = (d_z * h).sum(axis=1)
    mean = np.repeat(np.add.reduceat(s["a"] * d_a, bags.docs[:-1]), size)
    d_e = s["a"] * (d_a - mean)
    d_t = d_e[:, None] * model["w"] * s["g"] * (1 - s["t"] ** 2)
    d_g = d_e[:, None] * model["w"] * s["t"] * s["g"] * (1 - s["g"])
    d_h = s["a"][:, None] * d_z + d_t @ model["v"].T + d_g @ model["u"].T
    d_in = d_h * (1 - h**2)
    n = np.diff(bags.passages)
    rows = bags.types[bags.words].ravel()
    of = np.repeat(np.repeat(np.arange(len(n)), n), N_PARTS)
    order = np.argsort(rows, kind="stable")
    touched, begins = np.unique(rows[order], return_index=True)
    per_word = d_in / np.maximum(n, 1)[:, None]
    summed = np.add.reduceat(per_word[of[order]], begins, axis=0) if len(rows) else np.zeros((0, h.shape[1]), np.float32)
    return {
        "words": (touched, summed), "facts": bags.facts.T @ d_in, "bias": d_in.sum(axis=0),
        "v": h.T @ d_t, "u": h.T @ d_g, "w": (d_e[:, None] * s["t"] * s["g"]).sum(axis=0),
        "out": s["z"].T @ d_logit, "out_bias": d_logit.sum(keepdims=True),
    }


def fit(texts: list[bytes], labels: list[int], s: Settings) -> dict[str, np.ndarray]:
    """Adam on batches of documents in seeded order; classes weigh the same in the whole."""
    model, y = new_model(s), np.array(labels, np.float32)
    moment = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    rng, step = np.random.default_rng(s.seed), 0
    positive = max(1, int(y.sum()))
    class_weight = np.where(y > 0, len(y) / positive, len(y) / max(1, len(y) - positive)) / 2
    n = len(texts)
    batches = [np.arange(i, min(i + s.batch_docs, n)) for i in range(0, n, s.batch_docs)]
    bags = [bags_of(words_of([texts[i] for i in b], SPACED), s) for b in batches]
    for _ in range(s.epochs):
        for b in rng.permutation(len(batches)):
            step += 1
            grads = gradients(model, bags[b], y[batches[b]], class_weight[batches[b]])
            for k, g in grads.items():
                at, g = g if k == "words" else (slice(None), g)
                g = g + s.decay * model[k][at]
                moment[k][at] = 0.9 * moment[k][at] + 0.1 * g
                square[k][at] = 0.999 * square[k][at] + 0.001 * g * g
                up = moment[k][at] / (1 - 0.9**step) / (np.sqrt(square[k][at] / (1 - 0.999**step)) + 1e-8)
                model[k][at] -= s.rate * up
    return model


def pack(model: dict) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, **model)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as file:
        return {k: file[k] for k in file.files}


def score(model: dict, texts: list[bytes], s: Settings) -> np.ndarray:
    bags = bags_of(words_of(texts, SPACED), s)
    return attend(model, encode(model, bags), bags.docs)["p"].astype(float)


# --- Spark -------------------------------------------------------------------------------------


def held_out(id_col: str) -> Column:
    """Whether the remainder by 3 of the id's check sum is 1; a null id counts as no text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    settings: Settings = Settings(),
) -> dict[str, np.ndarray]:
    """A model from labelled documents that are not held out, at most ``sample_docs`` of them.

    One task fits it, on rows whose number is bounded; the driver gets the
    model, whose size is fixed.  Null labels are left out, and an id with
    several labels has the largest.  Without any labelled document the model is
    the one training starts from.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    order = F.xxhash64(F.lit(settings.seed), "id")
    chosen = known.orderBy(order, "id").limit(settings.sample_docs)
    # the sample's size is bounded, so it can go to every task
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for b in batches for r in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), b.column(2).to_pylist())]
        found.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r[0]), settings.seed), r[0]))
        model = fit([r[1] for r in found], [r[2] for r in found], settings)
        yield pa.RecordBatch.from_arrays([pa.array([pack(model)], pa.binary())], ["model"])

    fitted = rows.repartition(1).mapInArrow(run, "model binary").first()
    return unpack(fitted.model) if fitted else new_model(settings)


def predict(
    docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row, from its whole text.

    Null and empty texts are one passage without words and get that passage's
    score.  Repeated rows get equal results; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pack(model))  # its size is fixed by the settings
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    cache: dict[str, dict] = {}

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "model" not in cache:
            cache["model"] = unpack(shared.value)
        p = score(cache["model"], as_bytes(batch.column(2)), settings)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
            [id_col, "held_out", "score", "predicted"],
        )

    fields = [StructField("held_out", BooleanType()), StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    return map_batches(rows, of, StructType([rows.schema[0], *fields]))
