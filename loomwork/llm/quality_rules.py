"""Line-first cleaning: rules fail lines, and documents that lose too much text are rejected."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .texts import SPACED, as_bytes, map_batches, words_of

# Phrases that site furniture uses, in the languages of the corpus.
BOILERPLATE = (
    "all rights reserved|privacy policy|terms of (use|service)|accept (all )?cookies|enable javascript"
    "|sign up for our newsletter|click here to|lorem ipsum"
    "|alle rechte vorbehalten|datenschutzerkl|nutzungsbedingungen"
    "|tous droits r|politique de confidentialit|mentions l"
    "|todos los derechos reservados|de privacidad|aviso legal"
)
PUNCTUATION = r"[!-/:-@\[-`{-~]"
SYMBOLS = "#*$%&|<>"

_PUNCT = re.compile(PUNCTUATION)
_BOILER = re.compile(BOILERPLATE, re.ASCII)
_SPACE = re.compile(r"[ \t-\r]+")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; all shares are in per cent.

    A line fails

    * by punctuation, if it has ``min_punctuation`` ASCII punctuation marks or
      more and they are over ``max_punctuation`` of its characters but white space,
    * as navigation, if it has ``min_bars`` bars or more and they are over
      ``max_bars`` of its white-space separated parts,
    * as boilerplate, if it has one of the fixed phrases and at most
      ``boilerplate_words`` words, or if ``min_stutter`` words or more, and over
      half of them, equal the word before.

    A document is rejected if lines that failed hold over ``max_loss`` of its
    characters but white space, or by its base measures: fewer words than
    ``min_words``, or over ``max_repeat`` of them in windows of ``window``
    words found twice or more.
    """

    min_punctuation: int = 4
    max_punctuation: int = 12
    min_bars: int = 3
    max_bars: int = 25
    boilerplate_words: int = 25
    min_stutter: int = 6
    max_loss: int = 50
    min_words: int = 20
    window: int = 8
    max_repeat: int = 30


def failed_rule(line: str, rules: Rules) -> str | None:
    """The first rule that the line fails."""
    marks = len(_PUNCT.findall(line))
    if marks >= rules.min_punctuation and 100 * marks > rules.max_punctuation * len(_SPACE.sub("", line)):
        return "punctuation"
    words, bars = line.encode().split(), line.count("|")
    if bars >= rules.min_bars and 100 * bars > rules.max_bars * len(words):
        return "navigation"
    if len(words) <= rules.boilerplate_words and _BOILER.search(line.lower()):
        return "boilerplate"
    stutter = sum(map(eq, words, words[1:]))
    if stutter >= rules.min_stutter and 2 * stutter > len(words):
        return "boilerplate"
    return None


def repeat_words(words: list, window: int) -> int:
    """Words inside windows that occur twice or more in ``words``."""
    runs = list(zip(*(words[i:] for i in range(window))))
    often = Counter(runs)
    covered, end = 0, 0
    for i, run in enumerate(runs):
        if often[run] > 1:
            covered += i + window - max(i, end)
            end = i + window
    return covered


def repeated(words, window: int) -> np.ndarray:
    """``repeat_words`` of every text of a batch.

    Equal windows have equal hashes, so only texts with an equal pair of
    hashes are looked at word by word.
    """
    out = np.zeros(len(words.bounds) - 1, np.int64)
    n = len(words.codes) - window + 1
    if n < 2:
        return out
    mixed = (words.codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(n, np.uint64)
    for i in range(window):
        hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[i : i + n]
    owner = words.owner
    inside = owner[:n] == owner[window - 1 :]
    text = owner[:n].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    key = np.where(inside, hashes ^ text, np.arange(n, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    for i in np.unique(owner[order[1:][same]]):
        out[i] = repeat_words(words.codes[words.bounds[i] : words.bounds[i + 1]].tolist(), window)
    return out


# Beside all columns of a caller's table, so named apart from them.
MEASURES = (
    ("n_words", LongType()), ("word_chars", LongType()), ("n_symbols", LongType()),
    ("n_dup_lines", LongType()), ("n_repeat_words", LongType()), ("lost_chars", LongType()),
    ("n_punctuation_lines", LongType()), ("n_navigation_lines", LongType()),
    ("n_boilerplate_lines", LongType()), ("base_failed", BooleanType()), ("kept", BooleanType()),
)


def _judge(texts: list[bytes], rules: Rules) -> tuple[dict[str, list], list[str]]:
    """The measures of each text, and what is left of it without the lines that failed."""
    words = words_of(texts, SPACED)
    repeats = repeated(words, rules.window).tolist()
    out: dict[str, list] = {name: [] for name, _ in MEASURES}
    left = []
    for data, n, repeat in zip(texts, words.lengths.tolist(), repeats):
        text = data.decode()
        seen, good, dup, lost = set(), [], 0, 0
        failed = {"punctuation": 0, "navigation": 0, "boilerplate": 0}
        for line in text.split("\n"):
            if line in seen:
                dup += bool(line.encode().split())
            seen.add(line)
            rule = failed_rule(line, rules)
            if rule is None:
                good.append(line)
            else:
                failed[rule] += 1
                lost += len(_SPACE.sub("", line))
        chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
        base = n < rules.min_words or 100 * repeat > rules.max_repeat * n
        row = (
            n, chars, sum(text.count(c) for c in SYMBOLS), dup, repeat, lost,
            *failed.values(), base, not base and 100 * lost <= rules.max_loss * chars,
        )
        for (name, _), value in zip(MEASURES, row):
            out[name].append(value)
        left.append("\n".join(good))
    return out, left


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``id_col`` and the measures of every row.

    Words are what is between ASCII white space; null text has none, and such
    documents, like empty ones, fail for want of words.  Each row is judged by
    itself, so repeated rows get equal results, and a table without rows gives
    none.  Only the two named columns are read.
    """
    rows = docs.select(id_col, text_col)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, _ = _judge(as_bytes(batch.column(1)), rules)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(v, pa.bool_() if isinstance(t, BooleanType) else pa.int64())
                                for v, (_, t) in zip(out.values(), MEASURES))],
            [id_col, *out],
        )

    return map_batches(rows, of, StructType([rows.schema[0], *(StructField(n, t) for n, t in MEASURES)]))


def clean(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", rules: Rules = Rules()) -> DataFrame:
    """The documents kept, without the lines that failed; all columns stay.

    ``length_col``, where the table has it, becomes the characters of the text
    that is left.  Rows whose text is null or empty go, like all with too few
    words.
    """
    names = docs.columns
    at, size_at = names.index(text_col), names.index(length_col) if length_col in names else None

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, left = _judge(as_bytes(batch.column(at)), rules)
        columns = list(batch.columns)
        columns[at] = pa.array(left, columns[at].type)
        if size_at is not None:
            columns[size_at] = pc.utf8_length(columns[at]).cast(columns[size_at].type)
        new = pa.RecordBatch.from_arrays(columns, batch.schema.names)
        return new.filter(pa.array(out["kept"], pa.bool_()))

    return map_batches(docs, of, docs.schema)
