"""License texts in documents: MinHash over windows retrieves templates, shingle containment decides."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .decontaminate import WORDS
from .texts import Words, as_bytes, map_batches, words_of

# Notices and terms of public licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
     " compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
     " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed"
     " on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for"
     " the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the"
     " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
     " persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice"
     " and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
     " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
     " later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
     " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any"
     " later version."),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
     " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
     " option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser"
     " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
     " option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
     " General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your"
     " option) any later version."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
     " General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your"
     " option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
     " 2.0 which is available at"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
     " the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
     " conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,"
     " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
     " distribution."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
     " granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
     " was not distributed with this file, You can obtain one at"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
     " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any"
     " purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"
     " License"),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0"
     " International License"),
)

_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)  # larger than any hash, so no minimum


@dataclass(frozen=True)
class Settings:
    """A template is found where ``contained`` of its distinct shingles lie within
    ``stretch`` times its length; bands are as many as retrieve such a place with
    probability ``at_least`` or more."""

    shingle: int = 5
    contained: float = 0.8
    stretch: float = 1.25
    at_least: float = 0.999
    rows: int = 1
    seed: int = 42


class Template(NamedTuple):
    name: str
    words: list[bytes]
    shingles: np.ndarray  # distinct hashes
    run: int  # shingles in a row that may hold it


class Level(NamedTuple):
    """Windows of ``size`` shingles that begin every ``size // 4``, and the templates looked for there."""

    size: int
    bands: int
    templates: list[int]


def collision_probability(jaccard: float, bands: int, rows: int) -> float:
    return 1 - (1 - jaccard**rows) ** bands


def bands_for(jaccard: float, rows: int, at_least: float) -> int:
    """Fewest bands of ``rows`` rows that let sets this similar meet with the probability asked for."""
    return math.ceil(math.log(1 - at_least) / math.log(1 - jaccard**rows)) if jaccard < 1 else 1


def shingle_hashes(words: Words, n: int) -> np.ndarray:
    """A hash for the ``n`` words from each position on; ``_LAST`` where the text has fewer left."""
    total = len(words.codes)
    out = np.full(total, _LAST)
    if total < n:
        return out
    one = np.fromiter((xxhash.xxh64_intdigest(w) for w in words.types.to_pylist()), np.uint64, len(words.types))[words.codes]
    run = np.zeros(total - n + 1, np.uint64)
    for i in range(n):
        run = run * np.uint64(0x9E3779B97F4A7C15) + one[i : i + len(run)]
    run ^= run >> np.uint64(31)
    run *= np.uint64(0xBF58476D1CE4E5B9)
    run ^= run >> np.uint64(29)
    owner = words.owner
    out[: len(run)] = np.where(owner[: len(run)] == owner[n - 1 :], run, _LAST)
    return out


class Index:
    """Templates by their MinHash bands."""

    def __init__(self, templates, settings: Settings):
        self.settings = settings
        self.templates: list[Template] = []
        levels: dict[int, Level] = {}
        for i, (name, text) in enumerate(templates):
            words = words_of([text.encode()], WORDS)
            hashes = shingle_hashes(words, settings.shingle)
            shingles = np.unique(hashes[hashes != _LAST])
            if not len(shingles):
                raise ValueError(f"template {i} has fewer than {settings.shingle} words")
            run = math.ceil(settings.stretch * len(shingles))
            size = 4
            while size - size // 4 + 1 < run:
                size *= 2
            least = settings.contained * len(shingles) / (size + (1 - settings.contained) * len(shingles))
            bands = bands_for(least, settings.rows, settings.at_least)
            old = levels.get(size, Level(size, 0, []))
            levels[size] = Level(size, max(old.bands, bands), [*old.templates, i])
            plain = [w.as_py() for w in words.types.take(pa.array(words.codes))]
            self.templates.append(Template(name, plain, shingles, run))
        self.levels = [levels[s] for s in sorted(levels)]
        # licenses of which one's text alone would pass for the other's
        self.rivals = {
            (a.name, b.name)
            for a in self.templates
            for b in self.templates
            if a.name != b.name
            and len(np.intersect1d(a.shingles, b.shingles)) >= settings.contained * min(len(a.shingles), len(b.shingles)) - 1e-12
        }
        rng = np.random.default_rng(settings.seed)
        n = max(level.bands for level in self.levels) * settings.rows
        self.odd = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 1 << 63, n, np.uint64)
        # for each level and band: values of templates, with a table of their upper bits to look at first
        self.keys = {(level.size, b): self._keys(level, b) for level in self.levels for b in range(level.bands)}

    def hashed(self, shingles: np.ndarray, k: int) -> np.ndarray:
        return np.where(shingles == _LAST, _LAST, (shingles ^ self.add[k]) * self.odd[k])

    def _keys(self, level: Level, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = range(band * self.settings.rows, (band + 1) * self.settings.rows)
        values = [band_key([self.hashed(self.templates[t].shingles, k).min(keepdims=True) for k in rows])[0] for t in level.templates]
        table = np.zeros(1 << 16, bool)
        keys = np.array(values, np.uint64)
        table[keys >> np.uint64(48)] = True
        order = np.argsort(keys)
        return table, keys[order], np.array(level.templates)[order]

    def candidates(self, shingles: np.ndarray) -> dict[tuple[int, int], set[int]]:
        """(level size, template) -> windows that share a band with it."""
        found: dict[tuple[int, int], set[int]] = {}
        largest, rows = self.levels[-1].size, self.settings.rows
        padded = np.concatenate([shingles, np.full(largest + largest // 4, _LAST)])
        bands = max(level.bands for level in self.levels)
        wanted = {level.size: level for level in self.levels}
        for band in range(bands):
            minima = [self.hashed(padded, k) for k in range(band * rows, (band + 1) * rows)]
            minima = [np.minimum(m[:-1], m[1:]) for m in minima]
            minima = [np.minimum(m[:-2], m[2:]) for m in minima]
            size = 4
            while True:
                if size in wanted and band < wanted[size].bands:
                    self._look_up(found, size, band, band_key(minima))
                size *= 2
                if size > largest:
                    break
                minima = [np.minimum(m[::2][:-2], m[::2][2:]) for m in minima]
        return found

    def _look_up(self, found: dict, size: int, band: int, keys: np.ndarray) -> None:
        table, values, templates = self.keys[size, band]
        maybe = np.flatnonzero(table[keys >> np.uint64(48)])
        lo, hi = np.searchsorted(values, keys[maybe]), np.searchsorted(values, keys[maybe], side="right")
        for window, a, b in zip(maybe[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
            for t in templates[a:b].tolist():
                found.setdefault((size, t), set()).add(window)


def band_key(minima: list[np.ndarray]) -> np.ndarray:
    key = minima[0]
    for m in minima[1:]:
        key = key * np.uint64(0x94D049BB133111EB) + m
    return key


class Match(NamedTuple):
    license: str
    containment: float
    first_word: int
    n_words: int


def best_run(codes: list[int], wanted: set[tuple], run: int, n: int) -> tuple[int, int, int]:
    """Most distinct wanted shingles within ``run`` shingles in a row; from where to where they are."""
    at = [i for i in range(len(codes) - n + 1) if tuple(codes[i : i + n]) in wanted]
    best, left, held = (0, 0, 0), 0, {}
    for i in at:
        s = tuple(codes[i : i + n])
        held[s] = held.get(s, 0) + 1
        while i - at[left] >= run:
            gone = tuple(codes[at[left] : at[left] + n])
            held[gone] -= 1
            if not held[gone]:
                del held[gone]
            left += 1
        if len(held) > best[0]:
            best = len(held), at[left], i
    return best


def find(texts: list[bytes], index: Index) -> list[list[Match]]:
    """Matches in every text, by place; of overlapping ones of a license the fullest."""
    n = index.settings.shingle
    words = words_of(texts, WORDS)
    out: list[list[Match]] = [[] for _ in texts]
    for (size, t), windows in index.candidates(shingle_hashes(words, n)).items():
        template = index.templates[t]
        known = pc.fill_null(pc.index_in(pa.array(template.words, pa.large_binary()), value_set=words.types), -1).to_pylist()
        wanted = {tuple(known[i : i + n]) for i in range(len(known) - n + 1)}
        step = size // 4
        for window in sorted(windows):
            begin, end = window * step, window * step + size + n - 1
            first = int(np.searchsorted(words.bounds, begin, side="right")) - 1
            for doc in range(first, len(texts)):  # a window may reach over texts
                lo, hi = max(begin, int(words.bounds[doc])), min(end, int(words.bounds[doc + 1]))
                if words.bounds[doc] >= end:
                    break
                if hi - lo < n:
                    continue
                count, a, b = best_run(words.codes[lo:hi].tolist(), wanted, template.run, n)
                share = count / len(template.shingles)
                if share >= index.settings.contained - 1e-12:
                    out[doc].append(Match(template.name, share, lo + a - int(words.bounds[doc]), b - a + n))
    return [_fullest(m) for m in out]


def _fullest(matches: list[Match]) -> list[Match]:
    kept: list[Match] = []
    for m in sorted(set(matches), key=lambda m: (-m.n_words * m.containment, m.first_word, m.license)):
        if not any(
            k.license == m.license and k.first_word < m.first_word + m.n_words and m.first_word < k.first_word + k.n_words
            for k in kept
        ):
            kept.append(m)
    return sorted(kept, key=lambda m: (m.first_word, m.license))


def decided(matches: list[Match], index: Index) -> list[Match]:
    """Without matches that a fuller one of a rival license overlaps by half or more; equally full ones stay."""
    kept: list[Match] = []
    for m in sorted(matches, key=lambda m: -m.containment):
        if not any(
            (k.license, m.license) in index.rivals
            and k.containment > m.containment + 1e-12
            and 2 * (min(k.first_word + k.n_words, m.first_word + m.n_words) - max(k.first_word, m.first_word)) >= min(k.n_words, m.n_words)
            for k in kept
        ):
            kept.append(m)
    return sorted(kept, key=lambda m: (m.first_word, m.license))


_MATCH = StructType([
    StructField("license", StringType()), StructField("containment", DoubleType()),
    StructField("first_word", LongType()), StructField("n_words", LongType()),
])


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, settings: Settings = Settings()
) -> DataFrame:
    """``id_col, n_matches, licenses, matches`` for every row.

    ``licenses`` are the names found, sorted and comma-joined (empty if none),
    and ``matches`` says where in the text's words each was found and how much
    of its template.  Of licenses that differ in few words, such as versions,
    the fullest at a place counts.  Null and empty texts, and those shorter than a shingle,
    have no match; repeated rows get equal results; other columns are not
    looked at.  Nothing is shuffled: templates are few and fixed.
    """
    index = Index(templates, settings)
    rows = docs.select(id_col, text_col)
    kind = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())]))

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [decided(m, index) for m in find(as_bytes(batch.column(1)), index)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array([len(m) for m in found], pa.int64()),
                pa.array([",".join(sorted({x.license for x in m})) for m in found], pa.string()),
                pa.array([[x._asdict() for x in m] for m in found], kind),
            ],
            [id_col, "n_matches", "licenses", "matches"],
        )

    fields = [StructField("n_matches", LongType()), StructField("licenses", StringType()), StructField("matches", ArrayType(_MATCH))]
    return map_batches(rows, of, StructType([rows.schema[0], *fields]))
