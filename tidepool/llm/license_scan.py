"""Licence scan: TF-IDF cosine to templates, then inheritance from directories.

1. Document frequencies of hashed terms over all files (a table of fixed
   size, as in feature hashing) give the weights.
2. Every line of every file (long ones in overlapping windows) is compared to
   the templates by cosine, and so are every file as a whole and every run of
   words as long as a template, across line ends. Vectors are sparse: a text
   without one of a template's heaviest terms cannot reach the threshold and
   is not weighed at all. Sums over all runs bound their cosines from above;
   only runs that may be the best so far are weighed exactly.
3. A file that is mostly a licence, by its whole-file cosine or by its name,
   speaks for its directory. A file without a licence of its own inherits that
   of the nearest directory above it that has one. The nearest ancestor is
   found once for each directory, by joins on path prefixes, and then joined
   to the files of that directory.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches, utf8_values
from tidepool.llm.repeats import KEYED, KEYED_DDL, folded, pack, unpack
from tidepool.session import materialize

LETTERS = re.compile(rb"[a-z0-9\x80-\xff]+")

TERM_BITS = 20
SLICES = 16
THRESHOLD = 0.6
FILE_THRESHOLD = 0.6
WINDOW = 64

# Short notices by which works name their licence, by SPDX identifier.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, "
                     "are permitted under the BSD 3-Clause License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons "
                  "Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright. Released under CC0 1.0."],
    "Proprietary": ["All rights reserved."],
}

# Headers of source files; the full texts are in the folder ``licences``.
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} "
        "General Public License as published by the Free Software Foundation, either version {1} of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU {0} General Public License for more details.")
HEADERS = {
    "GPL-3.0": [_GNU.format("", "3")],
    "GPL-2.0": [_GNU.format("", "2")],
    "LGPL-3.0": [_GNU.format("Lesser", "3"), "GNU Lesser General Public License, version 3"],
    "LGPL-2.1": [_GNU.format("Lesser", "2.1"), "GNU Lesser General Public License, version 2.1"],
    "AGPL-3.0": [_GNU.format("Affero", "3"), "This work is licensed under the GNU Affero General Public License, "
                 "version 3.", "GNU Affero General Public License, version 3"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International Public License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International Public License"],
}

# What the words of a match must hold, so that near templates are told apart.
REQUIRED = {name: re.compile(pattern) for name, pattern in {
    "MIT": rb"\bmit\b|permission is hereby granted free of charge",
    "ISC": rb"\bisc\b|permission to use copy modify and (or )?distribute",
    "Apache-2.0": rb"\bapache\b",
    "GPL-3.0": rb"(?<!affero )(?<!lesser )general public license.{0,80}?\bv?3\b",
    "GPL-2.0": rb"(?<!affero )(?<!lesser )general public license.{0,80}?\bv?2\b",
    "LGPL-3.0": rb"lesser general public license.{0,80}?\bv?3\b",
    "LGPL-2.1": rb"lesser general public license.{0,80}?\bv?2 1\b",
    "AGPL-3.0": rb"affero general public license.{0,80}?\bv?3\b",
    "BSD-3-Clause": rb"\bbsd 3|neither the names? of",
    "BSD-2-Clause": rb"\bbsd 2|redistributions in binary form",
    "MPL-2.0": rb"mozilla public license",
    "CC-BY-4.0": rb"\bcc by (?!nc|sa|nd)|creative commons attribution (?!noncommercial|sharealike|noderivatives)",
    "CC-BY-NC-4.0": rb"\bcc by nc (?!sa|nd)|creative commons attribution noncommercial (?!sharealike|noderivatives)",
    "CC0-1.0": rb"\bcc0\b",
}.items()}

# Words without which no header or full text is there; these are looked for in every text.
TEXT_ANCHORS = (b"permission", b"redistribution", b"redistributions", b"license", b"licence")

# Said along with other licences: these count where no other reaches the threshold.
GENERAL = {"Proprietary"}


def template_table() -> list[tuple[str, str, bool]]:
    """Rows of licence, text and whether it is a notice of a line (else a header or a full text)."""
    folder = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licences")
    full = {}
    for file in sorted(os.listdir(folder)):
        with open(os.path.join(folder, file), encoding="utf-8") as f:
            full[file.removesuffix(".txt")] = f.read()
    # These two differ from their neighbours by a clause and by a name.
    third = re.compile(r"\n3\. Neither.*?permission\.", re.S)
    full["BSD-2-Clause"] = third.sub("", full["BSD-3-Clause"])
    full["AGPL-3.0"] = full["GPL-3.0"].replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC").replace(
        "GNU General Public", "GNU Affero General Public")
    return ([(name, text, True) for name, texts in TEMPLATES.items() for text in texts]
            + [(name, text, False) for name, texts in HEADERS.items() for text in texts]
            + [(name, text, False) for name, text in full.items()])


LICENCE_NAMES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-].*)?$"


def term(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> (64 - TERM_BITS)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts hold each hashed term, and the number of texts: 2^TERM_BITS counts."""
    width = (1 << TERM_BITS) // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        counts, number = np.zeros(1 << TERM_BITS, np.int64), 0

        def spill():
            np.add.at(counts, [term(w) for w in words], list(words.values()))
            words.clear()

        for batch in batches:
            for text in utf8_values(batch.column(0)):
                words.update(set(LETTERS.findall(bytes(text).lower())))
                number += 1
                if len(words) > 500_000:
                    spill()
        spill()
        if number:
            rows = [(k, pack(counts[k * width:(k + 1) * width])) for k in range(SLICES)]
            yield from in_batches([*rows, (SLICES, pack(np.array([number])))], KEYED)

    sums = folded(texts.mapInArrow(run, KEYED_DDL), lambda _: 0, lambda s, d: s + unpack(d, np.int64), pack)
    counts, number = np.zeros(1 << TERM_BITS, np.int64), 0
    for r in sums.collect():  # SLICES + 1 rows, 8 bytes a term at most
        if r.key == SLICES:
            number = int(unpack(r.data, np.int64)[0])
        else:
            counts[r.key * width:(r.key + 1) * width] = unpack(r.data, np.int64)
    return counts, number


@dataclass
class Templates:
    """Unit TF-IDF vectors of the templates and the terms that a match cannot do without."""

    weights: np.ndarray
    vectors: list[tuple[str, dict[int, float]]]
    anchors: re.Pattern
    lengths: list[int]
    notices: int  # these come first
    threshold: float

    @classmethod
    def build(cls, templates: list[tuple[str, str, bool]], counts: np.ndarray, number: int,
              threshold: float) -> Templates:
        weights = np.log((1 + number) / (1 + counts)).astype(np.float32) + 1
        vectors, anchors, lengths = [], set(), []
        notices = 0
        for name, text, notice in sorted(templates, key=lambda t: (not t[2], t[0] in GENERAL)):
            words = LETTERS.findall(text.lower().encode())
            lengths.append(len(words))
            tf = Counter(words)
            heavy = sorted(tf, key=lambda w: -tf[w] * weights[term(w)])
            size = {w: float(tf[w] * weights[term(w)]) for w in heavy}
            whole = sum(v * v for v in size.values())
            rest = whole
            notices += notice
            if not notice:
                anchors.update(TEXT_ANCHORS)
            for w in heavy if notice else ():  # what is left without these stays under the threshold
                if rest < (threshold * 0.999) ** 2 * whole:
                    break
                anchors.add(w)
                rest -= size[w] ** 2
            vector: dict[int, float] = {}
            for w in heavy:
                vector[term(w)] = vector.get(term(w), 0.0) + size[w]
            norm = sum(v * v for v in vector.values()) ** 0.5
            vectors.append((name, {t: v / norm for t, v in vector.items()}))
        pattern = rb"(?<![a-z0-9\x80-\xff])(?:" + b"|".join(sorted(map(re.escape, anchors))) + rb")(?![a-z0-9\x80-\xff])"
        return cls(weights, vectors, re.compile(pattern if anchors else rb"(?!)"), lengths, notices, threshold)

    def rank(self, score: float, name: str | None) -> tuple[bool, float]:
        """Order of matches: a licence that reaches the threshold is before a general notice."""
        return score >= self.threshold and name not in GENERAL, score

    def holds(self, name: str, words: list[bytes]) -> bool:
        """Whether the words hold what tells the licence from its neighbours."""
        return name not in REQUIRED or bool(REQUIRED[name].search(b" ".join(words)))

    def best(self, words: list[bytes], among: int | None = None) -> tuple[float, str | None]:
        """Best cosine of a run of words to one of the first ``among`` templates; equal ones go to the first."""
        vector: dict[int, float] = {}
        for w, n in Counter(words).items():
            t = term(w)
            vector[t] = vector.get(t, 0.0) + n * float(self.weights[t])
        norm = sum(v * v for v in vector.values()) ** 0.5
        found = (0.0, None)
        for name, template in self.vectors[:among]:
            cosine = sum(v * template.get(t, 0.0) for t, v in vector.items()) / norm if norm else 0.0
            if (self.rank(cosine, name) > self.rank(found[0] + 1e-9, found[1])
                    and (cosine < self.threshold or self.holds(name, words))):
                found = (cosine, name)
        return found

    def best_run(self, words: list[bytes], least: float) -> tuple[float, str | None, int]:
        """Highest cosine over ``least`` of a run of a template's length to it, and the run's first word."""
        whole = b" ".join(words)
        names: dict[bytes, int] = {}
        at = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
        terms = np.array([term(w) for w in names], np.int64)
        weights = self.weights[terms].astype(np.float64)
        squares = np.concatenate([[0.0], np.cumsum(weights[at] ** 2)])
        found = (least, None, 0)
        order = sorted(zip(self.vectors, self.lengths, strict=True), key=lambda v: v[0][0] in GENERAL)
        for (name, template), length in order:
            size = min(length, len(words))
            if not size or (name in REQUIRED and not REQUIRED[name].search(whole)):
                continue
            if name in GENERAL and found[1] is not None:
                break
            gains = np.array([template.get(t, 0.0) for t in terms.tolist()]) * weights
            if not gains.any():
                continue
            dots = np.concatenate([[0.0], np.cumsum(gains[at])])
            dots = dots[size:] - dots[:-size]
            # A word that a run repeats counts more in its norm than in these sums.
            bounds = dots / np.sqrt(squares[size:] - squares[:-size])
            likely = np.flatnonzero(bounds > max(self.threshold, found[0]) - 1e-6)
            for i in likely[np.argsort(-bounds[likely], kind="stable")].tolist():
                if bounds[i] <= found[0] + 1e-9:
                    break
                run, counts = np.unique(at[i:i + size], return_counts=True)
                merged: dict[int, float] = {}
                for t, v in zip(terms[run].tolist(), (counts * weights[run]).tolist(), strict=True):
                    merged[t] = merged.get(t, 0.0) + v
                cosine = float(dots[i]) / sum(v * v for v in merged.values()) ** 0.5
                if (cosine > found[0] + 1e-9 and cosine >= self.threshold
                        and self.holds(name, words[i:i + size])):
                    found = (cosine, name, i)
        return found

    def scan(self, text: bytes) -> tuple[float, str | None, int | None, float, str | None]:
        """Best line or run (score, licence, number of its first line) and best match of the whole text."""
        low = text.lower()
        if not self.anchors.search(low):
            return 0.0, None, None, 0.0, None
        line = (0.0, None, None)
        for i, part in enumerate(low.split(b"\n")):
            if self.anchors.search(part):
                words = LETTERS.findall(part)
                for at in range(0, max(1, len(words) - WINDOW // 2), WINDOW // 2):
                    score, name = self.best(words[at:at + WINDOW], self.notices)
                    if self.rank(score, name) > self.rank(line[0] + 1e-9, line[1]):
                        line = (score, name, i)
        words = LETTERS.findall(low)
        score, name, first = self.best_run(words, 0.0 if line[1] in GENERAL else line[0])
        if name is not None and self.rank(score, name) > self.rank(line[0] + 1e-9, line[1]):
            start = next(islice(LETTERS.finditer(low), first, None)).start()
            line = (score, name, low.count(b"\n", 0, start))
        return *line, *self.best(words)


def scan_files(files: DataFrame, id_col: str, path_col: str, text_col: str,
               templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per file ``id, path, score, licence, line`` (own) and ``file_score, file_licence`` (whole text)."""
    texts = files.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    counts, number = document_frequencies(texts)
    known = files.sparkSession.sparkContext.broadcast(
        Templates.build([(name, text, True) for name, texts in templates.items() for text in texts]
                        if templates else template_table(), counts, number, threshold))
    id_type = files.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("id", batch.schema.field(0).type), ("path", pa.string()), ("score", pa.float64()),
                                ("licence", pa.string()), ("line", pa.int32()), ("file_score", pa.float64()),
                                ("file_licence", pa.string())])

            def rows(batch=batch):
                for key, path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                           utf8_values(batch.column(2)), strict=True):
                    score, name, line, whole, file_name = known.value.scan(bytes(text))
                    if score < threshold:
                        name = line = None
                    yield key, path, score, name, line, whole, file_name

            yield from in_batches(rows(), schema)

    return files.select(F.col(id_col), F.col(path_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(
        run, f"id {id_type}, path string, score double, licence string, line int, file_score double, "
             "file_licence string")


def _folder(path):
    """Folder of a path; top-level files, and those without a path, are in the empty one."""
    return F.coalesce(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), F.lit(""))


def nearest_licences(scanned: DataFrame, file_threshold: float) -> DataFrame:
    """``folder, inherited, inherited_from`` for every folder that has a licensed folder at or above it."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    speaks = ((F.col("file_score") >= file_threshold)
              | (name.rlike(LICENCE_NAMES) & F.col("licence").isNotNull()))
    licence = F.when(F.col("file_score") >= file_threshold, F.col("file_licence")).otherwise(F.col("licence"))
    given = materialize(
        scanned.where(F.col("path").isNotNull() & speaks)
        .groupBy(_folder(F.col("path")).alias("above"))
        .agg(F.max_by(licence, F.struct("file_score", "score", licence)).alias("inherited")))
    folders = materialize(scanned.select(_folder(F.col("path")).alias("folder")).distinct())
    # All prefixes of a folder, the folder itself first; the depth tells the nearest.
    parts = F.split("folder", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("above")))
    climbs = folders.select("folder", F.explode(F.concat(
        prefixes, F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("above"))))).alias("p"))
    found = climbs.select("folder", "p.depth", "p.above").join(given, "above")
    best = F.max(F.struct("depth", "inherited", "above")).alias("b")
    return materialize(found.groupBy("folder").agg(best).select(
        "folder", F.col("b.inherited").alias("inherited"), F.col("b.above").alias("inherited_from")))


def licence_scan(files: DataFrame, id_col: str, path_col: str, text_col: str,
                 templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD,
                 file_threshold: float = FILE_THRESHOLD) -> DataFrame:
    """Per file its own licence, the one it inherits, and the one that holds.

    Returns ``id_col, path, licence, score, line, inherited, inherited_from,
    effective``: the template of the best line or run of words where its
    cosine reaches ``threshold``, its (first) line's number from 0; the licence of the nearest licensed
    folder and that folder; and the file's own or else the inherited one.
    Where several files speak for a folder, the highest cosine decides, then
    the name. Defined cases: null and empty texts have no licence of their
    own; a file without a path counts as top-level and speaks for no folder;
    repeated rows get a row each; an empty table gives an empty result; other
    columns are ignored.
    """
    scanned = materialize(scan_files(files, id_col, path_col, text_col, templates, threshold))
    nearest = nearest_licences(scanned, file_threshold)
    return (scanned.withColumn("folder", _folder(F.col("path"))).join(nearest, "folder", "left")
            .select(F.col("id").alias(id_col), "path", "licence", "score", "line", "inherited", "inherited_from",
                    F.coalesce("licence", "inherited").alias("effective")))
