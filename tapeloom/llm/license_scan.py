"""Licence notices, paragraph by paragraph.

A paragraph is a line of a text. A multinomial logistic regression on hashed word n-grams
tells licence families and the class of everything else apart. It is trained on variants of
each family's notices and on a bounded sample of the corpus's own lines. Whole notices, with
all their variants, and a part of the lines are held back from a first fit and calibrate the
probabilities (one temperature) and the least probability that a family needs, so that few
other lines reach it; then all are fitted. What the classifier names is confirmed by
comparing the line's word n-grams with the family's paragraphs.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.runtime import arrow_map, column, quoted, ship, stored

#: Paragraphs of the licences, and notices that name them.
NOTICES = {
    "MIT": [
        "Distributed under the terms of the MIT license",
        "This project is licensed under the MIT License - see the LICENSE file for details",
        "SPDX-License-Identifier: MIT",
        "This software is released under the MIT license, see LICENSE.txt",
        "The code is MIT licensed",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to "
        "the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the "
        "authors or copyright holders be liable for any claim, damages or other liability, whether in an action of "
        "contract, tort or otherwise, arising from, out of or in connection with the software or the use or other "
        "dealings in the software.",
    ],
    "Apache-2.0": [
        "Apache License, Version 2.0, January 2004",
        "This project is released under the Apache 2.0 license",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, "
        "non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, "
        "publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or "
        "Object form.",
        "Distributed under the Apache License, Version 2.0. See accompanying file LICENSE",
        "The documentation is available under the Apache License 2.0",
    ],
    "GPL": [
        "GNU General Public License, Version 3, 29 June 2007",
        "Released under the GNU GPL version 2 or later",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is licensed under the GNU General Public License, version 2",
        "You should have received a copy of the GNU General Public License along with this program. If not, see "
        "http://www.gnu.org/licenses/.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "Licensed under the terms of the GNU General Public License as published by the Free Software Foundation; version 3",
    ],
    "LGPL": [
        "GNU Lesser General Public License, Version 2.1, February 1999",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to "
        "the Free Software Foundation, Inc.",
        "The library is released under the GNU LGPL version 3",
    ],
    "AGPL": [
        "GNU Affero General Public License, Version 3, 19 November 2007",
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "This server is released under the GNU AGPL version 3 or later",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        "This software is provided by the copyright holders and contributors as is and any express or implied warranties, "
        "including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are "
        "disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, "
        "special, exemplary, or consequential damages",
        "This code is distributed under the 2-clause BSD license",
    ],
    "ISC": [
        "Licensed under the ISC License",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "The software is provided as is and the author disclaims all warranties with regard to this software including all "
        "implied warranties of merchantability and fitness. In no event shall the author be liable for any special, direct, "
        "indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits",
        "This package is available under the ISC license",
    ],
    "zlib": [
        "Licensed under the zlib license",
        "SPDX-License-Identifier: Zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter "
        "it and redistribute it freely, subject to the following restrictions:",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
        "Released under the zlib/libpng license",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the "
        "Software, and to prepare derivative works of the Software",
        "Use, modification and distribution are subject to the Boost Software License, Version 1.0.",
    ],
    "MPL-2.0": [
        "Mozilla Public License Version 2.0",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Covered Software is provided under this License on an as is basis, without warranty of any kind, either expressed, "
        "implied, or statutory",
        "The add-on is available under the Mozilla Public License 2.0",
    ],
    "EPL-2.0": [
        "Eclipse Public License - v 2.0",
        "SPDX-License-Identifier: EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0",
        "The accompanying program is provided under the terms of this Eclipse Public License. Any use, reproduction or "
        "distribution of the program constitutes recipient's acceptance of this agreement.",
    ],
    "CC-BY": [
        "Creative Commons Attribution 4.0 International Public License",
        "Available under CC BY 4.0",
        "SPDX-License-Identifier: CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text and images are published under a CC BY 3.0 license",
        "Except where otherwise noted, content on this site is licensed under a Creative Commons Attribution 4.0 license",
    ],
    "CC-BY-SA": [
        "Creative Commons Attribution-ShareAlike 4.0 International Public License",
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
        "Published under a CC BY-SA 3.0 license",
    ],
    "CC-BY-NC": [
        "Creative Commons Attribution-NonCommercial 4.0 International Public License",
        "Available under CC BY-NC 4.0",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Published under a CC BY-NC 3.0 license",
        "Licensed under CC BY-NC 4.0 for non-commercial use only",
    ],
    "public-domain": [
        "Released into the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: Unlicense",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
        "as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This file has been placed in the public domain",
    ],
    "proprietary": [
        "Copyright 2020 the authors, all rights reserved worldwide.",
        "Copyright (c) Example Corporation. All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited",
        "Proprietary and confidential",
        "This material may not be reproduced, displayed, modified or distributed without the express prior written permission "
        "of the copyright holder. All rights reserved",
        "No part of this publication may be reproduced, stored in a retrieval system, or transmitted in any form or by any "
        "means without the prior permission of the publisher",
    ],
}
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *NOTICES]

#: Production parameters.
FEATURES = 1 << 15
VARIANTS = 24  # of each notice
HELD_NOTICES = 4  # every so many-th notice of a family is held back
SAMPLE_DOCS = 2_000  # whose lines stand for all others; the bound of the sample
FALSE_ALARMS = 0.001  # share of held-back other lines that may reach the least probability
SHARED = 3
SIMILARITY = 0.5  # of a line's n-grams that must be found in the family's notices, or the other way round


# --- lines and their n-grams -------------------------------------------------------------

WORD = re.compile(r"[^\W_]+")
_DOCS_AT_ONCE = 512


def tokens(line: str) -> list[str]:
    return WORD.findall(line.lower())


def grams(words: list[str]) -> frozenset[str]:
    """Words and pairs of words."""
    return frozenset(words) | {f"{a} {b}" for a, b in zip(words, words[1:])}


@cache
def notice_grams() -> dict[str, list[frozenset[str]]]:
    return {family: [grams(tokens(t)) for t in texts] for family, texts in NOTICES.items()}


def similarity(words: list[str], family: str) -> float:
    """The largest share of n-grams, of the line or of one notice of the family, that both have;
    fewer than ``SHARED`` of them prove nothing."""
    mine = grams(words)
    both = [(len(mine & notice), len(notice)) for notice in notice_grams()[family]]
    return max((n / min(len(mine), size) for n, size in both if n >= SHARED), default=0.0)


def places(lines: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Feature places of all n-grams of all lines, line after line, and where each line ends."""
    counts = np.array([len(w) for w in lines], dtype=np.int64)
    hashed = np.fromiter(
        map(xxhash.xxh3_64_intdigest, chain.from_iterable(lines)), dtype=np.uint64, count=int(counts.sum())
    )
    ends = np.cumsum(counts)
    first = np.zeros(len(hashed), dtype=bool)
    first[(ends - counts)[counts > 0]] = True
    pairs = np.roll(hashed, 1) * np.uint64(0x9E3779B97F4A7C15) ^ hashed
    both = np.stack([hashed, pairs], axis=1)
    used = np.stack([np.ones(len(hashed), dtype=bool), ~first], axis=1)
    found = (both ^ both >> np.uint64(29)) % np.uint64(FEATURES)
    return found[used].astype(np.int64), np.cumsum(np.where(counts > 0, 2 * counts - 1, 0))


def notices(spark: SparkSession) -> DataFrame:
    """(family, text, held): the notices and variants of them with words left out and words around them.

    Every ``HELD_NOTICES``-th notice of a family is held back, so that the probabilities are set by notices that the
    classifier has not seen in any variant.
    """
    draw = random.Random(7)
    before = ["", "This file is", "Copyright (c) 2021 Example Authors.", "Note:", "The code is"]
    after = ["", "See the file LICENSE for details.", "as described below", "http://www.example.org"]
    rows = []
    for family, texts in NOTICES.items():
        for number, text in enumerate(texts, 1):
            held = number % HELD_NOTICES == 0
            rows.append((family, text, held))
            for _ in range(VARIANTS):
                kept = [w for w in text.split() if len(text.split()) < 4 or draw.random() > 0.08]
                rows.append((family, " ".join([draw.choice(before), *kept, draw.choice(after)]).strip(), held))
    return spark.createDataFrame(rows, "family string, text string, held boolean")


# --- the classifier ----------------------------------------------------------------------


@dataclass
class LicenseClassifier:
    """Weights of the regression, the temperature and the least probability of a family."""

    weights: np.ndarray  # one row per feature, one column per class
    intercepts: np.ndarray
    temperature: float = 1.0
    least: float = 0.5

    def raw(self, lines: list[list[str]]) -> np.ndarray:
        """Raw scores of lines with at least one word."""
        found, ends = places(lines)
        starts = np.append(0, ends[:-1])
        sums = np.add.reduceat(self.weights[found], starts, axis=0) if len(found) else np.zeros((0, len(FAMILIES)))
        return sums / np.sqrt(ends - starts)[:, None] + self.intercepts

    def named(self, lines: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Per line the place of the most probable class, and its calibrated probability."""
        raw = self.raw(lines)
        top = raw.max(axis=1, keepdims=True)
        return raw.argmax(axis=1), 1 / np.exp((raw - top) / self.temperature).sum(axis=1)


def exponentials(top: Column, temperature: float) -> Column:
    """Sum of the exponentials of the raw scores, the top one being 1."""
    return F.aggregate("raw", F.lit(0.0), lambda total, x: total + F.exp((x - top) / temperature))


def other_lines(docs: DataFrame, text_col: str) -> DataFrame:
    """(family, text) of the lines with a word that look like no notice."""

    def pick(batches):
        for batch in batches:
            found = []
            for text in column(batch, "text"):
                for line in (text or "").split("\n"):
                    words = tokens(line)
                    if words and max(similarity(words, f) for f in NOTICES) < SIMILARITY:
                        found.append(line)
            yield pa.RecordBatch.from_arrays([pa.array([UNKNOWN] * len(found)), pa.array(found, pa.string())], ["family", "text"])

    return arrow_map(docs.select(F.col(quoted(text_col)).alias("text")), pick, "family string, text string")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LicenseClassifier:
    """Fit on variants of the notices and on the lines of about ``SAMPLE_DOCS`` documents, drawn by
    a digest of their id; lines that look like a notice are left out of the sample. Without any line
    of the corpus (an empty table, or texts without words) the notices alone are told apart.
    """
    spark = docs.sparkSession
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    digest = F.pmod(F.xxhash64(quoted(id_col)), F.lit(1 << 30))
    others = other_lines(docs.where(digest < int(share * (1 << 30))), text_col)
    others = others.withColumn("held", F.pmod(F.xxhash64("text"), F.lit(4)) == 0)
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
    rows = others.unionByName(notices(spark)).select("text", "held", label.cast("double").alias("label"))
    sample = stored(rows, "license-sample")

    ship(spark)

    @F.udf(VectorUDT())
    def vector(text: str):
        found, ends = places([tokens(text)])
        where, counts = np.unique(found, return_counts=True)
        return Vectors.sparse(FEATURES, where.tolist(), (counts / np.sqrt(ends[-1])).tolist())

    features = stored(sample.select("label", "held", vector("text").alias("features")), "license-features")

    def fitted(rows: DataFrame) -> LicenseClassifier:
        classes = rows.groupBy("label").agg((1 / F.sqrt(F.count("*"))).alias("weight"))
        regression = LogisticRegression(
            family="multinomial", maxIter=30, regParam=1e-5, weightCol="weight", standardization=False
        )
        fit = regression.fit(rows.join(F.broadcast(classes), "label").select("label", "weight", "features"))
        weights = np.ascontiguousarray(fit.coefficientMatrix.toArray().T.astype(np.float32))
        return LicenseClassifier(weights, fit.interceptVector.toArray())

    first = fitted(features.where("NOT held"))
    classifier = fitted(features)
    sent = spark.sparkContext.broadcast(first)

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                raw = sent.value.raw([tokens(t) for t in column(batch, "text")])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1), pa.array(raw.astype(float).tolist(), pa.list_(pa.float64()))], ["label", "raw"]
                )

    held_rows = sample.where("held").select("text", "label")
    held_raw = stored(arrow_map(held_rows, score, "label double, raw array<double>"), "license-held")
    top, own = F.array_max("raw"), F.element_at("raw", F.col("label").cast("int") + 1)
    grid = [2.0**k for k in range(-3, 5)]
    losses = held_raw.agg(*[F.sum((top - own) / t + F.log(exponentials(top, t))) for t in grid]).first()
    _, classifier.temperature = min(((x, t) for x, t in zip(losses, grid) if x is not None), default=(0.0, 1.0))
    alarm = F.when(F.element_at("raw", 1) < top, 1 / exponentials(top, classifier.temperature)).otherwise(0.0)
    found = held_raw.where("label = 0").agg(F.percentile_approx(alarm, 1 - FALSE_ALARMS, 100_000)).first()[0]
    classifier.least = max(0.5, min(found or 0.0, 0.99))
    return classifier


def scan(
    docs: DataFrame, classifier: LicenseClassifier, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per line that the classifier gives to a family: id, ``line`` (from 0), ``family``,
    calibrated ``probability``, ``similarity`` to the family's notices and ``confirmed``.

    ``confirmed`` needs both the least probability and the similarity. All lines of all rows
    are looked at, repeated rows and rows with a null id too; null and empty texts have no
    lines, and a line without a letter or digit belongs to no family. Other columns are not
    looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(classifier)
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))

    def classify(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, _DOCS_AT_ONCE):
                batch = whole.slice(k, _DOCS_AT_ONCE)
                of, number, lines = [], [], []
                for row, text in enumerate(column(batch, "text")):
                    for place, line in enumerate(text.split("\n")):
                        if words := tokens(line):
                            of.append(row)
                            number.append(place)
                            lines.append(words)
                names, chances = sent.value.named(lines)
                hits = np.flatnonzero(names)
                families = [FAMILIES[names[h]] for h in hits]
                near = [similarity(lines[h], f) for h, f in zip(hits, families)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([of[h] for h in hits], pa.int64())),
                        pa.array([number[h] for h in hits], pa.int32()),
                        pa.array(families, pa.string()),
                        pa.array(chances[hits], pa.float64()),
                        pa.array(near, pa.float64()),
                    ],
                    ["id", "line", "family", "probability", "similarity"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    found = arrow_map(rows, classify, f"id {kind}, line int, family string, probability double, similarity double")
    sure = (F.col("probability") >= classifier.least) & (F.col("similarity") >= SIMILARITY)
    return found.select(F.col("id").alias(id_col), "line", "family", "probability", "similarity", sure.alias("confirmed"))
