"""Licence paragraphs: logistic regression on word n-grams, trained on template paragraphs, confirmed by the templates.

Scanning uses built-in functions only; the model is fitted on the driver from the templates below, whatever the corpus.
"""

from __future__ import annotations

import functools
import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

#: Sentences of public licence texts and the ways in which works name their licence, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "This work is released under the Apache License 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 2 or later.",
        "Released under the GNU GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see http://www.gnu.org/licenses/.",
        "Distributed under the GPL v3.",
        "Distributed under the GPL v2.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is licensed under the GNU Lesser General Public License version 3.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Distributed under the LGPL v3.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Distributed under the AGPL v3.",
    ),
    "BSD": (
        "Licensed under the 3-Clause BSD License.",
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "CC0": ("Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC-BY-ND": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "SPDX-License-Identifier: CC-BY-ND-4.0"),
    "proprietary": ("All rights reserved.", "Confidential and proprietary. Unauthorized copying of this file, via any medium, is strictly prohibited.", "No part of this work may be reproduced without the prior written permission of the owner."),
}
#: Paragraphs that speak of permissions and licences without giving one.
OTHERS = (
    "He lost his driving license last week and had to walk to work.",
    "The software was released in the spring and many people copied it.",
    "You may not use this door after six.",
    "The work of the public library is free for any person.",
    "Permission to enter the building is granted by the office.",
    "The license of the restaurant was renewed by the city.",
    "See the following list of conditions for visitors of the park.",
    "Under the law of the state the general rule is in force.",
    "This version is the second of the public report.",
    "The copyright of a song ends many years after the death of the author.",
    "They sell copies of the book without restriction.",
    "A license to fish can be obtained at the town hall.",
)
#: Fixed value: words that speak of licences, and names of families. A paragraph that has one and isn't confirmed is told as unknown.
TRIGGER = (
    r"(?i)licen[cs]e|copyright|spdx|permission|redistribut|public domain|rights reserved|proprietary|\bcc[ -]by|creative commons|unencumbered|warrant|general public"
    r"|\b[al]?gpl(?:\b|v?\d)|\bcc0\b|\bgnu\b|free to copy"
)
#: Names of families that are words of other languages in small letters.
NAMES = r"\b(?:MIT|ISC|BSD|MPL|Apache)\b"
#: Words that are too common to tell a template by, as are numbers.
STOP = frozenset("a all an and any are as at be by can for from if in is it may no not of on one or out see such that the this to under was were which with you".split())
UNKNOWN = "unknown"


def terms(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def ngrams(words: list[str]) -> set[str]:
    """Different word 1- to 3-grams."""
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def one_of(phrases: set[str]) -> str:
    """A pattern of any of the phrases (words with a space between), whatever stands between words; equal beginnings are tried once."""
    root: dict = {}
    for phrase in phrases:
        at = root
        for c in phrase:
            at = at.setdefault(c, {})
        at[""] = {}

    def pattern(at: dict) -> str:
        tails = ["" if not c else (c if c != " " else "[^A-Za-z0-9]+") + pattern(below) for c, below in sorted(at.items(), reverse=True)]
        return tails[0] if len(tails) == 1 else f"(?:{'|'.join(tails)})"

    return f"(?<![A-Za-z0-9]){pattern(root)}(?![A-Za-z0-9])"


def anchors() -> set[str]:
    """The templates' word pairs other than of common words alone. A text of four words or more that has half of a template's
    n-grams, or half of its n-grams in one, has such a pair, as single words are less than half."""
    pairs = {(a, b) for ts in TEMPLATES.values() for t in ts for a, b in zip(terms(t), terms(t)[1:])}
    return {f"{a} {b}" for a, b in pairs if not all(w in STOP or w.isdigit() for w in (a, b))}


#: What a text has that is looked at: a licence word, a family's name, or a word pair of a template (over ends of lines, too).
LOOK = f"{NAMES}|(?i:{TRIGGER[4:]}|{one_of(anchors())})"
#: Words of the longest template: wrapped lines are joined until they have as many.
LONGEST = max(len(terms(t)) for ts in TEMPLATES.values() for t in ts)


@dataclass
class Model:
    families: list[str]
    vocabulary: list[str]
    weights: np.ndarray  # (vocabulary, families)
    bias: np.ndarray
    temperature: float
    least: float  # probability below which a paragraph is unknown


@functools.lru_cache(maxsize=1)
def fit(seed: int = 5, copies: int = 12, rounds: int = 400, rate: float = 0.5, decay: float = 2e-4) -> Model:
    """Multinomial logistic regression on shares of known n-grams. Each template is seen whole and in copies with words dropped,
    cut off or amid other words, other paragraphs and scrambled words as unknown. Temperature and least probability come from texts that a model hasn't
    seen in any form: two models, each fitted without every other template and paragraph, judge copies of those left out."""
    rng = np.random.default_rng(seed)
    families = [*TEMPLATES, UNKNOWN]
    plain = sorted({w for t in OTHERS for w in terms(t)} | {w for ts in TEMPLATES.values() for t in ts for w in terms(t)})

    def altered(text: str) -> list[str]:
        words = terms(text)
        if len(words) > 12 and rng.random() < 0.5:
            a = int(rng.integers(0, len(words) // 2))
            words = words[a : a + max(8, int(len(words) * rng.uniform(0.4, 0.9)))]
        words = [w for w in words if rng.random() > 0.05]
        around = [str(rng.choice(plain)) for _ in range(int(rng.integers(0, 5)))]
        return around[:2] + words + around[2:]

    def rows(n: int, fold: int | None = None) -> tuple[list[set[str]], np.ndarray]:
        """Copies of all texts, or of every other one."""
        x, y = [], []
        for k, family in enumerate(families[:-1]):
            for j, t in enumerate(TEMPLATES[family]):
                if fold in (None, j % 2):
                    for c in range(n):
                        x.append(ngrams(altered(t) if c else terms(t)))
                        y.append(k)
        for j, t in enumerate(OTHERS):
            if fold in (None, j % 2):
                for _ in range(2 * n):
                    x.append(ngrams(altered(t)))
                    y.append(len(families) - 1)
        for _ in range(60 * n if fold is None else 30 * n):
            x.append(ngrams([str(w) for w in rng.choice(plain, int(rng.integers(3, 30)))]))
            y.append(len(families) - 1)
        return x, np.array(y)

    vocabulary = sorted({g for t in (*(t for ts in TEMPLATES.values() for t in ts), *OTHERS) for g in ngrams(terms(t))})
    place = {g: i for i, g in enumerate(vocabulary)}

    def matrix(held: list[set[str]]) -> np.ndarray:
        out = np.zeros((len(held), len(vocabulary)), np.float32)
        for r, grams in enumerate(held):
            known = [place[g] for g in grams if g in place]
            out[r, known] = 1 / math.sqrt(max(1, len(known)))
        return out

    def trained(x: list[set[str]], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z, t = matrix(x), np.eye(len(families), dtype=np.float32)[y]
        weigh = (1 / np.maximum(1, t.sum(0)))[y][:, None]
        weigh = weigh / weigh.mean() / len(z)
        w, b = np.zeros((len(vocabulary), len(families)), np.float32), np.zeros(len(families), np.float32)
        mw, mb = np.zeros_like(w), np.zeros_like(b)
        for _ in range(rounds):
            s = z @ w + b
            p = np.exp(s - s.max(1, keepdims=True))
            e = (p / p.sum(1, keepdims=True) - t) * weigh
            mw, mb = 0.9 * mw + z.T @ e + decay * w, 0.9 * mb + e.sum(0)
            w, b = w - rate * 4 * mw, b - rate * mb
        return w, b

    w, b = trained(*rows(copies))
    scores, truth = [], []
    for fold in (0, 1):
        half_w, half_b = trained(*rows(copies, 1 - fold))
        held, mine = rows(4, fold)
        scores.append(matrix(held) @ half_w + half_b)
        truth.append(mine)
    s, truth = np.concatenate(scores), np.concatenate(truth)

    def probability(temperature: float) -> np.ndarray:
        q = s / temperature
        q = np.exp(q - q.max(1, keepdims=True))
        return q / q.sum(1, keepdims=True)

    temperature = float(min(np.geomspace(0.2, 5, 60), key=lambda c: -np.log(probability(c)[np.arange(len(truth)), truth] + 1e-12).mean()))
    p = probability(temperature)
    known = truth != len(families) - 1
    best, top = p[:, :-1].argmax(1), p[:, :-1].max(1)
    grid = np.linspace(0.05, 0.95, 91)
    least = float(max(grid, key=lambda c: ((top >= c) & known & (best == truth)).sum() + ((top < c) & ~known).sum()))
    return Model(families, vocabulary, w, b, temperature, least)


def words_of(text: Column) -> Column:
    """Lower-case words; GPLv3 and GPL3 are the words gpl and v3."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"\b([al]?gpl)v?(\d)", "$1 v$2"), "[^a-z0-9]+"), lambda w: w != "")


def grams_of(ws: Column) -> Column:
    pairs = lambda n: F.when(F.size(ws) >= n, F.transform(F.sequence(F.lit(1), F.size(ws) - (n - 1)), lambda i: F.array_join(F.slice(ws, i, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(ws, pairs(2), pairs(3)))


def licence_paragraphs(docs: DataFrame, confirm: float = 0.5, key: str = "doc_id") -> DataFrame:
    """A row for each licence paragraph of docs (key, text): key, paragraph (number of its first line, from 0), lines (how many), family,
    probability (calibrated), template (its number in the family), overlap and confirmed.

    A paragraph is a line, or consecutive lines without a blank one that were wrapped: all runs of lines up to the words of the
    longest template are judged beside the single lines. Of the confirmed ones each line belongs to the one with most n-grams of its template, less
    those that aren't; joined lines count where that is so for all of them. Other lines count by themselves if confirmed or with a trigger.

    family is unknown where the most probable family is below the model's least probability or less probable than none, or where
    the template comparison doesn't confirm it: overlap is the share of the nearest template's n-grams in the paragraph, or of the
    paragraph's n-grams in the template, whichever is larger. Null and empty texts have no paragraphs. Only lines that have, with the line before or after,
    something of LOOK are shuffled, split into n-grams and joined to the weights, whose number the templates bound.
    """
    spark, model = docs.sparkSession, fit()
    last = len(model.families) - 1
    weights = spark.createDataFrame([(g, [float(v) for v in row]) for g, row in zip(model.vocabulary, model.weights)], "gram string, w array<double>")
    owned: dict[str, list[int]] = {}
    names, sizes = [], []
    for family, held in TEMPLATES.items():
        for n, t in enumerate(held):
            names.append((len(names), family, n))
            grams = ngrams(terms(t))
            sizes.append(len(grams))
            for g in grams:
                owned.setdefault(g, []).append(len(names) - 1)
    weights = F.broadcast(weights.join(F.broadcast(spark.createDataFrame(list(owned.items()), "gram string, templates array<int>")), "gram", "left"))
    text = F.col("text").cast("string")
    lines = docs.select(F.col(f"`{key}`").alias("key"), F.monotonically_increasing_id().alias("row"), text.alias("text")).where(F.col("text").rlike(LOOK))
    lines = lines.select("key", "row", F.split("text", "\n", -1).alias("held"))
    lines = lines.select("key", "row", F.posexplode(F.arrays_zip(F.concat(F.array(F.lit("")), "held").alias("before"), F.col("held").alias("line"), F.slice("held", 2, F.size("held")).alias("after"))).alias("at", "x"))
    lines = lines.where("x.line IS NOT NULL").where(F.concat_ws("\n", "x.before", "x.line").rlike(LOOK) | F.concat_ws("\n", "x.line", "x.after").rlike(LOOK))
    lines = lines.select("key", "row", "at", F.col("x.line").rlike(TRIGGER).alias("named"), words_of(F.col("x.line")).alias("ws")).where("size(ws) > 0")
    # run: consecutive lines have equal differences of line and rank; before: words of the run before the line
    lines = lines.withColumn("run", F.col("at") - F.row_number().over(Window.partitionBy("row").orderBy("at")))
    whole = Window.partitionBy("row", "run").orderBy("at")
    lines = lines.withColumn("before", F.sum(F.size("ws")).over(whole.rowsBetween(Window.unboundedPreceding, 0)) - F.size("ws"))
    ahead = Window.partitionBy("row", "run").orderBy("before").rangeBetween(0, LONGEST - 1)
    runs = lines.select("key", "row", "at", "named", F.collect_list(F.struct("at", "ws")).over(ahead).alias("held"))
    runs = runs.select("key", "row", "at", "named", "held", F.explode(F.sequence(F.lit(1), F.size("held"))).alias("n"))
    unit = ["key", "row", "at", "n", "named"]
    parts = runs.select(*unit, F.flatten(F.transform(F.slice("held", 1, F.col("n")), lambda x: x["ws"])).alias("ws"))
    grams = parts.select(*unit, grams_of(F.col("ws")).alias("grams"))
    grams = grams.select(*unit, F.size("grams").alias("total"), F.explode("grams").alias("gram")).join(weights, "gram")
    found = grams.groupBy(*unit).agg(
        F.count("*").alias("known"),
        F.max("total").alias("total"),
        *(F.sum(F.col("w")[k]).alias(f"s{k}") for k in range(last + 1)),
        *(F.sum(F.array_contains("templates", i).cast("int")).alias(f"t{i}") for i, _, _ in names),
    )
    logit = [(F.col(f"s{k}") / F.sqrt("known") + float(model.bias[k])) / model.temperature for k in range(last + 1)]
    top = F.greatest(*logit)
    # exploded, as the optimizer would else put each expression into all that use it, and into their functions of each element
    found = found.select(*unit, "total", F.explode(F.array(F.array(*(F.exp(x - top) for x in logit)))).alias("e"), *(f"t{i}" for i, _, _ in names))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    best = F.array_max(F.transform(F.slice("e", 1, last), lambda x, i: F.struct((x / total).alias("p"), (-i).alias("k"))))
    overlap = F.array(
        *(
            F.struct(
                F.greatest(F.col(f"t{i}") / F.lit(float(sizes[i])), F.col(f"t{i}") / F.col("total")).alias("o"),
                F.lit(-n).alias("n"),
                F.lit(list(TEMPLATES).index(family)).alias("f"),
                F.col(f"t{i}").alias("t"),
            )
            for i, family, n in names
        )
    )
    found = found.select(*unit, "total", F.explode(F.array(F.struct(best.alias("best"), (F.element_at("e", last + 1) / total).alias("none"), overlap.alias("overlaps")))).alias("x"))
    found = found.select(*unit, "total", "x.*")
    family = -F.col("best.k")
    nearest = F.array_max(F.filter("overlaps", lambda x: x["f"] == family))
    most = F.array_max(F.transform(F.filter("overlaps", lambda x: x["f"] == family), lambda x: x["t"]))
    found = found.select(*unit, "total", family.alias("k"), F.col("best.p").alias("probability"), "none", nearest.alias("near"), most.alias("most"))
    confirmed = (F.col("probability") >= model.least) & (F.col("probability") > F.col("none")) & (F.col("near.o") >= confirm)
    found = durable(found.withColumn("confirmed", confirmed).where("confirmed OR named AND n = 1"), "licences")
    # the joined lines that are the best of all confirmed runs for each of their lines
    best = F.max_by(F.struct("at", "n"), F.struct(2 * F.col("most") - F.col("total"), -F.col("n"), -F.col("at")))
    won = found.where("confirmed").select("row", "at", "n", "most", "total", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("line"))
    won = won.groupBy("row", "line").agg(best.alias("b")).where("b.n > 1").groupBy("row", F.col("b.at").alias("at"), F.col("b.n").alias("n")).agg(F.count("*").alias("lines")).where("lines = n")
    covered = won.select("row", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("at"))
    found = found.where("n > 1").join(won, ["row", "at", "n"], "left_semi").unionByName(found.where("n = 1").join(covered, ["row", "at"], "left_anti"))
    name = F.element_at(F.array(*map(F.lit, model.families)), F.col("k") + 1)
    return found.select(
        F.col("key").alias(key),
        F.col("at").alias("paragraph"),
        F.col("n").alias("lines"),
        F.when(F.col("confirmed"), name).otherwise(UNKNOWN).alias("family"),
        "probability",
        (-F.col("near.n")).alias("template"),
        F.col("near.o").alias("overlap"),
        "confirmed",
    )


def scan(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """licence_paragraphs gathered for each key: families (different ones, sorted, without unknown), n_paragraphs (confirmed, or with a trigger
    and a known n-gram), n_unknown and probability (the largest of a confirmed paragraph); rows only for keys with such a paragraph.
    Rows that share a key are one document; a null key is a key like any other."""
    named = F.col("family") != UNKNOWN
    return licence_paragraphs(docs, key=key).groupBy(F.col(f"`{key}`")).agg(
        F.array_sort(F.collect_set(F.when(named, F.col("family")))).alias("families"),
        F.count("*").alias("n_paragraphs"),
        F.count_if(~named).alias("n_unknown"),
        F.max(F.when(named, F.col("probability"))).alias("probability"),
    )
