"""Licence scans by a trained paragraph classifier, in DataFrame functions on the whole data path.

A notice is a line or consecutive lines of a paragraph, which ends at a line without words once
comment marks are gone; lines are joined where they hold word pairs of a template, over their ends
too.  The model is a multinomial logistic regression over binary word uni- and bigrams, fitted on the driver to a bounded set of labelled paragraphs: notice templates
of each family, varied by dropped words and surrounding text, against sentences that use the same
words otherwise.  Features hold an anchor word, so a paragraph without one scores as the bias
alone, which is the unknown class.  Temperature and the threshold below which a paragraph is unknown
are calibrated on templates and counter-examples that the fit has not seen, each scored by a model of
the other folds.  A family's predictions are confirmed by comparison with its templates, and of
overlapping notices the one that is most like a template stays.
"""

from __future__ import annotations

import functools
import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .secrets import _let, _running
from .store import materialize

UNKNOWN = "unknown"
#: bound of the labelled set: variants a template
VARIANTS = 40
#: parts of the templates and counter-examples, each calibrated on by a model of the others
FOLDS = 4
#: share of unseen counter-examples that may pass as a family
FALSE_ALARMS = 0.01
SIMILARITY = 0.6
STEPS = 250
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
#: Notices of public licences: fixed wordings.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License. See LICENSE for details.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Distributed under the MIT license.",
        "Available under the terms of the MIT licence.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache License 2.0.",
        "Distributed under the Apache License 2.0.",
        "Available under the terms of the Apache 2.0 licence.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GNU GPL version 3.",
        "Distributed under the GPL version 3.",
        "Available under the terms of the GPL-3.0 licence.",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Released under the GNU GPL version 2.",
        "Distributed under the GPL version 2.",
        "Available under the terms of the GPL-2.0 licence.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "Released under the GNU LGPL version 3.",
        "Distributed under the LGPL version 3.",
        "Available under the terms of the LGPL version 2.1.",
    ),
    "bsd": (
        "Released under the BSD License.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Distributed under the BSD license.",
        "Available under the terms of the BSD 2-Clause licence.",
    ),
    "mpl-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Released under the MPL version 2.0.",
        "Distributed under the Mozilla Public License 2.0.",
        "Available under the terms of the MPL 2.0.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "Distributed under CC BY 4.0.",
        "Available under the Creative Commons Attribution 4.0 licence.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "Distributed under CC BY-SA 4.0.",
        "Available under the Creative Commons Attribution-ShareAlike 4.0 licence.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "Distributed under CC BY-NC 4.0.",
        "Available under the Creative Commons Attribution-NonCommercial 4.0 licence.",
    ),
    "cc0": (
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright under a CC0 1.0 Universal public domain dedication.",
        "SPDX-License-Identifier: CC0-1.0",
        "Distributed under CC0 1.0.",
        "Available under the CC0 1.0 Universal licence.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright 2024 the authors. All rights reserved.",
        "This software is proprietary and confidential. Unauthorized copying is prohibited.",
        "Proprietary and confidential. Do not distribute.",
        "Copyright the authors, all rights reserved; use without permission is prohibited.",
    ),
}
#: Sentences that use licence words for other things.
NEGATIVES = (
    "The driver lost a license after the third offence.",
    "A fishing license costs twelve dollars in this county.",
    "The bar was licensed to serve spirits until midnight.",
    "She studied physics at MIT before moving to Boston.",
    "An Apache helicopter landed near the river at noon.",
    "The general public was invited to the opening of the bridge.",
    "The gnu grazed beside the zebras on the open plain.",
    "Human rights were reserved as a topic for the second session.",
    "All seats are reserved for members of the public library.",
    "The new version of the report is three pages longer.",
    "Creative writing classes meet in the commons on Friday.",
    "The copyright office moved to a larger building last year.",
    "Permission to enter was granted by the guard at the gate.",
    "Mozilla released a browser and many people use it.",
    "The source of the river lies in the northern hills.",
    "Free software meetings take place in the public hall.",
    "The licensing exam has two parts and an interview.",
    "The domain of the function is public in the interface.",
    "He asked about the terms of the foundation and its conditions.",
    "Use of the lift is permitted under supervision only.",
    "Please keep your license with you in the car.",
    "The software runs on every computer in the office.",
    "This version of the song is slower than the first.",
    "Version 3 of the timetable starts on Monday.",
    "A licence to sell wine is needed in most towns.",
    "The shop is licensed for music and dancing.",
    "Read the license terms before you install the software.",
    "The software version is shown under help.",
    "The foundation published its yearly report.",
    "A new license key for the software costs ten dollars.",
)
ANCHORS = (
    "license", "licensed", "licence", "licenced", "licensing", "spdx-license-identifier", "mit", "apache", "apache-2.0", "gnu", "gpl", "lgpl", "bsd", "mozilla", "mpl",
    "cc", "cc0", "creative", "commons", "attribution", "sharealike", "noncommercial", "copyright", "rights", "reserved", "proprietary", "confidential", "permission", "redistribution",
    "public", "domain", "software", "foundation", "by-sa", "by-nc", "version",
)
WORD = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
#: comment marks that are words; others hold no letter or digit
COMMENT = r"(?m)^[^\S\n]*(?:dnl|rem)\b"
#: names with a version as suffix, read as "gpl version 3"
VERSIONED = r"(?<![a-z0-9])(apache|bsd|gpl|lgpl|mpl)(?:[ -]?v)?([0-9]+(?:\.[0-9]+)*)"
_STOP = frozenset("a an and any as at by for from in is it no of on or that the this to under with you".split())


def words_of(paragraph: str) -> list[str]:
    return re.findall(WORD, re.sub(VERSIONED, r"\1 version \2 ", re.sub(COMMENT, "", paragraph.lower())))


def _pairs(words: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def _parts(words: list[str]) -> set[str]:
    return set(words) | _pairs(words)


#: words of the longest template
_LONGEST = max(len(words_of(t)) for texts in TEMPLATES.values() for t in texts)
#: word pairs that let lines be joined
_JOINING = sorted(p for texts in TEMPLATES.values() for p in set().union(*(_pairs(words_of(t)) for t in texts)) if not _STOP.issuperset(p.split(" ")))


def _is_anchor(word: str) -> bool:
    return word in ANCHORS or any(word.startswith(a + "-") for a in ("mit", "apache", "gpl", "lgpl", "bsd", "mpl", "cc", "cc0", "attribution"))


def features_of(paragraph: str) -> set[str]:
    return {g for g in _parts(words_of(paragraph)) if any(map(_is_anchor, g.split(" ")))}


class LicenceModel:
    def __init__(self, families: list[str], features: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float, threshold: float):
        self.families, self.features, self.weights, self.bias = families, features, weights, bias
        self.temperature, self.threshold = temperature, threshold

    def classify(self, paragraph: str) -> tuple[str, float]:
        own = features_of(paragraph)
        z = self.bias + sum((self.weights[i] for i, f in enumerate(self.features) if f in own), np.zeros(len(self.bias)))
        p = np.exp((z - z.max()) / self.temperature)
        p /= p.sum()
        k = int(p.argmax())
        known = self.families[k] != UNKNOWN and p[k] >= self.threshold
        return (self.families[k] if known else UNKNOWN), float(p[k])


def _variants(rng: random.Random, text: str, count: int) -> list[str]:
    filler = [w for s in NEGATIVES for w in words_of(s) if not _is_anchor(w)]
    out = [text]
    for _ in range(count - 1):
        own = words_of(text)
        if len(own) > 4:
            own = [w for w in own if rng.random() > 0.06]
        lead = [rng.choice(filler) for _ in range(rng.choice((0, 0, 3, 12)))]
        tail = [rng.choice(filler) for _ in range(rng.choice((0, 0, 3, 12)))]
        out.append(" ".join([*lead, *own, *tail]))
    return out


def _indicators(rows: list[set[str]], features: list[str]) -> np.ndarray:
    at = {f: i for i, f in enumerate(features)}
    x = np.zeros((len(rows), len(features)))
    for i, own in enumerate(rows):
        x[i, [at[f] for f in own if f in at]] = 1
    return x


def _descend(rows: list[set[str]], y: np.ndarray, classes: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Features of at least three rows, weights and bias, by full-batch gradient descent with momentum."""
    count = Counter(f for own in rows for f in own)
    features = sorted(f for f, c in count.items() if c >= 3)
    x, truth = _indicators(rows, features), np.eye(classes)[y]
    w, b = np.zeros((len(features), classes)), np.zeros(classes)
    pace_w, pace_b = np.zeros_like(w), np.zeros_like(b)
    share = (1 / (classes * truth.sum(axis=0)))[y][:, None]  # classes count alike, however many their rows
    for _ in range(STEPS):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - truth) * share
        pace_w, pace_b = 0.9 * pace_w + x.T @ g + 1e-5 * w, 0.9 * pace_b + g.sum(axis=0)
        w -= 2.0 * pace_w
        b -= 2.0 * pace_b
    return features, w, b


@functools.lru_cache(maxsize=2)
def fit(variants: int = VARIANTS, seed: int = 5) -> LicenceModel:
    """The model of a bounded set of labelled paragraphs, and temperature and threshold from the
    templates and counter-examples of each fold, scored by a model of the other folds."""
    rng = random.Random(seed)
    families = [*sorted(TEMPLATES), UNKNOWN]
    rows = [(v, family, i % FOLDS) for family, texts in sorted(TEMPLATES.items()) for i, t in enumerate(texts) for v in _variants(rng, t, variants)]
    rows += [(v, UNKNOWN, i % FOLDS) for i, t in enumerate(NEGATIVES) for v in _variants(rng, t, variants)] + [("", UNKNOWN, -1)] * variants
    own = [features_of(text) for text, _, _ in rows]
    fold = np.array([f for _, _, f in rows])
    truth = np.array([families.index(family) for _, family, _ in rows])
    scores = np.zeros((len(rows), len(families)))
    for k in range(FOLDS):
        inside = [i for i in range(len(rows)) if fold[i] != k]
        features, w, b = _descend([own[i] for i in inside], truth[inside], len(families))
        outside = np.flatnonzero(fold == k)
        scores[outside] = _indicators([own[i] for i in outside], features) @ w + b
    unseen = fold >= 0
    scores, y = scores[unseen], truth[unseen]

    def probabilities(t: float) -> np.ndarray:
        p = np.exp((scores - scores.max(axis=1, keepdims=True)) / t)
        return p / p.sum(axis=1, keepdims=True)

    temperature = min(TEMPERATURES, key=lambda t: -np.log(np.maximum(probabilities(t)[np.arange(len(y)), y], 1e-12)).mean())
    p = probabilities(temperature)
    unknown = families.index(UNKNOWN)
    alarms = np.sort(np.where(p.argmax(axis=1) != unknown, p.max(axis=1), 0)[y == unknown])
    threshold = float(alarms[max(0, math.ceil(len(alarms) * (1 - FALSE_ALARMS)) - 1)]) + 1e-9
    features, w, b = _descend(own, truth, len(families))
    return LicenceModel(families, features, np.round(w, 6), np.round(b, 6), temperature, threshold)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _weights(spark: SparkSession, model: LicenceModel) -> DataFrame:
    """(gram, w) as an inline table, as large as the bounded labelled set makes it."""
    rows = ",".join(f"({_quoted(f)},array({','.join(f'{v:.6f}D' for v in w)}))" for f, w in zip(model.features, model.weights))
    return spark.sql(f"select * from values {rows} as t(gram, w)")


def _templates(spark: SparkSession) -> DataFrame:
    rows = ",".join(f"({_quoted(family)},array({','.join(map(_quoted, sorted(_parts(words_of(t)))))}))" for family, texts in sorted(TEMPLATES.items()) for t in texts)
    return spark.sql(f"select * from values {rows} as t(family, template)")


def _word_pairs(words: Column) -> Column:
    return _let(words, lambda w: F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, i: F.concat(a, F.lit(" "), F.get(w, i + 1))))


def _lines(text: Column, gate: str) -> Column:
    """struct(n, size, hit, words) of each line."""

    def line(s: Column, i: Column) -> Column:
        hit = s.rlike(gate)
        low = F.lower(s)
        plain = F.when(hit, F.regexp_replace(low, VERSIONED, "$1 version $2 ")).otherwise(low)
        plain = F.when(low.rlike(COMMENT), F.regexp_replace(plain, COMMENT, "")).otherwise(plain)
        return F.struct(i.alias("n"), F.length(s).cast("bigint").alias("size"), hit.alias("hit"), F.regexp_extract_all(plain, F.lit(WORD), F.lit(0)).alias("words"))

    return F.transform(F.split(text, "\n", -1), line)


def _marked(lines: Column) -> Column:
    """The lines with start, and bears: words, and with the next words around a template's pair."""
    joining = F.lit(_JOINING)
    none = F.array().cast("array<string>")

    def bears(l: Column, i: Column) -> Column:
        around = F.concat(F.slice(F.coalesce(F.get(lines, i - 1)["words"], none), -1, 1), l["words"], F.slice(F.coalesce(F.get(lines, i + 1)["words"], none), 1, 1))
        return (F.size(l["words"]) > 0) & F.arrays_overlap(_word_pairs(around), joining)

    def over(starts: Column) -> Column:
        return F.transform(lines, lambda l, i: F.struct(l["n"].alias("n"), F.get(starts, i).alias("start"), (F.get(starts, i) + l["size"]).alias("end"), l["hit"].alias("hit"), l["words"].alias("words"), bears(l, i).alias("bears")))

    return _let(_running(F.transform(lines, lambda l: l["size"] + 1)), over)


def _notices(lines: Column) -> Column:
    """struct(paragraph, last, start, end, words): lines with an anchor, and runs of lines that a
    template may cover, with less than its words between the first and the last line."""

    def notice(first: Column, last: Column, words: Column) -> Column:
        return F.struct(first["n"].alias("paragraph"), last["n"].alias("last"), first["start"].alias("start"), last["end"].alias("end"), words.alias("words"))

    def from_line(first: Column) -> Column:
        def over(rest: Column) -> Column:
            def fits(last: Column, k: Column) -> Column:
                inner, tail = F.slice(rest, F.lit(1), k), F.slice(rest, F.lit(1), k + 1)
                few = F.aggregate(inner, F.lit(0), lambda a, l: a + F.size(l["words"])) < _LONGEST
                return F.forall(tail, lambda l: l["bears"]) & few & (first["hit"] | F.exists(tail, lambda l: l["hit"]))

            return F.transform(F.filter(rest, fits), lambda last: notice(first, last, F.concat(first["words"], F.flatten(F.transform(F.slice(rest, F.lit(1), last["n"] - first["n"]), lambda l: l["words"])))))

        return _let(F.slice(lines, first["n"] + 2, F.lit(_LONGEST + 1)), over)

    single = F.transform(F.filter(lines, lambda l: l["hit"]), lambda l: notice(l, l, l["words"]))
    return F.concat(single, F.flatten(F.transform(F.filter(lines, lambda l: l["bears"]), from_line)))


def scan_licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, similarity: float = SIMILARITY, model: LicenceModel | None = None) -> DataFrame:
    """Licence notices: doc_id, paragraph (number of the first line, from 0), start, end (code
    points), family, probability, similarity (share of the closest template's words and word pairs
    found in the notice), confirmed (similarity reached).

    A row for each notice that is classified as a family; those below the calibrated threshold are
    unknown and give none, and of notices that share a line the confirmed one, then the closest to
    a template by Dice's coefficient stays.  Null and empty texts have no notices; rows of null id
    and repeated rows are scanned each for itself; an empty table gives an empty result; other
    columns are not read.
    """
    spark = docs.sparkSession
    model = model or fit()
    anchors = "|".join(re.escape(a) for a in sorted(set(ANCHORS), key=lambda a: (-len(a), a)))
    gate = rf"(?i)(?<![a-z0-9])(?:{anchors})(?:v?[0-9][0-9.]*)?(?![a-z0-9])"
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").rlike(gate))
    found = found.withColumn("_doc", F.monotonically_increasing_id())
    notices = _let(_lines(F.col("text"), gate), lambda lines: _let(_marked(lines), _notices))
    hits = found.select("doc_id", "_doc", F.inline(notices))
    hits = hits.select(F.monotonically_increasing_id().alias("_row"), "_doc", "doc_id", "paragraph", "last", "start", "end", F.array_distinct(F.concat("words", _word_pairs(F.col("words")))).alias("grams"))
    hits = materialize(hits, "paragraphs")
    scored = hits.select("_row", F.explode("grams").alias("gram")).join(F.broadcast(_weights(spark, model)), "gram")
    sums = [F.sum(F.get("w", F.lit(k))) for k in range(len(model.families))]
    scored = scored.groupBy("_row").agg(F.array(*[s + F.lit(float(b)) for s, b in zip(sums, model.bias)]).alias("z"))
    top = F.array_max("z")
    scored = scored.select("_row", (1 / F.aggregate("z", F.lit(0.0), lambda a, v: a + F.exp((v - top) / model.temperature))).alias("probability"), F.array_position("z", top).alias("k"))
    names = F.array(*[F.lit(f) for f in model.families])
    scored = scored.withColumn("family", F.get(names, F.col("k").cast("int") - 1)).where((F.col("family") != UNKNOWN) & (F.col("probability") >= model.threshold))
    found = hits.join(scored.select("_row", "family", "probability"), "_row").join(F.broadcast(_templates(spark)), "family")
    common = F.size(F.array_intersect("template", "grams"))
    keys = ["_row", "_doc", "doc_id", "paragraph", "last", "start", "end", "family", "probability"]
    found = found.groupBy(*keys).agg(F.max(common / F.size("template")).alias("similarity"), F.max(2 * common / (F.size("template") + F.size("grams"))).alias("dice"))
    found = found.withColumn("confirmed", F.col("similarity") >= similarity)
    order = [(~F.col("confirmed")).alias("o1"), (-F.col("dice")).alias("o2"), (F.col("last") - F.col("paragraph")).alias("o3"), (-F.col("probability")).alias("o4")]
    ranked = found.groupBy("_doc").agg(F.array_sort(F.collect_list(F.struct(*order, "paragraph", "last", "doc_id", "start", "end", "family", "probability", "similarity", "confirmed"))).alias("all"))
    apart = lambda a, c: (a["last"] < c["paragraph"]) | (c["last"] < a["paragraph"])
    kept = F.aggregate("all", F.slice("all", 1, 0), lambda own, c: F.when(F.forall(own, lambda a: apart(a, c)), F.concat(own, F.array(c))).otherwise(own))
    return ranked.select(F.inline(kept)).select("doc_id", "paragraph", "start", "end", "family", "probability", "similarity", "confirmed")
