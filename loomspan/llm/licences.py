"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line; one of more than ``WINDOW`` words is read in windows that overlap by half, so that nothing is left
out. Lines without a blank one between them are then read together, for notices that are wrapped: what is confirmed there and in
none of the lines is added, as of the first of them. Its distinct word 1- to 3-grams, hashed to ``FEATURES`` places, go through a sparse multinomial logistic regression
(follow-the-regularised-leader with elastic net) over licence families and ``unknown``. It is trained here on variants of
the templates below (words dropped, foreign words around) and, as unknown, on ordinary sentences and on pieces of
templates too short to mean a licence. A held-out part fits the temperature and then the least score of a licence: the
smallest at which at most ``FALSE_SHARE`` of the unknown pass. A prediction counts as confirmed if at least ``COVERAGE``
of the word pairs of one of the family's templates stand in the paragraph; only confirmed ones name a document's licence.

Nulls: a null or empty text has no paragraph and no licence. Repeated rows are read each alike; a null id stays. No rows
give no rows.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import namedtuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.langid import _softmax, fit_ftrl
from loomspan.llm.scratch import ship, with_columns
from loomspan.llm.shingles import mixed

FEATURES, GRAMS, WINDOW = 1 << 17, 3, 200
VARIANTS, FALSE_SHARE, COVERAGE, SPARSE = 24, 0.02, 0.7, 0.5
#: A licence has at least this calibrated score.
LEAST_SCORE = 0.2
UNKNOWN = "unknown"
#: Notices by which works state their licence, by family; identifiers of a machine-readable notice follow by rule.
TEMPLATES = {
    "MIT": [
        "MIT License", "The MIT License (MIT)", "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Apache License Version 2.0, January 2004", "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-2.0": [
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "This work is licensed under the GNU General Public License, version 2.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    ],
    "GPL-3.0": [
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "LGPL-2.1": [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or any later version.",
    ],
    "LGPL-3.0": [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "This library is licensed under the GNU Lesser General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "AGPL-3.0": [
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "This program is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "MPL-2.0": [
        "Mozilla Public License Version 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", "Released under the 2-clause BSD License.", "Licensed under the Simplified BSD License."],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "Released under the 3-clause BSD License.", "Licensed under the New BSD License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "BSD": ["Released under the BSD License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "ISC": ["ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "EPL-2.0": ["Eclipse Public License v 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["CC0 1.0 Universal", "To the extent possible under law, the author has waived all copyright and related rights to this work.", "Released under CC0 1.0 into the public domain."],
    "Proprietary": ["All rights reserved.", "All rights reserved. No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher."],
}
#: Families without an identifier of their own, and those whose identifiers also say which versions are meant.
UNIDENTIFIED, WITH_VERSIONS = ("BSD", "Proprietary"), ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
for _family, _texts in TEMPLATES.items():
    _texts += [f"SPDX-License-Identifier: {_family}{more}" for more in (("", "-only", "-or-later") if _family in WITH_VERSIONS else ("",))] if _family not in UNIDENTIFIED else []
#: A template of so few words counts only in a paragraph of at most so many: a heading, not a mention.
SHORT, SHORT_WITHIN = 3, 8
#: Ordinary sentences, some of them with the licences' words.
ORDINARY = [
    "The driver showed his license to the officer at the border.", "She was released from hospital under the care of her doctor.", "The city council issued a new license for the market.",
    "Version two of the report is under review by the board.", "The public library is open from nine to five.", "All rights and duties of members are listed in the statute.",
    "He got permission to use the garden behind the house.", "The software was updated last night without any problem.", "This work is part of a larger study on rivers.",
    "General elections are held every four years in the country.", "The company was granted a patent for the engine.", "Copies of the letter were sent to all families.",
    "The notice above the door says that the shop is closed.", "An international conference on commons and forests took place.", "The Apache helicopter landed near the river.",
    "The author thanks the foundation for its support.", "Free entry for children under the age of twelve.", "The terms of the contract were not met in time.", "The source of the river lies in the hills.",
    "A license is required to fish in this lake.", "The album was released in May and sold well.", "It is licensed to carry forty passengers.", "The university offers courses in law and in history.",
    "The band released the album under the MIT label in 2004.", "She studied at MIT and later wrote about the Apache people of Arizona.", "The eclipse was visible to the general public in version two of the planetarium.", "Mozilla announced a new browser for phones.",
    "A simplified form of the clause was added to the new agreement.", "The foundation published either version of the story in its magazine.", "Creative work in common rooms needs attribution of tasks.", "The domain was released to the public by the museum.",
    "Redistribution of land was permitted under the following conditions.", "The Lesser Antilles lie between two seas.", "No part of the bridge may be used without written permission.", "Neither the name nor the address of the holder was known.", "Anyone is free to use the path along the lake.",
]
Model = namedtuple("Model", "families weights temperature least")
_WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = h = zlib.crc32(word.encode())
        return h


_hashes = _WordHashes()


def places_of(words: list[str]) -> np.ndarray:
    """Hashed places of the distinct 1- to 3-grams, and the last one, which is the bias."""
    h = np.array([_hashes[w] for w in words], np.uint64)
    grams, total = [], np.zeros(len(h), np.uint64)
    for n in range(min(GRAMS, len(h))):
        total = total[: len(h) - n] * np.uint64(0x9E3779B97F4A7C15) + h[n:] + np.uint64(n)
        grams.append(mixed(total) & np.uint64(FEATURES - 1))
    return np.append(np.unique(np.concatenate(grams)) if grams else np.zeros(0), FEATURES).astype(np.int64)


def _pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


_TEMPLATE_PAIRS = {family: [_pairs(words_of(t)) for t in texts] for family, texts in TEMPLATES.items()}
#: Words with a digit of each template.
_VERSIONS = {family: [{w for w in words_of(t) if re.search("[0-9]", w)} for t in texts] for family, texts in TEMPLATES.items()}
_SIZES = {family: [len(words_of(t)) for t in texts] for family, texts in TEMPLATES.items()}
_ALL_PAIRS = set().union(*[t for texts in _TEMPLATE_PAIRS.values() for t in texts])


def coverage(words: list[str], family: str) -> float:
    """The largest share of a template's word pairs that stand in the paragraph; a template with a version counts only if that is there,
    a heading only in a short paragraph."""
    own, there = _pairs(words), set(words)
    shares = [len(t & own) / len(t) for t, v, n in zip(_TEMPLATE_PAIRS[family], _VERSIONS[family], _SIZES[family], strict=True) if v <= there and (n > SHORT or len(words) <= SHORT_WITHIN)]
    return max(shares, default=0.0)


def confirmed(words: list[str], family: str) -> bool:
    """Whether a template of the family stands in the paragraph, and none of another family does so better: what tells Affero, Lesser and versions apart."""
    own = coverage(words, family)
    return own >= COVERAGE and all(coverage(words, other) <= own for other in TEMPLATES if other != family)


def _samples(variants: int) -> list[tuple[list[str], int, int]]:
    """Words, class and the number of the template or sentence that they were made of."""
    rng, families = random.Random(11), [*TEMPLATES, UNKNOWN]
    foreign = lambda: ["".join(rng.choice("abcdefghilmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(0, 12))]
    common = [w for s in ORDINARY for w in words_of(s)]
    samples, number = [], 0
    for i, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            words, number = words_of(template), number + 1
            for v in range(variants):
                kept = [w for w in words if len(words) < 8 or v == 0 or rng.random() > 0.1]
                around = [rng.choice(common) for _ in range(rng.randint(0, 4))] if v % 3 == 2 else []
                samples.append((foreign() + around + kept + foreign() if v and len(words) > SHORT else kept, i, number))
                if len(words) > 4:
                    piece = rng.randint(0, len(words) - 2)
                    samples.append((foreign() + words[piece : piece + 2] + foreign(), len(families) - 1, number))
    for sentence in ORDINARY:
        number += 1
        for _ in range(variants):
            samples.append((foreign() + words_of(sentence) + foreign(), len(families) - 1, number))
            samples.append((foreign() + rng.sample(common, 8) + foreign(), len(families) - 1, number))
    rng.shuffle(samples)
    return samples


def train(variants: int = VARIANTS) -> Model:
    """The classifier, from the tables of this module alone: the same each time.

    Temperature and threshold come from a first fit that has not seen every fourth template and sentence, on these: variants of one text never
    lie on both sides. The weights are then fitted to all of them."""
    families, rows, held, logits, right = _held_out(variants)
    temperature = min(np.exp(np.linspace(-2, 3, 101)), key=lambda t: -np.log(np.maximum(_softmax(logits / t)[np.arange(len(right)), right], 1e-12)).mean())
    scores = _softmax(logits / temperature)[:, :-1].max(1)
    others = np.sort(scores[right == len(families) - 1])[::-1]
    return Model(families, _fit(rows, families).astype(np.float32), float(temperature), max(LEAST_SCORE, float(others[int(FALSE_SHARE * len(others))]) + 1e-9))


def _fit(rows, families) -> np.ndarray:
    return fit_ftrl([(at, np.ones(len(at)), y) for at, y, *_ in rows], len(families), FEATURES, epochs=2, l1=SPARSE)


def _held_out(variants: int):
    """Families, all rows (places, class, source, words), those of every fourth source, and the logits and classes of these by a fit without them."""
    families = [*TEMPLATES, UNKNOWN]
    rows = [(places_of(w), y, source, w) for w, y, source in _samples(variants)]
    held = [r for r in rows if r[2] % 4 == 0]
    weights = _fit([r for r in rows if r[2] % 4], families)
    return families, rows, held, np.array([weights[at].sum(0) for at, *_ in held]), np.array([y for _, y, *_ in held])


def rates(model: Model, variants: int = VARIANTS) -> dict[str, float]:
    """Shares on templates and sentences that the judging fit has not seen: unknown ones taken for a licence, and confirmed as one; licences not predicted, and licences
    of seen templates that the model at hand doesn't confirm."""
    families, rows, held, logits, right = _held_out(variants)
    p = _softmax(logits / model.temperature)
    best, unknown = p[:, :-1].argmax(1), right == len(families) - 1
    passed = p[np.arange(len(p)), best] >= model.least
    sure = np.array([bool(x) and confirmed(r[3], families[i]) for x, i, r in zip(passed, best, held, strict=True)])
    known = np.abs(model.weights).sum(1) > 0
    whole = [(words_of(t), f) for f, texts in TEMPLATES.items() for t in texts]
    missed = [not _labels(w, model, known).get(f, (0, False))[1] for w, f in whole]
    return {"false": float(passed[unknown].mean()), "false_confirmed": float(sure[unknown].mean()), "missed_unseen": float(1 - (passed & (best == right))[~unknown].mean()), "missed_templates": float(np.mean(missed))}


_GAPS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _gaps(model: Model) -> np.ndarray:
    """Of each place by how much its weight for any licence exceeds that for unknown, at most; of the last model asked for."""
    if id(model.weights) not in _GAPS:
        _GAPS.clear()
        _GAPS[id(model.weights)] = model.weights, (model.weights[:, :-1] - model.weights[:, -1:]).max(1)
    return _GAPS[id(model.weights)][1]


def _labels(words: list[str], model: Model, known: np.ndarray) -> dict[str, tuple[float, bool]]:
    """Families of the windows of some words: the best score, and whether that window is confirmed."""
    step, best, gaps = WINDOW // 2, {}, _gaps(model)
    # A licence can't reach the least score where the gaps together don't.
    least = model.temperature * np.log(model.least / max(1e-9, 1 - model.least)) - 1e-3
    for at in range(0, max(1, len(words) - step), step):
        part = words[at : at + WINDOW]
        places = places_of(part)
        if not known[places[:-1]].any() or gaps[places].sum(dtype=np.float64) < least:
            continue
        p = _softmax(model.weights[places].sum(0, dtype=np.float64) / model.temperature)
        i = int(p[:-1].argmax())
        if p[i] >= model.least and p[i] > best.get(model.families[i], (0,))[0]:
            best[model.families[i]] = (float(p[i]), confirmed(part, model.families[i]))
    return best


#: Places of the templates' word pairs, and the least number of them that confirms one.
_PAIR_PLACES = np.zeros(FEATURES, bool)
_PAIR_PLACES[np.concatenate([places_of([x, y])[:-1] for x, y in _ALL_PAIRS])] = True
_LEAST_PAIRS = min(COVERAGE * len(t) for texts in _TEMPLATE_PAIRS.values() for t in texts)


def _bounds(words: list[str], model: Model) -> tuple[list, list]:
    """For the 1-, 2- and 3-grams of a text's words, sums from the start of what each adds to a licence's gap at most. Repeated ones count again, so the
    grams of a window together never add less than its distinct ones. Then, as sums too, which pairs of words can be a template's."""
    pairs = [0]
    h = np.array([_hashes[w] for w in words], np.uint64)
    gaps, sums, total = _gaps(model), [], np.zeros(len(h), np.uint64)
    for n in range(min(GRAMS, len(h))):
        total = total[: len(h) - n] * np.uint64(0x9E3779B97F4A7C15) + h[n:] + np.uint64(n)
        at = mixed(total) & np.uint64(FEATURES - 1)
        sums.append([0.0, *np.cumsum(np.maximum(gaps[at], 0), dtype=np.float64).tolist()])
        if n == 1:
            pairs += np.cumsum(_PAIR_PLACES[at]).tolist()
    return sums, pairs


def _reachable(sums: list, start: int, end: int, model: Model, least: float) -> bool:
    """Whether some window of the words start to end can reach the least score, by `_bounds`; if not, `_labels` finds nothing there."""
    step = WINDOW // 2
    for at in range(start, max(start + 1, end - step), step):
        stop = min(end, at + WINDOW)
        if sum(s[max(at, stop - n)] - s[at] for n, s in enumerate(sums) if stop - n > at) >= least:
            return True
    return False


def _wrapped(text: str, block: list[tuple[int, int, int]], found: list[dict], model: Model, known: np.ndarray) -> list[dict]:
    """Confirmed licences of lines (number, a, b) read together that no line of them confirms. A hyphen at a line's end joins."""
    if len(block) < 2:
        return []
    words = words_of(re.sub(r"(?<=\w)-[ \t\r]*\n[ \t]*", "-", text[block[0][1] : block[-1][2]]))
    own = _pairs(words) & _ALL_PAIRS
    # No window can be confirmed if all of the words can't.
    if not any(len(t & own) >= COVERAGE * len(t) for texts in _TEMPLATE_PAIRS.values() for t in texts):
        return []
    sure = {f["family"] for f in found if f["confirmed"] and f["paragraph"] >= block[0][0]}
    return [{"paragraph": block[0][0], "family": f, "score": s, "confirmed": True, "a": block[0][1], "b": block[-1][2]} for f, (s, c) in sorted(_labels(words, model, known).items()) if c and f not in sure]


def scan_text(text: str, model: Model, known: np.ndarray) -> tuple[int, list[dict]]:
    """Number of paragraphs, and the licences found: paragraph, family, score, confirmed, a, b (characters). known: places with any weight."""
    found, n, start, block, read = [], 0, 0, [], 0
    lines = [(line, words_of(line)) for line in text.split("\n")]
    sums, pairs = _bounds([w for _, words in lines for w in words], model)
    first, hyphen = 0, False
    # As in `_labels`; the margin covers the order of the sums.
    least = model.temperature * np.log(model.least / max(1e-9, 1 - model.least)) - float(_gaps(model)[FEATURES]) - 2e-3
    for number, (line, words) in enumerate(lines):
        n += bool(line.strip())
        if _reachable(sums, read, read + len(words), model, least):
            found += [{"paragraph": number, "family": f, "score": s, "confirmed": c, "a": start, "b": start + len(line)} for f, (s, c) in sorted(_labels(words, model, known).items())]
        if line.strip():
            if not block:
                first, hyphen = read, False
            block.append((number, start, start + len(line)))
            hyphen = hyphen or line.rstrip(" \t\r").endswith("-")
        read += len(words)
        if block and (not line.strip() or number == len(lines) - 1):
            # Without words that are joined over lines, the block's pairs are known: too few of them confirm nothing.
            last = len(pairs) - 1
            if hyphen or pairs[min(max(first, read - 1), last)] - pairs[min(first, last)] >= _LEAST_PAIRS:
                found += _wrapped(text, block, found, model, known)
            block = []
        start += len(line) + 1
    return n, found


def scan(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_paragraphs, found (list of the licences of paragraphs) of every row."""
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model or train())

    def run(batches):
        import pyarrow as pa

        known = np.abs(shared.value.weights).sum(1) > 0
        kind = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("score", pa.float64()), ("confirmed", pa.bool_()), ("a", pa.int32()), ("b", pa.int32())]))
        for batch in batches:
            read = [scan_text(text.as_py() or "", shared.value, known) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in read], pa.int32()), pa.array([f for _, f in read], kind)], ["doc_id", "n_paragraphs", "found"])

    schema = "doc_id long, n_paragraphs int, found array<struct<paragraph:int,family:string,score:double,confirmed:boolean,a:int,b:int>>"
    return with_columns(documents, {"doc_id": "long", "text": "string"}).mapInArrow(run, schema)


def op2_licences(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    sure = F.filter("found", lambda x: x["confirmed"])
    families = F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",")
    return found.select("doc_id", "n_paragraphs", F.size(sure).alias("n_licences"), families.alias("families"), F.array_max(F.transform(sure, lambda x: x["score"])).alias("score"), (F.size("found") - F.size(sure)).alias("n_unconfirmed"))
