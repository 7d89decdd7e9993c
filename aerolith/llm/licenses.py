"""License scans: MinHash bands over overlapping text windows, verified by exact shingle containment. DataFrame functions only."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerolith.llm.common import let

GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} Public License"
    " as published by the Free Software Foundation, {version}."
)
GNU_KINDS = (
    ("GPL-2.0", "program", "General", "2"), ("GPL-3.0", "program", "General", "3"), ("LGPL-2.0", "library", "Library General", "2"),
    ("LGPL-2.1", "library", "Lesser General", "2.1"), ("LGPL-3.0", "program", "Lesser General", "3"), ("AGPL-3.0", "program", "Affero General", "3"),
)
CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
            "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
BSD_3 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
    " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
    " distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
    " promote products derived from this software without specific prior written permission."
)

# Public license notices (SPDX id, text). Callers may pass their own.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the"
        " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
        " persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and"
        " this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
        " distribution.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with"
        " the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
        " version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    *(
        (f"{k}-or-later", GNU.format(what=w, name=n, version=f"either version {v} of the License, or (at your option) any later version"))
        for k, w, n, v in GNU_KINDS
        if k != "GPL-3.0"
    ),
    *((f"{k}-only", GNU.format(what=w, name=n, version=f"version {v} of the License")) for k, w, n, v in GNU_KINDS),
    (
        "GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License version 2 as published by the Free Software Foundation.",
    ),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", BSD_3),
    *((f"CC-{k}-4.0", f"Licensed under CC {k} 4.0.") for k in CREATIVE if k != "BY-NC"),
    *((f"CC-{k}-4.0", f"This work is licensed under a Creative Commons {n} 4.0 International License.") for k, n in CREATIVE.items()),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,"
        " compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,"
        " commercial or non-commercial, and by any means.",
    ),
    (
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at"
        " http://www.boost.org/LICENSE_1_0.txt)",
    ),
    (
        "Zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it"
        " and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be"
        " misrepresented; you must not claim that you wrote the original software.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is"
        " available at https://www.eclipse.org/legal/epl-2.0/",
    ),
)

SHINGLE = 5
NOT_WORD = r"[^a-z0-9\x{80}-\x{10FFFF}]+"


def words(text: Column) -> Column:
    """Lower-cased words (ASCII letters and digits, and all code points beyond ASCII)."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, NOT_WORD, -1), lambda w: w != "")


def shingles(text: Column) -> Column:
    """64-bit hash of each run of five words."""

    def hashed(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
        return F.when(F.size(w) >= SHINGLE, each).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), hashed)


@dataclass(frozen=True)
class SizeClass:
    """Templates of about one size and how texts are cut for them.

    Windows start every ``step`` shingles and hold ``blocks`` steps, so that
    any run of the largest size lies whole in one of them. A band is one
    MinHash row: the ``bands`` smallest hashes of a set, of which each is in
    both sets with the probability of their Jaccard similarity. Their number
    makes a window with the wanted containment of the smallest template share
    a band with it with at least the wanted probability.
    """

    templates: tuple[int, ...]
    step: int
    blocks: int
    bands: int


def size_classes(sizes: list[int], containment: float, probability: float) -> list[SizeClass]:
    out: list[SizeClass] = []
    todo = sorted((n, k) for k, n in enumerate(sizes))
    while todo:
        least = todo[0][0]
        chosen = [(n, k) for n, k in todo if n <= 1.25 * least]
        todo = todo[len(chosen) :]
        most = chosen[-1][0]
        step = -(-most // 4) if most > 4 else 1
        blocks = -(-(most + step - 1) // step)
        common = math.ceil(containment * least - 1e-9)
        jaccard = common / (blocks * step + least - common)
        bands = 1 if jaccard >= 1 else math.ceil(math.log(1 - probability) / math.log(1 - jaccard))
        out.append(SizeClass(tuple(k for _, k in chosen), step, blocks, bands))
    return out


def _window(h: Column, c: SizeClass, w: Column) -> Column:
    return F.slice(h, (w * c.step + 1).cast("int"), F.lit(c.step * c.blocks))


def candidate_windows(h: Column, c: SizeClass, template_hashes: list[list[int]]) -> Column:
    """Numbers of the windows that share a band with a template of the class."""
    values = sorted({x for t in c.templates for x in sorted(template_hashes[t])[: c.bands]})
    literal = F.array(*[F.lit(x) for x in values])

    def meets(w: Column) -> Column:
        window = _window(h, c, w)
        if c.bands == 1:
            return F.array_min(window).isin(values)
        return F.arrays_overlap(F.slice(F.sort_array(F.array_distinct(window)), 1, c.bands), literal)

    # A band is a shingle hash of the window, hence of the text: one probe tells that no window can have any of the values.
    last = F.floor((F.size(h) - 1) / c.step).cast("int")
    windows = F.filter(F.sequence(F.lit(0), last), meets)
    return F.when(F.arrays_overlap(h, literal), windows).otherwise(F.array().cast("array<int>"))


def find_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    containment: float = 0.8,
    probability: float = 0.999,
) -> DataFrame:
    """(doc_id, n_matches, licenses, matches, best_licenses) of each document.

    ``matches`` has (license, template, containment, first_word) for each
    template of which a window holds at least ``containment`` of the distinct
    5-word shingles: the best window, the first of equal ones. ``licenses``
    lists their ids, sorted, comma-joined; ``best_licenses`` leaves out each
    match that an overlapping window with a better containment accounts for
    (an equal one, of a larger template): one that reaches no more than the
    share of its shingles that the better template holds itself. One pass over the texts without a
    shuffle. The templates are a stated list (their shingles become literals
    of the plan); those of fewer than five words find nothing. Null and short
    texts match nothing; repeated rows come out as often as they go in.
    """
    spark = docs.sparkSession
    hashes = _template_hashes(spark, templates)
    usable = [k for k, h in enumerate(hashes) if h]
    classes = size_classes([len(hashes[k]) for k in usable], containment, probability)

    none = F.array().cast("array<struct<license:string,template:int,containment:double,first_word:int>>")

    def _match(t: int, best: Column) -> Column:
        row = F.struct(
            F.lit(templates[t][0]).alias("license"), F.lit(t).alias("template"),
            best["share"].alias("containment"), (-best["start"]).cast("int").alias("first_word"),
        )
        return F.when(best.isNotNull(), F.array(row)).otherwise(none)

    def _matcher(t: int):
        return lambda best: _match(t, best)

    def _best(h: Column, windows: Column, c: SizeClass, t: int) -> Column:
        literal = F.array(*[F.lit(x) for x in hashes[t]])

        def scored(w: Column) -> Column:
            share = F.size(F.array_intersect(_window(h, c, w), literal)) / F.lit(float(len(hashes[t])))
            return F.struct(share.alias("share"), (-w * c.step).alias("start"))

        return F.array_max(F.filter(F.transform(windows, scored), lambda s: s["share"] >= containment - 1e-9))

    def _verified(h: Column, c: SizeClass) -> Column:
        def of(windows: Column) -> Column:
            parts = [let(_best(h, windows, c, t), _matcher(t)) for t in c.templates]
            return F.when(F.size(windows) > 0, F.concat(*parts)).otherwise(none)

        return let(candidate_windows(h, c, hashes), of)

    def matches(h: Column) -> Column:
        named = [SizeClass(tuple(usable[t] for t in c.templates), c.step, c.blocks, c.bands) for c in classes]
        return F.concat(none, *[_verified(h, c) for c in named])

    length = {usable[t]: c.step * c.blocks for c in classes for t in c.templates}
    # (share of a template's shingles in another, size of either, shingles in a window of either) where that share is a match by itself
    pairs = []
    for a in usable:
        for b in usable:
            share = len(set(hashes[a]) & set(hashes[b])) / len(hashes[a])
            if a != b and share >= containment - 1e-9:
                pairs.append((a, b, share, len(hashes[b]) > len(hashes[a]) or (len(hashes[b]) == len(hashes[a]) and b < a)))
    names_of = ("t", "o", "share", "larger", "n", "m")
    table = [F.struct(*[F.lit(x).alias(y) for x, y in zip((a, b, share, larger, length[a], length[b]), names_of)]) for a, b, share, larger in pairs]

    def accounted(m: Column, o: Column) -> Column:
        def by(p: Column) -> Column:
            better = (o["containment"] > m["containment"] + 1e-9) | ((o["containment"] >= m["containment"] - 1e-9) & p["larger"])
            overlap = (o["first_word"] < m["first_word"] + p["n"]) & (m["first_word"] < o["first_word"] + p["m"])
            return (p["t"] == m["template"]) & (p["o"] == o["template"]) & better & overlap & (m["containment"] <= p["share"] + 1e-9)

        return F.exists(F.array(*table), by)

    rows = docs.select(F.col(id_col).alias("doc_id"), let(shingles(F.coalesce(F.col(text_col), F.lit(""))), matches).alias("matches"))

    def joined(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["license"]))), ",")

    best = F.filter("matches", lambda m: ~F.exists("matches", lambda o: accounted(m, o))) if pairs else F.col("matches")
    return rows.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"), joined(F.col("matches")).alias("licenses"), "matches", joined(best).alias("best_licenses")
    )


def _template_hashes(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> list[list[int]]:
    """Distinct shingle hashes of each template."""
    if not templates:
        return []
    rows = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(templates)], "k int, text string")
    found = rows.select("k", F.array_sort(F.array_distinct(shingles(F.col("text")))).alias("h")).collect()
    return [list(r["h"]) for r in sorted(found, key=lambda r: r["k"])]


# --- the same in DuckDB -----------------------------------------------------------


def oracle(templates: tuple[tuple[str, str], ...] = TEMPLATES, containment: float = 0.8, probability: float = 0.999) -> str:
    """DuckDB SQL of the registered query: exact containment in every window."""
    found = []
    for _, text in templates:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        w = [x for x in re.split("[^a-z0-9\x80-\U0010ffff]+", lower) if x]
        found.append(sorted({" ".join(w[k : k + SHINGLE]) for k in range(len(w) - SHINGLE + 1)}))
    usable = [k for k, f in enumerate(found) if f]
    kinds, parts, length = [], [], {}
    for c in size_classes([len(found[k]) for k in usable], containment, probability):
        for t in (usable[k] for k in c.templates):
            length[t] = c.step * c.blocks
            kinds.append(f"({t}, '{templates[t][0]}', {c.step}, {c.blocks}, {len(found[t])})")
            parts += [f"({t}, '{x}')" for x in found[t]]
    inside = []  # templates that a window of another one already holds
    for a in usable:
        for b in usable:
            share = len({*found[a]} & {*found[b]}) / len(found[a])
            if a != b and share >= containment - 1e-9:
                larger = len(found[b]) > len(found[a]) or (len(found[b]) == len(found[a]) and b < a)
                inside.append(f"({a}, {b}, {share!r}::DOUBLE, {str(larger).lower()}, {length[a]}, {length[b]})")
    inside = ", ".join(inside) or "(-1, -1, 0::DOUBLE, false, 0, 0)"
    # fmt: off
    return f"""
    WITH kinds(template, license, step, blocks, n) AS (VALUES {", ".join(kinds)}),
    parts(template, s) AS (VALUES {", ".join(parts)}),
    lists AS (
      SELECT doc_id, w FROM (
        SELECT doc_id, [x FOR x IN string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') IF x <> ''] AS w FROM documents)),
    shingled AS (
      SELECT doc_id, i - 1 AS i, array_to_string(list_slice(w, i, i + {SHINGLE - 1}), ' ') AS s FROM (
        SELECT doc_id, w, unnest(generate_series(1, len(w) - {SHINGLE - 1})) AS i FROM lists WHERE len(w) >= {SHINGLE})),
    windows AS (
      SELECT doc_id, template, license, step, n, s,
             unnest(generate_series(greatest(0, (i - step * blocks + step) // step), i // step)) AS w
      FROM (SELECT * FROM shingled WHERE i >= 0) JOIN parts USING (s) JOIN kinds USING (template)),
    shares AS (
      SELECT doc_id, template, license, w * step AS first_word, count(DISTINCT s) / n AS share
      FROM windows GROUP BY doc_id, template, license, step, n, w HAVING count(DISTINCT s) / n >= {containment} - 1e-9),
    best AS (
      SELECT * FROM shares QUALIFY row_number() OVER (PARTITION BY doc_id, template ORDER BY share DESC, first_word) = 1),
    inside(t, o, share, larger, n, m) AS (VALUES {inside}),
    own AS (
      SELECT doc_id, array_to_string(list_sort(list(DISTINCT license)), ',') AS best_licenses FROM best x
      WHERE NOT EXISTS (
        SELECT 1 FROM best y JOIN inside p ON p.o = y.template
        WHERE y.doc_id = x.doc_id AND p.t = x.template AND x.share <= p.share + 1e-9
          AND (y.share > x.share + 1e-9 OR (y.share >= x.share - 1e-9 AND p.larger))
          AND y.first_word < x.first_word + p.n AND x.first_word < y.first_word + p.m)
      GROUP BY doc_id),
    each_doc AS (
      SELECT doc_id, count(*) AS n_matches, array_to_string(list_sort(list(DISTINCT license)), ',') AS licenses, max(share) AS containment,
             array_to_string(list_sort(list(license || ':' || template || ':' || first_word)), ',') AS matches FROM best GROUP BY doc_id)
    SELECT doc_id, coalesce(n_matches, 0)::BIGINT AS n_matches, coalesce(licenses, '') AS licenses,
           coalesce(containment, 0)::DOUBLE AS containment, coalesce(matches, '') AS matches, coalesce(best_licenses, '') AS best_licenses
    FROM documents LEFT JOIN each_doc USING (doc_id) LEFT JOIN own USING (doc_id)"""
    # fmt: on
