import random
import re

from conftest_llm import as_docs

from aerolith.llm import licenses

SPLIT = re.compile("[^a-z0-9\x80-\U0010ffff]+")


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in SPLIT.split(low) if x]
    return [tuple(w[k : k + 5]) for k in range(len(w) - 4)]


def slow(text, templates, classes):
    s, out = shingles(text), []
    for c in classes:
        for t in c.templates:
            wanted, best = set(shingles(templates[t][1])), None
            for w in range(0, len(s), c.step):
                share = len(set(s[w : w + c.step * c.blocks]) & wanted) / len(wanted)
                if share >= 0.8 - 1e-9 and (best is None or share > best[0]):
                    best = (share, w)
            if best:
                out.append((templates[t][0], t, round(best[0], 9), best[1]))
    return sorted(out)


def test_matches_brute_force(spark, hard_rows):
    templates = licenses.TEMPLATES
    classes = licenses.size_classes([len(set(shingles(t))) for _, t in templates], 0.8, 0.999)
    rng = random.Random(1)
    vocabulary = [w for _, t in templates for w in t.split()] + [f"zeta{k}" for k in range(300)]
    rows = list(hard_rows)
    for k in range(60):
        w = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.02]) else x for x in templates[k % len(templates)][1].split()]
        rows.append((1000 + k, " ".join([*rng.choices(vocabulary, k=rng.randrange(90)), *w, *rng.choices(vocabulary, k=rng.randrange(90))])))
    text = dict(rows)
    found = licenses.find_licenses(as_docs(spark, rows)).collect()
    total = 0
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(i) for i, _ in rows)
    for r in found:
        mine = sorted((m["license"], m["template"], round(m["containment"], 9), m["first_word"]) for m in r["matches"])
        total += len(mine)
        assert mine == slow(text[r["doc_id"]], templates, classes)
        assert r["n_matches"] == len(mine) and r["licenses"] == ",".join(sorted({m[0] for m in mine}))
    assert total >= 50


def test_own_templates_short_templates_and_empty_table(spark):
    docs = as_docs(spark, [(1, "one two three four five six"), (2, None), (3, "")])
    templates = (("A", "one two three four five"), ("B", "too short"))
    assert {r["doc_id"]: r["licenses"] for r in licenses.find_licenses(docs, templates=templates).collect()} == {1: "A", 2: "", 3: ""}
    assert licenses.find_licenses(docs.limit(0)).collect() == []
    assert licenses.find_licenses(docs, templates=()).where("n_matches > 0").count() == 0


def test_bands_reach_the_wanted_probability():
    for c in licenses.size_classes([1, 3, 8, 30, 58, 83], 0.8, 0.999):
        assert c.bands >= 1 and c.step >= 1 and c.blocks * c.step >= c.step


def test_common_licenses_are_told_apart(spark):
    gnu = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."  # noqa: E501
    texts = {
        gnu.format("Affero General", 3): "AGPL-3.0-or-later", gnu.format("Lesser General", 3): "LGPL-3.0-or-later",
        gnu.format("General", 2): "GPL-2.0-or-later", gnu.format("General", 3): "GPL-3.0-or-later",
        "Licensed under CC BY 4.0.": "CC-BY-4.0", "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        licenses.BSD_3: "BSD-3-Clause", licenses.BSD_3.split(" 3. ")[0]: "BSD-2-Clause",
        gnu.format("General", 3) + " " + gnu.format("Affero General", 3): "AGPL-3.0-or-later,GPL-3.0-or-later",
    }
    rows = list(enumerate(f"some words before it: {t} And some after it." for t in texts))
    found = {r["doc_id"]: r["best_licenses"] for r in licenses.find_licenses(as_docs(spark, rows)).collect()}
    assert [found[k] for k, _ in rows] == list(texts.values())
