import re

import pytest

from emporia.llm.licenses import TEMPLATES, scan_licenses, template_bigrams
from tests.llm.conftest import ROWS

MIT = next(t for n, t in TEMPLATES if n == "MIT" and "charge" in t)


def brute(text, templates=TEMPLATES, threshold=0.8):
    """All (unit, template) coefficients, without any pruning."""
    plain = re.sub(r"[^\w\n]+|_+", " ", (text or "").lower())
    units = plain.split("\n") + [p for p in re.split(r"\n *(?:\n *)+", plain) if "\n" in p]
    hits = []
    for u in units:
        w = u.split()
        a = {f"{x} {y}" for x, y in zip(w, w[1:])}
        for name, t in templates:
            b = set(template_bigrams(t))
            if a and b and (d := 2.0 * len(a & b) / (len(a) + len(b))) >= threshold:
                hits.append((d, name))
    best = max(hits, default=(None, None))
    return len(hits), best[1], best[0]


TEXTS = ["Some words.\nReleased under the MIT License.\nMore words.", "released UNDER the mit   license", MIT, MIT.upper(),
         MIT.replace(" free of", "\nfree of").replace("Software", "Program"), "a\n\n" + MIT[:60] + "\n" + MIT[60:] + "\n\nb",
         "A.\nAll rights reserved.", "All rights reserved.\n" * 50, "Licensed under CC BY 4.0.", "licence", "", None, "\n\n\n",
         "Licensed under the Apache License, Version 1.1.", "word " * 5000 + "\n" + MIT, "ä ö\nAll rights reserved"]


def test_against_all_comparisons(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = scan_licenses(df)
    assert got.columns == ["doc_id", "n_matches", "license", "dice", "matches"]
    rows = {r["doc_id"]: (r["n_matches"], r["license"], r["dice"]) for r in got.collect()}
    assert rows == {k: brute(t) for k, t in enumerate(TEXTS)}
    assert [r["matches"][0]["unit"] for r in got.where("doc_id = 1").collect()] == ["released under the mit license"]


@pytest.mark.parametrize("threshold", [0.3, 0.5, 1.0])
def test_thresholds(spark, threshold):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = {r["doc_id"]: (r["n_matches"], r["license"], r["dice"])
            for r in scan_licenses(df, threshold=threshold).collect()}
    assert rows == {k: brute(t, threshold=threshold) for k, t in enumerate(TEXTS)}


def test_odd_rows(odd_docs, no_docs):
    got = sorted(((r["doc_id"], r["n_matches"], r["license"], r["dice"]) for r in scan_licenses(odd_docs).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in ROWS), key=str)
    assert scan_licenses(no_docs).count() == 0


def test_own_and_no_templates(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma"), (2, "other text here")], "doc_id long, text string")
    own = {r["doc_id"]: r["license"] for r in scan_licenses(df, templates=[("own", "Alpha, beta: gamma!")]).collect()}
    assert own == {1: "own", 2: None}
    assert {r["n_matches"] for r in scan_licenses(df, templates=[("none", "word")]).collect()} == {0}
    with pytest.raises(ValueError):
        scan_licenses(df, threshold=0.0)


def test_only_builtin_operators_and_no_shuffle(odd_docs):
    plan = scan_licenses(odd_docs)._jdf.queryExecution().executedPlan().toString()
    own = plan.split("InMemoryTableScan")[0]
    assert "Python" not in own and "Arrow" not in own and "Exchange" not in own


FULL = [t for n, t in TEMPLATES if n == "MIT"][-3:]
PASSAGES = [  # text, n_matches of the licence, licence, its best coefficient
    ("This project is released under the MIT License.", 1, "MIT", 1.0),
    ("Copyright (c) 2024 Jane Doe. All rights reserved.", 1, "reserved", 1.0),
    ("Licensed under the Apache License, Version 2.0. See LICENSE for details.", 1, "Apache-2.0", 1.0),
    ("Licensed under the MIT License.", 1, "MIT", 1.0),
    ("Some code, released under\nthe MIT\n\nLicense. And more.", 1, "MIT", 1.0),
    ("x " * 300 + "All rights reserved. Then y. All rights reserved, z " + "x " * 300, 2, "reserved", 1.0),
    ("A.\nAll rights reserved.\nB 2024. All rights reserved. C", 2, "reserved", 1.0),
    ("Ours is licensed under the Apache Software License, Version 2.0. See there.", 1, "Apache-2.0", 0.8),
    ("Uses the Apache License, and was licensed under the Apache License, Version 1.1.", 1, "Apache-1.1", 1.0),
    ("Uses the Apache License, and is not licensed, as others are, under the Apache terms.", 0, None, None),
    ("Under the License this work is free, in reserved words.", 0, None, None),
]


def test_notices_among_other_words(spark):
    df = spark.createDataFrame([(k, p[0]) for k, p in enumerate(PASSAGES)], "doc_id long, text string")
    rows = {r["doc_id"]: (r["n_matches"], r["license"], r["dice"]) for r in scan_licenses(df).collect()}
    assert rows == {k: p[1:] for k, p in enumerate(PASSAGES)}


@pytest.mark.parametrize("width", [40, 72, 10_000])
def test_full_notices_wrapped_or_not(spark, width):
    import textwrap

    text = "\n\n".join(textwrap.fill(p, width) for p in ["MIT License", "Copyright (c) 2024 Jane Doe", *FULL])
    mark = "\n".join(" * " + line for line in text.split("\n"))
    embedded = "Some words before. " + " ".join(FULL) + " Some words after."
    df = spark.createDataFrame([(1, text), (2, mark), (3, embedded)], "doc_id long, text string")
    for r in scan_licenses(df).collect():
        assert (r["license"], r["dice"]) == ("MIT", 1.0)
        units = {m["unit"] for m in r["matches"] if m["dice"] == 1.0}
        for t in FULL:
            assert " ".join(re.sub(r"[\W_]+", " ", t.lower()).split()) in units


def test_a_long_line_of_notices_loses_none(spark):
    df = spark.createDataFrame([(1, "Page 1. All rights reserved. " * 3000)], "doc_id long, text string")
    assert scan_licenses(df).first()["n_matches"] == 3000


def brute_passages(text, templates, threshold=0.8):
    """(name, dice, words) of the runs of words that match, by trying all runs
    of a template's size bound, best first; units that match are put apart."""
    plain = re.sub(r"[^\w\n]+|_+", " ", text.lower())
    words = plain.replace("\n", " ").split()
    found = []
    for name, t in templates:
        b = set(template_bigrams(t))
        low, high = len(b) * threshold / (2 - threshold) * (1 - 1e-9), len(b) * (2 - threshold) / threshold * (1 + 1e-9)
        runs = []
        for s in range(len(words) - 1):
            for n in range(1, int(high) + 1):
                if s + n < len(words):
                    grams = [f"{x} {y}" for x, y in zip(words[s:s + n], words[s + 1:s + n + 1])]
                    a = set(grams)
                    if n >= low and (d := 2.0 * len(a & b) / (len(a) + len(b))) >= threshold and grams[0] in b and grams[-1] in b:
                        runs.append((-d, n, s))
        found += best_first([(-d, -n, -s, name) for d, n, s in runs])
    return [(name, d, " ".join(words[-s:n - s + 1])) for d, n, s, name in best_first(found)]


def best_first(runs):
    taken = []
    for d, n, s, name in sorted(((d, -n if n < 0 else n, s, name) for d, n, s, name in runs), reverse=True):
        if all(n - s < -s2 or n2 - s2 < -s for _, n2, s2, _ in taken):
            taken.append((d, n, s, name))
    return taken


OWN = [("A", "alpha beta gamma delta epsilon zeta"), ("B", "one two three"), ("C", "alpha beta one two alpha beta gamma")]


@pytest.mark.parametrize("threshold", [0.8, 0.6])
def test_passages_against_all_runs(spark, threshold):
    """Random texts of template words, some left out, repeated and mixed with others, on one
    line that is no unit of any template."""
    import random

    rng = random.Random(5)
    rows = []
    for k in range(150):
        words = ["x0", "x1"]
        for _ in range(rng.randrange(1, 4)):
            for w in rng.choice(OWN)[1].split():
                words += [w] * rng.choice([1, 1, 1, 1, 0, 2]) + ["and"] * rng.choice([0, 0, 0, 0, 1])
            words += [f"y{rng.randrange(9)}" for _ in range(rng.randrange(12))]
        words += [f"z{i}" for i in range(40)]
        rows.append((k, " ".join(words)))
    want = {k: sorted(brute_passages(t, OWN, threshold)) for k, t in rows}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: sorted((m["name"], m["dice"], m["unit"]) for m in r["matches"])
           for r in scan_licenses(df, templates=OWN, threshold=threshold).collect()}
    assert got == want and sum(map(len, want.values())) > 60


SHORTENED = [  # notices that leave words out, or name another version
    ("Intro words here. This work is licensed under a Creative Commons Attribution International License. More words follow this.",
     "CC-BY-4.0"),
    ("We say: this work is licensed under the GNU General Public License, version 2, and mean it.", "GPL-2.0"),
    ("Note: this program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation; either version 2 of the License, or any later version. Bye.",
     "GPL-2.0"),
    ("It is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or any later version of it.", "AGPL-3.0"),
    ("Our library is licensed under the BSD 3-Clause License, as others are.", "BSD-3-Clause"),
]


def test_shortened_notices(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(SHORTENED)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in scan_licenses(df).collect()}
    for k, (text, name) in enumerate(SHORTENED):
        assert got[k]["license"] == name, text
        # as a unit if the whole line matches, else the best run
        unit = brute(text, [t for t in TEMPLATES if t[0] == name])[2]
        assert got[k]["dice"] == (unit or max(d for n, d, _ in brute_passages(text, TEMPLATES) if n == name))
