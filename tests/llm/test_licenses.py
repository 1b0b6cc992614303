import math
import re

import pytest

from cellar.llm import licenses as L
from tests.llm.common import SCHEMA, SMALL, frame, odd_rows, rows_of

TR = str.maketrans(L.UPPER, L.LOWER)


def expected(rows):
    sets = L.template_sets()
    out = []
    for r in rows:
        text = r[1] or ""
        w = re.findall(L.WORDS, text.translate(TR))
        places, base = [], set()
        for phrase, label in L.PHRASES.items():
            p = phrase.split()
            here = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
            places += here
            base |= {label} if here else set()
        more, score = set(), 1.0 if base else 0.0
        for block in re.split(L.BLOCK_END, text):
            b = set(re.findall(L.WORDS, block.translate(TR)))
            for label, t in sets.items():
                common = len(b & set(t))
                if common >= math.ceil(L.CONTAINMENT * len(t) - 1e-9):
                    more.add(label)
                    score = max(score, common / len(t))
        out.append((r[0], len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
                    ",".join(sorted(base | more)), score))
    return sorted(out, key=str)


def check(df, rows):
    got = sorted((tuple(r) for r in L.scan(df).collect()), key=str)
    want = expected(rows)
    assert [g[:-1] for g in got] == [w[:-1] for w in want]
    assert [g[-1] for g in got] == pytest.approx([w[-1] for w in want])


def test_odd_rows(spark):
    rows = odd_rows()
    check(frame(spark, rows), rows)


def test_phrases_and_templates(spark):
    texts = ["CC BY CC-by cc.by", "the GNU general, public\nLICENSE and all rights reserved", "general public licenses", "accby cc byte",
             "Foo. Released under the MIT License. Bar", "released under mit license", "Licensed under the\nApache License, Version 2.0",
             "Éall rights reserved", "Licensed under the Apache License, Version 2.0.", "licensed Apache version 2 license the", *L.TEMPLATES.values(),
             *[" ".join(t.split()[1:]) for t in L.TEMPLATES.values()], *[" ".join(reversed(t.split())) + " x" for t in L.TEMPLATES.values()],
             *[" ".join(t.split()[::2]) for t in L.TEMPLATES.values()], "All RIGHTS reserved all rights reserved " * 50]
    rows = rows_of(texts)
    check(frame(spark, rows), rows)


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_prefix_join_finds_every_pair(spark):
    """Random blocks over few words, several thresholds: the join against all pairs."""
    import random
    rng = random.Random(5)
    pool = [f"t{i}" for i in range(12)]
    templates = {f"l{i}": " ".join(rng.sample(pool, rng.randint(2, 9))) for i in range(8)}
    texts = [" ".join(rng.choices(pool + ["z"], k=rng.randint(1, 14))) for _ in range(150)]
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, print long, text string")
    for c in (0.4, 0.7, 1.0):
        got = {(r["id"], r["label"]) for r in L.template_matches(df, templates, c).collect()}
        want = {(i, label) for i, t in enumerate(texts) for label, s in templates.items()
                if len(set(t.split()) & set(s.split())) >= max(1, math.ceil(c * len(set(s.split())) - 1e-9))}
        assert got == want


def named(spark, texts):
    out = {r["doc_id"]: r for r in L.notices(frame(spark, rows_of(texts))).collect()}
    base = set(L.PHRASES.values())
    return [set(out[i]["labels"].split(",")) - base - {""} for i in range(len(texts))], [out[i]["score"] for i in range(len(texts))]


def test_templates_that_differ_by_a_word(spark):
    cases = {L.TEMPLATES[label]: {label} for label in L.TEMPLATES}
    cases |= {"Licensed under CC BY 4.0.": set(), "Licensed under CC BY-NC 4.0.": {"cc-by-nc-4.0"}, "Licensed under CC BY-SA 4.0.": {"cc-by-sa-4.0"},
              "Licensed under CC BY-SA v4.0.": {"cc-by-sa-4.0"}, "Licensed under CC BY-SA 3.0.": set(),
              "Released under the BSD license.": set(), "Released under the Apache License.": set(), "Released under the MIT License.": {"mit"},
              "This work is licensed under the GNU General Public License, version 3.": {"gpl-3.0"},
              "This work is licensed under the GNU General Public License, version 2.": set(),
              "Licensed under the GNU Affero General Public License version 3": {"agpl-3.0"}}
    got, score = named(spark, list(cases))
    assert dict(zip(cases, got)) == cases
    assert score[list(cases).index("Released under the BSD license.")] == 0


def test_labels_are_those_named_in_real_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: r["labels"].split(",") for r in L.notices(docs).collect()}
    for r in docs.collect():
        text = " ".join(re.findall(L.WORDS, (r["text"] or "").translate(TR)))
        for label, word in {"agpl-3.0": "affero", "cc-by-nc-4.0": "nc", "cc-by-sa-4.0": "sa", "mit": "mit"}.items():
            assert label not in got[r["doc_id"]] or word in text.split()


def test_notices_wrapped_at_line_ends(spark):
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. {}. If a copy of the MPL was not"
    cases = {"Redistribution and use in source and binary forms, with or without\nmodification, are permitted": {"bsd"},
             mpl.format("2.0"): {"mpl-2.0"}, mpl.format("1.1"): set(),
             "# Licensed under the Apache\r\n# License, Version 2.0": {"apache-2.0"},
             "Permission to use, copy, modify, and/or distribute this\nsoftware for any purpose with or without fee\nis hereby granted": {"isc"},
             "Licensed under the Apache\r\n\r\nLicense, Version 2.0": set(),
             **{t.replace(" ", "\n"): {label} for label, t in L.TEMPLATES.items()}}
    got, _ = named(spark, list(cases))
    assert dict(zip(cases, got)) == cases
