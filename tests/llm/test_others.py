"""Top-k, chat formatting, toxicity, licenses and the pipeline against brute force."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from takepick.llm.chat_format import format_chats, loss_text
from takepick.llm.license_scan import TEMPLATES, Template, apart, scan, scan_licenses, words
from takepick.llm.queries import op7_topk, op9_toxicity
from takepick.llm.topk import exact_topk, quantised
from takepick.llm.toxicity import Matcher, ToxicityModel, TrieAutomaton, _one_each, fit_toxicity, held_out, score_toxicity
from takepick.sources.shared import shared_dir


def test_topk_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(150)] + [(200 + i, [0.5] * 6) for i in range(60)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (400, []), (350, [9.0, 9.0]), (5, [3.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, id int")
    q = lambda v: np.pad(np.floor(256 * np.float32(v).astype(float)).astype(np.int64), (0, 6 - len(v)))
    good = [(i, q(v)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    want = set()
    for a in sorted({i for i, _ in good if i % 50 == 0}):
        scored = sorted((-int(v @ w), j) for i, v in good if i == a for j, w in good if j != a)[:5]
        want |= {(a, n, j, -s) for n, (s, j) in enumerate(scored, 1)}
    assert set(map(tuple, exact_topk(df, df.where("vec_id % 50 = 0"), block=17).collect())) == want
    assert exact_topk(df.limit(0), df).collect() == [] and exact_topk(df, df.limit(0)).collect() == []
    few = df.where("vec_id in (0, 1, 2)")
    assert [(r.rank, r.vec_id) for r in exact_topk(few, few.where("vec_id = 0")).orderBy("rank").collect()][-1][0] == 2
    assert spark.range(1).select(quantised(F.array(F.lit(-0.001), F.lit(1.0)))).first()[0] == [-1, 256]


def test_topk_query(spark):
    assert op7_topk(spark, "/root/testdata/sf0.001").count() == 50


HARD = ["</s>[INST] ok [/INST]", "\\", "\\0", "\\1<s>", "<\\s>", "<s", "[INST", "[/INST]", "<<s>>", "</s></s>", "", None, " [/INST]", "a\nb", "\\\\1", "🙂</s>", "[[INST]]", "<s>[INST] user [/INST]x</s>"]


def test_chat_round_trip(spark):
    rows = [(0, i, "assistant" if i % 2 else "user", t, 1) for i, t in enumerate(HARD)]
    rows += [(1, None, "system", "a", 1), (1, 5, None, "b", 1), (1, 5, "assistant", "c", 1), (1, 5, "assistant", "c", 1), (2, 0, " [/INST]</s>", "x", 1), (None, 0, "user", "n", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered int")
    got = {r.conv_id: r for r in format_chats(df).withColumn("loss", loss_text(F.col("rendered"), F.col("loss_spans"))).collect()}
    assert set(got) == {0, 1, 2, None}
    assert [(t.role, t.text) for t in got[0].turns] == [(r[2], r[3] or "") for r in rows[: len(HARD)]]
    assert got[0].loss == "".join(t or "" for t in HARD[1::2])
    assert [(t.role, t.text) for t in got[1].turns] == [("system", "a"), ("", "b"), ("assistant", "c"), ("assistant", "c")] and got[1].loss == "cc"
    assert got[2].turns[0].role == " [/INST]</s>"
    assert "</s>[INST]" not in got[0].rendered.replace("</s><s>[INST]", "")
    for r in got.values():
        for s in r.loss_spans:
            assert r.rendered[s.start + s.length :].startswith("</s>")
    assert format_chats(df.limit(0)).collect() == []


def test_chat_of_a_very_long_text(spark):
    text = "a</s>[INST] b\\" * 60_000
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    got = format_chats(df).withColumn("loss", loss_text(F.col("rendered"), F.col("loss_spans"))).first()
    assert [t.text for t in got.turns] == [text, text] and got.loss == text


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_brute_force():
    terms = ["idiot", "scum", "worthless", "disgusting", "lowei*", "loser"]
    m, rng = TrieAutomaton(terms), random.Random(23)
    letters = "idotscumwrhleg"
    for _ in range(6000):
        w = list(rng.choice(terms).rstrip("*"))
        for _ in range(rng.randrange(4)):
            at, kind = rng.randrange(len(w) + 1), rng.randrange(3)
            if kind == 0:
                w.insert(at, rng.choice(letters))
            elif w and at < len(w):
                w[at : at + 1] = [] if kind == 1 else [rng.choice(letters)]
        word = "".join(w)
        want = []
        for n, t in enumerate(terms):
            if t.endswith("*"):
                if word.startswith(t[:-1]):
                    want.append((0, n))
            elif word[:1] == t[:1] and (d := levenshtein(word[1:], t[1:])) <= TrieAutomaton.edits(t):
                want.append((d, n))
            elif word[1:] == t[1:] and word and TrieAutomaton.edits(t):
                want.append((1, n))
        got = m.match(word)
        assert (got is None) == (not want), word
        if want:
            assert got[1] == min(want)[0], word


def test_context_separates_quotation():
    m = Matcher(ToxicityModel(["idiot"], [5.0], frozenset({"idiom"}), np.array([-3.0, 3.0, 2.0, 0.0])))
    clean, abuse, typo, first, quoted, said, word = m.scores([None, "you idiot go", "you idiott go", "you 1diot go", 'he wrote "you idiot" there', "she said idiot once", "an idiom"])
    assert abuse > 0.7 and typo == first > 0.5 and word == clean < 0.1 and max(quoted, said) < 0.5
    called, scare, both = m.scores(["you are called an idiot", 'you "idiot" go', "du wurdest Idiot genannt sagte er"])
    assert min(called, scare, both) > 0.7
    assert m.scores(["x " * 30000 + "idiot"])[0] == abuse and m.scores(["q" * 500 + " idiot!"])[0] == abuse


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op9_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hit, toxic, flagged = (sum(1 for r in got if f(r)) for f in (lambda r: r.toxic and r.predicted, lambda r: r.toxic, lambda r: r.predicted))
    assert hit / toxic > 0.85 and hit / flagged > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_near_copies_are_learned_from_once_for_each_label(spark):
    base = ["w%d" % i for i in range(100)]
    rows = [(1, 0, " ".join(base)), (2, 0, " ".join(base)), (3, 1, " ".join(base)), (4, 1, " ".join(base[:95])), (5, 0, " ".join(base[:40] + ["x%d" % i for i in range(60)])), (6, 0, ""), (7, 0, None), (8, 1, "a b")]
    got = _one_each(spark.createDataFrame(rows, "id long, y int, text string")).collect()
    assert sorted((r.y, len((r.text or "").split())) for r in got) == [(0, 0), (0, 0), (0, 100), (0, 100), (1, 2), (1, 100)]


def test_score_does_not_depend_on_how_many_documents_are_drawn(spark):
    """Labels drawn at different rates leave the model's start at the share of all labelled documents."""
    rng = random.Random(43)
    rows = [(i, " ".join(["z%d" % rng.randrange(3000) for _ in range(30)] + (["horrid"] if i % 10 == 0 and i % 70 else []))) for i in range(1, 1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    whole, part = (score_toxicity(docs.where("doc_id = 1"), fit_toxicity(docs, labels, sample_per_label=n)).first().score for n in (4000, 120))
    assert abs(whole - part) < 0.02


def test_toxicity_without_labels_and_with_clashes(spark):
    docs = spark.createDataFrame([(1, "a", 9.0), (1, None, 1.0), (None, "", 2.0)], "doc_id long, text string, score double")
    model = fit_toxicity(docs, spark.createDataFrame([(1, None), (None, 1), (1, 5)], "doc_id long, toxic int"))
    rows = score_toxicity(docs, model).collect()
    assert len(rows) == 3 and all(r.score < 0.01 and r.predicted == 0 for r in rows)
    assert score_toxicity(docs.limit(0), model).collect() == []
    import zlib

    for r in spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect():
        assert r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def shown(template):
    """A template's text as it stands in a document."""
    return re.sub("[{}]", "", re.sub(r"\s*\[[^]]*\]", "", template))


def brute_scan(text, templates, least=0.8):
    """Licenses of a short text by whole-text LCS: names whose phrases are there word for word, best coverage of words."""
    out = {}
    for name, t in templates.items():
        plain, phrases, others = words(shown(t)), [words(p) for p in re.findall("{(.*?)}", t)], [words(p) for p in re.findall(r"\[(.*?)\]", t)]
        there = lambda p: any(text[i : i + len(p)] == p for i in range(len(text)))
        if all(map(there, phrases)) and not any(map(there, others)) and lcs(text, plain) >= least * len(plain):
            out[name.partition("/")[0]] = lcs(text, plain)
    return {n for n, x in out.items() if x == max(out.values())}


def test_licenses(spark):
    rng = random.Random(29)
    noise = lambda n: " ".join("z%d" % rng.randrange(1000) for _ in range(n))
    plain = {n: shown(t) for n, t in TEMPLATES.items()}
    rows, want = [(0, None), (1, ""), (2, noise(500)), (None, plain["ISC"])], {(None, "ISC", 1.0): 1}
    for i, (name, text) in enumerate(plain.items()):
        w = text.split()
        rows += [(100 + i, noise(300) + "\n" + text.upper() + "\n" + noise(3000)), (200 + i, text + " " + noise(30) + " " + text + " " + text), (300 + i, " ".join(w[: len(w) // 2])), (300 + i, noise(5))]
        name, gone = name.partition("/")[0], (4, 5) if name == "HPND" else (8, 9)
        want |= {(100 + i, name, 1.0): 1, (200 + i, name, 1.0): 3}
        if len(w) > 20:
            cut = [x for k, x in enumerate(w) if k not in gone]
            rows.append((400 + i, noise(10) + " " + " ".join(cut)))
            want[400 + i, name, (len(words(text)) - sum(len(words(w[k])) for k in gone)) / len(words(text))] = 1
    got = {}
    for r in scan_licenses(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string")).collect():
        got[r.doc_id, r.license, r.coverage] = got.get((r.doc_id, r.license, r.coverage), 0) + 1
        if r.doc_id == 100:
            assert r.first_word == 300
    assert {k: n for k, n in got.items() if k[0] is None or not 300 <= k[0] < 400} == want
    assert scan(words(noise(50)), Template("MIT", TEMPLATES["MIT"])) == []
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []


NEAR = {
    "Released under the BSD License.": "BSD (statement)",
    "Licensed under the Apache License, Version 1.1.": "Apache-1.1 (statement)",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0 (statement)",
    "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0 (statement)",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0 (statement)",
    "Licensed under CC BY 4.0.": "CC-BY-4.0 (statement)",
    "Licensed under CC BY 3.0.": None,
    "Licensed under CC BY-NC 2.0, see 4.0": None,
    "Released under the MIT-style License.": None,
    "Released under the Zlib License.": None,
    "Licensed under the Apache License, Version 3.0.": None,
    "This work is licensed under the GNU General Public License, version 4.": None,
    "No rights reserved.": None,
    "All rights are reserved": None,
}


def test_licenses_that_differ_by_a_word():
    templates = [Template(*x) for x in TEMPLATES.items()]
    for text, name in NEAR.items():
        for around in ("", "a b c d e f g "):
            mine = words(around + text + " " + around)
            found = [(m, t.name) for t in templates for m in scan(mine, t)]
            assert [found[i][1] for i in apart([m for m, _ in found])] == ([name] if name else []), text
        assert brute_scan(words(text), TEMPLATES) == ({name} if name else set())


GRANT = shown(TEMPLATES["MIT"]).split(" subject to")[0]
BSD = shown(TEMPLATES["BSD-2-Clause"])
#: Notices that are another's but for a clause: each has its own name or none.
OTHERS = {
    "HPND": "Permission to use, copy, modify and distribute this software and its documentation for any purpose and without fee is hereby granted, provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation, and that the name of the author not be used in advertising.",
    "BSD-4-Clause": BSD + " All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the University of California, Berkeley and its contributors. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-3-Clause": BSD + " The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE AUTHOR",
    "JSON": shown(TEMPLATES["MIT"]) + " The Software shall be used for Good, not Evil.",
    "MIT-0": GRANT + " THE SOFTWARE IS PROVIDED",
    "MIT": shown(TEMPLATES["MIT"]) + " THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND",
    "ISC": shown(TEMPLATES["ISC"]) + " THE SOFTWARE IS PROVIDED AS IS",
    "BSD-2-Clause": BSD + " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS",
}
OUTSIDE = [
    "This is not released under the MIT License.",
    "It isn’t licensed under the Apache License, Version 2.0.",
    "Never released under the BSD License.",
    shown(TEMPLATES["MIT"]) + " Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale.",  # X11
    BSD.split(" Redistributions in binary")[0] + " THIS SOFTWARE IS PROVIDED",  # BSD-1-Clause
    BSD.replace("are permitted provided", "are permitted (subject to the limitations in the disclaimer below) provided") + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",  # BSD-3-Clause-Clear
    BSD + " The end-user documentation included with the redistribution, if any, must include the following acknowledgment: This product includes software developed by the Foundation. The names must not be used to endorse or promote products derived from this software without prior written permission.",  # Apache-1.1
    BSD + " Subject to the terms and conditions of this license, each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual patent license.",  # BSD-2-Clause-Patent
    "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",  # PostgreSQL
    "Permission to use, copy, modify, and distribute this software and its documentation for any purpose with or without fee is hereby granted, provided that the above copyright notice appears in all copies and that both the copyright notice and this permission notice appear in supporting documentation.",  # NTP
    "Permission is hereby granted, free of charge, to any person obtaining a copy of the fonts accompanying this license (Fonts) and associated documentation files (the Font Software), to reproduce and distribute the Font Software, including without limitation the rights to use, copy, merge, publish, distribute, and/or sell copies of the Font Software, and to permit persons to whom the Font Software is furnished to do so, subject to the following conditions: The above copyright and trademark notices and this permission notice shall be included in all copies of one or more of the Font Software typefaces.",  # Bitstream Vera
    GRANT + " subject to the following conditions: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimers.",  # NCSA
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",  # BSL-1.0
    "This software is provided as-is, without any express or implied warranty. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",  # Zlib
    "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",  # WTFPL
    "As long as you retain this notice you can do whatever you want with this stuff. If we meet some day, and you think this stuff is worth it, you can buy me a beer in return.",  # Beerware
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at this address.",  # EPL-2.0
    "The contents of this file are subject to the terms of the Common Development and Distribution License, Version 1.0. You may not use this file except in compliance with the License.",  # CDDL-1.0
    "Licensed under the Educational Community License, Version 2.0; you may not use this file except in compliance with the License.",  # ECL-2.0
    "Licensed under the EUPL, Version 1.2.",
]


def test_notices_of_other_licenses(spark):
    rows = [(i, "Copyright (c) 2001 A. Person\n\n" + t) for i, t in enumerate([*OTHERS.values(), *OUTSIDE])]
    rows += [(100, BSD + " THIS SOFTWARE IS PROVIDED. Copyright 2002 B. " + OTHERS["BSD-3-Clause"]), (101, "This is not free. Released under the MIT License."), (102, "We do not care: it is Released under the MIT License.")]
    got = {}
    for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append(r.license)
    assert got == {i: [n] for i, n in enumerate(OTHERS)} | {100: ["BSD-2-Clause", "BSD-3-Clause"], 101: ["MIT (statement)"]}


def test_licenses_brute_force():
    """Notices with words dropped, changed and inserted: the same names as by whole-text LCS."""
    rng, templates = random.Random(31), [Template(*x) for x in TEMPLATES.items()]
    some = 0
    for _ in range(400):
        w = words(shown(rng.choice(list(TEMPLATES.values()))))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice(([], ["zz"], [w[at], "yy"]))
            w = w or ["zz"]
        found = [(m, t.name) for t in templates for m in scan(w, t)]
        got, want = {found[i][1] for i in apart([m for m, _ in found])}, brute_scan(w, TEMPLATES)
        assert got <= want, (w, got, want)
        some += got == want
    assert some >= 392  # alignment may match less than the longest common subsequence


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, [{r.doc_id: r.text for r in docs.collect()}]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "substring dedup", "packing"]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        assert docs.columns == columns and docs.where("n_chars <> length(text)").count() == 0
        seen.append({r.doc_id: r.text for r in docs.collect()})
        assert docs.count() == len(seen[-1])
    toxic = {r.doc_id for r in score_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), fit_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))).where("predicted = 1").collect()}
    assert set(seen[1]) == set(seen[0]) - toxic
    assert set(seen[2]) == set(seen[1]) and set(seen[4]) == set(seen[3])
    from test_dedup import brute_near, full_lines, held_before

    rows = list(seen[1].items())
    assert {i: full_lines(t) for i, t in seen[2].items()} == dict(held_before(rows))
    rows = list(seen[2].items())
    assert set(seen[3]) == {i for (i, _), (n, c) in zip(rows, brute_near(rows, 5)) if not n or c == i}
    whole = corpus_pipeline.run(spark, sf).groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all")).collect()
    assert {r.doc_id for r in whole} == set(seen[4]) and all(r.n == r["all"] for r in whole)
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_pipeline_stage_with_nulls_and_extra_columns(spark, stage):
    rows = [(1, None, None, "a", None, 1, "k"), (None, "x", "en", None, 1, 2, "k"), (2, "", "en", "b", 0, 3, "k"), (2, "y " * 200, None, None, 400, 4, "k"), (3, "y " * 200, None, None, 400, 5, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, tp_id long, sources string")
    out = stage(spark, docs, "/root/testdata/sf0.001")
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == docs.columns and out.count() >= 4
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
    else:
        assert out.count() >= 5


def test_pipeline_goes_on_after_a_failure_and_leaves_nothing(spark, tmp_path, monkeypatch):
    calls, broken = [], [True]

    def stage(name):
        def run(spark, docs, sf_dir):
            calls.append(name)
            if name == "c" and broken[0]:
                raise RuntimeError("lost")
            return docs.withColumn("text", F.concat("text", F.lit(name)))

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, stage(n)) for n in "abcd"])
    sf, kept = "/root/testdata/sf0.001", str(tmp_path / "kept")
    for folder in (None, kept):
        with pytest.raises(RuntimeError):
            corpus_pipeline.run(spark, sf, folder)
    shared = shared_dir(spark).removeprefix("file:")
    assert not [p for p in os.listdir(shared) if p.startswith("pipeline-")]
    broken[0] = False
    calls.clear()
    out = corpus_pipeline.run(spark, sf, kept)
    assert calls == ["c", "d"] and out.where(~F.endswith("text", F.lit("abcd"))).count() == 0
    assert corpus_pipeline.run(spark, sf).count() == out.count() and not [p for p in os.listdir(shared) if p.startswith("pipeline-")]


def test_pipeline_keeps_columns_named_like_the_score(spark):
    rows = [(i, "word%d and more of it" % i, 5.0 + i, "p", True) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, Predicted string, _score boolean")
    out = corpus_pipeline.toxicity(spark, docs, "/root/testdata/sf0.001")
    assert out.schema == docs.schema and sorted(map(tuple, out.collect())) == rows


def test_a_kept_pipeline_is_bound_to_its_input(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", lambda spark, docs, sf_dir: docs.select("doc_id"))])
    for n in (3, 5):
        for table in ("documents", "labels"):
            spark.range(n).withColumnRenamed("id", "doc_id").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / f"in{n}" / f"{table}.parquet"))
    kept = str(tmp_path / "kept")
    assert [corpus_pipeline.run(spark, str(tmp_path / f"in{n}"), kept).count() for n in (3, 3, 5)] == [3, 3, 5]
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("b", lambda spark, docs, sf_dir: docs.limit(1))])
    assert corpus_pipeline.run(spark, str(tmp_path / "in5"), kept).count() == 1


def test_near_dedup_keeps_one_row_of_a_repeated_document(spark):
    words = " ".join("w%d" % i for i in range(100))
    rows = [(1, words), (1, words), (2, words), (3, words + " x"), (None, words), (4, "alone in this text"), (4, "alone in this text"), (5, "unlike all others"), (6, ""), (6, ""), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, tp_id int")
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted([("1", words), ("4", rows[5][1]), ("5", rows[7][1]), ("6", ""), ("6", ""), ("None", "no id")])
