"""Exact, near, substring and line dedup against brute force, with nulls, ties, repeats and clashing columns."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from takepick.llm import exact_dedup as exact_module
from takepick.llm.exact_dedup import exact_dedup
from takepick.llm.graph import components, merged
from takepick.llm import line_dedup, minhash
from takepick.llm.line_dedup import common_lines, dedup_lines, duplicate_lines
from takepick.llm.common import Scratch, Words, sets_of_shingles
from takepick.llm.minhash import _differences, near_duplicates, sketch
from takepick.llm.patience import align, blocks, longest_increasing
from takepick.llm.substring_dedup import GEAR, chunk, dedup_substrings, duplicate_spans

LONG = "Wörd %d ﬁ " * 900
ROWS = [
    (1, "Same Text"), (2, "same text"), (3, "SAME TEXT"), (3, "same text"), (4, None), (5, ""), (None, ""), (None, "same text"), (6, "ÄB"), (7, "äb"),
    (8, LONG), (9, LONG.lower()), (10, LONG + "x"), (11, "x" * 1024), (12, "x" * 1025), (13, "x" * 2048), (14, "X" * 2048), (15, "same text "), (16, "🙂" * 1500), (17, "🙂" * 1500),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "c", 0, 5) for i, t in rows], "doc_id long, text string, name string, rid int, level int")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_exact_dedup_brute_force(spark):
    got = exact_dedup(frame(spark, ROWS)).collect()
    want = {}
    for i, t in ROWS:
        want.setdefault(lower(t), []).append(i)
    assert len(got) == len(ROWS)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in want.items()}
    kept = {}
    for r in got:
        ids = by_text[r.text_sha256]
        assert r.doc_id in ids and r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}
    assert exact_dedup(frame(spark, [])).collect() == []


def test_exact_dedup_survives_key_collisions(spark, monkeypatch):
    """The first seeds give all blocks one key: other seeds must be tried."""
    real, calls = exact_module._proven, []

    def proven(s, distinct, key):
        calls.append(1)
        return real(s, distinct, (lambda b: (b.isNull().cast("long"),) * 2) if len(calls) == 1 else key)

    monkeypatch.setattr(exact_module, "_proven", proven)
    got = exact_dedup(frame(spark, ROWS[:4] + ROWS[8:10]), block_chars=3).collect()
    assert len(calls) == 2 and sorted((r.doc_id, r.group_size) for r in got) == [(1, 4), (2, 4), (3, 4), (3, 4), (6, 1), (7, 1)]


def test_small_blocks_name_the_same_groups(spark):
    a, b = (sorted((r.doc_id or 0, r.keep_id or 0, r.group_size) for r in exact_dedup(frame(spark, ROWS), block_chars=n).collect()) for n in (7, 1024))
    assert a == b


def brute_near(rows, k, percent=80):
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", lower(t).encode())
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low.setdefault(find(i), []).append(d)
    return [(len(sets[i]), min((d for d in low[find(i)] if d is not None), default=None)) for i in range(len(rows))]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "new%d" % rng.randrange(10**9)
    return " ".join(words)


def near_rows():
    rng = random.Random(3)
    base = ["w%d" % rng.randrange(500) for _ in range(150)]
    rows = [(i, edited(rng, base, rng.randrange(12))) for i in range(100, 160)]
    other = ["v%d" % rng.randrange(500) for _ in range(200)]
    rows += [(i, " ".join(other[: 120 + i])) for i in range(80)]
    rows += [(500, "one two"), (501, "ONE\ttwo"), (502, "one"), (503, ""), (504, None), (505, "   \n"), (None, "one two"), (506, "one two three four"), (506, "one two three four"), (506, "five six")]
    rows += [(600 + i, " ".join("u%d" % rng.randrange(10**6) for _ in range(60))) for i in range(20)]
    return rows


def test_near_duplicates_brute_force(spark):
    rows = near_rows()
    for k in (4, 5):
        got = near_duplicates(frame(spark, rows), shingle=k).collect()
        want = sorted((str(d), n, str(c)) for (d, _), (n, c) in zip(rows, brute_near(rows, k)))
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    firsts = [r.component_id for r in got if r["first"] and r.n_shingles and r.component_id != 506]
    assert len(firsts) == len(set(firsts))
    assert near_duplicates(frame(spark, [])).collect() == []


def test_near_duplicates_in_groups_of_heavily_edited_copies(spark):
    """Copies of a hot text that link with nothing, chains of cuts, edits of edits, a shared passage, and pairs far from every lead."""
    rng = random.Random(37)
    base = ["h%d" % i for i in range(140)]
    edits = lambda words, n, tag: " ".join(tag + str(rng.randrange(40)) if i in set(rng.sample(range(len(words)), n)) else w for i, w in enumerate(words))
    rows = [(i, edits(base, rng.choice((1, 2, 3, 5, 8, 11, 14)), "e")) for i in range(90)]
    rows += [(200 + i, " ".join(base[: 140 - 5 * i])) for i in range(20)]
    far = [edits(base, 9, "f").split() for _ in range(5)]
    rows += [(300 + i, edits(far[i % 5], rng.choice((0, 1, 2, 6)), "g")) for i in range(40)]
    rows += [(400 + i, " ".join(base[:70] + ["p%d" % (100 * (i // 2) + j) for j in range(60)] + ["q%d" % i])) for i in range(30)]
    rows += [(500, " ".join(reversed(base))), (501, " ".join([*reversed(base)][2:])), (502, rows[0][1]), (503, rows[0][1].upper())]
    rng.shuffle(rows)
    for k in (4, 5):
        got = near_duplicates(frame(spark, rows), shingle=k).collect()
        want = sorted((d, n, c) for (d, _), (n, c) in zip(rows, brute_near(rows, k)))
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_differences_bound_every_link():
    """Two linked sets, not both near their lead, share as many differences as stated for both."""
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 60).astype(np.uint64)
    some = lambda n: np.unique(rng.choice(pool, n, replace=False))
    near = far = 0
    for _ in range(3000):
        lead = some(rng.integers(5, 40))
        a = np.unique(np.concatenate((rng.choice(lead, rng.integers(1, len(lead) + 1), replace=False), some(rng.integers(1, 12)))))
        b = np.unique(np.concatenate((rng.choice(a, rng.integers(max(1, 7 * len(a) // 8), len(a) + 1), replace=False), some(rng.integers(1, 4)))))
        both = len(np.intersect1d(a, b))
        (over_a, da, need_a, near_a), (over_b, db, need_b, near_b) = (_differences(x, lead, 80) for x in (a, b))
        common = len(np.intersect1d(lead, a))
        assert (over_a <= 0) == (100 * common >= 80 * (len(lead) + len(a) - common))
        if 100 * both >= 80 * (len(a) + len(b) - both) and not (over_a <= 0 and over_b <= 0) and len(da) and len(db):
            shared, bound = len(np.intersect1d(da, db)), 20 * len(lead)
            assert 180 * shared >= over_a + over_b + bound
            assert shared >= (near_a if over_b <= 0 else need_a) and shared >= (near_b if over_a <= 0 else need_b)
            near, far = near + (over_a <= 0 or over_b <= 0), far + (over_a > 0 and over_b > 0)
    assert near > 20 and far > 20


def test_sketch_estimates_similarity_and_fills():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[500:2500]
    doc = np.repeat([0, 1, 2], [2000, 2000, 1])
    s = sketch(doc, np.concatenate((np.sort(a), np.sort(b), pool[:1])), 4, 400)
    assert (s[:3] != np.uint64(2**64 - 1)).all() and (s[3] == np.uint64(2**64 - 1)).all()
    assert abs((s[0] == s[1]).mean() - 1500 / 2500) < 0.1


def test_words_and_shingles_contract():
    w = Words(["Ab  c\x0bD é", "", None, "x"])
    assert w.count().tolist() == [4, 0, 0, 1]
    doc, sh = sets_of_shingles(Words(["a b c a b c a b c", "a b", "A B", "b a", ""]), 3)
    assert np.bincount(doc, minlength=5).tolist() == [3, 1, 1, 1, 0] and sh[3] == sh[4] != sh[5]


def test_components_of_a_long_path_and_a_hub(spark):
    rng = random.Random(5)
    nodes = rng.sample(range(10**6), 60)
    links = list(zip(nodes, nodes[1:])) + [(2 * 10**6, 2 * 10**6 + i) for i in range(1, 40)] + [(2 * 10**6 + 7, 2 * 10**6)]
    with Scratch(spark) as s:
        got = dict(map(tuple, components(s, spark.createDataFrame(links, "a long, b long")).collect()))
        assert all(got[n] == min(nodes) for n in nodes) and all(got[2 * 10**6 + i] == 2 * 10**6 for i in range(40))
        assert components(s, spark.createDataFrame([], "a long, b long")).collect() == []


def test_links_that_come_later(spark):
    """Components of links in parts equal those of all links at once."""
    rng = random.Random(61)
    parts = [[(rng.randrange(60), rng.randrange(60)) for _ in range(n)] for n in (15, 1, 12, 3)] + [[(70, 71), (71, 0)], [(70, 0)]]
    with Scratch(spark) as s:
        labels, every = None, []
        for part in parts:
            every += part
            labels = merged(s, labels, spark.createDataFrame([x for x in part if x[0] != x[1]] or [(0, 0)], "a long, b long"))
            root = {x: x for p in every for x in p}
            for _ in root:
                for a, b in every:
                    root[a] = root[b] = min(root[a], root[b])
            got = {r.node: r.label for r in labels.collect()}
            assert labels.count() == len(got) and all(got.get(x, x) == root[x] for x in root)


def test_chunks_cover_texts_and_resist_shifts():
    rng = random.Random(7)
    text = " ".join("wörd%d" % rng.randrange(10**4) for _ in range(400))
    texts = [text, "inserted " + text, "", None, "a", "é" * 500]
    doc, start, length, digest = chunk(texts)
    for i, t in enumerate(texts):
        raw, mine = (t or "").encode(), doc == i
        ends = start[mine] + length[mine]
        assert length[mine].sum() == len(raw) and (start[mine][1:] == ends[:-1]).all()
        for a, b in zip(start[mine], ends):
            raw[a:b].decode()
    same = set(map(tuple, digest[doc == 0])) & set(map(tuple, digest[doc == 1]))
    assert len(same) >= (doc == 0).sum() - 3
    alone = chunk([text])[3]
    assert (alone == digest[doc == 0]).all()


def passage(rng, n, tag):
    return " ".join("%s%d" % (tag, rng.randrange(10**5)) for _ in range(n))


def test_planted_passages_are_cut_and_clean_texts_left(spark):
    rng = random.Random(11)
    shared = [passage(rng, 60, "pß") for _ in range(20)]
    rows = [(i, passage(rng, 80, "a") + " " + shared[i % 20] + " " + passage(rng, 50, "b")) for i in range(60)]
    rows += [(100 + i, passage(rng, 200, "c")) for i in range(40)] + [(200, rows[0][1]), (201, None), (202, ""), (None, rows[1][1]), (203, shared[0] + " | " + shared[0])]
    docs = frame(spark, rows)
    spans = duplicate_spans(docs)
    by = {}
    for r in spans.collect():
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == {*range(20, 60), 200, 203}
    assert all(r.first_doc_id == i % 20 for i in range(20, 60) for r in by[i])
    cleaned = {r.doc_id: r for r in dedup_substrings(docs, spans).collect() if r.doc_id is not None}
    assert len(cleaned) == len(rows) - 1 and list(cleaned[0].asDict()) == docs.columns
    text = dict((i, t) for i, t in rows if i is not None)
    for i, r in cleaned.items():
        if i in by:
            raw, at, parts = text[i].encode(), 0, []
            for s in sorted(by[i], key=lambda s: s.start):
                assert raw[s.start : s.start + s.length].decode() in text[s.first_doc_id] or i == 203
                parts.append(raw[at : s.start])
                at = s.start + s.length
            assert r.text == b"".join([*parts, raw[at:]]).decode()
            if i < 100:
                assert len(r.text) < len(text[i]) - 0.6 * len(shared[0])
        else:
            assert r.text == text[i]
    assert duplicate_spans(frame(spark, [])).collect() == []


def brute_spans(rows, within, mean=24, least=100):
    """Spans by a plain table of chunk bytes: byte after byte, a 16-byte hash of the last ones, then runs of chunks held before."""
    gear, table = [int(x) for x in GEAR], {}
    cut = {}
    for i, t in rows:
        raw, ends, last = (t or "").encode(), [], None
        h = [sum(gear[raw[p - k]] << k for k in range(16) if p >= k) & 0xFFFF for p in range(len(raw))]
        whole = [p + 1 == len(raw) or raw[p + 1] & 0xC0 != 0x80 for p in range(len(raw))]
        for p in range(len(raw)):
            if h[p] < (1 << 16) // mean and whole[p]:
                if last is None or p - last > 8:
                    ends.append(p + 1)
                last = p
        ends = sorted({*ends, len(raw)} - {0})
        long = [(a, b) for a, b in zip([0, *ends], ends) if b - a > 160]
        v = [0xFFFF] * len(raw)
        for a, b in long:
            v[a : b - 1] = h[a : b - 1]
        for a, b in long:
            go = a + 8
            for p in range(a, b - 1):
                if p >= go and whole[p] and v[p] == min(v[max(0, p - 63) : p + 64]):
                    ends.append(p + 1)
                    go = p + mean
        ends = sorted(ends)
        cut[i, t] = [(a, raw[a:b]) for a, b in zip([0, *ends], ends)]
    for i, t in rows:
        for _, c in cut[i, t] if i is not None else ():
            table.setdefault(c, set()).add(i)
    out = set()
    for i, t in rows:
        runs, mine = [], set()
        for a, c in cut[i, t] if i is not None else ():
            if min(table[c]) < i or within and c in mine:
                if runs and runs[-1][0] + runs[-1][1] == a:
                    runs[-1] = (runs[-1][0], runs[-1][1] + len(c), runs[-1][2] + 1)
                else:
                    runs.append((a, len(c), 1))
            mine.add(c)
        out |= {(i, *r) for r in runs if r[1] >= least}
    return out


def test_spans_brute_force(spark):
    rng = random.Random(47)
    words = ["w%d" % i for i in range(400)] + ["é", "日本語", "🙂", "ab", ". "]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [some(40) for _ in range(6)]
    rows = [(i, " ".join(rng.choice([some(rng.randrange(30)), rng.choice(shared), rng.choice(shared)[rng.randrange(40) :]]) for _ in range(4))) for i in range(40)]
    rows += [(50, rows[3][1]), (51, "la " * 300), (52, "x" + "la " * 200), (53, None), (54, ""), (None, rows[4][1]), (55, "ß" * 2000)]
    for within in (False, True):
        got = {(r.doc_id, r.start, r.length, r.n_chunks) for r in duplicate_spans(frame(spark, rows), within=within).collect()}
        assert got == brute_spans(rows, within) and len(got) > 30


def test_periodic_passages_are_found(spark):
    """Passages of one to four words over and over, at other places of two documents each."""
    rng = random.Random(59)
    rows, size = [], {}
    for i in range(300):
        period = " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 5)))
        text = " ".join([period] * 300)[: 60 * 8]
        rows += [(i, passage(rng, 20, "u") + " " + text + " " + passage(rng, 20, "v")), (1000 + i, passage(rng, rng.randrange(9, 30), "x") + " " + text + " " + passage(rng, 9, "y"))]
        size[1000 + i] = len(text)
    found = {}
    for r in duplicate_spans(frame(spark, rows)).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert sum(found.get(i, 0) >= 0.6 * n for i, n in size.items()) >= 0.9 * len(size)


def test_a_hot_passage_and_one_document_repeated(spark):
    rng = random.Random(13)
    hot = passage(rng, 70, "h")
    rows = [(i, hot + " " + passage(rng, 30, "t")) for i in range(50)] + [(7, hot)] * 3
    got = {r.doc_id for r in duplicate_spans(frame(spark, rows)).collect()}
    assert got == set(range(1, 50))


def test_very_long_texts(spark):
    """Texts of a megabyte beside short ones: each operator still finds what they share."""
    rng = random.Random(53)
    lines = [passage(rng, 8, "L") for _ in range(12000)]
    whole = "\n".join(lines)
    rows = [(1, whole), (2, whole), (3, "\n".join(["own line of the third document, long enough to be a run of its own", *lines[4000:4010]])), (4, "\n".join(lines[:11900])), (5, "q" * 1_000_000), (6, "q" * 1_000_000 + "r")]
    docs = frame(spark, rows)
    left = {r.doc_id: len(full_lines(r.text)) for r in dedup_lines(docs, duplicate_lines(docs)).collect()}
    assert left == {1: 12000, 2: 0, 3: 1, 4: 0, 5: 1, 6: 1}
    near = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert near == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 6}
    spans = {}
    for r in duplicate_spans(docs).collect():
        spans[r.doc_id] = spans.get(r.doc_id, 0) + r.length
    assert set(spans) == {2, 3, 4, 6} and spans[6] > 999_000 and spans[2] == len(whole.encode()) and spans[4] > 0.99 * len(rows[3][1])
    kept = {r.doc_id: (r.kept, r.group_size) for r in exact_dedup(docs).collect()}
    assert kept == {1: (False, 2), 2: (True, 2), 3: (True, 1), 4: (True, 1), 5: (True, 1), 6: (True, 1)}


def test_longest_increasing_and_alignment():
    rng = random.Random(17)
    for _ in range(200):
        v = [rng.randrange(30) for _ in range(rng.randrange(12))]
        best = max((sum(1 for _ in c) for c in subsequences(v)), default=0)
        got = longest_increasing(v)
        assert len(got) == best and all(v[a] < v[b] for a, b in zip(got, got[1:]))
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(10))] for _ in range(2))
        pairs = align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert align([1, 2, 3, 9, 4], [0, 1, 2, 3, 4]) == [(0, 1), (1, 2), (2, 3), (4, 4)]
    assert blocks([(0, 1), (1, 2), (3, 3), (4, 4)]) == [(0, 1, 2), (3, 3, 2)]
    n = list(range(20000))
    assert align(n, n[::1]) == list(zip(n, n)) and len(align(n, n[1:] + [0])) == 19999


def subsequences(v):
    for mask in range(1 << len(v)):
        c = [v[i] for i in range(len(v)) if mask >> i & 1]
        if all(x < y for x, y in zip(c, c[1:])):
            yield c


def full_lines(text):
    return [x.strip() for x in (text or "").split("\n") if x.strip()]


def by_blocks(later, sizes, earlier, min_bytes):
    """Lines within equal blocks of both documents, for every pair of places: what alignments can find together."""
    lost = set()
    for i in range(len(later)):
        for k in range(len(earlier)):
            n = 0
            while i + n < len(later) and k + n < len(earlier) and later[i + n] == earlier[k + n]:
                n += 1
            if sum(sizes[i : i + n]) >= min_bytes:
                lost.update(range(i, i + n))
    return sorted(lost)


def test_alignments_find_every_common_block(monkeypatch):
    r = random.Random(11)
    some = 0
    for _ in range(1500):
        words = range(1, r.choice((3, 8, 30)))
        a, b = ([r.choice(words) for _ in range(r.randrange(25))] for _ in range(2))
        for _ in range(r.randrange(3)):  # passages, repeated and moved
            i, n = r.randrange(len(b) + 1), r.randrange(1, 9)
            at = r.randrange(len(a) + 1)
            a[at:at] = b[i : i + n]
        sizes = [5 + 7 * (x % 4) for x in a]
        want = by_blocks(a, sizes, b, 40)
        some += bool(want)
        assert common_lines(a, sizes, b, 40) == want
    assert some > 400
    # all of it is the alignment's work
    monkeypatch.setattr(line_dedup, "align", lambda a, b, repeats=False: [])
    assert common_lines([1, 2, 3], [30] * 3, [1, 2, 3], 64) == []


def test_a_passage_repeated_many_times_takes_no_squared_time():
    passage = list(range(1, 40))
    a = [x for n in range(3000) for x in (*passage, 10_000 + n)]
    assert common_lines(a, [20] * len(a), [*passage, 7, *passage], 64) == [i for i, x in enumerate(a) if x < 10_000]


def test_occurrences_align_where_nothing_is_unique():
    assert align([1, 2, 1, 2, 3, 3], [9, 1, 2, 1, 2, 8, 3, 3, 9], repeats=True) == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 6), (5, 7)]
    assert align([5, 1, 1, 6], [7, 1, 1, 8]) == []


def held_before(rows, min_bytes=64):
    """(id, lines left) of each text, all its lines but those in a run of at least ``min_bytes`` that a document of smaller id holds: all pairs."""
    full, out = [(i, full_lines(t)) for i, t in rows], []
    for i, a in full:
        lost = set()
        for _, b in [r for r in full if None not in (i, r[0]) and r[0] < i]:
            places = {}
            for n, x in enumerate(b):
                places.setdefault(x, []).append(n)
            for p in range(len(a)):
                for k in places.get(a[p], ()):
                    n = 0
                    while p + n < len(a) and k + n < len(b) and a[p + n] == b[k + n]:
                        n += 1
                    if sum(len(x.encode()) for x in a[p : p + n]) >= min_bytes:
                        lost |= set(range(p, p + n))
        out.append((i, [x for k, x in enumerate(a) if k not in lost]))
    return out


def test_line_dedup_brute_force(spark):
    rng = random.Random(19)
    line = lambda: passage(rng, 8, "l")
    shared, hot = [[line() for _ in range(4)] for _ in range(5)], line() * 2
    rows = []
    for i in range(60):
        body = [line() for _ in range(5)]
        body[2:2] = [*shared[i % 5], "", "short"] if i % 2 else [hot]
        rows.append((i, "\n".join(body)))
    rows += [(100, rows[3][1]), (100, rows[3][1]), (101, "  " + rows[4][1].replace("\n", "  \n")), (102, None), (103, ""), (104, "\n\n\n"), (None, rows[3][1]), (50, rows[3][1])]
    docs = frame(spark, rows)
    out = dedup_lines(docs, duplicate_lines(docs), report=True).collect()
    assert sorted((str(r.doc_id), full_lines(r.text)) for r in out) == sorted((str(i), x) for i, x in held_before(rows))
    kept = [x.strip() for r in out for x in (r.text or "").split("\n")]
    assert all(x.strip() in kept for _, t in rows for x in (t or "").split("\n"))  # one copy of every line stays
    none = frame(spark, [])
    assert dedup_lines(none, duplicate_lines(none)).collect() == []


def kept_lines(spark, rows):
    docs = frame(spark, rows)
    return {r.doc_id: [x.strip() for x in r.text.split("\n") if x.strip()] for r in dedup_lines(docs, duplicate_lines(docs)).collect()}


def test_a_passage_whose_lines_an_earlier_document_scatters(spark):
    rng = random.Random(23)
    block = [passage(rng, 6, "s") for _ in range(12)]
    one = lambda: passage(rng, 6, "o")
    rows = [(1, "\n".join(x for b in block for x in (b, one()))), (2, "\n".join([one(), *block, one()])), (3, "\n".join([*block, one()]))]
    rows += [(4, "\n".join([one(), *block[:2], one(), *block[3:9], one()])), (5, "\n".join([*block[6:], "tail"])), (6, "\n".join(["head", *block[6:], "tail"]))]
    got = kept_lines(spark, rows)
    assert got == dict(held_before(rows))
    assert len(got[2]) == 14 and len(got[3]) == 1 and got[6] == ["head"]


def test_passages_repeated_in_either_document_or_moved(spark):
    p, a, b, c = [[n * 10 + k for k in range(1, 5)] for n in range(1, 5)]
    for later, earlier, lost in (
        (a + p + b, c + p + [99] + p + [98], range(4, 8)),
        (a + p + [97] + p + b, c + p + [98], [*range(4, 8), *range(9, 13)]),
        (p + a, a + p, range(8)),
        (a + p[:3] + b, c + p[:3] + [99] + p[:3] + [98], []),
    ):
        assert common_lines(later, [20] * len(later), earlier, 64) == list(lost)
    rng = random.Random(29)
    lines = [passage(rng, n, "r") for n in (4, 4, 5, 5, 12)]
    rows = [(i, "\n".join(rng.choice(lines) if rng.random() < 0.8 else passage(rng, 5, "n") for _ in range(12))) for i in range(60)]
    assert kept_lines(spark, rows) == dict(held_before(rows))


def test_line_dedup_of_an_id_with_many_texts(spark):
    """A third of all rows have one id, each with a text and passages of its own: later documents meet just the texts that hold their runs."""
    rng = random.Random(11)
    line = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(8))
    own = [[line() for _ in range(6)] for _ in range(120)]
    rows = [(5, "\n".join(x)) for x in own]
    rows += [(100 + i, "\n".join([line(), *own[i % 120][1:4], line(), *own[(i * 7 + 3) % 120][4:], line()])) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({"removed_lines": F.lit("x"), "Sources": F.lit("y"), "first_hash": F.lit(1)})
    out = dedup_lines(docs, duplicate_lines(docs), report=True)
    assert out.columns == ["doc_id", "text", "first_hash", "removed_lines", "sources"]
    got = out.collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id == 5) == sorted(rows[:120])
    assert sorted((r.doc_id, full_lines(r.text)) for r in got) == sorted(held_before(rows))
    assert all(r.removed_lines >= 5 and 5 in r.sources for r in got if r.doc_id != 5)


def test_documents_that_share_short_lines_only(spark):
    rng = random.Random(31)
    verse = [passage(rng, 2, "v") for _ in range(30)]
    rows = [(1, "\n".join(verse)), (2, "\n".join(verse)), (3, "\n".join(verse[5:20])), (4, "\n".join(verse[:3])), (5, "\n".join(["own", *verse[10:16], "", *verse[16:18], "words"]))]
    assert all(len(x) < 24 for x in verse)
    got = kept_lines(spark, rows)
    assert got == dict(held_before(rows)) and [len(got[i]) for i in range(1, 6)] == [30, 0, 0, 3, 2]


def test_shared_counts_and_what_links_join(monkeypatch):
    rng = np.random.default_rng(7)
    for t in range(60):
        monkeypatch.setattr(minhash, "RARE", int(rng.choice([0, 3, 1024])))
        n = int(rng.integers(1, 14))
        sets = [np.unique(rng.integers(0, rng.integers(2, 40), rng.integers(1, 30))).astype(np.uint64) for _ in range(n)]
        doc, sh, size = np.repeat(np.arange(n), [len(x) for x in sets]), np.concatenate(sets), np.array([len(x) for x in sets])
        side, label = rng.integers(0, 2, n), rng.integers(0, max(1, n - 2), n) * 10
        left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if t % 2 else (np.arange(n), np.arange(n))
        want = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i in left for j in right}
        got = minhash.shared_counts(doc, sh, left, right)
        assert all(got[a, b] == want[i, j] for a, i in enumerate(left) for b, j in enumerate(right))

        def joined(pairs):
            low = {x: x for x in label.tolist()}
            for _ in low:
                for x, y in pairs:
                    low[x] = low[y] = min(low[x], low[y])
            return low

        linked = [(label[i], label[j]) for (i, j), c in want.items() if c * 150 >= (size[i] + size[j]) * 50]
        assert joined(linked) == joined(list(zip(*minhash.linked_sets(doc, sh, size, label, left, right, 50))))


def test_near_duplicates_make_no_rows_for_pairs_of_a_large_group(spark, monkeypatch):
    """Rows of a group grow with its members: a template's copies whose edits others share, too far apart for one lead."""
    rng, made = random.Random(11), []
    table = minhash.Scratch.table

    def counted(self, df):
        out = table(self, df)
        made.append(out.count())
        return out

    monkeypatch.setattr(minhash.Scratch, "table", counted)
    template = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(f"{w}x{rng.randrange(3)}" if rng.random() < 0.05 else w for w in template)) for i in range(400)]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows), shingle=4).collect()}
    assert got == {i: c for (i, _), (_, c) in zip(rows, brute_near(rows, 4))}
    assert max(made) <= 24 * len(rows)
