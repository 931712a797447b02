"""Text, metric and audio functions against independent definitions."""

import io
import math
import random
import tracemalloc
import unicodedata
import wave

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from takepick.functions import audio, distances, metrics, text

TEXTS = ["", " ", "Hello, World!", "don't", "a_b", "ﬁne ＡＢＣ ½", "ΟΔΟΣ", "İstanbul", "éá", "tab\tnew\nline\x1cfs em\xa0nb", "日本 語", "...", "x²", "A­B"]


def basic(s):
    s = unicodedata.normalize("NFKC", s).lower()
    return " ".join("".join(c if c.isalnum() or c.isspace() else " " for c in s).split())


def run(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*cols).collect()]


def test_normalisation_and_tokens(spark):
    got = run(
        spark, [(t,) for t in TEXTS], "t string", text.normalize_basic(F.col("t")), text.normalize_basic(F.col("t"), exact=True), text.collapse_space(F.col("t")),
        text.tokens(F.col("t")), text.tokens(F.col("t"), tokenizer="char"), text.tokens(F.col("t"), "none"), text.py_strip(F.col("t")),
    )
    for t, (fast, exact, none, words, chars, raw, strip) in zip(TEXTS, got):
        assert fast == exact == basic(t)
        assert none == " ".join(t.split()) and raw == t.split() and strip == t.strip()
        assert words == basic(t).split() and chars == list(basic(t).replace(" ", ""))


def test_nfkc_equals_pythons_without_python(spark):
    """All assigned characters, random sequences of those that compose or decompose, jamo, long and null texts."""
    known = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) not in ("Cn", "Cs")]
    rng = random.Random(5)
    hot = [c for c in known if unicodedata.decomposition(c) or unicodedata.combining(c)]
    jamo = [chr(c) for c in (*range(0x1100, 0x1113), *range(0x1161, 0x1176), *range(0x11A7, 0x11C3), *range(0xAC00, 0xAC40))]
    made = ["".join(rng.choice(rng.choice((hot, hot, jamo, known))) for _ in range(rng.randrange(2, 12))) for _ in range(20_000)]
    texts = [*(c + "x" for c in known), *made, "e\u0301" * 100_000, "", None]
    df = spark.createDataFrame([(t, None if t is None else unicodedata.normalize("NFKC", t)) for t in texts], "t string, want string")
    out = df.select("want", text.nfkc(F.col("t")).alias("got"), text.normalize_basic(F.col("t")).alias("basic"))
    assert out.where("not got <=> want").count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r.n for r in df.groupBy(F.length(text.nfkc(F.col("t"))).alias("k")).agg(F.count("*").alias("n")).where("k = 100000").collect()] == [1]


def test_unknown_modes_are_refused():
    for bad in ({"normalize": "x"}, {"tokenizer": "x"}):
        with pytest.raises(ValueError):
            text.tokens(None if "normalize" in bad else F.lit("a"), **bad)


def test_newer_letters_need_exact(spark):
    (fast, exact), = run(spark, [("aࡰb",)], "t string", text.normalize_basic(F.col("t")), text.normalize_basic(F.col("t"), exact=True))
    assert exact == "aࡰb"


def dp(r, h):
    row = list(range(len(h) + 1))
    for i, x in enumerate(r, 1):
        before, row = row, [i]
        for j, y in enumerate(h, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def of_pairs(pairs, limit=None):
    """``distances`` of pairs of lists."""
    lists = [x for p in pairs for x in p]
    length = np.array([len(x) for x in lists], np.int64)
    start = np.cumsum(length) - length
    codes = np.array([c for x in lists for c in x], np.int64)
    return distances.distances(codes, start[::2], length[::2], start[1::2], length[1::2], limit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
def test_distance_is_a_metric(a, b, c):
    ab, ba, aa, bc, ac = of_pairs([(a, b), (b, a), (a, a), (b, c), (a, c)])
    assert ab == dp(a, b) == ba and aa == 0
    assert abs(len(a) - len(b)) <= ab <= max(len(a), len(b)) and ac <= ab + bc


@pytest.mark.parametrize("few", [0, 10**9])  # all steps together, or every pair in long integers
@pytest.mark.parametrize("lengths", [range(6), (62, 63, 64, 65), (0, 5, 127, 128, 129, 190)])
def test_distances_equal_the_programme(monkeypatch, few, lengths):
    monkeypatch.setattr(distances, "FEW", few)
    r = random.Random(len(lengths) + few)
    pairs = []
    for _ in range(120):
        a = [r.randrange(4) for _ in range(r.choice(lengths))]
        b = [x if r.random() < 0.8 else r.randrange(4) for x in a if r.random() < 0.9] if r.random() < 0.7 else [r.randrange(4) for _ in range(r.choice(lengths))]
        pairs.append((a, b))
    want = np.array([dp(*p) for p in pairs])
    assert of_pairs(pairs).tolist() == want.tolist()
    limit = np.array([r.randrange(0, 60) for _ in pairs])
    got, within = of_pairs(pairs, limit), want <= limit
    assert (got[within] == want[within]).all() and (got[~within] > limit[~within]).all() and (got[~within] <= want[~within]).all()
    assert of_pairs([]).tolist() == []


def by_vectors(r, h):
    """The programme with one vector step per item: for texts too long for ``dp``."""
    r, h = np.array(r), np.array(h)
    steps = np.arange(len(h) + 1)
    row = steps.copy()
    for i, x in enumerate(r, 1):
        best = row + 1
        best[0] = i
        np.minimum(best[1:], row[:-1] + (h != x), out=best[1:])
        row = np.minimum.accumulate(best - steps) + steps
    return int(row[-1])


def test_texts_of_ten_thousand_tokens(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    ref = [r.choice(words) for _ in range(10_000)]
    near = [w if r.random() < 0.9 else r.choice(words) for w in ref if r.random() < 0.97]
    far = [r.choice(words) for _ in range(9_000)]
    rows = [(ref, near), (near, ref), (ref, far), (ref, []), (None, ref), (ref, None), ([], [])]
    got = run(spark, rows, "a array<string>, b array<string>", metrics.edit_distance("a", "b"), metrics.error_rate("a", "b"))
    d, e = by_vectors(ref, near), by_vectors(ref, far)
    assert got == [(d, d / 10_000), (d, d / len(near)), (e, e / 10_000), (10_000, 1.0), (None, None), (None, None), (0, 0.0)]
    best, = run(spark, [(ref, [far, None, near, ref, near, ref])], "a array<string>, b array<array<string>>", metrics.least_error_rate("a", "b"))
    assert tuple(best[0]) == (3, 0.0)


def test_least_error_rate_equals_all_rates(spark):
    r = random.Random(8)
    say = lambda: [r.choice("abc") for _ in range(r.randrange(7))]
    rows = [(say(), [None if r.random() < 0.2 else say() for _ in range(r.randrange(6))]) for _ in range(400)]
    rows += [([], [["a", "b"], ["a"], [], []]), ([], [["a", "b"], ["c"]]), (["a"], []), (["a"], None), (None, [["a"]])]
    got = [tuple(x[0]) for x in run(spark, rows, "a array<string>, b array<array<string>>", metrics.least_error_rate("a", "b"))]
    for (ref, hyps), found in zip(rows, got):
        rates = [(dp(ref, h) / len(ref) if ref else float(bool(h)), i) for i, h in enumerate(hyps or []) if h is not None and ref is not None]
        best = min(rates, default=(None, None))
        assert found == (best[1], best[0])


def test_error_rates(spark):
    rows = [("Hello, world!", "hello world"), ("don't", "dont"), ("...", ""), ("...", "a"), ("a", "a b c"), ("a b c d", "a x c"), ("日本語", "日本"), ("x y z " * 50, "y z x " * 50)]
    want = [0.0, 1.0, 0.0, 1.0, 2.0, 0.5, 1.0, dp(("x y z " * 50).split(), ("y z x " * 50).split()) / 150]
    got = run(spark, rows, "a string, b string", metrics.wer(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == want
    assert run(spark, rows[6:7], "a string, b string", metrics.wer(F.col("a"), F.col("b"), tokenizer="char")) == [(1 / 3,)]


def test_safe_names(spark):
    names = ["..", "", "a b/c?d", "éà", "ok-name_1.wav", "x" * 209, "._a_."]
    got = [r[0] for r in run(spark, [(n,) for n in names], "t string", text.safe_name(F.col("t")))]
    assert got[0].startswith("record_") and got[1].startswith("record_") and got[2].startswith("a_b_c_d_") and got[4].startswith("ok-name_1.wav_")
    assert len(got[5]) == 131 and got[6].startswith("a_") and len(set(got)) == len(got)


def test_resolved_paths(spark):
    got = run(spark, [("/a/b", "/s/in.json"), ("c/d", "/s/in.json"), ("~/e", "/s/in.json")], "p string, s string", text.resolve_path(F.col("p"), F.col("s"), home="/h"), text.resolve_path(F.col("p"), F.col("s"), "/root/"))
    assert got == [("/a/b", "/a/b"), ("/s/c/d", "/root/c/d"), ("/h/e", "/root/~/e")]


def wav(x, rate, channels=1, width=2):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(x)
    return out.getvalue()


def test_wav_concatenation():
    tone = (np.sin(np.arange(1600) / 5) * 12000).astype("<i2")
    stereo = np.column_stack((tone, tone)).astype("<i2").tobytes()
    x, rate = audio.decode(audio.concat_wavs([wav(tone.tobytes(), 16000), wav(stereo, 16000, 2)], 16000, 200))
    assert rate == 16000 and len(x) == 1600 + 3200 + 1600 and not x[1600:4800].any()
    assert np.abs(x[:1600] - tone / 32768).max() <= 2 / 32768 and np.allclose(x[:1600], x[4800:])
    for width, raw in ((1, bytes([128, 255, 0])), (3, b"\x00\x00\x00\xff\xff\x7f\x00\x00\x80"), (4, np.array([0, 2**31 - 1, -(2**31)], "<i4").tobytes())):
        assert np.allclose(audio.decode(wav(raw, 8000, 1, width))[0], [0, 1, -1], atol=0.01)
    with pytest.raises(ValueError):
        audio.concat_wavs([], 16000)


def test_resampling(spark):
    x = np.arange(10, dtype=np.float32)
    (up, same), = run(spark, [(x.tolist(),)], "x array<float>", audio.resample_linear(F.col("x"), 8000, 16000), audio.resample_linear(F.col("x"), 8000, 8000))
    assert np.allclose(up, audio.resampled(x, 8000, 16000, "linear")) and np.allclose(same, x) and len(up) == 20
    assert audio.gap_samples(16000, 200) == 3200 and audio.gap_samples(16000, -5) == 0 and audio.gap_samples(1000, 2.5) == round(2.5)
    assert not math.isnan(up[-1])


def wav_of(path, x, rate, width=2, channels=1):
    raw = (x * (1 << 14)).astype(np.int32)
    raw = {1: (raw // 256 + 128).astype("u1"), 2: raw.astype("<i2"), 4: (raw << 16).astype("<i4")}.get(width)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(raw.tobytes())
    return str(path)


@pytest.mark.parametrize("method", ["polyphase", "linear"])
def test_files_piece_by_piece_equal_whole_ones(tmp_path, monkeypatch, method):
    """Whatever the pieces, files are put together to the bytes that whole signals give."""
    rng = np.random.default_rng(7)
    forms = [(16000, 2, 1, 5000), (44100, 2, 2, 9001), (8000, 1, 1, 77), (48000, 4, 2, 4000), (16000, 2, 1, 0), (22050, 2, 1, 0), (11025, 2, 1, 1)]
    paths = [wav_of(tmp_path / f"{i}.wav", rng.uniform(-1, 1, n * c), rate, w, c) for i, (rate, w, c, n) in enumerate(forms)]
    want = audio.concat_wavs([open(p, "rb").read() for p in paths], 16000, 3.3, method)
    for piece in (1, 10, 1000, 1 << 15):
        monkeypatch.setattr(audio, "PIECE", piece)
        out = io.BytesIO()
        audio.concat_files(paths if piece > 1 else paths[2:3] + paths[4:], out, 16000, 3.3, method)
        assert out.getvalue() == (want if piece > 1 else audio.concat_wavs([open(p, "rb").read() for p in paths[2:3] + paths[4:]], 16000, 3.3, method))
    with pytest.raises(ValueError):
        audio.concat_files([], io.BytesIO(), 16000)


@pytest.mark.parametrize("method", ["polyphase", "linear"])
def test_memory_does_not_grow_with_length(tmp_path, method):
    peaks = []
    for seconds in (20, 80):
        path = wav_of(tmp_path / f"{seconds}.wav", np.zeros(44100 * seconds), 44100)
        tracemalloc.start()
        with open(tmp_path / "out.wav", "wb") as out:
            audio.concat_files([path, path], out, 16000, 10, method)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        with wave.open(str(tmp_path / "out.wav")) as w:
            assert w.getnframes() == 2 * 16000 * seconds + 160
    assert peaks[1] < 1.1 * peaks[0] + (1 << 16)
