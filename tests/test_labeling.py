"""Sources, preparation, sharding, transcription, collection and a run from files to the result document."""

import json
import os
import time
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from takepick.__main__ import main
from takepick.config import LabelingConfig
from takepick.functions.audio import encode_pcm16, polyphase, resampled
from takepick.operators import collect, prepare, shard
from takepick.operators.models import Adapted, model_maker
from takepick.operators.transcribe import label_batch, read_result, transcribe
from takepick.plans.jobs import run_tagged
from takepick.plans.labeling import LabelingRun
from takepick.plans.progress import Progress
from takepick.queries import EchoTranscriber
from takepick.schemas import RESULT
from takepick.sources.listing import expand_paths
from takepick.sources.records import label_files, read_jsonl, read_records
from takepick.sources.sinks import append_jsonl, compact_json, read_document, result_json, write_document, write_jsonl, write_shards
from takepick.streaming.labels import stream_labels


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_path_expansion(spark, tmp_path):
    for name in ("b.json", "a.json", "c.jsonl", "d.txt"):
        put(tmp_path / name, "")
    names = lambda v: [os.path.basename(p) for p in expand_paths(spark, v)]
    assert names([str(tmp_path)]) == ["a.json", "b.json", "c.jsonl"]
    assert names([f"{tmp_path}/*.json", f"{tmp_path}/a.json", "nowhere.json"]) == ["a.json", "b.json", "nowhere.json"]


def test_record_forms(spark, tmp_path):
    files = [
        put(tmp_path / "1.jsonl", '{"id":1}\n\n  {"id":2}\n'),
        put(tmp_path / "2.json", ' [{"id":3},\n {"id":4}]'),
        put(tmp_path / "3.json", '{\n "id": 5\n}'),
        put(tmp_path / "4.json", "  \n"),
        put(tmp_path / "5 +%.jsonl", '{"id":6}\n{"id":7}'),
    ]
    rows = read_records(spark, files).select("record_index", "source_json", F.variant_get("record", "$.id", "int").alias("id")).orderBy("record_index").collect()
    assert [(r.record_index, r.id) for r in rows] == [(i, i + 1) for i in range(7)]
    assert rows[0].source_json.endswith("/1.jsonl")
    with pytest.raises(FileNotFoundError):
        read_records(spark, ["/no/such.json"])
    for bad in ('{"a":1}\n{"b":', '{"a":1}\n[1]', "[1]"):
        with pytest.raises(Exception):
            read_records(spark, [put(tmp_path / "bad.jsonl", bad)]).collect()
    assert read_records(spark, [files[3]]).collect() == []


def test_many_splits_keep_their_order(spark, tmp_path):
    path = put(tmp_path / "long.jsonl", "\n".join('{"id":%d}' % i for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
    try:
        rows = read_records(spark, [path]).select("record_index", F.variant_get("record", "$.id", "int").alias("id")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.record_index, r.id) for r in rows) == [(i, i) for i in range(5000)]


def test_strict_label_log(spark, tmp_path):
    schema = "id string, candidate_index int, error string"
    assert read_jsonl(spark, [str(tmp_path / "none")], schema).collect() == []
    a = put(tmp_path / "a.labels.jsonl", '{"id":"x","candidate_index":0,"error":null}\n\n{"id":"x","candidate_index":1,"error":"E"}\n')
    b = put(tmp_path / "b.labels.jsonl", '{"id":"x","candidate_index":0,"error":"late"}\n')
    assert label_files(spark, str(tmp_path)) == [a, b]
    rows = read_jsonl(spark, [a, b], schema)
    assert sorted(map(tuple, rows.collect()), key=lambda r: r[3]) == [("x", 0, None, 0), ("x", 1, "E", 1), ("x", 0, "late", 2)]
    assert {(r.candidate_index, r.error) for r in collect.latest(rows, ["id", "candidate_index"]).collect()} == {(0, "late"), (1, "E")}
    with pytest.raises(Exception):
        read_jsonl(spark, [put(tmp_path / "c", '{"id":"x"}\n{"id"')], schema).collect()


RECORDS = [
    ({"id": "ok", "output": [{"text": " a ", "candidate_audio_path": ["p", "/q"]}, {"text": "", "candidate_audio_path": ["r", "s"]}, {"text": "b", "candidate_audio_path": ["t", "u"]}]}, None),
    ({"id": 1, "output": None}, "ValueError: output must be a non-empty list"),
    ({"id": 1.5}, "ValueError: output must be a non-empty list"),
    ({"id": True, "output": {}}, "ValueError: output must be a non-empty list"),
    ({"id": 2, "output": []}, "ValueError: output must be a non-empty list"),
    ({"id": 3, "output": [{"text": "a", "candidate_audio_path": ["x"]}, 5]}, "ValueError: output[1] must be an object"),
    ({"id": 4, "output": [{"text": "a"}]}, "ValueError: output[0].candidate_audio_path must be a non-empty list"),
    ({"id": 5, "output": [{"text": "a", "candidate_audio_path": []}]}, "ValueError: output[0].candidate_audio_path must be a non-empty list"),
    ({"id": 6, "output": [{"text": "a", "candidate_audio_path": ["x", "y"]}, {"candidate_audio_path": ["x", "y", "z"]}]}, "ValueError: candidate count mismatch: output[0] has 2, output[1] has 3"),
    ({"id": None, "output": [{"text": " ", "candidate_audio_path": ["x"]}, {"text": None, "candidate_audio_path": ["x"]}, {"text": 0, "candidate_audio_path": ["x"]}]}, "ValueError: concatenated reference text is empty"),
    ({"output": [{"text": 7, "candidate_audio_path": ["x"]}, {"text": True, "candidate_audio_path": [None]}]}, None),
]


def test_validation(spark, tmp_path):
    path = put(tmp_path / "in.jsonl", "\n".join(json.dumps(r) for r, _ in RECORDS))
    valid = prepare.validate(read_records(spark, [path])).persist()
    got = {r.id: r for r in valid.collect()}
    ids = ["ok", "1", "1.5", "True", "2", "3", "4", "5", "6", "None", "record_000000010"]
    assert [got[i].error for i in ids] == [e for _, e in RECORDS]
    assert got["ok"].text == "a b" and got["record_000000010"].text == "7 True"
    assert got["ok"].paths == [[f"{tmp_path}/p", f"{tmp_path}/r", f"{tmp_path}/t"], ["/q", f"{tmp_path}/s", f"{tmp_path}/u"]]
    assert got["record_000000010"].paths[0][1] == f"{tmp_path}/None"
    rows = prepare.candidates(valid, "/o").orderBy("id", "candidate_index").collect()
    assert [(r.id, r.candidate_index, r.candidate, r.num_segments) for r in rows] == [("ok", 0, "0", 3), ("ok", 1, "1", 3), ("record_000000010", 0, "0", 2)]
    nested = {r.id: r for r in prepare.groups(valid, "/o").collect()}
    assert nested["ok"].candidate_count == 2 and nested["ok"].candidates[1].audio == rows[1].audio
    assert tuple(prepare.counters(valid).first()) == (2, 9, 3)
    assert prepare.errors(valid).count() == 9


def test_other_keys_and_root(spark, tmp_path):
    path = put(tmp_path / "in.jsonl", json.dumps({"key": "k", "segs": [{"say": "x", "wavs": ["a"]}, {"say": "y", "wavs": ["b"]}]}))
    c = LabelingConfig(id_key="key", output_key="segs", text_key="say", candidate_key="wavs", text_separator="-", audio_root="/r")
    r = prepare.validate(read_records(spark, [path]), c).first()
    assert (r.id, r.text, r.paths) == ("k", "x-y", [["/r/a", "/r/b"]])


def test_config_refuses_nonsense():
    for bad in ({"workers": 0}, {"batch_size": 0}, {"normalize": "x"}, {"tokenizer": "x"}, {"sample_rate": 0}, {"resample": "x"}):
        with pytest.raises(ValueError):
            LabelingConfig(**bad)


def test_sharding(spark):
    rows = spark.range(10).repartition(3)
    sizes = lambda df: sorted((r.shard_id, r["count"]) for r in df.groupBy("shard_id").count().collect())
    assert sizes(shard.round_robin(rows, 3, ["id"])) == [(0, 4), (1, 3), (2, 3)]
    assert sizes(shard.round_robin(spark.range(2), 8, ["id"])) == [(0, 1), (1, 1)]
    assert shard.round_robin(spark.range(0), 8, ["id"]).count() == 0
    assert sorted((r.id, r.batch_id) for r in shard.batches(rows, 4, ["id"]).collect()) == [(i, i // 4) for i in range(10)]
    dealt = shard.balanced_shards(rows, 2, F.col("id"), ["id"]).groupBy("shard_id").agg(F.sum("id").alias("s")).collect()
    assert sorted(r.s for r in dealt) == [22, 23]


def test_resume_and_status(spark):
    manifest = spark.createDataFrame([("a", 0, 0), ("a", 1, 0), ("b", 0, 1), ("b", 0, 1), ("c", 0, 2)], "id string, candidate_index int, shard_id int")
    labels = spark.createDataFrame([("a", 0, None), ("a", 1, ""), ("b", 0, "E"), ("b", 0, None), ("z", 0, None), (None, 0, None)], "id string, candidate_index int, error string")
    assert sorted((r.id, r.candidate_index) for r in shard.todo(manifest, labels).collect()) == [("a", 1), ("c", 0)]
    assert shard.todo(manifest, labels, True).count() == 5
    assert sorted(map(tuple, shard.shard_status(manifest, labels).collect())) == [(0, 2, 1, False), (1, 1, 1, True), (2, 1, 0, False)]


class Fails:
    def transcribe(self, audio, language, context):
        if any("bad" in a for a in audio):
            raise RuntimeError("no signal")
        return [{"text": a, "language": None, "conf": 0.5} for a in audio]


class Counts:
    def __init__(self, n):
        self.n = n

    def transcribe(self, audio, language, context):
        return [{"text": "x"}] * self.n


def test_batches_and_failures(spark):
    assert [x[2] for x in label_batch(Fails(), ["a", "bad", "c"], None, "", False)] == ["RuntimeError: no signal"] * 3
    assert [x[2] for x in label_batch(Fails(), ["a", "bad", "c"], None, "", True)] == [None, "RuntimeError: no signal", None]
    assert label_batch(Counts(0), ["a"], "en", "", False) == [("", "en", None, None)]
    assert label_batch(Counts(5), ["a"], None, "", False)[0][:3] == ("x", None, None)
    assert "expected 2" in label_batch(Counts(1), ["a", "b"], None, "", False)[0][2]
    assert read_result("text") == ("", None, {}) and read_result(None) == ("", None, {})
    rows = spark.createDataFrame([(i, f"{'bad' if i == 3 else 'x'}{i}") for i in range(10)], "n int, audio string").coalesce(1)
    got = {r.n: r for r in transcribe(rows, Fails, 4, "de").collect()}
    assert [i for i in range(10) if got[i].error] == [0, 1, 2, 3]
    assert got[5].language == "de" and json.loads(got[5].asr_extra) == {"conf": 0.5} and got[3].asr_text == ""
    with pytest.raises(ValueError):
        transcribe(rows, Fails, 0)


def document(results, missing):
    """The document as one task would write it, row after row."""
    rows = [json.dumps(json.loads(r.value), ensure_ascii=False, indent=2).replace("\n", "\n    ") for r in result_json(results).collect()]
    return '{\n  "results": [' + ",".join("\n    " + x for x in rows) + ("\n  " if rows else "") + f'],\n  "missing_labels": {missing}\n}}\n'


def test_document_is_written_by_many_tasks(spark, tmp_path):
    rows = [(i, f"r{i}é本", "t\n" * (i % 5), None if i % 7 == 0 else 0, [(0, None if i % 7 == 0 else i / 3, "x\"\\", "w", "E" if i % 7 == 0 else None)] * (i % 4)) for i in range(500)]
    results = spark.createDataFrame(rows, "record_index long, " + RESULT).repartition(13)
    path = str(tmp_path / "result.json")
    for part in (results, results.where("record_index = 250"), results.limit(0)):
        write_document(part, 3, path)
        whole = open(path, encoding="utf-8").read()
        assert whole == document(part.sort("record_index"), 3)
        assert [r["id"] for r in json.loads(whole)["results"]] == [r.id for r in part.sort("record_index").collect()]
    assert os.listdir(tmp_path) == ["result.json"]


def test_document_is_read_by_many_tasks(spark, tmp_path):
    rows = [(i, f"r{i}", '],\n  "missing_labels": 9\n}\n,' * (i % 3) + "\n    {", None if i % 7 == 0 else 0, [(0, i / 3, "},\n    {", "w", "E" if i % 2 else None)] * (i % 4)) for i in range(500)]
    results = spark.createDataFrame(rows, "record_index long, " + RESULT).repartition(5)
    path, small = str(tmp_path / "result.json"), {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        for part in (results, results.where("record_index = 250"), results.limit(0)):
            write_document(part, 3, path)
            got, missing = read_document(spark, path)
            want = json.load(open(path, encoding="utf-8"))
            there = got.select(F.to_json("result")).collect()
            assert sorted((json.loads(r[0]) for r in there), key=lambda r: r["id"]) == sorted(want["results"], key=lambda r: r["id"]) and missing == 3
        write_document(results, 3, path)
        assert read_document(spark, path)[0].rdd.getNumPartitions() > 8
        put(tmp_path / "cut.json", open(path, encoding="utf-8").read()[:-20])
        with pytest.raises(ValueError):
            read_document(spark, str(tmp_path / "cut.json"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_progress_while_a_stage_runs(spark, tmp_path, caplog):
    def slow(batches):
        for b in batches:
            time.sleep(0.5)
            yield b

    caplog.set_level("INFO", "takepick")
    spark.range(5).write.parquet(str(tmp_path / "other"))  # rows of other jobs don't count
    with Progress(spark, "slow", 0.1) as p:
        p.watch(spark.range(0, 4000, 1, 16).mapInArrow(slow, "id long"), F.col("id") % 10 == 0).write.parquet(str(tmp_path / "t"))
    done = p.done()
    assert (done["completed"], done["failed"]) == (4000, 400) and sum(n for _, n in p.intervals) == 4000
    assert sum(n > 0 for _, n in p.intervals) > 1 and [t for t, _ in p.intervals] == sorted(t for t, _ in p.intervals)
    assert any("rows so far" in r.message for r in caplog.records) and "4000 rows, 400 failed" in caplog.records[-1].message
    with pytest.raises(ValueError):
        Progress(spark, "x", 0)


def test_a_failed_shard_stops_the_others(spark, tmp_path):
    running = str(tmp_path / "running")

    def slow():
        def wait(batches):
            open(running, "w").close()
            time.sleep(120)
            yield from batches

        spark.range(0, 1, 1, 1).mapInArrow(wait, "id long").collect()

    def fail():
        while not os.path.exists(running):
            time.sleep(0.05)
        spark.range(1).select(F.raise_error(F.lit("no model"))).collect()

    began = time.monotonic()
    got = run_tagged(spark, {"a": lambda: spark.range(3).count(), "b": slow, "c": fail, "d": lambda: spark.range(3).count()}, 2)
    assert [got[x][0] for x in "abcd"] == ["ended", "cancelled", "failed", "not begun"] and "no model" in got["c"][1]
    assert time.monotonic() - began < 60
    assert run_tagged(spark, {}, 1) == {} and run_tagged(spark, {1: lambda: None}, 1) == {1: ("ended", None)}


def test_collection(spark):
    nested = "record_index long, id string, text string, candidates array<struct<candidate_index int, candidate string, audio string>>"
    groups = spark.createDataFrame(
        [(0, "a", "one two", [(i, str(i), f"w{i}") for i in range(3)]), (1, "b", "x", [(0, "0", "v0"), (1, "1", "v1")]), (2, "c", "y", [(0, "0", "u")])], nested
    )
    labels = spark.createDataFrame(
        [("a", 0, "one", None, None, 1), ("a", 1, "one", "moved", None, 2), ("a", 2, "one two", None, None, 3), ("a", 2, "", None, "E", 4), ("b", 0, "z", None, "", 5), ("q", 0, "", None, None, 6)],
        "id string, candidate_index int, asr_text string, audio string, error string, seq long",
    )
    scored = collect.score(groups, labels).persist()
    out = {r.id: r for r in collect.results(scored).collect()}
    assert [out[i].best_candidate for i in "abc"] == [0, 0, None]
    assert [(d.candidate, d.wer, d.transcript, d.audio, d.error) for d in out["a"].detail] == [(0, 0.5, "one", "w0", None), (1, 0.5, "one", "moved", None), (2, None, "", "w2", "E")]
    assert out["b"].detail[0].wer == 1.0 and out["b"].detail[0].error is None and out["b"].detail[1].error == "missing worker output"
    assert collect.missing_labels(scored).first()[0] == 2
    short = {r.id: tuple(r)[2:] for r in collect.best_of(groups, labels).collect()}
    assert short == {"a": (0, 0.5, 0, 1), "b": (0, 1.0, 1, 1), "c": (None, None, 1, 1)}
    whole = json.loads(document(collect.results(scored), 2))
    first = next(r for r in whole["results"] if r["id"] == "a")["detail"]
    assert whole["missing_labels"] == 2 and "error" not in first[0] and first[2]["wer"] is None and first[2]["error"] == "E"
    assert json.loads(document(collect.results(scored).limit(0), 0)) == {"results": [], "missing_labels": 0}


def test_records_that_repeat_an_id_and_a_text(spark):
    groups = spark.createDataFrame([(n, "a", "one two", [(0, "0", "w")]) for n in range(2)], "record_index long, id string, text string, candidates array<struct<candidate_index int, candidate string, audio string>>")
    labels = spark.createDataFrame([("a", 0, "one", None, None, 1)], "id string, candidate_index int, asr_text string, audio string, error string, seq long")
    out = collect.results(collect.score(groups, labels)).collect()
    assert sorted((r.record_index, len(r.detail), r.detail[0].wer) for r in out) == [(0, 1, 0.5), (1, 1, 0.5)]


def test_models_of_other_interfaces():
    each = type("Each", (), {"transcribe": lambda self, audio, language="": [{"text": language + audio}]})()
    assert Adapted(each).transcribe(["a", "b"], "x", "ignored") == [{"text": "xa"}, {"text": "xb"}]
    one = type("One", (), {"generate": lambda self, audio: {"text": audio[0]}})()
    assert Adapted(one).transcribe(["a"], "de", "c") == [{"text": "a"}]
    seen = []

    class Refuses:
        def transcribe(self, audio):
            seen.append(audio)
            if len(audio) > 1 or audio == ["bad"]:
                raise TypeError("one at a time")
            return [{"text": audio[0]}]

    assert Adapted(Refuses()).transcribe(["a", "b"], None, "") == [{"text": "a"}, {"text": "b"}] and seen == [["a", "b"], ["a"], ["b"]]
    with pytest.raises(TypeError):
        Adapted(Refuses()).transcribe(["bad"], None, "")
    with pytest.raises(TypeError):
        Adapted(object()).transcribe(["a"], None, "")
    with pytest.raises(ValueError):
        model_maker("a:B", "m", "other")
    with pytest.raises(TypeError):
        model_maker("collections:OrderedDict", "m", "transformers")()
    with pytest.raises(ImportError):
        model_maker("no.such.package:Model", "m")()


def test_polyphase_is_the_filter_over_stuffed_zeros():
    rng = np.random.default_rng(1)
    for up, down, n in ((3, 2, 64), (160, 441, 900), (2, 1, 5), (1, 3, 100), (1, 6, 4)):
        x = rng.normal(size=n).astype(np.float32)
        wide = 10 * max(up, down)
        t = np.arange(-wide, wide + 1)
        taps = np.sinc(t / max(up, down)) * np.kaiser(len(t), 5.0)
        stuffed = np.zeros(n * up)
        stuffed[::up] = x
        want = np.convolve(stuffed, taps * up / taps.sum())[wide : wide + n * up : down]
        got = polyphase(x, up, down, 50)
        assert len(got) == -(-n * up // down) and np.abs(got - want[: len(got)]).max() < 1e-5
    tone = np.sin(2 * np.pi * 440 * np.arange(8000) / 8000).astype(np.float32)
    made = resampled(tone, 8000, 16000)
    assert np.abs(made[200:-200] - np.sin(2 * np.pi * 440 * np.arange(16000) / 16000)[200:-200]).max() < 10 ** (-(5 / 0.1102 + 8.7) / 20)  # the ripple of a Kaiser window of beta 5


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", None), (2, "b", "c")], "shard_id int, x string, y string")
    assert [r[0] for r in df.select(compact_json("x", "y")).collect()] == ['{"x":"é","y":null}', '{"x":"b","y":"c"}']
    write_jsonl(df, str(tmp_path / "o"))
    append_jsonl(df, str(tmp_path / "o"))
    assert spark.read.json(str(tmp_path / "o")).count() == 4
    write_shards(df, str(tmp_path / "s"))
    write_shards(df.where("shard_id = 1"), str(tmp_path / "s"))
    assert [p for p in os.listdir(tmp_path / "s") if p.startswith("shard_id")] == ["shard_id=1"]


class ByLength:
    """Transcribes a recording as so many words as it has tenths of a second."""

    def transcribe(self, audio, language, context):
        out = []
        for a in audio:
            with wave.open(a) as w:
                out.append({"text": " ".join(["w"] * (w.getnframes() // 1600))})
        return out


def test_run_from_files_to_document(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}.wav").write_bytes(encode_pcm16(np.zeros(1600 * (i + 1), np.float32), 16000))
    records = [
        {"id": "r0", "output": [{"text": "w w", "candidate_audio_path": ["0.wav", "1.wav"]}, {"text": "w", "candidate_audio_path": ["0.wav", "0.wav"]}]},
        {"id": "r1", "output": [{"text": "w", "candidate_audio_path": ["none.wav"]}]},
        {"id": "r2", "output": []},
    ]
    inputs = [put(tmp_path / "in.json", json.dumps(records))]
    run = LabelingRun(spark, str(tmp_path / "run"), LabelingConfig(workers=2, batch_size=2))
    assert run.prepare(inputs) == {"groups": 1, "manifest": 2, "errors": 2}
    assert "FileNotFoundError" in {r.id: r.error for r in spark.read.parquet(f"{run.folder}/errors").collect()}["r1"]
    assert not run.status().first().complete
    assert run.transcribe(Fails) == 2 and run.transcribe(Fails) == 0
    assert LabelingRun(spark, run.folder, LabelingConfig(workers=2, overwrite_labels=True)).transcribe(ByLength) == 2
    out = run.run(inputs, ByLength, str(tmp_path / "result.json"))
    assert out.first().best_candidate == 1 and [d.wer for d in out.first().detail] == [pytest.approx(1 / 3), 0.0]
    whole = json.loads((tmp_path / "result.json").read_text())
    assert whole["missing_labels"] == 0 and whole["results"][0]["best_candidate"] == 1
    assert not LabelingRun(spark, run.folder, LabelingConfig(gap_ms=5)).prepared()
    # a run cut short goes on with the recordings there are; other settings make them anew
    wavs = sorted(str(p) for p in (tmp_path / "run" / "prepared_audio").rglob("*.wav"))
    assert len(wavs) == 2
    os.remove(f"{run.folder}/fingerprint")
    os.remove(wavs[1])
    os.utime(wavs[0], (1, 1))
    assert run.prepare(inputs) == {"groups": 1, "manifest": 2, "errors": 2}
    assert os.path.getmtime(wavs[0]) == 1 and os.path.exists(wavs[1])
    LabelingRun(spark, run.folder, LabelingConfig(workers=2, gap_ms=5)).prepare(inputs)
    assert os.path.getmtime(wavs[0]) > 1


class Loaded:
    """Stands for a package's model class."""

    def __init__(self, model, **options):
        self.model, self.options = model, options

    @classmethod
    def from_pretrained(cls, model, max_inference_batch_size, max_new_tokens):
        return cls(model, size=max_inference_batch_size, tokens=max_new_tokens)

    @classmethod
    def LLM(cls, model, max_inference_batch_size, max_new_tokens, gpu_memory_utilization, tensor_parallel_size):
        return cls(model, size=max_inference_batch_size, memory=gpu_memory_utilization, parallel=tensor_parallel_size)

    def generate(self, audio, context=""):
        return [{"text": "w w", "context": context, "model": self.model} for _ in audio]


def test_loading_models(monkeypatch):
    monkeypatch.delenv("VLLM_ATTENTION_BACKEND", raising=False)
    made = model_maker("test_labeling:Loaded", "m", "vllm", batch_size=3)()
    assert made.model.model == "m" and made.model.options == {"size": 3, "memory": 0.7, "parallel": 1} and os.environ["VLLM_ATTENTION_BACKEND"] == "FLASH_ATTN"
    made = model_maker("test_labeling:Loaded", "m", "transformers", max_new_tokens=9)()
    assert made.model.options == {"size": 8, "tokens": 9}
    assert made.transcribe(["a"], "de", "c") == [{"text": "w w", "context": "c", "model": "m"}]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "a.wav").write_bytes(encode_pcm16(np.zeros(1600, np.float32), 16000))
    put(tmp_path / "in.jsonl", json.dumps({"key": "k", "output": [{"text": "w w", "candidate_audio_path": ["a.wav"]}]}))
    given = ["--input-json", str(tmp_path / "in.jsonl"), "--output_dir", str(tmp_path / "run"), "--id-key", "key", "--workers", "1"]
    assert main([*given, "--prepare-only"]) == 0 and LabelingRun(spark, str(tmp_path / "run")).manifest().count() == 1
    assert main([*given, "--factory", "test_labeling:Loaded", "--backend", "transformers", "--context", "c"]) == 0
    assert main([*given, "--collect-only", "--result-name", "again.json"]) == 0
    for name in ("result.json", "again.json"):
        whole = json.loads((tmp_path / "run" / name).read_text())
        assert whole["results"][0]["id"] == "k" and whole["results"][0]["detail"][0]["wer"] == 0.0
    for bad in (["--batch-size", "0"], [], ["--prepare-only", "--collect-only"]):
        with pytest.raises(SystemExit):
            main([*given, *bad])
    assert "batch_size must be > 0" in capsys.readouterr().err


def manifest_rows(*rows):
    return "\n".join(json.dumps({"id": i, "candidate_index": c, "candidate": "0", "audio": audio, "text": "t", "source_json": "s", "num_segments": 1}) for i, c, audio in rows)


class FailsOnce:
    """Fails on some recordings; ends the whole task on a recording named for a file, the first time."""

    def transcribe(self, audio, language, context):
        out = []
        for a in audio:
            if a.startswith("/") and not os.path.exists(a):
                open(a, "w").close()
                raise SystemExit("the executor is lost")
            out.append({"text": "" if a == "bad" else a})
            if a == "bad":
                raise RuntimeError("no signal")
        return out


def follow(spark, tmp_path, n, rows, **how):
    put(tmp_path / f"m{n}.json", manifest_rows(*rows))
    (tmp_path / "m").mkdir(exist_ok=True)
    os.replace(tmp_path / f"m{n}.json", tmp_path / "m" / f"{n}.json")
    q = stream_labels(spark, str(tmp_path / "m"), str(tmp_path / "labels"), str(tmp_path / "c"), FailsOnce, isolate=True, **how)
    q.awaitTermination(120)
    return sorted((r.id or "", r.candidate_index, r.seq, r.asr_text, r.error) for r in spark.read.parquet(str(tmp_path / "labels")).collect())


def test_label_stream_over_restarts(spark, tmp_path):
    """Every start is a new query on the checkpoint: what it knows comes from the state."""
    error = "RuntimeError: no signal"
    one = follow(spark, tmp_path, 1, [("a", 0, "x"), ("b", 0, "bad"), ("b", 1, "y"), (None, 0, "n")], buckets=1)
    assert [(i, c, t, e) for i, c, _, t, e in one] == [("", 0, "n", None), ("a", 0, "x", None), ("b", 0, "", error), ("b", 1, "y", None)]
    assert sorted(r[2] for r in one) == [0, 1, 2, 3]
    two = follow(spark, tmp_path, 2, [("a", 0, "z"), ("b", 0, "bad"), ("b", 0, "again"), ("c", 0, "w"), (None, 0, "n")], buckets=7)  # the checkpoint keeps one bucket
    assert [(i, c, t, e) for i, c, _, t, e in two if (i, c, _, t, e) not in one] == [("", 0, "n", None), ("b", 0, "", error), ("c", 0, "w", None)]
    three = follow(spark, tmp_path, 3, [("b", 0, "good"), ("c", 0, "v"), ("a", 0, "u")])
    assert [(i, t) for i, _, s, t, _ in three if s > max(r[2] for r in two)] == [("b", "good")]
    assert [p.name for p in (tmp_path / "c").glob("buckets-*")] == ["buckets-1"]
    last = {(r.id, r.candidate_index): r.asr_text for r in collect.latest(spark.read.parquet(str(tmp_path / "labels")).where("id is not null"), ["id", "candidate_index"]).collect()}
    assert last == {("a", 0): "x", ("b", 0): "good", ("b", 1): "y", ("c", 0): "w"}


def test_label_stream_goes_on_after_a_crash(spark, tmp_path):
    """A batch that dies after some of its labels were made is made again, and no label is there twice."""
    follow(spark, tmp_path, 1, [(f"r{i}", 0, f"a{i}") for i in range(20)], buckets=2, batch_size=4)
    rows = [(f"r{i}", 0, f"b{i}") for i in range(10, 40)] + [("crash", 0, str(tmp_path / "crashed"))] + [(f"r{i}", 0, f"b{i}") for i in range(40, 50)]
    with pytest.raises(Exception):
        follow(spark, tmp_path, 2, rows, batch_size=4)
    assert os.path.exists(tmp_path / "crashed")
    got = follow(spark, tmp_path, 3, [("r49", 0, "c"), ("r50", 0, "c")], batch_size=4)
    assert [r[0] for r in got] == sorted(["crash", *(f"r{i}" for i in range(51))])
    assert {r[0]: r[3] for r in got} == {"crash": str(tmp_path / "crashed"), "r50": "c"} | {f"r{i}": f"{'a' if i < 20 else 'b'}{i}" for i in range(50)}


def test_label_stream_takes_labels_over(spark, tmp_path):
    known = spark.createDataFrame([("a", 0, "x", None, 5), ("b", 0, "", "E", 9), ("b", 0, "y", "", 3), (None, 0, "", None, 1)], "id string, candidate_index int, asr_text string, error string, seq long")
    got = follow(spark, tmp_path, 1, [("a", 0, "z"), ("b", 0, "w"), ("c", 0, "v")], known=known, buckets=1)
    assert [(i, s, t) for i, _, s, t, _ in got] == [("b", 10, "w"), ("c", 11, "v")]


def test_later_labels_outrank_earlier_ones(spark, tmp_path):
    source, labels = tmp_path / "m", str(tmp_path / "labels")
    source.mkdir()
    for turn, word in enumerate(("bad", "good")):
        put(source / f"{turn}.json", manifest_rows(*((f"r{i}", 0, word) for i in range(300))))
        stream_labels(spark, str(source), labels, str(tmp_path / "c"), Fails).awaitTermination(120)
    last = collect.latest(spark.read.parquet(labels), ["id", "candidate_index"]).collect()
    assert len(last) == 300 and all(r.asr_text == "good" and r.error is None for r in last)
