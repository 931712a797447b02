"""Queries of sources, sinks, audio files, models and whole runs, and their SQL.

Each writes its input, made of the shared tables, to a folder of its own below
the shared folder, reads it through the operator under test, and deletes it.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from takepick import queries as q
from takepick.config import LabelingConfig
from takepick.functions import audio, text
from takepick.operators import collect, prepare, shard
from takepick.operators.models import Adapted, model_maker
from takepick.operators.transcribe import transcribe
from takepick.plans import progress
from takepick.plans.labeling import LabelingRun
from takepick.schemas import LABEL
from takepick.sources import sinks
from takepick.sources.audio_files import read_audio, write_candidate_audio, write_wavs
from takepick.sources.label_store import LabelStore
from takepick.sources.listing import expand_paths
from takepick.sources.records import label_files, read_jsonl, read_records
from takepick.sources.shared import checkpointed, delete, shared_dir
from takepick.streaming.labels import stream_labels


@contextmanager
def _folder(spark: SparkSession) -> Iterator[str]:
    base = f"{re.sub(r'^file:/+', '/', shared_dir(spark))}/queries-{uuid.uuid4().hex}"
    os.makedirs(base)
    try:
        yield base
    finally:
        delete(spark, base)


def _turn(record: str = "record") -> list[Column]:
    get = lambda name, kind: F.variant_get(record, f"$.{name}", kind)
    return [get("conv_id", "long").alias("conv_id"), get("turn", "long").alias("turn"), get("role", "string").alias("role"), F.md5(get("text", "string")).alias("text_md5")]


def scan_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of JSON Lines files, numbered over all files."""
    with _folder(spark) as f:
        q.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").orderBy("conv_id", "turn").write.json(f"{f}/in")
        return checkpointed(read_records(spark, expand_paths(spark, [f"{f}/in"])).select("record_index", *_turn()))


def _as_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows as the lines of one JSON array."""
    n = 0
    for batch in batches:
        lines = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([(", " if n + i else "[\n") + x for i, x in enumerate(lines)], pa.string())], ["value"])
        n += len(lines)
    yield pa.RecordBatch.from_arrays([pa.array(["]" if n else "[]"])], ["value"])


def scan_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one JSON array each, read by as many tasks as they have splits."""
    turns = q.table(spark, sf_dir, "conversations").orderBy("conv_id", "turn").select(F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("json"))
    with _folder(spark) as f:
        turns.mapInArrow(_as_arrays, "value string").write.text(f"{f}/in")
        return checkpointed(read_records(spark, expand_paths(spark, [f"{f}/in/part-*"])).select("record_index", *_turn()))


def record_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as files of different forms: lines with blanks around them, arrays, indented objects, and blank files."""
    name = F.lpad(F.col("item_id").cast("string"), 9, "0")
    one = F.to_json(F.struct(F.col("item_id").alias("id"), "text"))
    other = F.to_json(F.struct((F.col("item_id") + 1000000).alias("id"), "text"))
    indented = F.concat(F.lit("{\n \"id\":"), F.col("item_id").cast("string"), F.lit(",\n \"text\":[\"}\\\"]\"]\n}"))
    blank = F.when(F.col("item_id") % 2 == 0, F.lit(" \t\n")).otherwise("[ ]")
    forms = (F.concat(F.lit("\n\t\n  "), one, F.lit("\t\n"), other), F.concat(F.lit(" ["), one, F.lit(",\n"), other, F.lit("] ")), indented, blank)
    made = F.get(F.array(*forms), (F.col("item_id") % 4).cast("int"))
    with _folder(spark) as f:
        q.table(spark, sf_dir, "benchmark").select(name.alias("item"), made.alias("value")).repartition(8).write.partitionBy("item").text(f"{f}/in")
        rows = read_records(spark, expand_paths(spark, [f"{f}/in/item=*/part-*"]))
        file = F.regexp_extract("source_json", "item=([0-9]+)", 1).cast("long").alias("item_id")
        return checkpointed(rows.select("record_index", file, F.variant_get("record", "$.id", "long").alias("id")))


def expanded_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders, a glob of files named before, a detour and a path that isn't there: each file once, in order."""
    name = F.lpad(F.col("item_id").cast("string"), 9, "0")
    with _folder(spark) as f:
        q.table(spark, sf_dir, "benchmark").select(name.alias("item"), "text").repartition(8).write.partitionBy("item").json(f"{f}/in")
        found = expand_paths(spark, [f"{f}/in/item=*[02468]", f"{f}/in/item=*", f"{f}/in/../in/item=*/*.json", f"{f}/none.json"])
        places = spark.createDataFrame(list(enumerate(found)), "place long, path string")
        return checkpointed(places.select("place", F.coalesce(F.expr("try_cast(regexp_extract(path, 'item=([0-9]+)', 1) as long)"), F.lit(-1)).alias("item_id")))


def label_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label files in order of their names; the last line of a key wins, failures included."""
    rows = q.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"), (F.col("event_id") % 3).cast("int").alias("candidate_index"), F.col("event_type").alias("asr_text"), F.when(F.col("value") < 10, "E").alias("error"), "event_id"
    )
    with _folder(spark) as f:
        rows.orderBy("event_id").write.json(f"{f}/labels", ignoreNullFields=False)
        read = read_jsonl(spark, label_files(spark, f"{f}/labels", "part-*.json"), "id string, candidate_index int, asr_text string, error string, event_id long")
        return checkpointed(collect.latest(read, ["id", "candidate_index"]).select("id", "candidate_index", "asr_text", "error", "event_id", F.col("seq")))


def shard_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards written over those of a larger run and read again."""
    docs = q.table(spark, sf_dir, "documents").select("doc_id")
    with _folder(spark) as f:
        for workers in (12, 8):
            sinks.write_shards(shard.round_robin(docs, workers, ["doc_id"]), f"{f}/shards")
        read = spark.read.schema("doc_id long, position long, shard_id int").json(f"{f}/shards")
        return checkpointed(read.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"), F.sum("doc_id").alias("total"), F.max("position").alias("last_position")))


def compact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = sinks.compact_json("conv_id", "turn", "role", F.lit(None).cast("string").alias("note"), "text")
    return q.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(row).alias("json_md5"))


def jsonl_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice (the first goes), then appended to."""
    rows = q.table(spark, sf_dir, "benchmark").select("item_id", "text", F.lit(None).cast("string").alias("note"))
    with _folder(spark) as f:
        for part in (rows, rows.where("item_id % 2 = 0")):
            sinks.write_jsonl(part, f"{f}/rows")
        sinks.append_jsonl(rows, f"{f}/rows")
        read = read_jsonl(spark, label_files(spark, f"{f}/rows", "part-*.json"), "item_id long, text string, note string")
        return checkpointed(read.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.md5(F.max("text")).alias("text_md5"), F.count("note").alias("notes")))


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates, groups and errors of one validation, written and counted."""
    valid = checkpointed(prepare.validate(q._records(spark, sf_dir)))
    with _folder(spark) as f:
        sinks.write_manifests(prepare.candidates(valid, "/out"), prepare.groups(valid, "/out"), prepare.errors(valid), f)
        parts = [spark.read.json(f"{f}/{kind}").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids")).select(F.lit(kind).alias("kind"), "n", "ids") for kind in ("candidates", "groups", "errors")]
        return checkpointed(parts[0].unionAll(parts[1]).unionAll(parts[2]))


def _written(spark: SparkSession, sf_dir: str, folder: str, stereo: bool = False) -> DataFrame:
    """Vectors as WAV files, ``wav/<vec_id>.wav``: their ids."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            signals = [np.asarray(e, np.float32) for e in pdf["embedding"]]
            data = [audio.encode_pcm16(np.stack((x, x[::-1]), axis=1) if stereo else x, 16000) for x in signals]
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "audio": [f"{folder}/wav/{i}.wav" for i in pdf["vec_id"]], "wav": data})

    rows = q.table(spark, sf_dir, "embeddings").select("vec_id", "embedding").mapInPandas(encode, "vec_id long, audio string, wav binary")
    return checkpointed(write_wavs(rows).select("vec_id"))


def _wavs(spark: SparkSession, folder: str) -> DataFrame:
    """WAV files read again: rate and samples."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [audio.decode(x) for x in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"], "rate": [r for _, r in made], "signal": [x.astype(float) for x, _ in made]})

    read = read_audio(spark, [folder]).mapInPandas(decode, "path string, rate int, signal array<double>")
    return read.select(F.regexp_extract("path", r"(\d+)\.wav$", 1).cast("long").alias("vec_id"), "rate", F.size("signal").cast("long").alias("samples"), F.round(q._signal_hash(F.col("signal")), 6).alias("total"), F.round(F.get("signal", F.lit(3)), 6).alias("fourth"))


def wav_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals as PCM16 WAV files and back."""
    with _folder(spark) as f:
        _written(spark, sf_dir, f)
        return checkpointed(_wavs(spark, f"{f}/wav"))


def channel_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two channels, the second one backwards, read as their mean."""
    with _folder(spark) as f:
        _written(spark, sf_dir, f, stereo=True)
        return checkpointed(_wavs(spark, f"{f}/wav"))


def candidate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips put together piece by piece, with silence between; every seventh candidate lacks its last clip."""
    with _folder(spark) as f:
        clip = F.concat(F.lit(f"{f}/wav/"), F.col("vec_id").cast("string"), F.when((F.col("vec_id") % 7 == 3), F.lit(".none")).otherwise(".wav"))
        own = F.concat(F.lit(f"{f}/wav/"), F.col("vec_id").cast("string"), F.lit(".wav"))
        rows = _written(spark, sf_dir, f).select("vec_id", F.array(own, own, clip).alias("audio_paths"), F.concat(F.lit(f"{f}/out/"), F.col("vec_id").cast("string"), F.lit(".wav")).alias("audio"))
        made = checkpointed(write_candidate_audio(rows, 16000, 0.5).select("vec_id", F.substring_index("error", ":", 1).alias("error")))
        return checkpointed(made.join(_wavs(spark, f"{f}/out"), "vec_id", "left"))


def resample_polyphase(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [audio.resampled(np.asarray(e, np.float32), 16000, 24000).astype(float) for e in pdf["embedding"]]
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "samples": [len(x) for x in made], "total": [x.sum() for x in made], "power": [(x * x).sum() for x in made]})

    rows = q.table(spark, sf_dir, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, samples long, total double, power double")
    return rows.select("vec_id", "samples", (F.round("total", 2) + F.lit(0.0)).alias("total"), F.round("power", 2).alias("power"))


def falsy_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are 0, false, empty or null count as empty; numbers and booleans are written out."""
    literal = F.lit(None).cast("string")
    for n, x in enumerate(("0", "false", "[]", "null", '""', "1.5", "true", "0.0")):
        literal = F.when(F.col("turn") % 9 == n, x).otherwise(literal)
    said = F.coalesce(literal, F.concat(F.lit('"'), F.col("conv_id").cast("string"), F.lit(' x "')))
    piece = F.concat(F.lit('{"text":'), said, F.lit(',"candidate_audio_path":["a"]}'))
    rows = q.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", piece.alias("p")))).alias("p"))
    whole = F.concat(F.lit('{"id":'), F.col("conv_id").cast("string"), F.lit(',"output":['), F.array_join(F.transform("p", lambda x: x["p"]), ","), F.lit("]}"))
    records = rows.select(F.col("conv_id").alias("record_index"), F.lit("/in.json").alias("source_json"), F.parse_json(whole).alias("record"))
    return prepare.validate(records).select("id", "text", "error")


def argument_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part's size, less 25, as the number of workers or the batch size: what it is refused with."""
    parts = q.table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") - 25).cast("int").alias("value"), F.when(F.col("p_partkey") % 2 == 0, "workers").otherwise("batch_size").alias("name"))

    def refused(name: str, value: int) -> str | None:
        try:
            LabelingConfig(**{name: value})
        except ValueError as e:
            return str(e)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [refused(n, v) for n, v in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said, pa.string())], [*batch.schema.names, "message"])

    return parts.mapInArrow(check, "p_partkey long, value int, name string, message string")


class Moody:
    """Stands for a model that fails on some recordings and answers in different forms."""

    def transcribe(self, audio: list[str], language: str | None, context: str) -> list:
        if any(a.endswith("3") for a in audio):
            raise RuntimeError("no signal")
        forms = ({"text": "t", "language": "xx", "score": 1}, {"text": None}, "text", {"text": "t"})
        return [forms[int(a[-1]) % 4] for a in audio]


def transcribe_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed recordings found by halving their batch; results of several forms."""
    manifest = q.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws("/", "conv_id", "turn").alias("audio"))
    return transcribe(manifest, Moody, 8, "en", isolate=True)


class Calls:
    def __call__(self, audio: str) -> dict:
        return {"text": "call " + os.path.basename(audio)}


class Generates:
    def generate(self, audio: list[str], language: str = "none") -> tuple:
        return tuple({"text": f"{language} {a}"} for a in audio)


class Transcribes:
    def transcribe(self, audio: list[str], context: str = "") -> list:
        return [{"text": f"{context} {a}"} for a in audio]


def model_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models that take other calls, or one recording at a time, as transcribers."""
    manifest = q.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("audio"))
    parts = [
        transcribe(manifest.where(F.col("turn") % 3 == n), lambda kind=kind: Adapted(kind()), 8, "de", "about").select("conv_id", "turn", "asr_text", "error")
        for n, kind in enumerate((Transcribes, Generates, Calls))
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


class Single:
    """Refuses lists of more than one recording, and in ``generate`` all lists."""

    def transcribe(self, audio: list[str], language: str = "none") -> list:
        (one,) = audio if len(audio) == 1 else (None,)
        return [{"text": f"{language} single " + one}]

    def generate(self, audio: str) -> dict:
        return {"text": "generate " + os.path.basename(audio)}


class Next:
    """Its ``transcribe`` takes one recording, its ``generate`` lists."""

    def transcribe(self, audio: str) -> dict:
        return {"text": "transcribe " + os.path.basename(audio)}

    def generate(self, audio: list[str], context: str = "") -> list:
        return [{"text": f"{context} next {a}"} for a in audio]


def refused_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models whose first method refuses a list: the next method gets it; if there is none that takes it, lists of one."""
    manifest = q.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("audio"))
    parts = [transcribe(manifest.where(F.col("turn") % 2 == n), lambda kind=kind: Adapted(kind()), 8, "de", "about").select("conv_id", "turn", "asr_text", "error") for n, kind in enumerate((Single, Next))]
    return parts[0].unionAll(parts[1])


class Package:
    """Stands for the model class of another package, with both ways to load a model."""

    def __init__(self, said: str):
        self.said = said

    @classmethod
    def LLM(cls, model: str, max_inference_batch_size: int, max_new_tokens: int, **memory: float) -> Package:
        return cls(f"LLM {model} {max_inference_batch_size} {max_new_tokens} " + " ".join(f"{k}={v}" for k, v in sorted(memory.items())))

    @classmethod
    def from_pretrained(cls, model: str, max_inference_batch_size: int, max_new_tokens: int) -> Package:
        return cls(f"pretrained {model} {max_inference_batch_size} {max_new_tokens}")

    def transcribe(self, audio: list[str]) -> list[dict]:
        return [{"text": f"{self.said} {a}"} for a in audio]


def loaded_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models that their class loads, by either backend, where the task runs."""
    manifest = q.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("audio"))
    parts = []
    for n, (backend, options) in enumerate((("vllm", {"max_model_len": 99}), ("transformers", {"batch_size": 4}))):
        make = model_maker(f"{__name__}:Package", "m", backend, **options)
        parts.append(transcribe(manifest.where(F.col("turn") % 2 == n), make).select("conv_id", "turn", "asr_text", "error"))
    return parts[0].unionAll(parts[1])


def result_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON document of all results, read back: null rates are written, errors only where there is one."""
    groups, labels = q._groups_and_labels(spark, sf_dir)
    scored = checkpointed(collect.score(groups, labels))
    with _folder(spark) as f:
        sinks.write_document(collect.results(scored), collect.missing_labels(scored).first()[0], f"{f}/result.json")
        whole, missing = sinks.read_document(spark, f"{f}/result.json")
        one = whole.select(F.lit(missing).cast("long").alias("missing_labels"), F.variant_get("result", "$.id", "string").alias("id"), F.explode(F.variant_get("result", "$.detail", "array<variant>")).alias("d"))
        get = lambda name, kind: F.variant_get("d", f"$.{name}", kind)
        return checkpointed(
            one.select(
                "id", get("candidate", "int").alias("candidate"), get("wer", "double").alias("wer"), F.is_variant_null(get("wer", "variant")).alias("wer_is_null"), get("error", "variant").isNotNull().alias("has_error"), get("error", "string").alias("error"), "missing_labels"
            )
        )


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that repeat an id are results of their own, each rated against its own text by the labels they share."""
    turns = q.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    items = F.array(*(F.struct(F.lit(i).alias("candidate_index"), F.lit(str(i)).alias("candidate"), F.lit(f"w{i}").alias("audio")) for i in range(2)))
    groups = turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("record_index"), F.col("conv_id").cast("string").alias("id"), "text", items.alias("candidates"))
    first = turns.where("turn = 0")
    labels = first.select(
        F.col("conv_id").cast("string").alias("id"), F.posexplode(F.array(F.lit(""), F.col("text"))).alias("candidate_index", "asr_text"), F.lit(None).cast("string").alias("audio"), F.lit(None).cast("string").alias("error"), F.lit(1).cast("long").alias("seq")
    )
    done = collect.results(collect.score(groups, labels))
    return done.select("record_index", "id", "best_candidate", F.size("detail").cast("long").alias("candidates"), F.get("detail", F.lit(1))["wer"].alias("wer"))


def nfkc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in full-width letters normalise to the same as in plain ones."""
    plain = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    wide = F.translate("text", plain, "".join(chr(ord(c) + 0xFEE0) for c in plain))
    return q.table(spark, sf_dir, "conversations").select("conv_id", "turn", text.normalize_basic(wide).alias("normalized"))


def normalize_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.table(spark, sf_dir, "documents").select("doc_id", text.normalize_basic(F.col("text"), exact=True).alias("normalized"))


def streamed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests that arrive in two batches, the second repeating some of the first."""
    rows = q.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.lit(0).alias("candidate_index"), F.lit("0").alias("candidate"), F.concat(F.lit("a"), F.col("doc_id").cast("string")).alias("audio"), F.col("lang").alias("text"), F.lit("s").alias("source_json"), F.lit(1).alias("num_segments"), "doc_id"
    )
    with _folder(spark) as f:
        for part in ("doc_id % 3 = 0", "doc_id % 3 < 2"):
            rows.where(part).drop("doc_id").write.mode("append").json(f"{f}/manifests")
            stream_labels(spark, f"{f}/manifests", f"{f}/labels", f"{f}/checkpoint", q.EchoTranscriber).awaitTermination()
        read = spark.read.schema(LABEL).parquet(f"{f}/labels")
        return checkpointed(read.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("asr_text").alias("asr_text")))


def stored_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains after three batches of labels, two of them summed up by key, the third as it was written."""
    labels = q.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), F.lit(0).alias("candidate_index"), F.when(F.col("quality") == 0, "RuntimeError: low").alias("error"), "doc_id")
    with _folder(spark) as f:
        store = LabelStore(spark, f"{f}/labels")
        for n in range(3):
            store.append(labels.where(F.pmod("doc_id", F.lit(3)) == n).drop("doc_id"), store.begin())
            if n < 2:
                store.compact()
        return checkpointed(store.todo(q._manifest(spark, sf_dir)).select("doc_id"))


def stored_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as labels in batches, of users who come back: each key's success, last batch, and whether its number is the last one's."""
    rows = q.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"), (F.col("event_id") % 3).cast("int").alias("candidate_index"), F.when(F.col("value") < 10, "E").alias("error"), F.col("event_type").alias("asr_text"), "event_id"
    )
    with _folder(spark) as f:
        store, begun = LabelStore(spark, f"{f}/labels", 16), []
        for n in range(4):
            begun.append(store.begin())
            store.append(rows.where(F.col("event_id") % 7 % 4 == n).drop("event_id"), begun[-1])
            if n % 2:
                store.compact()
        batch = sum((F.when(F.col("seq") >= b, 1).otherwise(0) for b in begun), F.lit(-1))
        numbers = store.labels().groupBy("id", "candidate_index").agg(F.max("seq").alias("highest"))
        keys = store.last().join(numbers, ["id", "candidate_index"], "full_outer")
        return checkpointed(keys.select("id", "candidate_index", "done", batch.alias("last_batch"), F.equal_null("seq", "highest").alias("is_last")))


class Breaks:
    """Stands for a model that takes its whole task down on some recordings."""

    def transcribe(self, audio: list[str], language: str | None, context: str) -> list[dict]:
        if any(a.startswith("broken") for a in audio):
            raise SystemExit("out of memory")
        return [{"text": a} for a in audio]


def shard_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labeled shard by shard, each a job of its own, in order; the sixth breaks: what became of each, and its labels."""
    shard_id = (F.col("doc_id") % 8).cast("int")
    audio = F.concat(F.when(shard_id == 5, "broken").otherwise("a"), F.col("doc_id").cast("string"))
    rows = q.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.lit(0).alias("candidate_index"), F.lit("0").alias("candidate"), audio.alias("audio"), F.col("lang").alias("text"), F.lit("s").alias("source_json"), F.lit(1).alias("num_segments"), F.col("doc_id").alias("record_index"), F.col("doc_id").alias("position"), shard_id.alias("shard_id")
    )
    with _folder(spark) as f:
        run = LabelingRun(spark, f)
        rows.write.partitionBy("shard_id").parquet(f"{f}/manifest")
        states = spark.createDataFrame([(n, state) for n, (state, _) in run.transcribe_shards(Breaks, concurrent=1).items()], "shard_id int, state string")
        labels = run.labels().groupBy((F.col("id").cast("long") % 8).cast("int").alias("shard_id")).agg(F.count(F.lit(1)).alias("labels"))
        return checkpointed(states.join(labels, "shard_id", "left").select("shard_id", "state", F.coalesce("labels", F.lit(0)).alias("labels")))


class CountsFrames:
    """Says one word for each tenth of a second."""

    def transcribe(self, audio_paths: list[str], language: str | None, context: str) -> list[dict]:
        out = []
        for path in audio_paths:
            with open(path, "rb") as f:
                x, rate = audio.decode(f.read())
            out.append({"text": " ".join(["w"] * (10 * len(x) // rate))})
        return out


def labeling_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run: records and clips as files, audio concatenated, shards, labels, results; every 13th record lacks a clip."""
    turns = q.table(spark, sf_dir, "conversations")
    clip = lambda n: F.concat(F.lit("clips/"), F.when((F.col("conv_id") % 13 == 5) & (F.col("turn") == 0), "none").otherwise(((F.col("turn") + n) % 4).cast("string")), F.lit(".wav"))
    said = F.array_join(F.array_repeat(F.lit("w"), (F.col("turn") % 4 + 1).cast("int")), " ")
    segment = F.struct(said.alias("text"), F.array(clip(0), clip(1)).alias("candidate_audio_path"))
    records = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", segment.alias("s")))).alias("o")).select("conv_id", F.transform("o", lambda x: x["s"]).alias("output"))
    with _folder(spark) as f:
        records.select(F.col("conv_id").alias("id"), "output").write.json(f"{f}/in")
        os.makedirs(f"{f}/in/clips")
        for n in range(4):
            with open(f"{f}/in/clips/{n}.wav", "wb") as out:
                out.write(audio.encode_pcm16(np.zeros(1600 * (n + 1), np.float32), 16000))
        run = LabelingRun(spark, f"{f}/run", LabelingConfig(workers=4))
        done = run.run([f"{f}/in"], CountsFrames, f"{f}/result.json")
        errors = spark.read.parquet(f"{f}/run/errors").select("id", F.lit(None).cast("int").alias("best_candidate"), F.lit(None).cast("double").alias("wer"), F.substring_index("error", ":", 1).alias("error"))
        good = done.select("id", "best_candidate", F.get("detail", F.lit(1))["wer"].alias("wer"), F.lit(None).cast("string").alias("error"))
        return checkpointed(good.unionAll(errors))


def preparation_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a second for each user, events as rows and their values as seconds."""
    done = q.table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("seconds"))
    return done.select("user_id", F.round(progress.rate(F.col("n"), F.col("seconds")), 6).alias("rate"))


def progress_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written under watch: rows by the intervals noted while they were, and failed ones (events below 10, documents in German)."""
    tables = {"events": F.col("value") < 10, "documents": F.col("lang") == "de"}
    out = []
    with _folder(spark) as f:
        for name, failed in tables.items():
            with progress.Progress(spark, name, 0.2) as watched:
                watched.watch(q.table(spark, sf_dir, name), failed).write.parquet(f"{f}/{name}")
            done = watched.done()
            out.append((name, sum(n for _, n in watched.intervals), done["failed"]))
    return spark.createDataFrame(out, "name string, completed long, failed long")


QUERIES = (
    scan_jsonl,
    scan_arrays,
    record_forms,
    expanded_paths,
    label_log,
    shard_files,
    compact_rows,
    jsonl_files,
    manifest_files,
    wav_files,
    channel_mean,
    candidate_files,
    resample_polyphase,
    falsy_texts,
    argument_checks,
    transcribe_failures,
    model_calls,
    refused_lists,
    loaded_models,
    result_document,
    repeated_ids,
    nfkc_texts,
    normalize_exact,
    streamed_labels,
    stored_todo,
    stored_keys,
    shard_jobs,
    labeling_run,
    preparation_rate,
    progress_counts,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


TURNS = "conv_id, turn, role, md5(text) AS text_md5 FROM conversations"
PCM = "greatest(-32768.0, least(32767.0, round_even((v * 32767::FLOAT)::DOUBLE, 0)))"


def oracle_sql() -> dict[str, str]:
    return {
        "scan_jsonl": f"SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS record_index, {TURNS}",
        "scan_arrays": f"SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS record_index, {TURNS}",
        "record_forms": """SELECT row_number() OVER (ORDER BY item_id, id) - 1 AS record_index, item_id, id
FROM (SELECT item_id, unnest(CASE item_id % 4 WHEN 0 THEN [item_id, item_id + 1000000] WHEN 1 THEN [item_id, item_id + 1000000] WHEN 2 THEN [item_id] ELSE [] END) AS id FROM benchmark)""",
        "expanded_paths": """SELECT row_number() OVER (ORDER BY o, item_id) - 1 AS place, item_id
FROM (SELECT item_id % 2 AS o, item_id FROM benchmark UNION ALL SELECT 2, -1)""",
        "label_log": """SELECT user_id::VARCHAR AS id, (event_id % 3)::INT AS candidate_index, event_type AS asr_text, CASE WHEN value < 10 THEN 'E' END AS error, event_id, seq
FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS seq FROM events) QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id DESC) = 1""",
        "shard_files": """SELECT (p % 8)::INT AS shard_id, count(*) AS n, min(doc_id) AS first_doc, sum(doc_id)::BIGINT AS total, max(p) AS last_position
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS p FROM documents) GROUP BY 1""",
        "compact_rows": "SELECT conv_id, turn, md5(json_object('conv_id', conv_id, 'turn', turn, 'role', role, 'note', NULL, 'text', text)::VARCHAR) AS json_md5 FROM conversations",
        "jsonl_files": "SELECT item_id, (CASE WHEN item_id % 2 = 0 THEN 2 ELSE 1 END)::BIGINT AS n, md5(text) AS text_md5, 0::BIGINT AS notes FROM benchmark",
        "manifest_files": f"""WITH {q.RECORDS}, good AS (SELECT count(*) AS n, count(DISTINCT id) AS ids FROM v WHERE error IS NULL)
SELECT 'candidates' AS kind, (2 * n)::BIGINT AS n, ids FROM good UNION ALL SELECT 'groups', n, ids FROM good
UNION ALL SELECT 'errors', count(*), count(DISTINCT id) FROM v WHERE error IS NOT NULL""",
        "wav_files": f"""SELECT vec_id, 16000 AS rate, len(s) AS samples, round(list_sum(s), 6) AS total, round(s[4], 6) AS fourth
FROM (SELECT vec_id, list_transform(embedding, lambda v: {PCM} / 32768) AS s FROM embeddings)""",
        "channel_mean": f"""SELECT vec_id, 16000 AS rate, len(s) AS samples, round(list_sum(s), 6) AS total, round(s[4], 6) AS fourth
FROM (SELECT vec_id, list_transform(range(1, len(p) + 1), lambda i: (p[i] + p[len(p) + 1 - i]) / 65536) AS s FROM (SELECT vec_id, list_transform(embedding, lambda v: {PCM}) AS p FROM embeddings))""",
        "candidate_files": f"""WITH s AS (SELECT vec_id, list_transform(embedding, lambda v: greatest(-32768.0, least(32767.0, round_even((({PCM} / 32768)::FLOAT * 32767::FLOAT)::DOUBLE, 0))) / 32768) AS s FROM embeddings),
x AS (SELECT vec_id, list_concat(list_concat(list_concat(s, z), list_concat(s, z)), s) AS x FROM (SELECT *, [0.0 for i in range(8)] AS z FROM s))
SELECT vec_id, CASE WHEN vec_id % 7 = 3 THEN 'FileNotFoundError' END AS error, CASE WHEN vec_id % 7 <> 3 THEN 16000 END AS rate, CASE WHEN vec_id % 7 <> 3 THEN len(x) END AS samples,
  CASE WHEN vec_id % 7 <> 3 THEN round(list_sum(x), 6) END AS total, CASE WHEN vec_id % 7 <> 3 THEN round(x[4], 6) END AS fourth FROM x""",
        "resample_polyphase": """WITH RECURSIVE t AS (SELECT unnest(range(-30, 31)) AS t),
b AS (SELECT t, 5 * sqrt(1 - (t / 30.0) ** 2) AS x, 0 AS k, 1.0::DOUBLE AS term, 1.0::DOUBLE AS total FROM t
  UNION ALL SELECT t, x, k + 1, term * (x / 2) ** 2 / (k + 1) ** 2, total + term * (x / 2) ** 2 / (k + 1) ** 2 FROM b WHERE k < 40),
raw AS (SELECT t, CASE WHEN t = 0 THEN 1 ELSE sin(pi() * t / 3.0) / (pi() * t / 3.0) END * total AS h FROM b WHERE k = 40),
taps AS (SELECT t, 3 * h / (SELECT sum(h) FROM raw) AS h FROM raw),
e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i, len(embedding) AS n FROM embeddings),
y AS (SELECT vec_id, (3 * i + t) // 2 AS k, sum(x * h) AS y FROM e, taps WHERE (3 * i + t) % 2 = 0 AND 3 * i + t >= 0 AND 3 * i + t < 3 * n GROUP BY 1, 2)
SELECT vec_id, count(*) AS samples, round(sum(y), 2) + 0.0 AS total, round(sum(y * y), 2) AS power FROM y GROUP BY 1""",
        "falsy_texts": """SELECT conv_id::VARCHAR AS id, j AS text, CASE WHEN j IS NULL THEN 'ValueError: concatenated reference text is empty' END AS error
FROM (SELECT conv_id, string_agg(CASE turn % 9 WHEN 5 THEN '1.5' WHEN 6 THEN 'True' WHEN 8 THEN conv_id || ' x' END, ' ' ORDER BY turn) AS j FROM conversations GROUP BY conv_id)""",
        "argument_checks": """SELECT p_partkey, (p_size - 25)::INT AS value, CASE WHEN p_partkey % 2 = 0 THEN 'workers' ELSE 'batch_size' END AS name,
  CASE WHEN p_size <= 25 THEN CASE WHEN p_partkey % 2 = 0 THEN 'workers' ELSE 'batch_size' END || ' must be > 0' END AS message FROM part""",
        "transcribe_failures": """SELECT conv_id, turn, conv_id || '/' || turn AS audio, CASE WHEN turn % 10 = 3 THEN '' WHEN d IN (0, 3) THEN 't' ELSE '' END AS asr_text,
  CASE WHEN turn % 10 = 3 THEN NULL WHEN d = 0 THEN 'xx' ELSE 'en' END AS language, CASE WHEN turn % 10 = 3 THEN 'RuntimeError: no signal' END AS error,
  CASE WHEN turn % 10 <> 3 AND d = 0 THEN '{"score": 1}' END AS asr_extra FROM (SELECT *, turn % 10 % 4 AS d FROM conversations)""",
        "model_calls": """SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'about ' WHEN 1 THEN 'de ' ELSE 'call ' END || conv_id || '-' || turn AS asr_text, NULL::VARCHAR AS error FROM conversations""",
        "refused_lists": "SELECT conv_id, turn, CASE turn % 2 WHEN 0 THEN 'de single ' ELSE 'about next ' END || conv_id || '-' || turn AS asr_text, NULL::VARCHAR AS error FROM conversations",
        "loaded_models": """SELECT conv_id, turn, CASE turn % 2 WHEN 0 THEN 'LLM m 8 1024 gpu_memory_utilization=0.7 max_model_len=99 tensor_parallel_size=1 ' ELSE 'pretrained m 4 1024 ' END
  || conv_id || '-' || turn AS asr_text, NULL::VARCHAR AS error FROM conversations""",
        "result_document": f"""WITH RECURSIVE {q.CANDIDATES}, {q._distance(q.RATED)}
SELECT l.id, l.candidate_index AS candidate, rated.rate AS wer, rated.rate IS NULL AS wer_is_null, missing OR failed IS NOT NULL AS has_error,
  CASE WHEN missing THEN 'missing worker output' ELSE failed END AS error, (SELECT count(*) FROM l WHERE missing) AS missing_labels
FROM l LEFT JOIN rated ON rated.k = l.id || '|' || l.candidate_index""",
        "repeated_ids": f"""WITH RECURSIVE f AS (SELECT conv_id, text FROM conversations WHERE turn = 0),
{q._distance("SELECT c.conv_id * 1000 + c.turn AS k, " + q.WORDS.format('c.text') + " AS r, " + q.WORDS.format('f.text') + " AS h FROM conversations c JOIN f ON f.conv_id = c.conv_id")}
SELECT k AS record_index, (k // 1000)::VARCHAR AS id, (CASE WHEN rate < 1 THEN 1 ELSE 0 END)::INT AS best_candidate, 2::BIGINT AS candidates, rate AS wer FROM rated""",
        "nfkc_texts": f"SELECT conv_id, turn, {q.NORM.format('text')} AS normalized FROM conversations",
        "normalize_exact": f"SELECT doc_id, {q.NORM.format('nfc_normalize(text)')} AS normalized FROM documents",
        "streamed_labels": "SELECT doc_id::VARCHAR AS id, 1::BIGINT AS n, 'a' || doc_id AS asr_text FROM documents WHERE doc_id % 3 < 2",
        "stored_todo": q.oracle_sql()["resume_todo"],
        "stored_keys": """SELECT user_id::VARCHAR AS id, (event_id % 3)::INT AS candidate_index, bool_or(value IS NULL OR value >= 10) AS done,
  max(event_id % 7 % 4)::INT AS last_batch, true AS is_last FROM events GROUP BY user_id, event_id % 3""",
        "shard_jobs": """SELECT (doc_id % 8)::INT AS shard_id, CASE WHEN doc_id % 8 < 5 THEN 'ended' WHEN doc_id % 8 = 5 THEN 'failed' ELSE 'not begun' END AS state,
  count(*) FILTER (WHERE doc_id % 8 < 5) AS labels FROM documents GROUP BY doc_id % 8""",
        "labeling_run": """WITH g AS (SELECT conv_id, sum(turn % 4 + 1) AS n0, sum((turn + 1) % 4 + 1) AS n1 FROM conversations GROUP BY conv_id)
SELECT conv_id::VARCHAR AS id, CASE WHEN conv_id % 13 <> 5 THEN 0 END::INT AS best_candidate, CASE WHEN conv_id % 13 <> 5 THEN abs(n1 - n0)::DOUBLE / n0 END AS wer,
  CASE WHEN conv_id % 13 = 5 THEN 'FileNotFoundError' END AS error FROM g""",
        "progress_counts": """SELECT 'events' AS name, count(*) AS completed, count(*) FILTER (WHERE value < 10) AS failed FROM events
UNION ALL SELECT 'documents', count(*), count(*) FILTER (WHERE lang = 'de') FROM documents""",
        "preparation_rate": "SELECT user_id, round(count(*) / greatest(0.001, max(value)), 6) AS rate FROM events GROUP BY user_id",
    }
