"""Batched transcription by a pluggable function, with failures kept as rows."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType


class Transcriber(Protocol):
    """Turns audio paths into results, one each, in order.

    A result is a mapping or an object with ``text``, and may have ``language``
    and more.
    """

    def transcribe(self, audio: Sequence[str], language: str | None, context: str) -> Sequence[Any]: ...


def read_result(result: Any) -> tuple[str, str | None, dict[str, Any]]:
    """(text, language, the rest) of a result of any kind; what is not understood has an empty text."""
    if isinstance(result, Mapping):
        fields = dict(result)
    else:
        fields = {k: v for k, v in getattr(result, "__dict__", {}).items() if not k.startswith("_")}
    text, language = fields.pop("text", None), fields.pop("language", None)
    return str(text) if text else "", language, fields


def label_batch(model: Transcriber, audio: list[str], language: str | None, context: str, isolate: bool) -> list[tuple[str, str | None, str | None, str | None]]:
    """(asr_text, language, error, asr_extra) of each recording.

    An exception, or a wrong number of results, fails the whole batch; with
    ``isolate`` its halves are tried again, so that only bad recordings fail.  A
    batch of one takes the first result, or an empty one.
    """
    try:
        results = list(model.transcribe(audio, language, context))
        if len(audio) == 1:
            results = results[:1] or [{}]
        elif len(results) != len(audio):
            raise RuntimeError(f"expected {len(audio)} results, got {len(results)}")
        out = []
        for r in results:
            text, spoken, extra = read_result(r)
            out.append((text, spoken or language, None, json.dumps(extra, ensure_ascii=False, default=str) if extra else None))
        return out
    except Exception as e:
        if isolate and len(audio) > 1:
            half = len(audio) // 2
            return label_batch(model, audio[:half], language, context, isolate) + label_batch(model, audio[half:], language, context, isolate)
        return [("", None, f"{type(e).__name__}: {e}", None)] * len(audio)


def transcribe(
    manifest: DataFrame,
    make: Callable[[], Transcriber],
    batch_size: int = 8,
    language: str | None = None,
    context: str = "",
    isolate: bool = False,
    profile: Any = None,
    barrier: bool = False,
) -> DataFrame:
    """Manifest rows and asr_text, language, error, asr_extra (JSON).

    ``make`` is called once per task, and only if there is a row to transcribe.
    ``profile`` is a resource profile (a GPU for each task, say) and ``barrier``
    starts all tasks together, for models spread over several.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be > 0")
    kept = [c for c in manifest.columns if c not in ("asr_text", "language", "error", "asr_extra")]
    more = ("asr_text", "language", "error", "asr_extra")
    schema = StructType([*manifest.select(*kept).schema.fields, *(StructField(c, StringType()) for c in more)])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, held = None, None
        for pdf in parts:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            whole = len(held) - len(held) % batch_size
            if whole:
                model = model or make()
                yield label(model, held[:whole])
                held = held[whole:].reset_index(drop=True)
        if held is not None and len(held):
            yield label(model or make(), held)

    def label(model: Transcriber, pdf: pd.DataFrame) -> pd.DataFrame:
        audio = pdf["audio"].tolist()
        made = [x for at in range(0, len(audio), batch_size) for x in label_batch(model, audio[at : at + batch_size], language, context, isolate)]
        return pdf.assign(**{c: [m[i] for m in made] for i, c in enumerate(more)})

    return manifest.select(*kept).mapInPandas(run, schema, barrier=barrier, profile=profile)
