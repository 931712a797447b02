"""Models of other packages as transcribers: loading, and calls that fit what a model takes."""

from __future__ import annotations

import importlib
import inspect
import os
from collections.abc import Callable, Sequence
from typing import Any

from takepick.operators.transcribe import Transcriber

#: The names under which models take recordings, in order of preference.
METHODS = ("transcribe", "generate", "__call__")


def _accepts(method: Callable, options: dict[str, Any]) -> bool:
    try:
        inspect.signature(method).bind([], **options)
    except TypeError:
        return False
    except ValueError:  # built in, without a signature
        return True
    return True


class Adapted:
    """A model with any of ``METHODS`` as a ``Transcriber``.

    Language and context are handed over where the method takes them.  One result
    for several recordings counts as a list of one.  A method that refuses a list,
    by its signature or with a ``TypeError``, leaves it to the next one.  If all
    refuse it, the first gets lists of one recording, and where it refuses these
    too, each recording by itself.
    """

    def __init__(self, model: Any):
        self.model = model

    def transcribe(self, audio: Sequence[str], language: str | None, context: str) -> list[Any]:
        options = {k: v for k, v in (("language", language), ("context", context)) if v}
        methods = [m for m in (getattr(self.model, n, None) for n in METHODS) if callable(m)]
        if not methods:
            raise TypeError(f"{type(self.model).__name__} has none of {', '.join(METHODS)}")
        for method in methods:
            try:
                return self._call(method, list(audio), options)
            except TypeError:
                continue
        first = next((m for m in methods if _accepts(m, {})), methods[0])
        return [r for a in audio for r in self._single(first, a, options)]

    def _call(self, method: Callable, given: Any, options: dict[str, Any]) -> list[Any]:
        return self._list(method(given, **{k: v for k, v in options.items() if _accepts(method, {k: v})}))

    def _single(self, method: Callable, audio: str, options: dict[str, Any]) -> list[Any]:
        try:
            return self._call(method, [audio], options)
        except TypeError:
            return self._call(method, audio, options)

    @staticmethod
    def _list(results: Any) -> list[Any]:
        return list(results) if isinstance(results, (list, tuple)) else [results]


def model_maker(
    factory: str,
    model: str,
    backend: str = "vllm",
    batch_size: int = 8,
    max_new_tokens: int = 1024,
    gpu_memory_utilization: float = 0.7,
    tensor_parallel_size: int = 1,
    max_model_len: int | None = None,
    attention_backend: str = "FLASH_ATTN",
    skip_version_check: bool = True,
) -> Callable[[], Transcriber]:
    """A ``make`` for ``transcribe``: loads ``model`` by the class ``factory`` ("package.module:Class") where it runs.

    ``vllm`` calls the class's ``LLM``, ``transformers`` its ``from_pretrained``.
    The package is imported by the task, after the settings it reads at import.
    """
    if backend not in ("vllm", "transformers"):
        raise ValueError("backend must be one of vllm, transformers")
    size = {"max_inference_batch_size": batch_size, "max_new_tokens": max_new_tokens}
    memory = {"gpu_memory_utilization": gpu_memory_utilization, "tensor_parallel_size": tensor_parallel_size}
    if max_model_len is not None:
        memory["max_model_len"] = max_model_len

    def make() -> Transcriber:
        if backend == "vllm":
            os.environ["FLASHINFER_DISABLE_VERSION_CHECK"] = "1" if skip_version_check else "0"
            if attention_backend.lower() != "auto":
                os.environ["VLLM_ATTENTION_BACKEND"] = attention_backend
        module, _, name = factory.partition(":")
        kind = getattr(importlib.import_module(module), name)
        build = getattr(kind, "LLM" if backend == "vllm" else "from_pretrained", None)
        if build is None:
            raise TypeError(f"{name} can't load a model for {backend}")
        return Adapted(build(model=model, **size, **memory) if backend == "vllm" else build(model, **size))

    return make
