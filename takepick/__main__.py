"""``python -m takepick``: a labeling run from the command line.

Every field of ``LabelingConfig`` is an option, with dashes or underscores.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from dataclasses import fields

from pyspark.sql import SparkSession

from takepick.config import LabelingConfig
from takepick.operators.models import model_maker
from takepick.plans.labeling import LabelingRun


def _names(field: str) -> list[str]:
    return list(dict.fromkeys((f"--{field.replace('_', '-')}", f"--{field}")))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="takepick", description="Prepare, transcribe and score candidate recordings.")
    p.add_argument(*_names("input_json"), nargs="+", required=True, help="files, folders or globs of records")
    p.add_argument(*_names("output_dir"), required=True, help="folder of the run, shared by driver and executors")
    p.add_argument(*_names("result_name"), default="result.json", help="the result document, in that folder")
    mode = p.add_mutually_exclusive_group()
    mode.add_argument(*_names("prepare_only"), action="store_true")
    mode.add_argument(*_names("collect_only"), action="store_true")
    config = p.add_argument_group("settings of the run")
    default = LabelingConfig()
    for f in fields(LabelingConfig):
        value = getattr(default, f.name)
        if isinstance(value, bool):
            config.add_argument(*_names(f.name), action="store_true")
        else:
            config.add_argument(*_names(f.name), type=type(value) if value is not None else str, default=value)
    model = p.add_argument_group("model")
    model.add_argument(*_names("factory"), help='class that loads the model, "package.module:Class"')
    model.add_argument(*_names("model"), default="")
    model.add_argument(*_names("backend"), choices=("vllm", "transformers"), default="vllm")
    for name, value in (("max_new_tokens", 1024), ("gpu_memory_utilization", 0.7), ("tensor_parallel_size", 1)):
        model.add_argument(*_names(name), type=type(value), default=value)
    model.add_argument(*_names("max_model_len"), type=int)
    model.add_argument(*_names("attention_backend"), default="FLASH_ATTN")
    return p


def main(arguments: Sequence[str] | None = None) -> int:
    p = parser()
    a = p.parse_args(arguments)
    try:
        config = LabelingConfig(**{f.name: getattr(a, f.name) for f in fields(LabelingConfig)})
    except ValueError as e:
        p.error(str(e))
    if not a.factory and not (a.prepare_only or a.collect_only):
        p.error("--factory is needed to transcribe")
    run = LabelingRun(SparkSession.builder.getOrCreate(), a.output_dir, config)
    document = f"{run.folder}/{a.result_name}"
    if a.collect_only:
        run.collect(document)
    elif a.prepare_only:
        run.prepare(a.input_json)
    else:
        options = ("backend", "batch_size", "max_new_tokens", "gpu_memory_utilization", "tensor_parallel_size", "max_model_len", "attention_backend")
        run.run(a.input_json, model_maker(a.factory, a.model, **{n: getattr(a, n) for n in options}), document)
    return 0


if __name__ == "__main__":
    sys.exit(main())
