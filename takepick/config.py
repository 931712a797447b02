"""Settings of a labeling run; wrong ones fail before any work starts."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class LabelingConfig:
    """What a run can be told.  Key names say where the parts of a record are."""

    id_key: str = "id"
    output_key: str = "output"
    text_key: str = "text"
    candidate_key: str = "candidate_audio_path"
    text_separator: str = " "
    audio_root: str | None = None
    home: str = field(default_factory=lambda: os.path.expanduser("~"))  # what ~ in an audio path stands for
    sample_rate: int = 16000
    gap_ms: float = 0.0
    resample: str = "polyphase"  # or "linear"
    normalize: str = "basic"  # or "none"
    tokenizer: str = "word"  # or "char"
    workers: int = 8
    batch_size: int = 8
    language: str | None = None
    context: str = ""
    overwrite_audio: bool = False
    overwrite_labels: bool = False

    def __post_init__(self) -> None:
        for name in ("sample_rate", "workers", "batch_size"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be > 0")
        for name, known in (("normalize", ("basic", "none")), ("tokenizer", ("word", "char")), ("resample", ("linear", "polyphase"))):
            if getattr(self, name) not in known:
                raise ValueError(f"{name} must be one of {', '.join(known)}")

    def fingerprint(self) -> str:
        """Of the settings that prepared audio depends on, so that a changed run does not reuse it."""
        names = ("id_key", "output_key", "text_key", "candidate_key", "text_separator", "audio_root", "home", "sample_rate", "gap_ms", "resample")
        return "|".join(f"{f.name}={getattr(self, f.name)!r}" for f in fields(self) if f.name in names)
