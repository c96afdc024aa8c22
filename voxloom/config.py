"""Folders and thresholds; each folder is overridable by an environment variable."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path


def _path(name: str, default: str):
    def value() -> str:
        text = os.environ.get(name, default)
        return str(Path(text).expanduser()) if text else ""

    return field(default_factory=value)


@dataclass(frozen=True)
class Config:
    """Paths of one run; ``VOXLOOM_ROOT`` moves all defaults."""

    root: str = _path("VOXLOOM_ROOT", "~/voxloom-data")
    catalog: str = _path("VOXLOOM_CATALOG", "")
    segments: str = _path("VOXLOOM_SEGMENTS", "")
    segments_audio: str = _path("VOXLOOM_SEGMENTS_AUDIO", "")
    trimmed: str = _path("VOXLOOM_TRIMMED", "")
    trimmed_audio: str = _path("VOXLOOM_TRIMMED_AUDIO", "")
    audio_scores: str = _path("VOXLOOM_AUDIO_SCORES", "")
    text_scores: str = _path("VOXLOOM_TEXT_SCORES", "")
    embeddings: str = _path("VOXLOOM_EMBEDDINGS", "")
    speakers: str = _path("VOXLOOM_SPEAKERS", "")
    release: str = _path("VOXLOOM_RELEASE", "")
    status: str = _path("VOXLOOM_STATUS", "")
    min_audio_score: float = 75.0
    min_text_score: float = 0.5
    merge_similarity: float = 0.85

    def folder(self, name: str) -> str:
        return getattr(self, name, "") or f"{self.root}/{name}"
