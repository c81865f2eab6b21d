"""Typed options of the two jobs."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class HealthJobConfig:
    """Frame job: score, filter, archive, and ask for a video when a session goes quiet."""

    bucket: str
    checkpoint: str
    base_path: str
    module: str
    protocol: str = "gs://"
    window_period_seconds: int = 60
    window_size_seconds: int = 300
    min_score_threshold: float = 0.66
    max_boxes_to_draw: int = 5
    watermark_delay: str = "0 seconds"
    repeats_within: str | None = None
    model_version: str | None = None

    @property
    def session_gap_seconds(self) -> int:
        return 2 * self.window_period_seconds


@dataclass(frozen=True)
class RenderJobConfig:
    """Render job: turn a request into a render manifest and an alert."""

    bucket: str
    checkpoint: str
    base_path: str
    module: str
    protocol: str = "gs://"
