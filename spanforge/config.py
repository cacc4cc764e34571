"""Settings of the composite pipelines; lengths in pixels, shares and thresholds as numbers."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DetectionConfig:
    tree_class_id: int = 2
    window: int = 1024
    stride: int = 768
    band_indices: list[int] = field(default_factory=lambda: [1, 2, 3])
    percentile_clip: tuple[float, float] = (2, 98)
    blur_size: int = 3
    min_size: int = 50
    stitch_shift: int = 6
    iou: float = 0.7
    containment: float = 0.92
    dust: int = 0
    drop_image_edge: bool = False
    chunk_size: int = 6400
    chunk_buffer: int = 94
    pixel_area_m2: float = 0.0256

    def __post_init__(self):
        if not 0 < self.stride <= self.window or not 0 < self.iou <= 1 or not 0 < self.containment <= 1 or self.dust < 0:
            raise ValueError("stride within the window, thresholds in (0, 1], dust not negative")


@dataclass(frozen=True)
class HeightConfig:
    threshold: float = 3.0
    min_share: float = 0.30
    cell: float = 1.0
    quantile: float = 0.99
    drop: bool = False


@dataclass(frozen=True)
class TrainingSource:
    name: str
    width: int
    height: int
    qc_field: str | None = None
    qc_pass_values: list | None = None
    bbox: tuple[float, float, float, float] | None = None
    val: tuple[float, float, float, float] | None = None


@dataclass(frozen=True)
class TrainingConfig:
    sources: list[TrainingSource]
    tile: int = 512
    stride: int = 384
    min_instances: int = 1

    def __post_init__(self):
        names = [s.name for s in self.sources]
        if not names or len(set(names)) != len(names):
            raise ValueError("source names must be given and distinct")
