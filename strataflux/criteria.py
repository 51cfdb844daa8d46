"""Thresholds of the screening, each of which a caller may replace."""

from __future__ import annotations

from dataclasses import dataclass, field

# Typical spans in m by superstructure, continuous superstructures and ratio thresholds by facility class.
TYPICAL_SPAN_M = {
    "RC슬래브교": 10, "RC중공슬래브교": 15, "PSC슬래브교": 20, "라멘교": 15, "RCT거더교": 15, "PSCI거더교": 30, "PSC박스거더교": 50, "강박스거더교": 45,
    "프리플렉스거더교": 35, "강I거더교": 35, "강플레이트거더교": 30, "사장교": 150, "현수교": 200, "아치교": 80, "트러스교": 60,
}
CONTINUOUS_TYPES = ("라멘교", "PSC박스거더교", "강박스거더교", "사장교", "현수교", "아치교", "트러스교")
RATIO_THRESHOLDS = {"1종": (0.3, 0.5, 0.7), "2종": (0.4, 0.6, 0.8), "3종": (0.5, 0.7, 0.9), "기타": (0.5, 0.7, 0.9)}
CLASS_LABELS = {1: "1종", 2: "2종", 3: "3종", 99: "기타"}
LEVEL_LABELS = ("정상", "관심", "주의", "경고")
INDICATORS = {"V": (1, 2, 4), "ACC": (1, 2, 3), "DIFF": (1, 2, 3), "CUM": (10, 20, 30)}
WAVELENGTH_M = 0.05546576


@dataclass(frozen=True)
class Criteria:
    bperp_max_m: float = 200.0
    coherence_ladder: tuple[float, ...] = (0.95, 0.92, 0.90, 0.85, 0.80)
    settlement_mm: float = 25.0
    beta_continuous: float = 0.002
    beta_simple: float = 0.002
    span_default_m: float = 25.0
    spans_m: dict[str, float] = field(default_factory=lambda: dict(TYPICAL_SPAN_M))
    continuous_types: tuple[str, ...] = CONTINUOUS_TYPES
    thresholds: dict[str, tuple[float, float, float]] = field(default_factory=lambda: dict(RATIO_THRESHOLDS))
    projection_years: float = 10.0
    min_deck_points: int = 5
    min_cover: float = 0.25
    ring_m: tuple[float, float] = (30.0, 300.0)
    min_ring: int = 8
    min_observations: int = 12


#: Where a criteria document keeps what :class:`Criteria` holds.
_PLACES = {
    "bperp_max_m": ("quality", "bperp_max_m"), "coherence_ladder": ("quality", "ref_coherence"), "settlement_mm": ("allowable", "total_settlement_mm"),
    "beta_continuous": ("allowable", "angular_distortion", "continuous"), "beta_simple": ("allowable", "angular_distortion", "simple"), "spans_m": ("allowable", "typical_span_m"),
    "continuous_types": ("allowable", "continuous_types"), "thresholds": ("ratio_thresholds",), "projection_years": ("projection_years",), "ring_m": ("ground_ring_m",),
    "min_deck_points": ("review", "min_deck_ps"), "min_cover": ("review", "min_node_cover"),
}


def from_document(base: dict, override: dict | None = None) -> Criteria:
    """Criteria of a parsed document; a top-level entry of ``override`` takes the place of the whole entry. What neither has keeps its default."""
    document, found = {**base, **(override or {})}, {}
    for name, path in _PLACES.items():
        value = document
        for key in path:
            value = value.get(key) if isinstance(value, dict) else None
        if value is not None:
            found[name] = tuple(value) if isinstance(value, list) else value
    if "spans_m" in found:
        spans = dict(found["spans_m"])
        found["span_default_m"] = float(spans.pop("default", 25.0))
        found["spans_m"] = spans
    if "thresholds" in found:
        found["thresholds"] = {k: tuple(v) for k, v in found["thresholds"].items()}
    return Criteria(**found)


def load(path: str, override: dict | None = None) -> Criteria:
    """Criteria from a YAML file; needs the yaml package."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return from_document(yaml.safe_load(f) or {}, override)
