"""Thresholds of all steps."""

from __future__ import annotations

from dataclasses import dataclass

# Results depend on each of them.
EARTH_RADIUS_M = 6_371_000.0
MAX_SPEED_MPS = 300 * 0.514444
NULL_ISLAND_DEG = 1e-6
LOW_ALTITUDE_M, HIGH_ALTITUDE_M = -400.0, 12000.0
CRUISE_ANCHOR_MPS = (45.0, 75.0)
TRAJECTORY_ANCHOR_MPS = (25.0, 90.0)
MAP_CELL_DEG = 0.25
KM_PER_DEG = 111.32


@dataclass(frozen=True)
class SegmentConfig:
    max_lag_s: float = 10.0
    gap_split_s: float = 60.0
    glitch_passes: int = 3
    persistent_fraction: float = 0.05
    max_speed_mps: float = MAX_SPEED_MPS
    min_duration_s: float = 300.0
    min_points: int = 20
    min_velocity_mps: float = 15.0


@dataclass(frozen=True)
class GridConfig:
    dt_s: float = 10.0
    max_gap_s: float = 30.0
    min_duration_s: float = 300.0
    min_points: int = 30
    max_speed_mps: float = MAX_SPEED_MPS
    max_accel_mps2: float = 10.0
    max_turn_rate_deg_s: float = 6.0
    violation_fraction: float = 0.05
    smooth: bool = False
    drop_dynamics: bool = False
