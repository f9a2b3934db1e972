"""Typed configuration with the reference pipeline's defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FeatureConfig:
    # Fixed values that must equal the reference's defaults.
    rolling_windows: tuple[int, ...] = (5, 10, 20, 60)
    rsi_period: int = 14
    macd_fast: int = 12
    macd_slow: int = 26
    macd_signal: int = 9
    bb_period: int = 20
    atr_period: int = 14
    target_horizon_days: int = 5
    gdd_base_temp_f: float = 50.0
    gdd_heat_stress_f: float = 95.0
    rvol_windows: tuple[int, ...] = (5, 10, 20, 60)
    heat_windows: tuple[int, ...] = (7, 14, 30)
    prcp_sum_windows: tuple[int, ...] = (10, 20, 30)
    long_window: int = 365
    long_min_periods: int = 30
    corr_window: int = 20
    # 1 = calendar year (what the reference computes); 4 = the documented April start.
    season_start_month: int = 1
    # True: averages re-weight over NULL closes between others, at a sort per average; False: such a close fails the build.
    ema_gaps: bool = False


@dataclass(frozen=True)
class TransformConfig:
    # Fixed values that must equal the reference's defaults.
    max_null_rate: float = 0.05
    min_daily_volume: float = 2000.0
    asof_tolerance_days: int = 3
    asof_direction: str = "nearest"  # nearest | backward | forward
    dedupe_keep: str = "first"  # first | last (by ingest order)
    snow_in_to_mm: float = 25.4


@dataclass(frozen=True)
class MonitoringConfig:
    # Fixed values that must equal the reference's defaults.
    lookback_years: int = 5
    min_row_fraction: float = 0.80
    psi_critical: float = 0.20
    psi_bins: int = 10
    psi_min_values: int = 20
    psi_columns: tuple[str, ...] = ("rsi", "rvol_20d", "gdd_cumulative", "close")
    max_gap_days: int = 5
    max_feature_null_rate: float = 0.10
    leakage_max_corr: float = 0.9
    lookahead_max_corr: float = 0.95


@dataclass(frozen=True)
class ModelConfig:
    # Fixed values that must equal the reference's defaults, as far as the booster has them.
    test_size: float = 0.15
    n_cv_splits: int = 5
    gap_days: int = 5
    max_iter: int = 600
    max_depth: int = 5
    step_size: float = 0.04
    subsampling_rate: float = 0.8
    feature_subset_strategy: str = "0.75"
    min_instances_per_node: int = 5
    seed: int = 42
    bull_threshold: float = 0.1
    bear_threshold: float = -0.1
    prediction_buckets: tuple[float, ...] = (-5, -3, -2, -1, -0.5, 0, 0.5, 1, 2, 3, 5)


@dataclass(frozen=True)
class Config:
    features: FeatureConfig = field(default_factory=FeatureConfig)
    transforms: TransformConfig = field(default_factory=TransformConfig)
    monitoring: MonitoringConfig = field(default_factory=MonitoringConfig)
    model: ModelConfig = field(default_factory=ModelConfig)
    # label -> symbol of the correlated instruments (driver tables: market segments)
    correlated: tuple[tuple[str, str], ...] = (
        ("wheat", "AUTOMOBILE"),
        ("crude", "FURNITURE"),
        ("usd", "HOUSEHOLD"),
    )
    # None = every symbol is a spine series; the reference's single series is "BUILDING" (corn)
    spine_symbols: tuple[str, ...] | None = None
    weather_datatypes: tuple[str, ...] = ("TMAX", "TMIN", "PRCP", "SNOW")
    refresh_window_days: int = 30
    # Split every series into chunks of this many rows (with halos) so that one series
    # holding a large share of all rows runs as many tasks; None = one task per series.
    series_chunk_rows: int | None = None
