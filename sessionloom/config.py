"""Thresholds of every stage, with the values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Quality:
    large_return: float = 0.2
    spike_multiple: float = 10.0
    spike_window: int = 20
    spike_least: int = 10


@dataclass(frozen=True)
class Features:
    returns: tuple[int, ...] = (1, 5, 20)
    sma: tuple[int, ...] = (5, 10, 20, 50, 200)
    ema: tuple[int, ...] = (12, 26, 50)
    rsi: int = 14
    atr: int = 14
    macd: tuple[int, int, int] = (12, 26, 9)
    bollinger: int = 20
    bollinger_width: float = 2.0
    volatility: tuple[int, ...] = (20, 60)
    year: int = 252
    extremes: int = 252
    volume: int = 20
    momentum: int = 10
    core: tuple[str, ...] = ("return_1d", "sma_20", "ema_26", "rsi_14", "macd_signal", "atr_14", "volatility_20")
    version: str = "features-1"


@dataclass(frozen=True)
class Analytics:
    benchmark: str = "NO"
    year: int = 252
    risk_free: float = 0.0
    least_returns: int = 30
    rolling: int = 60

    @property
    def daily_risk_free(self) -> float:
        return (1 + self.risk_free) ** (1 / self.year) - 1


@dataclass(frozen=True)
class Signals:
    high_volatility: float = 0.35
    low_volatility: float = 0.15
    abnormal_volume: float = 2.0
    z_threshold: float = 3.0
    z_rows: int = 60
    z_least: int = 40
    forest_rows: int = 252
    forest_least: int = 120
    forest_trees: int = 100
    forest_sample: int = 256
    contamination: float = 0.05
    seed: int = 42


@dataclass(frozen=True)
class Models:
    train_years: int = 3
    fold_months: int = 3
    holdout_months: int = 12
    least_train: int = 100
    trees: int = 40
    depth: int = 6
    least_leaf: int = 30
    boost_trees: int = 60
    boost_depth: int = 3
    boost_rate: float = 0.05
    seed: int = 42
    targets: dict[str, int] = field(default_factory=lambda: {"direction_1d": 1, "future_return_1d": 1, "future_return_5d": 5})
