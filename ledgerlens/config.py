"""Adjustable parameters. Defaults are the published thresholds of the analysis."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    """A card is suspicious when it goes strictly above any of these."""

    daily_count: int = 10
    cities: int = 3
    daily_amount: float = 1000.0


@dataclass(frozen=True)
class RiskWeights:
    """Cap and multiplier of each part of the client risk score."""

    volume_cap: float = 20.0
    volume_scale: float = 10.0
    amount_cap: float = 20.0
    amount_scale: float = 10.0
    geography_cap: float = 20.0
    geography_scale: float = 10.0
    error_cap: float = 20.0
    error_scale: float = 100.0
    night_cap: float = 10.0
    night_scale: float = 50.0
    diversity_cap: float = 10.0
    diversity_scale: float = 20.0


@dataclass(frozen=True)
class LevelCutoffs:
    """Lowest score of each risk level; below ``low`` the level is very low."""

    high: float = 60.0
    medium: float = 40.0
    low: float = 20.0
