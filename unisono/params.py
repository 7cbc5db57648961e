"""Thresholds, in one place. Fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    ngram_min: int = 3
    ngram_max: int = 6
    df_share_max: float = 0.05
    total_uses_min: int = 3
    quorum: int = 3
    concordance_min_statements: int = 10
    concordance_receipts: int = 3
    concordance_peak: int = 15
    unison_window: int = 7
    unison_min_active: int = 20
    unison_top: int = 5
    family_jaccard: float = 0.72
    family_min_tokens: int = 24
    family_shingle: int = 5
    family_hashes: int = 64
    family_bands: int = 32
    family_hours: int = 36
    surge_change: float = 0.03
    surge_ratio: float = 2.0
    surge_q: float = 0.05
    surge_window: int = 28
    surge_alpha: float = 0.5
    nomenclature_ratio: float = 0.80
    silence_high: float = 0.05
    silence_low: float = 0.01
    silence_quiet: int = 2
    silence_loud: int = 5
    silence_min_total: int = 25
    ready_ratio: float = 0.40
    ready_floor: int = 20
    subgram_ratio: float = 1.25


P = Params()
EPOCH = "2024-01-01"
