"""Fixed values of the signal model (sample counts, levels and thresholds of the direct-RNA preset)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Preset:
    stride: int = 15
    head_length: int = 30_000
    head_pooled: int = 2_000
    head_minimum: int = 9_000
    segment_limit: int = 100_000
    # event detection
    window_short: int = 7
    window_long: int = 20
    threshold_short: float = 3.0
    threshold_long: float = 8.0
    peak_height: float = 4.0
    # poly(A)
    polya_level: float = 108.95
    polya_sd: float = 2.55
    polya_band: float = 2.0
    polya_shift: float = 1.7
    polya_penalty: float = 1.5
    polya_gap: int = 110
    polya_stdev: float = 5.0
    polya_anchor_samples: int = 750
    polya_anchor_reach: int = 100
    polya_widen: int = 1_000
    polya_flank: int = 200
    polya_rounds: int = 50
    # fused reads
    chimera_window: float = 8.0
    chimera_step: float = 3.0
    chimera_head: float = 1.0
    chimera_cut_head: tuple[float, float] = (0.6, 0.5)
    chimera_cut: tuple[float, float] = (1.3, 1.0)
    chimera_p: float = 0.4
    chimera_count: int = 30
    chimera_ratio: float = 0.1
    # demultiplexing
    adapter_minimum: int = 260
    adapter_maximum: int = 3_000
    adapter_keep: int = 300
    adapter_filler: float = -1000.0
    decoys: int = 1
    phred_cut: int = 18
    # reads
    minimum_length: int = 10
    scale_quantile: float = 2.053748910631823


PRESET = Preset()
