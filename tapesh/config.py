"""Every threshold of the two pipelines, with its usual value."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class EngineConfig:
    # source
    platform: str = "telegram"
    text_col: str | None = None
    date_col: str | None = None
    source_name: str = ""
    # detection
    similarity: float = 0.55
    block_rows: int = 2048
    merge_similarity: float = 0.75
    coverage_similarity: float = 0.75
    min_peak: int = 3
    spike_z: float = 2.2
    spike_flag_z: float = 2.0
    spike_flag_share: float = 0.20
    cohesive_ratio: float = 5.0
    cohesive_median: float = 0.75
    cohesive_coverage: float = 0.55
    min_ratio: float = 0.7
    top_messages: int = 35
    top_keywords: int = 10
    min_term_count: int = 2
    sample_messages: int = 10
    # prediction
    chunk_words: int = 200
    medoid_noise: float = 0.50
    medoid_duplicate: float = 0.98
    medoid_merge: float = 0.75
    verify_above: int = 20
    verify_sample: int = 15
    verifier_sample: int = 10
    seed: int = 42
    # verifier
    token_caps: tuple[int, ...] = (400, 300, 200, 150)
    oom_caps: tuple[int, ...] = (300, 250, 200, 150)
    max_attempts: int = 5
    abort_after: int = 5
    max_input_tokens: int = 5000
    skip_verification: bool = False

    @property
    def is_twitter(self) -> bool:
        return self.platform.strip().lower() in ("x", "twitter")

    @property
    def text(self) -> str:
        return self.text_col or "txtContent"

    @property
    def date(self) -> str:
        return self.date_col or ("shdate" if self.is_twitter else "date")

    def but(self, **changes) -> EngineConfig:
        return replace(self, **changes)
