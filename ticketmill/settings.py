"""Parameters of a curation run, checked when they are set; the registered queries run with the defaults."""

from __future__ import annotations

from dataclasses import dataclass

from .operators.gates import MIN_WORDS, TIMEOUT_SECONDS
from .operators.sequence import EMA_ALPHA, MAX_ATTEMPTS, STOP_AT, WARN_AT


@dataclass(frozen=True)
class Settings:
    min_word_count: int = MIN_WORDS
    ticket_timeout_seconds: float = TIMEOUT_SECONDS
    ema_alpha: float = EMA_ALPHA
    bad_ratio_warning: float = WARN_AT
    bad_ratio_stop: float = STOP_AT
    max_attempts: int = MAX_ATTEMPTS

    def __post_init__(self) -> None:
        if self.min_word_count < 0:
            raise ValueError("min_word_count must not be negative")
        for name in ("ema_alpha", "bad_ratio_warning", "bad_ratio_stop"):
            if not 0.0 < getattr(self, name) <= 1.0:
                raise ValueError(f"{name} must be in (0, 1]")
        if self.bad_ratio_warning > self.bad_ratio_stop:
            raise ValueError("bad_ratio_warning must not exceed bad_ratio_stop")
        for name in ("ticket_timeout_seconds", "max_attempts"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
