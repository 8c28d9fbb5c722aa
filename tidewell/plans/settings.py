"""Settings from the environment, validated once, and a summary without secrets."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

PREFIX = "TIDEWELL_"
MODES = ("development", "test", "staging", "production")


@dataclass(frozen=True)
class Settings:
    """Defaults are fixed values of the domain (batch and retry limits, timeouts)."""

    environment: str = "development"
    log_level: str = "INFO"
    source_path: str = ""
    source_format: str = "parquet"
    source_url: str = ""
    source_password: str = ""
    warehouse: str = ""
    batch_size: int = 10_000
    bronze_rejected_threshold: int = 0
    silver_rejected_threshold: int = 0
    retry_max_attempts: int = 3
    retry_initial_delay_seconds: float = 1.0
    retry_max_delay_seconds: float = 30.0
    query_timeout_seconds: int = 300
    batch_timeout_seconds: int = 300
    table_timeout_seconds: int = 3_600
    stale_run_timeout_seconds: int = 7_200
    kpi_tolerance: float = 0.02

    def __post_init__(self):
        wrong = []
        if self.environment not in MODES:
            wrong.append(f"environment must be one of {', '.join(MODES)}")
        wrong += [f"{n} must be positive" for n in ("batch_size", "query_timeout_seconds", "batch_timeout_seconds", "table_timeout_seconds", "stale_run_timeout_seconds", "retry_initial_delay_seconds") if getattr(self, n) <= 0]
        wrong += [f"{n} must not be negative" for n in ("bronze_rejected_threshold", "silver_rejected_threshold", "kpi_tolerance") if getattr(self, n) < 0]
        if not 1 <= self.retry_max_attempts <= 3:
            wrong.append("retry_max_attempts must be 1 to 3")
        if self.retry_max_delay_seconds < self.retry_initial_delay_seconds:
            wrong.append("retry_max_delay_seconds must not be less than retry_initial_delay_seconds")
        if self.source_url and self.environment in ("staging", "production") and not self.source_password:
            wrong.append("source_password is needed outside development and test")
        if wrong:
            raise ValueError("; ".join(wrong))

    @classmethod
    def from_environment(cls, environment: Mapping[str, str] = os.environ) -> Settings:
        found = {}
        for f in fields(cls):
            text = environment.get(PREFIX + f.name.upper())
            if text is not None:
                found[f.name] = type(f.default)(text)
        return cls(**found)

    def safe_summary(self) -> dict[str, object]:
        return {f.name: getattr(self, f.name) for f in fields(self) if not f.name.endswith(("password", "url"))}
