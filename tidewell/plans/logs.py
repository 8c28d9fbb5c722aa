"""Structured logs: one JSON object a line, with approved fields only and without secrets."""

from __future__ import annotations

import json
import logging
from datetime import UTC, datetime
from logging.handlers import RotatingFileHandler

from tidewell.functions.identity import redact

#: Fields that events may have.
FIELDS = frozenset(
    "run_id load_id batch_id stage source_table target_table attempt status duration_ms retry_delay_ms rows_read rows_written rows_rejected rows_deduplicated table_count pipeline_name mode failed_stage error_type snapshot_id source_snapshot_id gold_run_id gold_version adapter operation".split()
)


class JsonLines(logging.Formatter):
    def __init__(self, secrets: tuple[str, ...] = ()):
        super().__init__()
        self.secrets = secrets

    def format(self, record: logging.LogRecord) -> str:
        entry = {"timestamp": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "event": redact(record.getMessage(), self.secrets)}
        fields = getattr(record, "fields", {})
        return json.dumps(entry | {k: redact(v, self.secrets) if isinstance(v, str) else v for k, v in fields.items()}, default=str)


def event(logger: logging.Logger, name: str, level: int = logging.INFO, **fields: object) -> None:
    if extra := sorted(set(fields) - FIELDS):
        raise ValueError(f"fields not approved for logs: {', '.join(extra)}")
    logger.log(level, name, extra={"fields": fields})


def configure(level: str = "INFO", path: str | None = None, secrets: tuple[str, ...] = ()) -> logging.Logger:
    logger = logging.getLogger("tidewell")
    logger.setLevel(level)
    for old in list(logger.handlers):
        logger.removeHandler(old)
        old.close()
    handler = RotatingFileHandler(path, maxBytes=5_000_000, backupCount=3) if path else logging.StreamHandler()
    handler.setFormatter(JsonLines(secrets))
    logger.addHandler(handler)
    return logger
