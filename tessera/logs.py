"""Logging: JSON lines on stderr, plain lines on a terminal; fields of a record go along as keys."""

from __future__ import annotations

import json
import logging
import sys
import time


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        at = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(record.created)) + f".{int(record.msecs):03d}Z"
        row = {"timestamp": at, "level": record.levelname.lower(), "logger": record.name, "event": record.getMessage(), **getattr(record, "fields", {})}
        if record.exc_info:
            row["exception"] = self.formatException(record.exc_info)
        return json.dumps(row, default=str)


def set_up(level: str = "INFO", stream=None) -> None:
    """Sends the records of this library from a level on to a stream; an unknown level counts as INFO."""
    stream = stream or sys.stderr
    handler = logging.StreamHandler(stream)
    handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s") if stream.isatty() else JsonLines())
    own = logging.getLogger("tessera")
    own.handlers[:] = [handler]
    own.setLevel(logging.getLevelNamesMapping().get(level.upper(), logging.INFO))
    own.propagate = False


def event(name: str, what: str, level: int = logging.INFO, **fields) -> None:
    """Logs what happened in a part of the library, with fields."""
    logging.getLogger(f"tessera.{name}").log(level, what, extra={"fields": fields})
