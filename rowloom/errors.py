"""Errors with stable codes: callers branch on ``code``, people read the text.

The codes raised throughout the package are fixed values and part of its contract.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any


class EngineError(Exception):
    """An error of this package.  ``code`` names the kind, ``context`` holds what was at hand."""

    code = "engine_error"

    def __init__(self, text: str, code: str = "", context: Mapping[str, Any] | None = None) -> None:
        super().__init__(text)
        self.code = code or type(self).code
        self.context: Mapping[str, Any] = context or {}

    def __str__(self) -> str:
        return f"{self.args[0]} ({self.code})"


class DataError(EngineError):
    code = "data_error"


class ModelError(EngineError):
    code = "model_error"


class TrainingError(EngineError):
    code = "training_error"


def require_columns(available: Iterable[str], wanted: Iterable[str], code: str, what: str) -> None:
    """Plan-time column check: no job, names what is missing and what is there."""
    have = list(available)
    missing = [c for c in wanted if c not in have]
    if missing:
        raise DataError(
            f"{what}: missing columns {missing}", code, {"missing": missing, "available": have}
        )
