"""Registered queries over the shared test tables, each with its SQL twin if it has one."""

from __future__ import annotations

from traceframe.checks.registry import ORACLES, QUERIES


def load() -> tuple[dict, dict]:
    from traceframe.checks import (  # noqa: F401
        drifts,
        files,
        learning,
        metrics,
        profiles,
        retrievals,
        signals,
        streams,
        tables,
        views,
    )

    return dict(QUERIES), dict(ORACLES)
