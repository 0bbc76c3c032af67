"""Registered queries, grouped by area; oracles live next to each query."""

from __future__ import annotations

from . import q_analytics, q_drift, q_evaluation, q_features, q_monitoring, q_quality, q_scoring, q_streaming, q_training  # noqa: F401
