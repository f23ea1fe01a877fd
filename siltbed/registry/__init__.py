"""Registered queries and their SQL oracles."""

from __future__ import annotations

from siltbed.registry.base import Registry


def all_registries() -> list[Registry]:
    from siltbed.registry import (
        capture_history,
        corpus_answers,
        events_gold,
        publication,
        streams,
    )

    return [events_gold.R, capture_history.R, publication.R, corpus_answers.R, streams.R]
