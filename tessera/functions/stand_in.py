"""Deterministic stand-ins for caller-supplied per-value functions, used by the
registered queries and tests (kept apart from the query registry so that
Python workers unpickling them import nothing else)."""

from __future__ import annotations


def mark_translation(value: str) -> str:
    """Stand-in for the translation call: values holding a 'z' fail (to
    exercise the fail-safe path); others get a marker unless their length is
    a multiple of three (left 'untranslated')."""
    if "z" in value:
        raise ValueError("service error")
    return "en:" + value if len(value) % 3 else value


def rerun_translation(value: str) -> str:
    return "v2:" + value
