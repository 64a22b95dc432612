"""Verifiers and renderers that users add, by task kind; the verifier and the generator ask for them before their own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Functions of the task column.
VERIFIERS: dict[str, Callable[[Column], Column]] = {}
RENDERERS: dict[str, Callable[[Column], Column]] = {}


def register_verifier(kind: str, expected: Callable[[Column], Column]) -> None:
    """``expected(task)`` is the answer of a kind of tasks."""
    VERIFIERS[kind] = expected


def register_renderer(kind: str, prompt: Callable[[Column], Column]) -> None:
    RENDERERS[kind] = prompt


def _by_kind(functions: dict[str, Callable[[Column], Column]], task: str) -> Column:
    out = F.lit(None).cast("string")
    for kind, f in functions.items():
        out = F.when(F.col(f"{task}.kind") == kind, f(F.col(task))).otherwise(out)
    return out


def registered_reason(task: str = "task", answer: str = "answer") -> Column:
    """unknown_kind, answer or null, by the registered verifiers."""
    known = F.col(f"{task}.kind").isin(*VERIFIERS) if VERIFIERS else F.lit(False)
    return F.when(~F.coalesce(known, F.lit(False)), "unknown_kind").when(~F.col(answer).eqNullSafe(_by_kind(VERIFIERS, task)), "answer")


def rendered(task: str = "task") -> Column:
    """The prompt of a task, by the registered renderers; null for another kind."""
    return _by_kind(RENDERERS, task)


def has_verifier(task: str = "task") -> Column:
    return F.coalesce(F.col(f"{task}.kind").isin(*VERIFIERS), F.lit(False)) if VERIFIERS else F.lit(False)


def expected(task: str = "task") -> Column:
    """The answer of a task, by the registered verifiers; null for another kind."""
    return _by_kind(VERIFIERS, task)
