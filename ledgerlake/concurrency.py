"""Independent jobs submitted side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")


def run_concurrently(tasks: dict[str, Callable[[], T]], workers: int | None = None) -> dict[str, T]:
    """Submit independent write jobs from threads so the scheduler overlaps
    them (one job's tail stages leave executors idle that the others use)."""
    if not tasks:
        return {}
    with ThreadPoolExecutor(max_workers=workers or len(tasks)) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}
