"""A time limit for a statement: its jobs carry a tag and are cancelled when the time is over."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

from ..schemas import STATEMENT_SECONDS

R = TypeVar("R")


def within(spark: SparkSession, run: Callable[[], R], otherwise: R, seconds: float = STATEMENT_SECONDS) -> R:
    """What run() returns, or `otherwise` if it takes longer: then its jobs, and those that it would still start, are cancelled.

    run() is called in this thread, on this session; other threads' jobs go on. An error that has another cause is raised as it is. The time
    in which no job runs (planning, reading rows) is not cut short, but counts: a result that comes too late is not returned.
    """
    sc, tag, over = spark.sparkContext, f"limit-{uuid.uuid4().hex}", threading.Event()
    done = threading.Event()

    def watch() -> None:
        if done.wait(seconds):
            return
        over.set()
        # Again and again: run() may start another job after the first is cancelled.
        while not done.is_set():
            sc.cancelJobsWithTag(tag)
            done.wait(0.05)

    sc.addJobTag(tag)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        result = run()
        return otherwise if over.is_set() else result
    except Exception:
        if over.is_set():
            return otherwise
        raise
    finally:
        done.set()
        watcher.join()
        sc.removeJobTag(tag)
