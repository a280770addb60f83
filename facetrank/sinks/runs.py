"""Outputs that grow run by run, with one commit for all parts of a run.

A run writes its parts below ``root/run/<id>/``; a small entry in ``root/committed``
makes all of them valid at once. Readers take the listed runs only, so a run that
died between two outputs is not seen, and when it is given again it starts over. A
run that has been committed is not written again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import SparkSession

from facetrank.sinks.tables import hadoop_path

_ENTRIES = "committed"


def run_path(root: str, run: str, part: str) -> str:
    """Where a run keeps one of its parts."""
    return f"{root.rstrip('/')}/run/{run}/{part}"


def committed_runs(spark: SparkSession, root: str) -> list[str]:
    """The ids of the runs that are complete, sorted."""
    folder, files = hadoop_path(spark, f"{root.rstrip('/')}/{_ENTRIES}")
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder))


def commit_run(spark: SparkSession, root: str, run: str) -> None:
    """Make a run's parts valid; committing it again changes nothing."""
    entry, files = hadoop_path(spark, f"{root.rstrip('/')}/{_ENTRIES}/{run}")
    if not files.exists(entry):
        files.create(entry, False).close()


def part_paths(spark: SparkSession, root: str, part: str) -> list[str]:
    """Folders of a part, of all complete runs that have it."""
    paths = []
    for run in committed_runs(spark, root):
        folder, files = hadoop_path(spark, run_path(root, run, part))
        if files.exists(folder):
            paths.append(run_path(root, run, part))
    return paths


def input_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """A name for input files as they are now: by path, length and time of change."""
    found = []
    for path in paths:
        folder, files = hadoop_path(spark, path)
        below = files.listFiles(folder, True)
        while below.hasNext():
            status = below.next()
            found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]

