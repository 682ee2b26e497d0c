"""Versions of a table: numbered files, each of which names the folders of one state.

A reader takes the newest version and sees that state, whatever a writer does. One
writer at a time: a version that exists is never replaced.
"""

from __future__ import annotations

import json
from collections.abc import Collection
from typing import Any

from pyspark.sql import SparkSession

from paystrata.sources import files

_FOLDER = "_versions"


def listed(spark: SparkSession, path: str) -> list[str]:
    """Version files, oldest first."""
    return files.matching(spark, f"{path.rstrip('/')}/{_FOLDER}/*.json")


def content(spark: SparkSession, version: str) -> dict[str, Any]:
    return json.loads(files.read_text(spark, version))


def publish(spark: SparkSession, path: str, earlier: list[str], state: dict[str, Any]) -> None:
    """Write the version after ``earlier``; of those the newest stays for its readers."""
    number = int(earlier[-1].rsplit("/", 1)[1].removesuffix(".json")) + 1 if earlier else 1
    target = f"{path.rstrip('/')}/{_FOLDER}/{number:012d}.json"
    files.write_text(spark, target, json.dumps(state, indent=0), replace=False)
    for old in earlier[:-1]:
        files.delete(spark, old)


def remove_unnamed(spark: SparkSession, path: str, pattern: str, named: Collection[str]) -> None:
    """Delete what matches ``pattern`` below the table and is not among ``named``:
    replaced earlier, or left behind by a run that died."""
    root = path.rstrip("/")
    depth = pattern.count("/") + 1
    for found in files.matching(spark, f"{root}/{pattern}"):
        if "/".join(found.split("/")[-depth:]) not in named:
            files.delete(spark, found)
