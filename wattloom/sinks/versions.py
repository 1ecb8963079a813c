"""Models as version folders behind a mark, so that readers of folders never meet a half-written or missing model.

A version is written to ``<path>/version=<token>``. It becomes the model when an empty file named after it is created in
``<path>/_current``: one operation of the file system, whether it renames or stores objects. The mark with the
greatest name counts. A run that dies at any point before leaves the model as it was; nothing has to be undone.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from wattloom.sinks.folders import Folders
from wattloom.sinks.writers import write_clustered

_MARKS = "_current"
_VERSION = "version="


def _marks(folders: Folders, path: str) -> list[str]:
    """Names of the marks, newest first: a number of fixed width and the version's token."""
    return sorted((n for n in folders.files(f"{path}/{_MARKS}") if n.partition("-")[0].isdigit()), reverse=True)


def _folder(path: str, mark: str) -> str:
    return f"{path}/{_VERSION}{mark.partition('-')[2]}"


def write_model(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (), keep: int = 2) -> str:
    """Write a version and make it the model; returns its folder.

    The newest ``keep`` versions stay, so that a reader who planned on one of them can finish.
    """
    if keep < 1:
        raise ValueError("the current version must be kept")
    path = path.rstrip("/")
    folders, token = Folders(df.sparkSession, path), uuid.uuid4().hex
    folder = write_clustered(df, f"{path}/{_VERSION}{token}", partition_by, cluster_by)
    marks = _marks(folders, path)
    number = int(marks[0].partition("-")[0]) + 1 if marks else 0
    folders.mark(f"{path}/{_MARKS}/{number:020d}-{token}")
    for old in _marks(folders, path)[keep:]:
        # The mark goes first: a mark without its folder would be a model that cannot be read.
        folders.drop(f"{path}/{_MARKS}/{old}")
        folders.drop(_folder(path, old))
    return folder


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder of the current version; ``path`` itself where it has no versions."""
    path = path.rstrip("/")
    marks = _marks(Folders(spark, path), path)
    return _folder(path, marks[0]) if marks else path


def read_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current_folder(spark, path))


def remove_unfinished(spark: SparkSession, path: str) -> list[str]:
    """Remove the folders of versions that never became the model, and return them. No job may be writing the model."""
    path = path.rstrip("/")
    folders = Folders(spark, path)
    marked = {_folder(path, mark) for mark in _marks(folders, path)}
    found = [f"{path}/{name}" for name in folders.names(path) if name.startswith(_VERSION)]
    lost = [folder for folder in found if folder not in marked]
    for folder in lost:
        folders.drop(folder)
    return lost
