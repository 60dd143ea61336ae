"""Fetch landed documents named by a key list."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame

FETCHED = "body binary, last_modified_at timestamp, fetch_error string"


def _open(path: str, systems: dict[str, fs.FileSystem]) -> tuple[fs.FileSystem, str]:
    """File system and key of a path; one client per store, not per document."""
    if "://" not in path:
        path = f"file://{path.removeprefix('file:')}"
    store = path.split("/", 3)[2]
    if not store:
        return systems.setdefault("local", fs.LocalFileSystem()), path.removeprefix("file://")
    prefix = path[: path.index(store) + len(store)]
    if prefix not in systems:
        systems[prefix] = fs.FileSystem.from_uri(prefix + "/")[0]
    return systems[prefix], path.split("://", 1)[1]


def _fetch(
    path: str, systems: dict[str, fs.FileSystem]
) -> tuple[bytes | None, datetime | None, str | None]:
    try:
        system, key = _open(path, systems)
        modified = system.get_file_info(key).mtime
        with system.open_input_stream(key) as stream:
            body = stream.read()
    except OSError as error:
        return None, None, str(error)
    if modified is not None and modified.tzinfo is None:
        modified = modified.replace(tzinfo=timezone.utc)
    return body, modified, None


def fetch_documents(keys: DataFrame, path_column: str, tasks: int = 0) -> DataFrame:
    """Add `body`, `last_modified_at` and `fetch_error` to each key row.

    Only listed documents are opened; a folder scan would read every document to
    keep a few. The keys are spread over `tasks` tasks (by default the shuffle
    partitions), since a short key list would otherwise end up in one. A
    document that cannot be read is reported in its row.
    """
    columns = keys.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        systems: dict[str, fs.FileSystem] = {}
        for batch in batches:
            # A few documents at a time, so a batch never holds many bodies.
            for start in range(0, len(batch), 16):
                part = batch.iloc[start : start + 16].reset_index(drop=True)
                found = [_fetch(p, systems) for p in part[path_column]]
                part["body"] = [f[0] for f in found]
                part["last_modified_at"] = pd.to_datetime([f[1] for f in found], utc=True)
                part["fetch_error"] = [f[2] for f in found]
                yield part

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields)
    tasks = tasks or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = keys.repartition(tasks, path_column)
    return spread.select(*columns).mapInPandas(run, f"{fields}, {FETCHED}")
