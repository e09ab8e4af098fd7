"""Commit files of a run's stages: a stage counts as done only once its manifest is written.

A manifest names the settings that the stage depends on, the run of the stage before that it
followed, the rows it wrote and the files it left. It is written last, in one piece, and removed
before a stage starts again; so a stage that broke off, one of other settings, one whose input has
been made anew since, or one whose files are no longer all there, is never taken for finished.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

from vidmart.sources.staging import files_below, read_text, remove, write_text


def _path(out: str, stage: str) -> str:
    return f"{out}/stages/{stage}.json"


def _state(spark: SparkSession, folder: str) -> dict:
    """Number, bytes and digest of the names and sizes of the files below a folder: a few words,
    however many files there are."""
    files = files_below(spark, folder)
    lines = "\n".join(f"{name} {size}" for name, size in sorted(files.items()))
    return {"files": len(files), "bytes": sum(files.values()), "digest": hashlib.sha256(lines.encode()).hexdigest()}


def read(spark: SparkSession, out: str, stage: str) -> dict | None:
    text = read_text(spark, _path(out, stage))
    return None if text is None else json.loads(text)


def begin(spark: SparkSession, out: str, stages: Iterable[str]) -> None:
    """From here on none of these stages counts as done."""
    for stage in stages:
        remove(spark, _path(out, stage))


def commit(
    spark: SparkSession, out: str, stage: str, settings: Mapping[str, str], after: str | None,
    rows: Mapping[str, int], folders: Iterable[str],
) -> str:
    """Write the manifest of a stage whose output is complete; return the token of this run of it."""
    token = uuid.uuid4().hex
    kept = {folder.removeprefix(f"{out}/"): _state(spark, folder) for folder in sorted(folders)}
    body = {"stage": stage, "token": token, "after": after, "settings": dict(settings), "rows": dict(rows), "folders": kept}
    write_text(spark, _path(out, stage), json.dumps(body, indent=1, sort_keys=True))
    return token


def require(
    spark: SparkSession, out: str, stage: str, settings: Mapping[str, str], after: str | None, wanted_by: str
) -> str:
    """The token of a finished stage; an error that says what is wrong if it cannot be built upon."""
    found = read(spark, out, stage)
    if found is None:
        raise FileNotFoundError(f"{wanted_by} needs the stage {stage}, which has not finished in {out}")
    changed = {k: (found["settings"].get(k), v) for k, v in settings.items() if found["settings"].get(k) != v}
    if changed:
        shown = ", ".join(f"{k} was {old}, is {new}" for k, (old, new) in sorted(changed.items()))
        raise ValueError(f"{stage} in {out} was run with other settings: {shown}")
    if found["after"] != after:
        raise ValueError(f"{stage} in {out} is older than what it was made from; run it again")
    for folder, state in found["folders"].items():
        if _state(spark, f"{out}/{folder}") != state:
            raise ValueError(f"{stage} in {out} left other files in {folder} than are there now; run it again")
    return found["token"]
