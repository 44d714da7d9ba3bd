"""Outputs that change as a whole.

Every run writes to a folder of its own and then adds one small numbered list
of its files, the edition. Readers take the edition with the highest number, so
they see all outputs of one run: a run that stops half way adds no edition and
changes nothing. Lists are never overwritten: each is written under another
name and renamed, which needs a file system where a rename is one step.

One run at a time may publish to a target; the other way round would only give
both the same number, of which one is refused.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

LISTS, RUNS = "editions", "runs"
_NUMBERED = re.compile(r"(\d{10})\.json")


@dataclass(frozen=True)
class Edition:
    """The outputs of one run: full paths by name, and errors by analysis."""

    number: int
    folder: str
    files: dict[str, str] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def new_folder(out: str) -> str:
    """A place under the target that no other run uses."""
    return f"{out.rstrip('/')}/{RUNS}/{uuid.uuid4().hex}"


def publish_edition(
    spark: SparkSession, out: str, folder: str, files: Mapping[str, str], errors: Mapping[str, str], keep: int
) -> Edition:
    """Make the files of ``folder`` the newest edition, and delete all but the last ``keep`` editions.

    Paths are stored relative to the target, which may be moved as a whole.
    Readers of an edition have until ``keep`` newer ones are published.
    """
    if keep < 1:
        raise ValueError(f"at least one edition must be kept, not {keep}")
    root = out.rstrip("/")
    inside = {name: path.removeprefix(f"{root}/") for name, path in files.items()}
    held = _numbers(spark, root)
    number = max(held, default=0) + 1
    text = json.dumps(
        {"folder": folder.removeprefix(f"{root}/"), "files": inside, "errors": dict(errors)}, sort_keys=True
    )
    _write_once(spark, _list_path(root, number), text)
    for old in sorted(held)[: max(0, len(held) + 1 - keep)]:
        _drop(spark, root, old)
    return _edition(root, number, text)


def current_edition(spark: SparkSession, out: str) -> Edition | None:
    """The newest edition under a target; ``None`` before the first one."""
    root = out.rstrip("/")
    number = max(_numbers(spark, root), default=None)
    return None if number is None else _edition(root, number, _read(spark, _list_path(root, number)))


def _edition(root: str, number: int, text: str) -> Edition:
    found = json.loads(text)
    files = {name: f"{root}/{path}" for name, path in found["files"].items()}
    return Edition(number, f"{root}/{found['folder']}", files, found["errors"])


def _list_path(root: str, number: int) -> str:
    return f"{root}/{LISTS}/{number:010d}.json"


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path in its own form."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def _numbers(spark: SparkSession, root: str) -> list[int]:
    files, place = _place(spark, f"{root}/{LISTS}")
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return [int(found[1]) for found in map(_NUMBERED.fullmatch, names) if found]


def _write_once(spark: SparkSession, path: str, text: str) -> None:
    files, place = _place(spark, path)
    _, draft = _place(spark, f"{path}.{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(place) or not files.rename(draft, place):
        files.delete(draft, False)
        raise FileExistsError(f"another run has published {path}")


def _read(spark: SparkSession, path: str) -> str:
    files, place = _place(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _drop(spark: SparkSession, root: str, number: int) -> None:
    """First the list, so that no reader starts on it, then the files of its run."""
    path = _list_path(root, number)
    folder = _edition(root, number, _read(spark, path)).folder
    files, place = _place(spark, path)
    files.delete(place, False)
    if folder.startswith(f"{root}/{RUNS}/"):
        files.delete(_place(spark, folder)[1], True)
