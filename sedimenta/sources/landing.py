"""Landing of source files on a local disk: size limits, running digests, atomic moves and manifests.

Downloads themselves are left to the caller, who passes an open stream and the headers' length.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import time
from collections.abc import Callable, Iterable, Mapping
from datetime import UTC, datetime
from pathlib import Path
from typing import BinaryIO


class LandingError(RuntimeError):
    """A file can't be landed."""


def require_room(folder: str | Path, length: int | None, least_free: int, free: Callable[[str], int] | None = None) -> None:
    """Raises LandingError unless the disk keeps `least_free` bytes and has room for the file beyond them."""
    have = (free or (lambda p: shutil.disk_usage(p).free))(str(folder))
    if have < least_free + (length or 0):
        raise LandingError("too little room on the disk")


def land(stream: BinaryIO, target: str | Path, expected_length: int | None = None, most: int | None = None, chunk: int = 1 << 20) -> dict:
    """Copy a stream to a file that appears only when it is whole; returns bytes and sha256.

    Raises LandingError for empty, overlong, short and HTML content and if the target exists.
    """
    target = Path(target)
    if target.exists():
        raise LandingError("the target exists")
    target.parent.mkdir(parents=True, exist_ok=True)
    part, digest, size, head = target.with_name(f".{target.name}.{os.getpid()}.part"), hashlib.sha256(), 0, b""
    try:
        with open(part, "wb") as out:
            while data := stream.read(chunk):
                if len(head) < 512:
                    head += data[:512]
                size += len(data)
                if most is not None and size > most:
                    raise LandingError("the content is too long")
                digest.update(data)
                out.write(data)
            out.flush()
            os.fsync(out.fileno())
        if not size:
            raise LandingError("the content is empty")
        if expected_length is not None and size != expected_length:
            raise LandingError("the content has another length than announced")
        if head.lstrip().lower().startswith((b"<!doctype html", b"<html")):
            raise LandingError("the content is an HTML page")
        os.replace(part, target)
    finally:
        part.unlink(missing_ok=True)
    return {"bytes": size, "sha256": digest.hexdigest()}


def with_retries[T](action: Callable[[int], T], attempts: int = 5, longest_wait: float = 4.0, sleep: Callable[[float], None] = time.sleep, retry_on: tuple[type[Exception], ...] = (OSError,)) -> T:
    """action(attempt), tried again with waits that double up to `longest_wait`."""
    for n in range(1, attempts + 1):
        try:
            return action(n)
        except retry_on:
            if n == attempts:
                raise
            sleep(min(longest_wait, 0.5 * 2 ** (n - 1)))
    raise LandingError("no attempt was made")


def retrieval_manifest(source_key: str, path: str | Path, root: str | Path, landed: Mapping, now: datetime | None = None) -> dict:
    """Lineage of a landed file."""
    at = now or datetime.now(UTC)
    return {"manifest_version": 1, "source_key": source_key, "request": {"completed": {"utc": at.astimezone(UTC).isoformat()}}, "artifact": {"relative_path": Path(path).resolve().relative_to(Path(root).resolve()).as_posix(), **landed}}


def run_resumable(tasks: Iterable[Mapping], done: Callable[[Mapping], bool], act: Callable[[Mapping], None], execute: bool = False, most: int | None = None, pause: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Work through tasks that aren't done, up to a number, with pauses; without `execute` only count them."""
    counts = {"planned": 0, "skipped": 0, "made": 0, "left": 0, "executed": execute}
    for task in tasks:
        counts["planned"] += 1
        if done(task):
            counts["skipped"] += 1
        elif not execute or (most is not None and counts["made"] >= most):
            counts["left"] += 1
        else:
            if counts["made"] and pause:
                sleep(pause)
            act(task)
            counts["made"] += 1
    return counts


def save_json(value: object, path: str | Path) -> None:
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n", encoding="utf-8")
