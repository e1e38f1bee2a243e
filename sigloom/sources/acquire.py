"""Getting one source file to a staging folder, with its checksum and manifest. Driver-side
utilities: one file at a time, streamed in chunks."""

from __future__ import annotations

import hashlib
import http.client
import json
import os
import time
import urllib.parse
import urllib.request
from collections.abc import Mapping
from dataclasses import asdict, dataclass
from datetime import UTC, datetime, timedelta
from pathlib import Path
from typing import BinaryIO

from sigloom.schema import SOURCES

CHUNK = 1 << 20


class AcquisitionError(RuntimeError):
    """A file can't be had as asked."""


@dataclass(frozen=True)
class Acquisition:
    kind: str
    location: str
    target: str
    sha256: str | None = None
    timeout: float = 30.0
    retries: int = 2
    delay: float = 0.0

    def __post_init__(self) -> None:
        if self.kind not in SOURCES:
            raise AcquisitionError(f"unknown source {self.kind!r}")


def file_sha256(path: str | Path) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as file:
        while chunk := file.read(CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def _checked_url(url: str) -> None:
    parts = urllib.parse.urlsplit(url)
    if parts.scheme not in ("http", "https") or not parts.hostname:
        raise AcquisitionError(f"not an HTTP address: {url!r}")


def _opened(job: Acquisition) -> tuple[BinaryIO, int | None]:
    if job.kind == "http":
        _checked_url(job.location)
        answer = urllib.request.urlopen(job.location, timeout=job.timeout)  # noqa: S310
        _checked_url(answer.geturl())
        size = answer.headers.get("Content-Length")
        return answer, int(size) if size else None
    path = Path(job.location)
    if not path.is_file():
        raise AcquisitionError(f"no file {path}")
    if job.kind == "archive":
        import tarfile
        import zipfile

        if not zipfile.is_zipfile(path) and not tarfile.is_tarfile(path):
            raise AcquisitionError(f"no archive: {path}")
    return path.open("rb"), path.stat().st_size


def acquire(job: Acquisition) -> dict[str, object]:
    """Copies the source to a ``.part`` file, checks size and hash, and renames it. What is
    there already is verified and reused, never overwritten; transport errors are tried again."""
    target = Path(job.target)
    if target.exists():
        digest = file_sha256(target)
        if job.sha256 and digest != job.sha256:
            raise AcquisitionError(f"{target} has another checksum")
        return {"status": "reused", "attempts": 0, "sha256": digest, "size": target.stat().st_size}
    part = target.with_name(target.name + ".part")
    target.parent.mkdir(parents=True, exist_ok=True)
    for attempt in range(1, job.retries + 2):
        try:
            digest, size = hashlib.sha256(), 0
            stream, expected = _opened(job)
            with stream, part.open("wb") as out:
                while chunk := stream.read(CHUNK):
                    digest.update(chunk)
                    size += len(chunk)
                    out.write(chunk)
                out.flush()
                os.fsync(out.fileno())
            if expected is not None and expected != size:
                raise AcquisitionError(f"{size} bytes of {expected}")
            if job.sha256 and digest.hexdigest() != job.sha256:
                raise AcquisitionError("checksum differs")
            part.rename(target)
            return {"status": "acquired", "attempts": attempt, "sha256": digest.hexdigest(), "size": size}
        except (OSError, http.client.HTTPException):
            if attempt > job.retries:
                raise
            time.sleep(job.delay)
        finally:
            part.unlink(missing_ok=True)
    raise AssertionError


def utc_time(text: str) -> datetime:
    value = datetime.fromisoformat(text)
    if value.utcoffset() != timedelta(0):
        raise AcquisitionError(f"not a UTC time: {text!r}")
    return value


def register(job: Acquisition, source: Mapping[str, str], licence: Mapping[str, str], manifest: str | Path) -> dict[str, object]:
    """Acquires with a checksum that must be given, and writes or verifies the manifest: file and manifest
    exist both, or neither."""
    if not job.sha256:
        raise AcquisitionError("registration needs an expected checksum")
    path, there = Path(manifest), Path(job.target).exists()
    if path.exists() != there:
        raise AcquisitionError("file and manifest must both exist, or neither")
    got = acquire(job)
    facts = {"schema_version": "1.0", "source": {**source, "access_method": job.kind, "reference": job.location}, "file": {"name": Path(job.target).name, "size_bytes": got["size"], "sha256": got["sha256"]}, "license": dict(licence)}
    if there:
        held = load_manifest(path)
        held.pop("downloaded_at_utc")
        if held != facts:
            raise AcquisitionError("the manifest differs")
        return {**facts, "status": "reused"}
    part = path.with_name(path.name + ".part")
    part.write_text(json.dumps({**facts, "downloaded_at_utc": datetime.now(UTC).isoformat()}, sort_keys=True, indent=1))
    part.rename(path)
    return {**facts, "status": "acquired"}


def load_manifest(path: str | Path) -> dict[str, object]:
    held = json.loads(Path(path).read_text())
    if held.get("schema_version") != "1.0" or not {"source", "file", "license", "downloaded_at_utc"} <= held.keys():
        raise AcquisitionError(f"{path} is no source manifest")
    utc_time(held["downloaded_at_utc"])
    return held


def as_dict(job: Acquisition) -> dict[str, object]:
    return asdict(job)
