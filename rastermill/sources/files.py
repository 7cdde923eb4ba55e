"""Byte access to a path or URI on any file system that pyarrow knows and by http, with retries for network errors."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable
from typing import TypeVar
from urllib.parse import unquote
from urllib.request import Request, urlopen

import pyarrow.fs as pafs

T = TypeVar("T")
#: Words of error messages that mark a network error.
NETWORK_WORDS = ("timeout", "timed out", "connection", "network", "temporar", "unreachable", "reset", "503", "502", "504", "curl")


def resolve(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a path or URI; s3a and s3n are Hadoop's names for s3."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(plain_uri(path))


def plain_uri(uri: str) -> str:
    scheme, rest = uri.split("://", 1)
    return f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}"


def file_key(path: str) -> str:
    """The same text for all ways in which Spark, Hadoop and users write the path of one file."""
    path = unquote(path)
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


class HttpFile:
    """A file behind http or https, read by ranges; reads go on where the server does not know ranges."""

    def __init__(self, url: str, timeout: float = 60.0):
        self.url, self.timeout, self.at, self._size, self._whole = url, timeout, 0, None, None

    def _get(self, first: int, last: int | None) -> bytes:
        wanted = f"bytes={first}-{'' if last is None else last}"
        with urlopen(Request(self.url, headers={"Range": wanted}), timeout=self.timeout) as answer:
            data = answer.read()
            if answer.status == 206:
                self._size = int(answer.headers["Content-Range"].rsplit("/", 1)[1])
                return data
        self._whole, self._size = data, len(data)
        return data[first : None if last is None else last + 1]

    def size(self) -> int:
        if self._size is None:
            self._get(0, 0)
        return self._size

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, size: int) -> bytes:
        if size <= 0 or self.at >= self.size():
            return b""
        last = min(self.at + size, self.size()) - 1
        data = self._whole[self.at : last + 1] if self._whole is not None else self._get(self.at, last)
        self.at += len(data)
        return data

    def close(self) -> None:
        self._whole = None

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        self.close()


def open_input(path: str):
    """A seekable file of any URI, http and https included."""
    if path.startswith(("http://", "https://")):
        return HttpFile(path)
    fs, at = resolve(path)
    return fs.open_input_file(at)


def retry(call: Callable[[], T], tries: int = 3, base: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """call(), again after network errors with doubling delays; other errors pass at once."""
    for n in range(1, tries + 1):
        try:
            return call()
        except Exception as error:
            if n == tries or not any(w in str(error).lower() for w in NETWORK_WORDS):
                raise
            sleep(base * 2 ** (n - 1) + 0.1 * n)
    raise AssertionError("unreachable")


def read_bytes(path: str, offset: int = 0, size: int | None = None) -> bytes:
    def get() -> bytes:
        with open_input(path) as f:
            f.seek(offset)
            return f.read(f.size() - offset if size is None else size)

    return retry(get)


def write_bytes(path: str, data: bytes) -> None:
    """Write under a name of this attempt, then rename, so that no reader sees half a file and no two writers share one."""
    fs, at = resolve(path)
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    own = attempt_name(at)
    with fs.open_output_stream(own, compression=None) as f:
        f.write(data)
    fs.move(own, at)


def attempt_name(at: str) -> str:
    """A temporary name beside `at` that no other attempt of a task has; not read as part of a dataset."""
    folder, _, name = at.rpartition("/")
    return f"{folder}/_{name}.{uuid.uuid4().hex}.tmp"


def shared_folder(spark, name: str) -> str:
    """A fresh path that all executors see: below spark.checkpoint.dir, else the warehouse; in plain local mode a temporary folder."""
    named, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not named and master.startswith("local") and not master.startswith("local-cluster"):
        return tempfile.mkdtemp(prefix="rastermill-")
    return f"{(named or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/rastermill/{name}-{uuid.uuid4().hex}"


def list_files(path: str, suffixes: tuple[str, ...]) -> list[str]:
    """The file itself, or the files of a folder with one of the suffixes, in order."""
    fs, at = resolve(path)
    info = fs.get_file_info(at)
    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
    if info.type == pafs.FileType.File:
        return [path]
    found = fs.get_file_info(pafs.FileSelector(at, recursive=True))
    return sorted(prefix + f.path for f in found if f.type == pafs.FileType.File and f.path.lower().endswith(suffixes))
