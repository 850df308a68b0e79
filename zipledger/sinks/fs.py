"""Filesystem access for the writers that Spark's own writers do not cover (ZIP
archives, commit markers, small job files): local paths, file://, hdfs:// and
s3:// (s3a:// is mapped to s3://) through ``pyarrow.fs``."""

from __future__ import annotations

import io
import os
import uuid

import pyarrow.fs as pafs


def resolve(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://"):]
    if "://" not in path and not path.startswith("file:"):
        path = os.path.abspath(path)
    elif path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path)


def join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *[p.strip("/") for p in parts if p]])


def makedirs(path: str) -> None:
    fs, p = resolve(path)
    fs.create_dir(p, recursive=True)


def exists(path: str) -> bool:
    fs, p = resolve(path)
    return fs.get_file_info(p).type != pafs.FileType.NotFound


def is_dir(path: str) -> bool:
    fs, p = resolve(path)
    return fs.get_file_info(p).type == pafs.FileType.Directory


def size(path: str) -> int:
    fs, p = resolve(path)
    return fs.get_file_info(p).size


def list_dir(path: str, files: bool = True, dirs: bool = False) -> list[str]:
    """Names directly in a directory ([] if it does not exist)."""
    fs, p = resolve(path)
    if fs.get_file_info(p).type != pafs.FileType.Directory:
        return []
    out = []
    for info in fs.get_file_info(pafs.FileSelector(p, allow_not_found=True)):
        if (files and info.type == pafs.FileType.File) or (dirs and info.type == pafs.FileType.Directory):
            out.append(info.base_name)
    return sorted(out)


def write_text(path: str, text: str) -> None:
    """Write a small file atomically where the store allows it (temp + move)."""
    fs, p = resolve(path)
    parent = p.rsplit("/", 1)[0]
    fs.create_dir(parent, recursive=True)
    tmp = f"{parent}/.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(tmp) as f:
        f.write(text.encode())
    _replace(fs, tmp, p)


def create_exclusive(path: str, text: str) -> bool:
    """Create a small file with all its text in one atomic step, or return False if it exists.

    Of any number of writers exactly one gets True. Needs a store that can refuse a name in use: local and shared
    mounts (hard link), hdfs (rename never replaces a file)."""
    fs, p = resolve(path)
    parent = p.rsplit("/", 1)[0]
    fs.create_dir(parent, recursive=True)
    tmp = f"{parent}/.{uuid.uuid4().hex}.tmp"
    if fs.type_name == "local":
        with open(tmp, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(tmp, p)
            return True
        except FileExistsError:
            return False
        finally:
            os.remove(tmp)
    if fs.type_name != "hdfs":
        raise NotImplementedError(f"no exclusive create on {fs.type_name}: keep the ledger on a mount or hdfs")
    with fs.open_output_stream(tmp) as f:
        f.write(text.encode())
    try:
        fs.move(tmp, p)
        return True
    except OSError:
        if fs.get_file_info(p).type == pafs.FileType.NotFound:
            raise
        fs.delete_file(tmp)
        return False


def read_text(path: str) -> str:
    fs, p = resolve(path)
    with fs.open_input_stream(p) as f:
        return f.read().decode()


def remove(path: str) -> None:
    fs, p = resolve(path)
    try:
        fs.delete_file(p)
    except FileNotFoundError:
        pass


def remove_tree(path: str) -> None:
    fs, p = resolve(path)
    try:
        fs.delete_dir(p)
    except FileNotFoundError:
        pass


class _Input(io.RawIOBase):
    """A store's file as Python's own kind of stream: a seek before its start is an OSError, as ``zipfile`` expects."""

    def __init__(self, file):
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self._file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            return self._file.seek(offset, whence)
        except ValueError as e:
            raise OSError(str(e)) from e

    def tell(self) -> int:
        return self._file.tell()

    def close(self) -> None:
        if not self.closed:
            self._file.close()
        super().close()


def open_input(path: str):
    """A seekable buffered stream."""
    fs, p = resolve(path)
    return io.BufferedReader(_Input(fs.open_input_file(p)), 64 << 10)


def open_output(path: str):
    fs, p = resolve(path)
    return fs.open_output_stream(p)


def copy(src: str, dst: str) -> None:
    fs, s = resolve(src)
    _, d = resolve(dst)
    fs.copy_file(s, d)


def move(src: str, dst: str) -> None:
    fs, s = resolve(src)
    _, d = resolve(dst)
    _replace(fs, s, d)


def move_left(pairs: list[tuple[str, str]]) -> None:
    """Move files into folders that are there; a source that is gone has been moved before. Local files take one call each."""
    for src, dst in pairs:
        if "://" in src or src.startswith("file:") or "://" in dst or dst.startswith("file:"):
            if exists(src):
                move(src, dst)
            continue
        try:
            os.replace(src, dst)
        except FileNotFoundError:
            if os.path.exists(src):
                raise


def _replace(fs: pafs.FileSystem, src: str, dst: str) -> None:
    """Move over what may exist: some stores refuse to rename onto an existing file."""
    try:
        fs.move(src, dst)
    except OSError:
        if fs.get_file_info(src).type == pafs.FileType.NotFound or fs.get_file_info(dst).type == pafs.FileType.NotFound:
            raise
        fs.delete_file(dst)
        fs.move(src, dst)
