"""Files that tasks write and read themselves, in the store that a path names."""

from __future__ import annotations

import io
import json

from pyarrow import fs

MANIFEST = "_manifest.json"


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (local, hdfs, s3, gs) and the path in it."""
    for ours, theirs in (("s3a://", "s3://"), ("s3n://", "s3://"), ("file:/", "/")):
        if path.startswith(ours):
            path = theirs + path.removeprefix(ours).lstrip("/")
    return fs.FileSystem.from_uri(path)


def open_read(store: fs.FileSystem, path: str) -> io.BufferedReader:
    return io.BufferedReader(store.open_input_file(path), 1 << 20)


def listed(path: str, endings: tuple[str, ...]) -> list[dict]:
    """Files of a folder that others wrote, at any depth and in order of name; or the one file."""
    store, where = open_store(path)
    found = store.get_file_info(where)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if found.type == fs.FileType.File:
        return [{"name": "", "bytes": found.size}]
    inside = store.get_file_info(fs.FileSelector(where, recursive=True))
    return [
        {"name": info.path.removeprefix(where).lstrip("/"), "bytes": info.size}
        for info in sorted(inside, key=lambda info: info.path)
        if info.type == fs.FileType.File and info.base_name.lower().endswith(endings)
    ]


def publish(path: str, entries: list[dict]) -> None:
    """List the files of the tasks that succeeded; files of failed or doubled attempts are not in it."""
    store, folder = open_store(path)
    store.create_dir(folder, recursive=True)
    with store.open_output_stream(f"{folder}/{MANIFEST}") as out:
        out.write(json.dumps(entries).encode())


def has_manifest(path: str) -> bool:
    store, folder = open_store(path)
    return store.get_file_info(f"{folder}/{MANIFEST}").type == fs.FileType.File


def published(path: str) -> list[dict]:
    store, folder = open_store(path)
    with store.open_input_stream(f"{folder}/{MANIFEST}") as source:
        return json.loads(source.read())


def discard(path: str, names: list[str]) -> None:
    store, folder = open_store(path)
    for name in names:
        store.delete_file(f"{folder}/{name}")


def binned(entries: list[dict], most_bytes: int) -> list[list[dict]]:
    """Files in their order, in bins of about `most_bytes`, each for one task."""
    bins: list[list[dict]] = []
    room = 0
    for entry in entries:
        if not bins or entry["bytes"] > room:
            bins.append([])
            room = most_bytes
        bins[-1].append(entry)
        room -= entry["bytes"]
    return bins
