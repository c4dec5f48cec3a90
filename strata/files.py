"""Files by path on any file system that Arrow knows, for what Spark's own sources do not write."""

from __future__ import annotations

from collections.abc import Iterable

from pyarrow import fs

_BLOCK = 8 << 20


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it.

    As in paths that Spark names, a percent sign stands for itself.
    """
    scheme, colon, rest = path.partition(":")
    if scheme == "file" and colon:
        return fs.LocalFileSystem(), "/" + rest.strip("/")
    if "://" in path:
        place, _, within = rest[2:].partition("/")
        system, base = fs.FileSystem.from_uri(f"{scheme}://{place}/")
        return system, f"{base.rstrip('/')}/{within}".rstrip("/")
    return fs.LocalFileSystem(), path.rstrip("/")


def join_files(parts: Iterable[str], target: str, first: bytes = b"") -> None:
    """Write ``first`` and then the parts, in order, to one file, a block at a time."""
    system, base = file_system(target)
    with system.open_output_stream(base, compression=None) as out:
        out.write(first)
        for part in parts:
            source_system, source = file_system(part)
            with source_system.open_input_stream(source, compression=None) as stream:
                while block := stream.read(_BLOCK):
                    out.write(block)
