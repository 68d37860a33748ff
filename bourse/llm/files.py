"""Files that tasks write and read themselves, in any shared folder."""

from __future__ import annotations

# Hadoop's names of stores that pyarrow knows by another one.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def opened(uri: str):
    """(file system, path) of a Hadoop or local URI."""
    from pyarrow import fs

    scheme, mark, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}{mark}{rest}" if mark else uri)
