"""Filesystem access from inside Spark tasks (pyarrow filesystems: local,
s3, gcs, hdfs by URI), so listing and copying work on object stores too."""

from __future__ import annotations

from pyarrow import fs as pafs


def resolve(path: str):
    """``(filesystem, path)`` for a URI or a local absolute path."""
    if "://" in path and not path.startswith("file://"):
        scheme, rest = path.split("://", 1)
        # Hadoop's names of the same stores
        return pafs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3', 'abfss': 'abfs'}.get(scheme, scheme)}://{rest}")
    return pafs.LocalFileSystem(), strip_file_scheme(path)


def strip_file_scheme(path: str) -> str:
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def as_uri(root: str, found: str) -> str:
    """``found``, a path in the filesystem of ``root``, as a URI of the same form:
    stores whose paths begin with the bucket keep the scheme, others (hdfs) the
    authority as well."""
    if "://" not in root or root.startswith("file://"):
        return found
    return (uri_prefix(root) if found.startswith("/") else root.split("://", 1)[0] + "://") + found


def uri_prefix(path: str) -> str:
    """Scheme and authority of ``path`` (empty for local paths)."""
    if "://" in path and not path.startswith("file://"):
        scheme, rest = path.split("://", 1)
        return f"{scheme}://" + (rest.split("/", 1)[0] if "/" in rest else rest)
    return ""
