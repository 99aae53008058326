"""Path expressions: join, basename, relative path, suffix tests, zero padding.

Join rule (fixes the trailing-slash defect of plain concatenation): parts are
joined with exactly one ``/``; empty parts are skipped; a part that starts with
``/`` restarts the path (as ``os.path.join`` does).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_literal(*parts: str) -> str:
    """Join literal path parts with the rule above (driver-side, parameters only)."""
    out = ""
    for p in parts:
        if not p:
            continue
        if p.startswith("/") or not out:
            out = p
        else:
            out = out.rstrip("/") + "/" + p
    return out


def join_path(base: str | Column, name: Column) -> Column:
    """``base / name`` where ``base`` is a literal or a column; absolute ``name`` wins."""
    b = F.lit(base) if isinstance(base, str) else base
    b = F.regexp_replace(b, "/+$", "")
    joined = F.when(b == "", name).otherwise(F.concat(b, F.lit("/"), name))
    return F.when(name.startswith("/"), name).otherwise(joined)


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def relative_to(path: Column, root: str) -> Column:
    """Path relative to ``root`` with leading slashes stripped (``lstrip('/')``)."""
    r = root.rstrip("/")
    return F.regexp_replace(F.substring(path, len(r) + 1, 1 << 30), "^/+", "")


def ends_with_any(path: Column, suffixes: str | Iterable[str]) -> Column:
    if isinstance(suffixes, str):
        suffixes = (suffixes,)
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | path.endswith(s)
    return cond
