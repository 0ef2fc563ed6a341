"""Path columns: file name, stem, suffix, relative path, category."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def suffix(path: Column) -> Column:
    """Last extension with its dot; names such as ``.profile`` have none."""
    return F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)


def stem(path: Column) -> Column:
    name = file_name(path)
    return F.left(name, F.length(name) - F.length(suffix(path)))


def relative_path(path: Column, root: Column) -> Column:
    base = F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))
    return F.when(F.startswith(path, base), F.substr(path, F.length(base) + 1)).otherwise(path)


def category(relative: Column) -> Column:
    """Parent folder of a relative path, ``.`` at the root."""
    parent = F.regexp_extract(relative, r"^(.*)/[^/]*$", 1)
    return F.when(parent == "", ".").otherwise(parent)
