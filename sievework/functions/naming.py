"""Paths, group names and file names as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def posix_path(path: Column) -> Column:
    """Forward slashes only, no empty or ``.`` segments."""
    slashed = F.regexp_replace(F.translate(path, "\\", "/"), "/+", "/")
    return F.regexp_replace(F.regexp_replace(slashed, r"(^|/)(\./)+", "$1"), r"(?<=.)/(\.)?$", "")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def group_name(path: Column) -> Column:
    """The recording group that a file name tells.

    Of the name without its suffix, what comes before ``.rf.`` and before ``_jpg``, ``_jpeg``, ``_png``;
    then without the last dash part, or else without a last underscore part of digits only.
    """
    name = F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")
    for mark in (".rf.", "_jpg", "_jpeg", "_png"):
        name = F.substring_index(name, mark, 1)
    dashed = F.regexp_replace(name, "-[^-]*$", "")
    return F.when(F.contains(name, F.lit("-")), dashed).otherwise(F.regexp_replace(name, r"_[0-9]+$", ""))


def safe_identifier(name: Column) -> Column:
    return F.regexp_replace(name, "[^A-Za-z0-9_-]+", "_")


def prepared_name(split: Column, image_id: Column, path: Column) -> Column:
    return F.concat_ws("__", split, image_id.cast("string"), base_name(path))


def required_group(group: Column) -> Column:
    """The group; a blank one is an error."""
    return F.when(F.trim(F.coalesce(group, F.lit(""))) == "", F.raise_error(F.lit("a record has no group"))).otherwise(group)


def source_path(root: Column, split: Column, file_name: Column) -> Column:
    """Where a source image lies."""
    return posix_path(F.concat_ws("/", root, split, file_name))


def relative_path(path: Column, root: Column) -> Column:
    """The path below ``root``, or the path itself where it is not below it."""
    under = F.concat(F.regexp_replace(posix_path(root), "/$", ""), F.lit("/"))
    plain = posix_path(path)
    return F.when(F.startswith(plain, under), F.substring(plain, F.length(under) + 1, F.length(plain))).otherwise(plain)


def numbered(n: Column, digits: int = 2) -> Column:
    """A number padded with zeros to a width."""
    return F.format_string(f"%0{digits}d", n)


def merged_class(category: Column, targets: list[str], name: str, other: str = "other") -> Column:
    """The one class that all target categories become, whatever their case and spaces; all else, null too, is ``other``."""
    wanted = [t.strip().upper() for t in targets]
    return F.when(F.upper(F.trim(category)).isin(wanted), name).otherwise(other)
