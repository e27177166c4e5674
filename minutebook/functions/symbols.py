"""Symbols, file names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that define what a symbol, a special security and a bar file are.
SYMBOL_PATTERN = r"^[\p{L}\p{N}./-]{1,15}$"
SPECIAL_PATTERN = r"^[A-Z]+[UWRZ]$"
FRAGMENT_PATTERN = r"^(.+)_(\d{8})\.parquet$"
DAY_FILE_PATTERN = r"^(\d{8})\.parquet$"
DAY_FOLDER_PATTERN = r"(?:^|/)(\d{4})/(\d{2})/(\d{2})/"
EDGE_SPACE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def strip(text: Column) -> Column:
    """Remove any white space (tabs and line ends too) at both ends."""
    return F.regexp_replace(text, EDGE_SPACE, "")


def normalize_symbol(text: Column) -> Column:
    return F.upper(strip(text))


def is_valid_symbol(symbol: Column) -> Column:
    return F.coalesce(symbol.rlike(SYMBOL_PATTERN), F.lit(False))


def is_special(symbol: Column) -> Column:
    """Warrants, units and rights: letters only, ending in U, W, R or Z."""
    return F.coalesce(symbol.rlike(SPECIAL_PATTERN), F.lit(False))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def _capture(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def symbol_of_file(name: Column) -> Column:
    """Text before the last underscore of SYMBOL_YYYYMMDD.parquet, else NULL."""
    return _capture(name, FRAGMENT_PATTERN, 1)


def date_of_file(name: Column) -> Column:
    """Date text of SYMBOL_YYYYMMDD.parquet or YYYYMMDD.parquet, else NULL."""
    return F.coalesce(_capture(name, FRAGMENT_PATTERN, 2), _capture(name, DAY_FILE_PATTERN, 1))


def date_of_path(path: Column) -> Column:
    """Date from an ..._YYYYMMDD file name, else from YYYY/MM/DD folders, else NULL."""
    folders = F.concat(*[F.regexp_extract(path, DAY_FOLDER_PATTERN, i) for i in (1, 2, 3)])
    return F.coalesce(_capture(path, r"_(\d{8})(?:\.[^./]*)?$", 1), F.nullif(folders, F.lit("")))


def fragment_name(symbol: Column, date: Column) -> Column:
    """Relative path YYYY/MM/SYMBOL_YYYYMMDD.parquet of a symbol-day."""
    return F.concat(
        F.substring(date, 1, 4), F.lit("/"), F.substring(date, 5, 2), F.lit("/"),
        symbol, F.lit("_"), date, F.lit(".parquet"),
    )
