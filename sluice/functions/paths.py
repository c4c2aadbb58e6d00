"""Column functions over landing-file paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: layout of a landing drop's date directories, year=YYYY/month=M[M]/day=D[D].
DATE_DIR_PATTERN = r"/year=(\d{4})/month=(\d{1,2})/day=(\d{1,2})(/|$)"


def path_year(path: Column) -> Column:
    return F.when(path.rlike(DATE_DIR_PATTERN), F.regexp_extract(path, DATE_DIR_PATTERN, 1).cast("int"))


def path_month(path: Column) -> Column:
    return F.when(path.rlike(DATE_DIR_PATTERN), F.regexp_extract(path, DATE_DIR_PATTERN, 2).cast("int"))


def path_day(path: Column) -> Column:
    return F.when(path.rlike(DATE_DIR_PATTERN), F.regexp_extract(path, DATE_DIR_PATTERN, 3).cast("int"))


def path_date_key(path: Column) -> Column:
    """``yyyymmdd`` as an int from the path's date directories; NULL when the path has none."""
    return path_year(path) * 10000 + path_month(path) * 100 + path_day(path)


def date_key(start) -> int | None:
    """``date``/``datetime``, ``(y, m, d)``, ``'YYYY-MM-DD'`` or an int ``yyyymmdd`` → int."""
    if start is None:
        return None
    if isinstance(start, int):
        return start
    if isinstance(start, str):
        y, m, d = (int(x) for x in start.split("-"))
        return y * 10000 + m * 100 + d
    if isinstance(start, (tuple, list)):
        y, m, d = start
        return int(y) * 10000 + int(m) * 100 + int(d)
    return start.year * 10000 + start.month * 100 + start.day


def _java_regex_literal(text: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in text)


def quarantine_path(path: Column, object_name: str, suffix: str = "_corrupted") -> Column:
    """``path`` with its first ``/object=<name>/`` directory renamed to ``/object=<name><suffix>/``."""
    needle = _java_regex_literal(f"/object={object_name}/")
    replacement = f"/object={object_name}{suffix}/".replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(path, F.lit(f"^(.*?){needle}"), F.lit("$1" + replacement))


def parent_dir(path: str) -> str:
    return path.rsplit("/", 1)[0]


def glob_for(fmt: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9]+", fmt):
        raise ValueError(f"unsupported format name {fmt!r}")
    return f"*.{fmt}"
