"""Report files with different headers under one path.

The header of every file is looked at once (the footer of a Parquet file, the first line of a text
file). Files whose headers come to the same columns share one scan with a declared schema, so a folder
costs as many scans as it has layouts, however many files it holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dwellspark.sources.reports import REQUIRED, find_column, normalize_reports, project_required, read_files

#: Headers that are looked at side by side.
LOOKERS = 16
#: Formats whose columns are found by their place in the line, not by name.
BY_PLACE = ("csv",)
#: Where a line that does not fit its header is kept as it is.
CORRUPT = "_corrupt_record"

Headers = Mapping[str, str | Sequence[str]]


@dataclass(frozen=True)
class Layout:
    """Files of one scan, the columns it reads, and the header of every canonical column."""

    paths: tuple[str, ...]
    schema: T.StructType
    columns: dict[str, str]


def files_under(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> list[str]:
    """Paths of all files, also in folders below; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.load([paths] if isinstance(paths, str) else list(paths)).select("path").collect()
    return sorted(r["path"] for r in found)


def _found(names: Sequence[str], headers: Headers) -> dict[str, str]:
    """The header of every canonical column that the file has; the first spelling that fits counts."""
    out = {}
    for key, wanted in headers.items():
        spellings = [wanted] if isinstance(wanted, str) else wanted
        hits = (find_column(names, s) for s in spellings)
        header = next((h for h in hits if h is not None), None)
        if header is not None:
            out[key] = header
    return out


def layouts(
    spark: SparkSession,
    files: Sequence[str],
    headers: Headers,
    fmt: str = "parquet",
    required: Sequence[str] = REQUIRED,
    **options,
) -> list[Layout]:
    """Layouts of the files. A file without a required column fails here, before its rows are read.

    `headers` gives for a canonical column its header, or several in the order in which they are tried.
    """
    with ThreadPoolExecutor(LOOKERS) as pool:
        schemas = list(pool.map(lambda f: spark.read.format(fmt).options(**options).load(f).schema, files))
    groups: dict[tuple, tuple[list[str], T.StructType, dict[str, str]]] = {}
    missing = []
    for path, schema in zip(files, schemas, strict=True):
        columns = _found(schema.names, headers)
        lost = [key for key in required if key not in columns]
        if lost:
            missing.append(f"{path}: {', '.join(lost)}")
            continue
        if fmt in BY_PLACE:
            read = schema
        else:
            read = T.StructType([f for f in schema.fields if f.name in set(columns.values())])
        # The order of the columns matters only where they are found by place.
        names = [(f.name, f.dataType.simpleString()) for f in read.fields]
        key = tuple(names if fmt in BY_PLACE else sorted(names)), tuple(sorted(columns.items()))
        groups.setdefault(key, ([], read, columns))[0].append(path)
    if missing:
        raise ValueError("missing columns in " + "; ".join(missing))
    return [Layout(tuple(paths), schema, columns) for paths, schema, columns in groups.values()]


def load_folder(
    spark: SparkSession,
    paths: str | Sequence[str],
    headers: Headers,
    fmt: str = "parquet",
    required: Sequence[str] = REQUIRED,
    pattern: str | None = None,
    keep_corrupt: bool = False,
    normalise=normalize_reports,
    **options,
) -> DataFrame:
    """All rows of all files under the paths as one table of canonical columns.

    Every layout is normalised with its own types before they are put together, so a date column and
    a text column of dates meet as dates. A column that a file does not have is null. With
    `keep_corrupt` a text line that does not fit its header stays as it is in CORRUPT.
    """
    if fmt in BY_PLACE:
        options = {"header": True, "enforceSchema": True, **options}
    found = layouts(spark, files_under(spark, paths, pattern), headers, fmt, required, **options)
    if not found:
        raise FileNotFoundError(f"no files under {paths}")
    parts = []
    for layout in found:
        schema, own = layout.schema, ["source_file", "seq"]
        if keep_corrupt:
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
            options = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
            own.append(CORRUPT)
        rows = read_files(spark, layout.paths, fmt, schema, **options)
        parts.append(normalise(project_required(rows, layout.columns, required, own)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
