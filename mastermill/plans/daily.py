"""The day's run of an entity: the matching files of a region as one extract and one commit."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import has_columns
from ..sources.files import discover_files, read_extract
from ..sources.tables import SnapshotStore
from ..spec import EntitySpec, GateRule
from .audit import EMPTY, FAILED, SKIPPED, RunRecord, append_audit
from .entity import AUDIT, ORIGIN, RunOptions, conform_extract, run_conformed

HEADER_THREADS = 8


@dataclass(frozen=True)
class ExtractFile:
    """A file to load; ``accepted`` says whether it is an extract at all."""

    path: str
    name: str
    file_date: date | None = None
    accepted: bool = True


def run_day(
    store: SnapshotStore,
    spec: EntitySpec,
    root: str,
    day: date,
    options: RunOptions | None = None,
    dimensions: Mapping[str, DataFrame] | None = None,
    fail_fast: bool = False,
) -> list[RunRecord]:
    """Load the files in ``<root>/<region>`` that carry the entity's prefix and the day, by :func:`run_files`.

    A region whose directory cannot be listed is audited and the next one is tried, unless ``fail_fast``. Running the day again skips
    the files already loaded.
    """
    options, records = options or RunOptions(), []
    for region, prefix in spec.files.items():
        try:
            found = discover_files(store.spark, root, {region: prefix}, day).orderBy("file_name").collect()
        except AnalysisException as error:
            records.append(RunRecord(spec.name, region=region).close(FAILED, str(error)))
            append_audit(store.spark, records[-1], f"{store.root}/{AUDIT}")
            if fail_fast:
                raise
            continue
        files = [ExtractFile(f["path"], f["file_name"], f["file_date"] or day, f["accepted"]) for f in found]
        records += run_files(store, spec, files, region, options, dimensions, fail_fast)
    return records


def run_files(
    store: SnapshotStore,
    spec: EntitySpec,
    files: Sequence[ExtractFile],
    region: str,
    options: RunOptions | None = None,
    dimensions: Mapping[str, DataFrame] | None = None,
    fail_fast: bool = False,
) -> list[RunRecord]:
    """Load files of one region as one extract: one scan for each header, one commit, one audit row for each file, in the order of their names.

    Of rows with one key the file that comes last by name wins, and its record counts the insert or update. A file of another type, one
    that cannot be opened, and one whose header lacks a key column is audited as failed and left out; the others are loaded all the same, unless
    ``fail_fast``. A file is known by region and name: those published before are skipped, and so is a file that changed nothing.

    Files are loaded apart, as a commit for each sort, where the result depends on it: when some lack the columns that guard a gate, when a gate
    needs their dates, and by header when fingerprints follow the order of columns.
    """
    options = options or RunOptions()
    spark, records, problem = store.spark, {}, None
    files = sorted(files, key=lambda f: f.name)
    known = store.known_runs([f"{region}/{f.name}" for f in files]) if files else set()

    def header(file: ExtractFile):
        try:
            if not file.accepted:
                raise ValueError(f"unsupported file type: {file.name}")
            return tuple(read_extract(spark, file.path).columns)
        except Exception as error:
            return error

    wanted = [f for f in files if f"{region}/{f.name}" not in known]
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        headers = dict(zip([f.name for f in wanted], pool.map(header, wanted)))
    sorts: dict[tuple, dict[tuple, list[ExtractFile]]] = {}
    for file in files:
        record = records[file.name] = RunRecord(spec.name, file.name, region)
        columns = headers.get(file.name)
        if columns is None:
            record.close(SKIPPED, "run was published before")
        elif columns == ():
            record.close(EMPTY, "extract has no rows")
        else:
            try:
                if isinstance(columns, Exception):
                    raise columns
                conformed = conform_extract(spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns)), spec, region)
            except Exception as error:
                record.close(FAILED, str(error))
                problem = problem or error
                continue
            gates = [has_columns(conformed, rule.guard) for rule in spec.rules if isinstance(rule, GateRule)]
            sort = (*gates, file.file_date if any(gates) else None, columns if options.legacy_fingerprint else None)
            sorts.setdefault(sort, {}).setdefault(columns, []).append(file)
    append_audit(spark, [r for r in records.values() if r.status], f"{store.root}/{AUDIT}")
    if problem and fail_fast:
        raise problem
    for groups in sorts.values():
        members = [f for group in groups.values() for f in group]
        run = replace(options, region=region, file_date=members[0].file_date)
        its = [records[f.name] for f in members]
        try:
            run_conformed(store, spec, lambda g=groups: _read(spark, g, spec, region), its, [f"{region}/{f.name}" for f in members], run, dimensions)
        except Exception:
            if fail_fast:
                raise
    return [records[f.name] for f in files]


def _read(spark, groups: Mapping[tuple, Sequence[ExtractFile]], spec: EntitySpec, region: str) -> DataFrame:
    """The rows of all files, one scan for each header, with the name of their file."""
    frames = []
    for group in groups.values():
        rows = read_extract(spark, [f.path for f in group])
        rows = rows.select("*", F.col("_metadata.file_name").alias(ORIGIN))
        frames.append(conform_extract(rows, spec, region))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
