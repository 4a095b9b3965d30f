"""Appends that count once a manifest names them.

An append is written under names of its own; then one small file, the manifest, is created under the next number, which only
one writer can get. Readers take what manifests name, in their order: a run that stops before its manifest leaves nothing that
anyone reads, and two writers never share a number. Manifests carry the number of rows of each split, so these need no count.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFESTS = "_commits"
#: A folder's name before what is its own.
APPEND = "append-"
#: Manifests that are read one by one; more are read by a job.
FEW = 40


@dataclass(frozen=True)
class Commit:
    number: int
    folders: Mapping[str, str] = field(default_factory=dict)  # name of a path -> its folder below that path
    rows: Mapping[str, int] = field(default_factory=dict)
    reset: bool = False  # what came before counts no more
    through: Mapping[str, int] = field(default_factory=dict)  # of a snapshot: the last append of each path that it holds
    since: Mapping[str, int] = field(default_factory=dict)  # and the reset of each that it counts from


def file_system(spark: SparkSession, path: str):
    """The path as Hadoop has it, and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, by the file system that Spark would use."""
    p, fs = file_system(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = file_system(spark, path)
    fs.delete(p, True)


def _text(spark: SparkSession, fs, path: str) -> str:
    stream = fs.open(file_system(spark, path)[0])
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def commits(spark: SparkSession, place: str, whole: bool = False) -> list[Commit] | None:
    """What was committed in a folder since its last reset (``whole``: ever), in order; None where nothing ever was. Manifests
    that were not finished count for nothing."""
    folder, fs = file_system(spark, f"{place}/{MANIFESTS}")
    if not fs.exists(folder):
        return None
    names = [n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.endswith(".json")]
    if len(names) > FEW:
        files = spark.read.text(f"{place}/{MANIFESTS}", wholetext=True, pathGlobFilter="*.json").select(F.col("_metadata.file_name").alias("name"), "value")
        said = {r["name"]: r["value"] for r in files.collect()}  # a row for each append since the folder was begun
    else:
        said = {n: _text(spark, fs, f"{place}/{MANIFESTS}/{n}") for n in names}
    found = []
    for name, value in said.items():
        try:
            found.append(Commit(int(name.removesuffix(".json")), **json.loads(value)))
        except (ValueError, TypeError):
            continue
    found.sort(key=lambda c: c.number)
    last = -1 if whole else max((i for i, c in enumerate(found) if c.reset), default=-1)
    return found[last + 1 :]


def commit(spark: SparkSession, place: str, **what) -> int:
    """Write the next manifest; its number. Another writer that takes the number first moves this one up."""
    folder, fs = file_system(spark, f"{place}/{MANIFESTS}")
    fs.mkdirs(folder)
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    number = 1 + max((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), default=0)
    body = json.dumps(what, sort_keys=True).encode()
    while True:
        path, _ = file_system(spark, f"{place}/{MANIFESTS}/{number:012d}.json")
        try:
            out = fs.create(path, False)
        except Py4JJavaError as e:
            if not fs.exists(path):
                raise e
            number += 1
            continue
        try:
            out.write(body)
        finally:
            out.close()
        return number


def _adopt(spark: SparkSession, place: str, paths: list[str]) -> None:
    """Files that were there before any commit become the first one, so that earlier runs' rows go on to count."""
    for path in paths:
        if exists(spark, path):
            own = f"{APPEND}{uuid.uuid4().hex}"
            here, fs = file_system(spark, path)
            aside, _ = file_system(spark, f"{place}/_{own}")
            target, _ = file_system(spark, f"{path}/{own}")
            single = fs.getFileStatus(here).isFile()
            fs.rename(here, aside)
            fs.mkdirs(target if single else target.getParent())
            fs.rename(aside, file_system(spark, f"{path}/{own}/part-00000-0.json")[0] if single else target)
            commit(spark, place, folders={posixpath.basename(path): own}, rows={posixpath.basename(path): spark.read.option("recursiveFileLookup", "true").text(f"{path}/{own}").count()})


def append(rows: DataFrame, paths: Mapping[str, str], split: str) -> dict[str, int]:
    """Add rows to the paths that their ``split`` names, all in one pass and one commit; how many went to each.

    The paths lie in one folder. A split that names no path stops the run before anything counts.
    """
    spark = rows.sparkSession
    (place,) = {posixpath.dirname(p) for p in paths.values()}
    if not exists(spark, f"{place}/{MANIFESTS}"):
        _adopt(spark, place, list(paths.values()))
    own = uuid.uuid4().hex
    staged = f"{place}/_staged-{own}"
    known = F.col(split).isin(*paths) & F.col(split).isNotNull()
    checked = rows.withColumn(split, F.when(F.coalesce(known, F.lit(False)), F.col(split)).otherwise(F.raise_error(F.concat(F.lit("no path for split "), F.coalesce(F.col(split).cast("string"), F.lit("null"))))))
    seen = Observation()
    names = list(paths)
    observed = checked.observe(seen, *[F.count_if(F.col(split) == n).alias(f"n{i}") for i, n in enumerate(names)])
    observed.write.partitionBy(split).json(staged)
    counts = {n: seen.get[f"n{i}"] for i, n in enumerate(names)}
    folders = {}
    for name, path in paths.items():
        if counts[name]:
            source, fs = file_system(spark, f"{staged}/{split}={name}")
            target, _ = file_system(spark, f"{path}/{APPEND}{own}")
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"{source} could not be moved to {target}")
            folders[posixpath.basename(path)] = f"{APPEND}{own}"
    remove(spark, staged)
    if folders:
        commit(spark, place, folders=folders, rows={posixpath.basename(paths[n]): c for n, c in counts.items()})
    return counts


def folders_of(spark: SparkSession, path: str, after: int = 0) -> dict[str, int] | None:
    """Folders below a path and the number of the commit that names each; None where the path is none of this engine's."""
    name, found = posixpath.basename(path), commits(spark, posixpath.dirname(path))
    return None if found is None else {c.folders[name]: c.number for c in found if name in c.folders and c.number > after}


def committed_rows(spark: SparkSession, path: str) -> int | None:
    """Rows of a path by its manifests, without reading it."""
    name, found = posixpath.basename(path), commits(spark, posixpath.dirname(path))
    return None if found is None else sum(c.rows.get(name, 0) for c in found)


def restart(spark: SparkSession, paths: list[str]) -> None:
    """From now on nothing written so far counts; then it goes."""
    for place in sorted({posixpath.dirname(p) for p in paths}):
        old = commits(spark, place) or []
        commit(spark, place, reset=True)
        for c in old:
            for name, folder in c.folders.items():
                remove(spark, f"{place}/{name}/{folder}")
