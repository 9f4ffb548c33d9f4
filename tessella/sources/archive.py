"""A run's folder as one archive: choice of files, manifest, export, safe import, clean-up."""

from __future__ import annotations

import fnmatch
import io
import json
import os
import shutil
import tarfile
from pathlib import Path, PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "manifest.json"


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Files below a folder as a frame: path below the root, size. Their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    base = Path(root).resolve().as_posix().rstrip("/") + "/"
    inner = F.substring_index(F.col("path"), base, -1)
    return files.select(inner.alias("path"), F.col("length").alias("size"))


def chosen(files: DataFrame, keep: list[str], leave_out: list[str] = ()) -> DataFrame:
    """Files whose path begins with one of `keep` or matches it as a pattern, and none of `leave_out`."""

    def any_of(patterns):
        test = F.lit(False)
        for p in patterns:
            test = test | (F.regexp_like("path", F.lit(fnmatch.translate(p).replace("\\Z", "$").replace("\\z", "$").replace("(?s:", "(?s)(?:"))) if any(c in p for c in "*?[") else F.startswith("path", F.lit(p)))
        return test

    return files.filter(any_of(keep) & ~any_of(leave_out))


def manifest(files: DataFrame) -> DataFrame:
    """One row: number of files, their size, and the list in order of path."""
    return files.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_size"), F.array_sort(F.collect_list(F.struct("path", "size"))).alias("files"))


def archive_name(run_id: str, day: str) -> str:
    """The usual name of an archive."""
    return f"run_{day}_{run_id[:8] or 'unknown'}.tar.gz"


def export_run(root: str, target: str, run_id: str, keep: list[str], leave_out: list[str] = ()) -> dict:
    """Writes chosen files to a tar.gz, the manifest first. Runs on the driver over files of its own file system."""
    base = Path(root)
    names = sorted(p.relative_to(base).as_posix() for p in base.rglob("*") if p.is_file())
    match = lambda n, ps: any(fnmatch.fnmatch(n, p) or n.startswith(p) for p in ps)
    picked = [n for n in names if match(n, keep) and not match(n, leave_out)]
    told = {"run_id": run_id, "n_files": len(picked), "total_size": sum((base / n).stat().st_size for n in picked), "files": [{"path": n, "size": (base / n).stat().st_size} for n in picked]}
    partial = f"{target}.partial"
    with tarfile.open(partial, "w:gz") as tar:
        raw = json.dumps(told, indent=1).encode()
        info = tarfile.TarInfo(MANIFEST)
        info.size = len(raw)
        tar.addfile(info, io.BytesIO(raw))
        for n in picked:
            tar.add(base / n, n, recursive=False)
    os.replace(partial, target)
    return told


def read_manifest(archive: str) -> dict:
    """The manifest of an archive; an error if it has none."""
    with tarfile.open(archive, "r:gz") as tar:
        try:
            return json.load(tar.extractfile(MANIFEST))
        except KeyError as x:
            raise ValueError(f"{archive} has no manifest") from x


def import_run(archive: str, root: str, allowed: list[str], force: bool = False) -> list[str]:
    """Unpacks an archive into an empty folder, or any with `force`. Paths must stay below it and begin as allowed; links are refused."""
    if has_output(root) and not force:
        raise FileExistsError(f"{root} is not empty")
    read_manifest(archive)
    done = []
    with tarfile.open(archive, "r:gz") as tar:
        for member in tar:
            path = PurePosixPath(member.name)
            if member.name == MANIFEST:
                continue
            if path.is_absolute() or ".." in path.parts or not (member.isfile() or member.isdir()) or not any(member.name.startswith(a) for a in allowed):
                raise ValueError(f"refused: {member.name}")
        for member in tar.getmembers():
            if member.isfile() and member.name != MANIFEST:
                tar.extract(member, root, filter="data")
                done.append(member.name)
    return done


def has_output(root: str) -> bool:
    """Whether a folder holds any file."""
    return any(p.is_file() for p in Path(root).rglob("*")) if Path(root).is_dir() else False


def clean_run(root: str, keep: list[str] = (), force: bool = False) -> list[str]:
    """Deletes what is in a folder but for names to keep; without `force` it only says what it would delete."""
    targets = sorted(p for p in Path(root).iterdir() if p.name not in keep) if Path(root).is_dir() else []
    if force:
        for p in targets:
            shutil.rmtree(p) if p.is_dir() else p.unlink()
    return [p.name for p in targets]
