"""Tables that are rewritten while others read them: a new folder each time, and a manifest that says which one counts."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEPT = 2  # versions that stay: the newest, and the one before it for those who read it still
ABANDONED = 24 * 3600  # seconds after which a folder that no manifest names is taken for that of a job that failed


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _read_text(spark: SparkSession, path: str) -> str:
    fs, at = _files(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not be there yet; False when another job was faster."""
    fs, at = _files(spark, path)
    try:
        stream = fs.create(at, False)
    except Exception as e:
        if fs.exists(at):
            return False
        raise e
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def _manifests(spark: SparkSession, root: str, name: str) -> dict[int, dict]:
    """Manifests by number; one that is being written does not count yet."""
    fs, at = _files(spark, f"{root.rstrip('/')}/{name}/_manifests")
    found = {}
    for status in fs.listStatus(at) if fs.exists(at) else []:
        file = status.getPath().getName()
        if file.endswith(".json") and file[:-5].isdigit():
            try:
                found[int(file[:-5])] = json.loads(_read_text(spark, status.getPath().toString()))
            except (ValueError, UnicodeDecodeError):
                continue
    return found


def publish(df: DataFrame, root: str, name: str, kept: int = KEPT) -> dict:
    """Write a table under a new name, then the manifest that makes it the current one; returns the manifest.

    Readers choose by manifest, so they see the table before or the table after, never a part of it.  The manifest has the
    folder, the number of rows and the schema.  Two jobs that publish at once get two numbers; the higher one counts.
    Then versions beyond the ``kept`` newest are deleted, and folders of jobs that failed a day ago.
    """
    spark, home = df.sparkSession, f"{root.rstrip('/')}/{name}"
    folder = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{home}/{folder}")
    written = spark.read.schema(df.schema).parquet(f"{home}/{folder}")
    manifest = {"folder": folder, "rows": written.count(), "schema": json.loads(df.schema.json())}
    number = max(_manifests(spark, root, name), default=0) + 1
    while not _create(spark, f"{home}/_manifests/{number:012d}.json", json.dumps(manifest)):
        number += 1
    _clean(spark, root, name, kept)
    return manifest | {"number": number}


def _clean(spark: SparkSession, root: str, name: str, kept: int) -> None:
    home = f"{root.rstrip('/')}/{name}"
    found = _manifests(spark, root, name)
    stay = sorted(found)[-max(1, kept):]
    named = {found[n]["folder"] for n in stay}
    for n in set(found) - set(stay):
        fs, at = _files(spark, f"{home}/_manifests/{n:012d}.json")
        fs.delete(at, False)  # the manifest first: what none names is nobody's
        if found[n]["folder"] not in named:
            fs.delete(_files(spark, f"{home}/{found[n]['folder']}")[1], True)
    named |= {m["folder"] for m in found.values()}
    fs, at = _files(spark, home)
    for status in fs.listStatus(at):
        file = status.getPath().getName()
        if file.startswith("version-") and file not in named and status.getModificationTime() / 1000 < time.time() - ABANDONED:
            fs.delete(status.getPath(), True)


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current version of a published table, with the schema it was written with."""
    found = _manifests(spark, root, name)
    if not found:
        raise FileNotFoundError(f"no published table {name} in {root}")
    newest = found[max(found)]
    return spark.read.schema(T.StructType.fromJson(newest["schema"])).parquet(f"{root.rstrip('/')}/{name}/{newest['folder']}")
