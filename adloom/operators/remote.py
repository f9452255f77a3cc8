"""Batches of requests to a remote service: each file is uploaded, run, waited for and fetched once, and a state file lets a later run go on where one stopped.

The service is an object with upload(name, data) -> file, create(file) -> batch, status(batch) -> (state, output file or None) and download(file) -> bytes.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.operators.pipeline import first_text

#: States in which a batch stays.
FINAL = ("completed", "failed", "cancelled", "expired")


class Service(Protocol):
    def upload(self, name: str, data: bytes) -> str: ...

    def create(self, file: str) -> str: ...

    def status(self, batch: str) -> tuple[str, str | None]: ...

    def download(self, file: str) -> bytes: ...


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _put(spark: SparkSession, path: str, data: bytes) -> None:
    """Written beside and renamed, so that a broken run leaves no half file."""
    system, place = _open(spark, f"{path}.part")
    out = system.create(place, True)
    out.write(bytearray(data))
    out.close()
    final = _open(spark, path)[1]
    system.delete(final, False)
    system.rename(place, final)


def _get(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def run_batches(spark: SparkSession, service: Service, requests: str, results: str, state: str, pause: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> dict[str, dict]:
    """The state of each file of `requests` once all are final; outputs of completed ones lie in `results`. Files are bounded by how they were written."""
    system, place = _open(spark, requests)
    names = sorted(s.getPath().getName() for s in system.listStatus(place) if s.getPath().getName().startswith("part-"))
    known = json.loads(_get(spark, state)) if _open(spark, state)[0].exists(_open(spark, state)[1]) else {}

    def note(name: str, **what) -> None:
        known[name] = known.get(name, {}) | what
        _put(spark, state, json.dumps(known).encode())

    for name in names:
        if "file" not in known.get(name, {}):
            note(name, file=service.upload(name, _get(spark, f"{requests}/{name}")))
        if "batch" not in known[name]:
            note(name, batch=service.create(known[name]["file"]))
    while True:
        waiting = [n for n in names if known[n].get("status") not in FINAL]
        for name in waiting:
            status, output = service.status(known[name]["batch"])
            note(name, status=status, output=output)
        for name in names:
            if known[name]["status"] == "completed" and known[name]["output"] and not known[name].get("fetched"):
                _put(spark, f"{results}/{name}", service.download(known[name]["output"]))
                note(name, fetched=True)
        if not [n for n in names if known[n]["status"] not in FINAL]:
            return known
        sleep(pause)


def read_results(spark: SparkSession, results: str) -> DataFrame:
    """(custom_id, value, ord) of the answers in fetched files: the first text of each; lines without one are left out. ord grows with file and place."""
    lines = spark.read.text(results).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"))
    body = F.coalesce(F.get_json_object("value", "$.response.body"), F.get_json_object("value", "$.response"))
    x = lines.select(F.get_json_object("value", "$.custom_id").alias("custom_id"), first_text(body).alias("value"), F.struct("file", "line").alias("ord"))
    return x.where("custom_id is not null and value is not null")
