"""Outputs of a job that belong together, published all at once or not at all.

Below the job's folder::

    runs/<run>/<name>        what a run wrote; never changed once it is written
    published/<number>.json  a manifest: the run and the path of each of its outputs

A run writes to a folder of its own. When everything is there, its manifest is renamed
into ``published/`` under the next number: that one rename is the publication, and the
highest number is what readers see. A run that fails on the way leaves the published
outputs as they were. A stage made from the same inputs with the same parameters is
taken over from an earlier run, published or not, by naming its path. A stage in parts
(one for each group of input files) takes over the parts whose files are the same and
makes the others only; its path is then a list of folders.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from propyield.sources import fs


#: The column that names a row's part while a stage in parts is written.
PART = "stage_part"


class Run:
    """One run of a job below ``out_dir``; safe to use from several threads."""

    def __init__(self, spark: SparkSession, out_dir: str, force: bool = False):
        self.spark, self.out, self.force = spark, out_dir.rstrip("/"), force
        now = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        self.id = f"{now}-{uuid.uuid4().hex[:8]}"
        self.folder = f"{self.out}/runs/{self.id}"
        self.outputs: dict[str, str | list[str]] = {}
        self._lock = threading.Lock()

    def path(self, name: str) -> str:
        """Where this run writes ``name``; it is published when the run is."""
        with self._lock:
            self.outputs[name] = f"runs/{self.id}/{name}"
        return f"{self.folder}/{name}"

    def stage(self, name: str, build: Callable[[], DataFrame], key: str) -> DataFrame:
        """The parquet table ``name`` made for ``key`` (a digest of inputs and parameters).

        A marker that names the key is written last, so a half-written table is never
        taken for a complete one.
        """
        made = [] if self.force else fs.glob(self.spark, f"{fs.escaped(self.out)}/runs/*/{name}/_made-for-{key}")
        if made:
            run = made[-1].rsplit("/", 3)[-3]
            with self._lock:
                self.outputs[name] = f"runs/{run}/{name}"
        else:
            path = self.path(name)
            build().write.parquet(path)
            fs.touch(self.spark, f"{path}/_made-for-{key}")
        return self.spark.read.parquet(f"{self.out}/{self.outputs[name]}")

    def parts(self, name: str, keys: Mapping[str, str], build: Callable[[list[str]], DataFrame]) -> DataFrame:
        """The parquet table ``name`` in parts, each made for its key.

        ``build(parts)`` gives the rows of the named parts, their part in the column ``PART``
        (not kept). It is called once, for the parts that no run has made for their key. Parts
        are short names of letters and digits.
        """
        made: dict[tuple[str, str], str] = {}
        if not self.force:
            for marker in fs.glob(self.spark, f"{fs.escaped(self.out)}/runs/*/{name}/{PART}=*/_made-for-*"):
                run, _, part, key = marker.rsplit("/", 4)[1:]
                made[part.partition("=")[2], key.removeprefix("_made-for-")] = f"runs/{run}/{name}/{part}"
        missing = sorted(p for p, key in keys.items() if (p, key) not in made)
        if missing:
            path = f"{self.folder}/{name}"
            build(missing).write.partitionBy(PART).parquet(path)
            for p in missing:  # also of a part without rows
                fs.touch(self.spark, f"{path}/{PART}={p}/_made-for-{keys[p]}")
                made[p, keys[p]] = f"runs/{self.id}/{name}/{PART}={p}"
        with self._lock:
            self.outputs[name] = [made[p, key] for p, key in sorted(keys.items())]
        return self.spark.read.parquet(*[f"{self.out}/{p}" for p in self.outputs[name]])

    def publish(self) -> int:
        """Make this run's outputs the published ones; returns the publication's number."""
        draft = f"{self.folder}/_manifest.json"
        fs.write_text(self.spark, draft, json.dumps({"run": self.id, "outputs": self.outputs}, indent=1, sort_keys=True))
        fs.make_folder(self.spark, f"{self.out}/published")
        number = (_numbers(self.spark, self.out) or [0])[-1] + 1
        while True:
            target = _manifest(self.out, number)
            if not fs.exists(self.spark, target):
                try:
                    fs.rename(self.spark, draft, target)
                    return number
                except OSError:
                    if not fs.exists(self.spark, target):
                        raise
            number += 1  # another run was published meanwhile


def _manifest(out: str, number: int) -> str:
    return f"{out}/published/{number:010d}.json"


def _numbers(spark: SparkSession, out: str) -> list[int]:
    found = fs.glob(spark, f"{fs.escaped(out)}/published/*.json")
    return sorted(int(f.rsplit("/", 1)[1][:-5]) for f in found)


def _read(spark: SparkSession, out: str, number: int) -> dict:
    return json.loads(fs.read_text(spark, _manifest(out, number)))


def published(spark: SparkSession, out_dir: str, number: int | None = None) -> dict[str, str | list[str]]:
    """Name and path (or paths of its parts) of every output of the last publication (or of
    ``number``).

    Empty when nothing was published yet.
    """
    out = out_dir.rstrip("/")
    numbers = _numbers(spark, out)
    if not numbers or number is not None and number not in numbers:
        return {}
    said = _read(spark, out, numbers[-1] if number is None else number)
    return {name: [f"{out}/{p}" for p in path] if isinstance(path, list) else f"{out}/{path}"
            for name, path in said["outputs"].items()}


def drop_old_runs(spark: SparkSession, out_dir: str, keep: int = 2) -> list[str]:
    """Delete what only older publications than the last ``keep``, or failed runs before
    the last publication, wrote; returns the deleted folders.

    A run that began after the last published one is left alone: it may still be going on.
    """
    out = out_dir.rstrip("/")
    numbers = _numbers(spark, out)
    if not numbers:
        return []
    kept = [_read(spark, out, n) for n in numbers[-keep:]]
    named = {p for said in kept for path in said["outputs"].values() for p in (path if isinstance(path, list) else [path])}
    gone = []
    for n in numbers[:-keep]:
        fs.delete(spark, _manifest(out, n))
    for folder in fs.glob(spark, f"{fs.escaped(out)}/runs/*"):
        run = folder.rsplit("/", 1)[1]
        if run >= kept[-1]["run"] or any(said["run"] == run for said in kept):
            continue
        # a later run may have taken over some stages, or some parts of a stage
        here = [p for p in named if p.startswith(f"runs/{run}/")]
        level = [folder]
        while level:
            item = level.pop()
            short = item[item.rindex(f"/runs/{run}") + 1:]
            if short in here:
                continue
            if any(p.startswith(f"{short}/") for p in here):
                level += fs.glob(spark, f"{fs.escaped(item)}/*")
                continue
            fs.delete(spark, item)
            gone.append(item)
    return gone
