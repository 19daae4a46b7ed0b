"""Trained runs as folders that never change, and a champion that is replaced by compare-and-swap."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from featureflow.operators.model import replaces_champion


@dataclass(frozen=True)
class Champion:
    """What a manifest says: its version, the run, and the run's metrics. Version 0 is no champion at all."""

    version: int = 0
    run_id: str | None = None
    metrics: Mapping[str, float] | None = None


class Registry:
    """Runs below ``<root>/runs`` and numbered manifests below ``<root>/champion``.

    A manifest is never changed; the one with the highest number holds. It is written by creating the file of
    the next number, which the file system grants to one writer only (HDFS and local files; an object store
    needs a committer that refuses to overwrite). Whoever comes second looks again at who is champion now.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def run_path(self, run_id: str) -> str:
        return f"{self.root}/runs/{run_id}"

    def add_run(self, run_id: str, write: Callable[[str], None], metrics: Mapping[str, float]) -> str:
        """Keep a run: ``write`` puts its parts below the given path. A run that is there already is an error."""
        path = self.run_path(run_id)
        if self._files.exists(self._path(f"{path}/metrics.json")):
            raise FileExistsError(f"run {run_id} is there already")
        write(path)
        # Written last and once: a run without metrics is unfinished.
        self._create(f"{path}/metrics.json", {k: float(v) for k, v in metrics.items()})
        return path

    def metrics_of(self, run_id: str) -> dict[str, float]:
        return self._read(f"{self.run_path(run_id)}/metrics.json")

    def champion(self) -> Champion:
        folder = self._path(f"{self.root}/champion")
        if not self._files.exists(folder):
            return Champion()
        names = sorted((s.getPath().getName() for s in self._files.listStatus(folder) if s.getLen()), reverse=True)
        for name in names:
            try:
                return Champion(**self._read(f"{self.root}/champion/{name}"))
            except ValueError:  # still being written
                continue
        return Champion()

    def promote(self, run_id: str, expected: Champion) -> bool:
        """Make the run champion if the champion is still the expected one."""
        version = expected.version + 1
        manifest = {"version": version, "run_id": run_id, "metrics": self.metrics_of(run_id)}
        return self._create(f"{self.root}/champion/{version:09d}.json", manifest, raising=False)

    def challenge(self, run_id: str, metric: str = "val_rmse") -> bool:
        """Make the run champion if its error is strictly lower than the champion's, whoever that is by then."""
        error = self.metrics_of(run_id)[metric]
        while True:
            now = self.champion()
            if not replaces_champion(now.metrics and {metric: now.metrics[metric]}, error):
                return False
            if self.promote(run_id, now):
                return True

    def _create(self, path: str, content: Mapping, raising: bool = True) -> bool:
        try:
            stream = self._files.create(self._path(path), False)
        except Py4JJavaError as problem:
            # Whoever holds the lease on the file is creating it; either way the name is taken.
            if not raising and "FileAlreadyExists" in str(problem.java_exception.getClass().getName()):
                return False
            raise
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        return True

    def _read(self, path: str) -> dict:
        rows = self.spark.read.text(path, wholetext=True).collect()
        return json.loads(rows[0][0] if rows else "")
