"""Tasks of one barrier stage that work in step (Spark's barrier execution mode).

Iterative fits with many cheap rounds cost a Spark job or more per round
otherwise.  Here every task keeps its rows, and a round adds up arrays over all
tasks: each task writes its part to the shared checkpoint folder, and each reads
the stretch it answers for from the parts of all, as soon as they are there
(Spark's own ``barrier`` and ``allGather`` look once a second).  A failed task
restarts the whole stage, under a new folder name.
"""

from __future__ import annotations

import time
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def slots(spark: SparkSession) -> int:
    """Tasks that may surely run at once; 0 where that is not known: a barrier
    stage needs all its tasks at work together."""
    sc = spark.sparkContext
    conf = sc.getConf()
    if conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    cores = sc.defaultParallelism
    if conf.get("spark.default.parallelism"):
        cores = int(conf.get("spark.executor.instances", "0")) * int(conf.get("spark.executor.cores", "0"))
    return cores // int(conf.get("spark.task.cpus", "1"))


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), unquote(urlparse(uri).path)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


class Gang:
    """The tasks of this barrier stage, from inside one of them; all make the
    same calls in the same order."""

    def __init__(self, folder: str, tasks: int):
        from pyspark import BarrierTaskContext
        self.context, self.tasks = BarrierTaskContext.get(), tasks
        self.me = self.context.partitionId()
        name = self.context.allGather(uuid.uuid4().hex)[0]
        self.files, path = _file_system(folder)
        self.path = f"{path}/quarry-gang-{name}"
        self.files.create_dir(self.path, recursive=True)
        self.round = 0

    def _meet(self, data: pa.Buffer | bytes) -> list[str]:
        """Hand in a file; those of all tasks, when they are whole."""
        self.round += 1
        names = [f"{self.path}/{self.round}-{t}" for t in range(self.tasks)]
        with self.files.open_output_stream(f"{names[self.me]}.part") as f:
            f.write(data)
        self.files.move(f"{names[self.me]}.part", names[self.me])
        left, pause = names, 0.0005
        while left := [x.path for x in self.files.get_file_info(left) if x.type == pafs.FileType.NotFound]:
            time.sleep(pause)  # a task that fails ends this one too
            pause = min(pause * 1.2, 0.05)
        if self.round > 2:  # read by all, or they would not be in the round before this one
            self.files.delete_file(f"{self.path}/{self.round - 2}-{self.me}")
        return names

    def gathered(self, data: bytes) -> list[bytes]:
        """What every task hands in, in the order of the tasks; for small things."""
        out = []
        for name in self._meet(data):
            with self.files.open_input_file(name) as f:
                out.append(f.read())
        return out

    def shares(self, sizes: np.ndarray) -> tuple[int, int]:
        """The units (of so many numbers) that this task answers for."""
        ends = np.cumsum(sizes)
        cuts = np.searchsorted(ends, ends[-1] * np.arange(self.tasks + 1) / self.tasks, side="left") if len(ends) else \
            np.zeros(self.tasks + 1, int)
        cuts[-1] = len(ends)
        return int(cuts[self.me]), int(cuts[self.me + 1])

    def added(self, values: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Element ``start`` to ``stop`` of the sum of all tasks' ``values``
        (float64, of one length), added up in the order of the tasks."""
        names = self._meet(pa.py_buffer(np.ascontiguousarray(values, np.float64)))
        total = np.zeros(stop - start)
        if stop > start:
            for name in names:
                with self.files.open_input_file(name) as f:
                    total += np.frombuffer(f.read_at(8 * (stop - start), 8 * start), np.float64)
        return total

    def end(self) -> None:
        """Nothing stays in the folder."""
        self.context.barrier()
        if self.me == 0:
            self.files.delete_dir(self.path)
