"""Numbers the batches of a pipeline through, whichever run they come from.

`runs/P/N` is a file that names the run and its batch. It is created in one step and
never overwritten, so a number belongs to one batch of one run even if two runs ask at the same
time. Old files are folded into one, `runs/P/archive-N`, which keeps the last batch of every run.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from tripfold.sources.paths import create_file, file_names, read_file, remove

RECENT = 20  # numbers with a file of their own
PATIENCE = 5.0  # seconds that another run has to write its name into the file it created


class BatchLog:
    def __init__(self, spark: SparkSession, root: str, pipeline_id: str, is_done: Callable[[int], bool]):
        """`is_done` tells whether a number's batch has been counted."""
        self.spark = spark
        self.folder = f"{root}/runs/pipeline_id={pipeline_id}"
        self.is_done = is_done

    def _archive(self) -> tuple[dict[str, list[int]], list[str]]:
        """(run: [its last batch, the number of that]) of the newest archive, and the names of all."""
        names = [n for n in file_names(self.spark, self.folder) if n.startswith("archive-")]
        return (json.loads(read_file(self.spark, f"{self.folder}/{names[-1]}")) if names else {}), names

    def _recent(self) -> list[int]:
        return sorted(int(n) for n in file_names(self.spark, self.folder) if n.isdigit())

    def _owner(self, number: int) -> tuple[str, int]:
        """Run and batch of a number."""
        until = time.monotonic() + PATIENCE
        while not (text := read_file(self.spark, f"{self.folder}/{number:09d}")):
            if time.monotonic() > until:
                raise ValueError(f"{self.folder}/{number:09d} names no run: a start was cut off; remove the file")
            time.sleep(0.1)
        run, batch = text.rsplit("-", 1)
        return run, int(batch)

    def number(self, run: str, batch_id: int) -> int:
        """The number of a run's batch: the one it had before, or the next.

        Raises while a batch of another run waits to be finished, because its
        events are part of the state but not yet of the KPIs.
        """
        while True:
            archive, names = self._archive()
            recent = self._recent()
            for n in reversed(recent):
                if self._owner(n) == (run, batch_id):
                    return n
            last_batch, its_number = archive.get(run, (-1, -1))
            if batch_id <= last_batch:  # an earlier batch of a run is never asked for again
                return its_number
            last = max([*recent, *(int(n.removeprefix("archive-")) for n in names)], default=-1)
            if last in recent and not self.is_done(last):
                raise ValueError(f"batch {'-'.join(map(str, self._owner(last)))} has not finished: run it again first")
            if create_file(self.spark, f"{self.folder}/{last + 1:09d}", f"{run}-{batch_id}"):
                return last + 1

    def fold(self) -> None:
        """Folds the files of all but the newest numbers into the archive. Cut off at any point, it loses nothing."""
        old = self._recent()[:-RECENT]
        if not old:
            return
        archive, names = self._archive()
        for n in old:
            run, batch = self._owner(n)
            archive[run] = max(archive.get(run, [-1, -1]), [batch, n])
        create_file(self.spark, f"{self.folder}/archive-{old[-1]:09d}", json.dumps(archive))
        for name in [*names, *(f"{n:09d}" for n in old)]:
            if name != f"archive-{old[-1]:09d}":
                remove(self.spark, f"{self.folder}/{name}")
