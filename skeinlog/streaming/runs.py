"""A table that grows by micro-batches and is read in few pieces, however many batches there were.

Each batch writes its own rows as one run. ``every`` runs of one size are folded into one of the next size, when the
batch number asks for it: after batch n the live runs are the digits of n + 1 in base ``every``. So a row is rewritten
a logarithmic number of times, a batch that is repeated after a failure writes the same runs again, and rows that a
batch does not touch are not written by it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Runs of one size that are folded into one.
EVERY = 8


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


@dataclass(frozen=True)
class Runs:
    """Runs below ``path``; ``fold`` turns rows of several runs into rows that stand for them.

    A reader starts from the newest batch that has a mark, an empty file made when all that the batch wrote is in place.
    Runs that a fold has replaced, and old marks, go ``every`` batches later, so that a reader has that long to finish.
    """

    path: str
    fold: Callable[[DataFrame], DataFrame]
    every: int = EVERY

    def _run(self, first: int, last: int) -> str:
        return f"{self.path}/run/{first}-{last}"

    def _mark(self, number: int) -> str:
        return f"{self.path}/mark/{number}"

    def _folds(self, number: int) -> Iterator[list[tuple[int, int]]]:
        """Groups of runs that batch ``number`` folds, small ones first."""
        size = 1
        while (number + 1) % (size * self.every) == 0:
            start = number + 1 - size * self.every
            yield [(start + i * size, start + (i + 1) * size - 1) for i in range(self.every)]
            size *= self.every

    def live(self, number: int) -> list[str]:
        """Folders of the runs that hold batches 0 to ``number``, oldest first."""
        done, size, left = [], 1, number + 1
        while size * self.every <= left:
            size *= self.every
        while left:
            while size > left:
                size //= self.every
            start = number + 1 - left
            done.append(self._run(start, start + size - 1))
            left -= size
        return done

    def head(self, spark: SparkSession) -> int | None:
        """Number of the newest batch that is in place."""
        files, at = _file_system(spark, f"{self.path}/mark")
        if not files.exists(at):
            return None
        return max((int(s.getPath().getName()) for s in files.listStatus(at)), default=None)

    def rows(self, spark: SparkSession, number: int) -> DataFrame:
        """Rows of all batches up to ``number``, folded within runs but not across them."""
        return spark.read.parquet(*self.live(number))

    def write(self, rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        rows.write.mode("overwrite").parquet(self._run(number, number))
        for group in self._folds(number):
            many = spark.read.parquet(*[self._run(*g) for g in group])
            self.fold(many).write.mode("overwrite").parquet(self._run(group[0][0], group[-1][1]))
        self._finish(spark, number)

    def _finish(self, spark: SparkSession, number: int) -> None:
        files, mark = _file_system(spark, self._mark(number))
        files.create(mark, True).close()
        old = number - self.every
        if old < 0:
            return
        replaced = [self._run(*g) for group in self._folds(old) for g in group]
        for path in [*replaced, self._mark(old)]:
            files.delete(_file_system(spark, path)[1], True)
