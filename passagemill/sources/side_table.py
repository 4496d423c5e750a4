"""Offsets of file blocks for the scan tasks that need them, without a join.

A scan task reads the same few blocks in both passes over the corpus. The block table is written sorted by scan task, and each
task reads its own rows of it by its number. So lines meet their block's row at any size of the table, and are neither
shuffled nor is the table broadcast. Only the lines' positions travel to Python; the text stays where it is.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reader travels inside the UDF, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Scan tasks whose blocks share a folder.
TASKS_PER_FOLDER = 64
_KEY, _FOLDER = "block_key", "task_folder"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system for a URI or local path (file, hdfs, gs, abfss, s3, also as s3a or s3n), and the path on it."""
    scheme, mark, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else uri)


def write_side_table(blocks: DataFrame, key: list[str], path: str) -> None:
    """``blocks``: task, first_pos, the columns of ``key`` and whatever is to be looked up."""
    own = blocks.withColumns({_KEY: F.xxhash64(*key), _FOLDER: F.expr(f"task div {TASKS_PER_FOLDER}")})
    own.repartition(_FOLDER).sortWithinPartitions(_FOLDER, "task", "first_pos").write.partitionBy(_FOLDER).parquet(path)


def look_up(path: str, key: list[str], columns: dict[str, str]) -> Column:
    """A struct of ``columns`` (name: type) of the block that holds the line; lines have task, pos and the columns of ``key``.

    A line whose block is not in the table stops the job.
    """
    names = list(columns)

    def found(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        task, rows = None, {}
        for tasks, keys, positions in batches:
            if not len(tasks):
                yield pd.DataFrame({n: [] for n in names})
                continue
            if task != tasks.iloc[0]:
                task = int(tasks.iloc[0])
                files, root = file_system(f"{path}/{_FOLDER}={task // TASKS_PER_FOLDER}")
                if files.get_file_info(root).type == fs.FileType.NotFound:
                    raise ValueError("file blocks changed between the two passes")
                wanted = list(dict.fromkeys(["first_pos", _KEY, *names]))
                read = pq.read_table(root, columns=wanted, filters=[("task", "=", task)], filesystem=files, partitioning=None)
                rows = {n: read[n].to_numpy(zero_copy_only=False) for n in wanted}
            at = np.searchsorted(rows["first_pos"], positions.to_numpy(), side="right") - 1
            if not len(rows["first_pos"]) or (at < 0).any() or (rows[_KEY][at] != keys.to_numpy()).any():
                raise ValueError("file blocks changed between the two passes")
            yield pd.DataFrame({n: rows[n][at] for n in names})

    kind = ", ".join(f"{n} {t}" for n, t in columns.items())
    return F.pandas_udf(found, kind)(F.col("task"), F.xxhash64(*key), F.col("pos"))
