"""Moving loaded files out of the landing folder (K7)."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def move_files(spark: SparkSession, names: Iterable[str], source: str, target: str) -> tuple[int, int]:
    """Moves entries of one folder to another on the same file system, one rename
    each; (moved, left). What cannot be moved, or would replace something, is
    logged and left where it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    moved = left = 0
    for name in names:
        there = path(target, name)
        try:
            store.mkdirs(path(target))
            problem = "the archive has one of that name" if store.exists(there) else None
            if problem is None and not store.rename(path(source, name), there):
                problem = "the file system refused"
        except Py4JJavaError as e:
            problem = str(e.java_exception)
        if problem:
            log.warning("%s stays in %s: %s", name, source, problem)
            left += 1
        else:
            moved += 1
    return moved, left
