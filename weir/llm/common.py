"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def give_back() -> None:
    """Hands a Python worker's freed memory back to the system. Workers are
    reused: what one stage freed but kept would stand beside the next one's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc: nothing to trim
        pass


_KEPT: dict = {}


def kept(key, make):
    """What this Python worker keeps between tasks under `key`, made when it is
    asked for first. A worker keeps one thing at a time."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Lets go of what another operator's tasks left in this worker, so that it
    does not stand beside the memory of this one's."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def released(step, *args):
    """One group's `step`, its memory given back once its locals are gone."""
    try:
        return step(*args)
    finally:
        give_back()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id` and the text as UTF-8 bytes (null: empty); any further column
    of the input, whatever its name, stays out of the plan."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("body"),
    )


def id_fold(id_col: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id's decimal text, modulo `folds` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def body_bytes(rows: DataFrame) -> int:
    """Bytes of `body` in all rows: what the numbers of blocks, shards and ranges follow."""
    return rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0


def in_blocks(rows: DataFrame, total: int, target_bytes: int, least: int = 32) -> DataFrame:
    """Adds `tie` (a hash of the body) and `block`: rows dealt by the hash of id and
    body into blocks of about `target_bytes` of the `total`. The number of blocks
    follows the input, so a block fits a Python worker at any size, and the rows of a
    null or repeated id are spread like any others; equal rows share a block."""
    n = max(least, math.ceil(total / target_bytes))
    tied = rows.withColumn("tie", F.xxhash64("body"))
    return tied.withColumn("block", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(n)).cast("int")).repartition(n, "block")


def sorted_block(table) -> tuple[list, list, np.ndarray]:
    """Ids and bodies of one block in the order (id, tie, body), null ids last: the
    same order in every pass over the block, whatever order the shuffle gave."""
    ids, bodies = table.column("doc_id").to_pylist(), table.column("body").to_pylist()
    ties = table.column("tie").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, ties[i], bodies[i]))
    return [ids[i] for i in order], [bodies[i] for i in order], np.array(order, dtype=np.int64)


def chunks(bodies: list[bytes], size: int):
    """Ranges [i, j) of consecutive bodies of about `size` bytes; a longer
    body is a range of its own."""
    i = 0
    while i < len(bodies):
        j, n = i, 0
        while j < len(bodies) and (j == i or n + len(bodies[j]) <= size):
            n += len(bodies[j])
            j += 1
        yield i, j
        i = j
