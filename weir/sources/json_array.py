"""One large JSON document, its array's elements read by many tasks.

A document like {"generated_at": ..., "users": [{...}, {...}]} is read as text cut
at every "}", which Spark splits by byte ranges wherever the file lies. A piece
never crosses a split, so an element of the array is a run of whole pieces, and the
array's name stands in one piece with its bracket.

Where an element begins depends on all text before it. A first pass sums up each
split for both ways it may begin, outside or inside a string: how it ends, how
deep it goes, and which arrays of the wanted name it leaves open. These few rows
are folded in file order into the state each split begins in. A second pass hands
out the elements; those cut by a split come as fragments and are joined again.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.operators.joins import broadcast_if_bounded
from weir.session import apply_result_conf

QUOTE, BACKSLASH = ord('"'), ord("\\")
OPENERS, CLOSERS = b"{[", b"}]"
PARTS = "file string, split long, lexical boolean, ends boolean, delta long, lowest long, opened array<long>"


def _structure(text: bytes, in_string: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of the brackets outside strings, their depth changes, and whether
    the text ends inside a string."""
    b = np.frombuffer(text, np.uint8)
    quotes = np.nonzero(b == QUOTE)[0]
    escaped = quotes[(quotes > 0) & (b[quotes - 1] == BACKSLASH)]
    real = np.ones(len(quotes), bool)
    for at in escaped.tolist():  # a quote after an odd number of backslashes is text
        run = at
        while run and b[run - 1] == BACKSLASH:
            run -= 1
        if (at - run) % 2:
            real[np.searchsorted(quotes, at)] = False
    quotes = quotes[real]
    opens, closes = np.isin(b, np.frombuffer(OPENERS, np.uint8)), np.isin(b, np.frombuffer(CLOSERS, np.uint8))
    at = np.nonzero(opens | closes)[0]
    outside = (np.searchsorted(quotes, at) + in_string) % 2 == 0
    at = at[outside]
    return at, np.where(opens[at], 1, -1), bool((len(quotes) + in_string) % 2)


def _named(name: str) -> re.Pattern:
    return re.compile(rb'"' + re.escape(name.encode()) + rb'"\s*:\s*\[')


class Summary:
    """What a split does from one way of beginning."""

    def __init__(self, in_string: bool):
        self.begins = self.in_string = in_string
        self.depth = self.lowest = 0
        self.opened: list[int] = []  # depths, before the bracket, of wanted arrays still open

    def add(self, text: bytes, named: re.Pattern) -> None:
        at, change, self.in_string = _structure(text, self.in_string)
        after = self.depth + np.cumsum(change)
        low = int(after.min(initial=self.depth))
        self.opened = [d for d in self.opened if low > d]
        for m in named.finditer(text):
            i = int(np.searchsorted(at, m.end() - 1))
            if i < len(at) and at[i] == m.end() - 1 and after[i:].min() >= after[i]:
                self.opened.append(int(after[i]) - 1)
        self.lowest = min(self.lowest, low)
        if len(after):
            self.depth = int(after[-1])


def _splits(batches):
    """(file, split, text) chunks of sorted pieces, the cuts put back."""
    for batch in batches:
        files, splits, values = (batch.column(c) for c in ("file", "split", "value"))
        key = list(zip(files.to_pylist(), splits.to_pylist()))
        start = 0
        for i in range(1, len(key) + 1):
            if i == len(key) or key[i] != key[start]:
                text = b"}".join(values.slice(start, i - start).cast(pa.binary()).to_pylist()) + b"}"
                yield key[start], text, batch.slice(start, 1)
                start = i


def _summarize(name: str):
    named, schema = _named(name), T._parse_datatype_string(PARTS)

    def run(batches):
        held: dict = {}
        for key, text, _ in _splits(batches):
            for s in held.setdefault(key, (Summary(False), Summary(True))):
                s.add(text, named)
        if held:
            rows = [(*key, s.begins, s.in_string, s.depth, s.lowest, s.opened) for key, both in held.items() for s in both]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                names=schema.names)

    return run


def _fold(key, parts):
    """The state in which each split of one file begins."""
    rows = sorted(parts.to_pylist(), key=lambda r: (r["split"], r["lexical"]))
    lexical, depth, inside, out = False, 0, False, []
    for r in rows:
        if r["lexical"] != lexical or (out and out[-1]["split"] == r["split"]):
            continue
        out.append({"file": r["file"], "split": r["split"], "lexical": lexical, "depth": depth, "inside": inside})
        inside = any(depth + d == 1 for d in r["opened"]) or (inside and depth + r["lowest"] >= 2)
        lexical, depth = r["ends"], depth + r["delta"]
    return pa.Table.from_pylist(out, schema=pa.schema([
        ("file", pa.string()), ("split", pa.int64()), ("lexical", pa.bool_()), ("depth", pa.int64()), ("inside", pa.bool_())]))


def _elements(name: str):
    named = _named(name)

    def run(batches):
        state: dict = {}
        key = None

        def rows(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.string()), pa.array([f[3] for f in found], pa.string())],
                names=["file", "split", "kind", "text"])

        def last():
            # what an element cut by the split's end has here: its beginning, or all between
            return [(*key, "begin" if state["began"] else "middle", b"".join(state["held"]).decode())] if state["open"] else []

        for now, text, first in _splits(batches):
            found = []
            if now != key:
                if key is not None:
                    found += last()
                row = first.to_pylist()[0]
                key = now
                state = {"in_string": row["lexical"], "depth": row["depth"], "inside": row["inside"],
                         "open": row["inside"] and row["depth"] >= 3, "began": False, "held": []}
            at, change, in_string = _structure(text, state["in_string"])
            after = state["depth"] + np.cumsum(change)
            before = after - change
            # arrays and objects right below the document: only the wanted array's members count
            tops = np.nonzero(((before == 1) & (change > 0)) | ((after == 1) & (change < 0)))[0]
            wanted = {m.end() - 1 for m in named.finditer(text)}
            inside = np.full(len(at), state["inside"])
            for i in tops.tolist():
                state["inside"] = bool(change[i] > 0 and int(at[i]) in wanted)
                inside[i:] = state["inside"]
            begins = at[inside & (change > 0) & (before == 2)]
            ends = at[inside & (change < 0) & (after == 2)]
            start = 0
            for end in ends.tolist():
                if state["open"]:
                    held = b"".join([*state["held"], text[:end + 1]]).decode()
                    found.append((*key, "whole" if state["began"] else "end", held))
                    state.update(open=False, held=[])
                else:
                    found.append((*key, "whole", text[begins[start]:end + 1].decode()))
                    start += 1
            if state["open"]:
                state["held"].append(text)
            elif start < len(begins):
                state.update(open=True, began=True, held=[text[begins[start]:]])
            state["in_string"] = in_string
            if len(after):
                state["depth"] = int(after[-1])
            if found:
                yield rows(found)
        if key is not None and (found := last()):
            yield rows(found)

    return run


def read_array_elements(spark: SparkSession, path: str, name: str, element: T.StructType) -> DataFrame:
    """One row (column `element`) per member object of the array `name` of each
    document in `path`. A file may hold one document of any size: its splits
    (`spark.sql.files.maxPartitionBytes`) are read by tasks of their own; a
    compressed file is one split. The array's name holds no "}"."""
    apply_result_conf(spark)
    pieces = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    parts = pieces.mapInArrow(_summarize(name), PARTS)
    states = parts.groupBy("file").applyInArrow(
        _fold, "file string, split long, lexical boolean, depth long, inside boolean").checkpoint()
    known, small = broadcast_if_bounded(states)
    if not small:
        raise ValueError(f"{path}: more splits than can be broadcast; raise spark.sql.files.maxPartitionBytes")
    # a broadcast join keeps the order of the pieces
    found = pieces.join(known, ["file", "split"]).select("file", "split", "lexical", "depth", "inside", "value").mapInArrow(
        _elements(name), "file string, split long, kind string, text string")
    cut = found.filter("kind <> 'whole'")
    order = Window.partitionBy("file").orderBy("split", F.expr("kind = 'begin'"))
    owner = F.last(F.when(F.col("kind") == "begin", F.col("split")), ignorenulls=True).over(order)
    joined = cut.withColumn("owner", owner).groupBy("file", "owner").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("split", "text"))), lambda p: p["text"]), "").alias("text"))
    whole = found.filter("kind = 'whole'").select("text").unionByName(joined.select("text"))
    return whole.select(F.from_json("text", element).alias("element"))
