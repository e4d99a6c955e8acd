"""Repair of conversation structure by a persistent audit dynamic program.

A conversation should read as an optional system turn and then pairs of user and
assistant turns. The cheapest edits (keep, rerole, delete, insert) that make it
so are found row by row: for each of the four places in that pattern the best
edits so far are one linked node, which shares its prefix with the others. Nodes
carry binary-lifting ancestors and a rolling hash of their whole string, so two
equally cheap edit strings are compared by a search for their longest common
prefix; equal hashes of different nodes are verified letter by letter. Equally
cheap strings for the same rows and place are never prefixes of each other (the
longer would hold inserts, which cost), so the smaller prefix stays the smaller
string.

Spark deals the rows by conversation and sorts them; each partition is streamed.
A place that another one undercuts by more than the edits between them is
dropped, and edits that all remaining places share are given out at once, so a
conversation of any length, a third of all rows included, is held as a short
window of rows and nodes. Repeats are found by a grouped aggregate.

Defined cases: a null role or text is one space; a null conversation id is a
conversation; rows of equal turn are taken by role, then text; null turns come
first; a role without characters has no initial and cannot be kept; texts may
have any length; further columns of any name stay out of the plan; an empty table
gives an empty result. A conversation all of whose rows are absent (`present`
false) has an empty audit.
"""

from __future__ import annotations

import hashlib
from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1  # added for a truncated row that stays
SPACE = " \t\n\x0b\x0c\r"

# Places in the pattern: 0 nothing yet, 1 after s, 2 after u, 3 after a; 0 and 3 may end.
START, ENDS = 0, (0, 3)
FOLLOWS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
# FOLLOW_UP[t][s]: what it may cost place t at most to do whatever place s does from here on.
FOLLOW_UP = {0: {1: 0, 2: 2, 3: 0}, 1: {0: 4, 2: 2, 3: 4}, 2: {0: 5, 1: 2, 3: 2}, 3: {0: 3, 1: 0, 2: 2}}
LEGAL = {"su", "ua", "au"}

MODULUS, BASE = 2**61 - 1, 1_000_003
WINDOW = 512  # edits held before those that all places share are given out
ROWS, BYTES = 4096, 1 << 22  # of one batch given out


class Node:
    """An edit string: its last letter, and its prefixes as ancestors 1, 2, 4, ... letters back."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, parent: Node | None = None, letter: str = ""):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(letter)) % MODULUS
        up, k = [parent], 0
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)

    def ancestor(self, depth: int) -> Node:
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node

    def letters(self, above: int = 0) -> str:
        out, node = [], self
        while node.depth > above:
            out.append(node.letter)
            node = node.up[0]
        return "".join(reversed(out))


def same(a: Node, b: Node) -> bool:
    """Whether two nodes of one depth spell the same; equal hashes are verified."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b and a.depth:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def fork(a: Node, b: Node) -> tuple[Node, Node]:
    """The first nodes of a and b that differ, or two that spell the same where
    one string is the other's prefix."""
    depth = min(a.depth, b.depth)
    a, b = a.ancestor(depth), b.ancestor(depth)
    if same(a, b):
        return a, b
    for k in range(len(a.up) - 1, -1, -1):
        if k < len(a.up) and not same(a.up[k], b.up[k]):
            a, b = a.up[k], b.up[k]
    return a, b


def smaller(a: Node, b: Node) -> bool:
    x, y = fork(a, b)
    return x.letter < y.letter if not same(x, y) else a.depth < b.depth


def shared(a: Node, b: Node) -> Node:
    """The longest common prefix."""
    x, y = fork(a, b)
    return x if same(x, y) else x.up[0]


class Audit:
    """The cheapest edits of one conversation, its rows given in order."""

    def __init__(self):
        self.best = {START: (0, Node())}
        self._insert(self.best)

    @staticmethod
    def _insert(best: dict) -> None:
        waiting = sorted(best)
        while waiting:
            place = waiting.pop()
            cost, node = best[place]
            target = WANTED[place][1]
            cost += COST[INSERT]
            have = best.get(target)
            if have is None or cost < have[0] or (cost == have[0] and smaller(Node(node, INSERT), have[1])):
                best[target] = (cost, Node(node, INSERT))
                waiting.append(target)

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        found: dict[int, tuple[int, Node, str]] = {}
        for place, (cost, node) in self.best.items():
            ways = [(place, COST[DELETE], DELETE)]
            if not must_go:
                ways.append((WANTED[place][1], COST[REROLE] + TRUNCATED * truncated, REROLE))
                if (place, initial) in FOLLOWS:
                    ways.append((FOLLOWS[place, initial], COST[KEEP] + TRUNCATED * truncated, KEEP))
            for target, more, letter in ways:
                have, total = found.get(target), cost + more
                if have is None or total < have[0] or (
                        total == have[0] and smaller(Node(node, letter), Node(have[1], have[2]))):
                    found[target] = (total, node, letter)
        best = {t: (cost, Node(node, letter)) for t, (cost, node, letter) in found.items()}
        self._insert(best)
        self.best = {s: x for s, x in best.items()
                     if all(t == s or y[0] + FOLLOW_UP[t][s] >= x[0] for t, y in best.items())}

    def depth(self) -> int:
        return max(node.depth for _, node in self.best.values())

    def decided(self) -> str:
        """Takes out the edits that all places share."""
        nodes = [node for _, node in self.best.values()]
        common = nodes[0]
        for node in nodes[1:]:
            common = shared(common, node)
        fresh = {}
        for place, (cost, node) in self.best.items():
            new = Node()
            for letter in node.letters(common.depth):
                key = (new, letter)
                new = fresh.get(key) or fresh.setdefault(key, Node(new, letter))
            self.best[place] = (cost, new)
        return common.letters()

    def finish(self) -> tuple[int, str]:
        ends = [self.best[p] for p in ENDS if p in self.best]
        low = min(cost for cost, _ in ends)
        nodes = [node for cost, node in ends if cost == low]
        last = nodes[0] if len(nodes) == 1 or smaller(nodes[0], nodes[1]) else nodes[1]
        return low, last.letters()


class Conversation:
    """Counts, edits and repaired rows of one conversation, as its rows come in order."""

    def __init__(self, conv_id, emit):
        self.conv_id, self.emit = conv_id, emit
        self.audit = Audit()
        self.waiting: deque = deque()
        self.place, self.steps = START, 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.first = self.last = self.before = None
        self.turns = 0

    def row(self, turn, role: str, text: str, blank: bool, repeated: bool, truncated: bool) -> None:
        now = (turn, role, text)
        initial = role[:1]
        if self.before is not None:
            repeated = repeated or now == self.before
            self.counts["illegal"] += self.before[1][:1] + initial not in LEGAL
        if turn is not None:
            if self.first is None:
                self.first = turn
            self.turns += turn != self.last
            self.last = turn
        self.before = now
        fault = "blank" if blank else "duplicate" if repeated else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        self.waiting.append(now)
        self.audit.row(initial, fault in ("blank", "duplicate"), fault == "truncated")
        if self.audit.depth() > WINDOW:
            self._give(self.audit.decided())

    def _give(self, letters: str) -> None:
        for letter in letters:
            turn, role, text = (None, "", "") if letter == INSERT else self.waiting.popleft()
            if letter in (INSERT, REROLE):
                role, self.place = WANTED[self.place]
            elif letter == KEEP:
                self.place = FOLLOWS[self.place, role[:1]]
            self.emit(self.conv_id, self.steps, letter, turn, role, text)
            self.steps += 1

    def finish(self) -> dict[str, int]:
        cost, letters = self.audit.finish()
        self._give(letters)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return {"gaps": gaps, **self.counts, "cost": cost}


def prepared(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
             present: Column | None) -> DataFrame:
    """The rows of each conversation in one partition and in order, faults marked."""
    def plain(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    whole = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        plain(role_col).alias("role"), plain(text_col).alias("text"), here.alias("present"))
    whole = whole.withColumns({
        "key": F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)),
        "at": F.struct(F.col("turn").isNotNull().alias("known"), "turn")})
    repeats = whole.where("present").groupBy("conv_id", "key").agg(F.min("at").alias("first"), F.count("*").alias("n")).where(
        "n > 1").select(F.col("conv_id").alias("r_conv"), F.col("key").alias("r_key"), "first")
    ended = F.rtrim("text", F.lit(SPACE))
    marked = whole.join(repeats, whole.conv_id.eqNullSafe(F.col("r_conv")) & (F.col("key") == F.col("r_key")), "left").select(
        "conv_id", "present", "turn", "role", "text", (ended == "").alias("blank"),
        F.coalesce(F.col("at") > F.col("first"), F.lit(False)).alias("repeated"),
        (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    return marked.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("present"), "turn", "role", "text")


def conversations(batches, emit):
    """Streams sorted rows: yields None after a row, and a conversation's id and counts after its last."""
    conv = None
    for batch in batches:
        for conv_id, present, turn, role, text, *faults in zip(*(c.to_pylist() for c in batch.columns)):
            if conv is None or conv_id != conv.conv_id:
                if conv is not None:
                    yield conv.conv_id, conv.finish()
                conv = Conversation(conv_id, emit)
            if present:
                conv.row(turn, role, text, *faults)
                yield None
    if conv is not None:
        yield conv.conv_id, conv.finish()


def _streamed(ready: DataFrame, fields: list[StructField], collector) -> DataFrame:
    """Runs a collector (emit, done) over each partition; its rows are given out in bounded batches."""
    schema = StructType([ready.schema["conv_id"], *fields])
    kinds = to_arrow_schema(schema)

    def run(batches):
        rows: list[tuple] = []
        sink = collector(rows)

        def batch():
            columns = zip(*rows)
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)
            rows.clear()
            sink.size = 0
            return out

        for done in conversations(batches, sink.emit):
            if done is not None:
                sink.done(*done)
            if len(rows) >= ROWS or sink.size >= BYTES:
                yield batch()
        if rows:
            yield batch()

    return ready.mapInArrow(run, schema)


class _Edits:
    """Every edit as a row."""

    def __init__(self, rows: list):
        self.rows, self.size = rows, 0

    def emit(self, *edit) -> None:
        self.rows.append(edit)
        self.size += len(edit[-1])

    def done(self, conv_id, counts) -> None:
        pass


class _Summary:
    """One row per conversation: its counts, audit string and the digest of its repaired rows."""

    def __init__(self, rows: list):
        self.rows, self.size = rows, 0
        self._open()

    def _open(self) -> None:
        self.letters, self.digest, self.any = [], hashlib.sha256(), False

    def emit(self, conv_id, step, edit, turn, role, text) -> None:
        self.letters.append(edit)
        if edit != DELETE:
            self.digest.update((("\n" if self.any else "") + f"{role}:{text}").encode())
            self.any = True

    def done(self, conv_id, counts) -> None:
        audit = "".join(self.letters)
        self.rows.append((conv_id, *counts.values(), audit, self.digest.hexdigest()))
        self.size += len(audit)
        self._open()


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", present: Column | None = None) -> DataFrame:
    """conv_id, step (from 0), edit, turn, role, text: each conversation's edits in
    order with the rows they give; deleted rows (edit D) are named as they were."""
    return _streamed(prepared(rows, conv_col, turn_col, role_col, text_col, present), [
        StructField("step", LongType()), StructField("edit", StringType()), StructField("turn", LongType()),
        StructField("role", StringType()), StructField("text", StringType())], _Edits)


def audits(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", present: Column | None = None) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost,
    audit, and the SHA-256 of the repaired `role:text` rows joined by newlines."""
    numbers = [StructField(c, LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return _streamed(prepared(rows, conv_col, turn_col, role_col, text_col, present), [
        *numbers, StructField("audit", StringType()), StructField("repaired_sha256", StringType())], _Summary)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows damaged by the crc32 of `conv_id:turn` modulo 20 (nulls: one
    space): 0 drops the row (`present` false), 1 empties its text, 2 removes its
    `[.!?]`, 3 repeats it, 4 makes it the user's."""
    def plain(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fold = F.crc32(F.concat_ws(":", plain("conv_id"), plain("turn")).cast("binary")) % 20
    return rows.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), fold.alias("fold")).select(
        "conv_id", "turn", F.when(F.col("fold") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fold") == 1, "").when(F.col("fold") == 2, F.translate("text", ".!?", "")).otherwise(
            F.col("text")).alias("text"),
        (F.col("fold") != 0).alias("present"),
        F.explode(F.when(F.col("fold") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
