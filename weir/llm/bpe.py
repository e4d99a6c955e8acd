"""Exact BPE encoding and decoding around a transducer lexicon.

Frequent words of the corpus and their token ids are compiled into a minimal
acyclic automaton (equal suffix languages share states). Every edge carries the
number of words that sort before it, so the sum along a path is the word's
number and indexes its ids: the automaton is a transducer from words to ids. It
is one flat file, sent to the executors once and memory-mapped by each worker;
only distinct words reach it, since a worker keeps the ids of the runs it has
seen. A word the lexicon lacks is merged here, pair by pair in the order of the
tokenizer's merge table.

Texts are cut at white space. No token of this kind of model spans white space,
so the ids of a text are those of its runs in order. A run with characters beyond
U+024F is normalised by the library, whose Unicode tables decide there, and then
cut into words like any other, so words of every script are in the lexicon. Only
runs with a special token's string, or a character that the library classes
otherwise than the word pattern here (asked once per character), go to the library
whole. A word enters the lexicon if the library gives it the same ids.

Defined cases: a null text is an empty one and has no ids; special tokens' strings
in a text get their ids, as in the library; a text or word may have any length;
repeated rows and ids are encoded each; further columns of any name stay out of the
plan; an empty table gives an empty result and an empty lexicon.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import uuid
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from weir.llm.common import id_and_bytes, kept
from weir.session import scratch_path

FREQUENT = 2e-6  # share of a task's runs from which a run is frequent: at most 500,000 of a task
HELD_RUNS = 300_000  # runs, and words, a worker keeps the ids of before it starts anew
MAGIC = 0x57454952


# ---- minimal acyclic automaton ---------------------------------------------

def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """Words (UTF-8) and their ids as one flat little-endian buffer of u32:
    header, hashed edge table (state, byte) -> (target, words before), final
    flags, and ids by word number."""
    keys = sorted(words)
    register: dict[tuple, int] = {}
    edges: list[list[tuple[int, int]]] = [[]]  # by state: (byte, target), bytes ascending
    final: list[bool] = [False]
    path = [0]  # states along the last word
    last = b""

    def settle(down_to: int) -> None:
        """Replace the last word's states below depth `down_to` by equal registered ones."""
        for depth in range(len(path) - 1, down_to, -1):
            state = path.pop()
            sign = (final[state], tuple(edges[state]))
            known = register.setdefault(sign, state)
            if known != state:
                byte = edges[path[-1]][-1][0]
                edges[path[-1]][-1] = (byte, known)

    for word in keys:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(common)
        for byte in word[common:]:
            edges.append([])
            final.append(False)
            edges[path[-1]].append((byte, len(edges) - 1))
            path.append(len(edges) - 1)
        final[path[-1]] = True
        last = word
    settle(0)

    count: dict[int, int] = {}

    def below(root: int) -> None:  # words accepted from each state, without recursion
        stack = [(root, False)]
        while stack:
            state, ready = stack.pop()
            if state in count:
                continue
            if ready:
                count[state] = int(final[state]) + sum(count[t] for _, t in edges[state])
            else:
                stack.append((state, True))
                stack.extend((t, False) for _, t in edges[state] if t not in count)

    below(0)
    number = {s: i for i, s in enumerate(count)}
    table: list[tuple[int, int, int]] = []
    for state in count:
        before = int(final[state])
        for byte, target in edges[state]:
            table.append((number[state] << 8 | byte, number[target], before))
            before += count[target]
    size = 1 << max(4, (2 * len(table)).bit_length())
    slots = np.zeros((size, 3), "<u4")  # key + 1 (0: free), target, words before
    for key, target, before in table:
        at = _slot(key, size)
        while slots[at, 0]:
            at = (at + 1) & (size - 1)
        slots[at] = (key + 1, target, before)
    flags = np.zeros(len(count), "<u4")
    for state, i in number.items():
        flags[i] = final[state]
    starts = np.zeros(len(keys) + 1, "<u4")
    starts[1:] = np.cumsum([len(words[k]) for k in keys])
    ids = np.array([i for k in keys for i in words[k]], "<u4")
    head = np.array([MAGIC, size, len(flags), len(starts), number[0], len(ids)], "<u4")
    return b"".join(x.tobytes() for x in (head, slots, flags, starts, ids))


def _slot(key: int, size: int) -> int:
    return (key * 0x9E3779B1 >> 7) & (size - 1)


class Lexicon:
    """Read side of `compile_lexicon`, over any buffer (a memory map)."""

    def __init__(self, buffer):
        view = memoryview(buffer).cast("B").cast("I")
        magic, self.size, flags, starts, self.root, _ = view[:6]
        if magic != MAGIC:
            raise ValueError("not a lexicon")
        a = 6 + 3 * self.size
        self.slots, self.final = view[6:a], view[a:a + flags]
        self.starts, self.ids = view[a + flags:a + flags + starts], view[a + flags + starts:]

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, word: bytes):
        """The word's ids, or None."""
        slots, wrap, state, number = self.slots, self.size - 1, self.root, 0
        for byte in word:
            key = state << 8 | byte
            at = (key * 0x9E3779B1 >> 7) & wrap  # _slot, in line: this loop is the hot one
            while (found := slots[3 * at]) != key + 1:
                if not found:
                    return None
                at = (at + 1) & wrap
            state = slots[3 * at + 1]
            number += slots[3 * at + 2]
        if not self.final[state]:
            return None
        return self.ids[self.starts[number]:self.starts[number + 1]]


# ---- merging -----------------------------------------------------------------

SHORT = 32  # symbols up to which all pairs of a word are looked at for each merge
NEVER = 1 << 62  # rank of a pair that is not in the table


class Merges:
    """A model's merge table: pairs of token ids -> rank, and the pair's id by rank."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.inner = {c: i for c, i in vocab.items() if len(c) == 1}
        self.last = {c[:1]: i for c, i in vocab.items() if c[1:] == suffix}

    def ids(self, symbols: list[str]) -> list[int]:
        """The ids of a word given as symbols: of all neighbours the pair of the
        lowest rank is merged, the leftmost first, until none is in the table.
        Symbols without a token are left out, as by the library."""
        known = [self.inner.get(c) for c in symbols[:-1]] + [self.last.get(c) for c in symbols[-1:]]
        ids = [i for i in known if i is not None]
        return self._short(ids) if len(ids) <= SHORT else self._long(ids)

    def _short(self, ids: list[int]) -> list[int]:
        rank, merged = self.rank.get, self.merged
        ranks = [rank(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            i = ranks.index(low)
            ids[i:i + 2] = [merged[low]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), NEVER)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        rank, n = self.rank.get, len(ids)
        following, preceding = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, at) for at, pair in enumerate(zip(ids, ids[1:])) if (r := rank(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            low, at = heapq.heappop(heap)
            right = following[at]
            # an entry is void once one of its two symbols has been merged away or changed
            if ids[at] < 0 or right >= n or rank((ids[at], ids[right])) != low:
                continue
            ids[at], ids[right] = self.merged[low], -1
            following[at] = after = following[right]
            if after < n:
                preceding[after] = at
                if (r := rank((ids[at], ids[after]))) is not None:
                    heapq.heappush(heap, (r, at))
            before = preceding[at]
            if before >= 0 and (r := rank((ids[before], ids[at]))) is not None:
                heapq.heappush(heap, (r, before))
        return [i for i in ids if i >= 0]


# ---- encoding ---------------------------------------------------------------

# fixed values: the tokenizer's pre-token pattern and the byte alphabet's printable bytes
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
ODD_SPACE = r"[\t-\r \x85\xa0  -     　]+"


class Encoder:
    """Ids of texts by one tokenizer file (its JSON text), as the library gives them."""

    def __init__(self, tokenizer_json: str, lexicon: Lexicon | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Regex, Tokenizer
        from tokenizers.pre_tokenizers import Split

        conf = json.loads(tokenizer_json)
        conf["truncation"] = conf["padding"] = None
        self.tokenizer = Tokenizer.from_str(json.dumps(conf))
        self.model, self.lexicon = self.tokenizer.model, lexicon
        self.merges = Merges(conf["model"]) if lexicon is not None else None
        self.normalise = self.tokenizer.normalizer.normalize_str
        # characters by class, as the library and as the pattern here see them
        self.classes = [(Split(Regex(c), "removed").pre_tokenize_str, regex.compile(c).fullmatch)
                        for c in (r"\p{L}", r"\p{N}", r"\s")]
        self.alike: dict[str, bool] = {}
        self.to_library = 0  # runs that went to the library whole
        self.words, self.odd_space = regex.compile(WORDS).findall, regex.compile(ODD_SPACE)
        special = [t["content"] for t in conf["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.beyond = regex.compile("[^\x00-ɏ]").search
        spare = iter(range(256, 512))
        self.alphabet = [chr(b) if b in set(PRINTABLE) else chr(next(spare)) for b in range(256)]
        self.runs: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.tokens = [""] * (1 + max(self.tokenizer.get_vocab(True).values()))
        for token, i in self.tokenizer.get_vocab(True).items():
            self.tokens[i] = token

    def split(self, text: str) -> list[str]:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # str.split() cuts there, the model does not
            return [x for x in self.odd_space.split(text) if x]
        return text.split()

    def merge(self, word: str) -> list[int]:
        """A normalised word's ids by the merge table (by the library, for an
        encoder without a lexicon)."""
        symbols = [self.alphabet[b] for b in word.encode()]
        return self.merges.ids(symbols) if self.merges else [t.id for t in self.model.tokenize("".join(symbols))]

    def checked(self, word: str) -> list[int] | None:
        """A word's ids if the library gives it the same, as a word of its own."""
        ids = self.merge(word)
        return ids if ids == self.tokenizer.encode(word, add_special_tokens=False).ids else None

    def classed_alike(self, text: str) -> bool:
        """Whether every character is of the same class for the library and here."""
        for c in set(text):
            known = self.alike.get(c)
            if known is None:
                # the library removes what matches: nothing is left of a character of the class
                known = self.alike[c] = all((not library(c)) == bool(here(c)) for library, here in self.classes)
            if not known:
                return False
        return True

    def run_words(self, run: str) -> list[str] | None:
        """The run's normalised words, or None if the library has to decide."""
        if self.special and "<" in run and self.special.search(run):
            return None
        if not self.beyond(run):
            return self.words(run.lower())
        normal = self.normalise(run)
        return self.words(normal) if self.classed_alike(normal) else None

    def word(self, word: str) -> bytes:
        held = self.pieces.get(word)
        if held is None:
            ids = self.lexicon.get(word.encode()) if self.lexicon else None
            held = bytes(ids) if ids is not None else np.array(self.merge(word), "<u4").tobytes()
            if len(self.pieces) >= HELD_RUNS:
                self.pieces.clear()
            self.pieces[word] = held
        return held

    def run(self, run: str) -> bytes:
        words = self.run_words(run)
        if words is None:
            self.to_library += 1
            return np.array(self.tokenizer.encode(run, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join([self.word(w) for w in words])

    def encode(self, text: str) -> bytes:
        """Ids of the whole text as little-endian unsigned 32-bit integers."""
        out, runs, held = [], self.runs, self.runs.get
        for run in self.split(text):
            ids = held(run)
            if ids is None:
                ids = self.run(run)
                if len(runs) >= HELD_RUNS:
                    runs.clear()
                runs[run] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The library's decode for a file without a decoder: tokens with a blank between."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def worker_encoder(broadcast_json, lexicon_name: str | None = None) -> Encoder:
    """This Python worker's encoder; kept between tasks."""

    def make() -> Encoder:
        return Encoder(broadcast_json.value, Lexicon.mapped(SparkFiles.get(lexicon_name)) if lexicon_name else None)

    return kept(("encoder", lexicon_name), make)


# ---- the operator -----------------------------------------------------------

def frequent_words(docs: DataFrame, tokenizer, share: float = FREQUENT) -> dict[bytes, list[int]]:
    """The corpus' frequent words with their ids. Every task counts its runs and
    passes on those with at least `share` of them, so a run that frequent in the
    corpus is passed on by some task, and no task passes on more than 1/share."""

    def count(batches):
        held, n = Counter(), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                runs = text.split()
                n += len(runs)
                held.update(runs)
            if len(held) > 4 * HELD_RUNS:  # keep the counters of a very long task bounded
                held = Counter({w: c for w, c in held.items() if c >= max(2, share * n)})
        top = [(w, c) for w, c in held.items() if c >= max(2, share * n)]
        encoder, words = worker_encoder(tokenizer), Counter()
        for run, c in top:
            for w in encoder.run_words(run) or ():
                words[w] += c
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64()),
             pa.array([n] * len(words), pa.int64())], names=["word", "c", "n"])

    counted = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "word string, c long, n long")
    summed = counted.groupBy("word").agg(F.sum("c").alias("c"), F.max("n").alias("n"))
    encoder = Encoder(tokenizer.value, Lexicon(compile_lexicon({})))
    # at most 1/share words of any task are this frequent; a run in hand bounds the sum
    kept = summed.where(F.col("c") >= share * F.col("n")).orderBy(F.desc("c"), "word").limit(int(1 / share))
    found = ((r.word.encode(), encoder.checked(r.word)) for r in kept.select("word").collect())
    return {word: ids for word, ids in found if ids is not None}


def send_lexicon(spark: SparkSession, buffer: bytes) -> str:
    """Writes the compiled lexicon to the shared folder and adds it to the
    application's files, so that every executor maps a copy; its name there."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'lexicon')}/{name}")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(path)
    try:
        out.write(bytearray(buffer))
    finally:
        out.close()
    spark.sparkContext.addFile(store.makeQualified(path).toString())
    return name


def encode(docs: DataFrame, tokenizer_path: str, lexicon: bool = True) -> DataFrame:
    """doc_id, ids (u32 little-endian, binary) and decoded text of every row."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())  # a vocabulary file: its size is the file's
    name = send_lexicon(spark, compile_lexicon(frequent_words(docs, tokenizer))) if lexicon else None

    def run(batches):
        encoder = worker_encoder(tokenizer, name)
        for b in batches:
            for doc_id, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = encoder.encode(body.decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), pa.array([ids], pa.binary()),
                     pa.array([encoder.decode(ids)], pa.string())], names=["doc_id", "ids", "decoded"])

    return id_and_bytes(docs).mapInArrow(run, "doc_id long, ids binary, decoded string")


def encoded_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row. The digests are
    taken where the ids are made, so ids and decoded texts do not leave the worker."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())
    name = send_lexicon(spark, compile_lexicon(frequent_words(docs, tokenizer)))

    def run(batches):
        encoder = worker_encoder(tokenizer, name)
        for b in batches:
            n, of_ids, of_text = [], [], []
            for body in b.column(1).to_pylist():
                ids = encoder.encode(body.decode("utf-8", "replace"))
                n.append(len(ids) // 4)
                of_ids.append(sha256(ids).hexdigest())
                of_text.append(sha256(encoder.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_bytes(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
