"""Language identification by language-bitmask n-gram filters.

Training texts give every language's letter n-grams and their counts; an n-gram
belongs to a language if it makes up at least `share` of the language's n-grams,
so a language has at most 1/share of them at any corpus size. All languages share
one Bloom filter laid out by bit slices: each row holds one bit per language, and
the AND of an n-gram's rows is the set of languages that have it, in one lookup
whatever the number of languages. A text's n-grams are looked up, each language's
bits are counted, the count is corrected for the share of false positives its
column gives, and the language with the largest share wins.

Defined cases: a null text, or one without a letter, is `und` with score 0; a
text none of whose n-grams is known gets the first language, with score 0; rows
without a language do not train, and with no training row at all every text is
`und`; a null doc_id is kept; repeated rows are predicted each.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from weir.llm.common import forget, give_back, id_fold

ORDERS = (3, 4)
SHARE = 1e-5  # so a language has at most 100,000 n-grams of any corpus
HASHES = 4
BITS_PER_GRAM = 12
HELD = 250_000  # runs a worker keeps the counts of
FIELD = 40  # bits of each counter in a packed sum: texts up to 10^12 n-grams


def letter_runs(run: str, letters) -> list[str]:
    return [run] if run.isalpha() else letters(run)


def grams(word: str) -> list[str]:
    padded = f" {word} "
    out = []
    for n in ORDERS:
        out += [padded[i:i + n] for i in range(len(padded) - n + 1)]
    return out


def filter_rows(gram: str, rows: int) -> list[int]:
    import xxhash

    h = xxhash.xxh3_64_intdigest(gram)
    a, b = h & 0xFFFFFFFF, h >> 32 | 1
    return [(a + k * b) % rows for k in range(HASHES)]


class BitmaskFilter:
    """languages: names in order; table: one bitmask row of u64 words per slot."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table
        bits = np.unpackbits(np.ascontiguousarray(table).view(np.uint8), axis=1, bitorder="little")
        fill = bits[:, :len(languages)].mean(axis=0) if len(table) else np.zeros(len(languages))
        self.false_share = fill ** HASHES

    @classmethod
    def build(cls, languages: list[str], members: list[tuple[str, str]]) -> BitmaskFilter:
        most = max(Counter(lang for lang, _ in members).values(), default=1)
        rows = 1 << max(6, (BITS_PER_GRAM * most - 1).bit_length())
        words = -(-max(1, len(languages)) // 64)
        table, index = np.zeros((rows, words), np.uint64), {x: i for i, x in enumerate(languages)}
        for lang, gram in members:
            i = index[lang]
            for r in filter_rows(gram, rows):
                table[r, i // 64] |= np.uint64(1 << i % 64)
        return cls(languages, table)

    def holders(self, gram: str) -> int:
        """Bitmask of the languages that have the n-gram (or seem to)."""
        mask = np.bitwise_and.reduce(self.table[filter_rows(gram, len(self.table))], axis=0)
        return int.from_bytes(mask.tobytes(), "little")


class Counting:
    """Counts n-grams and their languages of texts; one packed integer per run
    (n-grams, then one field per language), kept while a worker lives."""

    def __init__(self, bitmask: BitmaskFilter):
        import regex

        self.filter, self.letters = bitmask, regex.compile(r"\p{L}+").findall
        self.of_run: dict[str, int] = {}
        self.of_gram: dict[str, int] = {}

    def run(self, run: str) -> int:
        total, held = 0, self.of_gram
        for word in letter_runs(run, self.letters):
            for g in grams(word):
                v = held.get(g)
                if v is None:
                    mask, v, i = self.filter.holders(g), 1, 0
                    while mask:
                        if mask & 1:
                            v |= 1 << FIELD * (i + 1)
                        mask >>= 1
                        i += 1
                    if len(held) >= HELD:
                        held.clear()
                    held[g] = v
                total += v
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        total, held = 0, self.of_run
        for run in (text or "").lower().split():
            v = held.get(run)
            if v is None:
                if len(held) >= HELD:
                    held.clear()
                v = held[run] = self.run(run)
            total += v
        field = (1 << FIELD) - 1
        n, names = total & field, self.filter.languages
        if not n or not names:
            return "und", 0.0
        hits = np.array([(total >> FIELD * (i + 1)) & field for i in range(len(names))], float)
        wrong = self.filter.false_share
        share = np.clip((hits / n - wrong) / np.maximum(1 - wrong, 1e-9), 0, 1)
        best = int(share.argmax())
        return names[best], float(share[best])


def learn(docs: DataFrame, learns: Column, share: float = SHARE) -> BitmaskFilter:
    """The filter of the rows for which `learns` holds and whose lang is known."""

    def count(batches):
        import regex

        forget()
        letters, held = regex.compile(r"\p{L}+").findall, {}

        def flush():
            langs, names, times = [], [], []
            for lang, runs in held.items():
                by_word, by_gram = Counter(), Counter()
                for run, c in runs.items():
                    for w in letter_runs(run, letters):
                        by_word[w] += c
                for w, c in by_word.items():
                    for g in grams(w):
                        by_gram[g] += c
                langs += [lang] * len(by_gram)
                names += by_gram.keys()
                times += by_gram.values()
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(names, pa.string()), pa.array(times, pa.int64())],
                names=["lang", "gram", "c"])

        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(lang, Counter()).update(text.lower().split())
            if sum(map(len, held.values())) > HELD:
                yield flush()
        yield flush()
        give_back()

    rows = docs.where(learns & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "text", F.col("lang").cast("string").alias("lang"))
    counted = rows.mapInArrow(count, "lang string, gram string, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))
    totals = counted.groupBy("lang").agg(F.sum("c").alias("total"))
    common = counted.join(F.broadcast(totals.withColumnRenamed("lang", "of_lang")), F.col("lang") == F.col("of_lang"))
    kept = common.where(F.col("c") >= share * F.col("total")).select("lang", "gram").toArrow()
    members = sorted(zip(kept.column(0).to_pylist(), kept.column(1).to_pylist()))
    # a text without letters gives its language no n-gram, but the language is learned all the same
    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())
    return BitmaskFilter.build(languages, members)


def predict(docs: DataFrame, bitmask: BitmaskFilter, columns: list[Column]) -> DataFrame:
    """The given columns of `docs` (as c0, c1, ...), then lang_pred and score."""
    sent = docs.sparkSession.sparkContext.broadcast((bitmask.languages, bitmask.table))  # 1/share n-grams a language
    names = [*(f"c{i}" for i in range(len(columns))), "lang_pred", "score"]
    frame = docs.select(F.col("text"), *[c.alias(f"c{i}") for i, c in enumerate(columns)])

    def run(batches):
        forget()
        counting = Counting(BitmaskFilter(*sent.value))
        for b in batches:
            found = [counting.predict(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=names)
        del counting
        give_back()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields[1:])
    return frame.mapInArrow(run, f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; rows whose id's crc32 is
    divisible by five are held out of training."""
    held_out = id_fold() == 0
    out = predict(docs, learn(docs, ~held_out), [F.col("doc_id").cast("long"), held_out])
    return out.select(F.col("c0").alias("doc_id"), F.col("c1").alias("held_out"), "lang_pred", "score")
