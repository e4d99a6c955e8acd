"""Tokenizing, packing, language ID and scoring on small fixtures."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from weir.llm import bpe, ctw, langid, packing

from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  ", "a\x1cb c\x85d", "İstanbul ΣΑΣ Σ", "it's we'll 'S x'T", "<|endoftext|>abc <|startoftext|>",
       "a<|endoftext|>'s", "é é ́a", "日本語 テキスト 123 ٣٤", "foo\x00bar​q", "ǅ ŉ ß ẞ ﬁ", "K Å",
       "x　y", "1234 ½ ² x²", "a_b__c -- 'd", "🙂 ok🙂", "<|endoftext", "'re're", "x" * 30_000]
SCHEMA = "doc_id long, text string, ids string, length int, score int"  # the last three clash with our names


def _documents(spark, texts):
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)] + [(None, "null id", "x", 1, 2), (0, texts[0], "x", 1, 2)]
    return spark.createDataFrame(rows, SCHEMA), [(r[0], r[1]) for r in rows]


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + ODD + [None]


def test_lexicon_holds_words_and_shares_suffixes():
    words = {w.encode(): [i, 7] for i, w in enumerate(["nation", "station", "ration", "a", "an", "é"])}
    buffer = bpe.compile_lexicon(words)
    lexicon = bpe.Lexicon(buffer)
    assert all(list(lexicon.get(w)) == ids for w, ids in words.items())
    assert [lexicon.get(w) for w in (b"", b"nat", b"nations", b"\xc3", b"zz")] == [None] * 5
    assert len(lexicon.final) < sum(map(len, words)) + 1 - 10  # states of "ation" exist once
    assert bpe.Lexicon(bpe.compile_lexicon({})).get(b"a") is None


def test_bpe_is_the_library_and_decodes(spark, texts):
    df, rows = _documents(spark, texts)
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, bpe.encoded_digests(df, PATH).collect()), key=repr) == sorted(want, key=repr)
    whole = {r.doc_id: r for r in bpe.encode(df.where("doc_id < 5"), PATH).collect()}
    assert all(tokenizer.decode(np.frombuffer(bytes(r.ids), "<u4").tolist(), skip_special_tokens=False) == r.decoded
               for r in whole.values())
    assert bpe.encoded_digests(df.limit(0), PATH).collect() == []


SCRIPTS = ["Привет, МИР! Ёжик й й", "Καλημέρα ΣΟΦΟΣ ὈΔΥΣΣΕΎΣ άλφα", "日本語の文章と漢字、カタカナ。", "“curly” ‘quotes’—and… it’s l’été",
           "한국어 문장", "عربى نص ١٢٣", "हिन्दी १२", "İstanbul ŞIŞLI ẞ ﬁ Å Å ½ Ⅷ", "emoji 😀👩‍👩‍👧 🇫🇮", "zero\u200bwidth \u2028line\u3000wide",
           "mixed Ω<|endoftext|>ж <|startoftext|>", "\ua7aaꭰᏸ 𐐀𐐨 𞤀 \u0378\U000e0001", "x" * 30_000 + "Ж" * 3000]


def test_own_merges_and_any_script_equal_the_library(spark, texts):
    import json

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    library = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    with open(PATH, encoding="utf-8") as f:
        conf = f.read()
    empty = bpe.Encoder(conf, bpe.Lexicon(bpe.compile_lexicon({})))
    rng = random.Random(4)
    noise = ["".join(chr(rng.choice([rng.randint(33, 126), rng.randint(0xA1, 0x2FF), rng.randint(0x370, 0x1FFF), rng.randint(0x3000, 0xD7FF),
                                     rng.randint(0x1F300, 0x1FAFF)])) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    for text in [*SCRIPTS, *noise, *[t for t in texts[:50] if t]]:
        assert np.frombuffer(empty.encode(text), "<u4").tolist() == library(text), text
    assert empty.to_library < 0.2 * len(noise)
    merges = bpe.Merges(json.loads(conf)["model"])
    for text in texts[:20]:
        for w in empty.words((text or "").lower())[:300]:
            symbols = [empty.alphabet[b] for b in w.encode()]
            known = [t.id for t in empty.model.tokenize("".join(symbols))]
            parts = [merges.inner[c] for c in symbols[:-1]] + [merges.last[symbols[-1]]]
            assert merges.ids(symbols) == merges._short(list(parts)) == merges._long(list(parts)) == known

    df = spark.createDataFrame([(i, t) for i, t in enumerate(SCRIPTS * 3)], "doc_id long, text string")
    tokens = spark.sparkContext.broadcast(conf)
    words = bpe.frequent_words(df.coalesce(1), tokens)
    for word in ("привет", "日本語の文章と漢字", "καλημέρα", "“", "한국어"):
        assert words[word.encode()] == library(word)
    got = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in bpe.encode(df, PATH).collect()}
    assert got == {i: library(t) for i, t in enumerate(SCRIPTS * 3)}


def test_packing_places_every_piece(spark, texts):
    df, rows = _documents(spark, texts)
    tokenizer, want = Tokenizer.from_file(PATH), []
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 256):
            part = ids[k:k + 256]
            want.append((d, k // 256, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = packing.pack(df, PATH, capacity=256).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 256
    least = math.ceil(sum(w[3] for w in want) / 256)
    assert len(places) <= 1.02 * least + 1
    assert packing.pack(df.limit(0), PATH).collect() == []


@pytest.mark.parametrize("counts", [{6: 10, 4: 10}, {7: 5, 5: 9, 3: 4, 2: 1, 1: 3}, {10: 4}, {9: 3}, {}, {4: 1}])
def test_plan_covers_the_histogram(counts):
    plan = packing.pack_plan(dict(counts), 10)
    held = Counter()
    for content, n in plan:
        assert sum(content) <= 10
        for s in content:
            held[s] += n
    assert held == Counter(counts)
    assert sum(n for _, n in plan) <= sum(n for _, n in packing.best_fit(dict(counts), 10))


def _fewest(pieces, capacity):
    """The least number of sequences, by search over all packings."""
    best = [len(pieces)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(pieces):
            best[0] = len(bins)
            return
        for space in sorted(set(bins)):
            if space >= pieces[i]:
                rest = list(bins)
                rest.remove(space)
                place(i + 1, [*rest, space - pieces[i]])
        place(i + 1, [*bins, capacity - pieces[i]])
    place(0, [])
    return best[0]


def test_plan_against_the_optimum_of_small_histograms():
    rng = np.random.default_rng(11)
    beyond = 0
    for _ in range(120):
        capacity = int(rng.integers(8, 25))
        pieces = sorted(rng.integers(1, capacity, size=rng.integers(1, 11)).tolist(), reverse=True)
        counts, fewest = dict(Counter(pieces)), _fewest(pieces, capacity)
        found = packing.sequences(packing.pack_plan(dict(counts), capacity))
        _, bound = packing.solve(counts, capacity, len(pieces))
        assert bound <= fewest + 1e-9 and fewest <= found <= fewest + 1
        beyond += found > fewest
    assert beyond <= 6


def test_the_program_places_most_pieces_and_nears_its_bound():
    rng = np.random.default_rng(12)
    many = Counter(np.clip(rng.lognormal(6.2, 0.7, 20_000), 20, 2047).astype(int).tolist())
    alone = packing.sequences(packing.best_fit(dict(many), 2048))
    plan, left, bound = packing.by_program(dict(many), 2048, 0.1, alone)
    assert sum(left.values()) <= 0.1 * sum(many.values())
    whole = packing.sequences(packing.pack_plan(dict(many), 2048))
    assert bound <= whole <= 1.005 * bound + 1 and whole <= alone
    tight = Counter(rng.integers(500, 1100, 20_000).tolist())  # best fit wastes space here
    assert packing.sequences(packing.pack_plan(dict(tight), 2048)) < 0.98 * packing.sequences(packing.best_fit(dict(tight), 2048))


def test_long_texts_are_cut_at_the_production_capacity(spark):
    text = "the house by the river stands under every bright morning " * 2000
    got = packing.pack(spark.createDataFrame([(1, text), (2, "a"), (3, None)], "doc_id long, text string"), PATH).collect()
    n = len(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids) + 1
    mine = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == 1)
    assert mine == [(i, 2048 * i, min(2048, n - 2048 * i)) for i in range(math.ceil(n / 2048))] and n > 3 * 2048


def test_sequences_hold_the_ids_of_the_library(spark, texts):
    df, rows = _documents(spark, texts[:60] + ODD + [None, "", texts[0] * 30])
    got = packing.pack(df, PATH, capacity=256, ids=True).collect()
    sequences = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        held = sequences.setdefault(r.sequence_id, [])
        assert r.offset == len(held) and r.length == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        held += r.ids
    assert max(map(len, sequences.values())) <= 256
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want += [(d, k // 256, tuple(ids[k:k + 256])) for k in range(0, len(ids), 256)]
    read = [(r.doc_id, r.piece, tuple(sequences[r.sequence_id][r.offset:r.offset + r.length])) for r in got]
    assert sorted(read, key=repr) == sorted(want, key=repr)


def test_language_held_out_accuracy(spark):
    df = spark.read.parquet(SF_SMALL.replace("0.001", "0.01") + "/documents.parquet")
    out = langid.identify(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in out)
    held = [r.lang == r.lang_pred for r in out if r.held_out]
    assert sum(held) >= 0.97 * len(held)


def test_language_edge_cases(spark):
    base = [(i, "the cat and the dog " * 3, "en") for i in range(20)] + [(20 + i, "der hund und die katze " * 3, "de") for i in range(20)]
    odd = [(100, None, "en"), (101, "", None), (102, "123 !? ½", "de"), (103, "日本語", None), (None, "the dog", None),
           (104, "und die katze " * 50_000, None), (0, base[0][1], "en")]
    df = spark.createDataFrame([(*r, 1, "x") for r in base + odd], "doc_id long, text string, lang string, score int, gram string")
    out = sorted(((r.doc_id, r.lang_pred) for r in langid.identify(df).collect()), key=repr)
    want = sorted([(d, g) for d, _, g in base] + [(100, "und"), (101, "und"), (102, "und"), (103, "de"), (None, "en"),
                                                 (104, "de"), (0, "en")], key=repr)
    assert out == want
    assert langid.identify(df.limit(0)).collect() == []
    unlabelled = langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


def _tree_scores(docs, depth=ctw.DEPTH):
    """Context-tree weighting by its definition, with dictionaries."""
    learns = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1

    def decisions(text):
        data = bytes([254]) * depth + (text or "").encode() + b"\xff"
        for i in range(depth, len(data)):
            for k in range(8):
                yield data[i - depth:i][::-1], 1 << k | data[i] >> (8 - k), data[i] >> (7 - k) & 1

    count = {}
    for d, t in docs:
        if learns(d):
            for context, node, bit in decisions(t):
                for n in range(depth + 1):
                    count.setdefault((context[:n], node), [0, 0])[bit] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    below, share = {}, {}
    for key in sorted(count, key=lambda k: -len(k[0])):
        own = total = kt(*count[key])
        share[key] = 1.0
        if len(key[0]) < depth:
            total = np.logaddexp(own, below[key]) - math.log(2)
            share[key] = math.exp(own - math.log(2) - total)
        up = (key[0][:-1], key[1])
        if key[0]:
            below[up] = below.get(up, 0.0) + total
    words = Counter()
    for d, t in docs:
        if learns(d):
            words.update([*(t or "").encode().lower().split(), None])
    n, v = sum(words.values()), len(words)
    out = []
    for d, t in docs:
        score = 0.0
        for context, node, bit in decisions(t):
            p = 0.5
            for k in range(depth, -1, -1):
                c = count.get((context[:k], node))
                if c:
                    w = share[context[:k], node]
                    p = w * (c[bit] + 0.5) / (sum(c) + 1) + (1 - w) * p
            score += math.log10(p)
        tokens = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        out.append((d, not learns(d), len(tokens), sum(words[w] > 0 for w in tokens), n, base, score))
    return out


def test_context_tree_weighting_by_definition(spark, texts):
    df, rows = _documents(spark, [t and t[:400] for t in texts[:25]] + ODD[:8] + [None])
    got = sorted(map(tuple, ctw.score(df).collect()), key=repr)
    want = sorted(_tree_scores(rows), key=repr)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    assert ctw.score(df.limit(0)).collect() == []


def test_prediction_is_the_ratio_of_weighted_probabilities(spark):
    """A one-byte text after training: the whole tree's probability with it over without."""
    learns = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = next(i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1)
    rows = [(i, t) for i, t in zip(learns, ["abab", "abba", "b", "", "aab ba", "ab" * 40])]

    def log_weighted(decisions):
        """log10 of the weighted probability of (context, node, bit) decisions, by recursion."""
        def at(seen, n):
            own = _log_kt(sum(not b for _, b in seen), sum(b for _, b in seen))
            if n == ctw.DEPTH:
                return own
            children = {}
            for c, b in seen:
                children.setdefault(c[n], []).append((c, b))
            return np.logaddexp(own, sum(at(v, n + 1) for v in children.values())) - math.log(2)

        nodes = {}
        for c, node, b in decisions:
            nodes.setdefault(node, []).append((c, b))
        return sum(at(v, 0) for v in nodes.values()) / math.log(10)

    def decisions(text):
        data = bytes([254]) * ctw.DEPTH + text.encode() + b"\xff"
        return [(data[i - ctw.DEPTH:i][::-1], 1 << k | data[i] >> (8 - k), data[i] >> (7 - k) & 1)
                for i in range(ctw.DEPTH, len(data)) for k in range(8)]

    before = [d for _, t in rows for d in decisions(t)]
    for text in ("", "a", "z"):
        got = {r.doc_id: r.score for r in ctw.score(spark.createDataFrame(
            [*rows, (held, text)], "doc_id long, text string")).collect()}[held]
        # of the text's bytes, each is predicted from the training texts alone
        want = sum(log_weighted(before + decisions(text)[k:k + 8]) - log_weighted(before)
                   for k in range(0, len(decisions(text)), 8))
        assert got == pytest.approx(want, abs=1e-9)


def _log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


def test_tree_scores_with_a_hot_null_id_in_many_blocks(spark, monkeypatch):
    """A third of all rows under a null id, blocks and shards by the text."""
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 300)
    monkeypatch.setattr(ctw, "SHARD_BYTES", 200)
    rng = np.random.default_rng(4)
    rows = [(None if i % 3 == 0 else i, " ".join(rng.choice(["ab", "the", "né", "of x"], 20))) for i in range(120)]
    rows += [(None, "long " * 900), (7, None), (7, "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, tie int")
    got = sorted(map(tuple, ctw.score(df).collect()), key=repr)
    want = sorted(_tree_scores(rows), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_nothing_to_train_on(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    df = spark.createDataFrame([(i, "ab") for i in ids], "doc_id long, text string")
    assert {(r.train_tokens, r.n_known, round(r.score, 6)) for r in ctw.score(df).collect()} == {
        (0, 0, round(24 * math.log10(0.5), 6))}


def test_a_worker_keeps_one_operators_things_and_lets_go_of_them():
    import weakref

    from weir.llm.common import forget, kept

    class Thing:
        pass

    first = weakref.ref(kept("a", Thing))
    assert kept("a", Thing) is first()
    second = weakref.ref(kept("b", Thing))
    assert first() is None and second() is not None
    forget()
    assert second() is None
