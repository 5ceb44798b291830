import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from skygauge.llm import multikey, phrases

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())])


def brute_force(rows, least, top):
    counts, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    found = []
    for (lang, *words), a in counts.items():
        if len(words) < 2 or a < least:
            continue
        longer = [f for (other, *g), f in counts.items() if len(words) == 2 and other == lang and len(g) == 3 and f >= least and words in (g[:2], g[1:])]
        if any(100 * f >= 50 * a for f in longer):
            continue
        cuts = [(1000000 * a * a // (counts[lang, *words[:k]] * counts[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found.append((lang, -score, -a, " ".join(words).encode(), counts[lang, *words[:k]], counts[lang, *words[k:]]))
    out, place = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        place[lang] += 1
        if place[lang] <= top:
            out.append((lang, place[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return out


def made(rng, n, vocabulary):
    ends = [" ", " ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\x0b", "!"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(rng.randrange(0, 60)))
        if rng.random() < 0.5:
            text += " The Quick\tfox"
        rows.append((i, rng.choice([text, text, text, None, ""]), rng.choice(["en", "de", None])))
    return rows


@pytest.mark.parametrize("heavy", [1000, 20])
def test_against_brute_force(spark, monkeypatch, heavy):
    """With a low bound for frequent words all three kinds of routes occur."""
    monkeypatch.setattr(phrases, "HEAVY", heavy)
    monkeypatch.setattr(phrases, "BUCKET", 50)
    rng = random.Random(heavy)
    vocabulary = ["a", "a", "a", "the", "the", "The", "of", "É", "é", "ß", " x", "\x1cy", "n-gram", "o'c", *(f"w{i}" for i in range(25))]
    rows = made(rng, 250, vocabulary)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = phrases.collocations(docs, top=40)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for _, t in found.dtypes[3:]} == {"bigint"}
    want = brute_force(rows, 10, 40)
    assert len({w[0] for w in want}) == 3 and any(w[2].count(" ") == 2 for w in want)
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_frequent_words_are_routed_by_what_follows():
    coded = phrases.words_of([" . ".join([f"a x{i} y" for i in range(50)] + [f"a a z{i}" for i in range(50)] + ["q r s"] * 3)])
    codes, n = phrases.counted(coded)
    hashed = phrases.hashes(coded.dictionary, "en")
    a, y = (hashed[coded.dictionary.to_pylist().index(w)] for w in "ay")
    route, depth = phrases.routes(codes, hashed, np.sort(np.array([a, y])))
    first, second = codes[0] == coded.dictionary.to_pylist().index("a"), codes[1] == coded.dictionary.to_pylist().index("a")
    assert (depth[first & second] == 3).all() and (depth[first & ~second] == 2).all() and (depth[~first] <= 2).all()
    assert len(set(route[first])) == 50 + 50 + 50 and n.max() == 50 and n.sum() == 309
    assert (phrases.routes(codes, hashed, np.zeros(0, np.uint64))[1] == 1).all()


def test_blocks_of_suffixes_are_read_back():
    coded = phrases.words_of(["a b c. b c. é", "c " * 300, "x1 x2 x3"])
    codes, n = phrases.counted(coded)
    depth = np.arange(len(n), dtype=np.int8) % 3
    words, own, weight, deep = phrases._unpacked(phrases._packed(coded.dictionary, codes, n, depth))
    plain = [w.encode() for w in coded.dictionary.to_pylist()]
    assert [[words[c] for c in row] for row in own.tolist()] == [[plain[c] for c in row] for row in codes.tolist()]
    assert weight.tolist() == n.tolist() and deep.tolist() == depth.tolist()


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10**12 + 1
    rows = [("en", "a", None, None, big), ("en", "a", "b", None, big), ("en", "a", "b", "c", big), ("en", "b", None, None, big + 5), ("en", "b", "c", None, big + 5),
            ("en", "c", None, None, big + 7)]
    monkeypatch.setattr(phrases, "frequent", lambda rows_, least: spark.createDataFrame(rows, phrases.SUFFIX))
    monkeypatch.setattr(phrases, "word_counts", lambda docs: spark.createDataFrame([("en", "a", 1, 3 * big)], "lang string, w1 string, hash long, n long"))
    found = [tuple(r) for r in phrases.collocations(spark.createDataFrame([], SCHEMA)).collect()]
    score = 10**6 * big * big // (big * (big + 5))  # equal to that of the second cut after flooring
    assert found == [("en", 1, "a b c", big, big, big + 5, 3 * big, score)]


def test_one_word_repeated_and_a_very_long_word(spark):
    long = "k" * 300_000
    rows = [(1, "go " * 3000, "en"), (2, f"{long} {long} " * 6, None), (2, f"{long} {long} " * 6, None)]
    found = {(r.lang, len(r.phrase)): r for r in phrases.collocations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found["en", 8].a == 2998 and found["en", 8].n == 3000
    assert found["und", 3 * 300_000 + 2].a == 20 and len(found) == 2


def test_empty_table_and_extra_columns(spark):
    schema = T.StructType([*SCHEMA, T.StructField("n", T.LongType()), T.StructField("w1", T.StringType())])
    assert phrases.collocations(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "new york " * 30, "en", 5, "x")]
    assert phrases.collocations(spark.createDataFrame(rows, schema)).count() == 2


def test_quicksort_against_counting():
    rng = np.random.default_rng(1)
    for n, size in ((0, 1), (1, 3), (60, 3), (5000, 25)):
        keys = rng.integers(0, size, (3, n))
        short = rng.random(n) < 0.1
        keys[2, short] = -1
        keys[1:, rng.random(n) < 0.05] = -1
        weight = rng.integers(1, 4, n)
        for depth, (at, w) in enumerate(multikey.heavy_prefixes(keys, weight, (1, 5, 10)), 1):
            want = Counter()
            for row, x in zip(keys[:depth].T.tolist(), weight.tolist()):
                if min(row) >= 0:
                    want[tuple(row)] += x
            assert {tuple(keys[:depth, i]): x for i, x in zip(at, w)} == {k: x for k, x in want.items() if x >= (1, 5, 10)[depth - 1]}
