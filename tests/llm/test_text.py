"""Corpus operators on texts, against brute force, libraries and hand-made cases."""

import cProfile
import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skygauge.llm import bpe, chat, langid, minhash, packing, pieces, quality, suffix, toxicity, words

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, k_text string"
SMALL = "/root/testdata/sf0.001"
ODD = ["", " ", "  a", "a ", "\n", "\n\n a", "▁", "a▁b", "日本語 テキスト", "é" * 300, "x" * 5000, " " * 50, "<s></s><unk><0x41>", "🙂🙂 ok", "\u0000a", "a b\r\n", "It's we'll I'D",
       "<|endoftext|> a", "ΟΔΟΣ", "a\x1cb", "é Å ﬁ"]


def docs(spark, texts, start=0, langs=None):
    rows = [(start + i, t, (langs or {}).get(i), "s", None if t is None else len(t), 0.5, 7, "k") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC).repartition(3)


def prose(rng, n, kind="en"):
    parts = {"en": ["the", "th", "ing", "er", "and", "wh"], "fr": ["eau", "le", "é", "ment", "que", "oi"]}[kind]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


# --- language

def test_language_of_clear_odd_and_missing_texts(spark):
    rng = random.Random(1)
    train = docs(spark, [prose(rng, 200, k) for k in ("en", "fr") * 20], langs={i: ("en", "fr")[i % 2] for i in range(40)})
    found = langid.learn(train)
    assert sorted(found) == ["en", "fr"]
    texts = [prose(rng, 60), prose(rng, 60, "fr"), None, "", "123 !? 🙂", prose(rng, 30_000, "fr"), prose(rng, 60).upper()]
    rows = langid.predict(docs(spark, texts), found).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows] == ["en", "fr", "und", "und", "und", "fr", "en"]
    assert all(0 <= r.score <= 1 and r.rejected == (r.lang_pred == "und") for r in rows)
    assert langid.predict(docs(spark, []), found).count() == 0
    assert [r.lang_pred for r in langid.predict(docs(spark, ["abc"]), {}).collect()] == ["und"]
    assert [r.lang_pred for r in langid.predict(docs(spark, ["the thing"] * 2), {"b": b"xyz", "a": b"xyz"}).collect()] == ["a", "a"]  # a tie


def test_language_held_out(spark):
    rows = langid.op1(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.9


# --- quality and toxicity

def test_factorisation_machine_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    stats = rng.normal(size=(5, len(quality.STATS)))
    edges = np.quantile(rng.normal(size=(100, len(quality.STATS))), np.arange(1, quality.BINS) / quality.BINS, axis=0).T
    size = quality.BUCKETS + len(quality.STATS) * quality.BINS
    machine = quality.Machine(edges, 0.1, rng.normal(size=size), rng.normal(0, 0.3, (size, quality.FACTORS)))
    doc, bucket, weight = np.array([0, 0, 1, 4]), np.array([3, 9, 9, 100]), np.array([0.5, 0.8, 1.0, 1.0])
    got = machine.score(doc, bucket, weight, stats)
    at = quality.binned(stats, edges)
    for i in range(5):
        x = {int(k): 1.0 for k in at[i]} | {int(b): float(w) for d, b, w in zip(doc, bucket, weight) if d == i}
        names = sorted(x)
        total = machine.bias + sum(machine.linear[k] * x[k] for k in names)
        total += sum(machine.factors[a] @ machine.factors[b] * x[a] * x[b] for m, a in enumerate(names) for b in names[m + 1:])
        assert got[i] == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_learns_and_survives_odd_tables(spark):
    rng = random.Random(2)
    good, bad = [prose(rng, 80) for _ in range(60)], [prose(rng, 3) * 1 + " zap zap zap !!! " * 30 for _ in range(60)]
    table = docs(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)] + [(3, None), (None, 1), (5, 0)], "doc_id long, quality int")
    machine = quality.learn(table, labels)
    rows = quality.score(docs(spark, [prose(rng, 80), "zap zap zap !!! " * 30, None, "", prose(rng, 40_000)]), machine).orderBy("doc_id").collect()
    assert rows[0].predicted == 1 and rows[1].predicted == 0 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert quality.score(docs(spark, []), machine).count() == 0
    one = quality.learn(table, labels.where("quality = 1"))
    assert {r.score for r in quality.score(docs(spark, ["a", None]), one).collect()} == {1.0}
    assert quality.learn(table, labels.limit(0)).bias == 0.5


def test_toxicity_learns_from_positives_and_unlabelled(spark):
    rng = random.Random(3)
    texts = [prose(rng, 60) + (" vile" + rng.choice(["", "ly", "ness"]) if i % 5 == 0 else "") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 300)] + [(7, None)], "doc_id long, toxic int")
    ensemble = toxicity.learn(docs(spark, texts), labels)
    rows = toxicity.score(docs(spark, [prose(rng, 60) + " vile", prose(rng, 60), prose(rng, 60) + " vilest", None, "", prose(rng, 40_000)]), ensemble).orderBy("doc_id").collect()
    assert [r.predicted for r in rows] == [1, 0, 1, 0, 0, 0] and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.learn(docs(spark, texts), labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(docs(spark, ["a", None]), none).collect()} == {0.0}
    assert toxicity.score(docs(spark, []), ensemble).count() == 0


def test_toxicity_and_quality_held_out(spark):
    labels = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    for query, column, floor in ((toxicity.op9, "toxic", 0.95), (quality.op8, "quality", 0.97)):
        rows = [r for r in query(spark, "/root/testdata/sf0.1").collect() if r.held_out and r.doc_id in labels]
        assert np.mean([r.predicted == labels[r.doc_id][column] for r in rows]) > floor


def test_words_are_lower_case_runs_of_letters():
    assert words.split("It’s ÀB, c_d 1x—y «z»") == [w.encode() for w in ("it", "s", "àb", "c", "d", "x", "y", "z")] and words.split(None) == []
    doc, bucket = words.of(["a b a", None, ""], words.Buckets(97))
    assert list(doc) == [0, 0, 0] and bucket[0] == bucket[2]


# --- chat

def test_chat_round_trip_of_hostile_texts():
    rng = random.Random(4)
    marks = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "</s", "\n", "a", "<s\\>", "[/INST\\\\]", ">", "]", "[", "é"]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "sys\ntem", "a\\n", ""]), "".join(rng.choice(marks) for _ in range(rng.randint(0, 9)))) for _ in range(3)]
        done = [chat.render(*t) for t in turns]
        back = chat.parse("".join(d[0] for d in done))
        assert [b[:2] for b in back] == turns
        assert chat.render("user", "plain [x] <y>")[0] == "[INST]user\nplain [x] <y>[/INST]"
    assert chat.parse("[INST]user") is None and chat.parse("x") is None and chat.parse("") == []


def test_chat_digests(spark):
    rows = [(1, 2, "assistant", "</s>ok", 0), (1, 1, "user", None, 0), (2, 1, None, "[/INST]", 0), (None, 5, "assistant", "x", 0), (3, 1, "user", "same", 0), (3, 1, "user", "same", 0)]
    rows += [(9, i, ("user", "assistant")[i % 2], f"turn {i} </s>", 0) for i in range(3000)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int").repartition(4)
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(given)).collect()}
    for conv in (1, 2, None, 3, 9):
        own = sorted(((t, r or "", x or "") for c, t, r, x, _ in rows if c == conv))
        whole, learned = "".join(f"{r}\n{x}\n" for _, r, x in own), "".join(x for _, r, x in own if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(own), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(given.limit(0))).count() == 0


# --- sentence pieces

def test_pieces_equal_the_library(spark):
    path = public_tokenizers.path(pieces.MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(["a", "the", " ", "  ", "\n", "é", "▁", "🙂", "\t", "日", "<s>", "ing"]) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts += [None, "word " * 30_000, "nospace" * 4000]
    rows = pieces.digests(docs(spark, texts), path, ["doc_id"]).orderBy("doc_id").collect()
    full = pieces.encode(docs(spark, texts), path).orderBy("doc_id").collect()
    for row, whole, text in zip(rows, full, texts):
        ids = library.encode(text or "") + [library.eos_id()]
        assert whole.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        raw = (text or "").encode()
        assert whole.end[-1] == whole.begin[-1] == len(raw) == row.covered_bytes
        if len(ids) < 2000:
            for i, a, b in zip(ids[:-1], whole.begin, whole.end):
                piece = library.id_to_piece(i)
                assert raw[a:b].decode() in (piece.replace("▁", " "), piece, piece.replace("▁", " ")[1:]) or library.is_byte(i) or "▁" in raw[a:b].decode()
    assert pieces.encode(docs(spark, []), path).count() == 0


def test_decoding_takes_the_ids_not_the_text():
    path = public_tokenizers.path(pieces.MODEL)
    library, own, rng = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Model(path), random.Random(8)
    text = "plain words here"
    rows, _ = own.rows_of([text])[0]
    at = own.bounds[rows[1]]
    own.flat[at] = (own.flat[at] - 300) % 20_000 + 1000  # another piece in the second part
    ids = own.flat[pieces.common.ragged(own.bounds[rows], own.bounds[np.array(rows) + 1] - own.bounds[rows])].tolist() + [library.eos_id()]
    assert ids != library.encode(text, add_eos=True)
    assert pieces._digested(own, [text])[2].to_pylist() == [hashlib.sha256(library.decode(ids).encode()).hexdigest()]
    few = [library.unk_id(), library.bos_id(), library.eos_id(), *(library.piece_to_id(p) for p in ("▁", "▁the", "a", "<0x20>", "<0x41>", "<0xC3>", "<0xA9>", "<0xE2>", "<0x82>", "<0xFF>"))]
    for _ in range(3000):
        ids = [rng.choice(few) for _ in range(rng.randrange(9))]
        assert own.decode_ids(ids) == library.decode(ids)


def test_character_map_takes_the_longest_prefix():
    # a double array by hand for {"a": "X", "ab": "YZ"}: root at 0, its children at 256 ^ byte, and so on
    units = [0] * 2048
    units[0] = (256 ^ 0) << 10
    a = 256 ^ ord("a")
    base = 512
    units[a] = ((a ^ base) << 10) | ord("a") | 1 << 8
    units[base] = 1 << 31 | 0
    b = base ^ ord("b")
    units[b] = ((b ^ 1024) << 10) | ord("b") | 1 << 8
    units[1024] = 1 << 31 | 2
    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + b"X\0YZ\0"
    text, source = pieces.CharacterMap(blob).apply("éabac")
    assert text == "éYZXc" and list(source) == [0, 2, 2, 4, 5, 6]


# --- packing

def test_token_ids_equal_the_library():
    path = public_tokenizers.path(packing.TOKENIZER)
    library, own, rng = Tokenizer.from_file(path), bpe.Encoder(path), random.Random(6)
    texts = ODD + ["".join(rng.choice(["a", "the", " ", "\n", "É", "日", "'s", "'", "ing", "1", "23", "!", "??", "́", "ß", "·"]) for _ in range(rng.randint(1, 60))) for _ in range(500)]
    for text in texts:
        own.start()
        assert own.ids(own.rows(text)).tolist() == library.encode(text, add_special_tokens=False).ids


def test_known_words_are_not_merged_again():
    own, merged = bpe.Encoder(public_tokenizers.path(packing.TOKENIZER)), []
    inside = own._merged
    own._merged = lambda words: merged.extend(words) or inside(words)
    own.rows("alpha beta")
    own.rows("alpha, beta. (gamma) alpha's ...")
    assert sorted(merged) == sorted(["alpha", "beta", ",", ".", "(", "gamma", ")", "'s", "..."])
    library = own.library
    for text in ("alpha, beta. (gamma) alpha's ...", "... a,, ,a a, it's'"):
        assert own.ids(own.rows(text)).tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_slice_of_texts_has_the_ids_of_its_texts():
    own, rng = bpe.Encoder(public_tokenizers.path(packing.TOKENIZER)), random.Random(16)
    parts = ["'", "''", "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'r", "'v", "'l", "a", "S", "eau", "7", "½", "-", "?!", "é", "日本", "🙂", "́", "ſ", " ", "\t", "\u00a0", "\u2028", "\u3000", "\u0085",
             "\u200b", "\u180e", "\ufeff"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + ["", "'", "'r", "x'l", ODD[-3]]
    wanted = [x.ids for x in own.library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # new words, then known ones
        ids, counts = own.all_ids(texts)
        assert counts.tolist() == [len(x) for x in wanted] and ids.tolist() == sum(wanted, [])


def test_runs_of_a_slice_cost_no_call_each():
    own = bpe.Encoder(public_tokenizers.path(packing.TOKENIZER))
    texts = [" ".join(f"{a}{b}{mark}" for b in prose(random.Random(1), 400).split() for mark in ("", ".", "&&&", "'s", "é")) for a in prose(random.Random(2), 10).split()]
    profile = cProfile.Profile()
    profile.runcall(own.all_rows, texts)
    assert sum(entry.callcount for entry in profile.getstats()) < sum(len(set(text.split())) for text in texts) / 2


@pytest.mark.parametrize("shard", [20_000, 15])
def test_packing_keeps_every_token_once(spark, shard):
    path = public_tokenizers.path(packing.TOKENIZER)
    rng = random.Random(7)
    texts = [prose(rng, rng.randint(1, 400)) for _ in range(60)] + [None, "", prose(rng, 9000)]
    rows = packing.pack(packing.pieces(docs(spark, texts), path), shard=shard).collect()
    library = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [(r.start, r.length) for r in own] == [(a, len(ids[a:a + 2048])) for a in range(0, len(ids), 2048)]
        assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) for r in own)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 2048
    assert len(bins) <= -(-sum(r.length for r in rows) // 2048) + (1 if shard > 1000 else 6)
    assert packing.pack(packing.pieces(docs(spark, []), path)).count() == 0


def test_local_search_empties_a_bin():
    lengths = np.array([6, 5, 5, 4, 3, 3, 2, 2])
    found = packing.local_search([[0], [1, 3], [2, 4], [5, 6, 7]], lengths, 10)
    assert sorted(i for b in found for i in b) == list(range(8)) and len(found) == 3 and all(lengths[b].sum() <= 10 for b in found)
    assert packing.local_search([], lengths, 10) == [] and packing.best_fit(np.zeros(0, np.int64), 10) == []


def test_local_search_tries_every_underfull_bin():
    # the only changes are between bins that are neither among the emptiest nor among the fullest; pieces beyond the 24th count too
    lengths = np.array([51] * 40 + [60, 38, 55, 43] * 300 + [99] * 250 + [2, 1, 1] * 60)
    bins = [[i] for i in range(40)] + [[40 + 4 * i, 41 + 4 * i] for i in range(300)] + [[42 + 4 * i, 43 + 4 * i] for i in range(300)]
    bins += [[i] for i in range(1240, 1490)] + [list(range(a, a + 60)) for a in (1490, 1550, 1610)]
    found = packing.local_search(bins, lengths, 100)
    fills = [int(lengths[b].sum()) for b in found]
    assert sorted(i for b in found for i in b) == list(range(len(lengths))) and max(fills) <= 100
    assert packing.local_search(found, lengths, 100) == found
    # nothing that one or two pieces of an emptier bin could do is left
    if len(found) > -(-sum(fills) // 100):
        for low, a in zip(found, fills):
            gives = packing._gives(low, lengths)
            for high, b in zip(found, fills):
                if high is not low and a <= b < 100:
                    assert not any(0 < g - y <= 100 - b for g in gives for y in {0, *lengths[high].tolist()})


def test_rounds_go_on_while_sequences_are_emptied(spark):
    # two lengths fill a sequence together; a shard gets few of the rare one, and most pieces stay underfull
    rows = [(i, 0, 0, 1300 if i < 60 else 748, i) for i in range(120)]
    table = spark.createDataFrame(rows, packing.PIECES)
    got = packing.pack(table, shard=7).collect()
    assert sorted(r.doc_id for r in got) == list(range(120)) and len({r.sequence_id for r in got}) <= 66


# --- near duplicates

def brute_near(texts, n):
    def shingles(t):
        own = [w for w in (t or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()]
        return {tuple(own)} if 0 < len(own) < n else {tuple(own[i:i + n]) for i in range(len(own) - n + 1)}
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(8)
    texts = [None, "", "  \t", "One", "one", "two words", "TWO words", prose(rng, 8000)]
    for _ in range(12):
        base = prose(rng, rng.randint(20, 120)).split()
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = prose(rng, 1)
            texts += [" ".join(copy)] * rng.randint(1, 2)
    for n in (2, 5):
        want = brute_near(texts, n)
        got = {r.doc_id: r for r in minhash.near_duplicates(docs(spark, texts), n).collect()}
        assert [(got[i].n_shingles, got[i].component_id, got[i].kept) for i in range(len(texts))] == [(a, c, c == i) for i, (a, c) in enumerate(want)]
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_near_duplicate_stage_leaves_one_of_each_group(spark):
    text = prose(random.Random(9), 50)
    table = docs(spark, [text, text, text + " x", None, ""]).union(docs(spark, [text])).union(docs(spark, ["other words here"], 9))
    table = table.union(spark.createDataFrame([(None, text, None, None, None, None, None, None)], DOC))
    left = minhash.stage(spark, table, "")
    assert left.columns == table.columns and sorted((r.doc_id if r.doc_id is not None else -1) for r in left.collect()) == [-1, 0, 3, 4, 9]


def test_a_hot_bucket_is_compared_in_tiles():
    rng = random.Random(10)
    base = prose(rng, 100).split()
    texts = [" ".join(base[:i] + [prose(rng, 1)] + base[i + 1:]) for i in range(60)]
    import zstandard
    packed = [zstandard.ZstdCompressor().compress(t.encode()) for t in texts]
    tiles = np.array([i % 2 for i in range(60)])
    links = minhash._Group(2).links(list(range(60)), tiles, packed)
    assert len(links) <= 59 and all(tiles[a] != tiles[b] for a, b in links) and {x for p in links for x in p} == set(range(60))


# --- repeated strings

def brute_repeats(texts):
    seen, out = set(), []
    for t in texts:
        x = (t or "").encode()
        gone = bytearray(len(x))
        for k in range(len(x) - 99):
            if x[k:k + 100] in seen:
                gone[k:k + 100] = b"\1" * 100
            seen.add(x[k:k + 100])
        kept = bytes(c for c, g in zip(x, gone) if not g)
        out.append((len(x), sum(gone), sum(1 for k in range(len(x)) if gone[k] and not (k and gone[k - 1])), hashlib.sha256(kept).hexdigest(), kept))
    return out


def repeats_fixture():
    rng = random.Random(11)
    passages = [prose(rng, 60, rng.choice(["en", "fr"])) for _ in range(6)]
    texts = [None, "", "é" * 49, "ab" * 400, "x" * 1000]
    for _ in range(60):
        text = prose(rng, rng.randint(3, 200))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            at, a = rng.randrange(len(text)), rng.randrange(60)
            text = text[:at] + p[a:a + rng.randint(90, 400)] + text[at:]
        texts += [text] * rng.choice([1, 1, 1, 2])
    return texts


@pytest.mark.parametrize("hot, bits", [(2048, 64), (2, 64), (2048, 3), (2, 1)])
def test_repeats_equal_brute_force(spark, hot, bits, monkeypatch):
    """With few ``bits`` the hashes of unlike segments collide, and only their proofs differ."""
    monkeypatch.setattr(suffix, "HOT", hot)
    texts = repeats_fixture()

    def digest(data, start, end):
        data = data or b""
        return len(data), int((end - start).sum()), len(start), hashlib.sha256(suffix._left(data, start, end)).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in suffix._apply(docs(spark, texts), ["doc_id"], [
        ("n_bytes", suffix.T.LongType()), ("n_removed", suffix.T.LongType()), ("n_spans", suffix.T.LongType()), ("kept_sha256", suffix.T.StringType())], digest, bits).collect()}
    assert [got[i] for i in range(len(texts))] == [w[:4] for w in brute_repeats(texts)]


def brute_repeats_by_id(rows):
    """Earlier: a smaller (doc_id, start). Rows without id lose what any id has, and what they have before themselves."""
    least, out = {}, []
    windows = [[t.encode()[k:k + 100] for k in range(len(t.encode()) - 99)] for _, t in rows]
    for (d, _), own in zip(rows, windows):
        for k, w in enumerate(own):
            if d is not None:
                least[w] = min(least.get(w, (d, k)), (d, k))
    for (d, t), own in zip(rows, windows):
        x, seen = t.encode(), set()
        gone = bytearray(len(x))
        for k, w in enumerate(own):
            if (least[w] < (d, k)) if d is not None else (w in least or w in seen):
                gone[k:k + 100] = b"\1" * 100
            seen.add(w)
        out.append((-1 if d is None else d, bytes(c for c, g in zip(x, gone) if not g).decode("utf-8", "ignore")))
    return sorted(out)


@pytest.mark.parametrize("hot", [2048, 2])
@pytest.mark.parametrize("parts, piece", [(1, 2 << 20), (5, 2 << 20), (2, 1000)])
def test_repeats_of_rows_that_share_an_id_or_have_none(spark, hot, parts, piece, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "PIECE", piece)
    rng = random.Random(12)
    texts = [t for t in repeats_fixture() if t]
    one, other = prose(rng, 90), prose(rng, 90)
    rows = [(500, one)] * 2 + [(500, one + "?" + other)] + [(501, other + one)] * 2 + [(501, "." + one), (502, "é" * 60), (None, one), (None, prose(rng, 50))]
    rows += [(None, "x" * 400)] * 2 + [(None, t + t) for t in (prose(rng, 60),) * 2]
    rows += [(rng.choice([1, 2, 3, None, i]), t) for i, t in enumerate(texts)]
    rows += [r for r in rows[13:] if rng.random() < 0.3]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in suffix.stage(spark, table, "").collect())
    assert got == brute_repeats_by_id(rows)


def test_repeat_stage_cuts_texts(spark):
    texts = repeats_fixture()
    table = docs(spark, texts)
    rows = {r.doc_id: r for r in suffix.stage(spark, table, "").collect()}
    for i, want in enumerate(brute_repeats(texts)):
        if texts[i] is None:
            assert rows[i].text is None
        else:
            assert rows[i].text == want[4].decode("utf-8", "ignore") and rows[i].n_chars == len(rows[i].text)
        assert (rows[i].score, rows[i].component_id, rows[i].k_text) == (0.5, 7, "k")
    assert suffix.stage(spark, docs(spark, []), "").count() == 0


def test_repeats_inside_a_very_long_text(spark):
    rng = np.random.default_rng(0)
    half = "".join(map(chr, rng.integers(97, 123, 3_000_000)))
    row = suffix.stage(spark, docs(spark, [half + half]), "").first()
    assert row.text == half


def test_suffix_sort_orders_by_bytes():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 5000).astype(np.uint8)
    start, group = rng.integers(0, 4800, 700), np.sort(rng.integers(0, 40, 700))
    suffixes = suffix.Suffixes(data, start, 100)
    order = suffixes.sort(group)
    key = [(group[i], data[start[i]:start[i] + 100].tobytes()) for i in range(700)]
    assert order.tolist() == sorted(range(700), key=lambda i: (key[i], i))
    kinds = suffixes.classes(group, order)
    assert all((kinds[k] == kinds[k - 1]) == (key[order[k]] == key[order[k - 1]]) for k in range(1, 700))
    none = suffix.Suffixes(data, start[:0], 100)
    assert len(none.sort(group[:0])) == len(none.classes(group[:0], group[:0])) == 0
    # segments that share an anchor string but no window
    found = suffix._compared(np.array([0, 0]), np.array([1, 2]), np.array([0, 0]), np.array([1, 1]), np.array([3, 9]), [b"a" * 100, b"b" * 100])
    assert all(len(x) == 0 for x in found)


def test_columns_with_names_of_the_stages_own(spark):
    """Extra columns keep their values whatever they are called, in the prediction and in the stages."""
    rows = spark.createDataFrame([(1, "the thing and the other", "x", "y", 7.0, "en")], "doc_id long, text string, _text string, k_text string, _quality_score double, _langid_margin string")
    found = langid.predict(rows, {"en": b"the thing and the other", "de": b"das ding und das andere"}).first()
    assert (found._text, found.k_text, found.lang_pred) == ("x", "y", "en")
    assert langid.common.unused(rows.columns, "_quality_") == "__quality_"
    for stage in (quality.stage, langid.stage):
        left = stage(spark, rows.withColumns({"n_chars": F.length("text"), "lang": F.lit("en"), "source": F.lit("s")}), "/root/testdata/sf0.001")
        assert {"_quality_score", "_langid_margin", "_text"} < set(left.columns)
        for row in left.collect():
            assert row._quality_score == 7.0 and row._langid_margin == "en"


def test_language_samples_reach_every_part_of_long_texts(spark):
    long = "a " * 40_000 + "middle " * 40_000 + "end " * 40_000
    rows = spark.createDataFrame([(1, long, "x"), (2, "short words", "x"), (3, None, "x"), (4, "0", "y"), (5, "other", None)], "doc_id long, text string, lang string")
    found = langid.learn(rows)
    assert set(found) == {"x"} and {b"a", b"middle", b"end", b"short"} <= set(found["x"].split())
    many = spark.createDataFrame([(i, "same header " * 30 + f"own{i:04d} " * 200, "x") for i in range(400)], "doc_id long, text string, lang string")
    own = langid.learn(many)["x"]
    assert len({w for w in own.split() if w.startswith(b"own")}) == 1 or own.count(b"same header") <= 500
    assert len(langid.learn(many, sample_docs=7)["x"]) < 7 * 1400


def test_loss_is_read_under_its_mask(spark):
    turns = [(1, 0, "user", "ask"), (1, 1, "assistant", "an</s>swer"), (2, 0, "assistant", ""), (2, 1, "assistant", "more")]
    made = chat.format_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    good = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert good[1].loss_chars == 10 and good[1].loss_sha256 == hashlib.sha256(b"an</s>swer").hexdigest() and good[2].loss_chars == 4
    moved = {r.conv_id: r for r in chat.read_back(made.withColumn("loss_start", F.col("loss_start") + F.when(F.col("loss_end") > 0, 1).otherwise(0))).collect()}
    assert moved[1].turns_sha256 == good[1].turns_sha256 and moved[1].loss_sha256 != good[1].loss_sha256 and moved[1].loss_chars == 9


def test_near_duplicate_stage_loses_no_text_of_repeated_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    schema = "doc_id long, text string, _near_id long"
    rows = [(1, a, 1), (2, a, 2), (2, b, 3), (3, c, 4), (3, c, 4), (4, c, 5), (None, a, 6), (5, None, 7), (5, "", 8), (5, "", 9)]
    left = minhash.stage(spark, spark.createDataFrame(rows, schema).repartition(4), "")
    assert left.columns == ["doc_id", "text", "_near_id"]
    got = sorted(((r.doc_id or 0), r.text or "-") for r in left.collect())
    assert got == sorted([(0, a), (1, a), (2, b), (3, c), (5, "-"), (5, "-")])
