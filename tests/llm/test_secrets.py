import hashlib
import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.llm import secrets
from skygauge.llm.charnet import CharNet

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
#: the patterns as the contract states them, without the engine's own case rule
KEY = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token"))
ASSIGN = rf"""({KEY}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def made(rng):
    parts = ["password", "PassWd", "secret", "toKen", "api_key", "APIKEY", "=", ": ", " = \"", "='", "hunter", "abc", "AKIA", "ABCDEFGHIJKLMNOP", "deadbeef",
             "0123456789abcdef", "é", "ſecret=abcdefg", "toKen", " ", "\n", ".", "-x", "==", "😀", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(0, 25)))


def test_base_findings_against_plain_patterns():
    rng = random.Random(4)
    texts = [made(rng) for _ in range(4000)] + ["", "token=token: hunter22", "token=abc password=xyz123", "a" * 30, "AKIA" + "A" * 16, "AKIA" + "A" * 15]
    own = secrets.Slice(pa.array(texts))
    assert own.base == [plain(t) for t in texts] and sum(map(bool, own.base)) > 500


def test_runs_windows_and_touching():
    text = "é token=" + "x1" * 50 + " und 192.168.100.200 ende"
    own = secrets.Slice(pa.array(["nothing", None, text]))
    assert [(text[s - own.first[2]:e - own.first[2]]) for s, e in zip(own.start, own.end)] == ["token=" + "x1" * 50, "192.168.100.200"]
    assert own.touched().tolist() == [True, False] and own.doc.tolist() == [2, 2]
    codes, owner = own.windows(np.arange(2))
    assert owner.tolist() == [0, 0, 0, 0, 1] and codes.shape[1] == secrets.BEFORE + secrets.INSIDE + secrets.AFTER
    show = lambda row: "".join(" " if c < 4 else chr(c + 29) for c in row)
    assert show(codes[3])[24:56] == ("x1" * 50)[-32:] and show(codes[4])[24:39] == "192.168.100.200" and show(codes[4])[56:61] == " ende"
    assert show(codes[0])[:24].strip() == "" and codes[0][22] == 2  # nothing from the text before, the letter beyond ASCII by its kind


def test_gradients_and_calibration():
    rng = np.random.default_rng(2)
    codes, truth = rng.integers(0, 99, (40, secrets._LENGTH)), rng.random(40) < 0.5
    net = CharNet(99, secrets.PARTS, 1)
    weight = rng.uniform(0.5, 2, 40)

    def loss():
        z = net._forward(codes)["logit"]
        return np.sum(weight * (np.log1p(np.exp(z)) - truth * z)) / weight.sum()

    for name, g in net._gradients(codes, truth, weight).items():
        flat = net.weights[name].reshape(-1)
        for i in rng.integers(0, flat.size, 5):
            kept = flat[i]
            flat[i] = kept + 1e-5
            up = loss()
            flat[i] = kept - 1e-5
            down = loss()
            flat[i] = kept
            assert abs((up - down) / 2e-5 - g.reshape(-1)[i]) < 1e-7
    net.fit(codes, truth, epochs=40).calibrate(codes, truth, 0.9)
    assert (net.score(codes)[truth] >= net.threshold).mean() >= 0.9 and ((net.score(codes) >= 0.5) == truth).mean() > 0.9


def corpus(rng, n=400):
    """Keys behind names in some documents, without a name and too short for the patterns in others, numbers in all."""
    rows, bare = [], {}
    for i in range(n):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        words = " ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randrange(2, 9))) for _ in range(30))
        number = "".join(rng.choice(string.digits) for _ in range(16))
        text = f"{words} {number} {words[:40]} 10.{rng.randrange(256)}.100.{rng.randrange(100, 256)}"
        if i % 3 == 0:
            text += f' token = "{key}" {words[:20]}'
        elif i % 10 == 1:
            bare[i] = len(text) + 1, key[:22]
            text += f" {key[:22]} {words[:20]}"
        rows.append((i, text))
    return rows, bare


def test_network_adds_what_looks_like_the_labelled_findings(spark):
    rng = random.Random(7)
    rows, bare = corpus(rng)
    docs = spark.createDataFrame([r for r in rows if r[0] not in bare], SCHEMA).repartition(3)
    net = secrets.learn(secrets.findings(docs))
    fresh, bare = corpus(random.Random(8))
    found = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(fresh, SCHEMA), net).collect()}
    texts = dict(fresh)
    for i, row in found.items():
        own = plain(texts[i])
        shown = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in own)
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == j for _, k, _ in own) for j in range(3))
        assert row.base_sha256 == hashlib.sha256(shown.encode()).hexdigest() and set(shown.split(",")) <= {"", *row.spans.split(",")}
    hit = sum(f"learned:{s}:{s + len(key)}" in found[i].spans for i, (s, key) in bare.items())
    wrong = sum(row.spans.count("learned") for i, row in found.items() if i not in bare)
    assert hit >= 0.8 * len(bare) and wrong <= 0.02 * len(found)


def test_all_windows_are_learned_from(spark, monkeypatch):
    rng = np.random.default_rng(3)
    truth = rng.random(16_000) < 0.4  # more of either kind than were once taken
    codes = np.where(truth[:, None], rng.integers(4, 60, (16_000, secrets._LENGTH)), rng.integers(30, 99, (16_000, secrets._LENGTH))).astype(np.uint8)
    codes[::50] = rng.integers(4, 99, codes[::50].shape)
    labelled = spark.createDataFrame([(c.tobytes(), bool(t)) for c, t in zip(codes, truth)], "window binary, truth boolean").repartition(5)
    seen = []
    monkeypatch.setattr(secrets, "EPOCHS", 1)
    monkeypatch.setattr(secrets, "fit", lambda rows, *a, fit=secrets.fit: (seen.append((rows.count(), *a)), fit(rows, *a))[1])
    net = secrets.learn(labelled, 0.9)
    place = {r.window: r.held for r in labelled.select("window", (F.pmod(F.xxhash64("window"), F.lit(4)) == 0).alias("held")).collect()}
    held = np.array([place[c.tobytes()] for c in codes])
    assert seen == [((~held).sum(), (truth & ~held).sum(), (~truth & ~held).sum(), 0)]
    assert len(range(0, seen[0][0], secrets.PART)) == 2  # two parts, averaged
    own = np.sort(net.score(codes[held & truth].astype(np.int64)))
    assert abs(net.threshold - min(0.5, own[int((1 - 0.9) * len(own))])) < 1e-12
    assert ((net.score(codes[held].astype(np.int64)) >= 0.5) == truth[held]).mean() > 0.95
    local = CharNet(secrets.ALPHABET, secrets.PARTS)
    local.weights = {k: v.copy() for k, v in net.weights.items()}
    local.calibrate(codes[held].astype(np.int64), truth[held], 0.9)
    assert abs(local.slope - net.slope) < 1e-6 and abs(local.shift - net.shift) < 1e-6 and abs(local.threshold - net.threshold) < 1e-6


def test_one_part_is_learned_as_in_one_place(spark, monkeypatch):
    rng = np.random.default_rng(5)
    truth = rng.random(300) < 0.5
    codes = np.array(sorted(rng.integers(0, 99, (300, secrets._LENGTH)).astype(np.uint8).tolist()), np.int64)
    monkeypatch.setattr(secrets, "EPOCHS", 2)
    rows = spark.createDataFrame([(c.astype(np.uint8).tobytes(), bool(t)) for c, t in zip(codes, truth)], "window binary, truth boolean")
    net, local = secrets.fit(rows, truth.sum().item(), (~truth).sum().item()), CharNet(secrets.ALPHABET, secrets.PARTS)
    bare, moments, step = codes.copy(), local.moments(), 0.0
    bare[:, :secrets.BEFORE], bare[:, secrets.BEFORE + secrets.INSIDE:] = 0, 0
    weight = np.tile(np.where(truth, 150 / truth.sum(), 150 / (~truth).sum()), 2)
    for epoch in range(2):
        step = local.fit_once(np.concatenate([codes, bare]), np.tile(truth, 2), weight, moments, step, np.random.default_rng((0, epoch, 0)))
    assert all(np.allclose(net.weights[k], v, atol=1e-9) for k, v in local.weights.items())


def test_odd_rows(spark, tmp_path):
    schema = T.StructType([*SCHEMA, T.StructField("spans", T.StringType()), T.StructField("k_text", T.IntegerType())])
    long = "x " * 200_000 + "password: swordfish99"
    rows = [(1, None, "a", 1), (2, "", "b", 2), (None, "token=abcdef1", None, None), (3, "token=abcdef1", "c", 3), (3, "token=abcdef1", "c", 3), (4, long, "d", 4)]
    docs = spark.createDataFrame(rows, schema)
    found = secrets.scan(docs, None)
    assert found.columns == ["doc_id", "text", "k_text", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    got = sorted(((r.doc_id or 0, r.spans) for r in found.collect()))
    assert got == [(0, "assign:0:13"), (1, ""), (2, ""), (3, "assign:0:13"), (3, "assign:0:13"), (4, "assign:400000:400021")]
    both = secrets.scan(docs, None, prefix="x_").first()
    assert both.spans == "a" and both.x_spans == "" and both.x_base_sha256 == hashlib.sha256(b"").hexdigest()
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert secrets.op11(spark, str(tmp_path)).count() == 0
