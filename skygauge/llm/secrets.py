"""Secret scan: fixed patterns, and a character network over every other candidate in its surroundings.

Base findings are the leftmost matches of three patterns. A candidate is a whole run of ``RUN`` or more characters of the values' alphabet that holds a
digit or one of ``+/_=``. The network sees the ``BEFORE`` characters in front of a candidate, ``INSIDE`` of its own and the ``AFTER`` behind;
a longer candidate is seen through several windows and scores as its best. Findings of the network that touch no base
finding are added with the kind ``learned``; base findings always stay.

The network is trained on labelled findings: windows marked true or false. Where there are no other labels (``op11``), base findings are the true ones
and candidates that touch none the false ones. Words beside a value would give such labels away, so each true window is learned a second time
with its surroundings blanked, and so is each false one. All different windows of the corpus are learned from, in parts whose weights are averaged
after every pass, except that one in four calibrates the probabilities instead; the threshold keeps ``RECALL`` of
the true ones among these.

Defined results: a null text is empty and has no spans; places are code points. Without both true and false findings nothing is learned and only base
spans are returned. Equal windows score equally; repeated rows are answered one by one, a null doc_id stays. ``scan`` keeps the columns it
is told to keep; output columns replace columns of their names. Texts of any length are scanned whole.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.llm import common
from skygauge.llm.charnet import EPOCHS, WIDTH, CharNet
from skygauge.operators.ordered import positions
from skygauge.store import landed

KINDS = ("assign", "access", "hex", "learned")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: tells texts that may hold an assignment from those that don't
MAYBE = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
RUN = 12
BEFORE, INSIDE, AFTER = 24, 32, 12
#: windows that one task learns from at a time
PART = 8192
RECALL = 0.98
OUT = (("n_assign", T.LongType()), ("n_access", T.LongType()), ("n_hex", T.LongType()), ("base_sha256", T.StringType()), ("spans", T.StringType()))

_VALUE = np.zeros(128, bool)
_VALUE[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.=-"]] = True
_TELLING = np.zeros(128, bool)
_TELLING[[*range(48, 58), *b"+/_="]] = True
#: printable ASCII by itself, other characters by kind: 0 blank, 1 line end, 2 letter beyond ASCII, 3 anything else
ALPHABET = 99
_LENGTH = BEFORE + INSIDE + AFTER
_EDGE = WIDTH - 1
PARTS = ((0, BEFORE - _EDGE), (BEFORE - _EDGE, BEFORE + INSIDE), (BEFORE + INSIDE, _LENGTH - _EDGE))


def base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns' matches, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def runs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the runs of ``RUN`` characters or more in an array of code points, and whether a run is a candidate."""
    small = np.where(code < 128, code, 0)
    inside = np.concatenate([[False], _VALUE[small], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    long = end - start >= RUN
    start, end = start[long], end[long]
    telling = np.concatenate([[0], np.cumsum(_TELLING[small], dtype=np.int32)])
    return start, end, telling[end] > telling[start]


def windows(code: np.ndarray, first: np.ndarray, last: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes of each window, the candidate it belongs to); ``first`` and ``last`` bound the text that each candidate stands in.

    What lies outside the text is blank, and so is the room that a short candidate leaves.
    """
    count = -(-(end - start) // INSIDE)
    owner = np.repeat(np.arange(len(start)), count)
    at = start[owner] + INSIDE * common.ragged(np.zeros(len(start), np.int64), count)
    at = np.maximum(start[owner], np.minimum(at, end[owner] - INSIDE))  # the last window is full, too
    stop = np.minimum(at + INSIDE, end[owner])
    place = np.arange(_LENGTH)
    seen = at[:, None] - BEFORE + place
    seen = np.where(place >= BEFORE + INSIDE, stop[:, None] + place - BEFORE - INSIDE, seen)
    blank = (seen < first[owner, None]) | (seen >= last[owner, None]) | ((place >= BEFORE) & (place < BEFORE + INSIDE) & (seen >= stop[:, None]))
    return np.where(blank, 0, _symbols(code[np.clip(seen, 0, max(len(code) - 1, 0))])).astype(np.uint8), owner


def _symbols(code: np.ndarray) -> np.ndarray:
    letter = (code >= 0xC0) & (code < 0x2000) | (code >= 0x3040)
    out = np.where(letter, 2, 3)
    out = np.where((code > 32) & (code < 127), code - 33 + 4, out)
    return np.where((code == 32) | (code == 9), 0, np.where((code == 10) | (code == 13), 1, out))


class Slice:
    """Base findings and candidates of a list of texts, all in one array of code points."""

    def __init__(self, column: pa.Array):
        texts = [t or "" for t in column.to_pylist()]
        joined = "\n".join(texts)
        self.code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        length = np.array([len(t) for t in texts], np.int64)
        self.first = np.cumsum(length + 1) - length - 1
        self.last = self.first + length
        start, end, candidate = runs(self.code)
        doc = np.searchsorted(self.first, start, "right") - 1
        self.start, self.end, self.doc = start[candidate], end[candidate], doc[candidate]
        look = pc.fill_null(pc.match_substring_regex(column.cast(pa.large_string()), MAYBE), False).to_numpy(zero_copy_only=False).copy()
        look[doc[end - start >= 20]] = True  # no match of the other two patterns is shorter
        self.base = [base(t) if maybe else [] for t, maybe in zip(texts, look)]

    def touched(self) -> np.ndarray:
        """Candidates that share a character with a base finding."""
        flat = sorted((self.first[i] + s, self.first[i] + e) for i, own in enumerate(self.base) for s, _, e in own)
        if not flat:
            return np.zeros(len(self.start), bool)
        begin, reach = np.array([f[0] for f in flat]), np.maximum.accumulate([f[1] for f in flat])
        before = np.searchsorted(begin, self.end)  # findings that begin before the candidate's end
        return (before > 0) & (reach[np.maximum(before - 1, 0)] > self.start)

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return windows(self.code, self.first[self.doc[chosen]], self.last[self.doc[chosen]], self.start[chosen], self.end[chosen])


def findings(docs: DataFrame) -> DataFrame:
    """window (the codes as bytes) and truth: the candidates' windows, true where they touch a base finding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            own = Slice(batch.column("text"))
            codes, owner = own.windows(np.arange(len(own.start)))
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(own.touched()[owner])], names=["window", "truth"])

    return docs.select("text").mapInArrow(run, "window binary, truth boolean")


def _codes(windows: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(windows.to_pylist()), np.uint8).reshape(-1, _LENGTH).astype(np.int64)


def learn(labelled: DataFrame, recall: float = RECALL, seed: int = 0) -> CharNet | None:
    """``labelled``: window and truth, as ``findings`` gives them; a window with both labels is true. All windows are learned from or calibrate."""
    rows = landed(labelled.groupBy("window").agg(F.max("truth").alias("truth")), "findings").select("window", "truth", (F.pmod(F.xxhash64("window"), F.lit(4)) == 0).alias("held"))
    sizes = {(r.held, r.truth): r["n"] for r in rows.groupBy("held", "truth").agg(F.count("*").alias("n")).collect()}  # at most four rows
    apart = all((True, truth) in sizes for truth in (True, False))
    fitted = rows.where("not held") if apart else rows  # too few to set some apart
    true, false = (sum(n for (held, t), n in sizes.items() if t == truth and not (held and apart)) for truth in (True, False))
    if not true or not false:
        return None
    net = fit(fitted, true, false, seed)
    held = rows.where("held") if apart else rows
    return calibrate(net, held, sizes[True, True] if apart else true, sizes[True, False] if apart else false, recall)


def fit(rows: DataFrame, true: int, false: int, seed: int = 0) -> CharNet:
    """The network, learned from all windows in parts of about ``PART``: every part makes a pass from the same weights, then their mean
    (by the parts' sizes) is where the next pass begins. The means are exact sums, so their order changes nothing."""
    parts = -(-(true + false) // PART)
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "window"), F.lit(parts))).repartition(parts, "part")
    dealt = landed(dealt.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("window", "truth"))).alias("rows")).select("part", "rows.window", "rows.truth"), "windows")
    net = CharNet(ALPHABET, PARTS, seed)
    state = net.packed(net.moments(), 0.0)
    for epoch in range(EPOCHS):
        found = dealt.mapInArrow(_pass(state, true, false, seed, epoch), "place int, value double")
        means = found.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,20)")).cast("double").alias("value")).toPandas()  # as many rows as the network has weights and moments
        state = np.zeros(len(means))
        state[means["place"].to_numpy()] = means["value"].to_numpy()
    net.unpack(state)
    return net


def _pass(state: np.ndarray, true: int, false: int, seed: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, part in enumerate(batch.column("part").to_pylist()):
                codes, truth = _codes(batch.column("window")[i].values), np.array(batch.column("truth")[i].values.to_pylist(), bool)
                bare = codes.copy()
                bare[:, :BEFORE], bare[:, BEFORE + INSIDE:] = 0, 0
                weight = np.where(truth, 0.5 / true, 0.5 / false) * (true + false)
                net = CharNet(ALPHABET, PARTS, seed)
                moments, step = net.unpack(state)
                step = net.fit_once(np.concatenate([codes, bare]), np.tile(truth, 2), np.tile(weight, 2), moments, step, np.random.default_rng((seed, epoch, part)))
                value = net.packed(moments, step) * (len(codes) / (true + false))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(value), dtype=np.int32)), pa.array(value)], names=["place", "value"])

    return run


def calibrate(net: CharNet, rows: DataFrame, true: int, false: int, recall: float) -> CharNet:
    """``CharNet.calibrate`` over all ``rows``, whose logits stay in their tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("truth"), pa.array(net.logits(_codes(batch.column("window"))))], names=["truth", "logit"])

    logits = landed(rows.select("window", "truth").mapInArrow(run, "truth boolean, logit double"), "logits")
    x = F.col("logit")

    def sums(slope, shift, high, low):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), slope * x + shift))))
        curve, off = p * (1 - p), p - F.when(F.col("truth"), high).otherwise(low)
        return tuple(float(v) for v in logits.agg(*[F.sum(c.cast("decimal(38,18)")) for c in (curve * x * x, curve * x, curve, off * x, off)]).first())

    net.set_line(sums, true, false)
    place = positions(logits.where("truth").select("logit"), ["logit"], "_n")
    return net.set_threshold(place.where(F.col("_n") > int(np.floor((1 - recall) * true))).agg(F.min("logit")).first()[0])


def learned(own: Slice, net: CharNet | None) -> list[list[tuple[int, int, int]]]:
    """The network's findings in each text."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in own.base]
    chosen = np.flatnonzero(~own.touched())
    if net is None or not len(chosen):
        return found
    codes, owner = own.windows(chosen)
    best = np.zeros(len(chosen))
    np.maximum.at(best, owner, net.score(codes.astype(np.int64)))
    for i in chosen[best >= net.threshold]:
        doc = own.doc[i]
        found[doc].append((int(own.start[i] - own.first[doc]), len(KINDS) - 1, int(own.end[i] - own.first[doc])))
    return found


def _shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, net: CharNet | None, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """``keep`` columns (default all), then n_assign, n_access, n_hex, base_sha256 and spans, each after ``prefix``."""
    names = [prefix + n for n, _ in OUT]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    source = docs.select(*[F.col(c).alias(f"k_{c}") for c in kept], F.col("text").alias("text"))
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(prefix + n, t) for n, t in OUT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            own = Slice(batch.column("text"))
            counts = np.array([np.bincount([kind for _, kind, _ in spans] or [3], minlength=3)[:3] for spans in own.base], np.int64)
            digest = [hashlib.sha256(_shown(spans).encode()).hexdigest() for spans in own.base]
            spans = [_shown(sorted(a + b)) for a, b in zip(own.base, learned(own, net))]
            yield pa.RecordBatch.from_arrays([batch.column(f"k_{c}") for c in kept] + [*map(pa.array, counts.T), pa.array(digest), pa.array(spans)], names=[*kept, *names])

    return source.mapInArrow(run, schema)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, learn(findings(docs)), ["doc_id"])
