"""Best-fit packing of token sequences by swap-based local search.

Documents become token ids and an end id; longer ones than ``capacity`` are cut. Full pieces are sequences of their own. The other
pieces are dealt to shards of about ``SHARD`` pieces by a hash. A shard packs best fit, largest first, and
then searches: pieces of underfull sequences move into, or change places one for one and two for one with pieces of, other
underfull sequences whenever that increases the sum of squared fills, until there is no such change, and emptied sequences go. The pieces of
sequences that stay underfull go to a next round, dealt anew, so that what shards could not fill alone is
filled across them; this ends with a single shard, or with a round that needs as many sequences as its pieces had before.
A shard has about ``SHARD`` pieces in every round.

Defined results: a null or empty text is the end id alone. Repeated rows, also of one doc_id, are packed one by one. An empty table
gives an empty result. Lengths that tie are taken in the order of (doc_id, piece).
"""

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygauge.llm import bpe, common
from skygauge.store import landed

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
END = 0
SHARD = 20_000
#: a sequence with at most this share of room is not repacked across shards
SLACK = 0.005
#: bytes of text that are tokenized at once
SLICE_BYTES = 4 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the ids themselves."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe.encoder(path)
        for batch in common.slices(batches, most=SLICE_BYTES):
            own.start()
            ids, counts = own.all_ids([text or "" for text in batch.column("text").to_pylist()])
            bounds = np.cumsum(counts + 1)
            ids = np.insert(ids, np.cumsum(counts), np.uint32(END)).astype("<u4")
            out = []
            for doc_id, first, end in zip(batch.column("doc_id").to_pylist(), (bounds - counts - 1).tolist(), bounds.tolist()):
                for piece, start in enumerate(range(0, end - first, capacity)):
                    cut = ids[first + start:min(first + start + capacity, end)]
                    out.append((doc_id, piece, start, len(cut), zlib.crc32(cut), cut))
            columns = list(zip(*out))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t, _ in zip(columns, types, names)], names=names)
        own.forget()  # the process may go on with other work

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, PIECES + ", ids array<long>" * with_ids)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Positions of each bin: largest first, into the fullest bin that has room."""
    rooms: list[int] = []  # sorted free space, for each open bin
    owners: dict[int, list[int]] = {}
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        at = bisect.bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms.pop(at)
            own = owners[room].pop()
            bins[own].append(int(i))
        else:
            room, own = capacity, len(bins)
            bins.append([int(i)])
        if room - size:
            bisect.insort(rooms, room - size)
            owners.setdefault(room - size, []).append(own)
    return bins


def _gives(own: list[int], lengths: np.ndarray) -> list[int]:
    """What one piece or two of a bin hold, each number once; all different lengths of a bin are few (63 for 2048)."""
    sizes = sorted(lengths[own].tolist())
    different = sorted(set(sizes))
    twice = {a for a, b in zip(sizes, sizes[1:]) if a == b}
    return sorted({*different, *(a + b for i, a in enumerate(different) for b in different[i + 1:]), *(2 * a for a in twice)})


def _taken(own: list[int], size: int, lengths: np.ndarray) -> list[int]:
    """One piece or two of a bin that hold ``size``."""
    seen: dict[int, int] = {}
    for i in own:
        if lengths[i] == size:
            return [i]
    for i in own:
        if size - int(lengths[i]) in seen:
            return [seen[size - int(lengths[i])], i]
        seen[int(lengths[i])] = i
    raise ValueError("no such pieces")


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Moves and exchanges between underfull bins that increase the sum of squared fills, until a pass over all finds none.

    Taking d tokens from a bin of fill a to one of fill b changes the sum by 2d(b - a + d), so every change carries tokens
    to the fuller bin or past it. A pass goes through all underfull bins, fullest first; what one or two pieces of the emptier ones hold is kept
    sorted, so for each length that the bin can give back (or none) a bisection finds the most that its room allows. It ends early only
    with as few bins as the tokens need.
    """
    bins = [list(b) for b in bins]
    fills = [int(lengths[b].sum()) for b in bins]
    least, count = -(-sum(fills) // capacity), len(bins)
    changed = True
    while changed and count > least:
        changed = False
        order = sorted((i for i in range(len(bins)) if bins[i] and fills[i] < capacity), key=lambda i: fills[i], reverse=True)
        # of equal sizes the emptiest bin gives: it stands last
        place = {i: at for at, i in enumerate(order)}
        gives = sorted((size, place[i]) for i in order for size in _gives(bins[i], lengths))

        def drop(i):
            for size in _gives(bins[i], lengths):
                del gives[bisect.bisect_left(gives, (size, place[i]))]

        for high in order:
            if not bins[high]:
                continue
            drop(high)  # from here on it only receives; those that are left are no fuller
            while (room := capacity - fills[high]) and gives and count > least:
                best = (0, 0, 0)
                for back in (0, *sorted(set(lengths[bins[high]].tolist()))):
                    at = bisect.bisect_right(gives, (room + back, len(order))) - 1
                    if at >= 0 and gives[at][0] - back > best[0]:
                        best = (gives[at][0] - back, back, at)
                        if best[0] == room:
                            break
                d, back, at = best
                if not d:
                    break
                size, low = gives[at][0], order[gives[at][1]]
                give, take = _taken(bins[low], size, lengths), _taken(bins[high], back, lengths) if back else []
                drop(low)
                bins[low] = [x for x in bins[low] if x not in give] + take
                bins[high] = [x for x in bins[high] if x not in take] + give
                fills[low], fills[high], changed = fills[low] - d, fills[high] + d, True
                count -= not bins[low]
                for size in _gives(bins[low], lengths):
                    bisect.insort(gives, (size, place[low]))
    return [b for b in bins if b]


def _pack_shard(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, whether its bin is left underfull) of each piece."""
    bins = local_search(best_fit(lengths, capacity), lengths, capacity)
    which, offset, under = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), bool)
    for number, own in enumerate(bins):
        sizes = lengths[own]
        which[own] = number
        offset[own] = np.cumsum(sizes) - sizes
        under[own] = sizes.sum() < capacity * (1 - SLACK)
    return which, offset, under


def _packer(capacity: int, base: int):
    """The function that packs one shard; ``base`` keeps the sequence numbers of rounds apart."""

    def run(key, pdf):
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        which, pdf["offset"], pdf["_open"] = _pack_shard(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = base + (int(key[0]) << 24) + which
        return pdf.drop(columns="_shard")

    return run


def pack(rows: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``rows`` (of ``pieces``) with sequence_id and offset."""
    rows = landed(rows, "pieces")
    columns = rows.columns
    full = rows.where(F.col("length") >= capacity)
    rest = rows.where(F.col("length") < capacity)
    # any number may name a sequence: round and shard in front, so rounds and shards never share one
    done = [full.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    count, number, before = rest.count(), 0, None
    while count:
        shards = -(-count // shard)
        dealt = rest.select(*columns, F.pmod(F.xxhash64(F.lit(number), "doc_id", "piece", "ids_crc32", "length"), F.lit(shards)).alias("_shard"))
        packed = landed(dealt.groupBy("_shard").applyInPandas(_packer(capacity, number << 48), ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long, _open boolean"), "packed")
        # each sequence has one piece at offset 0
        needed, left, open_ = packed.agg(F.count_if(F.col("offset") == 0), F.count_if("_open"), F.count_if(F.col("_open") & (F.col("offset") == 0))).first()
        if before and needed >= before[0]:
            done.append(before[1])
            break
        if left == 0 or shards == 1:
            done.append(packed.drop("_open"))
            break
        done.append(packed.where("NOT _open").drop("_open"))
        before = open_, packed.where("_open").drop("_open")
        rest, count, number = before[1].select(*columns), left, number + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(pieces(docs, public_tokenizers.path(TOKENIZER)))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the documents: one row per piece, with its ids' checksum and its place."""
    return pack(pieces(docs, public_tokenizers.path(TOKENIZER)))
