"""Language identification by compression.

Every language gets a raw-content zstandard dictionary: up to ``DICTIONARY_BYTES`` of text of that language.
Texts are lower-cased and runs of other characters than letters become one space, so that markup and capitals
don't hide the words. A text is cut into pieces of ``PIECE`` bytes; each piece is compressed with each dictionary and the
language with the smallest total wins. The margin is the gap to the runner-up as a share of the
runner-up's size; a narrow margin is rejected.

Learning takes a bounded sample: at most ``SAMPLE_DOCS`` documents a language, of each ``EXCERPTS`` excerpts of ``EXCERPT_CHARS`` characters spread over the whole
text (a shorter text whole). The dictionary has the different excerpts in turn, the first of every document before the second of any, up to ``DICTIONARY_BYTES``.
Prediction reads whole texts and nothing but the text.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and is rejected. Without any
learned language every text is ``und``. Equal sizes go to the language first by name. Repeated rows are
answered one by one. ``predict`` keeps extra columns, whatever their names, unless an output column has their name (``prefix`` avoids that).
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.llm import common, words

UNKNOWN = "und"
DICTIONARY_BYTES = 256 << 10
SAMPLE_DOCS = 400
EXCERPTS = 4
EXCERPT_CHARS = 320
PIECE = 2048
LEVEL = 5
MARGIN = 0.01
FULL_MARGIN = 0.10
OUT = (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("margin", T.DoubleType()), ("rejected", T.BooleanType()))


def letters(text: str) -> bytes:
    return b" ".join(words.split(text))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """One dictionary for each value of ``lang``, from at most ``sample_docs`` texts of it."""
    room = F.greatest(F.length("text") - EXCERPT_CHARS, F.lit(0))
    starts = [F.floor(room * i / (EXCERPTS - 1)).cast("int") + 1 for i in range(EXCERPTS)]
    excerpts = F.when(room < EXCERPT_CHARS * (EXCERPTS - 1), F.array(F.substring("text", 1, EXCERPT_CHARS * EXCERPTS))).otherwise(
        F.array(*[F.substr("text", start, F.lit(EXCERPT_CHARS)) for start in starts]))
    known = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "lang", "text")
    rows = common.sampled(known, sample_docs, "lang").select("doc_id", "lang", excerpts.alias("excerpts"))
    texts: dict[str, list[list[str]]] = {}
    for row in rows.orderBy("lang", F.xxhash64("doc_id"), "doc_id", "excerpts").collect():
        if any(map(common.has_letter, row.excerpts)):
            texts.setdefault(row.lang, []).append(row.excerpts)
    found = {}
    for lang, own in sorted(texts.items()):
        turns = [letters(excerpts[i]) for i in range(EXCERPTS) for excerpts in own if i < len(excerpts)]
        found[lang] = b"\n".join(dict.fromkeys(turns))[:dictionary_bytes]
    return found


class Classifier:
    """Compressed sizes under each dictionary; built once in each Python task."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.coders = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang] or b"\n" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False, write_dict_id=False))

    def sizes(self, text: bytes) -> list[int]:
        pieces = [text[i:i + PIECE] for i in range(0, len(text), PIECE)]
        return [sum(len(coder.compress(piece)) for piece in pieces) for coder in self.coders]

    def __call__(self, text: str | None) -> tuple[str, float, float, bool]:
        if text is None or not self.langs or not common.has_letter(text):
            return UNKNOWN, 0.0, 0.0, True
        sizes = np.array(self.sizes(letters(text)))
        best = int(np.argmin(sizes))
        if len(sizes) == 1:
            return self.langs[0], 1.0, 1.0, False
        runner_up = int(np.delete(sizes, best).min())
        margin = (runner_up - int(sizes[best])) / runner_up
        return self.langs[best], min(1.0, margin / FULL_MARGIN), margin, margin < MARGIN


def predict(docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """``keep`` columns (default all) followed by lang_pred, score, margin and rejected, each after ``prefix``."""
    names = [prefix + name for name, _ in OUT]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    source = docs.select(*[F.col(c).alias(f"k_{c}") for c in kept], F.col("text").alias("text"))
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(prefix + n, t) for n, t in OUT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries)
        for batch in common.slices(batches):
            found = [classify(text) for text in batch.column("text").to_pylist()]
            columns = [batch.column(f"k_{c}") for c in kept] + [pa.array(v, t) for v, t in zip(
                zip(*found), (pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return source.mapInArrow(run, schema)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = common.held_out(4, 2)
    dictionaries = learn(docs.where(~held))
    return predict(docs, dictionaries, ["doc_id"]).select("doc_id", held.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with a sufficient margin."""
    dictionaries = learn(common.table(spark, sf_dir, "documents").where(~common.held_out(4, 2)))
    prefix = common.unused(docs.columns, "_langid_")
    return predict(docs, dictionaries, prefix=prefix).where(~F.col(f"{prefix}rejected")).select(*docs.columns)
