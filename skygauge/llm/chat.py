"""Chat formatting with a grammar round trip.

A conversation is the concatenation of its turns in the order of (turn, role, text):

    turn      := "<s>" "assistant" "\\n" text "</s>"  |  "[INST]" role "\\n" text "[/INST]"

The parser looks for the first closing mark of the kind it is in, splits role and text at the first line end, and takes one
backslash away from every control string that has some before its last character. A turn is rendered plain, parsed again, and
compared with its source; if they differ, its control strings get one more backslash each, until they agree.
Training loss covers the texts of the assistant.

Rendering is done row by row where the rows are; reading back streams over rows sorted by conversation, holding one batch,
so a conversation of any length needs no more memory.

Defined results: a null text or role is empty; rows without conv_id are one conversation of their own; a null turn comes first;
equal rows are all kept. An empty table gives an empty result. Extra columns are ignored.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygauge.llm import common

LEARNED_ROLE = "assistant"
MARKS = {True: ("<s>", "</s>"), False: ("[INST]", "[/INST]")}
_CONTROL = re.compile(r"(</?s|\[/?INST)(\\*)([>\]])")
_ESCAPED = re.compile(r"(</?s|\[/?INST)\\(\\*)([>\]])")
PROBE = "</s>[INST] ok [/INST]"
TURNS = "conv_id long, turn long, role string, text string, formatted string, loss_start int, loss_end int"


def _body(text: str, escapes: int) -> str:
    for _ in range(escapes):
        text = _CONTROL.sub(r"\1\2\\\3", text)
    return text


def _role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)


def unescaped(body: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", body)


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, start and end of the text in ``formatted``) of every turn; None outside the grammar."""
    found, at = [], 0
    while at < len(formatted):
        learned = formatted.startswith(MARKS[True][0], at)
        start, end = MARKS[learned]
        if not formatted.startswith(start, at):
            return None
        stop = formatted.find(end, at + len(start))
        split = formatted.find("\n", at + len(start), stop)
        if stop < 0 or split < 0:
            return None
        role = _unrole(unescaped(formatted[at + len(start):split]))
        found.append((role, unescaped(formatted[split + 1:stop]), split + 1, stop))
        at = stop + len(end)
    return found


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its text stands in it, with as many escapes as the round trip needs."""
    start, end = MARKS[role == LEARNED_ROLE]
    for escapes in range(3):
        head = f"{start}{_body(_role(role), escapes)}\n"
        body = _body(text, escapes)
        formatted = f"{head}{body}{end}"
        back = parse(formatted)
        if back is not None and len(back) == 1 and back[0][:2] == (role, text):
            return formatted, len(head), len(head) + len(body)
    raise ValueError("a turn does not survive the round trip")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn with its formatted text; loss_start and loss_end mark the trained characters (equal: none)."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            roles = batch.column("role").to_pylist()
            done = [render(role, text) for role, text in zip(roles, batch.column("text").to_pylist())]
            learned = [role == LEARNED_ROLE for role in roles]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([d[0] for d in done], pa.string()), pa.array([d[1] * x for d, x in zip(done, learned)], pa.int32()),
                pa.array([d[2] * x for d, x in zip(done, learned)], pa.int32())], names=[*batch.schema.names, "formatted", "loss_start", "loss_end"])

    return rows.mapInArrow(run, TURNS)


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of every conversation: turns parsed from the formatted text alone, the loss read under its mask."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "formatted", "loss_start", "loss_end")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def result(rows):
            columns = zip(*[(conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]) for conv, s in rows])
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in common.slices(batches, "formatted"):
            done = []
            convs, texts = batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist()
            masks = list(zip(batch.column("loss_start").to_pylist(), batch.column("loss_end").to_pylist()))
            start = 0
            for i in range(1, len(convs) + 1):
                if i < len(convs) and convs[i] == convs[start]:
                    continue
                if state is None or convs[start] != now:
                    if state is not None:
                        done.append((now, state))
                    now, state = convs[start], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                whole = "".join(texts[start:i])
                for role, text, _, _ in parse(whole):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                for formatted, (begin, end) in zip(texts[start:i], masks[start:i]):
                    learned = unescaped(formatted[begin:end])
                    state[2] += len(learned)
                    state[3].update(learned.encode("utf-8", "replace"))
                state[4] += len(whole)
                start = i
            if done:
                yield result(done)
        if state is not None:
            yield result([(now, state)])

    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(given.unionByName(probe)))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, role = 'assistant' AS learned,
         CASE WHEN (role = 'assistant' AND contains(text, '</s>')) OR (role <> 'assistant' AND contains(text, '[/INST]'))
                OR regexp_matches(text, '(</?s|\[/?INST)\\+[>\]]')
              THEN len(regexp_extract_all(text, '(</?s|\[/?INST)\\*[>\]]')) ELSE 0 END AS escapes
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN learned THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE learned), '')) AS loss_sha256,
       CAST(sum(length(role) + 1 + length(text) + escapes + CASE WHEN learned THEN 7 ELSE 13 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
