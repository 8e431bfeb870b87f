"""Chat formatting with prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and only that reply under
the loss mask. Turns after the last reply (or a conversation without one) give one more example with an empty
mask, so that every turn can be read back from the output.

Template: each turn is ``[INST]role[/INST]text</s>``. Control strings inside roles and texts get a backslash
after their first character, and backslashes are doubled, so the text stays readable and comes back exactly.

Defined results: a null text or role is empty; turns are ordered by turn (null first), then role, then text;
repeated rows are turns of their own; rows with a null conv_id form one conversation; an empty table gives no
examples; other columns are not read. A conversation is one training example, so its turns meet in one task;
examples are made and sent on one at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import table

#: Fixed strings of the template and of its relatives; none of them is left intact inside a text.
CONTROL = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[SYS]", "[/SYS]")
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

SCHEMA = "conv_id long, example int, text string, loss_start long, loss_end long, last boolean"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def examples(turns: list[tuple[str, str]]) -> Iterator[tuple[str, int, int, bool]]:
    """(text, loss_start, loss_end, last) of each example; offsets count code points."""
    replies = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
    ends = replies if replies and replies[-1] == len(turns) - 1 else [*replies, len(turns) - 1]
    context, done = "", 0
    for i in ends:
        parts = [f"{OPEN}{escape(r)}{CLOSE}{escape(t)}{END}" for r, t in turns[done : i + 1]]
        context += "".join(parts)
        done = i + 1
        stop = len(context) - len(END)
        start = stop - len(escape(turns[i][1])) if turns[i][0] == "assistant" else stop
        yield context, start, stop, i == len(turns) - 1


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    out = []
    for turn in text.split(END)[:-1]:
        role, _, body = turn.removeprefix(OPEN).partition(CLOSE)
        out.append((unescape(role), unescape(body)))
    return out


def format_chats(conversations: DataFrame) -> DataFrame:
    """Examples of all conversations: conv_id, example (from 0), text, loss_start, loss_end, last."""
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def flush():
            cols = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for batch in batches:
            for conv_id, turns in zip(batch.column("conv_id"), batch.column("turns"), strict=True):
                said = [(t["role"], t["text"]) for t in turns.as_py()]
                for k, (text, start, stop, last) in enumerate(examples(said)):
                    rows.append((conv_id.as_py(), k, text, start, stop, last))
                    size += len(text)
                    if size > 4_000_000 or len(rows) >= 5000:
                        yield flush()
                        rows, size = [], 0
        if rows:
            yield flush()

    return grouped.mapInArrow(run, SCHEMA)


_READ = T.StructType([T.StructField("reply", T.StringType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType())])


@F.pandas_udf(_READ)
def _read_back(text: pd.Series, start: pd.Series, stop: pd.Series, last: pd.Series) -> pd.DataFrame:
    out = []
    for t, a, b, final in zip(text, start, stop, last, strict=True):
        turns = parse(t) if final else []
        sha = hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest() if final else None
        out.append((unescape(t[a:b]), len(turns) if final else None, sha))
    return pd.DataFrame(out, columns=["reply", "n_turns", "turns_sha256"])


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted output holds, by conversation."""
    read = formatted.withColumn("_b", _read_back("text", "loss_start", "loss_end", "last"))
    read = read.select("conv_id", "example", F.length("text").cast("long").alias("chars"), "_b.*")
    replies = F.sort_array(F.collect_list(F.struct("example", "reply")))
    grouped = read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(replies, lambda x: x["reply"]), "").alias("loss"), F.sum("chars").alias("formatted_chars"),
    )
    return grouped.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    stored = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest(format_chats(stored.unionByName(extra)))


#: The digests follow from the rows alone; formatted_chars from the template: markers, roles and texts of every
#: prefix, with one character more for each backslash and control string.
ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
    17 + length(role) + length(text)
    + length(role || text) - length(replace(role || text, '\', ''))
    + len(regexp_extract_all(role, '\[/?(INST|SYS)\]|</?s>|<</?SYS>>'))
    + len(regexp_extract_all(text, '\[/?(INST|SYS)\]|</?s>|<</?SYS>>')) AS chars
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), prefixed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM sized
)
SELECT conv_id, CAST(max(n) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(length(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant')), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM prefixed GROUP BY conv_id
"""
