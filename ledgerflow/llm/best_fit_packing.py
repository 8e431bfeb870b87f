"""Best-fit packing of tokenised documents into fixed-length sequences.

Bounded-space online best-fit: pieces are placed as they come, and a fixed number of open sequences stands in a
bitset keyed by free space. A piece goes to the fullest open sequence that still has room; if none has, a new one
opens, and where the number of open sequences would pass the bound, the fullest closes first.

Each task packs its own part of the input. What stands in its open sequences at its end is not done: these pieces
(of `most_open` sequences for a task at most) are packed again in few tasks, one for about PART_TOKENS tokens, longest
first and with all of a part's sequences open, so the number of sequences hardly depends on how the input was split. The
first step is written to the shared folder, so no text is tokenised twice; only the pieces of open sequences move.

Defined results: a null text is empty, and an empty one still yields its closing id; repeated rows are packed
each on its own; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import json
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize, release, table

SEQUENCE, EOS, OPEN, PART_TOKENS = 1024, 2, 1024, 1 << 23
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


#: The pieces that a byte-level tokenizer cuts a text into before its merges. Fixed value: the pattern of that pre-tokenizer.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """The tokens of a byte-level model as bytes with their rank, or None where the file is none or its ids do not follow its merges.

    Merges of rank i make the token of the i-th least id then, so merging the pair with the least id is merging the pair
    with the least rank.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain_bytes = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain_bytes or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(a >= b for a, b in zip(made, made[1:])):
        return None
    # the byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = {x["content"] for x in spec.get("added_tokens", [])}
    return {bytes(map(back.__getitem__, token)): rank for token, rank in model["vocab"].items() if token not in added}


class Ids:
    """Little-endian 32-bit ids of texts. The tokenizer file is read by `tokenizers`, whose ids these are; where its merges allow
    it, a faster engine does the same merges, several times as fast and without a cache. Texts that name an added token, or
    that the faster engine gives up on (very long runs of white space), go through `tokenizers` itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        ranks = merge_ranks(path)
        try:
            import tiktoken
        except ImportError:
            ranks = None
        if ranks is not None:
            self.fast = tiktoken.Encoding("ledgerflow", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def text(self, text: str) -> bytes:
        if self.fast is None or any(t in text for t in self.added):
            ids = self.whole(text)
        else:
            try:
                ids = self.fast.encode_ordinary(text)
            except BaseException as e:
                if type(e).__name__ != "PanicException":  # the engine's own failure, which no narrower class covers
                    raise
                ids = self.whole(text)
        return np.array(ids, "<u4").tobytes()


def reader(path: str) -> Ids:
    """The worker's tokenizer; it outlives the task, since Python workers are used again."""
    store = sys.modules.setdefault("_ledgerflow_tokens", types.ModuleType("_ledgerflow_tokens"))
    if path not in store.__dict__:
        store.__dict__[path] = Ids(path)
    return store.__dict__[path]


class Packer:
    """Open sequences in a bitset keyed by free space."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.bits, self.open, self.next = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        out = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return out

    def place(self, length: int) -> tuple[int, int, list[int]]:
        """The sequence, the offset in it, and the sequences that are closed by now."""
        closed = []
        room = self.bits >> length
        if room:
            free = length + (room & -room).bit_length() - 1
            seq = self._take(free)
        else:
            if self.open == self.most_open:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))  # the fullest closes
            free, seq = self.capacity, self.next
            self.next += 1
        left = free - length
        if left:
            self.by_free[left].append(seq)
            self.bits |= 1 << left
            self.open += 1
        else:
            closed.append(seq)
        return seq, self.capacity - free, closed


def pieces(doc: bytes, capacity: int) -> Iterator[tuple[int, int, int]]:
    """(piece, start, length) of a document's ids; only one longer than capacity is cut, the rest going first."""
    total = len(doc) // 4
    start, k = 0, 0
    length = total if total <= capacity else (total % capacity or capacity)
    while start < total:
        yield k, start, length
        start, k, length = start + length, k + 1, capacity


KINDS = {"doc_id": pa.int64(), "piece": pa.int32(), "ids": pa.binary(), "done": pa.bool_()}
#: Rows that a task holds before it hands them on, and bytes of ids among them.
BATCH_ROWS, BATCH_BYTES = 1 << 16, 1 << 25


def _placed(rows: Iterator[tuple], names: list[str], capacity: int, most_open: int, base: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, piece, start, length, crc[, ids]) with sequence_id, offset and done, as their sequences close;
    at the end those of open sequences, not done."""
    packer = Packer(capacity, most_open)
    held: dict[int, list[tuple]] = {}
    ready: list[tuple] = []
    size = 0

    def batch():
        cols = list(zip(*ready, strict=True)) if ready else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, KINDS.get(n, pa.int64())) for n, c in zip(names, cols, strict=True)], names)

    for row in rows:
        seq, offset, closed = packer.place(row[3])
        held.setdefault(seq, []).append((*row[:5], base + seq, offset, *row[5:]))
        for s in closed:
            done = held.pop(s)
            ready.extend((*r, True) for r in done)
            size += sum(4 * r[3] for r in done)
        if len(ready) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield batch()
            ready, size = [], 0
    ready.extend((*r, False) for rest in held.values() for r in rest)
    if ready:
        yield batch()
    ready = []
    release()


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE, eos: int = EOS, most_open: int = OPEN,
    part_tokens: int = PART_TOKENS, with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their place in a sequence; with_ids adds the piece's ids (int32, binary)."""
    schema = SCHEMA + (", ids binary" if with_ids else "") + ", done boolean"
    names = [x.split()[0] for x in schema.split(", ")]
    own = [n for n in names if n not in ("sequence_id", "offset", "done")]

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        ids = reader(tokenizer)
        end = np.asarray([eos], "<u4").tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                doc = ids.text(text.as_py() or "") + end
                for k, start, length in pieces(doc, capacity):
                    part = doc[4 * start : 4 * (start + length)]
                    yield (doc_id.as_py(), k, start, length, zlib.crc32(part), *([part] if with_ids else []))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _placed(tokens(batches), names, capacity, most_open, TaskContext.get().partitionId() << 40)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[batch.column(n).to_pylist() for n in own], strict=True))
        yield from _placed(rows, names, capacity, sys.maxsize, 1 << 62 | TaskContext.get().partitionId() << 40)

    placed = materialize(docs.select("doc_id", "text").mapInArrow(first, schema))
    open_ = placed.filter("NOT done").select(*own)
    parts = 1 + (open_.agg(F.sum("length")).first()[0] or 0) // part_tokens
    again = open_.repartition(parts).sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32")
    again = again.mapInArrow(second, schema)
    return placed.filter("done").unionByName(again).drop("done")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
