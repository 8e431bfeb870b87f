"""Exact substring dedup: suffixes ordered by deep-shallow sorting.

Texts are UTF-8 bytes. A byte goes if a string of LENGTH bytes that covers it also starts in a document with a
smaller doc_id; strings are judged on the input. The suffixes of all documents are dealt out by the minimiser of
their first LENGTH bytes, so equal strings meet, and neighbouring suffixes with one minimiser travel as one run.

1. Each run goes to its minimiser's bucket as two hashes (12 bytes and its document). Runs that a batch has more
   than once are sent once, for the least document; the other documents know already that they are covered.
2. In a bucket, equal runs give the documents after the first their answer. Where one minimiser has different
   runs, their bytes are asked for: only these suffixes have to be sorted. Where it has more than HOT_RUNS (the edges of a
   passage that very many documents share), its suffixes go on one by one, dealt out by all their bytes.
3. Those are sorted deep-shallow to the depth LENGTH: multikey quicksort, eight bytes a step, to SHALLOW bytes, then blind
   tries order the groups that are still equal, branching at the first byte in which members differ and skipping all
   before it. Equal neighbours in the order are equal strings, and the least document of each keeps its own.
4. The answers of a document meet its text, whose runs are computed again, and the covered bytes go.

Runs count as equal when their minimiser's and their own 64-bit hash agree, without a look at the bytes. Two of 10^12
different runs agree in both by chance once in 10^14 jobs; a document's answers go by its run's own hash alone, which
among the 10^5 runs of a very long document agrees by chance once in 10^9 documents.

Defined results: a null text is empty; rows with one doc_id do not cover each other, and get the same answers; a
null doc_id stands last; a text shorter than LENGTH loses nothing; an empty table gives an empty result; other
columns are not read. Long texts are taken in overlapping chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.anchors import tables, text_runs
from ledgerflow.llm.common import discard, materialize, release, table
from ledgerflow.llm.shingles import mix64

LENGTH, MINIMISER, SHALLOW = 50, 20, 16
BUCKET_RUNS, BATCH_BYTES, HOT_RUNS = 500_000, 6_000_000, 8192
LAST = (1 << 63) - 1
ANSWER = np.dtype([("run", "<u8"), ("mask", "<u4")])
PIECE = np.dtype([("run", "<u8"), ("doc", "<i8"), ("first", "u1"), ("windows", "u1"), ("bytes", "u1", (2 * LENGTH - MINIMISER,))])


def _cuts(sorted_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each stretch of equal values."""
    if not len(sorted_ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))
    return starts, np.concatenate([starts[1:], [len(sorted_ids)]])


def _by(ids: np.ndarray, rec: np.ndarray) -> tuple[list[int], list[bytes]]:
    """The records of each id, packed."""
    order = np.argsort(ids, kind="stable")
    ids, rec = ids[order], rec[order]
    starts, ends = _cuts(ids)
    return ids[starts].tolist(), [rec[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]


def _doc_text(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    for d, t in zip(batch.column("d").to_pylist(), batch.column("text"), strict=True):
        yield d, (t.as_py() or "").encode("utf-8", "surrogatepass")


def _sender(buckets: int, parts: int, length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tabs = tables()
        held: list[tuple] = []
        size = 0

        def flush():
            mini, whole, doc, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((doc, whole, mini))
            mini, whole, doc, n = mini[order], whole[order], doc[order], n[order]
            first = np.concatenate([[True], (whole[1:] != whole[:-1]) | (mini[1:] != mini[:-1])])
            least = doc[first][np.cumsum(first) - 1]
            known = _addressed(doc[doc > least], whole[doc > least], _all(n[doc > least]), parts)
            # answers go through buckets of their own, which pass them on
            first_own = -(-buckets // parts) * parts
            rows = [(first_own + part, blob, None, None, None) for part, blob in zip(*known, strict=True)]
            mini, whole, doc = mini[first], whole[first], doc[first]
            n = n[first]
            to = (mini >> np.uint64(32)) % np.uint64(buckets)
            order = np.lexsort((doc, to))
            mini, whole, doc, to, n = mini[order], whole[order], doc[order], to[order], n[order]
            starts, ends = _cuts(to)
            for a, b in zip(starts, ends, strict=True):
                low = (mini[a:b] & np.uint64(0xFFFFFFFF)).astype("<u4")
                docs, at = np.unique(doc[a:b], return_inverse=True)
                rows.append((int(to[a]), low.tobytes(), whole[a:b].astype("<u8").tobytes(), at.astype("<u4").tobytes() + n[a:b].astype("u1").tobytes(), docs.astype("<i8").tobytes()))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["bucket", "b0", "b1", "b2", "b3"])

        for batch in batches:
            for d, data in _doc_text(batch):
                for _, _, (lo, hi, _, mini, whole) in text_runs(data, length, k, tabs):
                    held.append((mini, whole, np.full(len(lo), d), hi - lo + 1))
                size += len(data)
                if size >= BATCH_BYTES and held:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
        held.clear()
        release()

    return run


def _all(n: np.ndarray) -> np.ndarray:
    """A mask with the n lowest bits."""
    return ((np.uint64(1) << n.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)


#: Answers and requests travel with their document, packed by a hash of it: one row for each pair of buckets.
ADDRESSED = np.dtype([("doc", "<i8"), ("run", "<u8"), ("mask", "<u4")])


def _addressed(doc: np.ndarray, run: np.ndarray, mask: np.ndarray, parts: int) -> tuple[list[int], list[bytes]]:
    rec = np.zeros(len(doc), ADDRESSED)
    rec["doc"], rec["run"], rec["mask"] = doc, run, mask
    part = mix64(np.asarray(doc, np.int64).view(np.uint64)) % np.uint64(parts)
    return _by(part.astype(np.int64), rec)


def _split(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row for each document, with its answers."""
    rec = np.concatenate([np.frombuffer(b, ADDRESSED) for b in pdf["blob"]])
    rec = rec[np.argsort(rec["doc"], kind="stable")]
    starts, ends = _cuts(rec["doc"])
    own = np.zeros(len(rec), ANSWER)
    own["run"], own["mask"] = rec["run"], rec["mask"]
    return pd.DataFrame({"d": rec["doc"][starts], "blob": [own[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]})


def _bucket(pdf: pd.DataFrame, parts: int, hot_runs: int) -> pd.DataFrame:
    """Answers (kind 1) and requests for bytes (kind 2); the mask of a request tells whether its minimiser is hot."""
    if pdf["b1"].isna().all():
        return pd.DataFrame({"part": pdf["bucket"].astype("int32") % parts, "kind": 1, "blob": pdf["b0"]})
    mini = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["b0"]])
    whole = np.concatenate([np.frombuffer(x, "<u8") for x in pdf["b1"]])
    doc, n = [], []
    for at, docs in zip(pdf["b2"], pdf["b3"], strict=True):
        m = len(at) // 5
        doc.append(np.frombuffer(docs, "<i8")[np.frombuffer(at[: 4 * m], "<u4")])
        n.append(np.frombuffer(at[4 * m :], "u1"))
    doc, n = np.concatenate(doc), np.concatenate(n)
    order = np.lexsort((doc, whole, mini))
    mini, whole, doc, n = mini[order], whole[order], doc[order], n[order]
    new_mini = np.concatenate([[True], mini[1:] != mini[:-1]])
    first = new_mini | np.concatenate([[True], whole[1:] != whole[:-1]])
    least = doc[first][np.cumsum(first) - 1]
    later = doc > least
    starts = np.flatnonzero(new_mini)
    group = np.cumsum(new_mini) - 1
    different = np.add.reduceat(first.astype(np.int64), starts)
    several = different > 1
    several &= np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
    asked = first & several[group]
    release()
    ids, blobs = _addressed(doc[later], whole[later], _all(n[later]), parts)
    ids2, blobs2 = _addressed(doc[asked], whole[asked], (different > hot_runs)[group][asked].astype(np.uint32), parts)
    return pd.DataFrame({"part": [*ids, *ids2], "kind": [1] * len(ids) + [2] * len(ids2), "blob": [*blobs, *blobs2]})


def _row_hash(rows: np.ndarray) -> np.ndarray:
    """A hash of each row of bytes."""
    words = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    words[:, : rows.shape[1]] = rows
    out = np.zeros(len(rows), np.uint64)
    for column in words.view("<u8").T:
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


def _cut_out(padded: np.ndarray, doc: int, runs: np.ndarray, start: np.ndarray, first, n: np.ndarray, length: int) -> np.ndarray:
    """Records of n suffixes each that begin at start, the first of which is the run's suffix number `first`."""
    rec = np.zeros(len(runs), PIECE)
    rec["run"], rec["doc"], rec["first"], rec["windows"] = runs, doc, first, n
    cols = np.arange(rec["bytes"].shape[1])
    rec["bytes"] = np.where(cols < (n + length - 1)[:, None], padded[start[:, None] + cols], 0)
    return rec


def _pieces(buckets: int, length: int, k: int):
    """The bytes of the runs that were asked for, by minimiser bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tabs = tables()
        for batch in batches:
            recs, tos = [], []
            for (d, data), asked in zip(_doc_text(batch), batch.column("asked"), strict=True):
                asks = np.frombuffer(asked.as_py(), ANSWER)
                want, hot = np.unique(asks["run"]), np.unique(asks["run"][asks["mask"] > 0])
                done: set[int] = set()
                for _, part, (lo, hi, _, mini, whole) in text_runs(data, length, k, tabs):
                    hit = np.flatnonzero(np.isin(whole, want))
                    hit = hit[[int(w) not in done and not done.add(int(w)) for w in whole[hit]]] if len(hit) else hit
                    padded = np.concatenate([part, np.zeros(PIECE["bytes"].shape[0], np.uint8)])
                    single = np.isin(whole[hit], hot)
                    whole_runs, one_by_one = hit[~single], hit[single]
                    recs.append(_cut_out(padded, d, whole[whole_runs], lo[whole_runs], 0, hi[whole_runs] - lo[whole_runs] + 1, length))
                    tos.append((mini[whole_runs] >> np.uint64(32)) % np.uint64(buckets))
                    n = hi[one_by_one] - lo[one_by_one] + 1
                    own = np.repeat(one_by_one, n)
                    first = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                    rec = _cut_out(padded, d, whole[own], lo[own] + first, first, np.ones(len(own), np.int64), length)
                    recs.append(rec)
                    tos.append(_row_hash(rec["bytes"][:, :length]) % np.uint64(buckets))
            if recs:
                ids, blobs = _by(np.concatenate(tos).astype(np.int64), np.concatenate(recs))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    return run


def blind_tries(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order the rows of each group (equal group numbers stand together) and number the equal ones.

    All tries grow at once, a level at a time. A node looks at one byte only, the first in which its members
    differ from their leader; what lies before it is equal and skipped.
    """
    order = np.arange(len(rows))
    label = group.copy()
    apart = int(group.max(initial=0)) + 1
    done = np.zeros(len(rows), bool)
    while True:
        live = np.flatnonzero(~done)
        if not len(live):
            break
        own, mine = rows[order[live]], label[live]
        starts, _ = _cuts(mine)
        node = np.cumsum(np.concatenate([[False], mine[1:] != mine[:-1]])) if len(mine) else mine
        differs = own != own[starts][node]
        some = differs.any(axis=1)
        depth = np.where(some, differs.argmax(axis=1), rows.shape[1])
        branch = np.minimum.reduceat(depth, starts)
        ended = branch == rows.shape[1]  # all members are equal
        done[live[ended[node]]] = True
        go = live[~ended[node]]
        if not len(go):
            break
        node = node[~ended[node]]
        byte = rows[order[go], branch[node]].astype(np.int64)
        by = np.lexsort((byte, node))
        order[go] = order[go][by]
        byte, node = byte[by], node[by]
        new = np.concatenate([[False], (byte[1:] != byte[:-1]) & (node[1:] == node[:-1])])
        # a label that is unique among all: the place where the new group starts
        split = np.concatenate([[True], node[1:] != node[:-1]]) | new
        at = np.maximum.accumulate(np.where(split, np.arange(len(go)), 0))
        label[go] = go[at] + apart
        sizes = np.diff(np.concatenate([np.flatnonzero(split), [len(go)]]))
        done[go[np.repeat(sizes == 1, sizes)]] = True
    same = np.concatenate([[False], label[1:] == label[:-1]]) if len(rows) else np.zeros(0, bool)
    return order, same


def multikey(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of rows of words: the order, and for each place in it whether the row equals the one before.

    All groups are partitioned at once, each in three ways by the word of its middle row at the group's depth; what equals
    that word goes on one word deeper.
    """
    n, width = words.shape
    order, depth, head = np.arange(n), np.zeros(n, np.int64), np.zeros(n, bool)
    head[:1] = True
    live = np.arange(n if width else 0)
    while len(live):
        starts = np.flatnonzero(head[live])
        sizes = np.diff(np.append(starts, len(live)))
        node = np.repeat(np.arange(len(starts)), sizes)
        value = words[order[live], depth[live]]
        pivot = value[starts + sizes // 2][node]
        to, begins = np.empty(len(live), np.int64), starts.copy()
        fresh = np.zeros(len(live), bool)
        for part in (value < pivot, value == pivot, value > pivot):
            upto = np.cumsum(part)
            before = upto[starts] - part[starts]
            to[part] = (begins[node] + upto - 1 - before[node])[part]
            count = upto[starts + sizes - 1] - before
            fresh[begins[count > 0]] = True
            begins = begins + count
        deeper, rows = depth[live] + (value == pivot), order[live]
        order[live[to]], depth[live[to]] = rows, deeper
        head[live[fresh]] = True
        # groups of one row, and those whose words are used up, are done
        starts = np.flatnonzero(head[live])
        sizes = np.diff(np.append(starts, len(live)))
        live = live[np.repeat((sizes > 1) & (depth[live[starts]] < width), sizes)]
    return order, ~head


def deep_shallow(windows: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows of bytes, and for each place in it whether the row equals the one before."""
    if not len(windows):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    keys = np.ascontiguousarray(windows[:, :shallow]).view(">u8").astype(np.uint64)
    order, tied = multikey(keys)
    group = np.cumsum(~tied) - 1
    in_group = tied | np.concatenate([tied[1:], [False]])
    at = np.flatnonzero(in_group)
    same = np.zeros(len(windows), bool)
    if len(at):
        deep, equal = blind_tries(windows[order[at], shallow:], group[at])
        order[at] = order[at][deep]
        same[at] = equal
        same[at] &= tied[at]
    return order, same


def _sorted_answers(length: int, parts: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rec = np.concatenate([np.frombuffer(b, PIECE) for b in pdf["blob"]])
        n = rec["windows"].astype(np.int64)
        owner = np.repeat(np.arange(len(rec)), n)
        shift = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        # a view of all stretches of `length` bytes: picking from it needs no index for each byte
        windows = np.lib.stride_tricks.sliding_window_view(rec["bytes"], length, axis=1)[owner, shift]
        order, same = deep_shallow(windows)
        del windows
        starts = np.flatnonzero(~same)
        least = np.minimum.reduceat(rec["doc"][owner[order]], starts)[np.cumsum(~same) - 1]
        covered = order[least < rec["doc"][owner[order]]]
        mask = np.zeros(len(rec), np.uint64)
        np.bitwise_or.at(mask, owner[covered], np.uint64(1) << (shift[covered] + rec["first"][owner[covered]]).astype(np.uint64))
        hit = mask > 0
        ids, blobs = _addressed(rec["doc"][hit], rec["run"][hit], mask[hit].astype(np.uint32), parts)
        del rec, order, same, owner, shift
        release()
        return pd.DataFrame({"part": pd.Series(ids, dtype="int32"), "kind": pd.Series([1] * len(ids), dtype="int64"), "blob": blobs})

    return run


def covered(data: bytes, answers: bytes | None, length: int, k: int, tabs) -> np.ndarray:
    """Which bytes of a text go."""
    out = np.zeros(len(data), bool)
    if not answers or len(data) < length:
        return out
    rec = np.frombuffer(answers, ANSWER)
    rec = rec[np.argsort(rec["run"], kind="stable")]
    starts, _ = _cuts(rec["run"])
    keys, masks = rec["run"][starts], np.bitwise_or.reduceat(rec["mask"], starts)
    edge = np.zeros(len(data) + 1, np.int64)
    for offset, _, (lo, hi, _, _, whole) in text_runs(data, length, k, tabs):
        at = np.minimum(np.searchsorted(keys, whole), len(keys) - 1)
        mask = np.where(keys[at] == whole, masks[at], 0)
        n = hi - lo + 1
        window = np.arange(int(n.sum())) + lo[0]
        shift = window - np.repeat(lo, n)
        gone = window[(np.repeat(mask, n) >> shift.astype(np.uint32)) & 1 == 1] + offset
        edge[gone] += 1
        edge[gone + length] -= 1
    return np.cumsum(edge[:-1]) > 0


OUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _finish(length: int, k: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tabs = tables()
        for batch in batches:
            rows = []
            for doc_id, (_, data), answers in zip(batch.column("doc_id").to_pylist(), _doc_text(batch), batch.column("answers"), strict=True):
                gone = covered(data, answers.as_py(), length, k, tabs)
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                spans = edges.reshape(-1, 2).tolist()
                rows.append((doc_id, len(data), int(gone.sum()), len(spans), hashlib.sha256(kept).hexdigest(), *([kept, spans] if with_text else [])))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.list_(pa.int64()))]
            names = ["doc_id", *(x.split()[0] for x in OUT.split(", ")), "kept", "spans"]
            cols = list(zip(*rows, strict=True)) or [[]] * (7 if with_text else 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=False)], names[: len(cols)])

    return run


def dedup(docs: DataFrame, length: int = LENGTH, k: int = MINIMISER, with_text: bool = False, hot_runs: int = HOT_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; with_text adds the kept bytes and the removed spans."""
    texts = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("d"), "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + int(total * 2 / (length - k + 2)) // BUCKET_RUNS
    parts = max(16, buckets)
    sent = texts.select("d", "text").mapInArrow(_sender(buckets, parts, length, k), "bucket int, b0 binary, b1 binary, b2 binary, b3 binary")
    met = materialize(sent.groupBy("bucket").applyInPandas(lambda pdf: _bucket(pdf, parts, hot_runs), "part int, kind long, blob binary"))

    def by_doc(packed: DataFrame, name: str) -> DataFrame:
        return packed.groupBy("part").applyInPandas(_split, "d long, blob binary").withColumnRenamed("blob", name)

    asked = by_doc(met.filter("kind = 2"), "asked")
    bytes_ = texts.join(asked, "d").select("d", "text", "asked").mapInArrow(_pieces(buckets, length, k), "bucket int, blob binary")
    sorted_ = bytes_.groupBy("bucket").applyInPandas(_sorted_answers(length, parts), "part int, kind long, blob binary")
    answers = materialize(by_doc(met.filter("kind = 1").unionByName(sorted_), "answers"))
    discard(met)
    joined = texts.join(answers, "d", "left").select("doc_id", "d", "text", "answers")
    extra = ", kept binary, spans array<array<long>>" if with_text else ""
    return joined.mapInArrow(_finish(length, k, with_text), f"doc_id long, {OUT}{extra}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
