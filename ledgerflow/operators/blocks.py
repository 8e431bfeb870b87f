"""Products over the graph, block by block.

A recurrence that keeps a row for every pair of vertices joins each pair with all edges behind it: the square of the pairs
in rows, if edges are many. Here a task gets the pairs of some start vertices as lists, and beside them one list of edges for
each vertex that these pairs reach; it multiplies them in memory, as matrices over the vertices that occur. So no row is
made for a walk. Vertices are numbered so that linked ones lie near each other: the starts of a block then share most edge lists.
Sums of money are exact: amounts and factors are whole numbers, cut into limbs whose products cannot exceed an integer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.schemas import FACTOR, PART
from ledgerflow.sources.store import checkpointed

#: Start vertices of a block; a larger one sends edge lists less often, and holds more bits in memory.
BLOCK = 2048
#: Names of vertices that may be sent to every task.
NAMES = 1_000_000


def block(c: str):
    return F.floor(F.col(c) / BLOCK).cast("int").alias("b")


def numbered(edges: DataFrame) -> DataFrame:
    """v, i: the vertices of edges (src, dst) with numbers from 0, by the least vertex within two steps and then by name."""
    both = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(edges.select(F.col("dst").alias("u"), F.col("src").alias("v")))
    near = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("near"))
    near = both.join(near.withColumnRenamed("v", "u"), "u").groupBy("v").agg(F.min("near").alias("near"))
    placed = checkpointed(near.repartitionByRange("near", "v").sortWithinPartitions("near", "v").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    # one row for each partition: bounded by their number
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    joined = placed.withColumn("p", part).join(starts, "p")
    return joined.select("v", (F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).cast("int").alias("i"))


def small(ids: DataFrame) -> DataFrame:
    """Names to be looked up by pairs: the pairs are up to their square, and are not shuffled for them where the names fit a task."""
    return F.broadcast(ids) if ids.count() <= NAMES else ids


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and for each the row it is in."""
    got = table.column(name).combine_chunks()
    got = got.chunk(0) if isinstance(got, pa.ChunkedArray) and got.num_chunks else got
    if not len(got):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return got.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(got)), got.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))


def packed_lists(rows: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """The other way: n lists of values whose rows ascend."""
    ends = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def finder(names: np.ndarray):
    """A function from numbers to their places in ascending names, -1 where they are not there."""
    low, span = (int(names[0]), int(names[-1] - names[0]) + 1) if len(names) else (0, 0)
    if span > 4 * len(names) + (1 << 20):

        def search(v: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(names, v), len(names) - 1)
            return np.where(names[at] == v, at, -1)

        return search
    # the last place is that of all numbers outside
    place = np.full(span + 1, -1, np.int32)
    place[names - low] = np.arange(len(names))
    return lambda v: place[np.where((v >= low) & (v < low + span), v - low, span)]


def reached(table: pa.Table):
    """The vertices that a row of HOPS holds, row by row."""
    for batch in table.to_batches():
        to, base, bits = batch.column("to"), batch.column("base"), batch.column("bits")
        values, cuts = to.values.to_numpy(zero_copy_only=False), to.offsets.to_numpy()
        for i in range(batch.num_rows):
            if bits[i].is_valid:
                yield np.flatnonzero(np.unpackbits(np.frombuffer(bits[i].as_buffer(), np.uint8))) + base[i].as_py()
            else:
                yield values[cuts[i] : cuts[i + 1]]


def packed(v: np.ndarray) -> tuple[list | None, int | None, bytes | None]:
    """Ascending numbers as to, base and bits: a list, or one bit for each number from the first on where that is shorter."""
    span = int(v[-1] - v[0]) + 1
    if 32 * len(v) <= span:
        return v, None, None
    some = np.zeros(span, bool)
    some[v - v[0]] = True
    return None, int(v[0]), np.packbits(some).tobytes()


def by_vertex(sets, of: np.ndarray, n: int, at, wide: int) -> np.ndarray:
    """Sets of vertices, each of one of n starts, as a bit for each place (at) and start: rows of places, columns of starts."""
    bits = np.zeros((wide, -(-n // 64) * 8), np.uint8)
    for i, v in zip(of, sets, strict=True):
        here = at(v)
        bits[here[here >= 0], i >> 3] |= np.uint8(128 >> (i & 7))
    return bits


def next_hops(k: int):
    """For each start of a block the vertices behind those of its level k - 1 that it has not met, and in one row without a
    start all of them. A vertex holds a bit for each start, so an edge is one word for 64 starts.

    left: HOPS (all levels so far); right: for (the block), m, next (the edges of the vertices of level k - 1).
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        starts, of = np.unique(column(left, "o"), return_inverse=True)
        mids, place = np.unique(column(right, "m"), return_inverse=True)
        nexts = [batch.column("next") for batch in right.select(["next"]).to_batches()]
        nexts = [(x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()) for x in nexts]
        low, high = min((x.min() for x, _ in nexts if len(x)), default=0), max((x.max() for x, _ in nexts if len(x)), default=-1)
        some = np.zeros(int(high) - int(low) + 1, bool)
        for x, _ in nexts:
            some[x - low] = True
        targets = (np.flatnonzero(some) + low).astype(np.int32)
        at = finder(targets)
        last = column(left, "hops") == k - 1
        front = by_vertex(reached(left.filter(pa.array(last))), of[last], len(starts), finder(mids), len(mids)).view(np.uint64)
        met = by_vertex(reached(left), of, len(starts), at, len(targets))
        own = at(starts)
        for i in np.flatnonzero(own >= 0):
            met[own[i], i >> 3] |= 128 >> (i & 7)
        met = met.view(np.uint64)
        every = by_vertex([np.zeros(1, int)] * len(starts), np.arange(len(starts)), len(starts), lambda v: v, 1).view(np.uint64)
        # vertices that all starts have met need no edges
        open_ = (met != every).any(axis=1)
        new, row = np.zeros_like(met), 0
        for values, cuts in nexts:
            i = 0
            while i < len(cuts) - 1:
                j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + SLICE, side="right")) - 1)
                mid, col = np.repeat(place[row + i : row + j], np.diff(cuts[i : j + 1])), at(values[cuts[i] : cuts[j]])
                keep = open_[col]
                mid, col = mid[keep], col[keep]
                order = np.argsort(col.astype(np.uint16) if len(targets) <= 1 << 16 else col, kind="stable")
                mid, col = mid[order], col[order]
                begin = np.flatnonzero(np.diff(col, prepend=-1))
                found, begin = col[begin], np.append(begin, len(col))
                x = 0
                while x < len(found):
                    y = max(x + 1, int(np.searchsorted(begin, begin[x] + EDGES, side="right")) - 1)
                    new[found[x:y]] |= np.bitwise_or.reduceat(front[mid[begin[x] : begin[y]]], begin[x:y] - begin[x], axis=0)
                    x = y
                i = j
            row += len(cuts) - 1
        new &= ~met
        b = int(left.column("b")[0].as_py()) if left.num_rows else 0
        rows = []
        for g in range(0, len(starts), 64):
            mine = np.unpackbits(new[:, g // 64 : g // 64 + 1].copy().view(np.uint8), axis=1).T.copy()
            for i in range(min(64, len(starts) - g)):
                v = targets[np.flatnonzero(mine[i])]
                if len(v):
                    rows.append((int(starts[g + i]), *packed(v)))
        if rows:
            rows.append((None, targets[new.any(axis=1)], None, None))
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.binary()]
        arrays = [[b] * len(rows), cols[0], [k] * len(rows), *cols[1:]]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(arrays, kinds, strict=True)], ["b", "o", "hops", "to", "base", "bits"])

    return run


#: What a start reaches over its least number of edges: as numbers (to), or as bits from the number base on.
HOPS = "b int, o int, hops int, to array<int>, base int, bits binary"
#: Edges that are sorted at once, and those whose words are in memory at once.
SLICE, EDGES = 1 << 20, 1 << 16


def unpacked(table: pa.Table) -> pa.Table:
    """Rows of a few starts with lists alone."""
    sets = list(reached(table))
    to = packed_lists(np.repeat(np.arange(len(sets)), [len(v) for v in sets]), np.concatenate(sets).astype(np.int32), len(sets), pa.int32())
    return table.select(["origin", "o", "hops"]).append_column("to", to)


def unpacked_levels(named: DataFrame) -> DataFrame:
    """A task gets 16 starts at a time: a row may hold all vertices, and plain batches have as many rows as the session says."""
    few = named.select("origin", "o", "hops", "to", "base", "bits").groupBy(F.shiftright("o", 4).alias("few"))
    return few.applyInArrow(unpacked, "origin string, o int, hops int, to array<int>")


def hop_levels(edges: DataFrame, most: int | None) -> tuple[DataFrame, DataFrame]:
    """The vertices (v, i), and for each start and number of edges the list of what is that far: origin, o, hops, to."""
    edges = checkpointed(edges.select("src", "dst").filter("src <> dst").distinct())
    ids = checkpointed(numbered(edges))
    s, d = ids.select(F.col("v").alias("src"), F.col("i").alias("o")), ids.select(F.col("v").alias("dst"), F.col("i").alias("d"))
    by = edges.join(s, "src").join(d, "dst").groupBy("o").agg(F.array_sort(F.collect_list("d")).alias("to"))
    none = F.lit(None).cast("int").alias("base"), F.lit(None).cast("binary").alias("bits")
    level = checkpointed(by.select(block("o"), "o", F.lit(1).alias("hops"), "to", *none).repartition("b"))
    behind = level.select(F.col("o").alias("m"), F.col("to").alias("next"))
    seen, k, ends = level, 1, level
    while (most is None or k < most) and level.limit(1).count():
        k += 1
        need = ends.select(F.col("b").alias("for"), F.explode("to").alias("m")).distinct().join(behind, "m").select("for", "m", "next")
        # blocks that found nothing in the last level are done
        left = seen if k == 2 else seen.join(level.select("b").distinct(), "b", "left_semi")
        level = checkpointed(left.groupBy("b").cogroup(need.groupBy("for")).applyInArrow(next_hops(k), HOPS))
        seen, ends = seen.unionByName(level.filter("o IS NOT NULL")), level.filter("o IS NULL")
    named = seen.join(small(ids).select(F.col("v").alias("origin"), F.col("i").alias("o")), "o")
    return ids, unpacked_levels(named)


#: Bits of a limb: products of two, summed over a matrix's columns in memory, stay below 2 ** 53.
LIMB, DEEP = 20, 4096
#: Decimal places of an amount and of a factor (schemas.PART and FACTOR).
PLACES, FACTOR_PLACES = 4, 12
#: Targets whose factors are in memory at once, as a row for each and a column for each vertex of a block.
ROWS = 32
#: Products of factors that are in memory at once.
PRODUCTS = 1 << 18


def _limb(a: np.ndarray, i: int) -> np.ndarray:
    """The highest one takes the sign, and what is left."""
    return (a >> (LIMB * i) & ((1 << LIMB) - 1) if i < 2 else a >> (LIMB * i)).astype(np.float64)


def limbs_of(a: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The limbs of whole numbers below 2 ** 60 that are not all 0, with their places."""
    return [(i, x) for i in range(3) if (x := _limb(a, i)).any()]


def joined(sums: np.ndarray) -> np.ndarray:
    """Python's integers from sums of products of limbs, by the sum of their places."""
    return sum(x.astype(object) * (1 << LIMB * i) for i, x in enumerate(sums))


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two matrices of whole numbers below 2 ** 60, with DEEP columns at most, as Python's integers."""
    sums = np.zeros((5, a.shape[0], b.shape[1]), np.int64)
    add_product(sums, a, limbs_of(b))
    return joined(sums)


def add_product(sums: np.ndarray, a: np.ndarray, b: list[tuple[int, np.ndarray]]) -> None:
    for i, x in limbs_of(a):
        for j, y in b:
            sums[i + j] += (x @ y).astype(np.int64)


def units(m: np.ndarray) -> np.ndarray:
    """Factors as whole numbers of their last place, rounded half up."""
    if m.size and not np.abs(m).max() < 1e6:
        raise ValueError("a factor is too large for its decimal")
    return np.floor(m * 10.0**FACTOR_PLACES + 0.5).astype(np.int64)


def money(total: int) -> str:
    """A product of an amount and a factor as a decimal's text."""
    places = PLACES + FACTOR_PLACES
    text = str(abs(total)).rjust(places + 1, "0")
    return f"{'-' if total < 0 else ''}{text[:-places]}.{text[-places:]}"


def crossed(hops: int, most: int, size: int):
    """What reaches the targets of one block from the vertices of another by kind, over a front of factors whose edges number
    hops - 1. If one edge more is the last, also what comes over it, whose factors are then never written; if not, that front.

    left: u (the block of vertices, of size numbers), t, v (the front's vertices), m (their factors); right: m (a vertex), and kinds, ws
    (of the block's vertices: what came to them, in the amount's last place) or next, share (the block's vertices behind one of
    the front, and what each hands on).
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        t, of = np.unique(column(left, "t"), return_inverse=True)
        n, low = len(t), int(left.column("u")[0].as_py()) * size if left.num_rows else 0
        v, row = lists(left, "v")
        m, row = lists(left, "m")[0], of[row].astype(np.int32)
        came, steps = right.filter(right.column("kinds").is_valid()), right.filter(right.column("next").is_valid())
        names = came.column("kinds").combine_chunks()
        names = names.chunk(0) if isinstance(names, pa.ChunkedArray) and names.num_chunks else names
        coded = names.flatten().dictionary_encode(null_encoding="encode") if came.num_rows else None
        kinds = coded.dictionary.to_pylist() if coded is not None else []
        amounts, known = np.zeros((size, len(kinds)), np.int64), np.zeros((size, len(kinds)), bool)
        if kinds:
            w, w_row = lists(came, "ws")
            cell = column(came, "m")[w_row] - low, coded.indices.to_numpy(zero_copy_only=False)
            amounts[cell], known[cell] = w, True
        tables = []

        def give(k: int, sums: np.ndarray, some: np.ndarray) -> None:
            r, c = np.nonzero(some)
            total = joined(sums)
            cols = [t[r], [kinds[x] for x in c], np.full(len(r), k), [money(total[x, y]) for x, y in zip(r, c, strict=True)]]
            arrays = [pa.array(x, kind) for x, kind in zip(cols, (pa.int32(), pa.string(), pa.int32(), pa.string()), strict=True)]
            tables.append(pa.Table.from_arrays([*arrays, pa.nulls(len(r), pa.list_(pa.int32())), pa.nulls(len(r), pa.list_(pa.float64()))], FLOWS))

        # a vertex is once in a target's front, so a sum has size terms at most
        here = np.flatnonzero((v >= low) & (v < low + size))
        r, c, f = row[here], v[here] - low, limbs_of(units(m[here]))
        sums, some = np.zeros((5, n, len(kinds)), np.int64), np.zeros((n, len(kinds)), bool)
        for k in range(len(kinds)):
            for j, y in limbs_of(amounts[:, k]):
                for i, x in f:
                    sums[i + j][:, k] += np.bincount(r, x * y[c], n).astype(np.int64)
            some[:, k] = np.bincount(r, known[c, k], n) > 0
        give(hops, sums, some)
        del here, r, c, f
        if hops == most:
            return pa.concat_tables(tables)
        order = np.argsort(column(steps, "m"), kind="stable")
        mids = column(steps, "m")[order]
        ends, end_row = lists(steps, "next")
        ends, end_row, share = ends - low, end_row.astype(np.int32), lists(steps, "share")[0]
        count = np.bincount(end_row, minlength=steps.num_rows)
        begin = np.cumsum(count) - count
        at = np.minimum(np.searchsorted(mids, v), max(0, len(mids) - 1))
        here = np.flatnonzero(mids[at] == v) if len(mids) else np.zeros(0, np.int64)
        here = here[np.argsort(row[here], kind="stable")]
        row, m, at = row[here], m[here], order[at[here]]
        last = hops + 1 == most
        some = np.zeros((n, len(kinds)), bool)
        for k in range(len(kinds) if last else 0):
            behind = np.bincount(end_row, known[ends, k], len(count)) > 0
            some[:, k] = np.bincount(row, behind[at], n) > 0
        parts = [(a, limbs_of(amounts[a : a + DEEP])) for a in range(0, size, DEEP)]
        sums, fronts = np.zeros((5, n, len(kinds)), np.int64), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for a in range(0, n, ROWS):
            rows = min(ROWS, n - a)
            x, y = np.searchsorted(row, [a, a + rows])
            front, hit = np.zeros(rows * size), np.zeros(0 if last else rows * size, bool)
            total = np.cumsum(count[at[x:y]])
            while x < y:
                part = max(1, int(np.searchsorted(total, PRODUCTS, side="right")))
                which = at[x : x + part]
                times = count[which]
                cell = np.arange(int(times.sum())) + np.repeat(begin[which] - (np.cumsum(times) - times), times)
                key = np.repeat((row[x : x + part] - a).astype(np.int64) * size, times) + ends[cell]
                front += np.bincount(key, share[cell] * np.repeat(m[x : x + part], times), len(front))
                if not last:
                    hit[key] = True
                x, total = x + part, total[part:] - total[part - 1]
            front = front.reshape(rows, size)
            if last:
                whole = units(front)
                for b, y in parts if kinds else ():
                    add_product(sums[:, a : a + rows], whole[:, b : b + DEEP], y)
            else:
                r, c = np.nonzero(hit.reshape(rows, size))
                fronts.append((r + a, c + low, front[r, c]))
        if last:
            give(most, sums, some)
        else:
            r, c, f = (np.concatenate(x) for x in zip(*fronts, strict=True))
            kept, r = np.unique(r, return_inverse=True)
            none = [pa.nulls(len(kept), kind) for kind in (pa.string(), pa.int32(), pa.string())]
            tables.append(pa.Table.from_arrays([pa.array(t[kept], pa.int32()), *none, packed_lists(r, c, len(kept), pa.int32()), packed_lists(r, f, len(kept), pa.float64())], FLOWS))
        return pa.concat_tables(tables)

    return run


FLOWS = ["t", "kind", "hops", "amount", "v", "m"]


def inflow_levels(weights: DataFrame, came: DataFrame, most: int) -> DataFrame | None:
    """target, kind, hops, amount for two hops and more; weights: src, dst, share (null where the source hands nothing on);
    came: cmte_id, kind, w.

    A task gets the front of a block of targets and the edges out of a block of vertices, so neither is large, and the edges move
    as often as there are blocks. The factors of the last front, up to one for each pair, stay in the task.
    """
    if most < 2:
        return None
    size = 4 * BLOCK
    cell = lambda c, name: F.floor(F.col(c) / size).cast("int").alias(name)
    own = came.select(F.col("cmte_id").alias("src"), F.col("cmte_id").alias("dst")).distinct()
    ids = checkpointed(numbered(weights.select("src", "dst").unionByName(own)))
    s, d = ids.select(F.col("v").alias("src"), F.col("i").alias("s")), ids.select(F.col("v").alias("dst"), F.col("i").alias("d"))
    edges = weights.filter("share IS NOT NULL").join(s, "src").join(d, "dst").groupBy("d", cell("s", "u")).agg(F.array_sort(F.collect_list(F.struct("s", "share"))).alias("l"))
    steps = checkpointed(edges.select(F.col("d").alias("m"), "u", F.col("l.s").alias("next"), F.col("l.share").alias("share")))
    front = steps.select(cell("m", "tb"), F.col("m").alias("t"), F.col("next").alias("v"), F.col("share").alias("m"))
    sums = came.join(ids.select(F.col("v").alias("cmte_id"), F.col("i").alias("m")), "cmte_id")
    sums = sums.groupBy("m").agg(F.collect_list(F.struct("kind", (F.col("w") * 10**PLACES).cast("long").alias("w"))).alias("l"))
    sums = checkpointed(sums.select("m", cell("m", "u"), F.col("l.kind").alias("kinds"), F.col("l.w").alias("ws")))
    found = None
    for hops in range(2, max(2, most - 1) + 1):
        reach = checkpointed(front.select("tb", F.explode("v").alias("m")).distinct())
        cells = reach.select("tb", cell("m", "u"))
        if hops < most:
            cells = cells.unionByName(reach.join(steps.select("m", "u"), "m").select("tb", "u"))
        cells = checkpointed(cells.distinct())
        right = sums.join(cells, "u").select("tb", "u", "m", "kinds", "ws", F.lit(None).cast("array<int>").alias("next"), F.lit(None).cast("array<double>").alias("share"))
        if hops < most:
            right = right.unionByName(reach.join(steps, "m"), allowMissingColumns=True)
        left = front.join(cells, "tb").select("tb", "u", "t", "v", "m")
        both = left.groupBy("tb", "u").cogroup(right.groupBy("tb", "u"))
        made = checkpointed(both.applyInArrow(crossed(hops, most, size), "t int, kind string, hops int, amount string, v array<int>, m array<double>"))
        part = made.filter("v IS NULL").select("t", "kind", F.col("hops").cast("long"), F.col("amount").cast("decimal(38,16)").alias("amount"))
        found = part if found is None else found.unionByName(part)
        front = made.filter("v IS NOT NULL").select(cell("t", "tb"), "t", "v", "m")
    found = found.groupBy("t", "kind", "hops").agg(F.sum("amount").cast("decimal(38,16)").alias("amount"))
    return found.join(ids.select(F.col("v").alias("target"), F.col("i").alias("t")), "t").select("target", "kind", "hops", "amount")


#: Bits of a limb where sums are made by bincount, and products that are in memory at once.
SHORT, CROWD = 16, 1 << 21
#: Amounts in a block of labels.
AMOUNTS = 1_000_000


def decimals(limbs: list[np.ndarray]) -> pa.Array:
    """Whole numbers given by eight limbs of SHORT bits that may overflow and be negative, in the last place of a decimal(38,16)."""
    carry, words = np.zeros(len(limbs[0]), np.int64), np.zeros((len(limbs[0]), 8), np.uint16)
    for i, limb in enumerate(limbs):
        whole = limb + carry
        words[:, i], carry = (whole & 0xFFFF).astype(np.uint16), whole >> SHORT
    return pa.Array.from_buffers(pa.decimal128(38, PLACES + FACTOR_PLACES), len(words), [None, pa.py_buffer(np.ascontiguousarray(words).tobytes())])


def shared_money(left: pa.Table, right: pa.Table) -> pa.Table:
    """The exact sum over committees of amount times factor, for each label of a block and each candidate.

    left: b, kind, label, i (committees), w (amounts); right: for, i (a committee), c (candidates), m (their factors).
    """
    order = np.argsort(column(right, "i"), kind="stable")
    mids = column(right, "i")[order]
    c, c_row = lists(right, "c")
    m = lists(right, "m")[0]
    cands, c = np.unique(c, return_inverse=True)
    count = np.bincount(c_row, minlength=right.num_rows)
    begin = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64)
    i, row = lists(left, "i")
    w = lists(left, "w")[0]
    at = np.minimum(np.searchsorted(mids, i), max(0, len(mids) - 1))
    some = mids[at] == i if len(mids) else np.zeros(len(i), bool)
    w, row, at = w[some], row[some], order[at[some]]
    times = count[at]
    # whole labels at a time, so that a sum is made in one go
    per_label = np.bincount(row, times, left.num_rows) + len(cands)
    piece = (np.cumsum(per_label) // CROWD).astype(np.int64)
    cuts = [0, *(np.nonzero(np.diff(piece))[0] + 1).tolist(), left.num_rows]
    names, sums = [], []
    for a, b in zip(cuts, cuts[1:], strict=False):
        x, y = np.searchsorted(row, [a, b])
        cells, seen = (b - a) * len(cands), np.zeros((b - a) * len(cands), bool)
        limbs = [np.zeros(cells, np.int64) for _ in range(8)]
        ends = np.cumsum(times[x:y])
        while x < y:
            # a label with more products than a sum of doubles can hold exactly is added up in parts
            part = max(1, int(np.searchsorted(ends, CROWD, side="right")))
            n = times[x : x + part]
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            cell = np.repeat(begin[at[x : x + part]], n) + inner
            key = np.repeat(row[x : x + part] - a, n) * len(cands) + c[cell]
            seen[key] = True
            amounts, factors = np.repeat(w[x : x + part], n), m[cell]
            for j in range(4):
                p = amounts >> SHORT * j & 0xFFFF if j < 3 else amounts >> SHORT * j
                for k in range(4) if p.any() else ():
                    q = factors >> SHORT * k & 0xFFFF if k < 3 else factors >> SHORT * k
                    if q.any():
                        limbs[j + k] += np.bincount(key, p.astype(np.float64) * q, cells).astype(np.int64)
            x, ends = x + part, ends[part:] - ends[part - 1]
        found = np.nonzero(seen)[0]
        names.append((found // max(1, len(cands)) + a, cands[found % max(1, len(cands))]))
        sums.append(decimals([limb[found] for limb in limbs]))
    rows = np.concatenate([r for r, _ in names]) if names else np.zeros(0, np.int64)
    which = np.concatenate([k for _, k in names]) if names else np.zeros(0, np.int64)
    label = left.select(["kind", "label"]).take(pa.array(rows, pa.int64()))
    amount = pa.chunked_array(sums, pa.decimal128(38, PLACES + FACTOR_PLACES))
    return pa.Table.from_arrays([label.column("kind"), label.column("label"), pa.array(which, pa.int64()), amount], ["kind", "label", "c", "amount"])


def money_by_label(shares: DataFrame, money: DataFrame) -> DataFrame:
    """cand_id, kind, label, amount: the sums of w times m; shares: cand_id, cmte_id, m; money: cmte_id, kind, label, w.

    A block of labels gets its amounts as lists and the factors of all committees, so no row is made for an amount and a candidate.
    """
    cands = checkpointed(shares.select("cand_id").distinct().withColumn("c", F.monotonically_increasing_id()))
    factor = (F.round("m", FACTOR_PLACES).cast(FACTOR) * 10**FACTOR_PLACES).cast("long")
    by = shares.join(cands, "cand_id").groupBy("cmte_id").agg(F.collect_list(F.struct("c", factor.alias("m"))).alias("l"))
    factors = checkpointed(by.select("cmte_id", F.col("l.c").alias("c"), F.col("l.m").alias("m")).withColumn("i", F.monotonically_increasing_id()))
    amount = (F.col("w").cast(PART) * 10**PLACES).cast("long")
    known = money.join(factors.select("cmte_id", "i"), "cmte_id").groupBy("kind", "label").agg(F.collect_list(F.struct("i", amount.alias("w"))).alias("l"))
    labels = checkpointed(known.select("kind", "label", F.col("l.i").alias("i"), F.col("l.w").alias("w")))
    blocks = (labels.agg(F.sum(F.size("i"))).first()[0] or 0) // AMOUNTS + 1
    left = labels.withColumn("b", F.pmod(F.xxhash64("kind", "label"), F.lit(blocks)).cast("int"))
    right = factors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("for"), "i", "c", "m")
    left = left.select("b", "kind", "label", "i", "w")
    made = left.groupBy("b").cogroup(right.groupBy("for")).applyInArrow(shared_money, "kind string, label string, c long, amount decimal(38,16)")
    return made.join(cands, "c").select("cand_id", "kind", "label", "amount")
