"""SimHash near-duplicates, joined by the generalised pigeonhole principle.

Fingerprints are 64-bit SimHashes of word shingles. To find all pairs within ``most`` bits,
the 64 bits are grouped into ``parts`` of correlated bits. If each part i gets a threshold
t_i with sum(t_i) = most - parts + 1, any such pair differs by at most t_i bits in some
part i (t_i = -1 skips a part). Every fingerprint chooses its own thresholds: a dynamic
program over the parts minimises the probes plus the candidates that a table of counts of
part values predicts. It probes all values within its thresholds against the index of exact
part values, and candidates are verified on all 64 bits.

Equal fingerprints are one entry from the start. Inside a bucket of candidates the links
are reduced to stars (each member to the least of its component), so a group of n near
copies yields about n edges, not n^2. Buckets above ``CELL`` entries are dealt out as a grid
of cells, each of bounded size, so that every pair still meets once. The table of counts and
the 64 x 64 bit correlations are of fixed size; edges and components stay distributed.

Defined cases: a null, empty or blank text has fingerprint zero and links like any other;
fewer words than a shingle hash as one sequence; null doc_ids never name a component but are
linked; repeated rows fall together; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.llm import textops as X
from eventweave.llm.components import components
from eventweave.llm.frames import by_blocks, longs, need, no_text_as_empty, stored

#: Entries of one bucket that are compared in one cell.
CELL = 1 << 14
#: Slots of the count table of each part.
SLOTS = 1 << 20
_U1 = np.uint64(1)


def shingle_hashes(block: pa.RecordBatch, words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle, index of each row's first one)."""
    import xxhash
    data, offsets = X.column_bytes(block.column("text"))
    data = np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint8)
    w = X.split_words(data, offsets)
    size = w.end - w.start
    place = np.concatenate([[0], np.cumsum(size + 1)])         # words again, one space after each
    joined = np.full(int(place[-1]), 0x20, np.uint8)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    joined[np.repeat(place[:-1], size) + at] = data[np.repeat(w.start, size) + at]
    count = np.diff(w.first)
    n = np.maximum(np.minimum(count, 1), count - words + 1)
    first = np.concatenate([[0], np.cumsum(n)])
    begin = np.arange(first[-1]) - np.repeat(first[:-1] - w.first[:-1], n)
    last = begin + np.repeat(np.minimum(count, words), n)
    view, digest = memoryview(joined.tobytes()), xxhash.xxh64_intdigest
    h = [digest(view[a:b], seed) for a, b in zip(place[begin].tolist(), (place[last] - 1).tolist())]
    return np.array(h, dtype=np.uint64), first


def fingerprint_rows(block: pa.RecordBatch, words: int, seed: int) -> np.ndarray:
    h, first = shingle_hashes(block, words, seed)
    out = np.zeros(len(first) - 1, np.uint64)
    some = np.flatnonzero(np.diff(first))
    totals = np.zeros((len(first) - 1, 64), np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for lo in range(0, len(h), 1 << 15):        # a bounded number of shingles at a time
        bits = np.unpackbits(h[lo:lo + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        r = row[lo:lo + (1 << 15)]
        cut = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        totals[r[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    if len(some):
        out[some] = np.packbits(2 * totals[some] > np.diff(first)[some][:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, *, words: int = 3, seed: int = 42, rid: Column | None = None) -> DataFrame:
    """(rid, doc_id, fp): the fingerprint of every row as a long with the same bits; ``rid`` is
    the row's place in the input, if not given."""
    need(docs, "doc_id", "text")
    place = F.monotonically_increasing_id() if rid is None else rid
    rows = docs.select(place.alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), no_text_as_empty())
    return by_blocks(rows, "text", lambda b: {"rid": b.column("rid"), "doc_id": b.column("doc_id"), "fp": longs(fingerprint_rows(b, words, seed))},
                     "rid long, doc_id long, fp long", 1 << 19)


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` over whole Arrow batches: dict of columns in, dict of columns (or None) out."""
    def run(batches):
        X.drop_worker_tables()
        for b in batches:
            got = fn(b)
            if got is not None:
                yield pa.RecordBatch.from_pydict(got)
    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)


def correlated_parts(distinct: DataFrame, parts: int) -> list[list[int]]:
    """Bits grouped so that correlated ones stand together, from the co-occurrences of all fingerprints."""
    def sums(b):
        x = _bits(column(b, "fp"))
        xy = (x.T @ x).astype(np.int64)
        i, j = np.triu_indices(64)
        return {"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "n": pa.array(xy[i, j]), "rows": pa.array(np.full(len(i), len(x)))}
    got = (arrow_map(distinct, sums, "i int, j int, n long, rows long").groupBy("i", "j")
           .agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")).collect())          # 2080 rows
    both, rows = np.zeros((64, 64)), 1.0
    for r in got:
        both[r["i"], r["j"]] = both[r["j"], r["i"]] = r["n"]
        rows = float(r["rows"])
    p = np.diag(both) / rows
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    like = np.abs((both / rows - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(like, 0)
    left, out = set(range(64)), []
    for k in range(parts):
        room = 64 // parts + (k < 64 % parts)
        free = sorted(left)
        best = max(((like[a, b], -a, -b) for a in free for b in free if a < b), default=(0, -free[0], -free[0]))
        group = [-best[1]]
        left.discard(group[0])
        while len(group) < room:
            nxt = max(sorted(left), key=lambda b: like[group, b].mean())
            group.append(nxt)
            left.discard(nxt)
        out.append(sorted(group))
    return out


def part_value(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & _U1) << np.uint64(k)
    return out


def _slot(value: np.ndarray) -> np.ndarray:
    return (X.mix(value + np.uint64(0x51ED270B)) >> np.uint64(44)).astype(np.int64)       # 20 bits


def value_counts(distinct: DataFrame, groups: list[list[int]]) -> np.ndarray:
    """counts[part][slot]: fingerprints whose part value falls into the slot."""
    def count(b):
        fp = column(b, "fp")
        s = np.concatenate([_slot(part_value(fp, g)) + i * SLOTS for i, g in enumerate(groups)])
        u, n = np.unique(s, return_counts=True)
        return {"slot": pa.array(u), "n": pa.array(n.astype(np.int64))}
    got = arrow_map(distinct, count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()   # parts * SLOTS rows at most
    out = np.zeros(len(groups) * SLOTS, np.int64)
    out[got["slot"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return np.minimum(out, 2**31 - 1).astype(np.int32).reshape(len(groups), SLOTS)


def masks(width: int, most: int) -> list[np.ndarray]:
    """Difference patterns of exactly 0, 1, ... ``most`` bits."""
    out = [np.zeros(1, np.uint64)]
    for _ in range(most):
        bigger = (out[-1][:, None] | (_U1 << np.arange(width, dtype=np.uint64))).ravel()
        out.append(np.setdiff1d(bigger, np.concatenate(out)))
    return out


def allocate(costs: np.ndarray, budget: int) -> np.ndarray:
    """Thresholds (n, parts), each -1 or more, that sum to ``budget`` with the least total cost.

    ``costs[r, i, t + 1]``: cost of threshold t in part i for fingerprint r. One pass over the
    parts keeps, for every sum reached so far, the cheapest way to reach it."""
    n, parts, options = costs.shape
    least = -parts
    sums = budget - least + 1
    best = np.full((n, sums), np.inf)
    best[:, 0] = 0.0
    choice = np.zeros((parts, n, sums), np.int8)
    # sums are counted from the least possible one, so an option t adds t + 1
    for i in range(parts):
        nxt = np.full((n, sums), np.inf)
        for t in range(options):
            if t >= sums:
                break
            way = best[:, :sums - t] + costs[:, i, t, None]
            better = way < nxt[:, t:]
            nxt[:, t:] = np.where(better, way, nxt[:, t:])
            choice[i][:, t:] = np.where(better, t, choice[i][:, t:])
        best = nxt
    out = np.zeros((n, parts), np.int64)
    at = np.full(n, sums - 1)
    for i in reversed(range(parts)):
        t = choice[i][np.arange(n), at]
        out[:, i] = t - 1
        at = at - t
    return out


def _key(part: int, value: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return X.mix(X.mix(value + np.uint64(part * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) ^ (a.astype(np.uint64) << np.uint64(32)) ^ b.astype(np.uint64))


def _cells(part: int, value: np.ndarray, fp: np.ndarray, counts: np.ndarray, index: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the cells that each entry goes to, and the entry of each key."""
    n = np.maximum(1, -(-counts[_slot(value)].astype(np.int64) // CELL))
    own = (X.mix(fp + np.uint64(77 + index)) % n.astype(np.uint64)).astype(np.int64)
    at = np.repeat(np.arange(len(fp)), n)
    other = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    a, b = (own[at], other) if index else (other, own[at])
    return _key(part, value[at], a, b), at


def entries(fp: np.ndarray, groups: list[list[int]], counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, fingerprint, side) of the index (0) and probe (1) entries of some fingerprints."""
    parts, budget = len(groups), most - len(groups) + 1
    top = max(0, min(budget + parts - 1, max(2, -(-budget // parts))))       # further out only if the sum needs it
    values = [part_value(fp, g) for g in groups]
    patterns = [masks(len(g), top) for g in groups]
    costs = np.zeros((len(fp), parts, top + 2))
    for i, v in enumerate(values):
        total = np.zeros(len(fp))
        mean = float(counts[i].sum()) / max(1, 2.0 ** len(groups[i]))
        for t in range(top + 1):
            if t <= 1:          # looked up; further out the mean density stands in
                for m in patterns[i][t]:
                    total = total + 0.2 + counts[i][_slot(v ^ m)]
            else:
                total = total + len(patterns[i][t]) * (0.5 + mean)
            costs[:, i, t + 1] = total
    t = allocate(costs, budget)
    keys, own, side = [], [], []
    for i, v in enumerate(values):
        k, at = _cells(i, v, fp, counts[i], True)
        keys.append(k)
        own.append(fp[at])
        side.append(np.zeros(len(k), np.int8))
        for level in range(top + 1):
            who = np.flatnonzero(t[:, i] >= level)
            for m in patterns[i][level]:
                near = v[who] ^ m
                some = counts[i][_slot(near)] > 0        # else no fingerprint has this value
                k, at = _cells(i, near[some], fp[who[some]], counts[i], False)
                keys.append(k)
                own.append(fp[who[some]][at])
                side.append(np.ones(len(k), np.int8))
    return np.concatenate(keys), np.concatenate(own), np.concatenate(side)


def _least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component label (least member) of nodes 0..n-1 under edges a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    return label


def star_edges(key: np.ndarray, fp: np.ndarray, side: np.ndarray, most: int, step: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (fp, least fp of its component in the bucket) among entries sorted by (key, side)."""
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([cut, [len(key)]]))
    probes = np.add.reduceat(side, cut, dtype=np.int64) if len(cut) else size
    index = size - probes
    node = np.empty(len(key), np.int64)         # equal fingerprints of a bucket are one node
    o = np.lexsort((fp, np.repeat(np.arange(len(cut)), size)))
    group = np.repeat(np.arange(len(cut)), size)
    new = np.concatenate([[True], (fp[o][1:] != fp[o][:-1]) | (group[o][1:] != group[o][:-1])]) if len(o) else np.zeros(0, bool)
    node[o] = np.cumsum(new) - 1
    node_fp = fp[o][new]
    pairs = index * probes
    label = np.arange(len(node_fp))
    first = 0
    while first < len(cut):
        stop = max(first + 1, int(np.searchsorted(np.cumsum(pairs[first:]), step, side="right")) + first)
        rows = np.arange(first, stop)
        rows = rows[pairs[rows] > 0]
        if len(rows):
            # every (index, probe) pair of these buckets; a single large one goes in strips
            strips = -(-int(pairs[rows].max()) // step) if len(rows) == 1 else 1
            for s in range(strips):
                p_lo = (probes[rows] * s) // strips
                p_n = (probes[rows] * (s + 1)) // strips - p_lo
                n = index[rows] * p_n
                g = np.repeat(np.arange(len(rows)), n)
                k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                i = cut[rows][g] + k // np.maximum(p_n[g], 1)
                j = cut[rows][g] + index[rows][g] + p_lo[g] + k % np.maximum(p_n[g], 1)
                hit = (np.bitwise_count(fp[i] ^ fp[j]) <= most) & (fp[i] != fp[j])
                a, b = label[node[i[hit]]], label[node[j[hit]]]
                if len(a):
                    label = _least_labels(len(label), a, b)[label]
        first = stop
    linked = np.flatnonzero(label != np.arange(len(label)))
    return node_fp[linked], node_fp[label[linked]]


def links(distinct: DataFrame, *, most: int, parts: int) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within ``most`` bits of each other."""
    groups = correlated_parts(distinct, parts)
    counts = distinct.sparkSession.sparkContext.broadcast(value_counts(distinct, groups))     # parts * SLOTS * 4 bytes

    def deal(b):
        k, f, s = entries(column(b, "fp"), groups, counts.value, most)
        return {"key": pa.array(longs(k)), "fp": pa.array(longs(f)), "side": pa.array(s)}

    dealt = arrow_map(distinct, deal, "key long, fp long, side byte").repartition("key").sortWithinPartitions("key", "side")

    def meet(batches):
        kept = None             # rows of the bucket that may go on in the next batch
        def out(k, f, s):
            a, b = star_edges(k, f, s, most)
            return pa.RecordBatch.from_pydict({"a": pa.array(longs(a)), "b": pa.array(longs(b))})
        for batch in batches:
            k, f = column(batch, "key"), column(batch, "fp")
            s = batch.column("side").to_numpy(zero_copy_only=False).astype(np.int8)
            if kept is not None:
                k, f, s = (np.concatenate(x) for x in zip(kept, (k, f, s)))
            if not len(k):
                continue
            n = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
            kept = (k[n:], f[n:], s[n:])
            if n:
                yield out(k[:n], f[:n], s[:n])
        if kept is not None:
            yield out(*kept)

    return dealt.mapInArrow(meet, "a long, b long")


def grouped(docs: DataFrame, *, words: int, seed: int, most: int, parts: int | None, rid: Column | None = None) -> DataFrame:
    """(rid, doc_id, fp, best) of every row: ``best`` is the (no_id, doc_id, rid) of the first
    row of its component, by doc_id."""
    rows = stored(fingerprints(docs, words=words, seed=seed, rid=rid), "fingerprints")
    mine = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    names = stored(rows.groupBy("fp").agg(F.min(mine).alias("least")), "distinct-fingerprints")
    distinct = names.select("fp")
    if parts is None:           # wider parts as the number of fingerprints grows: fewer candidates, more probes
        parts = max(1, min(most + 1, 3 if distinct.count() < 1 << 25 else 2))
    roots = components(links(distinct, most=most, parts=parts))
    named = names.join(roots, names["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    whole = named.groupBy("root").agg(F.min("least").alias("best"))
    return rows.join(named.join(whole, "root").select("fp", "best"), "fp")


def near_duplicates(docs: DataFrame, *, words: int = 3, seed: int = 42, most: int = 3, parts: int | None = None) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: the component under links of at most
    ``most`` differing bits, named by its smallest doc_id."""
    return (grouped(docs, words=words, seed=seed, most=most, parts=parts)
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("best.doc_id").alias("component_id")))


def keep_one(docs: DataFrame, *, words: int = 3, seed: int = 42, most: int = 3, parts: int | None = None) -> DataFrame:
    """One row of every component: the one with the smallest doc_id, the first of equal ones.
    Rows are numbered once and written with their number, which both jobs read."""
    rows = stored(docs.withColumn("_rid", F.monotonically_increasing_id()), "rows", compression="zstd")
    gone = stored(grouped(rows, words=words, seed=seed, most=most, parts=parts, rid=F.col("_rid")).filter("rid <> best.rid").select(F.col("rid").alias("_gone")), "near-copies")
    return rows.join(gone, rows["_rid"] == gone["_gone"], "left_anti").drop("_rid")
