"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints are made in Arrow batches. Rows with equal fingerprints collapse first, so copies cost nothing further.
The 64 bits are grouped into parts, correlated bits together, using counts over all fingerprints. If the parts'
thresholds t_i sum to tau - m + 1, two fingerprints within tau bits agree in some part up to t_i bits; a part with
t_i = -1 is not looked at. Dynamic programming allocates the thresholds so that the estimated cost of index rows
and candidate pairs is least, and the number of parts is chosen by the same estimate, so the index gets more
selective as the data grow. Every fingerprint is filed under its value in each part and probes the values up to
t_i flips away. Buckets are verified by exact distance; a bucket above BLOCK rows is cut into blocks and each pair
of blocks is a task of its own. A bucket reports only a spanning forest of its links, so large groups of near copies
never become all their pairs, and no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionflow.llm.common import cut, join_groups, keep_rows
from regionflow.llm.components import connected_components

BITS = 64
TAU = 4
SHINGLE = 4
SEED = 42
#: Rows of a bucket's block; two blocks meet in a task.
BLOCK = 1024
#: Estimated cost of an index row and of comparing a pair, in microseconds.
ROW_COST, PAIR_COST = 1.5, 0.006
MAX_PARTS = 7
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Words are runs of anything but space and \\t-\\r, with A-Z lower-cased; shingles of so many words, repeats
    included, are hashed by XXH64; a bit is 1 if set in over half of the hashes. Fewer words are one shingle; null,
    empty and blank texts have none and give 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1]
    ends, n, digest = ends[shingle - 1 :], len(words) - shingle + 1, xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, _CHUNK):
        pairs = zip(starts[k : k + _CHUNK].tolist(), ends[k : k + _CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], np.dtype("<u8"))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: k_id, k_text, uid, fp (signed 64 bits). See fingerprint() for null and short texts."""
    rows = docs.select(
        F.col(id_col).alias("k_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("k_text"),
        F.monotonically_increasing_id().alias("uid"),
        F.col(text_col).cast("string").alias("text"),
    )
    schema = T.StructType([f for f in rows.schema.fields if f.name != "text"] + [T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py()) for t in b.column("text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("k_id"), b.column("k_text"), b.column("uid"), pa.array(fps.view(np.int64))],
                ["k_id", "k_text", "uid", "fp"],
            )

    return rows.mapInArrow(run, schema)


def bit_counts(nodes: DataFrame) -> np.ndarray:
    """64 x 64: in how many fingerprints of nodes (fp) both bits are set. Counts over all rows, 2,080 sums at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        for b in batches:
            fps = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            for k in range(0, len(fps), _CHUNK):
                x = np.unpackbits(fps[k : k + _CHUNK], axis=1, bitorder="little").astype(np.float32)
                total += (x.T @ x).astype(np.int64)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "n"])

    out = np.zeros((BITS, BITS), np.int64)
    for r in nodes.select("fp").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.n
    return out


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Parts of equal size; each starts from the free bit that correlates most and takes the bits that go with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    link = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(link, 0)
    free, out = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        mine = [max(sorted(free), key=lambda b: link[b, sorted(free)].sum())]
        free -= {mine[0]}
        while len(mine) < size:
            mine.append(max(sorted(free), key=lambda b: link[b, mine].sum()))
            free -= {mine[-1]}
        out.append(sorted(mine))
    return out


def part_cost(bits: list[int], share: np.ndarray, n: int, most: int) -> list[float]:
    """Estimated cost of a part for thresholds -1, 0, ..., most: rows, and pairs if bits differ independently."""
    near = np.zeros(len(bits) + 1)
    near[0] = 1
    for b in bits:
        q = 2 * share[b] * (1 - share[b])
        near[1:] = near[1:] * (1 - q) + near[:-1] * q
        near[0] *= 1 - q
    out = [0.0]
    for t in range(most + 1):
        rows = n * (1 + sum(comb(len(bits), k) for k in range(1, t + 1)) / 2)
        out.append(rows * ROW_COST + n * n / 2 * near[: t + 1].sum() * PAIR_COST)
    return out


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """The thresholds with the given sum whose costs, costs[i][t + 1], add up to the least."""
    best = {0: (0.0, [])}
    for c in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (cost, ts) in best.items():
            for t in range(-1, len(c) - 1):
                if s + t not in step or cost + c[t + 1] < step[s + t][0]:
                    step[s + t] = (cost + c[t + 1], [*ts, t])
        best = step
    return best[total]


def plan(both: np.ndarray, n: int, tau: int = TAU) -> list[tuple[list[int], int]]:
    """The parts and their thresholds: the number of parts and the allocation of least estimated cost."""
    share = np.diag(both) / max(n, 1)
    found = []
    for m in range(1, MAX_PARTS + 1):
        parts = group_bits(both, n, m)
        if tau - m + 1 < -m:
            break
        cost, ts = allocate([part_cost(b, share, n, tau) for b in parts], tau - m + 1)
        found.append((cost, list(zip(parts, ts))))
    return min(found, key=lambda x: x[0])[1]


def index_rows(nodes: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """part, key, probe, fp: each fingerprint under its own key of each part, and as a probe under the keys up to the
    threshold away that are larger than its own (of two fingerprints exactly one probes the other)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(part: int, key: np.ndarray, probe: bool, fp: np.ndarray) -> pa.RecordBatch:
            n = len(fp)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(key.view(np.int64)), pa.array(np.full(n, probe)), pa.array(fp.view(np.int64))],
                ["part", "key", "probe", "fp"],
            )

        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for part, (bits, t) in enumerate(parts):
                if t < 0:
                    continue
                key = np.zeros(len(fp), np.uint64)
                for k, bit in enumerate(bits):
                    key |= ((fp >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
                yield batch(part, key, False, fp)
                for flips in range(1, t + 1):
                    for at in combinations(range(len(bits)), flips):
                        other = key ^ np.uint64(sum(1 << k for k in at))
                        yield batch(part, other[other > key], True, fp[other > key])

    return nodes.select("fp").mapInArrow(run, "part int, key long, probe boolean, fp long")


def _small(end: np.ndarray, linked) -> np.ndarray:
    """Component labels of rows whose groups end at end, by comparing each row with the ones after it."""
    lab, at, d = np.arange(len(end)), np.arange(len(end)), 1
    i_all, j_all = [], []
    while len(at := at[at + d < end[at]]):
        ok = linked(at, at + d)
        i_all.append(at[ok])
        j_all.append(at[ok] + d)
        d += 1
    if not i_all:
        return lab
    i, j = np.concatenate(i_all), np.concatenate(j_all)
    while True:
        least = np.minimum(lab[i], lab[j])
        new = lab.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def _large(n: int, linked) -> np.ndarray:
    """The same for one large group: breadth-first over rows of the distance matrix."""
    every, lab = np.arange(n), np.full(n, -1)
    for root in range(n):
        if lab[root] >= 0:
            continue
        lab[root], todo = root, [root]
        while todo:
            rest = every[lab < 0]
            if not len(rest):
                break
            new = rest[linked(np.full(len(rest), todo.pop()), rest)]
            lab[new] = root
            todo.extend(new.tolist())
    return lab


def verify(rows: DataFrame, tau: int = TAU, block: int = BLOCK) -> DataFrame:
    """index_rows -> a, b: within each bucket a spanning forest of the links (distance tau or less)."""
    rows = cut(rows)
    hot = cut(rows.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > block))
    if hot.isEmpty():
        cells = rows.select("part", "key", F.lit(0).alias("c1"), F.lit(0).alias("c2"), F.lit(0).alias("blk"), "probe", "fp")
    else:
        blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("int")
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        cells = (
            rows.join(hot, ["part", "key"], "left")
            .select("part", "key", "probe", "fp", blocks.alias("blocks"))
            .select("part", "key", "probe", "fp", own.alias("blk"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("c"))
            .select("part", "key", F.least("blk", "c").alias("c1"), F.greatest("blk", "c").alias("c2"), "blk", "probe", "fp")
        )

    def chunk(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        col = {c: t.column(c).to_numpy() for c in ("c1", "c2", "blk", "probe")}
        fp = t.column("fp").to_numpy().view(np.uint64)
        inner = col["c1"] == col["c2"]

        def linked(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            near = np.bitwise_count(fp[i] ^ fp[j]) <= tau
            return near & ~(col["probe"][i] & col["probe"][j]) & (inner[i] | (col["blk"][i] != col["blk"][j]))

        ends = np.append(starts[1:], len(fp))
        sizes = ends - starts
        end = np.repeat(np.where(sizes <= 128, ends, 0), sizes)
        lab = _small(end, linked)
        for s, n in zip(starts[sizes > 128], sizes[sizes > 128]):
            lab[s : s + n] = s + _large(n, lambda i, j, s=s: linked(i + s, j + s))
        at = np.flatnonzero((lab != np.arange(len(lab))) & (fp[lab] != fp))
        pairs = np.unique(np.stack([np.minimum(fp[lab[at]], fp[at]), np.maximum(fp[lab[at]], fp[at])], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k]).view(np.int64)) for k in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def starts(t: pa.Table) -> np.ndarray:
            new = np.ones(t.num_rows, bool)
            new[1:] = False
            for c in ("part", "key", "c1", "c2"):
                v = t.column(c).to_numpy()
                new[1:] |= v[1:] != v[:-1]
            return np.flatnonzero(new)

        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= 200_000:
                t = pa.Table.from_batches(held)
                at = starts(t)
                if len(at) > 1:
                    yield chunk(t.slice(0, int(at[-1])), at[:-1])
                held = t.slice(int(at[-1])).combine_chunks().to_batches()
                n = sum(x.num_rows for x in held)
        if n:
            t = pa.Table.from_batches(held)
            yield chunk(t, starts(t))

    keys = ["part", "key", "c1", "c2"]
    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU) -> DataFrame:
    """One row per row of docs: k_id, k_text, fp, component_id, kept.

    Fingerprints link at tau or fewer differing bits; component_id is the smallest id that is reachable over links,
    the row's own included (null only where all ids of a component are null). kept marks one row of each component:
    that of component_id, or one of its repeats. All texts without words have fingerprint 0. An empty table gives no
    rows; other columns are not looked at.
    """
    leaves = cut(fingerprints(docs, id_col, text_col))
    rank = F.struct(F.col("k_id").isNull().alias("order_null"), F.col("k_id").alias("id"), F.col("uid").alias("uid"))
    nodes = cut(leaves.groupBy("fp").agg(F.min(rank).alias("best"), F.count("*").alias("n")))
    n_nodes, total = nodes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    parts = plan(bit_counts(nodes), n_nodes, tau)
    roots = connected_components(verify(index_rows(nodes, parts), tau))
    linked = cut(roots.select(F.col("node").alias("fp"), "root").join(nodes.select("fp", "best"), "fp"))
    best = cut(linked.groupBy("root").agg(F.min("best").alias("winner"), F.count("*").alias("size")))
    named = join_groups(linked, best, ["root"], "size", n_nodes).select("fp", "winner")
    every = cut(nodes.join(named, "fp", "left").select("fp", "n", F.coalesce("winner", "best").alias("winner")))
    return join_groups(leaves, every, ["fp"], "n", total).select(
        "k_id", "k_text", "fp", F.col("winner.id").alias("component_id"), (F.col("uid") == F.col("winner.uid")).alias("kept")
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU) -> DataFrame:
    """docs with one row of each component; columns unchanged."""
    return keep_rows(docs, near_groups(docs, id_col, text_col, tau).select("k_id", "k_text", "kept"), id_col, text_col)
