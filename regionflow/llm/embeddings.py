"""Near-duplicate embeddings: tiles of vectors, compared along their principal directions first.

Equal vectors of a label are one node. Nodes are ordered by label and by cells along the two leading directions, and cut
into tiles of bounded size; only tiles whose boxes along the leading directions come within reach of the threshold
meet. In a pair of tiles, products are added up over the leading directions first; what the others can add is bounded by
the norms of the suffixes, so most pairs end after a few directions. What is left is verified in double precision over
the vectors as given. A pair of tiles tells how many vectors each of its own is linked to and a spanning forest of its
links, never the links themselves; components are built by contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionflow.llm.common import cut, join_groups
from regionflow.llm.components import connected_components

THRESHOLD = 0.98
#: Directions after which a pair of vectors may end, and those whose ranges bound a tile.
STEPS, BOX = (8, 16, 32), 4
#: Numbers and vectors in a tile at most; rows of a tile that are compared at a time.
TILE_NUMBERS, TILE_ROWS, ROWS = 1 << 19, 2048, 512
#: What rounding may take from a bound, and the share of surviving pairs from which a block is verified as a whole.
SLACK, DENSE = 1e-9, 0.05
#: Length of vectors up to which directions are fitted; longer ones keep the order of their dimensions.
FITTED = 2048


def usable(v: Column) -> Column:
    """Whether a vector has a direction: some number that is not zero, none that is null or not finite."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of one width as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _units(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def directions(nodes: DataFrame) -> tuple[int, np.ndarray] | None:
    """The length that most nodes (v) have, and the directions of such unit vectors, of most spread first, as columns;
    null without nodes. Second moments are added up in the tasks and by cell; the driver gets one square of a length."""
    lengths = nodes.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return None
    d = lengths[0].d
    r = min(d, STEPS[-1])
    if d > FITTED:
        return d, np.eye(d, r)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for b in batches:
            if b.num_rows:
                u = _units(_matrix(b.column("v"), d))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "xs"])

    rows = nodes.where(F.size("v") == d).select("v").mapInArrow(moments, "i int, xs array<double>")
    square = np.zeros((d, d))
    for x in rows.select("i", F.posexplode("xs").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        square[x.i, x.j] = x.x
    return d, np.linalg.eigh((square + square.T) / 2)[1][:, ::-1][:, :r].copy()


def _along(units: np.ndarray, length: int, turned: np.ndarray) -> np.ndarray:
    """Coordinates along the leading directions; vectors of another length have those of their own first dimensions."""
    return units @ turned if units.shape[1] == length else units[:, : STEPS[-1]]


def _by_width(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in a batch and their vectors (v), a width at a time."""
    width = pc.list_value_length(b.column("v")).to_numpy(zero_copy_only=False)
    for d in np.unique(width):
        at = np.nonzero(width == d)[0]
        yield at, _matrix(b.column("v").take(pa.array(at)), int(d))


def tiles(nodes: DataFrame, length: int, turned: np.ndarray, radius: float) -> DataFrame:
    """tile, label, d, uids, ns, matrix (rows of doubles), lo and hi (its box along BOX directions) of nodes (uid, label, v,
    n), kept in the shared folder. A tile is a run of sorted rows of one label and length."""
    width = max(radius, 0.05)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lead = np.zeros((b.num_rows, 3))
            for at, rows in _by_width(b):
                own = _along(_units(rows), length, turned)[:, :3]
                lead[at[:, None], np.arange(own.shape[1])] = own
            cells = [pa.array(np.floor(lead[:, k] / width).astype(np.int32)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *cells, pa.array(lead[:, 2])], [*b.schema.names, "c0", "c1", "l2"])

    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    plain = ", ".join(f"{c} {k}" for c, k in kinds.items())
    order = ["label", "d", "c0", "c1", "l2", "uid"]
    spread = nodes.mapInArrow(placed, plain + ", c0 int, c1 int, l2 double").withColumn("d", F.size("v"))
    runs = spread.repartitionByRange(*order).sortWithinPartitions(*order).select("uid", "label", "v", "n", F.spark_partition_id().alias("part"))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, np.ndarray]] = []
        label = d = part = None
        made = 0

        def tile() -> pa.RecordBatch:
            rows = np.array([x[2] for x in held], np.float64).reshape(len(held), d)
            box = _along(_units(rows), length, turned)[:, :BOX]
            box = np.pad(box, ((0, 0), (0, BOX - box.shape[1])))
            values = [(part << 32) + made, label, d, [x[0] for x in held], [x[1] for x in held], rows.tobytes(), list(box.min(axis=0)), list(box.max(axis=0))]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, [pa.int64(), kind, pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())])], names)

        names = ["tile", "label", "d", "uids", "ns", "matrix", "lo", "hi"]
        kind = None
        for b in batches:
            kind = b.schema.field("label").type
            columns = [b.column(c).to_pylist() for c in ("uid", "label", "n", "part")]
            for uid, own, n, p, v in zip(*columns, b.column("v")):
                v = np.asarray(v.values, np.float64)
                if held and (own != label or len(v) != d or len(held) >= min(TILE_ROWS, max(64, TILE_NUMBERS // d))):
                    yield tile()
                    held, made = [], made + 1
                label, d, part = own, len(v), p
                held.append((uid, n, v))
        if held:
            yield tile()

    return cut(runs.mapInArrow(cut_up, f"tile long, label {kinds['label']}, d int, uids array<long>, ns array<long>, matrix binary, lo array<double>, hi array<double>"))


def tile_pairs(boxes: DataFrame, radius: float) -> DataFrame:
    """a and b (a <= b) of boxes (tile, label, d, lo, hi) of one label and length that come as near as radius. They meet by
    cells of the first two directions, each pair in the first cell that both have."""
    width, reach = max(radius, 0.05), radius + SLACK

    def cells(df: DataFrame, more: float) -> DataFrame:
        for k in (0, 1):
            first = F.floor((F.element_at("lo", k + 1) - more) / width)
            df = df.withColumn(f"f{k}", first).withColumn(f"c{k}", F.explode(F.sequence(first, F.floor((F.element_at("hi", k + 1) + more) / width))))
        return df

    one = cells(boxes, 0.0).select("label", "d", "c0", "c1", F.col("tile").alias("a"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"), F.col("f0").alias("a0"), F.col("f1").alias("a1"))
    two = cells(boxes, reach).select("label", "d", "c0", "c1", F.col("tile").alias("b"), "lo", "hi", "f0", "f1")
    gaps = F.zip_with(F.zip_with("lo", "a_hi", lambda x, y: x - y), F.zip_with("a_lo", "hi", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)
    met = one.join(two, ["label", "d", "c0", "c1"]).where((F.col("a") <= F.col("b")) & (F.col("c0") == F.greatest("a0", "f0")) & (F.col("c1") == F.greatest("a1", "f1")))
    return met.where(apart <= reach * reach).select("a", "b")


def linked(x: np.ndarray, y: np.ndarray, along_x: np.ndarray, along_y: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For ROWS rows of x at a time, their offset and which rows of y they are linked to (boolean). x and y are unit
    vectors, along_* their leading coordinates."""
    steps = [k for k in STEPS if k <= along_x.shape[1]] or [along_x.shape[1]]
    rest_x, rest_y = (np.sqrt(np.maximum(0.0, 1 - np.cumsum(a * a, axis=1)))[:, [k - 1 for k in steps]] for a in (along_x, along_y))
    for at in range(0, len(x), ROWS):
        own, rest = along_x[at : at + ROWS], rest_x[at : at + ROWS]
        part = np.zeros((len(own), len(y)))
        done, out = 0, np.zeros((len(own), len(y)), bool)
        i = j = None
        for k, step in enumerate(steps):
            if i is None:
                part += own[:, done:step] @ along_y[:, done:step].T
                alive = part + rest[:, k, None] * rest_y[None, :, k] >= threshold - SLACK
                if (some := np.count_nonzero(alive)) <= DENSE * alive.size:
                    i, j = np.nonzero(alive)
                    part = part[i, j]
            else:
                part = part + np.einsum("ij,ij->i", own[i, done:step], along_y[j, done:step])
                live = part + rest[i, k] * rest_y[j, k] >= threshold - SLACK
                i, j, part = i[live], j[live], part[live]
                some = len(i)
            done = step
            if not some:
                break
        if i is None:
            out = (x[at : at + ROWS] @ y.T) >= threshold
        else:
            for s in range(0, len(i), 1 << 15):
                a, b = i[s : s + (1 << 15)], j[s : s + (1 << 15)]
                ok = np.einsum("ij,ij->i", x[at + a], y[b]) >= threshold
                out[a[ok], b[ok]] = True
        yield at, out


def _compared(length: int, turned: np.ndarray, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """uid and links of each node with any, then uid and to of the edges of a forest, for each pair of tiles."""
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                d = row["d"].as_py()
                side = lambda p: (*(row[p + c].values.to_numpy() for c in ("_uids", "_ns")), _units(np.frombuffer(row[p + "_matrix"].as_buffer(), np.float64).reshape(-1, d)))  # noqa: B023, E731
                (u, n, x), (w, m, y) = side("a"), side("b")
                same = row["a"].as_py() == row["b"].as_py()
                of_x, of_y = np.zeros(len(u), np.int64), np.zeros(len(w), np.int64)
                root, frm, to = np.arange(len(u) + (0 if same else len(w))), [], []
                shift = 0 if same else len(u)
                for at, hits in linked(x, y, _along(x, length, turned), _along(y, length, turned), threshold):
                    if same:
                        hits[np.arange(len(hits)), at + np.arange(len(hits))] = False
                    of_x[at : at + len(hits)] += hits @ m
                    if not same:
                        of_y += n[at : at + len(hits)] @ hits
                    for i in np.nonzero(hits.any(axis=1))[0]:
                        js = np.nonzero(hits[i])[0]
                        roots, first = np.unique(root[shift + js], return_index=True)
                        new = roots != root[at + i]
                        if new.any():
                            frm += [u[at + i]] * int(new.sum())
                            to += list(w[js[first[new]]])
                            root[np.isin(root, roots[new])] = root[at + i]
                uids = np.concatenate([u[of_x > 0], w[of_y > 0], np.array(frm, np.int64)])
                links = np.concatenate([of_x[of_x > 0], of_y[of_y > 0], np.zeros(len(frm), np.int64)])
                ends = pa.array([None] * (len(uids) - len(to)) + [int(t) for t in to], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(links, pa.int64()), ends], ["uid", "links", "to"])

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of vectors: id, n_links (other rows of its label with a cosine of threshold or more), component_id (the
    smallest id that links lead to, its own included), kept (whether that is its own).

    Rows with a null label, or a vector that is null, empty, zero or holds null or non-finite numbers, are linked with
    nothing, and so are vectors of different lengths. Each of repeated rows counts as a vector of its own. A null id
    is never the smallest; where a component has no other, component_id is null and kept false. An empty table gives no
    rows; further columns are not looked at."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    ok = F.col("label").isNotNull() & usable(F.col("v"))
    good, bad = rows.where(ok), rows.where(~ok)
    nodes = cut(good.groupBy("label", "v").agg(F.min("id").alias("low"), F.count("*").alias("n")).withColumn("uid", F.monotonically_increasing_id()))
    fitted = directions(nodes)
    if fitted is None:
        return bad.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    cells = tiles(nodes.select("uid", "label", "v", "n"), *fitted, radius)
    pairs = tile_pairs(cells.select("tile", "label", "d", "lo", "hi"), radius)
    side = lambda p: cells.select(F.col("tile").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in ("uids", "ns", "matrix")])
    spark = vectors.sparkSession
    # A comparison costs far more than its bytes tell: a given number of partitions is not merged.
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    right = pairs.join(side("b"), "b").repartition(spread, "a")
    both = right.join(cells.select("d", F.col("tile").alias("a"), *[F.col(c).alias(f"a_{c}") for c in ("uids", "ns", "matrix")]).repartition(spread, "a"), "a")
    found = cut(both.mapInArrow(_compared(*fitted, threshold), "uid long, links long, to long"))
    roots = connected_components(found.where("to is not null").select(F.col("uid").alias("a"), F.col("to").alias("b")))
    known = nodes.select("uid", "low").join(roots.withColumnRenamed("node", "uid"), "uid")
    least = known.join(known.groupBy("root").agg(F.min("low").alias("component")), "root").select("uid", "component")
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    done = cut(
        nodes.join(links, "uid", "left").join(least, "uid", "left")
        .select("label", "v", F.col("n").alias("size"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "low").alias("component_id"))
    )
    total = nodes.agg(F.sum("n")).first()[0]
    out = join_groups(good, done, ["label", "v"], "size", total).select("id", "n_links", "component_id")
    out = out.unionByName(bad.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, label, e FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN low ON low.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
