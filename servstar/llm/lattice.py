"""Embedding near-duplicates by E8 lattice hashing.

Each of several tables projects the unit vectors to 8 random orthonormal directions, scales
them and decodes them to the nearest point of the E8 lattice: the vector's home cell. A vector
also visits the neighbouring cells nearest to it. Vectors that meet in a cell are compared by
cosine in double precision.

A pair may meet in several cells; it counts in the first table where it can meet, which both
vectors tell by themselves, so a task adds up numbers of links and never sends pairs. What
leaves a cell are partial counts and links that span its components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar.llm.common import components, least_of, mixed, written

THRESHOLD = 0.95
TABLES, PROBES = 8, 4
#: Mean distance of two vectors at the threshold in the plane of a table, in units of the lattice: there a pair meets
#: in a table with probability 0.56, in one of 8 with 0.998 or more.
SPREAD = 0.67
#: Rows of a cell beyond which its visitors are dealt to several tasks, and beyond which its homes are, too.
CELL_ROWS, HOME_ROWS = 4096, 16384
#: Bytes of vectors (in double precision) that a task holds of a cell at most, whatever their dimensions.
CELL_BYTES = 1 << 26
BLOCK = 1024
#: Pairs looked at together.
PAIRS = 1 << 16


def _short_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest point with integer coordinates of even sum."""
    f = np.rint(x)
    odd = np.flatnonzero(f.sum(axis=1).astype(np.int64) & 1)
    e = x[odd] - f[odd]
    at = np.abs(e).argmax(axis=1)
    f[odd, at] += np.where(e[np.arange(len(odd)), at] >= 0, 1, -1)
    return f


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 is the points of D8 and those shifted by one half; the nearer of the two nearest."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


class Lattice:
    """Cells (64-bit hashes of dimensions, table and lattice point) of unit vectors.

    A random plane of 8 of n dimensions holds 8 / n of a squared distance; the scale makes up for that, and
    for the distance 2 - 2 cos at the threshold."""

    def __init__(self, dims: int, tables: int, probes: int, threshold: float):
        rng = np.random.default_rng(3)
        wide = max(dims, 8)
        scale = SPREAD * np.sqrt(wide / 8) / np.sqrt(max(2 - 2 * threshold, 1e-6))
        self.dims = dims
        self.axes = [np.linalg.qr(rng.normal(size=(wide, 8)))[0][:dims] * scale for _ in range(tables)]
        self.mix = rng.integers(0, 1 << 63, size=(tables, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.short, self.probes = _short_vectors(), probes

    def cells(self, x: np.ndarray) -> np.ndarray:
        """(vector, table, place): place 0 is the home, the others the cells visited."""
        out = np.empty((len(x), len(self.axes), self.probes + 1), dtype=np.uint64)
        for t, axes in enumerate(self.axes):
            y = x @ axes
            home = nearest_e8(y)
            # |y - (home + v)|**2 orders the neighbours like -2 (y - home) v, as all v are equally long
            near = np.argpartition(-((y - home) @ self.short.T), self.probes, axis=1)[:, :self.probes]
            points = np.concatenate([home[:, None], home[:, None] + self.short[near]], axis=1)
            whole = (2 * points).astype(np.int64).view(np.uint64)
            out[:, t] = mixed((whole * self.mix[t]).sum(axis=2, dtype=np.uint64) + np.uint64(self.dims))
        return out


def unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top  # no overflow or underflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cell_links(x: np.ndarray, node: np.ndarray, table: int, visits: np.ndarray, homes: np.ndarray,
               lattice: Lattice, threshold: float):
    """Of a cell's visitors and homes (row numbers): (visitor, home) pairs above the
    threshold, at most ``PAIRS`` at a time, without those that count elsewhere."""
    for i in range(0, len(visits), BLOCK):
        for j in range(0, len(homes), BLOCK):
            v, h = visits[i:i + BLOCK], homes[j:j + BLOCK]
            cosine = x[v] @ x[h].T
            above = cosine >= threshold - 1e-9
            # The product of matrices may round otherwise than that of two vectors: near the threshold each pair by itself.
            near = np.flatnonzero(above & (cosine < threshold + 1e-9))
            for k in range(0, len(near), max(1, PAIRS * 64 // x.shape[1])):
                some = near[k:k + max(1, PAIRS * 64 // x.shape[1])]
                a, b = np.unravel_index(some, above.shape)
                above.flat[some] = (x[v[a]] * x[h[b]]).sum(axis=1) >= threshold
            above &= node[v][:, None] != node[h][None, :]
            if not above.any():
                continue
            cells_v, cells_h = lattice.cells(x[v])[:, :table + 1], lattice.cells(x[h])[:, :table + 1]
            pairs = np.flatnonzero(above)
            for k in range(0, len(pairs), PAIRS):
                a, b = np.unravel_index(pairs[k:k + PAIRS], above.shape)
                p, q = cells_v[a], cells_h[b]
                meets = (p == q[:, :, :1]).any(axis=2)  # the first visits the second's home
                back = (q == p[:, :, :1]).any(axis=2)
                a, b = v[a], h[b]
                once = ~(meets | back)[:, :table].any(axis=1) & ((node[a] < node[b]) | ~back[:, table])
                yield a[once], b[once]


def _spanning(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> list[int]:
    """Numbers of the links (p, q) that join two parts; ``label`` (a forest) is updated."""
    while not np.array_equal(up := label[label], label):
        label[:] = up
    out = []
    for k in np.flatnonzero(label[p] != label[q]).tolist():
        c, d = int(p[k]), int(q[k])
        while label[c] != c:
            label[c] = c = label[label[c]]
        while label[d] != d:
            label[d] = d = label[label[d]]
        if c != d:
            label[max(c, d)] = min(c, d)
            out.append(k)
    return out


def link_rows(vectors: DataFrame, threshold: float, tables: int, probes: int) -> DataFrame:
    """(u, v, n) from rows (node, m, x) of distinct vectors: with v NULL, n more links of u; else a link."""
    kind = dict(vectors.dtypes)["x"]
    number = np.float32 if kind == "array<float>" else np.float64

    def lattices():
        return cache(lambda dims: Lattice(dims, tables, probes, threshold))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice_of = lattices()
        for b in batches:
            size = b.column(2).value_lengths().to_numpy()
            parts = [b.take(pa.array(np.flatnonzero(size == d)[at:at + 1024])) for d in np.unique(size).tolist()
                     for at in range(0, int((size == d).sum()), 1024)]
            for part in parts:
                dims = part.column(2).value_lengths()[0].as_py()
                lattice = lattice_of(dims)
                x = unit(part.column(2).flatten().to_numpy().astype(np.float64).reshape(-1, dims))
                cells = lattice.cells(x).view(np.int64)
                n, width = len(x), probes + 1
                body = part.column(2).flatten().to_numpy().astype(number).reshape(n, dims)
                body = pa.array([r.tobytes() for r in body], pa.binary())
                for t in range(tables):
                    row = pa.array(np.repeat(np.arange(n), width))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n * width, t, dtype=np.int32)), pa.array(cells[:, t].ravel()),
                         pa.array(np.tile(np.arange(width) == 0, n)), part.column(0).take(row),
                         part.column(1).take(row), body.take(row)], ["t", "cell", "home", "node", "m", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice_of = lattices()

        def done(part: pa.Table) -> Iterator[pa.RecordBatch]:
            node, m = part.column("node").to_numpy(), part.column("m").to_numpy()
            home, visits, t, cell = (part.column(c).to_numpy() for c in ("home", "visits", "t", "cell"))
            new = np.ones(len(node), dtype=bool)
            salt = part.column("salt").to_numpy()
            new[1:] = (t[1:] != t[:-1]) | (cell[1:] != cell[:-1]) | (salt[1:] != salt[:-1])
            cut = np.append(np.flatnonzero(new), len(node))
            bodies = part.column("x").combine_chunks()
            for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
                homes = np.flatnonzero(home[a:z])
                if z - a < 2 or not len(homes):
                    continue
                body = np.frombuffer(b"".join(v.as_py() for v in bodies[a:z]), dtype=number).reshape(z - a, -1)
                lattice = lattice_of(body.shape[1])
                x, ids, size = unit(body.astype(np.float64)), node[a:z], m[a:z]
                count = np.zeros(z - a, dtype=np.int64)
                label = np.arange(z - a)
                us, vs = [], []
                for p, q in cell_links(x, ids, int(t[a]), np.flatnonzero(visits[a:z]), homes, lattice, threshold):
                    np.add.at(count, p, size[q])
                    np.add.at(count, q, size[p])
                    joined_at = _spanning(label, p, q)
                    us.append(ids[p[joined_at]])
                    vs.append(ids[q[joined_at]])
                got = np.flatnonzero(count)
                if len(got):
                    us, vs = np.concatenate(us), np.concatenate(vs)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([ids[got], us])),
                         pa.array(np.concatenate([np.zeros(len(got), np.int64), vs]),
                                  mask=np.concatenate([np.ones(len(got), bool), np.zeros(len(us), bool)])),
                         pa.array(np.concatenate([count[got], np.zeros(len(us), np.int64)]))], ["u", "v", "n"])

        held: list[pa.Table] = []
        for b in batches:
            if not len(b):
                continue
            part = pa.Table.from_batches([b])
            key = [part.column(c).to_numpy() for c in ("t", "cell", "salt")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0))
            if held and tuple(held[-1].column(c)[-1].as_py() for c in ("t", "cell", "salt")) != tuple(k[0] for k in key):
                yield from done(pa.concat_tables(held))
                held = []
            if len(change):
                at = int(change[-1]) + 1
                yield from done(pa.concat_tables([*held, part.slice(0, at)]))
                held = [part.slice(at)]
            else:
                held.append(part)
        if held:
            yield from done(pa.concat_tables(held))

    longest = vectors.agg(F.max(F.size("x"))).first()[0] or 1
    cell_rows, home_rows = (max(256, min(n, CELL_BYTES // (8 * longest) // k)) for n, k in ((CELL_ROWS, 4), (HOME_ROWS, 1)))
    rows = vectors.mapInArrow(keys, "t int, cell long, home boolean, node long, m long, x binary")
    # Cells of many rows are dealt to a grid of tasks: a visitor goes to its row of the grid, a home to its
    # column, so every visitor meets every home in one task, and no task holds a whole cell.
    parts_of = lambda n: F.ceil(F.col("rows") / n)
    large = written(rows.groupBy("t", "cell").agg(F.count("*").alias("rows")).filter(F.col("rows") > cell_rows)
                    .select("t", "cell", parts_of(cell_rows).alias("parts"), parts_of(home_rows).alias("home_parts")),
                    "large-cells")
    one = F.lit(1).cast("long")
    rows = rows.join(large, ["t", "cell"], "left").withColumns(
        {c: F.coalesce(F.col(c), one) for c in ("parts", "home_parts")})
    across = F.col("home_parts")
    own, own_home = F.pmod(F.xxhash64("node"), F.col("parts")), F.pmod(F.xxhash64("node"), across)
    as_visitor = F.transform(F.sequence(one - 1, across - 1), lambda k: own * across + k)
    as_home = F.transform(F.sequence(one - 1, F.col("parts") - 1), lambda k: k * across + own_home)
    dealt = rows.withColumn("salt", F.explode(F.when(F.col("home"), F.array_union(as_visitor, as_home)).otherwise(as_visitor)))
    dealt = dealt.withColumns({"visits": F.floor(F.col("salt") / across) == own,
                               "home": F.col("home") & (F.col("salt") % across == own_home)}).drop("parts", "home_parts")
    return dealt.repartition("t", "cell", "salt").sortWithinPartitions("t", "cell", "salt").mapInArrow(
        run, "u long, v long, n long")


def embedding_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                         threshold: float = THRESHOLD, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: how many other rows have a cosine of
    ``threshold`` or more, the smallest id reachable over such links, and whether that is the row's own.

    Equal vectors are one node with a count. Vectors that are NULL, empty, zero or hold NULL or non-finite
    components link with nothing; vectors of different lengths don't link. Every row counts, also those with a NULL id or an id
    that other rows bear; where no row of a component has an id, ``component_id`` is NULL, and ``kept`` is false for rows
    without id. No pair below the threshold links; a pair at the threshold is found with
    probability 0.998 (8 dimensions or more), closer pairs more surely."""
    v = F.col(f"`{embedding}`")
    finite = ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    ok = F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda e: e != 0), F.lit(False))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                          F.when(ok, F.transform(v, lambda e: e + 0)).alias("x"))  # -0.0 is 0.0
    nodes = written(rows.filter("x is not null").groupBy("x").agg(F.min("vec_id").alias("least"), F.count("*").alias("m"))
                    .select(F.monotonically_increasing_id().alias("node"), "m", "x", "least"), "vectors")
    found = written(link_rows(nodes.select("node", "m", "x"), threshold, tables, probes), "links")
    label = least_of(components(found.filter("v is not null").select("u", "v")), nodes.select("node", "least"))
    count = found.filter("v is null").groupBy("u").agg(F.sum("n").alias("n"))
    known = nodes.join(count, F.col("u") == F.col("node"), "left").drop("u").join(label, "node", "left").select(
        "x", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"))
    out = rows.join(known, "x", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op2_lattice(spark, sf_dir: str) -> DataFrame:
    return embedding_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a, v b
      WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
c(u, r) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.v, c.r FROM c JOIN l ON l.u = c.u)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.u = v.vec_id) AS n_links,
       (SELECT min(r) FROM c WHERE c.u = v.vec_id) AS component_id,
       v.vec_id = (SELECT min(r) FROM c WHERE c.u = v.vec_id) AS kept
FROM v"""
