"""Hard negatives from lists that the anchors of a cluster share (after MAXIMUS).

Anchors are clustered by direction. With t the angle of a row to a cluster's centroid, s the
cluster's widest anchor angle and |x| the row's length, no anchor a of the cluster scores the row above
|a| * |x| * cos(max(0, t - s)). The rows sorted by that bound without |a| are the cluster's list; it is sorted once, and
every member walks it until its worst wanted score exceeds all bounds that follow: certified termination.

A list isn't gathered, nor is a row sent once for every cluster. Rows are dealt once, to shards of rows that are nearest to
the same centroid, and the members of many clusters meet a shard in one task, which sorts the shard's part of
each cluster's list and lets the members walk it; their best over all shards are merged. The lists' heads, about ``HEAD``
rows each by a histogram of the bounds, go first and give every member a score that it can't do worse than. The
lowest of these over a cluster's members cuts its list: rows below all cuts and clusters out of a shard's reach are
certified to be of no use and aren't sent. Positives come first, then the negatives between their two limits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servstar.llm.common import hash_sample, written

#: Rows of a list that are walked first, rows of a shard, anchors that meet a shard in one task.
HEAD, SHARD_ROWS, MEMBERS = 4096, 32768, 4096
#: Bytes of a shard's vectors that a task sorts at once; a larger shard is walked part by part.
SHARD_BYTES = 1 << 25
#: Anchors a cluster should have, clusters at most, and sampled anchors (numbers of theirs) that fit the centroids.
CLUSTER_ANCHORS, MOST_CLUSTERS, SAMPLE, SAMPLE_NUMBERS = 128, 512, 8192, 1 << 22
#: Shards of the rows whose number of dimensions no sampled anchor has.
OTHER_SHARDS = 16
BINS = 1000
BLOCK = 1024
LEAST, MOST = -(1 << 62), 1 << 62
ROWS = "rid long, vec_id long, label long, anchor boolean, dims int, norm double, x binary"
DEALT = "home long, shard int, chunk long, cluster long, rid long, vec_id long, label long, norm double, x binary, " \
        "low array<long>, high array<long>, least array<long>"
FOUND = "anchor long, query int, score long, vec_id long, rid long"


def vectors_of(column: pa.Array, dims: int, kind=np.int32) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in column), dtype=kind).reshape(-1, dims)


def whole_vectors(vectors: DataFrame, anchor: Column, vec_id: str, embedding: str, label: str, scale: float) -> DataFrame:
    """The rows that take part, under a row number, their components floor(scale * x) as 32-bit integers."""
    e = F.col(f"`{embedding}`")
    finite = ~F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    ok = e.isNotNull() & F.col(f"`{label}`").isNotNull() & (F.size(e) > 0) & finite
    rows = vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                          F.col(f"`{label}`").cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
                          F.when(ok, e.cast("array<double>")).alias("e")).filter("e is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), BLOCK):
                part = b.slice(at, BLOCK)
                size = part.column(4).value_lengths().to_numpy()
                with np.errstate(over="ignore"):
                    flat = np.floor(part.column(4).flatten().to_numpy() * scale)
                    first = np.cumsum(size) - size
                    norm = np.sqrt(np.add.reduceat(flat * flat, first))
                use = np.flatnonzero(norm < 1 << 31)  # longer ones have scores that are no longs
                x = [flat[first[k]:first[k] + size[k]].astype("<i4").tobytes() for k in use.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(pa.array(use)) for c in range(4)]
                    + [pa.array(size[use].astype(np.int32)), pa.array(norm[use]), pa.array(x, pa.binary())],
                    [c.split()[0] for c in ROWS.split(", ")])

    return rows.mapInArrow(run, ROWS)


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def spherical_means(x: np.ndarray, k: int, steps: int = 8) -> np.ndarray:
    """Unit centroids of at most ``k`` clusters of directions."""
    x = unit(x)
    centre = np.unique(x[np.random.default_rng(7).choice(len(x), size=min(k, len(x)), replace=False)], axis=0)
    for _ in range(steps):
        own = (x @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        centre = unit(total[np.bincount(own, minlength=len(centre)) > 0])
    return centre


def angles(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """(row, centroid); 0 for a row without direction."""
    x = unit(x.astype(np.float64))
    out = np.arccos(np.clip(x @ centre.T, -1, 1))
    out[~x.any(axis=1)] = 0
    return out


class Clusters:
    """Centroids by number of dimensions, and what is known of each cluster, counted over all rows.

    Cluster ``dims * 1024 + k`` belongs to centroid k of vectors of ``dims`` components; a number of dimensions that the
    sample lacks has one cluster without a centroid, whose bound is the row's length."""

    def __init__(self, centre: dict[int, np.ndarray]):
        self.centre = centre
        #: Widest angle of an anchor, and of any row; length of the longest row of the cluster.
        self.wide, self.radius, self.longest = ({d: np.zeros(len(c)) for d, c in centre.items()} for _ in range(3))
        #: First chunk and number of chunks of a cluster's anchors; shards of its rows.
        self.chunks: dict[int, tuple[int, int]] = {}
        self.shards: dict[int, int] = {}
        self.top = 1.0

    def nearest(self, dims: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's cluster and angle."""
        if dims not in self.centre:
            return np.full(len(x), dims * 1024 + 1023), np.full(len(x), np.pi)
        angle = angles(x, self.centre[dims])
        own = angle.argmin(axis=1)
        return dims * 1024 + own, angle[np.arange(len(x)), own]

    def bounds(self, dims: int, x: np.ndarray, norm: np.ndarray, only=slice(None)) -> np.ndarray:
        """(row, cluster) upper bounds of score / anchor length, rounding covered."""
        if dims not in self.centre:
            return norm[:, None] * (1 + 1e-9)
        apart = np.maximum(angles(x, self.centre[dims][only]) - self.wide[dims][only] - 1e-6, 0)
        return norm[:, None] * (np.cos(apart) + 1e-9)

    def reach(self, dims: int) -> np.ndarray:
        """(home, cluster): the same for all rows whose nearest centroid is the home's."""
        apart = angles(self.centre[dims], self.centre[dims]) - self.wide[dims] - self.radius[dims][:, None] - 2e-6
        return self.longest[dims][:, None] * (np.cos(np.maximum(apart, 0)) + 2e-9)

    def chunked(self, dims: int) -> tuple[np.ndarray, np.ndarray]:
        """The clusters with anchors (numbers of centroids), ordered by chunk, and each one's first chunk."""
        own = np.array([k for k in range(len(self.centre[dims])) if dims * 1024 + k in self.chunks], dtype=np.int64)
        return own, np.array([self.chunks[dims * 1024 + k][0] for k in own.tolist()], dtype=np.int64)

    def low(self, dims: int, only: np.ndarray, cut: dict[int, float]) -> np.ndarray:
        """Cuts of these clusters, a little lower for rounding."""
        low = np.array([cut.get(dims * 1024 + k, -np.inf) for k in only.tolist()])
        return low - np.where(np.isinf(low), 0, 1e-9 * np.abs(low))


def by_length(part: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(dims, its rows, their vectors) of a batch with columns ``dims`` and ``x``."""
    dims = part.column("dims").to_numpy()
    for d in np.unique(dims).tolist():
        own = part.take(pa.array(np.flatnonzero(dims == d)))
        yield d, own, vectors_of(own.column("x"), d)


def fitted(anchors: DataFrame) -> Clusters:
    """Centroids from a sample of at most about 8192 anchors (fewer of long vectors)."""
    total, longest = anchors.agg(F.count("*"), F.max("dims")).first()
    some = hash_sample(anchors.select("rid", "dims", "x"), min(SAMPLE, SAMPLE_NUMBERS // (longest or 1) + 1), "rid")
    groups: dict[int, list] = {}
    for r in some.collect():
        groups.setdefault(r.dims, []).append(np.frombuffer(r.x, dtype=np.int32).astype(np.float64))
    seen = sum(map(len, groups.values())) or 1
    wanted = min(MOST_CLUSTERS, -(-total // CLUSTER_ANCHORS))
    return Clusters({d: c for d, g in groups.items()
                     if len(c := spherical_means(np.array(g), max(1, wanted * len(g) // seen)))})


def clustered(rows: DataFrame, clusters: Clusters) -> DataFrame:
    """Rows with their cluster and angle; fills in what is known of the clusters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), BLOCK):
                for dims, own, x in by_length(b.slice(at, BLOCK)):
                    cluster, angle = clusters.nearest(dims, x)
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(cluster), pa.array(angle)],
                                                     [*own.schema.names, "cluster", "angle"])

    out = written(rows.mapInArrow(run, ROWS + ", cluster long, angle double"), "clustered")
    known = out.filter(F.col("cluster") % 1024 < 1023).groupBy("cluster").agg(
        F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max("angle").alias("radius"), F.max("norm").alias("longest"),
        F.max(F.when(F.col("anchor"), F.col("angle"))).alias("wide"))
    chunk = held = last = 0
    for r in sorted(known.collect()):  # one row per centroid
        d, k = divmod(r.cluster, 1024)
        clusters.radius[d][k], clusters.longest[d][k], clusters.wide[d][k] = r.radius, r.longest, r.wide or 0.0
        clusters.shards[r.cluster] = -(-r.n // SHARD_ROWS)
        clusters.top = max(clusters.top, r.longest)
        if r.anchors:
            if d != last or held + r.anchors > MEMBERS:
                chunk, held = chunk + 1, 0
            parts = -(-r.anchors // MEMBERS)
            clusters.chunks[r.cluster] = (chunk, parts)
            chunk, held, last = chunk + parts - 1, MEMBERS if parts > 1 else held + r.anchors, d
    return out


def histogram(rows: DataFrame, clusters: Clusters) -> DataFrame:
    """(cluster, bin, n): rows by their bound in thousandths of the longest row's, of the clusters with anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[int, np.ndarray] = {}
        for b in batches:
            for at in range(0, len(b), BLOCK):
                for dims, own, x in by_length(b.slice(at, BLOCK)):
                    if dims not in clusters.centre:
                        continue
                    only, _ = clusters.chunked(dims)
                    bins = bin_of(clusters.bounds(dims, x, own.column("norm").to_numpy(), only), clusters.top)
                    for k, c in enumerate((dims * 1024 + only).tolist()):
                        count[c] = count.get(c, 0) + np.bincount(bins[:, k], minlength=2 * BINS + 3)
        for c, n in count.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), c)), pa.array(at), pa.array(n[at])], ["cluster", "bin", "n"])

    return written(rows.mapInArrow(run, "cluster long, bin long, n long").groupBy("cluster", "bin").agg(F.sum("n").alias("n")),
                   "bound-histogram")


def bin_of(bound, top: float):
    return np.clip(np.floor(bound / top * BINS) + BINS, 0, 2 * BINS + 2).astype(np.int64)


def dealt_rows(rows: DataFrame, clusters: Clusters, cut: dict[int, float]) -> DataFrame:
    """The rows above some cluster's cut, once per chunk of members that they can serve."""
    names = [c.split()[0] for c in DEALT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), BLOCK):
                for dims, own, x in by_length(b.slice(at, BLOCK)):
                    home, rid = own.column("cluster").to_numpy(), own.column("rid").to_numpy()
                    if dims in clusters.centre:
                        only, first = clusters.chunked(dims)
                        above = clusters.bounds(dims, x, own.column("norm").to_numpy(), only) >= clusters.low(dims, only, cut)
                        shards = np.array([clusters.shards[h] for h in home.tolist()])
                        chunks = {(f + k): above[:, first == f].any(axis=1) for f in np.unique(first).tolist()
                                  for k in range(max(clusters.chunks[dims * 1024 + c][1] for c in only[first == f].tolist()))}
                    else:
                        shards, chunks = np.full(len(x), OTHER_SHARDS), {-dims: np.ones(len(x), dtype=bool)}
                    shard = (rid * 0x9E3779B1 % (1 << 31) % shards).astype(np.int32)
                    for chunk, use in chunks.items():
                        at_ = pa.array(np.flatnonzero(use))
                        n, part = len(at_), own.take(at_)
                        none, given = pa.nulls(n, pa.list_(pa.int64())), {c: part.column(c) for c in ("rid", "vec_id", "label", "norm", "x")}
                        given |= {"home": pa.array(home[use]), "shard": pa.array(shard[use]), "chunk": pa.array(np.full(n, chunk)),
                                  "cluster": pa.nulls(n, pa.int64()), "low": none, "high": none, "least": none}
                        yield pa.RecordBatch.from_arrays([given[c] for c in names], names)

    return rows.mapInArrow(run, DEALT)


def dealt_members(members: DataFrame, clusters: Clusters, cut: dict[int, float]) -> DataFrame:
    """The members, once per shard within their cluster's reach."""
    names = [c.split()[0] for c in DEALT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = {d: clusters.reach(d) for d in clusters.centre}
        for b in batches:
            cluster, rid = b.column("cluster").to_numpy(), b.column("rid").to_numpy()
            for c in np.unique(cluster).tolist():
                d, k = divmod(c, 1024)
                at = np.flatnonzero(cluster == c)
                first, parts = clusters.chunks.get(c, (-d, 1))
                chunk = pa.array(first + rid[at] * 0x85EBCA6B % (1 << 31) % parts)
                part = b.take(pa.array(at))
                near = [(c, OTHER_SHARDS)] if d not in reach else [
                    (d * 1024 + h, clusters.shards[d * 1024 + h])
                    for h in np.flatnonzero(reach[d][:, k] >= clusters.low(d, np.array([k]), cut)).tolist() if d * 1024 + h in clusters.shards]
                for home, shards in near:
                    for shard in range(shards):
                        given = {"home": pa.array(np.full(len(at), home)), "shard": pa.array(np.full(len(at), shard, np.int32)), "chunk": chunk}
                        yield pa.RecordBatch.from_arrays([given[n] if n in given else part.column(n) for n in names], names)

    return members.mapInArrow(run, DEALT)


def best(clusters: Clusters, cut: dict[int, float], wanted: int, same: bool):
    """Members and rows by (home, shard, chunk), members first, to the ``wanted`` best rows of the members' queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, key = None, None
        for b in batches:
            if not len(b):
                continue
            keys = [b.column(c).to_numpy() for c in ("home", "shard", "chunk")]
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            for a, z in zip([0, *new.tolist()], [*new.tolist(), len(b)]):
                now = tuple(int(k[a]) for k in keys)
                if now != key:
                    if task is not None:
                        yield from task.result()
                    task, key = Shard(now[0] // 1024, clusters, cut, wanted, same), now
                task.take(b.slice(a, z - a))
        if task is not None:
            yield from task.result()

    return run


class Shard:
    """A shard of rows and the members of a chunk of clusters."""

    def __init__(self, dims: int, clusters: Clusters, cut: dict[int, float], wanted: int, same: bool):
        self.dims, self.clusters, self.cut, self.wanted, self.same = dims, clusters, cut, wanted, same
        self.members: list[pa.RecordBatch] = []
        self.rows: list[pa.RecordBatch] = []
        self.walks: dict[int, Walk] | None = None
        self.most = max(1, min(SHARD_ROWS, SHARD_BYTES // (4 * dims)))

    def take(self, part: pa.RecordBatch) -> None:
        members = len(part) - part.column("cluster").null_count
        if members:
            self.members.append(part.slice(0, members))
        if self.members and members < len(part):
            self.rows.append(part.slice(members))
            if sum(map(len, self.rows)) >= self.most:
                self.walk()

    def walk(self) -> None:
        """Each cluster's list of the rows at hand, sorted once, and its members' walks."""
        if self.walks is None:
            m = pa.Table.from_batches(self.members).combine_chunks().to_batches()[0]
            cluster = m.column("cluster").to_numpy()
            self.walks = {c: Walk(m.take(pa.array(np.flatnonzero(cluster == c))), self.dims, self.wanted, self.same)
                          for c in np.unique(cluster).tolist()}
        part = pa.Table.from_batches(self.rows).combine_chunks().to_batches()[0]
        self.rows = []
        rows = Rows(part, self.dims)
        for c, walk in self.walks.items():
            only = np.array([c % 1024])
            bound = self.clusters.bounds(self.dims, rows.x, rows.norm, only)[:, 0]
            use = np.flatnonzero(bound >= self.clusters.low(self.dims, only, self.cut))
            walk.down(rows, use[np.argsort(-bound[use], kind="stable")], bound)

    def result(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            self.walk()
        for walk in (self.walks or {}).values():
            yield from walk.result()


class Rows:
    def __init__(self, part: pa.RecordBatch, dims: int):
        self.x = vectors_of(part.column("x"), dims)
        self.norm, self.label, self.rid = (part.column(c).to_numpy() for c in ("norm", "label", "rid"))
        self.known = part.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
        self.id = part.column("vec_id").fill_null(0).to_numpy()


class Walk:
    """The members of one cluster and the best rows of their queries so far."""

    def __init__(self, members: pa.RecordBatch, dims: int, wanted: int, same: bool):
        self.wanted, self.same = wanted, same
        self.x = vectors_of(members.column("x"), dims)
        self.norm, self.label, self.rid = (members.column(c).to_numpy() for c in ("norm", "label", "rid"))
        n = members.column("low").value_lengths().to_numpy()
        self.member = np.repeat(np.arange(len(n)), n)
        self.number = np.arange(len(self.member)) - np.repeat(np.cumsum(n) - n, n)
        low, self.high, least = (members.column(c).flatten().to_numpy() for c in ("low", "high", "least"))
        self.need = np.maximum(low, least)
        self.top = [np.zeros(0, dtype=np.int64) for _ in range(4)] + [np.zeros(0, dtype=bool)]  # query, score, vec_id, rid, known

    def down(self, rows: Rows, order: np.ndarray, bound: np.ndarray) -> None:
        """Walks the list ``order`` (descending bounds) until all queries are done."""
        i, size = 0, 32
        while i < len(order) and self._block(rows, order[i:i + size], bound[order[i]]):
            i, size = i + size, min(BLOCK, 2 * size)

    def _block(self, rows: Rows, at: np.ndarray, bound: float) -> bool:
        """Rows whose bounds are ``bound`` at most. A query whose worst wanted score exceeds that is done; false if all are."""
        reach = self.norm[self.member] * bound
        query = np.flatnonzero(reach + 1e-9 * np.abs(reach) + 1e-6 >= self.need)
        if not len(query):
            return False
        who, column = np.unique(self.member[query], return_inverse=True)
        exact = np.float64 if rows.norm[at].max() * self.norm[who].max() < 1 << 52 else np.int64
        score = (rows.x[at].astype(exact) @ self.x[who].astype(exact).T).astype(np.int64)
        fits = rows.label[at][:, None] == self.label[who][None, :]
        fits = fits & (rows.rid[at][:, None] != self.rid[who][None, :]) if self.same else ~fits
        score, fits = score[:, column], fits[:, column]
        row, q = np.nonzero(fits & (score >= self.need[query]) & (score <= self.high[query]))
        if len(row):
            new = (query[q], score[row, q], *(a[at[row]] for a in (rows.id, rows.rid, rows.known)))
            top = [np.concatenate([a, b]) for a, b in zip(self.top, new)]
            order = np.lexsort((top[3], top[2], ~top[4], -top[1], top[0]))
            top = [a[order] for a in top]
            begin = np.flatnonzero(np.diff(top[0], prepend=-1))
            rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
            self.top = [a[rank < self.wanted] for a in top]
            full = rank == self.wanted - 1
            self.need[top[0][full]] = np.maximum(self.need[top[0][full]], top[1][full])
        return True

    def result(self) -> Iterator[pa.RecordBatch]:
        q, score, ids, rid, known = self.top
        if len(q):
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.rid[self.member[q]]), pa.array(self.number[q].astype(np.int32)), pa.array(score),
                 pa.array(ids, mask=~known), pa.array(rid)], [c.split()[0] for c in FOUND.split(", ")])


def walked(rows: DataFrame, members: DataFrame, clusters: Clusters, cut: dict[int, float], wanted: int, same: bool,
           name: str) -> DataFrame:
    """FOUND rows plus ``place`` (from 1): the ``wanted`` best rows of every query of the members
    (columns of anchors, and arrays low, high, least: limits of the score, and a score that the worst wanted one reaches)."""
    keys = ["home", "shard", "chunk"]
    every = dealt_members(members, clusters, cut).unionByName(dealt_rows(rows, clusters, cut))
    found = every.repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_last("cluster")).mapInArrow(
        best(clusters, cut, wanted, same), FOUND)
    order = Window.partitionBy("anchor", "query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return written(found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= wanted), name)


def cuts(members: DataFrame, worst: DataFrame, clusters: Clusters) -> dict[int, float]:
    """Per cluster the least bound that a row of use can have; ``worst``: (anchor, query, score) of the queries with all
    places filled. A query without is held to its lower limit."""
    queries = members.select("cluster", "rid", "norm", F.posexplode("low").alias("query", "low"))
    need = queries.join(worst.withColumnRenamed("anchor", "rid"), ["rid", "query"], "left") \
        .select("cluster", F.when(F.col("norm") > 0, F.greatest("low", "score") / F.col("norm")).otherwise(F.lit(float("-inf"))).alias("b"))
    return {r.cluster: r.b if r.b > LEAST / 2 ** 31 else -np.inf
            for r in need.filter(F.col("cluster") % 1024 < 1023).groupBy("cluster").agg(F.min("b").alias("b")).collect()}


def searched(rows: DataFrame, members: DataFrame, clusters: Clusters, head: dict[int, float], wanted: int, same: bool,
             name: str) -> DataFrame:
    """``walked`` over the lists' heads, then over the lists down to the cuts that the heads certify."""
    first = walked(rows, members, clusters, head, wanted, same, f"{name}-heads")
    worst = first.filter(F.col("place") == wanted).select("anchor", "query", "score")
    cut = cuts(members, worst, clusters)
    known = worst.groupBy(F.col("anchor").alias("rid")).agg(F.map_from_entries(F.collect_list(F.struct("query", "score"))).alias("at"))
    least = F.transform("least", lambda v, k: F.coalesce(F.col("at")[k.cast("int")], v))
    members = members.join(known, "rid", "left").withColumn("least", least).drop("at")
    return walked(rows, members, clusters, cut, wanted, same, name)


def hard_negatives(vectors: DataFrame, anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                   positives: int = 5, negatives: int = 3, scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row that the condition
    ``anchor`` picks and each of its ``positives`` best other rows of the same label, the ``negatives`` best rows
    of another label that score from a half to 95 percent of the positive.

    A score is the inner product of the vectors with components floor(scale * x), exact; ties go to the smaller id, NULL ids last.
    Rows with a NULL label, a NULL or empty vector or a component that is NULL or not finite take no part, nor do vectors of a
    length of 2**31 or more (after scaling), whose scores may be no longs. Vectors of different
    dimensions have no score. Rows are what counts: repeated rows are other rows, each with its own place and
    results. Zero vectors score 0. An anchor without a positive, or a positive without a negative, gives no row."""
    rows = written(whole_vectors(vectors, anchor, vec_id, embedding, label, scale), "whole-vectors")
    clusters = fitted(rows.filter("anchor"))
    rows = clustered(rows, clusters)
    members = rows.filter("anchor")
    counts = histogram(rows, clusters)
    upto = F.sum("n").over(Window.partitionBy("cluster").orderBy(F.desc("bin")))
    found = counts.withColumn("upto", upto).filter(F.col("upto") - F.col("n") < HEAD).groupBy("cluster").agg(F.min("bin").alias("bin"))
    head = {r.cluster: (r.bin - BINS) / BINS * clusters.top if r.bin else -np.inf for r in found.collect()}  # one row per centroid

    limit = lambda v: F.array(F.lit(v).cast("long"))
    members = members.withColumns({"low": limit(LEAST), "high": limit(MOST), "least": limit(LEAST)})
    close = searched(rows, members, clusters, head, positives, True, "positives")
    p = F.col("score")
    # 50 p <= 100 n <= 95 p, without products that leave the range of longs
    band = close.filter("score >= 0").withColumn("half", F.expr("(score + pmod(score, 2)) div 2")).groupBy(F.col("anchor").alias("rid")).agg(
        F.array_sort(F.collect_list(F.struct((F.col("place") - 1).alias("k"), F.col("half").alias("low"),
                                             (p - F.expr("(score + pmod(-score, 20)) div 20")).alias("high")))).alias("band"))
    askers = written(members.drop("low", "high", "least").join(band, "rid").select(
        "*", F.col("band.low").alias("low"), F.col("band.high").alias("high"), F.col("band.low").alias("least")).drop("band"), "askers")
    hard = searched(rows, askers, clusters, head, negatives, False, "negatives")
    ids = rows.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    chosen = close.select("anchor", (F.col("place") - 1).alias("query"), F.col("vec_id").alias("positive_id"),
                          F.col("score").alias("positive_score"))
    return hard.join(chosen, ["anchor", "query"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.*, other_id AS negative_id, score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
                   AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
