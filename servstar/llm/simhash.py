"""SimHash near-duplicates by pivot distance tables.

Fingerprints that link differ in ``radius`` bits at most, so their Hamming distances
to any reference fingerprint differ by ``radius`` at most (triangle inequality). Two kinds
of references use that:

* Structured references give the candidates. The 64 bits form 7 blocks. Table t owns
  three blocks; its references are 0 and the unit fingerprints of the bits in
  them. d(x, 0) - d(x, unit i) is +1 or -1 with bit i, so a fingerprint's coordinates in
  a table are its bits there, read by a mask. Four differing bits touch four blocks at
  most: two linked fingerprints have equal coordinates in at least one of the 35
  tables, which therefore find every link. (Random references alone prune too
  little: more than half of all pairs pass each.)
* Random references discard candidates: the rows of a table cell compare their distances
  to 24 references and drop pairs whose largest coordinate difference exceeds the
  radius. Survivors are verified bit by bit.

A cell of more than ``CELL_ROWS`` rows isn't gathered: its rows are dealt anew by the same
structured references over the 37 bits that the cell leaves open, in 35 tables again. Rows that
share such an inner cell agree in 42 bits or more, so it holds 2**22 distinct fingerprints at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar.llm.common import components, documents, least_of, text_chunks, word_spans, written

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
OWNED = 3
#: Rows of a cell beyond which it is dealt anew instead of compared in one task.
CELL_ROWS = 1 << 16
_SHINGLES_AT_ONCE = 1 << 16


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): the text's XXH64 and 64-bit SimHash (as signed longs) of the whole text, A-Z
    lower-cased. A bit is set if it is set in over half of the XXH64 values of the
    ``shingle``-word shingles; fewer words make one shingle, none makes 0."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32

    def joined(data: np.ndarray, offsets: np.ndarray) -> tuple[memoryview, np.ndarray, np.ndarray, np.ndarray]:
        """The words with one space between, their spans, and each text's first word."""
        starts, ends, doc = word_spans(data, offsets)
        keep = np.zeros(len(data) + 1, dtype=np.int8)
        keep[starts] += 1
        keep[ends] -= 1
        word = np.cumsum(keep[:-1]).astype(bool)
        size = ends - starts
        begin = np.cumsum(size + 1) - size - 1
        out = np.full(int(size.sum()) + len(size), 32, dtype=np.uint8)
        letters = np.ones(len(out), dtype=bool)
        letters[begin + size] = False
        out[letters] = lower[data[word]]
        return memoryview(out), begin, begin + size, np.searchsorted(doc, np.arange(len(offsets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest
        for b in batches:
            for i, j, data, offsets in text_chunks(b.column(1)):
                buffer, starts, ends, first = joined(data, offsets)
                out = np.zeros(j - i, dtype=np.uint64)
                for d in range(j - i):
                    s, e = starts[first[d]:first[d + 1]], ends[first[d]:first[d + 1]]
                    if not len(s):
                        continue
                    n = max(1, len(s) - shingle + 1)
                    s, e = s[:n], e[min(shingle, len(e)) - 1:]
                    ones = np.zeros(64, dtype=np.int64)
                    for k in range(0, n, _SHINGLES_AT_ONCE):
                        h = np.array([xxh64_intdigest(buffer[x:y], SEED) for x, y in
                                      zip(s[k:k + _SHINGLES_AT_ONCE].tolist(), e[k:k + _SHINGLES_AT_ONCE].tolist())],
                                     dtype="<u8")
                        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") \
                            .sum(axis=0, dtype=np.int64)
                    out[d] = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(out.view(np.int64))],
                    ["doc_id", "text_hash", "fp"])

    t = F.col(f"`{text}`")
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), t, text_hash(t).alias("text_hash")) \
        .mapInArrow(run, "doc_id long, text_hash long, fp long")


def text_hash(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def table_masks(blocks: int, owned: int, bits: list[int] | None = None) -> list[int]:
    """The bits owned by each table, as signed longs; ``bits``: the positions dealt out (all 64)."""
    bits = list(range(64)) if bits is None else bits
    at = [len(bits) * k // blocks for k in range(blocks + 1)]
    block = [sum(1 << x for x in bits[at[k]:at[k + 1]]) for k in range(blocks)]
    masks = [sum(block[k] for k in own) for own in combinations(range(blocks), owned)]
    return [_signed(m) for m in masks]


def _signed(m: int) -> int:
    return m - (1 << 64) if m >> 63 else m


def _references(n: int = 24) -> np.ndarray:
    return np.random.default_rng(5).integers(0, 1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + \
        np.random.default_rng(6).integers(0, 2, size=n, dtype=np.uint64)


def cell_links(fp: np.ndarray, cell: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that span the links within cells (runs of equal ``cell``).

    Cells of 2 or 3 are compared pair by pair, all at once. In a larger cell a row
    taken from the queue is compared with the rows not reached yet and links those it
    reaches: a spanning forest, never more pairs than rows, and in a dense group
    nearly all rows are reached by the first few."""
    table = np.bitwise_count(fp[:, None] ^ _references()[None, :]).astype(np.int8)

    def linked(a, b) -> np.ndarray:
        near = np.abs(table[a] - table[b]).max(axis=-1) <= radius
        out = np.zeros(near.shape, dtype=bool)
        rows = np.flatnonzero(near)
        left = fp[a] if np.ndim(a) == 0 else fp[a][rows]
        out[rows] = np.bitwise_count(left ^ fp[b][rows]) <= radius
        return out

    cut = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1 if len(cell) else 0, append=cell[-1] + 1 if len(cell) else 0))
    size = np.diff(cut)
    first, second = [], []
    small = cut[:-1][(size == 2) | (size == 3)]
    for gap in (1, 2):
        for begin in (0, 1):
            a = small + begin
            a = a[a + gap < len(fp)]
            a = a[cell[a + gap] == cell[a]]
            if len(a):
                hit = linked(a, a + gap)
                first.append(a[hit])
                second.append(a[hit] + gap)
    for k in np.flatnonzero(size > 3):
        rest, queue = np.arange(cut[k], cut[k + 1]), []
        while len(rest):
            if queue:
                x = queue.pop()
            else:
                x, rest = rest[0], rest[1:]
            hit = linked(x, rest)
            got = rest[hit]
            rest = rest[~hit]
            queue.extend(got.tolist())
            first.append(np.full(len(got), x))
            second.append(got)
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(first or none), np.concatenate(second or none)


def links(distinct: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(u, v) edges that span every link between the rows (fp, node) of distinct fingerprints."""
    masks = table_masks(radius + OWNED, OWNED)  # radius differing bits leave OWNED blocks untouched
    keys = lambda ms: F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in ms])
    cells = distinct.select("fp", "node", F.posexplode(keys(masks)).alias("table", "key"))
    found = written(_compared(cells, ["table", "key"], radius, cell_rows), "cell-links")
    # The same pigeonholes over the bits that a large cell's table doesn't own: within a cell, linked
    # rows differ in radius of those at most.
    inner = [table_masks(radius + OWNED, OWNED, [x for x in range(64) if not m >> x & 1]) for m in masks]
    by_table = F.element_at(F.array(*[F.array(*[F.lit(m) for m in ms]) for ms in inner]), F.col("table") + 1)
    large = found.filter("fp is not null").select("fp", "node", "table", "key", F.posexplode(
        F.transform(by_table, lambda m: m.bitwiseAND(F.col("fp")))).alias("inner", "inner_key"))
    more = _compared(large, ["table", "key", "inner", "inner_key"], radius, None)
    return found.filter("u is not null").select("u", "v").unionByName(more.select("u", "v"))


def _compared(cells: DataFrame, keys: list[str], radius: int, cell_rows: int | None) -> DataFrame:
    """Links (u, v) within the cells that ``keys`` name. Cells of more than ``cell_rows`` rows come out
    as their rows (fp, node, table, key) instead; a task holds that many rows and a batch."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("fp", pa.int64()), ("node", pa.int64()),
                        ("table", pa.int32()), ("key", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def changes(part: pa.Table) -> np.ndarray:
            new = np.zeros(len(part), dtype=bool)
            for c in keys:
                x = part.column(c).to_numpy()
                new[1:] |= x[1:] != x[:-1]
            return new

        def out(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

        def passed(part: pa.Table) -> pa.RecordBatch:
            return out(len(part), **{c: pa.array(part.column(c).to_numpy()) for c in ("fp", "node", "table", "key")})

        def closed(part: pa.Table) -> Iterator[pa.RecordBatch]:
            """Whole cells: large ones pass, the others are compared."""
            at = np.flatnonzero(changes(part))
            size = np.diff(at, prepend=0, append=len(part))
            if cell_rows is not None and size.max() > cell_rows:
                large = pa.array(np.repeat(size > cell_rows, size))
                yield passed(part.filter(large))
                part = part.filter(pa.compute.invert(large))
            fp, node = part.column("fp").to_numpy().view(np.uint64), part.column("node").to_numpy()
            a, b = cell_links(fp, np.cumsum(changes(part)), radius)
            yield out(len(a), u=pa.array(node[a]), v=pa.array(node[b]))

        held, passing, last = [], False, None  # rows of the cell that may go on; whether they pass; its keys
        for b in batches:
            if not len(b):
                continue
            part = pa.Table.from_batches([b])
            cut = np.flatnonzero(changes(part)).tolist()
            if last not in (None, [part.column(c)[0].as_py() for c in keys]):
                cut = [0, *cut]
            if passing:
                yield passed(part.slice(0, cut[0] if cut else None))
            else:
                held.append(part.slice(0, cut[0] if cut else None))
            if cut:
                held.append(part.slice(cut[0], cut[-1] - cut[0]))
                yield from closed(pa.concat_tables(held))
                held, passing = [part.slice(cut[-1])], False
            if cell_rows is not None and sum(map(len, held)) > cell_rows:
                yield passed(pa.concat_tables(held))
                held, passing = [], True
            last = [part.column(c)[-1].as_py() for c in keys]
        if held:
            yield from closed(pa.concat_tables(held))

    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        run, "u long, v long, fp long, node long, table int, key long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id, text_hash, kept) of every row: 16 hexadecimal digits, the
    smallest doc_id reachable over links of ``radius`` differing bits or fewer, the text's XXH64, and whether the
    row is its component's first (by id, NULL ids last, then text hash).

    Equal fingerprints are one node, whatever ids their rows have, so a group of copies costs one row. Texts without words have
    fingerprint 0. Rows with a NULL id or an id that others bear link like any other; ``component_id`` is NULL
    where no row of the component has an id. Rows equal in id and text are kept or not together."""
    fps = written(fingerprints(docs, text, doc_id, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash"))
    nodes = written(fps.groupBy("fp").agg(first.alias("least")).select(F.col("fp").alias("node"), "least"), "fp-nodes")
    found = least_of(components(links(nodes.select(F.col("node").alias("fp"), "node"), radius)), nodes)
    label = nodes.join(found, "node", "left").select(F.col("node").alias("fp"), F.coalesce("component_id", "least").alias("least"))
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    return fps.join(label, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"),
        "text_hash", own.eqNullSafe(F.col("least")).alias("kept"))


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")
