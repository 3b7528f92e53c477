"""Removal of repeated byte strings by depth-limited radix sort of suffixes.

Suffixes are ordered only through their first 400 bytes, most significant digit
first, and a group of one is dropped as soon as it is alone; the groups left at depth 400 are
exactly the repeated strings.

The first digit is the suffix's anchor: of the 128-byte strings inside its 400 bytes, the
one with the smallest hash, and how far it is from the suffix's start. Equal strings have
equal anchors, and neighbouring suffixes mostly share one, so a whole run of suffixes is one row
in the first pass (about one row per 140 bytes of text). The second digit is the content of a
run: copies of a run collapse into one row with a count. Only runs whose anchor occurs with
several contents go on, and their suffixes are sorted by four digits of 100 bytes, each
digit read as the 64-bit hash of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar.llm.common import RollingHash, documents, keyed, text_chunks, written

DEPTH = 400
GRAM = 128
DIGITS = 4
BLOCK = 1 << 20
#: Contents of one anchor that one task sorts; beyond, their suffixes are dealt out by whole hash.
MOST_CONTENTS = 20_000


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return x if have == width else np.minimum(x[:len(x) - (width - have)], x[width - have:])


def runs(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM) -> DataFrame:
    """(anchor, c1, c2, did, t32, lo, n, lead): runs of ``n`` suffixes from byte ``lo`` on that share an
    anchor, ``lead`` bytes into the first; (c1, c2) is the hash of the run's n + depth - 1 bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = RollingHash(51), RollingHash(61)
        low = np.uint64((1 << 22) - 1)
        for b in batches:
            ids, t32 = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, j, data, offsets in text_chunks(b.column(2), BLOCK):
                for begin in range(0, max(len(data) - depth + 1, 0), BLOCK):
                    part = data[begin:begin + BLOCK + depth - 1]
                    if len(part) < depth:
                        continue
                    p1, p2 = one.prefix(one.values[part]), two.prefix(two.values[part])
                    at = np.arange(len(part) - gram + 1)
                    h = one.spans(p1, at, at + gram)
                    least = _sliding_min((h & ~low) | at.astype(np.uint64), depth - gram + 1)
                    where = np.arange(len(least)) + begin
                    doc = np.searchsorted(offsets, where, side="right") - 1
                    valid = where + depth <= offsets[doc + 1]
                    new = np.ones(len(least), dtype=bool)
                    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
                    new |= np.concatenate([[True], valid[1:] != valid[:-1]])
                    first = np.flatnonzero(new)
                    n = np.diff(np.append(first, len(least)))
                    first, n = first[valid[first]], n[valid[first]]
                    gram_at = (least[first] & low).astype(np.int64)
                    end = first + n - 1 + depth
                    d = doc[first]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[gram_at].view(np.int64)), pa.array(one.spans(p1, first, end).view(np.int64)),
                         pa.array(two.spans(p2, first, end).view(np.int64)), pa.array(ids[i:j][d]), pa.array(t32[i:j][d]),
                         pa.array(first + begin - offsets[d]), pa.array(n.astype(np.int32)),
                         pa.array((gram_at - first).astype(np.int32))],
                        ["anchor", "c1", "c2", "did", "t32", "lo", "n", "lead"])

    return docs.select("did", "t32", "text").mapInArrow(
        run, "anchor long, c1 long, c2 long, did long, t32 int, lo long, n int, lead int")


def contents(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(anchor, c1, c2, n, lead, body): the bytes of the chosen runs, cut from their texts."""
    per_text = chosen.groupBy("did", "t32").agg(F.collect_list(F.struct("anchor", "c1", "c2", "lo", "n", "lead")).alias("runs"))
    kind = "anchor long, c1 long, c2 long, n int, lead int, body binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                body = memoryview(b.column(0).slice(i, 1).cast(pa.binary())[0].as_buffer())
                rows = pa.RecordBatch.from_struct_array(b.column(1)[i].values)
                lo, n = rows.column("lo").to_numpy(), rows.column("n").to_numpy()
                cut = pa.array([bytes(body[x:x + k + DEPTH - 1]) for x, k in zip(lo.tolist(), n.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in ("anchor", "c1", "c2", "n", "lead")] + [cut], [x.split()[0] for x in kind.split(", ")])

    return docs.join(per_text, ["did", "t32"]).select("text", "runs").mapInArrow(run, kind)


def _suffixes(part: pa.Table) -> tuple:
    """Of rows of contents: the joined bytes, and each suffix's row, number in its run and place."""
    body = pa.concat_arrays([c.cast(pa.large_binary()) for c in part.column("body").chunks])
    offsets = np.frombuffer(body.buffers()[1], dtype=np.int64, count=len(body) + body.offset + 1)[body.offset:]
    data = np.frombuffer(body.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    n = part.column("n").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return data, row, number, offsets[row] + number


def radix_sorted(part: pa.Table, rolling: RollingHash, depth: int = DEPTH, digits: int = DIGITS) -> np.ndarray:
    """Flags of the suffixes of ``part`` (complete anchors) that occur twice or more.

    Most significant digit first: a pass orders the suffixes by (group, digit), numbers the new
    groups, and drops the groups of one."""
    data, row, number, place = _suffixes(part)
    anchor, lead = part.column("anchor").to_numpy(), part.column("lead").to_numpy()
    prefix = rolling.prefix(rolling.values[data])
    live = np.arange(len(row))
    group, digit = anchor[row], (lead[row] - number).astype(np.uint64)
    step = depth // digits
    for k in range(digits + 1):
        order = np.lexsort((digit, group))
        g, x = group[order], digit[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (g[1:] != g[:-1]) | (x[1:] != x[:-1])
        name = np.cumsum(new) - 1
        many = np.bincount(name, minlength=1)[name] > 1
        live, group = live[order][many], name[many]
        if k < digits and len(live):
            at = place[live] + k * step
            digit = rolling.spans(prefix, at, at + step)
        elif not len(live):
            break
    out = np.zeros(len(row), dtype=bool)
    out[live] = True
    return out


def _covered(part: pa.Table, hit: np.ndarray) -> pa.RecordBatch:
    """(anchor, c1, c2, lo, hi): bytes of the run that its repeated suffixes cover, as merged intervals."""
    n = part.column("n").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = np.flatnonzero(hit)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] if len(at) else at
    r = row[first]
    return pa.RecordBatch.from_arrays(
        [pa.array(part.column(c).to_numpy()[r]) for c in ("anchor", "c1", "c2")]
        + [pa.array(number[first]), pa.array(number[last] + DEPTH)], ["anchor", "c1", "c2", "lo", "hi"])


def sort_anchors(rows: DataFrame) -> DataFrame:
    """(anchor, c1, c2, lo, hi) by sorting the contents of each anchor inside one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, held, size = RollingHash(71), [], 0

        def done(parts: list) -> pa.RecordBatch:
            part = pa.concat_tables(parts)
            return _covered(part, radix_sorted(part, rolling))

        for b in batches:
            for at in range(0, len(b), 1024):
                part = pa.Table.from_batches([b.slice(at, 1024)])
                size += part.nbytes
                held.append(part)
                if size < BLOCK:
                    continue
                joined = pa.concat_tables(held)  # all but the last anchor, which may go on
                anchor = joined.column("anchor").to_numpy()
                cut = int(np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))[-1])
                if cut:
                    yield done([joined.slice(0, cut)])
                    joined = joined.slice(cut)
                held, size = [joined], joined.nbytes if cut else 0
        if held:
            yield done(held)

    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        run, "anchor long, c1 long, c2 long, lo long, hi long")


def deal_suffixes(rows: DataFrame) -> DataFrame:
    """The same for anchors with more contents than a task should hold: every suffix is a row,
    keyed by its offset from the anchor and its 128-bit hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = RollingHash(81), RollingHash(91)
        for b in batches:
            for at in range(0, len(b), 256):
                part = pa.Table.from_batches([b.slice(at, 256)])
                data, row, number, place = _suffixes(part)
                hashes = [r.spans(r.prefix(r.values[data]), place, place + DEPTH).view(np.int64) for r in (one, two)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.column(c).to_numpy()[row]) for c in ("anchor", "c1", "c2")]
                    + [pa.array(number), *map(pa.array, hashes)], ["anchor", "c1", "c2", "number", "h1", "h2"])

    each = rows.mapInArrow(run, "anchor long, c1 long, c2 long, number long, h1 long, h2 long")
    many = each.groupBy("h1", "h2").agg(F.count("*").alias("m")).filter("m > 1")
    return each.join(many, ["h1", "h2"]).select("anchor", "c1", "c2", F.col("number").alias("lo"),
                                                (F.col("number") + DEPTH).alias("hi"))


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """(did, t32, spans): for each text with repeated strings the byte ranges they cover (unmerged)."""
    every = written(runs(docs), "runs")
    kinds = every.groupBy("anchor", "c1", "c2").agg(
        F.count("*").alias("m"), F.min(F.struct("did", "t32", "lo", "n", "lead")).alias("r"))
    kinds = written(kinds.select("anchor", "c1", "c2", "m", "r.*"), "contents")
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    pieces = written(contents(docs, kinds.join(several, "anchor")), "bodies")
    hot = several.filter(F.col("kinds") > MOST_CONTENTS)
    found = sort_anchors(pieces.join(hot, "anchor", "left_anti"))
    if not hot.isEmpty():
        found = found.unionByName(deal_suffixes(pieces.join(hot, "anchor", "left_semi")))
    # A content that occurs twice is repeated as a whole; it was sorted as a partner of the others only.
    whole = kinds.filter("m > 1").select("anchor", "c1", "c2", F.lit(0).cast("long").alias("lo"),
                                         (F.col("n") + DEPTH - 1).cast("long").alias("hi"))
    found = whole.unionByName(found).withColumnsRenamed({"lo": "a", "hi": "z"})
    return written(every.join(found, ["anchor", "c1", "c2"]).groupBy("did", "t32").agg(
        F.collect_list(F.struct((F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("z")).alias("z")))
        .alias("spans")), "repeated-bytes")


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) of every row: the UTF-8 bytes of the text
    without those that a repeated 400-byte string covers, and the number of runs removed.

    A string is repeated if it starts anywhere else, same text included, overlaps too. Texts of
    fewer than 400 bytes stay whole; NULL is empty. A repeated row is another text.
    ``kept`` is binary: a cut may fall inside a character."""
    rows = keyed(docs, text, doc_id)
    spans = repeated_bytes(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in text_chunks(b.column(1)):
                lists = b.column(2).slice(i, j - i)
                flat = pa.RecordBatch.from_struct_array(lists.flatten())
                owner = np.repeat(np.arange(j - i), lists.value_lengths().fill_null(0).to_numpy())
                marks = np.zeros(len(data) + 1, dtype=np.int32)
                np.add.at(marks, offsets[owner] + flat.column("a").to_numpy(), 1)
                np.add.at(marks, offsets[owner] + flat.column("z").to_numpy(), -1)
                gone = np.cumsum(marks)[:-1] > 0
                text_of = np.repeat(np.arange(j - i), np.diff(offsets))
                start = gone.copy()
                start[1:] &= ~gone[:-1] | (text_of[1:] != text_of[:-1])
                removed = np.bincount(text_of[gone], minlength=j - i)
                ends = np.zeros(j - i + 1, dtype=np.int64)
                np.cumsum(np.diff(offsets) - removed, out=ends[1:])
                kept = pa.Array.from_buffers(pa.large_binary(), j - i,
                                             [None, pa.py_buffer(ends), pa.py_buffer(data[~gone])]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), kept, pa.array(np.diff(offsets)), pa.array(removed),
                     pa.array(np.bincount(text_of[start], minlength=j - i))],
                    ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return rows.join(spans, ["did", "t32"], "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def op8_suffix_radix(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
