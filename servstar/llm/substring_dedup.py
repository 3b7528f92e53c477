"""Substring deduplication with difference-cover anchors.

A window of 20 words that occurs twice is found without hashing every window. The
set {0, 1, 3, 9} covers all differences modulo 13: for two occurrences starting at i and j
some shift below 13 puts both i + shift and j + shift on cover positions. The 8 words there
lie inside both windows, so the two occurrences share an anchor, and hashing 8
words at cover positions only (4 of 13) misses no match. A repeated anchor then extends to the 13
windows around it, and only those are compared as whole windows (128-bit hashes).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servstar.llm.common import RollingHash, documents, keyed, mixed, text_chunks, word_spans, written

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)


def _places(doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each word's number in its text, and the texts' word counts."""
    words = np.bincount(doc, minlength=n)
    first = np.cumsum(words) - words
    return np.arange(len(doc)) - first[doc], words


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """(key, did, at, n): n is 1 for an anchor that its chunk of texts has once, 2 for the first
    of several, 0 for the others. Those are repeated for certain, so they
    get a key of their own and a frequent anchor isn't gathered in one task."""
    size = window - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash(21)
        cover = np.zeros(PERIOD, dtype=bool)
        cover[list(COVER)] = True
        for b in batches:
            ids = b.column(0).to_numpy()
            for i, j, data, offsets in text_chunks(b.column(1)):
                starts, ends, doc = word_spans(data, offsets)
                at, words = _places(doc, j - i)
                h = rolling.windows(rolling.words(data, starts, ends), size)
                on = np.flatnonzero((cover[at % PERIOD] & (at + size <= words[doc]) & (words[doc] >= window))[:len(h)])
                h = h[on]
                _, first, group, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                count = np.minimum(n[group], 2).astype(np.int8)
                other = np.ones(len(h), dtype=bool)
                other[first] = False
                count[other] = 0
                did = ids[i:j][doc[on]]
                key = np.where(other, mixed(h + on.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(did), pa.array(at[on].astype(np.int32)), pa.array(count)],
                    ["key", "did", "at", "n"])

    return docs.select("did", "text").mapInArrow(run, "key long, did long, at int, n byte")


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """(w1, w2, did, t32, at, known) of the windows around repeated anchors. ``known`` marks
    those that occur earlier in the same chunk of texts; they are spread by a key of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = RollingHash(31), RollingHash(41)
        for b in batches:
            ids, t32 = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, j, data, offsets in text_chunks(b.column(2)):
                starts, ends, doc = word_spans(data, offsets)
                at, words = _places(doc, j - i)
                lists = b.column(3).slice(i, j - i)
                anchors = lists.flatten().to_numpy()
                owner = np.repeat(np.arange(j - i), lists.value_lengths().fill_null(0).to_numpy())
                first = np.cumsum(words) - words
                ok = anchors < words[owner]  # a row that shares only its id with the anchor's text
                anchors, owner = anchors[ok], owner[ok]
                low = np.maximum(anchors - PERIOD + 1, 0)
                high = np.minimum(anchors, words[owner] - window) + 1
                ok = low < high
                marks = np.zeros(len(doc) + 1, dtype=np.int64)
                np.add.at(marks, first[owner[ok]] + low[ok], 1)
                np.add.at(marks, first[owner[ok]] + high[ok], -1)
                on = np.flatnonzero(np.cumsum(marks)[:-1] > 0)
                w1 = one.windows(one.words(data, starts, ends), window)[on]
                w2 = two.windows(two.words(data, starts, ends), window)[on]
                did, t, place = ids[i:j][doc[on]], t32[i:j][doc[on]], at[on]
                order = np.lexsort((place, t, did, w2, w1))
                same = np.zeros(len(on), dtype=bool)
                a, c = order[1:], order[:-1]
                same[1:] = (w1[a] == w1[c]) & (w2[a] == w2[c])
                lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(on))))  # first of each group
                head = order[lead]
                late = same & ~((did[order] == did[head]) & (t[order] == t[head]) & (place[order] == place[head]))
                known = np.zeros(len(on), dtype=bool)
                known[order] = late
                spread = on.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                w1 = np.where(known, mixed(w1 + spread), w1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(did), pa.array(t),
                     pa.array(place.astype(np.int32)), pa.array(known)], ["w1", "w2", "did", "t32", "at", "known"])

    return rows.mapInArrow(run, "w1 long, w2 long, did long, t32 int, at int, known boolean")


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(did, t32, starts): starts of the windows of a text (by number of word) that occur earlier,
    in a text with a smaller id or before in the same text."""
    anchors = _anchors(docs, window)
    total = F.sum("n").over(Window.partitionBy("key"))
    found = written(anchors.withColumn("total", total).filter("n = 0 or total >= 2")
                    .groupBy("did").agg(F.collect_list("at").alias("anchors")), "anchors")
    rows = docs.join(found, "did").select("did", "t32", "text", "anchors")
    rank = F.dense_rank().over(Window.partitionBy("w1", "w2").orderBy("did", "t32", "at"))
    return written(_windows(rows, window).withColumn("rank", rank).filter("known or rank > 1")
                   .groupBy("did", "t32").agg(F.collect_list("at").alias("starts")), "repeated-windows")


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """(doc_id, text, n_words, n_removed) of every row: the text without the words that a
    repeated window covers, joined by one space.

    A window is removed where its words also start earlier: in a smaller id (NULL ids last) or
    before in the same text. Windows are judged on the input. Texts of
    fewer than ``window`` words stay whole; NULL is empty; a repeated row (same id, same text)
    is one document given twice, and its copies get the same result."""
    rows = keyed(docs, text, doc_id)
    repeats = repeated_windows(rows, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in text_chunks(b.column(1)):
                starts, ends, doc = word_spans(data, offsets)
                _, words = _places(doc, j - i)
                first = np.cumsum(words) - words
                lists = b.column(2).slice(i, j - i)
                at = lists.flatten().to_numpy()
                owner = np.repeat(np.arange(j - i), lists.value_lengths().fill_null(0).to_numpy())
                marks = np.zeros(len(doc) + 1, dtype=np.int64)
                np.add.at(marks, first[owner] + at, 1)
                np.add.at(marks, first[owner] + at + window, -1)
                gone = np.cumsum(marks)[:-1] > 0
                kept = _joined(data, starts[~gone], ends[~gone], doc[~gone], j - i)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), kept, pa.array(words),
                     pa.array(np.bincount(doc[gone], minlength=j - i))], ["doc_id", "text", "n_words", "n_removed"])

    return rows.join(repeats, ["did", "t32"], "left").select("doc_id", "text", "starts") \
        .mapInArrow(run, "doc_id long, text string, n_words long, n_removed long")


def _joined(data: np.ndarray, starts, ends, doc, n: int) -> pa.Array:
    """The given words of each text with one space between."""
    size = ends - starts
    last = np.ones(len(doc), dtype=bool)
    last[:-1] = doc[1:] != doc[:-1]
    begin = np.cumsum(size + ~last) - size - ~last
    out = np.full(int(size.sum() + (~last).sum()), 32, dtype=np.uint8)
    spread = np.zeros(len(data) + 1, dtype=np.int8)
    spread[starts] += 1
    spread[ends] -= 1
    letters = np.ones(len(out), dtype=bool)
    letters[(begin + size)[~last]] = False
    out[letters] = data[np.cumsum(spread[:-1]).astype(bool)]
    offsets = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(np.bincount(doc, weights=size + ~last, minlength=n), out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


def op9_difference_cover(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, CAST(len(w) AS BIGINT) - 18)) AS i FROM d WHERE len(w) >= 20),
h AS (SELECT p.doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM p JOIN d USING (doc_id)),
r AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM h) x WHERE k > 1),
c AS (SELECT DISTINCT doc_id, i + o AS i FROM r, (SELECT unnest(range(0, 20)) AS o) x),
a AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, CAST(len(w) AS BIGINT) + 1)) AS i FROM d),
k AS (SELECT a.doc_id, string_agg(word, ' ' ORDER BY a.i) AS kept, count(*) AS n
      FROM a LEFT JOIN c ON a.doc_id = c.doc_id AND a.i = c.i WHERE c.i IS NULL GROUP BY a.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) AS BIGINT) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""
