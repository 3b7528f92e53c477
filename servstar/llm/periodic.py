"""Periodic runs of words by recursive frequency splitting.

A run of period q is at least three times as long as q, so each of its words occurs three times or more in
it, and in any segment that holds it. Words that occur too rarely in the current segment belong to no run and
split it; the parts are counted anew until none changes (or falls short of the least length). Most text is
gone by then.

The surviving segments are scanned lag by lag. A run of period q is a stretch of words that equal the word q
places on, at least max(least length - q, 2 q) of them, so it is enough to compare 8-word windows at places that far
apart (less 7): a segment of m words costs m log m comparisons, not m * m. Windows that agree are
extended to the whole stretch. Windows inside a known run whose period divides the lag tell nothing
new (two runs of different smallest periods p and q share fewer than p + q words) and are skipped, so the first lag that
finds a run is its smallest period.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar.llm.common import RollingHash, documents, text_chunks, word_spans

LEAST_LENGTH, LEAST_EXPONENT = 24, 3
#: Window comparisons of one segment held at once; bounds a task's working memory.
SAMPLES = 1 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
KIND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, " \
       "best struct<start:long,length:long,period:long>, collapsed string"


def frequent_segments(words: np.ndarray, owner: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """(begin, end) of the stretches of ``words`` of one owner (ascending), ``least`` long or
    longer, in which every word occurs ``times`` times or more."""
    at, segment, out = np.arange(len(words)), owner.astype(np.int64), []
    while len(at):
        key = words[at] ^ (segment.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.lexsort((key, segment))
        k, s = key[order], segment[order]
        first = np.ones(len(k), dtype=bool)
        first[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
        rare = np.empty(len(at), dtype=bool)
        rare[order] = np.diff(np.append(np.flatnonzero(first), len(k)))[np.cumsum(first) - 1] < times
        # parts of each segment between its rare words
        begin = ~rare
        begin[1:] &= rare[:-1] | (segment[1:] != segment[:-1])
        part = np.cumsum(begin)[~rare]
        at, old, whole = at[~rare], segment[~rare], np.flatnonzero(np.diff(segment, prepend=-1))
        if not len(at):
            break
        split = np.add.reduceat(rare, whole) > 0  # of each old segment: whether it lost a word
        changed = split[np.searchsorted(segment[whole], old)]
        cut = np.flatnonzero(np.diff(part, prepend=0))
        size = np.diff(np.append(cut, len(at)))
        for c in np.flatnonzero((size >= least) & ~changed[cut]):
            out.append((int(at[cut[c]]), int(at[cut[c]] + size[c])))
        again = np.repeat((size >= least) & changed[cut], size)
        at, segment = at[again], part[again]
    return sorted(out)


class LagScan:
    """Runs of one segment at a time."""

    def __init__(self, least: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT):
        self.least, self.exponent = least, exponent
        self.rolling = RollingHash(113)
        # The shortest stretch over all lags; half of it is the window.
        self.gram = max(1, min(self.stretch(q) for q in range(1, least + 1)) // 2)

    def stretch(self, lag):
        return np.maximum(self.least - lag, (self.exponent - 1) * lag)

    def hits(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(lag, places), lags ascending: sampled places whose window equals the one a lag on."""
        m = len(words)
        windows = self.rolling.windows(words, self.gram)
        lags = np.arange(1, m // self.exponent + 1)
        step = self.stretch(lags) - self.gram + 1
        n = -(-(len(windows) - lags) // step)
        total = np.concatenate([[0], np.cumsum(n)])
        i = 0
        while i < len(lags):
            j = max(i + 1, int(np.searchsorted(total, total[i] + SAMPLES, side="right")) - 1)
            lag = np.repeat(lags[i:j], n[i:j])
            place = (np.arange(len(lag)) - np.repeat(total[i:j] - total[i], n[i:j])) * np.repeat(step[i:j], n[i:j])
            same = np.flatnonzero(windows[place] == windows[place + lag])
            lag, place = lag[same], place[same]
            cut = np.flatnonzero(np.diff(lag, prepend=0))
            for a, z in zip(cut, np.append(cut[1:], len(lag))):
                yield int(lag[a]), place[a:z]
            i = j

    @staticmethod
    def extent(words: np.ndarray, lag: int, place: int) -> tuple[int, int]:
        """The stretch of words around ``place`` that equal the word ``lag`` on (empty: place, place)."""
        m, end, width = len(words) - lag, place, 32
        while end < m:
            width *= 2
            z = min(m, end + width)
            same = words[end:z] == words[end + lag:z + lag]
            if not same.all():
                end += int(same.argmin())
                break
            end = z
        begin, width = place, 32
        while begin > 0:
            width *= 2
            a = max(0, begin - width)
            same = (words[a:begin] == words[a + lag:begin + lag])[::-1]
            if not same.all():
                begin -= int(same.argmin())
                break
            begin = a
        return (begin, end) if end > place else (place, place)

    def runs(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs."""
        out: list[tuple[int, int, int]] = []
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # starts and ends by period
        for lag, places in self.hits(words):
            for period, (starts, ends) in known.items():
                if lag % period == 0 and len(places):
                    k = np.searchsorted(starts, places, side="right") - 1
                    inside = (k >= 0) & (places + lag + self.gram <= ends[np.maximum(k, 0)])
                    places = places[~inside]
            done, found = -1, []
            for place in places.tolist():
                if place < done:
                    continue
                begin, done = self.extent(words, lag, place)
                if done - begin >= self.stretch(lag):
                    found.append((begin, done + lag))
            if found:
                known[lag] = tuple(np.array(found).T)
                out += [(a, z - a, lag) for a, z in found]
        return out


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = LEAST_LENGTH,
                  least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """Of every row ``doc_id``, ``n_words``, ``runs`` (array of start, length and period, by start, then period), ``best``
    (the run of greatest length / period, ties by smallest start, then period; NULL without runs) and
    ``collapsed``: the words without those that lie in a run after its first period, joined by one space.

    Words are maximal stretches of other characters than space and U+0009 to U+000D. A run is a maximal stretch of words with
    smallest period q and ``max(least_length, least_exponent * q)`` words or more (``least_exponent``: 2 or more). NULL and empty texts have no words;
    repeated rows come out each, NULL ids stay NULL. Words are told apart by 64-bit hashes. Nothing is shuffled;
    a task holds about 2 MB of text, or one longer text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, hashes = LagScan(least_length, least_exponent), RollingHash(101)
        for b in batches:
            for i, j, data, offsets in text_chunks(b.column(1)):
                starts, ends, doc = word_spans(data, offsets)
                words = hashes.words(data, starts, ends)
                first = np.searchsorted(doc, np.arange(j - i + 1))
                runs: list[list] = [[] for _ in range(j - i)]
                dropped = np.zeros(len(words), dtype=bool)
                for a, z in frequent_segments(words, doc, least_length, least_exponent):
                    d = int(doc[a])
                    for s, n, q in scan.runs(words[a:z]):
                        runs[d].append((int(a + s - first[d]), n, q))
                        dropped[a + s + q:a + s + n] = True
                for found in runs:
                    found.sort(key=lambda r: (r[0], r[2]))
                best = [min(r, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if r else None for r in runs]
                as_run = lambda r: dict(zip(("start", "length", "period"), r))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(np.diff(first)),
                     pa.array([[as_run(r) for r in found] for found in runs], pa.list_(RUN)),
                     pa.array([r and as_run(r) for r in best], RUN), pa.array(joined(data, starts, ends, first, ~dropped), pa.string())],
                    ["doc_id", "n_words", "runs", "best", "collapsed"])

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`")).mapInArrow(run, KIND)


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, kept: np.ndarray) -> list[bytes]:
    """Each text's kept words with one space between."""
    size = ends[kept] - starts[kept]
    after = np.cumsum(size + 1)  # every word is followed by a space, which a text's last word loses below
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[starts[kept]] += 1
    edge[ends[kept]] -= 1
    out = np.full(int(after[-1]) if len(after) else 0, 32, dtype=np.uint8)
    letters = np.ones(len(out), dtype=bool)
    letters[after - 1] = False
    out[letters] = data[np.cumsum(edge[:-1]).astype(bool)]
    out, at = out.tobytes(), np.concatenate([[0], after])[np.concatenate([[0], np.cumsum(kept)])[first]].tolist()
    return [out[a:max(a, z - 1)] for a, z in zip(at[:-1], at[1:])]


def planted(doc_id, text):
    """The text of a tenth of the documents with a periodic end: with h the CRC-32 of the decimal id and g = h div 10,
    if h mod 10 = 0, the n words from number a = g mod n on repeat the first 1 + (n - a) div (3 + g mod 8) of themselves."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1).cast("int")
    block = F.slice(words, a + 1, p)
    end = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.concat_ws(" ", F.slice(words, F.lit(1), a), end)).otherwise(text)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = periodic_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
