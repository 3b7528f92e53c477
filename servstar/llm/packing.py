"""Packing documents into fixed windows by minimum bin slack.

Every task tokenises its documents, cuts whole windows off long ones and keeps a
bounded pool of the remaining lengths. A window takes the longest remaining piece, and
bitset subset-sum dynamic programming over the pool's lengths finds the multiset
that fills the rest closest to capacity; its counts are backtracked and the pattern
is used as often as the pool allows. If it leaves a gap, one more piece is cut to fill it
and the piece's rest goes back to the pool. Nothing is shuffled.
"""

from __future__ import annotations

import json
import os
import sys
import types
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar.llm.common import documents, text_chunks

CAPACITY = 2048
END_ID = 1
#: Pieces that a task holds at most (or fewer ids than a window); bounds its memory.
POOL = 8192
#: Words, and pieces of words, whose ids a Python worker remembers at most.
CACHE_WORDS = 300_000
#: Bytes of text that are tokenised at once.
TEXT_BYTES = 1 << 22
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
# What a tokenizer file of the kind that word_tokenizer takes apart says of itself.
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": WORD_PIECES}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def word_tokenizer(path: str) -> Callable[[list[str]], list[bytes]]:
    """Texts to ids (little-endian unsigned 32-bit) by the tokenizer file ``path``.

    The file's pre-tokenizer drops white space and no token spans it, so ids are those of the
    words one by one; a worker encodes the distinct words that it doesn't remember, a batch of texts at a time. Words of
    Latin letters, digits and signs skip the normaliser, which only lower-cases them, and go piece by piece to the tokenizer's
    BPE model; all others take the whole tokenizer. Texts with the control characters
    that Python, but not the tokenizer, takes for white space are encoded whole. So are all texts
    if the file names another normaliser or pre-tokenizer than these rules are made for."""
    import regex
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    # Kept for the tasks that follow in the same Python worker.
    worker = sys.modules.setdefault("_servstar_worker", types.ModuleType("_servstar_worker"))
    if path not in worker.__dict__:
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        by_words = rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == PRE_TOKENIZER
        worker.__dict__[path] = (Tokenizer.from_file(path), {}, {}, by_words)
    tokenizer, known, known_pieces, by_words = worker.__dict__[path]
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    bpe = tokenizer.model.tokenize
    pieces = regex.compile(WORD_PIECES).findall
    # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
    plain = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c]
    alphabet = {c: chr(c) for c in plain} | {c: chr(256 + k) for k, c in enumerate(sorted(set(range(256)) - set(plain)))}
    del alphabet[10]  # parts the pieces, which hold none

    def ids_of(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encode(texts, add_special_tokens=False)]

    if not by_words:
        return ids_of

    def cut(data: bytes, sizes: Iterable[int]) -> list[bytes]:
        at = [4 * k for k in accumulate(sizes, initial=0)]
        return [data[a:b] for a, b in zip(at, at[1:])]

    def ids_of_pieces(new: list[str]) -> list[bytes]:
        tokens = list(map(bpe, "\n".join(new).encode().decode("latin-1").translate(alphabet).split("\n") if new else []))
        return cut(np.array([t.id for ts in tokens for t in ts], dtype="<u4").tobytes(), map(len, tokens))

    def remember(cache: dict, found: Iterable[tuple[str, bytes]]) -> None:
        cache.update(islice(found, max(0, CACHE_WORDS - len(cache))))

    def latin(words: list[str]) -> list[bytes]:
        words = [w.lower() for w in words]
        parts = [pieces(w) for w in words if not w.isalpha()]
        every = set(chain.from_iterable(parts))
        every.update(filter(str.isalpha, words))
        table = {p: known_pieces.get(p) for p in every}
        new = [p for p, ids in table.items() if ids is None]
        table.update(zip(new, ids_of_pieces(new)))
        remember(known_pieces, ((p, table[p]) for p in new))
        part = iter(parts)
        return [table[w] if w.isalpha() else b"".join([table[p] for p in next(part)]) for w in words]

    def of_words(texts: list[str]) -> list[bytes]:
        """The distinct words are looked up or encoded once; Arrow parts the texts and puts the words' ids together."""
        split = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        got = list(map(known.get, distinct))
        new = [k for k, ids in enumerate(got) if ids is None]
        fresh, rest = [], []
        for k in new:
            w = distinct[k]
            (fresh if (w.isascii() or max(w) < "\u0250") and "<|" not in w else rest).append(k)
        for some, encoded in ((fresh, latin), (rest, ids_of)):
            for k, ids in zip(some, encoded([distinct[k] for k in some])):
                got[k] = ids
        remember(known, ((distinct[k], got[k]) for k in new))
        ids = pa.array(got, pa.large_binary()).take(words.indices)
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy())])[split.offsets.to_numpy()].tolist()
        data = b"" if ids.buffers()[2] is None else ids.buffers()[2].to_pybytes()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def tokenize(texts: list[str]) -> list[bytes]:
        whole = [any(c in t for c in "\x1c\x1d\x1e\x1f") for t in texts]
        out = of_words(["" if w else t for t, w in zip(texts, whole)])
        return [ids_of([t])[0] if w else x for t, w, x in zip(texts, whole, out)]

    return tokenize


def best_fill(counts: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(length, count) pairs of the multiset drawn from ``counts`` (by length)
    whose sum is the largest that is at most ``capacity``."""
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in np.flatnonzero(counts[:capacity + 1])[::-1].tolist():
        before, left, times = reach, min(int(counts[length]), capacity // length), 1
        while left > 0:
            times = min(times, left)
            reach |= reach << (length * times)
            left, times = left - times, times * 2
        reach &= mask
        steps.append((length, before))
        if reach >> capacity:
            break
    at, out = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        n = 0
        while not before >> at & 1:
            at, n = at - length, n + 1
        if n:
            out.append((length, n))
    return out


class Packer:
    """Windows from pieces; ``emit(sequence, offset, piece)`` gets every piece.
    A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, emit, capacity: int):
        self.emit, self.capacity = emit, capacity
        self.pool: dict[int, list] = defaultdict(list)
        self.counts = np.zeros(capacity, dtype=np.int64)
        self.held = self.tokens = self.sequences = 0

    def add(self, doc_id, ids: bytes) -> None:
        tokens, step = len(ids) // 4, self.capacity
        for start in range(0, tokens, step):
            piece = (doc_id, start, ids[4 * start:4 * (start + step)], tokens)
            if start + step <= tokens:
                self.window([piece])
            else:
                self.put(piece)

    def put(self, piece: tuple) -> None:
        length = len(piece[2]) // 4
        self.pool[length].append(piece)
        self.counts[length] += 1
        self.held += 1
        self.tokens += length

    def take(self, length: int) -> tuple:
        self.counts[length] -= 1
        self.held -= 1
        self.tokens -= length
        return self.pool[length].pop()

    def window(self, pieces: list) -> None:
        offset = 0
        for p in pieces:
            self.emit(self.sequences, offset, p)
            offset += len(p[2]) // 4
        self.sequences += 1

    def pack(self, keep: int) -> None:
        """Fill windows until ``keep`` pieces are left or all that are left don't fill one. Where none fill the
        longest piece's window exactly, they fill it as closely as they can and one more is cut to the gap."""
        while self.held > keep and self.tokens >= self.capacity:
            longest = int(np.flatnonzero(self.counts)[-1])
            self.counts[longest] -= 1
            fill = best_fill(self.counts, self.capacity - longest)
            self.counts[longest] += 1
            need = defaultdict(int, {longest: 1})
            for a, n in fill:
                need[a] += n
            gap = self.capacity - sum(a * n for a, n in need.items())
            for _ in range(1 if gap else min(len(self.pool[a]) // n for a, n in need.items())):
                row = [self.take(a) for a, n in need.items() for _ in range(n)]
                if gap:  # every piece left is longer than the gap, or it would be in the fill
                    doc_id, start, ids, tokens = self.take(int(np.flatnonzero(self.counts)[-1]))
                    row.append((doc_id, start, ids[:4 * gap], tokens))
                    self.put((doc_id, start + gap, ids[4 * gap:], tokens))
                self.window(row)

    def finish(self) -> None:
        """What is left, less than a window, is cut into powers of two, which need no padding."""
        self.pack(0)
        rest = [p for a in sorted(self.pool, reverse=True) for p in self.pool[a]]
        left = sum(len(p[2]) // 4 for p in rest)
        size = lambda n: 1 << (n.bit_length() - 1)
        room, row = size(left) if left else 0, []
        for doc_id, start, ids, tokens in rest:
            while ids:
                part = ids[:4 * room]
                row.append((doc_id, start, part, tokens))
                n = len(part) // 4
                ids, start, room, left = ids[len(part):], start + n, room - n, left - n
                if not room:
                    self.window(row)
                    row, room = [], size(left) if left else 0
        self.pool.clear()
        self.counts[:] = 0
        self.held = self.tokens = 0


def pack(docs: DataFrame, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id",
         capacity: int = CAPACITY, end_id: int = END_ID, pool: int = POOL) -> DataFrame:
    """One row per piece of a document: ``doc_id``, ``start`` and ``length`` in its
    ids, ``ids`` (binary: little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and
    ``offset`` there.

    Every document, empty and NULL texts included, ends with ``end_id``; repeated rows
    are packed each. All sequences have ``capacity`` ids, but for a few per task that are
    shorter powers of two (``capacity`` is one itself). ``sequence_id`` is the task's number
    times 2**40 plus the sequence's number there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize, rows = word_tokenizer(tokenizer_path), []
        base, end = TaskContext.get().partitionId() << 40, np.asarray([end_id], dtype="<u4").tobytes()
        packer = Packer(lambda s, o, p: rows.append(
            (p[0], p[1], len(p[2]) // 4, p[2], p[3], base + s, o)), capacity)

        def taken() -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             [x.split()[0] for x in SCHEMA.split(", ")])
            rows.clear()
            return out

        for b in batches:
            for i, j, *_ in text_chunks(b.column(1), TEXT_BYTES):
                part = b.slice(i, j - i)
                texts = part.column(1).fill_null("").to_pylist()
                for d, ids in zip(part.column(0).to_pylist(), tokenize(texts)):
                    packer.add(d, ids + end)
                    if packer.held >= pool:
                        packer.pack(pool // 2)
                    if len(rows) >= 2000:
                        yield taken()
        packer.finish()
        yield taken()

    return docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")).mapInArrow(run, SCHEMA)


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return digest(pack(documents(spark, sf_dir), tokenizer_file()))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
