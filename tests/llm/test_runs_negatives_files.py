"""Periodic runs, hard negatives and token files against plain versions, on the smallest tables and on odd rows."""

from __future__ import annotations

import io
import os
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
from test_llm import SF, WIDE, odd_rows  # noqa: E402


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(odd_rows(), WIDE).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], WIDE)


def result(spark, name):
    from servstar.llm.registry import QUERIES
    return QUERIES[name](spark, SF).collect()


# -- 11 -------------------------------------------------------------------------------------------

def test_periodic_runs_match_brute_force(spark, texts):
    got = {r[0]: tuple(r)[1:] for r in result(spark, "op11_periodic_runs")}
    assert got == {i: brute.periodic_row(brute.planted(i, t)) for i, t in texts.items()}
    assert sum(r[0] > 0 for r in got.values()) > 10


def test_periodic_runs_of_random_words():
    from servstar.llm.periodic import LagScan, frequent_segments
    r, scan = random.Random(5), LagScan()
    for _ in range(1500):
        v, w = r.choice([1, 2, 3, 5, 40]), []
        while len(w) < r.choice([30, 80, 200]):
            w += ([r.randrange(v) for _ in range(r.choice([1, 1, 2, 3, 5, 8, 9, 20]))] * r.randrange(1, 14))[:r.randrange(1, 150)]
            w += [1000 + r.randrange(5)] * (r.random() < .3)
        words = np.array(w, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        got = [(a + s, n, q) for a, z in frequent_segments(words, np.zeros(len(w), dtype=np.int64), 24, 3)
               for s, n, q in scan.runs(words[a:z])]
        assert sorted(got, key=lambda x: (x[0], x[2])) == brute.periodic(w), w


@pytest.mark.parametrize("least, exponent", [(24, 3), (6, 2), (50, 5)])
def test_periodic_runs_odd_rows(spark, odd_docs, none, least, exponent):
    from servstar.llm.periodic import periodic_runs
    r = random.Random(2)
    more = ["x " + "a b c " * 40 + "y " + "a b c " * 40, "z " * 23, "z " * 24, "a b a a b " * 300 + "é é" * 2,
            " ".join(r.choice("ab") for _ in range(3000)), ("p q\tr\ns " * 9 + "\x1c \xa0 ") * 7]
    texts = [(i, t) for i, t, *_ in odd_rows() if len(t or "") < 100_000] + [(None, t) for t in more] + [(9, t) for t in more]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = periodic_runs(df, least_length=least, least_exponent=exponent).collect()
    want = Counter()
    for i, t in texts:
        w = brute.words(t)
        runs = brute.periodic(w, least, exponent)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want[i, len(w), str(runs), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    assert Counter((r.doc_id, r.n_words, str([tuple(x) for x in r.runs]), r.collapsed) for r in got) == want
    assert periodic_runs(none).collect() == []
    full = periodic_runs(odd_docs).collect()
    assert Counter((r.doc_id, r.n_words) for r in full) == Counter((i, len(brute.words(t))) for i, t, *_ in odd_rows())


def test_periodic_runs_of_a_very_long_text(spark):
    from servstar.llm.periodic import periodic_runs
    n = 200_000
    text = " ".join(["w%d" % (k % 5000) for k in range(n)] + ["end"] + ["again"] * 300)
    r = periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r.runs] == [(0, n, 5000), (n + 1, 300, 1)]
    assert tuple(r.best) == (n + 1, 300, 1) and len(r.collapsed.split()) == 5002


# -- 12 -------------------------------------------------------------------------------------------

def test_hard_negatives_match_sql(spark):
    import oracle_check
    assert oracle_check.compare(spark, "/root/testdata/sf0.01", ["op12_hard_negatives"], verbose=False) == []


def odd_vectors():
    r = np.random.default_rng(4)
    centre = r.normal(size=(6, 12))
    rows = [(k, (centre[k % 6] + r.normal(size=12) * 0.4).round(2).tolist(), int(r.integers(3))) for k in range(300)]
    rows += [(k, [0.5] * 12, k % 4) for k in range(300, 500)]  # a third of the rows alike
    rows += [(k, r.normal(size=5).round(1).tolist(), k % 2) for k in range(500, 560)]  # other dimensions
    rows += [(600, None, 1), (601, [], 1), (602, [1.0, None] * 6, 1), (603, [float("nan")] * 12, 1), (604, [float("inf")] * 12, 1),
             (605, [1.0] * 12, None), (610, [0.0] * 12, 1), (611, [0.0] * 12, 2), (620, [1e300] * 12, 1), (625, [3e5] * 12, 1),
             (626, [3e5] * 12, 1), (627, [2e5] * 12, 2), (630, [-1.0] * 12, 0)]
    rows += [(None, [0.5] * 12, 1), (None, (centre[1] + 0.1).tolist(), 0), rows[20], rows[20], rows[21]]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_odd_rows(spark, monkeypatch, small):
    from pyspark.sql import functions as F

    from servstar.llm import hard_negatives as h
    if small:  # heads, shards, chunks and clusters of a few rows
        for name, value in (("HEAD", 10), ("SHARD_ROWS", 40), ("MEMBERS", 4), ("CLUSTER_ANCHORS", 8), ("SAMPLE", 30),
                            ("SHARD_BYTES", 1000)):
            monkeypatch.setattr(h, name, value)
    df = spark.createDataFrame([(*r, 1, "x") for r in odd_vectors()], "vec_id long, embedding array<double>, label int, rid long, norm string")
    got = h.hard_negatives(df, F.col("vec_id") % 5 == 0).collect()
    want = brute.hard_negatives(odd_vectors(), lambda i: i % 5 == 0)
    assert len(want) > 500
    assert Counter(map(tuple, got)) == Counter(want)


def test_hard_negatives_of_no_rows(spark):
    from pyspark.sql import functions as F

    from servstar.llm.hard_negatives import hard_negatives
    kind = "vec_id long, embedding array<float>, label int"
    assert hard_negatives(spark.createDataFrame([], kind), F.col("vec_id") % 5 == 0).collect() == []
    assert hard_negatives(spark.createDataFrame([(1, [1.0], 1)], kind), F.col("vec_id") % 5 == 0).collect() == []


# -- 13 -------------------------------------------------------------------------------------------

def rows_in_order(rows):
    """(doc_id, ids) in the files' order, as the plain version has them, but for ties."""
    return sorted(((i, brute.token_ids(t)) for i, t, *_ in rows), key=lambda r: (r[0] is None, r[0] or 0))


def test_token_files_match_the_tokenizer(spark, texts):
    got, at = sorted(result(spark, "op13_token_frames")), 0
    assert len(got) == len(texts)
    for r, (i, ids) in zip(got, rows_in_order(texts.items())):
        assert tuple(r) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_odd_rows(spark, odd_docs, none):
    from servstar.llm.packing import tokenizer_file
    from servstar.llm.token_files import read_token_files, write_token_files
    manifest = write_token_files(odd_docs, tokenizer_file(), file_bytes=500)
    rows = read_token_files(manifest).collect()
    want = rows_in_order(odd_rows())
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == Counter((i, x.tobytes()) for i, x in want)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [i for i, _ in want]
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])])[:-1].tolist()
    files = manifest.collect()
    assert len(files) > 3 and sum(f.docs for f in files) == len(rows) and all(os.path.getsize(f.file.removeprefix("file:")) == f.bytes for f in files)
    some = read_token_files(manifest, [7, 100, 5, 12345]).collect()
    assert Counter((r.doc_id, r.start) for r in some) == Counter((r.doc_id, r.start) for r in rows if r.doc_id in (5, 7, 100))
    assert read_token_files(manifest, []).collect() == []
    assert read_token_files(write_token_files(none, tokenizer_file())).collect() == []


class Counted(io.BytesIO):
    def __init__(self, data):
        super().__init__(data)
        self.taken = 0

    def size(self):
        return len(self.getvalue())

    def read(self, n=-1):
        self.taken += n
        return super().read(n)


def test_frames_are_read_alone_and_checked():
    import zstandard

    from servstar.llm.token_files import FrameReader, FrameWriter
    out, r = io.BytesIO(), np.random.default_rng(1)
    out.close, writer = lambda: None, FrameWriter(out)
    ids = [r.integers(0, 50000, size=n, dtype="<u4").tobytes() for n in (5000, 1, 0, 9000, 30)]
    for k, x in enumerate(ids):
        writer.add(None if k == 1 else 10 * k, x)
    writer.close()
    data = out.getvalue()
    assert len(data) == writer.bytes
    # any zstandard reader passes over the two skippable frames
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(ids)
    file = Counted(data)
    reader = FrameReader(file)
    assert reader.known.tolist() == [True, False, True, True, True] and reader.doc_ids[reader.known].tolist() == [0, 20, 30, 40]
    assert file.taken < 200
    before = file.taken
    assert list(reader.read(np.array([1, 2, 4]))) == [(1, ids[1]), (2, ids[2]), (4, ids[4])]
    assert file.taken - before < 300  # neither of the long frames
    spoilt = bytearray(data)
    spoilt[reader.at[3] + 40] ^= 1
    reader = FrameReader(Counted(bytes(spoilt)))
    assert list(reader.read(np.array([0]))) == [(0, ids[0])]
    with pytest.raises(Exception):
        list(reader.read(np.array([3])))
    for bad in (data[:-1], data[:8], data[5000:]):
        with pytest.raises(ValueError):
            FrameReader(Counted(bad))
    wrong = bytearray(data)
    wrong[-9 - 12 * 5 + 8] ^= 1  # the first frame's checksum in the seek table
    with pytest.raises(ValueError):
        list(FrameReader(Counted(bytes(wrong))).read(np.array([0])))


def test_words_of_another_tokenizer_file():
    """A file with other rules is encoded whole."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from servstar.llm.packing import word_tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    some = ["two  spaces", "Case and\nlines", "中文 é"]
    t = Tokenizer.from_file(path)
    assert word_tokenizer(path)(some) == [np.array(t.encode(x, add_special_tokens=False).ids, dtype="<u4").tobytes() for x in some]


class CountedTokenizer:
    """A tokenizer that counts the pieces its model gets."""

    def __init__(self, tokenizer):
        self.tokenizer, self.pieces = tokenizer, Counter()
        self.model, self.encode_batch_fast, self.encode_batch = self, tokenizer.encode_batch_fast, tokenizer.encode_batch

    def tokenize(self, piece):
        self.pieces[piece] += 1
        return self.tokenizer.model.tokenize(piece)


@pytest.mark.parametrize("most", [0, 50, 300_000])
def test_pieces_are_encoded_once_whatever_is_remembered(monkeypatch, most):
    """Words that no worker remembers share the encoding of their pieces, and the caches keep to their size."""
    import sys

    from servstar.llm import packing
    monkeypatch.setattr(packing, "CACHE_WORDS", most)
    monkeypatch.delitem(sys.modules, "_servstar_worker", raising=False)
    path = packing.tokenizer_file()
    packing.word_tokenizer(path)
    worker = sys.modules["_servstar_worker"].__dict__
    counted = CountedTokenizer(worker[path][0])
    worker[path] = (counted, *worker[path][1:])
    some = [" ".join(f"Common{chr(97 + k % 26)}{chr(97 + j)}rare-{k}" for k in range(40)) for j in range(20)] + [
        "", " \t ", "it's IT'S \u4e2d\u6587 caf\u00e9, <|endoftext|>x a\x1cb \u0130 \u03a3\u03c2", "\x85a\xa0b\u3000c"]
    for _ in range(2):
        for t, ids in zip(some, packing.word_tokenizer(path)(some), strict=True):
            assert ids == brute.token_ids(t)[:-1].tobytes(), t
        assert all(len(cache) <= most for cache in worker[path][1:3])
    assert len(counted.pieces) > 500 and max(counted.pieces.values()) <= 2
    assert packing.word_tokenizer(path)([]) == []
    del sys.modules["_servstar_worker"]
