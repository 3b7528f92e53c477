"""The training-data operators against SQL or brute force on the smallest tables, and on hand-made
rows with NULLs, empty and long texts, repeated rows and clashing column names."""

from __future__ import annotations

import os
import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

SF = "/root/testdata/sf0.001"
WIDE = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, size string, "
        "score string, shard string, target string, copies string, text_sha256 string, node long, h string")


@pytest.fixture(scope="module")
def given(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    return {r.doc_id: r for r in rows}


@pytest.fixture(scope="module")
def texts(given):
    return {i: r.text for i, r in given.items()}


def result(spark, name, sf=SF):
    from servstar.llm.registry import QUERIES
    return {r[0]: r for r in QUERIES[name](spark, sf).collect()}


def odd_rows():
    r = random.Random(1)
    vocabulary = ["w%d" % k for k in range(5000)]
    passage = " ".join(r.choice(vocabulary) for _ in range(120))
    long = " ".join(r.choice(vocabulary) for _ in range(60_000))
    texts = [None, "", " \t\n", "one", "a b  c\td", "a b c d", passage, "x " + passage + " y", long, long + " end",
             "aa " * 500, "é" * 900, "token = AKIA" + "A" * 30, "password: short1 secret=ab", "0" * 100 + " " + "f" * 23,
             "中文 𝄞 " * 150, "\x1c\x1d odd \x85 space \xa0 " * 3]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(100, passage), (100, passage), (None, passage), (None, None), (7, "x " + passage + " y")]
    return [(i, t, None if k % 4 == 0 else "en", None if k % 3 == 0 else f"s{k % 5}", k, True, "s", "s", "s", "s", "s", "s", 1, "h")
            for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Odd rows as a table, and its distinct (doc_id, text) rows with an id."""
    path = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(odd_rows(), WIDE).repartition(3).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], WIDE).write.parquet(f"{path}/none.parquet")
    return path


@pytest.fixture(scope="module")
def odd_docs(spark, odd):
    return spark.read.parquet(f"{odd}/documents.parquet")


@pytest.fixture(scope="module")
def none(spark, odd):
    return spark.read.parquet(f"{odd}/none.parquet")


@pytest.mark.parametrize("name", ["op2_lattice", "op5_mixing", "op9_difference_cover", "op10_exact_dedup"])
def test_matches_sql(spark, name):
    import oracle_check
    assert oracle_check.compare(spark, SF, [name], verbose=False) == []


# -- 1 --------------------------------------------------------------------------------------------

def test_simhash_matches_brute_force(spark, texts):
    got = {i: (r.fingerprint, r.component_id) for i, r in result(spark, "op1_simhash").items()}
    assert got == brute.near(texts)


def test_rows_without_or_with_shared_ids_carry_links(spark):
    """Documents joined only through rows without an id are one group; one row of a group is kept, whatever its id."""
    import corpus_pipeline
    from servstar.llm.simhash import near_duplicates, links  # noqa: F401
    r = random.Random(8)
    words = ["w%d" % k for k in range(3000)]

    def close(text):  # a text two bits or more, but at most the radius, away
        while True:
            w = text.split()
            w[r.randrange(len(w))] = r.choice(words)
            n = (brute.fingerprint(" ".join(w)) ^ brute.fingerprint(text)).bit_count()
            if 2 < n <= 4:
                return " ".join(w)

    while True:
        a = " ".join(r.choice(words) for _ in range(300))
        b = close(a)
        c = close(b)
        if (brute.fingerprint(a) ^ brute.fingerprint(c)).bit_count() > 4:
            break
    other = " ".join(r.choice(words) for _ in range(300))
    rows = [(1, a), (None, b), (3, c), (3, other), (None, "alone and without id " * 3), (None, "alone and without id " * 3)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {(x.doc_id, x.text_hash): x for x in near_duplicates(df).collect()}
    at = {t: x for (i, t), x in zip(rows, df.selectExpr("xxhash64(text) as h").collect())}
    assert [got[i, at[t].h].component_id for i, t in rows] == [1, 1, 1, 3, None, None]
    kept = corpus_pipeline.near(spark, df, SF).collect()
    assert Counter((x.doc_id, x.text) for x in kept) == Counter([(1, a), (3, other), rows[4], rows[5]])


def test_simhash_odd_rows(odd_docs, none):
    from servstar.llm.simhash import near_duplicates
    rows = near_duplicates(odd_docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows())
    docs = {r[0]: r[1] for r in odd_rows() if r[0] is not None}
    want = brute.near(docs)
    for r in rows:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == want[r.doc_id]
    assert {r.fingerprint for r in rows if r.doc_id in (0, 1, 2)} == {"0" * 16}
    # A NULL id takes the component of the rows with its fingerprint.
    assert {r.component_id for r in rows if r.doc_id is None} == {0, 6}
    assert near_duplicates(none).collect() == []


@pytest.mark.parametrize("radius, cell_rows, batch", [(4, 1 << 16, 10000), (6, 1 << 16, 10000), (4, 20, 10000), (4, 3, 7), (6, 40, 50)])
def test_pivot_tables_lose_no_link(spark, radius, cell_rows, batch):
    """Also with cells too large for a task, which are dealt anew, and with cells cut by batches."""
    from servstar.llm.common import components
    from servstar.llm.simhash import links
    r = random.Random(radius)
    fps = {r.getrandbits(64) for _ in range(150)}
    for f in list(fps):
        for _ in range(3):
            fps.add(f ^ sum(1 << b for b in r.sample(range(64), r.randrange(1, radius + 2))))
    dense = r.getrandbits(64)  # one group of near copies
    fps |= {dense ^ sum(1 << b for b in r.sample(range(64), 2)) for _ in range(300)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, k) for k, f in enumerate(fps)], "fp long, node long")
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, str(batch))
    try:
        got = {x.node: x.component for x in components(links(df, radius, cell_rows)).collect()}
    finally:
        spark.conf.set(size, before)
    a = np.array(fps, dtype=np.uint64)
    pairs = [(i, int(j)) for i in range(len(a)) for j in i + 1 + np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1:]) <= radius)]
    want = brute.components(range(len(fps)), pairs)
    assert {k: got.get(k, k) for k in want} == want


def test_components_of_long_paths_and_hubs(spark):
    from servstar.llm.common import components
    edges = [(k, k + 1) for k in range(0, 30)] + [(1000, k) for k in range(1001, 1200)] + [(5000, 4000), (4000, 4500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: v for k, v in brute.components({n for e in edges for n in e}, edges).items()}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


# -- 2 --------------------------------------------------------------------------------------------

def test_lattice_decodes_to_the_nearest_point():
    from servstar.llm.lattice import _short_vectors, nearest_e8
    x = np.random.default_rng(0).normal(size=(300, 8)) * 3
    p = nearest_e8(x)
    near = p[:, None] + np.concatenate([np.zeros((1, 8)), _short_vectors()])
    assert (((x[:, None] - near) ** 2).sum(axis=2).argmin(axis=1) == 0).all()
    assert np.allclose(p * 2, np.rint(p * 2)) and (p.sum(axis=1) % 2 == 0).all()


def test_lattice_links_and_odd_vectors(spark):
    """A dense group, pairs around the threshold, copies, and vectors that link with nothing."""
    from servstar.llm.lattice import embedding_duplicates
    g = np.random.default_rng(1)
    base = g.normal(size=(40, 32))
    x = [base[k] + g.normal(size=32) * s for k in range(40) for s in (0, 0.05, 0.15, 0.3)]
    x += [base[0] + g.normal(size=32) * 0.02 for _ in range(200)] + [base[1] * 2, base[1] * 2, -base[2]]
    x = [[float(np.float32(v)) for v in row] for row in x]
    bad = [None, [0.0] * 32, [float("nan")] * 32, [None] * 32, [float("inf")] + [1.0] * 31, [], [1.0, 2.0]]
    rows = list(enumerate(x + bad))
    got = {r.vec_id: r for r in embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    a = np.array(x)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    hit = a @ a.T >= 0.95
    np.fill_diagonal(hit, False)
    want = brute.components(range(len(rows)), [tuple(map(int, p)) for p in np.argwhere(hit)])
    found = sum(r.n_links for r in got.values())
    assert found >= 0.99 * hit.sum() and all(got[k].n_links <= hit[k].sum() for k in range(len(x)))
    same = [k for k in range(len(x)) if got[k].n_links == hit[k].sum()]
    assert len(same) >= 0.98 * len(x)
    assert sum(got[k].component_id == want[k] for k in range(len(rows))) >= 0.98 * len(rows)
    for k in range(len(x), len(rows)):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert embedding_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_lattice_links_within_each_length_and_rows_without_ids(spark):
    from servstar.llm.lattice import embedding_duplicates
    g = np.random.default_rng(3)
    a, b = g.normal(size=64), g.normal(size=32)
    rows = [(k, (a * (1 + k)).tolist()) for k in range(20)] + [(100 + k, (b * (k + 1)).tolist()) for k in range(4)]
    # 200 and 202 link with a row without id only; two different vectors under one id
    e = g.normal(size=64)
    e -= a * (a @ e) / (a @ a)
    turn = lambda deg: (a / np.linalg.norm(a) * np.cos(np.radians(deg)) + e / np.linalg.norm(e) * np.sin(np.radians(deg))).tolist()
    rows += [(200, turn(90)), (None, turn(104)), (202, turn(118)), (300, [1.0, 0.0]), (300, [0.0, 1.0]), (301, [2.0, 0.1]), (None, [-1.0, -5.0])]
    got = Counter(map(tuple, embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    want = Counter((k, 19, 0, k == 0) for k in range(20)) + Counter((100 + k, 3, 100, k == 0) for k in range(4))
    want += Counter([(200, 1, 200, True), (None, 2, 200, False), (202, 1, 200, False), (300, 1, 300, True), (300, 0, 300, True),
                     (301, 1, 300, False), (None, 0, None, False)])
    assert got == want


@pytest.mark.parametrize("dims", [8, 12, 16, 24, 32, 64, 128, 384, 768])
def test_lattice_recall_at_the_threshold(dims):
    """Pairs at a cosine of exactly 0.95 meet in a cell in 95 of 100 cases or more."""
    from servstar.llm.lattice import PROBES, TABLES, THRESHOLD, Lattice, unit
    g = np.random.default_rng(dims)
    x, e = unit(g.normal(size=(1000, dims))), g.normal(size=(1000, dims))
    e = unit(e - x * (x * e).sum(axis=1, keepdims=True))
    y = 0.95 * x + np.sqrt(1 - 0.95 ** 2) * e
    lattice = Lattice(dims, TABLES, PROBES, THRESHOLD)
    p, q = lattice.cells(x), lattice.cells(y)
    met = ((p == q[:, :, :1]).any(axis=2) | (q == p[:, :, :1]).any(axis=2)).any(axis=1)
    assert met.mean() >= 0.95, met.mean()


def test_dense_cell_of_long_vectors_in_bounded_memory():
    """4096 near-equal vectors of 768 dimensions compared in one cell take less than 300 MB beside the vectors."""
    import tracemalloc

    from servstar.llm.lattice import PROBES, TABLES, THRESHOLD, Lattice, _spanning, cell_links, unit
    g = np.random.default_rng(1)
    x = unit(g.normal(size=768) + g.normal(size=(4096, 768)) * 0.01)
    lattice, at = Lattice(768, TABLES, PROBES, THRESHOLD), np.arange(4096)
    tracemalloc.start()
    label, seen = np.arange(4096), 0
    for p, q in cell_links(x, at, 0, at, at, lattice, THRESHOLD):
        assert len(p) <= 1 << 16
        _spanning(label, p, q)
        seen += len(p)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen > 4096 and peak < 300 << 20, peak


@pytest.mark.parametrize("cell_rows, home_rows", [(16, 1 << 14), (16, 50), (7, 7)])
def test_large_cells_are_dealt_out(spark, monkeypatch, cell_rows, home_rows):
    from servstar.llm import lattice
    monkeypatch.setattr(lattice, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(lattice, "HOME_ROWS", home_rows)
    g = np.random.default_rng(2)
    v = g.normal(size=16)
    rows = [(k, (v + g.normal(size=16) * 0.01).tolist()) for k in range(150)]
    got = lattice.embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(149, 0)}


# -- 3 --------------------------------------------------------------------------------------------

def check_pieces(rows, ids: list):
    """Every id lies in one piece, sequences are gapless and full."""
    of, sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
        sequence[r.sequence_id].append(r)
    for s in sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048 and at & (at - 1) == 0
    want = Counter()
    for i, x in ids:
        want[i, len(x)] += len(x)
    got = Counter()
    for r in rows:
        got[r.doc_id, r.doc_tokens] += r.length
    assert got == want
    return of


def test_packing_round_trip(spark, texts):
    from servstar.llm.packing import pack, tokenizer_file
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {i: brute.token_ids(t) for i, t in texts.items()}
    of = check_pieces(pack(docs, tokenizer_file()).collect(), list(ids.items()))
    for i, rows in of.items():
        assert b"".join(bytes(r.ids) for r in sorted(rows, key=lambda r: r.start)) == ids[i].tobytes()
    from servstar.llm.registry import QUERIES
    for r in QUERIES["op3_packing"](spark, SF).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())


def test_packing_odd_rows(odd_docs, none):
    from servstar.llm.packing import pack, tokenizer_file
    check_pieces(pack(odd_docs, tokenizer_file()).collect(), [(r[0], brute.token_ids(r[1])) for r in odd_rows()])
    assert pack(none, tokenizer_file()).collect() == []


@pytest.mark.parametrize("lengths, most", [([2043] + [50 + k % 350 for k in range(3000)], 20), ([50 + k * 37 % 1990 for k in range(3000)], 600),
                                           ([2047] * 50, 49 + 10), ([300] * 100, 18), ([2043] * 3 + [9] * 10, 9)])
def test_packing_goes_on_where_no_fill_is_exact(lengths, most):
    """A window without an exact fill costs one cut, and the other pieces are still packed whole."""
    from servstar.llm.packing import Packer
    out = []
    packer = Packer(lambda sequence, offset, p: out.append((p[0], p[1], p[2], sequence, offset)), 2048)
    for k, n in enumerate(lengths):
        packer.add(k, np.full(n, k, dtype="<u4").tobytes())
    packer.finish()
    of, rows = defaultdict(bytes), defaultdict(int)
    for k, start, ids, sequence, offset in sorted(out, key=lambda r: (r[0], r[1])):
        assert start == len(of[k]) // 4
        of[k] += ids
        rows[sequence] += len(ids) // 4
    assert [of[k] for k in range(len(lengths))] == [np.full(n, k, dtype="<u4").tobytes() for k, n in enumerate(lengths)]
    short = [n for n in rows.values() if n != 2048]
    assert len(short) == len(set(short)) and all(n & (n - 1) == 0 for n in short) and sum(short) < 2048
    assert len(out) - len(lengths) <= most


def test_words_have_the_tokenizers_ids():
    from servstar.llm.packing import tokenizer_file, word_tokenizer
    r = random.Random(3)
    signs = [chr(k) for k in range(1, 0x250)] + list("aé'stmdl 09!?<|>") * 30 + ["́", "Σ", "中", "　", "😀", "İ",
                                                                            "<|endoftext|>", "'s", "'LL"] * 5
    some = ["".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(3000)]
    for t, ids in zip(some, word_tokenizer(tokenizer_file())(some)):
        assert ids == brute.token_ids(t)[:-1].tobytes(), t


def test_best_fill_is_the_closest():
    from itertools import product

    from servstar.llm.packing import best_fill
    r = random.Random(5)
    for _ in range(200):
        have = {r.randrange(1, 30): r.randrange(1, 4) for _ in range(4)}
        counts = np.zeros(64, dtype=np.int64)
        for k, n in have.items():
            counts[k] = n
        capacity = r.randrange(1, 60)
        got = best_fill(counts, capacity)
        assert all(n <= have[k] for k, n in got)
        best = max(s for c in product(*[range(n + 1) for n in have.values()])
                   if (s := sum(k * m for k, m in zip(have, c))) <= capacity)
        assert sum(k * n for k, n in got) == best


# -- 4 --------------------------------------------------------------------------------------------

def spans_text(spans):
    return ",".join(f"{kind}:{a}:{z}" for a, _, z, kind in spans)


def test_secret_rules_match_brute_force(spark, texts):
    for i, r in result(spark, "op4_markov_secrets").items():
        want = brute.secrets(texts[i])
        kinds = Counter(s[3] for s in want)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == brute.sha(spans_text(want))
        assert set(spans_text(want).split(",")) - {""} <= set(r.spans.split(","))


def test_secret_odd_rows_and_models(spark, odd_docs, none):
    from pyspark.sql import functions as F

    from servstar.llm import secrets
    table = secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    want = Counter((r[0], spans_text(brute.secrets(r[1]))) for r in odd_rows())
    got = secrets.scan(odd_docs, table).select("doc_id", secrets.joined(F.col("base")).alias("b")).collect()
    assert Counter(map(tuple, got)) == want
    assert secrets.scan(none, secrets.train(none)).collect() == []
    more = ["see Zx9Qw3Lk8Vb2Nm7Tt5Rr1 there", "key eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9.", "𝄞 q7Zt4Kp9Xw2Lm8Vc3Bn6 end"]
    plain = ["Donaudampfschifffahrtsgesellschaft", "getUserAccountInformationById", "z" * 30, "=" * 40,
             "2024-01-01-2024-12-31-report", "MAX_CONNECTION_POOL_SIZE_LIMIT"]
    rows = [(k, t) for k, t in enumerate(more + plain)]
    got = {r[0]: r[1] for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), table)
           .select("doc_id", secrets.joined(F.col("spans"))).collect()}
    for k, t in enumerate(more):
        kind, a, z = got[k].split(":")
        assert kind == "markov" and t[int(a):int(z)] in t and int(z) - int(a) >= 20
    assert [got[k] for k in range(len(more), len(rows))] == [""] * len(plain)


def test_models_and_their_spans_against_plain_ones(spark, odd_docs):
    """Every text trains the models, however many there are and whatever its id; spans follow from them."""
    from pyspark.sql import functions as F

    from servstar.llm import secrets
    r = random.Random(5)
    strange = ["".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(n)) for n in (16, 20, 24, 40) for _ in range(10)]
    texts = [t.text for t in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] \
        + [t for _, t, *_ in odd_rows()] + [f"the {s} of a-plain-hyphenated-word, password = {s[::-1]}" for s in strange] + strange
    want = brute.markov_table(texts)
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    table = secrets.train(docs)
    signs = [None, *secrets.ALPHABET]
    assert max(abs(table[i * len(signs) + j] - want[a, b]) for i, a in enumerate(signs) for j, b in enumerate(signs)) < 1e-9
    got = Counter(x[0] for x in secrets.scan(docs, table).select(secrets.joined(F.col("spans"))).collect())
    assert got == Counter(spans_text(brute.markov_spans(t, want)) for t in texts)
    assert any("markov" in s for s in got)
    rare = secrets.train(docs.unionByName(docs.limit(0)).union(spark.createDataFrame([(1, "qqqqqqqqqqqqzz")], docs.schema)))
    q, z = signs.index("q"), signs.index("z")
    assert rare[q * len(signs) + z] < table[q * len(signs) + z]  # a single text counts


def test_models_on_random_strings_and_held_out_tokens(spark):
    """Recall by alphabet, and no token of other texts taken for random; figures of the whole trial are in the README."""
    import re
    import string

    from servstar.llm import secrets
    table = secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    r, up, low, digits = random.Random(11), string.ascii_uppercase, string.ascii_lowercase, string.digits
    families = {(digits + "ABCDEF", 32): 0.8, (digits + "ABCDEF", 40): 0.8, (up + digits, 32): 0.97, (up + digits, 20): 0.97,
                (up + "234567", 32): 0.97, (low + digits, 20): 0.97, (up, 24): 0.95, (low, 24): 0.95,
                (up + low + digits, 20): 0.97, (up + low + digits + "+/", 40): 0.97}
    rows = [(k, "".join(r.choice(alphabet) for _ in range(n))) for k, (alphabet, n) in enumerate(families) for _ in range(500)]
    other = [t.text or "" for t in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(3000).collect()]
    held = sorted({w for t in other for w in re.findall(secrets.TOKEN, t) if not brute.secrets(t)})
    names = ["get_user_account_information", "getUserAccountInformation", "connection-pool-size-limit", "-" * 40, "_" * 40,
             "DEFAULT_CONNECTION_TIMEOUT", "path/to/some/other/documents"]
    rows += [(-1, w) for w in held] + [(-2, w) for w in names]
    got = Counter(x.doc_id for x in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), table)
                  .filter("size(spans) > size(base)").select("doc_id").collect())
    assert got[-1] == 0 and len(held) > 50 and got[-2] == 0
    for k, (family, least) in enumerate(families.items()):
        found = got[k] / 500
        assert found >= least, (family, found)


def test_secrets_of_a_text_with_many_tokens(spark):
    """Work grows with the tokens of a text, not with their square."""
    from pyspark.sql import functions as F

    from servstar.llm import secrets
    text = " ".join(f"some-plain-token-{k}" for k in range(100_000)) + " AKIA" + "B2C3" * 5
    table = secrets.train(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    got = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), table).select(
        secrets.joined(F.col("base"))).first()[0]
    assert got == f"access:{len(text) - 24}:{len(text)}"


# -- 5 --------------------------------------------------------------------------------------------

def test_mixing_meets_its_target_with_null_and_repeated_ids(spark, tmp_path):
    """Equal rows, rows without id and rows that share one are split like any others."""
    from servstar.llm.mixing import mix
    rows = [(None if k % 3 == 0 else k, "a b c d e f g h i j " * 2, "s1") for k in range(600)]  # a third equal and without id
    rows += [(7, f"w{k} " * (1 + k % 9), "s2") for k in range(900)] + [(k, "x y z", "s3") for k in range(500)]
    rows += [(None, f"v{k % 40} " * 3, None) for k in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = mix(docs).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(rows)
    for s in ("s1", "s2", "s3", None):
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2
        assert all(0 <= r.taken <= 2 * r.size for r in own)
    again = mix(docs).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))


def test_mixing_odd_rows(odd_docs, none):
    from servstar.llm.mixing import mix
    rows = [(r[0], r[1], r[3]) for r in odd_rows()]
    got = mix(odd_docs.drop("size", "target", "copies")).collect()
    assert Counter((r.doc_id, r.source, r.size, r.copies) for r in got) == Counter(
        (i if i is not None else None, s, len(brute.words(t)), n) for (i, t, s), n in zip(
            rows, brute.copies([("" if i is None else i, t, s) for i, t, s in rows])))
    assert all(r.taken == r.size * r.copies <= 2 * r.size for r in got)
    clash = mix(odd_docs)
    assert len(clash.columns) == len(set(clash.columns)) and clash.count() == len(rows)
    assert mix(none).collect() == []


# -- 6 --------------------------------------------------------------------------------------------

def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = result(spark, "op6_quality_classifier", sf)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.3) for i, r in got.items())
    out = [(label[i], r.predicted) for i, r in got.items() if i in label and r.held_out]
    assert len(out) > 50 and sum(a == b for a, b in out) >= 0.95 * len(out)


def test_quality_against_plain_features_and_scores(spark, odd_docs):
    """Every text's features, its score from bin edges and weights, and weights that the pairs' loss can't better."""
    import math

    import numpy as np
    from pyspark.sql import functions as F

    from servstar.llm import quality
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)

    def score(text):
        raw = sum(model.weights[k * quality.BINS + sum(e < x for e in model.edges[k])]
                  for k, x in enumerate(brute.quality_features(text)))
        z = max(-30.0, min(30.0, model.slope * (raw - model.cut) + math.log(0.3 / 0.7)))
        return 1 / (1 + math.exp(-z))

    for df in (docs, odd_docs):
        got = df.select("text", quality.scored(F.col("text"), model).alias("s")).collect()
        assert max(abs(r.s - score(r.text)) for r in got) < 1e-9
    r, n = np.random.default_rng(3), 400
    label = np.arange(n) % 2
    x = r.normal(size=(n, len(quality.FEATURES)))
    x[:, 0] += label  # one feature tells, and not wholly
    fitted = quality.fit(x, label, pairs=5000)
    good, bad = fitted.raw(x)[label == 1], fitted.raw(x)[label == 0]
    wins = (good[:, None] > bad[None, :]).mean()
    assert wins > 0.75
    loss = lambda w: np.logaddexp(0, -(w[fitted.bins(x)].sum(axis=1)[label == 1][:, None]
                                       - w[fitted.bins(x)].sum(axis=1)[label == 0][None, :])).mean() + 5e-4 * (w ** 2).sum()
    assert loss(fitted.weights) < 0.9 * loss(np.zeros_like(fitted.weights))
    assert all(loss(fitted.weights * k) > 0.97 * loss(fitted.weights) for k in (0.5, 0.8, 1.25, 2.0))


def test_quality_learns_from_every_label(spark):
    """More labels than a group takes: bin edges and cut are still those of all rows, a rare label is in every group."""
    import numpy as np
    from pyspark.sql import functions as F

    from servstar.llm import quality
    n = 600
    docs = spark.createDataFrame([(k, " ".join(f"w{k % 7}" for _ in range(1 + k)) + "!" * (k % 50 == 7)) for k in range(n)],
                                 "doc_id long, text string")
    bad = lambda k: k % 50 == 7
    labels = spark.createDataFrame([(k, 1 - bad(k)) for k in range(n)], "doc_id long, quality int")
    learnt = [k for k in range(n) if zlib.crc32(str(k).encode()) % 5]
    model = quality.train(docs, labels, group_rows=40)
    text = {r.doc_id: r.text for r in docs.collect()}
    x = np.array([brute.quality_features(text[k]) for k in learnt])
    for f in range(x.shape[1]):
        for q, edge in enumerate(model.edges[f], 1):
            assert (x[:, f] <= edge).mean() >= q / quality.BINS - 1e-9 and (x[:, f] < (edge * (1 - 2 ** -9) if edge > 1e-300 else 0)).mean() <= q / quality.BINS
    raw = model.raw(x)
    worst = np.sort(raw)[:sum(map(bad, learnt)) + 1]
    assert worst[-2] - 1e-3 <= model.cut <= worst[-1] + 1e-3
    got = {r.doc_id: r.p for r in docs.select("doc_id", quality.predicted(quality.scored(F.col("text"), model)).alias("p")).collect()}
    assert all(got[k] == 1 - bad(k) for k in learnt)


def test_quality_odd_rows(spark, odd_docs, none):
    from pyspark.sql import functions as F

    from servstar.llm import quality
    labels = spark.createDataFrame([(k, k % 2) for k in range(17)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.train(odd_docs, labels)
    got = odd_docs.select("doc_id", quality.scored(F.col("text"), model).alias("s")).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows()) and all(0 <= r.s <= 1 for r in got)
    # Repeated labels, labels of other kinds and repeated documents change nothing.
    again = quality.train(odd_docs.unionByName(odd_docs), labels.unionByName(labels).unionByName(
        spark.createDataFrame([(5, 7)], "doc_id long, quality int")))
    assert np.array_equal(again.weights, model.weights) and again.cut == model.cut
    unlabelled = quality.train(odd_docs, labels.filter("false"))
    assert all(r.s >= 0.3 for r in odd_docs.select(quality.scored(F.col("text"), unlabelled).alias("s")).collect())
    assert none.select(quality.scored(F.col("text"), model)).collect() == []


# -- 7 --------------------------------------------------------------------------------------------

def check_shards(rows, want):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert {r.law for r in rows} <= {"rows"} and {r.grown_shard for r in rows} <= {None}
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r)
    counts = [len(slots[k]) for k in range(24)]
    assert max(counts) - min(counts) <= 1
    last = -1
    for k in range(24):
        run = sorted(slots[k], key=lambda r: r.slot)
        assert [r.slot for r in run] == list(range(len(run)))
        for r in run:  # shards are runs of the curve
            assert r.hilbert >= last
            last = r.hilbert


def test_sharding(spark, texts, odd_docs, none):
    from servstar.llm.sharding import hilbert_shards
    digest = lambda i, t: (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
    check_shards(list(result(spark, "op7_hilbert_sharding").values()), Counter(digest(i, t) for i, t in texts.items()))
    dims = ["source", "lang", "n_chars"]
    check_shards(hilbert_shards(odd_docs, dims).collect(), Counter(digest(r[0], r[1]) for r in odd_rows()))
    assert hilbert_shards(none, dims).collect() == []


def test_sharding_against_a_plain_one(spark, odd_docs):
    """Cells, curve, shards and slots of every row."""
    from servstar.llm.sharding import hilbert_shards
    dims = ["source", "lang", "n_chars"]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for df in (docs, odd_docs, docs.select("doc_id", "text", "source", "lang", (docs.n_chars % 7).alias("n_chars"))):
        want = brute.hilbert_shards([tuple(r) for r in df.select("doc_id", "text", *dims).collect()])
        assert Counter(map(tuple, hilbert_shards(df.repartition(5), dims).collect())) == want


def test_strings_are_quantised_whole(spark):
    """Sources that share their first bytes are placed like short ones, and a shard spans few of them."""
    from servstar.llm.sharding import hilbert_shards, string_cuts
    r = random.Random(4)
    rows = [(k, f"t{k}", min(int(r.expovariate(0.2)), 15), r.randrange(5000)) for k in range(4000)]
    got = []
    for prefix in ("", "https://www.example.org/common_crawl_"):
        docs = spark.createDataFrame([(i, t, prefix + "%02d" % s, n) for i, t, s, n in rows],
                                     "doc_id long, text string, source string, n_chars long").repartition(5)
        got.append({x.doc_id: x for x in hilbert_shards(docs, ["source", "n_chars"]).collect()})
    assert {i: (x.hilbert, x.shard) for i, x in got[0].items()} == {i: (x.hilbert, x.shard) for i, x in got[1].items()}
    of = defaultdict(set)
    for i, _, s, _ in rows:
        of[got[1][i].shard].add(s)
    assert sum(max(x) - min(x) for x in of.values()) / 24 < 6
    values = ["a"] * 5 + ["prefix-%d" % k for k in range(10)] + ["z"]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    assert string_cuts(df, 16) == sorted(values)[:15] and string_cuts(df, 4) == [sorted(values)[k] for k in (3, 7, 11)]
    assert string_cuts(df.limit(0), 4) == []


@pytest.mark.parametrize("dims", [2, 3])
def test_hilbert_neighbours_touch(spark, dims):
    """The index is a bijection, and consecutive cells differ by one step in one dimension."""
    from itertools import product

    from pyspark.sql import functions as F

    from servstar.llm.sharding import hilbert_index
    bits = 2
    cells = list(product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, ", ".join(f"c{k} int" for k in range(dims)))
    rows = df.withColumn("at", hilbert_index([F.col(f"c{k}") for k in range(dims)], bits)).collect()
    path = [tuple(r)[:dims] for r in sorted(rows, key=lambda r: r["at"])]
    assert sorted(r["at"] for r in rows) == list(range(len(cells)))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(path, path[1:]))


# -- 8 and 9 ----------------------------------------------------------------------------------------

def byte_rows(df):
    from pyspark.sql import functions as F
    return df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()


def test_suffix_dedup_matches_brute_force(spark, texts):
    got = {i: tuple(r)[1:] for i, r in result(spark, "op8_suffix_radix").items()}
    assert got == brute.repeated_bytes(texts)


def test_suffix_dedup_odd_rows(spark, odd_docs, none, monkeypatch):
    from servstar.llm import suffix_dedup
    rows = [(r[0], r[1]) for r in odd_rows() if len(r[1] or "") < 100_000]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.repeated_bytes({k: t for k, (_, t) in enumerate(rows)})
    expect = Counter((i, *want[k]) for k, (i, _) in enumerate(rows))
    assert Counter(map(tuple, byte_rows(suffix_dedup.remove_repeats(df)))) == expect
    # the way of anchors with too many contents for one task, and runs cut at block ends
    monkeypatch.setattr(suffix_dedup, "MOST_CONTENTS", 1)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    assert Counter(map(tuple, byte_rows(suffix_dedup.remove_repeats(df)))) == expect
    monkeypatch.undo()
    full = byte_rows(suffix_dedup.remove_repeats(odd_docs))
    assert len(full) == len(odd_rows())
    # the two long texts share all bytes of the first
    long, ended = (t.encode() for _, t, *_ in odd_rows() if len(t or "") >= 100_000)
    got = {r.n_bytes: tuple(r)[2:] for r in full if r.n_bytes > 100_000}
    assert got == {len(long): (len(long), 1, brute.sha(b"")), len(ended): (len(long), 1, brute.sha(b" end"))}
    assert suffix_dedup.remove_repeats(none).collect() == []


def test_substring_dedup_odd_rows(spark, odd_docs, none):
    from pyspark.sql import functions as F

    from servstar.llm.substring_dedup import remove_repeats
    order = 1 << 40  # NULL ids come last
    docs = {(order, t) if i is None else (i, t): t for i, t, *_ in odd_rows()}
    ranked = {k: n for n, k in enumerate(sorted(docs, key=lambda k: (k[0], k[1] or "")))}
    want = brute.repeated_words({ranked[k]: t for k, t in docs.items()})
    got = remove_repeats(odd_docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect()
    expect = Counter((i, *want[ranked[(order, t) if i is None else (i, t)]]) for i, t, *_ in odd_rows())
    assert Counter(map(tuple, got)) == expect
    assert remove_repeats(none).collect() == []


# -- 10 -------------------------------------------------------------------------------------------

def test_exact_dedup_odd_rows(odd_docs, none):
    from servstar.llm.exact_dedup import exact_duplicates
    got = exact_duplicates(odd_docs).collect()
    import re
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t, *_ in odd_rows():
        groups[brute.sha(norm(t))].append(i)
    assert Counter((r.doc_id, r.text_sha256) for r in got) == Counter((i, h) for h, g in groups.items() for i in g)
    for r in got:
        ids = [i for i in groups[r.text_sha256] if i is not None]
        assert r.group_size == len(groups[r.text_sha256]) and r.keep_id == (min(ids) if ids else None)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert kept == Counter(groups.keys())
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    full = exact_duplicates(odd_docs, max_bits=1 << 20)
    assert Counter(map(str, full.collect())) == Counter(map(str, got))
    assert exact_duplicates(none).collect() == []


# -- pipeline -------------------------------------------------------------------------------------

def test_pipeline_matches_brute_force(spark, given, texts):
    import corpus_pipeline
    from servstar.llm.registry import QUERIES
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "mixing", "packing"]
    good = {r.doc_id for r in QUERIES["op6_quality_classifier"](spark, SF).collect() if r.predicted == 1}
    docs = {i: texts[i] for i in brute.exact_keep({i: texts[i] for i in good})}
    near = brute.near(docs)
    docs = {i: t for i, t in docs.items() if near[i][1] == i}
    rows = [(i, t, given[i].source) for i, t in docs.items()]
    times = dict(zip(docs, brute.copies(rows)))
    got = corpus_pipeline.run(spark, SF).collect()
    check_pieces(got, [(i, brute.token_ids(docs[i])) for i, n in times.items() for _ in range(n)])


def test_pipeline_stages_keep_columns_and_odd_rows(spark, odd_docs, none):
    import corpus_pipeline
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (odd_docs, none):
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            assert out.count() <= 2 * docs.count()


def test_pipeline_stages_leave_clashing_columns_alone(spark, given):
    from pyspark.sql import functions as F

    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns(
        {c: F.col("doc_id") + 7 for c in ("copies", "size", "taken", "row", "fingerprint", "component_id", "__n", "__good", "kept")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        new = [c for c in docs.columns if c not in spark.read.parquet(f"{SF}/documents.parquet").columns]
        assert out.count() and out.filter(" or ".join(f"{c} <> doc_id + 7" for c in new)).count() == 0, name
