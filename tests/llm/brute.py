"""Plain Python versions of the operators, for tests on small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from functools import cache

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def fingerprint(text) -> int:
    import xxhash
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, links) -> dict:
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near(docs: dict) -> dict:
    ids = sorted(docs)
    fp = {i: fingerprint(docs[i]) for i in ids}
    of = components(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fp[a] ^ fp[b]).bit_count() <= 4])
    return {i: ("%016x" % fp[i], of[i]) for i in ids}


def exact_keep(docs: dict) -> list:
    first = {}
    for i in sorted(docs):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", docs[i] or ""), i)
    return sorted(first.values())


def targets(sizes: dict) -> dict:
    """Water level by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 2 * sizes[s]]
        if not over:
            return {**full, **share}
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]


def copies(rows: list) -> list:
    """How often the mix takes each (doc_id, text, source), by sorting."""
    size = [len(words(t)) for _, t, _ in rows]
    total = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        total[s] += n
    target, out = targets(dict(total)), [0] * len(rows)
    for s in total:
        base = int(target[s] // total[s]) if total[s] else 0
        budget = target[s] - base * total[s]
        at = defaultdict(list)
        for k, (i, _, x) in enumerate(rows):
            if x == s:
                out[k] = base
                at[int(hashlib.md5(str(i).encode()).hexdigest()[:12], 16)].append(k)
        for h in sorted(at):
            own = sum(size[k] for k in at[h])
            if own > budget and 2 * budget < own:
                break
            for k in at[h]:
                out[k] += 1
            if own > budget:
                break
            budget -= own
    return out


def repeated_bytes(docs: dict, depth: int = 400) -> dict:
    raw = {i: (t or "").encode() for i, t in docs.items()}
    count = Counter(b[k:k + depth] for b in raw.values() for k in range(len(b) - depth + 1))
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b) + 2, dtype=bool)
        for k in range(len(b) - depth + 1):
            if count[b[k:k + depth]] > 1:
                gone[k:k + depth] = True
        g = gone[:len(b)]
        out[i] = (len(b), int(g.sum()), int((g & ~np.concatenate([[False], g[:-1]])).sum()) if len(b) else 0,
                  sha(bytes(np.frombuffer(b, np.uint8)[~g])))
    return out


def repeated_words(docs: dict, size: int = 20) -> dict:
    seen, out = set(), {}
    for i in sorted(docs):
        w = words(docs[i])
        gone = np.zeros(len(w), dtype=bool)
        for k in range(len(w) - size + 1):
            if (key := tuple(w[k:k + size])) in seen:
                gone[k:k + size] = True
            seen.add(key)
        out[i] = (len(w), int(gone.sum()), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def planted(doc_id, text) -> list:
    """The words of a text, with the periodic end that a tenth of the ids get."""
    import zlib
    w = words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def periodic(w: list, least: int = 24, exponent: int = 3) -> list:
    """Runs (start, length, period) by comparing all words at every lag."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q - i), q)  # a multiple of the period has the same stretch
            i = max(j, i + 1)
    return sorted(((i, n, q) for (i, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_row(w: list) -> tuple:
    from fractions import Fraction
    runs = periodic(w)
    gone = {k for i, n, q in runs for k in range(i + q, i + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (len(runs), *best, best[1] * 1000 // best[2] if runs else None, sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def hard_negatives(rows: list, is_anchor) -> list:
    """Result rows from (vec_id, vector, label) by scoring all rows for each anchor."""
    import math
    use = []
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(256 * x) if abs(x) < 1e300 else 1 << 40 for x in v]
            if sum(x * x for x in q) < 1 << 62:
                use.append((i, q, label))
    out = []
    for k, (i, a, label) in enumerate(use):
        if i is None or not is_anchor(i):
            continue
        score = [(-sum(x * y for x, y in zip(a, b)), j is None, j or 0, n) for n, (j, b, _) in enumerate(use) if len(b) == len(a) and n != k]
        score.sort()
        for s, _, _, n in [x for x in score if use[x[3]][2] == label][:5]:
            near = [x for x in score if use[x[3]][2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, use[n][0], r + 1, use[x[3]][0], -s, -x[0]) for r, x in enumerate(near)]
    return out


def secrets(text) -> list:
    text = text or ""
    key = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    rules = (("assign", rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
             ("access", r"AKIA[A-Z0-9]+", 20, 0), ("hex", r"[0-9a-f]+", 24, 0))
    return sorted((m.start(), n, m.end(), kind) for n, (kind, p, least, g) in enumerate(rules)
                  for m in re.finditer(p, text) if len(m[g]) >= least)


def hilbert_index(cell, bits: int) -> int:
    """Hilbert index of a cell, level by level from Hamilton's formulas."""
    n = len(cell)
    left = lambda x, k: (x << k % n | x >> (n - k % n)) & ((1 << n) - 1)
    h = corner = direction = 0
    for level in range(bits - 1, -1, -1):
        g = left(sum((x >> level & 1) << k for k, x in enumerate(cell)) ^ corner, -(direction + 1))
        w = 0
        while g:  # inverse of the Gray code
            w, g = w ^ g, g >> 1
        if w:
            even = 2 * ((w - 1) // 2)
            ones = w if w % 2 else w - 1
            corner ^= left(even ^ even >> 1, direction + 1)
            direction += (len(bin(ones)) - len(bin(ones).rstrip("1"))) % n
        direction, h = (direction + 1) % n, h << n | w
    return h


def hilbert_shards(rows, shards: int = 24, bits: int = 6) -> Counter:
    """Of (doc_id, text, dimensions...) rows: (doc_id, size, crc, hilbert, law, shard, slot, grown_shard)."""
    import zlib

    import xxhash
    rows, cells = [(r[0], (r[1] or "").encode(), *r[2:]) for r in rows], 1 << bits
    cuts = []
    for column in zip(*[r[2:] for r in rows]):
        empty = "" if any(isinstance(x, str) for x in column) else 0
        key = str.encode if empty == "" else int
        values = sorted(key(x if x is not None else empty) for x in column)
        cuts.append((key, empty, [values[-(-p * len(values) // cells) - 1] for p in range(1, cells)]))
    placed = []
    for i, text, *dims in rows:
        cell = [sum(q < key(x if x is not None else empty) for q in of) for x, (key, empty, of) in zip(dims, cuts)]
        h = xxhash.xxh64_intdigest(text, seed=42)
        placed.append((hilbert_index(cell, bits), h - (h >> 63 << 64), i is not None, i or 0, len(text) + 8, zlib.crc32(text)))
    out, first = Counter(), {}
    for rank, (at, _, known, i, size, crc) in enumerate(sorted(placed)):
        shard = rank * shards // len(rows)
        out[i if known else None, size, crc, at, "rows", shard, rank - first.setdefault(shard, rank), None] += 1
    return out


def quality_features(text) -> list[float]:
    """The quality model's features of one text, counted plainly."""
    b = (text or "").encode()
    w = [x.encode() for x in words(text)]
    size, n = max(len(b), 1), max(len(w), 1)
    signs = set(b"#$%&*+/<=>@[\\]^_`{}~!")
    sign = set(b"#$%&*+/<=>@[\\]^_`{}~")
    pairs = list(zip(w, w[1:]))
    return [math.log1p(len(b)), math.log1p(len(w)), sum(map(len, w)) / n, sum(65 <= x <= 90 for x in b) / size,
            sum(48 <= x <= 57 for x in b) / size, sum(x >= 128 for x in b) / size, b.count(b".") / n, b.count(b",") / n,
            b.count(b"|") / n, b.count(b"!") / n, sum(x in sign for x in b) / size,
            sum(x in signs and y in signs for x, y in zip(b, b[1:])) / size, b.count(b"\n") / n,
            sum(65 <= x[0] <= 90 for x in w) / n, len(set(w)) / n, sum(x == y for x, y in pairs) / n,
            len(set(pairs)) / max(len(pairs), 1), max(Counter(w).values(), default=0) / n, sum(len(x) > 24 for x in w) / n]


_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."


def _secret(kind, value):
    return re.sub(r"""^.*?[:=]\x20*["']?""", "", value, count=1) if kind == "assign" else value


def markov_table(texts) -> dict:
    """Log-likelihood ratio by (character, next character), None for any other character."""
    sign = lambda c: c if c in _SIGNS else None
    random, plain = Counter(), Counter()
    for text in texts:
        text = text or ""
        values = [(kind, text[a:z]) for a, _, z, kind in secrets(text)]
        for kind, value in values:
            v = [sign(c) for c in _secret(kind, value)]
            random.update(zip(v, v[1:]))
        for w in re.findall(r"[A-Za-z0-9+/_=-]{6,}", text):
            if not any(w in value for _, value in values):
                v = ["edge", *map(sign, w), "edge"]
                plain.update(zip(v, v[1:]))
    every = [None, *_SIGNS]
    seen = {(a, b): float(plain[a, b]) for a in every for b in every}
    starts = sum(plain["edge", b] for b in [*every, "edge"])
    for j in "_-/=":
        for x in every:
            seen[j, x] += 0.25 * plain["edge", x]
            seen[x, j] += 0.25 * plain[x, "edge"]
        seen[j, j] += 0.025 * starts
    lower = lambda c: c and c.lower()
    folded = Counter()
    for (a, b), n in seen.items():
        folded[lower(a), lower(b)] += n
    ordinary = {(a, b): n + 0.1 * folded[lower(a), lower(b)] + 0.5 for (a, b), n in seen.items()}
    out = {}
    for a in every:
        all_random = sum(random[a, b] + 0.5 for b in every)
        all_ordinary = sum(ordinary[a, b] for b in every)
        for b in every:
            out[a, b] = math.log((random[a, b] + 0.5) / all_random) - math.log(ordinary[a, b] / all_ordinary)
    return out


def markov_spans(text, table) -> list:
    text = text or ""
    base, out = secrets(text), []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text):
        score = sum(table[a, b] for a, b in zip(m[0], m[0][1:]))
        if score >= max(12.0, 0.75 * len(m[0])) and not any(a < m.end() and m.start() < z for a, _, z, _ in base):
            out.append((m.start(), 3, m.end(), "markov"))
    return sorted(base + out)


@cache
def tokenizer():
    from tokenizers import Tokenizer

    from servstar.llm.packing import tokenizer_file
    return Tokenizer.from_file(tokenizer_file())


def token_ids(text):
    return np.asarray(tokenizer().encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
