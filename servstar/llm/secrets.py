"""Secret scans, with DataFrame functions only.

Three rules find secrets by form. Two character Markov models find more: one of random
strings, one of ordinary identifiers, both first-order over letters, digits and a few signs,
trained from labelled samples (values that a rule hit are random strings, other long tokens
are ordinary, also in other cases and joined by signs). A token is a secret if the log-likelihood ratio of the
models is high enough.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar.llm.common import documents

#: kind, pattern, shortest length, group the length is measured on
RULES = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]+", 24, 0),
)
#: A maximal run of 24 digits or more is what ``[0-9a-f]+`` finds there; shorter runs needn't be listed.
SEARCH = {"hex": r"[0-9a-f]{24,}", "access": r"AKIA[A-Z0-9]{16,}"}
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
#: What the ordinary model is trained on, where no rule hits.
WORD = r"[A-Za-z0-9+/_=-]{6,}"
SMOOTHING = 0.5
#: What an ordinary transition counts in other cases, a word's first and last letter beside a sign that joins
#: words, and such a sign beside itself: identifiers in capitals or of several words needn't be in the texts.
CASES, JOINED, RUNS = 0.1, 0.25, 0.025
JOINS = "_-/="
#: Natural logarithm of the likelihood ratio, in all and per character, from which on a token is a secret.
LEAST_RATIO, LEAST_MEAN = 12.0, 0.75


def named(**fields):
    return F.named_struct(*[x for k, v in fields.items() for x in (F.lit(k), v)])


def found(text, kind: str, pattern: str, order: int, keep):
    """Array of (start, rank, end, kind, value) of the pattern's matches; ``keep`` tells of such a span
    whether it stays, so that the array only grows by those.

    ``split`` gives what lies between the matches, so starts are running lengths."""
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + x["size"]
        span = named(start=start, rank=F.lit(order), end=end, kind=F.lit(kind), value=x["m"])
        return named(at=end, out=F.when(keep(span), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]))

    kind_of = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
    none = F.array().cast(kind_of)
    pairs = F.zip_with(F.slice(between, 1, F.size(match)), match,
                       lambda b, m: named(gap=F.length(b), size=F.length(m), m=m))
    every = F.aggregate(pairs, named(at=F.lit(0), out=none), step, lambda acc: acc["out"])
    return F.when(F.size(match) > 0, every.cast(kind_of)).otherwise(none)


def base_spans(text):
    """The spans of the three rules by start, then kind as listed."""
    def one(order: int, kind: str, pattern: str, least: int, group: int):
        value = (lambda m: F.regexp_extract(m, pattern, group)) if group else (lambda m: m)
        return found(text, kind, SEARCH.get(kind, pattern), order, lambda s: F.length(value(s["value"])) >= least)
    return F.array_sort(F.concat(*[one(i, *rule) for i, rule in enumerate(RULES)]))


def secret_value(span):
    """What of a span is the secret itself."""
    return F.when(span["kind"] == "assign", F.regexp_extract(span["value"], RULES[0][1], 2)).otherwise(span["value"])


def train(docs: DataFrame, text: str = "text") -> list[float]:
    """Log-likelihood ratio of each transition (previous character, next character; 0 stands
    for any other), row by row, trained on every text.

    Equal strings are counted together first (map-side, so a frequent word is a row a task), their transitions then
    weigh as often; the driver gets at most one row per model and transition. Without samples a model is uniform."""
    size = len(ALPHABET) + 1
    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).withColumn("base", base_spans(F.col("text")))
    words = F.filter(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)),
                     lambda w: ~F.exists("base", lambda s: F.contains(s["value"], w)))
    samples = rows.select(F.explode(F.concat(
        F.transform("base", lambda s: named(model=F.lit(1), v=secret_value(s))),
        F.transform(words, lambda w: named(model=F.lit(0), v=w)))).alias("s")).groupBy("s.model", "s.v").agg(F.count("*").alias("n"))
    codes = F.transform(F.split("v", ""), lambda c: F.instr(F.lit(ALPHABET), c))
    edge = F.array(F.lit(size))  # before and after an ordinary token
    codes = F.when(F.col("model") == 0, F.concat(edge, codes, edge)).otherwise(codes)
    pairs = samples.select("model", "n", codes.alias("c")).filter(F.size("c") > 1).select(
        "model", "n", F.explode(F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1),
                                      lambda a, b: a * (size + 1) + b)).alias("at"))
    seen = {m: [[0.0] * (size + 1) for _ in range(size + 1)] for m in (0, 1)}
    for r in pairs.groupBy("model", "at").agg(F.sum("n").alias("n")).collect():
        seen[r.model][r["at"] // (size + 1)][r["at"] % (size + 1)] += r["n"]
    seen[0] = identifiers(seen[0])
    count = {m: [x + SMOOTHING for row in seen[m][:size] for x in row[:size]] for m in seen}
    out = []
    for a in range(size):
        row = slice(a * size, (a + 1) * size)
        total = {m: sum(count[m][row]) for m in count}
        out += [math.log(x / total[1]) - math.log(y / total[0]) for x, y in zip(count[1][row], count[0][row])]
    return out


def identifiers(seen: list[list[float]]) -> list[list[float]]:
    """Ordinary counts (the last row and column: a token's edge) plus those of words joined by signs and in other cases."""
    size, low = len(ALPHABET) + 1, [0] + [ALPHABET.index(c.lower()) + 1 for c in ALPHABET]
    out = [row[:size] for row in seen[:size]]
    for j in [ALPHABET.index(c) + 1 for c in JOINS]:
        for x in range(size):
            out[j][x] += JOINED * seen[size][x]
            out[x][j] += JOINED * seen[x][size]
        out[j][j] += RUNS * sum(seen[size])
    folded = [[0.0] * size for _ in range(size)]
    for a in range(size):
        for b in range(size):
            folded[low[a]][low[b]] += out[a][b]
    return [[x + CASES * folded[low[a]][low[b]] for b, x in enumerate(row)] for a, row in enumerate(out)]


def ratio(value, table: list[float]):
    """Log-likelihood ratio of a string: random against ordinary."""
    size = len(ALPHABET) + 1
    weights = F.from_json(F.lit(json.dumps([round(x, 6) for x in table])), "array<double>")
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    steps = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1),
                       lambda a, b: F.element_at(weights, a * size + b + 1))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x)


def random_tokens(text, spans, table: list[float]):
    """Tokens that the models take for random and that touch no base span. The models judge first, as few
    tokens are left for the comparison with the spans then."""
    def keep(t):
        least = F.greatest(F.lit(LEAST_RATIO), LEAST_MEAN * F.length(t["value"]))
        return (ratio(t["value"], table) >= least) & ~F.exists(
            spans, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))
    return found(text, "markov", TOKEN, len(RULES), keep)


def scan(docs: DataFrame, table: list[float], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, base, spans): arrays of (start, rank, end, kind, value) of every row's whole
    text, by code points, end exclusive. ``base`` has the rules' matches, ``spans`` also the tokens
    that the models take for random (kind ``markov``). NULL is empty: two empty arrays."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), t.alias("text")).withColumn("base", base_spans(F.col("text")))
    more = random_tokens(F.col("text"), F.col("base"), table)
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_markov_secrets(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = scan(docs, train(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(r[0]) for r in RULES], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                      joined(F.col("spans")).alias("spans"))
