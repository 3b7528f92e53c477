"""Quality scores by Bradley-Terry pairwise ranking.

Documents labelled good and bad form preference pairs; a document's strength is a
linear score of its features, learned by logistic loss on the feature differences of
the pairs. The cut between good and bad is a quantile of the training scores.

Every labelled row counts. Bin edges and cut come from counts over all of them; the weights are the mean of those that
groups of about ``GROUP_ROWS`` rows learn apart, each group in one task.

Features come from the whole text only: length, character classes, repeated words and
word pairs, one-hot by quantile bin so that the linear score can bend.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar.llm.common import RollingHash, documents, text_chunks, word_spans, written

#: Labelled rows that learn their weights together, about.
GROUP_ROWS = 20_000
#: Rows of either label that a group has at least, about: the rows of a rarer label go to several groups.
GROUP_KIND = 1_000
#: Pairs of a group.
PAIRS = 200_000
BINS = 16
CUT = 0.3
FEATURES = ("bytes", "words", "word_length", "upper", "digit", "non_ascii", "stop", "comma", "pipe", "bang",
            "symbol", "symbol_pair", "line", "capital_word", "distinct", "again", "distinct_pair", "top_word",
            "long_word")


def _byte_classes() -> np.ndarray:
    out = np.zeros((8, 256), dtype=bool)
    for row, chars in enumerate((range(65, 91), range(48, 58), range(128, 256), b".", b",", b"|", b"!")):
        out[row, list(chars)] = True
    out[7, list(b"#$%&*+/<=>@[\\]^_`{}~")] = True
    return out


CLASSES = _byte_classes()


def features(data: np.ndarray, offsets: np.ndarray, rolling: RollingHash) -> np.ndarray:
    """One row of ``FEATURES`` per text of a chunk; ratios, so that length enters by itself."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    per_byte = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    starts, ends, doc = word_spans(data, offsets)
    words = np.bincount(doc, minlength=n)
    per_word = lambda flags: np.bincount(doc, weights=flags, minlength=n)
    h = rolling.words(data, starts, ends)
    same_doc = doc[1:] == doc[:-1]

    def distinct(keys, at) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of each text, and the count of the most frequent one."""
        order = np.lexsort((keys, at))
        k, d = keys[order], at[order]
        new = np.ones(len(k), dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        first = np.flatnonzero(new)
        most = np.zeros(n)
        np.maximum.at(most, d[first], np.diff(np.append(first, len(k))))
        return np.bincount(d[first], minlength=n), most

    kinds, top = distinct(h, doc)
    pair = (h[1:] * np.uint64(3) + h[:-1])[same_doc]
    pair_kinds, _ = distinct(pair, doc[1:][same_doc])
    pairs = np.maximum(words - 1, 0)
    again = np.bincount(doc[1:][same_doc & (h[1:] == h[:-1])], minlength=n)
    symbol = CLASSES[7][data] | CLASSES[6][data]
    twice = np.zeros(len(data), dtype=bool)
    twice[1:] = symbol[1:] & symbol[:-1]
    b, w = np.maximum(size, 1), np.maximum(words, 1)
    upper, digit, wide, stop, comma, pipe, bang, sign = (per_byte(CLASSES[i][data]) for i in range(8))
    return np.column_stack([
        np.log1p(size), np.log1p(words), per_word(ends - starts) / w, upper / b, digit / b, wide / b, stop / w,
        comma / w, pipe / w, bang / w, sign / b, per_byte(twice) / b, per_byte(data == 10) / w,
        per_word(CLASSES[0][data[starts]]) / w, kinds / w, again / w, pair_kinds / np.maximum(pairs, 1),
        top / w, per_word(ends - starts > 24) / w])


class Model:
    """Bin edges per feature, weights per bin, and the map of raw scores to 0..1."""

    def __init__(self, edges: np.ndarray, weights: np.ndarray, cut: float, slope: float):
        self.edges, self.weights, self.cut, self.slope = edges, weights, cut, slope

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(self.edges[k], x[:, k], side="left") + k * BINS
                                for k in range(x.shape[1])])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.bins(x)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.raw(x) - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def weigh(at: np.ndarray, label: np.ndarray, pairs: int = PAIRS, steps: int = 300, ridge: float = 1e-3) -> np.ndarray:
    """Bradley-Terry strengths of the bins ``at`` from (good, bad) pairs of the rows; every row of a label
    occurs as often as the others, give or take one."""
    w = np.zeros(len(FEATURES) * BINS)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return w
    rng, pairs = np.random.default_rng(7), max(pairs, len(good), len(bad))
    deal = lambda rows: rng.permuted(np.tile(rows, (-(-pairs // len(rows)), 1)), axis=1).ravel()[:pairs]
    i, j = deal(good), deal(bad)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):  # Adam on the mean logistic loss of the differences
        s = w[at].sum(axis=1)
        g = -1 / (1 + np.exp(np.clip(s[i] - s[j], -30, 30))) / pairs
        row = np.bincount(i, weights=g, minlength=len(at)) - np.bincount(j, weights=g, minlength=len(at))
        grad = np.bincount(at.ravel(), weights=np.repeat(row, at.shape[1]), minlength=len(w)) + ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return w


def fit(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, steps: int = 300, ridge: float = 1e-3) -> Model:
    """A model of rows that are at hand as a whole.

    ``cut`` is the quantile of the training scores at the share of bad labels. With
    labels of one kind, or none, no preference exists: every score is the same, above the cut."""
    edges = (np.quantile(x, np.arange(1, BINS) / BINS, axis=0).T if len(x) else np.zeros((len(FEATURES), BINS - 1)))
    model = Model(edges, np.zeros(len(FEATURES) * BINS), -1.0, 1.0)
    good, bad = label == 1, label == 0
    if not good.any() or not bad.any():
        return model
    model.weights = weigh(model.bins(x), label, pairs, steps, ridge)
    s = model.raw(x)
    model.cut = _between(np.sort(s), np.ones(len(s)), bad.sum())
    model.slope = float(4 / max(1e-6, s[good].mean() - s[bad].mean()))
    return model


def _between(ranked: np.ndarray, n: np.ndarray, k: int) -> float:
    """Midway between the last of ``k`` scores counted as bad and the first counted as good, of scores that occur ``n`` times."""
    upto = np.cumsum(n)
    return float((ranked[np.searchsorted(upto, k)] + ranked[np.searchsorted(upto, min(k + 1, upto[-1]))]) / 2)


# -- counts over rows that are spread out -----------------------------------------------------------
#: Bits of a feature's value that a count of values drops: 10 binary places stay.
_DROPPED = 42
#: Steps of a score that a count of scores tells apart.
_SCORE_STEP = 1 / 4096


def _table(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _cell_counts(rows: DataFrame, cells) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, cell, rows) in order, summed over all ``rows``, of the (kind, cell) that ``cells`` gives for features and
    labels. A cell is a rounded value, so what reaches the driver is bounded by the values' range."""
    def count(batches):
        for b in batches:
            for kind, cell in cells(_table(b.column("__x")), b.column("__label").to_numpy()):
                value, n = np.unique(cell, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), kind, np.int64)), pa.array(value), pa.array(n)],
                                                 ["kind", "cell", "n"])
    got = rows.mapInArrow(count, "kind long, cell long, n long").groupBy("kind", "cell").agg(F.sum("n").alias("n")) \
        .toArrow().sort_by([("kind", "ascending"), ("cell", "ascending")])
    return tuple(got.column(c).to_numpy() for c in ("kind", "cell", "n"))


def _edges(rows: DataFrame) -> np.ndarray:
    """Quantiles of each feature over all rows, rounded up to the end of their cell (features aren't negative)."""
    kind, cell, n = _cell_counts(rows, lambda x, _: [
        (k, np.ascontiguousarray(x[:, k]).view(np.int64) >> _DROPPED) for k in range(len(FEATURES))])
    out = np.zeros((len(FEATURES), BINS - 1))
    for k in range(len(FEATURES)):
        upto = np.cumsum(n[kind == k])
        at = cell[kind == k][np.searchsorted(upto, np.arange(1, BINS) / BINS * upto[-1])]
        out[k] = (((at + 1) << _DROPPED) - 1).view(np.float64)
    return out


def _mean_weights(rows: DataFrame, model: Model, of: dict[int, int], group_rows: int) -> np.ndarray:
    """The mean of the groups' weights, by their rows: 2.4 KB a group reach the driver. ``of``: rows by label."""
    groups = -(-sum(of.values()) // group_rows)
    copies = {k: min(groups, -(-GROUP_KIND * groups // n)) for k, n in of.items()}
    dealt = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.when(F.col("__label") == 1, copies[1]).otherwise(copies[0])))) \
        .withColumn("__group", F.pmod(F.pmod(F.xxhash64("__id"), F.lit(groups)) + F.col("__copy"), F.lit(groups)))

    def learn(key, table):
        table = table.sort_by([("__id", "ascending"), ("__label", "ascending")])
        w = weigh(model.bins(_table(table.column("__x").combine_chunks())), table.column("__label").to_numpy())
        return pa.table({"g": [key[0].as_py()], "n": [len(table)], "w": pa.array([w], pa.list_(pa.float64()))})
    got = dealt.groupBy("__group").applyInArrow(learn, "g long, n long, w array<double>").toArrow().sort_by("g")
    each = got.column("w").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES) * BINS)
    return np.average(each, axis=0, weights=got.column("n").to_numpy())


def _per_text(result, kind: str):
    """An Arrow UDF from texts to ``result`` of the features of each chunk of them."""
    @F.arrow_udf(kind)
    def run(column: pa.Array) -> pa.Array:
        rolling = RollingHash(11)
        parts = [result(features(data, offsets, rolling)) for _, _, data, offsets in text_chunks(column)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.float64())
    return run


def held_out(doc_id):
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
          group_rows: int | None = None) -> Model:
    """A model from all labelled documents that aren't held out.

    Labels other than 0 and 1 don't count. Repeated labels and repeated documents count once; of different texts under
    one id the one with the smallest features stands for the id, an id labelled both ways is both. Texts stay where
    they are: features are joined with the labels, written, and read by each step."""
    usable = (labels.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{label}`").cast("int").alias("__label"))
              .filter("__id is not null and __label in (0, 1)").filter(~held_out(F.col("__id"))).distinct())
    of = _per_text(lambda x: pa.array(list(x), pa.list_(pa.float64())), "array<double>")
    seen = docs.filter(F.col(f"`{doc_id}`").isNotNull() & ~held_out(F.col(f"`{doc_id}`"))) \
        .select(F.col(f"`{doc_id}`").alias("__doc"), of(F.col(f"`{text}`")).alias("__x"))
    rows = written(seen.join(usable, F.col("__doc") == F.col("__id")).groupBy("__id", "__label").agg(F.min("__x").alias("__x")),
                   "labelled-features")
    by_label = {r["__label"]: r["count"] for r in rows.groupBy("__label").count().collect()}
    model = Model(np.zeros((len(FEATURES), BINS - 1)), np.zeros(len(FEATURES) * BINS), -1.0, 1.0)
    if by_label:
        model.edges = _edges(rows)
    if len(by_label) < 2:  # no preference: every score is the same, above the cut
        return model
    model.weights = _mean_weights(rows, model, by_label, group_rows or GROUP_ROWS)
    kind, cell, n = _cell_counts(rows, lambda x, y: [
        (k, np.rint(model.raw(x[y == k]) / _SCORE_STEP).astype(np.int64)) for k in (0, 1)])
    value, at = np.unique(cell, return_inverse=True)
    model.cut = _between(value * _SCORE_STEP, np.bincount(at, weights=n), by_label[0])
    bad, good = (np.average(cell[kind == k], weights=n[kind == k]) * _SCORE_STEP for k in (0, 1))
    model.slope = float(4 / max(1e-6, good - bad))
    return model


def scored(text, model: Model):
    """Score 0..1 of a text column; NULL scores like an empty text."""
    return _per_text(lambda x: pa.array(model.score(x)), "double")(text)


def predicted(score):
    return (score >= CUT).cast("int")


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(F.col("text"), model).alias("score")) \
        .withColumn("predicted", predicted(F.col("score")))
