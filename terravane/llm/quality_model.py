"""A quality classifier learned from positive and unlabelled texts.

Trusted positives are the training labels of quality 1; unlabelled texts are drawn from the corpus, whatever their
labels. A logistic model over measurements of a text minimises the non-negative unbiased risk

    prior * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - prior * E_pos[loss(-f)])

Where the second term would be negative, a step is taken against it alone, as in the published method. No label other
than 1 is used, not even for the prior: above any bound on a score, the share of the unlabelled is at least the prior
times the share of the positives, and at a bound that only positives pass it is just that. So the prior is the least
ratio of the two shares, with scores of a first model fitted to the other half of the samples.

At most `sample` positives and `sample` unlabelled texts reach the driver for the fit. They are drawn among distinct
pairs of id and text by a hash of these, so repeated rows count once; all texts are scored.

Defined results: null and empty texts are measured as texts without words; if no positive label is there, every score
is 0.5; rows with a null id are scored, not learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import saved
from .language import held_out

SAMPLE = 20_000
FEATURES = (
    "log_words", "word_length", "upper", "digits", "symbols", "pipes", "exclamations", "stops", "commas", "other_punctuation",
    "beyond_ascii", "lines", "distinct", "commonest", "same_neighbour", "repeated_windows", "capitals", "long_words",
)


def _counts(low: np.ndarray, ends: np.ndarray, test: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(test[low], dtype=np.int64)])
    return total[ends[1:]] - total[ends[:-1]]


def _set(chars) -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[list(chars)] = 1
    return t


_SETS = {
    "upper": _set(range(65, 91)),
    "digits": _set(range(48, 58)),
    "symbols": _set(b"#*$%&<>"),
    "pipes": _set(b"|"),
    "exclamations": _set(b"!"),
    "stops": _set(b".?"),
    "commas": _set(b",;:"),
    "other_punctuation": _set(b"\"'()-/=@[\\]^_`{}~+"),
    "beyond_ascii": _set(range(192, 256)),
    "lines": _set(b"\n"),
}


def measure(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    data, ends = W.flat(texts)
    mapped = W.PLAIN[data]
    s, e, first = W.spans(mapped, ends)
    h = W.hashes(mapped, s, e)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    per_word = 1 / np.maximum(n, 1)
    length = np.diff(ends)
    out = {k: _counts(data, ends, t) * per_word for k, t in _SETS.items()}
    out["log_words"] = np.log1p(n)
    out["word_length"] = length * per_word
    out["upper"] = _counts(data, ends, _SETS["upper"]) / np.maximum(length, 1)

    def per_doc(flag: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=flag, minlength=len(n)) * per_word

    order = np.lexsort((h, doc))
    d, x = doc[order], h[order]
    new = np.ones(len(x), bool)
    new[1:] = (np.diff(d) != 0) | (x[1:] != x[:-1])
    heads = np.flatnonzero(new)
    runs = np.diff(np.append(heads, len(x)))
    out["distinct"] = per_doc(new, d)
    most = np.zeros(len(n))
    np.maximum.at(most, d[heads], runs)
    out["commonest"] = most * per_word
    twin = np.zeros(len(h), bool)
    twin[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    out["same_neighbour"] = per_doc(twin, doc)
    g = W.mix(h + np.uint64(3) * np.roll(h, -1)) + np.uint64(7) * np.roll(h, -2)
    whole = np.flatnonzero(np.repeat(first[1:], n) - np.arange(len(h)) >= 3)
    order = np.lexsort((g[whole], doc[whole]))
    d, x = doc[whole][order], g[whole][order]
    old = np.zeros(len(x), bool)
    old[1:] = (np.diff(d) == 0) & (x[1:] == x[:-1])
    out["repeated_windows"] = per_doc(old, d)
    initial = data[s]
    out["capitals"] = per_doc((initial >= 65) & (initial <= 90), doc)
    out["long_words"] = per_doc(e - s > 20, doc)
    return np.stack([out[k] for k in FEATURES], axis=1)


def _rows(texts: pa.Array) -> np.ndarray:
    got = [measure(texts.slice(a, b - a)) for a, b in W.pieces(texts, 8 << 20)]
    return np.concatenate(got) if got else np.zeros((0, len(FEATURES)))


class Model:
    """Standardised measurements, their squares, and a weight for each."""

    def __init__(self, prior: float, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.prior, self.centre, self.scale, self.weights = prior, centre, scale, weights

    def expanded(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        return np.concatenate([z, np.minimum(z * z, 36) / 6, np.ones((len(z), 1))], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.expanded(x) @ self.weights, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Full-batch Adam on the non-negative risk, with logistic loss."""
    return _fit(positive, unlabelled, prior, steps, rate, decay)


def _fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.05, decay: float = 1e-4, plain: bool = False) -> Model:
    """As fit(); plain: both samples weigh the same and the unlabelled count as negatives, for an order of the scores only."""
    both = np.concatenate([positive, unlabelled]) if len(unlabelled) else positive
    n = 2 * len(FEATURES) + 1
    start = np.zeros(n)
    start[-1] = np.log(prior / (1 - prior))
    if not len(positive) or not len(unlabelled):
        return Model(prior, np.zeros(len(FEATURES)), np.ones(len(FEATURES)), start)
    low, mid, high = np.quantile(both, [0.16, 0.5, 0.84], axis=0)
    model = Model(prior, mid, np.maximum((high - low) / 2, np.maximum(both.std(axis=0) * 0.25, 1e-6)), start)
    p, u = model.expanded(positive), model.expanded(unlabelled)
    w, m, v = start.copy(), np.zeros(n), np.zeros(n)
    sig = lambda t: 1 / (1 + np.exp(-np.clip(t, -30, 30)))
    for t in range(1, steps + 1):
        fp, fu = p @ w, u @ w
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        g_pos = -prior * (p * sig(-fp)[:, None]).mean(axis=0)
        g_neg = (u * sig(fu)[:, None]).mean(axis=0) - prior * (p * sig(fp)[:, None]).mean(axis=0)
        if plain:
            g = -(p * sig(-fp)[:, None]).mean(axis=0) / 2 + (u * sig(fu)[:, None]).mean(axis=0) / 2 + decay * w
        else:
            g = (g_pos + g_neg if negative >= 0 else -g_neg) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model.weights = w
    return model


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = _rows(b.column(1))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["role", "x"])


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from the two samples alone.

    Each half of the samples is judged by a model fitted to the other half. Bounds that fewer than a tenth of the
    positives pass are left out, as their ratios are mostly chance; of the rest the ratio with the least upper
    bound (three deviations up) counts.
    """
    if len(positive) < 4 or len(unlabelled) < 4:
        return 0.5
    rng, found = np.random.default_rng(3), []
    p_side, u_side = rng.permutation(len(positive)) % 2, rng.permutation(len(unlabelled)) % 2
    for side in (0, 1):
        model = _fit(positive[p_side != side], unlabelled[u_side != side], 0.5, plain=True)
        p, u = (np.sort(model.score(x)) for x in (positive[p_side == side], unlabelled[u_side == side]))
        at = np.quantile(p, np.linspace(0.0, 0.9, 46))
        passed_p = 1 - np.searchsorted(p, at, "left") / len(p)
        passed_u = 1 - np.searchsorted(u, at, "left") / len(u)
        ratio = passed_u / np.maximum(passed_p, 1e-9)
        spread = ratio * np.sqrt((1 - passed_u) / np.maximum(passed_u * len(u), 1) + (1 - passed_p) / np.maximum(passed_p * len(p), 1))
        found.append(ratio[np.argmin(ratio + 3 * spread)])
    return float(np.clip(np.mean(found), 0.01, 0.99))


def drawn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """role (1: positive, 2: unlabelled) and text of at most `sample` texts of either role, none of them held out."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text")).where(~held_out("id") & F.col("id").isNotNull())
    marks = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality")).where((F.col("quality") == 1) & F.col("id").isNotNull())
    trusted = rows.select("id", "h").join(marks.select("id").distinct(), "id", "left_semi")
    chosen = None
    for role, pairs in ((1, trusted), (2, rows.select("id", "h"))):
        some = pairs.distinct().orderBy(F.xxhash64("id", "h", F.lit(role)), "id", "h").limit(sample).select("id", "h", F.lit(role).alias("role"))
        chosen = some if chosen is None else chosen.unionByName(some)
    # No more than 2 * sample rows are broadcast, and the same number comes out: repeats of a pair go before they are measured.
    found = rows.join(F.broadcast(saved(chosen)), ["id", "h"])
    return found.dropDuplicates(["role", "id", "h"]).select("role", "text")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """The model of docs and labels; rows that held_out() names are never learned from."""
    got = drawn(docs, labels, id_col, text_col, sample).mapInArrow(_measured, "role int, x array<double>").toPandas()
    role = got["role"].to_numpy()
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, len(FEATURES)))
    # Rows come in no fixed order; the fit is to be the same every time.
    order = np.lexsort(x.T) if len(x) else np.zeros(0, np.int64)
    role, x = role[order], x[order]
    positive, unlabelled = x[role == 1], x[role == 2]
    return fit(positive, unlabelled, estimated_prior(positive, unlabelled) if len(positive) else 0.5)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.value.score(_rows(b.column(2)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted for each row of docs."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_score(known), "doc_id long, held_out boolean, score double, predicted int")
