"""Quality classifier: a linear-chain conditional random field over lines.

Every line of a document gets a vector of features of its own and of the lines
beside it; the field labels the lines good or bad, given each other.  The
length-weighted mean of the lines' marginals (forward-backward) is the
document's quality, put on the scale of a probability by a logistic fit.

The field is fitted on the driver from a bounded sample, ``MAX_TRAIN_DOCS``
labelled documents, in which a line has its document's label; the features of
the sample are computed by Spark and only they are gathered, not the texts.
Rows whose ``crc32(id as text) % 4`` is 2 are held out.  Scoring is one pass
without a shuffle.

Defined cases: null and empty texts, and texts without words, have no line and
get the sample's share of good documents; lines without words are left out;
repeated label rows count once, contradicting ones by their mean; without any
usable label every score is 0.5; null ids are scored and never held out; a very
long text is taken whole, in runs of lines; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.session import materialize

from .common import release
from .shingles import mix, text_bytes, words_of

MAX_TRAIN_DOCS = 4000          # the bounds of the sample: documents, and their lines together
MAX_TRAIN_LINES = 400_000
#: Lines of a group of texts with its padding, and texts of a group in training.
PADDED_LINES, GROUP_DOCS = 200_000, 500
FOLDS, HELD_OUT = 4, 2
ACCEPT = 0.7
STEPS, RATE, DECAY = 150, 0.1, 1e-3
RUN_BYTES = 1_000_000


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


#: Byte classes whose share in a line is a feature.
_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _class("abcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = True
_CLASSES = [_UPPER, _LETTER, _class("0123456789"), _class("|"), _class("!"), _class(".,;:?"),
            _class("\"#$%&'()*+/<=>@[\\]^_`{}~")]
#: Own features that the lines before and after lend.
_LENT = [1, 2, 3, 5, 6, 7, 9, 11]
N_OWN = 14
N_FEATURES = N_OWN + 2 * len(_LENT) + 3


def held_out(id_col: Column) -> Column:
    fold = F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def line_features(data: np.ndarray, offsets: np.ndarray):
    """(features, bytes, offsets of the texts among the lines) of all lines that
    hold a word."""
    n_texts = len(offsets) - 1
    cuts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
    starts, ends, words = words_of(data, cuts)
    line = np.searchsorted(cuts, starts, side="right") - 1
    at = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.empty(0, np.int64)
    n_lines = len(at)
    if not n_lines:
        return np.zeros((0, N_FEATURES), np.float32), np.zeros(0), np.zeros(n_texts + 1, np.int64)
    text = np.searchsorted(offsets, starts[at], side="right") - 1
    behind = np.append(at[1:], len(words))
    n_words = (behind - at).astype(np.float64)
    begin, end = starts[at], ends[behind - 1]
    size = (end - begin).astype(np.float64)

    def share(which):
        total = np.concatenate([[0], np.cumsum(which[data], dtype=np.int64)])
        return (total[end] - total[begin]).astype(np.float64)

    upper, letter, digit, pipe, bang, stop, symbol = map(share, _CLASSES)
    place = np.repeat(np.arange(n_lines), (behind - at))
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (place[1:] == place[:-1])
    # Distinct words of a line: places and hashes sorted as one number.
    key = np.sort((place.astype(np.uint64) << np.uint64(40)) | (words >> np.uint64(24)))
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    distinct = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=n_lines)
    short = np.add.reduceat((ends - starts <= 3).astype(np.float64), at)
    # A line seen before in its text.
    whole = mix(np.add.reduceat(mix(words + (np.arange(len(words)) - at[place]).astype(np.uint64)), at))
    _, first = np.unique(mix(whole + text.astype(np.uint64)), return_index=True)
    again = np.ones(n_lines)
    again[first] = 0
    own = np.stack([np.log1p(size) / 5, upper / (letter + 1), symbol / size, pipe / n_words, digit / size,
                    bang / n_words, np.add.reduceat(same, at) / n_words, 1 - distinct / n_words,
                    size / n_words / 10, np.isin(data[end - 1], np.frombuffer(b".!?", np.uint8)).astype(float),
                    _UPPER[data[begin]].astype(float), again, stop / n_words, short / n_words], axis=1)
    lines_of = np.searchsorted(text, np.arange(n_texts + 1))
    is_first, is_last = np.zeros(n_lines), np.zeros(n_lines)
    is_first[np.unique(lines_of[:-1][lines_of[:-1] < lines_of[1:]])] = 1
    is_last[np.unique(lines_of[1:][lines_of[:-1] < lines_of[1:]]) - 1] = 1
    lent = own[:, _LENT]
    before, after = np.zeros_like(lent), np.zeros_like(lent)
    before[1:], after[:-1] = lent[:-1], lent[1:]
    before[is_first == 1], after[is_last == 1] = 0, 0
    features = np.column_stack([own, before, after, is_first, is_last, np.ones(n_lines)])
    return features.astype(np.float32), size, lines_of


@dataclass(frozen=True)
class Model:
    """Feature scale, weights of "good", transitions [from, to], and the logistic
    map from mean marginals to scores."""
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    slope: float
    offset: float
    prior: float


def _padded(values: np.ndarray, lines_of: np.ndarray, fill=0.0):
    n = np.diff(lines_of)
    at = np.arange(int(n.max()) if len(n) else 0)[None, :] < n[:, None]
    out = np.full(at.shape, fill)
    out[at] = values
    return out, at


def forward_backward(good: np.ndarray, lines_of: np.ndarray, moves: np.ndarray):
    """(marginal of good per line, expected moves, log partition per text) from
    the lines' scores for good, the score of bad being 0."""
    unary, inside = _padded(good, lines_of)
    n, steps = unary.shape
    alpha = np.zeros((steps, n, 2))
    beta = np.zeros((steps, n, 2))
    emit = np.zeros((steps, n, 2))
    emit[:, :, 1] = unary.T
    alpha[0] = emit[0]
    for t in range(1, steps):
        prev = alpha[t - 1]
        step = np.logaddexp(prev[:, :1] + moves[0], prev[:, 1:] + moves[1]) + emit[t]
        alpha[t] = np.where(inside[:, t:t + 1], step, prev)
    for t in range(steps - 2, -1, -1):
        ahead = emit[t + 1] + beta[t + 1]
        step = np.stack([np.logaddexp(moves[a, 0] + ahead[:, 0], moves[a, 1] + ahead[:, 1]) for a in (0, 1)], axis=1)
        beta[t] = np.where(inside[:, t + 1:t + 2], step, 0.0)
    total = np.logaddexp(alpha[-1, :, 0], alpha[-1, :, 1])
    both = alpha + beta - total[None, :, None]
    marginal = np.exp(both[:, :, 1]).T[inside]
    expected = np.zeros((2, 2))
    if steps > 1:
        pair = inside[:, 1:].T
        for a in (0, 1):
            for b in (0, 1):
                p = alpha[:-1, :, a] + moves[a, b] + emit[1:, :, b] + beta[1:, :, b] - total[None, :]
                expected[a, b] = np.exp(p[pair]).sum()
    return marginal, expected, total


def _mean_marginals(features, size, lines_of, centre, spread, weights, moves) -> np.ndarray:
    """Length-weighted mean marginal of good per text; NaN without lines."""
    n = np.diff(lines_of)
    good = ((features - centre) / spread) @ weights
    out = np.full(len(n), np.nan)
    # Texts of like length go together, so that padding stays small.
    order = np.argsort(n, kind="stable")
    order = order[n[order] > 0]
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and (b + 1 - a) * n[order[b]] <= PADDED_LINES:
            b += 1
        part = order[a:b]
        rows = np.concatenate([np.arange(lines_of[i], lines_of[i + 1]) for i in part])
        at = np.concatenate([[0], np.cumsum(n[part])])
        marginal, _, _ = forward_backward(good[rows], at, moves)
        weight = size[rows]
        out[part] = np.add.reduceat(marginal * weight, at[:-1]) / np.add.reduceat(weight, at[:-1])
        a = b
    return out


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


class _Adam:
    def __init__(self, *shapes):
        self.m = [np.zeros(s) for s in shapes]
        self.v = [np.zeros(s) for s in shapes]
        self.t = 0

    def step(self, values, slopes, rate):
        self.t += 1
        for x, g, m, v in zip(values, slopes, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.99 ** self.t)) + 1e-8)


def train(parts: list[tuple[np.ndarray, np.ndarray]], quality: np.ndarray) -> Model:
    """Maximum likelihood of the lines' labels, then the logistic map."""
    keep = [i for i, (f, _) in enumerate(parts) if len(f)]
    parts, quality = [parts[i] for i in keep], quality[keep]
    if not parts or not len(quality):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), np.zeros((2, 2)), 1.0, 0.0, 0.5)
    order = np.argsort([len(f) for f, _ in parts], kind="stable")
    parts, quality = [parts[i] for i in order], quality[order]
    features = np.concatenate([f for f, _ in parts]).astype(np.float64)
    size = np.concatenate([s for _, s in parts])
    lines_of = np.concatenate([[0], np.cumsum([len(f) for f, _ in parts])])
    centre, spread = features.mean(axis=0), features.std(axis=0)
    centre[-1], spread = 0.0, np.where(spread > 1e-9, spread, 1.0)
    x = (features - centre) / spread
    label = np.repeat(quality, np.diff(lines_of))
    n = len(label)
    told = label @ x
    inner = np.ones(n, bool)
    inner[lines_of[1:] - 1] = False
    moved = np.array([[(1 - label[inner]).sum(), 0.0], [0.0, label[inner].sum()]])
    groups, a = [], 0
    while a < len(parts):
        b = a + 1
        # By size, so the last one is the longest.
        while b < min(len(parts), a + GROUP_DOCS) and (b + 1 - a) * len(parts[b][0]) <= PADDED_LINES:
            b += 1
        groups.append((a, b))
        a = b
    weights, moves, adam = np.zeros(x.shape[1]), np.zeros((2, 2)), _Adam(x.shape[1], (2, 2))
    for step in range(STEPS):
        good = x @ weights
        seen, seen_moves = np.zeros(n), np.zeros((2, 2))
        for a, b in groups:
            lo, hi = lines_of[a], lines_of[b]
            seen[lo:hi], expected, _ = forward_backward(good[lo:hi], lines_of[a:b + 1] - lo, moves)
            seen_moves += expected
        slope_w = (told - seen @ x) / n - DECAY * weights
        slope_m = (moved - seen_moves) / n - DECAY * moves
        adam.step([weights, moves], [slope_w, slope_m], RATE * (1 - step / STEPS) + 0.01)
    mean = _logit(_mean_marginals(features, size, lines_of, centre, spread, weights, moves))
    slope, offset = _logistic(mean, quality)
    return Model(centre, spread, weights, moves, slope, offset, float(quality.mean()))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps for y ~ slope * x + offset, lightly held to 0."""
    design, w = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        w += np.linalg.solve(h, design.T @ (y - p) - 1e-2 * w)
    return float(w[0]), float(w[1])


def _runs(column: pa.Array):
    """Features of runs of texts: (features, bytes, offsets)."""
    data, offsets = text_bytes(column)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + RUN_BYTES, side="right")) - 1))
        yield line_features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        a = b


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [(f[at[i]:at[i + 1]].tobytes(), s[at[i]:at[i + 1]].tobytes())
               for f, s, at in _runs(batch.column(0)) for i in range(len(at) - 1)]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary()),
                                          batch.column(1), batch.column(2)], ["features", "size", "quality", "place"])


def _within(lines: list[tuple[int, int]], max_lines: int) -> list[int]:
    """Places in order, without documents that would go beyond ``max_lines``."""
    kept, total = [], 0
    for place, n in sorted(lines):
        if total + n <= max_lines:
            kept.append(place)
            total += n
    return kept


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_docs: int = MAX_TRAIN_DOCS, max_lines: int = MAX_TRAIN_LINES) -> Model:
    """Fits the field on at most ``max_docs`` labelled documents, those with the
    smallest hashes of their ids among all that are not held out, and at most
    ``max_lines`` lines, leaving out documents that would go beyond.  Of rows that
    repeat an id the one with the smallest hash of the text counts."""
    own = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("quality"))
    sample = (own.where(F.col("quality").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
              .groupBy("id").agg(F.avg("quality").alias("quality"))
              .orderBy(F.xxhash64("id"), "id").limit(max_docs))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    one = (texts.where(F.col("text").isNotNull()).join(F.broadcast(sample), F.col("doc") == F.col("id"))
           .groupBy("doc", "quality").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))
    features = materialize(one.select("text", "quality", F.xxhash64("doc").alias("place")).mapInArrow(
        lambda b: _sample_features(b), "features binary, size binary, quality double, place long"), "line-features")
    lines = [(r["place"], r["n"]) for r in features.select("place", (F.length("size") / 8).cast("int").alias("n")).collect()]
    kept = _within(lines, max_lines)
    if len(kept) < len(lines):
        features = features.where(F.col("place").isin(kept))
    rows = features.collect()
    rows.sort(key=lambda r: (r["features"], r["quality"]))
    parts = [(np.frombuffer(r["features"], np.float32).reshape(-1, N_FEATURES), np.frombuffer(r["size"], np.float64))
             for r in rows]
    return train(parts, np.array([r["quality"] for r in rows]))


def text_scores(column: pa.Array, model: Model) -> np.ndarray:
    """Scores of a column of texts."""
    mean = [_mean_marginals(f, s, at, model.centre, model.spread, model.weights, model.moves)
            for f, s, at in _runs(column)]
    mean = np.concatenate(mean) if mean else np.empty(0)
    value = 1 / (1 + np.exp(-np.clip(model.slope * _logit(mean) + model.offset, -700, 700)))
    return np.where(np.isnan(mean), model.prior, value)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = text_scores(batch.column(2), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value),
                                              pa.array((value >= ACCEPT).astype(np.int32))], names)

    names = [id_col, "held_out", "score", "predicted"]
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), held_out(F.col(f"`{id_col}`")).alias("held_out"),
                       F.col(f"`{text_col}`").alias("__text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that the classifier accepts, with all their columns: the text
    alone goes to Python, and its decision comes back."""
    @F.arrow_udf("boolean")
    def good(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array(text_scores(column, model) >= ACCEPT)
        release()

    return docs.where(good(F.col(f"`{text_col}`")))
