"""Quality of documents by a linear-chain conditional random field over their lines.

Every line that is not blank is good or bad.  It is described by measures of its
own (length, kinds of characters, word shapes, repetition within the line and of
earlier parts of the document) and by those of the lines before and after it, each cut
into a few ranges; the field adds a weight for each range and for each pair of adjacent labels.
Forward-backward gives every line's probability to be good, and a document's quality is their
mean weighted by line length.

Only documents are labelled.  Their lines begin with the document's label; then lines
of bad documents that the field itself holds to be good are relabelled, and it is
fitted again.  Labels are drawn at different rates, for which documents are weighted: the
field stands for all labelled documents, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from takepick.llm.common import Scratch, Words, fresh, mix, stream, text_batches
from takepick.llm.toxicity import held_out

SHARES = (0.001, 0.01, 0.03, 0.08, 0.15, 0.3, 0.5, 0.7, 0.9, 0.97)
#: Measures of a line and where their ranges are cut.
MEASURES = {
    "characters": (5, 10, 20, 40, 80, 160, 320, 640, 1280, 5120),
    "words": (1.5, 3.5, 6.5, 12.5, 25.5, 50.5, 100.5, 400.5),
    "letters": SHARES,
    "digits": SHARES,
    "common marks": SHARES,
    "odd marks": SHARES,
    "upper case": SHARES,
    "word length": (1.5, 2.5, 3.5, 4.5, 5.5, 7, 9, 12, 20),
    "longest word": (2.5, 5.5, 10.5, 15.5, 20.5, 30.5, 60.5),
    "marked words": SHARES,
    "single characters": SHARES,
    "distinct words": SHARES,
    "runs seen in the line": SHARES,
    "runs seen before": SHARES,
    "line seen before": (0.5,),
    "last mark": (0.5, 1.5, 2.5),
}
BINS = 1 + max(map(len, MEASURES.values()))
EDGE = BINS  # there is no line before or after
RUN = 3  # words of a run

_CODE = np.arange(256)
_LETTER = (_CODE >= 0xC0) | ((_CODE | 32) >= 97) & ((_CODE | 32) <= 122) & (_CODE < 128)
_UPPER = (_CODE >= 65) & (_CODE <= 90)
_DIGIT = (_CODE >= 48) & (_CODE <= 57)
_CONTINUED = (_CODE >= 0x80) & (_CODE < 0xC0)
_COMMON = np.isin(_CODE, list(b".,;:?!'\"-()"))
_ODD = (_CODE > 32) & (_CODE < 127) & ~_LETTER & ~_DIGIT & ~_COMMON


@dataclass
class Lines:
    """Lines of a batch of texts, in order: text, number in it, code points, range of each measure."""

    text: np.ndarray
    number: np.ndarray
    size: np.ndarray
    bins: np.ndarray


def _seen(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether an equal key is earlier in the same group."""
    key = mix(key ^ mix(group.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return again


def describe(texts: list[str | None]) -> Lines:
    words = Words(texts, lower=False)
    data, start, end = words.data, words.start, words.end
    if not len(start):
        none = np.zeros(0, np.int64)
        return Lines(none, none, none, np.zeros((0, len(MEASURES)), np.uint8))
    breaks = data == 10
    breaks[words.base[1:] - 1] = True
    line_at = np.concatenate(([0], np.cumsum(breaks)))
    line_of, first = line_at[start], np.flatnonzero(np.diff(line_at[start], prepend=-1))
    count = np.diff(np.append(first, len(start)))
    line = np.repeat(np.arange(len(first)), count)
    text, a, b = words.doc[first], start[first], end[first + count - 1]

    def held(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(kind[data])))
        return sums[b] - sums[a]

    def sums(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags.astype(np.int64), first)

    size, letters = held(~_CONTINUED), held(_LETTER)
    continued = np.concatenate(([0], np.cumsum(_CONTINUED[data])))
    length = end - start - (continued[end] - continued[start])  # of words, in code points
    last = data[end - 1]
    whole = np.arange(len(start)) + RUN <= (first + count)[line]  # a run of words begins here and ends in this line
    coef = stream(RUN, 67)
    runs = np.zeros(len(start), np.uint64)
    for j in range(RUN):
        runs[: len(start) - j] += words.hash[j:] * coef[j]
    runs, of_line, of_text = mix(runs[whole]), line[whole], words.doc[whole]
    n_runs = np.maximum(np.bincount(of_line, minlength=len(first)), 1)
    in_line = _seen(of_line, runs)
    before = _seen(of_text, runs) & ~in_line
    same = np.add.reduceat(mix(words.hash + np.arange(len(start), dtype=np.uint64) - np.repeat(first, count).astype(np.uint64)), first)
    code = data[b - 1]
    values = (
        size,
        count,
        letters / size,
        held(_DIGIT) / size,
        held(_COMMON) / size,
        held(_ODD) / size,
        held(_UPPER) / np.maximum(letters, 1),
        sums(length) / count,
        np.maximum.reduceat(length, first),
        sums(_ODD[last]) / count,
        sums(length == 1) / count,
        sums(~_seen(line, words.hash)) / count,
        np.bincount(of_line[in_line], minlength=len(first)) / n_runs,
        np.bincount(of_line[before], minlength=len(first)) / n_runs,
        _seen(text, same),
        np.select((_LETTER[code] | _CONTINUED[code] | _DIGIT[code], np.isin(code, list(b".!?")), _COMMON[code]), (0, 1, 2), 3),
    )
    bins = np.stack([np.searchsorted(cuts, v, "right") for v, cuts in zip(values, MEASURES.values())], axis=1).astype(np.uint8)
    number = line_of[first] - line_at[words.base[text]]
    return Lines(text, number, size, bins)


class Chains:
    """Documents' lines as chains, for recursions that take one step in all of them at once."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        self.first = np.flatnonzero(np.diff(text, prepend=-1)) if n else np.zeros(0, np.int64)
        self.count = np.diff(np.append(self.first, n))
        by_size = np.argsort(-self.count, kind="stable")
        self.head, size = self.first[by_size], self.count[by_size]
        self.active = np.searchsorted(-size, -np.arange(size[0] if n else 0), "left")  # chains longer than t
        self.begins, self.ends = np.zeros(n, bool), np.zeros(n, bool)
        self.begins[self.first] = True
        self.ends[self.first + self.count - 1] = True

    def steps(self) -> Iterator[np.ndarray]:
        """Lines number 0 of all chains, then number 1 of those that have one, and so on."""
        for t, k in enumerate(self.active):
            yield self.head[:k] + t

    def marginals(self, lean: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each line to be good, and of each pair of labels of a line and the one before it."""
        n = len(lean)
        emit = np.stack((-lean / 2, lean / 2), axis=1)
        emit = np.exp(emit - emit.max(axis=1, keepdims=True))
        step = np.exp(pairs - pairs.max())
        forward, backward = np.ones((n, 2)), np.ones((n, 2))
        order = list(self.steps())
        for t, at in enumerate(order):
            f = emit[at] if not t else (forward[at - 1] @ step) * emit[at]
            forward[at] = f / f.sum(axis=1, keepdims=True)
        for at in order[:0:-1]:
            g = (emit[at] * backward[at]) @ step.T
            backward[at - 1] = g / g.sum(axis=1, keepdims=True)
        both = forward * backward
        good = both[:, 1] / both.sum(axis=1)
        later = np.flatnonzero(~self.begins)
        joint = forward[later - 1][:, :, None] * step * (emit[later] * backward[later])[:, None, :]
        return good, joint / joint.sum(axis=(1, 2), keepdims=True)


class Field:
    """Weights: of ranges of the line's measures, of those before and after it, and of pairs of labels."""

    def __init__(self, weights: np.ndarray | None = None):
        self.shape = (3, len(MEASURES), BINS + 1)
        self.size = int(np.prod(self.shape))
        self.weights = np.zeros(self.size + 4) if weights is None else weights

    def places(self, bins: np.ndarray, chains: Chains) -> np.ndarray:
        """Where the weights of each line are."""
        before, after = np.full_like(bins, EDGE), np.full_like(bins, EDGE)
        before[1:], after[:-1] = bins[:-1], bins[1:]
        before[chains.begins], after[chains.ends] = EDGE, EDGE
        at = np.stack((bins, before, after), axis=1).astype(np.int32)
        return (at + (BINS + 1) * np.arange(3 * len(MEASURES), dtype=np.int32).reshape(3, -1)).reshape(len(bins), 3 * len(MEASURES))

    def good(self, places: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray]:
        return chains.marginals(self.weights[places].sum(axis=1), self.weights[self.size :].reshape(2, 2))

    def fit(self, places: np.ndarray, chains: Chains, label: np.ndarray, weight: np.ndarray, steps: int, ridge: float) -> None:
        """Likelihood of the lines' labels with a ridge, climbed by Adam's rule over all lines."""
        later = np.flatnonzero(~chains.begins)
        pair = np.zeros((len(later), 2, 2))
        pair[np.arange(len(later)), label[later - 1], label[later]] = 1
        total, m, v = weight.sum(), np.zeros_like(self.weights), np.zeros_like(self.weights)
        for i in range(1, steps + 1):
            good, joint = self.good(places, chains)
            pull = np.bincount(places.ravel(), np.repeat(weight * (label - good), places.shape[1]), self.size)
            pull = np.concatenate((pull, ((pair - joint) * weight[later][:, None, None]).sum(axis=0).ravel()))
            pull = pull / total - ridge / len(chains.first) * self.weights
            m, v = 0.9 * m + 0.1 * pull, 0.99 * v + 0.01 * pull * pull
            self.weights = self.weights + 0.1 * (1 - 0.9 * i / steps) * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)


@dataclass
class QualityModel:
    weights: np.ndarray
    prior: float  # share of good documents
    start: float = 0.0  # of the document's log odds
    slope: float = 1.0
    prior_size: float = 20.0  # code points that the prior counts for

    def lines(self, texts: list[str | None]) -> tuple[Lines, np.ndarray]:
        lines = describe(texts)
        chains, field = Chains(lines.text), Field(self.weights)
        return lines, field.good(field.places(lines.bins, chains), chains)[0]

    def share(self, text: np.ndarray, size: np.ndarray, good: np.ndarray, n: int) -> np.ndarray:
        """Of each text, the mean of its lines' probabilities, weighted by length."""
        of = lambda x: np.bincount(text, x, n)
        return (self.prior * self.prior_size + of(size * good)) / (self.prior_size + of(size))

    def scores(self, share: np.ndarray) -> np.ndarray:
        share = np.clip(share, 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.start + self.slope * np.log(share / (1 - share)))))


def _drawn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_label: int, max_lines: int, s: Scratch) -> tuple[DataFrame, dict]:
    """(y, n, size, bins) of a bounded number of labelled documents, and how many there are of each label."""
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    marked = marked.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    totals = {r.y: r["count"] for r in marked.groupBy("y").count().collect()}
    one = lambda y: marked.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_label)
    chosen = s.table(one(0).unionAll(one(1)))  # at most 2 * per_label rows of 12 bytes: small enough to broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            lines, rows = describe(batch.column("text").to_pylist()), []
            ends = np.searchsorted(lines.text, np.arange(batch.num_rows + 1)).tolist()
            for i, hashed in enumerate(batch.column("h").to_pylist()):
                a, b = ends[i], ends[i + 1]
                if b - a > max_lines:  # a stretch of a long one
                    a += hashed % (b - a - max_lines + 1)
                    b = a + max_lines
                rows.append((lines.size[a:b].astype("<i8").tobytes(), lines.bins[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "y", "h")), *(pa.array([r[c] for r in rows], pa.binary()) for c in range(2))], ["id", "y", "h", "size", "bins"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    source = source.join(F.broadcast(chosen), "id").select("id", "y", "text", F.abs(F.xxhash64("text") % (1 << 40)).alias("h"))
    made = source.mapInArrow(run, "id long, y int, h long, size binary, bins binary")
    return made.groupBy("id").agg(F.min_by(F.struct("y", "size", "bins"), "h").alias("d")).select("id", "d.*"), totals  # one row of an id


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_per_label: int = 4000,
    max_lines: int = 200,
    ridge: float = 2.0,
) -> QualityModel:
    """Learn from labelled documents outside the held-out fold.

    The field is fitted on at most ``sample_per_label`` documents of each label (those whose
    hashed ids are least), of each at most ``max_lines`` adjacent lines.  Labels other than 0 and 1 are ignored;
    of several labels of one document the smallest counts.  If no document of one kind
    is labelled, every score is the share of good ones among the labelled, and
    without labels 0.5.
    """
    with Scratch(docs.sparkSession) as s:
        drawn, totals = _drawn(docs, labels, id_col, text_col, label_col, sample_per_label, max_lines, s)
        rows = sorted(drawn.collect())  # bounded: 24 bytes a line of the sample
    prior = (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)
    y = np.array([r.y for r in rows], np.int64)
    if not y.any() or y.all():
        return QualityModel(np.zeros(Field().size + 4), prior, np.log(prior / (1 - prior)), 0.0)
    size = [np.frombuffer(r["size"], "<i8") for r in rows]
    bins = np.frombuffer(b"".join(r.bins for r in rows), np.uint8).reshape(-1, len(MEASURES))
    n_lines = np.array([len(x) for x in size])
    text = np.repeat(np.arange(len(rows)), n_lines)
    size = np.concatenate(size)
    chains, field = Chains(text), Field()
    places = field.places(bins, chains)
    # a document counts as one, and as many times as its label's are rarer in the sample than they are
    of_doc = np.array([totals.get(k, 0) / max((y == k).sum(), 1) for k in (0, 1)])[y]
    weight = (of_doc / np.maximum(n_lines, 1))[text]
    label = y[text]
    field.fit(places, chains, label, weight, 150, ridge)
    for _ in range(2):
        good, _ = field.good(places, chains)
        worst = np.minimum.reduceat(good, chains.first)[np.repeat(np.arange(len(chains.first)), chains.count)]
        label = np.where(y[text] == 1, 1, (good > 0.9) & (good > worst)).astype(np.int64)
        field.fit(places, chains, label, weight, 60, ridge)
    model = QualityModel(field.weights, prior)
    good, _ = field.good(places, chains)
    share = np.clip(model.share(text, size, good, len(rows)), 1e-6, 1 - 1e-6)
    model.start, model.slope = _line(np.log(share / (1 - share)), y, of_doc)
    return model


def _line(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Start and slope of a logistic line, by Newton steps; the slope leans to 1."""
    w, a = np.array([0.0, 1.0]), np.column_stack((np.ones(len(x)), x))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        pull = a.T @ (weight * (y - p)) - ridge * (w - (0, 1))
        step = np.linalg.solve(a.T @ (a * (weight * p * (1 - p))[:, None]) + ridge * np.eye(2), pull)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0))


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.5, lines: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all rows and columns, and score (0 to 1), predicted (1 if score >= threshold).

    With ``lines`` also an array of (line, size, good): the number from 0, code points and probability of every line
    that is not blank.  Only the whole text is an input.  Null and empty texts, and those of white
    space, have no lines and get the score of the labelled documents' share of good ones.  Null and repeated ids are scored like any row.  A
    column of the documents that has one of the new names keeps it, and the new one gets an underscore in front.
    """
    score, predicted, told, t = fresh(docs, "score", "predicted", "lines", "tp_text")
    detail = ArrayType(StructType().add("line", "integer").add("size", "integer").add("good", "double"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, t, owner="quality"):
            n = batch.num_rows
            found, good = model.lines(batch.column(batch.num_columns - 1).to_pylist())
            more = [pa.array(model.scores(model.share(found.text, found.size, good, n)), pa.float64())]
            if lines:
                ends = pa.array(np.searchsorted(found.text, np.arange(n + 1)), pa.int32())
                each = pa.StructArray.from_arrays([pa.array(found.number, pa.int32()), pa.array(found.size, pa.int32()), pa.array(good)], ["line", "size", "good"])
                more.append(pa.ListArray.from_arrays(ends, each))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *more], [*batch.schema.names[:-1], *([score, told] if lines else [score])])

    schema = StructType(list(docs.schema.fields)).add(score, "double")
    schema = schema.add(told, detail) if lines else schema
    scored = docs.select("*", F.col(text_col).cast("string").alias(t)).mapInArrow(run, schema)
    return scored.withColumn(predicted, (F.col(score) >= threshold).cast("int"))
