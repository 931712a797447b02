"""Toxicity: Levenshtein automata intersected with a lexicon trie.

The lexicon is learned from labelled documents: words, and beginnings of words,
that toxic documents hold more often than chance allows (likelihood ratio).  A
trie of its terms is walked together with their Levenshtein automata, so a word
is compared with all terms at once; the intersection is made deterministic as it
is used.  Terms of five letters and more may have one edit, of nine and more two, after
the first letter; or the first letter alone may be another.  Shorter terms are an
edit away from many words and must be spelled right.  Words that clean documents
hold are no misspellings.

Each hit is read in its context: quotation marks around it and words before it that
report speech speak for a quotation, words that address somebody for abuse; the
score of the window divides the hit's weight between the two.  A logistic model of the
evidence (exact hits, misspelled hits, quoted hits) gives the document's score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from takepick.llm.common import Scratch, Words, sets_of_shingles, text_batches

WORD = re.compile(r"[^\W_]+")
#: Marks that open or close a quotation, and words that report speech in the four languages of the documents.
QUOTES = frozenset("\"“”„«»‹›‘’'`")
REPORTS = frozenset(
    "said says wrote writes called quote quoted quotes quoting termed sagte schrieb nannte zitat zitiert dit écrit citation cite appelé dijo escribió cita citado llamó".split()
)
#: Words that address somebody, in the same languages.
ADDRESS = frozenset("you your yours you're youre u ur du dich dir dein deine ihr euch euer tu te toi ton ta vous votre tú ti eres usted ustedes vosotros".split())
#: What marks, reports and addresses in a window add to the log odds of a quotation, and its start.
MARKED, REPORTED, ADDRESSED, START = 3.0, 2.5, -3.0, -1.0
FIRST = 9  # the errors of a state whose first letter is another: one, and no more may follow
STEMS = range(3, 9)  # lengths of word beginnings that may become terms


class TrieAutomaton:
    """All terms' Levenshtein automata, run over the trie of the terms at once.

    A term that ends in ``*`` is a beginning of words and must be spelled right;
    any other term is a whole word.
    """

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.child: list[dict[str, int]] = [{}]
        self.whole: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.limit: list[int] = [0]  # most edits of any term below a node
        for number, term in enumerate(terms):
            letters, node = term.rstrip("*"), 0
            edits = 0 if term.endswith("*") else self.edits(letters)
            for c in letters:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    for table, empty in ((self.child, {}), (self.whole, -1), (self.stem, -1), (self.limit, 0)):
                        table.append(empty)
                node = self.child[node][c]
                self.limit[node] = max(self.limit[node], edits)
            (self.stem if term.endswith("*") else self.whole)[node] = number
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    @staticmethod
    def edits(word: str) -> int:
        return 0 if len(word) < 5 else 1 if len(word) < 9 else 2

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        todo = list(pairs)
        while todo:  # a letter of the term is missing in the word
            node, errors = todo.pop()
            if node and errors < self.limit[node]:
                for child in self.child[node].values():
                    if (child, errors + 1) not in pairs and errors + 1 <= self.limit[child]:
                        pairs.add((child, errors + 1))
                        todo.append((child, errors + 1))
        key = frozenset(pairs)
        if key not in self.states:
            if len(self.sets) > 50_000:
                return self._reset(key)
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.next.append({})
        return self.states[key]

    def _reset(self, key: frozenset) -> int:
        self.states, self.sets, self.next = {}, [], []
        self.start = self._state({(0, 0)})
        return self._state(set(key))

    def _step(self, state: int, letter: str) -> int:
        known = self.next[state].get(letter)
        if known is not None:
            return known
        out: set[tuple[int, int]] = set()
        for node, errors in self.sets[state]:
            if letter in self.child[node]:
                child = self.child[node][letter]
                if errors % 8 <= self.limit[child]:
                    out.add((child, errors))
            if not node:
                out.update((c, FIRST) for x, c in self.child[0].items() if x != letter and self.limit[c])
            elif errors < self.limit[node]:
                out.add((node, errors + 1))
                out.update((c, errors + 1) for c in self.child[node].values() if errors + 1 <= self.limit[c])
        row = self.next[state]
        to = self._state(out)
        if len(self.next) > state and self.next[state] is row:
            row[letter] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the best match, fewest edits first, or None."""
        state, best = self.start, None
        for letter in word:
            state = self._step(state, letter)
            pairs = self.sets[state]
            if not pairs:
                break
            if best is None:
                stems = [self.stem[n] for n, e in pairs if e == 0 and self.stem[n] >= 0]
                best = (0, min(stems)) if stems else None
        for node, errors in self.sets[state]:
            term = self.whole[node]
            edits = errors % 8
            if term >= 0 and edits <= self.edits(self.terms[term]) and abs(len(word) - len(self.terms[term])) <= edits:
                best = min(best, (edits, term)) if best else (edits, term)
        return (best[1], best[0]) if best else None


@dataclass
class ToxicityModel:
    terms: list[str]
    weights: list[float]  # of the terms: log odds
    regular: frozenset[str]  # close to a term, but a word of clean documents
    coef: np.ndarray = field(default_factory=lambda: np.zeros(4))
    window: int = 4

    def matcher(self) -> "Matcher":
        return Matcher(self)


class Matcher:
    """Scores texts in one worker; chunks seen before are remembered, up to a bound."""

    def __init__(self, model: ToxicityModel):
        self.model, self.automaton, self.seen = model, TrieAutomaton(model.terms), {}

    def _chunk(self, chunk: str) -> tuple:
        found = []
        for word in WORD.findall(chunk):
            if (m := self.automaton.match(word)) and not (m[1] and word in self.model.regular):
                found.append((*m, word))
        return tuple(found)

    def hits(self, text: str) -> list[tuple[int, int, str, float]]:
        """(term, edits, word, share of quotation) of every hit in a whole text."""
        chunks = text.lower().split()
        seen = self.seen
        if len(seen) > 200_000:
            seen.clear()
        there = set(chunks)
        for c in there.difference(seen):
            found = self._chunk(c)
            if len(c) <= 64:
                seen[c] = found
            elif found:
                seen[c] = found
        hot = {c for c in there if seen.get(c)}
        if not hot:
            return []
        out = []
        for i, c in enumerate(chunks):
            if c in hot:
                quoted = self._quoted(chunks, i)
                out += [(*h, quoted) for h in seen[c]]
        for c in hot:
            if len(c) > 64:
                del seen[c]
        return out

    def _quoted(self, chunks: list[str], i: int) -> float:
        """How far the window around a hit speaks for a quotation, from 0 to 1."""
        w = self.model.window
        before, after = chunks[max(0, i - w) : i + 1], chunks[i : i + w + 1]
        opened = any(c[0] in QUOTES for c in before)
        closed = any(c.rstrip(".,;:!?")[-1:] in QUOTES for c in after)
        words = {c.strip(".,;:!?\"'") for c in before}
        marked, reported = opened and closed, not words.isdisjoint(REPORTS)
        if not marked and not reported:
            return 0.0
        return 1 / (1 + math.exp(-(START + MARKED * marked + REPORTED * reported + ADDRESSED * (not words.isdisjoint(ADDRESS)))))

    def evidence(self, text: str | None) -> np.ndarray:
        """1, exact, misspelled and quoted evidence."""
        exact = fuzzy = quoted = 0.0
        for term, edits, _, q in self.hits(text or ""):
            weight = self.model.weights[term]
            quoted += q * weight
            if edits:
                fuzzy += (1 - q) * weight
            else:
                exact += (1 - q) * weight
        return np.array([1.0, np.log1p(exact), np.log1p(fuzzy), np.log1p(quoted)])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        z = np.stack([self.evidence(t) for t in texts]) @ self.model.coef
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % folds == fold, F.lit(False))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Logistic regression with a ridge on all but the first coefficient, by Newton steps."""
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _g2(a: float, b: float, of_a: int, of_b: int) -> float:
    """Likelihood ratio of a of of_a against b of of_b."""
    n, share = a + b, of_a / (of_a + of_b)
    return 2 * ((a * np.log(a / (n * share)) if a else 0) + (b * np.log(b / (n * (1 - share))) if b else 0))


def _choose(counts: list[tuple[str, int, int]], toxic: int, clean: int, least: float) -> tuple[list[str], list[float]]:
    """Terms far more frequent in toxic documents; a word's beginning stands for its continuations."""
    odds = {t: float(np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1))) for t, a, b in counts}
    df = {t: a for t, a, _ in counts}
    strong = [t for t, a, b in counts if odds[t] > 1.5 and b * toxic <= 0.05 * a * clean and _g2(a, b, toxic, clean) >= least]
    chosen: dict[str, float] = {}
    for t in sorted(strong, key=lambda t: (len(t.rstrip("*")), t)):
        letters = t.rstrip("*")
        if t.endswith("*") and df.get(letters, 0) >= 0.9 * df[t]:
            continue  # the word itself is the term
        if t.endswith("*") and any(x.startswith(letters) and not x.endswith("*") and df[x] >= 0.9 * df[t] for x in strong):
            continue  # a beginning of one word
        if any(letters[:n] + "*" in chosen for n in STEMS if n <= len(letters)):
            continue
        chosen[t] = odds[t]
    best = sorted(chosen, key=lambda t: (-_g2(df[t], 0, toxic, clean) * chosen[t], t))
    return best, [chosen[t] for t in best]


def _one_each(drawn: DataFrame, percent: int = 80) -> DataFrame:
    """Of the drawn documents (id, y, text: a bounded number) those not nearly equal to one before them of the same label.

    Copies of one toxic document would make terms of its other words.  Sets of
    five-word shingles are compared in full; of two that are similar enough one
    shingle is among the first hashes of both, where candidates are looked up.
    """

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []
        known: dict[tuple[int, int], list[int]] = {}
        for batch in text_batches(batches, "text"):
            kept = []
            doc, shingles = sets_of_shingles(Words(batch.column("text").to_pylist()), 5)
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            for i, y in enumerate(batch.column("y").to_pylist()):
                mine = shingles[cuts[i] : cuts[i + 1]].copy()
                first = [(y, h) for h in mine[: len(mine) - -(-len(mine) * percent // 100) + 1].tolist()]
                near = [sets[x] for x in {x for h in first for x in known.get(h, ())}]
                if any(100 * (both := len(np.intersect1d(mine, x, True))) >= percent * (len(mine) + len(x) - both) for x in near):
                    continue
                kept.append(i)
                for h in first:
                    known.setdefault(h, []).append(len(sets))
                sets.append(mine)
            part = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("y"), part.column("text")], ["y", "text"])

    one = drawn.select("y", "id", "text").repartition(1).sortWithinPartitions("y", "id", F.xxhash64("text"))  # as many rows as are drawn, whatever the input
    return one.mapInArrow(pick, "y int, text string").repartition(32)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_per_label: int = 4000,
    least_g2: float = 25.0,
) -> ToxicityModel:
    """Learn from labelled documents outside the held-out fold.

    The documents learned from are bounded by ``sample_per_label`` of each label
    (those whose hashed ids are least, near copies once); all their words may
    become terms.  Labels are drawn at different rates, for which the model's start is
    corrected: it stands for all labelled documents.  Labels other
    than 0 and 1 are ignored; of several labels of one document the largest
    counts.  Without labelled documents of both kinds every score is 0.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    marked = marked.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    totals = {r.y: r["count"] for r in marked.groupBy("y").count().collect()}
    one = lambda y: marked.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample_per_label)
    with Scratch(docs.sparkSession) as s:
        chosen = s.table(one(0).unionAll(one(1)))  # at most 2 * sample_per_label rows of 12 bytes: small enough to broadcast
        source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        drawn = s.table(source.join(F.broadcast(chosen), "id"))
        sample = s.table(_one_each(drawn))
        sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
        toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
        if not toxic or not clean:
            return ToxicityModel([], [], frozenset(), np.array([-30.0, 0, 0, 0]))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_batches(batches, "text"):
                both = Counter(), Counter()
                for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
                    words = set(WORD.findall((text or "").lower()))
                    both[y].update(words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n})
                terms = list(both[0] | both[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in (both[1], both[0]))], ["term", "a", "b"]
                )

        total = sample.mapInArrow(count, "term string, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        # a term needs least_g2 at the least, and must stand out at most 1 in 20: few do
        strong = total.where((F.col("a") >= 3) & (F.col("b") * toxic <= 0.05 * clean * F.col("a")) & (2 * F.col("a") * float(np.log((toxic + clean) / toxic)) >= least_g2))
        terms, weights = _choose(sorted(map(tuple, strong.collect())), toxic, clean, least_g2)
        model = ToxicityModel(terms, weights, frozenset())

        def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = model.matcher()
            for batch in text_batches(batches, "text"):
                words = {w for t in batch.column("text").to_pylist() for _, edits, w, _ in m.hits(t or "") if edits}
                yield pa.RecordBatch.from_arrays([pa.array(sorted(words), pa.string())], ["w"])

        near = sample.where("y = 0").mapInArrow(close, "w string").distinct()
        model.regular = frozenset(r.w for r in near.collect())

        def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = model.matcher()
            for batch in text_batches(batches, "text"):
                x = np.stack([m.evidence(t) for t in batch.column("text").to_pylist()]) if batch.num_rows else np.zeros((0, 4))
                yield pa.RecordBatch.from_arrays([batch.column("y"), *(pa.array(x[:, i]) for i in range(1, 4))], ["y", "a", "b", "c"])

        rows = np.array([tuple(r) for r in sample.mapInArrow(evidence, "y int, a double, b double, c double").collect()], float)
        model.coef = logistic(np.column_stack((np.ones(len(rows)), rows[:, 1:])), rows[:, 0])
        model.coef[1:3] = np.maximum(model.coef[1:3], 0)  # a hit is never a sign of a clean text
        model.coef[0] += np.log(totals[1] / totals[0]) - np.log(toxic / clean)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, all its columns and score (0 to 1) and predicted (1 if score >= threshold).

    Only the whole text is an input.  Null and empty texts get the score of a
    text without hits.  Null and repeated ids are scored like any row.  Columns
    named score or predicted are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    schema = docs.select(*kept).schema.add("score", "double")
    at = kept.index(next(c for c in kept if c.lower() == text_col.lower()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.matcher()
        for batch in text_batches(batches, kept[at]):
            score = m.scores([None if t is None else str(t) for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, "score"])

    scored = docs.select(*kept).withColumn(kept[at], F.col(kept[at]).cast("string")).mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
