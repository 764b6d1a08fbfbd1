"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the classes of a clause's words and emit events: insults, threats (and those at a
target), targets (second or third person near an insult), negations (before an insult) and reported speech
(before an insult or threat). They are composed into one automaton; a clause that an insult or a threat was
matched in scores the weights of its events. A document's score is a calibrated function of its clauses' scores.

Learned from a bounded sample of labelled rows are the insults, the events' weights and the calibration. Insults are
words and word stems (first four to six letters) that stand in toxic texts far more often than in others, by a
likelihood-ratio test that allows for the number of candidates. The weights start at PRIOR, are held near it by a
ridge and keep its signs. Near copies in the sample share one vote. The classes of the other words are short fixed lists.

Null and empty texts have no clause and the base score. Without labelled toxic rows nothing is an insult.
Repeated rows get equal scores; extra columns are passed over; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhouse.llm.common import fold, slices, small_batches, spans, stored, texts_of
from roundhouse.llm.textgrid import WordGrid, mix, shingles

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Expected rows of each label in the sample, at most.
SAMPLE_ROWS = 10_000
CANDIDATES, LEXICON = 50_000, 5_000
STEMS = (4, 5, 6)
CLAUSE_ENDS = ".!?;:\n"

#: Single words, as the texts' words are cut: at apostrophes too.
WORDS = {
    THREAT: "kill destroy hurt punish crush beat töten zerstören schlagen verletzen tuer détruire frapper blesser matar destruir golpear herir",
    TARGET: "you your yours he she they him her them these those du dich dir ihr euch sie er tu te toi vous il elle ils tú ti usted él ella ellos",
    NEGATION: "not never no nobody isn wasn nicht nie kein keine ne pas jamais aucun nunca jamás ningún",
    REPORT: "said says wrote claimed quoted reported called sagte sagt schrieb behauptete dit disait écrit affirme dijo dice escribió afirmó",
}


#: What transducers emit, and the weights that learning starts from: positive ones stay so, negative ones too.
EVENTS = ("insult", "further insult", "threat", "threat at a target", "insult at a target", "negated insult", "reported insult", "reported threat")
PRIOR = np.array([1.0, 0.6, 0.2, 0.8, 0.3, -0.5, -0.3, -0.1])
FIRST, FURTHER, THREATENS, AT_TARGET, NEAR_TARGET, NEGATED, REPORTED, REPORTED_THREAT = range(len(EVENTS))
#: Score of a matched clause, at least.
LEAST = 0.05


@dataclass(frozen=True)
class Transducer:
    """(state, class) -> (next state, event or None); a missing arc stays in its state and emits nothing. final: states that accept."""

    arcs: dict[tuple[int, int], tuple[int, int | None]]
    final: frozenset[int] = frozenset()


def _grammar() -> list[Transducer]:
    insults = Transducer({(0, INSULT): (1, FIRST), (1, INSULT): (1, FURTHER)}, frozenset({1}))
    threats = Transducer({(0, THREAT): (1, THREATENS), (1, TARGET): (2, AT_TARGET)}, frozenset({2}))
    targets = Transducer({(0, TARGET): (1, None), (1, INSULT): (2, NEAR_TARGET), (0, INSULT): (3, None), (3, TARGET): (2, NEAR_TARGET)})
    near = {(k, c): (k - 1, None) for k in (1, 2, 3) for c in (OTHER, TARGET, THREAT, REPORT)}
    negations = Transducer(near | {(k, NEGATION): (3, None) for k in range(4)} | {(k, INSULT): (0, NEGATED) for k in (1, 2, 3)})
    reports = Transducer({(0, REPORT): (1, None), (1, INSULT): (1, REPORTED), (1, THREAT): (1, REPORTED_THREAT)})
    return [insults, threats, targets, negations, reports]


@dataclass
class Composed:
    """The product of transducers that read the same classes; states are made when they are first reached."""

    parts: list[Transducer]
    arcs: dict = field(default_factory=dict)

    def events(self, classes: list[int]) -> list[int] | None:
        """How often each of EVENTS was emitted; None if no part accepts."""
        state, counts = (0,) * len(self.parts), [0] * len(EVENTS)
        for c in classes:
            arc = self.arcs.get((state, c))
            if arc is None:
                steps = [p.arcs.get((s, c), (s, None)) for p, s in zip(self.parts, state, strict=True)]
                arc = self.arcs[state, c] = tuple(s for s, _ in steps), [e for _, e in steps if e is not None]
            state = arc[0]
            for e in arc[1]:
                counts[e] += 1
        return counts if any(s in p.final for p, s in zip(self.parts, state, strict=True)) else None


@cache
def grammar() -> Composed:
    return Composed(_grammar())


class Lookup:
    """Places of values in a sorted table. A sieve of the leading 20 bits spares most searches."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(table >> np.uint64(44)).astype(np.int64)] = True

    def places(self, values: np.ndarray) -> np.ndarray:
        """The place of each value, -1 if it isn't in the table."""
        out = np.full(len(values), -1)
        if len(self.table):
            maybe = np.flatnonzero(self.sieve[(values >> np.uint64(44)).astype(np.int64)])
            at = np.searchsorted(self.table, values[maybe])
            at[at == len(self.table)] = 0
            out[maybe] = np.where(self.table[at] == values[maybe], at, -1)
        return out


@cache
def fixed_classes() -> tuple[Lookup, np.ndarray]:
    """The word hashes of WORDS and their classes."""
    words = [(w, c) for c, text in WORDS.items() for w in text.split()]
    grid = WordGrid([w for w, _ in words])
    if (grid.words_per_text() != 1).any():
        raise ValueError("an entry of WORDS isn't a single word")
    order = np.argsort(grid.hashes)
    return Lookup(grid.hashes[order]), np.array([c for _, c in words])[order]


def pieces(grid: WordGrid) -> list[np.ndarray]:
    """For whole words and each stem length: a hash per word, 0 where the word is no longer than the stem."""
    out = [mix(grid.hashes + np.uint64(1))]
    for k in STEMS:
        long = grid.ends - grid.starts > k
        stem = np.zeros(len(grid.starts), np.uint64)
        stem[long] = mix(grid.hash_of(grid.starts[long], grid.starts[long] + k) + np.uint64(1 + k))
        out.append(stem)
    return out


def clause_events(texts: list[str], lexicon: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """(text, counts of EVENTS) of each matched clause of some texts."""
    grid = WordGrid(texts)
    classes = np.zeros(len(grid.starts), np.int64)
    fixed, kinds = fixed_classes()
    at = fixed.places(grid.hashes)
    classes[at >= 0] = kinds[at[at >= 0]]
    for own in pieces(grid):
        classes[lexicon.places(own) >= 0] = INSULT
    docs, counts = [], []
    hits = np.flatnonzero((classes == INSULT) | (classes == THREAT))
    if len(hits):
        ends = np.flatnonzero(np.isin(grid.points, [ord(x) for x in CLAUSE_ENDS]))
        clause = np.searchsorted(ends, grid.starts)
        first = np.searchsorted(clause, np.unique(clause[hits]), side="left")
        last = np.searchsorted(clause, clause[first], side="right")
        automaton = grammar()
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            if (found := automaton.events(classes[a:b].tolist())) is not None:
                docs.append(int(grid.doc[a]))
                counts.append(found)
    return np.array(docs, np.int64), np.array(counts, np.int64).reshape(-1, len(EVENTS))


def clause_scores(counts: np.ndarray, weights: np.ndarray = PRIOR) -> np.ndarray:
    return np.maximum(counts @ weights, LEAST)


def document_events(texts: list[str], lexicon: Lookup) -> np.ndarray:
    """Sums over the matched clauses of each text: EVENTS and the clauses."""
    out = np.zeros((len(texts), len(EVENTS) + 1))
    for a, b in spans(texts):
        doc, counts = clause_events(texts[a:b], lexicon)
        np.add.at(out, a + doc, np.concatenate([counts, np.ones((len(doc), 1))], 1))
    return out


def raw_scores(texts: list[str], lexicon: Lookup, weights: np.ndarray = PRIOR) -> np.ndarray:
    """log(1 + sum of clause scores) of each text."""
    out = np.zeros(len(texts))
    for a, b in spans(texts):
        doc, counts = clause_events(texts[a:b], lexicon)
        out[a:b] = np.bincount(doc, weights=clause_scores(counts, weights), minlength=b - a)
    return np.log1p(out)


def sample_of(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """Stored sample of labelled texts (doc_id, text, label) and the share that was taken of each label."""
    counts = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, SAMPLE_ROWS / n) for k, n in counts.items()}
    part = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) / 1_000_000
    taken = labels.where(F.coalesce(*[F.when(F.col("label") == k, part < s) for k, s in share.items()], F.lit(False)))
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(taken), "doc_id")  # at most about 2 * SAMPLE_ROWS ids
    return stored(rows, "toxicity-sample"), share


def votes_of(sample: DataFrame) -> DataFrame:
    """sample with a vote per row: one for all rows that share one of three minima of their three-word shingles."""

    def prints(batches):
        for batch in slices(batches, 1):
            texts = texts_of(batch.column(1))
            rows = []
            for a, b in spans(texts):
                for c in range(a, b, 4096):
                    part = texts[c : min(c + 4096, b)]
                    runs, doc = shingles(WordGrid(part), 3)
                    least = np.zeros((3, len(part)), np.uint64)
                    if len(runs):
                        begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                        for k in range(3):
                            least[k, doc[begin]] = np.minimum.reduceat(mix(runs + np.uint64(k)), begin)
                    rows.append(least.T)
            least = np.concatenate(rows) if rows else np.zeros((0, 3), np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(least[:, k].astype(np.int64)) for k in range(3)]], names=["doc_id", "text", "label", "f0", "f1", "f2"])

    rows = sample.select("doc_id", "text", "label").mapInArrow(prints, "doc_id long, text string, label int, f0 long, f1 long, f2 long")
    for k in range(3):
        size = rows.groupBy(f"f{k}").agg(F.count("*").alias(f"n{k}"))
        rows = rows.join(F.broadcast(size), f"f{k}")  # no more rows than the sample
    return rows.select("text", "label", (1 / F.greatest("n0", "n1", "n2")).alias("vote"))


def piece_votes(rows: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """(piece, votes): the votes of the texts that hold a piece."""

    def run(batches):
        wanted = None if only is None else Lookup(only)
        for batch in slices(batches, 0):
            texts, vote = texts_of(batch.column(0)), batch.column(1).to_numpy()
            found = []
            for a, b in spans(texts):
                grid = WordGrid(texts[a:b])
                for own in pieces(grid):
                    doc = grid.doc
                    if wanted is not None:
                        keep = wanted.places(own) >= 0
                        own, doc = own[keep], doc[keep]
                    order = np.lexsort((doc, own))
                    own, doc = own[order], doc[order]
                    fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])]) if len(own) else np.zeros(0, bool)
                    found.append((own[fresh], vote[a + doc[fresh]]))
            if not found:
                continue
            piece, back = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(piece.view(np.int64)), pa.array(np.bincount(back, weights=np.concatenate([x[1] for x in found]), minlength=len(piece)))], names=["piece", "votes"])

    return rows.select("text", "vote").mapInArrow(run, "piece long, votes double").where("piece <> 0").groupBy("piece").agg(F.sum("votes").alias("votes"))


@dataclass
class Model:
    lexicon: np.ndarray
    weights: np.ndarray
    slope: float
    base: float

    def score(self, texts: list[str], lexicon: Lookup) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.base + self.slope * raw_scores(texts, lexicon, self.weights))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and base of a ridge logistic regression, by Newton's method."""
    z = np.stack([x, np.ones(len(x))], 1)
    b = np.zeros(2)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag([0.05, 0.05]), z.T @ (weight * (y - p)) - 0.05 * b)
        b += step
    return float(b[0]), float(b[1])


def learn_weights(events: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60, ridge: float = 20.0) -> tuple[np.ndarray, float, float]:
    """Weights of EVENTS, slope and base: gradient steps on the weights, each with a new calibration, while the penalised likelihood rises.

    events: rows of document_events(). An event that the sample doesn't show keeps its prior weight.
    """

    def fitted(w: np.ndarray):
        total = np.maximum(events[:, :-1] @ w, LEAST * events[:, -1])
        slope, base = logistic(np.log1p(total), y, weight)
        slope = max(slope, 0.0)
        p = 1 / (1 + np.exp(-np.clip(base + slope * np.log1p(total), -30, 30)))
        fit = (weight * np.log(np.where(y == 1, p, 1 - p) + 1e-12)).sum() - ridge * ((w - PRIOR) ** 2).sum()
        pull = events[:, :-1].T @ (weight * (y - p) * slope / (1 + total)) - 2 * ridge * (w - PRIOR)
        return fit, slope, base, pull

    best, step = PRIOR.copy(), 0.2
    now = fitted(best)
    for _ in range(rounds):
        way = now[3] / max(np.abs(now[3]).max(), 1e-9)
        new = best + step * way
        new = np.where(PRIOR > 0, np.maximum(new, 0), np.minimum(new, 0))
        then = fitted(new)
        if then[0] > now[0]:
            best, now = new, then
        else:
            step /= 2
    return best, now[1], now[2]


def fit(docs: DataFrame, labels: DataFrame, candidates: int = CANDIDATES, entries: int = LEXICON) -> Model:
    """docs: doc_id, text. labels: doc_id, label, from labelled(). What reaches the driver is bounded by the sample, `candidates` and `entries`.

    candidates: pieces of toxic texts that are tested at most, those with most votes; entries: pieces of the lexicon at most, those of most gain.
    """
    sample, share = sample_of(docs, labels)
    rows = stored(votes_of(sample), "toxicity-votes")
    totals = {r["label"]: r["v"] for r in rows.groupBy("label").agg(F.sum("vote").alias("v")).collect()}
    none = Model(np.zeros(0, np.uint64), PRIOR, 0.0, -3.0)
    if not totals.get(1) or not totals.get(0):
        return none
    toxic = piece_votes(rows.where("label = 1")).where("votes >= 3").orderBy(F.desc("votes"), "piece").limit(candidates).collect()
    if not toxic:
        return none
    piece = np.array([r["piece"] for r in toxic], np.int64).view(np.uint64)
    bad = np.array([r["votes"] for r in toxic])
    order = np.argsort(piece)
    piece, bad = piece[order], bad[order]
    clean = np.zeros(len(piece))
    for r in piece_votes(rows.where("label = 0"), piece).collect():
        clean[np.searchsorted(piece, np.int64(r["piece"]).astype(np.uint64))] = r["votes"]
    chance = totals[1] / (totals[1] + totals[0])
    n = bad + clean
    gain = bad * np.log(bad / n / chance) + np.where(clean > 0, clean * np.log(np.maximum(clean, 1e-9) / n / (1 - chance)), 0)
    odds = np.log((bad + 0.5) / (totals[1] + 1)) - np.log((clean + 0.5) / (totals[0] + 1))
    chosen = np.flatnonzero((gain > np.log(len(piece)) + 5) & (odds > 2.5))
    chosen = chosen[np.argsort(-gain[chosen], kind="stable")][:entries]
    lexicon = np.sort(piece[chosen])

    def count(batches):
        own = Lookup(lexicon)
        for batch in slices(batches, 0):
            events = pa.array(list(document_events(texts_of(batch.column(0)), own)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([events, batch.column(1), batch.column(2)], names=["events", "label", "vote"])

    found = rows.select("text", "label", "vote").mapInArrow(count, "events array<double>, label int, vote double").collect()  # eleven numbers a sampled row
    y = np.array([r["label"] for r in found], float)
    weight = np.array([r["vote"] / share[r["label"]] for r in found])
    weights, slope, base = learn_weights(np.array([r["events"] for r in found]), y, weight / weight.sum() * len(weight))
    return Model(lexicon, weights, slope, base)


def score(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def run(batches):
        own = Lookup(model.lexicon)
        for batch in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(texts_of(batch.column(1)), own))], names=["doc_id", "score"])

    rows = small_batches(df).select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
