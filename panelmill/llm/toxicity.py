"""Toxicity by a weighted finite-state grammar over the clauses of a text.

Words become symbols: insult, threat, target, negation, report, other; clause ends are symbols too. Small transducers for
negation, reported speech, targets and threats rewrite them (an insult under a negation is a denied insult, one in
reported speech a quoted insult, one beside a person an aimed insult) and weigh what they rewrite. They are composed into one
machine, which runs over the clauses that hold an insult or a threat. A text's features are the weights of its
matched clauses by kind; a logistic regression, fitted to labelled rows, scores them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import bounded_sample, held_out
from .shared import bounded_batches, table
from .textkernel import PIECE, WordHasher, slices, texts

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END, DENIED, QUOTED, AIMED = range(10)

# Words that begin the lexicons of English, German, French and Spanish.
_WORDS = {
    INSULT: "idiot idiots moron morons stupid loser losers scum trash pathetic disgusting worthless clown clowns dumb imbecile "
    "dumm dummkopf trottel abschaum versager idioot imbécile crétin ordure minable abruti estúpido imbécil basura escoria",
    THREAT: "kill hurt destroy smash beat murder töten umbringen verprügeln tuer frapper détruire matar golpear destruir",
    TARGET: "you your yours yourself u he she they them him her people du dich dir ihr euch sie tu te toi vous votre tú te usted ustedes vosotros",
    NEGATION: "not no never isn aren wasn don doesn nobody nicht kein keine nie ne pas jamais aucun nunca jamás ninguno",
    REPORT: "said says say told tells wrote writes quoted according claimed sagte sagt schrieb dit disait écrit selon dijo dice escribió según",
}
_ENDS = b".!?;\n"


@dataclass(frozen=True)
class ToxicityParams:
    """Bound of the training sample, rows a learned insult must be in, its least log odds, and the regression's ridge."""

    sample_rows: int = 8000
    least_rows: int = 4
    least_odds: float = 2.0
    ridge: float = 1.0


# --- transducers ----------------------------------------------------------------------------------------------------


@dataclass
class Transducer:
    """A deterministic weighted transducer from state 0: (state, symbol) to (state, output, log weight).

    A symbol without an entry passes unchanged, and the state stays.
    """

    steps: dict[tuple[int, int], tuple[int, int, float]] = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        return self.steps.get((state, symbol), (state, symbol, 0.0))


def negation(reach: int = 3) -> Transducer:
    """Insults and threats up to ``reach`` words after a negation are denied."""
    steps = {}
    for s in range(reach + 1):
        steps[s, NEGATION] = (reach, NEGATION, 0.0)
        steps[s, END] = (0, END, 0.0)
        if s:
            for symbol in (OTHER, TARGET, REPORT):
                steps[s, symbol] = (s - 1, symbol, 0.0)
            steps[s, INSULT] = (0, DENIED, -1.0)
            steps[s, THREAT] = (0, OTHER, 0.0)
    return Transducer(steps)


def reported() -> Transducer:
    """Insults and threats after a verb of report, up to the end of the clause, are quoted."""
    return Transducer(
        {(0, REPORT): (1, REPORT, 0.0), (1, END): (0, END, 0.0), (1, INSULT): (1, QUOTED, -0.7), (1, DENIED): (1, QUOTED, -0.7), (1, THREAT): (1, OTHER, 0.0)}
    )


def aimed(reach: int = 4) -> Transducer:
    """Insults up to ``reach`` words after a person are aimed; threats count only with a person right after them."""
    steps = {}
    for s in range(reach + 1):
        steps[s, TARGET] = (reach, TARGET, 0.0)
        steps[s, END] = (0, END, 0.0)
        steps[s, THREAT] = (reach + 1, OTHER, 0.0)
        if s:
            for symbol in (OTHER, NEGATION, REPORT, DENIED, QUOTED):
                steps[s, symbol] = (s - 1, symbol, 0.0)
            steps[s, INSULT] = (s, AIMED, 0.4)
    waiting = reach + 1
    steps |= {(waiting, x): (0, x, 0.0) for x in (OTHER, NEGATION, REPORT, END, INSULT, DENIED, QUOTED)}
    steps[waiting, TARGET] = (reach, THREAT, 0.0)
    steps[waiting, THREAT] = (waiting, OTHER, 0.0)
    return Transducer(steps)


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The transducer that feeds a's output to b; weights add up. Only states that can be reached are built."""
    numbers, todo, steps = {(0, 0): 0}, [(0, 0)], {}
    for s, t in todo:
        for symbol in range(10):
            s2, middle, w = a.step(s, symbol)
            t2, out, v = b.step(t, middle)
            if (s2, t2) not in numbers:
                numbers[s2, t2] = len(numbers)
                todo.append((s2, t2))
            steps[numbers[s, t], symbol] = (numbers[s2, t2], out, w + v)
    return Transducer(steps)


def grammar() -> Transducer:
    return compose(compose(negation(), reported()), aimed())


@dataclass(frozen=True)
class Machine:
    """A transducer as tables by state and symbol, run over many sequences of symbols at once."""

    after: np.ndarray
    output: np.ndarray
    weight: np.ndarray
    start: int  # END leads every state there
    settled: int  # after so many OTHER words in a row another one changes nothing

    @staticmethod
    def of(t: Transducer) -> Machine:
        n = 1 + max(max(s, step[0]) for (s, _), step in t.steps.items())
        steps = [[t.step(s, x) for x in range(10)] for s in range(n)]
        after, output, weight = (np.array([[step[i] for step in row] for row in steps]) for i in range(3))
        settled, state = 0, np.arange(n)
        while (after[state, OTHER] != state).any():
            settled, state = settled + 1, after[state, OTHER]
        return Machine(after, output, np.exp(weight), int(after[0, END]), settled)

    def run(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Output and weight of every symbol; sequences begin at ``starts``, each in the start state.

        Sequences advance together, the longest first; a sequence that goes on alone is walked by itself.
        """
        lengths = np.diff(np.append(starts, len(symbols)))
        order = np.argsort(-lengths, kind="stable")
        at, left = starts[order], lengths[order]
        output, weight = np.empty(len(symbols), np.int64), np.empty(len(symbols))
        state, j = np.full(len(at), self.start), 0
        live = int(np.count_nonzero(left > 0))
        while live > 8:
            here = at[:live] + j
            seen = symbols[here]
            output[here], weight[here] = self.output[state[:live], seen], self.weight[state[:live], seen]
            state[:live] = self.after[state[:live], seen]
            j += 1
            live = int(np.searchsorted(-left, -j, "left"))
        after, out, w = self.after.tolist(), self.output.tolist(), self.weight.tolist()
        for k in range(live):
            s = int(state[k])
            for i, x in enumerate(symbols[at[k] + j : at[k] + left[k]].tolist(), int(at[k]) + j):
                output[i], weight[i], s = out[s][x], w[s][x], after[s][x]
        return output, weight


# --- features -------------------------------------------------------------------------------------------------------

_KINDS = (INSULT, AIMED, DENIED, QUOTED, THREAT)
N_FEATURES = len(_KINDS) + 3


def word_key(word: str) -> int:
    hashes = WordHasher().words(*texts(pa.array([word])))[0]
    return int(hashes[0]) if len(hashes) == 1 else 0


@dataclass(frozen=True)
class Lexicon:
    """Hashes of the words, sorted, with their symbols and weights."""

    keys: np.ndarray
    symbols: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of(learned: dict[int, float]) -> Lexicon:
        """The fixed words and the learned insults; a fixed word keeps its symbol, an insult among them takes the learned weight."""
        entries = {word_key(w): (symbol, 1.0) for symbol, words in _WORDS.items() for w in words.split()}
        entries |= {k: (INSULT, w) for k, w in learned.items() if entries.get(k, (INSULT,))[0] == INSULT}
        entries.pop(0, None)
        keys = np.array(sorted(entries), np.uint64)
        return Lexicon(keys, np.array([entries[int(k)][0] for k in keys]), np.array([entries[int(k)][1] for k in keys]))


def _features(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher, lexicon: Lexicon, machine: Machine) -> np.ndarray:
    """Texts by features: weights of matched clauses by kind, their largest, their number, and their share of the words.

    A clause ends at ``.!?;`` or a newline and has no bound: a text without them is one, walked whole.
    """
    words, begin, end, at = hasher.words(data, offsets)
    out = np.zeros((len(offsets) - 1, N_FEATURES))
    if not len(words):
        return out
    place = np.minimum(np.searchsorted(lexicon.keys, words), len(lexicon.keys) - 1)
    known = lexicon.keys[place] == words
    symbols = np.where(known, lexicon.symbols[place], OTHER)
    hot = np.flatnonzero((symbols == INSULT) | (symbols == THREAT))
    if not len(hot):
        return out
    member = np.zeros(256, bool)
    member[list(_ENDS)] = True
    marks = np.concatenate([[0], np.cumsum(member[data])])
    first = np.ones(len(words), bool)  # of its clause
    first[1:] = marks[begin[1:]] > marks[end[:-1]]
    first[at[(at < len(words))]] = True
    clause = np.cumsum(first) - 1
    matched = np.zeros(int(clause[-1]) + 1, bool)
    matched[clause[hot]] = True
    # of OTHER words in a row those that change no state are passed over, so that a clause counts by the words of the grammar in it
    named = np.flatnonzero(symbols != OTHER)
    since = np.arange(len(symbols)) - np.concatenate([[-1], named])[np.searchsorted(named, np.arange(len(symbols)), "right")]
    since = np.minimum(since, np.arange(len(symbols)) - np.flatnonzero(first)[clause] + 1)
    used = np.flatnonzero(matched[clause] & (since <= machine.settled))
    own = clause[used]
    kind, weight = machine.run(symbols[used], np.flatnonzero(np.diff(own, prepend=-1)))
    number = np.cumsum(np.diff(own, prepend=-1) > 0) - 1  # of the matched clause
    found = np.zeros((int(number[-1]) + 1, len(_KINDS)))
    for k, name in enumerate(_KINDS):
        is_kind = kind == name
        lexical = np.where(symbols[used] == INSULT, lexicon.weights[place[used]], 1.0)
        np.add.at(found[:, k], number[is_kind], (lexical * weight)[is_kind])
    text = np.searchsorted(at, used[np.flatnonzero(np.diff(own, prepend=-1))], "right") - 1
    for k in range(len(_KINDS)):
        np.add.at(out[:, k], text, found[:, k])
    best = found.max(axis=1)
    np.maximum.at(out[:, -3], text, best)
    np.add.at(out[:, -2], text, (best > 0).astype(float))
    out[:, -1] = 100 * out[:, -2] / np.maximum(np.diff(at), 20)
    out[:, : len(_KINDS)] = np.log1p(out[:, : len(_KINDS)])
    out[:, -2:] = np.log1p(out[:, -2:])
    return out


# --- learning -------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different words of every row, by their hashes, with the row's label."""
    hasher = WordHasher()
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        labels = np.asarray(batch.column("label"))
        for a, b in slices(offsets):
            words, _, _, at = hasher.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            own = [np.unique(words[at[i] : at[i + 1]]) for i in range(b - a)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(own).view(np.int64)), pa.array(np.repeat(labels[a:b], [len(x) for x in own]), pa.int32())], names=["word", "label"]
            )


def _learned_insults(sample: DataFrame, n: tuple[int, int], p: ToxicityParams) -> dict[int, float]:
    """Words that toxic rows have far more often than others, with their log odds, at most 3; ``n`` counts the sample's rows by label."""
    counts = sample.mapInArrow(_words, "word long, label int").groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n[1] + 1)) - F.log((F.col("b") + 0.5) / (n[0] + 1))
    found = counts.withColumn("odds", odds).filter((F.col("a") >= p.least_rows) & (F.col("odds") >= p.least_odds))
    return {r["word"] % (1 << 64): min(3.0, r["odds"]) for r in found.collect()}


def _measurer(lexicon: Lexicon):
    """The features of every row, as one array, with its label."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, machine = WordHasher(), Machine.of(grammar())
        for batch in batches:
            x = _batch_features(batch, hasher, lexicon, machine)
            ends = np.arange(0, x.size + 1, N_FEATURES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))], names=["label", "x"])

    return measure


def _batch_features(batch: pa.RecordBatch, hasher: WordHasher, lexicon: Lexicon, machine: Machine) -> np.ndarray:
    data, offsets = texts(batch.column("text"))
    x = [_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], hasher, lexicon, machine) for a, b in slices(offsets, PIECE)]
    return np.concatenate(x) if x else np.empty((0, N_FEATURES))


def _regression(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (q * (1 - q))[:, None]) + penalty, z.T @ (q - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams | None = None) -> ToxicityModel:
    """Learn from a bounded sample of the labelled rows that aren't held out.

    ``docs(doc_id, text, ...)`` and ``labels(doc_id, toxic, ...)``; labels other than 0 and 1 are ignored. Words that
    toxic rows have far more often join the insults, with their log odds as weights; words of the grammar stay what they
    are. Tasks count words and measure texts: the driver gets ids, words of at least ``least_rows`` rows of the sample and
    ``N_FEATURES`` numbers a row, never a text. A repeated label of a document counts once, rows that share a doc_id all teach.
    Without both labels the score is the share of 1.
    """
    p = params or ToxicityParams()
    known = labels.select("doc_id", F.col("toxic").alias("label")).filter("label in (0, 1)").filter(~held_out(F.col("doc_id"))).distinct()
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    # the sample is drawn from the labels alone; its ids, sample_rows at most, are sent to the texts
    chosen = [(r["doc_id"], r["label"]) for r in bounded_sample(known, "label", ["doc_id"], p.sample_rows)]
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id long, label int")
    sample = table(bounded_batches(docs).select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("label", "text"), "labelled")
    drawn = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(drawn) < 2:
        share = (n.get(1, 0) + 0.5) / (sum(n.values()) + 1)
        return ToxicityModel(Lexicon.of({}), np.zeros(N_FEATURES), float(np.log(share / (1 - share))))
    lexicon = Lexicon.of(_learned_insults(sample, (drawn[0], drawn[1]), p))
    rows = sorted((tuple(r["x"]), r["label"]) for r in sample.mapInArrow(_measurer(lexicon), "label int, x array<double>").collect())
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    weights, bias = _regression(x, y, p.ridge)
    return ToxicityModel(lexicon, weights, bias + np.log(n[1] / n[0]) - np.log(y.sum() / (len(y) - y.sum())))


def _scorer(model: ToxicityModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, machine = WordHasher(), Machine.of(grammar())
        for batch in batches:
            z = _batch_features(batch, hasher, model.lexicon, machine) @ model.weights + model.bias
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))], names=["doc_id", "held_out", "score"]
            )

    return score


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id long, text string, ...)``.

    score is from 0 to 1, predicted is 1 from 0.5 on. Only the text is used; null and empty texts have no clauses and get
    the score of a text without a match. Repeated rows are scored alike; an empty table gives no rows.
    """
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    out = rows.mapInArrow(_scorer(model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, params: ToxicityParams | None = None) -> DataFrame:
    """``score`` with a model that ``fit`` learns from ``labels``."""
    return score(docs, fit(docs, labels, params))
