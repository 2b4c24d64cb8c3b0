"""Toxicity by a weighted finite-state pattern grammar.

Words are read as classes: insult, threat, target, negation, reported speech
and other. Five small transducers read the classes of a clause and put out
weights: an insult or a threat counts, a target near it adds, a negation just
before it and a verb of reported speech take away. Their composition is one
transducer over the tuples of their states; a clause scores the sum of its
weights, and nothing outside matched clauses counts.

Insults are learned as word stems from the labelled documents of the training
fold. The weights of a document's score come from logistic regression over the
same documents, each half of them read with the stems of the other, so that no
document is read with stems that it has taught; the score is then shifted so
that ``THRESHOLD`` parts these documents best. Scores read nothing but the text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpipe.llm.byte_bpe import slices
from eventpipe.llm.common import Scratch

# Labelled rows to learn from, at most about so many in each half (by hash of the id).
TRAIN_ROWS = 20_000
STEM_CHARS = (4, 5, 6, 7, 8)
MAX_STEMS = 4_000
# A stem must be in so many toxic documents, and in so large a share of them.
MIN_STEM_DOCS = 4
MIN_STEM_SHARE = 0.01
MIN_STEM_LOG_ODDS = 2.5
THRESHOLD = 0.7
HELD_OUT = 1
FIXED_WEIGHTS = (-4.0, 1.0, 1.0, 1.0)

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, AUXILIARY = range(7)
# Closed classes of the grammar in four languages.
WORDS = {
    THREAT: "kill hurt destroy beat burn shoot stab crush töten umbringen schlagen tuer frapper matar golpear",
    TARGET: "you your yours youre u he she they him them his her their these those people du dich dir ihr euch sie "
    "tu te toi vous ils elles tú ti usted ustedes ellos ellas",
    NEGATION: "not no never none isnt arent wasnt dont nicht kein keine keinen nie ne pas jamais aucun nunca jamás ningún",
    REPORT: "said says say told called calls wrote writes claimed quoted quote sagte sagt schrieb nannte dit disait "
    "écrit appelé dijo dice escribió llamó",
    AUXILIARY: "will gonna shall should must werde wirst sollte vais devrait voy debería",
}
CLAUSE = re.compile(r"[.!?;:,()\[\]{}\"“”«»\n]+")
# A word with its apostrophes ("isn't", "don’t"); elided words before one ("l'", "qu'") stand for themselves.
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
ELIDED = frozenset("l d j t s m n c qu lorsqu puisqu jusqu".split())

State = tuple
Rule = dict[tuple[int, int], tuple[int, float]]


@dataclass(frozen=True)
class Transducer:
    """Rules (state, class) -> (next state, weight); a class without a rule goes to ``rest`` or stays, for no weight."""

    rules: Rule
    rest: dict[int, int]

    def step(self, state: int, kind: int) -> tuple[int, float]:
        return self.rules.get((state, kind), (self.rest.get(state, state), 0.0))


# An insult counts wherever it stands.
INSULTS = Transducer({(0, INSULT): (0, 1.0)}, {})
# A threat counts once it meets its target, and for more after "will" and the like; killing a process is none.
THREATS = Transducer(
    {(0, AUXILIARY): (1, 0.0), (1, THREAT): (2, 0.0), (2, TARGET): (1, 1.5), (0, THREAT): (3, 0.0), (3, TARGET): (0, 1.0)},
    {},
)
# A target before an insult, or within three words after it, adds once for each insult.
TARGETS = Transducer(
    {
        (0, TARGET): (1, 0.0), (1, INSULT): (1, 0.5),
        (0, INSULT): (2, 0.0), (2, TARGET): (1, 0.5), (3, TARGET): (1, 0.5), (4, TARGET): (1, 0.5),
        (2, INSULT): (2, 0.0), (3, INSULT): (2, 0.0), (4, INSULT): (2, 0.0),
    },
    {2: 3, 3: 4, 4: 0},
)
# A negation reaches three words; what it reaches counts for little.
NEGATIONS = Transducer(
    {(s, NEGATION): (1, 0.0) for s in range(5)}
    | {(s, INSULT): (s + 1 if s < 3 else 0, -0.8) for s in (1, 2, 3)}
    # A threat that is negated is none, whatever target follows.
    | {(s, THREAT): (4, 0.0) for s in (1, 2, 3)}
    | {(4, TARGET): (0, -1.5)},
    {1: 2, 2: 3, 3: 0},
)
# After a verb of reported speech the clause speaks of others' words.
REPORTS = Transducer({(0, REPORT): (1, 0.0), (1, INSULT): (1, -0.6), (1, THREAT): (1, -0.6)}, {})


class Composed:
    """Several transducers read side by side; rules over tuples of states are made as they are met."""

    def __init__(self, *parts: Transducer):
        self.parts = parts
        self.start: State = (0,) * len(parts)
        self.rules: dict[tuple[State, int], tuple[State, float]] = {}

    def step(self, state: State, kind: int) -> tuple[State, float]:
        key = (state, kind)
        if key not in self.rules:
            moves = [part.step(s, kind) for part, s in zip(self.parts, state)]
            self.rules[key] = (tuple(s for s, _ in moves), sum(w for _, w in moves))
        return self.rules[key]


@dataclass(frozen=True)
class Grammar:
    """What is learned: insult stems with their log-odds, and the document score's weights."""

    stems: dict[str, float]
    weights: tuple[float, ...] = ()


def words_of(clause: str) -> list[str]:
    """Words of a lower-case clause, apostrophes taken out of them."""
    words = []
    for word in WORD.findall(clause):
        if "'" not in word and "’" not in word:
            words.append(word)
            continue
        parts = word.replace("’", "'").split("'")
        while len(parts) > 1 and parts[0] in ELIDED:
            words.append(parts.pop(0))
        words.append("".join(parts))
    return words


class Reader:
    """Reads texts by one grammar within a worker."""

    def __init__(self, grammar: Grammar):
        self.stems = grammar.stems
        self.lengths = sorted({len(s) for s in self.stems})
        self.closed = {w: kind for kind, words in WORDS.items() for w in words.split()}
        self.machine = Composed(INSULTS, THREATS, TARGETS, NEGATIONS, REPORTS)
        self.known: dict[str, tuple[int, float]] = {}

    def kind(self, word: str) -> tuple[int, float]:
        """Class and strength of a word; stems go before closed classes."""
        if word not in self.known:
            if len(self.known) > 300_000:
                self.known.clear()
            stem = next((word[:n] for n in self.lengths if word[:n] in self.stems), None)
            if stem is not None:
                self.known[word] = (INSULT, self.stems[stem])
            else:
                self.known[word] = (self.closed.get(word, OTHER), 1.0)
        return self.known[word]

    def clause(self, words: list[str]) -> float:
        """What the composed transducer puts out, each insult's part times its strength; at least 0."""
        state, total = self.machine.start, 0.0
        for word in words:
            kind, strength = self.kind(word)
            state, weight = self.machine.step(state, kind)
            total += weight * strength
        return max(total, 0.0)

    def features(self, text: str) -> tuple[float, float, float, float]:
        """1, best clause, log of the sum over matched clauses, log of that sum per thousand words."""
        best = total = 0.0
        n_words = 0
        for clause in CLAUSE.split(text.lower()):
            words = words_of(clause)
            n_words += len(words)
            kinds = {self.kind(w)[0] for w in words}
            if INSULT in kinds or THREAT in kinds:
                score = self.clause(words)
                best, total = max(best, score), total + score
        return 1.0, best, math.log1p(total), math.log1p(1000.0 * total / max(n_words, 50))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def training_rows(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(toxic, half, text) of labelled rows outside the held-out fold: all, or by hash about ``2 * TRAIN_ROWS``."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    own = own.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    share = min(1.0, 2.0 * TRAIN_ROWS / max(own.count(), 1))
    own = scratch.settle(own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000), "labelled")
    # A row is an id and a digit, their number is bounded above: under 1 MB.
    return docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").select(
        "toxic", (fold(F.col("doc_id")) == 0).alias("half"), F.coalesce("text", F.lit("")).alias("text")
    )


def learn_stems(rows: DataFrame, scratch: Scratch) -> list[dict[str, float]]:
    """Stems that are far more frequent in toxic documents, with their log-odds from 0 to 1: of one half, the other, and all.

    One aggregate over the stems of each document: documents that have a stem
    against all of their kind, so one that repeats a word counts once, and so do
    copies.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    least = [F.array_min(F.transform("words", lambda w, i=i: F.xxhash64(F.lit(i), w))) for i in (1, 2)]
    halves = [F.max(F.col("half").cast("int")).alias("h0"), F.max((~F.col("half")).cast("int")).alias("h1")]
    seen = rows.select("toxic", "half", words.alias("words")).withColumn("group", F.xxhash64(*least))
    groups = seen.groupBy("toxic", "group").agg(*halves).groupBy("toxic").agg(F.sum("h0"), F.sum("h1"), F.count("*"))
    totals = {r["toxic"]: tuple(r)[1:] for r in groups.collect()}
    stems = F.array_distinct(
        F.flatten(
            F.transform("words", lambda w: F.filter(F.array(*[F.substr(w, F.lit(1), F.lit(n)) for n in STEM_CHARS]), lambda s: F.char_length(s) >= STEM_CHARS[0]))
        )
    )
    found = seen.select("toxic", "half", "group", F.explode(stems).alias("stem")).groupBy("toxic", "group", "stem").agg(*halves)
    parts = (F.col("h0"), F.col("h1"), F.lit(1))
    sums = [F.sum(part * kind).alias(f"{name}{i}") for i, part in enumerate(parts) for name, kind in (("a", F.col("toxic")), ("b", 1 - F.col("toxic")))]
    counted = scratch.settle(found.groupBy("stem").agg(*sums), "stems")
    return [_strong_stems(counted, i, {kind: t[i] for kind, t in totals.items()}) for i in range(len(parts))]


def _strong_stems(counted: DataFrame, i: int, groups: dict[int, int]) -> dict[str, float]:
    if not (groups.get(0) and groups.get(1)):
        return {}
    a, b = F.col(f"a{i}"), F.col(f"b{i}")
    odds = F.log((a + 0.5) / (groups[1] + 1)) - F.log((b + 0.5) / (groups[0] + 1))
    strong = (
        counted.where(a >= max(MIN_STEM_DOCS, MIN_STEM_SHARE * groups[1]))
        .select("stem", odds.alias("odds"))
        .where(F.col("odds") >= MIN_STEM_LOG_ODDS)
        .orderBy(F.desc("odds"), "stem")
        .limit(MAX_STEMS)
    )
    found = {row["stem"]: min(row["odds"], 6.0) / 6.0 for row in strong.collect()}
    # The shortest stem speaks for its longer forms.
    return {s: w for s, w in found.items() if not any(s[:n] in found for n in range(1, len(s)))}


def fit(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; a feature that would count against toxicity is left out."""
    used = list(range(x.shape[1]))
    while True:
        own, w = x[:, used], np.zeros(len(used))
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(own @ w, -30, 30)))
            hessian = (own * (p * (1 - p))[:, None]).T @ own + ridge * np.eye(len(used))
            w += np.linalg.solve(hessian, own.T @ (y - p) - ridge * w)
        worst = min(range(1, len(used)), key=lambda i: w[i], default=0)
        if worst == 0 or w[worst] >= 0:
            out = np.zeros(x.shape[1])
            out[used] = w
            return out
        del used[worst]


def with_features(frame: DataFrame, grammar: Grammar, keep: str) -> DataFrame:
    """(keep, f) with the features of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(grammar)
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                values = pa.array([list(reader.features(t)) for t in texts], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), values], names=[keep, "f"])

    kind = frame.schema[keep].dataType.simpleString()
    return frame.select(keep, "text").mapInArrow(run, f"{keep} {kind}, f array<double>")


def learn(docs: DataFrame, labels: DataFrame) -> Grammar:
    """A grammar from the labelled rows outside the held-out fold.

    Without labels of both kinds the score's weights are fixed ones.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    rows = scratch.settle(training_rows(docs, labels, scratch), "rows")
    first, second, every = learn_stems(rows, scratch)
    seen = with_features(rows.where(~F.col("half")), Grammar(first), "toxic").collect()
    seen += with_features(rows.where("half"), Grammar(second), "toxic").collect()
    grammar = Grammar(every)
    scratch.remove()
    # Copies of a document give the same features many times; each kind of them counts once.
    kinds = sorted({(r["toxic"], tuple(r["f"])) for r in seen})
    y = np.array([toxic for toxic, _ in kinds], dtype=float)
    if 0 < y.sum() < len(y):
        x = np.array([f for _, f in kinds])
        weights = fit(x, y)
        if weights[1:].any():
            weights[0] += math.log(THRESHOLD / (1 - THRESHOLD)) - best_cut(x @ weights, y)
            return Grammar(grammar.stems, tuple(weights.tolist()))
    return Grammar(grammar.stems, FIXED_WEIGHTS)


def best_cut(scores: np.ndarray, y: np.ndarray) -> float:
    """The value between two scores that parts the toxic from the others with the largest F1; of equals the middle one."""
    order = np.argsort(-scores, kind="stable")
    ranked, hits = scores[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    ends = np.append(ranked[:-1] > ranked[1:], True)  # a cut parts no equal scores
    best = np.flatnonzero(ends & (f1 >= f1[ends].max() - 1e-12))
    at = best[len(best) // 2]
    below = ranked[at + 1] if at + 1 < len(ranked) else ranked[at] - 1.0
    return float((ranked[at] + below) / 2)


def score_toxicity(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text, more).

    A null or empty text has no matched clause and scores as such. A null
    doc_id is in no fold: ``held_out`` is null. Repeated rows score alike,
    other columns are ignored, an empty table gives an empty one.
    """
    score = F.lit(0.0)
    for i, weight in enumerate(grammar.weights):
        score = score + F.col("f")[i] * weight
    return with_features(docs, grammar, "doc_id").select(
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        (1 / (1 + F.exp(-score))).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, learned from ``labels``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_toxicity(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
