import random
import zlib

import pytest

from eventpipe.llm import toxicity as X
from eventpipe.llm.toxicity import Grammar, Reader, learn, score_toxicity, words_of

DOCS, LABELS = "doc_id bigint, text string", "doc_id bigint, toxic int"
STEMS = {"idio": 1.0, "lowei": 1.0}


@pytest.fixture(scope="module")
def reader():
    return Reader(Grammar(STEMS))


def score(reader, text):
    return reader.clause(text.lower().split())


def test_targets_add_and_negations_and_reports_take_away(reader):
    plain = score(reader, "what an idiot")
    assert plain > 0
    assert score(reader, "you are an idiot") > plain
    assert score(reader, "idiot you are") > plain
    assert score(reader, "he is not an idiot") < score(reader, "he is an idiot")
    assert score(reader, "she said idiot") < plain
    assert score(reader, "the weather is fine") == 0


def test_threats_need_their_parts(reader):
    assert score(reader, "i will kill you") > 0
    assert score(reader, "to kill time") == 0
    assert score(reader, "kill you") > 0


def slow_weights(kinds):
    """What a clause of word classes weighs, rule by rule and without states."""
    total = 0.0
    for i, kind in enumerate(kinds):
        before = kinds[:i]
        if kind == X.INSULT:
            total += 1.0
            total += 0.5 * (X.TARGET in before)
            total -= 0.6 * (X.REPORT in before)
        if kind == X.THREAT:
            total -= 0.6 * (X.REPORT in before)
        if kind == X.TARGET and X.TARGET not in before and X.INSULT in kinds[max(0, i - 3) : i]:
            total += 0.5
    auxiliary, pending = False, None
    for kind in kinds:
        if kind == X.AUXILIARY and pending is None:
            auxiliary = True
        elif kind == X.THREAT and pending is None:
            pending = 1.5 if auxiliary else 1.0
        elif kind == X.TARGET and pending is not None:
            total, pending = total + pending, None
    reach, held = 0, False
    for kind in kinds:
        if kind == X.NEGATION:
            reach, held = 3, False
        elif held:
            if kind == X.TARGET:
                total, held = total - 1.5, False
        elif reach:
            reach -= 1
            if kind == X.INSULT:
                total -= 0.8
            if kind == X.THREAT:
                reach, held = 0, True
    return total


def test_the_composed_transducer_against_a_slow_reading():
    r = random.Random(2)
    machine = X.Composed(X.INSULTS, X.THREATS, X.TARGETS, X.NEGATIONS, X.REPORTS)
    for _ in range(20_000):
        kinds = r.choices(range(7), k=r.randint(0, 9))
        state, total = machine.start, 0.0
        for kind in kinds:
            state, weight = machine.step(state, kind)
            total += weight
        assert abs(total - slow_weights(kinds)) < 1e-9, kinds


def test_apostrophes(reader):
    def best(text):
        return reader.features(text)[1]

    assert words_of("he isn't l'idiot d’accord qu'il don’t rock'n'roll j'") == ["he", "isnt", "l", "idiot", "d", "accord", "qu", "il", "dont", "rocknroll", "j"]
    assert best("he isn't an idiot") == best("he is not an idiot") < best("he is an idiot")
    assert best("I don't say: you idiot") == best("you idiot")
    assert best("tu es l'idiot") > 0


def test_killing_a_process_is_no_threat(reader):
    assert reader.features("I will kill the process.")[1] == 0
    assert reader.features("I will kill you.")[1] == 1.5
    assert reader.features("I will never kill you.")[1] == 0


def test_a_word_that_one_document_repeats_is_no_stem(spark):
    docs, labels = corpus(300)
    docs = [(i, t + " repeated" * 500 if i == 0 else t + " repeated" if i % 4 == 1 else t) for i, t in docs]
    grammar = learn(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert any(s.startswith("grob") for s in grammar.stems) and not any(s.startswith("repe") for s in grammar.stems)


def test_the_cut_is_where_toxic_ones_part_best():
    import numpy as np

    assert X.best_cut(np.array([5.0, 4, 1, 0]), np.array([1.0, 1, 0, 0])) == 2.5
    assert X.best_cut(np.array([5.0, 5, 1, 0]), np.array([1.0, 0, 1, 0])) == 0.5
    assert X.best_cut(np.array([1.0, 1.0]), np.array([1.0, 0.0])) == 0.5


def test_a_negation_does_not_reach_another_clause(reader):
    assert reader.features("not now. an idiot")[1] > reader.features("not an idiot")[1]


def corpus(n, seed=1):
    r = random.Random(seed)
    plain = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}om" for i in range(300)]
    bad = ["grobal", "grobish", "grobon", "zanky", "zankful"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [r.choice(plain) for _ in range(60)]
        if toxic:
            for _ in range(4):
                words[r.randrange(60)] = r.choice(bad)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus(900)
    frame = spark.createDataFrame(docs, DOCS)
    out = score_toxicity(frame, learn(frame, spark.createDataFrame(labels, LABELS))).collect()
    truth = dict(labels)
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)


def test_held_out_labels_are_not_used(spark):
    docs, labels = corpus(300)
    frame = spark.createDataFrame(docs, DOCS)
    spoilt = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    a, b = (learn(frame, spark.createDataFrame(x, LABELS)) for x in (labels, spoilt))
    assert a == b


def test_nulls_empty_and_repeated_rows(spark):
    docs, labels = corpus(60)
    learned = learn(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels + [(None, 1), (3, None)], LABELS))
    rows = [(1, None), (2, ""), (None, "x"), (4, "grobal " * 50_000), (4, "grobal " * 50_000)]
    out = score_toxicity(spark.createDataFrame(rows, DOCS), learned).collect()
    assert len(out) == 5 and all(r.score is not None for r in out)
    assert [r.held_out for r in out if r.doc_id is None] == [None]
    empty = spark.createDataFrame([], DOCS)
    nothing = learn(empty, spark.createDataFrame([], LABELS))
    assert score_toxicity(empty, nothing).collect() == []
    clash = spark.createDataFrame([(1, "a", 2, 3)], DOCS + ", f int, score int")
    assert score_toxicity(clash, nothing).columns == ["doc_id", "held_out", "score", "predicted"]
