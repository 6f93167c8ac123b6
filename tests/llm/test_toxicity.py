from __future__ import annotations

import random
import re

import pytest

from farekit.llm import queries, toxicity
from farekit.llm.toxicity import Lexicon, clause_scores
from tests.llm.cases import ODD, crowded, docs

LEXICON = Lexicon({"idio": 2.0, "scum$": 3.0, "skin$": 4.0}, ["skin$"])


def total(text):
    return sum(clause_scores(text, LEXICON)[0])


def test_clauses_weigh_what_the_grammar_says():
    plain = total("An idiot came.")
    assert plain == 2.0 and total("Idiotic scum!") == 2.0 + 3.0 * 1.2 and total("scummy") == 0
    assert total("He is not an idiot.") < plain < total("You are an idiot.")
    assert total("She said he is an idiot.") < total("He is an idiot.")
    assert total("He is an idiot, she said.") < total("He is an idiot, she laughed.")
    assert total("It is not so. An idiot came.") == plain
    assert total("nothing here") == total("") == total("...") == 0


def test_insults_count_on_either_side_of_whom_they_mean():
    assert total("idiot, you are") == total("you, there, idiot") == total("you idiot") > total("an idiot")


def test_threats_have_a_subject_and_an_object():
    order = ["I will hurt you", "hurt you", "I hurt you", "he was told to hurt you", "you hurt", "they hurt"]
    scores = [total(t) for t in order]
    assert scores == sorted(scores, reverse=True) and scores[0] > 2 * scores[3] and scores[0] > 8 * scores[-1]
    assert total("kill yourself") == total("kill the lot of you") * 2 > total("you kill it on stage") * 4
    assert total("I will never hurt you") < total("I will hurt you") and total("kill time") > 0
    assert total("I will skin you") > total("you have skin") > 0
    assert total("ich werde dich töten") > 0 and total("I will. Hurt you.") < total("I will hurt you.")


# The grammar said again, word by word: what counts for a word is looked up in its clause.
def brute_clause(words):
    score = 0.0
    for i, (kind, weight) in enumerate(words):
        before, behind = [k for k, _ in words[:i]], [k for k, _ in words[i + 1 :]]
        if kind not in (toxicity.INSULT, toxicity.THREAT):
            continue
        if toxicity.NEGATION in before[-3:]:
            weight *= 0.25
        weight *= (0.5 if toxicity.REPORT in before else 1) * (0.5 if toxicity.REPORT in behind else 1)
        if kind == toxicity.INSULT:
            weight *= (1.25 if toxicity.TARGET in before else 1) * (1.25 if toxicity.TARGET in behind else 1)
            for near, k in enumerate(reversed(before)):
                if k == toxicity.INSULT:
                    weight *= 1.2 if near <= 1 else 1
                    break
                if k == toxicity.BEING:
                    weight *= 1.25
                    break
        else:
            since = before[len(before) - before[::-1].index(toxicity.THREAT) :] if toxicity.THREAT in before else before
            people = [k for k in since if k in (toxicity.SELF, toxicity.TARGET)]
            if toxicity.SELF in people:
                last = len(since) - 1 - since[::-1].index(toxicity.SELF)
                weight *= 1.5 if toxicity.MODAL in since[last:] else 1
            elif people:
                weight *= 0.5
            until = behind[: behind.index(toxicity.THREAT)] if toxicity.THREAT in behind else behind
            weight *= 2.0 if toxicity.TARGET in until[:2] else 1.0 if toxicity.TARGET in until else 0.25
        score += weight
    return score


def test_random_clauses_equal_the_grammar_said_again():
    dice = random.Random(1)
    for _ in range(4000):
        kinds = dice.choices(range(toxicity.END), k=dice.randrange(1, 12))
        words = [(k, dice.choice((1.0, 2.5)) if k in (toxicity.INSULT, toxicity.THREAT) else 0.0) for k in kinds]
        assert toxicity.clause_score(words) == pytest.approx(brute_clause(words)), kinds


def test_texts_are_scored_clause_by_clause():
    dice = random.Random(2)
    vocabulary = "you i will not said are idiot scum hurt kill house , . ! \n ; tree".split(" ")
    for _ in range(500):
        text = " ".join(dice.choices(vocabulary, k=dice.randrange(40)))
        clauses = [[LEXICON[t] for t in toxicity._TOKEN.findall(c.lower())] for c in re.split(r"[.!?;\n]", text)]
        wanted = [brute_clause(c) for c in clauses if any(w for _, w in c)]
        assert clause_scores(text, LEXICON)[0] == pytest.approx(wanted)


def test_threats_are_learnt_as_insults_are():
    dice = random.Random(3)
    filler = lambda: " ".join(dice.choices("house tree river stone cloud paper".split(), k=12))
    rows = [(f"{filler()} I will zorch you . {filler()} {i}", 1) for i in range(30)]
    rows += [(f"{filler()} what a blarg . {filler()} {i}", 1) for i in range(30)] + [(f"{filler()} you are here {i}", 0) for i in range(300)]
    stems, verbs = toxicity.learn_stems(rows)
    assert "zorch$" in verbs and "blarg$" in stems and "blarg$" not in verbs and not any(s in stems for s in ("you$", "will$"))
    lexicon = Lexicon(stems, verbs)
    assert lexicon["zorch"][0] == toxicity.THREAT and lexicon["blarg"][0] == toxicity.INSULT


def test_composition_runs_all_machines():
    kinds = [toxicity.REPORT, toxicity.TARGET, toxicity.NEGATION, toxicity.INSULT, toxicity.END, toxicity.INSULT]
    assert toxicity.factors(toxicity.FORWARD, kinds) == [1, 1, 1, 0.25 * 1.25 * 0.5, 1, 1]
    one = toxicity.compose(toxicity.negation(), toxicity.reported())
    assert len(one) == 8 and toxicity.factors(one, kinds) == [1, 1, 1, 0.125, 1, 1]


def test_held_out_accuracy(spark, data_dir):
    path = data_dir.replace("sf0.001", "sf0.1")
    found = queries.QUERIES["op8_toxicity"](spark, path).where("held_out")
    rows = found.join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").collect()
    toxic, clean = ([r for r in rows if r.toxic == t] for t in (1, 0))
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.85
    assert sum(r.predicted for r in clean) / len(clean) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_examples_are_bounded_in_characters(spark, monkeypatch):
    """Long texts are no examples, and examples end where their characters do; what is left decides."""
    rows = [(i, ("scum you " if i % 2 else "house tree ") * 20 + f"n{i}", "en", "a", 1) for i in range(80)]
    rows += [(100, "wretch " * 40_000, "en", "a", 1), (101, "wretch " * 40_000, "en", "a", 1)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(100, 1), (101, 1)], "doc_id long, toxic int")
    given = docs(spark, rows)
    every = toxicity.learn(given, labels)
    assert "scum$" in every["stems"] and "wretch$" not in every["stems"]
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 100)
    assert toxicity.learn(given, labels)["stems"] == {}


def test_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (6, 0), (7, None), (None, 1), (4, 3)], "doc_id long, toxic int")
    found = toxicity.with_toxicity(crowded(docs(spark), "score", "predicted", "toxic"), labels).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if not (r.text or "").strip()}) == 1
    assert toxicity.with_toxicity(docs(spark, []), labels).count() == 0
    assert {r.predicted for r in toxicity.with_toxicity(docs(spark), labels.limit(0)).collect()} == {0}
