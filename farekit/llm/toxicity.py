"""Toxicity by a weighted finite-state grammar over clauses, with its lexicon and weights learnt from labels."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farekit.session import stage

# Labelled rows of each class that the lexicon and the weights are learnt from, chosen by a hash of the text.
SAMPLE_ROWS = 3000
PARTS = 16
# Characters of the examples of each class in all; longer texts than the second number are no examples.
SAMPLE_CHARS = 12_000_000
EXAMPLE_CHARS = 200_000
# Prefixes of words that may become insults, and what one needs: texts it occurs in, log odds, standard deviations.
STEM_LETTERS = (4, 5, 6, 7, 8)
LEAST_TEXTS = 3
LEAST_ODDS = np.log(6.0)
LEAST_DEVIATIONS = 4.0
# Entries of the lexicon at most, the surest first.
LEXICON = 4000
REMEMBERED = 300_000

OTHER, INSULT, THREAT, TARGET, SELF, MODAL, BEING, NEGATION, REPORT, END = range(10)

# Function words of the grammar, and verbs of threats that count before any is learnt.
TARGETS = (
    "you your yours yourself yourselves u ya he she they them him her his their himself herself themselves du dir dich dein deine ihr "
    "euch sie ihn ihm ihnen tu toi te vous il elle ils elles eux lui leur tú ti usted ustedes él ella ellos ellas les"
)
SELVES = "i we me us my our ich wir mich uns je nous moi yo nosotros"
MODALS = "will shall gonna going want would can could must should werde werden wird will soll muss kann vais va veux dois voy va quiero debo"
BEINGS = "am is are was were be been being re bin bist ist sind seid war suis es est sont êtes soy eres somos son"
NEGATIONS = "not no never none neither nor hardly without nicht nie niemals kein keine keinen keiner ohne ne pas jamais aucun sans nunca jamás ningún sin tampoco"
REPORTS = "said says say told wrote writes called claimed reported quoted according sagte sagt schrieb nannte laut dit disait écrit appelé selon dijo dice escribió llamó según"
THREATS = "kill murder hurt destroy shoot stab hang beat burn töten umbringen ermorden verletzen schlagen tuer assassiner frapper détruire matar asesinar golpear destruir"
FIRST_WEIGHT = 1.5
# A learnt word is a threat if this share of its places in toxic texts has somebody right behind it, as a verb has its object.
OBJECT_SHARE = 0.5

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]")
_ENDS = frozenset(".!?;\n")


# --- transducers -------------------------------------------------------------------------------------------------

# A transducer is a table: for each state and class of word, the next state and the factor put on the word's weight. Some
# read a clause from its begin, some from its end; a word's weight gets the factors of both directions, so what stands
# before a word and what stands behind it count alike.
Transducer = list[list[tuple[int, float]]]


def _transducer(states: int, arcs) -> Transducer:
    return [[arcs(state, kind) for kind in range(END + 1)] for state in range(states)]


def negation(window: int = 3, factor: float = 0.25) -> Transducer:
    """Counts down the words that a negation reaches; an insult or threat among them loses most of its weight."""

    def arcs(state: int, kind: int) -> tuple[int, float]:
        if kind == NEGATION:
            return window, 1.0
        if kind == END:
            return 0, 1.0
        return max(state - 1, 0), factor if state and kind in (INSULT, THREAT) else 1.0

    return _transducer(window + 1, arcs)


def target(factor: float = 1.25) -> Transducer:
    """Remembers that the clause names somebody: insults weigh more then. From either end."""

    def arcs(state: int, kind: int) -> tuple[int, float]:
        if kind == END:
            return 0, 1.0
        return 1 if kind == TARGET else state, factor if state and kind == INSULT else 1.0

    return _transducer(2, arcs)


def insult(called: float = 1.25, again: float = 1.2) -> Transducer:
    """An insult that somebody is said to be, or that follows another one closely, weighs more. From the begin."""
    # 0 nothing, 1 a form of "to be" before, 2 and 3 an insult two words and one word before.

    def arcs(state: int, kind: int) -> tuple[int, float]:
        if kind == INSULT:
            return 3, {0: 1.0, 1: called, 2: again, 3: again}[state]
        if kind == END:
            return 0, 1.0
        if kind == BEING:
            return 1, 1.0
        return {0: 0, 1: 1, 2: 0, 3: 2}[state], 1.0

    return _transducer(4, arcs)


def threat_subject(meant: float = 1.5, told: float = 0.5) -> Transducer:
    """Who acts: a threat after "I will" weighs more, after somebody else little; an order has no subject. From the begin."""
    # 0 nobody, 1 the writer, 2 the writer with a modal verb, 3 somebody else.

    def arcs(state: int, kind: int) -> tuple[int, float]:
        if kind == END:
            return 0, 1.0
        if kind == THREAT:
            # Its object is not the subject of what follows.
            return 0, {0: 1.0, 1: 1.0, 2: meant, 3: told}[state]
        if kind == SELF:
            return 1, 1.0
        if kind == TARGET:
            return state or 3, 1.0
        return 2 if kind == MODAL and state in (1, 2) else state, 1.0

    return _transducer(4, arcs)


def threat_object(aimed: float = 2.0, near: float = 1.0, idle: float = 0.25) -> Transducer:
    """Whom it hits: a threat right before somebody weighs most, before nobody little. From the end."""
    # 0 nobody behind, 1 somebody further behind, 2 and 3 two words and one word behind.

    def arcs(state: int, kind: int) -> tuple[int, float]:
        if kind == THREAT:
            return 0, {0: idle, 1: near, 2: aimed, 3: aimed}[state]
        if kind == END:
            return 0, 1.0
        if kind == TARGET:
            return 3, 1.0
        return {0: 0, 1: 1, 2: 1, 3: 2}[state], 1.0

    return _transducer(4, arcs)


def reported(factor: float = 0.5) -> Transducer:
    """Remembers that the clause reports what somebody said; what it reports weighs less. From either end."""

    def arcs(state: int, kind: int) -> tuple[int, float]:
        if kind == END:
            return 0, 1.0
        return 1 if kind == REPORT else state, factor if state and kind in (INSULT, THREAT) else 1.0

    return _transducer(2, arcs)


def compose(*machines: Transducer) -> Transducer:
    """All at once: tuples of states, products of factors."""
    first, *rest = machines
    if not rest:
        return first
    other = compose(*rest)
    width = len(other)

    def arcs(state: int, kind: int) -> tuple[int, float]:
        (next_a, factor_a), (next_b, factor_b) = first[state // width][kind], other[state % width][kind]
        return next_a * width + next_b, factor_a * factor_b

    return _transducer(len(first) * width, arcs)


FORWARD = compose(negation(), target(), insult(), threat_subject(), reported())
BACKWARD = compose(target(), threat_object(), reported())


def factors(machine: Transducer, kinds: list[int]) -> list[float]:
    state, found = 0, []
    for kind in kinds:
        state, factor = machine[state][kind]
        found.append(factor)
    return found


# --- lexicon -----------------------------------------------------------------------------------------------------


class Lexicon(dict):
    """(class, weight) of a word; words are looked up by their stems once and then remembered.

    ``stems`` has the weight of each learnt stem, and ``verbs`` those of them that are threats.
    """

    def __init__(self, stems: dict[str, float], verbs: Iterable[str] = ()) -> None:
        self.stems, self.verbs = stems, frozenset(verbs)
        self.fixed = {w: (THREAT, FIRST_WEIGHT) for w in THREATS.split()}
        for words, kind in (
            (BEINGS, BEING), (MODALS, MODAL), (SELVES, SELF), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT),
        ):
            self.fixed |= {w: (kind, 0.0) for w in words.split()}
        self.fixed |= {e: (END, 0.0) for e in _ENDS}
        self.functions = {w for w, (kind, _) in self.fixed.items() if kind != THREAT}
        self.update({w: self.fixed[w] for w in self.functions})

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) > REMEMBERED:
            self.clear()
            self.update({w: self.fixed[w] for w in self.functions})
        known = [s for s in stems_of(word) if s in self.stems]
        if known:
            surest = max(known, key=lambda s: (self.stems[s], s))
            # A verb that is known as a threat stays one, with the weight that was learnt.
            kind = THREAT if surest in self.verbs or word in self.fixed else INSULT
            found = self[word] = (kind, self.stems[surest])
        else:
            found = self[word] = self.fixed.get(word, (OTHER, 0.0))
        return found


def stems_of(word: str) -> Iterable[str]:
    """The whole word, marked, and its prefixes."""
    yield word + "$"
    for n in STEM_LETTERS:
        if n > len(word):
            return
        yield word[:n]


def clause_score(words: list[tuple[int, float]]) -> float:
    """The weights of a clause's insults and threats, each by what stands before and behind it."""
    kinds = [kind for kind, _ in words]
    before, behind = factors(FORWARD, kinds), factors(BACKWARD, kinds[::-1])[::-1]
    return sum(w * f * b for (_, w), f, b in zip(words, before, behind, strict=True) if w)


def clause_scores(text: str, lexicon: Lexicon) -> tuple[list[float], int]:
    """Scores above zero of the clauses of a text, and its number of words and clause ends."""
    tokens = _TOKEN.findall(text.lower())
    words = [lexicon[t] for t in tokens]
    scores, begin = [], 0
    # Most clauses have no word with a weight; only the others are read.
    weighty = [i for i, (_, weight) in enumerate(words) if weight]
    if not weighty:
        return [], len(tokens)
    ends = [i for i, (kind, _) in enumerate(words) if kind == END] + [len(words)]
    at = 0
    for end in ends:
        if at < len(weighty) and weighty[at] < end:
            scores.append(clause_score(words[begin:end]))
            while at < len(weighty) and weighty[at] < end:
                at += 1
        begin = end + 1
    return scores, len(tokens)


FEATURES = 5


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    scores, size = clause_scores(text or "", lexicon)
    total = sum(scores)
    return [1.0, np.log1p(total), np.log1p(max(scores, default=0.0)), np.log1p(len(scores)), np.log1p(1000 * total / (size + 50))]


def probability(text: str | None, lexicon: Lexicon, weights: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(np.dot(features(text, lexicon), weights), -30, 30))))


# --- learning ----------------------------------------------------------------------------------------------------


def _unlike(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """One of the texts that share their two smallest hashes of four words: copies would look like evidence."""
    seen, kept = set(), []
    for text, toxic in rows:
        words = text.lower().split()
        hashes = sorted({xxhash.xxh64_intdigest(" ".join(words[i : i + 4])) for i in range(max(1, len(words) - 3))})[:2]
        if tuple(hashes) not in seen:
            seen.add(tuple(hashes))
            kept.append((text, toxic))
    return kept


def learn_stems(rows: list[tuple[str, int]]) -> tuple[dict[str, float], list[str]]:
    """Stems that occur in far more toxic texts than others, with their log odds, and which of them are threats.

    A stem stands for its longer ones. It is a threat if it mostly has somebody
    right behind it in toxic texts: then it is what is done to them.
    """
    objects, functions = frozenset(TARGETS.split()), Lexicon({}).functions
    counts = (Counter(), Counter())
    places, aimed = Counter(), Counter()
    for text, toxic in rows:
        tokens = _TOKEN.findall(text.lower())
        counts[toxic].update({s for w in set(tokens) - functions for s in stems_of(w)})
        if toxic:
            for word, after in zip(tokens, [*tokens[1:], ""], strict=True):
                for stem in stems_of(word):
                    places[stem] += 1
                    aimed[stem] += after in objects
    n_toxic = sum(toxic for _, toxic in rows)
    n_other = len(rows) - n_toxic
    found = {}
    for stem, hits in counts[1].items():
        if hits < LEAST_TEXTS:
            continue
        share, other = (hits + 0.5) / (n_toxic + 1), (counts[0][stem] + 0.5) / (n_other + 1)
        expected = n_toxic * (hits + counts[0][stem] + 1) / (len(rows) + 1)
        sure = (hits - expected) / np.sqrt(expected * n_other / len(rows) + 1e-9)
        odds = np.log(share / other)
        if odds >= LEAST_ODDS and sure >= LEAST_DEVIATIONS:
            found[stem] = (sure, odds)
    surest = sorted(found, key=lambda s: (-found[s][0], s))[:LEXICON]
    weights = {s: float(min(found[s][1], 6.0)) for s in surest}
    return weights, sorted(s for s in weights if aimed[s] >= OBJECT_SHARE * places[s])


def fit(x: np.ndarray, y: np.ndarray, importance: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method; the constant is not shrunk."""
    weights = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (importance * (p - y)) + shrink * weights
        curvature = (x * (importance * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(curvature, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def learn(docs: DataFrame, labels: DataFrame) -> dict:
    """Lexicon and weights from documents (doc_id, text) and their labels (doc_id, toxic).

    SAMPLE_ROWS labels of each class are taken by a hash of the id, before any
    text is touched; that bounds the broadcast, and as many texts of each class
    at most reach the driver, whole ones of EXAMPLE_CHARS characters each and
    SAMPLE_CHARS in all. Of two halves each gives the lexicon by which the
    other is scored, so that the weights see words as new texts have them; in
    the end the lexicon is learnt from all. The classes weigh as in the whole
    table. Rows without text or with another label are no examples. Without
    examples of both classes every score is the share of toxic labels.
    """
    known = labels.where(F.col("toxic").isin(0, 1)).where("doc_id is not null").select(
        F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic")
    )
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = (F.xxhash64("__id"), F.col("__id"))
    # First by parts of a class, so that no task sees more of a frequent one than parts x SAMPLE_ROWS.
    part = Window.partitionBy("toxic", F.pmod(order[0], F.lit(PARTS))).orderBy(*order)
    by_id = Window.partitionBy("toxic").orderBy(*order)
    first = known.withColumn("n", F.row_number().over(part)).where(F.col("n") <= SAMPLE_ROWS)
    chosen = first.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= SAMPLE_ROWS)
    chosen = stage(chosen, "toxicity-sample")
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    again = Window.partitionBy("toxic").orderBy("n", "text")
    sampled = (
        texts.select("toxic", "n", "text").where(F.length("text") <= EXAMPLE_CHARS)
        .withColumn("k", F.row_number().over(again))
        .withColumn("chars", F.sum(F.length("text")).over(again.rowsBetween(Window.unboundedPreceding, 0)))
        .where((F.col("k") <= SAMPLE_ROWS) & (F.col("chars") <= SAMPLE_CHARS))
    )
    sample = _unlike([(r["text"], r["toxic"]) for r in sampled.orderBy("toxic", "k").collect()])
    share = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    weights = np.zeros(FEATURES)
    weights[0] = np.log((share + 1e-6) / (1 - share + 1e-6))
    parts = ([], [])
    for i, row in enumerate(sample):
        parts[i % 2].append(row)
    if len(sizes) < 2 or not parts[1]:
        return {"stems": {}, "verbs": [], "weights": weights}
    x, y = [], []
    for mine, other in (parts, parts[::-1]):
        lexicon = Lexicon(*learn_stems(mine))
        x += [features(text, lexicon) for text, _ in other]
        y += [toxic for _, toxic in other]
    y = np.array(y, dtype=float)
    ones = max(y.sum(), 1.0)
    importance = np.where(y == 1, share / ones, (1 - share) / max(len(y) - ones, 1.0)) * len(y)
    stems, verbs = learn_stems(sample)
    return {"stems": stems, "verbs": verbs, "weights": fit(np.array(x), y, importance)}


def _score_all(shared: Broadcast[dict]):
    @F.pandas_udf("double")
    def of_texts(texts: pd.Series) -> pd.Series:
        model = shared.value
        lexicon = Lexicon(model["stems"], model["verbs"])
        return pd.Series([probability(t, lexicon, model["weights"]) for t in texts], dtype="float64")

    return of_texts


def with_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``score`` (0 to 1, higher for toxic) and ``predicted`` (score of 0.5 or more), replacing such columns.

    Clauses end at . ! ? ; and line ends. In a clause, insults and threats add
    their weights: insults more if somebody is named in the clause or said to be
    one, threats more after "I will" and before whom they hit, both less after a
    negation or in reported speech. Four features of the clause scores give the
    probability. Whole texts of any length are read; null and empty ones score
    like texts without a match, repeated rows alike. An empty table gives no
    row. The broadcast model has LEXICON entries at most.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))
    scored = docs.drop("score", "predicted").withColumn("score", _score_all(model)("text"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
