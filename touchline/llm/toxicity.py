"""Toxicity by a weighted finite-state pattern grammar.

Words get classes from lexicons: insults, threats, targets, negations and verbs of reported speech, and insults
learned from labels. Three transducers read the classes of a clause and mark insults and threats as negated, reported
or aimed at someone; they are composed into one machine. Each marked class is a pattern with a weight, so a document
is scored by the clauses it matches rather than by words alone. The weights are those of a logistic regression on the
pattern counts of labelled documents.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.rows import id_hash

SAMPLE = 20_000  # labelled documents that lexicon and weights are learned from, chosen by a hash of their id
LEARNED = 200  # words taken into the learned lexicon at most
REJECT = 0.7

# Lexicons. Insults and threats are words that seldom mean anything else.
INSULTS = """
airhead arsehole asshole bastard bitch blockhead bonehead buffoon clown coward creep cretin degenerate dimwit
disgusting douchebag dumbass dunce filthy freak idiot idiotic idiots imbecile jackass jerk loser losers lowlife
lunatic moron moronic morons nitwit pathetic pig prick repulsive scum scumbag sleazy slut stupid swine trash twit
vermin vile weirdo whore wimp worthless abschaum arschloch dummkopf idiotin trottel versager connard crétin imbécile
salaud cabrón escoria estúpida estúpido gilipollas idiota imbécil
""".split()
THREATS = """
kill kills murder strangle stab slaughter lynch behead exterminate hurt punch smash töten umbringen tuer matar
""".split()
TARGETS = """
you your you're youre u yourself he she they him her them his their this that these those du sie tu vous usted
""".split()
NEGATIONS = """
not no never nor neither without isn't aren't wasn't weren't don't doesn't didn't can't nicht kein nie pas jamais
nunca
""".split()
REPORTS = """
said says say called calls wrote writes claimed claims quoted quotes alleged reported according tweeted sagte
schrieb dit dijo
""".split()

KINDS = "ILT"  # insult, learned insult, threat
FLAGS = ("neg", "rep", "dir")
PATTERNS = [(kind, *flags) for kind in KINDS for flags in product((False, True), repeat=len(FLAGS))]

Symbol = tuple  # (class, negated, reported, aimed)

_SPLIT = re.compile(r"[.,;:!?()\[\]{}\"“”„«»|\n\r]+")
# Clause signs and other signs between words as blanks, for a first look at the words of a text.
_LOOSE = str.maketrans(dict.fromkeys(".,;:!?()[]{}\"“”„«»|'`*_-~#<>/\\&%$+=…’‘", " "))


class Transducer:
    """A deterministic machine from symbols to symbols: ``step(state, symbol)`` gives the next state and the output."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def compose(self, other: Transducer) -> Transducer:
        """The machine that feeds the output of this one to ``other``."""

        def step(state, symbol):
            mine, middle = self.step(state[0], symbol)
            its, out = other.step(state[1], middle)
            return (mine, its), out

        return Transducer((self.start, other.start), step)

    def table(self, symbols: Iterable[Symbol]) -> dict:
        """The reachable part as a table, (state, symbol) to (state, output)."""
        symbols, found, waiting = list(symbols), {}, [self.start]
        seen = {self.start}
        while waiting:
            state = waiting.pop()
            for symbol in symbols:
                after, out = found[state, symbol] = self.step(state, symbol)
                if after not in seen:
                    seen.add(after)
                    waiting.append(after)
        return found


def _negation(state: int, symbol: Symbol):
    """A negation holds for the next three words."""
    kind = symbol[0]
    if kind == "N":
        return 3, symbol
    out = (kind, True, *symbol[2:]) if state and kind in KINDS else symbol
    return max(0, state - 1), out


def _reported(state: int, symbol: Symbol):
    """A verb of reported speech holds to the end of the clause."""
    kind, negated, _, aimed = symbol
    return int(state or kind == "R"), (kind, negated, True, aimed) if state and kind in KINDS else symbol


def _aimed(state: int, symbol: Symbol):
    """A target holds for what follows in the clause."""
    kind, negated, reported, _ = symbol
    return int(state or kind == "Y"), (kind, negated, reported, True) if state and kind in KINDS else symbol


GRAMMAR = Transducer(0, _negation).compose(Transducer(0, _reported)).compose(Transducer(0, _aimed))


def lexicon(learned: Iterable[str] = ()) -> dict[str, str]:
    classes = dict.fromkeys(learned, "L")
    for words, kind in ((INSULTS, "I"), (THREATS, "T"), (TARGETS, "Y"), (NEGATIONS, "N"), (REPORTS, "R")):
        classes |= dict.fromkeys(words, kind)
    return classes


class Matcher:
    """Counts the patterns of a text."""

    def __init__(self, classes: dict[str, str]):
        self.classes = classes
        self.marked = frozenset(word for word, kind in classes.items() if kind in KINDS)
        self.table = GRAMMAR.table((kind, False, False, False) for kind in (*KINDS, *"YNRO"))
        self.number = {pattern: i for i, pattern in enumerate(PATTERNS)}
        # Words end at the signs that end them in learning, but listed words with an apostrophe are whole.
        sign = rf"[^\s{re.escape(''.join(map(chr, _LOOSE)))}]"
        listed = sorted((word for word in classes if "'" in word), key=len, reverse=True)
        inner = "".join(rf"{re.escape(word)}(?!{sign})|" for word in listed)
        self.words = re.compile(rf"{inner}{sign}+").findall

    def clause(self, words: list[str]) -> list[int]:
        """The patterns a clause matches, in order."""
        state, found = GRAMMAR.start, []
        for word in words:
            kind = self.classes.get(word, "O")
            state, out = self.table[state, (kind, False, False, False)]
            if kind in KINDS:
                found.append(self.number[out])
        return found

    def counts(self, text: str) -> dict[int, int]:
        folded = text.lower()
        if self.marked.isdisjoint(folded.translate(_LOOSE).split()):
            return {}
        found: Counter[int] = Counter()
        for clause in _SPLIT.split(folded):
            if not self.marked.isdisjoint(clause.translate(_LOOSE).split()):
                found.update(self.clause(self.words(clause)))
        return dict(found)


def features(counts: dict[int, int]) -> np.ndarray:
    out = np.zeros(len(PATTERNS))
    for number, count in counts.items():
        out[number] = np.log1p(count)
    return out


def held_out(column: str = "doc_id") -> Column:
    return id_hash(column) % 3 == 1


def _sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most SAMPLE labelled documents whose id isn't held out."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    picked = known.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    picked = picked.orderBy(F.xxhash64(F.col("doc_id").cast("long"), F.lit(7)), "doc_id", "toxic").limit(SAMPLE)
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text")).filter(~held_out())
    return texts.join(F.broadcast(picked), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic")


def learned_words(sample: DataFrame) -> list[str]:
    """Words that nearly only toxic texts have, each text counted once however many copies it has."""
    single = sample.groupBy(F.md5("text").alias("_key")).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    loose = F.translate(F.lower("text"), "".join(map(chr, _LOOSE)), " " * len(_LOOSE))
    words = single.select("toxic", F.explode(F.array_distinct(F.split(loose, r"\s+"))).alias("word"))
    counts = words.filter(F.char_length("word").between(3, 30)).groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("texts")
    )
    least = F.greatest(F.lit(5), F.lit(0.01) * F.lit(single.agg(F.coalesce(F.sum("toxic"), F.lit(0))).first()[0]))
    strong = counts.filter((F.col("toxic") >= least) & ((F.col("toxic") + 0.5) / (F.col("texts") + 1) >= 0.9))
    return [row["word"] for row in strong.orderBy(F.desc("toxic"), "word").limit(LEARNED).collect()]


def _rows(documents: DataFrame, classes: dict[str, str], columns: list[str], function, schema: str) -> DataFrame:
    """mapInArrow over texts: ``function(matcher, texts)`` gives the columns that are added to ``columns``."""

    def run(batches):
        matcher = Matcher(classes)
        for batch in batches:
            for start in range(0, len(batch), 500):
                some = batch.slice(start, 500)
                added = function(matcher, [text or "" for text in some["_text_to_match"].to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*(some[name] for name in columns), *added.values()], names=[*columns, *added]
                )

    text = F.col("text").cast("string").alias("_text_to_match")
    return documents.select(*(F.col(f"`{name}`") for name in columns), text).mapInArrow(run, schema)


def fitted(matches: list[tuple[dict[int, int], int]], penalty: float = 0.05) -> np.ndarray:
    """Weights of the patterns, the constant last: logistic regression with a ridge, by Newton's method."""
    groups: dict[tuple, list[int]] = defaultdict(lambda: [0, 0])
    for counts, toxic in matches:
        groups[tuple(sorted(counts.items()))][toxic] += 1
    if not groups:
        return np.zeros(len(PATTERNS) + 1)
    rows = np.array([[*features(dict(key)), 1.0] for key in groups])
    toxic, total = np.array([[n[1], sum(n)] for n in groups.values()], np.float64).T
    ridge = np.full(rows.shape[1], penalty)
    ridge[-1] = 1e-3
    weights = np.zeros(rows.shape[1])

    def loss(at):
        z = rows @ at
        return (total * np.logaddexp(0, z) - toxic * z).sum() + (ridge * at * at).sum() / 2

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (total * p - toxic) + ridge * weights
        curve = (rows.T * (total * p * (1 - p))) @ rows + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-6 and loss(weights - size * step) > loss(weights):
            size /= 2
        weights = weights - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return weights


def train(documents: DataFrame, labels: DataFrame) -> tuple[dict[str, str], np.ndarray]:
    """Lexicon and weights from the labels of documents that aren't held out; without labels, all weights are 0."""
    sample = _sample(documents, labels)
    classes = lexicon(learned_words(sample))

    def matched(matcher, texts):
        found = [[(k, n) for k, n in matcher.counts(text).items()] for text in texts]
        return {
            "patterns": pa.array([[k for k, _ in some] for some in found], pa.list_(pa.int32())),
            "counts": pa.array([[n for _, n in some] for some in found], pa.list_(pa.int32())),
        }

    rows = _rows(sample, classes, ["toxic"], matched, "toxic INT, patterns ARRAY<INT>, counts ARRAY<INT>")
    # The sample is bounded; equal rows go to the driver once, with their number.
    grouped = rows.groupBy("toxic", "patterns", "counts").count().collect()
    matches = [
        (dict(zip(row["patterns"], row["counts"])), row["toxic"]) for row in grouped for _ in range(row["count"])
    ]
    return classes, fitted(matches)


def score(
    documents: DataFrame, labels: DataFrame, columns: Iterable[str] = ("doc_id",), name: str = "score"
) -> DataFrame:
    """The columns named and ``name``, the probability of being toxic, for every row of ``documents`` (doc_id, text).

    NULL and empty texts match nothing and get the score of a text without matches. Labels that are NULL, have no
    document or are held out aren't used; repeated rows of either table count as they come.
    """
    classes, weights = train(documents, labels)
    columns = list(columns)
    fields = {field.name: field.dataType.simpleString() for field in documents.schema.fields}

    def scored(matcher, texts):
        rows = np.array([features(matcher.counts(text)) for text in texts]).reshape(len(texts), -1)
        return {name: pa.array(1 / (1 + np.exp(-np.clip(rows @ weights[:-1] + weights[-1], -30, 30))))}

    schema = ", ".join([*(f"`{column}` {fields[column]}" for column in columns), f"`{name}` DOUBLE"])
    return _rows(documents, classes, columns, scored, schema)


def clean(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below REJECT, with their columns unchanged."""
    name = "_toxicity_of_the_text"
    return score(documents, labels, documents.columns, name).filter(F.col(name) < REJECT).drop(name)
