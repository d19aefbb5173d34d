"""Toxicity by a weighted finite-state grammar over clauses, with an insult lexicon learned from labelled rows."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import documents, is_small, join_lookup, materialize, measured, send_code, size_measures

# Closed word classes of the grammar, in English, German, French and Spanish
TARGETS = set("""you your yours yourself he she him her they them their this these
    du dich dir dein deine ihr euch sie er tu te toi ton ta vous votre il elle ils elles
    tú ti usted ustedes él ella ellos ellas tu su""".split())
NEGATIONS = set("""not never no isn't aren't wasn't don't nicht kein keine nie jamais pas aucun nunca ningún jamás""".split())
REPORTS = set("""said says wrote writes quoted claims claimed reported called sagte schrieb behauptet dit écrit
    déclaré dijo escribió afirma""".split())
INTENTS = set("""will shall gonna going must should werde wirst sollst vais va dois voy vas debes""".split())
CLITIC_INTENTS = {"ll"}  # after an apostrophe: I'll, they'll
CLITIC_TARGETS = {"re", "all"}  # you're, y'all
ELIDED_TARGETS = {"t"}  # before an apostrophe: t'es

VERBS_EN = "kill hurt beat destroy burn shoot stab punish".split()
GERUNDS_EN = "killing hurting beating destroying burning shooting stabbing punishing".split()
PARTICIPLES_EN = "killed hurt beaten destroyed burned burnt shot stabbed punished".split()
BE_EN = "be am are is get".split()
CLITIC_BE_EN = {"m", "re", "s"}  # I'm, we're, she's
OBJECTS_EN = "you him her them".split()
SUBJECTS_EN = "you he she they".split()
INTENTS_EN = "will shall gonna going must should ll".split()
VERBS_DE = "töten schlagen vernichten erschießen verbrennen erstechen umbringen".split()
PARTICIPLES_DE = "getötet geschlagen vernichtet erschossen verbrannt erstochen umgebracht".split()
OBJECTS_DE = "dich euch ihn".split()
SUBJECTS_DE = "du ihr er".split()
INTENTS_DE = "werde werden wirst wird werdet soll sollst will".split()
VERBS_FR = "tuer frapper détruire brûler poignarder".split()
OBJECTS_FR = "te t vous".split()
INTENTS_FR = "vais vas va allons allez vont dois doit".split()
FUTURE_FR = "ai a ons ont".split()  # endings after the infinitive without its e
VERBS_ES = "matar golpear destruir quemar apuñalar".split()
OBJECTS_ES = "te os".split()
INTENTS_ES = "voy vas va vamos van debes debo".split()
FUTURE_ES = "é á emos án".split()  # endings after the infinitive
ENCLITICS_ES = "te os lo la los las".split()  # objects written together with the infinitive

# Threats: the classes of words that come one after the other in a clause, others between them. A verb's arc is closed after a
# negation. A word may be in several classes.
PATTERNS = (
    ("intent", "verb", "target"),  # we will kill you
    ("be_en", "gerund_en", "object_en"),  # I am killing you
    ("subject_en", "intent_en", "be_en", "participle_en"),  # you will be killed
    ("intent_de", "object_de", "verb_de"),  # ich werde dich töten
    ("object_de", "intent_de", "verb_de"),  # dich werde ich töten
    ("subject_de", "intent_de", "participle_de"),  # du wirst getötet
    ("intent_fr", "object_fr", "verb_fr"),  # je vais te tuer
    ("object_fr", "future_fr"),  # je te tuerai
    ("intent_es", "enclitic_es"),  # voy a matarte
    ("object_es", "intent_es", "verb_es"),  # te voy a matar
    ("object_es", "future_es"),  # te mataré
)
ACTIONS = {"verb", "gerund_en", "participle_en", "verb_de", "participle_de", "verb_fr", "future_fr", "verb_es", "enclitic_es", "future_es"}

TOKEN = re.compile(r"[^\W\d_]+(?:['’ʼ][^\W\d_]+)*|[.!?;:,\n\"“”«»()]")
WORD = re.compile(r"[^\W\d_]+")
BREAK = set(".!?;:,\n()")
QUOTES = set("\"“”«»")


def word_classes() -> dict[str, frozenset[str]]:
    """Every word of the closed classes and every form of a threat verb, with its classes. Forms follow from the rules of
    the languages: future endings and enclitic objects are put behind the infinitive."""
    forms = {"target": TARGETS, "report": REPORTS, "intent": INTENTS,
             "verb": {*VERBS_EN, *VERBS_DE, *VERBS_FR, *VERBS_ES}, "gerund_en": GERUNDS_EN, "participle_en": PARTICIPLES_EN,
             "be_en": BE_EN, "object_en": OBJECTS_EN, "subject_en": SUBJECTS_EN, "intent_en": INTENTS_EN,
             "verb_de": VERBS_DE, "participle_de": PARTICIPLES_DE, "object_de": OBJECTS_DE, "subject_de": SUBJECTS_DE, "intent_de": INTENTS_DE,
             "verb_fr": VERBS_FR, "object_fr": OBJECTS_FR, "intent_fr": INTENTS_FR,
             "future_fr": {v.removesuffix("e") + end for v in VERBS_FR for end in FUTURE_FR},
             "verb_es": VERBS_ES, "object_es": OBJECTS_ES, "intent_es": INTENTS_ES,
             "future_es": {v + end for v in VERBS_ES for end in FUTURE_ES},
             "enclitic_es": {v + end for v in VERBS_ES for end in ENCLITICS_ES}}
    forms["target"] = {*forms["target"], *forms["enclitic_es"]}
    found: dict[str, set[str]] = {}
    for name, words in forms.items():
        for word in words:
            found.setdefault(word, set()).add(name)
    return {word: frozenset(names) for word, names in found.items()}


CLASSES = word_classes()
THREATS = {word for word, names in CLASSES.items() if names & ACTIONS}


class Weights(NamedTuple):
    """Arc weights of the grammar."""

    target: float = 1.25  # an insult with a target in its clause
    negated: float = 0.35  # within `reach` words after a negation
    reported: float = 0.6  # in a clause that reports speech, or between quotation marks
    threat: float = 4.0  # a whole pattern of intent, threat verb and target
    reach: int = 2


class Calibration(NamedTuple):
    """score = 1 / (1 + exp(-(slope * log(1 + sum of clauses) + bias)))."""

    slope: float = 3.0
    bias: float = -4.0

    def __call__(self, total):
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(total) + self.bias, -30, 30)))


class Lexicon(NamedTuple):
    words: dict[str, float]
    stems: dict[str, float]

    def weight(self, word: str) -> float:
        if word in self.words:
            return self.words[word]
        return max((self.stems.get(word[:k], 0.0) for k in STEM_LENGTHS if len(word) > k), default=0.0) if self.stems else 0.0


STEM_LENGTHS = (3, 4, 5, 6)


def clauses(text: str):
    """Runs of words between punctuation, each with whether it stands between quotation marks."""
    words, quoted = [], False
    for token in TOKEN.findall(text):
        if token in BREAK or token in QUOTES:
            if words:
                yield words, quoted
                words = []
            quoted ^= token in QUOTES
            quoted &= token != "\n"  # a mark left open ends with its line
        else:
            words.append(token.lower().replace("’", "'").replace("ʼ", "'"))
    if words:
        yield words, quoted


class Machine(NamedTuple):
    """A transducer as a table: from (state, input) to (next state, output); inputs are sets of classes."""

    start: object
    step: Callable[[object, frozenset], tuple]


def negation(reach: int) -> Machine:
    """Counts words since a negation; the output says whether it still reaches this one."""
    def step(state, classes):
        state = 0 if "negation" in classes else min(state + ("word" in classes), reach + 1)
        return state, state <= reach
    return Machine(reach + 1, step)


def flag(name: str) -> Machine:
    """Remembers that a class was met."""
    return Machine(False, lambda state, classes: (state or name in classes,) * 2)


def pattern(names: tuple[str, ...]) -> Machine:
    """Waits for the classes in turn; the output says whether the last one is met. A negated verb begins anew. One word is one arc."""
    def step(state, classes):
        if names[state] not in classes:
            return state, False
        if names[state] in ACTIONS and "negated" in classes:
            return 0, False
        return ((state + 1) % len(names), state + 1 == len(names))
    return Machine(0, step)


class Grammar:
    """The composition of the transducers: its states are tuples of theirs. The negation's output is an input of the threat
    patterns; when one of these is complete, all begin anew, so a threat counts once. Arcs are computed when first taken and kept in
    one table; the states are finitely many, and so is the table."""

    def __init__(self, reach: int):
        self.negation, self.target, self.report = negation(reach), flag("target"), flag("report")
        self.patterns = [pattern(names) for names in PATTERNS]
        self.waiting = tuple(m.start for m in self.patterns)
        self.start = (self.negation.start, self.waiting, False, False)
        self.arcs: dict[tuple, tuple] = {}

    def step(self, state: tuple, classes: frozenset) -> tuple:
        """Next state, whether the word is negated, whether a threat is complete."""
        arc = self.arcs.get((state, classes))
        if arc is None:
            since, waiting, target, report = state
            since, negated = self.negation.step(since, classes)
            seen = classes | {"negated"} if negated else classes
            moves = [m.step(at, seen) for m, at in zip(self.patterns, waiting)]
            threat = any(done for _, done in moves)
            waiting = self.waiting if threat else tuple(at for at, _ in moves)
            state_after = (since, waiting, self.target.step(target, classes)[0], self.report.step(report, classes)[0])
            arc = self.arcs[state, classes] = state_after, negated, threat
        return arc


@functools.cache
def grammar(reach: int) -> Grammar:
    return Grammar(reach)


NEW_WORD = frozenset({"word"})
NO_CLASS: frozenset[str] = frozenset()


@functools.lru_cache(maxsize=100_000)
def inputs(word: str) -> tuple[tuple[str, frozenset], ...]:
    """A word's parts with the classes of each. A word with apostrophes is looked up whole as a negation and by its parts, which
    the lexicon holds, in all other classes."""
    parts = word.split("'")
    first = {"word"}
    if word in NEGATIONS or len(parts) > 1 and not NEGATIONS.isdisjoint(parts):
        first.add("negation")
    out = []
    for i, part in enumerate(parts):
        names = set(CLASSES.get(part, NO_CLASS)) | (first if i == 0 else set())
        names |= {"intent", "intent_en"} if i > 0 and part in CLITIC_INTENTS else set()
        names |= {"target"} if i > 0 and part in CLITIC_TARGETS or part in ELIDED_TARGETS and i + 1 < len(parts) else set()
        names |= {"be_en"} if i > 0 and part in CLITIC_BE_EN else set()
        out.append((part, frozenset(names)))
    return tuple(out)


def clause_score(words: list[str], quoted: bool, lexicon: Lexicon, w: Weights) -> float:
    """One pass of the composed transducers over a clause. An entry's weight is discounted while a negation reaches it, a threat adds
    its own; whether a target or reported speech was met applies to the whole clause."""
    machine, total = grammar(w.reach), 0.0
    state = machine.start
    for word in words:
        for part, classes in inputs(word):
            state, negated, threat = machine.step(state, classes)
            value = lexicon.weight(part)
            if value:
                total += value * (w.negated if negated else 1.0)
            if threat:
                total += w.threat
    _, _, target, report = state
    return total * (w.target if target else 1.0) * (w.reported if report or quoted else 1.0)


class Finder:
    """Whether any word of a text can score: an entry, one that begins with a stem, or a threat verb. Words that cannot are remembered,
    so that a text is one split and one difference of sets; the memory is emptied when it is full."""

    def __init__(self, lexicon: Lexicon, capacity: int = 500_000):
        self.lexicon, self.capacity, self.silent = lexicon, capacity, set()

    def search(self, text: str) -> bool:
        for word in set(WORD.findall(text)) - self.silent:
            low = word.lower()
            if low in THREATS or self.lexicon.weight(low):
                return True
            if len(self.silent) >= self.capacity:
                self.silent.clear()
            self.silent.add(word)
        return False


def text_total(text: str, lexicon: Lexicon, w: Weights = Weights(), finder=None) -> float:
    """The sum over a whole text's clauses; `finder` tells texts that can score, to pass by the others."""
    if finder is not None and not finder.search(text):
        return 0.0
    return sum(clause_score(words, quoted, lexicon, w) for words, quoted in clauses(text))


def finder_of(lexicon: Lexicon) -> Finder:
    return Finder(lexicon)


def words_of(text: str = "text") -> Column:
    return F.split(F.lower(F.col(text)), r"[^\p{L}]+")


def learn_entries(labelled: DataFrame, least_contexts: int = 4, least_weight: float = 3.0, least_share: float = 0.9) -> DataFrame:
    """The insult lexicon (entry, stem, weight) from rows (doc_id, text, y of 0/1), all of them.

    A word is an entry if it stands in toxic documents after `least_contexts` different words or more (copies of
    one document give one context only), if at least `least_share` of the documents with it are toxic, and if its
    smoothed log-odds reach `least_weight`. A stem of 3 to 6 letters is an entry if `least_contexts` different
    words of toxic documents start with it, under the same two limits; longer stems below a stem that is an entry are left out.
    A stem's documents are counted once for each of its words. Without rows of both kinds there are no entries.
    """
    n_toxic, n = labelled.agg(F.sum("y"), F.count(F.lit(1))).first()
    if not n_toxic or n_toxic == n:
        return labelled.sparkSession.createDataFrame([], "entry string, stem boolean, weight double")
    toxic = labelled.filter("y = 1").select("doc_id", words_of().alias("w"))
    pairs = F.arrays_zip(F.col("w").alias("word"), F.concat(F.array(F.lit("")), F.col("w")).alias("prev"))
    contexts = (toxic.select(F.explode(pairs).alias("p")).select("p.word", "p.prev").filter("length(word) > 1").distinct()
                .groupBy("word").agg(F.count(F.lit(1)).alias("contexts")))
    counts = (labelled.select("y", F.explode(F.array_distinct(words_of())).alias("word"))
              .groupBy("word").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("all")))
    counts = materialize(counts.filter("length(word) > 1"), "words")
    heads = F.array(*[F.substring("word", 1, k) for k in STEM_LENGTHS])
    stems = (counts.select("word", "pos", "all", F.explode(heads).alias("entry")).filter("length(word) > length(entry)")
             .groupBy("entry").agg(F.sum("pos").alias("pos"), F.sum("all").alias("all"), F.count_if(F.col("pos") > 0).alias("contexts"))
             .withColumn("stem", F.lit(True)))
    whole = counts.filter("pos > 0").join(contexts, "word").withColumnRenamed("word", "entry").withColumn("stem", F.lit(False))
    odds = F.log((F.col("pos") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("all") - F.col("pos") + 0.5) / F.lit(n - n_toxic + 1.0))
    found = whole.unionByName(stems).withColumn("weight", odds)
    chosen = found.filter((F.col("contexts") >= least_contexts) & (F.col("weight") >= least_weight) & (F.col("pos") >= least_share * F.col("all")))
    chosen = materialize(chosen.select("entry", "stem", "weight"), "entries")
    longer = F.array(*[F.substring("entry", 1, k) for k in STEM_LENGTHS])
    below = chosen.filter("stem").select("entry", F.explode(longer).alias("head")).filter("length(head) < length(entry)")
    heads = chosen.filter("stem").select(F.col("entry").alias("head"))
    below = below.join(heads, "head", "left_semi").select("entry", F.lit(True).alias("stem")).distinct()
    return chosen.join(below, ["entry", "stem"], "left_anti")


def learn(labelled: DataFrame, in_memory: int = 200_000, **options) -> Lexicon | DataFrame:
    """What `learn_entries` finds: as a Lexicon, which the tasks get with their code, up to `in_memory` entries, and as the written
    table beyond, which `totals` joins to the texts' words. The scores are the same."""
    entries = learn_entries(labelled, **options)
    entries, sizes = measured(entries, "lexicon", **size_measures(entries))
    if sizes["rows"] > in_memory:
        return entries
    rows = entries.collect()
    return Lexicon(*({r["entry"]: r["weight"] for r in rows if r["stem"] == stem} for stem in (False, True)))


def totals(docs: DataFrame, lexicon: Lexicon | DataFrame, weights: Weights = Weights()) -> DataFrame:
    """`docs` (with text) and total: the sum of the clauses' scores."""
    send_code(docs.sparkSession)
    if isinstance(lexicon, DataFrame):
        return totals_by_join(docs, lexicon, weights)

    @F.pandas_udf("double")
    def judge(texts: pd.Series) -> pd.Series:
        finder = finder_of(lexicon)
        return pd.Series([text_total(t, lexicon, weights, finder) for t in texts], dtype=float)

    return docs.withColumn("total", judge("text"))


def totals_by_join(docs: DataFrame, entries: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """`totals` for a lexicon of any size: each different word of each different text meets its entries in a join, and a text is judged
    with the weights of its own words."""
    docs = docs.withColumn("_text", F.sha2("text", 256))
    words = docs.select("_text", F.explode(F.array_distinct(words_of())).alias("word")).distinct()
    heads = F.array(F.struct(F.col("word").alias("entry"), F.lit(False).alias("stem")),
                    *[F.struct(F.substring("word", 1, k).alias("entry"), F.lit(True).alias("stem")) for k in STEM_LENGTHS])
    keyed = words.select("word", F.explode(heads).alias("e")).select("word", "e.*").filter("not stem or length(entry) < length(word)").distinct()
    weight = keyed.join(entries, ["entry", "stem"]).groupBy("word").agg(
        F.max_by("weight", F.struct(~F.col("stem"), F.col("weight"))).alias("weight"))  # the whole word before its stems
    own = join_lookup(words, weight, "word", "inner").groupBy("_text").agg(F.collect_list(F.struct("word", "weight")).alias("_own"))

    @F.pandas_udf("double")
    def judge(texts: pd.Series, own: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, own):
            lexicon = Lexicon({r["word"]: r["weight"] for r in found} if found is not None else {}, {})
            out.append(text_total(text, lexicon, weights, finder_of(lexicon)))
        return pd.Series(out, dtype=float)

    own = own.select("_text", F.transform("_own", lambda r: F.struct(r["word"].alias("word"), r["weight"].alias("weight"))).alias("_own"))
    return join_lookup(docs, own, "_text", "left").withColumn("total", judge("text", "_own")).drop("_text", "_own")


def calibrate(judged: DataFrame, start: Calibration = Calibration(), steps: int = 50) -> Calibration:
    """Slope and bias by penalised logistic regression (one pseudo-row's pull towards `start`) on rows (total, y).
    Spark adds up gradient and curvature of each Newton step over all rows, reduced to counts of equal ones; the driver gets five sums."""
    counts = materialize(judged.groupBy(F.log1p("total").alias("t"), "y").agg(F.count(F.lit(1)).alias("n")), "counts")
    if counts.select("y").distinct().count() < 2:
        return start
    first = b = np.array(start)
    for _ in range(steps):
        logit = F.greatest(F.least(F.col("t") * F.lit(float(b[0])) + F.lit(float(b[1])), F.lit(30.0)), F.lit(-30.0))
        p = 1 / (1 + F.exp(-logit))
        pull, bend = F.col("n") * (F.col("y") - p), F.col("n") * p * (1 - p)
        gt, g1, htt, ht, h1 = counts.agg(*[F.sum(c) for c in (pull * F.col("t"), pull, bend * F.col("t") * F.col("t"), bend * F.col("t"), bend)]).first()
        move = np.linalg.solve(np.array([[htt, ht], [ht, h1]]) + np.eye(2), np.array([gt, g1]) - (b - first))
        b = b + move / max(1.0, np.abs(move).max())
        if np.abs(move).max() < 1e-9:
            break
    return Calibration(max(float(b[0]), 0.1), float(b[1]))


def score(docs: DataFrame, lexicon: Lexicon | DataFrame, calibration: Calibration, weights: Weights = Weights()) -> DataFrame:
    """`docs` (with text), total and score: the calibrated total, in [0, 1]."""
    log = F.log1p("total") * F.lit(calibration.slope) + F.lit(calibration.bias)
    return totals(docs, lexicon, weights).withColumn("score", 1 / (1 + F.exp(-log)))


def fit(labelled: DataFrame, weights: Weights = Weights(), **options) -> tuple[Lexicon | DataFrame, Calibration]:
    """From rows (doc_id, text, y), all of them: a lexicon learned from four fifths and calibrated on the others,
    then the lexicon of all rows under that calibration."""
    labelled = materialize(labelled, "labelled")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(5))
    part = learn(labelled.filter(fold < 4), **options)
    calibration = calibrate(totals(labelled.filter(fold == 4), part, weights))
    return learn(labelled, **options), calibration


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.5, weights: Weights = Weights(), **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`.

    Labels are learned from rows where `held_out` (an expression over doc_id) is false.

    Null or empty text: the score of a total of 0. Null doc_id: scored, never a training row, held_out false. Null
    labels and labels of unknown documents are not used; of several labels of a document the largest counts. Repeated
    rows are scored each. Without labels of both kinds the lexicon is empty and only threats score. Empty documents: no rows.
    """
    rows = documents(docs).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
             .filter("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y")))
    known, sizes = measured(known, "labels", **size_measures(known))
    train = rows.filter("not held_out").join(F.broadcast(known) if is_small(sizes) else known, "doc_id")
    lexicon, calibration = fit(train, weights, **options)
    return score(rows, lexicon, calibration, weights).select(
        "doc_id", "held_out", "score", (F.col("score") >= F.lit(threshold)).cast("int").alias("predicted"))
