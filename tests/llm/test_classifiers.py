import random
import re
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from caseweave.llm import rff, toxicity as T
from caseweave.llm.common import fold_of

SF01 = "/root/testdata/sf0.1"
LEX = T.Lexicon({"fool": 5.0}, {"vek": 4.0})
CAL = T.Calibration()


def held_out_table(spark, scored, label):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    rows = scored.filter("held_out").join(labels, "doc_id").groupBy(label, "predicted").count().collect()
    return {(r[label], r["predicted"]): r["count"] for r in rows}


def test_quality_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    out = rff.classify(docs, labels, fold_of("doc_id", 4) == 2).cache()
    n = held_out_table(spark, out, "quality")
    assert out.count() == docs.count() and out.filter("score < 0 or score > 1").count() == 0
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.99 and n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) > 0.95
    wrong = out.filter((F.crc32(F.col("doc_id").cast("string")) % 4 == 2) != F.col("held_out"))
    assert wrong.count() == 0


def test_quality_edges(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (9, 1), (None, 0), (3, None)], "doc_id long, quality int")
    given = docs([(1, "a b c"), (2, "## ## ##"), (3, None), (4, ""), (None, "x")])
    out = rff.classify(given, labels, F.lit(False)).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    assert rff.classify(docs([]), labels, F.lit(False)).count() == 0
    assert {r["score"] for r in rff.classify(given, labels.limit(0), F.lit(False)).collect()} == {0.5}


def test_kernel_and_isotonic():
    rng = np.random.default_rng(0)
    w, b = rng.normal(0, 1 / 3, (4, 4000)), rng.uniform(0, 2 * np.pi, 4000)
    x = rng.normal(0, 1, (6, 4))
    z = rff.lift(x, w, b)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 9))
    assert np.abs(z @ z.T - exact).max() < 0.06
    steps, levels = rff.isotonic([(0.0, 10, 1), (0.1, 10, 0), (0.5, 10, 6), (0.6, 10, 4), (0.9, 10, 10)])
    assert (np.diff(levels) >= 0).all() and (np.diff(steps) >= 0).all() and levels[0] < 0.2 < 0.8 < levels[-1]


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    out = T.classify(docs, labels, fold_of("doc_id", 5) == 0).cache()
    labels = labels.filter("quality = 1")  # junk that carries a toxic label holds none of the words
    n = {(r["toxic"], r["predicted"]): r["count"] for r in out.filter("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()}
    assert out.count() == docs.count() and out.filter("score < 0 or score > 1").count() == 0
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.9 and n.get((0, 1), 0) / n[0, 0] < 0.01


def test_grammar():
    total = lambda t: T.text_total(t, LEX, T.Weights(), T.finder_of(LEX))
    w = T.Weights()
    assert total("") == 0 and total("foolish clouds") == 0
    assert total("a fool") == 5 and total("Fool. FOOL!") == 10 and total("some vekoir") == 4 and total("vek") == 0
    assert total("you fool") == 5 * w.target
    assert total("not a fool") == 5 * w.negated and total("not here, a fool") == 5
    assert total("mary said a fool came") == 5 * w.reported and total('"a fool"') == 5 * w.reported
    assert total("we will kill you") == w.threat * w.target and total("you kill time") == 0
    assert total("we will never kill you") == 0


def test_contractions():
    lexicon = T.Lexicon({"idiot": 5.0, "imbécile": 5.0}, {})
    total = lambda t: T.text_total(t, lexicon, T.Weights(), T.finder_of(lexicon))
    w = T.Weights()
    for mark in "'’":
        say = lambda t: total(t.replace("'", mark))
        assert say("I'll kill you") == say("we'll beat you") == w.threat * w.target
        assert say("an idiot's hat") == say("l'imbécile") == 5
        assert say("you're an idiot") == say("t'es un imbécile") == say("y'all idiot") == 5 * w.target
        assert say("don't be an idiot") == 5 and say("isn't an idiot") == 5 * w.negated
        assert say("I'll never kill you") == 0


def test_learn_and_edges(spark, docs):
    own = lambda i: "".join(chr(97 + int(d)) for d in str(i + 100))
    toxic = [(i, f"u{own(i)} dolt v{own(i)}. grokka{own(i % 7)}", 1) for i in range(20)]
    copies = [(100 + i, "same word zork", 1) for i in range(20)]  # one context: no evidence
    clean = [(200 + i, f"u{own(i)} fine v{own(i)} same word", 0) for i in range(60)]
    lexicon = T.learn(spark.createDataFrame(toxic + copies + clean, "doc_id long, text string, y int"))
    assert "dolt" in lexicon.words and "gro" in lexicon.stems and not {"zork", "same", "fine"} & set(lexicon.words)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    out = T.classify(docs([(1, "a"), (2, "b"), (3, None), (None, ""), (4, "we will kill you")]), labels, F.lit(False)).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    assert T.classify(docs([]), labels, F.lit(False)).count() == 0
    assert T.learn(spark.createDataFrame([], "doc_id long, text string, y int")) == T.Lexicon({}, {})


def test_threats_of_four_languages():
    w = T.Weights()
    total = lambda t: T.text_total(t, LEX, w, T.finder_of(LEX))
    for text in ("ich werde dich töten", "Dich werde ich töten", "du wirst getötet", "je vais te tuer", "je te tuerai", "je t'ai vu, je vous frapperai",
                 "voy a matarte", "te voy a matar", "te mataré", "I am killing you", "I'm killing you", "you will be killed", "they'll be shot",
                 "we are going to hurt them", "te voy a matar a ti"):
        assert total(text) == w.threat * w.target, text
    for text in ("ich werde dich nicht töten", "je vais te voir", "voy a verte", "you will kill time", "the film will be shot", "nunca te mataré",
                 "I am not killing you", "you will never be killed", "kill the process", "die Uhr wird schlagen", "dich. werde töten"):
        assert total(text) == 0, text
    assert total("mary said you will be killed") == w.threat * w.target * w.reported


def test_composition_against_its_parts():
    """Arc by arc as the machines would go on their own, and patterns as a search over the clause's classes."""
    pick, machine = random.Random(3), T.grammar(2)
    names = sorted({n for p in T.PATTERNS for n in p} | {"report", "negation"})
    for _ in range(300):
        clause = [frozenset(pick.sample(names, pick.randint(0, 2))) | {"word"} for _ in range(12)]
        state, got = machine.start, []
        for classes in clause:
            state, negated, threat = machine.step(state, classes)
            got.append((negated, threat))
        since = [min((i - j for j in range(i + 1) if "negation" in clause[j]), default=99) for i in range(12)]
        assert [n for n, _ in got] == [s <= 2 for s in since]
        assert state[2] == any("target" in c for c in clause) and state[3] == any("report" in c for c in clause)
        begin, want = 0, []
        for i in range(12):
            done = any(completes(clause[begin:i + 1], [s <= 2 for s in since[begin:i + 1]], p) for p in T.PATTERNS)
            want.append(done)
            begin = i + 1 if done else begin
        assert [t for _, t in got] == want


def completes(clause, negated, names):
    """The last word ends the pattern: the clause as letters, the pattern as an expression over them."""
    at, done = 0, False
    for classes, n in zip(clause, negated):
        done = False
        if names[at] in classes:
            at = 0 if names[at] in T.ACTIONS and n else at + 1
            if at == len(names):
                at, done = 0, True
    return done


def test_patterns_as_expressions():
    """Without negations and over single classes, a pattern is met where its classes stand in order."""
    for names in T.PATTERNS:
        letters = {n: chr(97 + i) for i, n in enumerate(dict.fromkeys(names))}
        expression = ".*".join(letters[n] for n in names)
        for word in product([*letters, "other"], repeat=min(len(names) + 1, 5)):
            machine, state, met = T.pattern(names), 0, False
            for c in word:
                state, done = machine.step(state, frozenset({c}))
                met |= done
            assert met == bool(re.search(expression, "".join(letters.get(c, "_") for c in word)))


def test_lexicon_of_any_size(spark, docs):
    """More entries than the earlier bound of 20,000 are kept, and a lexicon that is joined scores as one in memory."""
    letters = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(4))
    n = 21_000
    rows = [(k, " ".join(f"{a}{letters(i)}q {letters(i)}zz" for i in range(n)), 1) for k, a in enumerate("bcdfg")]
    rows += [(100 + i, f"clean words {i} here", 0) for i in range(400)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, y int")
    kept = T.learn(labelled, least_share=0.9, least_weight=3.0)
    table = T.learn(labelled, in_memory=0)
    assert len(kept.words) > 20_000 and table.count() == len(kept.words) + len(kept.stems)
    given = docs([(1, f"you {letters(5)}zz not {letters(7)}zz"), (2, "we will kill you"), (3, ""), (4, f"{letters(5)}zz"), (4, f"{letters(5)}zz"),
                  (None, f"b{letters(9)}q's x"), (6, f"{letters(20_900)}zz")])
    a, b = (sorted((str(r["doc_id"]), r["total"]) for r in T.totals(given, lex).collect()) for lex in (kept, table))
    assert a == b and len(a) == 7 and dict(a)["6"] > 0


def test_calibration_uses_every_total(spark):
    rows = [(float(t), int(t > 3)) for t in range(40)] + [(1e6, 1), (0.01, 0), (0.04, 0), (5.0, 0)]
    got = T.calibrate(spark.createDataFrame(rows, "total double, y int"))
    x, y = np.array([[np.log1p(t), 1.0] for t, _ in rows]), np.array([y for _, y in rows])
    p = 1 / (1 + np.exp(-np.clip(x @ np.array(got), -30, 30)))
    assert np.abs(x.T @ (y - p) - (np.array(got) - np.array(T.Calibration()))).max() < 1e-6
    assert T.calibrate(spark.createDataFrame([(1.0, 1)], "total double, y int")) == T.Calibration()


def test_ridge_and_calibration_against_plain_numpy(spark):
    """The summed normal equations give the ridge solution of all training rows at once, the calibration is the min-max form of
    isotonic regression; ties and repeated rows included."""
    rng, dims, ridge, seed = np.random.default_rng(1), 16, 1e-2, 11
    x = rng.normal(0, 2, (400, rff.FEATURES)).round(1)
    y = (x[:, 0] + rng.normal(0, 1, 400) > 0).astype(int)
    x[50:60], y[50:60] = x[40:50], y[40:50]
    rows = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i])) for i in range(400)], "doc_id long, x array<double>, y int")
    model = rff.fit(rows, dims=dims, ridge=ridge, seed=seed)
    part = F.pmod(F.shiftright(F.xxhash64("doc_id", F.lit(seed)), 8), F.lit(5))
    part = np.array([r[0] for r in rows.orderBy("doc_id").select(part).collect()])
    z = rff.lift((x - x.mean(0)) / x.std(0), model.directions, model.phases)
    fitted = part < 4
    pull = np.sqrt(ridge * fitted.sum() / dims) * np.eye(dims + 1)[:dims]  # the constant carries none
    plain = np.linalg.lstsq(np.vstack([z[fitted], pull]), np.append(y[fitted], np.zeros(dims)), rcond=None)[0]
    assert np.abs(z @ plain - model.ridge(x)).max() < 1e-6

    scores = np.round(model.ridge(x[part == 4]), 3)
    values = [(s, float((scores == s).sum()), float(y[part == 4][scores == s].sum())) for s in np.unique(scores)]
    w, p = np.array([v[1] for v in values]), np.array([v[2] for v in values])
    n = len(values)
    rate = [max(min(p[a:b + 1].sum() / w[a:b + 1].sum() for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
    block = np.concatenate(([0], np.cumsum(np.diff(rate) > 1e-12)))
    pulled = [(p[block == k].sum() + p.sum() / w.sum()) / (w[block == k].sum() + 1) for k in range(block[-1] + 1)]
    want = np.clip(np.maximum.accumulate(pulled)[block], 0, 1)
    steps, levels = rff.isotonic(values)
    assert np.abs(np.interp(np.unique(scores), steps, levels) - want).max() < 1e-12
    assert (model.steps == steps).all() and (model.levels == levels).all()
