import random

import numpy as np
import pytest

from cases import LONG, frame, rows
from martline.llm import quality
from martline.llm.lexicon import Lexicon, TermCounter, fold_word, folded_words
from martline.llm.quality import STATISTICS, document_statistics, isotonic, score_quality, statistics, train_quality
from martline.llm.toxicity import fit_logistic, score_toxicity, train_toxicity


def test_folding():
    assert [fold_word(w) for w in ("idi0t", "ѕtuрid", "m0r0n!!", "$cum", "ｉｄｉｏｔ", "id​iot", "clown***")] == [
        "idiot", "stupid", "moron", "scum", "idiot", "idiot", "clown"]
    assert fold_word("12345") == "" and fold_word("+1") == "" and folded_words(None) == []


def test_words_are_found_inside_tokens():
    assert folded_words("du,idiot so-called-idiot l'idi0t тыidiot idiot2you") == [
        "du", "idiot", "so", "called", "idiot", "l", "idiot", "tы", "idiot", "idiot", "you"]
    assert folded_words("сyкa дурaк ѕtuрid") == ["cyka", "дypak", "stupid"]  # look-alikes are no border
    assert folded_words("你这个傻瓜idiot啊 100元") == ["你", "这", "个", "傻", "瓜", "idiot", "啊", "元"]
    lexicon = Lexicon({"idiot": 2.0, "傻 瓜$": 3.0}, ["傻瓜相机"])
    hits = lambda t: sorted(lexicon.hits(folded_words(t))[1].values())
    assert hits("x" * 100 + "idiot" + "y" * 3000 + "idiot") == [2.0, 2.0]
    assert hits("天" * 5000 + "傻瓜") == [3.0] and hits("天傻瓜相机天") == []


def test_one_rule_for_words_of_all_lengths():
    lexicon = Lexicon({"idiot$": 2.0, "grumblerish$": 3.0, "ass$": 1.0}, ["patriidiotic"])
    hits = lambda t: sorted(lexicon.hits(folded_words(t))[1].values())
    for n in (0, 1, 3, 33, 34, 35, 36, 400):
        assert hits("q" * n + "idiot") == [2.0] and hits("q" * n + "grumblerish" + "q" * n) == [3.0]
    assert hits("youidiot youidiotyou") == [2.0, 2.0] and hits("class patriidiotic") == [] and hits("ass") == [1.0]


def test_spelled_and_accented_words():
    assert folded_words("b.l.o.r.g.h i d i o t! id-iot ídiot !diot Ìd.ï.ôt") == ["blorgh", "idiot", "idiot", "idiot", "idiot", "idiot"]
    assert folded_words("l'eau d'or it's a b") == ["l", "eau", "d", "or", "it", "s", "a", "b"]
    assert folded_words("un-able to-do so-so") == ["un", "able", "todo", "soso"]


def test_a_term_that_clean_words_hold_counts_at_a_beginning_only(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(3, 8)))
    rows = [(i, " ".join([word() for _ in range(30)] + (["zonker", "grumbler"] if i % 4 == 0 else ["amazonkeres"] if i % 4 == 1 else [])),
             int(i % 4 == 0)) for i in range(800)]
    model = train_toxicity(spark.createDataFrame(rows, "id long, text string, label int"))
    assert "zonker" in model["outside"] and "grumbler" not in model["outside"]
    want = {"the amazonkeres are fine words here": 0, "the zonker is one word": 1, "the yougrumbler is not one word": 1}
    got = {r.text: r.matches for r in score_toxicity(spark.createDataFrame([(t,) for t in want], "text string"), model).collect()}
    assert got == want


def test_terms_of_unspaced_scripts():
    counter = TermCounter()
    counter.add(folded_words("坏傻瓜 idiot 傻"))
    got = {t: (d, n) for t, d, n in counter.take()}
    assert got["傻$"] == (1, 2) and got["傻 瓜$"] == (1, 1) and got["坏 傻 瓜$"] == (1, 1) and got["idiot$"] == (1, 1)
    assert "瓜 idiot$" not in got and "瓜 傻$" not in got


def test_lexicon_matches_by_word_and_spares_exceptions():
    rnd, weights = random.Random(3), {"ab$": 2.0, "abc": 1.0, "b$": 0.5, "cab": 3.0}
    lexicon = Lexicon(weights, ["ab cab"])
    for _ in range(500):
        words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(0, 12))]
        at, want = 0, {}
        spared = [i for i in range(len(words) - 1) if words[i:i + 2] == ["ab", "cab"]]
        for n, w in enumerate(words):
            found = [v for t, v in weights.items() if (t.endswith("$") and w == t[:-1]) or (not t.endswith("$") and w.startswith(t))]
            if found and not any(n in (i, i + 1) for i in spared):
                want[at] = max(found)
            at += len(w) + 1
        assert lexicon.hits(words)[1] == want


def test_term_counter():
    counter = TermCounter()
    counter.add(["abcd", "abcd", "abce"])
    counter.add(["abc"])
    got = {t: (d, n) for t, d, n in counter.take()}
    assert got["abc"] == (2, 4) and got["abcd$"] == (1, 2) and got["abc$"] == (1, 1)


def labelled(spark, n=400, seed=2):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(3, 8)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rnd.randint(20, 200))]
        label = int(i % 5 == 0)
        for _ in range(len(words) // 15 + 1 if label else 0):
            words[rnd.randrange(len(words))] = rnd.choice(["grumbler", "gr0mble", "zonker", "zonkery"])
        if not label and i % 4 == 1:
            words[3:5] = ["harmless", "zonker"]  # a clean phrase with a term
        out.append((i, " ".join(words), label))
    return out, spark.createDataFrame(out, "id long, text string, label int")


def test_toxicity_learns_terms_and_exceptions(spark):
    _, train = labelled(spark)
    model = train_toxicity(train)
    assert "grumbler$" in model["weights"] and "harmless zonker" in model["exceptions"]
    fresh, test = labelled(spark, seed=99)
    got = {r.id: r.score for r in score_toxicity(test, model).collect()}
    right = sum((got[i] >= 0.7) == bool(label) for i, _, label in fresh)
    assert right >= 0.97 * len(fresh) and all(0 <= s <= 1 for s in got.values())


def test_toxicity_of_texts_without_spaces(spark):
    rnd = random.Random(7)
    def text(label):  # noqa: E306
        signs = [chr(rnd.randrange(0x4E00, 0x4E80)) for _ in range(300)]
        for _ in range(6 if label else 0):
            signs.insert(rnd.randrange(100, len(signs)), "傻瓜")
        return "".join(signs)
    train = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(400)]
    model = train_toxicity(spark.createDataFrame(train, "id long, text string, label int"))
    fresh = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(100)]
    got = {r.id: r.score for r in score_toxicity(spark.createDataFrame(fresh, "id long, text string, label int"), model).collect()}
    assert sum((got[i] >= 0.7) == bool(label) for i, _, label in fresh) >= 97


def test_terms_of_a_rare_language_enter_the_lexicon(spark):
    rnd = random.Random(5)
    word = lambda k: "".join(rnd.choice(k) for _ in range(6))
    train = [(i, " ".join([word("abcdef") for _ in range(4)] + ["grumbler"] * (i < 4000)), int(i < 4000)) for i in range(40_000)]
    # about 2 % of the toxic documents are in another language; each of its words is in a fifth of them
    rare = ["zonker", "zappler", "zittern", "zausel", "zwiebel"]
    train += [(50_000 + i, " ".join([word("uvwxyz") for _ in range(4)] + [rare[i % 5]]), 1) for i in range(95)]
    train += [(60_000 + i, " ".join(word("uvwxyz") for _ in range(4)), 0) for i in range(95)]
    weights = train_toxicity(spark.createDataFrame(train, "id long, text string, label int"))["weights"]
    assert {f"{w}$" for w in ["grumbler", *rare]} <= set(weights)


def test_toxicity_odd_rows(spark):
    nothing = spark.createDataFrame([], "id long, text string, label int")
    model = train_toxicity(nothing)
    got = score_toxicity(frame(spark), model).collect()
    assert len(got) == len(rows()) and {r.score for r in got} == {0.5}
    only = spark.createDataFrame([(1, "a b", 1), (2, None, 1), (3, "c", 7)], "id long, text string, label int")
    scores = {r.score for r in score_toxicity(frame(spark), train_toxicity(only)).collect()}
    assert len(scores) == 1 and scores.pop() == pytest.approx(0.75)
    assert score_toxicity(frame(spark, []), model).count() == 0


def test_logistic_curve_is_fitted():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - x[:, 1])))).astype(float)
    assert np.allclose(fit_logistic(x, y), [0.5, 2, -1], atol=0.2)


def brute_isotonic(ones, n):
    """Rising means by the max-min formula."""
    k = len(n)
    mean = lambda i, j: ones[i:j + 1].sum() / n[i:j + 1].sum()
    return [max(min(mean(i, j) for j in range(m, k)) for i in range(m + 1)) for m in range(k)]


def test_isotonic_equals_the_max_min_formula():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = rng.integers(1, 6, 15).astype(float)
        ones = np.array([rng.integers(0, int(k) + 1) for k in n], dtype=float)
        want = brute_isotonic(ones, n)
        knots, levels = isotonic(np.arange(15.0), ones, n)
        assert len(levels) == len(set(np.round(want, 9))) and np.all(np.diff(levels) >= 0) and np.all(np.diff(knots) > 0)


def test_normal_equations_are_the_whole_sums(spark):
    rng = np.random.default_rng(5)
    data = [(rng.standard_normal(len(STATISTICS)).tolist(), float(i % 2), i % quality.FOLDS) for i in range(200)]
    rows_ = spark.createDataFrame(data, "stats array<double>, label double, fold int").repartition(5)
    model = {"mean": np.zeros(len(STATISTICS)), "scale": np.ones(len(STATISTICS)),
             "directions": rng.standard_normal((len(STATISTICS), quality.FEATURES)), "phases": rng.uniform(0, 6, quality.FEATURES)}
    gram, right = quality._normal_equations(rows_, model)
    for f in range(quality.FOLDS):
        x = quality.random_features(np.array([d[0] for d in data if d[2] == f]), model)
        assert np.allclose(gram[f], x.T @ x) and np.allclose(right[f], x.T @ np.array([d[1] for d in data if d[2] == f]))


def test_random_features_approximate_the_kernel():
    rng = np.random.default_rng(6)
    d = len(STATISTICS)
    model = {"mean": np.zeros(d), "scale": np.ones(d), "directions": rng.standard_normal((d, quality.FEATURES)) / np.sqrt(d),
             "phases": rng.uniform(0, 2 * np.pi, quality.FEATURES)}
    x = rng.standard_normal((30, d))
    z = quality.random_features(x, model)[:, 1:]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * d))
    assert np.abs(z @ z.T - exact).max() < 0.35 and np.abs(z @ z.T - exact).mean() < 0.08


def test_quality_learns(spark):
    rnd = random.Random(11)
    good = [" ".join(rnd.choice("the water house of morning every school".split()) for _ in range(80)) + "." for _ in range(300)]
    bad = [" ".join(rnd.choice("the water house".split()) + "###" for _ in range(80)) for _ in range(100)]
    data = [(i, t, int(i < 300)) for i, t in enumerate(good + bad)]
    docs = document_statistics(spark.createDataFrame(data, "id long, text string, label int"))
    model = train_quality(docs.select("_row.id", "_row.label", "_stats").withColumnRenamed("_stats", "stats"))
    got = {r.id: r.score for r in score_quality(docs, model).collect()}
    assert sum((got[i] >= 0.7) == bool(label) for i, _, label in data) >= 0.98 * len(data)


def test_quality_odd_rows(spark):
    docs = document_statistics(frame(spark))
    model = train_quality(spark.createDataFrame([], "id long, stats array<double>, label int"))
    got = score_quality(docs, model).collect()
    assert len(got) == len(rows()) and {r.score for r in got} == {0.5}
    assert score_quality(document_statistics(frame(spark, [])), model).count() == 0
    assert statistics(None) == [0.0] * len(STATISTICS) and len(statistics(LONG)) == len(STATISTICS)
    assert np.isfinite(statistics("a")).all() and np.isfinite(statistics("日本")).all()


def test_accented_words_fold_alike_on_the_short_way():
    import random

    from martline.llm import lexicon as lx
    rnd = random.Random(11)
    letters = [*"abeio", *map(chr, lx._PLAIN)]
    for c in map(chr, lx._PLAIN):
        for word in (c, f"caf{c}s", c + "".join(rnd.choices(letters, k=rnd.randint(1, 12)))):
            assert lx.split_token(word) == lx.split_token(f'("{word}!"),') == [lx.fold_word(word)]
    assert lx.folded_words("a b c") == ["a", "b", "c"] and lx.folded_words("so i d i ó t now") == ["so", "idiot", "now"]
