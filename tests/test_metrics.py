import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logloom.operators import bleu, evaluation, label_scores, pairs, perplexity, rouge
from logloom.functions.text import normalize_text
from logloom.operators.ngrams import clipped, repeats
from tests.porter import stem


def make(spark, rows):
    return spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(rows)], "example_id bigint, prediction string, reference string")


def values(scores):
    return {(r.metric, r.sub_metric): r.value for r in scores.collect()}


CASES = [
    ("Yes.", "yes", 1, 0, (1, 1, 1)),
    ("The cat, sat!", "the cat ran", 0, 0, (2 / 3, 2 / 3, 2 / 3)),
    ("a a a b", "a c", 0, 0, (0.5, 0.5, 0.5)),
    ("", "", 1, 1, (1, 1, 1)),
    ("", "a", 0, 0, (0, 0, 0)),
    ("Été", "été", 1, 0, (1, 1, 1)),
    ("x", "y", 0, 0, (0, 0, 0)),
]


def test_exact_match_and_token_f1(spark):
    df = make(spark, [(p, r) for p, r, *_ in CASES])
    got = df.select(
        "example_id",
        pairs.exact_match(F.col("prediction"), F.col("reference")).alias("em"),
        pairs.exact_match(F.col("prediction"), F.col("reference"), False).alias("raw"),
        pairs.token_scores(F.col("prediction"), F.col("reference")).alias("t"),
    ).orderBy("example_id").collect()
    for row, (p, r, em, raw, t) in zip(got, CASES):
        assert (row.em, row.raw) == (em, raw), (p, r)
        assert tuple(row.t) == pytest.approx(t), (p, r)
    assert pairs.exact_match_score(df.limit(0)).first().value is None
    mean = values(pairs.token_f1_score(df))
    assert mean["f1", "f1"] == pytest.approx(sum(c[4][2] for c in CASES) / len(CASES))


def test_token_scores_swap(spark):
    df = make(spark, [(p, r) for p, r, *_ in CASES])
    one = values(pairs.token_f1_score(df))
    other = values(pairs.token_f1_score(df.select("example_id", F.col("reference").alias("prediction"), F.col("prediction").alias("reference"))))
    assert one["f1", "precision"] == pytest.approx(other["f1", "recall"])
    assert one["f1", "f1"] == pytest.approx(other["f1", "f1"])


def test_alignment(spark):
    p = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "example_id int, prediction string")
    r = spark.createDataFrame([(1, "a"), (2, "x"), (9, "z")], "example_id int, reference string")
    assert pairs.exact_match_score(pairs.align(p, r)).first().value == pytest.approx(1 / 3)
    assert pairs.align(p, r, keep_unmatched=False).count() == 2


def test_labels(spark):
    df = make(spark, list(zip("abbb", "aabc")))
    want = {
        "macro": (0.444444, 0.5, 0.388889),
        "micro": (0.5, 0.5, 0.5),
        "weighted": (0.583333, 0.5, 0.458333),
    }
    for average, expected in want.items():
        got = values(label_scores.label_f1_score(df, average))
        assert tuple(got["f1", k] for k in ("precision", "recall", "f1")) == pytest.approx(expected, abs=1e-6)
    assert values(pairs.accuracy_score(df))["accuracy", None] == 0.5
    with pytest.raises(ValueError):
        label_scores.label_f1_score(df, "other")


CAT = ("the cat sat on the mat", "the cat lay on the mat")


def test_rouge(spark):
    got = values(rouge.rouge_score(make(spark, [CAT])))
    for t, want in (("rouge1", 5 / 6), ("rouge2", 0.6), ("rougeL", 5 / 6)):
        for part in rouge.PARTS:
            assert got[t, part] == pytest.approx(want)
    same = values(rouge.rouge_score(make(spark, [("a b c", "A, b; C"), ("", "")]), stem=True))
    assert same["rouge1", "fmeasure"] == 0.5 and same["rougeL", "recall"] == 0.5
    stemmed = values(rouge.rouge_score(make(spark, [("running dogs", "runs dog")]), stem=True))
    assert stemmed["rouge1", "fmeasure"] == 1.0


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], (last + 1 if x == y else max(row[j], row[j - 1]))
    return row[-1]


def test_rouge_l_against_table(spark):
    import random

    rng = random.Random(3)
    rows = [(" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 90))), " ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 70)))) for _ in range(40)]
    got = rouge.rouge_per_example(make(spark, rows), ("rougeL",), stem=False).orderBy("example_id").collect()
    for row, (p, r) in zip(got, rows):
        want = lcs(p.split(), r.split()) / len(p.split()) if p else 0.0
        assert row.precision == pytest.approx(want)


@pytest.mark.parametrize(
    "word,want",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"),
        ("motoring", "motor"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"),
        ("relational", "relat"), ("conditional", "condit"), ("digitizer", "digit"), ("triplicate", "triplic"), ("hopefulness", "hope"),
        ("adoption", "adopt"), ("effective", "effect"), ("probate", "probat"), ("rate", "rate"), ("controll", "control"), ("sky", "sky"),
        ("dies", "die"), ("died", "die"), ("cried", "cri"), ("enjoy", "enjoy"), ("happily", "happili"), ("news", "news"), ("rationally", "ration"),
        ("geology", "geolog"), ("hopefully", "hope"), ("owed", "owe"),
    ],
)
def test_stem(word, want):
    assert stem(word) == want


def test_bleu(spark):
    got = values(bleu.bleu_score(make(spark, [CAT]), "word", "none"))
    assert [got["bleu", f"precision_{n}"] for n in range(1, 5)] == pytest.approx([5 / 6, 3 / 5, 1 / 4, 0])
    assert got["bleu", "bleu"] == 0
    smooth = values(bleu.bleu_score(make(spark, [CAT]), "word", "exp"))
    assert smooth["bleu", "bleu"] == pytest.approx((5 / 6 * 3 / 5 * 1 / 4 * 1 / 6) ** 0.25)
    same = values(bleu.bleu_score(make(spark, [("a b c d e", "a b c d e")])))
    assert same["bleu", "bleu"] == pytest.approx(1)
    short = values(bleu.bleu_score(make(spark, [("a b c d", "a b c d e f")])))
    assert short["bleu", "bleu"] == pytest.approx(math.exp(1 - 6 / 4))
    two = spark.createDataFrame([(1, "a b c d", ["a b c d e f g", "a b c x"])], "example_id int, prediction string, references array<string>")
    got = values(bleu.bleu_score(two))
    assert got["bleu", "bleu"] == pytest.approx(1)


def test_bleu_words(spark):
    df = spark.createDataFrame([("He said: 3,000 km, ok-ish (yes).",)], "x string")
    words = df.select(bleu.bleu_words(F.col("x"))).first()[0]
    assert words == ["He", "said", ":", "3,000", "km", ",", "ok-ish", "(", "yes", ")", "."]


def test_perplexity(spark):
    df = spark.createDataFrame([(1.0, 3), (3.0, 1)], "loss double, n_tokens bigint")
    assert values(perplexity.perplexity_score(df))["perplexity", "perplexity"] == pytest.approx(math.exp(2))
    assert values(perplexity.perplexity_score(df, weighted=True))["perplexity", "perplexity"] == pytest.approx(math.exp(1.5))


def test_bundles(spark):
    df = make(spark, [("yes", "yes"), ("no", "yes")])
    qa = values(evaluation.domain_metrics(df, "qa"))
    assert set(qa) == {("domain", x) for x in ("exact_match", "precision", "recall", "f1")}
    summary = values(evaluation.domain_metrics(df, "summarization"))
    assert set(summary) == {("domain", x) for x in ("rouge1_f1", "rouge2_f1", "rougeL_f1", "bleu")}
    assert set(values(evaluation.domain_metrics(df, "classification"))) == {("domain", x) for x in ("accuracy", "precision", "recall", "f1")}
    assert evaluation.domain_metrics(df, "nothing").count() == 0
    evaluation.register_domain("mine", evaluation.qa_bundle)
    assert evaluation.domain_metrics(df, "mine").count() == 4
    row = evaluation.headline(evaluation.calculate_metrics(df, ["exact_match", "f1", "bleu", "rouge", "unknown"])).first()
    assert row.exact_match == 0.5 and row.f1 == 0.5 and row.rouge_l == 0.5 and row.bleu == 0
    with pytest.raises(ValueError):
        evaluation.calculate_metrics(df, ["unknown"])


def test_normalize(spark):
    df = spark.createDataFrame([(" Don't STOP—Été_1! ",)], "x string")
    assert df.select(normalize_text(F.col("x"))).first()[0] == "don't stop été_1"


def test_compare_models(spark):
    scores = spark.createDataFrame(
        [("a", "f1", "f1", 0.1), ("b", "f1", "f1", 0.2), ("a", "bleu", "bleu", 0.3)],
        "model string, metric string, sub_metric string, value double",
    )
    assert [tuple(r) for r in evaluation.compare_models(scores, ["a", "b"]).collect()] == [("f1", "f1", 0.1, 0.2)]


def test_stems_equal_the_letterwise_stemmer(spark):
    import random

    from logloom.functions import stemming

    rng = random.Random(11)
    endings = [*stemming.STEP2, *stemming.STEP3, *stemming.STEP4, *"s es ies ied eed y e ll yyed yying ed ing".split(), ""]
    words = {
        "".join(rng.choice("aeiouybcdlstxyz9w") for _ in range(rng.randint(1, 7))) + rng.choice(endings) + rng.choice(["", "s", "ed", "ing", "ly"])
        for _ in range(4000)
    } | set(stemming.IRREGULAR) | {"", "a", "ss", "yes"}
    row = spark.createDataFrame([(sorted(words),)], "ws array<string>").select("ws", stemming.stem_words(F.col("ws")).alias("s")).first()
    assert [(w, s) for w, s in zip(row.ws, row.s) if s != (stem(w) if len(w) > 3 else w)] == []


def test_clipped_counts_against_counters(spark):
    import random
    from collections import Counter

    from logloom.operators.ngrams import clipped

    rng = random.Random(7)

    def some(limit):
        return [rng.choice("abc") for _ in range(rng.randint(0, limit))]

    rows = [(some(30), [some(25) for _ in range(rng.randint(0, 3))]) for _ in range(60)] + [([], []), (["a"] * 5000, [["a"] * 4000])]
    df = spark.createDataFrame(rows, "h array<string>, rs array<array<string>>")
    got = df.select("h", "rs", *[clipped(F.col("h"), F.col("rs"), n).alias(f"c{n}") for n in (1, 2, 4)]).collect()
    for row in got:
        for n in (1, 2, 4):
            def count(ws):
                return Counter(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))

            most = Counter()
            for r in row.rs:
                most |= count(r)
            have = count(row.h)
            assert tuple(row[f"c{n}"]) == ((have & most).total(), have.total()), (n, row)


def test_fused_metrics_read_the_pairs_once(spark, tmp_path):
    make(spark, [CAT, ("running dogs", "runs dog"), ("", "x"), (None, "y"), ("z", None)]).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    names = ["exact_match", "f1", "accuracy", "bleu", "rouge"]
    together = evaluation.calculate_metrics(df, names, domain="summarization")
    plan = together._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1, plan
    alone = {}
    for name in names:
        alone |= values(evaluation.calculate_metrics(df, [name]))
    alone |= values(evaluation.domain_metrics(df, "summarization"))
    assert values(together) == pytest.approx(alone)
    assert alone["rouge1", "fmeasure"] == pytest.approx((5 / 6 + 1) / 5)
    empty = values(evaluation.calculate_metrics(df.limit(0), names))
    assert empty["exact_match", None] is None and empty["rouge1", "recall"] is None and empty["bleu", "bleu"] == 0


def test_registered_measures_share_the_aggregation(spark):
    from logloom.operators.measures import Measure

    def shorter():
        return [Measure({"short": (F.length("prediction") < F.length("reference")).cast("double")}, {"short_mean": F.avg("short")},
                        [("domain", "shorter", F.col("short_mean"))])]

    evaluation.register_measures("brief", shorter)
    got = values(evaluation.calculate_metrics(make(spark, [("a", "bb"), ("cc", "d")]), ["exact_match"], domain="brief"))
    assert got == {("exact_match", None): 0.0, ("domain", "shorter"): 0.5}


def test_grams_are_clipped_by_sets_and_repeats(spark):
    pick = random.Random(3)

    def words():
        return [pick.choice("abcde") for _ in range(pick.randint(0, 30))]

    lists = [(k, words(), [words() for _ in range(pick.randint(1, 3))]) for k in range(60)]
    df = spark.createDataFrame(lists, "id int, h array<string>, rs array<array<string>>")
    row = df.select("id", *[clipped(F.col("h"), F.col("rs"), n).alias(f"n{n}") for n in (1, 2, 3)], repeats(F.col("h")).alias("again")).collect()
    grams = lambda ws, n: Counter(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    for got, (_, h, rs) in zip(sorted(row, key=lambda r: r.id), lists):
        for n in (1, 2, 3):
            most = Counter()
            for r in rs:
                most |= grams(r, n)
            assert tuple(got[f"n{n}"]) == (sum((grams(h, n) & most).values()), max(len(h) - n + 1, 0))
        assert got.again == sorted((Counter(h) - Counter(set(h))).elements())
