"""n-gram perplexity, repeated lines and pseudonyms on small tables, against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from logloom.functions import anonymise as A
from logloom.operators import ngram_model as M
from logloom.operators import repeated_lines as R

# --- n-gram model ---


class Brute:
    def __init__(self, texts, order, d=M.DISCOUNT):
        self.order, self.d = order, d
        padded = [[M.START] * (order - 1) + ws for ws in texts]
        counts = {order: Counter(tuple(p[i : i + order]) for p in padded for i in range(len(p) - order + 1))}
        for k in range(order - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        self.counts = counts
        self.sums, self.kinds = defaultdict(int), defaultdict(int)
        for k, table in counts.items():
            for g, c in table.items():
                self.sums[k, g[:-1]] += c
                self.kinds[k, g[:-1]] += 1

    def p(self, gram):
        k, context = len(gram), gram[:-1]
        if k == 0:
            return 1 / (self.kinds[1, ()] + 1)
        lower = self.p(gram[1:])
        if not self.sums[k, context]:
            return lower
        return max(self.counts[k][gram] - self.d, 0) / self.sums[k, context] + self.d * self.kinds[k, context] / self.sums[k, context] * lower

    def log(self, words):
        padded = [M.START] * (self.order - 1) + words
        return sum(math.log(self.p(tuple(padded[i : i + self.order]))) for i in range(len(words)))


@pytest.fixture(scope="module")
def sentences():
    pick = random.Random(10)
    words = [f"w{k}" for k in range(30)]
    return [["the"] * pick.randint(0, 4) + [pick.choice(words[: pick.randint(2, 30)]) for _ in range(pick.randint(0, 25))] for _ in range(60)] + [[], ["the"], ["the"] * 400]


def table(spark, lists):
    return spark.createDataFrame([(k, w) for k, w in enumerate(lists)], "id long, words array<string>")


@pytest.mark.parametrize("order", [1, 2, 3])
def test_perplexity(spark, sentences, order):
    words = table(spark, sentences)
    model, brute = M.count_model(words, order), Brute(sentences, order)
    new = [["the", "w1", "unknown", "w2"], ["unknown"], [], ["w3", "the", "the", "w5"], ["w29", "w28"]]
    for lists, counted in ((sentences, True), (sentences, False), (new, False)):
        got = {r["id"]: r for r in M.score(table(spark, lists), "id", model, counted).collect()}
        assert len(got) == len(lists)
        for k, ws in enumerate(lists):
            assert got[k]["n_tokens"] == len(ws)
            if ws:
                assert got[k]["log_prob"] == pytest.approx(brute.log(ws), rel=1e-9)
                assert got[k]["perplexity"] == pytest.approx(math.exp(-brute.log(ws) / len(ws)), rel=1e-9)
            else:
                assert got[k]["perplexity"] is None
    whole = M.corpus_perplexity(M.score(words, "id", model, True)).first()
    assert whole["n_tokens"] == sum(map(len, sentences))


@pytest.mark.parametrize("top", [1, 2, 4])
def test_all_orders_from_one_count(spark, sentences, top):
    got = {(r["id"], r["ngram_order"]): r for r in M.own_scores(table(spark, sentences), "id", top).collect()}
    assert len(got) == top * len(sentences)
    for order in range(1, top + 1):
        brute = Brute(sentences, order)
        for k, ws in enumerate(sentences):
            assert got[k, order]["n_tokens"] == len(ws)
            if ws:
                assert got[k, order]["log_prob"] == pytest.approx(brute.log(ws), rel=1e-9)
                assert got[k, order]["perplexity"] == pytest.approx(math.exp(-brute.log(ws) / len(ws)), rel=1e-9)
            else:
                assert got[k, order]["perplexity"] is None


def test_own_scores_of_nothing_and_of_repeated_keys(spark):
    assert M.own_scores(table(spark, []), "id", 2).count() == 0
    assert [tuple(r) for r in M.own_scores(table(spark, [[]]), "id", 2).orderBy("ngram_order").collect()] == [(0, 1, 0, None, None), (0, 2, 0, None, None)]
    twice = spark.createDataFrame([(None, ["a", "b"]), (None, ["b"]), (1, ["a"])], "id long, words array<string>")
    assert {(r["id"], r["n_tokens"]) for r in M.own_scores(twice, "id", 2).collect()} == {(None, 3), (1, 1)}


def test_probabilities_sum_to_one(spark, sentences):
    brute = Brute(sentences, 2)
    known = [g[0] for g in brute.counts[1]]
    assert sum(brute.p(("the", w)) for w in [*known, "?"]) == pytest.approx(1)
    level = M.count_model(table(spark, sentences), 2).levels[1].where(F.col("gram").startswith("the "))
    assert {r["gram"]: pytest.approx(r["p"]) for r in level.collect()} == {f"the {w}": brute.p(("the", w)) for (v, w) in brute.counts[2] if v == "the"}


def test_an_empty_corpus(spark):
    none = table(spark, [])
    model = M.count_model(none, 2)
    assert M.score(none, "id", model).count() == 0
    assert M.score(table(spark, [["a"]]), "id", model).first()["perplexity"] == pytest.approx(1)


def test_frequent_grams_are_broadcast(spark, sentences):
    model = M.count_model(table(spark, sentences), 2)
    plan = M.score(table(spark, sentences), "id", model, True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


# --- repeated lines ---


def brute_repeated(texts, share, least):
    counts = Counter(x for t in texts if t is not None for x in {y.strip(" \t\r") for y in t.split("\n")} if x)
    limit = max(least, math.ceil(len(texts) * share))
    return {x: n for x, n in counts.items() if n >= limit}


def test_repeated_lines(spark):
    pick = random.Random(27)
    lines = ["Page header", "  Page header\t", "footer", "Zeile", "", "   ", "rare"]
    texts = ["\n".join(pick.choice(lines[:-1] + [f"own {k} {j}" for j in range(4)]) for _ in range(pick.randint(0, 9))) for k in range(80)]
    texts += [None, "", "\n\n", "rare\nrare\nrare\nrare\r", "rare", "Page header\n" * 3000 + "end"]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, counter int")
    for share, least in ((0.05, 3), (0.5, 3), (0.01, 2), (0.999, 3)):
        found = R.repeated_lines(df, share=share, least=least)
        want = brute_repeated(texts, share, least)
        assert {r["line"]: r["documents"] for r in found.collect()} == want
        got = {r["doc_id"]: r for r in R.without_lines(df, found).collect()}
        for k, t in enumerate(texts):
            if t is None:
                assert got[k]["text"] is None and got[k]["lines_removed"] == 0
                continue
            kept = [x for x in t.split("\n") if x.strip(" \t\r") not in want]
            assert got[k]["text"] == "\n".join(kept) and got[k]["lines_removed"] == len(t.split("\n")) - len(kept)


def test_repeated_lines_with_crowded_counters(spark, monkeypatch):
    monkeypatch.setattr(R, "BUCKETS", 2)
    df = spark.createDataFrame([(f"line {k % 7}\nother {k}",) for k in range(70)], "text string")
    assert {r["line"]: r["documents"] for r in R.repeated_lines(df, share=0.1).collect()} == {f"line {k}": 10 for k in range(7)}
    assert R.repeated_lines(df.limit(0)).count() == 0


# --- pseudonyms ---


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def brute_anonymised(text, key):
    def name(m):
        span, kind = m.group(), None
        if re.fullmatch(A.EMAIL, span):
            kind = "EMAIL"
        elif re.fullmatch(A.SECRET, span):
            kind = "SECRET"
        elif re.fullmatch(A.ADDRESS, span):
            kind = "IP" if max(map(int, span.split("."))) <= 255 else None
        elif re.fullmatch(A.CARD, span):
            kind = "CARD" if luhn(re.sub("[^0-9]", "", span)) else None
        elif re.fullmatch(A.PHONE, span):
            kind = "PHONE"
        if kind is None:
            return span
        plain = re.sub("[^0-9]", "", span) if kind in ("CARD", "PHONE") else span.lower()
        return f"[{kind}_{hashlib.sha256(f'{key}|{kind}|{plain}'.encode()).hexdigest()[:8]}]"

    return re.sub(A.SPAN, name, text)


TEXTS = [
    "Mail Ada.Byron+x@mail2.example.com, or ada.byron+X@MAIL2.example.com; not a@b", "at 10.0.0.1 and 10.0.0.256, v1.2.3.4.5, 1.2.3.4",
    "card 4111 1111 1111 1111 and 4111111111111111, bad 4111111111111112, long 41111111111111111111111", "+1 (663) 555-6869 or 663 555 6869, 663-555-6869, 12 345",
    'token = "7c72db563d7f6e50" password: hunter2@example.com\tAPI_KEY=abc', "a" * 200_000 + "@x.org", "1" * 100_000, "x@" + "a." * 5000 + "org",
    "", "plain\n\ntext é", "10.0.0.1", "größe@example.com", "10.0.0.1" * 3,
]


def test_anonymised(spark):
    df = spark.createDataFrame([(k, t, "s") for k, t in enumerate([*TEXTS, None])], "doc_id long, text string, kind string")
    got = {r["doc_id"]: r["text"] for r in A.anonymised(df, "key").collect()}
    for k, t in enumerate(TEXTS):
        assert got[k] == brute_anonymised(t, "key"), t[:80]
    assert got[len(TEXTS)] is None
    assert got[0].count("[EMAIL_") == 2 and len(set(re.findall(r"\[EMAIL_\w+\]", got[0]))) == 1
    assert got[2].count("[CARD_") == 2 and len(set(re.findall(r"\[CARD_\w+\]", got[2]))) == 1 and "4111111111111112" in got[2]
    other = {r["doc_id"]: r["text"] for r in A.anonymised(df, "another").collect()}
    assert other[0] != got[0] and other[9] == got[9]
    counts = {r["kind"]: (r["documents"], r["matches"], r["different"]) for r in A.span_counts(A.with_spans(df, "key").select("spans")).collect()}
    assert counts["CARD"] == (1, 2, 1) and counts["EMAIL"][2] < counts["EMAIL"][1] and set(counts) == set(A.KINDS)
    assert A.anonymised(df.limit(0), "key").count() == 0


@pytest.mark.parametrize("top", [1, 2, 3, 4])
def test_own_scores_of_split_words_and_many_blocks(spark, sentences, top, monkeypatch):
    monkeypatch.setattr(M, "BUCKET", 40)
    monkeypatch.setattr(M, "BLOCK", 25)
    texts = [*sentences, ["the"] * 60, ["<s>", "the"], [], ["the", "w1", "the", "été"]]
    got = {(r["id"], r["ngram_order"]): r for r in M.own_scores(table(spark, texts), "id", top).collect()}
    assert len(got) == top * len(texts)
    for order in range(1, top + 1):
        brute = Brute(texts, order)
        for k, ws in enumerate(texts):
            assert got[k, order]["n_tokens"] == len(ws)
            assert (got[k, order]["log_prob"] is None) if not ws else got[k, order]["log_prob"] == pytest.approx(brute.log(ws), rel=1e-9)


def test_own_scores_move_positions_packed_and_once(spark):
    """A position took more than 14 bytes of shuffle for its hashes alone, and grams of every order were written."""
    r = random.Random(7)
    texts = [[f"word{int(r.paretovariate(0.6)) % 3000}" for _ in range(200)] for _ in range(400)]
    scores = M.own_scores(table(spark, texts), "id", 3)
    scores.collect()
    plan = scores._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    moves = [x for x in final.splitlines() if "Exchange hashpartitioning(bucket" in x]
    assert len([x for x in moves if "ReusedExchange" not in x]) == 2
    assert not re.search(r"hashpartitioning\((h0|g0)", plan)
    assert "BroadcastNestedLoopJoin" not in plan and len(moves) > 2
    blocks = M._packed(table(spark, texts), "id")
    moved = blocks.mapInArrow(M.to_buckets(3, 1, {}, M.START), "bucket int, keys array<bigint>, n bigint, n_words bigint, words binary, places binary")
    size, n = moved.agg(F.sum(F.length("places") + F.length("words")), F.sum("n")).first()
    assert n == 80_000 and size / n < 8


def test_blocks_are_taken_like_words(spark):
    docs = spark.createDataFrame([(1, "The cat, the dog"), (2, None), (3, "the été"), (None, "a cat")], "id long, text string")
    blocks, words = M.staged_words(docs, "id"), M.word_table(docs, "id")
    for n in (1, 2):
        a, b = ({r["id"]: r for r in M.score(w, "id", M.count_model(w, n), True).collect()} for w in (blocks, words))
        assert a.keys() == b.keys() == {1, 2, 3, None}
        own = {r["id"]: r for r in M.own_scores(blocks, "id", n).where(F.col("ngram_order") == n).collect()}
        for k in a:
            assert a[k]["n_tokens"] == b[k]["n_tokens"] == own[k]["n_tokens"]
            assert a[k]["log_prob"] == pytest.approx(b[k]["log_prob"]) == pytest.approx(own[k]["log_prob"])
