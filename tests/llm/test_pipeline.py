"""Every pipeline stage against a brute-force version, each on its own input."""

import hashlib
import math
from collections import Counter

import numpy as np

import corpus_pipeline
from logloom.llm import importance, quality_rules
from tests.llm.test_operators import brute_fingerprint, reachable, words_of


def passes_rules(text):
    words = [w.decode() for w in words_of(text)]
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count = Counter(grams)
    repeated = len({p for k, g in enumerate(grams) if count[g] > 1 for p in (k, k + 1, k + 2)})
    if len(words) < 50 or 2 * repeated > len(words):
        return False
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    plain = "".join(" " if c in ".,;:!?" else c for c in text.lower()).split()
    stop = sum(w in set(quality_rules.STOP_WORDS) for w in plain)
    return (
        1.5 <= sum(map(len, words)) / len(words) <= 30
        and sum(c in "#*$%&|<>" for c in text) / len(words) <= 0.3
        and stop / len(words) >= 0.06
        and (len(lines) - len(set(lines))) / max(len(lines), 1) <= 0.4
    )


def u_of(seed, doc_id):
    return (int(hashlib.md5(f"{seed}:{doc_id}".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)


def sampled(rows, known):
    fit, held = set(known[::2]), set(known[1::2])
    found = {i: importance.features(t) for i, t in rows}
    raw, target = np.zeros(importance.BUCKETS), np.zeros(importance.BUCKETS)
    for i, f in found.items():
        np.add.at(raw, f, 1)
        if i in fit:
            np.add.at(target, f, 1)
    p_raw = (raw + 1) / (raw + 1).sum()
    model = np.log((target + importance.BUCKETS * p_raw) / (target.sum() + importance.BUCKETS)) - np.log(p_raw)
    weight = {i: model[f].sum() / max(len(f), 1) for i, f in found.items()}
    good = sorted(weight[i] for i in held if i in weight)
    floor = good[max(0, math.ceil(importance.QUANTILE * len(good)) - 1)]
    k = sum(w >= floor - 1e-12 for w in weight.values())
    key = {i: w / importance.TEMPERATURE - math.log(-math.log(u_of(importance.SEED, i))) for i, w in weight.items()}
    return set(sorted(key, key=lambda i: -key[i])[:k])


def mixed(rows):
    size = {i: len(words_of(t)) for i, t, _ in rows}
    sources = sorted({s for _, _, s in rows})
    whole = {s: sum(size[i] for i, _, x in rows if x == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, open_, rest = {}, list(sources), 1.5 * sum(whole.values())
    while True:
        level = rest / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] >= 2 * whole[s]]
        if not full:
            break
        for s in full:
            target[s] = 2.0 * whole[s]
            rest -= target[s]
            open_.remove(s)
    target |= {s: level * weight[s] for s in open_}
    copies = {}
    for s in sources:
        mine = [i for i, _, x in rows if x == s]
        certain, left = int(target[s] / whole[s]), target[s] - int(target[s] / whole[s]) * whole[s]
        copies |= {i: certain for i in mine}
        # probabilities in proportion to size; whoever reaches 1 is taken, and the others share what is left
        open_ = {i for i in mine if size[i]}
        while open_ and left > 0:
            factor = left / sum(size[i] ** 2 for i in open_)
            full = {i for i in open_ if size[i] == max(size[j] for j in open_)}
            if factor * max(size[i] for i in open_) < 1:
                break
            open_ -= full
            left -= sum(size[i] for i in full)
            copies |= {i: certain + 1 for i in full}
        at, odds = 0, {i: u_of(42, i) / (1 - u_of(42, i)) / (factor * size[i] / (1 - factor * size[i])) for i in open_} if left > 0 else {}
        for i in sorted(odds, key=odds.get):
            copies[i] = certain + (at + size[i] / 2 <= left)
            at += size[i]
    return copies


def test_every_stage(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = [r[0] for r in importance.labelled(spark.read.parquet(f"{folder}/labels.parquet")).collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "quality classifier", "SimHash near-dedup", "mixing sources", "packing"]

    def take(name, before):
        after = stages[name](spark, before, folder).cache()
        assert after.columns == docs.columns
        return after, Counter(r.doc_id for r in after.select("doc_id").collect())

    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    one, got = take("quality rules", docs)
    rows = [r for r in rows if passes_rules(r[1])]
    assert got == Counter(r[0] for r in rows)
    two, got = take("quality classifier", one)
    kept = sampled([r[:2] for r in rows], known)
    assert got == Counter(kept) and len(kept) < len(rows)
    rows = [r for r in rows if r[0] in kept]
    three, got = take("SimHash near-dedup", two)
    prints = {r[0]: brute_fingerprint(r[1]) for r in rows}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    component = reachable(prints, pairs)
    assert got == Counter(i for i in prints if component[i] == i) and len(pairs) > 0
    rows = [r for r in rows if component[r[0]] == r[0]]
    four, got = take("mixing sources", three)
    assert got == Counter({i: n for i, n in mixed(rows).items() if n})
    packed = stages["packing"](spark, four, folder).collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == got
