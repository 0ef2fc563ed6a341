"""Small fixtures with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, against brute force."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logloom.llm import importance, mixing, packing, pstable, quality_rules, sharding, simhash, token_files, tool_calls, tokens, wrappers
from logloom.llm.common import Staged, components
from logloom.session import new_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, copies int, kept string, shard int, key string"


def docs_of(spark, rows):
    """Rows of (doc_id, text, source); the other columns clash with names the operators use."""
    full = [(i, t, "en", s, len(t or ""), 7, 3, "x", 9, "k") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(3)
    words = ["the", "of", "and", "river", "Stone", "größe", "naïve", "x1", "to", "is"] + [f"w{k}" for k in range(60)]
    out = [" ".join(pick.choice(words) for _ in range(pick.randint(1, 120))) for _ in range(40)]
    out += [out[0]] * 9 + [out[1] + " end"] + [None, "", "  \n\t ", "one", "one two", "long " * 30_000, "a\nb\na\nb\n\n", "###$$ ** & |", "<|endoftext|>  x\n\n y"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, [None, "a", "b", "ü"][k % 4]) for k, t in enumerate(texts)]
    rows += [(3, texts[3], "a"), (3, texts[3], "a"), (None, "no id here", "b")]
    return docs_of(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, [])


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def words_of(text):
    return (text or "").replace("\x0b", " ").replace("\x0c", " ").encode().split()


def test_sharding(spark, docs, empty):
    got = rows_of(sharding.sharded(docs, shards=4))
    assert len(got) == docs.count() and {r["law"] for r in got} == {"bytes"}
    for shard in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    sizes = {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    largest = max(r["size"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    assert sharding.sharded(empty).count() == 0


def test_sharding_keeps_groups_together_and_splits_large_ones(spark):
    rows = [(k, f"group {k % 25} text", "a") for k in range(100)] + [(1000 + k, f"own {k} text", "a") for k in range(400)]
    got = rows_of(sharding.sharded(docs_of(spark, rows), shards=5))
    homes = {}
    for r in got:
        if r["doc_id"] < 1000:
            homes.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(h) == 1 for h in homes.values()) >= 22
    hot = [(k, "the same text", "a") for k in range(300)] + [(1000 + k, f"own {k} text", "a") for k in range(300)]
    loads = {}
    for r in rows_of(sharding.sharded(docs_of(spark, hot), shards=6)):
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
    assert max(loads.values()) <= 1.05 * sum(loads.values()) / 6


def brute_fingerprint(text):
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def reachable(ids, linked):
    component = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(component[a], component[b])
            if component[a] != low or component[b] != low:
                component[a] = component[b] = low
                changed = True
    return component


def test_simhash(spark, docs, texts, empty):
    got = rows_of(simhash.near_copies(docs))
    assert len(got) == docs.count()
    prints = {}
    for r in docs.select("doc_id", "text").collect():
        prints.setdefault(r.doc_id, set()).add(brute_fingerprint(r.text))
    ids = [i for i in prints if i is not None]
    pairs = [(a, b) for a in ids for b in ids if a < b and any((x ^ y).bit_count() <= 2 for x in prints[a] for y in prints[b])]
    component = reachable(ids, pairs)
    for r in got:
        assert int(r["fingerprint"], 16) in prints[r["doc_id"]]
        if r["doc_id"] is not None:
            assert r["component_id"] == component[r["doc_id"]]
    assert simhash.near_copies(empty).count() == 0
    single = simhash.one_of_each(docs)
    assert single.columns == docs.columns
    assert sorted(r["doc_id"] for r in rows_of(single) if r["doc_id"] is not None) == sorted(set(component.values()))
    assert simhash.one_of_each(empty).count() == 0


def test_simhash_of_rows_without_ids(spark):
    one, two = "one two three four five six seven", "an entirely different text of some other words"
    rows = [(None, one, "a"), (5, one, "a"), (None, two, "a"), (9, two, "a"), (None, "alone and without a name", "a"), (None, "alone and without a name", "a")]
    got = sorted((str(r["doc_id"]), r["component_id"] or 0) for r in rows_of(simhash.near_copies(docs_of(spark, rows))))
    assert got == [("5", 5), ("9", 9), ("None", 0), ("None", 0), ("None", 5), ("None", 9)]


def test_simhash_links_in_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 8)
    pick = random.Random(1)
    base = [pick.getrandbits(64) for _ in range(3)]
    values = {b ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(8)) for b in base for _ in range(150)}
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v, k) for k, v in enumerate(values)]
    got = {tuple(r) for r in simhash.links(spark.createDataFrame(signed, "fp long, node long"), Staged(spark, "t")).collect()}
    want = {(a, b) for a in range(len(values)) for b in range(a + 1, len(values)) if (values[a] ^ values[b]).bit_count() <= 2}
    assert got == want and len(want) > 500


def test_components(spark):
    pick = random.Random(5)
    edges = [(k, k + 1) for k in range(0, 200) if k % 50 != 49] + [(300, 300)] + [(1000 + pick.randrange(80), 1000 + pick.randrange(80)) for _ in range(60)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long"), Staged(spark, "t")).collect()}
    want = reachable({x for e in edges for x in e}, edges)
    assert all(found.get(k, k) == v for k, v in want.items())


def test_embeddings(spark):
    random_state = np.random.default_rng(0)
    centres = random_state.standard_normal((12, 16))
    rows = []
    for k in range(160):
        v = centres[k % 12] + random_state.standard_normal(16) * random_state.choice([0.02, 0.15, 0.3])
        rows.append((k, v.tolist(), int(k % 12 % 3) if k % 17 else None, "x", 1))
    rows += [(500 + k, rows[1][1], 1, "x", 1) for k in range(30)] + [(600, [1e200 * x for x in rows[1][1]], 1, "x", 1)]
    rows += [(700, None, 1, "x", 1), (701, [], 1, "x", 1), (702, [0.0] * 16, 1, "x", 1), (703, [float("nan")] * 16, 1, "x", 1), (704, [None] + [1.0] * 15, 1, "x", 1), (705, [1.0] * 4, 1, "x", 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string, links int")
    got = {r["vec_id"]: r for r in rows_of(pstable.linked(table, recall=0.9999))}
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.linalg.norm(v)
    units = {r[0]: unit(r[1]) for r in rows}
    labels = {r[0]: r[2] for r in rows}
    pairs = [
        (a, b) for a in units for b in units
        if a < b and units[a] is not None and units[b] is not None and labels[a] is not None and labels[a] == labels[b]
        and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.93
    ]
    component = reachable(units, pairs)
    assert len(got) == len(rows)
    for i in units:
        assert got[i]["n_links"] == sum(i in p for p in pairs), i
        assert got[i]["component_id"] == component[i] and got[i]["kept"] == (component[i] == i)
    assert pstable.linked(table.limit(0)).count() == 0


def test_embedding_blocks_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(pstable, "BLOCK", 16)
    random_state = np.random.default_rng(1)
    centre = random_state.standard_normal(32)
    rows = [(k, (centre + random_state.standard_normal(32) * 0.03).tolist(), 0) for k in range(150)]
    got = rows_of(pstable.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")))
    assert {r["n_links"] for r in got} == {149} and {r["component_id"] for r in got} == {0}


ODD = ["", " ", "   ", "\n", "a  b   c\n\n d", "<|endoftext|>x <|startoftext|>", "I'll  we've", "\x1c\x85  x", "ΣΣ İ é 日本", "\t\r\n x", "９0", "a\x01b", " lead", "trail "]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_equal_the_library(name, texts):
    import public_tokenizers

    path = public_tokenizers.path(name)
    pick = random.Random(2)
    letters = [*" \n\t'sItéÉ.,!0９　\x1cΣİЖ\r\x0bl<|>日́", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>"]
    many = ODD + [t or "" for t in texts] + ["".join(pick.choice(letters) for _ in range(pick.randint(0, 25))) for _ in range(3000)]
    library = Tokenizer.from_file(path)
    want = [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(many, add_special_tokens=False)]
    assert tokens.encoder(path)(many) == want
    assert tokens.byte_level_encoder(path)(many) == want


def test_packing(spark, docs, empty):
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows_of(packing.pack(docs, length=64))
    per_row = docs.select("doc_id", "text").collect()
    assert sum(r["length"] for r in got) == sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in per_row)
    sequences = {}
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    filled = []
    for k in sorted(sequences):
        at = 0
        for offset, length in sorted(sequences[k]):
            assert offset == at
            at += length
        filled.append(at)
    assert sorted(sequences) == list(range(len(sequences))) and set(filled[:-1]) == {64}
    one = sorted((r for r in got if r["doc_id"] == 5), key=lambda r: r["start"])
    ids = np.frombuffer(b"".join(r["ids"] for r in one), "<u4").tolist()
    assert ids == library.encode(per_row[5].text, add_special_tokens=False).ids + [0]
    assert packing.pack(empty).count() == 0


def test_token_files(spark, docs, empty, tmp_path):
    import pyarrow.parquet as pq
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs, path)
    got = sorted(rows_of(token_files.read_token_files(spark, path)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is not None, x))
    at, by_id = 0, {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        assert r["start"] == at and r["ids"] == library.encode(by_id[r["doc_id"]] or "", add_special_tokens=False).ids + [2]
        at += r["n_tokens"]
    for file in (tmp_path / "ids").glob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        chunks = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
        assert any("DICTIONARY" in e for e in chunks["ids.list.element"].encodings)
        assert "DELTA_BINARY_PACKED" in chunks["doc_id"].encodings and chunks["doc_id"].has_offset_index
    path = new_path(spark, "empty-ids")
    token_files.write_token_files(empty, path)
    assert token_files.read_token_files(spark, path).count() == 0


def test_quality_rules(spark, docs, empty):
    got = {(r["doc_id"], r["n_words"]): r for r in rows_of(quality_rules.judge(docs).withColumn("own", F.col("size")))}
    for row in docs.select("doc_id", "text").collect():
        words = words_of(row.text)
        r = got[row.doc_id, len(words)]
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        from collections import Counter

        count = Counter(grams)
        assert r["n_repeat_words"] == len({p for k, g in enumerate(grams) if count[g] > 1 for p in (k, k + 1, k + 2)})
        lines = [line for line in (row.text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r")]
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["word_chars"] == sum(len(w.decode()) for w in words)
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in row.text or "")
        assert r["base_failed"] == (len(words) < 50 or 2 * r["n_repeat_words"] > len(words))
    assert quality_rules.judge(empty).count() == 0
    passing = quality_rules.passing(docs)
    assert passing.columns == docs.columns and passing.count() == sum(r["kept"] for r in rows_of(quality_rules.judge(docs)))


def test_importance(spark, docs, empty, sf_dir):
    larger = sf_dir.replace("sf0.001", "sf0.01")
    table = spark.read.parquet(f"{larger}/documents.parquet")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    got = rows_of(importance.sampled(table, labels))
    assert len(got) == table.count()
    kept = {r["doc_id"] for r in got if r["kept"]}
    known = [r for r in labels.collect()]
    good = [r.doc_id for r in known if r.quality == 1 and not r.toxic]
    bad = [r.doc_id for r in known if r.quality == 0]
    assert np.mean([i in kept for i in good]) >= 0.95 and np.mean([i in kept for i in bad]) <= 0.6
    assert {r["doc_id"] for r in importance.kept_documents(table, labels).collect()} == kept
    odd = spark.createDataFrame([(0, 1, 0), (0, 1, 0), (None, 1, None), (2, None, None), (5, 1, None)], "doc_id long, quality int, toxic int")
    assert importance.kept_documents(docs, odd).columns == docs.columns
    assert importance.sampled(docs, labels.limit(0)).where("kept").count() == docs.count()
    assert importance.sampled(empty, labels).count() == 0 and importance.kept_documents(empty, labels).count() == 0


def test_mixing(spark, docs, empty):
    got = rows_of(mixing.mixed(docs))
    assert len(got) == docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    total = sum(r["size"] for r in got)
    targets = {r["source"]: (r["target"], r["source_size"]) for r in got}
    assert sum(t for t, _ in targets.values()) == pytest.approx(1.5 * total) and all(t <= 2 * s + 1e-6 for t, s in targets.values())
    for source, (target, _) in targets.items():
        mine = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - target) <= max(r["size"] for r in mine) * 3
    assert sorted(map(str, got)) == sorted(map(str, rows_of(mixing.mixed(docs.repartition(5)))))
    mixed = mixing.repeated(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.mixed(empty).count() == 0 and mixing.repeated(empty).count() == 0


def test_tool_calls(spark):
    rows = [
        (1, 0, "call", "a", "search", '{"limit": 3, "query" : "x"}', None, None), (1, 1, "result", "a", None, None, None, "fine"),
        (1, 2, "call", "b", "search", '{"query":"x","limit":"3"}', "a", None), (1, 3, "call", "b", "search", '{"query":"y","limit":1}', None, None),
        (1, 4, "call", "c", "search", "not json", "d", None), (1, 5, "call", "d", "other", "{}", "c", None), (1, 6, "result", "z", None, None, None, None),
        (1, 7, "call", None, "search", None, None, None), (2, 0, "message", None, None, None, None, 'say "hi"'), (None, 0, "call", "q", "summarise", '{"query":1,"limit":2,"more":3}', "q", None),
    ]
    schema = "conv_id long, turn long, kind string, call_id string, name string, arguments string, after string, content string"
    got = {(r["conv_id"], r["turn"]): r for r in rows_of(tool_calls.linked(spark.createDataFrame(rows, schema)))}
    assert len(got) == len(rows)
    assert [got[1, t]["status"] for t in range(8)] == ["linked", "linked", "no_result", "repeat", "no_result", "no_result", "no_call", "no_identifier"]
    assert [got[1, t]["depth"] for t in (0, 1, 2, 4, 5)] == [0, 1, 2, None, None]
    assert got[1, 0]["json"] == '{"arguments":{"limit":3,"query":"x"},"id":"a","name":"search"}' and got[1, 0]["problem"] is None
    assert got[1, 2]["problem"] == "type:limit" and got[1, 4]["problem"] == "invalid_json" and got[1, 5]["problem"] == "unknown_tool"
    assert got[None, 0]["problem"] == "type:query" and got[1, 7]["problem"] == "invalid_json"
    assert sorted(got[1, t]["place"] for t in range(8)) == list(range(8)) and got[1, 2]["place"] > got[1, 1]["place"]
    assert tool_calls.linked(spark.createDataFrame([], schema)).count() == 0


PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header>Site</header>'
    '<nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div><div id="sidebar">Side</div>%s'
    '<section class="comments"><article>Nice!</article></section><form><input> Search</form><footer>&copy; x</footer></body></html>'
)


def test_extraction_of_one_page():
    article = "<article><h1>Head &amp; tail</h1><p><b>One\n two<br>three<p>Four &lt;5&gt;<ul><li>six<li>seven</ul><aside>ad</aside></article>"
    want = "Head & tail\nOne two three\nFour <5>\nsix\nseven"
    assert wrappers.extracted(PAGE % article) == want
    layout = '<body class="has-sidebar"><div class="wrap no-comments"><article class="post comments-open"><p>a<div class="ad-slot">x</div><p>b</article></div>'
    assert wrappers.extracted(layout + '<article class="comment">c</article>') == "a\nb"
    assert wrappers.extracted(None) == wrappers.extracted("") == ""
    deep = "<div>" * 5000 + "end" + "</div>" * 5000
    assert wrappers.extracted(deep) == "end"
    assert wrappers.extracted("<p>a<p>b</p>c<div>d</div>") == "a\nb\nc\nd"
    assert wrappers.extracted("plain &amp; text") == "plain & text"


def test_extraction_learns_the_template(spark):
    pick = random.Random(4)
    word = lambda n: " ".join(pick.choice(["red", "green", "blue", "grey"]) + str(pick.randrange(999)) for _ in range(n))
    rows, want = [], {}
    for k in range(40):
        body = [word(12) for _ in range(pick.randint(1, 5))]
        links = "".join(f'<li><a href="/{word(1)}">{word(2)}</a></li>' for _ in range(4))
        html = f"<body><div class='x'>Daily paper</div><div class='y'><ul>{links}</ul></div><div class='z'>" + "".join(f"<p>{b}</p>" for b in body) + "</div><p>All rights</p></body>"
        rows.append((k, "http://h.example/" + str(k), html, "t", 1))
        want[k] = "\n".join(body)
    rows += [(100, None, "<p>alone</p>", "t", 1), (101, "http://h.example/", None, "t", 1), (102, "bad url", "", "t", 1)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host int")
    got = {r["page_id"]: r for r in rows_of(wrappers.extract(table))}
    assert {k: got[k]["text"] for k in want} == want
    assert got[100]["text"] == "alone" and got[101]["text"] == got[102]["text"] == "" and got[0]["n_chars"] == len(want[0])
    assert wrappers.extract(table.limit(0)).count() == 0


def test_simple_tree_matching():
    leaf = lambda label, *children: [label, 1, 0, 0, {}, list(children), False]
    a = leaf("r", leaf("a", leaf("x")), leaf("b"), leaf("c"))
    b = leaf("r", leaf("b"), leaf("a", leaf("x"), leaf("y")), leaf("c"))
    assert wrappers.matching(a, b) == 4
    assert wrappers.aligned(a[5], b[5]) in ([(None, 0), (0, 1), (1, None), (2, 2)], [(0, 1), (1, None), (2, 2)])
