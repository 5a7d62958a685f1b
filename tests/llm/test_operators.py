"""The training-data operators on small inputs, against brute force or round trips."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from paytrail.llm import (bloom_cascade, hilbert, html_text, line_frequency, lsh_forest, pfair, reply_trees,
                          suffix_tree, templates, toxicity)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _h int, h int, id string, node int"


def frame(spark, texts, sources=None):
    """Documents with columns whose names clash with internal ones."""
    rows = [(i, t, None if i % 7 == 3 else "en", (sources or ["a"] * len(texts))[i], None if t is None else len(t),
             1, 2, "x", 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# ---- 1 reply trees ----

def messages(spark, rows):
    return spark.createDataFrame(rows, "tree string, msg long, parent long, role string, text string, score double, leaf int")


def test_reply_trees_paths_and_ranks(spark):
    rows = [("t", 1, None, "user", "q", 0.0, 0), ("t", 2, 1, "assistant", "good", 5.0, 0),
            ("t", 3, 1, "assistant", "bad", 1.0, 0), ("t", 4, 2, "user", None, 0.0, 0),
            ("t", 5, 99, "user", "orphan", 0.0, 0), ("t", 6, 7, "user", "cycle", 9.0, 0), ("t", 7, 6, "user", "cycle", 9.0, 0),
            (None, 1, None, None, "alone", None, 0), ("t", 3, 1, "assistant", "bad", 1.0, 0)]
    got = reply_trees.reply_paths(messages(spark, rows)).collect()
    paths = defaultdict(list)
    for r in sorted(got, key=lambda r: r.depth):
        paths[(r.tree, r.leaf, r.branch_rank)].append(r.text)
    assert dict(paths) == {("t", 4, 1): ["q", "good", ""], ("t", 3, 2): ["q", "bad"], ("t", 5, 3): ["orphan"],
                           (None, 1, 1): ["alone"]}
    best = reply_trees.reply_paths(messages(spark, rows), keep=1)
    assert {r.leaf for r in best.where("tree = 't'").collect()} == {4}
    assert reply_trees.reply_paths(messages(spark, rows[:0])).count() == 0


def test_reply_trees_long_chain_and_round_trip(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant ok", "\\<|", "<", "", "\\\\|", "a\\n", "é<\\|x", None] * 5
    turns = spark.createDataFrame([(1, i, "assistant" if i % 2 else "us\\ner\n", t) for i, t in enumerate(nasty)],
                                  "conv_id long, turn long, role string, text string")
    one = reply_trees.format_paths(reply_trees.reply_paths(reply_trees.chain(turns)))
    row = one.select("formatted", "loss", reply_trees.parse(F.col("formatted")).alias("turns")).head()
    assert [t.text for t in row.turns] == [t or "" for t in nasty]
    assert {t.role for t in row.turns} == {"assistant", "us\\ner\n"}
    trained = [row.formatted[s["from"]:s["to"]] for s in row.loss]
    plain = [t.replace("<\\|", "<|").replace("\\\\", "\\") for t in trained]
    assert len(trained) == 20 and plain[0] == "\\<|"


# ---- 2 Hilbert sharding ----

def test_hilbert_neighbours_touch():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    order = np.argsort(hilbert.hilbert_index(cells, 3))
    assert sorted(hilbert.hilbert_index(cells, 3)) == list(range(512))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_hilbert_shards(spark):
    docs = frame(spark, ["x" * (i % 5) if i % 6 else None for i in range(101)], ["hot" if i % 3 else None for i in range(101)])
    docs = docs.union(docs.limit(1))
    rows = hilbert.shard(docs, ["lang", "source", "n_chars", "doc_id"], shards=4).collect()
    assert len(rows) == 102
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert sorted(by) == [0, 1, 2, 3] and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert hilbert.shard(docs.limit(0), ["lang", "n_chars"]).count() == 0


# ---- 3 Bloom cascade ----

def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(1500).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("crc32(key) % 9 = 0")
    cascade = bloom_cascade.Cascade.build(listed.union(listed), universe)
    got = cascade.member(universe.select("key", F.array("key", F.lit(None)).alias("ks")), "ks", "hit")
    assert got.where("hit[0] != (crc32(key) % 9 = 0) or hit[1]").count() == 0
    assert len(cascade.shards[0]) > 1
    none = bloom_cascade.Cascade.build(listed.limit(0), universe)
    assert none.member(universe.select(F.array("key").alias("ks")), "ks", "hit").where("hit[0]").count() == 0


def test_cascade_in_shards_and_passes(spark, monkeypatch):
    monkeypatch.setattr(bloom_cascade, "KEYS_PER_SHARD", 100)
    monkeypatch.setattr(bloom_cascade, "PASS_BYTES", 200)
    universe = spark.range(700).select(F.col("id").cast("string").alias("key"))
    listed = universe.where("int(key) % 3 = 0")
    cascade = bloom_cascade.Cascade.build(listed, universe)
    assert len(cascade.shards) == 3
    got = cascade.member(universe.select("key", F.array("key").alias("ks")), "ks", "hit")
    assert got.where("hit[0] != (int(key) % 3 = 0)").count() == 0


def test_url_rules(spark):
    urls = {"http://A.example.NET/en/1": "example.net/en/", "http://example.net/de": "net/", "http://xnet/": None,
            "http://a.org/fr/?q": "org/fr/", "http://a.org?/fr/": None, None: None, "no url": None, "http://b.net": None}
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id int, url string, rule string")
    rules = spark.createDataFrame([("net/", "block"), ("example.net/en/", "allow"), ("org/fr/", "allow")], "rule string, verdict string")
    got = bloom_cascade.judge(pages, rules).collect()
    assert {r.url: r.rule for r in got} == urls
    assert {r.verdict for r in got if r.rule == "net/"} == {"block"}


# ---- 4 decontamination ----

def test_templates_catch_copies_and_new_numbers(spark):
    item = "tom wrote that Mary Jones had 12 km to walk and Mary paid 3,500 euros for the trip to the old town"
    other = "some words that share nothing with the benchmark at all and go on for a while longer than that"
    changed = item.replace("Mary", "Susan").replace("12", "77").replace("3,500", "9000")
    broken = "tom wrote that Mary Jones had 12 km to walk and Susan paid 3,500 euros for the trip to the old town"
    texts = [f"{other} {item} {other}", f"{other}, {changed} {other}", other, None, "", item * 2, f"{other} {broken}"]
    items = spark.createDataFrame([(1, item, "z"), (2, item, "z"), (3, None, "z"), (4, "a b", "z")], "item_id long, text string, doc_id string")
    got = {r.doc_id: (r.item_id, r.n_items) for r in templates.leaks(frame(spark, texts), items).collect()}
    assert got == {0: (1, 2), 1: (1, 2), 5: (1, 2)}
    assert templates.leaks(frame(spark, texts), items.limit(0)).count() == 0
    assert templates.leaks(frame(spark, []), items).count() == 0


def test_templates_keep_windows_that_agree(spark):
    long = ("the first of the boats that left the harbour carried 3 crates of fish and the people who waited on the shore "
            "cheered until all of them were out of sight while 3 gulls followed them far over the open and quiet sea")
    short = "a train that runs for 30 km in 2 h and then for another 45 km in 3 h has what mean speed"
    texts = [long.replace("3 gulls", "8 gulls"), short.replace("30", "60").replace("45", "80").replace("2 h", "3 h"),
             short.replace("30 km", "60 m")]
    items = spark.createDataFrame([(1, long), (2, short)], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.coverage) for r in templates.leaks(frame(spark, texts), items).collect()}
    assert got[0][0] == 1 and 0.5 <= got[0][1] < 1 and got[1] == (2, 1.0)
    # km meets m and km: only windows with km fall out.
    assert got.get(2, (2, 0.0))[1] < 1


def leaked(spark, texts, items):
    items = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, t) for i, t in texts], "doc_id long, text string")
    return sorted(((r.doc_id, r.item_id, r.n_items) for r in templates.leaks(docs, items).collect()), key=str)


def test_templates_find_verbatim_copies_of_any_item(spark):
    other = "some words that share nothing with the benchmark"
    items = [(1, "Compute 12 + 35 - 7 * 3"), (2, "What is 12 * 7 + 3 ?"), (3, "Mary has 3 apples and 4 pears"), (4, "2 + 2"),
             (5, "Wie viele Kilometer fuhr Anna Meyer am Montag nach Bad Homburg und am Dienstag nach Berlin Mitte")]
    texts = [(0, f"{other} compute 12 + 35 - 7 * 3 {other}"), (1, "So: What is 12 * 7 + 3 ? yes"), (2, "so we say: Mary has 3 apples and 4 pears."),
             (3, "Susan has 9 apples and 2 pears"), (4, "2 + 2"), (5, f"{other} 2 + 2 {other}"), (6, f"{other} {items[4][1]} {other}"),
             (7, "Compute 13 + 36 - 8 * 4"), (8, "what is 12 * 7 + 4 ?"), (9, "Susan has 9 apples and 9 pears"), (10, f"{other} 12 35 7 3")]
    got = {(d, i) for d, i, _ in leaked(spark, texts, items)}
    assert got == {(0, 1), (1, 2), (2, 3), (3, 3), (4, 4), (6, 5), (9, 3)}


def test_templates_join_classes_of_items_and_keep_texts_apart(spark):
    items = [(i, f"a train that runs for {i + 30} km in {i + 2} h and then stops has what mean speed") for i in range(40)]
    texts = [(None, f"{'x ' * i}{items[i][1]}") for i in range(30)] + [(7, items[3][1]), (7, "b " + items[4][1]), (8, "nothing here")]
    got = leaked(spark, texts, items)
    assert len(got) == 32 and {(i, n) for _, i, n in got} == {(0, 40)}
    assert [d for d, _, _ in got].count(None) == 30 and [d for d, _, _ in got].count(7) == 2


def test_templates_equal_a_search_for_whole_items(spark):
    """Random items of words, names, numbers and units, placed verbatim or with other values."""
    rng = random.Random(12)

    def sentence(n):
        return " ".join(rng.choice([f"w{'abcdefgh'[rng.randrange(8)]}{'ijkl'[rng.randrange(4)]}"] * 6 + ["Tom", "Ann", "17", "3.5", "20 km"]) for _ in range(n))

    items = [(i, sentence(rng.randrange(4, 30))) for i in range(40)]
    texts, want = [], set()
    for d in range(150):
        i, t = rng.choice(items)
        kind = rng.randrange(3)
        filler = " ".join(f"z{rng.randrange(10 ** 6)}q" for _ in range(20))
        body = t if kind == 1 else t.upper().lower() if kind == 2 and not re.search("Tom|Ann", t) else ""
        texts.append((d, f"{filler}. {body}, {filler}" if body else filler))
        if body:
            want.add((d, i))
    got = {(d, i) for d, i, _ in leaked(spark, texts, items)}
    assert want <= got and {d for d, _ in got} == {d for d, _ in want}


# ---- 5 line frequency ----

def brute_base(text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if x]
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
    wins = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if wins[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_base_metrics():
    rng = random.Random(1)
    for _ in range(200):
        t = "".join(rng.choice(["a", "b", " ", "\n", "#", "\x1c", "\xa0", "a b a b a b ", "|", "\t"]) for _ in range(rng.randrange(60)))
        assert line_frequency.base_metrics(t) == brute_base(t)
    assert line_frequency.base_metrics(None) == (0, 0, 0, 0, 0)


def test_line_frequency(spark):
    rng = random.Random(2)
    footer = "Subscribe to the letter 2024 now"
    texts = [f"{words(rng, 15)}\n{footer.upper() if i % 2 else footer}" for i in range(40)]
    texts += [f"{footer}\n" + words(rng, 5), None, "", *[words(random.Random(9), 30)] * 30]
    got = {r.doc_id: r for r in line_frequency.judge(frame(spark, texts)).collect()}
    assert all(got[i].kept and got[i].removed_words == 6 for i in range(40))
    assert got[40].depleted and not got[40].base_failed and got[40].removed_words == 6
    assert got[41].base_failed and got[42].base_failed and all(got[i].kept for i in range(43, 73))
    docs = frame(spark, texts)
    lines = line_frequency.line_counts(docs)
    bad = line_frequency.boilerplate(lines, line_frequency._rows(docs, "doc_id", "text", "source"))
    cleaned = {r.doc_id: r.text for r in line_frequency.clean(docs, bad).collect()}
    assert cleaned[0] == texts[0].split("\n")[0] and cleaned[41] is None


def test_line_frequency_limit_has_an_upper_bound(spark):
    rng = random.Random(22)
    texts = [words(rng, 15) + ("\nread more of this" if i < 60 else "") for i in range(200)]
    docs = frame(spark, texts)
    assert line_frequency.judge(docs, max_share=0.5).where("removed_words > 0").count() == 0
    assert line_frequency.judge(docs, max_share=0.5, max_docs=50).where("removed_words = 4").count() == 60


# ---- 6 suffix tree ----

def test_suffix_tree(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "theory", "of", "Other", "ÉTÉ"]) for _ in range(rng.randrange(80))) for _ in range(120)]
    texts += [None, "", "never seen words"]
    docs = frame(spark, texts)
    tree = suffix_tree.fit(docs, p_min=1e-4, divergence=5.0)
    got = {r.doc_id: r for r in suffix_tree.score(docs, tree).collect()}
    train = Counter()
    toks = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in enumerate(texts)}
    for i, t in toks.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(t)
    n, v = sum(train.values()), len(train)
    for i, t in toks.items():
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in t)
        assert got[i].base_score == pytest.approx(base) and got[i].train_tokens == n
        assert (got[i].n_tokens, got[i].n_known) == (len(t), sum(train[w] > 0 for w in t))
    # The next-symbol distributions sum to 1, and scores follow them symbol by symbol.
    for before in (b"\n", b"\0\0\0\0\n", b"\nthe o", b"zzzzz"):
        past = (b"\0" * 5 + before)[-suffix_tree.DEPTH:]
        p = [10 ** float(tree.log10(np.frombuffer(past + bytes([s]), np.uint8))[0]) for s in range(256)]
        assert sum(p) == pytest.approx(1, abs=1e-4)
    held = [r for r in got.values() if r.held_out and r.n_tokens > 5 and r.doc_id < 120]
    assert sum(r.score for r in held) > sum(len(toks[r.doc_id]) * -1.2 for r in held)


# ---- 7 LSH forest ----

def brute_links(texts):
    sets = {t: set(lsh_forest.shingles(t).tolist()) for t in set(texts) if t is not None}
    n = {t: texts.count(t) for t in sets}
    return {t: sum(n[u] for u in sets if u != t and sets[t] and len(sets[t] & sets[u]) >= 0.8 * len(sets[t] | sets[u]) - 1e-9)
            + n[t] - 1 for t in sets}


@pytest.mark.parametrize("block", [512, 8])
def test_forest_join_is_exact(spark, block):
    rng = random.Random(4)
    base = words(rng, 120, 5000).split()
    texts = [words(rng, 40, 5000) for _ in range(30)] + [None, "", "", "one two", "one  two", "x" * 50000]
    for _ in range(60):
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = f"n{rng.randrange(99)}"
        texts.append(" ".join(t))
    texts += texts[-5:]
    got = {r.doc_id: r for r in lsh_forest.join(frame(spark, texts), block_texts=block).collect()}
    want = brute_links(texts)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i].n_links == (0 if t is None else want[t]), (i, t)
    assert got[34].class_id == 33 and got[32].class_id == 31 and got[30].class_id == 30
    kept = lsh_forest.keep_one(frame(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.class_id for r in got.values()})
    assert lsh_forest.join(frame(spark, [])).count() == 0


def test_keep_one_with_null_and_repeated_ids(spark):
    rng = random.Random(12)
    base = [words(rng, 60, 5000) for _ in range(20)]
    texts = base + [t + " end" for t in base] + base[:5] + [None, None, ""]
    ids = [None if i % 3 == 0 else i % 7 for i in range(len(texts))]
    rows = [(i, t, n) for n, (i, t) in enumerate(zip(ids, texts))]
    kept = lsh_forest.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect()
    family = {n: t if t is None else t.removesuffix(" end") for _, t, n in rows}
    want = defaultdict(list)
    for i, t, n in rows:
        if t is not None:
            want[family[n]].append((i is None, i or 0))
    got = {family[r.n]: (r.doc_id is None, r.doc_id or 0) for r in kept if r.text is not None}
    assert got == {f: min(v) for f, v in want.items()}
    assert len(kept) == len(want) + 2


def test_forest_finds_pairs_at_the_threshold(spark):
    rng = random.Random(21)
    texts = []
    for i in range(400):  # pairs of 36 + 36 shingles, 32 of them shared
        t = words(rng, 36, 10**6).split()
        texts += [" ".join(t + [f"a{i}" for _ in range(4)]), " ".join(t + [f"b{i}", f"c{i}", f"d{i}", f"e{i}"])]
    base = words(rng, 120, 5000).split()
    for i in range(150):  # and one family of close copies
        texts.append(" ".join([*base, f"z{i}"]))
    want = brute_links(texts)
    assert all(want[t] == 1 for t in texts[:800])
    got = {r.doc_id: r.n_links for r in lsh_forest.join(frame(spark, texts)).collect()}
    assert sum(got[i] != want[t] for i, t in enumerate(texts)) == 0
    assert lsh_forest.choose_depth(0.8, 0.9985) == 6


def test_sorted_tries_connect_the_texts_of_every_node(spark):
    rng = random.Random(8)
    size = 2 * lsh_forest.START * lsh_forest.TREES
    hot = rng.randbytes(size)
    rows = []
    for i in range(3000):  # half share a signature, others a prefix of it in one trie, the rest nothing
        sig = bytearray(hot if i % 2 else rng.randbytes(size))
        if i % 6 == 0:
            at, d = 2 * lsh_forest.START * rng.randrange(lsh_forest.TREES), rng.randrange(2, 9)
            sig[at:at + 2 * d] = hot[at:at + 2 * d]
        rows.append((rng.randbytes(16).hex(), bytes(sig)))
    rows += [("00" * 16, None)]
    texts = spark.createDataFrame(rows, "text string, sig binary").repartition(5)
    for depth in (4, 6, 8):
        parent = {t: t for t, _ in rows}

        def top(t):
            while parent[t] != t:
                t = parent[t]
            return t

        met = {}
        for t, sig in rows[:-1]:
            for tree in range(lsh_forest.TREES):
                node = (tree, sig[2 * lsh_forest.START * tree:][:2 * depth])
                parent[top(t)] = top(met.setdefault(node, t))
        want = {t: top(t) for t, _ in rows}
        links = [(r.a, r.b) for r in lsh_forest.trie_links(texts, depth).collect()]
        parent = {t: t for t, _ in rows}
        for a, b in links:
            assert want[a] == want[b] and a != b
            parent[top(a)] = top(b)
        assert len({top(t) for t in want}) == len(set(want.values()))
    assert lsh_forest.trie_links(texts.limit(0), 6).count() == 0


# ---- 8 line blocks ----

def test_main_text(spark):
    page = """<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>
    <script>var a = "</p>";</script><div class="ad">Buy now</div><article><h1>Head &amp; line</h1><p>First  <b>bold</b>
    text.<br>More<p>Second &lt;b&gt;.</p><aside>side</aside><p>Third.</p><div class="comments"><p>me too</p></div></article>
    <footer>&copy; all</footer></body></html>"""
    want = "Head & line\nFirst bold text. More\nSecond <b>.\nThird."
    rows = spark.createDataFrame([(1, page, "old"), (2, None, None), (3, "", None), (4, "<p>cut <b", None)], "page_id int, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(rows).collect()}
    assert got == {1: (want, len(want)), 2: ("", 0), 3: ("", 0), 4: ("cut", 3)}


def test_main_text_keeps_links_of_an_article():
    body = "".join(f"<p>Paragraph {i} with quite some words to read in it.</p>" for i in range(20))
    refs = "".join(f"<li><a href=r{i}>Reference {i}</a></li>" for i in range(5))
    page = (f"<nav><a href=x>Menu</a></nav><article><h1><a href=h>Linked headline</a></h1>{body}<ul>{refs}</ul><p>Closing.</p>"
            "<article class='comment'><p><a href=c>me</a></p></article></article><p><a href=y>Elsewhere</a></p><footer>x</footer>")
    got = html_text.main_text(page).split("\n")
    assert got[0] == "Linked headline" and got[-1] != "x" and "Menu" not in got
    assert [x for x in got if x.startswith("Reference")] == [f"Reference {i}" for i in range(5)]
    assert "Closing." in got and len([x for x in got if x.startswith("Paragraph")]) == 20


# ---- 9 toxicity ----

def test_toxicity(spark):
    rng = random.Random(5)
    texts = [words(rng, 30) + (" moronic scum" if i % 5 == 0 else "") for i in range(400)] + [None, ""]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(401, None), (None, 1)], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, index).collect()}
    assert all((got[i] >= toxicity.CUTOFF) == (i % 5 == 0) for i in range(400)) and got[400] == got[401] < 0.05
    # Block-max search gives the neighbours of a full scan.
    v = index.vector("moronic moronic scum moron")
    at, cosine = index.nearest(v)
    q = np.zeros(len(index.vocabulary))
    q[index.weights(v)[0]] = index.weights(v)[1]
    full = np.zeros(len(index.ids))
    for t, (ex, w) in enumerate(index.postings):
        full[ex] += q[t] * w
    order = np.lexsort((np.arange(len(full)), -full.round(12)))[:toxicity.K]
    assert list(order) == list(at) and np.allclose(full[order], cosine)
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}


def test_toxicity_counts_all_terms_of_few_examples(spark):
    rng = random.Random(8)
    names = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(300)]
    texts = [" ".join(rng.choice(names) for _ in range(rng.randrange(1, 60))) for _ in range(600)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(300)], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels)
    learned = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 != 2]
    tf = [Counter(toxicity.terms(t)) for t in texts]
    known = {t for i in learned for t in tf[i]}
    df = Counter(t for c in tf for t in c)
    idf = {t: math.log(601 / (1 + df[t])) + 1 for t in known}

    def weighed(c):
        w = {t: (1 + math.log(n)) * idf[t] for t, n in c.items() if t in known}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    examples = [weighed(tf[i]) for i in learned]
    for i in range(300, 600, 7):
        q = weighed(tf[i])
        full = sorted((sum(x * e.get(t, 0.0) for t, x in q.items()) for e in examples), reverse=True)
        at, cosine = index.nearest(index.vector(texts[i]))
        assert len(index.vocabulary) == len(known) and np.allclose(full[:len(cosine)], cosine, atol=1e-6)
    got = toxicity.score(docs, index).collect()
    assert all(len(r.evidence) == toxicity.K for r in got if len(r.text.split()) > 10)


# ---- 10 Pfair ----

def test_pfair_deviation(spark):
    """Replayed against the exact shares, which the sources left divide among them."""
    rng = random.Random(17)
    cases = [({"a": 5, "b": 3, "c": 1}, {"a": 50, "b": 11, "c": 40})]
    cases += [({f"s{i}": rng.randrange(1, 30) for i in range(n)}, {f"s{i}": rng.randrange(1, 90) for i in range(n)})
              for n in (1, 2, 5, 12)]
    for weights, blocks in cases:
        rows = pfair.schedule(spark, {s: 4 * n - n % 3 for s, n in blocks.items()}, weights, 4).collect()
        rows.sort(key=lambda r: r.mix_slot)
        assert [r.mix_slot for r in rows] == list(range(sum(blocks.values())))
        left = {s: Fraction(n) for s, n in blocks.items()}
        ran, pos = Counter(), 0
        for r in rows:
            assert r.mix_block == ran[r._s] and r._pos == pos
            pos += min(4, 4 * blocks[r._s] - blocks[r._s] % 3 - 4 * r.mix_block)
            ran[r._s] += 1
            time = Fraction(1)  # one slot of exact shares
            while time:
                alive = {s: weights[s] for s, x in left.items() if x}
                step = min([time / sum(alive.values())] + [left[s] / a for s, a in alive.items()])
                for s, a in alive.items():
                    left[s] -= step * a
                time -= step * sum(alive.values())
            assert all(abs(ran[s] - (blocks[s] - left[s])) < 1 for s in blocks)


def test_pfair_with_very_many_sources(spark):
    rng = random.Random(18)
    counts = {f"host{i}": rng.choice([1, 3, 40, 200]) for i in range(100_000)}
    got = pfair.schedule(spark, counts, pfair.tempered(counts)).agg(
        F.count("*").alias("n"), F.countDistinct("mix_slot").alias("slots"), F.max("mix_slot").alias("last"),
        F.countDistinct("_pos").alias("places")).first()
    blocks = sum(-(-n // 32) for n in counts.values())
    assert (got.n, got.slots, got.last, got.places) == (blocks, blocks, blocks - 1, blocks)
    with pytest.raises(ValueError):
        pfair.mix(frame(spark, ["a", "b"]), weights={"a": 0})


def test_mix_places_every_row(spark):
    rng = random.Random(6)
    sources = [rng.choice(["hot", "hot", "b", None, "d"]) for _ in range(333)]
    docs = frame(spark, [None if i % 11 == 0 else str(i % 50) for i in range(333)], sources)
    docs = docs.union(docs.limit(3))
    rows = pfair.mix(docs, block_rows=4).collect()
    assert sorted(r.mix_pos for r in rows) == list(range(336))
    assert all(r.mix_source == r.source for r in rows)
    assert pfair.mix(docs.limit(0)).count() == 0
