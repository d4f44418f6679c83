"""Whole results against SQL, plain loops, brute force or held-out accuracy."""

import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from daytally.llm import components, decontamination, embeddings, html_text, lines, minhash, sharding, toxicity
from daytally.llm.common import Store, table
from verification.compare import compare, connect

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.mark.parametrize("name", ["op2_secrets", "op7_archives", "op9_mixing"])
def test_against_sql(spark, name):
    count, difference = compare(spark, connect(SF), SF, contract.queries()[name], contract.oracle_sql()[name])
    assert count > 0 and not difference, difference


def test_html_regions():
    page = ('<html><body class="home nav-open"><header><h1>Site</h1></header><div id="menu"><a>Home</a></div><div class="post-12"><h2>Title &amp; '
            'more</h2><p>First para&nbsp;here is  long enough.<p>Second <b>para</b> with <a href="x>y">link</a>.<div class="ad">BUY</div><ul><li>one<li>'
            'two</ul><form><p>Name</p></form><script>var x = "</p>";</script></div><div class="sidebar"><p>side text</p></div>'
            '<div id="comments"><p>I like it very very much and much and much more than anything</p></div></div><footer>c</footer></body></html>')
    pages = [page, page.replace("First", "Other").replace("<li>two", ""), page.replace("Second", "Third")]
    found = html_text.wrapper(pages)
    region = html_text.region(found, 3)
    assert region.endswith("div.post-0") and "(<p>#</p>)+" in html_text.expression(found)
    assert html_text.main_text(page, region) == "Title & more\nFirst para here is long enough.\nSecond para with link.\none\ntwo"


def test_html_texts_of_articles(spark):
    got = {r.page_id: r.text for r in contract.queries()["op1_html_text"](spark, SF).collect()}
    for r in table(spark, SF, "pages").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html_text.html_module.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


def test_near_documents_against_all_pairs(spark, docs):
    # Variants of one text around the threshold, documents that share a passage only, and the table itself.
    rng = np.random.default_rng(3)
    base, passage = [f"b{i}" for i in range(60)], " ".join(f"p{i}" for i in range(60))
    extra = [(10_000 + i, " ".join(["changed" + str(i) if j in rng.choice(60, 1 + i % 3) else w for j, w in enumerate(base)])) for i in range(40)]
    extra += [(20_000 + i, f"{' '.join(f'u{i}x{j}' for j in range(25))} {passage}") for i in range(30)]
    rows = spark.createDataFrame(extra, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(rows).collect()}
    sets = {r.doc_id: shingle_set(r.text) for r in rows.collect()}
    ids = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = smallest(pairs, ids)
    assert got == {i: (len(sets[i]), root[i], root[i] == i) for i in ids}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 201), (201, 200), (7, 7)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"), Store(spark, "test"), "t")
    nodes = {x for e in edges for x in e}
    assert dict(found.collect()) == smallest(edges, nodes)


def test_shards_are_balanced_and_keep_groups(spark, docs):
    got = sharding.shard_table(docs, 7).toPandas()
    texts = {r.doc_id: r.text for r in docs.collect()}
    loads = got.groupby("shard")["size"].sum()
    assert loads.max() - loads.min() <= got["size"].max() and set(got["shard"]) == set(range(7))
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard")["slot"])
    assert len({(texts[r.doc_id], r.shard) for r in got.itertuples()}) == len(set(texts.values()))
    assert sharding.lpt([5, 9, 4, 4, 3], 2) == [1, 0, 1, 0, 1]


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 64))
    noise = rng.uniform(0.02, 0.05, 300)[:, None] * rng.normal(size=(300, 64)) * np.linalg.norm(centres, axis=1).mean() / 4
    x = centres[rng.integers(0, 6, 300)] + noise * 4
    rows = [(i, [float(v) for v in x[i]], int(i % 2)) for i in range(300)]
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    links = [(i, j) for i in range(300) for j in range(i) if i % 2 == j % 2 and unit[i] @ unit[j] >= embeddings.LEAST]
    degree = Counter(i for pair in links for i in pair)
    assert links and sum(r.n_links for r in got.values()) >= 0.9 * 2 * len(links)
    assert all(r.n_links <= degree[i] for i, r in got.items())


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    found = contract.queries()["op6_toxicity"](spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert len(found) > 50 and (found["predicted"] == found["toxic"]).mean() >= 0.95
    assert found["score"].between(0, 1).all()


def test_label_model_shares_the_vote_of_copies():
    rng = np.random.default_rng(2)
    y = (rng.random(2000) < 0.3).astype(float)
    votes = np.column_stack([np.where(y, rng.random(2000) < 0.8, rng.random(2000) < 0.1) for _ in range(4)] + [y]).astype(float)
    votes = np.column_stack([votes[:, :4], votes[:, 0], votes[:, 0], votes[:, 4]])  # two copies of the first voter; labels last
    rates = [(w @ votes + 0.5) / (w.sum() + 1) for w in (y, 1 - y)]
    assert np.allclose(toxicity.clusters(votes, y, np.ones(2000), *rates), [1 / 3, 1, 1, 1, 1 / 3, 1 / 3, 1])
    assert (toxicity.label_model(votes[:, :6], y, np.ones(2000)).round() == y).mean() > 0.99


def test_edit_distance_and_line_join(spark):
    rng = np.random.default_rng(9)
    texts = set()
    for _ in range(40):
        base = "".join(rng.choice(list("abcdefg é"), rng.integers(18, 36)))
        for _ in range(6):
            line = list(base)
            for _ in range(rng.integers(0, 4)):
                at = rng.integers(0, len(line))
                line[at: at + rng.integers(0, 2)] = rng.choice(["", "z", "é"])
            texts.add("".join(line))
    texts = sorted(texts)
    store = Store(spark, "test")
    rows = store.put(lines.distinct_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), "rows")
    got = {tuple(sorted((int(x) >> 61) - (3 << 63) for x in (r.a, r.b))) for r in lines.near_lines(rows, store).collect()}
    long = [i for i, t in enumerate(texts) if len(t) >= lines.SHORTEST]
    want = {(i, j) for j in long for i in long if i < j and distance(texts[i], texts[j]) <= lines.EDITS}
    assert want and got == want
    pairs = [(a, b) if len(a) >= len(b) else (b, a) for a, b in zip(texts, texts[1:])]
    chars = [F.slice(F.split(c, ""), F.lit(1), F.length(c)) for c in ("a", "b")]
    for k in (1, 3):
        seen = spark.createDataFrame(pairs, "a string, b string").select("a", "b", lines.within(*chars, k).alias("near")).collect()
        assert all(r.near == (distance(r.a, r.b) <= k) for r in seen)


def test_benchmark_items_against_all_documents(spark, docs):
    item = "What does the first lantern cost today, and who pays? The keeper of the northern harbour pays four silver coins."
    planted = [(90_001, f"Before it. {item.upper()} After it."), (90_002, item.split("?")[0] + "? Nobody knows the answer to that."), (90_003, "x " * 500 + item)]
    rows = spark.createDataFrame(planted, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    items = spark.createDataFrame([(900, item)], "item_id long, text string").unionByName(table(spark, SF, "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(rows, items).collect()}

    def words(text):
        return re.findall(r"[^\s!-/:-@\[-`{-~]+", (text or "").lower())

    def runs(w):
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    held = defaultdict(set)
    for r in rows.collect():
        for run in runs(words(r.text)):
            held[run].add(r.doc_id)
    want = set()
    for r in items.collect():
        own = runs(words(r.text))
        count = Counter(d for run in own for d in held[run])
        want |= {(d, r.item_id) for d, n in count.items() if n >= 0.9 * len(own)}
    assert {(90_001, 900), (90_003, 900)} <= got and got == want


def test_pipeline_stage_by_stage(spark):
    docs = before = table(spark, SF, "documents")
    store, seen = Store(spark, "test"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = store.put(stage(spark, docs, SF), name)
        seen[name] = docs
    score = {r.doc_id: r.predicted for r in contract.queries()["op6_toxicity"](spark, SF).collect()}
    assert {r.doc_id for r in seen["toxicity"].collect()} == {i for i, p in score.items() if not p}
    sets = {r.doc_id: shingle_set(r.text) for r in seen["toxicity"].collect()}
    ids = sorted(sets)
    root = smallest([(a, b) for i, a in enumerate(ids) for b in ids[:i]
                     if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])], ids)
    assert {r.doc_id for r in seen["near_dedup"].collect()} == {i for i in ids if root[i] == i}
    held = {r.doc_id for r in decontamination.contaminated(seen["near_dedup"], table(spark, SF, "benchmark")).collect()}
    assert {r.doc_id for r in seen["decontamination"].collect()} == {r.doc_id for r in seen["near_dedup"].collect()} - held
    copies = Counter(r.doc_id for r in seen["mixing"].collect())
    assert max(copies.values()) <= 3 and set(copies) <= {r.doc_id for r in seen["decontamination"].collect()}
    shards = defaultdict(set)
    for r in seen["sharding"].collect():
        shards[r.text].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    for name in ("toxicity", "near_dedup", "decontamination", "mixing"):
        assert seen[name].columns == before.columns


def test_html_values_end_at_their_closing_quote():
    for mark in "\"'":
        value = f"<b>{'z' * 2000}</b></div>"
        page = f"<article><p>One.</p><div class=\"ad\" data-x={mark}{value}{mark}>BUY</div><p>Two.</p></article>"
        assert html_text.main_text(page, "article") == "One.\nTwo."
    assert html_text.main_text('<article><p title="open>One.</p><p>3 <4 and more.</p></article>', "article") == "One.\n3 <4 and more."


def test_html_pages_are_measured_whole():
    index = "".join(f"<p><a>Entry number {i} of the index</a></p><h2>{'x' * (i % 7)}</h2>" for i in range(1500))
    body = "".join(f"<p>Sentence {i} of the long main text, which is much longer than an entry.</p>" for i in range(3000))
    pages = [f'<body><div class="toc">{index}</div><div class="long"><h3>Main</h3>{body.replace("long main", word)}</div></body>' for word in ("long main", "main", "whole")]
    whole = [html_text.main_text(page, "") for page in pages]
    assert all(text.startswith("Main\nSentence 0 ") and text.count("\n") == 3000 for text in whole)
    found = html_text.region(html_text.wrapper(pages), 3)
    assert found == "body>div.long" and [html_text.main_text(page, found) for page in pages] == whole
    # Long pages that don't fold and have nothing but common tokens are aligned in bounded time.
    rng = np.random.default_rng(4)
    mixed = ["<body>" + "".join(f"<{t}>text {i}</{t}>" for i, t in enumerate(rng.choice(["p", "h2", "h3", "ul"], 20_000))) + "</body>" for _ in range(3)]
    assert html_text.region(html_text.wrapper(mixed), 3) == "body"


def test_html_all_articles_of_a_page():
    parts = ["One is short.", "Two is a good deal longer than one.", "Three."]
    page = "<body>" + "<div>between</div>".join(f"<article><p>{part}</p></article>" for part in parts) + '<article class="comment"><p>I like it</p></article></body>'
    for path in ("body>article", ""):
        assert html_text.main_text(page, path) == "\n".join(parts)


def test_lines_of_all_lengths_against_all_pairs(spark):
    rng = np.random.default_rng(12)
    texts = set()
    for size in [*range(5, 50), 58, 60, 61, 75, 104, 106, 120, 150, 208, 211, 250, 350, 500]:
        base = list(rng.choice(list("abcdefghij kléñ"), size))
        for k in range(6):
            line, most = list(base), size // 15 + 2
            for _ in range(rng.integers(0, most + 1) if k % 2 else min(k, most)):
                at = rng.integers(0, len(line))
                line[at: at + rng.integers(0, 2)] = [rng.choice(["", "z", "é"])]
            texts.add("".join(line))
        word = list(base)
        word[size // 2: size // 2 + 6] = rng.choice(list("uvwxy"), 7)
        texts |= {"".join(base), "".join(word)}
    texts = sorted(texts)
    store = Store(spark, "test")
    rows = store.put(lines.distinct_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), "rows")
    got = {tuple(sorted((int(x) >> 61) - (3 << 63) for x in (r.a, r.b))) for r in lines.near_by_length(rows, store).collect()}
    want = set()
    for i, a in enumerate(texts):
        for j in range(i):
            most = lines.threshold(min(len(a), len(texts[j])))
            if abs(len(a) - len(texts[j])) <= most and distance(a, texts[j]) <= most:
                want.add((j, i))
    assert len(want) > 200 and {1, 2, 3, 10, 33} <= {lines.threshold(len(texts[j])) for j, _ in want}
    assert got == want


def test_long_lines_in_ranges_of_lengths_against_all_pairs(spark, monkeypatch):
    """Many ranges, some in parts: a pair across two ranges and one found in several parts are links once."""
    monkeypatch.setattr(lines, "LEAST", 1)
    monkeypatch.setattr(lines, "RANGES", 12)
    rng = np.random.default_rng(21)
    texts = set()
    for size in [45, 59, 60, 62, 104, 105, 107, 209, 210, 212, 300, 300, 300, 300]:
        base = list(rng.choice(list("abcdefghij k"), size))
        texts.add("".join(base))
        for _ in range(5):
            line = list(base)
            for at in rng.integers(0, size, rng.integers(0, size // 15 + 1)):
                line[at] = rng.choice(["", "z", line[at] + "y"])
            texts.add("".join(line))
    texts = sorted(texts)
    store = Store(spark, "test")
    rows = store.put(lines.distinct_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), "rows")
    taken = lines.ranges(rows.where("length >= 45"))
    assert len(taken) > 5 and max(parts for _, _, parts in taken) > 1 and all(a[1] < b[0] for a, b in zip(taken, taken[1:]))
    got = sorted(tuple(sorted((int(x) >> 61) - (3 << 63) for x in (r.a, r.b))) for r in lines.near_long_lines(rows, store).collect())
    want = []
    for i, a in enumerate(texts):
        for j in range(i):
            short = min(len(a), len(texts[j]))
            if short >= 45 and abs(len(a) - len(texts[j])) <= short // 15 and distance(a, texts[j]) <= short // 15:
                want.append((j, i))
    crossing = [p for p in want if len({next(n for n, r in enumerate(taken) if r[0] <= len(texts[i]) <= r[1]) for i in p}) > 1]
    assert crossing and got == sorted(want)


def test_long_lines_are_shuffled_not_their_probes(spark, monkeypatch):
    """Lines with words changed, left out or put in, the segments of a range held in several parts."""
    monkeypatch.setattr(lines, "HELD", 1 << 9, raising=False)
    monkeypatch.setattr(lines, "LEAST", 1)
    monkeypatch.setattr(lines, "RANGES", 6)
    monkeypatch.setattr(lines, "AT_ONCE", 2, raising=False)
    rng = np.random.default_rng(33)
    words = ["".join(rng.choice(list("abcdefgé"), rng.integers(1, 12))) for _ in range(300)]
    texts = set()
    for size in [12, 20, 33, 60, 90]:
        base = list(rng.choice(words, size))
        for k in range(12):
            line = list(base)
            for at in rng.integers(0, size, rng.integers(0, size // 8 + 2)):
                line[at] = rng.choice([*rng.choice(words, 2), line[at] + "x"] if k % 2 else ["", line[at], "a b"])
            texts.add(" ".join(line))
    texts, plans = sorted(texts), []

    class Seen(Store):
        def put(self, df, name):
            if name.startswith("long_pairs"):
                plans.append(df._jdf.queryExecution().executedPlan().toString())
            return super().put(df, name)

    store = Seen(spark, "test")
    rows = store.put(lines.distinct_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), "rows")
    got = sorted(tuple(sorted((int(x) >> 61) - (3 << 63) for x in (r.a, r.b))) for r in lines.near_long_lines(rows, store).collect())
    want = []
    for i, a in enumerate(texts):
        for j in range(i):
            short = min(len(a), len(texts[j]))
            if short >= 45 and abs(len(a) - len(texts[j])) <= short // 15 and distance(a, texts[j]) <= short // 15:
                want.append((j, i))
    assert len(want) > 50 and got == sorted(want)
    assert len(plans) > 1 and not any("hashpartitioning(key" in p for p in plans)


def test_lines_leave_no_shuffled_files(spark):
    def shuffled():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for top in manager.localDirsString() for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    text = "the quick brown fox jumps over the lazy dog and then sleeps in the sun"
    docs = spark.createDataFrame([(n, f"{text} {n * 7919}\n{'x' * n}") for n in range(50)], "doc_id long, text string")
    before, kept = shuffled(), spark.conf.get(lines.CLEANUP)
    table = lines.line_table(docs)
    assert not shuffled() - before and spark.conf.get(lines.CLEANUP) == kept
    assert table.count() == 50


def test_texts_are_scored_by_whole_pieces():
    """A text longer than a piece has the stems and patterns of the text taken at once."""
    import random

    rng = random.Random(4)
    words = ["Idiot", "STUPID!!", "überALLES", "x" * 50, "a1b2", "naïve", "ΑΣ.", "$%", "loser's", "\n", "\t"]
    lexicon = toxicity.Lexicon([" idio", " stupid ", " über", " loser "])
    for size in (0, 10, 5000, 60_000):
        text = " ".join(rng.choice(words) for _ in range(size))
        assert "".join(toxicity.pieces(text)) == text
        assert all(p[-1].isspace() for p in list(toxicity.pieces(text))[:-1])
        whole = toxicity.spaced(text)
        assert lexicon(text) == Counter(i for _, i in lexicon.found.iter(whole))
        found = {w for w in whole.split() if len(w) >= 4}
        assert {s.strip() for s in toxicity.stems(text)} == {w[:k] for w in found for k in (4, 5, 6)} | {w for w in found if len(w) <= 12}
        n = max(1, len(text))
        assert toxicity.patterns(text) == [
            float(len(re.findall("[A-Z]", text)) / n > 0.3), float(text.count("!") / n > 0.01), float(len(re.findall("[#$%&*@]", text)) / n > 0.05)]
    assert len(list(toxicity.pieces("x" * 300_000))) == 1


def bm25(docs, items):
    """Plain BM25 of all passages: (doc, item) -> best (score, question, answer) of those that count."""
    import math

    words = lambda t: decontamination.hashes_of(t).tolist()
    bags = {i: words(t) for i, t in items.items() if words(t)}
    n, mean = len(bags), sum(map(len, bags.values())) / len(bags)
    df = Counter(w for bag in bags.values() for w in set(bag))

    def weight(item, w):
        count = bags[item].count(w)
        idf = math.log1p((n - df[w] + 0.5) / (df[w] + 0.5))
        return idf * count * (decontamination.K1 + 1) / (count + decontamination.K1 * (1 - decontamination.B + decontamination.B * len(bags[item]) / mean))
    weights = {i: {w: weight(i, w) for w in set(bag)} for i, bag in bags.items()}
    class_ = {i: sum(len(bag) > most for most in decontamination.LENGTHS) for i, bag in bags.items()}
    longest = {c: max(len(bags[i]) for i in bags if class_[i] == c) for c in set(class_.values())}

    def runs(w, size):
        return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}
    parts = {}
    for i in bags:
        text = items[i].rstrip()
        ends = [m.end() for m in re.finditer(r"[.!?][\"')\]]*\s+", text)]
        last = len(words(text[ends[-1]:])) if ends else len(bags[i]) // 2
        last = min(max(last, 5), max(len(bags[i]) - 5, 5))
        cut = [bags[i][: max(len(bags[i]) - last, 5)], bags[i][-last:]]
        parts[i] = [runs(c, min(5, len(c))) for c in cut]
    best = {}
    for d, text in docs.items():
        w = words(text)
        for c, size in longest.items():
            for at in range(0, len(w), size):
                passage = w[at: at + 2 * size]
                held = set(passage)
                for i in bags:
                    if class_[i] != c:
                        continue
                    score = sum(v for t, v in weights[i].items() if t in held) / sum(weights[i].values())
                    if score >= decontamination.LEAST - 1e-9:
                        own = runs(passage, min(5, len(bags[i])))
                        parted = [len(p & own) / len(p) for p in parts[i]]
                        if min(parted) >= decontamination.OVERLAP:
                            best[d, i] = max(best.get((d, i), (0, 0, 0)), (score, *parted))
    return best


@pytest.mark.parametrize("shard_words, cells", [(500_000, 1 << 20), (200, 8)])
def test_search_equals_plain_bm25_however_items_are_dealt(spark, monkeypatch, shard_words, cells):
    import random

    rng = random.Random(5)
    monkeypatch.setattr(decontamination, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(decontamination, "CELLS", cells)
    vocabulary = [f"{a}{b}" for a in "bcdfgklm" for b in ("an", "er", "it", "ol", "us", "ay")]

    def text(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", "?"]) for _ in range(n))
    items = {i: text(rng.choice([3, 8, 20, 40, 90, 600])) for i in range(60)}
    docs = {}
    for d in range(60):
        pieces = [text(rng.randrange(1, 150))]
        for _ in range(rng.randrange(3)):
            item = rng.choice(list(items.values())).split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                item[rng.randrange(len(item))] = rng.choice(vocabulary)
            pieces += [" ".join(item), text(rng.randrange(1, 60))]
        docs[d] = " ".join(pieces)
    frames = [spark.createDataFrame(list(x.items()), f"{k} long, text string") for x, k in ((docs, "doc_id"), (items, "item_id"))]
    want = bm25(docs, items)
    got = {(r.doc_id, r.item_id): (r.score, r.question_overlap, r.answer_overlap) for r in decontamination.contaminated(*frames).collect()}
    assert len(want) > 30 and got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k], atol=1e-9) for k in want)
    kept = {r.doc_id for r in decontamination.clean_rows(*frames).collect()}
    assert kept == set(docs) - {d for d, _ in want}


def test_html_streams_are_aligned_in_order():
    import random

    rng = random.Random(6)
    for _ in range(300):
        left = [rng.choice("abcdef") for _ in range(rng.randrange(12))]
        right = [c for c in left if rng.random() < 0.8] + [rng.choice("abxy") for _ in range(rng.randrange(3))]
        i = k = 0
        for same, a, b, c, d in html_text.matched(left, right):
            assert (a, c) == (i, k) and (not same or left[a:b] == right[c:d])
            i, k = b, d
        assert (i, k) == (len(left), len(right))
    assert [x[0] for x in html_text.matched(list("axbyc"), list("abzc"))] == [True, False, True, False, True]


def _html_pages(spark, htmls, url="http://paper.org/"):
    rows = [(i, f"{url}{i}", html) for i, html in enumerate(htmls)]
    return {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_html_template_and_names_inside_the_article(spark):
    """A notice that all pages have goes, whatever its name; blocks whose names only sound like something else stay."""
    def page(i):
        return (f'<body><nav><a>Home</a></nav><article><h1>Story {i}</h1><p>Text {i} of this story.</p><div class="box7">Subscribe to our paper today!</div>'
                f'<div class="long-form"><p>A longer part {i}.</p></div><p class="alert-story">What happened {i}.</p><div class="alert-box">Careful {i}</div>'
                f'<div class="comment-list"><p>I like {i}</p></div><p>Same line, twice a page.</p><p>Same line, twice a page {i}.</p></article></body>')
    got = _html_pages(spark, [page(i) for i in range(8)])
    for i in range(8):
        assert got[i] == f"Story {i}\nText {i} of this story.\nA longer part {i}.\nWhat happened {i}.\nSame line, twice a page {i}."


def test_html_copies_of_a_page_keep_their_text(spark):
    body = "<body><article><h1>One</h1><p>All of it is the same.</p><p>Everywhere.</p></article><p>{}</p></body>"
    got = _html_pages(spark, [body.format("")] * 4 + [body.format(i) for i in range(4)])
    assert set(got.values()) == {"One\nAll of it is the same.\nEverywhere."}
    again = "<body><article><h1>{0}</h1>" + "<p>Chorus.</p>" * 5 + "<p>Verse {0} is a long one.</p></article></body>"
    assert _html_pages(spark, [again.format(i) for i in range(2)])[0].count("Chorus.") == 5


def test_html_template_of_all_pages(spark):
    """Of 60 pages a host, a notice that 36 have stays and one that 42 have goes, whichever pages of the host those are."""
    def page(host, i, fewer, more):
        notes = "".join(f'<p class="box{k}">{t}</p>' for k, (t, on) in enumerate((("Printed in the paper too.", fewer), ("Sent to you by post.", more))) if on)
        return f"<body><article><h1>Story {i} of {host}</h1>{notes}<p>Long text {i} of this story, as it was told {i} times in {host}.</p></article></body>"
    rows, wanted = [], {}
    for host in range(10):
        for i in range(60):
            n, fewer, more = host * 60 + i, (i * 7 + host) % 60 < 36, (i * 11 + host) % 60 < 42
            rows.append((n, f"http://h{host}.org/{i}", page(host, i, fewer, more)))
            wanted[n] = "\n".join([f"Story {i} of {host}", *["Printed in the paper too."] * fewer, f"Long text {i} of this story, as it was told {i} times in {host}."])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extract(pages.union(pages)).collect()} == wanted


def test_html_regions_of_all_pages(spark, monkeypatch):
    """Text of a few pages decides where most of a layout's text is, in parts and rounds of any size."""
    def page(i):
        long = " ".join(f"w{i}x{k}" for k in range(4000 if i in (77, 140) else 4))
        return f'<body><div class="one"><p>{long}</p></div><div class="two"><p>Seen {i} times, as the list has it.</p></div></body>'
    htmls = [page(i) for i in range(200)]
    assert html_text.region(html_text.wrapper(htmls), 200) == "body>div.one"
    for fan in (3, 64):
        monkeypatch.setattr(html_text, "FAN", fan)
        got = _html_pages(spark, htmls)
        assert all(got[i] == re.search("<p>(.*?)</p>", htmls[i])[1] for i in range(200))


def test_html_expressions_grow_with_what_differs():
    blocks = ["<p>a{0}</p>", "<h2>b{0}</h2>", "<ul><li>c{0}</li></ul>", "<table><tr><td>d{0}</table>", "<pre>e{0}</pre>"]
    pages = ["<body><article>" + "".join(blocks[(i * 31 + k * k * (i % 11) + k * i) % 5].format(i + k) for k in range(40)) + "</article></body>" for i in range(300)]
    few, all_ = html_text.wrapper(pages[:30]), html_text.wrapper(pages)
    assert len(html_text.expression(all_)) < 3 * len(html_text.expression(few))
    assert html_text.region(all_, 300) == "body>article"
    assert sum(sum(sizes.values()) for _, _, sizes in html_text.slots(all_)) == sum(len(t) for p in pages for kind, _, t in html_text.events(p) if kind == "text")


def test_html_two_layouts_of_a_large_host(spark):
    """Every twentieth of 1,000 pages has its text elsewhere, and a long list of links where the others have theirs."""
    words = [f"word{i}" for i in range(50)]

    def page(i):
        text = " ".join(words[(i * 7 + k) % 50] for k in range(12))
        if i % 20:
            return f'<body><div class="main"><p>{text} {i}.</p><p>More {i}.</p></div><div class="side9"><p>Link {i}</p></div></body>'
        links = "".join(f"<p>Go to {i * k}</p>" for k in range(30))
        return f'<body><div class="story"><h2>Report {i}</h2><p>{text} {i}.</p><p>{text} {text} {text} {text}.</p></div><div class="main">{links}</div><div class="story"><p>{text} end.</p></div></body>'
    got = _html_pages(spark, [page(i) for i in range(1000)], "http://big.org/")
    assert all(got[i].endswith(f"More {i}.") and got[i].count("\n") == 1 for i in range(1000) if i % 20)
    assert all("Report" in got[i] and f"{i}." in got[i] for i in range(0, 1000, 20))
