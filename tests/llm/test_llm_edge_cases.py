"""Every operator over awkward rows: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from daytally.llm import (
    archives, decontamination, embeddings, html_text, lines, minhash, mixing, secrets, sharding, toxicity,
)
from daytally.llm.common import Store

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
CLASHING = ("size", "shard", "slot", "key", "rank", "score", "component_id", "component", "kept", "group", "part", "blob",
            "seen", "node", "line", "class", "label", "a", "b", "n", "version", "region", "host", "digest", "first", "toxic")
DOCS = [
    (None, "a row without id that has enough words to be a set", "en", "s1"), (1, None, "en", "s1"), (2, "", "en", None), (3, " \t\n ", None, None),
    (4, LONG, "en", "s2"), (5, "one two", "en", "s2"), (6, "one two", "en", "s2"), (7, "one two", "en", "s1"), (7, "one two", "en", "s1"),
    (8, "x" * 50_000, "en", "s1"), (9, "Ünïcode — “quotes” \x85 und mehr Wörter hier\nand a second line of text", "de", "S1"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in DOCS], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit("?").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (4, 0), (5, 1), (None, 1), (6, None)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, None), (2, ""), (None, "Is this here? No it is not here."), (4, "two words"), (5, "one two")], "item_id long, text string")


def documents_operators(spark, labels, benchmark):
    ledger = secrets.Ledger(spark, Store(spark, "ledger").root + "/l")
    return {
        "secrets": lambda d: secrets.secret_table(d, ledger),
        "minhash": minhash.near_duplicates,
        "sharding": sharding.shard_table,
        "toxicity": lambda d: toxicity.toxicity_table(d, labels),
        "mixing": mixing.mixing_table,
    }


@pytest.mark.parametrize("name", ["secrets", "minhash", "sharding", "toxicity", "mixing"])
def test_a_row_for_each_row(spark, docs, labels, benchmark, name):
    apply = documents_operators(spark, labels, benchmark)[name]
    assert apply(docs).count() == len(DOCS)
    assert apply(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["toxicity", "minhash", "decontamination", "mixing", "sharding"])
def test_row_operators_keep_the_columns(docs, labels, benchmark, name):
    apply = {
        "toxicity": lambda d: toxicity.clean_rows(d, labels), "minhash": minhash.kept_rows,
        "decontamination": lambda d: decontamination.clean_rows(d, benchmark), "mixing": mixing.mix_rows,
        "sharding": lambda d: sharding.shard_rows(d, out="to"),
    }[name]
    got = apply(docs)
    assert [c for c in got.columns if c != "to"] == docs.columns
    assert got.count() >= 1 and apply(docs.limit(0)).count() == 0


def test_minhash_defined_cases(docs):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 5, False)} <= got
    assert (None, 8, None, True) in got


def test_secrets_defined_cases(spark):
    key = "AKIA" + "A1B2C3D4E5F6G7H8"
    text = f"é token = short password: '{'p' * 12}' {key} AKIASHORT {'0a' * 8}"
    docs = spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string")
    ledger = secrets.Ledger(spark, Store(spark, "ledger").root + "/l")
    got = {r.doc_id: r for r in secrets.secret_table(docs, ledger).collect()}
    at = text.index("password"), text.index(key), text.index("0a" * 8)
    want = f"assign:{at[0]}:{at[0] + 23},access:{at[1]}:{at[1] + 20},hex:{at[2]}:{at[2] + 16}"
    assert got[1].spans == got[2].spans == want and got[3].spans == "" and (got[1].n_assign, got[1].n_hex) == (1, 1)
    # A second scan finds nothing new to read, a new rule version reads each blob once more.
    assert ledger.scanned.count() == 2
    secrets.secret_table(docs.limit(2).unionByName(docs.limit(1).withColumn("text", F.lit("new"))), ledger).count()
    assert ledger.scanned.count() == 3
    newer = (secrets.RULES[0], secrets.Rule("access", 2, r"AKIA[A-Z0-9]{14,}", 0, 18))
    ledger.scan(docs.select(secrets.blob_id(F.col("text")).alias("blob"), "text"), newer)
    assert sorted(r.rules for r in ledger.scanned.collect())[0] == ["access:2"]


def test_lines_defined_cases(spark):
    line = "a line that is long enough to count"
    docs = spark.createDataFrame(
        [(1, f"{line}\nshort"), (2, f"{line}s\nshart\n{line}"), (2, None), (3, None), (None, ""), (4, "x" * 20_000)], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_kept, r.n_near, r.n_links) for r in lines.line_table(docs).collect()}
    assert got == {1: (2, 2, 0, 1), 2: (3, 1, 1, 1), 3: (0, 0, 0, 0), None: (1, 1, 0, 0), 4: (1, 1, 0, 0)}
    assert {r.doc_id: r.text for r in lines.cleaned(docs).collect()}[2] == "shart"
    assert lines.line_table(docs.limit(0)).count() == 0


def test_vectors_defined_cases(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [1.0, 0.0], None),
            (7, [1.0, 0.0], 2), (1, [1.0, 0.0], 1), (8, [1.0, None], 1), (9, [1.0, 0.0, 0.0], 1), (10, [], 1), (11, [float("inf"), 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df).collect())
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)]
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), *alone])
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_decontamination_defined_cases(docs, benchmark):
    got = decontamination.contaminated(docs, benchmark).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, got)) == [(5, 5), (6, 5), (7, 5), (7, 5)]
    assert decontamination.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontamination.contaminated(docs.limit(0), benchmark).count() == 0


def test_pages_defined_cases(spark):
    body = "<p>x" + "y" * 2000
    rows = [(1, "http://a.b/x", body), (2, "http://a.b/x", body), (3, None, None), (None, "http://é.b/ü y\tz?q", body), (5, "http://a.b/x", body),
            (5, "http://a.b/x", body), (7, "", ""), (8, "http://www.zz.com:80/a#f", "small"), (9, "http://zz.com/a", "small"), (10, "http://[", "<" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("?")).withColumn("text", F.lit("?"))
    got = {(r.page_id, r.n_chars) for r in html_text.extract(pages).collect()}
    assert {(1, 2001), (3, 0), (7, 0), (8, 5)} <= got and html_text.extract(pages).count() == len(rows)
    assert html_text.extract(pages.limit(0)).count() == 0

    store = Store(spark, "archives")
    captures, files = archives.archive(pages, store)
    found = archives.lookup(captures, store.root, files, whole_key=False).collect()
    types = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in found)
    assert types[:6] == [(0, "revisit", 5), (1, "revisit", 5), (2, "revisit", 5), (3, "response", None), (5, "response", None), (5, "response", None)]
    assert len(found) == len(rows)
    by_url = spark.createDataFrame([("com,zz)/a",), ("none",)], "key string")
    assert sorted(r.page_id for r in archives.lookup(by_url, store.root, files).collect()) == [8, 9]
    empty = Store(spark, "archives")
    captures, files = archives.archive(pages.limit(0), empty)
    assert archives.lookup(captures, empty.root, files, whole_key=False).count() == 0


def test_kept_rows_is_one_row_of_each_group(spark):
    def words(name, n=60):
        return " ".join(f"{name}{i}" for i in range(n))
    rows = [(None, words("a")), (5, words("a")), (None, words("b")), (None, words("c")), (None, words("c")), (None, f"{words('c')} more"),
            (1, words("d")), (2, None), (None, None), (None, ""), (3, " \n"), (7, words("e")), (7, words("f")), (8, words("e")), (6, f"{words('f')} more")]
    docs = spark.createDataFrame([(*r, "?") for r in rows], "doc_id long, text string, row string")
    once = sorted(((r.doc_id, r.text) for r in minhash.kept_rows(docs).collect()), key=str)
    c = [r for r in once if r[1] and r[1].startswith("c0 ")]
    assert len(c) == 1 and c[0] in rows
    assert once == sorted([*c, (5, words("a")), (None, words("b")), (1, words("d")), (2, None), (None, None), (None, ""), (3, " \n"),
                           (7, words("e")), (6, f"{words('f')} more")], key=str)
    twice = sorted(((r.doc_id, r.text) for r in minhash.kept_rows(docs.unionByName(docs)).collect()), key=str)
    assert twice == once


def test_lines_table_tells_texts_and_classes(spark):
    line = "a line that is long enough to count"
    docs = spark.createDataFrame([(-3, f"one\n{line}"), (2, f"{line}s\nshart\n{line}"), (None, "null id\none"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in lines.line_table(docs).collect()}
    texts = {r.doc_id: r.text for r in lines.cleaned(docs).collect()}
    assert texts == {None: "null id\none", -3: line, 2: "shart", 4: None}
    assert all(got[i].digest == (None if t is None else hashlib.sha256(t.encode()).hexdigest()) for i, t in texts.items())
    assert {i: [tuple(c) for c in r.classes] for i, r in got.items()} == {None: [(0, None, 0), (1, None, 1)], -3: [(1, -3, 1)], 2: [(0, -3, 1), (1, 2, 1)], 4: []}


def test_lines_of_rows_that_share_or_lack_an_id(spark):
    """Against a plain loop over all pairs of lines."""
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    fox = "the quick brown fox jumps over dogs"
    apart = ["completely unrelated sentence goes here", "yet another line about something else", "numbers 12345 67890 and 24680 follow", "short", "the end of all that is here"]
    rows = [(1, fox), (5, f"{fox}s"), (5, apart[0]), (5, f"{apart[1]}\n{fox}"), (5, f"{apart[1]}\n{fox}"), (None, apart[2]), (None, f"{apart[2]}!\n{apart[3]}"),
            (None, None), (7, f"{apart[0]}x\n{apart[4]}"), *((None, f"row {i} without an id has this line {'abcdefghijklmnop'[i] * 9}") for i in range(16))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n") if text is not None else []:
            seen.setdefault(line, set()).add(doc_id)
    texts = sorted(seen)
    near = {(a, b) for a in texts for b in texts if a < b and distance(a, b) <= lines.threshold(min(len(a), len(b)))}
    group = {t: {t} for t in texts}
    for a, b in near:
        for t in group[a] | group[b]:
            group[t] = group[a] | group[b]
    cleaned = lines.cleaned(docs).collect()
    left = sorted(line for r in cleaned if r.text is not None for line in r.text.split("\n"))
    assert len(left) == len({frozenset(g) for g in group.values()})
    assert all(len(set(left) & g) == 1 for g in group.values())
    assert {apart[0], apart[1], apart[3], apart[4]} <= set(left) and f"{fox}s" not in left
    assert sum(r.doc_id is None for r in cleaned) == 19 and len(cleaned) == 22
    table = lines.line_table(docs).collect()
    assert sum(r.n_kept for r in table) == len(left) and sum(r.n_links for r in table) == 2 * len(near)
    assert sum(r.n_kept + r.n_near for r in table) == len(texts)


def test_ledger_goes_on_after_a_scan_that_broke_off(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "token = abcdefghijkl1"), (2, "AKIA" + "A" * 16)], "doc_id long, text string")
    ledger = secrets.Ledger(spark, Store(spark, "ledger").root + "/l")
    versions = docs.select(secrets.blob_id(F.col("text")).alias("blob"), "text")
    whole = [secrets.secret_table(docs, secrets.Ledger(spark, Store(spark, "ledger").root + "/l")).collect()]
    for broken in ("findings", "scanned"):
        def parquet(self, path, *args, write=type(docs.write).parquet, **options):
            if path.endswith(broken):
                raise OSError("gone")
            return write(self, path, *args, **options)

        with monkeypatch.context() as patch:
            patch.setattr(type(docs.write), "parquet", parquet)
            with pytest.raises(OSError, match="gone"):
                ledger.scan(versions)
    whole.append(secrets.secret_table(docs, ledger).collect())
    assert sorted(whole[0]) == sorted(whole[1]) and ledger.scanned.count() == 2
    assert not list(__import__("pathlib").Path(ledger.path.removeprefix("file:")).glob("runs/*"))


def test_many_secrets_in_one_text(spark):
    import time

    n = 40_000
    docs = spark.createDataFrame([(1, "é " + "token=abcdefghijkl " * n)], "doc_id long, text string")
    began = time.time()
    got = docs.select(secrets.spans(F.col("text"), secrets.RULES[0]).alias("s")).first()["s"]
    assert time.time() - began < 15
    assert [tuple(x) for x in got] == [(2 + 19 * i, 20 + 19 * i) for i in range(n)]


def test_records_are_looked_up_by_several_tasks(spark):
    pages = spark.range(400).selectExpr("id as page_id", "concat('http://h', id, '.org/') as url", "concat(repeat(sha2(string(id), 512), 20), uuid(), uuid()) as html")
    store = Store(spark, "archives")
    captures, files = archives.archive(pages, store)
    found = archives.lookup(captures, store.root, files, whole_key=False, tasks=5)
    assert found.rdd.getNumPartitions() == 5 and found.count() == 400
    assert archives.reading_tasks(captures) >= 1 and archives.reading_tasks(captures.limit(0)) == 1


def test_one_id_under_two_labels_is_no_bridge(spark):
    rows = [(5, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (5, [0.0, 1.0], 2), (3, [0.01, 1.0], 2), (5, [-1.0, 0.0], 1), (9, [-1.0, 0.01], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select(
        "*", *[F.lit("?").alias(c) for c in ("a", "b", "id", "mark", "code", "component", "node", "smallest", "copies", "vector", "of")])
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df).collect())
    assert got == [(2, 1, 2, True), (3, 1, 3, True), (5, 1, 2, False), (5, 1, 3, False), (5, 1, 5, True), (9, 1, 5, False)]
