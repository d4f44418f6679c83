"""The filter audit against SQL, and against filters applied one after the other to small tables."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from daytally.llm import filter_audit as fa
from verification.compare import compare, connect

SF = "/root/testdata/sf0.001"
WORDS = " ".join(f"word{i}" for i in range(210))
ROWS = [
    (1, WORDS, "en"), (2, WORDS, "de"), (2, WORDS, "de"), (3, WORDS + " #", "en"), (4, WORDS.upper(), None), (5, "a " * 300, ""),
    (6, None, "en"), (7, "", "en"), (8, " \t\x0b\n", None), (None, WORDS, "en"), (None, "only without id", "fr"), (9, "only without id", "fr"),
    (10, " " + WORDS, "en"), (11, "x y   z|" * 40_000, "fr"), (12, "x y   z|" * 40_000, "en"), (13, "ÄÖÜ ABC", "de"),
]
LABELS = [(1, 1, 0), (2, 1, 0), (2, 0, 1), (4, None, 1), (6, 1, None), (None, 1, 1), (99, 1, 1), (12, 1, 1)]


def plain(rows, labels):
    """Every order applied step by step."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    docs = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows)}
        docs.append((doc_id, lang or "", {k for k, v in fails.items() if v}))
    out, shapley = {}, Counter()
    for part in {d[1] for d in docs}:
        own = [d for d in docs if d[1] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[2]]
                left = [d for d in left if f not in d[2]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(f in d[2] for d in own) - len(gone), sum(d[2] == {f} for d in own),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def tables(spark, rows=ROWS, labels=LABELS):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clash = [F.lit("?").alias(c) for c in ("part", "mask", "words", "digest", "first", "n", "good", "toxic", "own")]
    return docs.select("*", *clash), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def as_dict(df):
    got = [tuple(r) for r in df.collect()]
    out = {r[:3]: r[3:] for r in got}
    assert len(out) == len(got)
    return out


def test_against_sql(spark):
    count, difference = compare(spark, connect(SF), SF, contract.queries()["op11_filter_audit"], contract.oracle_sql()["op11_filter_audit"])
    assert count > 0 and count % 600 == 0 and not difference, difference


def test_awkward_rows_step_by_step(spark):
    got = as_dict(fa.filter_audit(*tables(spark)))
    assert len(got) == 600 * 4 and got == plain(ROWS, LABELS)


def test_empty_tables(spark):
    docs, labels = tables(spark)
    assert fa.filter_audit(docs.limit(0), labels).count() == 0
    without = as_dict(fa.filter_audit(docs, labels.limit(0)))
    assert without == plain(ROWS, [])


@pytest.mark.parametrize("filters", [1, 3, 6])
def test_walk_gives_the_survivors_of_each_subset(filters):
    counts = np.random.default_rng(filters).integers(0, 50, (1 << filters, 2))
    states = fa.walk(counts)
    for subset in range(1 << filters):
        assert (states[subset] == sum((counts[m] for m in range(1 << filters) if not m & subset), np.zeros(2, int))).all()
