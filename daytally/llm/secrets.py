"""Secret scans over a ledger of blobs.

Every version of every path is addressed by its content, the SHA-256 of the text. A ledger holds
one row for each blob and rule version that was scanned, and the findings; a scan looks only
at pairs that the ledger lacks, so that the same text under many paths, or seen on an earlier day,
is read once by each rule version. Findings are then joined back to all paths.

All of it is DataFrame functions. Spark's SQL functions give the strings that a pattern matches
but not their places, so places come from the pieces between: the text split by the pattern and
the matches take turns, and running lengths give starts and ends in code points.

Defined cases: a null text is the empty text and has no findings; repeated rows give a row each; an
empty table gives an empty result; very long texts are scanned whole.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import Store, table


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` finds candidates, leftmost and non-overlapping; a candidate
    counts if ``group`` has ``least`` characters. A changed rule needs a new version."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


#: The kinds in their listed order. A run of hex digits, or of capitals and digits after
#: AKIA, that is too short cannot hold a longer one, so the length is part of those patterns.
RULES = (
    Rule("assign", 1, r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)

SPANS = "array<struct<start:int,end:int>>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _placed(lengths: Column) -> Column:
    """Start, end and long of each match, from the gap before it and its size. An array grows by being copied,
    so this is done in blocks of about the square root of their number, each from 0, which are then moved to
    where they lie: n matches take n ** 1.5 steps."""
    empty = F.array().cast("array<struct<start:int,end:int,long:int>>")

    def step(state, x):
        begin = state["at"] + x["gap"]
        one = F.struct(begin.alias("start"), (begin + x["size"]).alias("end"), x["long"].alias("long"))
        return F.struct((begin + x["size"]).alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    def moved(state, x):
        there = F.transform(x["found"], lambda y: F.struct(
            (y["start"] + state["at"]).alias("start"), (y["end"] + state["at"]).alias("end"), y["long"].alias("long")))
        return F.struct((state["at"] + x["at"]).alias("at"), F.concat(state["found"], F.array(there)).alias("found"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int,long:int>>>").alias("found"))

    def placed(held: Column) -> Column:
        count = F.greatest(F.size(held), F.lit(1))
        block = F.ceil(F.sqrt(count)).cast("int")
        blocks = F.transform(F.sequence(F.lit(1), count, block), lambda i: F.aggregate(F.slice(held, i, block), start, step))
        return F.flatten(F.aggregate(blocks, none, moved, lambda state: state["found"]))

    # The lambda's argument holds the lengths, so they are found once and not for every block.
    return F.get(F.transform(F.array(lengths), placed), F.lit(0))


def spans(text: Column, rule: Rule) -> Column:
    """Start and end, in code points, of what the rule finds in a text."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    pieces = F.slice(F.split(text, rule.pattern), F.lit(1), F.size(whole))
    steps = F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), held.alias("held"))
    lengths = F.transform(steps, lambda x: F.struct(
        F.length(x["piece"]).alias("gap"), F.length(x["whole"]).alias("size"), F.length(x["held"]).alias("long")))
    found = _placed(lengths)
    good = F.transform(F.filter(found, lambda x: x["long"] >= rule.least),
                       lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return F.when(text.rlike(rule.pattern), good).otherwise(F.array().cast(SPANS))


class Ledger:
    """Scanned (blob, kind, version) rows and findings, as tables under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str) -> DataFrame | None:
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        fs = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(fs_path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    @property
    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, rules array<string>")

    @property
    def findings(self) -> DataFrame:
        return self._read("findings", f"blob string, kind string, version int, spans {SPANS}")

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scans the blobs of ``versions`` (blob, text) with the rules that haven't seen them.

        Findings are written before the rows that say so: a scan that breaks off between the two
        leaves findings that a later scan repeats, and ``found`` drops repeats. Each scan has a folder of its
        own for what it works on; the next one removes what a broken one left. One scan at a time.
        """
        self._remove_runs()
        run_path = f"{self.path}/runs/{uuid.uuid4().hex}"
        names = [f"{r.kind}:{r.version}" for r in rules]
        texts = versions.select("blob", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["blob"])
        seen = self.scanned.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
        todo = texts.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        todo = todo.where(F.size(F.array_except(F.array(*[F.lit(n) for n in names]), F.col("seen"))) > 0)
        results = todo.select("blob", "seen", *[
            F.when(F.array_contains("seen", n), F.array().cast(SPANS)).otherwise(spans(F.col("text"), r)).alias(r.kind)
            for n, r in zip(names, rules)
        ])
        results.withColumn("rules", F.array_except(F.array(*[F.lit(n) for n in names]), F.col("seen"))).drop("seen") \
            .write.parquet(run_path)
        run = self.spark.read.parquet(run_path)
        each = F.explode(F.array(*[
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.col(r.kind).alias("spans")) for r in rules
        ])).alias("x")
        run.select("blob", each).select("blob", "x.*").where(F.size("spans") > 0) \
            .write.mode("append").parquet(f"{self.path}/findings")
        run.select("blob", "rules").write.mode("append").parquet(f"{self.path}/scanned")
        self._remove_runs()

    def _remove_runs(self) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/runs")
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def found(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Per blob with findings: blob, and for each rule an array of its spans by start."""
        wanted = F.concat_ws(":", "kind", F.col("version").cast("string")).isin([f"{r.kind}:{r.version}" for r in rules])
        return self.findings.where(wanted).groupBy("blob").agg(*[
            F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("kind") == r.kind, F.col("spans")))))).alias(r.kind)
            for r in rules
        ])


def listed(rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of all spans by start, then kind as listed, joined by commas."""
    def mark(i: int):
        return lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("i"), x["end"].alias("end"))

    marked = F.concat(*[F.transform(F.col(r.kind), mark(i)) for i, r in enumerate(rules)])
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(F.array_sort(marked), lambda x: F.concat_ws(
        ":", F.get(names, x["i"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_table(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_<kind> of each rule, spans; scans what is new."""
    paths = docs.select("doc_id", F.col("text").alias("text"), blob_id(F.col("text")).alias("blob"))
    ledger.scan(paths.select("blob", "text"), rules)
    none = F.array().cast(SPANS)
    joined = paths.drop("text").join(ledger.found(rules), "blob", "left").select(
        "doc_id", *[F.coalesce(r.kind, none).alias(r.kind) for r in rules])
    return joined.select(
        "doc_id", *[F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in rules], listed(rules).alias("spans"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules are the base rules, so all spans are base spans."""
    ledger = Ledger(spark, Store(spark, "secrets").root + "/ledger")
    found = secret_table(table(spark, sf_dir, "documents"), ledger)
    return found.withColumn("base_sha256", F.sha2("spans", 256))


def _spans_sql(name: str, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
      list_filter(list_transform(range(1, len({name}_m) + 1), lambda i: {{
        'start': list_sum(list_transform({name}_p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform({name}_m[1:i-1], lambda x: length(x))), 0),
        'size': length({name}_m[i]), 'long': length({name}_g[i])}}), lambda s: s.long >= {rule.least})""", f"""
      regexp_extract_all(text, '{pattern}') as {name}_m, regexp_extract_all(text, '{pattern}', {rule.group}) as {name}_g,
      string_split_regex(text, '{pattern}') as {name}_p"""


_PARTS = {r.kind: _spans_sql(r.kind, r) for r in RULES}
OP2_SQL = f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
m as (select doc_id, {', '.join(p[1] for p in _PARTS.values())} from d),
s as (select doc_id, {', '.join(f'{p[0]} as {k}' for k, p in _PARTS.items())} from m),
j as (select doc_id, len(assign) as n_assign, len(access) as n_access, len(hex) as n_hex,
        array_to_string(list_transform(list_sort(list_concat(list_concat(
          list_transform(assign, lambda x: {{'s': x.start::bigint, 'k': 0, 'n': 'assign', 'e': (x.start + x.size)::bigint}}),
          list_transform(access, lambda x: {{'s': x.start::bigint, 'k': 1, 'n': 'access', 'e': (x.start + x.size)::bigint}})),
          list_transform(hex, lambda x: {{'s': x.start::bigint, 'k': 2, 'n': 'hex', 'e': (x.start + x.size)::bigint}}))),
          lambda x: x.n || ':' || x.s || ':' || x.e), ',') as spans from s)
select doc_id, n_assign::bigint as n_assign, n_access::bigint as n_access, n_hex::bigint as n_hex,
       coalesce(spans, '') as spans, sha256(coalesce(spans, '')) as base_sha256 from j
"""
