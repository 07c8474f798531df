"""Secret scan with an incremental blob ledger.

Every historical version of a path is content-addressed (SHA-256 of its text).
A ledger in the shared folder records which blob has been scanned under which
rule version, and the findings. A run scans only the pairs of blob and rule
version that the ledger has not, each distinct text once, and joins findings
back to all paths that hold the blob. All steps are DataFrame expressions.

Spans are code points, end exclusive; a rule's matches are leftmost and do not
overlap; a match whose group is shorter than the rule's minimum is dropped after
matching. Offsets come from the text between matches: ``split`` gives the gaps,
``regexp_extract_all`` the matches, and a running sum over one text's matches
places them.

Inputs: null text counts as empty; equal texts share findings; rows that repeat
a path are scanned once per text; a null path is scanned like any other; empty
tables give empty results. Only the path and text columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, written


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    group: int = 0
    minimum: int = 1


BASE = [
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    # maximal runs, so 32 in the pattern drops the same matches as a length check after it
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
]
#: A second rule version: kinds that the base rules do not know.
ADDED = [
    Rule("private_key", 2, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("hosted_token", 2, r"gh[opsu]_[A-Za-z0-9]{36,}"),
    # only from where a run of its letters begins, and without giving letters back: time is linear in long runs
    Rule("web_token", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]+"),
]
RULES = BASE + ADDED


def blobs(df: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(path, blob, text): every version with its content address."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(path_col).alias("path"), F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("text"))


def _matches(text: Column, rule: Rule) -> Column:
    """Array of (gap, size, value): lengths of the text before each match, of
    the match, and of the group that the minimum is for."""
    pattern, lengths = F.lit(rule.pattern), lambda a: F.transform(a, lambda x: F.length(x))
    gaps = lengths(F.split(text, rule.pattern, -1))
    whole, value = lengths(F.regexp_extract_all(text, pattern, F.lit(0))), lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group)))
    return F.transform(whole, lambda n, i: F.struct(gaps[i].alias("gap"), n.alias("size"), value[i].alias("value")))


def find(texts: DataFrame, rules: list[Rule]) -> DataFrame:
    """(blob, version, kind, start, end) in rows (blob, text, versions): a row
    is scanned under the rule versions that it lists."""
    none = F.array().cast("array<struct<gap:int,size:int,value:int>>")
    hits = F.array(*(
        F.struct(
            F.lit(r.version).alias("version"), F.lit(r.kind).alias("kind"), F.lit(r.minimum).alias("minimum"),
            F.when(F.array_contains("versions", r.version) & F.col("text").rlike(r.pattern), _matches(F.col("text"), r)).otherwise(none).alias("found"),
        )
        for r in rules
    ))
    rows = texts.select("blob", F.explode(hits).alias("h")).select("blob", "h.version", "h.kind", "h.minimum", F.posexplode("h.found").alias("i", "m"))
    rows = rows.distinct()  # a repeated row gives its text twice
    upto = Window.partitionBy("blob", "version", "kind").orderBy("i")  # one text's matches of one rule
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(upto)
    return rows.withColumn("end", end).filter("m.value >= minimum").select("blob", "version", "kind", (F.col("end") - F.col("m.size")).alias("start"), "end")


class Ledger:
    """Scanned (blob, version) pairs and findings below one folder; runs append
    to it through Spark's commit protocol, findings before scanned pairs, so a
    broken run is scanned again and findings are read as distinct rows."""

    SCANS, FINDINGS = "blob string, version int", "blob string, version int, kind string, start long, end long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        for name, schema in (("scans", self.SCANS), ("findings", self.FINDINGS)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{path}/{name}")

    def scans(self) -> DataFrame:
        return self.spark.read.schema(self.SCANS).parquet(f"{self.path}/scans")

    def findings(self) -> DataFrame:
        return self.spark.read.schema(self.FINDINGS).parquet(f"{self.path}/findings")

    def run(self, df: DataFrame, rules: list[Rule] = RULES, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Scan what is new in ``df`` and return (path, blob) of all its rows."""
        versions = sorted({r.version for r in rules})
        paths = written(blobs(df, path_col, text_col).select("path", "blob"), "paths")
        distinct = paths.groupBy("blob").agg(F.min("path").alias("path"))  # one path stands for all
        pairs = distinct.withColumn("version", F.explode(F.array(*(F.lit(v) for v in versions))))
        unseen = pairs.join(self.scans().distinct(), ["blob", "version"], "left_anti")
        todo = written(unseen.groupBy("blob").agg(F.min("path").alias("path"), F.collect_set("version").alias("versions")), "unseen")
        texts = blobs(df, path_col, text_col)
        known = todo.filter("path is not null").hint("shuffle_hash")
        new = texts.join(known, ["path", "blob"]).select("blob", "text", "versions")
        nameless = texts.filter("path is null").dropDuplicates(["blob"]).join(todo.filter("path is null").drop("path"), "blob").select("blob", "text", "versions")
        found = find(new.unionByName(nameless), rules).distinct()
        found.withColumn("start", F.col("start").cast("long")).withColumn("end", F.col("end").cast("long")).write.mode("append").parquet(f"{self.path}/findings")
        todo.select("blob", F.explode("versions").alias("version")).write.mode("append").parquet(f"{self.path}/scans")
        return paths


def scan(df: DataFrame, rules: list[Rule] = RULES, path_col: str = "doc_id", text_col: str = "text", ledger: Ledger | None = None) -> DataFrame:
    """(path, blob, findings) for every row; findings is an array of (start,
    rank, kind, end, version) in order of start and rule."""
    ledger = ledger or Ledger(df.sparkSession, scratch(df.sparkSession, "ledger"))
    paths = ledger.run(df, rules, path_col, text_col)
    rank = reduce(lambda c, r: c.when((F.col("kind") == r[1].kind) & (F.col("version") == r[1].version), r[0]), enumerate(rules), F.when(F.lit(False), -1))
    wanted = ledger.findings().distinct().withColumn("rank", rank).filter("rank is not null")
    per_blob = wanted.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end", "version"))).alias("findings"))
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,version:int>>")
    return paths.join(per_blob, "blob", "left").select("path", "blob", F.coalesce("findings", empty).alias("findings"))


def spans_text(findings: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
