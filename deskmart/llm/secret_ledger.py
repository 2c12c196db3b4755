"""Secret scans: an incremental ledger of scanned (blob, rule version) pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmart.llm.common import matches, text_of, written


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that do not overlap; kept if ``part`` of the match has ``least`` characters."""

    kind: str
    version: str
    pattern: str
    part: int = 0
    least: int = 1


# Fixed patterns of the contract, then further kinds
BASE = (
    Rule("assign", "1", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "1", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "1", r"[0-9a-f]{24,}", 0, 24),  # the same as runs of any length, dropped below 24
)
# runs ahead of the telling character are bounded, so that a long run costs a bounded number of steps a character
MORE = (
    Rule("pem", "1", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("jwt", "2", r"eyJ[A-Za-z0-9_-]{8,1000}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("github", "1", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("login", "2", r"[a-z][a-z0-9+.-]{0,31}+://[^\s/:@]+:[^\s/:@]+@[^\s/:@]+"),
)
RULES = BASE + MORE


def spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of the rule's findings, in code points, end exclusive. Only texts with a match pay for it."""
    parts = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.part)) if rule.part else None
    found = matches(text, rule.pattern)
    if rule.part:
        found = F.zip_with(found, parts, lambda m, part: F.struct(m["start"].alias("start"), m["end"].alias("end"), part.alias("hit")))
    kept = F.filter(found, lambda m: F.length(m["hit"]) >= rule.least)
    return F.when(text.rlike(rule.pattern), F.transform(kept, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))))


def _labelled(found: Column, rule: Rule) -> Column:
    named = F.transform(found, lambda s: F.struct(
        F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"),
        s["start"].alias("start"), s["end"].alias("end")))
    return F.coalesce(named, F.expr("cast(array() as array<struct<kind:string,version:string,start:int,end:int>>)"))


class Ledger:
    """Two tables below ``path``: ``scanned`` (blob, kind, version) and ``findings`` (blob, kind, version, start, end).

    A blob is the SHA-256 of a whole text. ``update`` scans the pairs of blob and rule version that
    the ledger lacks, once per blob however many paths and versions hold it, and appends both
    tables; a scan that failed halfway is repeated, for findings are read only for scanned pairs
    and repeated findings count once. One update runs at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, table: str, schema: str) -> DataFrame:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return self.spark.sql(f"select from_json('{{}}', '{schema}') as row where false").select("row.*")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, kind string, version string")

    def findings(self, blobs: DataFrame | None = None) -> DataFrame:
        """Findings of scanned pairs; only those of ``blobs`` (blob), if given, which are picked before anything is made
        distinct."""
        found = self._read("findings", "blob string, kind string, version string, start int, end int")
        done = self.scanned()
        if blobs is not None:
            found, done = found.join(blobs, "blob", "left_semi"), done.join(blobs, "blob", "left_semi")
        return found.distinct().join(done, ["blob", "kind", "version"], "left_semi")

    def update(self, contents: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what is new in ``contents`` (path, text): every historical version is one row."""
        rows = contents.select(F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), text_of().alias("text"))
        addressed = rows.withColumn("blob", F.sha2("text", 256))
        names = [f"{r.kind}/{r.version}" for r in rules]
        rule = F.concat_ws("/", "kind", "version")
        # one row that holds the blob scans it; (path, blob) is the join key, so copies do not meet in a task
        held = written(addressed.groupBy("blob").agg(F.min("path").alias("path")), "blobs")
        done = (self.scanned().where(rule.isin(names)).join(held.select("blob"), "blob", "left_semi")
                .groupBy("blob").agg(F.collect_set(rule).alias("done")))
        holders = (held.join(done, "blob", "left")
                   .withColumn("todo", F.array_except(
                       F.array(*map(F.lit, names)),
                       F.coalesce("done", F.expr("cast(array() as array<string>)"))))
                   .where(F.size("todo") > 0).select("path", "blob", "todo"))
        holders = written(holders, "holders")
        work = addressed.join(holders.hint("shuffle_hash"), ["path", "blob"])
        found = F.concat(*(_labelled(F.when(F.array_contains("todo", f"{r.kind}/{r.version}"),
                                            spans(F.col("text"), r)), r) for r in rules))
        (work.select("blob", F.explode(found).alias("f")).select("blob", "f.*")
         .write.mode("append").parquet(f"{self.path}/findings"))
        (holders.select("blob", F.explode("todo").alias("rule"))
         .select("blob", F.substring_index("rule", "/", 1).alias("kind"), F.substring_index("rule", "/", -1).alias("version"))
         .write.mode("append").parquet(f"{self.path}/scanned"))


def span_text(found: Column) -> Column:
    """kind:start:end of all spans, ordered by start, then kind as listed in RULES, joined by commas."""
    ranked = F.array_sort(F.transform(found, lambda f: F.struct(
        f["start"], F.array_position(F.array(*(F.lit(r.kind) for r in RULES)), f["kind"]).alias("rank"),
        f["end"], f["kind"])))
    return F.concat_ws(",", F.transform(ranked, lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))


def scan_documents(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``docs``.

    The document is the path, its text the version. After the update, findings are joined back to
    all rows by blob. Null texts count as empty; null ids are one path; repeated rows are scanned
    once and all returned; further columns are ignored. A blob's findings are one list, which is no
    longer than its text.
    """
    ledger.update(docs.select(F.col("doc_id").alias("path"), "text"), rules)
    rows = docs.select("doc_id", F.sha2(text_of(), 256).alias("blob"))
    wanted = F.array(*(F.lit(f"{r.kind}/{r.version}") for r in rules))
    lists = written(
        ledger.findings(rows.select("blob").distinct()).where(F.array_contains(wanted, F.concat_ws("/", "kind", "version")))
        .groupBy("blob").agg(F.collect_list(F.struct("kind", "start", "end")).alias("found")), "found")
    found = F.coalesce("found", F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)"))
    base = F.filter(found, lambda f: f["kind"].isin(*(r.kind for r in BASE)))
    count = lambda kind: F.size(F.filter(found, lambda f: f["kind"] == kind)).cast("long")
    return rows.join(lists, "blob", "left").select(
        "doc_id", *(count(r.kind).alias(f"n_{r.kind}") for r in BASE),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(found).alias("spans"), "blob")
