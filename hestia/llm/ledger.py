"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its content. The
ledger holds one row for each blob and rule version that has been scanned,
with the spans found (possibly none). A run scans each pair of blob and rule
version that the ledger lacks, once, whatever number of paths holds the blob;
findings are then joined back to all paths. Built-in functions only.

Matches of a rule are its pattern's leftmost non-overlapping ones, from which
those with too short a value are dropped. Spans are in code points, end
exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hestia.llm.common import fresh_path


@dataclass(frozen=True)
class Rule:
    """``group`` of each match must have ``at_least`` characters. A changed rule gets a new ``version``."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 1
    version: int = 1


# The base rules, in the order in which spans of one start are listed.
BASE_RULES = [
    Rule(
        "assign",
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        at_least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", at_least=20),
    Rule("hex", r"[0-9a-f]{24,}", at_least=24),
]
# Further rules; their spans come on top of the base ones.
MORE_RULES = [
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
]
RULES = [*BASE_RULES, *MORE_RULES]
SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"
#: Matches that are listed one after the other; more are listed by so many at a time.
RUN = 128


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _listed(each: Column, begin: Column, rule: Rule, rank: int) -> Column:
    """Spans of the matches ``each`` (gap before, size, size of the value), the first gap from ``begin`` on."""
    end = lambda acc, x: acc["at"] + x["gap"] + x["size"]

    def add(acc: Column, x: Column) -> Column:
        span = F.struct((acc["at"] + x["gap"]).alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end(acc, x).alias("end"))
        out = F.when(x["value"] >= rule.at_least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end(acc, x).alias("at"), out.alias("out"))

    empty = F.struct(begin.alias("at"), F.array().cast(SPANS).alias("out"))
    return F.aggregate(each, empty, add, lambda acc: acc["out"])


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule in ``text`` (not null), in order."""
    pattern = F.lit(rule.pattern)
    # Between two matches lies one part: start = all parts and matches before.
    parts = F.transform(F.split(text, rule.pattern), F.length)
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    value = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    each = F.arrays_zip(F.slice(parts, 1, F.size(found)).alias("gap"), found.alias("size"), value.alias("value"))

    def runs(all_: Column) -> Column:
        """Matches by runs of ``RUN``, so that no long list is appended to one by one."""
        firsts = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / RUN).cast("int"))
        return F.transform(firsts, lambda i: F.slice(all_, i * RUN + 1, RUN))

    def begins(by_run: Column) -> Column:
        """The runs, and how much of the text lies before each."""
        size = F.transform(by_run, lambda r: F.aggregate(r, F.lit(0), lambda n, x: n + x["gap"] + x["size"]))
        return F.struct(by_run.alias("runs"), size.alias("sizes"))

    def spans(x: Column) -> Column:
        before = lambda i: F.aggregate(F.slice(x["sizes"], 1, i), F.lit(0), lambda n, y: n + y)
        return F.flatten(F.transform(x["runs"], lambda r, i: _listed(r, before(i), rule, rank)))

    run = _let(each, lambda a: _let(runs(a), lambda r: _let(begins(r), spans)))
    return F.when(text.rlike(rule.pattern), run).otherwise(F.array().cast(SPANS))


def blob_id(content: Column) -> Column:
    """Address of a content; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(content, F.lit("")), 256))


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    """The ledger at ``path``; an empty one where nothing is there yet. Any other trouble with it is an error."""
    schema = f"blob_id binary, kind string, version int, spans {SPANS}"
    try:
        return spark.read.schema(schema).parquet(path) if path else spark.createDataFrame([], schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def new_ledger(spark: SparkSession) -> str:
    """A path in the shared folder at which ``scan`` can begin a ledger, for later runs to go on with."""
    return fresh_path(spark, "ledger")


def scan_unseen(contents: DataFrame, ledger: DataFrame | None, content: str = "content", rules: list[Rule] = RULES) -> DataFrame:
    """New ledger rows (blob_id, kind, version, spans): every blob of ``contents`` with every rule version that ``ledger`` lacks for it."""
    blobs = contents.select(blob_id(F.col(content)).alias("blob_id"), F.coalesce(content, F.lit("")).alias("body"))
    blobs = blobs.groupBy("blob_id").agg(F.first("body").alias("body"))
    if ledger is None:
        todo = blobs.withColumn("done", F.array().cast("array<string>"))
    else:
        name = F.concat_ws(":", "kind", "version")
        done = ledger.groupBy("blob_id").agg(F.collect_set(name).alias("done"))  # as many as there are rule versions at most
        todo = blobs.join(done, "blob_id", "left").withColumn("done", F.coalesce("done", F.array().cast("array<string>")))
    rows = F.array(*[
        F.struct(
            F.lit(r.kind).alias("kind"),
            F.lit(r.version).alias("version"),
            F.when(F.array_contains("done", f"{r.kind}:{r.version}"), F.lit(None)).otherwise(matches(F.col("body"), r, i)).alias("spans"),
        )
        for i, r in enumerate(rules)
    ])
    return todo.select("blob_id", F.inline(rows)).where("spans is not null")


def findings(paths: DataFrame, ledger: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``paths`` (with ``blob_id``) and ``spans`` of the current rule versions, by start, then by the rules' order; none: an empty array."""
    current = F.concat_ws(":", "kind", "version").isin([f"{r.kind}:{r.version}" for r in rules])
    by_blob = (
        ledger.where(current & (F.size("spans") > 0))
        .groupBy("blob_id")
        .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))  # spans of one content
    )
    return paths.join(by_blob, "blob_id", "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))


def scan(paths: DataFrame, *, content: str, keep: list[str], ledger_path: str | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """Scan what ``ledger_path`` lacks, append it there, and return ``keep``, ``blob_id`` and ``spans`` of every row of ``paths``.

    A ledger is begun where ``ledger_path`` holds none yet (``new_ledger`` names
    such a path); without ``ledger_path`` everything is scanned, into a ledger of
    this run alone. A null
    content counts as empty and has no spans; repeated rows share a blob and
    are returned each; an empty table gives an empty one; other columns are
    not read. Two runs that append at once may both scan a blob, which
    repeats ledger rows but, as each holds the same spans, is undone by the
    distinct below.
    """
    spark = paths.sparkSession
    old = read_ledger(spark, ledger_path) if ledger_path else None
    to = ledger_path or new_ledger(spark)
    scan_unseen(paths, old, content, rules).write.mode("append").parquet(to)
    ledger = read_ledger(spark, to).dropDuplicates(["blob_id", "kind", "version"])
    return findings(paths.select(*keep, blob_id(F.col(content)).alias("blob_id")), ledger, rules)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def without_secrets(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has no span, with all their columns."""
    keyed = docs.withColumn("__blob", blob_id(F.col("text")))
    path = fresh_path(docs.sparkSession, "ledger")
    scan_unseen(docs, None, "text").write.parquet(path)
    found = read_ledger(docs.sparkSession, path).where(F.size("spans") > 0).select(F.col("blob_id").alias("__blob")).distinct()
    return keyed.join(found, "__blob", "left_anti").select(docs.columns)
