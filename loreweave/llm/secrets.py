"""Secret scans with a ledger of blobs: every text is scanned once per rule version.

A version of a file is named by the SHA-256 of its text. One row per blob that
the ledger does not hold for all rule versions in use is scanned, by the missing
rules only; findings are joined back to every path that holds the blob.

Defined cases: a null text is the empty text; equal rows give equal rows; a null
path keeps its row; no rows give no rows. Spans count code points, end exclusive.
Only the path and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loreweave.operators.ranking import keep_first
from loreweave.sources.staging import stage


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that do not overlap; of these, ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

#: A run of 16 hexadecimal digits or more is what is left of the runs after the
#: shorter ones are dropped; the same holds for 18 characters from AKIA on.
BASE = (
    Rule("assign", ASSIGN, group=1, least=12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("login", r"://[^\x20\x09-\x0D/:@]{1,64}:[^\x20\x09-\x0D/:@]{1,64}@"),
)
RULES = BASE + MORE

LEDGER = "blob binary, rules array<string>, spans array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def scan(
    versions: DataFrame,
    path_col: str,
    text_col: str,
    ledger: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
) -> tuple[DataFrame, DataFrame]:
    """The ledger's new rows, and ``path, blob, spans`` for every version.

    ``ledger`` holds the rows of earlier scans; append the new ones to it.
    """
    spark = versions.sparkSession
    if ledger is None:
        ledger = spark.createDataFrame([], LEDGER)
    names = [r.name for r in rules]
    texts = versions.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = texts.withColumn("blob", F.unhex(F.sha2("text", 256)))
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    blobs = keep_first(named, ["blob"], F.col("path"))
    missing = F.array_except(F.array(*map(F.lit, names)), F.coalesce("seen", F.array().cast("array<string>")))
    todo = blobs.join(seen, "blob", "left").withColumn("rules", missing).filter(F.size("rules") > 0)
    new = stage(_scanned(todo, rules), "ledger")
    known = ledger.select("blob", "rules", "spans").unionByName(new)
    valid = F.filter("spans", lambda s: F.array_contains(F.col("used"), s["kind"]))
    kinds = {r.name: r.kind for r in rules}
    used = F.array(*[F.when(F.array_contains("rules", n), F.lit(k)) for n, k in kinds.items()])
    found = known.withColumn("used", used).select("blob", valid.alias("spans")).filter(F.size("spans") > 0)
    found = found.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    # Written, so that the join below is free to split a blob that many paths hold.
    found = stage(found, "found")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    paths = named.select("path", "blob").join(found, "blob", "left")
    return new, paths.select("path", "blob", F.coalesce("spans", none).alias("spans"))


def _scanned(todo: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob, rules, spans`` of each row of ``blob, text, rules``.

    A text is cut at a rule's matches: what lies between them and the matches
    themselves give the positions, by running sums over the pieces.
    """
    for k, r in enumerate(rules):
        wanted = F.array_contains("rules", r.name) & F.col("text").rlike(r.pattern)
        todo = todo.withColumn(f"m{k}", F.when(wanted, F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))))
    todo = todo.select("blob", "rules", F.concat(*[_pieces(k, r) for k, r in enumerate(rules)]).alias("pieces"))
    todo = stage(todo, "pieces")
    each = todo.select("blob", F.inline("pieces"))
    upto = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto)).filter("fine")
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "rank", "end", "kind")
    spans = each.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return todo.select("blob", "rules").join(spans, "blob", "left").select(
        "blob", "rules", F.coalesce("spans", none).alias("spans")
    )


def _pieces(rank: int, rule: Rule) -> Column:
    matches = F.col(f"m{rank}")
    gaps = F.split(F.col("text"), rule.pattern, -1)

    def piece(match: Column, i: Column) -> Column:
        value = F.regexp_extract(match, rule.pattern, rule.group) if rule.group else match
        return F.struct(
            F.lit(rank).alias("rank"), i.alias("i"), F.length(match).cast("bigint").alias("size"),
            (F.length(value) >= rule.least).alias("fine"), F.lit(rule.kind).alias("kind"),
        )

    def with_gap(p: Column, gap: Column) -> Column:
        fields = [p[c].alias(c) for c in ("rank", "i", "size", "fine", "kind")]
        return F.struct(*fields, F.length(gap).cast("bigint").alias("gap"))

    cut = F.zip_with(F.transform(matches, piece), F.slice(gaps, 1, F.size(matches)), with_gap)
    none = F.array().cast("array<struct<rank:int,i:int,size:bigint,fine:boolean,kind:string,gap:bigint>>")
    return F.when(matches.isNotNull(), cut).otherwise(none)


def joined(spans: Column, kinds: Sequence[str] | None = None) -> Column:
    """``kind:start:end`` of the spans, of ``kinds`` only if given, comma-joined."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
