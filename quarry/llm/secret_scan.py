"""Secret scans through an incremental blob ledger.

A text is a blob, named by its SHA-256. The ledger holds one row for each
blob and rule version scanned, with its findings. A run looks up which
(blob, rule, version) it lacks, scans each missing blob once however many
paths and versions hold it, adds the rows, and joins findings back to every
path. DataFrame functions only.

Spark has no function for the places of all matches, so they are summed up:
``split`` gives what lies between the matches and ``regexp_extract_all`` the
matches, in order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed


@dataclass(frozen=True)
class Rule:
    """Non-overlapping leftmost matches of ``pattern`` whose group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    base: bool = True


def _either(word: str) -> str:
    """``word`` in either case, ASCII letters only."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(_either, ("password", "passwd", "secret", "token")), _either("api") + "_?" + _either("key")])
#: Kinds in the order in which spans that start together are listed; the last two are not of the base.
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]{24,}", 0, 24),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", base=False),
)
#: Matches whose places are summed up at a time, so that time grows with the matches and not with their square.
BLOCK = 256
FINDINGS = "array<struct<start: bigint, place: int, kind: string, end: bigint>>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it stands in there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def spans(text: Column, rule: Rule, place: int) -> Column:
    """All findings of one rule in a text: ``start, place, kind, end`` in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    sizes = F.transform(matches, lambda m: F.length(m).cast("long"))
    judged = sizes if rule.group == 0 else F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda m: F.length(m).cast("long"))
    gaps = F.transform(F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(matches)), lambda g: F.length(g).cast("long"))
    none = F.from_json(F.lit("[]"), FINDINGS)
    step = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), judged.alias("judged"))

    def add(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        end = start + m["size"]
        found = F.struct(start.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(m["judged"] >= rule.least, F.concat(state["found"], F.array(found))).otherwise(state["found"]).alias("found"))

    zero = F.lit(0).cast("long")

    def cut(steps: Column) -> Column:
        last = F.greatest(F.floor((F.size(steps) - 1) / BLOCK).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)))

    def placed(blocks: Column) -> Column:
        lengths = F.transform(blocks, lambda block: F.aggregate(block, zero, lambda total, m: total + m["gap"] + m["size"]))
        starts = F.aggregate(lengths, F.array(zero), lambda upto, n: F.concat(upto, F.array(F.element_at(upto, -1) + n)))
        zipped = F.arrays_zip(blocks.alias("block"), F.slice(starts, F.lit(1), F.size(blocks)).alias("start"))
        return F.flatten(F.transform(zipped, lambda z: F.aggregate(z["block"], F.struct(z["start"].alias("at"), none.alias("found")), add, lambda s: s["found"])))

    every = _bound(step, lambda steps: _bound(cut(steps), placed))
    return F.when(F.rlike(text, pattern), every).otherwise(none)


def blobs(paths: DataFrame, text_col: str = "text") -> DataFrame:
    """``paths`` with the content address ``blob`` of the text (null: that of the empty text)."""
    return paths.withColumn("blob", F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))


def scan_new(addressed: DataFrame, key: str, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows ``blob, kind, version, found`` for all (blob, rule, version) that ``ledger`` lacks.

    ``addressed`` has ``key`` (one for each blob at least), ``blob`` and ``text``. Of the rows with one
    blob only the one with the smallest key is scanned; the text itself is not
    grouped. A blob without findings gets a row too: it has been scanned.
    """
    first = addressed.groupBy("blob").agg(F.min(key).alias(key))
    kinds = [(r.kind, r.version) for r in rules]
    if ledger is None:
        todo = first.withColumn("todo", F.lit([f"{k}:{v}" for k, v in kinds]))
    else:
        known = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("known"))  # one row for each rule version
        todo = first.join(known, "blob", "left").withColumn("todo", F.array_except(F.lit([f"{k}:{v}" for k, v in kinds]), F.coalesce("known", F.array().cast("array<string>")))).filter(F.size("todo") > 0)
    texts = addressed.select(key, "text").join(todo.select(key, "blob", "todo"), key)
    scanned = [F.when(F.array_contains("todo", f"{r.kind}:{r.version}"), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), spans(F.coalesce("text", F.lit("")), r, i).alias("found"))) for i, r in enumerate(rules)]
    return texts.select("blob", F.explode(F.filter(F.array(*scanned), lambda s: s.isNotNull())).alias("s")).select("blob", "s.kind", "s.version", "s.found")


def scan(paths: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Findings of every path, and the ledger with this run's rows added.

    Findings: one row per row of ``paths`` with ``doc_id, blob, found`` (spans of
    all rules at their present versions, by start, then kind as listed). Null
    text counts as empty; repeated ids with one text are scanned once and stay
    repeated; ids may be null; an empty table gives an empty result; other
    columns are not carried, so none can clash. Blobs without findings never
    meet the paths in a join: what a path is joined with are the blobs that
    have some, and Spark splits a blob that many paths share.
    """
    # Rows with one id and one text are one path; a null id counts as an id of its own.
    addressed = blobs(paths.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    addressed = addressed.withColumn("path", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "blob"))
    new = checkpointed(scan_new(addressed, "path", ledger, rules).dropDuplicates(["blob", "kind", "version"]))  # rows with one id and text are scanned as often
    total = new if ledger is None else ledger.select("blob", "kind", "version", "found").unionByName(new)
    present = reduce(lambda a, b: a | b, [(F.col("kind") == r.kind) & (F.col("version") == r.version) for r in rules])
    found = total.filter(present & (F.size("found") > 0)).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))  # one row for each rule
    rows = addressed.select("doc_id", "blob").join(found, "blob", "left")
    return rows.select("doc_id", "blob", F.coalesce("found", F.from_json(F.lit("[]"), FINDINGS)).alias("found")), total


def scan_versions(versions: list[DataFrame], id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """``scan`` of each version's paths in turn, each with the ledger that the versions before it filled: findings of all paths, and the ledger."""
    found, ledger = [], None
    for paths in versions:
        rows, ledger = scan(paths, ledger, id_col, text_col, rules)
        found.append(rows)
    return reduce(DataFrame.unionByName, found), ledger


def listed(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
