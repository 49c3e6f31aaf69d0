"""Secret scans: strong patterns, and weak parts of credentials that count only together.

Strong patterns ("assign", "access", "hex") are always reported. Weak parts are an account name, a 40-character key
and a service address. Each plays a role of a credential: identifier, secret or endpoint. An interval join within a
document, over scopes of `scope` characters, tells which weak parts stand near parts of complementary roles:

* a weak key needs an identifier or an endpoint in its scope,
* an account name needs a secret in its scope,
* an endpoint needs both an identifier and a secret in its scope.

A weak part that overlaps a strong span is not reported again. Everything is built-in expressions, joins and windows.
Texts are read once; only the lengths of matches and of the gaps between them leave that stage, and only these are
shuffled. Matches of one kind don't overlap, so a bucket of the join holds at most `scope` of them however long the
text is.

Every pattern takes time in proportion to the text: a scheme of an address has at most 31 characters, so that a long
run of letters is not searched again from each of its letters.

Defined results: a null or empty text has no spans; null ids and repeated rows give a row each; other columns are
ignored, whatever their names. Positions are code points, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, saved, whole_text

_KEY = r"(?i:password|passwd|secret|token|api_?key)"
_ACCOUNT = r"(?i:access_?key_?id|client_?id|account_?id|username|user_?name|login)"

#: kind, role, weak, pattern, group whose length counts, least length of that group. The order is the order of kinds.
KINDS = (
    ("assign", "secret", False, rf"({_KEY})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "identifier", False, r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", "secret", False, r"[0-9a-f]{24,}", 0, 24),
    ("account", "identifier", True, rf"{_ACCOUNT}[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]+", 0, 6),
    ("key40", "secret", True, r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])", 0, 40),
    ("endpoint", "endpoint", True, r"[a-z][a-z0-9+]{0,30}://[A-Za-z0-9._~:@%-]+[^\x20\x09-\x0D\"'<>]*", 0, 8),
)
NAMES = [k[0] for k in KINDS]
BASE = ("assign", "access", "hex")
SCOPE = 200

#: What a text must hold for a pattern to be tried.
_HINT = {
    "assign": r"(?i:passw|secret|token|api_?key)",
    "access": "AKIA",
    "account": r"(?i:access_?key|client_?id|account_?id|user_?name|login)",
    "endpoint": "://",
}


def _lengths(text: Column, pattern: str, group: int) -> Column:
    """For each leftmost non-overlapping match: the gap before it, its length, and the length of the group."""
    p = F.lit(pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    groups = F.regexp_extract_all(text, p, F.lit(group)) if group else found
    return F.transform(
        F.arrays_zip(found.alias("m"), groups.alias("g"), F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("b")),
        lambda x: F.struct(F.char_length(x["b"]).alias("gap"), F.char_length(x["m"]).alias("len"), F.char_length(x["g"]).alias("glen")),
    )


def _numbered(kind: int):
    return lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["len"].alias("len"), x["glen"].alias("glen"))


def _parts(text: Column) -> Column:
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,glen:int>>")
    every = []
    for k, (name, _, _, pattern, group, _) in enumerate(KINDS):
        hint = _HINT.get(name)
        sure = text.rlike(pattern) if hint is None else (text.contains(hint) if "(" not in hint else text.rlike(hint)) & text.rlike(pattern)
        every.append(F.when(sure, F.transform(_lengths(text, pattern, group), _numbered(k))).otherwise(none))
    return F.concat(*every)


def _role(weak: bool | None = None) -> dict[str, list[int]]:
    roles: dict[str, list[int]] = {"identifier": [], "secret": [], "endpoint": []}
    for k, x in enumerate(KINDS):
        if weak is None or x[2] == weak:
            roles[x[1]].append(k)
    return roles


def found_spans(rows: DataFrame) -> DataFrame:
    """row, kind (a number), start, end of every match that is long enough; rows: row and parts."""
    every = rows.select("row", F.explode("parts").alias("p")).select("row", "p.*")
    run = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(run.rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    least = F.element_at(F.lit([k[5] for k in KINDS]), F.col("kind") + 1)
    return every.withColumn("end", end).where(F.col("glen") >= least).select("row", "kind", (F.col("end") - F.col("len")).alias("start"), "end")


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The strong spans, and the weak ones whose complementary parts stand in their scope."""
    weak_kinds = [k for k, x in enumerate(KINDS) if x[2]]
    weak = F.col("kind").isin(weak_kinds)
    roles = _role()
    cells = lambda a, b: F.explode(F.sequence(F.floor(a / scope), F.floor(b / scope)))
    near = spans.where(weak).select("row", "kind", "start", "end", cells(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope).alias("cell"))
    other = spans.select(F.col("row").alias("row2"), F.col("kind").alias("kind2"), F.col("start").alias("start2"), F.col("end").alias("end2"), cells(F.col("start"), F.col("end")).alias("cell2"))
    met = near.join(
        other,
        (F.col("row") == F.col("row2"))
        & (F.col("cell") == F.col("cell2"))
        & (F.col("start2") - F.col("end") <= scope)
        & (F.col("start") - F.col("end2") <= scope)
        & ((F.col("kind") != F.col("kind2")) | (F.col("start") != F.col("start2"))),
    )
    over = (F.col("start2") < F.col("end")) & (F.col("start") < F.col("end2")) & ~F.col("kind2").isin(weak_kinds)
    has = {r: F.bool_or(F.col("kind2").isin(ks) & ~over) for r, ks in roles.items()}
    seen = met.groupBy("row", "kind", "start", "end").agg(F.bool_or(over).alias("over"), *(x.alias(r) for r, x in has.items()))
    role = {r: F.col("kind").isin(ks) for r, ks in roles.items()}
    complete = (
        (role["secret"] & (F.col("identifier") | F.col("endpoint")))
        | (role["identifier"] & F.col("secret"))
        | (role["endpoint"] & F.col("identifier") & F.col("secret"))
    )
    return spans.where(~weak).union(seen.where(complete & ~F.col("over")).select("row", "kind", "start", "end"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row for each row of docs: row (a number of its own), doc_id and spans.

    spans is an array of (start, kind, end) by start, kinds as numbered in KINDS.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _parts(whole_text(text_col)).alias("parts"))
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()))
    reported = linked(saved(found_spans(rows.where(F.size("parts") > 0))), scope)
    by_row = reported.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.drop("parts").join(by_row, "row", "left").withColumn("spans", F.coalesce("spans", none))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the strong kinds and the two digests of spans."""
    name = lambda x: F.element_at(F.lit(NAMES), x["kind"] + 1)
    said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    strong = F.filter("spans", lambda x: x["kind"] < len(BASE))
    return scanned.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(said(strong), 256).alias("base_sha256"), said(F.col("spans")).alias("spans")
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """docs with every reported span of the text replaced by a mark; spans that overlap share one mark.

    Rows without any part pass as they are. Only the others are numbered, saved and joined with their spans, so texts
    are not shuffled for the few that change. A column n_chars, where there is one, is counted anew in the rows that
    change.
    """
    row, parts, cut, fresh = (f"__terravane_{x}" for x in ("row", "parts", "cuts", "text"))
    text = F.col(f"`{text_col}`")
    own = docs.withColumn(parts, _parts(whole_text(text_col)))
    clean = own.where(F.size(parts) == 0).drop(parts)
    hit = saved(own.where(F.size(parts) > 0).withColumn(row, F.monotonically_increasing_id()))
    reported = linked(saved(found_spans(hit.select(F.col(row).alias("row"), F.col(parts).alias("parts")))), scope)
    # Merge overlapping spans within a row: a new group begins where a span starts after all before it have ended.
    order = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = (
        reported.withColumn("new", F.when(before.isNull() | (F.col("start") >= before), 1).otherwise(0))
        .withColumn("g", F.sum("new").over(order))
        .groupBy("row", "g")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy(F.col("row").alias(row))
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(cut))
    )
    cuts = F.col(cut)

    def pieces(c: Column) -> Column:
        each = F.transform(c, lambda x, i: F.substring(text, F.coalesce(F.get(c, i - 1)["end"], F.lit(0)) + 1, x["start"] - F.coalesce(F.get(c, i - 1)["end"], F.lit(0))))
        return F.array_join(F.concat(each, F.array(F.substring(text, F.element_at(c, -1)["end"] + 1, F.lit(2147483647)))), mark)

    out = hit.join(merged, row, "left").withColumn(fresh, F.when(cuts.isNotNull(), let(cuts, pieces)).otherwise(text))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col(fresh).alias(c))
        elif c == "n_chars" and docs.schema[c].dataType.simpleString() in ("bigint", "int"):
            cols.append(F.when(cuts.isNotNull(), F.char_length(fresh).cast(docs.schema[c].dataType)).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return clean.union(out.select(*cols))
