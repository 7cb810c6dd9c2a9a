"""Secrets in whole texts, with parts of split credentials linked within scopes.

Strong kinds (``assign``, ``access``, ``hex``) count on their own. Weak parts, such as
an account name, a long mixed token or an endpoint, count only when a part that
completes them lies within the same scope, that is with at most ``scope`` code points
between the end of one and the start of the other in the same text:

    an identifier is completed by a secret, an endpoint by a secret,
    a secret by an identifier or an endpoint.

Every match of every pattern becomes a row (text key, kind, gap, length); running sums
turn gaps into code point positions. In the interval join a part stands in all bins of
``scope`` code points that it touches, and a weak part looks in all bins that it reaches
with ``scope`` added on both sides. Of the parts of a role that touch a bin only the first
start and the last end are needed, so bins are reduced to those before the join: a text
costs a row for each bin a part touches or reaches, not all pairs.

All of it is DataFrame functions. Defined results: a NULL text counts as empty and
has no spans; repeated rows get equal results; an empty table gives an empty one;
other columns are left alone. Spans of different kinds may overlap; a weak part
inside a strong span is not reported again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import free_name, join_copies, written

SCOPE = 200  # code points

# Fixed values of the contract; group 2 of an assignment must have 6 characters.
BASE = {
    "assign": "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
              "([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "(?<![0-9a-f])[0-9a-f]{24,}",
}
# Weak parts and their roles.
WEAK = {
    "account": "(?i:user(?:name)?|login|client_id|access_key_id|account)[\"']?\\x20*[:=]\\x20*"
               "[\"']?[A-Za-z0-9@._-]{3,}",
    "opaque": "(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}={0,2}",
    "endpoint": "(?i:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp)://"
                "[^\\x20\\x09-\\x0D\"'<>]+",
}
KINDS = [*BASE, *WEAK]
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "account": "id",
         "opaque": "secret", "endpoint": "endpoint"}
COMPLETED_BY = {"id": ["secret"], "endpoint": ["secret"], "secret": ["id", "endpoint"]}


def _matches(text: Column, kind: str) -> Column:
    """The matches in order: what lies between a match and the one before, its length,
    and whether it passes the kind's own check."""
    pattern = F.lit({**BASE, **WEAK}[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, {**BASE, **WEAK}[kind], -1)
    if kind == "assign":
        checked = F.transform(
            F.regexp_extract_all(text, pattern, F.lit(2)), lambda value: F.length(value) >= 6
        )
    elif kind == "opaque":
        checked = F.transform(
            found, lambda x: x.rlike("[0-9]") & x.rlike("[a-z]") & x.rlike("[A-Z]")
        )
    else:
        checked = F.transform(found, lambda x: F.lit(True))
    rows = F.transform(
        F.arrays_zip(found.alias("found"), checked.alias("ok"), between.alias("between")),
        lambda x: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), F.length(x["between"]).alias("gap"),
            F.length(x["found"]).alias("len"), x["ok"].alias("ok"),
        ),
    )
    # The text after the last match stands in the last row and has no match.
    return F.when(F.size(found) > 0, F.filter(rows, lambda x: x["len"].isNotNull())).otherwise(
        F.array().cast("array<struct<kind:int,gap:int,len:int,ok:boolean>>")
    )


def parts(scanned: DataFrame) -> DataFrame:
    """``key, kind, start, end`` of all checked matches of ``key, found``."""
    so_far = Window.partitionBy("key", "kind").orderBy("i")
    return (
        scanned.where(F.size("found") > 0)
        .dropDuplicates(["key"])
        .select("key", F.posexplode("found").alias("i", "m"))
        .select("key", "i", "m.*")
        .withColumn("end", F.sum(F.col("gap") + F.col("len")).over(so_far))
        .where("ok")
        .select("key", "kind", (F.col("end") - F.col("len")).alias("start"), "end")
    )


def _text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*(F.lit(ROLES[k]) for k in KINDS)), kind + 1)


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak rows of ``parts`` that a part of a completing role lies next to."""
    placed = found.withColumn("role", _role(F.col("kind")))

    def bins_of(start: Column, end: Column) -> Column:
        return F.sequence(F.floor(start / scope), F.floor(end / scope))

    # Every bin knows how far the parts that touch it reach to either side.
    bins = placed.withColumn("bin", F.explode(bins_of(F.col("start"), F.col("end")))).groupBy(
        "key", "role", "bin"
    ).agg(F.min("start").alias("first"), F.max("end").alias("last"))
    needs = F.when(F.col("role") == "secret", F.array(*map(F.lit, COMPLETED_BY["secret"])))
    needs = needs.otherwise(F.array(*map(F.lit, COMPLETED_BY["id"])))
    weak = (
        placed.where(F.col("kind") >= len(BASE))
        .withColumns({"low": F.col("start") - scope, "high": F.col("end") + scope})
        .withColumn("need", F.explode(needs))
        .withColumn("near", F.explode(bins_of(F.col("low"), F.col("high"))))
    )
    # A part that touches a bin between the first and the last is within the scope; in the first
    # bin it has to end late enough, in the last one to start early enough.
    joined = weak.join(
        bins.select(F.col("key"), F.col("role").alias("need"), F.col("bin").alias("near"),
                    "first", "last"),
        ["key", "need", "near"],
    ).where(
        F.when(F.col("near") == F.floor(F.col("low") / scope), F.col("last") >= F.col("low"))
        .when(F.col("near") == F.floor(F.col("high") / scope), F.col("first") <= F.col("high"))
        .otherwise(True)
    )
    return joined.select("key", "kind", "start", "end").distinct()


def _uncovered(weak: DataFrame, strong: DataFrame) -> DataFrame:
    """Weak spans that no strong span contains: the furthest strong end up to their start."""
    both = strong.select("key", "kind", "start", "end", F.lit(0).alias("weak")).union(
        weak.select("key", "kind", "start", "end", F.lit(1).alias("weak"))
    )
    before = Window.partitionBy("key").orderBy("start", "weak").rowsBetween(
        Window.unboundedPreceding, 0
    )
    reach = F.max(F.when(F.col("weak") == 0, F.col("end"))).over(before)
    return both.withColumn("reach", F.coalesce(reach, F.lit(-1))).where(
        "weak = 1 AND end > reach"
    ).select("key", "kind", "start", "end")


def scan(docs: DataFrame, keep: list[str], scope: int = SCOPE) -> tuple[DataFrame, DataFrame]:
    """A row per document (``keep`` and its text key) and the spans by text key.

    Spans are ``key, kind, start, end``: kind is a place in ``KINDS``, code points, end
    exclusive. Equal texts share a key, so a text is resolved once.
    """
    text = F.coalesce("text", F.lit(""))
    found = F.concat(*(_matches(text, k) for k in KINDS))
    scanned = written(
        docs.select(*keep, _text_key(text).alias("key"), found.alias("found")),
        "secret-scan",
    )
    all_parts = written(parts(scanned), "secret-parts")
    strong = all_parts.where(F.col("kind") < len(BASE))
    return scanned.select(*keep, "key"), strong.union(
        _uncovered(linked(all_parts, scope), strong)
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document the counts of strong kinds and the digest of its spans."""
    rows, spans = scan(docs, ["doc_id"])
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(items, lambda x: x["text"]), ",")

    found = (
        spans.select("key", F.struct(
            "start", "kind", F.concat_ws(":", name, "start", "end").alias("text")
        ).alias("span"))
        .groupBy("key").agg(F.array_sort(F.collect_list("span")).alias("all"))
    )
    both = join_copies(rows, found, "key").withColumn(
        "all", F.coalesce("all", F.array().cast("array<struct<start:bigint,kind:int,text:string>>"))
    ).withColumn("base", F.filter("all", lambda x: x["kind"] < len(BASE)))
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint")

    return both.select(
        "doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(BASE)),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("all")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """The documents with every span's text replaced, overlapping spans as one.

    ``n_chars`` is counted anew where the text has changed; other columns stay.
    """
    _, spans = scan(docs, [], scope)
    key, cuts, new_text = (free_name(docs, name) for name in ("key", "cuts", "text"))
    before = Window.partitionBy("key").orderBy("start", "end")
    merged = (
        spans.withColumn("reach", F.max("end").over(
            before.rowsBetween(Window.unboundedPreceding, -1)
        ))
        .withColumn("new", F.when(F.col("start") < F.col("reach"), 0).otherwise(1))
        .withColumn("island", F.sum("new").over(
            before.rowsBetween(Window.unboundedPreceding, 0)
        ))
        .groupBy("key", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(cuts))
        .withColumnRenamed("key", key)
    )
    text = F.coalesce("text", F.lit(""))
    pieces = F.concat(
        F.transform(cuts, lambda x, i: F.substring(
            F.col("text"),
            F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0)) + 1,
            x["start"] - F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0)),
        )),
        F.array(F.substring(
            F.col("text"), F.element_at(cuts, -1)["end"] + 1, F.length("text")
        )),
    )
    joined = join_copies(docs.withColumn(key, _text_key(text)), merged, key)
    out = joined.withColumn(new_text, F.when(F.col(cuts).isNull(), F.col("text")).otherwise(
        F.array_join(pieces, mark)
    ))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col(cuts).isNull(), F.col("n_chars")
        ).otherwise(F.length(new_text).cast(docs.schema["n_chars"].dataType)))
    return out.withColumn("text", F.col(new_text)).select(*docs.columns)
