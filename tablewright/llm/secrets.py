"""Secret scans with multipart credential linking.

Strong patterns report on their own. Access identifiers, secrets and endpoints
that are too weak to report alone are interval-joined within a scope, and
reported only where the parts complement each other. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import join_keyed, row_key, scanned, staged

# Fixed patterns of the base kinds; least lengths stand beside them.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# A maximal run of at least 24 is what filtering all runs by length leaves, and is found faster.
HEX_LONG = r"[0-9a-f]{24,}"
ACCESS_LONG = r"AKIA[A-Z0-9]{16,}"

# Parts that count only together.
IDENT = (
    r"(?i:access_?key(?:_?id)?|client_?id|user(?:_?name)?|login|account)"
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
)
BLOB = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/=_-])"
ENDPOINT = (
    r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\s"'<>]+"""
    r"|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{1,5})?(?![0-9.])"
)

KINDS = ("assign", "access", "hex", "ident", "blob", "endpoint")
SPAN = "struct<start:long,kind:int,end:long>"
PART = f"array<{SPAN}>"


def spans_of(text: str, pattern: str, kind: str, keep=None, needs: str = "") -> Column:
    """All matches of ``pattern``, leftmost and non-overlapping, as spans in code
    points: lengths of the pieces between the matches and of the matches add up
    to places. ``keep`` sees the first group of each. ``needs`` is a plain
    pattern that texts with a match hold, and that is found faster."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    group = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if keep else whole
    number = F.lit(KINDS.index(kind))

    def add(at: Column, m: Column) -> Column:
        start = at + F.char_length(m["gaps"])
        end = start + F.char_length(m["whole"])
        span = F.struct(start.cast("long").alias("start"), number.alias("kind"), end.cast("long").alias("end"))
        ok = keep(m["group"]) if keep else F.lit(True)
        return F.struct(end.alias("state"), F.when(m["whole"].isNotNull() & ok, span).alias("out"))

    zipped = F.arrays_zip(gaps.alias("gaps"), whole.alias("whole"), group.alias("group"))
    listed = scanned(F.slice(zipped, F.lit(1), F.size(whole)), F.lit(0), add, SPAN)
    listed = F.filter(listed, lambda s: s.isNotNull())
    here = F.col(text).rlike(needs) & F.col(text).rlike(pattern) if needs else F.col(text).rlike(pattern)
    return F.when(here, listed).otherwise(F.array().cast(PART))


def apart(weak: Column, strong: Column) -> Column:
    """The spans of ``weak`` that overlap none of ``strong``. Both are walked
    together in order, once to each side: a span overlaps one that starts before
    it if that reaches it, and one that starts behind it if that starts in it."""
    item = "struct<span:struct<start:long,kind:int,end:long>,strong:boolean,hit:boolean>"
    marked = lambda spans, is_strong: F.transform(
        spans, lambda s: F.struct(s.alias("span"), F.lit(is_strong).alias("strong"), F.lit(False).alias("hit"))
    )
    far = F.lit((1 << 62)).cast("long")

    def from_left(reach: Column, x: Column) -> Column:
        hit = x["hit"] | (~x["strong"] & (reach > x["span"]["start"]))
        new = F.when(x["strong"], F.greatest(reach, x["span"]["end"])).otherwise(reach)
        return F.struct(new.alias("state"), F.struct(x["span"].alias("span"), x["strong"].alias("strong"), hit.alias("hit")).alias("out"))

    def from_right(least: Column, x: Column) -> Column:
        hit = x["hit"] | (~x["strong"] & (least < x["span"]["end"]))
        new = F.when(x["strong"], F.least(least, x["span"]["start"])).otherwise(least)
        return F.struct(new.alias("state"), F.struct(x["span"].alias("span"), x["strong"].alias("strong"), hit.alias("hit")).alias("out"))

    in_order = F.array_sort(F.concat(marked(weak, False), marked(strong, True)))
    left = scanned(in_order, F.lit(-1).cast("long"), from_left, item)
    both = F.reverse(scanned(F.reverse(left), far, from_right, item))
    return F.transform(F.filter(both, lambda x: ~x["strong"] & ~x["hit"]), lambda x: x["span"])


def as_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def linked(parts: DataFrame, scope: int) -> DataFrame:
    """The weak parts that have complementary parts within ``scope`` code points.

    Both sides are cut into bins of ``scope`` and joined on text and bin, so a
    part meets only what lies near it: a bin holds at most ``scope`` starts.
    An identifier needs a secret, a blob needs an identifier or an endpoint, an
    endpoint needs an identifier and a secret.
    """
    role = (
        F.when(F.col("s.kind").isin(KINDS.index("access"), KINDS.index("ident")), "ident")
        .when(F.col("s.kind") == KINDS.index("endpoint"), "endpoint")
        .otherwise("secret")
    )
    near = parts.select("_id", "_th", "s", role.alias("role"))
    weak = near.where(F.col("s.kind") >= KINDS.index("ident")).select(
        "_id",
        "_th",
        F.col("s").alias("weak"),
        F.explode(F.sequence(F.expr(f"greatest(s.start - {scope}, 0) div {scope}"), F.expr(f"(s.end + {scope}) div {scope}"))).alias("bin"),
    )
    other = near.select(
        F.col("_id").alias("o_id"),
        F.col("_th").alias("o_th"),
        F.col("s").alias("o"),
        "role",
        F.explode(F.sequence(F.expr(f"s.start div {scope}"), F.expr(f"(s.end - 1) div {scope}"))).alias("o_bin"),
    )
    met = weak.join(
        other,
        F.col("_id").eqNullSafe(F.col("o_id"))
        & (F.col("_th") == F.col("o_th"))
        & (F.col("bin") == F.col("o_bin"))
        & (F.col("o.start") < F.col("weak.end") + scope)
        & (F.col("o.end") > F.col("weak.start") - scope),
    )

    def has(name: str) -> Column:
        return F.coalesce(F.max((F.col("role") == name) & (F.col("o") != F.col("weak"))), F.lit(False)).alias(name)

    seen = met.groupBy("_id", "_th", "weak").agg(has("ident"), has("secret"), has("endpoint"))
    kind = F.col("weak.kind")
    enough = (
        F.when(kind == KINDS.index("ident"), F.col("secret"))
        .when(kind == KINDS.index("blob"), F.col("ident") | F.col("endpoint"))
        .otherwise(F.col("ident") & F.col("secret"))
    )
    return seen.where(enough).select("_id", "_th", "weak")


def scan_secrets(docs: DataFrame, *, scope: int = 200) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_assign``, ``n_access``,
    ``n_hex``, ``base_sha256`` (of the base spans), ``spans`` (base spans and the
    weak parts reported by linking) and ``n_linked``.

    Weak parts that overlap a base span are part of it and dropped. NULL texts
    count as empty and have no spans; texts are scanned whole, in time that grows
    with their length; rows that repeat id and text get the same answer; an empty
    table gives no rows; no other column is read.
    """
    text = docs.select(*row_key("doc_id", "text"), F.coalesce("text", F.lit("")).alias("t"))
    base = {
        "assign": spans_of("t", ASSIGN, "assign", lambda value: F.char_length(value) >= 6, "[:=]"),
        "access": spans_of("t", ACCESS_LONG, "access", needs="AKIA"),
        "hex": spans_of("t", HEX_LONG, "hex"),
    }
    mixed = lambda value: value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    weak = F.concat(
        spans_of("t", IDENT, "ident", needs="[:=]"),
        spans_of("t", f"({BLOB})", "blob", mixed),
        spans_of("t", ENDPOINT, "endpoint", needs="://|[0-9][.]"),
    )
    found = text.select("_id", "_th", *[c.alias(n) for n, c in base.items()], weak.alias("weak"))
    strong = F.concat("assign", "access", "hex")
    alone = F.when((F.size("weak") > 0) & (F.size("strong") > 0), apart(F.col("weak"), F.col("strong")))
    found = found.withColumn("strong", strong).withColumn("weak", F.coalesce(alone, F.col("weak")))
    spans = staged(found, "secret-spans")
    # a single part has nothing to be linked with
    several = spans.where((F.size("weak") > 0) & (F.size("weak") + F.size("strong") > 1))
    parts = several.select("_id", "_th", F.explode(F.concat("strong", "weak")).alias("s")).distinct()
    reported = linked(parts, scope).groupBy("_id", "_th").agg(F.collect_set("weak").alias("linked"))
    more = F.coalesce("linked", F.array().cast(PART))
    return join_keyed(spans, reported).select(
        F.col("_id").alias("doc_id"),
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.sha2(as_text(F.col("strong")), 256).alias("base_sha256"),
        as_text(F.concat("strong", more)).alias("spans"),
        F.size(more).cast("long").alias("n_linked"),
    )
