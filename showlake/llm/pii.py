"""Personal data by bootstrapped contextual extraction, in DataFrame functions alone.

Patterns for e-mail addresses, IP addresses, card and phone numbers give the
base spans, which are also the seeds.  The words to the left of seeds are
lexical patterns; a graph of patterns and the identifier-like tokens that they
introduce is scored in rounds, and patterns of high confidence discover tokens
that no base pattern knows.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count as count_up

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showlake.llm.common import join_groups, stored

KINDS = ["email", "ip", "card", "phone"]
#: Possessive and anchored forms of the base patterns: the same leftmost matches, found in linear time without recursion.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must contain for a pattern to be tried on it.
CUES = {"email": "@", "phone": "+"}
#: Tokens that may be identifiers; quotes and punctuation at their ends are cut off.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
LEADING, TRAILING = r"^[\"'(<\[{]+", r"[\"')>\]},.;:!?]+$"
#: Distinct known instances and confidence that a pattern needs, and score that an instance needs.
SUPPORT, CONFIDENCE, BELIEF = 3, 0.7, 0.7
#: Words of left context, and characters in which they are looked for first.
WORDS, CONTEXT = 2, 64
STEP = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def running(steps: Column) -> Column:
    """Running sums of an array of longs, built in runs of ``STEP`` so that long arrays are not copied for each element."""
    none = F.array().cast("array<long>")
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

    def add(acc: Column, x: Column) -> Column:
        at = acc["at"] + x
        return F.struct(at.alias("at"), F.array_append(acc["out"], at).alias("out"))

    def extend(acc: Column, run: Column, all_steps: Column) -> Column:
        begin = F.struct(acc["at"].alias("at"), none.alias("out"))
        part = F.aggregate(F.slice(all_steps, run * STEP + 1, F.lit(STEP)), begin, add)
        return let(part, lambda p: F.struct(p["at"].alias("at"), F.concat(acc["out"], p["out"]).alias("out")))

    def whole(all_steps: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(all_steps) - 1) / STEP).cast("int"))
        return F.aggregate(runs, start, lambda acc, run: extend(acc, run, all_steps))["out"]

    return let(steps, lambda s: F.when(F.size(s) > 0, whole(s)).otherwise(none))


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, value, before>>: leftmost matches, their first code point and the text since the last one."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.struct(found.alias("found"), F.split(text, pattern, -1).alias("between"))

    def placed(p: Column) -> Column:
        def step(value: Column, i: Column) -> Column:
            last = F.when(i > 0, F.length(F.get(p["found"], i - 1))).otherwise(0)
            return (F.length(F.get(p["between"], i)) + last).cast("long")

        starts = running(F.transform(p["found"], step))

        def one(value: Column, i: Column, at: Column) -> Column:
            return F.struct(F.get(at, i).alias("start"), value.alias("value"), F.get(p["between"], i).alias("before"))

        return let(starts, lambda at: F.transform(p["found"], lambda v, i: one(v, i, at)))

    return let(both, placed)


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(10, 15) if kind == "phone" else F.lit(True)


SPAN = "array<struct<start:long,kind:int,end:long,value:string>>"


def base_spans(text: Column) -> Column:
    """Base spans of all kinds by start, then kind."""

    def of_kind(number: int, kind: str) -> Column:
        found = F.filter(located(text, PATTERNS[kind]), lambda m: valid(kind, m["value"]))
        spans = F.transform(
            found,
            lambda m: F.struct(
                m["start"].alias("start"),
                F.lit(number).alias("kind"),
                (m["start"] + F.length(m["value"])).alias("end"),
                m["value"].alias("value"),
            ),
        )
        tried = F.contains(text, F.lit(CUES[kind])) if kind in CUES else text.rlike("[0-9]")
        return F.when(tried, spans).otherwise(F.array().cast(SPAN))

    return F.sort_array(F.concat(*(of_kind(n, kind) for n, kind in enumerate(KINDS))))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def token_spans(text: Column) -> Column:
    """array<struct<start, end, value, left>> of identifier-like tokens; ``left`` is the pattern: the words before one."""

    def one(m: Column) -> Column:
        lead = F.length(F.regexp_extract(m["value"], LEADING, 0))
        value = F.regexp_replace(F.regexp_replace(m["value"], LEADING, ""), TRAILING, "")
        near = words(F.right(m["before"], F.lit(CONTEXT)))
        # With more than WORDS words in sight the last ones are whole; else the first may be cut, and all is read.
        cut = F.length(m["before"]) > CONTEXT
        before = let(near, lambda w: F.when(cut & (F.size(w) <= WORDS), words(m["before"])).otherwise(w))
        return F.struct(
            (m["start"] + lead).alias("start"),
            (m["start"] + lead + F.length(value)).alias("end"),
            F.lower(value).alias("value"),
            let(before, lambda w: F.array_join(F.slice(w, F.greatest(F.size(w) - WORDS, F.lit(0)) + 1, F.lit(WORDS)), " ")).alias("left"),
        )

    spans = F.transform(located(text, TOKEN), one)
    return F.when(text.rlike("[0-9@]"), F.filter(spans, lambda s: s["value"] != "")).otherwise(
        F.array().cast("array<struct<start:long,end:long,value:string,left:string>>")
    )


def mentions(scanned: DataFrame) -> DataFrame:
    """(doc_id, h, start, end, value, left, kind): tokens outside base spans (kind null) and base spans, with their context.

    A base span takes the context of the token in which it begins.
    """
    key = ["doc_id", "h"]
    tokens = scanned.select(*key, F.explode("tokens").alias("t")).select(
        *key, "t.start", F.lit(1).alias("order"), "t.end", "t.value", "t.left", F.lit(None).cast("int").alias("kind")
    )
    spans = scanned.select(*key, F.explode("base").alias("b")).select(
        *key, "b.start", F.lit(0).alias("order"), "b.end", F.lower("b.value").alias("value"), F.lit("").alias("left"), "b.kind"
    )
    one = Window.partitionBy(*key)
    before = one.orderBy("start", "order", "end").rowsBetween(Window.unboundedPreceding, 0)
    after = one.orderBy("start", "order", "end").rowsBetween(1, Window.unboundedFollowing)
    rows = tokens.unionByName(spans).distinct().withColumn(
        "covered", F.max(F.when(F.col("kind").isNotNull(), F.col("end"))).over(before)
    )
    rows = rows.withColumn("next_base", F.first(F.when(F.col("kind").isNotNull(), F.col("start")), True).over(after))
    rows = rows.withColumn("around", F.last(F.when(F.col("kind").isNull(), F.struct("start", "end", "left")), True).over(before))
    rows = rows.withColumn("same", F.first(F.when(F.col("kind").isNull(), F.struct("start", "left")), True).over(after))
    inside = (F.col("covered") > F.col("start")) | (F.col("next_base") < F.col("end"))
    context = F.when(F.col("same.start") == F.col("start"), F.col("same.left")).when(
        F.col("around.end") > F.col("start"), F.col("around.left")
    )
    rows = rows.filter(F.col("kind").isNotNull() | ~F.coalesce(inside, F.lit(False)))
    left = F.when(F.col("kind").isNull(), F.col("left")).otherwise(F.coalesce(context, F.lit("")))
    return rows.select(*key, "start", "end", "value", left.alias("left"), "kind")


def confident_patterns(found: DataFrame, rounds: int | None, support: int, confidence: float, belief: float) -> DataFrame:
    """(left, kind, confidence, mentions) of the patterns that the scoring of the graph accepts, the best kind of each.

    A pattern's confidence is the belief in its distinct instances over their
    number plus one; an instance's belief is 1 for seeds and else one minus the
    product of its accepted patterns' doubts.  Instances that reach ``belief``
    count as known in the next round; the rounds end when none is new, or after
    ``rounds``.  What is known only grows, so there is such an end.
    """
    graph = stored(found.filter("left != ''").groupBy("left", "value").agg(F.count("*").alias("n"), F.min("kind").alias("kind")), "pii-graph")
    sizes = graph.groupBy("left").agg(F.count("*").alias("values"), F.sum("n").alias("mentions"))
    sizes = stored(sizes.filter(F.col("values") >= support), "pii-patterns")
    edges = stored(graph.join(sizes.select("left"), "left").select("left", "value"), "pii-edges")
    seeds = found.filter("kind is not null").select("value", "kind", F.lit(1.0).alias("belief")).distinct()
    known, count, accepted = stored(seeds, "pii-known"), None, None
    for _ in count_up() if rounds is None else range(rounds):
        now = known.count()
        if now == count:
            break
        count = now
        scored = edges.join(known, "value").groupBy("left", "kind").agg(
            F.sum("belief").alias("sum"), F.count("*").alias("support")
        )
        scored = scored.join(sizes, "left").withColumn("confidence", F.col("sum") / (F.col("values") + 1))
        accepted = stored(
            scored.filter((F.col("support") >= support) & (F.col("confidence") >= confidence)).select(
                "left", "kind", "confidence", "mentions"
            ),
            "pii-accepted",
        )
        doubts = F.sum(F.log1p(-F.col("confidence")))
        fresh = edges.join(accepted, "left").groupBy("value", "kind").agg((1 - F.exp(doubts)).alias("belief"))
        known = seeds.unionByName(fresh.filter(F.col("belief") >= belief)).groupBy("value", "kind")
        known = stored(known.agg(F.max("belief").alias("belief")), "pii-known")
    best = F.max(F.struct("confidence", (-F.col("kind")).alias("order"), "kind", "mentions")).alias("b")
    return stored(accepted.groupBy("left").agg(best).select("left", "b.kind", "b.confidence", "b.mentions"), "pii-best")


def find_personal_data(
    documents: DataFrame,
    rounds: int | None = None,
    support: int = SUPPORT,
    confidence: float = CONFIDENCE,
    belief: float = BELIEF,
) -> DataFrame:
    """``doc_id, base, added`` of every whole text, one row per row.

    Both are arrays of (start, kind, end, value) by start, in code points with
    the end excluded; ``kind`` is a place in ``KINDS``.  ``added`` holds the
    discovered tokens, which never touch base spans.  A null text counts as
    empty.  Columns beyond doc_id and text are ignored.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scanned = texts.select(
        "doc_id", F.xxhash64("text").alias("h"), base_spans(F.col("text")).alias("base"), token_spans(F.col("text")).alias("tokens")
    )
    scanned = stored(scanned, "pii-scanned")
    found = stored(mentions(scanned), "pii-mentions")
    patterns = confident_patterns(found, rounds, support, confidence, belief)
    fresh = join_groups(
        found.filter("kind is null").drop("kind"), patterns, ["left"], "mentions"
    ).select("doc_id", "h", F.struct("start", "kind", "end", "value").alias("span"))
    added = fresh.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list("span")).alias("added"))
    added = added.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "added")
    same = scanned["doc_id"].eqNullSafe(added["_id"]) & (scanned["h"] == added["_h"])
    both = scanned.join(added, same, "left")
    return both.select("doc_id", "base", F.coalesce("added", F.array().cast(SPAN)).alias("added"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def report(found: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``: base counts, digest of base spans, all spans."""

    def count(n: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")

    return found.select(
        "doc_id",
        *(count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.sort_array(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
