"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Seeds are the matches of fixed patterns (e-mail, IP address, card, phone). A run of tokens
that hold a digit or @ is an instance; the words around it are its lexical patterns. Seeds
that overlap an instance label it. Then, in rounds over the pattern-instance graph:

* a pattern's confidence in a kind is the labelled share of its instances, where unlabelled
  instances that have the kind's form (a card number that fails the check digit, say) are
  what is looked for and do not count; unlabelled instances of other forms count against it;
* an unlabelled instance's score is one minus the product of its confident patterns'
  doubts; a high score labels it for the next round.

An unlabelled instance that ends with a high score is a new span wherever one of the
confident patterns of that kind surrounds it. Spans of the fixed patterns always stay.

Positions are code points. They come from the match list and the text between matches,
both found by one regular expression. The expressions below match what the fixed patterns
match, written with possessive repeats and look-behinds so that no input takes quadratic
time or deep recursion.

Each text is read once; what is kept is the spans and instances, a narrow table in the
shared checkpoint folder. The graph is narrow too and aggregated before it is shuffled.

Edge cases: null and empty texts have no spans; rows that repeat an id and text get the
same spans each; rows that repeat an id with other texts are told apart by a hash of the
text; other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import fresh, stable, text_or_empty

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Tokens with a digit or @, one space apart.
INSTANCE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: [^\s0-9@]*+[0-9@]\S*+)*+"
#: What an unlabelled instance must hold to have the form of a kind: the fixed patterns without
#: their checks, and with the lengths that cards (13 to 19 digits) and phones (7 to 15) have.
FORMS = {
    "email": "@",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[ -]?+[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9])[0-9](?:[ ().-]{0,3}+[0-9]){6,14}(?![0-9])",
}
#: Characters beside an instance in which its context words are looked for.
CONTEXT = 64
ROUNDS = 3
CONFIDENCE = 0.8
SUPPORT = 3
SCORE = 0.9

SPAN = "struct<start:int,end:int,value:string>"


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        def small(part):
            bare = F.ltrim(part, F.lit("0"))
            return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), small)
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _located(text: Column, pattern: str) -> Column:
    """Array of (start, end, value, before, after) of all matches, left to right."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    steps = F.transform(matches, lambda m, i: F.struct(
        m.alias("value"), F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("size"),
        F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")

    def put(acc, m):
        start = acc["at"] + m["gap"]
        end = start + m["size"]
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), m["value"].alias("value"), m["before"].alias("before"),
            m["after"].alias("after")))).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), empty.alias("out")), put, lambda acc: acc["out"])).otherwise(empty)


def _needs(kind: str, text: Column) -> Column:
    """A cheap condition without which the kind cannot occur."""
    return {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, F.lit(True))


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end), kinds in the listed order, then by start."""
    def of(kind):
        spans = F.filter(_located(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
        named = F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"),
                                                      s["end"].alias("end")))
        return F.when(_needs(kind, text), named).otherwise(
            F.array().cast("array<struct<kind:string,start:int,end:int>>"))
    return F.concat(*map(of, KINDS))


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def _extract(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: id, text hash, base spans, instances."""
    text = text_or_empty(text_col)
    return stable(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
                              base_spans(text).alias("base"), _located(text, INSTANCE).alias("instances")))


def _occurrences(rows: DataFrame) -> DataFrame:
    """One row per instance occurrence: place, trimmed value, seed kind, lexical patterns."""
    each = rows.select("id", "text_hash", "base", F.explode("instances").alias("m"))
    lead = F.length(F.regexp_extract("m.value", r"^[^A-Za-z0-9+(@]*+", 0))
    value = F.regexp_replace(F.regexp_replace("m.value", r"^[^A-Za-z0-9+(@]++", ""), r"[^A-Za-z0-9]++$", "")
    seed = F.get(F.filter("base", lambda s: (s["start"] < F.col("m.end")) & (s["end"] > F.col("m.start"))), F.lit(0))
    left = F.lower(F.regexp_extract("m.before", r"(\S++)\s*+$", 1))
    right = F.lower(F.regexp_extract("m.after", r"^\s*+(\S++)", 1))
    patterns = F.array_compact(F.array(F.when(left != "", F.concat(F.lit("l "), left)),
                                       F.when(right != "", F.concat(F.lit("r "), right)),
                                       F.when((left != "") & (right != ""), F.concat_ws(" ", F.lit("b"), left, right))))
    return each.select("id", "text_hash", (F.col("m.start") + lead).alias("start"), value.alias("value"),
                       seed["kind"].alias("seed"), patterns.alias("patterns")).where("value <> ''") \
        .withColumn("end", F.col("start") + F.length("value"))


def _discover(occurrences: DataFrame, rounds: int, confidence: float, support: float, score: float) \
        -> tuple[DataFrame, DataFrame]:
    """(value, kind) of the unseen identifiers, (pattern, kind) of the confident patterns."""
    edges = stable(occurrences.select("value", F.explode("patterns").alias("pattern")).distinct())
    seeds = stable(occurrences.where("seed is not null").groupBy("value").agg(F.min("seed").alias("kind"))
                   .withColumn("score", F.lit(1.0)))
    known = seeds
    for _ in range(rounds):
        marked = edges.join(known, "value", "left").groupBy("pattern").agg(
            F.count(F.lit(1)).alias("instances"), *(agg for k in KINDS for agg in (
                F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(f"weight_{k}"),
                F.count_if((F.col("kind") == k) | (F.col("kind").isNull() & F.col("value").rlike(FORMS[k])))
                .alias(f"own_{k}"))))
        # An instance of the kind counts by its score, an open one not at all, any other as one.
        each = marked.select("pattern", F.explode(F.array(*(
            F.struct(F.lit(k).alias("kind"), F.col(f"weight_{k}").alias("weight"),
                     (F.col("instances") - F.col(f"own_{k}")).alias("others")) for k in KINDS))).alias("k")) \
            .select("pattern", "k.*")
        sure = stable(each.where(F.col("weight") >= support)
                      .withColumn("confidence", F.col("weight") / (F.col("weight") + F.col("others") + 1.0))
                      .where(F.col("confidence") >= confidence).select("pattern", "kind", "confidence"))
        doubts = edges.join(sure, "pattern").join(seeds.select("value"), "value", "left_anti") \
            .groupBy("value", "kind").agg(F.sum(F.log(1 - F.col("confidence"))).alias("doubt"))
        found = stable(doubts.withColumn("score", 1 - F.exp("doubt")).where(F.col("score") >= score)
                       .groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"),
                                             F.max("score").alias("score")))
        known = seeds.unionByName(found)
    return found.select("value", "kind"), sure.select("pattern", "kind")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
         confidence: float = CONFIDENCE, support: float = SUPPORT, score: float = SCORE) -> DataFrame:
    """One row per input row: ``id``, ``text_hash``, ``base`` and ``spans`` (arrays of
    (kind, start, end) in kind order, then by start; ``spans`` holds ``base`` and what the
    method adds)."""
    rows = _extract(docs, id_col, text_col)
    occurrences = stable(_occurrences(rows))
    unseen, sure = _discover(occurrences, rounds, confidence, support, score)
    added = occurrences.where("seed is null").join(unseen, "value") \
        .withColumn("pattern", F.explode("patterns")).join(sure, ["pattern", "kind"]) \
        .groupBy("id", "text_hash").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    added = added.withColumnsRenamed({"id": "added_id", "text_hash": "added_hash"})
    both = rows.join(added, rows.id.eqNullSafe(added.added_id) & (rows.text_hash == added.added_hash), "left")
    new = F.coalesce("added", F.array().cast("array<struct<kind:string,start:int,end:int>>"))
    ranked = F.transform(F.concat("base", new), lambda s: F.struct(
        F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("rank"), s["start"].alias("start"),
        s["end"].alias("end"), s["kind"].alias("kind")))
    ordered = F.transform(F.array_sort(F.array_distinct(ranked)), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return both.select("id", "text_hash", "base", ordered.alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
           **settings) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets (overlapping spans by
    the first one's) and ``chars_col`` brought up to date. Texts without spans stay as they are."""
    found = find(docs, id_col, text_col, **settings).where(F.size("spans") > 0) \
        .dropDuplicates(["id", "text_hash"]).select(
            F.col("id").alias(fresh(docs, "pii_id")), F.col("text_hash").alias(fresh(docs, "pii_hash")),
            F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                               s["kind"].alias("kind")))).alias(fresh(docs, "pii_spans")))
    pid, phash, spans = found.columns
    text = text_or_empty(docs[text_col])
    both = docs.join(found, docs[id_col].eqNullSafe(found[pid]) & (F.xxhash64(text) == found[phash]), "left")

    def merge(acc, s):
        last = F.get(acc, F.size(acc) - 1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
                         last["kind"].alias("kind"))
        return F.when((F.size(acc) > 0) & (s["start"] < last["end"]),
                      F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))) \
            .otherwise(F.concat(acc, F.array(s)))

    merged = F.aggregate(spans, F.array().cast("array<struct<start:int,end:int,kind:string>>"), merge)
    place = fresh(docs, "pii_merged")
    both = both.withColumn(place, merged)

    def piece(s, i):
        since = F.when(i == 0, 0).otherwise(F.get(F.col(place), i - 1)["end"])
        return F.concat(F.substring(text, since + 1, s["start"] - since), F.lit("<"), F.upper(s["kind"]), F.lit(">"))

    last = F.get(F.col(place), F.size(place) - 1)["end"]
    clean = F.concat(F.array_join(F.transform(place, piece), ""), F.substring(text, last + 1, F.length(text)))
    new_text = F.when(F.size(F.col(place)) > 0, clean).otherwise(docs[text_col])
    new = {c: docs[c] for c in docs.columns}
    new[text_col] = new_text
    if chars_col in docs.columns:
        new[chars_col] = F.when(F.size(F.col(place)) > 0, F.length(clean)).otherwise(docs[chars_col]) \
            .cast(docs.schema[chars_col].dataType)
    return both.select(*(c.alias(n) for n, c in new.items()))
