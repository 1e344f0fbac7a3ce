"""Personal data: fixed patterns, and bootstrapped contextual extraction of further identifiers.

Base entities are the leftmost non-overlapping matches of one pattern per kind, with the checks
below; matches that fail a check are dropped and not tried again at another length.  Offsets are
code points, ends exclusive.

Bootstrapping: a unit is an identifier-like token (it holds a digit or @; phones and cards may
hold spaces).  Its lexical patterns are the two words before it, and the word before with the
word after, where a neighbouring unit is the word ``<id>``.  Units that are base entities are the seeds, with score 1 for their kind.  Each round

* a pattern's confidence for a kind is the mean score of its distinct units for that kind, if at
  least ``min_support`` of them are known;
* a unit's score is one minus the product of one minus the confidences of its patterns;

and units that reach ``accept`` count as known in the next round.  After ``rounds`` rounds, known
units that overlap no base entity and hold an @ or at least ``min_digits`` digits are new spans.
The pattern-unit graph holds distinct pairs only, so a frequent pattern or unit is one row per
pair, sums are pre-aggregated, and every round is written to the shared folder.

Only DataFrame functions are used.  The patterns are written so that every match attempt is
linear (possessive repetition, starts anchored where a match can begin); they find exactly what
the plain forms beside them find.

Defined cases: a null text is empty; rows are told apart by id and text, so repeated rows get the
same spans; rows without an id are searched like others; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_or_empty

#: Kinds in their order, with their patterns and a cheap necessary condition.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    # [0-9]([\x20-]?[0-9])+
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9]"),
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    "unit": (r"(?<!\S)(?:\+[0-9][\x20().0-9-]+[0-9](?!\w)|[0-9]++(?:[\x20-][0-9]++)++(?!\w)|[^\s0-9@]*+[0-9@]\S*+)", r"[0-9@]"),
}
OCTET = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"
#: The last two words of a text that ends in a space, or its only one.
LAST_WORDS = r"(?<!\S)(?:\S++\s++)?\S++\s++$"
#: What a neighbouring unit counts as in a context.
UNIT_WORD = "<id>"
NO_ID = 2**63 - 1


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)
    worth = F.transform(F.sequence(F.lit(1), F.length(back)), lambda i: F.substring(back, i, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(worth, F.lit(0), lambda s, w: s + w - F.when(w > 9, 9).otherwise(0)) % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "ip", F.forall(F.split(match, r"\."), lambda p: p.rlike(OCTET)))
            .when(kind == "card", F.when(n.between(14, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(10, 15))
            .otherwise(True))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(F.col(text_col))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("key"), text.alias("text"))


def matches(named: DataFrame) -> DataFrame:
    """(doc, key, kind, start, stop, match, before, after) of every match of every pattern, unchecked.

    Splitting at a pattern gives the gaps between its matches, so offsets are running sums.
    """
    parts = named.select("doc", "key", *(
        F.when(F.col("text").rlike(quick), f).alias(f"{name}_{kind}") for kind, (pattern, quick) in PATTERNS.items()
        for name, f in (("gaps", F.split("text", pattern, -1)), ("found", F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))))

    def before(gaps: Column, i: Column) -> Column:
        """The two words before unit i; with two units before it, they hold at least two words."""
        def gap(back: int) -> Column:  # the end of a word that a unit starts belongs to the unit
            return F.concat(F.lit(UNIT_WORD), F.regexp_replace(F.get(gaps, i - back), r"^\S+", ""))

        text = F.concat(F.when(i >= 2, gap(1)).when(i == 1, F.get(gaps, i - 1)).otherwise(""),
                        F.when(i >= 1, gap(0)).otherwise(F.get(gaps, i)))
        return F.regexp_replace(F.regexp_extract(text, LAST_WORDS, 0), r"\s+", " ")

    def after(gaps: Column, i: Column) -> Column:
        """The word after unit i."""
        word = F.regexp_extract(F.get(gaps, i + 1), r"^\S*+\s++(\S++)", 1)
        return F.concat(F.lit(" "), F.when((word == "") & (F.size(gaps) > i + 2), F.lit(UNIT_WORD)).otherwise(word))

    def rows(kind: str) -> Column:
        gaps, near = F.col(f"gaps_{kind}"), kind == "unit"
        return F.transform(F.coalesce(F.col(f"found_{kind}"), F.array().cast("array<string>")), lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("nth"), F.length(F.get(gaps, i)).alias("gap"), m.alias("match"),
            (before(gaps, i) if near else F.lit("")).alias("before"),
            (after(gaps, i) if near else F.lit("")).alias("after")))

    found = (parts.select("doc", "key", F.explode(F.concat(*map(rows, PATTERNS))).alias("m")).select("doc", "key", "m.*")
             .dropDuplicates(["doc", "key", "kind", "nth"]))
    so_far = Window.partitionBy("doc", "key", "kind").orderBy("nth")
    stop = F.sum(F.col("gap") + F.length("match")).over(so_far)
    return found.withColumn("stop", stop).select(
        "doc", "key", "kind", (F.col("stop") - F.length("match")).alias("start"), "stop", "match", "before", "after")


def base_entities(found: DataFrame) -> DataFrame:
    return found.filter((F.col("kind") != "unit") & valid(F.col("kind"), F.col("match"))).select("doc", "key", "kind", "start", "stop")


# ---------------------------------------------------------------- bootstrapping

def units(found: DataFrame, base: DataFrame) -> DataFrame:
    """(doc, key, start, stop, unit, kind of the equal base entity or null, patterns)."""
    lead = F.length(F.regexp_extract("match", r"^[\"'(<\[{]*", 0))
    core = F.regexp_replace(F.regexp_replace("match", r"^[\"'(<\[{]+", ""), r"[.,;:!?)\"'>\]}]+$", "")
    rows = (found.filter("kind = 'unit'").withColumn("unit", core).withColumn("start", F.col("start") + lead)
            .withColumn("stop", F.col("start") + F.length("unit")))
    two = F.lower(F.regexp_extract("before", r"(?<!\S)(\S++\s++\S++)\s++$", 1))
    one = F.lower(F.regexp_extract("before", r"(?<!\S)(\S++)\s++$", 1))
    after = F.lower(F.regexp_extract("after", r"^\s++(\S++)", 1))
    patterns = F.filter(F.array(
        F.when(two != "", F.concat(F.lit("2:"), F.regexp_replace(two, r"\s+", " "))),
        F.when((one != "") & (after != ""), F.concat(F.lit("1:"), one, F.lit(" _ "), after))), lambda p: p.isNotNull())
    # two kinds may match the same stretch; the first listed names the seed
    seeds = base.groupBy("doc", "key", "start", "stop").agg(F.min(F.struct(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("i"), "kind")).alias("k")) \
        .select("doc", "key", "start", "stop", "k.kind")
    return (rows.filter(F.length("unit") > 0).select("doc", "key", "start", "stop", "unit", patterns.alias("patterns"))
            .join(seeds, ["doc", "key", "start", "stop"], "left"))


def bootstrap(found_units: DataFrame, rounds: int = 3, min_support: int = 3, accept: float = 0.8) -> DataFrame:
    """(unit, kind, score) of the units known after the rounds, seeds included."""
    edges = cut(found_units.select(F.explode("patterns").alias("pattern"), F.lower("unit").alias("unit")).distinct())
    seeds = found_units.filter("kind IS NOT NULL").select(F.lower("unit").alias("unit"), "kind").distinct().withColumn("score", F.lit(1.0))
    known = seeds = cut(seeds)
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    for _ in range(rounds):
        confidence = (edges.join(known, "unit").groupBy("pattern", "kind")
                      .agg(F.sum("score").alias("sum"), F.count(F.lit(1)).alias("support")).filter(F.col("support") >= min_support)
                      .join(size, "pattern").select("pattern", "kind", (F.col("sum") / F.col("size")).alias("confidence")))
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        scored = (edges.join(confidence, "pattern").groupBy("unit", "kind").agg((1 - F.exp(doubt)).alias("score"))
                  .filter(F.col("score") >= accept))
        best = scored.groupBy("unit").agg(F.max(F.struct("score", "kind")).alias("b")).select("unit", "b.kind", "b.score")
        known = cut(best.join(seeds.select("unit").distinct(), "unit", "left_anti").unionByName(seeds))
    return known


def new_spans(found_units: DataFrame, base: DataFrame, known: DataFrame, min_digits: int = 4) -> DataFrame:
    """(doc, key, kind, start, stop) of known units that overlap no base entity."""
    digits = F.length(F.regexp_replace("unit", "[^0-9]", ""))
    some = (found_units.filter(F.col("kind").isNull() & (F.col("unit").contains("@") | (digits >= min_digits)))
            .select("doc", "key", "start", "stop", F.lower("unit").alias("unit")))
    named = some.join(known.select("unit", "kind"), "unit").select("doc", "key", "kind", "start", "stop")
    other = base.select("doc", "key", F.col("start").alias("a"), F.col("stop").alias("z"))
    return named.join(other, (named["doc"] == other["doc"]) & (named["key"] == other["key"])
                      & (F.col("a") < F.col("stop")) & (F.col("start") < F.col("z")), "left_anti")


# ---------------------------------------------------------------- result

def _listed(spans: DataFrame, name: str) -> DataFrame:
    """kind:start:stop of each document's spans, by start, then kind, then stop."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    text = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("stop").cast("string"))
    rows = F.array_sort(F.collect_list(F.struct("start", order.alias("i"), "stop", text.alias("text"))))
    return spans.groupBy("doc", "key").agg(F.array_join(F.transform(rows, lambda r: r["text"]), ",").alias(name),
                                           *(F.count(F.when(F.col("kind") == k, 1)).alias(f"{name}_{k}") for k in KINDS))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, min_support: int = 3,
         accept: float = 0.8, min_digits: int = 4) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone (base entities), base, spans (base and new ones)."""
    named = _named(docs, id_col, text_col)
    found = cut(matches(named))
    base = cut(base_entities(found))
    candidates = cut(units(found, base))
    more = new_spans(candidates, base, bootstrap(candidates, rounds, min_support, accept), min_digits)
    lists = _listed(base, "base").join(_listed(base.unionByName(more), "spans").select("doc", "key", "spans"), ["doc", "key"], "full")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(text_or_empty(F.col(text_col))).alias("key"))
    return rows.join(lists, ["doc", "key"], "left").select(
        "doc_id", *(F.coalesce(f"base_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.coalesce("base", F.lit("")).alias("base"), F.coalesce("spans", F.lit("")).alias("spans"))
