"""SpotSigs fingerprints: chains of content words that follow common words.

Common words are spread evenly over running text and rare in navigation and tables, so what follows them marks
the text proper. A signature is the run of common words before a content word (the anchor), that word and the
next ones, common words between them left out. A document's fingerprint is its set of signatures; sets are
compared by Jaccard only where their lengths allow the wanted likeness. DataFrame functions throughout.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paxledger.llm.common import forget, settle, texts

# Common words of English, French, German and Spanish that serve as anchors.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was were with "
    "au avec ce dans de des du en est et il la le les ou par pas pour qui que sur un une "
    "als am auch auf aus bei das dem den der die ein eine für im ist mit nicht sich sie und von zu "
    "al como con del el es las los más no para pero por se su una y"
).split()
#: Content words of a chain.
CHAIN = 3
#: Documents whose windows over neighbours are worked on together.
ROWS_PER_RANGE = 1 << 12
#: Ranges of ids of about equal numbers of rows, within which ids are taken to be evenly spread.
COARSE = 32

_ANCHORED = "(?<![^ ])(" + "|".join(sorted(set(ANCHORS))) + ") "


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The set of signatures of a text, as longs in no particular order.

    In a text without any anchored word every word begins a chain; one without words has no signature.
    """
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    words = F.split(F.regexp_replace(plain, _ANCHORED, "$1~"), " ", -1)
    bare = F.transform(words, lambda w: F.substring_index(w, "~", -1))
    both = F.struct(words.alias("words"), bare.alias("bare"))

    def chains(x: Column) -> Column:
        chained = lambda w, i: F.xxhash64(w, *[F.get(x["bare"], i + k) for k in range(1, chain)])
        anchored = F.array_compact(
            F.transform(x["words"], lambda w, i: F.when(F.contains(w, F.lit("~")), chained(w, i)))
        )
        return F.array_distinct(F.when(F.size(anchored) > 0, anchored).otherwise(F.transform(x["words"], chained)))

    # A one-element array holds the parts, so that each is made once.
    found = F.element_at(F.transform(F.array(both), chains), 1)
    return F.when(plain == "", F.array().cast("array<bigint>")).otherwise(found)


def fingerprint(sigs: Column) -> Column:
    """The set itself, in ascending order: equal for equal sets, and so for equal texts. ``signatures_of`` reads it back."""
    return F.array_join(F.array_sort(sigs).cast("array<string>"), ",")


def signatures_of(fingerprint: Column) -> Column:
    """The set that a fingerprint states."""
    return F.when(fingerprint == "", F.array().cast("array<bigint>")).otherwise(F.split(fingerprint, ",").cast("array<bigint>"))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two signature sets, 0 where their lengths already keep it below ``least``. Two empty sets are alike."""
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when(long == 0, F.lit(1.0))
        .when((short == 0) | (short < F.lit(least) * long), F.lit(0.0))
        .otherwise(shared / (short + long - shared))
    )


def ranged(rows: DataFrame, tie: Column) -> tuple[DataFrame, Column]:
    """(_range, _next) for the ranges of doc_id that hold rows, and the range of a doc_id as an expression.

    Ranges follow the ids: nulls first, in equal steps of ``tie``, a hash of 32 bits; then, within each of ``COARSE``
    quantile ranges, equal steps of the id.
    """
    n, without, bounds = rows.agg(
        F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull()), F.percentile_approx("doc_id", [i / COARSE for i in range(COARSE + 1)], 1000)
    ).first()
    cuts = sorted(set(bounds or [])) or [0]
    # The last range is closed above by the largest id, which percentile_approx returns for 1.
    low, high = cuts, [*cuts[1:], cuts[-1] + 1]
    steps = max(1, -(-n // (ROWS_PER_RANGE * max(1, len(cuts) - 1))))
    width = [max(1, -(-(b - a) // steps)) for a, b in zip(low, high)]
    at = F.greatest(F.lit(1), F.size(F.filter(F.array(*[F.lit(c) for c in low]), lambda c: c <= F.col("doc_id"))))
    inside = F.floor(
        (F.col("doc_id") - F.element_at(F.array(*[F.lit(c) for c in low]), at)) / F.element_at(F.array(*[F.lit(w) for w in width]), at)
    )
    inside = F.least(F.greatest(inside, F.lit(0)), F.lit(steps - 1))
    null_step = -(-(1 << 32) // max(1, -(-without // ROWS_PER_RANGE)))
    first = F.floor(tie / F.lit(null_step)) - F.lit(-(-(1 << 32) // null_step))
    place = F.when(F.col("doc_id").isNull(), first).otherwise(at.cast("long") * steps + inside).cast("long")
    held = rows.select(place.alias("_range")).distinct()
    # A few numbers a thousand rows.
    following = held.select("_range", F.lead("_range").over(Window.orderBy("_range")).alias("_next"))
    return following, place


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sigs, next_text, next_sigs: text and signatures, and those of the next document by doc_id, after the last the first's.

    Nulls come first and rows of one id, or of none, by a hash of their text and then the text, so the result doesn't
    depend on how rows are dealt out, and rows without ids fill several ranges. Text is shuffled once: ranges of ids are sorted each by itself, and only the first text of a range travels to the one
    before.
    """
    plain = texts(docs)
    tie = F.shiftrightunsigned(F.xxhash64("text"), 32)
    following, place = ranged(plain, tie)
    following = settle(following, "spots-ranges")
    placed = plain.withColumn("_range", place).withColumn("_tie", tie)
    order = [F.col("doc_id").asc_nulls_first(), "_tie", "text"]
    firsts = settle(
        placed.groupBy("_range").agg(F.min_by("text", F.struct("doc_id", "_tie", "text")).alias("_first")), "spots-firsts"
    )
    start = following.agg(F.min("_range")).first()[0]
    joined = (
        following.select(F.col("_range").alias("_here"), F.coalesce("_next", F.lit(start)).alias("_then"))
        .join(firsts, F.col("_then") == F.col("_range"))
        .select("_here", "_first")
    )
    line = Window.partitionBy("_range").orderBy(*order)
    # Signatures are made before the sort and travel with the text, so that each text is taken apart once.
    marked = placed.withColumn("sigs", signatures(F.col("text")))
    led = marked.select("*", F.lead("text").over(line).alias("_lead"), F.lead("sigs").over(line).alias("_lead_sigs"))
    led = led.join(joined, F.col("_range") == F.col("_here"))
    return led.select(
        "doc_id",
        "text",
        "sigs",
        F.coalesce("_lead", "_first").alias("next_text"),
        F.coalesce(F.col("_lead_sigs"), signatures(F.col("_first"))).alias("next_sigs"),
    )


def edited(text: Column, following: Column) -> Column:
    """The last quarter of ``text`` (floor of code points) replaced by as many first code points of ``following``."""
    cut = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(following, F.lit(1), cut))


def op9_spotsigs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    pairs = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    sets = pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("sigs").alias("a"),
        signatures(F.col("edited")).alias("b"),
        F.col("next_sigs").alias("c"),
    )
    return sets.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("a")).alias("fingerprint"),
        fingerprint(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"),
        likeness(F.col("a"), F.col("c")).alias("near_next"),
    )


def near_pairs(docs: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Classes of equal signature sets as (doc_id, class_id), and pairs of classes (a, b, likeness) of at least ``least``.

    The class id is the smallest doc_id. Sets are dealt to bands of length, of which a set meets only its own and
    the next longer one; in a band they meet by the rarest signatures of either, of which two sets that are alike
    enough share one; then lengths and the exact Jaccard decide.
    """
    sets = settle(texts(docs).select("doc_id", F.array_sort(signatures(F.col("text"))).alias("sigs")), "spots-sets")
    keyed = sets.select("doc_id", F.sha2(fingerprint(F.col("sigs")), 256).alias("_print"))
    ids = keyed.groupBy("_print").agg(F.min("doc_id").alias("class_id"))
    member = settle(keyed.join(ids, "_print").select("doc_id", "class_id"), "spots-classes")
    lead = member.where("doc_id = class_id").select(F.col("class_id").alias("_id")).distinct()
    reps = settle(
        sets.join(lead, F.col("doc_id") == F.col("_id")).where(F.size("sigs") > 0).groupBy("doc_id").agg(F.min("sigs").alias("sigs")),
        "spots-reps",
    )
    forget(sets)
    each = reps.select("doc_id", F.explode("sigs").alias("sig"))
    often = each.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = each.join(often, "sig")
    rarest = ranked.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("shared"))
    size = F.size("sigs")
    band = F.floor(F.log(size.cast("double")) / F.lit(-math.log(least))).cast("int")
    # Signatures of one set alone can't be shared; they come first in the order and use up that much of the prefix.
    prefix = F.greatest(F.lit(0), size - F.ceil(size * F.lit(least) - 1e-9).cast("int") + 1 - (size - F.size("shared")))
    short = rarest.join(reps, "doc_id").select(
        "doc_id", size.alias("n"), band.alias("band"), F.explode(F.slice("shared", F.lit(1), prefix)).alias("s")
    )
    left = short.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("s.sig").alias("sig"), F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    right = short.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("s.sig").alias("sig"), "band")
    longer = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    met = left.join(right, ["sig", "band"]).where(longer & (F.col("na") >= F.lit(least) * F.col("nb") - 1e-9)).select("a", "b").distinct()
    sa = reps.select(F.col("doc_id").alias("a"), F.col("sigs").alias("sa"))
    sb = reps.select(F.col("doc_id").alias("b"), F.col("sigs").alias("sb"))
    judged = met.join(sa, "a").join(sb, "b").select("a", "b", likeness(F.col("sa"), F.col("sb"), least).alias("likeness"))
    return member, judged.where(F.col("likeness") >= least)

