"""Performances matched across tables without a common key (problem 5) by a cascade of exact joins.

Each attribute first gets a key under which its spellings are equal: acts and towns by :func:`variants.name_groups`,
dates by a parser, venues by their sorted skeletons. Rules then join on ever weaker combinations of the keys. Each pass
anti-joins what earlier ones have resolved: a pair is looked for only if one of its two rows is still open; where the town is
missing that must be the row that lacks it, and a rule that relaxes the date takes only open listings, lest the second of two
nights be taken for the first. A pair's confidence is its first rule's precision on labelled pairs: those given, else
those whose listing has coordinates, which no rule uses, and whose entry's town has them too, else by the attribute left over.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm import names as N
from eventlake.llm.variants import name_groups
from eventlake.operators.places import haversine
from eventlake.session import broadcast_if_small, cut, stored

# Month names in English, German, Spanish and French by their first three letters.
MONTHS = {"jan": 1, "ene": 1, "feb": 2, "fév": 2, "fev": 2, "mar": 3, "mär": 3, "mrz": 3, "apr": 4, "abr": 4, "avr": 4, "may": 5, "mai": 5, "jun": 6, "jul": 7, "aug": 8, "ago": 8, "aoû": 8, "sep": 9, "oct": 10, "okt": 10, "nov": 11, "dec": 12, "dez": 12, "dic": 12, "déc": 12}
# Rules in the order they are tried: keys that must be equal, and days by which the dates may differ.
RULES = (
    ("act town date venue", ("act", "town", "venue"), 0),
    ("act town date", ("act", "town"), 0),
    ("act date venue", ("act", "venue"), 0),
    ("act date, town missing", ("act",), 0),  # in one of the two rows
    ("act town venue, day off", ("act", "town", "venue"), 1),
    ("act town, day off", ("act", "town"), 1),
    ("act venue, day off, town missing", ("act", "venue"), 1),
    ("town date venue, act alike", ("town", "venue"), 0),  # the acts' rare words within reach, and the other words and numbers of one among the other's
)

NEAR_KM = 35.0  # a listing's coordinates farther from a town than this are not of the town


def listed_date(c: Column) -> Column:
    """The day a listing states in words or numbers (day-first); null if it states none that exists."""
    t = F.lower(F.trim(c))
    g = lambda p, n: F.nullif(F.regexp_extract(t, p, n), F.lit(""))
    iso, num = r"^(\d{4})-(\d{1,2})-(\d{1,2})", r"^(?:\p{L}+\.?,? )?(\d{1,2})[./](\d{1,2})[./](\d{4})"
    dmy, mdy = r"(?:^|\s)(\d{1,2})(?:st|nd|rd|th|\.)?[\s./-]*(?:de\s+)?(\p{L}{3,12})\.?[\s./,-]*(?:de\s+)?(\d{4})", r"(?:^|\s)(\p{L}{3,12})\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})"
    months = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    word = lambda p, n: F.coalesce(F.when(g(p, n).rlike("^juil"), F.lit(7)), F.try_element_at(months, F.substring(F.regexp_extract(t, p, n), 1, 3)).cast("int"))
    text = lambda y, m, d: F.concat_ws("-", y, F.lpad(m.cast("string"), 2, "0"), F.lpad(d, 2, "0"))
    found = (
        F.when(t.rlike(iso), text(g(iso, 1), g(iso, 2), g(iso, 3)))
        .when(t.rlike(num), text(g(num, 3), g(num, 2), g(num, 1)))
        .when(t.rlike(dmy), text(g(dmy, 3), word(dmy, 2), g(dmy, 1)))
        .when(t.rlike(mdy), text(g(mdy, 3), word(mdy, 1), g(mdy, 2)))
    )
    return F.try_to_date(found, "yyyy-MM-dd")


def _venue_keys(venues: DataFrame) -> DataFrame:
    """(venue, venue_key) of distinct venues: the words' skeletons in order of the alphabet, without what is said of the room."""

    def f(batches):
        for b in batches:
            keys = []
            for v in b.column(0).to_pylist():
                core = re.sub(r"\s*(?:@.*|\(.*?\)|\bstage)\s*$", "", N.unmangle(v), flags=re.I)
                keys.append(" ".join(sorted(s for w in N.split(core.replace("-", " ")) if (s := N.skeleton(w)) and s != "te")) or None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.string())], names=["venue", "venue_key"])

    return venues.where(F.col("venue").isNotNull()).select("venue").distinct().mapInArrow(f, "venue string, venue_key string")


def keyed(entries: DataFrame, listings: DataFrame, cities: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Both tables as (id, act, stem, others, town, day, venue, lat, lng), rows without an act or a day left out, and the towns' places (town, spots)."""
    at = [F.col(c).cast("double").alias(c) if c in listings.columns else F.lit(None).cast("double").alias(c) for c in ("lat", "lng")]
    nowhere = [F.lit(None).cast("double").alias(c) for c in ("lat", "lng")]
    both = entries.select(F.lit(True).alias("entry"), F.col("entry_id").alias("id"), "artist", listed_date(F.col("event_date")).alias("day"), "venue", "city", *nowhere).unionByName(
        listings.select(F.lit(False).alias("entry"), F.col("listing_id").alias("id"), "artist", listed_date(F.col("date_text")).alias("day"), "venue", "city", *at)
    )
    rows = stored(both.where(F.col("id").isNotNull() & F.col("artist").isNotNull() & F.col("day").isNotNull()))
    acts = stored(name_groups(rows.select(F.col("artist").alias("name"))).select(F.col("name").alias("artist"), F.col("grp").alias("act"), "stem", "others"))
    known = cities.select(F.col("city").alias("name"), F.explode_outer("alt_names").alias("alias")).where(F.col("name").isNotNull()) if cities is not None else None
    towns = name_groups(rows.select(F.col("city").alias("name")).where(F.col("name").isNotNull()), place=True, aliases=known)
    towns = stored(towns.where(~F.col("grp").startswith("!")).select(F.col("name").alias("city"), F.col("grp").alias("town")))
    out = rows.join(acts, "artist").join(towns, "city", "left").join(_venue_keys(rows), "venue", "left").select("entry", "id", "act", "stem", "others", "town", "day", F.col("venue_key").alias("venue"), "lat", "lng")
    out = stored(out)
    spots = None
    if cities is not None and {"lat", "lng"} <= set(cities.columns):
        spots = cities.where("lat IS NOT NULL AND lng IS NOT NULL").join(towns, "city").groupBy("town").agg(F.collect_set(F.struct("lat", "lng")).alias("spots"))
    return out.where("entry").drop("entry", "lat", "lng"), out.where("not entry").drop("entry"), spots


def _joined(e: DataFrame, l: DataFrame, keys: tuple[str, ...], off: int) -> DataFrame:  # noqa: E741
    """Pairs of one rule: equal keys, none of them null, and dates ``off`` days apart (either way); the listing's columns are called r_..."""
    shifts = F.array(F.lit(0)) if not off else F.array(F.lit(-off), F.lit(off))
    left = e.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).withColumn("_s", F.explode(shifts)).withColumn("day", F.date_add("day", F.col("_s"))).drop("_s")
    right = l.select(*[F.col(c).alias(f"r_{c}") for c in l.columns])
    return left.join(right, [left[k] == right[f"r_{k}"] for k in (*keys, "day")])


def cascade(entries: DataFrame, listings: DataFrame, spots: DataFrame | None = None) -> DataFrame:
    """(entry_id, listing_id, rule_no, agrees) of keyed rows; agrees is a label from elsewhere, null where it cannot be told.

    Both tables are kept as one that carries along which rows are open, so a pass writes its pairs and that table, and its plan does not grow with the passes before it.
    """
    nowhere = F.lit(None).cast("array<struct<lat:double,lng:double>>")
    if spots is None:
        entries = entries.withColumn("spots", nowhere)
    else:
        entries = entries.join(broadcast_if_small(spots.withColumnRenamed("town", "_town")), F.col("town") == F.col("_town"), "left").drop("_town")
    if "lat" not in listings.columns:
        listings = listings.withColumns({c: F.lit(None).cast("double") for c in ("lat", "lng")})
    sides = entries.withColumn("entry", F.lit(True)).unionByName(listings.withColumn("entry", F.lit(False)), allowMissingColumns=True)
    rows = stored(sides.withColumn("open", F.lit(True)))
    near = F.exists("spots", lambda p: haversine(p["lat"], p["lng"], F.col("r_lat"), F.col("r_lng")) <= NEAR_KM)
    done: list[DataFrame] = []
    for no, (name, keys, off) in enumerate(RULES, 1):
        e, l = rows.where("entry").drop("entry", "lat", "lng"), rows.where("NOT entry").drop("entry", "spots")  # noqa: E741
        if "missing" in name:  # the row without a town must be open; a venue that is told on both sides must not be another
            pairs = _joined(e.where("open AND town IS NULL"), l.where("open" if off else "open OR town IS NOT NULL"), keys, off)
            pairs = pairs.unionByName(_joined(e.where("town IS NOT NULL"), l.where("open AND town IS NULL"), keys, off))
            pairs = pairs.where("venue IS NULL OR r_venue IS NULL OR levenshtein(venue, r_venue, 3) >= 0")
        elif off:
            pairs = _joined(e, l.where("open"), keys, off)
        else:
            pairs = _joined(e.where("open"), l, keys, off)
            if done:
                pairs = pairs.unionByName(_joined(e.where("NOT open"), l.where("open"), keys, off))
        if "alike" in name:
            lacks = "size(array_except(split({}, ' '), split({}, ' '))) = 0"
            among = [f"others = '' OR r_others = '' OR {lacks.format(*p)}" for p in (("others", "r_others"), ("r_others", "others"))]
            pairs = pairs.where("length(stem) > 5 AND length(r_stem) > 5 AND levenshtein(stem, r_stem, 2) >= 0").where(" OR ".join(among))
        left_over = F.levenshtein("venue", "r_venue", 3) >= 0 if "town" in keys else F.lit(None).cast("boolean")
        agrees = F.coalesce(F.when(F.col("r_lat").isNotNull() & F.col("r_lng").isNotNull(), near), left_over)
        found = stored(pairs.select(F.col("id").alias("entry_id"), F.col("r_id").alias("listing_id"), F.lit(no).alias("rule_no"), agrees.alias("agrees")))
        done.append(found)
        if no < len(RULES):
            rows = _closed(rows, found)
    first, pairs = F.min_by(F.col("agrees"), F.col("rule_no")), done[0]
    for d in done[1:]:
        pairs = pairs.unionByName(d)
    return pairs.groupBy("entry_id", "listing_id").agg(F.min("rule_no").alias("rule_no"), first.alias("agrees"))


def _closed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` of both tables with those of the pairs ``found`` no longer open."""
    sides = F.explode(F.array(F.struct(F.lit(True).alias("e"), F.col("entry_id").alias("i")), F.struct(F.lit(False).alias("e"), F.col("listing_id").alias("i"))))
    met = found.select(sides.alias("_m")).select(F.col("_m.e").alias("_e"), F.col("_m.i").alias("_id")).distinct()
    on = (F.col("entry") == F.col("_e")) & (F.col("id") == F.col("_id"))
    return stored(rows.join(met, on, "left").withColumn("open", F.col("open") & F.col("_id").isNull()).drop("_e", "_id"))


def matches(entries: DataFrame, listings: DataFrame, cities: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """(entry_id, listing_id, rule_no, confidence) of every pair that some rule joins.

    Confidence is (good + 1) / (told + 2) over the rule's labelled pairs: those of ``labels`` (entry_id, listing_id, same) if
    given, else pairs whose listing has coordinates (``lat``, ``lng``) and whose entry's town has them in ``cities``, good if
    they are at most NEAR_KM apart; else, for rules that join on the town, pairs with a venue on both sides, good if those agree.
    Rows with a null id, act or date are in no pair; a null town or venue equals nothing; towns given as "online" and the like
    count as missing. Repeated rows come once. Empty tables give no rows.
    """
    e, l, spots = keyed(entries, listings, cities)  # noqa: E741
    return with_confidence(cut(cascade(e.distinct(), l.distinct(), spots)), labels)


def with_confidence(pairs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Pairs (entry_id, listing_id, rule_no, agrees) with their rule's smoothed precision in place of ``agrees``."""
    told = pairs.select("rule_no", F.col("agrees").alias("good"))
    if labels is not None:
        told = pairs.join(labels.select("entry_id", "listing_id", F.col("same").alias("good")), ["entry_id", "listing_id"]).select("rule_no", "good")
    precision = told.groupBy("rule_no").agg(((F.coalesce(F.sum(F.col("good").cast("int")), F.lit(0)) + 1) / (F.count("good") + 2)).alias("confidence"))
    return pairs.join(F.broadcast(precision), "rule_no", "left").select("entry_id", "listing_id", "rule_no", F.round(F.coalesce("confidence", F.lit(0.5)), 6).alias("confidence"))  # one row a rule
