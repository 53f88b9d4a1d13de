"""Many requests against many ads, through an inverted index of what requests ask for.

1. Everything an ad can be found by is a token: its advertiser's id, countries, languages, media type, status, ad type,
   the day bins it spans, and the words and names of requests that it holds.
2. Words and names are found by 3-grams. The distinct ones open the postings of their rarest gram only and are then
   compared with the text, once for each ad and word, not for each ad and request.
3. Tokens that any request asks for are numbered; an index row has an ad's number, dates and those tokens. A request has
   groups of tokens, of each of which an ad must have one. It opens the postings of its rarest group, and the others and
   its dates are checked on the index rows.

An ad's other columns stay out of all of this and are fetched by row number in the end. Postings of a token that many
requests and ads share are dealt over several tasks by the ad, the requests being repeated in each.

Requests that differ in their dates only share a condition, which is matched once, within the days that any of them
concerns. Its ads are counted by first and last day; from these counts each request has its number of matches and the
days that hold its first rows, so that no pair of a request and an ad is made to be counted or cut away.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.literals import strings
from .storage import BROADCAST_ROWS, few, stored

# Executors get the function that answers requests as it is, without this package being installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM = 3
#: Days in a bin, and how many narrow bins an ad may span before it goes to the wide ones.
NARROW_DAYS, WIDE_DAYS, NARROW_BINS = 32, 1024, 8
#: Share of all days from which on a request is not looked for by bins.
MOST_DAYS = 0.75
#: Pairs of one token that a task tests.
PAIRS_A_TASK = 1 << 18
#: Up to so many grams are looked for in each text as they are; of more, a text's own grams are looked up.
FEW_GRAMS = 64
#: Patterns, each with its rarest gram, that a join may broadcast.
BROADCAST_PATTERNS = 100_000
AD = "_ad"
#: Columns by which ads are found.
SOUGHT = [
    "ad_id", "platform", "advertiser_id", "advertiser_name", "status", "first_seen", "last_seen", "media_type", "countries",
    "languages", "extra_json", "ad_text",
]
ANY = "all"
_NO_STATUS = "st?"


def like_pattern(word: Column) -> Column:
    """A word anywhere in a text; ``%`` and ``_`` in it stay wildcards."""
    return F.concat(F.lit("%"), F.replace(word, F.lit("\\"), F.lit("\\\\")), F.lit("%"))


def terms(words: Column) -> Column:
    return F.filter(F.split(words, r"\s+"), lambda t: t != "")


def grams(text: Column, size: int) -> Column:
    """The distinct runs of so many characters of a text, in time linear in its length.

    Halves of characters beyond the basic plane give further runs, which no pattern has.
    """
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def pattern_grams(mode: Column, word: Column) -> Column:
    """Grams that every text matched by a pattern holds: 3-grams if its fixed parts have any, else those parts.

    A pattern of wildcards only has the empty gram, which all texts hold.
    """
    parts = F.when(mode == "like", F.split(word, "[%_]")).when(mode == "all_terms", terms(word)).otherwise(F.array(word))
    parts = F.filter(parts, lambda p: p != "")
    long = F.filter(parts, lambda p: F.length(p) >= GRAM)
    starts = F.transform(long, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - GRAM + 1), lambda i: F.substring(p, i, F.lit(GRAM))))
    cut = F.array_distinct(F.flatten(starts))
    return F.when(F.size(cut) > 0, cut).when(F.size(parts) > 0, F.array_distinct(parts)).otherwise(F.array(F.lit("")))


def holds(text: Column, mode: Column, word: Column) -> Column:
    """Whether a text in lower case has a pattern."""
    every = F.forall(terms(word), lambda t: F.contains(text, t))
    return F.when(mode == "contains", F.contains(text, word)).when(mode == "like", F.like(text, like_pattern(word))).otherwise(every)


def pattern_matches(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(_ad, platform, token) of every text (_ad, platform, text) that holds a pattern (platform, token, mode, word) of its
    platform.

    Postings are counted for the grams of patterns; each pattern opens those of its rarest gram, and only these texts are
    compared with it: in the scan that spells them where the patterns can be broadcast, else by a join on the ad.
    """
    asked = stored(patterns.distinct().withColumn("gram", F.explode(pattern_grams(F.col("mode"), F.col("word")))), "patterns")
    first = [r[0] for r in asked.select("gram").distinct().limit(FEW_GRAMS + 1).collect()]
    if not first:
        return texts.select(AD, "platform", F.lit(None).cast("string").alias("token")).limit(0)
    if len(first) <= FEW_GRAMS:
        own = F.filter(strings(first), lambda gram: F.contains(F.col("text"), gram))
    else:
        sizes = sorted(r[0] for r in asked.select(F.length("gram")).distinct().collect())
        own = F.concat(*[F.array(F.lit("")) if n == 0 else grams(F.col("text"), n) for n in sizes])
    spelt = texts.where("text IS NOT NULL").select(AD, "platform", "text", F.explode(own).alias("gram"))
    key = ["platform", "gram"]
    counts = spelt.select(*key).join(asked.select(*key).distinct(), key).groupBy(*key).agg(F.count("*").alias("n"))
    rarest = asked.join(counts, key, "left").groupBy("platform", "token", "mode", "word").agg(
        F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram")
    )
    rarest, found = stored(rarest, "rarest"), [AD, "platform", "token"]
    has = holds(F.col("text"), F.col("mode"), F.col("word"))
    if few(rarest, BROADCAST_PATTERNS):
        return spelt.join(F.broadcast(rarest), key).where(has).select(*found)
    opened = spelt.select(AD, *key).join(rarest, key).select(*found, "mode", "word")
    return opened.join(texts.select(AD, "text"), AD).where(has).select(*found)


def _named(prefix: str, values: Column) -> Column:
    return F.array_distinct(F.array_compact(F.transform(values, lambda v: F.concat(F.lit(prefix), v))))


def _text_token(mode: Column, word: Column) -> Column:
    return F.concat(F.lit("tx:"), mode, F.lit(":"), word)


def _name_token(mode: Column, name: Column) -> Column:
    return F.concat(F.lit("nm:"), mode, F.lit(":"), name)


def _is_id(name: Column) -> Column:
    return name.rlike("^[0-9]+$")


def request_groups() -> Column:
    """Groups of tokens of a resolved request; an ad must have a token of each."""
    c = F.col

    def who(name: Column) -> Column:
        return F.when(_is_id(name), F.concat(F.lit("id:"), name)).otherwise(_name_token(c("r_name_mode"), name))

    return F.array_compact(
        F.array(
            F.array_distinct(F.array_compact(F.transform("r_advertisers", who))),
            F.when(c("r_text").isNotNull(), F.array(_text_token(c("r_text_mode"), c("r_text")))),
            _named("co:", c("r_countries")),
            _named("la:", c("r_languages")),
            _named("ty:", c("r_types")),
            F.when(c("r_media").isNotNull(), F.array(F.concat(F.lit("me:"), "r_media"))),
            F.when(c("r_status").isNotNull(), F.array(F.concat(F.lit("st:"), "r_status"), F.lit(_NO_STATUS))),
        )
    )


def _day(moment: Column) -> Column:
    return F.unix_date(F.to_date(moment))


def _bins(prefix: str, first: Column, last: Column, days: int) -> Column:
    bins = F.sequence(F.floor(first / days), F.floor(last / days))
    return F.transform(bins, lambda b: F.concat(F.lit(prefix), b.cast("string")))


def with_days(asked: DataFrame) -> DataFrame:
    """Adds the first and last day that a request's dates concern, either open, in order where both are there."""
    start, end = _day(F.coalesce("r_first_min", "r_last_min")), _day(F.coalesce("r_first_max", "r_last_max"))
    later = F.greatest(start, end)
    return asked.withColumns({"r_low": F.when(start.isNotNull(), F.least(start, end)), "r_high": F.when(end.isNotNull(), later)})


def request_bins(low: int, high: int) -> Column:
    """Day bins, of both widths, of a request with dates.

    None where these are most of the days: every ad has a bin among them, so there is little to be left out by bins.
    """
    first, last = F.coalesce("r_low", F.lit(low)), F.coalesce("r_high", F.lit(high))
    both = F.concat(_bins("d0:", first, last, NARROW_DAYS), _bins("d1:", first, last, WIDE_DAYS))
    some = (last - first) < (high - low) * MOST_DAYS
    return F.when((F.col("r_low").isNotNull() | F.col("r_high").isNotNull()) & some, both)


def ad_bins(low: int, high: int) -> Column:
    """Day bins that an ad spans between two days: narrow ones for short ads, wide ones for long or open ads."""
    start, end = F.coalesce(_day(F.col("first_seen")), F.lit(low)), F.coalesce(_day(F.col("last_seen")), F.lit(high))

    def within(day: Column) -> Column:
        return F.least(F.greatest(day, F.lit(low)), F.lit(high))

    first, last = within(F.least(start, end)), within(F.greatest(start, end))
    short = last - first <= NARROW_DAYS * NARROW_BINS
    return F.when(short, _bins("d0:", first, last, NARROW_DAYS)).otherwise(_bins("d1:", first, last, WIDE_DAYS))


def text_tokens(ads: DataFrame, asked: DataFrame) -> DataFrame:
    """(_ad, platform, token) of the words and names of requests that an ad holds."""
    c = F.col

    def in_field(field: str) -> Column:
        return F.concat("platform", F.lit(f":{field}")).alias("platform")

    words = asked.where("r_text IS NOT NULL").select(
        in_field("text"), _text_token(c("r_text_mode"), c("r_text")).alias("token"), c("r_text_mode").alias("mode"), c("r_text").alias("word")
    )
    names = asked.select("platform", c("r_name_mode").alias("mode"), F.explode("r_advertisers").alias("word")).where(~_is_id(c("word")))
    names = names.select(in_field("name"), _name_token(c("mode"), c("word")).alias("token"), "mode", "word")
    texts = ads.select(AD, in_field("text"), F.lower("ad_text").alias("text"))
    texts = texts.unionByName(ads.select(AD, in_field("name"), F.lower("advertiser_name").alias("text")))
    found = pattern_matches(texts, words.unionByName(names))
    return found.withColumn("platform", F.regexp_replace("platform", ":(text|name)$", ""))


def own_tokens(ads: DataFrame, days: tuple[int, int] | None, kinds: set[str]) -> DataFrame:
    """(_ad, platform, token) of everything else an ad can be found by, of the kinds that are asked for."""
    c = F.col
    none = F.array().cast("array<string>")
    single = {
        ANY: F.lit(ANY),
        "id:": F.concat(F.lit("id:"), "advertiser_id"),
        "me:": F.concat(F.lit("me:"), "media_type"),
        "ty:": F.concat(F.lit("ty:"), F.get_json_object("extra_json", "$.ad_type")),
        _NO_STATUS: F.coalesce(F.concat(F.lit("st:"), "status"), F.lit(_NO_STATUS)),
    }
    lists = {"co:": _named("co:", c("countries")), "la:": _named("la:", c("languages"))}
    if days and kinds & {"d0:", "d1:"}:
        kinds, lists["days"] = kinds | {"days"}, ad_bins(*days)
    # A request for a status also takes ads without one, so neither token is asked for without the other.
    listed = [F.coalesce(lists[k], none) for k in lists if k in kinds]
    own = F.concat(F.array_compact(F.array(F.lit(None).cast("string"), *[single[k] for k in single if k in kinds])), *listed)
    return ads.select(AD, "platform", F.explode(own).alias("token"))


def held_tokens(ads: DataFrame, asked: DataFrame, wanted: DataFrame, days: tuple[int, int] | None) -> DataFrame:
    """(_ad, no) of the ``wanted`` tokens (platform, token, no) that each ad holds.

    A kind of token, its first three characters, is left out where no request asks for it. Kinds of which few tokens are
    asked for are looked up in place, as most ads may share one of those; the others are joined.
    """
    kind, key = F.substring("token", 1, 3), ["platform", "token"]
    counts = sorted((r[1], r[0]) for r in wanted.groupBy(kind).agg(F.count("*")).collect())
    total = np.cumsum([n for n, _ in counts])
    short = {k for (_, k), n in zip(counts, total, strict=True) if n <= BROADCAST_ROWS}
    long, texts = {k for _, k in counts} - short, {"tx:", "nm:"}

    def numbers(tokens: DataFrame, kinds: set[str]) -> DataFrame:
        sought = wanted.where(kind.isin(*kinds))
        return tokens.join(F.broadcast(sought) if kinds <= short else sought, key).select(AD, "no")

    found = [numbers(own_tokens(ads, days, kinds), kinds) for kinds in (short - texts, long - texts) if kinds]
    if texts & (short | long):
        found.append(numbers(text_tokens(ads, asked), texts & (short | long)))
    return reduce(DataFrame.unionByName, found) if found else ads.select(AD, F.lit(0).cast("bigint").alias("no")).limit(0)


def _open_or(bound: str, test: Column) -> Column:
    return F.col(bound).isNull() | test


def request_rows(asked: DataFrame) -> DataFrame:
    """Resolved requests with a number for each, the days they concern and their groups of tokens, written once."""
    return stored(with_days(asked).withColumns({"_request": F.monotonically_increasing_id(), "groups": request_groups()}), "requests")


def matched(ads: DataFrame, asked: DataFrame) -> DataFrame:
    """Every (request, ad) pair once, by number, with the ad's id and start.

    ``ads`` are numbered by `numbered`, ``asked`` come from `request_rows`.
    """
    c = F.col
    low, high = asked.agg(F.least(F.min("r_low"), F.min("r_high")), F.greatest(F.max("r_low"), F.max("r_high"))).first()
    days = None if low is None else (low, high)
    options = [c("groups"), F.array(F.array(F.lit(ANY)))]
    if days:
        options.append(F.array_compact(F.array(request_bins(*days))))
    each = asked.select("_request", "platform", F.posexplode(F.concat(*options)).alias("choice", "tokens"))
    each = stored(each.select("_request", "platform", "choice", F.explode_outer("tokens").alias("token")), "options")
    wanted = each.select("platform", "token").distinct().where("token IS NOT NULL")
    wanted = stored(wanted.withColumn("no", F.monotonically_increasing_id()), "wanted")

    held = stored(held_tokens(ads, asked, wanted, days), "held")
    rows = ads.select(AD, "ad_id", "first_seen", "last_seen").join(held.groupBy(AD).agg(F.collect_list("no").alias("tokens")), AD)
    rows = stored(rows, "index")

    counts = held.groupBy("no").agg(F.count("*").alias("n"))
    sized = each.join(wanted.join(counts, "no", "left"), ["platform", "token"], "left")
    sized = sized.groupBy("_request", "choice").agg(F.collect_list("no").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("cost"))
    choices = sized.groupBy("_request").agg(
        F.min_by(F.struct("choice", "keys"), F.struct("cost", "choice")).alias("best"), F.collect_list(F.struct("choice", "keys")).alias("all")
    )
    # Of the groups besides the one that is opened; dates are compared as they are.
    others = F.filter("all", lambda o: (o["choice"] != c("best.choice")) & (o["choice"] < F.size("groups")))
    opening = asked.join(choices, "_request").select(
        "_request", "r_first_min", "r_first_max", "r_last_min", "r_last_max",
        c("best.keys").alias("keys"), F.transform(others, lambda o: o["keys"]).alias("rest"),
    )
    opening = stored(opening.withColumn("no", F.explode("keys")), "opening")

    work = opening.groupBy("no").agg(F.count("*").alias("asking")).join(counts, "no")
    parts = F.least(F.ceil(c("n") * c("asking") / PAIRS_A_TASK), c("n")).cast("int").alias("parts")
    used = stored(work.select("no", parts), "used")
    used = F.broadcast(used) if few(used, BROADCAST_ROWS) else used
    postings = rows.withColumn("no", F.explode("tokens")).join(used, "no")
    postings = postings.select(*rows.columns, "no", F.pmod(F.xxhash64(AD), c("parts")).cast("int").alias("part"))
    asking = opening.join(used, "no").withColumn("part", F.explode(F.sequence(F.lit(0), c("parts") - 1))).drop("parts")
    tests = [
        _open_or("r_first_min", c("first_seen") >= c("r_first_min")),
        _open_or("r_first_max", c("first_seen") <= c("r_first_max")),
        _open_or("r_last_min", c("last_seen").isNull() | (c("last_seen") >= c("r_last_min"))),
        _open_or("r_last_max", c("last_seen") <= c("r_last_max")),
        (F.size("rest") == 0) | F.forall("rest", lambda group: F.arrays_overlap(group, c("tokens"))),
        # Of several keys that an ad has, the first makes the pair.
        (F.size("keys") == 1) | (c("no") == F.try_element_at(F.array_intersect("keys", "tokens"), F.lit(1))),
    ]
    met = postings.join(asking, ["no", "part"]).where(reduce(lambda a, b: a & b, tests))
    return met.select("_request", AD, "ad_id", "first_seen", "last_seen")


#: Bounds of a request, each a day once cut: an ad's first day is from the first to the second, its last one likewise.
BOUNDS = {"r_first_min": F.min, "r_first_max": F.max, "r_last_min": F.min, "r_last_max": F.max}
DAYS = [f"{name}_day" for name in BOUNDS]
#: Requests of one condition that are answered together.
REQUESTS_A_GROUP = 1 << 13
#: Counts by days that are first looked at for the rows of a request.
LOOK_BACK = 1 << 10
#: Ads of a condition on one day, on average, above which its ads are found by the day and not by 32 days.
DENSE_DAY = 16
#: Stands for the first day of ads that have none, which come last, and for the last day of those still running.
NEVER, RUNNING = -(1 << 30), 1 << 30


def by_condition(asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The requests with the number of their condition, their bounds as days and a part; and the conditions.

    A condition is all that a request asks for but its dates. It has the widest bounds of its requests, open where one of
    them is, and the columns of a request, so that `matched` takes it for one.
    """
    c = F.col
    sorted_groups = F.transform("groups", lambda group: F.array_sort(group))
    sought = ["platform", "r_text", "r_text_mode", "r_advertisers", "r_name_mode", "groups"]
    keyed = asked.withColumns({"groups": sorted_groups, "r_advertisers": F.array_sort("r_advertisers")})
    keyed = keyed.withColumn("_key", F.to_json(F.struct(*sought)))
    widest = [F.when(F.count(name) == F.count("*"), widen(name)).alias(name) for name, widen in BOUNDS.items()]
    met = keyed.groupBy("_key").agg(*[F.any_value(name).alias(name) for name in sought], *widest, F.count("*").alias("asking"))
    parts = F.ceil(c("asking") / REQUESTS_A_GROUP).cast("int")
    met = stored(with_days(met).withColumns({"_request": F.monotonically_increasing_id(), "parts": parts}), "conditions")
    numbers = met.select("_key", c("_request").alias("_condition"), "parts")
    rows = keyed.join(numbers, "_key").drop("_key", *sought)
    rows = rows.withColumns({day: _day(c(name)) for day, name in zip(DAYS, BOUNDS, strict=True)})
    return rows.withColumn("part", F.pmod(F.xxhash64("_request"), c("parts")).cast("int")), met


def condition_pairs(ads: DataFrame, conditions: DataFrame) -> DataFrame:
    """Every (condition, ad) pair once, with the ad's days."""
    days = {"first_day": F.coalesce(_day(F.col("first_seen")), F.lit(NEVER)), "last_day": F.coalesce(_day(F.col("last_seen")), F.lit(RUNNING))}
    return matched(ads, conditions).withColumnRenamed("_request", "_condition").withColumns(days).drop("last_seen")


def _up_to(first: np.ndarray, last: np.ndarray, ads: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each x and y the ads with a first day up to x and a last day up to y; first days ascend.

    The days are gone through once, whatever the number of questions.
    """
    days, rank = np.unique(last, return_inverse=True)
    upto, order = np.searchsorted(days, y, side="right"), np.argsort(x, kind="stable")
    ends, starts = np.unique(np.searchsorted(first, x[order], side="right"), return_index=True)
    held, out, done = np.zeros(len(days), np.int64), np.zeros(len(x), np.int64), 0
    for end, asked in zip(ends, np.split(order, starts[1:]), strict=False):  # Without questions there is an empty part.
        held += np.bincount(rank[done:end], ads[done:end], len(days)).astype(np.int64)
        out[asked], done = np.concatenate([[0], np.cumsum(held)])[upto[asked]], end
    return out


def _answer(requests: pa.Table, cells: pa.Table) -> pa.Table:
    """Of requests of one condition, how many ads match, and the days of the first ``wanted`` of them as bins.

    ``cells`` are the condition's ads counted by first and last day.
    """
    first, last, ads = (cells[name].to_numpy() for name in ("first_day", "last_day", "ads"))
    order = np.argsort(first, kind="stable")
    first, last, ads = first[order], last[order], ads[order]

    def bound(name: str, otherwise: int) -> np.ndarray:
        return requests[name].fill_null(otherwise).to_numpy().astype(np.int64)

    # Ads without a first day match where no first day is asked for.
    dated = requests[DAYS[0]].is_valid().to_numpy() | requests[DAYS[1]].is_valid().to_numpy()
    low, high, last_low, last_high = (bound(name, o) for name, o in zip(DAYS, (NEVER, RUNNING, NEVER, RUNNING), strict=True))
    low = np.where(dated, np.maximum(low, NEVER + 1), low)
    n = [_up_to(first, last, ads, x, y) for x, y in ((high, last_high), (low - 1, last_high), (high, last_low - 1), (low - 1, last_low - 1))]
    n = np.where((low > high) | (last_low > last_high), 0, n[0] - n[1] - n[2] + n[3])

    first, last, ads = first[::-1], last[::-1], ads[::-1]
    fine = bool(ads.sum() > DENSE_DAY * len(np.unique(first)))
    starts, ends = np.searchsorted(-first, -high), np.searchsorted(-first, -low, side="right")
    lowest, bins = [], []
    for k, wanted in enumerate(requests["wanted"].to_pylist()):
        if not wanted or not n[k]:
            lowest.append(None)
            bins.append([] if wanted else None)
            continue
        size = LOOK_BACK
        while True:  # The rows wanted mostly lie in the latest days.
            here = slice(starts[k], min(ends[k], starts[k] + size))
            kept = (last[here] >= last_low[k]) & (last[here] <= last_high[k])
            sums = np.cumsum(ads[here][kept])
            if here.stop == ends[k] or (len(sums) and sums[-1] >= wanted):
                break
            size *= 4
        days = first[here][kept][: int(np.searchsorted(sums, wanted)) + 1]
        lowest.append(int(days[-1]))
        bins.append(np.unique(days if fine else days // NARROW_DAYS))
    return pa.table({
        **{name: requests[name] for name in ("_request", "_condition")},
        "n": pa.array(n, pa.int64()), "lowest": pa.array(lowest, pa.int32()),
        "fine": pa.array([fine] * len(n), pa.bool_()), "bins": pa.array(bins, pa.list_(pa.int32())),
    })


def answers(pairs: DataFrame, asked: DataFrame, conditions: DataFrame, wanted: Column) -> DataFrame:
    """Per request that matches any ad its number of matches ``n``; and of the first ``wanted`` of them, the ``lowest``
    first day and the ``bins`` of days that hold them: days if ``fine``, else 32 days.

    ``pairs`` come from `condition_pairs`, ``asked`` and ``conditions`` from `by_condition`. A group has a condition's
    counts by days, whose number the calendar bounds, and `REQUESTS_A_GROUP` requests or about that.
    """
    # Written, as it is read twice and the pairs are what takes time.
    cells = stored(pairs.groupBy("_condition", "first_day", "last_day").agg(F.count("*").alias("ads")), "cells")
    parts = conditions.select(F.col("_request").alias("_condition"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    cells = cells.join(parts, "_condition")
    rows = asked.select("_request", "_condition", "part", *DAYS, wanted.cast("bigint").alias("wanted"))
    rows = rows.join(cells.select("_condition").distinct(), "_condition", "left_semi")
    schema = "_request long, _condition long, n long, lowest int, fine boolean, bins array<int>"
    return rows.groupBy("_condition", "part").cogroup(cells.groupBy("_condition", "part")).applyInArrow(_answer, schema).where("n > 0")


def first_matches(pairs: DataFrame, asked: DataFrame, found: DataFrame) -> DataFrame:
    """(request, ad) pairs of the first rows that `answers` counted: all matches from the lowest day on."""
    c = F.col
    days = F.when(c("fine"), c("first_day")).otherwise(F.floor(c("first_day") / NARROW_DAYS)).cast("int")
    placed = pairs.join(found.select("_condition", "fine").distinct(), "_condition").withColumn("bin", days).drop("fine")
    opened = found.select("_request", "lowest", F.explode("bins").alias("bin")).join(asked.select("_request", "_condition", *DAYS), "_request")
    none = c("first_day") == NEVER
    tests = [
        c("first_day") >= c("lowest"),
        _open_or(DAYS[0], ~none & (c("first_day") >= c(DAYS[0]))),
        _open_or(DAYS[1], ~none & (c("first_day") <= c(DAYS[1]))),
        _open_or(DAYS[2], c("last_day") >= c(DAYS[2])),
        _open_or(DAYS[3], c("last_day") <= c(DAYS[3])),
    ]
    met = placed.join(opened, ["_condition", "bin"]).where(reduce(lambda a, b: a & b, tests))
    return met.select("_request", AD, "ad_id", "first_seen")


def numbered(ads: DataFrame) -> DataFrame:
    """The ads with a number for each row, written once, as several steps refer to it."""
    return stored(ads.withColumn(AD, F.monotonically_increasing_id()), "ads")
