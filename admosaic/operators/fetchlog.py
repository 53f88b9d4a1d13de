"""Accounting on landed pages and on the log of fetches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.registry import platform_limits
from ..sources.registry_values import DEFAULT_RATE_LIMITS
from .storage import stored

FETCH_LOG = (
    "ts timestamp, platform string, endpoint string, status int, retry_after string, usage_header string, body string"
)
_PAGE = ["platform", "request_id", "page_no"]


def distinct_pages(counters: DataFrame) -> DataFrame:
    """One row per (platform, request, page) with the number of copies; values of the copy fetched last.

    Of copies fetched at the same moment the fullest counts, then the one with the later next position.
    """
    values = ["items", "total_count", "next_position"]
    values += [name for name in ("readable",) if name in counters.columns]
    newest = F.max_by(F.struct(*values), F.struct("fetched_at", *values))
    return (
        counters.groupBy(*_PAGE)
        .agg(F.count("*").alias("copies"), newest.alias("v"))
        .select(*_PAGE, "copies", "v.*")
    )


def page_audit(counters: DataFrame) -> DataFrame:
    """What follows each landed page, and what is missing.

    ``state`` is ``followed`` or ``missing_next`` when the page names a next position, else ``last`` or
    ``past_end`` when a later page is there all the same; ``gap_before`` marks pages whose predecessor
    did not land. A page tells its neighbours about itself, so a request is never gathered in one task;
    only numbers are merged, which Spark does in a hash table.
    """
    pages = distinct_pages(counters.drop("readable"))

    def told(shift: int, before: int, after: int, own: bool) -> Column:
        def mine(column: Column, name: str) -> Column:
            return (column if own else F.lit(None).cast("bigint")).alias(name)

        return F.struct(
            (F.col("page_no") + shift).alias("page_no"),
            F.lit(before).alias("before"),
            F.lit(after).alias("after"),
            mine(F.col("copies"), "copies"),
            mine(F.col("items"), "items"),
            mine(F.col("next_position").isNotNull().cast("bigint"), "more"),
        )

    notes = pages.select(
        "platform",
        "request_id",
        F.inline(F.array(told(0, 0, 0, True), told(1, 1, 0, False), told(-1, 0, 1, False))),
    )
    merged = notes.groupBy(*_PAGE).agg(*[F.max(name).alias(name) for name in ("copies", "items", "more", "before", "after")])
    more, after = F.col("more") == 1, F.col("after") == 1
    state = (
        F.when(more & after, "followed").when(more, "missing_next").when(after, "past_end").otherwise("last")
    )
    return merged.filter(F.col("copies").isNotNull()).select(
        *_PAGE,
        "items",
        "copies",
        state.alias("state"),
        ((F.col("page_no") > 0) & (F.col("before") == 0)).alias("gap_before"),
    )


def audit_summary(audit: DataFrame) -> DataFrame:
    """Pages by request and fault: repeated, with a gap before, without their next page."""
    return audit.groupBy("platform", "request_id").agg(
        F.count("*").alias("pages"),
        F.sum(F.col("copies") - 1).alias("repeats"),
        F.count_if("gap_before").alias("gaps"),
        F.count_if(F.col("state") == "missing_next").alias("missing_next"),
        F.count_if(F.col("state") == "past_end").alias("past_end"),
    )


def collect_pages(counters: DataFrame, max_pages: int | None = None) -> DataFrame:
    """The pages of each request that count as collected: those before its first empty one, and of these the first
    ``max_pages`` if that is given.

    Only a well-formed page ends a request; one that cannot be read, or that reports an error, is passed over. The
    first empty page of a request is a minimum, so a request with many pages is never gathered in one task.
    """
    if max_pages is not None and max_pages < 1:
        raise ValueError("max_pages must be at least 1")
    pages = distinct_pages(counters if max_pages is None else counters.filter(F.col("page_no") < max_pages))
    empty = F.col("items") == 0
    if "readable" in pages.columns:
        empty = empty & F.col("readable")
    ends = pages.filter(empty).groupBy("platform", "request_id").agg(F.min("page_no").alias("_end"))
    before = F.col("_end").isNull() | (F.col("page_no") < F.col("_end"))
    ends = ends.toDF("_platform", "_request", "_end")
    same = F.col("platform").eqNullSafe(F.col("_platform")) & F.col("request_id").eqNullSafe(F.col("_request"))
    kept = pages.join(ends, same, "left").filter(before & (F.col("items") > 0))
    return kept.drop("_platform", "_request", "_end", "readable")


def collected_bodies(pages: DataFrame, collected: DataFrame) -> DataFrame:
    """The landed pages that `collect_pages` keeps, bodies included."""
    kept = collected.select(*[F.col(name).alias(f"_{name}") for name in _PAGE])
    return pages.join(kept, reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in _PAGE]), "left_semi")


def page_chains(pages: DataFrame) -> DataFrame:
    """Whether the pages of each request follow from one another by their positions, not only by their numbers.

    ``pages`` have platform, request_id, page_no, position (where the page starts; NULL for the first) and next_position;
    of repeated pages any copy counts that names the latest next position. A page is succeeded by the page that starts at
    its next position, the one numbered next if several do, else the first of them. Jumps along this are doubled until
    they reach the end, so a request of n pages takes about log2(n) rounds, each a join on the page; whatever has not
    ended by then runs in a circle, and the pages that such runs lie on are the loop.

    ``state``: ``loop`` for pages on a circle; ``wrong_position`` if the page numbered next starts elsewhere;
    ``missing_next`` if nothing starts at the next position; ``branch`` if an earlier page starts where this one does;
    ``past_end`` if there is no next position but a page numbered next; else ``followed`` or ``last``. ``steps`` is the
    number of pages that come after it by position, NULL if these end in a loop. Pages without a number have no place in a
    request and are left out; a NULL platform or request counts as one of its own.
    """
    c, page, request = F.col, ["request", "page_no"], F.struct("platform", "request_id")
    best = F.max_by(F.struct("position", "next_position"), F.struct("next_position", "position"))
    once = pages.where("page_no IS NOT NULL").groupBy(request.alias("request"), "page_no").agg(best.alias("v"))
    once = stored(once.select(*page, "v.*", F.struct("request", F.coalesce("v.position", F.lit("")).alias("position")).alias("at")), "pages")
    starts = once.groupBy("at").agg(F.min("page_no").alias("first"))
    to = F.struct("request", c("next_position").alias("position"))
    named = once.where("next_position IS NOT NULL").select(*page, to.alias("to"))
    # As many rows as pages, of which the plan only sees how small the files are.
    found = named.join(starts.select(c("at").alias("to"), "first"), "to").select(*page, "first").hint("merge")
    # The page numbered next, if it is there: told by itself, so that no request is gathered.
    told = once.select("request", (c("page_no") - 1).alias("page_no"), F.struct("position").alias("after"))
    placed = once.join(told, page, "left").join(found, page, "left").join(starts.select("at", c("first").alias("same")), "at")
    fits = c("after.position") == c("next_position")
    placed = placed.withColumn("to", F.when(fits, c("page_no") + 1).otherwise(c("first")))
    placed = stored(placed.select(*page, "position", "next_position", "after", "same", "to"), "placed")

    longest = placed.groupBy("request").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    jumps = placed.select(*page, "to", c("to").isNotNull().cast("bigint").alias("steps"))
    for _ in range(max(1, longest).bit_length()):
        ahead = jumps.select("request", c("page_no").alias("to"), c("to").alias("then"), c("steps").alias("more"))
        jumps = jumps.join(ahead, ["request", "to"], "left").select(
            *page, c("then").alias("to"), (c("steps") + F.coalesce("more", F.lit(0))).alias("steps")
        )
        jumps = stored(jumps, "jumps")
    circle = jumps.where("to IS NOT NULL").select("request", c("to").alias("page_no")).distinct().withColumn("circle", F.lit(True))
    known = placed.drop("to").join(jumps.select(*page, c("to").alias("runs"), "steps"), page).join(circle, page, "left")
    lands = c("steps") > 0
    state = (
        F.when(c("circle"), "loop")
        .when(c("next_position").isNotNull() & c("after").isNotNull() & ~F.coalesce(fits, F.lit(False)), "wrong_position")
        .when(c("next_position").isNotNull() & ~lands, "missing_next")
        .when(c("same") < c("page_no"), "branch")
        .when(c("next_position").isNotNull(), "followed")
        .when(c("after").isNotNull(), "past_end")
        .otherwise("last")
    )
    return known.select("request.*", "page_no", "position", "next_position", state.alias("state"), F.when(c("runs").isNull(), c("steps")).alias("steps"))


def page_totals(counters: DataFrame) -> DataFrame:
    """Items and pages collected per request."""
    per_page = counters.groupBy(*_PAGE).agg(F.sum("items").alias("items"))
    return per_page.groupBy("platform", "request_id").agg(
        F.sum("items").alias("items"), F.count("*").alias("pages_fetched")
    )


def quota_usage(fetch_log: DataFrame, period: str = "hour") -> DataFrame:
    """Fetches by platform and hour or day against the platform's limit; works on a stream as well."""
    window = F.window("ts", f"1 {period}")
    counted = fetch_log.groupBy(window.alias("w"), "platform").agg(F.count("*").alias("requests"))
    limits = platform_limits(fetch_log.sparkSession).select("platform", f"requests_per_{period}")
    allowed = F.coalesce(f"requests_per_{period}", F.lit(DEFAULT_RATE_LIMITS[f"requests_per_{period}"]))
    return counted.join(F.broadcast(limits), "platform", "left").select(
        "platform",
        F.col("w.start").alias("period_start"),
        "requests",
        allowed.cast("bigint").alias("allowed"),
        (F.col("requests") > allowed).alias("over_limit"),
    )


#: Seconds of the periods that sources limit, and by how many a sliding window of each moves.
PERIODS = {"minute": (60, 10), "hour": (3600, 300), "day": (86_400, 3600)}


def quota_counts(fetch_log: DataFrame, periods: list[str] | None = None, sliding: bool = False) -> DataFrame:
    """Fetches by platform, period and start of the window, for several periods at once; counts of parts of a log add up.

    A fetch is counted once for each period, in the step it falls in; only the counts of steps are spread over the
    windows that slide across them. Fetches without a time are in no window.
    """
    c = F.col
    shapes = []
    for name in periods or PERIODS:
        length, step = PERIODS[name]
        step = step if sliding else length
        at = (F.floor(F.unix_timestamp("ts") / step) * step).alias("at")
        shapes.append(F.struct(F.lit(name).alias("period"), F.lit(length).alias("length"), F.lit(step).alias("step"), at))
    steps = fetch_log.where("ts IS NOT NULL").select("platform", F.inline(F.array(*shapes)))
    steps = steps.groupBy("platform", "period", "length", "step", "at").agg(F.count("*").alias("requests"))
    start = F.explode(F.sequence(c("at") - c("length") + c("step"), c("at"), c("step").cast("bigint"))).alias("start")
    windows = steps.select("platform", "period", start, "requests").groupBy("platform", "period", "start")
    return windows.agg(F.sum("requests").alias("requests"))


def against_limits(counts: DataFrame) -> DataFrame:
    """`quota_counts` with what the platform allows in the period, platforms without a limit for a period left out.

    Sources that are not registered have the default limits; there is none for a minute.
    """
    limits = platform_limits(counts.sparkSession)
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("period"), F.col(f"requests_per_{p}").alias("allowed")) for p in PERIODS]))
    limits = limits.select("platform", each.alias("x")).select("platform", "x.*")
    default = F.lit(None).cast("bigint")
    for period in PERIODS:
        if f"requests_per_{period}" in DEFAULT_RATE_LIMITS:
            default = F.when(F.col("period") == period, F.lit(DEFAULT_RATE_LIMITS[f"requests_per_{period}"])).otherwise(default)
    joined = counts.join(F.broadcast(limits), ["platform", "period"], "left").withColumn("allowed", F.coalesce("allowed", default))
    return joined.where("allowed IS NOT NULL").select(
        "platform", "period", F.timestamp_seconds("start").alias("period_start"), "requests",
        F.col("allowed").cast("bigint").alias("allowed"), (F.col("requests") > F.col("allowed")).alias("over_limit"),
    )


def quota_windows(fetch_log: DataFrame, periods: list[str] | None = None, sliding: bool = True) -> DataFrame:
    """Fetches in every window of a minute, an hour and a day, sliding or not, against the platform's limits."""
    return against_limits(quota_counts(fetch_log, periods, sliding))


def usage_wait(usage: Column) -> Column:
    """Seconds to wait at a usage in percent."""
    return (
        F.when(usage > 95, 90).when(usage > 90, 30).when(usage > 80, 10).when(usage > 75, 5).when(usage > 50, 3)
    ).otherwise(1)


def usage_tier(fetch_log: DataFrame, max_usage_limit: int = 50) -> DataFrame:
    """Fetches with the highest of call, CPU and time usage and the wait it asks for.

    Of a header with several accounts, or several entries for one, the highest counts. A header that cannot be read
    counts as no usage; below the limit there is no wait.
    """
    numbers = "call_count double, total_cputime double, total_time double"
    header = F.col("usage_header")
    wrapped = F.map_values(F.from_json(header, "map<string, string>"))
    entries = f"array<struct<{numbers.replace(' double', ': double')}>>"

    def listed(inner: Column) -> Column:
        text = F.when(inner.startswith("["), inner).when(inner.startswith("{"), F.concat(F.lit("["), inner, F.lit("]")))
        return F.coalesce(F.from_json(text, entries), F.array().cast(entries))

    nested = F.coalesce(F.flatten(F.transform(wrapped, listed)), F.array().cast(entries))
    usage = F.concat(nested, F.array_compact(F.array(F.from_json(header, numbers))))
    parsed = fetch_log.withColumn("_u", usage)
    each = F.transform("_u", lambda u: F.greatest(u["call_count"], u["total_cputime"], u["total_time"]))
    highest = F.coalesce(F.array_max(each), F.lit(0.0))
    waits = F.when(F.col("max_usage") > max_usage_limit, usage_wait(F.col("max_usage"))).otherwise(0)
    return parsed.withColumn("max_usage", highest).withColumn("wait_seconds", waits).drop("_u")


def classify_errors(fetch_log: DataFrame) -> DataFrame:
    """Fetches with their error class, wait, message and whether to try again."""
    c, status = F.col, F.col("status")
    kind = (
        F.when(status.between(200, 299), "ok")
        .when(status.isin(401, 403), "auth")
        .when(status == 429, "rate_limit")
        .when(status.between(400, 499), "client")
        .when(status >= 500, "server")
        .otherwise("http")
    )
    said = F.coalesce(
        *[F.get_json_object("body", f"$.{name}") for name in ("message", "error", "debug_message", "display_message")]
    )
    is_json = F.try_parse_json("body").isNotNull()
    message = F.when(kind != "ok", F.coalesce(said, F.when(is_json, F.lit("Unknown error")), c("body")))
    short = F.length("body").between(1, 499)
    return fetch_log.select(
        "*",
        kind.alias("error_class"),
        F.when(status == 429, c("retry_after").try_cast("double")).alias("retry_seconds"),
        message.alias("message"),
        F.when((kind != "ok") & short, c("body")).alias("kept_body"),
        (kind == "server").alias("retryable"),
    )


def fetch_errors(fetch_log: DataFrame) -> DataFrame:
    """Number of fetches by platform and class, with the longest wait asked for."""
    return classify_errors(fetch_log).groupBy("platform", "error_class").agg(
        F.count("*").alias("n"),
        F.max("retry_seconds").alias("max_retry_seconds"),
        F.count_if("retryable").alias("retryable"),
    )
