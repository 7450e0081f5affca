"""Mixed timestamp formats and zones to one UTC instant (problem 4).

Text is parsed to local clock parts by JVM regular expressions; the local time is then looked up in the intervals of
constant offset of its zone: one interval gives the offset, two mean an ambiguous time, none a time that was skipped.
Intervals are exploded to years, so the as-of join is an equality join on (zone, year) followed by a filter.
"""

from __future__ import annotations

import datetime as dt
import zoneinfo
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = 86_400
FIRST_YEAR, LAST_YEAR = 1900, 2200
#: Before and after every instant a text with a four-digit year can name, in seconds since 1970.
ALWAYS = 1 << 40

#: The months by name and abbreviation in English, Spanish, German, French and Portuguese.
MONTHS = (
    ("january", "jan", "enero", "ene", "januar", "jän", "janvier", "janv", "janeiro"),
    ("february", "feb", "febrero", "februar", "février", "févr", "fevrier", "fevereiro", "fev", "fév"),
    ("march", "mar", "marzo", "märz", "maerz", "mär", "mrz", "mars", "março", "marco"),
    ("april", "apr", "abril", "abr", "avril", "avr"),
    ("may", "mayo", "mai", "maio"),
    ("june", "jun", "junio", "juni", "juin", "junho"),
    ("july", "jul", "julio", "juli", "juillet", "juil", "julho"),
    ("august", "aug", "agosto", "ago", "août", "aout"),
    ("september", "sep", "sept", "septiembre", "septembre", "setembro", "set"),
    ("october", "oct", "octubre", "oktober", "okt", "octobre", "outubro", "out"),
    ("november", "nov", "noviembre", "novembre", "novembro"),
    ("december", "dec", "diciembre", "dic", "dezember", "dez", "décembre", "déc", "dezembro"),
)

_NAME = r"([\p{L}]{3,12})"
_YEAR_FIRST = r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?:(?:\s*,\s*|[Tt\s]+)(.*)|(Z|[+-]\d.*)|)$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:[Tt ]?(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d{1,9}))?)?\s*(.*))?$"
_NUMERIC = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4}|\d{2})(?:(?:\s*,\s*|[Tt\s]+)(.*)|)$"
_DAY_NAME = r"^(?:\p{L}{2,10}\.?,\s*)?(\d{1,2})(?:\.|st|nd|rd|th|º|er)?[\s-]+(?:de\s+)?" + _NAME + r"\.?,?[\s-]+(?:de\s+)?(\d{4}|\d{2})(?:(?:\s*,\s*|[Tt\s]+)(.*)|)$"
_NAME_DAY = r"^(?:\p{L}{2,10}\.?,\s*)?" + _NAME + r"\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4}|\d{2})(?:(?:\s*,\s*|[Tt\s]+)(.*)|)$"
_CLOCK = r"^(?:(?:um|at|à|a las|às)\s+)?(\d{1,2})(?:[:h.](\d{2})|\s?(?=[AaPp]\.?[Mm]))(?:[:.](\d{2})(?:[.,](\d{1,9}))?)?\s*(?:([AaPp])\.?[Mm]\.?(?![A-Za-z/])|Uhr|hs?\b)?\s*(.*)$"
_OFFSET = r"^(?:UTC|GMT)?([+-])(\d{1,2})(?::?(\d{2}))?(?::?(\d{2}))?(?:\s*[\[(].*[\])])?$"
_ZONE = r"^[\[(]?([A-Za-z]+(?:/[A-Za-z0-9_+-]+)+)[\])]?$"

#: The forms of a date and how each is laid out: its letter, then year, month, day (or the numbers as they stand) and the rest.
_FORMS = (
    (r"^(\d{9,10}|\d{12,13})$", "e|$1|||"), (_YEAR_FIRST, "y|$1|$3|$4|$5$6"), (_COMPACT, "c|$1|$2|$3|$4:$5:$6.$7 $8"),
    (_NUMERIC, "n|$4|$1|$3|$5"), (_DAY_NAME, "d|$3|$2|$1|$4"), (_NAME_DAY, "m|$3|$1|$2|$4"),
)


def _month(c: Column) -> Column:
    out = F.lit(None).cast("int")
    t = F.lower(c)
    for n, names in reversed(list(enumerate(MONTHS, 1))):
        out = F.when(t.isin(*names), n).otherwise(out)
    return out


def _int(c: Column) -> Column:
    return c.try_cast("int")


def epoch_day(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a date of the Gregorian calendar, null where there is no such date."""
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    last = F.when(m.isin(4, 6, 9, 11), 30).when((m == 2) & leap, 29).when(m == 2, 28).otherwise(31)
    yy = F.when(m <= 2, y - 1).otherwise(y)
    era = F.floor(yy / 400)
    yoe = yy - era * 400
    doy = F.floor((F.lit(153) * (m + F.when(m > 2, -3).otherwise(9)) + 2) / 5) + d - 1
    doe = yoe * 365 + F.floor(yoe / 4) - F.floor(yoe / 100) + doy
    return F.when((y >= 1) & m.between(1, 12) & (d >= 1) & (d <= last), (era * 146097 + doe - 719468).cast("bigint"))


def parse_clock(df: DataFrame, value: str, month_first: Column, prefix: str = "_t_") -> DataFrame:
    """Adds the parsed parts of ``value``.

    {prefix}local_s, {prefix}us: the clock as written in seconds since 1970 and microseconds of the second, null where
    the text names no date and time; {prefix}year; {prefix}off: the offset in seconds, where one is written;
    {prefix}zone: a written zone name in lower case. month_first: whether 03/04/2024 has its month first; null where
    that is not known, then the text is valid if either order is.
    """
    p = prefix
    col = lambda n: F.col(p + n)
    at = lambda n, k: F.get(col(n), F.lit(k))
    # Every step is a column of its own: the next step refers to it more than once, and so it is computed once.
    # One replacement per form, each over the result of the one before: what a form has taken begins with a mark that no
    # later form can match, so a text is read by no more than the forms up to its own, and each only once.
    t = F.trim(F.regexp_replace(F.col(value), r"[\s\u00a0\x01]+", " "))
    for pattern, parts in _FORMS:
        t = F.regexp_replace(t, pattern, "\x01" + parts)
    df = df.withColumn(f"{p}a", F.split(t, r"\|", 5))
    df = df.withColumn(f"{p}f", F.when(F.startswith(at("a", 0), F.lit("\x01")), F.substring(at("a", 0), 2, 1)))
    df = df.withColumn(f"{p}a", F.when(col("f").isNotNull(), F.slice(col("a"), 2, 4)))
    f = col("f")
    # A compact date leaves "::." behind where it has no clock, "hh:mm:." where it has no seconds.
    rest = F.regexp_replace(F.regexp_replace(at("a", 3), r"^(\d{2}):(\d{2}):\.", "$1:$2 "), r"^::\.|(?<=\d)\.(?= |$)", "")
    year = _int(at("a", 0))
    named = f.isin("d", "m")
    df = df.withColumns({
        f"{p}y": F.when(f != "e", F.when(F.length(at("a", 0)) == 2, year + 2000).otherwise(year)), f"{p}one": F.when(named, _month(at("a", 1))).otherwise(_int(at("a", 1))), f"{p}two": _int(at("a", 2)),
        f"{p}r": F.trim(rest), f"{p}m": month_first,
    })
    # The month is the first number unless the place reads the day first; where the place is not known either may hold.
    swap = (f == "n") & F.coalesce(~col("m"), col("one") > 12)
    df = df.withColumns({f"{p}mo": F.when(swap, col("two")).otherwise(col("one")), f"{p}d": F.when(swap, col("one")).otherwise(col("two"))})
    df = df.withColumn(f"{p}day", epoch_day(col("y"), col("mo"), col("d")))
    r = col("r")
    df = df.withColumn(f"{p}c", F.split(F.regexp_replace(F.coalesce(r, F.lit("")), _CLOCK, "\x01$1|$2|$3|$4|$5|$6"), r"\|", 6))
    # Without a clock all that is left is the zone.
    none = F.concat(F.array(*[F.lit("")] * 5), F.array(F.coalesce(r, F.lit(""))))
    df = df.withColumn(f"{p}c", F.when(F.startswith(at("c", 0), F.lit("\x01")), F.concat(F.array(F.substring(at("c", 0), 2, 2)), F.slice(col("c"), 2, 5))).otherwise(none))
    hour, half = _int(at("c", 0)), F.lower(at("c", 4))
    df = df.withColumns({
        f"{p}h": F.when(at("c", 0) == "", 0).when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0)),
        f"{p}mi": F.when(at("c", 1) == "", 0).otherwise(_int(at("c", 1))), f"{p}s": F.when(at("c", 2) == "", 0).otherwise(_int(at("c", 2))), f"{p}z": F.trim(at("c", 5)),
    })
    zone = col("z")
    df = df.withColumn(f"{p}o", F.when(zone.rlike("[0-9]"), F.split(F.regexp_replace(zone, _OFFSET, "\x01$1|$2|$3|$4"), r"\|")))
    df = df.withColumn(f"{p}o", F.when(F.startswith(at("o", 0), F.lit("\x01")), F.concat(F.array(F.substring(at("o", 0), 2, 1)), F.slice(col("o"), 2, 3))))
    o = lambda k: F.coalesce(_int(at("o", k)), F.lit(0))
    off_s = F.when(zone.rlike(r"^(?i)(?:Z|UTC|Zulu)(?:\s*\[.*\])?$") | (f == "e"), 0).when(
        col("o").isNotNull() & (o(1) <= 18) & (o(2) <= 59), (o(1) * 3600 + o(2) * 60 + o(3)) * F.when(at("o", 0) == "-", -1).otherwise(1)
    )
    df = df.withColumns({f"{p}off": off_s, f"{p}zone": F.when(zone.rlike(_ZONE), F.lower(F.regexp_replace(zone, _ZONE, "$1")))})
    # Letters alone are an abbreviation and mean the zone of the place; anything else is no time.
    known = col("off").isNotNull() | col("zone").isNotNull() | zone.rlike(r"^[A-Za-z]{0,5}$")
    good = col("h").between(0, 23) & col("mi").between(0, 59) & col("s").between(0, 59) & known
    bare = F.when(f == "e", at("a", 0).try_cast("bigint"))
    is_ms = F.length(at("a", 0)) >= 12
    local_s = F.when(f == "e", F.when(is_ms, F.floor(bare / 1000)).otherwise(bare)).when(good, col("day") * DAY + col("h") * 3600 + col("mi") * 60 + col("s"))
    us = F.when((f == "e") & is_ms, (bare % 1000) * 1000).when(at("c", 3) == "", 0).otherwise(_int(F.rpad(F.substring(at("c", 3), 1, 6), 6, "0")))
    df = df.withColumns({f"{p}local_s": local_s.cast("bigint"), f"{p}us": F.coalesce(us, F.lit(0)).cast("int")})
    return df.withColumn(f"{p}year", span_year(col("local_s"))).drop(*[p + n for n in ("f", "a", "y", "one", "two", "r", "m", "mo", "d", "day", "c", "h", "mi", "s", "z", "o")])


def offset_spans(zone: str, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> list[tuple[int, int, int]]:
    """The spans (lo, hi, off) of constant offset of a zone, in UTC seconds; the first and the last are open.

    Weeks whose start and end differ in offset are halved until the second of the change is found.
    """
    tz = zoneinfo.ZoneInfo(zone)
    base = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)
    off = lambda s: int((base + dt.timedelta(seconds=s)).astimezone(tz).utcoffset().total_seconds())
    a, end = ((dt.date(y, 1, 1) - base.date()).days * DAY for y in (first_year, last_year))
    lo, now, out = -ALWAYS, off(a), []
    while a < end:
        b = a + 7 * DAY
        then = off(b)
        if then != now:
            x, y = a, b
            while y - x > 1:
                mid = (x + y) // 2
                x, y = (mid, y) if off(mid) == now else (x, mid)
            out.append((lo, y, now))
            lo, now = y, then
        a = b
    return [*out, (lo, ALWAYS, now)]


def offset_intervals(spark: SparkSession, zones: Iterable[str], first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """(zone_key, year, spans): of each zone and year the spans (lo, hi, off) of constant offset near that year.

    The first and last year also hold all that lies before and after. Reference data made on the driver: at most the
    600 zone names of the tz database by 301 years.
    """
    rows = []
    year_of = lambda s: min(max(1970 + int(s // (365.2425 * DAY)), first_year), last_year)
    for z in sorted(zones):
        by_year: dict[int, list[tuple[int, int, int]]] = {}
        for span in offset_spans(z, first_year, last_year):
            for y in range(year_of(span[0] - 3 * DAY), year_of(span[1] + 3 * DAY) + 1):
                by_year.setdefault(y, []).append(span)
        rows += [(z.lower(), y, spans) for y, spans in by_year.items()]
    return spark.createDataFrame(rows, "zone_key string, year int, spans array<struct<lo: bigint, hi: bigint, off: int>>")


def zones_used(texts: DataFrame, value: str, places: DataFrame, place_zone: str) -> list[str]:
    """The zones of the places and those that texts name, of those in the tz database (an action; at most 600). The
    texts may be raw deliveries: a zone more than is used does no harm, and nothing has to be deduplicated first."""
    names = {n.lower(): n for n in sorted(zoneinfo.available_timezones()) if "/" in n or n in ("UTC", "GMT")}
    written = texts.where(F.col(value).rlike("[A-Za-z]/[A-Za-z]")).select(F.lower(F.regexp_extract(F.col(value), r"([A-Za-z]+(?:/[A-Za-z0-9_+-]+)+)", 1)).alias("zone_key"))
    both = places.select(F.lower(F.trim(F.col(place_zone))).alias("zone_key")).unionByName(written)
    return [names[r.zone_key] for r in both.where(F.col("zone_key").isin(*names)).distinct().collect()]


def span_year(local_s: Column, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> Column:
    """The year under which offset_intervals holds a time in seconds."""
    return F.least(F.greatest(F.year(F.date_from_unix_date(F.floor(local_s / DAY).cast("int"))), F.lit(first_year)), F.lit(last_year))


def utc_text(seconds: Column, us: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.ffffffZ`` of UTC seconds and microseconds, whatever the session's zone."""
    day = F.floor(seconds / DAY)
    s = seconds - day * DAY
    date = F.date_from_unix_date(day.cast("int")).cast("string")
    return F.concat(date, F.lit("T"), F.format_string("%02d:%02d:%02d.%06dZ", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60, us.cast("bigint")))


def normalise(df: DataFrame, value: str, place_zone: str, locale: str, intervals: DataFrame | None = None) -> DataFrame:
    """Adds to each row what the text in ``value`` means.

    status: ``ok``, ``invalid``, ``zoneless``, ``skipped``, ``ambiguous``; utc_s, us: the instant, where ok; local_s: the
    clock as written, null where invalid; written_zone: whether the text itself fixes the zone.
    Null and blank texts are invalid. Rows are kept one to one; the intervals are bounded and broadcast, so the data
    are not shuffled. Columns named _t_* and spans are reserved.
    """
    month_first = F.when(F.col(place_zone).isNotNull() | F.col(locale).isNotNull(), F.coalesce(F.trim(F.col(locale)), F.lit("")) == "en-US")
    intervals = offset_intervals(df.sparkSession, zones_used(df, value, df, place_zone)) if intervals is None else intervals
    out = parse_clock(df, value, month_first)
    out = out.withColumn("_t_key", F.coalesce("_t_zone", F.lower(F.trim(F.col(place_zone)))))
    look = F.broadcast(intervals.select(F.col("zone_key").alias("_t_key"), F.col("year").alias("_t_year"), F.col("spans").alias("_t_spans")))
    out = out.join(look, ["_t_key", "_t_year"], "left")
    t = F.col("_t_local_s")
    found = F.filter("_t_spans", lambda x: (x["lo"] + x["off"] <= t) & (t < x["hi"] + x["off"]))
    out = out.withColumn("_t_hit", F.when(F.col("_t_off").isNull(), found))
    n = F.size("_t_hit")
    status = (
        F.when(t.isNull(), "invalid").when(F.col("_t_off").isNotNull(), "ok").when(F.col("_t_key").isNull(), "zoneless")
        .when(F.col("_t_spans").isNull(), F.when(F.col("_t_zone").isNotNull(), "invalid").otherwise("zoneless"))
        .when(n == 0, "skipped").when(n > 1, "ambiguous").otherwise("ok")
    )
    out = out.withColumns({
        "status": status, "utc_s": t - F.coalesce("_t_off", F.when(n == 1, F.get("_t_hit", F.lit(0))["off"])), "us": F.col("_t_us"), "local_s": t,
        "written_zone": F.col("_t_off").isNotNull() | F.col("_t_zone").isNotNull(),
    })
    return out.drop(*[c for c in out.columns if c.startswith("_t_")])
