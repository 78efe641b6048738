"""Reading of written times: local clock time, offset and precision, without guessing.

Everything is built from Catalyst expressions. A text is rearranged once into
the fields year|month|day|hour|minute|second|fraction|half|zone by the first
pattern that fits it as a whole, and the fields are then read strictly:
impossible dates and hours give null, never a shifted value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CANONICAL = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$"

_ZONE = r"([Zz]|[+-]\d\d(?::?\d\d)?|(?:GMT|UTC)[+-]\d{1,2}(?::?\d\d)?|[A-Z]{2,5})?"
_DAY = r"(?:(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),?\s+)?"

#: (pattern, rearrangement), tried in this order.
FORMS = [
    (rf"^(\d{{4}})-(\d\d)-(\d\d)[Tt ](\d\d):(\d\d)(?::(\d\d)(?:[.,](\d{{1,12}}))?)?\s*{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    (rf"^(\d{{4}})(\d\d)(\d\d)[Tt](\d\d)(\d\d)(\d\d)(?:[.,](\d{{1,12}}))?\s*{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    (rf"^(\d{{4}})/(\d\d?)/(\d\d?) (\d\d?):(\d\d)(?::(\d\d)(?:[.,](\d{{1,12}}))?)?\s*{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    (rf"^(\d\d?)\.(\d\d?)\.(\d{{4}}),? (\d\d?):(\d\d)(?::(\d\d)(?:[.,](\d{{1,12}}))?)?\s*{_ZONE}$", "$3|$2|$1|$4|$5|$6|$7||$8"),
    (rf"^{_DAY}(\d\d?) ([A-Z][a-z]{{2}})[a-z]* (\d{{4}}),? (\d\d?):(\d\d)(?::(\d\d))?\s*{_ZONE}$", "$3|$2|$1|$4|$5|$6|||$7"),
    (rf"^{_DAY}([A-Z][a-z]{{2}})[a-z]* (\d\d?), (\d{{4}}),? (\d\d?):(\d\d)(?::(\d\d))?\s*([AaPp])[Mm]\s*{_ZONE}$", "$3|$1|$2|$4|$5|$6||$7|$8"),
]

#: Hours east of UTC of zone abbreviations that stand for one offset only.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 1, "CET": 1, "CEST": 2, "EET": 2, "EEST": 3, "MSK": 3,
    "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7,
    "AWST": 8, "JST": 9, "KST": 9, "AEST": 10, "AEDT": 11, "NZST": 12, "NZDT": 13,
}

_MONTHS = {m: f"{i:02}" for i, m in enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(), 1)}


def ntz_micros(c: Column) -> Column:
    """Microseconds since 1970-01-01 of a time without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c.cast("timestamp_ntz"))


def with_read_time(df: DataFrame, value: str, out: str = "t") -> DataFrame:
    """Adds out = struct(local_us, offset_s, kind), read from the text column `value`.

    kind is `epoch` (local_us is already UTC), `zoned` (offset_s says how far
    the clock is east of UTC), `local` (no zone is written) or `none`: null,
    blank, relative, impossible or unknown to the patterns. local_us holds
    microseconds of the written clock; smaller fractions are dropped. Zone
    abbreviations outside ABBREVIATIONS and offsets beyond 18 hours give
    `none`. `60` as a second gives `none`.
    """
    c = lambda name: F.col(f"__{out}_{name}")
    part = lambda i: F.get(c("p"), F.lit(i))
    pad = lambda x: F.lpad(x.cast("string"), 2, "0")

    def put(**columns: Column) -> None:
        nonlocal df
        df = df.withColumns({f"__{out}_{k}": x for k, x in columns.items()})

    had = set(df.columns)
    put(v=F.regexp_replace(F.col(value), r"^\s+|\s+$", ""))
    fields = F.lit(None).cast("string")
    for pattern, to in reversed(FORMS):
        fields = F.when(c("v").rlike(pattern), F.regexp_replace(c("v"), pattern, to)).otherwise(fields)
    number = F.when(c("v").rlike(r"^\d{10}(?:\.\d+)?$|^\d{13}$|^\d{16}$"), c("v"))
    put(p=F.split(fields, r"\|", -1), e=number)
    put(z=F.upper(part(8)), m=part(1), h=part(3).try_cast("int"), half=F.lower(part(7)), f=F.rpad(F.substring(part(6), 1, 6), 6, "0"), s=F.when(part(5) == "", "00").otherwise(part(5)))
    month = F.when(c("m").rlike("^[A-Z]"), F.coalesce(F.try_element_at(_literal_map(_MONTHS), c("m")), F.lit("00"))).otherwise(pad(c("m")))
    hour = F.when(c("half") == "", c("h")).when(c("h").between(1, 12), c("h") % 12 + F.when(c("half") == "p", 12).otherwise(0))
    clock = F.concat(part(0), F.lit("-"), month, F.lit("-"), pad(part(2)), F.lit(" "), pad(hour), F.lit(":"), part(4), F.lit(":"), c("s")).try_cast("timestamp_ntz")
    put(c=clock, g=F.regexp_extract(c("z"), r"([+-])(\d\d?):?(\d\d)?$", 0))
    put(hh=F.regexp_extract(c("g"), r"[+-](\d\d?)", 1).try_cast("int"), mm=F.coalesce(F.regexp_extract(c("g"), r"[+-]\d\d?:?(\d\d)$", 1).try_cast("int"), F.lit(0)))
    by_sign = F.when((c("hh") * 60 + c("mm") <= 18 * 60) & (c("mm") < 60), (c("hh") * 3600 + c("mm") * 60) * F.when(c("g").startswith("-"), -1).otherwise(1))
    offset = F.when(c("g") != "", by_sign).otherwise(F.try_element_at(_literal_map(ABBREVIATIONS), c("z")) * 3600)
    digits = F.length(c("e"))
    epoch = F.when(digits == 13, c("e").try_cast("bigint") * 1000).when((digits == 16) & ~F.contains(c("e"), F.lit(".")), c("e").try_cast("bigint")).otherwise(F.substring(c("e"), 1, 10).try_cast("bigint") * 1_000_000 + F.rpad(F.substring(c("e"), 12, 6), 6, "0").try_cast("bigint"))
    put(us=F.when(c("e").isNotNull(), epoch).otherwise(ntz_micros(c("c")) + c("f").try_cast("bigint")), o=offset)
    put(k=F.when(c("us").isNull(), "none").when(c("e").isNotNull(), "epoch").when(c("z") == "", "local").when(c("o").isNotNull(), "zoned").otherwise("none"))
    df = df.withColumn(out, opaque(F.struct(F.when(c("k") != "none", c("us")).alias("local_us"), F.when(c("k") == "zoned", c("o")).alias("offset_s"), c("k").alias("kind"))))
    return df.drop(*(set(df.columns) - had - {out}))


def opaque(c: Column) -> Column:
    """The same value through a generator, so that filters on it are not copied into what computes it."""
    return F.explode(F.array(c))


def _literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def first_shown(local_us: Column, zone: Column) -> Column:
    """The UTC microseconds at which a clock of `zone` showed a time, the earlier ones if it did so twice."""
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local_us), zone))


def shown_once(local_us: Column, zone: Column, first: Column) -> Column:
    """`first` (of first_shown), if it is the only instant at which the clock showed the time.

    Null where the clock jumped over the time or showed it twice (the offset
    history of the zone decides), and where the time or the zone is null.
    """
    later = F.array(*[F.lit(m * 60_000_000).cast("bigint") for m in (-120, -60, -30, 30, 60, 120)])
    shown = lambda u: F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(u), zone))
    return F.when((shown(first) == local_us) & ~F.exists(later, lambda x: shown(first + x) == local_us), first)
