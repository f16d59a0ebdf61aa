"""Time parsing, zone conversion, calendar parts and time labels."""

from pyspark.sql import Column, DataFrame, functions as F

from thermolane.constants import LOCAL_ZONE, TIME_COLUMN_NAMES

_OFFSET_PATTERN = r"(\dZ|(:\d{2}|\.\d+|[T ]\d{4,6})\s*(Z|[+-]\d{2}:?\d{2}))$"

_CLOCK = r"(\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)"
_ZONE = r"\s*(Z|[+-]\d{2}:?\d{2})?"
#: Forms of times as text: pattern, and how it is rewritten for the parser.
TIME_FORMS = {
    "iso": (r"^(\d{4}-.*)$", "$1"),
    "year_first": (rf"^(\d{{4}})[/.](\d{{1,2}})[/.](\d{{1,2}})(?:[ T]+{_CLOCK})?{_ZONE}$", "$1-$2-$3 $4$5"),
    "kanji": (r"^(\d{4})年(\d{1,2})月(\d{1,2})日\s*(?:(\d{1,2})時(?:(\d{1,2})分(?:(\d{1,2})秒)?)?)?$", "$1-$2-$3 0$4:0$5:0$6"),
    "compact": (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:[ T]?(\d{{2}})(\d{{2}})(\d{{2}})?)?{_ZONE}$", "$1-$2-$3 0$4:0$5:0$6$7"),
    "month_first": (rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?: +{_CLOCK})?{_ZONE}$", "$3-$1-$2 $4$5"),
    "year": (r"^(\d{4})$", "$1-1-1"),
    "half_day": (r"^(\d{4})[/.-](\d{1,2})[/.-](\d{1,2}) +(\d{1,2}:\d{2})\s*([AaPp][Mm])$", "$1-$2-$3 $4 $5"),
    "day_month_name": (rf"^(\d{{1,2}})[ -]([A-Za-z]{{3}})[A-Za-z]*[ -](\d{{4}})(?: +{_CLOCK})?$", "$1 $2 $3 $4"),
    "month_name_first": (rf"^([A-Za-z]{{3}})[A-Za-z]* (\d{{1,2}}),? (\d{{4}})(?: +{_CLOCK})?$", "$2 $1 $3 $4"),
}
#: Formats of rewritten texts that are not ISO.
_MONTH_NAME, _HALF_DAY = "d MMM y[ H:m[:s]]", "y-M-d h:m a"


def time_column(df: DataFrame):
    """Name of the time column: exact names first, then any name containing "datetime"."""
    for name in TIME_COLUMN_NAMES:
        if name in df.columns:
            return name
    return next((c for c in df.columns if "datetime" in c.lower()), None)


def time_text(df: DataFrame):
    """The time of each row as text, null if the frame has no time column.

    Files under different headers may have it under different exact names: the first that is filled.
    """
    exact = [F.col(f"`{n}`").cast("string") for n in TIME_COLUMN_NAMES if n in df.columns]
    if exact:
        return F.coalesce(*exact)
    name = time_column(df)
    return None if name is None else F.col(f"`{name}`").cast("string")


def _clean(x: Column) -> Column:
    return F.trim(x.cast("string"))


def time_form(x: Column) -> Column:
    """Name of the form that a text has, null if it has none; half-day times have their own."""
    text = _clean(x)
    half = F.when(text.rlike(TIME_FORMS["half_day"][0]), F.lit("half_day"))
    return F.coalesce(half, *[F.when(text.rlike(pattern), F.lit(name)) for name, (pattern, _) in TIME_FORMS.items()])


def parse_time(x: Column) -> Column:
    """Text to timestamp, in any of TIME_FORMS; text that is no time gives null instead of an error.

    Each form's pattern covers the whole text and is rewritten for the parser, so the forms are
    tried by one chain of replacements and parsed once. Month before day in "1/5/2024".
    """
    text = _clean(x)
    for name, (pattern, rewriting) in TIME_FORMS.items():
        if name != "iso":  # ISO text stays as it is
            text = F.regexp_replace(text, pattern, rewriting)
    # Clock parts that the text lacks stand as 0, those that it has after a 0.
    text = F.regexp_replace(F.trim(text), r"(?<=[ :])0(?=\d{2}(?:$|[:Z+-]))", "")
    text = F.regexp_replace(text, r"(?<=[ :])0(?=:|$|[Z+-])", "00")
    # The parser would take a clock alone for a time of today.
    text = F.regexp_replace(text, r"^T?\d{1,2}:.*$", "")
    # A format that does not fit costs an exception, so only texts that may fit meet theirs.
    return F.coalesce(
        F.try_to_timestamp(text),
        F.when(text.rlike(r"^[-+]?\d+ [A-Za-z]{3}"), F.try_to_timestamp(F.initcap(text), F.lit(_MONTH_NAME))),
        F.when(text.rlike(r"(?i)[ap]m$"), F.try_to_timestamp(F.upper(text), F.lit(_HALF_DAY))),
    )


def local_minute(x: Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC reading time -> local wall-clock time, floored to the minute; bad text -> null."""
    return F.date_trunc("minute", F.from_utc_timestamp(parse_time(x), zone))


def assume_local(x: Column, zone: str = LOCAL_ZONE) -> Column:
    """Text time to UTC: text without an offset is local time, text with one is kept."""
    has_offset = _clean(x).rlike(_OFFSET_PATTERN)
    return F.to_utc_timestamp(parse_time(x), F.when(has_offset, F.lit("UTC")).otherwise(F.lit(zone)))


def floor_time(x: Column, unit: str) -> Column:
    return F.date_trunc(unit, x)


def calendar_columns(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add date, day_of_week (Monday = 0), hour, month and is_weekend."""
    t = F.col(ts)
    return df.withColumns(
        {
            "date": F.to_date(t),
            "day_of_week": F.weekday(t),
            "hour": F.hour(t),
            "month": F.month(t),
            "is_weekend": F.weekday(t).isin(5, 6).cast("int"),
        }
    )


def hour_of_week(ts: Column) -> Column:
    return F.weekday(ts) * 24 + F.hour(ts)


def month_label(month: Column) -> Column:
    return F.concat(month.cast("string"), F.lit("月"))


def month_number(label: Column) -> Column:
    """"1月" -> 1; anything that is not a month 1-12 -> null."""
    n = F.regexp_replace(label, "月", "").try_cast("int")
    return F.when(n.between(1, 12), n)


def clock_hour(text: Column, default: int) -> Column:
    """"HH:MM" -> hour; unreadable text -> `default`."""
    return F.coalesce(F.split(text, ":")[0].try_cast("int"), F.lit(default))


def plan_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/MM/dd HH:mm")


def schedule_file_parts(path: Column):
    """Kind and date of a plan file name such as `zone_schedule_20240131_0100.csv`."""
    name = F.substring_index(path, "/", -1)
    pattern = r"^(unit|zone)_schedule_(\d{8})_"
    kind = F.regexp_extract(name, pattern, 1)
    day = F.regexp_extract(name, pattern, 2)
    return (
        F.when(kind != "", kind),
        F.when(day != "", F.try_to_timestamp(day, F.lit("yyyyMMdd")).cast("date")),
    )
