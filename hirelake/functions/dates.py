"""Date expressions: posting dates, minute precision, calendar attributes."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date that stands for an unreadable one, and the words before a posting date. Of a text
# that begins with none of them as many characters are left out as the first one has.
UNKNOWN_DATE = "9999-12-30"
POSTED_PREFIXES = ("Posted ", "Veröffentlicht ", "Publié ", "Publicado ", "Publicada ")

# Names of the months and their short forms in English, German, French and Spanish.
MONTHS = (
    ("january", "jan", "januar", "jänner", "jän", "janvier", "janv", "enero", "ene"),
    ("february", "feb", "februar", "février", "fevrier", "févr", "fevr", "fév", "febrero"),
    ("march", "mar", "märz", "maerz", "mär", "mrz", "mars", "marzo"),
    ("april", "apr", "avril", "avr", "abril", "abr"),
    ("may", "mai", "mayo"),
    ("june", "jun", "juni", "juin", "junio"),
    ("july", "jul", "juli", "juillet", "juil", "julio"),
    ("august", "aug", "août", "aout", "agosto", "ago"),
    ("september", "sep", "sept", "septembre", "septiembre", "setiembre"),
    ("october", "oct", "oktober", "okt", "octobre", "octubre"),
    ("november", "nov", "novembre", "noviembre"),
    ("december", "dec", "dezember", "dez", "décembre", "decembre", "déc", "diciembre", "dic"),
)
# Words for whole dates, as (months, days) before the anchor.
SAID_DATES = {
    (0, 0): ("today", "just now", "now", "just posted", "heute", "gerade eben", "aujourd'hui", "aujourd’hui", "hoy"),
    (0, 1): ("yesterday", "gestern", "hier", "ayer"),
    (0, 2): ("vorgestern", "avant-hier", "anteayer", "antes de ayer"),
    (0, 7): ("last week", "letzte woche", "la semaine dernière", "la semana pasada"),
    (1, 0): ("last month", "letzten monat", "le mois dernier", "el mes pasado"),
    (12, 0): ("last year", "letztes jahr", "l'année dernière", "l’année dernière", "el año pasado"),
}


class Grammar(NamedTuple):
    """How a language counts back: patterns before and after the amounts, words, and patterns of units."""

    before: str
    after: str
    one: tuple[str, ...]
    also: str
    units: dict[str, tuple[str, ...]]


# The first language whose pattern a text matches is taken.
GRAMMARS = (
    Grammar(
        "(?:about |over |almost )?", r"\s+ago", ("a", "an", "one"), "and",
        {
            "year": ("years", "year", "yrs", "yr", "y"), "month": ("months", "month", "mths", "mth", "mos", "mo"),
            "week": ("weeks", "week", "wks", "wk", "w"), "day": ("days", "day", "d"),
            "hour": ("hours", "hour", "hrs", "hr", "h"), "minute": ("minutes", "minute", "mins", "min"),
            "second": ("seconds", "second", "secs", "sec", "s"),
        },
    ),
    Grammar(
        "vor (?:etwa |über |mehr als )?", "", ("ein", "eine", "einem", "einer"), "und",
        {
            "year": ("jahren", "jahre", "jahr"), "month": ("monaten", "monate", "monat"), "week": ("wochen", "woche"),
            "day": ("tagen", "tage", "tag"), "hour": ("stunden", "stunde", "std"),
            "minute": ("minuten", "minute", "min"), "second": ("sekunden", "sekunde", "sek"),
        },
    ),
    Grammar(
        "il y a (?:environ |plus de )?", "", ("un", "une"), "et",
        {
            "year": ("années", "année", "ans", "an"), "month": ("mois",), "week": ("semaines", "semaine"),
            "day": ("jours", "jour"), "hour": ("heures", "heure", "h"), "minute": ("minutes", "minute", "min"),
            "second": ("secondes", "seconde"),
        },
    ),
    Grammar(
        "hace (?:unos |unas |más de )?", "", ("un", "una", "uno"), "y",
        {
            "year": ("años", "año"), "month": ("meses", "mes"), "week": ("semanas", "semana"),
            "day": ("días", "dias", "día", "dia"), "hour": ("horas", "hora"), "minute": ("minutos", "minuto", "min"),
            "second": ("segundos", "segundo"),
        },
    ),
)
_IN_MONTHS, _IN_DAYS = {"year": 12, "month": 1}, {"week": 7, "day": 1}
_IN_SECONDS = {"hour": 3600, "minute": 60, "second": 1}

_LEAD = r"^(?:(?:on|am|le|el)\s+)?"
_TIME = r"(?:[t ]\d{1,2}:\d{2}.*)?$"
_YEAR_FIRST = rf"{_LEAD}(\d{{4}}-\d{{2}}-\d{{2}}|\d{{4}}/\d{{2}}/\d{{2}}){_TIME}"
_YEAR_LAST = rf"{_LEAD}(\d{{2}})([./])(\d{{2}})\2(\d{{4}}){_TIME}"
_DAY_MONTH = rf"{_LEAD}(\d{{1,2}})(?:st|nd|rd|th|er|\.)?(?: of| de)? (\p{{L}}+)\.?(?:,? (?:of |de )?(\d{{4}}){_TIME}|$)"
_MONTH_DAY = rf"{_LEAD}(\p{{L}}+)\.? (\d{{1,2}})(?:st|nd|rd|th)?(?:,? (\d{{4}}))?{_TIME}"


def parse_posted_date(text: Column | str, anchor: Column) -> Column:
    """The date in texts like 'Posted 3 days ago', counted back from the timestamp ``anchor``.

    English, German, French and Spanish are read ('Publié il y a 3 jours'). Several amounts add up ('3 days,
    2 hours ago'); 'last week' is one week ago. Absolute dates have the year first (2024-01-31, 2024/01/31) or last
    (01/31/2024, 31.01.2024; 31/01/2024 where the first number can't be a month), or a month's name, with or
    without a time after them, 'on' before or an ordinal ending. A day without a year is the latest one that
    is not after the anchor. Whatever cannot be read becomes 9999-12-30, as do amounts that lead out of the
    calendar. A later form is only looked for where the earlier ones don't match.
    """
    text = F.col(text) if isinstance(text, str) else text
    start = F.lit(len(POSTED_PREFIXES[0]) + 1)
    for prefix in POSTED_PREFIXES[1:]:
        start = F.when(F.startswith(text, F.lit(prefix)), len(prefix) + 1).otherwise(start)
    lowered = F.lower(F.trim(F.substring(text, start, F.lit(2**31 - 1))))
    day = anchor.cast("date")

    def read(said: Column) -> Column:
        forms = (_said(said, day), _year_first(said), _counted_back(said, anchor), _year_last(said), _named(said, day))
        return F.coalesce(*forms)

    return F.coalesce(_let(lowered, read), F.lit(UNKNOWN_DATE).cast("date"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _said(lowered: Column, day: Column) -> Column:
    found = F.lit(None).cast("date")
    for (months, days), words in reversed(SAID_DATES.items()):
        found = F.when(lowered.isin(*words), F.date_sub(F.add_months(day, -months), days)).otherwise(found)
    return found


def _counted_back(lowered: Column, anchor: Column) -> Column:
    """The date that amounts of units lead back to; NULL where there are none."""
    amounts = F.lit(None).cast("struct<number:array<string>,unit:array<string>>")
    for grammar in reversed(GRAMMARS):
        unit = "|".join(word for words in grammar.units.values() for word in words)
        number = rf"(\d+|(?:{'|'.join(grammar.one)})(?=\s))\+?\s*"
        part = rf"(?:{number}(?:{unit}))"
        between = rf"(?:\s*,\s*|\s+{grammar.also}\s+|\s*,\s*{grammar.also}\s+|\s+)"
        whole = F.lit(rf"^{grammar.before}{part}(?:{between}{part})*{grammar.after}$")
        one = F.lit(rf"(?<![\p{{L}}\d]){number}({unit})(?!\p{{L}})")
        parts = F.struct(
            F.regexp_extract_all(lowered, one, 1).alias("number"), F.regexp_extract_all(lowered, one, 2).alias("unit")
        )
        amounts = F.when(F.rlike(lowered, whole), parts).otherwise(amounts)

    def before(said: Column) -> Column:
        counts = F.transform(
            said["number"], lambda n: F.when(F.rlike(n, F.lit(r"^\d")), n.try_cast("int")).otherwise(1).cast("long")
        )

        def total(weights: dict[str, int]) -> Column:
            """NULL if an amount is more than a number holds."""

            def weighed(n: Column, word: Column) -> Column:
                weight = F.lit(0)
                for unit, times in weights.items():
                    words = sorted({w for g in GRAMMARS for w in g.units[unit]})
                    weight = F.when(word.isin(*words), times).otherwise(weight)
                return n * weight

            return F.aggregate(F.zip_with(counts, said["unit"], weighed), F.lit(0).cast("long"), lambda a, n: a + n)

        # Amounts beyond about two thousand years lead out of the calendar.
        def back(sums: Column) -> Column:
            sane = (sums["months"] < 24_000) & (sums["days"] < 730_000) & (sums["seconds"] < 60_000_000_000)
            clock = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), sums["seconds"].cast("decimal(18,6)"))
            months = F.add_months((anchor - clock).cast("date"), -sums["months"].cast("int"))
            date = F.date_sub(months, sums["days"].cast("int"))
            return F.when(sane, date)

        sums = F.struct(
            total(_IN_MONTHS).alias("months"), total(_IN_DAYS).alias("days"), total(_IN_SECONDS).alias("seconds")
        )
        return _let(sums, back)

    date = _let(amounts, lambda said: F.when(said.isNotNull(), before(said)))
    return _let(date, lambda d: F.when(d >= F.lit("0001-01-01").cast("date"), d))


def _year_first(lowered: Column) -> Column:
    return F.try_to_date(F.translate(F.regexp_extract(lowered, _YEAR_FIRST, 1), "/", "-"), "yyyy-MM-dd")


def _year_last(lowered: Column) -> Column:
    first, sign, second, year = (F.regexp_extract(lowered, _YEAR_LAST, k) for k in (1, 2, 3, 4))
    day_first = (sign == ".") | (first > "12")
    date = F.when(day_first, F.concat_ws("-", year, second, first)).otherwise(F.concat_ws("-", year, first, second))
    return F.when(F.rlike(lowered, F.lit(_YEAR_LAST)), F.try_to_date(date, "yyyy-MM-dd"))


def _named(lowered: Column, day: Column) -> Column:
    """Dates with a month's name, before or after the day."""

    def read(said: Column) -> Column:
        month = F.lit(None).cast("int")
        for number, names in enumerate(MONTHS, 1):
            month = F.when(said["month"].isin(*names), number).otherwise(month)

        def of(year: Column) -> Column:
            return F.try_to_date(F.concat(year.cast("string"), F.lit("-"), month.cast("string"), F.lit("-"), said["day"]), "yyyy-M-d")

        this_year = of(F.year(day))
        latest = F.when(this_year > day, F.add_months(this_year, -12)).otherwise(this_year)
        return F.when(said["year"] == "", latest).otherwise(of(said["year"]))

    def parts(pattern: str, at: int, month: int) -> Column:
        found = {"day": at, "month": month, "year": 3}
        return F.struct(*(F.regexp_extract(lowered, pattern, k).alias(name) for name, k in found.items()))

    said = F.when(F.rlike(lowered, F.lit(_DAY_MONTH)), parts(_DAY_MONTH, 1, 2)).when(
        F.rlike(lowered, F.lit(_MONTH_DAY)), parts(_MONTH_DAY, 2, 1)
    )
    return _let(said, lambda s: F.when(s.isNotNull(), read(s)))


def truncate_minute(ts: Column | str) -> Column:
    """The timestamp without seconds; a timestamp without zone stays one."""
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def calendar_columns(day: Column) -> list[Column]:
    """The attributes of one calendar day."""
    month, dom = F.month(day), F.dayofmonth(day)

    def falls_on(m: int, d: int) -> Column:
        return (month == m) & (dom == d)

    # The US holidays that keep their date are New Year, 4 July and Christmas.
    holiday = falls_on(1, 1) | falls_on(7, 4) | falls_on(12, 25)
    return [
        day.alias("date_iso_format_pk"),
        day.cast("timestamp_ntz").alias("date"),
        F.year(day).alias("num_year"),
        month.alias("num_month_in_year"),
        dom.alias("num_day_in_month"),
        (F.weekday(day) + 1).alias("num_day_in_week"),
        holiday.alias("is_holiday_us"),
        F.date_format(day, "MMMM").alias("name_month_en"),
        F.date_format(day, "EEEE").alias("name_day_en"),
    ]
