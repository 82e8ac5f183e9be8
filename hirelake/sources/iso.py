"""ISO 3166 country codes and their English short names."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# ISO short names that differ from the display names of the Java runtime.
ISO_SHORT_NAMES = {
    "AG": "Antigua and Barbuda",
    "AX": "Åland Islands",
    "BA": "Bosnia and Herzegovina",
    "BL": "Saint Barthélemy",
    "BN": "Brunei Darussalam",
    "BO": "Bolivia, Plurinational State of",
    "BQ": "Bonaire, Sint Eustatius and Saba",
    "CC": "Cocos (Keeling) Islands",
    "CD": "Congo, The Democratic Republic of the",
    "CG": "Congo",
    "CI": "Côte d'Ivoire",
    "CV": "Cabo Verde",
    "CZ": "Czechia",
    "FK": "Falkland Islands (Malvinas)",
    "FM": "Micronesia, Federated States of",
    "GS": "South Georgia and the South Sandwich Islands",
    "HK": "Hong Kong",
    "HM": "Heard Island and McDonald Islands",
    "IR": "Iran, Islamic Republic of",
    "KN": "Saint Kitts and Nevis",
    "KP": "Korea, Democratic People's Republic of",
    "KR": "Korea, Republic of",
    "LA": "Lao People's Democratic Republic",
    "LC": "Saint Lucia",
    "MD": "Moldova, Republic of",
    "MF": "Saint Martin (French part)",
    "MM": "Myanmar",
    "MO": "Macao",
    "PM": "Saint Pierre and Miquelon",
    "PN": "Pitcairn",
    "PS": "Palestine, State of",
    "RE": "Réunion",
    "RU": "Russian Federation",
    "SH": "Saint Helena, Ascension and Tristan da Cunha",
    "SJ": "Svalbard and Jan Mayen",
    "ST": "Sao Tome and Principe",
    "SX": "Sint Maarten (Dutch part)",
    "SY": "Syrian Arab Republic",
    "TC": "Turks and Caicos Islands",
    "TR": "Türkiye",
    "TT": "Trinidad and Tobago",
    "TW": "Taiwan, Province of China",
    "TZ": "Tanzania, United Republic of",
    "VA": "Holy See (Vatican City State)",
    "VC": "Saint Vincent and the Grenadines",
    "VE": "Venezuela, Bolivarian Republic of",
    "VG": "Virgin Islands, British",
    "VI": "Virgin Islands, U.S.",
    "VN": "Viet Nam",
    "WF": "Wallis and Futuna",
}


@lru_cache(maxsize=4)
def iso_names(spark: SparkSession) -> dict[str, str]:
    """Code to name, for every country code the Java runtime lists."""
    locale = spark.sparkContext._jvm.java.util.Locale
    names = {code: locale("", code).getDisplayCountry(locale.ENGLISH) for code in locale.getISOCountries()}
    return {code: ISO_SHORT_NAMES.get(code, name) for code, name in names.items()}


def iso_table(spark: SparkSession) -> DataFrame:
    """The countries as a table: iso_code, iso_country. It has about 250 rows."""
    return spark.createDataFrame(list(iso_names(spark).items()), "iso_code string, iso_country string")


def iso_pattern(codes: list[str]) -> str:
    """An upper-case country code standing alone. Codes with the same first letter share a branch."""
    seconds: dict[str, str] = {}
    for code in sorted(codes):
        seconds[code[0]] = seconds.get(code[0], "") + code[1]
    return r"\b(?:" + "|".join(f"{first}[{rest}]" for first, rest in seconds.items()) + r")\b"
