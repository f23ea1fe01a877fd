"""Language names from codes.

Names come from the CLDR data inside the ICU library that Spark ships, so the table is a rule
instead of a list. The exceptions below are the codes whose published name differs from CLDR's,
or that CLDR does not know. A published table that names fewer codes is given as a parameter of
``dimensions.dim_project``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that differ from the CLDR rule.
NAME_EXCEPTIONS = {
    "simple": "Simple English",
    "nan": "Southern Min",
    "bn": "Bengali",
    "no": "Norwegian (Bokmål)",
    "nn": "Norwegian (Nynorsk)",
    "eml": "Emilian-Romagnol",
    "lld": "Ladin",
    "frp": "Franco-Provençal",
    "nds-nl": "Low Saxon (Netherlands)",
    "gsw": "Alemannic German",
    "be-tarask": "Belarusian (Taraškievica)",
    "rsk": "Pannonian Rusyn",
    "hyw": "Western Armenian",
    "azb": "South Azerbaijani",
    "av": "Avar",
    "lez": "Lezgian",
    "os": "Ossetian",
    "sah": "Sakha (Yakut)",
    "tyv": "Tuvan",
    "mhr": "Eastern Mari",
    "rn": "Kirundi",
    "st": "Sesotho",
    "nr": "Southern Ndebele",
    "ny": "Chichewa",
    "lg": "Luganda",
    "shi": "Shilha",
    "nqo": "N'Ko",
    "ilo": "Ilocano",
    "bcl": "Central Bikol",
    "pam": "Kapampangan",
    "bjn": "Banjarese",
    "mi": "Maori",
    "dv": "Dhivehi",
    "ckb": "Central Kurdish (Sorani)",
    "cu": "Old Church Slavonic",
    "isv": "Interslavic",
    "als": "ISO: ALS",  # the projects of this code are not in the language that CLDR names
    "unknown": "Other / Technical",
}
ICU_CLASS, ICU_METHOD = "com.ibm.icu.util.ULocale", "getDisplayLanguage"


def language_name(code: Column) -> Column:
    """English name of a language code; codes without a name become ``ISO: <CODE>``."""
    lowered = F.lower(code)
    plain = F.when(lowered.rlike("^[a-z]{2,3}$"), lowered)
    # The ICU method takes no NULL; the name of an empty code is empty and never used.
    known = F.coalesce(plain, F.lit(""))
    icu = F.reflect(F.lit(ICU_CLASS), F.lit(ICU_METHOD), known, F.lit("en"))
    listed = ";".join(f"{key}={name}" for key, name in NAME_EXCEPTIONS.items())
    exceptions = F.str_to_map(F.lit(listed), F.lit(";"), F.lit("="))
    return F.coalesce(
        F.try_element_at(exceptions, lowered),
        F.when(icu != plain, icu),
        F.concat(F.lit("ISO: "), F.upper(code)),
    )
