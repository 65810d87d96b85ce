"""Spellings of language codes and of source names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Languages with their two-letter codes, for spellings without a script.
LANGUAGES = {
    "eng_Latn": "en", "deu_Latn": "de", "fra_Latn": "fr", "spa_Latn": "es", "por_Latn": "pt", "fin_Latn": "fi",
    "swe_Latn": "sv", "rus_Cyrl": "ru", "ukr_Cyrl": "uk", "ell_Grek": "el", "zho_Hans": "zh", "arb_Arab": "ar",
}

_SPELLINGS = {
    spelling: code
    for code, two in LANGUAGES.items()
    for spelling in (two, code[:3], code.replace("_", "").lower())
}


def language_of(code: Column) -> Column:
    """The language that a code names in any spelling (``en``, ``eng``, other case or separator), else null.

    A code of three letters and a script of four names itself, whatever the language; for shorter ones there is
    ``LANGUAGES``."""
    letters = F.lower(F.regexp_replace(code, "[^A-Za-z]", ""))
    whole = F.lower(F.trim(code)).rlike("^[a-z]{3}[^a-z0-9]?[a-z]{4}$")
    own = F.when(whole, F.concat(F.left(letters, F.lit(3)), F.lit("_"), F.initcap(F.right(letters, F.lit(4)))))
    return F.coalesce(F.create_map(*[F.lit(x) for x in chain(*_SPELLINGS.items())])[letters], own)


def source_key(name: Column) -> Column:
    """A source name without case, white space, hyphens, underscores and full stops; null if nothing is left."""
    key = F.lower(F.regexp_replace(name, r"(?U)[\s\-_.]+", ""))
    return F.when(key != "", key)
