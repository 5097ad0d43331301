"""Company names without their legal form."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Common public legal forms. Dots and the blanks around "&" are
# optional when matching, so "S.A.R.L." needs no entry besides "sarl".
LEGAL_FORMS = (
    "ab", "ag", "aps", "as", "asa", "bhd", "bv", "bvba", "co", "company",
    "corp", "corporation", "cv", "doo", "eirl", "ev", "gmbh", "gmbh & co kg",
    "inc", "incorporated", "jsc", "kft", "kg", "kgaa", "kk", "limited", "llc",
    "llp", "lp", "ltd", "ltda", "nv", "oao", "ohg", "ooo", "oy", "oyj", "pjsc",
    "plc", "pllc", "private limited", "pte", "pty", "pvt", "sa", "sa de cv",
    "sarl", "sas", "sdn", "se", "sl", "snc", "sp zoo", "spa", "sprl", "srl",
    "sro", "zao", "zrt",
)
SEPARATORS = " ,.&"


def _form_pattern(form: str) -> str:
    # Only short all-letter forms are ever written with dots between the letters.
    words = []
    for word in form.split(" "):
        letters = [re.escape(c) for c in word]
        words.append(r"\.?".join(letters) if word.isalpha() and len(word) <= 4 else "".join(letters))
    return r"\.?[ ]*".join(words)


def legal_form_pattern(forms=LEGAL_FORMS) -> str:
    """One or more forms at the end, with what stands before them as the first group."""
    longest_first = sorted(forms, key=lambda f: (-len(f), f))
    form = "|".join(_form_pattern(f) for f in longest_first)
    return rf"(?i)([^{SEPARATORS}])(?:[{SEPARATORS}]+(?:{form})[.]?)+$"


def basename(name: Column, forms=LEGAL_FORMS) -> Column:
    """Strips any number of trailing legal forms ("Co Pty Ltd", "Co., Ltd.").

    Null stays null, and a name that is nothing but a legal form stays whole.
    """
    return F.regexp_replace(F.trim(name), legal_form_pattern(forms), "$1")
