"""Repair of Vietnamese text whose letters and tone marks came apart."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Spacing and combining forms of the five tone marks, and the mark each becomes.
TONES = {
    "\u0301": "\u00b4\u02ca\u0301",
    "\u0300": "\u0060\u02cb\u0300",
    "\u0309": "\u0309",
    "\u0303": "\u007e\u02dc\u0303",
    "\u0323": "\u0323\u02d9",
}
# Pairs of vowels that get an ending with the tilde where older texts are to be matched.
STRICT_ENDINGS = {"ươ": "ng", "Ươ": "ng", "ƯƠ": "NG"}
TILDE = "\u0303"
# Vowels that take a tone mark.
VOWELS = "aăâeêioôơuưyAĂÂEÊIOÔƠUƯY"
# Pieces that end a syllable, and the marked vowels that a syllable may end with before them.
TAILS = "(?:ng|nh|ch|[cmnptk]|u|i|o|y)"
MARKED = "âêôơưăáàảãạắằẳẵặấầẩẫậéèẻẽẹếềểễệíìỉĩịóòỏõọốồổỗộớờởỡợúùủũụứừửữựýỳỷỹỵ"


def _class(chars: str) -> str:
    """A class of characters as ranges; a regular expression tries single ones beyond Latin-1 one after the other."""
    points = sorted(set(map(ord, chars)))
    runs = [[points[0], points[0]]]
    for p in points[1:]:
        if p == runs[-1][1] + 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return "[" + "".join(f"\\x{{{a:x}}}" + (f"-\\x{{{b:x}}}" if b > a else "") for a, b in runs) + "]"


# White space between a marked vowel and an end of its syllable. It is looked for by the space, so the time does not depend
# on the length of words; as no end is a marked vowel, one pass finds all there are.
_APART = f"(?<=[^\\x00-\\x7f])(?<={_class(MARKED + MARKED.upper())})\\s+(?iu)(?={TAILS}(?:[^\\p{{L}}\\p{{N}}_\u00c0-\u1ef9]|$))"


def _composed(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def nfc(s: Column) -> Column:
    """Composed form; made here, as a function of Spark needs a session."""
    return F.pandas_udf(_composed, "string")(s)


def repair(s: Column, *, reconnect: bool = True, strict: bool = False) -> Column:
    """Join tone marks to their vowels and split syllables to their ends, in composed form; null is ''.

    ``strict`` keeps a known oddity of older texts: a tilde joined to a horned pair of vowels is followed by an ending that
    was not there, so exports made before can be made again byte by byte. Only the composition is a Python function; it sees one column in Arrow batches.
    """
    s = F.replace(F.coalesce(s, F.lit("")), F.lit("\u00a0"), F.lit(" "))
    s = F.regexp_replace(s, "[\r\u00ad\u200b-\u200d\ufeff]", "")
    s = F.regexp_replace(s, "([a-zA-Z\u00c0-\u1ef9])\\s+([\u0300-\u036f\u1dc0-\u1dff\u1ab0-\u1aff])", "$1$2")
    for pair, ending in STRICT_ENDINGS.items() if strict else ():
        s = F.regexp_replace(s, rf"({pair})\s*[{TONES[TILDE]}]", f"$1{TILDE}{ending}")
    # marks of all tones are moved up to their vowels at once; then those that stand beside become those that combine
    s = F.regexp_replace(s, rf"({_class(VOWELS)})\s+(?=[{''.join(TONES.values())}])", "$1")
    for mark, forms in TONES.items():
        if beside := forms.replace(mark, ""):
            s = F.regexp_replace(s, rf"[{beside}](?<={_class(VOWELS)}[{beside}])", mark)
    s = nfc(s)
    if reconnect:
        s = F.regexp_replace(s, _APART, "")
    s = F.regexp_replace(s, "[ \t]+", " ")
    return F.regexp_replace(s, r"^\s+|\s+$", "")
