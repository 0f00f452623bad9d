"""Tokens, and small default word lists. Pass your own lists for real work."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelsight.functions.columns import col

# Words end where Unicode's default rules say (annex 29). Fixed values, as regular expression classes:
# scripts that are written without blanks, each of whose characters is a word; katakana, which runs
# together; marks and invisible characters, which belong to what they follow; what may stand between
# two letters, and between two digits; and what joins words.
_BY_CHARACTER = "Han Hiragana Thai Lao Khmer Myanmar".split()
_KATAKANA = r"\x{30FC}\x{FF70}\x{3031}-\x{3035}"
_EXTENDING = (
    r"\p{M}\x{AD}\x{0600}-\x{0605}\x{061C}\x{06DD}\x{070F}\x{200C}-\x{200F}\x{202A}-\x{202E}"
    r"\x{2060}-\x{2064}\x{2066}-\x{206F}\x{FEFF}"
)
_BETWEEN_BOTH = r".'\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}"
_BETWEEN_LETTERS = _BETWEEN_BOTH + r":\x{B7}\x{0387}\x{055F}\x{05F4}\x{2027}\x{FE13}\x{FE55}\x{FF1A}"
_BETWEEN_DIGITS = (
    _BETWEEN_BOTH + r",;\x{037E}\x{0589}\x{060C}\x{060D}\x{066C}\x{07F8}\x{2044}\x{FE10}\x{FE14}"
    r"\x{FE50}\x{FE54}\x{FF0C}\x{FF1B}"
)
_JOINING = r"\p{Pc}\x{202F}"
# Most words: Latin letters and digits before something plain that cannot go on with the word.
_ENDING = r"[\x00-\x26\x28-\x2B\x2D\x2F\x3C-\x40\x5B-\x5E\x60\x7B-\x7F]"
_EASY = (
    r"[A-Za-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{024F}]++"
    rf"(?={_ENDING}|[.,;:'](?:{_ENDING}|[.,;:']|\z)|\z)"
)


def word_pattern(script: str = "Is", kept: str = "+") -> str:
    """The expression of a word. ``script`` comes before the names of scripts, and ``kept`` after
    repetitions that need not be taken back: with it Java, which else calls itself for each of
    them, goes through a word of any length in a loop. Other engines may need neither."""
    unspaced = "".join(rf"\p{{{script}{s}}}" for s in _BY_CHARACTER)
    kana = rf"\p{{{script}Katakana}}{_KATAKANA}"
    # Plain letters and digits first: they are most of all, and go by in one step.
    letter = rf"(?:[A-Za-z]+{kept}|\p{{Nl}}|[^\P{{L}}{unspaced}{kana}])"
    digit = rf"(?:[0-9]+{kept}|\p{{Nd}})"
    after = f"[{_EXTENDING}]*{kept}"

    def run(one: str, between: str) -> str:
        many = f"(?:{one}{after})+{kept}"
        return f"{many}(?:[{between}]{after}{many})*{kept}"

    plain = f"(?:{run(letter, _BETWEEN_LETTERS)}|{run(digit, _BETWEEN_DIGITS)})+{kept}"
    core = f"(?:{plain}|(?:[{kana}]{after})+{kept})"
    join = f"[{_JOINING}][{_JOINING}{_EXTENDING}]*{kept}"
    # A run of joiners without a word is looked at once, not from each of its characters.
    first = f"(?:(?<![{_JOINING}]){join})?{kept}" if kept else f"(?:{join})?"
    whole = f"{first}{core}(?:{join}{core})*{kept}(?:{join})?{kept}|[{unspaced}]{after}"
    return f"{_EASY}|{whole}" if kept else whole


WORD_PATTERN = word_pattern()


def words_of(text: str | Column) -> Column:
    """All words of a text in lower case, in order, as an array (NULL for NULL)."""
    return F.regexp_extract_all(F.lower(col(text)), F.lit(WORD_PATTERN), F.lit(0))


# Common English function words: fixed values.
STOP_WORDS = (
    "a about above after again all am an and any are as at be because been before being below "
    "between both but by can could did do does doing down during each few for from further had "
    "has have having he her here hers him his how i if in into is it its itself just me more "
    "most my no nor not now of off on once only or other our out over own same she should so "
    "some such than that the their them then there these they this those through to too under "
    "until up very was we were what when where which while who whom why will with would you your"
).split()

# Words with a clear tone in delivery reviews: fixed values.
POSITIVE_WORDS = (
    "accurate amazing best clean easy excellent fast fresh friendly good great happy helpful "
    "love nice perfect polite pleasant prompt quick recommend reliable satisfied smooth"
).split()
NEGATIVE_WORDS = (
    "angry awful bad broken cold complaint damaged delay delayed dirty disappointed expired "
    "horrible late missing poor rude slow spoiled stale terrible unhappy worst wrong"
).split()
LEXICON = [(w, "positive") for w in POSITIVE_WORDS] + [(w, "negative") for w in NEGATIVE_WORDS]
