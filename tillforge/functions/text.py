"""Column helpers for text: trimming, NULL words, guarded parsing, redaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tillforge.constants import MASK, NULL_WORDS

# Fixed values. Java's \s and RE2's \s differ, so white space is spelled out:
# ASCII blanks and separators, NEL, and every Unicode separator.
BLANKS = r"\x09-\x0D\x1C-\x20\x85\p{Z}"
BLANK = f"[{BLANKS}]"
# The same characters one by one, for plain trimming.
BLANK_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
CONTROL_CHARACTERS = "".join(map(chr, [*range(0x20), *range(0x7F, 0xA0)]))
NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"

# Names whose value is a secret, in the order of application.
SECRET_NAMES = ["password", "token", "api_key", "secret"]
URL_PASSWORD = r"(?iu)(postgres(?:ql)?://[^:]+:)([^@]+)(@)"


def secret_value(name: str) -> str:
    """Pattern for ``name: value`` and ``name = value``, quoted or not; group 1 is kept."""
    return f"""(?iu)({name}['"]?{BLANK}*[:=]{BLANK}*['"]?)([^'"&{BLANKS}]+)"""


#: Visible ASCII, with plain blanks inside at most: trimming and stripping leave it as it is.
PLAIN = r"^[!-~](?:[ -~]*[!-~])?\z"
#: Longer texts are no NULL words; lower case never has fewer characters.
LONGEST_NULL_WORD = max(map(len, NULL_WORDS))


def strip_blank(text: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(BLANK_CHARACTERS))


def strip_control(text: Column) -> Column:
    """Remove control characters anywhere in the text."""
    return F.translate(text, CONTROL_CHARACTERS, "")


def null_words(text: Column) -> Column:
    """NULL where the text is one of the words that stand for a missing value."""
    return F.when((F.length(text) > LONGEST_NULL_WORD) | ~F.lower(text).isin(NULL_WORDS), text)


def stripped(text: Column) -> Column:
    """Trimmed and without control characters; one look at a text that needs neither."""
    return F.when(text.rlike(PLAIN), text).otherwise(strip_control(strip_blank(text)))


def clean_text(text: Column) -> Column:
    """Trim, drop control characters, then turn NULL words into NULL."""
    return null_words(strip_control(strip_blank(text)))


def parse_number(text: Column) -> Column:
    """Text to double, NULL where the whole text is not a plain number."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def parse_timestamp(text: Column) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss`` to a zone-free timestamp, else NULL."""
    return F.when(text.rlike(TIMESTAMP), text.try_cast("timestamp_ntz"))


def timestamp_of(df: DataFrame, name: str) -> Column:
    """A text column as :func:`parse_timestamp` reads it; one that is parsed as it is."""
    column = F.col(name)
    return column if isinstance(df.schema[name].dataType, TimestampNTZType) else parse_timestamp(column)


def redact(text: Column) -> Column:
    """Mask the value part of password, token, key, secret and database URL texts."""
    text = F.regexp_replace(text, secret_value(SECRET_NAMES[0]), f"$1{MASK}")
    text = F.regexp_replace(text, URL_PASSWORD, f"$1{MASK}$3")
    for name in SECRET_NAMES[1:]:
        text = F.regexp_replace(text, secret_value(name), f"$1{MASK}")
    return text


def padded(number: Column, width: int) -> Column:
    """Zero-padded number text; longer numbers keep all their digits."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0")
