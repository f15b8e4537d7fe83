"""Text cleaning as Column expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python-style ``strip`` removes; the JVM ``trim`` only knows ASCII space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace, non-breaking spaces included."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, SPACE_RUN, " ")


def clean_text(c: Column) -> Column:
    """Strip, collapse inner whitespace; blank and ``-`` become null."""
    text = collapse_spaces(strip(c))
    return F.when(~text.isin("", "-"), text)


def strip_html(c: Column) -> Column:
    """Drop tags and line feeds, strip, collapse whitespace."""
    bare = F.replace(F.regexp_replace(c, r"<[^>]*>", ""), F.lit("\n"), F.lit(""))
    return collapse_spaces(strip(bare))


def clean_html_list(values: Column) -> Column:
    """``strip_html`` on every element, dropping the ones left empty."""
    return F.filter(F.transform(values, strip_html), lambda v: v != "")


#: Between texts and between lists of them.
TEXT_END, LIST_END = "\x01", "\x02"
_SPACES = "".join(f"\\x{{{ord(c):x}}}" for c in sorted(set(WHITESPACE)))
#: Runs of whitespace other than one space; the first test passes over most characters.
_UNEVEN_RUN = rf"[^!-~](?:(?<=\x20)(?=[{_SPACES}])|(?<=[{_SPACES}&&[^\x20]]))[{_SPACES}]*+"


def clean_html_lists(lists: Column) -> Column:
    """``clean_html_list`` on every list of a list.

    All texts are joined and cleaned as one.  Where a text holds one of the two characters that then part them, or a list is null, each
    text is cleaned by itself.
    """
    joined = F.array_join(F.transform(lists, lambda texts: F.array_join(texts, TEXT_END)), LIST_END)

    def parted(all_texts: Column) -> Column:
        bare = F.replace(F.regexp_replace(all_texts, rf"<[^>{TEXT_END}{LIST_END}]*>", ""), F.lit("\n"), F.lit(""))
        even = F.split(F.regexp_replace(bare, _UNEVEN_RUN, " "), LIST_END, -1)
        return F.transform(even, lambda texts: F.filter(F.transform(F.split(texts, TEXT_END, -1), lambda t: F.trim(t)), lambda v: v != ""))

    def whole(all_texts: Column) -> Column:
        # as many ends as there should be, so none of them is part of a text
        ends = F.length(all_texts) - F.length(F.translate(all_texts, TEXT_END + LIST_END, ""))
        due = F.aggregate(lists, F.lit(-1).cast("bigint"), lambda n, texts: n + F.when(texts.isNull(), 1 << 40).otherwise(
            F.greatest(F.size(texts), F.lit(1))))
        return F.when(ends == due, parted(all_texts)).otherwise(F.transform(lists, clean_html_list))

    return F.get(F.transform(F.array(joined), whole), F.lit(0))


def normal_category(c: Column) -> Column:
    """Lower-case, spaces to ``_``, everything but word characters, ``-`` and spaces dropped."""
    return F.regexp_replace(F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_")), r"(?U)[^\w\s-]", "")


def fix_mojibake(c: Column) -> Column:
    """Undo UTF-8 text that was decoded as ISO-8859-1, drop control characters, strip.

    Only strings made of code points <= U+00FF can be such text (``encode`` raises
    on anything else), and only if the bytes form valid UTF-8; otherwise the text
    stays as it is.
    """
    narrow = c.rlike(r"\A[\x00-\xFF]*\z")
    redecoded = F.when(narrow, F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string")))
    return strip(F.regexp_replace(F.coalesce(redecoded, c), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""))


def has_text(c: Column) -> Column:
    """Whether anything is left by ``strip``; most texts show it by their first character."""
    return F.ascii(c).between(33, 126) | (strip(c) != "")


def is_blank(c: Column) -> Column:
    """True for null or whitespace-only."""
    return c.isNull() | (strip(c) == "")


def short_id(c: Column) -> Column:
    """Stable 16-hex-digit id of a URL."""
    return F.substring(F.sha2(c, 256), 1, 16)


def code_name(c: Column) -> Column:
    """``"3900 - NAME"`` as ``struct<code,name>``; without a separator name is null."""
    parts = F.split(c, " - ", 2)
    return F.struct(
        F.get(parts, F.lit(0)).alias("code"),
        F.get(parts, F.lit(1)).alias("name"),
    )
