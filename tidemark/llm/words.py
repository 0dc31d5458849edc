"""Texts as plain words, whatever their typography, spacing and markup."""

from __future__ import annotations

import html
import re
import unicodedata

import regex

# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans(
    "авекмнорстухіѕјӏԁАВЕКМНОРСТУХІЅЈ" + "αεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" + "ɡ",
    "abekmhopctyxisjldABEKMHOPCTYXISJ" + "aeikvoptuxABEZHIKMNOPTYX" + "g",
)

_LOOKALIKE = re.compile("[" + "".join(map(chr, LOOKALIKES)) + "]")
_TAG = regex.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:]*)(?:\s[^<>]*)?/?>|<!--.*?-->", regex.S)
_INLINE = {"b", "i", "em", "strong", "u", "s", "span", "a", "code", "sup", "sub", "mark", "small", "font", "wbr", "tt", "ins", "del"}
_INVISIBLE = regex.compile(r"[\p{Cf}\p{Mn}\p{Me}ᅟᅠㅤ]+")
_WORD = re.compile(r"[^\W_]+(?:[.,]\d+)*")
_APOSTROPHE = regex.compile(r"(?<=\p{L})['‘’ʼ´`](?=\p{L})")
_WRAPPED = regex.compile(r"(?<=\p{Ll})[-‐­]\r?\n\s*(?=\p{Ll})")
_THOUSANDS = regex.compile(r"(?<=\d),(?=\d{3}\b)")


def plain(text: str) -> str:
    """Without tags, entities, invisible characters, accents and typographic variants."""
    if "<" in text:
        text = _TAG.sub(lambda m: "" if (m[2] or "").lower() in _INLINE else " ", text)
    if "&" in text:
        text = html.unescape(text)
    if text.isascii():
        return text
    text = unicodedata.normalize("NFKD", text)
    return _LOOKALIKE.sub(lambda m: chr(LOOKALIKES[ord(m[0])]), _INVISIBLE.sub("", text))


def words(text: str | None) -> list[str]:
    """Lower-case words; a decimal number is one word, hyphens part words."""
    if not text:
        return []
    bare = _WRAPPED.sub("", plain(text))
    return _WORD.findall(_APOSTROPHE.sub("", bare).lower())
