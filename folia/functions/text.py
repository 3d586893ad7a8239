"""Scalar text functions as Column expressions: everything stays in the JVM.

Whitespace is spelled out as [ \\t\\n\\r] so that results don't depend on an engine's idea of \\s.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = "[ \\t\\n\\r]"
TAG = "<[^>]*>"
#: The entities every HTML writer escapes.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]
MATH_TOKENS = ["\\(", "\\)", "\\[", "\\]", "\\begin{", "\\end{"]
COMMAND = r"\\[a-zA-Z]+"


def squeeze(c) -> Column:
    """Runs of blanks to one, ends trimmed."""
    return F.trim(F.regexp_replace(c, f"{BLANK}+", " "))


def visible_text(html) -> Column:
    """Scripts, styles, comments, tags and entities give way to blanks."""
    c = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    c = F.regexp_replace(c, TAG, " ")
    return squeeze(F.regexp_replace(c, r"&(?:[a-z]+|#x?[0-9a-fA-F]+);", " "))


def strip_math(c) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?s)\\\(.*?\\\)", " "), r"(?s)\\\[.*?\\\]", " ")


def escape_html(c) -> Column:
    for plain, safe in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(safe))
    return c


def unescape_html(c) -> Column:
    for plain, safe in reversed(ESCAPES):
        c = F.replace(c, F.lit(safe), F.lit(plain))
    return F.replace(F.replace(c, F.lit("&#39;"), F.lit("'")), F.lit("&nbsp;"), F.lit(" "))


def attribute_values(html, name: str) -> Column:
    """All values of an attribute, in order."""
    return F.regexp_extract_all(html, F.lit(rf'\b{name}="([^"]*)"'), F.lit(1))


def count_of(c, token: str) -> Column:
    """Occurrences of a literal."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(token), F.lit("")))) / F.lit(len(token))).cast("long")


def math_signature(c) -> Column:
    return F.array(*[count_of(c, t) for t in MATH_TOKENS])


def mask(c, pattern: str) -> Column:
    """Matched spans become as many NUL characters, so that offsets stay. Works for patterns that can't match the empty text."""
    pieces = F.regexp_extract_all(c, F.lit(f"(?s)({pattern})|(?:(?!{pattern}).)+"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(f"^(?s:{pattern})$"), F.repeat(F.lit("\0"), F.length(p))).otherwise(p)), "")


def protect(c, pattern: str) -> tuple[Column, Column]:
    """The text with its n-th match as [[Mn]], and the matches."""
    found = F.regexp_extract_all(c, F.lit(f"(?s){pattern}"), F.lit(0))
    pieces = F.split(c, f"(?s){pattern}", -1)
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit("[[M"), (i - 1).cast("string"), F.lit("]]"), p))), ""), found


def restore(text, kept) -> Column:
    """Placeholders back to what they stand for."""
    return F.aggregate(F.sequence(F.lit(0), F.size(kept)), text, lambda a, i: F.when(i < F.size(kept), F.replace(a, F.concat(F.lit("[[M"), i.cast("string"), F.lit("]]")), F.get(kept, i))).otherwise(a))


def once_each(text, n) -> Column:
    """Whether each of n placeholders stands exactly once in a text, and no other."""
    found = F.regexp_extract_all(text, F.lit(r"\[\[M([0-9]+)\]\]"), F.lit(1))
    return F.array_sort(F.transform(found, lambda x: x.cast("int"))).eqNullSafe(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")))


def needs_translation(c) -> Column:
    return F.regexp_replace(F.regexp_replace(c, TAG, ""), r"\[\[M[0-9]+\]\]", "").rlike("[A-Za-zÀ-ÿ]")


def core(c) -> Column:
    """(leading blanks, core, trailing blanks)."""
    lead, tail = F.regexp_extract(c, f"^({BLANK}*)", 1), F.regexp_extract(c, f"({BLANK}*)$", 1)
    inner = F.regexp_replace(F.regexp_replace(c, f"^{BLANK}+", ""), f"{BLANK}+$", "")
    return F.struct(F.when(inner == "", "").otherwise(lead).alias("lead"), inner.alias("core"), tail.alias("tail"))


def strip_comment(line) -> Column:
    """A TeX line up to its first unescaped percent sign; possessive, so long lines don't overflow the stack."""
    return F.regexp_replace(line, r"^((?:[^%\\]++|\\.)*+)%.*$", "$1")


def glossary(c, pairs: list[tuple[str, str]]) -> Column:
    """Ordered whole-word replacements without regard to case."""
    for old, new in pairs:
        c = F.regexp_replace(c, rf"(?i)(?<![A-Za-z0-9_]){old}(?![A-Za-z0-9_])", new)
    return c


def words(c) -> Column:
    """Lower-case words of ASCII and Latin-1 letters."""
    return F.regexp_extract_all(F.lower(c), F.lit("([a-zà-ÿ]+)"), F.lit(1))


def share_of(tokens, vocabulary: list[str]) -> Column:
    return F.size(F.filter(tokens, lambda w: w.isin(vocabulary)))


def ngrams(tokens, n: int) -> Column:
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def title_parts(h1) -> Column:
    """A chapter heading: author span and notes out, line breaks to blanks, an EXPOSE-style prefix with its numeral split off."""
    author = F.regexp_extract(h1, r'(?s)<span class="author">(.*?)</span>', 1)
    bare = F.regexp_replace(F.regexp_replace(h1, r'(?s)<span class="author">.*?</span>', ""), r"(?s)<sup[^>]*>.*?</sup>", "")
    flat = squeeze(F.regexp_replace(F.regexp_replace(bare, r"<br ?/?>", " "), TAG, " "))
    numeral = F.regexp_extract(flat, r"^EXPOS[EÉ] ([IVXLC]+(?: ?[A-Z])?)(?: |$)", 1)
    title = F.trim(F.regexp_replace(flat, r"^EXPOS[EÉ] [IVXLC]+(?: ?[A-Z])?(?:[ .:—-]+|$)", ""))
    return F.struct(F.nullif(title, F.lit("")).alias("title"), F.nullif(numeral, F.lit("")).alias("numeral"), F.nullif(squeeze(F.regexp_replace(author, TAG, " ")), F.lit("")).alias("author"))


def block_type(tag, css) -> Column:
    """What a top-level element is: theorem kinds go by their first class that isn't a style."""
    kind = F.get(F.filter(F.split(css, " "), lambda c: ~c.isin("thm", "thm-plain", "thm-remark", "")), F.lit(0))
    return (F.when(tag.rlike("^h[1-6]$"), "heading").when(tag == "table", "table").when(tag.isin("ul", "ol", "dl"), "list")
            .when(F.array_contains(F.split(css, " "), "thm"), F.coalesce(kind, F.lit("theoreme"))).when(F.array_contains(F.split(css, " "), "proof"), "proof")
            .when(tag == "p", "paragraph").when(tag == "div", "div").otherwise(tag))


def page_id(chapter, index, anchor) -> Column:
    """An anchor with dots as dashes, or the chapter and a running number."""
    return F.coalesce(F.replace(anchor, F.lit("."), F.lit("-")), F.concat(chapter, F.lit("-s"), (index + 1).cast("string")))


def leaked_commands(html) -> Column:
    """TeX commands left outside math."""
    return F.regexp_extract_all(strip_math(F.regexp_replace(html, TAG, " ")), F.lit(f"({COMMAND})"), F.lit(1))
