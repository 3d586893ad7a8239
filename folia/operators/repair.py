"""Repairs of mathematical markup that need a scanner with state, as Arrow user functions over whole texts.

Null in, null out. A text without a fault comes back unchanged.
"""


import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What makes the content of a group with a plain closer a formula: a command or a script, or a single letter other than "i".
TEXISH = re.compile(r"\\[a-zA-Z]{2,}|[\^_]")
SINGLE = re.compile(r"^[A-Za-hj-z]['′]*$|^[A-Z]['′]*$")
KINDS = {op: (cl, re.compile(rf"(?s)\\(.)|[\{op}\{cl}]"), re.compile(rf"\s*\\\{cl}")) for op, cl in ("()", "[]")}

ROMAN = {"i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii"}
LETTERS = set("abcdefghjklmnopqrstuvwxyzABCDEFGHIJKLMNPQRSTUVWXYZ")
STOP = set(
    "le la les un une des du de et ou où si on en par pour avec sans sur sous dans est sont cas resp voir cf loc cit exemple ex chap exp sga ega page pages ibid donc alors comme que qui ne pas plus "
    "tout tous toute notations notation the of and see dire être avoir aussi ici après avant".split()
)
MASKED = re.compile(r"(?s)<!--.*?-->|(?<!\\)\\\[.*?(?<!\\)\\\]|(?<!\\)\\\(.*?(?<!\\)\\\)|<[^>]+>")
WORD = re.compile(r"[a-zàâçéèêëîïôûùüÿœ]{2,}")
CHARSET = re.compile(r"^[A-Za-z0-9À-ÿ'′,;:=+\-*/|!.\s(){}\[\]\\^_&#]+$")


def one_kind(text: str, op: str, log: list[str]) -> str:
    """Repairs one kind of delimiter in one pass; `groups` has the place of each open delimiter and the depth of plain ones in it, innermost last."""
    cl, token, closer = KINDS[op]
    gone, added, groups, at = [], set(), [], 0
    while m := token.search(text, at):
        i, at = m.start(), m.end()
        if m[1] == op:
            groups.append([i, 0])
        elif m[1] == cl and len(groups) > 1:
            inner, depth = groups.pop()
            groups[-1][1] += depth
            gone += [inner, i]
            log.append(f"nested at {inner}")
        elif m[1] == cl and groups:
            groups.pop()
        elif m[1] == cl == ")":
            gone.append(i)
            log.append(f"stray closer at {i}")
        elif m[0] == op and groups:
            groups[-1][1] += 1
        elif m[0] == cl and groups:
            if groups[-1][1]:
                groups[-1][1] -= 1
                continue
            start = groups.pop()[0]
            if groups:
                gone.append(start)
                log.append(f"nested at {start}")
            elif after := closer.match(text, at):
                at = after.end()
            elif TEXISH.search(content := text[start + 2 : i]) or SINGLE.match(content.strip()):
                added.add(i)
                log.append(f"plain closer at {i}")
            else:
                gone.append(start)
                log.append(f"literal opener at {start}")
    for inner, _ in groups[1:]:
        gone.append(inner)
        log.append(f"nested at {inner}")
    if groups:
        log.append("unclosed")
    out, last = [], 0
    for k in sorted([*gone, *added]):
        out += [text[last:k], "\\" if k in added else ""]
        last = k if k in added else k + 1
    return "".join(out) + text[last:]


def delimiters(text: str) -> tuple[str, list[str]]:
    """Balances \\( \\) and \\[ \\]: the innermost nested pair or opener becomes plain; an opener answered by a plain closer gets a real one if it holds a formula and becomes plain otherwise; \\) without an opener becomes plain; what stays open is reported."""
    log: list[str] = []
    for op in KINDS:
        text = one_kind(text, op, log)
    return text, log


def is_math(inner: str) -> bool:
    """Whether a bare parenthesis holds a formula: not an enumerator, a number, a citation, an acronym or prose."""
    c = inner.strip()
    if not c or "\0" in c:
        return False
    if c.lower() in ROMAN or len(c) == 1:
        return c in LETTERS
    if re.fullmatch(r"[A-Za-z]['′]+", c):
        return True
    if re.fullmatch(r"[A-Z]{2,}", c) or re.fullmatch(r"[\d.,;\s\-–]+", c) or re.search(r"(^|\s)\[\d+\]", c) or re.search(r"\((?:i|ii|iii|iv|vi|vii|viii|ix)\)", c):
        return False
    bare = re.sub(r"&[a-z]+;", " ", re.sub(r"\\[a-zA-Z]+", " ", c.replace("\\acute et", " ")))
    if not STOP.isdisjoint(WORD.findall(bare)) or not CHARSET.match(c):
        return False
    return bool(re.search(r"\\[a-zA-Z]{2,}|[\^_=/(]|&lt;|&gt;", c) or re.fullmatch(r"[A-Za-z]['′]*([,;:][ ]?[A-Za-z]['′]*)+", c))


def paired(masked: str) -> list[tuple[int, int]]:
    """Places of matching parentheses, by their openers; those without a partner are left out."""
    opened, out = [], []
    for m in re.finditer("[()]", masked):
        if m[0] == "(":
            opened.append(m.start())
        elif opened:
            out.append((opened.pop(), m.start()))
    return sorted(out)


def unwrapped(content: str) -> str:
    """Inline math delimiters as plain parentheses."""
    return content.replace("\\(", "(").replace("\\)", ")")


def edited(text: str, edits: list[tuple[int, int, str]]) -> str:
    """Replaces spans that don't overlap; places are those of the text before any edit."""
    out, last = [], 0
    for a, b, new in sorted(edits):
        out += [text[last:a], new]
        last = b
    return "".join(out) + text[last:]


def holds_residue(residue: str) -> bool:
    """Whether what stands around whole formulas in a group is mathematics too, and no prose."""
    return STOP.isdisjoint(WORD.findall(re.sub(r"\\[a-zA-Z]+", " ", residue))) and bool(re.search(r"\\[a-zA-Z]{2,}|[\^_=]", residue)) and bool(CHARSET.match(residue or "x"))


def wrap_bare(text: str, merge: bool = False) -> tuple[str, list[str]]:
    """Outermost balanced groups outside math, tags and comments that hold a formula get inline delimiters for their parentheses; other groups are searched inside. With merge, a group of formulas and raw mathematics becomes one formula, the delimiters inside it dropped."""
    masked = MASKED.sub(lambda m: "\0" * len(m[0]), text)
    edits, log, last = [], [], -1
    for a, b in paired(masked):
        if a <= last:
            continue
        inner = masked[a + 1 : b]
        if is_math(inner):
            edits += [(a, a + 1, "\\("), (b, b + 1, "\\)")]
            log.append(text[a + 1 : b])
            last = b
        elif merge and "\0" in inner and holds_residue(inner.replace("\0", "")):
            edits.append((a, b + 1, "\\(" + re.sub(r"\\(?=[()])", "", text[a + 1 : b]) + "\\)"))
            log.append(f"merged: {text[a + 1 : b]}")
            last = b
    return edited(text, edits), log


#: What stands directly before an inner delimiter only inside a formula.
ADJACENT = re.compile(r"[A-Za-z0-9}=_^|/+\-'′]\\\(")
HIDDEN = re.compile(r"(?s)<!--.*?-->|(?<!\\)\\\[.*?(?<!\\)\\\]|<[^>]+>")


def swap_delimiters(text: str) -> tuple[str, list[str]]:
    """Plain groups around inline delimiters that should have stood outside: where a delimiter follows a letter or sign without a blank, or raw mathematics stands outside the inner formulas, and no prose does, the group becomes one formula with plain parentheses inside. Groups inside a formula are searched, those inside a plain group aren't."""
    masked = HIDDEN.sub(lambda m: "\0" * len(m[0]), text)
    edits, log, last = [], [], -1
    for a, b in paired(masked):
        if a <= last or masked[a - 1 : a] == "\\":
            continue
        last = b
        inner = masked[a + 1 : b]
        if "\0" in inner or "\\(" not in inner:
            continue
        outside = re.sub(r"(?s)\\\(.*?\\\)", " ", inner)
        if (ADJACENT.search(inner) or TEXISH.search(outside)) and STOP.isdisjoint(WORD.findall(re.sub(r"\\[a-zA-Z]+", " ", outside))):
            edits.append((a, b + 1, "\\(" + unwrapped(text[a + 1 : b]) + "\\)"))
            log.append(text[a : b + 1])
    return edited(text, edits), log


def point_fixed(rows: DataFrame, fixes: DataFrame, key: str = "chapter_id", text: str = "src") -> DataFrame:
    """Literal replacements (key, ord, old, new) in the texts of their key, in order, one after the other; adds hits: how often each was found, 0 for a miss."""
    lists = fixes.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", "old", "new"))).alias("_fixes"))  # a short list for each text
    start = F.struct(F.col(text).alias("t"), F.array().cast("array<int>").alias("hits"))

    def step(a, x):
        n = (F.length(a["t"]) - F.length(F.replace(a["t"], x["old"], F.lit("")))) / F.length(x["old"])
        return F.struct(F.replace(a["t"], x["old"], x["new"]).alias("t"), F.concat(a["hits"], F.array(n.cast("int"))).alias("hits"))

    done = rows.join(lists, key, "left").withColumn("_done", F.aggregate(F.coalesce("_fixes", F.array().cast("array<struct<ord:int,old:string,new:string>>")), start, step))
    return done.select(*[F.col("_done.t").alias(c) if c == text else F.col(c) for c in rows.columns], F.col("_done.hits").alias("hits"))


def _column(f):
    @F.pandas_udf("text string, log array<string>")
    def run(texts: pd.Series) -> pd.DataFrame:
        got = [(None, None) if t is None else f(t) for t in texts]
        return pd.DataFrame({"text": [t for t, _ in got], "log": [x for _, x in got]})

    return run


def repaired_delimiters(c):
    return _column(delimiters)(c)


def wrapped_math(c):
    return _column(wrap_bare)(c)


def merged_math(c):
    return _column(lambda t: wrap_bare(t, merge=True))(c)


def swapped_delimiters(c):
    return _column(swap_delimiters)(c)
