"""Auxiliary files of a TeX run: the files that inputs reach, their labels and citation marks.

Files are rows (path, text). Null text: no labels and no inputs. A label
without all its groups has empty fields; one whose braces never close is left out.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.operators.tex import group

ENTRY = re.compile(r"\\(newlabel|bibcite)\{")
SCHEMA = "path string, pos int, entry string, key string, num string, display string, anchor string, kind string"


def reachable(files: DataFrame, roots: DataFrame, most_rounds: int = 32) -> DataFrame:
    """The files (path, text) that the roots (path) reach by inputs, each once; inputs are named from the folder of the file that holds them. Only paths go round: a round is one join of new paths with the input edges."""
    folder = F.regexp_extract("path", r"^(.*/)?[^/]*$", 1)
    edges = files.select("path", folder.alias("folder"), F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\\@input\{([^}]*)\}"), F.lit(1))).alias("name"))
    edges = edges.select("path", F.concat("folder", "name").alias("child")).distinct().persist()
    known = roots.select("path").distinct()
    new = known
    for _ in range(most_rounds):
        new = new.join(edges, "path").select(F.col("child").alias("path")).distinct().join(known, "path", "left_anti").persist()
        if new.isEmpty():
            break
        known = known.unionByName(new)
    else:
        raise ValueError(f"inputs are nested deeper than {most_rounds} files")
    return files.join(known, "path", "left_semi")


def bare(number: str) -> str:
    """A number as it is shown: braces around the whole, dollar signs and thin spaces away, ties as spaces."""
    number = number.strip()
    while number.startswith("{") and group(number, 1) == len(number) and number.endswith("}"):
        number = number[1:-1].strip()
    return number.replace("$", "").replace("\\,", "").replace("~", " ").strip()


def groups(text: str, at: int, most: int | None = None) -> list[str]:
    """The brace groups from a place on; with `most`, only so many that follow one another. The text ends in a blank: a group that runs into it is never closed."""
    out: list[str] = []
    while at < len(text) and (most is None or len(out) < most):
        if text[at] == "{":
            end = group(text, at + 1)
            if text[end - 1] != "}":
                break
            out.append(text[at + 1 : end - 1])
            at = end
        elif most is not None and not text[at].isspace():
            break
        else:
            at += 1
    return out


def entries(text: str | None) -> list[tuple[str, str, str, str, str, str]]:
    """(entry, key, num, display, anchor, kind) of each label and citation mark."""
    out = []
    text = (text or "") + " "
    for m in ENTRY.finditer(text):
        pair = groups(text, m.end() - 1, 2)
        if len(pair) < 2:
            continue
        key, body = pair
        if m[1] == "bibcite":
            out.append(("cite", key, body.strip(), bare(body), "", ""))
            continue
        parts = groups(body + " ", 0)
        num, anchor = (parts[k].strip() if len(parts) > k else "" for k in (0, 3))
        out.append(("label", key, num, bare(num), anchor, anchor.partition(".")[0]))
    return out


def labels(files: DataFrame) -> DataFrame:
    """A row for each label and citation mark of each file; a key defined again is answered by links.last_wins over (path, pos)."""

    def run(frames):
        for frame in frames:
            rows = [(path, k, *e) for path, text in zip(frame["path"], frame["text"], strict=True) for k, e in enumerate(entries(text))]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return files.select("path", "text").mapInPandas(run, SCHEMA)
