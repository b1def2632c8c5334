"""Fill-in-middle: each text cut in three at two places, and put together as prefix, suffix, middle.

A text is a sequence of units: characters (code points), words (with the blanks after them) or lines (with their end).
Every character has a class and a bit that tells whether it ends a run of blanks; a wavelet matrix over these symbols, one for many
texts, counts the characters that end a unit before any place as a sum of ranks, and bisection on these counts finds
both cuts of all texts at once. Cuts lie at two places drawn from the hash of the key and a seed.

Forms: ``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` is <S>suffix<P>prefix<M>middle, ``plain`` the text itself. ``restore`` gives
the exact text back.

Defined cases: a null text is empty; empty texts and texts that hold a mark are plain; a null key hashes as an empty one; leading
blanks are a word of their own; a last unit needs no end; equal rows get equal results; an empty table gives no rows. Only the key
and the results are returned, whatever other columns the table has.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import batches
from .wavelet import WaveletMatrix

MARKS = ("<P>", "<S>", "<M>")
PLAIN, SPM = 10, 20  # per cent of texts left plain, and of the others put suffix first

LOWER, UPPER, DIGIT, BLANK, NEWLINE, STOP, SIGN, OTHER = range(8)
LAST = 8  # the next character is blank and this one not, or the other way round, or there is none
BITS = 4
#: Symbols of the characters that end a unit.
ENDS = {
    "char": np.arange(1 << BITS),
    "word": np.array([BLANK | LAST, NEWLINE | LAST]),
    "line": np.array([NEWLINE, NEWLINE | LAST]),
}

_UNKNOWN = 255
_classes = np.full(0x110000, _UNKNOWN, dtype=np.uint8)


def _class(c: str) -> int:
    if c == "\n":
        return NEWLINE
    if c.isspace():
        return BLANK
    if c in ".!?":
        return STOP
    first = unicodedata.category(c)[0]
    if first == "L":
        return UPPER if c.isupper() else LOWER
    return {"N": DIGIT, "P": SIGN, "S": SIGN}.get(first, OTHER)


def symbols_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all characters of all texts, and where each text starts (one more entry than texts)."""
    at = np.cumsum([0] + [len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = _classes[codes]
    if (out == _UNKNOWN).any():
        for code in np.unique(codes[out == _UNKNOWN]).tolist():
            _classes[code] = _class(chr(code))
        out = _classes[codes]
    blank = (out == BLANK) | (out == NEWLINE)
    last = np.ones(len(out), dtype=bool)
    last[:-1] = blank[:-1] != blank[1:]
    last[at[1:][at[1:] > at[:-1]] - 1] = True
    return out + LAST * last.astype(np.uint8), at


def cuts(texts: list[str], h1: np.ndarray, h2: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and the code points before its first and second cut."""
    symbols, at = symbols_of(texts)
    ends = ENDS[unit]
    matrix = WaveletMatrix(symbols, BITS)
    begin, end = at[:-1], at[1:]
    before = matrix.count(ends, at)
    base = before[:-1]
    ended = before[1:] - base
    filled = end > begin
    units = ended.copy()
    units[filled] += ~np.isin(symbols[end[filled] - 1], ends)
    drawn = np.sort(np.stack([h1 % (units + 1), h2 % (units + 1)]), axis=0)
    found = matrix.place(ends, (drawn + base).ravel(), np.tile(begin, 2), np.tile(end, 2)).reshape(2, -1)
    return units, found[0] - begin, found[1] - begin


def _cuts(text: pd.Series, h1: pd.Series, h2: pd.Series, unit: pd.Series) -> pd.DataFrame:
    texts, a, b = text.tolist(), h1.to_numpy(), h2.to_numpy()
    parts = [cuts(texts[lo:hi], a[lo:hi], b[lo:hi], unit.iloc[0]) for lo, hi in batches(texts)]
    empty = np.zeros(0, dtype=np.int64)
    n, first, second = (np.concatenate(x) for x in zip(*parts)) if parts else (empty, empty, empty)
    return pd.DataFrame({"n": n, "first": first, "second": second})


def _draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned numbers of 32 bits from the hash of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "char", seed: int = 1, plain: int = PLAIN, spm: int = SPM
) -> DataFrame:
    """``key, n`` (units), ``form, prefix_chars, middle_chars`` (code points, null if plain), ``output``."""
    if unit not in ENDS:
        raise ValueError(f"unit must be one of {sorted(ENDS)}")
    own = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    h1, h2, h3, h4 = _draws(F.col("key"), seed)
    held = (F.col("text") == "") | (h3 % 100 >= 100 - plain)
    for mark in MARKS:
        held |= F.col("text").contains(mark)
    form = F.when(held, "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    at = F.pandas_udf(_cuts, "n long, first long, second long")
    cut = own.select("key", "text", form.alias("form"), at("text", h1, h2, F.lit(unit)).alias("cut"))
    first, second = F.col("cut.first").cast("int"), F.col("cut.second").cast("int")
    body = F.col("text")
    prefix, middle = F.substring(body, F.lit(1), first), F.substring(body, first + 1, second - first)
    suffix = F.substring(body, second + 1, F.length(body))
    p, s, m = (F.lit(x) for x in MARKS)
    output = (
        F.when(F.col("form") == "plain", body)
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
    )
    formed = F.col("form") != "plain"
    return cut.select(
        F.col("key").alias(key),
        F.col("cut.n").alias("n"),
        "form",
        F.when(formed, F.col("cut.first")).alias("prefix_chars"),
        F.when(formed, F.col("cut.second") - F.col("cut.first")).alias("middle_chars"),
        output.alias("output"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of: marks never stand within its parts."""
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(F.get(parts, 1), F.get(parts, 3), F.get(parts, 2)))
        .otherwise(F.concat(F.get(parts, 2), F.get(parts, 3), F.get(parts, 1)))
    )
