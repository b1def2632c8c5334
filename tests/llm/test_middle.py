"""Fill-in-middle against plain cuts, and its wavelet matrix against counting."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import ODD, frame
from weftable.llm.middle import ENDS, MARKS, cuts, fill_in_middle, restore
from weftable.llm.wavelet import WaveletMatrix

PATTERN = {"char": r"(?s).", "word": r"^\s+|\S+\s*", "line": r"[^\n]*\n|[^\n]+"}


def units(text, unit):
    return re.findall(PATTERN[unit], text)


def plain_output(key, text, unit="char"):
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    parts = units(text, unit)
    a, b = sorted((h[0] % (len(parts) + 1), h[1] % (len(parts) + 1)))
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 90:
        return len(parts), "plain", None, None, text
    prefix, middle, suffix = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < 20:
        return len(parts), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(parts), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 15), max_size=300))
def test_ranks(symbols):
    symbols = np.array(symbols, dtype=np.uint8)
    matrix = WaveletMatrix(symbols, 4)
    at = np.arange(len(symbols) + 1)
    ranks = matrix.rank(np.arange(16), at)
    for s in range(16):
        assert ranks[s].tolist() == [int((symbols[:i] == s).sum()) for i in at]
    some = np.array([1, 5, 9])
    k = np.arange(int(np.isin(symbols, some).sum()) + 2)
    found = matrix.place(some, k, np.zeros_like(k), np.full_like(k, len(symbols)))
    ends = [0] + [i + 1 for i in np.flatnonzero(np.isin(symbols, some)).tolist()] + [len(symbols)]
    assert found.tolist() == ends[: len(k)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aB1 .\n\té😀 \x00-", max_size=40), min_size=1, max_size=8), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
@pytest.mark.parametrize("unit", sorted(ENDS))
def test_cuts(unit, texts, a, b):
    n, first, second = cuts(texts, np.full(len(texts), a), np.full(len(texts), b), unit)
    for i, text in enumerate(texts):
        parts = units(text, unit)
        lo, hi = sorted((a % (len(parts) + 1), b % (len(parts) + 1)))
        assert (n[i], first[i], second[i]) == (len(parts), len("".join(parts[:lo])), len("".join(parts[:hi])))


ROWS = [*ODD, (20, "holds <M> a mark"), (21, "<<P"), (22, "ends with <"), (23, "S>P>M>"), *[(100 + i, f"text <{i}> of\n many words é😀{i}") for i in range(60)]]


@pytest.mark.parametrize("unit", sorted(ENDS))
def test_outputs(spark, unit):
    df = fill_in_middle(frame(spark, ROWS), unit=unit)
    assert df.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = df.select("*", restore(df["output"], df["form"]).alias("back")).collect()
    assert len(found) == len(ROWS) and {r.form for r in found} == {"plain", "psm", "spm"}
    expected = sorted(str((i, *plain_output(i, t or "", unit), t or "")) for i, t in ROWS)
    assert sorted(str(tuple(r)) for r in found) == expected


def test_seed_and_shares(spark):
    df = frame(spark, ROWS)
    assert {r.form for r in fill_in_middle(df, plain=100).collect()} == {"plain"}
    assert "psm" not in {r.form for r in fill_in_middle(df, spm=100).collect()}
    assert fill_in_middle(df, seed=2).collect() != fill_in_middle(df).collect()
    with pytest.raises(ValueError):
        fill_in_middle(df, unit="page")
