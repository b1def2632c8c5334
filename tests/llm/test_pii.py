"""Base spans against plain Python, and the bootstrap."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from weftable.llm import pii

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def keeps(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def plain(text):
    found = [
        (m.start(), rank, m.end(), kind)
        for rank, (kind, form) in enumerate(FORMS.items())
        for m in re.finditer(form, text or "")
        if keeps(kind, m.group())
    ]
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found))


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.personal_data(df).collect():
        base = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), (texts[r.doc_id], base, r.spans)
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(re.findall(rf"\b{k}:", base)) for k in FORMS]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    check(spark, [r.text for r in docs])


TRICKY = [
    "a@b.c@d.e", "a@b.c_d@e.f", "x a@b a@b.c. .@-.-", "é a.b+c@d-e.f\U0001F600g@h.i", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256", "001.002.3.255",
    "4111 1111 1111 1111", "4111-1111-1111-1111-2", "4111  1111 1111 1111", "1234567890123", "+1 (679) 555-1339", "+1-2-3 +12345678", "+1 23.", "+123456789012345678",
    "++49 30 123456", "0" * 19, "0" * 20, "5" * 30_000, "a" * 30_000 + "@b.c", "1." * 20_000, "+1" + " " * 30_000, None, "", "1 " * 20_000, "@" * 5_000,
]


def test_tricky_texts(spark):
    check(spark, TRICKY)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab@.-+ 0145()é_\U0001F600", max_size=60), min_size=60, max_size=60))
def test_random_texts(spark, texts):
    check(spark, texts)


def test_contexts_find_unseen_identifiers(spark):
    seeds = [f"please write to user{i}@host{i}.example.org today" for i in range(12)]
    more = ["please write to jo(at)host99.example.org99 today", "in the year 2024-12345 we met"]
    plain_words = [f"nothing of note in text number {10_000 + i} here" for i in range(30)]
    texts = seeds + more + plain_words
    rows = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    by = {r.doc_id: r for r in rows}
    found = by[12].spans
    assert by[12].n_added == (1 if found else 0)
    assert sum(r.n_added for r in rows if r.doc_id != 12) == 0
    seen = ["please write to jo12345 today"]
    rows = pii.personal_data(spark.createDataFrame(list(enumerate(seeds + seen + plain_words)), "doc_id long, text string")).collect()
    by = {r.doc_id: r for r in rows}
    assert by[12].spans == "email:16:23" and by[12].n_email == 0 and by[12].n_added == 1
    assert all(r.n_added == 0 for r in rows if r.doc_id != 12)


def rows_of(spark, texts):
    rows = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {r.doc_id: r for r in rows}


def added(text, kind, value):
    at = text.index(value)
    return f"{kind}:{at}:{at + len(value)}"


HEX = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(30)]
NOISE = [f"chapter {i} has the number 4711{i:04} in it, and {HEX[i % 7].upper()} too" for i in range(40)]


def test_secrets_after_a_known_context(spark):
    """Keys in the documented form teach the context; what stands there in another form is found, and nothing else."""
    seeds = [f"some words token = \"{h}\" and more words" for h in HEX]
    unseen = ["a line with token = \"AB12-CD34-EF56-7890\" in it", "TOKEN = \"" + HEX[3].upper() + "\"!! OF", "token = 'zz9876543210zz'."]
    texts = seeds + unseen + NOISE + ["a hash " + HEX[4].upper() + " alone", f"commit {HEX[5]} alone"]
    by = rows_of(spark, texts)
    for i, value in enumerate(("AB12-CD34-EF56-7890", HEX[3].upper(), "zz9876543210zz")):
        assert by[len(seeds) + i].spans == added(unseen[i], "secret", value) and by[len(seeds) + i].n_added == 1
    assert all(by[i].spans == added(seeds[i], "secret", HEX[i]) for i in range(len(seeds)))
    assert sum(by[i].n_added for i in range(len(seeds) + len(unseen), len(texts))) == 0


def test_labels_and_cards(spark):
    def card(i):
        digits = f"411111{i:09}"
        return next(digits + c for c in "0123456789" if luhn(digits + c))

    seeds = [f"pay card:{card(i)} now please" for i in range(20)]
    wrong = card(77)[:-1] + str((int(card(77)[-1]) + 1) % 10)
    texts = [*seeds, f"pay card:{wrong} now please", f"no context {wrong} at all", *NOISE]
    by = rows_of(spark, texts)
    assert by[20].spans == added(texts[20], "card", wrong) and (by[20].n_card, by[20].n_added) == (0, 1)
    assert sum(r.n_added for r in by.values()) == 1


def test_no_pattern_lends_to_itself(spark):
    """A pattern that is right in half of its values stays out, however many rounds and twins it has."""
    seeds = [f"write to user{i}@host{i}.example.org. today" for i in range(12)]
    other = [f"write to number{i}12345 today" for i in range(13)]
    spans = pii.scan(spark.createDataFrame(list(enumerate(seeds + other)), "k long, text string"), "k", "text")
    for rounds in (1, 3, 9):
        assert pii.score_patterns(spans, rounds=rounds).where("pattern like 'l:%'").collect() == []
    assert all(r.n_added == 0 for r in rows_of(spark, seeds + other).values())


def test_tokens_over_base_spans_are_no_other_values(spark):
    seeds = [f"write to user{i}@host{i}.example.org. today" for i in range(12)]
    spans = pii.scan(spark.createDataFrame(list(enumerate(seeds)), "k long, text string"), "k", "text")
    assert all(r.tokens == [] for r in spans.collect())
    found = {r.pattern: r.conf for r in pii.score_patterns(spans).collect()}
    assert found["l:to"] == found["l:write to"] == found["r:today"] == 1.0


def test_many_matches(spark):
    texts = ["1.2.3.4 " * 3000, "x " * 300 + "+1 (679) 555-1339 " * 700]
    check(spark, texts)
