"""Personal data by fixed forms and by bootstrapped context.

Four fixed forms (email, ip, card, phone) give the base spans. They are seeds, as are tokens in the documented form of a secret
key. The surroundings of a seed are its lexical patterns: the word and the two words to the left, a label before it (``key=``, ``id:``),
the word to the right, and its own shape. Patterns and the distinct values seen with them form a bipartite graph with the
other identifier-like tokens, on which Spark scores patterns by their values and values by their patterns in turn. Patterns to the
left of high confidence name further identifiers that no form matches. Base spans always stay.

A pattern's confidence in a kind is the share of its values that are seeds of the kind, and of the other values their score, times
``LENT``. The score of a value for a pattern is the mean confidence of its patterns on other sides, so that no pattern lends to
itself or to its own longer form. Tokens that overlap a base span are no other values.
Only built-in functions are used.

Defined cases: a null text is empty and has no spans; offsets count code points, ends are exclusive;
matches that fail their check are dropped without another try; tokens are cut free of labels, quotes and signs around them; equal rows
each get their own result; an empty table gives no rows. Identifiers that overlap a base span are not added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
SECRET = len(BASE)

# The forms, written so that a scan is linear in the text: quantifiers that never need to give back are
# possessive, and a match starts at the start of its run of characters or where the match before ended.
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": r"\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
TOKEN = r"(?:(?<!\S)|\G)[^\s0-9@]*+[0-9@]\S*+"
#: Documented forms of secrets: digests used as keys, and the keys of two public services.
SECRET_FORM = "^(?:[0-9a-f]{40}|[0-9a-f]{64}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})$"
LABEL = r"^([\p{L}_-]{2,}[:=])"
BEFORE = r"^(?:[\p{L}_-]{2,}[:=])?[^\p{L}\p{N}+@]*"
AFTER = r"[^\p{L}\p{N}]*$"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

TAIL = 64
SUPPORT = 5
CONFIDENCE = 0.8
ROUNDS = 3
LENT = 0.5
BLOCK = 256
LEFT, RIGHT, SHAPE = "l", "r", "s"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        return (F.length(_digits(value)) <= 19) & luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "token":
        return (F.length(_digits(value)) >= 5) | (value.contains("@") & (F.length(value) >= 6))
    return F.lit(True)


def _lefts(piece: Column) -> Column:
    """The word before and the two words before, lower-cased; of the last characters of ``piece`` only."""
    tail = F.regexp_replace(F.lower(F.substring(piece, -TAIL, TAIL)), r"[\"'(\[{<]+$", "")
    one = F.regexp_extract(tail, r"(?<!\S)(\S+)\s{0,3}$", 1)
    two = F.regexp_replace(F.regexp_extract(tail, r"(?<!\S)(\S+\s{1,3}\S+)\s{0,3}$", 1), r"\s+", " ")
    return F.filter(F.array(one, two), lambda x: x != "")


def _right(piece: Column) -> Column:
    """The word after, lower-cased, without the signs that follow the value."""
    return F.regexp_extract(F.lower(F.substring(piece, 1, TAIL)), r"^[^\p{L}\p{N}\s]{0,4}\s{1,3}(\S+)", 1)


def _shape(value: Column) -> Column:
    """Classes of the characters; runs of letters or digits count as one, but keys and numbers keep their length."""
    runs = F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), r"\p{N}+", "9")
    return (
        F.when(value.rlike("^[0-9]+$"), F.concat(F.lit("number"), F.length(value)))
        .when(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), F.concat(F.lit("hex"), F.length(value)))
        .otherwise(runs)
    )


def _patterns(lefts: Column, right: Column, value: Column) -> Column:
    """The patterns of an occurrence, each with its side."""

    def of(side: str, x: Column) -> Column:
        return F.concat(F.lit(f"{side}:"), x)

    return F.array_distinct(
        F.concat(F.transform(lefts, lambda x: of(LEFT, x)), F.when(right != "", F.array(of(RIGHT, right))).otherwise(F.array().cast("array<string>")), F.array(of(SHAPE, _shape(value))))
    )


SPAN = "array<struct<start:bigint,rank:int,end:bigint,value:string,patterns:array<string>>>"


def _with_ends(cut: DataFrame, kinds: list[str]) -> DataFrame:
    """Adds, for each kind, where its matches end: the running sums of the sizes of pieces and matches.

    Sums run within blocks of ``BLOCK`` matches and then over the blocks, so that no long array grows one by one.
    """

    def sizes(k: str) -> Column:
        return F.zip_with(f"{k}_pieces", f"{k}_hits", lambda p, h: F.length(p).cast("bigint") + F.coalesce(F.length(h), F.lit(0)))

    def running(x: Column, before: bool) -> Column:
        zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("all"))

        def step(state: Column, size: Column) -> Column:
            at = state["at"] + size
            return F.struct(at.alias("at"), F.concat(state["all"], F.array(state["at"] if before else at)).alias("all"))

        return F.aggregate(x, zero, step, lambda s: s["all"])

    def blocks(k: str) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(f"{k}_sizes") - 1) / BLOCK).cast("int"))
        return F.transform(starts, lambda b: running(F.slice(f"{k}_sizes", b * BLOCK + 1, F.lit(BLOCK)), False))

    def ends(k: str) -> Column:
        bases = running(F.transform(f"{k}_blocks", lambda x: F.get(x, F.size(x) - 1)), True)
        return F.flatten(F.zip_with(f"{k}_blocks", bases, lambda x, base: F.transform(x, lambda e: e + base)))

    none = F.array().cast("array<bigint>")
    some = {k: F.size(f"{k}_hits") > 0 for k in kinds}
    cut = cut.select("*", *[F.when(some[k], sizes(k)).otherwise(none).alias(f"{k}_sizes") for k in kinds])
    cut = cut.select("*", *[F.when(some[k], blocks(k)).alias(f"{k}_blocks") for k in kinds])
    return cut.select("*", *[F.when(some[k], ends(k)).otherwise(none).alias(f"{k}_ends") for k in kinds])


def _spans(kind: str, rank: int) -> Column:
    """Matches with their places, from the text cut at the matches, the matches themselves and their ends."""
    pieces, hits, ends = (F.col(f"{kind}_{x}") for x in ("pieces", "hits", "ends"))

    def span(x: Column) -> Column:
        if kind == "token":
            lead, trail = F.length(F.regexp_extract(x["hit"], BEFORE, 0)), F.length(F.regexp_extract(x["hit"], AFTER, 0))
            value = F.substring(x["hit"], lead + 1, F.greatest(F.length(x["hit"]) - lead - trail, F.lit(0)))
            label = F.lower(F.regexp_extract(x["hit"], LABEL, 1))
            lefts = F.when(label != "", F.array(label)).otherwise(_lefts(x["piece"]))
            start, end = x["end"] - F.length(x["hit"]) + lead, x["end"] - trail
        else:
            value, lefts, start, end = x["hit"], _lefts(x["piece"]), x["end"] - F.length(x["hit"]), x["end"]
        own = F.when(value.rlike(SECRET_FORM), F.lit(SECRET)) if kind == "token" else F.lit(rank)
        return F.struct(
            start.alias("start"), own.cast("int").alias("rank"), end.alias("end"), value.alias("value"), _patterns(lefts, _right(x["next"]), value).alias("patterns")
        )

    zipped = F.arrays_zip(pieces.alias("piece"), hits.alias("hit"), F.slice(pieces, F.lit(2), F.size(pieces)).alias("next"), ends.alias("end"))
    found = F.filter(F.transform(F.slice(zipped, F.lit(1), F.size(hits)), span), lambda s: _valid(kind, s["value"]))
    return F.when(F.size(hits) > 0, found).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``base`` and ``tokens``: the spans of the fixed forms, and of the identifier-like tokens that overlap none of them."""
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    forms = [*FORMS.items(), ("token", TOKEN)]
    none = F.array().cast("array<string>")
    cut = own.select(
        "key",
        *[
            F.when(F.col("text").rlike(NEEDS.get(k, "[0-9@]")), F.split("text", p, -1)).otherwise(none).alias(f"{k}_pieces")
            for k, p in forms
        ],
        *[
            F.when(F.col("text").rlike(NEEDS.get(k, "[0-9@]")), F.regexp_extract_all("text", F.lit(p), F.lit(0)))
            .otherwise(none)
            .alias(f"{k}_hits")
            for k, p in forms
        ],
    )
    spans = [_spans(k, rank).alias(k) for rank, (k, _) in enumerate(forms)]
    found = _with_ends(cut, [k for k, _ in forms]).select("key", *spans).select("key", F.sort_array(F.concat(*BASE)).alias("base"), F.col("token").alias("tokens"))
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return found.select("key", "base", free.alias("tokens"))


def score_patterns(spans: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """``pattern``, ``rank`` (of the kind), ``conf`` of the patterns whose confidence is high.

    Patterns with fewer than ``support`` distinct seeds of a kind never count for it.
    """
    seen = spans.select(F.explode(F.concat("base", "tokens")).alias("s"))
    edges = seen.select("s.value", "s.rank", F.explode("s.patterns").alias("pattern"))
    edges = edges.groupBy("pattern", "value").agg(F.max("rank").alias("rank"))
    strong = edges.groupBy("pattern").agg(F.count("rank").alias("seeds"), F.count("*").alias("values")).filter(F.col("seeds") >= support)
    graph = written(edges.join(strong, "pattern"), "pattern-graph")
    kinds = graph.filter("rank is not null").groupBy("pattern", "rank").agg(F.count("*").alias("of_kind")).filter(F.col("of_kind") >= support)
    certain = kinds.join(strong.select("pattern", "values"), "pattern")
    conf = written(certain.select("pattern", "rank", (F.col("of_kind") / F.col("values")).alias("conf")), "pattern-conf")
    open_edges = graph.filter("rank is null").select("pattern", F.substring("pattern", 1, 1).alias("side"), "value")
    of_value = open_edges.groupBy("value").agg(F.count("*").alias("degree"))
    by_side = open_edges.groupBy("value", "side").agg(F.count("*").alias("of_side"))
    others = written(
        open_edges.join(by_side, ["value", "side"]).join(of_value, "value").select(
            "pattern", "side", "value", (F.col("degree") - F.col("of_side")).alias("others")
        ),
        "pattern-values",
    )
    for _ in range(rounds - 1):
        given = open_edges.join(conf, "pattern").groupBy("value", "rank", "side").agg(F.sum("conf").alias("given"))
        total = given.groupBy("value", "rank").agg(F.sum("given").alias("total"))
        own = given.select("value", "rank", "side", F.col("given").alias("own"))
        score = (F.col("total") - F.coalesce("own", F.lit(0.0))) / F.col("others")
        lent = (
            others.filter("others > 0")
            .join(total, "value")
            .join(own, ["value", "rank", "side"], "left")
            .groupBy("pattern", "rank")
            .agg(F.sum(score).alias("lent"))
        )
        conf = written(
            certain.join(lent, ["pattern", "rank"], "left").select(
                "pattern", "rank", ((F.col("of_kind") + LENT * F.coalesce("lent", F.lit(0.0))) / F.col("values")).alias("conf")
            ),
            "pattern-conf",
        )
    return conf.filter(F.col("conf") >= confidence)


def personal_data(
    docs: DataFrame, key: str = "doc_id", text: str = "text", support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS
) -> DataFrame:
    """One row per row of ``docs``: key, counts and digest of the base spans, all spans, and how many were added.

    The spans are written once, without the texts; all later work reads only them.
    """
    spans = written(scan(docs, key, text).withColumn("row", F.monotonically_increasing_id()), "spans")
    patterns = score_patterns(spans, support, confidence, rounds).filter(F.col("pattern").startswith(f"{LEFT}:"))
    free = spans.filter(F.size("tokens") > 0).select("row", F.explode("tokens").alias("t"))
    named = free.select("row", "t.start", "t.end", F.explode("t.patterns").alias("pattern")).join(patterns, "pattern")
    best = named.groupBy("row", "start", "end").agg(F.max(F.struct("conf", (-F.col("rank")).alias("order"))).alias("b"))
    added = best.groupBy("row").agg(
        F.collect_list(F.struct("start", (-F.col("b.order")).cast("int").alias("rank"), "end")).alias("added")
    )
    joined = spans.join(added, "row", "left").select(
        "key",
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))).alias("base"),
        F.coalesce("added", F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")).alias("added"),
    )
    return joined.select(
        F.col("key").alias(key),
        *[_count(rank).alias(f"n_{kind}") for rank, kind in enumerate(BASE)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.sort_array(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def _count(rank: int) -> Column:
    return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["rank"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
