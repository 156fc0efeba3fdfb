"""Personal data: exact patterns first, then bootstrapped extraction by context. DataFrame functions only.

The matches of the exact patterns are seeds. Every word that looks like an identifier is an instance, and the one and
two words before it are lexical patterns. The graph of patterns and instances is scored in rounds: a pattern by the
mean score of its distinct instances, an instance that is no seed by its best trusted pattern. Identifiers after
patterns that are trusted in the end, when a round adds none, are found as well, with kind ``id``. Scores move as sums per pattern and value,
which are built before the shuffle, so frequent contexts and values are no hot spots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import cut_lineage

TRUST = 0.8  # least score of a trusted pattern
SUPPORT = 5  # least sum of the instance scores behind it
DECAY = 0.9  # what an instance keeps of its pattern's score
LEAST = 6  # characters of an identifier

# The patterns, with possessive repetition and starts only where a run starts or the last match ended: that finds what
# plain repetition finds, in time proportional to the text.
_LOCAL = "A-Za-z0-9._%+-"
KINDS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINTS = {"email": "@", "ip": ".", "phone": "+"}
_WORD = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda digit: F.coalesce(digit.cast("int"), F.lit(0)))
    doubled = F.transform(
        values, lambda value, i: F.when(i % 2 == 0, value).when(value > 4, 2 * value - 9).otherwise(2 * value)
    )
    return F.aggregate(doubled, F.lit(0), lambda total, value: total + value) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"\A{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z")
    if kind == "card":
        # The pattern also matches a single digit, which is too short to matter.
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _spans(text: Column, pattern: str, keep, make) -> Column:
    """Array of ``make(match, text before it since the last one, start, end)`` of the matches ``keep`` accepts.

    What lies between the matches tells where they are, in code points.
    """
    between, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.filter(F.array(make(F.lit(""), F.lit(""), F.lit(0), F.lit(0))), lambda _: F.lit(False))
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(state, pair):
        low = state["at"] + F.length(pair["gap"])
        high = low + F.length(pair["match"])
        more = F.array(make(pair["match"], pair["gap"], low, high))
        found = F.when(keep(pair["match"]), F.concat(state["found"], more)).otherwise(state["found"])
        return F.struct(high.alias("at"), found.alias("found"))

    pairs = F.arrays_zip(F.slice(between, 1, F.size(matches)).alias("gap"), matches.alias("match"))
    return F.aggregate(pairs, start, step, lambda state: state["found"])


def _span(kind: str):
    return lambda match, gap, low, high: F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"))


def _of(kind: str):
    return lambda span: span["kind"] == kind


def base_spans(text: Column) -> Column:
    """Array of (kind, low, high) of the exact patterns, by kind as listed, then start."""
    none = F.array().cast("array<struct<kind: string, low: int, high: int>>")
    found = []
    for kind, pattern in KINDS.items():
        spans = _spans(text, pattern, lambda match, kind=kind: _valid(kind, match), _span(kind))
        has = text.contains(_HINTS[kind]) if kind in _HINTS else text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}")
        found.append(F.when(has, spans).otherwise(none))
    return F.concat(*found)


def _candidates(text: Column) -> Column:
    """Array of (low, high, value, one, two) of words with a digit or an at sign: the words before as contexts.

    Among the words before, one with an at sign counts as ``@`` and one with a digit as ``0``.
    """
    between, matches = F.split(text, _WORD, -1), F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    # The last word of a text without digits and at signs, and the one before it, found from the end.
    last, two = r"(?s)\A.*(?<!\S)(\S++)\s*+\z", r"(?s)\A.*(?<!\S)(\S++)\s++\S++\s*+\z"
    gaps = F.transform(
        F.slice(between, 1, F.size(matches)),
        lambda gap: F.struct(
            F.length(gap).alias("size"),
            F.lower(F.regexp_extract(gap, last, 1)).alias("one"),
            F.lower(F.regexp_extract(gap, two, 1)).alias("before"),
        ),
    )

    def make(match, low, one, before):
        # Signs around the word are no part of the identifier.
        lead = F.length(F.regexp_extract(match, r"\A[^A-Za-z0-9]*", 0))
        core = F.regexp_replace(match, r"\A[^A-Za-z0-9]+|[^A-Za-z0-9]+\z", "")
        return F.struct(
            (low + lead).alias("low"),
            (low + lead + F.length(core)).alias("high"),
            F.xxhash64(core).alias("value"),
            one.alias("one"),
            F.when(before != "", F.concat(before, F.lit(" "), one)).otherwise("").alias("two"),
        )

    def step(state, pair):
        gap, match = pair["gap"], pair["match"]
        low = state["at"] + gap["size"]
        none = gap["one"] == ""
        one = F.when(none, state["one"]).otherwise(gap["one"])
        before = F.when(none, state["before"]).when(gap["before"] == "", state["one"]).otherwise(gap["before"])
        found = F.when(
            F.length(match) >= LEAST, F.concat(state["found"], F.array(make(match, low, one, before)))
        ).otherwise(state["found"])
        return F.struct(
            (low + F.length(match)).alias("at"),
            found.alias("found"),
            F.when(match.contains("@"), "@").otherwise("0").alias("one"),
            one.alias("before"),
        )

    none = F.filter(F.array(make(F.lit(""), F.lit(0), F.lit(""), F.lit(""))), lambda _: F.lit(False))
    start = F.struct(F.lit(0).alias("at"), none.alias("found"), F.lit("").alias("one"), F.lit("").alias("before"))
    pairs = F.arrays_zip(gaps.alias("gap"), matches.alias("match"))
    found = F.aggregate(pairs, start, step, lambda state: state["found"])
    empty = F.array().cast("array<struct<low: int, high: int, value: bigint, one: string, two: string>>")
    usable = F.filter(found, lambda c: (c["high"] - c["low"] >= LEAST) & (c["one"] != ""))
    return F.when(text.rlike("[0-9@]"), usable).otherwise(empty)


def _trusted(edges: DataFrame) -> DataFrame:
    """Patterns that are trusted once a round adds none. ``edges`` has pattern, value and whether the value is a seed.

    Scores only rise, so a pattern stays trusted, and the rounds end.
    """
    unseen = edges.filter(~F.col("seed")).select("pattern", "value")
    sums = edges.groupBy("pattern").agg(F.sum(F.col("seed").cast("double")).alias("seeds"), F.count(F.lit(1)).alias("n"))
    # A pattern with too few instances can't be trusted whatever their scores are.
    sums = cut_lineage(sums.filter((F.col("n") >= SUPPORT) & (F.col("n") / (F.col("n") + 1) >= TRUST)))

    def trusted(scored: DataFrame) -> DataFrame:
        found = scored.withColumn("trust", F.col("sum") / (F.col("n") + 1))
        return cut_lineage(
            found.filter((F.col("trust") >= TRUST) & (F.col("sum") >= SUPPORT)).select("pattern", "trust")
        )

    now = trusted(sums.withColumnRenamed("seeds", "sum"))
    size, before = now.count(), 0
    while size > before:
        best = unseen.join(now, "pattern").groupBy("value").agg((DECAY * F.max("trust")).alias("best"))
        more = unseen.join(cut_lineage(best), "value").groupBy("pattern").agg(F.sum("best").alias("more"))
        rise = F.col("seeds") + F.coalesce("more", F.lit(0.0))
        now = trusted(sums.join(cut_lineage(more), "pattern", "left").withColumn("sum", rise))
        size, before = now.count(), size
    return now.select("pattern")


def _text(spans: Column) -> Column:
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["low"].cast("string"), s["high"].cast("string")))
    return F.array_join(texts, ",")


def extract(documents: DataFrame) -> DataFrame:
    """Personal data of every row of ``documents`` (doc_id, text); NULL text is empty and has none.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the exact spans as kind:start:end), spans (those
    and the ones found by context, kind ``id``, in the same form) and n_id. Rows with repeated or NULL ids stay; extra
    columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        "doc_id",
        F.monotonically_increasing_id().alias("_row"),
        base_spans(text).alias("base"),
        _candidates(text).alias("words"),
    )
    rows = cut_lineage(rows)
    words = rows.filter(F.size("words") > 0).select("_row", "base", F.explode("words").alias("w")).select(
        "_row",
        "w.*",
        F.exists("base", lambda b: (b["low"] < F.col("w.high")) & (b["high"] > F.col("w.low"))).alias("seed"),
    )
    contexts = F.explode(F.array_distinct(F.array("one", "two")))
    words = cut_lineage(words.withColumn("pattern", contexts).filter("pattern <> ''"))
    # A value that is a seed somewhere counts as one everywhere.
    edges = cut_lineage(words.groupBy("pattern", "value").agg(F.max("seed").alias("seed")))
    trusted = _trusted(edges)
    extra = (
        words.filter(~F.col("seed"))
        .join(trusted, "pattern", "left_semi")
        .groupBy("_row")
        .agg(F.sort_array(F.collect_set(F.struct(F.lit("id").alias("kind"), "low", "high"))).alias("extra"))
    )
    counts = [
        F.size(F.filter("base", _of(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    every = F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.concat("base", "extra"))
    return rows.join(extra, "_row", "left").select(
        "doc_id",
        *counts,
        F.sha2(_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _text(every).alias("spans"),
        F.coalesce(F.size("extra"), F.lit(0)).cast("long").alias("n_id"),
    )
