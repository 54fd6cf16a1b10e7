"""Secrets in texts: fixed patterns, and a randomness test battery.

DataFrame expressions only. Besides the three base patterns, every run of token
characters, and every stretch of its parts between separators, is a candidate whose
encoding is inferred. Three tests ask whether it
looks uniformly random in that encoding (chi-squared on the alphabet, runs above
and below its middle, serial correlation). What passes them is set against the
opposite hypothesis, a text with repeated symbols, and false discoveries are
controlled within classes of encoding and length, as short tokens prove little.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.llm.common import documents, free_name, text_or_empty

# The base patterns (kind: pattern, least length), in order of kind.
KEY = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
BASE = {
    "assign": KEY + "[A-Za-z0-9+/_.=-]+",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Runs of these characters are tested, and parts of them; shorter ones say too little.
SHORTEST = 20
CANDIDATE = f"[A-Za-z0-9+/_-]{{{SHORTEST},}}"
#: Characters that join the parts of a run, by the encoding they may also stand in.
SEPARATORS = {"base64": "+/", "base64url": "-_"}
#: So many neighbouring parts are tested together: a key may hold separators itself.
PARTS = 4
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
#: Encodings from the narrowest: name, what a token must match, symbols in order.
ENCODINGS = (
    ("hex", "(?=.*[0-9])(?=.*[a-f])[0-9a-f]+", DIGITS + "abcdef"),
    ("HEX", "(?=.*[0-9])(?=.*[A-F])[0-9A-F]+", DIGITS + "ABCDEF"),
    ("base32", "(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+", UPPER + "234567"),
    ("base36", "(?=.*[0-9])(?=.*[a-z])[0-9a-z]+", DIGITS + LOWER),
    ("BASE36", "(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+", DIGITS + UPPER),
    ("base64", "(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+", UPPER + LOWER + DIGITS + "-_"),
)
#: Chance that two symbols of written text agree; at least twice that of random ones.
TEXT_COINCIDENCE = 0.0667
#: A token random in truth fails the battery this often at most.
BATTERY_ALPHA = 0.001
#: Share of false discoveries in each class of encoding and length.
FDR = 0.01
#: p-values are counted in bins of a quarter of a power of two, down to 2^-64.
BINS = 256
SPAN = "array<struct<start:int,kind_no:int,stop:int,kind:string,found:string>>"


def find_all(text: Column, pattern: str, kind: str, kind_no: int) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start, kind_no, stop, kind, found>>``.

    Positions count code points: what lies between the matches (``split``) and the
    matches themselves alternate, so their lengths add up to the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    empty = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPAN})").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        stop = start + F.length(x["found"])
        span = F.struct(
            start.alias("start"),
            F.lit(kind_no).alias("kind_no"),
            stop.alias("stop"),
            F.lit(kind).alias("kind"),
            x["found"].alias("found"),
        )
        return F.struct(stop.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    pairs = F.zip_with(
        found,
        F.split(text, pattern, -1),
        lambda m, gap: F.struct(gap.alias("gap"), m.alias("found")),
    )
    # The last gap has no match after it.
    walked = F.aggregate(F.filter(pairs, lambda x: x["found"].isNotNull()), empty, step)
    return F.when(F.rlike(text, F.lit(pattern)), walked["spans"]).otherwise(
        F.expr(f"cast(array() as {SPAN})")
    )


def base_spans(text: Column) -> Column:
    """The base spans in order of start, then kind. Matches that are too short are
    dropped after matching, so they still use up the text they cover."""
    kinds = []
    for no, (kind, pattern) in enumerate(BASE.items()):
        if kind == "assign":
            spans = F.filter(
                find_all(text, pattern, kind, no),
                lambda s: F.length(F.regexp_replace(s["found"], "^" + KEY, "")) >= LEAST["assign"],
            )
        else:
            # One run of a class: a shorter run can neither match nor hide a longer one.
            spans = find_all(text, longer(pattern, LEAST[kind]), kind, no)
        kinds.append(spans)
    return F.array_sort(F.concat(*kinds))


def longer(pattern: str, least: int) -> str:
    """``...[class]+`` with at least ``least`` characters in all."""
    fixed = pattern[: pattern.index("[")]
    return f"{pattern[:-1]}{{{least - len(fixed)},}}"


def normal_below(z: Column) -> Column:
    """Standard normal distribution function, by a logistic approximation."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(z * -1.5976 - z * z * z * 0.070566))


def two_sided(z: Column) -> Column:
    return normal_below(-F.abs(z)) * 2


def bounded(z: Column) -> Column:
    return F.greatest(F.least(z, F.lit(9.0)), F.lit(-9.0))


def inferred(token: Column) -> Column:
    """``struct<name, shape, alphabet>`` of the narrowest encoding that fits, or null."""
    table = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.lit(f"^{p}$").alias("shape"), F.lit(x).alias("alphabet"))
            for n, p, x in ENCODINGS
        ]
    )
    return F.try_element_at(F.filter(table, lambda e: F.rlike(token, e["shape"])), F.lit(1))


def with_fields(spans: Column, names: str, **fields) -> Column:
    """Adds fields computed from each span; later steps then read them, not their formula."""
    return F.transform(
        spans,
        lambda s: F.struct(
            *[s[c].alias(c) for c in names.split()], *[f(s).alias(n) for n, f in fields.items()]
        ),
    )


def windows(cuts: Column, most: int) -> Column:
    """Stretches of one to ``most`` parts between ``cuts``, long enough to be tested, as
    start times 2^32 plus stop. None begins or ends with an empty part."""

    def from_cut(cut: Column, no: Column) -> Column:
        return F.array(
            *[
                F.when(
                    (F.get(cuts, no + n) - cut > SHORTEST)
                    & (F.get(cuts, no + 1) > cut + 1)
                    & (F.get(cuts, no + n - 1) < F.get(cuts, no + n) - 1),
                    (cut + 1).cast("long") * (1 << 32) + F.get(cuts, no + n),
                )
                for n in range(1, most + 1)
            ]
        )

    return F.filter(F.flatten(F.transform(cuts, from_cut)), lambda w: w.isNotNull())


def candidates(text: Column) -> Column:
    """Runs of token characters and what stands between separators in them, as spans.

    Of each run: the whole, what lies between ``-`` and ``_``, what lies between ``/``
    and ``+``, and up to ``PARTS`` neighbouring parts between separators of any kind.
    So a key is looked at wherever it stands in a path or name, also where it holds
    some separators of its own. The work grows with the length of a run, not its square.
    """
    own = "start kind_no stop kind found"

    def mixed(found: Column) -> Column:
        return F.rlike(found, F.lit("[0-9]")) & F.rlike(found, F.lit("[A-Za-z]"))

    def cuts(s: Column, marks: str) -> Column:
        places = F.transform(s["symbols"], lambda c, no: F.when(c.isin(*marks), no))
        return F.concat(
            F.array(F.lit(-1)),
            F.coalesce(F.filter(places, lambda x: x.isNotNull()), F.expr("cast(array() as array<int>)")),
            F.array(F.length(s["found"])),
        )

    runs = F.filter(find_all(text, CANDIDATE, "random", len(BASE)), lambda s: mixed(s["found"]))
    joined = "".join(SEPARATORS.values())
    runs = with_fields(
        runs,
        own,
        symbols=lambda s: F.when(
            F.rlike(s["found"], F.lit(f"[{joined}]")), F.split(s["found"], "(?!^)", -1)
        ),
    )
    runs = with_fields(
        runs,
        own + " symbols",
        every=lambda s: cuts(s, joined),
        **{name: lambda s, marks=marks: cuts(s, marks) for name, marks in SEPARATORS.items()},
    )
    runs = with_fields(
        runs,
        own + " symbols",
        places=lambda s: F.array_distinct(
            F.concat(
                F.array(F.length(s["found"]).cast("long")),
                windows(s["every"], PARTS),
                *[windows(s[name], 1) for name in SEPARATORS],
            )
        ),
    )

    def cut_out(s: Column, place: Column) -> Column:
        start = F.shiftright(place, 32).cast("int")
        stop = place.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
        return F.struct(
            (s["start"] + start).alias("start"),
            s["kind_no"].alias("kind_no"),
            (s["start"] + stop).alias("stop"),
            s["kind"].alias("kind"),
            F.when(stop - start == F.length(s["found"]), s["found"])
            .otherwise(F.array_join(F.slice(s["symbols"], start + 1, stop - start), ""))
            .alias("found"),
        )

    spans = F.flatten(
        F.transform(runs, lambda s: F.transform(s["places"], lambda place: cut_out(s, place)))
    )
    return F.filter(spans, lambda s: mixed(s["found"]))


def outermost(spans: Column) -> Column:
    """Spans that lie in no other one, in order."""
    start = F.struct(F.lit(-1).alias("far"), F.expr(f"cast(array() as {SPAN})").alias("spans"))

    def step(acc: Column, s: Column) -> Column:
        span = F.struct(*[s[c].alias(c) for c in ("start", "kind_no", "stop", "kind", "found")])
        return F.when(s["stop"] <= acc["far"], acc).otherwise(
            F.struct(s["stop"].alias("far"), F.concat(acc["spans"], F.array(span)).alias("spans"))
        )

    widest_first = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                (-s["stop"]).alias("before"),
                *[s[c].alias(c) for c in ("kind_no", "stop", "kind", "found")],
            ),
        )
    )
    return F.aggregate(widest_first, start, step, lambda acc: acc["spans"])


def tested_spans(text: Column) -> Column:
    """Candidates that pass the battery, with class and p-value bin.

    ``array<struct<start, kind_no, stop, kind, found, cls, bin>>``. A token in no
    encoding (letters of one case, say) is no candidate. The class is the encoding
    and twice the base-2 logarithm of the length, rounded down. The battery passes
    where three times the least of its p-values is ``BATTERY_ALPHA`` or more:

    * chi-squared of the symbol counts against equal shares (cube root rule),
    * number of runs below and above the middle of the alphabet,
    * correlation of neighbouring symbols.

    The bin is that of the p-value of the opposite hypothesis: how likely text,
    whose symbols agree as often as ``TEXT_COINCIDENCE``, has as few equal pairs.
    """
    own = "start kind_no stop kind found"
    spans = with_fields(candidates(text), own, code=lambda s: inferred(s["found"]))
    spans = F.filter(spans, lambda s: s["code"].isNotNull())
    spans = with_fields(
        spans,
        own + " code",
        a=lambda s: F.length(s["code"]["alphabet"]).cast("double"),
        n=lambda s: F.length(s["found"]).cast("double"),
        symbols=lambda s: F.split(s["found"], "(?!^)", -1),
        halves=lambda s: F.call_function(
            "translate",
            s["found"],
            s["code"]["alphabet"],
            F.concat(
                F.repeat(F.lit("0"), (F.length(s["code"]["alphabet"]) / 2).cast("int")),
                F.repeat(F.lit("1"), (F.length(s["code"]["alphabet"]) / 2).cast("int")),
            ),
        ),
    )
    spans = with_fields(
        spans,
        own + " code a n",
        values=lambda s: F.transform(
            s["symbols"], lambda c: F.call_function("instr", s["code"]["alphabet"], c).cast("double")
        ),
        squares=lambda s: F.aggregate(
            F.regexp_extract_all(F.array_join(F.array_sort(s["symbols"]), ""), F.lit(r"(.)\1*"), 0),
            F.lit(0.0),
            lambda acc, run: acc + F.length(run) * F.length(run),
        ),
        runs=lambda s: F.size(F.regexp_extract_all(s["halves"], F.lit("0+|1+"), 0)).cast("double"),
        low=lambda s: F.length(F.translate(s["halves"], "1", "")).cast("double"),
    )
    spans = with_fields(
        spans,
        own + " code a n values squares runs",
        mean=lambda s: F.aggregate(s["values"], F.lit(0.0), lambda acc, x: acc + x) / s["n"],
        product=lambda s: s["low"] * (s["n"] - s["low"]) * 2,
        share=lambda s: F.greatest(F.lit(TEXT_COINCIDENCE), F.lit(2.0) / s["a"]),
    )
    start = F.struct(
        F.lit(0.0).alias("ss"), F.lit(0.0).alias("sp"), F.lit(0.0).alias("last")
    )

    def moments(s: Column) -> Column:
        return F.aggregate(
            s["values"],
            start,
            lambda acc, x: F.struct(
                (acc["ss"] + (x - s["mean"]) * (x - s["mean"])).alias("ss"),
                (acc["sp"] + acc["last"] * (x - s["mean"])).alias("sp"),
                (x - s["mean"]).alias("last"),
            ),
        )

    spans = with_fields(
        spans,
        own + " code n",
        z_chi=lambda s: bounded(
            (
                F.pow(
                    F.greatest(s["squares"] * s["a"] / s["n"] - s["n"], F.lit(0.0)) / (s["a"] - 1),
                    F.lit(1 / 3),
                )
                - 1
                + F.lit(2 / 9) / (s["a"] - 1)
            )
            / F.sqrt(F.lit(2 / 9) / (s["a"] - 1))
        ),
        # All symbols in one half: null, and no pass. Its variance is zero for n = 2 only.
        z_runs=lambda s: bounded(
            F.when(
                s["product"] > s["n"],
                (s["runs"] - s["product"] / s["n"] - 1)
                / F.sqrt(s["product"] * (s["product"] - s["n"]) / (s["n"] * s["n"] * (s["n"] - 1))),
            )
        ),
        moments=moments,
        z_text=lambda s: bounded(
            ((s["squares"] - s["n"]) / 2 - s["n"] * (s["n"] - 1) / 2 * s["share"])
            / F.sqrt(s["n"] * (s["n"] - 1) / 2 * s["share"] * (F.lit(1.0) - s["share"]))
        ),
    )
    spans = with_fields(
        spans,
        own + " code n z_chi z_runs",
        z_serial=lambda s: bounded(
            F.when(
                s["moments"]["ss"] > 0,
                (s["moments"]["sp"] / s["moments"]["ss"] + F.lit(1.0) / s["n"]) * F.sqrt(s["n"]),
            )
        ),
        p_text=lambda s: F.greatest(normal_below(s["z_text"]), F.lit(2.0**-60)),
    )
    spans = with_fields(
        spans,
        own,
        worst=lambda s: F.least(
            normal_below(-s["z_chi"]), two_sided(s["z_runs"]), two_sided(s["z_serial"])
        ),
        lost=lambda s: s["z_runs"].isNull() | s["z_serial"].isNull(),
        cls=lambda s: F.concat_ws(
            ":", s["code"]["name"], F.floor(F.log2(s["n"]) * 2).cast("string")
        ),
        bin=lambda s: F.least(F.floor(F.log2(s["p_text"]) * -4), F.lit(BINS - 1)).cast("int"),
    )
    return F.filter(spans, lambda s: ~s["lost"] & (s["worst"] * 3 >= BATTERY_ALPHA))


def thresholds(docs: DataFrame, text: str = "text", fdr: float = FDR) -> dict[str, int]:
    """Least bin that counts as found, by class: Benjamini and Hochberg on binned p-values.

    Each distinct candidate of all rows is one hypothesis, however often it stands
    there, so no repeated token decides for its class. Candidates are told apart by
    digest, combined on the map side, and counted by class and bin: a table of a few
    hundred classes and ``BINS`` bins at most, whatever the input.
    """
    counts = (
        docs.select(F.explode(tested_spans(text_or_empty(text))).alias("s"))
        .select("s.cls", "s.bin", F.unhex(F.md5("s.found")).alias("digest"))
        .distinct()
        .groupBy("cls", "bin")
        .count()
        .collect()
    )
    least: dict[str, int] = {}
    for cls in {r["cls"] for r in counts}:
        bins = sorted(((r["bin"], r["count"]) for r in counts if r["cls"] == cls), reverse=True)
        total = sum(n for _, n in bins)
        found = 0
        for place, n in bins:
            found += n
            # The largest p-value of the bin, against its share of the level.
            if 2.0 ** (-place / 4) <= fdr * found / total:
                least[cls] = place
    return least


def random_spans(text: Column, least: dict[str, int], base: Column) -> Column:
    """Tested spans beyond their class's threshold that lie in no base span and in no
    other one of themselves."""
    if not least:
        return F.expr(f"cast(array() as {SPAN})")
    table = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair])
    found = F.filter(
        tested_spans(text),
        lambda s: F.coalesce(s["bin"] >= F.try_element_at(table, s["cls"]), F.lit(False)),
    )
    alone = F.filter(
        found,
        lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (b["stop"] >= s["stop"])),
    )
    return outermost(alone)


def span_list(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )


def scan_secrets(docs: DataFrame, text: str = "text", into: str = "_secrets") -> DataFrame:
    """``docs`` with ``into``: ``struct<base, spans>``, arrays of spans in order.

    Null and empty texts have no spans. Each row is scanned on its own, in its
    place, so repeated rows and null ids change nothing; the only shuffles are those
    of token digests and their bounded counts in ``thresholds``. Columns of any name
    stay as they are, but one called ``into`` is an error: name the result otherwise.
    """
    if free_name(docs, into) != into:
        raise ValueError(f"there is a column {into} already")
    least = thresholds(docs, text)
    value = text_or_empty(text)
    base = free_name(docs, "_base")
    found = free_name(docs, "_random")
    return (
        docs.withColumn(base, base_spans(value))
        .withColumn(found, random_spans(value, least, F.col(base)))
        .withColumn(
            into,
            F.struct(
                F.col(base).alias("base"),
                F.array_sort(F.concat(base, found)).alias("spans"),
            ),
        )
        .drop(base, found)
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("_secrets.base")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan_secrets(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("_secrets.spans")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each stretch of overlapping spans replaced by ``mark``.

    Other columns, whatever their names, stay as they are. Null texts stay null.
    """
    own = free_name(docs, "_secrets")
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"])
        return F.when(
            (s["start"] < acc["at"]) & (acc["at"] > 0),
            F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["parts"].alias("parts")),
        ).otherwise(
            F.struct(s["stop"].alias("at"), F.concat(acc["parts"], F.array(gap, F.lit(mark))).alias("parts"))
        )

    spans = F.col(own)["spans"]
    walked = F.aggregate(spans, start, step)
    clean = F.concat(
        F.array_join(walked["parts"], ""),
        F.substring(F.col(text), walked["at"] + 1, F.length(F.col(text))),
    )
    return scan_secrets(docs, text, own).withColumn(
        text, F.when(F.size(spans) > 0, clean).otherwise(F.col(text))
    ).drop(own)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays; secrets in it give way to a mark."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)
