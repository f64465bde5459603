"""Personal data: candidate spans ranked by gradient-boosted trees, all in DataFrame expressions.

Generators propose spans generously. Those that a strict pattern and its check accept are the base: they
always stay, and they are the examples that boosted trees learn from, by context and what all forms share.
Counterexamples are other candidates without a word of their kind nearby; those with one are not labelled.
Candidates are added if they score as high as thresholds, calibrated on held-out labelled candidates, ask.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framefold.llm.common import documents, land, query

KINDS = ("email", "ip", "card", "phone")
#: Labelled candidates of each kind that the trees learn from at most; thresholds are calibrated on all held-out ones.
SAMPLE = 10_000
TREES = 10
DEPTH = 4
#: Share of labelled candidates at and above a threshold that the base confirms.
PRECISION = 0.98
BINS = 100
#: Code points before and after a span that are its context.
CONTEXT = 24

# The base patterns, written so that matching stays linear in very long runs: a run is entered at its start or where the
# last match ended, and what cannot be given back is possessive. They find what the plain patterns find.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generous ones: other separators, spelled-out signs, numbers without a country code.
WIDE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![A-Za-z0-9])[0-9]{1,3}(?:[.,:\x20-][0-9]{1,3}){3}(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])[0-9](?:[\x20./-]?[0-9]){11,18}(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9])\(?[0-9]{2,4}\)?(?:[\x20./-]?\(?[0-9]{2,4}\)?){2,4}(?![A-Za-z0-9])",
}
_WORTH_A_LOOK = r"[0-9@]|[(\[](?:at|AT)[)\]]"

# Whole words: "ip" is none in "recipe", "card" none in "discard".
_CONTEXTS = {
    kind: rf"(?<![\p{{L}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{N}}])"
    for kind, words in {
        "phone": "tel|telephone|phones?|calls?|mobile|fax|whatsapp",
        "card": "cards?|visa|credit|payments?|karte|tarjeta|carte",
        "ip": "ips?|hosts?|servers?|address|addresses|clients?",
        "email": "e?mails?|contact|write|kontakt|correo|courriel",
    }.items()
}
# Nothing that tells the form of a base pattern from a generous one: no signs, separators, lengths or country codes.
FEATURES = [
    "kind_at", "digits", "before", "after",
    *(f"near_{k}" for k in _CONTEXTS),
]


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running_sums(values: Column) -> Column:
    """Sums of all values up to each; in pieces of 256, so that long arrays are not copied for each element."""
    piece = 256

    def sums(part: Column) -> Column:
        empty = F.struct(F.lit(0).cast("bigint").alias("s"), F.array().cast("array<bigint>").alias("all"))
        return F.aggregate(
            part,
            empty,
            lambda acc, v: F.struct((acc["s"] + v).alias("s"), F.array_append(acc["all"], acc["s"] + v).alias("all")),
        )

    def join(parts: Column) -> Column:
        def shifted(part: Column, i: Column) -> Column:
            base = F.aggregate(F.slice(parts, 1, i), F.lit(0).cast("bigint"), lambda s, p: s + p["s"])
            return _with(base, lambda b: F.transform(part["all"], lambda v: v + b))

        return F.flatten(F.transform(parts, shifted))

    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / piece).cast("int") - 1, F.lit(0)))
    return _with(values, lambda v: _with(F.transform(starts, lambda i: sums(F.slice(v, i * piece + 1, piece))), join))


def _matches(text: Column, pattern: str, kind: str, base: bool) -> Column:
    """Leftmost matches that do not overlap: array of (kind, base, start, end, match, before, after).

    The gaps between matches and the matches alternate, so running sums of their lengths are the positions.
    """
    lengths = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.transform(F.split(text, pattern, -1), lambda g: F.length(g)).alias("g"),
    )

    def place(found: Column) -> Column:
        both = F.flatten(F.transform(found["m"], lambda m, i: F.array(F.get(found["g"], i), F.length(m))))

        def spans(sums: Column) -> Column:
            return F.transform(
                found["m"],
                lambda m, i: F.struct(
                    F.lit(kind).alias("kind"),
                    F.lit(base).alias("base"),
                    F.get(sums, 2 * i).alias("start"),
                    F.get(sums, 2 * i + 1).alias("end"),
                    m.alias("match"),
                    F.substring(
                        text,
                        F.greatest(F.get(sums, 2 * i) - CONTEXT, F.lit(0)).cast("int") + 1,
                        F.least(F.get(sums, 2 * i), F.lit(CONTEXT)).cast("int"),
                    ).alias("left"),
                    F.substring(text, F.get(sums, 2 * i + 1).cast("int") + 1, F.lit(CONTEXT)).alias("right"),
                ),
            )

        return F.when(F.size(found["m"]) > 0, _with(_running_sums(both), spans)).otherwise(spans(F.array().cast("array<bigint>")))

    return _with(lengths, place)


def _accepted() -> Column:
    """The checks of the base patterns on ``kind`` and ``match``."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    count = F.length(digits)
    parts = F.split("match", "[.]")
    small = F.forall(
        parts,
        lambda p: F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255).otherwise(
            F.lit(False)
        ),
    )
    return (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", small)
        .when(F.col("kind") == "card", count.between(12, 19) & F.when(count.between(12, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False)))
        .otherwise(count.between(9, 15))
    )


def _features(rows: DataFrame) -> DataFrame:
    """Context and digits as numbers; the base's own checks (checksum, ranges, counts) are not among them."""
    edge = {
        "before": F.right("left", F.lit(1)),
        "after": F.left("right", F.lit(1)),
    }
    columns = {
        "kind_at": F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")),
        "digits": F.when(F.col("kind").isin("ip", "card"), F.regexp_count("match", F.lit("[0-9]"))).otherwise(0),
        **{
            name: F.when(c == "", 0).when(c.rlike("\\s"), 1).when(c.rlike("[\\p{L}\\p{N}]"), 2).otherwise(3)
            for name, c in edge.items()
        },
        **{f"near_{k}": F.lower(F.concat("left", "right")).rlike(p).cast("int") for k, p in _CONTEXTS.items()},
    }
    return rows.withColumns({name: c.cast("double") for name, c in columns.items()})


def candidates(docs: DataFrame) -> DataFrame:
    """Distinct candidate spans per distinct text: ``text_key, kind, start, end, accepted`` and features.

    ``accepted`` marks the base. Null and empty texts, and texts without a digit or an at sign, have none.
    """
    text = F.col("text")
    looked = docs.where(text.rlike(_WORTH_A_LOOK)).select(F.xxhash64("text").alias("text_key"), "text")
    spans = [_matches(text, BASE[k], k, True) for k in KINDS] + [_matches(text, WIDE[k], k, False) for k in KINDS]
    found = looked.select("text_key", F.explode(F.concat(*spans)).alias("s")).select("text_key", "s.*")
    judged = found.withColumn("accepted", F.col("base") & _accepted())
    features = _features(judged)
    same = ["text_key", "kind", "start", "end"]
    return features.groupBy(*same).agg(F.max("accepted").alias("accepted"), *[F.max(c).alias(c) for c in FEATURES])


def fit(found: DataFrame) -> tuple[GBTClassificationModel, DataFrame] | None:
    """Trees, and the threshold of each kind (``kind, threshold``); None without examples of both sorts.

    Learned from at most ``SAMPLE`` labelled candidates of each kind with even hashes, calibrated on all with odd ones.
    """
    key = F.xxhash64("text_key", "kind", "start", "end")
    near = F.coalesce(*[F.when(F.col("kind") == k, F.col(f"near_{k}") > 0) for k in KINDS])
    labelled = found.where(F.col("accepted") | ~near)
    even, odd = (labelled.where(F.pmod(key, F.lit(2)) == part) for part in (0, 1))
    few = [even.where(F.col("kind") == k).orderBy(key, "text_key", "start", "end").limit(SAMPLE) for k in KINDS]
    sample = few[0].union(few[1]).union(few[2]).union(few[3])
    label = F.col("accepted").cast("double")
    train = land(_vectors(sample).select("features", label.alias("label")), "pii-examples")
    if train.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1).fit(train)
    return model, _thresholds(_scored(odd, model))


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def _scored(rows: DataFrame, model: GBTClassificationModel) -> DataFrame:
    scored = model.transform(_vectors(rows))
    return scored.withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "prediction")


def _thresholds(scored: DataFrame) -> DataFrame:
    """The lowest score of each kind at and above which the base confirms a share of ``PRECISION``."""
    bins = scored.groupBy("kind", F.floor(F.col("p") * BINS).alias("bin")).agg(
        F.sum(F.col("accepted").cast("int")).alias("good"), F.count(F.lit(1)).alias("all")
    )
    above = Window.partitionBy("kind").orderBy(F.desc("bin"))
    reached = bins.select("kind", "bin", (F.sum("good").over(above) / F.sum("all").over(above)).alias("precision"))
    return (
        reached.where(F.col("precision") >= PRECISION)
        .groupBy("kind")
        .agg((F.min("bin") / BINS).alias("threshold"))
    )


def find_spans(docs: DataFrame) -> DataFrame:
    """``text_key, spans`` of each distinct text that has any: array of (start, place, kind, end, base).

    Base spans are all there, also where they overlap. Added ones overlap no base span and no added one of a
    higher score. The spans of a text are gathered in its row; the text bounds their number.
    """
    found = land(candidates(docs), "pii-candidates")
    base = found.where("accepted").select("text_key", "kind", "start", "end", F.lit(2.0).alias("p"))
    fitted = fit(found)
    chosen = base
    if fitted:
        model, thresholds = fitted
        more = _scored(found.where(~F.col("accepted")), model).join(thresholds, "kind").where(F.col("p") >= F.col("threshold"))
        chosen = base.union(more.select("text_key", "kind", "start", "end", "p"))
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    rated = F.struct((-F.col("p")).alias("rank"), "start", place.alias("place"), "kind", "end")
    none = F.array().cast("array<struct<start: bigint, place: bigint, kind: string, end: bigint, base: boolean>>")

    def add(kept: Column, s: Column) -> Column:
        base = s["rank"] == -2.0
        free = ~F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]))
        row = F.struct(
            s["start"].alias("start"), s["place"].alias("place"), s["kind"].alias("kind"), s["end"].alias("end"), base.alias("base")
        )
        return F.when(base | free, F.array_append(kept, row)).otherwise(kept)

    gathered = chosen.groupBy("text_key").agg(F.sort_array(F.collect_list(rated)).alias("all"))
    return gathered.select("text_key", F.array_sort(F.aggregate("all", none, add)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one, named by the first.

    ``n_chars``, if there is one, follows the new text; other columns and texts without spans stay.
    """
    merged = F.aggregate(
        "spans",
        F.array().cast("array<struct<start: bigint, end: bigint, kind: string>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > s["start"]),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["start"].alias("start"),
                        F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"),
                        F.element_at(acc, -1)["kind"].alias("kind"),
                    )
                ),
            ),
        ).otherwise(F.array_append(acc, F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))),
    )
    spans = land(find_spans(docs).select("text_key", merged.alias("_spans")), "pii-spans")
    text = F.col("_row.text")
    parts = F.transform(
        "_spans",
        lambda s, i: _with(
            F.when(i > 0, F.get(F.col("_spans"), i - 1)["end"]).otherwise(F.lit(0)).cast("int"),
            lambda at: F.concat(F.substring(text, at + 1, s["start"].cast("int") - at), F.lit("["), F.upper(s["kind"]), F.lit("]")),
        ),
    )
    last = F.element_at("_spans", -1)["end"].cast("int")
    cleaned = F.concat(F.array_join(parts, ""), F.substring(text, last + 1, F.length(text)))
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # they cannot clash in there
    keyed = docs.select(columns.alias("_row"), F.xxhash64("text").alias("text_key"))
    none = F.col("_spans").isNull()
    out = keyed.join(spans, "text_key", "left").withColumn("_new", F.when(none, text).otherwise(cleaned))
    row = F.col("_row").withField("text", F.col("_new"))
    if "n_chars" in docs.columns:
        size = F.length("_new").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(none, F.col("_row.n_chars")).otherwise(size))
    return out.select(row.alias("_row")).select("_row.*")


def spans_by_document(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` of every row; null texts count as empty, repeated rows get equal results."""
    keyed = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_key"))
    none = F.array().cast("array<struct<start: bigint, place: bigint, kind: string, end: bigint, base: boolean>>")
    return keyed.join(land(find_spans(docs), "pii-spans"), "text_key", "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans")
    )


@query("op7_boosted_pii_spans")
def _(spark, sf):
    """Personal data in every document: base counts, a digest of the base spans, and all spans."""
    base = F.filter("spans", lambda s: s["base"])

    def count_of(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count_of(k) for k in KINDS]
    return spans_by_document(documents(spark, sf)).select(
        "doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
