"""Personal data in whole texts, on DataFrames and SQL functions alone.

Base spans follow fixed patterns per kind, leftmost and without overlap, with checks on the digits.
On top, wider generators propose spans (masked addresses, and numbers inside longer runs that fail
as a whole), which may overlap. Boosted trees score a proposal by features of its form and of its
surroundings; they learn from a bounded sample of proposals of each kind, of which those that are
base spans count as right. Forms that no base pattern can match (masked addresses, phones without a
plus) are neither right nor wrong. Per kind the lowest score whose precision over all other
proposals is high enough is the threshold. Proposals above it that overlap no base span of their
kind are added.

Positions are code points, the end exclusive. Every pattern is written so that it neither recurses
nor scans a run of characters again and again, whatever the text's length. Spans are counted up by
a window per text and kind, linear in their number.

A null text counts as empty and has no spans. Repeated rows are handled alike. Columns other than
``doc_id`` and ``text`` are not read. An empty table gives no rows; a sample with one class only
adds nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslink.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
#: The patterns of the contract in forms that match the same spans without backtracking.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])",
    "phone": r"(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)|(?<![0-9])[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: What a text must hold for a kind to be looked for at all.
HINT = {"email": r"@|[\(\[\{]at[\)\]\}]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]|[0-9][\x20().-]?[0-9]"}
FIT_ROWS = 20_000
PRECISION = 0.98
FEATURES = (
    "kind_no", "n_chars", "n_digits", "n_letters", "n_separators", "has_plus", "has_bracket", "luhn", "octets",
    "number_before", "number_after", "letter_before", "letter_after", "blank_before", "blank_after", "lead_digit",
)
_NEAR = 12


def _pieces(text: Column, pattern: str, hint: str) -> Column:
    """Every match with the characters between it and the one before (or the text's start)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda p: F.struct(F.length(p).alias("gap"), F.right(p, F.lit(_NEAR)).alias("before"), F.left(p, F.lit(_NEAR)).alias("left")))
    zipped = F.zip_with(
        F.sequence(F.lit(0), F.size(found) - 1),
        found,
        lambda i, m: F.struct(
            i.alias("i"), m.alias("match"), F.get(between, i)["gap"].alias("gap"), F.get(between, i)["before"].alias("before"),
            F.get(between, i + 1)["left"].alias("after"),
        ),
    )
    empty = F.array().cast("array<struct<i:int,match:string,gap:int,before:string,after:string>>")
    return F.when(text.rlike(hint), F.when(F.size(found) > 0, zipped).otherwise(empty)).otherwise(empty)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn_holds(match: Column) -> Column:
    digits = F.reverse(_digits(match))
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(digits))),
        F.lit(0),
        lambda s, i: s
        + F.when(i % 2 == 1, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*(F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.substring(digits, i, F.lit(1)).cast("int") + 1)
        ),
    )
    return (F.length(digits) > 0) & (F.length(digits) < 40) & (total % 10 == 0)


def octets_hold(match: Column) -> Column:
    return match.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9]|)(?:\.|$)){4}$") & ~match.rlike(r"\.\.|\.$|^\.")


def _base_holds(kind: Column, match: Column) -> Column:
    digits = F.length(_digits(match))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", octets_hold(match))
        .when(kind == "card", digits.between(13, 19) & luhn_holds(match))
        .otherwise(digits.between(9, 15))
    )


def _comparable(kind: Column, match: Column) -> Column:
    """Whether a proposal has a form that the base pattern of its kind can match."""
    return F.when(kind == "email", ~match.rlike(r"[\x20(\[{]")).when(kind == "phone", F.startswith(match, F.lit("+"))).otherwise(True)


def proposals(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows (``row``, ``doc_id``), and every match of the base and the wide patterns:
    ``row``, ``kind``, ``base`` (and checks hold), ``start``, ``end``, ``match`` and what is near."""
    text = F.coalesce("text", F.lit(""))
    columns = {f"{name}_{kind}": _pieces(text, patterns[kind], HINT[kind]) for name, patterns in (("base", BASE), ("wide", WIDE)) for kind in KINDS}
    found = F.filter(
        F.array(
            *(
                F.struct(F.lit(kind).alias("kind"), F.lit(name == "base").alias("base"), columns[f"{name}_{kind}"].alias("all"))
                for name in ("base", "wide") for kind in KINDS
            )
        ),
        lambda x: F.size(x["all"]) > 0,
    )
    nothing = F.array().cast("array<struct<kind:string,base:boolean,all:array<struct<i:int,match:string,gap:int,before:string,after:string>>>>")
    stored = cut_lineage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.when(text.rlike("[0-9@]|at[)\\]}]"), found).otherwise(nothing).alias("found"),
        ).withColumn("row", F.monotonically_increasing_id())
    )
    each = (
        stored.where(F.size("found") > 0)
        .select("row", F.explode("found").alias("f"))
        .select("row", "f.kind", "f.base", F.explode("f.all").alias("m"))
        .select("row", "kind", "base", "m.*")
    )
    before = Window.partitionBy("row", "kind", "base").orderBy("i")
    end = F.sum(F.col("gap") + F.length("match")).over(before).cast("long")
    spans = (
        each.withColumn("end", end)
        .withColumn("start", F.col("end") - F.length("match"))
        .where(~F.col("base") | _base_holds(F.col("kind"), F.col("match")))
        .drop("i", "gap")
    )
    return stored.select("row", "doc_id"), cut_lineage(spans)


def described(candidates: DataFrame) -> DataFrame:
    """Features of form and context as columns of doubles."""
    match, before, after = F.col("match"), F.right("before", F.lit(1)), F.left("after", F.lit(1))
    flag = lambda c: c.cast("double")
    count = lambda pattern: F.length(F.regexp_replace(match, pattern, "")).cast("double")
    return candidates.withColumns(
        {
            "kind_no": (F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))).cast("double"),
            "n_chars": F.length(match).cast("double"),
            "n_digits": count("[^0-9]"),
            "n_letters": count("[^A-Za-z]"),
            "n_separators": count(r"[^\x20.()-]"),
            "has_plus": flag(F.startswith(match, F.lit("+"))),
            "has_bracket": flag(match.rlike(r"[\(\[\{]")),
            "luhn": F.when(F.col("kind") == "card", flag(luhn_holds(match))).otherwise(0.0),
            "octets": F.when(F.col("kind") == "ip", flag(octets_hold(match))).otherwise(0.0),
            "number_before": flag(F.col("before").rlike(r"[0-9.+-]$")),
            "number_after": flag(F.col("after").rlike(r"^[.-]?[0-9]")),
            "letter_before": flag(before.rlike("[A-Za-z]")),
            "letter_after": flag(after.rlike("[A-Za-z]")),
            "blank_before": flag((before == "") | before.rlike(r"\s")),
            "blank_after": flag((after == "") | after.rlike(r"\s")),
            "lead_digit": F.coalesce(F.left(_digits(match), F.lit(1)).try_cast("double"), F.lit(0.0)),
        }
    )


def _accepted(wide: DataFrame, fit_rows: int, precision: float) -> DataFrame | None:
    """Proposals above their kind's threshold, or None where nothing can be learned."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    order = F.xxhash64("row", "kind", "start")
    known = wide.where("right is not null").withColumn("part", F.pmod(order, F.lit(3)))
    each = [known.where(F.col("kind") == k).orderBy(order, "row", "start").limit(fit_rows // len(KINDS)) for k in KINDS]
    sample = cut_lineage(described(reduce(DataFrame.unionByName, each)))
    classes = {r[0] for r in sample.where("part > 0").select("right").distinct().collect()}  # two at most
    if classes != {0.0, 1.0}:
        return None
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = GBTClassifier(labelCol="right", maxDepth=4, maxIter=20, stepSize=0.3, seed=7)
    model = trees.fit(assemble.transform(sample.where("part > 0")).select("features", "right").coalesce(2))
    scored = cut_lineage(
        model.transform(assemble.transform(described(wide)))
        .withColumn("score", F.round(vector_to_array("probability")[1], 6))
        .select("row", "kind", "start", "end", "score", "right")
    )
    above = Window.partitionBy("kind").orderBy(F.desc("score"))
    thresholds = (
        scored.groupBy("kind", "score")
        .agg(F.sum("right").alias("right"), F.count("right").alias("known"))
        .where("known > 0")
        .withColumn("precision", F.sum("right").over(above) / F.sum("known").over(above))
        .where(F.col("precision") >= precision)
        .groupBy("kind")
        .agg(F.greatest(F.min("score"), F.lit(0.5)).alias("least"))
    )
    return scored.join(thresholds, "kind").where("score >= least").select("row", "kind", "start", "end", "score")


def find_personal_data(docs: DataFrame, fit_rows: int = FIT_ROWS, precision: float = PRECISION) -> tuple[DataFrame, DataFrame]:
    """All rows (``row``, ``doc_id``) and their spans (``row``, ``kind``, ``start``, ``end``,
    ``base``)."""
    rows, found = proposals(docs)
    base = found.where("base").select("row", "kind", "start", "end")
    wide = found.where("not base")
    right = base.select("row", "kind", "start", "end", F.lit(1.0).alias("right"))
    wide = cut_lineage(wide.join(right, ["row", "kind", "start", "end"], "left").withColumn("right", F.coalesce("right", F.when(_comparable(F.col("kind"), F.col("match")), 0.0))))
    accepted = _accepted(wide, fit_rows, precision)
    spans = base.withColumn("base", F.lit(True))
    if accepted is None:
        return rows, spans
    # In order of start, a base span before overlaps if it ends later; one behind, if it starts earlier.
    both = spans.unionByName(accepted.drop("score").withColumn("base", F.lit(False)))
    ahead = Window.partitionBy("row", "kind").orderBy("start", F.desc("base")).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("row", "kind").orderBy(F.desc("start"), "base").rowsBetween(Window.unboundedPreceding, -1)
    free = F.coalesce(F.col("ends") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("starts") >= F.col("end"), F.lit(True))
    return rows, (
        both.withColumn("ends", F.max(F.when(F.col("base"), F.col("end"))).over(ahead))
        .withColumn("starts", F.min(F.when(F.col("base"), F.col("start"))).over(behind))
        .where(F.col("base") | free)
        .drop("ends", "starts")
    )


def personal_data(docs: DataFrame, fit_rows: int = FIT_ROWS, precision: float = PRECISION) -> DataFrame:
    """Per row the number of spans of each kind, the digest of the base spans, all spans, the number
    of those added, and the number of base spans of each kind (``n_base_*``)."""
    rows, spans = find_personal_data(docs, fit_rows, precision)
    number = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    item = F.struct(number.alias("no"), "start", "end", "base", F.concat_ws(":", "kind", "start", "end").alias("text"))
    listed = lambda items: F.array_join(F.transform(items, lambda x: x["text"]), ",")
    held = spans.groupBy("row").agg(
        *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS),
        F.count(F.when(~F.col("base"), 1)).alias("n_added"),
        *(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_base_{k}") for k in KINDS),
        F.sort_array(F.collect_list(item)).alias("items"),
    )
    number_of = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return rows.join(held, "row", "left").select(
        "doc_id",
        *(number_of(f"n_{k}") for k in KINDS),
        F.sha2(F.coalesce(listed(F.filter("items", lambda x: x["base"])), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(listed(F.col("items")), F.lit("")).alias("spans"),
        number_of("n_added"),
        *(number_of(f"n_base_{k}") for k in KINDS),
    )
