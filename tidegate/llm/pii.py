"""Personal data by candidate and boosted trees, in DataFrame operations only.

Fixed formats (email, ip, card, phone) are found as asked for and always stay.  Two wide
generators propose further, overlapping spans: ``number`` (any grouped digits) and ``handle``
(addresses written out, with "at" and "dot").  Boosted trees tell from a candidate's shape
and the words before it how likely it is personal data.  Right examples are the candidates
that hold a fixed format, and the same with the country code masked or the address written
out (at, dot): forms that no fixed format has.  Wrong examples are candidates of none of the
shapes of phones and addresses so found (numbers that fail a check digit among them), and those of such a shape that the words before announce as something else
(order, version, date).  The rest, shaped like personal data without a fixed format, has no
label and is left out of training and calibration, however frequent it is.  Shape and context
take few values, so one grouped count of all candidates is the whole training set; the trees
become a SQL expression.  A threshold per generator is calibrated on one fifth of the
documents; where it can't reach ``PRECISION`` nothing is added.

Matches are cut out by marks: a regular expression brackets them, the text is split at the
marks, and running lengths give the places.  Null texts are empty.  Spans are code points,
end exclusive.  Repeated rows are separate results; an empty table gives none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.llm import common
from tidegate.session import scratch_path

KINDS = ("email", "ip", "card", "phone", "number", "handle")
BASE = 4
#: Share of added spans that must be right on the calibration documents, and how many must be there to tell.
PRECISION, ENOUGH = 0.95, 20
ROUNDS, DEPTH = 8, 3
BINS = 50

_MARK, _JOINT, _OTHER = "\ue000", "\ue001", "\ue002"  # private characters; those of a text are replaced first

# The formats asked for.  A joint is a separator between two characters that it joins;
# with it every pattern is a run of single characters, which the engine matches without recursion.
_EMAIL = f"(?:\\G|(?<![A-Za-z0-9._%+{_JOINT}-]))[A-Za-z0-9._%+{_JOINT}-]++@[A-Za-z0-9-]++{_JOINT}[A-Za-z0-9{_JOINT}-]++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
_CARD = f"[0-9][0-9{_JOINT}]++"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_IN_RANGE = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$"

_NUMBER = r"(?<![0-9A-Za-z])[+(]?[0-9][0-9 ()./-]{5,}[0-9](?![0-9A-Za-z])"
_HANDLE = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}|\bat\b|@) ?[A-Za-z0-9-]++ ?(?:\.|\(dot\)|\[dot\]|\{dot\}|\bdot\b) ?[A-Za-z]{2,}")

# Words before a candidate, by what they announce.
_CONTEXT = (
    "phone|tel|call|mobile|cell|fax|whatsapp|sms", "card|visa|credit|debit|account|iban|payment", "mail|contact|write|reach",
    "ip|addr|host|server|client|subnet", "order|ref|invoice|version|page|isbn|date|year|item|total|price|#")
_ELSE = len(_CONTEXT)
#: Ways to write out the ``@`` and the last dot of an address.
_WRITTEN = ((" (at) ", " (dot) "), ("(at)", "(dot)"), (" at ", " dot "), (" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", "."), ("(at)", "."))
SHAPE = ("digits", "groups", "parens", "dots", "dashes", "spaces", "slashes")
FEATURES = ("kind", "digits", "groups", "parens", "dots", "dashes", "spaces", "slashes", "context", "before", "after")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _passes_luhn(digits: Column) -> Column:
    """Check digit of 16 to 19 digits."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = 2 * digit - F.when(digit > 4, 9).otherwise(0)
        return total + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(False)


def _parts(text: Column, pattern: str, guard: Column) -> Column:
    """The text cut at the matches: every second part is one.  Null where there is none."""
    parts = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)
    return F.when(guard, parts)


def _segments(text: Column) -> Column:
    has_digit, has_at = text.rlike("[0-9]"), F.contains(text, F.lit("@"))
    numbers = F.when(has_digit, F.regexp_replace(text, "(?<=[0-9])[ -](?=[0-9])", _JOINT))
    domains = F.when(has_at, F.regexp_replace(text, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _JOINT))
    spoken = has_at | F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]")) | F.contains(text, F.lit("{at}")) | text.rlike(r" at [A-Za-z0-9-]+ ?(?:\.[A-Za-z]|[(\[{ ]dot)")
    cut = (_parts(domains, _EMAIL, has_at), _parts(text, _IP, has_digit), _parts(numbers, _CARD, has_digit),
           _parts(text, _PHONE, F.contains(text, F.lit("+"))), _parts(text, _NUMBER, has_digit), _parts(text, _HANDLE, spoken))

    def described(kind: int):
        def one(s: Column, i: Column) -> Column:
            inside = i % 2 == 1
            return F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(s).cast("long").alias("len"), F.when(inside, s).alias("m"),
                            F.when(~inside, F.lower(F.substring(s, -40, 40))).alias("tail"), F.when(~inside, F.substring(s, 1, 1)).alias("head"))

        return one

    some = [F.when(F.size(parts) > 1, F.transform(parts, described(kind))) for kind, parts in enumerate(cut)]
    return F.flatten(F.array_compact(F.array(*some)))


def _shape(m: Column) -> dict[str, Column]:
    count = lambda chars: F.length(F.regexp_replace(m, f"[^{chars}]", ""))
    values = (F.least(F.length(_digits(m)), F.lit(24)), F.least(F.length(F.regexp_replace(F.regexp_replace(m, "[0-9]+", "9"), "[^9]", "")), F.lit(9)),
              F.least(count("()"), F.lit(2)), F.least(count("."), F.lit(4)), F.least(count("-"), F.lit(4)), F.least(count(" "), F.lit(4)), F.least(count("/"), F.lit(2)))
    return dict(zip(SHAPE, values))


def _masked(m: Column, kind: Column) -> Column:
    """Shapes of a find of a fixed format in forms that have none: phone without plus or country code, address written out."""
    described = lambda form: F.struct(*[v.alias(n) for n, v in _shape(form).items()])
    national = F.array(described(F.regexp_replace(m, r"^\+[0-9]{1,3}[ .-]*(?=[(0-9])", "")), described(F.regexp_replace(m, r"^\+[0-9]{1,3}[ .-]*\(?([0-9]+)\)?", "$1")))
    written = F.array(*(described(F.regexp_replace(F.regexp_replace(m, "@", at), r"\.([A-Za-z]+)$", f"{dot}$1")) for at, dot in _WRITTEN))
    return F.when((kind == BASE) & m.startswith("+"), national).when((kind == BASE + 1), written)


def _side(char: Column) -> Column:
    """What stands next to a candidate."""
    return F.when(F.coalesce(F.length(char), F.lit(0)) == 0, 0).when(char.rlike(r"\s"), 1).when(char.rlike(r"\p{L}"), 2).when(char.rlike("[0-9]"), 3).otherwise(4)


def candidates(docs: DataFrame, text: str = "text", keep: list[str | Column] = ()) -> DataFrame:
    """All matches: row number, kept columns, kind, start, end, whether a fixed format holds (or is held), features.

    Rows without a match are there once, with a null kind."""
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    clean = reduce(lambda t, c: F.when(F.contains(own, F.lit(c)), F.lit(True)).otherwise(t), (_MARK, _JOINT), F.lit(False))
    own = F.when(clean, F.translate(own, _MARK + _JOINT, _OTHER * 2)).otherwise(own)
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), *keep, own.alias("__text"))
    kept = [c for c in rows.columns if c not in ("__row", "__text")]
    cut = rows.select("__row", *[F.col(f"`{c}`") for c in kept], F.explode_outer(_segments(F.col("__text"))).alias("__s"))
    line = Window.partitionBy("__row", "__s.kind").orderBy("__s.i")
    placed = cut.select(
        "__row", *[F.col(f"`{c}`") for c in kept], "__s.kind", "__s.i", "__s.m",
        (F.sum("__s.len").over(line) - F.col("__s.len")).alias("start"), F.sum("__s.len").over(line).alias("end"),
        F.lag("__s.tail").over(line).alias("tail"), F.lead("__s.head").over(line).alias("head"))
    placed = placed.where(F.col("i").isNull() | (F.col("i") == 0) | (F.col("i") % 2 == 1))
    m, kind = F.col("m"), F.col("kind")
    digits = F.length(_digits(m))
    phone, ip, card = (F.regexp_extract(m, p, 0) for p in (_PHONE, _IP, r"[0-9](?:[ -]?[0-9]){15,18}"))
    holds = ((phone != "") & F.length(_digits(phone)).between(8, 15)) | ((ip != "") & ip.rlike(_IN_RANGE)) | _passes_luhn(_digits(card))
    handle = m.rlike(r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+\.[A-Za-z0-9-]")
    valid = (F.when(kind == 0, True).when(kind == 1, m.rlike(_IN_RANGE)).when(kind == 2, _passes_luhn(_digits(m)))
             .when(kind == 3, digits.between(8, 15)).when(kind == 4, holds).otherwise(handle))
    context = reduce(lambda other, w: F.when(F.col("tail").rlike(f"(?<![a-z])(?:{w[1]})"), w[0]).otherwise(other),
                     reversed(list(enumerate(_CONTEXT, 1))), F.lit(0))
    shape = _shape(m) | {"context": context, "before": _side(F.substring("tail", -1, 1)), "after": _side(F.col("head"))}
    real = F.col("i") % 2 == 1
    wide = real & (kind >= BASE)
    return placed.select("__row", *[F.col(f"`{c}`") for c in kept], F.when(real, kind).alias("kind"), "start", "end",
                         F.coalesce(F.when(real, valid), F.lit(False)).alias("valid"), *[F.when(wide, v).alias(n) for n, v in shape.items()],
                         F.when(wide & valid, _masked(m, kind)).alias("masked"))


def _tree_sql(node) -> str:
    """A fitted tree as a CASE expression."""
    if node.getClass().getSimpleName() == "LeafNode":
        return repr(float(node.prediction()))
    split = node.split()
    name, at = FEATURES[split.featureIndex()], float(split.threshold())
    return f"CASE WHEN {name} <= {at!r} THEN {_tree_sql(node.leftChild())} ELSE {_tree_sql(node.rightChild())} END"


def _labelled(counts: DataFrame) -> DataFrame:
    """Counted candidates with a ``label``, and whether they hold no fixed format (``formless``); those shaped like personal data without a fixed format have none and are left out."""
    right = counts.where("valid")
    masked = right.select("held", "kind", "context", "before", "after", "n", F.explode("masked").alias("s")).select(
        "held", "kind", "context", "before", "after", "n", *[F.col(f"s.{c}").alias(c) for c in SHAPE])
    columns = ["held", *FEATURES, "n"]
    # A number that fails its check digit or range is no card or address: only phones and handles have forms without a format.
    formless = right.where("masked is not null").select("kind", *SHAPE).unionByName(masked.select("kind", *SHAPE))
    right = right.select(*columns).withColumn("formless", F.lit(False)).unionByName(masked.select(*columns).withColumn("formless", F.lit(True)))
    known = formless.distinct().withColumn("known", F.lit(True))
    others = counts.where("not valid").join(known, ["kind", *SHAPE], "left").where(F.col("known").isNull() | (F.col("context") == _ELSE))
    return right.withColumn("label", F.lit(True)).unionByName(
        others.select(*columns).withColumns({"formless": F.lit(True), "label": F.lit(False)}))


def _likelihood(counts: DataFrame) -> Column | None:
    """Probability of personal data by boosted trees on the counted candidates; None where only one class is there."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    classes = counts.agg(F.sum(F.col("label").cast("long") * F.col("n")).alias("yes"), F.sum("n").alias("all")).first()
    if not classes["yes"] or classes["yes"] == classes["all"]:
        return None
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(counts.withColumn("label", F.col("label").cast("double")).withColumn("w", F.col("n").cast("double")))
    model = GBTClassifier(featuresCol="x", labelCol="label", weightCol="w", maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, minInstancesPerNode=1, seed=5).fit(rows)
    terms = [f"{float(w)!r} * ({_tree_sql(t._call_java('rootNode'))})" for t, w in zip(model.trees, model.treeWeights)]
    return F.expr(f"1 / (1 + exp(-2 * ({' + '.join(terms)})))")


def _thresholds(counts: DataFrame, likelihood: Column) -> dict[int, float]:
    """Per generator the least likelihood above which the calibration candidates are right often enough."""
    binned = counts.withColumn("bin", F.floor(likelihood * BINS)).groupBy("kind", "bin").agg(F.sum("n").alias("n"), F.sum(F.col("label").cast("long") * F.col("n")).alias("yes"))
    out: dict[int, float] = {}
    table = sorted(((r["kind"], r["bin"], r["n"], r["yes"]) for r in binned.collect()), reverse=True)  # bins times generators
    for kind in {r[0] for r in table}:
        n = yes = 0
        for _, bin_, more, right in (r for r in table if r[0] == kind):
            n, yes = n + more, yes + right
            if n >= ENOUGH and yes >= PRECISION * n:
                out[kind] = bin_ / BINS
    return out


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, counts of the fixed kinds, ``n_added``, ``base_sha256`` and ``spans``."""
    spark = docs.sparkSession
    all_ = candidates(docs, text, [F.col(doc_id).alias("doc_id")])
    all_.write.parquet(at := scratch_path(spark, "candidates"))
    all_ = spark.read.parquet(at)
    wide = all_.where(F.col("kind") >= BASE).withColumn("held", F.coalesce(common.fold(5) == 0, F.lit(False)))
    wide.groupBy("held", "valid", "masked", *FEATURES).agg(F.count(F.lit(1)).alias("n")).write.parquet(at := scratch_path(spark, "counts"))
    _labelled(spark.read.parquet(at)).write.parquet(at := scratch_path(spark, "labelled"))
    counts = spark.read.parquet(at)
    likelihood = _likelihood(counts.where("not held"))
    added = F.lit(False)
    if likelihood is not None:
        least = F.lit(None).cast("double")
        # What is added holds no fixed format, so thresholds are calibrated on such candidates alone.
        for kind, value in _thresholds(counts.where("held and formless"), likelihood).items():
            least = F.when(F.col("kind") == kind, value).otherwise(least)
        # A candidate that holds a fixed format is there already.
        added = F.coalesce((F.col("kind") >= BASE) & ~F.col("valid") & (likelihood >= least), F.lit(False))
    base = F.col("valid") & (F.col("kind") < BASE)
    marked = all_.select("__row", "doc_id", "kind", F.struct("kind", "start", "end").alias("span"), F.coalesce(base, F.lit(False)).alias("base"), added.alias("added"))
    n = [F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{KINDS[k]}") for k in range(BASE)]
    grouped = marked.groupBy("__row").agg(
        F.first("doc_id").alias("doc_id"), *n, F.count(F.when(F.col("added"), 1)).alias("n_added"),
        F.sort_array(F.collect_list(F.when(F.col("base"), F.col("span")))).alias("b"),
        F.sort_array(F.collect_list(F.when(F.col("base") | F.col("added"), F.col("span")))).alias("s"))
    names = F.array(*(F.lit(k) for k in KINDS))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")

    return grouped.select("doc_id", *[f"n_{k}" for k in KINDS[:BASE]], "n_added", F.sha2(joined("b"), 256).alias("base_sha256"), joined("s").alias("spans"))
