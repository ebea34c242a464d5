"""Personal data: base patterns plus boosted trees over candidate spans, all in column functions.

Generators propose spans freely; trees boosted on labelled candidates score their format
and context; a threshold per kind, set on candidates held out of training, selects what is
added to the base spans. The fitted trees are compiled into one CASE expression, so the
whole table is scored where it is scanned: no Python code and no shuffle.

Labels come from the base findings, rewritten into forms that the base patterns miss: an
address spelt "(at)", a number without its plus sign, a card in other groups. These are the
positives. Negatives are the same findings made wrong (a check digit changed, a part above
255, a sentence end for a dot), and proposed spans of the texts themselves, unless their
form or the words before them leave open what they are. Every document takes part. Candidates
of equal features and label are one weighted row, so what is fitted grows with the forms that
spans have, not with the documents.
"""

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from .shared import staged

KINDS = ("email", "ip", "card", "phone")

# Possessive quantifiers and lookbehinds change no match of the plain patterns; they keep a
# failing match from being tried again at each letter of a long run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Patterns of proposed spans; those of one kind may overlap.
GENERATORS = {
    "email": [r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?+(?:@|\(at\)|\[at\])\x20?+[A-Za-z0-9-]++"
             r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++"],
    "ip": [r"(?<![0-9])[0-9]{1,3}+(?:(?:[.,:]|\[\.\]|\(\.\))[0-9]{1,3}+){3}+"],
    "card": [r"[0-9](?:[\x20._/-]{0,2}+[0-9]){11,}+", r"(?<![0-9])[0-9]{13,19}+(?![0-9])"],
    "phone": [r"\(?+[0-9](?:[\x20()./-]{0,3}+[0-9]){6,}+"],
}
# Words near personal data, by kind.
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|host|server|addr|login|client",
    "card": "card|visa|credit|pay|karte|tarjeta|carte",
    "phone": "phone|tel|call|fax|mobile|ruf|llam|appel",
}
CONTEXT_CHARS = 24
#: Trees fitted to the labelled candidates.
TREES, DEPTH = 16, 4
#: Documents, one in so many, that set the thresholds and train no tree.
HELD_OUT = 3
#: Precision that a kind's threshold must reach on held-out candidates, both labels counted
#: alike, and the least number of each label to trust it.
PRECISION, LEAST_ROWS = 0.98, 8
SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def _sums(values):
    """Running sums of an array, in blocks, so that long arrays do not cost their square."""
    block = 64
    parts = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int")),
        lambda b: F.aggregate(F.slice(values, b * block + 1, block), F.lit(0).cast("long"), lambda a, x: a + x),
    )

    def with_parts(p):
        before = F.transform(p, lambda _, b: F.aggregate(F.slice(p, 1, b), F.lit(0).cast("long"), lambda a, x: a + x))
        return F.element_at(F.transform(F.array(before), lambda q: F.transform(
            values, lambda _, i: F.get(q, F.floor(i / block).cast("int")) + F.aggregate(
                F.slice(values, F.floor(i / block).cast("int") * block + 1, i % block + 1), F.lit(0).cast("long"),
                lambda a, x: a + x,
            ))), 1)

    return F.element_at(F.transform(F.array(parts), with_parts), 1)


def _found(frame, name, pattern, may):
    """Add ``name``: matches with start, end, value and context, in code points.

    Matches and the text between them come from the same search, so their lengths in turn
    give the positions.
    """
    none = F.array().cast("array<string>")
    frame = frame.withColumn("_v", F.when(may, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).otherwise(none))
    any_found = F.size("_v") > 0
    frame = frame.withColumn("_g", F.when(any_found, F.split("_text", pattern, -1)).otherwise(none))
    steps = F.transform("_v", lambda v, i: (F.length(F.get("_g", i)) + F.when(
        i > 0, F.length(F.get("_v", i - 1))).otherwise(0)).cast("long"))
    frame = frame.withColumn("_steps", steps)
    frame = frame.withColumn("_at", F.when(any_found, _sums(F.col("_steps"))).otherwise(F.array().cast("array<bigint>")))
    spans = F.transform("_v", lambda v, i: F.struct(
        F.get("_at", i).alias("start"), (F.get("_at", i) + F.length(v)).alias("end"), v.alias("value"),
        F.right(F.get("_g", i), F.lit(CONTEXT_CHARS)).alias("before"), F.left(F.get("_g", i + 1), F.lit(8)).alias("after"),
    ))
    return frame.withColumn(name, spans).drop("_v", "_g", "_steps", "_at")


def _digits(value):
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits):
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda a, i: a + F.element_at(
        F.transform(F.array(F.coalesce(F.substring(digits, n - i + 1, F.lit(1)).cast("int"), F.lit(0))), lambda d: F.when(
            i % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)), 1))
    return total % 10 == 0


def _dotted(value):
    """An address with plain dots, whatever was written in their place."""
    return F.regexp_replace(value, "[^0-9]+", ".")


def _small_parts(value):
    return F.forall(F.split(value, r"\."), lambda p: F.when(
        F.length(F.ltrim(p, F.lit("0"))) <= 3, F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255
    ).otherwise(F.lit(False)))


def _valid(kind, value):
    n = F.length(_digits(value))
    if kind == "ip":
        return _small_parts(value)
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _count(value, pattern):
    return F.regexp_count(value, F.lit(pattern)).cast("double")


def features(kind, x):
    """Format and context of a candidate, as named numbers."""
    value, before = x["value"], F.lower(x["before"])
    digits = _digits(value)
    n = F.length(digits)
    flag = lambda c: c.cast("double")
    return {
        **{f"is_{k}": F.lit(float(k == kind)) for k in KINDS},
        "n_chars": F.length(value).cast("double"),
        "n_digits": n.cast("double"),
        "n_groups": _count(value, "[0-9]+"),
        "n_letters": _count(value, "[A-Za-z]"),
        "n_spaces": _count(value, " "),
        "n_dots": _count(value, r"\."),
        "stop": flag(value.rlike(r"\.\x20")),
        "first_group": F.length(F.regexp_extract(value, "[0-9]+", 0)).cast("double"),
        "last_group": F.length(F.regexp_extract(value, "([0-9]+)[^0-9]*$", 1)).cast("double"),
        "n_dashes": _count(value, "-"),
        "n_parens": _count(value, r"[()\[\]]"),
        "at_sign": flag(F.instr(value, "@") > 0),
        "plus_before": flag(F.endswith(before, F.lit("+"))),
        "luhn": flag(F.when(n.between(12, 19), _luhn(digits)).otherwise(F.lit(False))),
        "small_parts": flag(F.when(n <= 12, _small_parts(_dotted(value))).otherwise(F.lit(False))),
        "digit_before": flag(before.rlike("[0-9][^a-z]?$")),
        "digit_after": flag(x["after"].rlike("^[^A-Za-z]?[0-9]")),
        "word_before": flag(before.rlike("[a-z]$")),
        **{f"near_{k}": flag(before.rlike(f"(?:{words})")) for k, words in CONTEXT.items()},
    }


def _overlap(a, b):
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _proposed(docs):
    """Per document ``_base_<kind>`` and ``_cand_<kind>``: spans with value and context."""
    text = F.coalesce(F.col("text"), F.lit(""))
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text"))
    frame = frame.withColumn("_digit", F.col("_text").rlike("[0-9]"))
    may = {
        "email": (F.instr("_text", "@") > 0) | F.contains("_text", F.lit("(at)")) | F.contains("_text", F.lit("[at]")),
        "ip": F.col("_digit"), "card": F.col("_digit"), "phone": F.col("_digit"),
    }
    for kind in KINDS:
        frame = _found(frame, f"_base_{kind}", BASE[kind], may[kind])
        frame = frame.withColumn(f"_base_{kind}", F.filter(f"_base_{kind}", lambda x: _valid(kind, x["value"])))
        for k, pattern in enumerate(GENERATORS[kind]):
            frame = _found(frame, f"_cand_{kind}_{k}", pattern, may[kind])
        every = F.concat(*(F.col(f"_cand_{kind}_{k}") for k in range(len(GENERATORS[kind]))))
        frame = frame.withColumn(f"_cand_{kind}", F.array_distinct(every))
    spans = F.concat(*(F.transform(f"_base_{k}", lambda x: F.struct(
        F.lit(k).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))) for k in KINDS))
    return frame.withColumn("base", spans)


def candidates(docs):
    """Per document its base spans and the candidates that touch none, with their features.

    ``base`` has kind, start and end by kind as listed and start; ``candidates`` adds the
    features of every proposed span.
    """
    frame = _proposed(docs)
    free = [F.transform(
        F.filter(f"_cand_{kind}", lambda x: ~F.exists("base", lambda b: _overlap(b, x))),
        lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                           *(c.alias(name) for name, c in features(kind, x).items())),
    ) for kind in KINDS]
    return frame.select(
        "doc_id", *(F.size(f"_base_{k}").cast("long").alias(f"n_{k}") for k in KINDS), "base",
        F.concat(*free).alias("candidates"),
    )


def _with_check_digit(start):
    """A number completed by the digit that makes it pass the check."""
    return F.concat(start, F.element_at(F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: d.cast("string")), lambda d: _luhn(F.concat(start, d))), 1))


def _next_digit(value, at):
    """``value`` with the digit at a position (from 1) counted on by one."""
    digit = (F.substring(value, at, F.lit(1)).cast("int") + 1) % 10
    return F.concat(F.left(value, at - 1), digit.cast("string"), F.substring(value, at + 1, F.length(value)))


def _rewritten(kind, x):
    """(value, before, right) of a base finding in forms that its base pattern misses.

    ``right`` is false for the forms that are made wrong. Values are built in arrays, step by
    step, so that no expression is repeated in the plan.
    """
    value, before = x["value"], x["before"]
    digits = _digits(value)
    if kind == "email":
        name, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
        dots = lambda by: F.replace(host, F.lit("."), F.lit(by))
        right = F.array(*(F.concat(name, F.lit(at), dots(dot)) for at, dot in (
            (" (at) ", " (dot) "), ("(at)", "."), ("[at]", "[dot]"), (" [at] ", "."), (" @ ", "."))))
        wrong = F.array(*(F.concat(name, F.lit(at), dots(". ")) for at in (" (at) ", "(at)", "[at]", " [at] ", " @ ")))
    elif kind == "ip":
        signs = F.array(F.lit("[.]"), F.lit("(.)"))
        large = F.concat_ws(".", F.slice(F.split(value, r"\."), 1, 3), (F.lit(300) + F.length(value)).cast("string"))
        right = F.transform(signs, lambda by: F.replace(value, F.lit("."), by))
        wrong = F.transform(F.concat(F.array(F.lit(".")), signs), lambda by: F.replace(large, F.lit("."), by))
    elif kind == "card":
        groups = F.array(*(F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", f"$1{by}") for by in "./_"))
        shorter = F.transform(F.array(F.left(digits, F.lit(12)), F.left(digits, F.lit(14))), _with_check_digit)
        right = F.concat(groups, shorter)
        wrong = F.transform(right, lambda v: _next_digit(v, F.length(v)))
    else:
        rest = F.substring(value, F.lit(2), F.length(value))
        home = F.regexp_replace(value, r"^\+[0-9]{1,3}[\x20.-]*", "")
        slashes = F.regexp_replace(rest, r"[\x20.-]+", "/")
        right = F.filter(F.array(rest, home, slashes, F.concat(F.lit("00"), rest)), lambda v: v.rlike("[0-9][^0-9]+[0-9]"))
        wrong = F.transform(F.array(digits), lambda d: F.array(
            d, F.left(d, F.lit(8)), F.concat(d, F.left(d, F.lit(6))),
            F.concat_ws("-", *(F.substring(d, F.lit(at), F.lit(n)) for at, n in ((1, 4), (5, 2), (7, 2)))),
        ))
        wrong = F.flatten(wrong)

    def rows(values, good, contexts):
        return F.flatten(F.transform(values, lambda v: F.transform(contexts, lambda b: F.struct(
            v.alias("value"), b.alias("before"), F.lit(good).alias("right")))))

    contexts = F.array(before, F.lit(" "))
    found = [rows(right, True, contexts), rows(wrong, False, contexts)]
    if kind == "card":  # a number next to another one: the base pattern takes both as one
        beside = F.array(F.right(F.concat(before, F.reverse(digits), F.lit(" ")), F.lit(CONTEXT_CHARS)))
        found.append(rows(F.array(digits), True, beside))
        found.append(rows(F.transform(F.array(digits), lambda v: _next_digit(v, F.length(v))), False, beside))
    return F.concat(*found)


def _open(kind, c, value):
    """Whether form or context leave open what a proposed span of a text is."""
    form = {
        "email": value.rlike(r"[(\[](?:at|dot)"),
        "ip": (c["small_parts"] == 1) & value.rlike(r"[\[(]"),
        "card": (c["luhn"] == 1) & c["n_digits"].between(13, 19),
        "phone": value.rlike(r"^\(|^0") & c["n_digits"].between(8, 15),
    }[kind]
    return form | (c[f"near_{kind}"] == 1)


def labelled(docs):
    """Rows (doc_id, kind, target, features) to learn from: see the head of this module.

    A rewritten finding counts only if a generator of its kind proposes it whole.
    """
    frame, parts = _proposed(docs), []
    for kind in KINDS:
        whole = "|".join(f"(?:{p})" for p in GENERATORS[kind])
        copies = F.flatten(F.transform(f"_base_{kind}", lambda x: F.transform(
            _rewritten(kind, x), lambda r: F.struct(r["value"].alias("value"), r["before"].alias("before"),
                                                    x["after"].alias("after"), r["right"].alias("right")))))
        copies = F.filter(copies, lambda r: F.coalesce(r["value"].rlike(f"^(?:{whole})$"), F.lit(False)))
        free = F.filter(f"_cand_{kind}", lambda x: ~F.exists("base", lambda b: _overlap(b, x)))
        free = F.transform(free, lambda x: F.struct(
            x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after"),
            F.lit(None).cast("boolean").alias("right")))
        parts.append(F.transform(F.concat(copies, free), lambda r: F.struct(
            F.lit(kind).alias("kind"), r["right"].alias("right"), r["value"].alias("value"),
            *(c.alias(name) for name, c in features(kind, r).items()))))
    # Written before it is exploded: the filter that an explode brings along would repeat
    # the work of every candidate.
    arrays = staged(frame.select("doc_id", F.concat(*parts).alias("rows")), "pii-arrays")
    rows = arrays.select("doc_id", F.explode("rows").alias("c")).select("doc_id", "c.*")
    unclear = F.lit(False)
    for kind in KINDS:
        unclear = F.when(F.col("kind") == kind, _open(kind, {n: F.col(n) for n in rows.columns}, F.col("value"))).otherwise(unclear)
    rows = rows.filter(F.col("right").isNotNull() | ~unclear)
    return rows.withColumn("target", F.coalesce("right", F.lit(False)).cast("double")).drop("right", "value")


def _tree(lines, at=0):
    """One tree of a model's printed form: a leaf value, or (feature, threshold, low, high)."""
    line = lines[at].strip()
    leaf = re.match(r"Predict: (\S+)", line)
    if leaf:
        return float(leaf[1]), at + 1
    feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low, at = _tree(lines, at + 1)
    high, at = _tree(lines, at + 1)  # past the Else line
    return (int(feature), float(threshold), low, high), at


def compile_trees(printed, names):
    """The margin of a printed boosted model, as a function of a struct of features."""
    weights = [float(w) for w in re.findall(r"Tree \d+ \(weight (\S+)\):", printed)]
    trees = [_tree([x for x in part.split("\n")[1:] if x.strip()])[0] for part in re.split(r"\n\s*Tree \d+ ", printed)[1:]]

    def column(node, x):
        if isinstance(node, float):
            return F.lit(node)
        feature, threshold, low, high = node
        return F.when(x[names[feature]] <= threshold, column(low, x)).otherwise(column(high, x))

    return lambda x: sum((F.lit(w) * column(t, x) for w, t in zip(weights, trees)), F.lit(0.0))


def _score(margin):
    return 1 / (1 + F.exp(-2 * margin))


def feature_names(rows):
    return [c for c in rows.columns if c not in ("doc_id", "kind", "target", "calibrate", "n", "weight")]


def counted(rows):
    """Equal rows of all documents as one row with their number ``n``."""
    return rows.groupBy(*(c for c in rows.columns if c != "doc_id")).agg(F.count(F.lit(1)).alias("n"))


def _balanced(rows):
    """Add ``weight``: both labels of a kind weigh the same."""
    rows = rows if "n" in rows.columns else counted(rows)
    totals = rows.groupBy("kind", "target").agg(F.sum("n").alias("total"))
    return rows.join(F.broadcast(totals), ["kind", "target"]).withColumn(
        "weight", 1000 * F.col("n") / F.col("total")).drop("n", "total")


def learn(rows, seed=3):
    """The boosted model of labelled rows; None if one label is missing."""
    if rows.select("target").distinct().count() < 2:
        return None
    assembled = VectorAssembler(inputCols=feature_names(rows), outputCol="features").transform(_balanced(rows))
    return GBTClassifier(labelCol="target", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=seed).fit(
        assembled.select("features", "target", "weight"))


def fit(rows, seed=3):
    """(margin function, threshold per kind) from what ``labelled`` gives; None if one-sided.

    A third of the documents sets the thresholds: per kind the least score above which enough
    held-out candidates are right, both labels weighing the same.
    """
    held = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(HELD_OUT)) == 0
    rows = staged(counted(rows.withColumn("calibrate", held)), "pii-candidates")
    model = learn(rows.filter("!calibrate"), seed)
    if model is None:
        return None
    names = feature_names(rows)
    margin = compile_trees(model.toDebugString, names)
    scored = rows.filter("calibrate").select(
        "kind", "target", "n", (F.floor(_score(margin({n: F.col(n) for n in names})) * 10_000) / 10_000).alias("score")
    ).groupBy("kind", "score").agg(F.sum(F.col("target") * F.col("n")).alias("right"), F.sum("n").alias("n")).collect()
    thresholds = {}
    for kind in KINDS:
        own = sorted((r for r in scored if r["kind"] == kind), key=lambda r: -r["score"])
        n_right = sum(r["right"] for r in own)
        n_wrong = sum(r["n"] for r in own) - n_right
        if min(n_right, n_wrong) < LEAST_ROWS:
            continue
        right = wrong = 0
        for r in own:
            right, wrong = right + r["right"] / n_right, wrong + (r["n"] - r["right"]) / n_wrong
            if right >= PRECISION * (right + wrong):
                thresholds[kind] = r["score"]
    return margin, thresholds


def find_pii(docs):
    """Per document: counts and spans of the base kinds, and all spans.

    ``base`` and ``spans`` are arrays of (kind, start, end) in code points, end exclusive,
    by kind as listed and start. Added spans overlap no base span; of added spans that
    overlap, the better scored stays, then the earlier. A null text is empty.
    """
    found = candidates(docs)
    fitted = fit(labelled(docs))
    added = F.array().cast(SPAN)
    if fitted and fitted[1]:
        margin, thresholds = fitted
        least = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])
        found = found.withColumn("_scored", F.transform(
            "candidates", lambda x: F.struct(
                x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), _score(margin(x)).alias("score"))
        )).withColumn("_good", F.filter("_scored", lambda x: x["score"] >= F.element_at(least, x["kind"])))
        rank = lambda x: F.struct(-x["score"], x["start"], x["end"], x["kind"])
        added = F.transform(
            F.filter("_good", lambda x: ~F.exists("_good", lambda y: _overlap(x, y) & (rank(y) < rank(x)))),
            lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")),
        )
    every = F.concat("base", added)
    in_order = F.concat(*(F.sort_array(F.filter(every, lambda x: x["kind"] == k)) for k in KINDS))
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), "base", in_order.alias("spans"))


def joined(spans):
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def pii_report(docs):
    """The digest per document: counts, the base spans' hash, all spans as text and their number.

    Repeated rows each give a row; columns other than doc_id and text are not read.
    """
    return find_pii(docs).select(
        "doc_id", *(f"n_{k}" for k in KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )
