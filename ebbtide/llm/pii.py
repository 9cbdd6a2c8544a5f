"""Personal data in texts: patterns, and further spans that boosted trees select.

Fixed patterns give the base spans. Generators with looser patterns propose more, and
these may overlap each other and the base. What a proposal looks like and what stands
around it become a few coarse features. Gradient-boosted trees learn from all proposals
of all texts which of them look like base spans: the texts are reduced to counts per
combination of feature values, of which there is a fixed number, and the trees are
grown on these counts. Thresholds are calibrated on a fold of the texts held out.
All work on texts is done by built-in expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import known, stored

KINDS = ("email", "ip", "card", "phone")
# A run of characters that may begin a match is entered at its start only, or where the
# last match ended: elsewhere in it a match would go on alike. Loops never give back
# what they took, so that long runs cost no more than their length.
_LOCAL = "A-Za-z0-9._%+-"
BASE = (
    rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[ -]?+[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_NAME = r"\p{L}\p{N}._%+-"
GENERATORS = (
    rf"(?i)(?:(?<![{_NAME}])|\G)[{_NAME}]++ ?(?:@|\(at\)|\[at\]) ?[\p{{L}}\p{{N}}-]++"
    r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[\p{L}\p{N}-]++)++",
    r"(?<![0-9])[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}(?![0-9])",
    r"(?<![0-9])[0-9]{4}(?:[ ./-]?[0-9]{4}){3}(?![0-9])",
    r"(?<![0-9])(?:00[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])",
)
_CONTEXT = r"(?i)mail|phone|tel|call|card|visa|account|\bip\b|host|server|address|contact"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
# Names of the features and how many values each has.
FEATURES = {
    "kind": 4, "digits": 5, "joint": 4, "before": 3, "after": 3,
    "checksum": 2, "octets": 2, "context": 2,
}
ROUNDS = 16
RATE = 0.4
# Share of proposals at or above a threshold that must look like base spans.
PRECISION = 0.95


def _matches(text: Column, pattern: str) -> Column:
    """The non-overlapping matches of a pattern, leftmost first: ``start``, ``end`` (in
    code points, end exclusive), ``match``, and ``lead``, the text just before."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("lead"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
    )
    nothing = F.array().cast("array<struct<start:int,end:int,match:string,lead:string>>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["lead"])
        end = start + F.length(known(part["match"]))
        own = F.struct(
            start.alias("start"),
            end.alias("end"),
            part["match"].alias("match"),
            F.right(part["lead"], F.lit(24)).alias("lead"),
        )
        found = F.when(part["match"].isNull(), state["found"]).otherwise(
            F.concat(state["found"], F.array(own))
        )
        return F.struct(end.alias("at"), found.alias("found"))

    start = F.struct(F.lit(0).alias("at"), nothing.alias("found"))
    return F.aggregate(parts, start, step, lambda state: state["found"])


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    def weighed(digit: Column, place: Column) -> Column:
        value = F.coalesce(F.try_to_number(digit, F.lit("9")).cast("int"), F.lit(0))
        twice = F.when(value > 4, 2 * value - 9).otherwise(2 * value)
        return F.when(place % 2 == 1, twice).otherwise(value)

    values = F.transform(F.split(F.reverse(digits), ""), weighed)
    return F.aggregate(values, F.lit(0), lambda total, value: total + value) % 10 == 0


def _octets(match: Column) -> Column:
    return match.rlike(rf"^{_OCTET}(?: ?\. ?{_OCTET}){{3}}$")


def _passes(kind: int, match: Column) -> Column:
    size = F.length(_digits(match))
    return (
        F.lit(True),
        _octets(match),
        size.between(12, 19) & _luhn(_digits(match)),
        size.between(9, 15),
    )[kind]


def _possible(text: Column, kind: int, loose: bool) -> Column:
    """A cheap test that texts without any match fail."""
    if kind == 0:
        return text.contains("@") | (text.rlike(r"(?i)[(\[]at[)\]]") if loose else F.lit(False))
    if kind == 3 and not loose:
        return text.contains("+")
    return text.rlike("[0-9]")


def _side(character: Column) -> Column:
    plain = (character == "") | character.rlike(r"^\s")
    return F.when(plain, 0).when(character.rlike(r"^[\p{L}\p{N}]"), 1).otherwise(2)


def _described(text: Column, kind: int, found: Column) -> Column:
    """A proposal as its place and features."""
    match = found["match"]
    size = F.length(_digits(match))
    features = {
        "kind": F.lit(kind),
        "digits": F.when(size == 0, 0).when(size < 8, 1).when(size < 12, 2).when(size < 17, 3).otherwise(4),
        "joint": F.when(match.contains("("), 3)
        .when(match.rlike("[ -]"), 1)
        .when(match.contains("."), 2)
        .otherwise(0),
        "before": _side(F.right(found["lead"], F.lit(1))),
        "after": _side(F.substr(text, found["end"] + 1, F.lit(1))),
        "checksum": F.when(size.between(12, 19) & _luhn(_digits(match)), 1).otherwise(0),
        "octets": F.when(_octets(match), 1).otherwise(0),
        "context": F.when(found["lead"].rlike(_CONTEXT), 1).otherwise(0),
    }
    return F.struct(
        found["start"].alias("start"),
        F.lit(kind).alias("kind"),
        found["end"].alias("end"),
        F.struct(*[value.cast("int").alias(name) for name, value in features.items()]).alias("f"),
    )


_SPAN = "struct<start:int,kind:int,end:int>"
_FEATURES_TYPE = ",".join(f"{name}:int" for name in FEATURES)
_PROPOSAL = f"struct<start:int,kind:int,end:int,f:struct<{_FEATURES_TYPE}>>"


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``base`` spans and ``proposed`` spans with their features, and the fold,
    of every row of ``docs``."""
    whole = F.col("text")

    def of(kind: int, loose: bool) -> Column:
        found = _matches(whole, (GENERATORS if loose else BASE)[kind])
        if loose:
            listed = F.transform(found, lambda m: _described(whole, kind, m))
        else:
            kept = F.filter(found, lambda m: _passes(kind, m["match"]))
            listed = F.transform(
                kept, lambda m: F.struct(m["start"], F.lit(kind).alias("kind"), m["end"])
            )
        kind_type = f"array<{_PROPOSAL if loose else _SPAN}>"
        return F.when(_possible(whole, kind, loose), listed.cast(kind_type)).otherwise(
            F.array().cast(kind_type)
        )

    kinds = range(len(KINDS))
    return docs.select(
        F.col(key).cast("long").alias("id"), known(F.col(text)).alias("text")
    ).select(
        "id",
        F.array_sort(F.concat(*[of(kind, False) for kind in kinds])).alias("base"),
        F.concat(*[of(kind, True) for kind in kinds]).alias("proposed"),
        F.pmod(F.xxhash64("text"), F.lit(4)).cast("int").alias("fold"),
    )


@dataclass
class Tree:
    """A split of a feature's values, and below it one on either side."""

    feature: str
    least: int
    sides: tuple[tuple[str, int, float, float], tuple[str, int, float, float]]

    def value(self, features: dict[str, int]) -> float:
        name, least, low, high = self.sides[features[self.feature] >= self.least]
        return high if features[name] >= least else low

    def column(self, features: Column) -> Column:
        def leaf(side: tuple[str, int, float, float]) -> Column:
            name, least, low, high = side
            return F.when(features[name] >= least, high).otherwise(low)

        return F.when(features[self.feature] >= self.least, leaf(self.sides[1])).otherwise(
            leaf(self.sides[0])
        )


def _best_split(cells: list[tuple[dict, float, float]]) -> tuple[float, str, int, float, float]:
    """The split of cells ``(features, slope, curve)`` that lowers the loss most, and
    the Newton steps on its sides."""

    def side(slope: float, curve: float) -> tuple[float, float]:
        return slope * slope / (curve + 1), -RATE * slope / (curve + 1)

    all_slope, all_curve = (sum(c[i] for c in cells) for i in (1, 2))
    gain, step = side(all_slope, all_curve)
    best = (gain, "kind", 0, step, step)
    for name, values in FEATURES.items():
        sums = [[0.0, 0.0] for _ in range(values)]
        for features, slope, curve in cells:
            sums[features[name]][0] += slope
            sums[features[name]][1] += curve
        for least in range(1, values):
            low = [sum(s[i] for s in sums[:least]) for i in (0, 1)]
            high = [all_slope - low[0], all_curve - low[1]]
            (gain_low, step_low), (gain_high, step_high) = side(*low), side(*high)
            if gain_low + gain_high > best[0] + 1e-9:
                best = (gain_low + gain_high, name, least, step_low, step_high)
    return best


def boost(cells: list[tuple[dict[str, int], float, float]]) -> list[Tree]:
    """Trees of two levels for the log loss of cells ``(features, rows, positive rows)``."""
    scores = [0.0] * len(cells)
    trees = []
    for _ in range(ROUNDS):
        sloped = []
        for (features, rows, good), score in zip(cells, scores, strict=True):
            p = 1 / (1 + math.exp(-score))
            sloped.append((features, rows * p - good, rows * p * (1 - p)))
        _, name, least, _, _ = _best_split(sloped)
        sides = tuple(
            _best_split([c for c in sloped if (c[0][name] >= least) == high])[1:]
            for high in (False, True)
        )
        trees.append(Tree(name, least, sides))
        scores = [s + trees[-1].value(c[0]) for s, c in zip(scores, cells, strict=True)]
    return trees


def thresholds(
    trees: list[Tree], cells: list[tuple[dict[str, int], float, float]]
) -> list[float]:
    """For each kind the least score from which on proposals are precise enough."""
    found = []
    for kind in range(len(KINDS)):
        scored = sorted(
            (
                (sum(t.value(features) for t in trees), rows, good)
                for features, rows, good in cells
                if features["kind"] == kind
            ),
            reverse=True,
        )
        least, rows, good = math.inf, 0.0, 0.0
        for i, (score, more, right) in enumerate(scored):
            rows, good = rows + more, good + right
            last = i + 1 == len(scored) or scored[i + 1][0] < score
            if last and good >= PRECISION * rows:
                least = score
        found.append(least - 1e-9)
    return found


def _inside(span: Column, base: Column) -> Column:
    return F.exists(
        base,
        lambda b: (b["kind"] == span["kind"]) & (b["start"] <= span["start"]) & (span["end"] <= b["end"]),
    )


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``base`` and ``spans`` of every row of ``docs``: arrays of ``start``,
    ``kind`` (its place in ``KINDS``) and ``end``, sorted.

    Base spans always stay. Proposals within a base span of their kind add nothing;
    others are added where the trees score them at or above their kind's threshold, so
    none where no proposal resembled a base span. Null texts count as empty and have
    no spans. Rows that repeat are each searched; an empty table gives no rows; other
    columns are not read.
    """
    found = stored(spans(docs, key, text), "spans")
    proposed = found.select(
        "fold", "base", F.explode("proposed").alias("p")
    ).select("fold", "p.f.*", _inside(F.col("p"), F.col("base")).alias("good"))
    # At most as many rows as there are combinations of feature values, twice.
    counted = (
        proposed.groupBy((F.col("fold") == 0).alias("held"), *FEATURES)
        .agg(F.count("*").alias("rows"), F.count_if("good").alias("good"))
        .collect()
    )
    cells = {False: [], True: []}
    for row in counted:
        features = {name: row[name] for name in FEATURES}
        cells[row.held].append((features, float(row.rows), float(row.good)))
    ordered = {held: sorted(c, key=lambda x: tuple(x[0].values())) for held, c in cells.items()}
    trees = boost(ordered[False])
    least = thresholds(trees, ordered[True])

    def chosen(p: Column) -> Column:
        score = reduce(lambda a, b: a + b, [tree.column(p["f"]) for tree in trees])
        limits = F.array(*[F.lit(x) for x in least])
        return score >= F.element_at(limits, p["kind"] + 1)

    added = F.filter(
        "proposed", lambda p: ~_inside(p, F.col("base")) & chosen(p)
    )
    added = F.transform(added, lambda p: F.struct(p["start"], p["kind"], p["end"])).cast(
        f"array<{_SPAN}>"
    )
    return found.select(
        "id", "base", F.array_sort(F.concat("base", F.array_distinct(added))).alias("spans")
    )


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":",
                F.element_at(names, s["kind"] + 1),
                s["start"].cast("string"),
                s["end"].cast("string"),
            ),
        ),
        ",",
    )
