"""Rules as rows: what a column becomes, by step and priority.

A rule has a pattern for each condition column (NULL: anything; `text`: equal; `text*`: begins
with; `?`: missing; `+`: not missing), the column it sets, and either a value or the name of a
condition column to copy. In a step the matching rule of smallest priority wins; where none
matches, the column keeps what it has. A step sees what the steps before it have set.

Rules stay a table. Those of one shape (which columns are compared, and how) are found by one
equi-join, so a step costs a join for each shape, whatever the number of rules. Rows are reduced
to their distinct conditions first and get the result in one join.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelproj.operators.delivery import DeliveryRules
from panelproj.operators.relational import na_join

CONDITIONS = ["market", "atc3", "atc4", "molecule", "route"]
TARGETS = ["category_1", "category_2"]
_PATTERNS = [*CONDITIONS, *TARGETS]
RULES = "step int, priority int, " + ", ".join(f"{c} string" for c in _PATTERNS) + ", target string, value string, copy string"


def classification_rules(spark: SparkSession, rules: DeliveryRules | None = None) -> DataFrame:
    """The delivery's two category levels as a rule table."""
    r = rules or DeliveryRules()
    rows: list[tuple] = []

    def add(step: int, target: str, value: str | None, copy: str | None = None, **patterns: str) -> None:
        rows.append((step, len(rows), *[patterns.get(c) for c in _PATTERNS], target, value, copy))

    nitrate = {"market": r.nitrate_market, "atc3": r.nitrate_class}
    add(1, "category_1", r.nitrate_labels[0], **nitrate, molecule=r.nitrate_molecule)
    add(1, "category_1", r.nitrate_labels[1], **nitrate, molecule="+")
    add(1, "category_1", "TCM", market=r.venous_market, atc3=f"{r.tcm_prefix}*")
    for (market, atc3), label in r.category_1.items():
        add(1, "category_1", label, market=market, atc3=atc3)
    for atc3, label in r.category_2.items():
        add(2, "category_2", label, atc3=atc3)
    for atc4, label in r.category_2_subclass.items():
        add(2, "category_2", label, atc4=atc4)
    add(3, "category_2", None, copy="category_1", market=r.diabetes_market)
    add(3, "category_2", None, market="?")
    add(4, "category_1", r.diabetes_label, market=r.diabetes_market)
    for old, new in r.relabel_1.items():
        add(4, "category_1", new, category_1=old)
    for old, new in r.relabel_2.items():
        add(5, "category_2", new, category_2=old)
    for route, label in r.tcm_routes.items():
        add(6, "category_2", label, market=r.venous_market, category_1="TCM", route=route)
    add(6, "category_2", None, market=r.venous_market)
    for market in r.first_as_second:
        add(7, "category_2", None, copy="category_1", market=market, category_2="?")
    return spark.createDataFrame(rows, RULES)


def _kind(pattern: Column) -> Column:
    """How a pattern compares: any, missing, known, equal, or the length of a prefix."""
    return (
        F.when(pattern.isNull(), "any")
        .when(pattern == "?", "missing")
        .when(pattern == "+", "known")
        .when(F.endswith(pattern, F.lit("*")), (F.char_length(pattern) - 1).cast("string"))
        .otherwise("equal")
    )


def apply_rules(df: DataFrame, rules: DataFrame, conditions: Sequence[str] = CONDITIONS, targets: Sequence[str] = TARGETS) -> DataFrame:
    """The rows with the target columns set by the rules (existing ones are replaced)."""
    given = [c for c in conditions if c in df.columns]
    patterns = [*conditions, *targets]
    rows = df.select(*given).distinct().withColumns({c: F.lit(None).cast("string") for c in patterns if c not in given})
    kinds = [_kind(F.col(c)).alias(c) for c in patterns]
    shapes = rules.select("step", "target", *kinds).distinct().collect()  # at most one a combination of comparisons
    steps: dict[int, list] = {}
    for shape in shapes:
        steps.setdefault(shape["step"], []).append(shape)
    for step, of_step in sorted(steps.items()):
        if len({shape["target"] for shape in of_step}) > 1:
            raise ValueError(f"the rules of step {step} set several columns")
        rows = _step(rows, rules.filter(F.col("step") == step), of_step, patterns)
    return na_join(df.drop(*targets), rows.select(*given, *targets), given, "inner")


def _step(rows: DataFrame, rules: DataFrame, shapes: Sequence, patterns: Sequence[str]) -> DataFrame:
    hits = []
    for i, shape in enumerate(shapes):
        compared = {c: shape[c] for c in patterns if shape[c] not in ("any", "missing", "known")}
        mine = reduce(Column.__and__, [_kind(F.col(c)) == shape[c] for c in patterns])
        one = rules.filter(mine).select(
            *[F.when(F.lit(kind == "equal"), F.col(c)).otherwise(F.expr(f"left(`{c}`, char_length(`{c}`) - 1)")).alias(f"__{i}_{c}") for c, kind in compared.items()],
            F.lit(True).alias(f"__{i}_any"),
            F.struct("priority", "value", "copy").alias("rule"),
        )
        keys = [f"__{i}_{c}" for c in compared] + [f"__{i}_any"]
        one = one.groupBy(*keys).agg(F.min("rule").alias(f"__hit{i}"))
        there = [F.col(c).isNull() == (shape[c] == "missing") for c in patterns if shape[c] in ("missing", "known")]
        # a key of the row's own, so that conditions without a comparison join like others
        same = [F.coalesce(reduce(Column.__and__, there, F.col(patterns[0]).isNull() | F.col(patterns[0]).isNotNull()), F.lit(False)) == F.col(f"__{i}_any")]
        for c, kind in compared.items():
            same.append((F.col(c) if kind == "equal" else F.substring(F.col(c), 1, int(kind))) == F.col(f"__{i}_{c}"))
        rows = rows.join(one, reduce(Column.__and__, same), "left").drop(*keys)
        hits.append(f"__hit{i}")
    best = F.least(*hits) if len(hits) > 1 else F.col(hits[0])
    rows = rows.withColumn("__best", best)
    copied: Column = F.lit(None).cast("string")
    for c in patterns:
        copied = F.when(F.col("__best.copy") == c, F.col(c)).otherwise(copied)
    value = F.when(F.col("__best").isNull(), F.col(shapes[0]["target"])).when(F.col("__best.copy").isNotNull(), copied).otherwise(F.col("__best.value"))
    return rows.withColumn(shapes[0]["target"], value).drop(*hits, "__best")
