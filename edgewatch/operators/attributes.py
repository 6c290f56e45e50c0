"""Which flow attributes separate a class from the rest."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgewatch.functions.ordering import (
    ROWS_PER_SLICE,
    Slices,
    exact_quantiles,
    long_form,
    with_running_sums,
)
from edgewatch.functions.scalar import named
from edgewatch.functions.sizing import join_sized
from edgewatch.operators.clean import column_medians, fill_medians
from edgewatch.schemas import BENIGN, PROFILE_FEATURES
from edgewatch.session import materialize

CLASS = "attack_type"
BINS = 5
MIN_ROWS_IMPORTANCE = 10
TOP_IMPORTANCE = 10
#: Texts of the attribute table.
IN_DISTRIBUTION = " in anomaly distribution"
NO_FEATURES = "No discriminative features"
NO_RANGE = "N/A"


def profile_features(flows: DataFrame, features: list[str] | None = None) -> list[str]:
    """The features to analyse that the frame has."""
    wanted = list(PROFILE_FEATURES) if features is None else features
    return [f for f in wanted if f in flows.columns]


def stored_features(flows: DataFrame, features: list[str]) -> DataFrame:
    """Class and features as numbers, written once: the analyses read them several times."""
    return materialize(flows.select(CLASS, *[named(f).cast("double").alias(f) for f in features]), "features")


def position_of(feature: Column, features: list[str]) -> Column:
    """Place of a feature in the list, the tie-break of every ranking."""
    return F.array_position(F.array(*[F.lit(f) for f in features]), feature)


class ValueCounts:
    """How often each class has each value of each feature, sorted by value, with running counts per class.

    Rows are counted per feature and value with a column for each class, so one table in one order has all
    that quartiles, ranges and comparisons of classes need. Gaps are left out. The list of classes is the
    only thing the driver gets.
    """

    def __init__(self, flows: DataFrame, features: list[str]):
        self.features = features
        self.classes = sorted(r[0] for r in flows.select(CLASS).distinct().collect() if r[0] is not None)
        cells = long_form(flows, features, Slices({}), F.col(CLASS))
        own = [F.count_if(F.col(CLASS) == c).alias(f"n{i}") for i, c in enumerate(self.classes)]
        names = [f"n{i}" for i in range(len(self.classes))]
        counted = cells.groupBy("feature", "value").agg(*own) if own else None
        self.ranked = with_running_sums(counted, ["feature"], names) if own and features else None

    def summary(self, *columns) -> DataFrame:
        """``feature, attack_type, ...`` of the classes that have values; ``columns`` take a class's number and totals."""
        totals = self.ranked.groupBy("feature").agg(*[F.sum(f"n{i}").alias(f"all{i}") for i in range(len(self.classes))])
        placed = join_sized(self.ranked, totals, ["feature"], len(self.features))
        numbers = range(len(self.classes))
        flat = placed.groupBy("feature").agg(*[column(i).alias(f"{label}{i}") for i in numbers for label, column in columns])
        per_class = [
            F.struct(F.lit(name).alias(CLASS), *[F.col(f"{label}{i}").alias(label) for label, _ in columns])
            for i, name in enumerate(self.classes)
        ]
        return flat.select("feature", F.inline(F.array(*per_class)))

    def at_rank(self, i: int, rank: Column) -> Column:
        """The value of class ``i`` at a rank, counted from 0."""
        return F.min(F.when((F.col(f"n{i}") > 0) & (F.col(f"n{i}_upto") > rank), F.col("value")))

    def quantile(self, probability: float):
        def of(i: int) -> Column:
            place = (F.col(f"all{i}") - 1) * F.lit(probability)
            low, high = self.at_rank(i, F.floor(place)), self.at_rank(i, F.ceil(place))
            return low + (high - low) * F.max(place - F.floor(place))

        return of

    def delta(self, i: int) -> Column:
        """Cliff's delta of class ``i``: its values lose to the benign ones above and beat those below."""
        if BENIGN not in self.classes:
            return F.first(F.lit(None).cast("double"))
        benign = self.classes.index(BENIGN)
        below = (F.col(f"n{benign}_upto") - F.col(f"n{benign}")).cast("double")
        above = (F.col(f"all{benign}") - F.col(f"n{benign}_upto")).cast("double")
        n = F.col(f"n{i}").cast("double")
        sizes = [F.nullif(F.max(f"all{k}"), F.lit(0)) for k in (benign, i)]
        return F.sum(n * (above - below)) / sizes[0] / sizes[1]

    def extent(self, i: int) -> Column:
        value = F.when(F.col(f"n{i}") > 0, F.col("value"))
        return F.max(value) - F.min(value)


def _no_rows(flows: DataFrame, schema: str) -> DataFrame:
    return flows.sparkSession.createDataFrame([], schema)


def cliffs_delta(flows: DataFrame, features: list[str] | None = None) -> DataFrame:
    """``attack_type, feature, cliff_delta``: P(benign > attack) - P(benign < attack).

    Comparing all pairs is quadratic. Equal values are counted first, and an attack value ``v`` then
    beats or loses to as many benign rows as lie below or above it, which a running count over the
    sorted values gives. The sort is a range partitioning.
    """
    counts = ValueCounts(flows, profile_features(flows, features))
    if counts.ranked is None:
        return _no_rows(flows, f"{CLASS} string, feature string, cliff_delta double")
    found = counts.summary(("cliff_delta", counts.delta))
    return found.filter((F.col(CLASS) != BENIGN) & F.col("cliff_delta").isNotNull()).select(CLASS, "feature", "cliff_delta")


def feature_statistics(flows: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Medians, interquartile ranges, Cliff's delta and discrimination per attack class and feature.

    All of them come from one table of value counts. Features that a class or the benign rows have no value
    of are left out.
    """
    features = profile_features(flows, features)
    counts = ValueCounts(flows, features)
    if counts.ranked is None:
        names = ("benign_median", "benign_iqr", "attack_median", "attack_iqr", "cliff_delta", "discrimination")
        return _no_rows(flows, f"{CLASS} string, feature string, " + ", ".join(f"{n} double" for n in names))
    quartiles = [(f"q{i}", counts.quantile(p)) for i, p in enumerate((0.25, 0.5, 0.75))]
    found = counts.summary(*quartiles, ("range", counts.extent), ("cliff_delta", counts.delta)).filter("q1 IS NOT NULL")
    sides = found.select(CLASS, "feature", F.col("q1").alias("median"), (F.col("q2") - F.col("q0")).alias("iqr"), "range", "cliff_delta")
    # a row per feature and class: both sides of every pair in one small grouping
    benign = F.max(F.when(F.col(CLASS) == BENIGN, F.struct("median", "iqr", "range"))).over(Window.partitionBy("feature"))
    paired = sides.select("*", benign.alias("benign")).filter((F.col(CLASS) != BENIGN) & F.col("benign").isNotNull())
    widest = F.greatest(F.col("benign.range"), F.col("range"))
    apart = F.abs(F.col("median") - F.col("benign.median"))
    return paired.select(
        CLASS,
        "feature",
        F.col("benign.median").alias("benign_median"),
        F.col("benign.iqr").alias("benign_iqr"),
        F.col("median").alias("attack_median"),
        F.col("iqr").alias("attack_iqr"),
        "cliff_delta",
        F.when(widest > 0, apart / widest).otherwise(F.lit(0.0)).alias("discrimination"),
    )


def medians_and_bins(
    flows: DataFrame, features: list[str], rows: int, bins: int = BINS
) -> tuple[dict[str, float], dict[str, list[float]]]:
    """Median, and edges of equal-frequency bins with equal edges merged, of each feature with values.

    Bins are those of the median-filled column. One pass serves both for columns without gaps; only
    columns with gaps need a second one.
    """
    probabilities = [i / bins for i in range(bins + 1)]
    found = exact_quantiles(flows, features, [0.5, *probabilities], rows=rows).collect()
    medians = {r.feature: r.q0 for r in found}
    edges = {r.feature: sorted({r[f"q{i + 1}"] for i in range(bins + 1)}) for r in found}
    gaps = [r.feature for r in found if r.n < rows]
    if gaps:
        filled = fill_medians(flows, {f: medians[f] for f in gaps})
        again = exact_quantiles(filled, gaps, probabilities, rows=rows).collect()
        edges.update({r.feature: sorted({r[f"q{i}"] for i in range(bins + 1)}) for r in again})
    return medians, edges


def bin_of(value: Column, edges: list[float]) -> Column:
    """Right-closed bin number; the lowest edge belongs to bin 0."""
    inner = edges[1:-1]
    number = F.lit(len(inner))
    for i in reversed(range(len(inner))):
        number = F.when(value <= F.lit(float(inner[i])), i).otherwise(number)
    return number


def _entropy_term(share: Column) -> Column:
    return -share * F.log2(share + F.lit(1e-10))


def feature_importance(
    flows: DataFrame,
    features: list[str] | None = None,
    rows: int | None = None,
    top: int = TOP_IMPORTANCE,
    min_rows: int = MIN_ROWS_IMPORTANCE,
) -> DataFrame:
    """``attack_type, rank, feature, importance``: mutual information of binned feature and class.

    Classes of fewer than ``min_rows`` rows are left out; ``class_counts`` shows them.

    Bins do not depend on the class, so all classes come from one count per feature, bin and class.
    """
    features = profile_features(flows, features)
    flows = stored_features(flows, features)
    rows = flows.count() if rows is None else rows
    medians, edges = medians_and_bins(flows, features, rows)
    features = [f for f in features if f in medians]
    filled = fill_medians(flows, medians)
    cells = [
        F.struct(F.lit(f).alias("feature"), bin_of(named(f), edges[f]).alias("bin")) for f in features
    ]
    counts = (
        filled.select(CLASS, F.inline(F.array(*cells)))
        .groupBy("feature", "bin", CLASS)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # everything below works on features x bins x classes rows
    per_bin = counts.groupBy("feature", "bin").agg(F.sum("n").alias("in_bin"))
    per_class = (
        counts.filter(F.col(CLASS) != BENIGN)
        .groupBy("feature", CLASS)
        .agg(F.sum("n").alias("in_class"))
        .filter(F.col("in_class") >= min_rows)
    )
    joint = (
        per_bin.join(per_class, "feature")
        .join(counts, ["feature", "bin", CLASS], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
    )
    total = F.lit(float(rows))
    inside, outside = F.col("n") / total, (F.col("in_bin") - F.col("n")) / total
    joint_entropy = F.when(inside > 0, _entropy_term(inside)).otherwise(0.0) + F.when(
        outside > 0, _entropy_term(outside)
    ).otherwise(0.0)
    of_class, of_rest = F.col("in_class") / total, (total - F.col("in_class")) / total
    class_entropy = _entropy_term(of_class) + F.when(of_rest > 0, _entropy_term(of_rest)).otherwise(0.0)
    scored = joint.groupBy("feature", CLASS, "in_class").agg(
        F.sum(_entropy_term(F.col("in_bin") / total)).alias("h_bin"),
        F.sum(joint_entropy).alias("h_joint"),
    )
    information = F.greatest(F.lit(0.0), F.col("h_bin") + class_entropy - F.col("h_joint"))
    # sums of the same terms may differ in the last bits, so ties are decided on 12 digits
    order = Window.partitionBy(CLASS).orderBy(
        F.desc(F.round("importance", 12)), position_of(F.col("feature"), features)
    )
    return (
        scored.withColumn("importance", information)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select(CLASS, "rank", "feature", "importance")
    )


def correlation_matrix(
    flows: DataFrame, features: list[str] | None = None, rows: int | None = None
) -> DataFrame:
    """``feature_1, feature_2, correlation`` (Pearson) over median-filled features, all pairs.

    One distributed pass builds the matrix, whose size depends on the number of features only.
    A constant feature has no correlation (null), also not with itself. Results are rounded to 12 digits,
    because the last ones depend on how the rows were dealt to tasks.
    """
    features = profile_features(flows, features)
    flows = stored_features(flows, features)
    rows = flows.count() if rows is None else rows
    medians = column_medians(flows, features, rows=rows)
    features = [f for f in features if f in medians]
    filled = fill_medians(flows, medians)
    plain = [f"_c{i}" for i in range(len(features))]
    narrow = filled.select(*[named(f).cast("double").alias(p) for f, p in zip(features, plain)])
    vectors = VectorAssembler(inputCols=plain, outputCol="v").transform(narrow).select("v")
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    # the library reports 1 on the diagonal even for a constant
    flat = narrow.agg(*[(F.min(p) == F.max(p)).alias(p) for p in plain]).first()
    cells = []
    for i, a in enumerate(features):
        for j, b in enumerate(features):
            undefined = flat[i] or flat[j]
            cells.append((a, b, None if undefined else round(float(matrix[i][j]), 12)))
    return flows.sparkSession.createDataFrame(
        cells, "feature_1 string, feature_2 string, correlation double"
    )


def suggested_rule(feature: Column, attack_median: Column, benign_median: Column) -> Column:
    """A rule that flags values outside half to one and a half times the benign median."""
    low = benign_median * 0.5
    high = F.when(benign_median > 0, benign_median * 1.5).otherwise(F.lit(1.0))
    return (
        F.when(attack_median > high, F.format_string("%s > %.2f", feature, high))
        .when(attack_median < low, F.format_string("%s < %.2f", feature, low))
        .otherwise(F.concat(feature, F.lit(IN_DISTRIBUTION)))
    )


def attribute_table(
    flows: DataFrame,
    statistics: DataFrame,
    tree_metrics: DataFrame | None = None,
    features: list[str] | None = None,
) -> DataFrame:
    """One row per attack class: key features, ranges, suggested rule, support and tree quality.

    With ``tree_metrics`` (``attack_type, precision, recall``) only classes that have a tree appear.
    """
    features = profile_features(flows, features)
    order = Window.partitionBy(CLASS).orderBy(
        F.desc("discrimination"), position_of(F.col("feature"), features)
    )
    ranked = statistics.withColumn("place", F.row_number().over(order)).filter("place <= 3")
    best = F.col("place") == 1
    columns = ("feature", "benign_median", "benign_iqr", "attack_median", "attack_iqr")
    # at most three rows per class are gathered
    top = ranked.groupBy(CLASS).agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("place", "feature"))), lambda s: s["feature"]
            ),
            ", ",
        ).alias("key_features"),
        *[F.max(F.when(best, F.col(c))).alias(c) for c in columns],
    )
    per_class = flows.groupBy(CLASS).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))) * 100
    support = per_class.select(CLASS, share.alias("support_percent")).filter(F.col(CLASS) != BENIGN)
    span = F.format_string
    table = support
    if tree_metrics is not None:
        table = table.join(
            tree_metrics.select(
                CLASS,
                F.col("precision").alias("rule_precision"),
                F.col("recall").alias("rule_recall"),
            ),
            CLASS,
        )
    table = table.join(top, CLASS, "left")
    rule = suggested_rule(F.col("feature"), F.col("attack_median"), F.col("benign_median"))
    missing = F.col("feature").isNull()
    out = [
        F.col(CLASS),
        F.coalesce("key_features", F.lit("")).alias("key_features"),
        F.when(missing, NO_RANGE)
        .otherwise(span("%.0f±%.0f", "benign_median", "benign_iqr"))
        .alias("benign_range"),
        F.when(missing, NO_RANGE)
        .otherwise(span("%.0f±%.0f", "attack_median", "attack_iqr"))
        .alias("attack_range"),
        F.when(missing, NO_FEATURES).otherwise(rule).alias("suggested_rule"),
        F.col("support_percent"),
    ]
    if tree_metrics is not None:
        out += [F.col("rule_precision"), F.col("rule_recall")]
    return table.select(*out)
