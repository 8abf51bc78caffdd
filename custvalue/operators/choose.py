"""Choice of inputs by mutual information with the label, less what chosen inputs tell already.

All columns are binned, and one pass counts the joint bins of every pair of them; inputs, label
and pairs of inputs alike. From then on the work is that of the histograms, whatever the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 12
#: Differences below this are ties, which go to the first by name.
DIGITS = 9
#: Share of an input's entropy that makes another one its like.
TOLD = 0.95


def _scale(x: Column) -> Column:
    return F.signum(x) * F.ln(1 + F.abs(x))


def joint_counts(rows: DataFrame, names: list[str], bins: int = BINS) -> DataFrame:
    """left, right, left_bin, right_bin and n for all pairs of columns, also with themselves.

    Bins are even between the least and largest value on a logarithmic scale to both sides of
    zero; a null has a bin of its own.
    """
    scaled = rows.select(*(_scale(F.col(c).cast("double")).alias(c) for c in names))
    head = scaled.agg(*(f(c).alias(f"{k}_{c}") for c in names for k, f in (("low", F.min), ("high", F.max)))).first()

    def bin_of(c: str) -> Column:
        low, high = head[f"low_{c}"], head[f"high_{c}"]
        if low is None or not high > low:
            return F.when(F.col(c).isNull(), -1).otherwise(0)
        place = F.floor((F.col(c) - F.lit(low)) / F.lit(high - low) * bins)
        # A null is greater than nothing, so it is told first.
        return F.when(F.col(c).isNull(), -1).otherwise(F.least(F.lit(bins - 1), place)).cast("int")

    pairs = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), bin_of(a).alias("left_bin"), bin_of(b).alias("right_bin"))
        for i, a in enumerate(names)
        for b in names[i:]
    ]
    keys = ["left", "right", "left_bin", "right_bin"]
    return scaled.select(F.inline(F.array(*pairs))).groupBy(*keys).agg(F.count("*").alias("n"))


def mutual_information(counts: DataFrame) -> DataFrame:
    """left, right and information, in nats, of every pair; the entropy for a column with itself."""
    pair = ["left", "right"]
    total = counts.groupBy(*pair).agg(F.sum("n").alias("all_n"))
    lefts = counts.groupBy(*pair, "left_bin").agg(F.sum("n").alias("left_n"))
    rights = counts.groupBy(*pair, "right_bin").agg(F.sum("n").alias("right_n"))
    joined = counts.join(lefts, [*pair, "left_bin"]).join(rights, [*pair, "right_bin"]).join(total, pair)
    share = F.col("n") / F.col("all_n")
    term = share * F.ln(share / (F.col("left_n") / F.col("all_n") * (F.col("right_n") / F.col("all_n"))))
    return joined.groupBy(*pair).agg(F.sum(term).alias("information"))


def ranked(information: DataFrame, inputs: list[str], label: str) -> list[tuple[str, float, float, float]]:
    """Inputs in the order in which they are chosen: name, relevance, redundancy and their difference.

    The next one has the most information on the label less its mean information on those chosen.
    The driver holds a number for each pair of columns.
    """
    known = {}
    for row in information.collect():
        known[row["left"], row["right"]] = known[row["right"], row["left"]] = row["information"]
    chosen: list[tuple[str, float, float, float]] = []
    left = sorted(inputs)
    while left:
        scores = {}
        for name in left:
            redundancy = sum(known[name, c[0]] for c in chosen) / len(chosen) if chosen else 0.0
            relevance = known[name, label]
            scores[name] = (relevance, redundancy, relevance - redundancy)
        best = max(left, key=lambda n: round(scores[n][2], DIGITS))
        chosen.append((best, *scores[best]))
        left.remove(best)
    return chosen


def choose(rows: DataFrame, inputs: list[str], label: str, bins: int = BINS) -> list[str]:
    """Inputs in their order, without those that tell nothing beyond what chosen ones told.

    That is one whose information on the label is not above its mean information on those before
    it, or of whose entropy one of them tells nearly all (``TOLD``).
    """
    table = mutual_information(joint_counts(rows, [*inputs, label], bins))
    known = {}
    for row in table.collect():
        known[row["left"], row["right"]] = known[row["right"], row["left"]] = row["information"]
    chosen: list[str] = []
    for name, _, _, gain in ranked(table, inputs, label):
        told = any(known[name, c] >= TOLD * known[name, name] for c in chosen)
        if not chosen or gain > 0 and not told:
            chosen.append(name)
    return chosen
