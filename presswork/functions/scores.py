"""From class scores to labels."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(scores: Column) -> Column:
    """0-based index of the highest score; the lowest index wins a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def _names(labels: Sequence[str]) -> Column:
    return F.expr("array(" + ", ".join(f"'{name}'" for name in labels) + ")")


def label_of(index: Column, labels: Sequence[str]) -> Column:
    """Name of a class index, null for a null index (which element_at over literals is not)."""
    return F.get(_names(labels), index)


def class_sums(weights: str, n_labels: int) -> Column:
    """Aggregate: array with the sum of each element of an array column."""
    sums = [f"coalesce(sum({weights}[{i}]), 0L)" for i in range(n_labels)]
    return F.expr(f"array({', '.join(sums)})")


def label_votes(label: str, labels: Sequence[str]) -> Column:
    """Aggregate: array with the number of rows of each label, labels in name order.

    Plain counters keep the vote in a hash aggregate, whatever the number of articles.
    """
    counts = [f"count_if({label} = '{name}')" for name in sorted(labels)]
    return F.expr(f"array({', '.join(counts)})")


def elected(votes: Column, labels: Sequence[str]) -> Column:
    """Label with most votes, the smallest name on a tie; null when there are no votes."""
    return F.when(F.array_max(votes) > 0, label_of(argmax(votes), sorted(labels)))
