"""Decision → cost rule → monthly savings (the predictive-maintenance savings analysis)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cost of a correct decision per maintenance type. "cost" means the
# recorded cost of the event; a number is a fixed amount. A wrong decision
# always costs the recorded cost.
DEFAULT_RULE: dict[str, object] = {"Healthy": 0, "Preventive": "cost", "Corrective": 30000}


def predicted_cost(actual: str, predicted: str, cost: str, rule: dict[str, object] | None = None) -> Column:
    """Rule table as a CASE expression (no Python UDF)."""
    rule = rule or DEFAULT_RULE
    a, p, c = F.col(actual), F.col(predicted), F.col(cost)
    inner = None
    for label, val in rule.items():
        v = c if val == "cost" else F.lit(val)
        inner = F.when(a == label, v) if inner is None else inner.when(a == label, v)
    return F.when(a == p, inner).otherwise(c)


def monthly_savings(df: DataFrame, date: str = "date", cost: str = "cost", actual: str = "maintenance_type",
                    predicted: str = "predicted_type", rule: dict[str, object] | None = None) -> DataFrame:
    """Per ``yyyyMM`` month: actual cost, cost under the model's decisions, savings."""
    x = df.select(date, cost, predicted_cost(actual, predicted, cost, rule).alias("_pc"))
    return (x.groupBy(F.date_format(date, "yyyyMM").alias("month"))
            .agg(F.sum(cost).cast("long").alias("actual_cost"), F.sum("_pc").cast("long").alias("predicted_cost"),
                 F.sum(F.col(cost) - F.col("_pc")).cast("long").alias("predicted_savings")))


def total_savings(monthly: DataFrame) -> DataFrame:
    """Grand total of savings and its percentage of the actual cost."""
    return (monthly.agg(F.sum("actual_cost").alias("_tc"), F.sum("predicted_savings").alias("total_savings"))
            .select(F.col("total_savings").cast("long").alias("total_savings"),
                    (F.col("total_savings") / F.col("_tc") * 100).alias("total_savings_pct")))
