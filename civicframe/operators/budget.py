"""Budget lines by version of the plan: which version counted for an item on its day, and the publication of all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.operators.linkage import as_of
from civicframe.store import stored


def plan_of_items(references: DataFrame, plans: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows (code, item, plan, other_plan) of ``references`` (code, item, day): the plan whose line counts for the item.

    ``plans`` (plan, valid_from) are numbered in the order of their page; the plan of an item is the latest that was valid on its day, the earliest
    if none was or the day is unknown, of plans of one day the first. ``versions`` (plan, code) tells which plans have a code: if
    the item's plan lacks it, the first plan that has it counts, and ``other_plan`` says so. Codes that no plan has go; repeated references count once.
    """
    asked = references.select("code", "item", "day").distinct().withColumn("_all", F.lit(1))
    dated = as_of(asked, plans.withColumn("_all", F.lit(1)), fact_id="item", fact_day="day", version="plan", valid_from="valid_from", keys=["_all"]).select("code", "item", "plan")
    has = versions.select("plan", "code").distinct()
    first = has.groupBy("code").agg(F.min("plan").alias("first_plan"))
    found = dated.join(first, "code").join(has.withColumn("_has", F.lit(True)), ["plan", "code"], "left")
    return found.select("code", "item", F.when(F.col("_has"), F.col("plan")).otherwise(F.col("first_plan")).alias("plan"), F.col("_has").isNull().alias("other_plan"))


def publication(lines: DataFrame, placed: DataFrame) -> DataFrame:
    """One row a code that items refer to: code, line (of the first plan that has it), versions, items.

    ``lines`` has plan, code and a struct ``line``; ``placed`` is :func:`plan_of_items`. Versions and items are counted before they are listed: a
    code has a version a plan at most, and its items are a page's list. A code without lines goes. An item that refers to a code on
    several days is listed once, with the first of its plans that has the code.
    """
    used = lines.join(placed.select("code").distinct(), "code", "left_semi")
    versions = used.groupBy("code").agg(F.min_by("line", "plan").alias("line"), F.sort_array(F.collect_list(F.struct("plan", "line"))).alias("versions"))
    once = placed.groupBy("code", "item").agg(F.min(F.struct("other_plan", "plan")).alias("p")).select("code", "item", "p.plan", "p.other_plan")
    items = once.groupBy("code").agg(F.sort_array(F.collect_list(F.struct("item", "plan", "other_plan"))).alias("items"))
    return versions.join(items, "code")


def publication_json(published: DataFrame) -> Column:
    """A code's publication as a JSON text: its line, the line of each plan, and each item's plan."""
    plan = lambda s: F.struct(s["plan"].cast("string").alias("key"), s["line"].alias("value"))
    item = lambda s: F.struct(s["item"].cast("string").alias("key"), s["plan"].alias("value"))
    other = F.transform(F.filter("items", lambda s: s["other_plan"]), lambda s: s["item"])
    return F.to_json(
        F.struct(
            "code", "line", F.map_from_entries(F.transform("versions", plan)).alias("versions"), F.map_from_entries(F.transform("items", item)).alias("plan_of_item"),
            F.when(F.size(other) > 0, other).alias("from_other_plan"),
        )
    )


def export(published: DataFrame, path: str) -> None:
    """Write the publication as JSON lines."""
    stored(published.select(publication_json(published).alias("value")), "budget").write.mode("overwrite").text(path)
