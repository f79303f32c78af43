"""Tags of cards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.operators.merge import replace_children

CARD_TAG = "ORACLE_CARD_TAG"


def tag_rows(responses: DataFrame, key: str) -> DataFrame:
    """(key, tag_name) of the taggings that are about the card itself."""
    names = F.transform(F.filter("taggings", lambda t: t["tag"]["type"] == CARD_TAG), lambda t: t["tag"]["name"])
    return responses.select(key, F.explode(names).alias("tag_name")).filter("tag_name is not null")


def answered(responses: DataFrame, work_list: DataFrame) -> DataFrame:
    """(card_id, taggings): responses back at the cards whose printing was asked for."""
    asked = work_list.select("card_id", "set_code", "collector_number")
    return responses.join(asked, ["set_code", "collector_number"]).select("card_id", "taggings")


def merge_tags(target: DataFrame, stage: DataFrame, key: str, replace: bool = False) -> DataFrame:
    """Adds the tags that are new, or replaces all tags of the cards in ``stage``; a
    card without a tag in ``stage`` keeps its tags in either case."""
    new = stage.select(key, "tag_name").distinct()
    if replace:
        return replace_children(target, new, key)
    return target.unionByName(new.join(target, [key, "tag_name"], "left_anti").select(*target.columns))
