"""The breakdown of players named by fragment or id, read from published tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.scalars import norm_name
from tallywright.plans import specs as sp
from tallywright.plans.profile import ID, union_all


def find_players(players: DataFrame, query: str) -> DataFrame:
    """Players whose accent-free full name holds the fragment; digits mean an id."""
    if query.isdigit():
        return players.where(F.col(ID) == int(query))
    wanted = norm_name(F.lit(query), keep_spaces=True)
    return players.where(norm_name(F.concat_ws(" ", "first_name", "last_name"), keep_spaces=True).contains(wanted))


def breakdown(tables: dict, query: str) -> DataFrame:
    """Long rows ``(player_id, section, field, component, value, z, weight, text)`` of all matches."""
    who = find_players(tables["players"], query).select(ID)

    def of(name):
        return tables[name].join(who, ID, "left_semi")

    def shaped(df, **cols):
        base = {"section": None, "field": None, "component": None, "value": None, "z": None, "weight": None, "text": None}
        kinds = {"section": "string", "field": "string", "component": "string", "text": "string"}
        given = {**base, **cols}
        return df.select(ID, *[(F.lit(None) if v is None else v).cast(kinds.get(k, "double")).alias(k) for k, v in given.items()])

    group = F.create_map(*[F.lit(x) for g, names in sp.ATTRIBUTE_GROUPS.items() for a in names for x in (a, g)])
    ratings = shaped(of("player_attributes"), section=F.element_at(group, F.col("attribute")), field=F.col("attribute"),
                     value=F.col("rating"), z=F.col("score"))
    parts = of("components").join(tables["blend_weights"], ["field", "component"], "left")
    parts = shaped(parts.where(~F.col("field").startswith("trait:")), section=F.element_at(group, F.col("field")), field=F.col("field"),
                   component=F.col("component"), value=F.col("value"), z=F.col("z"), weight=F.col("weight"))
    tend = shaped(of("player_tendencies"), section=F.lit("Tendencies"), field=F.col("tendency"), value=F.col("value"),
                  text=F.concat_ws(" / ", F.col("numerator").cast("string"), F.col("denominator").cast("string")))
    traits = shaped(of("player_traits"), section=F.lit("Traits"), field=F.col("trait"), value=F.col("value"), z=F.col("z_score"),
                    text=F.col("tier_name"))
    return union_all([ratings, parts, tend, traits])
