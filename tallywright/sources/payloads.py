"""Nested JSON payloads to typed tables, and the contracts on their columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.scalars import to_num

_SET = "struct<name:string,headers:array<string>,rowSet:array<array<string>>>"
_TWO_LEVEL = ("struct<resultSets:struct<headers:array<struct<columnsToSkip:int,columnSpan:int,"
              "columnNames:array<string>>>,rowSet:array<array<string>>>>")


class MissingColumns(ValueError):
    """A source lacks columns the derivation reads."""


def result_set_rows(df: DataFrame, payload: str) -> DataFrame:
    """One row per result-set row: ``set_name, row_no, headers, row`` beside the other columns.

    Accepts ``resultSets`` as a list or a single object, and ``resultSet``.
    """
    # the outer object is read as raw text once, so only the form it has is parsed
    outer = F.from_json(F.col(payload), "struct<resultSets:string,resultSet:string>")
    text = F.coalesce(outer["resultSets"], outer["resultSet"])
    none = F.raise_error(F.lit("payload has no result sets")).cast(f"array<{_SET}>")
    sets = (F.when(text.isNull(), none).when(text.startswith("["), F.from_json(text, f"array<{_SET}>"))
            .otherwise(F.array(F.from_json(text, _SET))))
    listed = df.withColumn("__sets", sets)
    one = listed.select("*", F.explode("__sets").alias("__set")).drop("__sets", payload)
    return one.select(
        *[c for c in one.columns if c != "__set"], F.col("__set.name").alias("set_name"),
        F.col("__set.headers").alias("headers"),
        F.posexplode("__set.rowSet").alias("row_no", "row"))


def result_set_table(rows: DataFrame, set_name: str, columns: list[str]) -> DataFrame:
    """Named text columns of one result set, found by header position in each payload."""
    wanted = rows.where(F.col("set_name") == set_name)
    keep = [c for c in rows.columns if c not in ("set_name", "headers", "row")]
    cells = []
    for c in columns:
        at = F.array_position("headers", c).cast("int")
        cells.append(F.when(at > 0, F.get("row", at - 1)).otherwise(F.raise_error(
            F.lit(f"{set_name}: header {c} missing")).cast("string")).alias(c))
    return wanted.select(*keep, *cells)


def two_level_names(df: DataFrame, payload: str) -> DataFrame:
    """Flatten a two-level header to ``Zone|Column`` names: adds ``names, row_no, row``."""
    rs = F.from_json(F.col(payload), _TWO_LEVEL)["resultSets"]
    parsed = df.withColumn("__rs", rs).withColumn("__zone", F.col("__rs.headers")[0]).withColumn(
        "__cols", F.col("__rs.headers")[1]["columnNames"])
    skip = F.coalesce(F.col("__zone.columnsToSkip"), F.lit(0))
    span = F.coalesce(F.col("__zone.columnSpan"), F.lit(3))
    zones = F.col("__zone.columnNames")
    grouped = F.flatten(F.transform(zones, lambda z, i: F.transform(
        F.slice("__cols", skip + i * span + 1, span), lambda c: F.concat(z, F.lit("|"), c))))
    names = F.concat(F.slice("__cols", F.lit(1), skip), grouped)
    named = parsed.withColumn("names", names)
    return named.select(*[c for c in df.columns if c != payload], "names",
                        F.posexplode("__rs.rowSet").alias("row_no", "row"))


def two_level_table(rows: DataFrame, columns: list[str]) -> DataFrame:
    keep = [c for c in rows.columns if c not in ("names", "row")]
    return rows.select(*keep, *[F.get("row", F.array_position("names", c).cast("int") - 1).alias(c)
                                for c in columns])


# The keys of one logged action, both dialects together.
ACTION_FIELDS = {
    "actionNumber": "bigint", "clock": "string", "period": "int", "teamId": "bigint",
    "personId": "bigint", "playerName": "string", "playerNameI": "string", "actionType": "string",
    "subType": "string", "descriptor": "string", "description": "string", "shotResult": "string",
    "isFieldGoal": "int", "shotValue": "int", "shotDistance": "double", "assistPersonId": "bigint",
    "blockPersonId": "bigint", "foulDrawnPersonId": "bigint", "possession": "bigint",
}


def read_actions(df: DataFrame, payload: str, fields: dict[str, str] | None = None) -> DataFrame:
    """Explode ``game.actions`` (or a bare ``actions`` list); keys an action lacks are NULL.

    ``ord`` is the position in the log, the only order the walk relies on.
    """
    f = fields or ACTION_FIELDS
    one = "array<struct<" + ",".join(f"`{k}`:{t}" for k, t in f.items()) + ">>"
    shape = f"struct<game:struct<actions:{one}>,actions:{one}>"
    parsed = F.from_json(F.col(payload), shape)
    listed = df.withColumn("__a", F.coalesce(parsed["game"]["actions"], parsed["actions"]))
    keep = [c for c in df.columns if c != payload]
    return listed.select(*keep, F.posexplode("__a").alias("ord", "__x")).select(*keep, "ord", "__x.*")


def require_columns(df: DataFrame, source: str, columns: list[str]) -> DataFrame:
    """The frame itself, or an error naming the source and what it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"{source}: missing columns {missing}; available: {df.columns}")
    return df


def union_tagged(frames: dict, tag: str) -> DataFrame:
    """Union by name, each source marked with its key in ``tag``."""
    tagged = [df.withColumn(tag, F.lit(key)) for key, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def prefer_source(primary: DataFrame, backup: DataFrame, key: list[str], origin: str = "origin",
                  names=("primary", "backup")) -> DataFrame:
    """All rows of the primary source, and the backup's rows for keys the primary lacks."""
    have = primary.select(*key).distinct()
    rest = backup.join(have, key, "left_anti").withColumn(origin, F.lit(names[1]))
    return primary.withColumn(origin, F.lit(names[0])).unionByName(rest, allowMissingColumns=True)


def pick_columns(df: DataFrame, source: str, options: list[tuple], names: tuple) -> DataFrame:
    """Rename the first option that is present in full to ``names``; other columns stay."""
    for option in options:
        if all(c in df.columns for c in option):
            other = [c for c in df.columns if c not in option]
            return df.select(*other, *[F.col(c).alias(n) for c, n in zip(option, names)])
    raise MissingColumns(f"{source}: none of {options} in {df.columns}")


def optional_source(df: DataFrame, extra: DataFrame | None, key: list[str], values: dict) -> DataFrame:
    """Left join an optional source; its absence gives the defaults, never an error."""
    if extra is None:
        return df.select("*", *[F.lit(v).alias(c) for c, v in values.items()])
    joined = df.join(extra.select(*key, *[F.col(c).alias(f"__{c}") for c in values]), key, "left")
    for c, v in values.items():
        joined = joined.withColumn(c, F.coalesce(F.col(f"__{c}"), F.lit(v))).drop(f"__{c}")
    return joined


def numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[to_num(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
