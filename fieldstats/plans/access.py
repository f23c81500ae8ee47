"""Who may see each account."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstats.operators.lists import distinct_lists
from fieldstats.operators.lookup import cross_one_row
from fieldstats.params import JobParams

# Each leading role with the roles listed under it.
SUBORDINATES = {
    "csd": ("csr", "csm", "cta", "ssm"),
    "cvp": ("csd",),
    "asd": ("asm",),
    "avp": ("asd",),
}


LISTS = max(len(roles) for roles in SUBORDINATES.values())


def role_lists(tables: Mapping[str, DataFrame], params: JobParams) -> DataFrame:
    """One row per leading role and member: ``level``, ``role_key`` and the array ``lists``.

    All levels come from one pass over the team rows. The key holds level and member
    in one text, so each of the four lookups reads the same frame and Spark computes
    it once.
    """
    accounts = tables["account"].where(
        (F.col("recordtype") == params.record_type) & (F.col("capitalregion") == params.region)
    )
    team = tables["account_team"].join(accounts.select("accountguid"), "accountguid")
    members = []
    for level, roles in SUBORDINATES.items():
        listed = [F.col(f"{role}networkid") for role in roles] + [F.lit(None)] * (LISTS - len(roles))
        members.append(
            F.struct(
                F.lit(level).alias("level"),
                F.col(f"{level}networkid").cast("string").alias("member"),
                *[c.cast("string").alias(f"list{i}") for i, c in enumerate(listed)],
            )
        )
    rows = team.select(F.explode(F.array(*members)).alias("row")).select("row.*").where(F.col("member").isNotNull())
    names = [f"list{i}" for i in range(LISTS)]
    return distinct_lists(rows, ["level", "member"], {name: name for name in names}).select(
        "level", F.concat_ws(":", "level", "member").alias("role_key"), F.array(*names).alias("lists")
    )


def _parts(level: str, lists: Column) -> list[Column]:
    """The lists of a level; a missing one is an empty slot."""
    return [F.coalesce(lists[i], F.lit("")) for i in range(len(SUBORDINATES[level]))]


def everyone(lists: DataFrame, separator: str = "") -> DataFrame:
    """One row: the list of all role lists.

    Neighbouring lists run together unless a separator is given.
    """
    listed = F.col("lists")[0]
    for level, roles in SUBORDINATES.items():
        if len(roles) > 1:
            whole = F.concat_ws(", ", *_parts(level, F.col("lists")))
            listed = F.when(F.col("level") == level, whole).otherwise(listed)
    per_level = distinct_lists(lists.select("level", listed.alias("listed")), ["level"], {"listed": "listed"}, separator)
    return distinct_lists(per_level, [], {"ALLUSERS": "listed"}, separator)


def access_list(tables: Mapping[str, DataFrame], params: JobParams, separator: str = "") -> DataFrame:
    """One row per account and team row, with everyone above or beside it."""
    lists = role_lists(tables, params)
    accounts = tables["account"].where(F.col("recordtype") == params.record_type)
    team = tables["account_team"].select("accountguid", *[f"{level}networkid" for level in SUBORDINATES])
    rows = accounts.select("accountid", "accountguid").join(team, "accountguid", "left")
    parts = []
    for level in SUBORDINATES:
        found = lists.select(F.col("role_key").alias(f"{level}_key"), F.col("lists").alias(f"{level}_lists"))
        key = F.concat(F.lit(f"{level}:"), F.col(f"{level}networkid"))
        rows = rows.join(found, key == F.col(f"{level}_key"), "left")
        parts += _parts(level, F.col(f"{level}_lists"))
    rows = cross_one_row(rows, everyone(lists, separator))
    return rows.select("accountid", "accountguid", "ALLUSERS", F.concat_ws(", ", *parts).alias("WHOCANACCESS"))


def access_list_region(tables: Mapping[str, DataFrame], params: JobParams, separator: str = "") -> DataFrame:
    """As ``access_list``, limited to one region, with the account's own roles."""
    accounts = tables["account"].where(
        (F.col("recordtype") == params.record_type) & (F.col("clinicalregion") == params.region)
    )
    rows = accounts.join(tables["account_team"].select("accountguid"), "accountguid", "left")
    rows = cross_one_row(rows, everyone(role_lists(tables, params), separator))
    return rows.select("accountid", "accountguid", "ALLUSERS", "csdnetworkid", "csmnetworkid", "csrnetworkid")


def _led(tables: Mapping[str, DataFrame], params: JobParams) -> DataFrame:
    """(level, leader, role, networkid): each person listed under a leader, from the region's team rows, once."""
    accounts = tables["account"].where(
        (F.col("recordtype") == params.record_type) & (F.col("capitalregion") == params.region)
    )
    team = tables["account_team"].join(accounts.select("accountguid"), "accountguid")
    pairs = [
        F.struct(
            F.lit(level).alias("level"),
            F.col(f"{level}networkid").cast("string").alias("leader"),
            F.lit(role).alias("role"),
            F.col(f"{role}networkid").cast("string").alias("networkid"),
        )
        for level, roles in SUBORDINATES.items()
        for role in roles
    ]
    led = team.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    return led.where(F.col("leader").isNotNull() & F.col("networkid").isNotNull()).distinct()


def access_rows(tables: Mapping[str, DataFrame], params: JobParams) -> DataFrame:
    """Who may see each account, as rows: (accountid, accountguid, level, role, networkid).

    The row form of ``access_list``'s WHOCANACCESS: every person listed under one of the
    account's leaders, once per account. No list of a level is built as one text, so no task
    holds more than the persons of one leader; the text is joined, if at all, by the reader.
    """
    accounts = tables["account"].where(F.col("recordtype") == params.record_type).select("accountid", "accountguid")
    leaders = tables["account_team"].select(
        "accountguid",
        F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.col(f"{level}networkid").cast("string").alias("leader")) for level in SUBORDINATES])).alias("l"),
    ).select("accountguid", "l.*")
    rows = accounts.join(leaders, "accountguid").join(_led(tables, params), ["level", "leader"])
    return rows.select("accountid", "accountguid", "level", "role", "networkid").distinct()


def access_users(tables: Mapping[str, DataFrame], params: JobParams) -> DataFrame:
    """ALLUSERS as a table: (level, role, networkid) of every person listed under any leader."""
    return _led(tables, params).select("level", "role", "networkid").distinct()
