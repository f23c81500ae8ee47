"""What the large joins send through a shuffle."""

import re
from datetime import date

from fieldstats.plans.procedures import duration_population
from workload.bindings import PARAMS
from workload.products import SNAPSHOT

DAY = date(2000, 2, 3)
ACCOUNT = "accountguid, accountid, accountname, recordtype, capitalregion, customertype, endcustomerstateprovince, parentaccountname, tier1 boolean"
TEAM = "accountguid, asdname, asmname, csdname, csmname, csrname, ssmname"
PROCEDURES = (
    "recordid, casenumber, accountguid, surgeonguid, status, proceduredatelocal date, proceduredurationinseconds long, "
    "installedbaseguid, businesscategoryname, subject, procedurename"
)


def _frame(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(c if " " in c else f"{c} string" for c in columns.split(", ")))


def _tables(spark):
    case = lambda k, account, surgeon, system: (f"r{k}", f"c{k}", account, surgeon, "Completed", DAY, 60, system, "x", "y", "z")
    account = lambda guid, kind: (guid, f"id {guid}", f"name {guid}", kind, "ASIA", "t", "p", "g", True)
    return {
        "procedures": _frame(
            spark,
            PROCEDURES,
            [case(k, "a", "s", "i") for k in range(7)]
            + [case(7, "a", None, None), case(8, "b", "s", "i"), case(9, None, "s", "i"), case(10, "a", "unknown", "none"), case(11, "b", "t", "i")],
        ),
        "account": _frame(spark, ACCOUNT, [account("a", "Hospital"), account("b", "Office"), account(None, "Hospital")]),
        "account_team": _frame(spark, TEAM, [("a", *"uvwxyz")]),
        "contact": _frame(spark, "contactguid, fullname, specialtyname", [("s", "one", "A"), ("s", "two", "B"), ("t", "three", "C"), (None, "none", "D")]),
        "installbase": _frame(spark, "installbaseguid, name, model, financeinstalleddate date", [("i", "n", "m", DAY), (None, "n", "m", DAY)]),
    }


def test_durations_with_null_and_repeated_keys(spark):
    got = duration_population(spark, _tables(spark), PARAMS, SNAPSHOT)
    got = got.select("ProcedureGUID", "SurgeonName", "SurgeonPopulation", "`SurgeonPopulation (Runrate)`", "Model", "AccountName").collect()
    want = [(f"r{k}", name, "Bubble", "Bubble", "m", "name a") for k in range(7) for name in ("one", "two")]
    want += [("r7", None, None, None, None, "name a"), ("r10", None, "Dabbler", "Dabbler", None, "name a")]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_no_join_of_durations_shuffles_the_account_columns_of_procedures(spark, plan):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        text = plan(duration_population(spark, _tables(spark), PARAMS, SNAPSHOT))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    sent = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning", text)
    rows = [x for x in sent if "casenumber#" in x]
    assert len(rows) == 3, "by surgeon and quarter, by system, by account"
    assert not [x for x in rows if "accountname#" in x]
