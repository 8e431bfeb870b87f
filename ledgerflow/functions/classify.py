"""Classification rules; the first that matches holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.schemas import OFFICES, PARTIES

# The patterns that tell organisations and persons apart.
ORGANIZATION = [
    r"\b(INC|LLC|LLP|CORP|CORPORATION|CO\.?|COMPANY|LIMITED|LTD)\b",
    r"\b(PAC|COMMITTEE|FUND|FOUNDATION|TRUST|ASSOCIATION|SOCIETY)\b",
    r"\b(PARTNERS|GROUP|HOLDINGS|CAPITAL|VENTURES|MANAGEMENT)\b",
    r"\b(UNION|COUNCIL|FEDERATION|COALITION|ALLIANCE)\b",
]
CONDUIT = [r"^WINRED", r"^ACTBLUE", r"EARMARK|CONDUIT"]
PERSON = [r"\b(MR|MRS|MS|DR|MD|PHD|JR|SR|III|IV)\b", r"^[A-Z]+\s+[A-Z]+$", r",\s*[A-Z]+$"]
OCCUPATION = [
    r"\b(RETIRED|HOMEMAKER|ATTORNEY|LAWYER|PHYSICIAN|DOCTOR|PROFESSOR)\b",
    r"\b(ENGINEER|CONSULTANT|EXECUTIVE|PRESIDENT|CEO|CFO|VP)\b",
    r"\b(TEACHER|EDUCATOR|NURSE|ACCOUNTANT|DENTIST|PHARMACIST)\b",
    r"\b(NOT EMPLOYED|UNEMPLOYED|STUDENT|SELF[\s-]EMPLOYED)\b",
]
SELF_EMPLOYER = r"\b(SELF[\s-]EMPLOYED|RETIRED|NOT EMPLOYED|UNEMPLOYED|N/A|NONE)\b"


def terminal_type(cmte_tp: Column, org_tp: Column) -> Column:
    tp, org = F.coalesce(cmte_tp, F.lit("")), F.coalesce(org_tp, F.lit(""))
    orgs = {"C": "corporation", "T": "trade_association", "L": "labor_union", "M": "ideological", "W": "corporation", "V": "cooperative"}
    out = F.when(tp.isin("X", "Y", "Z", "V"), "passthrough").when(tp.isin("H", "S", "P"), "campaign")
    for code, kind in orgs.items():
        out = out.when(org == code, kind)
    return out.when(tp.isin("O", "U"), "super_pac_unclassified").when(tp.isin("N", "Q", "W"), "passthrough").otherwise("unknown")


def donor_type(name: Column, employer: Column, occupation: Column | None = None) -> Column:
    n, e = F.upper(F.coalesce(name, F.lit(""))), F.upper(F.coalesce(employer, F.lit("")))
    job = F.lit("") if occupation is None else F.upper(F.coalesce(occupation, F.lit("")))
    some = lambda c, patterns: c.rlike("|".join(f"(?:{p})" for p in patterns))
    return (
        F.when(n == "", "unclear").when(some(n, CONDUIT), "conduit").when(some(n, ORGANIZATION), "organization")
        .when(some(n, PERSON) | some(job, OCCUPATION) | e.rlike(SELF_EMPLOYER), "individual")
        .when(n.contains(",") | (F.size(F.split(n, " ")) >= 2), "likely_individual").otherwise("unclear")
    )


def whale_tier(total: Column) -> Column:
    return F.when(total >= 1_000_000, "ultra").when(total >= 500_000, "mega").when(total >= 100_000, "whale").when(total >= 50_000, "notable")


def lean(dem: Column, rep: Column, total: Column) -> Column:
    """Whether gifts lean to one of two parties: half as much again as to the other."""
    return F.when(total <= 0, "UNKNOWN").when(dem > 1.5 * rep, "DEM").when(rep > 1.5 * dem, "REP").otherwise("MIXED")


def _lookup(c: Column, names: dict[str, str], other: Column) -> Column:
    out = other
    for code, name in reversed(names.items()):
        out = F.when(c == code, name).otherwise(out)
    return out


def office_name(c: Column) -> Column:
    """Unknown for any other code and for none."""
    return _lookup(c, OFFICES, F.lit("Unknown"))


def party_name(c: Column) -> Column:
    """Another code stands for itself; Unknown where there is none."""
    return _lookup(c, PARTIES, F.when(F.coalesce(c, F.lit("")) == "", "Unknown").otherwise(c))


def is_super_pac(cmte_tp: Column) -> Column:
    return F.coalesce(cmte_tp.isin("I", "O", "U"), F.lit(False))


def is_campaign(cmte_tp: Column) -> Column:
    return F.coalesce(cmte_tp.isin("H", "S", "P"), F.lit(False))


def is_principal_committee(dsgn: Column) -> Column:
    return F.coalesce(dsgn == "P", F.lit(False))


def is_authorized(dsgn: Column) -> Column:
    return F.coalesce(dsgn.isin("P", "A"), F.lit(False))
