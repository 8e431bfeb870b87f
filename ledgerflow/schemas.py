"""Fixed schemas of the raw files, the graph registry and code tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The field order of the published bulk files.
_SENDER = (
    "CMTE_ID", "AMNDT_IND", "RPT_TP", "TRANSACTION_PGI", "IMAGE_NUM", "TRANSACTION_TP", "ENTITY_TP", "NAME", "CITY", "STATE", "ZIP_CODE",
    "EMPLOYER", "OCCUPATION", "TRANSACTION_DT", "TRANSACTION_AMT", "OTHER_ID",
)
_FILING = ("TRAN_ID", "FILE_NUM", "MEMO_CD", "MEMO_TEXT", "SUB_ID")
FIELDS = {
    "cn": (
        "CAND_ID", "CAND_NAME", "CAND_PTY_AFFILIATION", "CAND_ELECTION_YR", "CAND_OFFICE_ST", "CAND_OFFICE", "CAND_OFFICE_DISTRICT", "CAND_ICI",
        "CAND_STATUS", "CAND_PCC", "CAND_ST1", "CAND_ST2", "CAND_CITY", "CAND_ST", "CAND_ZIP",
    ),
    "cm": (
        "CMTE_ID", "CMTE_NM", "TRES_NM", "CMTE_ST1", "CMTE_ST2", "CMTE_CITY", "CMTE_ST", "CMTE_ZIP", "CMTE_DSGN", "CMTE_TP",
        "CMTE_PTY_AFFILIATION", "CMTE_FILING_FREQ", "ORG_TP", "CONNECTED_ORG_NM", "CAND_ID",
    ),
    "ccl": ("CAND_ID", "CAND_ELECTION_YR", "FEC_ELECTION_YR", "CMTE_ID", "CMTE_TP", "CMTE_DSGN", "LINKAGE_ID"),
    "indiv": _SENDER + _FILING,
    "oth": _SENDER + _FILING,
    "pas2": (*_SENDER, "CAND_ID", *_FILING),
}

#: The key of each file; a later row with the same key replaces an earlier one.
KEYS = {"cn": ["CAND_ID"], "cm": ["CMTE_ID"], "ccl": ["CAND_ID", "CMTE_ID", "LINKAGE_ID"], "indiv": ["SUB_ID"], "pas2": ["SUB_ID"], "oth": ["SUB_ID"]}

#: Edge name -> (source vertex, destination vertex): the graph's definition.
EDGES = {
    "contributed_to": ("donors", "committees"),
    "transferred_to": ("committees", "committees"),
    "affiliated_with": ("committees", "candidates"),
    "employed_by": ("donors", "employers"),
    "spent_on": ("committees", "candidates"),
}

MONEY, SUM = T.DecimalType(14, 2), T.DecimalType(20, 4)
#: Factors of shared money: an amount of 18 digits times such a factor still fits a decimal.
PART, FACTOR = T.DecimalType(18, 4), T.DecimalType(18, 12)

# Codes and thresholds.
OTH_ENTITIES = ["PAC", "COM", "PTY", "ORG"]
TRANSFER_ENTITIES = ["COM", "PAC", "PTY", "CCM", "ORG"]
IE_TYPES = {"24E": "S", "24A": "O"}
DONOR_THRESHOLD = 10_000
RECEIPTS_THRESHOLD, DONOR_SUMMARY_THRESHOLD = 100_000, 50_000
TERMINAL_ORGS = ["corporation", "labor_union", "trade_association", "cooperative", "ideological"]
FOLLOWED = ["passthrough", "unknown"]
CONDUIT_NAMES = ["WINRED", "ACTBLUE", "EARMARK", "CONDUIT", "UNITEMIZED"]
NOT_EMPLOYERS = ["NOT EMPLOYED", "SELF-EMPLOYED", "SELF EMPLOYED", "RETIRED", "NONE", "N/A"]
IE_NOT_EMPLOYERS = ["RETIRED", "SELF", "SELF-EMPLOYED", "NOT EMPLOYED", "NONE", "N/A", "HOMEMAKER"]
NOT_COMPANIES = [
    "RETIRED", "SELF", "SELF-EMPLOYED", "NOT EMPLOYED", "NONE", "N/A", "HOMEMAKER", "SELF EMPLOYED", "NA", "UNEMPLOYED", "OWNER",
    "INVESTOR", "BUSINESS OWNER", "",
]
OFFICES = {"H": "House", "S": "Senate", "P": "President"}
PARTIES = {"DEM": "Democrat", "REP": "Republican", "IND": "Independent", "LIB": "Libertarian", "GRE": "Green"}


#: What a field holds where its name does not say it.
COMMENTS = {"TRANSACTION_AMT": "number(14,2)", "TRANSACTION_DT": "MMDDYYYY", "CAND_ELECTION_YR": "year", "SUB_ID": "key of a row", "MEMO_CD": "X: not part of totals"}


def raw_schema(kind: str) -> T.StructType:
    """Every field is a string, as in the files."""
    return T.StructType([T.StructField(f, T.StringType(), True, {"comment": COMMENTS[f]} if f in COMMENTS else None) for f in FIELDS[kind]])


def ddl(kind: str, table: str) -> str:
    """The file type as a CREATE TABLE statement with its comments."""
    cols = ",\n  ".join(f.name + " STRING" + (f" COMMENT '{COMMENTS[f.name]}'" if f.name in COMMENTS else "") for f in raw_schema(kind))
    return f"CREATE TABLE {table} (\n  {cols}\n) USING parquet"
