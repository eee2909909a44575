"""The case schema, the structs inside its cells, and small dimensions.

The words, codes and names in this module are fixed values of the data: results have to show them as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The columns of a case row, in order.
CASE_COLUMNS = (
    "partyName", "caseNumber", "courtNumber", "registrationDate", "nextListingDate", "respondent", "otherRespondent", "respondentAdvocate", "petitioner", "otherPetitioner",
    "petitionerAdvocate", "location", "courtType", "benchName", "caseType", "caseStatus", "uniqueness", "listingHistory", "applicationDetails", "status",
)
CASE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CASE_COLUMNS])

PARTY_FIELDS = ("respondent", "otherRespondent", "petitioner", "otherPetitioner")
ADVOCATE_FIELDS = ("respondentAdvocate", "petitionerAdvocate")
HISTORY_FIELDS = ("listingHistory", "applicationDetails", "orderHistory", "applicationHistory")
PRIMARY_FIELDS = ("caseNumber", "respondent", "petitioner", "caseType", "registrationDate")
KEY_FIELDS = ("uniqueness", "courtType", "benchName", "caseNumber", "registrationDate")

DATE_PARTS = "struct<day:int,month:int,year:int>"
HEARING = "struct<date:string,purpose:string,judge:string,orderUrl:string>"
ORDER_HEARING = "struct<date:string,purpose:string,orderDetail:struct<url:string>,actionTaken:string,encPath:string>"
TRIBUNAL_HEARING = f"struct<date:{DATE_PARTS},purpose:string>"
MATCH = "struct<matched:boolean,score:int,method:string,candidate:string,variant:string>"

# The three-letter months, in order.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
# The full months, in order.
FULL_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

# The sources, the result cell each reports to, and the order in which they run.
SOURCES = ("drt", "drat", "nclt", "ncdrc", "scdrc", "dcdrc", "high_court", "district_court", "supreme_court")
SOURCE_KEYWORDS = {
    "drt": ("DRT",), "drat": ("DRAT",), "nclt": ("NCLT",), "ncdrc": ("NCDRC",), "scdrc": ("SCDRC",), "dcdrc": ("DCDRC",),
    "high_court": ("HIGH_COURT", "HIGH COURT"), "district_court": ("DISTRICT_COURT", "DISTRICT COURT"), "supreme_court": ("SUPREME_COURT", "SUPREME COURT"),
}

# The benches of the company tribunal as (id, name, short name).
NCLT_BENCHES = (
    (10, "Principal Bench / New Delhi Bench", "New Delhi"), (9, "Mumbai Bench", "Mumbai"), (13, "Cuttack Bench", "Cuttack"), (1, "Ahmedabad Bench", "Ahmedabad"),
    (12, "Amaravati Bench", "Amaravati"), (4, "Chandigarh Bench", "Chandigarh"), (8, "Kolkata Bench", "Kolkata"), (11, "Jaipur Bench", "Jaipur"),
    (3, "Bengaluru Bench", "Bengaluru"), (5, "Chennai Bench", "Chennai"), (6, "Guwahati Bench", "Guwahati"), (7, "Hyderabad Bench", "Hyderabad"),
    (14, "Kochi Bench", "Kochi"), (15, "Indore Bench", "Indore"), (2, "Allahabad Bench", "Allahabad"),
)
NCLT_PARTY_TYPES = (("P", "Petitioner"), ("R", "Respondent"))
NCLT_STATUSES = (("P", "Pending"), ("D", "Disposed"))
# Fragments of bench locations and the bench each means; the first that is contained counts.
BENCH_FRAGMENTS = (
    ("new delhi", "New Delhi"), ("principal bench", "New Delhi"), ("mumbai", "Mumbai"), ("cuttack", "Cuttack"), ("ahmedabad", "Ahmedabad"), ("amaravati", "Amaravati"),
    ("chandigarh", "Chandigarh"), ("kolkata", "Kolkata"), ("jaipur", "Jaipur"), ("bengaluru", "Bengaluru"), ("bangalore", "Bengaluru"), ("chennai", "Chennai"),
    ("guwahati", "Guwahati"), ("hyderabad", "Hyderabad"), ("kochi", "Kochi"), ("indore", "Indore"), ("allahabad", "Allahabad"),
)
# Codes of the supreme court's case types and their prefixes.
SC_TYPE_SLUGS = {
    "1": "SLP(C)", "2": "SLP(CRL)", "3": "CA", "4": "CRCASE", "5": "WP(C)", "6": "WP(CRL)", "7": "TP(C)", "8": "TP(CRL)", "9": "RP(C)", "10": "RP(CRL)", "11": "TC(C)", "12": "TC(CRL)",
    "17": "OS", "18": "DRC", "19": "CONT(C)", "20": "CONT(CRL)", "21": "TRC", "22": "SRC", "23": "EP(C)", "24": "ARB.P.", "25": "CUR(C)", "26": "CUR(CRL)", "31": "DIARY", "39": "MISC.",
}
# The tabs of a supreme court case.
SC_TABS = ("case_details", "listing_dates", "interlocutory_application_documents", "court_fees", "notices", "defects", "judgement_orders", "earlier_court_details", "similarities")
SC_REQUIRED_TABS = ("case_details", "listing_dates", "interlocutory_application_documents", "judgement_orders")
# The states of the consumer commissions as (id, name).
CONSUMER_STATES = (
    (11350000, "ANDAMAN NICOBAR"), (11280000, "ANDHRA PRADESH"), (11120000, "ARUNACHAL PRADESH"), (11180000, "ASSAM"), (11100000, "BIHAR"), (11040000, "CHANDIGARH"),
    (11220000, "CHHATTISGARH"), (11380000, "DADRA AND NAGAR HAVELI AND DAMAN AND DIU"), (11070000, "DELHI"), (11300000, "GOA"), (11240000, "GUJARAT"), (11060000, "HARYANA"),
    (11020000, "HIMACHAL PRADESH"), (11010000, "J AND K"), (11200000, "JHARKHAND"), (11290000, "KARNATAKA"), (11320000, "KERALA"), (11370000, "LADAKH"), (11310000, "LAKSHADWEEP"),
    (11230000, "MADHYA PRADESH"), (11270000, "MAHARASHTRA"), (11140000, "MANIPUR"), (11170000, "MEGHALAYA"), (11150000, "MIZORAM"), (11130000, "NAGALAND"), (11210000, "ODISHA"),
    (11340000, "PONDICHERRY"), (11030000, "PUNJAB"), (11080000, "RAJASTHAN"), (11110000, "SIKKIM"), (11330000, "TAMIL NADU"), (11360000, "TELANGANA"), (11160000, "TRIPURA"),
    (11050000, "UTTARAKHAND"), (11090000, "UTTAR PRADESH"), (11190000, "WEST BENGAL"),
)


def dimension(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small fixed table in one partition, with the rows' order as ``ord``."""
    kinds = T.StructType([T.StructField("ord", T.IntegerType()), *T.StructType.fromDDL(schema).fields])
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], kinds).coalesce(1)
