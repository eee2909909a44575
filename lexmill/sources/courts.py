"""The courts and case types that searches go over, as small tables.

The codes and names in this module are fixed values of the data, in their own order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.operators.shard import grid, years
from lexmill.schema import CONSUMER_STATES, NCLT_BENCHES, dimension

# States of the district courts as (code, name).
DISTRICT_STATES = (
    ("28", "Andaman and Nicobar"), ("2", "Andhra Pradesh"), ("36", "Arunachal Pradesh"), ("6", "Assam"), ("8", "Bihar"), ("27", "Chandigarh"), ("18", "Chhattisgarh"), ("26", "Delhi"), ("30", "Goa"),
    ("17", "Gujarat"), ("14", "Haryana"), ("5", "Himachal Pradesh"), ("12", "Jammu and Kashmir"), ("7", "Jharkhand"), ("3", "Karnataka"), ("4", "Kerala"), ("33", "Ladakh"), ("37", "Lakshadweep"),
    ("23", "Madhya Pradesh"), ("1", "Maharashtra"), ("25", "Manipur"), ("21", "Meghalaya"), ("19", "Mizoram"), ("34", "Nagaland"), ("11", "Odisha"), ("35", "Puducherry"), ("22", "Punjab"), ("9", "Rajasthan"),
    ("24", "Sikkim"), ("10", "Tamil Nadu"), ("29", "Telangana"), ("38", "The Dadra And Nagar Haveli And Daman And Diu"), ("20", "Tripura"), ("15", "Uttarakhand"), ("13", "Uttar Pradesh"), ("16", "West Bengal"),
)
# The high courts as (code, name).
HIGH_COURTS = (
    ("13", "Allahabad High Court"), ("1", "Bombay High Court"), ("16", "Calcutta High Court"), ("6", "Gauhati High Court"), ("29", "High Court for Telangana"), ("2", "High Court of Andhra Pradesh"),
    ("18", "High Court of Chhattisgarh"), ("26", "High Court of Delhi"), ("17", "High Court of Gujarat"), ("5", "High Court of Himachal Pradesh"), ("12", "High Court of Jammu and Kashmir"),
    ("7", "High Court of Jharkhand"), ("3", "High Court of Karnataka"), ("4", "High Court of Kerala"), ("23", "High Court of Madhya Pradesh"), ("25", "High Court of Manipur"), ("21", "High Court of Meghalaya"),
    ("11", "High Court of Orissa"), ("22", "High Court of Punjab and Haryana"), ("9", "High Court of Rajasthan"), ("24", "High Court of Sikkim"), ("20", "High Court of Tripura"),
    ("15", "High Court of Uttarakhand"), ("10", "Madras High Court"), ("8", "Patna High Court"),
)
# The supreme court's case types as (code, name).
SC_CASE_TYPES = (
    ("1", "SPECIAL LEAVE PETITION (CIVIL)"), ("2", "SPECIAL LEAVE PETITION (CRIMINAL)"), ("3", "CIVIL APPEAL"), ("4", "CRIMINAL APPEAL"), ("5", "WRIT PETITION (CIVIL)"), ("6", "WRIT PETITION(CRIMINAL)"),
    ("7", "TRANSFER PETITION (CIVIL)"), ("8", "TRANSFER PETITION (CRIMINAL)"), ("9", "REVIEW PETITION (CIVIL)"), ("10", "REVIEW PETITION (CRIMINAL)"), ("11", "TRANSFERRED CASE (CIVIL)"),
    ("12", "TRANSFERRED CASE (CRIMINAL)"), ("13", "SPECIAL LEAVE TO PETITION (CIVIL)..."), ("14", "SPECIAL LEAVE TO PETITION (CRIMINAL)..."), ("15", "WRIT TO PETITION (CIVIL)..."),
    ("16", "WRIT TO PETITION (CRIMINAL)..."), ("17", "ORIGINAL SUIT"), ("18", "DEATH REFERENCE CASE"), ("19", "CONTEMPT PETITION (CIVIL)"), ("20", "CONTEMPT PETITION (CRIMINAL)"), ("21", "TAX REFERENCE CASE"),
    ("22", "SPECIAL REFERENCE CASE"), ("23", "ELECTION PETITION (CIVIL)"), ("24", "ARBITRATION PETITION"), ("25", "CURATIVE PETITION(CIVIL)"), ("26", "CURATIVE PETITION(CRL)"), ("27", "REF. U/A 317(1)"),
    ("28", "MOTION(CRL)"), ("31", "DIARYNO AND DIARYYR"), ("32", "SUO MOTO WRIT PETITION(CIVIL)"), ("33", "SUO MOTO WRIT PETITION(CRIMINAL)"), ("34", "SUO MOTO CONTEMPT PETITION(CIVIL)"),
    ("35", "SUO MOTO CONTEMPT PETITION(CRIMINAL)"), ("37", "REF. U/S 14 RTI"), ("38", "REF. U/S 17 RTI"), ("39", "MISCELLANEOUS APPLICATION"), ("40", "SUO MOTO TRANSFER PETITION(CIVIL)"),
    ("41", "SUO MOTO TRANSFER PETITION(CRIMINAL)"),
)
# The debt tribunals as (id, place), after "DEBTS RECOVERY TRIBUNAL ".
DEBT_TRIBUNALS = (
    (1, "DELHI (DRT 1)"), (2, "DELHI (DRT 2)"), (3, "DELHI (DRT 3)"), (9, "AHMEDABAD (DRT 1)"), (10, "AHMEDABAD (DRT 2)"), (11, "ALLAHABAD"), (12, "AURANGABAD"), (13, "BANGALORE (DRT 1)"),
    (14, "CHANDIGARH (DRT 1)"), (15, "CHANDIGARH (DRT 2)"), (16, "CHENNAI (DRT 1)"), (17, "CHENNAI (DRT 2)"), (18, "CHENNAI (DRT 3)"), (19, "COIMBATORE"), (20, "CUTTACK"), (21, "ERNAKULAM (DRT 1)"),
    (22, "GUWAHATI"), (23, "HYDERABAD (DRT 1)"), (24, "JABALPUR"), (25, "JAIPUR"), (26, "KOLKATA (DRT 1)"), (27, "KOLKATA (DRT 2)"), (28, "KOLKATA (DRT 3)"), (29, "LUCKNOW"), (30, "MADURAI"),
    (31, "MUMBAI (DRT 1)"), (32, "MUMBAI (DRT 2)"), (33, "MUMBAI (DRT 3)"), (34, "NAGPUR"), (35, "PATNA"), (36, "PUNE"), (37, "RANCHI"), (38, "VISHAKHAPATNAM"), (39, "BANGALORE (DRT 2)"),
    (40, "CHANDIGARH (DRT 3)"), (41, "DEHRADUN"), (42, "ERNAKULAM (DRT 2)"), (43, "HYDERABAD (DRT 2)"), (44, "SILIGURI"),
)
# The appellate tribunals as (id, place), after "DEBT RECOVERY APPELLATE TRIBUNAL - ".
APPELLATE_TRIBUNALS = ((100, "DELHI"), (101, "ALLAHABAD"), (102, "CHENNAI"), (103, "MUMBAI"), (104, "KOLKATA"))


def courts(spark: SparkSession, source: str) -> DataFrame:
    """The courts of a source: ord, code and name, with the names as results show them."""
    known = {
        "district_court": DISTRICT_STATES,
        "high_court": HIGH_COURTS,
        "drt": [(str(i), f"DEBTS RECOVERY TRIBUNAL {n}") for i, n in DEBT_TRIBUNALS],
        "drat": [(str(i), f"DEBT RECOVERY APPELLATE TRIBUNAL - {n}") for i, n in APPELLATE_TRIBUNALS],
        "nclt": [(str(i), n) for i, n, _ in NCLT_BENCHES],
        "scdrc": [(str(i), n) for i, n in CONSUMER_STATES],
    }
    return dimension(spark, known[source], "code string, name string")


def sc_case_types(spark: SparkSession) -> DataFrame:
    return dimension(spark, SC_CASE_TYPES, "code string, name string")


def sc_grid(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """T4: the supreme court's units: case types, and years from the last one down."""
    return grid(sc_case_types(spark).withColumnsRenamed({"code": "type_code", "name": "type_name"}), years(spark, first_year, last_year, down=True))


def court_grid(spark: SparkSession, inner: DataFrame, case_types: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """T4: a high or district court's units: its benches or establishments (``inner``), case types, years from the last one down, and pending before disposed."""
    states = dimension(spark, (("Pending",), ("Disposed",)), "state string")
    return grid(inner, case_types, years(spark, first_year, last_year, down=True), states)
