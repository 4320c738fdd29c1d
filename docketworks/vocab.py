"""Fixed values of the court domain, in their natural order."""

CHARGE_TYPES = (
    "Theft", "Assault", "Drug Possession", "DUI",
    "Burglary", "Fraud", "Traffic Violation", "Domestic Violence",
)
SEVERITIES = ("Violation", "Misdemeanor", "Felony")
CASE_STATUSES = ("Filed", "Pending", "Active", "Scheduled")
GENDERS = ("Male", "Female", "Other")
INCOME_LEVELS = ("Low", "Medium", "High")
HEARING_TYPES = ("Arraignment", "Pre-trial", "Plea Hearing", "Trial", "Sentencing")
ZIP_CODES = (
    10001, 10002, 10003, 11201, 11205, 11215,
    11101, 11103, 10451, 10452, 10301, 10302,
)

PRIVATE = "Private Attorney"
ASSIGNED = "Public Defender Assigned"
REQUESTED = "Public Defender Requested"
SELF = "Self-Represented"
PENDING = "Attorney Pending"
ATTORNEY_STATUSES = (PRIVATE, ASSIGNED, REQUESTED, SELF, PENDING)

# borough name inside the district name -> district code
BOROUGH_CODES = {
    "Manhattan": "MN",
    "Brooklyn": "BK",
    "Queens": "QN",
    "Bronx": "BX",
    "Staten Island": "SI",
}
DISTRICTS = tuple(f"{borough} Criminal Court" for borough in BOROUGH_CODES)

UNKNOWN_DISTRICT = "Unknown"
MISSING_ZIP = 99999
REPAIR_DAYS = 14

# upper limit (inclusive) -> label; the last label takes the rest and nulls
AGE_BANDS = ((25, "18-25"), (35, "26-35"), (45, "36-45"), (55, "46-55"), (65, "56-65"))
AGE_BAND_REST = "65+"
URGENCY_BANDS = ((3, "URGENT"), (7, "SOON"))
URGENCY_REST = "SCHEDULED"

# lower limit (inclusive) -> label
ALERT_STEPS = ((9, "CRITICAL"), (7, "HIGH"), (5, "MEDIUM"))
ALERT_REST = "LOW"
CATEGORY_STEPS = ((8, "Critical"), (6, "High"), (4, "Medium"))
CATEGORY_REST = "Low"
ALERT_THRESHOLD = 7

# priority scores
SCORE_NOT_NEEDED = 1
SCORE_BY_DAYS = ((2, 10), (7, 8))
SCORE_NEEDED = 6
SCORE_FALLBACK = 3
SOON_DAYS = 7
