"""Declared schemas of the three raw tables and the value domains.

Everything in this module is a fixed value that must equal the source
system's for results to agree: column names and types in schema order, the
categorical domains in their natural order with their relative weights.
"""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField,
                               StructType)

S, I, D = StringType(), IntegerType(), DoubleType()


def _schema(cols):
    return StructType([StructField(n, t, True) for n, t in cols])


# ---- fixed values: raw table schemas (22 columns each, schema order) -------
POLICY_COLUMNS = [
    ("policy_id", S), ("customer_id", S), ("policy_type", S), ("coverage_amount", I),
    ("premium_amount", D), ("deductible", I), ("policy_start_date", S),
    ("policy_end_date", S), ("renewal_date", S), ("region", S), ("zip_code", S),
    ("property_type", S), ("construction_year", I), ("square_footage", I),
    ("policy_status", S), ("agent_id", S), ("underwriter_id", S), ("risk_score", D),
    ("discount_percentage", D), ("payment_frequency", S), ("created_date", S),
    ("last_updated", S),
]

CUSTOMER_COLUMNS = [
    ("customer_id", S), ("first_name", S), ("last_name", S), ("email", S), ("phone", S),
    ("date_of_birth", S), ("age_group", S), ("gender", S), ("marital_status", S),
    ("employment_status", S), ("income_range", S), ("credit_score_range", S),
    ("address_line1", S), ("city", S), ("state", S), ("zip_code", S), ("country", S),
    ("occupation", S), ("years_at_address", I), ("previous_claims_count", I),
    ("customer_since", S), ("last_contact_date", S),
]

CLAIM_COLUMNS = [
    ("claim_id", S), ("policy_id", S), ("customer_id", S), ("claim_type", S),
    ("claim_status", S), ("claim_date", S), ("incident_date", S), ("report_date", S),
    ("claim_amount", D), ("settlement_amount", D), ("deductible_applied", I),
    ("severity_level", S), ("adjuster_id", S), ("investigator_id", S),
    ("police_report_number", S), ("witness_count", I), ("photos_taken", I),
    ("repair_estimate", D), ("fraud_score", D), ("comments", S), ("created_date", S),
    ("last_updated", S),
]

POLICY_SCHEMA = _schema(POLICY_COLUMNS)
CUSTOMER_SCHEMA = _schema(CUSTOMER_COLUMNS)
CLAIM_SCHEMA = _schema(CLAIM_COLUMNS)

# Partition columns used when the raw tables are written as Parquet.
PARTITION_COLUMNS = {
    "policies": ["region", "policy_status"],
    "customers": ["state", "age_group"],
    "claims": ["claim_type", "claim_status"],
}

# ---- fixed values: categorical domains (natural order) and weights ----------
POLICY_TYPES = ["Home", "Renters", "Condo", "Mobile Home", "Vacation Home"]
POLICY_TYPE_WEIGHTS = [40, 25, 20, 10, 5]
COVERAGE_AMOUNTS = [50000, 100000, 150000, 200000, 300000, 500000, 750000, 1000000]
COVERAGE_WEIGHTS = [5, 15, 25, 20, 15, 10, 7, 3]
REGIONS = ["CA", "TX", "FL", "NY", "IL", "PA", "OH", "GA", "NC", "MI", "NJ", "VA",
           "WA", "AZ", "MA"]
REGION_WEIGHTS = [12, 10, 8, 7, 6, 5, 5, 4, 4, 4, 3, 3, 3, 3, 3]
POLICY_STATUSES = ["Active", "Inactive", "Suspended", "Cancelled", "Expired"]
POLICY_STATUS_WEIGHTS = [70, 10, 8, 7, 5]
PROPERTY_TYPES = ["Single Family", "Condo", "Townhouse", "Mobile Home", "Apartment"]
PAYMENT_FREQUENCIES = ["Monthly", "Quarterly", "Semi-Annual", "Annual"]
DEDUCTIBLES = [500, 1000, 1500, 2500, 5000]

AGE_GROUPS = ["18-25", "26-35", "36-45", "46-55", "56-65", "65+"]
AGE_WEIGHTS = [5, 20, 25, 25, 15, 10]
INCOME_RANGES = ["<30k", "30k-50k", "50k-75k", "75k-100k", "100k-150k", "150k-250k", "250k+"]
INCOME_WEIGHTS = [10, 20, 25, 20, 15, 7, 3]
CREDIT_RANGES = ["Poor (300-579)", "Fair (580-669)", "Good (670-739)",
                 "Very Good (740-799)", "Excellent (800-850)"]
CREDIT_WEIGHTS = [10, 20, 30, 25, 15]
MARITAL_STATUSES = ["Single", "Married", "Divorced", "Widowed", "Separated"]
MARITAL_WEIGHTS = [25, 50, 15, 7, 3]
EMPLOYMENT_STATUSES = ["Employed", "Self-Employed", "Retired", "Unemployed", "Student"]
EMPLOYMENT_WEIGHTS = [60, 15, 15, 7, 3]
FIRST_NAMES = ["John", "Jane", "Michael", "Sarah", "David", "Lisa", "Robert", "Jennifer",
               "William", "Maria"]
LAST_NAMES = ["Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis",
              "Rodriguez", "Martinez"]
GENDERS = ["M", "F", "Other"]
STREETS = ["Main", "Oak", "Pine", "Elm", "Cedar", "Maple"]
CITIES = ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix", "Philadelphia",
          "San Antonio", "San Diego", "Dallas", "San Jose"]
CUSTOMER_STATES = ["NY", "CA", "IL", "TX", "AZ", "PA", "TX", "CA", "TX", "CA"]
OCCUPATIONS = ["Engineer", "Teacher", "Manager", "Sales", "Healthcare", "Finance", "Legal",
               "Retail", "Construction", "Technology"]
PREVIOUS_CLAIMS = [0, 1, 2, 3, 4, 5]
PREVIOUS_CLAIMS_WEIGHTS = [60, 20, 10, 5, 3, 2]

CLAIM_TYPES = ["Water Damage", "Theft", "Fire", "Wind/Hail", "Vandalism", "Liability",
               "Personal Property", "Additional Living Expenses"]
CLAIM_TYPE_WEIGHTS = [25, 20, 10, 15, 8, 7, 10, 5]
CLAIM_STATUSES = ["Open", "In Progress", "Approved", "Denied", "Closed", "Under Review"]
CLAIM_STATUS_WEIGHTS = [10, 15, 20, 5, 40, 10]
SEVERITY_LEVELS = ["Low", "Medium", "High", "Critical"]
SEVERITY_WEIGHTS = [40, 35, 20, 5]
SEVERITY_AMOUNT_FACTOR = {"Low": 0.5, "Medium": 1.0, "High": 2.0, "Critical": 4.0}
CLAIM_AMOUNT_RANGES = [(100, 1000), (1000, 5000), (5000, 15000), (15000, 50000),
                       (50000, 100000), (100000, 500000)]
CLAIM_AMOUNT_WEIGHTS = [30, 35, 20, 10, 3, 2]

# Five comment texts per claim type, in claim-type order.
CLAIM_COMMENTS = {
    "Water Damage": [
        "Burst pipe in basement caused significant water damage to flooring and drywall",
        "Roof leak during heavy rainstorm damaged ceiling and walls",
        "Washing machine overflow flooded laundry room and adjacent areas",
        "Water heater failure caused extensive water damage throughout home",
        "Sewer backup resulted in contaminated water damage requiring professional cleanup",
    ],
    "Theft": [
        "Home burglary - electronics and jewelry stolen, forced entry through back door",
        "Package theft from front porch, security camera footage shows suspect",
        "Vehicle break-in, laptop and tools stolen from car",
        "Garage break-in, bicycles and power tools stolen",
        "Theft of outdoor equipment including lawn mower and garden tools",
    ],
    "Fire": [
        "Kitchen fire caused by unattended cooking, smoke damage throughout home",
        "Electrical fire in basement, extensive damage to electrical panel",
        "Wildfire damage to exterior of home, smoke damage inside",
        "Candle fire in bedroom, limited damage but smoke throughout house",
        "Grill fire spread to deck and siding, moderate damage",
    ],
    "Wind/Hail": [
        "Hailstorm damaged roof shingles and gutters, need roof replacement",
        "High winds caused tree to fall on house, structural damage to roof",
        "Tornado damage to siding and windows, debris throughout property",
        "Severe windstorm damaged fence and outdoor structures",
        "Hail damage to vehicle and outdoor furniture",
    ],
    "Vandalism": [
        "Graffiti spray painted on exterior walls and garage door",
        "Broken windows from thrown rocks, glass damage throughout",
        "Vandalized mailbox and outdoor lighting fixtures",
        "Keyed car paint damage, multiple deep scratches",
        "Broken fence panels and damaged landscaping",
    ],
    "Liability": [
        "Guest injured on property due to uneven walkway, medical expenses covered",
        "Dog bite incident with neighbor, liability coverage activated",
        "Slip and fall on icy driveway, medical and legal expenses",
        "Property damage caused by falling tree branch onto neighbor's car",
        "Accidental damage to neighbor's fence during construction work",
    ],
    "Personal Property": [
        "Stolen laptop and camera equipment from home office",
        "Jewelry theft during home invasion, high-value items missing",
        "Electronics damaged by power surge, multiple devices affected",
        "Artwork damaged during move, professional restoration needed",
        "Musical instruments stolen from home, professional equipment loss",
    ],
    "Additional Living Expenses": [
        "Temporary housing required due to extensive water damage repairs",
        "Hotel expenses during kitchen fire restoration work",
        "Rental car needed while vehicle repaired after accident",
        "Temporary storage costs for belongings during home renovation",
        "Meal expenses during extended displacement from home",
    ],
}

# Domains used by canonical title-casing (case-insensitive lookup).
CANONICAL_DOMAINS = {
    "policy_type": POLICY_TYPES,
    "property_type": PROPERTY_TYPES,
    "policy_status": POLICY_STATUSES,
    "payment_frequency": PAYMENT_FREQUENCIES,
    "claim_type": CLAIM_TYPES,
    "claim_status": CLAIM_STATUSES,
    "severity_level": SEVERITY_LEVELS,
}

DATA_SOURCE = "content_insurance_generator"

# Ranges of the generated numbers and dates, both ends included. Fixed values.
RANGES = {
    "premium_rate": (0.008, 0.015),
    "premium_shift": (-200, 500),
    "start": ("2020-01-01", "2024-01-01"),
    "end": ("2024-01-01", "2025-12-31"),
    "renewal": ("2024-01-01", "2025-12-31"),
    "zip": (10000, 99999),
    "construction_year": (1950, 2023),
    "square_footage": (800, 5000),
    "agent": (1, 100),
    "underwriter": (1, 50),
    "risk": (200, 850),
    "discount": (0, 25),
    "created": ("2020-01-01", "2024-01-01"),
    "updated": ("2023-01-01", "2024-01-01"),
    "phone_a": (100, 999),
    "phone_b": (100, 999),
    "phone_c": (1000, 9999),
    "house": (100, 9999),
    "dob": ("1950-01-01", "2005-12-31"),
    "years_at_address": (1, 20),
    "since": ("2015-01-01", "2023-01-01"),
    "contact": ("2023-01-01", "2024-01-01"),
    "settle": (0.3, 0.95),
    "comment": (1, 5),
    "incident": ("2020-01-01", "2024-01-01"),
    "police_no": (100000, 999999),
    "adjuster": (1, 50),
    "investigator": (1, 30),
    "witness": (0, 5),
    "photos": (0, 20),
    "repair": (0.8, 1.2),
    "fraud": (0, 100),
}
