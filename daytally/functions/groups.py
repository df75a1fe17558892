"""Which series belong to which group of the dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.text import decode_field_slug

# Short names of the series shown together.
SERIES_GROUPS = {
    "total": ["Total_Crimes"],
    "public": [
        "Location_ALLEY",
        "Location_COMMERCIAL_s_BUSINESS_OFFICE",
        "Location_CTA_PLATFORM",
        "Location_PARK_PROPERTY",
        "Location_PARKING_LOT__GARAGE_p1_NON_x_RESID_x__p2_",
        "Location_SCHOOL_c_PUBLIC_c_BUILDING",
        "Location_SIDEWALK",
        "Location_STREET",
        "Location_OTHER",
    ],
    "residential": [
        "Location_APARTMENT",
        "Location_RESIDENCE",
        "Location_RESIDENCE_PORCH__HALLWAY",
        "Location_RESIDENCE_h_GARAGE",
        "Location_RESIDENTIAL_YARD__p1_FRONT__BACK_p2_",
        "Location_VEHICLE_NON_h_COMMERCIAL",
    ],
    "stores": [
        "Location_DEPARTMENT_STORE",
        "Location_GAS_STATION",
        "Location_GROCERY_FOOD_STORE",
        "Location_RESTAURANT",
        "Location_SMALL_RETAIL_STORE",
    ],
    "types 1": [
        "Type_ASSAULT",
        "Type_BATTERY",
        "Type_BURGLARY",
        "Type_CRIM_SEXUAL_ASSAULT",
        "Type_CRIMINAL_DAMAGE",
    ],
    "types 2": [
        "Type_CRIMINAL_TRESPASS",
        "Type_DECEPTIVE_PRACTICE",
        "Type_GAMBLING",
        "Type_INTERFERENCE_WITH_PUBLIC_OFFICER",
        "Type_LIQUOR_LAW_VIOLATION",
    ],
    "types 3": [
        "Type_MOTOR_VEHICLE_THEFT",
        "Type_NARCOTICS",
        "Type_OFFENSE_INVOLVING_CHILDREN",
        "Type_PROSTITUTION",
        "Type_PUBLIC_PEACE_VIOLATION",
    ],
    "types 4": [
        "Type_ROBBERY",
        "Type_SEX_OFFENSE",
        "Type_THEFT",
        "Type_WEAPONS_VIOLATION",
        "Type_OTHER_OFFENSE",
    ],
    "weather": ["Depart", "Heat", "PrecipTotal", "Tavg", "Tmin", "Tmax"],
}


def series_groups(spark: SparkSession) -> DataFrame:
    """``(group, slug, category)``, one row per known series."""
    rows = [(group, slug) for group, slugs in SERIES_GROUPS.items() for slug in slugs]
    df = spark.createDataFrame(rows, "`group` string, slug string")
    return df.withColumn("category", decode_field_slug(F.col("slug")))
