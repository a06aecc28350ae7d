"""Region lookups: the region of each script number and region codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Script number to script path, whose folder names the region.
SCRIPTS = {
    "01": "01_kuala-lumpur/main.py",
    "02": "02_selangor/main.py",
    "03": "03_johor/main.py",
    "04": "04_penang/main.py",
    "05": "05_perak/main.py",
    "06": "06_negeri-sembilan/main.py",
    "07": "07_melaka/main.py",
    "08": "08_pahang/main.py",
    "09": "09_sabah/main.py",
    "10": "10_sarawak/main.py",
    "11": "11_kedah/main.py",
    "12": "12_putrajaya/main.py",
    "13": "13_kelantan/main.py",
    "14": "14_terengganu/main.py",
    "15": "15_perlis/main.py",
    "16": "16_labuan/main.py",
}

# Region code to region.
REGION_CODES = {
    "01": "johor",
    "02": "kedah",
    "03": "kelantan",
    "04": "melaka",
    "05": "negeri-sembilan",
    "06": "pahang",
    "07": "penang",
    "08": "perak",
    "09": "perlis",
    "10": "selangor",
    "11": "terengganu",
    "12": "sabah",
    "13": "sarawak",
    "14": "kuala-lumpur",
    "15": "labuan",
    "16": "putrajaya",
}


def region_dim(spark: SparkSession) -> DataFrame:
    """Script number, region and region code, one row per region."""
    codes = {region: code for code, region in REGION_CODES.items()}
    regions = {number: path.split("/")[0].split("_")[1] for number, path in SCRIPTS.items()}
    rows = [(number, region, codes[region]) for number, region in regions.items()]
    return spark.createDataFrame(rows, "script_number string, region string, region_code string")
