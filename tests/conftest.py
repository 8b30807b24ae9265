import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

# Ten invented listings: a leading-zero ZIP, ties in price and size, every lot bucket, status and segment.
SAMPLE_HEADER = "street,city,state,zip_code,brokered_by,status,price,bed,bath,acre_lot,house_size,prev_sold_date"
SAMPLE_ROWS = [
    "17 Harbor Way,Portsmouth,NH,03801,Granite Homes,For Sale,640000,3,2,0.30,1750,2018-02-11",
    "2204 Mesa Trail,Santa Fe,NM,87501,Adobe Realty,Sold,1250000,4,3,1.40,3100,2018-10-05",
    "9 Lakeshore Ct,Madison,WI,53703,Lakes Group,For Sale,475000,3,2,0.25,2000,2019-04-18",
    "88 Juniper St,Boise,ID,83702,Summit Brokers,For Sale,390000,2,1,0.12,980,2015-07-09",
    "301 Peachtree Ln,Savannah,GA,31401,Live Oak Realty,Sold,520000,3,2,0.18,1640,2021-01-22",
    "45 Cannery Rd,Astoria,OR,97103,Tidewater,For Sale,390000,2,1,0.12,980,2016-09-30",
    "1200 Bluebonnet Dr,Waco,TX,76701,Lone Star Lots,For Sale,310000,4,2,1.00,2250,2014-05-14",
    "6 Orchard Hill,Provo,UT,84601,Maple Agency,Sold,700000,3,3,0.60,1900,2022-03-03",
    "73 Canal View,Tulsa,OK,74103,Prairie Homes,For Sale,1100000,5,4,2.10,4200,2017-11-28",
    "510 Dune Rd,Mobile,AL,36602,Gulf Coast Realty,For Sale,225000,2,2,0.08,860,2020-08-16",
]
SAMPLE_SCHEMA = (
    "street string, city string, state string, zip_code string, brokered_by string, status string, "
    "price double, bed int, bath int, acre_lot double, house_size double, prev_sold_date date"
)
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("rowmill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sample_csv():
    d = tempfile.mkdtemp(prefix="rowmill-sample-")
    path = os.path.join(d, "listings.csv")
    with open(path, "w") as fh:
        fh.write("\n".join([SAMPLE_HEADER, *SAMPLE_ROWS]) + "\n")
    return path


@pytest.fixture(scope="session")
def sample(spark, sample_csv):
    """Sample listings read with the declared schema (zip code kept as text)."""
    return spark.read.option("header", "true").schema(SAMPLE_SCHEMA).csv(sample_csv)


def rows(df, *cols):
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
