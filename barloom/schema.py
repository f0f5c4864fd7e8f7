"""Names, types and formats shared by all steps."""

from pyspark.sql import types as T

# Column names, the time format and the file name of a landed day.
OHLCV = ("open", "high", "low", "close", "volume")
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
DAY_FORMAT = "yyyy-MM-dd"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
LANDED_NAME = r"([^/=]+)-s1-bid-(\d{4}-\d{2}-\d{2})-\d{4}-\d{2}-\d{2}\.csv(?:/[^/]*)?$"
DATE_WORDS = ("date", "time", "timestamp")
# Texts that stand for a missing value in a CSV field.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

DAILY_KEYS = ["symbol", "date"]
YEARLY_KEYS = ["symbol", "year"]
ANY_YEAR = (None, None)

CATALOG = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("earliest_date", T.DateType()),
        T.StructField("location", T.StringType()),
    ]
)
