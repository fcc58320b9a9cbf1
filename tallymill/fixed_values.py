"""Names, thresholds and texts that results must share with existing tables."""

# Sales lab: replacements for missing values, and what counts as a high-value sale.
LAB_FILLS = {"customer_id": 0, "promo_code": "NO CODE"}
HIGH_VALUE_TOTAL = 5

# Taxi: thresholds of suspicious rides, length of the top list, table names.
SUSPICIOUS_FARE_PER_KM = 10.0
SHORT_TRIP_KM = 1.0
HIGH_FARE = 25.0
TOP_FARES = 3
TAXI_DATABASE = "taxi_etl_db"
TAXI_BRONZE = "taxi_bronze"
TAXI_CLEAN = "taxi_silver_clean"
TAXI_SUSPICIOUS = "taxi_silver_suspicious_rides"
TAXI_WEEKLY = "taxi_silver_weekly_aggregates"
TAXI_TOP = "taxi_gold_top3_highest_fares"

# Order book: partition columns, statuses, and the limits of the low-value clean-up.
ORDER_PARTITIONS = ("country", "order_date")
PAID = "PAID"
CANCELLED = "CANCELLED"
LOW_VALUE = 50
DELETE_BELOW = 10

# Retail medallion: look-back for late sales, source name, and run-log entries.
LOOKBACK = "2 days"
SOURCE_SYSTEM = "retail_sales_csv"
BRONZE_PIPELINE = "bronze_sales_ingestion"
SILVER_PIPELINE = "silver_sales_incremental"
BRONZE_LAYER = "bronze"
SILVER_LAYER = "silver"
SUCCESS = "SUCCESS"
FAILED = "FAILED"
