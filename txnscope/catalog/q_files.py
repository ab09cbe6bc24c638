"""Source / sink round trips."""

from pyspark.sql import functions as F

from txnscope.catalog.registry import query
from txnscope.functions import parse as P
from txnscope.sources import files as A
from txnscope.sources import txn_orders
from txnscope.sources.raw import raw_transactions
from txnscope.streaming.source import new_run_dir

RAW_COLS = ["txn_id", "client_id", "amount_txt", "date_txt", "time_txt", "label_txt", "chip_txt", "city",
            "terminal", "currency", "birth_txt", "sex"]

ROUND_TRIP_SQL = """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows, r6(sum(amount)) AS amount,
       CAST(sum(y) AS BIGINT) AS positives
FROM txn_events GROUP BY 1
"""


@query("a1_a5_file_round_trip", ROUND_TRIP_SQL)
def round_trip(spark, sf_dir):
    """A1 latin-1 '|' text export read back with an all-string schema and typed with the
    total parsers; A4 written as parquet partitioned by day and read back with partition
    pruning; A3 CSV and A5 JSON report written and read back."""
    path = new_run_dir(spark, "files")
    raw = raw_transactions(spark, sf_dir).select(*[F.col(c).cast("string") for c in RAW_COLS])
    A.write_delimited(raw, f"{path}/raw")
    r = A.read_delimited(spark, f"{path}/raw", RAW_COLS)
    typed = r.select(F.col("txn_id").cast("long").alias("txn_id"),
                     P.decimal_comma("amount_txt").alias("amount"),
                     F.date_format(P.date_yymmdd("date_txt"), "yyyy-MM-dd").alias("day"),
                     P.binary_label("label_txt").alias("y"))
    A.write_partitioned(typed, f"{path}/curated", ["day"])
    cur = spark.read.parquet(f"{path}/curated")
    per_day = cur.groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"),
                                     F.sum(F.coalesce("y", F.lit(0))).cast("long").alias("positives"))
    A.write_csv(per_day, f"{path}/report_csv")
    back = A.read_csv(spark, f"{path}/report_csv", "day string, rows long, amount double, positives long")
    A.write_report(back, f"{path}/report_json")
    return spark.read.schema("day string, rows long, amount double, positives long").json(f"{path}/report_json")


@query("a8_dataset_fingerprint")
def fp(spark, sf_dir):
    """Order-insensitive fingerprint (rows + XOR of row hashes); equal for a shuffled,
    repartitioned copy."""
    t = txn_orders(spark, sf_dir)
    a = A.fingerprint(t).withColumn("copy", F.lit("original"))
    b = A.fingerprint(t.repartition(7, "client_id").orderBy(F.rand(1))).withColumn("copy", F.lit("shuffled"))
    return a.unionByName(b)


FINGERPRINT_SQL = """
SELECT CAST(2 AS BIGINT) AS copies, CAST(1 AS BIGINT) AS fingerprints, count(*) AS rows, 16 AS digits FROM txn_orders
"""


@query("a8_fingerprint_facts", FINGERPRINT_SQL)
def fp_facts(spark, sf_dir):
    """A8, what SQL can state: the rows counted, and that the original and the shuffled copy share one fingerprint of 16 digits."""
    return fp(spark, sf_dir).agg(F.count(F.lit(1)).alias("copies"), F.count_distinct("fingerprint").alias("fingerprints"),
                                 F.max("rows").alias("rows"), F.max(F.length("fingerprint")).alias("digits"))
