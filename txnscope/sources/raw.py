"""Raw-text transaction view derived from ``events``.

Mimics the raw delimited export of the reference (decimal commas, ``yyMMdd``
dates, unpadded ``hhmmss00`` times, ``SI``/``NO`` labels, stray chip values,
missing cities, 0–14 terminal codes of which 13 and 14 are unknown), so the
parsing operators can be checked against the original typed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.sources.tables import txn_events


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = txn_events(spark, sf_dir)
    hhmmss = (F.hour("ts") * 1000000 + F.minute("ts") * 10000 + F.second("ts") * 100)
    birth = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("client_id") * 7).cast("int"))
    return e.select(
        "txn_id", "client_id", "ts", "amount", "code", "category",
        F.regexp_replace(F.col("amount").cast("string"), r"\.", ",").alias("amount_txt"),
        F.date_format("ts", "yyMMdd").alias("date_txt"),
        F.when(F.col("code") == 0, F.lit("99999999")).otherwise(hhmmss.cast("string"))
        .alias("time_txt"),
        F.when(F.col("y") == 1, F.lit("SI")).when(F.col("category") == "signup", F.lit("N/D"))
        .otherwise(F.lit("NO")).alias("label_txt"),
        F.when(F.col("code") < 5, F.lit("0")).when(F.col("code") < 50, F.lit("S"))
        .otherwise(F.lit("N")).alias("chip_txt"),
        F.when(F.col("code") >= 90, F.lit(None).cast("string")).otherwise(F.upper("category"))
        .alias("city"),
        (F.col("code") / 7).cast("int").alias("terminal"),
        F.when(F.col("amount") > 50, F.lit(2)).otherwise(F.lit(1)).alias("currency"),
        F.date_format(birth, "dd/MM/yyyy").alias("birth_txt"),
        F.when((F.col("category") == "error") & (F.col("code") >= 95), F.lit("X"))
        .when(F.col("client_id") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("sex"),
        F.col("y"),
    )


RAW_TRANSACTIONS_SQL = """
SELECT txn_id, client_id, ts, amount, code, category,
       replace(CAST(amount AS VARCHAR), '.', ',') AS amount_txt,
       strftime(ts, '%y%m%d') AS date_txt,
       CASE WHEN code = 0 THEN '99999999'
            ELSE CAST(hour(ts) * 1000000 + minute(ts) * 10000 + second(ts) * 100 AS VARCHAR) END AS time_txt,
       CASE WHEN y = 1 THEN 'SI' WHEN category = 'signup' THEN 'N/D' ELSE 'NO' END AS label_txt,
       CASE WHEN code < 5 THEN '0' WHEN code < 50 THEN 'S' ELSE 'N' END AS chip_txt,
       CASE WHEN code >= 90 THEN NULL ELSE upper(category) END AS city,
       CAST(trunc(code / 7) AS INT) AS terminal,
       CASE WHEN amount > 50 THEN 2 ELSE 1 END AS currency,
       strftime(DATE '1950-01-01' + CAST(client_id * 7 AS INT), '%d/%m/%Y') AS birth_txt,
       CASE WHEN category = 'error' AND code >= 95 THEN 'X'
            WHEN client_id % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
       y
FROM txn_events
"""
